"""Domain tables derived from the generic Parquet tables lineitem, part, supplier and events.

Each adapter has a SQL twin of the same name in ``oracle.CTES``. Remainders of
keys plant the special cases: unknown products, missing prices, empty slots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storespark.operators.joins import enrich_shelf_position
from storespark.operators.shelves import layout_grid
from storespark.operators.validation import CLEANED_COLUMNS, clean_rows, validate
from storespark.tables import Tables

STORES = [1, 2, 3]


def _money(expr: str) -> str:
    return f"cast({expr} as decimal(12,4))"


def _each_store() -> F.Column:
    return F.explode(F.array(*[F.lit(s) for s in STORES])).alias("store_id")


class Testbed:
    __test__ = False

    """Lazily built tables over one folder of Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._sources: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._sources[name]

    def tables(self) -> Tables:
        names = [
            "products", "brands", "store_layout", "store_assortment", "past_assortment", "inventory", "suppliers",
            "product_suppliers", "products_specifications", "movements", "raw_movements", "cleaned_movements",
        ]
        t = Tables({name: getattr(self, name) for name in names})
        self._t = t
        return t

    def products(self) -> DataFrame:
        return self.source("part").selectExpr(
            "cast(p_partkey as string) as product_id",
            "p_name as product_description",
            "case when p_partkey % 97 <> 0 then p_type end as category_level_1",
            "split_part(p_name, ' ', 1) as category_level_2",
            "split_part(p_name, ' ', 2) as category_level_3",
            "cast(case p_size % 3 when 0 then 4 when 1 then 10 else 22 end as decimal(5,2)) as vat_rate",
            "case when p_size % 4 = 0 then 'KG' else 'PZ' end as unit_of_measure",
            _money("cast(p_retailprice as decimal(12,2)) * cast(0.6 as decimal(2,1))") + " as purchase_price",
            _money("p_retailprice") + " as sale_price",
            "case when p_partkey % 11 <> 0 then concat('B', substr(p_brand, 7), '-', p_type) end as brand_code",
        )

    def brands(self) -> DataFrame:
        """Brands of all products but the PROMO ones, which stay without a name."""
        return self.source("part").selectExpr(
            "concat('B', substr(p_brand, 7), '-', p_type) as brand_code", "upper(concat(p_type, ' ', p_brand)) as brand_name", "p_type"
        ).filter("p_type <> 'PROMO'").select("brand_code", "brand_name").distinct()

    def _positions(self, shift: int, inactive: int) -> DataFrame:
        """Every tenth product has no position; every ``inactive``-th one is not active, some flags are null."""
        key = f"(p_partkey + {shift})"
        return (
            self.source("part")
            .filter("p_partkey % 10 <> 0")
            .select(_each_store(), "p_partkey")
            .selectExpr(
                "store_id",
                "cast(p_partkey as string) as product_id",
                f"cast({key} div 45 + 1 as int) as shelf_id",
                f"cast(({key} % 45) div 9 + 1 as int) as shelf_level",
                f"case ({key} % 9) div 3 when 0 then 'left' when 1 then 'center' else 'right' end as zone",
                f"cast({key} % 3 + 1 as int) as slot_number",
                f"case when p_partkey % 41 <> 0 then p_partkey % {inactive} <> 0 end as active_flag",
            )
        )

    def store_assortment(self) -> DataFrame:
        return self._positions(0, 7)

    def past_assortment(self) -> DataFrame:
        """Positions at the time the movements were loaded."""
        return self._positions(100, 5)

    def stores(self) -> DataFrame:
        """Stores with the number of shelves their products need."""
        shelves = self.source("part").agg(F.expr("cast(max(p_partkey) div 45 + 1 as int)").alias("n_shelves"))
        return shelves.select(_each_store(), "n_shelves")

    def store_layout(self) -> DataFrame:
        return layout_grid(self.stores()).withColumns(
            {
                "shelf_category": F.expr("case when shelf_id % 2 = 0 then concat('C', shelf_id % 6) end"),
                "capacity": F.expr(
                    "case when shelf_id % 5 = 0 then 0 when shelf_id % 7 = 0 then null else shelf_level * 3 end"
                ),
            }
        )

    def inventory(self) -> DataFrame:
        """Every thirteenth product has no inventory row; some stock is negative."""
        return (
            self.source("part").filter("p_partkey % 13 <> 0").select(_each_store(), "p_partkey")
            .selectExpr(
                "store_id",
                "cast(p_partkey as string) as product_id",
                "cast((p_partkey * 17 + store_id * 5) % 60 - 10 as int) as stock_qty",
                "timestamp'2024-01-01 00:00:00' as updated_at",
            )
        )

    def suppliers(self) -> DataFrame:
        return self.source("supplier").selectExpr(
            "cast(s_suppkey as string) as supplier_id",
            "s_name as supplier_name",
            "case when s_suppkey = 0 then 'primary' else 'secondary' end as supplier_type",
        )

    def product_suppliers(self) -> DataFrame:
        """The primary supplier, a secondary one, or both; every 23rd product has none."""
        second = "cast(p_partkey % 9 + 1 as string)"
        options = (
            "case when p_partkey % 23 = 0 then array() "
            "when p_partkey % 10 < 7 then array(named_struct('s', '0', 'p', true)) "
            f"when p_partkey % 10 < 9 then array(named_struct('s', {second}, 'p', false)) "
            f"else array(named_struct('s', '0', 'p', true), named_struct('s', {second}, 'p', false)) end"
        )
        return self.source("part").selectExpr(
            "cast(p_partkey as string) as product_id", f"explode({options}) as o"
        ).selectExpr("product_id", "o.s as supplier_id", "o.p as is_primary_supplier")

    def products_specifications(self) -> DataFrame:
        return self.source("part").selectExpr(
            "cast(p_partkey as string) as product_id",
            "case p_size % 3 when 0 then 'high' when 1 then 'medium' else 'low' end as rotation_class",
            "cast(p_size * 0.0021 as decimal(6,5)) as spoilage_probability",
            "cast(p_size * 2 as int) as initial_stock",
            "cast(p_size % 20 + 5 as int) as minimum_stock_threshold",
            "cast(p_size as int) as reorder_lot",
            "p_partkey % 10 <> 0 as assortment_flag",
        )

    def lines(self) -> DataFrame:
        """Line items as movements without a position: R is breakage, A purchase, N sale."""
        part = self.source("part").select("p_partkey", "p_retailprice")
        price = "cast(p_retailprice as decimal(12,2))"
        return self.source("lineitem").join(part, F.expr("p_partkey = l_partkey")).selectExpr(
            "cast(l_orderkey % 3 + 1 as int) as store_id",
            "case when l_orderkey % 53 = 0 then 'UNKNOWN' else cast(l_partkey as string) end as product_id",
            "case when l_returnflag = 'A' then cast(l_suppkey as string) end as supplier_id",
            "case l_returnflag when 'R' then 'breakage' when 'A' then 'purchase' else 'sale' end as movement_type",
            "cast(l_quantity as int) as quantity",
            "case when l_returnflag = 'N' then "
            + _money(f"{price} * (1 - cast(l_discount as decimal(4,2)))") + " end as unit_sale_price",
            "case when l_returnflag = 'A' then "
            + _money(f"{price} * cast(0.6 as decimal(2,1))") + " end as unit_purchase_price",
            "l_linenumber = 1 as is_promo",
            "cast(l_shipdate as date) as movement_date",
        )

    def movements(self) -> DataFrame:
        """Line items with their position at load."""
        return enrich_shelf_position(self.lines(), self._t.past_assortment)

    def raw_movements(self) -> DataFrame:
        """Events as raw movements with planted faults."""
        return self.source("events").selectExpr(
            "event_id as raw_movement_id",
            "concat('movements_', cast(cast(ts as date) as string), '.csv') as source_file_name",
            "'simulated_api' as source_system",
            "cast(user_id % 3 + 1 as int) as store_id",
            "case when event_id % 53 = 0 then 'UNKNOWN' else cast((event_id * 7919) % 200 as string) end as product_id",
            "case when event_type <> 'purchase' or event_id % 31 = 0 then null when event_id % 37 = 0 then '-1' "
            "else cast(event_id % 10 as string) end as supplier_id",
            "case event_type when 'purchase' then 'purchase' when 'error' then 'breakage' else 'sale' end "
            "as movement_type",
            "cast(event_id % 9 + 1 as int) as quantity",
            "case when event_type = 'purchase' or event_id % 41 = 0 then null "
            "when event_type = 'error' and event_id % 47 <> 0 then null "
            "when event_id % 43 = 0 then cast(0 as decimal(12,4)) else cast(value as decimal(12,4)) end "
            "as unit_sale_price",
            "case when event_type = 'purchase' and event_id % 29 <> 0 then cast(value as decimal(12,4)) end "
            "as unit_purchase_price",
            "event_id % 7 = 0 as is_promo",
            "case when event_id % 7 = 0 then case event_id % 3 when 0 then 'sconto_percentuale' "
            "when 1 then 'offerta_3x2' else 'prezzo_speciale' end end as promo_type",
            "cast(ts as timestamp) as movement_timestamp",
            "cast(ts as date) as movement_date",
        )

    def validated(self) -> DataFrame:
        return validate(self._t.raw_movements, self._t.products, self._t.suppliers)

    def cleaned_movements(self) -> DataFrame:
        """Clean events; a quarter of them counts as loaded on 2024-02-01."""
        loaded = F.col("raw_movement_id") % 4 == 0
        return clean_rows(self.validated()).select(
            F.col("raw_movement_id").alias("cleaned_movement_id"),
            *CLEANED_COLUMNS,
            loaded.alias("loaded"),
            F.when(loaded, F.lit("2024-02-01").cast("timestamp")).alias("loaded_at"),
        )

    def price_rows(self) -> DataFrame:
        """Parts as price list rows; descriptions carry upper case and extra blanks."""
        return self.source("part").selectExpr(
            "p_partkey as id_prodotto",
            "concat(upper(p_name), '  ', p_type) as descrizione",
            "case when p_partkey % 97 <> 0 then p_type end as cat1",
            "split_part(p_name, ' ', 1) as cat2",
            "split_part(p_name, ' ', 2) as cat3",
            "case when p_size % 17 = 0 then '++' when p_size % 3 = 0 then '4' when p_size % 3 = 1 then '10' "
            "else '22' end as iva",
            "cast(p_size as int) as pzxcar",
            "case when p_size % 4 = 0 then 'KG' else 'PZ' end as um",
            "cast(case when p_partkey % 3 = 0 then 7 else 0 end as int) as brand",
            _money("cast(p_size as decimal(12,4)) / 10 - cast(1 as decimal(12,4))") + " as costo",
            _money("cast(p_size as decimal(12,4)) / 10") + " as prezzo_vendita",
        )


# spellings over the words of part names: overlapping, multi-word, and one that never occurs
SPELLINGS = [
    ("red ring", "B001"), ("old", "B002"), ("ring", "B003"), ("small g", "B004"), ("gizmo", "B005"), ("gear", "B006"),
    ("red", "B007"), ("wid", "B008"), ("widget economy", "B009"), ("anvil", "B010"), ("hot plate", "B011"),
    ("plate", "B012"),
]
SHARES = {"STANDARD": 0.05, "LARGE": 0.3, "SMALL": 0.3, "PROMO": 1.0}
CLASS_RULES = [
    [("STANDARD", "high", "0.03", "0.08"), ("LARGE", "low", "0.0", "0.0005"), ("PROMO", "medium", "0.001", "0.004")],
    [("red", "high", "0.0005", "0.002"), ("old", "low", "0.0001", "0.0005")],
    [("anvil", "low", "0.0", "0.001"), ("gear", "high", "0.05", "0.12")],
]

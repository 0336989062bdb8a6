"""SQL twins of the registered queries, for a second engine on the same Parquet tables.

Dates and times are compared as text, money as double after exact decimal sums,
whole numbers and flags that may be null as double; ``registry.portable`` does
the same to the Spark results.
"""

from __future__ import annotations

from storespark.functions import fixed_values as fixed
from storespark.testbed.adapters import CLASS_RULES, SHARES, SPELLINGS

# whole numbers and flags with nulls, which result frames of engines show in different types
NULLABLE = {
    "movements_projection": ["shelf_id", "shelf_level", "slot_number"],
    "enrich_shelf_position": ["shelf_id", "shelf_level", "slot_number"],
    "stream_pipeline": ["shelf_id", "shelf_level", "slot_number"],
    "margins_by_product_shelf": ["shelf_id"],
    "shelf_products_grid": ["stock_qty"],
    "shelf_products_grid_week": ["stock_qty"],
    "position_join": ["capacity"],
    "fill_pct": ["capacity"],
    "inventory_by_shelf": ["capacity"],
    "shelf_detail": ["capacity", "active_flag"],
    "layout_left_assortment": ["active_flag"],
}

_STORES = "(values (1), (2), (3)) st(store_id)"


def _positions(shift: int, inactive: int) -> str:
    key = f"(p_partkey + {shift})"
    return f"""
select cast(st.store_id as int) store_id, cast(p_partkey as varchar) product_id,
  cast({key} // 45 + 1 as int) shelf_id, cast(({key} % 45) // 9 + 1 as int) shelf_level,
  case ({key} % 9) // 3 when 0 then 'left' when 1 then 'center' else 'right' end as zone,
  cast({key} % 3 + 1 as int) slot_number,
  case when p_partkey % 41 <> 0 then p_partkey % {inactive} <> 0 end active_flag
from part cross join {_STORES} where p_partkey % 10 <> 0"""


def _pairs(rules: list[tuple]) -> str:
    return ", ".join(f"('{c}', '{r}', {lo}, {hi})" for c, r, lo, hi in rules)


CTES = {
    "products": """
select cast(p_partkey as varchar) product_id, p_name product_description,
  case when p_partkey % 97 <> 0 then p_type end category_level_1,
  split_part(p_name, ' ', 1) category_level_2, split_part(p_name, ' ', 2) category_level_3,
  cast(case p_size % 3 when 0 then 4 when 1 then 10 else 22 end as decimal(5,2)) vat_rate,
  case when p_size % 4 = 0 then 'KG' else 'PZ' end unit_of_measure,
  cast(cast(p_retailprice as decimal(12,2)) * cast(0.6 as decimal(2,1)) as decimal(12,4)) purchase_price,
  cast(p_retailprice as decimal(12,4)) sale_price,
  case when p_partkey % 11 <> 0 then 'B' || substr(p_brand, 7) || '-' || p_type end brand_code
from part""",
    "brands": """
select distinct 'B' || substr(p_brand, 7) || '-' || p_type brand_code, upper(p_type || ' ' || p_brand) brand_name
from part where p_type <> 'PROMO'""",
    "store_assortment": _positions(0, 7),
    "past_assortment": _positions(100, 5),
    "store_layout": f"""
select cast(st.store_id as int) store_id, cast(s.i as int) shelf_id, cast(l.i as int) shelf_level, z.zone,
  cast(n.i as int) slot_number, case when s.i % 2 = 0 then 'C' || (s.i % 6) end shelf_category,
  case when s.i % 5 = 0 then 0 when s.i % 7 = 0 then null else cast(l.i * 3 as int) end capacity
from {_STORES}
cross join (select unnest(generate_series(1, (select max(p_partkey) // 45 + 1 from part))) i) s
cross join (values (1), (2), (3), (4), (5)) l(i)
cross join (values ('left'), ('center'), ('right')) z(zone)
cross join (values (1), (2), (3)) n(i)""",
    "inventory": f"""
select cast(st.store_id as int) store_id, cast(p_partkey as varchar) product_id,
  cast((p_partkey * 17 + st.store_id * 5) % 60 - 10 as int) stock_qty, timestamp '2024-01-01' updated_at
from part cross join {_STORES} where p_partkey % 13 <> 0""",
    "suppliers": """
select cast(s_suppkey as varchar) supplier_id, s_name supplier_name,
  case when s_suppkey = 0 then 'primary' else 'secondary' end supplier_type
from supplier""",
    "product_suppliers": """
select cast(p_partkey as varchar) product_id, '0' supplier_id, true is_primary_supplier
from part where p_partkey % 23 <> 0 and (p_partkey % 10 < 7 or p_partkey % 10 = 9)
union all
select cast(p_partkey as varchar), cast(p_partkey % 9 + 1 as varchar), false
from part where p_partkey % 23 <> 0 and p_partkey % 10 >= 7""",
    "products_specifications": """
select cast(p_partkey as varchar) product_id,
  case p_size % 3 when 0 then 'high' when 1 then 'medium' else 'low' end rotation_class,
  cast(p_size * 0.0021 as decimal(6,5)) spoilage_probability, cast(p_size * 2 as int) initial_stock,
  cast(p_size % 20 + 5 as int) minimum_stock_threshold, cast(p_size as int) reorder_lot,
  p_partkey % 10 <> 0 assortment_flag
from part""",
    "lines": """
select cast(l_orderkey % 3 + 1 as int) store_id,
  case when l_orderkey % 53 = 0 then 'UNKNOWN' else cast(l_partkey as varchar) end product_id,
  case when l_returnflag = 'A' then cast(l_suppkey as varchar) end supplier_id,
  case l_returnflag when 'R' then 'breakage' when 'A' then 'purchase' else 'sale' end movement_type,
  cast(l_quantity as int) quantity,
  case when l_returnflag = 'N' then cast(cast(p_retailprice as decimal(12,2))
    * (1 - cast(l_discount as decimal(4,2))) as decimal(12,4)) end unit_sale_price,
  case when l_returnflag = 'A' then cast(cast(p_retailprice as decimal(12,2))
    * cast(0.6 as decimal(2,1)) as decimal(12,4)) end unit_purchase_price,
  l_linenumber = 1 is_promo, cast(l_shipdate as date) movement_date
from lineitem join part on p_partkey = l_partkey""",
    "movements": """
select l.*, p.shelf_id, p.shelf_level, p.zone, p.slot_number
from lines l left join past_assortment p
  on p.store_id = l.store_id and p.product_id = l.product_id and p.active_flag""",
    "raw_movements": """
select event_id raw_movement_id, 'movements_' || cast(cast(ts as date) as varchar) || '.csv' source_file_name,
  'simulated_api' source_system, cast(user_id % 3 + 1 as int) store_id,
  case when event_id % 53 = 0 then 'UNKNOWN' else cast((event_id * 7919) % 200 as varchar) end product_id,
  case when event_type <> 'purchase' or event_id % 31 = 0 then null when event_id % 37 = 0 then '-1'
    else cast(event_id % 10 as varchar) end supplier_id,
  case event_type when 'purchase' then 'purchase' when 'error' then 'breakage' else 'sale' end movement_type,
  cast(event_id % 9 + 1 as int) quantity,
  case when event_type = 'purchase' or event_id % 41 = 0 then null
    when event_type = 'error' and event_id % 47 <> 0 then null
    when event_id % 43 = 0 then cast(0 as decimal(12,4)) else cast(value as decimal(12,4)) end unit_sale_price,
  case when event_type = 'purchase' and event_id % 29 <> 0 then cast(value as decimal(12,4)) end unit_purchase_price,
  event_id % 7 = 0 is_promo,
  case when event_id % 7 = 0 then case event_id % 3 when 0 then 'sconto_percentuale' when 1 then 'offerta_3x2'
    else 'prezzo_speciale' end end promo_type,
  ts movement_timestamp, cast(ts as date) movement_date
from events""",
    "validated": """
select r.*, case
    when p.product_id is null then 'unknown_product'
    when r.supplier_id is not null and s.supplier_id is null then 'unknown_supplier'
    when r.movement_type = 'sale' and (r.unit_sale_price is null or r.unit_sale_price <= 0) then 'missing_sale_price'
    when r.movement_type = 'purchase' and (r.unit_purchase_price is null or r.unit_purchase_price <= 0)
      then 'missing_purchase_price'
    when r.movement_type = 'breakage' and (r.unit_sale_price is not null or r.unit_purchase_price is not null)
      then 'breakage_with_price'
    when r.movement_type = 'purchase' and r.supplier_id is null then 'purchase_without_supplier' end error_reason
from raw_movements r left join products p on p.product_id = r.product_id
  left join suppliers s on s.supplier_id = r.supplier_id""",
    "cleaned_movements": """
select raw_movement_id cleaned_movement_id, * exclude (error_reason), raw_movement_id % 4 = 0 loaded,
  case when raw_movement_id % 4 = 0 then timestamp '2024-02-01' end loaded_at
from validated where error_reason is null""",
    "price_rows": """
select p_partkey id_prodotto, upper(p_name) || '  ' || p_type descrizione,
  case when p_partkey % 97 <> 0 then p_type end cat1, split_part(p_name, ' ', 1) cat2, split_part(p_name, ' ', 2) cat3,
  case when p_size % 17 = 0 then '++' when p_size % 3 = 0 then '4' when p_size % 3 = 1 then '10' else '22' end iva,
  cast(p_size as int) pzxcar, case when p_size % 4 = 0 then 'KG' else 'PZ' end um,
  cast(case when p_partkey % 3 = 0 then 7 else 0 end as int) brand,
  cast(p_size * 1000 - 10000 as bigint) costo_units, cast(p_size * 1000 as bigint) prezzo_units
from part""",
    # ---- results other queries build on ------------------------------------------------------
    "active": "select * from store_assortment where active_flag",
    "daily": """
with valued as (
  select store_id, movement_date, movement_type kind, quantity q, quantity * unit_sale_price sold,
    quantity * unit_purchase_price bought, quantity * purchase_price worth
  from movements join products using (product_id)),
per_kind as (
  select store_id, movement_date, kind, count(*) n, sum(q) q, sum(sold) sold, sum(bought) bought, sum(worth) worth
  from valued group by all)
select store_id, movement_date, strftime(movement_date, '%Y-%m') as month, cast(year(movement_date) as int) as year,
  cast(weekofyear(movement_date) as int) as week,
  coalesce(max(n) filter (kind = 'sale'), 0) sale_transactions, coalesce(max(q) filter (kind = 'sale'), 0) qty_sold,
  coalesce(max(sold) filter (kind = 'sale'), 0) revenue, coalesce(max(worth) filter (kind = 'sale'), 0) cogs,
  coalesce(max(n) filter (kind = 'breakage'), 0) breakage_events,
  coalesce(max(q) filter (kind = 'breakage'), 0) qty_breakage,
  coalesce(max(worth) filter (kind = 'breakage'), 0) breakage_cost,
  coalesce(max(n) filter (kind = 'purchase'), 0) purchase_transactions,
  coalesce(max(q) filter (kind = 'purchase'), 0) qty_purchased,
  coalesce(max(bought) filter (kind = 'purchase'), 0) purchase_cost, cast(sum(n) as bigint) total_movements
from per_kind group by store_id, movement_date""",
    "day_sums": """
select store_id, product_id, shelf_id, movement_date, movement_type kind, count(*) n, sum(quantity) pieces,
  sum(quantity * unit_sale_price) sold
from movements group by all""",
    "labelled": "select products.*, brand_name from products left join brands using (brand_code)",
    "shelf_moves": """
select store_id, place.shelf_id, place.shelf_level, place.zone, place.slot_number, product_id, product_description,
  category_level_1, category_level_2, brand_code, brand_name, movement_type, quantity, unit_sale_price,
  unit_purchase_price, purchase_price as unit_cost, is_promo, movement_date
from active place join movements using (store_id, product_id) join labelled using (product_id)""",
    "details": """
select store_id, shelf_id, shelf_category, shelf_level, zone, slot_number, capacity, product_id, active_flag,
  product_description, category_level_1, category_level_2, brand_code, brand_name
from store_layout left join store_assortment using (store_id, shelf_id, shelf_level, zone, slot_number)
  left join labelled using (product_id)""",
    "stock_positions": """
select store_id, shelf_id, shelf_level, zone, slot_number, product_id, product_description, category_level_1, stock_qty,
  capacity
from store_layout join active using (store_id, shelf_id, shelf_level, zone, slot_number)
  join inventory using (store_id, product_id) join products using (product_id)""",
    "delta": """
select store_id, product_id, sum(case when movement_type = 'purchase' then quantity else -quantity end) net_qty
from lines group by store_id, product_id""",
    "candidates": """
select p.*, s.rotation_class from products p join products_specifications s using (product_id) where s.assortment_flag""",
    "categories": """
select category_level_1, count(*) n_products from candidates where category_level_1 is not null group by 1""",
    "allocation": """
select category_level_1, n_products, n + case when row_number() over (order by n_products desc, category_level_1) = 1
    then 45 - sum(n) over () else 0 end n_shelves
from (select *, cast(round_even(n_products / sum(n_products) over () * 45, 0) as int) n from categories)""",
    "spellings": "select * from (values "
    + ", ".join(f"({n}, '{s}', '{c}')" for n, (s, c) in enumerate(SPELLINGS))
    + ") v(n, spelling, code)",
    "branded": r"""
select r.*, lower(descrizione) low, (select arg_min(code, n) from spellings
    where regexp_matches(lower(descrizione), '\b' || spelling || '\b')) brand_anon,
  trim(regexp_replace(regexp_replace(lower(descrizione), '\b(ALIASES)\b', '', 'g'), '\s+', ' ', 'g')) descrizione_clean
from price_rows r""".replace("ALIASES", "|".join(s for s, _ in SPELLINGS)),
    # prices in units of 0.0001; the step is a whole number of tenths
    "noisy": """
select *, costo_units + 1000 * step costo_noisy, prezzo_units + 1000 * step prezzo_noisy
from (select *, ([-8,-7,-6,-5,-4,-3,-2,2,3,4,5,6,7,8])[
  cast(('0x' || substr(md5('42' || id_prodotto), 1, 8)) as bigint) % 14 + 1] step from branded where brand = 0)""",
    "sampled": """
select * exclude (k, n) from (select *, row_number() over (partition by cat1 order by md5('42' || id_prodotto)) k,
    count(*) over (partition by cat1) n from noisy where brand_anon is null) x
  join (values SHARES) s(cat, share) on s.cat = x.cat1 where k <= round_even(share * n, 0)""".replace(
        "SHARES", ", ".join(f"('{k}', {v})" for k, v in SHARES.items())
    ),
    "master": """
select id_prodotto, descrizione_clean, cat1, cat2, cat3, iva, pzxcar, um, brand_anon, costo_noisy, prezzo_noisy
from noisy where brand_anon is not null
union all select id_prodotto, descrizione_clean, cat1, cat2, cat3, iva, pzxcar, um, brand_anon, costo_noisy, prezzo_noisy
from sampled""",
    "rules1": f"select * from (values {_pairs(CLASS_RULES[0])}) v(c, r, lo, hi)",
    "rules2": f"select * from (values {_pairs(CLASS_RULES[1])}) v(c, r, lo, hi)",
    "rules3": f"select * from (values {_pairs(CLASS_RULES[2])}) v(c, r, lo, hi)",
}

CALENDAR = (
    "strftime(movement_date, '%Y-%m') as month, cast(year(movement_date) as int) as year, "
    "cast(weekofyear(movement_date) as int) as week"
)
DAY = "cast(movement_date as varchar) as movement_date"


def moment(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def dbl(expr: str, name: str) -> str:
    return f"cast(cast({expr} as decimal(38,4)) as double) as {name}"


def big(expr: str, name: str) -> str:
    return f"cast({expr} as bigint) as {name}"


def half_up(num: str, den: str, digits: int) -> str:
    """num / den rounded half-up in whole numbers; both have at most four digits."""
    n, d = (f"cast(cast({x} as decimal(38,4)) * 10000 as hugeint)" for x in (num, den))
    scale = 10**digits
    whole = f"(2 * abs({n}) * {scale} + abs({d})) // (2 * abs({d}))"
    return f"case when {d} <> 0 then sign({n}) * sign({d}) * cast({whole} as double) / {scale} end"


def margin(rev: str, cost: str) -> str:
    return f"case when {rev} = 0 then 0.0 else {half_up(f'(({rev}) - ({cost})) * 100', rev, 2)} end as margin_pct"


def fill(stock: str, cap: str) -> str:
    return f"case when {cap} = 0 then 0.0 else {half_up(f'{stock} * 100', cap, 1)} end as fill_pct"


def _needed(body: str) -> list[str]:
    """Names of the CTEs a query uses, in the order they are declared."""
    import re

    text, found = body, set()
    while True:
        more = {n for n in CTES if n not in found and re.search(rf"\b{n}\b", text)}
        if not more:
            return [n for n in CTES if n in found]
        found |= more
        text = " ".join(CTES[n] for n in more)


def query(body: str) -> str:
    names = _needed(body)
    return "with " + ", ".join(f"{n} as ({CTES[n].strip()})" for n in names) + " " + body if names else body


MOVEMENT_FIELDS = (
    "store_id, product_id, supplier_id, movement_type, quantity, cast(unit_sale_price as double) unit_sale_price, "
    "cast(unit_purchase_price as double) unit_purchase_price, is_promo, promo_type, "
    f"{moment('movement_timestamp')} movement_timestamp, {DAY}"
)
SOURCE_FIELDS = "source_file_name, source_system"
RAW_FIELDS = f"raw_movement_id, {SOURCE_FIELDS}, {MOVEMENT_FIELDS}"
LINE_FIELDS = f"store_id, product_id, movement_type, quantity, {DAY}"
SLOT = "store_id, shelf_id, shelf_level, zone, slot_number"
CUT = "'movements_2024-01-15.csv'"

_REASONS = {
    "unknown_product": "product_id not in (select product_id from products)",
    "unknown_supplier": "supplier_id is not null and supplier_id not in (select supplier_id from suppliers)",
    "missing_sale_price": "movement_type = 'sale' and (unit_sale_price is null or unit_sale_price <= 0)",
    "missing_purchase_price": "movement_type = 'purchase' and (unit_purchase_price is null or unit_purchase_price <= 0)",
    "breakage_with_price": "movement_type = 'breakage' and (unit_sale_price is not null or unit_purchase_price is not null)",
    "purchase_without_supplier": "movement_type = 'purchase' and supplier_id is null",
}
_DETAILS = "case error_reason " + " ".join(
    f"when '{r}' then '{d.replace(chr(39), chr(39) * 2)}'" for r, d in fixed.RULE_TEXTS.items()
) + " end error_details"

_SHELF_SALES = f"{big('sum(n)', 'transaction_count')}, {big('sum(pieces)', 'qty_sold')}, {dbl('sum(sold)', 'revenue')}"
_SHELF_BREAKS = (
    f"{big('sum(n)', 'breakage_events')}, {big('sum(pieces)', 'qty_lost')}, "
    f"{dbl('sum(pieces * purchase_price)', 'breakage_cost')}"
)


_REV, _COST = "sum(quantity * unit_sale_price)", "sum(quantity * purchase_price)"


def _per_shelf(kind: str, measures: str, when: str) -> str:
    """Sums per product and day of one kind, on the shelf of ``then`` or ``now``, added up by shelf."""
    then = "(select * from day_sums where shelf_id is not null)"
    now = "(select * exclude (shelf_id) from day_sums) join (select store_id, product_id, shelf_id from active) using (store_id, product_id)"
    priced = " join labelled using (product_id)" if kind == "breakage" else ""
    return f"""select store_id, shelf_id, {DAY}, {CALENDAR}, {measures}
from {then if when == "then" else now}{priced} where kind = '{kind}' group by store_id, shelf_id, movement_date"""


_DAILY = f"""{big('qty_sold', 'qty_sold')}, {dbl('revenue', 'revenue')}, {dbl('cogs', 'cogs')},
  breakage_events, {big('qty_breakage', 'qty_breakage')}, {dbl('breakage_cost', 'breakage_cost')}, purchase_transactions,
  {big('qty_purchased', 'qty_purchased')}, {dbl('purchase_cost', 'purchase_cost')}, total_movements"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _of_list(values: list[str], step: int) -> str:
    listed = ", ".join(map(_text, values))
    return f"([{listed}])[(p_partkey * {step}) % {len(values) + 1} + 1]"


def _default_brands() -> str:
    """The first of the default spellings that stands between signs that are no letters, digits or ``_``."""
    spellings = fixed.brand_spellings()
    names = [s for s, _ in spellings]
    rows = ", ".join(f"({n}, {_text(s)}, '{c}')" for n, (s, c) in enumerate(spellings))
    first, second = _of_list(names, 1), _of_list(names, 7)
    return rf"""with parts as (
  select cast(p_partkey as varchar) product_id, lower(concat_ws(' ', split_part(p_name, ' ', 1),
    case when p_partkey % 2 = 0 then upper({first}) else {first} end, split_part(p_name, ' ', 2),
    case when p_partkey % 3 = 0 then {second} end, '500 g')) low
  from part)
select product_id, (select arg_min(code, n) from (values {rows}) v(n, spelling, code)
  where case when contains(low, spelling) then regexp_matches(low, '(^|[^\pL\pN_])' || regexp_escape(spelling) || '($|[^\pL\pN_])') else false end) brand_anon from parts"""


def _default_classes() -> str:
    tables = [fixed.CATEGORY_1_RULES, fixed.CATEGORY_2_RULES, fixed.CATEGORY_3_RULES]
    columns = ", ".join(f"{_of_list([r[0] for r in t], s)} c{n}" for n, (t, s) in enumerate(zip(tables, (1, 3, 5)), 1))
    values = [", ".join(f"({_text(c)}, '{r}', {lo}, {hi})" for c, r, lo, hi in t) for t in tables]
    joins = " ".join(f"left join (values {v}) r{n}(c, r, lo, hi) on r{n}.c = c{n}" for n, v in enumerate(values, 1))
    rotation, low, high = fixed.DEFAULT_RULE
    return f"""select product_id, coalesce(r3.r, r2.r, r1.r, '{rotation}') rotation_class,
  cast(coalesce(r3.lo, r2.lo, r1.lo, {low}) as double) spoilage_min, cast(coalesce(r3.hi, r2.hi, r1.hi, {high}) as double) spoilage_max
from (select cast(p_partkey as varchar) product_id, {columns} from part) p {joins}"""


def _trend(period: str) -> str:
    return f"""select {period} as period, {dbl('sum(revenue)', 'revenue')}, {dbl('sum(cogs)', 'cogs')},
  {big('sum(qty_purchased)', 'qty_purchased')}, {big('sum(qty_sold)', 'qty_sold')},
  {half_up('sum(revenue)', 'sum(cogs)', 4)} as revenue_cost_ratio from daily group by 1"""


def _level(keys: str) -> str:
    rev = "sum(quantity * unit_sale_price)"
    return f"""select {keys}, {big('sum(quantity)', 'qty_sold')}, {dbl(rev, 'revenue')},
  {half_up(rev, 'sum(quantity)', 4)} as avg_price, {dbl(f'{rev} - sum(quantity * unit_cost)', 'margin')}
from shelf_moves where movement_type = 'sale' group by {keys}"""


def _shelf_share(item: str) -> str:
    return f"""select store_id, shelf_id, {item}, slots,
  {half_up('slots * 100', 'sum(slots) over (partition by store_id, shelf_id)', 2)} as shelf_share_pct
from (select store_id, shelf_id, {item}, count(*) slots from details where product_id is not null group by all)"""


def _sales_share(item: str) -> str:
    whole = "sum(revenue) over (partition by store_id, shelf_id)"
    return f"""select store_id, shelf_id, {item}, slots, shelf_share_pct, {dbl('revenue', 'revenue')},
  {half_up('revenue * 100', whole, 2)} as sales_share_pct from (
select sp.*, coalesce(sa.revenue, 0) revenue from ({_shelf_share(item)}) sp left join (
  select store_id, shelf_id, {item}, sum(quantity * unit_sale_price) revenue from shelf_moves
  where movement_type = 'sale' group by all) sa
  on sa.store_id = sp.store_id and sa.shelf_id = sp.shelf_id and sa.{item} is not distinct from sp.{item})"""


def _duplicates(constraints: list[tuple[str, str]]) -> str:
    parts = [
        f"select '{t}' table_name, concat_ws('|', {keys}) as key, count(*) as rows from {t} "
        f"where concat_ws('|', {keys}) <> '' group by {keys} having count(*) > 1"
        for t, keys in constraints
    ]
    return " union all ".join(parts)


def _orphans(keys: list[tuple[str, str, str]]) -> str:
    parts = [
        f"select '{t}' table_name, '{ref}' referenced, concat_ws('|', {cols}) as key, count(*) as rows from {t} x "
        f"where concat_ws('|', {cols}) is not null and ({' and '.join(c.strip() + ' is not null' for c in cols.split(','))}) "
        f"and not exists (select 1 from {ref} r where "
        + " and ".join(f"r.{c.strip()} = x.{c.strip()}" for c in cols.split(","))
        + f") group by {cols}"
        for t, cols, ref in keys
    ]
    return " union all ".join(parts)


def _violations(checks: list[tuple[str, str, str]]) -> str:
    return " union all ".join(
        f"select '{t}' table_name, '{rule}' as rule, count(*) filter (not ({check})) as rows from {t}"
        for t, rule, check in checks
    )


def sql() -> dict[str, str]:
    slot = SLOT
    # constraints as declared, written out here and not read from the code under test
    primary = [
        ("products", "product_id"), ("brands", "brand_code"), ("store_layout", slot),
        ("store_assortment", "store_id, product_id"), ("inventory", "store_id, product_id"),
        ("suppliers", "supplier_id"), ("product_suppliers", "product_id, supplier_id"),
        ("products_specifications", "product_id"), ("raw_movements", "raw_movement_id"),
        ("cleaned_movements", "cleaned_movement_id"),
    ]
    foreign = [("store_assortment", "product_id", "products"), ("store_assortment", slot, "store_layout"),
               ("inventory", "product_id", "products"), ("product_suppliers", "product_id", "products"),
               ("product_suppliers", "supplier_id", "suppliers"), ("products_specifications", "product_id", "products"),
               ("cleaned_movements", "product_id", "products"), ("cleaned_movements", "supplier_id", "suppliers"),
               ("cleaned_movements", "raw_movement_id", "raw_movements"),
               ("movements", "product_id", "products"), ("movements", "supplier_id", "suppliers")]
    kinds = "movement_type in ('sale', 'purchase', 'breakage')"
    domains = [
        ("store_layout", "shelf_level", "shelf_level >= 1 and shelf_level <= 5"),
        ("store_layout", "zone", "zone in ('left', 'center', 'right')"),
        ("store_layout", "slot_number", "slot_number >= 1 and slot_number <= 3"),
        ("store_layout", "capacity", "capacity > 0"),
        ("inventory", "stock_qty", "stock_qty >= 0"),
        ("suppliers", "supplier_type", "supplier_type in ('primary', 'secondary')"),
        *[(t, rule, check) for t in ("raw_movements", "cleaned_movements", "movements")
          for rule, check in (("movement_type", kinds), ("quantity", "quantity > 0"))],
        ("products_specifications", "rotation_class", "rotation_class in ('high', 'medium', 'low')"),
        ("products_specifications", "spoilage_probability", "spoilage_probability between 0 and 1"),
        ("products_specifications", "initial_stock", "initial_stock >= 0"),
        ("products_specifications", "minimum_stock_threshold", "minimum_stock_threshold >= 0"),
        ("products_specifications", "reorder_lot", "reorder_lot >= 0"),
    ]
    price_rules = [
        (t, rule, check) for t in ("raw_movements", "movements") for rule, check in (
            ("sale_price", "movement_type <> 'sale' or (unit_sale_price is not null and unit_sale_price > 0)"),
            ("purchase_price",
             "movement_type <> 'purchase' or (unit_purchase_price is not null and unit_purchase_price > 0)"),
            ("breakage_prices",
             "movement_type <> 'breakage' or (unit_sale_price is null and unit_purchase_price is null)"),
        )
    ]
    moved = ["store_id", "product_id", "movement_type", "quantity", "is_promo", "movement_date"]
    file_row = ["raw_movement_id", "source_file_name", "source_system", *moved, "movement_timestamp"]
    required = {
        "products": ["product_id", "product_description"],
        "store_layout": ["store_id", "shelf_id", "shelf_level", "zone", "slot_number"],
        "store_assortment": ["store_id", "product_id", "shelf_id", "shelf_level", "zone", "slot_number"],
        "inventory": ["store_id", "product_id", "stock_qty"],
        "suppliers": ["supplier_id", "supplier_name", "supplier_type"],
        "product_suppliers": ["product_id", "supplier_id", "is_primary_supplier"],
        "products_specifications": ["product_id", "rotation_class", "spoilage_probability", "initial_stock",
                                    "minimum_stock_threshold", "reorder_lot"],
        "raw_movements": file_row,
        "cleaned_movements": ["cleaned_movement_id", *file_row, "loaded"],
        "movements": moved,
    }
    not_null = [(t, c, f"{c} is not null") for t, columns in required.items() for c in columns]
    longest = {
        "products": "product_id 50, category_level_1 100, category_level_2 100, category_level_3 100, "
                    "unit_of_measure 20, brand_code 20",
        "store_layout": "shelf_category 100, zone 10",
        "store_assortment": "product_id 50, zone 10",
        "inventory": "product_id 50",
        "suppliers": "supplier_id 20, supplier_name 100, supplier_type 20",
        "product_suppliers": "product_id 50, supplier_id 20",
        "products_specifications": "product_id 50, rotation_class 20",
        "raw_movements": "source_file_name 255, source_system 50, product_id 50, supplier_id 20, movement_type 20, "
                         "promo_type 50",
        "cleaned_movements": "source_file_name 255, source_system 50, product_id 50, supplier_id 20, "
                             "movement_type 20, promo_type 50",
        "movements": "product_id 50, supplier_id 20, movement_type 20, zone 10",
    }
    lengths = [
        (t, c, f"length({c}) <= {n}") for t, text in longest.items() for c, n in (x.split(" ") for x in text.split(", "))
    ]
    found: dict[str, str] = {
        # ---- sources and sinks --------------------------------------------------------------
        "source_files": "select distinct source_file_name file_name from raw_movements",
        "stored_tables": "select 'brands' table_name, count(*) as rows from brands union all select 'products', count(*) from products",
        "append_rows": "select brand_code, brand_name from brands union all select brand_code, brand_name from brands",
        "full_refresh": "select brand_code, brand_name from brands where brand_code > 'B2'",
        "overwrite_partitions": "select product_id, category_level_1, case when category_level_1 = 'PROMO' then 'new' else unit_of_measure end unit_of_measure from products where category_level_1 is not null",
        "replace_table": "select brand_code, cast(null as varchar) brand_name from brands",
        "load_once": "select brand_code, brand_name from brands",
        "write_csv": """select id_prodotto, 'He said "' || descrizione || '"; ' || chr(10) || 'done' descrizione
from (select cast(id_prodotto as varchar) id_prodotto, descrizione from price_rows)""",
        "run_steps": """select 'extract' pipeline_step, count(*) runs, cast(sum(n) as bigint) rows_processed
  from (select source_file_name, count(*) n from raw_movements group by all)
union all select 'load', 1, count(*) from validated where error_reason is null
union all select 'transform', count(*), cast(sum(n) as bigint) from (select source_file_name, count(*) n from raw_movements group by all)""",
        "raw_ingest": f"select {SOURCE_FIELDS}, {MOVEMENT_FIELDS} from raw_movements",
        "products_master": """select product_id, product_description, category_level_1, category_level_2,
  category_level_3, cast(vat_rate as double) vat_rate, unit_of_measure, cast(purchase_price as double) purchase_price,
  cast(sale_price as double) sale_price, brand_code from products""",
        "price_list": """select cast(id_prodotto as varchar) id_prodotto, descrizione, cat1, cat2, cat3, iva, pzxcar,
  um, brand, costo_units / 10000 costo, prezzo_units / 10000 prezzo_vendita from price_rows""",
        "raw_for_file": f"select {RAW_FIELDS} from raw_movements where source_file_name = {CUT}",
        "unloaded_movements": f"select cleaned_movement_id, {RAW_FIELDS} from cleaned_movements where not loaded",
        "brands_csv": "select brand_code, brand_name from brands",
        "brands_upsert": """select coalesce(n.brand_code, b.brand_code) brand_code,
  coalesce(n.brand_name, b.brand_name) brand_name
from brands b full join (select brand_code, 'New ' || min(p_type) brand_name
    from (select 'B' || substr(p_brand, 7) || '-' || p_type brand_code, p_type from part
      where p_type in ('PROMO', 'SMALL')) group by brand_code) n on n.brand_code = b.brand_code""",
        "mark_file_processed": "select distinct source_file_name file_name, source_system from raw_movements",
        "inventory_apply": """select i.store_id, i.product_id, cast(i.stock_qty + coalesce(d.net_qty, 0) as int) stock_qty
from inventory i left join delta d on d.store_id = i.store_id and d.product_id = i.product_id""",
        "mark_loaded": f"""select cleaned_movement_id, loaded or raw_movement_id % 5 = 1 loaded,
  {moment("case when raw_movement_id % 5 = 1 then timestamp '2024-03-01' else loaded_at end")} loaded_at
from cleaned_movements""",
        "touch_updated_at": f"""select i.store_id, i.product_id,
  {moment("case when d.net_qty is not null then timestamp '2024-03-01' else i.updated_at end")} updated_at
from inventory i left join delta d on d.store_id = i.store_id and d.product_id = i.product_id""",
        # ---- projections, filters, rules ----------------------------------------------------
        **{
            f"validate_{rule}": f"select raw_movement_id, product_id, supplier_id, movement_type from raw_movements where {c}"
            for rule, c in _REASONS.items()
        },
        "validate_split": f"select raw_movement_id, error_reason, {_DETAILS} from validated",
        "cleaned_projection": f"select {RAW_FIELDS} from validated where error_reason is null",
        "bad_projection": f"""select {RAW_FIELDS}, error_reason, {_DETAILS}, false reviewed, false corrected
from validated where error_reason is not null""",
        "movements_projection": f"""select {RAW_FIELDS.replace('store_id', 'c.store_id').replace('product_id', 'c.product_id')},
  a.shelf_id, a.shelf_level, a.zone, a.slot_number from cleaned_movements c
  left join active a on a.store_id = c.store_id and a.product_id = c.product_id""",
        "movement_type_filter": f"select {LINE_FIELDS} from lines where movement_type in ('sale', 'breakage')",
        "shelf_not_null": f"select {LINE_FIELDS}, shelf_id from movements where shelf_id is not null",
        "active_assortment": f"select product_id, {SLOT} from active",
        "assortment_candidates": "select product_id, category_level_1, rotation_class from candidates",
        "category_exclude": """select id_prodotto, cat1, iva from price_rows
where brand = 0 and coalesce(cat1 not in ('LARGE', 'PROMO'), true) and iva <> '++'""",
        "positive_prices": """select id_prodotto, costo_noisy / 10000 costo, prezzo_noisy / 10000 prezzo_vendita from noisy
where costo_noisy > 0 and prezzo_noisy > 0""",
        "dashboard_filter": f"""select store_id, shelf_id, {DAY}, {big('count(*)', 'transaction_count')} from movements
where movement_type = 'sale' and shelf_id = 3 and year(movement_date) = 1998 and month(movement_date) = 3
group by store_id, shelf_id, movement_date""",
        # ---- joins --------------------------------------------------------------------------
        "new_files": f"select distinct source_file_name file_name from raw_movements where source_file_name >= {CUT}",
        "valid_keys": """select p.product_id is not null known_product, s.supplier_id is not null known_supplier,
  count(*) as rows from raw_movements r left join products p on p.product_id = r.product_id
  left join suppliers s on s.supplier_id = r.supplier_id group by 1, 2""",
        "enrich_shelf_position": f"select {LINE_FIELDS}, shelf_id, shelf_level, zone, slot_number from movements",
        "movements_products": f"""select {LINE_FIELDS.replace('product_id', 'm.product_id')}, p.product_description,
  cast(p.purchase_price as double) purchase_price from lines m join products p on p.product_id = m.product_id""",
        "movements_current_position": f"""select {LINE_FIELDS.replace('store_id', 'm.store_id').replace('product_id', 'm.product_id')},
  a.shelf_id, a.zone from lines m join active a on a.store_id = m.store_id and a.product_id = m.product_id""",
        "position_join": f"""select a.product_id, {SLOT}, capacity from store_assortment a
  join store_layout l using ({SLOT})""",
        "layout_left_assortment": f"select {SLOT}, product_id, active_flag, product_description from details",
        "brand_left_join": """select product_id, p.brand_code, brand_name from products p
  left join brands b on b.brand_code = p.brand_code""",
        "stock_join": f"""select {SLOT.replace('store_id', 'a.store_id')}, a.product_id, stock_qty from active a
  join inventory i on i.store_id = a.store_id and i.product_id = a.product_id""",
        "layout_grid": f"select {SLOT}, cast(null as varchar) shelf_category, cast(1 as int) capacity from store_layout",
        # ---- aggregations -------------------------------------------------------------------
        "net_stock_delta": f"select store_id, product_id, {big('net_qty', 'net_qty')} from delta",
        "conditional_counts": """select store_id, count(*) filter (movement_type = 'sale') sales,
  count(*) filter (movement_type = 'breakage') breakages, count(*) filter (movement_type = 'purchase') purchases
from lines group by store_id""",
        "conditional_sums": f"""select store_id, movement_type, {big("coalesce(sum(quantity) filter (movement_type = 'sale'), 0)", 'qty_sold')},
  {dbl("coalesce(sum(quantity * unit_purchase_price) filter (movement_type = 'purchase'), 0)", 'purchase_cost')}
from lines group by store_id, movement_type""",
        "sum_product": f"select store_id, product_id, {dbl(_REV, 'revenue')} from lines group by store_id, product_id",
        "margin_pct": f"""select m.store_id, m.product_id, {dbl(_REV, 'revenue')}, {dbl(_COST, 'cost')}, {margin(_REV, _COST)}
from lines m join products p on p.product_id = m.product_id where movement_type = 'sale' group by m.store_id, m.product_id""",
        "fill_pct": f"""select i.store_id, i.product_id, l.capacity, {fill('i.stock_qty', 'l.capacity')}
from inventory i join store_assortment a on a.store_id = i.store_id and a.product_id = i.product_id
  join store_layout l on l.store_id = a.store_id and l.shelf_id = a.shelf_id and l.shelf_level = a.shelf_level
    and l.zone = a.zone and l.slot_number = a.slot_number""",
        "category_counts": "select * from categories",
        "shelf_allocation": "select category_level_1, n_products, cast(n_shelves as int) n_shelves from allocation",
        "table_row_count": "select count(*) row_count from lines",
        "unique_products": "select count(distinct product_id) unique_products from store_assortment",
        "validation_counts": """select source_file_name, count(*) rows_processed,
  count(*) filter (error_reason is null) rows_success, count(*) filter (error_reason is not null) rows_failed
from validated group by source_file_name""",
        # ---- ranks --------------------------------------------------------------------------
        "shelf_category_map": """select cast(unnest(generate_series(f + 1, cast(f + n_shelves as bigint))) as int) shelf_id,
  category_level_1 shelf_category from (select *, coalesce(sum(n_shelves) over (order by n_products desc, category_level_1
    rows between unbounded preceding and 1 preceding), 0)::bigint f from allocation where n_shelves > 0)""",
        "brand_names": """select brand_code, case when i < 145 then name else name || ' ' || (i // 145 + 2) end brand_name
from (select brand_code, row_number() over (order by brand_code) - 1 i
    from (select distinct brand_code from products where brand_code is not null)) c
  join (values NAMES) n(k, name) on n.k = i % 145""".replace(
            "NAMES",
            ", ".join(f"({k}, '{n.replace(chr(39), chr(39) * 2)}')" for k, n in enumerate(fixed.BRAND_NAMES)),
        ),
        "sample_by_category": "select id_prodotto, cat1 from sampled",
        # ---- sorts, limits, sets ------------------------------------------------------------
        "files_in_order": "select distinct source_file_name file_name from raw_movements order by 1",
        "brand_head": "select brand_code, brand_name from brands order by brand_code limit 10",
        "distinct_brand_codes": "select distinct brand_code from products where brand_code is not null order by 1",
        "layout_order": f"select {SLOT} from store_layout order by shelf_id, shelf_level, zone, slot_number",
        "files_to_transform": f"""select distinct source_file_name from raw_movements except (
  select source_file_name from validated where error_reason is null and source_file_name < 'movements_2024-01-10.csv'
  union select source_file_name from validated where error_reason is not null and source_file_name < {CUT})""",
        "masterdata_concat": "select id_prodotto, cat1, brand_anon from master",
        "dedupe_products": f"""select product_id, {DAY}, store_id, quantity from (
  select *, row_number() over (partition by product_id order by movement_date, store_id, quantity) k from lines) where k = 1""",
        # ---- scalar functions ---------------------------------------------------------------
        "month_key": "select strftime(movement_date, '%Y-%m') as month, count(*) as rows from lines group by 1",
        "year_key": "select cast(year(movement_date) as int) as year, count(*) as rows from lines group by 1",
        "iso_week": """select cast(year(movement_date) as int) as year, cast(weekofyear(movement_date) as int) as week,
  count(*) as rows from lines group by 1, 2""",
        "pseudonymise_id": """select product_id,
  'COD_' || upper(substr(sha256('retail_project_2026' || product_id), 1, 10)) pseudonym from products""",
        "price_noise": "select id_prodotto, step / 10 step from noisy",
        "round_prices": """select product_id, (q + case when r > 50000 or (r = 50000 and q % 2 = 1) then 1 else 0 end) / 100 price
from (select product_id, u // 100000 q, u % 100000 r
  from (select product_id, cast(sale_price * 10000 as bigint) * 125 u from products))""",
        "normalise_description": "select id_prodotto, lower(descrizione) descrizione from price_rows",
        "extract_brand": "select id_prodotto, brand_anon from branded",
        "strip_brand": r"""select id_prodotto, regexp_replace(lower(descrizione), '\b(ALIASES)\b', '', 'g') descrizione
from price_rows""".replace("ALIASES", "|".join(s for s, _ in SPELLINGS)),
        "squeeze_spaces": r"select id_prodotto, trim(regexp_replace(descrizione, '\s+', ' ', 'g')) descrizione from price_rows",
        "brand_removed_flag": "select id_prodotto, brand_anon is not null brand_removed from branded",
        "truncate_description": "select id_prodotto, substr(descrizione, 1, 15) descrizione from price_rows",
        "rename_categories": """select id_prodotto, case cat1 when 'SMALL' then 'FRESCHI' when 'LARGE' then 'GASTRONOMIA'
  else cat1 end cat1 from price_rows""",
        "opening_stock": f"""select cast(st.store_id as int) store_id, product_id,
  case when assortment_flag then initial_stock else 0 end stock_qty
from products_specifications cross join {_STORES}""",
        "extract_brand_default": _default_brands(),
        "classify_products_default": _default_classes(),
        "classify_products": """select product_id, coalesce(r3.r, r2.r, r1.r, 'medium') rotation_class,
  cast(coalesce(r3.lo, r2.lo, r1.lo, 0.005) as double) spoilage_min,
  cast(coalesce(r3.hi, r2.hi, r1.hi, 0.02) as double) spoilage_max
from products p left join rules1 r1 on r1.c = p.category_level_1 left join rules2 r2 on r2.c = p.category_level_2
  left join rules3 r3 on r3.c = p.category_level_3""",
        "supplier_code": """select 'SUP_' || lpad(cast(s_suppkey + 1 as varchar), cast(greatest(3, length(cast(s_suppkey + 1 as varchar))) as int), '0') supplier_id,
  'Fornitore ' || chr(cast(65 + s_suppkey as int)) supplier_name,
  case when s_suppkey = 0 then 'primary' else 'secondary' end supplier_type from supplier""",
        "clamp_threshold": """select product_id, case when not assortment_flag then 0 when minimum_stock_threshold >= initial_stock
  then greatest(1, initial_stock // 3) else minimum_stock_threshold end minimum_stock_threshold from products_specifications""",
        "date_spine": f"""select s.store_id, cast(s.movement_date as varchar) as movement_date, {dbl('coalesce(d.revenue, 0)', 'revenue')}
from (select store_id, cast(unnest(generate_series(min(movement_date), max(movement_date), interval 1 day)) as date) movement_date
    from lines group by store_id) s
  left join daily d on d.store_id = s.store_id and d.movement_date = s.movement_date""",
        # ---- audits -------------------------------------------------------------------------
        "audit_primary_keys": _duplicates(primary).replace("from inventory ", "from lines "),
        "audit_unique": f"""select 'store_assortment' table_name, concat_ws('|', {SLOT}) as key, count(*) as rows
  from (select * from store_assortment union all select * from past_assortment) group by {SLOT} having count(*) > 1
union all select 'movements', cast(raw_movement_id as varchar), count(*) from (select raw_movement_id from raw_movements
  union all select raw_movement_id from cleaned_movements where loaded) group by raw_movement_id having count(*) > 1""",
        "audit_foreign_keys": _orphans(foreign),
        "audit_domains": _violations(domains),
        "audit_price_rules": _violations(price_rules),
        "audit_not_null": _violations(not_null),
        "audit_lengths": _violations(lengths),
        "cascade_delete_rows": """select 'store_layout' table_name, count(*) as rows from store_layout where shelf_level <> 1
union all select 'store_assortment', count(*) from store_assortment where shelf_level <> 1
union all select 'raw_movements', count(*) from raw_movements where raw_movement_id not in (select raw_movement_id from raw_movements where movement_type = 'breakage')
union all select 'cleaned_movements', count(*) from cleaned_movements where raw_movement_id not in (select raw_movement_id from raw_movements where movement_type = 'breakage')
union all select 'movements without raw row', count(*) from raw_movements where raw_movement_id in (select raw_movement_id from raw_movements where movement_type = 'breakage')""",
        "cascade_delete": """select 'inventory' table_name, count(*) as rows, 0 without_supplier from inventory where product_id not in (select product_id from products where category_level_1 = 'LARGE')
union all select 'movements', count(*), count(*) filter (movement_type = 'purchase' and
    (supplier_id in (select supplier_id from suppliers where supplier_type = 'secondary') or supplier_id is null))
  from lines where product_id not in (select product_id from products where category_level_1 = 'LARGE')
union all select 'product_suppliers', count(*), 0 from product_suppliers where product_id not in (select product_id from products where category_level_1 = 'LARGE')
    and supplier_id not in (select supplier_id from suppliers where supplier_type = 'secondary')
union all select 'store_assortment', count(*), 0 from store_assortment where product_id not in (select product_id from products where category_level_1 = 'LARGE')""",
        # ---- analytic tables ----------------------------------------------------------------
        "sales_by_shelf_historical": _per_shelf("sale", _SHELF_SALES, "then"),
        "sales_by_shelf_current": _per_shelf("sale", _SHELF_SALES, "now"),
        "breakage_by_shelf_historical": _per_shelf("breakage", _SHELF_BREAKS, "then"),
        "breakage_by_shelf_current": _per_shelf("breakage", _SHELF_BREAKS, "now"),
        "margins_by_product_shelf": f"""select store_id, product_id, product_description, category_level_1, category_level_2,
  brand_code, brand_name, shelf_id, {DAY}, {CALENDAR}, {big('pieces', 'qty_sold')}, {dbl('sold', 'revenue')},
  {dbl('worth', 'cost')}, {dbl('sold - worth', 'margin')}, {margin('sold', 'worth')}
from (select *, pieces * purchase_price as worth from day_sums join labelled using (product_id)) where kind = 'sale'""",
        "daily_kpis": f"select store_id, {DAY}, month, year, week, sale_transactions, {_DAILY} from daily",
        "inventory_by_shelf": f"select *, {fill('stock_qty', 'capacity')} from stock_positions",
        "shelf_detail": "select * from details",
        "shelf_movements_current": f"""select * exclude (movement_date) replace (cast(unit_sale_price as double) as unit_sale_price,
  cast(unit_purchase_price as double) as unit_purchase_price, cast(unit_cost as double) as unit_cost), {DAY}, {CALENDAR}
from shelf_moves""",
        "overview_totals": f"""select {dbl('sum(revenue)', 'revenue')}, {big('sum(qty_sold)', 'qty_sold')},
  {big('sum(qty_breakage)', 'qty_breakage')}, {dbl('sum(breakage_cost)', 'breakage_cost')},
  {dbl('sum(revenue) - sum(cogs)', 'margin')} from daily""",
        "overview_trend": _trend("month"),
        "overview_trend_week": _trend("year || '-W' || lpad(cast(week as varchar), 2, '0')"),
        "overview_trend_day": _trend("cast(movement_date as varchar)"),
        'shelf_products_grid': f"""select a.store_id, a.shelf_id, a.shelf_level, a.zone, a.slot_number, product_id, product_description,
  {big('coalesce(qty_sold, 0)', 'qty_sold')}, {big('coalesce(qty_breakage, 0)', 'qty_breakage')}, stock_qty
from active a join products using (product_id)
left join (select store_id, product_id, sum(case when movement_type = 'sale' then quantity else 0 end) qty_sold,
    sum(case when movement_type = 'breakage' then quantity else 0 end) qty_breakage
  from movements where movement_type in ('sale', 'breakage') group by store_id, product_id) using (store_id, product_id)
left join (select store_id, product_id, stock_qty from stock_positions) using (store_id, product_id)""",
        'shelf_products_grid_week': f"""select a.store_id, a.shelf_id, a.shelf_level, a.zone, a.slot_number, product_id, product_description,
  {big('coalesce(qty_sold, 0)', 'qty_sold')}, {big('coalesce(qty_breakage, 0)', 'qty_breakage')}, stock_qty
from active a join products using (product_id)
left join (select store_id, product_id, sum(case when movement_type = 'sale' then quantity else 0 end) qty_sold,
    sum(case when movement_type = 'breakage' then quantity else 0 end) qty_breakage
  from movements where movement_type in ('sale', 'breakage') and year(movement_date) = 1998 and weekofyear(movement_date) = 1 group by store_id, product_id) using (store_id, product_id)
left join (select store_id, product_id, stock_qty from stock_positions) using (store_id, product_id)
where a.shelf_id = 7""",
        "shelf_level_kpis": _level("store_id, shelf_id, shelf_level, zone"),
        "shelf_level_totals": _level("store_id, shelf_id, shelf_level"),
        "share_of_shelf": _shelf_share("brand_code"),
        "share_of_shelf_category": _shelf_share("category_level_1"),
        "share_of_sales": _sales_share("brand_code"),
        "share_of_sales_category": _sales_share("category_level_1"),
        "shelf_mix_kpis": f"""select d.*, {dbl('coalesce(m.revenue, 0)', 'revenue')}, {dbl('coalesce(m.margin, 0)', 'margin')}
from (select store_id, shelf_id, count(distinct brand_code) brands, count(distinct category_level_1) categories
    from details where product_id is not null group by all) d
  left join (select store_id, shelf_id, sum(quantity * unit_sale_price) revenue,
      sum(quantity * unit_sale_price) - sum(quantity * unit_cost) margin
    from shelf_moves where movement_type = 'sale' group by all) m
  on m.store_id = d.store_id and m.shelf_id = d.shelf_id""",
        "pipeline_runs": f"""select 'transform' pipeline_step, source_file_name, 'success' status, count(*) rows_processed,
  count(*) filter (error_reason is null) rows_success, count(*) filter (error_reason is not null) rows_failed,
  cast(null as varchar) error_message, {moment("timestamp '2024-02-01 00:00:00'")} started_at,
  {moment("timestamp '2024-02-01 00:00:12.345'")} completed_at, cast(12.35 as double) duration_seconds
from validated group by source_file_name""",
        "replenishment_candidates": """select i.store_id, i.product_id, i.stock_qty, minimum_stock_threshold, supplier_id, is_primary_supplier,
  cast(greatest(1, floor(reorder_lot * case when is_primary_supplier then 1.25 else 0.75 end),
    case when stock_qty < 0 then 1 - stock_qty else 1 end) as int) suggested_qty,
  cast(row_number() over (partition by i.store_id, i.product_id order by is_primary_supplier desc, supplier_id) as int) option_rank
from inventory i join products_specifications s on s.product_id = i.product_id
  join product_suppliers o on o.product_id = i.product_id where stock_qty < minimum_stock_threshold""",
        "product_registry": """select 'COD_' || upper(substr(sha256('retail_project_2026' || id_prodotto), 1, 10)) id_prodotto,
  substr(descrizione_clean, 1, 15) descrizione, cat1, cat2, cat3, iva, pzxcar, um, costo_noisy / 10000 costo,
  prezzo_noisy / 10000 prezzo_vendita, brand_anon brand
from master where coalesce(cat1 <> 'MEDIUM', true) and iva <> '++' and costo_noisy > 0 and prezzo_noisy > 0""",
        # ---- pipelines ----------------------------------------------------------------------
        "stream_ingest": f"select {SOURCE_FIELDS}, {MOVEMENT_FIELDS} from raw_movements",
        "stream_pipeline": f"""select {SOURCE_FIELDS}, {MOVEMENT_FIELDS.replace('store_id', 'c.store_id').replace('product_id', 'c.product_id')},
  a.shelf_id, a.shelf_level, a.zone, a.slot_number from cleaned_movements c
  left join active a on a.store_id = c.store_id and a.product_id = c.product_id""",
        "batch_load": """select i.store_id, i.product_id, cast(i.stock_qty + coalesce(d.net, 0) as int) stock_qty
from inventory i left join (select store_id, product_id,
    sum(case when movement_type = 'purchase' then quantity else -quantity end) net
  from cleaned_movements group by all) d on d.store_id = i.store_id and d.product_id = i.product_id""",
    }

    def as_double(key: str, body: str) -> str:
        casts = ", ".join(f"cast({c} as double) as {c}" for c in NULLABLE.get(key, []))
        return f"select * replace ({casts}) from ({body})" if casts else body

    return {key: as_double(key, query(body)) for key, body in found.items()}

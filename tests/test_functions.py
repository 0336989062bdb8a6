import hashlib
import random
import re
from decimal import ROUND_HALF_UP, localcontext
from decimal import Decimal as D

from pyspark.sql import functions as F

from storespark.functions import fixed_values as fixed
from storespark.functions import money, text
from storespark.operators import ranking, shelves
from storespark.operators.stock import clamp_threshold


def test_fixed_lists():
    assert len(fixed.BRANDS) == len(set(fixed.BRANDS)) == 155
    assert len(set(fixed.BRAND_NAMES)) == 145
    spellings = fixed.brand_spellings()
    assert spellings[:4] == [("mulino bianco", "B012"), ("mulinobianco", "B012"), ("m b", "B012"), ("mb", "B012")]
    assert dict(spellings)["barilla"] == "B001" and dict(spellings)["plasmon"] == "B155"


def first_by_search(description, spellings):
    """One search per spelling, in order."""
    for spelling, code in spellings:
        if re.search(rf"\b{re.escape(spelling)}\b", description):
            return code
    return None


def test_brand_search_equals_one_search_per_spelling(spark):
    spellings = fixed.brand_spellings()
    rng = random.Random(7)
    words = [s for s, _ in spellings] + ["pasta", "bianco", "s", "rio", "mbx", "starlet", "vivo", "bio", "l'", "&"]
    glue = [" ", "  ", "-", ".", "", "'"]
    descriptions = ["nestlé crunch", "xnestlé", "barillabio", "vivo barilla bio", "s. lucia ricotta", "head&shoulders",
                    "sant'anna", "l'oréal elvive", "beck's", "", "é star é", "4 salti in padella"]
    for _ in range(600):
        parts = rng.choices(words, k=rng.randint(1, 4))
        descriptions.append("".join(p + rng.choice(glue) for p in parts))
    frame = spark.createDataFrame([(d,) for d in descriptions], "d string").select(
        "d",
        text.extract_brand(F.col("d")).alias("brand"),
        text.squeeze_spaces(text.strip_brand(F.col("d"))).alias("rest"),
    )
    every = "|".join(re.escape(s) for s, _ in spellings)
    for r in frame.collect():
        assert r.brand == first_by_search(r.d, spellings), r.d
        rest = re.sub(r"\s+", " ", re.sub(rf"\b({every})\b", "", r.d)).strip()
        assert r.rest == rest, r.d
    nothing = spark.createDataFrame([(None,)], "d string").select(text.extract_brand(F.col("d")))
    assert nothing.first()[0] is None


def test_pseudonym(spark):
    got = spark.range(1, 4).select(text.pseudonymise_id(F.col("id"))).collect()
    expected = ["COD_" + hashlib.sha256(f"retail_project_2026{n}".encode()).hexdigest()[:10].upper() for n in (1, 2, 3)]
    assert [r[0] for r in got] == expected


def test_price_noise_uses_every_step(spark):
    steps = spark.range(2000).select(text.price_noise(F.col("id")).alias("s")).groupBy("s").count().collect()
    assert {r.s for r in steps} == {D(str(s)) for s in fixed.PRICE_STEPS}
    assert min(r["count"] for r in steps) > 80


def test_clamp_threshold(spark):
    rows = [(10, 4, True), (10, 10, True), (2, 5, True), (10, 4, False), (10, 4, None)]
    frame = spark.createDataFrame(rows, "i int, m int, f boolean")
    got = [r[0] for r in frame.select(clamp_threshold(F.col("i"), F.col("m"), F.col("f"))).collect()]
    assert got == [4, 3, 1, 0, 0]


def test_class_rules(spark):
    rows = [("1", "BEVANDE", "ACQUA", "LATTUGHE"), ("2", "BEVANDE", "ACQUA", None), ("3", "MACELLERIA", None, "x"), ("4", None, None, None)]
    frame = spark.createDataFrame(
        rows, "product_id string, category_level_1 string, category_level_2 string, category_level_3 string"
    )
    got = {r.product_id: (r.rotation_class, r.spoilage_min, r.spoilage_max) for r in shelves.classify_products(frame).collect()}
    assert got == {
        "1": ("high", D("0.06"), D("0.12")), "2": ("high", D("0.0001"), D("0.0005")),
        "3": ("high", D("0.03"), D("0.08")), "4": ("medium", D("0.005"), D("0.02")),
    }


def test_suppliers_and_grid(spark):
    suppliers = shelves.supplier_list(spark.range(1, 21).selectExpr("cast(id as int) as n")).orderBy("supplier_id").collect()
    assert tuple(suppliers[0]) == ("SUP_001", "Fornitore A", "primary")
    assert tuple(suppliers[19]) == ("SUP_020", "Fornitore T", "secondary")
    grid = shelves.layout_grid(spark.createDataFrame([(1,)], "store_id int"))
    assert grid.count() == grid.distinct().count() == 2025


# ---- ranks ------------------------------------------------------------------------------------


def test_numbered_equals_a_sort(spark):
    values = sorted({f"B{random.Random(n).randint(0, 10**6):06d}" for n in range(3000)} | {"", "é", "Z"})
    frame = spark.createDataFrame([(v,) for v in values], "v string").repartition(5)
    got = {r.v: r.i for r in ranking.numbered(frame, "v").collect()}
    assert got == {v: i for i, v in enumerate(sorted(values, key=lambda v: v.encode()))}


def test_brand_names_second_round(spark):
    codes = spark.range(300).selectExpr("format_string('B%03d', id + 1) as brand_code")
    # the second round of names starts with the number 3
    products = codes.union(codes).union(spark.createDataFrame([(None,)], "brand_code string"))
    got = {r.brand_code: r.brand_name for r in shelves.brand_names(products).collect()}
    assert len(got) == 300 and got["B001"] == "Barilla" and got["B146"] == "Barilla 3" and got["B291"] == "Barilla 4"


def test_sample_is_exact_with_a_hot_category(spark):
    rows = spark.range(9000).selectExpr("id", "case when id % 3 > 0 then 'hot' when id < 60 then 'small' else 'other' end as c")
    order = text.hash_order(F.col("id"), 1)
    for buckets in (4096, 2):
        got = ranking.sample_by_category(rows, "c", order, {"hot": 0.05, "small": 0.3, "none": 1.0}, buckets).collect()
        every = [(r.id, r.c) for r in rows.collect()]
        expected = set()
        for c, share in (("hot", 0.05), ("small", 0.3)):
            ids = sorted((i for i, k in every if k == c), key=lambda i: hashlib.md5(f"1{i}".encode()).hexdigest())
            expected |= set(ids[: round(share * len(ids))])
        assert {r.id for r in got} == expected and len(got) == len(expected)


def test_sample_is_exact_where_one_id_straddles_its_end(spark):
    rows = spark.range(900).selectExpr("id as n", "if(id % 3 = 0, -1, id) as id", "id % 2 as v", "'c' as c")
    order = text.hash_order(F.col("id"), 1)
    hashes = sorted(hashlib.md5(f"1{r.id}".encode()).hexdigest() for r in rows.collect())
    below = hashes.index(hashlib.md5(b"1-1").hexdigest())
    for share in ((below + 20) / 900, (below + 299) / 900, (below + 300) / 900, below / 900):
        for columns in (["n", "id", "c"], ["id", "v", "c"]):
            got = ranking.sample_by_category(rows.select(*columns), "c", order, {"c": round(share, 6)}).collect()
            assert len(got) == round(share * 900)
            assert sorted(hashlib.md5(f"1{r.id}".encode()).hexdigest() for r in got) == hashes[: len(got)]


def test_first_per_key_with_many_copies(spark):
    rows = spark.range(6000).selectExpr("case when id % 3 = 0 then 'hot' else cast(id % 7 as string) end as k", "id as n", "id % 5 as v")
    got = {r.k: (r.n, r.v) for r in ranking.first_per_key(rows, "k", [F.col("n")]).collect()}
    assert got["hot"] == (0, 0) and len(got) == 8


def test_allocation_sums_to_the_shelves(spark):
    counts = spark.createDataFrame([("a", 10), ("b", 10), ("c", 1), ("d", 3)], "category_level_1 string, n_products bigint")
    allocation = shelves.shelf_allocation(counts)
    got = {r.category_level_1: r.n_shelves for r in allocation.collect()}
    # shares 18.75, 18.75, 1.875, 5.625 round to 19, 19, 2, 6: one too many, taken from the first of the largest
    assert got == {"a": 18, "b": 19, "c": 2, "d": 6}
    shelf_map = {r.shelf_id: r.shelf_category for r in shelves.shelf_category_map(allocation).collect()}
    assert sorted(shelf_map) == list(range(1, 46)) and shelf_map[18] == "a" and shelf_map[19] == "b" and shelf_map[45] == "c"


def test_quotients_are_rounded_once_at_any_size(spark):
    pairs = [("5.0000", "100000.0001"), ("1", "3"), ("-2", "3"), ("1", "-8"), ("100000000000000", "1"),
             ("123456789012345678.1234", "7.0001"), ("0.0005", "10"), ("1", "0")]
    frame = spark.createDataFrame([(D(a), D(b)) for a, b in pairs], "a decimal(38,4), b decimal(38,4)")
    found = frame.select(money.ratio(F.col("a"), F.col("b")), money.percent(F.col("a"), F.col("b"))).collect()
    with localcontext() as context:
        context.prec = 60
        for (a, b), row in zip(pairs, found):
            for digits, times, got in ((4, 1, row[0]), (2, 100, row[1])):
                exact = None if D(b) == 0 else (D(a) * times / D(b)).quantize(D(1).scaleb(-digits), ROUND_HALF_UP)
                assert got == exact, (a, b, digits)
    large = spark.createDataFrame([(D(10) ** 14, D(1))], "r decimal(38,4), c decimal(38,4)")
    assert large.select(money.margin_pct(F.col("r"), F.col("c"))).first()[0] == D("100.00")


def test_supplier_names_differ_at_any_number(spark):
    numbers = spark.range(1, 100_001).withColumnRenamed("id", "n").union(spark.sql("select 5000000L"))
    found = shelves.supplier_list(numbers)
    assert found.select("supplier_name").distinct().count() == 100_001
    assert found.filter("supplier_id = 'SUP_001'").first().supplier_name == "Fornitore A"

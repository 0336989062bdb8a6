"""CSV sources.

A drop ``movements_2026-01-01.csv`` is either one file or a folder of that name
holding part files, as distributed writers leave it. Its name is its path below
the drop folder; only a folder may carry a ``key=`` prefix, which is not part
of the name. Cells follow the dialect in which a quote inside quotes is doubled.
"""

from __future__ import annotations

import datetime as dt
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storespark import schemas
from storespark.functions import fixed_values as fixed

_LISTING = {"recursiveFileLookup": "true", "pathGlobFilter": "*.csv"}
DIALECT = {"quote": '"', "escape": '"'}
#: a folder named like a drop, below any others, and the file inside it
_PARTS = r"^((?:[^/]+/)*?)(?:([^/=]+)=)?([^/]+\.csv)/.*$"
#: what reading bytes that are not UTF-8 leaves in a cell
WRONG_BYTES = "\ufffd"


def _hadoop_path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def path_below(spark: SparkSession, folder: str) -> str:
    """The folder's full path, without scheme and host, as file paths start with it."""
    files, path = _hadoop_path(spark, folder)
    return files.makeQualified(path).toUri().getPath().rstrip("/")


def drop_name(path: Column, base: str) -> Column:
    """Name of the drop a file belongs to, from the file's encoded path."""
    plain = F.regexp_replace(F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), r"^\w+:(//[^/]*)?(?=/)", "")
    below = F.when(plain.startswith(f"{base}/"), F.substring(plain, F.lit(len(base) + 2), F.length(plain))).otherwise(
        F.raise_error(F.concat(F.lit(f"not below {base}: "), plain)).cast("string")
    )
    folder = F.regexp_extract(below, _PARTS, 3)
    unescaped = F.coalesce(F.try_url_decode(F.replace(folder, F.lit("+"), F.lit("%2B"))), folder)
    value = F.when(F.regexp_extract(below, _PARTS, 2) != "", unescaped).otherwise(folder)
    return F.when(folder == "", below).otherwise(F.concat(F.regexp_extract(below, _PARTS, 1), value))


def hidden_files(spark: SparkSession, folder: str) -> list[tuple[str, str, int, dt.datetime]]:
    """CSV files, at any depth, that Spark's readers pass over, as a name on their path starts with ``_`` or ``.``.

    As (name, path, length, time). The store matches the names, level by level; only hidden ones come to the driver.
    """
    files, path = _hadoop_path(spark, folder)
    base = files.makeQualified(path).toUri().getPath().rstrip("/")
    matches = lambda pattern: files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, pattern)) or []
    found, level = {}, ""
    while True:
        inside = f"{level}[_.]*"
        found |= {s.getPath().toUri().getPath(): s for s in matches(f"{inside}.csv") if s.isFile()}
        while any(s.isDirectory() for s in matches(inside)):
            inside += "/*"
            found |= {s.getPath().toUri().getPath(): s for s in matches(f"{inside}.csv") if s.isFile()}
        if not any(s.isDirectory() for s in matches(f"{level}*")):
            break
        level += "*/"
    at = lambda s: dt.datetime.fromtimestamp(s.getModificationTime() / 1000, dt.timezone.utc)
    return [(name.removeprefix(f"{base}/"), name, s.getLen(), at(s)) for name, s in sorted(found.items())]


def literal_path(path: str) -> str:
    """A decoded path as readers take it, with no sign left that they would expand."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def list_files(spark: SparkSession, folder: str, paths: list[str] | None = None) -> DataFrame:
    """Every CSV file, or those below some ``paths``, with its drop name, path, length and time; contents are not read.

    Scans pass over files of length 0, so the names come from the file index
    that Spark holds on the driver, one entry per file.
    """
    reader = spark.read.format("binaryFile").options(**_LISTING)
    found = reader.load([literal_path(p) for p in paths or [folder]])
    listed = spark.createDataFrame([(path, unquote(path)) for path in found.inputFiles()], "_encoded string, path string")
    sizes = found.select(_same_form(F.col("_metadata.file_path")).alias("_at"), "length", "modificationTime")
    joined = listed.withColumn("_at", _same_form(F.col("_encoded"))).join(sizes, "_at", "left")
    return joined.select(*_listed(drop_name(F.col("_encoded"), path_below(spark, folder)), F.col("path")))


def _listed(name: Column, path: Column) -> list[Column]:
    """Files of length 0 have no scan entry; their time is the epoch. Paths have one slash after a scheme without host."""
    return [
        name.alias("file_name"),
        _same_form(path).alias("path"),
        F.coalesce("length", F.lit(0)).cast("bigint").alias("length"),
        F.coalesce("modificationTime", F.timestamp_seconds(F.lit(0))).alias("modified_at"),
    ]


def listed_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Files as they arrive, as ``list_files`` tells of them; contents are not read."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").options(**_LISTING).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    found = reader.load(literal_path(folder))
    encoded = F.col("_metadata.file_path")
    plain = F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
    return found.select(*_listed(drop_name(encoded, path_below(spark, folder)), plain))


def with_all_parts(files: DataFrame, folder: str) -> DataFrame:
    """Listed files with the other parts of their drops; only folders of drops that have parts are listed."""
    spark = files.sparkSession
    plain = F.regexp_replace("path", r"^\w+:(//[^/]*)?(?=/)", "")
    single = plain == F.concat(F.lit(f"{path_below(spark, folder)}/"), "file_name")
    parts = files.where(~single).select(F.regexp_replace("path", "/[^/]*$", "").alias("at")).distinct()
    folders = [r["at"] for r in parts.collect()]
    whole = files.where(single)
    return whole.unionByName(list_files(spark, folder, folders)) if folders else whole


def _same_form(path: Column) -> Column:
    """Paths come as file:/x and as file:///x; here as the first."""
    return F.regexp_replace(path, r"^(\w+):/+", "$1:/")


def source_files(spark: SparkSession, folder: str) -> DataFrame:
    """Drop names in order; empty files are listed too."""
    return list_files(spark, folder).select("file_name").distinct().orderBy("file_name")


_TOKENS = ", ".join(f"'{t}'" for t in fixed.NULL_TOKENS)


def no_token(name: str) -> Column:
    """The named cell, or null where it holds one of the tokens for no value."""
    return F.expr(f"case when `{name}` not in ({_TOKENS}) then `{name}` end")


def typed(text: Column, sql_type: str) -> Column:
    """A cell in its type; null where it does not fit. Whole numbers may carry a zero fraction."""
    if sql_type == "string":
        return text
    if sql_type != "int":
        return text.try_cast(sql_type)
    number = F.trim(text).try_cast("decimal(20,4)")
    return F.when(number == F.floor(number), number.try_cast("int"))


def cell(name: str, sql_type: str) -> Column:
    """A named cell without null tokens, in its type."""
    return typed(no_token(name), sql_type)


def violation() -> Column:
    """Whether a typed row breaks the structure of the raw table, which rejects its whole file.

    ``_text`` holds the cells as they were read.
    """
    types = schemas.MOVEMENT_TYPES
    kind, quantity = F.col("movement_type"), F.col("quantity")
    bad = F.col("_malformed") | F.coalesce(F.contains(F.concat_ws("", "_text.*"), F.lit(WRONG_BYTES)), F.lit(False))
    bad = bad | F.coalesce(~kind.isin(fixed.MOVEMENT_KINDS), F.lit(True)) | F.coalesce(quantity <= 0, F.lit(True))
    for name in schemas.REQUIRED:
        bad = bad | F.col(name).isNull()
    for name in [c for c, t in types.items() if t != "string" and c not in schemas.REQUIRED]:
        bad = bad | (F.col(f"_text.{name}").isNotNull() & F.col(name).isNull())
    return bad


def type_movements(text: DataFrame, source_system: str = fixed.SOURCE_SYSTEM) -> DataFrame:
    """Typed movements of text rows that carry their ``source_file_name``, with a ``violation`` flag."""
    types = schemas.MOVEMENT_TYPES
    malformed = F.col(schemas.MALFORMED).isNotNull() if schemas.MALFORMED in text.columns else F.lit(False)
    others = [c for c in (OTHER_HEADER,) if c in text.columns]
    cells = text.select(
        "source_file_name", *others, malformed.alias("_malformed"), F.struct(*[no_token(c).alias(c) for c in types]).alias("_text")
    )
    rows = cells.select(
        "source_file_name",
        F.lit(source_system).alias("source_system"),
        *[typed(F.col(f"_text.{c}"), t).alias(c) for c, t in types.items()],
        *others,
        "_text",
        "_malformed",
    )
    return rows.withColumn("violation", violation()).drop("_text", "_malformed")


#: set on a row that tells that its file has to be read again: the columns' order, after ``OVER_LINES`` if over lines
OTHER_HEADER = "other_header"
OVER_LINES = "over lines"


def movement_text(reader, paths: str | list[str], base: str, order: list[str] | None = None) -> DataFrame:
    """Cells of movement files as text, through ``spark.read`` or ``spark.readStream``.

    Header lines are read as rows and dropped by their content. A file whose
    header has the columns in another ``order`` keeps it as a marked row, so
    that the file can be read again in its own order; any other header fits no
    type, so that this file alone is rejected. Files are split by lines; one
    with a line that leaves a quote open is marked too, and read again over
    lines, which an ``order`` that begins with ``OVER_LINES`` asks for.
    """
    order = order or schemas.MOVEMENT_COLUMNS
    over_lines = [OVER_LINES] if order[0] == OVER_LINES else []
    order = order[len(over_lines) :]
    fields = [schemas.MOVEMENT_CSV[c] for c in [*order, schemas.MALFORMED]]
    schema = type(schemas.MOVEMENT_CSV)(fields)
    reader = reader.schema(schema).option("header", False).option("multiLine", bool(over_lines))
    rows = reader.options(**_LISTING, **DIALECT).csv(paths)
    trimmed = F.array(*[F.regexp_replace(F.trim(F.coalesce(F.col(c), F.lit(""))), "^\ufeff", "") for c in order])
    # all cells are looked at only where the first one holds a column's name
    first = F.regexp_replace(F.trim(F.coalesce(F.col(order[0]), F.lit(""))), "^\ufeff", "")
    header = F.coalesce(F.when(first == order[0], trimmed == F.array(*map(F.lit, order))), F.lit(False))
    named = F.when(first.isin(order), F.array_sort(trimmed) == F.array(*map(F.lit, sorted(order))))
    other = F.when(named, F.concat_ws(",", *map(F.lit, over_lines), F.array_join(trimmed, ",")))
    if not over_lines:
        line = F.col(schemas.MALFORMED)
        quotes = F.length(line) - F.length(F.replace(line, F.lit('"')))
        other = F.coalesce(other, F.when(quotes % 2 == 1, F.lit(",".join([OVER_LINES, *order]))))
    return rows.filter(~header).withColumns(
        {"source_file_name": drop_name(F.col("_metadata.file_path"), base), OTHER_HEADER: other}
    )


def raw_ingest(
    spark: SparkSession,
    paths: str | list[str],
    source_system: str = fixed.SOURCE_SYSTEM,
    folder: str | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Movements of a drop folder, or of some ``paths`` below ``folder``, with their file name and system.

    ``order`` is the columns' order in these files, after ``OVER_LINES`` where cells go over lines. The mark of files
    that have to be read otherwise is left out; ``read_in_order`` keeps it.
    """
    return read_in_order(spark, paths, source_system, folder, order).drop(OTHER_HEADER)


def read_in_order(
    spark: SparkSession,
    paths: str | list[str],
    source_system: str = fixed.SOURCE_SYSTEM,
    folder: str | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    base = path_below(spark, folder or paths)
    found = [literal_path(p) for p in ([paths] if isinstance(paths, str) else paths)]
    return type_movements(movement_text(spark.read, found, base, order), source_system)


def with_header(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Cells of a CSV with a header line, as text.

    A file is split over tasks unless some line holds an odd number of quotes, as one does where a quoted cell goes on
    in the next line; only then the cells are read over lines, a file a task.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    over_lines = not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()
    return spark.read.option("header", True).option("multiLine", over_lines).options(**DIALECT, **options).csv(path)


def products_master(spark: SparkSession, path: str) -> DataFrame:
    """Product registry CSV: ten renamed columns; an unnamed index column, where present, is left out."""
    types = {f.name: f.dataType.simpleString() for f in schemas.TABLES["products"].fields}
    return with_header(spark, path).select(
        *[cell(src, types[dst]).alias(dst) for src, dst in schemas.PRODUCT_MASTER_COLUMNS.items()]
    )


def price_list(spark: SparkSession, path: str) -> DataFrame:
    """Price list CSV (``;``): eleven renamed columns; the VAT code stays text."""
    types = {"pzxcar": "int", "brand": "int", "costo": "decimal(12,4)", "prezzo_vendita": "decimal(12,4)"}
    return with_header(spark, path, sep=";").select(
        *[cell(src, types.get(dst, "string")).alias(dst) for src, dst in schemas.PRICE_LIST_COLUMNS.items()]
    )


def brands_csv(spark: SparkSession, path: str) -> DataFrame:
    return with_header(spark, path).select(*schemas.TABLES["brands"].fieldNames())

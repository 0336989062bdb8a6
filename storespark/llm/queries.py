"""Queries of this package for ``__spark_entry__``, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storespark.llm import (
    bpe_prefix,
    dartminhash,
    exact_dedup,
    fingerprints,
    hard_negatives,
    langid,
    licenses,
    mixing,
    packing,
    prefix_trie,
    secrets,
    toxicity,
    warc_zip,
)
from storespark.llm.common import table


def op1_secret_ownership(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, folder, "documents")).drop("found")


def op2_chunk_recipes(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents")).drop("n_chunks")


def op3_toxicity_trees(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_license_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, folder, "documents"))
    return found.withColumn("n_detections", F.size("detections").cast("long")).drop("detections")


def op5_dartminhash(spark: SparkSession, folder: str) -> DataFrame:
    return dartminhash.near_duplicates(table(spark, folder, "documents")).drop("name")


def op6_language_filters(spark: SparkSession, folder: str) -> DataFrame:
    return langid.languages(table(spark, folder, "documents"))


def op7_weighted_sampling(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, folder, "documents"))


def op8_water_filling(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "repeats"
    )


def op9_bin_slack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op10_warc_packages(spark: SparkSession, folder: str) -> DataFrame:
    return warc_zip.archive_pages(table(spark, folder, "pages")).drop("url")


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.shared_prefix_trie(table(spark, folder, "conversations"))


def op12_prefix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_prefix.digests(table(spark, folder, "documents"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_ownership,
        op2_chunk_recipes,
        op3_toxicity_trees,
        op4_license_rules,
        op5_dartminhash,
        op6_language_filters,
        op7_weighted_sampling,
        op8_water_filling,
        op9_bin_slack,
        op10_warc_packages,
        op11_prefix_trie,
        op12_prefix_bpe,
        op13_hard_negatives,
    )
}

ORACLE: dict[str, str] = {
    "op2_chunk_recipes": """
with t as (
  select doc_id, coalesce(text, '') as body,
    regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') as norm
  from documents)
select doc_id,
  first_value(doc_id) over (partition by norm order by length(body) desc, doc_id) as keep_id,
  count(*) over (partition by norm) as group_size,
  row_number() over (partition by norm order by length(body) desc, doc_id) = 1 as kept,
  sha256(norm) as text_sha256
from t""",
    "op8_water_filling": """
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
    md5('mix-1:' || coalesce(cast(doc_id as varchar), '')) as place
  from documents),
totals as (
  select source, cast(sum(size) as double) as source_size,
    (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
  from sized group by source),
ordered as (
  select *, 3 * source_size as cap,
    sum(3 * source_size) over w - 3 * source_size as caps_before, sum(weight) over w - weight as weights_before,
    sum(source_size) over () as total, sum(weight) over () as weights
  from totals
  window w as (order by 3 * source_size / weight, source nulls last rows unbounded preceding)),
levels as (select *, row_number() over (order by 3 * source_size / weight, source nulls last) as place, (total - caps_before) / cast(weights - weights_before as double) as level from ordered),
free as (select min_by(level, place) as level from levels where level * weight <= cap),
targets as (
  select source, source_size, least(coalesce(free.level, 1e300) * weight, cap) as target from levels, free),
plan as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end as whole from targets),
placed as (
  select d.doc_id, d.source, d.size, p.source_size, p.target, p.whole,
    p.target - p.whole * p.source_size as missing,
    sum(d.size) over (partition by d.source order by d.place, d.doc_id, d.size rows unbounded preceding) as reached
  from sized d join plan p on d.source is not distinct from p.source),
picked as (
  select *, whole + case when size > 0 and reached - size < missing and reached - size / 2.0 <= missing then 1 else 0 end
    as repeats from placed)
select doc_id, size, cast(source_size as bigint) as source_size, target,
  cast(size * repeats as bigint) as taken, cast(repeats as bigint) as repeats from picked""",
    "op10_warc_packages": """
with t as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest,
    case when strlen(coalesce(html, '')) >= 1000
      then max(page_id) over (partition by coalesce(html, '')) else page_id end as first_id
  from pages)
select page_id, payload_bytes, payload_digest,
  case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id <> first_id then first_id end as refers_to
from t""",
    "op11_prefix_trie": """
with own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place
  from conversations where conv_id is not null),
ids as (select conv_id, cast(conv_id as varchar) as digits from own group by conv_id),
hashed as (
  select conv_id, xor(list_reduce(
      list_concat([cast(4294967295 as bigint)], flatten(list_transform(range(1, strlen(digits) + 1),
        lambda i: [cast(ascii(substr(digits, i, 1)) as bigint), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda a, x: case when x >= 0 then xor(a, x) when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end),
    4294967295) % 9 as h
  from ids),
parts as (
  select i.conv_id, 0 as part, o.place, o.role, o.text
  from hashed i join own o on o.conv_id = i.conv_id - i.conv_id % 5 and o.place <= i.h
  union all
  select i.conv_id, 1, o.place, o.role, o.text from hashed i join own o on o.conv_id = i.conv_id and o.place > i.h),
rebuilt as (select *, row_number() over (partition by conv_id order by part, place) as d from parts),
paths as (
  select conv_id, d, strlen(text) as bytes,
    list(sha256(length(role) || ':' || role || text)) over (partition by conv_id order by d) as path
  from rebuilt),
prefixes as (
  select conv_id, d, bytes, sha256(cast(path as varchar)) as key from paths
  union all select conv_id, 0, 0, 'root' from ids),
lengths as (select conv_id, max(d) as length from prefixes group by conv_id),
nodes as (
  select key, d, min(conv_id) as conv_id, count(*) as n_convs, max(bytes) as bytes,
    coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where length = d), '') as ends
  from prefixes join lengths using (conv_id) group by key, d),
linked as (
  select n.*, p.key as parent_key from nodes n left join prefixes p on p.conv_id = n.conv_id and p.d = n.d - 1),
kids as (select parent_key as key, count(*) as n_children from linked where parent_key is not null group by parent_key),
subtrees as (
  select p.key, sum((n.n_convs - 1) * n.bytes) as saved_tokens, count(*) filter (where k.key is null) as n_leaves
  from nodes n left join kids k on k.key = n.key join prefixes p on p.conv_id = n.conv_id and p.d <= n.d
  group by p.key)
select l.conv_id, l.d as depth, u.conv_id as parent_conv_id, l.n_convs, coalesce(k.n_children, 0) as n_children,
  s.n_leaves, cast(s.saved_tokens as bigint) as saved_tokens, sha256(l.ends) as ends_sha256
from linked l join subtrees s on s.key = l.key left join kids k on k.key = l.key left join nodes u on u.key = l.parent_key""",
    "op13_hard_negatives": """
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
    cast(list_dot_product(a.v, b.v) as bigint) as score
  from usable a join usable b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (
  select anchor_id, id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, p.positive_id,
  cast(row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.id) as integer) as rank,
  n.id as negative_id, p.positive_score, n.score as negative_score
from positives p join scored n
  on n.anchor_id = p.anchor_id and not n.same
  and 30 * p.positive_score <= 100 * n.score and 100 * n.score <= 90 * p.positive_score
qualify row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.id) <= 10""",
}

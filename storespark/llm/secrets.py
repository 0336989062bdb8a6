"""Secret scan with corpus-wide ownership frequency.

Every text is scanned for candidates: the three base kinds, and further kinds
of known form. A candidate's value is kept as SHA-256 only. Over the corpus
the hashes are summed by owner and repository: a value that many owners or
many repositories hold is a widely copied example, a random-looking value that
one owner holds in a few repositories is likely a live credential.

The scan is one Arrow pass that writes counts, spans and hashes; only those
narrow rows are shuffled, and the sums are combined per task before they move,
so that a value found in a third of all documents is one row per task.

Defined cases: a null text counts as empty and has the SHA-256 of the empty
string as ``base_sha256``; a null owner is an owner of its own, and so is a
null repository; rows alike are reported separately, and each counts as an
occurrence but not as a further owner or repository; an empty table gives an
empty result; texts of any length are scanned whole; further columns are not
read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storespark.llm.common import materialise, arrow_ready

ANY_CASE = re.ASCII | re.IGNORECASE
#: kind, words of which a lower-cased text must hold one, expression, group of the value, least length of that group
BASE_KINDS = [
    (
        "assign",
        ("password", "passwd", "secret", "token", "api_key", "apikey"),
        re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", ANY_CASE),
        2,
        8,
    ),
    ("access", ("akia",), re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", (), re.compile(r"[0-9a-f]+"), 0, 32),
]
#: The one bound, on a URL's scheme, keeps long runs with dots from being tried from every dot on.
MORE_KINDS = [
    ("private_key", ("private key",), re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]{40,}-----END", re.ASCII), 0, 60),
    ("jwt", ("eyj",), re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", re.ASCII), 0, 30),
    ("host_token", ("ghp_", "gho_", "ghs_", "glpat-", "xox", "sk_live_", "rk_live_", "npm_", "aiza"),
     re.compile(r"\b(?:gh[pos]_[A-Za-z0-9]{30,}|glpat-[\w-]{16,}|xox[abprs]-[\w-]{10,}|[sr]k_live_\w{16,}|npm_[A-Za-z0-9]{30,}|AIza[\w-]{30,})", re.ASCII), 0, 20),
    ("url_login", ("://",), re.compile(r"\b[a-z][a-z0-9+.-]{1,20}://[^\s:/@]+:([^\s:/@]{3,})@", ANY_CASE), 1, 3),
    ("bearer", ("bearer",), re.compile(r"\bbearer\x20+([A-Za-z0-9+/_.=~-]{16,})", ANY_CASE), 1, 16),
]
#: 32 hex digits or more; cheaper to look for than every run of hex digits
LONG_HEX = re.compile(r"[0-9a-f]{32,}")
BASE_NAMES = [k[0] for k in BASE_KINDS]
PLACEHOLDER = re.compile(r"example|sample|dummy|changeme|placeholder|your|xxx|test|fake|1234567", re.IGNORECASE)

SCANNED = (
    "doc_id bigint, owner string, repo string, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
    "spans string, candidates array<struct<hash:string,kind:string,from:int,to:int,random:boolean>>"
)
#: A value is an example from this many owners or repositories on; below both, one owner only makes it owner-specific.
EXAMPLE_OWNERS, EXAMPLE_REPOS = 3, 10
#: A live value is in so many repositories at most.
LIVE_REPOS = 3


def entropy(value: str) -> float:
    """Bits per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def looks_random(value: str) -> bool:
    """Long and mixed enough for a generated credential, and no placeholder."""
    return len(value) >= 12 and entropy(value) >= 3.0 and not PLACEHOLDER.search(value)


def find(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind's place, end, value) of all candidates, by start, then kind."""
    lower = text.lower()
    found = []
    for place, (kind, words, pattern, group, least) in enumerate(BASE_KINDS + MORE_KINDS):
        if words and not any(w in lower for w in words):
            continue
        use = LONG_HEX if kind == "hex" else pattern
        for m in use.finditer(text):
            if len(m.group(group)) >= least:
                found.append((m.start(), place, m.end(), m.group(group)))
    return sorted(found)


def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [k[0] for k in BASE_KINDS + MORE_KINDS]
    schema = pa.schema(
        [("doc_id", pa.int64()), ("owner", pa.string()), ("repo", pa.string())]
        + [(f"n_{k}", pa.int64()) for k in BASE_NAMES]
        + [("base_sha256", pa.string()), ("spans", pa.string())]
        + [("candidates", pa.list_(pa.struct([("hash", pa.string()), ("kind", pa.string()), ("from", pa.int32()), ("to", pa.int32()), ("random", pa.bool_())])))]
    )
    for batch in batches:
        rows = []
        for doc_id, owner, repo, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            found = find(text or "")
            spans = [(p, f"{names[p]}:{s}:{e}") for s, p, e, _ in found]
            base = ",".join(x for p, x in spans if p < len(BASE_NAMES))
            counts = Counter(p for _, p, _, _ in found)
            rows.append(
                {"doc_id": doc_id, "owner": owner, "repo": repo, "spans": ",".join(x for _, x in spans)}
                | {f"n_{k}": counts[i] for i, k in enumerate(BASE_NAMES)}
                | {"base_sha256": hashlib.sha256(base.encode()).hexdigest()}
                | {
                    "candidates": [
                        {"hash": hashlib.sha256(v.encode()).hexdigest(), "kind": names[p], "from": s, "to": e, "random": looks_random(v)}
                        for s, p, e, v in found
                    ]
                }
            )
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def scan(docs: DataFrame, owner: Column, repo: Column) -> DataFrame:
    arrow_ready(docs.sparkSession)
    rows = docs.select("doc_id", owner.cast("string").alias("owner"), repo.cast("string").alias("repo"), "text")
    return rows.mapInArrow(scan_batches, SCANNED)


def ownership(scanned: DataFrame) -> DataFrame:
    """hash, n_owners, n_repos, n_places: how widely each candidate value is held."""
    each = scanned.select(
        F.coalesce("owner", F.lit("\x00")).alias("owner"),
        F.coalesce("repo", F.lit("\x00")).alias("repo"),
        F.explode("candidates.hash").alias("hash"),
    )
    by_repo = each.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("_n"))
    by_owner = by_repo.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("_repos"), F.sum("_n").alias("_n"))
    return by_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("_repos").alias("n_repos"), F.sum("_n").alias("n_places")
    )


def verdict(example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> Column:
    return (
        F.when((F.col("n_owners") >= example_owners) | (F.col("n_repos") >= example_repos), "example")
        .when((F.col("n_owners") == 1) & (F.col("n_repos") <= LIVE_REPOS) & F.col("random"), "live")
        .otherwise("unclear")
    )


def scan_secrets(
    docs: DataFrame,
    owner: Column | None = None,
    repo: Column | None = None,
    example_owners: int = EXAMPLE_OWNERS,
    example_repos: int = EXAMPLE_REPOS,
) -> DataFrame:
    """One row per row of ``docs``: base counts and digest, all spans, and the candidates with their verdicts.

    ``docs`` needs doc_id, text and what owner and repo name; by default the
    source owns, and each document is a repository.
    """
    owner = docs["source"] if owner is None else owner
    repo = docs["doc_id"] if repo is None else repo
    scanned = materialise(scan(docs, owner, repo).withColumn("_row", F.monotonically_increasing_id()), "secrets")
    each = scanned.select("_row", F.explode("candidates").alias("c")).select("_row", "c.*")
    # written, so that the join shuffles both sides by itself and a hot value can be split
    held = materialise(ownership(scanned), "ownership")
    judged = each.join(held, "hash").withColumn("verdict", verdict(example_owners, example_repos))
    span = F.concat_ws(":", "kind", "from", "to")
    of = lambda v: F.count_if(F.col("verdict") == v)
    per_row = judged.groupBy("_row").agg(
        of("live").alias("n_live"),
        of("example").alias("n_example"),
        of("unclear").alias("n_unclear"),
        F.max("n_owners").alias("most_owners"),
        F.array_sort(F.collect_list(F.struct("from", "to", "kind", "verdict", "n_owners", "n_repos", "hash"))).alias("found"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.when(F.col("verdict") == "live", F.struct("from", span.alias("s"))))),
                lambda x: x["s"],
            ),
            ",",
        ).alias("live_spans"),
    )
    zero = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("n_live", "n_example", "n_unclear", "most_owners")}
    return scanned.join(per_row, "_row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", *zero.values(),
        F.coalesce("live_spans", F.lit("")).alias("live_spans"), "found",
    )

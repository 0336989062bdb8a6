"""Document fingerprints by consistent weighted sampling.

Each term of a text has a weight, its count. For every one of ``SAMPLES``
samples and every term, gamma variables that depend on the term and the sample
alone give a quantised weight and a rank; the term of the least rank, with its
quantised weight, is the sample. Two texts agree in a sample with a probability
of their generalised Jaccard similarity. A fingerprint is 16 bits per sample.

The variables are made once per distinct term of a batch, and terms of weight
1, by far the most, need only their ready ranks.

The edited text takes its end from the next document by doc_id. Documents are
dealt into ranges of doc_id, each sorted; a copy of the following range's
first document closes a range, so that texts are shuffled once and no task
sees more than its ranges.

Defined cases: a null text counts as empty; empty texts have the fingerprint
``''``, are alike among each other (1.0) and unlike all others (0.0); a text
without word characters is made of its single characters; a null doc_id comes
last; rows with one doc_id follow each other in the order of their texts; a
single document is its own next one.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storespark.llm.common import arrow_ready, text_or_empty

SAMPLES = 64
#: A term is a run of word characters; longer runs, as in scripts without spaces, are cut.
TERM = re.compile(r"\w{1,16}")
ROWS_PER_RANGE, RANGES_PER_PARTITION = 20_000, 4
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def terms(text: str) -> Counter:
    found = Counter(TERM.findall(text.lower()))
    return found or Counter(text)


def term_hash(term: str) -> int:
    data = term.encode("utf-8", "surrogatepass")
    return zlib.crc32(data) << 32 | zlib.crc32(data, 0x5BD1E995)


def _uniforms(hashes: np.ndarray, lane: int, samples: int) -> tuple[np.ndarray, np.ndarray]:
    """Two (terms, samples) arrays of numbers in (0, 1), fixed by term, lane and sample."""
    x = hashes[:, None] + (np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(4) + np.uint64(lane))[None, :] * _STEP
    x ^= x >> np.uint64(30)
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    scale = np.float32(2.0**-32)
    low = (x & np.uint64(0xFFFFFFFF)).astype(np.float32) * scale
    high = (x >> np.uint64(32)).astype(np.float32) * scale
    least = np.float32(2.0**-33)
    return np.clip(low, least, 1 - np.float32(2**-24)), np.clip(high, least, 1 - np.float32(2**-24))


class Sampler:
    """The variables of a set of terms, and the samples of weighted sets of them."""

    def __init__(self, vocabulary: list[str], samples: int) -> None:
        self.place = {t: i for i, t in enumerate(vocabulary)}
        self.hashes = np.array([term_hash(t) for t in vocabulary], dtype=np.uint64)
        a, b = _uniforms(self.hashes, 0, samples)
        self.r = -np.log(a * b)
        a, b = _uniforms(self.hashes, 1, samples)
        self.log_c = np.log(-np.log(a * b))
        self.beta, _ = _uniforms(self.hashes, 2, samples)
        self.rank_of_one = self.log_c + self.r * (self.beta - 1)
        self.samples = samples

    def fingerprint(self, counted: Counter) -> str:
        if not counted:
            return ""
        once = [self.place[t] for t, n in counted.items() if n == 1]
        more = [(self.place[t], n) for t, n in counted.items() if n > 1]
        best = np.full(self.samples, np.inf, np.float32)
        code = np.zeros(self.samples, np.uint64)
        columns = np.arange(self.samples)
        if once:
            rank = self.rank_of_one[once]
            least = rank.argmin(axis=0)
            best, code = rank[least, columns], self.hashes[np.array(once)[least]]
        if more:
            own = np.array([i for i, _ in more])
            weight = np.log(np.array([n for _, n in more], dtype=np.float32))[:, None]
            r, beta = self.r[own], self.beta[own]
            t = np.floor(weight / r + beta)
            rank = self.log_c[own] - r * (t - beta) - r
            least = rank.argmin(axis=0)
            better = rank[least, columns] < best
            picked = self.hashes[own[least]] + t[least, columns].astype(np.int64).astype(np.uint64) * _STEP
            code = np.where(better, picked, code)
        code = (code ^ (code >> np.uint64(32))) * _MIX[0]
        return (code >> np.uint64(48)).astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal samples, less what equal 16-bit codes of unequal samples add."""
    if not a or not b:
        return float(a == b)
    x, y = np.frombuffer(bytes.fromhex(a), ">u2"), np.frombuffer(bytes.fromhex(b), ">u2")
    equal, chance = float((x == y).mean()), 2.0**-16
    return max(0.0, (equal - chance) / (1 - chance))


def edited(text: str, following: str) -> str:
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


OUTPUT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprinter(samples: int):
    """A mapInArrow function over ranges in order; the last row of a range only closes it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # (range, doc_id, text): its next document comes with the next batch
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("_range", "_closing", "doc_id", "text"))))
            texts = ([before] if before else []) + [(r, d, t) for r, _, d, t in rows]
            closing = ([False] if before else []) + [c for _, c, _, _ in rows]
            pairs = [(a, b) for a, b, shut in zip(texts, texts[1:], closing) if not shut]
            before = None if not texts or closing[-1] else texts[-1]
            changed = [edited(a[2], b[2]) for a, b in pairs]
            counted = {t: terms(t) for t in {x for a, b in pairs for x in (a[2], b[2])} | set(changed)}
            sampler = Sampler(list({w for c in counted.values() for w in c}), samples)
            marks = {t: sampler.fingerprint(c) for t, c in counted.items()}
            out = [
                {
                    "doc_id": a[1],
                    "n_chars": len(a[2]),
                    "edited_sha256": hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(),
                    "fingerprint": marks[a[2]],
                    "edited_fingerprint": marks[e],
                    "near_edited": likeness(marks[a[2]], marks[e]),
                    "near_next": likeness(marks[a[2]], marks[b[2]]),
                }
                for (a, b), e in zip(pairs, changed)
            ]
            if out:
                yield pa.RecordBatch.from_pylist(out)

    return run


def in_ranges(docs: DataFrame, n_ranges: int) -> DataFrame:
    """_range, _closing, doc_id, text: ranges of doc_id, each closed by the first document of the following one.

    Per range, a bound and a least id come to the driver.
    """
    bounds = sorted(set(docs.approxQuantile("doc_id", [i / n_ranges for i in range(1, n_ranges)], 0.25 / n_ranges)))
    rows = docs.select(
        F.col("doc_id").cast("bigint"), text_or_empty().alias("text"), F.coalesce(F.col("doc_id").cast("double"), F.lit(float("nan"))).alias("_id")
    )
    rows = Bucketizer(
        splits=[-np.inf, *(bounds or [0.0]), np.inf], inputCol="_id", outputCol="_range", handleInvalid="keep"
    ).transform(rows).drop("_id")
    rows = rows.withColumn("_range", F.col("_range").cast("int"))
    least = rows.groupBy("_range").agg(F.min("doc_id").alias("doc_id")).orderBy("_range").collect()
    if not least:
        return rows.withColumn("_closing", F.lit(False))
    before = [least[-1]["_range"], *(r["_range"] for r in least[:-1])]  # the last range is closed by the first document
    closes = F.create_map(*[F.lit(x) for r, b in zip(least, before) for x in (r["_range"], b)])
    ids = [r["doc_id"] for r in least if r["doc_id"] is not None]
    firsts = rows.where(F.col("doc_id").isin(ids) | (F.col("doc_id").isNull() & F.lit(len(ids) < len(least))))
    firsts = firsts.groupBy("_range").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text")).alias("f"))
    closing = firsts.select(
        F.element_at(closes, F.col("_range")).alias("_range"), F.lit(True).alias("_closing"), "f.doc_id", "f.text"
    )
    return rows.select("_range", F.lit(False).alias("_closing"), "doc_id", "text").unionByName(closing)


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): fingerprints of the text and of its edited form, and likenesses."""
    spark = docs.sparkSession
    arrow_ready(spark, 250)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_ranges = max(parts * RANGES_PER_PARTITION, docs.count() // ROWS_PER_RANGE)
    dealt = in_ranges(docs, n_ranges).repartition("_range")
    ordered = dealt.sortWithinPartitions("_range", "_closing", F.col("doc_id").isNull(), "doc_id", "text")
    return ordered.mapInArrow(fingerprinter(samples), OUTPUT)

"""Language identification by bit-sliced Bloom filters over letter n-grams.

Row j of the filter holds one bit per language. An n-gram's k rows, ANDed,
give the mask of all languages whose filter contains it. A document's masks
are counted per language, each count is corrected by the share of false
positives that its language's filling predicts, and the largest count decides.

A language's n-grams are those found in at least ``MIN_SHARE`` of its
documents and not far more often in another language. Document frequencies
come from a bounded sample of labelled documents (``PER_LANGUAGE`` each, by
hash of the id); prediction reads every whole text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
a text whose n-grams no filter knows takes the most frequent language, score
0; without any labelled document every text is ``und``. Ties take the language
first in order. Rows alike are predicted separately; an empty table gives an
empty result; texts of any length are read whole; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storespark.llm.common import fold, arrow_ready

GRAMS = (3, 4)
PER_LANGUAGE, MIN_SHARE, RIVAL_SHARE = 3000, 0.03, 0.3
ROWS_PER_GRAM, HASHES = 24, 4
UNDETERMINED = "und"

LETTER = np.array([chr(i).isalpha() for i in range(0x10000)])
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, each run of others one space; empty without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    known = LETTER[np.minimum(points, 0xFFFF)]
    high = points > 0xFFFF
    if high.any():
        known = known.copy()
        known[high] = [chr(p).isalpha() for p in points[high]]
    if not known.any():
        return points[:0]
    padded = np.concatenate(([32], np.where(known, points, 32), [32])).astype(np.uint64)
    return padded[np.concatenate(([True], (padded[1:] != 32) | (padded[:-1] != 32)))]


def gram_hashes(points: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every n-gram, all lengths."""
    found = []
    for n in GRAMS:
        if len(points) < n:
            continue
        h = np.full(len(points) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            h = (h ^ points[i : len(points) - n + 1 + i]) * ODD[0]
            h ^= h >> np.uint64(29)
        found.append(h)
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def rows_of(hashes: np.ndarray, n_rows: int) -> list[np.ndarray]:
    mask = np.uint64(n_rows - 1)
    return [((hashes * odd) >> np.uint64(33)) & mask for odd in ODD[:HASHES]]


class Model(NamedTuple):
    languages: list[str]
    rows: np.ndarray  # (n_rows, words) of uint64 masks
    false_rate: np.ndarray
    fallback: int


def build(languages: list[str], grams: list[np.ndarray], fallback: int) -> Model:
    """Fill the bit slices: language l sets bit l of the rows its n-grams name."""
    most = max((len(g) for g in grams), default=1)
    n_rows = 1 << max(10, int(np.ceil(np.log2(max(1, most) * ROWS_PER_GRAM))))
    rows = np.zeros((n_rows, -(-len(languages) // 64) or 1), dtype=np.uint64)
    for i, own in enumerate(grams):
        for place in rows_of(own, n_rows):
            np.bitwise_or.at(rows[:, i // 64], place.astype(np.int64), np.uint64(1) << np.uint64(i % 64))
    filled = [np.count_nonzero(rows[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)) / n_rows for i in range(len(languages))]
    return Model(languages, rows, np.array(filled) ** HASHES, fallback)


def counts(model: Model, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Corrected counts per document and language; ``starts`` are the documents' first hashes, none empty."""
    n_rows = len(model.rows)
    places = [p.astype(np.int64) for p in rows_of(hashes, n_rows)]
    n = np.diff(np.append(starts, len(hashes)))
    out = np.empty((len(starts), len(model.languages)))
    for word in range(model.rows.shape[1]):
        slices = model.rows[:, word]
        masks = slices[places[0]]
        for p in places[1:]:
            masks = masks & slices[p]
        for i in range(word * 64, min(word * 64 + 64, len(model.languages))):
            hits = np.add.reduceat((masks >> np.uint64(i % 64)) & np.uint64(1), starts)
            wrong = model.false_rate[i]
            out[:, i] = np.maximum(0.0, (hits - n * wrong) / (1 - wrong))
    return out


def frequency_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n_docs) of each batch: documents of a language that hold the n-gram."""
    for batch in batches:
        by: dict[str, list[np.ndarray]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            by.setdefault(lang, []).append(np.unique(gram_hashes(letters(text or ""))))
        for lang, parts in by.items():
            grams, n = np.unique(np.concatenate(parts), return_counts=True)
            if len(grams):
                yield pa.RecordBatch.from_pydict(
                    {"lang": [lang] * len(grams), "gram": grams.view(np.int64), "n": n.astype(np.int64)}
                )


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on at most about ``per_language`` documents of each language outside fold 0.

    To the driver come the languages and the n-grams that a ``MIN_SHARE`` of a language's sampled documents hold.
    """
    arrow_ready(docs.sparkSession)
    labelled = docs.where(F.col("lang").isNotNull() & (fold(F.col("doc_id")) != 0)).select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.zeros((1, 1), np.uint64), np.zeros(0), 0)
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, per_language / n)))])
    drawn = (F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 20)) / (1 << 20)) < F.element_at(share, F.col("lang"))
    sample = labelled.where(drawn)
    seen = sample.groupBy("lang").count()
    found = sample.select("lang", "text").mapInArrow(frequency_batches, "lang string, gram bigint, n bigint")
    frequent = found.groupBy("lang", "gram").agg(F.sum("n").alias("n")).join(F.broadcast(seen), "lang")
    frequent = frequent.where(F.col("n") >= F.greatest(F.lit(2), F.col("count") * MIN_SHARE)).withColumn(
        "share", F.col("n") / F.col("count")
    )
    # the n-grams left are few per language, as each must be in MIN_SHARE of its documents
    rival = F.max("share").over(Window.partitionBy("gram"))
    rows = (
        frequent.withColumn("_most", rival)
        .where(F.col("share") >= F.col("_most") * RIVAL_SHARE)
        .select("lang", "gram")
        .toPandas()
    )
    languages = sorted(sizes)
    by = {k: g["gram"].to_numpy(np.int64).view(np.uint64) for k, g in rows.groupby("lang")}
    most = max(range(len(languages)), key=lambda i: sizes[languages[i]])
    return build(languages, [by.get(k, np.empty(0, np.uint64)) for k in languages], most)


def predictor(shared):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            points = [letters(t) if t else np.empty(0, np.uint64) for t in texts]
            hashes = [gram_hashes(p) if model.languages else p[:0] for p in points]
            worth = [i for i, h in enumerate(hashes) if len(h)]
            if worth:
                starts = np.cumsum([0] + [len(hashes[i]) for i in worth[:-1]])
                found = counts(model, np.concatenate([hashes[i] for i in worth]), starts)
                best, total = found.argmax(axis=1), found.sum(axis=1)
                for row, i in enumerate(worth):
                    known = total[row] > 0
                    lang[i] = model.languages[best[row] if known else model.fallback]
                    score[i] = found[row, best[row]] / total[row] if known else 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lang), pa.array(score)], names=["doc_id", "lang_pred", "score"]
            )

    return predict


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of every row; only doc_id and text are read."""
    arrow_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(predictor(shared), "doc_id bigint, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    """Train on the labelled rows of ``docs`` outside fold 0 and predict all rows."""
    return identify(docs, train(docs)).select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score"
    )

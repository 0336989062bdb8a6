"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features come from one Arrow pass over whole texts: how dense words of the
fixed and of a learned lexicon are, how near they stand to words that address
the reader, capitals, punctuation, and how many words are spelled so as to hide
(digits or signs for letters, stretched letters, spaced-out letters).

The learned lexicon, the trees and the calibration are fitted on labelled
documents outside fold 0, at most about ``MOST_LABELLED`` of them by hash of
the id, equal texts once. Words, word beginnings and families (a beginning of
several different words of one text) enter the lexicon by a lower bound of
their log odds, however many there are. The sample has ``PARTS`` parts: the
features of a part come from the lexicon of the other parts, and the
calibration sees each part as scored by trees fitted on the others. So neither
trees nor calibration trust a word for the very texts it was learned from.

Defined cases: a null or empty text has all features 0 and is scored like any
other; without labels of both kinds, as in an empty table, every score is 0;
labels with a null doc_id or a null mark are not learned from, and of repeated
labels, and of labels of equal texts, the largest counts; rows alike are scored
separately; texts of any length are read whole; further columns are not read. A
row is dropped by its own text: rows with another text under a repeated or
null doc_id stay.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storespark.llm.common import fold, materialise, arrow_ready, row_name, text_or_empty

MOST_LABELLED, PARTS = 12_000, 3
#: A unit is learned from so many texts on, if its log odds less so many standard errors pass the bound.
LEAST_TEXTS, ERRORS, LEAST_LOG_ODDS = 2, 1.3, 0.7
TREES, DEPTH = 15, 4
CLEAN_PRIOR = 0.1

#: Insults and words of contempt in the four languages of the corpus.
LEXICON = frozenset(
    """
    idiot idiots idiotic moron morons moronic stupid dumb fool trash garbage scum filth filthy loser losers pathetic
    worthless disgusting clown clowns imbecile cretin jerk bastard vermin parasite pig swine retard ugly freak
    crap damn hateful
    trottel dummkopf arschloch vollidiot abschaum versager dreck mistkerl depp schwachkopf widerlich erbärmlich
    connard crétin imbécile débile abruti ordure salaud minable dégoûtant raclure
    idiota imbécil estúpido estúpida basura escoria perdedor payaso asqueroso cabrón inútil tonto
    """.split()
)
ADDRESS = frozenset("you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta vous votre tú ti usted vosotros".split())
#: Signs that stand for letters.
HIDDEN = str.maketrans("0134578@$!|+", "oieastbasiit")
WORD = re.compile(r"[^\W_](?:[\w'@$!|*+-]*[^\W_])?")
SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][ .*_-]){3,}[^\W\d_](?!\w)")
STRETCHED = re.compile(r"(.)\1{2,}")
BEGINNINGS = (4, 5, 6, 7)
PLAIN = re.compile(r"[^\W_]+")
#: Learned words stand beside the fixed lexicon, near an addressed reader or in disguise, from these log odds on.
CERTAIN = 2.5
NEAR = 6
FEATURES = (
    "log_words", "lexicon_density", "lexicon_log", "learned_density", "learned_log", "learned_strongest", "family_strongest", "family_log", "address_density",
    "near_address", "capital_share", "shouted_share", "exclaim_density", "punctuation_density", "disguised_share",
    "disguised_hits", "stretched_share", "spaced_runs", "other_share",
)


def units(word: str) -> list[str]:
    """A word and its beginnings, as the learned lexicon knows them."""
    return [word, *(f"{word[:n]}~" for n in BEGINNINGS if len(word) > n)]


def all_units(text: str) -> set[str]:
    """The distinct units of a text, with the beginnings that several of its words have (families)."""
    words = {w.lower() for w in PLAIN.findall(text)}
    begun = Counter(w[:n] for w in words for n in BEGINNINGS if len(w) > n)
    return words | {f"{b}~" for b in begun} | {f"{b}~~" for b, n in begun.items() if n > 1}


class Words:
    """What a word says by itself; distinct words are looked up once per worker."""

    def __init__(self, learned: dict[str, float]) -> None:
        self.known: dict[str, tuple] = {}
        self.learned = {u: x for u, x in learned.items() if not u.endswith("~")}
        self.begun = {u[:-1]: x for u, x in learned.items() if u.endswith("~") and not u.endswith("~~")}
        self.families = {u[:-2]: x for u, x in learned.items() if u.endswith("~~")}
        self.beginnings = self.begun.keys() | self.families.keys()

    def look(self, word: str) -> tuple:
        """(in the fixed lexicon, strongest learned odds, disguised, a disguised hit, stretched, shouted, a hit of some
        kind, addresses the reader, lower case, learned families)."""
        low = word.lower()
        plain, odds = low in LEXICON, self.learned.get(low, 0.0)
        families: tuple[str, ...] = ()
        for n in BEGINNINGS:
            if len(low) <= n:
                break
            beginning = low[:n]
            if beginning in self.beginnings:
                odds = max(odds, self.begun.get(beginning, 0.0))
                if beginning in self.families:
                    families += (beginning,)
        disguised = hidden = stretched = False
        if not low.isalpha() or STRETCHED.search(low):
            shown = low.translate(HIDDEN).replace("*", "").replace("-", "").replace("'", "")
            disguised = shown != low and any(c.isalpha() for c in low) and not low.isalpha()
            narrow = STRETCHED.sub(r"\1", shown)
            stretched = bool(STRETCHED.search(low))
            hidden = not plain and odds == 0.0 and (disguised or stretched) and any(
                w in LEXICON or self.learned.get(w, 0.0) >= CERTAIN for w in {shown, narrow}
            )
        hit = plain or odds >= CERTAIN or hidden
        address = not hit and len(word) < 9 and low in ADDRESS
        found = (plain, odds, disguised, hidden, stretched, len(word) > 2 and word.isupper(), hit, address, low, families)
        if len(self.known) > 300_000:
            self.known.clear()
        self.known[word] = found
        return found


def features(text: str, words: Words) -> list[float]:
    found = WORD.findall(text)
    n = len(found)
    if not text:
        return [0.0] * len(FEATURES)
    begun: dict[str, set[str]] = {}
    plain = learned = disguised = hidden = stretched = shouted = 0
    strongest, hitting, addressing = 0.0, set(), set()
    known, look = words.known.get, words.look
    for word, times in Counter(found).items():
        fixed, odds, masked, unmasked, drawn, loud, hit, address, low, families = known(word) or look(word)
        if odds > 0:
            learned += times
            strongest = max(strongest, odds)
        if masked or drawn:
            disguised += masked * times
            hidden += unmasked * times
            stretched += drawn * times
        if loud:
            shouted += times
        if hit:
            plain += fixed * times
            hitting.add(word)
        elif address:
            addressing.add(word)
        for family in families:
            begun.setdefault(family, set()).add(low)
    hits = [i for i, word in enumerate(found) if word in hitting] if hitting else []
    address = [i for i, word in enumerate(found) if word in addressing] if hitting and addressing else []
    n_address = sum(map(addressing.__contains__, found)) if addressing else 0
    several = {f: w for f, w in begun.items() if len(w) > 1}
    near, a = 0, 0
    for i in hits:
        while a < len(address) and address[a] < i - NEAR:
            a += 1
        near += a < len(address) and address[a] <= i + NEAR
    runs = SPACED.findall(text)
    for run in runs:
        hidden += re.sub(r"\W|_", "", run).lower() in LEXICON
    signs = Counter(text)
    letters = sum(times for sign, times in signs.items() if sign.isalpha())
    capitals = sum(times for sign, times in signs.items() if sign.isupper())
    spaces = signs[" "] + signs["\n"]
    per = 1.0 / max(1, n)
    return [
        math.log1p(n),
        plain * per,
        math.log1p(plain),
        learned * per,
        math.log1p(learned),
        strongest,
        max((words.families[f] for f in several), default=0.0),
        math.log1p(len(set().union(*several.values()))),
        n_address * per,
        near / len(hits) if hits else 0.0,
        capitals / max(1, letters),
        shouted * per,
        signs["!"] * per,
        sum(map(signs.__getitem__, ".,;:!?")) * per,
        disguised * per,
        math.log1p(hidden),
        stretched * per,
        float(len(runs)) * per,
        (len(text) - letters - spaces) / len(text),
    ]


def featuriser(shared):
    """Features of the last column's texts; a column ``part``, where there is one, tells which lexicon counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = [Words(learned) for learned in shared.value]
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            parts = batch.column("part").to_pylist() if "part" in batch.schema.names else [-1] * len(texts)
            rows = np.array([features(t, words[p]) for t, p in zip(texts, parts)], dtype=np.float64)
            flat = pa.array(rows.reshape(-1))
            listed = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], listed], names=[*batch.schema.names[:-1], "features"])

    return run


def with_features(rows: DataFrame, lexicons: list[dict[str, float]], others: str) -> DataFrame:
    """``others`` names, with types, the columns that stand before the text; the last lexicon is that of all parts."""
    arrow_ready(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(lexicons)
    return rows.mapInArrow(featuriser(shared), f"{others}, features array<double>")


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """toxic, part, text of at most about ``most`` labelled documents outside fold 0, equal texts once."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & (fold(F.col("doc_id")) != 0))
    marks = marks.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    share = min(1.0, most / max(1, marks.count()))
    drawn = (F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 20)) / (1 << 20)) < share
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    once = texts.join(marks.where(drawn), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    part = F.pmod(F.xxhash64(F.lit("part"), "text"), F.lit(PARTS)).cast("int").alias("part")
    return materialise(once.select("toxic", part, "text"), "labelled")


def unit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(unit, part, toxic, n): texts of a batch that hold a unit."""
    for batch in batches:
        found: Counter = Counter()
        for toxic, part, text in zip(*(batch.column(c).to_pylist() for c in ("toxic", "part", "text"))):
            found.update((u, part, toxic) for u in all_units(text))
        if found:
            units_, parts, marks = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(units_), pa.array(parts, pa.int32()), pa.array(marks, pa.int32()), pa.array(list(found.values()), pa.int64())],
                names=["unit", "part", "toxic", "n"],
            )


def surest_odds(toxic: np.ndarray, clean: np.ndarray, all_toxic: int, all_clean: int) -> np.ndarray:
    """Lower bounds of the log odds that a text with the unit is toxic."""
    odds = np.log((toxic + 0.5) / (all_toxic + 1.0)) - np.log((clean + 0.5) / (all_clean + 1.0))
    return odds - ERRORS * np.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def learn_lexicons(sample: DataFrame) -> list[dict[str, float]]:
    """For each part the units learned from the others, and at the end those learned from all.

    To the driver come only units that toxic texts hold more often than chance lets expect.
    """
    arrow_ready(sample.sparkSession)
    sizes = {(r["part"], r["toxic"]): r["count"] for r in sample.groupBy("part", "toxic").count().collect()}
    size = lambda mark: np.array([sizes.get((p, mark), 0) for p in range(PARTS)])
    all_toxic, all_clean = size(1), size(0)
    counted = sample.mapInArrow(unit_counts, "unit string, part int, toxic int, n bigint")
    of = lambda p, mark: F.sum(F.when((F.col("part") == p) & (F.col("toxic") == mark), F.col("n")).otherwise(0))
    sums = [of(p, mark).alias(f"{name}{p}") for name, mark in (("t", 1), ("c", 0)) for p in range(PARTS)]
    held = counted.groupBy("unit").agg(*sums)
    t, c = (sum(F.col(f"{name}{p}") for p in range(PARTS)) for name in "tc")
    # the laxest lexicon leaves out the part with most clean texts that hold the unit; more is not needed on the driver
    rare = F.greatest(*[F.col(f"c{p}") for p in range(PARTS)])
    odds = F.log((t + 0.5) / F.lit(float(all_toxic.sum() + 1))) - F.log((c - rare + 0.5) / F.lit(float(all_clean.sum() + 1)))
    found = held.where((t >= LEAST_TEXTS) & (odds >= LEAST_LOG_ODDS)).toPandas().sort_values("unit")
    own_t, own_c = (found[[f"{name}{p}" for p in range(PARTS)]].to_numpy() for name in "tc")
    lexicons = []
    for part in [*range(PARTS), None]:
        keep = np.array([p != part for p in range(PARTS)])
        toxic, clean = own_t[:, keep].sum(axis=1), own_c[:, keep].sum(axis=1)
        sure = surest_odds(toxic, clean, all_toxic[keep].sum(), all_clean[keep].sum())
        held_by = (toxic >= LEAST_TEXTS) & (sure >= LEAST_LOG_ODDS)
        lexicons.append(dict(zip(found["unit"][held_by], sure[held_by].tolist())))
    return lexicons


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED):
    """(learned lexicon, trees, calibration), or None without labels of both kinds."""
    sample = labelled_sample(docs, labels, most)
    if sample.select("toxic").distinct().count() < 2:
        return None
    lexicons = learn_lexicons(sample)
    rows = with_features(sample.select("toxic", "part", "text"), lexicons, "toxic int, part int")
    rows = rows.select(array_to_vector("features").alias("features"), F.col("toxic").cast("double").alias("label"), "part")
    rows = materialise(rows, "toxic-features").coalesce(4)  # a bounded sample of narrow rows
    classifier = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, stepSize=0.3, seed=7, minInstancesPerNode=3)
    scored = []
    for part in range(PARTS):
        others, own = rows.where(F.col("part") != part), rows.where(F.col("part") == part)
        if others.select("label").distinct().count() < 2:
            others = rows
        scored.append(classifier.fit(others).transform(own).select(raw_score().alias("raw"), "label", F.lit(1.0).alias("weight")))
    raw = materialise(reduce(DataFrame.unionByName, scored), "toxic-scores").coalesce(4)
    # a share of each row counts as clean, so that a step made of two or three rows does not decide
    prior = raw.select("raw", F.lit(0.0).alias("label"), F.lit(CLEAN_PRIOR).alias("weight"))
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight").fit(raw.union(prior))
    return lexicons[-1], classifier.fit(rows), calibration


def raw_score():
    return F.element_at(vector_to_array("probability"), 2)


def score(docs: DataFrame, model) -> DataFrame:
    """doc_id, name, score and predicted of every row; only doc_id and text are read."""
    name = row_name(docs["doc_id"], docs["text"]).alias("name")
    rows = docs.select(F.col("doc_id").cast("bigint"), name, text_or_empty().alias("text"))
    if model is None:
        return rows.select("doc_id", "name", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    learned, trees, calibration = model
    scored = with_features(rows, [learned], "doc_id bigint, name string").withColumn("features", array_to_vector("features"))
    scored = trees.transform(scored).select("doc_id", "name", raw_score().alias("raw"))
    value = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("prediction")))
    return (
        calibration.setFeaturesCol("raw")
        .transform(scored)
        .select("doc_id", "name", value.alias("score"), F.when(value >= 0.5, 1).otherwise(0).alias("predicted"))
    )


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labels outside fold 0 and score all rows."""
    return score(docs, train(docs, labels)).select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted"
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic; texts are shuffled once, by row name."""
    bad = score(docs, train(docs, labels)).where("predicted = 1").select(F.col("name").alias("_bad")).distinct()
    return docs.join(bad, row_name(docs["doc_id"], docs["text"]) == bad["_bad"], "left_anti")

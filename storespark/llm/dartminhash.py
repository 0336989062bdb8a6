"""Near duplicates by DartMinHash signatures and banded joins.

A text is a weighted set: its shingles of five words, each with its count as
weight. Darts are thrown at every unit of weight: their arrival times along a
rank axis follow from hashes of shingle, unit and throw alone, so two texts
share the darts of the weight they share. Only darts up to a rank bound that
leaves about k ln k of them are thrown; each falls on one of k coordinates,
which keeps its earliest. The cost is the number of shingles plus the number
of darts, not their product with k. Where a coordinate stays empty, the bound
doubles. Two signatures agree in a coordinate with a probability of their
weighted Jaccard similarity.

Links are found by bands of the signature and verified exactly on the
shingles. Texts with equal words are one text first. Within a bucket every
text is compared with the bucket's hub, the member that shares most buckets
with others. Buckets of up to ``FEW`` members that still hold several classes
are then compared in full. Texts of larger ones that do are joined by an exact
prefix filter: of two similar sets, the smaller holds one of the larger's
rarest units among its own very rarest, and the place of that unit bounds the
larger's size. Unit and size band make the key of the join, so a passage that
thousands of texts have in common brings none of them together unless it makes
them similar. Groups of one key meet their two hubs first; then only members of
different classes are compared, all of them, so no similar pair is passed over.

Defined cases: a null text counts as empty; texts with less than five words
are one shingle of all their words, those without a word are one class; a null
doc_id comes last when a class picks its smallest; rows alike are one class; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storespark.llm.common import kept_rows, materialise, row_name, arrow_ready, text_or_empty

WORDS, THRESHOLD = 5, 0.8
COORDINATES, BANDS, ROWS = 128, 32, 4
#: members of a bucket that is compared in full
FEW = 8
#: Differing bits of two 128-bit sketches that a pair at the threshold exceeds with a chance below 1e-6.
MOST_BITS = 31
#: Bounds on counts give way by so much, as products with the threshold are rounded.
SLACK = 1e-6
#: Sizes of a band are within this factor.
SIZE_STEP = 1.03
WORD = re.compile(r"\w+")
#: Texts are worked on together up to so many words; a longer text is worked on by itself.
RUN_WORDS = 200_000
_A, _B, _C = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words, kept per worker."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def of(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > 500_000:
            known.clear()
        for w in set(words).difference(known):
            known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return np.fromiter((known[w] for w in words), dtype=np.uint64, count=len(words))


def unit_runs(words: np.ndarray, starts: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Units of weight of several texts, sorted within each, and where each text's units start.

    A unit is a hash of a shingle and of its how-manieth occurrence it is. ``words`` are the words' hashes of all texts
    one after the other; ``starts`` has one entry more than there are texts.
    """
    sizes = np.diff(starts)
    counts = np.where(sizes >= n, sizes - n + 1, (sizes > 0).astype(sizes.dtype))
    ends = np.concatenate(([0], np.cumsum(counts)))
    owner = np.repeat(np.arange(len(sizes)), counts)
    first = starts[owner] + (np.arange(ends[-1]) - ends[owner])
    width = np.minimum(sizes, n)[owner]
    shingles = np.zeros(len(owner), dtype=np.uint64)
    for i in range(n):
        if (width > i).all():
            shingles = mixed(shingles + words[first + i] + _C)
        else:
            more = np.flatnonzero(width > i)
            shingles[more] = mixed(shingles[more] + words[first[more] + i] + _C)
    for x, y in zip(ends[:-1].tolist(), ends[1:].tolist()):
        shingles[x:y].sort()
    new = np.ones(len(shingles), dtype=bool)
    new[1:] = shingles[1:] != shingles[:-1]
    new[ends[:-1][counts > 0]] = True
    place = np.arange(len(shingles))
    nth = place - np.maximum.accumulate(np.where(new, place, 0))
    return mixed(shingles + nth.astype(np.uint64) * _C), ends


def units(words: np.ndarray, n: int = WORDS) -> np.ndarray:
    """Units of weight of one text."""
    return unit_runs(words, np.array([0, len(words)]), n)[0]


def signatures(weight: np.ndarray, ends: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """The name of the earliest dart per text and coordinate; every text has at least one unit.

    Darts are thrown for all texts at once. Texts with an empty coordinate throw again up to twice the rank.
    """
    sizes = np.diff(ends)
    out, todo = np.empty((len(sizes), k), dtype=np.uint64), np.arange(len(sizes))
    bound = k * (np.log(k) + 3) / sizes
    while len(todo):
        owner = np.repeat(np.arange(len(todo)), sizes[todo])
        alive = weight if len(todo) == len(sizes) else np.concatenate([weight[ends[t] : ends[t + 1]] for t in todo])
        rank, most, throw = np.zeros(len(alive)), bound[todo], 0
        names, ranks, slots = [], [], []
        while len(alive):
            throw += 1
            darts = mixed(alive + np.uint64(throw * int(_C) % 2**64))
            rank = rank - np.log(((darts >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            near = rank <= most[owner]
            alive, rank, darts, owner = alive[near], rank[near], darts[near], owner[near]
            name = mixed(darts ^ _B)
            names.append(name)
            ranks.append(rank)
            slots.append(owner * k + (name % np.uint64(k)).astype(np.int64))
        names, ranks, slots = np.concatenate(names), np.concatenate(ranks), np.concatenate(slots)
        late_first = np.argsort(-ranks, kind="stable")
        earliest = np.full(len(todo) * k, -1)
        earliest[slots[late_first]] = late_first  # of several darts the last one written, the earliest, stays
        earliest = earliest.reshape(len(todo), k)
        full = (earliest >= 0).all(axis=1)
        out[todo[full]] = names[earliest[full]]
        bound[todo] *= 2
        todo = todo[~full]
    return out


def signature(weight: np.ndarray, k: int = COORDINATES) -> np.ndarray:
    """The signature of one text of at least one unit."""
    return signatures(weight, np.array([0, len(weight)]), k)[0]


def runs_of_texts(texts: list[str], words: WordHashes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word hashes of texts one after the other, up to about ``RUN_WORDS`` words at a time, and where each text starts."""
    held, starts = [], [0]
    for text in texts:
        held += WORD.findall(text.lower())
        starts.append(len(held))
        if len(held) >= RUN_WORDS:
            yield words.of(held), np.array(starts)
            held, starts = [], [0]
    if len(starts) > 1:
        yield words.of(held), np.array(starts)


def sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    spread = np.arange(1, BANDS + 1, dtype=np.uint64) * _C
    for batch in batches:
        same, bits, bands = [], [], []
        for hashes, starts in runs_of_texts(batch.column("text").to_pylist(), words):
            same += [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).hexdigest() for a, b in zip(starts[:-1], starts[1:])]
            own, ends = unit_runs(hashes, starts)
            some = np.flatnonzero(np.diff(ends))
            sign = signatures(own, np.append(ends[some], ends[-1])) if len(some) else np.empty((0, COORDINATES), np.uint64)
            packed = np.packbits((sign >> np.uint64(20) & np.uint64(1)).astype(bool), axis=1).view(np.int64)
            keys = np.tile(spread, (len(some), 1))
            for i in range(ROWS):
                keys = mixed(keys + sign.reshape(-1, BANDS, ROWS)[:, :, i])
            of_text = dict(zip(some.tolist(), zip(packed.tolist(), keys.view(np.int64).tolist())))
            for i in range(len(starts) - 1):
                own_bits, own_bands = of_text.get(i, ([0, 0], []))
                bits.append(own_bits)
                bands.append(own_bands)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("name"), pa.array(same, pa.string()), pa.array(bits, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
            names=["doc_id", "name", "same", "bits", "bands"],
        )


def unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = WordHashes()
    for batch in batches:
        found = []
        for hashes, starts in runs_of_texts(batch.column("text").to_pylist(), words):
            own, ends = unit_runs(hashes, starts)
            found += [np.sort(own[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(found, pa.binary())], names=["rep", "units"])


def similarity_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            shared = len(np.intersect1d(a, b, assume_unique=True))
            out.append(shared / max(1, len(a) + len(b) - shared))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], names=["a", "b", "similarity"])


def shingle_units(members: DataFrame, names: DataFrame, texts: DataFrame) -> DataFrame:
    """(rep, units) of every representative in a bucket; ``names`` has (rep, name), ``texts`` (name, text).

    The texts are shuffled once, for all rounds.
    """
    held = names.join(members.select("rep").distinct(), "rep")
    named = texts.join(held, "name").dropDuplicates(["rep"]).select("rep", "text")
    return materialise(named.mapInArrow(unit_batches, "rep bigint, units binary"), "units")


def verified(pairs: DataFrame, own: DataFrame, threshold: float) -> DataFrame:
    """Of distinct pairs (a, b) of representatives, those whose shingles are similar enough.

    Hubs with many partners are split by the joins.
    """
    both = pairs.join(own.select(F.col("rep").alias("a"), F.col("units").alias("x")), "a").join(
        own.select(F.col("rep").alias("b"), F.col("units").alias("y")), "b"
    )
    found = both.select("a", "b", "x", "y").mapInArrow(similarity_batches, "a bigint, b bigint, similarity double")
    return materialise(found.where(F.col("similarity") >= threshold), "links")


def components(links: DataFrame) -> DataFrame:
    """(v, class) for every end of a link (a, b): the smallest of its connected component.

    Labels fall to the smallest neighbour's and then to their label's label, a round each,
    so rounds grow with the logarithm of a chain's length.
    """
    edges = links.select(F.col("a").alias("v"), F.col("b").alias("w")).union(links.select("b", "a"))
    edges = materialise(edges.distinct(), "edges")
    labels = materialise(edges.groupBy("v").agg(F.least("v", F.min("w")).alias("class")), "classes")
    while True:
        near = edges.join(labels.withColumnRenamed("v", "w"), "w").groupBy("v").agg(F.min("class").alias("near"))
        lower = labels.join(near, "v").select("v", F.least("class", "near").alias("low"), F.col("class").alias("old"))
        lower = materialise(lower, "classes")
        of_label = lower.select(F.col("v").alias("low"), F.col("low").alias("lowest"))
        stepped = materialise(
            lower.join(of_label, "low").select("v", F.col("lowest").alias("class"), (F.col("lowest") < F.col("old")).alias("moved")),
            "classes",
        )
        labels = stepped.select("v", "class")
        if stepped.where("moved").isEmpty():
            return labels


def merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """Classes (rep, class) after further links (a, b); only classes that a link joins are looked at."""
    of = lambda c: classes.select(F.col("rep").alias(c), F.col("class").alias(f"{c}_class"))
    placed = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    between = placed.select(F.coalesce("a_class", "a").alias("a"), F.coalesce("b_class", "b").alias("b")).where("a <> b").distinct()
    found = components(between).select(F.col("v").alias("class"), F.col("class").alias("lower"))
    moved = classes.join(found, "class", "left").select("rep", F.coalesce("lower", "class").alias("class"))
    single = found.select(F.col("class").alias("rep"), F.col("lower").alias("class")).join(classes.select("rep"), "rep", "left_anti")
    return materialise(moved.unionByName(single), "merged")


def differing_bits(x: str, y: str) -> Column:
    halves = [F.bit_count(F.get(F.col(x), i).bitwiseXOR(F.get(F.col(y), i))) for i in (0, 1)]
    return halves[0] + halves[1]


def hub_pairs(members: DataFrame, most_bits: int) -> DataFrame:
    """Each member of a bucket with the bucket's hub.

    Sums per bucket are written before they meet the members, so that hot buckets can be split.
    """
    sizes = materialise(members.groupBy("key").count(), "bucket-sizes")
    spread = members.join(sizes, "key").groupBy("rep").agg(F.sum("count").alias("spread"))
    ranked = members.join(materialise(spread, "spread"), "rep")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("spread", -F.col("rep"), "rep", "bits")).alias("h"))
    hubs = materialise(hubs.select("key", F.col("h.rep").alias("hub"), F.col("h.bits").alias("hub_bits")), "hubs")
    pairs = members.join(hubs, "key").where((F.col("rep") != F.col("hub")) & (differing_bits("bits", "hub_bits") <= most_bits))
    return pairs.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()


def several_classes(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of buckets that hold several classes, with the ``size`` of their bucket."""
    placed = members.join(classes, "rep", "left").withColumn("class", F.coalesce("class", "rep"))
    placed = materialise(placed, "placed-members")
    sizes = placed.groupBy("key").agg(F.min("class").alias("_low"), F.max("class").alias("_high"), F.count(F.lit(1)).alias("size"))
    several = materialise(sizes.where("_low <> _high").select("key", "size"), "several-keys")
    return materialise(placed.join(several, "key"), "several")


def few_pairs(placed: DataFrame, most_bits: int) -> DataFrame:
    """All pairs of different classes in buckets of up to ``FEW`` members."""
    small = placed.where(F.col("size") <= FEW)
    one, two = (small.select("key", *[F.col(c).alias(f"{c}{i}") for c in ("rep", "bits", "class")]) for i in (1, 2))
    apart = (F.col("rep1") < F.col("rep2")) & (F.col("class1") != F.col("class2"))
    pairs = one.join(two, "key").where(apart & (differing_bits("bits1", "bits2") <= most_bits))
    return pairs.select(F.col("rep1").alias("a"), F.col("rep2").alias("b")).distinct()


def listed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rep, held in zip(batch.column("rep").to_pylist(), batch.column("units").to_pylist()):
            found = np.frombuffer(held, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), rep)), pa.array(np.full(len(found), len(found))), pa.array(found)],
                names=["rep", "n", "unit"],
            )


def by_frequency(own: DataFrame, threshold: float) -> DataFrame:
    """(rep, n, unit, place): of n units, in order of how many texts hold them, the first n - threshold * n + 1.

    A partner shares at least threshold * n of them, so one of these, in any order that all texts keep to. Units that
    one text alone holds have their places, but no rows.
    """
    held = materialise(own.mapInArrow(listed_batches, "rep bigint, n bigint, unit bigint"), "shingles")
    shared = materialise(held.groupBy("unit").agg(F.count(F.lit(1)).alias("frequency")).where("frequency > 1"), "frequencies")
    common = held.join(shared, "unit")
    by_rep = W.partitionBy("rep")
    alone = F.col("n") - F.count(F.lit(1)).over(by_rep)
    place = alone + F.row_number().over(by_rep.orderBy("frequency", "unit"))
    placed = common.select("rep", "n", "unit", place.alias("place"))
    return materialise(placed.where(F.col("place") <= first_places(threshold)), "prefixes")


def first_places(share: float) -> Column:
    """How many first places a partner that shares ``share`` of the n units cannot all miss."""
    return F.col("n") - F.ceil(F.col("n") * share - SLACK) + 1


def size_band(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / np.log(SIZE_STEP))


def meeting_places(first: DataFrame, threshold: float) -> DataFrame:
    """(unit, band, rep, n, place, small): rows of one unit and band may be similar if one is the ``small`` side.

    Of a pair of n1 >= n2 units at least (n1 + n2) * t / (1 + t) are shared, and no more than stand from the first
    shared unit on. So the smaller holds that unit among fewer places than the larger, and its place bounds n1: as the
    smaller side a row stands in the bands of all sizes that its place allows for, as the larger one in its own.
    """
    share = threshold / (1 + threshold)
    most = (F.col("n") - F.col("place") + 1 + SLACK) / share - F.col("n")
    # the highest band may begin a little early, as logarithms are rounded
    bands = F.sequence(size_band(F.col("n")), size_band(F.greatest(F.col("n"), most) * (1 + SLACK)))
    small = first.where(F.col("place") <= first_places(2 * share)).select("*", F.explode(bands).alias("band"), F.lit(True).alias("small"))
    return small.unionByName(first.select("*", size_band(F.col("n")).alias("band"), F.lit(False).alias("small")))


def groups_of_several(rows: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of meeting places that hold several classes, with their class, and each such place's main class and hubs.

    The main class is the one with most rows; ``hub`` is of it, ``other`` of the others.
    """
    placed = rows.join(classes, "rep", "left").withColumn("class", F.coalesce("class", "rep"))
    placed = materialise(placed, "placed-prefixes")
    counted = placed.groupBy("unit", "band", "class").agg(F.count(F.lit(1)).alias("rows"), F.min("rep").alias("first"), F.max("small").alias("small"))
    sides = F.struct("rows", -F.col("class"), F.col("class").alias("main"), F.col("first").alias("hub"))
    groups = counted.groupBy("unit", "band").agg(F.max(sides).alias("m"), F.max("small").alias("small"), F.count(F.lit(1)).alias("classes"))
    groups = materialise(groups.where("small and classes > 1").select("unit", "band", "m.main", "m.hub"), "places")
    here = materialise(placed.join(groups, ["unit", "band"]), "meeting")
    drawn = F.struct(F.xxhash64("rep", F.lit("other")), "rep")
    others = here.where("class <> main").groupBy("unit", "band").agg(F.min(drawn)["rep"].alias("other"))
    return here, materialise(others, "others")


def star_pairs(here: DataFrame, others: DataFrame) -> DataFrame:
    """Every row outside its place's main class with the place's hub, and with one more row outside."""
    outside = here.where("class <> main").select("unit", "band", "rep", "hub").distinct()
    both = outside.join(others, ["unit", "band"]).select("rep", F.explode(F.array("hub", "other")).alias("with")).where("rep <> with")
    return both.select(F.least("rep", "with").alias("a"), F.greatest("rep", "with").alias("b")).distinct()


def cross_pairs(here: DataFrame, threshold: float) -> DataFrame:
    """All pairs of different classes at one place whose sizes and places allow for the threshold.

    Of two classes at a place one is not its main class, so rows of the main class never meet each other.
    """
    sides = {}
    for i in (1, 2):
        sides[i] = here.select("unit", "band", *[F.col(c).alias(f"{c}{i}") for c in ("rep", "class", "n", "place", "small", "main")])
    least = (F.col("n1") + F.col("n2")) * (threshold / (1 + threshold)) - SLACK
    follow = F.least(F.col("n1") - F.col("place1"), F.col("n2") - F.col("place2")) + 1
    # side 2 is the smaller one; which side lies outside the main class decides where a pair comes from
    near = (F.col("class1") != F.col("class2")) & (F.col("n1") >= F.col("n2")) & (F.col("rep1") != F.col("rep2")) & (follow >= least)
    large, small = sides[1].where("not small1").drop("small1"), sides[2].where("small2").drop("small2")
    a = large.where("class1 <> main1").drop("main1").join(small.drop("main2"), ["unit", "band"]).where(near)
    b = large.where("class1 = main1").drop("main1").join(small.where("class2 <> main2").drop("main2"), ["unit", "band"]).where(near)
    pairs = a.select("rep1", "rep2").union(b.select("rep1", "rep2"))
    return pairs.select(F.least("rep1", "rep2").alias("a"), F.greatest("rep1", "rep2").alias("b")).distinct()


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, most_bits: int = MOST_BITS) -> DataFrame:
    """doc_id, class_id, class_size, n_links, kept, name: one row per row of ``docs`` (doc_id, text).

    ``class_id`` is the smallest doc_id of the class; the first row with it is kept. ``n_links`` counts the other texts
    with which the row's text was compared and found similar; within a class not all pairs are compared.
    """
    arrow_ready(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("bigint"), text_or_empty().alias("text"), row_name(docs["doc_id"], docs["text"]).alias("name")
    )
    sketched = rows.mapInArrow(
        sketch_batches, "doc_id bigint, name string, same string, bits array<bigint>, bands array<bigint>"
    )
    sketched = materialise(sketched.withColumn("_row", F.monotonically_increasing_id()), "sketches")
    # texts with equal words are one text, named by the smallest row
    groups = sketched.groupBy("same").agg(F.min("_row").alias("rep"))
    groups = materialise(groups, "texts")
    first = sketched.join(groups.select(F.col("rep").alias("_row")), "_row", "left_semi")
    first = materialise(first.select(F.col("_row").alias("rep"), "name", "bits", "bands"), "representatives")
    members = first.select("rep", "bits", F.explode("bands").alias("key"))
    shared = materialise(members.groupBy("key").count().where("count > 1").select("key"), "shared-keys")
    members = materialise(members.join(shared, "key"), "buckets")
    own = shingle_units(members, first.select("rep", "name"), rows.select("name", "text"))
    tried = materialise(hub_pairs(members, most_bits), "pairs")
    links = verified(tried, own, threshold).select("a", "b")
    classes = components(links).withColumnRenamed("v", "rep")

    def compared(pairs: DataFrame) -> None:
        nonlocal tried, links, classes
        pairs = materialise(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        found = verified(pairs, own, threshold).select("a", "b")
        tried, links, classes = tried.unionByName(pairs), links.unionByName(found), merged(classes, found)

    compared(few_pairs(several_classes(members, classes), most_bits))
    large = several_classes(members, classes).where(F.col("size") > FEW).select("rep").distinct()
    first = by_frequency(own.join(large, "rep", "left_semi"), threshold)
    places = materialise(meeting_places(first, threshold), "meeting-places")
    compared(star_pairs(*groups_of_several(places, classes)))
    compared(cross_pairs(groups_of_several(places, classes)[0], threshold))
    degrees = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    classes = materialise(classes.join(degrees, "rep", "left"), "classes-with-links")
    by_text = groups.join(classes, "rep", "left").select(
        "same", F.coalesce("class", "rep").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    by_text = materialise(by_text, "classes-of-texts")
    placed = materialise(sketched.join(by_text, "same").select("_row", "doc_id", "name", "class", "n_links"), "placed")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    named = placed.groupBy("class").agg(F.min(order).alias("f"), F.count(F.lit(1)).alias("class_size"))
    # written, so that the join below shuffles by itself and a hot class can be split
    named = materialise(
        named.select("class", "class_size", F.col("f.doc_id").alias("class_id"), F.col("f._row").alias("_first")), "named"
    )
    return placed.join(named, "class").select(
        "doc_id", "class_id", "class_size", "n_links", (F.col("_row") == F.col("_first")).alias("kept"), "name"
    )


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns."""
    stay = near_duplicates(docs, **options).where("kept").select(F.col("name").alias("_name")).distinct()
    return kept_rows(docs, row_name(docs["doc_id"], docs["text"]), stay)

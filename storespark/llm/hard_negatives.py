"""Hard negatives from blocks of vectors in Hilbert order, chosen by zone maps.

Vectors become whole numbers and are written, label by label and along a
Hilbert curve through the dimensions that vary most, as Parquet rows of one
block each: up to ``BLOCK_ROWS`` neighbours of one label, packed. A zone map
holds the least and largest component of each block and dimension.

Every search is interval arithmetic first: with an anchor's components and a
block's zones, the sum of the smaller and the sum of the larger products bound
all scores in the block. An anchor reads only blocks whose bounds meet what it
looks for: its own block gives five scores of its label to start with, and
blocks that cannot beat them are left out. A window of negative scores first
reads the few blocks with the highest bounds, and then those that can still
beat the tenth score found. Nothing that could count is passed over.

Anchors travel to blocks in packed groups, those of one block together, so a
task holds one block and one group at a time. Groups meet zone maps in packs
of ``ZONES``, by an equi-join on the pack's number.

Defined cases: rows without a label, id or vector, or with a null or
non-finite component, take no part; shorter vectors are zero beyond their
end; whole components beyond +-2^40 and scores beyond +-2^61 count as those
bounds; rows that repeat an id are separate rows, but no other rows to each
other; of a repeated anchor the row first in the blocks' order is the anchor; an
empty table gives an empty result; of further columns none is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storespark.llm.common import arrow_ready, materialise

SCALE, LABELS, EVERY, RELABELLED = 256, 10, 100, 7
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these hundredths of the positive's.
LOWEST, HIGHEST = 30, 90
BLOCK_ROWS, ZONES, FIRST_BLOCKS = 2048, 1024, 4
#: The curve runs through so many dimensions, with so many bits each.
CURVE_DIMENSIONS, CURVE_BITS = 8, 4
LARGEST = 2**40
FAR = 2**61
BLOCK = "block bigint, label bigint, n int, ids binary, vectors binary, low binary, high binary, anchors binary, starts binary"
GROUP = "grp bigint, label bigint, anchors binary, vectors binary, low binary, high binary"
PACK = "pack bigint, n int, blocks binary, labels binary, zone_low binary, zone_high binary"
CHOSEN = "block bigint, rank int, grp bigint, anchors binary, vectors binary, low binary, high binary"
PLACE = "grp bigint, place int, anchor_id bigint"
FOUND = "anchor_id bigint, slot int, id bigint, score bigint"


def as_records(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def packed(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, dtype=np.int64).tobytes()


def unpacked(data: bytes, rows: int | None = None) -> np.ndarray:
    found = np.frombuffer(data, dtype=np.int64)
    return found if rows is None else found.reshape(rows, -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers: by floating point where that is exact, else by integers."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2**62:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, -FAR, FAR).astype(np.int64)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that a vector between ``low`` and ``high`` can have with each row of ``a``."""
    plus, minus = np.maximum(a, 0), np.minimum(a, 0)
    return products(plus, low) + products(minus, high), products(plus, high) + products(minus, low)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell coordinates below 2 ** bits; coordinates x bits <= 62."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    # from axes to the transposed index: undo the rotations from the highest bit down, then decode the Gray code
    for bit in (1 << np.arange(bits - 1, 0, -1)).tolist():
        for i in range(n):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & (bit - 1))
            x[0] = np.where(flip, x[0] ^ (bit - 1), x[0]) ^ swap
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in (1 << np.arange(bits - 1, 0, -1)).tolist():
        turn ^= np.where(x[n - 1] & bit, bit - 1, 0)
    x ^= turn
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            place = place << 1 | x[i] >> bit & 1
    return place


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and whole-numbered vector of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    # the bound is applied before the cast, as larger doubles have no whole number of 64 bits
    bounded = F.transform(
        x, lambda c: F.floor(F.greatest(F.lit(float(-LARGEST)), F.least(F.lit(float(LARGEST)), c * SCALE))).cast("long")
    )
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % RELABELLED == 0, (label + 1) % LABELS).otherwise(label)
    return rows.select(F.col("vec_id").cast("long"), label.alias("label"), bounded.alias("v"))


def curve_of(rows: DataFrame) -> tuple[int, list[int], np.ndarray, np.ndarray]:
    """Length of the vectors, the dimensions that vary most, and their least and largest values; a row a dimension."""
    each = rows.select(F.posexplode("v").alias("i", "x"))
    stats = each.groupBy("i").agg(F.min("x").alias("low"), F.max("x").alias("high"), F.variance(F.col("x").cast("double")).alias("spread"))
    found = sorted(stats.collect(), key=lambda r: (-(r["spread"] or 0.0), r["i"]))
    used = found[:CURVE_DIMENSIONS]
    length = max((r["i"] for r in found), default=-1) + 1
    return length, [r["i"] for r in used], np.array([r["low"] for r in used]), np.array([r["high"] for r in used])


def padded(batch: pa.RecordBatch, length: int) -> np.ndarray:
    column = batch.column("v")
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.value_lengths())
    if len(sizes) and (sizes == length).all():
        return flat.reshape(len(sizes), length)
    out = np.zeros((len(sizes), length), dtype=np.int64)
    for row, part in zip(out, np.split(flat, np.cumsum(sizes)[:-1])):
        row[: len(part)] = part
    return out


def placer(length: int, used: list[int], low: np.ndarray, high: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.maximum(1, high - low + 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = ((padded(batch, length)[:, used] - low) * (1 << CURVE_BITS) // width) if used else np.zeros((batch.num_rows, 1), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("v"), pa.array(hilbert(np.clip(cells, 0, (1 << CURVE_BITS) - 1), CURVE_BITS))],
                names=["vec_id", "label", "v", "place"],
            )

    return run


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id."""
    if len(scores) > 4 * k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def block_row(number: int, label: int, ids: np.ndarray, v: np.ndarray) -> tuple:
    """One packed block, with its anchors and where each one's search for positives may start."""
    places = np.flatnonzero(ids % EVERY == 0)
    starts = np.full(len(places), -FAR)
    if len(ids) > POSITIVES:
        found = products(v[places], v)
        for row, anchor in enumerate(ids[places]):
            others = found[row][ids != anchor]
            if len(others) >= POSITIVES:
                starts[row] = np.partition(others, len(others) - POSITIVES)[len(others) - POSITIVES]
    low, high = v.min(axis=0), v.max(axis=0)
    return (number, label, len(ids), packed(ids), packed(v), packed(low), packed(high), packed(places), packed(starts))


def blocker(length: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, v, label = np.empty(0, np.int64), np.empty((0, length), np.int64), None
        for batch in batches:
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            own_ids, own = batch.column("vec_id").to_numpy(zero_copy_only=False), padded(batch, length)
            edges = np.append(np.flatnonzero(np.diff(labels)) + 1, len(labels))
            start = 0
            for end in edges.tolist():
                if start == end:
                    continue
                if label is not None and labels[start] != label and len(ids):
                    yield as_records(BLOCK, [block_row(number, label, ids, v)])
                    number, ids, v = number + 1, ids[:0], v[:0]
                label = int(labels[start])
                ids, v = np.concatenate((ids, own_ids[start:end])), np.concatenate((v, own[start:end]))
                while len(ids) >= rows:
                    yield as_records(BLOCK, [block_row(number, label, ids[:rows], v[:rows])])
                    number, ids, v = number + 1, ids[rows:], v[rows:]
                start = end
        if len(ids):
            yield as_records(BLOCK, [block_row(number, label, ids, v)])

    return run


def write_blocks(vectors: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """The packed blocks with their zone maps, as a written Parquet table."""
    arrow_ready(vectors.sparkSession, 2000)
    whole = materialise(usable(vectors), "vectors")
    length, used, low, high = curve_of(whole)
    placed = whole.mapInArrow(placer(length, used, low, high), "vec_id bigint, label bigint, v array<bigint>, place bigint")
    placed = placed.repartitionByRange("label", "place", "vec_id").sortWithinPartitions("label", "place", "vec_id", "v")
    return materialise(placed.mapInArrow(blocker(length, rows), BLOCK), "blocks")


def anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors of each block as one group, looking for positives: scores from the start upwards."""
    for batch in batches:
        for r in batch.to_pylist():
            places, starts = unpacked(r["anchors"]), unpacked(r["starts"])
            if not len(places):
                continue
            ids, v = unpacked(r["ids"])[places], unpacked(r["vectors"], r["n"])[places]
            top = np.full(len(ids), FAR)
            yield as_records(GROUP, [(r["block"], r["label"], packed(ids), packed(v), packed(starts), packed(top))])


def zone_packs(blocks: DataFrame) -> tuple[DataFrame, int]:
    """The zone maps as packed rows of about ``ZONES`` blocks, numbered from 0, and how many there are."""
    zones = materialise(blocks.select("block", "label", "low", "high"), "zones")
    packs = max(1, -(-zones.count() // ZONES))
    dealt = zones.withColumn("pack", F.pmod(F.xxhash64("block"), F.lit(packs)))
    ordered = dealt.repartition("pack").sortWithinPartitions("pack", "block")
    return materialise(ordered.mapInArrow(pack_batches, PACK), "zone-packs"), packs


def pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted zone maps to a row per pack; a pack may lie over several batches."""
    pack, own = None, []

    def row() -> pa.RecordBatch:
        blocks, labels = (packed(np.array([r[c] for r in own])) for c in ("block", "label"))
        low, high = (b"".join(r[c] for r in own) for c in ("low", "high"))
        return as_records(PACK, [(pack, len(own), blocks, labels, low, high)])

    for batch in batches:
        for r in batch.to_pylist():
            if r["pack"] != pack and own:
                yield row()
                own = []
            pack = r["pack"]
            own.append(r)
    if own:
        yield row()


def chooser(same_label: bool):
    """Blocks that each group has to read: those whose bounds meet an anchor's range of scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                anchors, n = unpacked(r["anchors"]), r["n"]
                v, zone_low, zone_high = unpacked(r["vectors"], len(anchors)), unpacked(r["zone_low"], n), unpacked(r["zone_high"], n)
                low, high = (unpacked(r[c], len(anchors)) for c in ("low", "high"))
                least, most = bounds(v, zone_low, zone_high)
                # an anchor's ranges are joined here; the reader looks at each by itself
                open_range = low <= high
                floor = np.where(open_range, low, FAR).min(axis=1)
                roof = np.where(open_range, high, -FAR).max(axis=1)
                fits = (unpacked(r["labels"]) == r["label"]) == same_label
                reach = fits & (most >= floor[:, None]) & (least <= roof[:, None])
                order = np.argsort(np.argsort(np.where(reach, -np.minimum(most, roof[:, None]), FAR), axis=1, kind="stable"), axis=1)
                for j, block in enumerate(unpacked(r["blocks"]).tolist()):
                    for first in (True, False):
                        own = np.flatnonzero(reach[:, j] & ((order[:, j] < FIRST_BLOCKS) == first))
                        if len(own):
                            parts = (anchors[own], v[own], low[own], high[own])
                            yield as_records(CHOSEN, [(block, int(not first), r["grp"], *map(packed, parts))])

    return run


def reader(k: int, slots: int):
    """The k best rows of a block for every range of every anchor of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                anchors = unpacked(r["anchors"])
                low, high = (unpacked(r[c], len(anchors)).reshape(len(anchors), slots) for c in ("low", "high"))
                ids, block = unpacked(r["ids"]), unpacked(r["block_vectors"], r["n"])
                found = products(unpacked(r["vectors"], len(anchors)), block)
                rows: list[tuple] = []
                for i, anchor in enumerate(anchors.tolist()):
                    for slot in range(slots):
                        near = np.flatnonzero((found[i] >= low[i, slot]) & (found[i] <= high[i, slot]) & (ids != anchor))
                        top = near[best(found[i][near], ids[near], k)]
                        rows += [(anchor, slot, a, b) for a, b in zip(ids[top].tolist(), found[i][top].tolist())]
                if rows:
                    yield as_records(FOUND, rows)

    return run


def choose(groups: DataFrame, zones: tuple[DataFrame, int], same_label: bool) -> DataFrame:
    """(block, rank, group with the anchors that read it); rank 0 holds each anchor's ``FIRST_BLOCKS`` of a pack."""
    packs, n = zones
    dealt = groups.withColumn("pack", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    return materialise(dealt.join(packs, "pack").drop("pack").mapInArrow(chooser(same_label), CHOSEN), "chosen")


def read(chosen: DataFrame, blocks: DataFrame, k: int, slots: int) -> DataFrame:
    """(anchor_id, slot, id, score): the k best of each block read; only chosen blocks are joined."""
    packed_blocks = blocks.select("block", "n", "ids", F.col("vectors").alias("block_vectors"))
    return chosen.drop("rank").join(packed_blocks, "block").mapInArrow(reader(k, slots), FOUND)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best over all blocks of every slot, with their ``rank``."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def regroup(groups: DataFrame, ranges: DataFrame, slots: int) -> DataFrame:
    """The groups with other ranges: ``ranges`` has (anchor_id, slot, low, high), up to ``slots`` an anchor.

    Anchors without a range are left out.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = unpacked(r["anchors"])
                v = unpacked(r["vectors"], len(ids))
                yield as_records("grp bigint, label bigint, anchor_id bigint, vector binary", [(r["grp"], r["label"], i, packed(x)) for i, x in zip(ids.tolist(), v)])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                own = sorted(r["own"], key=lambda o: o["anchor_id"])
                low, high = np.full((len(own), slots), FAR), np.full((len(own), slots), -FAR)
                for i, o in enumerate(own):
                    for s in o["ranges"]:
                        low[i, s["slot"]], high[i, s["slot"]] = s["low"], s["high"]
                ids = np.array([o["anchor_id"] for o in own])
                yield as_records(GROUP, [(r["grp"], r["label"], packed(ids), b"".join(o["vector"] for o in own), packed(low), packed(high))])

    single = groups.select("grp", "label", "anchors", "vectors").mapInArrow(spread, "grp bigint, label bigint, anchor_id bigint, vector binary")
    # at most ``slots`` ranges an anchor, and at most a block's rows a group
    by_anchor = ranges.groupBy("anchor_id").agg(F.collect_list(F.struct("slot", "low", "high")).alias("ranges"))
    held = single.join(by_anchor, "anchor_id").groupBy("grp", "label").agg(F.collect_list(F.struct("anchor_id", "vector", "ranges")).alias("own"))
    return materialise(held.mapInArrow(gather, GROUP), "groups")


def first_of_repeated(groups: DataFrame) -> DataFrame:
    """Leaves out anchors that another group, or an earlier place of the same one, holds already."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = unpacked(r["anchors"])
                yield as_records(PLACE, [(r["grp"], p, i) for p, i in enumerate(ids.tolist())])

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                drop = set(r["drop"] or ())
                ids = unpacked(r["anchors"])
                keep = np.array([p for p in range(len(ids)) if p not in drop], dtype=np.int64)
                if len(keep):
                    v, low, high = (unpacked(r[c], len(ids))[keep] for c in ("vectors", "low", "high"))
                    yield as_records(GROUP, [(r["grp"], r["label"], *map(packed, (ids[keep], v, low, high)))])

    each = groups.mapInArrow(listed, PLACE)
    repeated = each.groupBy("anchor_id").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("grp", "place")).alias("f")).where("_n > 1")
    doubles = each.join(repeated, "anchor_id").where((F.col("grp") != F.col("f.grp")) | (F.col("place") != F.col("f.place")))
    dropped = doubles.groupBy("grp").agg(F.collect_list("place").alias("drop"))
    return materialise(groups.join(dropped, "grp", "left").mapInArrow(without, GROUP), "anchors")


def hundredths(score: str, of: int, up: bool) -> Column:
    """Column ``score`` times of / 100, rounded up or down, in whole numbers that cannot overflow."""
    whole, rest = F.expr(f"({score} - pmod({score}, 100)) div 100"), F.pmod(F.col(score), F.lit(100)) * of
    return whole * of + (F.ceil(rest / 100) if up else F.floor(rest / 100)).cast("long")


def hard_negatives(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``vectors`` needs vec_id, embedding and label. Rows whose id is divisible by ``EVERY`` are anchors.
    """
    blocks = write_blocks(vectors, block_rows)
    zones = zone_packs(blocks)
    anchors = first_of_repeated(materialise(blocks.mapInArrow(anchor_batches, GROUP), "anchor-groups"))
    positives = materialise(ranked(read(choose(anchors, zones, True), blocks, POSITIVES, 1), POSITIVES), "positives")
    positives = positives.select("anchor_id", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    window = positives.select(
        "anchor_id", "slot", hundredths("positive_score", LOWEST, True).alias("low"), hundredths("positive_score", HIGHEST, False).alias("high")
    )
    window = materialise(window.where("low <= high"), "windows")
    chosen = choose(regroup(anchors, window, POSITIVES), zones, False)
    first = materialise(ranked(read(chosen.where("rank = 0"), blocks, NEGATIVES, POSITIVES), NEGATIVES), "first-negatives")
    # from the tenth score found on, other blocks can only count with as much or more
    tenth = first.where(F.col("rank") == NEGATIVES).select("anchor_id", "slot", F.col("score").alias("_least"))
    raised = window.join(tenth, ["anchor_id", "slot"], "left").select("anchor_id", "slot", F.greatest("low", F.coalesce("_least", "low")).alias("low"), "high")
    again = choose(regroup(anchors, raised, POSITIVES), zones, False)
    done = chosen.where("rank = 0").select("block", "grp", F.col("anchors").alias("_done"))
    rest = again.join(done, ["block", "grp"], "left").mapInArrow(_not_done, CHOSEN)
    later = materialise(read(rest, blocks, NEGATIVES, POSITIVES), "later-negatives")
    negatives = ranked(first.drop("rank").unionByName(later), NEGATIVES)
    return negatives.join(positives, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _not_done(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a group, the anchors that have not read the block in the first pass."""
    for batch in batches:
        for r in batch.to_pylist():
            ids = unpacked(r["anchors"])
            keep = np.flatnonzero(~np.isin(ids, unpacked(r["_done"] or b"")))
            if len(keep):
                v, low, high = (unpacked(r[c], len(ids))[keep] for c in ("vectors", "low", "high"))
                yield as_records(CHOSEN, [(r["block"], r["rank"], r["grp"], *map(packed, (ids[keep], v, low, high)))])

"""Conversation prefixes as a z-fast trie over turns, built from joins.

A conversation is a string whose letters are turns (role, text). The trie is
compacted: a node is a prefix where conversations part or end, and its edge
reaches from below its parent's depth to its own. Every node is known by a
hash of its handle, the prefix whose depth is the one in the edge's range that
is divisible by the highest power of two. To find where a conversation leaves
the trie, a fat binary search asks for handles at such depths only: a hit goes
on below the node found, a miss above the depth asked for, so the number of
joins grows with the logarithm of the longest conversation. One look at the
node's child and at one edge then gives the exact depth.

Sequences come in batches. A batch is located in the trie, only what lies
below the exits is grouped, edges are cut where something leaves them, and
handles are renewed on edges that changed. Equal conversations are one
sequence with a number of copies before they enter.

Prefixes are named by two 64-bit sums, over their turns, of hashes of depth
and turn, so prefix names come from running sums: of blocks of ``BLOCK`` turns,
with the sums of earlier blocks added. A conversation of any length is thus
numbered, summed and searched by many tasks. Sums over subtrees are sums over
(sequence, compacted node) pairs. Of ids that end at one node, each task joins
up to ``IDS`` to one text, and the digest is fed with these in order.

Defined cases: turns without a conv_id belong to no conversation; null turns
come first; turns alike in number follow by role, then text; null role or text
is empty; repeated rows are turns of their own; without conversations there
is no root and the result is empty; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storespark.llm.common import arrow_ready, materialise

FAMILY, SHARED = 5, 9
BLOCK, IDS, BATCHES = 1024, 4096, 2
KEY = ["d", "k1", "k2"]
NOTHING = hashlib.sha256(b"").hexdigest()
LOW = 0xFFFFFFFF


def named(prefix: str, *columns: str) -> list[Column]:
    return [F.col(c).alias(f"{prefix}{c}") for c in columns]


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), turn digest and bytes of text of every turn.

    Rows are dealt by ranges of their order, so that a conversation may lie in several; counts of what lies in earlier
    ranges, a row per range and conversation, make the places.
    """
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint"), "turn", role.alias("role"), text.alias("text")
    )
    # beginnings are enough to spread rows of one turn, and keep the sample of ranges small
    beginnings = [F.substring(c, 1, 32) for c in ("role", "text")]
    ranged = rows.repartitionByRange("conv_id", "turn", *beginnings).sortWithinPartitions("conv_id", "turn", "role", "text")
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    ordered = ranged.select(
        "conv_id", digest.alias("digest"), F.octet_length("text").cast("bigint").alias("bytes"), F.monotonically_increasing_id().alias("_at")
    )
    ordered = materialise(ordered, "turns").withColumn("_part", F.shiftright("_at", 33))
    spans = ordered.groupBy("conv_id", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("conv_id").orderBy("_part")) - F.col("_n")
    spans = materialise(spans.withColumn("_before", before), "spans")
    places = ordered.join(spans, ["conv_id", "_part"])
    return materialise(
        places.select("conv_id", (F.col("_at") - F.col("_first") + F.col("_before") + 1).alias("place"), "digest", "bytes"), "places"
    )


def shared_beginnings(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) and the turns (conv_id, d, digest, bytes) of conversations that begin like their family's first.

    A conversation's first h turns give way to those of the first of its ``FAMILY`` ids, h by a hash of its id.
    """
    sizes = materialise(turns.groupBy("conv_id").agg(F.max("place").alias("n")), "sizes")
    own = sizes.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn(
        "h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    )
    first = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("_first"))
    given = F.least("h", F.coalesce("_first", F.lit(0)))
    plan = own.join(first, "base", "left").withColumn("given", given)
    plan = materialise(plan.withColumn("length", F.col("given") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "plan")
    heads = turns.where(F.col("place") < SHARED).withColumnRenamed("conv_id", "base").join(plan, "base")
    heads = heads.where("place <= given").select("conv_id", F.col("place").alias("d"), "digest", "bytes")
    tails = turns.join(plan, "conv_id").where("place > h")
    tails = tails.select("conv_id", (F.col("place") - F.col("h") + F.col("given")).alias("d"), "digest", "bytes")
    return plan.select("conv_id", "length"), materialise(heads.unionByName(tails), "rebuilt")


def as_they_are(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) and the turns of conversations that are taken as they are."""
    lengths = materialise(turns.groupBy("conv_id").agg(F.max("place").alias("length")), "sizes")
    return lengths, turns.withColumnRenamed("place", "d")


def prefixes(lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """conv_id, d, name of the prefix (k1, k2) and of the one before (p1, p2), bytes of its last text and of all its texts."""
    lanes = [f"_s{i}" for i in range(4)]
    hashed = turns.select(
        "conv_id", "d", "bytes", F.floor((F.col("d") - 1) / BLOCK).alias("_block"),
        *[F.shiftrightunsigned(F.xxhash64(F.lit(f"trie{i}"), "d", "digest"), 32).alias(s) for i, s in enumerate(lanes)],
    )
    upto = Window.partitionBy("conv_id", "_block").orderBy("d")
    inside = hashed.select("*", F.sum("bytes").over(upto).alias("_upto"), *[F.sum(s).over(upto).alias(f"{s}u") for s in lanes])
    # only conversations of several blocks have earlier ones
    long = lengths.where(F.col("length") > BLOCK).select("conv_id")
    totals = hashed.join(long, "conv_id").groupBy("conv_id", "_block").agg(*[F.sum(c).alias(c) for c in ("bytes", *lanes)])
    earlier = Window.partitionBy("conv_id").orderBy("_block")
    offsets = totals.select("conv_id", "_block", *[(F.sum(c).over(earlier) - F.col(c)).alias(f"{c}e") for c in ("bytes", *lanes)])
    offsets = materialise(offsets, "offsets")
    full = inside.join(offsets, ["conv_id", "_block"], "left")
    sums = [F.col(f"{s}u") + F.coalesce(f"{s}e", F.lit(0)) for s in lanes]
    pair = lambda a, b: F.shiftleft(a.bitwiseAND(LOW), 32).bitwiseOR(b.bitwiseAND(LOW))
    less = [x - F.col(s) for x, s in zip(sums, lanes)]
    return materialise(
        full.select(
            "conv_id", F.col("d").cast("bigint"), pair(sums[0], sums[1]).alias("k1"), pair(sums[2], sums[3]).alias("k2"),
            pair(less[0], less[1]).alias("p1"), pair(less[2], less[3]).alias("p2"), "bytes",
            (F.col("_upto") + F.coalesce("bytese", F.lit(0))).alias("upto"),
        ),
        "prefixes",
    )


class Trie(NamedTuple):
    """``nodes``: depth and name of each compacted node but the root, a sequence through it (owner), its parent's depth
    and name (td, t1, t2), bytes of the texts up to it and up to its parent, the first prefix of its edge (n1, n2) and
    its handle (hd, h1, h2). ``paths``: the prefixes (rep, d, ...) of all sequences in it.
    """

    nodes: DataFrame
    paths: DataFrame


def fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that is divisible by the highest power of two."""
    power = F.pow(F.lit(2.0), F.floor(F.log2(low.bitwiseXOR(high).cast("double")))).cast("bigint")
    return high - high % power


def locate(trie: Trie, sequences: DataFrame, paths: DataFrame) -> DataFrame:
    """Where each sequence (rep, length) leaves the trie.

    rep, length, lcp (depth it shares with the trie), its prefix's name and bytes there (a1, a2, reached), and the edge
    it leaves by: name of the lower node (ed, e1, e2), its owner and its parent (td, t1, t2), null at a node.
    """
    zero = F.lit(0).cast("bigint")
    state = sequences.select("rep", "length", zero.alias("low"), F.col("length").alias("high"), *[zero.alias(c) for c in ("nd", "n1", "n2")])
    handles = trie.nodes.select(F.col("hd").alias("f"), F.col("h1").alias("f1"), F.col("h2").alias("f2"), *named("o", *KEY))
    asked = paths.select("rep", F.col("d").alias("f"), F.col("k1").alias("f1"), F.col("k2").alias("f2"))
    found = []
    while True:
        state = materialise(state, "search")
        found.append(state.where("low >= high"))
        active = state.where("low < high")
        if active.isEmpty():
            break
        probe = materialise(active.withColumn("f", fattest(F.col("low"), F.col("high"))).join(asked, ["rep", "f"]), "probes")
        hit = F.col("od").isNotNull()
        state = probe.join(handles, ["f", "f1", "f2"], "left").select(
            "rep", "length", F.coalesce("od", "low").alias("low"), F.when(hit, F.col("high")).otherwise(F.col("f") - 1).alias("high"),
            *[F.coalesce(o, n).alias(n) for o, n in (("od", "nd"), ("ok1", "n1"), ("ok2", "n2"))],
        )
    at = found[0]
    for more in found[1:]:
        at = at.unionByName(more)
    # does the sequence go through the node found, and if so, through which child on
    here = paths.select("rep", F.col("d").alias("nd"), F.col("k1").alias("g1"), F.col("k2").alias("g2"))
    below = paths.select("rep", (F.col("d") - 1).alias("nd"), F.col("k1").alias("b1"), F.col("k2").alias("b2"))
    at = at.join(here, ["rep", "nd"], "left").join(below, ["rep", "nd"], "left")
    through = (F.col("nd") == 0) | (F.coalesce("g1", F.lit(0)) == F.col("n1")) & (F.coalesce("g2", F.lit(0)) == F.col("n2")) & F.col("g1").isNotNull()
    at = materialise(at.withColumn("through", through), "reached")
    edge = ["owner", "td", "t1", "t2"]
    inside = at.where("not through").join(
        trie.nodes.select(F.col("d").alias("nd"), F.col("k1").alias("n1"), F.col("k2").alias("n2"), *edge, *named("e", *KEY)), ["nd", "n1", "n2"]
    )
    child = trie.nodes.select(F.col("td").alias("nd"), F.col("n1").alias("b1"), F.col("n2").alias("b2"), *edge, *named("e", *KEY))
    onward = at.where("through").join(child, ["nd", "b1", "b2"], "left")
    columns = ["rep", "length", "nd", "n1", "n2", *edge, "ed", "ek1", "ek2"]
    at = materialise(inside.select(columns).unionByName(onward.select(columns)), "edges")
    # along the edge both share prefixes up to the exit
    along = paths.join(at.where("owner is not null").select("rep", "owner", "td", "ed"), "rep").where("d > td and d <= ed")
    along = materialise(along.select("rep", "owner", *KEY), "along")
    same = along.join(trie.paths.select(F.col("rep").alias("owner"), *KEY), ["owner", *KEY]).groupBy("rep").agg(F.max("d").alias("shared"))
    lcp = F.coalesce("shared", "nd")
    out = at.join(same, "rep", "left").select(*columns, lcp.alias("lcp"))
    point = paths.select("rep", F.col("d").alias("lcp"), F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("upto").alias("reached"))
    out = out.join(point, ["rep", "lcp"], "left")
    none = [F.coalesce(c, F.lit(0)).alias(c) for c in ("a1", "a2", "reached")]
    return materialise(out.select("rep", "length", "lcp", *none, *edge, "ed", F.col("ek1").alias("e1"), F.col("ek2").alias("e2")), "located")


def with_handles(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Adds to nodes (d, k1, k2, owner, upto, td, t1, t2) the first prefix of the edge, the bytes before it and the handle."""
    first = paths.select(F.col("rep").alias("owner"), (F.col("d") - 1).alias("td"), F.col("k1").alias("n1"), F.col("k2").alias("n2"), (F.col("upto") - F.col("bytes")).alias("base"))
    handle = paths.select(F.col("rep").alias("owner"), F.col("d").alias("hd"), F.col("k1").alias("h1"), F.col("k2").alias("h2"))
    asked = materialise(nodes.withColumn("hd", fattest(F.col("td"), F.col("d"))), "changed")
    found = materialise(asked.join(first, ["owner", "td"]), "named")
    return found.join(handle, ["owner", "hd"]).select(NODE)


NODE = [*KEY, "owner", "upto", "base", "td", "t1", "t2", "n1", "n2", "hd", "h1", "h2"]


def insert(trie: Trie | None, sequences: DataFrame, paths: DataFrame) -> Trie:
    """The trie with the batch ``sequences`` (rep, length, and the name k1, k2 of their end) and their prefixes ``paths``."""
    zero = F.lit(0).cast("bigint")
    if trie is None:
        edge = [F.lit(None).cast("bigint").alias(c) for c in ("owner", "td", "t1", "t2", "ed", "e1", "e2")]
        at = sequences.select("rep", "length", *[zero.alias(c) for c in ("lcp", "a1", "a2", "reached")], *edge)
    else:
        at = locate(trie, sequences.select("rep", "length"), paths)
    below = materialise(paths.join(at.select("rep", "lcp", "a1", "a2"), "rep").where("d > lcp"), "below")
    fresh = below.groupBy(*KEY, "p1", "p2", "upto").agg(F.min("rep").alias("owner"))
    fresh = materialise(fresh, "fresh")
    children = fresh.groupBy((F.col("d") - 1).alias("d"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("children"))
    ends = sequences.select(F.col("length").alias("d"), "k1", "k2", F.lit(True).alias("ends"))
    compact = fresh.join(children, KEY, "left").join(ends, KEY, "left").where("children is null or children > 1 or ends")
    compact = materialise(compact.select(*KEY, "owner", "upto"), "compact")
    # the parent of a node is the one before it on its owner's way down, the first one's is the exit
    pairs = below.select("rep", *KEY, "lcp", "a1", "a2").join(compact, KEY)
    down = Window.partitionBy("rep").orderBy("d")
    parent = F.lag(F.struct(*KEY)).over(down)
    exit_ = F.struct(F.col("lcp").alias("d"), F.col("a1").alias("k1"), F.col("a2").alias("k2"))
    linked = pairs.withColumn("_p", F.coalesce(parent, exit_)).where("rep = owner")
    changed = linked.select(*KEY, "owner", "upto", F.col("_p.d").alias("td"), F.col("_p.k1").alias("t1"), F.col("_p.k2").alias("t2"))
    if trie is None:
        return Trie(materialise(with_handles(changed, paths), "nodes"), paths)
    # edges are cut where something leaves them or ends on them
    cuts = at.where("owner is not null and lcp < ed").groupBy("ed", "e1", "e2", "owner", "td", "t1", "t2", "lcp", "a1", "a2").agg(F.min("reached").alias("upto"))
    cuts = materialise(cuts, "cuts")
    along = Window.partitionBy("ed", "e1", "e2").orderBy("lcp")
    before = F.coalesce(F.lag(F.struct(F.col("lcp").alias("d"), F.col("a1").alias("k1"), F.col("a2").alias("k2"))).over(along), F.struct(F.col("td").alias("d"), F.col("t1").alias("k1"), F.col("t2").alias("k2")))
    split = cuts.withColumn("_p", before).select(
        F.col("lcp").alias("d"), F.col("a1").alias("k1"), F.col("a2").alias("k2"), "owner", "upto",
        F.col("_p.d").alias("td"), F.col("_p.k1").alias("t1"), F.col("_p.k2").alias("t2"),
    )
    last = cuts.groupBy(F.col("ed").alias("d"), F.col("e1").alias("k1"), F.col("e2").alias("k2")).agg(F.max(F.struct("lcp", "a1", "a2")).alias("_p"))
    last = materialise(last.select(*KEY, F.col("_p.lcp").alias("td"), F.col("_p.a1").alias("t1"), F.col("_p.a2").alias("t2")), "cut-edges")
    lower = trie.nodes.select(*KEY, "owner", "upto").join(last, KEY)
    kept = trie.nodes.join(last.select(KEY), KEY, "left_anti").select(NODE)
    every = trie.paths.unionByName(paths)
    renewed = with_handles(changed.unionByName(split).unionByName(lower), every)
    return Trie(materialise(kept.unionByName(renewed), "nodes"), every)


def joined_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (d, k1, k2, conv_id) to up to ``IDS`` comma-joined ids of one end, named by the first."""
    key, ids = None, []

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"d": [key[0]], "k1": [key[1]], "k2": [key[2]], "first": [ids[0]], "ids": [",".join(map(str, ids))]})

    for batch in batches:
        done: list[tuple] = []
        for *own, conv_id in zip(*(batch.column(c).to_pylist() for c in (*KEY, "conv_id"))):
            if ids and (own != key or len(ids) == IDS):
                done.append((*key, ids[0], ",".join(map(str, ids))))
                ids = []
            key = own
            ids.append(conv_id)
        if done:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done))), names=[*KEY, "first", "ids"])
    if ids:
        yield row()


def id_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted joined ids to a digest per end; no list of all ids is held."""
    key, sha = None, None
    for batch in batches:
        done: list[tuple] = []
        for *own, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
            if own == key:
                sha.update(b"," + ids.encode())
                continue
            if key is not None:
                done.append((*key, sha.hexdigest()))
            key, sha = own, hashlib.sha256(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done))), names=[*KEY, "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_pydict({"d": [key[0]], "k1": [key[1]], "k2": [key[2]], "ends_sha256": [sha.hexdigest()]})


def end_digests(ends: DataFrame) -> DataFrame:
    """(d, k1, k2, ends_sha256) of the prefixes where conversations (conv_id, d, k1, k2) end."""
    arrow_ready(ends.sparkSession)
    joined = ends.repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id").select(*KEY, "conv_id")
    joined = materialise(joined.mapInArrow(joined_ids, "d bigint, k1 bigint, k2 bigint, first bigint, ids string"), "joined-ids")
    dealt = joined.repartition(*KEY).sortWithinPartitions(*KEY, "first").select(*KEY, "ids")
    return materialise(dealt.mapInArrow(id_digests, "d bigint, k1 bigint, k2 bigint, ends_sha256 string"), "ends")


def statistics(trie: Trie, sequences: DataFrame) -> tuple[DataFrame, tuple[int, ...] | None]:
    """Smallest member, members, children, leaves and saved bytes of the subtree: of compacted nodes, and of the root.

    The root's are five numbers, or None without conversations.
    """
    children = materialise(trie.nodes.groupBy(*[F.col(t).alias(c) for t, c in zip(("td", "t1", "t2"), KEY)]).agg(F.count(F.lit(1)).alias("n_children")), "children")
    ended = sequences.select("rep", F.col("length").alias("d"), "k1", "k2", "copies").join(children, KEY, "left")
    ended = materialise(ended.select("rep", "copies", (F.col("n_children").isNull() & (F.col("d") > 0)).cast("bigint").alias("leaf")), "leaves")
    pairs = materialise(trie.paths.select("rep", *KEY).join(trie.nodes.select(KEY), KEY), "pairs")
    pairs = materialise(pairs.join(ended, "rep"), "counted-pairs")
    sums = pairs.groupBy(KEY).agg(F.min("rep").alias("conv_id"), F.sum("copies").alias("n_convs"), F.sum("leaf").alias("n_leaves"))
    sums = trie.nodes.join(sums, KEY).withColumn("saved", (F.col("n_convs") - 1) * (F.col("upto") - F.col("base")))
    sums = materialise(sums, "sums")
    # each node counts once, with its smallest member; that member carries it to all nodes above
    carried = pairs.select("rep", *KEY).join(sums.select(*KEY, "conv_id", "saved"), KEY)
    up = Window.partitionBy("rep").orderBy(F.desc("d"))
    carried = carried.select(*KEY, "rep", F.sum(F.when(F.col("conv_id") == F.col("rep"), F.col("saved")).otherwise(0)).over(up).alias("saved"))
    below = materialise(carried.groupBy(KEY).agg(F.sum("saved").alias("subtree")), "subtrees")
    nodes = sums.join(below, KEY).join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    whole = ended.agg(F.min("rep").alias("conv_id"), F.sum("copies").alias("n_convs"), F.sum("leaf").alias("n_leaves")).first()
    if whole["conv_id"] is None:
        return materialise(nodes, "node-sums"), None
    saved = sums.agg(F.sum("saved")).first()[0] or 0
    first = children.where("d = 0").agg(F.sum("n_children")).first()[0] or 0
    return materialise(nodes, "node-sums"), (whole["conv_id"], whole["n_convs"], first, max(1, whole["n_leaves"]), saved)


def trie_nodes(lengths: DataFrame, turns: DataFrame, batches: int = BATCHES) -> DataFrame:
    """A row per distinct prefix of the conversations (conv_id, length) with turns (conv_id, d, digest, bytes)."""
    names = prefixes(lengths, turns)
    ends = lengths.join(names.select("conv_id", F.col("d").alias("length"), "k1", "k2"), ["conv_id", "length"], "left")
    ends = ends.select("conv_id", F.col("length").cast("bigint").alias("d"), *[F.coalesce(k, F.lit(0)).alias(k) for k in ("k1", "k2")])
    ends = materialise(ends, "conversation-ends")
    sequences = ends.groupBy(KEY).agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    batch = F.pmod(F.xxhash64(F.lit("batch"), "rep"), F.lit(batches))
    sequences = materialise(sequences.withColumnRenamed("d", "length").withColumn("_batch", batch), "sequences")
    paths = names.withColumnRenamed("conv_id", "rep").join(sequences.select("rep", "_batch"), "rep")
    paths = materialise(paths, "paths")
    trie = None
    for number in range(batches):
        mine = F.col("_batch") == number
        trie = insert(trie, sequences.where(mine).drop("_batch"), paths.where(mine).drop("_batch"))
    nodes, root = statistics(trie, sequences)
    digests = end_digests(ends)
    # edges expanded, in steps, as they can be long
    steps = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("d") - F.col("td") - 1) / BLOCK)))
    first = F.col("td") + 1 + F.col("_step") * BLOCK
    edges = nodes.withColumnRenamed("n_children", "_children").select("*", steps.alias("_step"))
    edges = edges.select("*", F.explode(F.sequence(first, F.least("d", first + BLOCK - 1))).alias("depth"))
    edges = materialise(edges.select("conv_id", "depth", *KEY, "td", "t1", "t2", "n_convs", "n_leaves", "subtree", "base", "_children"), "expanded")
    own = paths.select(F.col("rep").alias("conv_id"), F.col("d").alias("depth"), (F.col("upto") - F.col("bytes")).alias("_above"))
    edges = edges.join(own, ["conv_id", "depth"])
    parents = nodes.select(F.col("d").alias("td"), F.col("k1").alias("t1"), F.col("k2").alias("t2"), F.col("conv_id").alias("_parent"))
    top = nodes.where("td > 0").select(*KEY, "td", "t1", "t2").join(parents, ["td", "t1", "t2"]).select(*KEY, "_parent")
    known = materialise(top.join(digests, KEY, "full").select(*KEY, "_parent", "ends_sha256"), "parents")
    at_end, at_top = F.col("depth") == F.col("d"), F.col("depth") == F.col("td") + 1
    parent = F.when(~at_top, F.col("conv_id")).when(F.col("td") == 0, F.lit(root and root[0])).otherwise(F.col("_parent"))
    out = edges.join(known, KEY, "left").select(
        "conv_id", "depth", parent.cast("bigint").alias("parent_conv_id"), "n_convs",
        F.when(at_end, F.col("_children")).otherwise(1).cast("bigint").alias("n_children"), "n_leaves",
        (F.col("subtree") - (F.col("n_convs") - 1) * (F.col("_above") - F.col("base"))).alias("saved_tokens"),
        F.when(at_end, F.coalesce("ends_sha256", F.lit(NOTHING))).otherwise(NOTHING).alias("ends_sha256"),
    )
    if root is None:
        return out
    smallest, members, children, leaves, saved = root
    silent = digests.where("d = 0").select("ends_sha256").first()
    top = [(smallest, 0, None, members, children, leaves, saved, silent[0] if silent else NOTHING)]
    return out.unionByName(lengths.sparkSession.createDataFrame(top, out.schema))


def shared_prefix_trie(conversations: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The prefix nodes of conversations that share beginnings within families; see ``shared_beginnings``."""
    return trie_nodes(*shared_beginnings(numbered(conversations)), batches=batches)


def conversation_trie(conversations: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The prefix nodes of conversations (conv_id, turn, role, text) as they are."""
    return trie_nodes(*as_they_are(numbered(conversations)), batches=batches)

"""The conversation trie against a plain trie in memory."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cases import rows_of
from storespark.llm import prefix_trie
from storespark.llm.common import materialise

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, rebuild=True):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(role, text) for _, _, role, text in sorted(v)] for c, v in own.items()}
    built = {}
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9 if rebuild else 0
        built[c] = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
    members, children = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        own_bytes = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = sum(saved[x] for x in children[node]) + own_bytes
    found = []
    for node, held in members.items():
        ends = ",".join(str(c) for c in held if len(built[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        found.append(
            (held[0], len(node), parent, len(held), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(found, key=repr)


def odd_conversations():
    rng = random.Random(11)
    texts = ["a", "é", "", None, "longer text", "漢字"]
    rows = []
    for c in range(160):
        for t in range(rng.choice([0, 1, 2, 3, 5, 9, 14])):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(texts[: 2 + c % 5])))
    rows += [(c, t, "user", f"hot {t}") for c in range(200, 400, 5) for t in range(12)]  # copies
    rows += [(c, t, "user", f"hot {t}") for c in range(400, 440) for t in range(c % 11)]  # each a prefix of another
    rows += [(500, None, "user", "first"), (500, None, None, "first"), (500, 3, "user", "x"), (500, 3, "user", "x"), (500, 1, "system", None)]
    rows += [(None, 0, "user", "nobody's"), (2**40, 0, "user", "far"), (503, 0, "u", "only own"), (600, 0, "", "a:b"), (605, 0, "a", ":b")]
    rows += [(700, t, "user", f"turn {t // 2}") for t in range(60)] + [(705, t, "user", f"turn {t // 2}" if t < 41 else "other") for t in range(50)]
    return rows


@pytest.mark.parametrize("batches", [1, 3])
def test_trie_equals_plain_trie(spark, monkeypatch, batches):
    monkeypatch.setattr(prefix_trie, "BLOCK", 7)  # so that these conversations have several blocks
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    rows = odd_conversations()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    more = frame.select("*", *[F.lit("x").alias(c) for c in ("d", "k1", "rep", "n", "place", "base", "h", "bytes", "_at")])
    found = prefix_trie.shared_prefix_trie(more, batches)
    assert set(found.columns) == set(COLUMNS)
    assert rows_of(found, *COLUMNS) == plain(rows)


def test_conversations_as_they_are(spark):
    rows = odd_conversations()[:300]
    found = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(found, *COLUMNS) == plain(rows, rebuild=False)


def test_conversations_without_turns_and_empty_tables(spark):
    # ids whose own turns all give way to a missing family's: only the root is left
    silent = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1][:6]
    rows = [(c, 0, "user", "x") for c in silent]
    found = rows_of(prefix_trie.shared_prefix_trie(spark.createDataFrame(rows, SCHEMA)), *COLUMNS)
    assert found == plain(rows) and len(found) == 1 and found[0][5] == 1
    assert prefix_trie.shared_prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_sequence_is_located_at_its_exact_exit(spark):
    old = [(c, t, "u", f"{w}") for c, words in ((0, "abcdefgh"), (5, "abcdxy"), (10, "q")) for t, w in enumerate(words)]
    new = [(c, t, "u", f"{w}") for c, words in ((20, "abcdefz"), (25, "abzz"), (30, "abcd"), (35, "abc"), (40, "z"), (45, "abcdefgh"), (50, "abcdefghi"), (55, "abcdxyz")) for t, w in enumerate(words)]
    lengths, turns = prefix_trie.as_they_are(prefix_trie.numbered(spark.createDataFrame(old + new, SCHEMA)))
    names = prefix_trie.prefixes(lengths, turns).withColumnRenamed("conv_id", "rep")
    ends = lengths.withColumnRenamed("conv_id", "rep").join(names.select("rep", F.col("d").alias("length"), "k1", "k2"), ["rep", "length"])
    ends = materialise(ends, "test-ends")
    trie = prefix_trie.insert(None, ends.where("rep < 20"), names.where("rep < 20"))
    found = prefix_trie.locate(trie, ends.where("rep >= 20").select("rep", "length"), names.where("rep >= 20"))
    at = {r["rep"]: (r["lcp"], r["ed"]) for r in found.collect()}
    assert at == {20: (6, 8), 25: (2, 4), 30: (4, None), 35: (3, 4), 40: (0, None), 45: (8, None), 50: (8, None), 55: (6, None)}


def test_fattest_number(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 70)]
    frame = spark.createDataFrame(pairs, "a bigint, b bigint").select("a", "b", prefix_trie.fattest(F.col("a"), F.col("b")).alias("f"))
    for a, b, f in frame.collect():
        assert f == max(range(a + 1, b + 1), key=lambda x: x & -x)

"""Prefix BPE against tiktoken, and hard negatives against brute force."""

import hashlib
import random
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cases import odd_documents, rows_of, with_clashes
from storespark.llm import bpe_prefix, hard_negatives, queries
from storespark.llm.common import table

SF = "/root/testdata/sf0.001"
PARTS = ["a", "b", " ", "  ", "\n", "é", "漢", "😀", "1", "'s", "the", "ing", "Ⅷ", "՘", "ⱟ", "\U00016ea0", "!", "x" * 50, "ab" * 40]


@cache
def reference() -> tiktoken.Encoding:
    ranks = own().vocabulary.ranks
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@cache
def own() -> bpe_prefix.Codec:
    return bpe_prefix.Codec()


def test_bpe_query_equals_tiktoken(spark):
    docs = table(spark, SF, "documents").unionByName(odd_documents(spark))
    expected = []
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = np.array(reference().encode_ordinary(text or ""), dtype="<u4")
        expected.append((doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    for rows in (docs, with_clashes(docs)):
        assert rows_of(bpe_prefix.digests(rows)) == sorted(expected, key=repr)
    encoded = bpe_prefix.encode(docs)
    assert rows_of(bpe_prefix.decode(encoded)) == sorted([(d, (t or "").encode()) for d, t in docs.select("doc_id", "text").collect()], key=repr)
    assert bpe_prefix.digests(docs.limit(0)).count() == 0


def test_special_strings_and_long_matches_are_ordinary_text():
    for text in ("a <|endoftext|> b", "a" * 200_000, " " * 100_000, "é" * 50_000 + "\n" * 999):
        assert np.frombuffer(own().encode(text), "<u4").tolist() == reference().encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.lists(st.sampled_from(PARTS), max_size=20).map("".join))
def test_any_text_is_encoded_as_by_tiktoken(text):
    ids = own().encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == reference().encode_ordinary(text)
    assert own().decode(ids) == text.encode()


def test_appends_and_edits_equal_encoding_anew():
    rng = random.Random(3)
    some = lambda n: "".join(rng.choice(PARTS) for _ in range(rng.randint(0, n)))
    for _ in range(400):
        doc = bpe_prefix.Document(some(30), own().vocabulary, own().splitter)
        for _ in range(4):
            start = rng.randint(0, len(doc.text))
            doc.edit(start, rng.randint(start, min(len(doc.text), start + 6)), some(3))
            doc.append(some(2))
            assert doc.ids() == reference().encode_ordinary(doc.text)


def test_an_edit_encodes_only_what_is_near_it():
    doc = bpe_prefix.Document("some words and more " * 5_000, own().vocabulary, own().splitter)
    assert doc.edit(50_000, 50_002, "QQ") <= 5 and doc.append("x") <= 4
    assert doc.ids() == reference().encode_ordinary(doc.text)


def test_class_tables_agree_up_to_safe_characters():
    every = "".join(c for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000)]) if bpe_prefix.SAFE.fullmatch(c))
    plain, exact = own().splitter.plain, bpe_prefix.as_written(public_tokenizers.PATTERN)
    assert plain.findall(every) == exact.findall(every)
    assert all(plain.findall("a1 " + c) == exact.findall("a1 " + c) for c in every[:3000])


def brute_force(rows):
    """(anchor, positive, rank, negative, positive score, negative score) of all anchors, by plain loops."""
    usable = []
    for vec_id, v, label in rows:
        if None not in (vec_id, v, label) and all(x is not None and np.isfinite(x) for x in v):
            whole = [int(np.floor(256 * float(x))) for x in v]
            usable.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, whole))
    found = []
    for anchor, own_label, a in usable:
        if anchor % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), i, label) for i, label, v in usable if i != anchor)
        for minus, positive, _ in [s for s in scored if s[2] == own_label][:5]:
            fits = [s for s in scored if s[2] != own_label and 30 * -minus <= 100 * -s[0] <= 90 * -minus][:10]
            found += [(anchor, positive, rank, i, -minus, -s) for rank, (s, i, _) in enumerate(fits, 1)]
    return sorted(found, key=repr)


def odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.normal(size=6) * 0.4], int(i % 3)) for i in range(1, 900)]
    rows += [(1000 + i, [0.5, 0.5, 0.1, 0.0, 0.0, 0.2], i % 2) for i in range(300)]  # ties
    rows += [(2000, [0.0] * 6, 1), (2100, None, 1), (2200, [1.0, None, 1.0, 0.0, 0.0, 0.0], 1), (2300, [1.0] * 6, None)]
    rows += [(2400, [float("nan")] + [0.0] * 5, 1), (2500, [float("inf")] * 6, 1), (None, [0.1] * 6, 2), (2600, [0.3, 0.1], 1), (2700, [], 2)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


@pytest.mark.parametrize("block_rows", [7, 64])
def test_hard_negatives_equal_brute_force(spark, block_rows):
    vectors = odd_vectors(spark)
    expected = brute_force([tuple(r) for r in vectors.collect()])
    more = vectors.selectExpr("*", "'x' as block", "1 as grp", "2 as n", "3 as pack", "4 as slot", "5 as score", "6 as v", "7 as place")
    assert len(expected) > 100
    assert rows_of(hard_negatives.hard_negatives(more, block_rows)) == expected


def test_a_repeated_anchor_counts_once_and_an_empty_table_gives_nothing(spark):
    vectors = odd_vectors(spark)
    once = rows_of(hard_negatives.hard_negatives(vectors.where("vec_id % 100 <> 0 or vec_id = 300")))
    rows = vectors.where("vec_id % 100 <> 0 or vec_id = 300")
    assert rows_of(hard_negatives.hard_negatives(rows.unionByName(vectors.where("vec_id = 300")))) == once
    assert hard_negatives.hard_negatives(vectors.limit(0)).count() == 0


def test_zone_maps_leave_blocks_out_and_bounds_hold(spark):
    rng = np.random.default_rng(1)
    v, a = rng.integers(-300, 300, (500, 5)), rng.integers(-300, 300, (40, 5))
    least, most = hard_negatives.bounds(a, v.min(axis=0)[None], v.max(axis=0)[None])
    scores = a @ v.T
    assert (least[:, 0] <= scores.min(axis=1)).all() and (most[:, 0] >= scores.max(axis=1)).all()
    near = [(i, [float(np.cos(c)), float(np.sin(c)), 0.0, 0.0], 0) for i, c in enumerate(np.linspace(0, 6, 4000))]
    blocks = hard_negatives.write_blocks(spark.createDataFrame(near, "vec_id bigint, embedding array<float>, label int"), 100)
    groups = blocks.mapInArrow(hard_negatives.anchor_batches, hard_negatives.GROUP)
    chosen = hard_negatives.choose(groups, hard_negatives.zone_packs(blocks), True)
    read = chosen.selectExpr("sum(length(anchors)) / 8").first()[0]
    assert 40 <= read < 40 * blocks.count() / 4


def test_hilbert_places_are_a_walk_by_single_steps():
    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    places = hard_negatives.hilbert(cells, 3)
    assert sorted(places) == list(range(512))
    walk = cells[np.argsort(places)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_registered_queries_read_whole_tables(spark):
    assert queries.QUERIES["op12_prefix_bpe"](spark, SF).count() == table(spark, SF, "documents").count()

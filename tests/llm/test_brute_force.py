"""Each operator against a plain computation over all rows."""

import hashlib
import itertools
import re
import struct
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cases import SCHEMA, odd_documents, rows_of
from storespark.llm import (
    dartminhash,
    exact_dedup,
    fingerprints,
    langid,
    licenses,
    mixing,
    packing,
    queries,
    secrets,
    toxicity,
    warc_zip,
)
from storespark.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents").unionByName(odd_documents(spark)).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]


def test_secrets(docs, texts):
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
    )
    expected = []
    for doc_id, text in texts:
        spans = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(text) if len(m[2]) >= 8]
        spans += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        spans += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        n = Counter(p for _, p, _ in spans)
        joined = ",".join(s for _, _, s in sorted(spans))
        expected.append((doc_id, n[0], n[1], n[2], hashlib.sha256(joined.encode()).hexdigest()))
    found = secrets.scan_secrets(docs)
    assert rows_of(found, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == sorted(expected, key=repr)


def test_ownership_separates_examples_from_live_values(spark):
    live, copied = "tok_" + "9f8a7c6b5d4e3f2a1b0c", "secret_" + "Zx81kQ0pLm4vRt7y"
    rows = [(i, f"token = {copied}", None, f"owner{i % 5}", 0) for i in range(20)]
    rows += [(100, f"token = {live}", None, "owner1", 0), (101, "token = changeme123", None, "owner2", 0)]
    found = {r["doc_id"]: r for r in secrets.scan_secrets(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (found[3]["n_example"], found[3]["most_owners"], found[3]["n_live"]) == (1, 5, 0)
    assert (found[100]["n_live"], found[100]["n_example"]) == (1, 0) and found[100]["live_spans"].startswith("assign:")
    assert found[101]["n_unclear"] == 1
    assert found[3]["found"][0]["n_repos"] == 20


def test_copies_within_one_owner_are_examples(spark):
    copied, few, live = ("tok_" + f"{x}f8a7c6b5d4e3f2a1b0c" for x in "789")
    rows = [(i, f"token = {copied}", None, "hot", 0) for i in range(1000)]
    rows += [(1000 + i, f"token = {few}", None, "hot", 0) for i in range(5)]
    rows += [(2000 + i, f"token = {live}", None, "hot", 0) for i in range(2)]
    found = {r["doc_id"]: r for r in secrets.scan_secrets(spark.createDataFrame(rows, SCHEMA)).collect()}
    counts = {i: tuple(found[i][f"n_{v}"] for v in ("live", "example", "unclear")) for i in (0, 999, 1000, 2000)}
    assert counts == {0: (0, 1, 0), 999: (0, 1, 0), 1000: (0, 0, 1), 2000: (1, 0, 0)}
    assert found[0]["live_spans"] == "" and found[0]["most_owners"] == 1


def _exact(texts):
    groups = defaultdict(list)
    for doc_id, text in texts:
        groups[re.sub("[\x20\x09-\x0d]", "", text)].append((-len(text), doc_id is None, doc_id))
    return {k: (min(v, key=lambda x: (x[0], x[1], x[2] or 0))[2], len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("key", [exact_dedup.chunk_key, lambda chunk: F.length(chunk).cast("bigint")])
def test_exact_duplicates_even_with_colliding_identifiers(docs, texts, key):
    groups = _exact(texts)
    expected = []
    for doc_id, text in texts:
        norm = re.sub("[\x20\x09-\x0d]", "", text)
        expected.append((doc_id, *groups[norm], hashlib.sha256(norm.encode()).hexdigest()))
    found = exact_dedup.exact_duplicates(docs, key)
    assert rows_of(found, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(expected, key=repr)
    assert found.where("kept").count() == len(groups)
    assert exact_dedup.drop_exact_duplicates(docs).count() == len(groups)


def test_license_phrases(docs, texts):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    upper = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    expected = []
    for doc_id, text in texts:
        words = word.findall(text.translate(upper))
        places = []
        for phrase, label in licenses.BASE.items():
            parts = phrase.split()
            places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
        at = [i for i, _ in places]
        expected.append((doc_id, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))))
    found = licenses.scan_licenses(docs)
    assert rows_of(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(expected, key=repr)


def test_license_rules_and_suppression(spark):
    cases = {
        "Licensed under the Apache License, Version 2.0.": "apache,apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
        "SPDX-License-Identifier: BSD-3-Clause": "bsd-3-clause",
        "Licensed under our own terms": "unknown",
        "GNU Lesser General Public License version 2.1": "gpl,lgpl-2.1",
        "nothing of the kind": "",
    }
    rows = [(i, text, None, None, None) for i, text in enumerate(cases)]
    found = licenses.scan_licenses(spark.createDataFrame(rows, SCHEMA)).orderBy("doc_id").collect()
    assert [r["labels"] for r in found] == list(cases.values())
    for r in found:
        for d, e in itertools.permutations(r["detections"], 2):
            assert not (e["from"] <= d["from"] and d["to"] <= e["to"] and e["priority"] <= d["priority"])
    assert len(licenses.rules()) > 300


def _samples(parsed, space):
    """Shortest texts that a rule matches, one for each choice of alternatives, with ``space`` for white space."""
    made = [""]
    for op, value in parsed:
        name = str(op)
        if name in ("ASSERT", "ASSERT_NOT", "AT"):
            continue
        if name == "LITERAL":
            parts = [chr(value)]
        elif name == "IN":
            kind, first = value[0]
            parts = [space if str(kind) == "CATEGORY" and "SPACE" in str(first) else chr(first[0] if str(kind) == "RANGE" else first) if str(kind) != "CATEGORY" else "1"]
        elif name == "MAX_REPEAT":
            parts = [s * value[0] for s in _samples(value[2], space)] if value[0] else [""]
        elif name == "SUBPATTERN":
            parts = _samples(value[3], space)
        elif name == "BRANCH":
            parts = [s for branch in value[1] for s in _samples(branch, space)]
        else:
            raise ValueError(name)
        made = [a + b for a in made for b in parts]
    return made


def test_each_license_rule_is_found_through_the_gates():
    from storespark.llm import license_rules

    ordered = licenses.rules()
    forms = [re.compile(f) for f in licenses.TRIGGER_FORMS]
    for rule in ordered:
        assert " " not in rule.keyword
        for space in " \n":
            for text in _samples(re._parser.parse(rule.pattern), space):
                low = text.lower()
                assert re.search(rule.pattern, text), (rule, text)
                assert rule.keyword in low, (rule, text)
                assert any(t in low for t in licenses.TRIGGERS) or any(f.search(low) for f in forms), (rule, text)
    assert len(ordered) == 522 and set(license_rules.OWN_KEYWORDS) <= {n for x in license_rules.LICENCES for n in x[2]}


def test_license_names_with_words_of_their_own(spark):
    cases = {
        "Alle Rechte vorbehalten": "proprietary",
        "Tous droits\nréservés": "proprietary",
        "Todos los derechos reservados": "proprietary",
        "X Consortium License": "x11",
        "Berkeley Software\nDistribution License": "bsd",
        "Internet Systems Consortium License": "isc",
        "PSF License": "python",
        "in the public\ndomain": "public-domain",
        "GNU Free\nDocumentation License": "fdl",
        "Server\nSide Public License": "sspl",
        "Business\nSource License": "busl",
        "CC\nBY-SA 4.0": "cc-by-sa-4.0",
        "mozilla.org/MPL/2.0": "mpl",
        "released under its terms": "unknown",
    }
    rows = [(i, text, None, None, None) for i, text in enumerate(cases)]
    found = licenses.scan_licenses(spark.createDataFrame(rows, SCHEMA)).orderBy("doc_id").collect()
    assert {t: r["labels"] for t, r in zip(cases, found)} == cases


def _units(text):
    words = re.findall(r"\w+", text.lower())
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else Counter()


def test_near_duplicates_are_the_components_of_all_pairs(docs, texts):
    weighted = [_units(t) for _, t in texts]
    by_shingle = defaultdict(set)
    for i, w in enumerate(weighted):
        for s in w:
            by_shingle[s].add(i)
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    same = {}
    for i, (_, t) in enumerate(texts):
        j = same.setdefault(tuple(re.findall(r"\w+", t.lower())), i)
        parent[root(i)] = root(j)
    for i, j in {p for v in by_shingle.values() for p in itertools.combinations(sorted(v), 2)}:
        shared, total = sum((weighted[i] & weighted[j]).values()), sum((weighted[i] | weighted[j]).values())
        if shared >= 0.8 * total:
            parent[root(i)] = root(j)
    members = defaultdict(list)
    for i, (doc_id, _) in enumerate(texts):
        members[root(i)].append(doc_id)
    smallest = {k: min(v, key=lambda x: (x is None, x or 0)) for k, v in members.items()}
    expected = [(d, smallest[root(i)], len(members[root(i)])) for i, (d, _) in enumerate(texts)]
    found = dartminhash.near_duplicates(docs)
    assert rows_of(found, "doc_id", "class_id", "class_size") == sorted(expected, key=repr)
    assert found.where("kept").count() == len(members)
    assert dartminhash.drop_near_duplicates(docs).count() == len(members)


def test_classes_that_no_hub_sees_whole(spark):
    """A chain in which each text is near the next only: one class by links, though its ends are unlike."""
    words = [f"w{i}" for i in range(400)]
    chain = [" ".join(words[10 * i : 10 * i + 200]) for i in range(12)]
    rows = [(i, t, None, None, None) for i, t in enumerate(chain)]
    found = dartminhash.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert {r["class_id"] for r in found.collect()} == {0}


def test_signatures_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 2**63, 400).astype(np.uint64)
    other = words.copy()
    other[300:] = rng.integers(0, 2**63, 100).astype(np.uint64)
    a, b = dartminhash.units(words), dartminhash.units(other)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    agree = (dartminhash.signature(a, 2048) == dartminhash.signature(b, 2048)).mean()
    assert abs(agree - true) < 0.04


def test_languages_on_held_out_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = langid.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 100
    assert sum(r["lang_pred"] == r["lang"] for r in found) / len(found) >= 0.97


def test_language_cases(spark, docs):
    found = {r["doc_id"]: r for r in langid.languages(docs).collect()}
    assert found[2**40]["lang_pred"] == "fr"
    nothing = docs.where("text is null or trim(text) = ''").withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.languages(nothing).collect()} == {"und"}


def test_filters_hold_every_ngram_and_correct_false_ones():
    rng = np.random.default_rng(2)
    grams = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (500, 2000)] * 40  # 80 languages: two words of bits
    model = langid.build([f"l{i}" for i in range(80)], grams, 0)
    hits = langid.counts(model, grams[0], np.array([0]))[0]
    assert hits[0] == pytest.approx(500) and hits[78] == pytest.approx(500) and hits[1] < 25


def _jaccard(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_fingerprints(docs, texts):
    ordered = sorted(texts, key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    expected = []
    for (doc_id, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        n = len(text) // 4
        changed = text[: len(text) - n] + following[:n]
        expected.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    found = fingerprints.fingerprints(docs)
    assert rows_of(found, "doc_id", "n_chars", "edited_sha256") == sorted(expected, key=repr)
    marks = defaultdict(set)
    by_id = defaultdict(set)
    for doc_id, text in texts:
        by_id[doc_id].add(text)
    for r in found.collect():
        if len(by_id[r["doc_id"]]) == 1:
            marks[next(iter(by_id[r["doc_id"]]))].add(r["fingerprint"])
    assert all(len(v) == 1 for v in marks.values())


def test_likeness_is_near_generalised_jaccard(texts):
    long = [fingerprints.terms(t) for _, t in texts if len(t) > 2000][:40]
    sampler = fingerprints.Sampler(list({w for c in long for w in c}), 512)
    for a, b in zip(long, long[1:]):
        mixed = a + b
        for x, y in ((a, b), (a, mixed)):
            near = fingerprints.likeness(sampler.fingerprint(x), sampler.fingerprint(y))
            assert abs(near - _jaccard(x, y)) < 0.09


def test_mix_is_near_its_targets(docs):
    found = mixing.mix(docs)
    assert rows_of(found) == rows_of(mixing.mix(docs.repartition(7)))
    total = found.agg(F.sum("size")).first()[0]
    by = found.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("size").alias("most"), F.first("target").alias("target"), F.sum("size").alias("size")).collect()
    assert sum(r["target"] for r in by) == pytest.approx(total)
    for r in by:
        assert r["target"] <= 3 * r["size"] + 1e-6 and abs(r["taken"] - r["target"]) <= r["most"] / 2 + 1
    assert found.where("taken > 3 * size").count() == 0
    assert mixing.repeat_documents(docs).count() == found.agg(F.sum(F.when(F.col("size") >= 0, F.col("repeats")))).first()[0]


def test_water_filling_clamps_and_reshares(spark):
    sources = spark.createDataFrame([("a", 1), ("b", 10), ("c", 1000), (None, 50)], "source string, source_size bigint")
    found = {r["source"]: r["target"] for r in mixing.water_filling(sources).collect()}
    assert found["a"] == 3 and found["b"] == 30
    # c has weight 3, the null source comes last and has weight 1 again
    assert found["c"] + found[None] == pytest.approx(1061 - 33) and found[None] == pytest.approx(150)


def test_packing_round_trip(docs, texts):
    whole = packing.Tokens()
    ids = Counter()
    for doc_id, text in texts:
        own = whole.tokenizer.encode(text, add_special_tokens=False).ids + [0]
        ids[(doc_id, tuple(own))] += 1
    found = packing.pack(docs).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[(r["doc_id"], r["doc_tokens"])].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc_id, own in ids:
        pieces = by_doc[(doc_id, len(own))]
        assert sum(p["length"] for p in pieces) == sum(len(o) * n for (d, o), n in ids.items() if d == doc_id and len(o) == len(own))
        right = {(p["start"], p["length"]): zlib.crc32(struct.pack(f"<{p['length']}I", *own[p["start"] : p["start"] + p["length"]])) for p in pieces}
        if doc_id is not None:
            assert all(right[(p["start"], p["length"])] == p["ids_crc32"] for p in pieces)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 1024 or at & (at - 1) == 0  # no padding at all


def test_tokens_equal_the_tokenizers(texts):
    odd = ["don't we'll  \n\n x\t\ty", "a b c", "½ ² Ⅷ 漢字", "<|endoftext|>", "_x__y 12ab", "it's 'sup ''ll", "naïve café – “quoted” €5", "\x1c\x1d a", "é ʼn ǅ"]
    tokens = packing.Tokens()
    for text in odd + [t for _, t in texts[:60]]:
        assert tokens.encode([text])[0].tolist() == tokens.tokenizer.encode(text, add_special_tokens=False).ids + [0]


def test_tokens_equal_a_fresh_tokenizers(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    fresh, tokens = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY)), packing.Tokens()
    assert fresh.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    odd = ["a <|endoftext|> b", "<|endoftext|>", "漢<|endoftext|>", "<|endoftext |>", "x<|endoftext|><|endoftext|>\n"]
    for text in odd + [t for _, t in texts[:60]]:
        assert tokens.encode([text])[0].tolist() == fresh.encode(text, add_special_tokens=False).ids + [0]


def test_closest_sum_is_the_best_one():
    rng = np.random.default_rng(3)
    for _ in range(60):
        lengths = sorted({int(x) for x in rng.integers(5, 60, 6)}, reverse=True)
        counts = [0] * 100
        for n in lengths:
            counts[n] = int(rng.integers(1, 4))
        capacity = int(rng.integers(10, 150))
        sums = {0}
        for n in lengths:
            sums = {s + n * k for s in sums for k in range(counts[n] + 1)}
        chosen = Counter()
        for length, number in packing.closest(counts, lengths, capacity):
            chosen[length] += number
        assert sum(n * k for n, k in chosen.items()) == max(s for s in sums if s <= capacity)
        assert all(k <= counts[n] for n, k in chosen.items())


def test_packages_are_zip_files_with_stored_members(spark, folder):
    pages = table(spark, SF, "pages")
    path = f"file://{folder}" if folder.startswith("/") else folder
    packages = warc_zip.write_packages(pages, path, package_bytes=20_000)
    names = [r["package"] for r in packages.collect()]
    assert len(names) > 1
    for name in names:
        with zipfile.ZipFile(f"{folder}/{name}") as z:
            assert [i.compress_type for i in z.infolist()] == [0, 0] and z.testzip() is None
    found = {r["page_id"]: r for r in warc_zip.read_packages(packages, path, payloads=True).collect()}
    for r in pages.collect():
        got = found[r["page_id"]]
        if got["record_type"] == "response":
            assert bytes(got["payload"]).decode() == r["html"]


def test_plain_zip_directories_are_read_too(tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("one", b"first member")
        z.writestr("two", b"second", compress_type=zipfile.ZIP_DEFLATED)
        z.comment = b"a note"
    with open(tmp_path / "a.zip", "rb") as f:
        one, two = warc_zip.members(f, (tmp_path / "a.zip").stat().st_size)
        assert warc_zip.read_at(f, warc_zip.data_at(f, one), one.size) == b"first member"
        with pytest.raises(ValueError, match="compressed"):
            warc_zip.data_at(f, two)


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    found = toxicity.toxicity(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    toxic = [r for r in found if r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.8 * len(toxic)
    assert sum(r["predicted"] for r in found if not r["toxic"]) <= 0.03 * len(found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)


def test_toxic_words_in_disguise():
    words = toxicity.Words({"vequ~": 4.0})
    plain, hidden, clean = (toxicity.features(t, words) for t in ("you idiot", "you 1d10t and st*upid", "a kind word"))
    at = toxicity.FEATURES.index
    assert plain[at("lexicon_density")] == 0.5 and plain[at("near_address")] == 1.0
    assert hidden[at("disguised_hits")] > 0 and clean[at("disguised_hits")] == 0
    assert toxicity.features("vequique", words)[at("learned_strongest")] == 4.0


def test_spaced_insults_count_at_every_length():
    words, at = toxicity.Words({}), toxicity.FEATURES.index("disguised_hits")
    short, long = (toxicity.features("you i d i o t " + "word " * n, words)[at] for n in (10, 250_000))
    assert short == long > 0


def test_toxic_rows_take_no_clean_row_along(spark, monkeypatch):
    rows = [(i, t, None, None, None) for i in (None, 7) for t in ("you idiot", "a kind word")]
    docs = spark.createDataFrame(rows, SCHEMA)
    toxic = F.col("text") == "you idiot"

    def scored(given, model):
        name = toxicity.row_name(given["doc_id"], given["text"]).alias("name")
        return given.select("doc_id", name, toxic.cast("double").alias("score"), toxic.cast("int").alias("predicted"))

    monkeypatch.setattr(toxicity, "train", lambda *_: None)
    monkeypatch.setattr(toxicity, "score", scored)
    assert rows_of(toxicity.drop_toxic(docs, None), "doc_id", "text") == [(7, "a kind word"), (None, "a kind word")]


def test_without_labels_nothing_is_toxic(docs, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {(r["score"], r["predicted"]) for r in toxicity.toxicity(docs, none).collect()} == {(0.0, 0)}


def test_pipeline_stages_take_effect(spark):
    docs = table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    kept = stages["toxicity"](spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() < docs.count()
    found = corpus_pipeline.run(spark, SF)
    ids = {r[0] for r in found.select("doc_id").distinct().collect()}
    near = stages["near_dedup"](spark, stages["exact_dedup"](spark, kept, SF), SF)
    assert ids and ids <= {r[0] for r in near.select("doc_id").collect()}


def test_every_dealt_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 11))


def test_pairs_whose_buckets_are_all_large_are_found(spark):
    """Texts share a passage; few of them share as much again as makes a pair, in buckets that hundreds are in."""
    passage = [f"p{i}" for i in range(400)]
    texts = []
    for i in range(900):
        twin = i - 1 if i % 300 == 1 else i
        own = [f"t{twin}x{j}" for j in range(10)] + [f"o{i}x{j}" for j in range(50)]
        texts.append(" ".join(passage + own))
    number = {}
    held = [frozenset(number.setdefault(u, len(number)) for u in _units(t)) for t in texts]
    near = []
    for i, j in itertools.combinations(range(len(texts)), 2):
        shared = len(held[i] & held[j])
        if 10 * shared >= 8 * (len(held[i]) + len(held[j]) - shared):
            near.append((i, j))
    assert near == [(0, 1), (300, 301), (600, 601)]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    found = {r["doc_id"]: r["class_id"] for r in dartminhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {(c, d) for d, c in found.items() if c != d} == set(near)


def test_template_texts_do_not_meet_on_their_common_passage(spark):
    """20,000 texts share 400 shingles and have 60 of their own: the join has to bring none of them together."""
    n, common = 20_000, np.arange(400, dtype=np.uint64)
    rows = [(i, np.concatenate((common, np.arange(60, dtype=np.uint64) + np.uint64(1000 + 60 * i))).tobytes()) for i in range(n)]
    # pairs that are similar by what is their own
    rows += [(n + i, np.concatenate((common, np.arange(60, dtype=np.uint64) + np.uint64(1000 + 60 * i + 5))).tobytes()) for i in range(5)]
    own = spark.createDataFrame(rows, "rep bigint, units binary").repartition(8)
    alone = spark.createDataFrame([], "rep bigint, class bigint")
    places = dartminhash.meeting_places(dartminhash.by_frequency(own, 0.8), 0.8)
    met = places.groupBy("unit", "band").agg(F.count_if(F.expr("small")).alias("s"), F.count_if(F.expr("not small")).alias("l"))
    assert (met.selectExpr("sum(s * l)").first()[0] or 0) < n
    pairs = dartminhash.cross_pairs(dartminhash.groups_of_several(places, alone)[0], 0.8)
    assert rows_of(pairs) == [(i, n + i) for i in range(5)]


@pytest.mark.parametrize("n", [63, 64, 100, 900])
def test_the_last_window_is_always_split_into_powers_of_two(spark, n):
    rows = spark.createDataFrame([(i, None, None, None, None) for i in range(n)], SCHEMA).coalesce(1)
    lengths = packing.pack(rows).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sorted(r["n"] for r in lengths) == [1 << i for i in range(10) if n >> i & 1]


def test_long_keys_and_logins_are_found(spark):
    key = "-----BEGIN RSA PRIVATE KEY-----" + "Ab1/" * 7_500 + "-----END RSA PRIVATE KEY-----"
    login = f"see https://{'u' * 300}:{'p' * 300}@host/ there"
    rows = spark.createDataFrame([(1, key, None, "a", 0), (2, login, None, "a", 0)], SCHEMA)
    spans = {r["doc_id"]: r["spans"] for r in secrets.scan_secrets(rows).collect()}
    assert spans[1] == f"private_key:0:{key.index('-----END') + 8}" and "url_login:4:" in spans[2]


def test_the_mixing_stage_repeats_each_row_as_planned(spark):
    rows = [(i, f"word{i} " * (1 + i % 7), None, f"s{i % 4}", 0) for i in range(200)]
    rows += [(None, "alike alike", None, "s1", 0)] * 7 + [(None, "x y", None, "7:x", 0), (7, "x y", None, "x", 0), (None, "x y", None, None, 0)]
    rows += [(7, "x y", None, None, 0), (300, None, None, "s1", 0), (300, "", None, "s1", 0)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    planned = Counter()
    for r in mixing.mix(docs).collect():
        planned[r["doc_id"], r["source"], r["size"]] += r["repeats"]
    found = Counter((r["doc_id"], r["source"], len((r["text"] or "").split())) for r in mixing.repeat_documents(docs).collect())
    assert found == +planned and sum(found.values()) > 200


def test_licence_names_in_capitals_beyond_ascii(spark):
    rows = spark.createDataFrame([(1, "(c) TOUS DROITS RÉSERVÉS", None, "a", 0), (2, "Tous droits réservés", None, "a", 0)], SCHEMA)
    labels = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(rows).collect()}
    assert labels[1] == labels[2] != ""

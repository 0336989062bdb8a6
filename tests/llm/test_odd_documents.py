"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator and stage."""

import pytest

import corpus_pipeline
from cases import SCHEMA, odd_documents, rows_of, with_clashes
from storespark.llm import (
    dartminhash,
    exact_dedup,
    fingerprints,
    langid,
    licenses,
    mixing,
    packing,
    secrets,
    toxicity,
    warc_zip,
)

LABELS = "doc_id bigint, quality int, toxic int"


def labels(spark):
    marks = [(i, 1, int(i == 13)) for i in (2, 4, 5, 6, 9, 13)] + [(None, 1, 1), (4, None, None), (13, 1, 1)]
    return spark.createDataFrame(marks, LABELS)


OPERATORS = {
    "secrets": secrets.scan_secrets,
    "exact": exact_dedup.exact_duplicates,
    "licenses": licenses.scan_licenses,
    "near": dartminhash.near_duplicates,
    "languages": langid.languages,
    "fingerprints": fingerprints.fingerprints,
    "mix": mixing.mix,
    "toxicity": lambda docs: toxicity.toxicity(docs, labels(docs.sparkSession)),
}


@pytest.fixture(scope="module")
def docs(spark):
    path = f"{corpus_pipeline.__file__}".rsplit("/", 1)[0]  # only to show that the module has a place
    assert path
    return odd_documents(spark)


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_row(docs, name):
    found = OPERATORS[name](docs)
    assert rows_of(found, "doc_id") == rows_of(docs, "doc_id")


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("name", ["secrets", "exact", "licenses", "near", "languages", "fingerprints", "mix"])
def test_clashing_columns_change_nothing(docs, name):
    plain, more = OPERATORS[name](docs), OPERATORS[name](with_clashes(docs))
    assert plain.columns == more.columns
    skip = {"name"} if name == "near" else set()
    columns = [c for c in plain.columns if c not in skip]
    assert rows_of(more, *columns) == rows_of(plain, *columns)


@pytest.mark.parametrize("name", ["exact_dedup", "near_dedup", "mixing"])
def test_stages_keep_columns_and_take_no_row_twice(spark, docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    found = stage(spark, with_clashes(docs), "")
    assert found.columns == with_clashes(docs).columns
    assert stage(spark, docs.limit(0), "").count() == 0
    if name != "mixing":
        ids = [r[0] for r in found.select("doc_id").where("doc_id is not null").collect()]
        assert len(ids) == len(set(ids))


def test_packing_covers_every_row(spark, docs):
    found = packing.pack(with_clashes(docs)).groupBy("doc_id").agg({"length": "sum"}).collect()
    assert {r[0] for r in found} == {r[0] for r in docs.select("doc_id").collect()}
    assert packing.pack(docs.limit(0)).count() == 0


def test_packages_of_odd_pages(spark):
    rows = [(1, None, None), (2, "http://a b\r\nX: y/é", ""), (None, "u", "x" * 1500), (4, "u", "x" * 1500), (4, "u", "x" * 1500)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = rows_of(warc_zip.archive_pages(pages), "page_id", "payload_bytes", "record_type", "refers_to")
    assert found == sorted(
        [(1, 0, "response", None), (2, 0, "response", None), (None, 1500, "revisit", 4)] + [(4, 1500, "response", None)] * 2,
        key=repr,
    )
    assert warc_zip.archive_pages(pages.limit(0)).count() == 0

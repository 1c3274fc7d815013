"""Nulls in any column, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm import decontaminate, edits, fertility, jaccard, lattice, licences, passages, pii, revisits, secrets
from eventloom.llm.licence_texts import TEMPLATES
from tests.conftest import SF

CLASHES = ("_text", "_key", "_id", "_row_key", "key", "set", "cell", "samples", "fertility", "_group", "_band_group", "personal", "tokens", "content", "region", "_candidates", "_text_key", "_leak_id", "label")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


def operators(classifier, forest, items):
    return {
        "fertility": lambda d: fertility.judged(d)[0],
        "fertility.kept": fertility.kept,
        "decontaminate": lambda d: decontaminate.overlaps(d, items),
        "decontaminate.clean": lambda d: decontaminate.clean(d, items),
        "edits": lambda d: edits.recounted(d, edits.cleaning_edits)[0],
        "licences": lambda d: licences.scan(d, classifier=classifier),
        "passages": passages.repeated,
        "lattice": lambda d: lattice.sampled(d)[0],
        "secrets": lambda d: secrets.findings(d, forest=forest),
        "secrets.redacted": lambda d: secrets.redacted(d, forest=forest),
        "jaccard": jaccard.linked,
        "jaccard.representatives": jaccard.representatives,
        "pii": lambda d: pii.found(d)[0],
    }


NAMES = list(operators(None, None, None))
PER_ROW = ("fertility", "edits", "lattice", "secrets.redacted", "jaccard", "pii")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, " ".join(f"q{k}" for k in range(20))), (None, "a b c d e f g h"), (2, None)], "item_id long, text string")


@pytest.fixture(scope="module")
def awkward(spark):
    long_text = " ".join(f"word{k % 977} mail{k}@x.example.com" if k % 500 == 0 else f"word{k % 977}" for k in range(60_000))
    texts = [None, "", " \n\t", "word", "a" * 200_000, "1" * 50_000, "." * 50_000, long_text, "Licensed under the MIT License.", "token = \"0641917ea4e9feb9cda83477b57ac2654884f485\"", "▁ ▁ \x00 � 🦄"]
    rows = [(k, t, "en", "src", 1, *["x"] * len(CLASHES)) for k, t in enumerate(texts)]
    rows += [(3, "word", "en", "src", 1, *["x"] * len(CLASHES))] * 2  # repeated rows
    rows += [(None, t, None, None, None, *[None] * len(CLASHES)) for t in ("word", None, long_text)]
    rows += [(3, "another text under an id that is taken", None, "src", None, *[None] * len(CLASHES))]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows(awkward, classifier, forest, items, name):
    got = operators(classifier, forest, items)[name](awkward)
    rows = got.collect()
    if name in PER_ROW:
        assert len(rows) == awkward.count()
    if name in ("fertility.kept", "decontaminate.clean", "secrets.redacted", "jaccard.representatives"):
        assert got.columns == awkward.columns


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, classifier, forest, items, name):
    empty = spark.createDataFrame([], SCHEMA)
    assert operators(classifier, forest, items)[name](empty).count() == 0


def test_no_benchmark(spark, awkward, items):
    assert decontaminate.overlaps(awkward, items.limit(0)).count() == 0
    assert decontaminate.clean(awkward, items.limit(0)).count() == awkward.count()


def test_one_of_each_group_stays(awkward):
    kept = jaccard.representatives(awkward).select("doc_id", "text").collect()
    by_text = [(r.doc_id, r.text) for r in kept if r.text and r.text.strip()]
    assert len({t for _, t in by_text}) == len(by_text)  # equal texts once
    assert (3, "word") in by_text and (3, "another text under an id that is taken") in by_text
    assert sum(not (r.text or "").strip() for r in kept) == awkward.filter(F.coalesce(F.trim("text"), F.lit("")).rlike("^\\s*$")).count()


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stages_take_awkward_tables(spark, awkward, stage):
    work = dict(corpus_pipeline.STAGES)[stage]
    last = stage == corpus_pipeline.STAGES[-1][0]
    for docs in (awkward, spark.createDataFrame([], SCHEMA)):
        out = work(spark, docs, SF)
        out.collect()
        if not last:
            assert out.columns == docs.columns


def test_many_candidates_in_one_text(spark, forest):
    """Time grows with the text, not with its square: ten thousand candidates take seconds."""
    values = [f"{k:024x}" for k in range(10_000)]
    docs = spark.createDataFrame([(1, " ".join(f"password = '{v}'" for v in values), "x")], "doc_id long, text string, source string")
    start = time.monotonic()
    assert secrets.findings(docs, forest=forest, least=0.0).count() == len(values)
    assert secrets.redacted(docs, forest=forest, least=0.0).first().text.count(secrets.MASK) == len(values)
    assert time.monotonic() - start < 60


def test_long_block_with_a_licence(spark, classifier):
    words = [f"word{k % 977}" + ("\n" if k % 12 == 0 else "") for k in range(50_000)]
    text = "\n".join(TEMPLATES["mit"][3].split(" to ")) + " ".join(words) + " license"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.monotonic()
    assert "mit" in {r.family for r in licences.scan(docs, classifier=classifier).collect() if r.confirmed}
    assert time.monotonic() - start < 60


RECORDS = "record_id long, type string, url string, ts long, status int, etag string, last_modified string, headers map<string,string>, response string, near string, slice string"


def test_revisits_of_awkward_records(spark):
    long_url = "https://www.host.example/" + "p" * 200_000
    clash = (None, "x", "y")
    rows = [
        (1, "response", "http://host.example/a", 100, 200, '"t"', None, {"server": "a"}, *clash),
        (2, "revisit", "https://www.host.example/a/#top", 100, 304, 'W/"t"', None, None, *clash),  # a tie of time: the smaller id is earlier
        (2, "revisit", "https://www.host.example/a/#top", 100, 304, 'W/"t"', None, None, *clash),  # repeated
        (3, "response", long_url, 50, 200, None, None, None, *clash),
        (4, "revisit", long_url, 10**9, 304, None, None, {"date": "d"}, *clash),
        (5, "revisit", None, 1, 304, None, None, None, *clash),
        (6, "revisit", "", 1, 304, None, None, {}, *clash),
        (7, None, "http://host.example/a", 1, 304, None, None, None, *clash),
        (8, "revisit", "http://host.example/a", None, 304, None, None, None, *clash),
        (None, "revisit", "http://host.example/a", 99, 304, '"t"', None, None, *clash),
        (9, "response", "http://host.example/a", 99, 404, '"t"', None, None, *clash),
    ]
    records = spark.createDataFrame(rows, RECORDS)
    got = sorted((r.record_id or 0, r.outcome, r.response_id) for r in revisits.resolved(records).collect())
    assert got == [(0, "no_response", None), (2, "resolved", 1), (2, "resolved", 1), (4, "unchecked", 3), (6, "no_response", None)]
    assert revisits.resolved(records.limit(0)).count() == 0

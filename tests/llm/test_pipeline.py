"""The pipeline stage by stage against plain versions, each on what its predecessor kept."""

import __spark_entry__ as entry
import corpus_pipeline
from eventloom.llm import fertility, secrets
from eventloom.llm.stored import stored
from tests.conftest import SF
from tests.llm import brute


def test_stages_equal_plain_versions(spark, forest):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], SF)))
    quality, unique, clean, masked, pieces = kept[1:]
    assert all(df.columns == columns for df in kept[:-1])
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}

    judged, m = fertility.judged(docs)
    assert ids(quality) == ids(judged.filter(f"{m}.kept"))
    for r in docs.collect():
        n_words, _, _, _, repeated = brute.base_counts(r.text)
        if n_words < 20 or 100 * repeated > 30 * n_words:
            assert r.doc_id not in ids(quality)

    rows = [(r.doc_id, r.text) for r in quality.collect()]
    assert ids(unique) == {i for i, _, least in brute.classes(rows, 5, 80, 100) if i == least}

    runs = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = brute.words(brute.folded(r.text))
        runs |= {tuple(w[k : k + 13]) for k in range(len(w) - 12)}
    leaks = set()
    for r in unique.collect():
        w = brute.words(brute.folded(r.text))
        if any(tuple(w[k : k + 13]) in runs for k in range(len(w) - 12)):
            leaks.add(r.doc_id)
    assert ids(clean) == ids(unique) - leaks and leaks

    found = {}
    for r in secrets.findings(clean, forest=forest).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.end))
    for before, after in zip(clean.orderBy("doc_id").collect(), masked.orderBy("doc_id").collect()):
        text = before.text
        for a, b in sorted(found.get(before.doc_id, []), reverse=True):
            text = text[:a] + secrets.MASK + text[b:]
        assert after.text == text and after.n_chars == len(text)

    assert ids(pieces) == ids(masked) and pieces.count() == 2 * masked.count()
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" in entry.queries() and "pipeline" not in entry.oracle_sql()


def test_run_gives_the_last_stage(spark):
    got = entry.queries()["pipeline"](spark, SF)
    assert got.count() > 0 and {"doc_id", "number", "ids", "log_inclusion"} <= set(got.columns)

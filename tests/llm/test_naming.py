"""Block naming against plain grouping of whole texts."""

import hashlib
import random
import re
from collections import defaultdict

import pytest

from check_queries import compare, connect
from eventloom.llm import naming
from tests.conftest import SF

SCHEMA = "doc_id long, text string, copies string, key string, row string, id string"


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[plain(t)].append((-len(t or ""), i is None, i))
    out = []
    for i, t, *_ in rows:
        members = groups[plain(t)]
        best = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        out.append((i, best[2], len(members), hashlib.sha256(plain(t).encode()).hexdigest()))
    return out


def check(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x", None, "y", "z") for r in rows], SCHEMA).repartition(5)
    found, m = naming.grouped(docs, **options)
    assert found.columns == [*docs.columns, m] and m not in docs.columns
    got = found.select("doc_id", f"{m}.*").collect()
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=order) == sorted(expected(rows), key=order)
    by_identity = defaultdict(list)
    for r in got:
        by_identity[r.identity].append(r)
    assert len(by_identity) == len({plain(t) for _, t in rows})
    for members in by_identity.values():  # one name per text, one row of each stays and is the one named
        assert len({r.text_sha256 for r in members}) == 1
        assert [(r.doc_id == r.keep_id) for r in members if r.kept] == [True] or members[0].keep_id is None
        assert sum(r.kept for r in members) == 1
    return got


@pytest.mark.parametrize("block", [1, 3, 64, naming.BLOCK_BYTES])
def test_names_of_random_texts(spark, block):
    rng = random.Random(block)
    rows = [(k, "".join(rng.choice("ab \n") for _ in range(rng.randint(0, 9)))) for k in range(300)]
    rows += [(1000 + k, "x" * k) for k in range(0, 40)] + [(2000 + k, "é中 " * (k % 7)) for k in range(60)]
    rows += [(3000 + k, "long " * 900 + ("a" if k % 3 else "b") + "c" * (k % 2)) for k in range(12)] * 2
    check(spark, rows, block=block)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(5, None), (4, ""), (None, " \t\x0b"), (7, "a b"), (3, "ab "), (3, "ab "), (None, "ab "), (None, "only  without id"), (None, "only without id"), (9, "a b"), (-(2**63), "ab ")]
    got = check(spark, rows)
    assert {(r.keep_id, r.group_size) for r in got} >= {(-(2**63), 5), (None, 2), (9, 1), (None, 3)}


def test_dictionaries_that_are_closed_early(spark, monkeypatch):
    monkeypatch.setattr(naming, "BOOK_BYTES", 300)
    rng = random.Random(3)
    check(spark, [(k, rng.choice(["same text of a third", f"text {k % 20}", f"own {k}" * 30])) for k in range(200)], block=16)


def test_deduplicated(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "ab", "y"), (3, "c", None), (4, None, None), (5, " ", None)], "doc_id long, text string, more string")
    kept = naming.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [(1, "a b", "x"), (3, "c", None), (5, " ", None)]
    assert naming.deduplicated(docs.limit(0)).count() == 0


def test_query_equals_its_sql(spark):
    assert compare(spark, connect(SF), "op11_block_naming", SF)[0] is None

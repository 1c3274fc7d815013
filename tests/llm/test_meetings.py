"""What meets at a key in passages, batch after batch, against whole groups."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventloom.llm import passages
from tests.llm import brute


def batches(rows, names, kinds, size):
    return [pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows[i : i + size]), kinds)], names=names) for i in range(0, len(rows), size)]


def keyed(rng, n):
    return [(rng.choice([-3, 0, 5, 9]) if rng.random() < 0.5 else rng.randint(-200, 200), rng.choice([1, 2, 3, rng.randint(10, 90)])) for _ in range(n)]


@pytest.mark.parametrize("size", [1, 2, 7, 1000])
def test_rows_that_meet_at_a_key(size):
    rng = random.Random(size)
    rows = [((key << passages.SIZE_BITS) + 1 + content % 16, content, rng.choice([None, content])) for key, content in keyed(rng, 400)]
    groups = {}
    for k, content, _ in rows:
        groups.setdefault(k >> passages.SIZE_BITS, set()).add(content)
    want = {(k >> passages.SIZE_BITS, c) for k, c, _ in rows if len(groups[k >> passages.SIZE_BITS]) > 1}
    kinds = [pa.int64()] * 3
    for one in groups:  # a key at a time tells which key a row that comes back is of
        mine = sorted((r for r in rows if r[0] >> passages.SIZE_BITS == one), key=lambda r: r[0])
        got = [r for b in passages._met(iter(batches(mine, ["key", "content", "low"], kinds, size))) for r in b.to_pylist()]
        assert {(one, r["content"]) for r in got} == {x for x in want if x[0] == one}
        sizes = {1 + c % 16 for c in groups[one]}
        for r in got:
            own = 1 + r["content"] % 16
            assert r["smallest"] == min(sizes) and r["low"] in (None, r["content"])
            assert {s for s in sizes if s <= own} <= {s for s in range(63) if r["sizes"] >> s & 1} <= sizes
    ordered = sorted(rows, key=lambda r: r[0])
    got = [r["content"] for b in passages._met(iter(batches(ordered, ["key", "content", "low"], kinds, size))) for r in b.to_pylist()]
    assert set(got) == {c for _, c in want}


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_links_of_a_key_are_those_of_its_smaller_side(size):
    rng = random.Random(40 + size)
    rows = sorted((2 * key + (key % 3 == 0 and content > 40), content) for key, content in keyed(rng, 300))
    found = batches(rows, ["key", "content"], [pa.int64()] * 2, size)
    links = {(r["a"], r["b"]) for b in passages._starred(iter(found)) for r in b.to_pylist()}

    def classes(pairs):
        root = {c: c for _, c in rows}
        find = lambda c: c if root[c] == c else find(root[c])
        for a, b in pairs:
            root[find(a)] = find(b)
        return [find(c) for _, c in rows]

    expected = set()
    for key in {k >> 1 for k, _ in rows}:
        small = {c for k, c in rows if k == 2 * key}
        expected |= {(a, c) for a in small for k, c in rows if k >> 1 == key}
    parts = lambda marks: {frozenset(i for i, m in enumerate(marks) if m == x) for x in marks}
    assert links <= expected and parts(classes(links)) == parts(classes(expected))


@pytest.mark.parametrize("size", [1, 4, 1000])
def test_what_is_asked_of_a_text_is_one_list(size):
    rng = random.Random(50 + size)
    rows = sorted((rng.randint(0, 12), k, rng.randint(1, 16)) for k in range(90))
    found = batches(rows, ["_sample", "content", "smallest"], [pa.int64(), pa.int64(), pa.int32()], size)
    got = [r for b in passages._listed(iter(found)) for r in b.to_pylist()]
    assert [r["_sample"] for r in got] == sorted({r[0] for r in rows})
    assert [(r["_sample"], w["content"], w["smallest"]) for r in got for w in r["wanted"]] == rows
    assert list(passages._listed(iter([]))) == []


def test_partners_of_sets_hold_all_similar_ones_and_few_others(spark):
    """A long set whose bucket holds a short one makes subsets for shorter ones only where it agrees with such."""
    rng, rule = random.Random(60), passages.Banding()
    texts = []
    for k in range(60):  # sets of 16 and, with a loop in the last words, of 13 that are contained in them
        words = [f"w{k}_{j}" for j in range(7)] * 3
        texts.append(" ".join(words[:20]))
        texts.append(" ".join([*words[:19], f"x{k}"]))
        texts.append(" ".join(f"v{rng.randint(0, 10**9)}" for _ in range(20)))
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    banded = docs.mapInArrow(passages._banded(rule), "id long, start long, content long, size int, bands array<long>")
    wanted = banded.select("content", F.lit(1).alias("smallest"), F.col("id").alias("low"))
    rows = passages._sets(wanted, docs, rule).collect()
    sets = {r.content: frozenset(np.frombuffer(r.shingles, np.int64).tolist()) for r in rows}
    partners = {r.content: r.partners for r in rows}
    ids = {r.content: r.id for r in banded.collect()}
    want = {k: brute.shingles(t, 5) for k, t in enumerate(texts)}
    similar = [(a, b) for a in want for b in want if a != b and 1.8 * len(want[a] & want[b]) >= 0.8 * (len(want[a]) + len(want[b]))]
    assert len(similar) >= 60
    of = {i: c for c, i in ids.items() if c in sets}
    assert all(partners[of[a]] >> len(want[b]) & 1 for a, b in similar)
    unlike = [k for k in want if k % 3 == 2]
    assert sum(k in of and partners[of[k]] & sum(1 << s for s in (13, 14, 15)) != 0 for k in unlike) < 6

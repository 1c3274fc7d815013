"""Hard negatives against scoring every pair."""

import math

import numpy as np
import pytest

from check_queries import compare, connect
from eventloom.llm import negatives
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<double>, label long, tile string, v string"


def expected(rows, options=negatives.Mining()):
    usable = {(i, lab, tuple(math.floor(256 * x) for x in v)) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) and abs(x) < negatives.LARGEST for x in v)}
    out = []
    for i, lab, v in usable:
        if i % options.every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in usable)
        positives = [(j, -s) for s, j, other in scored if other == lab and j != i][: options.positives]
        for j, p in positives:
            fit = [(n, -s) for s, n, other in scored if other != lab and options.low * p <= -100 * s <= options.high * p]
            out += [(i, j, k, n, p, s) for k, (n, s) in enumerate(fit[: options.negatives], 1)]
    return out


def check(spark, rows, **options):
    options = negatives.Mining(**options)
    df = spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA).repartition(3)
    got = negatives.mined(df, options=options)
    assert sorted(map(tuple, got.collect())) == sorted(expected(rows, options))


def vectors(seed, n, d=6, scale=1.0, clusters=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, d)) * scale
    return [(k, (centres[k % clusters] + rng.normal(size=d) * 0.3 * scale).round(2).tolist(), int(rng.integers(0, 4))) for k in range(n)]


@pytest.mark.parametrize("tile_rows", [40, 8192])
def test_against_all_pairs(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(negatives, "TILE_ROWS", tile_rows)
    monkeypatch.setattr(negatives, "TILES", 5)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 7)
    check(spark, vectors(tile_rows, 260), every=9)


def test_copies_ties_and_awkward_rows(spark):
    hot = [(k, [0.5, 0.25, -0.125], k % 3) for k in range(0, 120)]
    near = [(k, [0.5, 0.2, 0.01 * (k % 4)], k % 2) for k in range(200, 260)]
    far = [(k, [0.25, 0.0, 0.0], 5) for k in range(300, 306)] + [(400, [-1.0, -1.0, 0.0], 7), (401, [-1.0, 0.0, 0.0], 7)]
    bad = [(500, None, 1), (600, [0.1, None, 0.2], 1), (700, [math.nan, 0.1, 0.1], 1), (800, [math.inf, 0.1, 0.1], 1), (900, [0.5, 0.2, 0.1], None), (None, [0.5, 0.2, 0.1], 1), (1000, [2.0**16, 0.0, 0.0], 1)]
    odd = [(1100, [], 1), (1200, [0.5], 1), (0, [0.5, 0.25, -0.125], 0), (0, [0.5, 0.25, -0.125], 0)]
    check(spark, hot + near + far + bad + odd, every=20, positives=4, negatives=6)


def test_exact_with_large_components(spark):
    check(spark, vectors(3, 90, d=3, scale=20_000.0), every=10)


def test_no_anchors_and_empty_table(spark):
    check(spark, [(k, [1.0], 0) for k in range(1, 5)])
    check(spark, [(100, [1.0], 0), (1, [0.5], 1)])  # an anchor without positives
    assert negatives.mined(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_boxes_and_search(monkeypatch, seed):
    monkeypatch.setattr(negatives, "LEAF", 4)
    monkeypatch.setattr(negatives, "FAN", 3)
    rng = np.random.default_rng(seed)
    x = rng.integers(-9, 10, (int(rng.integers(1, 200)), 3)) + 40 * rng.integers(-1, 2, (1, 3))
    tree = negatives.Tree(x, rng.permutation(len(x)), rng.integers(0, 3, len(x)))
    assert sorted(tree.ids) == list(range(len(x))) and tree.base[-1] - tree.base[-2] == 1
    for level in range(1, len(tree.base) - 1):  # a box holds its children
        for box in range(tree.base[level], tree.base[level + 1]):
            inside = list(tree.children(level, box))
            assert (tree.low[inside].min(axis=0) == tree.low[box]).all() and (tree.high[inside].max(axis=0) == tree.high[box]).all()
    q = rng.integers(-9, 10, (20, 3))
    least, most, floor = rng.integers(-200, 0, 20), rng.integers(0, 200, 20), rng.integers(-300, 50, 20)
    labels = rng.integers(0, 3, 20)
    for same in (True, False):
        got = negatives.search(tree, negatives.Requests(q, labels, least, most, floor, same, 5))
        for r, (s, i) in enumerate(got):
            want = sorted((-int(q[r] @ tree.vectors[k]), int(tree.ids[k])) for k in range(len(x)) if (tree.labels[k] == labels[r]) == same)
            want = [(-t, k) for t, k in want if max(least[r], floor[r]) <= -t <= most[r]][:5]
            assert list(zip(s.tolist(), i.tolist())) == want


def test_query_equals_its_sql(spark):
    assert compare(spark, connect(SF), "op12_hard_negatives", SF)[0] is None

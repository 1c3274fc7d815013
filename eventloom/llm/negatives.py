"""Hard negatives by best-first search over STR-packed R-trees.

Vectors are rounded to integers and an anchor's score with a row is their inner product. The rows are dealt into tiles
by sorting them along one coordinate into slabs and each slab along a second one (sort-tile-recursive); a task packs the
rows of a tile in the same way down to leaves and keeps the least and greatest value per coordinate of each leaf and of
each run of leaves. Such a box gives an interval that holds all inner products of an anchor with its rows, so a queue
that opens the most promising box first leaves out boxes outside the wanted scores or strictly below the k-th found.

Anchors are a stated query set and meet all tiles in blocks of bounded size. They begin with their own tile and go on
to twice as many tiles in each round, with the k-th score found so far as a bound, so what a round gives out is a few rows
per anchor and not k rows per anchor and tile.

Copies: rows of one label with equal vectors have equal scores, so only those of the smallest ids can be among the
first k; more of them are left out before any search (exactly, by rank). Anchors with equal vector and label are
searched once. A search first finds positives (the same label), then, for each positive's score, the negatives.

Edge cases: rows without id, label or vector, or with a component that is null or not finite, take no part; nor do
those with a component of 2^16 or more in size, as a hundredfold score must fit 64 bits. A shorter vector counts as padded with
zeros. Rows that repeat id, label and vector count once. Ties go to the smaller id. Without anchors, positives or negatives
in the window there are no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from eventloom.llm.naming import spread_join
from eventloom.llm.stored import stored

SCALE = 256
LARGEST = 1 << 16
#: Rows are dealt to TILES tiles at least, unless these have fewer than TILE_ROWS rows, and no tile has more than about
#: TILE_NUMBERS components.
TILES, TILE_ROWS, TILE_NUMBERS = 64, 8_192, 1 << 24
LEAF, FAN = 256, 8
#: Anchors that meet a tile in one task, and of these how many are searched together.
BLOCK_ANCHORS, TOGETHER = 65_536, 512


@dataclass(frozen=True)
class Mining:
    """An anchor is a row whose id is divisible by `every`. It has the first `positives` other rows of its label; each
    of these the first `negatives` rows of other labels whose score is from low to high hundredths of the positive's."""

    every: int = 100
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90


# --- the tree of one tile


class Tree:
    """Rows packed into leaves of LEAF rows; boxes of leaves, then of FAN boxes each, up to one."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        order = packed(vectors, np.arange(len(vectors)), LEAF)
        self.vectors, self.ids, self.labels = vectors[order], ids[order], labels[order]
        starts = np.arange(0, len(order), LEAF)
        low, high = np.minimum.reduceat(self.vectors, starts), np.maximum.reduceat(self.vectors, starts)
        #: Level 0 holds the leaves; self.base[k] is where level k begins among all boxes.
        lows, highs, self.base = [low], [high], [0, len(low)]
        while len(low) > 1:
            starts = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            lows.append(low)
            highs.append(high)
            self.base.append(self.base[-1] + len(low))
        self.low, self.high = np.concatenate(lows), np.concatenate(highs)

    def children(self, level: int, box: int) -> range:
        first = (box - self.base[level]) * FAN
        return range(self.base[level - 1] + first, min(self.base[level - 1] + first + FAN, self.base[level]))


def packed(vectors: np.ndarray, rows: np.ndarray, leaf: int) -> np.ndarray:
    """rows in the order of sort-tile-recursive packing: sorted along the widest coordinate, cut into as many slabs as
    the square root of the leaves needed, and each slab packed in turn."""
    leaves = -(-len(rows) // leaf)
    if leaves <= 1:
        return rows
    part = vectors[rows]
    axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
    rows = rows[np.argsort(part[:, axis], kind="stable")]
    slabs = int(np.ceil(np.sqrt(leaves)))
    step = -(-leaves // slabs) * leaf
    return np.concatenate([packed(vectors, rows[k : k + step], leaf) for k in range(0, len(rows), step)])


@dataclass
class Requests:
    """What is sought: for each anchor the first k rows with scores from least to most, of its label or of others.
    floor is the score of the k-th found so far, in other tiles."""

    vectors: np.ndarray
    labels: np.ndarray
    least: np.ndarray
    most: np.ndarray
    floor: np.ndarray
    same: bool
    k: int


def search(tree: Tree, ask: Requests) -> list[tuple[np.ndarray, np.ndarray]]:
    """Scores and ids of the first k of each request in this tree that are not below its floor, best first."""
    none = np.zeros(0, np.int64)
    found = [(none, none)] * len(ask.vectors)
    bound = np.maximum(ask.least, ask.floor)
    # Sums of products are exact in doubles below 2^53, and much faster there.
    size = max(1, int(np.abs(tree.vectors).max(initial=0))) * max(1, int(np.abs(ask.vectors).max(initial=0))) * tree.vectors.shape[1]
    kind = np.float64 if size < 1 << 53 else np.int64
    q, x = ask.vectors.astype(kind), tree.vectors.astype(kind)
    low, high = tree.low.astype(kind), tree.high.astype(kind)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    tops = (up @ high.T + down @ low.T).astype(np.int64)
    bottoms = (up @ low.T + down @ high.T).astype(np.int64)

    def alive(box: int) -> np.ndarray:
        return np.flatnonzero((tops[:, box] >= bound) & (bottoms[:, box] <= ask.most))

    def promise(box: int, who: np.ndarray) -> int:
        return int(np.minimum(tops[who, box], ask.most[who]).max())

    level, root = len(tree.base) - 2, tree.base[-2]
    queue = [(0, level, root)]
    while queue:
        _, level, box = heapq.heappop(queue)
        who = alive(box)
        if not len(who):
            continue
        if level:
            for child in tree.children(level, box):
                there = alive(child)
                if len(there):
                    heapq.heappush(queue, (-promise(child, there), level - 1, child))
            continue
        rows = slice(box * LEAF, (box + 1) * LEAF)
        scores = (q[who] @ x[rows].T).astype(np.int64)
        fits = (scores >= bound[who, None]) & (scores <= ask.most[who, None])
        fits &= (tree.labels[rows][None, :] == ask.labels[who, None]) == ask.same
        for k in np.flatnonzero(fits.any(axis=1)).tolist():
            r = who[k]
            s = np.concatenate([found[r][0], scores[k, fits[k]]])
            i = np.concatenate([found[r][1], tree.ids[rows][fits[k]]])
            first = np.lexsort((i, -s))[: ask.k]
            found[r] = s[first], i[first]
            if len(first) == ask.k:
                bound[r] = max(bound[r], s[first[-1]])
    return found


# --- the distributed search


def _matrix(column: pa.Array | pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Lists of integers as rows, shorter ones padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), max(width, int(sizes.max(initial=1)), 1)), np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    out[np.repeat(np.arange(len(column)), sizes), np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


FOUND = T.StructType([T.StructField(c, T.LongType()) for c in ("request", "score", "id")])


def _in_tile(same: bool, k: int):
    arrow = to_arrow_schema(FOUND)

    def run(anchors, rows):
        if not anchors.num_rows or not rows.num_rows:
            return arrow.empty_table()
        x = _matrix(rows.column("v"))
        q = _matrix(anchors.column("v"), x.shape[1])
        x = np.pad(x, ((0, 0), (0, q.shape[1] - x.shape[1])))
        tree = Tree(x, rows.column("id").to_numpy(), rows.column("label").to_numpy())
        numbers = {c: anchors.column(c).to_numpy() for c in ("request", "label", "least", "most", "floor")}
        out = []
        for start in range(0, len(q), TOGETHER):
            part = slice(start, start + TOGETHER)
            ask = Requests(q[part], *[numbers[c][part] for c in ("label", "least", "most", "floor")], same, k)
            for r, (s, i) in zip(numbers["request"][part], search(tree, ask)):
                if len(s):
                    out.append((np.full(len(s), r), s, i))
        if not out:
            return arrow.empty_table()
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=arrow)

    return run


LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _first(rows: DataFrame, k: int) -> DataFrame:
    """The first k rows (request, score, id) of each request, with their rank."""
    order = Window.partitionBy("request").orderBy(F.desc("score"), "id")
    return rows.select("request", "score", "id", F.row_number().over(order).alias("rank")).filter(F.col("rank") <= k)


def _searched(asked: DataFrame, rows: DataFrame, n_tiles: int, n_blocks: int, same: bool, k: int) -> DataFrame:
    """(request, score, id, rank) of the first k rows for each request (request, v, label, tile, least, most)."""
    block = F.pmod(F.xxhash64("v"), F.lit(n_blocks)).cast("int")
    dealt = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    found, first, stop = None, 0, 1
    while first < n_tiles:
        open_ = asked.withColumn("floor", F.lit(LEAST))
        if found is not None:
            # With k found, the k-th score is a floor for what other tiles have to offer.
            floors = found.filter(F.col("rank") == k).select("request", F.col("score").alias("kth"))
            open_ = asked.join(floors, "request", "left").withColumn("floor", F.coalesce("kth", F.lit(LEAST))).drop("kth")
        offsets = F.explode(F.sequence(F.lit(first), F.lit(min(stop, n_tiles) - 1)))
        sent = open_.withColumn("block", block).withColumn("offset", offsets)
        sent = sent.withColumn("tile", ((F.col("tile") + F.col("offset")) % n_tiles).cast("int")).drop("offset")
        sent = sent.withColumnsRenamed({"tile": "to_tile", "block": "to_block"})
        new = sent.groupBy("to_tile", "to_block").cogroup(dealt.groupBy("tile", "block")).applyInArrow(_in_tile(same, k), FOUND)
        if found is not None:
            new = new.unionByName(found.select("request", "score", "id"))
        found = stored(_first(new, k))
        first, stop = stop, 2 * stop
    return found


def _tiled(rows: DataFrame) -> tuple[Callable[[Column], Column], int]:
    """How a vector is dealt to a tile (a column of its array), and the number of tiles. Cuts come from all rows."""
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    n_tiles = max(1, -(-n // min(max(TILE_ROWS, n // TILES), max(1, TILE_NUMBERS // (width or 1)))))
    slabs = int(np.ceil(np.sqrt(n_tiles)))
    per_slab = -(-n_tiles // slabs)
    if n_tiles == 1:
        return lambda v: F.lit(0), 1
    spread = rows.select(F.posexplode("v").alias("axis", "x")).groupBy("axis").agg(F.variance("x").alias("s"))
    axes = [r.axis for r in spread.orderBy(F.desc("s"), "axis").limit(2).collect()] or [0]

    def along(v: Column, k: int) -> Column:
        # Rows with equal coordinates are told apart by a fraction, so that slabs can be of equal size.
        fraction = F.pmod(F.xxhash64(v, F.lit(k)), F.lit(1 << 20)) / F.lit(float(1 << 20))
        return F.coalesce(F.get(v, F.lit(axes[min(k, len(axes) - 1)])), F.lit(0)) + fraction

    def cuts(x: Column, parts: int) -> Column:
        points = [k / parts for k in range(1, parts)]
        return F.percentile_approx(x, F.array(*map(F.lit, points)), F.lit(100 * parts)) if points else F.array().cast("array<double>")

    first = rows.agg(cuts(along(F.col("v"), 0), slabs).alias("c")).first().c or []
    place = lambda x, c: F.size(F.filter(c, lambda y: y <= x))
    slab = lambda v: place(along(v, 0), F.array(*map(F.lit, first)).cast("array<double>"))
    inner = rows.groupBy(slab(F.col("v")).alias("slab")).agg(cuts(along(F.col("v"), 1), per_slab).alias("c")).collect()
    by_slab = {r.slab: r.c or [] for r in inner}
    table = F.array(*[F.array(*map(F.lit, by_slab.get(k, []))).cast("array<double>") for k in range(slabs)])

    def tile(v: Column) -> Column:
        return (slab(v) * per_slab + place(along(v, 1), F.get(table, slab(v)))).cast("int")

    return tile, slabs * per_slab


def mined(rows: DataFrame, identifier: str = "vec_id", vector: str = "embedding", label: str = "label", options: Mining = Mining()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): the hard negatives of each anchor and
    positive, from rank 1."""
    v = F.transform(rows[f"`{vector}`"].cast("array<double>"), lambda x: F.floor(SCALE * x))
    usable = F.forall("x", lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < LARGEST))
    source = rows.select(
        rows[f"`{identifier}`"].cast("long").alias("id"), rows[f"`{label}`"].cast("long").alias("label"), rows[f"`{vector}`"].cast("array<double>").alias("x"), v.alias("v")
    )
    source = source.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & usable).select("id", "label", F.col("v").cast("array<int>").alias("v"))
    order = Window.partitionBy("v", "label").orderBy("id")
    most = max(options.positives + 1, options.negatives)
    searched = source.withColumn("copy", F.dense_rank().over(order)).filter(F.col("copy") <= most).drop("copy").distinct()
    searched = stored(searched)
    tile, n_tiles = _tiled(searched)
    searched = searched.withColumn("tile", tile(F.col("v")))

    anchors = stored(source.filter(F.col("id") % options.every == 0).distinct())
    classes = stored(anchors.select("v", "label").distinct().withColumn("class", F.monotonically_increasing_id()))
    n_blocks = max(1, -(-classes.count() // BLOCK_ANCHORS))
    asked = classes.select(
        F.col("class").alias("request"), "v", "label", tile(F.col("v")).alias("tile"), F.lit(LEAST).alias("least"), F.lit(MOST).alias("most")
    )
    positives = _searched(asked, searched, n_tiles, n_blocks, True, options.positives + 1)

    # Windows of negatives: one request per anchor class and positive score.
    windows = positives.select(F.col("request").alias("class"), "score").distinct()
    windows = stored(windows.withColumn("request", F.monotonically_increasing_id()))
    # Negative scores have no window: the bounds would be the wrong way round.
    least, most = F.expr(f"({options.low} * score + 99) div 100"), F.expr(f"({options.high} * score) div 100")
    bounds = windows.filter("score >= 0").withColumn("least", least).withColumn("most", most)
    asked = bounds.filter("least <= most").join(asked.select(F.col("request").alias("class"), "v", "label", "tile"), "class").drop("class", "score")
    asked = stored(asked.select("request", "v", "label", "tile", "least", "most"))
    negatives = _searched(asked, searched, n_tiles, n_blocks * (options.positives + 1), False, options.negatives)
    listed = negatives.groupBy("request").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "id"))).alias("negatives"))
    answered = positives.withColumnsRenamed({"request": "class", "rank": "place", "id": "positive_id"})
    answered = answered.join(windows, ["class", "score"]).join(listed, "request", "left")
    answered = answered.groupBy("class").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "score", "negatives"))).alias("answers"))
    answered = classes.join(answered, "class").select("v", "label", "answers")

    asking = anchors.withColumnRenamed("id", "anchor_id").withColumn("shard", F.pmod(F.xxhash64("anchor_id"), F.lit(64)))
    joined = spread_join(asking, answered, ["v", "label"], "shard")
    others = F.slice(F.filter("answers", lambda a: a.positive_id != F.col("anchor_id")), 1, options.positives)
    joined = joined.select("anchor_id", F.explode(others).alias("p")).select("anchor_id", "p.positive_id", F.col("p.score").alias("positive_score"), F.explode("p.negatives").alias("n"))
    return joined.select(
        "anchor_id", "positive_id", F.col("n.rank").cast("int").alias("rank"), F.col("n.id").alias("negative_id"), "positive_score", F.col("n.score").alias("negative_score")
    )

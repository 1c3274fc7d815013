"""Jaccard self-join on word n-grams through trees over count vectors.

A text is the set of its distinct word shingles. Shingles are hashed into groups; a text's point is how many of its
shingles fall into each group. The overlap of two sets is at most the sum of the coordinate minima of their points, so
two sets of sizes a and b whose Jaccard is at least p/q have points at an L1 distance of at most
r = (a + b)(q - p) / (q + p).

The tree, from its root down:
 1. Classes. Texts of equal sets are one point; only classes are joined, so copies cost nothing.
 2. Size ranges. Jaccard bounds the ratio of sizes, so a point is compared within its range, and the first part of a
    range is also reached from the range below.
 3. Slices. A range has more than r slices of coordinates, r being the largest distance of its pairs: distances add up
    over slices, so a pair within r agrees in all coordinates of one slice at least. In each slice's tree the query thus has
    radius zero, and the leaf it ends in, the cell, is found by the hash of the slice's counts. A shared passage does
    not make a cell hot: a cell holds those who agree in *all* their shingles of a slice.
 4. Pages. Points are first held against the leader of one of their cells; in each further round, against one leader that
    is not in their component yet. Where the links found leave more than one component in a cell, pages of its points
    are held against each other by sketches, whose bound on the distance is nearly the distance itself. Cells of equal
    members are one cell. A page gives out a forest of its near pairs, nearest first: if all of them link, so do all the
    others. Only the cells of those that do not are gone through again, then for all near pairs.
Surviving pairs are verified on the sets. Links are complete up to connectivity: two linked texts are always in one
component, though a pair within one component need not be tested once the component is known.

Sets, classes and cells are compared by 64-bit hashes of words and shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.components import components, led, still_open
from eventloom.llm.rows import free_name, with_found
from eventloom.llm.stored import forget, stored
from eventloom.llm.words import FOLDED_KEYS, Hasher, Texts, keys, mix, release, windows

#: Points have so many coordinates (the bound on the whole vector); slices have finer groups of their own.
GROUPS = 256
GROUP_SHIFT = np.uint64(64 - (GROUPS - 1).bit_length())
SUBGROUPS = 1 << 20
#: Size ranges grow by this ratio.
RANGE_RATIO = 1.4
#: Cells are gathered in so many passes over disjoint parts of them, which bounds the disk that one shuffle takes.
PASSES = 4
#: Sketches have 4 to 8 groups per unit of distance, so that few groups differ in three shingles or more.
SKETCH_GROUPS = (64, 1 << 13)
#: Bits of a group: whether its shingles are odd in number, and exclusive ors of bits of theirs.
PLANES = 4
#: Points in a page of a cell, about.
PAGE = 1024
#: A task takes pages of so many bytes, about, so that a batch of them is small.
PAGE_BYTES = 1 << 23
#: Rounds in which each set is held against one leader of a cell, before what is left is compared by pages.
ROUNDS = 2


@dataclass(frozen=True)
class Join:
    """Shingles of `width` words; linked from a Jaccard of num / den on."""

    width: int = 5
    num: int = 80
    den: int = 100

    def reach(self, total: int) -> int:
        """Largest L1 distance of a linked pair whose sizes sum up to total."""
        return total * (self.den - self.num) // (self.den + self.num)

    def groups(self, n: int) -> int:
        """Groups of the sketch of a set of n shingles, a power of two."""
        least, most = SKETCH_GROUPS
        return min(max(1 << (4 * self.reach(2 * n)).bit_length(), least), most)

    def ranges(self, n: int) -> list[tuple[int, int, int]]:
        """(range, slices, spare slices) in which a set of n shingles has cells; none if only an equal set can link with it."""
        largest = n * self.den // self.num
        if self.reach(n + largest) == 0:
            return []
        home = int(np.log(n) / np.log(RANGE_RATIO) + 1e-9)
        below = int(np.ceil(RANGE_RATIO**home))
        found = [home] if n >= below else []
        if home > 0 and self.num * n <= self.den * (below - 1):  # it may link with a smaller one of the range below
            found.append(home - 1)
        out = []
        for k in found:
            top = int(np.ceil(RANGE_RATIO ** (k + 1))) - 1
            least = self.reach(top + top * self.den // self.num) + 1
            spare = -(-least // 10)
            out.append((k, least + spare, spare))
        return out


POINT = T.StructType([
    T.StructField("n_shingles", T.LongType()),
    T.StructField("set", T.LongType()),
    T.StructField("point", T.ArrayType(T.IntegerType())),
    T.StructField("cells", T.ArrayType(T.LongType())),
    T.StructField("sketch", T.BinaryType()),
])
SET = T.StructType([T.StructField("set", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle, without words none."""
    texts = Texts(column)
    hashes = Hasher(texts.data, FOLDED_KEYS)(texts.start, texts.end)
    shingles, at = windows(hashes, texts.first, width)
    cuts = np.searchsorted(at, texts.first)
    for i in range(texts.n):
        a, b = cuts[i], cuts[i + 1]
        if b > a:
            yield np.unique(shingles[a:b])
        elif texts.counts[i]:
            short = hashes[texts.first[i] : texts.first[i + 1]]
            yield mix((short * keys(len(short), 7)).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(short)))
        else:
            yield shingles[:0]


def set_key(shingles: np.ndarray) -> int:
    total = mix(shingles ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64)
    return int(mix(np.array([total + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def _cells(shingles: np.ndarray, ranges: list[tuple[int, int, int]]) -> np.ndarray:
    """Keys of the cells of a set. A linked pair agrees in more slices than there are spare ones, so a set with no more
    empty slices than that agrees in one that is not empty, and its empty ones need no cell."""
    out = []
    for k, n_slices, spare in ranges:
        seed = np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        sums = mix(np.arange(n_slices, dtype=np.uint64) + seed)
        which = ((shingles >> np.uint64(33)) % np.uint64(n_slices)).astype(np.int64)
        group = which.astype(np.uint64) * np.uint64(SUBGROUPS) + (shingles & np.uint64(SUBGROUPS - 1))
        np.add.at(sums, which, mix(group + ~seed))
        filled = np.bincount(which, minlength=n_slices) > 0
        out.append(mix(sums if n_slices - filled.sum() > spare else sums[filled]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _lists(parts: list[np.ndarray], kind: np.dtype) -> pa.Array:
    lengths = np.array([len(p) for p in parts], np.int32)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    values = np.concatenate(parts).view(kind) if parts else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _sketch(shingles: np.ndarray, groups: int) -> bytes:
    """PLANES rows of a bit per group, as 64-bit words; the halves of a row add up to the row of half as many groups."""
    group = ((shingles >> np.uint64(21)) % np.uint64(groups)).astype(np.int64)
    bits = ((shingles[None] >> np.arange(PLANES, dtype=np.uint64)[:, None]) & np.uint64(1)).astype(np.uint8)
    bits[0] = 1
    out = np.zeros((PLANES, groups), np.uint8)
    for plane in range(PLANES):
        np.bitwise_xor.at(out[plane], group, bits[plane])
    return np.packbits(out, axis=1, bitorder="little").tobytes()


def least_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """What sets differ by at least, by their sketches: groups of unequal parity hold one shingle that the other set has
    not, groups that differ otherwise two."""
    odd = p[..., 0, :] ^ q[..., 0, :]
    other = p[..., 1, :] ^ q[..., 1, :]
    for plane in range(2, PLANES):
        other |= p[..., plane, :] ^ q[..., plane, :]
    return np.bitwise_count(odd).sum(-1, dtype=np.int32) + 2 * np.bitwise_count(other & ~odd).sum(-1, dtype=np.int32)


def _points(join: Join):
    def find(column: pa.Array) -> list[pa.Array]:
        n, key, points, cells, sketches = [], [], [], [], []
        for s in shingle_sets(column, join.width):
            n.append(len(s))
            key.append(set_key(s))
            points.append(np.bincount((s >> GROUP_SHIFT).astype(np.int64), minlength=GROUPS).astype(np.int32))
            cells.append(_cells(s, join.ranges(len(s))) if len(s) else s)
            sketches.append(_sketch(s, join.groups(len(s))))
        return [pa.array(n, pa.int64()), pa.array(key, pa.int64()), _lists(points, np.int32), _lists(cells, np.int64), pa.array(sketches, pa.binary())]

    return lambda: find


def _sets(join: Join):
    def find(column: pa.Array) -> list[pa.Array]:
        sets = list(shingle_sets(column, join.width))
        return [pa.array([set_key(s) for s in sets], pa.int64()), _lists(sets, np.int64)]

    return lambda: find


def _enough(overlap: Column, n_a: Column, n_b: Column, join: Join) -> Column:
    """den * overlap >= num * union."""
    return (join.den + join.num) * overlap >= join.num * (n_a + n_b)


def _bounded(pairs: DataFrame, classes: DataFrame, join: Join) -> DataFrame:
    """Pairs (a, b) whose summed coordinate minima reach far enough."""
    side = lambda x: classes.select(F.col("set").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("point").alias(f"p_{x}"))
    minima = F.aggregate(F.zip_with("p_a", "p_b", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    return joined.filter(_enough(minima, F.col("n_a"), F.col("n_b"), join)).select("a", "b")


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, join: Join) -> DataFrame:
    """Pairs (a, b) of classes that link, by their sets; only texts of these classes are read again."""
    wanted = pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set"))).distinct()
    ids = wanted.join(classes, "set").select(F.col("sample").alias("_sample")).distinct()
    texts = docs.join(ids, F.col("_id").eqNullSafe(F.col("_sample")), "left_semi")
    sets = stored(
        with_found(texts, "_text", "_found", SET, _sets(join), []).select("_found.*").join(wanted, "set", "left_semi").dropDuplicates(["set"])
    )
    side = lambda x: sets.select(F.col("set").alias(x), F.col("shingles").alias(f"s_{x}"))
    overlap = F.size(F.array_intersect("s_a", "s_b"))
    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    return joined.filter(_enough(overlap, F.size("s_a"), F.size("s_b"), join)).select("a", "b")


class _Pages:
    """A column of pages as numpy arrays: members of page k are first[k] to first[k + 1]."""

    def __init__(self, column: pa.ListArray):
        self.first = column.offsets.to_numpy() - column.offsets[0].as_py()
        members = column.flatten()
        self.set, self.root, self.n = (members.field(c).to_numpy() for c in ("set", "root", "n_shingles"))
        sketches = members.field("sketch")
        wide = sketches.type == pa.large_binary()
        offsets = np.frombuffer(sketches.buffers()[1], np.int64 if wide else np.int32) if len(sketches) else np.zeros(1, np.int64)
        self.at = offsets[sketches.offset : sketches.offset + len(sketches) + 1].astype(np.int64)
        self.data = np.frombuffer(sketches.buffers()[2], np.uint8) if len(sketches) else np.zeros(0, np.uint8)

    def page(self, k: int) -> tuple[np.ndarray, ...]:
        a, b = self.first[k], self.first[k + 1]
        return self.set[a:b], self.root[a:b], self.n[a:b]

    def words(self, k: int) -> int:
        """Words in a row of the smallest sketch of page k."""
        return int(np.diff(self.at[self.first[k] : self.first[k + 1] + 1]).min()) // (8 * PLANES)

    def sketches(self, k: int, words: int) -> np.ndarray:
        """Those of page k, as of so many words in a row."""
        at = self.at[self.first[k] : self.first[k + 1] + 1]
        sizes = np.diff(at)
        out = np.zeros((len(sizes), PLANES, words), np.uint64)
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            whole = np.ascontiguousarray(self.data[at[rows][:, None] + np.arange(size)]).view(np.uint64)
            out[rows] = np.bitwise_xor.reduce(whole.reshape(len(rows), PLANES, -1, words), axis=2)
        return out


def _near(x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...], p: np.ndarray, q: np.ndarray, join: Join, alone: bool) -> tuple[np.ndarray, ...]:
    """(i, j, least distance) of the members of two pages that lie in different components and near enough."""
    found = []
    rows = max(1, (1 << 19) // max(q.size, 1))
    for a in range(0, len(p), rows):
        apart = least_distance(p[a : a + rows, None], q[None])
        total = x[2][a : a + rows, None] + y[2][None]
        near = (apart <= total * (join.den - join.num) // (join.den + join.num)) & (x[1][a : a + rows, None] != y[1][None])
        i, j = np.nonzero(np.triu(near, 1 + a) if alone else near)
        found.append((i + a, j, apart[i, j]))
    return tuple(np.concatenate(c) for c in zip(*found))


def _forest(left: np.ndarray, right: np.ndarray, apart: np.ndarray, roots: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Which of the pairs, nearest first, lead to a component that those before do not lead to."""
    up, taken = {}, []

    def top(r):
        while r in up:
            r = up[r]
        return r

    for k in np.lexsort((right, left, apart)).tolist():
        a, b = sorted((top(int(roots[0][k])), top(int(roots[1][k]))))
        if a != b:
            up[b] = a
            taken.append(k)
    return np.array(taken, np.int64)


def _page_pairs(join: Join, forest: bool):
    """Pairs of points of two pages (or of one, where y is null) that lie in different components and near enough; all,
    or a forest of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(0).to_numpy()
            found = [(np.zeros(0, np.int64),) * 3]
            pages, others = _Pages(batch.column(1)), _Pages(batch.column(2))
            alone = batch.column(2).is_null().to_numpy(zero_copy_only=False)
            for k in range(batch.num_rows):
                x, of_y = pages.page(k), pages if alone[k] else others
                y = x if alone[k] else others.page(k)
                words = min(pages.words(k), of_y.words(k))
                p = pages.sketches(k, words)
                i, j, apart = _near(x, y, p, p if alone[k] else others.sketches(k, words), join, alone[k])
                left, right = np.minimum(x[0][i], y[0][j]), np.maximum(x[0][i], y[0][j])
                if forest:
                    taken = _forest(left, right, apart, (x[1][i], y[1][j]))
                    left, right = left[taken], right[taken]
                found.append((np.full(len(left), cells[k]), left, right))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["cell", "a", "b"])
        release()

    return run


def _rest(labelled: DataFrame, classes: DataFrame, join: Join, forest: bool) -> DataFrame:
    """(cell, a, b) of pairs that share a cell and are in different components: all near ones, or a forest of them for
    each two pages."""
    of_cells = labelled.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / PAGE).alias("n_pages"), *_members_key())
    open_cells = of_cells.groupBy("n_pages", *MEMBERS_KEY).agg(F.min("cell").alias("cell")).select("cell", "n_pages")
    slim = classes.select("set", "n_shingles", "sketch")
    paged = labelled.join(open_cells, "cell").join(slim, "set").select(
        "cell", "n_pages", F.pmod(F.xxhash64("set"), "n_pages").alias("page"), F.struct("set", "root", "n_shingles", "sketch").alias("p")
    )
    pages = stored(paged.groupBy("cell", "n_pages", "page").agg(F.collect_list("p").alias("x"), F.sum(F.length("p.sketch") + 24).alias("size")))
    several = pages.filter(F.col("n_pages") > 1)
    others = several.select("cell", F.col("page").alias("other"), F.col("x").alias("y"))
    across = several.join(others, "cell").filter(F.col("page") < F.col("other")).select("cell", "x", "y")
    within = pages.select("cell", "x", F.lit(None).cast(pages.schema["x"].dataType).alias("y"))
    parts = 1 + int((pages.agg(F.sum(F.col("size") * F.col("n_pages"))).first()[0] or 0) // PAGE_BYTES)
    return within.unionByName(across).repartition(parts).mapInArrow(_page_pairs(join, forest), "cell long, a long, b long")


MEMBERS_KEY = ["first", "last", "n", "all"]


def _members_key() -> list[Column]:
    """Equal for cells of equal members."""
    return [F.min("set").alias("first"), F.max("set").alias("last"), F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("set")).alias("all")]


def _members(classes: DataFrame, part: int) -> DataFrame:
    """(cell, set) of the cells of one part that hold several sets; of cells of equal members one stays."""
    cells = classes.select(F.explode("cells").alias("cell"), "set").filter(F.pmod("cell", F.lit(PASSES)) == part)
    several = cells.groupBy("cell").agg(*_members_key()).filter("first < last").groupBy(*MEMBERS_KEY).agg(F.min("cell").alias("cell")).select("cell")
    return cells.join(several, "cell", "left_semi")


def linked(docs: DataFrame, id: str = "doc_id", text: str = "text", join: Join = Join()) -> DataFrame:
    """A row per row of docs: id, text_key (xxhash64 of the text), n_shingles and component, the smallest id reachable by
    links, its own included.

    A null or empty text has no shingles and is a component of its own, as is a row without id (component null) unless
    its text links with others. Rows with equal ids are told apart by their texts. Other columns play no part."""
    whole = F.col(f"`{text}`").cast("string")
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("_id"), whole.alias("_text"), F.xxhash64(whole).alias("_key"))
    found = stored(with_found(rows, "_text", "_found", POINT, _points(join), ["_id", "_key"]).select("_id", "_key", "_found.*"))
    with_cells = stored(found.filter(F.col("n_shingles") > 0).groupBy("set").agg(
        F.min("n_shingles").alias("n_shingles"), F.min("_id").alias("sample"), F.first("point").alias("point"), F.first("cells").alias("cells"), F.first("sketch").alias("sketch")
    ))
    points = stored(found.select("_id", "_key", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("set")).alias("set")))
    forget(found)
    members = reduce(DataFrame.unionByName, [stored(_members(with_cells, part)) for part in range(PASSES)])
    classes = stored(with_cells.drop("cells"))
    forget(with_cells)
    links, roots, labelled = None, None, members
    for number in range(ROUNDS + 2):
        before, labelled = labelled, still_open(labelled.select("cell", "set"), roots)
        if number > 1:  # the first two are the members themselves
            forget(before)
        if roots is not None and labelled.isEmpty():
            break
        if number < ROUNDS:
            near = stored(_bounded(led(labelled, number), classes, join))
        else:
            found = stored(_rest(labelled, classes, join, forest=number == ROUNDS))
            near = found.select("a", "b").distinct()
        if links is not None and near.isEmpty():
            if number >= ROUNDS:
                break
            continue
        more = stored(_verified(near, classes, rows, join))
        if links is None or not more.isEmpty():
            links = more if links is None else links.unionByName(more)
            roots = components(links)
        if number == ROUNDS:
            # Where the whole forest of a cell links, all its near pairs are in one component.
            apart = near.join(more, ["a", "b"], "left_anti")
            again = found.join(apart, ["a", "b"], "left_semi").select("cell").distinct()
            before, labelled = labelled, stored(labelled.join(again, "cell", "left_semi"))
            forget(before)
    rooted = classes.join(roots, F.col("set") == F.col("node"), "left").select("set", "sample", F.coalesce("root", "set").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("sample").alias("component"))
    of_class = rooted.join(smallest, "root").select("set", "component")
    return points.join(of_class, "set", "left").select(
        F.col("_id").alias(id), F.col("_key").alias("text_key"), "n_shingles", F.coalesce("component", "_id").alias("component")
    )


def representatives(docs: DataFrame, id: str = "doc_id", text: str = "text", join: Join = Join()) -> DataFrame:
    """The rows of docs without near duplicates, with their columns: of each component the row of its smallest id stays,
    once. Texts without shingles stay, as do rows without id that link with no id."""
    key, other_id, other_key = (free_name(docs.columns, c) for c in ("_text_key", "_other_id", "_other_key"))
    found = stored(linked(docs, id, text, join)).filter(F.col("n_shingles") > 0)
    copies = found.filter(F.col("component").isNotNull() & ~F.col("component").eqNullSafe(F.col(id)))
    again = found.filter(F.col(id).eqNullSafe(F.col("component")) & F.col(id).isNotNull()).groupBy(id, "text_key").count().filter("count > 1")
    keyed = docs.withColumn(key, F.xxhash64(F.col(f"`{text}`").cast("string")))
    named = lambda t: stored(t.select(F.col(id).alias(other_id), F.col("text_key").alias(other_key)).distinct())
    same = keyed[f"`{id}`"].cast("long").eqNullSafe(F.col(other_id)) & (F.col(key) == F.col(other_key))
    kept = keyed.join(named(copies), same, "left_anti")
    repeats = named(again)
    if not repeats.isEmpty():
        same = F.col(f"`{id}`").cast("long").eqNullSafe(F.col(other_id)) & (F.col(key) == F.col(other_key))
        kept = kept.join(repeats, same, "left_anti").unionByName(kept.join(repeats, same, "left_semi").dropDuplicates([id, key]))
    return kept.drop(key)

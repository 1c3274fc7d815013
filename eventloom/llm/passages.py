"""Substring deduplication by MinHash bands over paragraphs.

Repeated passages begin and end anywhere, so paragraphs are cut by content: of every run of `spread` places the one whose
three words hash lowest begins a paragraph of `words` words. Two texts that share a passage of spread + words - 1 words
(50) thus have a whole paragraph in common, wherever the passage stands. Where these leave words out, paragraphs between
them follow, counted from the one before, and the text's first and last words make paragraphs: no word is in none. A
paragraph is the set of its 5-word shingles.

Paragraphs that share a bucket of some band (`rows` MinHash values) with another one are joined exactly, whatever else
their buckets hold: two sets of a and b shingles are similar enough if and only if they have some subset of `needed`
shingles in common, so each set leaves the hashes of its subsets of that size, and those who meet at one are linked with
one of them without further tests. A paragraph has few shingles and may miss few of them, so its subsets are few (16 as a
rule); those for partners of fewer shingles are made only where a bucket holds such and, dealt out to groups in two ways,
its shingles agree in a group with some set of that size. What meets at a key, a bucket's, a group's or a subset's, is
shuffled once, sorted by key and goes by row after row, so a key may have any number of rows; they go by in one task.
Links make components; of a component's places all but the first are removals. `bands_for` gives
the bands a recall needs. Paragraphs of equal words are one node from the start, however many copies there are.

Words are compared as they stand, by 64-bit hashes. Edge cases: texts of fewer than `words` words have no paragraphs;
null texts none either; rows without id are not reported, and what only they hold takes no part; equal ids count as one
document. A component is reported if its paragraphs stand in two documents at least. Keys of subsets have 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.components import components
from eventloom.llm.fertility import ranges
from eventloom.llm.stored import forget, stored
from eventloom.llm.words import Hasher, Texts, keys, mix, release, slices

WIDTH = 5
#: Texts are read again, groups of shingles and subsets of shared shingles gathered in so many passes over disjoint parts of
#: them, which bounds the disk that one shuffle takes; buckets in one pass per band.
TEXT_PASSES = 2
GROUP_PASSES = 3
PAIRED = [f"paired{part}" for part in range(GROUP_PASSES)]
SINGLE = ["single0", "single1"]
SUBSET_PASSES = 2
#: Subsets of one size that a paragraph may leave, at most; a rule that asks for more is an error.
SUBSETS = 10_000
#: Subsets that a task makes at a time.
AT_ONCE = 50_000
EQUAL, SMALL, LARGE = 0, 1, 2
#: The last bits of the key of a bucket or a group hold the number of shingles, so that a key's rows come smallest first.
SIZE_BITS = 7


def bands_for(similarity: float, recall: float, rows: int) -> int:
    """Bands of so many rows that a pair of that similarity shares one with that probability."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))


@dataclass(frozen=True)
class Banding:
    words: int = 20
    spread: int = 31
    similarity: float = 0.8
    rows: int = 2
    bands: int = bands_for(0.8, 0.95, 2)

    def __post_init__(self):
        most = self.words - WIDTH + 1
        if max(comb(a, self.needed(a, b)) for a in range(1, most + 1) for b in range(1, most + 1) if self.needed(a, b) <= min(a, b)) > SUBSETS:
            raise ValueError("paragraphs of so many words at so low a similarity have too many subsets of shingles")

    def needed(self, a: int, b: int) -> int:
        """Shingles that sets of a and b shingles have in common at least if they are similar enough."""
        return ceil(self.similarity * (a + b) / (1 + self.similarity) - 1e-9)


def _sliding(pick, x: np.ndarray, width: int) -> np.ndarray:
    """pick over each run of width values, by doubling."""
    done = 1
    while 2 * done <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    return pick(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


def _lowest(values: np.ndarray, row: np.ndarray, n_rows: int, spread: int) -> np.ndarray:
    """Which values are the lowest of some run of `spread` values of their row (of the whole row if it is shorter)."""
    if not len(values):
        return np.zeros(0, bool)
    counts = np.bincount(row, minlength=n_rows)
    room = np.maximum(counts, np.where(counts > 0, spread, 0))  # short rows are filled up with the highest value
    begin = np.cumsum(room) - room
    offset = np.arange(len(values)) + np.repeat(begin - (np.cumsum(counts) - counts), counts)
    padded = np.full(int(room.sum()) + spread, np.iinfo(np.uint64).max, np.uint64)
    padded[offset] = values
    low = _sliding(np.minimum, padded, spread)
    inside = np.zeros(len(low), bool)
    inside[ranges(begin, room - np.where(counts > 0, spread - 1, 0))] = True
    low[~inside] = 0  # runs over the end of a row
    high = _sliding(np.maximum, np.concatenate([np.zeros(spread - 1, np.uint64), low]), spread)
    return high[offset] == values


def _covering(chosen: np.ndarray, row: np.ndarray, words: int) -> np.ndarray:
    """The chosen places and those that paragraphs need besides so that every word of a row is in one: its first and last
    place, and in gaps every `words` places from the one before."""
    edge = np.ones(len(row), bool)
    edge[1:] = row[1:] != row[:-1]
    chosen = chosen | edge | np.append(edge[1:], np.ones(min(len(row), 1), bool))
    place = np.arange(len(row))
    before = np.maximum.accumulate(np.where(chosen, place, 0))
    return chosen | ((place - before) % words == 0)


def _paragraphs(hashes: np.ndarray, texts: Texts, rule: Banding) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word among all, row, content hash) of each paragraph."""
    n = len(hashes) - rule.words + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    row = np.repeat(np.arange(texts.n), texts.counts)
    at = np.flatnonzero(row[:n] == row[rule.words - 1 :])
    factors = keys(3, 9) | np.uint64(1)
    three = mix(hashes[at] * factors[0] + hashes[at + 1] * factors[1] + hashes[at + 2] * factors[2])
    at = at[_covering(_lowest(three, row[at], texts.n, rule.spread), row[at], rule.words)]
    content = np.zeros(len(at), np.uint64)
    for k, factor in enumerate(keys(rule.words, 11) | np.uint64(1)):
        content += hashes[at + k] * factor
    return at, row[at], mix(content)


def _shingles(hashes: np.ndarray) -> np.ndarray:
    n = max(len(hashes) - WIDTH + 1, 0)
    out = np.zeros(n, np.uint64)
    for k, factor in enumerate(keys(WIDTH, 7) | np.uint64(1)):
        out += hashes[k : n + k] * factor
    return mix(out)


def _of_paragraphs(shingles: np.ndarray, at: np.ndarray, rule: Banding) -> np.ndarray:
    """A row of shingles per paragraph."""
    width = rule.words - WIDTH + 1
    return shingles[at[:, None] + np.arange(width)] if len(at) else np.zeros((0, width), np.uint64)


def _banded(rule: Banding):
    seeds = keys(rule.bands * rule.rows, 13)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = Texts(part.column(1))
                hashes = Hasher(texts.data)(texts.start, texts.end)
                at, row, content = _paragraphs(hashes, texts, rule)
                shingles = _shingles(hashes)
                bands = np.zeros((len(at), rule.bands), np.uint64)
                for k in range(rule.bands):
                    for r in range(rule.rows):
                        least = np.full(len(at), np.iinfo(np.uint64).max, np.uint64)
                        permuted = mix(shingles ^ seeds[k * rule.rows + r])
                        for j in range(rule.words - WIDTH + 1):
                            np.minimum(least, permuted[at + j], out=least)
                        bands[:, k] = mix(bands[:, k] * np.uint64(31) + least)
                    bands[:, k] = mix(bands[:, k] + np.uint64(k))
                offsets = pa.array(np.arange(len(at) + 1, dtype=np.int32) * rule.bands)
                each = np.sort(_of_paragraphs(shingles, at, rule), axis=1)
                size = 1 + (each[:, 1:] != each[:, :-1]).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(at - texts.first[row]), pa.array(content.view(np.int64)), pa.array(size, pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(bands.ravel().view(np.int64)))],
                    names=["id", "start", "content", "size", "bands"],
                )
        release()

    return run


def _group_keys(rule: Banding, dealt: int = 0):
    """(key, content) of each set's shingles by groups. Similar sets differ in fewer shingles than there are groups, so
    they agree in all of one group. `dealt` is another way to deal shingles to groups for each number."""
    most = rule.words - WIDTH + 1
    sizes = [(a, b) for a in range(1, most + 1) for b in range(1, most + 1) if rule.needed(a, b) <= min(a, b)]
    groups = 1 + max(a + b - 2 * rule.needed(a, b) for a, b in sizes)
    salt = keys(dealt + 1, 23)[-1] if dealt else np.uint64(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            values = mix(lists.flatten().to_numpy().view(np.uint64) ^ salt)
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            sums = np.tile(keys(groups, 17), batch.num_rows)
            np.add.at(sums, row * groups + (values % np.uint64(groups)).astype(np.int64), mix(values))
            yield pa.RecordBatch.from_arrays([pa.array(mix(sums).view(np.int64)), pa.array(np.repeat(batch.column(0).to_numpy(), groups))], names=["key", "content"])

    return run


def _pair_keys(sets: np.ndarray, once: np.ndarray, rule: Banding) -> np.ndarray:
    """A key for each two groups of each set's shingles (the marked ones of a row). Similar sets of equal sizes differ in
    two shingles less than there are groups, so they agree in all of two groups."""
    sizes = [a for a in range(1, sets.shape[1] + 1) if rule.needed(a, a) <= a]
    groups = 2 + max(2 * (a - rule.needed(a, a)) for a in sizes)
    values, seeds = mix(sets), keys(groups, 19)
    group, values = values % np.uint64(groups), np.where(once, mix(values), np.uint64(0))
    sums = [mix(np.where(group == g, values, np.uint64(0)).sum(1, dtype=np.uint64) + seeds[g]) for g in range(groups)]
    size = once.sum(1).astype(np.uint64)
    return np.stack([mix(sums[g] + sums[h] + size) for g, h in combinations(range(groups), 2)], axis=1)


def _sized(size):
    """The last bits of a key, a column or an array of numbers of shingles."""
    most = (1 << SIZE_BITS) - 1
    return np.minimum(size, most).astype(np.uint64) if isinstance(size, np.ndarray) else F.least(size, F.lit(most)).cast("long")


def _bit(size):
    """The bit of a number of shingles in a set of such numbers; all from 62 on have one."""
    return np.int64(1) << np.minimum(size, 62)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in the order of their sized keys (key, content, more columns), those whose key another content has as well:
    content, smallest, sizes, more columns. smallest is the least number of shingles at the key, sizes has the numbers
    up to the row's own, at least, as bits. A key with very many rows goes by batch after batch; kept of it are four
    numbers and, until a second content comes, one row."""
    low = high = smallest = sizes = key = held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keyed, content = (batch.column(k).to_numpy() for k in (0, 1))
        size, own = keyed & ((1 << SIZE_BITS) - 1), keyed >> SIZE_BITS
        begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        run = np.repeat(np.arange(len(begin)), np.diff(begin, append=len(own)))
        lows, highs, bits, least = np.minimum.reduceat(content, begin), np.maximum.reduceat(content, begin), np.bitwise_or.reduceat(_bit(size), begin), size[begin]
        goes_on = key is not None and own[0] == key
        if goes_on:
            lows[0], highs[0], bits[0], least[0] = min(lows[0], low), max(highs[0], high), bits[0] | sizes, smallest

        def found(rows: pa.RecordBatch, least: np.ndarray, bits: np.ndarray) -> pa.RecordBatch:
            arrays = [rows.column(1), pa.array(least, pa.int32()), pa.array(bits), *rows.columns[2:]]
            return pa.RecordBatch.from_arrays(arrays, names=["content", "smallest", "sizes", *rows.schema.names[2:]])

        several = lows < highs
        if goes_on and held is not None and several[0]:
            yield found(held, least[:1], bits[:1])
        at = np.flatnonzero(several[run])
        if len(at):
            yield found(batch.take(pa.array(at)), least[run[at]], bits[run[at]])
        if several[-1]:
            held = None
        elif not (goes_on and len(begin) == 1):
            held = batch.take(pa.array(begin[-1:]))
        low, high, smallest, sizes, key = lows[-1], highs[-1], least[-1], bits[-1], own[-1]


def _meeting(rows: DataFrame, more: str = "") -> DataFrame:
    """_met of rows with columns key (sized), content and `more`, which are shuffled once."""
    by_key = rows.repartition(F.shiftright("key", SIZE_BITS)).sortWithinPartitions("key")
    return by_key.mapInArrow(_met, "content long, smallest int, sizes long" + more)


def _worded(rule: Banding):
    """Shingles and group keys of the wanted paragraphs of each text; the keys in a list for each pass over them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = Texts(part.column(1))
                hashes = Hasher(texts.data)(texts.start, texts.end)
                at, row, content = _paragraphs(hashes, texts, rule)
                lists = part.column(0)
                asked = lists.flatten()
                wanted, least = asked.field("content").to_numpy().view(np.uint64), asked.field("smallest").to_numpy()
                of = np.repeat(np.arange(texts.n), np.diff(lists.offsets.to_numpy()))
                # Equal contents in other rows, or twice in one, are not asked for.
                names, found = mix(wanted + of.astype(np.uint64)), mix(content + row.astype(np.uint64))
                _, first, place = np.intersect1d(found, names, return_indices=True)
                _, once = np.unique(content[first], return_index=True)
                at, content, smallest = at[first[once]], content[first[once]], least[place[once]]
                each = np.sort(_of_paragraphs(_shingles(hashes), at, rule), axis=1)
                once = np.ones(each.shape, bool)
                once[:, 1:] = each[:, 1:] != each[:, :-1]
                size = once.sum(1)
                ends = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
                sets = pa.RecordBatch.from_arrays(
                    [pa.array(content.view(np.int64)), pa.array(smallest, pa.int32()), pa.ListArray.from_arrays(ends, pa.array(each[once].view(np.int64)))], names=["content", "smallest", "shingles"]
                )
                pairs = _pair_keys(each, once, rule)
                paired = [_lists(pairs[:, part::GROUP_PASSES], np.arange(len(at)), size) for part in range(GROUP_PASSES)]
                # Those that may have partners of other sizes agree with them in one group at least, however dealt.
                other = np.flatnonzero((size < each.shape[1]) | (smallest < size))
                alone = []
                for dealt in range(len(SINGLE)):
                    found = [b.column(0).to_numpy().view(np.uint64) for b in _group_keys(rule, dealt)([sets.take(pa.array(other))])] if len(other) else [np.zeros(0, np.uint64)]
                    alone.append(_lists(found[0].reshape(len(other), -1) if len(other) else pairs[:0], other, size))
                packed = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer((sets.column(2).offsets.to_numpy() * 8).astype(np.int32)), pa.py_buffer(each[once].tobytes())])
                yield pa.RecordBatch.from_arrays([*sets.columns[:2], packed, *paired, *alone], names=["content", "smallest", "shingles", *PAIRED, *SINGLE])
        release()

    return run


def _lists(values: np.ndarray, rows: np.ndarray, size: np.ndarray) -> pa.ListArray:
    """A list of sized keys per set: a row of values for the given ones, none for the others."""
    counts = np.zeros(len(size), np.int64)
    counts[rows] = values.shape[1]
    sized = values & ~np.uint64((1 << SIZE_BITS) - 1) | _sized(size[rows])[:, None]
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(sized.ravel().view(np.int64)))


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text, with the list of what is asked for of it, of rows in the order of the text's id."""
    rest = None

    def lists(rows: pa.RecordBatch, ids: np.ndarray, begin: np.ndarray) -> pa.RecordBatch:
        structs = pa.StructArray.from_arrays(rows.columns[1:], names=rows.schema.names[1:])
        ends = pa.array(np.append(begin, rows.num_rows).astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(ids[begin]), pa.ListArray.from_arrays(ends, structs)], names=["_sample", "wanted"])

    for batch in batches:
        rows = pa.concat_batches([rest, batch]) if rest is not None else batch
        if not rows.num_rows:
            continue
        ids = rows.column(0).to_numpy()
        begin = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        last = int(begin[-1])
        if last:
            yield lists(rows.slice(0, last), ids, begin[:-1])
        rest = rows.slice(last)
    if rest is not None:
        yield lists(rest, rest.column(0).to_numpy(), np.zeros(1, np.int64))


def _agreeing(sets: DataFrame) -> DataFrame:
    """(content, paired, single0, single1) of the sets that agree with another one in a key of two groups (paired), or in a
    single group in both ways to deal shingles out: then the numbers of shingles, as bits, of those it agrees with."""
    tables = []
    for lists in (*PAIRED, *SINGLE):
        met = _meeting(sets.select(F.explode(lists).alias("key"), "content")).groupBy("content").agg(F.bit_or("sizes").alias("sizes"))
        flags = [(F.col("sizes") if lists == c else F.lit(None).cast("long")).alias(c) for c in SINGLE]
        tables.append(stored(met.select("content", F.lit(lists in PAIRED).alias("paired"), *flags)))
    together = reduce(DataFrame.unionByName, tables).groupBy("content").agg(F.max("paired").alias("paired"), *[F.bit_or(c).alias(c) for c in SINGLE])
    agreeing = stored(together.filter("paired or (single0 is not null and single1 is not null)"))
    for table in tables:
        forget(table)
    return agreeing


def _partners() -> Column:
    """The numbers of shingles, as bits, that partners of an agreeing set may have: its own if it is paired; of those
    with fewer, the ones it agrees with however its shingles are dealt out; then any with more."""
    own = F.expr("shiftleft(1L, least(octet_length(shingles) div 8, 62))")
    fewer = F.col("single0").bitwiseAND(F.col("single1")).bitwiseAND(own - 1)
    alone = F.when(F.col("single0").isNotNull() & F.col("single1").isNotNull(), fewer.bitwiseOR(-own)).otherwise(F.lit(0))
    return alone.bitwiseOR(F.when(F.col("paired"), own).otherwise(F.lit(0)))


def _sets(wanted: DataFrame, docs: DataFrame, rule: Banding) -> DataFrame:
    """(content, smallest, shingles, partners) of the wanted contents that agree with others in groups of shingles; what
    does not is similar to none. Each is read again from one text."""
    # Contents that stand in rows without id only are not reported, and would be one group.
    by_text = wanted.filter("low is not null").select(F.col("low").alias("_sample"), "content", "smallest").repartition("_sample").sortWithinPartitions("_sample")
    asked = stored(by_text.mapInArrow(_listed, "_sample long, wanted array<struct<content: long, smallest: int>>"))
    parts = []
    for part in range(TEXT_PASSES):
        texts = docs.join(asked.filter(F.pmod(F.xxhash64("_sample"), F.lit(TEXT_PASSES)) == part), F.col("id") == F.col("_sample")).select("wanted", "text")
        parts.append(stored(texts.mapInArrow(_worded(rule), "content long, smallest int, shingles binary" + "".join(f", {g} array<long>" for g in (*PAIRED, *SINGLE)))))
    forget(asked)
    sets = reduce(DataFrame.unionByName, parts)
    agreeing = _agreeing(sets)
    found = []
    for part in range(GROUP_PASSES):
        mine = F.pmod("content", F.lit(GROUP_PASSES)) == part
        joined = sets.select("content", "smallest", "shingles").filter(mine).join(agreeing.filter(mine), "content")
        found.append(stored(joined.select("content", "smallest", "shingles", _partners().alias("partners")).dropDuplicates(["content"])))
    for table in (*parts, agreeing):
        forget(table)
    return reduce(DataFrame.unionByName, found)


def _subset_keys(hashes: np.ndarray, keep: int, salt: int) -> np.ndarray:
    """Keys of all subsets of `keep` of each row's hashes."""
    left_out = np.array(list(combinations(range(hashes.shape[1]), hashes.shape[1] - keep)), np.int64)
    sums = hashes.sum(1, dtype=np.uint64)[:, None] - hashes[:, left_out].sum(2, dtype=np.uint64)
    return mix(sums + keys(1, salt))


def _of_bytes(run):
    """run, for batches whose third column has lists of 64-bit numbers as bytes."""

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = batch.column(2)
            offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
            numbers = np.frombuffer(packed.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.int64) if len(packed) else np.zeros(0, np.int64)
            column = pa.ListArray.from_arrays(pa.array((offsets - offsets[0]) // 8), pa.array(numbers))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], column, *batch.columns[3:]], names=batch.schema.names)

    return lambda batches: run(lists(batches))


def _subsets(rule: Banding, part: int):
    """(key, content, side) of the subsets that a linked set must share: side is EQUAL for partners of as many shingles,
    SMALL for partners of more and LARGE for partners of fewer. A column of partners says which numbers of shingles these
    may have."""
    most = rule.words - WIDTH + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, smallest = (batch.column(k).to_numpy() for k in (0, 1))
            partners = batch.column(3).to_numpy() if batch.num_columns > 3 else np.full(batch.num_rows, -1)
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            values = mix(lists.flatten().to_numpy().view(np.uint64))
            first = np.cumsum(sizes) - sizes
            made, count = [], 0
            for a in np.unique(sizes).tolist():
                of_size = np.flatnonzero(sizes == a)
                for b in range(1, most + 1):
                    keep = rule.needed(a, b)
                    if keep > min(a, b):
                        continue
                    rows = of_size[(smallest[of_size] <= b) & (partners[of_size] & _bit(b) != 0)]
                    side = EQUAL if a == b else SMALL if a < b else LARGE
                    step = max(AT_ONCE // comb(a, keep), 1)
                    for some in (rows[at : at + step] for at in range(0, len(rows), step)):
                        found = _subset_keys(values[first[some][:, None] + np.arange(a)], keep, 1000 + min(a, b) * (most + 1) + max(a, b))
                        content = np.repeat(contents[some], found.shape[1])
                        found = found.ravel()
                        mine = np.flatnonzero(found % np.uint64(SUBSET_PASSES) == part)
                        made.append((found[mine].view(np.int64), content[mine], np.full(len(mine), side, np.int32)))
                        count += len(mine)
                        if count >= AT_ONCE:
                            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*made)], names=["key", "content", "side"])
                            made, count = [], 0
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*made)], names=["key", "content", "side"])
        release()

    return run


def _starred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of rows (key, content) in the order of the key, whose last bit LARGE rows have set: of the rows whose key
    agrees in the other bits with one that is not LARGE. Two SMALL ones are similar, too: they share as many shingles as
    sets of their own size need, at least."""
    key = centre = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keyed, content = (batch.column(k).to_numpy() for k in (0, 1))
        large, own = keyed & 1 == 1, keyed >> 1
        begin = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        least = np.minimum.reduceat(np.where(large, np.iinfo(np.int64).max, content), begin)
        has = ~large[begin]
        if key is not None and own[0] == key and centre is not None:
            least[0], has[0] = centre, True
        run = np.repeat(np.arange(len(begin)), np.diff(begin, append=len(own)))
        at = np.flatnonzero(has[run] & (least[run] != content))
        yield pa.RecordBatch.from_arrays([pa.array(least[run[at]]), pa.array(content[at])], names=["a", "b"])
        key, centre = own[-1], least[-1] if has[-1] else None


def _links(sets: DataFrame, rule: Banding, part: int) -> DataFrame:
    """Pairs (a, b) of similar contents, for the subsets of one part: those that share a subset are linked through one."""
    subsets = sets.select("content", "smallest", "shingles", "partners").mapInArrow(_of_bytes(_subsets(rule, part)), "key long, content long, side int")
    key = F.col("key").bitwiseAND(F.lit(-2)).bitwiseOR((F.col("side") == LARGE).cast("long"))
    by_key = subsets.select(key.alias("key"), "content").repartition(F.shiftright("key", 1)).sortWithinPartitions("key")
    return by_key.mapInArrow(_starred, "a long, b long").distinct()


def _shared(classes: DataFrame, band: int) -> DataFrame:
    """(content, smallest, low) of the contents that have a bucket of the band with others; smallest is the least number
    of shingles in it."""
    key = F.col(f"band{band}").bitwiseAND(F.lit(-1 << SIZE_BITS)).bitwiseOR(_sized(F.col("size")))
    return _meeting(classes.select(key.alias("key"), "content", "low"), ", low long").select("content", "smallest", "low")


def repeated(docs: DataFrame, id: str = "doc_id", text: str = "text", rule: Banding = Banding()) -> DataFrame:
    """A row per place of a repeated paragraph: id, begin and end (words of the text), component, first (whether it is
    the component's first place, by id and begin, which stays; the others are removals)."""
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    bands = [f"band{k}" for k in range(rule.bands)]
    paragraphs = rows.mapInArrow(_banded(rule), "id long, start long, content long, size int, bands array<long>")
    banded = stored(paragraphs.select("id", "start", "content", "size", *[F.col("bands")[k].alias(b) for k, b in enumerate(bands)]))
    with_bands = stored(banded.groupBy("content").agg(F.min("id").alias("low"), F.max("id").alias("high"), *[F.min(c).alias(c) for c in ("size", *bands)]))
    found = stored(banded.select("id", "start", "content"))
    forget(banded)
    shared = [stored(_shared(with_bands, band)) for band in range(rule.bands)]
    classes = stored(with_bands.select("content", "low", "high"))
    forget(with_bands)
    sets = _sets(reduce(DataFrame.unionByName, shared).groupBy("content").agg(F.min("smallest").alias("smallest"), F.min("low").alias("low")), rows, rule)
    for table in shared:
        forget(table)
    roots = components(reduce(DataFrame.unionByName, [stored(_links(sets, rule, part)) for part in range(SUBSET_PASSES)]))
    joined = classes.join(roots, F.col("content") == F.col("node"), "left").filter(F.col("node").isNotNull() | (F.col("low") < F.col("high")))
    several = stored(joined.select("content", F.coalesce("root", "content").alias("component"), "low", "high"))
    groups = several.groupBy("component").agg(F.min("low").alias("kept"), F.max("high").alias("high")).filter("kept < high").select("component", "kept")
    members = stored(several.select("content", "component").join(groups, "component"))
    places = stored(found.filter("id is not null").join(members, "content").select("id", "start", "component", "kept").distinct())
    # A component's first place is in the document of its least id; only that one's places meet by component.
    in_kept = places.filter("id = kept")
    firsts = in_kept.groupBy("component").agg(F.min("start").alias("at"))
    marked = in_kept.join(firsts, "component").withColumn("first", F.col("start") == F.col("at")).drop("at")
    marked = marked.unionByName(places.filter("id != kept").withColumn("first", F.lit(False)))
    return marked.select(F.col("id").alias(id), F.col("start").alias("begin"), (F.col("start") + rule.words).alias("end"), "component", "first")

"""Benchmark decontamination by spaced seeds.

A mask is slid over the words of an item or text; the words at its ones are hashed, those at its zeros ignored, so a
substituted word spoils only the seeds that look at it. Hashes of the items and of the texts are joined; each hit fixes
a diagonal (offset of the text against the item), along which item and text are held against each other word by word.

The texts' seeds are not shuffled: a Bloom filter of the items' seeds, of a fixed size whatever the number of items,
goes to all tasks and only what passes it is joined (exactly). Hits of one text that lie near each other form a
region, which carries its words; equal regions of many texts (copies) are joined and verified once.

Words are compared in lower case (A-Z) by 64-bit hashes. Edge cases: null and empty texts and items match nothing, as
do items with fewer words than the shortest mask; an empty table on either side gives an empty result; a repeated row
gives a row each, items without id are ignored, a row's null id stays null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.rows import free_name
from eventloom.llm.stored import stored
from eventloom.llm.words import FOLDED_KEYS, Hasher, Texts, keys, mix, slices

MASKS = ("111111", "1110111", "11011011", "110101011")


@dataclass(frozen=True)
class Seeds:
    """masks; bits of the filter (2^24: 2 MB); words of context kept around hits; what counts as an overlap: a segment
    of a diagonal with at least `min_words` equal words (of shorter items: `share` of their words) of which at most a
    quarter differ. A differing word costs as much as `penalty` equal ones when the segment is extended."""

    masks: tuple[str, ...] = MASKS
    bits: int = 24
    context: int = 32
    min_words: int = 13
    share: float = 0.8
    identity: float = 0.75
    penalty: int = 2


def _seeds(hashes: np.ndarray, first: np.ndarray, mask: str, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each place of the mask within one row, and the index of its first word."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    factors = keys(len(mask), seed=100 + number) | np.uint64(1)
    out = np.full(n, number, np.uint64)
    for k, one in enumerate(mask):
        if one == "1":
            out += hashes[k : n + k] * factors[k]
    whole = np.ones(n, bool)
    for k in range(1, len(mask)):
        at = first[1:-1] - k
        whole[at[(at >= 0) & (at < n)]] = False
    return mix(out), np.flatnonzero(whole)


def _probes(seeds: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    top, low = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
    return (seeds >> top).astype(np.int64), (seeds & low).astype(np.int64)


def _item_seeds(rule: Seeds):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = Texts(part.column(1))
                hashes = Hasher(texts.data, FOLDED_KEYS)(texts.start, texts.end)
                words = pa.ListArray.from_arrays(pa.array(texts.first.astype(np.int32)), pa.array(hashes.view(np.int64)))
                found = [[] for _ in range(texts.n)]
                for number, mask in enumerate(rule.masks):
                    seeds, at = _seeds(hashes, texts.first, mask, number)
                    row = np.searchsorted(texts.first, at, "right") - 1
                    for r, s, p in zip(row.tolist(), seeds[at].view(np.int64).tolist(), (at - texts.first[row]).tolist()):
                        found[r].append({"seed": s, "at": p})
                kind = pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())]))
                yield pa.RecordBatch.from_arrays([part.column(0), words, pa.array(found, kind)], names=["item", "words", "seeds"])

    return run


def _filter_of(seeds: DataFrame, bits: int) -> np.ndarray:
    """Bit set of both probes of every seed: at most 2^bits / 64 rows reach the driver."""
    low = F.col("seed").bitwiseAND(F.lit((1 << bits) - 1))
    top = F.shiftrightunsigned("seed", 64 - bits)
    probes = seeds.select(F.explode(F.array(low, top)).alias("p"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))
    words = probes.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(bit).alias("bit"))
    out = np.zeros(1 << (bits - 6), np.int64)
    for word, value in words.toLocalIterator():
        out[word] = value
    return np.unpackbits(out.view(np.uint8), bitorder="little")


def _regions(rule: Seeds, passed_filter) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(np.frombuffer(passed_filter.value, np.uint8), bitorder="little").view(bool)
        width = max(map(len, rule.masks))
        for batch in batches:
            for part in slices(batch, "text"):
                texts = Texts(part.column(2))
                hashes = Hasher(texts.data, FOLDED_KEYS)(texts.start, texts.end)
                hit_at, hit_seed = [], []
                for number, mask in enumerate(rule.masks):
                    seeds, at = _seeds(hashes, texts.first, mask, number)
                    a, b = _probes(seeds, rule.bits)
                    at = at[flags[a[at]] & flags[b[at]]] if len(at) else at
                    hit_at.append(at)
                    hit_seed.append(seeds[at])
                at, seed = np.concatenate(hit_at), np.concatenate(hit_seed)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, seed = at[order], seed[order]
                row = np.searchsorted(texts.first, at, "right") - 1
                new = np.ones(len(at), bool)
                new[1:] = (row[1:] != row[:-1]) | (at[1:] - at[:-1] > rule.context)
                begin = np.flatnonzero(new)
                end = np.append(begin[1:], len(at))
                rows, start, key, words, hits = [], [], [], [], []
                for i, j in zip(begin, end):
                    r = row[i]
                    low = max(texts.first[r], at[i] - rule.context)
                    high = min(texts.first[r + 1], at[j - 1] + width + rule.context)
                    content = hashes[low:high]
                    rows.append(r)
                    start.append(low - texts.first[r])
                    # The place of the first hit tells regions of equal words but other hits apart.
                    key.append(int(mix((content * keys(len(content), 5)).sum(keepdims=True, dtype=np.uint64) + np.uint64(at[i] - low)).view(np.int64)[0]))
                    words.append(content.view(np.int64).tolist())
                    hits.append([{"seed": s, "at": p} for s, p in zip(seed[i:j].view(np.int64).tolist(), (at[i:j] - low).tolist())])
                take = pa.array(rows)
                kind = pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(start, pa.int64()), pa.array(key, pa.int64()), pa.array(words, pa.list_(pa.int64())), pa.array(hits, kind)],
                    names=["id", "text_key", "start", "region", "words", "hits"],
                )

    return run


def best_segment(same: np.ndarray, penalty: int) -> tuple[int, int]:
    """Begin and end of the run with the highest sum of 1 per equal and -penalty per other place (the first of ties)."""
    sums = np.concatenate([[0], np.cumsum(np.where(same, 1, -penalty))])
    low = np.minimum.accumulate(sums)
    end = int(np.argmax(sums[1:] - low[:-1])) + 1
    return int(np.argmin(sums[:end])), end


def _verify(rule: Seeds):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            regions, items, begin, end, matched, n_items = [], [], [], [], [], []
            words, item_words = batch.column(2), batch.column(4)
            shifts = batch.column(3).to_pylist()
            for k in range(batch.num_rows):
                text, item, shift = words[k].values.to_numpy(), item_words[k].values.to_numpy(), shifts[k]
                a, b = max(0, shift), min(len(text), shift + len(item))
                if b <= a:
                    continue
                same = text[a:b] == item[a - shift : b - shift]
                x, y = best_segment(same, rule.penalty)
                equal = int(same[x:y].sum())
                need = min(rule.min_words, int(np.ceil(rule.share * len(item))))
                if equal >= need and equal >= rule.identity * (y - x):
                    regions.append(k)
                    begin.append(a + x)
                    end.append(a + y)
                    matched.append(equal)
                    n_items.append(len(item))
            take = pa.array(regions, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), *[pa.array(v, pa.int64()) for v in (begin, end, matched, n_items)]],
                names=["region", "item", "begin", "end", "n_equal", "n_item"],
            )

    return run


def overlaps(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", rule: Seeds = Seeds()) -> DataFrame:
    """A row per text, item and overlap: id, text_key (xxhash64 of the text), item_id, begin and end (words of the text),
    n_equal (equal words in between) and n_item (words of the item). Of overlaps of one pair that share words, each
    diagonal gives one."""
    spark = docs.sparkSession
    one_item = items.select(F.col(f"`{item_id}`").cast("long").alias("item"), F.col(f"`{item_text}`").cast("string").alias("text"))
    pairs = "array<struct<seed:long,at:int>>"
    bench = stored(one_item.mapInArrow(_item_seeds(rule), f"item long, words array<long>, seeds {pairs}"))
    item_seeds = bench.select("item", F.explode("seeds").alias("s")).select("item", "s.seed", F.col("s.at").alias("item_at")).distinct()
    bit_set = np.packbits(_filter_of(item_seeds, rule.bits), bitorder="little").tobytes()
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text}`").cast("string")).alias("text_key"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = f"id long, text_key long, start long, region long, words array<long>, hits {pairs}"
    found = stored(rows.mapInArrow(_regions(rule, spark.sparkContext.broadcast(bit_set)), schema))
    distinct = stored(found.groupBy("region").agg(F.first("words").alias("words"), F.first("hits").alias("hits")))
    hits = distinct.select("region", F.explode("hits").alias("h")).select("region", "h.seed", "h.at")
    diagonals = hits.join(item_seeds, "seed").select("region", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    texts_of_items = bench.select("item", F.col("words").alias("item_words")).distinct()
    sides = diagonals.join(distinct.select("region", "words"), "region").join(texts_of_items, "item")
    verified = sides.select("region", "item", "words", "shift", "item_words").mapInArrow(
        _verify(rule), "region long, item long, begin long, end long, n_equal long, n_item long"
    ).distinct()
    return found.select("id", "text_key", "start", "region").join(verified, "region").select(
        F.col("id").alias(id), "text_key", F.col("item").alias(item_id), (F.col("start") + F.col("begin")).alias("begin"),
        (F.col("start") + F.col("end")).alias("end"), "n_equal", "n_item",
    )


def clean(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of docs without an overlap, with their columns."""
    key, leak_id, leak_key = (free_name(docs.columns, c) for c in ("_text_key", "_leak_id", "_leak_key"))
    leaks = overlaps(docs, items, id, text, **options).select(F.col(id).alias(leak_id), F.col("text_key").alias(leak_key)).distinct()
    keyed = docs.withColumn(key, F.xxhash64(F.col(f"`{text}`").cast("string")))
    same = F.col(f"`{id}`").cast("long").eqNullSafe(F.col(leak_id)) & (F.col(key) == F.col(leak_key))
    return keyed.join(leaks, same, "left_anti").drop(key)

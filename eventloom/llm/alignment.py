"""Alignment of two tokenisers by divide and conquer at shared cuts.

Every text is encoded by a byte-level BPE (A) and by a piece vocabulary with byte fallback (B). Byte offsets where tokens
of both end are shared cuts. An interval of A's tokens is divided at a shared cut near its middle, which is looked for
outwards from there, and both halves are divided in turn; an interval without a shared cut is a
group. Each of A's ends is looked up once by bisection in B's ends, in order. All intervals of a batch are divided
together; what an interval has tried in vain is kept for its parts, so each end is tried about once. A and B tokens whose byte ranges overlap are linked; for each pair of ids the documents that
hold it linked are counted over the corpus.

Neither tokeniser has a token across a single blank before a word, so the tokens of such chunks (a blank and what follows
up to the next one) are remembered and each distinct chunk is encoded about once.

How the counts come back: a task closes a book about every BOOK_BYTES of text, with its distinct pairs and in how many
of its documents each is. Books are counted together, each book's pairs get their counts, and book and documents meet
again by book. So a pair that is in every document is one row per book, and no group is larger than a book (a longer
text is a book of its own).

Edge cases: a text that is null or empty, or whose tokens do not spell a space and the text byte by byte (B normalises
some characters), has no tokens: zeros, an empty digest. Repeated rows count as documents each. Other columns pass
through; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eventloom.llm.fertility import TOKENIZERS, ranges
from eventloom.llm.rows import free_name
from eventloom.llm.stored import stored
from eventloom.llm.words import Hasher, release, slices

#: Text of a book. Its links take about 30 bytes each while it is closed.
BOOK_BYTES = 6 << 20
#: A pair of ids is one integer: A's id times PAIR plus B's id.
PAIR = 1 << 20
#: Chunks whose tokens a task remembers; beyond that, or eight tokens each, it starts anew (no effect on results).
REMEMBERED = 400_000
#: First bytes of characters that are no white space to anyone (those that share a first byte with some white space are
#: left out: then a chunk is only longer).
BEGINS_WORD = np.zeros(256, bool)
BEGINS_WORD[[*range(0x21, 0x7F), *range(0xC3, 0xE1), *range(0xE4, 0xEF), *range(0xF0, 0xF5)]] = True
FIRST_BYTES = frozenset(np.flatnonzero(BEGINS_WORD).tolist())
WORD_BYTES = bytes([*np.flatnonzero(BEGINS_WORD).tolist(), *range(0x80, 0xC0)])

COUNTS = ("n_a", "n_b", "n_groups", "n_links")
FOUND = T.StructType(
    [T.StructField(c, T.LongType()) for c in (*COUNTS, "n_best", "count_sum")] + [T.StructField(c, T.StringType()) for c in ("groups_sha256", "groups")]
)


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Coders:
    """Both tokenisers, the bytes of their tokens, and the texts of their ids as digests need them."""

    def __init__(self, folder: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(f"{folder}/byte_bpe_50k.json")
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/piece_bpe_32k.model")
        names = {i: s for s, i in self.a.get_vocab().items()}
        of = byte_of_char()
        self.bytes_a = [bytes(of.get(c, 0x3F) for c in names.get(i, "")) for i in range(max(names) + 1)]
        n = self.b.vocab_size()
        piece = self.b.id_to_piece
        self.bytes_b = [
            bytes([int(piece(i)[3:-1], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else piece(i).replace("▁", " ").encode()
            for i in range(n)
        ]
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.n_a, self.n_b = len(self.bytes_a), n
        marks = [(self.n_a, b","), (self.n_a, b"|"), (n, b","), (n, b";")]
        self.written = [b"%d%s" % (i, mark) for size, mark in marks for i in range(size)]

        self._forget()

    def _forget(self) -> None:
        self.at: dict[int, int] = {}
        self.spelt = np.zeros(0, bool)
        self.ids = [np.zeros(0, np.int64) for _ in "ab"]
        self.starts = [np.zeros(1, np.int64) for _ in "ab"]

    def _together(self, chunks: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids of both and how many each chunk has, with all chunks encoded as one text; None if they do not come apart."""
        whole = b"".join(chunks)
        text, stops = whole.decode(), np.cumsum(np.fromiter(map(len, chunks), np.int64, len(chunks)))
        out = []
        for ids, table, length in ((self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.bytes_a, self.length_a), (self.b.encode(text[1:]), self.bytes_b, self.length_b)):
            if b"".join(map(table.__getitem__, ids)) != whole:
                return None
            ids = np.array(ids, np.int64)
            ends = np.cumsum(length[ids])
            last = np.searchsorted(ends, stops)
            if (ends[last] != stops).any():
                return None
            out.append((ids, np.diff(last + 1, prepend=0)))
        return out

    def _singly(self, chunks: list[bytes]) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[bool]]:
        texts = [c.decode() for c in chunks]
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = [self.b.encode(t[1:]) for t in texts]  # B adds a blank of its own
        of_a, of_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        spelt = [b"".join(map(of_a, x)) == c == b"".join(map(of_b, y)) for c, x, y in zip(chunks, a, b)]
        return [(np.array([i for x in ids for i in x], np.int64), np.array([len(x) for x in ids], np.int64)) for ids in (a, b)], spelt

    def _remember(self, hashes: list[int], chunks: list[bytes]) -> None:
        """Tokens of both for chunks, each of which begins with a blank. Those that are a word and nothing else are
        encoded together, as nothing in them touches the next blank; so are those with line ends, but apart, as one that
        is not spelt has all of its kind encoded singly."""
        left = [c.translate(None, WORD_BYTES) for c in chunks]
        begins = [len(c) > 1 and c[1] in FIRST_BYTES for c in chunks]
        plain = [k for k, x in enumerate(left) if x == b" " and begins[k]]
        lines = [k for k, x in enumerate(left) if len(x) > 1 and begins[k] and not x[1:].strip(b"\n") and chunks[k][-1] != 0x20]
        rest, parts = set(range(len(chunks))), []
        for some in (plain, lines):
            found = self._together([chunks[k] for k in some]) if some else None
            if found:
                parts.append(([hashes[k] for k in some], found, [True] * len(some)))
                rest.difference_update(some)
        if rest:
            rest = sorted(rest)
            parts.append(([hashes[k] for k in rest], *self._singly([chunks[k] for k in rest])))
        for keys, both, spelt in parts:
            self.at.update(zip(keys, range(len(self.at), len(self.at) + len(keys))))
            self.spelt = np.concatenate([self.spelt, spelt])
            for k, (ids, sizes) in enumerate(both):
                self.ids[k] = np.concatenate([self.ids[k], ids])
                self.starts[k] = np.concatenate([self.starts[k], self.starts[k][-1] + np.cumsum(sizes)])

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and for B: the ids of all texts, and how many each has; none for a text that either does not spell."""
        data = "".join(" " + t if t else "" for t in texts).encode()
        sizes = np.array([len(t.encode()) + 1 if t else 0 for t in texts], np.int64)
        stops = np.cumsum(sizes)
        flat = np.frombuffer(data, np.uint8)
        first = np.zeros(len(flat) + 1, bool)
        first[(stops - sizes)[sizes > 0]] = True
        cut = first[:-1].copy()
        cut[1:-1] |= (flat[1:-1] == 0x20) & (flat[:-2] != 0x20) & BEGINS_WORD[flat[2:]] & ~first[2:-1]
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(flat)).astype(np.int64)
        if len(self.at) > REMEMBERED or len(self.ids[0]) > 8 * REMEMBERED:
            self._forget()
        hashes, sample, inverse = np.unique(Hasher(flat)(start, end), return_index=True, return_inverse=True)
        hashes = hashes.tolist()
        new = [k for k, h in enumerate(hashes) if h not in self.at]
        if new:
            self._remember([hashes[k] for k in new], [data[start[k] : end[k]] for k in sample[new].tolist()])
        chunk = np.fromiter(map(self.at.__getitem__, hashes), np.int64, len(hashes))[inverse]
        text = np.searchsorted(stops, start, "right")
        bad = np.bincount(text, ~self.spelt[chunk], len(texts)) > 0
        chunk, text = chunk[~bad[text]], text[~bad[text]]
        out = []
        for ids, starts in zip(self.ids, self.starts):
            counts = starts[chunk + 1] - starts[chunk]
            out.append((ids[ranges(starts[chunk], counts)], np.bincount(text, counts, len(texts)).astype(np.int64)))
        return out


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Sorted indices of A's tokens that end groups, in the intervals of tokens first[k] to last[k] (exclusive), whose
    own ends are shared. Both arrays of ends increase."""
    found = [last - 1]
    is_shared = ends_b[np.minimum(np.searchsorted(ends_b, ends_a), len(ends_b) - 1)] == ends_a
    low, high = first, last - 1  # candidates: low to high, exclusive
    zone_low = zone_high = (low + high) // 2  # what lies between has been tried and holds no cut
    width = np.ones(len(low), np.int64)
    while True:
        open_ = (low < zone_low) | (zone_high < high)
        low, high, zone_low, zone_high, width = (x[open_] for x in (low, high, zone_low, zone_high, width))
        n = len(low)
        if not n:
            return np.sort(np.concatenate(found))
        down, up = np.maximum(zone_low - width, low), np.minimum(zone_high + width, high)

        def shared(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            counts = stop - start
            at = ranges(start, counts)
            hit = is_shared[at]
            return np.repeat(np.arange(n), counts)[hit], at[hit]

        left, right = np.full(n, -1), np.full(n, np.iinfo(np.int64).max)
        of, at = shared(down, zone_low)
        left[of] = at  # at rises within an interval, so the last assignment is the nearest
        of, at = shared(zone_high, up)
        right[of[::-1]] = at[::-1]
        middle = (low + high) // 2
        has_left, has_right = left >= low, right < high
        take_left = has_left & (~has_right | (middle - left < right - middle))
        take_right = has_right & ~take_left
        zone_low, zone_high = np.where(has_left, left + 1, down), np.where(has_right, right, up)
        none = ~take_left & ~take_right
        cut = np.where(take_left, left, right)
        found.append(cut[~none])
        l, r = take_left, take_right
        centre = lambda a, b: (a + b) // 2
        parts = (
            (low[none], high[none], zone_low[none], zone_high[none], 2 * width[none]),
            # A cut on the left: what is left of it is new, what is right of it knows the zone.
            (low[l], cut[l], centre(low[l], cut[l]), centre(low[l], cut[l]), np.ones(l.sum(), np.int64)),
            (cut[l] + 1, high[l], cut[l] + 1, zone_high[l], width[l]),
            (low[r], cut[r], zone_low[r], cut[r], width[r]),
            (cut[r] + 1, high[r], centre(cut[r] + 1, high[r]), centre(cut[r] + 1, high[r]), np.ones(r.sum(), np.int64)),
        )
        low, high, zone_low, zone_high, width = (np.concatenate(x) for x in zip(*parts))


@dataclass
class Aligned:
    """Some texts: token and group counts, digests, and the pairs linked in each, in order of place."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    written: list[bytes]
    pairs: np.ndarray


def align(coders: Coders, texts: list[str]) -> Aligned:
    (a, n_a), (b, n_b) = coders.encode(texts)
    ends_a, ends_b = np.cumsum(coders.length_a[a]), np.cumsum(coders.length_b[b])
    stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
    full = np.flatnonzero(n_a)
    cut_a = shared_cuts(ends_a, ends_b, (stop_a - n_a)[full], stop_a[full]) if len(full) else np.zeros(0, np.int64)
    cut_b = np.searchsorted(ends_b, ends_a[cut_a])
    # Tokens in the order they are written: A's of a group, then B's.
    last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    last_a[cut_a], last_b[cut_b] = True, True
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + np.concatenate([[0], cut_b + 1])[group_a]] = a + coders.n_a * last_a
    order[np.arange(len(b)) + (cut_a + 1)[group_b]] = 2 * coders.n_a + b + coders.n_b * last_b
    words, bounds = coders.written.__getitem__, np.concatenate([[0], stop_a + stop_b]).tolist()
    order = order.tolist()
    written = [b"".join(map(words, order[i:j]))[:-1] for i, j in zip(bounds, bounds[1:])]
    # Links: between two ends that follow each other, of whichever side, one A and one B token overlap.
    sides = np.zeros((2, int(ends_a[-1]) + 1 if len(a) else 1), bool)
    sides[0, ends_a] = sides[1, ends_b] = True
    ends = np.flatnonzero(sides[0] | sides[1])
    # A token is the one whose end comes next: so many ends of its side lie before.
    at_a, at_b = (np.cumsum(x) - x for x in sides[:, ends])
    pairs = a[at_a] * PAIR + b[at_b] if len(a) else np.zeros(0, np.int64)
    text_ends = np.concatenate([[0], ends_a])[stop_a]
    n_links = np.diff(np.concatenate([[0], np.searchsorted(ends, text_ends, "right")]))
    n_groups = np.diff(np.concatenate([[0], np.searchsorted(cut_a, stop_a)]))
    return Aligned(n_a, n_b, n_groups, n_links, written, pairs)


def _packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers with their bytes by place, so that the high ones compress."""
    return numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel().astype(np.int64)


@dataclass
class _Book:
    """The documents read since the last book was closed."""

    key: int
    size: int = 0
    rows: list = field(default_factory=list)
    n_links: list = field(default_factory=list)
    pairs: list = field(default_factory=list)

    def closed(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Its documents, with their pairs as places in the book and how often each is linked; then its pairs, with
        the number of documents each is in."""
        import pandas as pd
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        n_links = np.concatenate(self.n_links)
        place, codes = pd.factorize(np.concatenate(self.pairs))
        of = np.repeat(np.arange(len(n_links)), n_links)
        both, times = np.unique(of * max(len(codes), 1) + place, return_counts=True)
        of, place = np.divmod(both, max(len(codes), 1))
        bounds = np.searchsorted(of, np.arange(len(n_links) + 1)).tolist()
        at = 0
        for batch in self.rows:
            links = []
            for i, j in zip(bounds[at : at + batch.num_rows], bounds[at + 1 :]):
                links.append(pack(_packed(np.concatenate([np.diff(place[i:j], prepend=0), times[i:j]]))))
            at += batch.num_rows
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.key] * n, pa.int64()), *batch.columns, pa.array(links, schema.field("links").type), *[pa.nulls(n, f.type) for f in list(schema)[-2:]]],
                schema=schema,
            )
        if len(codes):
            empty = [pa.nulls(1, f.type) for f in list(schema)[1:-2]]
            n_docs = np.bincount(place, minlength=len(codes))
            lists = [pa.array([x], schema.field(k).type) for k, x in (("codes", codes), ("n_docs", n_docs))]
            yield pa.RecordBatch.from_arrays([pa.array([self.key], pa.int64()), *empty, *lists], schema=schema)


def _booked(docs: DataFrame, text: str, keep: list[str], folder: str, groups: bool) -> DataFrame:
    source = docs.select(
        F.struct(*([docs[f"`{c}`"] for c in keep] or [F.lit(0).alias("none")])).alias("row"),
        docs[f"`{text}`"].cast("string").alias("text"),
        F.monotonically_increasing_id().alias("key"),
    )
    kinds = {"sha": T.BinaryType(), "groups": T.StringType(), "links": T.BinaryType(), "codes": T.ArrayType(T.LongType()), "n_docs": T.ArrayType(T.LongType())}
    kinds = {"book": T.LongType(), "row": source.schema["row"].dataType, **{c: T.LongType() for c in COUNTS}, **kinds}
    schema = T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders, book = Coders(folder), None
        inner = pa.schema(list(arrow)[1:-3])
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column(1).fill_null("")
                found = align(coders, texts.to_pylist())
                digests = [hashlib.sha256(w).digest() if w else None for w in found.written]
                written = [w.decode() for w in found.written] if groups else [None] * part.num_rows
                arrays = [found.n_a, found.n_b, found.n_groups, found.n_links, digests, written]
                rows = pa.RecordBatch.from_arrays(
                    [part.column(0).cast(inner.field("row").type), *[pa.array(x, f.type) for x, f in zip(arrays, list(inner)[1:])]], schema=inner
                )
                if book is None:
                    book = _Book(part.column(2)[0].as_py())
                book.rows.append(rows)
                book.n_links.append(found.n_links)
                book.pairs.append(found.pairs)
                book.size += texts.nbytes
                if book.size >= BOOK_BYTES:
                    yield from book.closed(arrow)
                    book = None
        if book is not None:
            yield from book.closed(arrow)
        del coders
        release()

    return source.mapInArrow(run, schema)


def _entries(found: DataFrame) -> DataFrame:
    listed = found.filter(F.col("codes").isNotNull()).select("book", F.posexplode(F.arrays_zip("codes", "n_docs")).alias("place", "e"))
    return listed.select("book", "place", F.col("e.codes").alias("code"), F.col("e.n_docs").alias("n_docs"))


def _counts(entries: DataFrame) -> DataFrame:
    return entries.groupBy("code").agg(F.sum("n_docs").alias("count"))


def pair_counts(docs: DataFrame, text: str = "text", folder: str = TOKENIZERS) -> DataFrame:
    """(a_id, b_id, n_docs): in how many documents each pair of ids is linked."""
    counts = _counts(_entries(_booked(docs, text, [], folder, False)))
    return counts.select(F.expr(f"code div {PAIR}").cast("int").alias("a_id"), (F.col("code") % PAIR).cast("int").alias("b_id"), F.col("count").alias("n_docs"))


def aligned(docs: DataFrame, text: str = "text", keep: list[str] | None = None, folder: str = TOKENIZERS, groups: bool = False) -> tuple[DataFrame, str]:
    """The rows of docs (columns `keep`, all by default) with a struct of FOUND: token, group and link counts, links
    whose pair is the most frequent of its A id, the sum of pair counts over links, the digest of the groups and, if
    asked for, the groups as text (`a1,a2|b1;a3|b2,b3`). Returns the DataFrame and the struct's name."""
    keep = docs.columns if keep is None else keep
    name = free_name(keep, "alignment")
    found = stored(_booked(docs, text, keep, folder, groups))
    entries = _entries(found)
    a_id = F.expr(f"code div {PAIR}").alias("a_id")
    counts = stored(_counts(entries))
    # At most one row per id of A's vocabulary.
    tops = counts.groupBy(a_id).agg(F.max("count").alias("top"))
    scored = counts.withColumn("a_id", a_id).join(F.broadcast(tops), "a_id").select("code", "count", (F.col("count") == F.col("top")).alias("best"))
    scored = entries.join(scored, "code").select(F.col("book").alias("of"), "place", "count", "best")
    documents = found.filter(F.col("codes").isNull()).select("book", "row", *COUNTS, "sha", "groups", "links")
    row = documents.schema["row"]
    schema = T.StructType([row, T.StructField("found", FOUND, False)])
    arrow = to_arrow_schema(schema)

    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        """A book's documents with the counts of its pairs."""
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        count, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        place = right.column("place").to_numpy()
        count[place], best[place] = right.column("count").to_numpy(), right.column("best").to_numpy()
        n_best, sums = [], []
        for blob in left.column("links").to_pylist():
            numbers = _unpacked(unpack(blob))
            half = len(numbers) // 2
            at, times = np.cumsum(numbers[:half]), numbers[half:]
            n_best.append(int((times * best[at]).sum()))
            sums.append(int((times * count[at]).sum()))
        digests = [d.hex() if d else "" for d in left.column("sha").to_pylist()]
        counts = [left.column(c).combine_chunks() for c in COUNTS]
        struct = pa.StructArray.from_arrays(
            [*counts, pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()), pa.array(digests, arrow.field("found").type.field("groups_sha256").type), left.column("groups").combine_chunks().cast(arrow.field("found").type.field("groups").type)],
            fields=list(arrow.field("found").type),
        )
        return pa.Table.from_arrays([left.column("row").combine_chunks().cast(arrow.field("row").type), struct], schema=arrow)

    joined = documents.groupBy("book").cogroup(scored.groupBy("of")).applyInArrow(settle, schema)
    return joined.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], F.col("found").alias(name)), name

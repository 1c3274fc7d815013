"""Edit-aware token counts: segment trees of pre-token counts, updated where edits touch a text.

A byte-level BPE never joins bytes of two pre-tokens, so a text's token count is the sum over its pre-tokens. Per text a
segment tree over blocks of pre-tokens is kept: each leaf has its characters and tokens, each inner node the sum below.
An edit replaces the characters [start, end). Only pre-tokens near it are split and encoded again: from the last boundary
that the edit cannot reach (a pre-token looks at most CONTEXT characters past its end, or to the end of white space) to the first
old boundary behind it at which a new pre-token begins; from there on the pattern, which looks only ahead, splits as
before. The leaves in between are replaced and the sums above them updated.

Pre-tokens follow the public pattern of the vocabulary. Edge cases: a null text has no tree and no edits; an empty text
has an empty tree; edits are applied in order of start, from the right, each to the text as given; of overlapping edits
the one that begins first (then the longer) holds and the others are dropped and counted; bounds past the text's end are
cut to it; rows with equal ids are separate texts.
"""

from __future__ import annotations

import base64
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from eventloom.llm.fertility import TOKENIZERS
from eventloom.llm.pii import KINDS, base_spans
from eventloom.llm.rows import free_name, with_found

# Fixed value: the pre-token pattern that byte_bpe_50k is defined with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CONTEXT = 4
#: Pre-tokens of a block, about: a block is split beyond twice that.
BLOCK = 64
#: Distinct pre-tokens whose counts a task remembers.
REMEMBERED = 400_000

_SPLIT = regex.compile(PATTERN)


class Counts(dict):
    """Token count by pre-token, encoded at first sight."""

    def __init__(self, folder: str):
        import tiktoken

        with open(f"{folder}/byte_bpe_50k.tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding("pre-tokens", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, piece: str) -> int:
        n = len(self.bpe.encode_ordinary(piece))
        if len(self) < REMEMBERED:
            self[piece] = n
        return n


@dataclass
class Tree:
    """Segment tree over blocks: sizes (characters of each pre-token) and counts (its tokens) by block; chars and tokens
    are heap-ordered sums, node i over nodes 2i and 2i + 1, blocks at `width` and on."""

    sizes: list[list[int]]
    counts: list[list[int]]
    width: int = 1
    chars: np.ndarray = field(default_factory=lambda: np.zeros(2, np.int64))
    tokens: np.ndarray = field(default_factory=lambda: np.zeros(2, np.int64))

    @staticmethod
    def of(pieces: list[str], counter: Counts) -> Tree:
        sizes, counts = list(map(len, pieces)), [counter[p] for p in pieces]
        tree = Tree([sizes[k : k + BLOCK] for k in range(0, len(sizes), BLOCK)], [counts[k : k + BLOCK] for k in range(0, len(counts), BLOCK)])
        tree._sum()
        return tree

    def _sum(self) -> None:
        """All sums anew, for a new number of blocks."""
        n = len(self.sizes)
        self.width = 1 << max(0, (n - 1).bit_length())
        self.chars, self.tokens = np.zeros(2 * self.width, np.int64), np.zeros(2 * self.width, np.int64)
        self.chars[self.width : self.width + n] = [sum(s) for s in self.sizes]
        self.tokens[self.width : self.width + n] = [sum(c) for c in self.counts]
        for sums in (self.chars, self.tokens):
            level = self.width
            while level > 1:
                sums[level // 2 : level] = sums[level : 2 * level].reshape(-1, 2).sum(1)
                level //= 2

    def _update(self, block: int) -> None:
        """The sums above one block."""
        node = self.width + block
        self.chars[node], self.tokens[node] = sum(self.sizes[block]), sum(self.counts[block])
        while node > 1:
            node //= 2
            self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def locate(self, at: int) -> tuple[int, int]:
        """(block, character it begins at) of the block that holds character `at` (the last block beyond the end)."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if at >= begin + self.chars[node] and begin + self.chars[node] < self.chars[1]:
                begin += int(self.chars[node])
                node += 1
        return node - self.width, begin

    def replace(self, low: int, high: int, new: list[tuple[int, int]]) -> None:
        """Puts (size, count) pairs in the place of the pre-tokens that cover characters [low, high), both boundaries."""
        if not self.sizes:
            self.sizes, self.counts = [[]], [[]]
            self._sum()
        first, begin = self.locate(low)
        last, last_begin = self.locate(max(low, high - 1))
        head, k = begin, 0
        while k < len(self.sizes[first]) and head < low:
            head += self.sizes[first][k]
            k += 1
        tail, j = last_begin, 0
        while j < len(self.sizes[last]) and tail < high:
            tail += self.sizes[last][j]
            j += 1
        sizes = self.sizes[first][:k] + [s for s, _ in new] + self.sizes[last][j:]
        counts = self.counts[first][:k] + [c for _, c in new] + self.counts[last][j:]
        if first == last and 0 < len(sizes) <= 2 * BLOCK:
            self.sizes[first], self.counts[first] = sizes, counts
            self._update(first)
            return
        self.sizes[first : last + 1] = [sizes[a : a + BLOCK] for a in range(0, len(sizes), BLOCK)]
        self.counts[first : last + 1] = [counts[a : a + BLOCK] for a in range(0, len(counts), BLOCK)]
        self._sum()

    def boundary_before(self, at: int) -> int:
        """The last boundary of a pre-token at or before character `at`."""
        if not self.sizes:
            return 0
        block, begin = self.locate(at)
        for size in self.sizes[block]:
            if begin + size > at:
                break
            begin += size
        return begin

    def boundaries_from(self, at: int):
        """Boundaries from character `at` on."""
        if not self.sizes:
            yield 0
            return
        block, begin = self.locate(at)
        for k in range(block, len(self.sizes)):
            for size in self.sizes[k]:
                if begin >= at:
                    yield begin
                begin += size
        yield begin


def apply_edit(text: str, tree: Tree, start: int, end: int, replacement: str, counter: Counts) -> tuple[str, int]:
    """The edited text and how many pre-tokens were encoded again; the tree follows."""
    reach = start - CONTEXT
    while reach > 0 and text[reach - 1 : reach].isspace():
        reach -= 1
    low = tree.boundary_before(max(0, reach))
    if low and low == reach:
        low = tree.boundary_before(low - 1)
    edited = text[:start] + replacement + text[end:]
    shift = len(replacement) - (end - start)
    old = tree.boundaries_from(end)
    stop = next(old, None)
    at, new, high = low, [], len(text)
    while at < len(edited):
        while stop is not None and stop + shift < at:
            stop = next(old, None)
        if stop is not None and stop + shift == at and at >= start + len(replacement):
            high = stop
            break
        piece = _SPLIT.match(edited, at)
        new.append((piece.end() - at, counter[piece[0]]))
        at = piece.end()
    tree.replace(low, high, new)
    return edited, len(new)


Edit = tuple[int, int, str]


def disjoint(edits: list[Edit], size: int) -> list[Edit]:
    """Edits in order, within the text, without those that overlap an earlier one."""
    out: list[Edit] = []
    for a, b, new in sorted(edits, key=lambda e: (e[0], -e[1], e[2])):
        a, b = min(max(a, 0), size), min(max(b, a, 0), size)
        if not out or a >= out[-1][1]:
            out.append((a, b, new))
    return out


FOUND = T.StructType([
    *[T.StructField(c, T.LongType()) for c in ("n_pretokens", "n_tokens", "n_edits", "n_dropped", "n_reencoded", "n_tokens_after", "n_chars_after")],
    T.StructField("tree", T.ArrayType(T.LongType())),
])


def _finder(edits_of: Callable[[str], list[Edit]], folder: str):
    def start():
        counter = Counts(folder)

        def find(column: pa.Array) -> list[pa.Array]:
            rows = []
            for text in column.to_pylist():
                if text is None:
                    rows.append((0, 0, 0, 0, 0, 0, 0, None))
                    continue
                tree = Tree.of(_SPLIT.findall(text), counter)
                n_pieces, before = sum(map(len, tree.sizes)), tree.total
                asked = edits_of(text)
                edits = disjoint(asked, len(text))
                again = 0
                for a, b, new in reversed(edits):
                    text, n = apply_edit(text, tree, a, b, new, counter)
                    again += n
                blocks = len(tree.sizes)
                rows.append((n_pieces, before, len(edits), len(asked) - len(edits), again, tree.total, len(text), tree.tokens[tree.width : tree.width + blocks].tolist()))
            columns = list(zip(*rows)) if rows else [()] * 8
            return [*[pa.array(c, pa.int64()) for c in columns[:7]], pa.array(columns[7], pa.list_(pa.int64()))]

        return find

    return start


def recounted(docs: DataFrame, edits_of: Callable[[str], list[Edit]], text: str = "text", keep: list[str] | None = None, folder: str = TOKENIZERS) -> tuple[DataFrame, str]:
    """The rows of docs (columns `keep`, all by default) with a struct: token counts before and after the edits that
    edits_of gives for each text, pre-tokens encoded again, and the tree's leaf sums. Returns the DataFrame and the
    struct's name."""
    name = free_name(docs.columns, "tokens")
    return with_found(docs, text, name, FOUND, _finder(edits_of, folder), keep), name


_SPACES = regex.compile(r"[ \t]{2,}+|\n{3,}+")


def cleaning_edits(text: str) -> list[Edit]:
    """Edits of a usual cleaning pass: personal data is masked, runs of blanks are shortened, and a line that equals the
    line before it is taken out."""
    edits = [(a, b, f"[{KINDS[kind]}]") for a, kind, b in base_spans(text)]
    edits += [(*m.span(), m[0][0]) for m in _SPACES.finditer(text)]
    at, last = 0, None
    for line in text.split("\n"):
        if line and line == last:
            edits.append((at - 1, at + len(line), ""))
        last, at = line, at + len(line) + 1
    return edits

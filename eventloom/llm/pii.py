"""Personal data in whole texts: fixed patterns, and more spans from a linear-chain conditional random field.

Base spans (kinds e-mail, ip, card, phone) come from the patterns. The field labels words with begin and inside of a
kind from features of word shapes and is trained from a small labelled table; its spans are added where they touch no
base span. A word without a digit or "@" can only have the label "other", so it cuts the chain in two; Viterbi
therefore runs over the stretches of words in between, which is exact, many stretches at a time in numpy.

Positions are code points, ends exclusive. Edge cases: a null or empty text has no spans (the digest is that of the
empty string); rows with equal or null ids are read each on its own; a text may be of any length, as all patterns are
applied in linear time.
"""

from __future__ import annotations

import functools
import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.pii_labelled import LABELLED
from eventloom.llm.rows import free_name, with_found
from eventloom.llm.words import LEADS, Texts

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *[f"{p}-{k}" for k in KINDS for p in "BI"])

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+ : from each "@" both ways, so in linear time."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        if domain:
            begin = at
            while begin > last and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < at:
                found.append((begin, domain.end()))
                last = domain.end()
        at = text.find("@", at + 1)
    return found


def addresses(text: str) -> list[tuple[int, int]]:
    """Each dotted chain of numbers is cut into fours from its left, as a leftmost search does."""
    found = []
    for chain in _DOTTED.finditer(text):
        parts = chain[0].split(".")
        at = chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                found.append((at, end))
            at = end + 1
    return found


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m[0])) <= 15]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), in order."""
    finders = (emails, addresses, cards, phones)
    return sorted((a, kind, b) for kind, find in enumerate(finders) for a, b in find(text))


# --- features -------------------------------------------------------------------------------------------------------

_HINTS = {
    "phone": "phone", "tel": "phone", "telefon": "phone", "call": "phone", "mobile": "phone", "fax": "phone", "cell": "phone", "ring": "phone",
    "mail": "email", "email": "email", "e-mail": "email", "contact": "email", "write": "email",
    "ip": "ip", "host": "ip", "server": "ip", "address": "ip",
    "card": "card", "visa": "card", "karte": "card", "carte": "card", "mastercard": "card",
}
_EDGES = "\"'.,;:!?<>[]{}"


def shape(word: str) -> str:
    """Digits d, upper X, lower x, other letters w; the rest as it is; runs cut at five."""
    out, run = [], 0
    for c in word[:40]:
        k = "d" if "0" <= c <= "9" else "X" if "A" <= c <= "Z" else "x" if "a" <= c <= "z" else "w" if c.isalpha() else c
        run = run + 1 if out and out[-1] == k else 1
        if run <= 5:
            out.append(k)
    return "".join(out)


def _collapsed(s: str) -> str:
    return re.sub(r"(.)\1+", r"\1", s)


@functools.lru_cache(1 << 16)
def _own_features(word: str) -> tuple[str, ...]:
    core = word.strip(_EDGES)
    s = shape(core)
    n = sum("0" <= c <= "9" for c in core)
    sized = "0" if n == 0 else str(n) if n <= 5 else "6-8" if n <= 8 else "9-11" if n <= 11 else "12-19" if n <= 19 else "20+"
    letters = sum(c.isalpha() for c in core)
    return (
        f"shape={s}", f"short={_collapsed(s)}", f"digits={sized}", f"letters={min(letters, 3)}", f"dots={min(core.count('.'), 4)}",
        f"dashes={min(core.count('-'), 4)}", f"colons={min(core.count(':'), 3)}", f"at={core.find('@') > 0}", f"handle={core.startswith('@')}",
        f"first={s[:1]}", f"first3={s[:3]}", f"last3={s[-3:]}", f"pure={n == len(core)}", f"slash={'/' in core}", f"equals={'=' in core}",
        f"end={word[-1:] if word[-1:] in _EDGES else ''}",
    )


def _features(word: str, before: str, after: str) -> list[str]:
    hint = _HINTS.get(before.strip(_EDGES).lower(), "")
    near = lambda w: _collapsed(shape(w.strip(_EDGES)))
    return [*_own_features(word), f"hint={hint}", f"before={near(before)}", f"after={near(after)}", "bias"]


def _signal(word: str) -> bool:
    return any("0" <= c <= "9" or c == "@" for c in word)


# --- the field ------------------------------------------------------------------------------------------------------

_FORBIDDEN = np.zeros((len(LABELS), len(LABELS)), bool)
for _k in range(len(KINDS)):
    _inside = 2 + 2 * _k
    _FORBIDDEN[:, _inside] = True
    _FORBIDDEN[[_inside - 1, _inside], _inside] = False
_LOW = -1e9


@dataclass
class Field:
    """Weights: by feature and label, by label pair; the label before and after a stretch is "other"."""

    weights: dict[str, np.ndarray]
    moves: np.ndarray

    def scores(self, features: list[str]) -> np.ndarray:
        out = np.zeros(len(LABELS))
        for f in features:
            w = self.weights.get(f)
            if w is not None:
                out += w
        return out

    def decode(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best labels of stretches, whose scores stand one after the other: Viterbi, a word of all stretches at a time."""
        order = np.argsort(-lengths, kind="stable")
        begin = (np.cumsum(lengths) - lengths)[order]
        sizes = lengths[order]
        labels = np.zeros(len(scores), np.int64)
        back = np.zeros(scores.shape, np.int8)
        best = scores[begin] + self.moves[0]
        final = np.zeros((len(sizes), len(LABELS)))
        for t in range(1, int(sizes[0]) if len(sizes) else 0):
            live = np.searchsorted(-sizes, -t)  # stretches of more than t words
            final[live : len(best)] = best[live:]
            moved = best[:live, :, None] + self.moves
            at = begin[:live] + t
            back[at] = moved.argmax(1)
            best = moved.max(1) + scores[at]
        final[: len(best)] = best
        now = (final + self.moves[:, 0]).argmax(1)
        for t in range(int(sizes[0]) - 1 if len(sizes) else -1, -1, -1):
            live = np.searchsorted(-sizes, -t)
            at = begin[:live] + t
            labels[at] = now[:live]
            now[:live] = back[at, now[:live]]
        return labels


def parsed(sentence: str) -> list[tuple[list[str], list[int]]]:
    """Words and labels of a marked sentence."""
    words, labels = [], []
    for m in re.finditer(r"\[(\w+) ([^\]]+)\]|([^\x20\x09-\x0D]+)", sentence):
        if m[1] in KINDS:
            inner = m[2].split()
            words += inner
            labels += [1 + 2 * KINDS.index(m[1]) + (k > 0) for k in range(len(inner))]
        else:
            words.append(m[0])
            labels.append(0)
    return words, labels


def _stretches(words: list[str]) -> list[tuple[int, int]]:
    out, k = [], 0
    while k < len(words):
        j = k
        while j < len(words) and _signal(words[j]):
            j += 1
        if j > k:
            out.append((k, j))
        k = max(j, k + 1)
    return out


@functools.lru_cache(4)
def trained(labelled: str = LABELLED, rounds: int = 150, penalty: float = 0.02, rate: float = 0.15) -> Field:
    """Maximum likelihood with an L2 penalty: forward-backward over all stretches at once, Adam steps. The table is
    small by contract (it is held and trained on by every task that needs it: a fraction of a second)."""
    chains = []
    for line in filter(None, labelled.split("\n")):
        words, labels = parsed(line)
        for a, b in _stretches(words):
            feats = [_features(words[k], words[k - 1] if k else "", words[k + 1] if k + 1 < len(words) else "") for k in range(a, b)]
            chains.append((feats, labels[a:b]))
    names = {f: i for i, f in enumerate(dict.fromkeys(f for feats, _ in chains for x in feats for f in x))}
    n, longest, size = len(chains), max(len(x) for _, x in chains), len(LABELS)
    lengths = np.array([len(x) for _, x in chains])
    mask = np.arange(longest) < lengths[:, None]
    inputs = np.zeros((n, longest, len(names)))
    gold = np.zeros((n, longest, size))
    gold_moves = np.zeros((size, size))
    for i, (feats, labels) in enumerate(chains):
        for t, (fs, y) in enumerate(zip(feats, labels)):
            inputs[i, t, [names[f] for f in fs]] = 1
            gold[i, t, y] = 1
        for a, b in zip([0, *labels], [*labels, 0]):
            gold_moves[a, b] += 1
    params = [np.zeros((len(names), size)), np.zeros((size, size))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1):
        moves = np.where(_FORBIDDEN, _LOW, params[1])
        scores = inputs @ params[0]
        ahead = np.zeros((n, longest, size))
        ahead[:, 0] = scores[:, 0] + moves[0]
        for t in range(1, longest):
            ahead[:, t] = np.logaddexp.reduce(ahead[:, t - 1, :, None] + moves, axis=1) + scores[:, t]
        behind = np.zeros((n, longest, size))
        for t in range(longest - 1, -1, -1):
            behind[:, t] = moves[:, 0]
            if t + 1 < longest:
                onward = np.logaddexp.reduce(moves + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
                behind[:, t] = np.where(mask[:, t + 1, None], onward, behind[:, t])
        total = np.logaddexp.reduce(ahead[:, 0] + behind[:, 0], axis=1)
        share = np.exp(ahead + behind - total[:, None, None]) * mask[..., None]
        expected = np.zeros((size, size))
        expected[0] += share[:, 0].sum(0)
        for t in range(longest):
            ends = lengths == t + 1
            expected[:, 0] += share[ends, t].sum(0)
            if t + 1 < longest:
                pair = ahead[:, t, :, None] + moves + (scores[:, t + 1] + behind[:, t + 1])[:, None, :] - total[:, None, None]
                expected += (np.exp(pair) * mask[:, t + 1, None, None]).sum(0)
        grads = [np.einsum("itf,itl->fl", inputs, gold - share) - penalty * params[0], np.where(_FORBIDDEN, 0, gold_moves - expected) - penalty * params[1]]
        for k, g in enumerate(grads):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            params[k] = params[k] + rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Field({f: params[0][i] for f, i in names.items()}, np.where(_FORBIDDEN, _LOW, params[1]))


# --- the operator ---------------------------------------------------------------------------------------------------

FOUND = T.StructType([
    *[T.StructField(f"n_{k}", T.LongType()) for k in KINDS],
    T.StructField("n_added", T.LongType()),
    T.StructField("base", T.StringType()),
    T.StructField("spans", T.StringType()),
])
_MARKS = np.isin(np.arange(256), list(b"0123456789@"))


def _labelled_words(texts: Texts, field: Field) -> list[tuple[int, int, int, int]]:
    """(row, kind, begin byte, end byte) of the field's spans."""
    marks = np.concatenate([[0], np.cumsum(_MARKS[texts.data])])
    words = np.flatnonzero(marks[texts.end] > marks[texts.start])
    if not len(words):
        return []
    row = np.searchsorted(texts.first, words, "right") - 1
    lines = np.concatenate([[0], np.cumsum(texts.data == 10)])[texts.start[words]]
    joined = np.zeros(len(words), bool)
    joined[1:] = (words[1:] == words[:-1] + 1) & (row[1:] == row[:-1]) & (lines[1:] == lines[:-1])
    begin = np.flatnonzero(~joined)
    lengths = np.diff(np.append(begin, len(words)))
    word = lambda k, r: texts.text(texts.start[k], texts.end[k]) if texts.first[r] <= k < texts.first[r + 1] else ""
    scores = np.array([field.scores(_features(word(k, r), word(k - 1, r), word(k + 1, r))) for k, r in zip(words.tolist(), row.tolist())])
    labels = field.decode(scores, lengths)
    out, k = [], 0
    named = np.flatnonzero(labels).tolist()
    stretch = np.repeat(np.arange(len(begin)), lengths)
    while k < len(named):
        j = k + 1
        while j < len(named) and named[j] == named[j - 1] + 1 and stretch[named[j]] == stretch[named[k]] and labels[named[j]] % 2 == 0:
            j += 1
        a, b = texts.start[words[named[k]]], texts.end[words[named[j - 1]]]
        inner = texts.text(a, b)
        left = len(inner) - len(inner.lstrip(_EDGES))
        right = len(inner) - len(inner.rstrip(_EDGES))
        if left + right < len(inner):
            # Edge characters are ASCII, a byte each.
            out.append((int(row[named[k]]), (int(labels[named[k]]) - 1) // 2, int(a) + left, int(b) - right))
        k = j
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def _finder(labelled: str):
    def start():
        field = trained(labelled)

        def find(column: pa.Array) -> list[pa.Array]:
            texts = Texts(column)
            marked = np.flatnonzero(texts.per_row(_MARKS[texts.data]))
            counts = np.zeros((5, texts.n), np.int64)
            base, spans = [""] * texts.n, [""] * texts.n
            added: dict[int, list] = {}
            for row, kind, a, b in _labelled_words(texts, field):
                added.setdefault(row, []).append((a, kind, b))
            leads = np.concatenate([[0], np.cumsum(LEADS[texts.data])])
            for i in marked.tolist():
                own = base_spans(texts.text(texts.rows[i], texts.rows[i + 1]))
                for _, kind, _ in own:
                    counts[kind, i] += 1
                base[i] = spans[i] = _joined(own)
                if i in added:
                    zero = leads[texts.rows[i]]
                    more = [(int(leads[a] - zero), kind, int(leads[b] - zero)) for a, kind, b in added[i]]
                    more = _apart(more, own)
                    counts[4, i] = len(more)
                    spans[i] = _joined(sorted([*own, *more]))
            return [*[pa.array(c) for c in counts], pa.array(base), pa.array(spans)]

        return find

    return start


def _apart(spans: list[tuple[int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans (in order, disjoint) that touch none of base (ordered by start)."""
    out, k, reach = [], 0, -1
    for a, kind, b in spans:
        while k < len(base) and base[k][0] < b:
            reach = max(reach, base[k][2])
            k += 1
        if reach <= a:
            out.append((a, kind, b))
    return out


def found(docs: DataFrame, text: str = "text", keep: list[str] | None = None, labelled: str = LABELLED) -> tuple[DataFrame, str]:
    """The rows of docs (columns `keep`, all by default) with a struct: base spans per kind, spans that the field adds,
    base_sha256, base and all spans as kind:start:end by start. Returns the DataFrame and the struct's name."""
    name = free_name(docs.columns, "personal")
    rows = with_found(docs, text, name, FOUND, _finder(labelled), keep)
    return rows.withColumn(name, F.col(name).withField("base_sha256", F.sha2(F.col(f"{name}.base"), 256))), name

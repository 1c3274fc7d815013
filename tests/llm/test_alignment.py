"""Cross-tokeniser alignment against plain sets of ends and ranges."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import alignment, queries
from eventloom.llm.fertility import TOKENIZERS
from tests.conftest import SF


@pytest.fixture(scope="module")
def coders():
    return alignment.Coders(TOKENIZERS)


def plain(coders, text):
    """(n_a, n_b, groups text, links) of one text, from sets of ends."""
    whole = b" " + (text or "").encode()
    a = coders.a.encode(" " + (text or ""), add_special_tokens=False).ids
    b = coders.b.encode(text or "")
    spelt = lambda ids, of: b"".join(of[i] for i in ids)
    if not text or spelt(a, coders.bytes_a) != whole or spelt(b, coders.bytes_b) != whole:
        return 0, 0, "", Counter()

    owner = lambda ids, of: [k for k, i in enumerate(ids) for _ in of[i]]
    of_a, of_b = owner(a, coders.bytes_a), owner(b, coders.bytes_b)  # the token of each byte
    ends = lambda owners: {k + 1 for k in range(len(whole)) if k + 1 == len(whole) or owners[k] != owners[k + 1]}
    groups, start = [], 0
    for cut in sorted(ends(of_a) & ends(of_b)):
        written = lambda ids, owners: ",".join(str(ids[k]) for k in range(owners[start], owners[cut - 1] + 1))  # noqa: E731, B023
        groups.append(f"{written(a, of_a)}|{written(b, of_b)}")
        start = cut
    links = Counter((a[i], b[j]) for i, j in set(zip(of_a, of_b)))
    return len(a), len(b), ";".join(groups), links


def expected(coders, texts):
    found = [plain(coders, t) for t in texts]
    counts = Counter(p for *_, links in found for p in links)
    top = Counter()
    for (i, _), n in counts.items():
        top[i] = max(top[i], n)
    out = []
    for n_a, n_b, groups, links in found:
        best = sum(n for p, n in links.items() if counts[p] == top[p[0]])
        total = sum(n * counts[p] for p, n in links.items())
        sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((n_a, n_b, groups.count(";") + 1 if groups else 0, sum(links.values()), best, total, sha, groups))
    return out, counts


def texts(seed, n=120):
    rng = random.Random(seed)
    pools = ["the quick brown fox naïve café ", "日本語のテキスト 中文 ", "aaaa    \n\n\t0123456789", "🦄👩‍👩‍👧 é̀ ﬁ ½ ▁ \x00", "<|endoftext|> <s> </s> <unk> <0x41> "]
    made = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 80))) for _ in range(n)]
    return [*made, None, "", " ", "a", "<|endoftext|>", "<s></s>", "a" * 3000, "word " * 700, "▁", "  two  spaces "]


def test_bytes_of_all_tokens(coders):
    assert sorted(x for x in coders.bytes_a if len(x) == 1) == sorted(bytes([b]) for b in range(256))
    assert coders.a.decode(list(range(300))).encode()  # the vocabulary is read as the library reads it
    assert b"".join(coders.bytes_a[i] for i in coders.a.encode(" naïve 日本", add_special_tokens=False).ids) == " naïve 日本".encode()


@pytest.mark.parametrize("seed", range(12))
def test_cuts_by_division(seed):
    rng = np.random.default_rng(seed)
    ends_a = ends_b = np.zeros(0, np.int64)
    sizes, base = [], 0
    for _ in range(40):  # intervals with many, few and clustered shared ends
        n = int(rng.integers(1, 400))
        dense_a, dense_b = rng.random(2) ** 2
        a = np.flatnonzero(rng.random(n) < dense_a)
        b = np.flatnonzero(rng.random(n) < dense_b)
        if rng.random() < 0.5:
            b = b[b > n * rng.random()]
        a, b = (np.append(x, n) + base for x in (a, b))
        ends_a, ends_b = np.concatenate([ends_a, a]), np.concatenate([ends_b, b])
        sizes.append(len(a))
        base += n + 1
    last = np.cumsum(sizes)
    got = alignment.shared_cuts(ends_a, ends_b, last - sizes, last)
    assert got.tolist() == np.flatnonzero(np.isin(ends_a, ends_b)).tolist()


@pytest.mark.parametrize("book", [1, 600, alignment.BOOK_BYTES])
def test_against_plain_version(spark, coders, monkeypatch, book):
    monkeypatch.setattr(alignment, "BOOK_BYTES", book)
    rows = texts(book) * (2 if book == 600 else 1)
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(rows)], "doc_id long, text string, alignment string, book int").repartition(4)
    found, m = alignment.aligned(docs, groups=True)
    assert found.columns == [*docs.columns, m]
    got = {r.doc_id: r for r in found.collect()}
    assert len(got) == len(rows)
    want, counts = expected(coders, rows)
    for k, w in enumerate(want):
        r = got[k][m]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256, r.groups) == w, rows[k]
    if book == 600:
        pairs = {(r.a_id, r.b_id): r.n_docs for r in alignment.pair_counts(docs).collect()}
        assert pairs == counts


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([(None, "some text"), (1, "some text"), (1, "some text"), (None, None)], "doc_id long, text string")
    found, m = alignment.aligned(docs)
    rows = [r for r in found.select("doc_id", f"{m}.*").collect()]
    assert len(rows) == 4 and {r.count_sum for r in rows if r.n_a} == {3 * rows[0].n_links or 3 * rows[1].n_links}
    assert alignment.aligned(docs.limit(0))[0].count() == 0


def test_query_on_the_whole_table(spark, coders):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want, _ = expected(coders, [r.text for r in docs])
    got = queries.op13_alignment(spark, SF)
    names = [c for c in alignment.FOUND.names if c != "groups"]
    assert got.columns == ["doc_id", *names]
    assert sorted(map(tuple, got.collect())) == sorted((r.doc_id, *w[:-1]) for r, w in zip(docs, want))
    assert got.filter(F.col("n_groups") > 0).count() > 0

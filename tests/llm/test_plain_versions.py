"""Licence and secret scans against plain Python over whole texts: patterns, features, weights and trees walked one by one."""

import math
import random
import re

import pytest
import regex

from eventloom.llm import licences, secrets
from eventloom.llm.licence_texts import TEMPLATES, UNKNOWN
from tests.conftest import SF


def share(value, pattern):
    return len(re.findall(pattern, value)) / max(len(value), 1)


def features(value, before, after, path):
    has = lambda text, pattern: 1.0 if re.search(pattern, text) else 0.0
    return [
        float(len(value)),
        share(value, "[0-9]"),
        share(value, "[A-Z]"),
        share(value, "[a-z]"),
        share(value, "[^A-Za-z0-9]"),
        has(value, "^(?:[0-9a-f]+|[0-9A-F]+)$"),
        has(value, "^[0-9]+$"),
        share(value, "[A-Za-z](?=[0-9])"),
        share(value, "[0-9](?=[A-Za-z])"),
        share(value, "[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        share(value, "(?i)[bcdfghjklmnpqrstvwxz](?=[aeiouy])"),
        share(value, r"(.)(?=\1)"),
        (len(value) - len(re.sub(secrets._WORDS, "", value))) / max(len(value), 1),
        has(value, secrets._PREFIXES),
        has(value, "^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"),
        float(value.count("/")),
        share(value, "[-_]"),
        has(before, secrets._SECRET_WORDS + r"[^A-Za-z0-9]*$"),
        has(before, secrets._SECRET_WORDS),
        has(before, r"[=:]\s*[\"']?$"),
        has(before, "[\"']$") * has(after, "^[\"']"),
        has(before, secrets._OTHER_WORDS + r"[^A-Za-z]*(?:of the file )?[^A-Za-z]*$"),
        has(before, r"(?i)https?://\S*$"),
        has(path, r"(?i)(?:\.env|\.pem|config|credential|secret)"),
        has(path, r"(?i)(?:test|example|sample|docs?/)"),
    ]


def walked(node, f):
    while isinstance(node, tuple):
        at, threshold, left, right = node
        node = left if f[at] <= threshold else right
    return node


def plain_findings(forest, text, path):
    spans = [m.span() for m in re.finditer(secrets.CANDIDATE, text or "")]
    for k, (start, end) in enumerate(spans):
        before = text[spans[k - 1][1] if k else 0 : start][-secrets.NEAR :]
        after = text[end : spans[k + 1][0] if k + 1 < len(spans) else len(text)][: secrets.NEAR]
        f = features(text[start:end], before, after, path or "")
        yield start, end, text[start:end], sum(walked(t, f) for t in forest.trees) / len(forest.trees)


def made_texts(seed):
    rng = random.Random(seed)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    keys = lambda n: "".join(rng.choice("ABCDEFGHabcdefgh0123456789_+/-") for _ in range(n))
    parts = [
        lambda: f"password = '{keys(20)}'", lambda: f"commit {hexes(40)}", lambda: f"https://host.example/{keys(14)}/file_{rng.randrange(999999):06d}.html",
        lambda: f"token: ghp_{keys(36)}", lambda: "plain words and Naïve ones", lambda: f"order {rng.randrange(10**15)}", lambda: f"{hexes(8)}-{hexes(4)}-{hexes(4)}-{hexes(4)}-{hexes(12)}",
        lambda: f"AKIA{keys(16).upper()}==", lambda: "🦄 é \n\t", lambda: f"release_notes_2024_{rng.choice(['summer', 'winter'])}_final",
    ]
    return [" ".join(rng.choice(parts)() for _ in range(rng.randint(0, 12))) for _ in range(60)]


def test_findings_and_masks(spark, forest):
    given = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").limit(80).collect()
    rows = [(k, t, p) for k, (t, p) in enumerate([*[(r.text, r.source) for r in given], *[(t, rng) for t, rng in zip(made_texts(1), ["a/.env", None, "docs/test.md"] * 20)], (None, "x")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want, masked = [], {}
    for k, text, path in rows:
        found = [x for x in plain_findings(forest, text, path) if x[3] >= 0.5]
        want += [(k, s, e, v, round(score, 6)) for s, e, v, score in found]
        for s, e, *_ in reversed(found):
            text = text[:s] + secrets.MASK + text[e:]
        masked[k] = text
    got = [(r.doc_id, r.start, r.end, r.value, r.score) for r in secrets.findings(docs, forest=forest).collect()]
    assert len(want) > 30
    assert [x[:4] for x in sorted(got)] == [x[:4] for x in sorted(want)]
    assert all(abs(a[4] - b[4]) < 2e-6 for a, b in zip(sorted(got), sorted(want)))
    assert {r.doc_id: r.text for r in secrets.redacted(docs, forest=forest).collect()} == masked


def plain_paragraphs(model, text, least=0.5, enough=0.6):
    """(paragraph, family, probability, share) of a text's paragraphs with an anchor."""
    for number, paragraph in enumerate(regex.split(licences.PARAGRAPH_END, text or "")):
        if not regex.search(licences.ANCHOR, paragraph):
            continue
        words = regex.findall(licences._WORD, paragraph.lower())
        grams = {*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))}
        logits = [b + sum(model.weights[g][k] for g in grams if g in model.weights) for k, b in enumerate(model.intercepts)]
        top = max(logits)
        powers = [math.exp((x - top) / model.temperature) for x in logits]
        p = [x / sum(powers) for x in powers]
        best = max(range(len(p)), key=p.__getitem__)
        family = model.families[best] if p[best] >= least else licences.NO_LICENCE
        likeness = 0.0
        for template in TEMPLATES.get(family, ()):
            w = regex.findall(licences._WORD, template.lower())
            two = {f"{a} {b}" for a, b in zip(w, w[1:])} or set(w)
            likeness = max(likeness, len(two & grams) / len(two))
        yield number, family, p[best], likeness


def test_paragraphs_with_an_anchor(spark, classifier):
    rng = random.Random(4)
    notices = [t for texts in TEMPLATES.values() for t in texts if not regex.search(licences.PARAGRAPH_END, t)]
    other = [t for t in UNKNOWN if not regex.search(licences.PARAGRAPH_END, t)]
    words = "the permission of this work under a license may be public and free for use by any person named MIT or BSD".split()
    texts = [None, "", "no anchor here"]
    for _ in range(60):  # one paragraph per block, so no block holds more than its paragraph
        parts = [rng.choice([lambda: rng.choice(notices), lambda: rng.choice(other), lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 20)))])() for _ in range(rng.randint(1, 5))]
        texts.append("\n\n".join(parts))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {(k, n): x for k, t in enumerate(texts) for n, *x in plain_paragraphs(classifier, t)}
    got = {(r.doc_id, r.paragraph): r for r in licences.scan(docs, classifier=classifier).collect()}
    assert set(got) == set(want) and len(got) > 100
    for at, (family, probability, likeness) in want.items():
        r = got[at]
        assert r.probability == pytest.approx(probability, abs=2e-6) and r.share == pytest.approx(likeness, abs=2e-6), at
        if abs(probability - 0.5) > 1e-5:
            assert r.family == family and r.confirmed == (likeness >= 0.6)

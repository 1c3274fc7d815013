"""Licence scan: a paragraph classifier confirmed by template comparison. DataFrame functions only.

Paragraphs are lines, cut after sentences. Those with an anchor (licence, copyright, a family's name, ...) are classified: a sparse
multinomial logistic regression over the set of their words and word pairs gives a probability per licence family and
for "unknown", a class of its own. A temperature, fitted on training rows that the regression has not seen, calibrates
the probabilities; a family needs `least` of it. Its prediction is confirmed if the paragraph holds enough of the word
pairs of one of the family's templates. A paragraph without an anchor is no licence by definition.

A notice may be wrapped over lines or have several sentences, so templates are also compared with whole blocks (lines up
to a blank one; comment marks are no words). Where a block holds enough of a template, and more than any of its
paragraphs does, the classifier reads what they share, and the block is reported at its first paragraph.

Edge cases: null and empty texts have no paragraphs; a null id stays null; equal rows are reported each; texts may be of any length.
"""

from __future__ import annotations

import functools
import json
import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.licence_texts import FRAMES, TEMPLATES, UNKNOWN, UNKNOWN_FRAMES

ANCHOR = (
    r"(?i)licen[cs]|copyright|rights reserved|public domain|warrant|permission|redistribut|creative commons|\bCC[ -]?(?:BY|0)"
    r"|SPDX|(?-i:\bMIT\b)|\bapache\b|\b[AL]?GPL|\bGNU\b|\bBSD\b|\bmozilla\b|\bMPL\b"
)
PARAGRAPH_END = r"\n|(?<=[.!?])[ \t]+(?=[A-Z\p{Lu}])"
#: Before the blank lines that end a block.
BLOCK_END = r"(?<=\n)(?=[ \t\r]*+\n)"
NO_LICENCE = "unknown"
_WORD = r"[\p{L}0-9]+(?:[.-][\p{L}0-9]+)*"
#: Training rows, at most.
ROWS = 20_000


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(0))


def pairs(w: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    at = F.when(F.size(w) > 1, F.sequence(F.lit(1), F.size(w) - 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: F.concat_ws(" ", F.element_at(w, i), F.element_at(w, i + 1))))


def grams(w: Column) -> Column:
    """Distinct words and pairs of an array of words, which must be a column or a lambda's variable: pairs reads it once
    for each word."""
    return F.array_distinct(F.concat(w, pairs(w)))


def labelled() -> list[tuple[str, str]]:
    """(paragraph, family) rows: each notice and each other sentence in several frames."""
    notices = [(a + text + b, family) for family, texts in TEMPLATES.items() for text in texts for a, b in FRAMES]
    return notices + [(a + text + b, NO_LICENCE) for text in UNKNOWN for a, b in UNKNOWN_FRAMES]


@dataclass(frozen=True)
class Classifier:
    """Nonzero weights by word or pair (a value per family), intercepts, and the temperature."""

    families: tuple[str, ...]
    weights: dict[str, list[float]]
    intercepts: list[float]
    temperature: float

    def logits(self, features: Column) -> Column:
        table = F.from_json(F.lit(json.dumps(self.weights)), "map<string,array<double>>")
        known = F.filter(F.transform(features, lambda g: F.element_at(table, g)), lambda x: x.isNotNull())
        start = F.array(*[F.lit(float(b)) for b in self.intercepts])
        return F.aggregate(known, start, lambda s, x: F.zip_with(s, x, lambda a, b: a + b))

    def probabilities(self, logits: Column) -> Column:
        scaled = F.transform(logits, lambda x: x / self.temperature)
        powers = F.transform(scaled, lambda x: F.exp(x - F.array_max(scaled)))
        return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda s, y: s + y))


def fitted(spark: SparkSession, rows: list[tuple[str, str]] | None = None, penalty: float = 0.003, held_out: int = 4, at_most: int = ROWS) -> Classifier:
    """The classifier of labelled paragraphs, of which at most `at_most` are read. Every `held_out`th row is kept from the
    regression for the temperature."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizer

    rows = (rows or labelled())[:at_most]
    families = tuple(sorted({family for _, family in rows}))
    table = spark.createDataFrame([(k, text, float(families.index(family))) for k, (text, family) in enumerate(rows)], "number long, text string, label double")
    table = table.coalesce(1).select("number", "label", _once(words(F.col("text"))).alias("words"))
    table = table.select("number", "label", grams(F.col("words")).alias("grams")).cache()
    counter = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=2.0).fit(table)
    ready = counter.transform(table.filter(F.col("number") % held_out != held_out - 1))
    model = LogisticRegression(family="multinomial", elasticNetParam=0.9, regParam=penalty, maxIter=60, standardization=False).fit(ready)
    matrix = model.coefficientMatrix.toArray()
    weights = {g: [float(x) for x in matrix[:, j]] for j, g in enumerate(counter.vocabulary) if matrix[:, j].any()}
    raw = Classifier(families, weights, [float(x) for x in model.interceptVector.toArray()], 1.0)
    seen = table.filter(F.col("number") % held_out == held_out - 1).select("label", raw.logits(F.col("grams")).alias("logits")).collect()
    table.unpersist()

    def loss(t: float) -> float:
        total = 0.0
        for label, logits in seen:
            top = max(x / t for x in logits)
            total += top + math.log(sum(math.exp(x / t - top) for x in logits)) - logits[int(label)] / t
        return total

    temperature = min((0.25 * 1.1**k for k in range(40)), key=loss) if seen else 1.0
    return Classifier(families, weights, raw.intercepts, temperature)


@functools.lru_cache(4)
def standard_classifier(spark: SparkSession) -> Classifier:
    """The classifier of the notices given here, fitted once per session."""
    return fitted(spark)


@functools.cache
def _template_json() -> str:
    """Of each template the family, pairs (the word itself where there is one only) and grams."""
    out = []
    for family, texts in TEMPLATES.items():
        for text in texts:
            w = re.findall(_WORD.replace(r"[\p{L}0-9]", r"[^\W_]"), text.lower())
            two = list(dict.fromkeys(f"{x} {y}" for x, y in zip(w, w[1:])))
            out.append({"family": family, "pairs": two or w, "grams": list(dict.fromkeys(w + two))})
    return json.dumps(out)


def _templates() -> Column:
    return F.from_json(F.lit(_template_json()), "array<struct<family:string,pairs:array<string>,grams:array<string>>>")


def _once(value: Column) -> Column:
    """The value through a generator, so that it is not put into the lambdas that use it and computed there again."""
    return F.explode(F.array(value))


def _share(template: Column, found: Column) -> Column:
    """Which part of a template's pairs is found."""
    return F.size(F.array_intersect(template["pairs"], found)) / F.size(template["pairs"])


def _blocks(texts: DataFrame, model: Classifier, least: float, share: float) -> DataFrame:
    """(_id, paragraph, family, probability, share) of the blocks of several paragraphs that hold a notice as a whole."""
    split = texts.select("_id", _once(F.split("_whole", BLOCK_END)).alias("_blocks"))
    ends = F.transform("_blocks", lambda b: F.regexp_count(b, F.lit(PARAGRAPH_END)))
    inner = lambda b: F.regexp_replace(b, r"^\s+|\s+$", "")
    wanted = F.filter(
        F.sequence(F.lit(1), F.size("_blocks")),
        lambda i: F.element_at("_blocks", i).rlike(ANCHOR) & (F.regexp_count(inner(F.element_at("_blocks", i)), F.lit(PARAGRAPH_END)) > 0),
    )
    blank = lambda b: F.regexp_count(F.regexp_extract(b, r"^\s*", 0), F.lit("\n"))
    each = split.withColumn("_ends", _once(ends)).select("_id", "_blocks", "_ends", F.explode(wanted).alias("_i"))
    block = F.element_at("_blocks", F.col("_i"))
    before = F.aggregate(F.slice("_ends", F.lit(1), F.col("_i") - 1), F.lit(0), lambda s, x: s + x)
    each = each.select("_id", (before + blank(block)).alias("paragraph"), inner(block).alias("_block"))
    each = each.withColumn("_words", _once(words(F.col("_block")))).withColumn("_grams", _once(grams(F.col("_words"))))
    shared = F.filter(F.transform(_templates(), lambda t: F.struct(_share(t, F.col("_grams")).alias("share"), t.alias("template"))), lambda x: x["share"] >= share)
    each = each.withColumn("_shared", _once(shared)).filter(F.size("_shared") > 0)
    lines = F.filter(F.split("_block", PARAGRAPH_END), lambda p: p.rlike(ANCHOR))
    each = each.withColumn("_lines", _once(F.transform(lines, words))).withColumn("_lines", _once(F.transform("_lines", grams)))
    best = F.transform(F.array(*[F.lit(f) for f in TEMPLATES]), lambda f: F.array_max(F.filter("_shared", lambda x: x["template"]["family"] == f)))
    each = each.select("_id", "paragraph", "_lines", "_grams", F.explode(best).alias("_best")).filter("_best is not null")
    alone = F.exists("_lines", lambda g: _share(F.col("_best.template"), g) >= F.col("_best.share"))
    each = each.filter(~alone).withColumn("_logits", _once(model.logits(F.array_intersect("_best.template.grams", "_grams"))))
    each = each.withColumn("_p", _once(model.probabilities(F.col("_logits"))))
    at = F.array_position(F.array(*[F.lit(f) for f in model.families]), F.col("_best.template.family"))
    probability = F.when(at > 0, F.get("_p", (at - 1).cast("int")))
    return each.select("_id", "paragraph", F.col("_best.template.family").alias("family"), probability.alias("probability"), F.col("_best.share").alias("share")).filter(
        F.col("probability") >= least
    )


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", classifier: Classifier | None = None, least: float = 0.5, share: float = 0.6) -> DataFrame:
    """A row per paragraph with an anchor: id, paragraph (its number in the text), family (or unknown), probability, of
    the family's templates the largest share of pairs found, confirmed. A notice of which a whole block
    holds more than each of its paragraphs has a row of its own, with the number of the block's first paragraph."""
    model = classifier or standard_classifier(docs.sparkSession)
    whole = F.col(f"`{text}`").cast("string")
    anchored = docs.filter(whole.rlike(ANCHOR)).select(F.col(f"`{id}`").alias("_id"), whole.alias("_whole"))
    texts = anchored.select("_id", F.posexplode(F.split("_whole", PARAGRAPH_END)).alias("paragraph", "_text"))
    found = texts.filter(F.col("_text").rlike(ANCHOR)).select("_id", "paragraph", words(F.col("_text")).alias("_words"))
    found = found.select("_id", "paragraph", pairs(F.col("_words")).alias("_pairs"), F.array_distinct("_words").alias("_words"))
    scored = found.select("_id", "paragraph", F.concat("_words", "_pairs").alias("_grams"))
    scored = scored.withColumn("_logits", _once(model.logits(F.col("_grams")))).withColumn("_p", _once(model.probabilities(F.col("_logits"))))
    top = F.array_max("_p")
    families = F.array(*[F.lit(f) for f in model.families])
    best = scored.withColumn("probability", top).withColumn(
        "family", F.when(top >= least, F.element_at(families, F.array_position("_p", top).cast("int"))).otherwise(NO_LICENCE)
    )
    of_family = F.filter(_templates(), lambda t: t["family"] == F.col("family"))
    shares = F.transform(of_family, lambda t: _share(t, F.col("_grams")))
    likeness = F.coalesce(F.array_max(shares), F.lit(0.0))
    found = best.select("_id", "paragraph", "family", "probability", likeness.alias("share")).unionByName(_blocks(anchored, model, least, share))
    return found.select(
        F.col("_id").alias(id), "paragraph", "family", F.round("probability", 6).alias("probability"), F.round("share", 6).alias("share"),
        (F.col("share") >= share).alias("confirmed"),
    )

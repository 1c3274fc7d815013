"""Secret scan: candidates by pattern, false positives removed by a random forest. DataFrame functions only.

Candidates are runs of at least 12 characters of keys and encodings that hold a digit. The text splits into candidates and
the pieces between them; features are the candidate's length, its character classes and their transitions, how much of
it a small dictionary covers, whether it or its document's path looks like a path, and the words next to it. The
forest is fitted on labelled findings (a bounded table) and written out as a column expression, so scoring is part of the scan.

Edge cases: a null or empty text has no findings; a null path counts as empty; rows equal in id and text are reported
once; patterns run in linear time, so texts may be of any length.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.llm.rows import free_name
from eventloom.llm.secret_findings import labelled_findings

CANDIDATE = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{12,}+={0,2}"
MASK = "[SECRET]"
#: Characters of context on either side.
NEAR = 48
#: Labelled findings that a forest is fitted on, at most.
FINDINGS = 20_000

# Words that candidates which are names are made of.
DICTIONARY = (
    "about", "access", "admin", "and", "android", "api", "archive", "article", "asset", "auth", "backup", "base", "battery", "body", "book", "build",
    "case", "cat", "chapter", "charset", "city", "class", "client", "code", "config", "content", "correct", "count", "covid", "css", "customer", "data",
    "date", "day", "default", "demo", "docs", "document", "download", "edition", "encoding", "english", "enterprise", "error", "event", "example", "feed", "file",
    "final", "font", "for", "form", "from", "group", "guide", "header", "home", "horse", "http", "https", "icon", "image", "img", "index", "info",
    "input", "introduction", "issue", "item", "java", "july", "key", "label", "language", "level", "library", "line", "link", "list", "local", "log", "main",
    "manual", "map", "media", "menu", "message", "method", "model", "month", "name", "network", "news", "nightly", "note", "number", "object", "of",
    "office", "order", "output", "package", "page", "parser", "part", "passwort", "password", "patch", "path", "photo", "player", "plugin", "post", "press", "product",
    "profile", "project", "push", "query", "question", "record", "release", "report", "request", "result", "review", "rules", "sample", "script", "search", "season",
    "section", "series", "server", "service", "session", "share", "show", "site", "sommer", "song", "source", "src", "staff", "standard", "start", "state", "statistics",
    "status", "story", "string", "style", "sum", "summer", "system", "table", "task", "team", "test", "text", "the", "theme", "thread", "time", "title",
    "token", "topic", "update", "upload", "user", "utils", "value", "version", "video", "view", "web", "week", "windows", "winter", "work", "world", "year",
)
_WORDS = "(?i)(?:" + "|".join(sorted(DICTIONARY, key=len, reverse=True)) + ")"
_SECRET_WORDS = r"(?i)(?:passw(?:or)?d|passwd|passwort|pwd|secret|token|key|auth|bearer|credential)"
_OTHER_WORDS = r"(?i)(?:commit|sha[0-9]*|md5|hash|checksum|digest|revision|etag|uuid|\bid\b|order|card|isbn|number|file|http|version)"
_PREFIXES = r"^(?:AKIA|ASIA|gh[pousr]_|glpat-|xox[abpr]-|sk[-_]|AIza|eyJ|npm_|dop_v1_)"


def _features(value: Column, before: Column, after: Column, path: Column) -> dict[str, Column]:
    count = lambda c, p: F.regexp_count(c, F.lit(p)).cast("double")
    has = lambda c, p: F.when(c.rlike(p), 1.0).otherwise(0.0)
    size = F.length(value).cast("double")
    share = lambda x: x / F.greatest(size, F.lit(1.0))
    covered = size - F.length(F.regexp_replace(value, _WORDS, "")).cast("double")
    return {
        "length": size,
        "digits": share(count(value, "[0-9]")),
        "upper": share(count(value, "[A-Z]")),
        "lower": share(count(value, "[a-z]")),
        "symbols": share(count(value, "[^A-Za-z0-9]")),
        "hex": has(value, "^(?:[0-9a-f]+|[0-9A-F]+)$"),
        "number": has(value, "^[0-9]+$"),
        "to_digit": share(count(value, "[A-Za-z](?=[0-9])")),
        "to_letter": share(count(value, "[0-9](?=[A-Za-z])")),
        "case_changes": share(count(value, "[a-z](?=[A-Z])|[A-Z](?=[a-z])")),
        "to_vowel": share(count(value, "(?i)[bcdfghjklmnpqrstvwxz](?=[aeiouy])")),
        "repeats": share(count(value, r"(.)(?=\1)")),
        "covered": share(covered),
        "prefix": has(value, _PREFIXES),
        "uuid": has(value, "^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"),
        "slashes": count(value, "/"),
        "dashes": share(count(value, "[-_]")),
        "secret_near": has(before, _SECRET_WORDS + r"[^A-Za-z0-9]*$"),
        "secret_before": has(before, _SECRET_WORDS),
        "assigned": has(before, r"[=:]\s*[\"']?$"),
        "quoted": has(before, "[\"']$") * has(after, "^[\"']"),
        "other_near": has(before, _OTHER_WORDS + r"[^A-Za-z]*(?:of the file )?[^A-Za-z]*$"),
        "url": has(before, r"(?i)https?://\S*$"),
        "path_config": has(path, r"(?i)(?:\.env|\.pem|config|credential|secret)"),
        "path_test": has(path, r"(?i)(?:test|example|sample|docs?/)"),
    }


def _once(value: Column) -> Column:
    """The value through a generator, so that it is not put into the lambdas that use it and computed there again."""
    return F.explode(F.array(value))


def _with_candidates(df: DataFrame, text: str, path: str | None) -> tuple[DataFrame, str]:
    """df with an array of candidates (null where there is none): value, gap (code points since the candidate before),
    f (features)."""
    name = free_name(df.columns, "_candidates")
    pieces, values = free_name([*df.columns, name], "_pieces"), free_name([*df.columns, name], "_values")
    whole = F.col(f"`{text}`").cast("string")
    where = F.coalesce(F.col(f"`{path}`").cast("string"), F.lit("")) if path else F.lit("")
    some = whole.rlike(CANDIDATE)
    split = df.withColumn(values, _once(F.when(some, F.regexp_extract_all(whole, F.lit(CANDIDATE), F.lit(0)))))
    split = split.withColumn(pieces, _once(F.when(F.col(values).isNotNull(), F.split(whole, CANDIDATE, -1))))
    around = F.transform(
        F.sequence(F.lit(1), F.size(values)),
        lambda i: F.struct(
            F.element_at(values, i).alias("value"),
            F.length(F.element_at(pieces, i)).alias("gap"),
            F.right(F.element_at(pieces, i), F.lit(NEAR)).alias("before"),
            F.left(F.element_at(pieces, i + 1), F.lit(NEAR)).alias("after"),
        ),
    )
    features = lambda c: F.array(*_features(c["value"], c["before"], c["after"], where).values())
    found = F.transform(around, lambda c: F.struct(c["value"].alias("value"), c["gap"].alias("gap"), features(c).alias("f")))
    return split.withColumn(name, _once(F.when(F.col(values).isNotNull(), found))).drop(pieces, values), name


class Forest:
    """A fitted random forest as nested tuples: (feature, threshold, left, right), or the share of secrets at a leaf."""

    def __init__(self, trees: list):
        self.trees = trees

    def score(self, f: Column) -> Column:
        """Mean over trees, for an array of features."""

        def column(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(node)
            feature, threshold, left, right = node
            return F.when(f[feature] <= F.lit(threshold), column(left)).otherwise(column(right))

        total = column(self.trees[0])
        for tree in self.trees[1:]:
            total = total + column(tree)
        return total / F.lit(float(len(self.trees)))


def _node(node):
    if node.getClass().getSimpleName() == "LeafNode":
        stats = list(node.impurityStats().stats())
        return float(stats[1]) / sum(stats)
    split = node.split()
    return (split.featureIndex(), float(split.threshold()), _node(node.leftChild()), _node(node.rightChild()))


def fitted(spark: SparkSession, findings: list[tuple[str, str, str, int]] | None = None, trees: int = 24, depth: int = 6, at_most: int = FINDINGS) -> Forest:
    """The forest of labelled findings (text before, candidate, text after, label), of which at most `at_most` are read.
    Findings whose candidate the pattern does not find are left out."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    rows = [(b + v + a, float(y), v) for b, v, a, y in (findings or labelled_findings())[:at_most]]
    table = spark.createDataFrame(rows, "text string, label double, wanted string").coalesce(1)
    found, name = _with_candidates(table, "text", None)
    mine = F.filter(F.col(name), lambda c: c["value"] == F.col("wanted"))
    ready = found.filter(F.size(mine) > 0).select("label", array_to_vector(F.get(mine, 0)["f"]).alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=2, featureSubsetStrategy="onethird", seed=8).fit(ready)
    return Forest([_node(t._call_java("rootNode")) for t in forest.trees])


@functools.lru_cache(4)
def standard_forest(spark: SparkSession) -> Forest:
    """The forest of the labelled findings given here, fitted once per session."""
    return fitted(spark)


def _scored(df: DataFrame, text: str, path: str | None, forest: Forest) -> tuple[DataFrame, str]:
    found, name = _with_candidates(df, text, path)
    scored = F.transform(F.col(name), lambda c: F.struct(c["value"].alias("value"), c["gap"].alias("gap"), forest.score(c["f"]).alias("score")))
    return found.withColumn(name, _once(scored)), name


def findings(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = "source", forest: Forest | None = None, least: float = 0.5) -> DataFrame:
    """A row per secret: id, text_key (xxhash64 of the text), start and end (code points), value, score."""
    scored, name = _scored(docs, text, path, forest or standard_forest(docs.sparkSession))
    rows = scored.filter(F.col(name).isNotNull()).select(
        F.col(f"`{id}`").alias("_id"), F.xxhash64(F.col(f"`{text}`").cast("string")).alias("text_key"), F.col(name).alias("_c")
    ).dropDuplicates(["_id", "text_key"])
    each = rows.select("_id", "text_key", F.posexplode("_c").alias("_n", "_x")).select("_id", "text_key", "_n", "_x.*")
    so_far = Window.partitionBy("_id", "text_key").orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(so_far))
    return placed.filter(F.col("score") >= least).select(
        F.col("_id").alias(id), "text_key", (F.col("end") - F.length("value")).alias("start"), "end", "value", F.round("score", 6).alias("score")
    )


def redacted(docs: DataFrame, text: str = "text", path: str | None = "source", forest: Forest | None = None, least: float = 0.5) -> DataFrame:
    """docs with each secret of the text replaced by MASK; other columns and rows as they are."""
    scored, name = _scored(docs, text, path, forest or standard_forest(docs.sparkSession))
    whole = F.col(f"`{text}`").cast("string")
    pieces = F.split(whole, CANDIDATE, -1)
    found = F.col(name)  # null or an array of this row
    parts = F.transform(
        pieces,
        lambda p, i: F.concat(
            p,
            F.when(i < F.size(found), F.when(F.get(found, i)["score"] >= least, F.lit(MASK)).otherwise(F.get(found, i)["value"])).otherwise(F.lit("")),
        ),
    )
    any_secret = F.exists(found, lambda c: c["score"] >= least)
    return scored.withColumn(text, F.when(any_secret, F.array_join(parts, "")).otherwise(whole)).select(*docs.columns)

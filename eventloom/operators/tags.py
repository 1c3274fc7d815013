"""Usage of emotion tags embedded in product texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.numbers import count_where, exact_sum, ratio
from eventloom.vocab import BASE_EMOTIONS, PRESET_TAGS, RATE_BANDS, TAG_PATTERN


def _tags(products: DataFrame, *columns: str) -> DataFrame:
    """One row per tag of a text: what stands before and after its `#`."""
    text = F.col("target_text")
    pattern = F.lit(TAG_PATTERN)
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(1)).alias("head"),
        F.regexp_extract_all(text, pattern, F.lit(2)).alias("body"),
    )
    return products.filter(text.contains("#")).select(*columns, F.inline(pairs))


def _is_emoji(head: Column) -> Column:
    """`[😨 #Fear:7]:` has a space before the `#`, `[surprise#Fear:2]:` has not."""
    return head.endswith(" ")


def tag_usage(
    products: DataFrame, emotions: Sequence[str] = BASE_EMOTIONS, presets: Sequence[str] = PRESET_TAGS
) -> DataFrame:
    """Per tag: distinct products with it, distinct downloaded ones and their ratio.

    Emoji tags go by the emotion after the `#`, text tags by the word before it. Only the listed ones
    count. A product counts once per tag and may have several.
    """
    emoji = _is_emoji(F.col("head"))
    tag = F.when(emoji, F.split_part("body", F.lit(":"), F.lit(1))).otherwise(F.col("head"))
    kind = F.when(emoji, "emoji").otherwise("text")
    return (
        _tags(products, "gen_product_id", "is_downloaded")
        .select("gen_product_id", "is_downloaded", kind.alias("kind"), tag.alias("tag"))
        .filter(
            ((F.col("kind") == "emoji") & F.col("tag").isin(*emotions))
            | ((F.col("kind") == "text") & F.col("tag").isin(*presets))
        )
        .groupBy("kind", "tag", "gen_product_id")
        .agg(F.max(F.coalesce("is_downloaded", F.lit(False))).alias("is_downloaded"))
        .groupBy("kind", "tag")
        .agg(F.count("gen_product_id").alias("usage"), F.count(F.when(F.col("is_downloaded"), F.col("gen_product_id"))).alias("downloaded"))
        .withColumn("download_rate", ratio(F.col("downloaded"), F.col("usage")))
    )


def tag_weights(products: DataFrame, presets: Sequence[str] = PRESET_TAGS) -> DataFrame:
    """Base emotions mixed into each text tag: occurrences, weight and share of the tag's weight.

    A part without a readable weight adds nothing to them and is counted as unreadable."""
    parts = (
        _tags(products)
        .filter(~_is_emoji(F.col("head")) & F.col("head").isin(*presets))
        .select(F.col("head").alias("tag"), F.explode(F.split("body", ";")).alias("part"))
        .select(
            "tag",
            F.trim(F.split_part("part", F.lit(":"), F.lit(1))).alias("emotion"),
            F.split_part("part", F.lit(":"), F.lit(2)).try_cast("double").alias("weight"),
        )
    )
    readable = F.abs("weight") < 1e37
    mixed = parts.groupBy("tag", "emotion").agg(
        count_where(readable).alias("occurrences"),
        exact_sum(F.when(readable, F.col("weight"))).alias("weight"),
        count_where(~F.coalesce(readable, F.lit(False))).alias("unreadable"),
    )
    totals = mixed.groupBy("tag").agg(exact_sum(F.col("weight")).alias("tag_weight"))
    return mixed.join(totals, "tag").select(
        "tag", "emotion", "occurrences", "weight", ratio(F.col("weight"), F.col("tag_weight")).alias("share"), "unreadable"
    )


def tag_ranking(usage: DataFrame, bands: Sequence[tuple[float, str]] = RATE_BANDS) -> DataFrame:
    """Tags by falling download rate, with the band of the rate in percent."""
    pct = F.col("download_rate") * 100.0
    band = F.lit("low")
    for least, name in sorted(bands):
        band = F.when(pct >= least, name).otherwise(band)
    return usage.withColumn("rate_band", band).orderBy(F.desc("download_rate"), "tag")

"""Silver rows to the enriched gold layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.topics import title_topics

LAYER = "gold"
SCHEMA_VERSION = 1

# Fixed values of the score and the summary text.
SCORE_BASE = 0.55
SCORE_BODY_CAP = 8000
SCORE_BODY_UNIT = 20000.0
SUMMARY_TITLE_CHARS = 120
SUMMARY_START = "[MOCK] Статья «"
SUMMARY_MIDDLE = "»; ~"
SUMMARY_END = " символов текста."


def body_length() -> Column:
    """Stored body length, or the length of the body where none is stored."""
    return F.coalesce("body_len", F.length("body"), F.lit(0)).cast("int")


def quality_score() -> Column:
    """0.55 to 0.95, growing with the body up to the cap."""
    capped = F.least(body_length(), F.lit(SCORE_BODY_CAP))
    return F.round(SCORE_BASE + capped / SCORE_BODY_UNIT, 4)


def summary() -> Column:
    """Template text with the start of the title and the body length."""
    shown = F.coalesce(F.substring("title", 1, SUMMARY_TITLE_CHARS), F.lit(""))
    size = body_length().cast("string")
    return F.concat(F.lit(SUMMARY_START), shown, F.lit(SUMMARY_MIDDLE), size, F.lit(SUMMARY_END))


def gold(silver: DataFrame) -> DataFrame:
    """All silver columns in place, with topics, score, summary and schema version added."""
    layer = F.lit(LAYER).alias("layer")
    kept = [layer if c == "layer" else F.col(c) for c in silver.columns]
    return silver.select(
        *kept,
        title_topics(F.col("title")).alias("mock_topics"),
        quality_score().alias("mock_quality_score"),
        summary().alias("mock_summary"),
        F.lit(SCHEMA_VERSION).alias("gold_schema_version"),
        *([] if "layer" in silver.columns else [layer]),
    )

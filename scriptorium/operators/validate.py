"""Record validation: raw lines to flagged records, a report and gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.iso8601 import is_iso_datetime
from scriptorium.functions.rounding import round_4
from scriptorium.functions.text import at_least, generated, strip
from scriptorium.sources.layers import json_object
from scriptorium.sources.schemas import BRONZE

# Fixed values of the record checks.
REQUIRED_KEYS = ("source", "url", "title", "content", "published_at", "process_date")
MIN_TITLE_CHARS = 5
MIN_CONTENT_CHARS = 20
URL_MARK = "arxiv"
MAX_INVALID_RATIO = 0.5

# Reject reasons, in the order of the checks.
REASONS = (
    "unparsable",
    "missing_key",
    "bad_title",
    "bad_content",
    "bad_url",
    "bad_published_at",
    "bad_authors",
)


class QualityGateError(RuntimeError):
    """A validated input is empty, wholly invalid, or mostly invalid."""


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _only_text(value: Column) -> Column:
    """The string in a variant, null for any other type."""
    return F.when(F.schema_of_variant(value) == "STRING", _text(value))


def _authors(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<string>")


def _authors_ok(value: Column) -> Column:
    """Absent, null, or a list of strings only."""
    # [] and [null] have the same variant schema, as have ["a"] and ["a", null].
    strings = F.schema_of_variant(value).isin("ARRAY<STRING>", "ARRAY<VOID>") & F.forall(
        _authors(value), lambda a: a.isNotNull()
    )
    return value.isNull() | F.is_variant_null(value) | F.coalesce(strings, F.lit(False))


def _typed(rec: Column) -> Column:
    """Typed fields of a parsed object with what the checks need to know of the raw types."""
    text_only = {"title", "content", "url", "published_at"}
    fields = [
        (_only_text if name in text_only else _authors if name == "authors" else _text)(rec[name])
        .alias(name)
        for name in BRONZE.names
    ]
    has_keys = reduce(lambda a, b: a & b, [rec[k].isNotNull() for k in REQUIRED_KEYS])
    return F.struct(
        *fields, has_keys.alias("has_keys"), _authors_ok(rec["authors"]).alias("authors_ok")
    )


def validate(lines: DataFrame) -> DataFrame:
    """Flag each line with ``reason``: the first check it fails, or null when the record is valid.

    Keeps the input columns and adds the typed fields of the record; where the input already has a
    column of that name, such as the day of a partitioned layer, the input's stays. The untouched line
    is the payload, so every original key of a valid record survives.
    """
    rec = F.col("rec")
    checks = (
        rec.isNotNull(),
        rec["has_keys"],
        at_least(strip(rec["title"]), MIN_TITLE_CHARS),
        at_least(strip(rec["content"]), MIN_CONTENT_CHARS),
        F.contains(F.lower(rec["url"]), F.lit(URL_MARK)),
        is_iso_datetime(rec["published_at"]),
        rec["authors_ok"],
    )
    reason = F.lit(None).cast("string")
    for name, passed in reversed(tuple(zip(REASONS, checks))):
        reason = F.when(~F.coalesce(passed, F.lit(False)), name).otherwise(reason)
    fields = [rec[name].alias(name) for name in BRONZE.names if name not in lines.columns]
    parsed = generated(json_object(F.col("line"), BRONZE.names, _typed)).alias("rec")
    return lines.select("*", parsed).select(*lines.columns, reason.alias("reason"), *fields)


def valid_records(validated: DataFrame) -> DataFrame:
    """Typed fields and payload of the valid records."""
    return validated.where(F.col("reason").isNull()).drop("reason")


def _ratio(invalid: Column, total: Column) -> Column:
    return F.when(total > 0, invalid / total)


def report_columns() -> list[Column]:
    """Counts of a validation report, as aggregates over validated rows."""
    total = F.count(F.lit(1))
    invalid = F.count("reason")
    return [
        total.alias("total_lines"),
        (total - invalid).alias("valid"),
        invalid.alias("invalid"),
    ]


def with_ratio(counts: DataFrame) -> DataFrame:
    """Add the rounded share of invalid lines to report counts."""
    ratio = _ratio(F.col("invalid"), F.col("total_lines"))
    return counts.withColumn("_ratio", ratio).withColumn("invalid_ratio", round_4(F.col("_ratio"))).drop("_ratio")


def validation_report(
    validated: DataFrame, raw_path: str = "", validated_path: str = ""
) -> DataFrame:
    """One row: paths, counts and the share of invalid lines, to four places."""
    return with_ratio(validated.agg(*report_columns())).select(
        F.lit(raw_path).alias("raw_path"), F.lit(validated_path).alias("validated_path"), "*"
    )


def reject_reasons(validated: DataFrame) -> DataFrame:
    """Number of invalid lines per first failing check."""
    return (
        validated.where(F.col("reason").isNotNull())
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def with_gates(counts: DataFrame) -> DataFrame:
    """Add ``failure`` to report counts: why such an input must not go on, or null.

    A share of exactly one half passes.
    """
    total, valid, invalid = F.col("total_lines"), F.col("valid"), F.col("invalid")
    return counts.withColumn(
        "failure",
        F.when(total == 0, "no lines")
        .when(valid == 0, "no valid records")
        .when(invalid > total * MAX_INVALID_RATIO, "too many invalid lines"),
    )


def check_gates(counts: DataFrame, source: str = "input") -> None:
    """Raise when the one row of report counts fails a gate."""
    row = with_gates(counts).first()
    if row["failure"]:
        raise QualityGateError(
            f"{row['failure']} in {source}: {row['invalid']} of {row['total_lines']} invalid"
        )

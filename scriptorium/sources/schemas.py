"""Explicit schemas of the layers.

JSON inference sorts columns, costs an extra job and coerces mixed types to string without a word, so
no reader here infers.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_STRINGS = ArrayType(StringType())


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


# One entry of an Atom feed. Only the parts a record needs are read.
FEED_ENTRY = _struct(
    id=StringType(),
    title=StringType(),
    summary=StringType(),
    published=StringType(),
    updated=StringType(),
    author=ArrayType(_struct(name=StringType())),
    category=ArrayType(_struct(_term=StringType())),
)

BRONZE = _struct(
    source=StringType(),
    url=StringType(),
    title=StringType(),
    content=StringType(),
    authors=_STRINGS,
    published_at=StringType(),
    updated_at=StringType(),
    process_date=StringType(),
    run_id=StringType(),
)

SILVER = _struct(
    url=StringType(),
    title=StringType(),
    body=StringType(),
    authors=_STRINGS,
    published_at=StringType(),
    process_date=StringType(),
    title_len=IntegerType(),
    body_len=IntegerType(),
    n_authors=IntegerType(),
    layer=StringType(),
)

GOLD = StructType(
    SILVER.fields
    + _struct(
        mock_topics=_STRINGS,
        mock_quality_score=DoubleType(),
        mock_summary=StringType(),
        gold_schema_version=IntegerType(),
    ).fields
)

MESSAGES = ArrayType(_struct(role=StringType(), content=StringType()))

TRAINING_ROW = _struct(
    messages=MESSAGES,
    text=StringType(),
    instruction=StringType(),
    input=StringType(),
    output=StringType(),
)

METRICS = _struct(
    train_loss=DoubleType(),
    max_steps=IntegerType(),
    n_samples=LongType(),
    model_name=StringType(),
    device=StringType(),
    dtype=StringType(),
    runtime_seconds=DoubleType(),
    jsonl=StringType(),
)

EVAL_REPORT = _struct(
    process_date=StringType(),
    mock=BooleanType(),
    train_loss=DoubleType(),
    perplexity_estimate=DoubleType(),
    metrics_source=StringType(),
    device=StringType(),
    model_name=StringType(),
    notes=StringType(),
)

# Columns a stage cannot do without.
BRONZE_REQUIRED = ("url", "title", "content", "published_at", "process_date")
SILVER_REQUIRED = ("title", "body", "body_len")

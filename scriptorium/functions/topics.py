"""Deterministic topic labels from the characters of a title."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the topic labels.
TOPICS = ("nlp", "deep-learning", "systems", "theory", "evaluation")
UNKNOWN_TOPIC = "unknown"
TITLE_CHARS = 80
SECOND_TOPIC_STEP = 2


def title_bucket(title: Column) -> Column:
    """Sum of the code points of the first characters of a title, modulo the number of topics."""
    chars = F.split(F.substring(title, 1, TITLE_CHARS), "")
    return F.aggregate(chars, F.lit(0), lambda total, c: total + F.ascii(c)) % len(TOPICS)


def title_topics(title: Column) -> Column:
    """``array<string>`` of two topics, or of the unknown topic for a null or empty title."""
    # One literal pair per bucket: the code-point sum is worked out once per row.
    pairs = F.array(
        *[
            F.array(F.lit(topic), F.lit(TOPICS[(i + SECOND_TOPIC_STEP) % len(TOPICS)]))
            for i, topic in enumerate(TOPICS)
        ]
    )
    return F.when(
        F.coalesce(title, F.lit("")) == "", F.array(F.lit(UNKNOWN_TOPIC))
    ).otherwise(F.get(pairs, title_bucket(title)))

"""Gold rows to prompt and answer messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.text import at_least, strip, strip_or_empty
from scriptorium.sources.schemas import MESSAGES

# Character offsets and the prompt text.
MIN_BODY_CHARS = 160
HEAD_CHARS = 1400
TAIL_CHARS = 1400
FALLBACK_START = 800
FALLBACK_CHARS = 700
MIN_TAIL_CHARS = 50
PROMPT_START = (
    "Given the arXiv paper title and the beginning of the abstract, "
    "continue the abstract in English.\n\nTitle:\n"
)
PROMPT_MIDDLE = "\n\nAbstract (prefix):\n"
PROMPT_END = "\n"


def prompt(title: Column, head: Column) -> Column:
    return F.concat(F.lit(PROMPT_START), title, F.lit(PROMPT_MIDDLE), head, F.lit(PROMPT_END))


def split_body(gold: DataFrame) -> DataFrame:
    """Rows long enough to split, with ``head``, ``tail`` and ``fallback`` added.

    The tail follows the head. A body without 50 characters after the head gives characters 800 to
    1500 instead, which lie in the head or just past it; such rows carry ``fallback``. A tail below 50
    characters drops the row, so the body length alone decides: 850 is the least, 1450 the least
    without fallback, and the stated minimum of 160 never binds.
    """
    shortest = max(MIN_BODY_CHARS, FALLBACK_START + MIN_TAIL_CHARS)
    after_head = F.substring("body", HEAD_CHARS + 1, TAIL_CHARS)
    inside_head = F.substring("body", FALLBACK_START + 1, FALLBACK_CHARS)
    return (
        gold.withColumn("body", strip_or_empty(F.col("body")))
        .where(at_least(F.col("body"), shortest))
        .withColumn("fallback", ~at_least(F.col("body"), HEAD_CHARS + MIN_TAIL_CHARS))
        .withColumn("head", F.substring("body", 1, HEAD_CHARS))
        .withColumn("tail", F.when(F.col("fallback"), inside_head).otherwise(after_head))
    )


def training_messages(gold: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``messages`` of a user turn with the prompt and an assistant turn with the continuation.

    ``keep`` names gold columns to carry along.
    """
    question = prompt(strip_or_empty(F.col("title")), F.col("head"))
    turns = F.array(
        F.struct(F.lit("user").alias("role"), question.alias("content")),
        F.struct(F.lit("assistant").alias("role"), strip(F.col("tail")).alias("content")),
    )
    return split_body(gold).select(*keep, "fallback", turns.cast(MESSAGES).alias("messages"))

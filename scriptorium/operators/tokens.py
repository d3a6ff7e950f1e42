"""Text to token ids, truncated."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

# Executors need not have this package: its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_TOKENS = 512

# Takes a batch of texts and the token limit, returns one list or int32 array of ids per text.
BatchTokenizer = Callable[[Sequence[str], int], Sequence[Sequence[int] | np.ndarray]]


def tokenize(
    texts: DataFrame,
    load: Callable[[], BatchTokenizer],
    max_length: int = MAX_TOKENS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``input_ids`` and ``attention_mask`` per text, without padding; the text is dropped.

    ``load`` builds the tokenizer, once per task. The vocabulary is the caller's: the package has none.
    """
    narrow = texts.select(*keep, "text")
    fields = [narrow.schema[c] for c in keep]
    schema = StructType(fields + [StructField("input_ids", ArrayType(IntegerType()))])
    kept = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load()
        for batch in batches:
            ids = encode(batch.column("text").to_pylist(), max_length)
            column = pa.array([row[:max_length] for row in ids], pa.list_(pa.int32()))
            yield pa.record_batch(
                [*(batch.column(c) for c in kept), column], names=[*kept, "input_ids"]
            )

    ids = narrow.mapInArrow(run, schema)
    return ids.withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))


def utf8_bytes() -> BatchTokenizer:
    """Byte tokenizer: each id is a byte of the UTF-8 text."""

    def encode(texts: Sequence[str], limit: int) -> list[np.ndarray]:
        return [np.frombuffer(t.encode()[:limit], dtype=np.uint8).astype(np.int32) for t in texts]

    return encode


def word_pieces(text: Column, max_length: int = MAX_TOKENS) -> Column:
    """First ``max_length`` runs of ASCII letters and digits, or single other visible characters."""
    return F.slice(
        F.regexp_extract_all(text, F.lit("[A-Za-z0-9]+|[^A-Za-z0-9\\s]"), F.lit(0)), 1, max_length
    )

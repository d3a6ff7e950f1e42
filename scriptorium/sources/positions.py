"""Positions that hold over a whole input: line numbers in files, and ranks in an order.

Both are a number within a piece that one task holds (a block of a file, a range of the order) plus the rows of the
pieces before it. Only the counts of the pieces are put in order, never the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.session import shared_dir
from scriptorium.sources.layers import stripped_lines

#: Rows of a range of the order, about.
RANGE_ROWS = 1_000_000
_PART, _AT = "__part", "__at"


def numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``file``, ``line_number`` (from 1, blank lines counted) and ``line`` of the non-blank lines of text files.

    A task reads the lines of a block in their order, so their places in the task count them. Lines and places are
    written once and read from there: how files are cut into blocks can differ from one read to the next. One row a
    block is summed up and joined back, which Spark broadcasts while the table of blocks is small.
    """
    kept = shared_dir(spark, "lines")
    block = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.text(path)
    lines.select(*block, F.monotonically_increasing_id().alias(_AT), F.col("value").alias("line")).write.parquet(kept)
    placed = spark.read.schema(f"file string, block long, {_AT} long, line string").parquet(kept)
    blocks = placed.groupBy("file", "block").agg(F.min(_AT).alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("passed"))
    number = F.col(_AT) - F.col("first") + F.col("passed") + 1
    return stripped_lines(placed.join(blocks, ["file", "block"]).select("file", number.alias("line_number"), "line"))


class Ranked:
    """Rows stored by ranges of an order, so that any stretch of it is read from its own ranges.

    ``order`` has to tell rows apart, or rows that it does not tell apart may come in any order among themselves. The
    rows of a range fit a task, unless more than that many are equal in ``order``.
    """

    def __init__(self, rows: DataFrame, order: Sequence[Column], path: str, range_rows: int = RANGE_ROWS):
        self.spark, self.order, self.path = rows.sparkSession, list(order), path
        self.schema = rows.schema
        ranges = max(1, -(-rows.count() // range_rows))
        parted = rows.repartitionByRange(ranges, *self.order).withColumn(_PART, F.spark_partition_id())
        parted.write.partitionBy(_PART).parquet(path)
        # a row a range
        counts = sorted(self._stored().groupBy(_PART).count().collect())
        self.parts = [part for part, _ in counts]
        self.ends = list(accumulate(n for _, n in counts))

    def __len__(self) -> int:
        return self.ends[-1] if self.ends else 0

    def _stored(self) -> DataFrame:
        names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        return self.spark.read.schema(f"{names}, {_PART} int").parquet(self.path)

    def stretch(self, start: int, size: int) -> DataFrame:
        """``size`` rows of the order from ``start`` on; only the ranges that hold them are read."""
        begins = [0, *self.ends[:-1]] if self.ends else []
        held = [i for i, (a, b) in enumerate(zip(begins, self.ends)) if a < start + size and start < b]
        skipped = start - begins[held[0]] if held else 0
        rows = self._stored().where(F.col(_PART).isin([self.parts[i] for i in held]))
        return rows.orderBy(*self.order).offset(skipped).limit(size).drop(_PART)

    def ranks(self, name: str = "rank") -> DataFrame:
        """All rows with their place in the order, from 0; each range is numbered by a task of its own."""
        within = F.row_number().over(Window.partitionBy(_PART).orderBy(*self.order))
        begins = [(p, e) for p, e in zip(self.parts, [0, *self.ends])]
        passed = self.spark.createDataFrame(begins, f"{_PART} int, {_AT} long")
        return self._stored().join(passed, _PART).withColumn(name, within + F.col(_AT) - 1).drop(_PART, _AT)

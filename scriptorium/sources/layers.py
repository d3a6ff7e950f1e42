"""Reading and writing the layers, with the checks around each stage."""

from __future__ import annotations

import hashlib
import itertools
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scriptorium.functions.text import generated, is_blank, once, strip
from scriptorium.session import exists
from scriptorium.sources.schemas import MESSAGES, TRAINING_ROW

PARTITION = "process_date"

# The JSON reader's own bounds would turn a record with a very long text into nulls.
JSON_OPTIONS = {"maxStringLen": str(2**31 - 1), "maxNumLen": str(2**31 - 1)}

#: Formats of plain lines, and the level at which they are compressed.
LINES = ("text", "json")
FAST = {"zlib.compress.level": "BEST_SPEED"}

_CHECK_KEY = "__line_hash"


STAGE_META = "rows bigint, engine string, spark_app string, input string, output string"


class ContractError(ValueError):
    """A stage's input lacks a required column."""


class EmptyStageError(RuntimeError):
    """A stage wrote no rows."""


@dataclass(frozen=True)
class StageMeta:
    rows: int
    engine: str
    spark_app: str
    input: str
    output: str


def raw_lines(
    spark: SparkSession, path: str | Sequence[str], days: Sequence[str] | None = None
) -> DataFrame:
    """Stripped, non-blank lines of text files, in a column ``line``.

    ``days`` reads those days of a layer root and keeps the day of each line.
    """
    if days is None:
        return stripped_lines(spark.read.text(path).select(F.col("value").alias("line")))
    reader = spark.read.schema(f"value string, {PARTITION} string").format("text")
    lines = _load_days(spark, reader, path, days)
    return stripped_lines(lines.select(F.col("value").alias("line"), PARTITION))


def _load_days(
    spark: SparkSession, reader: DataFrameReader, path: str | Sequence[str], days: Sequence[str]
) -> DataFrame:
    """Rows of some days of a layer root; of the other days not even the files are listed."""
    if isinstance(path, str):
        folders = [f"{path.rstrip('/')}/{PARTITION}={d}" for d in days]
        there = [f for f in folders if exists(spark, f)]
        if there:
            reader, path = reader.option("basePath", path), there
    return reader.load(path).where(F.col(PARTITION).isin(list(days)))


def stripped_lines(lines: DataFrame) -> DataFrame:
    """Strip column ``line`` and drop blank lines."""
    return lines.where(~is_blank(F.col("line"))).withColumn("line", strip(F.col("line")))


def read_layer(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    required: Iterable[str] = (),
    days: Sequence[str] | None = None,
    strict: bool = False,
    fmt: str = "json",
) -> DataFrame:
    """Rows of a layer under an explicit schema; ``days`` prunes partitions of a layer root.

    A line that is not JSON gives a row of nulls, or with ``strict`` stops the read.
    """
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "json":
        reader = reader.options(mode="FAILFAST" if strict else "PERMISSIVE", **JSON_OPTIONS)
    rows = reader.load(path) if days is None else _load_days(spark, reader, path, days)

    def lines() -> DataFrame:
        texts = spark.read.schema(f"value string, {PARTITION} string").format("text")
        return spark.read.text(path) if days is None else _load_days(spark, texts, path, days)

    check_contract(rows, required, lines if fmt == "json" else None)
    return rows


def check_contract(
    rows: DataFrame, required: Iterable[str], lines: Callable[[], DataFrame] | None = None
) -> None:
    """Raise when a required column is not there, or is there without a single value.

    With ``lines``, which reads the JSON lines (``value``) of the rows, a column without values is there if a line has its
    key. The usual case ends at the first complete row; only a suspect input is read to the end.
    """
    required = tuple(required)
    if not required:
        return
    missing = [c for c in required if c not in rows.columns]
    if not missing:
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
        if not rows.where(complete).isEmpty():
            return
        counts = rows.agg(*[F.count(c).alias(c) for c in required]).first()
        missing = [c for c in required if counts[c] == 0]
        if missing and lines is not None:
            keys = F.json_object_keys("value")
            held = lines().agg(*[F.max(F.array_contains(keys, c)).alias(c) for c in missing]).first()
            missing = [c for c in missing if not held[c]]
    if missing:
        raise ContractError(f"missing columns {missing}, have {rows.columns}")


class DayCounts:
    """Rows per day and class, taken in one metric of an ``Observation`` for any number of days.

    A histogram with as many bins as there are days and classes holds each of their numbers in a bin of its
    own, so it is exact; rows of other days stay out of it. Where two tasks' bins of a number meet, their mean is taken,
    so numbers are kept far below what a double holds and read by rounding.
    """

    def __init__(self, days: Sequence[str], classes: int = 1):
        self.days, self.classes = list(dict.fromkeys(days)), classes
        salts = (str(n) for n in itertools.count())
        self.salt = next(s for s in salts if len({self._code(s, d) for d in self.days}) == len(self.days))

    @staticmethod
    def _code(salt: str, day: str) -> int:
        return int(hashlib.md5(f"{salt}{day}".encode()).hexdigest()[:8], 16)

    def metric(self, day: Column, of: Column | None = None) -> Column:
        """The counts of ``day`` and of ``of``, a number below ``classes``."""
        number = F.conv(F.substring(F.md5(F.concat(F.lit(self.salt), day)), 1, 8), 16, 10).cast("double")
        coded = number * self.classes + (F.lit(0) if of is None else of)
        known = F.when(day.isin(self.days), coded) if self.days else F.lit(None).cast("double")
        return F.histogram_numeric(known, F.lit(max(2, len(self.days) * self.classes)))

    def read(self, bins: Sequence | None) -> dict[str, list[int]]:
        """Counts of each class, by day."""
        found = Counter()
        for b in bins or ():
            found[round(b["x"])] += round(b["y"])
        codes = {d: self._code(self.salt, d) * self.classes for d in self.days}
        return {d: [found[c + i] for i in range(self.classes)] for d, c in codes.items()}


def write_layer(
    rows: DataFrame,
    root: str,
    day: str | None = None,
    days: Sequence[str] = (),
    fmt: str = "json",
    rows_per_file: int | None = None,
    rebalance: bool = False,
    per_day: dict[str, int] | None = None,
    compression: str | None = None,
) -> int:
    """Write days of a layer, replacing those days only, and return the number of rows written.

    Rows are counted while they are written. ``day`` puts all rows under one day; without it each row
    goes to its own ``process_date``. ``days`` names the days the rows stand for: one that turns out to
    have no rows is emptied, where it would keep its earlier rows otherwise. ``rebalance`` evens out
    file sizes by a shuffle that splits a large day over tasks; use it when many days are written at
    once from input that is not laid out by day. ``per_day`` receives the rows of each of ``days``.
    ``compression`` is the codec of text and JSON files; readers tell it by the files' names.
    """
    if day is not None:
        rows = rows.withColumn(PARTITION, F.lit(day))
    if rebalance:
        rows = rows.hint("rebalance", PARTITION)
    written, each = Observation(), DayCounts(days)
    counted = rows.observe(
        written,
        F.count(F.lit(1)).alias("rows"),
        F.collect_set(PARTITION).alias("days"),
        *([each.metric(F.col(PARTITION)).alias("each")] if per_day is not None else []),
    )
    writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if compression and fmt in LINES:
        writer = writer.options(compression=compression, **FAST)
    writer.partitionBy(PARTITION).format(fmt).save(root)
    for empty in sorted(set(days) - set(written.get["days"])):
        nothing = rows.sparkSession.createDataFrame([], rows.drop(PARTITION).schema)
        nothing.write.mode("overwrite").format(fmt).save(f"{root}/{PARTITION}={empty}")
    if per_day is not None:
        per_day.update({d: n for d, [n] in each.read(written.get["each"]).items()})
    return written.get["rows"]


def require_rows(rows: int, stage: str) -> int:
    """Stop a run whose stage wrote nothing."""
    if rows == 0:
        raise EmptyStageError(f"{stage}: no rows written")
    return rows


def stage_meta(spark: SparkSession, meta: StageMeta) -> DataFrame:
    """One-row record of a finished stage."""
    return spark.createDataFrame(
        [(meta.rows, meta.engine, meta.spark_app, meta.input, meta.output)], STAGE_META
    )


def write_record(record: DataFrame, path: str) -> None:
    """Write a one-row report, replacing an earlier one. Nulls are kept as JSON nulls."""
    record.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def json_object(line: Column, keys: Sequence[str], use: Callable[[Column], Column]) -> Column:
    """``use`` of the wanted keys, as variants, of the JSON object in a line; null if it is not one object.

    A JSON reader stops after the first value, so ``{..}}`` or ``{..} x`` would pass. The line is
    therefore parsed as the first element of an array whose second element holds the line's hash: what
    comes after the first object breaks the array, or leaves more or other than these two elements.
    """
    fields = ", ".join(f"`{key}` variant" for key in (*keys, _CHECK_KEY))
    check = F.xxhash64(line).cast("string")
    wrapped = F.concat(F.lit("["), line, F.lit(f',{{"{_CHECK_KEY}":'), check, F.lit("}]"))
    options = {"allowSingleQuotes": "false", **JSON_OPTIONS}

    def used(elements: Column) -> Column:
        first, second = F.get(elements, F.lit(0)), F.get(elements, F.lit(1))
        found = F.try_variant_get(second[_CHECK_KEY], "$", "string")
        whole = (F.size(elements) == 2) & first.isNotNull() & (found == check)
        return F.when(whole, use(first))

    return once(F.from_json(wrapped, f"array<struct<{fields}>>", options), used)


def _training_fields(row: Column) -> Column:
    def text(name: str) -> Column:
        return F.try_variant_get(row[name], "$", "string")

    def kind(name: str) -> Column:
        return F.schema_of_variant(row[name])

    def spelled(name: str) -> Column:
        return (
            F.when(F.is_variant_null(row[name]), "None")
            .when(kind(name) == "BOOLEAN", F.initcap(text(name)))
            .otherwise(text(name))
        )

    nothing = (kind("text") != "STRING") & text("text").isin("false", "0", "0.0", "[]", "{}")
    plain = F.when(~F.is_variant_null(row["text"]) & ~nothing, spelled("text"))
    messages = F.try_variant_get(row["messages"], "$", MESSAGES.simpleString())
    loose = [spelled(name).alias(name) for name in ("instruction", "input", "output")]
    return F.struct(messages.alias("messages"), plain.alias("text"), *loose)


def training_rows_from_lines(lines: DataFrame) -> DataFrame:
    """Training rows from JSON lines in column ``line``; other columns are kept.

    A line that is not a JSON object stops the read. ``messages`` that are not a list, and an
    empty ``text`` of any type, count as absent. ``instruction`` is null only where the key is absent:
    JSON null, true and false there, and in ``input`` and ``output``, become the words None, True and
    False.
    """
    line = F.col("line")
    row = json_object(line, TRAINING_ROW.names, _training_fields)
    broken = F.raise_error(F.concat(F.lit("MALFORMED training row: "), line))
    kept = [c for c in lines.columns if c != "line"]
    return lines.select(*kept, generated(F.coalesce(row, broken)).alias("row")).select(
        *kept, "row.*"
    )


def read_training_rows(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Training rows of JSON-lines files; a line that is not JSON stops the read."""
    return training_rows_from_lines(raw_lines(spark, path))

"""Incremental runs: a stream over the states of a landing folder brings changed days up to date.

A state is the listing (path, time, size, day) of all landed files. Each run that finds another state than the last takes
it down and lands its number, one small file; a stream with a checkpoint reads these numbers, a batch each, and works out
the days in which a state differs from the one before. So what a batch has to do is fixed before its work begins,
and a run that dies anywhere is taken up again: one that dies after its work, but before the stream has taken that
down, does exactly the same days again.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.plans.daily import LAYERS, Layout, RunResult, clear_days, process_days
from scriptorium.plans.publication import new_run, publish_run
from scriptorium.session import remove
from scriptorium.sources.layers import PARTITION

#: What tells one state of a landed file from another, and its day.
LANDED = f"path string, modificationTime timestamp, length long, {PARTITION} string"
_NUMBER = "number long"


def landed_files(spark: SparkSession, landing: str) -> DataFrame:
    """Path, time, size and day of each file under ``landing/process_date=<day>/``; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
    day = F.regexp_extract("path", f"/{PARTITION}=([^/]+)/[^/]*$", 1)
    return files.select("path", "modificationTime", "length", day.alias(PARTITION))


class States:
    """The states of a landing folder that were taken down under ``checkpoint``, numbered from 1."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.checkpoint = spark, checkpoint
        self.numbers = f"{checkpoint}/states"
        # Writing no rows makes the folder of a first run.
        spark.createDataFrame([], _NUMBER).write.mode("append").parquet(self.numbers)

    def path(self, number: int) -> str:
        return f"{self.checkpoint}/listings/{number}"

    def state(self, number: int) -> DataFrame:
        """Listing of a number; 0 is the state before any file."""
        if number == 0:
            return self.spark.createDataFrame([], LANDED)
        return self.spark.read.schema(LANDED).parquet(self.path(number))

    def changed_days(self, number: int) -> dict[str, bool]:
        """The days in which a state differs from the one before, and whether they still have files."""
        now, before = self.state(number), self.state(number - 1)
        changed = now.subtract(before).union(before.subtract(now)).select(PARTITION).distinct()
        there = now.select(PARTITION).distinct().withColumn("there", F.lit(True))
        # One row per calendar day that changed.
        rows = changed.join(there, PARTITION, "left").orderBy(PARTITION).collect()
        return {r[PARTITION]: bool(r["there"]) for r in rows}

    def take(self, landing: str) -> None:
        """Take the present state down, if it differs from the last; its number makes it count."""
        last = self.spark.read.schema(_NUMBER).parquet(self.numbers).agg(F.max("number")).first()[0] or 0
        landed_files(self.spark, landing).write.mode("overwrite").parquet(self.path(last + 1))
        days = self.changed_days(last + 1)
        if "" in days:
            raise ValueError(f"files under {landing} outside of a day")
        if days:
            number = self.spark.createDataFrame([(last + 1,)], _NUMBER)
            number.coalesce(1).write.mode("append").parquet(self.numbers)


def run_incremental(
    spark: SparkSession, landing: str, root: str, checkpoint: str, fmt: str = "json", at_once: bool = False
) -> RunResult | None:
    """Bring every day whose landed files changed up to date; None if there is none.

    A file counts as changed when its time or size did, so a day landed again under the same name is
    taken, and one with an old time as well. Each changed day is worked out once, from all its files, and
    replaces its earlier result; a day without files any more is emptied in every layer. A file that changes
    meanwhile is taken by the next run; one that vanishes meanwhile stops the run. One run at a time may use a ``checkpoint``,
    a folder that all executors share; it keeps the last two listings.

    ``at_once`` writes each state's days to folders of their own and publishes all layers together; readers then use
    :func:`scriptorium.plans.publication.read_published`.
    """
    states = States(spark, checkpoint)
    states.take(landing)
    done, failures = RunResult(), []
    worked: list[int] = []

    def work(batch: DataFrame, _: int) -> None:
        try:
            for number in sorted(r["number"] for r in batch.collect()):
                _bring_up(spark, states, number, landing, new_run(root, fmt) if at_once else Layout(root, fmt), done)
                worked.append(number)
        except BaseException as error:
            failures.append(error)
            raise

    numbers = spark.readStream.schema(_NUMBER).option("maxFilesPerTrigger", 1).parquet(states.numbers)
    stream = numbers.writeStream.foreachBatch(work).option("checkpointLocation", f"{checkpoint}/stream")
    try:
        stream.trigger(availableNow=True).start().awaitTermination()
    except StreamingQueryException:
        if failures:
            raise failures[0]
        raise
    return done if worked else None


def _bring_up(
    spark: SparkSession, states: States, number: int, landing: str, layout: Layout, done: RunResult
) -> None:
    """Do the days of a state, add to ``done``, and forget the state that no batch can ask for any more."""
    days = states.changed_days(number)
    gone, present = ([d for d, there in days.items() if there == wanted] for wanted in (False, True))
    if not layout.run:
        clear_days(spark, layout, gone)
    if present:
        result = process_days(spark, layout, present, raw=landing)
        for stage, rows in result.rows.items():
            done.rows[stage] = done.rows.get(stage, 0) + rows
        for mine, more in ((done.stopped, result.stopped), (done.rejected, result.rejected)):
            for day in present:
                mine.pop(day, None)
            mine.update(more)
    if layout.run:
        made = {d: {n: layout.day(n, d) for n in LAYERS[1:]} for d in present if d not in done.stopped}
        for day, artifacts in made.items():
            artifacts["bronze_raw"] = f"{landing}/{PARTITION}={day}"
        publish_run(spark, layout, f"state-{number}", made, removed=gone)
    remove(spark, states.path(number - 2))

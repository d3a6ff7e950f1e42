"""Tables in the shared folder: they cut lineage, can be read again, and have a size that Spark knows."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.session import discard, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Bytes of an Arrow batch at most.
BATCH_BYTES = 8_000_000


def small_batches(spark: SparkSession) -> None:
    """Have Spark cut Arrow batches by bytes, so that long texts do not add up in the executors' memory."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(key).lower().removesuffix("b")
    if not held.isdigit() or int(held) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


#: Whether Spark deletes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries within leave no shuffle files, which stay else until the driver happens to collect its garbage."""
    held = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if held is None else spark.conf.set(CLEANUP, held)


def settle(rows: DataFrame, name: str) -> DataFrame:
    """Write the rows to a new table in the shared folder and read them from there.

    The file sizes are known to the planner, so it broadcasts such a table only if it is small. What was shuffled for it
    is dropped.
    """
    path = shared_dir(rows.sparkSession, name)
    with shuffles_dropped(rows.sparkSession):
        rows.write.parquet(path)
    found = rows.sparkSession.read.schema(rows.schema).parquet(path)
    found.settled_at = path
    return found


def drop(*tables: DataFrame) -> None:
    """Delete settled tables that nothing reads any more."""
    for rows in tables:
        discard(rows.sparkSession, rows.settled_at)


#: Rows of a sample that a task writes. Every file that a task writes to a local disk starts processes.
SAMPLE_ROWS = 2_000


def sample_tasks(sample: int) -> int:
    """Tasks that write a sample of at most so many rows, whatever the number of shuffle partitions."""
    return max(1, sample // SAMPLE_ROWS)


#: Parts into which the rows that ask for one node are dealt.
SEATS = 256


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): the smallest node that each node of the undirected edges (a, b) is linked with.

    Every round hangs each node on the smallest root seen from its neighbours and then on that root's
    own root, until nothing changes; a round joins and groups on the node, and its result is written.
    Many rows may ask for one node (the hub of a star, the root of a large component). They ask from ``SEATS`` seats:
    the distinct (node, seat), found with map-side combining, fetch the answer, and the rows join their seat.
    """
    seat = lambda c: F.pmod(F.xxhash64(c), F.lit(SEATS)).alias("seat")
    turned = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = edges.filter("a <> b").select(F.explode(turned).alias("edge")).select("edge.a", "edge.b")
    links = settle(both.distinct().select("a", "b", seat("a")), f"{name}-links")
    asked = settle(links.select("b", "seat").distinct(), f"{name}-seats")
    roots = links.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
    held = settle(roots, f"{name}-roots")
    roots = held
    while True:
        told = asked.join(roots.withColumnRenamed("node", "b"), "b")
        near = links.join(told, ["b", "seat"]).groupBy("a").agg(F.min("root").alias("seen"))
        hung = roots.join(near, F.col("node") == F.col("a")).select("node", "root", F.least("root", "seen").alias("next"))
        # the old root learns of the smaller one as well, so that whole trees move at once
        moved = hung.select("node", "next").union(hung.select(F.col("root").alias("node"), "next"))
        best = settle(moved.groupBy("node").agg(F.min("next").alias("next")), f"{name}-best")
        placed = roots.join(best, "node").select("node", "root", "next", seat("node"))
        up = best.select(F.col("node").alias("next"), F.col("next").alias("top"))
        tops = best.select("next", seat("node")).distinct().join(up, "next")
        step = placed.join(tops, ["next", "seat"], "left")
        after = step.select("node", F.least("next", "top").alias("root"), (F.least("next", "top") < F.col("root")).alias("changed"))
        after = settle(after, f"{name}-roots")
        drop(best, held)
        held, roots = after, after.select("node", "root")
        if after.filter("changed").isEmpty():
            drop(links, asked)
            return roots

"""Sharding by extendible hashing, in DataFrame operations only: shards of at most a given number of bytes.

The directory is indexed by leading bits of a 60-bit hash of id and text. Bytes are summed once per fine prefix, a few bits
deeper than an even split needs, and from these for every shorter prefix; a bucket is the shortest prefix whose
rows fit the limit, so only oversized buckets have been split on another bit. Where a fine prefix is still too large, its rows
alone go on with more bits. Rows with the same hash (equal rows) cannot be told apart by bits; if they exceed the limit
together they are numbered, by their place within and among input partitions, and cut by number.

:func:`assign_shards` shuffles ids, hashes and sizes only; :func:`write_shards` moves the rows and writes the shards. A bucket
is a string of its bits, the empty one holding everything.

Defined cases: a null text has no bytes and hashes like an empty one, a null doc_id like the word ``null``. A row larger
than the limit is a shard of its own (one per row). An empty table has no shards. Other columns are not used for the
assignment, and are kept by :func:`write_shards`.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from scriptorium.llm.store import settle

LIMIT = 128_000_000
BITS = 60
#: Bits of a fine prefix beyond an even split, and of every further round.
SLACK, MORE = 6, 8
#: Prefixes of a task that writes tables about them. Every file that a task writes to a local disk starts a process.
TASK_PREFIXES = 16_384


def _prefix(depth: int):
    return F.shiftright("hash", BITS - depth)


def _measures() -> list:
    """n_bytes and hash of a row."""
    text = F.coalesce("text", F.lit(""))
    spelled = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(text))
    return [
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.conv(F.substring(F.md5(spelled), 1, BITS // 4), 16, 10).cast("long").alias("hash"),
    ]


def _tasks(depth: int) -> int:
    """Tasks for a table with at most a row for each prefix of ``depth`` bits."""
    return max(4, min(1 << depth, 1 << 30) // TASK_PREFIXES)


def _buckets(rows: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """The directory (depth, prefix, bucket_bytes), a row for each bucket, and the bits of the first round's fine prefixes.

    bucket_bytes is null where equal rows exceed the limit; each row has the prefix of exactly one bucket. Sums are grouped
    only and meet in no join: a file of prefixes is small beside the rows that come of it, and Spark would broadcast them all.
    """
    total = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    known, rest, least = [], rows, 0
    first = depth = min(BITS, max(0, math.ceil(math.log2(max(1, total) / limit))) + SLACK)
    while True:
        fine = rest.groupBy(_prefix(depth).alias("fine")).agg(
            F.sum("n_bytes").alias("n_bytes"), (F.min("hash") == F.max("hash")).alias("alike")
        )
        fine = settle(fine.coalesce(_tasks(depth)), "fine")
        lower = F.explode(F.sequence(F.lit(least), F.lit(depth)))
        above = fine.select("fine", "n_bytes", lower.alias("depth")).withColumn(
            "prefix", F.expr(f"shiftright(fine, {depth} - depth)")
        )
        sizes = above.groupBy("depth", "prefix").agg(F.sum("n_bytes").alias("bucket_bytes"))
        # the two halves of a prefix meet: one that fits is a bucket unless both fit together
        halves = sizes.groupBy((F.col("depth") - 1).alias("up"), F.shiftright("prefix", 1).alias("both")).agg(
            F.sum("bucket_bytes").alias("whole"), F.collect_list(F.struct("depth", "prefix", "bucket_bytes")).alias("half")
        )
        shortest = (F.col("whole") > limit) | (F.col("b.depth") == least)
        buckets = halves.select("whole", F.explode("half").alias("b")).filter((F.col("b.bucket_bytes") <= limit) & shortest).select("b.*")
        # beyond the last bit, or with one hash only, bits cannot help
        stuck = (F.col("n_bytes") > limit) & (F.col("alike") | F.lit(depth >= BITS))
        alike = fine.filter(stuck).select(
            F.lit(depth).alias("depth"), F.col("fine").alias("prefix"), F.lit(None).cast("long").alias("bucket_bytes")
        )
        known.append(settle(buckets.union(alike).coalesce(_tasks(depth)), "buckets"))
        large = settle(fine.filter((F.col("n_bytes") > limit) & ~stuck).select("fine").coalesce(_tasks(depth)), "large")
        if depth >= BITS or large.isEmpty():
            break
        rest = rest.join(large, _prefix(depth) == F.col("fine"), "left_semi")
        least, depth = depth + 1, min(BITS, depth + MORE)

    return settle(reduce(DataFrame.union, known).coalesce(1), "directory"), first


def _placed(rows: DataFrame, directory: DataFrame) -> DataFrame:
    """The rows with depth, prefix and bucket_bytes of their bucket."""
    # the directory has a row for each shard, small beside the texts; buckets are looked up depth by depth
    rows = rows.withColumn("bucket", F.lit(None).cast(directory.schema))
    others = [c for c in rows.columns if c != "bucket"]
    for depth in sorted(r["depth"] for r in directory.select("depth").distinct().collect()):
        held = directory.filter(F.col("depth") == depth).select(F.col("prefix").alias("at"), F.struct(*directory.columns).alias("b"))
        rows = rows.join(held, _prefix(depth) == F.col("at"), "left")
        rows = rows.select(*others, F.coalesce("bucket", "b").alias("bucket"))
    return rows.select(*others, "bucket.*")


def _copies(over: DataFrame, limit: int) -> DataFrame:
    """Equal rows (place, hash, n_bytes, …) with ``copy``, cut by their number so that none exceeds the limit."""
    over = over.withColumn("part", F.shiftright("place", 33))
    counts = over.groupBy("hash", "part").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("hash").orderBy("part")) - F.col("n"))
    number = F.col("before") + F.row_number().over(Window.partitionBy("hash", "part").orderBy("place")) - 1
    over = over.join(before.drop("n"), ["hash", "part"]).withColumn("number", number)
    each = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest(F.lit(1), "n_bytes")))
    return over.withColumn("copy", F.floor(F.col("number") / each).cast("long"))


def _bits():
    return F.when(F.col("depth") > 0, F.expr("lpad(bin(prefix), depth, '0')")).otherwise("")


def assign_shards(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(place, doc_id, n_bytes, shard, copy, shard_bytes) of every row of documents.

    ``shard`` and ``copy`` together name a shard; ``copy`` is above 0 only where equal rows exceed the limit. ``place`` is the
    row's number by input partition, as ``monotonically_increasing_id`` gives it.
    """
    rows = settle(docs.select(F.monotonically_increasing_id().alias("place"), "doc_id", *_measures()), "hashed")
    found = settle(_placed(rows, _buckets(rows, limit)[0]), "placed")

    fits = found.filter("bucket_bytes is not null").withColumn("copy", F.lit(0).cast("long"))
    over = _copies(found.filter("bucket_bytes is null"), limit)
    of_copy = over.groupBy("hash", "copy").agg(F.sum("n_bytes").alias("copy_bytes"))
    over = over.join(of_copy, ["hash", "copy"]).withColumn("bucket_bytes", F.col("copy_bytes"))

    columns = ["place", "doc_id", "n_bytes", "depth", "prefix", "copy", "bucket_bytes"]
    return fits.select(*columns).union(over.select(*columns)).select(
        "place", "doc_id", "n_bytes", _bits().alias("shard"), "copy", F.col("bucket_bytes").alias("shard_bytes")
    )


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Write every shard as one folder of Parquet, in one task; returns (doc_id, n_bytes, shard, copy, shard_bytes) of what
    was written, read from there.

    A row finds its shard by its hash, and equal rows that exceed the limit by a number that is written with them first, so
    the input may come in another order each time it is read.
    """
    whole = docs.select(F.struct(*docs.columns).alias("row"), *_measures())
    directory, depth = _buckets(settle(whole.select("n_bytes", "hash"), "hashed"), limit)
    rows = _placed(whole, directory)
    shard = F.concat_ws("-", F.concat(F.lit("b"), _bits()), F.col("copy")).alias("_shard")
    routed = rows.filter("bucket_bytes is not null").withColumn("copy", F.lit(0).cast("long")).select("row", shard)
    if not directory.filter("bucket_bytes is null").isEmpty():
        over = settle(rows.filter("bucket_bytes is null").withColumn("place", F.monotonically_increasing_id()), "over")
        routed = routed.union(_copies(over, limit).select("row", shard))
    routed.repartition("_shard").select("row.*", "_shard").write.partitionBy("_shard").parquet(path)

    written = docs.sparkSession.read.schema(StructType([*docs.schema.fields, StructField("_shard", StringType())])).parquet(path)
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes")
    written = settle(written.select("doc_id", size, "_shard"), "written")
    sizes = written.groupBy("_shard").agg(F.sum("n_bytes").alias("shard_bytes"))
    return written.join(settle(sizes.coalesce(_tasks(depth)), "sizes"), "_shard").select(
        "doc_id",
        "n_bytes",
        F.regexp_extract("_shard", "^b([01]*)-", 1).alias("shard"),
        F.substring_index("_shard", "-", -1).cast("long").alias("copy"),
        "shard_bytes",
    )

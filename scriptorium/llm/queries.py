"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import quality, toxicity
from scriptorium.llm.decontaminate import contamination
from scriptorium.llm.jaccard_join import similar_components
from scriptorium.llm.lexical import ranked
from scriptorium.llm.nearest import nearest
from scriptorium.llm.packing import pack, segments
from scriptorium.llm.perspectives import perspectives
from scriptorium.llm.runs import runs, with_planted_period
from scriptorium.llm.sentencepiece import MODEL, encode_decode
from scriptorium.llm.sharding import write_shards
from scriptorium.llm.store import settle, table
from scriptorium.llm.substring_dedup import remove_repeats
from scriptorium.llm.warc import archive_root, read_archives, write_archives
from scriptorium.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and the digest of the text that they decode to."""
    found = encode_decode(table(spark, sf_dir, "documents"), MODEL, digest=True)
    return found.select("row.doc_id", "n_tokens", "ids", "decoded_sha256", "round_trip")


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors by inner product that are found for every twentieth vector."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 20 = 0"))


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the ids of every document lie in the written matrices, and their digest."""
    return segments(settle(pack(table(spark, sf_dir, "documents"), MODEL), "packed"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as shards of at most a million bytes, and the shard in which each row was found."""
    found = write_shards(table(spark, sf_dir, "documents"), shared_dir(spark, "shards"), limit=1_000_000)
    return found.select("doc_id", "n_bytes", "shard", "copy", "shard_bytes")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives, and what reading these back gives of each record."""
    archives = write_archives(table(spark, sf_dir, "pages"), archive_root(spark))
    found = read_archives(archives, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the view of each of its speakers, with the spans to learn from."""
    found = perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return found.select("conv_id", "participant", "part", "piece", "n_turns", "text", F.array_join(spans, ",").alias("spans"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents joined by a similarity of 0.9 and more of their sets of three-word shingles."""
    return similar_components(table(spark, sf_dir, "documents"), shingle=3, level=90, scale=100)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left and removed of every document, passages of 20 words and more counting as repeats."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in passages of ten words and more of the benchmark."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.coalesce(F.transform("items", lambda i: i.cast("string")), F.array())
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(ids), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated toxicity of every document, learned from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.Model(docs, table(spark, sf_dir, "labels")).score(docs.select("doc_id", "text"))
    return scored.select(
        "row.doc_id",
        toxicity.held_out("row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of four periods and more in every document, every tenth of them made to repeat itself, and the rest without them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs(docs.withColumn("text", with_planted_period(F.col("doc_id"), F.col("text"))))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        (-F.col("longest.n")).alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(-1000 * F.col("longest.n") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents that match each benchmark item best by its terms."""
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs.select("doc_id", "text", "n_chars"), quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "row.doc_id",
        quality.held_out("row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


_QUERIES = (
    op1_sentencepiece,
    op2_nearest,
    op3_pack,
    op4_sharding,
    op5_warc,
    op6_perspectives,
    op7_jaccard_join,
    op8_substring_dedup,
    op9_decontaminate,
    op10_toxicity,
    op11_runs,
    op12_lexical,
    op13_quality,
)


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in _QUERIES}

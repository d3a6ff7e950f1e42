"""Registered queries: every operator over the whole of the given tables.

Each takes (spark, sf_dir) and returns flat columns, lists joined to strings, so that results compare
with SQL. The matching statements are in :mod:`scriptorium.plans.oracles`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.functions.text import at_least, strip
from scriptorium.operators import report as rep
from scriptorium.operators import validate as v
from scriptorium.operators.chat import training_text
from scriptorium.operators.gold import gold
from scriptorium.operators.silver import silver
from scriptorium.operators.templates import compile_template
from scriptorium.operators.tokens import tokenize, utf8_bytes, word_pieces
from scriptorium.operators.training import (
    FALLBACK_START,
    MIN_TAIL_CHARS,
    split_body,
    training_messages,
)
from scriptorium.plans import standins as st
from scriptorium.plans.daily import Layout, process_days
from scriptorium.session import shared_dir
from scriptorium.sources import feed
from scriptorium.sources.layers import (
    PARTITION,
    read_layer,
    stripped_lines,
    training_rows_from_lines,
    write_layer,
)
from scriptorium.sources.positions import numbered_lines
from scriptorium.sources.schemas import GOLD, SILVER, SILVER_REQUIRED, TRAINING_ROW
from scriptorium.streaming.incremental import run_incremental

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def _query(run: Query) -> Query:
    """Register under the function's name, without the underscore that tells it from the operator."""
    _QUERIES[run.__name__.rstrip("_")] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.table(spark, sf_dir, "documents")


def _joined(column: str) -> Column:
    return F.array_join(column, "|").alias(column)


def _flat(rows: DataFrame) -> DataFrame:
    lists = {f.name for f in rows.schema if f.dataType.typeName() == "array"}
    return rows.select(*[_joined(c) if c in lists else F.col(c) for c in rows.columns])


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(st.padded_bronze(_documents(spark, sf_dir)))


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.validate(stripped_lines(st.raw_lines(_documents(spark, sf_dir))))


# --- sources ---------------------------------------------------------------------------------------


@_query
def raw_line_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents, stripped, blank ones skipped, counted per language."""
    lines = _documents(spark, sf_dir).select("lang", F.explode(F.split("text", "\n")).alias("line"))
    return stripped_lines(lines).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.length("line")).alias("n_chars"),
    )


@_query
def feed_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest entries of the feed categories, as many as the full scale takes."""
    entries = st.feed_entries(_documents(spark, sf_dir))
    return feed.feed_window(entries, "full").select("id", "title", "published")


@_query
def feed_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second page of the feed at test scale."""
    entries = st.feed_entries(_documents(spark, sf_dir))
    page = feed.feed_page(entries, page=1, page_size=feed.SCALES["test"].page_size)
    return page.select("id", "title", "published")


@_query
def feed_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank of every entry of the feed and the page at test scale that it is on, from the feed stored by ranges."""
    entries = st.feed_entries(_documents(spark, sf_dir)).select("id", "published", "category")
    ranked = feed.feed_index(entries, shared_dir(spark, "feed"), range_rows=10_000).ranks()
    page = F.floor(F.col("rank") / feed.SCALES["test"].page_size).cast("long")
    return ranked.select("id", F.col("rank").cast("long").alias("rank"), page.alias("page"))


@_query
def feed_deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page at test scale in the middle of the feed, read from its range."""
    entries = st.feed_entries(_documents(spark, sf_dir)).select("id", "title", "published", "category")
    index = feed.feed_index(entries, shared_dir(spark, "feed"), range_rows=10_000)
    size = feed.SCALES["test"].page_size
    return index.stretch(len(index) // size // 2 * size, size).select("id", "title", "published")


@_query
def scale_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale and row budget of a run for every document, its settings written in many ways."""
    runs = st.run_settings(_documents(spark, sf_dir))
    scale = feed.resolved_scale(F.col("conf"), F.col("env"), F.col("params"))
    return runs.select("doc_id", scale.alias("scale")).withColumn("n_rows", feed.scale_rows(F.col("scale")).cast("long"))


@_query
def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File, line number and reason of every rejected line of documents landed as text files."""
    landed = shared_dir(spark, "landed")
    st.write_shelves(st.raw_lines(_documents(spark, sf_dir)), landed)
    flagged = v.validate(numbered_lines(spark, landed)).where("reason is not null")
    shelf = F.regexp_extract("file", "shelf=([0-9]+)", 1).cast("long")
    return flagged.select(shelf.alias("shelf"), "line_number", "reason")


@_query
def atom_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed as Atom files and read back as bronze records."""
    landed = shared_dir(spark, "feed")
    st.write_feed(st.feed_entries(_documents(spark, sf_dir)), landed)
    return _flat(feed.to_bronze(feed.read_feed(spark, landed), "2026-01-01", "run"))


@_query
def layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows written as daily JSON lines and read back under their schema."""
    root = shared_dir(spark, "silver")
    write_layer(_silver(spark, sf_dir), root, rebalance=True)
    return _flat(read_layer(spark, root, SILVER, SILVER_REQUIRED))


# --- validation ------------------------------------------------------------------------------------


@_query
def validate_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir).select("doc_id", "reason")


@_query
def validated_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed fields of the valid records."""
    return _flat(v.valid_records(_flagged(spark, sf_dir)).drop("line"))


@_query
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.validation_report(_flagged(spark, sf_dir), "raw", "validated")


@_query
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.reject_reasons(_flagged(spark, sf_dir))


@_query
def quality_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, share and gate of three deliveries of lines, one wholly and one mostly invalid."""
    delivery = (
        F.when(F.col("doc_id") % 37 == 0, "cut")
        .when((F.col("doc_id") % 23 == 0) | (F.col("doc_id") % 46 == 1), "mixed")
        .otherwise("rest")
    )
    counts = _flagged(spark, sf_dir).groupBy(delivery.alias("delivery")).agg(*v.report_columns())
    return v.with_gates(v.with_ratio(counts))


# --- silver and gold -------------------------------------------------------------------------------


@_query
def silver_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_silver(spark, sf_dir))


@_query
def gold_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold(_silver(spark, sf_dir)).select("url", "title", _joined("mock_topics"))


@_query
def gold_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold(_silver(spark, sf_dir)).select("url", "body_len", "mock_quality_score")


@_query
def gold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold(_silver(spark, sf_dir)).select("url", "mock_summary")


@_query
def gold_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(gold(_silver(spark, sf_dir)))


# --- training set ----------------------------------------------------------------------------------


@_query
def training_messages_(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_messages(gold(_silver(spark, sf_dir)), keep=("url",))
    return rows.select(
        "url",
        "fallback",
        F.get("messages", F.lit(0))["content"].alias("prompt"),
        F.get("messages", F.lit(1))["content"].alias("answer"),
    )


@_query
def training_split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and characters of heads and tails, with and without fallback."""
    return (
        split_body(_silver(spark, sf_dir))
        .groupBy("fallback")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.length("head")).alias("head_chars"),
            F.sum(F.length("tail")).alias("tail_chars"),
            F.min(F.length("body")).alias("shortest_body"),
        )
    )


@_query
def render_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of every conversation."""
    chats = st.chats(st.table(spark, sf_dir, "conversations"))
    return training_text(chats, keep=("conv_id",))


@_query
def render_fallbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of training rows in all accepted forms."""
    return training_text(st.training_rows(_documents(spark, sf_dir)), keep=("doc_id",))


@_query
def render_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from JSON lines, for a tokenizer without chat template."""
    rows = st.training_rows(_documents(spark, sf_dir))
    lines = rows.select("doc_id", F.to_json(F.struct(*TRAINING_ROW.names)).alias("line"))
    return training_text(training_rows_from_lines(lines), template=None, keep=("doc_id",))


@_query
def render_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of every document's chat by a translated template; where that raises, the plain text."""
    template = compile_template(st.ALTERNATING, bos_token="<s>", eos_token="</s>")
    return training_text(st.line_chats(_documents(spark, sf_dir)), template, keep=("doc_id",))


@_query
def text_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept texts and their characters per language, after the length gate and cut."""
    texts = training_text(_documents(spark, sf_dir), keep=("lang",))
    return texts.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_samples"), F.sum(F.length("text")).alias("n_chars")
    )


@_query
def token_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = training_text(_documents(spark, sf_dir), keep=("doc_id",))
    pieces = texts.select("doc_id", word_pieces(F.col("text")).alias("tokens"))
    return pieces.select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens")
    )


@_query
def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids from the pluggable tokenizer, here the bytes of the text, in hexadecimal."""
    texts = training_text(_documents(spark, sf_dir), keep=("doc_id",))
    ids = tokenize(texts, utf8_bytes, keep=("doc_id",))
    in_hex = F.transform("input_ids", lambda i: F.lpad(F.hex(i), 2, "0"))
    return ids.select(
        "doc_id",
        F.array_join(in_hex, "").alias("ids"),
        F.aggregate("attention_mask", F.lit(0), lambda n, m: n + m).alias("n_ids"),
    )


@_query
def sample_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training texts per day, from raw lines on in one plan."""
    rows = training_messages(_gold_from_lines(spark, sf_dir), keep=(PARTITION,))
    return rep.sample_counts(training_text(rows, keep=(PARTITION,)), PARTITION)


# --- reports ---------------------------------------------------------------------------------------


@_query
def perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.losses(_documents(spark, sf_dir)).select(
        "doc_id", "train_loss", rep.perplexity(F.col("train_loss")).alias("perplexity_estimate")
    )


@_query
def eval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = st.losses(_documents(spark, sf_dir))
    return rep.eval_report(metrics, F.concat(F.lit("metrics/"), F.col("doc_id").cast("string")))


@_query
def train_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = st.losses(_documents(spark, sf_dir))
    folder = F.concat(F.lit("models/"), F.col("doc_id").cast("string"))
    return rep.train_manifest(
        metrics, folder, F.concat(folder, F.lit("/metrics.json")), keep=("doc_id",)
    )


@_query
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifacts per day and source, from one pass over the flagged lines."""
    flagged = _flagged(spark, sf_dir)
    valid = F.col("reason").isNull()
    shortest = FALLBACK_START + MIN_TAIL_CHARS
    runs = flagged.groupBy(
        F.coalesce(PARTITION, F.lit("unknown")).alias(PARTITION), F.col("run_id")
    ).agg(
        F.bool_or(valid).alias("valid"),
        F.bool_or(valid & at_least(strip(F.col("content")), shortest)).alias("trainable"),
    )

    def made(name: str, when: Column) -> Column:
        path = F.concat(F.lit(f"{name}/{PARTITION}="), F.col(PARTITION))
        return F.struct(F.lit(name).alias("artifact"), F.when(when, path).alias("path"))

    made_by_valid = ("bronze_validated", "validation_report", "silver", "gold")
    made_by_training = ("sft_train", "qwen_checkpoint_dir", "qwen_train_manifest", "qwen_metrics", "eval_report")
    artifacts = runs.select(
        PARTITION,
        "run_id",
        F.inline(
            F.array(
                made("bronze_raw", F.lit(True)),
                *[made(name, F.col("valid")) for name in made_by_valid],
                *[made(name, F.col("trainable")) for name in made_by_training],
            )
        ),
    )
    return rep.manifest(artifacts, "daily").select(PARTITION, "run_id", "pipeline", "artifacts.*")


# --- whole runs ------------------------------------------------------------------------------------


def _gold_from_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold(silver(v.valid_records(_flagged(spark, sf_dir))))


@_query
def lines_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines to gold rows in one plan without a shuffle."""
    return _flat(_gold_from_lines(spark, sf_dir))


@_query
def lines_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines to training texts in one plan without a shuffle."""
    rows = training_messages(_gold_from_lines(spark, sf_dir), keep=("url",))
    return training_text(rows, keep=("url",))


def _landed_days(spark: SparkSession, sf_dir: str) -> str:
    landing = shared_dir(spark, "landing")
    lines = st.raw_lines(_documents(spark, sf_dir))
    days = lines.select(F.col("line").alias("value"), st.day().alias(PARTITION))
    write_layer(days, landing, fmt="text", rebalance=True, compression="gzip")
    return landing


@_query
def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold layer after an incremental run over landed days."""
    root = shared_dir(spark, "layers")
    landing = _landed_days(spark, sf_dir)
    run_incremental(spark, landing, root, shared_dir(spark, "seen"))
    return _flat(read_layer(spark, Layout(root).gold, GOLD))


@_query
def stage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per day that each stage of a run over three days reports in its metadata."""
    layout = Layout(shared_dir(spark, "layers"))
    days = ["2026-01-01", "2026-01-02", "2026-01-03"]
    process_days(spark, layout, days, raw=_landed_days(spark, sf_dir))
    stages = [
        spark.read.schema(f"rows bigint, engine string, {PARTITION} string")
        .json(f"{layout.layer(stage)}/_meta")
        .select(F.lit(stage).alias("stage"), PARTITION, "rows", "engine")
        for stage in ("silver", "gold", "sft_train")
    ]
    return stages[0].unionByName(stages[1]).unionByName(stages[2])

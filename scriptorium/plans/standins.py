"""Inputs of the pipeline derived from the given tables.

The tables hold no papers, so documents stand in for them: each becomes a bronze record, a feed entry or
a training row, with faults planted by rules over the document id. Every row of a table is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scriptorium.functions.text import WHITESPACE, generated
from scriptorium.operators.chat import CHATML, MAX_TEXT_CHARS, ChatTemplate, head_turns
from scriptorium.sources.schemas import BRONZE, MESSAGES, METRICS

TURN_SALTS = 64
SHELF = 500
# Default of spark.sql.optimizer.windowGroupLimitThreshold.
MAP_SIDE_TURNS = 1000
TURN_ORDER = ("turn", "role", "text")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("doc_id") % n == 0


def day() -> Column:
    """Day of a document."""
    return F.concat(F.lit("2026-01-0"), (1 + F.col("doc_id") % 3).cast("string"))


def _title() -> Column:
    """The whole first line."""
    return F.substring_index("text", "\n", 1)


def _published() -> Column:
    month = F.lpad((1 + F.col("doc_id") % 12).cast("string"), 2, "0")
    of_month = F.lpad((1 + F.col("doc_id") % 28).cast("string"), 2, "0")
    return F.concat(F.lit("2024-"), month, F.lit("-"), of_month, F.lit("T00:00:00Z"))


def bronze(documents: DataFrame) -> DataFrame:
    """Bronze records with ``doc_id``; short titles, wrong urls and dates are planted."""
    host = F.when(_every(23), "http://example.com/abs/").otherwise("http://arxiv.org/abs/")
    published = F.when(_every(29), "not-a-date").otherwise(_published())
    return documents.select(
        "doc_id",
        F.lit("arxiv").alias("source"),
        F.concat(host, F.col("doc_id").cast("string")).alias("url"),
        F.when(_every(31), "abc").otherwise(_title()).alias("title"),
        F.col("text").alias("content"),
        F.when(~_every(5), F.array("source", "lang")).alias("authors"),
        published.alias("published_at"),
        published.alias("updated_at"),
        day().alias("process_date"),
        F.lit("fixture").alias("run_id"),
    )


def padded_bronze(documents: DataFrame) -> DataFrame:
    """Bronze records with spaces and other whitespace around title and content, and null titles."""
    edge = (
        F.when(_every(3), F.lit("  "))
        .when(F.col("doc_id") % 3 == 1, F.lit("\t"))
        .otherwise(F.lit(WHITESPACE[-1] + " "))
    )
    padded = bronze(documents)
    title = F.when(~_every(17), F.concat(edge, "title", edge))
    return padded.withColumn("title", title).withColumn("content", F.concat(edge, "content", edge))


def raw_lines(documents: DataFrame) -> DataFrame:
    """One JSON line per document (``doc_id``, ``line``), with broken lines planted.

    Left as they are, records break as in :func:`bronze`; over that, lines are cut short, wrapped in a
    list, followed by a surplus brace or other text, or lack a key; and authors get a wrong type.
    """
    records = bronze(documents)
    body = F.expr("substring(line, 2, length(line) - 2)")
    line = F.col("line")
    broken = (
        F.when(_every(37), F.expr("substring(line, 1, length(line) - 1)"))
        .when(_every(41), F.concat(F.lit("["), line, F.lit("]")))
        .when(_every(43), F.concat(line, F.lit("}")))
        .when(_every(47), F.concat(line, F.lit(" trailing")))
        .when(_every(53), F.concat(F.lit("{"), body, F.lit(',"authors":["a",1]}')))
        .when(_every(59), F.concat(F.lit("{"), body, F.lit(',"authors":"a"}')))
        .when(_every(61), F.regexp_replace(line, '"source":', '"origin":'))
        .when(_every(67), F.concat(F.lit("{"), body, F.lit(',"title":5}')))
        .when(_every(71), F.concat(F.lit("{"), body, F.lit(',"authors":null,"score":NaN}')))
        .when(_every(73), F.concat(F.lit(" \t"), line, F.lit("\t ")))
        .otherwise(line)
    )
    plain = records.select("doc_id", F.to_json(F.struct(*BRONZE.names)).alias("line"))
    # As opaque to the stages as a line that was read from a file.
    return plain.select("doc_id", generated(broken).alias("line"))


def write_shelves(lines: DataFrame, path: str) -> None:
    """Lines as text files, one for each ``SHELF`` consecutive ids, in the order of their ids, a blank line before each."""
    shelved = lines.withColumn("shelf", F.floor(F.col("doc_id") / SHELF))
    blank = F.concat(F.lit("\n"), F.col("line")).alias("value")
    ordered = shelved.repartition("shelf").sortWithinPartitions("shelf", "doc_id")
    ordered.select(blank, "shelf").write.partitionBy("shelf").text(path)


def run_settings(documents: DataFrame) -> DataFrame:
    """Settings of a run for each document: scale names in several spellings, empty and absent ones."""
    spelled = lambda names, n: F.get(F.array(*map(F.lit, names)), (F.col("doc_id") % n).cast("int"))
    return documents.select(
        "doc_id",
        spelled(["", " Smoke ", None, "test", None, "", None], 7).alias("conf"),
        spelled([" FULL", "   ", "\t", "huge", None], 5).alias("env"),
        spelled(["smoke", "", None], 3).alias("params"),
    )


def feed_entries(documents: DataFrame) -> DataFrame:
    """Feed entries with ``doc_id``: categories cycle, some entries lack ``published`` or authors."""
    cycle = F.array(*[F.lit(c) for c in ("cs.AI", "cs.CL", "cs.LG", "cs.DB", "math.CO")])
    terms = F.array(
        F.get(cycle, (F.col("doc_id") % 5).cast("int")),
        F.get(cycle, (F.col("doc_id") % 7 % 5).cast("int")),
    )
    return documents.select(
        "doc_id",
        F.concat(F.lit("http://arxiv.org/abs/"), F.col("doc_id").cast("string")).alias("id"),
        _title().alias("title"),
        F.col("text").alias("summary"),
        F.when(~_every(29), _published()).alias("published"),
        _published().alias("updated"),
        F.when(
            ~_every(5),
            F.array(F.struct(F.col("source").alias("name")), F.struct(F.col("lang").alias("name"))),
        ).alias("author"),
        F.transform(terms, lambda t: F.struct(t.alias("_term"))).alias("category"),
    )


def write_feed(entries: DataFrame, path: str) -> None:
    """Land entries as Atom files."""
    (
        entries.drop("doc_id")
        .write.mode("errorifexists")
        .option("rootTag", 'feed xmlns="http://www.w3.org/2005/Atom"')
        .option("rowTag", "entry")
        .xml(path)
    )


def chats(turns: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """``messages`` per conversation: the leading turns that decide its training text.

    A training text ends at 12,000 characters and every turn takes up some, so the turns after the first
    few hundred cannot show, and the text is the same as for the whole conversation; one turn without
    role or content, which voids a chat, is kept wherever it stands. This is one plan for conversations
    of any length: parts of a conversation, told apart by input partition, are cut before the whole, in
    the task that reads them and again after the shuffle, so no task sees all turns of a long one.

    Spark cuts before the shuffle up to MAP_SIDE_TURNS; a template with so little markup that more turns
    can show is refused.
    """
    limit = head_turns(MAX_TEXT_CHARS, template)
    if limit > MAP_SIDE_TURNS:
        raise ValueError(f"the markup lets {limit} turns show, more than {MAP_SIDE_TURNS}")
    whole = F.col("role").isNotNull() & F.col("text").isNotNull()
    voids = turns.where(~whole).groupBy("conv_id").agg(F.min(F.struct(*TURN_ORDER)).alias("void"))
    leading = turns.where(whole)
    for parts in ([F.spark_partition_id() % TURN_SALTS], []):
        first = Window.partitionBy("conv_id", *parts).orderBy(*TURN_ORDER)
        leading = leading.withColumn("rank", F.row_number().over(first)).where(
            F.col("rank") <= limit
        )
    deciding = leading.select("conv_id", *TURN_ORDER).unionByName(voids.select("conv_id", "void.*"))
    in_order = F.array_sort(F.collect_list(F.struct(*TURN_ORDER)))
    message = F.transform(
        in_order, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))
    )
    return deciding.groupBy("conv_id").agg(message.cast(MESSAGES).alias("messages"))


def training_rows(documents: DataFrame) -> DataFrame:
    """Training rows with ``doc_id`` in the accepted forms: messages, text and instruction.

    Every document goes through whole. Further rows, with a negative id, have texts around the length
    gate or nothing usable.
    """
    own, extra = F.col("doc_id"), -1 - F.col("doc_id")
    around = F.repeat(F.lit("x"), (own % 9 + 36).cast("int"))

    def row(doc_id: Column, doc: Column, form: Column) -> Column:
        return F.struct(doc_id.alias("doc_id"), doc.alias("doc"), form.cast("int").alias("form"))

    rows = F.array_compact(
        F.array(
            row(own, F.col("text"), own % 5),
            F.when(_every(11), row(extra, around, own % 5)),
            F.when(_every(6), row(extra, F.lit(None).cast("string"), F.lit(5))),
        )
    )
    documents = documents.select("lang", "source", F.inline(rows))
    form = F.col("form")
    user = F.struct(F.lit("user").alias("role"), F.col("doc").alias("content"))
    empty_turn = F.struct(F.lit("user").alias("role"), F.lit(None).cast("string").alias("content"))
    messages = (
        F.when(form == 0, F.array(user))
        .when(form == 1, F.array().cast(MESSAGES))
        .when(form == 4, F.array(empty_turn))
    )
    return documents.select(
        "doc_id",
        messages.cast(MESSAGES).alias("messages"),
        F.when(form.isin(1, 2, 4), F.concat(F.lit(" "), "doc", F.lit("\n")))
        .when(form == 3, F.lit(" \t"))
        .alias("text"),
        F.when(form == 3, F.col("doc")).alias("instruction"),
        F.when((form == 3) & _every(2), F.col("lang")).alias("input"),
        F.when(form == 3, F.col("source")).alias("output"),
    )


# The markup of a public chat template whose roles have to take turns.
ALTERNATING = """{% if messages[0]['role'] == 'system' %}
    {%- set turns = messages[1:] %}
    {%- set opening = '<<SYS>>\\n' + messages[0]['content'] | trim + '\\n<</SYS>>\\n\\n' %}
{%- else %}
    {%- set turns = messages %}
    {%- set opening = '' %}
{%- endif %}
{%- for message in turns %}
    {%- if (message['role'] == 'user') != (loop.index0 % 2 == 0) %}
        {{- raise_exception('Conversation roles must alternate user/assistant/user/assistant/...') }}
    {%- endif %}
    {%- set content = opening + message['content'] if loop.index0 == 0 else message['content'] %}
    {%- if message['role'] == 'user' %}
        {{- bos_token + '[INST] ' + content | trim + ' [/INST]' }}
    {%- elif message['role'] == 'assistant' %}
        {{- ' ' + content | trim + ' ' + eos_token }}
    {%- endif %}
{%- endfor %}"""


def line_chats(documents: DataFrame) -> DataFrame:
    """Training rows with ``doc_id``: the lines of a document as turns, its text as fallback.

    Every third chat opens with a system turn; in every seventh the last turn is out of turn.
    """
    lines = F.split("text", "\n")
    system = (F.col("doc_id") % 3 == 0).cast("int")

    def turn(line: Column, at: Column) -> Column:
        user = (at - system) % 2 == 0
        late = (at == F.size(lines) - 1) & _every(7)
        role = F.when(at < system, "system").when(user != late, "user").otherwise("assistant")
        return F.struct(role.alias("role"), line.alias("content"))

    return documents.select("doc_id", F.transform(lines, turn).cast(MESSAGES).alias("messages"), "text")


def losses(documents: DataFrame) -> DataFrame:
    """Metrics rows keyed by ``doc_id``, with a loss from the text length, missing or overflowing for some."""
    loss = (
        F.when(_every(17), F.lit(None).cast("double"))
        .when(_every(13), 710.0 + F.col("n_chars"))
        .otherwise((F.col("n_chars") % 12000) / 1000.0)
    )
    values = {
        "train_loss": loss,
        "max_steps": F.lit(300),
        "n_samples": F.col("n_chars"),
        "model_name": F.col("source"),
        "device": F.lit("cpu"),
        "dtype": F.lit("torch.float32"),
        "runtime_seconds": F.col("n_chars") / 100.0,
        "jsonl": F.concat(F.lit("sft/process_date="), day()),
    }
    fields = [values[f.name].cast(f.dataType).alias(f.name) for f in METRICS.fields]
    return documents.select("doc_id", day().alias("process_date"), *fields)


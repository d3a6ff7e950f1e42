"""Chat formatting by perspective: every participant of a dialogue in turn as assistant, in DataFrame operations only.

For each participant the dialogue is rendered with that speaker's turns as ``assistant``, all other speakers as users with
their names, and system turns as they are; spans give the characters to learn from, the participant's own contents.

A dialogue may hold a third of all rows, so it is rendered in parts of ``PART_TURNS`` turn numbers: the parts in order, put
together, are the whole dialogue, and spans count from the beginning of their row. A part that holds more than
``PIECE_ROWS`` different rows, because many share a turn number, is cut into pieces of that many consecutive turns, whose
order is that of ``piece``. No group is larger than that, and equal rows are combined before they are counted. The
different rows of parts with more rows than that are numbered by a sort over all tasks, so none sorts a whole part.

Defined cases: equal rows are one turn. Turns of the same number follow each other by role, then text; turns without
number come last, in a part without number. A null role is a speaker named ``unknown`` who gets no perspective; a null or empty
text is an empty turn. System turns are no participants, and a dialogue without any has no rows. Rows without conv_id
form one dialogue. Line ends in names become spaces; contents are kept as they are. Other columns are not used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.store import settle

PART_TURNS, PIECE_ROWS = 32, 256
SYSTEM, UNKNOWN = "system", "unknown"

# Fixed values of the chat markup.
_BEGIN, _END = "<|im_start|>", "<|im_end|>\n"


def _name(role: Column) -> Column:
    return F.translate(F.coalesce(role, F.lit(UNKNOWN)), "\r\n", "  ")


def _head(role: Column, participant: Column) -> Column:
    shown = (
        F.when(role.eqNullSafe(participant), F.lit("assistant"))
        .when(role == SYSTEM, F.lit(SYSTEM))
        .otherwise(F.concat(F.lit("user name="), _name(role)))
    )
    return F.concat(F.lit(_BEGIN), shown, F.lit("\n"))


def _numbered(rows: DataFrame) -> DataFrame:
    """The rows with their ``number`` within (conv_id, part) by turn, role and text."""
    order = ["conv_id", "part", "turn", "role", "text"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    placed = settle(placed, "placed").withColumn("task", F.shiftright("place", 33))
    of_task = placed.groupBy("conv_id", "part", "task").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id", "part").orderBy("task")
    # rows of a part follow each other in a task
    begun = of_task.select(
        F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("task").alias("t"),
        (F.sum("n").over(earlier) - F.col("n") - F.col("first")).alias("offset"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("part").eqNullSafe(F.col("p")) & (F.col("task") == F.col("t"))
    return placed.join(settle(begun, "begun"), same).withColumn("number", F.col("place") + F.col("offset"))


def perspectives(turns: DataFrame, part_turns: int = PART_TURNS, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """(conv_id, participant, part, piece, n_turns, text, spans) from rows (conv_id, turn, role, text)."""
    rows = turns.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("part", F.floor(F.col("turn") / part_turns))
    # raw rows only tell which parts may be crowded; what counts is the place among the different rows
    counts = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n")).filter(F.col("n") > piece_rows)
    crowded = settle(counts.select(F.col("conv_id").alias("c"), F.col("part").alias("p")), "crowded")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("part").eqNullSafe(F.col("p"))
    few = rows.join(crowded, same, "left_anti").withColumn("piece", F.lit(0).cast("long"))
    many = _numbered(rows.join(crowded, same, "left_semi").distinct())
    many = many.withColumn("piece", F.floor(F.col("number") / piece_rows)).select(*few.columns)

    pieces = few.union(many).groupBy("conv_id", "part", "piece").agg(F.array_sort(F.collect_set(F.struct("turn", "role", "text"))).alias("turns"))
    speakers = turns.filter(F.col("role") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("role").alias("participant")).distinct()
    seen = pieces.join(speakers, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")

    who = F.col("participant")
    shown = F.transform("turns", lambda t: F.concat(_head(t["role"], who), t["text"], F.lit(_END)))
    begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(done: Column, t: Column) -> Column:
        start = done["at"] + F.length(_head(t["role"], who))
        end = start + F.length(t["text"])
        own = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(t["role"].eqNullSafe(who), F.concat(done["spans"], own)).otherwise(done["spans"])
        return F.struct((end + len(_END)).alias("at"), spans.alias("spans"))

    return seen.select(
        "conv_id",
        "participant",
        "part",
        "piece",
        F.size("turns").alias("n_turns"),
        F.array_join(shown, "").alias("text"),
        F.aggregate("turns", begun, add, lambda done: done["spans"]).alias("spans"),
    )

"""Training rows to plain text: chat rendering, fallbacks and the length gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from scriptorium.functions.text import at_least, first_chars, generated, once, strip
from scriptorium.operators.templates import CompiledTemplate

# Fixed values of the text gate and the instruction layout.
MIN_TEXT_CHARS = 40
MAX_TEXT_CHARS = 12000
INSTRUCTION_HEADINGS = ("### Instruction\n", "\n### Input\n", "\n### Output\n")


@dataclass(frozen=True)
class ChatTemplate:
    """How a list of messages becomes text, whatever their roles.

    ``default_system`` opens a chat that does not start with a system turn.
    """

    turn_open: str
    role_end: str
    turn_close: str
    default_system: str | None = None

    def turn(self, role: Column, content: Column) -> Column:
        return F.concat(
            F.lit(self.turn_open), role, F.lit(self.role_end), content, F.lit(self.turn_close)
        )


# Fixed values of the chat markup of the default model.
CHATML = ChatTemplate(
    turn_open="<|im_start|>",
    role_end="\n",
    turn_close="<|im_end|>\n",
    default_system="You are Qwen, created by Alibaba Cloud. You are a helpful assistant.",
)


def render(messages: Column, template: ChatTemplate | CompiledTemplate = CHATML) -> Column:
    """Chat text without a generation prompt; null for no messages or a turn without role or content."""
    if isinstance(template, CompiledTemplate):
        return template.rendered(messages)
    opening = F.lit("")
    if template.default_system is not None:
        has_system = F.coalesce(F.get(messages, F.lit(0))["role"] == "system", F.lit(False))
        opening = F.when(has_system, "").otherwise(
            template.turn(F.lit("system"), F.lit(template.default_system))
        )

    def joined(turns: Column) -> Column:
        # A turn without role or content renders as null.
        complete = F.forall(turns, lambda turn: turn.isNotNull())
        return F.when(complete, F.concat(opening, F.array_join(turns, "")))

    turns = F.transform(messages, lambda m: template.turn(m["role"], m["content"]))
    return F.when(F.size(messages) > 0, once(turns, joined))


def instruction_text() -> Column:
    """Instruction layout; null where there is no instruction."""
    parts = zip(INSTRUCTION_HEADINGS, ("instruction", "input", "output"))
    text = F.concat(*[p for h, c in parts for p in (F.lit(h), F.coalesce(c, F.lit("")))])
    return F.when(F.col("instruction").isNotNull(), text)


def training_text(
    rows: DataFrame, template: ChatTemplate | CompiledTemplate | None = CHATML, keep: tuple[str, ...] = ()
) -> DataFrame:
    """``text`` of the rows with more than 40 characters, cut to 12,000.

    The text is the first non-empty of the rendered chat, the plain text and the instruction layout. Any
    of the training-row columns may be absent; ``template=None`` stands for a tokenizer without chat
    template. Where a compiled template raises, the next form is taken.
    """
    have = set(rows.columns)
    for name in ("input", "output"):
        if "instruction" in have and name not in have:
            rows = rows.withColumn(name, F.lit(None).cast(StringType()))
    choices = []
    if "messages" in have and template is not None:
        rows = rows.select("*", generated(render(F.col("messages"), template)).alias("_chat"))
        choices.append(F.when(F.col("_chat") != "", F.col("_chat")))
    if "text" in have:
        plain = strip(F.col("text"))
        choices.append(F.when(plain != "", plain))
    if "instruction" in have:
        choices.append(instruction_text())
    chosen = F.coalesce(*choices) if choices else F.lit(None).cast(StringType())
    texts = rows.select(*keep, generated(once(chosen, strip)).alias("text"))
    return texts.where(at_least(F.col("text"), MIN_TEXT_CHARS + 1)).withColumn(
        "text", first_chars(F.col("text"), MAX_TEXT_CHARS)
    )


def head_turns(chars: int, template: ChatTemplate) -> int:
    """Number of leading turns that decide the first ``chars`` characters of a chat."""
    shortest = len(template.turn_open) + len(template.role_end) + len(template.turn_close)
    return (chars + len(template.turn_close)) // max(shortest, 1) + 1

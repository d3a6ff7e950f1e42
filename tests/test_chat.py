import json
import os
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from scriptorium.operators.chat import CHATML, ChatTemplate, head_turns, render, training_text
from scriptorium.operators.tokens import MAX_TOKENS, tokenize, utf8_bytes, word_pieces
from scriptorium.plans.standins import chats
from scriptorium.sources.layers import training_rows_from_lines
from scriptorium.sources.schemas import TRAINING_ROW

SYSTEM = f"<|im_start|>system\n{CHATML.default_system}<|im_end|>\n"


def shown(role, content):
    return f"<|im_start|>{role}\n{content}<|im_end|>\n"


def training_rows(spark, rows):
    full = [{**dict.fromkeys(TRAINING_ROW.names), **r} for r in rows]
    return spark.createDataFrame([tuple(r[n] for n in TRAINING_ROW.names) for r in full], TRAINING_ROW)


def texts(spark, rows, **options):
    return [r.text for r in training_text(training_rows(spark, rows), **options).collect()]


@pytest.mark.parametrize(
    "messages, expected",
    [
        ([("user", "q")], SYSTEM + shown("user", "q")),
        ([("system", "s"), ("user", "q")], shown("system", "s") + shown("user", "q")),
        ([("user", "q"), ("system", "s")], SYSTEM + shown("user", "q") + shown("system", "s")),
        ([("user", "")], SYSTEM + shown("user", "")),
        ([("user", "q"), ("critic", "c")], SYSTEM + shown("user", "q") + shown("critic", "c")),
        ([("user", "q"), ("critic", "c"), (None, "n")], None),
        ([("user", None)], None),
        ([("critic", None), ("user", "100% {x}")], None),
        ([(None, "a"), ("user", "b")], None),
        ([("user", "100% {x}"), ("tool", "r")], SYSTEM + shown("user", "100% {x}") + shown("tool", "r")),
        ([], None),
        (None, None),
    ],
)
def test_render(spark, messages, expected):
    row = training_rows(spark, [{"messages": messages}])
    assert row.select(render(F.col("messages")).alias("t")).first().t == expected


def test_other_template(spark):
    plain = ChatTemplate("<", ":", ">")
    row = training_rows(spark, [{"messages": [("user", "a"), ("user", "b"), ("system", "c")]}])
    assert row.select(render(F.col("messages"), plain).alias("t")).first().t == "<user:a><user:b><system:c>"


def test_gate_boundary(spark):
    rows = [{"text": c * n} for c, n in (("a", 40), ("b", 41), ("é", 41), ("😀", 40))]
    assert sorted(texts(spark, rows)) == ["b" * 41, "é" * 41]
    assert texts(spark, [{"text": " " * 20 + "a" * 40 + "　" * 20}]) == []


@pytest.mark.parametrize("chars", [11999, 12000, 12001])
def test_cut(spark, chars):
    assert texts(spark, [{"text": "\n" + "é" * chars + "\t"}]) == ["é" * min(chars, 12000)]


LONG = "x" * 50


def test_fallback_order(spark):
    chat = [("user", LONG)]
    layout = f"### Instruction\n{LONG}\n### Input\n\n### Output\no"
    for row, expected in [
        ({"messages": chat, "text": LONG}, (SYSTEM + shown("user", LONG)).strip()),
        ({"messages": [], "text": f" {LONG}"}, LONG),
        ({"messages": [("user", None)], "text": LONG}, LONG),
        ({"text": LONG, "instruction": "i"}, LONG),
        ({"text": " 　", "instruction": LONG, "output": "o"}, layout),
        ({"text": "short", "instruction": LONG}, None),
        ({"instruction": ""}, None),
        ({}, None),
    ]:
        assert texts(spark, [row]) == ([expected] if expected else []), row


def test_no_template_skips_messages(spark):
    row = {"messages": [("user", LONG)], "instruction": LONG}
    assert texts(spark, [row], template=None)[0].startswith("### Instruction")
    assert texts(spark, [{"messages": [("user", LONG)]}], template=None) == []


def test_columns_may_be_absent(spark):
    frame = spark.createDataFrame([(1, LONG)], "id int, instruction string")
    row = training_text(frame, keep=("id",)).first()
    assert (row.id, row.text) == (1, f"### Instruction\n{LONG}\n### Input\n\n### Output")
    assert training_text(spark.range(3)).count() == 0


def test_rendered_once(spark, plan):
    message = "named_struct('role', 'user', 'content', repeat('x', cast(id + 50 as int)))"
    rows = spark.range(1).selectExpr(f"array({message}) as messages")
    assert plan(training_text(rows)).count("array_join(") == 1


def test_json_lines(spark):
    lines = [
        {"messages": [{"role": "user", "content": LONG}]},
        {"text": LONG},
        {"instruction": LONG, "input": None, "output": True},
        {"instruction": None, "input": 5, "output": LONG},
        {"input": "i", "output": LONG},
    ]
    frame = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(lines)], "i int, line string")
    got = {r.i: r.text for r in training_text(training_rows_from_lines(frame), keep=("i",)).collect()}
    assert got == {
        0: (SYSTEM + shown("user", LONG)).strip(),
        1: LONG,
        2: f"### Instruction\n{LONG}\n### Input\nNone\n### Output\nTrue",
        3: f"### Instruction\nNone\n### Input\n5\n### Output\n{LONG}",
    }


@pytest.mark.parametrize("row", [{"messages": "m"}, {"messages": [{"role": "user"}]}, {"text": 0},
                                 {"text": None}, {"text": False}, {"text": []}, {"messages": {}, "text": ""}])
def test_unusable_values_fall_through(spark, row):
    line = json.dumps({**row, "instruction": LONG})
    frame = spark.createDataFrame([(line,)], "line string")
    assert training_text(training_rows_from_lines(frame)).first().text.startswith("### Instruction")


@pytest.mark.parametrize("line", ["{bad", "[1]", "null", '{"text": "t"} x', '{"text": "t"}}'])
def test_a_line_that_is_not_an_object_stops_the_read(spark, line):
    frame = spark.createDataFrame([(line,)], "line string")
    with pytest.raises(Exception, match="MALFORMED"):
        training_rows_from_lines(frame).collect()


def brute_force(turns):
    """Training text of whole conversations."""
    by_conversation = {}
    for conv, turn, role, text in turns:
        by_conversation.setdefault(conv, []).append((turn, role, text))
    result = {}
    for conv, items in by_conversation.items():
        items.sort(key=lambda t: (t[0], t[1] or "", t[2] or ""))
        known = [(role, text) for _, role, text in items]
        if any(None in turn for turn in known):
            continue
        text = "" if items[0][1] == "system" else SYSTEM
        text = (text + "".join(shown(*turn) for turn in known)).strip()
        if len(text) > 40:
            result[conv] = text[:12000]
    return result


def test_hot_conversation(spark):
    limit = head_turns(12000, CHATML)
    turns = [(0, t, "user" if t % 2 else "assistant", "") for t in range(3 * limit)]
    turns += [(1, t * 7, "user", "x" * (t % 90)) for t in range(2 * limit)]
    turns += [(2, 3, "user", "copy")] * (2 * limit)
    turns += [(3, 0, "system", "s"), (3, 1, "user", "y" * 13000), (3, 2, "user", "z")]
    turns += [(4, t, "user", " " * 100) for t in range(limit + 1)]
    turns += [(5, t, "tool", "shown as well") for t in range(2 * limit)]
    turns += [(5, 9000, "system", "late"), (5, 9001, "user", "shown")]
    turns += [(6, t, "user", "x") for t in range(2 * limit)] + [(6, 9000, "user", None)]
    turns += [(7, 0, "tool", None), (7, 1, "system", "s"), (7, 2, "user", "u" * 50)]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    frame = frame.repartition(7)
    got = {r.conv_id: r.text for r in training_text(chats(frame), keep=("conv_id",)).collect()}
    assert got == brute_force(turns)
    assert set(got) == {0, 1, 2, 3, 4, 5}
    assert chats(frame).agg(F.max(F.size("messages"))).first()[0] == limit + 1


def test_a_long_conversation_changes_no_other(spark):
    rows = [(c, t, "tool" if t == 1 else "user", f"{c} {t} " * 9) for c in range(5) for t in range(c + 1)]
    rows += [(8, 0, "user", "a"), (8, 0, None, "b")]
    long = [(9, t, "user", "x" * 30) for t in range(1200)]
    schema = "conv_id long, turn long, role string, text string"
    alone, beside = (
        {r.conv_id: r.messages for r in chats(spark.createDataFrame(part, schema)).collect()}
        for part in (rows, rows + long)
    )
    assert {c: m for c, m in beside.items() if c != 9} == alone
    texts_of = training_text(chats(spark.createDataFrame(rows, schema)), keep=("conv_id",))
    assert {r.conv_id: r.text for r in texts_of.collect()} == brute_force(rows)


def test_a_template_with_little_markup_is_refused(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    with pytest.raises(ValueError, match="turns show"):
        chats(rows, ChatTemplate("", "", ""))


def test_long_conversations_are_cut_on_the_map_side(spark, plan):
    rows = spark.range(2000).selectExpr(
        "id % 2 as conv_id", "id as turn", "'user' as role", "cast(id as string) as text"
    )
    assert plan(chats(rows)).count("Partial") == 2


def test_head_turns_fill_the_text():
    shortest = len("<|im_start|>" + "\n" + "<|im_end|>\n")
    assert head_turns(12000, CHATML) * shortest >= 12000 + len("<|im_end|>\n")


def test_tokens(spark):
    frame = spark.createDataFrame([(1, "é" * 300), (2, "ab"), (3, "")], "id int, text string")
    got = {r.id: r for r in tokenize(frame, utf8_bytes, keep=("id",)).collect()}
    assert got[1].input_ids == list(("é" * 300).encode())[:MAX_TOKENS]
    assert (got[2].input_ids, got[2].attention_mask) == ([97, 98], [1, 1])
    assert got[3].input_ids == got[3].attention_mask == []
    assert "text" not in tokenize(frame, utf8_bytes).columns


def test_tokenizer_is_loaded_once_per_task_and_cut(spark):
    def load():
        loaded = [0]

        def encode(batch, limit):
            loaded[0] += 1
            return [[loaded[0]] * (limit + 5) for _ in batch]

        return encode

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        frame = spark.range(0, 6, 1, 1).select(F.lit("t").alias("text"))
        got = [r.input_ids for r in tokenize(frame, load, max_length=3).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    # One tokenizer sees all batches of the task.
    assert got == [[1] * 3] * 2 + [[2] * 3] * 2 + [[3] * 3] * 2


def test_library_tokenizer(spark):
    def load():
        from tokenizers import Tokenizer, models, pre_tokenizers

        model = models.WordLevel({"[UNK]": 0, "hello": 1, "world": 2}, unk_token="[UNK]")
        tokenizer = Tokenizer(model)
        tokenizer.pre_tokenizer = pre_tokenizers.Whitespace()

        def encode(batch, limit):
            tokenizer.enable_truncation(limit)
            return [e.ids for e in tokenizer.encode_batch(list(batch))]

        return encode

    frame = spark.createDataFrame([("hello world again",)], "text string")
    assert tokenize(frame, load, max_length=2).first().input_ids == [1, 2]


def test_tokenizer_travels_without_the_package(tmp_path):
    code = "import pickle, sys; print(pickle.load(sys.stdin.buffer)()(['é'], 9)[0].tolist())"
    sent = cloudpickle.dumps(utf8_bytes)
    env = {k: w for k, w in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", code], input=sent, capture_output=True, cwd=tmp_path, env=env
    )
    assert run.stdout.decode().strip() == "[195, 169]", run.stderr


def test_word_pieces(spark):
    frame = spark.createDataFrame([("Ab1, é" + " w" * 600,)], "text string")
    got = frame.select(word_pieces(F.col("text")).alias("p")).first().p
    assert got[:4] == ["Ab1", ",", "é", "w"]
    assert len(got) == MAX_TOKENS

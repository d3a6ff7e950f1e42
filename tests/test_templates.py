"""Translated chat templates against plain Python renderings of the same templates."""

import itertools

import pytest
from pyspark.sql import functions as F

from scriptorium.operators.chat import training_text
from scriptorium.operators.templates import TemplateError, compile_template
from scriptorium.plans import standins as st

CHAT = "messages array<struct<role:string,content:string>>"

MODEL_TURNS = """{{ bos_token }}{% if messages[0]['role'] == 'system' %}{{ raise_exception('System role not supported') }}{% endif %}
{%- for message in messages %}
{% if (message['role'] == 'user') != (loop.index0 % 2 == 0) %}
{{ raise_exception('Conversation roles must alternate') }}
{% endif %}
{% if message['role'] == 'assistant' %}
{% set role = 'model' %}
{% else %}
{% set role = message['role'] %}
{% endif %}
{{ '<start_of_turn>' + role + '\\n' + message['content'] | trim + '<end_of_turn>\\n' -}}
{% endfor %}
{% if add_generation_prompt %}{{ '<start_of_turn>model\\n' }}{% endif %}"""

LABELLED = """{# a header for each turn #}{% for m in messages -%}
{% if loop.first and m.role not in ['system', 'user'] %}[{{ loop.length ~ '/' ~ loop.index }}]{% elif m.role is none or not m.content %}?{% else %}<|{{ m.role | upper }}|>
{{ m.content.split('</think>')[-1].strip() if '</think>' in m.content else m.content }}{{ eos_token }}{% endif %}
{% if not loop.last %} + {% endif %}
{%- endfor %}
{%- if tools is defined %}tools{% endif %}
{%- if messages[-1].role == 'assistant' and messages | length > 1 %} (answered){% endif %}"""


def alternating(chat):
    opening = ""
    if chat[0][0] == "system":
        opening, chat = f"<<SYS>>\n{chat[0][1].strip()}\n<</SYS>>\n\n", chat[1:]
    text = ""
    for i, (role, content) in enumerate(chat):
        if (role == "user") != (i % 2 == 0):
            return None
        content = (opening + content if i == 0 else content).strip()
        text += {"user": f"<s>[INST] {content} [/INST]", "assistant": f" {content} </s>"}.get(role, "")
    return text


def model_turns(chat):
    text = "<bos>"
    for i, (role, content) in enumerate(chat):
        if (role == "user") != (i % 2 == 0):
            return None
        text += f"<start_of_turn>{'model' if role == 'assistant' else role}\n{content.strip()}<end_of_turn>\n"
    return text


def labelled(chat):
    text = ""
    for i, (role, content) in enumerate(chat):
        if i == 0 and role not in ("system", "user"):
            text += f"[{len(chat)}/1]"
        elif role is None or not content:
            text += "?"
        else:
            text += f"<|{role.upper()}|>\n{content.split('</think>')[-1].strip() if '</think>' in content else content}<eos>"
        if i < len(chat) - 1:
            text += " + "
    return text + (" (answered)" if chat[-1][0] == "assistant" and len(chat) > 1 else "")


CASES = {
    "alternating": (st.ALTERNATING, {"bos_token": "<s>", "eos_token": "</s>"}, alternating),
    "model turns": (MODEL_TURNS, {"bos_token": "<bos>"}, model_turns),
    "labelled": (LABELLED, {"eos_token": "<eos>"}, labelled),
}
CONTENTS = ["q", " padded\n", "é 中 ", "", "<think>x</think>  y ", "100% {x} {{ y }}"]


def chats():
    roles = ["system", "user", "assistant", "tool"]
    every = [c for n in (1, 2, 3) for c in itertools.product(roles, repeat=n)]
    every += [("system", *["user", "assistant"] * 4), tuple(["user", "assistant"] * 40)]
    return [[(r, CONTENTS[(i + n) % len(CONTENTS)]) for i, r in enumerate(c)] for n, c in enumerate(every)]


@pytest.mark.parametrize("name", CASES)
def test_texts_are_those_of_a_plain_rendering(spark, name):
    source, given, plain = CASES[name]
    template = compile_template(source, **given)
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(chats())], f"i int, {CHAT}")
    found = {r.i: r.t for r in rows.select("i", template.rendered(F.col("messages")).alias("t")).collect()}
    assert found == {i: plain(c) for i, c in enumerate(chats())}
    assert sum(t is not None for t in found.values()) > 2


@pytest.mark.parametrize("name", CASES)
def test_texts_of_all_conversations(spark, name):
    source, given, plain = CASES[name]
    turns = st.table(spark, "/root/testdata/sf0.01", "conversations").orderBy("conv_id", "turn").collect()
    whole = {c: [(t.role, t.text) for t in g] for c, g in itertools.groupby(turns, lambda t: t.conv_id)}
    rows = spark.createDataFrame(list(whole.items()), f"conv_id long, {CHAT}")
    found = rows.select("conv_id", compile_template(source, **given).rendered(F.col("messages")).alias("t")).collect()
    assert {r.conv_id: r.t for r in found} == {i: plain(c) for i, c in whole.items()}


def test_a_chat_is_void_where_a_text_is_missing(spark):
    rows = spark.createDataFrame([(None,), ([],), ([("user", None)],), ([("user", "a"), (None, "b")],)], CHAT)
    template = compile_template("{% for m in messages %}{{ m.role + m.content }}{% endfor %}")
    assert [r.t for r in rows.select(template.rendered(F.col("messages")).alias("t")).collect()] == [None] * 4


def test_a_raise_makes_the_row_fall_back(spark):
    good, bad = [("user", "q" * 50)], [("assistant", "q" * 50)]
    rows = spark.createDataFrame([(1, good, "t" * 50), (2, bad, "t" * 50), (3, bad, None)], f"id int, {CHAT}, text string")
    found = training_text(rows, compile_template(MODEL_TURNS), keep=("id",)).collect()
    assert {r.id: r.text[:15] for r in found} == {1: "<start_of_turn>", 2: "t" * 15}


def test_rendering_is_part_of_the_plan(spark, plan):
    rows = spark.createDataFrame([([("user", "a")],)], CHAT)
    text = plan(rows.select(compile_template(MODEL_TURNS).rendered(F.col("messages")).alias("t")))
    assert "Exchange" not in text and "Python" not in text.replace("PythonRDD", "")


@pytest.mark.parametrize(
    "source",
    [
        "{% for m in messages %}",
        "{% if x %}a",
        "{% macro f() %}{% endmacro %}",
        "{{ messages | tojson }}",
        "{{ messages }}",
        "{{ namespace(a=1) }}",
        "{% for a, b in messages %}{% endfor %}",
        "{{ 'a' + }}",
        "{{ messages[::-1] }}",
        "{{ messages.role }}",
        "{{ [x for x in messages] }}",
        "{% endif %}",
    ],
)
def test_what_is_not_supported_is_refused(spark, source):
    with pytest.raises(TemplateError):
        compile_template(source)

import re

import pytest
from pyspark.sql import functions as F

from chatscope.operators import chat_template as CT
from chatscope.operators import template as T
from chatscope.plans import fixtures as FX
from chatscope.plans.templates import CHATML, INST, MARKERS
from chatscope.schemas import MESSAGES
from tests.conftest import SF_SMALL

CHATS = [
    (1, [("system", " Be brief. ", []), ("user", "Hi\n", []), ("assistant", "Hello", [])], '[{"name":"f"}]'),
    (2, [("user", "Weather?", []), ("assistant", None, [("look", [("city", "Oslo"), ("at", "now")]), ("stop", [])])], "[]"),
    (3, [], None), (4, [("tool", "x", [])], "null"), (5, None, None),
]


@pytest.fixture(scope="module")
def chats(spark):
    return spark.createDataFrame(CHATS, f"id long, messages {MESSAGES}, tools_json string")


def rendered(chats, source, **names):
    out = CT.ChatTemplate(source).render(messages=CT.value(chats, "messages"), **names)
    return {r.id: r.t for r in chats.select("id", out.alias("t")).collect()}


@pytest.mark.parametrize("source, want", [
    ("{% for m in messages %}{{ m.role }}{% if not loop.last %},{% endif %}{% endfor %}", "system,user,assistant"),
    ("{% for m in messages %}{{ loop.index ~ loop.index0 ~ loop.length }};{% endfor %}", "103;213;323;"),
    ("{{ messages[0]['role'] }} {{ messages[-1].role | upper }} {{ messages[7].role }}", "system ASSISTANT "),
    ("{{ messages | length }}{{ messages[1:] | length }}{{ messages[:-1] | length }}{{ messages[-2:-1] | length }}", "3221"),
    ("{% for m in messages[1:] %}{{ m['content'].strip() + '|' }}{% endfor %}", "Hi|Hello|"),
    ("{% set a = 'x' %}{% for m in messages %}{% set a = a + m.role %}{% endfor %}{{ a }}", "x"),
    ("{% if messages[0].role == 'user' %}{% set s = 'u' %}{% elif messages[0].role == 'system' %}{% set s = 's' %}"
     "{% endif %}{{ s }}", "s"),
    ("{{ 'a' if messages[0].role != 'system' else 'b' }}{{ none or 'c' }}{{ 'd' if false }}", "bc"),
    ("{{ messages[0].nothing | default('none') }}{{ messages[0].nothing is defined }}{{ 'role' in messages[0] }}", "noneFalseTrue"),
    ("{{ 'Be' in messages[0].content }}{{ 'x' not in messages[0].content }}{{ 7 % 3 + 1 - 2 }}{{ 1 + 7 % 3 }}", "TrueTrue02"),
    ("{{ messages[0].content.startswith(' Be') and 2 > 1 and not 1 >= 2 }}", "True"),
    ("{{ messages[1].content | tojson }}{{ 3 | tojson }}{{ messages[0].content | trim | replace('Be', 'B') | lower }}",
     '"Hi\\n"3b brief.'),
    ("a\n  {% if true %}\n  b\n  {% endif %}\nc\n", "a\n  b\nc"),
    ("a \n {%- if true -%} \n b {{- ' c ' -}} \n d{# note #}{% endif %}\n\ne", "ab c d\ne"),
    ("  {# note #}\n  {{ 'x' }}\n", "  x"),
    ("{{ '\\'q\\' \\n' ~ \"d\" }}", "'q' \nd"),
    ("{{ a }}{{ b }}{{ c }}", "x5True"),
])
def test_language(chats, source, want):
    assert rendered(chats, source, a="x", b=5, c=True)[1] == want


def test_calls_tools_and_items(chats):
    got = chats.select("id", CT.ChatTemplate(
        "{% for m in messages %}{% for c in m.tool_calls %}{{ c.name }}({% for k, v in c.arguments | dictsort %}"
        "{{ k }}={{ v }}{{ '' if loop.last else ',' }}{% endfor %}){% endfor %}{% endfor %}"
        "{% if tools %}{% for x in tools %}{{ x.name }}{{ x | tojson }}{{ x is mapping }}{{ x.y is defined }}{% endfor %}{% endif %}"
    ).render(messages=CT.value(chats, "messages"), tools=CT.Value(F.try_parse_json("tools_json"), CT.t.VariantType())).alias("t"))
    assert {r.id: r.t for r in got.collect()} == {
        1: 'f{"name":"f"}TrueFalse', 2: "look(at=now,city=Oslo)stop()", 3: "", 4: "", 5: ""}


def test_raising_rows_are_null(chats):
    got = rendered(chats, "{% for m in messages %}{% if m.role == 'tool' %}{{ raise_exception('no tools') }}{% endif %}"
                          "{{ m.role }}{% endfor %}")
    assert got == {1: "systemuserassistant", 2: "userassistant", 3: "", 4: None, 5: ""}
    rows = {r.id: r for r in CT.with_template(chats, INST, "messages", bos_token="<s>", eos_token="</s>").collect()}
    assert rows[4].full is None and not rows[4].prefix_ok and rows[4].completion is None
    assert rows[1].prefix_ok and rows[1].prompt + rows[1].completion == rows[1].full


@pytest.mark.parametrize("source", [
    "{% for m in messages %}", "{% endif %}", "{% if x %}{% else %}{% elif y %}{% endif %}", "{{ 1 + }}", "{{ x", "{% macro f() %}",
    "{{ namespace(a=1) }}", "{{ messages | nofilter }}", "{{ messages.append(1) }}", "{{ messages[0] }}", "{{ messages.role }}",
    "{% for k, v in messages %}{% endfor %}", "{% for m in 'text' %}{% endfor %}", "{{ messages[0].nothing }}", "{{ 'a' < 1 }}",
    "{{ messages | trim('x', 'y') }}", "{% for m in messages if m.role %}{% endfor %}", "{{ 'a' is odd }}", "{{ a @ b }}",
    "{{ (1 }}", "{% set x = 'a' if messages else 1 %}", "{{ messages[x] }}", "{% include 'f' %}"])
def test_unsupported_is_an_error_at_compile_time(chats, source):
    with pytest.raises(CT.TemplateError):
        CT.ChatTemplate(source).render(messages=CT.value(chats, "messages"))


def test_default_markers_as_a_template(spark, chats):
    """The marker spec and the same format written as a template give equal rows."""
    for df in (chats.where("id < 4"), FX.chats(spark, SF_SMALL).withColumn("tools_json", F.lit("[]"))):
        key = df.columns[0]
        want = T.with_rendered(df, "messages", "tools_json").orderBy(key).collect()
        got = CT.with_template(df, MARKERS, "messages", "tools_json").orderBy(key).collect()
        assert [(r.full, r.prompt, r.completion, r.prefix_ok, r.last_role) for r in got] == [
            (r.full, r.prompt, r.completion, r.prefix_ok, r.last_role) for r in want]


def test_no_python_in_the_plan(spark):
    df = CT.with_template(FX.chats(spark, SF_SMALL), CHATML)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)

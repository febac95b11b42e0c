import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfline.llm import chat_template as c

HOSTILE = st.one_of(st.text(max_size=30), st.lists(st.sampled_from(
    [*c.CONTROL_STRINGS, "\\", "\n", "<", "|", "a", "[IN", "ST]", "<|im_", "end|>", "assistant"]), max_size=8).map("".join))


@settings(max_examples=300, deadline=None)
@given(HOSTILE)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    for way in (c.escape, c.escape_line):
        assert c.unescape(way(text)) == text
        assert not any(x in way(text) for x in c.CONTROL_STRINGS)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), HOSTILE), HOSTILE), max_size=6), st.integers(1, 40))
def test_turns_read_back(turns, size):
    pieces = list(c.Template(c.DEFAULT_TEMPLATE).render(messages=({"role": r, "text": t} for r, t in turns)))
    text = "".join(p for p, _ in pieces)
    assert list(c.read_turns(text[i:i + size] for i in range(0, len(text), size))) == turns
    assert "".join(c.unescape(p) for p, marked in pieces if marked) == "".join(t for r, t in turns if r == "assistant")


def shown(source, **variables):
    return "".join(p for p, _ in c.Template(source).render(**variables))


@pytest.mark.parametrize("source, expected", [
    ("a{{ 1 + 2 }}b{{ 'x' ~ 1 ~ none }}", "a3bx1"), ("{% if x == 1 %}one{% elif x > 5 %}big{% else %}other{% endif %}", "big"),
    ("{% for i in items %}{{ loop.index }}{{ i }}{% if not loop.last %},{% endif %}{% endfor %}", "1p,2q"),
    ("{% set y = x + 1 %}{{ y }}", "10"), ("{{ items[1] | upper }}{{ items[7] }}{{ d.k['z'] }}", "Q3"),
    ("{{ 'q' in items and x }}{{ 'z' not in items }}", "9true"), (" a {#- no -#} b", " a  b"), (" a {{- ' ' -}} b ", "a b "[0:0] + " a b "),
    ("{% if false %}{{ nothing.at.all }}{% endif %}{{ missing }}", ""), ("{{ items | length }}{{ (x) }}{{ \"d\\\"\\n\" }}", "29d\"\n"),
    ("{% if false or true %}{% for i in none %}no{% endfor %}yes{% endif %}", "yes"),
])
def test_language(source, expected):
    assert shown(source, x=9, items=["p", "q"], d={"k": {"z": 3}}) == expected


@pytest.mark.parametrize("source", ["{{ }}", "{{ a b }}", "{% if x %}", "{% endif %}", "{{ x | unknown }}", "{{ x", "{% import os %}",
                                    "{% for in x %}{% endfor %}", "{{ f() }}", "{{ 'a }}", "{% set = 1 %}", "{{ not }}", "{{ x. }}"])
def test_broken_templates(source):
    with pytest.raises(c.TemplateError):
        c.Template(source)


def test_sandbox_and_folding():
    assert shown("{{ x.__class__ }}{{ x['__len__'] }}{{ f.__globals__ }}", x="s", f=shown) == ""
    tree = c.fold(c.parse("a{{ 'b' | upper }}{% if 1 == 1 %}c{% else %}{{ x }}{% endif %}d{{ x }}"))
    assert tree == [c.Output(c.Const("aBcd")), c.Output(c.Name("x"))]


def digest(rows, size=c.PART_CHARS):
    turns = "".join(f"{r}\n{t}\n" for r, t in rows)
    loss = "".join(t for r, t in rows if r == "assistant")
    return len(rows), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_conversations_on_spark(spark):
    rows = [(1, 2, "assistant", "b <|im_end|>"), (1, 1, "user", None), (1, 1, None, "x\\"), (1, 1, None, "x\\"), (2, None, "assistant", ""),
            (2, 0, "assistant", "é" * 200_000), (None, 1, "user", "u"), (None, 0, "assistant", "v")]
    rows += [(3, i, "assistant" if i % 2 else "user", f"turn {i} [INST] " * 3) for i in range(2000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")
    formatted = c.format_conversations(df, part_chars=1000)
    assert formatted.where("conv_id = 3").count() > 50
    got = {r["conv_id"]: r for r in c.read_back(formatted).collect()}
    for key in (1, 2, 3, None):
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))
        own = [(r[2] or "", r[3] or "") for r in own]
        text = "".join(p for p, _ in c.Template(c.DEFAULT_TEMPLATE).render(messages=[{"role": r, "text": t} for r, t in own]))
        r = got[key]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == digest(own)
        assert r["formatted_chars"] == len(text)
    assert c.read_back(c.format_conversations(df.where("false"))).collect() == []
    names = c.read_back(c.format_conversations(df.selectExpr("cast(conv_id as string) AS conv_id", "turn", "role", "text"))).collect()
    assert {r["conv_id"] for r in names} == {"1", "2", "3", None}


@pytest.mark.parametrize("source, expected", [
    ("{{ none | escape }}|{{ 5 | upper }}|{{ true | trim }}|{{ 'ab' | length }}", "|5|true|2"),
    ("{% if x %}{{ 5 | length }}{{ 'a' < 1 }}{% endif %}ok", "ok"),
    ("{{ 'a' ~ none ~ 1 }}", "a1"),
])
def test_folding_keeps_the_meaning(source, expected):
    assert "".join(t for t, _ in c.Template(source).render()) == expected


def test_constants_that_fail_do_so_when_rendered():
    template = c.Template("{{ 5 | length }}")
    with pytest.raises(TypeError):
        list(template.render())


@pytest.mark.parametrize("source", [
    "{% for m in messages %}a{% endfor %}{% for m in messages %}b{% endfor %}",
    "{% for x in messages %}{% for m in messages %}a{% endfor %}{% endfor %}",
    "{{ messages | length }}", "{% if messages %}a{% endif %}", "{{ messages[i] }}", "{{ messages[64] }}", "{{ messages['role'] }}",
    "{% set x = messages %}", "{% set messages = 'a' %}",
])
def test_uses_of_messages_that_a_stream_cannot_serve(spark, source):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    with pytest.raises(c.TemplateError):
        c.format_conversations(df, source)


def test_messages_by_number(spark):
    source = ("{% if messages[0].role == 'system' %}<{{ messages[0].text }}>{% for m in messages %}{{ m.text }}/{{ messages[2].text }},{% endfor %}"
              "{% else %}{% for m in messages %}{{ m.text }};{% endfor %}{% endif %}")
    rows = [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 3, "user", "d"), (2, 0, "user", "x"), (3, 0, "system", "t")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r["text"] for r in c.format_conversations(df, source).collect()}
    assert got == {1: "<s>s/b,a/b,b/b,d/b,", 2: "x;", 3: "<t>t/,"}


@pytest.mark.parametrize("portions", [1, 2, 7, 40])
@pytest.mark.parametrize("source", [
    c.DEFAULT_TEMPLATE,
    "<{{ messages[1].text }}{% for m in messages %}{{ loop.index }}{% if loop.first %}F{% endif %}{% generation %}{{ m.role }}:{{ m.text | escape }}"
    "{% endgeneration %}{% if loop.last %}L{% else %},{% endif %}{{ messages[2].text }}{% endfor %}>{{ messages[0].role }}",
    "{% if messages[3].text %}many{% generation %}{% for m in messages %}{{ m.text }}{% for x in none %}{% endfor %}{% endfor %}{% endgeneration %}"
    "{% else %}few {{ messages[0].text }}{% endif %}.",
])
def test_a_conversation_over_several_portions(spark, source, portions):
    rows = [(1, i // 2 if i else None, "assistant" if i % 2 else "user", f"{i} </s> é" * (i % 5)) for i in range(300)]
    rows += [(1, 7, "user", "same")] * 30 + [(1, 8, "r" * 200 + str(i), "x" * 300 + str(i % 3)) for i in range(20)]
    rows += [(k, 0, "user", "a") for k in range(2, 9)] + [(None, i, "assistant", str(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got: dict = {}
    for r in sorted(c.format_conversations(df, source, part_chars=64, portions=portions).collect(), key=lambda r: r["part"]):
        text, marked, parts = got.get(r["conv_id"], ("", "", 0))
        assert (r["part"], r["start"]) == (parts, len(text))
        text += r["text"]
        got[r["conv_id"]] = (text, marked + "".join(text[s["start"]:s["stop"]] for s in r["loss"]), parts + 1)
    assert got.keys() == {r[0] for r in rows}
    for key, (text, marked, _) in got.items():
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1], r[2], r[3]))
        pieces = list(c.Template(source).render(messages=c.Messages([{"role": r[2], "text": r[3]} for r in own], 4)))
        assert text == "".join(p for p, _ in pieces)
        assert marked == "".join(p for p, m in pieces if m)

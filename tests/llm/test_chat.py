"""The template language and the chat format."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vintagecast.llm import chat, template
from vintagecast.llm.template import Const, If, Print, Text, TemplateError, compile_template, fold, parse


def show(source, **values):
    return compile_template(source)(values)[0]


def test_language():
    assert show("a{# note #}b{{ x }}{{ 1 + 2 }}", x="é") == "abé3"
    assert show("{% for m in ms %}{{ loop.index }}{% if not loop.last %},{% endif %}{% endfor %}", ms=[1, 2, 3]) == "1,2,3"
    assert show("{% if a == 'x' %}1{% elif a == 'y' and b %}2{% else %}3{% endif %}", a="y", b=True) == "2"
    assert show("{% set k = m['a'].b %}{{ k | upper ~ '!' }}", m={"a": {"b": "q"}}) == "Q!"
    assert show("{{ 'yes' if 'a' in t else 'no' }}{{ u is defined }}{{ u | default('d') }}", t="abc") == "yesfalsed"
    assert show("{{ l[0] }}{{ l[-1] }}{{ l[9] }}{{ l | length }}{{ -2 - -3 }}{{ (1 < 2) and 'ok' }}", l=["a", "b"]) == "ab21ok"
    assert show("{{ '\\n\\'' }}{{ none }}{{ true }}{{ 'a' not in 'b' }}") == "\n'truetrue"
    assert show("{% for x in xs %}{% set y = x %}{{ y }}{% endfor %}{{ y }}", xs=["1"]) == "1"


def test_generation_spans_are_code_points():
    text, spans = compile_template("😀{% generation %}{{ a }}b{% endgeneration %}c{% generation %}{% endgeneration %}")({"a": "éé"})
    assert text == "😀éébc" and spans == [(1, 4)]


def test_folding():
    assert fold(parse("a{{ 1 + 1 }}b{% if 'x' == 'x' %}c{% else %}{{ z }}{% endif %}")) == (Text("a2bc"),)
    assert fold(parse("{% if false and x %}a{% endif %}")) == ()
    (node,) = fold(parse("{% if x and true %}{{ 'a' ~ 'b' | upper }}{% endif %}"))
    assert isinstance(node, If) and node.then == (Text("aB"),)
    assert fold(parse("{{ x ~ (1 + 2) }}"))[0].expr.args[1] == Const(3) and isinstance(fold(parse("{{ x }}"))[0], Print)


@pytest.mark.parametrize("bad", ["{{ x", "{% if x %}", "{% endif %}", "{{ x.__class__() }}", "{{ 1 + }}", "{{ x | nothing }}", "{% for in x %}{% endfor %}", "{{ a b }}", "{% include 'f' %}", "{{ " + "(" * 200 + "1" + ")" * 200 + " }}", "{% if x %}" * 100])
def test_what_is_no_template(bad):
    with pytest.raises(TemplateError):
        compile_template(bad)


def test_sandbox():
    assert show("{{ x.__class__ }}{{ x['__class__'] }}{{ f.a }}", x="s", f=len) == ""
    with pytest.raises(TemplateError):
        show("{{ x }}", x=object())
    with pytest.raises(TemplateError):
        show("{{ 'a' + 1 }}")


PARTS = [*chat.CONTROL, "\\", "<", "[", "/", "s>", "INST]", "a", "é", " ", "\n", "<<", "SYS>>"]
SAID = st.one_of(st.text(max_size=12), st.lists(st.sampled_from(PARTS), max_size=10).map("".join))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "tool", ""]), SAID), SAID), max_size=6))
def test_turns_come_back(turns):
    render = compile_template(chat.TEMPLATE, {"escape": chat.escape})
    text, spans = render({"messages": [{"role": r, "text": t} for r, t in turns]})
    assert chat.read_back(text) == turns
    for r, t in turns:
        assert chat.unescape(chat.escape(t)) == t and not any(c in chat.escape(t) for c in chat.CONTROL)
    assert "".join(chat.unescape(text[s:e]) for s, e in spans) == "".join(t for r, t in turns if r == "assistant")


def test_format_conversations(spark):
    rows = [(1, 1, "assistant", "</s>b\\"), (1, 0, "user", "[INST]"), (2, None, None, None), (2, 0, "system", "é"), (None, 0, "user", "q"), (1, 1, "assistant", "</s>b\\"), (3, 5, "assistant", "")]
    rows += [(9, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(25)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    made = chat.format_conversations(frame)
    by = {r["conv_id"]: r for r in made.collect()}
    got = {r["conv_id"]: r for r in chat.digests(made).collect()}
    assert set(got) == {1, 2, 3, 9, None} and len(by) == 5
    for conv in got:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in own]
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[conv]["n_turns"] == len(turns) == by[conv]["n_turns"]
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv]["formatted_chars"] == len(by[conv]["formatted"])
    assert chat.digests(chat.format_conversations(frame.limit(0))).count() == 0


def test_chunks_give_back_whole_conversations(spark):
    said = lambda i: ["[INST]é", "</s>b\\", "", None, "x" * (i % 40)][i % 5]
    rows = [(c, i, ["user", "assistant", "tool", None][i % 4], said(i + (c or 0))) for c, n in [(1, 3), (2, 1), (3, 3000), (4, 1), (None, 900), (5, 0)] for i in range(n)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chunks = chat.format_chunks(frame, chunk_chars=100)
    parts = {}
    for r in chunks.collect():
        assert len(r["text"]) < 100 + 100 and r["n_turns"]
        parts.setdefault(r["conv_id"], []).append(r)
    whole = {r["conv_id"]: r for r in chat.format_conversations(frame).collect()}
    assert set(parts) == set(whole) and len(parts[3]) > 100
    for conv, own in parts.items():
        own.sort(key=lambda r: r["part"])
        assert [r["part"] for r in own] == list(range(len(own)))
        assert "".join(r["text"] for r in own) == whole[conv]["formatted"]
        assert [(r["start"] + s["start"], r["start"] + s["end"]) for r in own for s in r["spans"]] == [(s["start"], s["end"]) for s in whole[conv]["spans"]]
    for n in (1, 100, chat.CHUNK_CHARS):
        got = chat.digest_chunks(chat.format_chunks(frame, chunk_chars=n)).collect()
        assert sorted(map(str, got)) == sorted(map(str, chat.digests(chat.format_conversations(frame)).collect()))
    assert chat.digest_chunks(chat.format_chunks(frame.limit(0))).count() == 0


def test_template_module_has_no_way_out():
    assert not hasattr(template, "eval") and "getattr" not in open(template.__file__).read()

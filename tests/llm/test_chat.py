"""Template language and exact round trips of formatted conversations."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF001
from parcelkit.llm import chat


def render(template, messages=()):
    return "".join(t for t, _ in chat.compile_template(template)(list(messages)))


@pytest.mark.parametrize("template,text", [
    ("a{{ 'b' ~ 1 + 2 }}c", None), ("{{ 'x' + \"y\\n\" }}", "xy\n"), ("{{ 1 + 2 }}", "3"), ("{{ true }}{{ none }}", "true"),
    ("{% if 1 == 2 %}no{% elif 'a' in 'cab' %}yes{% else %}no{% endif %}", "yes"),
    ("{% for m in messages %}{{ loop.index }}{{ m.role }}{% if not loop.last %},{% endif %}{% endfor %}", "1u,2a"),
    ("{% set x = messages %}{% for m in x %}{{ m['text'] | upper | trim }}{% endfor %}", "HIYO"),
    ("{#note#} {%- if messages and not false or 1 > 2 -%}  k  {%- endif %}", "k"),
    ("{{ ('a' | upper) ~ (2 >= 2) }}", "Atrue")])
def test_language(template, text):
    messages = [{"role": "u", "text": " hi"}, {"role": "a", "text": "yo "}]
    if text is None:
        with pytest.raises(chat.TemplateError):
            render(template, messages)
    else:
        assert render(template, messages) == text


@pytest.mark.parametrize("bad", ["{{ a( }}", "{{ m.x | run }}", "{% for m %}{% endfor %}", "{% if 1 %}", "{% go %}", "{{ 1 1 }}",
                                 "{{ }}", "{% endif %}", "{% generation %}x", "{{ f() }}"])
def test_errors_are_found_when_compiling(bad):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(bad)


@pytest.mark.parametrize("template", ["{{ messages.__class__ }}", "{{ 'a'.upper }}", "{{ open }}", "{{ (1).real }}"])
def test_sandbox(template):
    with pytest.raises(chat.TemplateError):
        render(template, [{"role": "u", "text": "x"}])


def test_constants_fold():
    tree = chat.fold(chat.parse("a{{ 'b' ~ 'c' }}{% if 1 == 1 %}d{% else %}{{ x }}{% endif %}{{ 'e' | upper }}"))
    assert tree == ("block", [("text", "abcdE")])


texts = st.text(alphabet=st.sampled_from(list("\\<>|[]/sINTim_endbox \n\U0001f600é")), max_size=60) | st.lists(
    st.sampled_from([*chat.CONTROL, "\\", "<", "[", "x"]), max_size=6).map("".join)


@settings(max_examples=300, deadline=None)
@given(texts)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text and not any(c in out for c in chat.CONTROL)


def digest(rows):
    rows = [(r or "", t or "") for r, t in rows]
    said = "".join(t for r, t in rows if r == "assistant")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(rows), sha("".join(f"{r}\n{t}\n" for r, t in rows)), len(said), sha(said)


ROWS = [(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "a\\<|im_end|>\\"), (1, 2, "assistant", "\\\\<s>"),
        (2, None, None, None), (2, 5, "assistant", ""), (2, 5, "assistant", "b"), (2, 5, "assistant", "b"),
        (None, 1, "assistant", "no id"), (None, 2, "tool\n", "x"), (3, 9, "system", "x" * 5000),
        *((4, i, "assistant" if i % 2 else "user", f"<|im_sep|>{i}\\" * (i % 50)) for i in range(3000))]


@pytest.mark.parametrize("part", [1, 7, 1000, chat.PART])
def test_round_trip(spark, part):
    df = spark.createDataFrame([(*r, 1) for r in ROWS], "conv_id long, turn long, role string, text string, part int")
    formatted = chat.format_conversations(df, part=part)
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    for key in {r[0] for r in ROWS}:
        mine = sorted((r for r in ROWS if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert tuple(got[key])[1:5] == digest([r[2:] for r in mine])
    whole = {}
    for r in formatted.collect():
        whole.setdefault(r.conv_id, []).append((r.part, r.text))
    for key, parts in whole.items():
        text = "".join(t for _, t in sorted(parts))
        assert len(text) == got[key].formatted_chars
        assert text.count(chat.OPEN) == text.count(chat.CLOSE) == got[key].n_turns


def test_empty_table_and_query(spark, queries):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(df)).count() == 0
    got = {r.conv_id: r for r in queries["op9_chat_formatting"](spark, SF001).collect()}
    assert tuple(got[-7])[1:5] == digest([("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")])
    rows = {}
    for r in spark.read.parquet(f"{SF001}/conversations.parquet").orderBy("conv_id", "turn", "role", "text").collect():
        rows.setdefault(r.conv_id, []).append((r.role, r.text))
    assert len(got) == len(rows) + 1
    for key, mine in rows.items():
        assert tuple(got[key])[1:5] == digest(mine)

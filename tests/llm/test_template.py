import pytest

from marquee.llm.chat import CHATML, FILTERS, escape, escape_line, read_turns, unescape, unescape_line
from marquee.llm.template import BEGIN, END, FILTERS as PLAIN, STEP, Const, TemplateError, Write, compile_template, fold, parse, reads_once


def render(source, **names):
    return "".join(p for p in compile_template(source, FILTERS)(**names) if isinstance(p, str))


def test_values_loops_and_conditions():
    source = (
        "{%- set x = 'a' ~ 1 -%} {{ x }}:{% for m in ms %}{% if loop.first %}<{% elif loop.last %}>{% else %},{% endif %}"
        "{{ m.t | upper | trim }}{{ loop.previtem.t }}{% endfor %}{# gone #}"
    )
    assert render(source, ms=[{"t": " p "}, {"t": "q"}, {"t": "r"}]) == "a1:<P,Q p >Rq"
    assert render("{{ 1 + 2 }}{{ 'a' in 'cat' and not false }}{{ none }}{{ ('x' or y) }}") == "3Truex"


def test_fold_leaves_only_what_varies():
    tree = fold(parse("a{% if 1 + 1 == 2 %}b{{ 'c' | upper }}{% else %}{{ z }}{% endif %}d", PLAIN))
    assert tree == (Write(Const("abCd")),)
    assert fold(parse("{% if false %}a{% endif %}", PLAIN)) == ()


def test_sandbox():
    assert render("{{ x.__class__ }}{{ x['__len__'] }}{{ open }}", x="text") == ""
    for source in ("{{ x() }}", "{{ x | eval }}", "{% import os %}", "{{ x", "{% if x %}", "{% endfor %}", "{{ 'a }}", "{{ }}"):
        if source == "{{ x":
            assert render(source) == "{{ x"
            continue
        with pytest.raises(TemplateError):
            compile_template(source)


def test_markers_and_lazy_messages():
    def messages():
        yield {"role": "user", "text": "q"}
        yield {"role": "assistant", "text": "r"}
        raise AssertionError("pulled too early")

    parts = compile_template(CHATML, FILTERS)(messages=messages())
    seen = []
    for part in parts:
        seen.append(part)
        if part is STEP:
            break
    assert seen[-1] is STEP and BEGIN not in seen
    whole = list(compile_template(CHATML, FILTERS)(messages=[{"role": "assistant", "text": "r"}]))
    assert whole.index(BEGIN) + 2 == whole.index(END)


@pytest.mark.parametrize("text", ["", "<|", "<|im_end|>\n<|im_start|>x\ny", r"<\|a<\\|", "<<||", "\n<|\n", "a" * 10000])
def test_escapes_are_reversible(text):
    assert unescape(escape(text)) == text and "<|" not in escape(text)
    assert unescape_line(escape_line(text)) == text and "\n" not in escape_line(text)
    formatted = render(CHATML, messages=[{"role": text, "text": text}, {"role": "assistant", "text": text}])
    assert read_turns(formatted) == [(text, text), ("assistant", text)]


def test_items_and_length():
    ms = [{"role": "system"}, {"role": "user"}, {"role": "assistant"}]
    source = (
        "{% if messages[0].role == 'system' %}s{% endif %}{{ messages[-1]['role'] }}{{ messages | length }}"
        "{{ messages[7] }}{% for m in messages %}{{ m.role }},{% endfor %}{% for m in messages %}{{ loop.index }}{% endfor %}"
    )
    assert render(source, messages=ms) == "sassistant3system,user,assistant,123"
    with pytest.raises(TemplateError):
        render("{{ x | length }}", x=5)


def test_reads_once():
    assert reads_once(CHATML, "messages", FILTERS) and reads_once("no messages", "messages")
    assert reads_once("{% if x %}{% for m in messages %}{{ m.t }}{% endfor %}{% endif %}", "messages")
    for source in (
        "{{ messages[0].t }}", "{% set x = messages %}", "{{ messages | length }}",
        "{% for m in messages %}{% endfor %}{% for m in messages %}{% endfor %}",
        "{% for n in ns %}{% for m in messages %}{% endfor %}{% endfor %}",
    ):
        assert not reads_once(source, "messages")

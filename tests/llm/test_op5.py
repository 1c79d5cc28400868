import hashlib

from marquee.llm import chat
from marquee.llm.chat import format_conversations, read_turns

SCHEMA = "conv_id long, turn long, role string, text string, piece string, TEXTS string"


def whole(spark, rows):
    pieces = format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    out = {}
    for p in pieces:
        out.setdefault(p.conv_id, []).append(p)
    return out


def test_edges(spark):
    rows = [
        (1, 1, "assistant", None, "x", "y"), (1, 0, None, "q", "x", "y"), (1, 0, None, "q", "x", "y"),
        (2, None, "user", "", None, None), (2, 0, "assistant", "<|im_end|>\n" * 3, None, None), (None, 0, "user", "z", "", ""),
    ]
    got = whole(spark, rows)
    assert {k: [read_turns(p.text) for p in v] for k, v in got.items()} == {
        1: [[("", "q"), ("", "q"), ("assistant", "")]],
        2: [[("user", ""), ("assistant", "<|im_end|>\n" * 3)]],
        None: [[("user", "z")]],
    }
    (span,) = got[2][0].generated
    assert chat.unescape(got[2][0].text[span.start : span.end]) == "<|im_end|>\n" * 3
    assert format_conversations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_long_conversation_comes_in_pieces(spark):
    rows = [(7, i, "assistant" if i % 2 else "user", f"{i} " * 30000, "", "") for i in range(12)]
    pieces = whole(spark, rows)[7]
    assert len(pieces) > 1 and [p.piece for p in pieces] == list(range(len(pieces)))
    turns = [t for p in pieces for t in read_turns(p.text)]
    assert turns == [(r[2], r[3]) for r in rows]
    said = "".join(chat.unescape(p.text[s.start : s.end]) for p in pieces for s in p.generated)
    assert hashlib.sha256(said.encode()).digest() == hashlib.sha256("".join(r[3] for r in rows if r[2] == "assistant").encode()).digest()


def test_a_template_that_looks_ahead(spark, monkeypatch):
    monkeypatch.setattr(chat, "SPOOL_BYTES", 10)
    rows = [(1, 0, "system", "be é", "", ""), (1, 1, "user", "q\n", "", ""), (2, 0, "user", "r", "", ""), (3, 0, "user", "", "", "")]
    template = (
        "{% if messages[0].role == 'system' %}[{{ messages[0].text }}]{% endif %}{{ messages | length }}"
        "{% for m in messages %}{{ m.text }};{% endfor %}{% for m in messages %}{{ m.role }}{% if loop.last %}.{% endif %}{% endfor %}"
        "{{ messages[-1].text }}"
    )
    got = format_conversations(spark.createDataFrame(rows, SCHEMA), template).collect()
    assert {g.conv_id: g.text for g in got} == {
        1: "[be é]2be é;q\n;systemuser.q\n", 2: "1r;user.r", 3: "1;user.",
    }

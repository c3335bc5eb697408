import hashlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from apportion.llm import chat, chat_template
from apportion.llm.chat import conversation_digests, format_conversations, read_turns, with_marked_conversation
from apportion.llm.chat_template import Const, If, Output, TemplateError, compile_template, escape, fold, parse, unescape

ROWS = "conv_id long, turn long, role string, text string"


def rendered(template, messages):
    return "".join(t for t, _ in compile_template(template)(messages))


@given(st.text(alphabet="<\\|ab>[]/s\n", max_size=30))
def test_escape_round_trip(text):
    assert unescape(escape(text)) == text and "<|" not in escape(text)


def test_language():
    m = [{"role": "user", "text": " hi "}, {"role": "bot", "text": None}]
    assert rendered("{% for x in messages %}{{ loop.index }}:{{ x.text | trim | upper }};{% endfor %}", m) == "1:HI;2:NONE;"
    assert rendered("{% for x in messages %}{% if x.role == 'user' and not loop.index0 %}U{% elif 1 > 2 %}no{% else %}B{% endif %}{% endfor %}", m) == "UB"
    assert rendered("{% set a = 2 + 3 * 4 %}{{ a }}{{ 'x' ~ 1 }}{{ 'ab' in 'cab' }}{{ messages[0]['role'] }}", m) == "14x1Trueuser"
    assert rendered("a  {{- 'b' -}}  c", []) == "abc"
    pieces = list(compile_template("p{% generation %}q{{ 1 }}{% endgeneration %}r")([]))
    assert [(t, g) for t, g in pieces] == [("p", False), ("q1", True), ("r", False)]


def test_constants_are_folded():
    tree = fold(parse("a{{ 1 + 2 }}b{% if 2 > 1 %}c{% else %}d{% endif %}{{ 'X' | lower }}"))
    assert tree == (Output(Const("a3bcx")),)
    assert isinstance(fold(parse("{% if x %}a{% endif %}"))[0], If)


@pytest.mark.parametrize("bad", ["{{ open('x') }}", "{% for x in y %}", "{{ a | nofilter }}", "{% import os %}", "{{ 1 + }}", "{{ a b }}"])
def test_outside_the_language(bad):
    with pytest.raises(TemplateError):
        compile_template(bad)


def test_no_python_attributes():
    for source in ("{{ 'x'.__class__ }}", "{{ 'x'.upper }}", "{{ messages.append }}"):
        with pytest.raises(TemplateError):
            rendered(source, [])


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append((r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
    out = Counter()
    for conv, turns in groups.items():
        turns = [(t[3], t[5]) for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        whole = "".join(f"{chat.TURN}{escape(r)}{chat.TEXT}{escape(t)}{chat.END}" for r, t in turns)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv, len(turns), digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), digest(loss), len(whole)] += 1
    return out


def test_odd_conversations(spark, monkeypatch):
    monkeypatch.setattr(chat, "PART_CHARS", 100)
    rows = [
        (1, 0, "user", "hello <|end|>\n"), (1, 1, "assistant", "<|turn|>user<\\|text|>"), (1, 2, "assistant", ""), (1, 3, "assistant", None), (2, 0, "assistant", "a" * 3000),
        (2, 1, "user", None), (3, None, None, "no role"), (3, None, None, "no role"), (None, 0, "user", "x"), (None, 1, "assistant", "é漢😀<|"), (4, 5, "system\n<|x", "tie"), (4, 5, "assistant", "tie"),
    ]
    rows += [(7, k, "assistant" if k % 2 else "user", f"message {k} <") for k in range(60)]
    df = with_marked_conversation(spark.createDataFrame([(*r, "clash") for r in rows], ROWS + ", part string").repartition(5))
    said = "</s>[INST] ok [/INST]"
    parts = format_conversations(df)
    assert Counter(tuple(r) for r in conversation_digests(parts).collect()) == brute([*rows, (-7, 0, "user", said), (-7, 1, "assistant", said)])
    assert parts.where("conv_id = 7").count() > 3 and parts.where("length(formatted) > 3200").count() == 0


def test_no_rows(spark):
    assert conversation_digests(format_conversations(spark.createDataFrame([], ROWS))).collect() == []


def test_reader_rejects_other_text():
    with pytest.raises(ValueError):
        list(read_turns("hello<|text|>x<|end|>\n"))

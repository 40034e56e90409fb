"""Chat formatting: layouts by fingerprint, a template that reads back what it wrote, digests against plain Python."""

import hashlib
import json
import random
import re
from collections import defaultdict

import pytest
from rankhouse.llm.chat_format import (
    END,
    HOSTILE,
    LAYOUTS,
    START,
    Chooser,
    Each,
    Layout,
    canonical_turns,
    escape,
    fingerprint,
    format_chat,
    formatted,
    op11_chat_format,
    parsed,
    paths_of,
    read_chat,
    turns_of,
    unescape,
    unmapped,
)
from rankhouse.llm.common import read_table

SCHEMA = "conv_id long, turn long, role string, text string, record string, layout string, prompt string"


def brute(rows):
    """Digests of (conv_id, turn, role, text) rows, without the formatted length."""
    conversations = defaultdict(list)
    for conv, turn, role, text in rows:
        conversations[conv].append((turn is not None, turn or 0, role is not None, (role or "").encode(), text is not None, (text or "").encode()))
    out = []
    for conv, turns in conversations.items():
        turns.sort()
        said = b"".join(role + b"\n" + text + b"\n" for *_, role, _, text in turns)
        learnt = b"".join(text for *_, role, _, text in turns if role == b"assistant")
        out.append((conv, len(turns), hashlib.sha256(said).hexdigest(), len(learnt.decode()), hashlib.sha256(learnt).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def conversations(spark):
    def build(rows):
        return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)

    return build


def same(got, rows):
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == brute(rows)


def test_escape_is_reversible_and_leaves_no_marker():
    draw = random.Random(2)
    parts = ["<", "|", "\\", ">", "n", "\n", START, END, "im_start", "é", " "]
    for _ in range(5000):
        role, text = ("".join(draw.choice(parts) for _ in range(draw.randint(0, 9))) for _ in range(2))
        assert unescape(escape(text)) == text and "<|" not in escape(text)
        whole, low, high = formatted(role, text)
        assert parsed(whole * 3) == [(role, text)] * 3
        assert unescape(whole[low:high]) == text
        assert whole.count(START) == whole.count(END) == 1


def test_text_of_another_template_is_refused():
    for text in ("hello", START + "user\nx", "x" + END + "\n"):
        with pytest.raises(ValueError):
            parsed(text)


RECORDS = [
    ({"messages": [{"role": "system", "content": "s"}, {"role": "human", "content": "u"}, {"role": "model", "content": None}]}, "messages", [("system", "s"), ("user", "u"), ("assistant", "")]),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}], "name": "n"}]}, "messages", [("user", "ab")]),
    ({"id": 7, "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]}, "from and value", [("user", "q"), ("assistant", "r")]),
    ({"system": "s", "conversations": [{"from": "tool", "value": 5}]}, "from and value", [("system", "s"), ("tool", "5")]),
    ({"instruction": "i", "input": "", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "x", "output": "o", "system": ""}, "instruction", [("user", "i\n\nx"), ("assistant", "o")]),
    ({"prompt": "p", "completion": "c"}, "prompt and completion", [("user", "p"), ("assistant", "c")]),
    ({"prompt": "p", "response": "c", "system": "s"}, "prompt and response", [("system", "s"), ("user", "p"), ("assistant", "c")]),
    ({"prompt": [{"role": "user", "content": "p"}], "completion": [{"role": "gpt", "content": "c"}]}, "chat prompt", [("user", "p"), ("assistant", "c")]),
    ({"question": "q", "context": "c", "answer": {"b": 1, "a": [2]}}, None, None),
    ({"question": "q", "context": "c", "answer": True, "meta": {"role": 1}}, "question and answer", [("user", "c\n\nq"), ("assistant", "true")]),
    ({"role": "user", "text": "t", "turn": 3}, "turn rows", [("user", "t")]),
    ({"prompt": "p"}, None, None),
    ({"prompt": "p", "completion": "c", "response": "d"}, None, None),
    ({"messages": []}, None, None),
    ([], None, None),
    ("text", None, None),
]


def test_layouts_are_chosen_by_fingerprint():
    chooser = Chooser()
    for record, name, turns in RECORDS:
        _, layout = chooser.choose(record)
        assert (layout and layout.name) == name, record
        if layout:
            assert turns_of(record, layout) == turns


def test_fingerprints():
    assert paths_of({"a": [{"b": 1}, {"c": None}], "d": {}, "e": []}) == {".a[].b", ".a[].c", ".d", ".e[]"}
    assert fingerprint({".a", ".b"}) == fingerprint({".b", ".a"}) != fingerprint({".a.b"})
    with pytest.raises(ValueError, match="told apart"):
        Chooser([*LAYOUTS, Layout("again", (".role", ".text"), (Each("", "role", "text"),))])


def test_records_to_text(spark):
    rows = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(RECORDS)] + [(90, "{"), (91, None), (92, '{"prompt": "\\ud800", "response": "[" }')]
    turns = canonical_turns(spark.createDataFrame(rows, "conv_id long, record string").repartition(2))
    blocks = format_chat(turns).collect()
    got = {b.conv_id: parsed(b.text) for b in blocks}
    want = {i: t for i, (_, _, t) in enumerate(RECORDS) if t} | {92: [("user", "�"), ("assistant", "[")]}
    assert got == want
    assert sum(r.n for r in unmapped(turns).collect()) == len(rows) - len(want)
    assert {r.n for r in unmapped(turns).where("fingerprint IS NULL").collect()} == {2}


def test_awkward_rows(conversations):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (2, None, "assistant", "no number"), (2, 0, None, "no role"),
        (None, 0, "user", "no conversation"), (None, 0, "assistant", "é" * 300), (3, 5, "a\nb\\n<|im_end|>", HOSTILE), (3, 5, "a", "<\\|x<|"),
        (4, 0, "assistant", "퟿\U0001f600 \x00 "), (5, 7, "assistant", "later"), (5, -7, "assistant", "sooner"),
    ]
    hostile = [(-1, 0, "user", HOSTILE), (-1, 1, "assistant", HOSTILE)]
    same(op11_chat_format(conversations(rows)), rows + hostile)


def test_conversations_over_many_blocks_and_tasks(spark, conversations):
    draw = random.Random(6)
    rows = [(0, t, draw.choice(["user", "assistant"]), "x" * draw.randint(0, 40)) for t in range(600)]
    rows += [(c, t, "assistant", f"{c} {t}") for c in range(1, 60) for t in range(3)]
    turns = canonical_turns(conversations(rows).selectExpr("conv_id", "turn", "to_json(struct(role, text)) AS record"), turn="turn")
    blocks = format_chat(turns, block_chars=300).cache()
    parts = {b.part for b in blocks.collect() if b.conv_id == 0}
    assert len(parts) > 1  # the large conversation is formatted by more than one task
    assert blocks.where("NOT partial").count() > 40
    same(read_chat(blocks), rows)
    blocks.unpersist()


def test_very_long_text(conversations):
    rows = [(1, 0, "user", "<|" * 1_200_000), (1, 1, "assistant", "w " * 1_200_000), (2, 0, "assistant", "short")]
    same(op11_chat_format(conversations(rows)), rows + [(-1, 0, "user", HOSTILE), (-1, 1, "assistant", HOSTILE)])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert [r.conv_id for r in op11_chat_format(empty).collect()] == [-1]
    assert format_chat(canonical_turns(empty)).count() == 0


def test_query(spark, small):
    table = read_table(spark, small, "conversations")
    got = op11_chat_format(table)
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()] + [(-1, 0, "user", HOSTILE), (-1, 1, "assistant", HOSTILE)]
    same(got, rows)
    chars = {r.conv_id: r.formatted_chars for r in got.collect()}
    marks = len(START) + len(END) + 2
    assert chars[-1] == 2 * (marks + len(re.sub(r"<\|", r"<\\|", HOSTILE))) + len("userassistant")

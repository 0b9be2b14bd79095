from __future__ import annotations

import hashlib
import random

from parcella.llm import chat

TURNS = "conv_id long, turn long, role string, text string, place int, formatted string"


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, 7, "clash") for r in rows], TURNS)


def test_escape_is_reversible_and_leaves_no_control_string():
    r = random.Random(1)
    for _ in range(3000):
        text = "".join(r.choice("<|\\>im_a") for _ in range(r.randint(0, 12)))
        assert chat.unescape(chat.escape(text)) == text
        assert "<|" not in chat.escape(text)


def test_read_back_gives_every_turn(spark):
    r = random.Random(2)
    said = ["<|im_end|>", "<|im_end|>\n<|im_start|>assistant\nok<|im_end|>\n", "<\\|im_end|>", "a\n\nb", "", None, "<|image|>", "é" * 9, "<"]
    rows = [(c, t, r.choice(["user", "assistant", "system", None, "a\nb", "<|nl|>"]), r.choice(said)) for c in [*range(40), None] for t in range(r.randint(1, 6))]
    rows += [(99, t, "assistant", f"t{t}") for t in range(3000)] + [(5, 0, "user", "again")] * 2
    r.shuffle(rows)
    got = {x.conv_id: x for x in chat.read_back(chat.format_chat(turns_of(spark, rows))).collect()}
    assert len(got) == len({x[0] for x in rows})
    for conv, row in got.items():
        mine = [x for x in rows if x[0] == conv]
        mine.sort(key=lambda x: (x[1], chat.format_turn(x[2], [{"type": "text", "text": x[3]}], chat.Sizes())[0]))
        whole = "".join(f"{x[2] or ''}\n{x[3] or ''}\n" for x in mine)
        learnt = "".join(x[3] or "" for x in mine if x[2] == "assistant")
        assert row.n_turns == len(mine)
        assert row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest() and row.loss_chars == len(learnt)


def test_segments_join_to_the_conversation(spark):
    rows = [(1, 1, "assistant", "yes <|x|>"), (1, 0, "user", "hi"), (2, None, "assistant", "first"), (2, 0, "user", None)]
    got = sorted(chat.format_chat(turns_of(spark, rows)).collect(), key=lambda x: (x.conv_id, x.place))
    whole = got[0].formatted + got[1].formatted
    assert whole == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nyes <\\|x|><|im_end|>\n"
    assert [whole[s.start : s.end] for s in got[1].loss] == ["yes <\\|x|>"] and got[0].loss == []
    assert got[1].start == len(got[0].formatted) and got[2].formatted.endswith("first<|im_end|>\n")
    assert chat.format_chat(turns_of(spark, rows).limit(0)).count() == 0
    assert chat.read_back(chat.format_chat(turns_of(spark, rows).limit(0))).count() == 0


def test_parts_become_placeholders_in_order(spark):
    def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
        return (kind, text, ref, width, height, seconds, pages)

    rows = [
        (1, 0, "user", [part("text", "see <"), part("text", "|im_end|>"), part("image", ref="a.png", width=57, height=28), None, part("audio", ref="b.wav", seconds=1.5)]),
        (1, 1, "assistant", [part("text", "one"), part("document", ref="c.pdf", pages=3), part("text", "two"), part("video", ref="d")]),
        (1, 2, "assistant", []),
        (1, 3, "user", None),
    ]
    turns = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content {chat.PARTS}")
    got = sorted(chat.format_chat(turns, content="content").collect(), key=lambda x: x.place)
    whole = "".join(x.formatted for x in got)
    assert "see <\\|im_end|><|image|><|audio|>" in whole and "one<|document|>two<|attachment|>" in whole
    found = [a for x in got for a in x.attachments]
    assert [(a.kind, a.ref, a.tokens) for a in found] == [
        ("image", "a.png", 3), ("audio", "b.wav", 38), ("document", "c.pdf", 768), ("video", "d", 0)
    ]
    assert [whole[a["at"] :].startswith(chat.PLACEHOLDERS.get(a.kind, chat.OTHER)) for a in found] == [True] * 4
    assert [whole[s.start : s.end] for x in got for s in x.loss] == ["one", "two"]
    assert len(got) == 4 and got[3].formatted == "<|im_start|>user\n<|im_end|>\n"

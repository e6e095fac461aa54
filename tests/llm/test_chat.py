"""Perspective rotation: the joined rows are the plainly rendered dialogue."""

import re

from tabula.llm import chat

ROWS = ([(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi <|end|> é"), (1, 2, "bob", "Hello"), (1, 3, "cy", None),
         (1, 4, "ann", ""), (2, 0, "system", "alone"), (3, 5, "ann", "late"), (3, 5, "ann", "late"), (3, None, "bob", "no turn"),
         (3, 2, None, "no role"), (None, 1, "dee", "no conversation"), (None, 0, "eve", "x" * 30000)]
        + [(9, i, ["ann", "bob"][i % 2], f"turn {i}") for i in range(1000)])


def plain(rows, conv, who):
    clean = lambda t: t.replace("<|", "< |").replace("|>", "| >")
    own = sorted((r for r in rows if r[0] == conv),
                 key=lambda r: (r[1] is None, r[1] or 0, r[2] is None, r[2] or "", r[3] or ""))
    text, masks = "", []
    for _, _, role, body in own:
        name = "system" if role == "system" else "assistant" if role == who else f"user name={role}" if role else "user"
        text += f"<|start|>{name}\n"
        start = len(text)
        text += clean(body or "") + "<|end|>"
        if role == who:
            masks.append((start, len(text)))
        text += "\n"
    return text, masks


def test_joined_rows_are_the_dialogue(spark):
    frame = spark.createDataFrame([(*r, "z") for r in ROWS], "conv_id long, turn long, role string, text string, block string")
    got = {}
    for r in chat.rotate(frame).collect():
        got.setdefault((r["conv_id"], r["perspective"]), []).append(r)
    want = {(c, w) for c, _, w, _ in ROWS if w not in (None, "system")}
    assert got.keys() == want
    for (conv, who), rows in got.items():
        rows.sort(key=lambda r: r["position"])
        assert [r["position"] for r in rows] == list(range(1, len(rows) + 1))
        text, masks = plain(ROWS, conv, who)
        assert "".join(r["segment"] for r in rows) == text
        assert [(r["mask_start"], r["mask_end"]) for r in rows if r["mask_start"] is not None] == masks
        assert all(text[r["seg_start"]:r["seg_end"]] == r["segment"] for r in rows)


def test_empty_and_native(spark):
    from tests.conftest import SF_SMALL
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.rotate(frame).count() == 0
    plan = chat.op9(spark, SF_SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)

"""A table of several layouts: each row is read by its own."""

from __future__ import annotations

from tidemark.llm import chat


def test_mixed_layouts(spark):
    kind = "conv_id long, messages array<struct<role:string,content:string>>, prompt string, response string, turn long, role string, text string"
    rows = [
        (1, [("user", "hi"), ("assistant", "yo")], None, None, None, None, None),
        (2, None, "hi", "yo", None, None, None),
        (3, [], "hi", None, None, None, None),
        (4, None, None, None, 5, "user", "hi"),
        (5, None, None, None, None, None, None),
        (6, [], None, None, None, None, None),
        (None, None, "hi", "yo", None, None, None),
    ]
    got = sorted((tuple(r) for r in chat.to_turns(spark.createDataFrame(rows, kind)).collect()), key=str)
    two = [(0, "user", "hi"), (1, "assistant", "yo")]
    want = [(1, *x) for x in two] + [(2, *x) for x in two] + [(3, 0, "user", "hi"), (3, 1, "assistant", ""), (4, 5, "user", "hi")] + [(None, *x) for x in two]
    assert got == sorted(want, key=str)
    lists = spark.createDataFrame([(1, None), (2, [])], "conv_id long, messages array<struct<role:string,content:string>>")
    assert chat.to_turns(lists).count() == 0

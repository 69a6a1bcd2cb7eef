"""Rows that operators meet seldom."""

from __future__ import annotations

LOREM = "the quick brown fox jumps over the lazy dog and runs far away from all the noise of the old town "


def odd_rows() -> list[tuple]:
    """Nulls in any column, empty and long texts, ties, copies, repeated rows, unusual white space and characters."""
    long = " ".join(f"word{i % 977} and{i}" for i in range(12_000))
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n ", None, None, 3), (4, "12 34 !!", "en", "b", 8),
        (5, LOREM, "en", "b", 90), (6, LOREM + " ", "en", None, 91), (7, LOREM.replace(" ", "\t"), "en", "c", 90),
        (8, LOREM * 3, "en", "c", 270), (9, LOREM * 3 + "end", "en", "c", 273), (10, long, "en", "d", len(long)),
        (11, "a" * 5000, "de", "d", 5000), (12, "été à la plage où l'eau est  bleue　日本", "fr", "é", 40),
        (13, "x " + passage + " y z", "en", "a", 0), (14, passage + " " + passage, "en", "b", 0),
        (15, "one two", "en", "c", 7), (16, "ONE two", "en", "c", 7), (17, "I'm he'll  <|endoftext|> \x85 \x1c end ", "en", "a", 9),
        (None, "no id here, only a text", "en", "a", 5), (18, "the same row", "en", "b", 1), (18, "the same row", "en", "b", 1),
    ]
    return rows

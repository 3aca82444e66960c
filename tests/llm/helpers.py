"""Small tables and plain definitions that the tests compare with."""

from __future__ import annotations

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

PROSE = (
    "the sun rose over the quiet town and every street was still while the baker opened his door and set out warm "
    "loaves for the early walkers who came down from the hill with baskets and songs and news of the harvest that "
    "had been brought in late because of the long rain which filled each ditch and turned the fields to mud"
)


def frame(spark, rows, schema=SCHEMA):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in rows] if schema == SCHEMA else rows
    return spark.createDataFrame(rows, schema)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


#: NULL and empty texts, blanks, repeated rows, ties of doc_id, one long text, odd characters.
AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, PROSE),
    (5, PROSE),
    (5, PROSE.upper()),
    (6, PROSE + " extra"),
    (None, PROSE),
    (None, None),
    (7, "a " * 3000),
    (8, "ü€😀 " * 60 + "\x1cx"),
    (9, "l1 a\n\nl2 b\nl3 c\nl4 d\nl1 a\nl2 b\nl3 c"),
    (10, "l1 a\nl2 b\nl3 c"),
]

"""Rows that no operator may stumble over."""

from pyspark.sql import functions as F

#: Names that operators use inside or return; as extra columns they must not clash.
CLASHING = (
    "key", "row", "n_tokens", "score", "node", "group", "spans", "h", "x", "_row", "_stats",
    "_spans", "signature", "held_out", "word", "c", "bucket", "similarity", "item", "host", "path",
)
LONG = "word%d other, " * 2000
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts():
    filler = "the quick brown fox jumps over the lazy dog near the old mill by the river bank today"
    return [
        (1, filler), (1, filler), (2, filler + " again"), (None, None), (None, ""), (3, ""),
        (4, "  "), (5, "x"), (6, "a\tb\n\nc"), (7, LONG % tuple(range(2000))),
        (8, "mail ab.c@mail1.example.com or call +1 (555) 123-4567 é 日本 😀"), (9, filler),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    full = [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def clashing(df):
    return df.withColumns({c: F.lit("odd") for c in CLASHING if c not in df.columns})


def same_rows(a, b):
    """Whether two frames hold the same rows, in any order."""
    return sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))

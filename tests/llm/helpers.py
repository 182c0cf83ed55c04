"""Frames with the awkward rows that every operator must take."""

from __future__ import annotations

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use for columns of their own.
CLASHES = ("fp", "score", "row", "sequence_id", "offset", "shard", "slot", "rank", "size", "taken", "part", "mark", "key", "root")


def documents(spark, rows):
    """(doc_id, text[, source]) as documents."""
    return spark.createDataFrame([(i, t, "en", s[0] if s else "a", None if t is None else len(t)) for i, t, *s in rows], DOCS)


def with_clashes(df):
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHES)])


AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "two words"), (None, "no id here at all"), (6, "a b c " * 5000),
           (7, "same text in two rows"), (7, "same text in two rows"), (8, "same text in two rows"), (9, "é ü \x1c x​  y\r\n\nz 'tis don't"),
           (10, "<|endoftext|> mid <|endoftext|>dle"), (11, "x" * 20000), (12, "\U0001f600 smile \U0001f600")]

"""Small tables with the awkward cases that every operator has to define."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LONG = "wort " * 30_000 + "ende"
NORMAL = "the quick brown fox jumps over the lazy dog and runs far away from the big bad wolf of the dark wood today"

#: (doc_id, text, lang, source)
EDGE = [
    (1, NORMAL, "en", "a"),
    (2, NORMAL.upper(), "en", "a"),
    (3, NORMAL + " indeed", "en", "b"),
    (4, None, None, None),
    (5, "", "en", "b"),
    (6, " \t\n\x0b\f\r", "en", None),
    (7, LONG, "de", "a"),
    (8, "one two", "en", "a"),
    (8, "one two", "en", "a"),          # a repeated row
    (8, "another text under the same id", "en", "b"),
    (None, NORMAL, "en", "a"),
    (None, None, None, "b"),
    (9, "ÀÉ ſ Kelvin K \u00a0 \u2028 日本 🙂 <|endoftext|>", "xx", "é"),
    (10, "x" * 5000, "en", "a"),
]

#: Names that the operators use for columns of their own.
CLASHES = ("_llm_row", "_llm_text", "_llm_pieces", "keep_id", "kept", "size", "target", "ids", "decoded", "words", "bands",
           "score", "label", "blob", "spans", "index", "block", "norm", "held_out", "failed", "hash", "bucket", "_id", "s", "a", "b")


def stored(df: DataFrame) -> DataFrame:
    """The frame as a stored table."""
    path = f"{tempfile.mkdtemp(prefix='llm-test-')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def documents(spark: SparkSession, rows=EDGE, clashes: bool = False) -> DataFrame:
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    full = [(*r, None if r[1] is None else len(r[1])) for r in rows]
    if clashes:
        schema += "".join(f", {c} string" for c in CLASHES)
        full = [(*r, *["clash"] * len(CLASHES)) for r in full]
    return stored(spark.createDataFrame(full, schema).coalesce(2) if full else spark.createDataFrame([], schema))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    key = lambda rows: sorted(map(repr, rows))
    return key([tuple(r) for r in a.collect()]) == key([tuple(r) for r in b.select(*a.columns).collect()])

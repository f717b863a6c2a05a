"""Inputs that every operator must get through, and small conveniences."""

import zlib

from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=False):
    """``rows`` of (doc_id, text) or (doc_id, text, lang); with ``extra`` also columns named like results."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or "")) for r in rows]
    schema = DOCS
    if extra:
        names = ["score", "fingerprint", "component_id", "held_out", "n_removed", "kept", "label", "pattern", "batch",
                 "length", "part", "fp", "_rank", "lang_pred", "item_id", "n_bytes", "shard"]
        schema += "".join(f", `{n}` string" for n in names)
        full = [(*r, *["x"] * len(names)) for r in full]
    return spark.createDataFrame(full, schema)


def awkward(spark, extra=True):
    """Nulls, blanks, ties, repeated rows, a very long text, odd characters."""
    long = "word " * 30_000 + "the end"
    rows = [(1, None, "en"), (2, "", "en"), (3, "   \n\t ", None), (4, "a", "de"), (4, "a", "de"), (None, "a null id text", "en"),
            (5, "same text as another one here", "en"), (6, "same text as another one here", "en"), (7, long, "en"),
            (8, "\u0000é\U0001F600 naïve 中文 <|endoftext|>", "fr"), (9, "! ! ! ### $$$", None), (None, None, None)]
    return documents(spark, rows, extra)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def labels(spark, rows):
    return spark.createDataFrame(rows, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("label", T.IntegerType())]))


def fold(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus

"""Small tables with the awkward cases every operator must take."""

from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use inside themselves or return.
CLASHES = ("fp", "key", "rep", "node", "root", "a", "b", "spans", "score", "kept", "n_words", "items", "features", "word", "n", "shard",
           "slot", "part", "size", "found", "h", "toxic", "quality", "component_id", "predicted", "data", "index", "name", "token_ids", "s", "g")


def documents(spark, rows):
    """Documents from (doc_id, text) pairs."""
    return spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in rows], DOCS)


def with_clashes(df, more=()):
    return df.withColumns({c: F.lit("clash") for c in (*CLASHES, *more) if c not in df.columns})


AWKWARD = [
    (1, None), (2, ""), (3, " \t\n "), (None, "a row without an id and some words"), (4, "one"), (5, "one"), (5, "one"),
    (6, "two words"), (7, "the cat sat on the mat and the dog sat on the log " * 400), (8, "ÄÖÜ ß é 中文 😀 ½ \x00 \x1c end"),
    (9, "x" * 5000), (10, "the cat sat on the mat and the dog sat on the log"), (11, "the cat sat on the mat and the dog sat on the log"),
    (None, None), (12, "line\n\nline\n  \nline two\r\nline"),
]


def rows(df, *columns):
    out = [tuple(r) for r in df.select(*columns).collect()] if columns else [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))

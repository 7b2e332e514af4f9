"""Documents with every awkward value; extra columns clash with result names."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("score", T.StringType()),
    T.StructField("size", T.StringType()), T.StructField("fp", T.StringType()), T.StructField("a.b", T.StringType()),
    T.StructField("kept", T.StringType()), T.StructField("_k0", T.StringType()),
])
EXTRA = ("x",) * 6
TEXTS = [
    (1, None, "en", "s1"), (2, "", "en", "s1"), (3, " \t\r\n\x0b\x0c ", None, "s1"), (4, "one", "de", None),
    (5, "the cat and the dog " * 40, "en", "s2"), (5, "the cat and the dog " * 40, "en", "s2"), (6, "12 34 !!", "en", "s2"),
    (None, "the cat and the dog " * 40, None, None), (None, "nothing like it at all", "en", "s3"), (None, "nothing like it at all", "en", "s3"),
    (7, "É\u00a0ß 漢字 \U0001f600 a\u2028b", "fr", "s3"), (8, "word%d " * 3 + " ".join(f"w{i}" for i in range(30_000)), "en", "s1"),
    (9, "x" * 200_000, "en", "s1"), (10, "a b\nc d\na b\n\na b", "en", "s4"), (-11, "A b C", "en", "s4"),
]


def documents(spark):
    return spark.createDataFrame([(i, t, lg, s, None if t is None else len(t), *EXTRA) for i, t, lg, s in TEXTS], SCHEMA)

"""Small tables with awkward rows: nulls, empty and long texts, repeated rows, clashing columns."""

DOCS = (
    "doc_id long, text string, score string, predicted string, n string, sig string, label string, "
    "length string, ids string, _id string, token string"
)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, *["x"] * 9) for i, t in rows], DOCS)


def awkward(long_words=30_000):
    long = " ".join(f"word{i % 997}" for i in range(long_words))
    return [(1, None), (2, ""), (3, " \n "), (4, "a b c"), (4, "a b c"), (None, "no id"), (5, long), (6, "12 !! ??")]

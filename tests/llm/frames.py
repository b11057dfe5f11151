"""Small document tables for the tests."""

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, folder=None):
    """``rows``: (doc_id, text) or (doc_id, text, source); written to ``folder`` if given."""
    full = [(row[0], row[1], "en", row[2] if len(row) > 2 else "s", len(row[1] or "")) for row in rows]
    docs = spark.createDataFrame(full, COLUMNS)
    if folder is None:
        return docs
    docs.repartition(3).write.mode("overwrite").parquet(str(folder))
    return spark.read.parquet(str(folder))


def awkward(n=40, seed=0):
    """Nulls, empty and very long texts, ties and repeated rows."""
    rng = random.Random(seed)
    vocabulary = ["alpha", "Beta", "gamma", "délta", "EPSILON", "zeta,", "ετα", "theta."]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40))), rng.choice(["a", "b", None])) for i in range(n)]
    rows += [(n, None, None), (n + 1, "", "a"), (n + 2, " \n\t ", "b"), (None, "no id", "a"), (None, "no id", "a"),
             (None, None, None), (n + 3, "word " * 30_000, "c"), (n + 4, "x" * 50_000, "c")]
    return rows + rows[:5] + [(n + 10 + i, rows[3][1], "b") for i in range(6)]


def clashing(docs):
    """More columns, with names that operators use themselves."""
    from pyspark.sql import functions as F

    names = ["row", "key", "size", "kept", "id", "score", "bucket", "normal", "start", "length", "__file", "__times", "_metadata_"]
    return docs.withColumns({name: F.lit("theirs") for name in names})


def plain(df, *columns):
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)

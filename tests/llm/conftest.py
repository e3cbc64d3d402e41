import random

import pytest

SF = "/root/testdata/sf0.001"


def words(n, seed, size=400):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(n)) if size else ""


LONG = words(30_000, 1)
BASE = words(120, 2)
NEAR = BASE.rsplit(" ", 3)[0] + " x y z"
RUN = "\n".join(words(30, 10 + k) for k in range(3))  # three lines, 90 words
#: (doc_id, text, lang, source): null, empty, blank, short, long, equal, near, repeated rows, null id.
ROWS = [
    (1, None, "en", "b"), (2, "", "en", None), (3, " \n\t ", "en", "a"), (4, "one two", "fr", "a"),
    (5, LONG, "en", "b"), (6, BASE, "en", "a"), (7, BASE, "en", "a"), (8, NEAR, "en", None),
    (9, NEAR, None, "c"), (9, NEAR, None, "c"), (None, words(40, 3), "fr", "c"), (11, words(60, 4), "fr", "c"),
    (12, f"first\n{RUN}\nlast", "en", "a"), (13, f"other\n{RUN}\nend", "en", "b"),
]
#: Columns that a table may have besides, named like the operators' own.
CLASH = {"_row": "r", "_size": "s", "_copies": "c", "n_words": "w", "kept": "k", "hi": "h", "node": "n", "_id": "i",
         "length": "l", "score": "x", "_verdict": "v", "piece": "p"}


@pytest.fixture(scope="session")
def docs(spark):
    from pyspark.sql import functions as F
    rows = [(d, t, lang, s, None if t is None else len(t)) for d, t, lang, s in ROWS]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *[F.lit(v).alias(c) for c, v in CLASH.items()])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (6, 1, 0), (4, 0, 0), (4, 1, 0), (None, 1, 0), (11, None, 0)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def real(spark):
    return {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "pages")}

"""Small tables with awkward rows, and helpers for brute-force versions."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names clash with ones the operators use themselves.
CLASHING = ("size", "score", "print", "key", "row", "number", "at", "words", "component", "spans", "bins", "label")


def words(text):
    return (text or "").encode().lower().split()


def sentence(rng, n):
    return " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "río", "straße", "eins", "deux"]) + str(rng.randrange(40)) for _ in range(n))


def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, clashing columns."""
    rng = random.Random(1)
    rows = [(i, sentence(rng, rng.randrange(1, 60)), "en", f"src{i % 4}", 0) for i in range(30)]
    rows += [(30, None, None, None, None), (31, "", "en", "src1", 0), (32, " \n\t ", "en", None, 3), (33, "one", "en", "src0", 3)]
    rows += [(None, "no id here at all, sorry", "en", "src2", 1), (None, None, None, None, None)]
    rows += [(34, sentence(rng, 9000), "de", "src3", 1), (35, "x" * 60_000, "de", "src3", 1), (36, rows[0][1], "en", "src9", 1)]
    rows += [rows[1], rows[1]]
    df = spark.createDataFrame(rows, DOCS)
    for name in CLASHING:
        df = df.selectExpr("*", f"'{name}' AS {name}")
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark, rows):
    """(doc_id, text) pairs, or (doc_id, text, source)."""
    return spark.createDataFrame([(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows], DOCS)

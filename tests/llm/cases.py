"""Small documents that every operator must stand: nulls, empty and long texts, ties, repeats, clashing columns."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(seed: int, n: int, vocabulary: int = 5000) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents() -> list[tuple]:
    base = words(1, 300)
    changed = base.split(" ")
    changed[150] = "other"
    passage = words(2, 60)
    texts = {
        1: base, 2: base, 3: " ".join(changed), 4: None, 5: "", 6: "  \n ", 7: "two words", 8: "two words",
        9: words(3, 80) + " " + passage + " " + words(4, 80), 10: words(5, 70) + " " + passage + " " + words(6, 90),
        11: "a " * 3000, 12: words(7, 20_000, 100_000), 13: "Ünïcode — ’s 日本語 　 text",
    }
    rows = [(i, t, "en", ["a", "b", None][i % 3], len(t or "")) for i, t in texts.items()]
    return [*rows, rows[6], (14, words(8, 40), "en", "a", None), (None, words(9, 40), None, None, None)]


def frame(spark, rows=None, schema: str = DOCS):
    return spark.createDataFrame(documents() if rows is None else rows, schema)


def clashing(df):
    """The same rows with columns named like those that operators make."""
    from pyspark.sql import functions as F

    for name in ("row", "key", "size", "shard", "slot", "score", "label", "n", "gram", "u", "bin", "weight", "range", "id", "copies", "target"):
        df = df.withColumn(name, F.lit("x"))
    return df

"""Small tables with the awkward cases that every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

#: Names that operators use inside; as extra columns of the input they must do no harm.
CLASHING = ("fp", "key", "row", "size", "h", "fingerprint", "component_id", "ids", "decoded", "kinds", "score", "_text", "block", "found", "n", "value", "digest", "start")
LETTERS = "abcdefghijklmnop"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return ["".join(rng.choice(LETTERS) for _ in range(2 + k % 5)) for k in (rng.randrange(vocabulary) for _ in range(n))]


def corpus(seed: int = 1) -> list[tuple]:
    """(doc_id, text, lang, source): copies, near copies, shared and repeated passages, nulls, empty, blank and long texts, repeated rows."""
    rng = random.Random(seed)
    base = [words(rng, rng.randrange(1, 160)) for _ in range(40)]
    shared = words(rng, 50)
    texts = [" ".join(w) for w in base]
    texts += [texts[3], texts[3], texts[7].upper(), " ".join([*base[9][:-1], "x"]), " ".join([*base[11], "tail"])]
    texts += [" ".join(base[k] + shared + base[k + 1]) for k in range(12)]
    texts += [" ".join(shared), " ".join(shared[5:45]), " ".join(["same"] * 90), " ".join(base[5] * 3), "a\n\tb\x0b c\xa0d ", "one", "one two", "one two three"]
    texts += ["", "   \n", None, None, "long " + " ".join(words(rng, 30_000)), "é漢字🙂 ▁ <s> [INST] \x00 end", "word" * 3000]
    rows = [(k, t, "en", (None, "b", "a", "", "é")[k % 5] if k % 3 else "hot") for k, t in enumerate(texts)]
    return [*rows, rows[2], rows[2], (None, texts[4], "en", "a"), (None, None, None, None)]


def documents(spark, rows: list[tuple]):
    """Documents with extra columns whose names operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    return df.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASHING))

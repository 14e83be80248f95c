"""Small documents with the awkward cases, and frames made of them."""

import random

from pyspark.sql import functions as F

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "re", "so", "ti", "ve") for b in ("ra", "ne", "li", "do", "mu", "sa", "to", "wi")]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


def documents(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """Ids and texts: prose, copies, near copies, shared passages, empty, null, very short and long texts, repeated rows."""
    rng = random.Random(seed)
    rows: list[tuple[int | None, str | None]] = [(i, prose(rng, rng.randrange(20, 120))) for i in range(60)]
    base = prose(rng, 90)
    rows += [(100 + i, base) for i in range(12)]
    for i in range(25):
        words = base.split()
        words[rng.randrange(len(words))] = f"edit{i}"
        rows.append((200 + i, " ".join(words)))
    passage = prose(rng, 60)
    rows += [(300 + i, f"{prose(rng, 8 + i)}\n{passage}\n{prose(rng, 9 + i)}") for i in range(10)]
    rows += [(400, ""), (401, None), (402, "  \n\t "), (403, "word"), (404, "two words"), (405, "two  WORDS"), (406, "héé ñandú 日本 x"), (407, "word")]
    rows += [(None, rows[3][1]), (None, "a text without an id"), (-5, prose(rng, 30)), (500, prose(rng, 6000)), (501, "ab" * 3000)]
    rows += [rows[5], rows[5], (5, "another text of the same id")]
    return rows


def frame(spark, rows, parts: int = 5):
    """A documents table with more columns than wanted, some with names that operators use themselves."""
    base = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    for name in ("key", "node", "found", "row_id", "_doc", "_gone", "score", "n", "c0", "toxic", "fold", "component_id"):
        base = base.withColumn(name, F.lit(f"own {name}"))
    return base.withColumn("n_chars", F.char_length("text").cast("long")).withColumn("lang", F.lit(None).cast("string"))

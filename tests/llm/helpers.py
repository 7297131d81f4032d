"""Small corpora with the awkward cases that every operator has to stand."""

from __future__ import annotations

import random

WORD = __import__("re").compile(r"[^\x20\x09-\x0D]+")


def corpus(seed: int = 1, n: int = 60) -> list[tuple[int, str | None]]:
    """Random texts, exact and near copies, shared passages, nulls, empty and very long texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4))) for _ in range(120)]

    def text(k: int) -> list[str]:
        return [rng.choice(vocabulary) for _ in range(k)]

    passage = text(40)
    rows: list[tuple[int, str | None]] = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "one two")]
    for i in range(6, n):
        kind, base = rng.random(), rng.choice(rows[3:])[1]
        if kind < 0.2:
            rows.append((i, base))
        elif kind < 0.5:
            words = base.split()
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((i, rng.choice([" ", "\n", "  "]).join(words)))
        elif kind < 0.7:
            rows.append((i, " ".join(text(rng.randint(0, 30)) + passage + text(rng.randint(0, 30)))))
        else:
            rows.append((i, " ".join(text(rng.randint(1, 90)))))
    rows.append((n, " ".join(["again"] * 3000 + text(3000))))
    rng.shuffle(rows)
    return rows


def frame(spark, rows, extra: bool = True):
    """Documents, with columns whose names an operator might want for itself."""
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        docs = docs.selectExpr("doc_id", "text", "'x' AS score", "7 AS n_words", "true AS kept", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    return docs.repartition(3)

"""Small document tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as extra columns of the input.
CLASHING = ["key", "at", "row", "score", "label", "shard", "size", "fp", "spans", "component_id", "term", "kept", "range"]


def table(spark, rows, clash: bool = True):
    """Rows of (doc_id, text) or (doc_id, text, lang) with all document columns and clashing extra ones."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None if k % 3 == 0 else f"src{k % 2}",
             None if r[1] is None else len(r[1])) for k, r in enumerate(rows)]
    df = spark.createDataFrame(full, SCHEMA)
    return df.withColumns({c: F.lit(7) for c in CLASHING}) if clash else df


def some_texts(seed: int = 1) -> list[tuple[int, str | None]]:
    """Copies, near copies, shared passages, repeats inside a text, unicode, short, empty, null, long."""
    rng = random.Random(seed)
    syllables = ["an", "er", "ou", "thé", "st", "ing", "ñe", "re", "ble", "ly"]

    def sentence(n):
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))

    shared = sentence(60)
    base = sentence(120)
    rows = [(1, base), (2, base), (3, base + " tail"), (4, sentence(40) + "\n" + shared + "\n" + sentence(30)),
            (5, shared + " " + sentence(50)), (6, "x " + shared), (7, None), (8, ""), (9, "  \n\t "), (10, "Word"),
            (11, "a" * 450), (12, "a" * 450 + "b"), (13, "ab " * 120), (14, sentence(35) + " " + sentence(35)),
            (15, "日本語テキスト " * 30), (16, "日本語テキスト " * 30 + "終"), (17, sentence(3000)), (18, "x\x00y " * 50),
            (19, None), (20, base.upper())]
    rows += [(30 + k, sentence(25) + " " + base[100 + 7 * k:400 + 9 * k]) for k in range(12)]
    rng.shuffle(rows)
    return rows

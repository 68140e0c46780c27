"""Small documents with every awkward case, for all operators."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, spans string, fingerprint string, u int, _row int"


def words(rng: random.Random, n: int, vocabulary: int = 40) -> list[str]:
    return ["".join(rng.choice("abcdefgh") for _ in range(1 + rng.randrange(vocabulary) % 7)) for _ in range(n)]


def awkward(seed: int = 3) -> list[tuple]:
    """Nulls in any column, empty and long texts, repeated rows, ties, copies, near copies."""
    rng = random.Random(seed)
    base = words(rng, 120)
    near = list(base)
    near[60] = "changed"
    texts = [
        (0, " ".join(base)), (1, " ".join(base)), (2, " ".join(near)), (3, None), (4, ""), (5, " \t\n\x0b "),
        (6, "one"), (7, "two words"), (8, "x " * 300), (9, " ".join(words(rng, 90)) + "\n" + " ".join(base[10:70])),
        (None, " ".join(words(rng, 50))), (None, None), (12, "Ünï cödé  double  spaces ▁ ▁x <|endoftext|> <s>"),
        (13, " ".join(words(rng, 6000))), (14, "ONE"), (15, " ".join(words(rng, 40))), (15, " ".join(words(rng, 40))),
        (16, "tail " + " ".join(base)),
    ]
    texts += [(17, " ".join(words(rng, rng.randrange(1, 80)))) for _ in range(1)] * 3
    texts += [(20 + i, " ".join(words(rng, rng.randrange(0, 120)))) for i in range(30)]
    return [
        (i, t, None if n % 7 == 3 else "en", None if n % 5 == 4 else f"s{n % 3}", n, 1, "s", "f", 2, 3)
        for n, (i, t) in enumerate(texts)
    ]


def frame(spark, rows: list[tuple] | None = None, tmp_path=None):
    """The rows as a table scan."""
    df = spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
    if tmp_path is None:
        return df
    df.repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/docs")
    return spark.read.parquet(f"{tmp_path}/docs")

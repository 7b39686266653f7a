"""Small tables with every awkward case, and plain Python answers."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import functions as F

# names that operators use inside
CLASHING = (
    "id node label fingerprint digest pii secrets winner run n ids tail size count key "
    "component start end kind score directory vector fp segment at own ask "
    "_key _text _lost _lost_id bucket block marks names which position rank query length"
).split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int, alphabet: str = "abcdeéß") -> str:
    return " ".join("".join(rng.choices(alphabet, k=rng.randint(1, 7))) for _ in range(n))


def texts() -> list[str | None]:
    rng = random.Random(5)
    base = words(rng, 60)
    return [
        None,
        "",
        " ",
        "\n\t \x0b",
        "x",
        "Two words",
        base,
        base.upper(),
        base,
        base + " more",
        words(rng, 20_000),
        "a" * 100_000,
        "1" * 50_000 + "." * 50,
        "日本語 text é ﬁ İ K \U0001f600 \x00 \x1c end",
        "  double  spaces \r\n and\ttabs ",
        "<|endoftext|> and ▁marks ▁▁ here",
        *(words(rng, rng.randint(1, 200)) for _ in range(30)),
    ]


def frame(spark, texts: list[str | None], ids: list[int | None] | None = None):
    """Documents with NULLs elsewhere and extra columns of clashing names."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, None, None, None) for i, t in zip(ids, texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *(F.lit(None).cast("string").alias(name) for name in CLASHING))


def collected(df) -> pd.DataFrame:
    return df.toPandas()

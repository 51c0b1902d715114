"""A small table of documents with every odd case, and helpers."""

import random

from pyspark.sql import DataFrame, SparkSession

#: Extra columns named like the operators' own helper columns.
EXTRA = ("_id", "th", "id", "n", "w", "at", "row", "spans", "u", "cdf", "of", "value", "digest", "low", "size", "_source", "count")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in EXTRA)


def words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnoprstuvwyz") for _ in range(r.randint(2, 8))) for _ in range(n)]


def texts() -> list[tuple[int | None, str | None]]:
    base = words(1, 120)
    long = words(2, 6000)
    rows: list[tuple[int | None, str | None]] = [
        (1, " ".join(base)), (2, " ".join(base)), (2, " ".join(base)),          # copies and a repeated row
        (3, " ".join(base[:118] + ["changed", "Words"])),                       # near copy
        (4, " ".join(words(3, 40) + base[30:70] + words(4, 40))),               # shared passage
        (5, None), (6, ""), (7, "  \n\t "), (8, "one"), (9, "One two"), (10, "one  TWO"), (11, "one"),
        (None, " ".join(base)), (None, None), (None, "no id here " * 3),
        (12, " ".join(long)), (13, " ".join(long[:5990])),                      # very long, near copy
        (14, " ".join(words(5, 50))), (14, " ".join(words(6, 50))),             # one id, two texts
        (15, "ab " * 300), (16, "Élan Ünder ÉCOLE straße İstanbul naïve " * 6), (17, " x y z\x00w" * 30),
        (18, " ".join(base[40:110])), (20, "x" * 500), (21, "x" * 499 + "y")]
    return rows


def documents(spark: SparkSession, rows: list | None = None, extra: bool = True) -> DataFrame:
    rows = texts() if rows is None else rows
    data = [(i, t, None if i is None else "en", None if i is not None and i % 5 == 0 else "s", len(t) if t and i else None,
             *[f"{c}{k}" for c in EXTRA]) for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA)
    return df if extra else df.select("doc_id", "text", "lang", "source", "n_chars")


def rows_of(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)

"""Rows that every text operator must take: nulls, empty and very long texts, repeated rows, clashing column names."""

import random

import pyarrow.parquet as pq

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, repeats string, node int, kept boolean"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, words: int) -> str:
    """Sentences of made-up words, the same for the same seed."""
    rng = random.Random(seed)
    out = []
    while words > 0:
        n = min(words, rng.randint(6, 14))
        s = ["".join(rng.choices("bcdfglmnprst", k=1) + rng.choices("aeiou", k=1))[:2] + rng.choice(WORDS) for _ in range(n)]
        out.append(" ".join(s).capitalize() + ".")
        words -= n
    return " ".join(out)


def awkward(spark, texts=None):
    texts = texts or [None, "", " \n\t", "x", prose(1, 80), prose(1, 80), prose(2, 20000), "no-blank" * 4000, "ünï © 日本語 \x00\x1c 😀"]
    rows = [(i, t, "en" if i % 2 else None, None, None, 7, "r", 3, False) for i, t in enumerate(texts)]
    rows += [rows[4], (None, prose(3, 60), "en", "s", 1, 7, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def stored(df, tmp_path):
    """The rows as a table scan, in two files."""
    path = str(tmp_path / "docs.parquet")
    df.repartition(2).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def table(sf: str, name: str):
    return pq.read_table(f"/root/testdata/sf{sf}/{name}.parquet").to_pandas()

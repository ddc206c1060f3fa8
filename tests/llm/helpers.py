"""Small documents with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, digest string, label string, root long"


def words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(vocabulary)]
    return [rng.choice(pool) for _ in range(n)]


def rows():
    base = words(120, 1)
    near = [*base[:60], "changed", *base[61:]]
    long = " ".join(words(30_000, 2, 3000))
    texts = [
        (1, " ".join(base)), (2, " ".join(near)), (3, "\t".join(base) + "\n"), (4, None), (5, ""), (6, " \n\t"),
        (7, long), (8, long), (9, "ab"), (10, "a b"), (10, "a b"), (None, "x y z null id"), (None, "x y z null id"),
        (11, "Über Straße   naïve   ok"), (12, "no  double   blanks\n\nhere <|endoftext|> x"), (13, "1234 5678 !!"), (14, "ab"),
    ]
    return [(i, t, "en" if k % 2 else None, f"s{k % 3}" if k % 5 else None, "clash", "clash", 7) for k, (i, t) in enumerate(texts)]


def frame(spark, own=None):
    return spark.createDataFrame(rows() if own is None else own, SCHEMA)

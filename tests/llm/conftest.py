import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept string, words int, "
          "digest_key string, size string, KEY string")


def sentence(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, near copies."""
    rng = random.Random(7)
    base, long = sentence(rng, 120), sentence(rng, 30_000)
    near = base.split()
    near[5] = "changed"
    texts = [(1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, long),
             (9, long + " tail"), (10, "idiot " + base), (10, "idiot " + base), (None, base), (None, None),
             (11, "Mail a.b@c.de or +1 (456) 555-2186, later 555-2186."), (12, "x" * 50_000), (13, "É́ Σ <|endoftext|>")]
    texts += [(20 + i, "same text in many rows") for i in range(40)]
    return [(i, t, None if n % 5 == 0 else "en", None if n % 4 == 0 else f"s{n % 3}", None if n % 3 == 0 else 1,
             "no", n, None, "big", "k") for n, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)

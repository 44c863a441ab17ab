"""Small inputs shared by the tests of the corpus operators."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(n, seed):
    """n words in sentences of 3 to 12."""
    rng, out = random.Random(seed), []
    while n > 0:
        k = min(n, rng.randint(3, 12))
        out.append(" ".join(rng.choice(WORDS) + rng.choice(["", "s", "en"]) for _ in range(k)).capitalize() + ".")
        n -= k
    return " ".join(out)


def edge_rows():
    """Nulls, empty and very long texts, repeated rows, equal texts and keys that repeat."""
    long = prose(30_000, 1)
    return [
        (1, "", "en", "a", 0), (2, None, None, None, None), (None, prose(40, 2), "en", "a", 1),
        (3, prose(40, 3), "en", "a", 1), (3, prose(40, 3), "en", "a", 1), (4, prose(40, 3), "de", "b", 1),
        (5, prose(40, 5), "en", "a", 1), (5, prose(40, 6), "en", "a", 1), (6, long, "en", "a", 1),
        (7, " \t\n", "en", "a", 3), (8, "été \U0001f600 中文", "fr", "a", 6), (None, None, None, None, None),
    ]


def documents(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)

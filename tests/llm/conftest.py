import random

import pytest


@pytest.fixture(scope="session")
def edge_rows():
    """Null, empty, blank, very long and repeated texts, ties, null ids."""
    r = random.Random(3)
    words = ["alpha", "beta", "the", "of", "Gamma", "delta,", "ünder", "naïve", "x1", "und"]
    long = " ".join(r.choice(words) + (str(r.randrange(99)) if r.random() < 0.5 else "") for _ in range(30_000))
    say = " ".join(r.choice(words) + str(r.randrange(50)) for _ in range(120))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (6, long), (7, say), (8, say),
            (8, say), (9, say + " more words at the end"), (10, "y" * 20_000), (11, "a\n" * 3000),
            (12, "\n".join([say, long[:2000], say])), (13, "¿日本 語😀\r\n end"), (None, "no id at all"), (14, "it's <s>[INST]\\ we'll\x0bgo")]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    rows = [(i, t, "en" if k % 3 else None, "src", k, "w", 1, "r") for k, (i, t) in enumerate(edge_rows)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, id int, `row` string")


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)

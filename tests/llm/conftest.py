import random

import pytest
from pyspark.sql import functions as F

ALPHABET = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()


@pytest.fixture(scope="session")
def prose():
    """Texts with copies, near copies, empty and null ones, a long one, and repeated rows."""
    rnd = random.Random(3)

    def text(n):
        return " ".join(rnd.choice(ALPHABET) + str(rnd.randrange(40)) for _ in range(n))

    rows = [(i, text(rnd.randrange(3, 90))) for i in range(60)]
    base = text(120)
    rows += [(100 + i, base) for i in range(5)]
    for i in range(12):
        w = base.split()
        for _ in range(2):
            w[rnd.randrange(len(w))] = f"changed{rnd.randrange(99)}"
        rows.append((120 + i, " ".join(w)))
    rows += [(200, None), (201, ""), (202, " \t\n "), (203, "One"), (204, "one"), (205, "one two"), (206, text(30_000))]
    rows += [(0, rows[0][1]), (0, rows[0][1])]
    return rows


@pytest.fixture(scope="session")
def documents(spark, prose):
    df = spark.createDataFrame(prose, "doc_id long, text string")
    extra = {"n_words": F.lit("own"), "score": F.lit(-1), "predicted": F.lit("x"), "labels": F.lit(1)}
    return df.withColumns({"lang": F.lit("en"), "source": F.concat(F.lit("src"), F.col("doc_id") % 3), **extra})


@pytest.fixture(scope="session")
def nothing(documents):
    return documents.limit(0)

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and to in a is that it for was on are as with his they at be this from".split()


def prose(rng: random.Random, n: int) -> str:
    """n words; some frequent, most made up."""
    made = ["".join(rng.choice("abcdeinorst") for _ in range(rng.randint(2, 7))) for _ in range(n)]
    return " ".join(rng.choice(WORDS) if rng.random() < 0.3 else w for w in made)


@pytest.fixture
def docs(spark):
    """Documents from (id, text) pairs, with a clashing extra column."""

    def make(rows, extra: bool = False):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F

            for name in ("n_words", "kept", "score", "node", "row_key"):
                df = df.withColumn(name, F.lit(name))
        return df

    return make

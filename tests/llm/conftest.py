import random

import pytest

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table of (id, text) or (id, text, lang), with extra columns on request."""
    def make(rows, **extra):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or ""), *extra.values()) for r in rows]
        names = "".join(f", {name} string" for name in extra)
        return spark.createDataFrame(full, COLUMNS + names)

    return make


@pytest.fixture
def words():
    """Pronounceable random words, the same for each seed."""
    def make(n, seed):
        rnd = random.Random(seed)
        return ["".join(rnd.choice(["ba", "ke", "li", "mo", "nu", "ra", "si", "to"])
                        for _ in range(rnd.randint(2, 4))) for _ in range(n)]

    return make


def ids(df, column="doc_id"):
    return sorted(r[column] for r in df.select(column).collect())

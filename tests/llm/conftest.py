import pytest

WORDS = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike".split()


@pytest.fixture(scope="session")
def documents(spark):
    """documents(rows): a frame of (doc_id, text, source) with columns whose names clash."""
    def make(rows):
        rows = [(i, t, "en", s, None if t is None else len(t), "x", 1.5, "y", 7) for i, t, s in rows]
        return spark.createDataFrame(
            rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                  "TEXT string, score double, id string, size int")
    return make


def prose(seed: int, n: int) -> list[str]:
    """Reproducible words; neighbours in a row of seeds share nothing."""
    import random

    rng = random.Random(seed)
    return [rng.choice(WORDS) + str(rng.randint(0, 9999)) for _ in range(n)]

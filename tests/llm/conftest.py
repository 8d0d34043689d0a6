import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, _key int, root int, at int"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text, lang, source) or shorter rows, with extra columns of names used inside."""

    def make(rows):
        full = [tuple([*r, *[None] * (4 - len(r))]) for r in rows]
        return spark.createDataFrame(
            [(i, t, la, s, None if t is None else len(t), "k", 1, 2, 3) for i, t, la, s in full], SCHEMA
        )

    return make


@pytest.fixture
def prose():
    """Pseudo-words in a fixed order."""
    import random

    def make(seed, n):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 9))) for _ in range(n))

    return make

"""Decontamination by joins: repeated rows, common phrases, long texts, ids of other types."""

import random
from collections import Counter

import pytest

from tableferry.llm import decontam
from tests.llm.test_text_models import brute_tiles

PHRASE = "which of these answers is the right one"


def brute(docs, items, seed=decontam.SEED_WORDS):
    out = Counter()
    for doc_id, text in docs:
        for item_id, item in items:
            size = len((item or "").split())
            if text and size:
                covered = brute_tiles(text.split(), item.split(), min(seed, size)) / size
                if covered >= decontam.COVERAGE:
                    out[doc_id, item_id, round(covered, 9)] += 1
    return out


def found(df):
    return Counter((r.doc_id, r.item_id, round(r.coverage, 9)) for r in df.collect())


def test_a_phrase_of_all_items_and_repeated_rows(spark, documents, prose):
    rng = random.Random(5)
    items = [(i, f"{prose(i, rng.randint(4, 40))} {PHRASE}") for i in range(20)] + [(3, "one two three"), (None, prose(77, 12)), (9, PHRASE)]
    items += items[:2]
    docs = []
    for i in range(40):
        words = rng.choice(items)[1].split()
        cut = rng.randrange(len(words))
        docs.append((i, " ".join([*([PHRASE] * rng.randint(0, 2)), *words[cut:], prose(100 + i, 9), *words[:cut]])))
    docs += [docs[0], docs[0], (None, docs[1][1]), (0, docs[2][1]), (60, "zero one two three four")]
    bench = spark.createDataFrame(items, "item_id smallint, text string")
    got = decontam.contaminated(spark, documents(docs), bench)
    assert dict(got.dtypes)["item_id"] == "smallint"
    want = brute(docs, items)
    assert found(got) == want and max(want.values()) >= 3


def test_long_texts_and_empty_tables(spark, documents, prose):
    item = prose(1, 60)
    words = item.split()
    long = " ".join([prose(2, 60_000), *words[:40], prose(3, 60_000), PHRASE, *([PHRASE] * 2000)])
    docs = documents([(1, long), (2, prose(4, 10)), (3, None), (4, ""), (5, "... !!")])
    bench = spark.createDataFrame([(1, item), (2, PHRASE), (3, None), (4, "?!"), (5, "")], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id, r.tiles) for r in decontam.contaminated(spark, docs, bench).collect()}
    assert got == {(1, 1, 1), (1, 2, 1)}
    for left, right in ((docs.limit(0), bench), (docs, bench.limit(0)), (docs, bench.where("item_id > 2"))):
        none = decontam.contaminated(spark, left, right)
        assert none.columns == ["doc_id", "item_id", "coverage", "tiles", "longest"] and none.count() == 0


def test_small_sieves_lose_nothing(spark, documents, prose, monkeypatch):
    docs = [(i, prose(i, 80)) for i in range(12)]
    items = [(i, " ".join(prose(i, 80).split()[20:50])) for i in range(0, 12, 3)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(decontam, "SIEVE_BITS", 1 << 15)
    assert found(decontam.contaminated(spark, documents(docs), bench)) == brute(docs, items) == Counter({(i, i, 1.0): 1 for i in range(0, 12, 3)})


@pytest.mark.parametrize("k, n", [(5, 5), (5, 6), (5, 40), (3, 3)])
def test_matches_of_repeated_words(k, n):
    places = list(range(n - k + 1))
    got = decontam._matches([{"places": places, "item_places": places}], k)
    assert sorted(map(tuple, got.tolist())) == sorted(
        (max(d, 0), max(-d, 0), n - abs(d)) for d in range(k - n, n - k + 1)
    )

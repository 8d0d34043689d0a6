"""Near duplicates and components, against brute force."""

import random
import re

import numpy as np
import pytest

from tableferry.llm import neardup
from tableferry.llm.components import components


def brute(rows, k, percent):
    def shingles(text):
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))) if words else frozenset()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return sorted(
        ((i, len(sets[a]), least.get(find(a)), i == least.get(find(a))) for a, (i, _) in enumerate(rows)), key=repr
    )


@pytest.fixture
def similar(prose):
    rng, rows = random.Random(7), []
    for group in range(12):
        words = prose(group, rng.choice([3, 8, 40, 200])).split()
        for _ in range(rng.randint(1, 9)):
            rows.append((len(rows), " ".join(w if rng.random() > 0.03 else w + "x" for w in words)))
            if rng.random() < 0.5:
                words = rows[-1][1].split()
    rows += [(500, None), (501, ""), (502, " \t"), (503, "one"), (504, "ONE"), (3, "one"), (None, "one"), (None, "two words")]
    return rows


@pytest.mark.parametrize("k", [2, 5])
def test_components_equal_brute_force(spark, documents, similar, k):
    got = neardup.near_duplicates(spark, documents(similar), k=k)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(similar, k, 80)
    assert not neardup.near_duplicates(spark, documents([]), k=k).take(1)


def test_one_of_each_group_stays(spark, documents, similar):
    docs = documents([*similar, *similar[:3], (600, None), (600, None)])
    kept = neardup.without_duplicates(spark, docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sum(r.doc_id == 600 for r in rows) == 2 and sum(r.text == "one" for r in rows) == 1
    groups = {r[2] for r in brute(similar, 5, 80) if r[1]}
    with_words = [r for r in rows if r.text and r.text.strip()]
    assert len(with_words) == len({tuple(r) for r in with_words}) and {r.doc_id for r in with_words} == groups


def test_densified_signatures_estimate_similarity():
    rng = np.random.Generator(np.random.PCG64(1))
    for size in (3, 30, 3000):
        both = rng.integers(0, 1 << 63, size * 2, dtype=np.uint64)
        a, b = both[: size + size // 2], both[size // 2 :]
        rows = np.array([0, len(a), len(a) + len(b)])
        values = np.concatenate([np.sort(a), np.sort(b)])
        one, two = neardup.signatures(values, rows, 1024)
        want = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((one == two).mean() - want) < (0.3 if size == 3 else 0.1)


@pytest.mark.parametrize("in_task", [0, 1000])
def test_long_chains_settle(spark, in_task):
    edges = [(i, i + 1) for i in range(200)] + [(500, 400), (400, 500), (7, 7)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.root for r in components(spark, frame, in_task=in_task).collect()}
    assert got == {**{i: 0 for i in range(201)}, 400: 400, 500: 400}
    assert not components(spark, spark.createDataFrame([], "a bigint, b bigint")).take(1)


def test_links_in_crowded_buckets_equal_brute_force(spark, documents, prose):
    template, rows = prose(1, 200), []
    for i in range(200):
        # All pairs share the template at 0.76 to 0.79; those with a shorter part of their own reach 0.82.
        rows.append((i, template + " " + prose(1000 + i, 22 if i in (7, 57) else 32)))
    want = brute(rows, 1, 80)
    assert [r[2] for r in want if r[0] == 57] == [7]
    got = neardup.near_duplicates(spark, documents(rows), k=1)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_rows_repeated_often_stay_once_and_wordless_ones_stay_all(spark, documents, prose):
    text = prose(1, 30)
    rows = [(5, text, "b")] * 300 + [(5, text, "a")] * 3 + [(6, text)] + [(7, " \t\r\n\x0b")] * 3 + [(None, None)] * 2 + [(8, "\u00a0")] * 2
    kept = neardup.without_duplicates(spark, documents(rows).repartition(6))
    assert sorted(((r.doc_id, r.text, r.lang) for r in kept.collect()), key=repr) == sorted(
        [(5, text, "a"), *[(7, " \t\r\n\x0b", None)] * 3, *[(None, None, None)] * 2, (8, "\u00a0", None)], key=repr
    )


def test_a_worker_gets_few_whole_texts_at_once(spark, documents, monkeypatch):
    from tableferry.llm import components, neardup, suffixdedup, texts

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    rows = spark.range(0, 7000, numPartitions=1)
    before = spark.conf.get(components.ARROW_ROWS)
    got = components.stored(spark, rows.mapInArrow(sizes, "n bigint"), "sizes", texts.BATCH_ROWS)
    assert sorted(r.n for r in got.collect()) == [1000] * 7 and spark.conf.get(components.ARROW_ROWS) == before
    asked = {}

    def noted(spark, df, name, batch_rows=None):
        asked[name] = batch_rows
        return components.stored(spark, df, name, batch_rows)

    monkeypatch.setattr(neardup, "stored", noted)
    monkeypatch.setattr(suffixdedup, "stored", noted)
    docs = documents([(i, f"one two three four five six {i // 2}") for i in range(20)])
    neardup.without_duplicates(spark, suffixdedup.without_repeats(spark, docs)).collect()
    assert all(asked[name] == texts.BATCH_ROWS for name in ("signed", "sets", "segments", "pieces"))

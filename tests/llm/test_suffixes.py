"""Induced suffix sorting and removal of repeated byte strings, against brute force."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tableferry.llm import induced, suffixdedup


def brute_order(text, cap):
    order = sorted(range(len(text)), key=lambda i: text[i:])
    shared = [0] * len(text)
    for r in range(1, len(text)):
        a, b = order[r - 1], order[r]
        while max(a, b) + shared[r] < len(text) and shared[r] < cap and text[a + shared[r]] == text[b + shared[r]]:
            shared[r] += 1
    return order, shared


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.sampled_from([(256, 1 << 20, 1 << 16), (0, 8, 3), (256, 16, 4)]))
def test_order_and_common_prefixes(text, limits):
    bucket, memory, chunk = limits
    before = induced.BUCKET, induced.CHUNK
    induced.BUCKET, induced.CHUNK = bucket, chunk
    try:
        for cap in (1000, 3):
            order, shared = induced.sorted_suffixes(np.array(text, np.int64), 4, cap, induced.Workspace(memory))
            want_order, want_shared = brute_order(text, cap)
            assert list(shared) == want_shared
            assert cap == 3 or list(order) == want_order
    finally:
        induced.BUCKET, induced.CHUNK = before


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for t in texts:
        for p in range(len(t) - length + 1):
            seen[t[p : p + length]] = seen.get(t[p : p + length], 0) + 1
    out = []
    for (i, _), t in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = True
        runs = int(np.sum(np.diff(gone.astype(int), prepend=0) == 1))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture
def repeated(prose):
    passage, other = prose(1, 120), prose(2, 100)
    rows = [(i, prose(10 + i, 40) + passage[i : 500 + i] + prose(50 + i, 30)) for i in range(12)]
    rows += [(20, None), (21, ""), (22, "x" * 399), (23, "y" * 1400), (24, other), (24, other), (None, other + "!")]
    rows += [(25, "Sich " * 300), (26, "é" * 260), (27, prose(3, 200) + passage), (28, passage[:399] + "z")]
    return rows


def test_removal_equals_brute_force(spark, documents, repeated):
    got = suffixdedup.report(spark, documents(repeated))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(repeated, 400)
    assert not suffixdedup.report(spark, documents([])).take(1)


def test_crowded_anchors_and_many_shards(spark, documents, repeated, monkeypatch):
    monkeypatch.setattr(suffixdedup, "SHARD_SEGMENTS", 2)
    monkeypatch.setattr(suffixdedup, "MEMORY", 500)
    got = suffixdedup.report(spark, documents(repeated))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(repeated, 400)


def test_rows_and_characters_stay_whole(spark, documents, repeated):
    docs = documents(repeated)
    kept = suffixdedup.without_repeats(spark, docs)
    assert kept.columns == docs.columns
    got = {r.doc_id: r for r in kept.collect()}
    assert kept.count() == len(repeated)
    assert got[24].text == "" and got[24].n_chars == 0
    assert got[22].text == "x" * 399 and got[20].text is None and got[0]._key == 1
    assert set(got[26].text) <= {"é"}


@pytest.mark.parametrize("crowd", [250, 2])
def test_periodic_text_beside_plain_text(spark, documents, monkeypatch, crowd):
    monkeypatch.setattr(suffixdedup, "SHARD_SEGMENTS", crowd)
    rng, rows = np.random.Generator(np.random.PCG64(2)), []
    for i in range(60):
        head, line = ("".join(chr(97 + c) for c in rng.integers(0, 26, n)) for n in (350, (1, 30, 150)[i % 3 if i % 2 else 2]))
        rows += [(2 * i, head + line * (150 // len(line))), (2 * i + 1, head + line * (450 // len(line)))]
    got = suffixdedup.report(spark, documents(rows))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 400)

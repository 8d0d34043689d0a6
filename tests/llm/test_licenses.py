"""License scans against a plain scan of all windows."""

import random
import string

import numpy as np
import pytest

from tableferry.llm import licenses, texts


def words_of(text):
    trimmed = (w.strip(string.punctuation) for w in (text or "").lower().split())
    return [w for w in trimmed if w]


def shingles_of(text, k=licenses.SHINGLE_WORDS):
    words = words_of(text)
    return [tuple(words[i : i + k]) for i in range(len(words) - k + 1)] or [tuple(words)] * bool(words)


def brute(rows, templates, containment=licenses.CONTAINMENT):
    """Every window of every text against every template."""
    out = []
    for doc_id, text in rows:
        seen = shingles_of(text)
        for name, template in templates.items():
            own, spans = set(shingles_of(template)), []
            n = len(own)
            for w in range(0, len(seen), n):
                inside = [w + i for i, s in enumerate(seen[w : w + 2 * n + 1]) if s in own]
                share = len({seen[i] for i in inside}) / n
                if share < containment:
                    continue
                if spans and inside[0] <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(spans[-1][1], inside[-1]), max(spans[-1][2], share))
                else:
                    spans.append((inside[0], inside[-1], share))
            out += [(doc_id, name, a, b + licenses.SHINGLE_WORDS - 1, share) for a, b, share in spans]
    return sorted(out, key=repr)


def scanned(df, **options):
    return sorted(((r.doc_id, r.license, r.first_word, r.last_word, r.containment) for r in licenses.license_scan(df, **options).collect()), key=repr)


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        i = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[i] = "other"
        elif kind == 1:
            words.insert(i, "more")
        else:
            del words[i]
    return " ".join(words)


def test_all_windows_of_edited_texts(spark, documents, prose):
    rng, rows = random.Random(8), []
    for i, text in enumerate([*licenses.TEMPLATES.values()] * 3):
        # Short notices are edited in the first round only, as one word is often too much for them.
        edits = rng.randint(0, max(i < len(licenses.TEMPLATES), len(text.split()) // 25))
        parts = [prose(i, rng.randint(0, 60)), edited(rng, text, edits), prose(i + 500, rng.randint(0, 60))]
        rows.append((i, "\n".join(parts)))
    rows += [(900, prose(1, 300)), (None, licenses.TEMPLATES["ISC (text)"]), (900, licenses.TEMPLATES["ISC (text)"].upper())]
    want = brute(rows, licenses.TEMPLATES)
    assert len({name for _, name, *_ in want}) == len(licenses.TEMPLATES)
    assert scanned(documents([*rows, (901, None), (902, ""), (903, "of the")])) == want
    shares = [share for *_, share in want]
    assert min(shares) < 0.9 and 1.0 in shares


def test_long_texts_repeats_and_empty_tables(spark, documents, prose):
    text = licenses.TEMPLATES["Zlib (text)"]
    rows = [(1, " ".join([prose(1, 40_000), text, prose(2, 40_000), text, prose(3, 9)])), (2, f"{text} {text}"), (2, f"{text} {text}")]
    got = scanned(documents(rows))
    assert got == brute(rows, licenses.TEMPLATES) and len([g for g in got if g[0] == 1]) == 2
    assert got[-1] == got[-2]
    assert licenses.license_scan(documents(rows).limit(0)).count() == 0
    for templates in ({}, {"short": "just four words here"}):
        with pytest.raises(ValueError):
            licenses.license_scan(documents(rows), templates)


@pytest.mark.parametrize("containment", [0.8, 0.95])
def test_bands_retrieve_what_the_settings_promise(containment):
    """Windows that hold just the share asked for are retrieved; other windows hardly ever."""
    rng, lost = np.random.default_rng(1), 0
    known = licenses.Templates(licenses.TEMPLATES, containment, 1e-6)
    for n, own in known.sizes.items():
        for i in own:
            for _ in range(20):
                kept = rng.choice(known.sets[i], int(np.ceil(containment * n)), replace=False)
                window = rng.permutation(np.concatenate([kept, rng.integers(0, 1 << 63, 2 * n + 1 - len(kept), dtype=np.uint64)]))
                rows = np.array([0, len(window)])
                lost += not any(j == i and 0 in starts for j, starts in licenses._retrieved(window, rows, n, known))
            strange = texts.mixed(np.arange(50 * n, dtype=np.uint64))
            assert all(len(starts) == 0 for _, starts in licenses._retrieved(strange, np.array([0, len(strange)]), n, known))
    assert not lost


def test_settings_beyond_the_bands_are_refused():
    with pytest.raises(ValueError, match="bands"):
        licenses.Templates(licenses.TEMPLATES, 0.02, 1e-12)

"""Byte-pair encoding against the tokenizers library, and the transducer against a dictionary."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tableferry.llm import bpe
from tableferry.llm.transducer import Transducer, compiled

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")

ODD = [
    None, "", " \t\n", "Hello  world's DON'T I'LL ..'re", "İstanbul ΣΑΣ ὈΔΥΣΣΕΎΣ ǅ ß", "a1b22 ½ ²٣ Ⅷ", "é é ́x",
    "x<|startoftext|> <|endoftext|>y<|endoftext|", "<|endoftext|>", "\u0085a b\x1cc d　e", "​﻿ !?",
    "漢字かな交じり文 한국어 🙂👍🏽", "\U000e0041\U0001f468‍\U0001f469", "՘a ࢏1 ֋ ა", "a" * 3000, "!?" * 400 + "ab" * 500,
    "\x00\x01a", "<|ENDOFTEXT|>", "Ɤ Ƛ \U00010d50", "e" + "́" * 5,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def words():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Words(file.read())


def test_words_and_merges_are_those_of_the_library(library, words, tmp_path):
    (tmp_path / "none").write_bytes(compiled([]))
    encoder = bpe.Encoder(words, Transducer(str(tmp_path / "none")))
    ids, starts = encoder.encode(ODD)
    for i, text in enumerate(ODD):
        assert ids[starts[i] : starts[i + 1]].tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(library, words, text):
    found = [i for w in words.words(text) for i in ([words.special[w]] if w in words.special else words.merged(w.encode()))]
    assert found == library.encode(text, add_special_tokens=False).ids
    short = [w.encode() for w in words.words(text) if w not in words.special] + [b""]
    assert [x.tolist() for x in words.merged_all(short)] == [words.merged(w) for w in short]


def test_every_letter_of_common_blocks_is_cut_like_the_library_does(library, words):
    for c in [*range(0x3000), *range(0xA640, 0xAB70), *range(0x10400, 0x10600)]:
        text = f"a{chr(c)}B1{chr(c)}! {chr(c)}"
        got = [i for w in words.words(text) for i in words.merged(w.encode())]
        assert got == library.encode(text, add_special_tokens=False).ids, hex(c)


def test_many_words_are_merged_like_one(words):
    rng = random.Random(3)
    some = ["".join(rng.choice("aaeinrst") for _ in range(rng.randint(1, 64))).encode() for _ in range(500)] + [b"a" * 64]
    assert [x.tolist() for x in words.merged_all(some)] == [words.merged(w) for w in some]
    assert words.merged_all([]) == []


def test_a_long_text_is_cut_at_spaces_only(library, words, monkeypatch, prose):
    monkeypatch.setattr(bpe, "PART", 50)
    text = prose(1, 300) + "b" * 200 + " don't́ " + prose(2, 100)
    assert [i for w in words.words(text) for i in words.merged(w.encode())] == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=6).map(lambda b: bytes(x % 4 for x in b)), st.lists(st.integers(0, 5), max_size=4)))
def test_transducer_equals_a_dictionary(tmp_path_factory, entries):
    file = tmp_path_factory.mktemp("t") / "t"
    file.write_bytes(compiled(sorted(entries.items())))
    asked = [*entries, b"", b"\0", b"\1\2\3\0\1\2\3", *(w + b"\1" for w in entries), *(w[:-1] for w in entries)]
    known, ids, starts = Transducer(str(file)).find(asked)
    for i, word in enumerate(asked):
        assert known[i] == (word in entries)
        assert ids[starts[i] : starts[i + 1]].tolist() == list(entries.get(word, []))


def test_suffixes_share_states(tmp_path):
    stems = [f"{a}{b}".encode() for a in "abcdefgh" for b in "klmnop"]
    entries = sorted((s + e, [1]) for s in stems for e in (b"ing", b"ed", b"er"))
    (tmp_path / "t").write_bytes(compiled(entries))
    mapped = Transducer(str(tmp_path / "t"))
    # One state after each first letter and one after each second would be 8 + 48 in a tree; here each level has one.
    assert isinstance(mapped.pool, np.memmap) and mapped.n_states < 10


def test_documents_against_the_library(spark, documents, library, prose):
    rng = random.Random(5)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (7, "again"), (7, "again")]
    rows += [(100 + i, " ".join(rng.choice(prose(3, 200).split()).title() for _ in range(rng.randint(1, 400)))) for i in range(40)]
    docs = documents(rows).repartition(3)

    def sha(data):
        return hashlib.sha256(data).hexdigest()

    expected = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        out = library.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(out.encode())))
    for size in (0, 60, bpe.LEXICON):
        got = [tuple(r) for r in bpe.token_digests(spark, docs, PATH, size).collect()]
        assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_ids_and_texts(spark, documents, library):
    tokens = bpe.encoded(spark, documents([(1, "Hello <|endoftext|>worlds"), (2, None), (3, " ")]), PATH)
    out = {r["doc_id"]: (r["ids"], r["decoded"]) for r in bpe.decoded(tokens, PATH).collect()}
    ids = library.encode("Hello <|endoftext|>worlds", add_special_tokens=False).ids
    assert out == {1: (ids, library.decode(ids, skip_special_tokens=False)), 2: ([], ""), 3: ([], "")}
    nulls = spark.createDataFrame([(1, None, "k"), (2, [], "k"), (3, [320], "k")], "doc_id int, ids array<int>, _key string")
    assert [(r["decoded"], r["_key"]) for r in bpe.decoded(nulls, PATH).orderBy("doc_id").collect()] == [
        (None, "k"), ("", "k"), (library.decode([320]), "k")
    ]


def test_empty_tables_and_a_very_long_text(spark, documents, library, prose):
    assert bpe.token_digests(spark, documents([]), PATH).collect() == []
    text = prose(9, 60_000)
    (row,) = bpe.token_digests(spark, documents([(1, text)]), PATH).collect()
    ids = library.encode(text, add_special_tokens=False).ids
    assert row["n_tokens"] == len(ids) and row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_counts_hold_all_texts(spark, documents, words, prose):
    from collections import Counter

    rows = [(i, prose(i % 7, 50)) for i in range(30)]
    with open(PATH, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())
    expected = Counter(w for _, t in rows for w in words.words(t))
    assert {r["word"]: r["n"] for r in bpe.word_counts(documents(rows), spec).collect()} == dict(expected)

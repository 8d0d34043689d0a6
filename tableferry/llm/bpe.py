"""Byte-pair encoding and decoding with a lexicon of frequent words.

Words are counted over all texts; the most frequent are compiled with their ids into a
minimal acyclic transducer, a file that Spark hands to every executor and that its
Python workers memory-map. All other words are merged pair by pair, exactly as the
merges rank them, so that the lexicon changes the speed only.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import uuid
from collections import Counter
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast, SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import texts
from tableferry.llm.components import stored
from tableferry.llm.transducer import Transducer, compiled
from tableferry.session import filesystem, shared_dir

#: Words of the lexicon, and bytes of the longest of them; all others are merged anew.
LEXICON = 50_000
LONGEST = 48
#: Levels of frequency between a number and its double.
LEVELS = 16
#: Distinct words that a task counts before it says what it has and starts afresh.
HELD = 200_000
#: Characters of a text that are cut into words at once.
PART = 1 << 20
#: Bytes of words that are merged many at once; longer ones are merged one by one, with a queue.
SHORT = 64
#: Up to here, and in this block, Python, ``regex`` and the library agree on letters, numbers, spaces and small letters.
_PLAIN = regex.compile(r"[\x00-\u052f\u2000-\u206f]*")
_SPACE = regex.compile(r"[ \t\n\r]")
#: The characters that stand for the bytes in byte-level vocabularies.
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]


def _byte_characters() -> list[str]:
    others = iter(range(256, 512))
    return [chr(b) if b in _SELF else chr(next(others)) for b in range(256)]


class Words:
    """Cuts texts into words, and merges words to ids, as a tokenizer file says."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        given = json.loads(spec)
        model, cutters = given["model"], (given["pre_tokenizer"] or {}).get("pretokenizers", [])
        kinds = [c["type"] for c in cutters]
        odd = [t for t in given["added_tokens"] if t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]]
        if (
            model["type"] != "BPE" or kinds != ["Split", "ByteLevel"] or odd or given["decoder"]
            or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges")
            or cutters[0]["behavior"] != "Removed" or not cutters[0]["invert"] or cutters[1]["add_prefix_space"]
        ):
            raise ValueError("the file is not of a byte-level BPE with word ends, cut by one pattern")
        whole = Tokenizer.from_str(spec)
        self._normalized, self._cut = whole.normalizer.normalize_str, whole.pre_tokenizer.pre_tokenize_str
        self._pattern = regex.compile(cutters[0]["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        by_length = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if by_length else None
        characters, vocabulary = _byte_characters(), model["vocab"]
        self._byte = {c: b for b, c in enumerate(characters)}
        end = model.get("end_of_word_suffix") or ""
        # A byte without a token of its own is left out, as there is no token for the unknown.
        self._inner = [vocabulary.get(c) for c in characters]
        self._last = [vocabulary.get(c + end) for c in characters]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self._pairs = {
            (vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(pairs)
        }
        width = np.int64(max(vocabulary.values()) + 1)
        made = sorted((a * int(width) + b, rank, new) for (a, b), (rank, new) in self._pairs.items())
        self._width, (self._key, self._rank, self._new) = width, np.array(made, np.int64).reshape(-1, 3).T.copy()
        self._symbols = np.array([[-1 if i is None else i for i in x] for x in (self._inner, self._last)], np.int64)
        named = {**{i: t for t, i in vocabulary.items()}, **{i: t for t, i in self.special.items()}}
        spelled = [named.get(i, "").encode() for i in range(max(named) + 1)]
        self.spelling = np.frombuffer(b"".join(b" " + s for s in spelled), np.uint8)
        self.spelled = np.cumsum([0, *(len(s) + 1 for s in spelled)])

    def words(self, text: str) -> list[str]:
        """The words of a text in order; special tokens stand for themselves."""
        if self._special is None:
            return self._plain_words(text)
        out: list[str] = []
        for i, part in enumerate(self._special.split(text)):
            out += [part] if i % 2 else self._plain_words(part)
        return out

    def _plain_words(self, text: str) -> list[str]:
        out, at = [], 0
        while at < len(text):
            # No word holds white space, so a text may be cut there.
            end = len(text)
            if end - at > PART:
                space = _SPACE.search(text, at + PART)
                end = space.start() if space else end
            part, at = text[at:end], end
            if _PLAIN.fullmatch(part) and is_normalized("NFC", part):
                # A letter alone: the library knows no final form of sigma.
                out += self._pattern.findall(part.replace("Σ", "σ").lower())
            else:
                out += [bytes(self._byte[c] for c in word).decode() for word, _ in self._cut(self._normalized(part))]
        return out

    def merged(self, word: bytes) -> list[int]:
        """The ids of a word: of all neighbours that merge the pair of least rank, the leftmost, again and again."""
        ids = [*(self._inner[b] for b in word[:-1]), *(self._last[b] for b in word[-1:])]
        ids = [i for i in ids if i is not None]
        n, pairs = len(ids), self._pairs
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        waiting = [(*found, i) for i in range(n - 1) if (found := pairs.get((ids[i], ids[i + 1])))]
        heapq.heapify(waiting)
        while waiting:
            rank, new, i = heapq.heappop(waiting)
            j = after[i]
            # A pair of which one part was merged meanwhile is no longer there.
            if ids[i] < 0 or j >= n or pairs.get((ids[i], ids[j])) != (rank, new):
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                if found := pairs.get((new, ids[after[i]])):
                    heapq.heappush(waiting, (*found, i))
            if before[i] >= 0 and (found := pairs.get((ids[before[i]], new))):
                heapq.heappush(waiting, (*found, before[i]))
        return [i for i in ids if i >= 0]

    def merged_all(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of many short words: in every round each word merges its pair of least rank, the leftmost."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        last = np.zeros(len(data), np.int64)
        last[np.cumsum(size)[size > 0] - 1] = 1
        ids, word = self._symbols[last, data], np.repeat(np.arange(len(words)), size)
        ids, word = ids[ids >= 0], word[ids >= 0]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        none = np.int64(len(self._key))
        while len(ids):
            key = ids[:-1] * self._width + ids[1:]
            spot = np.minimum(np.searchsorted(self._key, key), max(none - 1, 0))
            rank = np.full(len(ids), none)
            there = (word[:-1] == word[1:]) & (self._key[spot] == key) if none else np.zeros(len(key), bool)
            rank[:-1][there] = self._rank[spot[there]]
            first = np.flatnonzero(np.diff(word, prepend=-1))
            # The least rank of each word, then its leftmost place.
            least = np.minimum.reduceat(rank * len(ids) + np.arange(len(ids)), first)
            ends = np.append(first[1:], len(ids))
            open_ = least // len(ids) < none
            place = least[open_] % len(ids)
            ids = ids.copy()
            ids[place] = self._new[spot[place]]
            kept = np.ones(len(ids), bool)
            kept[place + 1] = False
            going = np.repeat(open_, ends - first)
            done.append((word[~going], ids[~going]))
            ids, word = ids[going & kept], word[going & kept]
        at, ids = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*done) if done else ((), ())))
        ids = ids[np.argsort(at, kind="stable")]
        return np.split(ids, np.cumsum(np.bincount(at, minlength=len(words)))[:-1]) if words else []


_loaded: dict[str, Words] = {}


def _words(spec: str) -> Words:
    """The tokenizer of a file's content, read once by each Python worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _loaded:
        _loaded[key] = Words(spec)
    return _loaded[key]


def word_counts(documents: DataFrame, spec: Broadcast) -> DataFrame:
    """``(word, n)`` over all texts, words up to ``LONGEST`` bytes; summed in each task before anything moves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, counts = _words(spec.value), Counter()

        def said() -> pa.RecordBatch:
            kept = {w: n for w, n in counts.items() if w not in cutter.special and len(w.encode()) <= LONGEST}
            return pa.RecordBatch.from_arrays(
                [pa.array(kept.keys(), pa.string()), pa.array(kept.values(), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for text in batch.column("text"):
                counts.update(cutter.words(text.as_py() or ""))
                if len(counts) > HELD:
                    yield said()
                    counts.clear()
        yield said()

    each = documents.select("text").mapInArrow(run, "word string, n bigint")
    return each.groupBy("word").agg(F.sum("n").alias("n"))


def _handed_out(spark: SparkSession, data: bytes, name: str) -> str:
    """The name under which every executor finds ``data`` among its files; Spark fetches it from the shared folder."""
    name = f"{name}-{uuid.uuid4().hex}"
    location = f"{shared_dir(spark)}/tableferry/{name}"
    fs, path = filesystem(spark, location)
    out = fs.create(path)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    fs.deleteOnExit(path)
    spark.sparkContext.addFile(str(fs.makeQualified(path).toString()))
    return name


def lexicon(spark: SparkSession, documents: DataFrame, spec: Broadcast, size: int = LEXICON) -> str:
    """The most frequent words of all texts, ``size`` at most, as a file that every executor can map.

    Words of about one frequency come in together or not at all.
    """
    counts = stored(spark, word_counts(documents, spec).where("n > 1"), "words")
    level = F.floor(F.log2("n") * LEVELS)
    least, room = None, size
    for row in counts.groupBy(level.alias("level")).agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():
        room -= row["words"]
        if room < 0:
            break
        least = row["level"]
    top = [] if least is None else counts.where(level >= least).select("word").collect()
    merge = _words(spec.value).merged
    frequent = sorted(r["word"].encode() for r in top)
    return _handed_out(spark, compiled((w, merge(w)) for w in frequent), "lexicon")


class Encoder:
    """Words to ids: by the mapped lexicon where it has them, else by merging."""

    def __init__(self, words: Words, lexicon: Transducer):
        self.words, self.lexicon = words, lexicon
        self._special = {t.encode(): np.array([i], np.int64) for t, i in words.special.items()}

    def _others(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of words that are not in the lexicon."""
        out = [self._special.get(w) for w in words]
        short = [i for i, w in enumerate(words) if out[i] is None and len(w) <= SHORT]
        for i, ids in zip(short, self.words.merged_all([words[i] for i in short])):
            out[i] = ids
        return [np.array(self.words.merged(w), np.int64) if ids is None else ids for w, ids in zip(words, out)]

    def encode(self, values: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's ids start."""
        numbers: dict[str, int] = {}
        codes, ends = [], [0]
        for text in values:
            found = self.words.words(text or "")
            for word in set(found).difference(numbers):
                numbers[word] = len(numbers)
            codes.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
            ends.append(ends[-1] + len(found))
        distinct = [w.encode() for w in numbers]
        known, ids, starts = self.lexicon.find(distinct)
        others = self._others([distinct[i] for i in np.flatnonzero(~known)])
        n = np.diff(starts)
        begin = starts[:-1].copy()
        n[~known] = [len(x) for x in others]
        begin[~known] = len(ids) + np.cumsum(n[~known]) - n[~known]
        pool = np.concatenate([ids, *others])
        code = np.concatenate([np.zeros(0, np.int64), *codes])
        size = n[code]
        total = np.zeros(len(code) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        spot = np.arange(total[-1]) + np.repeat(begin[code] - total[:-1], size)
        return pool[spot], total[np.array(ends)]


def _encode(batches: Iterator[pa.RecordBatch], encoder: Encoder) -> Iterator[pa.RecordBatch]:
    """Replaces ``text`` by ``ids``."""
    for batch in batches:
        for block in texts.blocks(batch):
            ids, starts = encoder.encode(block.column("text").to_pylist())
            listed = texts.lists(ids.astype(np.int32), starts)
            names = [n for n in block.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(block.column(n) for n in names), listed], [*names, "ids"])


def _decode(batches: Iterator[pa.RecordBatch], words: Words) -> Iterator[pa.RecordBatch]:
    """Adds ``decoded``: what the ids spell, a space between two; null where ids are null."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("ids"))
        ids = np.asarray(column.flatten())
        count = np.asarray(pc.fill_null(pc.list_value_length(column), 0)).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(count)])
        size = np.diff(words.spelled)[ids]
        total = np.concatenate([[0], np.cumsum(size)])
        spelled = words.spelling[np.arange(total[-1]) + np.repeat(words.spelled[ids] - total[:-1], size)].tobytes()
        cuts = total[ends].tolist()
        out = [spelled[a + 1 : b] for a, b in zip(cuts[:-1], cuts[1:])]
        text = pa.array(out, pa.binary(), mask=np.asarray(column.is_null())).cast(pa.string())
        yield batch.append_column("decoded", text)


def _shared_spec(spark: SparkSession, path: str) -> Broadcast:
    """The content of a tokenizer file, which grows with its vocabulary only."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def _mapped(spec: Broadcast, file: str) -> Encoder:
    return Encoder(_words(spec.value), Transducer(SparkFiles.get(file)))


def _typed(frame: DataFrame, ddl: str) -> str:
    kept = [f"`{n}` {kind}" for n, kind in frame.dtypes]
    return ", ".join([*kept, ddl])


def encoded(spark: SparkSession, documents: DataFrame, path: str, size: int = LEXICON) -> DataFrame:
    """``(doc_id, ids)`` per row of documents: the ids of the whole text by the tokenizer file at ``path``.

    The file is read by the driver. Null and empty texts and texts of white space
    have no ids. Special tokens in a text get their own ids. Rows are treated one by
    one: repeated rows and ids are encoded alike, null ids stay null, other columns
    are not read, no rows give no rows.
    """
    spec = _shared_spec(spark, path)
    file, given = lexicon(spark, documents, spec, size), documents.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _encode(batches, _mapped(spec, file))

    return given.mapInArrow(run, _typed(given.drop("text"), "ids array<int>"))


def decoded(tokens: DataFrame, path: str) -> DataFrame:
    """``tokens`` with what their ``ids`` spell as ``decoded``; null ids give null, none give an empty text.

    An id that the vocabulary does not have is an error. All columns are kept.
    """
    spec = _shared_spec(tokens.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decode(batches, _words(spec.value))

    return tokens.mapInArrow(run, _typed(tokens, "decoded string"))


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def sha(data) -> str:
        return hashlib.sha256(data).hexdigest()

    for batch in batches:
        column, text = (batch.column(batch.schema.get_field_index(n)) for n in ("ids", "decoded"))
        ids, ends = np.asarray(column.flatten()).astype("<u4"), [0]
        ends += np.cumsum(np.asarray(pc.list_value_length(column))).tolist()
        spans = list(zip(ends[:-1], ends[1:]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([b - a for a, b in spans], pa.int64()),
                pa.array([sha(ids[a:b].tobytes()) for a, b in spans], pa.string()),
                pa.array([sha(t.as_py().encode()) for t in text], pa.string()),
            ],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def token_digests(spark: SparkSession, documents: DataFrame, path: str, size: int = LEXICON) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` per row, from encoding and decoding its whole text.

    Does in one task what :func:`encoded` and :func:`decoded` do one after the other; rows are treated
    as there, and a null text counts as empty.
    """
    spec = _shared_spec(spark, path)
    file, given = lexicon(spark, documents, spec, size), documents.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _mapped(spec, file)
        yield from _digested(_decode(_encode(batches, encoder), encoder.words))

    return given.mapInArrow(
        run, _typed(given.drop("text"), "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    )


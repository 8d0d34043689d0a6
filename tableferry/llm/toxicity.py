"""Toxicity: a support vector machine on a subsequence string kernel with Nyström landmarks.

The kernel counts common subsequences of three letters, each weighted by a factor
for every letter that it spans, up to six, and is normalised; letters put between
others, or left out, lower it a little. Words of labelled sentences that stand in
toxic ones almost alone are examples of the positive class, words of clean ones of
the negative. A Gaussian of the kernel keeps classes apart that differ in a letter; landmarks
span the feature space. Bounds of the kernel show which words lie far from every
toxic landmark, so that few need it in full. A text is as toxic as its worst word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import texts
from tableferry.llm.components import stored
from tableferry.llm.sampling import draw, fold

DECAY, SPAN = 0.85, 6
SYMBOLS = 32
WORD, STRIDE = 32, 16
#: Bounds of the training sample.
LABELLED = 20_000
POSITIVE, NEGATIVE, LANDMARKS, VARIANTS = 400, 3000, 600, 8000
LEAST_NEIGHBOURHOODS, PRECISION = 3, 0.9
#: Clean documents that must have a word for it to be known as clean.
LEAST_DOCUMENTS = 2
FLOOR = -1.0
#: Of the Gaussian; words whose string kernel with every toxic landmark is under NEAR have the floor.
SHARPNESS, NEAR = 6.0, 0.5
#: Share of a toxic landmark's length that a longer word must have in common with it to be searched for it.
HELD = 0.7
#: Kernel with a toxic landmark that a window of a longer word must have.
JOINED = 0.9
#: Kernel with a clean word at which a toxic one is trained with few changes.
CROWDED = 0.75
RIDGE = 0.05
#: Share of the best F-measure that the cut between the classes must keep.
CALIBRATION = 0.99
THRESHOLD = 0.3
#: Places of the second and third letter, and the weight of the span.
_PLACES = [(a, b, DECAY ** (b + 1)) for b in range(2, SPAN) for a in range(1, b)]

#: Symbols: letters without case, digits that stand for letters, and the last bytes of accented
#: letters in five classes; 0 is dropped.
_SYMBOL = np.zeros(256, np.int64)
for _i in range(26):
    _SYMBOL[[ord("a") + _i, ord("A") + _i]] = _i + 1
for _digit, _letter in zip("013457", "oieast"):
    _SYMBOL[ord(_digit)] = ord(_letter) - ord("a") + 1
_SYMBOL[128:192] = 27 + np.arange(64) % 32 % 5


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all words, where each word starts, and the words before each row.

    Signs inside a word are dropped; what stands between them is a word too, behind
    the others of its row; single letters in a row are one word; a long word is read
    in overlapping pieces.
    """
    begin, end, rows = texts.word_spans(data, starts)
    symbol = _SYMBOL[data]
    before = np.concatenate([[0], np.cumsum(symbol > 0)])
    letters = symbol[symbol > 0].astype(np.int32)
    low, high = before[begin], before[end]
    row = np.repeat(np.arange(len(starts) - 1), np.diff(rows))
    # Letters with a sign before them, inside a word, begin a part; bytes over 127 are no signs.
    signs = np.cumsum((symbol == 0) & (data < 128))[symbol > 0]
    cut = np.flatnonzero(np.diff(signs, prepend=signs[:1])) if len(signs) else np.zeros(0, np.int64)
    full = high > low
    low, high, row = low[full], high[full], row[full]
    single = high - low == 1
    new = np.ones(len(low), bool)
    new[1:] = ~(single[1:] & single[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(low)) - 1 if len(first) else first
    low, high, row, low_whole, high_whole, row_whole = low[first], high[last], row[first], low, high, row
    # Parts: between the begin of a word, its cuts, and its end; only of words that have cuts.
    owner = np.searchsorted(low_whole, cut, "right") - 1
    inside = (owner >= 0) & (cut > low_whole[owner]) if len(low_whole) else np.zeros(len(cut), bool)
    cut, owner = cut[inside], owner[inside]
    split = np.unique(owner)
    begins = np.concatenate([low_whole[split], cut])
    of = np.concatenate([split, owner])
    order = np.argsort(begins, kind="stable")
    begins, of = begins[order], of[order]
    same = np.append(of[1:] == of[:-1], False) if len(of) else np.zeros(0, bool)
    ends = np.where(same, np.append(begins[1:], 0), high_whole[of])
    some = ends - begins > 2
    low, high = np.concatenate([low, begins[some]]), np.concatenate([high, ends[some]])
    row = np.concatenate([row, row_whole[of[some]]])
    order = np.argsort(row, kind="stable")
    low, high, row = low[order], high[order], row[order]
    pieces = np.maximum(1, -(-(high - low - WORD) // STRIDE) + 1)
    which = np.repeat(np.arange(len(low)), pieces)
    number = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = low[which] + number * STRIDE
    size = np.minimum(start + WORD, high[which]) - start
    at = np.concatenate([[0], np.cumsum(size)])
    index = np.repeat(start - at[:-1], size) + np.arange(at[-1])
    return letters[index], at, np.searchsorted(row[which], np.arange(len(starts)))


def _subsequences(symbols: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each shape of a subsequence: number of each, the place of its first letter, and its weight."""
    left = np.repeat(starts[1:], np.diff(starts)) - np.arange(len(symbols))
    for a, b, weight in _PLACES:
        place = np.flatnonzero(left > b)
        yield (symbols[place] * SYMBOLS + symbols[place + a]) * SYMBOLS + symbols[place + b], place, weight


def features(symbols: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each word's subsequences and their weights, scaled to length one."""
    n = len(starts) - 1
    word = np.repeat(np.arange(n), np.diff(starts))
    found = [(word[p] * SYMBOLS**3 + s, np.full(len(s), w)) for s, p, w in _subsequences(symbols.astype(np.int64), starts)]
    key, where = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    mass = np.bincount(where, np.concatenate([f[1] for f in found]), minlength=len(key))
    owner = key // SYMBOLS**3
    mass = mass / np.sqrt(np.bincount(owner, mass * mass, minlength=n))[owner]
    cuts = np.searchsorted(owner, np.arange(1, n))
    return list(zip(np.split(key % SYMBOLS**3, cuts), np.split(mass, cuts)))


#: The least squared length of a word of each length: equal subsequences only add to it.
_LEAST = np.array([sum(w * w * max(0, n - b) for _, b, w in _PLACES) for n in range(WORD + 1)])


def _places(starts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all symbols of the chosen words, and where each chosen word starts among them."""
    size = starts[chosen + 1] - starts[chosen]
    at = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(starts[chosen] - at[:-1], size) + np.arange(at[-1]), at


class Landmarks:
    """Words that span the feature space, the first ``toxic`` of them toxic; only their subsequences have rows."""

    def __init__(self, marks: list[tuple[np.ndarray, np.ndarray]], toxic: int, common: np.ndarray | None = None, sizes: np.ndarray | None = None):
        keys = np.unique(np.concatenate([key for key, _ in marks]))
        self.place = np.zeros(SYMBOLS**3, np.int32)
        self.place[keys] = np.arange(1, len(keys) + 1)
        self.rows = np.zeros((len(keys) + 1, len(marks)), np.float32)
        for i, (key, mass) in enumerate(marks):
            self.rows[self.place[key], i] = mass
        self.sizes = np.full(len(marks), WORD + 1) if sizes is None else sizes
        self._index(marks[:toxic], np.ones(SYMBOLS**3) if common is None else common + 1.0)

    def _index(self, marks: list[tuple[np.ndarray, np.ndarray]], common: np.ndarray) -> None:
        """For each subsequence the toxic landmarks that it may bring near.

        Subsequences of a landmark, the heavy and uncommon first, are listed until the rest is
        shorter than ``NEAR``: a word that shares none of them cannot have so large a kernel.
        """
        pairs = []
        for i, (key, mass) in enumerate(marks):
            order = np.argsort(common[key] / mass**2, kind="stable")
            rest = 1 - np.cumsum(mass[order] ** 2)
            pairs += [(k, i) for k in key[order[: int(np.argmax(rest < NEAR**2)) + 1]].tolist()]
        listed = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.listed = listed[:, 1]
        self.first = np.searchsorted(listed[:, 0], np.arange(SYMBOLS**3 + 1))

    def kernel(self, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Similarity of each word to each landmark: the string kernel under a Gaussian."""
        shared = np.stack([mass.astype(np.float32) @ self.rows[self.place[key]] for key, mass in found])
        return np.exp(-SHARPNESS * (1 - shared.astype(np.float64)))

    def near(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words whose string kernel with a toxic landmark may reach ``NEAR``, and a bound of it; longer words and landmarks they may hold.

        A word that holds a landmark has all its subsequences, so that their product is at least the
        landmark's own length, whatever else the word has.
        """
        n, marks = len(starts) - 1, self.rows.shape[1]
        word = np.repeat(np.arange(n), np.diff(starts))
        found, owner, weights = [], [], []
        for key, place, weight in _subsequences(symbols, starts):
            found.append(key)
            owner.append(word[place])
            weights.append(np.full(len(key), weight, np.float32))
        found, owner, weights = (np.concatenate(x) for x in (found, owner, weights))
        count = self.first[found + 1] - self.first[found]
        hit = np.flatnonzero(count)
        which = np.repeat(hit, count[hit])
        step = np.arange(len(which)) - np.repeat(np.cumsum(count[hit]) - count[hit], count[hit])
        pair = np.unique(owner[which] * marks + self.listed[self.first[found[which]] + step])
        # Subsequences by word, to go through those of each pair's word.
        order = np.argsort(owner, kind="stable")
        places, weights = self.place[found[order]], weights[order]
        at = np.searchsorted(owner[order], np.arange(n + 1))
        bound, held = np.zeros(n), [np.zeros(0, np.int64)]
        length = np.diff(starts)
        least = np.sqrt(np.maximum(_LEAST[np.diff(starts)], 1e-9))
        for begin in range(0, len(pair), 20_000):
            own, mark = np.divmod(pair[begin : begin + 20_000], marks)
            index, inner = _places(at, own)
            mass = weights[index] * self.rows[places[index], np.repeat(mark, np.diff(inner))]
            product = np.add.reduceat(mass, inner[:-1])
            np.maximum.at(bound, own, product / least[own])
            longer = length[own] > self.sizes[mark] + 1
            size = np.sqrt(_LEAST[np.minimum(self.sizes[mark], WORD)])
            held.append(pair[begin : begin + 20_000][longer & (product >= HELD * size)])
        near = np.flatnonzero(bound >= NEAR)
        return near, bound[near], np.concatenate(held)

    def windows(self, symbols: np.ndarray, starts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All windows of the chosen words as long as a toxic landmark, or a letter longer: symbols, starts, the word of each."""
        sizes = np.unique(np.concatenate([[WORD], self.sizes, self.sizes + 1]))
        length = (starts[1:] - starts[:-1])[chosen]
        begin, size, word = [], [], []
        for s in sizes[sizes < WORD].tolist():
            count = np.maximum(0, length - s + 1) * (length > s)
            which = np.repeat(np.arange(len(chosen)), count)
            begin.append(starts[chosen][which] + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count))
            size.append(np.full(len(which), s))
            word.append(chosen[which])
        begin, size, word = np.concatenate(begin), np.concatenate(size), np.concatenate(word)
        at = np.concatenate([[0], np.cumsum(size)])
        return symbols[np.repeat(begin - at[:-1], size) + np.arange(at[-1])], at, word


class Known:
    """Margins of words that a task has met, by hash; forgotten when there are too many."""

    MOST = 1 << 20

    def __init__(self):
        self.hashes, self.values = np.zeros(0, np.uint64), np.zeros(0)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.zeros(len(hashes), bool)
        return self.hashes[np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)] == hashes

    def add(self, hashes: np.ndarray, values: np.ndarray) -> None:
        """New hashes in ascending order; the caller looks up what it needs before the next."""
        place = np.searchsorted(self.hashes, hashes)
        self.hashes, self.values = np.insert(self.hashes, place, hashes), np.insert(self.values, place, values)

    def margins(self, hashes: np.ndarray) -> np.ndarray:
        out = self.values[np.searchsorted(self.hashes, hashes)]
        if len(self.hashes) > self.MOST:
            self.__init__()
        return out


class Machine:
    """Landmarks and their weights, a bias, and the line that turns the worst word's margin into a score."""

    def __init__(self, landmarks: Landmarks | None = None, weights: np.ndarray | None = None, bias: float = FLOOR):
        self.landmarks, self.weights, self.bias = landmarks, weights, bias
        self.slope, self.middle = 4.0, 0.0
        #: Hashes of words that many clean documents have, though they look like insults.
        self.clean = np.zeros(0, np.uint64)

    def margins(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The margin of each word; the floor where no toxic landmark is near."""
        out = np.full(len(starts) - 1, FLOOR)
        if self.landmarks is None or not len(symbols):
            return out
        near, _, held = self.landmarks.near(symbols, starts)
        out[near] = self._evaluated(symbols, starts, near)
        np.maximum.at(out, *self.within(symbols, starts, held))
        high = np.flatnonzero(out > 0)
        hashed = texts.RangeHash(symbols.astype(np.uint8)).of(starts[high], starts[high + 1])
        out[high[np.isin(hashed, self.clean)]] = FLOOR
        return out

    def _evaluated(self, symbols: np.ndarray, starts: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        out = np.zeros(len(chosen))
        for at in range(0, len(chosen), 2048):
            index, inner = _places(starts, chosen[at : at + 2048])
            found = features(symbols[index], inner)
            out[at : at + 2048] = np.clip(self.landmarks.kernel(found) @ self.weights + self.bias, FLOOR, -FLOOR)
        return out

    def within(self, symbols: np.ndarray, starts: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words that may hold an insult, once per window, and the windows' margins; few words at a time."""
        holders = np.unique(held // self.landmarks.rows.shape[1])
        word, margin = [np.zeros(0, np.int64)], [np.zeros(0)]
        for at in range(0, len(holders), 256):
            window, inner, of = self.landmarks.windows(symbols, starts, holders[at : at + 256])
            near, bound, _ = self.landmarks.near(window, inner)
            near = near[bound >= JOINED]
            word.append(of[near])
            margin.append(self._evaluated(window, inner, near))
        return np.concatenate(word), np.concatenate(margin)

    def in_clean_words(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Toxic landmarks that stand inside these longer words, which are clean."""
        _, _, held = self.landmarks.near(symbols, starts)
        holders = np.unique(held // self.landmarks.rows.shape[1])
        found = [np.zeros(0, np.int64)]
        for at in range(0, len(holders), 256):
            window, inner, _ = self.landmarks.windows(symbols, starts, holders[at : at + 256])
            near, bound, _ = self.landmarks.near(window, inner)
            index, inner = _places(inner, near[bound >= JOINED])
            if len(index):
                kernel = self.landmarks.kernel(features(window[index], inner))
                found.append(np.unique(np.nonzero(kernel >= math.exp(-SHARPNESS * (1 - JOINED)))[1]))
        return np.unique(np.concatenate(found))

    def worst(self, data: np.ndarray, starts: np.ndarray, known: "Known | None" = None) -> np.ndarray:
        """The greatest margin of each row's words."""
        symbols, at, rows = words(data, starts)
        out = np.full(len(starts) - 1, FLOOR)
        if len(at) > 1:
            hashed = texts.RangeHash(symbols.astype(np.uint8)).of(at[:-1], at[1:])
            values, first, where = np.unique(hashed, return_index=True, return_inverse=True)
            known = known or Known()
            new = ~known.has(values)
            index, inner = _places(at, first[new])
            known.add(values[new], self.margins(symbols[index], inner))
            own = known.margins(values)[where]
            some = np.flatnonzero(np.diff(rows) > 0)
            out[some] = np.maximum.reduceat(own, rows[:-1][some])
        return out

    def score(self, margin: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the threshold is met where the margin is in the middle."""
        return 1 / (1 + np.exp(-self.slope * (margin - self.middle)) * (1 - THRESHOLD) / THRESHOLD)

    def calibrate(self, margin: np.ndarray, toxic: np.ndarray) -> None:
        """Put the middle as low as the labels allow: nearly as good as the best cut, so that changed insults pass it too."""
        order = np.argsort(-margin, kind="stable")
        hits = np.cumsum(toxic[order])
        quality = 2 * hits / (np.arange(1, len(order) + 1) + max(1, toxic.sum()))
        at = margin[order]
        # A cut is only possible between different margins.
        quality[:-1][at[:-1] == at[1:]] = 0
        quality[at <= FLOOR] = 0
        low = np.flatnonzero(quality >= CALIBRATION * quality.max())[-1]
        below = at[at < at[low]]
        self.middle = float((at[low] + (below[0] if len(below) else at[low] - 1)) / 2)


def _packed(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(values), np.concatenate([[0], np.cumsum([len(v) for v in values])])


def fit(positive: list[np.ndarray], negative: list[np.ndarray]) -> Machine:
    """Train on words of both classes; the landmarks are all toxic words and some of the clean ones nearest to them."""
    rng = np.random.Generator(np.random.PCG64(5))
    marks = Landmarks(features(*_packed(positive)), len(positive))
    close = marks.kernel(features(*_packed(negative))).max(axis=0) >= math.exp(-SHARPNESS * (1 - CROWDED))
    # Insults with a letter put in are examples too, but no landmarks: all, or as many of each as the bound
    # allows; few of a word that clean words are like, as a letter more or less is what tells it from them.
    changed = []
    for word, crowded in zip(positive, close):
        ways = [(place, letter) for place in range(1, len(word)) for letter in range(1, 27)]
        some = rng.permutation(len(ways))[: 3 if crowded else VARIANTS // len(positive)]
        changed += [np.insert(word, *ways[i]) for i in sorted(some.tolist())]
    own = positive + negative + changed
    found = features(*_packed(own))
    label = np.concatenate([np.ones(len(positive)), -np.ones(len(negative)), np.ones(len(changed))])
    common = np.zeros(SYMBOLS**3)
    for key, _ in found[len(positive) : len(positive) + len(negative) : 2]:
        common[key] += 1
    marks = Landmarks(found[: len(positive)], len(positive))
    closest = marks.kernel(found[len(positive) : len(positive) + len(negative)]).max(axis=1)
    extra = np.argsort(-closest, kind="stable")[: max(0, min(300, LANDMARKS - len(positive)))]
    chosen = found[: len(positive)] + [found[len(positive) + i] for i in extra.tolist()]
    sizes = np.full(len(chosen), WORD + 1)
    sizes[: len(positive)] = [len(word) for word in positive]
    marks = Landmarks(chosen, len(positive), common, sizes)
    # Nyström: features whose products are the kernel, as far as the landmarks tell.
    values, vectors = np.linalg.eigh(marks.kernel(chosen))
    kept = values > 1e-3
    root = vectors[:, kept] / np.sqrt(values[kept])
    z = np.column_stack([marks.kernel(found) @ root, np.ones(len(found))])
    balance = np.where(label > 0, max(1.0, len(negative) / len(positive)) ** 0.5, 1.0)
    # Changed words weigh no more than the clean ones, however many they are.
    balance[len(positive) + len(negative) :] = 0.5 * min(1.0, len(negative) / max(1, len(changed))) ** 0.5
    w = np.zeros(z.shape[1])
    for _ in range(30):
        # Newton steps of the squared hinge: a ridge regression of the words inside the margin.
        active = label * (z @ w) < 1
        scaled = z[active] * balance[active, None]
        new = np.linalg.solve(scaled.T @ z[active] + RIDGE * np.eye(len(w)), scaled.T @ label[active])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return Machine(marks, root @ w[:-1], float(w[-1]))


def _vocabulary(sample: DataFrame) -> DataFrame:
    """``(word, clean, toxic)``: clean documents with each word, and neighbourhoods it has in toxic ones.

    A neighbourhood is the words before and after; copies of a document repeat it,
    so a word is not toxic for standing in a document that was copied. Words are
    given as their symbols.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(batch):
                symbols, at, rows = words(*texts.flat(block.column("text")))
                hashed = texts.RangeHash(symbols.astype(np.uint8)).of(at[:-1], at[1:])
                row = np.repeat(np.arange(block.num_rows), np.diff(rows))
                toxic = np.asarray(block.column("toxic"))[row]
                around = np.zeros(len(hashed), np.uint64)
                around[1:] += hashed[:-1] * np.uint64(3)
                around[:-1] += hashed[1:]
                around[toxic == 0] = 0
                order = np.lexsort((around, hashed, row))
                new = np.ones(len(order), bool)
                new[1:] = np.any([x[order][1:] != x[order][:-1] for x in (row, hashed, around)], axis=0)
                kept = order[new & (np.diff(at)[order] > 2)]
                raw = symbols.astype(np.uint8).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([raw[at[i] : at[i + 1]] for i in kept.tolist()], pa.binary()),
                        pa.array(toxic[kept].astype(np.int32)),
                        pa.array(around[kept].view(np.int64)),
                    ],
                    ["word", "toxic", "around"],
                )

    found = sample.select("text", "toxic").mapInArrow(run, "word binary, toxic int, around bigint")
    counted = found.groupBy("word", "toxic", "around").agg(F.count("*").alias("n"))
    return counted.groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"),
        F.sum("toxic").alias("toxic"),
    )


def _symbols(word: bytes) -> np.ndarray:
    return np.frombuffer(word, np.uint8).astype(np.int32)


def _nearest(positive: list[np.ndarray], clean: DataFrame) -> DataFrame:
    """``(word, near)``: clean words and a bound of their string kernel with any toxic one, if it is large enough."""
    marks = Landmarks(features(*_packed(positive)), len(positive))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                data, starts = texts.flat(batch.column("word"))
                near, bound, _ = marks.near(data.astype(np.int32), starts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("word").take(pa.array(near)), pa.array(bound.astype(np.float64))], ["word", "near"]
                )

    return clean.mapInArrow(run, "word binary, near double")


def _in_clean_words(machine: Machine, clean: DataFrame) -> list[int]:
    """Numbers of the toxic landmarks that clean words have inside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = texts.flat(batch.column("word"))
            found = machine.in_clean_words(data.astype(np.int32), starts) if len(data) else []
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["mark"])

    return [r.mark for r in clean.mapInArrow(run, "mark bigint").distinct().collect()]


def _mistaken(machine: Machine, clean: DataFrame) -> np.ndarray:
    """Hashes of words of several clean documents that the machine takes for insults."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = texts.flat(batch.column("word"))
            high = machine.margins(data.astype(np.int32), starts) > 0
            hashed = texts.RangeHash(data).of(starts[:-1], starts[1:])
            yield pa.RecordBatch.from_arrays([pa.array(hashed[high].view(np.int64))], ["hashed"])

    found = clean.where(F.col("clean") >= LEAST_DOCUMENTS).select("word").mapInArrow(run, "hashed bigint").collect()
    return np.sort(np.array([r.hashed for r in found], np.int64).view(np.uint64))


def _worst_words(machine: Machine, documents: DataFrame, column: str, kind: str) -> DataFrame:
    """``column`` and the worst word's margin of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known()
        for batch in batches:
            for block in texts.blocks(batch):
                margin = machine.worst(*texts.flat(block.column("text")), known)
                yield pa.RecordBatch.from_arrays([block.column(column), pa.array(margin)], [column, "margin"])

    return documents.select(column, "text").mapInArrow(run, f"{column} {kind}, margin double")


def learn(spark: SparkSession, documents: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2) -> Machine | None:
    """Train on labels outside the held-out fold; None unless words of both classes are found.

    At most ``LABELLED`` documents are used; the driver gets their ids and margins,
    ``POSITIVE`` toxic words and a few thousand clean ones, most of them near to toxic ones.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold("doc_id", folds) != held_out))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    total = known.count()
    if not total:
        return None
    chosen = known.where(draw("doc_id") < min(1.0, LABELLED / total)).orderBy(F.xxhash64("doc_id")).limit(LABELLED)
    # The ids are bounded by LABELLED, whatever the tables' size.
    sample = documents.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    vocabulary = stored(spark, _vocabulary(sample), "vocabulary")
    counts = sample.agg(F.count("*"), F.sum("toxic")).first()
    size = vocabulary.count()
    if not counts[1] or counts[1] == counts[0] or not size:
        return None
    # Among so many words, some would be in fewer documents that are all toxic by chance.
    least = max(LEAST_NEIGHBOURHOODS, math.log(size) / math.log(counts[0] / counts[1]))
    positive = (
        vocabulary.where((F.col("toxic") >= least) & (F.col("toxic") >= PRECISION * (F.col("toxic") + F.col("clean"))))
        .orderBy(F.desc("toxic"), "word")
        .limit(POSITIVE)
        .collect()
    )
    positive = [_symbols(r.word) for r in positive]
    if not positive:
        return None
    unhurt = vocabulary.where("clean > 0 and toxic <= clean")
    clean = unhurt.select("word")
    some = clean.orderBy(F.xxhash64("word"), "word").limit(NEGATIVE // 4).collect()
    close = _nearest(positive, clean).orderBy(F.desc("near"), "word").limit(NEGATIVE).collect()
    negative = [_symbols(w) for w in sorted({r.word for r in some} | {r.word for r in close})]
    if not negative:
        return None
    machine = fit(positive, negative)
    # What clean words are made of is no insult when joined to something: only as a word of its own.
    machine.landmarks.sizes[_in_clean_words(machine, clean)] = WORD + 1
    machine.clean = _mistaken(machine, unhurt)
    seen = _worst_words(machine, sample, "toxic", "int").toPandas()
    machine.calibrate(seen.margin.to_numpy(), seen.toxic.to_numpy())
    return machine


def toxicity(spark: SparkSession, documents: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of documents.

    Null, empty and wordless texts have the lowest score; all have it when nothing
    toxic is labelled. Repeated rows score alike. Labels other than 0 and 1 are left
    out; of several for one id the highest counts.
    """
    machine = learn(spark, documents, labels, folds, held_out) or Machine()
    kept = documents.withColumn("_row", F.struct("doc_id", (fold("doc_id", folds) == held_out).alias("held_out")))
    scored = _worst_words(machine, kept, "_row", kept.schema["_row"].dataType.simpleString())
    score = 1 / (1 + F.exp(-machine.slope * (F.col("margin") - machine.middle)) * ((1 - THRESHOLD) / THRESHOLD))
    return scored.select("_row.*", score.alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

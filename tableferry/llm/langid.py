"""Language identification with a bidirectional gated recurrent network over bytes.

Both directions read windows of bytes with states of their own (one gate per
unit: it scales the old state's part in the candidate and mixes the two), every
position gets language probabilities, and a document's are the mean over its
letters. The network is trained in numpy by backpropagation through time on a
bounded sample of labelled windows; the weights are a few thousand numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import texts
from tableferry.llm.sampling import draw, fold

WINDOW = 64
UNITS = 8
#: Bounds of the training sample: labels, documents of each, and windows of each document.
MOST_LABELS = 256
DOCUMENTS_PER_LABEL = 1200
WINDOWS_PER_DOCUMENT = 3
STEPS, BATCH, RATE = 220, 192, 0.02
#: Windows that run through the network side by side.
SIDE_BY_SIDE = 4096
UNKNOWN = "und"
#: Documents with a lower mean probability are in no language that is known.
LEAST_SCORE = 0.3
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True


class Direction:
    """One direction: input rows and recurrent weights of gate and candidate, side by side."""

    def __init__(self, rng: np.random.Generator):
        self.table = rng.normal(0, 0.3, (257, 2 * UNITS)).astype(np.float32)
        self.back = rng.normal(0, 0.3, (UNITS, 2 * UNITS)).astype(np.float32)

    def states(self, symbols: np.ndarray) -> np.ndarray:
        """States after each position of ``symbols`` (positions, windows)."""
        n = symbols.shape[1]
        out = np.empty((len(symbols), n, UNITS), np.float32)
        state = np.zeros((n, UNITS), np.float32)
        # tanh serves the gate too: sigmoid(x) is (1 + tanh(x / 2)) / 2.
        half = np.concatenate([np.full(UNITS, 0.5), np.ones(UNITS)]).astype(np.float32)
        table, back = self.table * half, self.back * half
        for t, row in enumerate(symbols):
            given = table[row]
            past = state @ back
            gate = given[:, :UNITS] + past[:, :UNITS]
            np.tanh(gate, out=gate)
            gate *= 0.5
            gate += 0.5
            new = past[:, UNITS:] * gate
            new += given[:, UNITS:]
            np.tanh(new, out=new)
            new -= state
            new *= gate
            np.add(state, new, out=out[t])
            state = out[t]
        return out

    def backward(self, symbols: np.ndarray, states: np.ndarray, into: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of table and recurrent weights from those of the states, back through time."""
        table, back = np.zeros_like(self.table), np.zeros_like(self.back)
        carried = np.zeros_like(into[0])
        for t in range(len(symbols) - 1, -1, -1):
            old = states[t - 1] if t else np.zeros_like(states[0])
            given, past = self.table[symbols[t]], old @ self.back
            gate = 1 / (1 + np.exp(-(given[:, :UNITS] + past[:, :UNITS])))
            new = np.tanh(given[:, UNITS:] + gate * past[:, UNITS:])
            down = into[t] + carried
            d_new = down * gate * (1 - new * new)
            d_gate = (down * (new - old) + d_new * past[:, UNITS:]) * gate * (1 - gate)
            d_given = np.concatenate([d_gate, d_new], axis=1)
            d_past = np.concatenate([d_gate, d_new * gate], axis=1)
            np.add.at(table, symbols[t], d_given)
            back += old.T @ d_past
            carried = down * (1 - gate) + d_past @ self.back.T
        return table, back


class Network:
    """Both directions and the layer that labels every position."""

    def __init__(self, labels: list[str], seed: int = 1):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.labels = labels
        self.ahead, self.behind = Direction(rng), Direction(rng)
        self.out = rng.normal(0, 0.1, (2 * UNITS, len(labels))).astype(np.float32)
        self.bias = np.zeros(len(labels), np.float32)

    def positions(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Label probabilities at each position, and the states of both directions."""
        a, b = self.ahead.states(symbols), self.behind.states(symbols[::-1])[::-1]
        logits = a @ self.out[:UNITS]
        logits += b @ self.out[UNITS:]
        logits += self.bias
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        return logits, a, b

    def train(self, symbols: np.ndarray, label: np.ndarray, steps: int, batch: int, rate: float, seed: int = 2) -> None:
        """Adam on the mean cross entropy of all letters of random windows (windows, positions)."""
        rng = np.random.Generator(np.random.PCG64(seed))
        weights = [self.ahead.table, self.ahead.back, self.behind.table, self.behind.back, self.out, self.bias]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        by_label = [np.flatnonzero(label == k) for k in range(len(self.labels))]
        for step in range(1, steps + 1):
            # Labels get equal shares, however rare they are.
            chosen = np.concatenate([rng.choice(own, max(1, batch // len(by_label))) for own in by_label])
            x = np.ascontiguousarray(symbols[chosen].T)
            mass, a, b = self.positions(x)
            weight = (_LETTER[np.minimum(x, 255)] & (x < 256)).astype(np.float32)
            weight /= max(1.0, weight.sum())
            mass[:, np.arange(len(chosen)), label[chosen]] -= 1
            mass *= weight[:, :, None]
            flat = mass.reshape(-1, len(self.labels))
            g_out = np.concatenate([a.reshape(-1, UNITS).T @ flat, b.reshape(-1, UNITS).T @ flat])
            t1, b1 = self.ahead.backward(x, a, mass @ self.out[:UNITS].T)
            t2, b2 = self.behind.backward(x[::-1], b[::-1], (mass @ self.out[UNITS:].T)[::-1])
            now = rate * (1 - (step - 1) / steps)
            for w, g, m, v in zip(weights, (t1, b1, t2, b2, g_out, flat.sum(axis=0)), first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)


PAD = 256


def windows(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts cut to windows (positions, windows), filled up with a symbol of its own, and each window's row."""
    size = np.diff(starts)
    count = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    begin = starts[:-1][row] + number * WINDOW
    at = begin + np.arange(WINDOW)[:, None]
    inside = at < starts[1:][row]
    out = np.where(inside, data[np.where(inside, at, 0)], PAD) if len(row) else np.zeros((WINDOW, 0))
    return out.astype(np.int16), row


def learn(spark: SparkSession, documents: DataFrame, folds: int = 3, held_out: int = 1) -> Network | None:
    """Train on labelled documents outside the held-out fold; None without any.

    The driver gets at most ``MOST_LABELS * DOCUMENTS_PER_LABEL * WINDOWS_PER_DOCUMENT``
    windows of 64 characters; rarer labels beyond the bound are not learned.
    """
    known = documents.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold("doc_id", folds) != held_out)
    )
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LABELS).collect()
    if not counts:
        return None
    share = F.lit(0.0)
    for lang, n in counts:
        share = F.when(F.col("lang") == lang, min(1.0, DOCUMENTS_PER_LABEL / n)).otherwise(share)
    room = F.greatest(F.lit(1), F.length("text") - WINDOW + 1)
    place = (F.pmod(F.xxhash64("doc_id", "k"), room) + 1).cast("int")
    sample = (
        known.where(draw("doc_id") < share)
        .select("doc_id", "text", "lang", F.explode(F.sequence(F.lit(1), F.lit(WINDOWS_PER_DOCUMENT))).alias("k"))
        .select("doc_id", "k", "lang", F.substring("text", place, F.lit(WINDOW)).alias("part"))
        .orderBy(F.xxhash64("doc_id", "k"), "lang", "part")
        .limit(len(counts) * DOCUMENTS_PER_LABEL * WINDOWS_PER_DOCUMENT)
        .collect()
    )
    values = [r.part.encode()[:WINDOW] for r in sample]
    data = np.frombuffer(b"".join(values), np.uint8)
    symbols, row = windows(data, np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int64))
    labels = sorted({sample[i].lang for i in row})
    if not labels:
        return None
    network = Network(labels)
    label = np.array([labels.index(sample[i].lang) for i in row])
    network.train(symbols.T, label, STEPS, BATCH, RATE)
    return network


def _pooled(network: Network, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: sums of letter probabilities, number of letters labelled with each language, and of letters."""
    n, k = len(starts) - 1, len(network.labels)
    mass, votes, letters = np.zeros((n, k)), np.zeros((n, k)), np.zeros(n)
    symbols, row = windows(data, starts)
    for at in range(0, len(row), SIDE_BY_SIDE):
        part, rows = np.ascontiguousarray(symbols[:, at : at + SIDE_BY_SIDE]), row[at : at + SIDE_BY_SIDE]
        each = network.positions(part)[0]
        weight = (_LETTER[np.minimum(part, 255)] & (part < PAD)).astype(np.float32)
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        own = rows[first]
        mass[own] += np.add.reduceat(np.einsum("twk,tw->wk", each, weight), first, axis=0)
        best = each.argmax(axis=2)
        for j in range(k):
            votes[own, j] += np.add.reduceat(((best == j) * weight).sum(axis=0), first)
        letters[own] += np.add.reduceat(weight.sum(axis=0), first)
    return mass, votes, letters


def _judged(network: Network | None, block: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Predicted language, score and share of each row of a block."""
    column = block.column("text")
    # Bytes of 128 and more need not be letters.
    known = np.array([t is not None and any(map(str.isalpha, t)) for t in column.to_pylist()], bool)
    if not network:
        return [UNKNOWN] * len(known), np.zeros(len(known)), np.zeros(len(known))
    mass, votes, letters = _pooled(network, *texts.flat(column))
    best, rows, many = mass.argmax(axis=1), np.arange(len(known)), np.maximum(letters, 1)
    names = [network.labels[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), known.tolist())]
    return names, np.minimum(mass[rows, best] / many, 1) * known, votes[rows, best] / many * known


def identify(spark: SparkSession, documents: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, share)`` per row of documents.

    ``score`` is the mean probability of the predicted language over the letters,
    ``share`` that of letters labelled with it. Null texts, and texts without a
    letter, are ``und`` with score 0; so are all if nothing is labelled. Ties go to
    the first language by name. Repeated rows are judged alike.
    """
    network = learn(spark, documents, folds, held_out)
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(batch):
                names, score, share = _judged(network, block)
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), block.column("held_out"), *map(pa.array, (names, score, share))],
                    ["doc_id", "held_out", "lang_pred", "score", "share"],
                )

    return documents.select("doc_id", "text", (fold("doc_id", folds) == held_out).alias("held_out")).mapInArrow(
        run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, share double"
    )


def recognised(spark: SparkSession, documents: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """Documents in a language that the network knows, with all their columns.

    Null texts, texts without a letter, and those whose mean probability is under
    ``least_score`` go. If nothing is labelled, every text with a letter stays.
    """
    network = learn(spark, documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(batch, limit=texts.SMALL_BLOCK_BYTES):
                if network:
                    names, score, _ = _judged(network, block)
                    keep = [n != UNKNOWN and s >= least_score for n, s in zip(names, score.tolist())]
                else:
                    keep = [t is not None and any(map(str.isalpha, t)) for t in block.column("text").to_pylist()]
                yield block.filter(pa.array(keep, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)

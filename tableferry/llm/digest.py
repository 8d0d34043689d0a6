"""Document fingerprints: quartile bucket digests and their bounded difference.

Byte triplets of a sliding window of five bytes are hashed into buckets; a bucket's
code says between which quartiles of all bucket counts its count lies. The
fingerprint is the codes and a logarithmic length, in hexadecimal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import texts

BUCKETS = 512
#: Offsets of the second and third byte of each triplet.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
#: Differences are counted up to this many points per bucket.
BOUND = 2
LENGTH_STEPS = 8
_FACTORS = np.random.Generator(np.random.PCG64(3)).integers(1 << 30, 1 << 32, (3, 256), dtype=np.uint32)
#: What two codes of a bucket add to the difference: opposite quartiles count double.
_POINTS = np.array([0, 1, 2, 6])


def codes(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Quartile codes (0 to 3) of each text's buckets, and its length code."""
    n = len(values)
    size = np.array([len(v) for v in values], np.int64)
    data = np.frombuffer(b"".join(values), np.uint8)
    end = np.cumsum(size)
    counts = np.zeros((n + 1) * BUCKETS, np.int64)
    row = np.repeat(np.arange(n) * BUCKETS, size)
    first, second, third = (f[data] for f in _FACTORS)
    for k, (b, c) in enumerate(TRIPLETS):
        if len(data) <= c:
            continue
        m = len(data) - c
        hashed = first[:m] * np.uint32(2 * k + 1) + second[b : b + m] + third[c : c + m] * np.uint32(3)
        hashed ^= hashed >> np.uint32(15)
        hashed *= np.uint32(0x85EBCA6B)
        slot = row[:m] + (hashed >> np.uint32(23)).astype(np.int64)
        # Triplets that reach into the next text go to a row of their own.
        over = (end[:, None] - 1 - np.arange(c)).ravel()
        over = over[(over >= np.repeat(end - size, c)) & (over < m)]
        slot[over] = n * BUCKETS
        counts += np.bincount(slot, minlength=len(counts))
    counts = counts[: n * BUCKETS].reshape(n, BUCKETS)
    quartile = np.sort(counts, axis=1)[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    code = sum((counts > quartile[:, [i]]).astype(np.uint8) for i in range(3))
    length = np.minimum(np.round(np.log2(size + 1.0) * LENGTH_STEPS), 255).astype(np.uint8)
    return code, length


def written(code: np.ndarray, length: np.ndarray) -> list[str]:
    """Fingerprints in hexadecimal: the length code, then four bucket codes a byte."""
    packed = code.reshape(len(code), BUCKETS // 4, 4) @ np.array([1, 4, 16, 64], np.uint8)
    return [row.tobytes().hex() for row in np.column_stack([length, packed]).astype(np.uint8)]


def likeness(code_a, length_a, code_b, length_b) -> np.ndarray:
    """1 for equal digests, 0 from the bound on."""
    apart = _POINTS[np.abs(code_a.astype(np.int8) - code_b.astype(np.int8))].sum(axis=1)
    apart = apart + np.abs(length_a.astype(np.int64) - length_b) * (BUCKETS // 128)
    return 1 - np.minimum(apart, BOUND * BUCKETS) / (BOUND * BUCKETS)


def edited(text: str, following: str) -> str:
    """The last quarter of the characters replaced by as many (or all) of the following text's first."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _place(key: Column, bounds: list[int], low: int = 0) -> Column:
    """The number of bounds not above ``key``, by binary search."""
    if not bounds:
        return F.lit(low)
    mid = len(bounds) // 2
    return F.when(key < bounds[mid], _place(key, bounds[:mid], low)).otherwise(
        _place(key, bounds[mid + 1 :], low + mid + 1)
    )


def _neighbours(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Documents dealt out by ranges of doc_id and ordered; each range ends with a guest, the next range's first."""
    least = -(1 << 63)
    docs = documents.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(least)).alias("at")
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = 8 * parts
    # The driver gets one bound and one first id per range.
    bounds = docs.approxQuantile("at", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))
    bounds = sorted({int(b) for b in bounds})
    dealt = docs.withColumn("range", _place(F.col("at"), bounds))
    firsts = sorted(tuple(r) for r in dealt.groupBy("range").agg(F.min("at")).collect())
    before = [(at, firsts[i - 1][0]) for i, (_, at) in enumerate(firsts)]
    guests = docs.join(F.broadcast(spark.createDataFrame(before, "at bigint, range int")), "at")
    both = dealt.withColumn("guest", F.lit(0)).unionByName(guests.withColumn("guest", F.lit(1)))
    return both.repartition(parts, "range").sortWithinPartitions("range", "guest", "at", "text")


def fingerprints(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Per row: ``n_chars``, the edited text's SHA-256, both fingerprints, and likeness to the edited and the next text.

    The next document is that of the next greater doc_id, after the last the first.
    Null texts are empty; texts without a triplet have codes of 0 and are told apart
    by length alone. Null ids come first; rows with equal ids follow each other by
    text, and each is the next of the one before. A single row is its own next. No
    rows give no rows; other columns are not read.
    """
    kind = dict(documents.dtypes)["doc_id"]

    def judged(rows: list[tuple]) -> pa.RecordBatch:
        ids, own, after = zip(*rows)
        changed = [edited(a, b).encode() for a, b in zip(own, after)]
        mine = [t.encode() for t in own]
        # Most rows' next text is the row after; only the others' are counted apart.
        extra = [i for i in range(len(own)) if i + 1 == len(own) or own[i + 1] is not after[i]]
        code, length = codes(mine + [after[i].encode() for i in extra])
        place = np.arange(1, len(own) + 1)
        place[extra] = len(own) + np.arange(len(extra))
        edit, edit_length = codes(changed)
        n = len(own)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, doc_type),
                pa.array([len(t) for t in own], pa.int64()),
                pa.array([hashlib.sha256(t).hexdigest() for t in changed]),
                pa.array(written(code[:n], length[:n])),
                pa.array(written(edit, edit_length)),
                pa.array(likeness(code[:n], length[:n], edit, edit_length)),
                pa.array(likeness(code[:n], length[:n], code[place], length[place])),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    doc_type = {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, done, size = None, [], 0
        for batch in batches:
            ids, range_, guest = (batch.column(c).to_pylist() for c in ("doc_id", "range", "guest"))
            column = batch.column("text")
            for i in range(batch.num_rows):
                text = column[i].as_py()
                if waiting and waiting[0] == range_[i] and not (guest[i] and waiting[3]):
                    if not waiting[3]:
                        done.append((waiting[1], waiting[2], text))
                        size += len(waiting[2])
                if size > texts.BLOCK_BYTES // 2:
                    yield judged(done)
                    done, size = [], 0
                waiting = (range_[i], ids[i], text, guest[i])
        if done:
            yield judged(done)

    return _neighbours(spark, documents).select("doc_id", "text", "range", "guest").mapInArrow(
        run,
        f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )

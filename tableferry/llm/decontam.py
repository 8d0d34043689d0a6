"""Benchmark decontamination by greedy string tiling.

Runs of ``seed`` words, by rolling hashes, are the seeds of items and documents; both
are tables that Spark joins. A document is a candidate for an item if they share one of
the item's seeds that the documents hold most rarely: as many as a covered item cannot
avoid all of. Only candidates meet with all their seeds, which grow to maximal matches;
the longest is marked again and again among words that no tile covers yet, so that
passages count in any order. A document is contaminated by an item of which tiles
cover enough.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableferry.llm import texts
from tableferry.llm.components import prefixed, stored, unprefixed

SEED_WORDS = 5
COVERAGE = 0.5
#: Bits of the filter of item seeds that every task holds: 8 MB whatever the benchmark's size.
SIEVE_BITS = 1 << 26
#: Parts into which the documents of one seed or item are dealt.
SALTS = 8


def _seeds(words: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and hash of each run of ``k`` words; rows with fewer words have none."""
    hashed, at = texts.shingles(words, rows, k)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    fits = (np.diff(rows) >= k)[row]
    return row[fits], (np.arange(len(hashed)) - at[row])[fits], hashed[fits].view(np.int64)


def _item_seeds(benchmark: DataFrame, seed: int) -> DataFrame:
    """``(item, size, k, seed, place)`` of distinct items; one shorter than ``seed`` words is a seed as a whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(batch, limit=texts.SMALL_BLOCK_BYTES):
                words, rows = texts.trimmed_hashes(*texts.flat(block.column("text")))
                size = np.diff(rows)
                for k in sorted(set(np.minimum(size, seed).tolist()) - {0}):
                    row, place, hashed = _seeds(words, rows, k)
                    own = np.flatnonzero((size[row] == k) | (k == seed))
                    row, place, hashed = row[own], place[own], hashed[own]
                    columns = [size[row], np.full(len(row), k), hashed, place]
                    yield pa.RecordBatch.from_arrays(
                        [block.column("item").take(pa.array(row)), *map(pa.array, columns)], ["item", "size", "k", "seed", "place"]
                    )

    return benchmark.select("item", "text").mapInArrow(run, "item bigint, size bigint, k bigint, seed bigint, place bigint")


def _sieve(seeds: DataFrame) -> np.ndarray:
    """A bit for each low part of a seed, as bytes; its size does not grow with the seeds."""
    bit = F.col("seed").bitwiseAND(SIEVE_BITS - 1) + 1
    parts = seeds.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    out = np.zeros(SIEVE_BITS // 8, np.uint8)
    for part, bits in parts.collect():
        out[(part - 1) * len(bits) : part * len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def _hits(spark: SparkSession, documents: DataFrame, lengths: list[int], sieve: np.ndarray) -> DataFrame:
    """``(doc_id, doc, seed, places, copies)`` of the documents' seeds that the sieve lets through."""
    shared = spark.sparkContext.broadcast(sieve)
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, low = shared.value, SIEVE_BITS - 1
        for batch in batches:
            for block in texts.blocks(batch, limit=texts.SMALL_BLOCK_BYTES):
                words, rows = texts.trimmed_hashes(*texts.flat(block.column("text")))
                for k in lengths:
                    row, place, hashed = _seeds(words, rows, k)
                    at = hashed & low
                    hit = np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1)
                    own = block.select(["doc_id", "doc"]).take(pa.array(row[hit]))
                    yield pa.RecordBatch.from_arrays(
                        [own.column("doc_id"), own.column("doc"), pa.array(hashed[hit]), pa.array(place[hit])],
                        ["doc_id", "doc", "seed", "place"],
                    )

    named = documents.where("text is not null").select("doc_id", F.xxhash64("doc_id", "text").alias("doc"), "text")
    found = named.mapInArrow(run, f"doc_id {kind}, doc bigint, seed bigint, place bigint")
    # Repeated rows are counted before their places are put together, so that no list grows with the copies.
    single = found.groupBy("doc_id", "doc", "seed", "place").agg(F.count("*").alias("copies"))
    return single.groupBy("doc_id", "doc", "seed").agg(F.collect_list("place").alias("places"), F.max("copies").alias("copies"))


def _candidates(hits: DataFrame, seeds: DataFrame, coverage: float) -> DataFrame:
    """``(doc_id, doc, item)`` of all pairs whose tiles may cover enough, and others.

    Tiles of ``k`` words or more over a share of an item's words start at one place in
    ``k`` of them at least, so a document that covers it holds one of the item's rarest
    seeds if only fewer than that are left out. The most common are left out.
    """
    frequency = hits.groupBy("seed").agg(F.count("*").alias("n"))
    places = Window.partitionBy("item")
    needed = F.greatest(F.ceil(F.col("size") * coverage / F.col("k") - 1e-9), F.lit(1))
    ranked = (
        seeds.join(frequency, "seed", "left")
        .withColumn("rank", F.row_number().over(places.orderBy(F.coalesce("n", F.lit(0)), "seed", "place")))
        .withColumn("places", F.count("*").over(places))
    )
    rare = ranked.where((F.col("rank") <= F.col("places") - needed + 1) & F.col("n").isNotNull()).select("item", "seed").distinct()
    return hits.select("doc_id", "doc", "seed", _salt()).join(_salted(rare), ["seed", "salt"]).select("doc_id", "doc", "item").distinct()


def _salt():
    return F.pmod("doc", F.lit(SALTS)).alias("salt")


def _salted(df: DataFrame) -> DataFrame:
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))


def _matches(seeds: list[dict], k: int) -> np.ndarray:
    """Maximal matches of a document and an item: first word in the text and in the item, number of words."""
    at = [(np.array(s["places"]), np.array(s["item_places"])) for s in seeds]
    i = np.concatenate([np.repeat(a, len(b)) for a, b in at])
    j = np.concatenate([np.tile(b, len(a)) for a, b in at])
    order = np.lexsort((i, i - j))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.concatenate([[True], (i[1:] != i[:-1] + 1) | (j[1:] != j[:-1] + 1)]))
    return np.column_stack([i[first], j[first], np.diff(np.append(first, len(i))) + k - 1])


def tiled(matches: list[tuple[int, int, int]], seed: int) -> list[tuple[int, int, int]]:
    """Tiles ``(place in text, place in item, words)``: the longest match among unmarked words, again and again.

    Ties go to the earlier place in the text, then in the item.
    """
    heap = [(-n, i, j) for i, j, n in matches]
    heapq.heapify(heap)
    in_text, in_item, out = set(), set(), []
    while heap:
        n, i, j = heapq.heappop(heap)
        n = -n
        free = [i + d not in in_text and j + d not in in_item for d in range(n)]
        if all(free):
            out.append((i, j, n))
            in_text.update(range(i, i + n))
            in_item.update(range(j, j + n))
            continue
        d = 0
        while d < n:
            if free[d]:
                e = d
                while e < n and free[e]:
                    e += 1
                if e - d >= seed:
                    heapq.heappush(heap, (-(e - d), i + d, j + d))
                d = e
            d += 1
    return out


def contaminated(
    spark: SparkSession,
    documents: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    seed: int = SEED_WORDS,
) -> DataFrame:
    """``(doc_id, item_id, coverage, tiles, longest)`` for each document and item with enough coverage.

    Words are compared lower-cased and without punctuation at their ends. An item
    shorter than the seed must stand as a whole. Null or wordless items and texts
    match nothing. Repeated documents or items give repeated rows; a null id is
    given as such. An empty table on either side gives no rows. Ids may be of any type
    that Spark groups by.
    """
    kind, item_kind = dict(documents.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    items = (
        benchmark.where("text is not null")
        .groupBy("item_id", "text")
        .agg(F.count("*").alias("item_copies"))
        .withColumn("item", F.xxhash64("item_id", "text"))
    )
    items = stored(spark, items, "items")
    seeds = stored(spark, _item_seeds(items, seed), "item_seeds")
    # As many lengths as the words of a seed, at most.
    lengths = sorted(r.k for r in seeds.select("k").distinct().collect())
    if not lengths:
        return spark.createDataFrame([], f"doc_id {kind}, item_id {item_kind}, coverage double, tiles int, longest int")
    hits = stored(spark, _hits(spark, documents.select("doc_id", "text"), lengths, _sieve(seeds)), "seed_hits")
    pairs = _candidates(hits, seeds, coverage).withColumn("salt", _salt())
    whole = seeds.groupBy("item", "size", "k", "seed").agg(F.collect_list("place").alias("item_places"))
    wanted = pairs.join(_salted(whole), ["item", "salt"]).drop("salt").alias("w")
    same = F.expr("w.doc_id <=> h.doc_id and w.doc = h.doc and w.seed = h.seed")
    met = (
        wanted.join(hits.alias("h"), same)
        .groupBy("w.doc_id", "w.doc", "item")
        .agg(
            F.first("size").alias("size"),
            F.first("k").alias("k"),
            F.max("copies").alias("copies"),
            F.collect_list(F.struct("places", "item_places")).alias("seeds"),
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for row in range(batch.num_rows):
                size, k = batch.column("size")[row].as_py(), batch.column("k")[row].as_py()
                matches = _matches(batch.column("seeds")[row].as_py(), k)
                # Unmarked matches cover no more than their union.
                places = np.zeros(size + 1, np.int64)
                np.add.at(places, matches[:, 1], 1)
                np.add.at(places, matches[:, 1] + matches[:, 2], -1)
                if (np.cumsum(places)[:-1] > 0).sum() < coverage * size:
                    continue
                marked = tiled([tuple(m) for m in matches.tolist()], k)
                covered = sum(n for _, _, n in marked)
                if covered >= coverage * size:
                    kept.append((row, covered / size, len(marked), max(n for _, _, n in marked)))
            row, share, tiles, longest = zip(*kept) if kept else ((), (), (), ())
            own = batch.select(["doc_id", "item", "copies"]).take(pa.array(row, pa.int64()))
            found = [pa.array(share, pa.float64()), pa.array(tiles, pa.int32()), pa.array(longest, pa.int32())]
            yield pa.RecordBatch.from_arrays([*own.columns, *found], ["doc_id", "item", "copies", "coverage", "tiles", "longest"])

    found = met.drop("doc").mapInArrow(run, f"doc_id {kind}, item bigint, copies bigint, coverage double, tiles int, longest int")
    again = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies") * F.col("item_copies")))
    rows = found.join(items.select("item", "item_id", "item_copies"), "item").withColumn("copy", again)
    return rows.select("doc_id", "item_id", "coverage", "tiles", "longest")


def clean(spark: SparkSession, documents: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Documents that no item contaminates, judged row by row: a repeated id does not drop its clean rows."""
    keyed = prefixed(documents).withColumn("key", F.xxhash64("own_doc_id", F.coalesce("own_text", F.lit(""))))
    by_key = keyed.select(F.col("key").alias("doc_id"), F.col("own_text").alias("text"))
    bad = contaminated(spark, by_key, benchmark, coverage).select(F.col("doc_id").alias("key")).distinct()
    return unprefixed(keyed.join(bad, "key", "left_anti"), documents.columns)

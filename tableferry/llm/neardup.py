"""Near-duplicate documents: one-permutation hashing with optimal densification, banded
buckets, star-shaped candidate edges, and links confirmed on full shingle sets.

Equal sets share one node, so copies never make pairs. A bucket of nodes gives
an edge from each member to each of a few centres. Where a bucket still joins several
components after these were judged, its nodes are joined exactly, by the rarest
shingles of each set.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tableferry.llm import texts
from tableferry.llm.components import components, prefixed, stored, unprefixed

SHINGLE_WORDS = 5
PERCENT = 80
BANDS, ROWS = 32, 4
#: Members of a bucket that all others are compared with.
CENTRES = 3
#: The centre of a bucket is the node nearest to this value, by exclusive or.
_CENTRES = np.random.Generator(np.random.PCG64(9)).integers(-(1 << 63), 1 << 63, 64, dtype=np.int64)


def signatures(values: np.ndarray, rows: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation signatures of rows of distinct hashes, empty rows left out by the caller.

    The hash space is cut into ``bins``; a bin keeps its least hash. An empty bin
    takes the value of the first filled bin in its own probe sequence, the same
    for all documents (optimal densification).
    """
    n = len(rows) - 1
    row = np.repeat(np.arange(n), np.diff(rows))
    permuted = texts.mixed(values + np.uint64(0x5851F42D4C957F2D))
    slot = row * bins + (permuted >> np.uint64(32)).astype(np.int64) % bins
    kept = np.full(n * bins, np.uint64(0xFFFFFFFFFFFFFFFF))
    np.minimum.at(kept, slot, permuted)
    kept = kept.reshape(n, bins)
    empty = np.ones(n * bins, bool)
    empty[slot] = False
    out, open_ = kept.copy(), empty.reshape(n, bins)
    filled = ~open_
    r, b = np.nonzero(open_)
    attempt = 0
    while len(r):
        attempt += 1
        probe = texts.mixed((b * 1_000_003 + attempt).astype(np.uint64)) % np.uint64(bins)
        hit = filled[r, probe.astype(np.int64)]
        out[r[hit], b[hit]] = kept[r[hit], probe[hit].astype(np.int64)]
        r, b = r[~hit], b[~hit]
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One key per band: a hash of the band's number and its values."""
    n, bins = signature.shape
    parts = signature.reshape(n, bands, bins // bands)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands)).copy()
    for i in range(bins // bands):
        key = texts.mixed(key * np.uint64(0x2545F4914F6CDD1D) + parts[:, :, i])
    return key


def _sets(block: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    words, rows = texts.word_hashes(*texts.flat(block.column("text")))
    return texts.row_sets(*texts.shingles(words, rows, k))


def _nodes(values: np.ndarray, rows: np.ndarray) -> list[int | None]:
    """A key of each row's set; None for an empty one."""
    raw, out = values.tobytes(), []
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
        digest = hashlib.blake2b(raw[8 * a : 8 * b], digest_size=8).digest()
        out.append(int.from_bytes(digest, "little", signed=True) if b > a else None)
    return out


def signed(documents: DataFrame, k: int, bands: int, rows: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, n_shingles, node, bands)`` and carried columns per row; without words node is null and bands are empty."""
    given = documents.select("doc_id", *carried, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(batch, limit=texts.SMALL_BLOCK_BYTES):
                values, at = _sets(block, k)
                full = np.diff(at) > 0
                some = np.concatenate([[0], np.cumsum(np.diff(at)[full])])
                keys = band_keys(signatures(values, some, bands * rows), bands).view(np.int64)
                places = np.concatenate([[0], np.cumsum(full)]) * bands
                listed = texts.lists(keys.ravel(), places)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(block.column(c) for c in ("doc_id", *carried)),
                        *(pa.array(np.diff(at)), pa.array(_nodes(values, at), pa.int64()), listed),
                    ],
                    ["doc_id", *carried, "n_shingles", "node", "bands"],
                )

    kept = ", ".join(f"`{name}` {kind}" for name, kind in given.drop("text").dtypes)
    return given.mapInArrow(run, f"{kept}, n_shingles bigint, node bigint, bands array<bigint>")


def _shingle_sets(documents: DataFrame, k: int) -> DataFrame:
    """``(node, shingles)`` of each row with words, recomputed from its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(batch, limit=texts.SMALL_BLOCK_BYTES):
                values, at = _sets(block, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_nodes(values, at), pa.int64()), texts.lists(values.view(np.int64), at)],
                    ["node", "shingles"],
                )

    return documents.select("text").mapInArrow(run, "node bigint, shingles array<bigint>").where("node is not null")


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets overlap enough; both sets are compared in full."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    sized = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("left", "right")).cast("bigint")
    return sized.where(
        shared * 100 >= percent * (F.size("left") + F.size("right") - shared)
    ).select("a", "b")


def _star_pairs(members: DataFrame, centres: int, percent: int) -> DataFrame:
    """All pairs ``(a, b)`` of a bucket's member and one of its centres whose sizes allow a link."""
    nearest = []
    for flip in map(int, _CENTRES[:centres]):
        least = F.min(F.struct(F.col("node").bitwiseXOR(F.lit(flip)).alias("flipped"), "n_shingles"))
        nearest.append(
            F.struct(least["flipped"].bitwiseXOR(F.lit(flip)).alias("centre"), least["n_shingles"].alias("centre_shingles"))
        )
    chosen = members.groupBy("band").agg(F.array_distinct(F.array(*nearest)).alias("centres"))
    return (
        members.join(chosen, "band")
        .select("node", "n_shingles", F.inline("centres"))
        .where("node <> centre")
        # Sets of too different sizes cannot share so much of their union.
        .where(F.least("n_shingles", "centre_shingles") * 100 >= F.greatest("n_shingles", "centre_shingles") * percent)
        .select(F.greatest("centre", "node").alias("a"), F.least("centre", "node").alias("b"))
        .distinct()
    )


def _placed(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _merged(spark: SparkSession, found: DataFrame, roots: DataFrame) -> DataFrame:
    return components(spark, found.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))


def _open(members: DataFrame, roots: DataFrame, n_centres: int) -> DataFrame:
    """``(node, n_shingles)`` in buckets of several components where two members or more were never a centre."""
    centres = [F.min(F.col("node").bitwiseXOR(F.lit(int(c)))).bitwiseXOR(F.lit(int(c))) for c in _CENTRES[:n_centres]]
    tried = F.size(F.array_distinct(F.array(*centres))) if n_centres else F.lit(0)
    left = (
        _placed(members, roots)
        .groupBy("band")
        .agg(F.min("root").alias("lo"), F.max("root").alias("hi"), (F.count("*") - tried).alias("n"))
        .where("lo <> hi and n > 1")
    )
    return members.join(left.select("band"), "band", "left_semi").select("node", "n_shingles").distinct()


def _prefixes(open_nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(band, node, n_shingles, rest)``: the rarest shingles of each set, and how many of its shingles do not come before.

    With all sets in one order, two that overlap enough share a shingle among
    their first; their overlap is at most the lesser rest at the first they share.
    A shingle of one set only comes before all others and needs no row.
    """
    each = open_nodes.join(sets, "node").select("node", "n_shingles", F.explode("shingles").alias("band"))
    shared = each.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    own = W.partitionBy("node")
    place = F.row_number().over(own.orderBy(F.desc("n"), F.desc("band")))
    return (
        each.join(shared, "band")
        .withColumn("rest", place.cast("bigint"))
        .where(F.col("rest") * 100 >= F.col("n_shingles") * percent)
        .select("band", "node", "n_shingles", "rest")
    )


#: Members of one component and one shingle that are compared in one tile, and of small components together.
TILE = 256


def _allowed(spark: SparkSession, prefixes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that the filters of size and place allow, by tiles of bounded size."""
    # Of a pair the smaller set must have this much left.
    able = F.max((F.col("rest") * (100 + percent) >= 2 * percent * F.col("n_shingles")).cast("int"))
    placed = _placed(prefixes, roots)
    by_root = placed.groupBy("band", "root").agg(F.count("*").alias("of_root"), able.alias("able"))
    # Sets whose sizes are more than one class apart cannot be linked.
    size_class = F.floor(F.log("n_shingles") / (F.log(F.lit(100.0 / percent)) + 1e-9)) if percent < 100 else F.col("n_shingles")
    live = (
        by_root.groupBy("band")
        .agg(F.count("*").alias("of_band"), F.sum("of_root").alias("n"), F.max("able").alias("able"))
        .where("of_band > 1 and able = 1")
        .select("band", F.ceil(F.col("n") / TILE).alias("parts"))
    )
    crowd = F.col("of_root") > TILE
    tile = F.struct(
        size_class.cast("bigint").alias("size"),
        F.when(crowd, F.col("root")).alias("alone"),
        F.when(crowd, F.pmod(F.xxhash64("node"), F.ceil(F.col("of_root") / TILE))).otherwise(
            F.pmod(F.xxhash64("root"), F.col("parts"))
        ).alias("part"),
    )
    entry = F.struct("node", "root", "n_shingles", "rest")
    tiles = stored(
        spark,
        placed.join(by_root.drop("able"), ["band", "root"])
        .join(live, "band")
        .groupBy("band", tile.alias("tile"))
        .agg(F.collect_list(entry).alias("entries")),
        "tiles",
    )
    names = tiles.select("band", "tile", F.xxhash64("tile").alias("order"))
    left, right = names.toDF("band", "tile", "order"), names.toDF("band", "tile2", "order2")
    both = left.join(right, "band").where(
        (F.col("order") <= F.col("order2"))
        & (F.abs(F.col("tile.size") - F.col("tile2.size")) <= 1)
        & ~F.coalesce(F.col("tile.alone") == F.col("tile2.alone"), F.lit(False))
    )
    full = (
        both.select("band", "tile", "tile2")
        .join(tiles.withColumnRenamed("entries", "left"), ["band", "tile"])
        .join(tiles.toDF("band", "tile2", "right"), ["band", "tile2"])
        .select("left", "right")
    )

    def columns(entries: pa.Array) -> list[np.ndarray]:
        return [np.asarray(entries.field(i)).astype(np.int64) for i in range(4)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                node, root, size, rest = columns(batch.column("left")[row].values)
                node2, root2, size2, rest2 = columns(batch.column("right")[row].values)
                overlap = np.minimum(rest[:, None], rest2) * (100 + percent)
                x, y = np.nonzero((overlap >= percent * (size[:, None] + size2)) & (root[:, None] != root2))
                if len(x):
                    pair = np.unique(np.stack([np.maximum(node[x], node2[y]), np.minimum(node[x], node2[y])], 1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], ["a", "b"])

    return full.mapInArrow(run, "a bigint, b bigint").distinct()


def _rest(
    spark: SparkSession, members: DataFrame, sets: DataFrame, roots: DataFrame, judged: DataFrame, percent: int, centres: int
) -> DataFrame:
    """Roots after every pair that shares an open bucket was judged, or ruled out by a filter."""
    left = stored(spark, _open(members, roots, centres), "open")
    if not left.take(1):
        return roots
    prefixes = stored(spark, _prefixes(left, sets, percent), "prefixes")
    # Stars first: they spare most pairs of a group that is only reached now.
    stars = stored(spark, _star_pairs(prefixes, 1, percent).join(judged, ["a", "b"], "left_anti"), "pairs")
    found = stored(spark, _linked(_between(stars, roots), sets, percent), "links")
    roots = _merged(spark, found, roots)
    judged = judged.unionByName(stars)
    pairs = stored(spark, _allowed(spark, prefixes, roots, percent).join(judged, ["a", "b"], "left_anti"), "pairs")
    found = stored(spark, _linked(pairs, sets, percent), "links")
    return _merged(spark, found, roots)


def _between(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs that are not of one component yet."""
    left, right = (roots.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in "ab")
    joined = pairs.join(left, "a", "left").join(right, "b", "left")
    return joined.where(F.coalesce("a_root", "a") != F.coalesce("b_root", "b")).select("a", "b")


def grouped(
    spark: SparkSession,
    documents: DataFrame,
    k: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    centres: int = CENTRES,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """``(doc_id, carried..., n_shingles, root, component_id)`` per row: root is the component, null without words."""
    docs = stored(spark, signed(documents, k, bands, rows, carried), "signed", texts.BATCH_ROWS)
    entries = docs.where("node is not null").select("node", "n_shingles", F.explode("bands").alias("band"))
    shared = (
        entries.groupBy("band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("band")
    )
    members = stored(spark, entries.join(shared, "band").distinct(), "members")
    nodes = members.select("node", "n_shingles").distinct()
    wanted = (
        docs.join(nodes.select("node"), "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    )
    # One row per node: its least document. Nodes of null ids only are found by a null id.
    texts_of = documents.select("doc_id", "text").join(
        wanted.select(F.col("doc_id").alias("wanted_id")).distinct(),
        F.col("doc_id").eqNullSafe(F.col("wanted_id")),
        "left_semi",
    )
    sets = stored(
        spark,
        _shingle_sets(texts_of, k).join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"]),
        "sets",
        texts.BATCH_ROWS,
    )
    judged = stored(spark, _star_pairs(members, centres, percent), "pairs")
    roots = components(spark, stored(spark, _linked(judged, sets, percent), "links"))
    roots = _rest(spark, members, sets, roots, judged, percent, centres)
    first = docs.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("first"))
    placed = first.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    final = stored(spark, placed.join(least, "root").select("node", "root", "component_id"), "placed")
    columns = ["doc_id", *carried, "n_shingles"]
    with_words = docs.where("node is not null").join(final, "node").select(*columns, "root", "component_id")
    without = docs.where("node is null").select(
        *columns, F.lit(None).cast("bigint").alias("root"), F.col("doc_id").alias("component_id")
    )
    return with_words.unionByName(without)


def near_duplicates(
    spark: SparkSession, documents: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT, **more
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of documents.

    Documents whose sets of ``k``-word shingles share ``percent`` of their union
    are linked; a component's id is its least doc_id, and that document is kept.
    At similarity 0.8 a pair misses all 32 bands with a chance of 5e-8.

    Null or wordless texts have an empty set and their own id; they are kept.
    Repeated rows and ids share a component and are kept alike. A null doc_id is
    ignored in the minimum; a component of null ids only has a null id and is
    kept. No rows give no rows; other columns are not read.
    """
    return grouped(spark, documents, k, percent, **more).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def without_duplicates(spark: SparkSession, documents: DataFrame, **more) -> DataFrame:
    """One document of each component, the one with the least doc_id, with all its columns.

    Wordless texts are linked with nothing and stay. Of rows that share the least id
    (or have none), one stays.
    """
    keyed = prefixed(documents).withColumn("key", F.xxhash64("own_doc_id", F.coalesce("own_text", F.lit(""))))
    found = grouped(
        spark, keyed.select(F.col("own_doc_id").alias("doc_id"), F.col("own_text").alias("text"), "key"), carried=("key",), **more
    )
    first = (
        found.where(F.col("root").isNotNull() & F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.min("key").alias("key"))
    )
    worded = F.coalesce(F.col("own_text").rlike("[^ \\x09-\\x0D]"), F.lit(False))
    whole = [F.col(f"`own_{c}`") for c in documents.columns]
    order = [F.col(f"`own_{c}`") for c, kind in documents.dtypes if c != "text" and not kind.startswith(("map", "variant"))]
    # Each task brings repeats of a row down to one before they meet.
    single = keyed.where(worded).groupBy("key").agg(F.min_by(F.struct(*whole), F.struct(*order)).alias("row"))
    kept = single.join(stored(spark, first.select("key"), "kept"), "key", "left_semi").select("row.*")
    return unprefixed(kept.unionByName(keyed.where(~worded).drop("key")), documents.columns)

"""Removal of byte strings that stand at more than one place of the corpus.

A string of ``length`` bytes is repeated if it starts anywhere else. Every such
string contains its anchor, the least-hashed gram inside it, so equal strings have
equal anchors, at equal depths. Strings around one place of an anchor form a segment;
in periodic text equal segments that follow each other are kept as one and a number.
Segments whose anchor occurs once are unique, and equal segments are counted before any of
their bytes move. Of the others, strings at a range of depths all hold the same core
of bytes, and only those whose core occurs again go on. They are dealt out to shards
by anchor; each shard is suffix-sorted by external induced sorting, and common
prefixes of ``length`` bytes or more between neighbours show what is repeated. A core
with too many distinct segments for one shard is narrowed to cores of fewer depths,
at last of one, spread over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import texts
from tableferry.llm.components import prefixed, stored, unprefixed
from tableferry.llm.induced import CHUNK, Spool, Workspace, sorted_suffixes

LENGTH = 400
GRAM = 100
SHARD_BYTES = 1_000_000
#: Distinct segments of one anchor that are still sorted together.
SHARD_SEGMENTS = 250
#: Records of each structure that a sort keeps in memory.
MEMORY = 1 << 20
SEPARATOR = 1
#: Ranges of depths whose cores are compared before sorting, and the depths of a range when a crowd is narrowed.
RANGES = 4
NARROWER = (15, 3, 1)
_KEYS = ("_key", "_key2")


def _range_width(length: int, gram: int) -> int:
    return -(-(length - gram + 1) // RANGES)


def _cores(hashes: texts.RangeHash, anchor, deepest, starts, length: int, width: int, blocks: range) -> np.ndarray:
    """For each block of ``width`` depths the hash of what all its strings hold; 0 where a segment has none of them."""
    out = np.zeros((len(anchor), len(blocks)), np.uint64)
    for j, block in enumerate(blocks):
        some = np.flatnonzero((deepest >= block * width) & (deepest - starts + 1 < (block + 1) * width))
        low = anchor[some] - block * width
        out[some, j] = hashes.of(low, low - width + 1 + length) | np.uint64(1)
    return out


def keyed(documents: DataFrame) -> DataFrame:
    """Documents with a key per row; equal keys are equal ids and texts, which are repeated alike."""
    text = F.coalesce("text", F.lit(""))
    return documents.withColumn("_key", F.xxhash64("doc_id", text)).withColumn("_key2", F.hash(text))


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each run of ``width``, by running minima of blocks from both sides."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def _segments(data: np.ndarray, starts: np.ndarray, length: int, gram: int):
    """Runs of string starts with one place of an anchor: row, first start in the row, number of starts, anchor,
    digest, how many times the run follows itself, depth of the first start, and cores."""
    counts = np.maximum(np.diff(starts) - length + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    if not len(row):
        return None
    before = np.concatenate([[0], np.cumsum(counts)])
    pos = starts[:-1][row] + np.arange(len(row)) - before[row]
    hashes = texts.RangeHash(data)
    grams = texts.mixed((hashes.sums[gram:] - hashes.sums[:-gram]) * hashes.down[: len(data) - gram + 1])
    low = np.uint64(0xFFFFFFFF)
    # Of equal hashes the rightmost is taken, by its place in the low half.
    ranked = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
    anchor = (low - (_least_in_windows(ranked, length - gram + 1)[pos] & low)).astype(np.int64)
    found = grams[anchor]
    new = np.ones(len(row), bool)
    # At another place of the anchor depths start anew.
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(row)) - 1
    digest = hashes.of(pos[first], pos[last] + length)
    depth, count = anchor[first] - pos[first], last - first + 1
    # In periodic text a run follows itself: the first stands for all of them.
    fresh = np.ones(len(first), bool)
    fresh[1:] = np.any([x[1:] != x[:-1] for x in (row[first], found[first], digest)], axis=0)
    lead = np.flatnonzero(fresh)
    times = np.diff(np.append(lead, len(first)))
    first, digest, depth, count = first[lead], digest[lead], depth[lead], count[lead]
    width = _range_width(length, gram)
    cores = _cores(hashes, anchor[first], depth, count, length, width, range(RANGES))
    return row[first], pos[first] - starts[:-1][row[first]], count, found[first], digest, times, depth, cores


def segments(documents: DataFrame, length: int, gram: int) -> DataFrame:
    """All segments of keyed documents, without their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(batch, limit=texts.SMALL_BLOCK_BYTES // 2):
                got = _segments(*texts.flat(block.column("text")), length, gram)
                if got is None:
                    continue
                row, first, count, anchor, digest, times, depth, cores = got
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("_key").take(pa.array(row)),
                        block.column("_key2").take(pa.array(row)),
                        pa.array(first.astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        pa.array(anchor.view(np.int64)),
                        pa.array(digest.view(np.int64)),
                        pa.array(times.astype(np.int32)),
                        pa.array(depth.astype(np.int32)),
                        texts.lists(cores.view(np.int64).ravel(), np.arange(len(row) + 1) * RANGES),
                    ],
                    ["_key", "_key2", "first", "starts", "anchor", "digest", "times", "depth", "cores"],
                )

    return documents.select("_key", "_key2", "text").mapInArrow(
        run, "_key bigint, _key2 int, first int, starts int, anchor bigint, digest bigint, times int, depth int, "
        "cores array<bigint>"
    )


def _with_shared_cores(distinct: DataFrame, length: int, gram: int) -> DataFrame:
    """Distinct segments by range of depths, where the range's core occurs again: offset and number of its starts."""
    width = _range_width(length, gram)
    ranges = distinct.select(
        "anchor", "digest", "copies", *_KEYS, "first", "starts", "depth", F.posexplode("cores").alias("range", "core")
    ).where("core <> 0")
    shared = (
        ranges.groupBy("anchor", "range", "core")
        .agg(F.sum("copies").alias("n"), (F.count("*") > SHARD_SEGMENTS).alias("many"))
        .where("n > 1")
        .drop("n")
    )
    deepest = F.least(F.col("depth"), (F.col("range") + 1) * width - 1)
    flattest = F.greatest(F.col("depth") - F.col("starts") + 1, F.col("range") * width)
    columns = ["anchor", "digest", "copies", *_KEYS, "first"]
    return ranges.join(shared, ["anchor", "range", "core"]).select(
        *columns, (F.col("depth") - deepest).alias("offset"), (deepest - flattest + 1).alias("starts"), deepest.alias("depth"), "many"
    )


PIECE = ("anchor", "digest", "copies", "offset", "starts", "depth", "many")
PIECE_DDL = "anchor bigint, digest bigint, copies bigint, offset int, starts int, depth int"


def _joined_parts(parts: list[dict]) -> list[dict]:
    """Ranges of one segment that follow each other as one, unless they are of a crowd."""
    out: list[dict] = []
    for part in sorted(parts, key=lambda p: (p["anchor"], p["digest"], p["many"], p["offset"])):
        last = out[-1] if out else None
        if last and not part["many"] and all(last[k] == part[k] for k in ("anchor", "digest", "many", "first")):
            if last["offset"] + last["starts"] == part["offset"]:
                last["starts"] += part["starts"]
                continue
        out.append(dict(part))
    return out


def _cut_out(documents: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted parts of segments with their bytes, each cut from one occurrence."""
    each = wanted.groupBy(*_KEYS).agg(F.collect_list(F.struct("first", *PIECE)).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(batch, limit=texts.SMALL_BLOCK_BYTES):
                data, at = texts.flat(block.column("text"))
                raw, rows = data.tobytes(), []
                for start, parts in zip(at.tolist(), block.column("parts").to_pylist()):
                    for part in _joined_parts(parts):
                        low = start + part["first"] + part["offset"]
                        rows.append((*(part[k] for k in PIECE), raw[low : low + part["starts"] + length - 1]))
                if rows:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows), types)), [*PIECE, "bytes"])

    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
    return (
        documents.select(*_KEYS, "text")
        .dropDuplicates(list(_KEYS))
        .join(each, list(_KEYS))
        .select("text", "parts")
        .mapInArrow(run, f"{PIECE_DDL}, many boolean, bytes binary")
    )


def _repeated_starts(order, lcp, own_weight, length: int, n: int, work: Workspace) -> np.ndarray:
    """Marks the owned starts of strings that stand at two places or more; neighbours in order share them."""
    marked = work.array(n, bool)
    weight, waiting = 0, None
    for at in range(0, len(order), CHUNK):
        pos = np.asarray(order[at : at + CHUNK])
        joins = np.asarray(lcp[at : at + CHUNK]) >= length
        own = own_weight(pos)
        group = np.cumsum(~joins)
        sums = np.bincount(group, own, minlength=group[-1] + 1).astype(np.int64)
        # The first group goes on from the chunk before.
        sums[0] += weight
        repeated = sums >= 2
        if repeated[0] and waiting is not None:
            marked[waiting] = True
            waiting = None
        marked[pos[(own > 0) & repeated[group]]] = True
        last = group[-1]
        if last > 0:
            waiting = None
        weight = int(sums[last])
        if weight < 2:
            single = pos[(group == last) & (own > 0)]
            waiting = single[0] if len(single) else waiting
    return marked


def _runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of marks."""
    change = np.diff(marked.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1) - 1


def _verdict(anchor, digest, row, first, last) -> pa.RecordBatch:
    counts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(anchor)))]).astype(np.int32)
    runs = pa.StructArray.from_arrays([pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))], ["a", "b"])
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor, pa.int64()), pa.array(digest, pa.int64()), pa.ListArray.from_arrays(pa.array(counts), runs)],
        ["anchor", "digest", "runs"],
    )


VERDICT = "anchor bigint, digest bigint, runs array<struct<a: int, b: int>>"


def _sorted_verdicts(pieces: DataFrame, shards: int, length: int) -> DataFrame:
    """Repeated starts of each segment, from the suffix order of its shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = Workspace(MEMORY)
        symbols, columns = Spool(work, np.uint16), {n: [] for n in ("anchor", "digest", "copies", "starts", "offset", "size")}
        for batch in batches:
            if not batch.num_rows:
                continue
            data, at = texts.flat(batch.column("bytes"))
            # Each segment is followed by a separator, which is smaller than any byte.
            out = np.full(len(data) + batch.num_rows, SEPARATOR, np.uint16)
            out[np.arange(len(data)) + np.repeat(np.arange(batch.num_rows), np.diff(at))] = data.astype(np.uint16) + 2
            symbols.add(out)
            for name in ("anchor", "digest", "copies", "starts", "offset"):
                columns[name].append(np.asarray(batch.column(name)))
            columns["size"].append(np.diff(at) + 1)
        if not len(symbols):
            return
        column = {n: np.concatenate(parts) for n, parts in columns.items()}
        begin = np.concatenate([[0], np.cumsum(column["size"])])
        text = work.array(len(symbols), np.uint16)
        for at in range(0, len(symbols), CHUNK):
            text[at : at + CHUNK] = symbols.read(at, min(at + CHUNK, len(symbols)))

        def own_weight(pos: np.ndarray) -> np.ndarray:
            """Copies of the string at each place, 0 for places that other segments answer for."""
            row = np.searchsorted(begin, pos, "right") - 1
            return np.where(pos - begin[row] < column["starts"][row], column["copies"][row], 0)

        order, lcp = sorted_suffixes(text, 257, length, work)
        first, last = _runs(_repeated_starts(order, lcp, own_weight, length, len(text), work))
        row = np.searchsorted(begin, first, "right") - 1
        shift = column["offset"][row] - begin[row]
        yield _verdict(column["anchor"], column["digest"], row, first + shift, last + shift)

    return pieces.repartition(shards, "anchor").mapInArrow(run, VERDICT)


def _narrowed(pieces: DataFrame, length: int, width: int) -> DataFrame:
    """Pieces of crowds cut into parts of at most ``width`` depths, with core and content as hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in texts.blocks(batch, "bytes", texts.BLOCK_BYTES // 4):
                data, at = texts.flat(block.column("bytes"))
                hashes, raw = texts.RangeHash(data), data.tobytes()
                depth, starts, offset = (np.asarray(block.column(n)).astype(np.int64) for n in ("depth", "starts", "offset"))
                low, high = (depth - starts + 1) // width, depth // width
                row = np.repeat(np.arange(block.num_rows), high - low + 1)
                part = low[row] + np.arange(len(row)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1)
                deepest = np.minimum(depth[row], (part + 1) * width - 1)
                count = deepest - np.maximum(depth[row] - starts[row] + 1, part * width) + 1
                begin = at[row] + depth[row] - deepest
                anchor = at[row] + depth[row]
                core = hashes.of(anchor - part * width, anchor - part * width - width + 1 + length)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(block.column(n).take(take) for n in ("anchor", "digest", "copies")),
                        pa.array((offset[row] + depth[row] - deepest).astype(np.int32)),
                        pa.array(count.astype(np.int32)),
                        pa.array(deepest.astype(np.int32)),
                        pa.array(core.view(np.int64)),
                        pa.array(hashes.of(begin, begin + count + length - 1).view(np.int64)),
                        pa.array([raw[a : a + n] for a, n in zip(begin.tolist(), (count + length - 1).tolist())], pa.binary()),
                    ],
                    [*PIECE[:-1], f"core{width}", "content", "bytes"],
                )

    return pieces.mapInArrow(run, f"{PIECE_DDL}, core{width} bigint, content bigint, bytes binary").withColumnRenamed(
        f"core{width}", "core"
    )


def _crowd_verdicts(spark: SparkSession, pieces: DataFrame, length: int) -> DataFrame:
    """Repeated starts where a core has very many distinct segments.

    A part whose core stands once is unique; parts of one core and equal content are
    repeated as a whole; the others go on with fewer depths. At one depth core and
    content are the string itself.
    """
    found = spark.createDataFrame([], VERDICT)
    for width in NARROWER:
        parts = stored(spark, _narrowed(pieces, length, width), "narrowed")
        block = F.floor(F.col("depth") / width).alias("block")
        shared = (
            parts.groupBy("anchor", block, "core")
            .agg(F.sum("copies").alias("n"), F.min("content").alias("lo"), F.max("content").alias("hi"))
            .where("n > 1")
            .select("anchor", "block", "core", F.expr("lo = hi").alias("whole"))
        )
        judged = stored(spark, parts.withColumn("block", block).join(shared, ["anchor", "block", "core"]), "judged")
        run = F.struct(F.col("offset").alias("a"), (F.col("offset") + F.col("starts") - 1).alias("b"))
        found = found.unionByName(judged.where("whole").select("anchor", "digest", F.array(run).alias("runs")))
        pieces = judged.where("not whole").select(*PIECE[:-1], "bytes")
    return found


def repeated_spans(
    spark: SparkSession, documents: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """``(_key, _key2, spans)`` for keyed documents with repeated strings; spans may overlap."""
    found = stored(spark, segments(documents, length, gram), "segments", texts.BATCH_ROWS)
    shared = (
        found.groupBy("anchor")
        .agg(F.sum("times").alias("n"), F.min("digest").alias("lo"), F.max("digest").alias("hi"))
        .where("n > 1")
        # Copies of one segment are repeated as a whole.
        .select("anchor", F.expr("lo = hi").alias("whole"))
    )
    places = stored(spark, found.join(shared, "anchor"), "places")
    one = F.min(F.struct(*_KEYS, "first", "starts", "depth", "cores")).alias("one")
    distinct = stored(
        spark,
        places.where("not whole")
        .groupBy("anchor", "digest")
        .agg(F.sum("times").alias("copies"), one)
        .select("anchor", "digest", "copies", "one.*"),
        "distinct",
    )
    wanted = _with_shared_cores(distinct, length, gram)
    pieces = stored(spark, _cut_out(documents, wanted, length), "pieces", texts.BATCH_ROWS)
    total = pieces.where("not many").agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    verdicts = _sorted_verdicts(pieces.where("not many"), max(1, -(-total // shard_bytes)), length)
    crowd = pieces.where("many")
    if crowd.take(1):
        verdicts = verdicts.unionByName(_crowd_verdicts(spark, crowd, length))
    verdicts = stored(spark, verdicts, "verdicts")
    # A run that follows itself is repeated whatever else there is.
    last = F.col("first") + F.col("times") * F.col("starts") - 1
    whole = places.where("whole or times > 1").select(*_KEYS, F.col("first").alias("a"), last.alias("b"))
    partly = (
        places.where("not whole and times = 1")
        .join(verdicts, ["anchor", "digest"])
        .select(*_KEYS, "first", F.explode("runs").alias("r"))
        .select(*_KEYS, (F.col("first") + F.col("r.a")).alias("a"), (F.col("first") + F.col("r.b")).alias("b"))
    )
    return (
        whole.unionByName(partly)
        .groupBy(*_KEYS)
        .agg(F.collect_list(F.struct("a", (F.col("b") + length).alias("b"))).alias("spans"))
    )


def _merged(spans: pa.Array, row: int) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes, in order."""
    out: list[tuple[int, int]] = []
    for span in sorted((s["a"], s["b"]) for s in spans[row].as_py() or ()):
        if out and span[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], span[1]))
        else:
            out.append(span)
    return out


def _left(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    out, at = [], 0
    for a, b in spans:
        out.append(data[at:a])
        at = b
    return b"".join([*out, data[at:]])


def report(spark: SparkSession, documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` per row of documents.

    Null and short texts lose nothing; a null text has 0 bytes. Equal rows are two
    places. Ids may be null or repeated; other columns are not read; no rows give no rows.
    """
    docs = keyed(documents.select("doc_id", "text"))
    kind = dict(documents.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = texts.flat(batch.column("text"))
            raw, ends, rows = data.tobytes(), at.tolist(), []
            spans = batch.column("spans")
            for i in range(batch.num_rows):
                text, cut = raw[ends[i] : ends[i + 1]], _merged(spans, i)
                rows.append((sum(b - a for a, b in cut), len(cut), hashlib.sha256(_left(text, cut)).hexdigest()))
            removed, count, digest = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(at)),
                    pa.array(removed, pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.array(digest, pa.string()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    spans = stored(spark, repeated_spans(spark, docs, length), "spans")
    return docs.join(spans, list(_KEYS), "left").select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )


def without_repeats(spark: SparkSession, documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """Documents with repeated strings taken out of ``text``; a character cut by a span's end stays whole.

    All rows and columns are kept; ``n_chars``, if there, is counted anew for changed texts.
    """
    plain = keyed(documents.select("doc_id", "text"))
    spans = stored(spark, repeated_spans(spark, plain, length), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, count = (batch.schema.get_field_index(f"own_{c}") for c in ("text", "n_chars"))
            texts_out = batch.column(place).to_pylist()
            counts = batch.column(count).to_pylist() if count >= 0 else None
            for i in range(batch.num_rows):
                cut = _merged(batch.column("spans"), i)
                if cut:
                    data, whole = texts_out[i].encode(), []
                    for a, b in cut:
                        while a < b and data[a] & 0xC0 == 0x80:
                            a += 1
                        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
                            b -= 1
                        whole.append((a, b))
                    texts_out[i] = _left(data, whole).decode()
                    if counts:
                        counts[i] = len(texts_out[i])
            batch = batch.set_column(place, batch.schema.field(place), pa.array(texts_out, batch.column(place).type))
            if counts:
                batch = batch.set_column(count, batch.schema.field(count), pa.array(counts, batch.column(count).type))
            yield batch.drop_columns(["spans"])

    text = F.coalesce("own_text", F.lit(""))
    docs = prefixed(documents).withColumn("_key", F.xxhash64("own_doc_id", text)).withColumn("_key2", F.hash(text))
    joined = docs.join(spans, list(_KEYS), "left").drop(*_KEYS)
    return unprefixed(joined.mapInArrow(run, joined.drop("spans").schema), documents.columns)

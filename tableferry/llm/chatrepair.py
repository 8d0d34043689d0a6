"""Repair of conversations: the cheapest edits that make roles alternate, as an audit and a repaired text.

Rows of a conversation are numbered in order by a range sort, so that a conversation of any
length is spread over tasks, and cut into chunks of bounded length. Costs run backwards over
four states. Every chunk starts from a guessed cost vector at its end; fix-up passes run
those again whose guess differs from what the next chunk found by more than a constant. Once
none does, the constants are added up along the conversation, which gives the true costs;
the least audit is then traced forwards through all chunks at once, from every state a chunk
may begin in, and the traces are stitched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tableferry.llm.components import stored

#: A chunk has at most 2 to this power rows.
CHUNK_BITS = 12
#: Passes that run chunks again; what is then still open is run from each state alone, which serves any vector.
PASSES = 4

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing kept yet, after a leading system row, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the row that must come next.
_NEXT = (USER, USER, ASSISTANT, USER)
_FINAL = (START, ASSISTANT)
#: Row codes: the role's initial, plus ``_CUT`` if truncated; ``_GONE`` must be deleted.
_INITIALS = "sua"
_OTHER, _CUT, _GONE = 3, 4, 8
_ROLES = {USER: "user", ASSISTANT: "assistant"}

_BLANK = r"[^\x20\x09-\x0D]"
_LAST = r"[.!?][\x20\x09-\x0D]*\z"

Vector = tuple[int, int, int, int]


def _with_inserts(costs: Vector) -> Vector:
    """Costs from each state when rows may first be inserted."""
    to_user, to_assistant = costs[USER], costs[ASSISTANT]
    user, assistant = min(to_user, to_assistant + INSERT), min(to_assistant, to_user + INSERT)
    return (min(costs[START], user + INSERT), min(costs[SYSTEM], user + INSERT), user, assistant)


#: Costs behind the last row.
_INFINITE = 1 << 40
END: Vector = _with_inserts(tuple(0 if q in _FINAL else _INFINITE for q in range(4)))


def _kept(state: int, code: int) -> int | None:
    """The state after keeping a row, None if it may not stand here."""
    initial = code & 3
    if code == _GONE or initial == _OTHER:
        return None
    if initial == 0:
        return SYSTEM if state == START else None
    after = USER if initial == 1 else ASSISTANT
    return after if _NEXT[state] == after else None


@lru_cache(maxsize=1 << 16)
def _step(vector: Vector, code: int) -> tuple[int, Vector]:
    """Costs before a row from those behind it, the least taken out."""
    extra = TRUNCATED if code & _CUT else 0
    costs = []
    for state in range(4):
        cost = DELETE + vector[state]
        if code != _GONE:
            cost = min(cost, REROLE + extra + vector[_NEXT[state]])
            if (after := _kept(state, code)) is not None:
                cost = min(cost, KEEP + extra + vector[after])
        costs.append(cost)
    return reduced(_with_inserts(tuple(costs)))


def reduced(vector: Vector) -> tuple[int, Vector]:
    """The least cost, and the vector without it: vectors that differ by a constant have the same."""
    least = min(vector)
    return least, tuple(c - least for c in vector)


def backward(codes: bytes, end: Vector) -> tuple[int, Vector]:
    """Costs before a chunk's first row, as a constant and a reduced vector, from those behind its last."""
    total, vector = reduced(end)
    for code in reversed(codes):
        least, vector = _step(vector, code)
        total += least
    return total, vector


@lru_cache(maxsize=1 << 16)
def _choice(before: Vector, shift: int, behind: Vector, code: int, state: int) -> tuple[str, int]:
    """The edits up to and with a row, the first in ASCII among the cheapest, and the state after it.

    ``before`` and ``behind`` are the reduced costs on both sides, ``shift`` the constant between them.
    """
    edits, extra = "", TRUNCATED if code & _CUT else 0
    while True:
        cost = before[state] + shift
        if cost == DELETE + behind[state]:
            return edits + "D", state
        if cost == INSERT + before[_NEXT[state]] + shift:
            edits, state = edits + "I", _NEXT[state]
            continue
        after = _kept(state, code)
        if after is not None and cost == KEEP + extra + behind[after]:
            return edits + "K", after
        return edits + "R", _NEXT[state]


def forward(codes: bytes, end: Vector, states: tuple[int, ...], last: bool) -> list[tuple[list[str], int]]:
    """For each state before a chunk: the edits of its rows, and the state behind it.

    ``end`` holds the true costs behind the chunk up to a constant. After the ``last`` chunk rows may be inserted.
    """
    vectors, shifts = [reduced(end)[1]], []
    for code in reversed(codes):
        least, vector = _step(vectors[-1], code)
        vectors.append(vector)
        shifts.append(least)
    out = []
    for state in states:
        edits = []
        for i, code in enumerate(codes):
            at = len(codes) - i
            said, state = _choice(vectors[at], shifts[at - 1], vectors[at - 1], code, state)
            edits.append(said)
        tail = ""
        while last and state not in _FINAL:
            tail, state = tail + "I", _NEXT[state]
        out.append(([*edits, tail] if tail else edits, state))
    return out


def repaired_rows(codes: bytes, edits: list[str], state: int) -> list[list[tuple[str, bool]]]:
    """For each row (and the end) the roles written: ``(role, True)`` with the row's text, ``(role, False)`` without.

    An empty role stands for the row's own.
    """
    out = []
    for i, said in enumerate(edits):
        rows = []
        for edit in said:
            if edit == "D":
                continue
            if edit == "K":
                state = _kept(state, codes[i])
                rows.append(("", True))
            else:
                state = _NEXT[state]
                rows.append((_ROLES[state], edit == "R"))
        out.append(rows)
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, n)`` as faults leave them; null texts and roles are a space. ``n`` rows are equal.

    The fault is the checksum of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes
    the ends of sentences out, 3 repeats it, 4 makes it a user's.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *named).cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    text = F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    n = F.when(fault == 3, 2).otherwise(1)
    rows = conversations.where(fault != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), n.alias("n"))
    # Equal rows are added up in each task before they move, however many there are.
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").cast("bigint").alias("n"))


def ordered(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """``rows`` with their ``place`` over all conversations, stored: by turn, nulls first, then role and text.

    ``chunk`` numbers the runs of bounded length that places are cut into. The sort deals out by all of
    a row, so that a conversation may lie in many tasks; no two rows are equal.
    """
    keys = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text"]
    # The number of a row within its task lies in the lower bits, that of the task above.
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    return stored(spark, placed.withColumn("chunk", F.shiftright("place", CHUNK_BITS)), "ordered")


def _codes(rows: DataFrame) -> DataFrame:
    """Ordered rows without their texts: blank, duplicate or truncated, and as a code for the costs."""
    initial = F.lit(_OTHER)
    for number, letter in enumerate(_INITIALS):
        initial = F.when(F.substring("role", 1, 1) == letter, number).otherwise(initial)
    slim = rows.select(
        "conv_id", "turn", "place", "chunk", "n", "role", F.sha2("text", 256).alias("digest"),
        initial.alias("initial"), (~F.col("text").rlike(_BLANK)).alias("blank"), (~F.col("text").rlike(_LAST)).alias("unended"),
    )
    said = ["conv_id", "role", "digest"]
    # Only what is said at several turns is looked up again.
    again = (
        slim.where("not blank").groupBy(*said).agg(F.min("place").alias("first"), F.count("*").alias("turns"))
        .where("turns > 1").select(*[F.col(c).alias(f"said_{c}") for c in said], "first")
    )
    same = (
        F.col("conv_id").eqNullSafe(F.col("said_conv_id"))
        & (F.col("role") == F.col("said_role")) & (F.col("digest") == F.col("said_digest"))
    )
    duplicate = ~F.col("blank") & F.coalesce(F.col("place") > F.col("first"), F.lit(False))
    truncated = ~F.col("blank") & ~F.col("duplicate") & F.col("unended")
    code = (
        F.when(F.col("blank") | F.col("duplicate"), _GONE)
        .otherwise(F.col("initial") + F.when(F.col("truncated"), _CUT).otherwise(0)).cast("int")
    )
    return (
        slim.join(again, same, "left").withColumn("duplicate", duplicate).withColumn("truncated", truncated)
        .select("conv_id", "turn", "place", "chunk", "n", "initial", "blank", "duplicate", "truncated", code.alias("code"))
    )


def _counts(codes: DataFrame) -> DataFrame:
    """Gaps and faults of each conversation; a null conv_id is a conversation too."""
    one = {c: F.col(c).cast("bigint") for c in ("blank", "duplicate", "truncated")}
    # Later copies of a row are duplicates, or blank like the first.
    again = F.when(F.col("blank"), 0).otherwise(F.col("n") - 1)
    by_turn = codes.groupBy("conv_id", "turn").agg(
        F.sum(one["blank"] * F.col("n")).alias("blank"),
        F.sum(one["duplicate"] + again).alias("duplicate"),
        F.sum(one["truncated"]).alias("truncated"),
    )
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
    return by_turn.groupBy("conv_id").agg(
        gaps.cast("bigint").alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    )


def _unlawful(a: Column, b: Column) -> Column:
    """1 if two initials, one after the other, are none of su, ua, au."""
    lawful = ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))
    return F.when(lawful, 0).otherwise(1).cast("bigint")


def _chunks(codes: DataFrame) -> DataFrame:
    """A row for each chunk, known by its first place: codes and numbers of equal rows in order, and their initials' faults."""
    listed = F.sort_array(F.collect_list(F.struct("place", "code", "initial", "n")))
    each = codes.groupBy("conv_id", "chunk").agg(listed.alias("rows"))
    pairs = F.zip_with(
        F.slice("rows", F.lit(1), F.size("rows") - 1), F.slice("rows", F.lit(2), F.size("rows")),
        lambda a, b: _unlawful(a["initial"], b["initial"]),
    )
    # Copies that follow their row have its role, which is never lawful.
    copies = F.aggregate("rows", F.lit(0).cast("bigint"), lambda acc, r: acc + r["n"] - 1)
    return each.select(
        "conv_id", F.col("rows.place")[0].alias("place"), F.col("rows.code").alias("codes"), F.col("rows.n").alias("ns"),
        copies.alias("copies"), (F.aggregate(pairs, F.lit(0).cast("bigint"), lambda acc, p: acc + p) + copies).alias("illegal"),
        F.col("rows.initial")[0].alias("first"), F.element_at("rows.initial", -1).alias("final"),
    )


RAN = "place bigint, `end` array<bigint>, total bigint, start array<bigint>"


def _ran(chunks: DataFrame) -> DataFrame:
    """Chunks run backwards from the vector ``end`` behind them: the constant and the vector before them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.to_pydict()
            rows = [(p, e, *backward(bytes(c), tuple(e))) for p, c, e in zip(given["place"], given["codes"], given["end"])]
            yield pa.RecordBatch.from_pylist([dict(zip(("place", "end", "total", "start"), r)) for r in rows], schema)

    vector = pa.list_(pa.int64())
    schema = pa.schema([("place", pa.int64()), ("end", vector), ("total", pa.int64()), ("start", vector)])
    return chunks.select("place", "codes", "end").mapInArrow(run, RAN)


def _in_order(frame: DataFrame, step, schema: str, *order: Column) -> DataFrame:
    """Rows of each conversation in order through ``step(state, row)``, which gives a new state and a row to keep.

    Rows stream; of a conversation only its state is held.
    """
    fields = frame.sparkSession.createDataFrame([], schema).schema.fieldNames()
    kinds = pa.schema([(n, pa.list_(pa.int64()) if n == "end" else pa.int64()) for n in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = (), None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if (row["conv_id"],) != now:
                    now, state = (row["conv_id"],), None
                state, kept = step(state, row)
                out.append(kept)
            yield pa.RecordBatch.from_pylist(out, kinds)

    return frame.repartition("conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(run, schema)


def _transfers(chunks: DataFrame) -> DataFrame:
    """Chunks with ``costs``: from each state before them to each state behind them, one row of four after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for codes in batch.column("codes").to_pylist():
                ends = [tuple(0 if q == state else _INFINITE for q in range(4)) for state in range(4)]
                found = [backward(bytes(codes), end) for end in ends]
                out.append([total + vector[q] for q in range(4) for total, vector in found])
            kept = [batch.column("conv_id"), batch.column("place"), pa.array(out, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(kept, ["conv_id", "place", "costs"])

    kind = dict(chunks.dtypes)["conv_id"]
    return chunks.select("conv_id", "place", "codes").mapInArrow(run, f"conv_id {kind}, place bigint, costs array<bigint>")


def _behind(state: Vector | None, row: dict) -> tuple[Vector, dict]:
    """Takes chunks from the last to the first: the reduced true vector behind each."""
    end = END if state is None else state
    before = tuple(min(row["costs"][4 * q + r] + end[r] for r in range(4)) for q in range(4))
    return reduced(before)[1], {"place": row["place"], "end": end}


def _through(state: int | None, row: dict) -> tuple[int, dict]:
    """Takes chunks from the first to the last: the state before each."""
    before = START if state is None else state
    return row["states"][before], {"place": row["place"], "state": before}


def _solved(spark: SparkSession, chunks: DataFrame, heads: DataFrame, passes: int) -> DataFrame:
    """``RAN`` of all chunks with true vectors behind them, up to constants."""
    guess = F.array(*[F.lit(c).cast("bigint") for c in END])
    ran = stored(spark, _ran(chunks.withColumn("end", guess)), "ran")
    links = stored(spark, heads.where("next is not null").select("conv_id", "place", "next"), "links")

    def open_() -> DataFrame:
        """Chunks whose vector is not the one that the next chunk found."""
        found = ran.select(F.col("place").alias("next"), F.col("start").alias("true_end"))
        return links.join(found, "next").join(ran, "place").where("`end` <> true_end").select("conv_id", "place", "true_end")

    def run_again(ends: DataFrame) -> DataFrame:
        again = _ran(chunks.join(ends.select("place", F.col("true_end").alias("end")), "place"))
        return stored(spark, ran.join(ends, "place", "left_anti").select(*ran.columns).unionByName(again), "ran")

    for _ in range(passes):
        ends = stored(spark, open_(), "open")
        if not ends.take(1):
            return ran
        ran = run_again(ends)
    still = stored(spark, open_().select("conv_id").distinct(), "still")
    if still.take(1):
        same = F.col("conv_id").eqNullSafe(F.col("still_id"))
        stubborn = chunks.join(still.select(F.col("conv_id").alias("still_id")), same, "left_semi")
        ends = _in_order(_transfers(stubborn), _behind, "place bigint, `end` array<bigint>", F.desc("place"))
        ran = run_again(stored(spark, ends.withColumnRenamed("end", "true_end"), "ends"))
    return ran


def _states(spark: SparkSession, chunks: DataFrame, heads: DataFrame) -> DataFrame:
    """``(place, state)``: the state before every chunk of conversations of several chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.to_pydict()
            states = [
                [state for _, state in forward(bytes(c), tuple(e), (0, 1, 2, 3), last=False)]
                for c, e in zip(given["codes"], given["end"])
            ]
            kept = [batch.column("conv_id"), batch.column("place"), pa.array(states, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(kept, ["conv_id", "place", "states"])

    kind = dict(chunks.dtypes)["conv_id"]
    several = chunks.join(heads.where("next is not null or before is not null").select("place"), "place", "left_semi")
    traced = several.select("conv_id", "place", "codes", "end").mapInArrow(run, f"conv_id {kind}, place bigint, states array<bigint>")
    return stored(spark, _in_order(traced, _through, "place bigint, state bigint", F.col("place")), "states")


def _edited(chunks: DataFrame) -> DataFrame:
    """Chunks with their ``edits``: those of each row, and behind the last row of a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given, edits = batch.to_pydict(), []
            for codes, end, state, last in zip(given["codes"], given["end"], given["state"], given["last"]):
                ((said, _),) = forward(bytes(codes), tuple(end), (state,), last)
                edits.append(said)
            kept = batch.drop_columns(["end", "last"])
            yield kept.append_column("edits", pa.array(edits, pa.list_(pa.string())))

    given = chunks.select("conv_id", "place", "codes", "ns", "end", "state", "last")
    kept = ", ".join(f"{n} {kind}" for n, kind in given.drop("end", "last").dtypes)
    return given.mapInArrow(run, f"{kept}, edits array<string>")


class _Repaired:
    """One conversation as it streams by: its audit, and the checksum of its repaired text."""

    def __init__(self):
        self.audit, self.hash, self.empty, self.rows = [], hashlib.sha256(), True, iter(())

    def begin(self, row: dict) -> None:
        codes, edits = bytes(row["codes"]), row["edits"]
        roles = repaired_rows(codes, edits, row["state"])
        self.rows = iter(zip(edits, roles, [*row["ns"], 1]))
        if len(edits) > len(codes):
            self.tail = edits[-1], roles[-1]
        else:
            self.tail = "", []

    def add(self, row: dict) -> None:
        said, roles, n = next(self.rows)
        self.audit.append(said + "D" * (n - 1))
        self.write(roles, row["role"], row["text"])

    def write(self, roles: list[tuple[str, bool]], own: str, text: str) -> None:
        for role, with_text in roles:
            self.hash.update(f"{'' if self.empty else chr(10)}{role or own}:{text if with_text else ''}".encode())
            self.empty = False

    def end(self) -> tuple[str, str]:
        self.audit.append(self.tail[0])
        self.write(self.tail[1], "", "")
        return "".join(self.audit), self.hash.hexdigest()


def _texts(rows: DataFrame, edited: DataFrame) -> DataFrame:
    """``(conv_id, audit, repaired_sha256)``: rows stream by in order, each chunk's edits before its rows.

    A checksum is one run over the text, so a conversation goes through one task, a batch at a time.
    """
    kind = dict(rows.dtypes)["conv_id"]
    both = rows.select("conv_id", "place", F.lit(1).alias("kind"), "role", "text").unionByName(
        edited.withColumn("kind", F.lit(0)), allowMissingColumns=True
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own = (), None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if (row["conv_id"],) != now:
                    if own:
                        done.append((*now, *own.end()))
                    now, own = (row["conv_id"],), _Repaired()
                own.begin(row) if row["kind"] == 0 else own.add(row)
            if done:
                yield batch_of(done, batch.schema.field("conv_id").type)
        if own:
            yield batch_of([(*now, *own.end())], batch.schema.field("conv_id").type)

    def batch_of(done: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*done), (id_type, pa.string(), pa.string()))]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "audit", "repaired_sha256"])

    sorted_ = both.repartition("conv_id").sortWithinPartitions("conv_id", "place", "kind")
    return sorted_.mapInArrow(run, f"conv_id {kind}, audit string, repaired_sha256 string")


SUMS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repair(spark: SparkSession, conversations: DataFrame, passes: int = PASSES) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` per conversation.

    Rows are damaged first (:func:`damaged`), then judged and repaired in the order of turn (nulls first), role and
    text. A null text or role is one space; a role that begins with none of s, u, a, or is empty, may not be kept.
    Rows without a conv_id are one conversation, with a null conv_id. Repeated rows are duplicates of the first. A
    conversation that lost all rows has zeros, an empty audit and the checksum of nothing. Other columns are not
    read; no rows give no rows.
    """
    own = conversations.select("conv_id", "turn", "role", "text")
    rows = ordered(spark, damaged(own))
    codes = stored(spark, _codes(rows), "codes")
    chunks = stored(spark, _chunks(codes), "chunks")
    by_place = W.partitionBy("conv_id").orderBy("place")
    # Of a long conversation a task sees a row per chunk only.
    heads = stored(
        spark,
        chunks.select("conv_id", "place", "final", "first").select(
            "conv_id", "place", F.lead("place").over(by_place).alias("next"), F.lag("place").over(by_place).alias("before"),
            _unlawful(F.col("final"), F.lead("first").over(by_place)).alias("unlawful"),
        ),
        "heads",
    )
    ran = _solved(spark, chunks, heads, passes)
    solved = stored(spark, chunks.join(ran, "place"), "solved")
    states = _states(spark, solved, heads)
    told = (
        solved.join(heads.select("place", F.col("next").isNull().alias("last"), "unlawful"), "place")
        .join(states, "place", "left")
        .withColumn("state", F.coalesce("state", F.lit(START).cast("bigint")))
    )
    at_start = F.min_by(F.element_at("start", START + 1), "place")
    costs = told.groupBy("conv_id").agg(
        F.sum(F.col("illegal") + F.when(F.col("last"), 0).otherwise(F.col("unlawful"))).alias("illegal"),
        (F.sum(F.col("total") + DELETE * F.col("copies")) + at_start).alias("cost"),
    )
    parts = [_counts(codes), costs, _texts(rows, _edited(told)), own.select("conv_id").distinct()]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part, allowMissingColumns=True)
    nothing = hashlib.sha256().hexdigest()
    return found.groupBy("conv_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in SUMS],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256"),
    )

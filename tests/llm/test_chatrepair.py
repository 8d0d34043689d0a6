"""Conversation repair against exhaustive search, a plain forward search over whole conversations, and one chunk."""

import heapq
import random
import re
import zlib
from hashlib import sha256

import pytest

from tableferry.llm import chatrepair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, place int, n int, code int"
LAWFUL = re.compile(r"(s?(ua)+)?")


def broken(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def cheapest(rows):
    """The least (cost, audit) with its text, by a search over (rows done, initials) in that order."""
    todo, done = [(0, "", 0, "", ())], set()
    while todo:
        cost, audit, at, last, said = heapq.heappop(todo)
        if (at, last) in done:
            continue
        if at == len(rows) and last in ("", "a"):
            return cost, audit, "\n".join(said)
        done.add((at, last))
        after = "a" if last == "u" else "u"
        name = {"u": "user", "a": "assistant"}[after]
        heapq.heappush(todo, (cost + 5, audit + "I", at, after, (*said, f"{name}:")))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(todo, (cost + 2, audit + "D", at + 1, last, said))
            if fault in ("", "truncated"):
                extra = 5 if fault else 0
                heapq.heappush(todo, (cost + 1 + extra, audit + "R", at + 1, after, (*said, f"{name}:{text}")))
                if role[:1] == after or role[:1] == "s" and last == "":
                    heapq.heappush(todo, (cost + extra, audit + "K", at + 1, role[:1], (*said, f"{role}:{text}")))
    raise AssertionError


def brute(given):
    out = []
    left = broken(given)
    for conv in {r[0] for r in given}:
        rows = sorted((r for r in left if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns = {r[1] for r in rows} - {None}
        faults, seen = [], set()
        for _, _, role, text in rows:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append((role, text, fault))
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, text = cheapest(faults)
        count = [sum(f == kind for *_, f in faults) for kind in ("blank", "duplicate", "truncated")]
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *count, illegal, cost, audit, sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed, n, length):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why? ", "well", "", " \t", "Hm. so", "One. Two!\n", "é."]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, length)):
            if rng.random() < 0.1:
                continue
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.7 else rng.choice(["system", "user", "assistant", "tool", "", None])
            text = rng.choice(texts) if rng.random() < 0.5 else f"{rng.choice(texts)} {turn}{rng.choice(['.', '', '?'])}"
            rows.append((conv, turn if rng.random() < 0.95 else None, role, text if rng.random() < 0.95 else None))
            if rng.random() < 0.05:
                rows.append(rows[-1])
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).repartition(3)


def test_search_is_exhaustive():
    """The search above, against all edit strings of bounded length."""
    from itertools import product

    rng = random.Random(1)
    for _ in range(25):
        rows = [(rng.choice(["user", "assistant", "system", "x"]), str(i), rng.choice(["", "", "truncated", "blank"])) for i in range(rng.randint(0, 3))]
        best = None
        for size in range(0, len(rows) + 5):
            for edits in product(["D", "K", "Ru", "Ra", "Iu", "Ia"], repeat=size):
                cost, roles, at = 0, "", 0
                for e in edits:
                    if e[0] == "I":
                        cost, roles = cost + 5, roles + e[1]
                        continue
                    if at == len(rows) or e[0] in "KR" and rows[at][2] == "blank":
                        break
                    cost += 2 if e == "D" else (0 if e == "K" else 1) + 5 * (rows[at][2] == "truncated")
                    roles += "" if e == "D" else rows[at][0][0] if e == "K" else e[1]
                    at += 1
                else:
                    if at == len(rows) and LAWFUL.fullmatch(roles):
                        found = cost, "".join(e[0] for e in edits)
                        best = min(best or found, found)
            if len(rows) == 3 and size == 5:
                break
        assert cheapest(rows)[:2] == best


@pytest.mark.parametrize("bits,passes", [(14, 4), (1, 4), (1, 0), (2, 1)])
def test_conversations_against_search(spark, monkeypatch, bits, passes):
    monkeypatch.setattr(chatrepair, "CHUNK_BITS", bits)
    rows = conversations(bits + passes, 60, 14)
    rows += [(None, 1, "user", "Hi."), (None, None, None, None), (900, 5, "user", "a."), (900, 5, "user", "a.")]
    got = sorted((tuple(r) for r in chatrepair.repair(spark, frame(spark, rows), passes).collect()), key=repr)
    assert got == brute(rows)


@pytest.mark.parametrize("seed,text", [(1, "{0}."), (2, "{0}"), (3, "same."), (4, "")])
def test_one_long_conversation_in_many_chunks(spark, monkeypatch, seed, text):
    monkeypatch.setattr(chatrepair, "CHUNK_BITS", 3)
    rng = random.Random(seed)
    rows = [(7, i, rng.choice(["user", "assistant"]), text.format(i)) for i in range(500)] + [(7, 3, "user", "z.")] * 40
    got = sorted(tuple(r) for r in chatrepair.repair(spark, frame(spark, rows), 2).collect())
    assert got == brute(rows)


def test_chunks_stitch_to_whole_conversations():
    rng = random.Random(9)
    for _ in range(300):
        codes = bytes(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 8]) for _ in range(rng.randint(1, 12)))
        cut = rng.randint(0, len(codes))
        total, start = chatrepair.backward(codes, chatrepair.END)
        behind = chatrepair.backward(codes[cut:], chatrepair.END)
        before = chatrepair.backward(codes[:cut], behind[1])
        assert (total, start) == (before[0] + behind[0], before[1])
        ((whole, _),) = chatrepair.forward(codes, chatrepair.END, (0,), True)
        ((left, state),) = chatrepair.forward(codes[:cut], behind[1], (0,), False)
        ((right, _),) = chatrepair.forward(codes[cut:], chatrepair.END, (state,), True)
        assert whole == left + right


def test_odd_tables(spark):
    def run(rows):
        return sorted((tuple(r) for r in chatrepair.repair(spark, frame(spark, rows)).collect()), key=repr)

    assert chatrepair.repair(spark, spark.createDataFrame([], SCHEMA)).collect() == []
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert run([(dropped, 0, "user", "Hi.")]) == [(dropped, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]
    long_text = "word. " * 400_000
    rows = [(1, 1, "user", long_text), (1, 2, "assistant", long_text), (2, None, None, None), (2, None, "", "")]
    assert run(rows) == brute(rows)


def test_query_against_search(spark):
    from tableferry.llm.queries import registry

    folder = "/root/testdata/sf0.001"
    got = [tuple(r) for r in registry()["op12_conversation_repair"](spark, folder).collect()]
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(got, key=repr) == brute(rows)

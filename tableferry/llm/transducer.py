"""A minimal acyclic transducer from words to id sequences, as flat arrays that can be memory-mapped.

Words are added in byte order. States that are done are looked up among those made
before, so equal suffixes share their states; the ids a word stands for are moved
towards the root as far as all words through an arc agree on them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np


class _State:
    __slots__ = ("arcs", "final")

    def __init__(self):
        #: Each arc is [byte, number of the target, ids].
        self.arcs: list[list] = []
        #: Ids at the end of a word; None where none ends.
        self.final: tuple[int, ...] | None = None


def _shared(a: tuple, b: tuple) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def compiled(entries: Iterable[tuple[bytes, Sequence[int]]]) -> bytes:
    """The transducer of ``(word, ids)`` in ascending order of distinct words, as the bytes of a file.

    The file is an array of 64-bit integers: the numbers of arcs, states and pooled ids and the
    root; then for each arc, ordered by state and byte, its state and byte, its target, and where
    its ids are in the pool; for each state where its final ids are, or -1; the pool.
    """
    known: dict[tuple, int] = {}
    done: list[_State] = []

    def settled(state: _State) -> int:
        key = (state.final, tuple(map(tuple, state.arcs)))
        number = known.get(key)
        if number is None:
            number = known[key] = len(done)
            done.append(state)
        return number

    path, before = [_State()], b""

    def settle_from(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            path[-1].arcs[-1][1] = settled(state)

    for word, ids in entries:
        if word <= before and before:
            raise ValueError("words must come in ascending order, each once")
        shared, rest = _shared(before, word), tuple(int(i) for i in ids)
        settle_from(shared)
        for byte in word[shared:]:
            path[-1].arcs.append([byte, -1, ()])
            path.append(_State())
        path[-1].final = ()
        for depth in range(shared):
            arc, state = path[depth].arcs[-1], path[depth + 1]
            n = _shared(arc[2], rest)
            # What only some words through this arc say moves on to the arcs behind it.
            if late := arc[2][n:]:
                for other in state.arcs[: None if depth + 1 < shared else -1]:
                    other[2] = late + other[2]
                if state.final is not None:
                    state.final = late + state.final
                arc[2] = arc[2][:n]
            rest = rest[n:]
        if shared < len(word):
            path[shared].arcs[-1][2] = rest
        else:
            path[-1].final = rest
        before = word
    settle_from(0)
    root = settled(path[0])

    pool: dict[tuple, int] = {}
    ids_out: list[int] = []

    def pooled(ids: tuple) -> tuple[int, int]:
        if ids not in pool:
            pool[ids] = len(ids_out)
            ids_out.extend(ids)
        return pool[ids], len(ids)

    arcs = [(s << 8 | byte, target, *pooled(out)) for s, state in enumerate(done) for byte, target, out in state.arcs]
    finals = [(-1, 0) if state.final is None else pooled(state.final) for state in done]
    columns = np.array(arcs, np.int64).reshape(-1, 4).T, np.array(finals, np.int64).T
    head = np.array([len(arcs), len(done), len(ids_out), root], np.int64)
    return np.concatenate([head, *(c.ravel() for c in columns), np.array(ids_out, np.int64)]).tobytes()


class Transducer:
    """Looks up many words at once, byte by byte, in the memory-mapped file of :func:`compiled`."""

    def __init__(self, path: str):
        data = np.memmap(path, np.int64, "r")
        n_arcs, self.n_states, n_ids, self.root = (int(x) for x in data[:4])
        cuts = np.cumsum([4, n_arcs, n_arcs, n_arcs, n_arcs, self.n_states, self.n_states, n_ids])
        self.key, self.target, self.out, self.n_out, self.final, self.n_final, self.pool = (
            data[a:b] for a, b in zip(cuts[:-1], cuts[1:])
        )

    def find(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words are known, the ids of those in their order, and for each word where its ids start."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        begin, data = np.cumsum(size) - size, np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        state = np.full(len(words), self.root, np.int64)
        said: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        going, step = np.arange(len(words)), 0
        while len(going := going[size[going] > step]) and len(self.key):
            wanted = state[going] << 8 | data[begin[going] + step]
            arc = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
            there = self.key[arc] == wanted
            state[going[~there]] = -1
            going, arc = going[there], arc[there]
            state[going] = self.target[arc]
            loud = self.n_out[arc] > 0
            said.append((going[loud], self.out[arc[loud]], self.n_out[arc[loud]]))
            step += 1
        if len(going):
            state[going] = -1
        found = (state >= 0) & (self.final[np.maximum(state, 0)] >= 0)
        ends = np.flatnonzero(found)
        said.append((ends, self.final[state[ends]], self.n_final[state[ends]]))
        word, place, n = (np.concatenate(parts) for parts in zip(*said))
        order = np.argsort(word, kind="stable")
        order = order[found[word[order]]]
        word, place, n = word[order], place[order], n[order]
        spot = np.arange(n.sum()) + np.repeat(place - (np.cumsum(n) - n), n)
        starts = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bincount(word, n, len(words)).astype(np.int64), out=starts[1:])
        return found, np.asarray(self.pool[spot]), starts

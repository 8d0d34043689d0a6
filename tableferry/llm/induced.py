"""External induced suffix sorting with common prefixes, for one shard in one task.

A suffix is S if it is smaller than the next one, else L; an S suffix after an L
one is S*. The substrings between S* positions are sorted and named, the string of
names is sorted in the same way (recursion), and two passes of a priority queue
induce all L and then all S suffixes. Queue entries are tuples that carry the
symbols before the suffix, so that the text is not looked up at each step, and the
common prefix with the entry before; both survive the recursion. The queue and
the sorters keep a bounded number of records in memory and the rest in files.

Common prefixes are counted up to ``cap`` symbols; suffixes that agree further
may stand in any order.
"""

from __future__ import annotations

import heapq
import os
import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 16
#: Below so many suffixes per name, a string of names that fits in memory is sorted by doubling.
BUCKET = 256
ENTRY = np.dtype([("pos", "<i8"), ("before", "<u8"), ("lcp", "<i4")])


class Workspace:
    """Files of one sort: unlinked while open, so nothing stays when the task ends or dies."""

    def __init__(self, memory: int = 1 << 22):
        #: Records that each structure may keep in memory.
        self.memory = memory

    def file(self):
        handle, path = tempfile.mkstemp(prefix="suffixes-")
        os.unlink(path)
        return os.fdopen(handle, "r+b")

    def array(self, n: int, dtype) -> np.ndarray:
        """An array of zeros, in a file if it is large."""
        if n <= self.memory:
            return np.zeros(n, dtype)
        file = self.file()
        file.truncate(n * np.dtype(dtype).itemsize)
        return np.memmap(file, dtype, "r+", shape=(n,))


class Spool:
    """An append-only sequence of records that can be read in slices."""

    def __init__(self, work: Workspace, dtype=ENTRY):
        self.work, self.dtype, self.parts, self.held, self.stored, self.disk = work, np.dtype(dtype), [], 0, 0, None

    def __len__(self) -> int:
        return self.stored + self.held

    def add(self, records: np.ndarray) -> None:
        self.parts.append(records)
        self.held += len(records)
        if self.held > self.work.memory:
            self.disk = self.disk or self.work.file()
            self.disk.seek(self.stored * self.dtype.itemsize)
            for part in self.parts:
                part.astype(self.dtype, copy=False).tofile(self.disk)
            self.stored, self.parts, self.held = self.stored + self.held, [], 0

    def read(self, start: int, end: int) -> np.ndarray:
        out = []
        if start < self.stored:
            self.disk.flush()
            self.disk.seek(start * self.dtype.itemsize)
            out.append(np.fromfile(self.disk, self.dtype, min(end, self.stored) - start))
        if end > self.stored and self.parts:
            if len(self.parts) > 1:
                self.parts = [np.concatenate(self.parts)]
            out.append(self.parts[0][max(0, start - self.stored) : end - self.stored])
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.zeros(0, self.dtype)


class Sorter:
    """Sorts records by some of their fields: runs in memory, merged from files."""

    def __init__(self, work: Workspace, dtype, keys: tuple[str, ...]):
        self.work, self.dtype, self.keys, self.parts, self.held, self.runs = work, np.dtype(dtype), keys, [], 0, []

    def add(self, records: np.ndarray) -> None:
        self.parts.append(records)
        self.held += len(records)
        if self.held > self.work.memory:
            self._close()

    def _ordered(self, records: np.ndarray) -> np.ndarray:
        columns = [np.ascontiguousarray(records[k]) for k in self.keys]
        columns = [c for c in columns if len(c) and c.min() != c.max()]
        if not columns:
            return records
        # Equal records stay as they came.
        return records[np.argsort(columns[0], kind="stable") if len(columns) == 1 else np.lexsort(columns[::-1])]

    def _close(self) -> None:
        spool = Spool(self.work, self.dtype)
        spool.add(self._ordered(np.concatenate(self.parts)))
        self.runs.append(spool)
        self.parts, self.held = [], 0

    def _until(self, records: np.ndarray, last: np.void) -> int:
        """How many of the ordered records are not after ``last``."""
        low, high = 0, len(records)
        for key in self.keys:
            part = records[key][low:high]
            high = low + int(np.searchsorted(part, last[key], "right"))
            low += int(np.searchsorted(part, last[key], "left"))
            if low == high:
                break
        return high

    def __iter__(self) -> Iterator[np.ndarray]:
        if not self.runs:
            if self.parts:
                yield self._ordered(np.concatenate(self.parts))
            return
        if self.parts:
            self._close()
        step = max(1024, self.work.memory // len(self.runs))
        at, heads = [0] * len(self.runs), [np.zeros(0, self.dtype)] * len(self.runs)
        while True:
            for i, run in enumerate(self.runs):
                if not len(heads[i]) and at[i] < len(run):
                    heads[i] = run.read(at[i], min(at[i] + step, len(run)))
                    at[i] += len(heads[i])
            live = [i for i in range(len(self.runs)) if len(heads[i])]
            if not live:
                return
            # Nothing still on disk comes before the least of the last records read.
            ends = np.array([heads[i][-1] for i in live], self.dtype)
            bound = self._ordered(ends)[0]
            taken = []
            for i in live:
                n = self._until(heads[i], bound)
                taken.append(heads[i][:n])
                heads[i] = heads[i][n:]
            yield self._ordered(np.concatenate(taken))


class SymbolQueue:
    """A priority queue of entries by first symbol, and by arrival among equal ones.

    Entries arrive in the order of the suffixes that induced them, so arrival order
    is suffix order within a symbol. All but the parts in memory lie in one file.
    """

    def __init__(self, work: Workspace, largest_first: bool):
        self.work, self.sign, self.held = work, -1 if largest_first else 1, 0
        self.parts: dict[int, list] = defaultdict(list)
        self.heap: list[int] = []
        self.disk, self.stored = None, 0

    def push(self, symbols: np.ndarray, entries: np.ndarray) -> None:
        """``symbols`` in ascending order, one for each entry."""
        if not len(symbols):
            return
        cuts = np.flatnonzero(np.diff(symbols)) + 1
        for symbol, part in zip(symbols[np.concatenate([[0], cuts])].tolist(), np.split(entries, cuts)):
            if symbol not in self.parts:
                heapq.heappush(self.heap, self.sign * symbol)
            self.parts[symbol].append(part)
        self.held += len(entries)
        if self.held > self.work.memory:
            self._spill()

    def _spill(self) -> None:
        self.disk = self.disk or self.work.file()
        self.disk.seek(self.stored * ENTRY.itemsize)
        for parts in self.parts.values():
            for i, part in enumerate(parts):
                if isinstance(part, np.ndarray):
                    part.tofile(self.disk)
                    parts[i] = (self.stored, len(part))
                    self.stored += len(part)
        self.held = 0

    def first(self) -> int | None:
        """The symbol that comes first."""
        return self.sign * self.heap[0] if self.heap else None

    def pop(self, symbol: int) -> np.ndarray | None:
        """The next entries of ``symbol``; None when there are no more."""
        parts = self.parts.get(symbol)
        if not parts:
            if self.heap and self.sign * self.heap[0] == symbol:
                heapq.heappop(self.heap)
                del self.parts[symbol]
            return None
        out, n = [], 0
        while parts and n < CHUNK:
            part = parts.pop(0)
            if not isinstance(part, np.ndarray):
                self.disk.flush()
                self.disk.seek(part[0] * ENTRY.itemsize)
                read = min(part[1], CHUNK)
                if part[1] > read:
                    parts.insert(0, (part[0] + read, part[1] - read))
                part = np.fromfile(self.disk, ENTRY, read)
            else:
                self.held -= len(part)
                if len(part) > CHUNK:
                    parts.insert(0, part[CHUNK:])
                    self.held += len(part) - CHUNK
                    part = part[:CHUNK]
            out.append(part)
            n += len(part)
        return np.concatenate(out) if len(out) > 1 else out[0]


class _Text:
    """Symbols of at least 1, with an end smaller than all of them."""

    def __init__(self, symbols: np.ndarray, largest: int):
        self.symbols, self.n = symbols, len(symbols)
        self.bits = min(64, int(largest + 2).bit_length())
        self.each = 64 // self.bits
        self.mask = np.uint64((1 << self.bits) - 1)

    def at(self, pos: np.ndarray) -> np.ndarray:
        """Symbols at positions; 0 outside the text."""
        inside = (pos >= 0) & (pos < self.n)
        return np.where(inside, self.symbols[np.where(inside, pos, 0)], 0).astype(np.uint64)

    def before(self, pos: np.ndarray) -> np.ndarray:
        """The symbols before each position in one word, the nearest lowest, and a mark above the last."""
        word = np.full(len(pos), self.mask << np.uint64(self.bits * (self.each - 1)), np.uint64)
        for k in range(self.each - 1):
            word |= self.at(pos - 1 - k) << np.uint64(self.bits * k)
        return word

    def common(self, x: np.ndarray, y: np.ndarray, have: np.ndarray, cap: int) -> np.ndarray:
        """Length of the common prefix of suffixes that are known to share ``have``."""
        have = np.minimum(have, cap).astype(np.int64)
        open_ = np.flatnonzero(have < cap)
        while len(open_):
            a, b = x[open_] + have[open_], y[open_] + have[open_]
            steps = np.arange(8)
            same = self.at(a[:, None] + steps) == self.at(b[:, None] + steps)
            same &= (a[:, None] + steps < self.n) & (b[:, None] + steps < self.n)
            run = np.where(same.all(1), 8, same.argmin(1))
            have[open_] = np.minimum(have[open_] + run, cap)
            open_ = open_[(run == 8) & (have[open_] < cap)]
        return have


class _Induction:
    """One pass: what was processed so far, as far as later common prefixes need it."""

    def __init__(self, text: _Text, largest: int, cap: int, work: Workspace, to_large: bool):
        self.text, self.cap, self.to_large = text, cap, to_large
        self.queue = SymbolQueue(work, largest_first=not to_large)
        self.seen = 0
        #: For each symbol the number of the entry that pushed to it last.
        self.pushed = work.array(largest + 2, np.int64)
        self.pushed[:] = -1
        #: For each value v, the last processed entry whose common prefix is at most v.
        self.last_within = np.full(cap + 1, -1, np.int64)

    def process(self, symbol: int, entries: np.ndarray, induced: bool) -> None:
        """Push the predecessors of entries that start with ``symbol``, in order."""
        n, lcp = len(entries), entries["lcp"]
        word = entries["before"]
        ahead = word & self.text.mask
        spent = np.flatnonzero(ahead == self.text.mask)
        if len(spent) and self.text.each > 1:
            word = word.copy()
            word[spent] = self.text.before(entries["pos"][spent])
            ahead = word & self.text.mask
        elif len(spent):
            ahead = self.text.at(entries["pos"] - 1)
        if self.to_large:
            goes = ahead >= symbol
        else:
            goes = (ahead <= symbol if induced else ahead < symbol) & (ahead > 0)
        at = np.flatnonzero(goes)
        if len(at):
            to = ahead[at].astype(np.int64)
            order = np.argsort(to.astype(np.uint16) if self.text.bits <= 16 else to, kind="stable")
            at, to = at[order], to[order]
            earlier = np.empty(len(at), bool)
            earlier[0] = True
            np.not_equal(to[1:], to[:-1], out=earlier[1:])
            shared = np.empty(len(at), np.int64)
            inner = np.flatnonzero(~earlier)
            if len(inner):
                shared[inner] = self._least(lcp, at[inner - 1] + 1, at[inner] + 1)
            outer = np.flatnonzero(earlier)
            since = self.pushed[to[outer]]
            least = np.minimum.accumulate(lcp)[at[outer]]
            past = np.searchsorted(self.last_within, since, "right")
            shared[outer] = np.where(since < 0, -1, np.minimum(past, least))
            closing = np.concatenate([outer[1:] - 1, [len(at) - 1]])
            self.pushed[to[outer]] = self.seen + at[closing]
            new = np.empty(len(at), ENTRY)
            new["pos"] = entries["pos"][at] - 1
            new["before"] = word[at] >> np.uint64(self.text.bits % 64) if self.text.each > 1 else self.text.mask
            new["lcp"] = np.minimum(shared + 1, self.cap)
            self.queue.push(to, new)
        last = np.full(self.cap + 1, -1, np.int64)
        last[lcp] = self.seen + np.arange(n)
        np.maximum(self.last_within, np.maximum.accumulate(last), out=self.last_within)
        self.seen += n

    @staticmethod
    def _least(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The least value of each range."""
        length = end - start
        level = np.frexp(length)[1] - 1
        table = [np.ascontiguousarray(values)]
        for k in range(int(level.max())):
            table.append(np.minimum(table[-1][: -(1 << k) or None], table[-1][1 << k :]))
        out = np.empty(len(start), np.int64)
        for k in range(len(table)):
            here = np.flatnonzero(level == k)
            out[here] = np.minimum(table[k][start[here]], table[k][end[here] - (1 << k)])
        return out


def _star_positions(text: _Text, work: Workspace) -> Spool:
    """S* positions in ascending order."""
    found, blocks = Spool(work, "<i8"), []
    #: Type of the first symbol of the block after, and that symbol; the end is smaller than the last one.
    next_small, next_symbol = False, 0
    for start in range((text.n - 1) // CHUNK * CHUNK, -1, -CHUNK):
        part = np.asarray(text.symbols[max(0, start - 1) : start + CHUNK]).astype(np.int64)
        lead = int(start > 0)
        step = np.sign(np.append(part[lead + 1 :], next_symbol) - part[lead:])
        step[-1] = step[-1] or (1 if next_small else -1)
        index = np.where(step != 0, np.arange(len(step)), len(step))
        small = step[np.minimum.accumulate(index[::-1])[::-1]] > 0
        star = np.zeros(len(small), bool)
        star[1:] = small[1:] & (part[lead:-1] > part[lead + 1 :])
        if lead:
            star[0] = small[0] and part[0] > part[1]
        blocks.append(start + np.flatnonzero(star))
        next_small, next_symbol = bool(small[0]), int(part[lead])
    for block in reversed(blocks):
        found.add(block)
    return found


def _named(text: _Text, stars: Spool, work: Workspace) -> tuple[np.ndarray, int]:
    """A name for each S* position: equal for equal substrings up to the next, and ordered like them."""
    n1, inside = len(stars), np.uint64((1 << text.bits) - 1)
    names = work.array(n1, np.int64)
    record = np.dtype([("group", "<i8"), ("word", "<u8"), ("star", "<i8"), ("pos", "<i8"), ("left", "<i8")])

    def words(pos: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The next symbols, the first highest; past the end all ones, as a substring comes after its longer ones."""
        word = np.zeros(len(pos), np.uint64)
        for k in range(text.each):
            symbol = np.where(k < left, text.at(pos + k), inside)
            word |= symbol << np.uint64(text.bits * (text.each - 1 - k))
        return word

    open_ = Sorter(work, record, ("group", "word"))
    for start in range(0, n1, CHUNK):
        pos = stars.read(start, min(start + CHUNK + 1, n1))
        ends = np.append(pos[1:], text.n) if start + CHUNK >= n1 else pos[1:]
        pos = pos[: len(ends)]
        part = np.empty(len(pos), record)
        part["group"], part["star"], part["pos"], part["left"] = 0, start + np.arange(len(pos)), pos, ends - pos + 1
        part["word"] = words(pos, part["left"])
        open_.add(part)
    while open_ is not None:
        # A group's name is the number of S* positions before it: refining keeps the names of others.
        following, previous, base, rank, size_of = None, None, None, 0, None
        pending: list[np.ndarray] = []
        for part in open_:
            if previous is not None:
                part = np.concatenate([previous, part])
            new = np.ones(len(part), bool)
            new[1:] = (part["group"][1:] != part["group"][:-1]) | (part["word"][1:] != part["word"][:-1])
            # The last group may go on in the next part.
            tail = int(np.flatnonzero(new)[-1])
            previous = part[tail:]
            following, base, rank = _name_groups(part[:tail], new[:tail], names, following, base, rank, text, words, work)
        if previous is not None and len(previous):
            new = np.zeros(len(previous), bool)
            new[0] = True
            following, base, rank = _name_groups(previous, new, names, following, base, rank, text, words, work)
        open_ = following
    # Names were numbers of positions; make them consecutive.
    order = Sorter(work, np.dtype([("name", "<i8"), ("star", "<i8")]), ("name",))
    for start in range(0, n1, CHUNK):
        part = np.empty(min(CHUNK, n1 - start), order.dtype)
        part["name"], part["star"] = names[start : start + CHUNK], start + np.arange(len(part))
        order.add(part)
    last, count = -1, 0
    for part in order:
        new = np.diff(part["name"], prepend=last) != 0
        names[part["star"]] = count + np.cumsum(new)
        count += int(new.sum())
        last = int(part["name"][-1])
    return names, count


def _name_groups(part, new, names, following, base, rank, text, words, work):
    """Names for whole groups of sorted records; those that go on are passed to ``following``."""
    if not len(part):
        return following, base, rank
    record = part.dtype
    # The records of one old group stand together: the first gets the group's number, others count on from it.
    at = np.flatnonzero(new)
    index = np.arange(len(part))
    old_new = np.ones(len(part), bool)
    old_new[1:] = part["group"][1:] != part["group"][:-1]
    if base is not None and part["group"][0] == base:
        old_new[0] = False
        before = rank
    else:
        before = 0
    old_start = np.maximum.accumulate(np.where(old_new, index, -1))
    offset = np.where(old_start < 0, before + index, index - old_start)
    group_start = at[np.cumsum(new) - 1]
    name = part["group"] + offset[group_start]
    names[part["star"]] = name
    sizes = np.diff(np.append(at, len(part)))
    goes_on = (part["left"] > text.each) & (np.repeat(sizes, sizes) > 1)
    # A group whose members all end here is one name; they end together, as the padding is part of the word.
    if goes_on.any():
        if following is None:
            following = Sorter(work, record, ("group", "word"))
        more = part[goes_on].copy()
        more["group"] = name[goes_on]
        more["pos"] += text.each
        more["left"] -= text.each
        more["word"] = words(more["pos"], more["left"])
        following.add(more)
    return following, int(part["group"][-1]), int(offset[-1]) + 1


def _doubled(names: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Order and common prefixes of the suffixes of a short string, by doubling of ranks.

    Ranks are numbers of smaller suffixes, so a suffix that stands alone keeps its
    rank and takes no further part.
    """
    n = len(names)
    order = np.argsort(names, kind="stable")
    value = np.asarray(names)[order]
    rank = np.full(n + 1, -1, np.int32 if n < 1 << 31 else np.int64)
    new = np.ones(n, bool)
    new[1:] = value[1:] != value[:-1]
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    ranks, width = [rank], 1
    open_ = order[~(new & np.append(new[1:], True))]
    while width < cap and len(open_):
        # Groups stand together in ``open_``; each is ordered by what follows.
        key = rank[open_].astype(np.int64) * (n + 1) + rank[np.minimum(open_ + width, n)] + 1
        by = np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        new = np.ones(len(open_), bool)
        new[1:] = key[1:] != key[:-1]
        group = rank[open_]
        start = np.flatnonzero(np.diff(group, prepend=-2))
        inside = np.arange(len(open_)) - np.repeat(start, np.diff(np.append(start, len(open_))))
        rank = rank.copy()
        rank[open_] = group + inside[np.flatnonzero(new)[np.cumsum(new) - 1]]
        ranks.append(rank)
        width *= 2
        open_ = open_[~(new & np.append(new[1:], True))]
    order = np.argsort(rank[:n], kind="stable")
    lcp, a, b = np.zeros(n, np.int64), order[:-1], order[1:]
    same = np.zeros(max(0, n - 1), np.int64)
    for k in reversed(range(len(ranks))):
        x, y = np.minimum(a + same, n), np.minimum(b + same, n)
        same += np.where((ranks[k][x] == ranks[k][y]) & (x < n) & (y < n), 1 << k, 0)
    lcp[1:] = np.minimum(same, cap)
    return order, lcp


def sorted_suffixes(symbols: np.ndarray, largest: int, cap: int, work: Workspace) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in ascending order, and the common prefix of each with the one before, up to ``cap``.

    Symbols are whole numbers from 1 to ``largest``.
    """
    text = _Text(symbols, largest)
    n = text.n
    order, lcp = work.array(n, np.int64), work.array(n, np.int32)
    if not n:
        return order, lcp
    stars = _star_positions(text, work)
    n1 = len(stars)
    seeds = iter(())
    if n1:
        names, count = _named(text, stars, work)
        if n1 <= work.memory and n1 < BUCKET * count:
            star_order, star_lcp = _doubled(names, cap)
        else:
            star_order, star_lcp = sorted_suffixes(names, count, cap, work)
        seeds = _seeds(text, stars, star_order, star_lcp, cap, work)
    large = _large_pass(text, largest, cap, seeds, work)
    _small_pass(text, largest, cap, *large, order, lcp, work)
    return order, lcp


def _seeds(text, stars, star_order, star_lcp, cap, work) -> Iterator[tuple[int, np.ndarray]]:
    """S* suffixes in order as entries by first symbol; tuples are made in text order and sorted by rank."""
    n1 = len(stars)
    positions = work.array(n1 + 1, np.int64)
    for start in range(0, n1, CHUNK):
        positions[start : min(start + CHUNK, n1)] = stars.read(start, min(start + CHUNK, n1))
    positions[n1] = text.n
    rank = work.array(n1, np.int64)
    for start in range(0, n1, CHUNK):
        part = star_order[start : start + CHUNK]
        rank[part] = start + np.arange(len(part))
    tuples = Sorter(work, np.dtype([("rank", "<i8"), ("pos", "<i8"), ("before", "<u8"), ("first", "<i8")]), ("rank",))
    for start in range(0, n1, CHUNK):
        pos = np.asarray(positions[start : min(start + CHUNK, n1)])
        part = np.empty(len(pos), tuples.dtype)
        part["rank"], part["pos"], part["before"] = rank[start : start + len(pos)], pos, text.before(pos)
        part["first"] = text.at(pos)
        tuples.add(part)
    last, done = None, 0
    for whole in tuples:
        for at in range(0, len(whole), CHUNK):
            part = whole[at : at + CHUNK]
            index = np.arange(done, done + len(part))
            star = np.asarray(star_order[index])
            left = star if last is None else np.append(last, star[:-1])
            if last is None:
                left = np.append(star[:1], star[:-1])
            shared = np.asarray(star_lcp[index]).astype(np.int64)
            # So many whole names agree; what the next two share is compared in the text.
            have = positions[np.minimum(left + shared, n1)] - positions[left]
            entries = np.empty(len(part), ENTRY)
            entries["pos"], entries["before"] = part["pos"], part["before"]
            entries["lcp"] = text.common(positions[left], part["pos"], have, cap)
            if last is None:
                entries["lcp"][0] = 0
            last, done = star[-1], done + len(part)
            cuts = np.flatnonzero(np.diff(part["first"])) + 1
            for symbol, piece in zip(part["first"][np.concatenate([[0], cuts])].tolist(), np.split(entries, cuts)):
                yield symbol, piece


def _touching(text: _Text, a: int, b: int, cap: int) -> int:
    """Common prefix of two suffixes at the border of a symbol's L and S suffixes."""
    return int(text.common(np.array([a]), np.array([b]), np.zeros(1, np.int64), cap)[0])


def _large_pass(text, largest, cap, seeds, work) -> tuple[Spool, list[tuple[int, int]]]:
    """L suffixes in ascending order, and the number of them for each symbol."""
    run, found, counts = _Induction(text, largest, cap, work, to_large=True), Spool(work), []
    end = np.zeros(1, ENTRY)
    end["pos"], end["before"] = text.n, text.before(np.array([text.n]))
    run.process(0, end, induced=False)
    seed = next(seeds, None)
    while seed is not None or run.queue.heap:
        symbol = min(x for x in (run.queue.first(), seed and seed[0]) if x is not None)
        number, last = 0, None
        while (part := run.queue.pop(symbol)) is not None:
            found.add(part)
            number, last = number + len(part), int(part["pos"][-1])
            run.process(symbol, part, induced=True)
        if number:
            counts.append((symbol, number))
        while seed is not None and seed[0] == symbol:
            part = seed[1]
            if last is not None:
                part = part.copy()
                part["lcp"][0] = _touching(text, last, int(part["pos"][0]), cap)
                last = None
            run.process(symbol, part, induced=False)
            seed = next(seeds, None)
    return found, counts


def _small_pass(text, largest, cap, larges, counts, order, lcp, work) -> None:
    """S suffixes in descending order, among the L ones; fills the results from the end."""
    run, place, counts = _Induction(text, largest, cap, work, to_large=False), text.n, list(counts)
    rest = len(larges)

    def put(part: np.ndarray) -> None:
        nonlocal place
        order[place - len(part) : place] = part["pos"][::-1]
        # What an entry shares with the greater one before it belongs to that one's place.
        high = min(place + 1, text.n)
        shared = part["lcp"][::-1]
        lcp[place - len(part) + 1 : high] = shared if high == place + 1 else shared[:-1]
        place -= len(part)

    while counts or run.queue.heap:
        symbol = max(x for x in (run.queue.first(), counts[-1][0] if counts else None) if x is not None)
        last = None
        while (part := run.queue.pop(symbol)) is not None:
            put(part)
            last = int(part["pos"][-1])
            run.process(symbol, part, induced=True)
        if counts and counts[-1][0] == symbol:
            number = counts.pop()[1]
            low, shared = rest - number, None
            while rest > low:
                size = min(CHUNK, rest - low)
                part = larges.read(rest - size, rest)[::-1].copy()
                own = part["lcp"].copy()
                if shared is None:
                    shared = 0 if last is None else _touching(text, last, int(part["pos"][0]), cap)
                part["lcp"][0], part["lcp"][1:] = shared, own[:-1]
                shared = int(own[-1])
                put(part)
                run.process(symbol, part, induced=False)
                rest -= size
    if text.n:
        lcp[0] = 0

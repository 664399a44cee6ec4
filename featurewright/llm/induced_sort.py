"""External induced sorting of a shard's suffixes, with spilling queues.

The shard is a set of strings over bytes, each ended by a separator that is
smaller than all bytes; suffixes end at their string's separator.

Suffixes are L-type (larger than the next one) or S-type (smaller).  The
leftmost S-type ones are sorted first: the substrings between them get ranks as
names, and the string of names, the recursion's reduced problem, is ranked in
turn.  The sorted ones then induce the L-type suffixes in ascending order, and
those the S-type ones in descending order: whoever is taken from the queue
pushes its left neighbour to the queue of that neighbour's first byte.

A priority queue on (first byte, rank of the next suffix) gets its entries in
order of the second key, so it is one first-in-first-out queue per byte; the
queues live in memory up to a limit and beyond it in unlinked files.  Whole
runs of equal first bytes are taken at once, as arrays.
"""

from __future__ import annotations

import tempfile

import numpy as np

MEMORY = 64 << 20


class Queues:
    """First-in-first-out queues of suffix positions, one per byte value; they spill together."""

    def __init__(self, n: int, memory: int = MEMORY):
        self.blocks: list[list] = [[] for _ in range(n)]
        self.memory, self.held, self.file = memory, 0, None

    def push(self, symbols: np.ndarray, positions: np.ndarray) -> None:
        """Append positions to the queues of their symbols, in the order given."""
        order = np.argsort(symbols, kind="stable")
        symbols, positions = symbols[order], positions[order]
        cuts = np.flatnonzero(np.diff(symbols)) + 1
        for c, part in zip(symbols[np.concatenate([[0], cuts])] if len(symbols) else (), np.split(positions, cuts)):
            self.blocks[c].append(part)
        self.held += positions.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for queue in self.blocks:
            for k, block in enumerate(queue):
                if isinstance(block, np.ndarray):
                    queue[k] = (self.file.tell(), len(block), block.dtype)
                    self.file.write(block.tobytes())
        self.held = 0

    def take(self, c: int) -> list[np.ndarray]:
        """All blocks of a queue, oldest first; the queue is empty then."""
        out, self.blocks[c] = self.blocks[c], []
        for k, block in enumerate(out):
            if isinstance(block, tuple):
                self.file.seek(block[0])
                out[k] = np.frombuffer(self.file.read(block[1] * block[2].itemsize), block[2])
            else:
                self.held -= block.nbytes
        return out


def _types(t: np.ndarray) -> np.ndarray:
    """True for S-type positions."""
    n = len(t)
    up = np.ones(n, np.int8)  # the last separator is S-type
    up[:-1] = np.sign(np.diff(t.astype(np.int32)))
    nxt = np.where(up != 0, np.arange(n), n - 1)
    nxt = np.minimum.accumulate(nxt[::-1])[::-1]
    return up[nxt] > 0


def _sorted_seeds(t: np.ndarray, s_type: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The leftmost S-type positions in the order of their suffixes."""
    code = (t.astype(np.uint16) * 2 + s_type).astype(">u2").tobytes()
    ends = np.append(seeds[1:], seeds[-1])
    ends = np.where(t[seeds] == 0, seeds, ends)  # a separator stands alone
    keys = [code[2 * a:2 * b + 2] for a, b in zip(seeds.tolist(), ends.tolist())]
    name = {k: r for r, k in enumerate(sorted(set(keys)))}
    rank = np.fromiter(map(name.__getitem__, keys), np.int64, len(keys))
    # the reduced strings are short (their strings are): their suffixes are ranked by doubling
    last = t[seeds] == 0
    of = np.cumsum(last) - last  # string number
    m = len(rank)
    order = np.argsort(rank, kind="stable")
    rank[order] = _group_starts(rank[order])
    todo, h = np.arange(m), 1  # those that still share their rank
    longest = int(np.bincount(of).max())
    while h < longest:
        todo = todo[np.bincount(rank, minlength=m)[rank[todo]] > 1]
        if not len(todo):
            break
        ahead = np.minimum(todo + h, m - 1)
        nxt = np.where((todo + h < m) & (of[ahead] == of[todo]), rank[ahead] + 1, 0)
        key = rank[todo] * (m + 1) + nxt
        by = np.argsort(key)
        key, group = key[by], rank[todo[by]]
        rank[todo[by]] = group + _group_starts(key) - _group_starts(group)
        h *= 2
    return seeds[np.argsort(rank, kind="stable")]


def _group_starts(values: np.ndarray) -> np.ndarray:
    """Of sorted values: where each one's run begins."""
    head = np.append(True, values[1:] != values[:-1])
    return np.maximum.accumulate(np.where(head, np.arange(len(values)), 0))


def suffix_array(t: np.ndarray, memory: int = MEMORY) -> np.ndarray:
    """Positions of all non-separator suffixes in order; ``t`` holds byte + 1, and 0 for separators, the last one included."""
    s_type = _types(t)
    lms = s_type.copy()
    lms[1:] &= ~s_type[:-1]
    lms[0] = False
    seeds = _sorted_seeds(t, s_type, np.flatnonzero(lms))
    seed_cuts = np.searchsorted(t[seeds], np.arange(258))
    large, small = Queues(257, memory), Queues(257, memory)
    done_l: list[list] = [[] for _ in range(257)]
    kept = Queues(257, memory)  # the sorted L-type suffixes wait here for the second pass

    def induce(block: np.ndarray, want_s: bool, queues: Queues) -> None:
        prev = block - 1
        prev = prev[prev >= 0]
        sym = t[prev]
        ok = (s_type[prev] == want_s) & (sym > 0)
        queues.push(sym[ok], prev[ok])

    for c in range(257):
        while blocks := large.take(c):
            block = np.concatenate(blocks)
            kept.push(np.full(len(block), c, np.int64), block)
            induce(block, False, large)
        seeded = seeds[seed_cuts[c]:seed_cuts[c + 1]]
        if len(seeded):
            induce(seeded, False, large)
    done_s: list[np.ndarray] = [np.zeros(0, np.int64)] * 257
    for c in range(256, 0, -1):
        parts = []
        while blocks := small.take(c):
            block = np.concatenate(blocks)
            parts.append(block)
            induce(block, True, small)
        done_s[c] = np.concatenate(parts)[::-1] if parts else done_s[c]
        done_l[c] = kept.take(c)
        if done_l[c]:
            induce(np.concatenate(done_l[c])[::-1], True, small)
    return np.concatenate([x for c in range(257) for x in (*done_l[c], done_s[c])])


def equal_prefixes(t: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For neighbours in ``order``: whether position r and r - 1 agree in ``length`` symbols (common prefix >= length)."""
    padded = np.append(t, np.zeros(8, t.dtype)).astype(np.uint64)
    four = np.zeros(len(t) + 4, np.uint64)
    for k in range(4):
        four = (four << np.uint64(16)) | padded[k:len(t) + 4 + k]
    same = np.zeros(len(order), bool)
    live = np.arange(1, len(order))
    for at in [*range(0, length - 3, 4), length - 4]:
        live = live[four[order[live] + at] == four[order[live - 1] + at]]
    same[live] = True
    return same

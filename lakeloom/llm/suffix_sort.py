"""Suffixes sorted by recursive induction with queues that spill to disk, in part.

As in external induced sorting, but with the text, its types and ranks in memory: suffixes are told apart by type (S if smaller
than the next suffix, else L); those of type S behind one of type L (the starred
ones) are sorted by recursion over their names, and all others are induced from
them, first L in ascending, then S in descending order of symbols. The induced
suffixes wait in a queue ordered by symbol; within a symbol the order of arrival
is the order of rank, so a queue is one run of positions for each symbol, and
beyond its memory it goes on in a temporary file of the task, without a name.

One step handles a whole run as an array. Order is needed only up to a number of
symbols (``depth``): where names become too many for runs by symbol, the rest is
sorted by doubling prefixes up to that depth. Common-prefix values of neighbours
in the order come from comparing eight bytes at a time, up to the depth.
"""

from __future__ import annotations

import tempfile

import numpy as np


class SymbolQueue:
    """Positions queued by symbol, first in first out; beyond ``memory`` of them, on disk."""

    def __init__(self, symbols: int, kind: np.dtype, memory: int):
        self.here: list[list[np.ndarray]] = [[] for _ in range(symbols)]
        self.there: dict[int, list[tuple[int, int]]] = {}
        self.kind, self.memory, self.held, self.file = np.dtype(kind), memory, 0, None

    def push(self, positions: np.ndarray, symbols: np.ndarray) -> None:
        """Queues ``positions`` in their order, each under its symbol."""
        if not len(positions):
            return
        if len(positions) == 1:
            self.here[int(symbols[0])].append(positions)
        else:
            order = np.argsort(symbols, kind="stable")
            dealt, sorted_ = positions[order], symbols[order]
            cuts = np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1
            starts = [0, *cuts.tolist()]
            for symbol, lo, hi in zip(sorted_[starts].tolist(), starts, [*starts[1:], len(dealt)], strict=True):
                self.here[symbol].append(dealt[lo:hi])
        self.held += len(positions)
        if self.held > self.memory:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()  # noqa: SIM115  unnamed: gone when the task ends, however it ends
        self.file.seek(0, 2)
        for symbol, runs in enumerate(self.here):
            if runs:
                run = np.concatenate(runs).astype(self.kind)
                self.there.setdefault(symbol, []).append((self.file.tell(), len(run)))
                self.file.write(run.tobytes())
                runs.clear()
        self.held = 0

    def pop(self, symbol: int) -> np.ndarray:
        """All that waits under ``symbol``, in order of arrival."""
        runs = []
        for at, count in self.there.pop(symbol, ()):
            self.file.seek(at)
            runs.append(np.frombuffer(self.file.read(count * self.kind.itemsize), dtype=self.kind))
        here, self.here[symbol] = self.here[symbol], []
        self.held -= sum(map(len, here))
        runs += here
        return runs[0] if len(runs) == 1 else np.concatenate(runs) if runs else np.zeros(0, self.kind)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is of type S; the last symbol is the least and stands nowhere else."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int64) - text[:-1].astype(np.int64))
    at = np.where(step != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(at[::-1])[::-1]  # the next place where neighbours differ
    return np.append(step[np.minimum(following, n - 2)] > 0, True)


def induce(text: np.ndarray, is_s: np.ndarray, starred: np.ndarray, symbols: int, memory: int) -> np.ndarray:
    """All suffixes in the order that the ``starred`` ones, given in theirs, induce."""
    kind = starred.dtype
    bounds = np.searchsorted(text[starred], np.arange(symbols + 1))
    large: list[np.ndarray] = []

    def before(run: np.ndarray, wanted: bool) -> tuple[np.ndarray, np.ndarray]:
        prior = run[run > 0] - kind.type(1)
        prior = prior[is_s[prior] == wanted]
        return prior, text[prior]

    queue = SymbolQueue(symbols, kind, memory)
    for c in range(symbols):
        run, seen = queue.pop(c), []
        while len(run):
            seen.append(run)
            prior, first = before(run, False)
            here = first == c
            queue.push(prior[~here], first[~here])
            run = prior[here]
        large.append(np.concatenate(seen) if seen else np.zeros(0, kind))
        if bounds[c] < bounds[c + 1]:
            queue.push(*before(starred[bounds[c] : bounds[c + 1]], False))
    queue.close()

    out: list[np.ndarray] = []
    queue = SymbolQueue(symbols, kind, memory)
    for c in range(symbols - 1, -1, -1):
        run, seen = queue.pop(c), []
        while len(run):
            seen.append(run)
            prior, first = before(run, True)
            here = first == c
            queue.push(prior[~here], first[~here])
            run = prior[here]
        if len(large[c]):
            queue.push(*before(large[c][::-1], True))
        if seen:
            out.append(np.concatenate(seen))
        out.append(large[c][::-1])
        large[c] = large[c][:0]
    queue.close()
    out.append(np.array([len(text) - 1], dtype=kind))
    return np.concatenate(out)[::-1]  # all of it was gathered from the largest down


def _name(text: np.ndarray, ordered: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers for the starred substrings in ``ordered`` order: equal ones share theirs."""
    if len(ordered) < 2:
        return np.zeros(len(ordered), np.int64)
    a, b = ordered[:-1].astype(np.int64), ordered[1:].astype(np.int64)
    size = ends[1:] - b
    differs = (ends[:-1] - a) != size
    live = np.flatnonzero(~differs)
    step = 0
    while len(live):  # symbol by symbol; these substrings are short
        apart = text[a[live] + step] != text[b[live] + step]
        differs[live[apart]] = True
        live = live[~apart]
        step += 1
        live = live[size[live] >= step]
    return np.concatenate([[0], np.cumsum(differs)])


def by_doubling(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least."""
    n = len(text)
    rank, span = text.astype(np.int64), 1
    order = np.argsort(rank)
    while True:
        further = np.full(n, -1, dtype=np.int64)
        if span < n:
            further[: n - span] = rank[span:]
        if span >= depth:
            return order
        key = rank * (int(further.max(initial=0)) + 2) + further + 1
        order = np.argsort(key)  # equal keys get equal ranks, so their order is free
        new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        span *= 2
        if new[-1] == n - 1:
            return order


def sort_suffixes(text: np.ndarray, symbols: int, depth: int, memory: int = 8_000_000, most_symbols: int = 8192) -> np.ndarray:
    """Positions of all suffixes of ``text`` (numbers below ``symbols``, the last one 0 and unique), ordered by their first ``depth`` symbols at least."""
    n = len(text)
    kind = np.dtype(np.int32 if n < 2**31 - 1 else np.int64)
    if n < 3:
        return np.arange(n, dtype=kind)[::-1]
    is_s = suffix_types(text)
    places = (np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1).astype(kind)
    by_first = places[np.argsort(text[places], kind="stable")]
    is_star = np.zeros(n, dtype=bool)
    is_star[places] = True
    rough = induce(text, is_s, by_first, symbols, memory)
    ordered = rough[is_star[rough]]
    del rough
    index = np.zeros(n, dtype=kind)
    index[places] = np.arange(len(places), dtype=kind)
    following = np.append(places[1:], n - 1).astype(np.int64)
    names_in_order = _name(text, ordered, following[index[ordered]])
    names = np.empty(len(places), dtype=np.int64)
    names[index[ordered]] = names_in_order
    count = int(names_in_order[-1]) + 1
    if count == len(places):
        return induce(text, is_s, ordered, symbols, memory)
    # A starred substring has two symbols at least beyond its overlap's first, so half the depth is enough.
    further = depth // 2 + 2
    kinds = names.astype(np.int32)
    if count <= most_symbols:
        inner = sort_suffixes(kinds, count, further, memory, most_symbols)
    else:
        inner = by_doubling(kinds, further)
    return induce(text, is_s, places[inner], symbols, memory)


def common_prefixes(data: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Lengths of the common prefixes of the byte strings at ``a`` and ``b``, up to ``most``; ``data`` has eight bytes more than any of them."""
    words = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    out = np.full(len(a), most, dtype=np.int64)
    live = np.arange(len(a))
    for step in range(0, most, 8):
        x = words[a[live] + step] ^ words[b[live] + step]
        apart = np.flatnonzero(x)
        low = x[apart] & (~x[apart] + np.uint64(1))
        out[live[apart]] = np.minimum(most, step + (np.bitwise_count(low - np.uint64(1)) >> 3))
        live = live[x == 0]
    return out

"""A generalised suffix automaton over word numbers."""

from __future__ import annotations

from array import array
from bisect import bisect_left

import numpy as np


class Automaton:
    """All runs of words of a set of items; tells for each place of a text which windows end there.

    A window is `span` consecutive words of an item, or the whole of a shorter item. States, links and lengths are
    those of a suffix automaton that is extended item by item from its start state. A state whose lengths include
    `span` knows the items that have its run of `span` words; a state knows the short items that end it.

    It is built with a dictionary for each state, which then become flat arrays: arrows sorted by state and word, and for
    each word of the items at most two states of 8 bytes, three arrows of 12, and 8 for the items.
    """

    def __init__(self, items: dict[object, list[bytes]], span: int) -> None:
        self.span = span
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = array("i", [-1]), array("i", [0])
        coded = {k: [self.number.setdefault(w, len(self.number)) for w in ws] for k, ws in items.items() if ws}
        for ws in coded.values():
            last = 0
            for w in ws:
                last = self._extend(last, w)
        windows: set[tuple[int, int]] = set()  # state and item of windows of full span
        self.short: dict[int, list[tuple[int, object]]] = {}  # by state: length and item
        self.names = list(coded)
        for i, (k, ws) in enumerate(coded.items()):
            at = n = 0
            for w in ws:
                at, n = self.next[at][w], n + 1
                while self.length[self.link[at]] >= span if at else False:
                    at = self.link[at]
                if n >= span:
                    windows.add((at, i))
            if len(ws) < span:
                self.short.setdefault(at, []).append((len(ws), k))
        self.least = min((min(len(ws), span) for ws in coded.values()), default=0)
        pairs = {(a << 32) | b for ws in coded.values() for a, b in zip(ws, ws[1:], strict=False)}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        ordered = sorted(windows)
        self.window_state, self.window_item = array("i", [s for s, _ in ordered]), array("i", [i for _, i in ordered])
        # the nearest state among a state's suffixes, itself first, that a short item ends
        self.above = array("i", bytes(4 * len(self.link)))
        for s in sorted(range(len(self.link)), key=self.length.__getitem__):
            self.above[s] = s if s in self.short else self.above[self.link[s]] if s else -1
        arrows = np.array([(s << 32) | w for s, ws in enumerate(self.next) for w in ws], dtype=np.int64)
        to = np.array([t for ws in self.next for t in ws.values()], dtype=np.int32)
        order = np.argsort(arrows)
        self.arrows, self.to = array("q", arrows[order].tobytes()), array("i", to[order].tobytes())
        del self.next

    def follow(self, at: int, w: int) -> int:
        """The state behind the arrow, or -1."""
        key = (at << 32) | w
        i = bisect_left(self.arrows, key)
        return self.to[i] if i < len(self.arrows) and self.arrows[i] == key else -1

    def _extend(self, last: int, w: int) -> int:
        if (q := self.next[last].get(w)) is not None:
            if self.length[q] == self.length[last] + 1:
                return q
            return self._clone(last, q, w)
        new = self._state({}, 0, self.length[last] + 1)
        at = last
        while at != -1 and w not in self.next[at]:
            self.next[at][w] = new
            at = self.link[at]
        if at != -1:
            q = self.next[at][w]
            self.link[new] = q if self.length[q] == self.length[at] + 1 else self._clone(at, q, w)
        return new

    def _state(self, arrows: dict[int, int], link: int, length: int) -> int:
        self.next.append(arrows)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _clone(self, at: int, q: int, w: int) -> int:
        twin = self._state(dict(self.next[q]), self.link[q], self.length[at] + 1)
        self.link[q] = twin
        while at != -1 and self.next[at].get(w) == q:
            self.next[at][w] = twin
            at = self.link[at]
        return twin

    def stretches(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """Ranges outside of which no window can lie: runs of known words whose neighbours also meet in some item."""
        if not len(codes) or not self.least:
            return []
        if self.least == 1:
            good = codes >= 0
        else:
            pair = (codes[:-1] << 32) | codes[1:]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            good = (self.pairs[at] == pair) & (codes[:-1] >= 0) & (codes[1:] >= 0)
        edge = np.diff(np.concatenate([[0], good.astype(np.int8), [0]]))
        lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + (self.least > 1)
        keep = hi - lo >= self.least
        return list(zip(lo[keep].tolist(), hi[keep].tolist(), strict=True))

    def spans(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged ranges of word places inside windows, and the items of these windows."""
        get = self.number.get
        codes = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        out: list[tuple[int, int]] = []
        found: set = set()
        follow, link, length, span = self.follow, self.link, self.length, self.span
        for lo, hi in self.stretches(codes):
            at = n = 0
            for i, w in enumerate(codes[lo:hi].tolist(), lo):
                while (to := follow(at, w)) < 0 and at:
                    at = link[at]
                    n = length[at]
                if to >= 0:
                    at, n = to, n + 1
                while at and length[link[at]] >= span:
                    at = link[at]
                    n = length[at]
                long = 0
                if n >= span:
                    j = bisect_left(self.window_state, at)
                    while j < len(self.window_state) and self.window_state[j] == at:
                        found.add(self.names[self.window_item[j]])
                        long, j = span, j + 1
                s = self.above[at]
                while s > 0:
                    for m, k in self.short[s]:
                        if m <= n:
                            found.add(k)
                            long = max(long, m)
                    s = self.above[link[s]]
                if long:
                    a = i + 1 - long
                    while out and out[-1][1] >= a:
                        a = min(a, out.pop()[0])
                    out.append((a, i + 1))
        return out, found

"""Generalised suffix automaton over word sequences."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Sequence


class SuffixAutomaton:
    """All word runs of a set of items, with the items that own each window.

    A window is ``width`` consecutive words of an item; an item of fewer words is one window. A state stands for the
    runs that end at the same places; its longest run has ``length`` words, its suffix link leads to the longest run
    that ends at more places.
    """

    def __init__(self, items: Iterable[tuple[Hashable, Sequence[bytes]]], width: int):
        self.width = width
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.owners: dict[int, set] = {}
        self.short: dict[int, dict[int, set]] = {}
        self.least = width
        read = []
        for item, words in items:
            if words:
                coded = [self.ids.setdefault(w, len(self.ids)) for w in words]
                read.append((item, coded))
                self._insert(coded)
        for item, coded in read:
            self._own(item, coded)
        # The nearest state on the way up, itself included, at which a short item ends; and the last one on the way up
        # that still has the width of a window.
        self.above, self.top = [-1] * len(self.link), [0] * len(self.link)
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            up = self.link[s]
            self.above[s] = s if s in self.short else self.above[up]
            self.top[s] = self.top[up] if self.length[up] >= width else s

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The part of q that p reaches by c as a state of its own."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _insert(self, coded: list[int]) -> None:
        last = 0
        for c in coded:
            q = self.next[last].get(c)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
                continue
            new = self._state(self.length[last] + 1, 0, {})
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
            last = new

    def _own(self, item: Hashable, coded: list[int]) -> None:
        n, state = min(len(coded), self.width), 0
        self.least = min(self.least, n)
        for i, c in enumerate(coded, 1):
            state = self.next[state][c]
            while self.length[self.link[state]] >= n and i >= n:
                state = self.link[state]
            if i >= n:
                if n == self.width:
                    self.owners.setdefault(state, set()).add(item)
                else:
                    self.short.setdefault(state, {}).setdefault(n, set()).add(item)

    def scan(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Merged spans of words that lie in an occurrence of a window, and the items these windows are from."""
        spans: list[tuple[int, int]] = []
        found: set = set()
        get, least = self.ids.get, self.least
        coded = list(map(get, words))
        coded.append(None)
        start = -1
        for i, c in enumerate(coded):
            if c is None:
                if start >= 0 and i - start >= least:
                    self._run(coded, start, i, spans, found)
                start = -1
            elif start < 0:
                start = i
        return spans, found

    def _run(self, coded: list, start: int, end: int, spans: list, found: set) -> None:
        """Streams one stretch of known words and tracks the longest match that ends at each of them."""
        moves, link, length, above, width = self.next, self.link, self.length, self.above, self.width
        state = match = 0
        for i in range(start, end):
            c = coded[i]
            while state and c not in moves[state]:
                state = link[state]
                match = length[state]
            if c not in moves[state]:
                continue
            state = moves[state][c]
            match += 1
            hit = 0
            if match >= width:
                found |= self.owners[self.top[state]]
                hit = width
            at = above[state]
            while at > 0:
                for n, items in self.short[at].items():
                    if n <= match:
                        found |= items
                        hit = max(hit, n)
                at = above[link[at]]
            if hit:
                first = i + 1 - hit
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append((first, i + 1))

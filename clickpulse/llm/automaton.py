"""Generalised suffix automaton over word sequences."""

from __future__ import annotations

import numpy as np


class SuffixAutomaton:
    """Suffix automaton of several sequences of words, and what the windows of
    its items need: which items hold the window that ends at a state.

    ``window`` consecutive words of an item are a window; an item of fewer
    words, but not none, is one window."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, words in items:
            last = 0
            for w in words:
                last = self._extend(last, self.vocab.setdefault(w, len(self.vocab)))
        #: state -> items whose window is the word sequence of ``window``
        #: words (long) or of the state's own length (short) that ends there
        self.long: dict[int, set] = {}
        self.short: dict[int, dict[int, set]] = {}
        self.shortest = window
        for name, words in items:
            if 0 < len(words) < window:
                self.shortest = min(self.shortest, len(words))
                state = self._walk(words)
                self.short.setdefault(state, {}).setdefault(len(words), set()).add(name)
            elif words:
                state = matched = 0
                for w in words:
                    state, matched = self.step(state, matched, self.vocab[w])
                    if matched >= window:
                        self.long.setdefault(self.cut(state, window), set()).add(name)
        self._short_above = self._nearest_short()

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, q, c)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
        return cur

    def _clone(self, p: int, q: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = new
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def _walk(self, words: list[bytes]) -> int:
        state = 0
        for w in words:
            state = self.next[state][self.vocab[w]]
        return state

    def _nearest_short(self) -> list[int]:
        """Per state, itself or the nearest state above that ends a short item."""
        out = [-1] * len(self.next)
        for s in np.argsort(self.length, kind="stable").tolist():
            out[s] = s if s in self.short else out[self.link[s]] if s else -1
        return out

    def step(self, state: int, matched: int, c: int) -> tuple[int, int]:
        """The state and length of the longest match after word ``c``."""
        while state and c not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        if c in self.next[state]:
            return self.next[state][c], matched + 1
        return 0, 0

    def cut(self, state: int, n: int) -> int:
        """The state of the last ``n`` words of a match that ends at ``state``."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def scan(self, ids: list[int], at: int, spans: list[tuple[int, int]], found: set) -> None:
        """Walk word ids (all in the vocabulary; the first is word ``at`` of
        the document); add hit spans [from, to) and the items found."""
        state = matched = 0
        window, short, above = self.window, self.short, self._short_above
        nxt, link, length = self.next, self.link, self.length
        for i, c in enumerate(ids, at + 1):
            go = nxt[state].get(c)
            if go is None:
                while state and go is None:
                    state = link[state]
                    go = nxt[state].get(c)
                matched = length[state]
            if go is None:
                state = matched = 0
                continue
            state = go
            matched += 1
            if matched >= window:
                spans.append((i - matched, i))
                found |= self.long[self.cut(state, window)]
            if short:
                s = above[state]
                while s > 0:
                    for n, names in short[s].items():
                        if n <= matched:
                            spans.append((i - n, i))
                            found |= names
                    s = above[link[s]]

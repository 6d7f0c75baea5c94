"""FM-index over a delimited vocabulary, in numpy, and the search of many words in it at once with one error.

The text is ``$w0$w1$...$`` with sorted words; every delimiter is a suffix of its own rank, so the order of the suffixes is
that of the words and a match that reaches the delimiter before a word names it by its rank. A search scheme matches the
end of a word exactly and extends to its front with one error; the scheme that matches the front exactly is the same one
over reversed words. As words are delimited on both sides, no search turns round, and each direction has an index of its own.
"""

from __future__ import annotations

import numpy as np

#: Words searched at once.
BLOCK = 4096


def _joined(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, one after the other, and where each begins (one more entry at the end)."""
    data = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return data, np.cumsum([0, *map(len, words)])


class FmIndex:
    """Backward search by suffix ranks: the rank of ``c`` before suffix i is a place in one sorted array."""

    def __init__(self, words: list[str]):
        """``words`` sorted and distinct."""
        data, begin = _joined(words)
        self.alphabet, codes = np.unique(data, return_inverse=True)
        m = len(words)
        self.n = len(data) + m + 1
        text = np.zeros(self.n, np.int64)
        word_of = np.repeat(np.arange(m), np.diff(begin))
        text[np.arange(len(data)) + word_of + 1] = codes + 1
        order = self._suffixes(text, int(np.diff(begin).max(initial=0)))
        before = text[order - 1]
        self.before = before
        by_char = np.argsort(before, kind="stable")
        self.ranks = before[by_char] * (self.n + 1) + by_char
        self.all = (0, m + 1)

    @staticmethod
    def _suffixes(text: np.ndarray, longest: int) -> np.ndarray:
        """Suffix array by doubling; the last delimiter is the smallest suffix, the others follow by place."""
        n, ends = len(text), np.flatnonzero(text == 0)
        rank = text + len(ends)
        rank[ends] = np.arange(1, len(ends) + 1)
        rank[ends[-1]] = 0
        width = 1
        while True:
            after = np.zeros(n, np.int64)
            after[: n - width] = rank[width:]
            key = rank * (n + int(rank.max()) + 1) + after
            order = np.argsort(key, kind="stable")
            fresh = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
            rank = np.empty(n, np.int64)
            rank[order] = fresh
            if fresh[-1] == n - 1:
                return order
            width *= 2
            assert width <= 2 * longest + 2

    def coded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the words as rows (-1: not in the alphabet, 0 beyond the end), and their lengths."""
        data, begin = _joined(words)
        place = np.searchsorted(self.alphabet, data)
        place[place == len(self.alphabet)] = 0
        codes = np.where(self.alphabet[place] == data, place + 1, -1) if len(self.alphabet) else np.full(len(data), -1)
        lengths = np.diff(begin)
        rows = np.zeros((len(words), int(lengths.max(initial=0))), np.int64)
        owner = np.repeat(np.arange(len(words)), lengths)
        rows[owner, np.arange(len(data)) - begin[owner]] = codes
        return rows, lengths

    def extended(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of suffixes that begin with ``c`` before those of ``[lo, hi)``; empty for a code of -1."""
        base = c * (self.n + 1)
        new = np.searchsorted(self.ranks, base + lo), np.searchsorted(self.ranks, base + hi)
        return new[0], np.where(c < 0, new[0], new[1])

    def _children(self, lo: np.ndarray, hi: np.ndarray):
        """(state, code) of all characters that stand before the suffixes of the intervals."""
        sigma = len(self.alphabet)
        narrow = np.flatnonzero(hi - lo <= sigma)
        width = (hi - lo)[narrow]
        state = np.repeat(narrow, width)
        rows = np.arange(len(state)) - np.repeat(np.cumsum(width) - width, width) + lo[state]
        some = np.unique(state * (sigma + 1) + self.before[rows])
        wide = np.flatnonzero(hi - lo > sigma)
        every = (wide[:, None] * (sigma + 1) + np.arange(1, sigma + 1)).ravel()
        both = np.concatenate((some, every))
        state, code = both // (sigma + 1), both % (sigma + 1)
        return state[code > 0], code[code > 0]

    def near(self, words: list[str], exact: list[int]):
        """Pairs (place in ``words``, number of an indexed word) at one error, where at least the last ``exact`` characters agree."""
        for k in range(0, len(words), BLOCK):
            found = self._near(words[k : k + BLOCK], np.array(exact[k : k + BLOCK], np.int64))
            yield found[0] + k, found[1]

    def _near(self, words: list[str], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        codes, lengths = self.coded(words)
        query = np.arange(len(words))
        lo, hi = np.full(len(words), self.all[0]), np.full(len(words), self.all[1])
        rest = lengths.copy()
        while True:  # the exact half
            own = np.flatnonzero(rest > lengths[query] - exact[query])
            if not len(own):
                break
            rest[own] -= 1
            lo[own], hi[own] = self.extended(codes[query[own], rest[own]], lo[own], hi[own])
            open_rows = lo < hi
            query, lo, hi, rest = query[open_rows], lo[open_rows], hi[open_rows], rest[open_rows]
        ones = []
        while len(query):  # the other half: an error before any character, or none yet
            more = rest > 0
            ones.append((query[more], lo[more], hi[more], rest[more] - 1))
            state, code = self._children(lo, hi)
            new_lo, new_hi = self.extended(code, lo[state], hi[state])
            ones.append((query[state], new_lo, new_hi, rest[state]))
            expected = codes[query[state], np.maximum(rest[state] - 1, 0)]
            other = (rest[state] > 0) & (code != expected)
            ones.append((query[state][other], new_lo[other], new_hi[other], rest[state][other] - 1))
            query, lo, hi, rest = query[more], lo[more], hi[more], rest[more] - 1
            lo, hi = self.extended(codes[query, rest], lo, hi)
            open_rows = lo < hi
            query, lo, hi, rest = query[open_rows], lo[open_rows], hi[open_rows], rest[open_rows]
        if not ones:
            return query, query
        query, lo, hi, rest = (np.concatenate(x) for x in zip(*ones))
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
        while len(query):  # one error made: the front must agree, up to the delimiter
            done = rest == 0
            rest = rest - 1
            c = np.where(done, 0, codes[query, np.maximum(rest, 0)])
            lo, hi = self.extended(c, lo, hi)
            whole = done & (lo < hi)
            found.append((query[whole], lo[whole] - 1))
            open_rows = ~done & (lo < hi)
            query, lo, hi, rest = query[open_rows], lo[open_rows], hi[open_rows], rest[open_rows]
        query, word = (np.concatenate(x) for x in zip(*found))
        both = np.unique(query * (self.n + 1) + word)
        return both // (self.n + 1), both % (self.n + 1)

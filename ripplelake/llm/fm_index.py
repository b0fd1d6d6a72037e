"""A compressed FM-index over words, in numpy.

The Burrows-Wheeler transform of a word sequence is kept in a wavelet matrix
whose codes are Huffman codes, so a level holds only the words that are not
decided yet and the whole takes about the sequence's entropy.  Backward search
takes all queries one word further at a time: an interval's two ends are
ranked level by level, all queries at once.

Suffixes are sorted by their first ``depth`` words, which is exact for
patterns of up to ``depth`` words.  A pattern of just ``depth`` words has an
interval of its own; the index keeps the first text position of each such
interval with two rows or more.
"""

from __future__ import annotations

import numpy as np

from .common import ship

ship(__name__)

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def huffman_lengths(freq: np.ndarray) -> np.ndarray:
    """Code length of every symbol; one symbol alone takes one bit."""
    n = len(freq)
    if n == 1:
        return np.ones(1, dtype=np.int64)
    order = np.argsort(freq, kind="stable")
    weight = freq[order].tolist() + [0] * (n - 1)
    parent = [0] * (2 * n - 1)
    leaf, node = 0, n
    for new in range(n, 2 * n - 1):  # two queues: leaves and made nodes, both ascending
        total = 0
        for _ in range(2):
            if node >= new or (leaf < n and weight[leaf] <= weight[node]):
                pick, leaf = leaf, leaf + 1
            else:
                pick, node = node, node + 1
            total += weight[pick]
            parent[pick] = new
        weight[new] = total
    depth = [0] * (2 * n - 1)
    for i in range(2 * n - 3, -1, -1):
        depth[i] = depth[parent[i]] + 1
    out = np.empty(n, dtype=np.int64)
    out[order] = depth[:n]
    return out


class WaveletMatrix:
    """Rank of symbols in a sequence of 0..n_symbols-1; every symbol occurs."""

    def __init__(self, seq: np.ndarray, n_symbols: int) -> None:
        freq = np.bincount(seq, minlength=n_symbols)
        self.length = huffman_lengths(freq).astype(np.int8)
        order = np.argsort(self.length, kind="stable")
        code = np.zeros(n_symbols, dtype=np.uint64)
        self.first = np.zeros(n_symbols, dtype=np.int64)
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        nodes, done, left = np.zeros(1, dtype=np.uint64), 0, len(seq)
        keep = []
        for d in range(1, int(self.length.max()) + 1):
            # After a stable split by bit, nodes stand in this order; finished symbols take the last places.
            nodes = np.concatenate([nodes, nodes | np.uint64(1 << (d - 1))])
            m = int(np.count_nonzero(self.length == d))
            if m:
                ended = order[done:done + m]
                code[ended], nodes = nodes[-m:], nodes[:-m]
                self.first[ended] = left - np.cumsum(freq[ended][::-1])[::-1]
                left -= int(freq[ended].sum())
                done += m
            keep.append(left)
        for d, left in enumerate(keep):
            bit = (code[seq] >> np.uint64(d)).astype(np.uint8) & 1
            packed = np.zeros((len(bit) // 64 + 1) * 8, dtype=np.uint8)
            packed[:-(-len(bit) // 8)] = np.packbits(bit, bitorder="little")
            words = packed.view(np.uint64)
            ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])[:-1].astype(np.uint32)
            self.levels.append((words, ranks, len(bit) - int(bit.sum())))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])[:left]
        self.code = code

    def rank(self, symbol: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often symbol[i] occurs before each of ends[:, i]."""
        size = self.length[symbol]
        order = np.argsort(-size, kind="stable")
        symbol, at = symbol[order], ends[:, order].astype(np.int64)
        code, active = self.code[symbol], np.searchsorted(-size[order], -np.arange(len(self.levels)), side="left")
        for d, (words, ranks, zeros) in enumerate(self.levels):
            n = active[d]
            if not n:
                break
            now = at[:, :n]
            cell, low = now >> 6, (now & 63).astype(np.uint64)
            ones = ranks[cell] + np.bitwise_count(words[cell] & ~(_ALL << low)).astype(np.int64)
            one = (code[:n] >> np.uint64(d)) & np.uint64(1) == 1
            at[:, :n] = np.where(one, zeros + ones, now - ones)
        out = np.empty_like(at)
        out[:, order] = at - self.first[symbol]
        return out


def _ranked(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key)
    new = np.diff(key[order], prepend=key[order[:1]] - 1) != 0
    rank = np.empty(len(key), dtype=np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank


def sort_by_prefix(text: np.ndarray, depth: int) -> np.ndarray:
    """Rank of every suffix by its first ``depth`` symbols; equal prefixes share a rank.

    Three ranks of k symbols give those of 3 k in one sort.
    """
    rank, k = text.astype(np.int64), 1
    while k < depth:
        width = int(rank.max()) + 2
        parts = 3 if width ** 3 < 1 << 62 else 2
        key = rank.copy()
        for i in range(1, parts):
            step = min(i * k, max(0, depth - k))
            after = np.zeros(len(rank), dtype=np.int64)
            after[:len(rank) - step] = rank[step:] + 1
            key = key * width + after
        rank, k = _ranked(key), min(parts * k, depth)
    return rank


class FMIndex:
    """Index of a list of word sequences (64-bit word hashes), in their order."""

    def __init__(self, sequences: list[np.ndarray], depth: int) -> None:
        self.depth = depth
        size = np.array([len(s) for s in sequences], dtype=np.int64)
        self.starts = np.cumsum(size + 1) - size  # a separator stands before each sequence
        flat = np.concatenate(sequences)
        self.words, ids = np.unique(flat, return_inverse=True)
        text = np.zeros(len(flat) + len(sequences), dtype=np.int64)
        text[np.arange(len(flat)) + np.repeat(np.arange(1, len(sequences) + 1), size)] = ids + 1
        rank = sort_by_prefix(text, depth)
        rows = np.sort(rank * len(rank) + np.arange(len(rank))) % len(rank)
        self.matrix = WaveletMatrix(text[rows - 1], len(self.words) + 1)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(self.words) + 1))])
        start = np.flatnonzero(np.diff(rank[rows], prepend=-1))
        many = np.diff(np.append(start, len(rows))) > 1
        # Rows of one prefix keep the text's order, so the first row is the first place.
        self.shared_row, self.shared_at = start[many].astype(np.uint32), rows[start[many]].astype(np.uint32)

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """Symbols of word hashes; -1 for words that the index lacks."""
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at + 1, -1)

    def matching(self, symbols: np.ndarray, ends: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics: for each end, how many of the up to ``depth``
        symbols before it match backwards with ``least`` occurrences or more,
        and the rows [low, high) of the longest such match.

        ``symbols`` must have ``depth`` symbols or a -1 before each end.
        """
        n = len(ends)
        matched = np.zeros(n, dtype=np.int64)
        low, high = np.zeros(n, dtype=np.int64), np.full(n, self.before[-1], dtype=np.int64)
        alive = np.arange(n)
        for j in range(1, self.depth + 1):
            c = symbols[ends[alive] - j]
            known = c > 0
            alive, c = alive[known], c[known]
            if not len(alive):
                break
            if j == 1:
                found = np.stack([self.before[c], self.before[c + 1]])
            else:
                found = self.before[c] + self.matrix.rank(c, np.stack([low[alive], high[alive]]))
            held = found[1] - found[0] >= least
            alive, found = alive[held], found[:, held]
            low[alive], high[alive] = found
            matched[alive] = j
        return matched, low, high

    def first_place(self, low: np.ndarray) -> np.ndarray:
        """First text position of whole-depth matches whose rows begin at ``low``; -1 if there is one only."""
        if not len(self.shared_row):
            return np.full(len(low), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.shared_row, low), len(self.shared_row) - 1)
        return np.where(self.shared_row[at] == low, self.shared_at[at].astype(np.int64), -1)

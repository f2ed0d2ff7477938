"""Run-length index of a small collection of byte pieces.

The pieces are joined with a separator that no byte equals, their suffixes are
sorted, and the Burrows-Wheeler transform is kept as runs. Only at run ends are
suffix positions sampled, with the length of the match to the suffix before
(at a run's head) and after (at a run's tail).

That is enough to stream matching statistics over the whole collection: if two
suffixes that are neighbours in the order have the same byte before them, those
longer suffixes are neighbours too and match one byte longer. So the match of a
position with its neighbour is that of the last sampled position at or before it
in the text, less the distance. The longer of both neighbours' matches is the
longest match of the position anywhere else in the collection.
"""

from __future__ import annotations

import numpy as np

_FIRST = 7  # symbols of 9 bits that fit in one key


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; symbols are 0..256, the last one a separator."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.zeros(_FIRST, symbols.dtype)]).astype(np.int64)
    key = np.zeros(n, np.int64)
    for i in range(_FIRST):
        key = key << 9 | padded[i:i + n]
    order = np.argsort(key)
    ordered = key[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    # A suffix's rank is the place where its group of equals begins.
    heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = heads
    places = np.flatnonzero(~new | np.append(~new[1:], False))
    width = _FIRST
    while len(places) and width < n:
        # Only groups of more than one are sorted, by what follows their common prefix.
        some = order[places]
        beyond = some + width
        following = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        key = rank[some] * (n + 1) + following
        by_key = np.argsort(key)
        some, key = some[by_key], key[by_key]
        order[places] = some
        new = np.concatenate([[True], key[1:] != key[:-1]])
        rank[some] = np.maximum.accumulate(np.where(new, places, 0))
        places = places[~new | np.append(~new[1:], False)]
        width *= 2
    return order


def match_lengths(symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes a and b.

    A separator ends a match: it is unequal to everything, itself included.
    """
    step = 16
    padded = np.concatenate([symbols, np.zeros(step, symbols.dtype)])
    length = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    window = np.lib.stride_tricks.sliding_window_view(padded, step)
    while len(live):
        one, other = window[a[live] + length[live]], window[b[live] + length[live]]
        equal = np.logical_and.accumulate((one == other) & (one > 0), axis=1).sum(1)
        length[live] += equal
        live = live[equal == step]
    return length


class RunLengthIndex:
    """BWT runs of the pieces and their sampled ends."""

    def __init__(self, pieces: list[bytes]):
        parts = []
        for piece in pieces:
            parts += [np.frombuffer(piece, np.uint8).astype(np.uint16) + 1, np.zeros(1, np.uint16)]
        self.symbols = np.concatenate(parts)
        self.starts = np.cumsum([0, *(len(p) + 1 for p in pieces[:-1])])
        order = suffix_order(self.symbols)
        before = self.symbols[order - 1]
        # A separator before a suffix never equals another one.
        head = np.concatenate([[True], (before[1:] != before[:-1]) | (before[1:] == 0)])
        tail = np.append(head[1:], True)
        heads, tails = np.flatnonzero(head), np.flatnonzero(tail)
        self.run_symbols, self.run_lengths = before[heads], np.diff(np.append(heads, len(order)))
        self.head_positions, self.tail_positions = order[heads], order[tails]
        self.head_matches = match_lengths(self.symbols, order[heads], order[np.maximum(heads - 1, 0)])
        self.tail_matches = match_lengths(self.symbols, order[tails], order[np.minimum(tails + 1, len(order) - 1)])
        self.head_matches[heads == 0] = 0
        self.tail_matches[tails == len(order) - 1] = 0

    def matching_statistics(self) -> np.ndarray:
        """For every position, the longest match with another one."""
        n = len(self.symbols)
        best = np.zeros(n, np.int64)
        for positions, matches in ((self.head_positions, self.head_matches), (self.tail_positions, self.tail_matches)):
            in_text = np.argsort(positions)
            at, reach = positions[in_text], (positions + matches)[in_text]
            # Each sample holds up to the next one; position 0 is one of them.
            best = np.maximum(best, np.repeat(reach, np.diff(np.append(at, n))) - np.arange(at[0], n))
        return best

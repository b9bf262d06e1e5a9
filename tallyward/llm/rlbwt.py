"""A run-compressed Burrows-Wheeler index of short strings, for matches of one length.

Suffixes are sorted by their first ``depth`` symbols and then by the owner (a number) of
their string; equal prefixes form a class. The transform is kept as runs, and a rank counts
symbols in runs. Samples: the smallest owner of each class (it stands first), and the class
of each string's last ``depth`` symbols.

``first_owners`` streams the strings from right to left, from the sampled end on. The
matching statistics of a string in the index against the index only grow, so they are cut at
``depth``: a step drops the last symbol (the class one symbol shorter begins at a stored
border) and takes one more on the left by a rank at that border, which is the beginning of
the next class.
"""

from __future__ import annotations

import numpy as np

_BITS = 9  # a symbol: 0 ends a string, byte b is b + 1
_PACKED = 7


def _ranks(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    sorted_ = keys[order]
    out = np.empty(len(keys), np.int64)
    out[order] = np.cumsum(np.concatenate([[0], sorted_[1:] != sorted_[:-1]]))
    return out


def _prefix_ranks(symbols: np.ndarray, depths: list[int]) -> list[np.ndarray]:
    """Ranks of every suffix by its first symbols (equal prefixes, equal ranks), for each of
    ``depths``: by doubling, the last step of each overlaps."""
    n = len(symbols)
    after = lambda x, step, end: np.concatenate([x[step:], np.full(min(step, n), end)])[:n]
    span = min(_PACKED, *depths)
    keys = np.zeros(n, np.int64)
    for i in range(span):
        keys = (keys << _BITS) | after(symbols, i, 0)
    rank = _ranks(keys)
    while 2 * span < min(depths):
        rank = _ranks(rank * (n + 1) + after(rank, span, -1) + 1)
        span *= 2
    return [rank if d == span else _ranks(rank * (n + 1) + after(rank, d - span, -1) + 1) for d in depths]


class RunIndex:
    def __init__(self, data: np.ndarray, lengths: np.ndarray, owners: np.ndarray, depth: int):
        """``data``: the strings' bytes one after the other."""
        self.depth = depth
        self.lengths = lengths
        ends = np.cumsum(lengths + 1)
        self.begins = ends - lengths - 1
        n = int(ends[-1]) if len(ends) else 0
        symbols = np.zeros(n, np.int64)
        inside = np.ones(n, bool)
        inside[ends - 1] = False
        symbols[inside] = data.astype(np.int64) + 1
        self.symbols = symbols
        if not n:
            return
        shorter, full = _prefix_ranks(symbols, [depth - 1, depth])
        known, number = np.unique(owners, return_inverse=True)
        owner = np.repeat(number, lengths + 1)
        order = np.argsort(full * len(known) + owner)
        new = lambda x: np.concatenate([[True], x[1:] != x[:-1]])
        begins_class, begins_short = new(full[order]), new(shorter[order])
        class_starts = np.flatnonzero(begins_class)
        self.class_of = np.cumsum(begins_class) - 1
        self.class_owners = known[owner[order[class_starts]]]
        # where the class one symbol shorter begins
        self.short_start = np.flatnonzero(begins_short)[np.cumsum(begins_short)[class_starts] - 1]
        # samples: the class of the last ``depth`` symbols of each string
        inverse = np.empty(n, np.int64)
        inverse[order] = np.arange(n)
        self.long = np.flatnonzero(lengths >= depth)
        self.last_class = self.class_of[inverse[self.begins[self.long] + lengths[self.long] - depth]]
        # the transform, as runs by symbol
        transform = symbols[order - 1]  # before the first symbol stands the end of the last string
        begins_run = new(transform)
        self.run_starts = np.flatnonzero(begins_run)
        self.run_of = np.cumsum(begins_run) - 1
        self.run_symbols = transform[self.run_starts]
        sizes = np.diff(np.append(self.run_starts, n))
        by = np.argsort(self.run_symbols, kind="stable")
        self.keys = self.run_symbols[by] * (len(by) + 1) + by  # (symbol, run), ascending
        self.before = np.concatenate([[0], np.cumsum(sizes[by])])

    def _step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Suffixes before the ones that begin with each symbol and go on as the suffix at each
        place: those of smaller symbols, and the symbol's own before that place."""
        run = self.run_of[at]
        j = np.searchsorted(self.keys, symbol * (len(self.run_starts) + 1) + run)
        return self.before[j] + np.where(self.run_symbols[run] == symbol, at - self.run_starts[run], 0)

    def first_owners(self) -> np.ndarray:
        """The smallest owner of the ``depth`` bytes at each place of the strings (the
        strings' bytes one after the other), or -1 where a string has fewer left."""
        out = np.full(len(self.symbols), -1, np.int64)
        if not len(out):
            return out
        left = self.lengths[self.long] - self.depth  # symbols still to take
        place, match = self.begins[self.long] + left, self.last_class
        out[place] = self.class_owners[match]
        while True:
            on = left > 0
            if not on.all():
                left, place, match = left[on], place[on], match[on]
            if not len(left):
                return out[self.symbols > 0]
            left, place = left - 1, place - 1
            match = self.class_of[self._step(self.symbols[place], self.short_start[match])]
            out[place] = self.class_owners[match]

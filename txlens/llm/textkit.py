"""Array helpers over whole batches of texts: UTF-8 bytes, words and rolling hashes."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

#: The separators of words: space and \t to \r.
BREAKS = np.zeros(256, dtype=bool)
BREAKS[[9, 10, 11, 12, 13, 32]] = True
WORD_GAP = "[\\x20\\x09-\\x0D]+"
U64 = np.uint64


def once(value, use):
    """``use(value)`` with the value bound, so that it is worked out once wherever it is used.

    A column that a lambda refers to may be replaced by its whole expression when filters are
    pushed down, and then costs that expression for every element; a bound one does not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def utf8(column):
    """The bytes of a text column and its offsets; nulls count as empty texts."""
    if column.null_count:
        column = column.fill_null("")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0]:offsets[-1]] if held else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def pieces(batches, column="text", max_bytes=1 << 21):
    """Cut Arrow batches so that a piece holds at most ``max_bytes`` of text, or one text."""
    for batch in batches:
        _, offsets = utf8(batch.column(column))
        start, rows = 0, batch.num_rows
        while start < rows:
            end = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
            end = min(max(end, start + 1), rows)
            yield batch.slice(start, end - start)
            start = end


class Words:
    """The words of a batch of texts, in canonical form: one space between two words.

    ``data`` holds the canonical bytes of all texts, ``start``/``end`` the place of each word
    in it, ``of`` the first word of each text (one more entry than texts).
    """

    def __init__(self, column, lower=False):
        raw, offsets = utf8(column)
        inside = ~BREAKS[raw]
        opens = np.zeros(len(raw) + 1, dtype=bool)
        opens[offsets[:-1]] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | opens[1:-1]
        last[:-1] &= ~inside[1:] | opens[1:-1]
        begin, finish = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.of = np.searchsorted(begin, offsets)
        lead = np.ones(len(begin), dtype=np.int64)
        lead[self.of[:-1][self.of[:-1] < self.of[1:]]] = 0
        separators = begin[lead == 1] - 1
        inside[separators] = True
        data = raw.copy()
        data[separators] = 32
        data = data[inside]
        if lower:
            capital = (data >= 65) & (data <= 90)
            data[capital] += 32
        self.data = data
        self.end = np.cumsum(finish - begin + lead)
        self.start = self.end - (finish - begin)

    def text(self, i):
        """Canonical bytes of text ``i``."""
        a, b = self.of[i], self.of[i + 1]
        return self.data[self.start[a]:self.end[b - 1]].tobytes() if b > a else b""

    def runs(self, length):
        """First words of all windows of ``length`` words, and the first window of each text."""
        counts = np.maximum(np.diff(self.of) - length + 1, 0)
        of = np.concatenate([[0], np.cumsum(counts)])
        first = np.arange(of[-1]) + np.repeat(self.of[:-1] - of[:-1], counts)
        return first, of


class Rolling:
    """Rabin-Karp hashes modulo 2**64: the hash of any span from one pass over the bytes."""

    def __init__(self, base):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, U64)

    def _reach(self, size):
        if len(self.powers) < size:
            for name, factor in (("powers", self.base), ("inverses", self.inverse)):
                table = np.full(size, factor, U64)
                table[0] = 1
                setattr(self, name, np.cumprod(table, dtype=U64))

    def spans(self, data, start, end):
        """Mixed hashes of ``data[start:end]`` for arrays of starts and ends."""
        self._reach(len(data) + 1)
        sums = np.empty(len(data) + 1, U64)
        sums[0] = 0
        terms = data.astype(U64)
        terms += U64(1)
        terms *= self.powers[:len(data)]
        np.cumsum(terms, out=sums[1:])
        return mixed((sums[end] - sums[start]) * self.inverses[start])


def mixed(x):
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def sliding_min(values, width):
    """Minimum of every ``width`` neighbours, in a logarithmic number of passes."""
    reach, best = 1, values
    while reach * 2 <= width:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(best[:len(best) - rest], best[rest:]) if rest else best

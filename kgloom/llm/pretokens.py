"""The words that byte-level tokenizers merge within, found for a whole column at once.

The pattern is the public one that tokenizers of this kind share
(public_tokenizers.PATTERN).  Every character belongs to exactly one match, so a
match is known by its first character, and the rule for first characters is
stated here on arrays of character classes.
"""

from __future__ import annotations

import numpy as np
import regex

from .arrays import word_hash

U64 = np.uint64
SPACE, LETTER, NUMBER, OTHER = range(4)
#: The characters with the White_Space property.
WHITE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SLICE = 2 << 20
_classes: list[np.ndarray] = []


def classes() -> np.ndarray:
    if not _classes:
        table = np.full(0x110000, OTHER, np.uint8)
        for kind, name in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
            known = regex.compile(name)
            for a in range(0, 0x110000, 1 << 16):
                chars = "".join(chr(c) for c in range(a, a + (1 << 16)) if not 0xD800 <= c < 0xE000)
                table[[ord(c) for c in known.findall(chars)]] = kind
        table[WHITE] = SPACE
        _classes.append(table)
    return _classes[0]


def match_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte places where a match starts; each runs to the next start or its document's end."""
    if not len(data):
        return np.zeros(0, np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    if len(at) == len(data):
        chars = data
    else:
        chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    kind = classes()[chars]
    n = len(kind)
    edge = np.zeros(n + 1, bool)
    edge[np.searchsorted(at, offsets)] = True
    start = edge[:-1].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # the last white space before anything else stands alone, or leads it if it is a blank
    after = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~edge[1:-1]) + 1
    start[after - 1] = True
    start[after] = chars[after - 1] != 32
    # contractions
    quote = np.flatnonzero((chars == 39) & start)
    if len(quote):
        pad = np.concatenate((chars, np.zeros(3, chars.dtype)))
        gap = np.concatenate((edge, np.ones(3, bool)))
        one, two = pad[quote + 1], pad[quote + 2]
        same1 = ~gap[quote + 1]
        same2 = same1 & ~gap[quote + 2]
        short = same1 & np.isin(one, [ord(c) for c in "stmd"])
        long = same2 & (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l")))
        for which, size in ((short, 2), (long, 3)):
            p = quote[which]
            start[p + 1] = False
            p = p[p + size < n] + size
            start[p] = True
    return at[start]


class Ragged:
    """Rows of different length in one pool."""

    def __init__(self, dtype):
        self.pool = np.zeros(0, dtype)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, pool: np.ndarray, size: np.ndarray) -> None:
        self.start = np.concatenate((self.start, len(self.pool) + np.cumsum(size) - size))
        self.size = np.concatenate((self.size, size))
        self.pool = np.concatenate((self.pool, pool))

    def take(self, rows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows end to end, and how long each group of rows is that starts at `first`."""
        size = self.size[rows]
        end = np.cumsum(size)
        values = self.pool[np.arange(end[-1] if len(end) else 0) + np.repeat(self.start[rows] - (end - size), size)]
        return values, np.diff(np.concatenate(([0], end))[first])


class WordTable:
    """Tokens of the words seen so far, found by the hash of the word's bytes and compared byte by byte.

    `encode` is asked once for the ids of each new word, `decode` (where given)
    for the bytes of those ids.  The table is emptied when it holds over `most` words.
    """

    def __init__(self, encode, decode=None, most: int = 1_000_000):
        self._encode, self._decode, self.most = encode, decode, most
        self.clear()

    def clear(self) -> None:
        self.keys, self.row = np.zeros(0, U64), np.zeros(0, np.int64)
        self.ids, self.bytes, self.words = Ragged(np.uint32), Ragged(np.uint8), Ragged(np.uint8)

    def _add(self, words: list[bytes]) -> np.ndarray:
        """Rows of new words."""
        lists = self._encode(words)
        n = len(self.words.size)
        self.words.add(np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words], np.int64))
        self.ids.add(np.fromiter((i for x in lists for i in x), np.uint32), np.array([len(x) for x in lists], np.int64))
        if self._decode:
            back = self._decode(lists)
            self.bytes.add(np.frombuffer(b"".join(back), np.uint8), np.array([len(x) for x in back], np.int64))
        return np.arange(n, n + len(words))

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        keys, row = np.concatenate((self.keys, keys)), np.concatenate((self.row, self._add(words)))
        order = np.argsort(keys, kind="stable")
        self.keys, self.row = keys[order], row[order]

    def _exact(self, rows: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """rows, but a word whose hash another word has taken gets a row of its own."""
        size = ends - starts
        if np.array_equal(self.words.size[rows], size) and np.array_equal(self.words.take(rows, np.arange(len(rows)))[0], data):
            return rows
        pool, raw, own = self.words.pool.tobytes(), data.tobytes(), {}
        rows = rows.copy()
        for i, (r, a, n) in enumerate(zip(rows.tolist(), starts.tolist(), size.tolist())):
            word, at = raw[a : a + n], int(self.words.start[r])
            if pool[at : at + int(self.words.size[r])] != word:
                own.setdefault(word, []).append(i)
        for row, places in zip(self._add(list(own)), own.values()):
            rows[places] = row
        return rows

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Ids of all documents end to end and their number in each; then decoded bytes likewise."""
        starts = match_starts(data, offsets)
        ends = np.append(starts[1:], len(data))[: len(starts)]
        h, first, back = np.unique(word_hash(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.words.size) > self.most:
            self.clear()
        new = ~np.isin(h, self.keys, assume_unique=True)
        if new.any():
            raw, f = data.tobytes(), first[new]
            self._learn(h[new], [raw[a:b] for a, b in zip(starts[f].tolist(), ends[f].tolist())])
        rows = self._exact(self.row[np.searchsorted(self.keys, h)][back], data, starts, ends)
        first_word = np.searchsorted(starts, offsets)
        return *self.ids.take(rows, first_word), *(self.bytes.take(rows, first_word) if self._decode else (None, None))


def slices(offsets: np.ndarray, most: int = SLICE):
    """Ranges of documents of about `most` bytes in all."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        yield a, b
        a = b

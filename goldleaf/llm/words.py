"""Words, their hashes and windows over whole Arrow batches of texts, with numpy.

A word is a run of bytes other than space and 0x09 to 0x0D. All functions take one `Texts`,
a slice of a batch of a few megabytes (or one longer text), so that the arrays made of it
stay small however large the batch is. A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_R = 0x9E3779B97F4A7C15 | 1
_G = 0xD6E8FEB86659FD93 | 5

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers, modulo 2**64, of an odd base and of its inverse."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(n - 1, 1 << 16).bit_length()
        made = []
        for x in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, x, dtype=np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        have = _powers[base] = tuple(made)
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes one after the other, and where each begins (and the last ends)."""
    if column.null_count:
        column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return held[at[0] : at[-1]], at - at[0]


class Texts:
    """Bytes of some texts, where each begins, and where their words are."""

    def __init__(self, data: np.ndarray, at: np.ndarray) -> None:
        self.data, self.at = data, at
        self.n = len(at) - 1
        solid = ~SPACE[data]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        ends = solid.copy()
        ends[:-1] &= ~solid[1:]
        full = at[1:] > at[:-1]
        first, last = at[:-1][full], at[1:][full] - 1
        begins[first] |= solid[first]
        ends[last] |= solid[last]
        self.solid = solid
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        # Word number at which each text begins, and the text of every word.
        self.word_at = np.searchsorted(self.start, at)
        self.doc = np.repeat(np.arange(self.n), np.diff(self.word_at))

    def counts(self) -> np.ndarray:
        return np.diff(self.word_at)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each text are flagged."""
        upto = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return upto[self.at[1:]] - upto[self.at[:-1]]

    def span_hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of byte spans by content."""
        up, down = powers(_R, len(self.data) + 1)
        prefix = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], out=prefix[1:])
        return mixed((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))

    def word_hashes(self) -> np.ndarray:
        return self.span_hashes(self.start, self.end)

    def windows(self, width: int) -> np.ndarray:
        """Numbers of the words at which a window of so many words of one text begins."""
        if len(self.start) < width:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(self.doc[width - 1 :] == self.doc[: len(self.doc) - width + 1])

    def window_hashes(self, hashes: np.ndarray, begin: np.ndarray, width: int) -> np.ndarray:
        """64-bit hashes of the windows of so many words that begin at these words."""
        up, down = powers(_G, len(hashes) + 1)
        prefix = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * up[: len(hashes)], out=prefix[1:])
        return mixed((prefix[begin + width] - prefix[begin]) * down[begin] + np.uint64(width))

    def covered(self, begin: np.ndarray, width: int) -> np.ndarray:
        """Which words lie in one of the windows that begin at these words."""
        steps = np.zeros(len(self.start) + 1, dtype=np.int64)
        np.add.at(steps, begin, 1)
        np.add.at(steps, begin + width, -1)
        return np.cumsum(steps[:-1]) > 0

    def words(self, i: int) -> list[bytes]:
        return self.data[self.at[i] : self.at[i + 1]].tobytes().split()


def sliced(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The batch in slices of some megabytes of text, at least one row each."""
    data, at = text_bytes(batch.column(batch.schema.get_field_index(column)))
    row = 0
    while row < batch.num_rows:
        upto = int(np.searchsorted(at, at[row] + limit, side="right")) - 1
        upto = min(max(upto, row + 1), batch.num_rows)
        yield batch.slice(row, upto - row), Texts(data[at[row] : at[upto]], at[row : upto + 1] - at[row])
        row = upto


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)

"""Token ids of whole texts with the `tokenizers` library, at the speed of the distinct words.

Texts are cut where both vocabularies' pre-tokenizers cut anyway: at blanks and line feeds, and
between a letter of Latin-1 and an ASCII sign. Equal pieces of a slice are brought together by Arrow's
dictionary encoding, and only pieces that the worker has not met lately are given to the
tokenizer. A word of Latin-1 letters is left whole by the pre-tokenizers and at most lower-cased by the normalizers, so it
goes straight to the tokenizer's model; other pieces go through all steps. A text with any other kind of white space, or
with the string of a special token, is given to the tokenizer whole, so ids are those of a plain call of the library,
which takes such a string for the token. A null text is an empty one.
"""

from __future__ import annotations

import codecs
import os
import re
from array import array
from itertools import chain, compress

import numpy as np
import pyarrow as pa

from goldleaf.llm.words import Texts

#: Pieces a worker remembers; beyond that it starts anew, taking over those that it meets again before the next time.
#: Affects speed only.
REMEMBERED = 250_000
#: Pieces given to the tokenizer in one string, and words given to its model in one.
JOINED = 256
WORDS = 32

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = True
_SIGN = np.zeros(256, dtype=bool)
_SIGN[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
#: The second bytes of Latin-1 letters whose first is 0xC3; the other two are signs.
_SECOND = np.zeros(256, dtype=bool)
_SECOND[[x for x in range(0x80, 0xC0) if x not in (0x97, 0xB7)]] = True
_WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
#: The character that stands for each byte in a byte-level vocabulary.
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_OTHERS = [x for x in range(256) if x not in _PRINTED]
_BYTES = "".join(chr(x if x in _PRINTED else 256 + _OTHERS.index(x)) for x in range(256))
#: All letters of `_WORD`.
_LETTERS = "".join(chr(x) for x in range(0x100) if _WORD.fullmatch(chr(x).encode()))
#: White space that is neither blank nor line feed, by single bytes and by first bytes of more.
_OTHER = np.zeros(256, dtype=bool)
_OTHER[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_WIDE = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe1\xa0\x8e", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80"]


class Encoder:
    """Ids of texts. `word_ends`: white space is dropped, as the vocabulary marks ends of words."""

    def __init__(self, path: str, word_ends: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        self.tokenizer = Tokenizer.from_file(path)
        self.word_ends = word_ends
        # The same model, for words that are normalized and split already, if this vocabulary treats them as described.
        self.model = None
        probe = _LETTERS if word_ends else f" {_LETTERS}"
        if self._splits(probe) == [self._spelt(probe.encode())]:
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = Split("|", "isolated")
            (self.bar,) = self.model.encode("|", add_special_tokens=False).ids
        # In lower case, as a vocabulary may look for them in normalised text.
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # What stands between pieces in one string, and the single id it gets.
        self.between = "\n|\n" if word_ends else "\n"
        (self.mark,) = self._ids("|" if word_ends else "\n")
        self.known: dict[bytes, int] = {}
        self.pool, self.first, self.size = array("I"), array("q"), array("q")
        self._forget()

    def _splits(self, text: str) -> list[str]:
        """What a plain call gives to the model."""
        normalizer, splitter = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        text = normalizer.normalize_str(text) if normalizer else text
        return [part for part, _ in splitter.pre_tokenize_str(text)] if splitter else [text]

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _forget(self) -> None:
        """Start anew; what was known until now can be recalled until the next time."""
        self.before = self.known, self.pool, self.first, self.size
        self.known = {}
        self.pool, self.first, self.size = array("I"), array("q"), array("q")

    def _keep(self, pieces: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        at = len(self.first)
        self.first.frombytes((np.cumsum(sizes) - sizes + len(self.pool)).astype(np.int64).tobytes())
        self.size.frombytes(sizes.astype(np.int64).tobytes())
        self.pool.frombytes(ids.astype(np.uint32).tobytes())
        self.known.update(zip(pieces, range(at, at + len(pieces))))

    def _recall(self, pieces: list[bytes]) -> list[bytes]:
        """Remember those that were known before; returns the others."""
        known, pool, first, size = self.before
        found = list(map(known.get, pieces))
        entry = np.array([x for x in found if x is not None], dtype=np.int64)
        if len(entry):
            sizes = np.frombuffer(size, np.int64)[entry]
            ids = np.frombuffer(pool, np.uint32)[_runs(np.frombuffer(first, np.int64)[entry], sizes)]
            self._keep([p for p, x in zip(pieces, found) if x is not None], ids, sizes)
        return [p for p, x in zip(pieces, found) if x is None]

    def _spelt(self, text: bytes) -> str:
        """Words of Latin-1 letters as the model gets them in a plain call."""
        if self.word_ends:
            text = text.decode().lower().encode()
        return codecs.charmap_decode(text, "strict", _BYTES)[0]

    def _learn_words(self, words: list[bytes]) -> None:
        """Remember the ids of words of Latin-1 letters."""
        texts = [self._spelt(b"|".join([*words[i : i + WORDS], b""])) for i in range(0, len(words), WORDS)]
        rows = [out.ids for out in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        row = np.fromiter(chain.from_iterable(rows), np.uint32, sum(map(len, rows)))
        bars = row == self.bar
        self._keep(words, row[~bars], np.diff(np.flatnonzero(bars), prepend=-1) - 1)

    def _learn(self, pieces: list[bytes]) -> None:
        """Remember the ids of new pieces."""
        if self.model:
            is_word = [p.isalpha() or _WORD.fullmatch(p) is not None for p in pieces]
            self._learn_words(list(compress(pieces, is_word)))
            pieces = [p for p, w in zip(pieces, is_word) if not w]
        plain = b"|" if self.word_ends else b"\n"
        alone = [p for p in pieces if plain in p]
        joint = [p for p in pieces if plain not in p] if alone else pieces
        between = self.between.encode()
        groups = [joint[i : i + JOINED] for i in range(0, len(joint), JOINED)]
        strings = [between.join(g).decode("utf-8", "replace") for g in groups]
        done, ids, sizes = [], [], []
        for group, out in zip(groups, self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)):
            row = np.array(out.ids, dtype=np.uint32)
            marks = np.flatnonzero(row == self.mark)
            if len(marks) != len(group) - 1:
                alone += group
                continue
            done += group
            ids.append(np.delete(row, marks))
            sizes.append(np.diff(marks, prepend=-1, append=len(row)) - 1)
        if done:
            self._keep(done, np.concatenate(ids), np.concatenate(sizes))
        if alone:
            texts = [p.decode("utf-8", "replace") for p in alone]
            rows = [out.ids for out in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            flat = np.array([x for row in rows for x in row], dtype=np.uint32)
            self._keep(alone, flat, np.array([len(row) for row in rows], dtype=np.int64))

    def _numbers(self, pieces: list[bytes]) -> np.ndarray:
        """Entry of each of these distinct pieces."""
        if len(self.known) > REMEMBERED:
            self._forget()
        found = list(map(self.known.get, pieces))
        unknown = [i for i, x in enumerate(found) if x is None]
        if unknown:
            new = [pieces[i] for i in unknown]
            self._learn(self._recall(new))
            for i, x in zip(unknown, map(self.known.get, new)):
                found[i] = x
        return np.array(found, dtype=np.int64)

    def _odd(self, texts: Texts) -> np.ndarray:
        """Texts that may hold white space other than blanks and line feeds, or a special token."""
        data = texts.data
        hit = [np.flatnonzero(_OTHER[data])]
        lower = data.tobytes().lower()
        for token in self.special:
            at = lower.find(token)
            while at >= 0:
                hit.append(np.array([at]))
                # Once per text is enough.
                at = lower.find(token, int(texts.at[np.searchsorted(texts.at, at, side="right")]))
        if (data >= 0xC2).any():
            raw = data.tobytes()
            for seq in _WIDE:
                if seq in raw:
                    at = np.flatnonzero(data[: len(data) - len(seq) + 1] == seq[0])
                    for k in range(1, len(seq)):
                        at = at[data[at + k] == seq[k]]
                    hit.append(at)
        out = np.zeros(texts.n, dtype=bool)
        out[np.searchsorted(texts.at, np.concatenate(hit), side="right") - 1] = True
        return out

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        data, n = texts.data, len(texts.data)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(texts.n, np.int64)
        odd = self._odd(texts)
        space = (data == 0x20) | (data == 0x0A)
        edge = np.zeros(n + 1, dtype=bool)
        edge[texts.at] = True
        cut = edge.copy()
        gap = space[1:] != space[:-1]
        letter = _LETTER[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        lead = lead[~edge[lead + 1]]
        letter[lead + 1] = _SECOND[data[lead + 1]]
        # Between a letter and a sign, and where white space begins.
        cut[1:n] |= (letter[:-1] & _SIGN[data[1:]]) | (gap & space[1:])
        last = np.zeros(n, dtype=bool)
        last[:-1] = space[:-1] & ~space[1:] & ~edge[1:n]
        if self.word_ends:
            cut[1:] |= last
        else:
            # The last of some white space begins a piece of its own; a line feed ends it too.
            cut[:n] |= last
            cut[1:] |= last & (data == 0x0A)
        bounds = np.flatnonzero(cut)
        begin, end = bounds[:-1], bounds[1:]
        doc = np.searchsorted(texts.at, begin, side="right") - 1
        keep = ~odd[doc]
        if self.word_ends:
            keep &= ~space[begin]
        begin, end, doc = begin[keep], end[keep], doc[keep]
        counts = np.zeros(texts.n, np.int64)
        ids = np.zeros(0, np.uint32)
        if len(begin):
            # Pieces that lie one after the other share the bytes; gaps are dropped with the pieces.
            packed = data if len(bounds) - 1 == len(begin) else data[np.repeat(keep, np.diff(bounds))]
            offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
            pieces = pa.BinaryArray.from_buffers(
                pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(packed))]
            ).dictionary_encode()
            entry = self._numbers(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())[pieces.indices.to_numpy()]
            first, size = np.frombuffer(self.first, np.int64)[entry], np.frombuffer(self.size, np.int64)[entry]
            ids = np.frombuffer(self.pool, np.uint32)[_runs(first, size)]
            counts = np.bincount(doc, weights=size, minlength=texts.n).astype(np.int64)
        if odd.any():
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i in np.flatnonzero(odd).tolist():
                text = data[texts.at[i] : texts.at[i + 1]].tobytes().decode("utf-8", "replace")
                parts[i] = np.array(self._ids(text), dtype=np.uint32)
                counts[i] = len(parts[i])
            ids = np.concatenate(parts)
        return ids, counts


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of runs that begin at `first`, one run after the other."""
    upto = np.cumsum(size)
    return np.repeat(first - upto + size, size) + np.arange(upto[-1])


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, word_ends: bool) -> Encoder:
    """One per Python worker and vocabulary."""
    key = (path, word_ends)
    if key not in _encoders:
        _encoders[key] = Encoder(path, word_ends)
    return _encoders[key]


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with an end id after each text."""
    return np.insert(ids, np.cumsum(counts), end), counts + 1

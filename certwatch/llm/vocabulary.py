"""Fast encoding with a word-level BPE tokenizer file.

Its pre-tokenizer never crosses white space and its pieces are encoded one by
one, so a batch of texts needs each of its distinct pieces encoded once. Texts of
ASCII and accented Latin letters are cut into pieces here, as the tokenizer's
normaliser only lowers them; in other texts every chunk between spaces that is
not of this kind goes through the tokenizer whole.
"""

from __future__ import annotations

import numpy as np

from certwatch.llm.batches import per_process, ranges, word_hashes

_SLOTS = 1 << 22
_KEPT_WORDS = 1 << 21
_SPACE, _LETTER, _DIGIT, _OTHER, _ODD = range(5)


def _byte_classes() -> np.ndarray:
    out = np.full(256, _ODD, np.uint8)
    out[33:127] = _OTHER
    out[[9, 10, 13, 32]] = _SPACE
    out[48:58] = _DIGIT
    out[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3]] = _LETTER
    return out


_CLASS = _byte_classes()
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class _Words:
    """Ids of words by their 64-bit hash, in flat arrays with open addressing."""

    def __init__(self, dtype: np.dtype):
        self.keys, self.places = np.zeros(_SLOTS, np.uint64), np.zeros(_SLOTS, np.int32)
        self.starts, self.sizes = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.ids, self.count, self.used = np.zeros(4096, dtype), 0, 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each word, -1 if it is not here."""
        out = np.full(len(hashes), -1, np.int64)
        slots, left = (hashes & np.uint64(_SLOTS - 1)).astype(np.int64), np.arange(len(hashes))
        while len(left):
            keys = self.keys[slots]
            same = keys == hashes[left]
            out[left[same]] = self.places[slots[same]]
            on = ~same & (keys != 0)
            left, slots = left[on], (slots[on] + 1) % _SLOTS
        return out

    def add(self, key: int, ids: np.ndarray) -> None:
        slot = key % _SLOTS
        while self.keys[slot]:
            slot = (slot + 1) % _SLOTS
        if self.count == len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, x]) for x in (self.starts, self.sizes))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, self.ids])
        self.keys[slot], self.places[slot] = key, self.count
        self.starts[self.count], self.sizes[self.count] = self.used, len(ids)
        self.ids[self.used:self.used + len(ids)] = ids
        self.count, self.used = self.count + 1, self.used + len(ids)


class Encoder:
    """Ids of texts as arrays of ``dtype``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._words = _Words(self.dtype)
        self._letters = dict(enumerate(_byte_letters()))

    def _word(self, word: bytes) -> list[int]:
        """The ids of one piece in lower case."""
        shown = word.decode("latin-1")
        if not word.isascii():
            shown = shown.translate(self._letters)
        return [t.id for t in self.tokenizer.model.tokenize(shown)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The ids of each text of a UTF-8 array."""
        low, kinds = _LOWER[data], _CLASS[data]
        odd = kinds == _ODD
        odd[(data == 0xC3) & (np.append(data[1:], 0) == 0x97)] = True
        odd[(data == 0xC3) & (np.append(data[1:], 0) == 0xB7)] = True
        inside = (data >= 0x80) & (data < 0xC0)
        odd |= inside & (np.insert(data[:-1], 0, 0)[:len(data)] != 0xC3)
        odd |= (data == ord("<")) & (np.append(data[1:], 0) == ord("|"))
        odd_before = np.concatenate([[0], np.cumsum(odd)])[offsets]
        plain = np.diff(odd_before) == 0
        low[inside & (data < 0x9F)] += 0x20  # the second byte of an accented capital
        ids, ends = self._plain(low, kinds, offsets, plain)
        out = np.split(ids, ends[:-1])
        for i in np.flatnonzero(~plain):
            out[i] = self._mixed(data[offsets[i]:offsets[i + 1]].tobytes().decode())
        return out

    def _plain(self, low: np.ndarray, kinds: np.ndarray, offsets: np.ndarray,
               plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the plain texts, and where each text's ids end."""
        kinds = np.where(np.repeat(plain, np.diff(offsets)), kinds, _SPACE)
        before = np.insert(kinds[:-1], 0, _SPACE)[:len(kinds)]
        before[offsets[:-1][offsets[:-1] < len(kinds)]] = _SPACE
        first = (kinds != _SPACE) & ((kinds != before) | (kinds == _DIGIT))
        self._contractions(low, kinds, first, offsets)
        after = np.append(first[1:] | (kinds[1:] == _SPACE), True)[:len(kinds)]
        after[offsets[1:-1][offsets[1:-1] > 0] - 1] = True
        starts, stops = np.flatnonzero(first), np.flatnonzero(after & (kinds != _SPACE)) + 1
        hashes = np.maximum(word_hashes(low, starts, stops), np.uint64(1))
        known = self._words.find(hashes)
        if (known < 0).any():
            if self._words.count > _KEPT_WORDS:
                self._words = _Words(self.dtype)
            new = np.flatnonzero(self._words.find(hashes) < 0)
            keys, where = np.unique(hashes[new], return_index=True)
            text = low.tobytes()
            for key, i in zip(keys.tolist(), new[where].tolist()):
                self._words.add(key, self._word(text[starts[i]:stops[i]]))
            known = self._words.find(hashes)
        sizes = self._words.sizes[known]
        ids = self._words.ids[ranges(self._words.starts[known], sizes)]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return ids, total[np.searchsorted(starts, offsets[1:])]

    @staticmethod
    def _contractions(low: np.ndarray, kinds: np.ndarray, first: np.ndarray, offsets: np.ndarray) -> None:
        """An apostrophe alone takes 's, 't, 'm, 'd, 're, 've or 'll with it."""
        for i in np.flatnonzero((low == 39) & first).tolist():
            if i + 1 >= len(low) or kinds[i + 1] != _LETTER:
                continue
            end = int(offsets[np.searchsorted(offsets, i, side="right")])
            tail = low[i + 1:min(i + 3, end)].tobytes()
            size = 2 if tail in (b"re", b"ve", b"ll") else 1 if tail[:1] in (b"s", b"t", b"m", b"d") else 0
            if size:
                first[i + 1] = False
                if i + 1 + size < end and kinds[i + 1 + size] == _LETTER:
                    first[i + 1 + size] = True

    def _mixed(self, text: str) -> np.ndarray:
        out = []
        for chunk in text.replace("\n", " ").split(" "):
            raw = chunk.encode()
            if raw.isalpha() and raw.isascii():
                out.extend(self._word(raw.lower()))
            elif chunk:
                out.extend(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        return np.array(out, self.dtype)


def encoder(path: str) -> Encoder:
    """The process's encoder for the tokenizer file ``path`` names."""
    return per_process(("encoder", path), lambda: Encoder(path))

"""Counts per line of many texts at once. Lines are what stands between line feeds; nothing is copied out of the buffer."""

from __future__ import annotations

from functools import cached_property

import numpy as np

from tally.llm.words import _POWERS, _LETTERS, Words, mixed


def _bytes(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


SYMBOLS = _bytes("#*$%&|<>")
_UPPER = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _bytes("abcdefghijklmnopqrstuvwxyz")
_LETTER[0xC2:0xF5] = True  # first bytes of all other characters
_DIGIT = _bytes("0123456789")
_BANG = _bytes("!?")
_END = _bytes(".!?:;\"')")
_END[0x80:] = True  # the closing marks of other scripts; a word's letter in the worst case


class Lines:
    """The lines of ``words``' texts. Arrays have one entry per line."""

    def __init__(self, words: Words):
        self.words = words
        self.ends = np.flatnonzero(words.buffer == 10)
        self.starts = np.concatenate([[0], self.ends[:-1] + 1])[: len(self.ends)]
        self.first = np.searchsorted(self.starts, np.append(words.begins, len(words.buffer)))  # first line of each text
        self.text = np.repeat(np.arange(len(words.begins)), np.diff(self.first))
        at = np.searchsorted(words.starts, np.append(self.starts, len(words.buffer)))
        self.first_word, self.n_words = at[:-1], np.diff(at)

    def count(self, mask: np.ndarray) -> np.ndarray:
        """Bytes of each line at which ``mask`` holds."""
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return sums[self.ends] - sums[self.starts]

    def count_words(self, mask: np.ndarray) -> np.ndarray:
        """Words of each line at which ``mask`` holds."""
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums[self.first_word + self.n_words] - sums[self.first_word]

    @cached_property
    def points(self) -> np.ndarray:
        return self.count((self.words.buffer & 0xC0) != 0x80)

    @cached_property
    def symbols(self) -> np.ndarray:
        return self.count(SYMBOLS[self.words.buffer])

    @cached_property
    def letters(self) -> np.ndarray:
        return self.count(_LETTER[self.words.buffer])

    @cached_property
    def upper(self) -> np.ndarray:
        """Capitals of ASCII and Latin-1."""
        b = self.words.buffer
        latin = np.zeros(len(b), bool)
        latin[1:] = (b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] <= 0x9E)
        return self.count(_UPPER[b] | latin)

    @cached_property
    def digits(self) -> np.ndarray:
        return self.count(_DIGIT[self.words.buffer])

    @cached_property
    def bangs(self) -> np.ndarray:
        return self.count(_BANG[self.words.buffer])

    @cached_property
    def bars(self) -> np.ndarray:
        """Words that are a single bar, angle or middle dot: what parts the links of a menu."""
        w, b = self.words, self.words.buffer
        one = (w.stops - w.starts == 1) & ((b[w.starts] == 124) | (b[w.starts] == 60) | (b[w.starts] == 62))
        two = (w.stops - w.starts == 2) & (b[w.starts] == 0xC2) & ((b[w.stops - 1] == 0xB7) | (b[w.stops - 1] == 0xBB))
        return self.count_words(one | two)

    @cached_property
    def ended(self) -> np.ndarray:
        """Does the last word end with a closing mark?"""
        out = np.zeros(len(self.ends), bool)
        there = self.n_words > 0
        last = self.words.stops[(self.first_word + self.n_words - 1)[there]] - 1
        out[there] = _END[self.words.buffer[last]]
        return out

    @cached_property
    def stutters(self) -> np.ndarray:
        """Words equal to the word before."""
        h = self.words.hashes
        same = np.zeros(len(h), bool)
        same[1:] = h[1:] == h[:-1]
        return self.count_words(same)

    @cached_property
    def word_line(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ends)), self.n_words)

    @cached_property
    def repeated(self) -> np.ndarray:
        """Of each word: does it stand in a run of five words that its text holds twice or more?"""
        w = self.words
        hashes, at = w.windows(5)
        text = self.text[self.word_line[at]] if len(at) else at
        keys = mixed(hashes + text.astype(np.uint64) * _LETTERS[7])
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        again = np.zeros(len(at), bool)
        again[order[1:][same]] = True
        again[order[:-1][same]] = True
        edge = np.zeros(len(w.starts) + 5, np.int32)
        edge[at[again]] += 1
        edge[at[again] + 5] -= 1
        return np.cumsum(edge)[: len(w.starts)] > 0

    @cached_property
    def hashes(self) -> np.ndarray:
        up, down = _POWERS.of(len(self.words.buffer) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LETTERS[self.words.buffer] * up[: len(self.words.buffer)], dtype=np.uint64)])
        return mixed((sums[self.ends] - sums[self.starts]) * down[self.starts])

    @cached_property
    def seen_before(self) -> np.ndarray:
        """Lines with a word that equal an earlier line of their text."""
        there = np.flatnonzero(self.n_words > 0)
        keys = mixed(self.hashes[there] + self.text[there].astype(np.uint64) * _LETTERS[9])
        order = np.argsort(keys, kind="stable")
        out = np.zeros(len(self.ends), bool)
        out[there[order[1:][keys[order][1:] == keys[order][:-1]]]] = True
        return out

    def per_text(self, counts: np.ndarray) -> np.ndarray:
        """Sums of a count of lines over each text."""
        sums = np.concatenate([[0], np.cumsum(counts)])
        return sums[self.first[1:]] - sums[self.first[:-1]]

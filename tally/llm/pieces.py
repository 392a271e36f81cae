"""Whole texts to token ids by the tokenizers library, encoding each distinct piece once.

A text is cut in front of a space or line feed that follows a character which is no white space, and between a letter
or digit and an ASCII mark other than an apostrophe. No token of the supported vocabularies crosses such a place:
their patterns never put white space behind other characters, never join letters to marks, and look ahead only. So the
ids of a text are the ids of its pieces, one after another. Texts in which white space stands in other ways (or which
hold control characters) are cut at white space only.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core a task

# how much is remembered; beyond it the memo starts anew, which costs time and changes nothing
MEMO_PIECES = 500_000

# white space besides single spaces and line feeds within the text; control characters; a letter that lower case breaks up;
# what opens a special string
_UNEVEN = (
    r"[\x00-\x09\x0b-\x1f\x{85}\x{a0}\x{130}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    r"|[ \n][ \n]|\A[ \n]|[ \n]\z|<\|"
)
_MARKS = r"([\pL\pN])([!-&(-/:-@\[-^`{-~])"
# 1C to 1F are white space to Python only, so no cut touches them
_PLACES = re.compile(r"(?<=\S)(?=[^\S\x1c-\x1f])")


def piece_of(key: str) -> str:
    """A key that starts with a space or the byte 1 stands for the rest of it, one that starts with a line feed for
    itself, any other for itself behind one space."""
    return key[1:] if key[0] in " \x01" else key if key[0] == "\n" else " " + key


def _byte_letters() -> dict[int, int]:
    """Bytes (as Latin-1) to the letters that byte-level vocabularies write for them: printable ones stand for
    themselves, the others follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in own)}


class _Codes(dict):
    """Numbers of the keys; new keys get the next number and wait to be encoded."""

    def __init__(self):
        self.waiting: list[str] = []

    def __missing__(self, key: str) -> int:
        code = self[key] = len(self)
        self.waiting.append(key)
        return code


class PieceTokens:
    """Ids of whole texts; one instance per Python worker and vocabulary file."""

    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.memo_pieces = memo_pieces
        self.letters = _byte_letters()
        self.blank = chr(self.letters[ord(" ")])
        self.lower = bool(json.loads(self.tokenizer.to_str())["normalizer"])
        # a run of letters is one word to the model, which can be asked directly if that gives the library's ids
        probe = [" the", "Probe", " Äpfel", "été", " жук"]
        full = [e.ids for e in self.tokenizer.encode_batch(probe, add_special_tokens=False)]
        self.direct = full == [self._word_ids(p) for p in probe]
        self._forget()

    def _forget(self) -> None:
        self.codes = _Codes()
        self.flat = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.starts = np.empty(1 << 15, np.int64)
        self.lengths = np.empty(1 << 15, np.int64)

    def _word_ids(self, piece: str) -> list[int]:
        plain = piece.isascii()  # its letters stand for themselves, and are composed already
        if self.lower:
            piece = (piece.strip(" ") if plain else unicodedata.normalize("NFC", piece.strip(" "))).lower()
        written = piece.replace(" ", self.blank) if plain else piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.tokenizer.model.tokenize(written)]

    def _is_word(self, key: str) -> bool:
        """Letters of the Latin, Greek and Cyrillic blocks only, besides a sigma, whose lower case depends on its place."""
        letters = key[1:] if key[0] in " \x01" else key
        return letters.isalpha() and max(letters) < "԰" and "Σ" not in letters and "İ" not in letters

    def _encode_waiting(self) -> None:
        waiting, self.codes.waiting = self.codes.waiting, []
        if not waiting:
            return
        rows: list[list[int] | None] = [self._word_ids(piece_of(k)) if self.direct and self._is_word(k) else None for k in waiting]
        rest = [i for i, r in enumerate(rows) if r is None]
        if rest:
            for i, e in zip(rest, self.tokenizer.encode_batch_fast([piece_of(waiting[i]) for i in rest], add_special_tokens=False), strict=True):
                rows[i] = e.ids
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
        total, first = int(lengths.sum()), len(self.codes) - len(rows)
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while first + len(rows) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.empty_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.empty_like(self.lengths)])
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(rows), np.uint32, total)
        self.lengths[first : first + len(rows)] = lengths
        self.starts[first : first + len(rows)] = self.used + np.cumsum(lengths) - lengths
        self.used += total

    def _coded(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Piece numbers of all texts in a row, and the place where each text ends."""
        if len(self.codes) > self.memo_pieces:
            self._forget()
        texts = pc.fill_null(texts, "")
        uneven = pc.or_(pc.match_substring_regex(texts, _UNEVEN), pc.equal(texts, "")).to_numpy(zero_copy_only=False)
        counts = np.zeros(len(texts), np.int64)
        number = self.codes.__getitem__
        even_codes = np.empty(0, np.int64)
        if not uneven.all():
            even = texts.filter(pa.array(~uneven))
            marked = pc.replace_substring_regex(pc.replace_substring(even, "\n", " \n"), _MARKS, "\\1 \x01\\2")
            lists = pc.split_pattern(marked, " ")
            sizes = np.diff(lists.offsets.to_numpy())
            seen = lists.flatten().dictionary_encode()
            words = seen.dictionary.to_pylist()
            local = seen.indices.to_numpy()
            firsts = np.cumsum(sizes) - sizes
            even_codes = np.fromiter(map(number, words), np.int64, len(words))[local]
            even_codes[firsts] = [number(" " + words[w]) for w in local[firsts].tolist()]
            counts[~uneven] = sizes
        if not uneven.any():
            self._encode_waiting()
            return even_codes, np.cumsum(counts)
        rows = []
        for i, text in zip(np.flatnonzero(uneven).tolist(), texts.filter(pa.array(uneven)).to_pylist(), strict=True):
            rows.append([number(" " + run) for run in _PLACES.split(text)] if text else [])
            counts[i] = len(rows[-1])
        ends = np.cumsum(counts)
        codes = np.empty(int(ends[-1]), np.int64)
        codes[np.repeat(~uneven, counts)] = even_codes
        codes[np.repeat(uneven, counts)] = np.fromiter(chain.from_iterable(rows), np.int64)
        self._encode_waiting()
        return codes, ends

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Number of tokens of each text."""
        codes, ends = self._coded(texts)
        sums = np.concatenate([[0], np.cumsum(self.lengths[codes])])
        return np.diff(sums[np.concatenate([[0], ends])])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (uint32), and the place where each text ends."""
        codes, ends = self._coded(texts)
        lengths = self.lengths[codes]
        sums = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(self.starts[codes] - sums[:-1], lengths)
        at += np.arange(int(sums[-1]))
        return self.flat[at], sums[ends]


_LOADED: dict[str, PieceTokens] = {}


def loaded(path: str) -> PieceTokens:
    """The worker's instance for a vocabulary file; workers live on from task to task and keep their memo."""
    if path not in _LOADED:
        _LOADED[path] = PieceTokens(path)
    return _LOADED[path]


def with_end(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` behind each text."""
    return np.insert(ids, ends, np.uint32(end_id)), ends + np.arange(1, len(ends) + 1)

"""Token ids of whole texts with public tokenizers, one lookup per piece of text.

A byte-pair tokenizer never merges across the pieces its splitting rule makes, so the
ids of a text are the ids of its pieces in a row. Pieces end where a word meets one blank or
line end; each distinct piece goes through the tokenizers library once and later comes
from a table of bounded size in the worker; once the table is full, pieces that were met
only once make room. A text with runs of white space at such a
place is cut where a run begins, so a run always stays with the word after it. Plain
words with closing punctuation go to the library's model as the two parts that the
splitting rule makes of them; all other pieces go through the whole tokenizer.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

# Pieces (some 150 MB) and other parts of pieces a worker remembers before it makes room.
REMEMBERED = 900_000
PARTS = 20_000
# Texts that are Python strings at a time.
TEXTS = 256

# The white-space code points of the Unicode property.
_WHITE = "\t-\r \x85\xa0  -     　"
_SEGMENT = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
# Letters that lower-casing and composition treat one by one, then closing punctuation.
_SIMPLE = re.compile(
    "([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-įı-ſ]+)([.,!?;:%$&#*|)]*)"
)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: itself if printable."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Places(dict):
    """Numbers of pieces in the order in which they are first looked up; `new` lists fresh ones."""

    def __init__(self, *args):
        super().__init__(*args)
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        at = self[key] = len(self)
        self.new.append(key)
        return at


class PieceEncoder:
    """Ids of texts; `blanks` tells whether white space takes part in the ids."""

    def __init__(self, path: str, blanks: bool, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model_ids = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.before = self.letters[0x20]
        self.blanks = blanks
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.place = Places()
        self.known = 0
        self.parts: dict[str, list[int]] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.limits = np.zeros(1 << 14, np.int64)
        self.again = np.zeros(1 << 14, bool)

    def _make_room(self) -> None:
        """Keeps the pieces that were met again since they came or since this was last done."""
        kept = np.flatnonzero(self.again[: self.known])
        if 2 * len(kept) > self.remembered:
            self._forget()
            return
        names = list(self.place)
        names = [names[i] for i in kept.tolist()]
        self.place.clear()  # else both tables would be held at once
        self.place.update(zip(names, range(len(names))))
        begin = self.limits[kept]
        lengths = self.limits[kept + 1] - begin
        ends = np.cumsum(lengths)
        shift = np.repeat(begin - (ends - lengths), lengths)
        self.ids[: len(shift)] = self.ids[shift + np.arange(len(shift))]
        self.limits[1 : len(kept) + 1] = ends
        self.known = len(kept)
        self.again[:] = False

    def _tokenize(self, part: str, blank: bool) -> list[int]:
        """Ids of one part that the splitting rule leaves whole, after one blank or not."""
        written = part
        if not part.isascii() or part == "\n":
            written = part.encode().decode("latin-1").translate(self.letters)
        if blank:
            written = self.before + written
        return [token.id for token in self.model_ids(written)]

    def _word(self, word: str) -> list[int]:
        """Ids of a word as it stands after one blank: a piece of its own."""
        at = self.place.get(word)
        if at is not None and at < self.known:
            self.again[at] = True
            return self.ids[self.limits[at] : self.limits[at + 1]].tolist()
        known = self.fresh.get(word)
        if known is None:
            known = self.fresh[word] = self._tokenize(word, self.blanks)
        return known

    def _part(self, part: str) -> list[int]:
        """Ids of closing punctuation, a line end or a word after it."""
        known = self.parts.get(part)
        if known is None:
            if len(self.parts) > PARTS:
                self.parts.clear()
            known = self.parts[part] = self._tokenize(part, False)
        return known

    def _whole(self, piece: str) -> list[int]:
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def _ids(self, key: str) -> list[int]:
        """Ids of one piece; the first letter of its key tells how it stood in the text."""
        if key.isalpha() and key.isascii():
            written = self.before + key if self.blanks else key.lower()
            return [token.id for token in self.model_ids(written)]
        first = key[:1]
        line = first == "\n"
        if self.blanks and (first == "\0" or first == "\1"):
            return self._whole(key[1:])
        simple = _SIMPLE.fullmatch(key, line)
        if simple is None:
            return self._whole(" " + key if self.blanks and not line else key)
        word, end = simple.groups()
        if line:
            ids = self._part("\n") + self._part(word)
        else:
            ids = self._word(word if self.blanks else word.lower())
        return ids + self._part(end) if end else ids

    def _learn(self, keys: list[str]) -> None:
        """Ids of the pieces that were looked up first, in the order of their numbers."""
        known, place = self.known, self.place
        self.fresh: dict[str, list[int]] = {}
        new = list(map(self._ids, keys))
        for word, ids in self.fresh.items():
            if word not in place:
                place[word] = len(place)
                new.append(ids)
        counts = np.fromiter(map(len, new), np.int64, len(new))
        used = int(self.limits[known])
        total = used + int(counts.sum())
        self.known += len(new)
        while len(self.limits) < self.known + 1:
            self.limits = np.concatenate([self.limits, np.zeros_like(self.limits)])
            self.again = np.concatenate([self.again, np.zeros_like(self.again)])
        while len(self.ids) < total:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.limits[known + 1 : self.known + 1] = used + np.cumsum(counts)
        self.ids[used:total] = np.fromiter(chain.from_iterable(new), np.uint32, total - used)

    def _numbers(self, keys: list[str]) -> np.ndarray:
        """The number of each piece; new ones get the next numbers and stand in place.new."""
        self.place.new = []
        return np.fromiter(map(self.place.__getitem__, keys), np.int64, len(keys))

    def _cut(self, text: str) -> np.ndarray:
        """Numbers of the pieces of a text, new ones among them."""
        if not self.blanks:
            # Letters up to U+00FF are lower-cased one by one, before or after the cut.
            if "<|" not in text and _is_latin(text):
                text = text.lower()
            return self._numbers(text.replace("\n", " ").split(" "))
        if "\0" in text or "\1" in text:
            return self._segments(text)
        # "\0": stands first; "\n": after a line end; all others: after one blank.
        keys = text.replace("\n", " \n").split(" ")
        keys[0] = "\0" + keys[0]
        where = self._numbers(keys)
        for key in self.place.new:
            bare = key[1:] if key[:1] in ("\0", "\n") else key
            if not bare or bare[0].isspace() or bare[-1].isspace():
                for fresh in self.place.new:
                    del self.place[fresh]
                return self._segments(text)  # such a key is never remembered
        return where

    def _segments(self, text: str) -> np.ndarray:
        """As _cut, for a text with runs of white space or with the letters of the marks."""
        return self._numbers(["\1" + segment for segment in _SEGMENT.findall(text)])

    def encode(self, text: str) -> np.ndarray:
        """The ids of one whole text as an array of unsigned 32-bit integers."""
        if not text:
            return np.zeros(0, np.uint32)
        if self.known > self.remembered:
            self._make_room()
        known = self.known
        where = self._cut(text)
        if self.place.new:
            self._learn(self.place.new)
        self.again[where] = True
        self.again[known : self.known] = False
        begin = self.limits[where]
        lengths = self.limits[where + 1] - begin
        shift = np.repeat(begin - (np.cumsum(lengths) - lengths), lengths)
        return self.ids[shift + np.arange(len(shift))]


@lru_cache(maxsize=2)
def encoder(path: str, blanks: bool) -> PieceEncoder:
    """The worker's encoder for this file; its memory of pieces serves later tasks too."""
    return PieceEncoder(path, blanks)


def encode_all(texts: pa.Array, path: str, blanks: bool) -> Iterator[np.ndarray]:
    """The ids of each text of an Arrow column; a null is an empty text."""
    own = encoder(path, blanks)
    for first in range(0, len(texts), TEXTS):
        for text in texts.slice(first, TEXTS).to_pylist():
            yield own.encode(text or "")

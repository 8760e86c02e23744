"""Token ids of whole texts, by the tokenizers library, with every distinct piece encoded once.

Both tokenizers used here cut a text before merging, and never across the border
between a character and the white space after it. So a text may be cut there first
and the pieces encoded one by one: the ids are the same, and since natural text
repeats its words, nearly all pieces come out of a dictionary.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable

import numpy as np

# Distinct pieces in one generation of a worker's memory. A full generation becomes
# the previous one and the one before is dropped, so frequent pieces stay known,
# memory stays bounded and results do not change.
REMEMBERED = 300_000

_GAP = re.compile(r"\s[ \n]")
_BORDER = re.compile(r"(?<=\S)(?=\s)")
# A word and closing punctuation, which both tokenizers part. No apostrophe: it may
# begin a contraction.
_WORD = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in plain}
    rest = (b for b in range(256) if b not in shown)
    shown |= {b: chr(256 + i) for i, b in enumerate(rest)}
    return [shown[b] for b in range(256)]


_LETTERS = _byte_letters()


class PieceEncoder(dict):
    """piece -> its ids as little-endian unsigned 32-bit bytes.

    A piece that does not begin with white space stands for the piece after one
    space when ``spaced`` is set (byte-level vocabularies keep the space, the other
    kind lower-cases and drops it).
    """

    def __init__(self, path: str, spaced: bool) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = spaced
        self.before: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def raw(self, text: str) -> bytes:
        """Ids of ``text`` as it stands."""
        if not text:
            return b""
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of letters, after a space or not: one unit, so it can go to the merges."""
        if self.spaced:
            unit = word
        else:
            unit = word.lower()
        if not (unit.isascii() and unit.isalpha()):
            unit = "".join([_LETTERS[b] for b in unit.encode()])
        return array("I", [t.id for t in self.tokenizer.model.tokenize(unit)]).tobytes()

    def _tail(self, tail: str) -> bytes:
        if tail not in self.tails:
            if len(self.tails) > 10_000:
                self.tails.clear()
            self.tails[tail] = self.raw(tail)
        return self.tails[tail]

    def __missing__(self, piece: str) -> bytes:
        found = self.before.get(piece)
        if found is None:
            spaced, broken = self.spaced, piece[:1] == "\n"
            parts = _WORD.fullmatch(piece, broken)
            # Latin letters only: they have one form under any normalisation. A lower case
            # of several characters may hold marks, which would join what follows.
            plain = parts and max(parts[1]) < "\u0250" and parts[1].isalpha()
            if plain and len(parts[1].lower()) == len(parts[1]):
                word, tail = parts.groups()
                if tail:
                    found = self[piece[: -len(tail)]] + self._tail(tail)
                elif broken:
                    found = self._tail("\n") + self._word(word)
                else:
                    found = self._word(" " + word if spaced else word)
            else:
                found = self.raw(" " + piece if spaced and not broken else piece)
        self[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a whole text."""
        if len(self) > REMEMBERED:
            self.before = dict(self)
            self.clear()
        if not self.spaced:
            return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))
        if _GAP.search(text):
            return b"".join(map(self._loose, _BORDER.split(text)))
        first, *rest = text.replace("\n", " \n").split(" ")
        return self.raw(first) + b"".join(map(self.__getitem__, rest))

    def _loose(self, piece: str) -> bytes:
        if piece[:1] == " " and piece[1:2] not in ("", "\n") and not piece[1].isspace():
            return self[piece[1:]]
        return self.raw(piece)


_ENCODERS: dict[tuple[str, bool], PieceEncoder] = {}


def encoder(path: str, spaced: bool) -> PieceEncoder:
    """This worker's encoder; workers are reused, so it is warm after the first task."""
    key = (path, spaced)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, spaced)
    return _ENCODERS[key]


def encode_all(path: str, spaced: bool, texts: Iterable[str | None]) -> list[np.ndarray]:
    """Ids of each text; null counts as empty."""
    known = encoder(path, spaced)
    return [np.frombuffer(known.encode(text or ""), dtype="<u4") for text in texts]

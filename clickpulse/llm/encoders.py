"""Token ids of texts, by the ``tokenizers`` library with a word cache.

Both vocabularies split a text into pieces before the merges, and a piece's
ids depend on the piece alone.  So a text can be cut wherever a piece must
begin, and its ids are the ids of the parts, one after the other.  A part met
before comes from a bounded cache; a new one goes through the library's own
normalizer, pre-tokenizer and model.  The strings of special tokens in a text
are ordinary text, as the vocabularies' notes advise.
"""

from __future__ import annotations

import re
from array import array

#: Cached parts of one Python worker; a full cache starts anew.
CACHE_PARTS = 500_000
#: Longer parts are not kept.
PART_CHARS = 64

#: White space other than space and line feed.
_ASCII_ODD = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_ODD = re.compile(r"[^\S \n]")
_CUT = re.compile(r" (?=\S)")
_MARKS = frozenset(".,;:!?")


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write a byte as one visible character: itself
    where Latin-1 shows it, else the next character from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b if b in shown else next(rest)) for b in range(256)}


_LETTERS = _byte_letters()


class _Parts(dict):
    """Part of a text -> its ids as little-endian unsigned 32-bit integers.
    ``prefix`` goes in front of every part before it is encoded."""

    def __init__(self, tok, prefix: str = "", lower: bool = False):
        super().__init__()
        self.model = tok.model
        self.lower = lower
        self.normal = tok.normalizer
        self.split = tok.pre_tokenizer.pre_tokenize_str
        self.prefix = prefix
        self.marks = {m: self._ids(m) for m in _MARKS}

    def __missing__(self, part: str) -> bytes:
        if part.isalpha() and (part.isascii() or max(part) < "\u0100"):
            # Latin-1 letters alone are one piece, and no normal form changes them
            text = self.prefix + (part.lower() if self.lower else part)
            piece = text.encode().decode("latin-1").translate(_LETTERS)
            return self._keep(part, array("I", [t.id for t in self.model.tokenize(piece)]).tobytes())
        if len(part) > 1 and part[-1] in _MARKS and part[-2] < "\u0100" and part[-2].isalpha():
            return self._keep(part, self[part[:-1]] + self.marks[part[-1]])
        return self._keep(part, self._ids(self.prefix + part))

    def _ids(self, text: str) -> bytes:
        """By the library's own normalizer, pre-tokenizer and model."""
        if self.normal is not None:
            text = self.normal.normalize_str(text)
        tokenize = self.model.tokenize
        return array("I", [t.id for piece, _ in self.split(text) for t in tokenize(piece)]).tobytes()

    def _keep(self, part: str, out: bytes) -> bytes:
        if len(part) <= PART_CHARS:
            if len(self) >= CACHE_PARTS:
                self.clear()
            self[part] = out
        return out


class _Spaced(_Parts):
    """Parts that follow a space; one with a line feed in front follows that."""

    def __init__(self, tok, first: _Parts):
        super().__init__(tok, " ")
        self.first, self.feed = first, first["\n"]

    def __missing__(self, part: str) -> bytes:
        if part[:1] == "\n":
            return self._keep(part, self.feed + self.first[part[1:]])
        return super().__missing__(part)


class ByteEncoder:
    """Byte-level vocabulary: one space before a word belongs to the word."""

    def __init__(self, tok):
        self.first = _Parts(tok)
        self.spaced = _Spaced(tok, self.first)

    def __call__(self, text: str | None) -> bytes:
        """The ids of ``text`` (null or empty: none), 4 bytes each."""
        if not text:
            return b""
        if self._runs(text):
            # cut only where one space stands before a word: a piece begins there
            at = sorted({0, *(m.start() for m in _CUT.finditer(text)), len(text)})
            return b"".join([self._ids_of(text[a:b]) for a, b in zip(at, at[1:])])
        words = text.replace("\n", " \n").split(" ")
        return self.first[words[0]] + b"".join(map(self.spaced.__getitem__, words[1:]))

    def _ids_of(self, part: str) -> bytes:
        if part[0] == " " and part[1:2] not in ("", "\n"):
            return self.spaced[part[1:]]
        return self.first[part]

    @staticmethod
    def _runs(text: str) -> bool:
        """White space longer than one character, or other than space and
        line feed: a piece may then hold several of them."""
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return True
        if text.isascii():
            return any(c in text for c in _ASCII_ODD)
        return _ODD.search(text) is not None


class WordEncoder:
    """Vocabulary with word ends: white space only separates words."""

    def __init__(self, tok):
        self.parts = _Parts(tok, lower=True)

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        return b"".join(map(self.parts.__getitem__, text.replace("\n", " ").split(" ")))


_made: dict[tuple, object] = {}


def encoder(kind: str, path: str):
    """The worker's encoder for a vocabulary file; ``kind``: byte or word."""
    if (kind, path) not in _made:
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        tok.encode_special_tokens = True
        _made[kind, path] = (ByteEncoder if kind == "byte" else WordEncoder)(tok)
    return _made[kind, path]

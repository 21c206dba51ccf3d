"""Token ids of whole texts by a byte-level `tokenizers` file, as little-endian uint32 bytes.

Byte-level BPE never merges across a pre-token, and a cut before a single space between two
non-space characters is always a pre-token boundary. Each text is therefore cut at such spaces
and every distinct piece is encoded once per Python worker. The ids are kept from task to task, in two generations of
at most `GENERATION` bytes: when the younger is full it becomes the older, whose words come back when they are met again.
A text in which a space touches any other white space, or that holds one of the tokenizer's special strings, is encoded in
one call instead.
"""

from __future__ import annotations

import codecs
import re
from array import array

import pyarrow as pa
import regex
from tokenizers import Tokenizer

GPT2_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value
ASCII_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"  # the same, of ASCII texts
GENERATION, ENTRY = 144 << 20, 190  # bytes; of an entry besides its key and ids

# Characters whose Unicode class every regex engine agrees on, so that GPT2_SPLIT gives the
# library's own pre-tokens.
_PLAIN = re.compile(r"[!-~À-ɏ](?:[!-~\nÀ-ɏ]*[!-~À-ɏ])?").fullmatch
_STOPS = frozenset(".,;:!?")
_EDGE = re.compile(r"[!-~\w]").match


class _Unsafe(Exception):
    """A piece that can't be encoded apart from its neighbours."""


def _byte_letters() -> str:
    """The letter that byte-level BPE writes for each byte: printable Latin-1 as it is, the rest from U+0100 on."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = iter(range(256, 512))
    return "".join(chr(b) if b in kept else chr(next(rest)) for b in range(256))


class _Kept(dict):
    """Ids by string: the younger generation; a miss looks into the older one before it computes."""

    def __init__(self, compute):
        self.compute, self.older, self.size = compute, {}, 0

    def __missing__(self, key: str) -> bytes:
        ids = self.older.get(key)
        if ids is None:
            ids = self.compute(key)
        self.size += len(key) + len(ids) + ENTRY
        if self.size > GENERATION:
            self.older, self.size = dict(self), 0
            self.clear()
        self[key] = ids
        return ids

    def forget(self) -> None:
        self.clear()
        self.older, self.size = {}, 0


class _Words(_Kept):
    """Ids of a space and the key."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__(self.word)
        self.tokenizer, self.letters = tokenizer, _byte_letters()
        self.tokens = tokenizer.model.tokenize
        self.split, self.split_ascii = regex.compile(GPT2_SPLIT).findall, re.compile(ASCII_SPLIT, re.ASCII).findall
        self.inner = _Kept(self.piece)

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a plain text."""
        return (self.split_ascii if text.isascii() else self.split)(text)

    def piece(self, piece: str) -> bytes:
        """Ids of one pre-token."""
        if piece.isascii() and piece.isprintable():  # printable ASCII but the space stands for itself
            word = piece.replace(" ", "\u0120")
        else:
            word = codecs.charmap_decode(piece.encode(), "strict", self.letters)[0]
        return array("I", [t.id for t in self.tokens(word)]).tobytes()

    def word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():  # most words: one pre-token
            return array("I", [t.id for t in self.tokens("\u0120" + word)]).tobytes()
        plain = _PLAIN(word)
        if plain and word.isalpha():  # one pre-token
            return self.piece(" " + word)
        if plain and word[-1] in _STOPS and word[:-1].isalpha():
            return self[word[:-1]] + self.inner[word[-1]]
        if plain:
            first, *rest = self.pieces(" " + word)
            if not rest:
                return self.piece(first)
            return (self[first[1:]] if len(first) > 1 else self.inner[first]) + b"".join(map(self.inner.__getitem__, rest))
        if word and _EDGE(word[0]) and _EDGE(word[-1]):
            return _whole(self.tokenizer, " " + word)
        raise _Unsafe

    def forget(self) -> None:
        super().forget()
        self.inner.forget()


def _whole(tokenizer: Tokenizer, text: str) -> bytes:
    return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


class TokenIds:
    """`ids(text)`: the text's token ids as little-endian uint32 bytes, as the library's `encode(text, add_special_tokens=False)` gives them."""

    _loaded: dict[str, "TokenIds"] = {}

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = _Words(self.tokenizer)

    @classmethod
    def of(cls, path: str) -> "TokenIds":
        """One instance per Python worker and file."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def rest(self, keep: bool) -> None:
        """At the end of a task: unused memory goes, and the ids, too, if they are not to be kept; the worker lives on."""
        if not keep:
            self.words.forget()
        pa.default_memory_pool().release_unused()

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return _whole(self.tokenizer, text)
        first, *rest = text.split(" ")
        if rest and (not first or _EDGE(first[-1])):
            try:
                tail = b"".join(map(self.words.__getitem__, rest))
            except _Unsafe:
                return _whole(self.tokenizer, text)
            head = self.words.inner[first] if first.isascii() and first.isalpha() else _whole(self.tokenizer, first) if first else b""
            return head + tail
        return _whole(self.tokenizer, text)

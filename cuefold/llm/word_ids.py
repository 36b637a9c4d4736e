"""Identifiers of the word-level BPE vocabulary, as the tokenizers library gives them.

The vocabulary drops white space and no token crosses it, so a text's identifiers are those of its words,
end to end. Each distinct word is encoded by the library once; a bounded cache keeps the result as
little-endian 32-bit identifiers. Texts that hold a special string are encoded by the library as they are.
"""

from __future__ import annotations

import struct

import public_tokenizers
import regex

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Words that a worker keeps, of about 190 bytes each.
CACHED = 700_000
LONGEST_CACHED = 48

_STOPS = frozenset(b".,")
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class WordEncoder:
    def __init__(self, vocabulary: str = VOCABULARY, cached: int = CACHED):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(public_tokenizers.path(vocabulary))
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        rest = [b for b in range(256) if b not in plain]
        self.spelling = {b: 256 + i for i, b in enumerate(rest)}
        self.words: dict[bytes, bytes] = {}
        self.cached = cached

    def _piece(self, piece: str) -> bytes:
        raw = piece.encode()
        known = self.words.get(raw)
        if known is None:
            tokens = self.model.tokenize(raw.decode("latin-1").translate(self.spelling))
            known = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
            self._keep(raw, known)
        return known

    def _keep(self, word: bytes, ids: bytes) -> None:
        if len(word) <= LONGEST_CACHED:
            if len(self.words) >= self.cached:
                self.words.clear()
            self.words[word] = ids

    def _word(self, word: bytes) -> bytes:
        if word[-1] in _STOPS and word[-2:-1].isalnum() and (core := self.words.get(word[:-1])):
            return core + self._piece(chr(word[-1]))
        text = word.decode("utf-8", "replace")
        if text.isascii() or max(text) <= "\xff":  # the library's normaliser only lowers the case of these
            pieces = _PIECES.findall(text.lower())
            if len(pieces) == 1:
                return self._piece(pieces[0])
            ids = b"".join(map(self._piece, pieces))
            if len(pieces) == 2 and word[-1] in _STOPS:
                return ids  # its parts are kept
        else:
            ids = self._whole(text)
        self._keep(word, ids)
        return ids

    def _whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: bytes | None) -> bytes:
        """The identifiers of a whole text in UTF-8."""
        if not text:
            return b""
        if b"<|" in text:
            return self._whole(text.decode("utf-8", "replace"))
        known, one = self.words.get, self._word
        return b"".join([known(w) or one(w) for w in text.lower().split()])


_encoders: dict[tuple[str, int], WordEncoder] = {}


def encoder(vocabulary: str = VOCABULARY, cached: int = CACHED) -> WordEncoder:
    """This worker's encoder; later tasks find its cache filled."""
    key = vocabulary, cached
    if key not in _encoders:
        _encoders[key] = WordEncoder(vocabulary, cached)
    return _encoders[key]

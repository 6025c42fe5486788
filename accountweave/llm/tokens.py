"""Byte-level BPE through the tokenizers library, with a bounded memory of segments that were encoded before."""

from __future__ import annotations

import os
import re
import struct
from functools import cache

SPECIAL = "<|endoftext|>"
#: Segments that one worker remembers; beyond that it starts afresh. Only speed depends on it.
MEMORY = 300_000
_BEFORE_WORD = re.compile(r" (?=\S)")
_ODD_SPACE = re.compile(r" (?:\s|\Z)")
_LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"
#: A word, its points, perhaps a line end and the next line's first word: pieces that the pattern keeps apart.
_PLAIN = re.compile(rf"( ?{_LETTERS})([.,;:!?]*)(?:(\n)({_LETTERS})([.,;:!?]*))?").fullmatch


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next free one."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTER_OF = _byte_letters()


_SPACE_LETTER = _LETTER_OF[ord(" ")]
_POINTS = ".,;:!?"


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class SegmentEncoder:
    """Ids of whole texts, as the library gives them.

    The pre-tokenizer never lets a token reach over the point before a space that a non-space follows, so the text
    between two such points can be encoded by itself, and a segment seen before needs no second encoding. Texts with
    the special token go to the library whole.
    """

    def __init__(self, path: str, memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.memory = memory
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        #: Whether ids need more than 16 bits.
        self.wide = self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16
        self.known: dict[str, bytes] = {}  # segments after a space
        self.first: dict[str, bytes] = {}  # segments that open a text

    def _encode(self, text: str) -> bytes:
        """By the library; plain words piece by piece, so that a word is encoded once whatever points follow it."""
        plain = _PLAIN(text)
        if plain and any(plain.groups()[1:]):
            return b"".join([self._piece(p) for p in plain.groups() if p])
        if plain:
            ids = [t.id for t in self.model.tokenize(text.encode().decode("latin-1").translate(_LETTER_OF))]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str, memory: dict[str, bytes]) -> bytes:
        """Ids of a segment that is not remembered: after a space if ``memory`` is ``known``, else at the start.

        ASCII letters stand for themselves in the vocabulary and are one piece, which the model takes as it is; points
        behind them are a piece of their own. All else goes through the pattern.
        """
        if word.isascii():
            if word.isalpha():
                ids = [t.id for t in self.model.tokenize(_SPACE_LETTER + word if memory is self.known else word)]
                return struct.pack(f"<{len(ids)}I", *ids)
            letters = word.rstrip(_POINTS)
            if letters.isalpha() and len(letters) < len(word):
                ids = memory.get(letters)
                if ids is None:
                    ids = self._word(letters, memory)
                    if len(letters) < 64:
                        memory[letters] = ids
                return ids + self._piece(word[len(letters) :])
        return self._encode(" " + word if memory is self.known else word)

    def _piece(self, piece: str) -> bytes:
        memory, word = (self.known, piece[1:]) if piece[0] == " " else (self.first, piece)
        ids = memory.get(word)
        if ids is None:
            ids = self._word(word, memory) if piece.strip() and piece[-1].isalpha() else self._whole(piece)
            if len(word) < 64:
                memory[word] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if SPECIAL in text:
            return self._encode(text)
        parts = _BEFORE_WORD.split(text) if _ODD_SPACE.search(text) else text.split(" ")
        known, first = self.known, self.first
        if len(known) + len(first) > self.memory:
            known.clear()
            first.clear()
        out = [first.get(parts[0]), *map(known.get, parts[1:])]
        if None in out:
            for i, ids in enumerate(out):
                if ids is None:
                    memory, word = (known, parts[i]) if i else (first, parts[i])
                    ids = memory.get(word)
                    if ids is None:
                        ids = self._word(word, memory)
                        if len(word) < 64:
                            memory[word] = ids
                    out[i] = ids
        return b"".join(out)


@cache
def encoder(path: str, memory: int = MEMORY) -> SegmentEncoder:
    """One for each worker process."""
    return SegmentEncoder(path, memory)


@cache
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id, in order of ids."""
    tokenizer = encoder(path).tokenizer
    shown = {letter: b for b, letter in _LETTER_OF.items()}
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    table = []
    for i in range(size):
        token = tokenizer.id_to_token(i) or ""
        table.append(token.encode() if token == SPECIAL else bytes(shown[c] for c in token))
    return table

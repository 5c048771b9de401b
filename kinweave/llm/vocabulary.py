"""Token ids of texts with a public byte-level BPE tokenizer, one library call per distinct word piece.

The tokenizer lower-cases, drops white space and merges only inside runs of letters, so a text's ids are the ids of its words in
order. A text of Latin letters is cut into the very runs that the tokenizer merges in, any other one into words. Pieces are looked up in a
bounded per-worker memory; only unknown ones are encoded.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable

import numpy as np

#: Pieces that one Python worker remembers; further ones are encoded again in every batch.
REMEMBERED = 700_000
#: Punctuation that may be cut off behind a letter or digit: the tokenizer separates it there anyway.
TAIL = b".,;:!?"
#: The tokenizer's own runs in lower-cased Latin-1, where no two characters compose.
LETTER, DIGIT = rb"a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", rb"0-9\xb2\xb3\xb9\xbc-\xbe"
RUN = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[" + LETTER + rb"]+|[" + DIGIT + rb"]|[^\s" + LETTER + DIGIT + rb"]+")
#: Control characters, blanks and the soft hyphen beyond ASCII.
OTHER = re.compile(rb"[\x80-\xa0\xad]")

_encoders: dict[tuple[str, str], "WordEncoder"] = {}


def byte_letters() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class Memory(dict):
    """Ids of pieces as bytes; an unknown piece is encoded when it is asked for."""

    def __init__(self, encode: Callable[[bytes], list[int]], width: str):
        super().__init__()
        self.encode, self.kind = encode, np.dtype(width).char

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.encode(piece)
        self[piece] = packed = struct.pack(f"<{len(ids)}{self.kind}", *ids)
        return packed


class WordEncoder:
    def __init__(self, path: str, width: str = "<u4"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.width = Tokenizer.from_file(path), width
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = byte_letters()
        self.words, self.runs = Memory(self._encode, width), Memory(self._encode_run, width)

    def _merged(self, raw: bytes) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(raw.decode("latin-1").translate(self.letters))]

    def _encode(self, piece: bytes) -> list[int]:
        word = piece.decode()
        # A word of Latin letters is one run of letters whatever the normaliser does, so the merges alone decide.
        if len(piece) < 64 and word.isalpha() and ord(max(word)) < 256:
            return self._merged(word.lower().encode())
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _encode_run(self, run: bytes) -> list[int]:
        if len(run) < 64:
            return self._merged(run if run.isascii() else run.decode("latin-1").encode())
        return self.tokenizer.encode(run.decode("latin-1"), add_special_tokens=False).ids

    def latin(self, text: str) -> bytes | None:
        """The lower-cased text in Latin-1 if ``RUN`` finds the tokenizer's own runs in it."""
        try:
            raw = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        if text.isascii():
            low = raw.lower()
        elif OTHER.search(raw):
            return None
        else:
            low = text.lower().encode("latin-1")
        return None if any(s in low for s in self.special) else low

    def pieces(self, text: str) -> list[bytes]:
        """The words of a text, cut before their closing punctuation where that changes no id."""
        raw = text.encode()
        if any(s in raw for s in self.special):
            return raw.split()
        # Lower case must not turn other text into a special string, which the tokenizer looks for before it lower-cases.
        low = raw.lower() if raw.isascii() else raw
        words = (raw if any(s in low for s in self.special) else low).split()
        out = []
        for w in words:
            if w[-1] in TAIL:
                core = w.rstrip(TAIL)
                if core and core[-1:].isalnum():
                    out.append(core)
                    out.append(w[len(core):])
                    continue
            out.append(w)
        return out

    def ids_of(self, text: str | None) -> bytes:
        """The ids of a text, ``width`` wide each."""
        if not text:
            return b""
        low = self.latin(text)
        if low is not None:
            return b"".join(map(self.runs.__getitem__, RUN.findall(low)))
        return b"".join(map(self.words.__getitem__, self.pieces(text)))

    def encode_each(self, texts: list[str | None]) -> list[bytes]:
        """The ids of every text."""
        out = []
        for text in texts:
            out.append(self.ids_of(text))
            if len(self.words) + len(self.runs) > REMEMBERED:
                self.words.clear()
                self.runs.clear()
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        found = self.encode_each(texts)
        return np.frombuffer(b"".join(found), self.width), np.array([len(f) for f in found], np.int64) // np.dtype(self.width).itemsize


def encoder(path: str, width: str = "<u4") -> WordEncoder:
    """One encoder per Python worker, file and width; it stays between tasks."""
    if (path, width) not in _encoders:
        _encoders[path, width] = WordEncoder(path, width)
    return _encoders[path, width]

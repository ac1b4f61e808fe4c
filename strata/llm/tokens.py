"""Token ids of whole texts by a public word BPE, fast enough for a corpus.

The tokenizer's normaliser and splitter never look across white space, and work on each
run of letters, each digit and each run of other marks by itself. So ids are looked up
per chunk between spaces and, for a new chunk, per such piece, in bounded caches that the
tokenizer's own model fills. That holds for texts of Latin letters and common marks,
where normal form, lower case and white space are the same to both; any other text goes
to the tokenizer whole. ``tests/llm`` holds both ways against the tokenizer.
"""

from __future__ import annotations

import unicodedata

import numpy as np

#: Code points of texts that are looked up by chunks: up to Latin Extended-A but for the
#: dotted capital I, whose lower case is two code points, and the four separators that
#: only Python takes for spaces; and General Punctuation's marks.
_RANGES = ((0, 0x1B), (0x20, 0x12F), (0x131, 0x17F), (0x2010, 0x2027), (0x2030, 0x205E))
_CACHE = 400_000


def _class(kind: str) -> str:
    chars = (chr(c) for a, b in _RANGES for c in range(a, b + 1))
    return "".join(f"\\U{ord(c):08x}" for c in chars if unicodedata.category(c)[0] == kind)


def _byte_chars() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class _Chunks(dict):
    """Chunk between spaces -> little-endian 32-bit ids of its pieces.

    When full, it becomes the older generation, from which chunks in use come back.
    """

    def __init__(self, model, find):
        super().__init__()
        self.model, self.find, self.chars, self.old = model, find, _byte_chars(), {}
        self.ids = [i.to_bytes(4, "little") for i in range(1 << 16)]

    def __missing__(self, chunk: str) -> bytes:
        ids = self.old.get(chunk)
        if ids is None:
            if chunk.isalpha():
                pieces = [chunk]
            elif chunk[:-1].isalpha():
                pieces = [chunk[:-1], chunk[-1]]
            else:
                pieces = self.find(chunk)
            if len(pieces) > 1:
                ids = b"".join([self[p] for p in pieces])
            else:
                if not chunk.isascii() or not chunk.isalpha():
                    chars = self.chars
                    mapped = "".join([chars[b] for b in chunk.encode()])
                else:
                    mapped = chunk
                ids = b"".join([self.ids[t.id] for t in self.model.tokenize(mapped)])
        if len(self) >= _CACHE:
            self.old = dict(self)
            self.clear()
        self[chunk] = ids
        return ids


class Encoder:
    """``encode(text)``: the ids as bytes, four little-endian bytes each."""

    def __init__(self, path: str):
        import re

        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        letters, numbers = _class("L"), _class("N")
        find = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]"
                          f"|[^{letters}{numbers}]+").findall
        self.chunks = _Chunks(self.whole.model, find)
        allowed = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in _RANGES)
        self._odd = re.compile(f"[^{allowed}]").search

    def odd(self, text: str) -> bool:
        """Whether the text must go to the tokenizer whole."""
        if "<|" in text:  # the tokenizer's own marks, should a text hold them
            return True
        if text.isascii():
            return any(c in text for c in "\x1c\x1d\x1e\x1f")
        return bool(self._odd(text))

    def encode(self, text: str) -> bytes:
        if self.odd(text):
            text = text.encode("utf-8", "replace").decode()  # lone surrogates have no ids
            return np.array(self.whole.encode(text, add_special_tokens=False).ids,
                            "<u4").tobytes()
        return b"".join(map(self.chunks.__getitem__, text.lower().split()))

"""Token ids from a public tokenizer file, with bounded caches of words."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

WORD_BPE = "word_bpe_49k.json"
#: letters and numbers among the plain characters below, lower-cased
_LETTERS, _NUMBERS = "a-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
#: how the word_bpe file cuts normalised text (a fixed value of the file), for plain characters
_UNIT = re.compile(f"[{_LETTERS}]+|[{_NUMBERS}]|'(?:s|t|re|ve|m|ll|d)|[^{_LETTERS}{_NUMBERS}\\s]+")
#: characters up to Latin Extended-B whose lower case is one such character too (that of Ɓ, for one, is not)
_LATIN = "".join(c for c in map(chr, range(0xA1, 0x250)) if len(c.lower()) == 1 and c.lower() <= "ɏ")
#: ASCII white space and printable characters, and those: composed already, and lower-cased one by one
_PLAIN = re.compile(f"[\t-\r -~{_LATIN}]*")
#: how each string of a special token begins
_SPECIAL = "<|"
#: the character that stands for each byte in the vocabulary: itself if it can be seen, else one from U+0100 on
_SEEN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_SHOWN = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_SEEN)))}


def tokenizer_path(name: str = WORD_BPE) -> str:
    """Where the named vocabulary file lies on this machine (it is installed, not copied)."""
    import public_tokenizers

    return public_tokenizers.path(name)


class _Units(dict):
    """The ids of units, found through the tokenizer's merges the first time."""

    def __init__(self, merges, size: int):
        self.merge = merges.tokenize
        self.bytes = [i.to_bytes(4, "little") for i in range(size)]

    def __missing__(self, unit: str) -> bytes:
        text = unit if unit.isascii() else unit.encode().decode("latin-1").translate(_SHOWN)
        known = self.bytes
        found = self[unit] = b"".join([known[t.id] for t in self.merge(text)])
        return found


class _Pieces(dict):
    """The ids of pieces between white space, cut into units the first time."""

    def __init__(self, units: _Units):
        self.unit = units.__getitem__

    def __missing__(self, piece: str) -> bytes:
        found = self[piece] = b"".join(map(self.unit, _UNIT.findall(piece)))
        return found


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids of ``word_bpe_49k``, unit by unit.

    A text of plain Latin characters is cut at white space, and a new piece into
    the tokenizer's own units here; ids come from caches of about ``limit``
    pieces and units, a new unit's from the tokenizer's merges. Any other text is left to the tokenizer whole,
    also one that may hold a special token's string: ids are those of the
    library's ``encode(text, add_special_tokens=False)``.
    """

    def __init__(self, path: str | None = None, limit: int = 400_000):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path or tokenizer_path())
        self.limit = limit
        self.cache = _Units(self.whole.model, self.whole.get_vocab_size())
        self.pieces = _Pieces(self.cache)

    def encode(self, texts) -> list[bytes]:
        """The ids of each text; a null text counts as empty."""
        for cache in (self.cache, self.pieces):
            if len(cache) > self.limit:
                cache.clear()
        ids = self.pieces.__getitem__
        return [b"".join(map(ids, t.lower().split())) if t and _SPECIAL not in t and _PLAIN.fullmatch(t) else self._whole(t) for t in texts]

    def _whole(self, text: str | None) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes() if text else b""


@lru_cache(maxsize=2)
def encoder(path: str | None = None) -> WordEncoder:
    """One encoder for each file in a worker."""
    return WordEncoder(path)

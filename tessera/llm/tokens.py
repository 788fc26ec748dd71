"""Tokens of the public tokenizer files, exactly as their library gives them, through a word cache.

The pre-tokenizers used here never join characters across certain places
(white space), so the tokens of a text are those of the pieces between these
places. A bounded cache per worker process holds the tokens of pieces already
seen; the library encodes each new one. Texts in which that is not plainly so
(special strings, characters from U+0130 on, rare separators) are passed to the
library whole.
"""

from __future__ import annotations

import base64
import os
import re

import numpy as np

#: Entries of one generation of the piece cache; two generations are held (about 100 MB).
CACHE = 250_000
_RARE = re.compile("[\x1c-\x1f\x85\xa0İ-\U0010ffff]|<\\|")
_SPLIT = re.compile("(?<=[^\t-\r ])(?= [^\t-\r ])")
_LOADED: dict = {}


def library(path: str):
    """The tokenizers model of a file, loaded once in each process."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


class _Cache(dict):
    """Piece -> value; the older generation goes when the younger one is full."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.old = encode, {}

    def __missing__(self, piece):
        value = self.old.get(piece)
        if value is None:
            value = self.encode(piece)
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        self[piece] = value
        return value


class WordCounter:
    """Token counts of a lower-casing word tokenizer that drops white space."""

    def __init__(self, path: str):
        lib = self.lib = library(path)
        self.cache = _Cache(lambda w: len(lib.encode(w, add_special_tokens=False).ids))

    def count(self, text: str) -> int:
        if _RARE.search(text):
            return len(self.lib.encode(text, add_special_tokens=False).ids)
        return sum(map(self.cache.__getitem__, text.lower().split()))


class ByteIds:
    """Ids of a byte-level tokenizer, as bytes of little-endian unsigned 32-bit numbers.

    ``ranks``: the file of the same vocabulary for the second library, which
    encodes single pieces faster; without it the first library does.
    """

    def __init__(self, path: str, ranks: str | None = None):
        lib = self.lib = library(path)
        if ranks:
            import public_tokenizers
            import tiktoken
            with open(ranks, "rb") as f:
                merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            one = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges,
                                    special_tokens={}).encode_ordinary
        else:
            def one(piece):
                return lib.encode(piece, add_special_tokens=False).ids
        self.cache = _Cache(lambda piece: np.array(one(piece), "<u4").tobytes())

    def ids(self, text: str) -> bytes:
        if _RARE.search(text):
            return np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        # a piece starts at each single space between two other characters
        if ("  " in text or "\n " in text or " \n" in text or text[:1] == " " or text[-1:] == " "
                or "\t" in text or "\r" in text or "\x0b" in text or "\x0c" in text):
            return b"".join(map(self.cache.__getitem__, _SPLIT.split(text)))
        head, *rest = text.split(" ")
        get = self.cache.__getitem__
        return get(head) + b"".join([get(" " + w) for w in rest])


def shared(kind, *args):
    """One instance for each process and file: worker processes serve many tasks."""
    key = (kind.__name__, *args)
    if key not in _LOADED:
        _LOADED[key] = kind(*args)
    return _LOADED[key]

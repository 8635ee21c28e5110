"""Byte-level BPE of whole texts, word by word.

A text is cut into words before every blank that a non-space character
follows.  The vocabulary's splitting pattern never takes a piece across such
a cut, so the ids of a text are the ids of its words one after the other.
Added tokens (``<|endoftext|>``) are cut out first, as the library does.
"""

from __future__ import annotations

import functools
import os
import re
from array import array

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256
_CUT = re.compile(r" (?=\S)")
_ODD = (" \n", " \t", " \r", " \x0b", " \x0c", " \x1c", " \x1d", " \x1e", " \x1f")
_UNICODE_SPACE = re.compile(r" (?=[^\S\x00-\x7f])")


def words_of(text: str) -> list[str]:
    """Words of a text without added tokens; each but the first stands for itself after a blank."""
    parts = text.split(" ")
    if "" in parts or any(x in text for x in _ODD) or not text.isascii() and _UNICODE_SPACE.search(text):
        parts = _CUT.split(text)
    return parts


def keys_of(text: str) -> list[str]:
    """The dictionary words of a text, in order.  A word stands for itself after a
    blank, a blank and a word for the word without one (only a segment begins
    so), and the added token, by its name, for itself."""
    if SPECIAL not in text:
        keys = words_of(text)
        if keys[0]:
            keys[0] = " " + keys[0]
            return keys
        return keys[1:]
    out: list[str] = []
    for i, segment in enumerate(text.split(SPECIAL)):
        if i:
            out.append(SPECIAL)
        out += keys_of(segment)
    return out


class WordEncoder:
    """Encodes single words; the added token only when it is the whole word."""

    def __init__(self, vocabulary: str, ranks: str):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(vocabulary)
        self.exact.no_truncation()
        self.exact.no_padding()
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                      special_tokens={})._core_bpe.encode_ordinary

    def __call__(self, key: str) -> bytes:
        """Ids of a dictionary word as little-endian unsigned 32-bit integers.

        Latin text goes through the rank file; other scripts, where two
        libraries' character tables may differ, through the tokenizer itself.
        """
        word = key[1:] if key[0] == " " else " " + key
        if key == SPECIAL:
            ids = [SPECIAL_ID]
        elif word.isascii() or max(word) < "\u0250" and "\x85" not in word and "\xa0" not in word:
            ids = self.fast(word)
        else:
            ids = self.exact.encode(word, add_special_tokens=False).ids
        return array("I", ids).tobytes()


@functools.cache
def word_encoder(vocabulary: str, ranks: str) -> WordEncoder:
    """One encoder for each worker process, as reading the files takes a second."""
    return WordEncoder(vocabulary, ranks)


class IdCache(dict):
    """Dictionary word to id bytes; two generations of ``limit`` words of at most ``longest`` characters.
    In scripts without blanks a word may be a whole text: longer ones are encoded each time."""

    def __init__(self, encode, limit: int = 100_000, longest: int = 64):
        super().__init__()
        self.encode, self.limit, self.longest, self.old = encode, limit, longest, {}

    def __missing__(self, key: str) -> bytes:
        if len(key) > self.longest:
            return self.encode(key)
        ids = self.old.get(key)
        if ids is None:
            ids = self.encode(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = ids
        return ids


class TextEncoder:
    """Whole texts to id bytes, with a bounded word cache."""

    def __init__(self, vocabulary: str, ranks: str):
        self.cache = IdCache(word_encoder(vocabulary, ranks))

    def __call__(self, text: str) -> bytes:
        return b"".join(map(self.cache.__getitem__, keys_of(text)))


@functools.cache
def pieces_of(vocabulary: str) -> list[bytes]:
    """The bytes of each id.  Vocabulary files write every byte as a printable
    character: itself where it is one, else those from 256 on in turn."""
    import json

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    with open(vocabulary, encoding="utf-8") as f:
        spec = json.load(f)
    ids = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
    out = [b""] * (max(ids.values()) + 1)
    for piece, i in ids.items():
        out[i] = bytes(byte[c] for c in piece)
    return out


def vocabulary_paths() -> tuple[str, str]:
    """The public vocabulary as a tokenizer file and as a rank file, where this Python has them."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")

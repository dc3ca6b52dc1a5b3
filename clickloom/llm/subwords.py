"""Subword ids of whole texts by a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import re
from array import array
from functools import cache

# A single space between two characters that are no white space always starts a new
# piece of the vocabulary's own pre-tokenizer, so such texts may be cut there.
_UNSAFE = re.compile(r"\s \s|  | \Z")
CACHED_WORDS = 150_000
# Fixed value: the token that the vocabulary's file adds to its ranks, found in any text.
ADDED = "<|endoftext|>"


class Subwords:
    """Encodes texts to little-endian unsigned 32-bit ids; remembers a bounded number of words."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(t): int(i) for t, i in (line.split() for line in lines)}
        self._encode = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self._added = array("I", [len(ranks)]).tobytes()
        self.tokens = {i: t for t, i in ranks.items()}
        self._known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        if ADDED in text:
            return self._added.join(self.encode(part) if part else b"" for part in text.split(ADDED))
        if _UNSAFE.search(text):
            return array("I", self._encode(text)).tobytes()
        first, *words = text.split(" ")
        known, out = self._known, [array("I", self._encode(first)).tobytes()]
        for word in words:
            ids = known.get(word)
            if ids is None:
                ids = array("I", self._encode(" " + word)).tobytes()
                if len(word) < 64:
                    if len(known) >= CACHED_WORDS:
                        known.clear()
                    known[word] = ids
            out.append(ids)
        return b"".join(out)


@cache
def subwords(name: str = "byte_bpe_50k") -> Subwords:
    """The vocabulary of that name; loaded once in each Python worker."""
    import public_tokenizers

    return Subwords(public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN)

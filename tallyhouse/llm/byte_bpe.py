"""Ids of a byte-level BPE whose file lies on every machine, a text at a time.

The file is one of the `tokenizers` library. Its vocabulary numbers tokens in the order of their merges, which is
what `tiktoken` needs to give the same ids several times faster.
"""

from __future__ import annotations

import json
import re

import numpy as np
import tiktoken

#: How the byte-level BPE cuts a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A run of white space (that of the pattern) which is too long to look ahead from its end one character at a time.
LONG_BLANK = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")


def byte_of_character() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as characters from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def vocabulary(path: str) -> dict[bytes, int]:
    """Ids of all tokens but the special ones."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    special = {t["content"] for t in found["added_tokens"] if t["special"]}
    byte = byte_of_character()
    return {bytes(byte[c] for c in token): k for token, k in found["model"]["vocab"].items() if token not in special}


class ByteBPE:
    """Ids as little-endian unsigned 32-bit integers; strings of special tokens are ordinary text."""

    def __init__(self, path: str):
        self.encoding = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=vocabulary(path), special_tokens={})

    def ids(self, text: str) -> bytes:
        """Ids of a whole text. The pattern looks ahead at the end of white space, which fails on very long runs; those go by hand.

        By the pattern, a run before other text is one piece without its last character, which begins the next piece, and a run
        at the end of the text is one piece; no piece begins before the run and goes on in it.
        """
        parts, at = [], 0
        for run in LONG_BLANK.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            parts += [self._plain(text[at : run.start()]), self._piece(text[run.start() : end])]
            at = end
        return b"".join([*parts, self._plain(text[at:])])

    def _plain(self, text: str) -> bytes:
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()

    def _piece(self, text: str) -> bytes:
        return np.array(self.encoding._core_bpe.encode_single_piece(text.encode()), dtype="<u4").tobytes()


_loaded: dict[str, ByteBPE] = {}


def byte_bpe(path: str) -> ByteBPE:
    """The tokenizer of a file, loaded once by each Python worker."""
    if path not in _loaded:
        _loaded[path] = ByteBPE(path)
    return _loaded[path]

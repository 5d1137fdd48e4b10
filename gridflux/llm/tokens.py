"""Byte-level BPE ids of a public tokenizer file.

The vocabulary comes from a ``tokenizers`` JSON file whose path is a parameter
(it is read on the driver and broadcast, so executors need no file).  Ids are
those of ``Tokenizer.encode(text, add_special_tokens=False)``; ``tiktoken``
computes them from the same vocabulary, several times as fast, and
``tokenizers`` itself those of texts that hold a special string (which it takes
for its special id) or that the other refuses.  The tests hold both against
each other.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

DEFAULT_FILE = "byte_bpe_50k.json"


def default_path() -> str:
    return public_tokenizers.path(DEFAULT_FILE)


def _byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: bytes that
    print stand for themselves, the others for code points from 256 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and b not in (32, 0xAD) and not 0x7F <= b <= 0xA0]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    return letters


class Encoder:
    def __init__(self, blob: str):
        self.blob = blob
        letters = _byte_letters()
        spec = json.loads(blob)
        added = {x["content"] for x in spec.get("added_tokens", ())}
        ranks = {bytes(letters[c] for c in k): v for k, v in spec["model"]["vocab"].items() if k not in added}
        self._added = sorted(added)
        self._bpe = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._slow: Tokenizer | None = None

    def ids(self, text: str) -> np.ndarray:
        if any(special in text for special in self._added):
            return self.slow_ids(text)
        try:
            return np.array(self._bpe.encode_ordinary(text), np.uint32)
        except BaseException as e:  # a panic of the native library is no Exception
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return self.slow_ids(text)

    def slow_ids(self, text: str) -> np.ndarray:
        if self._slow is None:
            self._slow = Tokenizer.from_str(self.blob)
        return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def encoder(blob: str) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    return Encoder(blob)


def read_vocabulary(path: str | None = None) -> str:
    with open(path or default_path(), encoding="utf-8") as f:
        return f.read()

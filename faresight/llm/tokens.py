"""Token ids of whole texts by the ``tokenizers`` library, each distinct word encoded once.

The library spends its time per word, and words repeat.  Both tokenizers here
split a text into pieces before any merge, and no piece crosses the cuts made
below, so a text's ids are the ids of its parts in a row.  A worker keeps the
ids of the parts it has seen, up to ``MAX_PARTS``; then it starts anew.  Texts
with strings or characters on which a cut could matter go to the library whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Sequence
from itertools import islice

import numpy as np

#: Parts kept by a worker; bounds its memory, never a result.
MAX_PARTS = 1_200_000
#: Added tokens may hold a text together; the other characters are white space to some libraries only.
_WHOLE = re.compile("<\\||[\x1c-\x1f\x85\u180e\u0130]")
#: Letters and numbers up to U+024F, where no character combines with another.
_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
_BEYOND = re.compile("[^\x00-ɏ]")
#: Fixed split pattern of the byte-level tokenizer, for texts up to U+024F.
_BYTE_FINE = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\\s{_LETTER}{_NUMBER}]+|\\s+(?!\\S)|\\s+")
#: Coarser, for any text: a run without white space, with one space before it; of a run of white space all but the last go together.
_BYTE_COARSE = re.compile(r" ?\S+|\s+(?!\S)|\s")
#: Fixed split pattern of the lower-case word tokenizer, for texts up to U+024F.
_WORD_FINE = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTER}]+|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}]+")


def byte_parts(text: str) -> list[str]:
    """Parts of a text for the byte-level tokenizer."""
    return (_BYTE_COARSE if _BEYOND.search(text) else _BYTE_FINE).findall(text)


def word_parts(text: str) -> list[str]:
    """Parts of a text for the word tokenizer, which lower-cases and drops white space."""
    return text.split() if _BEYOND.search(text) else _WORD_FINE.findall(text.lower())


class Encoder:
    """Encodes texts to little-endian ids of ``dtype``."""

    def __init__(self, path: str, parts: Callable[[str], list[str]]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts = parts
        self.dtype = np.dtype(id_type(self.tokenizer.get_vocab_size()))
        self.known: dict[str, bytes] = {}
        self.mark_id, mark = max(self.tokenizer.get_added_tokens_decoder().items())
        self.mark = mark.content

    def _learn(self, parts: list[str]) -> None:
        """Encode new parts in one text, held apart by a special token that no part can contain."""
        joined = self.tokenizer.encode_batch_fast([self.mark.join(parts)], add_special_tokens=False)[0].ids
        ids = np.asarray(joined, dtype=self.dtype)
        size = self.dtype.itemsize
        ends = np.append(np.nonzero(ids == self.mark_id)[0], len(ids)) * size
        starts = np.concatenate(([0], ends[:-1] + size))
        raw = ids.tobytes()
        self.known.update(zip(parts, (raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), strict=True))

    def encode(self, text: str) -> bytes:
        """The ids of one whole text."""
        if _WHOLE.search(text):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()
        parts = self.parts(text)
        known = self.known
        try:
            return b"".join(map(known.__getitem__, parts))
        except KeyError:
            fresh = list(set(parts).difference(known))
            if len(known) + len(fresh) > MAX_PARTS:
                # what came first is what is frequent
                self.known = known = dict(islice(known.items(), MAX_PARTS // 2))
                fresh = list(set(parts).difference(known))
            for i in range(0, len(fresh), 20_000):
                self._learn(fresh[i:i + 20_000])
            return b"".join(map(known.__getitem__, parts))


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, parts: Callable[[str], list[str]]) -> Encoder:
    """This process's encoder for a tokenizer file."""
    key = (path, parts.__name__)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, parts)
    return _ENCODERS[key]


def id_type(vocabulary: int) -> str:
    """Smallest little-endian unsigned type that holds ids below ``vocabulary``."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def vocabulary_path(name: str) -> str:
    """Place of a public tokenizer file, by the installed package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def same(ids: Sequence[int], raw: bytes, dtype: np.dtype) -> bool:
    """Whether ``raw`` holds exactly ``ids``."""
    return np.frombuffer(raw, dtype=dtype).tolist() == list(ids)

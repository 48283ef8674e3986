"""Token ids by a public tokenizer file, with the ids of white-space-free chunks remembered.

The tokenizer drops white space and never joins across it, so a text's ids are those of its chunks
one after the other. Most chunks of a corpus repeat; the library sees each new one once per worker
until the memory is full and starts over, so it stays bounded. ``tests/llm`` compares the ids with
the library's on whole texts. Chunks of more than ``LONGEST`` characters are not remembered, so the
memory is bounded in bytes as well. Texts are split, and their ids put together, for all texts of a
call at once by Arrow; each distinct chunk of a call is looked up once.
"""

from __future__ import annotations

import gc
import os
import re
import sys
from array import array
from collections.abc import Sequence

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
#: Chunks that a worker remembers, and pieces of chunks.
REMEMBERED = 400_000
#: Characters of a chunk that is remembered.
LONGEST = 64

#: Printable ASCII and the letters of Latin-1: no normal form but case changes them.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
#: How the tokenizer's own pattern cuts plain lower-case chunks that hold no apostrophe.
_PIECES = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+|\n")
#: White space to Arrow, as to Python, but not to the tokenizer.
_SEPARATORS = r"[\x1c-\x1f]"
#: Stands between the ids of chunks; no id has these bytes, nor have two that touch, as ids are below 2^24.
_BETWEEN = b"\xff" * 4
#: Pieces that the library is given at a time, as words of one text.
PIECES_AT_A_TIME = 512


def _packed(encoding) -> bytes:
    ids = array("I", encoding.ids)
    if sys.byteorder == "big":
        ids.byteswap()
    return ids.tobytes()


class WordIds:
    """Ids as little-endian unsigned 32-bit integers, four bytes each."""

    def __init__(self, path: str = WORD_BPE, remembered: int = REMEMBERED):
        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.whole.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        suffix = getattr(self.whole.model, "end_of_word_suffix", None)
        vocabulary = self.whole.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a piece
        for token, i in vocabulary.items():
            self.last[i] = bool(suffix) and token.endswith(suffix)
        self.remembered = remembered
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _ids_of_pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces without white space, many given as one text; the last id of each ends it."""
        runs = [pieces[at:at + PIECES_AT_A_TIME] for at in range(0, len(pieces), PIECES_AT_A_TIME)]
        out = []
        for run, encoding in zip(runs, self.bare.encode_batch_fast([" ".join(r) for r in runs], add_special_tokens=False)):
            raw = _packed(encoding)
            ends = ((np.flatnonzero(self.last[np.frombuffer(raw, "<u4")]) + 1) * 4).tolist()
            if len(ends) == len(run) and ends[-1] == len(raw):
                out += [raw[start:end] for start, end in zip([0, *ends], ends)]
            else:  # a vocabulary that lacks a letter or marks no ends
                out += map(_packed, self.bare.encode_batch_fast(run, add_special_tokens=False))
        return out

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        plain, other = [], []
        for c in chunks:
            (plain if len(c) <= LONGEST and _PLAIN.fullmatch(c) and "'" not in c and "<|" not in c else other).append(c)
        cut = _PIECES.findall("\n".join(plain).lower())
        distinct = set(cut) - {"\n"}
        new = [p for p in distinct if p not in self.pieces]
        if len(self.pieces) + len(new) > self.remembered:
            self.pieces.clear()
            new = list(distinct)
        self.pieces.update(zip(new, self._ids_of_pieces(new)))
        self.pieces["\n"] = _BETWEEN
        learnt = dict(zip(plain, b"".join(map(self.pieces.__getitem__, cut)).split(_BETWEEN)))
        learnt.update(zip(other, map(_packed, self.whole.encode_batch_fast(other, add_special_tokens=False))))
        if len(self.chunks) + len(learnt) > self.remembered:
            self.chunks.clear()
        self.chunks.update((c, ids) for c, ids in learnt.items() if len(c) <= LONGEST)
        return learnt

    def __call__(self, texts: Sequence[str] | pa.Array) -> list[bytes]:
        """The ids of every text."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(texts, _SEPARATORS)
        split = pc.utf8_split_whitespace(pc.if_else(odd, "", texts))
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.chunks.get, distinct))
        missing = [w for w, b in zip(distinct, ids) if b is None]
        if missing:
            learnt = self._learn(missing)
            ids = [learnt[w] if b is None else b for w, b in zip(distinct, ids)]
        ends = np.cumsum(np.concatenate(([0], pc.list_value_length(split).to_numpy())), dtype=np.int64)
        taken = pa.array(ids, pa.large_binary()).take(words.indices)
        out = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends), taken), pa.scalar(b"", pa.large_binary())).to_pylist()
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            out[i] = _packed(self.whole.encode(texts[i].as_py(), add_special_tokens=False))
        return out


_OWN: dict[tuple[str, int], WordIds] = {}


def word_ids(path: str = WORD_BPE, remembered: int = REMEMBERED) -> WordIds:
    """This worker's tokenizer of a file, kept from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    gc.set_threshold(200_000, 50, 100)  # fewer walks over what is remembered
    if (path, remembered) not in _OWN:
        _OWN[path, remembered] = WordIds(path, remembered)
    return _OWN[path, remembered]

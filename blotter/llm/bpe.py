"""Byte-level BPE: texts to ids by a queue of merges, and ids back to text.

A text is cut at its special tokens, then into words by the usual pattern of byte-level
vocabularies. The symbols of a word, one per byte at first, form a doubly linked list. A priority
queue holds every neighbouring pair that has a merge, least rank first and then leftmost. The
pair that comes out is joined: the left symbol becomes the new one, the right one leaves the
list, and the pairs with the new neighbours are queued. Entries whose symbols have changed
since are stale and skipped. Each word costs O(n log n), however long it is.

Decoding joins the byte strings of the ids and reads the bytes as UTF-8.

Texts are independent rows, so nothing is shuffled. Null text is as empty text: no ids. Null ids
give null, no ids the empty text. Bytes that are no UTF-8 become U+FFFD on the way in and on the way out.
Other columns are not looked at; repeated rows give the same ids each, an empty table none.
"""

from __future__ import annotations

import json
import re
import string
from array import array
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how byte-level vocabularies cut a text into words.
WORD = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: A word begins at every blank before something else, whatever stands before the blank, so the
#: stretches from one such blank to the next can be encoded apart.
SEAM = re.compile(r" (?=\S)")
#: Marks that never begin a word of letters; an apostrophe may.
MARKS = string.punctuation.replace("'", "")
#: Code points that are cut at a time.
STRIDE = 1 << 20
#: Stretches and words remembered by a task, and the longest of them.
KNOWN, KNOWN_LENGTH = 1 << 19, 64


def encode(text: Column, vocabulary: str) -> Column:
    """The ids of a text, array<int>. ``vocabulary`` is a file that all executors have."""

    @F.arrow_udf("array<int>")
    def ids(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = Bpe(vocabulary)
        for batch in texts:
            found = [bpe.packed_ids(text.as_py() or b"") for text in batch]
            ends = np.cumsum([0] + [len(f) // 4 for f in found], dtype=np.int32)
            values = np.frombuffer(b"".join(found), dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(values))

    return ids(text.cast("binary"))


def decode(ids: Column, vocabulary: str) -> Column:
    """The text that ids stand for; ids that the vocabulary lacks stand for nothing."""

    @F.arrow_udf("string")
    def text(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = Bpe(vocabulary)
        for batch in lists:
            values = batch.values.fill_null(-1).to_numpy(zero_copy_only=False)
            ends = batch.offsets.to_numpy()
            found = [bpe.decode(values[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            yield pc.if_else(batch.is_null(), None, pa.array(found, pa.string()))

    return text(ids)


class Bpe:
    """One vocabulary file: byte-level BPE in the JSON form of the tokenizers library."""

    def __init__(self, vocabulary: str) -> None:
        with open(vocabulary, encoding="utf-8") as file:
            said = json.load(file)
        _check(said)
        alphabet = byte_letters()
        byte_of = {letter: byte for byte, letter in enumerate(alphabet)}
        vocab = said["model"]["vocab"]
        self.first = [vocab[letter] for letter in alphabet]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in said["model"]["merges"]]
        #: What the two symbols of a merge become, by rank.
        self.become = [vocab[left + right] for left, right in pairs]
        #: By left symbol, then right symbol, the rank of their merge; the same for two bytes.
        self.rank: list[dict[int, int]] = [{}] * (1 + max(vocab.values()))
        for rank, (left, right) in enumerate(pairs):
            row = self.rank[vocab[left]] or {}
            row[vocab[right]] = rank
            self.rank[vocab[left]] = row
        self.first_rank = [list(map(self.rank[left].get, self.first)) for left in self.first]
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes([byte_of[letter] for letter in token])
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        # Of special tokens that begin at one place the longest is meant.
        names = sorted(filter(None, self.special), key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.words = _Known(lambda word: _packed(self.merged(word.encode())))
        self.opening = _Known(self._stretch)
        self.following = _Known(lambda rest: self._stretch(" " + rest))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed_ids(text.encode()), dtype=np.int32).tolist()

    def packed_ids(self, text: bytes) -> bytes:
        """Ids of four bytes each."""
        found = []
        for part in self._parts(text.decode(errors="replace")):
            if part in self.special:
                found.append(_packed([self.special[part]]))
            else:
                first, *rest = SEAM.split(part)
                found.append(self.opening[first])
                found += map(self.following.__getitem__, rest)
        return b"".join(found)

    def decode(self, ids: np.ndarray) -> str:
        known = ids[(ids >= 0) & (ids < len(self.bytes_of))]
        return b"".join(map(self.bytes_of.__getitem__, known.tolist())).decode(errors="replace")

    def merged(self, word: bytes) -> list[int]:
        """The ids of one word."""
        first, become, rank_of = self.first, self.become, self.rank
        symbols, size = [first[byte] for byte in word], len(word)
        # By place, the rank of the pair that begins there.
        ranks = [self.first_rank[left][right] for left, right in zip(word, word[1:])]
        # An entry is a rank and a place in one number, so less is sooner.
        bits = size.bit_length()
        queue = [rank << bits | place for place, rank in enumerate(ranks) if rank is not None]
        if not queue:
            return symbols
        heapify(queue)
        ranks.append(None)
        # Links to the neighbours.
        before, after = list(range(-1, size)), list(range(1, size + 1))
        mask = (1 << bits) - 1
        while queue:
            entry = heappop(queue)
            place, rank = entry & mask, entry >> bits
            if ranks[place] != rank:
                continue  # stale: one of the two has been joined to something else
            right = after[place]
            symbols[place] = new = become[rank]
            symbols[right] = ranks[right] = None
            after[place] = behind = after[right]
            before[behind] = place
            followers = rank_of[new]
            if followers and behind < size:
                rank = ranks[place] = followers.get(symbols[behind])
                if rank is not None:
                    heappush(queue, rank << bits | place)
            else:
                ranks[place] = None
            ahead = before[place]
            if ahead >= 0:
                rank = ranks[ahead] = rank_of[symbols[ahead]].get(new)
                if rank is not None:
                    heappush(queue, rank << bits | ahead)
        return [symbol for symbol in symbols if symbol is not None]

    def _stretch(self, text: str) -> bytes:
        if text.isascii():
            # A blank, letters, marks: a word of letters, and one of all marks that follow.
            core = text.rstrip(MARKS)
            if core[1:].isalpha() and (core[0] == " " or core[0].isalpha()):
                ids = self.words[core]
                return ids if len(core) == len(text) else ids + self.words[text[len(core) :]]
        return b"".join(map(self.words.__getitem__, WORD.findall(text)))

    def _parts(self, text: str) -> Iterator[str]:
        """Special tokens, and what is between them in parts of bounded length where there is a seam."""
        for piece in self.cut.split(text) if self.cut else [text]:
            start = 0
            while len(piece) - start > STRIDE and (seam := SEAM.search(piece, start + STRIDE)):
                yield piece[start : seam.start()]
                start = seam.start()
            yield piece[start:]


class _Known(dict):
    """Packed ids of short texts, worked out when first asked for; starts anew when it is full."""

    def __init__(self, ids: Callable[[str], bytes]) -> None:
        super().__init__()
        self.ids = ids

    def __missing__(self, text: str) -> bytes:
        ids = self.ids(text)
        if len(text) <= KNOWN_LENGTH:
            if len(self) >= KNOWN:
                self.clear()
            self[text] = ids
        return ids


def _packed(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if it prints in Latin-1, else one from U+0100 on."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printing]
    letters = {byte: chr(byte) for byte in printing}
    letters |= {byte: chr(0x100 + k) for k, byte in enumerate(others)}
    return [letters[byte] for byte in range(256)]


def _check(said: dict) -> None:
    """Files that ask for more than is done here are refused."""
    model, cut = said["model"], said["pre_tokenizer"] or {}
    asks = (
        model["type"] != "BPE" or cut.get("type") != "ByteLevel" or said["normalizer"],
        cut.get("add_prefix_space") or not cut.get("use_regex", True),
        any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")),
        any(model.get(k) for k in ("fuse_unk", "byte_fallback", "ignore_merges")),
        any(t[k] for t in said["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")),
    )
    if any(asks):
        raise ValueError("not a plain byte-level BPE vocabulary")

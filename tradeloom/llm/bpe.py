"""Byte-level BPE encoding and decoding with a given vocabulary, by an index of pair occurrences.

A task cuts its texts into pieces, and encodes the distinct pieces it has not met yet all together:
each adjacent pair of symbols is mapped to all the positions that have it, the ranks with positions are
applied in ascending order, and each merge updates the lists of the pairs to its left and right. A merge
can only make pairs of higher rank than its own (its product was learned before), so one ascending pass
gives what merging every piece by itself, lowest rank first and leftmost first, would give.

Nothing is shuffled. A task's memory is bounded by the block size and by ``KNOWN_PIECES``, the number of
pieces remembered between blocks. Null and empty texts have no ids; null ids decode to an empty text.
Other columns are kept; the added column replaces one of the same name.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Fixed value: how byte-level BPE cuts texts into pieces.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Bytes that are encoded and ids that are decoded at a time; workers keep for later tasks what they once took.
BLOCK_BYTES = 1_000_000
BLOCK_IDS = 250_000
KNOWN_PIECES = 150_000


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: itself if printable, else the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Ranks, products and bytes of tokens as arrays. Its size is that of the file, whatever the data."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, letters = content["model"], byte_letters()
        ids = model["vocab"]
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        self.size = 1 + max([*ids.values(), *(t["id"] for t in content["added_tokens"])])
        self.left, self.right, self.made = (np.array([ids[f(p)] for p in pairs], np.int64) for f in (lambda p: p[0], lambda p: p[1], lambda p: p[0] + p[1]))
        keys = self.left * self.size + self.right
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = ids[letter]
        texts = [b""] * self.size
        for token, i in ids.items():
            texts[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.added = {t["content"]: t["id"] for t in content["added_tokens"]}
        for token, i in self.added.items():
            texts[i] = token.encode()
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.lengths = np.array([len(x) for x in texts], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or -1."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.order[at], -1)

    @cached_property
    def special(self) -> re.Pattern | None:
        names = sorted(self.added, key=len, reverse=True)
        return re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None


def merge_pieces(pieces: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces, one after another, and the number of ids of each."""
    lengths = np.array([len(p) for p in pieces], np.int64)
    # A slot for every byte, and one of -1 before the first piece and after each.
    slots = np.full(lengths.sum() + len(pieces) + 1, -1, np.int64)
    filled = np.ones(len(slots), bool)
    filled[0] = False
    filled[np.cumsum(lengths + 1)] = False
    slots[filled] = vocab.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    after, before = np.arange(1, len(slots) + 1), np.arange(-1, len(slots) - 1)
    index: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def add(positions: np.ndarray) -> None:
        ranks = vocab.ranks(slots[positions], slots[after[positions]])
        known = ranks >= 0
        if not known.any():
            return
        ranks, positions = ranks[known], positions[known]
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for rank, part in zip(ranks[np.r_[0, cuts]].tolist(), np.split(positions, cuts) if len(cuts) else [positions], strict=True):
            if rank in index:
                index[rank].append(part)
            else:
                index[rank] = [part]
                heapq.heappush(active, rank)

    add(np.arange(len(slots) - 1))
    while active:
        rank = heapq.heappop(active)
        lists = index.pop(rank)
        at = lists[0] if len(lists) == 1 else np.concatenate(lists)
        left, right = vocab.left[rank], vocab.right[rank]
        at = at[(slots[at] == left) & (slots[after[at]] == right)]
        if len(lists) > 1 or left == right:
            at = np.unique(at)
        if left == right and len(at) > 1:
            # Of occurrences that overlap in a row, the first, third and so on merge.
            begins = np.r_[True, after[at[:-1]] != at[1:]]
            nth = np.arange(len(at)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]
            at = at[nth % 2 == 0]
        if not len(at):
            continue
        gone = after[at]
        slots[at], slots[gone] = vocab.made[rank], -2
        follow = after[gone]
        after[at], before[follow] = follow, at
        add(np.unique(np.concatenate([before[at], at])) if len(at) > 1 else np.array([before[at[0]], at[0]]))
    kept = slots >= 0
    piece = np.cumsum(slots == -1)[kept] - 1
    return slots[kept], np.bincount(piece, minlength=len(pieces))


class Encoder:
    """Encodes blocks of texts; remembers the pieces of earlier blocks, up to a bound."""

    def __init__(self, vocab: Vocabulary, pieces: str = PIECES):
        self.vocab, self.cut = vocab, regex.compile(pieces).findall
        self.forget()

    def forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.ids, self.lengths = np.empty(0, np.int32), np.empty(0, np.int64)

    def pieces(self, text: str) -> list[str]:
        if self.vocab.special is None or not self.vocab.special.search(text):
            return self.cut(text)
        # Odd parts are added tokens; they go by a key that no piece can have.
        parts = self.vocab.special.split(text)
        return [y for i, x in enumerate(parts) for y in (["\0added:" + x] if i % 2 else self.cut(x))]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        cut = [self.pieces(t) if t else [] for t in texts]
        if len(self.codes) > KNOWN_PIECES:
            self.forget()
        new = list({p for pieces in cut for p in pieces} - self.codes.keys())
        if new:
            plain = [p for p in new if not p.startswith("\0added:") or p[7:] not in self.vocab.added]
            added = [p for p in new if p.startswith("\0added:") and p[7:] in self.vocab.added]
            ids, lengths = merge_pieces([p.encode() for p in plain], self.vocab)
            self.codes.update(zip([*plain, *added], range(len(self.codes), len(self.codes) + len(new)), strict=True))
            self.ids = np.concatenate([self.ids, ids.astype(np.int32), np.array([self.vocab.added[p[7:]] for p in added], np.int32)])
            self.lengths = np.concatenate([self.lengths, lengths, np.ones(len(added), np.int64)])
        codes = np.fromiter((self.codes[p] for pieces in cut for p in pieces), np.int64)
        counts = self.lengths[codes]
        values = gather(self.ids, (np.cumsum(self.lengths) - self.lengths)[codes], counts)
        sums = np.r_[0, np.cumsum(counts)]
        ends = np.cumsum([len(pieces) for pieces in cut])
        return values, np.diff(sums[np.r_[0, ends]])


def gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """values[start:start + count] of each start, one after another."""
    shift = starts - (np.cumsum(counts) - counts)
    return values[np.repeat(shift, counts) + np.arange(counts.sum())]


def _slices(texts: pa.Array, limit: int) -> Iterator[pa.Array]:
    """Parts of a text column of at most ``limit`` bytes, or one text; of a column of lists, so many elements or one list."""
    lengths = pc.list_value_length(texts) if pa.types.is_list(texts.type) else pc.binary_length(texts)
    ends = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(texts):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield texts.slice(low, high - low)
        low = high


def encode(docs: DataFrame, vocab_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Each row with the token ids of its whole text; no special tokens are added."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocab_path))
    base = docs.drop(ids_col)
    schema = T.StructType([*base.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            low = 0
            for texts in _slices(batch.column(text_col), BLOCK_BYTES):
                values, counts = encoder.encode(texts.to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(values, pa.int32()))
                own = batch.slice(low, len(texts))
                low += len(texts)
                yield pa.RecordBatch.from_arrays([*own.columns, ids], [*own.schema.names, ids_col])

    return base.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocab_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Each row with the text of its ids; bytes that are no UTF-8 become U+FFFD, as is usual."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(vocab_path))
    base = encoded.drop(text_col)
    schema = T.StructType([*base.schema.fields, T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for batch in batches:
            start = 0
            for lists in _slices(batch.column(ids_col), BLOCK_IDS):
                values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.r_[0, np.cumsum(counts)]
                texts = []
                for low, high in zip(ends[:-1], ends[1:], strict=True):
                    ids = values[low:high]
                    texts.append(gather(vocab.bytes, vocab.offsets[ids], vocab.lengths[ids]).tobytes().decode("utf-8", "replace"))
                own = batch.slice(start, len(lists))
                start += len(lists)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(texts, pa.string())], [*own.schema.names, text_col])

    return base.mapInArrow(run, schema)

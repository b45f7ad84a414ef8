"""Encoding and decoding with a merge-type piece vocabulary, by a score-ordered agenda of adjacent symbols.

A text (a space put before it, spaces written as U+2581) is a row of symbols, at first its characters. The
agenda holds each adjacent pair whose joint text is a piece, the greatest score first, then the leftmost.
The first pair is merged, its neighbours enter the agenda anew, until the agenda is empty. What is left of
unknown characters becomes byte pieces, or the unknown id if the vocabulary has no bytes.

No pair is ever merged across two characters that stand side by side in no piece, so texts are cut there,
and each distinct segment is merged once. A task runs the agendas of all its new segments side by side in
numpy: a step takes the first pair of every segment. Segments of over ``LONG`` symbols have a heap each.
``compare`` holds the result against the sentencepiece library, Arrow batch by Arrow batch.

Nothing is shuffled. A task's memory is bounded by the block size and by ``KNOWN_SEGMENTS``, the number of
segments remembered between blocks; a single longer text makes a block of its own. Null and empty texts
have no ids; null ids decode to an empty text. Rows are independent, so ties and repeated rows need no
rule. Other columns are kept; the added column replaces one of the same name.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
BLOCK_BYTES = 1_000_000
BLOCK_IDS = 250_000
KNOWN_SEGMENTS = 200_000
LONG = 200
#: Offsets within a segment take this many bits of an agenda entry, so LONG must stay below 1 << OFFSET_BITS.
OFFSET_BITS = 8
NEVER = np.int64(1) << 62

# The types of a piece in a vocabulary file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Vocabulary:
    """Pieces, the pairs that make them, and characters as arrays. Its size is that of the file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, trainer = model.normalizer_spec, model.trainer_spec
        kinds = {p.type for p in model.pieces}
        if trainer.model_type != trainer.BPE:
            raise ValueError("only merge-type (BPE) vocabularies have an agenda of pairs")
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or trainer.treat_whitespace_as_suffix:
            raise ValueError("only vocabularies that leave texts unchanged but for spaces are supported")
        if kinds & {USER_DEFINED, UNUSED}:
            raise ValueError("vocabularies with user-defined or unused pieces are not supported")
        self.dummy = spec.add_dummy_prefix
        self.size = len(model.pieces)
        self.types = np.array([p.type for p in model.pieces], np.int8)
        self.unknown = int(np.flatnonzero(self.types == UNKNOWN)[0])
        pieces = [p.piece for p in model.pieces]
        normal = {pieces[i]: i for i in np.flatnonzero(self.types == NORMAL).tolist()}
        self.byte_ids = np.full(256, -1, np.int64)
        for i in np.flatnonzero(self.types == BYTE).tolist():
            self.byte_ids[int(pieces[i][3:-1], 16)] = i
        self.fallback = trainer.byte_fallback and bool((self.byte_ids >= 0).all())
        self._symbols(normal)
        self._pairs(normal, np.array([p.score for p in model.pieces], np.float64))
        self._surfaces(pieces, trainer.unk_surface)

    def _symbols(self, normal: dict[str, int]) -> None:
        """Numbers of characters: those of pieces, further ones for characters that only longer pieces have."""
        inner = sorted({c for p in normal if len(p) > 1 for c in p})
        more = [c for c in inner if c not in normal]
        self.of = {**normal, **{c: self.size + i for i, c in enumerate(more)}}
        self.alone = self.size + len(more)  # any other character: never merged
        self.char_of = np.full(0x110000, self.alone, np.int32)
        for text, i in self.of.items():
            if len(text) == 1:
                self.char_of[ord(text)] = i
        letters = "".join(re.escape(c) for c in inner if c != SPACE)
        # Segments begin at runs of spaces, as no piece has a space after anything else; other characters stand alone.
        joins = any(SPACE in p.lstrip(SPACE) for p in normal)
        body = f"[{letters}{SPACE if joins else ''}]+" if letters else "(?!)"
        self.cut = re.compile(f"{SPACE}*{body}|{SPACE}+|[\\s\\S]").findall

    def _pairs(self, normal: dict[str, int], scores: np.ndarray) -> None:
        """(left, right) -> piece and its place in descending order of scores, equal scores at one place."""
        left, right, made = [], [], []
        for text, i in normal.items():
            for k in range(1, len(text)):
                a, b = self.of.get(text[:k]), self.of.get(text[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(i)
        keys = np.array(left, np.int64) * (self.alone + 1) + np.array(right, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.made = keys[order], np.array(made, np.int64)[order]
        self.place = np.unique(-scores, return_inverse=True)[1][self.made].astype(np.int64)
        # A small hash table in front: where the keys of a slot begin.
        self.shift = np.uint64(64 - 20)
        slots = self._slot(self.keys)
        by_slot = np.argsort(slots, kind="stable")
        self.keys, self.made, self.place = self.keys[by_slot], self.made[by_slot], self.place[by_slot]
        counts = np.bincount(slots, minlength=1 << 20)
        self.first = np.cumsum(counts) - counts
        self.deepest = int(counts.max(initial=0))
        self.keys = np.r_[self.keys, np.full(self.deepest + 1, -1)]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _surfaces(self, pieces: list[str], unknown: str) -> None:
        texts = []
        for i, (text, kind) in enumerate(zip(pieces, self.types.tolist(), strict=True)):
            if kind == BYTE:
                texts.append(bytes([int(text[3:-1], 16)]))
            else:
                texts.append(b"" if kind == CONTROL else unknown.encode() if i == self.unknown else text.replace(SPACE, " ").encode())
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.chars = np.array([len(p) for p in pieces], np.int64)
        self.lengths = np.array([len(x) for x in texts], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.leads = np.array([t.startswith(SPACE) and k == NORMAL for t, k in zip(pieces, self.types.tolist(), strict=True)])

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The number of each pair that makes a piece, or -1."""
        keys = left * (self.alone + 1) + right
        at, found = self.first[self._slot(keys)], np.full(len(keys), -1, np.int64)
        for k in range(self.deepest):
            same = self.keys[at + k] == keys
            found[same] = (at + k)[same]
        return found

    def one(self, left: int, right: int) -> int:
        return int(self.find(np.array([left], np.int64), np.array([right], np.int64))[0])


def merge_long(symbols: list[int], vocab: Vocabulary) -> list[int]:
    """One segment by a heap of (place, offset, left, right): entries whose symbols have changed are passed over."""
    after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
    row = np.array(symbols, np.int64)
    pairs = vocab.find(row[:-1], row[1:])
    agenda = [(int(vocab.place[p]), i, symbols[i], symbols[i + 1], int(vocab.made[p])) for i, p in enumerate(pairs.tolist()) if p >= 0]
    heapq.heapify(agenda)
    known: dict[tuple[int, int], int] = {}

    def enter(i: int, j: int) -> None:
        pair = (symbols[i], symbols[j])
        if pair not in known:
            known[pair] = vocab.one(*pair)
        if (p := known[pair]) >= 0:
            heapq.heappush(agenda, (int(vocab.place[p]), i, *pair, int(vocab.made[p])))

    while agenda:
        _, i, left, right, made = heapq.heappop(agenda)
        j = after[i]
        if symbols[i] != left or j >= len(symbols) or symbols[j] != right:
            continue
        symbols[i], symbols[j] = made, -1
        after[i] = after[j]
        if after[j] < len(symbols):
            before[after[j]] = i
            enter(i, after[j])
        if before[i] >= 0:
            enter(before[i], i)
    return [s for s in symbols if s >= 0]


def merge_short(symbols: np.ndarray, lengths: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All segments side by side: the symbols that are left, and the number of each segment's.

    A slot's agenda entry is (place of its pair, offset) in one number, so the least entry of a segment is
    its pair of the greatest score and of these the leftmost. A slot merged away has no entry.
    """
    out = symbols.copy()
    starts = np.cumsum(lengths) - lengths
    # Slots link to the next and previous one alive; the last of a segment links to a slot at the very end.
    end = len(out)
    out = np.r_[out, vocab.alone]
    after, before = np.arange(1, end + 2), np.arange(-1, end)
    after[starts + lengths - 1] = end
    before[starts] = end
    offset = np.arange(end) - np.repeat(starts, lengths)
    made = np.full(end + 1, -1, np.int64)

    def entries(at: np.ndarray) -> np.ndarray:
        pair = vocab.find(out[at], out[after[at]])
        known = pair >= 0
        made[at] = np.where(known, vocab.made[pair], -1)
        return np.where(known, (vocab.place[pair] << OFFSET_BITS) | offset[at], NEVER)

    agenda = entries(np.arange(end))
    gone = np.zeros(end + 1, bool)
    # The segments still at work: their slots lie one after another in ``open_slots``.
    open_starts, open_lengths, open_slots = starts, lengths, np.arange(end)
    while len(open_starts):
        local = np.cumsum(open_lengths) - open_lengths
        first = np.minimum.reduceat(agenda[open_slots], local)
        busy = first < NEVER
        if not busy.all():
            open_slots = open_slots[np.repeat(busy, open_lengths)]
            open_starts, open_lengths, first = open_starts[busy], open_lengths[busy], first[busy]
            if not len(open_starts):
                break
        at = open_starts + (first & ((1 << OFFSET_BITS) - 1))
        dead = after[at]
        out[at] = made[at]
        gone[dead] = True
        agenda[dead] = NEVER
        follow = after[dead]
        after[at] = follow
        before[follow] = at
        agenda[at] = entries(at)
        left = before[at]
        left = left[left < end]
        agenda[left] = entries(left)
    kept = ~gone[:-1]
    sums = np.r_[0, np.cumsum(kept)]
    return out[:-1][kept], sums[starts + lengths] - sums[starts]


class Encoder:
    """Encodes blocks of texts; remembers the segments of earlier blocks, up to a bound."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.forget()

    def forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.ids, self.lengths = np.empty(0, np.int32), np.empty(0, np.int64)

    def segments(self, text: str | None) -> list[str]:
        if not text:
            return []
        return self.vocab.cut(((SPACE if self.vocab.dummy else "") + text).replace(" ", SPACE))

    def merge(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the segments, one after another, and the number of each."""
        vocab = self.vocab
        chars = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        lengths = np.array([len(s) for s in segments], np.int64)
        symbols = vocab.char_of[chars].astype(np.int64)
        long = np.repeat(lengths > LONG, lengths)
        short_ids, short_counts = merge_short(symbols[~long], lengths[lengths <= LONG], vocab)
        ends = np.cumsum(lengths)
        parts, counts = [], np.zeros(len(segments), np.int64)
        counts[lengths <= LONG] = short_counts
        if not long.any():
            values = short_ids
        else:
            whole = np.cumsum(short_counts)
            nth = -1
            for i, n in enumerate(lengths.tolist()):
                if n > LONG:
                    own = merge_long(symbols[ends[i] - n : ends[i]].tolist(), vocab)
                    parts.append(np.array(own, np.int64))
                    counts[i] = len(own)
                else:
                    nth += 1
                    parts.append(short_ids[whole[nth] - short_counts[nth] : whole[nth]])
            values = np.concatenate(parts)
        return self._without_unknown(values, counts, segments)

    def _without_unknown(self, values: np.ndarray, counts: np.ndarray, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece are written as bytes; they kept their places, so the text tells which they are."""
        vocab = self.vocab
        odd = np.flatnonzero(values >= vocab.size)
        if not len(odd):
            return values, counts
        if not vocab.fallback:
            values = values.copy()
            values[odd] = vocab.unknown
            return values, counts
        owner = np.repeat(np.arange(len(segments)), counts)
        out, low = [], 0
        counts = counts.copy()
        for s in np.unique(owner[odd]).tolist():
            first = int(np.searchsorted(owner, s))
            last = int(np.searchsorted(owner, s, "right"))
            out.append(values[low:first])
            low, at, own = last, 0, []
            for v in values[first:last].tolist():
                if v >= vocab.size:
                    own += vocab.byte_ids[list(segments[s][at].encode())].tolist()
                    at += 1
                else:
                    own.append(v)
                    at += int(vocab.chars[v])
            out.append(np.array(own, np.int64))
            counts[s] = len(own)
        return np.concatenate([*out, values[low:]]), counts

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        cut = [self.segments(t) for t in texts]
        if len(self.codes) > KNOWN_SEGMENTS:
            self.forget()
        codes = self.codes
        new = list({s for segments in cut for s in segments if s not in codes})
        if new:
            ids, lengths = self.merge(new)
            codes.update(zip(new, range(len(codes), len(codes) + len(new)), strict=True))
            self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
            self.lengths = np.concatenate([self.lengths, lengths])
        places = np.fromiter((codes[s] for segments in cut for s in segments), np.int64)
        counts = self.lengths[places]
        values = gather(self.ids, (np.cumsum(self.lengths) - self.lengths)[places], counts)
        ends = np.cumsum([len(segments) for segments in cut])
        sums = np.r_[0, np.cumsum(counts)]
        per_text = np.diff(sums[np.r_[0, ends]])
        return self._one_unknown(values, per_text) if not self.vocab.fallback else (values, per_text)

    def _one_unknown(self, values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Without byte pieces a run of unknown characters is one unknown id."""
        row = np.repeat(np.arange(len(counts)), counts)
        unknown = values == self.vocab.unknown
        again = np.r_[False, unknown[1:] & unknown[:-1] & (row[1:] == row[:-1])]
        return values[~again], np.bincount(row[~again], minlength=len(counts))


def gather(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """values[start:start + count] of each start, one after another."""
    shift = starts - (np.cumsum(counts) - counts)
    return values[np.repeat(shift, counts) + np.arange(counts.sum())]


def _text(ids: np.ndarray, vocab: Vocabulary) -> str:
    """The text of ids: one leading space of the first piece goes; bytes that are no UTF-8 become U+FFFD each."""
    control = np.flatnonzero(vocab.types[ids] == CONTROL)
    parts, begun = [], not vocab.dummy
    # Control pieces have no text, but end a run of bytes.
    for part in np.split(ids, control) if len(control) else [ids]:
        raw = gather(vocab.bytes, vocab.offsets[part], vocab.lengths[part]).tobytes()
        shown = part[vocab.types[part] != CONTROL]
        if len(shown) and not begun:
            begun, raw = True, raw[1:] if vocab.leads[shown[0]] else raw
        try:
            parts.append(raw.decode())
        except UnicodeDecodeError:
            parts.append(_repaired(raw))
    return "".join(parts)


def _repaired(raw: bytes) -> str:
    parts = []
    while raw:
        try:
            parts.append(raw.decode())
            break
        except UnicodeDecodeError as error:
            parts += [raw[: error.start].decode(), "�"]
            raw = raw[error.start + 1 :]
    return "".join(parts)


def _parts(column: pa.Array, size: Callable[[pa.Array], pa.Array], limit: int) -> Iterator[pa.Array]:
    """Parts of a column of at most ``limit`` in size, or one value."""
    ends = np.cumsum(size(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(column):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield column.slice(low, high - low)
        low = high


def encode(docs: DataFrame, vocab_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Each row with the piece ids of its whole text, without begin and end ids."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocab_path))
    base = docs.drop(ids_col)
    schema = T.StructType([*base.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            low = 0
            for texts in _parts(batch.column(text_col), pc.binary_length, BLOCK_BYTES):
                values, counts = encoder.encode(texts.to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(values, pa.int32()))
                own = batch.slice(low, len(texts))
                low += len(texts)
                yield pa.RecordBatch.from_arrays([*own.columns, ids], [*own.schema.names, ids_col])

    return base.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocab_path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Each row with the text of its ids. Ids that the vocabulary does not have are an error."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(vocab_path))
    base = encoded.drop(text_col)
    schema = T.StructType([*base.schema.fields, T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for batch in batches:
            low = 0
            for lists in _parts(batch.column(ids_col), pc.list_value_length, BLOCK_IDS):
                values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.r_[0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))]
                if len(values) and (values.min() < 0 or values.max() >= vocab.size):
                    raise ValueError(f"ids must be from 0 to {vocab.size - 1}")
                texts = [_text(values[start:end], vocab) for start, end in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                own = batch.slice(low, len(lists))
                low += len(lists)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(texts, pa.string())], [*own.schema.names, text_col])

    return base.mapInArrow(run, schema)


def compare(docs: DataFrame, vocab_path: str, text_col: str = "text") -> DataFrame:
    """The rows whose ids or decoded text differ from those of the sentencepiece library, with both; none is right.

    The library runs over the Arrow batches of the encoded rows, where the vocabulary file must be readable.
    """
    coded = decode(encode(docs, vocab_path, text_col, "_ids"), vocab_path, "_ids", "_decoded")
    fields = [*coded.schema.fields, T.StructField("_library_ids", T.ArrayType(T.IntegerType())), T.StructField("_library_decoded", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=vocab_path)
        for batch in batches:
            ids = library.encode([t or "" for t in batch.column(text_col).to_pylist()], num_threads=1)
            more = [pa.array(ids, pa.list_(pa.int32())), pa.array([library.decode(x) if x else "" for x in ids], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [f.name for f in fields])

    both = coded.mapInArrow(run, T.StructType(fields))
    return both.where((F.col("_ids") != F.col("_library_ids")) | (F.col("_decoded") != F.col("_library_decoded")))

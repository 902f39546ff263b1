"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece exactly one last token can end its encoding. The tables hold
that token per prefix, so an encoding is read backwards, bytes are appended exactly, and an
edit re-encodes only until the stored tokens agree again. Whether two tokens may stand side by
side is decided by undoing merges at their border; no merge loop runs over texts.
"""

from __future__ import annotations

import base64
import ctypes
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh

#: Pieces whose ids a worker remembers, in each of two generations.
MEMO = 120_000
#: Prefixes whose last token a worker remembers; starts anew when full.
PREFIXES = 150_000
#: Bytes of a piece from which prefixes are taken in order, not on demand.
LONG = 200
#: Token pairs whose verdict a worker remembers; starts anew when full.
PAIRS = 250_000
#: Bytes of text that one Arrow slice gathers at least before it is passed on.
SLICE = 2_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` vocabulary file (base64 token, rank per line), read on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def split_of(token: bytes, ranks: dict[bytes, int]) -> tuple[int, int] | None:
    """The two tokens whose merge makes ``token``, or None if merges of lower rank never reach it."""
    own, parts = ranks[token], [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        best = min(((ranks.get(a + b, own), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))), default=(own, 0))
        if best[0] >= own:
            return None
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return (ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else (own, own)


@dataclass
class Vocabulary:
    ranks: dict[bytes, int]
    tokens: list[bytes] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    merged: dict[tuple[int, int], int] = field(default_factory=dict)

    @classmethod
    def build(cls, ranks: dict[bytes, int]) -> Vocabulary:
        v = cls(ranks)
        size = max(ranks.values()) + 1
        v.tokens = [b""] * size
        v.left, v.right = list(range(size)), list(range(size))
        for token, rank in ranks.items():
            v.tokens[rank] = token
            if len(token) > 1:
                split = split_of(token, ranks)
                if split is None:
                    v.left[rank] = -1  # only ever a whole piece
                else:
                    v.left[rank], v.right[rank] = split
                    v.merged[split] = rank
        return v


class Encoder:
    """Encodes pieces; one per Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.longest = max(map(len, vocabulary.ranks))
        self.pairs: dict[int, bool] = {}
        self.prefixes: dict[bytes, int] = {}
        self.reach: dict[bytes, int] = {}  # longest token that ends with these three bytes
        for token in vocabulary.ranks:
            self.reach[token[-3:]] = max(len(token), self.reach.get(token[-3:], 2))

    def fits(self, a: int, b: int) -> bool:
        """Whether tokens a, b stay as they are when their bytes are encoded together.

        The last merge on either side of the border is undone, the later one first; a merge
        across the border that ranks before what was undone would have happened instead.
        """
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._fits(a, b)
        return known

    def _fits(self, a: int, b: int) -> bool:
        left, right, merged = self.v.left, self.v.right, self.v.merged
        bound = len(left)
        while True:
            across = merged.get((a, b))
            if across is not None and across < bound:
                return False
            whole_a, whole_b = right[a] == a, left[b] == b
            if whole_a and whole_b:
                return True
            if not whole_a and (a > b or whole_b):
                bound, a = a, right[a]
            else:  # the left one of two equal merges goes first
                bound, b = b + 1, left[b]

    def extend(self, data: bytes, last: list[int], upto: int) -> None:
        """Store the last token of each prefix of data[:upto] that ``last`` doesn't have yet."""
        known, left, fits, reach, pairs = self.v.ranks.get, self.v.left, self.fits, self.reach.get, self.pairs.get
        for end in range(len(last) + 1, upto + 1):
            for start in range(max(0, end - reach(data[max(0, end - 3) : end], 2)), end):
                t = known(data[start:end])
                if t is None or left[t] < 0:
                    continue
                if start:
                    before = last[start - 1]
                    fit = pairs(before << 32 | t)
                    if not (fits(before, t) if fit is None else fit):
                        continue
                last.append(t)
                break
            else:
                raise ValueError("the vocabulary lacks a byte")

    def read(self, last: list[int]) -> list[int]:
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.v.tokens[last[at - 1]])
        return out[::-1]

    def last(self, prefix: bytes) -> int:
        """The last token of a prefix, from those of the shorter prefixes that it needs."""
        known, left, reach, pairs = self.v.ranks.get, self.v.left, self.reach.get, self.pairs.get
        end = len(prefix)
        for start in range(max(0, end - reach(prefix[-3:], 2)), end):
            t = known(prefix[start:])
            if t is None or left[t] < 0:
                continue
            if start:
                head = prefix[:start]
                before = self.prefixes.get(head)
                if before is None:
                    before = self.prefixes[head] = self.last(head)
                fit = pairs(before << 32 | t)
                if not (self.fits(before, t) if fit is None else fit):
                    continue
            return t
        raise ValueError("the vocabulary lacks a byte")

    def encode(self, piece: bytes) -> list[int]:
        whole = self.v.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > LONG:
            table: list[int] = []
            self.extend(piece, table, len(piece))
            return self.read(table)
        if len(self.prefixes) >= PREFIXES:
            self.prefixes.clear()
        tokens, out = self.v.tokens, [self.last(piece)]
        at = len(piece) - len(tokens[out[0]])
        while at:
            t = self.prefixes[piece[:at]]
            out.append(t)
            at -= len(tokens[t])
        out.reverse()
        return out


class PrefixTable:
    """Bytes with the last token of each prefix: exact appends and re-encoding near edits."""

    def __init__(self, encoder: Encoder, data: bytes = b""):
        self.encoder, self.data, self.last = encoder, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.encoder.extend(self.data, self.last, len(self.data))

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in the place of bytes [start, end); returns how many prefixes were encoded anew.

        Once as many prefixes in a row as the longest token has bytes agree with the old ones,
        all later ones do, for each depends on no more than that.
        """
        tail, shift = self.last[end:], start + len(new)
        self.data = self.data[:start] + new + self.data[end:]
        del self.last[start:]
        agreed, i = 0, 0
        self.encoder.extend(self.data, self.last, shift)
        while i < len(tail) and agreed < self.encoder.longest:
            self.encoder.extend(self.data, self.last, shift + i + 1)
            agreed = agreed + 1 if self.last[-1] == tail[i] else 0
            i += 1
        self.last += tail[i:]
        return len(new) + i

    def ids(self) -> list[int]:
        return self.encoder.read(self.last)


class _Memo(dict):
    """Results by piece; when full, the older half goes, so that frequent pieces stay. Pieces over LONG characters aren't kept."""

    def __init__(self, make):
        self.make, self.old = make, {}

    def __missing__(self, piece):
        made = self.old.get(piece)
        if made is None:
            made = self.make(piece)
        if len(piece) > LONG:
            return made
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[piece] = made
        return made


#: Of this Python worker: the memo of the last vocabulary, which later tasks use on.
_KEPT: dict[str, _Memo] = {}


def _memo(key: str, vocabulary) -> _Memo:
    if key not in _KEPT:
        _KEPT.clear()
        encode = Encoder(vocabulary()).encode
        _KEPT[key] = _Memo(lambda piece: tuple(encode(piece.encode())))
    return _KEPT[key]


def release() -> None:
    """Give memory that this Python worker no longer uses back to the system: workers outlive their stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about SLICE bytes of ``column``; memory is released after each batch."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            gone = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, gone + SLICE)))
            yield batch.slice(at, upto - at)
            at = upto
        del batch
        release()


def encode_texts(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids`` array<int>: each match of ``pattern`` encoded by itself, no special tokens.

    Null text counts as empty and gives an empty array; other columns stay; a column named like
    ``ids``, whatever its case, is replaced. The vocabulary, of fixed size, is broadcast; texts never leave their row.
    """
    import regex

    regex.compile(pattern)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.build(ranks))
    key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    hold = fresh(docs, "ids")

    def run(batches):
        import regex

        memo = _memo(key, lambda: shared.value)
        pieces = regex.compile(pattern).findall
        for batch in slices(batches, text):
            flat, ends = [], [0]
            at = 0
            for value in batch.column(text):
                one = np.fromiter(chain.from_iterable(map(memo.__getitem__, pieces(value.as_py() or ""))), np.int32)
                flat.append(one)
                at += len(one)
                ends.append(at)
            values = pa.array(np.concatenate(flat) if flat else np.empty(0, np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, hold])

    plain = docs.drop(ids)
    schema = plain.select("*", F.lit(None).cast("array<int>").alias(hold)).schema
    return plain.mapInArrow(run, schema).withColumnRenamed(hold, ids)


def decode_ids(rows: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out`` binary, the bytes of the ids in order; null ids give no bytes. An id that the vocabulary lacks raises."""
    size = max(ranks.values()) + 1
    tokens = [None] * size
    for token, rank in ranks.items():
        tokens[rank] = token
    shared = rows.sparkSession.sparkContext.broadcast(tokens)
    hold = fresh(rows, "decoded")

    def run(batches):
        known = shared.value
        for batch in batches:
            column = batch.column(ids)
            at = column.offsets.to_numpy()
            values = column.values.to_numpy()
            if len(values) and values.min() < 0:
                raise IndexError("the vocabulary lacks a negative id")
            out = []
            for i in range(len(column)):
                out.append(b"".join(map(known.__getitem__, values[at[i] : at[i + 1]].tolist())))  # a gap is None, which raises
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, hold])

    plain = rows.drop(out)
    schema = plain.select("*", F.lit(None).cast("binary").alias(hold)).schema
    return plain.mapInArrow(run, schema).withColumnRenamed(hold, out)

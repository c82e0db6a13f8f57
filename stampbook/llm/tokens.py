"""Token ids in training order: documents are cut into sequences, a keyed permutation gives each its slot,
and range partitions put the slots into shards of a fixed stride."""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stampbook.llm.arrays import mix
from stampbook.llm.working import kept

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_OF_TEXT = 50256
SEQUENCE_TOKENS = 2048
SHARD_SEQUENCES = 256
KEY = 20240601
ROUNDS = 4
SLICE_CHARS = 1 << 16

# Fixed value: the pattern that splits text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# A piece of the pattern never goes from other characters on to white space (as the pattern understands it), so a text
# may be cut there: a long one goes to the encoder in parts of about SLICE_CHARS, which bounds the lists of ids.
_BLANK = "\t-\r \x85\xa0  -     　"
_SLICE = re.compile(f"(?s:.{{{SLICE_CHARS}}})[{_BLANK}]*[^{_BLANK}]*|(?s:.+)")

_TOKENS = "part int, start long, n long, tokens binary"
_SHARD = "shard long, first_slot long, n_sequences int, stride int, payload binary"


@dataclass(frozen=True)
class Permutation:
    """A permutation of 0 .. n - 1 by a key: a Feistel network over the next even number of bits, walked on
    from numbers that are n or more until one is below n."""

    n: int
    key: int = KEY

    def _half(self) -> int:
        return max(1, (max(self.n - 1, 1).bit_length() + 1) // 2)

    def _round(self, x: np.ndarray, i: int) -> np.ndarray:
        return mix(x ^ mix(np.array([self.key + i], np.uint64))) & np.uint64((1 << self._half()) - 1)

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        half = np.uint64(self._half())
        left, right = x >> half, x & np.uint64((1 << int(half)) - 1)
        for i in range(ROUNDS):
            if back:
                left, right = right ^ self._round(left, ROUNDS - 1 - i), left
            else:
                left, right = right, left ^ self._round(right, i)
        return (left << half) | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        out = self._once(np.asarray(x).astype(np.uint64), back)
        while (outside := out >= np.uint64(self.n)).any():
            out[outside] = self._once(out[outside], back)
        return out.astype(np.int64)

    def slots(self, sequences: np.ndarray) -> np.ndarray:
        return self._walk(sequences, False)

    def sequences(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, True)


def _token_rows(ranks: bytes, pattern: str, end: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoding = tiktoken.Encoding("ranks", pat_str=pattern, special_tokens={}, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())})
        part, start, last = TaskContext.get().partitionId(), 0, np.array([end], np.uint16).tobytes()
        for batch in batches:
            starts, sizes, tokens = [], [], []
            for text in batch["text"].to_pylist():
                # the encoder looks whole words up by itself: asking it word by word costs more than all of its work
                found = [array("H", encoding.encode_ordinary(piece)).tobytes() for piece in _SLICE.findall(text or "")]
                found.append(last)
                tokens.append(b"".join(found))
                starts.append(start)
                sizes.append(len(tokens[-1]) // 2)
                start += sizes[-1]
            yield pa.RecordBatch.from_pydict({"part": pa.array([part] * len(tokens), pa.int32()), "start": starts, "n": sizes, "tokens": pa.array(tokens, pa.binary())})

    return rows


def _cuts(bases: dict[int, int], length: int, permutation: Permutation, per_shard: int):
    """The part of each sequence that a document holds: its shard, slot, offset and tokens."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = np.asarray(batch["start"]) + np.array([bases[p] for p in batch["part"].to_pylist()], np.int64)
            end = begin + np.asarray(batch["n"])
            first, count = begin // length, (end - 1) // length - begin // length + 1
            row = np.repeat(np.arange(len(begin)), count)
            sequence = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            a, b = np.maximum(sequence * length, begin[row]), np.minimum((sequence + 1) * length, end[row])
            slot = permutation.slots(sequence)
            raw = batch["tokens"].to_pylist()
            tokens = [raw[r][2 * i : 2 * j] for r, i, j in zip(row.tolist(), (a - begin[row]).tolist(), (b - begin[row]).tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict({"shard": slot // per_shard, "slot": slot, "offset": (a - sequence * length).astype(np.int32), "tokens": pa.array(tokens, pa.binary())})

    return cut


def _shards(length: int, n: int, per_shard: int, end: int):
    """Rows sorted by slot and offset to one row for each shard; what no token fills holds the end mark."""

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, payload = -1, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"shard": [current], "first_slot": [current * per_shard], "n_sequences": pa.array([len(payload) // length], pa.int32()), "stride": pa.array([2 * length], pa.int32()), "payload": pa.array([payload.tobytes()], pa.binary())})

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("shard", "slot", "offset", "tokens")]
            for shard, slot, offset, tokens in zip(*columns, strict=True):
                if shard != current:
                    if payload is not None:
                        yield done()
                    current, payload = shard, np.full(min(per_shard, n - shard * per_shard) * length, end, np.uint16)
                at = (slot - shard * per_shard) * length + offset
                payload[at : at + len(tokens) // 2] = np.frombuffer(tokens, np.uint16)
        if payload is not None:
            yield done()

    return assemble


def training_shards(docs: DataFrame, ranks: str = RANKS, pattern: str = PATTERN, end: int = END_OF_TEXT, length: int = SEQUENCE_TOKENS, per_shard: int = SHARD_SEQUENCES, key: int = KEY) -> DataFrame:
    """shard, first_slot, n_sequences, stride (bytes of a sequence), payload, in order of shards.

    Tokens of all texts, in the order of the table's files, each followed by the end mark, are one stream,
    cut into sequences of ``length`` tokens (16 bits each, little-endian; the last is filled with end marks).
    The sequence i is in slot Permutation(n, key).slots(i); slot s is in shard s // per_shard, at
    (s % per_shard) * stride of its payload. Nulls and empty texts are an end mark. Repeated rows are written
    as often as they occur; an empty table gives no shards; other columns are not read.
    """
    rows = docs.select("text").mapInArrow(_token_rows(Path(ranks).read_bytes(), pattern, end), _TOKENS)
    tokens = kept(rows)  # parts and places in them hold for all that follows
    sums = sorted((r[0], r[1]) for r in tokens.groupBy("part").agg(F.sum("n")).collect())  # one row a partition
    total = sum(n for _, n in sums)
    bases = {part: sum_before for (part, _), sum_before in zip(sums, np.cumsum([0, *[n for _, n in sums]]).tolist(), strict=False)}
    n = -(-total // length)
    cut = tokens.mapInArrow(_cuts(bases, length, Permutation(max(n, 1), key), per_shard), "shard long, slot long, offset int, tokens binary")
    dealt = cut.repartitionByRange("shard").sortWithinPartitions("shard", "slot", "offset")
    return dealt.mapInArrow(_shards(length, n, per_shard, end), _SHARD)


def read_slots(shards: DataFrame, first: int, last: int) -> DataFrame:
    """slot and tokens of the slots first .. last - 1, from the shards that hold them only."""
    size = F.col("n_sequences")
    inside = shards.where((F.col("first_slot") < last) & (F.col("first_slot") + size > first))
    each = inside.select("first_slot", "stride", "payload", F.posexplode(F.sequence(F.lit(1), size)).alias("i", "_"))
    slots = each.select((F.col("first_slot") + F.col("i")).alias("slot"), F.substring("payload", F.col("i") * F.col("stride") + 1, F.col("stride")).alias("tokens"))
    return slots.where((F.col("slot") >= first) & (F.col("slot") < last))


def op5(docs: DataFrame) -> DataFrame:
    return training_shards(docs)

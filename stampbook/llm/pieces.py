"""SentencePiece encoding and decoding: a relational lattice of pieces, folded by Spark's higher-order functions.

Models of the unigram kind are folded by Viterbi: the best sum of scores. In a model of the BPE kind scores
are the ranks of merges, and the best sum of ranks is not the model's encoding; there the fold makes the
merges over the same lattice, best score first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stampbook.llm import arrays as A
from stampbook.llm.blocks import BLOCK, ROW, TEXT
from stampbook.llm.columns import let, spread

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_BYTES = 8 << 20  # of text
UNKNOWN_PENALTY = 10.0  # below the lowest piece, for a character that no piece is

SPACE = "▁"
_BPE = 2  # the model_type of a model file's trainer settings
LONG_WORD = 64  # characters; longer ones are merged with a heap
ID_BITS = 20
PLACE_BITS = 22  # above a rank and an id, for a start and an end


@dataclass(frozen=True)
class Vocabulary:
    """A model file's pieces: of a size that the file fixes, not the data."""

    pieces: list[str]  # by id, with spaces for SPACE; empty for control and byte pieces
    scores: list[float]
    byte_ids: list[int]  # the piece that stands for each byte
    merges: bool  # the BPE kind

    @property
    def longest(self) -> int:
        return max(map(len, self.pieces))

    @property
    def unknown(self) -> float:
        return min(s for p, s in zip(self.pieces, self.scores, strict=True) if p) - UNKNOWN_PENALTY

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(p, i, s) for i, (p, s) in enumerate(zip(self.pieces, self.scores, strict=True)) if p]
        return spark.createDataFrame(rows, "piece string, id int, score double")

    def joins(self, spark: SparkSession) -> DataFrame:
        """Pieces of several characters, and the rank of their score above their id in one number."""
        order = {x: i for i, x in enumerate(sorted(set(self.scores), reverse=True))}
        rows = [(p, order[s] << ID_BITS | i) for i, (p, s) in enumerate(zip(self.pieces, self.scores, strict=True)) if len(p) > 1]
        return spark.createDataFrame(rows, "piece string, value long")

    def raw(self) -> list[bytes]:
        out = [p.encode() for p in self.pieces]
        for byte, i in enumerate(self.byte_ids):
            out[i] = bytes([byte])
        return out


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protobuf message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(message):
        key, at = number(at)
        if key & 7 == 0:
            value, at = number(at)
        else:
            size, at = number(at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = message[at : at + size], at + size
        yield key >> 3, value


def _kind(model: bytes) -> int:
    trainer = next((v for f, v in _fields(model) if f == 2), b"")
    return next((v for f, v in _fields(trainer) if f == 3), 1)


def vocabulary(model: str = MODEL) -> Vocabulary:
    from sentencepiece import SentencePieceProcessor

    processor = SentencePieceProcessor(model_file=model)
    pieces, scores, byte_ids = [], [], [0] * 256
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if processor.is_byte(i):
            byte_ids[int(piece[3:-1], 16)] = i
        plain = not (processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i))
        pieces.append(piece.replace(SPACE, " ") if plain else "")
        scores.append(processor.get_score(i))
    return Vocabulary(pieces, scores, byte_ids, _kind(Path(model).read_bytes()) == _BPE)


def _marked(text: Column) -> Column:
    """The text with a space before it and a space for each mark; an empty text stays empty."""
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit(SPACE), F.lit(" "))
    return F.when(F.length(plain) > 0, F.concat(F.lit(" "), plain)).otherwise("")


def _best_path(edges: Column, n: Column) -> Column:
    """The ids on the best way through edges (an array for each end) of a word of n characters.

    One fold over the edges keeps the best score and last edge up to each end. A character that no piece
    is gets an edge with the id -1 - its place. Of equal scores the longer last piece wins.
    """
    start = F.struct(F.array(F.lit(0.0)).alias("scores"), F.array().cast("array<int>").alias("starts"), F.array().cast("array<int>").alias("ids"))

    def put(a: Column, score: Column, begin: Column, piece: Column) -> Column:
        return F.struct(F.concat(a["scores"], F.array(score)).alias("scores"), F.concat(a["starts"], F.array(begin)).alias("starts"), F.concat(a["ids"], F.array(piece)).alias("ids"))

    def step(a: Column, group: Column) -> Column:
        score = F.transform(group, lambda e: F.struct((F.get(a["scores"], e["start"]) + e["score"]).alias("score"), (-e["start"]).alias("back"), e["id"].alias("id")))
        return let(F.array_max(score), lambda best: put(a, best["score"], -best["back"], best["id"]))

    reached = F.aggregate(edges, start, step)

    def back(r: Column) -> Column:
        begin = F.struct(n.alias("at"), F.array().cast("array<int>").alias("ids"))
        walked = F.aggregate(F.sequence(F.lit(1), n), begin, lambda a, _: F.when(a["at"] > 0, F.struct(F.get(r["starts"], a["at"] - 1).alias("at"), F.concat(F.array(F.get(r["ids"], a["at"] - 1)), a["ids"]).alias("ids"))).otherwise(a))
        return walked["ids"]

    return let(reached, back)


def _merged(edges: Column, word: Column) -> Column:
    """What merging leaves of a word: of neighbours that a piece joins, the best rank first, of equal ones the
    leftmost. Pieces of one character are left as that character's negative code point.

    An edge is its place (start and end) above its rank and id; the fold's state is the ends of the symbols so far.
    """
    n = F.length(word)

    def place(start: Column, end: Column) -> Column:
        return (start * (LONG_WORD + 1) + end).cast("long")

    def with_pieces(pieces: Column) -> Column:
        def step(a: Column, _: Column) -> Column:
            def merge(ends: Column) -> Column:
                ranks = F.transform(F.sequence(F.lit(1), F.size(ends) - 2), lambda i: F.shiftright(F.element_at(pieces, place(F.get(ends, i - 1), F.get(ends, i + 1))), ID_BITS))
                return let(ranks, lambda r: let(F.array_position(r, F.array_min(r)), lambda at: F.when(at.isNull(), F.struct(ends.alias("ends"), F.lit(True).alias("done"))).otherwise(
                    F.struct(F.filter(ends, lambda e, i: i != at).alias("ends"), F.lit(False).alias("done")))))

            return F.when(a["done"] | (F.size(a["ends"]) < 3), a).otherwise(merge(a["ends"]))

        def symbol(start: Column, end: Column) -> Column:
            joined = F.element_at(pieces, place(start, end)).bitwiseAND(F.lit((1 << ID_BITS) - 1)).cast("int")
            return F.when(end - start == 1, -F.ascii(F.substring(word, end, F.lit(1)))).otherwise(joined)

        begin = F.struct(F.sequence(F.lit(0), n).alias("ends"), F.lit(False).alias("done"))
        ends = F.aggregate(F.sequence(F.lit(1), n), begin, step, lambda a: a["ends"])
        return let(ends, lambda e: F.transform(F.sequence(F.lit(1), F.size(e) - 1), lambda i: symbol(F.get(e, i - 1), F.get(e, i))))

    value = (1 << (64 - PLACE_BITS)) - 1
    entries = F.transform(edges, lambda e: F.struct(F.shiftrightunsigned(e, 64 - PLACE_BITS), e.bitwiseAND(F.lit(value))))
    return let(F.map_from_entries(entries), with_pieces)


def _merge_word(word: str, pieces: dict[str, tuple[int, float]], byte_ids: list[int]) -> list[int]:
    """The same for a word of any length, with a heap of the joinable neighbours."""
    ends = list(range(1, len(word) + 1))  # of the symbol that starts at each place; 0 if none does
    before = list(range(-1, len(word) - 1))
    heap = [(-pieces[word[i : i + 2]][1], i, i + 1, i + 2) for i in range(len(word) - 1) if word[i : i + 2] in pieces]
    heapify(heap)
    while heap:
        _, left, middle, right = heappop(heap)
        if ends[left] != middle or middle >= len(word) or ends[middle] != right:
            continue
        ends[left], ends[middle] = right, 0
        if right < len(word):
            before[right] = left
            joined = word[left : ends[right]]
            if joined in pieces:
                heappush(heap, (-pieces[joined][1], left, right, ends[right]))
        if before[left] >= 0:
            joined = word[before[left] : right]
            if joined in pieces:
                heappush(heap, (-pieces[joined][1], before[left], left, right))
    out, at = [], 0
    while at < len(word):
        piece = word[at : ends[at]]
        out += [pieces[piece][0]] if piece in pieces else [byte_ids[b] for b in piece.encode()]
        at = ends[at]
    return out


def _bytes(ids: Column, word: Column, byte_ids: list[int]) -> Column:
    """ids, with the pieces of its bytes for each character that no piece is."""
    table = F.array(*[F.lit(i) for i in byte_ids])

    def of_character(i: Column) -> Column:
        digits = F.hex(F.encode(F.substring(word, -i, F.lit(1)), "UTF-8"))
        return F.transform(F.sequence(F.lit(0), (F.length(digits) / 2).cast("int") - 1), lambda k: F.get(table, F.conv(F.substring(digits, k * 2 + 1, F.lit(2)), 16, 10).cast("int")))

    return F.when(F.exists(ids, lambda i: i < 0), F.flatten(F.transform(ids, lambda i: F.when(i >= 0, F.array(i)).otherwise(of_character(i))))).otherwise(ids)


def encode_words(words: DataFrame, keys: list[str], vocabulary: Vocabulary, rest: list[str] | None = None) -> DataFrame:
    """keys, word, its ids and other columns (rest), for distinct words (with keys). Words have spaces where pieces have marks.

    Each substring of up to the longest piece's length meets the piece table; the table is broadcast, as a
    model file bounds it. Grouping the edges by word needs no exchange beyond that of the words.
    """
    n, rest = F.length("word"), rest or []
    if vocabulary.merges:
        return _merge_words(words, keys, rest, vocabulary)
    starts = words.select(*keys, "word", *rest, F.explode(F.sequence(F.lit(1), n)).alias("at"))
    spans = starts.select("*", F.explode(F.sequence(F.lit(1), F.least(F.lit(vocabulary.longest), n - F.col("at") + 1))).alias("long"))
    piece = F.substring(F.col("word"), F.col("at"), F.col("long"))
    table = F.broadcast(vocabulary.table(words.sparkSession))
    unit = (F.col("long") == 1) & F.col("id").isNull()
    joined = spans.withColumn("piece", piece).join(table, "piece", "left").where(F.col("id").isNotNull() | unit)
    end = F.col("at") + F.col("long") - 1
    edge = F.struct(end.alias("end"), (F.col("at") - 1).alias("start"), F.when(unit, -F.col("at")).otherwise(F.col("id")).alias("id"), F.when(unit, F.lit(vocabulary.unknown)).otherwise(F.col("score")).alias("score"))
    grouped = joined.groupBy(*keys, "word").agg(F.collect_list(edge).alias("edges"), *[F.first(c).alias(c) for c in rest])

    def by_end(edges: Column) -> Column:
        """One array for each end; every end has the edge of its single character."""
        ordered = F.array_sort(edges)
        return let(ordered, lambda s: let(
            F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.coalesce(F.get(s, i)["end"] != F.get(s, i - 1)["end"], F.lit(True))),
            lambda cuts: F.transform(cuts, lambda c, k: F.slice(s, c + 1, F.coalesce(F.get(cuts, k + 1), F.size(s)) - c)),
        ))

    ids = _best_path(by_end(F.col("edges")), n)
    return grouped.select(*keys, "word", *rest, let(ids, lambda i: _bytes(i, F.col("word"), vocabulary.byte_ids)).alias("ids"))


def _merge_words(words: DataFrame, keys: list[str], rest: list[str], vocabulary: Vocabulary) -> DataFrame:
    """The same by merges, for words of up to LONG_WORD characters with a joinable part; negative ids are code points."""
    n = F.length("word")
    some = words.where((n > 1) & (n <= LONG_WORD)).select(*keys, "word", *rest, F.explode(F.sequence(F.lit(1), n - 1)).alias("at"))
    spans = some.select("*", F.explode(F.sequence(F.lit(2), F.greatest(F.lit(2), F.least(F.lit(vocabulary.longest), n - F.col("at") + 1)))).alias("long"))
    spans = spans.withColumn("piece", F.substring(F.col("word"), F.col("at"), F.col("long")))
    joined = spans.join(F.broadcast(vocabulary.joins(words.sparkSession)), "piece")
    start = F.col("at") - 1
    edge = F.shiftleft((start * (LONG_WORD + 1) + start + F.col("long")).cast("long"), 64 - PLACE_BITS).bitwiseOR(F.col("value"))
    grouped = joined.groupBy(*keys, "word").agg(F.collect_list(edge).alias("edges"), *[F.first(c).alias(c) for c in rest])
    return grouped.select(*keys, "word", *rest, _merged(F.col("edges"), F.col("word")).alias("ids"))


def _letter_or_symbol(vocab: Vocabulary) -> np.ndarray:
    """For each byte 1 (an ASCII letter), 2 (another visible or control ASCII character) or 0; all 0 if a piece joins both."""
    kind = np.zeros(256, np.int8)
    kind[:128] = 2
    kind[[*range(65, 91), *range(97, 123)]] = 1
    kind[32] = 0
    for piece in vocab.pieces:
        found = kind[np.frombuffer(piece.encode(), np.uint8)]
        if (found[1:] + found[:-1] == 3).any():
            return np.zeros(256, np.int8)
    return kind


def _units(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the parts that no piece goes beyond, and the text of each: words with the spaces before
    them, cut between letters and symbols if no piece joins these, and spaces at a text's end."""
    space = data == 32
    last = np.zeros(len(data) + 1, bool)
    last[1 : len(data)] = ~space[:-1] & space[1:]
    found = kind[data]
    last[1 : len(data)] |= found[1:] + found[:-1] == 3
    last[offsets[1:][np.diff(offsets) > 0]] = True
    ends = np.flatnonzero(last)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(ends, offsets, "right")))
    starts = np.maximum(np.concatenate(([0], ends[:-1])), offsets[:-1][text]) if len(ends) else ends
    return starts, ends, text


def _asked(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different units: place of the first of each, by bucket and hash, for every unit the number of its kind, and where each bucket begins."""
    names = A.span_hashes(A.prefix_sums(data, A.byte_values()), starts, ends)
    codes, kinds = pd.factorize(names)
    first = np.empty(len(kinds), np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    bucket = (kinds % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((kinds, bucket))
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    return first[order], number[codes], np.searchsorted(bucket[order], np.arange(buckets + 1))


def _packed(*arrays: np.ndarray) -> tuple[bytes, int]:
    raw = b"".join(A.packed(x) for x in arrays)
    return pa.compress(raw, codec="zstd", asbytes=True), len(raw)


def _unpacked(payload: pa.Scalar, size: pa.Scalar) -> bytes:
    return pa.decompress(payload.as_py(), decompressed_size=size.as_py(), codec="zstd", asbytes=True)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in blocks of BLOCK_BYTES of text, compressed; numbered by task and place."""
    number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32
    for batch in batches:
        for part in A.slices(batch, TEXT, BLOCK_BYTES):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as writer:
                writer.write_batch(part)
            yield pa.RecordBatch.from_pydict({BLOCK: pa.array([number], pa.int64()), "payload": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
            number += 1


def _opened(payload: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(payload.as_py()).read_all()


def _asking(kind: np.ndarray, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each block and bucket the different units of the block, in the order of their hashes."""

    def asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch[BLOCK], batch["payload"], strict=True):
                data, offsets = A.texts(_opened(payload)[TEXT])
                starts, ends, _ = _units(data, offsets, kind)
                first, _, edges = _asked(data, starts, ends, buckets)
                sizes = (ends - starts)[first].astype(np.int32)
                words, upto, rows = A.gather(data, starts[first], ends[first]), np.concatenate(([0], np.cumsum(sizes))), []
                for b in np.flatnonzero(np.diff(edges)):
                    x, y = edges[b], edges[b + 1]
                    packed, size = _packed(sizes[x:y], words[upto[x] : upto[y]])
                    rows.append({"bucket": int(b), BLOCK: block.as_py(), "units": int(y - x), "size": size, "payload": packed})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema([("bucket", pa.int32()), (BLOCK, pa.int64()), ("units", pa.int32()), ("size", pa.int64()), ("payload", pa.binary())]))

    return asking


def _words_of(units: pa.Scalar, size: pa.Scalar, payload: pa.Scalar) -> pa.Array:
    raw, n = _unpacked(payload, size), units.as_py()
    offsets = np.concatenate(([0], np.cumsum(np.frombuffer(raw, np.int32, n)))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(raw[4 * n :])])


def _different(table: pa.Table) -> pa.Table:
    """bucket, word: the different units that the blocks ask of a bucket."""
    words = pa.array([], pa.binary())
    for row in range(table.num_rows):
        words = pa.concat_arrays([words, _words_of(*(table[c][row] for c in ("units", "size", "payload")))]).unique()
    return pa.table({"bucket": pa.array(np.full(len(words), table["bucket"][0].as_py()), pa.int32()), "word": words.cast(pa.string())})


def _replying(vocab: Vocabulary) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For each block and bucket the ids of the units it asked for, in that order."""
    by_piece = {p: (i, s) for i, (p, s) in enumerate(zip(vocab.pieces, vocab.scores, strict=True)) if p}
    schema = pa.schema([(BLOCK, pa.int64()), ("bucket", pa.int32()), ("units", pa.int32()), ("size", pa.int64()), ("payload", pa.binary())])
    wide = len(vocab.pieces) > 1 << 16

    def of_character(code: int) -> list[int]:
        found = by_piece.get(chr(code))
        return [found[0]] if found else [vocab.byte_ids[b] for b in chr(code).encode()]

    def spelt(ids: pa.ChunkedArray) -> pa.Array:
        """Lists of ids with the ids of characters for negative code points."""
        lists = pa.concat_arrays([*ids.chunks, pa.array([], pa.list_(pa.int32()))])
        flat, ends = np.asarray(lists.flatten()), np.concatenate(([0], np.cumsum(np.asarray(lists.value_lengths()))))
        codes, back = np.unique(flat[flat < 0], return_inverse=True)
        each = [of_character(-c) for c in codes.tolist()]
        first = np.concatenate(([0], np.cumsum([len(x) for x in each]))).astype(np.int64)
        every = np.array([i for x in each for i in x], np.int64)
        counts = np.ones(len(flat), np.int64)
        counts[flat < 0] = np.diff(first)[back]
        out = np.repeat(flat, counts).astype(np.int64)
        out[np.repeat(flat < 0, counts)] = every[A.ranges(first[:-1][back], np.diff(first)[back])] if len(every) else 0
        upto = np.concatenate(([0], np.cumsum(counts)))[ends]
        return pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(out.astype(np.int32)))

    def hashes(words: pa.Array) -> np.ndarray:
        data, offsets = A.texts(words)
        return A.span_hashes(A.prefix_sums(data, A.byte_values()), offsets[:-1], offsets[1:])

    def replying(asks: pa.Table, encoded: pa.Table) -> pa.Table:
        words = encoded.select(["word", "ids"]).cast(pa.schema([("word", pa.binary()), ("ids", pa.list_(pa.int32()))]))
        names = pa.concat_arrays([*words["word"].chunks, pa.array([], pa.binary())])
        lists = spelt(words["ids"])
        asked = [_words_of(*(asks[c][row] for c in ("units", "size", "payload"))) for row in range(asks.num_rows)]
        every = pa.concat_arrays([*asked, pa.array([], pa.binary())])
        wanted = hashes(every)
        codes, missing = pd.factorize(wanted)
        where = np.empty(len(missing), np.int64)
        where[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        where = where[~np.isin(missing, hashes(names))]
        if vocab.merges and len(where):  # words that the lattice leaves out: long ones, and those that no piece joins
            others = every.take(pa.array(where))
            merged = [_merge_word(w.decode("utf-8", "replace"), by_piece, vocab.byte_ids) for w in others.to_pylist()]
            names, lists = pa.concat_arrays([names, others]), pa.concat_arrays([lists, pa.array(merged, pa.list_(pa.int32()))])
        known = hashes(names)
        by_name = np.argsort(known, kind="stable")
        flat, counts = np.asarray(lists.flatten()), np.asarray(lists.value_lengths())
        upto = np.concatenate(([0], np.cumsum(counts)))
        places = by_name[np.searchsorted(known, missing, sorter=by_name)][codes] if len(codes) else codes
        edges, rows = np.cumsum([0, *map(len, asked)]), []
        for row, n in enumerate(map(len, asked)):
            at = places[edges[row] : edges[row + 1]]
            told = np.asarray(pc.binary_length(asked[row])).astype(np.uint8)  # the length's last byte, as a check
            packed, size = _packed(told, counts[at].astype(np.int32), flat[A.ranges(upto[:-1][at], counts[at])].astype(np.int32 if wide else np.uint16))
            rows.append({BLOCK: asks[BLOCK][row].as_py(), "bucket": asks["bucket"][row].as_py(), "units": n, "size": size, "payload": packed})
        return pa.Table.from_pylist(rows, schema)

    return replying


def _assembling(vocab: Vocabulary, kind: np.ndarray, buckets: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The ids of the texts of a block, from the replies of the buckets."""
    raw = vocab.raw()
    sizes = np.array([len(x) for x in raw])
    joined, begins = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum(sizes)))[:-1]
    wide = len(raw) > 1 << 16

    def assembling(block: pa.Table, replies: pa.Table) -> pa.Table:
        table = _opened(block["payload"][0])
        data, offsets = A.texts(table[TEXT])
        starts, ends, text = _units(data, offsets, kind)
        first, number, _ = _asked(data, starts, ends, buckets)
        asked = (ends - starts)[first].astype(np.uint8)
        counts, ids, told = [np.zeros(0, np.uint16)], [np.zeros(0, np.int32)], [np.zeros(0, np.uint8)]
        for row in np.argsort(np.asarray(replies["bucket"])):
            values, n = _unpacked(replies["payload"][row], replies["size"][row]), replies["units"][row].as_py()
            told.append(np.frombuffer(values, np.uint8, n))
            counts.append(np.frombuffer(values, np.int32, n, n))
            ids.append(np.frombuffer(values, np.int32, -1, 5 * n) if wide else np.frombuffer(values, np.uint16, -1, 5 * n))
        counts, flat = np.concatenate(counts), np.concatenate(ids)
        if len(counts) != len(first) or not np.array_equal(asked, np.concatenate(told)):
            raise ValueError("the texts of a block changed between two readings of the table")
        upto = np.concatenate(([0], np.cumsum(counts)))
        per_unit = counts[number]
        ids = flat[A.ranges(upto[:-1][number], per_unit)]
        token_upto = np.concatenate(([0], np.cumsum(per_unit)))
        edges = token_upto[np.searchsorted(text, np.arange(len(offsets)))].astype(np.int32)
        back = joined[A.ranges(begins[ids], sizes[ids])] if len(ids) else data[:0]
        byte_upto = np.concatenate(([0], np.cumsum(sizes[ids])))[edges]
        same = [bool(b1 - b0 == e - s) and np.array_equal(back[b0:b1], data[s:e]) for s, e, b0, b1 in zip(offsets[:-1], offsets[1:], byte_upto[:-1], byte_upto[1:], strict=True)]
        out = pa.ListArray.from_arrays(pa.array(edges), pa.array(ids.astype(np.int32)))
        return pa.table({ROW: A.loose(table[ROW]), "ids": out, "n_tokens": np.diff(edges).astype(np.int64), "round_trip": pa.array(same, pa.bool_())})

    return assembling


def encode(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """All columns of docs but text, and ids, n_tokens, round_trip (decoding gives the bytes of the text).

    Texts get a space before them, spaces become marks, and words are taken with the spaces before them (no
    piece has a mark after another character) and cut into pieces as the model's kind says; characters
    without a piece are cut into bytes. Each different word of the table meets the pieces once: blocks of texts ask
    buckets of words, which send the ids back. ``docs`` must give the same rows in the same order when Spark reads lost
    parts again, as a table does; otherwise the job fails rather than mix texts up. Nulls and empty texts have no ids. Repeated rows
    give repeated rows; an empty table gives no rows; extra columns pass through; those with a name of the result give way.
    """
    kind = _letter_or_symbol(vocab)
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"] or [F.lit(None).cast("int").alias("_none")]
    rows = docs.select(F.struct(*rest).alias(ROW), _marked(F.col("text")).cast("binary").alias(TEXT))
    # dealt once; both uses read the same exchange
    blocks = rows.mapInArrow(_blocks, f"{BLOCK} long, payload binary").repartition(buckets, BLOCK)
    message = f"bucket int, {BLOCK} long, units int, size long, payload binary"
    asks = blocks.mapInArrow(_asking(kind, buckets), message).repartition(buckets, "bucket")
    different = asks.groupBy("bucket").applyInArrow(_different, "bucket int, word string")
    encoded = encode_words(different.repartition(buckets, "bucket"), ["bucket"], vocab)
    replies = asks.groupBy("bucket").cogroup(encoded.groupBy("bucket")).applyInArrow(_replying(vocab), f"{BLOCK} long, bucket int, units int, size long, payload binary")
    schema = f"{ROW} {rows.schema[ROW].dataType.simpleString()}, ids array<int>, n_tokens long, round_trip boolean"
    out = blocks.groupBy(BLOCK).cogroup(replies.groupBy(BLOCK)).applyInArrow(_assembling(vocab, kind, buckets), schema)
    return spread(out, ROW, "ids", "n_tokens", "round_trip")


def decode(rows: DataFrame, vocab: Vocabulary, column: str = "ids") -> DataFrame:
    """rows with text, the bytes of the pieces read as UTF-8 (what isn't becomes U+FFFD), without the first space."""
    raw = vocab.raw()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [b"".join(raw[i] for i in ids or ()).decode("utf-8", "replace")[1:] for ids in batch["_ids"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"_row": A.loose(batch["_row"]), "text": pa.array(found, pa.string())})

    rest = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != "text"]).alias("_row"), F.col(f"`{column}`").alias("_ids"))
    return spread(rest.mapInArrow(texts, f"_row {rest.schema['_row'].dataType.simpleString()}, text string"), "_row", "text")


def op7(docs: DataFrame) -> DataFrame:
    return encode(docs.select("doc_id", "text"), vocabulary()).select("doc_id", "n_tokens", "ids", "round_trip")

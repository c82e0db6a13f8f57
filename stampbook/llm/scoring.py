"""Language-model scoring with a weighted backoff automaton.

States are the contexts seen in training, arcs the n-grams seen, with their smoothed
probability. A state without an arc for the next word is left by its failure arc, which
leads to the context without its first word. Counts never meet in one place: each block
of documents asks the buckets of all n-grams for the counts of those that it holds, and
so gets the part of the automaton that its texts can walk.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stampbook.llm import arrays as A
from stampbook.llm.blocks import BLOCK, ROW, TEXT, blocked, parts, text_bytes
from stampbook.llm.columns import spread
from stampbook.llm.repeats import _bucket_edges
from stampbook.llm.working import kept

ORDER = 2
PRIOR = 100.0  # what the shorter context weighs, in occurrences

BLOCK_BYTES = 8 << 20
#: Bits of a hash that don't travel, of single words and of longer n-grams; with those that a bucket has in common,
#: 60 and more bits tell words apart, and about 54 n-grams, of which a collision changes one probability.
DROPPED_BITS = {1: 2, 2: 10}

BEGIN, END = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
_FIRST = A.mix(np.array([BEGIN]))[0]
_ASK = "bucket int, size int, block int, keys binary, counts binary"
_REPLY = "block int, bucket int, size int, counts binary, tokens long, types long, once long, twice long"
_OUT = "n_tokens long, n_known long, train_tokens long, base_score double, score double"
_FLAG = "_train"


def _planes(counts: np.ndarray) -> bytes:
    """Counts with their bytes of equal weight side by side, which are mostly zeros, compressed."""
    return zlib.compress(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _start(bucket: int, buckets: int) -> int:
    return -(-(bucket << 64) // buckets)


def _relative(keys: np.ndarray, bucket: int, buckets: int, size: int) -> np.ndarray:
    """Keys from the bucket's start on, without their lowest bits."""
    return (keys - np.uint64(_start(bucket, buckets))) >> np.uint64(DROPPED_BITS[min(size, 2)])


def _steps(ascending: np.ndarray) -> bytes:
    """Ascending numbers as the steps between them, in as few bytes each as the largest step needs."""
    steps = np.diff(ascending, prepend=np.uint64(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    return bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _from_steps(raw: bytes) -> np.ndarray:
    width = raw[0]
    out = np.zeros(((len(raw) - 1) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(out.view("<u8").ravel(), dtype=np.uint64)


@dataclass
class _Grams:
    first: np.ndarray  # of each text, the place of its begin mark; n + 1 entries
    keys: list[np.ndarray]  # for each size from 1, the distinct n-grams
    number: list[np.ndarray]  # for each size, which of them ends at each place; -1 before a text's begin


def _grams(table: pa.Table, order: int) -> _Grams:
    data, offsets = A.texts(table[TEXT])
    starts, ends, first = A.words(data, offsets, A.separators())
    symbols = A.span_hashes(A.prefix_sums(data, A.byte_values(lower=True)), starts, ends)
    texts = np.arange(len(first) - 1)
    edge = first + 2 * np.append(texts, len(texts))
    sequence = np.empty(len(symbols) + 2 * len(texts), np.uint64)
    sequence[edge[:-1]], sequence[edge[1:] - 1] = BEGIN, END
    sequence[np.arange(len(symbols)) + 2 * np.repeat(texts, np.diff(first)) + 1] = symbols
    depth = np.arange(len(sequence)) - np.repeat(edge[:-1], np.diff(edge))
    keys, number = [], []
    for size in range(1, order + 1):
        whole = np.flatnonzero(depth >= size - 1)
        own, back = np.unique(A.gram_hashes(sequence, size)[whole - size + 1], return_inverse=True)
        keys.append(own)
        number.append(np.full(len(sequence), -1))
        number[-1][whole] = back
    return _Grams(edge, keys, number)


def _asks(order: int, buckets: int) -> Callable[[pa.Table], pa.Table]:
    def ask(table: pa.Table) -> pa.Table:
        grams = _grams(table, order)
        train = np.repeat(np.asarray(table[_FLAG].combine_chunks().cast(pa.int8())) > 0, np.diff(grams.first))
        block, rows = table[BLOCK][0].as_py(), []
        for size, (keys, number) in enumerate(zip(grams.keys, grams.number, strict=True), 1):
            counts = np.bincount(number[train & (number >= 0)], minlength=len(keys))
            edges = _bucket_edges(keys, buckets)
            for b in np.flatnonzero(np.diff(edges)):
                own = slice(edges[b], edges[b + 1])
                rows.append((int(b), size, block, _steps(_relative(keys[own], int(b), buckets, size)), _planes(counts[own])))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(["bucket", "size", "block", "keys", "counts"], columns, kinds, strict=True)})

    return ask


def _replies(table: pa.Table, buckets: int) -> pa.Table:
    """What other blocks add to the training counts of each block's n-grams; with single words also what the bucket has, once."""
    own = [_from_steps(x) for x in table["keys"].to_pylist()]
    every = np.concatenate(own)
    counts = np.concatenate([_from_planes(x) for x in table["counts"].to_pylist()])
    keys, back = np.unique(every, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, back, counts)
    size, n, bucket = table["size"][0].as_py(), table.num_rows, table["bucket"][0].as_py()
    mark = _FIRST >= np.uint64(_start(bucket, buckets)) and int(_FIRST) < _start(bucket + 1, buckets)
    plain = keys != _relative(_FIRST, bucket, buckets, 1) if mark else np.ones(len(keys), bool)
    parts = np.split(total[back] - counts, np.cumsum([len(x) for x in own])[:-1])
    seen = total[plain & (total > 0)] if size == 1 else total[:0]
    facts = {"tokens": seen.sum(), "types": len(seen), "once": (seen == 1).sum(), "twice": (seen == 2).sum()}
    reply = {"block": table["block"], "bucket": table["bucket"], "size": table["size"], "counts": pa.array([_planes(x) for x in parts], pa.binary())}
    return pa.table(reply | {k: pa.array([int(v)] + [0] * (n - 1), pa.int64()) for k, v in facts.items()})


@dataclass
class Facts:
    """Of all training tokens: how many, and how many different ones in all, seen once, seen twice."""

    tokens: int
    types: int
    once: int
    twice: int

    def known(self, counts: np.ndarray) -> np.ndarray:
        """Probabilities of words by their counts, less the discount that unknown words get together."""
        discount = (self.once + 0.5) / (self.once + 2 * self.twice + 1)
        return np.where(counts > 0, np.maximum(counts - discount, 0) / max(self.tokens, 1), discount * self.types / self.tokens if self.tokens else 1.0)


def _walk(grams: _Grams, counts: list[np.ndarray], facts: Facts, prior: float) -> np.ndarray:
    """The log10 probability of each text: all texts advance one token at a time, each with its state.

    A state is the length of the context it stands for, whose words are those just read.
    """
    number, order = grams.number, len(counts)
    arc, fail = [facts.known(counts[0])], []
    for size in range(2, order + 1):
        at = np.full(len(counts[size - 1]), -1)
        places = np.flatnonzero(number[size - 1] >= 0)
        at[number[size - 1][places]] = places
        context = counts[size - 2][number[size - 2][at - 1]]
        arc.append((counts[size - 1] + prior * arc[-1][number[size - 2][at]]) / (context + prior))
        fail.append(np.log10(prior / (counts[size - 2] + prior)))
    arc = [np.log10(x) for x in arc]
    lengths = np.diff(grams.first)
    by_length = np.argsort(-lengths, kind="stable")
    begin, ordered = grams.first[:-1][by_length], lengths[by_length]
    score = np.zeros(len(begin))
    state = np.full(len(begin), min(1, order - 1))
    for step in range(1, int(ordered[0]) if len(ordered) else 0):
        live = int(np.searchsorted(-ordered, -step))
        place, length, gain = begin[:live] + step, state[:live].copy(), np.zeros(live)
        for size in range(order, 0, -1):
            here = np.flatnonzero(length == size - 1)
            if not len(here):
                continue
            gram = number[size - 1][place[here]]
            if size > 1:
                unseen = counts[size - 1][gram] == 0
                lost = here[unseen]
                gain[lost] += fail[size - 2][number[size - 2][place[lost] - 1]]
                length[lost] = size - 2
                here, gram = here[~unseen], gram[~unseen]
            gain[here] += arc[size - 1][gram]
            state[here] = np.where(counts[size - 1][gram] > 0, min(size, order - 1), 0)
            length[here] = -1
        score[:live] += gain
    out = np.empty(len(score))
    out[by_length] = score
    return out


def _scores(order: int, prior: float, buckets: int, facts: Facts) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def scored(table: pa.Table, replies: pa.Table) -> pa.Table:
        grams = _grams(table, order)
        counts = []
        found = {(s, b): x for s, b, x in zip(replies["size"].to_pylist(), replies["bucket"].to_pylist(), replies["counts"].to_pylist(), strict=True)}
        train = np.repeat(np.asarray(table[_FLAG].combine_chunks().cast(pa.int8())) > 0, np.diff(grams.first))
        for size, (keys, number) in enumerate(zip(grams.keys, grams.number, strict=True), 1):
            added = [_from_planes(found[size, int(b)]) for b in np.flatnonzero(np.diff(_bucket_edges(keys, buckets)))]
            counts.append(np.bincount(number[train & (number >= 0)], minlength=len(keys)) + np.concatenate([*added, np.zeros(0, np.int64)]))
        single = counts[0][grams.number[0]]
        chance = np.log10((single + 1) / (facts.tokens + facts.types + 1))
        inner = grams.first[:-1] + 1  # after the begin mark

        def per_text(x: np.ndarray) -> np.ndarray:
            return np.add.reduceat(np.append(x, 0), np.stack((inner, grams.first[1:]), 1).ravel())[::2]

        return pa.table({
            ROW: A.loose(table[ROW]), "n_tokens": np.diff(grams.first) - 1, "n_known": per_text((single > 0).astype(np.int64)),
            "train_tokens": np.full(table.num_rows, facts.tokens), "base_score": per_text(chance), "score": _walk(grams, counts, facts, prior),
        })

    return scored


def score_texts(docs: DataFrame, train: Column, order: int = ORDER, prior: float = PRIOR) -> DataFrame:
    """All columns of docs but text, and n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows for which ``train`` is true (null: not). Tokens are lower-cased (A-Z)
    words between white space, then one end. p(w | context) = (c(context w) + prior * p(w | shorter
    context)) / (c(context) + prior); single words are discounted by Good-Turing's estimate, and what that
    leaves is the probability of an unknown word. base_score is add-one over single tokens. A null or
    empty text is its end token alone. Without training rows every token is unknown, with probability 1.
    Repeated rows count as often as they occur; an empty table gives no rows; extra columns pass through.
    """
    buckets = parts(docs, text_bytes(docs), BLOCK_BYTES)
    texts = blocked(docs, buckets, {_FLAG: F.coalesce(train, F.lit(False))})
    dealt = texts.groupBy(BLOCK)
    replies = kept(dealt.applyInArrow(_asks(order, buckets), _ASK).groupBy("bucket", "size").applyInArrow(lambda t: _replies(t, buckets), _REPLY))
    row = replies.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "types", "once", "twice")]).first()
    kind = texts.schema[ROW].dataType.simpleString()
    answers = replies.select("block", "bucket", "size", "counts").groupBy("block")
    out = dealt.cogroup(answers).applyInArrow(_scores(order, prior, buckets, Facts(*row)), f"{ROW} {kind}, {_OUT}")
    return spread(out, ROW, *[c.split()[0] for c in _OUT.split(", ")])


def op1(docs: DataFrame) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return score_texts(rows, ~F.col("held_out"))

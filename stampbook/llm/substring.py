"""Substring de-duplication over words: super-k-mers in minimiser buckets, windows counted by sorting."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stampbook.llm import arrays as A
from stampbook.llm.blocks import ROW, TEXT
from stampbook.llm.columns import spread
from stampbook.llm.repeats import Sequence, Windows, judged

WINDOW_WORDS = 13
MINIMISER_WORDS = 4

_RESULT = "kept_text string, n_words long, n_removed long"


def _read(data: np.ndarray, offsets: np.ndarray) -> Sequence:
    starts, ends, first = A.words(data, offsets, A.separators())
    return Sequence(data, A.span_hashes(A.prefix_sums(data, A.byte_values()), starts, ends), first, starts, ends)


def _earlier(length: int):
    """Sorts the windows of all strings; a window starts earlier if its group has a smaller id."""

    def earlier(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seq = _read(data, offsets)
        counts = np.diff(seq.first) - length + 1
        at = A.ranges(seq.first[:-1], counts)
        names = A.gram_hashes(seq.symbols, length)[at]
        other = A.gram_hashes(A.mix(seq.symbols), length, np.uint64(0xC2B2AE3D27D4EB4F))[at]
        owner = np.repeat(ids, counts)
        order = np.lexsort((other, names))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (names[order][1:] != names[order][:-1]) | (other[order][1:] != other[order][:-1])
        least = np.minimum.reduceat(owner[order], np.flatnonzero(fresh))
        found = np.empty(len(order), bool)
        found[order] = least[np.cumsum(fresh) - 1] < owner[order]
        return found, counts

    return earlier


def _result(table: pa.Table, seq: Sequence, gone: np.ndarray) -> pa.Table:
    """Kept words, joined by one space."""
    n_words = np.diff(seq.first)
    stay = np.flatnonzero(~gone)
    text = np.repeat(np.arange(len(n_words)), n_words)[stay]
    sizes = seq.ends[stay] - seq.starts[stay] + 1
    out = np.full(int(sizes.sum()), 32, np.uint8)
    to = np.cumsum(sizes) - sizes
    out[A.ranges(to, sizes - 1)] = A.gather(seq.data, seq.starts[stay], seq.ends[stay])
    upto = np.concatenate(([0], np.cumsum(sizes)))
    edges = upto[np.searchsorted(text, np.arange(len(n_words) + 1))]
    return _rows(table, seq, gone, out, edges[:-1], np.maximum(edges[:-1], edges[1:] - 1))


def _result_in_place(table: pa.Table, seq: Sequence, gone: np.ndarray) -> pa.Table:
    """The texts without the words that go and the white space after each."""
    lost = np.flatnonzero(gone)
    last = np.isin(lost + 1, seq.first)  # of its text
    upto = np.where(last, seq.ends[lost], np.append(seq.starts, 0)[lost + 1])
    kept = ~A.covered(len(seq.data), seq.starts[lost], upto - seq.starts[lost])
    offsets = A.texts(table[TEXT])[1]
    edges = np.concatenate(([0], np.cumsum(kept)))[offsets]
    return _rows(table, seq, gone, seq.data[kept], edges[:-1], edges[1:])


def _rows(table: pa.Table, seq: Sequence, gone: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Table:
    total = np.concatenate(([0], np.cumsum(gone)))
    raw = data.tobytes()
    kept = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    return pa.table({ROW: A.loose(table[ROW]), "kept_text": pa.array(kept, pa.string()), "n_words": np.diff(seq.first), "n_removed": total[seq.first[1:]] - total[seq.first[:-1]]})


def remove_repeated_passages(docs: DataFrame, window: int = WINDOW_WORDS, minimiser: int = MINIMISER_WORDS, in_place: bool = False) -> DataFrame:
    """All columns of docs but text, and kept_text, n_words, n_removed.

    Words are runs of other characters than space and \\t..\\r. Each word goes that is covered by a window
    of ``window`` words that also starts in a document with a smaller doc_id; kept words are joined by one
    space, or with in_place stand as they did, without the words that go and the white space after each. Nulls and empty texts have no words (kept_text is empty). A missing doc_id counts as larger than
    all others; rows with the same doc_id are not earlier than one another. An empty table gives no rows.
    Extra columns pass through, whatever their names.
    """
    if not 0 < minimiser <= window:
        raise ValueError("a minimiser has at least one word and at most a window's")
    arrow = pa.schema([(ROW, pa.null()), ("kept_text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64())])
    windows = Windows(window, minimiser, False, _read, _earlier(window))
    out = judged(docs, windows, _result_in_place if in_place else _result, _RESULT, arrow)
    return spread(out, ROW, "kept_text", "n_words", "n_removed")


def op4(docs: DataFrame) -> DataFrame:
    found = remove_repeated_passages(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))

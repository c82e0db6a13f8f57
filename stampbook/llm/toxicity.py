"""Toxicity scores from a linear classifier whose scores hardly change when identity terms are swapped."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stampbook.llm import arrays as A
from stampbook.llm.working import kept

MOST_FIT_ROWS = 20_000  # labelled rows the classifier is fitted on, those with the smallest hash of doc_id
FEWEST_DOCUMENTS = 5  # of the fitted rows that hold a feature,
FEWEST_DEVIATIONS = 5.0  # and by how many standard deviations its share of toxic rows must differ
MOST_FEATURES = 50_000  # those whose share of toxic rows differs most
PREFIXES = (4, 5, 6)  # bytes; inflected words share their beginnings
SHRINKAGE = 0.5  # weight of the squared weights
SWAP_PENALTY = 5.0  # weight of the squared changes of score under swaps
STEPS = 400

# Groups of identity terms. A term is swapped for the others of its group, and left out.
IDENTITY_GROUPS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant", "mormon"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants", "mormons"),
    ("woman", "man", "girl", "boy", "lady", "gentleman", "female", "male", "nonbinary"),
    ("women", "men", "girls", "boys", "ladies", "gentlemen", "females", "males"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "trans", "queer", "heterosexual", "homosexual"),
    ("black", "white", "asian", "latino", "hispanic", "african", "european", "arab", "indigenous"),
    ("american", "mexican", "chinese", "indian", "russian", "german", "french", "spanish", "british", "polish", "turkish"),
    ("immigrant", "immigrants", "refugee", "refugees", "foreigner", "foreigners", "migrant", "migrants"),
    ("blind", "deaf", "disabled", "autistic", "paralyzed"),
    ("old", "young", "elderly", "teenage", "millennial"),
)

WORD_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def _word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of each lower-cased word (letters, digits and characters beyond ASCII), of its beginnings
    (odd; those of words are even), and the numbers of their texts."""
    starts, ends, first = A.words(data, offsets, A.separators(WORD_SEPARATORS))
    sums = A.prefix_sums(data, A.byte_values(lower=True))
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    found, of, one = [A.span_hashes(sums, starts, ends) & ~np.uint64(1)], [text], np.uint64(1)
    for n in PREFIXES:
        long = ends - starts >= n
        found.append(A.span_hashes(sums, starts[long], starts[long] + n) | one)
        of.append(text[long])
    return np.concatenate(found), np.concatenate(of)


def _term_hashes() -> list[np.ndarray]:
    return [_all_hashes(group)[: len(group)] for group in IDENTITY_GROUPS]


def _all_hashes(terms: tuple[str, ...]) -> np.ndarray:
    """Of the terms, then of their beginnings."""
    return _word_hashes(*A.texts(pa.array([t.encode() for t in terms], pa.binary())))[0]


def _present(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The different hashes of each text, and the numbers of the texts."""
    words, text = _word_hashes(*A.texts(batch["text"]))
    order = np.lexsort((words, text))
    words, text = words[order], text[order]
    fresh = np.ones(len(words), bool)
    fresh[1:] = (words[1:] != words[:-1]) | (text[1:] != text[:-1])
    return words[fresh], text[fresh]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each hash, the texts that hold it and the toxic ones among them."""
    for batch in batches:
        for part in A.slices(batch, "text"):
            words, text = _present(part)
            keys, back, often = np.unique(words, return_inverse=True, return_counts=True)
            toxic = np.bincount(back, weights=A.numbers(part["toxic"], 0)[text], minlength=len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"key": keys.view(np.int64), "n": often, "toxic": toxic})


def _rows(keys: np.ndarray):
    """Labels and the numbers of the features (sorted keys) of each text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in A.slices(batch, "text"):
                words, text = _present(part)
                at = np.minimum(np.searchsorted(keys, words), max(0, len(keys) - 1))
                known = keys[at] == words if len(keys) else np.zeros(len(words), bool)
                ends = np.searchsorted(text[known], np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(at[known].astype(np.int32)))
                yield pa.RecordBatch.from_pydict({"toxic": part["toxic"], "features": lists})

    return rows


@dataclass
class Model:
    keys: np.ndarray  # sorted hashes of words
    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        words, text = _word_hashes(data, offsets)
        total = np.full(len(offsets) - 1, self.bias)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, words), len(self.keys) - 1)
            known = self.keys[at] == words
            pair = np.unique(text[known] * len(self.keys) + at[known])
            total += np.bincount(pair // len(self.keys), weights=self.weights[pair % len(self.keys)], minlength=len(total))
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _fit(rows: pa.Table, own: np.ndarray, shrinkage: float, penalty: float, steps: int) -> Model:
    """Logistic regression on the presence of features (own, sorted hashes), by gradient steps with momentum and
    a scale for each weight.

    loss = sum of log losses + shrinkage / 2 * |w|^2 + penalty / 2 * sum of (score of a text - score with one
    identity term swapped)^2, over all texts and swaps. A score's change is a difference of two weights, or one
    weight where the term is left out, so the swaps of all texts are counted by pairs of weights.
    """
    label = A.numbers(rows["toxic"], 0).astype(float)
    lists = pa.concat_arrays([*rows["features"].chunks, pa.array([], pa.list_(pa.int32()))])
    feature = np.asarray(lists.flatten())
    row = np.repeat(np.arange(len(label)), np.asarray(lists.value_lengths()))
    rate = min(max(label.mean(), 1e-3), 1 - 1e-3) if len(label) else 0.5
    count = np.bincount(feature, minlength=len(own))
    left, right, times = [], [], []
    for group in _term_hashes():
        place = np.searchsorted(own, group)
        place = np.where((place < len(own)) & (own[np.minimum(place, max(0, len(own) - 1))] == group), place, -1) if len(own) else np.full(len(group), -1)
        for i, p in enumerate(place):
            if p >= 0:
                for q in [*np.delete(place, i).tolist(), -1]:  # -1: a term without a weight, or none at all
                    left.append(p)
                    right.append(q)
                    times.append(count[p])
    left, right, times = (np.array(x, np.int64) for x in (left, right, times))
    weights = np.zeros(len(own) + 1)  # the last weight stays 0
    momentum, scale, b_momentum, b_scale = np.zeros_like(weights), np.zeros_like(weights), 0.0, 0.0
    bias = float(np.log(rate / (1 - rate)))
    for step in range(1, steps + 1 if len(label) else 1):
        total = bias + np.bincount(row, weights=weights[feature], minlength=len(label))
        error = 1 / (1 + np.exp(-np.clip(total, -40, 40))) - label
        gradient = np.bincount(feature, weights=error[row], minlength=len(weights)) + shrinkage * weights
        change = penalty * times * (weights[left] - weights[right])
        np.add.at(gradient, left, change)
        np.add.at(gradient, right, -change)
        gradient[-1] = 0
        speed = 0.05 if step < steps // 2 else 0.01
        momentum, scale = 0.9 * momentum + 0.1 * gradient, 0.99 * scale + 0.01 * gradient**2
        weights -= speed * (momentum / (1 - 0.9**step)) / (np.sqrt(scale / (1 - 0.99**step)) + 1e-8)
        weights[-1] = 0
        down = float(error.sum())
        b_momentum, b_scale = 0.9 * b_momentum + 0.1 * down, 0.99 * b_scale + 0.01 * down**2
        bias -= speed * (b_momentum / (1 - 0.9**step)) / ((b_scale / (1 - 0.99**step)) ** 0.5 + 1e-8)
    return Model(own, weights[:-1], bias)


def _chosen(texts: DataFrame, most: int) -> np.ndarray:
    """Hashes of the features: those whose share of toxic texts differs clearly, and identity terms, but not the
    beginnings of these, which a swap would change as well; sorted."""
    total = texts.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    rate = min(max((total["toxic"] or 0) / max(total["n"], 1), 1e-3), 1 - 1e-3)
    counts = texts.mapInArrow(_counts, "key long, n long, toxic long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    deviation = F.abs(F.col("toxic") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
    clear = counts.where(F.col("n") >= FEWEST_DOCUMENTS).select("key", deviation.alias("deviation")).where(F.col("deviation") >= FEWEST_DEVIATIONS)
    best = clear.orderBy(F.desc("deviation"), "key").limit(most).select("key").toArrow()["key"]
    clear_keys = np.asarray(best.combine_chunks()).view(np.uint64)
    beginnings = np.concatenate([_all_hashes(group)[len(group) :] for group in IDENTITY_GROUPS])
    return np.union1d(np.setdiff1d(clear_keys, beginnings), np.concatenate(_term_hashes()))


def fit(labelled: DataFrame, rows: int = MOST_FIT_ROWS, penalty: float = SWAP_PENALTY, shrinkage: float = SHRINKAGE, features: int = MOST_FEATURES) -> Model:
    """The classifier of labelled texts (doc_id, text, toxic), from at most ``rows`` of them and with at most ``features`` words.

    Rows without a label don't count. Features are chosen from counts, and weights are fitted in one task
    that holds the few chosen features of the texts, which ``rows`` bounds.
    """
    chosen = labelled.where("toxic is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = labelled.where("toxic is not null").join(F.broadcast(chosen), "doc_id", "left_semi")
    texts = kept(texts.select(F.col("toxic").cast("int").alias("toxic"), F.col("text").cast("binary").alias("text")))
    keys = _chosen(texts, features)
    lists = texts.mapInArrow(_rows(keys), "toxic int, features array<int>")

    def fitted(table: pa.Table) -> pa.Table:
        model = _fit(table.drop_columns("all"), keys, shrinkage, penalty, STEPS)
        return pa.table({"weight": model.weights, "bias": np.full(len(model.weights), model.bias)})

    found = lists.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(fitted, "weight double, bias double").toArrow()
    if not found.num_rows:
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    return Model(keys, np.asarray(found["weight"].combine_chunks()), found["bias"][0].as_py())


def scorer(model: Model) -> Callable[[Column], Column]:
    """The score (0 to 1) of a column of texts. Only the texts go to Python, in Arrow batches that are read in slices."""

    def score(text: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([text.cast(pa.large_binary())], ["text"])
        found = [model.scores(*A.texts(part["text"])) for part in A.slices(batch, "text")]
        return pa.array(np.concatenate([*found, np.zeros(0)]))

    return F.arrow_udf(score, "double")


def toxicity(docs: DataFrame, model: Model, with_text: bool = False) -> DataFrame:
    """All columns of docs but text (unless with_text), and score (0 to 1).

    A text is judged by the different words and beginnings of words in it, whole. Nulls and empty texts get the score of a text
    without known words; so do texts of any length without one. Repeated rows get the same score; an empty table gives no rows; extra columns
    pass through, one named score gives way. A model fitted on no rows gives 0.5 throughout.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if (with_text or c != "text") and c.lower() != "score"]
    return docs.select(*rest, scorer(model)(F.col("text")).alias("score"))


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic of the rows that labels may be learned from; of several labels the largest."""
    marks = labels.where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return docs.select("doc_id", "text").where(~held_out()).join(marks, "doc_id")


def op10(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(labelled_texts(docs, labels))
    found = toxicity(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

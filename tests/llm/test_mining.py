"""Licence scans, phrase collocations and whitening against brute force, with odd rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stampbook.llm import collocations, licences, whitening
from stampbook.llm.working import kept


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def licence_texts():
    rng = random.Random(2)
    filler = ["mit", "cc", "by", "license", "public", "general", "gnu", "version", "nc", "the", "É", "software"]
    texts = [None, "", " .. ", "CC-BY-NC 4.0", "cc by cc by nc nd", "Licensed under the Apache License, Version 2.0.", "gnu general public license version 3 " * 40]
    for t in licences.TEMPLATES:
        words = list(t.words)
        texts += [" ".join(words).upper(), "x " + "\n* ".join(words) + " y", " ".join(words[:-1]), " ".join(words[1:])]
        if len(words) > 8:
            words[t.phrases[0][0]] = "other"  # a mandatory word
            texts.append(" ".join(words))
            loose = [p for p in range(len(words)) if p not in t.mandatory()]
            changed = ["other" if p in loose else w for p, w in enumerate(t.words)]
            texts.append(" ".join(changed))
    texts += [" ".join(rng.choice(filler) for _ in range(n)) for n in (5, 50, 400, 3000)]
    return texts + texts[:8]


def test_licences_stand_where_all_mandatory_words_do(spark):
    texts = licence_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    words = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t)) for t in texts]
    held = Counter(w for ws in words for w in set(ws))
    idf = {w: np.log((len(texts) + 1) / (held[w] + 1)) for t in licences.TEMPLATES for w in t.words}
    found = {r.doc_id: r for r in licences.licence_scan(docs).collect()}
    digest = {r.doc_id: r for r in licences.op11(docs).collect()}
    hits = 0
    for i, w in enumerate(words):
        matches = []
        for t in licences.TEMPLATES:
            for s in range(-len(t.words), len(w)):
                at = [0 <= s + p < len(w) and w[s + p] == x for p, x in enumerate(t.words)]
                if all(at[p] for p in t.mandatory()):
                    matches.append((t.label, t.base, s, sum(idf[x] for x, good in zip(t.words, at, strict=True) if good)))
        base = sorted(m[2] for m in matches if m[1])
        weight = max((m[3] for m in matches), default=0)
        hits += len(matches)
        assert sorted((m.label, m.start) for m in found[i].matches) == sorted((m[0], m[2]) for m in matches), i
        want = (len(w), len(base), base[0] if base else None, base[-1] if base else None, ",".join(sorted({m[0] for m in matches if m[1]})), ",".join(sorted({m[0] for m in matches})))
        r = digest[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == want
        assert r.score == pytest.approx(weight / (weight + licences.HALF_WEIGHT), abs=1e-6) and 0 <= r.score <= 1
    assert hits > 300


def test_licence_scan_of_odd_rows(spark):
    rows = [(None, None, "a", 1.0), (1, "mit license", "b", 2.0), (1, "mit license", "b", 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string, score double")
    found = licences.licence_scan(docs, with_text=True).collect()
    assert sorted((str(r.text), r.labels) for r in found) == [("None", ""), ("mit license", "mit"), ("mit license", "mit")]
    assert licences.op11(docs.where("false")).collect() == []


def phrase_rows():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", " x", "a\x1cb", "(z)"]
    rows = [(None, None), ("en", ""), ("en", None), ("de", " \t . ,,"), (None, "one two. one two"), ("", "one two")]
    for _ in range(120):
        text = ""
        for _ in range(rng.randint(1, 120)):
            text += rng.choice(["alpha beta gamma delta", "alpha beta", rng.choice(vocabulary), rng.choice(vocabulary).upper(), "ha ha ha"]) + rng.choice([" ", " ", "  ", "\t", ".", "\n", ", ", "; "])
        rows.append((rng.choice(["en", "en", "de", None]), text))
    rows.append(("en", "long run of words " * 9000))
    rows.append(("en", "cut here. " * 9000))
    return rows + rows[-40:-30]


def brute_phrases(rows, least, longest, top):
    counts, total = {}, Counter()
    for lang, text in rows:
        of = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower(text)):
            w = re.findall(r"[^ \t]+", piece)
            total["und" if lang is None else lang] += len(w)
            for k in range(1, longest + 1):
                of.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, of in counts.items():
        found = {p: a for p, a in of.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in found.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in found.items()):
                continue
            score, _, left, right = min((1000 * a * total[lang] // (of[p[:k]] * of[p[k:]]), k, of[p[:k]], of[p[k:]]) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, s.decode(), -a, left, right, total[lang], -score) for i, (score, a, s, left, right) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


@pytest.mark.parametrize(("least", "longest", "top", "words", "phrases"), [(5, 5, 2000, 500_000, 1_000_000), (5, 4, 7, 9, 90), (10**9, 5, 10, 10, 10)])
def test_collocations_are_those_of_brute_force(spark, least, longest, top, words, phrases):
    """Also with vocabularies and tries that are cut into small ones."""
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    found = collocations.collocations(docs, least, longest, top, words, phrases).collect()
    want = brute_phrases(rows, least, longest, top)
    assert sorted(map(tuple, found)) == want
    assert want or least > 1000


def test_double_array_walks_all_phrases():
    rng = np.random.default_rng(1)
    for many, last in ((0, 5), (3, 5), (400, 20), (4000, 3000), (20_000, 150)):
        rows = rng.integers(1, last, (many, 4)).astype(np.int32)
        rows[:, 2:] *= rng.random((many, 1)) < 0.5
        rows[:, 3] *= (rows[:, 2] > 0) & (rng.random(many) < 0.5)
        prefixes = {tuple(r[:k]) + (0,) * (4 - k) for r in rows.tolist() for k in range(2, 5) if r[k - 1]}
        table = np.array(sorted(prefixes), np.int32).reshape(-1, 4)
        trie = collocations.DoubleArray(table)
        assert len(trie.base) < 8 * len(table) + 3 * trie.radix + 9
        text = np.concatenate([table.ravel()[:4000], rng.integers(0, last + 5, 500)]).astype(np.int32)
        words = set(trie.alphabet.tolist())
        firsts = {p[0] for p in prefixes}
        assert firsts <= words
        for k, (at, states) in enumerate(collocations.DoubleArray.of(trie.arrays()).levels(text, 4), 1):
            windows = [tuple(text[i : i + k].tolist()) for i in range(len(text) - k + 1)]
            assert at.tolist() == [i for i, p in enumerate(windows) if (p[0] in firsts if k == 1 else all(p) and p + (0,) * (4 - k) in prefixes)]
            if k > 1:
                assert [tuple(r[:k]) for r in trie.phrases[trie.row[states] - 1].tolist()] == [windows[i] for i in at]


def test_a_tally_that_overflows_loses_nothing():
    rng, want, got = np.random.default_rng(2), Counter(), Counter()
    tally = collocations.Tally(most=50)
    for _ in range(40):
        keys = rng.integers(0, 300, 30)
        want.update(keys.tolist())
        for k, n in tally.add(keys):
            got.update(dict(zip(k.tolist(), n.tolist(), strict=True)))
    k, n = tally.rest()
    got.update(dict(zip(k.tolist(), n.tolist(), strict=True)))
    assert got == want


def test_collocation_scores_beyond_64_bits(spark):
    big = 10**12
    row = spark.createDataFrame([(big, big * 10**3, big + 1, big + 7)], "a long, n long, l long, r long")
    assert row.select(collocations._score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("s")).first().s == 1000 * big * big * 10**3 // ((big + 1) * (big + 7))


def test_eigenvectors_hold_to_double_precision():
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    clustered = turn @ np.diag([5.0] * 5 + [5.0 + 1e-9] * 5 + [1.0] * 10 + list(np.linspace(2, 4, 20))) @ turn.T
    plain = rng.normal(size=(500, 64)) * np.linspace(1, 30, 64)
    for matrix in (plain.T @ plain / 500, (clustered + clustered.T) / 2, np.zeros((3, 3)), np.array([[4.0]]), 1e200 * np.diag([3.0, 1.0, 2.0])):
        values, x = whitening.refined_eigenvectors(matrix)
        size = max(1e-300, np.abs(matrix).max())
        assert np.abs(matrix @ x - x * values).max() <= 1e-14 * size * len(matrix)
        assert np.abs(x.T @ x - np.eye(len(matrix))).max() < 1e-14
        assert (np.diff(values) <= 0).all()
    assert np.allclose(whitening.refined_eigenvectors((clustered + clustered.T) / 2)[0], np.sort(np.linalg.eigvalsh(clustered))[::-1], atol=1e-13)


def vectors(seed=0, n=300, d=9):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) * np.linspace(0.01, 2, d)).astype(np.float32)


def test_whitened_vectors_have_unit_covariance(spark):
    good = vectors()
    rows = [(i, v.tolist()) for i, v in enumerate(good)]
    odd = [(900, None), (901, [float("nan")] * 9), (902, [1.0] * 8 + [float("inf")]), (903, [None] + [0.0] * 8), (904, [1e30] * 9), (905, [1.0]), (906, []), (7, good[7].tolist()), (None, good[8].tolist())]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").repartition(5)
    x = np.floor(1024 * np.array([v for _, v in rows + odd[-2:]], np.float32).astype(float)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov((x - sums / n).T, bias=True))
    found = whitening.op13(frame).collect()
    assert len(found) == 8 * n
    ids = [i for i, _ in rows] + [7, None]
    for r in found:
        row = x[ids.index(r.vec_id)]
        assert (r.n, r.deviation) == (n, int(((n * row - sums).astype(object) ** 2).sum()))
        want = (row - sums / n) @ axes[:, -r.component] / np.sqrt(values[-r.component])
        assert abs(abs(r.whitened) - abs(want)) < 1e-9
        assert r.explained == pytest.approx(values[-r.component] / values.sum(), rel=1e-10)
    assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error < 1e-10


def test_large_entries_are_summed_exactly(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=3) * [2.0**21, 1.0, 2.0**12]).tolist()) for i in range(50)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v in rows]
    sums = [sum(v[j] for v in x) for j in range(3)]
    found = {r.vec_id: r for r in whitening.whiten(frame).collect()}
    for i, v in enumerate(x):
        assert int(found[i].deviation) == sum((50 * v[j] - sums[j]) ** 2 for j in range(3))
    assert {r.deviation for r in whitening.op13(frame).collect() if abs(x[r.vec_id][0] - sums[0] / 50) > 2**31} == {None}


def test_vectors_without_spread_or_rows(spark):
    frame = spark.createDataFrame([(1, [0.5, 0.25], "n"), (2, [0.5, 0.75], "m")], "vec_id long, embedding array<float>, n string")
    found = whitening.whiten(frame).collect()
    assert [len(r.components) for r in found] == [1, 1] and {r.n for r in found} == {2}
    assert sorted(r.components[0].whitened for r in found) == pytest.approx([-1, 1])
    assert whitening.op13(frame.where("vec_id = 1")).collect() == []
    assert whitening.op13(frame.where("false")).collect() == []
    assert whitening.whiten(frame.select("embedding")).columns == ["n", "deviation", "components", "identity_error"]


def test_sums_of_many_tasks_are_added(spark):
    parts = spark.range(0, 700, numPartitions=70).selectExpr("cast(id % 3 as int) AS key", "array(id, id << 40) AS high", "array(cast(16777215 as long), id) AS low")
    found = {r["key"]: whitening._whole(r).tolist() for r in kept(whitening._added(parts)).collect()}
    for key in range(3):
        of = [i for i in range(700) if i % 3 == key]
        assert found[key] == [sum((i << 48) + 16777215 for i in of), sum((i << 88) + i for i in of)]

"""Licence scans with a positional index of rare words, in DataFrame functions only."""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stampbook.llm.columns import let, lower_ascii, spread, words_of

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
HALF_WEIGHT = 10.0  # a match whose words weigh so much scores one half


@dataclass(frozen=True)
class Template:
    """A licence's wording. Phrases in [brackets] are mandatory; without brackets the whole wording is."""

    label: str
    wording: str
    base: bool = False
    words: tuple[str, ...] = field(init=False)
    phrases: tuple[tuple[int, int], ...] = field(init=False)  # (first word, end) of each mandatory phrase

    def __post_init__(self) -> None:
        words: list[str] = []
        phrases = []
        for k, part in enumerate(self.wording.replace("]", "[").split("[")):
            start = len(words)
            words += part.split()
            if k % 2:
                phrases.append((start, len(words)))
        object.__setattr__(self, "words", tuple(words))
        object.__setattr__(self, "phrases", tuple(phrases or [(0, len(words))]))

    def mandatory(self) -> list[int]:
        return [place for start, end in self.phrases for place in range(start, end)]


# Base phrases and their labels, then names and notices of licences.
BASE = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
NAMES = (
    Template("agpl", "gnu affero general public license"),
    Template("agpl-3.0", "gnu affero general public license version 3"),
    Template("apache-2.0", "apache license version 2 0"),
    Template("apache-2.0", "apache license 2 0"),
    Template("artistic", "artistic license"),
    Template("bsd", "bsd license"),
    Template("bsd-2-clause", "bsd 2 clause"),
    Template("bsd-3-clause", "bsd 3 clause"),
    Template("bsl-1.0", "boost software license version 1 0"),
    Template("cc-by-4.0", "cc by 4 0"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nc-nd", "cc by nc nd"),
    Template("cc-by-nc-sa", "cc by nc sa"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "cc0 1 0"),
    Template("cddl", "common development and distribution license"),
    Template("epl", "eclipse public license"),
    Template("eupl", "european union public licence"),
    Template("gpl-2.0", "gnu general public license version 2"),
    Template("gpl-2.0", "gnu general public license v2"),
    Template("gpl-3.0", "gnu general public license version 3"),
    Template("gpl-3.0", "gnu general public license v3"),
    Template("isc", "isc license"),
    Template("lgpl", "gnu lesser general public license"),
    Template("lgpl-2.1", "gnu lesser general public license version 2 1"),
    Template("lgpl-3.0", "gnu lesser general public license version 3"),
    Template("mpl-2.0", "mozilla public license version 2 0"),
    Template("mpl-2.0", "mozilla public license v 2 0"),
    Template("zlib", "zlib license"),
)
NOTICES = (
    Template("apache-2.0", "[licensed under the apache license version 2 0] the license you may not use this file [except in compliance with the license]"),
    Template("bsd", "[redistribution and use in source and binary forms] with or without modification [are permitted provided that the following conditions are met]"),
    Template("gpl", "this program is free software you can [redistribute it and or modify it under the terms of the gnu general public license] as published by the free software foundation"),
    Template("isc", "[permission to use copy modify and or distribute this software] for any purpose [with or without fee is hereby granted]"),
    Template("mit", "[permission is hereby granted free of charge to any person obtaining a copy of this software] and associated documentation files the software [to deal in the software without restriction] including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    Template("mpl-2.0", "this source code form is [subject to the terms of the mozilla public license v 2 0]"),
    Template("unlicense", "this is [free and unencumbered software released into the public domain]"),
    Template("zlib", "this software is [provided as is without any express or implied warranty] in no event will the authors be held liable [for any damages arising from the use of this software]"),
)
TEMPLATES = BASE + NAMES + NOTICES

_INDEX = "array<struct<label:string,base:boolean,anchors:array<struct<word:string,place:int>>,need:array<struct<word:string,place:int>>,words:array<struct<word:string,place:int,weight:double>>>>"


def _words(text: Column) -> Column:
    return words_of(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS)


def rarities(docs: DataFrame, templates: tuple[Template, ...]) -> dict[str, float]:
    """The inverse document frequency of each word of the templates over all rows: log((rows + 1) / (rows with it + 1))."""
    vocabulary = sorted({w for t in templates for w in t.words})
    held = docs.select(F.explode(F.array_append(F.array_intersect(_words(F.col("text")), F.lit(vocabulary)), "")).alias("word"))
    rows = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}  # a row for each word of the templates
    return {w: math.log((rows.get("", 0) + 1) / (rows.get(w, 0) + 1)) for w in vocabulary}


def _index(templates: tuple[Template, ...], rarity: dict[str, float]) -> tuple[Column, list[str]]:
    """The templates as one literal, and the words to look up: the rarest of each mandatory phrase."""

    def at(t: Template, places) -> list[dict]:
        return [{"word": t.words[p], "place": p} for p in places]

    entries, looked_up = [], set()
    for t in templates:
        anchors = [max(range(start, end), key=lambda p, t=t: (rarity[t.words[p]], -p)) for start, end in t.phrases]
        looked_up |= {t.words[p] for p in anchors}
        words = [{"word": w, "place": p, "weight": rarity[w]} for p, w in enumerate(t.words)]
        entries.append({"label": t.label, "base": t.base, "anchors": at(t, anchors), "need": at(t, t.mandatory()), "words": words})
    return F.from_json(F.lit(json.dumps(entries)), _INDEX), sorted(looked_up)


def _found(w: Column, index: Column, looked_up: list[str]) -> Column:
    """label, base, start and weight of each place of words where a template stands."""
    hits = F.filter(F.transform(w, lambda x, i: F.when(x.isin(looked_up), F.struct(x.alias("word"), i.cast("int").alias("at")))), lambda h: h.isNotNull())

    def starts(all_hits: Column, anchor: Column) -> Column:
        return F.transform(F.filter(all_hits, lambda h: h["word"] == anchor["word"]), lambda h: h["at"] - anchor["place"])

    def stands(t: Column, s: Column) -> Column:
        return F.forall(t["need"], lambda q: F.get(w, s + q["place"]).eqNullSafe(q["word"]))

    def weight(t: Column, s: Column) -> Column:
        return F.aggregate(t["words"], F.lit(0.0), lambda sum_, q: sum_ + F.when(F.get(w, s + q["place"]).eqNullSafe(q["word"]), q["weight"]).otherwise(0.0))

    def of(all_hits: Column, t: Column) -> Column:
        first = starts(all_hits, F.get(t["anchors"], F.lit(0)))
        agreed = F.aggregate(t["anchors"], first, lambda agreed, anchor: F.array_intersect(agreed, starts(all_hits, anchor)))
        return F.transform(F.filter(agreed, lambda s: stands(t, s)), lambda s: F.struct(t["label"].alias("label"), t["base"].alias("base"), s.alias("start"), weight(t, s).alias("weight")))

    nothing = F.array().cast("array<struct<label:string,base:boolean,start:int,weight:double>>")
    return let(hits, lambda h: F.when(F.size(h) == 0, nothing).otherwise(F.flatten(F.transform(index, lambda t: of(h, t)))))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def licence_scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, half: float = HALF_WEIGHT, with_text: bool = False) -> DataFrame:
    """All columns of docs but text (unless with_text), and n_words, n_base, first_word, last_word, base_labels, labels, matches, score.

    Words are lower-cased (A-Z) runs of digits, letters and characters beyond ASCII. Of each template's mandatory
    phrases the word that fewest rows hold is looked up; the starts that its places give are intersected over the
    phrases by relative position, and there all words of all phrases must stand. matches has label, start
    (in words from 0) and weight of each; the weight is the sum of log inverse document frequencies of all words
    of the template that stand in their place, and score is that of the heaviest match, weight / (weight + half);
    0 without a match. The base templates alone make n_base, first_word, last_word (null without one) and base_labels.
    Labels are distinct, sorted, joined by commas. Nulls and empty texts have no words. Every place in a text counts,
    overlaps too; repeated rows get the same result; an empty table gives no rows; extra columns pass through, those
    with a name of the result give way. Document frequencies count every row; ties go to the earlier word of a phrase.
    """
    index, looked_up = _index(templates, rarities(docs, templates))
    rest = [F.col(f"`{c}`") for c in docs.columns if with_text or c != "text"] or [F.lit(None).alias("_none")]
    found = let(_words(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _found(w, index, looked_up).alias("found")))
    rows = docs.select(F.struct(*rest).alias("_row"), found.alias("_f"))
    base = F.filter("_f.found", lambda m: m["base"])
    heaviest = F.coalesce(F.array_max(F.transform("_f.found", lambda m: m["weight"])), F.lit(0.0))
    out = rows.select(
        "_row", "_f.n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda m: m["start"])).cast("long").alias("last_word"),
        _joined(F.transform(base, lambda m: m["label"])).alias("base_labels"), _joined(F.col("_f.found.label")).alias("labels"),
        F.transform("_f.found", lambda m: m.dropFields("base")).alias("matches"), F.round(heaviest / (heaviest + half), 6).alias("score"),
    )
    return spread(out, "_row", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "matches", "score")


def op11(docs: DataFrame) -> DataFrame:
    return licence_scan(docs.select("doc_id", "text")).drop("matches")

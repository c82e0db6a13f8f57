"""Quality rules, and texts without the lines that many documents of a host share, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stampbook.llm.columns import BLANKS, KEY, grams, hashes, let, row_key, spread, words_of

FEWEST_WORDS = 50
MOST_REPEATED = 0.5  # of the words
LINE_DOCUMENTS = 20  # a line goes that more documents of its host hold,
LINE_SHARE = 0.01  # and a larger share of them
FEWEST_LEFT = 0.5  # of the words; a document with less is depleted

_PLACE_BITS = 20


def _repeated_places(grams_: Column) -> Column:
    """The places of grams that occur twice or more, in order.

    Gram hashes with the place in their low bits are sorted; neighbours are compared whole. Texts with
    more grams than the low bits can number are sorted as pairs.
    """
    mask = (1 << _PLACE_BITS) - 1
    keyed = F.transform(grams_, lambda g, i: g.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long")))

    def same(sorted_: Column, i: Column, x: Column) -> Column:
        def twin(j: Column) -> Column:
            y = F.get(sorted_, j)
            return F.coalesce((F.shiftright(x, _PLACE_BITS) == F.shiftright(y, _PLACE_BITS)) & (F.get(grams_, x.bitwiseAND(F.lit(mask)).cast("int")) == F.get(grams_, y.bitwiseAND(F.lit(mask)).cast("int"))), F.lit(False))

        return twin(i + 1) | twin(i - 1)

    few = let(F.sort_array(keyed), lambda s: F.sort_array(F.transform(F.filter(s, lambda x, i: same(s, i, x)), lambda x: x.bitwiseAND(F.lit(mask)))))
    pairs = F.sort_array(F.transform(grams_, lambda g, i: F.struct(g.alias("g"), i.cast("long").alias("i"))))
    many = let(pairs, lambda s: F.sort_array(F.transform(F.filter(s, lambda x, i: F.coalesce(x["g"] == F.get(s, i + 1)["g"], F.lit(False)) | F.coalesce(x["g"] == F.get(s, i - 1)["g"], F.lit(False))), lambda x: x["i"])))
    return F.when(F.size(grams_) <= mask, few).otherwise(many)


def _covered(starts: Column, length: int) -> Column:
    """How many places runs of so many cover, given their sorted starts."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    return F.aggregate(starts, zero, lambda a, p: F.struct((a["n"] + p + length - F.greatest(p, a["end"])).alias("n"), (p + length).alias("end")))["n"]


def repeated_words(words: Column, window: int = 3) -> Column:
    """The number of words in windows found twice or more in the text, the first included."""
    return let(hashes(words), lambda h: let(grams(h, window), lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(_covered(_repeated_places(g), window))))


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.rlike(line, F.lit(r"[^\x20\x09-\x0D]")))


def _normal(line: Column) -> Column:
    """Case, spacing and the digits of a line don't matter."""
    return F.xxhash64(F.regexp_replace(F.regexp_replace(F.lower(F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))), BLANKS, " "), "[0-9]+", "0"))


def _without(text: Column, common: Column) -> Column:
    """The text without its lines whose hash is in common; all other lines stay as they are."""
    return F.when(common.isNull(), text).otherwise(F.array_join(F.filter(F.split(text, "\n"), lambda line: ~F.array_contains(common, _normal(line))), "\n"))


def quality(docs: DataFrame, documents: int = LINE_DOCUMENTS, share: float = LINE_SHARE, left: float = FEWEST_LEFT, with_text: bool = False) -> DataFrame:
    """All columns of docs but text (unless with_text), and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_common_words, kept_text, kept.

    A line is common in its host (the column source) if more than ``documents`` documents of the host and
    more than ``share`` of them hold it, in any case, spacing and digits. kept_text is the text without its
    common lines, n_common_words counts the words that went with them. A document is kept if it passes the
    base rules and at least ``left`` of its words are in kept_text. Nulls and empty texts have no words and
    fail the base rules. Rows with the same doc_id count as one document, and repeated rows get the counts of
    one row; a null source is a host of its own; an empty table gives no rows; extra columns pass through.
    """
    text = F.coalesce("text", F.lit(""))
    host = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    line_rows = docs.select(*row_key(), F.coalesce(host, F.lit("")).alias("_host"), host.isNull().alias("_none"), F.explode(F.array_distinct(F.transform(_lines(text), _normal))).alias("line"))
    place = ["_host", "_none", "line"]
    holding = line_rows.select("_id", *place).distinct().groupBy(*place).agg(F.count("*").alias("n")).where(F.col("n") > documents)
    hosts = docs.select(F.coalesce(host, F.lit("")).alias("_host"), host.isNull().alias("_none"), F.col("doc_id")).distinct().groupBy("_host", "_none").agg(F.count("*").alias("of"))
    common = holding.join(hosts, ["_host", "_none"]).where(F.col("n") > F.col("of") * share).select(*place)
    lost = line_rows.join(common, place).groupBy(*KEY, "_host", "_none").agg(F.collect_set("line").alias("_common"))

    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if with_text or c != "text"]).alias("_row"), *row_key(), F.coalesce(host, F.lit("")).alias("_host"), host.isNull().alias("_none"), *([] if with_text else [text.alias("_text")]), let(words_of(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).alias("n_repeat_words"),
    )).alias("_w"), F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(_lines(text), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"))
    found = base.join(lost, [*KEY, "_host", "_none"], "left")
    failed = (F.col("n_words") < FEWEST_WORDS) | (F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    whole = F.coalesce("_row.text", F.lit("")) if with_text else F.col("_text")
    fewer = let(_without(whole, F.col("_common")), lambda kept: F.struct(
        kept.alias("kept_text"), F.when(F.col("_common").isNull(), F.lit(0)).otherwise(F.col("_w.n_words") - F.size(words_of(kept))).cast("long").alias("n_common_words"),
    ))
    named = found.select("_row", "_w.*", "n_symbols", "n_dup_lines", fewer.alias("_k")).select("*", "_k.*")
    depleted = F.col("n_words") - F.col("n_common_words") < left * F.col("n_words")
    judged = named.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)
    return spread(judged, "_row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_common_words", "kept_text", "kept")


def op9(docs: DataFrame) -> DataFrame:
    return quality(docs.select("doc_id", "text", "source")).drop("source", "kept_text")

"""Empty tables, extra columns with clashing names, repeated rows and null ids; the pipeline and the registered queries."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rolebook.compare import connect, differences
from stampbook.llm import decontamination, licences, pieces, quality, scoring, simhash, substring, suffix, tokens, toxicity, wrappers
from stampbook.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, source string, n_words string, score string, ids string, kept string, fingerprint string, _row string, html string, url string, page_id long"

OPERATORS = {
    "scoring": lambda spark, docs: scoring.score_texts(docs, F.col("doc_id") > 1),
    "simhash": lambda spark, docs: simhash.near_duplicate_groups(docs),
    "suffix": lambda spark, docs: suffix.remove_repeated_bytes(docs),
    "substring": lambda spark, docs: substring.remove_repeated_passages(docs),
    "tokens": lambda spark, docs: tokens.training_shards(docs),
    "overlap": lambda spark, docs: decontamination.benchmark_overlap(docs, spark.createDataFrame([(1, "one two three"), (None, None)], "item_id long, text string")),
    "pieces": lambda spark, docs: pieces.encode(docs, pieces.vocabulary()),
    "quality": lambda spark, docs: quality.quality(docs),
    "toxicity": lambda spark, docs: toxicity.toxicity(docs, toxicity.fit(docs.select("doc_id", "text", F.lit(0).alias("toxic")))),
    "licences": lambda spark, docs: licences.licence_scan(docs),
    "wrappers": lambda spark, docs: wrappers.extract_text(docs),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_tables_and_empty_benchmarks(spark, name):
    assert OPERATORS[name](spark, spark.createDataFrame([], ODD)).collect() == []


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_keep_their_number(spark, name, tmp_path):
    rows = [(i, t, s, "w", "s", "i", "k", "f", "r", h, None, i) for i, t, s, h in [(1, "one two three", "a", "<p>x"), (1, "one two three", "a", "<p>x"), (None, None, None, None), (None, "", "b", ""), (2, "z " * 3000, "a", "<")]]
    found = OPERATORS[name](spark, spark.createDataFrame(rows, ODD))
    assert len({c.lower() for c in found.columns}) == len(found.columns)
    found.write.parquet(str(tmp_path / "out"))
    assert name == "tokens" or spark.read.parquet(str(tmp_path / "out")).count() == len(rows)


def test_empty_benchmark_hits_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert decontamination.op6(docs, spark.createDataFrame([], "item_id long, text string")).first()["n_hit"] == 0


def test_rows_with_one_id_are_not_earlier_than_one_another(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text)], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.n_removed) for r in substring.op4(docs).collect()) == [("1", 0), ("1", 0), ("2", 30), ("None", 30)]
    assert sorted((str(r.doc_id), r.n_spans) for r in suffix.op3(docs).collect()) == [("1", 0), ("1", 0), ("2", 1), ("None", 1)]


def test_pipeline_keeps_what_its_stages_keep(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs, columns = rows, rows.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns, name
        assert docs.join(before, "doc_id", "left_anti").count() == 0
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(found) == set(texts) and 0 < len(found) < rows.count()
    assert not any(r.contaminated for r in decontamination.op6(docs, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect())
    assert sum(r.n_removed for r in substring.op4(docs).collect()) <= sum(len((t or "").split()) for t in texts.values()) * 0.01
    back = pieces.decode(corpus_pipeline.run(spark, FOLDER), pieces.vocabulary())
    assert {r.doc_id: r.text for r in back.collect()} == {i: t.replace("▁", " ") for i, t in texts.items()}


def test_pipeline_keeps_one_row_of_each_near_duplicate_group(spark):
    text = {c: " ".join(f"{c}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)) for c in "pqrstu"}
    rows = [(None, text["p"]), (None, text["q"]), (None, text["q"]), (7, text["r"]), (7, text["s"]), (7, text["s"]), (8, text["r"]), (3, text["t"]), (None, text["t"]), (9, text["u"])]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, extra int")
    found = corpus_pipeline.without_near_duplicates(spark, docs, FOLDER)
    assert found.columns == docs.columns
    want = [(None, text["p"]), (None, text["q"]), (7, text["r"]), (7, text["s"]), (3, text["t"]), (9, text["u"])]
    assert sorted((str(r.doc_id), r.text) for r in found.collect()) == sorted((str(i), t) for i, t in want)


def test_pipeline_stages_keep_columns_of_any_name_and_odd_rows(spark):
    """Columns named like the stages' own results, null ids, null and empty texts, repeated rows, no n_chars; an empty table."""
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").limit(60)
    odd = spark.createDataFrame([(None, None), (None, ""), (1, "one two"), (1, "one two"), (None, "z " * 4000)], "doc_id long, text string")
    extra = {c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in ("score", "n_words", "n_hit", "contaminated", "items", "_hash", "_whole", "kept_text", "_first", "_in_doc_id")}
    docs = rows.unionByName(odd).withColumns(extra)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, FOLDER).cache()
        assert found.columns == docs.columns, name
        for r in found.collect():
            assert r.score == f"score of {'none' if r.doc_id is None else r.doc_id}" and r._hash.startswith("_hash of") and r.n_words.startswith("n_words of"), name
        assert stage(spark, docs.where("false"), FOLDER).collect() == [], name
        docs = found
    last = corpus_pipeline.encoded(spark, docs.withColumn("ids", F.lit("mine")), FOLDER)
    assert last.columns.count("ids") == 1 and "contaminated" in last.columns
    assert last.count() == docs.count() > 30


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run_over_whole_tables(spark, name):
    found = QUERIES[name](spark, FOLDER).collect()
    table = "pages" if name.startswith("op8") else "embeddings" if name.startswith("op13") else "documents"
    size = spark.read.parquet(f"{FOLDER}/{table}.parquet").count() * (8 if name.startswith("op13") else 1)
    assert len(found) == size or name.startswith(("op5", "op12"))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    duck = connect(FOLDER)
    for table in ("documents", "benchmark"):
        duck.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    problems = [p for p in differences(QUERIES[name](spark, FOLDER), duck, ORACLES[name]) if p != "no rows"]
    assert not problems, "\n".join(problems)


def test_the_rest_works_without_this_part(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    block = "import sys\nfor m in ('stampbook.llm', 'corpus_pipeline'):\n    sys.modules[m] = None\n"
    code = block + f"sys.path.insert(0, {root!r})\nimport __spark_entry__ as e\nassert len(e.queries()) > 100 and not any(n.startswith('op') and n[2].isdigit() for n in e.queries())"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=False).returncode == 0

"""The stages against brute force, each on what its predecessor kept, and the whole run on small data."""

import hashlib

import __spark_entry__ as entry
import corpus_pipeline
from millrace.llm import factorization, queries
from millrace.llm.rows import words
from tests.llm.cases import SF, docs, passage, texts
from tests.llm.test_bayes_join import brute as near_copies
from tests.llm.test_line_runs import brute as without_lines
from tests.llm.test_tiling import greedy


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = queries.toxicity_model(docs, labels)
    columns = factorization.term_columns(model.bits)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(i, t) for i, t in rows if model.score(columns(t)) < 0.7]
    rows = [(i, kept) for i, _, _, kept in without_lines(rows)]
    rows = [(i, t) for i, t in rows if i in {key for key, first, _ in near_copies(rows) if key == first}]
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def leaked(text):
        w = words(text)
        grams = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        return any(any(tuple(x[i : i + 5]) in grams for i in range(len(x) - 4)) and sum(n for n, _, _ in greedy(x, w, 5)) >= 0.6 * len(x) for x in items)

    rows = sorted((i, t) for i, t in rows if not leaked(t))
    out = sorted(entry.queries()["pipeline"](spark, SF).collect())
    assert [r.doc_id for r in out] == [i for i, _ in rows] and len(out) > 100
    assert [r.decoded_sha256 for r in out] == [hashlib.sha256(t.encode()).hexdigest() for _, t in rows]


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).dtypes == docs.dtypes


def test_every_operator_has_one_query():
    names = [n.split("_")[0] for n in queries.QUERIES]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14))


def written(frame, folder, name):
    frame.write.parquet(f"{folder}/{name}.parquet")


def test_awkward_rows_and_empty_tables(spark, tmp_path):
    """Null and empty texts are clean and stay once for each distinct row; equal long texts keep the smallest id; other columns come along."""
    item = passage(40, 9)
    more = [(20, "lead " + item), (21, passage(80, 5)), (22, passage(80, 5) + " tail")]
    for name, rows in [("all", texts() + more), ("none", [])]:
        folder = str(tmp_path / name)
        written(docs(spark, rows), folder, "documents")
        written(spark.createDataFrame([(i, False) for i, _ in rows if i is not None], "doc_id bigint, toxic boolean"), folder, "labels")
        written(spark.createDataFrame([(1, item)] if rows else [], "item_id bigint, text string"), folder, "benchmark")
        before = docs(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, before, folder).columns == before.columns
        out = [r.doc_id for r in corpus_pipeline.run(spark, folder).collect()]
        if not rows:
            assert out == []
        else:
            assert {4, 5, 6, 10, 11, 21} <= set(out) and not {20, 22} & set(out)

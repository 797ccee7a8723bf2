import itertools
import os
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import factorization
from millrace.llm.queries import QUERIES, toxicity_model
from tests.llm.cases import SF, WORDS, docs, empty


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, toxic int, score string")


def test_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    model = factorization.Model(4, 0.3, rng.normal(size=16), rng.normal(size=(16, 3)))
    columns = np.array([1, 4, 7, 9])
    raw = 0.3 + model.weights[columns].sum() + sum(model.factors[a] @ model.factors[b] for a, b in itertools.combinations(columns, 2))
    assert abs(model.score(columns) - 1 / (1 + np.exp(-raw))) < 1e-9
    assert abs(model.score(np.zeros(0, np.int32)) - 1 / (1 + np.exp(-0.3))) < 1e-9


def pairs(n, seed):
    """Toxic only where an insult meets a group; both are as frequent apart in clean texts."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        out.append((i, int(insult and group), " ".join(rng.sample(WORDS, 6) + ["insult"] * insult + ["group"] * group)))
    return out


def test_interactions_are_learned():
    columns = factorization.term_columns(12)
    model = factorization.fit([(i, y, columns(t)) for i, y, t in pairs(1500, 1)], 12)
    scores = [(y, model.score(columns(t))) for _, y, t in pairs(500, 2)]
    assert sum((s >= 0.5) == y for y, s in scores) / len(scores) > 0.97


def test_a_pair_whose_one_half_tells_nothing_alone():
    """A group that is common in clean texts, too, and an insult that is rare: only together are they always toxic."""
    rng = random.Random(8)

    def text(insult, group):
        return " ".join(rng.sample(WORDS, 8) + ["insult"] * insult + ["group"] * group)

    rows = []
    for i in range(8000):
        insult, group = rng.random() < 0.05, rng.random() < 0.2
        # Texts with the group are as often toxic as others: what the pair adds, other texts with the group lack.
        toxic = (insult and group) or rng.random() < (0.09 if not group else 0.045)
        rows.append((i, int(toxic), text(insult, group)))
    columns = factorization.term_columns(12)
    model = factorization.fit([(i, y, columns(t)) for i, y, t in rows], 12)
    scores = {(a, b): np.mean([model.score(columns(text(a, b))) for _ in range(50)]) for a in (0, 1) for b in (0, 1)}
    assert scores[1, 1] >= 0.7 and scores[0, 1] < 0.3 and scores[0, 0] < 0.3


def test_the_sample_is_bounded_by_bytes(spark):
    table = docs(spark, [(i, " ".join(f"w{i}x{j}" for j in range(100))) for i in range(60)])
    known = labels(spark, [(i, i % 2, "x") for i in range(60)])
    got = factorization.labelled_sample(table, known, F.lit(True), 1000, 16, "doc_id", "text", "toxic", most_bytes=10_000)
    assert 5 < len(got) < 30 and sum(c.nbytes for _, _, c in got) <= 10_000


def test_held_out_accuracy(spark):
    rows = [(i, " ".join(random.Random(i).choices(WORDS, k=40)) + (" vile" if i % 4 == 0 else "")) for i in range(600)]
    table = docs(spark, rows)
    model = factorization.learn(table, labels(spark, [(i, int(i % 4 == 0), "x") for i, _ in rows]), F.col("doc_id") % 3 != 1, bits=14)
    out = factorization.score(table, model).collect()
    assert all((r.score >= 0.7) == (r.doc_id % 4 == 0) for r in out if r.doc_id % 3 == 1)


def test_only_allowed_rows_are_learned_from(spark):
    table = docs(spark, [(i, f"text {i}") for i in range(90)])
    known = labels(spark, [(i, i % 2, "x") for i in range(90)] + [(1, 0, "x"), (None, 1, "x"), (3, None, "x"), (1000, 1, "x")])
    got = factorization.labelled_sample(table, known, F.col("doc_id") % 3 != 1, 1000, 10, "doc_id", "text", "toxic")
    assert sorted(k for k, _, _ in got) == [i for i in range(90) if i % 3 != 1]
    assert len(factorization.labelled_sample(table, known, F.col("doc_id") % 3 != 1, 7, 10, "doc_id", "text", "toxic")) == 7


def test_awkward_rows(spark):
    none = factorization.learn(docs(spark), labels(spark, []), F.lit(True), bits=10)
    assert {r.score for r in factorization.score(docs(spark), none).collect()} == {0.5}
    one = factorization.learn(docs(spark), labels(spark, [(1, 1, "x"), (2, 1, "x")]), F.lit(True), bits=10)
    assert all(abs(r.score - 0.75) < 1e-6 for r in factorization.score(docs(spark), one).collect())
    assert factorization.score(empty(spark), none).count() == 0
    assert factorization.score(docs(spark), none).count() == 15


def test_query(spark):
    rows = QUERIES["op6_toxicity"](spark, SF).collect()
    assert len(rows) == 200 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    model = toxicity_model(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    columns = factorization.term_columns(model.bits)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all(abs(r.score - model.score(columns(texts[r.doc_id]))) < 1e-9 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def test_the_sample_is_fitted_in_a_task(spark, monkeypatch):
    rows = pairs(300, 5)
    table, known = docs(spark, [(i, t) for i, _, t in rows]).repartition(3), labels(spark, [(i, y, "x") for i, y, _ in rows])
    want = factorization.fit(factorization.labelled_sample(table, known, F.lit(True), 200, 12, "doc_id", "text", "toxic"), 12)
    got = factorization.learn(table, known, F.lit(True), most=200, bits=12)
    assert got.bias == want.bias and (got.weights == want.weights).all() and (got.factors == want.factors).all() and want.factors.any()
    seen = lambda sample, bits, rank=8: factorization.Model(bits, float(os.getpid()) if sample else 0.0, np.ones(2**bits, np.float32), np.zeros((2**bits, rank), np.float32))
    monkeypatch.setattr(factorization, "fit", seen)
    assert factorization.learn(table, known, F.lit(True), bits=4).bias not in (0.0, float(os.getpid()))

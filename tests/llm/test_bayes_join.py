from collections import Counter

import numpy as np

from pyspark.sql import functions as F

from millrace.llm import bayes_join
from millrace.llm.queries import QUERIES
from millrace.llm.rows import words
from tests.llm.cases import SF, docs, empty, passage


def grams(text, n=5):
    w = words(text)
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(rows, threshold=0.8):
    """(id, class, links) of every row, from all pairs."""
    sets = [grams(t) for _, t in rows]
    up, links = list(range(len(rows))), Counter()

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                up[top(a)] = top(b)
    first = {}
    for i, (key, _) in enumerate(rows):
        if sets[i] and key is not None:
            first[top(i)] = min(key, first.get(top(i), key))
    return sorted(((key, first.get(top(i)) if sets[i] else key, links[i]) for i, (key, _) in enumerate(rows)), key=str)


def result(df):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in df.collect()), key=str)


def test_posterior_bounds():
    fewest = bayes_join.least_matches(0.8, 1e-6)
    assert list(fewest) == [16, 32, 48, 64, 80, 96] and all(0.3 * n < m < 0.7 * n for n, m in fewest.items())
    assert bayes_join.least_matches(0.8, 0.05)[64] > fewest[64]
    rng = np.random.default_rng(1)
    assert (rng.binomial(96, 0.8, 200_000) < fewest[96]).mean() < 1e-4


def near_copies():
    """A base text and copies of it with more and more changed words."""
    base = (passage(150, 2) + " " + passage(50, 3)).split()
    out = []
    for n in range(60):
        w = list(base)
        for j in range(n % 12):
            w[(j * 31 + n) % len(w)] = f"new{n}{j}"
        out.append((100 + n, " ".join(w)))
    return out


def test_near_copies_equal_brute_force(spark):
    rows = near_copies() + [(1, passage(60, 1)), (2, passage(60, 1).upper()), (3, passage(60, 4)), (4, "a b"), (5, "a  B!"), (6, "b a"), (7, None), (8, ""), (9, ""), (None, passage(60, 1)), (None, passage(60, 7)), (3, passage(60, 5))]
    assert result(bayes_join.similar(docs(spark, rows))) == brute(rows)


def test_blocks_of_a_bucket_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(bayes_join, "BLOCK", 7)
    rows = near_copies()
    assert result(bayes_join.similar(docs(spark, rows))) == brute(rows)


def test_overlaps_of_many_pairs_equal_set_sizes():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(20)]
    a, b = np.triu_indices(20, 1)
    want = [len(set(sets[x].tolist()) & set(sets[y].tolist())) for x, y in zip(a, b, strict=True)]
    assert bayes_join.overlaps(sets, a, b).tolist() == want == bayes_join.overlaps(sets * 50, a, b).tolist()


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(60)] + [(b"x", b"y")], "a binary, b binary")
    roots = {bytes(r.c): bytes(r.root) for r in bayes_join.components(edges).collect()}
    assert {roots[bytes([i])] for i in range(61)} == {b"\0"} and roots[b"y"] == b"x"


def test_awkward_rows(spark):
    assert bayes_join.similar(empty(spark)).count() == 0
    assert result(bayes_join.similar(docs(spark))) == brute([(r.doc_id, r.text) for r in docs(spark).collect()])


def test_one_of_each_group_stays(spark):
    table = docs(spark)
    kept = bayes_join.keep_one(table)
    assert kept.columns == table.columns
    got = sorted((str(r.doc_id), (r.text or "")[:10]) for r in kept.collect())
    assert [k for k, _ in got].count("1") == 1 and "2" not in dict(got) and "3" not in dict(got)
    assert [g for g in got if g[1] == "short"] == [("9", "short")] and {"4", "5", "6", "10"} <= {k for k, _ in got}


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(QUERIES["op8_bayes_jaccard_join"](spark, SF)) == brute(rows)


def test_null_ids_are_told_apart_by_text(spark):
    near = passage(200, 5)
    rows = [(None, near), (None, near + " tail"), (None, passage(60, 1)), (1, passage(60, 1)), (None, "..."), (5, passage(80, 6)), (5, passage(60, 1) + "!"), (None, "alone here")]
    kept = [(r.doc_id, r.text) for r in bayes_join.keep_one(docs(spark, rows)).collect()]
    assert len(kept) == 5 and (1, rows[2][1]) in kept and len([t for _, t in kept if t.startswith(near)]) == 1
    assert {(None, "..."), (5, rows[5][1]), (None, "alone here")} <= set(kept)


def test_rows_without_an_id_meet_their_own_class_only(spark):
    rows = [(None, passage(40, 100 + i // 2) + (" tail" if i % 2 else "")) for i in range(200)]
    table = docs(spark, rows)
    drawn = bayes_join.sketches(table, 5, "doc_id", "text").where("c is not null")
    wanted = drawn.groupBy("c").agg(bayes_join.representative().alias("rep"), F.count("*").alias("size"))
    assert wanted.count() == 200 and bayes_join.needed_grams(table, wanted, 5, "doc_id", "text").count() == 200
    assert {r.n_links for r in bayes_join.similar(table).collect()} == {1} and bayes_join.keep_one(table).count() == 100

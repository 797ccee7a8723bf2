import random
import time

import numpy as np

from millrace.llm import tiling
from millrace.llm.queries import QUERIES
from millrace.llm.rows import words
from tests.llm.cases import SF, docs, empty, passage


def greedy(item, text, least):
    """Greedy string tiling, plainly: the longest free common stretch, leftmost first, until none is long enough."""
    fa, ft, out = [True] * len(item), [True] * len(text), []
    while True:
        best = (0, 0, 0)
        for a in range(len(item)):
            for t in range(len(text)):
                n = 0
                while a + n < len(item) and t + n < len(text) and item[a + n] == text[t + n] and fa[a + n] and ft[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, a, t)
        n, a, t = best
        if n < least:
            return out
        fa[a : a + n], ft[t : t + n] = [False] * n, [False] * n
        out.append(best)


def test_tiles_equal_plain_greedy_tiling():
    rng = random.Random(2)
    for _ in range(300):
        item, text = ([rng.randint(1, 6) for _ in range(rng.randint(0, 25))] for _ in range(2))
        for least in (2, 3):
            assert sorted(n for n, _, _ in tiling.tiles(item, text, least))[-1:] == sorted(n for n, _, _ in greedy(item, text, least))[-1:]
    for _ in range(200):  # without repeated words the tiling is unique
        item = rng.sample(range(100), 30)
        parts = [item[:8], item[8:15], item[15:22], item[22:]]
        rng.shuffle(parts)
        text = [x for p in parts for x in [*p, 1000 + rng.randint(0, 9)]]
        assert sorted(tiling.tiles(item, text, 5)) == sorted(greedy(item, text, 5))


def test_tiles_are_those_of_plain_greedy_tiling_in_its_order():
    rng = random.Random(4)
    for _ in range(400):
        letters = rng.randint(1, 5)
        item, text = ([rng.randint(1, letters) for _ in range(rng.randint(0, 40))] for _ in range(2))
        for least in (1, 2, 5):
            assert tiling.tiles(item, text, least) == greedy(item, text, least)


def test_equal_hashes_of_other_words_make_no_tile(monkeypatch):
    rng = random.Random(5)
    monkeypatch.setattr(tiling.Words, "windows", lambda self, size: ((at := np.array([i for i in range(len(self.free) - size + 1) if all(self.free[i : i + size])], np.int64)), np.zeros(len(at), np.uint64)))
    for _ in range(100):
        item, text = ([rng.randint(1, 4) for _ in range(rng.randint(0, 20))] for _ in range(2))
        assert tiling.tiles(item, text, 2) == greedy(item, text, 2)


def test_words_over_and_over_take_little_time():
    start = time.process_time()
    assert tiling.tiles([7] * 4_000, [7] * 40_000, 5) == [(4_000, 0, 0)]
    runs = ([7] * 10 + [8]) * 4_000
    runs[10::11] = range(100, 4_100)
    got = tiling.tiles([7] * 4_000, runs, 5)
    assert len(got) == 400 and {n for n, _, _ in got} == {10}
    assert sum(n for n, _, _ in tiling.tiles([7, 8] * 2_000, [8, 7, 7] * 13_000 + [7, 8] * 500, 5)) == 1_000
    assert time.process_time() - start < 5


def test_rolling_hash_equals_hash_of_window():
    seq = [random.Random(1).randint(0, 2**64 - 1) for _ in range(50)]
    assert dict(tiling.rolling(seq, 7)) == {i: next(iter(tiling.rolling(seq[i : i + 7], 7)))[1] for i in range(44)}


ITEM = passage(40, 9)


def benchmark(spark, rows=None):
    return spark.createDataFrame([(1, ITEM, "x"), (2, passage(30, 8), "x"), (3, "too short", "x"), (4, None, "x"), (5, "", "x"), (1, ITEM, "x")] if rows is None else rows, "item_id bigint, text string, seeds string")


def test_reordered_and_embedded_passages(spark):
    w = ITEM.split()
    reordered = " ".join(["lead"] * 9 + w[25:] + ["x"] + w[:12] + ["y"] + w[12:25])
    rows = [(1, ITEM.upper()), (2, reordered), (3, passage(500, 4) + " " + ITEM + " " + passage(500, 5)), (4, " ".join(w[:20])), (5, passage(100, 6)), (6, None), (7, ""), (None, ITEM), (8, ITEM), (8, ITEM), (8, "clean"), (9, "too short")]
    out = tiling.contaminated(docs(spark, rows), benchmark(spark)).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in out) == [("1", 1), ("2", 1), ("3", 1), ("8", 1), ("None", 1)]
    assert next(r for r in out if r.doc_id == 2).n_tiles == 3 and all(r.coverage == 1 for r in out)
    kept = tiling.without_contaminated(docs(spark, rows), benchmark(spark))
    # The clean row stays although another row of its id goes.
    assert [r.text for r in kept.collect() if r.doc_id == 8] == ["clean"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["4", "5", "6", "7", "8", "9"] and kept.columns == docs(spark).columns


def test_threshold(spark):
    w = ITEM.split()
    rows = [(n, " ".join(w[:n])) for n in range(1, 41)]
    got = {r.doc_id: r.coverage for r in tiling.contaminated(docs(spark, rows), benchmark(spark), coverage=0.5).collect()}
    assert set(got) == set(range(20, 41)) and got[30] == 0.75


def test_small_filter_changes_nothing(spark):
    full = tiling.contaminated(docs(spark, [(1, ITEM), (2, passage(900, 2))]), benchmark(spark)).collect()
    assert full == tiling.contaminated(docs(spark, [(1, ITEM), (2, passage(900, 2))]), benchmark(spark), bits=15).collect()


def test_empty_tables(spark):
    assert tiling.contaminated(empty(spark), benchmark(spark)).count() == 0
    assert tiling.contaminated(docs(spark), benchmark(spark, [])).count() == 0
    assert tiling.without_contaminated(docs(spark), benchmark(spark, [])).count() == 15


def test_query_equals_brute_force(spark):
    items = [(r.item_id, words(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        w = words(r.text)
        grams = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        for item, x in items:
            if any(tuple(x[i : i + 5]) in grams for i in range(len(x) - 4)) and sum(n for n, _, _ in greedy(x, w, 5)) >= 0.6 * len(x):
                want.add((r.doc_id, item))
    assert {(r.doc_id, r.item_id) for r in QUERIES["op7_benchmark_tiling"](spark, SF).collect()} == want and want


def test_rows_that_share_an_id_or_have_none_are_judged_by_their_text(spark):
    rows = [(None, ITEM), (None, "clean of items"), (None, passage(50, 3)), (8, ITEM), (8, "clean"), (9, "clean")]
    kept = tiling.without_contaminated(docs(spark, rows), benchmark(spark)).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted((str(i), t) for i, t in rows if t != ITEM)


def test_items_that_repeat_a_window(spark):
    flip = " ".join(["left right"] * 10)
    items = benchmark(spark, [(1, flip, "x"), (2, passage(12, 8), "x"), (2, passage(200, 7), "x")])
    out = tiling.contaminated(docs(spark, [(1, flip), (2, "lead " + passage(12, 8)), (3, "left right left right left")]), items).collect()
    assert sorted((r.doc_id, r.item_id, r.coverage) for r in out) == [(1, 1, 1.0), (2, 2, 1.0)]

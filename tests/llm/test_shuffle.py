import random
from collections import Counter

from millrace.llm import shuffle
from millrace.llm.queries import QUERIES
from tests.llm.cases import SF, docs, empty


def test_hypergeometric_has_its_law():
    rng = random.Random(1)
    drawn = Counter(shuffle.hypergeometric(rng, 10, 4, 5) for _ in range(20_000))
    law = {0: 6, 1: 60, 2: 120, 3: 60, 4: 6}
    assert all(abs(drawn[k] / 20_000 - n / 252) < 0.015 for k, n in law.items())
    big = [shuffle.hypergeometric(rng, 10**11, 10**10, 10**6) for _ in range(20)]
    assert all(abs(x - 10**5) < 3000 for x in big)
    assert shuffle.hypergeometric(rng, 5, 5, 3) == 3 and shuffle.hypergeometric(rng, 5, 0, 3) == 0


def test_matrix_has_exact_sums():
    counts = [0, 5, 1000, 1, 77, 40_003]
    m = shuffle.communication_matrix(counts, 8, 3)
    assert [sum(r) for r in m] == counts
    assert [sum(c) for c in zip(*m, strict=True)] == shuffle.shard_sizes(sum(counts), 8)


def test_shards_are_exact_and_slots_gapless(spark):
    table = spark.range(10_007).repartition(7)
    for bound in (200, 100_000):
        rows = shuffle.shuffle_into_shards(table, 8, rows_per_part=bound).select("row.id", "shard", "slot").collect()
        assert sorted(r.id for r in rows) == list(range(10_007))
        for s, n in Counter(r.shard for r in rows).items():
            assert n in (1250, 1251)
            assert sorted(r.slot for r in rows if r.shard == s) == list(range(n))


def test_shuffle_looks_uniform(spark):
    rows = shuffle.shuffle_into_shards(spark.range(0, 8000, 1, 4), 8).select("row.id", "shard", "slot").collect()
    cells = Counter((r.id // 2000, r.shard) for r in rows)
    assert len(cells) == 32 and all(180 < n < 320 for n in cells.values())
    by_slot = [r.id for r in sorted(rows, key=lambda r: (r.shard, r.slot))][:1000]
    assert sum(a < b for a, b in zip(by_slot, by_slot[1:], strict=False)) in range(430, 570)


def test_awkward_rows(spark):
    assert shuffle.shuffle_into_shards(empty(spark)).count() == 0
    out = shuffle.shuffle_into_shards(docs(spark), 8)
    assert out.count() == 15 and out.select("row.*").columns == docs(spark).columns
    same = shuffle.shuffle_into_shards(docs(spark, [(1, "same")] * 1000), 8).groupBy("shard").count().collect()
    assert [r["count"] for r in same] == [125] * 8


def test_query(spark):
    df = QUERIES["op4_hypergeometric_shuffle"](spark, SF)
    assert df.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    rows = df.collect()
    n = Counter(r.shard for r in rows)
    assert set(n) == set(range(8)) and max(n.values()) - min(n.values()) <= 1
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}

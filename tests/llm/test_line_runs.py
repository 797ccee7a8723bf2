from collections import defaultdict

from millrace.llm import line_runs
from millrace.llm.queries import QUERIES, SQL
from tests.llm.cases import SF, docs, empty
from tests.oracle import compare, connect

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in line.strip(WHITE))


def brute(rows, min_docs=3, min_chars=20):
    holders = defaultdict(list)
    for n, (i, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= min_chars:
                holders[k].append((n, i))
    out = []
    for i, text in rows:
        kept = []
        for line in (text or "").split("\n"):
            held = holders.get(key(line), [])
            top = max((j for _, j in held if j is not None), default=None)
            if len(held) < min_docs or i == top:
                kept.append(line)
        out.append((i, len((text or "").split("\n")), len((text or "").split("\n")) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


LINE = "A Line That Is Long Enough To Count"
ROWS = [
    (1, f"{LINE}\nx\n{LINE}"), (2, f"x\n  {LINE.lower()}\t"), (3, f"{LINE.upper()}\nshort\nshort"), (3, f"{LINE}\nsame id, other row here yes"), (None, f"{LINE}\nnull id"), (4, "short\nshort"), (5, "short"),
    (6, None), (7, ""), (8, "\n\n"), (9, "É" * 25), (10, "é" * 25), (11, "É" * 25 + " "), (12, "É" * 25), (13, "only nulls hold it, with luck"), (14, "x\n" * 3000 + LINE),
]


def test_rows_equal_brute_force(spark):
    for batches, fanout in ((1, 2), (4, 2), (5, 3)):
        out = line_runs.dedup_lines(docs(spark, ROWS), batches=batches, fanout=fanout).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
        assert sorted([tuple(r) for r in out], key=str) == brute(ROWS)


def test_batches_in_any_order(spark):
    table = docs(spark, ROWS, clashing=False)
    runs = line_runs.LineRuns(spark, fanout=2)
    for part in (table.where("doc_id < 3"), table.where("doc_id >= 3 or doc_id is null"), table.limit(0)):
        runs.add(part)
    out = line_runs.drop_lines(table, runs).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    assert sorted([tuple(r) for r in out], key=str) == brute(ROWS)


def test_runs_are_merged_into_levels(spark):
    runs = line_runs.LineRuns(spark, fanout=2)
    for n in range(4):
        runs.add(docs(spark, [(n, f"line number {n} that is long enough")], clashing=False))
    assert [len(level) for level in runs.levels] == [0, 0, 1] and runs.levels[2][0].count() == 4


def test_settled_keys_are_not_stored_again(spark):
    runs = line_runs.LineRuns(spark, fanout=9)
    runs.add(docs(spark, [(10 + n, LINE) for n in range(3)], clashing=False))
    runs.add(docs(spark, [(1, LINE)], clashing=False))
    assert [r.count() for r in runs.levels[0]] == [1, 0]


def test_empty_table_and_columns(spark):
    assert line_runs.dedup_lines(empty(spark)).count() == 0
    out = line_runs.with_kept_text(docs(spark))
    assert out.columns == docs(spark).columns and out.count() == docs(spark).count()


def test_query_matches_sql(spark):
    problems, _ = compare(QUERIES["op1_line_dedup"](spark, SF), SQL["op1_line_dedup"], connect(SF))
    assert not problems, problems


def test_no_python_in_the_plan(spark):
    plan = line_runs.dedup_lines(docs(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

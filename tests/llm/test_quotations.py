from millrace.llm import quotations
from millrace.llm.queries import QUERIES, SQL
from tests.llm.cases import SF
from tests.oracle import compare, connect


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, level string, depth string")


def test_nested_quotations(spark):
    rows = [
        (1, 0, "user", "How do I bake bread?\nSecond line here"),
        (1, 1, "assistant", "With flour.\n  indented stays"),
        (1, 2, "user", "Message 0 wrote:\n> how do  I bake BREAD?\nI asked that."),
        (1, 3, "assistant", "Anna wrote:\n> I asked that.\n>> How do I bake bread?\n> > Second line here\nYes > you did"),
        (1, 4, "user", "> nobody said this\nno link"),
        (2, 5, "user", "> How do I bake bread?\nother conversation"),
    ]
    out = {(r.conv_id, r.turn): r for r in quotations.reply_ordered(table(spark, rows)).collect()}
    assert [out[1, t].reply_to for t in range(5)] == [None, 0, 0, 2, 3] and out[2, 5].reply_to is None
    assert [out[1, t].depth for t in range(5)] == [0, 1, 1, 2, 3]
    assert [out[1, t].reply_pos for t in range(5)] == [1, 2, 3, 4, 5]
    assert out[1, 3].own_text == "Yes > you did" and out[1, 3].max_level == 2 and out[1, 3].n_quoted == 3 and out[1, 3].n_linked == 1
    assert out[1, 1].own_text == "With flour.\n  indented stays" and out[1, 4].n_linked == 0
    assert out[1, 0].formatted == "<|user|>\nHow do I bake bread?\nSecond line here\n"


def test_breadth_first_order(spark):
    rows = [(1, 0, "u", "root"), (1, 1, "a", "first answer"), (1, 2, "u", "> first answer\nagain"), (1, 3, "a", "> root\nlate answer to the root")]
    out = sorted(quotations.reply_ordered(table(spark, rows)).collect(), key=lambda r: r.reply_pos)
    assert [r.turn for r in out] == [0, 1, 3, 2]


def test_repeated_lines_take_the_latest_earlier_message(spark):
    rows = [(1, t, "u", "the same line") for t in range(5)] + [(1, 9, "u", "> the same line\nx")]
    out = {r.turn: r.reply_to for r in quotations.reply_ordered(table(spark, rows)).collect()}
    assert out[9] == 4


def test_awkward_rows(spark):
    rows = [(None, 1, "u", "a"), (1, None, "u", "a"), (1, 1, None, None), (1, 1, "u", "b"), (1, 2, "a", ""), (1, 3, "a", "> " * 3000), (1, 3, "a", "> " * 3000), (1, 4, "u", "y" * 50_000)]
    out = sorted(quotations.reply_ordered(table(spark, rows)).collect(), key=lambda r: r.turn)
    assert [(r.turn, r.reply_to) for r in out] == [(1, None), (2, 1), (3, 2), (4, 3)] and out[0].own_text == "" and out[2].max_level == 3000
    assert quotations.reply_ordered(table(spark, [])).count() == 0


def test_long_chain(spark):
    out = quotations.reply_ordered(table(spark, [(1, t, "u", f"m{t}") for t in range(1500)])).collect()
    assert {(r.turn, r.depth, r.reply_pos) for r in out} == {(t, t, t + 1) for t in range(1500)}


def test_query_matches_sql(spark):
    df = QUERIES["op10_quotation_linking"](spark, SF)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    problems, _ = compare(df, SQL["op10_quotation_linking"], connect(SF))
    assert not problems, problems


def test_a_message_that_quotes_only_deeper_levels_is_linked(spark):
    rows = [(1, 0, "a", "first line of all\nand a second one"), (1, 1, "b", "something else"), (1, 2, "c", "more of it"), (1, 3, "d", ">> first line of all\n>>> and a second one\nmine")]
    out = {r.turn: r for r in quotations.reply_ordered(table(spark, rows)).collect()}
    assert (out[3].reply_to, out[3].n_linked, out[3].own_text) == (0, 1, "mine") and out[2].reply_to == 1

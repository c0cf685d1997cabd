"""Quotation linking: by-hand cases and edge cases."""

from linktally.llm.quotes import link_quotes

SCHEMA = "conv_id long, turn long, role string, text string, content int"


def linked(spark, rows):
    out = link_quotes(spark.createDataFrame(rows, SCHEMA))
    return {(r["conv_id"], r["turn"]): r for r in out.collect()}


def test_links_the_outermost_quote_and_orders_by_replies(spark):
    rows = [
        (1, 0, "a", "Where is the key?\nI looked everywhere.", 0),
        (1, 1, "b", "> Where is the key?\n\nUnder the mat.", 0),
        (1, 2, "c", "> > where is THE key\n> Under the mat.\nNot there!", 0),
        (1, 3, "d", "On  the table.", 0),
        (1, 4, "a", ">I looked everywhere.\r\n> \r\n> no such line was said\r\nStill gone.", 0),
        (2, 0, "x", "Under the mat.", 0),
        (2, 2, "y", "> Under the mat.\n> Later line", 0),
        (2, 3, "y", "Later line", 0),
        (2, 7, "z", "after a gap", 0),
    ]
    got = linked(spark, rows)
    assert [got[1, t]["reply_to"] for t in range(5)] == [None, 0, 1, 2, 0]
    assert [got[1, t]["depth"] for t in range(5)] == [0, 1, 2, 3, 1]
    assert {got[1, t]["root"] for t in range(5)} == {0}
    assert got[1, 1]["content"] == "Under the mat."
    assert got[1, 1]["rendered"] == "<|b|>\nUnder the mat.<|end|>\n"
    assert (got[1, 2]["n_quoted"], got[1, 2]["n_linked"], got[1, 2]["content"]) == (2, 2, "Not there!")
    assert (got[1, 4]["n_quoted"], got[1, 4]["n_linked"]) == (2, 1)
    assert got[2, 2]["reply_to"] == 0 and got[2, 2]["n_linked"] == 1  # a quote points back only
    assert got[2, 7]["reply_to"] is None and got[2, 7]["root"] == 7
    order = sorted(got.values(), key=lambda r: (r["conv_id"], r["root"], r["depth"], r["turn"]))
    place = {(r["conv_id"], r["turn"]): i for i, r in enumerate(order)}
    assert all(r["reply_to"] is None or place[r["conv_id"], r["reply_to"]] < i for i, r in enumerate(order))


def test_nulls_repeats_long_and_empty_texts(spark):
    long = "\n".join(f"line {i} of many" for i in range(20_000))
    rows = [
        (1, 0, None, None, 1),
        (1, 1, "b", "", 1),
        (1, 1, "b", "", 1),
        (None, 0, "c", "> a quote\nmine", 1),
        (1, None, "d", "no turn", 1),
        (3, 0, "e", long, 1),
        (3, 1, "f", "> " + long.replace("\n", "\n> "), 1),
    ]
    out = link_quotes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 6
    by = {(r["conv_id"], r["turn"]): r for r in out}
    assert by[1, 0]["content"] == "" and by[1, 0]["rendered"] == "<||>\n<|end|>\n"
    assert by[None, 0]["content"] == "mine" and by[None, 0]["reply_to"] is None and by[None, 0]["n_quoted"] == 1
    assert by[3, 1]["reply_to"] == 0 and by[3, 1]["n_linked"] == 20_000 and by[3, 1]["content"] == ""


def test_empty_table_and_no_python(spark):
    out = link_quotes(spark.createDataFrame([], SCHEMA))
    assert out.collect() == []
    assert not any(w in out._jdf.queryExecution().toString() for w in ("Python", "Pandas", "Arrow"))


def test_a_long_chain(spark):
    rows = [(1, t, "r", f"message {t}", 0) for t in range(300)]
    got = linked(spark, rows)
    assert all(got[1, t]["depth"] == t and got[1, t]["root"] == 0 for t in range(300))

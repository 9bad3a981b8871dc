"""Quotation linking against the known parents of quoted replies."""

from pyspark.sql import functions as F

from millrace.llm.quotes import _SLICE, conversations, latest_before, link_quotes

SCHEMA = "conv_id long, turn long, role string, text string, hash int, level int, place int, up int"


def messages(spark, rows):
    return spark.createDataFrame([(*r, 1, 1, 1, 1) for r in rows], SCHEMA)


def linked(spark, rows):
    return {(r["thread"], r["turn"]): r for r in link_quotes(messages(spark, rows)).collect()}


def test_links_by_quotation(spark):
    rows = [
        (1, 0, "a", "Shall we meet on Monday?\nOr later in the week?"),
        (1, 1, "b", "Monday is fine."),
        (1, 2, "c", "> shall we meet   on MONDAY?\nNo, Tuesday."),
        (1, 3, "a", ">> Shall we meet on Monday?\n> No, Tuesday.\nTuesday then."),
        (1, 4, "b", "> Nobody wrote this\nodd"),
        (2, 0, "a", "Something else."),
        (2, 5, "b", "> Monday is fine.\nI read that elsewhere."),
        (2, 7, "c", " > > Something else.\n>\nyes"),
    ]
    got = linked(spark, rows)
    parents = {k: (r["parent_thread"], r["parent_turn"]) for k, r in got.items()}
    assert parents == {
        (1, 0): (None, None),
        (1, 1): (1, 0),
        (1, 2): (1, 0),
        (1, 3): (1, 2),
        (1, 4): (1, 3),
        (2, 0): (None, None),
        (2, 5): (1, 1),
        (2, 7): (2, 0),
    }
    assert got[1, 3]["text"] == "Tuesday then." and got[1, 3]["n_quotes"] == 2
    assert [got[1, t]["depth"] for t in range(5)] == [0, 1, 1, 2, 3]
    assert got[1, 4]["n_quotes"] == 1 and got[1, 4]["n_linked"] == 0
    # Without a parent in its own thread a message is a start.
    assert got[2, 5]["depth"] == 0
    places = sorted((r["place"], t) for (c, t), r in got.items() if c == 1)
    assert [t for _, t in places] == [0, 1, 2, 3, 4]


def test_quotations_of_some_lines_and_paragraphs(spark):
    rows = [
        (1, 0, "a", "Dear all,\nthe plan is ready.\nPlease read it\nsoon.\n\nIt is long.\n\nBye"),
        (1, 1, "b", "Please read it\nsome day"),
        (1, 2, "c", "Well"),
        # Two lines of a paragraph; a line of another message alone is not enough.
        (1, 3, "d", "> The plan is ready.\n> Please read it\nI did."),
        # Two of three paragraphs, one wrapped otherwise.
        (1, 4, "e", "> Dear all, the plan is ready.\n> Please read it soon.\n>\n> It is long.\nToo long."),
        # No message holds both lines.
        (1, 5, "f", "> the plan is ready.\n> some day\nodd"),
        # Lines of two paragraphs, from another thread.
        (2, 0, "a", "start"),
        (2, 1, "b", "> soon.\n>\n> Bye\nhere"),
    ]
    got = linked(spark, rows)
    assert {k: (r["parent_thread"], r["parent_turn"], r["n_linked"]) for k, r in got.items()} == {
        (1, 0): (None, None, 0),
        (1, 1): (1, 0, 0),
        (1, 2): (1, 1, 0),
        (1, 3): (1, 0, 1),
        (1, 4): (1, 0, 1),
        (1, 5): (1, 4, 0),
        (2, 0): (None, None, 0),
        (2, 1): (1, 0, 1),
    }


def test_quotations_that_several_threads_hold(spark):
    """The smallest other thread is taken, however many hold the passage."""
    rows = [(c, t, "a", f"Copied {t}") for c in range(3, 9) for t in (2, 4)]
    rows += [(c, 1, "b", "> Copied 4\nreply") for c in (1, 3, 4)]
    rows += [(c, 5, "b", "> Copied 2\nreply") for c in (1, 4)]
    got = linked(spark, rows)
    parents = {k: (r["parent_thread"], r["parent_turn"]) for k, r in got.items() if r["n_quotes"]}
    assert parents == {(1, 1): (3, 4), (3, 1): (4, 4), (4, 1): (3, 4), (1, 5): (3, 2), (4, 5): (4, 2)}
    assert all(r["n_linked"] == 1 for r in got.values() if r["n_quotes"])


def test_odd_rows(spark):
    rows = [
        (None, 0, "a", "x"),
        (3, None, "a", "x"),
        (3, 0, "a", None),
        (3, 1, "a", "> x\n"),
        (3, 1, "a", "again"),
        (3, 1, "a", "again"),
        (3, 2, "a", ">" * 2000 + " deep\n" + "long " * 50_000),
    ]
    out = link_quotes(messages(spark, rows)).collect()
    assert len(out) == len(rows)
    assert sorted(r["place"] for r in out if r["thread"] == 3 and r["turn"] is not None) == [
        1, 2, 3, 4, 5,
    ]
    assert all(
        (r["depth"], r["place"]) == (0, 1) for r in out if r["thread"] is None or r["turn"] is None
    )
    assert link_quotes(messages(spark, [])).collect() == []


def test_quoted_replies_of_the_given_conversations(spark, folder):
    """Every turn quotes a line of an earlier one, as mail programs do."""
    table = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    text = {(c, t): x for c, t, _, x in rows}
    count = {}
    for x in text.values():
        for line in set(x.split("\n")):
            count[line] = count.get(line, 0) + 1
    quoted, want = [], {}
    for c, t, role, x in sorted(rows):
        target = t // 2
        line = text[c, target].split("\n")[0] if t else ""
        if t and count[line] == 1:
            quoted.append((c, t, role, f"> {line.replace('th', 'TH')}\n{x}"))
            want[c, t] = (c, target)
        else:
            quoted.append((c, t, role, x))
    got = linked(spark, quoted)
    assert len(want) > 20
    assert all((got[k]["parent_thread"], got[k]["parent_turn"]) == v for k, v in want.items())
    assert all(r["text"] == text[k].strip(" ") for k, r in got.items())
    whole = conversations(link_quotes(table))
    assert whole.count() == len({c for c, *_ in rows})


def test_long_threads_are_cut(spark):
    """A thread over several slices gives what one window would."""
    n = 3 * _SLICE + 7
    rows = spark.range(n).select(
        F.lit(1).alias("k"), (F.col("id") * 3 % (2 * n)).alias("turn")
    ).distinct()
    rows = rows.withColumn("odd", F.col("turn") % 5 == 0)
    got = latest_before(rows, ["k"], F.col("odd")).collect()
    marked = sorted(r["turn"] for r in got if r["odd"])
    for r in got:
        assert r["latest"] == max((t for t in marked if t < r["turn"]), default=None)

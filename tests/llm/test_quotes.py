import collections

import duckdb
import pandas as pd
import pyarrow as pa
import pytest

from carestar.llm.queries import op1_quotation_linking
from carestar.llm.quotes import LINK_SQL, link_quotes

FIRST = "Hello there. I think the plan is good! Shall we start\non Monday? Yes."
SECOND = "On Mon, Jan 1, Ann wrote:\n> Hello there. I think the plan\n> is good!\n\nI agree with that. Let us go."
THIRD = "Am 3. Mai schrieb Bob:\n> I agree with that.\n>> Hello there.\n\n> Let us go.\nNo, wait. Not so fast."
FOURTH = "> Not so fast.\nWhy?"
ROWS = [
    (1, 0, "a", FIRST), (1, 1, "b", SECOND), (1, 2, "c", THIRD), (1, 3, "a", FOURTH),
    (1, 4, "b", "New idea."), (1, 4, "b", "New idea."), (1, 5, "a", "> something else\nnothing"),
    (2, 0, "a", "> Hello there."), (2, 1, "b", None), (None, 0, "a", "x"), (None, 0, "a", FOURTH),
    (3, None, "a", "Foo bar."), (3, 1, "b", "> foo, bar\r\nbaz"), (4, 0, None, ""),
    (4, 0, "z", "> > > deep\n \n>ok"), (5, 0, "a", "Same. Same."), (5, 0, "b", "> Same.\nHm."),
]


def frame(spark, rows):
    """Extra columns have names that the operator uses inside."""
    rows = [(*r, 0, "m", "k") for r in rows]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, level int, mid string, thread string")


def by_sql(rows):
    table = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"])
    table = table.astype({"conv_id": "Int64", "turn": "Int64"})
    con = duckdb.connect()
    con.register("given", pa.Table.from_pandas(table))
    con.execute("CREATE VIEW conversations AS SELECT * FROM given")
    answer = con.execute(LINK_SQL)
    names = [c[0] for c in answer.description]
    return collections.Counter(tuple(sorted(zip(names, r, strict=True))) for r in answer.fetchall())


def found(df):
    return collections.Counter(tuple(sorted(r.asDict().items())) for r in df.collect())


def test_rows_against_sql(spark):
    assert found(link_quotes(frame(spark, ROWS))) == by_sql(ROWS)


def test_the_thread_by_hand(spark):
    got = {r.turn: r for r in link_quotes(frame(spark, ROWS)).where("conv_id = 1").collect()}
    assert [(got[t].parent, got[t].branch, got[t].depth) for t in range(6)] == [
        (None, 0, 0), (0, 1, 1), (1, 1, 2), (2, 1, 3), (0, 4, 1), (0, 5, 1),
    ]
    assert (got[2].n_quoted, got[2].n_linked, got[2].max_level) == (3, 3, 2)
    assert got[1].body == "I agree with that. Let us go."
    assert got[2].body == "No, wait. Not so fast."


def test_a_long_chain_and_its_order(spark):
    rows = [(9, 0, "a", "Sentence 0 here.")]
    rows += [(9, k, "a", f"> Sentence {k - 1} here.\nSentence {k} here.") for k in range(1, 41)]
    rows += [(9, 100, "b", "> Sentence 0 here.\nAside.")]
    got = link_quotes(frame(spark, rows)).collect()
    assert [(r.turn, r.depth) for r in got] == [*((k, k) for k in range(41)), (100, 1)]
    assert {r.branch for r in got} == {0, 1, 100}
    assert found(link_quotes(frame(spark, rows))) == by_sql(rows)


@pytest.mark.parametrize("n", [300])
def test_a_sentence_that_everyone_repeats(spark, n):
    rows = [(7, k, "a", f"> Yes.\nYes. And {k}.") for k in range(n)]
    got = link_quotes(frame(spark, rows)).collect()
    assert all((r.parent, r.depth) == ((0, 1) if r.turn else (None, 0)) for r in got)


def test_very_long_and_empty(spark):
    long = "\n".join(f"> line {i} of it." for i in range(20_000))
    got = link_quotes(frame(spark, [(1, 0, "a", "Line 5 of it."), (1, 1, "b", long)])).collect()
    assert got[1].n_quoted == 20_000 and got[1].n_linked == 1
    assert link_quotes(frame(spark, [])).collect() == []


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    answer = con.execute(LINK_SQL)
    names = [c[0] for c in answer.description]
    want = collections.Counter(tuple(sorted(zip(names, r, strict=True))) for r in answer.fetchall())
    assert found(op1_quotation_linking(spark, folder)) == want

"""The registered queries against their SQL, and chat formatting and top-k on small tables."""

import duckdb
import pytest
from compare import connect, differences
from pyspark.sql import functions as F
from tidemark.llm.chat import LLAMA, chat_digest, escaped, format_conversations, unescaped
from tidemark.llm.queries import ORACLE_SQL, QUERIES
from tidemark.llm.topk import top_k


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE_SQL[name]) == []


def test_escapes_are_reversible(spark):
    said = ["", "</s>", r"\</s>", r"\\[INST]\[/INST", "<<SYS>>[ROLE]", "\\", "a\n</s>\n[INST]\nb", "<s><s>"]
    frame = spark.createDataFrame([(t,) for t in said], "t string")
    back = frame.select("t", unescaped(escaped(F.col("t"), LLAMA), LLAMA).alias("b")).collect()
    assert all(r.t == r.b for r in back)


def test_turns_are_read_back(spark):
    rows = [(1, 0, "user", "a\n[/INST]\n"), (1, 1, "assistant", "\n</s>\n"), (2, 0, "assistant", None), (2, 1, "tool x\n", "t"), (3, 0, None, ""), (None, 0, "user", "q")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, valid int")
    con = duckdb.connect()
    got = {r.conv_id: r for r in chat_digest(frame).collect()}
    for conv in (1, 2, 3, None):
        own = [r for r in rows if r[0] == conv]
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        digest = lambda s: con.execute("select sha256(?)", [s]).fetchone()[0]
        assert (got[conv].n_turns, got[conv].turns_sha256, got[conv].loss_chars, got[conv].loss_sha256) == (len(own), digest(said), len(loss), digest(loss))
    assert [got[c].valid for c in (1, 2, 3, None)] == [True, False, False, True]
    assert format_conversations(frame.limit(0)).count() == 0


def test_top_k_of_odd_vectors(spark):
    nan = float("nan")
    rows = [(0, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [0.5, 0.25]), (20, [-1.0, 0.0]), (3, None), (4, [nan, 0.0]), (5, [None, 0.0]), (None, [1.0, 1.0]), (6, [0.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, score int")
    got = [tuple(r) for r in top_k(frame, k=3, every=20).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1280), (0, 2, 2, 1280), (0, 3, 6, 0), (20, 1, 6, 0), (20, 2, 0, -2048), (20, 3, 1, -2048)]
    assert top_k(frame.limit(0), k=3, every=20).count() == 0

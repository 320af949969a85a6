"""Queries of exact operators against their SQL, on the sample tables and on awkward rows."""

import os

import duckdb
import pytest

from cardlake.llm import neardup, queries, substrings, suffixes
from compare import differences, duck

SF_DIR = os.environ.get("CARDLAKE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_equals_sql(spark, key):
    assert differences(queries.QUERIES[key](spark, SF_DIR), duck(SF_DIR), queries.ORACLE[key]) == ""


@pytest.mark.parametrize(
    "key, operator",
    [
        ("op3_bwt_merge_dedup", lambda docs: suffixes.remove_repeats(docs, with_bytes=False)),
        ("op7_countmin_substrings", substrings.removed_words),
        ("op8_setsketch_neardup", neardup.near_duplicates),
    ],
)
def test_awkward_rows_equal_sql(spark, key, operator):
    passage = " ".join(f"É{i} wörd{i}" for i in range(40))
    tail = " ".join(f"t{i}" for i in range(60))
    texts = [
        None, "", " \n", "one", "ONE", "x" * 99, "x" * 100, "x" * 250, passage, passage.upper(), passage,
        f"{passage} {tail}", f"{tail} {passage}", f"{tail} {passage}", f"{passage} {passage}", tail[:150],
        " ".join(f"v{i * i % 9973}" for i in range(20000)),
    ]
    rows = [(i * 5 % 17, t, "other") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _id string").repartition(3)
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    assert differences(operator(docs), connection, queries.ORACLE[key]) == ""
    connection.execute("DELETE FROM documents")
    assert differences(operator(docs.limit(0)), connection, queries.ORACLE[key]) == ""

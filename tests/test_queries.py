from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from muster import queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{SF}/{t}.parquet").exists():
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql(spark, tables, tmp_path, name):
    queries.QUERIES[name](spark, SF).write.parquet(str(tmp_path / name))
    tables.sql(f"CREATE OR REPLACE TABLE o AS {queries.ORACLE_SQL[name]}")
    tables.sql(f"CREATE OR REPLACE TABLE s AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    columns = sorted(r[0] for r in tables.sql("DESCRIBE o").fetchall())
    assert columns == sorted(r[0] for r in tables.sql("DESCRIBE s").fetchall())
    listed = ", ".join(f'"{c}"' for c in columns)
    for a, b in (("o", "s"), ("s", "o")):
        assert tables.sql(f"SELECT {listed} FROM {a} EXCEPT ALL SELECT {listed} FROM {b}").fetchall() == []


def test_landed_table_faults_of_rows_in_no_order(spark, tmp_path):
    """Orders in falling order, of keys that all tables of the query take."""
    path = str(tmp_path / "orders.parquet")
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * REPLACE (o_orderkey * 100 + 50 AS o_orderkey) FROM '{SF}/orders.parquet' ORDER BY o_orderkey DESC) TO '{path}' (FORMAT parquet)")
    con.execute(f"CREATE VIEW orders AS SELECT * FROM '{path}'")
    found = queries.QUERIES["landed_table_faults"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == sorted(con.sql(queries.ORACLE_SQL["landed_table_faults"]).fetchall())


@pytest.mark.parametrize("name", ["located_text", "sensitive_text"])
def test_findings_of_documents_with_one_id(spark, tmp_path, name):
    """Ids that several documents have, and documents without one, count together as in the SQL."""
    path = str(tmp_path / "documents.parquet")
    con = duckdb.connect()
    mail, place = "\na@b.org c@d.org\nx e@f.org", "12 Main stó\n12-3456789"
    rows = [(1, mail), (1, place), (1, "\ng@h.org"), (None, mail), (None, place), (None, mail), (2, place), (3, None), (3, mail)]
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    con.execute(f"COPY documents TO '{path}' (FORMAT parquet)")
    found = queries.QUERIES[name](spark, str(tmp_path)).collect()
    order = lambda r: tuple((v is None, v or 0) for v in r)
    wanted = con.sql(queries.ORACLE_SQL[name]).fetchall()
    assert sorted(map(tuple, found), key=order) == sorted(wanted, key=order)
    assert [r[-1] for r in sorted(wanted, key=order) if r[:2] == ("email", 1)] == ([3, 1] if name == "located_text" else [4])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

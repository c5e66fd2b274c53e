"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import math

import duckdb
import pytest

from paperloom.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "~"
    return repr(round(value, 6) + 0.0) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(tuple(map(plain, r)) for r in df.select(*columns).collect())
    if name not in catalogue.ORACLE:
        return
    relation = duck.sql(catalogue.ORACLE[name])
    assert sorted(relation.columns) == columns
    listed = ", ".join(f'"{c}"' for c in columns)
    assert rows == sorted(tuple(map(plain, r)) for r in duck.sql(f"SELECT {listed} FROM ({catalogue.ORACLE[name]})").fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(catalogue.ORACLE) <= set(entry.oracle_sql()) and set(catalogue.QUERIES) <= set(entry.queries())


def test_filters_and_columns_reach_the_scan(spark):
    plan = catalogue.threshold_flags(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "c_acctbal" not in plan and "Python" not in plan
    plan = catalogue.form_union(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in plan.replace("IsNotNull(doc_id), ", "").replace(", IsNotNull(doc_id)", "") and "text" not in plan.split("ReadSchema")[1]


def test_top5_targets_long_order(spark, tmp_path):
    """Lines of orders of any length have related fields."""
    c = duckdb.connect()
    # those that errors refer to have been read again; the last ones are the least sure
    lines = f"SELECT l.* REPLACE (k // 40 AS l_orderkey, (k % 40)::INTEGER AS l_linenumber, (k % 40) / 100.0::DOUBLE AS l_discount, CASE WHEN k % 2 = 0 THEN 'F' ELSE 'O' END AS l_linestatus) FROM range(80) r(k), (SELECT * FROM '{SF}/lineitem.parquet' LIMIT 1) l"
    c.sql(f"COPY ({lines}) TO '{tmp_path}/lineitem.parquet'")
    c.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet'")
    df = catalogue.QUERIES["top5_targets"](spark, str(tmp_path))
    rows = sorted(map(tuple, df.select("doc_id", "field_key", "turn").collect()))
    assert len(rows) == 10 and rows == sorted(c.sql(f"SELECT doc_id, field_key, turn FROM ({catalogue.ORACLE['top5_targets']})").fetchall())


def test_cells_do_not_go_to_the_driver(spark):
    """The planner takes exploded cells for small; their answers are joined with them without a broadcast."""
    plan = catalogue.QUERIES["two_pass_tables"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan

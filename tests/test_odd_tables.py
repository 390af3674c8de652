"""Queries on tables unlike the given ones, against the same SQL."""

import duckdb
import pytest

from recordloom.queries import QUERIES, SQL

from .compare import rows_of, sql_rows


def _table(tmp_path, name, sql):
    duckdb.sql(f"copy ({sql}) to '{tmp_path}/{name}.parquet' (format parquet)")


def _same(spark, tmp_path, name):
    got, want = rows_of(QUERIES[name](spark, str(tmp_path))), sql_rows(str(tmp_path), SQL[name])
    assert want[1] and got == want


def test_codes_of_halves(spark, tmp_path):
    """SQL casts halves to the even number: of 50, 150 and 250 come 0, 2 and 2."""
    values = [20.0, 50.0, 150.0, 250.0, 249.99, 250.01, 350.0]
    rows = " union all ".join(f"select {i} as event_id, timestamp '2024-01-0{i + 1}' as ts, 7 as user_id, 'view' as event_type, {v}::double as value, '{{}}' as props" for i, v in enumerate(values))
    _table(tmp_path, "events", rows)
    _same(spark, tmp_path, "r07_signal_events")


def test_register_codes_of_six_digits(spark, tmp_path):
    _table(tmp_path, "customer", "select range + 89980 as c_custkey, 'c' as c_name, cast(range % 3 as integer) as c_nationkey, 0.0 as c_acctbal, 'BUILDING' as c_mktsegment from range(60)")
    _same(spark, tmp_path, "t08_parse_register")
    _same(spark, tmp_path, "t08_parse_register_rest")

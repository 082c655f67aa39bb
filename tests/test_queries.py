"""A sample of the registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL

TABLES = "documents labels pages conversations benchmark events lineitem".split()
QUICK = (
    "deduplicated_by_source", "group_hashes", "mail_features", "class_sample", "conversation_split", "leakage_rates",
    "data_checks", "full_report", "chosen_threshold", "fitted_temperature", "error_rules", "page_text",
)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([round(r[i], 9) + 0.0 if isinstance(r[i], float) else r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SMALL)
    want = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.columns, got.collect()) == _rows(columns, want.fetchall())


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0

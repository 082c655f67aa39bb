"""Queries that take in all rows, against their SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from mailsift.plans.inputs import labelled
from test_queries import _rows, duck  # noqa: F401

WHOLE = (
    "raw_mail_records", "scored_messages", "scoring_history", "block_sizes", "parsed_mail", "sigmoid_calibration", "platt_scaling",
)


@pytest.mark.parametrize("name", WHOLE)
def test_whole_query_equals_sql(spark, duck, name):  # noqa: F811
    got = entry.queries()[name](spark, SMALL)
    want = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.columns, got.collect()) == _rows(columns, want.fetchall())


def test_svd_block_is_fitted_on_train_only(spark):
    rows = entry.queries()["svd_block"](spark, "/root/testdata/sf0.01")
    first = rows.first()
    train = labelled(spark, "/root/testdata/sf0.01").filter("split = 'train'").select("email_id")
    assert len(first["svd"]) == 200
    assert abs(rows.join(train, "email_id").agg({"char_len": "avg"}).first()[0]) < 1e-9  # scaled by the mean of train
    assert rows.count() == 1000


def test_a_table_in_several_files_is_streamed_whole(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    one, several = (entry.queries()["streamed_mail"](spark, folder) for folder in (SMALL, str(tmp_path)))
    assert sorted(map(tuple, several.collect())) == sorted(map(tuple, one.collect())) != []

"""Deduplication, samples, splits and guards."""

import pytest
from pyspark.sql import functions as F

from mailsift.operators import audit, curate


def groups(spark, ham=80, spam=20):
    rows = [(f"g{i}", f"g{i}", int(i >= ham)) for i in range(ham + spam)]
    return spark.createDataFrame(rows, "group_key string, thread_group string, label int")


def test_every_split_has_both_labels(spark):
    out = curate.split_by_group(groups(spark))
    counts = {(r.split, r.label): r["count"] for r in out.groupBy("split", "label").count().collect()}
    assert counts == {("train", 0): 48, ("train", 1): 12, ("valid", 0): 16, ("valid", 1): 4, ("test", 0): 16, ("test", 1): 4}


def test_published_sizes(spark):
    out = curate.split_by_group(groups(spark, 4000, 1000))
    curate.require_split_sizes(out, {"train": 3500, "valid": 750, "test": 750})
    curate.require_label_counts(out, {0: 4000, 1: 1000}, 5000)
    assert curate.leakage(out).first()["rate"] == 0.0


def test_giant_group_stays_whole(spark):
    rows = groups(spark).unionByName(groups(spark).filter("group_key = 'g3'").crossJoin(spark.range(500)).drop("id"))
    out = curate.split_by_group(rows)
    assert out.groupBy("group_key").agg(F.count_distinct("split").alias("n")).filter("n > 1").isEmpty()


def test_mixed_labels_are_refused(spark):
    mixed = groups(spark).unionByName(spark.createDataFrame([("g1", "g1", 1)], "group_key string, thread_group string, label int"))
    with pytest.raises(ValueError):
        curate.split_by_group(mixed)


def test_too_few_groups(spark):
    with pytest.raises(ValueError):
        curate.split_by_group(groups(spark, 5, 1))


def test_sample_is_exact_and_short_classes_fail(spark):
    rows = groups(spark).withColumnRenamed("group_key", "email_id")
    out = curate.sample_classes(rows, {0: 7, 1: 20})
    assert curate.class_counts(out) == {0: 7, 1: 20}
    again = curate.sample_classes(rows.repartition(7), {0: 7, 1: 20})
    assert {r.email_id for r in out.collect()} == {r.email_id for r in again.collect()}
    with pytest.raises(ValueError):
        curate.sample_classes(rows, {0: 81})


def test_hot_body_is_one_row(spark):
    rows = spark.range(100_000).select(
        F.lpad(F.col("id").cast("string"), 6, "0").alias("email_id"), F.lit("s").alias("source_dataset"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("duplicate_group"),
    )
    kept = curate.deduplicate(rows)
    assert kept.count() == 66_667
    assert kept.filter("duplicate_group = 'hot'").first()["email_id"] == "000000"
    assert curate.deduplicate(kept).count() == 66_667


def test_caller_map_must_cover_every_group(spark):
    rows = groups(spark, 3, 0)
    with pytest.raises(Exception, match="No split for group"):
        curate.assign_by_group(rows, spark.createDataFrame([("g0", "train")], "group_key string, split string")).collect()


def test_empty_test_split_has_no_leakage(spark):
    rows = groups(spark, 3, 0).withColumn("split", F.lit("train"))
    assert curate.leakage(rows).first()["rate"] == 0.0
    assert audit.md5_overlap(rows.withColumn("clean_text", F.lit("x"))).first()["rate"] == 0.0


def test_exact_sample_refuses_repeated_keys(spark):
    rows = spark.createDataFrame([(str(i % 9), i % 2) for i in range(18)], "email_id string, label int")
    with pytest.raises(ValueError, match="repeated"):
        curate.sample_classes(rows.union(rows), {0: 2, 1: 2})


def test_label_words_with_any_white_space(spark):
    from mailsift.sources import tables

    words = spark.createDataFrame([("spam\t",), ("1\n",), ("\u00a0ham",), (" no such",)], "word string")
    assert [r[0] for r in words.select(tables.label_of(words["word"])).collect()] == [1, 1, 0, None]


def test_the_first_row_of_a_group_is_fetched_by_a_semi_join(spark):
    rows = [("g", "b", "1", "x"), ("g", "a", "9", "y"), ("g", "a", "9", "y"), ("h", "a", None, "z"), ("h", "a", "2", "w"), (None, None, None, "n"), ("k", "c", "3", "k")]
    frame = spark.createDataFrame(rows, "duplicate_group string, source_dataset string, email_id string, text string").repartition(3)
    kept = curate.deduplicate(frame)
    assert sorted(r.text for r in kept.collect()) == ["k", "n", "y", "z"]
    plan = curate.deduplicate(frame.filter("text <> 'y'"))._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "Aggregate" not in plan and "Window" not in plan


def test_equal_rows_are_numbered(spark):
    from mailsift.sources.records import number_copies

    frame = spark.createDataFrame([("a", 1)] * 5 + [("b", None)] * 2 + [("c", 2)], "text string, n int").repartition(4)
    got = sorted((r.text, r.copy_no) for r in number_copies(frame).collect())
    assert got == [("a", i) for i in range(5)] + [("b", 0), ("b", 1), ("c", 0)]

"""From corpora to audited splits: the data side of the work, stage by stage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from mailsift.config import Settings
from mailsift.operators import audit, curate
from mailsift.sources.records import union_corpora
from mailsift.sources.tables import write_table

REJECTS = "path string, error string"


@dataclass
class Dataset:
    """The split mail and the tables that describe how it came about."""

    split: DataFrame
    funnel: DataFrame
    sources: DataFrame
    checks: DataFrame
    rejects: DataFrame


def build_dataset(
    spark, corpora: list[DataFrame | None], out: str, settings: Settings = Settings(), rejects: list[DataFrame] = (),
) -> Dataset:
    """Union, filter, deduplicate, sample, split and audit; each large stage is written once.

    ``corpora`` may hold records that are flagged as corrupted (``corrupted_records``): the funnel
    counts them, the filter drops them. ``rejects`` are tables (path, error or parse_error) of what no
    record could be made of, messages and table files alike; they are written beside the records.

    Records are written with their hashes, so later stages never hash a text again. The split
    table is partitioned by split, so reading one split prunes the others.
    """
    refused = spark.createDataFrame([], REJECTS)
    for table in rejects:
        refused = refused.union(table.select("path", F.col(table.columns[-1]).alias("error")))
    write_table(refused, f"{out}/rejects")
    write_table(union_corpora(*corpora), f"{out}/records", partition_by=("source_dataset",))
    records = spark.read.parquet(f"{out}/records")
    write_table(curate.deduplicate(curate.drop_corrupted(records)), f"{out}/deduplicated")
    unique = spark.read.parquet(f"{out}/deduplicated")
    sample = curate.with_group_key(curate.sample_classes(unique, settings.class_sizes, settings.seed))
    rows = sum(settings.class_sizes.values())
    curate.require_label_counts(sample, settings.class_sizes, at_least=rows)
    write_table(curate.split_by_group(sample, settings.seed, settings.split_sizes), f"{out}/split", partition_by=("split",))
    split = spark.read.parquet(f"{out}/split")
    curate.require_split_sizes(split, settings.split_sizes)
    return Dataset(
        split, curate.funnel(records, split), curate.source_by_split(split), audit.overlap_checks(split), spark.read.schema(REJECTS).parquet(f"{out}/rejects"),
    )

"""Session builder and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_BYTES = 16_000_000  # a side is broadcast only if its rows were measured and take no more than this


def build_session(app_name: str = "mailsift", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew-join handling and UTC timestamps."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A private temporary folder is used only where no folder is named and the session is
    local, as in tests: on a cluster other machines could not read it.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that every executor can reach.")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="mailsift-checkpoint-"))
        current = context.getCheckpointDir()
    return current


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet below the shared checkpoint folder and read it back.

    The result survives lost executors and is read, not recomputed, by every consumer. Unlike a
    checkpoint the table is compressed, has statistics and is read column by column.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def side_by_side[A, B](work: Callable[[A], B], items: Iterable[A]) -> list[B]:
    """The work on a few items at the same time and its results in their order: many short jobs fill each other's gaps."""
    items = list(items)
    with ThreadPoolExecutor(max(1, len(items))) as pool:
        return list(pool.map(work, items))


def bounded_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Marked for broadcast only if the bytes of its rows were added up and are few; else a plain side.

    ``df`` is meant to be a written table, as it is read once for the sum.
    """
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) if t in ("string", "binary") else F.lit(16) for c, t in df.dtypes]
    total = df.agg(F.coalesce(F.sum(sum(sizes, F.lit(16)).cast("long")), F.lit(0))).first()[0]
    return F.broadcast(df) if total <= limit else df

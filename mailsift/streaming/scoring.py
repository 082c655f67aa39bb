"""Continuous scoring of arriving mail: the batch scorer on a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from mailsift.operators.scoring import MailModel


def mail_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet", name_filter: str | None = None, files_per_batch: int = 1000) -> DataFrame:
    """New files of ``folder`` as a stream with a declared schema.

    ``folder`` may be a pattern: of what it matches, files are read as they are and folders by their files.
    """
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(folder)


def score_stream(mail: DataFrame, model: MailModel, sink: str, checkpoint: str, keep: tuple[str, ...] = ("email_id",)) -> StreamingQuery:
    """Append scored mail to ``sink``, each row once, and stop when the present files are done.

    Scoring holds no state, so the output equals the batch scorer's row for row.
    """
    scored = model.score(mail).select(*keep, "probability", "pred", "risk", "risk_code")
    return (
        scored.writeStream.format("parquet").outputMode("append")
        .option("path", sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )

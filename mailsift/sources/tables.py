"""Table sources and sinks: CSV/TSV corpora in, Parquet/CSV/JSON out."""

from __future__ import annotations

import csv
import gzip
import io
import re
import zlib
from collections.abc import Iterable, Iterator, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from mailsift.functions import patterns as P
from mailsift.functions.text import strip
from mailsift.session import written

# Header aliases of the two kinds of labelled table.
LABELLED_MAIL_ROLES = {
    "text": ("text", "body", "message", "email", "content"),
    "label": ("spam", "label", "is_spam", "class", "spam/ham", "spam_ham"),
    "subject": ("subject",),
    "sender": ("from", "sender", "author"),
}
PREPROCESSED_ROLES = {
    "text": ("text", "body", "message"),
    "label": ("label", "spam", "spam_ham", "class"),
}
SCORING_ROLES = ("text", "body", "clean_text", "message")
KNOWN_HEADERS = {
    "message id": "message_id",
    "spam/ham": "spam_ham",
    "message": "text",
    "subject": "subject",
    "date": "date",
}
CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    sep: str = ",",
    multi_line: bool = True,
) -> DataFrame:
    """A table with a header row. Without a schema every column is a string; none is inferred.

    Damaged lines are kept in ``_corrupt_record`` when the schema declares it; a file that cannot
    be read to its end stops the job, so none is ever read by half (``scan_tables`` names such files
    beforehand). Quoted line breaks need ``multi_line``, which makes a file one read unit: turn it off
    for very large files that have none.
    """
    reader = (
        spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line).option("mode", "PERMISSIVE").option("encoding", "UTF-8")
        .option("columnNameOfCorruptRecord", CORRUPT).option("ignoreCorruptFiles", False)
    )
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def resolve_columns(columns: Iterable[str], roles: Mapping[str, tuple[str, ...]]) -> dict[str, str]:
    """Column per role by trimmed, case-insensitive alias; the last match wins."""
    role_of = {alias: role for role, aliases in roles.items() for alias in aliases}
    found: dict[str, str] = {}
    for column in columns:
        role = role_of.get(column.lower().strip())
        if role:
            found[role] = column
    return found


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def select_roles(df: DataFrame, roles: Mapping[str, tuple[str, ...]], keep: tuple[str, ...] = ()) -> DataFrame | None:
    """The role columns of one table, or None when it has no text or no label."""
    found = resolve_columns((c for c in df.columns if c not in keep), roles)
    if "text" not in found or "label" not in found:
        return None
    picked = [
        (quoted(found[role]) if role in found else F.lit("")).cast("string").alias(role)
        for role in ("text", "label", "subject", "sender")
    ]
    return df.select(*keep, *picked)


def rename_known_headers(df: DataFrame) -> DataFrame:
    """The known headers under their plain names; a name that another column has already is left alone."""
    plain = {c: c.lower().strip() for c in df.columns}
    renames = {c: KNOWN_HEADERS[n] for c, n in plain.items() if n in KNOWN_HEADERS}
    taken = [n for c, n in plain.items() if c not in renames]
    targets = list(renames.values())
    return df.withColumnsRenamed({c: n for c, n in renames.items() if n not in taken and targets.count(n) == 1})


def _checked(content: pa.Buffer, sep: str, packed: bool) -> tuple[list[str] | None, str | None]:
    """(header, None) of a sound file, (None, error) of any other: all of it is read once, some lines at a time."""
    try:
        plain = gzip.GzipFile(fileobj=pa.BufferReader(content)) if packed else pa.BufferReader(content)
        rows = csv.reader(io.TextIOWrapper(plain, encoding="utf-8-sig", newline=""), delimiter=sep, strict=True)
        header = next(rows, None)
        if not header:
            return None, "ValueError: no header"
        for row in rows:
            if len(row) > len(header):
                return None, f"ValueError: line {rows.line_num} has {len(row)} fields, the header {len(header)}"
    except (OSError, EOFError, UnicodeDecodeError, csv.Error, zlib.error) as error:
        return None, f"{type(error).__name__}: {error}"
    return header, None


def scan_tables(spark: SparkSession, root: str) -> DataFrame:
    """(path, sep, columns, error) of every CSV and TSV file under ``root``, plain or gzipped, in one job.

    A file is sound if it decodes as UTF-8 to its end, closes its quotes, and has no line longer than
    its header; any other has its error instead of columns. The separator follows the suffix. Files of
    a task are as many as make up one read partition, or one larger file.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{csv,tsv,csv.gz,tsv.gz}").load(root).select("path", "content")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(1 << 31)
        for batch in batches:
            paths = batch.column("path").to_pylist()
            seps = ["\t" if re.search(r"\.tsv(\.gz)?$", path, re.I) else "," for path in paths]
            found = [_checked(c.as_buffer(), sep, p.lower().endswith(".gz")) for p, c, sep in zip(paths, batch.column("content"), seps)]
            yield pa.RecordBatch.from_arrays([
                batch.column("path"), pa.array(seps), pa.array([c for c, _ in found], pa.list_(pa.string())),
                pa.array([e for _, e in found], pa.string()),
            ], names=["path", "sep", "columns", "error"])

    return written(files.mapInArrow(check, "path string, sep string, columns array<string>, error string"), "table-scan")


def skipped_tables(scan: DataFrame) -> DataFrame:
    """(path, error) of the files that are left out as a whole."""
    return scan.filter(F.col("error").isNotNull()).select("path", "error")


def _string_schema(columns: list[str]) -> T.StructType:
    """Every column a string; a repeated name gets its position."""
    names = [c if columns.index(c) == i else f"{c}_{i}" for i, c in enumerate(columns)]
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def read_labelled_tables(
    spark: SparkSession, root: str, roles: Mapping[str, tuple[str, ...]] = LABELLED_MAIL_ROLES, scan: DataFrame | None = None
) -> DataFrame | None:
    """All sound labelled tables under ``root`` as (source_path, text, label, subject, sender).

    One job has checked the files and found their headers (``scan``); files that share a header are
    one scan more, and files without a text or label column, or damaged, give no rows at all. Known
    headers are renamed first, where that clashes with no other column. The driver holds the names of
    the files, as it does for any scan of them.
    """
    scan = scan_tables(spark, root) if scan is None else scan
    groups = scan.filter(F.col("error").isNull()).groupBy("sep", "columns").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    parts = []
    for group in groups.orderBy("sep", "columns").collect():
        table = read_csv(spark, group.paths, schema=_string_schema(group.columns), sep=group.sep)
        part = select_roles(rename_known_headers(table).withColumn("source_path", F.col("_metadata.file_path")), roles, keep=("source_path",))
        if part is not None:
            parts.append(part)
    return reduce(DataFrame.unionByName, parts) if parts else None


def label_of(word: Column) -> Column:
    """1, 0 or null for the published label words; any white space around a word is ignored."""
    plain = F.lower(strip(word.cast("string")))
    return F.when(plain.isin(*P.TRUE_LABELS), F.lit(1)).when(plain.isin(*P.FALSE_LABELS), F.lit(0))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()) -> None:
    """Parquet by default; ``fmt="csv"`` gives quoted UTF-8 text with a header."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"').option("encoding", "UTF-8")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_report(report: DataFrame, path: str) -> None:
    """A metric report as JSON lines; reports have a handful of rows."""
    report.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)

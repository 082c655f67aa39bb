"""Raw message files: scan, label index, and the bulk parse job."""

from __future__ import annotations

from collections.abc import Iterator
from email import policy
from email.parser import BytesParser
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailsift.functions.text import clean_text
from mailsift.sources.html import page_text

_PARSED = (
    "body string, html_text string, subject string, sender string, date string, message_id string, "
    "has_html boolean, attachment_hint boolean, parse_error string"
)


_FLAGS = ("has_html", "attachment_hint")
BATCH_BYTES = 4_000_000  # of messages that a task has parsed at once


def byte_ranges(contents: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(start, stop) of runs of one value, or of at most ``most`` bytes in all."""
    start = total = 0
    for i, length in enumerate(pc.fill_null(pc.binary_length(contents), 0).to_pylist()):
        if i > start and total + length > most:
            yield start, i
            start, total = i, 0
        total += length
    if start < len(contents):
        yield start, len(contents)


def scan_mail_files(spark: SparkSession, root: str) -> DataFrame:
    """Non-empty files under ``root`` that look like messages: (path, length, content).

    A name qualifies with no suffix or with any dot, which covers ``.eml``, ``.txt``,
    digits-only names and hashed names. Size and name are tested before content is read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    name = F.element_at(F.split("path", "/"), -1)
    return files.filter((F.col("length") > 0) & name.rlike(r"^[^.]+$|\.")).select("path", "length", "content")


def read_label_index(lines: DataFrame, line_col: str = "value", words: bool = False) -> DataFrame:
    """Index lines of exactly two tokens, a 0/1 label and a path; other lines are dropped.

    ``words=True`` also takes ``spam`` and ``ham`` as labels.
    """
    tokens = F.split(clean_text(F.col(line_col)), " ")
    allowed = ("0", "1", "spam", "ham") if words else ("0", "1")
    parsed = lines.select(tokens.alias("t")).filter((F.size("t") == 2) & F.col("t")[0].isin(*allowed))
    label = F.col("t")[0].isin("1", "spam").cast("int")
    return parsed.select(
        F.col("t")[1].alias("relative_path"),
        label.alias("label"),
        F.when(label == 1, "spam").otherwise("ham").alias("source_label"),
    )


def resolve_path(path: Column) -> Column:
    """``.`` and ``..`` segments folded away, as the file system would."""
    start = F.array().cast("array<string>")
    kept = F.aggregate(
        F.split(path, "/"),
        start,
        lambda done, part: F.when(part.isin("", "."), done)
        .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    return F.array_join(kept, "/")


def join_label_index(index: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """Index entries with their files; entries without a file drop out in the join."""
    wanted = index.withColumn("_key", resolve_path(F.concat(F.lit(root + "/"), "relative_path")))
    present = files.withColumn("_key", resolve_path(F.regexp_replace("path", r"^file:/*|^[a-z0-9]+://[^/]*/", "/")))
    return wanted.join(present, "_key").drop("_key")


def _relative(path: Column, root: str) -> Column:
    plain_root = root.rstrip("/") + "/"
    at = F.instr(path, plain_root)
    return F.when(at > 0, F.substring(path, at + len(plain_root) - 1, F.length(path))).otherwise(path)


def label_from_path(path: Column, root: str) -> Column:
    """1, 0 or -1 from the directory names *below* the corpus root.

    The root's own name and the file name are not looked at: a corpus folder with ``spam`` in
    its name must not label every message.
    """
    folders = F.lower(F.regexp_replace(_relative(path, root), r"[^/]*$", ""))
    return F.when(folders.contains("spam"), F.lit(1)).when(folders.contains("ham"), F.lit(0)).otherwise(F.lit(-1))


def sender_from_path(path: Column) -> Column:
    """``spam``, ``ham`` or ``unknown`` by path. It leaks the label into the group key."""
    lower = F.lower(F.translate(path, "\\", "/"))

    def named(key: str) -> Column:
        return lower.contains(f"/{key}/") | lower.endswith(f"/{key}") | lower.contains(f"_{key}")

    return F.when(named("spam"), "spam").when(named("ham"), "ham").otherwise("unknown")


def _storable(text: str | None) -> str:
    return ("" if text is None else str(text)).encode("utf-8", "ignore").decode("utf-8")


def _body_of(part) -> str:
    """Decoded text of one part, empty when it cannot be decoded."""
    try:
        content = part.get_content()
    except Exception:
        return ""
    if not isinstance(content, str):
        raise TypeError(f"{part.get_content_type()} is not a text body")
    return content


@lru_cache(maxsize=256)  # a parsed header takes some ten thousand bytes
def _short_header(name: str, value: str):
    return policy.default.header_fetch_parse(name, value)


class _OncePerHeader(policy.EmailPolicy):
    """The default policy, which parses a header anew each time it is asked for, with a memory of short ones."""

    def header_fetch_parse(self, name, value):
        if type(value) is str and len(value) <= 200:
            return _short_header(name, value)
        return super().header_fetch_parse(name, value)


ONCE = _OncePerHeader()


def _parse_message(raw: bytes) -> tuple:
    message = BytesParser(policy=ONCE).parsebytes(raw)
    parts = list(message.walk()) if message.is_multipart() else [message]
    found: dict[str, list[str]] = {"plain": [], "html": []}
    attached = has_html = False
    for part in parts:
        kind = part.get_content_type()
        if len(parts) > 1 or message.is_multipart():
            attached |= bool(part.get_filename()) or part.get_content_disposition() == "attachment"
            if kind not in ("text/plain", "text/html"):
                continue
        has_html |= kind == "text/html"
        found["html" if kind == "text/html" else "plain"].append(_body_of(part))
    plain, markup = ("\n".join(filter(None, found[k])).strip() for k in ("plain", "html"))
    visible = page_text(markup)
    headers = [message.get(name, "") for name in ("subject", "from", "date", "message-id")]
    return (*map(_storable, (plain or visible, visible, *headers)), has_html, attached, None)


def _parse_or_reject(raw: bytes) -> tuple:
    try:
        return _parse_message(bytes(raw))
    except Exception as error:  # one bad message must not stop the job
        return ("", "", "", "", "", "", False, False, f"{type(error).__name__}: {error}")


def parse_mail(df: DataFrame, content_col: str = "content") -> DataFrame:
    """Bytes to the nine message fields plus ``parse_error``; all other columns are kept.

    Python only decodes the message. Cleaning and the fallback id are native expressions.
    """
    keep = [c for c in df.columns if c != content_col]
    digest = "_digest"
    source = df.select(*keep, F.sha2(content_col, 256).alias(digest), F.col(content_col).alias("_content"))
    kept_schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields if f.name != "_content"
    )
    names = [piece.strip().split(" ")[0] for piece in _PARSED.split(",")]

    def parse_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.drop_columns(["_content"])
            for start, stop in byte_ranges(batch.column("_content"), BATCH_BYTES):
                fields = zip(*(_parse_or_reject(raw.as_py()) for raw in batch.column("_content").slice(start, stop - start)))
                arrays = [pa.array(field, pa.bool_() if name in _FLAGS else pa.string()) for name, field in zip(names, fields)]
                yield pa.RecordBatch.from_arrays([*kept.slice(start, stop - start).columns, *arrays], names=[*kept.schema.names, *names])

    parsed = source.mapInArrow(parse_batches, f"{kept_schema}, {_PARSED}")
    message_id = clean_text(F.col("message_id"))
    return parsed.select(
        *keep,
        F.col("body").alias("raw_text"),
        clean_text(F.col("body")).alias("clean_text"),
        *[clean_text(F.col(c)).alias(c) for c in ("subject", "sender", "date")],
        F.when(message_id == "", F.col(digest)).otherwise(message_id).alias("message_id"),
        "has_html", "html_text", "attachment_hint", "parse_error",
    )

"""Mail-shaped views of the given tables, in Spark and in SQL, with no random function.

The tables hold hardly any link, address, tag or keyword, so each text gets one of a few
fixed endings by id; otherwise most counters would only ever be checked on zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailsift.functions.text import clean_text, hash32
from mailsift.operators.curate import bucket_split
from mailsift.plans.registry import table

# Endings by document number modulo their count.
ENDINGS = (
    " FREE offer, click http://a.example/x WWW.b.example https://c.example/y?z=1 verify@shop.example",
    " system notice 555-123-4567 (call +1 415-555-2671)",
    " winnnn!!!! unsubscribe or manage preferences; winner WIN",
    " see attached file $9 <b>bold</b> <a href=\"x\">link</a>",
    " urgent discount bonus: buy cheap gift, limited credit (save 50)",
    "",
    " <html><body>alert: verify account [now] {sale}</body></html>",
)


def _ending(doc_id: Column) -> Column:
    out = F.lit(ENDINGS[0])
    for i, text in enumerate(ENDINGS[1:], start=1):
        out = F.when(doc_id % len(ENDINGS) == i, F.lit(text)).otherwise(out)
    return out


def as_mail(documents: DataFrame) -> DataFrame:
    """(email_id, source_dataset, sender, subject, text, clean_text), batch or stream."""
    doc = F.col("doc_id")
    text = F.concat(F.col("text"), _ending(doc))
    return documents.select(
        doc.cast("string").alias("email_id"),
        F.col("source").alias("source_dataset"),
        F.when(doc % 11 == 0, "").otherwise(
            F.concat(F.lit("User"), (doc % 37).cast("string"), F.lit("@Example.com"))
        ).alias("sender"),
        F.concat(
            F.when(doc % 4 == 0, "Re: ").when(doc % 4 == 1, "FW : ").otherwise(""),
            F.lit("Topic "), (doc % 53).cast("string"),
        ).alias("subject"),
        text.alias("text"),
        clean_text(text).alias("clean_text"),
    )


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as mail."""
    return as_mail(table(spark, sf_dir, "documents"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled emails, with a split by hash bucket of the id."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("email_id"), F.col("toxic").alias("label"))
    return emails(spark, sf_dir).join(labels, "email_id").withColumn("split", bucket_split(F.col("email_id")))


def _score(key: Column, label: Column, salt: str, spread: float, digits: int) -> Column:
    uniform = hash32(salt, key) / F.lit(4294967296.0)
    mixed = F.lit(spread) * uniform + F.lit(1.0 - spread) * label
    return F.floor(mixed * F.lit(10.0**digits) + F.lit(0.5)) / F.lit(10.0**digits)


# Two made-up models, a sharp and a blunt one. Scores tie on purpose.
MODELS = {"sharp": 0.7, "blunt": 0.9}


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(email_id, label, source_dataset, model, probability) of the labelled emails."""
    base = table(spark, sf_dir, "documents").select(F.col("doc_id"), F.col("source").alias("source_dataset"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    rows = base.join(labels, "doc_id").withColumn("email_id", F.col("doc_id").cast("string"))
    models = F.array(*[
        F.struct(F.lit(name).alias("model"), _score(F.col("email_id"), F.col("label"), name, spread, 2).alias("probability"))
        for name, spread in MODELS.items()
    ])
    return rows.select("email_id", "label", "source_dataset", F.explode(models).alias("m")).select(
        "email_id", "label", "source_dataset", "m.*"
    )


def one_model(spark: SparkSession, sf_dir: str, name: str = "sharp") -> DataFrame:
    return scored(spark, sf_dir).filter(F.col("model") == name).drop("model")


def scored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, label, probability) of every order line: many rows and nearly no ties."""
    line = table(spark, sf_dir, "lineitem")
    key = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"))
    label = (F.col("l_returnflag") == "R").cast("int")
    return line.select(
        F.col("l_linestatus").alias("model"), label.alias("label"), _score(key, label, "line", 0.8, 7).alias("probability")
    )


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as mail: real groups, one label per group."""
    conv = F.col("conv_id")
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", conv.cast("string"), F.col("turn").cast("string")).alias("email_id"),
        F.lit("conversations").alias("source_dataset"),
        conv.cast("string").alias("group_key"),
        F.when(conv % 5 == 0, 1).otherwise(0).alias("label"),
        clean_text(F.col("text")).alias("clean_text"),
    )


# ---- the same views in SQL ---------------------------------------------------------------

WS = r"[\s\x0B\x1c-\x1f\x85\p{Z}]"
NWS = r"[^\s\x0B\x1c-\x1f\x85\p{Z}]"


def sql_clean(expression: str) -> str:
    return f"trim(regexp_replace(coalesce({expression}, ''), '{WS}+', ' ', 'g'))"


def sql_hash(seed: str, expression: str) -> str:
    return f"CAST(('0x' || substr(md5('{seed}:' || {expression}), 1, 8)) AS UBIGINT)::BIGINT"


def sql_score(key: str, label: str, salt: str, spread: float, digits: int) -> str:
    uniform = f"({sql_hash(salt, key)} / 4294967296e0)"
    scale = f"1e{digits}"
    return f"floor(({spread}e0 * {uniform} + {1.0 - spread!r}::DOUBLE * {label}) * {scale} + 0.5e0) / {scale}"


def sql_bucket_split(key: str, seed: int = 42) -> str:
    bucket = f"({sql_hash(f'split-{seed}', key)} % 10000)"
    return f"CASE WHEN {bucket} < 7000 THEN 'train' WHEN {bucket} < 8500 THEN 'valid' ELSE 'test' END"


_ENDING_SQL = "CASE doc_id % {n} {whens} END".format(
    n=len(ENDINGS), whens=" ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(ENDINGS))
)

CTES = {
    "emails": f"""emails AS (
  SELECT *, {sql_clean('text')} AS clean_text FROM (
    SELECT CAST(doc_id AS VARCHAR) AS email_id, source AS source_dataset,
      CASE WHEN doc_id % 11 = 0 THEN '' ELSE 'User' || (doc_id % 37) || '@Example.com' END AS sender,
      CASE doc_id % 4 WHEN 0 THEN 'Re: ' WHEN 1 THEN 'FW : ' ELSE '' END || 'Topic ' || (doc_id % 53) AS subject,
      text || {_ENDING_SQL} AS text
    FROM documents))""",
    "labelled": f"""labelled AS (
  SELECT e.*, l.toxic AS label, {sql_bucket_split('e.email_id')} AS split
  FROM emails e JOIN labels l ON e.email_id = CAST(l.doc_id AS VARCHAR))""",
    "scored": f"""scored AS (
  SELECT email_id, label, source_dataset, m.model, m.probability FROM (
    SELECT CAST(d.doc_id AS VARCHAR) AS email_id, l.toxic AS label, d.source AS source_dataset
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id) b,
  LATERAL (SELECT unnest([{', '.join(
      f"{{'model': '{name}', 'probability': {sql_score('b.email_id', 'b.label', name, spread, 2)}}}"
      for name, spread in MODELS.items())}]) AS m))""",
    "one_model": "one_model AS (SELECT email_id, label, source_dataset, probability FROM scored WHERE model = 'sharp')",
    "scored_lines": f"""scored_lines AS (
  SELECT l_linestatus AS model, label, {sql_score('k', 'label', 'line', 0.8, 7)} AS probability FROM (
    SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label,
      l_orderkey || '-' || l_linenumber || '-' || l_partkey AS k FROM lineitem))""",
    "turns": f"""turns AS (
  SELECT conv_id || '-' || turn AS email_id, 'conversations' AS source_dataset, CAST(conv_id AS VARCHAR) AS group_key,
    CASE WHEN conv_id % 5 = 0 THEN 1 ELSE 0 END AS label, {sql_clean('text')} AS clean_text FROM conversations)""",
}
_NEEDS = {"labelled": ("emails",), "one_model": ("scored",)}


def with_views(names: str, body: str, extra: str = "") -> str:
    """``body`` under the named views, the views they need, and further ``extra`` ones."""
    ordered: list[str] = []
    for name in names.split():
        ordered += [n for n in (*_NEEDS.get(name, ()), name) if n not in ordered]
    ctes = [CTES[n] for n in ordered] + ([extra] if extra else [])
    return "WITH " + ",\n".join(ctes) + "\n" + body

"""Record construction, curation, splits, leakage and audits."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from mailsift.functions import text as X
from mailsift.operators import audit, curate
from mailsift.plans.inputs import emails, labelled, sql_bucket_split, sql_clean, sql_hash, turns, with_views
from mailsift.plans.registry import query, r6, s6, table
from mailsift.plans.text_queries import sql_body_hash, sql_sender_group, sql_subject, sql_thread
from mailsift.schema import EMAIL_RECORD
from mailsift.session import checkpoint_dir, written
from mailsift.sources import mail_files, records, tables


def scratch(spark, name: str) -> str:
    """A new folder beside the session's checkpoints, which every executor can reach."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---- records -----------------------------------------------------------------------------

# Label words by document number, some of them not labels.
LABEL_WORDS = ("spam", " Ham ", "TRUE", "no", "1", "0", "yes", "false", "maybe")
_WORD_SQL = "CASE doc_id % {n} {w} END".format(
    n=len(LABEL_WORDS), w=" ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(LABEL_WORDS))
)
_LABEL_SQL = "CASE WHEN lower(trim({c})) IN ('1','spam','true','yes') THEN 1 WHEN lower(trim({c})) IN ('0','ham','false','no') THEN 0 END"


def _word(doc):
    out = F.lit(LABEL_WORDS[0])
    for i, word in enumerate(LABEL_WORDS[1:], start=1):
        out = F.when(doc % len(LABEL_WORDS) == i, F.lit(word)).otherwise(out)
    return out


@query(f"SELECT doc_id, {_LABEL_SQL.format(c='w')} AS label FROM (SELECT doc_id, {_WORD_SQL} AS w FROM documents) WHERE {_LABEL_SQL.format(c='w')} IS NOT NULL")
def label_words(spark, sf_dir):
    """Label words to 0 and 1; other words drop the row."""
    rows = table(spark, sf_dir, "documents").select("doc_id", tables.label_of(_word(F.col("doc_id"))).alias("label"))
    return rows.filter("label IS NOT NULL")


_PATH_SQL = "'/data/spamcorpus/' || CASE doc_id % 4 WHEN 0 THEN 'easy_ham' WHEN 1 THEN 'spam_2' WHEN 2 THEN 'hard_HAM/x' ELSE 'other' END || '/' || doc_id || '.spam.eml'"


def _path(doc):
    folder = F.when(doc % 4 == 0, "easy_ham").when(doc % 4 == 1, "spam_2").when(doc % 4 == 2, "hard_HAM/x").otherwise("other")
    return F.concat(F.lit("/data/spamcorpus/"), folder, F.lit("/"), doc.cast("string"), F.lit(".spam.eml"))


@query(f"""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 0 ELSE -1 END AS label,
  CASE WHEN contains(p, '/spam/') OR p LIKE '%/spam' OR contains(p, '_spam') THEN 'spam'
       WHEN contains(p, '/ham/') OR p LIKE '%/ham' OR contains(p, '_ham') THEN 'ham' ELSE 'unknown' END AS sender
  FROM (SELECT doc_id, lower({_PATH_SQL}) AS p FROM documents)""")
def path_labels(spark, sf_dir):
    """Label and fallback sender from the folders below the corpus root."""
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", _path(doc).alias("p")).select(
        "doc_id", mail_files.label_from_path(F.col("p"), "/data/spamcorpus").alias("label"),
        mail_files.sender_from_path(F.col("p")).alias("sender"),
    )


_LINE_SQL = """CASE doc_id % 7 WHEN 0 THEN '  1   ../mail/' || doc_id || '.eml ' WHEN 1 THEN '0 ./mail/' || doc_id || '.eml'
  WHEN 2 THEN '' WHEN 3 THEN '1 two tokens' WHEN 4 THEN 'x mail/' || doc_id || '.eml' WHEN 5 THEN '0 mail/missing-' || doc_id
  ELSE '0	mail/' || doc_id || '.eml' END"""


def _index_lines(spark, sf_dir):
    doc, name = F.col("doc_id"), F.concat(F.col("doc_id").cast("string"), F.lit(".eml"))
    kind = doc % 7
    line = (
        F.when(kind == 0, F.concat(F.lit("  1   ../mail/"), name, F.lit(" ")))
        .when(kind == 1, F.concat(F.lit("0 ./mail/"), name)).when(kind == 2, "").when(kind == 3, "1 two tokens")
        .when(kind == 4, F.concat(F.lit("x mail/"), name)).when(kind == 5, F.concat(F.lit("0 mail/missing-"), doc.cast("string")))
        .otherwise(F.concat(F.lit("0\tmail/"), name))
    )
    return table(spark, sf_dir, "labels").select(line.alias("value"))


_INDEX_SQL = rf"""SELECT t[2] AS relative_path, CAST(t[1] AS INTEGER) AS label, CASE WHEN t[1] = '1' THEN 'spam' ELSE 'ham' END AS source_label
  FROM (SELECT string_split({sql_clean(_LINE_SQL)}, ' ') AS t FROM labels) WHERE len(t) = 2 AND t[1] IN ('0', '1')"""


@query(_INDEX_SQL)
def label_index(spark, sf_dir):
    """Label lines of two tokens with a 0/1 label."""
    return mail_files.read_label_index(_index_lines(spark, sf_dir))


@query(f"""SELECT i.relative_path, i.label, i.source_label, d.path, d.doc_id FROM (
    SELECT *, regexp_replace('corpus/full/' || relative_path, 'full/\\.\\./|\\./', '', 'g') AS k FROM ({_INDEX_SQL})) i
  JOIN (SELECT doc_id, 'file:/corpus/' || CASE WHEN doc_id % 7 = 0 THEN '' ELSE 'full/' END || 'mail/' || doc_id || '.eml' AS path FROM documents) d
  ON 'file:/' || i.k = d.path""")
def indexed_files(spark, sf_dir):
    """Index entries joined to the files they name; ``.`` and ``..`` are folded."""
    doc = F.col("doc_id")
    path = F.concat(F.lit("file:/corpus/"), F.when(doc % 7 == 0, "").otherwise("full/"), F.lit("mail/"), doc.cast("string"), F.lit(".eml"))
    files = table(spark, sf_dir, "documents").select(path.alias("path"), "doc_id")
    return mail_files.join_label_index(label_index(spark, sf_dir), files, "/corpus/full")


def _raw_table(spark, sf_dir):
    """The mail as an unfamiliar labelled table: odd headers, label words, short bodies."""
    return emails(spark, sf_dir).select(
        F.lit("/in/mail.csv").alias("source_path"),
        F.col("text").alias(" Message"), _word(F.col("email_id").cast("bigint")).alias("Spam/Ham"),
        F.col("subject").alias("Subject"), F.col("sender").alias("FROM"), F.col("email_id").alias("row_key"),
    )


def table_records(spark, sf_dir):
    picked = tables.select_roles(_raw_table(spark, sf_dir), tables.LABELLED_MAIL_ROLES, keep=("source_path", "row_key"))
    return records.records_from_table(picked, "table_mail", key_col="row_key")


_RECORDS = f"""records AS (
  SELECT *, {sql_body_hash('clean_text')} AS body_group FROM (
    SELECT sha256('/in/mail.csv:' || email_id || ':' || substr(clean_text, 1, 200)) AS email_id, label, {sql_clean('subject')} AS subject,
      {sql_clean('sender')} AS sender, clean_text
    FROM (SELECT e.*, {_LABEL_SQL.format(c='w')} AS label FROM (SELECT *, {_WORD_SQL.replace('doc_id', 'CAST(email_id AS BIGINT)')} AS w FROM emails) e)
    WHERE label IS NOT NULL AND length(clean_text) >= 10))"""


@query(with_views("emails", f"""SELECT email_id, 'table_mail' AS source_dataset, CASE label WHEN 1 THEN 'spam' ELSE 'ham' END AS source_label, label,
  'raw/table_mail/' || email_id || '.txt' AS raw_path, 'clean/table_mail/' || email_id || '.txt' AS clean_path,
  subject, sender, '' AS date, email_id AS message_id,
  {sql_thread('subject', 'sender', 'body_group')} AS thread_group, {sql_sender_group('sender')} AS sender_group,
  sha256({sql_subject('subject')}) AS subject_group, body_group, clean_text AS raw_text, clean_text,
  false AS has_html, false AS attachment_hint, false AS is_corrupted, body_group AS duplicate_group FROM records""", _RECORDS))
def mail_records(spark, sf_dir):
    """20-field records from a labelled table whose columns are found by their headers."""
    return table_records(spark, sf_dir)


@query(with_views("emails", """SELECT source_path, text_md5, label, count(*) AS n FROM (
    SELECT '/in/mail.csv' AS source_path, md5(clean_text) AS text_md5, label FROM records) GROUP BY ALL""", _RECORDS))
def numbered_copies(spark, sf_dir):
    """Records of a table without a key column: every copy keeps its own id.

    Counting distinct ids gives the number of copies, so a lost or doubled id would show.
    """
    picked = tables.select_roles(_raw_table(spark, sf_dir), tables.LABELLED_MAIL_ROLES, keep=("source_path",))
    built = records.records_from_table(picked, "table_mail")
    return built.groupBy(F.lit("/in/mail.csv").alias("source_path"), X.md5_text(F.col("clean_text")).alias("text_md5"), "label").agg(
        F.count_distinct("email_id").alias("n")
    )


@query(with_views("emails", """SELECT source_dataset, label, count(*) AS n FROM (
    SELECT 'table_mail' AS source_dataset, label FROM records
    UNION ALL SELECT 'conversations', label FROM turns WHERE length(clean_text) >= 10) GROUP BY ALL""",
    _RECORDS + f""", turns AS (SELECT CASE WHEN conv_id % 5 = 0 THEN 1 ELSE 0 END AS label, {sql_clean('text')} AS clean_text FROM conversations)"""))
def corpora_union(spark, sf_dir):
    """Two corpora in one table, counted by source and label."""
    conversation = turns(spark, sf_dir).select(
        F.lit("/in/turns").alias("source_path"), F.col("clean_text").alias("text"), F.col("label").cast("string").alias("label"),
        F.lit("").alias("subject"), F.lit("").alias("sender"), "email_id",
    )
    second = records.records_from_table(conversation, "conversations", key_col="email_id")
    return records.union_corpora(table_records(spark, sf_dir), second).groupBy("source_dataset", "label").agg(F.count("*").alias("n"))


# ---- sinks read back ---------------------------------------------------------------------


@query(with_views("emails", """SELECT email_id, subject, md5(text) AS text_md5, length(text) AS chars FROM emails"""))
def csv_round_trip(spark, sf_dir):
    """Mail with quotes and line breaks written as CSV and read back by header."""
    path = scratch(spark, "csv")
    tables.write_table(emails(spark, sf_dir).select("email_id", "subject", "text"), path, fmt="csv")
    back = tables.read_csv(spark, path)
    return back.select("email_id", "subject", F.md5("text").alias("text_md5"), F.length("text").alias("chars").cast("bigint"))


@query(with_views("emails", """SELECT source_dataset, sum(octet_length(encode(text)) + 1)::BIGINT AS bytes, bit_xor(('0x' || substr(md5(text), 1, 15))::BIGINT) AS digest
  FROM (SELECT source_dataset, replace(replace(clean_text, chr(13), ' '), chr(10), ' ') AS text FROM emails) GROUP BY ALL"""))
def scanned_files(spark, sf_dir):
    """Mail written as text files in a folder for each source, and found again whole as raw files."""
    root = scratch(spark, "raw-files")
    text = F.replace(F.replace(F.col("clean_text"), F.lit("\r"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    emails(spark, sf_dir).select("source_dataset", text.alias("value")).write.partitionBy("source_dataset").text(root)
    files = mail_files.scan_mail_files(spark, root)
    source = F.regexp_extract("path", "source_dataset=([^/]+)/", 1).alias("source_dataset")
    line = F.explode(F.split(F.regexp_replace(F.decode("content", "UTF-8"), "\n$", ""), "\n"))
    sizes = files.groupBy(source).agg(F.sum("length").alias("bytes"))
    lines = files.select(source, line.alias("line")).groupBy("source_dataset").agg(
        F.bit_xor(F.conv(F.substring(F.md5("line"), 1, 15), 16, 10).cast("long")).alias("digest")
    )
    return sizes.join(lines, "source_dataset")


@query(with_views("emails", f"""SELECT 'rows' AS kind, CAST(email_id AS BIGINT) % 2 AS files, md5({sql_clean('subject')} || '/' || {sql_clean('text')}) AS digest, count(*) AS n
    FROM emails GROUP BY ALL UNION ALL SELECT 'skipped', 2, 'csv.Error', 1"""))
def table_corpus(spark, sf_dir):
    """Mail in many CSV and TSV files of two headers, found and read as a whole, and the one damaged file that is left out.

    The headers are the known ones, in their own spelling. A file whose quote never closes is skipped.
    """
    root = scratch(spark, "corpus")
    mail = emails(spark, sf_dir)
    odd = F.col("email_id").cast("bigint") % 2
    label = F.lit("ham")
    tables.write_table(mail.filter(odd == 0).select(
        F.col("subject").alias("Subject"), F.col("text").alias("Message"), label.alias("Spam/Ham"), F.lit("").alias("Date")), f"{root}/comma", fmt="csv")
    tables.write_table(mail.filter(odd == 1).select(
        label.alias(" CLASS"), F.col("text").alias("Body"), F.col("subject").alias("subject")), f"{root}/other", fmt="csv")
    broken = spark.createDataFrame([("text,label",), ("fine,ham",), ('"never closed,spam',)], "line string").coalesce(1)
    broken.write.option("sep", "\x01").option("quote", "\x02").option("escape", "\x02").csv(f"{root}/broken")
    scan = tables.scan_tables(spark, root)
    rows = tables.read_labelled_tables(spark, root, scan=scan)
    digest = F.md5(F.concat(X.clean_text(F.col("subject")), F.lit("/"), X.clean_text(F.col("text"))))
    files = F.when(F.col("source_path").contains("/comma/"), 0).otherwise(1).cast("bigint")
    found = rows.groupBy(F.lit("rows").alias("kind"), files.alias("files"), digest.alias("digest")).agg(F.count("*").alias("n"))
    skipped = tables.skipped_tables(scan).groupBy(
        F.lit("skipped").alias("kind"), F.lit(2).cast("bigint").alias("files"), F.concat(F.lit("csv."), F.substring_index("error", ":", 1)).alias("digest")
    ).agg(F.count("*").alias("n"))
    return found.union(skipped)


@query(with_views("emails", f"""SELECT 'table_mail' AS source_dataset, label, count(*) AS n, sum(length(clean_text))::BIGINT AS chars FROM records GROUP BY ALL""", _RECORDS))
def parquet_round_trip(spark, sf_dir):
    """Records with raw and clean text, partitioned by source, read back with the declared schema."""
    path = scratch(spark, "records")
    tables.write_table(table_records(spark, sf_dir), path, partition_by=("source_dataset",))
    back = spark.read.schema(EMAIL_RECORD).parquet(path)
    return back.groupBy("source_dataset", "label").agg(F.count("*").alias("n"), F.sum(F.length("clean_text")).alias("chars"))


# ---- curation ----------------------------------------------------------------------------


@query(with_views("emails", f"""SELECT source_dataset, count(*) AS mails, count(*) FILTER (first) AS unique_mails,
    count(*) FILTER (NOT first) AS copies_removed FROM (
  SELECT source_dataset, row_number() OVER (PARTITION BY {sql_body_hash('clean_text')} ORDER BY source_dataset, email_id) = 1 AS first
  FROM emails) GROUP BY source_dataset"""))
def deduplicated_by_source(spark, sf_dir):
    """Unique mail per source and the copies removed: the first copy by source and id stays.

    Only the hash, the source and the id are shuffled, once per distinct body and map task.
    """
    hashed = emails(spark, sf_dir).select("source_dataset", "email_id", X.body_hash(F.col("clean_text")).alias("duplicate_group"))
    kept = curate.deduplicate(hashed).groupBy("source_dataset").agg(F.count("*").alias("unique_mails"))
    mails = hashed.groupBy("source_dataset").agg(F.count("*").alias("mails"))
    return mails.join(kept, "source_dataset", "left").select(
        "source_dataset", "mails", F.coalesce("unique_mails", F.lit(0)).alias("unique_mails"),
        (F.col("mails") - F.coalesce("unique_mails", F.lit(0))).alias("copies_removed"),
    )


@query(with_views("emails", f"""SELECT email_id, source_dataset, duplicate_group, md5(clean_text) AS text_md5 FROM (
  SELECT *, row_number() OVER (PARTITION BY duplicate_group ORDER BY source_dataset, email_id) AS rn FROM (
    SELECT *, {sql_body_hash('clean_text')} AS duplicate_group FROM emails WHERE CAST(email_id AS BIGINT) % 13 <> 0)) WHERE rn = 1"""))
def deduplicated_mail(spark, sf_dir):
    """Whole mail rows without corrupted ones and without copies."""
    flagged = emails(spark, sf_dir).withColumns(
        {"duplicate_group": X.body_hash(F.col("clean_text")), "is_corrupted": F.col("email_id").cast("bigint") % 13 == 0}
    )
    kept = curate.deduplicate(curate.drop_corrupted(flagged))
    return kept.select("email_id", "source_dataset", "duplicate_group", X.md5_text(F.col("clean_text")).alias("text_md5"))


_GUARDS = f"""n AS (SELECT count(*) FILTER (label = 1) AS spam, count(*) FILTER (split = 'train') AS train FROM labelled)"""


@query(with_views("labelled", """SELECT g.* FROM n, (SELECT unnest([
    {'guard': 'class size', 'wanted': spam, 'stopped': false}, {'guard': 'class size', 'wanted': spam + 1, 'stopped': true},
    {'guard': 'label counts', 'wanted': spam, 'stopped': false}, {'guard': 'label counts', 'wanted': spam + 1, 'stopped': true},
    {'guard': 'split sizes', 'wanted': train, 'stopped': false}, {'guard': 'split sizes', 'wanted': train - 1, 'stopped': true}]) AS g)""", _GUARDS))
def dataset_guards(spark, sf_dir):
    """The guards of the dataset stages, each at the size that it lets through and at the next that it stops."""
    rows = labelled(spark, sf_dir)
    counts = curate.class_counts(rows)
    sizes = {row[0]: row[1] for row in rows.groupBy("split").count().collect()}
    more = {**counts, 1: counts[1] + 1}
    moved = {**sizes, "train": sizes["train"] - 1, "valid": sizes["valid"] + 1}
    trials = [
        ("class size", counts[1], lambda: curate.sample_classes(rows, {1: counts[1]})), ("class size", more[1], lambda: curate.sample_classes(rows, {1: more[1]})),
        ("label counts", counts[1], lambda: curate.require_label_counts(rows, counts, sum(counts.values()))),
        ("label counts", more[1], lambda: curate.require_label_counts(rows, more, sum(counts.values()))),
        ("split sizes", sizes["train"], lambda: curate.require_split_sizes(rows, sizes)),
        ("split sizes", moved["train"], lambda: curate.require_split_sizes(rows, moved)),
    ]

    def stopped(trial) -> bool:
        try:
            trial()
        except ValueError:
            return True
        return False

    return spark.createDataFrame([(name, wanted, stopped(trial)) for name, wanted, trial in trials], "guard string, wanted long, stopped boolean")


def _sample_sizes(df) -> dict[int, int]:
    """Half of each class, so that the sizes follow the data."""
    return {label: n // 2 for label, n in curate.class_counts(df).items()}


def _sample(spark, sf_dir):
    rows = labelled(spark, sf_dir).drop("split")
    return curate.sample_classes(rows, _sample_sizes(rows))


_SAMPLE = f"""sample AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY {sql_hash('sample-42', 'email_id')}, email_id) AS rn,
      count(*) OVER (PARTITION BY label) // 2 AS wanted FROM labelled) WHERE rn <= wanted)"""


@query(with_views("labelled", "SELECT email_id, label, source_dataset FROM sample", _SAMPLE))
def class_sample(spark, sf_dir):
    """An exact-size sample of every class in seeded hash order."""
    return _sample(spark, sf_dir).select("email_id", "label", "source_dataset")


@query(with_views("labelled", f"SELECT email_id, label, row_number() OVER (ORDER BY {sql_hash('shuffle-42', 'email_id')}, email_id) AS position FROM labelled"))
def shuffled_order(spark, sf_dir):
    """The seeded order of the rows, as a position checked against SQL.

    The sorted rows are numbered by partition offsets, so the order is never collected.
    """
    from mailsift.operators.order import numbered

    rows = labelled(spark, sf_dir).select("email_id", "label")
    ordered = rows.withColumn("_order", X.hash32("shuffle-42", F.col("email_id")))
    return numbered(ordered, ["_order", "email_id"], "position").select("email_id", "label", "position")


# Groups of the sampled mail, split with exact stratified sizes. The arithmetic is that of a
# stratified shuffle split: ceil for the second part, largest remainder per label.
_QUOTA = """
  counted AS (SELECT label, count(*) AS n FROM groups GROUP BY label),
  whole AS (SELECT sum(n)::BIGINT AS g, ceil(least(0.4e0, 1500e0 / sum(n)) * sum(n)::DOUBLE)::BIGINT AS t FROM counted),
  q1 AS (SELECT label, n, g, t, n / g::DOUBLE * (g - t) AS ex, floor(n / g::DOUBLE * (g - t))::BIGINT AS fl FROM counted, whole),
  q2 AS (SELECT *, fl + CASE WHEN row_number() OVER (ORDER BY fl - ex, label) <= (g - t) - sum(fl) OVER () THEN 1 ELSE 0 END AS train FROM q1),
  q3 AS (SELECT *, n - train AS temp, t - ceil(0.5e0 * t)::BIGINT AS v FROM q2),
  q4 AS (SELECT *, temp / t::DOUBLE * v AS ex2, floor(temp / t::DOUBLE * v)::BIGINT AS fl2 FROM q3),
  quota AS (SELECT label, train, fl2 + CASE WHEN row_number() OVER (ORDER BY fl2 - ex2, label) <= v - sum(fl2) OVER () THEN 1 ELSE 0 END AS valid FROM q4),
  assigned AS (SELECT group_key, g.label, CASE WHEN rn <= train THEN 'train' WHEN rn <= train + valid THEN 'valid' ELSE 'test' END AS split
    FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {order}, group_key) AS rn FROM groups) g JOIN quota q ON g.label = q.label)"""
_ASSIGNED = _QUOTA.format(order=sql_hash("split-42", "group_key"))
_MAIL_GROUPS = (
    "keyed AS (SELECT *, " + sql_thread("subject", "sender", sql_body_hash("clean_text")) + " AS thread FROM labelled), "
    "pure AS (SELECT thread FROM keyed GROUP BY thread HAVING min(label) = max(label)), "
    "groups AS (SELECT thread AS group_key, min(label) AS label FROM keyed WHERE thread IN (SELECT thread FROM pure) GROUP BY thread),"
)


def keyed_mail(spark, sf_dir):
    """(email_id, label, group_key) of labelled mail; threads with both labels are left out.

    The keys come from whole texts, so they are written once and every later pass reads them.
    """
    rows = labelled(spark, sf_dir).withColumn("body_group", X.body_hash(F.col("clean_text")))
    thread = X.thread_group(F.col("subject"), F.col("sender"), F.col("body_group"))
    keyed = written(curate.with_group_key(rows.withColumn("thread_group", thread)).select("email_id", "label", "group_key"), "keyed")
    return keyed.join(curate.mixed_label_groups(keyed).select("group_key"), "group_key", "left_anti")


@query(with_views("labelled", "SELECT k.email_id, k.label, a.split FROM keyed k JOIN assigned a ON k.thread = a.group_key", _MAIL_GROUPS + _ASSIGNED))
def mail_split(spark, sf_dir):
    """Mail split by thread into exact stratified train, valid and test shares."""
    return curate.split_by_group(keyed_mail(spark, sf_dir)).select("email_id", "label", "split")


def split_turns(spark, sf_dir):
    return curate.split_by_group(turns(spark, sf_dir))


_TURNS = "groups AS (SELECT group_key, min(label) AS label FROM turns GROUP BY group_key),"
_TURN_SPLIT = _TURNS + _ASSIGNED + ", s AS (SELECT t.*, a.split FROM turns t JOIN assigned a ON t.group_key = a.group_key)"


@query(with_views("turns", "SELECT email_id, group_key, label, split FROM s", _TURN_SPLIT))
def conversation_split(spark, sf_dir):
    """Turns split by conversation, where a group has many rows."""
    return split_turns(spark, sf_dir).select("email_id", "group_key", "label", "split")


@query(with_views("turns", "SELECT split, source_dataset, count(*) AS count, count(DISTINCT group_key) AS groups FROM s GROUP BY ALL",
                  _TURN_SPLIT))
def split_sources(spark, sf_dir):
    """Rows per split and source, with the distinct groups beside them."""
    rows = split_turns(spark, sf_dir)
    groups = rows.groupBy("split", "source_dataset").agg(F.count_distinct("group_key").alias("groups"))
    return curate.source_by_split(rows).join(groups, ["split", "source_dataset"])


@query(with_views("turns", f"SELECT email_id, split FROM (SELECT email_id, {sql_bucket_split('group_key')} AS split FROM turns) WHERE split = 'train' OR split = 'test'"))
def bucket_splits(spark, sf_dir):
    """The shuffle-free split: two of its splits extracted and put together again."""
    rows = curate.split_by_group(turns(spark, sf_dir), exact=False)
    both = curate.concat_splits(curate.one_split(rows, "train"), curate.one_split(rows, "test"))
    return both.select("email_id", "split")


@query(with_views("labelled", "SELECT subject AS group_key, count(*) AS rows FROM labelled GROUP BY subject HAVING min(label) <> max(label)"))
def mixed_groups(spark, sf_dir):
    """Subjects that hold both labels: they would block a split by subject."""
    return curate.mixed_label_groups(curate.with_group_key(labelled(spark, sf_dir), "subject"))


@query(with_views("turns", "SELECT group_key, min(label) AS label, false AS is_mixed, count(*) AS rows FROM turns GROUP BY group_key"))
def labelled_groups(spark, sf_dir):
    """Distinct groups with their label."""
    return curate.group_labels(turns(spark, sf_dir))


def _sql_leak(key: str, source: str) -> str:
    left = f"SELECT DISTINCT {key} AS k FROM {source} WHERE split = 'train'"
    right = f"SELECT DISTINCT {key} AS k FROM {source} WHERE split = 'test'"
    return f"""SELECT (SELECT count(*) FROM ({right})) AS right_keys,
      (SELECT count(*) FROM (({left}) INTERSECT ({right}))) AS shared_keys"""


@query(with_views("labelled turns", f"""SELECT *, {s6('shared_keys / right_keys')} AS rate FROM (
  SELECT 'subject' AS key, * FROM ({_sql_leak('subject', 'labelled')})
  UNION ALL SELECT 'conversation', * FROM ({_sql_leak('group_key', 's')}))""", _TURN_SPLIT))
def leakage_rates(spark, sf_dir):
    """Shared train and test keys: none by conversation, some by subject."""
    subjects = curate.leakage(labelled(spark, sf_dir), "subject").withColumn("key", F.lit("subject"))
    groups = curate.leakage(split_turns(spark, sf_dir)).withColumn("key", F.lit("conversation"))
    return subjects.unionByName(groups).withColumn("rate", r6("rate"))


@query(with_views("labelled", f"""SELECT m.metric, m.value FROM (
  SELECT unnest([
    {{'metric': 'parsed_total', 'value': (SELECT count(*) FROM keyed)::DOUBLE}},
    {{'metric': 'after_corrupt_filter', 'value': (SELECT count(*) FROM keyed WHERE NOT bad)::DOUBLE}},
    {{'metric': 'after_dedup', 'value': (SELECT count(DISTINCT body) FROM keyed WHERE NOT bad)::DOUBLE}},
    {{'metric': 'final_size', 'value': (SELECT count(*) FROM keyed)::DOUBLE}},
    {{'metric': 'ham', 'value': (SELECT count(*) FROM keyed WHERE label = 0)::DOUBLE}},
    {{'metric': 'spam', 'value': (SELECT count(*) FROM keyed WHERE label = 1)::DOUBLE}},
    {{'metric': 'train', 'value': (SELECT count(*) FROM keyed WHERE split = 'train')::DOUBLE}},
    {{'metric': 'valid', 'value': (SELECT count(*) FROM keyed WHERE split = 'valid')::DOUBLE}},
    {{'metric': 'test', 'value': (SELECT count(*) FROM keyed WHERE split = 'test')::DOUBLE}},
    {{'metric': 'train_test_leakage_rate', 'value': (SELECT {s6('shared_keys / right_keys')} FROM ({_sql_leak('subject', 'keyed')}))}}
  ]) AS m)""", f"keyed AS (SELECT *, {sql_body_hash('clean_text')} AS body, CAST(email_id AS BIGINT) % 13 = 0 AS bad FROM labelled)"))
def funnel_counts(spark, sf_dir):
    """Rows left at every stage as (metric, value)."""
    rows = labelled(spark, sf_dir).withColumns(
        {"duplicate_group": X.body_hash(F.col("clean_text")), "is_corrupted": F.col("email_id").cast("bigint") % 13 == 0,
         "group_key": F.col("subject")}
    )
    return curate.funnel(rows, rows).withColumn("value", r6("value"))


# ---- audits ------------------------------------------------------------------------------

# Expected numbers to audit against; the data decide which of them hold.
EXPECTED_ROWS, EXPECTED_SPAM = {"train": 283, "valid": 60, "test": 60}, {"train": 38, "valid": 7, "test": 8}


def _expected_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{s}' AS split, {n}::BIGINT AS expected_rows, {EXPECTED_SPAM[s]}::BIGINT AS expected_spam" for s, n in EXPECTED_ROWS.items()
    )


_AUDIT_SQL = f"""SELECT e.split, expected_rows, expected_spam, coalesce(rows, 0) AS rows, coalesce(spam, 0) AS spam,
  CASE WHEN rows = expected_rows THEN 'PASS' ELSE 'FAIL' END AS rows_level,
  CASE WHEN spam = expected_spam THEN 'PASS' ELSE 'FAIL' END AS spam_level
  FROM ({_expected_sql()}) e LEFT JOIN (SELECT split, count(*) AS rows, sum(label)::BIGINT AS spam FROM labelled GROUP BY split) a ON e.split = a.split"""


@query(with_views("labelled", _AUDIT_SQL))
def split_size_audit(spark, sf_dir):
    """Rows and spam per split against expected numbers."""
    return audit.split_audit(labelled(spark, sf_dir), EXPECTED_ROWS, EXPECTED_SPAM)


_KEYS_SQL = {
    "sender": "regexp_replace(lower(trim(sender)), ' +', ' ', 'g')",
    "subject": sql_subject("subject"),
}


def _overlap_sql(key: str) -> str:
    return f"""SELECT shared_keys AS overlap, shared_keys / greatest(1, right_keys) AS rate
      FROM ({_sql_leak('k', f"(SELECT {key} AS k, split FROM labelled WHERE {key} <> '')")})"""


_MD5_SQL = f"SELECT shared_keys AS overlap, shared_keys / (SELECT count(*) FROM labelled WHERE split = 'test') AS rate FROM ({_sql_leak('k', '(SELECT md5(clean_text) AS k, split FROM labelled)')})"


@query(with_views("labelled", f"""SELECT key, overlap, {s6('rate')} AS rate FROM (
  SELECT 'md5' AS key, * FROM ({_MD5_SQL}) UNION ALL SELECT 'sender', * FROM ({_overlap_sql(_KEYS_SQL['sender'])})
  UNION ALL SELECT 'subject', * FROM ({_overlap_sql(_KEYS_SQL['subject'])}))"""))
def split_overlaps(spark, sf_dir):
    """Content, sender and subject overlap between train and test."""
    rows = labelled(spark, sf_dir)
    parts = [
        fn(rows).select(F.lit(name).alias("key"), "overlap", r6("rate").alias("rate"))
        for name, fn in (("md5", audit.md5_overlap), ("sender", audit.sender_overlap), ("subject", audit.subject_overlap))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("""SELECT (SELECT count(*) FROM (SELECT md5(text) FROM documents INTERSECT SELECT md5(text) FROM benchmark)) AS overlap,
  floor((SELECT count(*) FROM (SELECT md5(text) FROM documents INTERSECT SELECT md5(text) FROM benchmark)) / (SELECT count(*) FROM benchmark) * 1e6 + 0.5e0) / 1e6 AS rate""")
def benchmark_overlap(spark, sf_dir):
    """Benchmark items whose content is in the documents: whole rows of two tables."""
    train = table(spark, sf_dir, "documents").select(F.col("text").alias("clean_text"), F.lit("train").alias("split"))
    test = table(spark, sf_dir, "benchmark").select(F.col("text").alias("clean_text"), F.lit("test").alias("split"))
    return audit.md5_overlap(train.unionByName(test)).withColumn("rate", r6("rate"))


@query(with_views("emails", "SELECT DISTINCT sender FROM emails WHERE sender <> ''"))
def known_senders(spark, sf_dir):
    """Distinct senders without the empty one."""
    return audit.except_key(emails(spark, sf_dir), "sender")


_CHECKS_SQL = f"""SELECT 'md5_overlap' AS "check", CASE WHEN overlap = 0 THEN 'PASS' ELSE 'FAIL' END AS level, overlap::DOUBLE AS value FROM ({_MD5_SQL})
  UNION ALL SELECT 'sender_overlap', CASE WHEN overlap = 0 THEN 'PASS' ELSE 'WARN' END, overlap::DOUBLE FROM ({_overlap_sql(_KEYS_SQL['sender'])})
  UNION ALL SELECT 'subject_overlap', CASE WHEN overlap = 0 THEN 'PASS' ELSE 'WARN' END, overlap::DOUBLE FROM ({_overlap_sql(_KEYS_SQL['subject'])})
  UNION ALL SELECT split || '_rows', rows_level, rows::DOUBLE FROM ({_AUDIT_SQL})
  UNION ALL SELECT split || '_spam', spam_level, spam::DOUBLE FROM ({_AUDIT_SQL})"""


def _checks(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    return audit.overlap_checks(rows).unionByName(audit.split_checks(audit.split_audit(rows, EXPECTED_ROWS, EXPECTED_SPAM)))


@query(with_views("labelled", _CHECKS_SQL))
def data_checks(spark, sf_dir):
    """Every data check with its level and value."""
    return _checks(spark, sf_dir)


@query(with_views("labelled", f"""SELECT count(*) FILTER (level = 'PASS') AS n_pass, count(*) FILTER (level = 'WARN') AS n_warn,
  count(*) FILTER (level = 'FAIL') AS n_fail, coalesce(bool_or(level = 'FAIL'), false) AS failed FROM ({_CHECKS_SQL})"""))
def quality_summary(spark, sf_dir):
    """Checks per level and the overall verdict."""
    return audit.quality_rollup(_checks(spark, sf_dir))

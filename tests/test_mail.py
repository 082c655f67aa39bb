"""Raw files, label index, records, the data stages, and streaming."""

import gzip
from email.message import EmailMessage

from pyspark.sql import functions as F

from mailsift.config import Settings
from mailsift.plans.dataset import build_dataset
from mailsift.sources import mail_files as MF, records as R, tables as T
from mailsift.sources.html import page_text


def _message(body=None, html=None, attach=False, message_id="<m1@x>", subject="Hello\tthere") -> bytes:
    m = EmailMessage()
    m["From"], m["Subject"] = "A <a@b.c>", subject
    if message_id:
        m["Message-ID"] = message_id
    if body is not None:
        m.set_content(body)
        if html:
            m.add_alternative(html, subtype="html")
    elif html:
        m.set_content(html, subtype="html")
    if attach:
        m.add_attachment(b"x", maintype="application", subtype="pdf", filename="a.pdf")
    return m.as_bytes()


def _corpus(root):
    files = {
        "easy_ham/0001.abc": _message("plain body of ham"),
        "spam_2/0002.eml": _message(None, "<p>markup <b>only</b></p><script>x()</script>", message_id=None),
        "spam_2/3": _message("two parts here", "<p>two parts here</p>", attach=True),
        "easy_ham/short": _message("tiny"),
        "easy_ham/bad": b"Content-Type: image/png\r\nContent-Transfer-Encoding: base64\r\n\r\niVBORw0KGgo=\r\n",
        "other/4": _message("no label for this one"),
        "easy_ham/empty.eml": b"",
    }
    for name, raw in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(raw)
    return str(root)


def test_scan_parse_and_reject(spark, tmp_path):
    root = _corpus(tmp_path / "spamcorpus")
    files = MF.scan_mail_files(spark, root)
    assert files.count() == 6  # the empty file is no message
    labelled = MF.parse_mail(files.drop("length")).withColumn("label", MF.label_from_path(F.col("path"), root))
    got = {r.path.split("/")[-1]: r for r in labelled.collect()}
    assert got["0001.abc"].label == 0 and got["0002.eml"].label == 1 and got["4"].label == -1
    assert got["0001.abc"].subject == "Hello there" and got["0001.abc"].clean_text == "plain body of ham"
    assert got["0002.eml"].clean_text == "markup only" and got["0002.eml"].has_html and len(got["0002.eml"].message_id) == 64
    assert got["3"].attachment_hint and got["3"].clean_text == "two parts here"
    assert got["bad"].parse_error.startswith("TypeError")
    built, rejects = R.records_from_mail(labelled, "raw")
    assert built.count() == 3 and rejects.count() == 1


def test_label_index_drops_other_lines(spark):
    lines = spark.createDataFrame(
        [("1 a/b.eml",), ("0 ./c.eml",), ("",), ("1 two three",), ("x d.eml",), ("0 missing",)], "value string"
    )
    index = MF.read_label_index(lines)
    assert index.count() == 3
    files = spark.createDataFrame([("file:/r/a/b.eml",), ("file:/r/c.eml",)], "path string")
    assert MF.join_label_index(index, files, "/r").count() == 2


def test_page_text_keeps_visible_nodes_only():
    assert page_text("<p>a &amp; b<!-- c -->d</p><style>x</style> <i> e </i><script>1<2</script>") == "a & b d e"
    assert page_text(None) == ""


def test_references_need_their_semicolon():
    assert page_text("<p>a&amp b &copy=1 &am &notit; &#38; &amp;quot; &quot;c&quot; &&&amp;</p>") == 'a&amp b &copy=1 &am &notit; & &quot; "c" &&&'


def test_tables_with_other_headers_and_separators(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Message,Spam/Ham,Subject\n"long body, with\nbreak",spam,Hi\nshort,ham,x\nanother long body,maybe,y\n')
    (tmp_path / "b.tsv").write_text("text\tlabel\na third long body\t0\n")
    (tmp_path / "c.csv").write_text("id,value\n1,2\n")
    rows = T.read_labelled_tables(spark, str(tmp_path))
    built = R.records_from_table(rows, "tables").collect()
    assert sorted((r.label, r.clean_text) for r in built) == [(0, "a third long body"), (1, "long body, with break")]


def test_last_alias_wins():
    assert T.resolve_columns(["body", " TEXT ", "Label", "spam"], T.LABELLED_MAIL_ROLES) == {"text": " TEXT ", "label": "spam"}


def test_copies_keep_their_own_ids(spark):
    rows = spark.range(50).select(
        F.lit("p").alias("source_path"), F.when(F.col("id") < 40, "the same long body").otherwise("another long body").alias("text"),
        F.lit("1").alias("label"), F.lit("").alias("subject"), F.lit("").alias("sender"),
    )
    assert R.records_from_table(rows, "s").select("email_id").distinct().count() == 50


def test_data_stages_end_to_end(spark, tmp_path):
    rows = spark.range(300).select(
        F.lit("p").alias("source_path"), F.concat(F.lit("body number "), F.sha2(F.col("id").cast("string"), 256)).alias("text"),
        (F.col("id") % 5 == 0).cast("int").cast("string").alias("label"), F.lit("s").alias("subject"), F.lit("").alias("sender"), F.col("id").alias("k"),
    )
    corpus = R.records_from_table(rows.unionByName(rows.filter("k < 20")), "c", key_col="k")
    settings = Settings(class_sizes={0: 160, 1: 40}, split_sizes={"train": 120, "valid": 40, "test": 40})
    built = build_dataset(spark, [corpus, None], str(tmp_path / "out"), settings)
    numbers = {r.metric: r.value for r in built.funnel.collect()}
    assert numbers["parsed_total"] == 320 and numbers["after_dedup"] == 300 and numbers["final_size"] == 200
    assert (numbers["train"], numbers["valid"], numbers["test"]) == (120, 40, 40)
    assert numbers["train_test_leakage_rate"] == 0.0


def _jobs(spark, run):
    """Spark jobs that ``run`` starts."""
    group = f"count-{id(run)}"
    spark.sparkContext.setJobGroup(group, "", False)
    run()
    found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("rest", "", False)
    return found


def test_damaged_tables_are_skipped_whole_and_named(spark, tmp_path):
    sound = "text,label\na sound long body,spam\nanother sound body,ham\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(sound)
    (tmp_path / "in" / "b.csv.gz").write_bytes(gzip.compress(sound.replace("sound", "packed").encode()))
    cut = gzip.compress(("text,label\n" + "".join(f"{i * 7919 % 1000003} of a long body,spam\n" for i in range(5000))).encode())
    (tmp_path / "cut.csv.gz").write_bytes(cut[: len(cut) // 2])
    (tmp_path / "bytes.csv").write_bytes(b"text,label\n\xff\xfe bad,spam\n")
    (tmp_path / "ragged.csv").write_text("text,label\nfine,spam\none,two,three\n")
    (tmp_path / "open.tsv").write_text('text\tlabel\n"never closed\tspam\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "note.txt").write_text("text,label\nno,spam\n")
    scan = T.scan_tables(spark, str(tmp_path))
    skipped = {r.path.rsplit("/", 1)[1]: r.error for r in T.skipped_tables(scan).collect()}
    assert set(skipped) == {"cut.csv.gz", "bytes.csv", "ragged.csv", "open.tsv"} and all(skipped.values())  # Spark lists no empty file
    rows = T.read_labelled_tables(spark, str(tmp_path), scan=scan)
    assert sorted(r.text for r in rows.collect()) == ["a packed long body", "a sound long body", "another packed body", "another sound body"]


def test_jobs_do_not_grow_with_the_files(spark, tmp_path):
    for folder, n in (("few", 80), ("many", 200)):
        (tmp_path / folder).mkdir()
        for i in range(n):
            header = "text,label" if i % 2 else "Message,Spam/Ham,Date"
            (tmp_path / folder / f"{i}.csv").write_text(f"{header}\na long body {i},spam" + ("" if i % 2 else ",x") + "\n")
    runs = [lambda f=folder: T.read_labelled_tables(spark, str(tmp_path / f)).count() for folder in ("few", "many")]
    few, many = (_jobs(spark, run) for run in runs)
    assert many == few
    assert T.read_labelled_tables(spark, str(tmp_path / "many")).count() == 200


def test_known_headers_are_renamed_unless_taken(spark):
    frame = spark.createDataFrame([("1", "a", "b", "c")], ["Message ID", " SUBJECT", "Spam/Ham", "x"])
    assert T.rename_known_headers(frame).columns == ["message_id", "subject", "spam_ham", "x"]
    clash = spark.createDataFrame([("1", "a", "b")], ["Message", "text", "Date"])
    assert T.rename_known_headers(clash).columns == ["Message", "text", "date"]


def test_corrupted_messages_are_counted_and_dropped(spark, tmp_path):
    good = [(f"/c/{'spam' if i % 4 == 0 else 'ham'}/{i}", f"Subject: s{i}\r\nContent-Type: text/plain\r\n\r\nbody number {i} {'x' * i}\r\n".encode()) for i in range(80)]
    bad = [(f"/c/ham/bad{i}", b"Content-Type: image/png\r\nContent-Transfer-Encoding: base64\r\n\r\niVBO\r\n") for i in range(7)]
    files = spark.createDataFrame(good + bad, "path string, content binary")
    parsed = MF.parse_mail(files).withColumn("label", MF.label_from_path(F.col("path"), "/c"))
    records, rejects = R.records_from_mail(parsed, "raw")
    settings = Settings(class_sizes={0: 30, 1: 10}, split_sizes={"train": 24, "valid": 8, "test": 8})
    built = build_dataset(spark, [records, R.corrupted_records(parsed, "raw")], str(tmp_path / "out"), settings, rejects=[rejects])
    numbers = {r.metric: r.value for r in built.funnel.collect()}
    assert (numbers["parsed_total"], numbers["after_corrupt_filter"], numbers["after_dedup"]) == (87, 80, 80 - 80 + len({"x" * i for i in range(80)}))
    assert built.rejects.count() == 7 and built.split.filter("is_corrupted").isEmpty()


def test_a_table_file_is_checked_without_a_copy_of_its_text():
    import tracemalloc

    import pyarrow as pa

    content = pa.py_buffer(b"text,label\n" + ("\u4e00" * 300 + ",ham\n").encode() * 20_000)
    tracemalloc.start()
    assert T._checked(content, ",", False) == (["text", "label"], None)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < content.size / 4


def test_messages_are_parsed_some_bytes_at_a_time():
    import pyarrow as pa

    contents = pa.array([b"x" * n for n in (3, 3, 3, 20, 1)] + [None, b""])
    assert list(MF.byte_ranges(contents, 6)) == [(0, 2), (2, 3), (3, 4), (4, 7)]
    assert list(MF.byte_ranges(contents.slice(0, 0), 6)) == []

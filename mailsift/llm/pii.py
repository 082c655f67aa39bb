"""Personal data: fixed patterns, and words that give the protected values away (native).

Base spans are e-mail addresses, IP addresses, card and phone numbers. Each base value is a
protected entity. The corpus then tells how strongly a word reveals an entity: with documents as
the unit, ``pmi(entity, term) = log2(n(entity, term) * n / (n(entity) * n(term)))`` is the
information that the term gives about the entity, and ``ic(entity) = log2(n / n(entity))`` is all
there is to know. A word of the entity's documents, wherever it stands in them, reveals it where
``pmi`` reaches ``DISCLOSURE`` times ``ic``. Every occurrence of a revealing word in every text is
sanitised, in documents without the entity too: removed where ``pmi`` reaches ``REMOVAL`` times ``ic``
for some entity, generalised to a placeholder below that. Pairs seen in fewer than ``SUPPORT``
documents are no estimate and stay. Words are whole runs of letters of any length, in lower case; what overlaps with
a base span is no word.

Positions are code points: Java's
``split`` and ``regexp_extract_all`` walk through the same matches, so the lengths of gaps and hits
give every start. Patterns that begin with a run of characters start only where the run starts or
the last match ended, which finds the same matches in linear time.

Defined results: a null text is empty and has no spans; equal rows are judged alike; null ids are
carried along; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mailsift.llm.common import small_side, written

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# The patterns of the contract, written for linear time and a flat stack: a repeated
# group recurses in Java, so ``joints`` first marks the separators that may stand inside a match.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+\uE002-]))[A-Za-z0-9._%+\uE002-]++@[A-Za-z0-9-]++\uE002[A-Za-z0-9\uE002-]*+"
IP = r"(?:\G|(?<![0-9]))[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9][0-9\uE000]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
CARD_DIGITS, PHONE_DIGITS = (16, 19), (8, 15)

MASK = "\ue003"  # stands for a base span
LETTERS = r"\p{L}+"
BLOCK = 128  # numbers that are summed in one pass
CUT = 512  # code points of a block of a text
SUPPORT = 3  # documents that a pair needs
DISCLOSURE, REMOVAL = 0.9, 0.98


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def before_each(values: Column, joined=lambda a, b: a + b) -> Column:
    """For each number of an array what those before it join to: their sum, from 0 on.

    Blocks of ``BLOCK`` are joined apart and then with what is before them: appending copies an array,
    so one pass over a text of a million hits would copy a million times a million numbers.
    """
    def grown(array: Column, last) -> Column:
        return F.aggregate(array, F.array(F.lit(0)), lambda acc, x: F.array_append(acc, joined(F.element_at(acc, -1), last(x))))

    def done(whole: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(whole), F.lit(BLOCK))
        blocks = F.transform(starts, lambda at: grown(F.slice(whole, at, F.lit(BLOCK)), lambda x: x))
        return bound(blocks, lambda inner: F.flatten(F.zip_with(
            inner, F.slice(grown(inner, lambda x: F.element_at(x, -1)), F.lit(1), F.size(inner)),
            lambda block, before: F.transform(F.slice(block, F.lit(1), F.size(block) - 1), lambda x: joined(x, before)),
        )))

    none = F.array().cast("array<int>")
    return bound(values, lambda whole: F.when(F.size(whole) > 0, done(whole)).otherwise(none))


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start int, end int, value string>> of the matches, in code points."""
    def placed(hits: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
        steps = F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("hit")))
        return bound(steps, lambda known: F.zip_with(
            F.zip_with(before_each(F.transform(known, lambda x: x["gap"] + x["hit"])), known, lambda at, x: F.struct(
                (at + x["gap"]).alias("start"), (at + x["gap"] + x["hit"]).alias("end"))),
            hits, lambda at, h: F.struct(at["start"].alias("start"), at["end"].alias("end"), h.alias("value")),
        ))

    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def joints(text: Column, separator: str, around: str, mark: str) -> Column:
    """The text with ``mark`` for every separator between two characters of a class; positions stay."""
    free = F.translate(text, "\ue000\ue002", "\ue001\ue001")
    return F.regexp_replace(free, f"(?<={around}){separator}(?={around})", mark)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _is_ip(value: Column) -> Column:
    def small(part: Column) -> Column:
        part = F.regexp_replace(part, "^0+", "")
        return (F.length(part) <= 3) & (F.coalesce(part.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(value, r"\."), small)


def _is_card(value: Column) -> Column:
    digits = _digits(value)

    def share(place: Column) -> Column:
        digit = F.substr(digits, -place, F.lit(1)).cast("int")
        double = digit * 2
        return F.when(place % 2 == 1, digit).when(double > 9, double - 9).otherwise(double)

    places = F.sequence(F.lit(1), F.length(digits))
    luhn = F.aggregate(places, F.lit(0), lambda total, place: total + share(place)) % 10 == 0
    return F.when(F.length(digits).between(*CARD_DIGITS), luhn).otherwise(False)


def _is_phone(value: Column) -> Column:
    return F.length(_digits(value)).between(*PHONE_DIGITS)


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, end, value>> by kind as listed, then by start."""
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")
    rules = (
        ("email", joints(text, r"\.", "[A-Za-z0-9-]", "\ue002"), EMAIL, None, F.contains(text, F.lit("@"))),
        ("ip", text, IP, _is_ip, F.rlike(text, F.lit(r"[0-9]\.[0-9]"))),
        ("card", joints(text, r"[\x20-]", "[0-9]", "\ue000"), CARD, _is_card, F.rlike(text, F.lit("[0-9]"))),
        ("phone", text, PHONE, _is_phone, F.contains(text, F.lit("+"))),
    )

    def spans(kind, searched, pattern, valid, possible) -> Column:
        found = matches(searched, pattern)
        if valid:
            found = F.filter(found, lambda m: valid(m["value"]))
        named = F.transform(found, lambda m: F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"),
            F.translate(m["value"], "\ue002\ue000", ".-").alias("value"),
        ))
        return F.when(possible, named).otherwise(none)

    return F.concat(*[spans(*rule) for rule in rules])


def _replaced(text: Column, spans: Column) -> Column:
    """The text with each of the sorted spans (start, back, by) replaced, unless an earlier one reaches into it.

    What stays is cut out of blocks of the text, so no cut walks through all of it.
    """
    def built(blocks: Column, reached: Column) -> Column:
        def cut(start: Column, end: Column) -> Column:
            first = F.floor(start / CUT).cast("int")
            count = F.floor((end - 1) / CUT).cast("int") - first + 1
            return F.substring(F.array_join(F.slice(blocks, first + 1, count), ""), start - first * CUT + 1, end - start)

        kept = F.filter(reached, lambda x: x["span"]["start"] >= x["reach"])
        parts = F.transform(kept, lambda x: F.concat(cut(x["reach"], x["span"]["start"]), x["span"]["by"]))
        last = F.coalesce(F.array_max(F.transform(reached, lambda x: -x["span"]["back"])), F.lit(0))
        return F.concat(F.array_join(parts, ""), bound(last, lambda at: cut(at, F.greatest(at, F.size(blocks) * CUT))))

    def of(blocks: Column, known: Column) -> Column:
        reach = before_each(F.transform(known, lambda s: -s["back"]), F.greatest)
        return bound(F.zip_with(reach, known, lambda r, s: F.struct(r.alias("reach"), s.alias("span"))), lambda reached: built(blocks, reached))

    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))
    return bound(blocks, lambda held: bound(spans, lambda known: of(held, known)))


def words(text: Column) -> Column:
    """The distinct words of a text, without those that touch a ``MASK``."""
    found = F.regexp_extract_all(text, F.lit(rf"(?<![\p{{L}}{MASK}])\p{{L}}++(?!{MASK})"), F.lit(0))
    return F.array_distinct(F.transform(found, F.lower))


def masked(text: Column, base: Column) -> Column:
    """The text with a blank for every base span, and a ``MASK`` where the span begins or ends inside a run of letters."""
    def edge(value: Column, pattern: str) -> Column:
        return F.when(F.rlike(value, F.lit(pattern)), F.lit(MASK)).otherwise(F.lit(""))

    free = F.translate(text, MASK, "\ue001")
    blanked = _replaced(free, F.array_sort(F.transform(base, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("back"),
        F.concat(edge(s["value"], r"^\p{L}"), F.lit(" "), edge(s["value"], r"\p{L}$")).alias("by")))))
    return F.when(F.size(base) > 0, blanked).otherwise(free)


def occurrences(text: Column, base: Column, held: Column) -> Column:
    """array<struct<start, end, remove>>: where the ``held`` words stand in the text, outside of base spans."""
    none = F.array().cast("array<struct<start:int,end:int,remove:boolean>>")
    # Held words first: only what is found is compared with the base spans, and nothing is appended.
    by_word = bound(F.map_from_entries(F.transform(held, lambda h: F.struct(h["term"], h["remove"]))), lambda known: F.filter(
        F.transform(matches(text, LETTERS), lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), F.element_at(known, F.lower(m["value"])).alias("remove"))),
        lambda m: m["remove"].isNotNull(),
    ))
    free = F.filter(by_word, lambda m: ~F.exists(base, lambda s: (m["start"] < s["end"]) & (m["end"] > s["start"])))
    return F.when(F.size(held) > 0, free).otherwise(none)


def revealing_terms(
    rows: DataFrame, support: int = SUPPORT, disclosure: float = DISCLOSURE, removal: float = REMOVAL,
) -> DataFrame:
    """(_term, _remove) of the words whose information about some entity reaches the threshold.

    ``rows`` has ``number``, ``row`` and ``base`` of every document. Counts are of documents, over the
    whole table; every count combines before its shuffle. A word of too many documents to reach the
    threshold for an entity is left out before pairs are counted, which changes no result.
    """
    of = F.array_distinct(F.transform("base", lambda s: F.concat(s["kind"], F.lit(":"), F.lower(s["value"]))))
    holders = rows.where(F.size("base") > 0)
    single = holders.select("number", F.explode(of).alias("entity"))
    entities = written(
        single.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= support)
        .withColumnRenamed("entity", "_entity"), "pii-entities",
    )
    n = rows.select(F.count("row.text").cast("double").alias("n")).first()["n"]
    top = entities.agg(F.max("n_entity").alias("top")).first()["top"] or 0
    # From pmi >= disclosure * ic and both <= n_entity; a little slack for rounding.
    most = lambda count: count * F.pow(F.lit(n) / count, F.lit(1 - disclosure)) * (1 + 1e-9)
    limit = top if n <= top or not top else top * (n / top) ** (1 - disclosure) * (1 + 1e-9)
    terms = written(
        rows.select(F.explode(words(masked(F.coalesce("row.text", F.lit("")), F.col("base")))).alias("word"))
        .groupBy("word").agg(F.count("*").alias("n_term")).where(F.col("n_term").between(support, limit)), "pii-words",
    )
    near = (
        holders.select("number", F.explode(words(masked(F.coalesce("row.text", F.lit("")), F.col("base")))).alias("term"))
        .join(small_side(terms), F.col("term") == F.col("word")).select(F.col("number").alias("_number"), "term", "n_term")
    )
    pairs = (
        single.join(small_side(entities), F.col("entity") == F.col("_entity")).drop("_entity")
        .join(near, F.col("number") == F.col("_number")).where(F.col("n_term") <= most(F.col("n_entity")))
        .groupBy("entity", "term", "n_entity", "n_term").agg(F.count("*").alias("both")).where(F.col("both") >= support)
    )
    known = F.log2(F.lit(n) / F.col("n_entity"))
    told = F.log2(F.col("both") * F.lit(n) / (F.col("n_entity") * F.col("n_term")))
    told_enough = pairs.where((known > 0) & (told >= F.lit(disclosure) * known))
    return told_enough.groupBy(F.col("term").alias("_term")).agg(F.max(told >= F.lit(removal) * known).alias("_remove"))


def find(docs: DataFrame, **thresholds) -> DataFrame:
    """(row, base, added): every row of ``docs`` as a struct, its base spans and the spans of revealing terms.

    ``added`` is array<struct<start, end, remove>>, by start. The rows are written once with their base
    spans; words meet the revealing terms by a join, and only texts that hold one are searched again.
    """
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), base_spans(F.coalesce(F.col("text"), F.lit(""))).alias("base"))
    rows = written(rows.withColumn("number", F.monotonically_increasing_id()), "pii-found")
    terms = written(revealing_terms(rows, **thresholds), "pii-terms")
    held = written(
        rows.select(F.col("number").alias("_number"), F.explode(words(text)).alias("word"))
        .join(small_side(terms), F.col("word") == F.col("_term"))
        .groupBy("_number").agg(F.collect_list(F.struct(F.col("word").alias("term"), F.col("_remove").alias("remove"))).alias("held")),
        "pii-held",
    )
    nothing = F.array().cast("array<struct<term:string,remove:boolean>>")
    held = small_side(held)

    def full(some: DataFrame) -> DataFrame:
        return some.join(held, F.col("number") == F.col("_number"), "left").select(
            "row", "base", occurrences(text, F.col("base"), F.coalesce("held", nothing)).alias("added")
        )

    return full(rows.where(F.size("base") == 0)).union(full(rows.where(F.size("base") > 0)))  # without base spans first


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitised_text(text: Column, base: Column, added: Column) -> Column:
    """The text with base spans as ``[KIND]``, generalised terms as ``[TERM]`` and removed terms gone.

    Of overlapping spans the first one, the longest where they start together, is replaced and the
    others lose only what lies beyond it.
    """
    spans = F.array_sort(F.concat(
        F.transform(base, lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("back"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("by"))),
        F.transform(added, lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("back"), F.when(s["remove"], F.lit("")).otherwise(F.lit("[TERM]")).alias("by"))),
    ))
    return _replaced(text, spans)


def sanitise(docs: DataFrame, **thresholds) -> DataFrame:
    """``docs`` with the text sanitised; a null text stays null, other columns are unchanged."""
    found = find(docs, **thresholds)
    touched = (F.size("base") > 0) | (F.size("added") > 0)
    text = F.when(touched, sanitised_text(F.coalesce("row.text", F.lit("")), F.col("base"), F.col("added"))).otherwise(F.col("row.text"))
    return found.select(*[
        text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns
    ])


def result(docs: DataFrame) -> DataFrame:
    """Counts and span digests of every document."""
    found = find(docs.select("doc_id", "text"))
    more = F.transform("added", lambda s: F.struct(F.lit(TERM).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    plain = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "row.doc_id", *map(count, KINDS),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.concat(plain, more)).alias("spans"),
    )

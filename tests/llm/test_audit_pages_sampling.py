"""Divergence audit, page extraction and importance resampling against brute force and hand-made cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from mailsift.llm import divergence, html_extract, importance

DOCS = "doc_id long, text string, lang string, source string, size int, row string, term string, n long"


def texts(seed, count, alphabet="abcdeéZ"):
    rng = random.Random(seed)
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 3))) for _ in range(80)]
    return [rng.choice([" ", "\n", ", ", "-7-"]).join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 30, 90]))) for _ in range(count)]


def documents(seed=2, count=150):
    rng = random.Random(seed)
    rows = [
        (i, t, rng.choice(["en", "en", "de", None]), rng.choice(["s0", "s0", "s1", "é", "Z", None]), i, "r", "t", 1)
        for i, t in enumerate(texts(seed, count))
    ]
    rows += [(500, None, "en", "s1", 0, None, None, None), (501, "", "xx", "lonely", 0, None, None, None), (502, "7 7", "yy", "a", 0, None, None, None),
             (503, None, "yy", "b", 0, None, None, None), (None, None, None, None, None, None, None, None)]
    return rows + [rows[3], rows[3], (504, "Ab " * 4000, "en", "s0", 0, "x", "y", 2)]


# ---- divergence audit --------------------------------------------------------------------


def brute_audit(rows, least, top):
    groups, found, seen = set(), defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        found[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in seen[lang].items() if d >= least]
        sources = sorted(s for g, s in groups if g == lang)
        whole = Counter()
        for s in sources:
            whole.update({t: found[lang, s][t] for t in kept})

        def share(counts):
            total = sum(counts[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // total for t in kept}

        p, q = {s: share(found[lang, s]) for s in sources}, share(whole)
        far = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(far(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(-far(p[s][t], q[t]), t.encode()) for t in kept if found[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(items)]
    return sorted(out)


@pytest.mark.parametrize("least", [1, 10])
def test_audit_equals_brute_force(spark, least):
    rows = documents()
    got = divergence.audit(spark.createDataFrame(rows, DOCS).repartition(5), least).select("lang", "source", "part", "item", "value", "rank")
    assert sorted(map(tuple, got.collect())) == brute_audit(rows, least, divergence.TOP_TERMS)


def test_audit_of_no_rows(spark):
    assert divergence.result(spark.createDataFrame([], DOCS)).count() == 0


def test_tree_shares_paths_and_survives_cuts():
    rng = random.Random(5)
    rows = sorted({(rng.randint(0, 1), tuple((s, rng.randint(1, 2)) for s in range(6) if rng.random() < 0.6)) for _ in range(300)} - {(0, ()), (1, ())})
    share = lambda s, n: 10 + 7 * s + 31 * n

    def sums(chunk):
        flat = [(s, n) for _, items in chunk for s, n in items]
        starts = np.cumsum([0] + [len(items) for _, items in chunk])
        source, n = (np.array(c, np.int64) for c in zip(*flat))
        lang = np.array([g for g, _ in chunk])
        coded = np.repeat(lang, np.diff(starts)) * 10 + source
        out, nodes = Counter(), 0
        times = np.arange(1, len(chunk) + 1)
        for a, b, v in divergence.tree_corrections(lang, starts, coded, n, share(source, n), share(source, 0 * n), times):
            nodes += len(v)
            for x, y, z in zip(a.tolist(), b.tolist(), v.tolist()):
                out[x, y] += z
        return out, nodes

    want = Counter()
    far = lambda a, b: (a - b) ** 2 // (a + b)
    for i, (g, items) in enumerate(rows):
        for k, (s, n) in enumerate(items):
            for h, m in items[k + 1:]:
                p, q, p0, q0 = share(s, n), share(h, m), share(s, 0), share(h, 0)
                want[g * 10 + s, g * 10 + h] += (far(p, q) - far(p, q0) - far(p0, q) + far(p0, q0)) * (i + 1)
    got, nodes = sums(rows)
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
    assert nodes < sum(len(items) * (len(items) - 1) // 2 for _, items in rows)  # shared paths are counted once


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    text = "Aa bbbbbbbbbbbbbbb c,d éé".encode()
    assert [t for piece in divergence.term_pieces(text) for t in piece] == [b"aa", b"bbbbbbbbbbbbbbb", b"c", b"d", "éé".encode()]
    assert not list(divergence.term_pieces(None))


# ---- page extraction ---------------------------------------------------------------------

BODY = "A first sentence, with commas, that says what this page is about. And one more of it."
MORE = "Then a second paragraph, also long enough to be taken for prose, follows the first."
PAGES = {
    "article": (
        f"<html><head><title>T</title><style>p{{}}</style></head><body><header><a href=/>Site</a></header><nav><ul><li><a href=/a>A</a></ul></nav>"
        f"<article><h1>Head</h1><p>{BODY}<p>Short.<p>{MORE}</article><div class='ad'>Buy, buy, buy!</div><footer>&copy; me</footer>",
        f"Head\n{BODY}\nShort.\n{MORE}",
    ),
    "divs": (
        f"<body><div id='top-menu'><a href=1>one</a> <a href=2>two</a></div><div><h2>Head</h2><div class=c><p>{BODY}</p>\n<p>{MORE}&nbsp;&amp;\n  so on</p></div></div>"
        f"<div class='sideBar'><p>{BODY}</p></div><div id=comments><p>{BODY} {BODY} {BODY}</p><p>{MORE}</p></div></body>",
        f"Head\n{BODY}\n{MORE} & so on",
    ),
    "breaks": (f"<div class=text>{BODY}<br><br>{MORE}<script>var a='<p>no</p>';</script></div><form><p>{BODY}</p></form>", f"{BODY} {MORE}"),
    "sections": (
        f"<article><section><h2>One</h2><p>{BODY}</p></section><section><h2>Two</h2><p>{MORE}</p><ul><li>a point, made<li>another</ul></section>"
        f"<aside>{BODY}</aside><ul class=x><li><a href=1>{BODY}</a><li><a href=2>{MORE}</a></ul></article>",
        f"One\n{BODY}\nTwo\n{MORE}\na point, made\nanother",
    ),
    "layout words": (f"<div class='page has-sidebar'><p>{BODY}</p><p>{MORE}</p></div>", f"{BODY}\n{MORE}"),
    "comments in articles": (f"<article><p>{BODY}</p><p>{MORE}</p><article class='comment'><p>{BODY} I agree, fully.</p></article></article>", f"{BODY}\n{MORE}"),
    "siblings": (f"<body><h1>Head</h1><div><p>{BODY}</p><p>{BODY}</p></div><p>{MORE}</p><p><a href=x>{MORE}</a></p></body>", f"Head\n{BODY}\n{BODY}\n{MORE}"),
    "inline": (f"<p>{BODY} <b>bo</b>ld <i>a</i>&lt;b&gt; x < y</p>", f"{BODY} bold a<b> x < y"),
    "cookie notice": (f"<div class='cookie-notice'><p>{BODY}</p></div><main><p>{MORE}</p></main><div role=dialog>{BODY}</div><p hidden>{BODY}</p>", MORE),
    "broken off": (f"<article><p>{BODY}</p><p>{MORE}</p><p clas", f"{BODY}\n{MORE}"),
    "table": (f"<table><tr><td><p>{BODY}<td>{MORE}</table>", f"{BODY}\n{MORE}"),
    "menu only": ("<nav><a href=1>one</a></nav>", ""),
    "empty": ("", ""),
    "null": (None, ""),
    "plain": (BODY, BODY),
    "one word": ("<p>word", "word"),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages_give_their_article(name):
    html, text = PAGES[name]
    assert html_extract.main_text(html) == text


def test_pages_as_a_job(spark):
    rows = [(i, f"u{i}" if i % 2 else None, html, "t", i) for i, (html, _) in enumerate(PAGES.values())] + [(None, None, BODY, None, None)] * 2
    got = html_extract.result(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int").repartition(3))
    want = [(r[0], r[1], html_extract.main_text(r[2])) for r in rows]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(((*w, len(w[2])) for w in want), key=key)
    assert html_extract.result(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("page", ["<div>" * 20000 + BODY, "<a " * 50000, "<b>" * 30000 + BODY + "</p></b>" * 20000, "<!-" * 50000, "<a b='" * 20001,
                                  "<table><tr><td>" * 5000 + BODY, "<ul><li>" * 20000 + BODY, "<script>" * 20000])
def test_broken_pages_take_time_in_proportion(page):
    assert html_extract.main_text(page) in ("", BODY)


# ---- importance resampling ---------------------------------------------------------------


def features(text, most):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    return [b" ".join(words[i : i + k]) for k in range(1, most + 1) for i in range(len(words) - k + 1)], len(words)


@pytest.mark.parametrize("most", [1, 2, 3])
@pytest.mark.parametrize("piece", [40, 2_000_000])
def test_span_checksums_equal_zlib(monkeypatch, most, piece):
    monkeypatch.setattr(importance, "PIECE", piece)
    rng = random.Random(most)
    many = [t + " " + "x" * rng.choice([0, 3, 63, 64, 65, 128, 129, 1000]) + "é-Q" for t in texts(most, 60)] + [None, "", " ", "ABC"]
    got = defaultdict(list)
    for rows, hashes, _ in importance.feature_hashes([t and t.encode() for t in many], most):
        for row, value in zip(rows.tolist(), hashes.tolist()):
            got[row].append(value)
    for i, text in enumerate(many):
        assert sorted(got[i]) == sorted(map(zlib.crc32, features(text, most)[0]))


def brute_resample(rows, target, buckets, most, least, percent):
    split = [features(r[1], most) for r in rows]
    s, t = Counter(), Counter()
    for grams, _ in split:
        s.update(zlib.crc32(g) % buckets for g in grams)
    for text in target:
        t.update(zlib.crc32(g) % buckets for g in features(text, most)[0])
    ns, nt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets)))) for b in range(buckets)]
    out = []
    for row, (grams, words) in zip(rows, split):
        h = int(hashlib.sha256(f"2024:{'' if row[0] is None else row[0]}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[zlib.crc32(g) % buckets] for g in grams)
        out.append([row[0], len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    may = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, row in enumerate(may[: len(may) * percent // 100]):
        row[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize("most", [1, 2])
def test_resampling_equals_brute_force(spark, most):
    rows, target = documents(4), texts(9, 20, "abc") + [None, ""]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)], "item_id long, text string, weight long")
    got = importance.resample(docs, bench, most=most, percent=30)
    assert sorted(map(tuple, got.collect()), key=str) == brute_resample(rows, target, 10_000, most, 20, 30)


def test_resampling_of_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert importance.result(none, none).count() == 0
    rows = [(1, "a " * 30, None, None, 1, None, None, 1), (2, None, None, None, 1, None, None, 1)]
    got = importance.resample(spark.createDataFrame(rows, DOCS), none, percent=100).collect()
    assert sorted((r.doc_id, r.n_features, r["rank"]) for r in got) == [(1, 30, 1), (2, 0, None)]

"""Vector operators, chats, registered queries and the pipeline on small and awkward tables."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from mailsift.llm import chat, common, embedding_dedup, topk_search

SMALL = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label int, number int"


@pytest.fixture(scope="module")
def frame(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema).repartition(3)


def vectors(seed=1, n=120, dim=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    near = base[:40] + rng.normal(size=(40, dim)) * 0.02
    rows = [(i, v.tolist(), 0, 0) for i, v in enumerate(np.concatenate([base, near, near[:3]]))]
    odd = [None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [float("nan")] * dim, [float("inf")] + [0.0] * (dim - 1), [1.0, 2.0], [2.0, 4.0], [1e200] * dim]
    rows += [(500 + i, v, None, 0) for i, v in enumerate(odd)]
    return rows + [(None, base[0].tolist(), 0, 0), rows[2], (600, base[1].tolist(), 0, 0)]


@pytest.mark.parametrize("piece", [1024, 4])
def test_near_vectors_are_linked(frame, monkeypatch, piece):
    monkeypatch.setattr(embedding_dedup, "PIECE", piece)
    rows = vectors()
    good = [(i, np.array(v)) for i, (_, v, *_) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, degree, parent = 0, [0] * len(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, v) in enumerate(good):
        for j, w in good[:k]:
            if len(v) == len(w) and (v / np.abs(v).max()) @ (w / np.abs(w).max()) >= 0.95 * np.linalg.norm(v / np.abs(v).max()) * np.linalg.norm(w / np.abs(w).max()):
                links, degree[i], degree[j] = links + 1, degree[i] + 1, degree[j] + 1
                parent[root(i)] = root(j)
    big = common.NO_ID
    ids = [big if r[0] is None else r[0] for r in rows]
    least = {}
    for i in range(len(rows)):
        least[root(i)] = min(ids[i], least.get(root(i), big))
    got = embedding_dedup.near_duplicates(frame(rows, VECTORS)).collect()
    assert len(got) == len(rows)
    assert sum(r["n_links"] for r in got) >= 0.98 * 2 * links and sum(r["n_links"] for r in got) <= 2 * links
    want = sorted((ids[i], degree[i], least[root(i)]) for i in range(len(rows)))
    assert sum(a == b for a, b in zip(want, sorted((r["id"], r["n_links"], r["component"]) for r in got))) >= 0.97 * len(rows)
    assert sum(r["kept"] for r in got) == len({root(i) for i in range(len(rows))})


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 64))
    assert np.allclose(np.linalg.norm(embedding_dedup.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(embedding_dedup.hadamard(embedding_dedup.hadamard(x)), x)


def test_topk_equals_all_scores(frame, monkeypatch):
    monkeypatch.setattr(topk_search, "SHARD", 40)
    monkeypatch.setattr(topk_search, "BLOCK", 2)
    rng = np.random.default_rng(2)
    rows = [(i, (np.round(rng.normal(size=24) * 2) / 8).tolist(), 0, 0) for i in range(230)]
    rows += [(500, None, 0, 0), (550, [], 0, 0), (600, [float("nan")] * 24, 0, 0), (650, [1.0, 2.0], 0, 0), (None, rows[0][1], 0, 0), (700, rows[0][1], 0, 0)]
    got = {(r[0], r[1]): (r[2], r[3]) for r in topk_search.result(frame(rows, VECTORS)).collect()}
    whole = {i: np.floor(256 * np.array(v)).astype(int) for i, v, *_ in rows if i is not None and v and np.isfinite(v).all()}
    want = {}
    for q in whole:
        if q % 50 == 0:
            scores = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
            want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(scores[:5])}
    assert got == want


def test_components_of_chains_and_stars(frame):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["id"]: r["component"] for r in common.components(frame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}
    assert common.components(frame([], "a long, b long")).count() == 0


CHATS = "conv_id long, turn long, role string, text string, n_turns int"


def test_snapshots_collapse(frame):
    turns = [("user", "a"), ("bot", "b"), ("user", None), ("bot", "d")]
    rows = [(c, t, *turns[t], 0) for c in range(1, 5) for t in range(c)]  # snapshots of one conversation
    rows += [(9, t, *turns[t], 0) for t in range(4)] + [(11, 0, "user", "b", 0), (12, 5, "user", "", 0), (12, None, None, "x", 0)]
    rows += [(13, 0, "user", "a", 0), (13, 0, "user", "a", 0), (None, 1, "user", "z", 0)]
    got = {r["conv_id"]: (r["n_turns"], r["text"]) for r in chat.result(frame(rows, CHATS)).collect()}
    assert set(got) == {4, 11, 12, 13, None}
    assert got[4] == (4, "".join(f"<|im_start|>{r}\n{t or ''}<|im_end|>\n" for r, t in turns))
    assert got[12][1].startswith("<|im_start|>\nx<|im_end|>")
    assert chat.result(frame([], CHATS)).count() == 0


def test_conversations_equal_sql_with_copies(spark, frame):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(60):
        rows += [(c, t, "user", str(rng.integers(0, 2)), 0) for t in range(rng.integers(1, 5))]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [r[:4] for r in rows])
    want = con.execute(chat.ORACLE).fetchall()
    assert sorted(map(tuple, chat.result(frame(rows, CHATS)).collect())) == sorted(want)


@pytest.mark.parametrize("name", ["op2_mix_sources", "op4_topk_search", "op7_chat_formatting"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    want = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = entry.queries()[name](spark, SMALL).select(*columns)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, SMALL), f"test-{name}")
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes[1] >= 0.99 * sizes[0] and sizes[2] < sizes[1] and sizes[3] == sizes[2]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert packed.where("piece = 0").count() == sizes[4]
    totals = packed.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert all(r[1] <= 4096 for r in totals)


def test_topk_of_repeated_rows_and_large_values(frame, monkeypatch):
    """Every query row ranks for itself; sums beyond doubles, and beyond longs, keep their exact order."""
    monkeypatch.setattr(topk_search, "SHARD", 7)
    monkeypatch.setattr(topk_search, "BLOCK", 3)
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=6) * rng.choice([1.0, 1e3, 1e12, 3e16])).tolist(), 0, 0) for i in range(60)]
    rows += [rows[50], rows[50], rows[7], rows[7], (100, rows[50][1], 0, 0), (150, [1e300, -1e300, 0.0, 0.0, 0.0, 0.0], 0, 0)]
    most = (1 << 63) - 1
    whole = [(i, [min(max(int(np.floor(256 * x)) if abs(x) < 2.0**55 else (most if x > 0 else -most), -most), most) for x in v]) for i, v, *_ in rows]
    want = []
    for q, v in whole:
        if q % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)[:5]
            want += [(q, k + 1, i, max(min(-s, most), -most - 1)) for k, (s, i) in enumerate(scores)]
    got = [tuple(r) for r in topk_search.result(frame(rows, VECTORS)).collect()]
    assert sorted(got) == sorted(want)
    assert len(got) == 5 * sum(1 for i, _ in whole if i % 50 == 0)


@pytest.mark.parametrize("most", [None, 0])
def test_topk_never_multiplies_what_it_broadcasts(frame, monkeypatch, most):
    """Query blocks go to the driver once each if they are few, and not at all if they are not."""
    monkeypatch.setattr(topk_search, "SHARD", 40)
    monkeypatch.setattr(topk_search, "BLOCK", 2)
    if most is not None:
        monkeypatch.setattr(topk_search, "BROADCAST_BYTES", most, raising=False)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=8) * (300 if i % 7 else 1e6)).tolist(), 0, 0) for i in range(220)] + [(900, [1.0, 2.0], 0, 0), (901, [3.0, -2.0], 0, 0)]
    found = topk_search.result(frame(rows, VECTORS))
    sent = found._jdf.queryExecution().executedPlan().toString().partition("BroadcastExchange")
    assert "explode" not in sent[2] and bool(sent[1]) == (most is None)
    whole = {i: np.floor(256 * np.array(v)).astype(int) for i, v, *_ in rows}
    want = []
    for q in (i for i in whole if i % 50 == 0):
        scores = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:5])]
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)


def test_copies_of_a_direction_are_counted_not_paired(spark):
    """20,000 copies of one vector, 500 of a near one and some of neither; scaled copies are copies."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=64)
    near = base + 0.05 * rng.normal(size=64)
    far = rng.normal(size=64)
    assert near @ base / np.linalg.norm(near) / np.linalg.norm(base) > 0.97
    kinds = {0: base.tolist(), 1: near.tolist(), 2: (4.0 * base).tolist(), 3: far.tolist()}
    ids = spark.range(20_503).selectExpr("id AS vec_id", "CASE WHEN id < 500 THEN 1 WHEN id < 20500 THEN IF(id % 2 = 0, 0, 2) ELSE 3 END AS kind")
    vectors = ids.join(spark.createDataFrame(list(kinds.items()), "kind int, embedding array<double>").hint("broadcast"), "kind")
    got = {
        (r["n_links"], r["component"]): r["n"]
        for r in embedding_dedup.near_duplicates(vectors).groupBy("n_links", "component").count().withColumnRenamed("count", "n").collect()
    }
    assert got == {(20_499, 0): 20_500, (2, 20_500): 3}


def test_recall_just_above_the_threshold():
    """Random pairs with cosines from 0.95 to 0.96, for the numbers of hashes of small and of large tables."""
    rng = np.random.default_rng(6)
    a = rng.normal(size=(400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    other = rng.normal(size=a.shape)
    other -= (other * a).sum(1, keepdims=True) * a
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    cosine = rng.uniform(0.95, 0.96, (400, 1))
    b = cosine * a + np.sqrt(1 - cosine**2) * other
    assert embedding_dedup.hash_numbers(1000) == (10, 3)
    assert embedding_dedup.hash_numbers(1 << 30) == (20, 4)
    for rows in (1000, 1 << 30):
        tables, hashes = embedding_dedup.hash_numbers(rows)
        lists = [embedding_dedup.bucket_lists(x, tables, hashes).tolist() for x in (a, b)]
        assert np.mean([bool(set(x) & set(y)) for x, y in zip(*lists)]) >= 0.9

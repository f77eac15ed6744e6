"""Components, nearest neighbours and the pipeline."""

import random

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from motorpool.llm import neighbours
from motorpool.llm.components import components


def test_components_are_union_find(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rnd.randrange(100, 400), rnd.randrange(100, 400)) for _ in range(160)] + [(5, 5), (None, 3), (7, 6)]
    edges += [(900, 900 + k) for k in range(50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    top: dict[int, int] = {}

    def root(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = root(a), root(b)
            top[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in top if root(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def _brute(rows, queries, k):
    usable = {i: np.asarray(v, float) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in queries:
        if q in usable:
            order = sorted(((-float(usable[q] @ v), i) for i, v in usable.items() if i != q))
            out[q] = [(i, -s) for s, i in order[:k]]
    return out


@pytest.mark.parametrize("n", [0, 1, 7, 300])
def test_nearest_on_small_tables_is_exact(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, [float(x) for x in rng.normal(size=5) * (1 + i % 3)]) for i in range(n)]
    if n == 300:
        rows += [(1000 + i, rows[10][1]) for i in range(60)]
        rows += [(2000, None), (2001, [0.0] * 5), (2002, [1.0, None, 0.0, 0.0, 0.0]), (2003, [float("nan")] * 5), (2004, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (None, rows[0][1]), rows[20]]
    df = spark.createDataFrame([(i, v, 3, 1.0) for i, v in rows], "vec_id long, embedding array<double>, rank int, score double")
    got: dict[int, list] = {}
    for r in neighbours.nearest(df, "id % 20 = 0", k=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = {q: v for q, v in _brute(rows, [i for i, _ in rows if i is not None and i % 20 == 0], 20).items() if v}
    assert set(got) == set(want)
    assert all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in want)
    assert all(abs(a[1] - b[1]) < 1e-9 for q in want for a, b in zip(got[q], want[q], strict=True))


def test_graph_search_recall(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got: dict[int, set] = {}
    for r in neighbours.nearest(df, "id % 100 = 0", k=20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 6000, 100):
        s = x @ x[q]
        s[q] = -9
        hits += len(got[q] & set(np.argsort(-s)[:20].tolist()))
    assert hits / (20 * 60) >= 0.9


def test_graph_is_built_until_it_settles(spark, monkeypatch):
    x = np.random.default_rng(2).normal(size=(4000, 16))
    vectors = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(x)], "id long, vec binary")
    monkeypatch.setattr(neighbours.start, "__defaults__", (neighbours.NEIGHBOURS, 1, 64))  # a poor start
    graph = neighbours.build(vectors)
    longest = float(np.linalg.norm(x, axis=1).max())
    again = neighbours.descend(graph, vectors, longest)
    assert neighbours.changed(graph) < 0.01 and neighbours.changed(again) < 0.01
    lists = {r.id: (np.frombuffer(r.near, np.int64), np.frombuffer(r.score, np.float32)) for r in again.collect()}
    assert len(lists) > 3900  # one table of small blocks leaves a few nodes alone
    assert all(len(set(n)) == len(n) <= 32 and i not in n and (np.diff(s) <= 0).all() for i, (n, s) in lists.items())


def test_a_round_joins_fresh_neighbours_only(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = {i: rng.normal(size=12) for i in range(1500)}
    vectors = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in x.items()], "id long, vec binary").cache()
    sizes, plain = [], neighbours.written

    def seen(df, label):
        out = plain(df, label)
        if label == "edges":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(neighbours, "written", seen)
    longest = max(float(np.linalg.norm(v)) for v in x.values())
    graph, codes, held = plain(neighbours.start(vectors, len(x), longest, 12, 16, 2, 128), "graph"), plain(neighbours.coded(vectors, longest), "vectors"), None
    code = {r.near: bytes(r.code) for r in codes.collect()}
    for _ in range(3):
        fresh = {(r.id, int(n)) for r in graph.collect() for n, f in zip(np.frombuffer(r.near, np.int64), r.fresh, strict=True) if f}
        every = {(r.id, int(n)) for r in graph.collect() for n in np.frombuffer(r.near, np.int64)}
        held = plain(neighbours.meetings(graph, codes, held, 16), "meetings")
        there = {}
        for r in held.collect():
            near = np.frombuffer(r.near, np.int64)
            assert len(set(near.tolist())) == len(near) and bytes(r.code) == b"".join(code[int(n)] for n in near)
            there |= {(r.id, int(n)): f for n, f in zip(near, r.fresh, strict=True)}
        assert sizes[-1] == len(fresh) and every <= there.keys()
        assert all((b, a) in fresh or (a, b) in fresh for (a, b), f in there.items() if f)
        graph = plain(neighbours.meet(graph, held, 16), "graph")
    assert sizes[0] > 2 * sizes[2]


def _packed_vectors(spark, x):
    return spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(x)], "id long, vec binary").cache()


def _share_of_nearest(graph, x, k=20):
    hits = total = 0
    for r in graph.where("id % 25 = 0").collect():
        s = x @ x[r.id]
        s[r.id] = -np.inf
        hits, total = hits + len(set(np.argsort(-s)[:k].tolist()) & set(np.frombuffer(r.near, np.int64).tolist())), total + k
    return hits / total


def test_a_larger_table_starts_as_well_and_needs_no_more_rounds(spark, monkeypatch):
    monkeypatch.setattr(neighbours.start, "__defaults__", (neighbours.NEIGHBOURS, 10, 128))  # many cells at these sizes
    rounds, plain = [], neighbours.changed
    monkeypatch.setattr(neighbours, "changed", lambda graph: rounds.append(plain(graph)) or rounds[-1])
    x = np.random.default_rng(5).normal(size=(5000, 48))
    x /= np.linalg.norm(x, axis=1)[:, None]
    taken = []
    for n in (1000, 5000):
        vectors = _packed_vectors(spark, x[:n])
        first = neighbours.start(vectors, n, 1.0, 48)
        assert first.count() == n and _share_of_nearest(first, x[:n]) > 0.85
        rounds.clear()
        assert _share_of_nearest(neighbours.build(vectors), x[:n]) > 0.95
        taken.append(len(rounds))
    assert taken[1] <= taken[0] + 1 and taken[1] <= 2


def test_cells_are_divided_when_leaders_run_out(spark, monkeypatch):
    x = np.random.default_rng(6).normal(size=(3000, 12)) * np.random.default_rng(7).uniform(0.2, 2, size=(3000, 1))
    x[:900] = x[0] + 1e-4 * x[:900]  # one cell would hold all of these
    vectors, longest = _packed_vectors(spark, x), float(np.linalg.norm(x, axis=1).max())
    sizes, plain = [], neighbours.written

    def seen(df, label):
        out = plain(df, label)
        if label == "codes":
            sizes.append({r.code: r["count"] for r in out.groupBy("code").count().collect()})
            assert out.select("code", "id").distinct().count() == out.count() == 4 * out.select("id").distinct().count()
        return out

    monkeypatch.setattr(neighbours, "written", seen)
    lists = []
    for most in (4096, 12):
        monkeypatch.setattr(neighbours, "LEADERS", most)
        lists.append({r.id: np.frombuffer(r.near, np.int64) for r in neighbours.start(vectors, 3000, longest, 12, 16, 4, 32).collect()})
    assert len(sizes[0]) <= 4 * 32 and 12 < len(sizes[1]) <= 12 * 11
    assert all(len(got) > 2900 and all(i not in near and len(set(near.tolist())) == len(near) <= 16 for i, near in got.items()) for got in lists)


def test_the_best_of_several_lists():
    pick = neighbours._pick(np.array([2, 1, 2, 2, 1]), np.array([7, 5, 7, 4, 6]), np.array([0.5, 0.1, 0.6, 0.6, 0.2]), np.array([0, 1, 1, 1, 1], np.uint8), 2)
    assert [x.tolist() for x in pick] == [[1, 1, 2, 2], [6, 5, 4, 7], [0.2, 0.1, 0.6, 0.6], [1, 1, 1, 0]]
    assert all(len(x) == 0 for x in neighbours._pick(*[np.zeros(0, np.int64)] * 3, np.zeros(0, np.uint8), 3))


def test_searches_are_salted_by_query(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ASKED", 7)
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=6)]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got: dict[int, list] = {}
    for r in neighbours.nearest(df, "id % 20 = 0", k=20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = _brute(rows, range(0, 400, 20), 20)
    assert {q: [i for i, _ in v] for q, v in want.items()} == got


def test_pipeline_keeps_columns_and_takes_effect(spark, tmp_path):
    import shutil

    for name in ("labels", "benchmark"):
        shutil.copy(f"/root/testdata/sf0.001/{name}.parquet", tmp_path / f"{name}.parquet")
    source = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    item = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").orderBy("item_id").first().text
    base = " ".join(f"u{k}v" for k in range(80))
    extra = [(9001, base, "en", "s", 1), (9002, base, "en", "s", 1), (9003, base.replace("u7v", "u7w"), "en", "s", 1), (9004, "intro words " + item + " outro", "en", "s", 1), (9005, None, "en", "s", 1), (9006, "", "en", "s", 0)]
    docs = source.union(spark.createDataFrame(extra, source.schema))
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == source.columns
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert 9002 not in seen[1] and 9003 not in seen[2] and 9004 in seen[2] and 9004 not in seen[3]
    assert {9001, 9005, 9006} <= seen[4]


def test_queries_are_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names

"""Best-fit packing, source divergence and whitening against brute force and numpy, with odd rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from motorpool.llm import divergence, packing, whitening

PATH = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"w{i % 700}x{i % 13}" for i in range(30_000))
ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, LONG), (6, "one two"), (6, "one two"), (None, "no id here"), (7, "日本 😀 ünï 12"), (8, "x" * 4000)]


# -- packing


def documents(spark, texts):
    """Extra columns carry names that the operator uses inside."""
    return spark.createDataFrame([(i, t, 1, "r", 2.0) for i, t in texts], "doc_id long, text string, row long, ids string, length double")


def test_words_remembered_one_by_one_give_the_tokenizers_ids():
    plain, rnd = Tokenizer.from_file(PATH), random.Random(2)
    words = packing.WordIds(PATH)
    parts = [*"aBcZ ßİñÉ\x0b\x0c\x1c\x85  ́èΣς' 12\t\n\r　中日😀\x00​.,!?&#$*%)-", "'s", "'LL", " the", "Ing,", "<|endoftext|>", "word", "Word.", "ÉTÉ,"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(40))) for _ in range(4000)]
    got = list(packing.text_ids(words, (t.encode() for t in texts), b"\0\0\0\0"))
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids + [0], repr(text)


def test_a_small_memory_changes_no_ids(monkeypatch):
    rnd = random.Random(9)
    texts = [" ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 9))) + rnd.choice(["", ",", "***"]) for _ in range(rnd.randrange(60))).encode() for _ in range(300)]
    want = list(packing.text_ids(packing.WordIds(PATH), texts))
    monkeypatch.setattr(packing, "MEMO_ENTRIES", 20)
    monkeypatch.setattr(packing, "SEGMENT", 100)
    monkeypatch.setattr(packing, "WORDS_A_CALL", 3)
    assert list(packing.text_ids(packing.WordIds(PATH), texts)) == want


def test_long_texts_are_cut_at_white_space(monkeypatch):
    monkeypatch.setattr(packing, "SEGMENT", 16)
    for text in (b"", b"a" * 100, b"ab cd " * 30, b" " * 50, b"a" * 40 + b" " + b"b" * 40, b"x y\nz" * 11):
        parts = list(packing._segments(text))
        assert b"".join(parts) == text and [w for p in parts for w in p.split()] == text.split()


def _check_packing(rows, want, capacity):
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc].append(r)
    for doc, texts in want.items():
        chains = Counter()
        for ids in texts:
            for piece, at in enumerate(range(0, len(ids), capacity)):
                part = ids[at : at + capacity]
                chains[piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
        assert Counter((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[doc]) == chains, doc
    assert len(rows) == sum(-(-len(ids) // capacity) for texts in want.values() for ids in texts)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_packing_of_odd_rows(spark):
    plain = Tokenizer.from_file(PATH)
    want = defaultdict(list)
    for i, t in ODD:
        want[i].append(plain.encode(t or "", add_special_tokens=False).ids + [0])
    rows = packing.pack(documents(spark, ODD).repartition(3), PATH, ids=False).collect()
    total = sum(len(ids) for texts in want.values() for ids in texts)
    assert _check_packing(rows, want, 2048) <= -(-total // 2048) + 1
    kept = packing.pack(documents(spark, ODD), PATH).collect()
    assert all(zlib.crc32(bytes(r.ids)) in {x.ids_crc32 for x in rows} and len(r.ids) == 4 * r.length for r in kept)
    assert packing.pack(documents(spark, []), PATH).count() == 0


def test_packing_is_close_to_the_bound_and_repeatable(spark):
    rnd = random.Random(6)
    texts = [(i, " ".join("a" for _ in range(rnd.choice([5, 20, 60, 90, 140])))) for i in range(4000)]
    want = {i: [[Tokenizer.from_file(PATH).encode("a").ids[0]] * len(t.split()) + [0]] for i, t in texts[:1]}
    token = want[0][0][0]
    want = {i: [[token] * len(t.split()) + [0]] for i, t in texts}
    docs = documents(spark, texts)
    first = packing.pack(docs, PATH, capacity=128, ids=False)
    rows = first.collect()
    total = sum(len(ids[0]) for ids in want.values())
    assert _check_packing(rows, want, 128) <= 1.02 * total / 128
    stored = packing.written(packing.pieces(docs, PATH, 128).drop("ids"), "t")
    a = packing.place(stored, 128, shard=500)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    b = packing.place(stored.repartition(5), 128, shard=500)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_packer_is_bounded_best_fit():
    """Against a plain list of open bins."""
    rnd = random.Random(1)
    for bound in (1, 2, 5, 50):
        packer, free, used = packing.Packer(100, bound), {}, Counter()
        for _ in range(800):
            length = rnd.randrange(1, 101)
            chosen, offset = packer.place(length)
            fits = [f for f in free.values() if f >= length]
            if fits:
                assert free[chosen] == min(fits)
            else:
                assert chosen not in used
                if len(free) == bound:
                    (closed,) = set(free) - _open(packer)
                    assert free[closed] == min(free.values())
                    del free[closed]
                free[chosen] = 100
            assert offset == used[chosen]
            used[chosen] += length
            free[chosen] -= length
            if not free[chosen]:
                del free[chosen]
            assert sorted(free) == sorted(_open(packer)) and len(free) <= bound


def _open(packer):
    return {b for bins in packer._by_free for b in bins}


# -- source divergence


def _brute_audit(rows, least):
    docs = [(a or "", b or "", t or "") for a, b, t in rows]
    cut = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n, df, groups = Counter(), Counter(), sorted({d[:2] for d in docs})
    for lang, source, text in docs:
        words = [w.translate(lower) for w in cut.findall(text)]
        n.update((lang, source, w) for w in words)
        df.update((lang, w) for w in set(words))
    out = set()
    for lang in {g[0] for g in groups}:
        terms = [w for (x, w), k in df.items() if x == lang and k >= least]
        sources = [s for x, s in groups if x == lang]
        total = {s: sum(n[lang, s, w] for w in terms) for s in sources}
        whole = sum(total.values())

        def share(c, t):
            return 1 + 1_000_000_000 * (c + 5) // (t + 5 * len(terms))

        for s in sources:
            pairs = [(sum(abs(share(n[lang, s, w], total[s]) - share(n[lang, o, w], total[o])) for w in terms), o) for o in sources if o != s]
            rise = [(share(n[lang, s, w], total[s]) - share(sum(n[lang, o, w] for o in sources), whole), w) for w in terms if n[lang, s, w]]
            for part, items, most in (("pair", pairs, 10**9), ("term", [x for x in rise if x[0] > 0], 50)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(items[:most])}
    return out


def _audited(spark, rows, least):
    df = spark.createDataFrame([(a, b, t, 5, "x") for a, b, t in rows], "lang string, source string, text string, term long, place string")
    got = [tuple(r) for r in divergence.audit(df.repartition(3), least_docs=least).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("tile", [1, 3, 128])
def test_divergence_equals_brute_force(spark, tile, monkeypatch):
    monkeypatch.setattr(divergence, "TILE", tile)
    rnd = random.Random(tile)
    vocabulary = ["Die", "die", "straße", "a", "international", "internationalen", "internationale", "12abc", "x'y", "é", "日本語テキスト", "ab c", "Z" * 30, "Z" * 31, "z" * 24]
    rows = [(rnd.choice(["de", "en", None, ""]), rnd.choice(["s1", "s2", "s3", None, "ü", "s10", "s4"]), rnd.choice([" ", "-", "\n"]).join(rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 30)))) for _ in range(200)]
    rows += [("en", "empty", None), ("en", "empty", "12 34"), ("lonely", "one", "die die"), ("none", "a", ""), ("none", "b", "q"), ("en", "s1", "internationale " * 20000)]
    assert _audited(spark, rows, 30) == _brute_audit(rows, 30)
    assert _audited(spark, rows, 1) == _brute_audit(rows, 1)


def test_divergence_of_an_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0
    assert _audited(spark, [("en", "a", None)], 1) == set()


def test_shares_do_not_overflow(spark):
    from pyspark.sql import functions as F

    big = spark.createDataFrame([(10**17, 10**17 + 7, 10**9)], "c long, t long, v long").select(divergence._share(F.col("c"), F.col("t"), F.col("v")).alias("p")).first().p
    assert big == 1 + 10**9 * (10**17 + 5) // (10**17 + 7 + 5 * 10**9)


def test_pointer_sort_orders_by_bytes():
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abé") for _ in range(rnd.choice([1, 2, 7, 8, 9, 15, 16, 17, 40]))) for _ in range(3000)] + ["a" * 33] * 40
    text = np.frombuffer(" ".join(words).encode(), np.uint8)
    size = np.array([len(w.encode()) for w in words])
    start = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    order, new = divergence.pointer_sort(text, start, start + size)
    got = [words[k].encode() for k in order]
    assert got == sorted(w.encode() for w in words)
    assert new.tolist() == [k == 0 or got[k] != got[k - 1] for k in range(len(got))]


# -- whitening


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, n long, whitened double")


def _check_whitening(spark, rows, most=32):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    x = np.floor(np.array([v for _, v in good]) * 64).astype(int) + 1_000_000
    n, d = x.shape
    sums = x.sum(axis=0)
    apart = x * n - sums
    centred = apart / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    got = whitening.components(whitening.whitened(_vectors(spark, rows).repartition(5), most)).collect()
    by = defaultdict(list)
    for r in got:
        by[r.component].append(r)
    for c, part in by.items():
        e, u = values[-c], vectors[:, -c]
        assert sorted(str(r.vec_id) for r in part) == sorted(str(i) for i, _ in good)
        assert all(r.n == n and r.identity_error < 1e-9 and abs(r.explained / (e / values.sum()) - 1) < 1e-9 for r in part)
        want = defaultdict(set)
        for (i, _), row, w in zip(good, apart.tolist(), centred @ u / np.sqrt(e), strict=True):
            want[i].add((sum(v * v for v in row), round(abs(w), 6)))
        assert all((r.deviation, round(abs(r.whitened), 6)) in want[r.vec_id] for r in part)
        mine = np.array([r.whitened for r in part])
        assert abs((mine**2).mean() - 1) < 1e-9
    return len(by)


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=40) * np.arange(1, 41) ** 0.5 + 3]) for i in range(900)]
    rows += [(1, None), (2, []), (3, [1.0] * 39 + [None]), (4, [float("nan")] * 40), (5, [float("inf")] * 40), (None, rows[3][1]), rows[7], rows[7]]
    assert _check_whitening(spark, rows) == 32
    assert _check_whitening(spark, rows, 5) == 5


def test_whitening_without_full_rank(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 4))
    flat = [(i, [*map(float, v), 7.0, float(v[0])]) for i, v in enumerate(base)]
    assert _check_whitening(spark, flat) == 4
    assert whitening.components(whitening.whitened(_vectors(spark, [(1, [1.0, 2.0])] * 5))).count() == 0
    assert whitening.whitened(_vectors(spark, [])).count() == 0
    mixed = [(i, [1.0 * i, 2.0]) for i in range(9)] + [(50, [1.0, 2.0, 3.0])]
    assert {r.vec_id for r in whitening.whitened(_vectors(spark, mixed)).collect()} == set(range(9))


def _triangle(a):
    centred = a - a.mean(axis=0)
    r = np.linalg.qr(centred, mode="r")
    out = np.zeros((a.shape[1],) * 2)
    out[: len(r)] = r
    return centred, out


@pytest.mark.parametrize("name", ["clustered", "graded", "repeated columns", "cross", "wide"])
def test_directions_of_hard_spectra(name):
    rng = np.random.default_rng(8)
    q = np.linalg.qr(rng.normal(size=(3000, 30)) - 0.0)[0]
    a = {
        "clustered": q,
        "graded": rng.normal(size=(2000, 24)) * 10.0 ** -(np.arange(24) / 4),
        "repeated columns": np.tile(rng.normal(size=(400, 6)), (1, 4)),
        "cross": np.vstack([np.eye(12), -np.eye(12)]) * 3.0,
        "wide": rng.normal(size=(9, 40)),
    }[name]
    centred, r = _triangle(a)
    model = whitening.solve(r, len(a), np.zeros(a.shape[1], np.int64), 32)
    w = centred @ model.directions / np.sqrt(model.values)
    k = len(model.values)
    assert k == min(32, np.linalg.matrix_rank(centred))
    assert np.abs(w.T @ w / len(a) - np.eye(k)).max() < 1e-8
    assert np.allclose(model.values, np.linalg.svd(r, compute_uv=False)[:k] ** 2 / len(a), rtol=1e-9)


def test_deviations_beyond_64_bits_are_null():
    x = np.array([[10**6, 10**6], [10**6 + 3, 10**6]])
    assert whitening._deviations(x, 2, x.sum(axis=0)) == [9, 9]
    assert whitening._deviations(x, 10**12, np.array([10**18, 10**18])) == [0, None]

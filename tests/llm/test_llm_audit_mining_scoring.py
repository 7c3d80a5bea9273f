"""Hard negatives, filter audit and LM scoring against brute force, and their edge cases."""

import math
import random
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from regweave.llm import audit, gru, hardneg, lm

SF = "/root/testdata/sf0.001"
CLASH = ("id", "v", "norm", "angles", "label_", "a", "w", "rank", "score", "n", "mask", "part", "row", "ids", "h", "c", "_id", "_text", "_held", "digest", "first")


def brute_negatives(rows, clip=None):
    kept = []
    for i, v, lab in rows:
        if i is None or lab is None or v is None or not all(x is not None and math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        kept.append((i, (lab + 1) % 10 if i % 7 == 0 else lab, q))
    out = []
    for i, lab, q in {(i, lab, tuple(q)) for i, lab, q in kept if i % 100 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, r)), j, m) for j, m, r in kept if j != i)
        for s, p, _ in [x for x in scored if x[2] == lab][:5]:
            fit = [x for x in scored if x[2] != lab and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(i, p, k, j, -s, -t) for k, (t, j, _) in enumerate(fit, 1)]
    return sorted(out)


def mined(df, **more):
    return sorted(map(tuple, hardneg.hard_negatives(df, **more).collect()))


def test_hard_negatives_equal_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = mined(spark.read.parquet(f"{SF}/embeddings.parquet"))
    assert got == brute_negatives(rows) and len(got) > 50


@pytest.mark.parametrize("block, run, size", [(3, 7, 5), (8192, 2048, 512)])
def test_hard_negatives_of_clusters_ties_and_hot_vectors(spark, monkeypatch, block, run, size):
    monkeypatch.setattr(hardneg, "ANCHORS", block)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 12))
    rows = []
    for i in range(1500):
        v = centres[0] if i % 3 == 0 else centres[i % 6] + rng.normal(scale=[0.01, 0.3][i % 2], size=12)
        rows.append((i, [float(x) for x in v], int(rng.integers(3))))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(5)
    got = mined(df)
    assert got == brute_negatives(rows) and len(got) > 200


def test_hard_negatives_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.4], 1), (2, [0.9, 0.5], 2), (3, [0.9, 0.5], 2), (4, None, 1), (5, [1.0, None], 1), (6, [nan, 1.0], 1), (8, [inf, 1.0], 1),
            (9, [1.0, 0.5], None), (None, [1.0, 0.5], 1), (10, [], 1), (11, [0.0, 0.0], 2), (12, [0.95], 3), (100, [-1.0, 0.25, 4.0], 3), (200, [0.0, 0.0], 2),
            (13, [1.0, 0.4], 1), (1, [1.0, 0.4], 1), (14, [1e300, 1.0], 4), (300, [0.9, 0.5], -1), (7, [0.5, 0.5], 9)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    plain = [r for r in rows if r[0] != 14]
    got = mined(df.filter("vec_id IS NULL OR vec_id <> 14").select("*", *[F.lit(1).alias(c) for c in CLASH]))
    assert got == brute_negatives(plain) and got
    assert mined(df)  # a component out of range is held at the limit
    assert mined(df.limit(0)) == []


def test_a_score_never_leaves_its_bounds():
    rng = np.random.default_rng(1)
    v = np.floor(256 * rng.normal(size=(300, 16)) * rng.choice([0.01, 1, 50], size=(300, 1)))
    v[:20] = v[20:40] * 3
    norm = np.sqrt((v * v).sum(axis=1))
    own = hardneg.angles(v, norm, hardneg.directions(v))
    low, high = hardneg._bounds(own, own, norm[:, None] * norm[None, :])
    exact = v @ v.T
    assert (low <= exact).all() and (exact <= high).all()


def brute_audit(docs, labels):
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    fails = []
    for d, t, s in docs:
        t = t or ""
        w = [x for x in t.encode().split()]
        f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
             "D": any(c in "#$%&*|" for c in t), "E": d is not None and d > least[t]}
        fails.append((d, s or "", {k for k, v in f.items() if v}))
    out = []
    for part in sorted({s for _, s, _ in fails}):
        rows = [(d, f) for d, s, f in fails if s == part]
        removed_by = Counter()
        lines = []
        for order in permutations("ABCDE"):
            left = rows
            for k, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                removed_by[f] += len(gone)
                lines.append([part, "".join(order), k, len(left), len(gone), sum(f in r[1] for r in rows) - len(gone), sum(r[1] == {f} for r in rows),
                              sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)])
        out += [(*x, removed_by[x[1][x[2] - 1]]) for x in lines]
    return sorted(out)


def test_audit_equals_brute_force(spark):
    random.seed(2)
    docs = [(i, " ".join(random.choices(["alpha", "Beta", "GAMMA", "d#", "é", "ß9"] if i % 4 else [f"w{k}" for k in range(400)], k=random.choice([0, 3, 49, 50, 80]))), random.choice(["a", "b", "", None])) for i in range(120)]
    docs += [(200 + i, docs[i % 7][1], "a") for i in range(60)] + [(5, docs[9][1], "b"), (5, None, "b"), (None, docs[1][1], "a"), (None, None, None), (7, docs[7][1], "b"), (3, "x" * 100_000, "b")]
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(0, 260, 2)] + [(4, None, 1), (None, 1, 1), (6, 1, None), (6, 0, 0), (9999, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string").select("*", *[F.lit(1).alias(c) for c in CLASH])
    lab = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").select("*", F.lit(True).alias("good"), F.lit(2).alias("_id"))
    got = sorted(map(tuple, audit.audit(df, lab).collect()))
    assert got == brute_audit(docs, labels) and len(got) == 3 * 600
    assert audit.audit(df.limit(0), lab).count() == 0 and audit.audit(df, lab.limit(0)).filter("good_lost > 0").count() == 0


def test_potentials_give_the_mean_over_all_orders():
    worth = np.random.default_rng(0).integers(0, 50, (3, 32))
    worth[:, 0] = 0
    p = audit.potentials(worth)
    for i in range(5):
        total = np.zeros(3, np.int64)
        for o in permutations(range(5)):
            before = sum(1 << j for j in o[: o.index(i)])
            total += worth[:, before | 1 << i] - worth[:, before]
        assert (2 * (p[:, 31] - p[:, 31 & ~(1 << i)]) == total).all()


def brute_base(docs):
    words = {k: (t or "").encode().lower().split() + [b""] for k, (_, t) in enumerate(docs)}
    outside = {k: d is None or zlib.crc32(str(d).encode()) % 10 == 0 for k, (d, _) in enumerate(docs)}
    c = Counter()
    for k, w in words.items():
        if not outside[k]:
            c.update(w)
    n, v = sum(c.values()), len(c)
    spread = n + 0.1 * (v + 1)
    return [(docs[k][0], outside[k], len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.1) / spread) for x in w)) for k, w in words.items()]


def check_base(rows, docs):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted((tuple(r)[:6] for r in rows), key=key), sorted(brute_base(docs), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


@pytest.mark.parametrize("frequent", [1 << 20, 40])
def test_base_scores_equal_brute_force_and_the_model_beats_them(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    monkeypatch.setattr(lm, "SHARD", 60_000)
    df = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    rows = lm.score(df.repartition(5)).collect()
    check_base(rows, docs)
    apart = [r for r in rows if r.held_out]
    assert sum(r.score for r in apart) > sum(r.base_score for r in apart)


def test_lm_edge_rows(spark, monkeypatch):
    docs = [(1, "the cat sat on the mat"), (1, "the cat sat on the mat"), (2, None), (3, ""), (4, "abcé " * 9000 + "x" * 70_000), (None, "one the"), (5, " \n\t"), (10, "A\x0bB\x1cC a")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").select("*", *[F.lit(1).alias(c) for c in CLASH])
    check_base(lm.score(df).collect(), docs)
    assert lm.score(df.limit(0)).count() == 0
    none = lm.score(df.filter("doc_id IS NULL")).collect()
    assert [(r.train_tokens, r.n_known, r.base_score, r.score) for r in none] == [(0, 0, 0.0, 0.0)]


def test_words_of_a_slice_of_a_batch(spark):
    texts = pa.array([None if i % 11 == 0 else f"Word{i} is  THE same\té {i % 7}" for i in range(9000)])
    for at, n in ((0, 9000), (8192, 808), (17, 5), (9000, 0)):
        hashes, words, sizes = lm.numbered(texts.slice(at, n))
        own, again, counts = lm.numbered(pa.array(texts.slice(at, n).to_pylist(), pa.string()))
        want = [(texts[i].as_py() or "").split() for i in range(at, at + n)]
        assert sizes.tolist() == counts.tolist() == [len(w) for w in want]
        assert hashes[words].tolist() == own[again].tolist() and len(hashes) == len({x.lower() for w in want for x in w})
    # One task with more rows than a slice.
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts.to_pylist())], "doc_id bigint, _text string").coalesce(1)
    got = lm.word_counts(df).agg(F.sum("c"), F.count("*")).first()
    want = [x for t in texts.to_pylist() for x in (t or "").lower().split()]
    assert tuple(got) == (len(want) + 9000, len(set(want)) + 1)


def test_gradients_and_a_law_over_all_words(monkeypatch):
    """One small step lowers the loss as far as its gradient says; the words' probabilities add up to 1."""
    for name, value in {"CLASSES": 3, "MEMBERS": 4, "WIDTH": 5, "LANES": 4, "STEPS": 6}.items():
        monkeypatch.setattr(gru, name, value)
    rng = np.random.default_rng(2)
    line = rng.integers(0, 12, 400)
    line[-1] = gru.END
    model = gru.fresh(np.log(np.full(12, 1 / 12)))
    loss = lambda m: -gru.Scorer(m).score([line])[0]
    after = model
    for _ in range(30):
        after = gru.train(after, np.tile([0, 3, 7, 5, 9, 2], 70), rate=0.02)
    taught = np.tile([0, 3, 7, 5, 9, 2], 20)
    assert -gru.Scorer(after).score([taught])[0] < 0.5 * -gru.Scorer(model).score([taught])[0]
    assert abs(loss(model) - 400 * np.log(12)) < 1e-2
    total = sum(np.exp(gru.Scorer(after).score([np.array([3, w])])[0] - gru.Scorer(after).score([np.array([3])])[0]) for w in range(12))
    assert abs(total - 1) < 1e-4
    one, other = gru.Scorer(after).score([line, taught, line[:1]]), [gru.Scorer(after).score([t])[0] for t in (line, taught, line[:1])]
    assert np.allclose(one, other, rtol=1e-4)
    assert all((gru.unflat(gru.flat(after), model)[k] == after[k]).all() for k in model)

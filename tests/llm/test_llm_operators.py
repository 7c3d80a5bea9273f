"""Training-data operators against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from regweave.llm import bpe, dac, decontam, jaccard, langid, quality, shards, simhash, suffixes, templates, units
from regweave.llm.batches import parts_of
from regweave.llm.components import components
from regweave.session import stored

SF = "/root/testdata/sf0.001"
LONG = "abcé" * 6000
EDGE = [
    (1, "the cat sat on the mat and then the dog ran off to see the sea", "x"), (1, "the cat sat on the mat and then the dog ran off to see the sea", "x"),
    (2, None, "y"), (3, "", "y"), (4, LONG, "z"), (None, "one two", None), (5, " \n\t ", None), (6, "a", "x"), (7, LONG + " end", "x"),
]


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns that clash with the operators' own."""
    df = spark.createDataFrame(EDGE, "doc_id bigint, text string, lang string")
    return df.select("*", *[F.lit(7).alias(c) for c in ("fp", "root", "size", "shard", "ids", "start", "piece", "k1", "score", "n_lines", "_id", "_text", "key", "v")])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def brute_prints(rows):
    out = []
    for _, t in rows:
        w = t.encode().lower().split()
        s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        out.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    return np.array(out, np.uint64)


def brute_classes(values, k):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= k):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_simhash_equals_brute_force(docs, texts):
    got = {r.doc_id: (r.fp & (2**64 - 1), r.component) for r in simhash.near_duplicates(docs).collect()}
    prints = brute_prints(texts)
    least = defaultdict(list)
    roots = brute_classes(prints, 2)
    for (d, _), r in zip(texts, roots):
        least[r].append(d)
    assert got == {d: (int(p), min(least[r])) for (d, _), p, r in zip(texts, prints, roots)}


def test_exploded_prints_are_not_broadcast(spark, monkeypatch):
    """Spark sizes them as if each print were still one row, and would take them through the driver."""
    plans = []

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df)

    monkeypatch.setattr(simhash, "stored", watched)
    close = spark.range(40).select((F.xxhash64(F.lit(1)).bitwiseXOR(F.expr("shiftleft(1L, int(id))"))).alias("fp"))
    found = simhash.links(spark.range(300).select(F.xxhash64("id").alias("fp")).union(close), paired=8)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 2 and all("Generate" in p for p in plans)
    assert "BroadcastHashJoin" not in plans[0] and "HashJoin [v0" not in plans[1]
    assert components(found).count() == 40


def test_jaccard_groups_equal_brute_force(spark, edge, empty):
    random.seed(3)
    words = [f"w{i}" for i in range(400)]
    data = []
    for _ in range(12):  # copies with changed words, chains of them, and a common passage in every third text
        base = random.choices(words, k=random.choice([3, 5, 30, 60, 200]))
        for n in range(9):
            data.append(" ".join(base + (["common", "line"] * 20 if n % 3 == 0 else [])))
            for _ in range(max(1, len(base) // 60)):
                base[random.randrange(len(base))] = random.choice(words)
    rows = list(enumerate(data))
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in map(str.split, data)]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    linked = [(i, j) for i in range(len(rows)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    for i, j in linked:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    got = {r.doc_id: r.component for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {i: find(i) for i in got} and len(got) == len(rows) and 1 < len(set(got.values())) < len(rows)
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), SF)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))
    prints = np.array([simhash.fingerprint(t.encode()) for t in data], np.uint64)
    assert any(np.bitwise_count(prints[i] ^ prints[j]) > 2 for i, j in linked)
    assert jaccard.near_duplicates(empty).count() == 0
    groups = Counter((r.root, r.component) for r in jaccard.near_duplicates(edge).collect())
    assert sorted((str(c), n) for (_, c), n in groups.items()) == [("1", 2), ("2", 3), ("4", 1), ("6", 1), ("7", 1), ("None", 1)]


def test_jaccard_moves_only_texts_that_can_be_near(spark, monkeypatch):
    random.seed(4)
    word = lambda n: [f"v{random.randrange(10**9)}" for _ in range(n)]
    common = word(1500)
    data = [common + word(n) for n in range(1500, 1512)]  # Jaccard a third; all meet in the common shingles
    data += [data[0][:-100] + word(n) for n in (100, 300)]
    sets = [jaccard.shingles(" ".join(w).encode()) for w in data]
    pairs = [(i, j) for j in range(len(sets)) for i in range(j)]
    for i, j in pairs:
        least = jaccard.differing(jaccard.sketch(sets[i]), jaccard.sketch(sets[j][: len(sets[j]) // (1 + (i + j) % 3)]))
        assert least <= len(np.setxor1d(sets[i], sets[j][: len(sets[j]) // (1 + (i + j) % 3)]))
    near = [(i, j) for i, j in pairs if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))]
    moved = []

    def similar(pairs, *rest, compare=jaccard.similar):
        moved.extend(pairs.collect())
        return compare(pairs, *rest)

    monkeypatch.setattr(jaccard, "similar", similar)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(data)], "doc_id bigint, text string")
    got = {r.doc_id: r.component for r in jaccard.near_duplicates(docs).collect()}
    assert got == {i: 0 if i in (0, 12, 13) else i for i in range(len(data))}
    assert near == [(0, 12), (0, 13), (12, 13)] and len(moved) <= len(near)


def test_jaccard_pairs_of_a_common_passage_are_not_formed(spark, monkeypatch):
    random.seed(6)
    word = lambda n: [f"u{random.randrange(10**9)}" for _ in range(n)]
    passage = word(30)
    data = [word(random.randrange(80)) + passage + word(60) for _ in range(60)]
    data += [d[:-4] + word(4) for d in data[:10]]
    sets = [set(jaccard.shingles(" ".join(w).encode()).tolist()) for w in data]
    near = {(i, j) for j in range(70) for i in range(j) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    formed = []

    def possible(pairs, *rest, compare=jaccard._possible):
        formed.append(pairs.count())
        return compare(pairs, *rest)

    monkeypatch.setattr(jaccard, "_possible", possible)
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(data)], "doc_id bigint, text string")
    got = {r.doc_id: r.component for r in jaccard.near_duplicates(docs).collect()}
    assert near == {(i, 60 + i) for i in range(10)} and got == {i: i - 60 if i >= 60 else i for i in range(70)}
    assert formed[-1] <= len(near)


@pytest.mark.parametrize("paired", [0, 64])
def test_links_find_every_link_in_pairs_and_in_stars(spark, paired):
    rng = random.Random(5)
    values = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(12):
            values.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))))
    values = np.array(sorted(values), np.uint64)
    nodes = spark.createDataFrame([(int(v),) for v in values.astype(np.int64)], "fp bigint")
    edges = simhash.links(nodes, 2, paired)
    for r in edges.collect():
        assert 0 < ((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2
    root = {r.node: r.root for r in components(edges).collect()}
    want = brute_classes(values, 2)
    signed = values.astype(np.int64).tolist()
    classes, wanted = defaultdict(set), defaultdict(set)
    for i, v in enumerate(signed):
        classes[root.get(v, v)].add(v)
        wanted[want[i]].add(v)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, wanted.values()))


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100)] + [(i + 1, i) for i in range(0, 100, 7)]
    hub = [(1000, 1001 + i) for i in range(200)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain + hub, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(101)) and all(got[1001 + i] == 1000 for i in range(200)) and 5000 not in got


def test_simhash_edge_rows(edge, empty):
    rows = simhash.near_duplicates(edge).collect()
    assert len(rows) == len(EDGE)
    zero = [r for r in rows if r.doc_id in (2, 3, 5)]
    assert all(r.fp == 0 and r.component == 2 for r in zero)
    assert [r.component for r in rows if r.doc_id is None] == [None]
    assert simhash.near_duplicates(empty).count() == 0


def check_shards(rows, texts, n):
    shard_of, slots, sizes = {}, defaultdict(list), Counter()
    for r in rows:
        t = texts[r.doc_id]
        assert r["size"] == len((t or "").encode()) + 1 and r.text_crc32 == zlib.crc32((t or "").encode())
        assert shard_of.setdefault(t or "", r.shard) == r.shard
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(n))
    return sizes


def test_shards_of_documents(docs, texts):
    sizes = check_shards(shards.shard(docs).collect(), dict(texts), 16)
    groups = Counter()
    for _, t in texts:
        groups[t] += len(t.encode()) + 1
    even = sum(sizes.values()) / 16
    assert max(sizes.values()) <= even + max(groups.values())


def test_a_third_of_all_rows_in_one_group_gets_a_shard_of_its_own(spark):
    rows = [(i, "hot text " * 20 if i % 3 == 0 else f"text {i} " * 20) for i in range(900)]
    sizes = check_shards(shards.shard(spark.createDataFrame(rows, "doc_id bigint, text string"), 8).collect(), dict(rows), 8)
    rest = sorted(sizes.values())[:-1]
    assert len(rest) == 7 and rest[-1] - rest[0] <= 400


def test_smallest_capacity_is_minimal():
    rng = random.Random(2)
    for _ in range(200):
        sizes = [rng.randrange(1, 30) for _ in range(rng.randrange(1, 12))]
        n = rng.randrange(1, 6)
        best = {0: {0: 0}}
        ends = np.cumsum([0, *sizes]).tolist()
        cost = [[10**9] * (len(sizes) + 1) for _ in range(n + 1)]
        cost[0][0] = 0
        for k in range(1, n + 1):
            for j in range(len(sizes) + 1):
                cost[k][j] = min(max(cost[k - 1][i], ends[j] - ends[i]) for i in range(j + 1))
        capacity = shards.smallest_capacity(sizes, n)
        assert capacity == cost[n][-1] and best
        cuts = [0, *shards.even_cuts(ends[1:], capacity, n), len(sizes)]
        assert cuts == sorted(cuts) and all(ends[b] - ends[a] <= capacity for a, b in zip(cuts, cuts[1:]))


def test_shards_edge_rows(edge, empty):
    rows = shards.shard(edge, 4).collect()
    assert len(rows) == len(EDGE) and len({r.shard for r in rows if r.doc_id in (2, 3)}) == 1
    assert shards.shard(empty, 4).count() == 0


def test_tree_concatenation_equals_whole_encoding():
    tok = bpe.load(bpe.default_tokenizer())
    rng = random.Random(1)
    parts = ["the", "in", "é", "é", "한", "ᄒ", "ᅡ", "ᆫ", "'s", "'ve", "'", "!", "!!", "23", "<|endoftext|>", "<|", "漢字", "İ", "Σ", "ing", "tion", " ", "😀"]
    for _ in range(150):
        text = "".join(rng.choice(rng.sample(parts, rng.choice([2, 4, 12]))) for _ in range(rng.randrange(1, 300)))
        assert bpe.encode_piece(tok, text, rng.choice([4, 16, 64]))[:, 0].tolist() == tok.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("leaf", [64, bpe.LEAF])
def test_bpe_round_trip(edge, docs, texts, leaf):
    tok = bpe.load(bpe.default_tokenizer())
    wanted = lambda t: ((e := tok.encode(t or "", add_special_tokens=False).ids), tok.decode(e, skip_special_tokens=False))
    for df, rows in ((edge, [r[:2] for r in EDGE]), (docs, texts)):
        got = Counter((r.doc_id, bytes(r.ids), r.decoded) for r in bpe.encode(df, leaf=leaf).collect())
        assert got == Counter((d, bpe.pack(w[0]), w[1]) for d, t in rows for w in [wanted(t)])


def test_batches_of_texts_in_slices():
    rng = random.Random(7)
    signs = ["a", "Bc", " ", "\n", "\t", "\x0b", "\x1f", "\u00a0", "\u3000", "\u00e9", "'s", "!", "9", "x" * 30]
    texts = [None if rng.random() < 0.1 else "".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(400)]
    words, tok, seen = bpe.Words(bpe.default_tokenizer()), bpe.load(bpe.default_tokenizer()), 0
    for part in parts_of([pa.record_batch({"t": pa.array(texts, pa.string())}).slice(3)], "t", rows=37, size=900):
        pieces = bpe.Pieces(part.column("t"))
        ids, bounds, decoded = words.encode(pieces)
        for j, (t, long) in enumerate(zip(part.column("t").to_pylist(), pieces.long_texts(25))):
            wanted = tok.encode(t or "", add_special_tokens=False).ids
            assert ids[bounds[j] : bounds[j + 1]].tolist() == wanted and decoded[j].as_py() == tok.decode(wanted, skip_special_tokens=False)
            assert long == (max(map(len, (t or "").encode().split()), default=0) > 25)
            seen += 1
    assert seen == 397


def test_bpe_of_an_empty_table(empty):
    assert bpe.encode(empty).collect() == []


def test_codes_give_any_token():
    rng = np.random.default_rng(4)
    for high in (2, 300, 70_000, 1 << 31):
        values = rng.integers(0, high, 3000).astype(np.uint32)
        code = dac.Code(dac.build(values))
        assert (code.span(0, 3000) == values).all() and all(code.get(i) == values[i] for i in (0, 1, 511, 512, 513, 2999))
        for a, b in ((0, 0), (7, 9), (511, 1025), (2999, 3000)):
            assert (code.span(a, b) == values[a:b]).all()
    assert dac.Code(dac.build(np.empty(0, np.uint32))).size == 0


def test_token_file(spark, edge, docs, texts, empty, tmp_path):
    tok = bpe.load(bpe.default_tokenizer())
    dac.write_tokens(docs, str(tmp_path / "a"), segment_tokens=5000)
    got = sorted(dac.read_documents(spark, str(tmp_path / "a")).collect())
    start, want = 0, []
    for d, t in sorted(texts):
        ids = tok.encode(t, add_special_tokens=False).ids + [1]
        want.append((d, start, len(ids), zlib.crc32(bpe.pack(ids))))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    dac.write_tokens(edge, str(tmp_path / "b"))
    rows = dac.read_documents(spark, str(tmp_path / "b")).collect()
    assert len(rows) == len(EDGE) and [r.start for r in rows if r.doc_id is None] == [0]
    dac.write_tokens(empty, str(tmp_path / "c"))
    assert dac.read_documents(spark, str(tmp_path / "c")).count() == 0


def test_repeated_words_equals_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        words = [rng.choice([b"a", b"b", b"c"][: rng.randrange(1, 4)]) for _ in range(rng.randrange(0, 60))]
        grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        want = {i + j for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for j in range(8)}
        assert quality.repeated_words(words) == len(want)


def test_trees_are_monotonic_and_learn():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 3))
    y = ((x[:, 0] + 0.5 * x[:, 1] > 0.8) ^ (rng.random(2000) < 0.05)).astype(float)
    trees = quality.grow(x, y, [1, 1, 0])
    assert ((trees.score(x) > 0) == (y > 0.5)).mean() > 0.92
    for f in (0, 1):
        line = np.repeat(rng.random((20, 1, 3)), 50, axis=1)
        line[:, :, f] = np.linspace(0, 1, 50)
        score = trees.score(line.reshape(-1, 3)).reshape(20, 50)
        assert (np.diff(score, axis=1) >= -1e-9).all()


def test_quality_verdicts(spark, edge, empty, docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    trees = quality.fit(big.filter("doc_id % 2 = 0"), labels)
    held = quality.judge(big.filter("doc_id % 2 = 1"), trees).join(labels, "doc_id").filter("not base_failed").collect()
    assert np.mean([r.kept == (r.quality == 1) for r in held]) > 0.95
    rows = quality.judge(edge, trees).collect()
    assert len(rows) == len(EDGE) and all(r.base_failed and not r.kept for r in rows)
    assert quality.judge(empty, trees).count() == 0 and not len(quality.fit(empty, labels).feature) > 1


def test_phrases_equal_the_greedy_parse():
    rng = random.Random(6)
    train = [rng.randrange(1, 4) for _ in range(60)]
    table = langid.automaton(train, 6)
    table[:, 5] = np.arange(len(table))
    joined = "".join(map(str, train))
    for _ in range(100):
        text = [rng.randrange(1, 5) for _ in range(rng.randrange(1, 40))]
        want, at = 0, 0
        while at < len(text):
            n = 1
            while at + n < len(text) + 1 and n <= len(text) - at and "".join(map(str, text[at : at + n])) in joined:
                n += 1
            at += max(1, n - 1)
            want += 1
        steps = np.array(text + [5] * 3, np.uint8)[:, None]
        assert int(langid.phrases(table, steps)[0]) == want


def test_language_of_held_out_documents(spark, edge, empty):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs)
    rows = langid.predict(docs.filter(langid.held_out("doc_id")), model).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97 and all(0 <= r.score <= 1 for r in rows)
    got = langid.predict(edge, model).collect()
    assert len(got) == len(EDGE) and {r.lang_pred for r in got if r.doc_id in (2, 3, 5)} == {"und"}
    assert langid.predict(empty, model).count() == 0
    assert langid.predict(edge, langid.fit(empty)).filter("lang_pred <> 'und'").count() == 0


def test_every_start_picks_one_piece_by_its_string_alone():
    rng = np.random.default_rng(0)
    for _ in range(200):
        length, piece, n = int(rng.integers(9, 40)), int(2 ** rng.integers(0, 4)), int(rng.integers(0, 300))
        data = rng.integers(97, 97 + int(rng.integers(1, 4)), n).astype(np.uint8)
        times, picks = np.zeros(max(0, n - length + 1), int), {}
        for h, a, b in zip(*(x.tolist() for x in suffixes.picked(data, length, piece))):
            times[a : b + 1] += 1
            assert all(picks.setdefault(data[s : s + length].tobytes(), h) == h for s in range(a, b + 1))
        assert (times == 1).all()


def test_suffix_order_equals_sorting():
    rng = random.Random(3)
    for _ in range(150):
        s = [rng.randrange(1, rng.choice([2, 3, 20]) + 1) for _ in range(rng.randrange(1, 200))]
        order = np.argsort(suffixes.suffix_ranks(np.array(s), 6), kind="stable").tolist()
        assert order == sorted(range(len(s)), key=lambda i: s[i:])


def brute_cut(rows, length):
    seen = Counter(t[i : i + length] for _, t in rows for i in range(len(t) - length + 1))
    out = []
    for d, t in rows:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[1 + i : 1 + i + length] = True
        kept = bytes(b for b, g in zip(t, gone[1:]) if not g)
        out.append((d, len(t), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("many", [3, suffixes.MANY])
def test_suffix_dedup_equals_brute_force(spark, many):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    passages = [" ".join(rng.choice(words) for _ in range(90)) for _ in range(4)]
    rows = []
    for i in range(60):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(0, 80)))
        if i % 3 == 0:
            a = rng.randrange(100)
            text = f"{text} é {passages[i % 4][a : a + rng.randrange(150, 400)]} {i}"
        rows.append((i, text))
    rows += [(100, rows[0][1]), (101, "ab" * 300), (102, passages[0] * 2), (103, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = Counter(tuple(r)[:5] for r in suffixes.cut_repeats(df, many=many).collect())
    assert got == brute_cut([(d, t.encode()) for d, t in rows], 200)


def test_suffix_dedup_edge_rows(edge, empty):
    got = Counter(tuple(r)[:5] for r in suffixes.cut_repeats(edge).collect())
    assert got == brute_cut([(d, (t or "").encode()) for d, t, _ in EDGE], 200)
    assert suffixes.cut_repeats(empty).count() == 0


def test_templates_edge_rows(spark, edge, empty):
    rows = {(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in templates.drop_recurring(edge).collect()}
    assert (2, None, 0, 0) in rows and (3, "", 1, 0) in rows and (5, " \n\t ", 2, 0) in rows
    assert templates.drop_recurring(empty).count() == 0
    lines = [(i, f"own {i} words of this one are its own {i % 7}x\nReleased on day {i} by user {chr(97 + i % 20)} under terms\nshort") for i in range(60)]
    lines += [(i + 100, lines[0][1]) for i in range(60)]
    out = templates.drop_recurring(spark.createDataFrame(lines, "doc_id bigint, text string")).collect()
    assert all("Released" not in r.text and "short" in r.text for r in out)
    kept = [("a b c d e f", 0)] * 30
    assert templates.drop_recurring(spark.createDataFrame(kept, "text string, doc_id int")).filter("n_dropped > 0").count() == 0


def test_units_against_brute_force(spark, docs, texts, edge, empty):
    first, want = {}, set()
    for d, t in sorted(texts):
        for a, b, digest in units.units(t):
            kept = first.setdefault(digest, (d, a))
            if kept != (d, a):
                want.add((d, a, b, *kept))
    assert {tuple(r) for r in units.repeated_units(docs).collect()} == want
    for _, t in texts:
        spans = [u[:2] for u in units.units(t)]
        assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:])) and all(len(t[a:b].split()) >= units.WORDS for a, b in spans)
    assert {r.doc_id for r in units.repeated_units(edge).collect()} <= {7} and units.repeated_units(empty).count() == 0


def test_repeated_lines_equal_brute_force(spark, docs, texts, edge, empty):
    long = "the committee met again and the minutes of the last meeting were read and approved by all"
    more = [(-3, f"Monday\n{long}\n--\nfirst"), (-2, f"a different speaker\n  {long.upper()}\n\nshort line\nsecond"), (-1, "Short  line\n--\nthird")]
    rows = sorted([*texts, *more])
    first, want = {}, set()
    for d, t in rows:
        at = 0
        for line in t.split("\n"):
            if key := tuple(w.lower() for w in re.findall(r"[^ \t-\r]+", line)):
                a, b = at + len(line) - len(line.lstrip(" \t\r\v\f")), at + len(line.rstrip(" \t\r\v\f"))
                kept = first.setdefault(key, (d, a))
                if kept != (d, a):
                    want.add((d, a, b, *kept))
            at += len(line) + 1
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {tuple(r) for r in units.repeated_spans(table).collect()}
    by_content = {tuple(r) for r in units.repeated_units(table).collect()}
    assert got == want | by_content and want - by_content
    assert {(-2, 22, 22 + len(long), -3, 7), (-1, 0, 11, -2, 24 + len(long))} <= got and all((k, s) < (d, a) for d, a, _, k, s in got)
    assert {r.doc_id for r in units.repeated_spans(edge).collect()} <= {7} and units.repeated_spans(empty).count() == 0


def test_alignment_equals_edit_distance():
    rng = random.Random(9)
    for _ in range(150):
        item = bytes(rng.choice(b"abc") for _ in range(rng.randrange(8, 30)))
        text = bytearray(item)
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(text))
            text[i : i + 1] = rng.choice([b"", b"a", b"bc"])
        prefix = bytes(rng.choice(b"xyz") for _ in range(5))
        whole = prefix + bytes(text) + b"zzz"
        row = [0] * (len(whole) + 1)
        for i, c in enumerate(item, 1):
            new = [i]
            for j, x in enumerate(whole, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != x)))
            row = new
        got = decontam.align(item, whole, -2, 12, 4)
        assert (got[0] if got else 9) == (min(row) if min(row) <= 4 else 9)


def test_decontamination(spark, docs, texts, edge, empty):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    fold = lambda t: re.sub(rb"[\t\n\r\f\v]", b" ", t.encode().lower())
    want = {(d, r.item_id, m.start(), m.end(), 0) for d, t in texts for r in benchmark.collect() for m in re.finditer(re.escape(fold(r.text)), fold(t))}
    got = {tuple(r) for r in decontam.contaminated(docs, benchmark).collect()}
    assert want and want <= got and all(r[4] > 0 for r in got - want)
    text = benchmark.first().text
    near = text[:40] + "Q" + text[41:90] + text[91:]
    rows = decontam.contaminated(spark.createDataFrame([(1, "before " + near + " after"), (2, text.upper().lower()), (3, text[:50])], "doc_id bigint, text string"),
                                 benchmark.limit(1)).collect()
    assert {r.doc_id: r.edits for r in rows} == {1: 2, 2: 0}
    assert decontam.contaminated(edge, empty.select(F.col("doc_id").alias("item_id"), "text")).count() == 0
    assert decontam.contaminated(empty, benchmark).count() == 0
    short = spark.createDataFrame([(1, "dog"), (2, None), (3, "")], "item_id bigint, text string")
    assert {r.doc_id for r in decontam.contaminated(edge, short).collect()} == {1}
    blocks = {tuple(r) for r in decontam.contaminated(docs, benchmark, block_bytes=500).collect()}
    assert blocks == got


@pytest.mark.parametrize("hot", [40, 100, 3])
def test_the_plan_has_the_smallest_capacity_over_all_groups(spark, hot, monkeypatch):
    """Tens of thousands of groups, one with a fortieth (or a third) of all rows; every histogram is seen."""
    seen = []
    refined = shards._refined
    monkeypatch.setattr(shards, "_refined", lambda g, p, s: seen.append(len(s)) or refined(g, p, s))
    rng = random.Random(hot)
    sizes = [rng.choice([1, 3, 40, 900]) for _ in range(51_000)] + [0]
    sizes[-1] = sum(sizes) // (hot - 1)
    orders = rng.sample(range(1 << 50), len(sizes) - 1)
    rows = [(o << 13, s) for o, s in zip(orders, sizes)] + [((orders[77] << 13) + 1, sizes[-1])]
    alone, firsts, capacity = shards.plan(spark.createDataFrame(rows, "order bigint, bytes bigint").repartition(8), 16)
    left = sorted(r for r in rows if r[0] not in alone)
    assert capacity == shards.smallest_capacity([s for _, s in left], 16 - len(alone))
    loads = Counter()
    for o, s in left:
        loads[sum(o >= f for f in firsts)] += s
    assert max(loads.values()) <= capacity and sum(seen) < 20_000


def test_thousands_of_buckets_are_refined_in_one_filter(spark):
    rows = [(i << 49, 1 + i % 7) for i in range(1 << 13)] + [((i << 49) + 5, 2) for i in range(1 << 13)]
    groups = spark.createDataFrame(rows, "order bigint, bytes bigint")
    pieces = shards._histogram(groups, 12)
    assert len(pieces) == 2048 and all(p[2] == 8 for p in pieces)
    fine = shards._refined(groups, pieces, list(range(2048)))
    assert sum(p[1] for p in fine) == sum(s for _, s in rows) and len(fine) == 1 << 13
    assert sum(p[1] for p in shards._refined(groups, fine, [0, 3])) == sum(s for _, s in rows)


def test_contaminated_equals_brute_force_over_edited_passages(spark):
    """Random edits up to and beyond the bound, items that repeat, several in a text, at either end of it."""
    rng = random.Random(8)
    words = ["stone", "river", "lamp", "the", "of", "window", "seven", "quiet", "paper", "mountain", "é"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([3, 12, 25])))) for i in range(12)]
    items.append((50, items[3][1].upper()))

    def edited(text, n):
        chars = list(text)
        for _ in range(n):
            at = rng.randrange(len(chars))
            chars[at : at + 1] = rng.choice([[], [rng.choice("xyz")], [chars[at], rng.choice("xyz")]])
        return "".join(chars)

    rows = []
    for i in range(150):
        parts = [" ".join(rng.choices(words, k=rng.randrange(40))) for _ in range(2)]
        t = rng.choice(items)[1]
        parts.insert(rng.randrange(3), edited(t, rng.randrange(0, 2 + len(t.encode()) // 20)))
        rows.append((i, rng.choice([" ", "\n"]).join(parts)))

    def least_edits(item, text):
        """Fewest edits of the item against any part of the text, by the full table."""
        row = np.zeros(len(text) + 1, int)
        for k, c in enumerate(item, 1):
            new = np.minimum(row[1:] + 1, row[:-1] + (np.frombuffer(text, np.uint8) != c))
            new = np.r_[k, new]
            row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
        return int(row.min())

    want = set()
    for d, text in rows:
        for i, item in items:
            item, folded = decontam.fold(item.encode()), decontam.fold(text.encode())
            if folded and least_edits(item, folded) <= decontam.Index.budget(len(item), decontam.EDITS):
                want.add((d, i))
    found = decontam.contaminated(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and len(want) > 100
    for r in found:
        part = decontam.fold(dict(rows)[r.doc_id].encode())[r.start : r.end]
        assert least_edits(decontam.fold(dict(items)[r.item_id].encode()), part) <= r.edits


def test_languages_of_many_scripts_and_many_languages(spark):
    rng = random.Random(6)
    scripts = {"zh": "的一是不了人我在有他这中大来上国个到说们为子和你地出道也时年得就那要下以生会自着去之过家学对可她里后小么心多天而能好都然没日于起还发成事只作当想看文无开手十用主行方又如前所本见经头面公同三已老从动两长",
               "ja": "のにはをたがでてとしれさあるいもするからなことまりよどそうだけっんえせおみめわつ日本人年大学者国中出生時会社行事見分後前間自何上気地方新場員立開手力問代明", "ko": "이다는에의을가고하지를로한은기도사시정인리서자대어나일해보스그만전수부제상라아주원조여구동마국선비성장들과유미공무경",
               "el": "αβγδεζηθικλμνξοπρστυφχψω", "ru": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "he": "אבגדהוזחטיכלמנסעפצקרשת", "en": "abcdefghijklmnopqrstuvwxyz", "fr": "abcdefghijklmnopqrstuvwxyzéèàçêîôû"}

    def words_of(letters, seed):
        r = random.Random(seed)
        weights = [1 / (i + 1) for i in range(len(letters))]
        return ["".join(r.choices(letters, weights, k=r.randrange(2, 7))) for _ in range(150)]

    spoken = {lang: words_of(letters, lang) for lang, letters in scripts.items()}
    rows = [(i, " ".join(rng.choices(spoken[lang], k=40)), lang) for i, lang in enumerate(sorted(scripts) * 25)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = langid.predict(docs.filter(langid.held_out("doc_id")), langid.fit(docs)).collect()
    assert len(got) > 30 and all(r.lang == r.lang_pred for r in got)
    # More languages than 64: each has a part of the model.
    spoken = {f"l{n}": words_of("abcdefghijklmnop", n) for n in range(90)}
    rows = [(i, " ".join(rng.choices(spoken[lang], k=60)), lang) for i, lang in enumerate(sorted(spoken) * 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = langid.fit(docs)
    got = langid.predict(docs.filter(langid.held_out("doc_id")), model).collect()
    assert len(model.languages) == 90 and sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)


def test_without_labels_the_quality_rules_keep_what_passes_the_fixed_ones(docs):
    labels = docs.select("doc_id", F.lit(None).cast("int").alias("quality"))
    rows = quality.judge(docs, quality.fit(docs, labels)).collect()
    assert all(r.kept != r.base_failed for r in rows) and any(r.kept for r in rows)


def test_base_counts_of_quality_equal_brute_force(docs, texts):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.judge(docs, quality.grow(np.empty((0, 13)), np.empty(0), [0] * 13)).collect()}
    for d, t in texts:
        words = [w.decode() for w in t.encode().split()]
        seen, dup = set(), 0
        for line in t.split("\n"):
            if line.encode().split():
                dup += line in seen
                seen.add(line)
        windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
        hit = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit), len(words) < 20 or 100 * len(hit) > 30 * len(words))
        assert got[d] == want

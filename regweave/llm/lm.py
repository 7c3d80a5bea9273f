"""LM scoring: counts over all training documents, a gated recurrent model trained on all of them, whole texts scored.

Words that make up more than one token in ``FREQUENT`` (so at most that many words) are held by every task; the
others, each rare, meet their counts in a join on the word's hash.  The recurrent model predicts the most frequent
words and one RARE class; within RARE a word has its share of the unigram law, so the model is a law over all words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regweave.llm import gru
from regweave.llm.batches import parts_of, slices
from regweave.llm.catalog import query
from regweave.session import stored

#: Words held by every task, at most: 16 bytes each.  Tokens of one training shard, about.
FREQUENT, SHARD = 1 << 20, 4_000_000
#: Eighths of the training documents that each round of training starts and ends with.
ROUNDS = ((0, 1), (1, 3), (3, 8))
#: Weights are averaged as integers of 1 / UNIT, so the order of adding does not matter.
UNIT = 1 << 24
#: Counts that a task holds before it hands them on.
HELD = 2_000_000


def held_out(id: Column) -> Column:
    """Documents that are scored and not learned from; so are those without an id."""
    return F.coalesce(F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(10)) == 0, F.lit(True))


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit integers with their bits spread."""
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
    return x


#: A number for each byte, and the key of the end of a document.
_BYTES, END_KEY = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)), 0


def hashes_of(words: pa.Array) -> np.ndarray:
    """64-bit keys of words, none of them empty: sums of each byte's number times an odd number of its place."""
    if not len(words):
        return np.empty(0, np.int64)
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    odd = _mixed((np.arange(int(np.diff(offsets).max())) + 1000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return _mixed(np.add.reduceat(_BYTES[data] * odd[place], offsets[:-1])).view(np.int64)


def numbered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, numbered: (hash of each different word, number of each word in order, words of each text)."""
    # A copy whose characters start at 0: Arrow's ascii_lower garbles slices that begin further on.
    texts = pc.fill_null(texts.cast(pa.large_string()), "").take(pa.array(np.arange(len(texts))))
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = split.flatten()
    # White space at either end leaves an empty word.
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    sizes = split.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[real], minlength=len(sizes))
    coded = words.filter(pa.array(real)).dictionary_encode()
    return hashes_of(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False), sizes


def word_counts(docs: DataFrame) -> DataFrame:
    """``h``, ``c`` of every distinct word of ``_text`` and of the end of a document."""

    def merged(hashes: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        keys, back = np.unique(np.concatenate(hashes), return_inverse=True)
        return keys, np.bincount(back, weights=np.concatenate(times), minlength=len(keys)).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, times = [], []
        for part in parts_of(batches, "_text"):
            own, words, _ = numbered(part.column("_text"))
            hashes += [own, np.array([END_KEY])]
            times += [np.bincount(words, minlength=len(own)), np.array([part.num_rows])]
            if sum(map(len, hashes)) > HELD:
                hashes, times = ([x] for x in merged(hashes, times))
                if len(hashes[0]) > HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(hashes[0]), pa.array(times[0])], names=["h", "c"])
                    hashes, times = [], []
        if hashes:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged(hashes, times)], names=["h", "c"])

    return docs.select("_text").mapInArrow(run, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))


def encode(docs: DataFrame, keys: np.ndarray, logs: np.ndarray, known: bool) -> DataFrame:
    """Model ids of each text (``_text``) and its unigram sums over the frequent words; rare words as hashes and counts.

    ``keys`` and ``logs``: hashes of the frequent words by falling count and their log10 probabilities, the end of
    a document first.
    """
    held = docs.sparkSession.sparkContext.broadcast((keys, logs))
    vocabulary = gru.CLASSES * gru.MEMBERS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logs = held.value
        order = np.argsort(keys)
        ordered = keys[order]
        for part in parts_of(batches, "_text"):
            hashes, words, sizes = numbered(part.column("_text"))
            place = np.minimum(np.searchsorted(ordered, hashes), len(keys) - 1)
            # Place of each different word among the frequent ones, -1 for the others.
            place = np.where(ordered[place] == hashes, order[place], -1)
            ends = np.cumsum(sizes)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            n = place[words]
            common = n >= 0
            # The frequent word n (0 is the end) has the id n + 1 where the model's vocabulary reaches that far.
            got = np.where(common & (n < vocabulary - 1), n + 1, gru.RARE).astype(np.uint16)
            outside = got == gru.RARE
            line = np.insert(got, ends, gru.END)
            base = np.bincount(doc[common], weights=logs[n[common]], minlength=len(sizes)) + logs[0]
            both = common & outside
            base_out = np.bincount(doc[both], weights=logs[n[both]], minlength=len(sizes))
            n_known = np.bincount(doc[common], minlength=len(sizes)) + int(known)
            n_out = np.bincount(doc[outside], minlength=len(sizes))
            pairs, times = np.unique(doc[~common] * len(hashes) + words[~common], return_counts=True)
            owner, rare = np.divmod(pairs, max(1, len(hashes)))
            rare_ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sizes)))]).astype(np.int32)
            offsets = np.concatenate([[0], 2 * (ends + np.arange(1, len(sizes) + 1))])
            if offsets[-1] >= 1 << 31:
                raise ValueError("a text of over 2^30 words")
            column = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(line.astype("<u2").tobytes())])
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), part.column("_held"), column, pa.array(sizes + 1), pa.array(n_known.astype(np.int64)), pa.array(n_out.astype(np.int64)), pa.array(base.astype(float)), pa.array(base_out.astype(float)),
                 pa.ListArray.from_arrays(rare_ends, pa.array(hashes[rare])), pa.ListArray.from_arrays(rare_ends, pa.array(times.astype(np.int64)))],
                names=["_id", "_held", "ids", "n", "known", "n_out", "base", "base_out", "rare_h", "rare_n"])

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"_id {kind}, _held boolean, ids binary, n bigint, known bigint, n_out bigint, base double, base_out double, rare_h array<bigint>, rare_n array<bigint>")


def trained(encoded: DataFrame, start: gru.Model) -> gru.Model:
    """The model after all rounds: in each, every shard trains its own copy on its documents, then weights are averaged.

    Shards are sets of documents by hash, their number follows the tokens; each training document belongs to one
    shard of one round.  Gathered by the driver: sums of the weights, whose number is fixed.
    """
    key = F.xxhash64("_id", "ids")
    docs = encoded.filter("NOT _held").select("ids", "n", key.alias("key")).withColumn("turn", F.pmod("key", F.lit(8)))
    tokens = {r[0]: r[1] for r in docs.groupBy("turn").agg(F.sum("n")).collect()}
    model = start
    for low, high in ROUNDS:
        total = sum(tokens.get(t, 0) for t in range(low, high))
        if not total:
            continue
        shards = -(-total // SHARD)
        held = encoded.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            def out(texts: list[bytes]) -> pa.RecordBatch:
                line = np.frombuffer(b"".join(texts), "<u2").astype(np.int64)
                weights = np.rint(gru.flat(gru.train(held.value, line)).astype(np.float64) * UNIT).astype(np.int64)
                return pa.RecordBatch.from_arrays([pa.array([np.append(weights, 1)], pa.list_(pa.int64()))], names=["w"])

            shard, texts = None, []
            for batch in batches:
                for s, ids in zip(batch.column("shard").to_pylist(), batch.column("ids").to_pylist()):
                    if s != shard and texts:
                        yield out(texts)
                        texts = []
                    shard = s
                    texts.append(ids)
            if texts:
                yield out(texts)

        rows = docs.filter(F.col("turn").between(low, high - 1)).select(F.pmod(F.shiftright("key", 3), F.lit(shards)).alias("shard"), "key", "ids")
        rows = rows.repartition(shards, "shard").sortWithinPartitions("shard", "key", "ids").select("shard", "ids")
        sums = rows.mapInArrow(run, "w array<bigint>").select(F.posexplode("w").alias("i", "w")).groupBy("i").agg(F.sum("w").alias("w")).toArrow()
        line = np.empty(len(sums))
        line[sums["i"].to_numpy()] = sums["w"].to_numpy()
        model = gru.unflat(line[:-1] / (line[-1] * UNIT), start)
    return model


def score(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every whole text.

    Null and empty texts are a single end.  Rows without an id are held out and kept; rows that repeat are learned from
    and scored each; an empty table gives an empty table; other columns are not read.  Without training documents every
    token has the log probability 0, and ``score`` is ``base_score``.  Words are told apart by a 64-bit hash: two
    words that share one would count as one (one pair is expected among 6 * 10^9 different words).
    """
    docs = docs.select(F.col(id).alias("_id"), held_out(F.col(id)).alias("_held"), F.col(text).cast("string").alias("_text"))
    counts = stored(word_counts(docs.filter("NOT _held")))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    spread = n + 0.1 * (v + 1)
    top = counts.filter((F.col("c") * FREQUENT > n) & (F.col("h") != END_KEY)).orderBy(F.desc("c"), "h").toArrow()
    ends = counts.filter(F.col("h") == END_KEY).first()
    keys = np.concatenate([[END_KEY], top["h"].to_numpy()]).astype(np.int64)
    shares = (np.concatenate([[ends.c if ends else 0], top["c"].to_numpy()]) + 0.1) / spread
    rows = encode(docs, keys, np.log10(shares), bool(n)).withColumn("row", F.monotonically_increasing_id())
    encoded = stored(rows)

    used = shares[: gru.CLASSES * gru.MEMBERS - 1]
    rest = max(1 - float(used.sum()), 0.1 / spread)
    model = gru.fresh(np.log(np.concatenate([used[:1], [rest], used[1:]]))) if n else None
    model = trained(encoded, model) if n else None
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = gru.Scorer(held.value) if held.value else None
        for batch in batches:
            for part, texts in slices(iter([batch]), "ids", rows=1 << 20, size=4_000_000):
                logs = scorer.score([np.frombuffer(t, "<u2").astype(np.int64) for t in texts]) if scorer else np.zeros(len(texts))
                own = pa.array(logs / np.log(10))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), own], names=[*kept, "own"])

    kept = ["row", "_id", "_held", "n", "known", "n_out", "base", "base_out"]
    scored = encoded.select(*kept, "ids").mapInArrow(run, encoded.select(*kept).schema.add("own", "double"))
    rare = encoded.select("row", F.explode(F.arrays_zip("rare_h", "rare_n")).alias("e")).select("row", F.col("e.rare_h").alias("h"), F.col("e.rare_n").alias("times"))
    share = (F.coalesce("c", F.lit(0)) + 0.1) / F.lit(spread)
    rare = rare.join(counts.filter(F.col("c") * FREQUENT <= n), "h", "left")
    rare = rare.groupBy("row").agg(F.sum(F.col("times") * F.log10(share)).alias("rare"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"))
    base = F.col("base") + F.coalesce("rare", F.lit(0.0))
    whole = F.col("own") + F.col("base_out") + F.coalesce("rare", F.lit(0.0)) - F.col("n_out") * F.lit(float(np.log10(rest)))
    return scored.join(rare, "row", "left").select(
        F.col("_id").alias(id), F.col("_held").alias("held_out"), F.col("n").alias("n_tokens"), (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"), base.alias("base_score"), (whole if n else base).alias("score"))


@query("op13_lm_score")
def op13(t):
    """Log probability of every document."""
    return score(t.documents)

"""BPE encoding and decoding of whole texts with a public tokenizer, by tree concatenation.

White space never lies inside a pre-token of this family of tokenizers (BPE with word ends, white space
dropped), so the pieces between ASCII white space encode on their own and a worker remembers pieces it has
seen.  A piece that is long and unsplit is cut in halves until they are short; the halves are encoded as rows
of their own, and a tree of joins puts them together: the text around a cut is encoded again in growing
windows until the window agrees with both sides exactly.

Why agreement is enough: a token sequence is the encoding of its text if and only if each neighbouring pair
of tokens is stable.  The pairs of both sides are stable by construction, those of the window too, and a
shared token at each end of the window glues the three chains together.
"""

from __future__ import annotations

import gc
import os
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regweave.llm.batches import batch_of, parts_of
from regweave.llm.catalog import query
from regweave.session import stored

#: Characters of a piece from which on it is cut, and of the parts that it is cut into.
LEAF = 4096
#: Pieces that a worker remembers before it starts afresh, with and without their decoded texts.
REMEMBERED, REMEMBERED_IDS = 250_000, 1_200_000

ENCODED = "ids binary, decoded string"


def default_tokenizer() -> str:
    """Path of the public tokenizer with word ends."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def load(path: str):
    """The tokenizer without its own threads: Spark's tasks are the parallelism."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def pack(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.asarray(ids, "<u4").tobytes()


class Numbers(dict):
    """Numbers of pieces in order of first sight; ``new`` gathers those not yet encoded."""

    new: list[bytes]

    def __missing__(self, piece: bytes) -> int:
        self.new.append(piece)
        n = self[piece] = len(self)
        return n


class Pieces:
    """Texts of a batch cut at ASCII white space: ``bounds`` of each text among the distinct pieces' ``codes``."""

    def __init__(self, texts: pa.Array) -> None:
        words = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        self.bounds = words.offsets.to_numpy().astype(np.int64)
        coded = words.flatten().dictionary_encode()
        self.codes = coded.indices.to_numpy(zero_copy_only=False)
        self.distinct = coded.dictionary.cast(pa.binary())

    def long_texts(self, leaf: int) -> np.ndarray:
        """Which texts hold a piece of more than ``leaf`` bytes."""
        out = np.zeros(len(self.bounds) - 1, bool)
        sizes = pc.binary_length(self.distinct).to_numpy(zero_copy_only=False)
        if len(sizes) and sizes.max() > leaf:
            out[np.searchsorted(self.bounds, np.flatnonzero(sizes[self.codes] > leaf), side="right") - 1] = True
        return out


class Words:
    """Encodings of pieces between ASCII white space, remembered up to a bound.

    A decoded piece ends in a space, of which the whole text drops the last; a piece without tokens decodes
    to nothing.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED, decoded: bool = True, leaf: int = LEAF) -> None:
        self.tok, self.most, self.decoded, self.leaf = load(path), remembered, decoded, leaf
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.texts = Numbers(), []
        self.ids, self.ends = np.empty(0, np.uint32), np.zeros(1, np.int64)
        self.numbers.new = []

    def encode(self, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, pa.Array | None]:
        """Ids of all texts in one array, the bounds of each text, and the decoded texts."""
        if len(self.numbers) > self.most:
            self._forget()
        gc.disable()  # nothing here is cyclic, and the memory is large to walk through
        try:
            return self._encode(pieces)
        finally:
            gc.enable()

    def _encode(self, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, pa.Array | None]:
        numbers = np.fromiter(map(self.numbers.__getitem__, pieces.distinct.to_pylist()), np.int64, len(pieces.distinct))
        new, self.numbers.new = self.numbers.new, []
        for at in range(0, len(new), 20_000):
            self._learn([w.decode() for w in new[at : at + 20_000]])
        starts, sizes = self.ends[numbers], self.ends[numbers + 1] - self.ends[numbers]
        counts = sizes[pieces.codes]
        ends = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.repeat(starts[pieces.codes] - ends[:-1], counts) + np.arange(ends[-1])]
        texts = None
        if self.decoded:
            parts = pa.array(map(self.texts.__getitem__, numbers.tolist()), pa.string(), size=len(numbers)).take(pa.array(pieces.codes))
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(pieces.bounds, pa.int32()), parts), "")
            texts = pc.binary_slice(joined.cast(pa.binary()), 0, -1).cast(pa.string())
        return ids, ends[pieces.bounds], texts

    def _learn(self, pieces: list[str]) -> None:
        if max(map(len, pieces)) > self.leaf:
            ids = [encode_piece(self.tok, p, self.leaf)[:, 0].tolist() for p in pieces]
        else:
            ids = [e.ids for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]
        self.ids = np.concatenate([self.ids, np.array([i for x in ids for i in x], np.uint32)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum([len(x) for x in ids])])
        if self.decoded:
            self.texts += [t + " " if x else "" for t, x in zip(self.tok.decode_batch(ids, skip_special_tokens=False), ids)]


def worker_words(path: str, decoded: bool = True, leaf: int = LEAF) -> Words:
    """The memory of this Python worker: Spark reuses workers, so later tasks find it filled."""
    held = sys.__dict__.setdefault("_regweave_words", {})
    if (path, decoded, leaf) not in held:
        held[path, decoded, leaf] = Words(path, REMEMBERED if decoded else REMEMBERED_IDS, decoded, leaf)
    return held[path, decoded, leaf]


# Tree concatenation


def fine_cut(text: str, p: int, specials: list[str]) -> bool:
    """Whether the pre-tokens and the normal form on both sides of ``p`` do not depend on each other.

    A run of letters or signs may go on across ``p``; the joins see to that.  Apostrophes start
    contractions, special tokens are found before all else, and characters may compose.
    """
    if p <= 0 or p >= len(text):
        return True
    if any(c in "'\N{RIGHT SINGLE QUOTATION MARK}" for c in text[max(0, p - 3) : p + 3]):
        return False
    left, right = text[max(0, p - 8) : p], text[p : p + 8]
    if not (left + right).isascii():
        nfc = unicodedata.normalize
        if unicodedata.combining(right[0]) or nfc("NFC", left + right) != nfc("NFC", left) + nfc("NFC", right):
            return False
    for s in specials:
        if s in text[max(0, p - len(s) + 1) : p + len(s) - 1]:
            return False
    return True


def cuts(text: str, specials: list[str], leaf: int = LEAF) -> list[int]:
    """Cut positions of the recursive halving, in order.  A stretch without a fine cut stays whole."""
    out: list[int] = []
    todo = [(0, len(text))]
    while todo:
        lo, hi = todo.pop()
        if hi - lo <= leaf:
            continue
        mid = (lo + hi) // 2
        p = next((q for d in range((hi - lo) // 2) for q in (mid - d, mid + d) if lo < q < hi and fine_cut(text, q, specials)), None)
        if p is not None:
            out.append(p)
            todo += [(lo, p), (p, hi)]
    return sorted(out)


def encode_part(tok, text: str, lo: int, hi: int) -> np.ndarray:
    """Rows of (id, start, end) of ``text[lo:hi]``; positions are those of the whole text."""
    e = tok.encode(text[lo:hi], add_special_tokens=False)
    out = np.empty((len(e.ids), 3), np.int64)
    out[:, 0] = e.ids
    out[:, 1:] = np.asarray(e.offsets, np.int64).reshape(-1, 2) + lo
    return out


def join_parts(tok, text: str, specials: list[str], left: np.ndarray, right: np.ndarray, lo: int, cut: int, hi: int, start: int = 8) -> np.ndarray:
    """Encoding of ``text[lo:hi]`` from those of ``text[lo:cut]`` and ``text[cut:hi]``."""
    k = start
    while True:
        i = max(0, len(left) - k)
        while i > 0 and not (left[i, 1] >= left[i - 1, 2] and fine_cut(text, int(left[i, 1]), specials)):
            i -= 1
        n = min(len(right), k)
        while n < len(right) and right[n, 1] < right[n - 1, 2]:
            n += 1
        a, b = (int(left[i, 1]) if i else lo), (hi if n >= len(right) else int(right[n - 1, 2]))
        window = encode_part(tok, text, a, b)
        left_agrees = i == 0 or len(window) > 0 and (window[0] == left[i]).all()
        if left_agrees and b == hi:
            return np.concatenate([left[:i], window])
        if left_agrees:
            at = {(int(s), int(e)): j for j, (_, s, e) in enumerate(right[:n])}
            for j in range(len(window) - 2, 0, -1):
                t, s, e = map(int, window[j])
                r = at.get((s, e))
                if s < cut or r is None or r + 1 >= len(right):
                    continue
                alone = window[j - 1, 2] <= s and window[j + 1, 1] >= e and (r == 0 or right[r - 1, 2] <= s) and right[r + 1, 1] >= e
                if alone and int(right[r, 0]) == t:
                    return np.concatenate([left[:i], window[: j + 1], right[r + 1 :]])
        k *= 2


def join_tree(tok, text: str, parts: list[np.ndarray], bounds: list[int]) -> np.ndarray:
    """All parts joined pairwise; ``bounds`` are the cuts with 0 and the length around them."""
    specials = special_texts(tok)
    while len(parts) > 1:
        joined, kept = [], [bounds[0]]
        for i in range(0, len(parts) - 1, 2):
            joined.append(join_parts(tok, text, specials, parts[i], parts[i + 1], bounds[i], bounds[i + 1], bounds[i + 2]))
            kept.append(bounds[i + 2])
        if len(parts) % 2:
            joined.append(parts[-1])
            kept.append(bounds[-1])
        parts, bounds = joined, kept
    return parts[0]


def encode_piece(tok, text: str, leaf: int = LEAF) -> np.ndarray:
    """Tree concatenation of one piece in one task."""
    bounds = [0, *cuts(text, special_texts(tok), leaf), len(text)]
    return join_tree(tok, text, [encode_part(tok, text, a, b) for a, b in zip(bounds, bounds[1:])], bounds)


def special_texts(tok) -> list[str]:
    """Contents of the added tokens."""
    return [t.content for t in tok.get_added_tokens_decoder().values()]


# The operator


def encode(docs: DataFrame, path: str | None = None, id: str = "doc_id", text: str = "text", leaf: int = LEAF) -> DataFrame:
    """Ids and decoded text of every whole text: columns ``id``, ``ids`` (little-endian uint32), ``decoded``.

    Null and empty texts give no ids and an empty text; rows that repeat are kept; null ids stay null; other
    columns are not read, whatever their names.  An empty table gives an empty table.
    """
    path = path or default_tokenizer()
    docs = docs.select(F.col(id).alias("_id"), F.col(text).cast("string").alias("_text"))
    id_type = docs.schema["_id"].dataType.simpleString()

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, schema = worker_words(path, True, leaf), None
        for part in parts_of(batches, "_text", rows=2048, size=2_000_000):
            schema = schema or pa.schema([("_id", part.schema.field("_id").type), ("ids", pa.binary()), ("decoded", pa.string())])
            pieces = Pieces(part.column("_text"))
            long = pieces.long_texts(leaf)
            if long.any():
                part = part.filter(pa.array(~long))
                pieces = Pieces(part.column("_text"))
            ids, bounds, decoded = words.encode(pieces)
            flat = pa.py_buffer(ids.astype("<u4"))
            rows = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer((4 * bounds).astype(np.int32)), flat])
            yield batch_of(schema, part.column("_id"), rows, decoded)

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts_of(batches, "_text", rows=2048, size=2_000_000):
            keep = Pieces(part.column("_text")).long_texts(leaf)
            if keep.any():
                yield part.filter(pa.array(keep))

    out = docs.mapInArrow(short, f"_id {id_type}, {ENCODED}")
    # Texts with a long unsplit piece: encoded once per text, piece by piece in rows of their own.
    with_long = stored(docs.filter(F.length("_text") > leaf / 4).mapInArrow(long, docs.schema).withColumn("_h", F.sha2("_text", 256)))
    whole = _encode_long(with_long.select("_h", "_text").dropDuplicates(["_h"]), path, leaf)
    out = out.unionByName(with_long.join(whole, "_h").select("_id", "ids", "decoded"))
    return out.withColumnRenamed("_id", id)


def _encode_long(texts: DataFrame, path: str, leaf: int) -> DataFrame:
    """``_h``, ids and decoded text of distinct texts with long unsplit pieces."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        specials = special_texts(load(path))
        schema = pa.schema([("_h", pa.string()), ("_no", pa.int64()), ("_lo", pa.int64()), ("_part", pa.string())])
        for batch in batches:
            for h, raw in zip(batch.column("_h").to_pylist(), batch.column("_text").to_pylist()):
                no, rows, room = 0, [], []
                for w in raw.encode().split():
                    if len(w) <= leaf:
                        room.append(w)
                        if len(room) < 512:
                            continue
                    if room:
                        rows.append((h, no, -1, b" ".join(room).decode()))
                        no, room = no + 1, []
                    if len(w) > leaf:
                        piece = w.decode()
                        bounds = [0, *cuts(piece, specials, leaf), len(piece)]
                        rows += [(h, no, lo, piece[lo:hi]) for lo, hi in zip(bounds, bounds[1:])]
                        no += 1
                if room:
                    rows.append((h, no, -1, b" ".join(room).decode()))
                for at in range(0, len(rows), 1024):
                    yield batch_of(schema, *zip(*rows[at : at + 1024]))

    def encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(path)
        for batch in batches:
            got = [encode_part(tok, t, 0, len(t)) for t in batch.column("_part").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([g.astype("<i8").tobytes() for g in got], pa.binary())],
                                             names=[*batch.schema.names, "_tokens"])

    def gather(rows):
        import pandas as pd

        tok = load(path)
        ids: list[np.ndarray] = []
        for _, piece in rows.sort_values(["_no", "_lo"]).groupby("_no", sort=True):
            parts = [np.frombuffer(t, "<i8").reshape(-1, 3).copy() for t in piece["_tokens"]]
            if len(parts) > 1:
                los = piece["_lo"].tolist()
                for p, lo in zip(parts, los):
                    p[:, 1:] += lo
                text = "".join(piece["_part"])
                parts = [join_tree(tok, text, parts, [*los, len(text)])]
            ids.append(parts[0][:, 0])
        flat = np.concatenate(ids).tolist() if ids else []
        return pd.DataFrame({"_h": [rows["_h"].iloc[0]], "ids": [pack(flat)], "decoded": [tok.decode(flat, skip_special_tokens=False)]})

    parts = texts.mapInArrow(split, "_h string, _no bigint, _lo bigint, _part string").repartition("_h", "_no", "_lo")
    parts = parts.mapInArrow(encode_rows, "_h string, _no bigint, _lo bigint, _part string, _tokens binary")
    # One group is one document: as large as its row, never larger.
    return parts.groupBy("_h").applyInPandas(gather, f"_h string, {ENCODED}")


@query("op3_bpe_round_trip")
def op3(t):
    """Digests of the ids and of the decoded text of every document."""
    out = encode(t.documents)
    return out.select("doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))

"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built.  A text is parsed greedily against each
automaton: a phrase is the longest match from where the last one ended.  The language whose automaton needs
the fewest phrases, each weighted with the bits of a pointer into its text, wins.

Texts are parsed in segments, all segments of a batch in step, so that one array operation advances every
segment by one character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regweave.llm.batches import slices
from regweave.llm.catalog import query

#: Bounds of the model: languages (most rows first), labelled rows and characters for each, characters of all.
LANGUAGES, ROWS, CHARACTERS, TOTAL = 1024, 200, 24_000, 400_000
#: Characters that are parsed in step; letters with a symbol of their own; symbols that all other letters are dealt to.
SEGMENT, SYMBOLS, SHARED = 128, 60, 64
BREAK = 0


def automaton(codes: list[int], symbols: int) -> np.ndarray:
    """Transitions (state x symbol, 0: none) of the suffix automaton of a code sequence; state 0 is the root."""
    nexts: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        now = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nexts[p]:
            nexts[p][c] = now
            p = link[p]
        if p != -1:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                clone = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nexts[p].get(c) == q:
                    nexts[p][c] = clone
                    p = link[p]
                link[q] = link[now] = clone
        last = now
    table = np.zeros((len(nexts), symbols), np.uint16 if len(nexts) < 1 << 16 else np.int32)
    for s, out in enumerate(nexts):
        for c, t in out.items():
            table[s, c] = t
    return table


@dataclass
class Model:
    """Automata of the languages over a common alphabet: a break, shared symbols, the most frequent letters."""

    languages: list[str]
    alphabet: str
    tables: list[np.ndarray]
    bits: list[float]

    def codes(self, text: str) -> np.ndarray:
        """Codes of a lower-cased text: letters by the alphabet, all else a break, runs of breaks as one."""
        points = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
        seen, back = (np.unique(points, return_inverse=True)) if len(points) < 400 or points.max(initial=0) >= 1 << 16 else (None, None)
        if seen is None:
            codes = self._table()[points]
        else:
            codes = np.array([self._code(int(p)) for p in seen], np.uint8)[back] if len(seen) else np.empty(0, np.uint8)
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != BREAK) | (codes[:-1] != BREAK)
        return codes[keep]

    def _code(self, point: int) -> int:
        c = chr(point)
        if c in self.alphabet:
            return self.alphabet.index(c) + 1 + SHARED
        # Letters beyond the alphabet share symbols by a hash, so texts of a script without any keep their letters apart.
        return 1 + (point * 2654435761 >> 16) % SHARED if c.isalpha() else BREAK

    def _table(self) -> np.ndarray:
        if not hasattr(self, "_known"):
            self._known = np.array([self._code(p) if not 0xD800 <= p < 0xE000 else BREAK for p in range(1 << 16)], np.uint8)
        return self._known

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score of each text; ``und`` and 0 for a text without a letter or a model without languages."""
        if not self.tables:
            return [("und", 0.0)] * len(texts)
        codes = [self.codes(t) for t in texts]
        letters = np.array([int((c != BREAK).any()) for c in codes], bool)
        counts = [-(-len(c) // SEGMENT) for c in codes]
        owner = np.repeat(np.arange(len(codes)), counts)
        pad = self.tables[0].shape[1] - 1
        grid = np.full((len(owner), SEGMENT), pad, np.uint8)
        at = 0
        for c, n in zip(codes, counts):
            grid[at : at + n].reshape(-1)[: len(c)] = c
            at += n
        steps = np.ascontiguousarray(grid.T)
        costs = np.empty((len(self.tables), len(codes)))
        for i, (table, bits) in enumerate(zip(self.tables, self.bits)):
            costs[i] = bits * np.bincount(owner, weights=phrases(table, steps), minlength=len(codes))
        order = np.argsort(costs, axis=0, kind="stable")
        best = costs[order[0], np.arange(len(codes))]
        second = costs[order[min(1, len(self.tables) - 1)], np.arange(len(codes))]
        score = np.where(best + second > 0, second / np.maximum(best + second, 1e-9), 0.0)
        return [(self.languages[o], float(s)) if k else ("und", 0.0) for o, s, k in zip(order[0], score, letters)]


def phrases(table: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Phrases of each column of ``steps`` (position x segment) in the greedy parse against one automaton."""
    symbols = table.shape[1]
    flat = table.reshape(-1)
    state = np.zeros(steps.shape[1], np.int64)
    begun = np.zeros(steps.shape[1], np.int32)
    for c in steps:
        nexts = flat.take(state * symbols + c).astype(np.int64)
        miss = np.flatnonzero((nexts == 0) & (c != symbols - 1))
        begun += (state == 0) & (c != symbols - 1)
        begun[miss] += state[miss] != 0
        nexts[miss] = flat.take(c[miss])  # a phrase begins: from the root, at which an unknown symbol ends it
        state = nexts
    return begun


def train(rows: list[tuple[str, str]], characters: int = CHARACTERS, symbols: int = SYMBOLS) -> Model:
    """Model of (language, text) rows: each row of a language gives an equal share of its characters, and each language one of all."""
    by: dict[str, list[str]] = {}
    for lang, text in rows:
        by.setdefault(lang, []).append(text)
    characters = min(characters, max(1, TOTAL // max(1, len(by))))
    counts: dict[str, int] = {}
    samples = {}
    for lang, texts in sorted(by.items()):
        share = max(1, characters // len(texts))
        sample = "\n".join(t[max(0, (len(t) - share) // 2) :][:share].lower() for t in sorted(texts))[:characters]
        samples[lang] = sample
        for c in set(sample):
            if c.isalpha():
                counts[c] = counts.get(c, 0) + sample.count(c)
    alphabet = "".join(sorted(sorted(counts, key=lambda c: (-counts[c], c))[:symbols]))
    model = Model(list(samples), alphabet, [], [])
    for sample in samples.values():
        codes = model.codes(sample).tolist()
        table = automaton(codes, len(alphabet) + SHARED + 2)
        table[:, -1] = np.arange(len(table))  # the padding symbol stays where it is
        model.tables.append(table)
        model.bits.append(float(np.log2(max(2, len(codes)))))
    return model


def held_out(id: str):
    """Rows that are never learned from: crc32 of the id as text divisible by 5 (null ids among them)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))), F.lit(5)) == 0


def sample(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = ROWS, languages: int = LANGUAGES) -> list[tuple[str, str]]:
    """The bounded training sample: per language the distinct texts with the smallest hashes, none held out."""
    known = docs.filter(~held_out(id) & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    known = known.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("_h"))
    counts = known.groupBy("lang").agg(F.count("*").alias("_n")).orderBy(F.desc("_n"), "lang").limit(languages)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("_h")) <= rows
    # Hashes first: the texts themselves are fetched only for the picked ones.
    picked = known.select("lang", "_h").distinct().join(counts.select("lang"), "lang")
    picked = picked.withColumn("_in", first).filter("_in").select("lang", "_h")
    limits = {r.lang: r.most for r in picked.groupBy("lang").agg(F.max("_h").alias("most")).collect()}
    if not limits:
        return []
    most = F.element_at(F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]), F.col("lang"))
    got = known.filter(F.col("_h") <= most).groupBy("lang", "_h").agg(F.min("text").alias("text")).orderBy("lang", "_h").collect()
    return [(r.lang, r.text) for r in got]


def fit(docs: DataFrame, **columns) -> Model:
    """Model of the labelled rows of ``docs`` that are not held out."""
    return train(sample(docs, **columns))


def predict(docs: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and a score from 0 to 1 (share of the runner-up's cost).

    Null texts, texts without a letter and an empty model give ``und`` and 0.  Ties go to the language first in
    order.  All rows and columns are kept; columns named as the two results are replaced.
    """
    docs = docs.drop(pred, score)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{pred}` string, `{score}` double"])
    # Bounded by the constants above: at most 2 TOTAL states.
    held = docs.sparkSession.sparkContext.broadcast((model.languages, model.alphabet, model.tables, model.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*held.value)
        for part, texts in slices(batches, text, rows=1024, size=1_000_000):
            got = model.predict([t.decode() for t in texts])
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())],
                                             names=[*part.schema.names, pred, score])

    return docs.mapInArrow(run, schema)


@query("op5_language_id")
def op5(t):
    """Predicted language of every document."""
    docs = t.documents
    return predict(docs.select("doc_id", "text", held_out("doc_id").alias("held_out")), fit(docs)).select("doc_id", "held_out", "lang_pred", "score")

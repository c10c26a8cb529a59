"""Toxicity by the nearest labelled examples.

1. A bounded, documented sample of labelled texts (``examples`` per class,
   drawn by a hash of the id) is joined to the texts and written once.  Every
   term of these texts -- words and the leading bytes of longer words -- is
   indexed, and every example is kept.
2. One pass over all texts counts the terms' document frequencies for the IDF.
   The IDF is multiplied by the distance of the term's smoothed log odds
   between the classes of the examples (a departure from plain TF-IDF, see the
   README); no term is left out by it.
3. The examples' vectors form a block-max inverted index: examples of like
   content are neighbours, ``BLOCK`` of them a block.  Postings of rare terms are
   summed for all examples; of terms that ``FREQUENT`` or more examples hold each
   block keeps the largest weight, which bounds what the block can reach.  Blocks
   are opened by falling bound, each for all texts of a batch that ask for it,
   until no bound reaches the k-th cosine found: the search is exact.
4. The neighbours vote with their cosines; a logistic curve, fitted on a
   second bounded sample of labelled rows, turns votes into probabilities.
   The neighbours (ids and cosines) are returned as evidence.

Defined results: a null or empty text, or one without a term of an example, has
no neighbours and gets the curve's value for no vote; an id with several
labels has their mean, rounded; null labels are ignored; without labels of
both classes every score is the share of label 1 (0 without any label).
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volspark.llm.common import PARTS, add_arrays, array_parts, fold, small, texts_of
from volspark.session import cut_lineage

#: Bytes of words as they are, all others blank.
LETTERS = bytes(c if c >= 0x80 or chr(c) in "abcdefghijklmnopqrstuvwxyz" else 0x20 for c in range(256))
STEMS = (4, 5, 6)
#: Terms in so many examples are summed by block, the others by postings.
FREQUENT = 400
#: Postings of the others stand in tables of rows so long, filled up with zeros.
LENGTHS = (2, 8, 32, 64, 128, 192, 256)
#: Examples in a block, and blocks opened before the first bound is compared.
BLOCK, FIRST = 64, 3
#: Texts, and about how many words, handled together; words remembered with their terms.
TOGETHER, WORDS, REMEMBERED = 200, 200_000, 400_000
SCHEMA = "doc_id long, score double, vote double, neighbours string"


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(LETTERS).split()


def terms_of(word: bytes) -> list[bytes]:
    """A word and its leading parts; these are marked by a final blank."""
    return [word, *[word[:n] + b" " for n in STEMS if len(word) > n]]


def sample_of(labels: DataFrame, label: str, held_out_mod: int, held_out: int, per_class: int, calibration: int):
    """Two disjoint bounded samples of ``doc_id, y``: examples, and rows to calibrate on."""
    known = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), held_out_mod) != held_out))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.round(F.avg(F.col(label).cast("double"))).cast("int").alias("y"))
        .withColumn("h", F.xxhash64("doc_id"))
    )
    for_index = known.filter(F.pmod("h", F.lit(4)) != 0)
    examples = None
    for y in (0, 1):
        part = for_index.filter(F.col("y") == y).orderBy("h", "doc_id").limit(per_class)
        examples = part if examples is None else examples.unionByName(part)
    rest = known.filter(F.pmod("h", F.lit(4)) == 0).orderBy("h", "doc_id").limit(calibration)
    return examples.select("doc_id", "y"), rest.select("doc_id", "y")


def class_terms(rows: DataFrame) -> dict[bytes, float]:
    """Every term of the examples ``text, y``, with the distance of its log
    odds between the classes; nothing if a class is missing."""

    def run(batches):
        seen = (Counter(), Counter())
        for b in small(batches):
            for text, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist()):
                seen[y].update({t for w in set(words_of(text)) for t in terms_of(w)})
        terms = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.binary()), *(pa.array([c[t] for t in terms], pa.int64()) for c in seen)], names=["term", "in0", "in1"])

    totals = {r.y: float(r.n) for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return {}
    got = rows.select("text", "y").mapInArrow(run, "term binary, in0 long, in1 long").groupBy("term").agg(F.sum("in0").alias("in0"), F.sum("in1").alias("in1")).toArrow()
    odds = [np.log((c + 0.5) / (totals[y] - c + 0.5)) for y, c in ((y, got[f"in{y}"].to_numpy()) for y in (0, 1))]
    return dict(sorted(zip(got["term"].to_pylist(), np.abs(odds[1] - odds[0]).tolist())))


class _WordTerms(dict):
    """Word -> number; the numbers of its terms stand in ``flat`` from
    ``ends[number]`` to ``ends[number + 1]``."""

    def __init__(self, at: dict[bytes, int]):
        super().__init__()
        self.number_of = at.get
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.flat, self.ends = array("q"), array("q", [0])

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        # the terms of terms_of, without a list of them: half of all words come once
        number_of, flat, n = self.number_of, self.flat, len(word)
        if (i := number_of(word)) is not None:
            flat.append(i)
        for stem in STEMS:
            if n > stem and (i := number_of(word[:stem] + b" ")) is not None:
                flat.append(i)
        self.ends.append(len(flat))
        return number


def count_terms(batches, at: dict[bytes, int]):
    """For slices of Arrow batches: the slice, and the rows, term numbers and
    counts of its texts, by row and term.  ``at`` numbers the terms."""
    known, width = _WordTerms(at), max(1, len(at))

    def cells(parts: list[np.ndarray]):
        ends, flat = np.frombuffer(known.ends, np.int64), np.frombuffer(known.flat, np.int64)
        word = np.concatenate(parts)
        row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        first, n = ends[word], ends[word + 1] - ends[word]
        key = flat[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))] if len(flat) else np.zeros(0, np.int64)
        key += np.repeat(row, n) * width
        key.sort()
        edge = np.flatnonzero(np.diff(key, prepend=-1))
        cell = key[edge]
        return cell // width, cell % width, np.diff(edge, append=len(key)).astype(float)

    for b in small(batches, TOGETHER):
        parts, done, held = [], 0, 0
        for i, text in enumerate(b.column("text").to_pylist()):
            words = words_of(text)
            parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
            held += len(words)
            if held >= WORDS or i + 1 == b.num_rows:
                yield b.slice(done, len(parts)), *cells(parts)
                parts, done, held = [], i + 1, 0
                if len(known) >= REMEMBERED:
                    known.clear()


def document_frequencies(texts: DataFrame, at: dict[bytes, int]) -> tuple[int, np.ndarray]:
    """The number of texts, and in how many of them each term occurs."""

    def run(batches):
        total = np.zeros(len(at) + 1)
        for b, _, term, _ in count_terms(batches, at):
            total += np.bincount(np.append(term, [len(at)] * b.num_rows), minlength=len(total))
        yield from array_parts(total, TaskContext.get().partitionId())

    parts = add_arrays(texts.select("text").mapInArrow(run, PARTS)).collect()
    total = np.concatenate([r["values"] for r in sorted(parts, key=lambda r: r.chunk)]) if parts else np.zeros(len(at) + 1)
    return int(total[-1]), total[:-1]


def vectors_of(texts: DataFrame, at: dict[bytes, int]) -> DataFrame:
    """``doc_id, y, terms, counts`` of each whole text."""

    def run(batches):
        for b, row, term, count in count_terms(batches, at):
            off = pa.array(np.searchsorted(row, np.arange(b.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(off, pa.array(x, pa.int32())) for x in (term, count.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), *lists], names=["doc_id", "y", "terms", "counts"])

    return texts.select("doc_id", "y", "text").mapInArrow(run, "doc_id long, y int, terms array<int>, counts array<int>")


class BlockMaxIndex:
    """Inverted index over the unit vectors of all examples, in blocks."""

    def __init__(self, idf: np.ndarray, examples: Iterable[tuple[int, int, list[int], list[int]]]):
        self.idf = idf
        units = [(doc, y, *self.unit(t, c)) for doc, y, t, c in examples]
        # examples of like content side by side: by the heaviest term that many of them hold
        held = np.bincount(np.concatenate([u[2] for u in units]), minlength=len(idf)) if units else np.zeros(len(idf))
        theme = [int(t[np.argmax(np.where(held[t] >= BLOCK // 4, w, 0))]) if len(t) else -1 for _, _, t, w in units]
        units = [units[i] for i in sorted(range(len(units)), key=lambda i: (units[i][1], theme[i], units[i][0]))]
        self.ids = np.array([e[0] for e in units], np.int64)
        self.y = np.array([e[1] for e in units], float)
        term = np.concatenate([e[2] for e in units]) if units else np.zeros(0, np.int64)
        weight = np.concatenate([e[3] for e in units]) if units else np.zeros(0)
        doc = np.repeat(np.arange(len(units), dtype=np.int32), [len(e[2]) for e in units])
        order = np.lexsort((doc, term))
        self._lay_out(np.searchsorted(term[order], np.arange(len(idf) + 1)), doc[order], weight[order])

    def _lay_out(self, start: np.ndarray, doc: np.ndarray, weight: np.ndarray) -> None:
        """Tables and blocks of the postings, sorted by term."""
        size = np.diff(start)
        self.frequent = np.flatnonzero(size >= FREQUENT)
        lengths = [*(n for n in LENGTHS if n < FREQUENT), FREQUENT]
        self.postings = start, doc, weight
        self.table, self.line, self.tables = np.searchsorted(lengths, size), np.zeros(len(size), np.int64), []
        for i, length in enumerate(lengths):
            terms = np.flatnonzero((self.table == i) & (size < FREQUENT))
            self.line[terms] = np.arange(len(terms))
            filled = np.arange(length) < size[terms, None]
            docs, weights = np.zeros(filled.shape, np.int32), np.zeros(filled.shape)
            into = (start[terms, None] + np.arange(length))[filled]
            docs[filled], weights[filled] = doc[into], weight[into]
            self.tables.append((docs, weights))
        self.column = np.full(len(size), -1, np.int64)
        self.column[self.frequent] = np.arange(len(self.frequent))
        self.blocks = -(-len(self.ids) // BLOCK)
        matrix = np.zeros((len(self.frequent), self.blocks * BLOCK))
        for i, t in enumerate(self.frequent):
            at = slice(start[t], start[t + 1])
            matrix[i, doc[at]] = weight[at]
        cube = matrix.reshape(len(self.frequent), self.blocks, BLOCK)
        self.top = cube.max(axis=2) if self.blocks else np.zeros((len(self.frequent), 0))
        self.cube = np.ascontiguousarray(cube.transpose(1, 0, 2))
        self.opened = self.asked = 0

    def __getstate__(self):
        """What travels to the tasks: the postings alone, laid out again there."""
        return self.idf, self.ids, self.y, self.postings

    def __setstate__(self, state):
        self.idf, self.ids, self.y, postings = state
        self._lay_out(*postings)

    def unit(self, terms, counts) -> tuple[np.ndarray, np.ndarray]:
        t = np.asarray(terms, np.int64)
        w = (1 + np.log(np.asarray(counts, float))) * self.idf[t]
        return t, w / max(np.sqrt((w**2).sum()), 1e-300)

    def nearest_of(self, rows: int, row: np.ndarray, term: np.ndarray, count: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per text, given by cells (row, term, count): examples and cosines of
        the exact k nearest (cosine above 0), ties to the smaller id."""
        none = np.zeros(0, np.int64), np.zeros(0)
        if not len(self.ids) or not len(term):
            return [none] * rows
        width = self.blocks * BLOCK
        w = (1 + np.log(count)) * self.idf[term]
        w = w / np.maximum(np.sqrt(np.bincount(row, w**2, rows)), 1e-300)[row]
        column = self.column[term]
        dense = column >= 0
        query = np.zeros((rows, len(self.frequent)))
        query[row[dense], column[dense]] = w[dense]
        rare = self._rare(rows, row[~dense], term[~dense], w[~dense]).reshape(rows, self.blocks, BLOCK)
        bound = rare.max(axis=2) + query @ self.top
        found, least, left = np.zeros_like(rare), np.zeros(rows), bound > 0
        place = np.argsort(np.argsort(-bound, axis=1), axis=1)
        for most in (FIRST, 5 * FIRST, self.blocks):  # the blocks of the largest bounds first
            go = left & (place < most) & (bound >= least[:, None] - 1e-11)
            for block in np.flatnonzero(go.any(axis=0)):
                some = np.flatnonzero(go[:, block])
                found[some, block] = rare[some, block] + query[some] @ self.cube[block]
            self.opened += int(go.sum())
            left &= ~go
            for i, (cos, low) in enumerate(zip(found.reshape(rows, width), least)):
                cos = cos[cos > low]
                if len(cos) >= k:
                    least[i] = np.partition(cos, len(cos) - k)[len(cos) - k]
        self.asked += rows * self.blocks
        return [self._best(cos, low, k) for cos, low in zip(found.reshape(rows, width), least)]

    def _rare(self, rows: int, row: np.ndarray, term: np.ndarray, w: np.ndarray) -> np.ndarray:
        """What the texts' rare terms add to each example's cosine."""
        out = np.zeros((rows, self.blocks * BLOCK))
        key = row * len(self.tables) + self.table[term]
        order = np.argsort(key, kind="stable")
        key, line, w = key[order], self.line[term[order]], w[order]
        edge = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)] if len(key) else [0]
        for i, j in zip(edge[:-1], edge[1:]):
            text, table = divmod(int(key[i]), len(self.tables))
            docs, weights = self.tables[table]
            part = weights.take(line[i:j], axis=0)
            part *= w[i:j, None]
            out[text] += np.bincount(docs.take(line[i:j], axis=0).ravel(), part.ravel(), out.shape[1])
        return out

    def _best(self, cos: np.ndarray, least: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        docs = np.flatnonzero((cos > 0) & (cos >= least - 1e-11))
        best = docs[np.lexsort((self.ids[docs], -cos[docs].round(12)))[:k]]
        return best, cos[best]

    def nearest(self, terms, counts, k: int) -> tuple[np.ndarray, np.ndarray]:
        t = np.asarray(terms, np.int64)
        return self.nearest_of(1, np.zeros(len(t), np.int64), t, np.asarray(counts, float), k)[0]


class Voter:
    """Distance-weighted vote and its calibration curve."""

    def __init__(self, index: BlockMaxIndex, k: int, prior: float):
        self.index, self.k, self.prior = index, k, prior
        self.coef: np.ndarray | None = None

    def votes(self, rows: int, row, term, count) -> list[tuple[list[float], str]]:
        out = []
        for (docs, cos), words in zip(self.index.nearest_of(rows, row, term, count, self.k), np.bincount(row, count, rows)):
            if not len(docs):
                out.append(([0.0, 0.0], ""))
                continue
            w = cos**2
            share = float((w * self.index.y[docs]).sum() / w.sum())
            toxic_mass = float(np.log1p(words)) * share
            out.append(([share, toxic_mass], ",".join(f"{self.index.ids[d]}:{int(self.index.y[d])}:{c:.4f}" for d, c in zip(docs, cos))))
        return out

    def calibrate(self, rows: list[tuple[list[float], int]], steps: int = 25, ridge: float = 0.1) -> None:
        """Logistic regression by Newton steps; a small ridge keeps it finite."""
        if not rows or len({y for _, y in rows}) < 2:
            return
        x = np.array([[1.0, *v] for v, _ in rows])
        y = np.array([float(y) for _, y in rows])
        b = np.zeros(x.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
            grad = x.T @ (y - p) - ridge * b
            b = b + np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(b)), grad)
        self.coef = b

    def probability(self, votes: list[float]) -> float:
        if self.coef is None:
            return self.prior if not votes[0] else votes[0]
        return float(1 / (1 + np.exp(-np.clip(self.coef @ np.array([1.0, *votes]), -30, 30))))


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", held_out_mod: int = 5, held_out: int = 0, examples: int = 2000, calibration: int = 10_000, k: int = 15) -> DataFrame:
    """``doc_id, score, vote, neighbours`` of every document."""
    texts = texts_of(docs)
    for_index, for_curve = sample_of(labels, label, held_out_mod, held_out, examples, calibration)
    sample = cut_lineage(for_index.withColumn("indexed", F.lit(True)).unionByName(for_curve.withColumn("indexed", F.lit(False))))
    labelled = cut_lineage(texts.join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"]))
    indexed = labelled.filter("indexed")
    odds = class_terms(indexed)
    at = {t: i for i, t in enumerate(odds)}
    n, df = document_frequencies(texts, at)
    idf = (np.log((n + 1) / (df + 1)) + 1) * np.array(list(odds.values()))
    rows = vectors_of(indexed, at).toArrow().sort_by("doc_id")
    prior = float(np.mean(rows["y"].to_numpy())) if rows.num_rows else 0.0
    voter = Voter(BlockMaxIndex(idf, zip(rows["doc_id"].to_pylist(), rows["y"].to_pylist(), *([v.values.to_numpy() for v in rows[c]] for c in ("terms", "counts")))), k, prior)

    def cast(batches):
        for b, *cells in count_terms(batches, at):
            votes = [v for v, _ in voter.votes(b.num_rows, *cells)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(votes, pa.list_(pa.float64()))], names=["doc_id", "y", "votes"])

    held = labelled.filter("NOT indexed").select("doc_id", "y", "text").mapInArrow(cast, "doc_id long, y int, votes array<double>").collect()
    voter.calibrate([(r.votes, r.y) for r in sorted(held, key=lambda r: r.doc_id)])

    def run(batches):
        for b, *cells in count_terms(batches, at):
            out = voter.votes(b.num_rows, *cells)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([voter.probability(v) for v, _ in out], pa.float64()), pa.array([v[0] for v, _ in out], pa.float64()), pa.array([e for _, e in out], pa.string())],
                names=["doc_id", "score", "vote", "neighbours"],
            )

    return texts.mapInArrow(run, SCHEMA)

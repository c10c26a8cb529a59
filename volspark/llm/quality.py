"""Quality classifier: histogram gradient-boosted trees over text statistics.

The trees are fitted on at most ``max_rows`` labelled rows (drawn by a hash of
the id; a parameter, so what reaches the driver is ``max_rows`` x 20 numbers),
whose ids are broadcast to pick their texts.  One pass over all whole texts
then computes the statistics and the score of every document: the trees are
flattened into arrays, over which a batch of rows is moved level by level.

Defined results: a null text is empty; an id with several labels has their
mean; null labels are ignored; without any labelled row every score is 0.5.
"""

from __future__ import annotations

import math
import zlib
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volspark.llm.common import fold, small, texts_of

FEATURES = (
    "log_bytes log_words word_length upper_share digit_share symbol_share pipe_share space_share newline_share high_share "
    "distinct_words repeated_next top_word bare_symbols symbol_tails repeated_lines line_words entropy longest_byte_share squeezed"
).split()

_CLASS = np.zeros(256, np.int64)  # 0 lower, 1 upper, 2 digit, 3 symbol, 4 pipe, 5 blank, 6 newline, 7 beyond ASCII
for _b in range(256):
    _ch = chr(_b)
    _CLASS[_b] = 7 if _b > 127 else 0 if _ch.islower() else 1 if _ch.isupper() else 2 if _ch.isdigit() else 4 if _ch == "|" else 6 if _ch == "\n" else 5 if _ch.isspace() else 3


def statistics(text: bytes) -> list[float]:
    n = len(text)
    if not n:
        return [0.0] * len(FEATURES)
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = np.bincount(_CLASS, weights=hist, minlength=8) / n
    p = hist[hist > 0] / n
    words = text.split()
    w = max(1, len(words))
    counts: dict[bytes, int] = {}
    for x in words:
        counts[x] = counts.get(x, 0) + 1
    lines = text.split(b"\n")
    first = set(lines)
    bare = sum(k for x, k in counts.items() if not x.isalnum() and not any(map(_is_word_byte, x)))
    tails = sum(k for x, k in counts.items() if len(x) > 2 and _CLASS[x[-1]] == 3 and _CLASS[x[-2]] == 3)
    return [
        math.log1p(n), math.log1p(len(words)), n / w, share[1], share[2], share[3], share[4], share[5], share[6], share[7],
        len(counts) / w, sum(map(eq, words, words[1:])) / w, max(counts.values(), default=0) / w, bare / w, tails / w,
        (sum(map(len, lines)) - sum(map(len, first))) / n, w / len(lines), float(-(p * np.log(p)).sum()), float(hist.max()) / n, len(zlib.compress(text, 1)) / n,
    ]


def _is_word_byte(b: int) -> bool:
    return _CLASS[b] in (0, 1, 2, 7)


def matrix(texts: pa.Array) -> np.ndarray:
    """Statistics of an Arrow column of texts; null is empty."""
    return np.array([statistics(t or b"") for t in texts.cast(pa.binary()).to_pylist()], dtype=float).reshape(len(texts), len(FEATURES))


class BoostedTrees:
    """Logistic boosting; all trees in five parallel arrays.  Node i of an
    inner level sends a row to ``left[i]`` if its feature is <= ``cut[i]``,
    else to ``left[i] + 1``; a leaf points to itself."""

    def __init__(self, base: float, feature, cut, left, value, roots, depth: int):
        self.base, self.feature, self.cut, self.left, self.value, self.roots, self.depth = base, feature, cut, left, value, roots, depth

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, trees: int = 100, depth: int = 4, rate: float = 0.15, bins: int = 64, least: float = 1.0, ridge: float = 1.0) -> "BoostedTrees":
        n, m = x.shape
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
        codes = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(m)], axis=1)
        rate_of = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        base = float(np.log(rate_of / (1 - rate_of)))
        margin = np.full(n, base)
        feature, cut, left, value, roots = [], [], [], [], []

        def add() -> int:
            feature.append(0), cut.append(np.inf), left.append(len(left)), value.append(0.0)
            return len(left) - 1

        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, np.maximum(p * (1 - p), 1e-9)
            root = add()
            roots.append(root)
            at = np.full(n, root)
            level = [root]
            for d in range(depth + 1):
                slot = {node: i for i, node in enumerate(level)}
                base_id = level[0]
                inside = at >= base_id
                rows = np.flatnonzero(inside) if not inside.all() else slice(None)
                where = at[rows] - base_id
                k = at.max() - base_id + 1 if len(at) else 1
                gs, hs = np.bincount(where, g[rows], minlength=k), np.bincount(where, h[rows], minlength=k)
                for node in level:
                    i = node - base_id
                    value[node] = -rate * gs[i] / (hs[i] + ridge)
                if d == depth:
                    break
                best = {node: (1e-6, None, None) for node in level}
                for j in range(m):
                    w = len(edges[j]) + 1
                    if w == 1:
                        continue
                    cell = where * w + codes[rows, j]
                    gh = np.bincount(cell, g[rows], minlength=k * w).reshape(k, w).cumsum(axis=1)[:, :-1]
                    hh = np.bincount(cell, h[rows], minlength=k * w).reshape(k, w).cumsum(axis=1)[:, :-1]
                    rest_g, rest_h = gs[:, None] - gh, hs[:, None] - hh
                    gain = gh**2 / (hh + ridge) + rest_g**2 / (rest_h + ridge) - (gs**2 / (hs + ridge))[:, None]
                    gain[(hh < least) | (rest_h < least)] = -1
                    split = gain.argmax(axis=1)
                    for node in level:
                        i = node - base_id
                        if gain[i, split[i]] > best[node][0]:
                            best[node] = (gain[i, split[i]], j, split[i])
                following = []
                for node in level:
                    _, j, s = best[node]
                    if j is None:
                        continue
                    a = add()
                    b = add()
                    feature[node], cut[node], left[node] = j, edges[j][s], a
                    mine = at == node
                    at[mine] = np.where(codes[mine, j] <= s, a, b)
                    following += [a, b]
                level = following
                if not level:
                    break
            margin += np.array(value)[at]
        arrays = (np.array(feature), np.array(cut), np.array(left), np.array(value), np.array(roots))
        return BoostedTrees(base, *arrays, depth)

    def probability(self, x: np.ndarray) -> np.ndarray:
        at = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            nxt = self.left[at]
            at = np.where(nxt == at, at, nxt + (x[row, self.feature[at]] > self.cut[at]))
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def train(docs: DataFrame, labels: DataFrame, label: str, held_out_mod: int = 5, held_out: int = 0, max_rows: int = 40_000) -> BoostedTrees | None:
    """Fit on the labelled rows outside the held-out fold, at most ``max_rows``."""
    known = (
        labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), held_out_mod) != held_out))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg(F.col(label).cast("double")).alias("y"))
    )
    drawn = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)

    def run(batches):
        for b in small(batches):
            x = matrix(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    rows = texts_of(docs).join(F.broadcast(drawn), "doc_id").mapInArrow(run, "doc_id long, y double, x array<double>")
    got = rows.toPandas().sort_values("doc_id", kind="stable").drop_duplicates("doc_id")
    return BoostedTrees.fit(np.stack(got["x"].to_numpy()), got["y"].to_numpy(float)) if len(got) else None


def probabilities(texts: pa.Array, model: BoostedTrees | None, step: int = 2000) -> np.ndarray:
    if model is None:
        return np.full(len(texts), 0.5)
    return np.concatenate([np.zeros(0), *(model.probability(matrix(texts[i : i + step])) for i in range(0, len(texts), step))])


def score(docs: DataFrame, model: BoostedTrees | None) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``."""

    def run(batches):
        for b in small(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(probabilities(b.column("text"), model), pa.float64())], names=["doc_id", "score"])

    return texts_of(docs).mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, model: BoostedTrees | None, least: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is ``least`` or more."""

    def run(batches):
        for b in small(batches):
            yield b.filter(pa.array(probabilities(b.column("text"), model) >= least))

    return docs.mapInArrow(run, docs.schema)

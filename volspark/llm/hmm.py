"""Language-model scoring with a hidden Markov model.

1. Tokens of all texts are counted (each task pre-aggregates, Spark sums by
   word), separately for training texts: ``c``, ``N`` and ``V`` are exact.
2. One pass replaces words by ids.  The ``head_words`` most frequent words
   travel to the tasks with their counts (a fixed bound); the other words of a
   text, each at most 1 / head_words of all tokens, get theirs by a join.
3. States emit the ``emission_words`` most frequent words, classes of the other
   words of training texts, and one symbol for all unseen words together (base
   weight 0.5).  A word's class is its crc32 modulo the number of classes, which
   grows with the vocabulary (``words_in_class`` words in each); within a class a
   word has probability proportional to c + 0.5, so the model is a proper
   distribution over the same token types as the unigram base.
4. Baum-Welch: every task adds up expected counts over all its training texts,
   each from its first to its last token, Spark adds the tasks' arrays by chunk,
   the driver normalises.
5. The scaled forward recursion, over whole texts, many texts side by side,
   gives the exact log likelihood.

Defined results: a null or empty text is the end token alone; rows with a null
id are training rows; a repeated id is scored row by row; without training
texts (N = 0) the base is log10(0.5 / 0.5) = 0 per token, and so is the score.
"""

from __future__ import annotations

import math
import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volspark.llm.common import PARTS, add_arrays, array_parts, fold, in_few, numbered, small, texts_of
from volspark.session import cut_lineage

END = b""  # no word is empty
#: About how many tokens a worker holds as Python objects at a time.
TOGETHER = 100_000
KEPT = ["doc_id", "held_out", "in_model", "in_rest", "n_known", "more"]


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lowered; bytes methods know ASCII only."""
    return text.lower().split()


def count_tokens(docs: DataFrame, flush: int = 400_000, together: int = TOGETHER) -> DataFrame:
    """``word, c, n``: occurrences in training texts and in all texts."""

    def run(batches):
        parts = []  # counts of slices: word, c, n

        def count(seen, kept):
            words, at = numbered(seen + kept)
            c = np.bincount(at[: len(seen)], minlength=len(words))
            parts.append(pa.table({"word": words.cast(pa.binary()), "c": c, "n": c + np.bincount(at[len(seen) :], minlength=len(words))}))

        def summed():
            got = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("c", "sum"), ("n", "sum")])
            return got.select(["word", "c_sum", "n_sum"]).rename_columns(["word", "c", "n"]).combine_chunks()

        seen, kept = [], []  # words of training texts, of the others
        for b in small(batches):
            for text, held in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("held_out").to_pylist()):
                into = kept if held else seen
                into += words_of(text)
                into.append(END)
                if len(seen) + len(kept) > together:
                    count(seen, kept)
                    seen, kept = [], []
                    if sum(p.num_rows for p in parts) > 2 * flush:
                        parts[:] = [summed()]
                        if parts[0].num_rows > flush:
                            yield from parts.pop().to_batches()
        count(seen, kept)
        yield from summed().to_batches()

    return docs.select("text", "held_out").mapInArrow(run, "word binary, c long, n long").groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, size: int) -> list[tuple[bytes, int]]:
    """``(word, c)`` of at most ``size`` words, the most frequent in all texts:
    those above a threshold that a coarse histogram of frequencies gives, so
    that no more than ``size`` rows reach the driver."""
    steps = F.floor(F.log2("n") * 32).cast("int")
    sizes = {r.s: r.k for r in counts.groupBy(steps.alias("s")).agg(F.count(F.lit(1)).alias("k")).collect()}
    least, held = None, 0
    for s in sorted(sizes, reverse=True):
        held += sizes[s]
        if held > size:
            break
        least = s
    if least is None:
        return []
    got = counts.filter(steps >= least).toArrow()
    rows = sorted(zip(got["n"].to_pylist(), got["word"].to_pylist(), got["c"].to_pylist()), key=lambda r: (-r[0], r[1]))
    return [(word, c) for _, word, c in rows]


def encode(docs: DataFrame, head: list[tuple[bytes, int]], emission_words: int, classes: int) -> DataFrame:
    """One row per text: symbols of its tokens (``emission_words``, or as many
    as there are, then ``classes``, then the unseen words), sums over its head
    words, and its other words with their places; these have the symbol of a
    class, also where no training text holds them.  ``key`` numbers the rows;
    the result is to be written before it is used."""
    place = {w: i for i, (w, _) in enumerate(head)}
    logs = np.array([math.log10(c + 0.5) for _, c in head] + [0.0])
    known = np.array([c > 0 for _, c in head] + [False], np.int64)
    emitted = min(emission_words, len(head))
    symbol = np.array([emitted + classes if not c else i if i < emitted else emitted + zlib.crc32(w) % classes for i, (w, c) in enumerate(head)] + [0], np.int32)

    def run(batches):
        part, row = TaskContext.get().partitionId(), 0
        far = len(head)
        for b in small(batches):
            keys, ids, in_model, in_rest, n_known, others, places = [], [], [], [], [], [], []
            for text in b.column("text").cast(pa.binary()).to_pylist():
                words = words_of(text)
                words.append(END)
                at = np.fromiter(map(place.get, words, repeat(far)), np.int64, len(words))
                rest = symbol[at] >= emitted
                lg = logs[at]
                keys.append((part << 33) + row)
                row += 1
                in_rest.append(float(lg[rest].sum()))
                in_model.append(float(lg.sum()) - in_rest[-1])
                n_known.append(int(known[at].sum()))
                places.append(np.flatnonzero(at == far).astype(np.int32))
                others.append([words[i] for i in places[-1]])
                ids.append(symbol[at])
                ids[-1][places[-1]] = [emitted + zlib.crc32(w) % classes for w in others[-1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), b.column("doc_id"), b.column("held_out"), pa.array([x.astype(np.int32).tobytes() for x in ids], pa.binary()), pa.array(in_model, pa.float64()), pa.array(in_rest, pa.float64()), pa.array(n_known, pa.int64()), pa.array(others, pa.list_(pa.binary())), pa.array(places, pa.list_(pa.int32()))],
                names=["key", "doc_id", "held_out", "ids", "in_model", "in_rest", "n_known", "others", "places"],
            )

    return docs.mapInArrow(run, "key long, doc_id long, held_out boolean, ids binary, in_model double, in_rest double, n_known long, others array<binary>, places array<int>")


def ragged(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flat values, starts and lengths of a column of integer lists, or of the
    bytes of 32-bit integers."""
    if pa.types.is_binary(column.type):
        off = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64) // 4
        flat = np.frombuffer(column.buffers()[2] or b"", np.int32)
    else:
        off, flat = column.offsets.to_numpy().astype(np.int64), column.values.to_numpy()
    return flat, off[:-1], np.diff(off)


class HiddenMarkov:
    """start (k), step (k x k), emit (symbols x k)."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.start, self.step, self.emit = start, step, emit

    @staticmethod
    def initial(unigram: np.ndarray, states: int, seed: int = 7, stay: float = 0.9) -> "HiddenMarkov":
        rng = np.random.default_rng(seed)
        noise = rng.normal(0, 1.0, (len(unigram), states)) if states > 1 else np.zeros((len(unigram), 1))
        emit = unigram[:, None] * np.exp(noise)
        step = np.full((states, states), (1 - stay) / max(1, states - 1))
        np.fill_diagonal(step, stay if states > 1 else 1.0)
        return HiddenMarkov(np.full(states, 1 / states), step, emit / emit.sum(axis=0))

    def log10_likelihood(self, flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Scaled forward recursion over ragged sequences, long ones first."""
        out = np.zeros(len(start))
        order = np.argsort(-length, kind="stable")
        s, n = start[order], length[order]
        total, a = np.zeros(len(s)), None
        active = np.searchsorted(-n, -np.arange(n[0] if len(n) else 0), side="left")  # sequences longer than t
        for t, m in enumerate(active):
            e = self.emit[flat[s[:m] + t]]
            a = self.start * e if a is None else (a[:m] @ self.step) * e
            c = a.sum(axis=1)
            a /= c[:, None]
            total[:m] += np.log10(c)
        out[order] = total
        return out

    def expected(self, flat: np.ndarray, start: np.ndarray, length: np.ndarray, into: tuple[np.ndarray, np.ndarray, np.ndarray]) -> float:
        """Adds expected counts (start, step, emit) of the sequences; returns
        their natural log likelihood.  All arrays are time-major: step t holds
        the sequences longer than t."""
        order = np.argsort(-length, kind="stable")
        s, n = start[order], length[order]
        if not len(n) or not n[0]:
            return 0.0
        k, step32 = len(self.start), self.step.astype(np.float32)
        active = np.searchsorted(-n, -np.arange(n[0]), side="left")
        off = np.concatenate([[0], np.cumsum(active)])
        symbols = np.empty(off[-1], np.int64)
        for t, m in enumerate(active):
            symbols[off[t] : off[t + 1]] = flat[s[:m] + t]
        e = self.emit.astype(np.float32)[symbols]
        alpha, scale = np.empty_like(e), np.empty(off[-1], np.float32)
        a = self.start.astype(np.float32) * e[: active[0]]
        for t, m in enumerate(active):
            now = slice(off[t], off[t + 1])
            if t:
                a = alpha[off[t - 1] : off[t - 1] + m] @ step32
                a *= e[now]
            c = a.sum(axis=1)
            scale[now] = c
            np.divide(a, c[:, None], out=alpha[now])
        # backwards: e becomes what is carried into a step, later what is carried out is 1 or its sum
        e /= scale[:, None]
        later, back = np.ones_like(e), np.ascontiguousarray(step32.T)
        for t in range(len(active) - 1, 0, -1):
            now, m = slice(off[t], off[t + 1]), active[t]
            np.multiply(e[now], later[now], out=e[now])
            np.matmul(e[now], back, out=later[off[t - 1] : off[t - 1] + m])
        pairs = np.zeros((k, k))
        before = np.arange(off[1], off[-1]) - np.repeat(active[:-1], active[1:])
        for i in range(0, len(before), 65_536):
            pairs += alpha[before[i : i + 65_536]].T.astype(np.float64) @ e[off[1] + i : off[1] + i + len(before[i : i + 65_536])]
        gamma = alpha
        gamma *= later  # the state posteriors
        into[0][:] += gamma[: active[0]].sum(axis=0, dtype=np.float64)
        into[1][:] += pairs * self.step
        width = into[2].shape[0]
        for j in range(k):
            into[2][:, j] += np.bincount(symbols, gamma[:, j], minlength=width)
        return float(np.log(scale.astype(np.float64)).sum())


def baum_welch(encoded: DataFrame, model: HiddenMarkov, prior: np.ndarray, rounds: int, segment: int, batch_tokens: int = 1_000_000) -> tuple[HiddenMarkov, list[float]]:
    """``rounds`` of re-estimation over all rows of ``encoded``; ``prior`` holds
    pseudo-counts per symbol.  Texts are never cut; those longer than ``segment``
    only share batches apart from the others.  Returns the model and each round's
    log likelihood."""
    k, width, history = len(model.start), model.emit.shape[0], []

    for _ in range(rounds):

        def run(batches, model=model):
            into = (np.zeros(k), np.zeros((k, k)), np.zeros((width, k)))
            like = 0.0
            for b in batches:
                flat, start, length = ragged(b.column("ids"))
                order = np.argsort(-length, kind="stable")  # texts of like length share a batch
                s, n = start[order], length[order]
                edges = np.searchsorted(np.cumsum(n), np.arange(0, n.sum() + batch_tokens, batch_tokens))
                edges = np.unique([*edges, int((n > segment).sum()), len(n)])
                for i, j in zip(edges[:-1], edges[1:]):
                    like += model.expected(flat, s[i:j], n[i:j], into)
            every = np.concatenate([[like], into[0], into[1].ravel(), into[2].ravel()])
            task = TaskContext.get().partitionId()
            yield from array_parts(every, task)

        sums = add_arrays(in_few(encoded.select("ids")).mapInArrow(run, PARTS)).collect()
        if not sums:
            break
        every = np.concatenate([r["values"] for r in sorted(sums, key=lambda r: r.chunk)])
        history.append(float(every[0]))
        start, step, emit = every[1 : 1 + k] + 1, every[1 + k : 1 + k + k * k].reshape(k, k) + 1, every[1 + k + k * k :].reshape(width, k) + prior[:, None]
        model = HiddenMarkov(start / start.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    return model, history


def score(docs: DataFrame, held_out_mod: int = 5, held_out: int = 1, states: int = 8, rounds: int = 6, head_words: int = 262_144, emission_words: int = 16_384, segment: int = 512, words_in_class: int = 64) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per document."""
    texts = texts_of(docs).withColumn("held_out", fold(F.col("doc_id"), held_out_mod) == held_out)
    counts = cut_lineage(count_tokens(texts))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    head = most_frequent(counts, head_words)
    emitted = min(emission_words, len(head))
    classes = max(1, -(-total.v // words_in_class))
    encoded = cut_lineage(encode(texts, head, emission_words, classes))

    # symbols: the emitted words, the classes of the other words, the unseen words
    rest = np.zeros(classes)
    by_class = counts.filter("c > 0").groupBy((F.crc32("word") % classes).cast("int").alias("class")).agg(F.sum(F.col("c") + F.lit(0.5)).alias("mass")).toArrow()
    rest[by_class["class"].to_numpy()] = by_class["mass"].to_numpy()
    for w, c in head[:emitted]:
        if c:
            rest[zlib.crc32(w) % classes] -= c + 0.5  # halves: no rounding
    symbols = np.concatenate([[c + 0.5 if c else 0.0 for _, c in head[:emitted]], rest, [0.5]])
    mass = total.n + 0.5 * (total.v + 1)
    unigram = symbols / symbols.sum()
    scorer, _ = baum_welch(encoded.filter(~F.col("held_out")), HiddenMarkov.initial(unigram, states), 20 * unigram, rounds, segment)
    unseen = emitted + classes
    class_logs = np.log10(np.where(symbols > 0, symbols, 1.0))
    class_logs[:emitted] = 0.0

    looked = encoded.select("key", F.explode(F.arrays_zip("others", "places")).alias("o")).select("key", F.col("o.others").alias("word"), F.col("o.places").alias("place")).join(counts.select("word", "c"), "word", "left")
    is_known = F.coalesce("c", F.lit(0)) > 0
    per_text = looked.groupBy("key").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.5))).alias("more_logs"), F.sum(F.when(is_known, 1).otherwise(0)).alias("more_known"),
        F.collect_list(F.when(~is_known, F.col("place"))).alias("unseen"),
    )

    def run(batches):
        for b in batches:
            flat, start, length = ragged(b.column("ids"))
            places = b.column("unseen")
            flat = flat.copy()
            flat[np.repeat(start, np.diff(places.offsets.to_numpy())) + places.flatten().to_numpy()] = unseen
            off = np.concatenate([[0], np.cumsum(class_logs[flat])])
            rest_logs = off[start + length] - off[start]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in KEPT), pa.array(length), pa.array(scorer.log10_likelihood(flat, start, length) - rest_logs)],
                names=[*KEPT, "n_tokens", "forward"],
            )

    more = F.coalesce("more_logs", F.lit(0.0))
    joined = encoded.drop("others", "places").join(per_text, "key", "left")
    forward = joined.select(
        "doc_id", "held_out", "in_model", "in_rest", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), more.alias("more"),
        "ids", F.coalesce("unseen", F.array().cast("array<int>")).alias("unseen"),
    ).mapInArrow(run, "doc_id long, held_out boolean, in_model double, in_rest double, n_known long, more double, n_tokens long, forward double")
    return forward.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total.n).cast("long").alias("train_tokens"),
        (F.col("in_model") + F.col("in_rest") + F.col("more") - F.col("n_tokens") * math.log10(mass)).alias("base_score"),
        (F.col("forward") + F.col("in_rest") + F.col("more")).alias("score"),
    )

"""Runs of periodically repeated words, found on scale tiles and stitched.

A run is a stretch of words with smallest period q (words q apart are equal),
at least ``shortest`` and 2 q long, that no neighbouring word extends.  The
words after the first q of a run are repetitions; collapsing drops them.

In terms of matches -- position i matches at distance p if word i equals word
i + p -- a run of period p is a maximal interval of at least
max(p, shortest - p) consecutive matches.  Periods are dealt with by octave:
an octave of periods [low, high) has boundaries at every multiple of ``step``,
no more than the least interval, so that each run's interval holds a boundary.

1. Every text is exploded into overlapping tiles per octave: some boundaries
and the words up to ``step`` before and ``step + high`` after each.  Boundaries
whose surroundings hold no repeated word group (of the least number of matches)
closer than ``high`` cannot lie in a run and are left out.
2. Tiles are dealt out and solved alone.  At a boundary b the Z-function of the
words from b on gives the matches from b rightwards at every distance, the
Z-function of the reversed words those leftwards: for each period one interval
fragment.  A fragment whose words have a period that divides p belongs to a run
of that smaller period and is dropped.
3. Fragments are shuffled by document and period and stitched where they touch;
intervals that are long enough are the runs.

Defined results: a null text is empty and has no runs and an empty collapsed
text; a null id stays null; rows are taken one by one, also repeated ones;
words are compared whole and as they are; very long texts are spread over tasks
by tile; other columns are ignored; of an empty table the result is empty.
"""

from __future__ import annotations

import hashlib
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from volspark.llm.common import small, texts_of
from volspark.session import cut_lineage

TILE_WORDS = 2048
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def octaves(n: int, shortest: int = 12):
    """(low, high, step): periods [low, high) and the distance of boundaries."""
    first = max(2, 2 * (shortest // 3))
    yield 1, first, (shortest + 1) // 2
    low = first
    while 2 * low <= n:
        yield low, 2 * low, low
        low *= 2


def repeated_groups(ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Consecutive places of equal groups of ``size`` words: (earlier, later)."""
    n = len(ids) - size + 1
    if n < 2:
        return np.zeros(0, int), np.zeros(0, int)
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.uint64)
        for k in range(size):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + ids[k : n + k].astype(np.uint64)
    at = np.argsort(h, kind="stable")
    same = np.flatnonzero(h[at][1:] == h[at][:-1])
    return at[same], at[same + 1]


def boundaries(n: int, high: int, step: int, earlier: np.ndarray, later: np.ndarray, size: int) -> np.ndarray:
    """Multiples of ``step`` with a repeated group, closer than ``high``, among
    the words from ``step`` before to ``step + high`` after."""
    near = later - earlier < high
    first = np.maximum(0, -(-(later[near] + size - high) // step) - 1)
    last = np.minimum((earlier[near] + step) // step, (n - 1) // step)
    marks = np.zeros((n - 1) // step + 2, np.int64)
    np.add.at(marks, first[first <= last], 1)
    np.add.at(marks, last[first <= last] + 1, -1)
    return np.flatnonzero(np.cumsum(marks)[:-1] > 0) * step


def tiles(ids: np.ndarray, shortest: int = 12):
    """(low, high, step, place of the first word, boundaries, words) of each tile."""
    size = (shortest + 1) // 2
    earlier, later = repeated_groups(ids, size)
    if not len(earlier):
        return
    for low, high, step in octaves(len(ids), shortest):
        kept = boundaries(len(ids), high, step, earlier, later, size)
        if len(kept):
            new = np.flatnonzero(np.diff(kept // max(step, TILE_WORDS), prepend=-1))
            for some in np.split(kept, new[1:]):
                at = max(0, int(some[0]) - step)
                yield low, high, step, at, some - at, ids[at : int(some[-1]) + step + high]


def z_function(s: list, upto: int) -> list:
    """Length of the longest common prefix of ``s`` and ``s[i:]``, i < upto."""
    n = len(s)
    z = [0] * upto
    left = right = 0
    for i in range(1, min(upto, n)):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        left, right = i, i + k
    return z


def prime_factors(p: int) -> list[int]:
    out, f = [], 2
    while f * f <= p:
        if p % f == 0:
            out.append(f)
            while p % f == 0:
                p //= f
        f += 1
    return out + [p] if p > 1 else out


def solve(low: int, high: int, step: int, bounds: list[int], words: list) -> dict[int, list[list[int]]]:
    """By period: intervals of matches through the boundaries, those that touch
    united, as places in the tile."""
    found: dict[int, list[list[int]]] = {}
    for b in bounds:
        start, stop = max(0, b - step), min(len(words), b + step + high)
        top = min(high, stop - b)
        if top <= low:
            continue
        right = z_function(words[b:stop], top)
        before = words[start:b][::-1]
        # before + [a word that is nowhere] + words from b + top - 2 back to start
        back = z_function(before + [-1] + words[start : b + top - 1][::-1], len(before) + top)
        left = [0] + back[::-1]  # left[p]: at the place of word b + p - 1
        for p in range(low, top):
            if right[p] + left[p] < step:
                continue
            l, r = left[p], right[p]
            if any(right[q] >= r + p - q and left[q] >= l for q in (p // f for f in prime_factors(p))):
                continue
            intervals = found.setdefault(p, [])
            if intervals and b - l <= intervals[-1][1]:
                intervals[-1][1] = max(intervals[-1][1], b + r)
            else:
                intervals.append([b - l, b + r])
    return found


ROWS = "row long, doc_id long, text binary, low int, high int, step int, at long, bounds binary, words binary"


def exploded(texts: DataFrame, shortest: int, digest: bool) -> DataFrame:
    """Rows of two kinds.  One per text, ``low`` null: its words joined by a
    blank, or their SHA-256 if ``digest`` and it has no tiles; ``high`` is the
    number of its tiles.  One per tile."""

    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        for b in small(batches, 200):
            out: list[tuple] = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
                row, number = (task << 33) + number, number + 1
                words = text.split()
                table = dict(zip(dict.fromkeys(words), count()))
                ids = np.fromiter(map(table.__getitem__, words), np.int32, len(words))
                n = 0
                if len(table) < len(words) >= shortest:
                    for n, (low, high, step, at, bounds, part) in enumerate(tiles(ids, shortest), 1):
                        out.append((row, None, None, low, high, step, at, bounds.astype(np.int32).tobytes(), part.tobytes()))
                joined = b" ".join(words)
                out.append((row, doc, hashlib.sha256(joined).hexdigest().encode() if digest and not n else joined, None, n, None, None, None, None))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
            names = [c.split()[0] for c in ROWS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return texts.mapInArrow(run, ROWS)


def fragments(parts: DataFrame) -> DataFrame:
    """``row, period, a, z``: intervals [a, z) of matches found on the tiles."""

    def run(batches):
        for b in small(batches, 500):
            out = []
            for row, low, high, step, at, bounds, words in zip(*(b.column(c).to_pylist() for c in ("row", "low", "high", "step", "at", "bounds", "words"))):
                found = solve(low, high, step, np.frombuffer(bounds, np.int32).tolist(), np.frombuffer(words, np.int32).tolist())
                out += [(row, p, at + a, at + z) for p, intervals in found.items() for a, z in intervals]
            columns = zip(*out) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["row", "period", "a", "z"])

    dealt = parts.repartition("row", "low", "at")
    return dealt.mapInArrow(run, "row long, period long, a long, z long")


def stitched(found: DataFrame, shortest: int) -> DataFrame:
    """``row, runs``: fragments of a row and period united where they touch,
    the long enough ones as (start, length, period) by start and period."""
    order = Window.partitionBy("row", "period").orderBy("a", "z")
    seen = F.max("z").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = found.withColumn("new", F.when(F.col("a") <= seen, 0).otherwise(1))
    island = F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    whole = marked.withColumn("island", island).groupBy("row", "period", "island").agg(F.min("a").alias("a"), F.max("z").alias("z"))
    runs = whole.filter(F.col("z") - F.col("a") >= F.greatest("period", F.lit(shortest) - F.col("period")))
    run = F.struct(F.col("a").alias("start"), (F.col("z") - F.col("a") + F.col("period")).alias("length"), "period")
    by_place = lambda x, y: F.when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1).when(x["period"] < y["period"], -1).otherwise(1)
    return runs.groupBy("row").agg(F.array_sort(F.collect_list(run), by_place).alias("runs"))


def find(docs: DataFrame, shortest: int = 12, digest: bool = False) -> DataFrame:
    """``doc_id, runs, collapsed`` of every row: its runs by start and period,
    and its words without repetitions, joined by one blank -- or, if ``digest``,
    the hexadecimal SHA-256 of that text, which saves writing the texts."""
    rows = cut_lineage(exploded(texts_of(docs), shortest, digest))
    runs = stitched(fragments(rows.filter(F.col("low").isNotNull())), shortest)
    texts = rows.filter(F.col("low").isNull()).select("row", "doc_id", "text", F.col("high").alias("tiles"))

    def collapse(batches):
        for b in small(batches, 200):
            out = []
            for text, starts, lengths, periods in zip(*(b.column(c).to_pylist() for c in ("text", "starts", "lengths", "periods"))):
                if starts:
                    words = text.split(b" ")
                    keep = np.ones(len(words), bool)
                    for s, n, p in zip(starts, lengths, periods):
                        keep[s + p : s + n] = False
                    text = b" ".join([words[i] for i in np.flatnonzero(keep)])
                out.append(hashlib.sha256(text).hexdigest().encode() if digest else text)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("runs"), pa.array(out, pa.binary())], names=["doc_id", "runs", "collapsed"])

    none = F.lit([]).cast(RUNS)
    tiled = texts.filter("tiles > 0").join(runs, "row", "left").withColumn("runs", F.coalesce("runs", none))
    tiled = tiled.select("doc_id", "text", "runs", *[F.col(f"runs.{c}").alias(f"{c}s") for c in ("start", "length", "period")])
    done = texts.filter("tiles = 0").select("doc_id", none.alias("runs"), F.col("text").alias("collapsed"))
    both = done.unionByName(tiled.mapInArrow(collapse, f"doc_id long, runs {RUNS}, collapsed binary"))
    return both.select("doc_id", "runs", F.col("collapsed").cast("string").alias("collapsed"))

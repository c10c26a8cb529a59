"""Near-duplicate groups by exact Jaccard similarity of 5-word shingles.

A document is a point: its shingles are hashed into ``GROUPS`` groups and the
group counts are its coordinates.  The shingles that two documents share number
at most the sum of the coordinate minima, so an R-tree over the points (leaves
and inner nodes hold coordinate maxima and the least and largest set size)
prunes pairs of boxes, then of points; the pairs left are verified on the sets.

Such bounds prune within a neighbourhood, but hashed counts of unrelated long
texts are much alike, so one tree over a corpus would prune little.  The points
are therefore first dealt to cells: two sets with J >= 3/4 share one of the
first ``n - ceil(3n/4) + 1`` shingles of each in any fixed order (here: by a
sketch of corpus frequencies, rare ones first, then by hash), and each such
shingle is a cell with a tree of its own.  Cells of frequent shingles are split
by salt.  Nothing is dropped: the result is exact up to collisions of 64-bit
shingle hashes within a pair.

Steps: 1. set sizes, digests, points and the frequency sketch; 2. cells with
two or more documents, one for each set of documents; 3. neighbours in the leaf
order of each tree are verified and joined into components, so a group of M
near copies costs about M pairs; 4. in cells that still hold several components
each document's most promising partner in another one is tried, then all pairs
between components go through the tree; survivors are verified.
Pairs are tested with a finer point before their sets are made.  Documents with
equal sets are one point throughout.

Defined results: null or empty texts and texts without words have an empty set
and link with nothing; fewer than five words are one shingle; rows with a null
id link with nothing and have component null; rows that share an id are one
node, linked by whatever any of them is linked by (rows without words keep
their own id); other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volspark.llm.common import PARTS, add_arrays, array_parts, join_groups, small, texts_of
from volspark.session import cut_lineage

WORDS = 5
GROUPS = 64
SKETCH_BITS = 18
CELL = 4096
LEAF = 16
MULT = np.uint64(0x9E3779B97F4A7C15)
UNBOUNDED = np.int32(2**31 - 1)


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word 5-grams of a lower-cased text."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        if len(h) < WORDS:
            out = np.array([len(h)], np.uint64)
            for x in h:
                out = (out ^ x) * MULT
                out ^= out >> np.uint64(29)
        else:
            out = h[: len(h) - WORDS + 1].copy()
            for i in range(1, WORDS):
                out = (out ^ (out >> np.uint64(32))) * MULT + h[i : len(h) - WORDS + 1 + i]
        out = (out ^ (out >> np.uint64(31))) * MULT
    return np.unique(out ^ (out >> np.uint64(30)))


def point(s: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    return np.bincount((s & np.uint64(groups - 1)).astype(np.int64), minlength=groups)


def packed(counts: np.ndarray, kind) -> bytes:
    """Counts in a small integer type, whose largest value means 'unbounded'."""
    return np.minimum(counts, np.iinfo(kind).max).astype(kind).tobytes()


def unpacked(blob: bytes, kind) -> np.ndarray:
    x = np.frombuffer(blob, kind)
    return np.where(x == np.iinfo(kind).max, UNBOUNDED, x.astype(np.int32))


def fine_groups(n: int) -> int:
    """Groups of the second, finer point of a set: two to four members each."""
    return max(GROUPS, 1 << max(0, (n // 2).bit_length() - 1))


def enough(shared, a, b):
    """100 * shared >= 75 * union, in integers."""
    return 7 * shared >= 3 * (a + b)


def sets_and_sketch(texts: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """``doc_id, n, set_key`` and two points (coarse and fine) of each text, and
    counts of all sets' shingles by the upper SKETCH_BITS of their hash."""

    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in small(batches):
            n, keys, coarse, fine, slots = [], [], [], [], [np.zeros(0, np.int64)]
            for t in b.column("text").cast(pa.binary()).to_pylist():
                s = shingles(t)
                n.append(len(s))
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest())
                coarse.append(packed(point(s), np.uint16))
                fine.append(packed(point(s, fine_groups(len(s))), np.uint8))
                slots.append((s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64))
                if len(slots) == 1000:
                    total += np.bincount(np.concatenate(slots), minlength=1 << SKETCH_BITS)
                    slots = slots[:1]
            total += np.bincount(np.concatenate(slots), minlength=1 << SKETCH_BITS)
            none = [None] * len(n)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.string()), pa.array(coarse, pa.binary()), pa.array(fine, pa.binary()), pa.array(none, pa.int32()), pa.array(none, pa.int32()), pa.array(none, pa.list_(pa.float64()))], names=names)
        for part in array_parts(total, TaskContext.get().partitionId()):
            none = [None] * part.num_rows
            yield pa.RecordBatch.from_arrays([*[pa.array(none, kind) for kind in (pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary())], *part.columns], names=names)

    names = ["doc_id", "n", "set_key", "x", "fine", "chunk", "task", "values"]
    found = cut_lineage(texts.mapInArrow(run, f"doc_id long, n long, set_key string, x binary, fine binary, {PARTS}"))
    parts = add_arrays(found.filter(F.col("chunk").isNotNull()).select("chunk", "task", "values")).collect()
    counts = np.concatenate([r["values"] for r in sorted(parts, key=lambda r: r.chunk)]) if parts else np.zeros(1 << SKETCH_BITS)
    return found.filter(F.col("chunk").isNull()).select("doc_id", "n", "set_key", "x", "fine"), counts


class Order:
    """A fixed order of all shingles: unremarkable ones first, then by how far
    their sketch count lies above the mean, in steps of a factor of two."""

    def __init__(self, counts: np.ndarray):
        mean = counts.mean()
        noise = 4 * np.sqrt(mean) + 8  # the spread of a count of many rare shingles
        excess = np.maximum(counts - mean - noise, 0)
        self.level = np.minimum(np.ceil(np.log2(excess / noise + 1)), 60).astype(np.uint64)
        self.salts = np.maximum(1, np.ceil(excess / CELL)).astype(np.int32)

    def prefix(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The leading shingles, in order, of which a set with J >= 3/4 shares one; their salts."""
        n = len(s)
        size = n - -(-3 * n // 4) + 1
        slot = (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)
        rank = (self.level[slot] << np.uint64(58)) | (((s * MULT) >> np.uint64(6)))
        at = np.argpartition(rank, size - 1)[:size] if size < n else np.arange(n)
        at = at[np.argsort(rank[at])]
        return s[at], self.salts[slot[at]]


def cells(texts: DataFrame, order: Order, postings: int, shuffles: int) -> DataFrame:
    """``key, salt, salts, doc, n, pos``: the cells with at least two rows; pos
    counts the shingles of the row before ``key`` in the order."""
    buckets = max(shuffles, -(-postings // 1_000_000))
    kinds = {"keys": np.int64, "salt": np.int32, "salts": np.int32, "docs": np.int64, "n": np.int32, "pos": np.int32}

    def deal(batches):
        for b in small(batches, 2000):
            rows = []
            for doc, t in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
                s = shingles(t)
                if len(s):
                    k, m = order.prefix(s)
                    rows.append((k, m, np.full(len(k), doc, np.int64), np.full(len(k), len(s), np.int32), np.arange(len(k), dtype=np.int32)))
            if not rows:
                continue
            k, m, d, n, pos = (np.concatenate(x) for x in zip(*rows))
            with np.errstate(over="ignore"):
                salt = (((d.astype(np.uint64) + np.uint64(1)) * MULT >> np.uint64(33)).astype(np.int64) % m).astype(np.int32)
                bucket = ((((k ^ (salt.astype(np.uint64) << np.uint64(40))) * MULT) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
            at = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[at], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(cut))
            blob = lambda x: pa.array([x[at[cut[i] : cut[i + 1]]].tobytes() for i in full], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *map(blob, (k, salt, m, d, n, pos))], names=["bucket", *kinds])

    def shared(t: pa.Table) -> pa.Table:
        k, salt, m, d, n, pos = (np.frombuffer(b"".join(t[c].to_pylist()), kind) for c, kind in kinds.items())
        at = np.lexsort((pos, n, d, salt, k))
        again = (k[at][1:] == k[at][:-1]) & (d[at][1:] == d[at][:-1]) & (n[at][1:] == n[at][:-1]) & (pos[at][1:] == pos[at][:-1])
        at = at[np.r_[True, ~again]]  # rows that repeat an id and a text
        new = np.r_[True, (k[at][1:] != k[at][:-1]) | (salt[at][1:] != salt[at][:-1])]
        size = np.diff(np.r_[np.flatnonzero(new), len(at)])
        # a salted cell may meet its rows in the cells of the other salts
        at = at[(np.repeat(size, size) > 1) | (m[at] > 1)]
        return pa.table({"key": pa.array(k[at], pa.int64()), "salt": pa.array(salt[at], pa.int32()), "salts": pa.array(m[at], pa.int32()), "doc": pa.array(d[at], pa.int64()), "n": pa.array(n[at], pa.int64()), "pos": pa.array(pos[at], pa.int32())})

    blobs = texts.mapInArrow(deal, "bucket int, keys binary, salt binary, salts binary, docs binary, n binary, pos binary")
    return blobs.groupBy("bucket").applyInArrow(shared, "key long, salt int, salts int, doc long, n long, pos int")


def distinct_cells(held: DataFrame) -> DataFrame:
    """The rows of one cell for each set of two or more documents.  The shingles
    of a shared passage are cells with the same documents; the first of them
    in the order sees every pair at its first common shingle among them.
    Split cells are all kept."""
    about = held.groupBy("key").agg(
        F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.max("salts").alias("salts"), F.count(F.lit(1)).alias("rows"), F.min("pos").alias("pos"),
        F.bit_xor(F.xxhash64(F.lit(1), "doc", "n")).alias("h1"), F.bit_xor(F.xxhash64(F.lit(2), "n", "doc")).alias("h2"),
    ).filter("lo < hi")
    same = F.when(F.col("salts") > 1, F.col("key"))  # null but for split cells
    first = about.groupBy("h1", "h2", "rows", same.alias("same")).agg(F.min(F.struct("pos", "key")).alias("c")).select("c.key")
    return held.join(first, "key", "left_semi")


class Tree:
    """Packed R-tree over points of one cell, by set size and then position."""

    def __init__(self, n: np.ndarray, x: np.ndarray):
        peak = x.argmax(axis=1) if len(x) else np.zeros(0, int)
        self.at = np.lexsort((x[np.arange(len(x)), peak], peak, n)) if len(x) else np.zeros(0, int)
        self.levels = [(n[self.at], n[self.at], x[self.at])]
        while len(self.levels[-1][0]) > LEAF:
            low, high, top = self.levels[-1]
            cut = np.arange(0, len(low), LEAF)
            self.levels.append((np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut), np.maximum.reduceat(top, cut, axis=0)))

    def close(self, level: int, i: np.ndarray, j: np.ndarray, together: int = 20_000) -> np.ndarray:
        """Which pairs of boxes may hold a linked pair."""
        low, high, top = self.levels[level]
        ok = (4 * high[i] >= 3 * low[j]) & (4 * high[j] >= 3 * low[i])
        fits = np.flatnonzero(ok)
        for s in range(0, len(fits), together):
            at = fits[s : s + together]
            a, b = i[at], j[at]
            ok[at] = enough(np.minimum(top[a], top[b]).sum(axis=1, dtype=np.int64), low[a], low[b])
        return ok

    def pairs(self, together: int = 2000) -> tuple[np.ndarray, np.ndarray]:
        """Positions of all pairs of points whose bound allows a link; depth
        first, at most ``together`` pairs of boxes are opened at a time."""
        last = len(self.levels) - 1
        open_ = [(last, *np.triu_indices(len(self.levels[last][0])))]
        a, b = np.divmod(np.arange(LEAF * LEAF), LEAF)
        found = [(np.zeros(0, int), np.zeros(0, int))]
        while open_:
            level, i, j = open_.pop()
            if len(i) > together and level:
                open_ += [(level, i[s : s + together], j[s : s + together]) for s in range(0, len(i), together)]
                continue
            ok = self.close(level, i, j)
            i, j = i[ok], j[ok]
            if level == 0:
                keep = i < j
                found.append((self.at[i[keep]], self.at[j[keep]]))
            elif len(i):
                m = len(self.levels[level - 1][0])
                i, j = (i[:, None] * LEAF + a).ravel(), (j[:, None] * LEAF + b).ravel()
                keep = (i < m) & (j < m) & (i <= j)
                open_.append((level - 1, i[keep], j[keep]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Consecutive points in leaf order whose bound allows a link."""
        i = np.arange(len(self.at) - 1)
        ok = self.close(0, i, i + 1) if len(i) else np.zeros(0, bool)
        return self.at[i[ok]], self.at[i[ok] + 1]


PAIRS = "a long, b long"


def _pairs_table(pairs: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
    a = np.concatenate([np.minimum(x, y) for x, y in pairs]) if pairs else np.zeros(0, np.int64)
    b = np.concatenate([np.maximum(x, y) for x, y in pairs]) if pairs else np.zeros(0, np.int64)
    both = np.unique(np.stack([a, b], axis=1)[a < b], axis=0)
    return pa.table({"a": pa.array(both[:, 0], pa.int64()), "b": pa.array(both[:, 1], pa.int64())})


def _cells_of(t: pa.Table):
    """(rows of one cell, columns, points) for each cell of a bucket."""
    cols = {c: t[c].to_numpy() for c in t.column_names if c != "x"}
    x = unpacked(b"".join(t["x"].to_pylist()), np.uint16).reshape(-1, GROUPS)
    names = [c for c in ("key", "i", "j") if c in cols]
    at = np.lexsort((cols["doc"], *[cols[c] for c in reversed(names)]))
    new = np.zeros(len(at), bool)
    for c in names:
        v = cols[c][at]
        new |= np.r_[True, v[1:] != v[:-1]]
    cut = np.r_[np.flatnonzero(new), len(at)]
    for lo, hi in zip(cut[:-1], cut[1:]):
        if hi - lo > 1:
            yield at[lo:hi], cols, x


def _reachable(cols, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Can the pair be linked if this cell is its first common shingle?  All
    that it shares then comes from here on in both orders."""
    rest = np.minimum(cols["n"][i] - cols["pos"][i], cols["n"][j] - cols["pos"][j])
    return enough(rest, cols["n"][i], cols["n"][j])


def _near(t: pa.Table) -> pa.Table:
    out = []
    for rows, cols, x in _cells_of(t):
        i, j = Tree(cols["n"][rows], x[rows]).neighbours()
        i, j = rows[i], rows[j]
        ok = _reachable(cols, i, j)
        out.append((cols["doc"][i[ok]], cols["doc"][j[ok]]))
    return _pairs_table(out)


def _apart(rows: np.ndarray, cols, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the pairs of one cell that may be linked and lie in different components."""
    if cols["comp"][rows].min() == cols["comp"][rows].max():
        return rows[:0], rows[:0]
    i, j = Tree(cols["n"][rows], x[rows]).pairs()
    i, j = rows[i], rows[j]
    ok = (cols["comp"][i] != cols["comp"][j]) & _reachable(cols, i, j)
    if cols["i"][rows[0]] != cols["j"][rows[0]]:
        ok &= cols["salt"][i] != cols["salt"][j]
    return i[ok], j[ok]


def _closest(t: pa.Table) -> pa.Table:
    """For every document of a cell its most promising partner elsewhere: the
    pair with the largest bound for its size."""
    out = []
    for rows, cols, x in _cells_of(t):
        i, j = _apart(rows, cols, x)
        if not len(i):
            continue
        bound = np.concatenate([np.minimum(x[i[s : s + 20_000]], x[j[s : s + 20_000]]).sum(axis=1, dtype=np.int64) for s in range(0, len(i), 20_000)])
        worth = bound / (cols["n"][i] + cols["n"][j])
        one, other, worth = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([worth, worth])
        at = np.lexsort((cols["doc"][other], -worth, one))
        first = at[np.r_[True, one[at][1:] != one[at][:-1]]]
        out.append((cols["doc"][one[first]], cols["doc"][other[first]]))
    return _pairs_table(out)


PARTNERS = "a long, b binary"


def _between(t: pa.Table) -> pa.Table:
    """All pairs of a bucket's cells that may be linked across components, as
    one row per document with its partners of larger id."""
    both = _pairs_table([(cols["doc"][i], cols["doc"][j]) for i, j, cols in ((*_apart(rows, c, x), c) for rows, c, x in _cells_of(t))])
    a, b = both["a"].to_numpy(), both["b"].to_numpy()
    cut = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, int)
    return pa.table({"a": pa.array(a[cut], pa.int64()), "b": pa.array([p.tobytes() for p in np.split(b, cut[1:])] if len(a) else [], pa.binary())})


def _unpack_partners(t: pa.Table) -> pa.Table:
    """The distinct pairs of all rows of a bucket of documents."""
    blobs = t["b"].to_pylist()
    b = np.frombuffer(b"".join(blobs), np.int64)
    return _pairs_table([(np.repeat(t["a"].to_numpy(), [len(x) // 8 for x in blobs]), b)])


def _fold(x: np.ndarray, groups: int) -> np.ndarray:
    """A finer point as one of fewer groups (both counts are powers of two)."""
    return x.reshape(-1, groups).sum(axis=0, dtype=np.int64)


def _test_pairs(pairs: DataFrame, values: DataFrame, test) -> DataFrame:
    """The pairs for which ``test`` of the two documents' values holds;
    ``values`` has ``doc, value``, perhaps several rows for an id."""

    def run(batches):
        for b in small(batches, 2000):
            ok = [test(s, t) for s, t in zip(b.column("s").to_pylist(), b.column("t").to_pylist())]
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(mask), b.column("b").filter(mask)], names=["a", "b"])

    left = pairs.join(values.select(F.col("doc").alias("a"), F.col("value").alias("s")), "a")
    both = left.join(values.select(F.col("doc").alias("b"), F.col("value").alias("t")), "b")
    return both.select("a", "b", "s", "t").mapInArrow(run, PAIRS).distinct()


def _fine_bound(s: bytes, t: bytes) -> bool:
    x, y = unpacked(s, np.uint8), unpacked(t, np.uint8)
    g = min(len(x), len(y))
    x, y = _fold(x, g), _fold(y, g)
    return bool(enough(int(np.minimum(x, y).sum()), int(x.sum()), int(y.sum()))) or max(x.max(), y.max()) >= UNBOUNDED


def _similar(s: bytes, t: bytes) -> bool:
    x, y = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return bool(enough(int((y[at] == x).sum()), len(x), len(y)))


def verify(pairs: DataFrame, points: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose sets are similar enough: first by the bound of the finer
    points, then on the sets, which are made anew for the documents left."""
    left = cut_lineage(_test_pairs(pairs, points.select("doc", F.col("fine").alias("value")), _fine_bound))
    flags = doc_filter(left.select(F.explode(F.array("a", "b")).alias("doc")))

    def prepare(batches):
        for b in small(batches):
            ids = b.column("doc_id").to_numpy()
            b = b.filter(pa.array(flags[_slots(ids)], pa.bool_()))
            sets = [shingles(t).tobytes() for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sets, pa.binary())], names=["doc", "value"])

    sets = cut_lineage(texts.mapInArrow(prepare, "doc long, value binary"))
    return _test_pairs(left, sets.filter(F.length("value") > 0), _similar)


def _local_roots(batches):
    """Within one task: every node of its links with the smallest of its part."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.setdefault(top, top)) != top:
            top = up
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for b in batches:
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist()):
            u, v = find(u), find(v)
            if u != v:
                root[max(u, v)] = min(u, v)
    nodes = list(root)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(x) for x in nodes], pa.int64())], names=["u", "v"])


def components(links: DataFrame, together: int = 1_000_000) -> DataFrame:
    """``node, comp`` (smallest reachable node) of all nodes of ``links (a, b)``
    by contraction.  Tasks of about ``together`` links first replace their links
    by stars around the smallest node of each of their parts.  While there is
    more than one task, every node then moves to its smallest neighbour's
    smallest neighbour and the links are rewritten, until none is left."""
    edges = cut_lineage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    found = None
    while n := edges.count():
        tasks = -(-n // together)
        stars = cut_lineage(edges.coalesce(tasks).mapInArrow(_local_roots, "u long, v long"))
        if found is None and tasks == 1:  # one task has seen every link
            return stars.select(F.col("u").alias("node"), F.col("v").alias("comp"))
        if found is None:
            found = stars.select(F.col("u").alias("node")).distinct().withColumn("comp", F.col("node"))
        if tasks == 1:
            move = stars.select("u", F.col("v").alias("to"))
        else:
            hook = cut_lineage(stars.filter("u <> v").groupBy("u").agg(F.min("v").alias("h")))
            far = hook.select(F.col("u").alias("h"), F.col("h").alias("hh"))
            move = cut_lineage(hook.join(far, "h", "left").select("u", F.coalesce("hh", "h").alias("to")))
        moved = lambda df, c: df.join(move.select(F.col("u").alias(c), "to"), c, "left").withColumn(c, F.coalesce("to", c)).drop("to")
        found = cut_lineage(moved(found, "comp"))
        if tasks == 1:
            break
        rewritten = moved(moved(stars, "u"), "v").filter("u <> v")
        edges = cut_lineage(rewritten.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    if found is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return found


def group(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``."""
    spark = docs.sparkSession
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = texts_of(docs).filter(F.col("doc_id").isNotNull())
    ids, counts = sets_and_sketch(texts_of(docs))
    order = Order(counts)
    named = ids.filter(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = cut_lineage(named.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    totals = ids.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.floor(F.col("n") / 4) + 1), F.lit(0)).alias("postings")).first()

    # points of class representatives, in their cells
    reps = classes.select(F.col("rep").alias("doc")).distinct()
    points = named.select(F.col("doc_id").alias("doc"), "n", "x", "fine").join(reps, "doc", "left_semi")
    points = cut_lineage(points.dropDuplicates(["doc", "n", "fine", "x"]))
    held = cut_lineage(cells(texts, order, totals.postings, shuffles).join(reps, "doc", "left_semi"))
    placed = cut_lineage(distinct_cells(held).join(points.select("doc", "n", "x"), ["doc", "n"]))

    # neighbours in each cell, and among the first documents of a split cell's parts
    buckets = max(shuffles, -(-placed.count() // 200_000))
    deal = lambda *c: F.pmod(F.xxhash64(*c), F.lit(buckets)).cast("int")
    cell = placed.select("key", F.col("salt").alias("i"), "doc", "n", "pos", "x", deal("key", "salt").alias("bucket"))
    first = placed.filter("salts > 1").groupBy("key", "salt").agg(F.min(F.struct("doc", "n", "pos", "x")).alias("r")).select("key", F.lit(-1).alias("i"), "r.*", deal("key").alias("bucket"))
    near = cut_lineage(cell.unionByName(first).groupBy("bucket").applyInArrow(_near, PAIRS).distinct())
    # rows that share an id are one node: the id is linked to the classes it occurs in
    several = named.groupBy("doc_id").agg(F.min("set_key").alias("lo"), F.max("set_key").alias("hi")).filter("lo <> hi").select("doc_id")
    shared = named.join(several, "doc_id", "left_semi").select("doc_id", "set_key").distinct().join(classes, "set_key").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    links = cut_lineage(verify(near, points, texts).unionByName(shared))
    comp = components(links)

    # twice, in cells that still hold several components: first each document's
    # most promising partner, which unites most of them, then all pairs left
    def mixed_cells(comp: DataFrame) -> DataFrame:
        known = placed.join(comp.select(F.col("node").alias("doc"), "comp"), "doc", "left").withColumn("comp", F.coalesce("comp", "doc"))
        mixed = known.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
        split = known.join(mixed, "key", "left_semi").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
        split = split.select("key", F.least("salt", "other").alias("i"), F.greatest("salt", "other").alias("j"), "salt", "doc", "n", "pos", "x", "comp")
        return split.withColumn("bucket", deal("key", "i", "j")).groupBy("bucket")

    def united(comp: DataFrame, links: DataFrame) -> DataFrame:
        """``comp`` after further links between its components."""
        of = lambda c: comp.select(F.col("node").alias(c), F.col("comp").alias(f"{c}_comp"))
        joined = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select("a", "b", F.coalesce("a_comp", "a").alias("ca"), F.coalesce("b_comp", "b").alias("cb"))
        upper = components(joined.select(F.col("ca").alias("a"), F.col("cb").alias("b"))).select(F.col("node").alias("comp"), F.col("comp").alias("top"))
        nodes = comp.unionByName(joined.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("ca").alias("comp")), F.struct(F.col("b").alias("node"), F.col("cb").alias("comp")))).alias("r")).select("r.*")).distinct()
        return cut_lineage(nodes.join(upper, "comp", "left").select("node", F.coalesce("top", "comp").alias("comp")))

    closest = cut_lineage(mixed_cells(comp).applyInArrow(_closest, PAIRS).distinct().join(near, ["a", "b"], "left_anti"))
    comp = united(comp, cut_lineage(verify(closest, points, texts)))
    partners = mixed_cells(comp).applyInArrow(_between, PARTNERS).withColumn("bucket", deal("a"))
    rest = partners.groupBy("bucket").applyInArrow(_unpack_partners, PAIRS).distinct()
    rest = cut_lineage(rest.join(near.unionByName(closest), ["a", "b"], "left_anti"))
    comp = united(comp, cut_lineage(verify(rest, points, texts)))

    # documents -> class representative -> component
    final = classes.join(comp.select(F.col("node").alias("rep"), F.col("comp").alias("component_id")), "rep", "left")
    final = cut_lineage(final.select("set_key", "copies", F.coalesce("component_id", "rep").alias("component_id")))
    alone = ids.filter(F.col("doc_id").isNull() | (F.col("n") == 0)).select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    linked = join_groups(named.select("doc_id", "n", "set_key"), final, "set_key", "copies", totals.rows)
    return linked.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


FILTER_BITS = 22


def _slots(ids: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((ids.astype(np.uint64) * MULT) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def doc_filter(docs: DataFrame) -> np.ndarray:
    """A bitmap of 2**FILTER_BITS hashed ids that has every id of ``docs``; ids
    that hit it by chance only cost time, the exact join follows."""

    def run(batches):
        flags = np.zeros(1 << FILTER_BITS, bool)
        for b in batches:
            flags[_slots(b.column("doc").to_numpy())] = True
        yield from array_parts(np.packbits(flags).view(np.uint32).astype(float), TaskContext.get().partitionId())

    def either(t: pa.Table) -> pa.Table:
        bits = np.bitwise_or.reduce([np.asarray(v).astype(np.uint32) for v in t["values"].to_numpy()])
        return pa.table({"chunk": pa.array([t["chunk"][0].as_py()], pa.int32()), "task": pa.array([0], pa.int32()), "values": pa.array([bits.astype(float)], pa.list_(pa.float64()))})

    parts = docs.select("doc").mapInArrow(run, PARTS).groupBy("chunk").applyInArrow(either, PARTS).collect()
    if not parts:
        return np.zeros(1 << FILTER_BITS, bool)
    words = np.concatenate([r["values"] for r in sorted(parts, key=lambda r: r.chunk)]).astype(np.uint32)
    return np.unpackbits(words.view(np.uint8)).astype(bool)

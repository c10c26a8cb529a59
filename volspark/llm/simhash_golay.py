"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A text's fingerprint has bit b set if over half of its shingle hashes have it.
Fingerprints that differ in at most ``bits`` bits are linked.

The 64 bits are cut into ``segments`` pieces of at most 23 bits.  The binary
Golay code (23, 12, 7) is perfect: every 23-bit word lies within three bits of
exactly one of its 4096 codewords.  The keys of a piece are the indices of the
codewords nearest to it and to every word one bit away: one to six of them, as
a table by syndrome.  Two pieces that differ in at most two bits have a word in
between that is at most one bit from either, so they share a key.  By the
pigeonhole principle at most ``bits // 3`` pieces differ in more than two bits;
every choice of the other pieces gives a compound key (24 bits for three
pieces, 36 for four), and linked fingerprints share at least one.

Steps: 1. distinct fingerprints with their smallest id; 2. their compound keys,
dealt to cells, a frequent key (told by a sketch of counts) split by salt;
3. each cell compares its members and returns a spanning forest of its links,
never all pairs; 4. connected components; 5. frequent keys whose members still
lie in several components compare the parts of their split cells pairwise.
The result is exact; keys only choose what is compared.

Defined results: null and empty texts and texts without words have fingerprint
zero, linked like any other; fewer than ``shingle`` words are one shingle; rows
with a null id link with nothing and have component null; rows that share an
id are one node, linked by whatever any of them is linked by; other columns
are ignored; of an empty table the result is empty.
"""

from __future__ import annotations

from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from volspark.llm.common import PARTS, add_arrays, array_parts, join_groups, small, texts_of
from volspark.llm.jaccard_join import components
from volspark.session import cut_lineage

#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, a generator of the Golay code.
GENERATOR = 0b110001110101
LENGTH, CHECK = 23, 11
SEED = 42
CELL = 2048
SKETCH_BITS = 18
SALT_SHIFT = 42
MULT = np.uint64(0x9E3779B97F4A7C15)


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator."""
    left = np.asarray(words, np.int64).copy()
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        left ^= ((left >> bit) & 1) * (GENERATOR << (bit - CHECK))
    return left


def error_patterns() -> np.ndarray:
    """The pattern of at most three bits behind each of the 2048 syndromes."""
    patterns = np.array([sum(1 << b for b in at) for k in range(4) for at in combinations(range(LENGTH), k)])
    table = np.zeros(1 << CHECK, np.int64)
    table[syndromes(patterns)] = patterns
    return table


class SegmentKeys:
    """Codeword indices near a segment of ``width`` bits: index of the segment
    itself xor a change that depends on its syndrome only."""

    def __init__(self, width: int):
        errors, s = error_patterns(), np.arange(1 << CHECK)
        flips = np.r_[0, 1 << np.arange(width)]
        changes = np.stack([(f ^ errors[s ^ syndromes(np.array([f]))[0]]) >> CHECK for f in flips], axis=1)
        sets = [np.unique(row) for row in changes]
        self.count = np.array([len(x) for x in sets])
        self.change = np.zeros((len(sets), self.count.max()), np.int64)
        for row, x in zip(self.change, sets):
            row[: len(x)] = x

    def of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of each word, one row a word, and which of them are real."""
        s = syndromes(words)
        return (words >> CHECK)[:, None] ^ self.change[s], np.arange(self.change.shape[1]) < self.count[s][:, None]


class FuzzyKeys:
    """Compound keys of 64-bit fingerprints."""

    def __init__(self, bits: int = 4, segments: int = 3):
        cut = [64 * i // segments for i in range(segments + 1)]
        self.pieces = [(lo, hi - lo) for lo, hi in zip(cut, cut[1:])]
        if max(w for _, w in self.pieces) > LENGTH or segments <= bits // 3 or segments - bits // 3 > 3:
            raise ValueError(f"{segments} segments cannot serve a distance of {bits}")
        self.keys = [SegmentKeys(w) for _, w in self.pieces]
        self.choices = list(combinations(range(segments), segments - bits // 3))

    def of(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position of the fingerprint, key) of every compound key."""
        parts = [k.of(((fps >> np.uint64(lo)) & np.uint64((1 << w) - 1)).astype(np.int64)) for k, (lo, w) in zip(self.keys, self.pieces)]
        at, keys = [], []
        for number, chosen in enumerate(self.choices):
            key, real = np.full((len(fps), 1), number, np.int64), np.ones((len(fps), 1), bool)
            for i in chosen:
                k, ok = parts[i]
                key = ((key[:, :, None] << 12) | k[:, None, :]).reshape(len(fps), -1)
                real = (real[:, :, None] & ok[:, None, :]).reshape(len(fps), -1)
            at.append(np.nonzero(real)[0])
            keys.append(key[real])
        return np.concatenate(at), np.concatenate(keys)


def fingerprint(text: bytes, shingle: int = 4, together: int = 8192) -> int:
    """SimHash of the lower-cased text's word shingles (repeats count)."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle:] if len(words) >= shingle else ends[-1:]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, (joined[a : b - 1] for a, b in zip(ends, last)), repeat(SEED)), np.dtype("<u8"), n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, together):
        ones += np.unpackbits(hashes[i : i + together].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(texts: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed number) of every row."""

    def run(batches):
        for b in small(batches):
            fps = np.array([fingerprint(t, shingle) for t in b.column("text").cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return texts.mapInArrow(run, "doc_id long, fp long")


def _hash(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x.astype(np.uint64) ^ (x.astype(np.uint64) >> np.uint64(29))) * MULT
        return (x ^ (x >> np.uint64(32))) * MULT


def key_sketch(classes: DataFrame, fuzzy: FuzzyKeys) -> np.ndarray:
    """How many compound keys fall on each value of the upper bits of their hash."""

    def run(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for b in small(batches, 4096):
            _, keys = fuzzy.of(b.column("fp").to_numpy().view(np.uint64))
            total += np.bincount((_hash(keys) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
        yield from array_parts(total, TaskContext.get().partitionId())

    rows = add_arrays(classes.select("fp").mapInArrow(run, PARTS)).collect()
    return np.concatenate([r["values"] for r in sorted(rows, key=lambda r: r.chunk)]) if rows else np.zeros(1 << SKETCH_BITS)


class Salts:
    """Number of cells of a key: what its sketch count has above the count that
    unremarkable keys together may reach, in cells of CELL members."""

    def __init__(self, counts: np.ndarray):
        noise = 4 * np.sqrt(counts.mean()) + 8
        self.of_slot = np.maximum(1, np.ceil((counts - counts.mean() - noise) / CELL)).astype(np.int64)

    def of(self, keys: np.ndarray) -> np.ndarray:
        return self.of_slot[(_hash(keys) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]


def _salt(keys: np.ndarray, fps: np.ndarray, salts: np.ndarray) -> np.ndarray:
    return ((_hash(keys ^ fps.view(np.int64)) >> np.uint64(20)) % salts.astype(np.uint64)).astype(np.int64)


class Forest:
    """Labels of positions that grow together; keeps the links that joined two."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        apart = self.label[a] != self.label[b]
        a, b = a[apart], b[apart]
        if len(a):
            self.links.append((a, b))
        while len(a):
            x, y = self.label[a], self.label[b]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while (self.label[self.label] != self.label).any():
                self.label = self.label[self.label]
            apart = self.label[a] != self.label[b]
            a, b = a[apart], b[apart]


def _cell_links(cell: np.ndarray, fps: np.ndarray, bits: int, narrow: int = 32, block: int = 128):
    """(i, j) of links that span the linked members of each cell; both arrays
    are sorted by cell."""
    forest = Forest(len(cell))
    start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, int)
    size = np.diff(np.r_[start, len(cell)])
    of = np.repeat(size, size)
    i = np.flatnonzero((of > 1) & (of <= narrow))
    for step in range(1, narrow):  # small cells, all at once: members ``step`` apart
        i = i[i + step < len(cell)]
        i = i[cell[i] == cell[i + step]]
        if not len(i):
            break
        close = i[np.bitwise_count(fps[i] ^ fps[i + step]) <= bits]
        forest.join(close, close + step)
    yield from forest.links
    for s, n in zip(start[size > narrow], size[size > narrow]):
        x, own = fps[s : s + n], Forest(n)
        own.join(*(lambda a: (a, a + 1))(np.flatnonzero(np.bitwise_count(x[1:] ^ x[:-1]) <= bits)))
        for at in range(0, n, block):
            close = np.bitwise_count(x[at : at + block, None] ^ x[None, at:]) <= bits
            close &= own.label[at : at + block, None] != own.label[None, at:]
            a, b = np.nonzero(close)
            own.join(a + at, b + at)
        for a, b in own.links:
            yield a + s, b + s


LINKS = "a long, b long"


def _spanning(fps: np.ndarray, links) -> pa.Table:
    """A bucket's links as stars around one fingerprint of each linked part."""
    links = list(links)
    if not links:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    a, b = (fps[np.concatenate(x)] for x in zip(*links))
    nodes, at = np.unique(np.r_[a, b], return_inverse=True)
    forest = Forest(len(nodes))
    forest.join(at[: len(a)], at[len(a) :])
    far = np.flatnonzero(forest.label != np.arange(len(nodes)))
    return pa.table({"a": pa.array(nodes[far].view(np.int64)), "b": pa.array(nodes[forest.label[far]].view(np.int64))})


def links_in_cells(classes: DataFrame, fuzzy: FuzzyKeys, salts: Salts, bits: int, buckets: int) -> DataFrame:
    """Spanning links ``a, b`` between the fingerprints of each cell."""

    def deal(batches):
        for b in small(batches, 4096):
            fps = b.column("fp").to_numpy().view(np.uint64)
            at, keys = fuzzy.of(fps)
            fp = fps[at]
            cell = keys | (_salt(keys, fp, salts.of(keys)) << SALT_SHIFT)
            bucket = (_hash(cell ^ 0x5BD1) >> np.uint64(33)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            full = np.flatnonzero(np.diff(cut))
            blob = lambda x: pa.array([x[order[cut[i] : cut[i + 1]]].tobytes() for i in full], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), blob(cell), blob(fp)], names=["bucket", "cells", "fps"])

    def compare(t: pa.Table) -> pa.Table:
        cell = np.frombuffer(b"".join(t["cells"].to_pylist()), np.int64)
        fps = np.frombuffer(b"".join(t["fps"].to_pylist()), np.uint64)
        order = np.lexsort((fps, cell))
        cell, fps = cell[order], fps[order]
        return _spanning(fps, _cell_links(cell, fps, bits))

    return classes.select("fp").mapInArrow(deal, "bucket int, cells binary, fps binary").groupBy("bucket").applyInArrow(compare, LINKS)


def links_across(classes: DataFrame, comp: DataFrame, fuzzy: FuzzyKeys, salts: Salts, bits: int, buckets: int) -> DataFrame:
    """Spanning links between the parts of split cells that hold fingerprints
    of several components of ``comp`` (``fp, comp``)."""

    def hot(batches):
        for b in small(batches, 4096):
            fps, comps = b.column("fp").to_numpy().view(np.uint64), b.column("comp").to_numpy()
            at, keys = fuzzy.of(fps)
            n = salts.of(keys)
            at, keys, n = at[n > 1], keys[n > 1], n[n > 1]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, n, _salt(keys, fps[at], n), fps[at].view(np.int64), comps[at])], names=["key", "salts", "salt", "fp", "comp"])

    def compare(t: pa.Table) -> pa.Table:
        key, i, j, salt, comp = (t[c].to_numpy() for c in ("key", "i", "j", "salt", "comp"))
        fps = t["fp"].to_numpy().view(np.uint64)
        order = np.lexsort((salt, j, i, key))
        new = np.r_[True, np.any([x[order][1:] != x[order][:-1] for x in (key, i, j)], axis=0)]
        cut, out = np.r_[np.flatnonzero(new), len(order)], []
        for lo, hi in zip(cut, cut[1:]):
            rows = order[lo:hi]
            left, right = rows[salt[rows] == i[rows[0]]], rows[salt[rows] == j[rows[0]]]
            for s in range(0, len(left), 128):
                some = left[s : s + 128]
                close = (np.bitwise_count(fps[some][:, None] ^ fps[right][None, :]) <= bits) & (comp[some][:, None] != comp[right][None, :])
                a, b = np.nonzero(close)
                if len(a):  # one link for each pair of components
                    pair = np.unique(np.stack([comp[some[a]], comp[right[b]]], axis=1), axis=0, return_index=True)[1]
                    out.append((some[a[pair]], right[b[pair]]))
        return _spanning(fps, out)

    rows = cut_lineage(classes.join(comp, "fp").select("fp", "comp").mapInArrow(hot, "key long, salts long, salt long, fp long, comp long"))
    mixed = rows.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
    tiles = rows.join(mixed, "key", "left_semi").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).filter("other <> salt")
    tiles = tiles.select("key", F.least("salt", "other").alias("i"), F.greatest("salt", "other").alias("j"), "salt", "fp", "comp")
    return tiles.withColumn("bucket", F.pmod(F.xxhash64("key", "i", "j"), F.lit(buckets))).groupBy("bucket").applyInArrow(compare, LINKS)


def group(docs: DataFrame, bits: int = 4, shingle: int = 4, segments: int = 3) -> DataFrame:
    """``doc_id, fp, component_id`` (smallest id reachable) of every row."""
    shuffles = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fuzzy = FuzzyKeys(bits, segments)
    rows = cut_lineage(fingerprints(texts_of(docs), shingle))
    named = rows.filter(F.col("doc_id").isNotNull())
    classes = cut_lineage(named.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    size = classes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("copies"), F.lit(0)).alias("rows")).first()
    counts = key_sketch(classes, fuzzy)
    salts = Salts(counts)
    buckets = max(shuffles, int(counts.sum()) // 1_000_000)

    def by_id(links: DataFrame) -> DataFrame:
        """Links between fingerprints as links between smallest ids."""
        of = lambda c: classes.select(F.col("fp").alias(c), F.col("rep").alias(f"{c}_id"))
        return links.join(of("a"), "a").join(of("b"), "b").select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))

    # rows that share an id are one node: the id is linked to the classes it occurs in
    several = named.groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter("lo <> hi").select("doc_id")
    shared = named.join(several, "doc_id", "left_semi").distinct().join(classes, "fp").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    links = cut_lineage(by_id(links_in_cells(classes, fuzzy, salts, bits, buckets)).unionByName(shared).distinct())
    comp = components(links)
    if salts.of_slot.max() > 1:
        known = classes.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("fp", F.coalesce("comp", "rep").alias("comp"))
        more = cut_lineage(by_id(links_across(classes, cut_lineage(known), fuzzy, salts, bits, buckets)))
        comp = components(links.unionByName(more))
    final = classes.join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("fp", "copies", F.coalesce("comp", "rep").alias("component_id"))
    linked = join_groups(named, cut_lineage(final), "fp", "copies", size.rows).select("doc_id", "fp", "component_id")
    return linked.unionByName(rows.filter(F.col("doc_id").isNull()).select("doc_id", "fp", F.lit(None).cast("long").alias("component_id")))

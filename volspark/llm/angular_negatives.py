"""Hard negatives by angular triangle filtering.

For every row the angles to a few reference directions and the norm are stored.
If an anchor has angle s and a row angle t to a reference, the angle between
them lies in [|s - t|, min(s + t, 2 pi - s - t)]; the narrowest interval over
all references, as cosines times both norms, bounds their inner product.  The
same holds for blocks of rows with ranges of angles and norms.  Bounds are
widened by more than what rounding can do (``SLACK`` on angles, ``WIDER`` on
products, one on scores), so that the integer score is always inside.

1. Positives: anchors meet the shards of their label; blocks by falling upper
bound, until no block left can reach an anchor's last place.
2. Negatives: anchors meet all shards; only blocks, then rows, whose bounds
overlap the score window of one of their positives get integer scores.
Lists of a shard are merged in a tree of fixed fan-in.  Shards are dealt by a
hash of the id and hold a bounded number of bytes; a frequent label has many.

The references are chosen from a bounded sample (the ``SAMPLE`` rows with the
smallest hashes of their id), each the farthest from those before; they decide
what is skipped, never what is found.

Defined results: rows with a null id or label, a null vector, or a null or
non-finite component take no part; vectors are compared with those of the same
length; rows with the anchor's own id are neither its positives nor negatives;
an id that occurs as several anchors is one, its smallest (label, vector);
repeated other rows are rows of their own; equal scores go by id; zero vectors
score zero; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volspark.llm.common import join_groups
from volspark.llm.topk_search import EXACT
from volspark.session import cut_lineage

SLACK = 1e-6
WIDER = 1e-9
SAMPLE = 1024
REFERENCES = 16
SHARD_BYTES = 32 << 20
ANCHORS = 4096
BLOCK = 256
FAN_IN = 16
INT = np.int64
LOW = -(1 << 62)


def valid(vectors: DataFrame, id_col: str, label_col: str, vec_col: str, scale: int) -> DataFrame:
    """``id, label, dim, v`` with v = floor(scale * x), of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vec_col).cast("array<double>").alias("x"))
    fit = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).filter(F.coalesce(fit, F.lit(False)))
    return rows.select("id", "label", F.size("x").alias("dim"), F.transform("x", lambda x: F.floor(x * scale).cast("double")).alias("v"))


def choose_references(rows: DataFrame) -> dict[int, np.ndarray]:
    """Unit vectors by dimension, at most REFERENCES of each, from SAMPLE rows."""
    by_dim: dict[int, list] = {}
    for r in rows.orderBy(F.xxhash64("id"), "id").select("dim", "v").limit(SAMPLE).collect():
        by_dim.setdefault(r["dim"], []).append(r["v"])
    out = {}
    for dim, vs in by_dim.items():
        x = np.array(vs, float).reshape(len(vs), dim)
        norm = np.sqrt((x * x).sum(axis=1))
        x = x[norm > 0] / norm[norm > 0, None]
        chosen: list[int] = []
        nearest = np.full(len(x), -2.0)
        while len(chosen) < min(REFERENCES, len(x)) and nearest.min() < 1 - 1e-12:
            chosen.append(int(nearest.argmin()))
            nearest = np.maximum(nearest, x @ x[chosen[-1]])
        out[dim] = x[chosen]
    return out


def measured(rows: DataFrame, references: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` with ``norm`` and ``angles`` to the references of their dimension."""

    def run(batches):
        for b in batches:
            norms, angles = [], []
            for dim, v in zip(b.column("dim").to_pylist(), b.column("v")):
                x = np.asarray(v.values, float)
                norms.append(float(np.sqrt(x @ x)))
                r = references.get(dim, np.zeros((0, dim)))
                angles.append(np.arccos(np.clip(r @ x / (norms[-1] or 1.0), -1, 1)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(norms, pa.float64()), pa.array(angles, pa.list_(pa.float64()))], names=[*b.schema.names, "norm", "angles"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, norm double, angles array<double>")


def cosine_bounds(s: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest cosine between anchors with angles ``s`` (a row each)
    and blocks with angles in [least, most] (a row each)."""
    shape = (len(s), len(least))
    near, far = np.zeros(shape), np.full(shape, np.pi)
    for r in range(s.shape[1]):
        a, lo, hi = s[:, r, None], least[None, :, r], most[None, :, r]
        near = np.maximum(near, np.maximum(a - hi, lo - a) - SLACK)
        upper = np.where(a + lo >= np.pi, 2 * np.pi - a - lo, np.where(a + hi <= np.pi, a + hi, np.pi))
        far = np.minimum(far, upper + SLACK)
    return np.cos(np.clip(far, 0, np.pi)), np.cos(np.clip(near, 0, np.pi))


def score_bounds(norm: np.ndarray, s: np.ndarray, least_norm, most_norm, least, most) -> tuple[np.ndarray, np.ndarray]:
    """Integers that enclose the scores of anchors with blocks (or single rows)."""
    low, high = cosine_bounds(s, least, most)
    low = np.where(low >= 0, low * least_norm, low * most_norm) * norm[:, None]
    high = np.where(high >= 0, high * most_norm, high * least_norm) * norm[:, None]
    wide = WIDER * norm[:, None] * most_norm + 1
    return np.floor(low - wide), np.ceil(high + wide)


class Shard:
    """Rows of one length, in blocks of like angles, and their scores."""

    def __init__(self, t: pa.Table, prefix: str = ""):
        ids = t[prefix + "id"].to_numpy()
        n = len(ids)
        flat = lambda c: pa.concat_arrays([x.flatten() for x in t[prefix + c].chunks]).to_numpy().reshape(n, -1) if n else np.zeros((0, 0))
        v, angles = flat("v"), flat("angles")
        own = angles.argmin(axis=1) if angles.shape[1] else np.zeros(n, int)
        at = np.lexsort((angles[np.arange(n), own] if angles.shape[1] else own, own))
        at = at[np.lexsort((ids[at], np.arange(n) // BLOCK))]  # within a block by id
        self.ids, self.v, self.angles, self.norm = ids[at], v[at], angles[at], t[prefix + "norm"].to_numpy()[at]
        self.labels = np.array(t[prefix + "label"].to_pylist(), object)[at]
        self.largest = np.abs(v).max(initial=1)
        cut = np.arange(0, n, BLOCK)
        self.start, self.stop = cut, np.minimum(cut + BLOCK, n)
        if n:
            self.ranges = (np.minimum.reduceat(self.norm, cut), np.maximum.reduceat(self.norm, cut), np.minimum.reduceat(self.angles, cut, axis=0), np.maximum.reduceat(self.angles, cut, axis=0))

    def scores(self, q: np.ndarray, at) -> np.ndarray:
        if max(np.abs(q).max(initial=1), 1) * self.largest * max(q.shape[1], 1) < EXACT:
            return (q @ self.v[at].T).astype(INT)
        return q.astype(INT) @ self.v[at].astype(INT).T


class Best:
    """The k best (score, id) of each list, ties by smaller id."""

    def __init__(self, lists: int, k: int):
        self.score, self.id = np.full((lists, k), LOW, INT), np.full((lists, k), np.iinfo(INT).max, INT)

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` (a row per list of ``at``; LOW: no candidate; changed) of
        the ascending ``ids``."""
        rows, new_scores, new_ids = np.arange(len(at)), [self.score[at]], [self.id[at]]
        for _ in range(min(self.score.shape[1], scores.shape[1])):
            j = scores.argmax(axis=1)  # the first of equal ones
            new_scores.append(scores[rows, j][:, None])
            new_ids.append(np.where(new_scores[-1] == LOW, np.iinfo(INT).max, ids[j][:, None]))
            scores[rows, j] = LOW
        s, i = np.concatenate(new_scores, axis=1), np.concatenate(new_ids, axis=1)
        best = np.lexsort((i, -s), axis=1)[:, : self.score.shape[1]]
        self.score[at], self.id[at] = np.take_along_axis(s, best, axis=1), np.take_along_axis(i, best, axis=1)

    def last(self) -> np.ndarray:
        return self.score[:, -1]


def best_positives(q: Shard, c: Shard, k: int) -> Best:
    """Per anchor the best k rows of a shard of its label."""
    best = Best(len(q.ids), k)
    _, high = score_bounds(q.norm, q.angles, *c.ranges)
    for b in np.argsort(-high.max(axis=0)):
        at = np.flatnonzero(high[:, b] >= best.last())
        for some in np.split(at, np.arange(512, len(at), 512)):
            if len(some):
                rows = slice(c.start[b], c.stop[b])
                s = c.scores(q.v[some], rows)
                s[q.ids[some][:, None] == c.ids[rows][None, :]] = LOW
                best.add(some, s, c.ids[rows])
    return best


def best_in_windows(q: Shard, owner: np.ndarray, positive: np.ndarray, c: Shard, k: int, low: int, high: int) -> Best:
    """Per (anchor, positive): the best k rows of a shard of another label with
    ``low * positive <= 100 * score <= high * positive``."""
    best = Best(len(owner), k)
    least, most = -(-low * positive // 100), high * positive // 100
    bounds = score_bounds(q.norm, q.angles, *c.ranges)
    for b in np.argsort(-bounds[1].max(axis=0)):
        under, over = bounds[0][owner, b], bounds[1][owner, b]
        lists = np.flatnonzero((over >= least) & (under <= most) & (least <= most) & (over >= best.last()))
        if not len(lists):
            continue
        anchors, of = np.unique(owner[lists], return_inverse=True)
        for s in range(0, len(anchors), 512):
            some = anchors[s : s + 512]
            rows = np.arange(c.start[b], c.stop[b])
            under, over = score_bounds(q.norm[some], q.angles[some], c.norm[rows], c.norm[rows], c.angles[rows], c.angles[rows])
            mine = (of >= s) & (of < s + 512)
            ask, at = lists[mine], of[mine] - s
            overlap = (over[at] >= np.maximum(least, best.last())[ask][:, None]) & (under[at] <= most[ask][:, None])
            wanted = np.flatnonzero(overlap.any(axis=0))
            if not len(wanted):
                continue
            score = c.scores(q.v[some], rows[wanted])
            apart = (q.labels[some][:, None] != c.labels[rows[wanted]][None, :]) & (q.ids[some][:, None] != c.ids[rows[wanted]][None, :])
            found = score[at]
            ok = apart[at] & overlap[:, wanted] & (found >= least[ask][:, None]) & (found <= most[ask][:, None])
            best.add(ask, np.where(ok, found, LOW), c.ids[rows[wanted]])
    return best


def merged(lists: DataFrame, keys: list[str], k: int, shards: int) -> DataFrame:
    """``keys`` and ``top``: the k best (neg, id) over all shards of ``lists``
    (``keys, shard, score, id``), FAN_IN shards at a time."""
    while True:
        last, shards = shards <= FAN_IN, -(-shards // FAN_IN)
        hits = F.collect_list(F.struct((-F.col("score")).alias("neg"), "id"))
        tops = lists.withColumn("shard", F.floor(F.col("shard") / FAN_IN).cast("int")).groupBy(*keys, "shard").agg(F.slice(F.array_sort(hits), 1, k).alias("top"))
        if last:
            return tops.select(*keys, "top")
        lists = tops.select(*keys, "shard", F.explode("top").alias("hit")).select(*keys, "shard", (-F.col("hit.neg")).alias("score"), F.col("hit.id").alias("id"))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for every row for which ``is_anchor`` (an expression over
    ``id``) holds and each of its ``positives`` best rows of the same label, the
    ``negatives`` best rows of other labels whose score is ``low`` to ``high``
    percent of the positive's."""
    spark = vectors.sparkSession
    rows = valid(vectors, id_col, label_col, vec_col, scale)
    rows = cut_lineage(measured(rows, choose_references(rows)))
    anchors = rows.filter(is_anchor)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("dim"), F.lit(0)).alias("dim")).first()
    n_anchors = anchors.count()
    per_shard = max(1024, SHARD_BYTES // (8 * max(size.dim, 1)))
    deal = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    one = anchors.groupBy("id", "dim").agg(F.min(F.struct("label", "v", "norm", "angles")).alias("r")).select("id", "dim", "r.*")
    blocks = max(1, -(-n_anchors // ANCHORS))
    one = cut_lineage(one.withColumn("block", deal(F.lit(blocks))))
    parts = lambda df, keys, prefix="": df.select(*[F.col(c).alias(prefix + c) for c in dict.fromkeys([*keys, "id", "label", "v", "norm", "angles"])])

    # positives: the shards of the anchor's label; a frequent label has several
    cell = F.struct("dim", "label").alias("cell")
    sizes = cut_lineage(rows.groupBy(cell).agg(F.count(F.lit(1)).alias("rows")))
    asked = one.groupBy(cell).agg(F.ceil(F.count(F.lit(1)) / ANCHORS).cast("int").alias("blocks"))
    layout = cut_lineage(sizes.join(asked, "cell").withColumn("shards", F.ceil(F.col("rows") / per_shard).cast("int")))
    keys = ["dim", "label", "block", "shard"]
    left = join_groups(one.drop("block").withColumn("cell", cell), layout, "cell", "rows", size.n)
    left = left.withColumn("block", deal(F.col("blocks"))).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    right = join_groups(rows.withColumn("cell", cell), layout, "cell", "rows", size.n)
    right = right.withColumn("shard", deal(F.col("shards"))).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lists = "anchor_id long, dim int, positive_id long, positive_score long, shard int, score long, id long"

    def table(owner, dims, positive, shard, score, ids) -> pa.Table:
        n = len(owner)
        whole = lambda x, kind: pa.array(np.full(n, x) if np.ndim(x) == 0 else x, kind)
        return pa.table({"anchor_id": whole(owner, pa.int64()), "dim": whole(dims, pa.int32()), "positive_id": whole(positive[0], pa.int64()), "positive_score": whole(positive[1], pa.int64()), "shard": whole(shard, pa.int32()), "score": whole(score, pa.int64()), "id": whole(ids, pa.int64())})

    def empty() -> pa.Table:
        none = np.zeros(0, INT)
        return table(none, 0, (0, 0), 0, none, none)

    def near(key, lt: pa.Table, rt: pa.Table) -> pa.Table:
        if not len(lt) or not len(rt):
            return empty()
        q = Shard(lt)
        best = best_positives(q, Shard(rt, "c_"), positives)
        at, place = np.nonzero(best.score > LOW)
        return table(q.ids[at], key[0].as_py(), (0, 0), key[3].as_py(), best.score[at, place], best.id[at, place])

    cells = parts(left, keys).groupBy(*keys).cogroup(parts(right, keys, "c_").groupBy(*[f"c_{k}" for k in keys]))
    found = cells.applyInArrow(near, lists).select("anchor_id", "dim", "shard", "score", "id")
    most = layout.agg(F.coalesce(F.max("shards"), F.lit(1))).first()[0]
    tops = cut_lineage(merged(found, ["anchor_id", "dim"], positives, most))

    # negatives: every shard, with the anchor's positives beside its vector
    shards = max(4 * spark.sparkContext.defaultParallelism, -(-size.n // per_shard))
    keys = ["dim", "block", "shard"]
    left = one.join(tops.withColumnRenamed("anchor_id", "id"), ["id", "dim"]).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    left = left.select(*keys, "id", "label", "v", "norm", "angles", F.col("top.id").alias("positive_ids"), F.transform("top.neg", lambda x: -x).alias("positive_scores"))
    right = rows.withColumn("shard", deal(F.lit(shards))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def hard(key, lt: pa.Table, rt: pa.Table) -> pa.Table:
        if not len(lt) or not len(rt):
            return empty()
        q, c = Shard(lt), Shard(rt, "c_")
        place = {int(x): i for i, x in enumerate(q.ids)}
        owner, ids, scores = [], [], []
        for a, p, s in zip(lt["id"].to_pylist(), lt["positive_ids"].to_pylist(), lt["positive_scores"].to_pylist()):
            # two rows of one id and score have the same negatives; ask once
            for i, x in dict.fromkeys(zip(p, s)):
                owner.append(place[a])
                ids.append(i)
                scores.append(x)
        owner, ids, scores = (np.array(x, INT) for x in (owner, ids, scores))
        best = best_in_windows(q, owner, scores, c, negatives, low, high)
        at, rank = np.nonzero(best.score > LOW)
        return table(q.ids[owner[at]], key[0].as_py(), (ids[at], scores[at]), key[2].as_py(), best.score[at, rank], best.id[at, rank])

    found = left.groupBy(*keys).cogroup(parts(right, keys, "c_").groupBy(*[f"c_{k}" for k in keys])).applyInArrow(hard, lists)
    pair = ["anchor_id", "dim", "positive_id", "positive_score"]
    best = merged(found, pair, negatives, shards)
    # a positive row that occurs twice keeps its lists twice
    times = tops.select("anchor_id", "dim", F.explode("top").alias("p")).groupBy("anchor_id", "dim", F.col("p.id").alias("positive_id"), (-F.col("p.neg")).alias("positive_score")).agg(F.count(F.lit(1)).cast("int").alias("times"))
    best = best.join(times, pair).withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
    ranked = best.select("anchor_id", "positive_id", "positive_score", F.posexplode("top").alias("pos", "hit"))
    return ranked.select("anchor_id", "positive_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.id").alias("negative_id"), "positive_score", (-F.col("hit.neg")).alias("negative_score"))

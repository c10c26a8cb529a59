"""Top-k search and packing against direct computations."""

import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from volspark.llm import packing, topk_search
from volspark.llm.queries import tokenizer_path


def brute_top(rows, k):
    valid = [(i, [math.floor(256 * np.float32(x).astype(float)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in valid:
        if q % 50 == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in valid if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -neg) for r, (neg, i) in enumerate(s[:k])]
    return sorted(out)


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.normal(0, 1, 6).astype(np.float32)]) for i in range(300)]
    rows += [(i, [1.0, 0.0, 0.5, 0.0, 0.0, 0.25]) for i in range(300, 420)]  # equal vectors: ties by id
    rows += [(420, None), (421, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (422, [float("nan")] * 6), (450, [float("inf")] * 6), (None, [1.0] * 6), (500, [1.0, 2.0]), (501, [2.0, 1.0]), (550, [3.0e6] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(7)).withColumn("score", F.lit(1))
    got = sorted(map(tuple, topk_search.search(df, F.col("id") % 50 == 0, k=5, query_block=3, shard_rows=50, tile=(2, 16), fan_in=2).collect()))
    assert got == brute_top(rows, 5)


def test_search_empty_and_lonely(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk_search.search(spark.createDataFrame([], schema), F.col("id") % 50 == 0).count() == 0
    assert topk_search.search(spark.createDataFrame([(0, [1.0])], schema), F.col("id") % 50 == 0).count() == 0


def test_large_integers_stay_exact():
    q, c = np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 1.0], [2.0**20, 2.0]])
    out = topk_search.best_of_tile(np.array([0]), q, np.array([1, 2]), c, 2)
    assert [(int(s[0]), int(i[0])) for _, s, i in out] == [(2**60 + 2, 2), (2**60 + 1, 1)]


def best_fit_decreasing(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(room) if r >= n]
        if fits:
            room[min(fits, key=room.__getitem__)] -= n
        else:
            room.append(capacity - n)
    return len(room)


TEXTS = [None, "", "one", "Hello, WORLD! it's <|endoftext|> x", "İ. Σς ﬁ é. ²3 _’", "word " * 5000, "tab\tnew\nline\x1cfs\x85nel", "don't.", "a" * 9000] + [f"text {i} " * (i % 37) for i in range(300)]


def test_pieces_and_places(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("length", F.lit("clash"))
    rows = packing.pack(docs, tokenizer_path(), capacity=64).collect()
    want = {}
    for i, t in enumerate(TEXTS):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for p, s in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[s : s + 64], "<u4")
            want[i, p] = (s, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 64
    assert len(filled) <= best_fit_decreasing([r.length for r in rows], 64)


def test_texts_are_encoded_together():
    """All texts of a slice at once, each distinct word looked up once."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    texts = [t or "" for t in TEXTS]
    encoder = packing.WordEncoder(tokenizer_path(), max_words=50)
    want = [[*tok.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    for size in (1, 500, 10**9):
        slices = list(packing.few(batch, size))
        assert [d for docs, _ in slices for d in docs] == list(range(len(texts)))
        assert [ids.tolist() for _, part in slices for ids in encoder.encode(part)] == want
    assert encoder.encode([]) == []


def test_pack_empty_and_repeated(spark):
    schema = "doc_id long, text string"
    assert packing.pack(spark.createDataFrame([], schema), tokenizer_path()).count() == 0
    rows = packing.pack(spark.createDataFrame([(1, "x"), (1, "x"), (None, None)], schema), tokenizer_path(), capacity=8).collect()
    assert len(rows) == 3
    places = sorted((r.sequence_id, r.offset, r.length) for r in rows)
    assert len({(s, o) for s, o, _ in places}) == 3 and places[0][:2] == (0, 0)


@pytest.mark.parametrize("seed", range(5))
def test_fullest_is_optimal(seed):
    rng = np.random.default_rng(seed)
    sizes = sorted({int(x) for x in rng.integers(3, 40, 6)}, reverse=True)
    counts = {s: int(rng.integers(1, 4)) for s in sizes}
    room = int(rng.integers(20, 90))
    sums = {0}
    for s in sizes:
        sums |= {a + s * n for a in sums for n in range(counts[s] + 1)}
    used = packing.fullest(sizes, counts, room)
    assert sum(s * n for s, n in used.items()) == max(x for x in sums if x <= room)
    assert all(n <= counts[s] for s, n in used.items())


def test_slack_uses_everything_once():
    histogram = {2048: 7, 1000: 501, 48: 13, 3: 2, 700: 90, 512: 1000, 1: 5}
    used = {}
    for combo, bins in packing.minimum_bin_slack(histogram, 2048):
        assert sum(s * n for s, n in combo.items()) <= 2048
        for s, n in combo.items():
            used[s] = used.get(s, 0) + n * bins
    assert used == histogram

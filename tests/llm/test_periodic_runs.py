import hashlib
import re
import zlib

import numpy as np
import pytest

from volspark.llm import periodic_runs as P
from volspark.llm.queries import QUERIES, repeated_words


def plain_runs(words, shortest=12):
    """By definition: maximal stretches of every period, smallest period only."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            stretch = words[s : i + q]
            if len(stretch) >= max(shortest, 2 * q) and not any(stretch[:-d] == stretch[d:] for d in range(1, q)):
                out.append((s, len(stretch), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def tile_runs(words):
    table = {w: i for i, w in enumerate(dict.fromkeys(words))}
    pieces = {}
    for low, high, step, at, bounds, part in P.tiles(np.array([table[w] for w in words], np.int32)):
        for p, intervals in P.solve(low, high, step, bounds.tolist(), part.tolist()).items():
            pieces.setdefault(p, []).extend((at + a, at + z) for a, z in intervals)
    out = []
    for p, found in pieces.items():
        whole = []
        for a, z in sorted(found):
            if whole and a <= whole[-1][1]:
                whole[-1][1] = max(whole[-1][1], z)
            else:
                whole.append([a, z])
        out += [(a, z - a + p, p) for a, z in whole if z - a >= max(p, 12 - p)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def random_words(rng):
    words = list(rng.choice(list("abc"), rng.integers(0, 40))) if rng.random() < 0.4 else [str(x) for x in rng.integers(0, 50, rng.integers(0, 60))]
    for _ in range(rng.integers(0, 4)):
        unit = [str(x) for x in rng.integers(0, 4, rng.integers(1, 45))]
        words += (unit * 12)[: rng.integers(1, 160)] + [str(x) for x in rng.integers(0, 9, rng.integers(0, 7))]
    return words


@pytest.mark.parametrize("tile", [8, 2048])
def test_tiles_find_the_runs_of_the_definition(monkeypatch, tile):
    monkeypatch.setattr(P, "TILE_WORDS", tile)
    rng = np.random.default_rng(5)
    several = 0
    for _ in range(400):
        words = random_words(rng)
        want = plain_runs(words)
        assert tile_runs(words) == want
        several += len(want) > 1
    assert several > 50
    for n in (11, 12, 13, 700):
        assert tile_runs(["x"] * n) == plain_runs(["x"] * n)
    fibonacci = "a"
    for a, b in [("a", "ab")]:
        for _ in range(9):
            a, b = b, b + a
        fibonacci = list(b)
    assert tile_runs(fibonacci) == plain_runs(fibonacci)


def test_find_over_rows(spark):
    rng = np.random.default_rng(6)
    texts = ["  ".join(random_words(rng)) for _ in range(60)]
    texts += [None, "", " \n", "a", "é " * 30 + "end", "\tA a A a A a A a A a A a A a", " ".join(["line of words"] * 2500), " ".join(str(i) for i in range(30000))]
    rows = [(i, t, "clash", i) for i, t in enumerate(texts)] + [(7, texts[7], "again", 0), (7, texts[8], "other", 0), (None, "b " * 40, "null id", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, row int")
    want = []
    for i, t, *_ in rows:
        words = re.findall("[^\x20\x09-\x0d]+", t or "")
        runs = plain_runs(words) if len(words) < 5000 else [(0, 7500, 3)] if t.startswith("line") else []
        want.append((i, runs, plain_collapse(words, runs)))
    got = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in P.find(docs).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(got, key=key) == sorted(want, key=key)
    digests = {(r.doc_id, r.collapsed) for r in P.find(docs, digest=True).collect()}
    assert digests == {(i, hashlib.sha256(t.encode()).hexdigest()) for i, _, t in want}
    assert P.find(docs.limit(0)).count() == 0


def test_query_is_the_contract(spark):
    """All documents of the smallest tables, by the definition."""
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    changed = 0
    for d in docs:
        words = re.findall("[^\x20\x09-\x0d]+", d.text or "")
        h = zlib.crc32(str(d.doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            changed += 1
        r = got[d.doc_id]
        if n > 1500:
            continue
        runs = plain_runs(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
    assert changed > 5


def test_planting_on_edges(spark):
    rows = [(i, t) for i, t in enumerate([None, "", " ", "one", "a b c d e f"] * 8)] + [(None, "x y z")]
    got = [(r.doc_id, r.text) for r in repeated_words(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    for i, t in got:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            assert t == dict(rows)[i]

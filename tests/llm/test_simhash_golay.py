import numpy as np
import xxhash
from pyspark.sql import functions as F

from volspark.llm import simhash_golay as G
from volspark.llm.queries import QUERIES


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", words) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    """fps: {node: fingerprints}; smallest reachable node by single steps."""
    root = {n: n for n in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if any((x ^ y).bit_count() <= 4 for x in fps[a] for y in fps[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


def test_code_is_perfect():
    words = np.array([0, 1, 5, GEN := G.GENERATOR, GEN << 3])
    assert (G.syndromes(words[[0, 3, 4]]) == 0).all()
    patterns = G.error_patterns()
    assert len(set(patterns.tolist())) == 2048 and (G.syndromes(patterns) == np.arange(2048)).all()


def test_pieces_two_bits_apart_share_a_key():
    rng = np.random.default_rng(1)
    for width in (16, 21, 22, 23):
        keys = G.SegmentKeys(width)
        x = rng.integers(0, 1 << width, 4000)
        flip = (1 << rng.integers(0, width, 4000)) | (1 << rng.integers(0, width, 4000))
        a, ok_a = keys.of(x)
        b, ok_b = keys.of(x ^ flip)
        assert all(set(p[m]) & set(q[n]) for p, m, q, n in zip(a, ok_a, b, ok_b))
        assert set(ok_a.sum(axis=1)) <= {1, 2, 3, 4, 5, 6}


def test_linked_fingerprints_share_a_compound_key():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 63, 500).astype(np.uint64)
    for segments in (3, 4):
        fuzzy = G.FuzzyKeys(4, segments)
        y = x.copy()
        for _ in range(4):
            y ^= np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)
        ax, kx = fuzzy.of(x)
        ay, ky = fuzzy.of(y)
        assert {a for a in range(500) if set(kx[ax == a]) & set(ky[ay == a])} == set(range(500))


def documents(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"Word{i}é" for i in range(300)]
    texts = []
    for _ in range(25):
        words = list(rng.choice(vocabulary, rng.integers(30, 90)))
        texts.append(" ".join(words))
        for _ in range(3):
            copy = list(words)
            copy[rng.integers(len(copy))] = "changed"
            texts.append("\t".join(copy).upper() if rng.random() < 0.2 else "  ".join(copy))
    texts += ["", None, " \n ", "one two", "One  TWO", "a b c d", "x " * 5000, texts[0], texts[0]]
    rows = [(i, t, i * 2) for i, t in enumerate(texts)]
    rows += [(3, texts[40], 0), (3, texts[60], 0), (3, texts[60], 0), (None, texts[0], 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, fp int"), rows


def test_groups_are_those_of_brute_force(spark):
    docs, rows = documents(spark)
    fps = {}
    for i, t, _ in rows:
        if i is not None:
            fps.setdefault(i, set()).add(plain_fingerprint(t))
    want = plain_components(fps)
    got = G.group(docs).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id or -1, r.fp % 2**64) for r in got) == sorted((i or -1, plain_fingerprint(t)) for i, t, _ in rows)
    assert all(r.component_id == want[r.doc_id] for r in got if r.doc_id is not None)
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert sum(1 for c in set(want.values()) if sum(v == c for v in want.values()) > 1) > 5
    four = G.group(docs, segments=4).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in four) == sorted((r.doc_id or -1, r.component_id or -1) for r in got)


def test_split_cells(spark, monkeypatch):
    """Chains of fingerprints around few centres, with cells of eight members."""
    rng = np.random.default_rng(4)
    fps = [0x0123456789ABCDEF]
    for _ in range(400):
        fps.append(fps[rng.integers(len(fps))] ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))) ^ (1 << int(rng.integers(64))))
    fps += [int(x) for x in rng.integers(0, 2**63, 50)]
    monkeypatch.setattr(G, "CELL", 8)
    monkeypatch.setattr(G, "fingerprints", lambda texts, shingle: texts.select("doc_id", F.col("text").cast("long").alias("fp")))
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    docs = spark.createDataFrame([(i, str(x)) for i, x in enumerate(signed)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in G.group(docs).collect()}
    want = plain_components({i: {x} for i, x in enumerate(fps)})
    assert got == want and len(set(want.values())) > 20


def test_empty_and_query(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert G.group(none).count() == 0
    out = QUERIES["op11_simhash_golay"](spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    rows = out.collect()
    assert all(len(r.fingerprint) == 16 and r.component_id <= r.doc_id for r in rows)

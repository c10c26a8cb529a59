"""The learned operators: exact parts against direct computations, learning on
planted signals, and edge cases."""

import collections
import math
import pickle
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from volspark.llm import hmm, langid, quality, sentencepiece_sampling, toxicity
from volspark.llm.common import fold
from volspark.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, score string"  # the last name clashes
EDGE = [(900, None, "en", "x"), (901, "", None, "x"), (902, "12 ... !?", "en", "x"), (903, "the of and to " * 8000, "en", "x"), (None, "the of and", "en", "x"), (904, "a\u0000b ퟿ é", "de", "x"), (904, "a\u0000b ퟿ é", "de", "x")]


def held(i, mod, rest):
    return i is not None and zlib.crc32(str(i).encode()) % mod == rest


def planted(n=400, seed=2):
    rng = random.Random(seed)
    words = {"en": "the of and to in that was for".split(), "de": "der die und nicht ist mit sich auf".split()}
    rows, toxic, good = [], {}, {}
    for i in range(n):
        lang = rng.choice(["en", "de"])
        w = [rng.choice(words[lang]) for _ in range(rng.randint(5, 60))]
        toxic[i] = int(rng.random() < 0.3)
        good[i] = int(rng.random() < 0.8)
        if toxic[i]:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["zork", "blargish"]))
        t = " ".join(w) if good[i] else " | ".join(w).upper() + "!!"
        rows.append((i, t, lang, "x"))
    return rows, toxic, good


def test_toxicity_learns_and_handles_edges(spark):
    rows, toxic, _ = planted()
    docs = spark.createDataFrame(rows + EDGE, SCHEMA)
    labels = spark.createDataFrame([(i, v) for i, v in toxic.items()] + [(900, None), (None, 1), (5000, 1)], "doc_id long, toxic int")
    got = toxicity.score(docs, labels).collect()
    assert len(got) == len(rows) + len(EDGE)
    assert all(0 <= r.score <= 1 for r in got)
    assert all((r.score >= 0.5) == bool(toxic[r.doc_id]) for r in got if r.doc_id in toxic)
    assert all(r.score < 0.5 and r.neighbours == "" for r in got if r.doc_id in (900, 901, 902))


def test_block_max_search_is_exact():
    rng = np.random.default_rng(3)
    idf = rng.uniform(0.5, 4, 50)
    examples = [(int(i), int(rng.integers(2)), sorted(rng.choice(50, rng.integers(1, 9), replace=False).tolist()), rng.integers(1, 5, 8).tolist()) for i in range(500)]
    examples = [(d, y, t, c[: len(t)] + [1] * (len(t) - len(c[: len(t)]))) for d, y, t, c in examples]
    index = toxicity.BlockMaxIndex(idf, examples)
    dense = np.zeros((500, 50))
    for d, _, t, c in examples:
        i, w = index.unit(t, c)
        dense[d, i] = w
    for d, _, t, c in examples[:60]:
        docs, cos = index.nearest(t, c, 7)
        all_cos = dense @ dense[d]
        want = sorted(range(500), key=lambda j: (-round(all_cos[j], 12), j))[:7]
        want = [j for j in want if all_cos[j] > 0]
        assert index.ids[docs].tolist() == want
        assert np.allclose(cos, all_cos[want])


def test_blocks_are_left_closed(monkeypatch):
    """Examples of ten themes that also share a frequent term: a text of one theme opens few blocks."""
    monkeypatch.setattr(toxicity, "FREQUENT", 20)
    rng = np.random.default_rng(4)
    examples = [(i, i % 2, [0, *(1 + 5 * (i % 10) + np.sort(rng.choice(5, 3, replace=False))).tolist()], [1, 2, 1, 3]) for i in range(1280)]
    index = toxicity.BlockMaxIndex(np.r_[0.2, np.ones(50)], examples)
    dense = np.zeros((1280, 51))
    for place, doc in enumerate(index.ids):
        t, w = index.unit(examples[doc][2], examples[doc][3])
        dense[place, t] = w
    for _, _, t, c in examples[:40]:
        docs, cos = index.nearest(t, c, 9)
        q = np.zeros(51)
        q[t] = index.unit(t, c)[1]
        every = dense @ q
        want = sorted(range(1280), key=lambda j: (-round(every[j], 12), index.ids[j]))[:9]
        assert index.ids[docs].tolist() == index.ids[want].tolist() and np.allclose(cos, every[want])
    assert index.opened < index.asked / 2


def test_terms_are_counted_once_a_word_and_blocks_opened_for_many_texts(monkeypatch):
    """Words are looked up once, however often and in however many texts they
    stand; a block is opened by one product for all texts of a batch."""
    monkeypatch.setattr(toxicity, "FREQUENT", 5)
    texts = ["The theatre, THE theatres", "", "naïve 12 theatre unknownword", "the " * 50] * 50
    looked = collections.Counter()

    class Numbers(dict):
        def get(self, term):
            looked[term] += 1
            return super().get(term)

    at = Numbers((t, i) for i, t in enumerate(sorted({t for w in (b"the", b"theatre", b"theatres", "naïve".encode()) for t in toxicity.terms_of(w)})))
    batch = pa.RecordBatch.from_pydict({"text": texts})
    got = {}
    for words in (200_000, 3):  # one slice, and slices that are cut by words
        monkeypatch.setattr(toxicity, "WORDS", words)
        looked.clear()
        rows, done = [], 0
        for b, row, term, count in toxicity.count_terms([batch], at):
            rows += [(done + int(r), int(t), int(c)) for r, t, c in zip(row, term, count)]
            done += b.num_rows
        assert done == len(texts) and {w for w, n in looked.items() if n == 1} >= {b"the", b"theatre", b"theatres", b"unknownword"}
        got[words] = rows
    want = []
    for r, text in enumerate(texts):
        each = collections.Counter(at[t] for w in toxicity.words_of(text) for t in toxicity.terms_of(w) if t in at)
        want += [(r, t, c) for t, c in sorted(each.items())]
    assert got[200_000] == got[3] == want

    rng = np.random.default_rng(5)
    examples = [(i, i % 2, sorted(rng.choice(60, 12, replace=False).tolist()), rng.integers(1, 5, 12).tolist()) for i in range(400)]
    index = toxicity.BlockMaxIndex(rng.uniform(0.5, 4, 60), examples)
    cells = [np.concatenate([e[n] for e in examples]) for n in (2, 3)]
    together = index.nearest_of(len(examples), np.repeat(np.arange(len(examples)), 12), cells[0], cells[1].astype(float), 9)
    for (_, _, t, c), (docs, cos) in zip(examples, together):
        alone = index.nearest(t, c, 9)
        assert docs.tolist() == alone[0].tolist() and np.allclose(cos, alone[1])
    sent = pickle.dumps(index)
    assert len(sent) < sum(x.nbytes for x in (*index.postings, index.idf, index.ids, index.y)) + 2000
    again = pickle.loads(sent).nearest(*examples[3][2:], 9)
    assert again[0].tolist() == together[3][0].tolist() and np.allclose(again[1], together[3][1])
    only = toxicity.BlockMaxIndex(np.ones(4), [(7, 1, [0, 1], [1, 1])])
    assert len(only.nearest([2, 3], [1, 1], 9)[0]) == 0  # terms that no example holds


def test_toxicity_indexes_every_term_and_example(spark):
    # few examples: no term passes a significance threshold, most texts hold none
    rows = [(i, f"the of and word{'abcdefgh'[i % 8]}", "en", "x") for i in range(200)]
    ids = [i for i in range(1, 200) if not held(i, 5, 0)]
    toxic = {i: int(i in ids[:30]) for i in ids}
    rows = [(i, t + (" zork" if i in ids[:12] else ""), a, b) for i, t, a, b in rows] + [(300, "zork", "en", "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}
    named = {n.split(":")[0] for r in got.values() for n in r.neighbours.split(",") if n}
    assert got[300].neighbours and all(n.split(":")[1] == "1" for n in got[300].neighbours.split(","))
    indexed = toxicity.class_terms(docs.join(labels.withColumnRenamed("toxic", "y"), "doc_id"))
    assert {b"the", b"zork", b"worda", b"word "} <= set(indexed)
    assert all(got[i].neighbours for i in got) and len(named) >= 50


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)]])
def test_without_both_classes(spark, labels):
    docs = spark.createDataFrame([(i, f"text {i}", "en", "x") for i in range(4)], SCHEMA)
    table = spark.createDataFrame(labels, "doc_id long, toxic int, quality int") if not labels else spark.createDataFrame([(i, v, v) for i, v in labels], "doc_id long, toxic int, quality int")
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, table).collect())
    assert all(0 <= r.score <= 1 for r in quality.score(docs, quality.train(docs, table, "quality")).collect())


def test_quality_learns_and_keeps_columns(spark):
    rows, _, good = planted()
    docs = spark.createDataFrame(rows + EDGE, SCHEMA)
    labels = spark.createDataFrame([(i, v) for i, v in good.items()] + [(1, None), (None, 0)], "doc_id long, quality int")
    model = quality.train(docs, labels, "quality")
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows) + len(EDGE)
    assert all((r.score >= 0.3) == bool(good[r.doc_id]) for r in got if r.doc_id in good)
    kept = quality.keep(docs, model, 0.3)
    assert kept.schema.names == docs.schema.names
    assert {r.doc_id for r in kept.collect()} & set(good) == {i for i, v in good.items() if v}


def test_flat_trees_equal_recursion():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.BoostedTrees.fit(x, y, trees=20)

    def walk(node, row):
        return model.value[node] if model.left[node] == node else walk(model.left[node] + int(row[model.feature[node]] > model.cut[node]), row)

    by_hand = [1 / (1 + math.exp(-(model.base + sum(walk(r, row) for r in model.roots)))) for row in x[:50]]
    assert np.allclose(model.probability(x[:50]), by_hand)
    assert ((model.probability(x) > 0.5) == (y > 0.5)).mean() > 0.97


def test_language_mixture(spark):
    rows, _, _ = planted()
    by_id = {i: lang for i, _, lang, _ in rows}
    mixed = [(2000, " ".join(["the of and to in that was for"] * 20 + ["der die und nicht ist mit sich auf"] * 10), None, "x")]
    docs = spark.createDataFrame(rows + EDGE + mixed, SCHEMA).withColumn("held_out", fold(F.col("doc_id"), 4) == 2)
    model = langid.MixtureModel.fit(langid.count_by_language(docs.filter(~F.col("held_out"))))
    got = langid.identify(docs, model).collect()
    assert len(got) == len(rows) + len(EDGE) + 1
    assert all(r.lang_pred == by_id[r.doc_id] for r in got if r.doc_id in by_id)
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (900, 901, 902))
    (m,) = (r for r in got if r.doc_id == 2000)
    assert m.lang_pred == "en" and m.languages.startswith("en:0.6") and ",de:0.3" in m.languages
    nothing = langid.MixtureModel.fit(langid.count_by_language(docs.filter("false")))
    assert {r.lang_pred for r in langid.identify(docs.limit(5), nothing).collect()} == {"und"}


def test_hmm_base_counts_and_proper_scores(spark, monkeypatch):
    rows, _, _ = planted(n=120)
    rows = rows + EDGE
    got = hmm.score(spark.createDataFrame(rows, SCHEMA), states=3, rounds=3, head_words=40, emission_words=6, segment=16).collect()
    words = lambda t: (t or "").encode().lower().split() + [b""]
    c = collections.Counter()
    for i, t, _, _ in rows:
        if not held(i, 5, 1):
            c.update(words(t))
    n, v = sum(c.values()), len(c)
    want = sorted((i, held(i, 5, 1), len(words(t)), sum(w in c for w in words(t)), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words(t)), 5)) for i, t, _, _ in rows if i is not None)
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got if r.doc_id is not None) == want
    assert sum(r.score for r in got) > sum(r.base_score for r in got)
    assert all(math.isfinite(r.score) for r in got)


def test_one_state_is_the_base(spark):
    rows, _, _ = planted(n=60)
    got = hmm.score(spark.createDataFrame(rows, SCHEMA), states=1, rounds=0, head_words=10, emission_words=4).collect()
    assert all(abs(r.score - r.base_score) < 1e-6 * r.n_tokens for r in got)


def test_hmm_counts_do_not_depend_on_slices(spark):
    texts = [None, "", "A b a", "É é\u00a0x", "one two  three\tfour " * 30, *[f"w{i % 7} Rare{i}" for i in range(40)]]
    docs = spark.createDataFrame([(i, t or "", i % 5 == 1) for i, t in enumerate(texts)], "doc_id long, text string, held_out boolean").coalesce(1)
    want, train = collections.Counter(), collections.Counter()
    for i, t in enumerate(texts):
        for w in [*hmm.words_of((t or "").encode()), b""]:
            want[w] += 1
            train[w] += i % 5 != 1
    for flush, together in ((400_000, 100_000), (3, 4)):
        counts = hmm.count_tokens(docs, flush, together)
        got = {bytes(r.word): (r.c, r.n) for r in counts.collect()}
        assert got == {w: (train[w], n) for w, n in want.items()}


def test_hmm_learns_rare_words_and_whole_texts(spark):
    # after "a" always comes a rare word of one kind, after "b" one of the other: one class of all the rest cannot tell
    rng = random.Random(5)
    rare = {c: [f"{c}{w}" for w in range(40)] for c in "ab"}
    rows = [(i, " ".join(f"{c} {rng.choice(rare[c])}" for c in [rng.choice("ab")] * 30), "en", "x") for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA)
    loose, fine = (hmm.score(docs, states=2, rounds=12, head_words=10, emission_words=3, words_in_class=n).agg(F.sum("score")).first()[0] for n in (10**9, 1))
    assert fine > loose + 1000
    # batches and segments change no count
    flat = spark.createDataFrame([(np.random.default_rng(i).integers(0, 4, 5 + 3 * i).tolist(),) for i in range(12)], "ids array<int>")
    model = hmm.HiddenMarkov.initial(np.full(4, 0.25), 2)
    got = [hmm.baum_welch(flat, model, np.ones(4), 2, n) for n in (3, 1000)]
    assert np.allclose(got[0][0].start, got[1][0].start, atol=1e-5) and np.allclose(got[0][0].step, got[1][0].step, atol=1e-5)
    assert np.allclose(got[0][1], got[1][1], rtol=1e-5)


def test_forward_equals_sum_over_paths():
    import itertools

    rng = np.random.default_rng(4)
    norm = lambda a, axis: a / a.sum(axis=axis, keepdims=True)
    m = hmm.HiddenMarkov(norm(rng.random(3), 0), norm(rng.random((3, 3)), 1), norm(rng.random((5, 3)), 0))
    seqs = [rng.integers(0, 5, k) for k in (1, 4, 2, 6)]
    flat = np.concatenate(seqs)
    n = np.array([len(s) for s in seqs])
    start = np.cumsum(n) - n
    total = [sum(m.start[p[0]] * np.prod([m.step[a, b] for a, b in zip(p, p[1:])]) * np.prod([m.emit[o, s] for o, s in zip(x, p)]) for p in itertools.product(range(3), repeat=len(x))) for x in seqs]
    assert np.allclose(m.log10_likelihood(flat, start, n), np.log10(total))
    # expected counts: every token is in some state, every step between two
    into = (np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)))
    like = m.expected(flat, start, n, into)
    assert math.isclose(like, np.log(total).sum(), rel_tol=1e-4)
    assert np.allclose(into[2].sum(axis=1), np.bincount(flat, minlength=5), atol=1e-3)
    assert math.isclose(into[1].sum(), (n - 1).sum(), rel_tol=1e-4) and math.isclose(into[0].sum(), 4, rel_tol=1e-4)
    # a path sum for the transition counts of the second sequence
    x, pairs = seqs[1], np.zeros((3, 3))
    for p in itertools.product(range(3), repeat=len(x)):
        w = m.start[p[0]] * np.prod([m.step[a, b] for a, b in zip(p, p[1:])]) * np.prod([m.emit[o, s] for o, s in zip(x, p)])
        for a, b in zip(p, p[1:]):
            pairs[a, b] += w / total[1]
    own = (np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3)))
    m.expected(x.astype(np.int32), np.array([0]), np.array([len(x)]), own)
    assert np.allclose(own[1], pairs, atol=1e-4)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert toxicity.score(empty, labels).count() == 0
    assert quality.score(empty, quality.train(empty, labels, "quality")).count() == 0
    assert hmm.score(empty).count() == 0
    assert langid.identify(empty.withColumn("held_out", F.lit(False)), langid.MixtureModel.fit(langid.count_by_language(empty))).count() == 0
    assert sentencepiece_sampling.round_trip(empty, tokenizer_path("piece_bpe_32k.model")).count() == 0


def test_sampled_segmentations(spark):
    model = tokenizer_path("piece_bpe_32k.model")
    odd = ["▁", " ▁ ▁▁", "  two  blanks ", "\n\n x\t", "🙂é́日本", "<unk> <s> <0x41>", "x" * 5000, "\U0010ffff", "the internationalisation of lattices"]
    rows = [(i, t, "en", "x") for i, t in enumerate(odd)] + EDGE
    docs = spark.createDataFrame(rows, SCHEMA)
    a = sorted(map(tuple, sentencepiece_sampling.round_trip(docs.repartition(1), model).collect()), key=str)
    b = sorted(map(tuple, sentencepiece_sampling.round_trip(docs.repartition(7), model).collect()), key=str)
    assert a == b and len(a) == len(rows)  # the same draws however the rows are dealt
    assert all(r[-1] for r in a)
    encoded = sentencepiece_sampling.encode(docs, model)
    back = sentencepiece_sampling.decode(encoded, model)
    assert sorted(((r.doc_id, r.text) for r in back.collect()), key=str) == sorted(((i, t or "") for i, t, _, _ in rows), key=str)
    other = sorted(map(tuple, sentencepiece_sampling.round_trip(docs, model, seed=1).collect()), key=str)
    assert other != a


def test_sampling_follows_the_weights():
    s = sentencepiece_sampling.Sampler(tokenizer_path("piece_bpe_32k.model"))
    chunk, total = "▁there", {}

    def walk(rest, so_far, weight):
        if not rest:
            total[so_far] = math.exp(weight)
        for k in range(1, len(rest) + 1):
            i = s.pieces.ids.get(rest[:k])
            if i is not None:
                walk(rest[k:], (*so_far, i), weight + s.pieces.weight[i])

    walk(chunk, (), 0.0)
    drawn = collections.Counter(tuple(x.tolist()) for x in s.encode([" there"] * 20000, list(range(20000))))
    assert set(drawn) <= set(total)
    assert max(abs(drawn[p] / 20000 - w / sum(total.values())) for p, w in total.items()) < 0.02


def test_arrays_of_sums_are_few(spark):
    """The second round of adding moves no more than eight arrays, and tasks that leave one are bounded."""
    import numpy as np

    from volspark.llm.common import PARTS, add_arrays, array_parts, in_few

    many = spark.range(0, 400, 1, 100)
    assert in_few(many).rdd.getNumPartitions() <= max(16, 2 * spark.sparkContext.defaultParallelism)

    def run(batches):
        from pyspark import TaskContext

        total = sum(float(np.asarray(b.column("id")).sum()) for b in batches)
        yield from array_parts(np.array([total, 1.0]), TaskContext.get().partitionId())

    parts = many.mapInArrow(run, PARTS)
    assert add_arrays(parts).first()["values"] == [400 * 399 / 2, 100.0]
    assert "pmod(task#" in (plan := add_arrays(parts)._jdf.queryExecution().optimizedPlan().toString()) and ", 8)" in plan

"""Base spans against a plain re search, redaction, and edge cases."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from volspark.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def plain_spans(text):
    out = []
    for kind, form in PLAIN.items():
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(q) <= 255 for q in m[0].split(".")) if kind == "ip" else False,
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def fuzz_texts(n=3000):
    rng = random.Random(5)
    bits = ["4111111111111111", "4111 1111 1111 1111", "+1 (743) 555-3824", "a@b.c", "_d@e.f", "@", ".", "..", "1.2.3.4", "256.1.1.1", "08.8.8.8", "+", "+4", " ", "-", "  ", "x", "é", "🙂", "7", "12", "555", "(555) 123-4567", "555-123-4567", "jo [at] ex [dot] com", "5500005555555559", "\n", "\t", "call ", "mail ", "version "]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(n)]


def test_base_spans_equal_plain_search(spark):
    texts = fuzz_texts() + [None, "", "9" * 30000, "1 " * 20000, "a" * 50000, "+1" + " " * 20000, "1." * 20000, "a.b@" * 5000]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = plain_spans(t or "")
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (t[:200], want, got[i])
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(w.startswith(k) for w in want) for k in pii.KINDS]
        spans = got[i].spans.split(",") if got[i].spans else []
        assert set(want) <= set(spans)
        rank = [(pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert rank == sorted(rank)


def test_redact_keeps_columns_and_clean_texts(spark):
    rows = [(1, "write to a.b@mail.example.com now", "x", 7), (2, "nothing here", None, 8), (3, None, "y", None), (None, "ip 10.2.3.4 and +1 (743) 555-3824.", "z", 1), (2, "nothing here", None, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string, _s int")
    got = sorted(map(tuple, pii.redact(df).collect()), key=str)
    want = [(1, "write to [EMAIL] now", "x", 7), (2, "nothing here", None, 8), (3, None, "y", None), (None, "ip [IP] and [PHONE].", "z", 1), (2, "nothing here", None, 8)]
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find(empty).count() == 0
    assert pii.redact(empty).count() == 0


def test_labelers_learn_from_agreement(spark):
    """Candidates that share the votes of real ones are added, others are not."""
    rows = [(i, f"call our phone +1 (743) 555-{1000 + i} or phone (743) 555-{2000 + i} today") for i in range(60)]
    rows += [(100 + i, f"order serial 4111111111111{i:03d}9 x") for i in range(60)]
    got = pii.find(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got.filter("doc_id < 100").filter(F.size(F.split("spans", ",")) >= 1).count() == 60
    wrong = got.filter("doc_id >= 100 AND n_card = 0 AND spans <> ''").count()
    assert wrong == 0

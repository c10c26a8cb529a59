"""Personal data by weak supervision, in built-in functions only.

Candidate spans are the matches of four base patterns (valid or not) and of a
few looser ones (national phone numbers, spelled-out e-mail addresses).  Six
labelers vote on each: the base rule, the span's shape, a gazetteer, cue words
before it, counter-cues before it, and its borders.  The corpus is reduced to
counts of vote patterns (at most 4 x 3**6 rows); expectation-maximisation over
them estimates how reliable each labeler is and so a probability per pattern.
With these as soft labels, one more aggregation trains the final classifier, a
naive Bayes model over votes and surface features, whose table (a few hundred
numbers) travels as a literal.  Valid base matches always stay; of the other
candidates those with probability >= 0.5 that touch no base span are added.

Positions come from splitting a text at its matches: a span starts after the
pieces and matches before it, counted in code points.  The base patterns are
written so that Java's engine cannot recurse or backtrack over long runs: runs
are possessive and start at their first character (or, for an address, where
the match before ended).

Defined results: a null or empty text has no spans; a repeated id is handled
row by row; columns besides doc_id and text are kept by ``redact`` and ignored
by ``find``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from volspark.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")

#: The base patterns, equal in their matches to the plain forms beside them.
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}",
    # [0-9]([\x20-]?[0-9])+ of 13 to 19 digits
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "contains(_t, '@')", "ip": "contains(_t, '.')", "card": "true", "phone": "contains(_t, '+')"}
#: Looser forms, tried for further spans.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[({](?:at|AT)[\])}]\x20?[A-Za-z0-9-]{1,64}(?:\x20?(?:\.|[\[({](?:dot|DOT)[\])}])\x20?[A-Za-z0-9-]{2,64}){1,5}",
    "phone": r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])",
}
LOOSE_NEEDS = {"email": "rlike(_t, '[\\\\[({](?:at|AT)[\\\\])}]')", "phone": "true"}

#: Fixed word lists of the labelers.
TLDS = "com org net edu gov mil int info biz io co me us uk ca au de fr es it nl be ch at se no dk fi pl pt ru jp cn in br mx ar za eu".split()
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 98".split()
CARD_PREFIXES = "30 34 35 36 37 38 39 4 51 52 53 54 55 6011 62 64 65".split()
SPECIAL_NETS = "0 10 127 224 255".split()
CUES = {
    "email": "e-?mail mail contact kontakt correo courriel write",
    "ip": "ip address host server client adresse",
    "card": "card visa mastercard amex credit karte tarjeta carte payment",
    "phone": "phone tel fax call mobile cell telefon t[eé]l[eé]fono anruf",
}
COUNTER_CUES = "version release build isbn issn order invoice ref serial sku part section chapter figure token hash sha"
VOTES = 6
CONTEXT = 40


def _lit(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _positions(m: str, p: str) -> str:
    """Spans of matches ``m`` between pieces ``p`` as array of (start, end, text)."""
    none = "cast(array() as array<struct<start:int,end:int,text:string>>)"
    return (
        f"CASE WHEN size({m}) > 0 THEN aggregate(sequence(1, size({m})), named_struct('at', 0, 'out', {none}), "
        f"(a, i) -> named_struct('at', a.at + length({p}[i - 1]) + length({m}[i - 1]), 'out', concat(a.out, array(named_struct("
        f"'start', a.at + length({p}[i - 1]), 'end', a.at + length({p}[i - 1]) + length({m}[i - 1]), 'text', {m}[i - 1])))), "
        f"a -> a.out) ELSE {none} END"
    )


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _valid(kind: str, x: str) -> str:
    """The base rule on a match."""
    if kind == "email":
        return "true"
    if kind == "ip":
        return f"forall(split({x}, '[.]'), q -> length(ltrim('0', q)) <= 3 AND cast(concat('0', right(ltrim('0', q), 3)) AS int) <= 255)"
    if kind == "phone":
        return f"length({_digits(x)}) BETWEEN 9 AND 15"
    d = f"cast(substring(n, -i, 1) AS int)"
    luhn = f"aggregate(sequence(1, length(n)), 0, (a, i) -> a + CASE WHEN i % 2 = 1 THEN {d} WHEN {d} > 4 THEN 2 * {d} - 9 ELSE 2 * {d} END) % 10 = 0"
    return f"exists(array({_digits(x)}), n -> {luhn})"


def _vote(yes: str, no: str = "false") -> str:
    return f"CASE WHEN {yes} THEN 1 WHEN {no} THEN -1 ELSE 0 END"


def _candidate(kind: str, s: str, base: str) -> str:
    """A candidate with its votes and surface features, from span ``s``."""
    x = f"{s}.text"
    before = f"substring(_t, greatest({s}.start - {CONTEXT}, 0) + 1, least({s}.start, {CONTEXT}))"
    last = f"CASE WHEN {s}.start > 0 THEN substring(_t, {s}.start, 1) ELSE '' END"
    after = f"substring(_t, {s}.end + 1, 1)"
    digits = _digits(x)
    shape = {
        "email": _vote(f"rlike({x}, '^[A-Za-z0-9][A-Za-z0-9._%+-]{{0,63}}@([A-Za-z0-9][A-Za-z0-9-]{{0,62}}[.])+[A-Za-z]{{2,}}$')", f"NOT rlike({x}, '[A-Za-z]')"),
        "ip": _vote(f"NOT rlike({x}, '(^|[.])0[0-9]')", f"rlike({x}, '[0-9]{{4}}')"),
        "card": _vote(f"rlike({x}, '^([0-9]{{13,19}}|[0-9]{{4}}([ -][0-9]{{4}}){{3}}|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{5}})$')", f"rlike({x}, '[ -][0-9][ -]')"),
        "phone": _vote(f"rlike({x}, '^(\\\\+[0-9]{{1,3}}[ .-]?)?(\\\\([0-9]{{2,4}}\\\\)|[0-9]{{2,4}})[ .-]?[0-9]{{3,4}}[ .-]?[0-9]{{3,4}}$')", f"rlike({x}, '[ .-]{{3}}')"),
    }[kind]
    listed = {
        "email": _vote(f"array_contains(array({', '.join(map(_lit, TLDS))}), lower(regexp_extract({x}, '([A-Za-z0-9-]+)$', 1)))", f"rlike({x}, '[0-9]$')"),
        "ip": _vote(f"NOT array_contains(array({', '.join(map(_lit, SPECIAL_NETS))}), substring_index({x}, '.', 1))", "true"),
        "card": _vote(f"rlike({digits}, '^({'|'.join(CARD_PREFIXES)})')", "true"),
        "phone": _vote(f"rlike({x}, '^\\\\+({'|'.join(CALLING_CODES)})')", f"startswith({x}, '+')"),
    }[kind]
    cue = "(?i)\\\\b(" + "|".join(CUES[kind].split()) + ")"
    counter = "(?i)\\\\b(" + "|".join(COUNTER_CUES.split()) + ")\\\\b"
    votes = [
        _vote(f"{base}", "true") if base != "null" else "0",
        shape,
        listed,
        _vote(f"rlike({before}, '{cue}')"),
        _vote("false", f"rlike({before}, '{counter}')"),
        _vote(f"NOT rlike({last}, '[A-Za-z0-9]') AND NOT rlike({after}, '[A-Za-z0-9]')", "true"),
    ]
    klass = lambda c: f"CASE WHEN {c} = '' THEN 'edge' WHEN rlike({c}, '[A-Za-z]') THEN 'letter' WHEN rlike({c}, '[0-9]') THEN 'digit' WHEN rlike({c}, '[ \\\\t\\\\r\\\\n]') THEN 'blank' ELSE 'mark' END"
    surface = [f"concat('len=', cast(least(length({x}), 40) AS int))", f"concat('digits=', length({digits}))", f"concat('left=', {klass(last)})", f"concat('right=', {klass(after)})", f"concat('seps=', least(length(regexp_replace({x}, '[A-Za-z0-9]', '')), 9))"]
    keep = "false" if base == "null" else base
    return f"named_struct('kind', {_lit(kind)}, 'start', {s}.start, 'end', {s}.end, 'base', {keep}, 'votes', array({', '.join(votes)}), 'surface', array({', '.join(surface)}))"


def with_candidates(docs: DataFrame, columns: list[Column]) -> DataFrame:
    """``columns`` of ``docs`` and ``_base`` (valid base spans) and ``_extra``
    (other candidates), both by kind and start."""
    df = docs.select(*columns, F.coalesce(F.col("text"), F.lit("")).alias("_t"))
    forms = [(k, "b", BASE[k], NEEDS[k]) for k in KINDS] + [(k, "l", LOOSE[k], LOOSE_NEEDS[k]) for k in KINDS if k in LOOSE]
    empty = "cast(array() as array<string>)"
    df = df.select("*", *[F.expr(f"CASE WHEN {need} THEN regexp_extract_all(_t, {_lit(form)}, 0) ELSE {empty} END").alias(f"_{w}_{k}_m") for k, w, form, need in forms])
    df = df.select("*", *[F.expr(f"CASE WHEN size(_{w}_{k}_m) > 0 THEN split(_t, {_lit(form)}, -1) ELSE {empty} END").alias(f"_{w}_{k}_p") for k, w, form, _ in forms])
    df = df.select("*", *[F.expr(_positions(f"_{w}_{k}_m", f"_{w}_{k}_p")).alias(f"_{w}_{k}") for k, w, _, _ in forms])
    found = []
    for k, w, _, _ in forms:
        base = _valid(k, "s.text") if w == "b" else "null"
        found.append(f"transform(_{w}_{k}, s -> {_candidate(k, 's', base)})")
    df = df.select("*", F.expr(f"concat({', '.join(found)})").alias("_all"))
    names = [c for c in df.columns if not c.startswith(("_b_", "_l_"))]
    df = df.select(*names, F.expr("filter(_all, c -> c.base)").alias("_base"))
    apart = "filter(_all, c -> NOT c.base AND NOT exists(_base, b -> c.start < b.end AND b.start < c.end))"
    return df.select(*[c for c in names if c != "_all"], "_base", F.expr(apart).alias("_extra"))


class SpanModel:
    """log odds by kind, and by ``kind|feature``."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def probability_at_least_half(self, c: str) -> str:
        """SQL test on candidate ``c``: is its log odds at least 0?"""
        if not self.weights:
            return "false"
        table = "map(" + ", ".join(f"{_lit(k)}, {v:.12g}D" for k, v in sorted(self.weights.items())) + ")"
        feats = f"concat({c}.surface, transform({c}.votes, (v, j) -> concat('vote', j, '=', v)))"
        return f"aggregate({feats}, coalesce(element_at({table}, {c}.kind), -1D), (a, f) -> a + coalesce(element_at({table}, concat({c}.kind, '|', f)), 0D)) >= 0D"


def train(candidates: DataFrame, rounds: int = 10, smooth: float = 1.0) -> SpanModel:
    """EM over vote patterns, then the classifier; ``candidates`` has ``_base``
    and ``_extra`` and should be written already, as it is read twice."""
    spans = candidates.select(F.explode(F.concat("_base", "_extra")).alias("c")).select("c.kind", "c.votes", "c.surface")
    sure = F.col("votes")[0] == 1  # the base rule's positives are given, not guessed
    patterns = cut_lineage(spans.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).coalesce(1))
    kinds = [r.kind for r in patterns.select("kind").distinct().collect()]
    if not kinds:
        return SpanModel({})
    # start: the base rule is right in 99 of 100 votes, the other labelers in
    # 7 of 10, and half of the candidates are real
    prior = dict.fromkeys(kinds, 0.0)
    weight = {(k, j, v): v * math.log(99 if j == 0 else 7 / 3) for k in kinds for j in range(VOTES) for v in (-1, 0, 1)}

    def posterior() -> Column:
        table = F.create_map(*[F.lit(x) for (k, j, v), w in weight.items() for x in (f"{k}|{j}|{v}", float(w))])
        start = F.create_map(*[F.lit(x) for k, w in prior.items() for x in (k, float(w))])
        odds = start[F.col("kind")]
        for j in range(VOTES):
            odds = odds + table[F.concat_ws("|", "kind", F.lit(str(j)), F.col("votes")[j].cast("string"))]
        return F.when(sure, 1.0).otherwise(1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), odds)))))

    for _ in range(rounds):
        voted = patterns.select("kind", "n", posterior().alias("p"), F.posexplode("votes").alias("j", "v"))
        sums = voted.groupBy("kind", "j", "v").agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no")).collect()
        yes, no = {(r.kind, r.j, r.v): r.yes for r in sums}, {(r.kind, r.j, r.v): r.no for r in sums}
        for k in kinds:
            all_yes, all_no = (sum(x.get((k, 0, v), 0.0) for v in (-1, 0, 1)) for x in (yes, no))
            prior[k] = math.log((all_yes + smooth) / (all_no + smooth))
            for j in range(VOTES):
                for v in (-1, 0, 1):
                    weight[k, j, v] = math.log((yes.get((k, j, v), 0.0) + smooth) / (all_yes + 3 * smooth)) - math.log((no.get((k, j, v), 0.0) + smooth) / (all_no + 3 * smooth))
    feature = F.explode(F.concat("surface", F.expr("transform(votes, (v, j) -> concat('vote', j, '=', v))"))).alias("f")
    soft = spans.select("kind", posterior().alias("p"), feature)
    sums = soft.groupBy("kind", "f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    model = dict(prior)
    totals = {k: (sum(r.yes for r in sums if r.kind == k and r.f.startswith("vote0=")), sum(r.no for r in sums if r.kind == k and r.f.startswith("vote0="))) for k in kinds}
    for r in sums:
        all_yes, all_no = totals[r.kind]
        model[f"{r.kind}|{r.f}"] = math.log((r.yes + smooth) / (all_yes + smooth * 10)) - math.log((r.no + smooth) / (all_no + smooth * 10))
    return SpanModel(model)


def _all_spans(model: SpanModel) -> str:
    """Valid base spans and accepted others, by kind as listed, then start."""
    order = " ".join(f"WHEN {_lit(k)} THEN {i}" for i, k in enumerate(KINDS))
    picked = f"concat(_base, filter(_extra, c -> {model.probability_at_least_half('c')}))"
    return f"array_sort(transform({picked}, c -> named_struct('rank', CASE c.kind {order} END, 'start', c.start, 'end', c.end, 'kind', c.kind)))"


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` per row;
    the counts and the digest are of the base spans."""
    found = cut_lineage(with_candidates(docs, [F.col("doc_id").cast("long").alias("doc_id")]).drop("_t"))
    model = train(found)
    said = lambda spans: f"array_join(transform({spans}, c -> concat(c.kind, ':', c.start, ':', c.end)), ',')"
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(_base, c -> c.kind = {_lit(k)})) as bigint)").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.expr(said("_base")), 256).alias("base_sha256"),
        F.expr(said(_all_spans(model))).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets;
    texts without spans, null ones too, stay as they are."""
    model = train(cut_lineage(with_candidates(docs, []).select("_base", "_extra")))
    rows = with_candidates(docs, [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")])
    spans = f"array_sort(transform({_all_spans(model)}, c -> named_struct('start', c.start, 'end', c.end, 'kind', c.kind)))"
    rows = rows.select("_row", "_t", F.expr(spans).alias("_s"))
    cut = (
        "aggregate(_s, named_struct('at', 0, 'out', ''), (a, c) -> CASE WHEN c.start < a.at THEN named_struct('at', greatest(a.at, c.end), 'out', a.out) "
        "ELSE named_struct('at', c.end, 'out', concat(a.out, substring(_t, a.at + 1, c.start - a.at), '[', upper(c.kind), ']')) END, "
        "a -> concat(a.out, substring(_t, a.at + 1)))"
    )
    text = F.when(F.size("_s") > 0, F.expr(cut)).otherwise(F.col("_row.text"))
    return rows.select(*[text.alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])

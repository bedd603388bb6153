"""Personal data by weak supervision, with built-in functions only.

Candidates are the matches of the four base patterns (whether they pass their
checks or not) and of two looser ones: phone numbers without a plus sign and
e-mail addresses with the at sign spelt out.  Four labelers vote on each (-1, 0
or 1): the strict pattern, a gazetteer (mail domains' endings, card issuers,
reserved networks, dialling codes), the words before the candidate, and its
shape.  Expectation-maximisation over the counts of vote patterns estimates how
reliable each labeler is; its posteriors train a logistic span classifier.  The
classifier decides on the loose candidates; base spans stay in any case, and a
strict match that failed its check digits or ranges is evidence for the model but
is never added.

The model sees only a table of vote patterns (kinds x 3^4 rows at most), so
fitting costs the same whatever the corpus.  Patterns are anchored at the start
of a run (or at the end of the last match) and possessive: linear on runs of any
length, with the same leftmost, non-overlapping matches.

Null counts as empty; texts without candidates give zero counts and empty spans;
repeated rows are judged alike, one result row each; extra columns are not read;
an empty table gives an empty result.  Positions are code points, end exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import written

KINDS = ("email", "ip", "card", "phone")
_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "loose_phone": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
    "loose_email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++\x20?(?:\[at\]|\(at\))\x20?{_LABEL}++(?:\x20?(?:\[dot\]|\(dot\)|\.)\x20?{_LABEL}++)++",
}
#: Cheap tests that a text must pass before its pattern is tried.
NEEDS = {
    "email": "instr(text, '@') > 0",
    "ip": r"text rlike '[0-9]\\.[0-9]'",
    "card": r"text rlike '[0-9](?:[ -]?[0-9]){11}'",
    "phone": "instr(text, '+') > 0",
    "loose_phone": "text rlike '[0-9]{3}[ .-][0-9]{4}'",
    "loose_email": r"text rlike '[\\[(]at[\\])]'",
}
KIND_OF = {p: p.removeprefix("loose_") for p in PATTERNS}
# Gazetteers and context words of the labelers.
ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu", "us", "co", "test")
CONTEXT = {
    "email": "mail|contact|write|reply|kontakt|courriel|correo",
    "ip": "ip|host|server|address|login|from|adresse",
    "card": "card|visa|master|credit|pay|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|ruf|appel|llam",
}
CONTEXT_CHARS = 32
FOUND = "array<struct<s:int,e:int,t:string,c:string>>"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _before(lengths: str, step: int = 64) -> str:
    """For each place of the array ``lengths`` (a name) the sum of what stands before it.

    Sums run within blocks of ``step``, over the blocks of ``step`` blocks, and over those, so that no long array
    grows one by one: the time is linear up to millions of matches.
    """
    def blocks(of: str, total: str) -> str:  # running sums, from 0, of each block; the last one is the block's total
        return (f"transform(sequence(0, greatest(({total}) - 1, 0) div {step}), k -> aggregate(sequence(0, {step - 1}), array(0), "
                f"(a, j) -> concat(a, array(element_at(a, -1) + coalesce(get({of}, {step} * k + j), 0)))))")

    totals = "transform({0}, y -> element_at(y, -1))"
    top = "aggregate(t2, array(0), (a, y) -> concat(a, array(element_at(a, -1) + y)))"
    outer = _let("b2", blocks("t1", "size(t1)"), _let("t2", totals.format("b2"), _let("b3", top,
            "flatten(transform(b2, (y, k) -> transform(slice(y, 1, " + str(step) + "), z -> z + get(b3, k))))")))
    return _let("b1", blocks(lengths, f"size({lengths})"), _let("t1", totals.format("b1"), _let("o1", outer,
                f"flatten(transform(b1, (y, k) -> transform(slice(y, 1, {step}), z -> z + get(o1, k))))")))


def _placed(name: str) -> str:
    """Matches of one pattern with their places, from the matches and the pieces between them."""
    spans = f"""zip_with(m, slice(q, 1, size(m)), (x, b) -> named_struct('s', b + length(x.p), 'e', b + length(x.p) + length(x.h),
        't', x.h, 'c', lower(right(x.p, {CONTEXT_CHARS}))))"""
    placed = _let("m", f"zip_with(slice(p_{name}, 1, size(h_{name})), h_{name}, (x, y) -> named_struct('p', x, 'h', y))",
                  _let("l", "transform(m, x -> length(x.p) + length(x.h))", _let("q", _before("l"), spans)))
    return f"CASE WHEN size(h_{name}) > 0 THEN {placed} ELSE cast(array() as {FOUND}) END"


_DIGITS = "regexp_replace(x.t, '[^0-9]', '')"
_LUHN = f"""(aggregate(sequence(1, length({_DIGITS})), 0, (a, i) -> a + CASE
        WHEN i % 2 = 1 THEN cast(substr(reverse({_DIGITS}), i, 1) as int)
        WHEN cast(substr(reverse({_DIGITS}), i, 1) as int) > 4 THEN 2 * cast(substr(reverse({_DIGITS}), i, 1) as int) - 9
        ELSE 2 * cast(substr(reverse({_DIGITS}), i, 1) as int) END) % 10 = 0)"""
#: Whether a match is a base span.
PASSES = {
    "email": "true",
    "ip": "forall(split(x.t, '[.]'), q -> length(ltrim('0', q)) <= 3 AND cast(concat('0', ltrim('0', q)) as int) <= 255)",
    "card": f"(length({_DIGITS}) BETWEEN 12 AND 19 AND {_LUHN})",
    "phone": f"(length({_DIGITS}) BETWEEN 9 AND 15)",
    "loose_phone": "false",
    "loose_email": "false",
}
_SET = "('" + "','".join(ENDINGS) + "')"
GAZETTEER = {
    "email": f"CASE WHEN lower(regexp_extract(x.t, '([A-Za-z0-9]+)$', 1)) IN {_SET} THEN 1 ELSE -1 END",
    "ip": "CASE WHEN x.t rlike '^(0+|127|255)[.]' THEN -1 ELSE 1 END",
    "card": f"CASE WHEN {_DIGITS} rlike '^(4|5[1-5]|2[2-7]|3[47]|6011|65)' THEN 1 ELSE -1 END",
    "phone": f"CASE WHEN {_DIGITS} rlike '^(1[2-9]|[2-9])' THEN 1 ELSE -1 END",
}
SHAPE = {
    "email": "CASE WHEN x.t rlike '^[^@(]*[A-Za-z]' THEN 1 ELSE -1 END",
    "ip": "CASE WHEN x.t rlike '(^|[.])0[0-9]' OR length(x.t) > 15 THEN -1 ELSE 1 END",
    "card": f"CASE WHEN length({_DIGITS}) IN (13, 15, 16) THEN 1 WHEN length({_DIGITS}) BETWEEN 12 AND 19 THEN 0 ELSE -1 END",
    "phone": "CASE WHEN x.t rlike '[(][0-9]{3}[)]' THEN 1 WHEN x.t rlike '[0-9]{3}[ .-][0-9]{4}$' THEN 0 ELSE -1 END",
}


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, found): every candidate of a text with its kind, place, whether it is a base span, and its votes."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    literal = lambda p: "r'" + p + "'"
    hits = text.select("doc_id", "text", *[
        F.expr(f"CASE WHEN {NEEDS[p]} THEN regexp_extract_all(text, {literal(x)}, 0) ELSE cast(array() as array<string>) END").alias(f"h_{p}")
        for p, x in PATTERNS.items()])
    pieces = hits.select("doc_id", *[f"h_{p}" for p in PATTERNS], *[
        F.expr(f"CASE WHEN size(h_{p}) > 0 THEN split(text, {literal(x)}, -1) ELSE cast(array() as array<string>) END").alias(f"p_{p}")
        for p, x in PATTERNS.items()])
    placed = pieces.select("doc_id", *[F.expr(_placed(p)).alias(p) for p in PATTERNS])

    def voted(p: str) -> str:
        k = KIND_OF[p]
        keep = f"x -> {PASSES[p]} OR length({_DIGITS}) BETWEEN 12 AND 19" if p == "card" else "x -> true"
        return f"""transform(filter({p}, {keep}), x -> named_struct('kind', '{k}', 's', x.s, 'e', x.e, 'base', {PASSES[p]}, 'loose', {str(p != k).lower()},
            'v1', CASE WHEN {PASSES[p]} THEN 1 ELSE -1 END, 'v2', {GAZETTEER[k]},
            'v3', CASE WHEN x.c rlike '({CONTEXT[k]})' THEN 1 ELSE 0 END, 'v4', {SHAPE[k]}))"""

    every = placed.select("doc_id", F.expr("concat(" + ", ".join(voted(p) for p in PATTERNS if not p.startswith("loose")) + ")").alias("strict"),
                          F.expr("concat(" + ", ".join(voted(p) for p in PATTERNS if p.startswith("loose")) + ")").alias("loose"))
    return every.select("doc_id", F.expr(
        "concat(strict, filter(loose, l -> NOT exists(strict, b -> b.base AND l.s < b.e AND b.s < l.e)))").alias("found"))


VOTES = ("v1", "v2", "v3", "v4")


def estimate(patterns: list[dict], rounds: int = 50) -> dict[tuple, float]:
    """Posterior of each vote pattern (kind, v1..v4) by expectation-maximisation over the patterns' counts.

    One reliability per labeler and kind; an abstaining labeler says nothing.  Priors
    keep a kind with few candidates from extremes.
    """
    posterior: dict[tuple, float] = {}
    for kind in KINDS:
        rows = [(tuple(p[v] for v in VOTES), p["n"]) for p in patterns if p["kind"] == kind]
        reliable, share = [0.85, 0.7, 0.7, 0.7], 0.5
        belief: list[float] = []
        for _ in range(rounds):
            belief = []
            for votes, _n in rows:
                odds = math.log(share / (1 - share)) + sum(v * math.log(r / (1 - r)) for v, r in zip(votes, reliable, strict=True))
                belief.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
            total = sum(n for _, n in rows)
            share = min(0.95, max(0.05, (sum(b * n for b, (_, n) in zip(belief, rows, strict=True)) + 1) / (total + 2)))
            for j in range(len(VOTES)):
                right = sum(n * (b if v[j] > 0 else 1 - b) for b, (v, n) in zip(belief, rows, strict=True) if v[j])
                voted = sum(n for v, n in rows if v[j])
                reliable[j] = min(0.98, max(0.55, (right + 7) / (voted + 10)))
        posterior |= {(kind, *votes): b for b, (votes, _) in zip(belief, rows, strict=True)}
    return posterior


def train(patterns: list[dict], posterior: dict[tuple, float], rounds: int = 300, rate: float = 0.5) -> dict[str, list[float]]:
    """Weights (intercept, v1..v4) of a logistic span classifier per kind, fitted to the posteriors."""
    out = {}
    for kind in KINDS:
        rows = [((1.0, *(float(p[v]) for v in VOTES)), posterior[(kind, *(p[v] for v in VOTES))], p["n"]) for p in patterns if p["kind"] == kind]
        w, total = [0.0] * 5, sum(n for _, _, n in rows) or 1
        for _ in range(rounds):
            grad = [1e-3 * x for x in w]
            for x, y, n in rows:
                p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x, strict=True))))))
                for j in range(5):
                    grad[j] += n / total * (p - y) * x[j]
            w = [a - rate * g for a, g in zip(w, grad, strict=True)]
        out[kind] = w
    return out


def _score(weights: dict[str, list[float]]) -> str:
    return "CASE x.kind " + " ".join(
        f"WHEN '{k}' THEN {w[0]!r}D + {w[1]!r}D * x.v1 + {w[2]!r}D * x.v2 + {w[3]!r}D * x.v3 + {w[4]!r}D * x.v4" for k, w in weights.items()) + " END"


def _joined(spans: str) -> Column:
    order = "CASE x.kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END"
    return F.expr(f"""array_join(transform(array_sort(transform({spans}, x -> named_struct('s', x.s, 'k', {order}, 'e', x.e, 'kind', x.kind))),
        x -> concat_ws(':', x.kind, x.s, x.e)), ',')""")


def detect(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_<kind> (base counts), base and spans (``kind:start:end``, comma-joined)."""
    spark = docs.sparkSession
    found = written(spark, candidates(docs), "pii-candidates")
    one = found.select(F.explode("found").alias("x"))
    votes = one.groupBy("x.kind", *[f"x.{v}" for v in VOTES]).agg(F.count("*").alias("n")).collect()  # 4 x 81 rows at most
    patterns = [r.asDict() for r in votes]
    weights = train(patterns, estimate(patterns))
    spans = found.select("doc_id", F.expr("filter(found, x -> x.base)").alias("base"),
                         F.expr(f"filter(found, x -> x.base OR x.loose AND ({_score(weights)}) >= 0D)").alias("all"))
    return spans.select("doc_id", *[F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS],
                        _joined("base").alias("base"), _joined("all").alias("spans"))

"""Personal data by weak supervision: labelers vote on spans, expectation-maximisation weighs them, a classifier decides.

Candidates are spans of exact patterns (e-mail, IP address, card and phone number; these always stay) and
of looser ones: addresses spelled with "(at)" and "(dot)", phone numbers without a plus, cards with other separators. Five labelers vote
for, against or abstain: the pattern, a checksum or range, a gazetteer of introducing words before the span, the
characters around it, and its shape. Votes are counted by pattern of votes, of which there are a bounded number; on these
counts expectation-maximisation estimates how reliable each labeler is, and a logistic classifier of span features is trained
on what it concludes. Every candidate is then scored inside Spark.

DataFrame and SQL functions only; the driver sees counts per pattern of votes and features.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import DataFrame, functions as F

from tapflow.functions import let
from tapflow.llm import shared

KINDS = ("email", "ip", "card", "phone")

#: The exact patterns. Quantifiers that need no way back are possessive, and runs that can't begin a match but
#: at their first character, or where the match before ended, aren't tried elsewhere: long runs take linear time.
EXACT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"[A-Za-z0-9._%+-]{1,64}\x20?[(\[]\x20?(?:at|AT)\x20?[)\]]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[(\[](?:dot|DOT)[)\]])\x20?[A-Za-z0-9-]{1,63}){1,4}",
    "card": r"(?<![0-9])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+A-Za-z])(?:\([0-9]{2,4}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z])",
}
GUARD = {
    ("email", True): "instr({t}, '@') > 0", ("phone", True): "instr({t}, '+') > 0",
    ("email", False): r"{t} RLIKE '[(\\[]\\x20?(?:at|AT)\\x20?[)\\]]'",
}
GAZETTEER = {
    "email": "mail|contact|kontakt|correo|courriel|write|reach", "ip": "ip|host|server|address|from|client",
    "card": "card|visa|master|karte|carte|tarjeta|payment|pay", "phone": "phone|tel|call|mobile|fax|cell|rufnummer|appel",
}
VOTES = ("pattern", "check", "words", "around", "shape")
BLOCK = 256
ACCEPT = 0.5


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _matches(kind: str, pattern: str, exact: bool) -> str:
    """All matches in `text`: start and end in characters, the value and what stands around it.

    Matches and the pieces between them give the places: sums of lengths, by blocks so that many matches stay cheap.
    """
    guard = GUARD.get((kind, exact), "{t} RLIKE '[0-9]'").format(t="text")
    p = _quoted(pattern)
    total = "aggregate(slice(sizes, {first}, {n}), 0, (s, x) -> s + x)"
    start = (
        "aggregate(slice(blocks, 1, i DIV {b}), 0, (s, x) -> s + x) + {rest} + length(pieces[i])"
    ).format(b=BLOCK, rest=total.format(first=f"(i DIV {BLOCK}) * {BLOCK} + 1", n=f"i % {BLOCK}"))
    spans = (
        f"transform(found, (v, i) -> {let('at', start, _struct(kind, exact))})"
    )
    blocks = f"transform(sequence(0, size(sizes) DIV {BLOCK}), b -> {total.format(first=f'b * {BLOCK} + 1', n=BLOCK)})"
    sizes = "zip_with(pieces, found, (x, y) -> coalesce(length(x), 0) + coalesce(length(y), 0))"
    body = let("found", f"regexp_extract_all(t, {p}, 0)", let("pieces", f"split(t, {p}, -1)", let("sizes", sizes, let("blocks", blocks, spans))))
    return let("t", f"if({guard}, text, '')", body)


def _struct(kind: str, exact: bool) -> str:
    return (
        f"named_struct('start', at, 'rank', {KINDS.index(kind)}, 'stop', at + length(v), 'exact', {str(exact).lower()}, 'value', "
        "v, 'before', right(pieces[i], 24), 'after', left(pieces[i + 1], 2))"
    )


def _digits(value: str) -> str:
    return f"regexp_replace({value}, '[^0-9]', '')"


def _luhn(value: str) -> str:
    doubled = "CAST(substr(d, length(d) - i + 1, 1) AS int) * (2 - i % 2)"
    total = f"aggregate(sequence(1, length(d)), 0, (s, i) -> s + {let('x', doubled, 'x - if(x > 9, 9, 0)')})"
    return let("d", _digits(value), f"CASE WHEN length(d) BETWEEN 12 AND 19 THEN {total} % 10 = 0 ELSE false END")


def _valid(kind: str) -> str:
    """Whether the span s passes its kind's check."""
    if kind == "ip":
        part = let("z", "ltrim('0', x)", "length(z) <= 3 AND coalesce(try_cast(z AS int), 0) <= 255")
        return f"forall(split(s.value, '\\\\.'), x -> {part})"
    if kind == "card":
        return _luhn("s.value")
    if kind == "phone":
        return f"length({_digits('s.value')}) BETWEEN 9 AND 15"
    return "true"


def candidates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, base (valid spans of the exact patterns) and more (all other candidates)."""
    rows = docs.select("doc_id", shared.text_of())
    exact = [_matches(k, EXACT[k], True) for k in KINDS]
    loose = [_matches(k, LOOSE[k], False) for k in KINDS if k in LOOSE]
    checked = [f"filter({m}, s -> {_valid(k)})" for k, m in zip(KINDS, exact, strict=True)]
    base = "array_sort(concat({}))".format(", ".join(checked))
    more = "concat({})".format(", ".join(loose))
    return rows.selectExpr("doc_id", f"{base} AS base", f"{more} AS more").selectExpr(
        "doc_id", "base",
        # a looser span that lies over an exact one says nothing new
        "filter(more, s -> NOT exists(base, b -> b.start < s.stop AND s.start < b.stop)) AS more",
    )


def _votes(s: str) -> dict[str, str]:
    """Each labeler's vote on a span: 1, 0 or -1."""
    words = "CASE " + " ".join(
        f"WHEN {s}.rank = {i} THEN if({s}.before RLIKE '(?i)({GAZETTEER[k]})[^0-9@]*$', 1, 0)" for i, k in enumerate(KINDS)
    ) + " END"
    digits = f"length({_digits(f'{s}.value')})"
    check = (
        f"CASE {s}.rank WHEN 0 THEN if({s}.value RLIKE '[A-Za-z]{{2}}$', 1, 0) WHEN 2 THEN if({_luhn(f'{s}.value')}, 1, -1) "
        f"WHEN 3 THEN if({digits} BETWEEN 9 AND 15, 1, -1) ELSE 1 END"
    )
    around = f"if({s}.before RLIKE '[A-Za-z0-9=_/]$' OR {s}.after RLIKE '^[A-Za-z0-9=_/]', -1, if({s}.before RLIKE '(^|[ :(\\n])$', 1, 0))"
    shape = (
        f"CASE WHEN {s}.rank = 0 THEN if(length({s}.value) BETWEEN 6 AND 80, 1, -1) WHEN {s}.rank = 2 THEN "
        f"if({digits} IN (15, 16), 1, 0) WHEN {s}.rank = 3 THEN if({digits} BETWEEN 10 AND 12, 1, 0) ELSE 0 END"
    )
    return {"pattern": f"if({s}.exact, 1, 0)", "check": check, "words": words, "around": around, "shape": shape}


def _features(s: str) -> dict[str, str]:
    """Bounded features of a span that the classifier sees."""
    share = f"(4 * length({_digits(f'{s}.value')})) DIV greatest(length({s}.value), 1)"
    return {
        "kind": f"{s}.rank", "share": share, "length": f"least(length({s}.value) DIV 8, 5)",
        "before": f"if({s}.before RLIKE '[A-Za-z0-9=_/]$', 1, 0)", "after": f"if({s}.after RLIKE '^[A-Za-z0-9=_/]', 1, 0)",
        "words": _votes(s)["words"], "check": _votes(s)["check"],
    }


def reliabilities(counts: list[tuple[tuple[int, ...], int]], rounds: int = 25) -> tuple[float, list[dict], dict]:
    """Expectation-maximisation over vote patterns and how often they occur.

    Returns the share of true spans, for each labeler {(truth, vote): probability}, and each pattern's posterior.
    """
    n = len(VOTES)
    total = sum(c for _, c in counts)
    posterior = {v: min(max(0.5 + 0.2 * sum(v), 0.02), 0.98) for v, _ in counts}
    prior, tables = 0.5, [{} for _ in range(n)]
    for _ in range(rounds if total else 0):
        prior = (1 + sum(posterior[v] * c for v, c in counts)) / (2 + total)
        for j in range(n):
            for truth, vote in product((0, 1), (-1, 0, 1)):
                mass = [(posterior[v] if truth else 1 - posterior[v]) * c for v, c in counts]
                hit = sum(m for m, (v, _) in zip(mass, counts, strict=True) if v[j] == vote)
                # a labeler is taken to be right more often than not
                lean = 1.5 if (vote > 0) == bool(truth) and vote else 0.5 if vote else 1.0
                tables[j][truth, vote] = (hit + lean) / (sum(mass) + 3)
        for v in posterior:
            odds = math.log(prior / (1 - prior))
            odds += sum(math.log(tables[j][1, v[j]] / tables[j][0, v[j]]) for j in range(n))
            posterior[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return prior, tables, posterior


def classifier(examples: list[tuple[tuple[int, ...], float, int]], steps: int = 200, rate: float = 0.5) -> dict[tuple[int, int], float]:
    """Logistic weights {(feature, value): weight} from features, posterior and count; (-1, 0) is the constant."""
    weights: dict[tuple[int, int], float] = {(-1, 0): 0.0}
    rows = [([(-1, 0), *enumerate(f)], p, math.sqrt(c)) for f, p, c in examples]
    total = sum(c for _, _, c in rows) or 1.0
    for _ in range(steps):
        slope: dict[tuple[int, int], float] = {}
        for keys, p, c in rows:
            z = sum(weights.get(k, 0.0) for k in keys)
            error = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - p) * c / total
            for k in keys:
                slope[k] = slope.get(k, 0.0) + error
        for k, s in slope.items():
            weights[k] = weights.get(k, 0.0) * (1 - 1e-3) - rate * 4 * s
    return weights


def _trained(found: DataFrame) -> dict[tuple[int, int], float]:
    votes, features = _votes("s"), _features("s")
    spans = found.select(F.explode(F.concat("base", "more")).alias("s"))
    names = [f"v_{k}" for k in votes] + [f"f_{k}" for k in features]
    counted = spans.selectExpr(
        *[f"{e} AS v_{k}" for k, e in votes.items()], *[f"{e} AS f_{k}" for k, e in features.items()]
    ).groupBy(*names).agg(F.count("*").alias("n"))
    rows = sorted(tuple(r) for r in counted.collect())  # bounded by the values of votes and features
    n = len(votes)
    patterns: dict[tuple[int, ...], int] = {}
    for r in rows:
        patterns[r[:n]] = patterns.get(r[:n], 0) + r[-1]
    _, _, posterior = reliabilities(sorted(patterns.items()))
    return classifier([(r[n:-1], posterior[r[:n]], r[-1]) for r in rows])


def _score(weights: dict[tuple[int, int], float]) -> str:
    terms = [f"{weights[-1, 0]!r}D"]
    for j, expression in enumerate(_features("s").values()):
        cases = " ".join(f"WHEN {v} THEN {w!r}D" for (k, v), w in sorted(weights.items()) if k == j)
        if cases:
            terms.append(f"CASE {expression} {cases} ELSE 0D END")
    return f"1 / (1 + exp(-({' + '.join(terms)})))"


def _listed(spans: str) -> str:
    name = "element_at(array({}), s.rank + 1)".format(", ".join(f"'{k}'" for k in KINDS))
    return f"array_join(transform({spans}, s -> concat({name}, ':', s.start, ':', s.stop)), ',')"


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (kind:start:end by start, then kind).

    Counts and digest are of the exact patterns' spans. `spans` has the looser ones that the classifier accepts too. Null
    texts count as empty; texts without spans have '' there; repeated documents are searched each.
    """
    found = shared.stored(candidates(docs))
    accepted = f"filter(more, s -> {_score(_trained(found))} >= {ACCEPT})"
    return found.selectExpr("doc_id", "base", f"array_sort(concat(base, {accepted})) AS every").selectExpr(
        "doc_id", *[f"CAST(size(filter(base, s -> s.rank = {i})) AS bigint) AS n_{k}" for i, k in enumerate(KINDS)],
        f"sha2({_listed('base')}, 256) AS base_sha256", f"{_listed('every')} AS spans",
    )


"""URL filters by association rules: Spark's FP-growth mines URL token combinations from labelled pages.

Every url is cut into host and path. A list of (verdict, host, path) rules labels the pages that it fits: a rule fits its host
and all subdomains, where the url's path starts with the rule's path; the longest rule (host plus path, in code points) wins.
The pages so labelled are transactions of their url tokens plus a label item; FP-growth (`pyspark.ml.fpm.FPGrowth`, the
distributed parallel FP-growth) finds the frequent token sets, and association rules `tokens => label` with at least
`min_support` of the labelled pages and `min_confidence` are kept. Every page is matched against these rules through an
inverted index (token -> rules): a rule fires when all its tokens are among the page's, which a join on the token and a count
per (page, rule) decide. The firing rule of highest confidence, then support, then most tokens, then verdict `block`
decides the page's verdict; where none fires, `allow`. A page that a fixed rule fits takes that rule's verdict.

Defined cases: a null url or one without `://` has empty host and path, so no fixed rule fits it and only its (empty) token set
is matched, which fires no rule: `allow`. No labelled page: no mined rule. Repeated rows and ids are judged one by one, each by
its url; other columns pass through, and those named like the added ones are replaced.
"""

from __future__ import annotations

import json

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from tapflow.llm import shared

# Fixed values of the contract: (verdict, host, path) in the given order.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
MIN_SUPPORT = 0.02
MIN_CONFIDENCE = 0.9
DEFAULT = "allow"
#: Rows of the rules' token table up to which it is broadcast to the pages (about 100 bytes each); above, a shuffle join.
BROADCAST_ITEMS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDED = ("host", "path", "rule", "verdict", "mined_verdict", "confidence", "tokens")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased) and path (then up to `?`, `#` or the end)."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    host = F.regexp_extract(text, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(text, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def fixed_rule(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text `host + path`, and its verdict; nulls where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, on_host, on_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # longest last, so it wins
        fits = (host == on_host) | host.endswith("." + on_host)
        fits = fits & path.startswith(on_path)
        rule = F.when(fits, F.lit(on_host + on_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a url: host labels, last two labels, top label, path segments, first segment, query keys."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    n = F.size(labels)
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    query = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.split(x, "=")[0]), lambda x: x != "")
    tail = F.when(n >= 2, F.array(F.concat(F.lit("d:"), F.concat_ws(".", F.slice(labels, -2, 2))))).otherwise(F.array())
    top = F.when(n >= 1, F.array(F.concat(F.lit("t:"), F.element_at(labels, -1)))).otherwise(F.array())
    first = F.when(F.size(segments) >= 1, F.array(F.concat(F.lit("f:"), segments[0]))).otherwise(F.array())
    return F.array_distinct(F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("h:"), x)), tail, top,
        F.transform(segments, lambda x: F.concat(F.lit("p:"), x)), first,
        F.transform(keys, lambda x: F.concat(F.lit("q:"), x)),
    ).cast("array<string>"))


def _parsed(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    base = pages.drop(*ADDED)
    host, path = host_and_path(F.col("url"))
    rows = base.withColumns({"host": host, "path": path})
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    return rows.withColumns({"rule": rule, "_label": verdict, "tokens": tokens(F.col("host"), F.col("path"), F.col("url"))})


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules `antecedent => verdict` from rows with `tokens` and `_label`: rule_id, antecedent, verdict, confidence, support, size."""
    items = labelled.select(F.array_union("tokens", F.array(F.concat(F.lit("="), "_label"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(
        (F.size("consequent") == 1) & F.col("consequent")[0].startswith("=")
        & ~F.exists("antecedent", lambda x: x.startswith("="))
    )
    rules = rules.select(
        "antecedent", F.substring(F.col("consequent")[0], 2, 100).alias("verdict"), "confidence", "support",
        F.size("antecedent").alias("size"),
    )
    return shared.stored(rules.withColumn("rule_id", F.monotonically_increasing_id()))


def _in_row(rules: list, tokens: Column) -> Column:
    """The best firing rule of a row, by an inverted index (token -> rule numbers) held as one constant map."""
    index: dict[str, list[int]] = {}
    for number, rule in enumerate(rules):
        for item in rule["antecedent"]:
            index.setdefault(item, []).append(number)
    listed = F.from_json(F.lit(json.dumps(index)), "map<string, array<int>>")
    kinds = "array<struct<antecedent: array<string>, confidence: double, support: double, size: int, blocks: boolean, verdict: string>>"
    table = F.from_json(F.lit(json.dumps([
        {"antecedent": r["antecedent"], "confidence": r["confidence"], "support": r["support"], "size": r["size"],
         "blocks": r["verdict"] == "block", "verdict": r["verdict"]} for r in rules
    ])), kinds)
    candidates = F.array_distinct(F.flatten(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(listed, t), F.array().cast("array<int>")))))
    fired = F.filter(candidates, lambda r: F.forall(F.get(table, r)["antecedent"], lambda x: F.array_contains(tokens, x)))
    return F.array_max(F.transform(fired, lambda r: F.get(table, r).dropFields("antecedent")))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Every page with host, path, rule, verdict, and the mined verdict and its confidence (null where no mined rule fires).

    Where the mined rules hold at most `BROADCAST_ITEMS` tokens in all, their index goes to every task as a constant and
    pages are matched where they are read, without a shuffle; otherwise pages and rules meet in a join on the token.
    """
    rows = _parsed(pages, rules)
    mined = mine(rows.where(F.col("_label").isNotNull()).select("tokens", "_label"), min_support, min_confidence)
    items = mined.select(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    if items <= BROADCAST_ITEMS:
        judged = rows.withColumn("_best", _in_row(mined.orderBy("rule_id").collect(), F.col("tokens")))
    else:
        judged = _joined(rows, mined)
    mined_verdict = F.col("_best.verdict")
    return judged.select(
        *[c for c in rows.columns if c not in ("_row", "_label")],
        F.coalesce(F.col("_label"), mined_verdict, F.lit(DEFAULT)).alias("verdict"),
        mined_verdict.alias("mined_verdict"), F.col("_best.confidence").alias("confidence"),
    )


def _joined(rows: DataFrame, mined: DataFrame) -> DataFrame:
    """The same match for many rules: page tokens join the rules' tokens, a count per (page, rule) tells which fire."""
    rows = shared.stored(rows.withColumn("_row", F.monotonically_increasing_id()))
    index = mined.select(F.explode("antecedent").alias("item"), "rule_id", "size", "verdict", "confidence", "support")
    hits = rows.select("_row", F.explode("tokens").alias("item")).join(index, "item")
    fired = hits.groupBy("_row", "rule_id", "size", "verdict", "confidence", "support").count().where(F.col("count") == F.col("size"))
    order = F.struct("confidence", "support", "size", (F.col("verdict") == "block").alias("blocks"), "verdict")
    best = fired.groupBy("_row").agg(F.max(order).alias("_best"))
    return rows.join(best, "_row", "left")

import hashlib
import random
import re

from tapflow.llm import personal as X
from tests.llm.helpers import docs, odd_docs

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def spans(text):
    found = [(m.start(), i, m.end(), k) for i, k in enumerate(PATTERNS) for m in re.finditer(PATTERNS[k], text or "") if valid(k, m.group())]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


def texts():
    rnd = random.Random(5)
    out = ["".join(rnd.choice("aB1.@+- ()12é😀45") for _ in range(rnd.randrange(150))) for _ in range(1500)]
    out += ["a@b.c+d@e.f.. x@y.z", "a@b.c@d.e@f", "1" * 60_000, "a" * 60_000 + "@", "4111 1111-1111 1111 4111111111111112", "000255.1.1.1 256.1.1.1 1.2.3.4.5.6.7.8"]
    out += [" ".join(f"u{i}@b.co +1 (555) 010-{i:04}" for i in range(900)), None, "", "+1-22.333(444) 55"]
    return out


def test_exact_spans_equal_brute_force(spark):
    given = texts()
    rows = {r.doc_id: r for r in X.find(docs(spark, given)).collect()}
    for i, text in enumerate(given):
        own = spans(text)
        assert rows[i].base_sha256 == hashlib.sha256(",".join(own).encode()).hexdigest()
        assert [rows[i][f"n_{k}"] for k in X.KINDS] == [sum(s.startswith(k) for s in own) for k in X.KINDS]
        assert set(own) <= {*rows[i].spans.split(",")}


def test_looser_spans_are_added_and_clean_texts_left_alone(spark):
    given = ["mail jo (at) ex (dot) com now, call (415) 555-1234 or 415.555.1234; visa 4111.1111.1111.1111 x", "at 3 (at) most, 12.5 of 300.400 and 1999-2000"]
    given += [f"write to u{i}@mail.example.com, call +1 (415) 555-{i:04}" for i in range(200)]
    rows = {r.doc_id: r.spans for r in X.find(docs(spark, given)).collect()}
    assert rows[0] == "email:5:25,phone:36:50,phone:54:66,card:73:92" and rows[1] == ""
    assert rows[2] == "email:9:28,phone:35:52"


def test_expectation_maximisation_finds_a_bad_labeler():
    rnd = random.Random(2)
    counts: dict[tuple[int, ...], int] = {}
    for _ in range(4000):
        truth = rnd.random() < 0.6
        vote = tuple((1 if truth else -1) * (1 if rnd.random() < right else -1) for right in (0.9, 0.9, 0.85, 0.8, 0.5))
        counts[vote] = counts.get(vote, 0) + 1
    prior, tables, posterior = X.reliabilities(sorted(counts.items()))
    assert abs(prior - 0.6) < 0.06 and tables[0][1, 1] > 0.85 and abs(tables[4][1, 1] - 0.5) < 0.06
    assert posterior[(1, 1, 1, 1, -1)] > 0.95 > 0.05 > posterior[(-1, -1, -1, -1, 1)]
    weights = X.classifier([((1,), 0.95, 100), ((0,), 0.05, 100)])
    assert weights[-1, 0] + weights[0, 1] > 0 > weights[-1, 0] + weights[0, 0]


def test_odd_rows_and_empty_tables(spark):
    odd = odd_docs(spark)
    rows = X.find(odd).collect()
    assert len(rows) == odd.count() and all(r.spans == "" for r in rows)
    assert X.find(odd.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    for frame in (X.candidates(docs(spark, ["a"])), X.find(docs(spark, ["a"]))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)

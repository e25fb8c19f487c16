import hashlib
import itertools
import random
import re
import zlib

import pytest

from tapflow.llm import conversations as X

ROLES = ["system", "user", "assistant", "tool", None]
TEXTS = ["Hello there.", "ok", "  ", "Why?", None, "fine!", "same.", "same.", "cut off", ""]
MOVES = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def damage(rows):
    """The contract's damage and faults by hand: per conversation, rows in order with their fault."""
    out = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        h = zlib.crc32(key.encode()) % 20
        role = " " if role is None else role
        text = " " if text is None else text
        out.setdefault(conv, [])
        if h == 0:
            continue
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub(r"[.!?]", "", text)
        if h == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (2 if h == 3 else 1)
    result = {}
    for conv, rs in out.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faulted = set(), []
        for turn, role, text in rs:
            stripped = text.rstrip(" \t\n\x0b\x0c\r")
            fault = None
            if not stripped.strip(" \t\n\x0b\x0c\r"):
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif stripped[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            faulted.append((turn, role, text, fault))
        result[conv] = faulted
    return result


def brute_force(rows, max_inserts=2):
    """All edit sequences with up to two inserts; cheapest, then least audit."""
    n, best = len(rows), None
    gaps = [(g, r) for g in range(n + 1) for r in "ua"]
    for edits in itertools.product("KRD", repeat=n):
        for k in range(max_inserts + 1):
            for inserts in itertools.combinations_with_replacement(gaps, k):
                for r_roles in itertools.product("ua", repeat=edits.count("R")):
                    cost, audit, lines, state, rr, ok = 0, [], [], 0, iter(r_roles), True
                    for g in range(n + 1):
                        for gap, role in sorted(inserts):
                            if gap == g:
                                cost += 5
                                audit.append("I")
                                lines.append(("user" if role == "u" else "assistant") + ":")
                                state = MOVES[state].get(role, -1) if state >= 0 else -1
                        if g == n:
                            break
                        turn, role, text, fault = rows[g]
                        e = edits[g]
                        audit.append(e)
                        if e == "D":
                            cost += 2
                            continue
                        if fault in ("blank", "duplicate"):
                            ok = False
                            break
                        cost += 5 if fault == "truncated" else 0
                        if e == "R":
                            cost += 1
                            new = next(rr)
                            role = "user" if new == "u" else "assistant"
                        lines.append(f"{role}:{text}")
                        state = MOVES[state].get(role[:1], -1) if state >= 0 else -1
                    if ok and state in (0, 3):
                        key = (cost, "".join(audit), "\n".join(lines))
                        best = key if best is None or key[:2] < best[:2] else best
    return best


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def random_rows(seed, convs, most):
    rnd = random.Random(seed)
    rows = []
    for c in range(convs):
        conv = None if c == 0 else c
        for _ in range(rnd.randint(0, most)):
            rows.append((conv, rnd.choice([None, *range(6)]), rnd.choice(ROLES), rnd.choice(TEXTS)))
    return rows


def test_equals_brute_force(spark):
    rows = random_rows(5, 60, 4)
    got = {r.conv_id: r for r in X.repair(table(spark, rows)).collect()}
    truth = damage(rows)
    assert set(got) == set(truth)
    for conv, faulted in truth.items():
        if len(faulted) > 4:
            continue
        cost, audit, text = brute_force(faulted)
        r = got[conv]
        assert (r.cost, r.audit, r.repaired_sha256) == (cost, audit, hashlib.sha256(text.encode()).hexdigest()), (conv, faulted)
        assert (r.blank, r.duplicate, r.truncated) == tuple(sum(f == k for *_, f in faulted) for k in ("blank", "duplicate", "truncated"))
        initials = [role[:1] for _, role, _, _ in faulted]
        assert r.illegal == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = {t for t, *_ in faulted if t is not None}
        assert r.gaps == (max(turns) - min(turns) + 1 - len(turns) if turns else 0)


def plain_viterbi(faulted):
    """The same optimum by a Viterbi that keeps whole audit strings per state (no coalescence)."""
    def closure(best):
        changed = True
        while changed:
            changed = False
            for s, (c, a, ls) in list(best.items()):
                for ini, to in MOVES[s].items():
                    if ini in "ua":
                        cand = (c + 5, a + "I", ls + [("user" if ini == "u" else "assistant") + ":"])
                        if to not in best or cand[:2] < best[to][:2]:
                            best[to], changed = cand, True
        return best
    best = closure({0: (0, "", [])})
    for _, role, text, fault in faulted:
        nxt = {}
        def offer(s, cand):
            if s not in nxt or cand[:2] < nxt[s][:2]:
                nxt[s] = cand
        for s, (c, a, ls) in best.items():
            offer(s, (c + 2, a + "D", ls))
            if fault in ("blank", "duplicate"):
                continue
            pen = 5 if fault == "truncated" else 0
            if role[:1] in MOVES[s]:
                offer(MOVES[s][role[:1]], (c + pen, a + "K", ls + [f"{role}:{text}"]))
            for ini, to in MOVES[s].items():
                if ini in "ua":
                    offer(to, (c + 1 + pen, a + "R", ls + [("user" if ini == "u" else "assistant") + ":" + text]))
        best = closure(nxt)
    return min((best[s] for s in (0, 3) if s in best), key=lambda x: x[:2])


def test_long_conversation_equals_plain_viterbi(spark):
    rnd = random.Random(9)
    rows = [(7, t, rnd.choice(ROLES[:3]), rnd.choice(TEXTS)) for t in range(3000)] + [(8, None, None, None)]
    got = {r.conv_id: r for r in X.repair(table(spark, rows)).collect()}
    truth = damage(rows)
    cost, audit, lines = plain_viterbi(truth[7])
    assert (got[7].cost, got[7].audit, got[7].repaired_sha256) == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    assert len(got[7].audit) >= len(truth[7]) > 2500


def test_empty_and_dropped(spark):
    assert X.repair(table(spark, [])).count() == 0
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    r = X.repair(table(spark, [(dropped, 1, "user", "hi.")])).collect()
    assert [(r[0].conv_id, r[0].cost, r[0].audit, r[0].repaired_sha256, r[0].gaps)] == [(dropped, 0, "", hashlib.sha256(b"").hexdigest(), 0)]

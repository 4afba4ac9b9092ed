import hashlib
import itertools
import random
import re
import zlib

from ledgerlens.llm import conversation_repair as C

PATTERN = re.compile(r"(s?(ua)+)?\Z")
FAULTS = ("", "", "blank", "duplicate", "truncated")


def cheapest(rows, keep=0, rerole=1, delete=2, insert=5, truncated=5):
    """(cost, audit, repaired text) by trying all edits, two insertions at a place at most."""
    gaps = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    best = None
    for added in itertools.product(gaps, repeat=len(rows) + 1):
        for edits in itertools.product(("D", "K", "user", "assistant"), repeat=len(rows)):
            cost, audit, out = 0, "", []
            for (role, text, fault), edit, before in zip([*rows, (None, None, None)], [*edits, None], added, strict=True):
                cost += insert * len(before)
                audit += "I" * len(before)
                out += [(r, "") for r in before]
                if edit is None:
                    continue
                if edit == "D":
                    cost, audit = cost + delete, audit + "D"
                    continue
                if fault in ("blank", "duplicate"):
                    break
                cost += (truncated if fault == "truncated" else 0) + (keep if edit == "K" else rerole)
                audit += "K" if edit == "K" else "R"
                out.append((role if edit == "K" else edit, text))
            else:
                if PATTERN.match("".join(r[:1] or "?" for r, _ in out)):
                    found = (cost, audit, "\n".join(f"{r}:{t}" for r, t in out))
                    best = found if best is None or found[:2] < best[:2] else best
    return best


def run(rows):
    path = C.Repair()
    for row in rows:
        path.add(*row)
    return path.result()


def random_rows(rng, n):
    return [(rng.choice(["user", "assistant", "system", "tool", ""]), f"text {rng.random()}.", rng.choice(FAULTS))
            for _ in range(n)]


def agrees(rows, **costs):
    cost, audit, text = cheapest(rows, **costs)
    assert run(rows) == (cost, audit, hashlib.sha256(text.encode()).hexdigest()), rows


def test_cheapest_edits_against_brute_force():
    rng = random.Random(1)
    for n in (0, 1, 2, 2, 3, 3, 3):
        agrees(random_rows(rng, n))
    agrees([("system", "a.", ""), ("user", "b.", ""), ("user", "c.", "")])


def test_insertions_where_they_are_cheap(monkeypatch):
    monkeypatch.setattr(C, "INSERT", 1)
    monkeypatch.setattr(C, "DELETE", 4)
    monkeypatch.setattr(C, "REROLE", 3)
    rng = random.Random(2)
    for n in (0, 1, 2, 2, 3, 3):
        agrees(random_rows(rng, n), insert=1, delete=4, rerole=3)


def plain(rows):
    """(cost, audit) without insertions: ordered pairs in place of integers."""
    best = {C.START: (0, "")}
    for role, _, fault in rows:
        new = {}
        for state, (cost, audit) in best.items():
            options = [(state, 2, "D")]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                options += [(C.NEXT.get((state, role[:1])), more, "K")]
                options += [(C.NEXT.get((state, r)), 1 + more, "R") for r in "ua"]
            for after, add, letter in options:
                if after is not None:
                    new[after] = min(new.get(after, (10**9, "")), (cost + add, audit + letter))
        best = new
    return min(best[s] for s in C.FINAL if s in best)


def test_long_conversations_need_no_wide_numbers():
    rng = random.Random(3)
    for n in (60, 200, 3000):
        rows = random_rows(rng, n)
        cost, audit, _ = run(rows)
        assert (cost, audit) == plain(rows) and len(audit) == n


def expected(rows):
    """Brute-force version of the query for short conversations: {conv: all columns}."""
    out = {}
    space = lambda x: " " if x is None else str(x)
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            h = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
            role, text = space(role), space(text)
            text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            role = "user" if h == 4 else role
            kept += [(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns, seen, coded = [t for t, _, _ in kept if t is not None], set(), []
        for _, role, text in kept:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            coded.append((role, text, "blank" if not bare else "duplicate" if (role, text) in seen
                          else "truncated" if bare[-1] not in ".!?" else ""))
            seen.add((role, text))
        steps = [(a[0][:1] + b[0][:1]) for a, b in itertools.pairwise(coded)]
        cost, audit, fixed = cheapest(coded)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     *(sum(f == name for _, _, f in coded) for name in ("blank", "duplicate", "truncated")),
                     sum(s not in ("su", "ua", "au") for s in steps), cost, audit,
                     hashlib.sha256(fixed.encode()).hexdigest())
    return out


def test_query_against_brute_force(spark):
    rng = random.Random(4)
    texts = ["Yes.", "No!", "cut off", "", " \n", "Same.", None, "Ende… 🙂."]
    rows = [(c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", "system", None]), rng.choice(texts))
            for c in [None, *range(40)] for t in range(rng.randint(1, 2))]
    rows += [(100, 0, "user", "Hello."), (100, 9, "assistant", "Hi."), (100, 9, "assistant", "Hi.")]
    frame = spark.createDataFrame([(*r, "own") for r in rows], "conv_id long, turn long, role string, text string, fault string")
    got = C.repair(spark, C.damaged(frame)).collect()
    assert {r[0]: tuple(r)[1:] for r in got} == expected(rows) and len(got) == 42
    assert C.repair(spark, C.damaged(frame.where("false"))).count() == 0


def test_one_long_conversation_among_short_ones(spark):
    rows = [(0, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(4000)] + [(1, 0, "user", "x " * 200_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in C.repair(spark, C.damaged(frame)).collect()}
    assert len(got[0].audit) >= 3500 and set(got[0].audit) <= set("DKR")
    assert got[1].truncated + got[1].blank <= 1 and got[1].audit in ("", "D", "DD")

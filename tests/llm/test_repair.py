"""Repairs against all repairs of short conversations, tried one by one."""

import hashlib
import heapq
import random
import re
import zlib
from itertools import product

import pytest

from reachgrid.llm import repair
from reachgrid.llm.queries import conversation_repair

TURNS = "conv_id long, turn long, role string, text string, audit string, row int, digest string"
LEGAL = re.compile(r"(s?(ua)+)?")


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = text.strip(" \t\n\x0b\x0c\r")
        if not solid:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute_repair(rows):
    """Cost, audit and rows of the cheapest repair, by a search over whole prefixes."""
    faults = faults_of(rows)
    heap = [(0, "", 0, "", ())]
    most = 4 * len(rows) + 3
    done = set()
    while heap:
        cost, audit, at, roles, out = heapq.heappop(heap)
        if at == len(rows) and LEGAL.fullmatch(roles):
            return cost, audit, list(out)
        if (audit, roles, at) in done or cost > most or not LEGAL.fullmatch(roles) and not (
            LEGAL.fullmatch(roles + "a") or LEGAL.fullmatch(roles + "ua")
        ):
            continue
        done.add((audit, roles, at))
        for name in ("user", "assistant"):
            heapq.heappush(heap, (cost + 3, audit + "I", at, roles + name[0], (*out, (name, ""))))
        if at < len(rows):
            (role, text), fault = rows[at], faults[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, roles, out))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                options = [("K", role, 0), ("R", "user", 3), ("R", "assistant", 3)]
                for edit, name, price in options:
                    if name[:1]:
                        heapq.heappush(heap, (
                            cost + price + extra, audit + edit, at + 1,
                            roles + name[0], (*out, (name, text)),
                        ))
    raise AssertionError("no repair")


def brute_report(rows):
    """All of a report from the rows (turn, role, text) of one conversation."""
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest())
    rows = sorted(rows, key=key)
    plain = [(role, text) for _, role, text in rows]
    faults = faults_of(plain)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = zip(plain, plain[1:])
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in pairs)
    cost, audit, out = brute_repair(plain)
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    whole = "\n".join(f"{r}:{t}" for r, t in out)
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest())


def test_every_short_signature():
    """All signatures of up to three rows, in the order in which suffixes are shared."""
    texts = {False: "fine.", True: "cut"}
    rows = {"x": ("user", " ")}
    for cut, (initial, role) in product((False, True), zip("suao", ("system", "user", "assistant", "tool"))):
        rows[initial.upper() if cut else initial] = (role, texts[cut])
    suffixes = repair.Suffixes()
    symbols = sorted(rows)
    found = [s for n in range(4) for s in map("".join, product(symbols, repeat=n))]
    for signature in sorted(found, key=lambda s: s[::-1]):
        turns = [(rows[s][0], rows[s][1] if s == "x" else f"{i} {rows[s][1]}")
                 for i, s in enumerate(signature)]
        cost, audit, _ = brute_repair(turns)
        assert suffixes.repair(signature) == (cost, audit), signature


def test_shared_suffixes_are_computed_once():
    suffixes, pushed = repair.Suffixes(), []
    push = suffixes._push
    suffixes._push = lambda symbol: (pushed.append(symbol), push(symbol))
    for signature in sorted(["ua", "uaua", "sua", "xua", "u"], key=lambda s: s[::-1]):
        suffixes.repair(signature)
    assert len(pushed) == len({"a", "ua", "aua", "uaua", "sua", "xua", "u"})


def some_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(0, 5)):
            role = rng.choice(["user", "assistant", "system", "tool", None, ""])
            text = rng.choice(["a.", "b!", "c", None, "", "d? \n", "e e e.", "ü。"])
            number = rng.choice([turn, turn, turn + 3, None])
            rows += [(conv if conv % 9 else None, number, role, text, None, None, None)]
    return rows


def test_reports_and_rows(spark):
    rows = some_rows(3, 120)
    frame = spark.createDataFrame(rows, TURNS).repartition(4)
    extra = spark.createDataFrame([(777,), (1,)], "conv_id long")
    found, edited = repair.repair(frame, ids=extra)
    by_conv = {777: []}
    for conv, turn, role, text, *_ in rows:
        by_conv.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    by_conv = {c: r for c, r in by_conv.items() if c is not None}  # the null one is too long to search
    by_conv.setdefault(1, [])
    out = {}
    for r in edited.collect():
        out.setdefault(r.conv_id, []).append(r)
    got = {r.conv_id: r for r in found.collect()}
    assert set(got) == {*by_conv, None}
    for conv, own in by_conv.items():
        r = got[conv]
        kept = sorted((x for x in out.get(conv, []) if x.edit != "D"), key=lambda x: x.place)
        assert [x.place for x in kept] == list(range(len(kept)))
        whole = "\n".join(f"{x.role}:{x.text}" for x in kept)
        digest = hashlib.sha256(whole.encode()).hexdigest()
        report = (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digest)
        assert report == brute_report(own), conv


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = [
        (conv, turn, rng.choice(["user", "assistant", "system"]), rng.choice(["One. Two!", "cut", "x?"]))
        for conv in range(400)
        for turn in range(rng.randint(1, 5))
    ]
    rows += [(1000, None, None, None), (1000, 3, "user", None), (None, 1, "user", "Who?"), (-5, 2, "user", "Hi.")]
    rows += [(2000, 1, "user", "Same."), (2000, 1, "user", "Same.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet"
    )
    damaged = {conv: [] for conv, *_ in rows}
    blank = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{blank(conv)}:{blank(turn)}".encode()) % 20
        role, text = blank(role), blank(text)
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        damaged[conv] += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    got = {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
        for r in conversation_repair(spark, str(tmp_path)).collect()
    }
    assert got == {conv: brute_report(own) for conv, own in damaged.items()}


def test_long_conversation_and_no_rows(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"{i}.") for i in range(5_001)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found, edited = repair.repair(frame)
    report = found.first()
    assert (report.cost, report.audit) == (3, "K" * 5_001 + "I")
    assert edited.count() == 5_002
    found, edited = repair.repair(frame.limit(0))
    assert found.count() == 0 and edited.count() == 0


@pytest.mark.parametrize("n", [3, 40])
def test_deep_repairs_stay_consistent(n):
    """The audit's own cost is the cost to go."""
    rng = random.Random(n)
    found = sorted(("".join(rng.choices("suaoxSUAO", k=n)) for _ in range(300)), key=lambda s: s[::-1])
    suffixes = repair.Suffixes()
    for signature in found:
        cost, audit = suffixes.repair(signature)
        kept = [e for e in audit if e != "I"]
        paid = sum({"K": 0, "R": 3, "D": 4, "I": 3}[e] for e in audit)
        paid += 3 * sum(s.isupper() and e != "D" for s, e in zip(signature, kept))
        assert len(kept) == n and paid == cost

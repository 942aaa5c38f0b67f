import hashlib
import heapq
import random
import re
import zlib

from tradewinds.llm import conversation_repair as cr

STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}


def search(codes):
    """Least (cost, audit) by trying all sequences of edits, cheapest first."""
    heap = [(0, "", 0, "")]
    while True:
        cost, audit, i, last = heapq.heappop(heap)
        if i == len(codes) and last in ("", "a"):
            return cost, audit
        if i < len(codes):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last))
            extra = 5 * codes[i].isupper()
            for role in "sua":
                if codes[i] != "x" and (last, role) in STEP:
                    if role == codes[i].lower():
                        heapq.heappush(heap, (cost + extra, audit + "K", i + 1, role))
                    elif role != "s":
                        heapq.heappush(heap, (cost + extra + 1, audit + "R", i + 1, role))
        for role in "ua":
            if (last, role) in STEP:
                heapq.heappush(heap, (cost + 5, audit + "I", i, role))


def test_cells_like_exhaustive_search():
    pick = random.Random(1)
    for _ in range(400):
        codes = "".join(pick.choice("suaoSUAOxuaua") for _ in range(pick.randint(0, 6)))
        assert cr.cheapest(cr.span_cells(codes)) == search(codes), codes


def test_splits_give_the_same_cells():
    pick = random.Random(2)
    for _ in range(50):
        codes = "".join(pick.choice("suaoSUAOx") for _ in range(40))
        cut = pick.randint(1, 39)
        assert cr.joined(cr.span_cells(codes[:cut]), cr.span_cells(codes[cut:])) == cr.span_cells(codes)


def report(conv, rows):
    """Brute force over one conversation: rows of (turn, role, text) in order."""
    seen, codes, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        body = text.strip(cr.BLANKS)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        letter = role[0] if role[:1] in ("s", "u", "a") else "o"
        codes += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
    cost, audit = search(codes) if len(codes) < 12 else cr.cheapest(cr.span_cells(codes))
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    kept = len(audit) - audit.count("D")
    roles = (["system"] if kept % 2 else []) + ["user", "assistant"] * (kept // 2)
    lines, left = [], iter(rows)
    for letter in audit:
        role, text = ("", "") if letter == "I" else next(left)[1:]
        if letter != "D":
            lines.append((role if letter == "K" else roles[len(lines)]) + ":" + text)
    return (conv, gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def hurt(rows):
    out = {}
    for conv, turn, role, text, *_ in rows:
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if hit == 1 else re.sub("[.!?]", "", text or " ") if hit == 2 else " " if text is None else text
        role = "user" if hit == 4 else " " if role is None else role
        out.setdefault(conv, []).extend([(turn, role, text)] * (hit != 0) * (2 if hit == 3 else 1))
    for conv in out:
        out[conv].sort(key=lambda r: (r[0] is not None, r[0] or 0))
    return out


def test_reports_like_brute_force(spark):
    pick = random.Random(3)
    texts = ["Hello there.", "What?", "no end", "  ", "", None, "Yes!\n", "Hello there.", "a.b", "Größe."]
    rows = [(conv, turn, pick.choice(["user", "assistant", "system", "tool", None, ""]), pick.choice(texts), "x", 1)
            for conv in (1, 2, 3, None, 50) for turn in [*range(0, 9), 12, None][:pick.randint(1, 11)]]
    rows += [(7, turn, "user" if turn % 2 else "assistant", f"{turn}.", "x", 1) for turn in range(300)]
    lost = next(i for i in range(1000, 2000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((lost, 0, "user", "gone.", "x", 1))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, copies string, digest long").repartition(3)
    got = sorted((tuple(r) for r in cr.reports(cr.damaged(df)).collect()), key=str)
    assert got == sorted((report(c, r) for c, r in hurt(rows).items()), key=str)
    assert (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got


def test_one_conversation_over_many_tasks(spark):
    """Repeated texts and long conversations: as many turns as all others together, in eight tasks."""
    rows = [(1, i, "user" if i % 2 else "assistant", "Same again." if i % 3 == 0 else f"Turn {i}.") for i in range(4000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert cr.parsed(cr.coded(cr.turns(df))).count() > 4
        assert [tuple(r) for r in cr.reports(cr.turns(df)).collect()] == [report(1, [r[1:] for r in rows])]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repaired_turns(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "user", "Go on."), (1, 2, "user", "Go on."), (1, 3, "assistant", "Fine."), (2, 0, "user", " ")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [tuple(r) for r in cr.repaired_turns(cr.turns(df)).orderBy("conv", "nth").collect()]
    assert got == [(1, 0, "K", "user", "Go on."), (1, 1, "K", "assistant", "Fine.")]
    assert cr.reports(cr.turns(df.limit(0))).count() == 0

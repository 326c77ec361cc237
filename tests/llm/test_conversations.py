import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from marketgrain.llm import op11_suffix_dawg as dawg

SPACE = " \t\n\x0b\x0c\r"
WANTED = re.compile(r"(s?(ua)+)?")


def hurt(conv, turn, role, text):
    role, text = (" " if x is None else x for x in (role, text))
    name = ":".join(" " if x is None else str(x) for x in (conv, turn))
    h = zlib.crc32(name.encode()) % 20
    if h == 0:
        return []
    if h == 1:
        text = ""
    if h == 2:
        text = re.sub("[.!?]", "", text)
    if h == 4:
        role = "user"
    return [(turn, role, text)] * (2 if h == 3 else 1)


def fault_of(role, text, seen):
    bare = text.strip(SPACE)
    if not bare:
        return "blank"
    if (role, text) in seen:
        return "duplicate"
    return "sound" if bare[-1] in ".!?" else "truncated"


def cheapest(rows, faults):
    """Least (cost, audit, repaired) by a table over (row, grammar state), forwards
    through all prefixes with whole strings."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", ())}

    def offer(table, state, value):
        if state is not None and (state not in table or value < table[state]):
            table[state] = value

    def inserted(table):
        for _ in range(3):
            for state, (cost, audit, out) in list(table.items()):
                for name in ("user", "assistant"):
                    offer(table, step.get((state, name[0])), (cost + 3, audit + "I", (*out, (name, ""))))
        return table

    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        # every state keeps its least audit; an audit fixes the number of rows and so the roles
        for state, (cost, audit, out) in inserted(best).items():
            offer(after, state, (cost + 4, audit + "D", out))
            if fault in ("sound", "truncated"):
                more = 3 if fault == "truncated" else 0
                offer(after, step.get((state, role[:1])), (cost + more, audit + "K", (*out, (role, text))))
                for name in ("user", "assistant"):
                    offer(after, step.get((state, name[0])), (cost + more + 3, audit + "R", (*out, (name, text))))
        best = after
    ends = [v for s, v in inserted(best).items() if s in ("", "a")]
    return min(ends, key=lambda v: (v[0], v[1]))


def expected(table, harm=hurt):
    convs = {}
    for conv, turn, role, text in table:
        convs.setdefault(conv, []).extend(harm(conv, turn, role, text))
    out = []
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, faults = set(), []
        for _, role, text in rows:
            faults.append(fault_of(role, text, seen))
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))  # noqa: B905
        cost, audit, mended = cheapest(rows, faults)
        assert WANTED.fullmatch("".join(r[:1] for r, _ in mended))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in mended).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=str)


def table(seed, convs=120):
    rng, rows = random.Random(seed), []
    texts = ["Yes.", "No!", "Why?", "and then", "", " \t", "Fine. \n", "x" * 3000 + ".", "日本。", "a:b\nc."]
    for conv in range(convs):
        for _ in range(rng.randrange(0, 9)):
            turn = rng.choice([None, *range(7)])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            rows.append((conv, turn, role, rng.choice([*texts, None])))
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (7000, None, None, None)]
    return rows + rows[:10]  # repeated rows


def frame_of(spark, rows):
    named = [(c, t, r, x, "x", 1) for c, t, r, x in rows]
    return spark.createDataFrame(named, "conv_id bigint, turn int, role string, text string, symbol string, copies int")


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = table(seed)
    found = dawg.repair_report(dawg.damaged(frame_of(spark, rows).repartition(5))).collect()
    by_text = lambda r: (r[2] or " ").encode()
    assert sorted(map(tuple, found), key=str) == expected(sorted(rows, key=by_text))


def test_one_long_conversation_over_many_tasks(spark):
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", "", f"{t}.", "Same."])) for t in range(3000)]
    rows += [(2, 0, "user", "Hi."), (2, 2, "assistant", "Ho.")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        found = dawg.repair_report(dawg.damaged(frame_of(spark, rows).repartition(7))).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, found), key=str) == expected(rows)


def test_repaired_rows_have_the_wanted_roles(spark):
    rows = [r for r in table(3) if r[0] is not None]
    found = dawg.repaired(frame_of(spark, rows)).orderBy("conv_id", "line").collect()
    convs = {}
    for r in found:
        assert r["line"] == len(convs.setdefault(r["conv_id"], []))
        convs[r["conv_id"]].append((r["role"], r["text"]))
    kept = lambda conv, turn, role, text: [(turn, " " if role is None else role, " " if text is None else text)]
    for conv, *_, digest in expected(rows, kept):
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in convs.get(conv, [])).encode()).hexdigest() == digest


def test_suffixes_are_shared():
    words = ["".join(random.Random(i).choices("aefijk", k=30)) + "eiei" * 20 for i in range(50)]
    shared = dawg.Suffixes()
    added = []
    step = shared.automaton.step
    shared.automaton.step = lambda below, symbol: added.append(symbol) or step(below, symbol)
    audits = {w: shared.audit(w.encode()) for w in sorted(words, key=lambda w: w[::-1])}
    assert len(added) <= 80 + 50 * 30  # the common end is walked once
    assert len(shared.automaton.steps) < 300  # and few steps are different at all
    for word in words:
        assert dawg.Suffixes().audit(word.encode()) == audits[word]
    assert dawg.Suffixes().audit(b"") == ""


def test_empty_table(spark):
    none = frame_of(spark, [])
    assert dawg.repair_report(dawg.damaged(none)).collect() == []
    assert dawg.repaired(none).collect() == []


def test_all_rows_dropped(spark):
    conv = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found = dawg.repair_report(dawg.damaged(frame_of(spark, [(conv, 0, "user", "Hi.")]))).collect()
    assert [tuple(r) for r in found] == [(conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert found[0].asDict().keys() >= {"gaps", "illegal", "audit"}


def test_other_columns_and_types(spark):
    rows = frame_of(spark, [(1, 0, "user", "Hi."), (1, 1, "assistant", "Ho.")]).withColumn("conv_id", F.col("conv_id").cast("string"))
    assert [r["conv_id"] for r in dawg.repair_report(dawg.damaged(rows.select("conv_id", "turn", "role", "text"))).collect()] == ["1"]

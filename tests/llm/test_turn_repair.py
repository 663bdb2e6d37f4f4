import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from pulsevault.llm import turn_repair as T

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR, START = re.compile("(s?(ua)+)?"), re.compile("s?(ua)*u?")
WHITE = " \t\n\x0b\x0c\r"


def least_edits(rows):
    """(cost, audit, repaired) by a search over all edits in order of (cost, audit); rows: (role, text, fault)."""
    heap, seen = [(0, "", 0, (), "")], set()
    while heap:
        cost, audit, i, out, initials = heapq.heappop(heap)
        if i == len(rows) and GRAMMAR.fullmatch(initials):
            return cost, audit, "\n".join(out)
        state = (i, initials[:1] == "s", len(initials) % 2, not initials, initials == "s")
        if state in seen:
            continue
        seen.add(state)

        def go(more, letter, j, *put):
            spelled = initials + (put[0][:1] if put else "")
            if START.fullmatch(spelled):
                heapq.heappush(heap, (cost + more, audit + letter, j, out + tuple(f"{put[0]}:{put[1]}" for _ in put[:1]), spelled))

        if audit.count("I") < len(rows) + 3:
            go(5, "I", i, "user", "")
            go(5, "I", i, "assistant", "")
        if i < len(rows):
            role, text, fault = rows[i]
            go(2, "D", i + 1)
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if role:
                    go(more, "K", i + 1, role, text)
                go(1 + more, "R", i + 1, "user", text)
                go(1 + more, "R", i + 1, "assistant", text)
    raise AssertionError("no way")


def plain(table):
    """The whole contract, row by row."""
    groups = defaultdict(list)
    for conv, turn, role, text in table:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = []
    for conv, turns in groups.items():
        rows = []
        for turn, role, text in turns:
            fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if fault == 1:
                text = ""
            if fault == 2:
                text = re.sub("[.!?]", "", text)
            if fault == 4:
                role = "user"
            rows += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked, count = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, None: 0}
        for _, role, text in rows:
            filled = text.rstrip(WHITE)
            fault = "blank" if not filled else "duplicate" if (role, text) in seen else "truncated" if filled[-1] not in ".!?" else None
            seen.add((role, text))
            count[fault] += 1
            marked.append((role, text, fault))
        known = [r[0] for r in rows if r[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, repaired = least_edits(marked)
        out.append((conv, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
                    hashlib.sha256(repaired.encode()).hexdigest()))
    return sorted(out, key=str)


def odd_conversations(seed, n, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", None, "unknown"]
    texts = ["Hi there.", "Well?", "cut off", " \n", "", None, "Yes! ", "No. ", "x. ", "end!\t\r", "Hi there."]
    rows = []
    for conv in range(n):
        turn = rng.randint(0, 3)
        for k in range(rng.randint(1, longest)):
            role = roles[0] if rng.random() < 0.3 else rng.choice(roles)
            text = rng.choice(texts) if rng.random() < 0.6 else f"Turn {k}."
            rows.append((conv if conv else None, None if rng.random() < 0.1 else turn, role, text))
            turn += rng.choice([0, 1, 1, 1, 2, 5])
    rng.shuffle(rows)
    return rows


def codes(rows):
    return bytes(T.kind_of(i, f) for i, f in rows)


@pytest.mark.parametrize("block", [1, 2, 3, T.BLOCK])
def test_audits_equal_a_search_over_all_edits(block):
    rng = random.Random(block)
    repairer = T.Repairer(block)
    names = {0: None, 1: "blank", 2: "truncated"}
    for _ in range(1500):
        rows = [(rng.choice("suaaut"), rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randint(0, 9))]
        want = least_edits([(i, "", names[f]) for i, f in rows])[:2]
        assert repairer.audit(codes([("x" if i == "t" else i, f) for i, f in rows])) == want, rows


def test_blocks_do_not_change_long_conversations():
    rng = random.Random(5)
    rows = [(rng.choice("uauauas"), rng.choice([0, 0, 0, 0, 0, 1, 2])) for _ in range(150)]
    want = T.Repairer(1000).audit(codes(rows))
    assert all(T.Repairer(b).audit(codes(rows)) == want for b in (7, 64))
    names = {0: None, 1: "blank", 2: "truncated"}
    assert want == least_edits([(i, "", names[f]) for i, f in rows])[:2]


def test_band_keeps_to_the_budget():
    kinds = [("u", 0), ("a", 0), ("u", 1), ("u", 0)]
    assert T.aligned(kinds, "uaua", True, 7) == (7, "KKDKI")
    assert T.aligned(kinds, "uaua", True, 6) is None
    assert T.aligned(kinds, "ua", True, 4) == (4, "DDKR") or T.aligned(kinds, "ua", True, 4)[0] == 4


@pytest.mark.parametrize("seed", range(3))
def test_query_equals_plain(spark, seed):
    rows = odd_conversations(seed, 150, 8)
    table = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", place int").repartition(5)
    assert sorted(map(tuple, T.repair_audits(T.damaged(table)).collect()), key=str) == plain(rows)


def test_repaired_turns_hash_to_the_digest(spark):
    rows = odd_conversations(11, 40, 12)
    table = spark.createDataFrame(rows, SCHEMA)
    turns = defaultdict(list)
    for r in T.repaired_turns(table).orderBy("place").collect():
        turns[r.conv_id].append(f"{r.role}:{r.text}")
    for r in T.repair_audits(table).collect():
        assert hashlib.sha256("\n".join(turns[r.conv_id]).encode()).hexdigest() == r.repaired_sha256


def test_empty_lost_and_very_long(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert T.repair_audits(T.damaged(empty)).count() == 0 and T.repaired_turns(empty).count() == 0
    lost = spark.createDataFrame([(1, 1, "user", "x", True)], SCHEMA + ", lost boolean")
    nothing = hashlib.sha256(b"").hexdigest()
    assert [tuple(r) for r in T.repair_audits(lost).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", nothing)]
    long = spark.range(20_000).selectExpr("1L conv_id", "id turn", "if(id % 2 = 0, 'user', 'assistant') role", "concat('Turn ', id, '.') text")
    got = T.repair_audits(long).first()
    assert (got.cost, got.audit) == (0, "K" * 20_000)
    big = spark.createDataFrame([(1, 1, "user", "y" * 20_000_000 + "."), (1, 2, "assistant", "z" * 20_000_000)], SCHEMA)
    got = T.repair_audits(big).first()
    assert (got.truncated, got.cost, got.audit) == (1, 4, "DD")


def test_given_table_equals_plain(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, T.repair_audits(T.damaged(table)).collect()), key=str) == plain(rows)

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tableflow.llm import conversations
from tableflow.llm.conversations import Repaired, audit_of, op13_conversations, repair_conversations, span_of

COLUMNS = "conv_id long, turn long, role string, text string"
GOOD = re.compile(r"(s?(ua)+)?")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode()))


def cheapest(rows):
    """(cost, audit, repaired turns) by trying edits in order of (cost, audit), whole sequences of them.

    Sequences that write the same state at the same place go on alike; only their least is followed.
    """
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, written, turns = heapq.heappop(heap)
        state = written[-1:] if "u" in written else written
        if (at, state) in seen:
            continue
        seen.add((at, state))
        if at == len(rows) and GOOD.fullmatch(written):
            return cost, audit, turns
        steps = [(2, "I", at, role, "") for role in ("user", "assistant")]
        if at < len(rows):
            role, text, fault = rows[at]
            cut = fault == "truncated"
            steps.append((3, "D", at + 1, None, ""))
            if fault not in ("blank", "duplicate"):
                steps += [(2 + cut, "R", at + 1, new, text) for new in ("user", "assistant")]
                steps.append((cut, "K", at + 1, role, text))
        for weight, letter, then, role, text in steps:
            new = written + ("" if role is None else role[:1] or "-")
            if re.fullmatch(r"s?(ua)*u?", new):
                more = () if role is None else ((role, text),)
                heapq.heappush(heap, (cost + weight, audit + letter, then, new, turns + more))


def brute_force(rows):
    out = []
    for conv in {row[0] for row in rows}:
        own = damage([row for row in rows if row[0] == conv])
        seen, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        for _, role, text in own:
            bare = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "" if bare and bare[-1] in ".!?" else "truncated"
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else fault
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role, text, fault))
        turns = {turn for turn, _, _ in own if turn is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [role[:1] for _, role, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, repaired = cheapest(marked)
        text = "\n".join(f"{role}:{text}" for role, text in repaired)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out.append((conv, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, sha))
    return sorted(out, key=str)


def invented(rng, conv, turns):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "unknown", "User"]
    texts = ["Hi.", "What?", "cut off", "", " \n", None, "Same again.", "é.\x0b"]
    rows = []
    for turn in range(turns):
        kind = rng.random()
        role = rng.choice(roles) if kind < 0.4 else "user" if turn % 2 else "assistant"
        text = rng.choice(texts) if rng.random() < 0.5 else f"text {rng.randrange(10**6)}."
        number = None if kind > 0.95 else turn + 3 * (kind > 0.9)
        rows.append((conv, number, role, text))
    return rows


@pytest.fixture(scope="module")
def talks():
    rng = random.Random(3)
    rows = [row for conv in range(150) for row in invented(rng, conv, rng.randrange(0, 12))]
    rows += invented(rng, 1000, 700) + invented(rng, None, 30)
    rows += [(2000, 5, "user", "Equal.")] * 40 + [(2000, None, "user", "Equal.")] * 3 + [(2000, 6, "assistant", "Yes.")]
    rows += [(2001, None, None, None), (2002, turn := 0, "user", "long " * 200_000)]
    rows += [(conv, 0, "user", "All gone.") for conv in range(3000, 3040)]  # some lose their only row
    rng.shuffle(rows)
    return rows


def plain(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("partitions", ["3", "40"])
def test_digests_are_those_of_brute_force(spark, talks, tmp_path, partitions):
    frame = spark.createDataFrame(talks, COLUMNS).selectExpr("*", "1 as conv", "2 as times", "3 as key").repartition(5)
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    adaptive, number = "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions"
    before = spark.conf.get(adaptive), spark.conf.get(number)
    spark.conf.set(adaptive, "false")
    spark.conf.set(number, partitions)
    try:
        got = plain(op13_conversations(spark, str(tmp_path)).collect())
    finally:
        spark.conf.set(adaptive, before[0])
        spark.conf.set(number, before[1])
    assert got == brute_force(talks)
    assert any(row[7] == "" and row[0] and row[0] >= 3000 for row in got)


def test_a_conversation_of_many_partitions_is_cut(spark):
    rng = random.Random(5)
    rows = invented(rng, 7, 3000)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = Repaired(spark.createDataFrame(rows, COLUMNS))
        turns = found.pieces().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert found.whole().isEmpty() and len({row["chunk"] for row in turns}) > 4
    audit = "".join(row["edit"] * row["times"] for row in sorted(turns, key=lambda r: r[:3]) if row["edit"])
    assert audit == brute_force(rows)[0][7]


def test_repaired_turns_alternate(spark, talks):
    turns = repair_conversations(spark.createDataFrame(talks, COLUMNS)).where("role is not null")
    by_conv = {}
    for row in sorted(turns.collect(), key=lambda r: (str(r["conv_id"]), r["chunk"], r["place"])):
        by_conv.setdefault(row["conv_id"], []).append(row["role"][:1])
    assert all(GOOD.fullmatch("".join(initials)) for initials in by_conv.values())


def test_spans_of_blocks_are_those_of_edits(monkeypatch):
    rng = random.Random(8)
    for _ in range(30):
        rows = [
            (rng.choice("suax"), rng.choice(["", "", "blank", "duplicate", "truncated"]), rng.randrange(1, 3))
            for _ in range(rng.randrange(5, 40))
        ]
        whole, best = span_of(rows), audit_of(rows)
        monkeypatch.setattr(conversations, "BLOCK", 4)
        assert span_of(rows) == whole and audit_of(rows) == best
        monkeypatch.undo()


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/conversations.parquet")
    assert op13_conversations(spark, str(tmp_path)).collect() == []

"""Prefix tries and turn repair against plain versions of themselves."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie, queries, turn_repair

SF_DIR = "/root/testdata/sf0.01"
TURNS = "conv_id bigint, turn bigint, role string, text string"


# --- prefix trie


def plain_trie(convs):
    """All nodes of {conv_id: [(role, text), ...]}, straight from the definition."""
    members = {}
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    out = set()
    for prefix, found in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        ends = sorted(c for c in found if len(convs[c]) == len(prefix))
        out.add((
            min(found), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(found),
            sum(len(p) == len(prefix) + 1 for p in below),
            sum(not any(len(q) > len(p) and q[: len(p)] == p for q in below) for p in below),
            sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return out


def regrafted(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, digest, (role or "", text or "")))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def built(spark, rows, **options):
    turns = prefix_trie.numbered(spark.createDataFrame(rows, TURNS), **options)
    conv = F.col("conv_id")
    grafted = prefix_trie.grafted(turns, F.crc32(conv.cast("string")) % 9, conv - conv % 5, most=8)
    nodes = prefix_trie.trie(*grafted, **options).select(*COLUMNS).collect()
    assert len(nodes) == len(set(nodes))
    return {tuple(r) for r in nodes}


def odd_rows():
    rng = random.Random(5)
    rows = []
    for conv in range(60):
        start = rng.randrange(3)
        for i in range(rng.randrange(1, 14)):
            # Few different texts, so prefixes are shared; some turns missing a number, a role or a text.
            rows.append((
                conv, None if rng.random() < 0.05 else i, rng.choice(["user", "assistant", None]) if i > 2 else "user",
                rng.choice(["é", "b", "", None]) if i > 1 else f"start {start}",
            ))
    rows += [(70, 0, "user", "start 0")] * 3 + [(None, 0, "user", "nobody's")]
    # Conversation 80 is given the first turns of one that doesn't exist... and so is left with none.
    return rows + [(83, 0, "user", "lost")]


@pytest.mark.parametrize("width", [None, 64])
def test_trie_against_plain_version(spark, monkeypatch, width):
    """A sketch of 64 cells takes nearly every prefix for shared; the nodes are the same."""
    if width:
        monkeypatch.setattr(prefix_trie, "MAX_WIDTH", width)
    rows = odd_rows()
    want = plain_trie(regrafted(rows))
    assert built(spark, rows) == want
    assert any(n[1] == 0 and n[3] == 62 for n in want)


def test_trie_of_giant_conversations_runs_in_chunks(spark):
    rows = [(c, i, "user", f"t{i}" if i < 90 else f"t{i} of {c}") for c in (5, 10, 15) for i in range(100 + c)]
    rows += [(c, 0, "user", "hello") for c in range(20, 40)]
    assert built(spark, rows, hot_rows=16) == plain_trie(regrafted(rows))


def test_trie_of_nothing(spark):
    assert built(spark, []) == set()
    assert built(spark, [(None, 1, "user", "x")]) == set()


def test_trie_with_other_columns_named_alike(spark):
    rows = odd_rows()
    wide = spark.createDataFrame(rows, TURNS).withColumns(
        {c: F.lit(1) for c in ("digest", "place", "depth", "k1", "bytes", "length", "own", "head", "shared")}
    )
    assert prefix_trie.numbered(wide).count() == sum(r[0] is not None for r in rows)


def test_long_id_lists_are_hashed_over_chunks_and_batches(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS", 7)
    ends = spark.range(1000).select(
        F.when(F.col("id") < 900, 1).otherwise(F.col("id") % 9).cast("bigint").alias("k1"), F.lit(0).cast("bigint").alias("k2"),
        F.lit(3).cast("bigint").alias("depth"), F.col("id").alias("conv_id"),
    )
    want = {}
    for i in range(1000):
        want.setdefault(1 if i < 900 else i % 9, []).append(i)
    got = {r["k1"]: r["ends_sha256"] for r in prefix_trie.digests_of_ids(ends).collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for k, v in want.items()}


# --- turn repair

LEGAL = re.compile(r"(s?(ua)+)?\Z")


def faults(turns):
    """First fault of each turn of [(role, text), ...]."""
    seen, out = set(), []
    for role, text in turns:
        stripped = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("b" if not stripped else "d" if (role, text) in seen else "t" if stripped[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(turns):
    """(cost, audit, repaired turns) by trying every edit, with up to two empty turns before each and at the end."""
    best = None
    kinds = faults(turns)
    put = [[], [("I", "user", "")], [("I", "assistant", "")], *([("I", a, ""), ("I", b, "")] for a, b in
           itertools.product(("user", "assistant"), repeat=2))]
    options = []
    for (role, text), kind in zip(turns, kinds):
        ways = [(3, [("D", None, None)])]
        if kind not in ("b", "d"):
            extra = kind == "t"
            ways += [(extra, [("K", role, text)]), (2 + extra, [("R", "user", text)]), (2 + extra, [("R", "assistant", text)])]
        options.append(put)
        options.append(ways)
    options.append(put)
    for choice in itertools.product(*options):
        cost, edits = 0, []
        for i, part in enumerate(choice):
            if i % 2:
                cost += part[0]
                edits += part[1]
            else:
                cost += 2 * len(part)
                edits += part
        kept = [e for e in edits if e[0] != "D"]
        if LEGAL.match("".join(e[1][:1] or "?" for e in kept)):
            way = (cost, "".join(e[0] for e in edits), [(e[1], e[2]) for e in kept])
            best = way if best is None or way[:2] < best[:2] else best
    return best


def stepped_repair(turns):
    """(cost, audit, repaired turns) for turns of any number: whole audits kept for each last role."""
    ways = {"": (0, "", ())}

    def spread(ways):
        for _ in range(2):
            for last, (cost, audit, kept) in list(ways.items()):
                role = "assistant" if last == "u" else "user"
                way = (cost + 2, audit + "I", (*kept, (role, "")))
                if role[0] not in ways or way[:2] < ways[role[0]][:2]:
                    ways[role[0]] = way
        return ways

    for (role, text), kind in zip(turns, faults(turns)):
        new = {}
        for last, (cost, audit, kept) in spread(dict(ways)).items():
            found = [(last, (cost + 3, audit + "D", kept))]
            if kind not in ("b", "d"):
                for edit, given in (("K", role), ("R", "user"), ("R", "assistant")):
                    if given[:1] == "s" and last == "" or given[:1] == "u" and last != "u" or given[:1] == "a" and last == "u":
                        found.append((given[0], (cost + 2 * (edit == "R") + (kind == "t"), audit + edit, (*kept, (given, text)))))
            for last_now, way in found:
                if last_now not in new or way[:2] < new[last_now][:2]:
                    new[last_now] = way
        ways = new
    ways = spread(dict(ways))
    return min((ways[q] for q in ("", "a") if q in ways), key=lambda w: w[:2])


def plain_report(turns, numbers):
    kinds = faults(turns)
    cost, audit, kept = stepped_repair(turns)
    known = sorted(n for n in numbers if n is not None)
    initials = [r[:1] for r, _ in turns]
    return (
        known[-1] - known[0] + 1 - len(set(known)) if known else 0, kinds.count("b"), kinds.count("d"), kinds.count("t"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
    )


SAYINGS = ["Yes.", "No", " ", "Well!", "So. ", ""]
ROLES = ["system", "user", "assistant", "tool", ""]


def test_stepped_version_equals_trying_everything():
    rng = random.Random(3)
    for n in (0, 1, 2, 2, 2, 3, 3, 3):
        turns = [(rng.choice(ROLES), rng.choice(SAYINGS)) for _ in range(n)]
        got = stepped_repair(turns)
        assert (got[0], got[1], list(got[2])) == plain_repair(turns), turns


def reported(spark, rows, **options):
    df = spark.createDataFrame(rows, TURNS)
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv_id"]: tuple(r[c] for c in names) for r in turn_repair.report(df, **options).collect()}


def by_conversation(rows):
    """{conv_id: (turns in order, their numbers)} of unsorted rows."""
    own = {}
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        own.setdefault(conv, []).append((turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest(), text, turn))
    return {c: ([(t[2], t[4]) for t in sorted(ts, key=lambda t: t[:4])], [t[5] for t in ts]) for c, ts in own.items()}


def random_rows(seed, convs, most):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(convs)]:
        for i in range(rng.randrange(1, most)):
            turn = rng.choice([None, i, i, i, i + 3])
            rows.append((conv, turn, rng.choice([*ROLES, "user", "assistant", None]), rng.choice([*SAYINGS, f"{i}.", f"{i}", None])))
    rng.shuffle(rows)
    return rows


def test_reports_against_plain_version(spark):
    rows = random_rows(1, 300, 9)
    assert reported(spark, rows) == {c: plain_report(*v) for c, v in by_conversation(rows).items()}


@pytest.mark.parametrize("block", [1, 7, 64])
def test_spilled_conversations_give_the_same(spark, monkeypatch, block):
    """All but the shortest conversations go through blocks and three passes."""
    monkeypatch.setattr(turn_repair, "HELD_TURNS", 5)
    monkeypatch.setattr(turn_repair, "BLOCK", block)
    monkeypatch.setattr(turn_repair, "BATCH", 10)
    rows = random_rows(2, 25, 64) + [(900, 4, "user", "Same.")] * 200 + [(901, i % 3, "user", "Hm.") for i in range(100)]
    want = {c: plain_report(*v) for c, v in by_conversation(rows).items()}
    assert reported(spark, rows) == want
    got = {}
    for r in turn_repair.repair(spark.createDataFrame(rows, TURNS)).collect():
        got.setdefault(r["conv_id"], []).append((r["place"], r["role"], r["text"]))
    for conv, (turns, _) in by_conversation(rows).items():
        kept = [(i, *t) for i, t in enumerate(stepped_repair(turns)[2], 1)]
        assert sorted(got.get(conv, [])) == kept


def test_one_very_long_text_is_spilled_by_its_bytes(spark):
    rows = [(1, 0, "user", "x" * (turn_repair.HELD_BYTES + 1) + "."), (1, 1, "user", "y.")]
    assert reported(spark, rows) == {c: plain_report(*v) for c, v in by_conversation(rows).items()}


def test_repair_of_nothing_and_of_bare_ids(spark):
    assert reported(spark, []) == {}
    ids = spark.createDataFrame([(4,), (4,), (None,), (1,)], "conv_id bigint")
    got = reported(spark, [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hi.")], ids=ids)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {4: nothing, None: nothing, 1: (0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(b"user:Hi.\nassistant:Hi.").hexdigest())}


def test_repair_ignores_other_columns(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi.")], TURNS)
    wide = rows.withColumns({c: F.lit("x") for c in ("conv", "kind", "digest", "block", "place", "no_turn")})
    assert [r["audit"] for r in turn_repair.report(wide).collect()] == ["KI"]


def test_repair_query_against_plain_version(spark):
    want = {}
    for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").orderBy("conv_id", "turn").collect():
        turns, numbers = want.setdefault(r["conv_id"], ([], []))
        role, text = r["role"] or " ", r["text"] or " "
        fault = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            role = "user" if fault == 4 else role
            for _ in range(1 + (fault == 3)):
                turns.append((role, text))
                numbers.append(r["turn"])
    got = {tuple(r)[0]: tuple(r)[1:] for r in queries.QUERIES["op12_turn_repair"](spark, SF_DIR).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    assert got == {c: plain_report(*v) for c, v in want.items()}

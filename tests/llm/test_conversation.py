"""Conversation repair against a table of all prefixes, states and audits."""

import hashlib
import random
import re
import zlib

import pytest

from curate.llm import conversation as C
from curate.llm.catalogue import ORACLE, QUERIES
from curate.plans.verify import compare

from conftest import SF_MID

STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAME = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, repaired lines) of rows (role, text, must go, cut off), by all prefixes and states."""

    def inserted(best):
        for _ in range(4):
            for (p, c), q in STEP.items():
                if c in NAME and p in best:
                    cost, audit, lines = best[p]
                    best[q] = min(best.get(q, (1 << 40, "", ())), (cost + 3, audit + "I", lines + (NAME[c] + ":",)))
        return best

    best = inserted({0: (0, "", ())})
    for role, text, gone, cut in rows:
        new = {}
        for p, (cost, audit, lines) in best.items():
            made = [(p, (cost + 4, audit + "D", lines))]
            if not gone:
                extra = 3 if cut else 0
                if (p, role[:1]) in STEP:
                    made.append((STEP[p, role[:1]], (cost + extra, audit + "K", lines + (f"{role}:{text}",))))
                made += [(STEP[p, c], (cost + extra + 3, audit + "R", lines + (f"{NAME[c]}:{text}",))) for c in NAME if (p, c) in STEP]
            for q, x in made:
                new[q] = min(new.get(q, (1 << 40, "", ())), x)
        best = inserted(new)
    return min(best[s] for s in (0, 3) if s in best)


def expected(rows, damaged=True):
    """The whole contract over (conv_id, turn, role, text)."""
    convs: dict = {}
    for conv, turn, role, text in rows:
        held = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        if fault == 0:
            continue
        role = "user" if fault == 4 else role
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        held += [(turn, role, text)] * (2 if fault == 3 else 1)
    out = []
    for conv, held in convs.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked, n = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in held:
            core = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(held, held[1:]))
        cost, audit, lines = cheapest(marked)
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def chats(seed, convs, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", "", None])
            text = rng.choice(["Yes.", "No", "Well?! ", "é.\n", "", " \t", None, "\xa0", f"{rng.random()}.", f"{rng.random()}"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    return rows


DDL = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def digest(edits, counts):
    """What the registered query makes of the operator's results."""
    conv = counts.schema["conv_id"]
    made = C._streamed(edits.repartition("conv_id").sortWithinPartitions("conv_id", "at", "seq"), C._digests, conv, audit="string", repaired_sha256="string")
    found = {r.conv_id: r for r in made.collect()}
    none = hashlib.sha256(b"").hexdigest()
    return sorted(((*r, found[r.conv_id].audit, found[r.conv_id].repaired_sha256) if r.conv_id in found else (*r, "", none) for r in counts.collect()), key=repr)


def test_solve_equals_all_prefixes():
    rng = random.Random(1)
    for _ in range(1500):
        rows = [(rng.choice("suax"), "t", rng.random() < .2, rng.random() < .3) for _ in range(rng.randint(0, 14))]
        units = [1 if gone else (role if role in "sua" else "", cut) for role, _, gone, cut in rows]
        cost, audit, _ = cheapest(rows)
        assert C.solve(units, 0)[0] == audit
        assert min(x + y for x, y in zip(C.matrix(units)[:4], C.ENDS)) == cost
        back = C.backward(units, 0, len(units), list(C.ENDS))
        assert back[0] == cost and all(min(a + b for a, b in zip(C.matrix(units)[4 * p:4 * p + 4], C.ENDS)) == back[p] for p in range(4))


@pytest.mark.parametrize("bits", [0, 2, 12])
def test_damaged_conversations(spark, monkeypatch, bits):
    monkeypatch.setattr(C, "BLOCK_BITS", bits)
    rows = chats(bits, 60, 25) + [(None, 0, "user", "a."), (None, 1, "assistant", "b"), (900, None, None, None), (901, 3, "user", "x" * 200_000 + ".")]
    rows += rows[5:40] + [(902, 1, "user", "same.")] * 300          # repeated rows, and a row that stands very often
    edits, counts = C.repair(C.damage(spark.createDataFrame(rows, DDL)), "n")
    assert digest(edits, counts) == expected(rows)


def test_one_long_conversation_is_dealt_out(spark, monkeypatch):
    """A conversation with most of the rows goes through many blocks, and comes back whole."""
    monkeypatch.setattr(C, "BLOCK_BITS", 4)
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["a.", "b", "", f"{t}.", f"{t}"])) for t in range(3000)] + chats(9, 5, 6)
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], DDL + ", at int, edit string")          # extra columns of clashing names
    edits, counts = C.repair(table)
    assert digest(edits, counts) == expected(rows, damaged=False)
    kept = edits.filter("conv_id = 7 and edit <> 'D'").orderBy("at", "seq").collect()
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in kept))


def test_empty_table(spark):
    edits, counts = C.repair(C.damage(spark.createDataFrame([], DDL)), "n")
    assert edits.count() == 0 and counts.count() == 0


def test_query_equals_sql(spark):
    from curate.plans.verify import duckdb_connection

    name = "op12_conversation_repair"
    r = compare(spark, duckdb_connection(SF_MID), name, SF_MID, QUERIES[name], ORACLE[name])
    assert r["ok"], r

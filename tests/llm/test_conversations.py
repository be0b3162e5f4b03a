import hashlib
import itertools
import random
import re

import pytest

from ferry.llm import conversations as c
from ferry.llm import queries
from conftest import DATA

SCHEMA = "conv_id long, turn long, role string, text string, block string, part string, digest string"


def all_edits(rows, costs=c.Costs()):
    """The least (cost, letters) over every string of edits of a few rows, by the form of the roles it writes."""
    best = None
    for letters in itertools.product("KRD", repeat=len(rows)):
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            audit, cost, wanted = "I" * inserts[0], costs.insert * sum(inserts), ["?"] * inserts[0]
            for letter, (role, gone, cut), more in zip(letters, rows, inserts[1:]):
                if gone and letter != "D":
                    break
                cost += {"K": 0, "R": costs.rerole, "D": costs.delete}[letter] + (costs.truncated if cut and letter != "D" else 0)
                wanted += [] if letter == "D" else [role] if letter == "K" else ["?"]
                audit += letter + "I" * more
                wanted += ["?"] * more
            else:
                odd = len(wanted) % 2
                form = "s" * odd + "ua" * (len(wanted) // 2)
                free = len(wanted) != 1 and not (odd and wanted[0] == "?")
                if free and all(w in ("?", f) for w, f in zip(wanted, form)):
                    best = min(best or (cost, audit), (cost, audit))
    return best


def test_cheapest_edits_against_all():
    rng = random.Random(5)
    for _ in range(150):
        rows = [(rng.choice("suaux"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(4))]
        assert c.Lattice().cheapest(rows) == all_edits(rows), rows
    cheap = c.Costs(rerole=4, delete=9, insert=1, truncated=2)
    for _ in range(150):
        rows = [(rng.choice("sua"), rng.random() < 0.1, rng.random() < 0.3) for _ in range(rng.randrange(4))]
        assert c.Lattice(cheap).cheapest(rows) == all_edits(rows, cheap), rows


@pytest.mark.parametrize("costs", [c.Costs(), c.Costs(rerole=4, delete=9, insert=1, truncated=2), c.Costs(2, 2, 2, 0)])
def test_tables_of_parts_make_the_whole(costs):
    rng, lattice = random.Random(7), c.Lattice(costs)
    for _ in range(60):
        rows = [(rng.choice("suaa"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randrange(1, 40))]
        cuts = sorted({0, len(rows), *(rng.randrange(len(rows)) for _ in range(4))})
        parts = [lattice.table(rows[a:b]) for a, b in zip(cuts, cuts[1:])]
        made = parts[0]
        for part in parts[1:]:
            made = c.joined(made, part)
        assert min(made[c.EMPTY, q] for q in c.ENDS if (c.EMPTY, q) in made) == lattice.cheapest(rows)


def plain(rows, lattice=c.Lattice()):
    """The report and the turns of one conversation's rows."""
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    cost, audit = lattice.cheapest([(r[:1], f in ("blank", "duplicate"), f == "truncated") for (_, r, _), f in zip(rows, faults)])
    turns = {t for t, _, _ in rows if t is not None}
    out, left, odd = [], list(rows), len(audit.replace("D", "")) % 2
    for letter in audit:
        role, text = ("", "") if letter == "I" else left.pop(0)[1:]
        if letter != "D":
            out.append((role if letter == "K" else ("user", "assistant")[(len(out) - odd) % 2], text))
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit), out


def check(spark, rows, block):
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    made = c.repair(frame, block=block)
    by = {}
    for conv_id, *row in rows:
        by.setdefault(conv_id, []).append(tuple(row))
    truth = {k: plain(v) for k, v in by.items()}
    report = {r[0]: tuple(r[1:]) for r in made.report.collect()}
    assert report == {k: v[0] for k, v in truth.items()}
    turns = {}
    for r in made.turns.orderBy("conv_id", "place").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert turns == {k: v[1] for k, v in truth.items() if v[1]}
    assert {r[0]: r[1] for r in made.digests.collect()} == {
        k: hashlib.sha256("\n".join(f"{r}:{t}" for r, t in v[1]).encode()).hexdigest() for k, v in truth.items()
    }


TEXTS = ["Yes.", "No!", "cut off", "", " \n", None, "Why?  ", "x" * 3000 + ".", "Ünï 😀."]


@pytest.mark.parametrize("block", [2, 512])
def test_nulls_ties_repeats_and_one_large_conversation(spark, block):
    rng = random.Random(block)
    rows = [(rng.choice([1, 2, None, 4, 5]), rng.choice([None, *range(6)]), rng.choice(["user", "assistant", "system", None, "", "tool"]), rng.choice(TEXTS)) for _ in range(60)]
    rows += [(6, k % 70, rng.choice(["user", "assistant"]), f"{rng.choice(TEXTS)} {k % 50}.") for k in range(120)]
    rows += [(7, 3, "user", "The same.")] * 30
    check(spark, rows, block)


def test_no_rows(spark):
    made = c.repair(spark.createDataFrame([], SCHEMA))
    assert made.report.count() == made.turns.count() == made.digests.count() == 0
    assert c.repair_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_conversations_that_lose_all_rows(spark):
    import zlib

    gone = next(i for i in range(500) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    found = c.repair_report(spark.createDataFrame([(gone, 0, "user", "Hello.", "", "", "")], SCHEMA)).collect()
    assert [tuple(r) for r in found] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    # a row without an identifier is written as one space in what is hashed
    harm = zlib.crc32(b" : ") % 20
    (row,) = c.repair_report(spark.createDataFrame([(None, None, None, None, "", "", "")], SCHEMA)).collect()
    assert row.conv_id is None and row.blank == (0 if harm == 0 else 2 if harm == 3 else 1)


def test_what_is_repaired_has_the_form(spark):
    for r in queries.op12_conversation_repair(spark, DATA).collect():
        assert re.fullmatch("[DIKR]*", r.audit) and r.cost >= 2 * r.audit.count("D") + r.audit.count("R") + 5 * r.audit.count("I")

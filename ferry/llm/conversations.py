"""Repair the structure of conversations with the cheapest edits, found by a search from both ends of the edit lattice.

A node of the lattice is (rows read, state): the state is the last role written, so that a path spells a conversation of
the form `system? (user assistant)+`, or an empty one. Rows arrive in the order of their conversation, by ranges of all
rows, so a conversation that holds a third of them is read by many tasks, in blocks of bounded size. One that lies
whole within a block is repaired where it is read. The blocks of the others are solved between every two states; such
tables are joined in a tree, as paths that read the same rows at the same cost never are prefixes of each other (an
insertion more costs more), so that the least text of a whole is made of the least texts of its parts.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import stored

EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: (state, initial of the role written) to the state after it.
WRITES = {
    (EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT,
}
ENDS = (EMPTY, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}
#: Rows and characters of text after which a block is full.
BLOCK, BLOCK_CHARS = 512, 4 << 20
FANIN = 32


@dataclass(frozen=True)
class Costs:
    """Whole numbers; keeping a row is free. `insert` must be more than zero."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


class Lattice:
    """Edits of rows, each row given as `(initial of its role, must go, is truncated)`."""

    def __init__(self, costs: Costs = Costs()):
        if costs.insert <= 0 or min(costs.rerole, costs.delete, costs.truncated) < 0:
            raise ValueError(f"not usable as costs: {costs}")
        self.costs, self.known = costs, {}
        self.inserts = [[("I", to, costs.insert) for (at, r), to in WRITES.items() if at == q and r in NAMES] for q in range(4)]
        self.uninserts = _turned(self.inserts)

    def edits(self, row: tuple[str, bool, bool]) -> tuple[list, list]:
        """What can be done to a row: for each state before it `(letter, state after, cost)`, and the same backwards."""
        if row not in self.known:
            role, gone, truncated = row
            extra = self.costs.truncated if truncated else 0
            ahead: list[list] = [[("D", q, self.costs.delete)] for q in range(4)]
            for (at, r), to in WRITES.items():
                if not gone and r == role:
                    ahead[at].append(("K", to, extra))
                elif not gone and r in NAMES:
                    ahead[at].append(("R", to, self.costs.rerole + extra))
            self.known[row] = ahead, _turned(ahead)
        return self.known[row]

    def cheapest(self, rows: list[tuple[str, bool, bool]], start: int = EMPTY, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
        """The least cost from a state to one of others over all rows, and the ASCII-least letters of that cost.

        Two heaps hold the tips of the paths from the start and, reversed, from the ends. A node is settled with its
        least (cost, letters); at equal cost nodes fewer rows away come first, as only edits of rows may be free. The
        search goes on while paths of the best cost known may still cross, so all of them cross between settled
        nodes, and the least joined letters are those of the least path.
        """
        n = len(rows)
        tips = [{(0, start): (0, "")}, {(n, q): (0, "") for q in ends}]
        heaps = [[(0, 0, 0, start)], [(0, 0, n, q) for q in ends]]
        settled: list[dict] = [dict(tips[0]), dict(tips[1])]
        closed: list[set] = [set(), set()]
        best = min((0 for node in tips[0] if node in tips[1]), default=None)
        while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best):
            side = 0 if heaps[0][0] <= heaps[1][0] else 1
            cost, far, i, q = heapq.heappop(heaps[side])
            if (i, q) in closed[side]:
                continue
            closed[side].add((i, q))
            letters = tips[side][i, q][1]
            settled[side][i, q] = cost, letters
            steps = [(x, i, to, more) for x, to, more in (self.inserts, self.uninserts)[side][q]]
            if side == 0 and i < n:
                steps += [(x, i + 1, to, more) for x, to, more in self.edits(rows[i])[0][q]]
            elif side == 1 and i > 0:
                steps += [(x, i - 1, to, more) for x, to, more in self.edits(rows[i - 1])[1][q]]
            for letter, j, to, more in steps:
                tip = cost + more, letters + letter if side == 0 else letter + letters
                if (j, to) not in tips[side] or tip < tips[side][j, to]:
                    tips[side][j, to] = tip
                    heapq.heappush(heaps[side], (tip[0], far + (j != i), j, to))
                across = tips[1 - side].get((j, to))
                if across and (best is None or tip[0] + across[0] < best):
                    best = tip[0] + across[0]
        if best is None:
            return None
        ahead, behind = settled
        found = [a + behind[node][1] for node, (c, a) in ahead.items() if node in behind and c + behind[node][0] == best]
        for (i, q), (cost, letters) in ahead.items():
            steps = [(x, i, to, more) for x, to, more in self.inserts[q]]
            steps += [(x, i + 1, to, more) for x, to, more in self.edits(rows[i])[0][q]] if i < n else []
            for letter, j, to, more in steps:
                if (j, to) in behind and cost + more + behind[j, to][0] == best:
                    found.append(letters + letter + behind[j, to][1])
        return best, min(found)

    def table(self, rows: list[tuple[str, bool, bool]]) -> dict[tuple[int, int], tuple[int, str]]:
        """The cheapest edits between every two states."""
        found = {(a, b): self.cheapest(rows, a, (b,)) for a in range(4) for b in range(4)}
        return {k: v for k, v in found.items() if v is not None}


def _turned(steps: list[list]) -> list[list]:
    back: list[list] = [[] for _ in range(4)]
    for at, options in enumerate(steps):
        for letter, to, cost in options:
            back[to].append((letter, at, cost))
    return back


def joined(first: dict, second: dict) -> dict:
    """The table of two stretches of rows, one after the other."""
    found: dict = {}
    for (a, m), (cost, letters) in first.items():
        for b in range(4):
            if (m, b) in second:
                way = cost + second[m, b][0], letters + second[m, b][1]
                if (a, b) not in found or way < found[a, b]:
                    found[a, b] = way
    return found


class Spelled:
    """The rows that edits give, one after another. The number of rows written says which role each has."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, 0
        self.odd = (len(audit) - audit.count("D")) % 2

    def _role(self) -> str:
        return NAMES["ua"[(self.place - self.odd) % 2]]

    def _inserted(self) -> Iterator[tuple[int, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            yield self.place, self._role(), ""
            self.at, self.place = self.at + 1, self.place + 1

    def row(self, role: str, text: str) -> Iterator[tuple[int, str, str]]:
        """What is written before the next row and for it."""
        yield from self._inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            yield self.place, role if letter == "K" else self._role(), text
            self.place += 1

    end = _inserted


def blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x20\x09-\x0D]")


def truncated(text: Column) -> Column:
    """The last character that is not white space is not a stop."""
    return text.rlike(r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z")


_ROW = "conv_id long, turn long, role string, text string"
_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_READ = (
    f"done boolean, part long, block long, place long, {_ROW}, digest binary, blank boolean, truncated boolean, "
    f"report struct<{_REPORT.replace(' ', ':').replace(',:', ', ')}>, repaired array<struct<role:string, text:string>>"
)
_TABLE = "array<struct<start:int, end:int, cost:long, audit:string>>"
_SUMS = ("blank", "duplicate", "truncated", "illegal", "turns")
_BLOCK = (
    f"conv_id long, part long, block long, {', '.join(f'{c} long' for c in _SUMS)}, least long, most long, "
    f"first string, last string, ways {_TABLE}"
)


def _summed(rows: list[tuple]) -> dict:
    """Counts of a stretch of rows `(turn, initial, blank, duplicate, truncated)` in their order."""
    turns = [t for t, *_ in rows if t is not None]
    return {
        "blank": sum(b for _, _, b, _, _ in rows), "duplicate": sum(d and not b for _, _, b, d, _ in rows),
        "truncated": sum(t and not b and not d for _, _, b, d, t in rows),
        "illegal": sum(x[1] + y[1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:])),
        "turns": len(set(turns)), "least": min(turns, default=None), "most": max(turns, default=None),
        "first": rows[0][1], "last": rows[-1][1],
    }


def _edited(rows: list[tuple]) -> list[tuple[str, bool, bool]]:
    return [(initial, bool(b or d), bool(t)) for _, initial, b, d, t in rows]


def _report(sums: dict, way: tuple[int, str]) -> dict:
    gaps = 0 if sums["least"] is None else sums["most"] - sums["least"] + 1 - sums["turns"]
    return {"gaps": gaps, **{c: sums[c] for c in _SUMS[:4]}, "cost": way[0], "audit": way[1]}


def _read(costs: Costs, most: int, schema: pa.Schema):
    """Conversations that lie whole within a block are repaired; of the others the rows are handed on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, lattice, out, held, block, now, opened, size = TaskContext.get().partitionId(), Lattice(costs), [], [], 0, None, True, 0

        def flush(whole: bool) -> None:
            nonlocal block, held, size
            if whole:
                seen, rows = set(), []
                for _, turn, role, _, digest, b, t in held:
                    rows.append((turn, role[:1], b, (role, digest) in seen, t))
                    seen.add((role, digest))
                way = lattice.cheapest(_edited(rows))
                spelled = Spelled(way[1])
                turns = [x for _, _, role, text, *_ in held for x in spelled.row(role, text)] + list(spelled.end())
                out.append({
                    "done": True, "conv_id": held[0][0], "report": _report(_summed(rows), way),
                    "repaired": [{"role": r, "text": t} for _, r, t in turns],
                })
            else:
                names = ("conv_id", "turn", "role", "text", "digest", "blank", "truncated")
                out.extend({"done": False, "part": part, "block": block, "place": k, **dict(zip(names, row))} for k, row in enumerate(held))
            block, held, size = block + 1, [], 0

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns))):
                if held and row[0] != now:
                    flush(not opened)
                    opened = False
                elif len(held) >= most or size >= BLOCK_CHARS:
                    opened = True
                    flush(False)
                now = row[0]
                held.append(row)
                size += len(row[3])
                if len(out) >= 1024:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out.clear()
        if held:
            flush(False)
        for at in range(0, len(out), 1024):
            yield pa.RecordBatch.from_pylist(out[at : at + 1024], schema)

    return run


def _solved(costs: Costs, schema: pa.Schema):
    def run(table: pa.Table) -> pa.Table:
        found = sorted(table.to_pylist(), key=lambda r: r["place"])
        rows = [(r["turn"], r["initial"], r["blank"], not r["new"], r["truncated"]) for r in found]
        ways = [{"start": a, "end": b, "cost": c, "audit": x} for (a, b), (c, x) in Lattice(costs).table(_edited(rows)).items()]
        one = {k: found[0][k] for k in ("conv_id", "part", "block")} | _summed(rows) | {"ways": ways}
        return pa.Table.from_pylist([one], schema)

    return run


def _merged(fanin: int, schema: pa.Schema):
    """One row for several stretches of a conversation that follow each other."""
    def run(table: pa.Table) -> pa.Table:
        first, *others = sorted(table.to_pylist(), key=lambda r: (r["part"], r["block"]))
        ways = {(w["start"], w["end"]): (w["cost"], w["audit"]) for w in first["ways"]}
        for r in others:
            ways = joined(ways, {(w["start"], w["end"]): (w["cost"], w["audit"]) for w in r["ways"]})
            for c in _SUMS:
                first[c] += r[c]
            first["illegal"] += first["last"] + r["first"] not in ("su", "ua", "au")
            first["turns"] -= first["most"] is not None and first["most"] == r["least"]
            first["least"] = r["least"] if first["least"] is None else first["least"]
            first["most"] = first["most"] if r["most"] is None else r["most"]
            first["last"] = r["last"]
        first["ways"] = [{"start": a, "end": b, "cost": c, "audit": x} for (a, b), (c, x) in ways.items()]
        first["part"], first["block"] = first["part"] // fanin, 0
        return pa.Table.from_pylist([first], schema)

    return run


def _closed(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ways = {(w["start"], w["end"]): (w["cost"], w["audit"]) for w in r["ways"]}
                out.append({"conv_id": r["conv_id"], **_report(r, min(ways[EMPTY, q] for q in ENDS if (EMPTY, q) in ways))})
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _turns(digests: bool, schema: pa.Schema):
    """From each conversation's edits and then its rows, what is repaired: its rows, or their digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, spelled, digest = [], None, None, None

        def take(turns) -> None:
            for place, role, text in turns:
                if digests:
                    digest.update((f"\n{role}:{text}" if place else f"{role}:{text}").encode())
                else:
                    out.append({"conv_id": now, "place": place, "role": role, "text": text})

        def close() -> None:
            if spelled is not None:
                take(spelled.end())
                if digests:
                    out.append({"conv_id": now, "repaired_sha256": digest.hexdigest()})

        for batch in batches:
            for conv_id, audit, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text"))):
                if audit is not None:
                    close()
                    now, spelled, digest = conv_id, Spelled(audit), hashlib.sha256()
                else:
                    take(spelled.row(role, text))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


@dataclass(frozen=True)
class Repaired:
    """`report`: `conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`, a row per conversation.
    `turns`: `conv_id, place, role, text`, the repaired rows. `digests`: `conv_id, repaired_sha256` of the repaired
    `role:text`, joined by newlines."""

    report: DataFrame
    turns: DataFrame
    digests: DataFrame


def _arrow(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def repair(messages: DataFrame, costs: Costs = Costs(), block: int = BLOCK) -> Repaired:
    """Repair the conversations of `conv_id, turn, role, text`; other columns are not read.

    Rows are taken by turn (nulls first), rows of one turn by role and then by the SHA-256 of their text. A role counts
    by its first character. Null roles and texts are one space; rows without conv_id are one conversation. Of rows that
    repeat role and text within a conversation all but the first are duplicates and go, as blank ones do. An empty
    text is blank; a role that is empty or unknown can only be changed or deleted. Without rows the result has none.

    A conversation of any size is read by as many tasks as its rows need; only the digest of its repaired text, a chain
    by nature, is made by one task, which reads a row at a time. Its audit is a value of a row, a letter per row.
    """
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    rows = rows.withColumns({
        "digest": F.unhex(F.sha2("text", 256)), "blank": blank(F.col("text")), "truncated": truncated(F.col("text")),
        "salt": F.monotonically_increasing_id(),  # rows that agree in all else may be dealt to several tasks
    })
    order = ["conv_id", "turn", "role", "digest", "salt"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    read = stored(ordered.mapInArrow(_read(costs, block, _arrow(_READ)), _READ))

    done, pieces = read.filter("done"), read.filter("NOT done")
    line = F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"]))
    whole = done.select("conv_id", F.sha2(F.array_join(line, "\n"), 256).alias("repaired_sha256"))
    spot = ["part", "block", "place"]
    firsts = pieces.groupBy("conv_id", "role", "digest").agg(F.min(F.struct(*spot)).alias("at"))
    light = pieces.select(*spot, "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "blank", "truncated").join(
        firsts.select("at.*", F.lit(True).alias("new")), spot, "left"
    ).withColumn("new", F.coalesce("new", F.lit(False)))
    blocks = _arrow(_BLOCK)
    state = light.groupBy("part", "block").applyInArrow(_solved(costs, blocks), _BLOCK)
    state = stored(state.groupBy("conv_id", "part").applyInArrow(_merged(1, blocks), _BLOCK))
    parts = (state.agg(F.max("part").alias("n")).first().n or 0) + 1
    while parts > 1:
        group = (F.col("part") / FANIN).cast("long")
        state = stored(state.groupBy("conv_id", group).applyInArrow(_merged(FANIN, blocks), _BLOCK))
        parts = -(-parts // FANIN)
    closed = f"conv_id long, {_REPORT}"
    reports = stored(state.mapInArrow(_closed(_arrow(closed)), closed))

    edits = reports.select("conv_id", F.lit(-1).cast("long").alias("part"), *(F.lit(0).cast("long").alias(c) for c in spot[1:]), "audit")
    lines = edits.unionByName(pieces.select("conv_id", *spot, "role", "text"), allowMissingColumns=True)
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", *spot).select("conv_id", "audit", "role", "text")
    turn, digest = "conv_id long, place long, role string, text string", "conv_id long, repaired_sha256 string"
    spread = done.select("conv_id", F.posexplode("repaired").alias("place", "turn"))
    return Repaired(
        done.select("conv_id", "report.*").unionByName(reports),
        spread.select("conv_id", F.col("place").cast("long").alias("place"), "turn.role", "turn.text").unionByName(
            lines.mapInArrow(_turns(False, _arrow(turn)), turn)
        ),
        whole.unionByName(lines.mapInArrow(_turns(True, _arrow(digest)), digest)),
    )


def damaged(messages: DataFrame) -> DataFrame:
    """Rows damaged by the CRC-32 of `conv_id:turn`, modulo 20 (nulls written as one space): 0 drops a row, 1 empties
    its text, 2 takes the stops out of it, 3 repeats it, 4 makes it the user's."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    rows = messages.select(
        "conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
        (F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20).alias("harm"),
    ).filter("harm != 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("harm") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def repair_report(messages: DataFrame) -> DataFrame:
    """Damage the conversations and repair them: a row for every conv_id there was, with the digest of what is repaired.
    One without rows after the damage has zeros, an empty audit and the digest of an empty text."""
    done = repair(damaged(messages))
    found = done.report.withColumnRenamed("conv_id", "of").join(
        done.digests.withColumnRenamed("conv_id", "its"), F.col("of").eqNullSafe(F.col("its"))
    )
    every = messages.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


SQL = r"""
WITH RECURSIVE
bytes AS (SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, k:
              CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
              coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
harmed AS (SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
               list_prepend(4294967295, list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT))),
               lambda c, b: xor(t[xor(c, b) % 256 + 1], c // 256))) % 20 AS harm FROM named, bytes),
rows_ AS (SELECT conv_id, turn, CASE harm WHEN 4 THEN 'user' ELSE role END AS role,
              CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
              unnest(range(CASE harm WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM harmed WHERE harm <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM rows_),
told AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
             regexp_matches(text, '[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*\z') AS cut,
             left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
               count(*) FILTER (cut AND NOT again AND NOT blank) AS truncated,
               count(*) FILTER (before IS NOT NULL AND before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM told GROUP BY conv_id),
writes(q, w, p) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
inserts(q, p, letters, cost) AS (
    SELECT q, q, '', 0 FROM range(4) t(q) UNION ALL SELECT q, p, 'I', 5 FROM writes WHERE w <> 's'
    UNION ALL SELECT a.q, b.p, 'II', 10 FROM writes a JOIN writes b ON a.p = b.q WHERE a.w <> 's' AND b.w <> 's' AND a.q <> b.p),
edits AS (
    SELECT conv_id, i, q, q AS p, 'D' AS letters, 2 AS cost FROM told, range(4) t(q)
    UNION ALL SELECT conv_id, i, q, p, CASE WHEN w = r THEN 'K' ELSE 'R' END, CASE WHEN w = r THEN 0 ELSE 1 END + CASE WHEN cut THEN 5 ELSE 0 END
              FROM told, writes WHERE NOT blank AND NOT again AND (w = r OR w <> 's')),
steps AS (SELECT conv_id, i, a.q, b.p, a.letters || b.letters AS letters, a.cost + b.cost AS cost FROM inserts a JOIN edits b ON a.p = b.q),
walk AS (
    SELECT conv_id, 0 AS i, CAST(0 AS BIGINT) AS q, '0000000000' AS way FROM counts
    UNION ALL
    SELECT w.conv_id, w.i + 1, CAST(s.p AS BIGINT), min(lpad(CAST(CAST(left(way, 10) AS BIGINT) + s.cost AS VARCHAR), 10, '0') || way[11:] || s.letters)
    FROM walk w JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i + 1 AND s.q = w.q
    GROUP BY w.conv_id, w.i, s.p),
ended AS (SELECT c.conv_id, min(lpad(CAST(CAST(left(way, 10) AS BIGINT) + s.cost AS VARCHAR), 10, '0') || way[11:] || s.letters) AS way
          FROM counts c JOIN walk w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n JOIN inserts s ON s.q = w.q AND s.p IN (0, 3)
          GROUP BY c.conv_id),
letters AS (SELECT conv_id, x, k, length(replace(way[11:], 'D', '')) % 2 AS odd,
                count(*) FILTER (x <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i,
                count(*) FILTER (x <> 'D') OVER (PARTITION BY conv_id ORDER BY k) AS place
            FROM (SELECT conv_id, way, unnest(string_split(way[11:], '')) AS x, generate_subscripts(string_split(way[11:], ''), 1) AS k FROM ended) s),
spelled AS (SELECT l.conv_id, string_agg(CASE WHEN x = 'K' THEN role WHEN (place - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END
                || ':' || CASE WHEN x = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS line
            FROM letters l LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM l.conv_id AND t.i = l.i WHERE x IN ('K', 'R', 'I') GROUP BY l.conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(left(way, 10) AS BIGINT), 0) AS cost,
       coalesce(way[11:], '') AS audit, sha256(coalesce(line, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
     LEFT JOIN ended d ON d.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN spelled s ON s.conv_id IS NOT DISTINCT FROM e.conv_id"""

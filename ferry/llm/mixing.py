"""Mixing sources to target weights by min-cost flow over membership patterns."""

from __future__ import annotations

import json
from collections import defaultdict, deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import WORD, quoted, stored, whole

#: Rows of a table of patterns that is broadcast; a larger one meets the documents by a shuffle.
MOST_BROADCAST = 20_000
BINS = 1024


def targets(
    sizes: dict[str | None, int], weights: dict[str | None, float], share: float = 1.5, cap: float = 2.0
) -> dict[str | None, float]:
    """What each source is to give: `share` of all sizes by weight, at most `cap` times its own size. What is over
    goes to the sources that are still below, by weight, until none is above."""
    found: dict[str | None, float] = {}
    rest, below = share * sum(sizes.values()), list(sizes)
    while below:
        total = sum(weights[s] for s in below)
        given = {s: rest * weights[s] / total if total else 0.0 for s in below}
        above = [s for s in below if given[s] > cap * sizes[s]]
        if not above:
            return found | given
        found |= {s: cap * float(sizes[s]) for s in above}
        rest, below = rest - sum(found[s] for s in above), [s for s in below if s not in above]
    return found


class Flow:
    """Largest flow by blocking flows: levels by breadth, then paths down the levels until none is left. Arcs may be added
    between runs; what flows already stays."""

    def __init__(self, nodes: int):
        self.of: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []  # an arc's reverse is its number with the last bit turned

    def add(self, a: int, b: int, room: int) -> int:
        for at, to, free in ((a, b, room), (b, a, 0)):
            self.of[at].append(len(self.to))
            self.to.append(to)
            self.room.append(free)
        return len(self.to) - 2

    def through(self, arc: int) -> int:
        return self.room[arc ^ 1]

    def _levels(self, source: int, sink: int) -> list[int]:
        level, queue = [-1] * len(self.of), deque([source])
        level[source] = 0
        while queue:
            a = queue.popleft()
            for arc in self.of[a]:
                if self.room[arc] and level[self.to[arc]] < 0:
                    level[self.to[arc]] = level[a] + 1
                    queue.append(self.to[arc])
        return level

    def run(self, source: int, sink: int) -> None:
        while (level := self._levels(source, sink))[sink] >= 0:
            tried, path, at = [0] * len(self.of), [], source
            while True:
                if at == sink:
                    room = min(self.room[arc] for arc in path)
                    for arc in path:
                        self.room[arc] -= room
                        self.room[arc ^ 1] += room
                    full = next(k for k, arc in enumerate(path) if not self.room[arc])
                    at = self.to[path[full] ^ 1]
                    del path[full:]
                elif tried[at] < len(self.of[at]):
                    arc = self.of[at][tried[at]]
                    if self.room[arc] and level[self.to[arc]] == level[at] + 1:
                        path.append(arc)
                        at = self.to[arc]
                    else:
                        tried[at] += 1
                elif path:  # no way on from here
                    at = self.to[path.pop() ^ 1]
                    tried[at] += 1
                else:
                    break


def _together(patterns: list[tuple]) -> list[list[tuple]]:
    """Patterns that share sources, directly or through others: each lot is a problem of its own."""
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for p in patterns:
        for s in p[1:]:
            root[find(s)] = find(p[0])
    lots: dict = defaultdict(list)
    for p in patterns:
        lots[find(p[0])].append(p)
    return list(lots.values())


def arcs(tokens: dict[tuple, int], quotas: dict[str | None, int], epochs: int = 2) -> dict[tuple, dict[str | None, int]]:
    """Tokens that each membership pattern gives to each of its sources, so that the sources' quotas are met as far as they
    can be and, among such ways, at the least cost.

    Each pattern offers its tokens once per epoch, the e-th time at cost e - 1 per token: costs are convex, so all fresh
    text that can serve a quota goes before anything is repeated. As only these first arcs cost anything, and a flow that
    grows never takes one of them back, the cheapest largest flow is made by letting the epochs in one after another.
    Patterns that share no source, even through others, are solved apart; most are alone with their source.
    """
    given: dict[tuple, dict] = {p: {} for p in tokens}
    for lot in _together(sorted((p for p in tokens if p), key=repr)):
        if len(lot) == 1 and len(lot[0]) == 1:
            (p,) = lot
            given[p] = {p[0]: min(quotas[p[0]], epochs * tokens[p])}
            continue
        sources = sorted({s for p in lot for s in p}, key=lambda s: (s is None, s or ""))
        flow, at = Flow(2 + len(lot) + len(sources)), {s: 2 + len(lot) + i for i, s in enumerate(sources)}
        inner = {(p, s): flow.add(2 + i, at[s], epochs * tokens[p]) for i, p in enumerate(lot) for s in p}
        for s in sources:
            flow.add(at[s], 1, quotas[s])
        for _ in range(epochs):
            for i, p in enumerate(lot):
                flow.add(0, 2 + i, tokens[p])
            flow.run(0, 1)
        for p, s in inner:
            given[p][s] = flow.through(inner[p, s])
    return given


def route(tokens: dict[tuple, int], quotas: dict[str | None, int], epochs: int = 2) -> dict[tuple, int]:
    """Tokens to take from each membership pattern."""
    return {p: sum(to.values()) for p, to in arcs(tokens, quotas, epochs).items()}


def membership(sources: Column, dtype: str) -> Column:
    """The sources of a row as canonical text: one source or an array of them, sorted and without repeats."""
    as_array = sources if dtype.startswith("array") else F.array(sources)
    return F.to_json(F.array_sort(F.array_distinct(F.coalesce(as_array, F.array().cast("array<string>")))))


def _order(seed: int, id_col: Column, text: Column) -> Column:
    return F.xxhash64(F.lit(seed), id_col, text)


def plan(
    docs: DataFrame, weights=None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    share: float = 1.5, cap: int = 2, seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Size all documents and decide what the mix takes.

    Returns the sized rows, `id, pattern, place, size` (a written table), and the decisions, one row per membership
    pattern: `pattern, epochs, last_place, source_size, target`. A document is taken `epochs` times, and once more if
    its seeded `place` is not after `last_place`. Sizes are summed by pattern and by 1,024 ranges of the place; only the
    range where a quota ends is looked at row by row. The driver gets a row per pattern: names of sources and a number, so
    their kinds are what bounds it, not the documents.

    weights: from the sorted names of the sources (by code point, null last) to their weights; as given in the contract,
    3, 1, 2 and again, if None.
    """
    spark, dtype = docs.sparkSession, dict(docs.dtypes)[source_col]
    text = whole(text_col)
    rows = stored(docs.select(
        F.col(id_col).alias("id"), membership(F.col(source_col), dtype).alias("pattern"),
        _order(seed, F.col(id_col), text).alias("place"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
    ))
    sums = rows.groupBy("pattern").agg(F.sum("size").alias("size")).collect()
    tokens = {tuple(json.loads(r.pattern)): r["size"] for r in sums}
    text_of = {tuple(json.loads(r.pattern)): r.pattern for r in sums}
    sources = sorted({s for p in tokens for s in p}, key=lambda s: (s is None, s or ""))
    sizes = dict.fromkeys(sources, 0)
    for p, n in tokens.items():
        for s in p:
            sizes[s] += n
    wanted = targets(sizes, (weights or contract_weights)(sources), share, cap)
    taken = route(tokens, {s: round(wanted[s]) for s in sources}, cap)
    epochs = {p: taken[p] // n if n else 0 for p, n in tokens.items()}
    rest = {p: taken[p] - epochs[p] * n for p, n in tokens.items()}
    last = _last_places(rows, {text_of[p]: n for p, n in rest.items() if n})
    decisions = [(
        text_of[p], epochs[p], last.get(text_of[p]), sizes[p[0]] if p else 0, wanted[p[0]] if p else 0.0,
    ) for p in tokens]
    schema = "pattern string, epochs long, last_place long, source_size long, target double"
    return rows, _small(spark.createDataFrame(decisions, schema), len(decisions))


def _small(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= MOST_BROADCAST else table


def _last_places(rows: DataFrame, rest: dict[str, int]) -> dict[str, int]:
    """For each pattern the last place, in seeded order, at which the sum of sizes comes nearest to the rest."""
    spark = rows.sparkSession
    wanted = _small(spark.createDataFrame(list(rest.items()), "pattern string, rest long"), len(rest))
    range_of = F.shiftright("place", 54).alias("bin")  # -512 to 511
    up_to = Window.partitionBy("pattern").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = rows.select("pattern", range_of, "size").groupBy("pattern", "bin").agg(F.sum("size").alias("n"))
    bins = bins.join(wanted, "pattern").withColumn("after", F.sum("n").over(up_to)).withColumn(
        "before", F.col("after") - F.col("n")
    )
    ends = bins.filter("before < rest AND after >= rest").select("pattern", "bin", "before", "rest").collect()
    ends = _small(spark.createDataFrame(ends, "pattern string, bin long, before long, rest long"), len(ends))
    places = rows.withColumn("bin", range_of.cast("long")).join(ends, ["pattern", "bin"])
    places = places.groupBy("pattern", "place", "before", "rest").agg(F.sum("size").alias("n"))
    each = Window.partitionBy("pattern").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    places = places.withColumn("after", F.col("before") + F.sum("n").over(each))
    nearest = F.min_by(F.col("place"), F.struct(F.abs(F.col("after") - F.col("rest")), F.col("place")))
    start = F.min(F.abs(F.col("after") - F.col("rest"))) < F.first(F.col("rest") - F.col("before"))
    before = F.shiftleft(F.min(F.shiftright("place", 54)), 54) - 1  # no document of this range
    found = places.groupBy("pattern").agg(F.when(start, nearest).otherwise(before).alias("last"))
    return {r.pattern: r["last"] for r in found.collect()}


def contract_weights(sources: Sequence[str | None]) -> dict[str | None, float]:
    return {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(sources)}


def _times(decisions: DataFrame) -> Column:
    return F.col("epochs") + F.when(F.col("last_place").isNotNull() & (F.col("place") <= F.col("last_place")), 1).otherwise(0)


def mix_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **settings
) -> DataFrame:
    """A row for each row of `docs`: `<id_col>, size, source_size, target, taken`.

    size: words of the whole text (null: 0). source_size and target belong to the document's source (the first by code
    point, if several).
    taken: words the mix takes, repeats counted; a document is taken whole, 0 to `cap` times. Each source's sum comes as
    near its target as one document allows. A null source is a source of its own, last in order; an empty array of
    sources is never taken. Rows that repeat an identifier with equal texts are taken alike. The seed fixes the choice,
    so reruns agree. Other columns are not read.
    """
    rows, decisions = plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, **settings)
    return rows.join(decisions, "pattern").select(
        F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * _times(decisions)).alias("taken")
    )


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 0, **settings
) -> DataFrame:
    """The documents as the mix takes them: one taken twice is there twice, with all its columns, whatever these are called.
    Null and empty texts have no words, so they weigh nothing and are there as often as all of their source; a null source
    is one of its own. Rows that repeat are taken alike. Texts are not shuffled."""
    _, decisions = plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed, **settings)
    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"))  # columns may have any names
    of = membership(F.col("row")[source_col], dict(docs.dtypes)[source_col])
    place = _order(seed, F.col("row")[id_col], whole(F.col("row")[text_col]))
    taken = rows.withColumns({"pattern": of, "place": place}).join(decisions, "pattern")
    taken = taken.select("row", _times(decisions).cast("int").alias("times")).filter("times > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), "times")).alias("copy")).select("row.*")

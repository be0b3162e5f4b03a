"""Secret scan: base patterns, and windows of high entropy slid over candidate strings, with DataFrame functions alone."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import whole

#: The base kinds as the contract lists them, with the least length of the stated group.
BASE = {
    "assign": (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
               r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
}
#: Entropy kinds: the alphabet of the class as written in a regular expression and in full, and the least bits per
#: character of a window.
CLASSES = {
    "entropy_hex": ("[0-9A-Fa-f]", "0123456789ABCDEFabcdef", 3.0),
    "entropy_base64": ("[A-Za-z0-9+/_=-]", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.8),
}
#: Allow-list: candidates that are known not to be secrets, each matched in full, so that one with a secret beside a word
#: is not let off. UUIDs, digits or one-case letters alone; words, each capitalised or not and with a few digits behind it,
#: joined as paths and names are; documented examples, which end in a word of their own.
ALLOWED = (
    r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
    r"[0-9_=-]+", r"[a-z_=-]+", r"[A-Z_=-]+",
    r"[/_-]*[A-Z]?[a-z]+[0-9]{0,4}([/_-]+[A-Z]?[a-z]*[0-9]{0,4})*",
    r"[A-Za-z0-9/+]*EXAMPLE(KEY)?",
)
WINDOW = 20
CHUNK = 1024
#: Entropies are compared as whole numbers: c * log2(c) in units of 2**-20, so that every engine decides alike.
UNIT = 1 << 20


def weights(window: int) -> list[int]:
    return [round(c * math.log2(c) * UNIT) if c else 0 for c in range(window + 2)]


def most_weight(window: int, bits: float) -> int:
    """A window has at least `bits` of entropy per character if the weights of its counts add up to no more than this."""
    return math.floor(window * (math.log2(window) - bits) * UNIT)


def _matches(text: Column, found: Column, pattern: str, group: int) -> Column:
    """The matches found in a text, in order: characters before it since the last one, its length, and the group's text.

    `split` gives what lies between the matches; it only runs on texts that have some."""
    values = F.transform(found, lambda m: F.regexp_extract(m, pattern, group)) if group else found
    matches = F.arrays_zip(
        F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), F.char_length).alias("gap"),
        F.transform(found, F.char_length).alias("length"), values.alias("value"),
    )
    return F.when(F.size(found) > 0, matches).otherwise(F.slice(F.array(F.struct(
        F.lit(0).alias("gap"), F.lit(0).alias("length"), F.lit("").alias("value"))), 1, 0))


def _placed(matches: Column) -> Column:
    """The matches with the place where each starts. Runs over chunks, as an array that grows is copied at each step."""
    empty = F.slice(
        F.transform(matches, lambda m: F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), m["value"].alias("value"))),
        1, 0,
    )

    def step(s: Column, m: Column) -> Column:
        start = s["at"] + m["gap"]
        return F.struct((start + m["length"]).alias("at"), F.array_append(
            s["spans"], F.struct(start.alias("start"), (start + m["length"]).alias("end"), m["value"].alias("value"))).alias("spans"))

    def chunk(s: Column, c: Column) -> Column:
        inner = F.aggregate(
            F.slice(matches, c * CHUNK + 1, F.lit(CHUNK)), F.struct(s["at"].alias("at"), empty.alias("spans")), step
        )
        return F.struct(inner["at"].alias("at"), F.array_append(s["spans"], inner["spans"]).alias("spans"))

    chunks = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / CHUNK).cast("int"))
    start = F.struct(F.lit(0).alias("at"), F.slice(F.array(empty), 1, 0).alias("spans"))
    return F.when(F.size(matches) > 0, F.flatten(F.aggregate(chunks, start, chunk)["spans"])).otherwise(empty)


def _allowed(value: Column, allowed: tuple[str, ...]) -> Column:
    return value.rlike("^(" + "|".join(f"({a})" for a in allowed) + ")$")


def _windows(value: Column, alphabet: str, bits: float, window: int) -> Column:
    """Spans of a candidate that its windows of high entropy cover, overlapping ones as one.

    The counts of the characters in the window are carried along; each step adds the character that enters, takes off
    the one that leaves, and corrects the sum of c * log2(c) by those two counts alone. Only the span that may still grow
    is carried with them: those that are closed wait in a list per chunk of characters, as a list that grows is copied
    at each step."""
    table = F.array(*(F.lit(w).cast("long") for w in weights(window)))
    none = F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("end"))
    empty = F.slice(F.array(none), 1, 0)
    codes = F.transform(F.split(value, ""), lambda c: F.call_function("locate", c, F.lit(alphabet)) - 1)

    def step_over(codes: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            enter = F.get(codes, i)
            leave = F.when(i >= window, F.get(codes, i - window)).otherwise(-1)
            up = F.get(s["counts"], enter)
            down = F.get(s["counts"], leave) + F.when(leave == enter, 1).otherwise(0)
            weight = s["weight"] + F.get(table, up + 1) - F.get(table, up) + F.when(leave >= 0, F.get(table, down - 1) - F.get(table, down)).otherwise(0)
            counts = F.transform(s["counts"], lambda n, k: n + (k == enter).cast("int") - (k == leave).cast("int"))
            first = i - (window - 1)
            high = (first >= 0) & (weight <= most_weight(window, bits))
            joins = s["open"]["end"] >= first
            closes = high & ~joins & (s["open"]["end"] >= 0)
            span = F.struct(F.when(joins & (s["open"]["end"] >= 0), s["open"]["start"]).otherwise(first).alias("start"), (i + 1).alias("end"))
            return F.struct(
                counts.alias("counts"), weight.alias("weight"), F.when(high, span).otherwise(s["open"]).alias("open"),
                F.when(closes, F.array_append(s["spans"], s["open"])).otherwise(s["spans"]).alias("spans"),
            )

        def chunk(s: Column, c: Column) -> Column:
            places = F.sequence(c * CHUNK, F.least(c * CHUNK + CHUNK, F.size(codes)) - 1)
            start = F.struct(s["counts"].alias("counts"), s["weight"].alias("weight"), s["open"].alias("open"), empty.alias("spans"))
            inner = F.aggregate(places, start, step)
            return F.transform(F.array(inner), lambda x: F.struct(
                x["counts"].alias("counts"), x["weight"].alias("weight"), x["open"].alias("open"),
                F.when(F.size(x["spans"]) > 0, F.array_append(s["spans"], x["spans"])).otherwise(s["spans"]).alias("spans"),
            ))[0]

        start = F.struct(
            F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0).cast("long").alias("weight"), none.alias("open"),
            F.slice(F.array(empty), 1, 0).alias("spans"),
        )
        chunks = F.sequence(F.lit(0), F.floor((F.size(codes) - 1) / CHUNK).cast("int"))
        return F.aggregate(chunks, start, chunk, lambda s: F.concat(
            F.flatten(s["spans"]), F.filter(F.array(s["open"]), lambda x: x["end"] >= 0)
        ))

    return F.element_at(F.transform(F.array(codes), step_over), 1)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    classes: dict[str, tuple[str, str, float]] = CLASSES, allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """Find secrets in every whole text. A row for each row of `docs`: `<id_col>, base, entropy`, arrays of `(kind,
    start, end)` in characters (code points), ends exclusive.

    `base` holds the matches of the fixed patterns that are long enough; the allow-list does not touch them. `entropy`
    holds, for each class of characters, what windows of high Shannon entropy cover in its runs of at least `window`
    characters; a run that the allow-list names in full is left out. Null text is empty and has neither. Nothing is
    shuffled and repeated rows are scanned alike. Other columns are not read.
    """
    text = F.col("text")
    df = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"))
    patterns = {k: (p, g) for k, (p, g, _) in BASE.items()} | {
        k: (f"{chars}{{{window},}}", 0) for k, (chars, _, _) in classes.items()
    }
    df = df.select(
        "id", "text", *(F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(k) for k, (p, _) in patterns.items())
    )
    df = df.select("id", *(_matches(text, F.col(k), p, g).alias(k) for k, (p, g) in patterns.items()))
    df = df.select("id", *(_placed(F.col(k)).alias(k) for k in patterns))

    def named(kind: str, spans: Column) -> Column:
        return F.transform(
            spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
        )

    def base(kind: str, least: int) -> Column:
        return named(kind, F.filter(F.col(kind), lambda m: F.char_length(m["value"]) >= least))

    def entropy(kind: str, alphabet: str, bits: float) -> Column:
        candidates = F.filter(F.col(kind), lambda m: ~_allowed(m["value"], allowed))
        return named(kind, F.flatten(F.transform(candidates, lambda m: F.transform(
            _windows(m["value"], alphabet, bits, window),
            lambda s: F.struct((s["start"] + m["start"]).alias("start"), (s["end"] + m["start"]).alias("end"))))))

    return df.select(
        F.col("id").alias(id_col),
        F.concat(*(base(k, least) for k, (_, _, least) in BASE.items())).alias("base"),
        F.concat(*(entropy(k, alphabet, bits) for k, (_, alphabet, bits) in classes.items())).alias("entropy"),
    )


def digest(spans: Column, kinds: list[str]) -> Column:
    """`kind:start:end` of all spans, by start and then by the order of the kinds, joined by commas."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, kinds)), s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """The scan as counts and digests: a row for each row of `docs`, repeated ones too. Null and empty texts have no spans and
    the digest of an empty text."""
    kinds = [*BASE, *CLASSES]
    found = scan(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, BASE), F.sha2(digest(F.col("base"), kinds), 256).alias("base_sha256"),
        digest(F.concat("base", "entropy"), kinds).alias("spans"),
    )


def _sql() -> str:
    """The report in DuckDB: every window's entropy on its own, from counts of its characters."""
    kinds = [*BASE, *CLASSES]
    patterns = {k: (p, g, least) for k, (p, g, least) in BASE.items()} | {
        k: (f"{chars}{{{WINDOW},}}", 0, 0) for k, (chars, _, _) in CLASSES.items()
    }
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    found = " UNION ALL ".join(
        f"SELECT row, {i} AS rank, '{kind}' AS kind, regexp_extract_all(text, {quoted(p)}, 0) AS m, regexp_extract_all(text, {quoted(p)}, {g}) AS v, "
        f"string_split_regex(text, {quoted(p)}) AS gaps, {least} AS least FROM docs"
        for i, (kind, (p, g, least)) in enumerate(patterns.items()))
    limits = " ".join(f"WHEN '{k}' THEN {most_weight(WINDOW, bits)}" for k, (_, _, bits) in CLASSES.items())
    allowed = quoted("|".join(f"({a})" for a in ALLOWED))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
     found AS ({found}),
     each AS (SELECT row, rank, kind, least, unnest(range(1, len(m) + 1)) AS i, m, v, gaps FROM found WHERE len(m) > 0),
     placed AS (SELECT row, rank, kind, least, v[i] AS value, length(m[i]) AS size,
                       list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS start FROM each),
     base AS (SELECT row, rank, kind, start, start + size AS "end" FROM placed WHERE rank < {len(BASE)} AND length(value) >= least),
     candidates AS (SELECT row, rank, kind, start, value, unnest(range(0, size - {WINDOW - 1})) AS i
                    FROM placed WHERE rank >= {len(BASE)} AND NOT regexp_full_match(value, {allowed})),
     windows AS (SELECT row, rank, kind, start, i, list_sum(list_transform(list_distinct(string_split(value[i + 1 : i + {WINDOW}], '')),
                     lambda c: {weights(WINDOW)}[{WINDOW + 1} - length(replace(value[i + 1 : i + {WINDOW}], c, ''))])) AS weight FROM candidates),
     high AS (SELECT *, i > coalesce(lag(i) OVER part + {WINDOW}, -1) AS begins FROM windows
              WHERE weight <= CASE kind {limits} END WINDOW part AS (PARTITION BY row, rank, start ORDER BY i)),
     runs AS (SELECT *, sum(CAST(begins AS INTEGER)) OVER (PARTITION BY row, rank, start ORDER BY i) AS run FROM high),
     entropy AS (SELECT row, rank, kind, start + min(i) AS start, start + max(i) + {WINDOW} AS "end" FROM runs GROUP BY row, rank, kind, runs.start, run),
     spans AS (SELECT row, rank, kind, CAST(start AS BIGINT) AS start, CAST("end" AS BIGINT) AS "end" FROM base UNION ALL SELECT * FROM entropy),
     joined AS (SELECT row, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)},
                       string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank, "end") FILTER (rank < {len(BASE)}) AS base,
                       string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank, "end") AS spans FROM spans GROUP BY row)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (row)"""


SQL = _sql()

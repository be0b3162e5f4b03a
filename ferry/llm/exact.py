"""Exact deduplication by a tree merge of sorted digest runs, with DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import SPACE, quoted, stored, whole

#: What must agree for two texts to count as one: SHA-256, length in bytes, and an unrelated 64-bit hash.
KEY = ["digest", "n_bytes", "witness"]
#: Rows of a block, about.
BLOCK = 4096


def normalised(text: Column | str) -> Column:
    """The text with each run of white space as one space; null is empty."""
    return F.regexp_replace(whole(text), SPACE, " ")


def _merged(runs: Column, fan_in: int) -> Column:
    """Sorted runs as one: an entry of each key, with the smallest identifier and the sum of the counts.

    Sorting what follows each other in order is a merge. No run has a key twice, so entries of one lie within `fan_in`
    places, the smallest identifier first; equality is that of the whole key, field by field.
    """
    def differs(x: Column, y: Column) -> Column:
        return y.isNull() | ~F.forall(F.array(*(x[k].eqNullSafe(y[k]) for k in KEY)), lambda same: same)

    def merge(s: Column) -> Column:
        def entry(x: Column, i: Column) -> Column:
            n = x["n"]
            for k in range(1, fan_in):
                other = F.get(s, i + k)
                n = n + F.when(differs(x, other), F.lit(0).cast("long")).otherwise(other["n"])
            first = (i == 0) | differs(x, F.get(s, i - 1))
            return F.struct(*(x[k].alias(k) for k in (*KEY, "none", "keep_id")), n.alias("n"), first.alias("first"))

        kept = F.filter(F.transform(s, entry), lambda x: x["first"])
        return F.transform(kept, lambda x: F.struct(*(x[k].alias(k) for k in (*KEY, "none", "keep_id", "n"))))

    return F.transform(F.array(F.array_sort(F.flatten(runs))), merge)[0]


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3, fan_in: int = 4, block: int = BLOCK
) -> DataFrame:
    """Group rows whose texts are equal after each run of white space has become one space.

    Rows are dealt to `fan_in ** rounds` runs, each sorted by digest, in blocks of one range of digests and about `block`
    rows or fewer. In each round the blocks of a range of `fan_in` runs are merged, as in a binomial tree, until one run
    holds, for every digest, the smallest identifier and the count. A run has a key once, however many copies its rows
    are, so a block holds no more keys than its range has. The way back down joins the result to the runs and those to
    the rows, so a group that holds a third of all rows is spread over all runs. Equality is checked at every level on the
    whole key: SHA-256, byte length and a 64-bit hash of another kind stand for the texts.

    Returns a row for each row of `docs`: `<id_col>, keep_id, group_size, kept, text_sha256`.
    Null text is empty. Rows that repeat an identifier are one document: with equal texts they share its decision and
    each counts in `group_size`. A null identifier stays only if its whole group has none. Other columns are not read.
    """
    rows = stored(
        docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("text")).select(
            "id", F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").alias("n_bytes"),
            F.xxhash64("text").alias("witness"),
        ).withColumn("run", F.pmod(F.xxhash64("id", "digest"), F.lit(fan_in**rounds)).cast("int"))
    )
    leaves = stored(rows.groupBy("run", *KEY).agg(F.min("id").alias("keep_id"), F.count("*").alias("n")))
    ranges = max(1, rows.count() // block)
    lead = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long")
    entry = F.struct(*KEY, F.col("keep_id").isNull().alias("none"), "keep_id", "n")
    runs = leaves.select("run", F.shiftright(lead * ranges, 32).alias("range"), entry.alias("entry"))
    runs = runs.groupBy("run", "range").agg(F.array_sort(F.collect_list("entry")).alias("entries"))
    for _ in range(rounds):
        runs = runs.groupBy(F.floor(F.col("run") / fan_in).cast("int").alias("run"), "range").agg(
            _merged(F.collect_list("entries"), fan_in).alias("entries")
        )
    top = runs.select(F.inline("entries")).select(*KEY, "keep_id", F.col("n").alias("group_size"))
    down = leaves.select("run", *KEY).join(top, KEY)
    return rows.join(down, ["run", *KEY]).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with their columns, whatever these are called. Rows that repeat an identifier stay or go
    together if their texts are equal. Texts meet their decision by identifier and digest: one shuffle of the rows that
    stay or go."""
    kept = exact_groups(docs, id_col, text_col).filter("kept")
    kept = kept.select(F.col(id_col).alias("id"), F.col("text_sha256").alias("sha")).distinct()
    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("row")).select(
        "row", F.col("row")[id_col].alias("own_id"), F.sha2(normalised(F.col("row")[text_col]), 256).alias("own_sha")
    )
    same = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_sha") == F.col("sha"))
    return rows.join(kept, same, "left_semi").select("row.*")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d"""

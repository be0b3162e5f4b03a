"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import binary, pieces, quoted, stored
from ferry.llm.components import components

BITS = 64


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The SimHash of a text: bit i is 1 if it is set in over half of the hashes of its word shingles, repeats included.
    Fewer words than a shingle: the hash of them all; no word: zero."""
    words = text.lower().split()  # of bytes: A-Z alone change, and ASCII white space alone separates
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n].tolist(), ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 15):
        slices = zip(starts[at : at + (1 << 15)], ends[at : at + (1 << 15)])
        hashes = np.array([digest(joined[a:b], seed) for a, b in slices], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42
) -> DataFrame:
    """`id, fp`: the fingerprint of each row's whole text (null: empty), as a signed 64-bit number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                found = [fingerprint(t, shingle, seed) for t in binary(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.int64())], ["id", "fp"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, fp long")


def masks(radius: int, level: int = 0) -> list[int]:
    """The covering code: bit i of a fingerprint gets a non-zero vector v(i) of radius + 1 bits, and table t, for every
    non-zero t, keeps the bits whose v(i) has an odd number of ones in common with t. Any `radius` bits have vectors
    that leave some t with even numbers on all of them, so a pair that differs in those bits alone agrees on what table
    t keeps. Another level deals the vectors to the bits in another order."""
    vectors = 1 + np.random.default_rng(level).permutation(BITS) % (2 ** (radius + 1) - 1)
    found = []
    for t in range(1, 2 ** (radius + 1)):
        odd = [int(v & t).bit_count() & 1 for v in vectors.tolist()]
        mask = sum(bit << i for i, bit in enumerate(odd))
        found.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return found


def in_tables(points: DataFrame, radius: int, level: int) -> DataFrame:
    """Each point once for each table of the code: `bucket` so far and what the table keeps make the new bucket."""
    tables = F.array(
        *(F.struct(F.lit(t).alias("t"), F.lit(m).cast("long").alias("m")) for t, m in enumerate(masks(radius, level)))
    )
    return points.withColumn("__t", F.explode(tables)).select(
        F.xxhash64("bucket", F.col("__t.t"), F.col("fp").bitwiseAND(F.col("__t.m"))).alias("bucket"), "fp"
    )


def forest(fps: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Links that connect what is connected at the radius among the fingerprints: each to the smallest of its tree.
    A search takes every point off the list once and compares it with those still on it."""
    left = np.sort(fps)
    while len(left) > 1:
        root, frontier, left = int(left[0]), [left[0]], left[1:]
        while frontier and len(left):
            near = np.bitwise_count(left ^ frontier.pop()) <= radius
            if near.any():
                frontier += list(left[near])
                yield from ((root, int(x)) for x in left[near])
                left = left[~near]


def bucket_links(radius: int):
    """For partitions sorted by bucket: the links inside each bucket. Holds one bucket at a time beside a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_b, held_f = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in _ended(batches):
            if batch is not None:
                held_b = np.concatenate((held_b, batch.column(0).to_numpy()))
                held_f = np.concatenate((held_f, batch.column(1).to_numpy()))
                done = int(np.searchsorted(held_b, held_b[-1])) if len(held_b) else 0  # the last bucket may go on
            else:
                done = len(held_b)
            b, f = held_b[:done], held_f[:done].view(np.uint64)
            held_b, held_f = held_b[done:], held_f[done:]
            cuts = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1], [True]))) if done else np.zeros(1, np.int64)
            sizes = np.diff(cuts)
            two = cuts[:-1][sizes == 2]
            near = np.bitwise_count(f[two] ^ f[two + 1]) <= radius if len(two) else np.zeros(0, bool)
            links = [np.stack((f[two][near], f[two + 1][near]), 1)]
            for start, size in zip(cuts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                if found := list(forest(f[start : start + size], radius)):
                    links.append(np.array(found, np.uint64))
            pairs = np.concatenate(links).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return run


def _ended(batches):
    yield from batches
    yield None


def links(points: DataFrame, radius: int = 3, most: int = 4096) -> DataFrame:
    """Pairs `a, b` of the distinct fingerprints in `points` (column `fp`) whose connections are those of all pairs
    within `radius` bits. A bucket of over `most` fingerprints is dealt again by another covering code, which also
    covers every pair inside it, until none is larger: each level fixes about half of the bits that still vary, so this
    ends after a few levels, and no bucket is cut or skipped."""
    open_, found, level = points.select(F.lit(0).cast("long").alias("bucket"), "fp"), None, 0
    while True:
        dealt = stored(in_tables(open_, radius, level))
        sizes = dealt.groupBy("bucket").count()
        sized = dealt.join(sizes.filter(F.col("count") > 1), "bucket")
        here = sized.filter(F.col("count") <= most).select("bucket", "fp").repartition("bucket").sortWithinPartitions("bucket")
        here = here.mapInArrow(bucket_links(radius), "a long, b long")
        found = here if found is None else found.union(here)
        if sizes.filter(F.col("count") > most).isEmpty():
            return found.distinct()
        level += 1
        open_ = sized.filter(F.col("count") > most).select("bucket", "fp")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3, most: int = 4096
) -> DataFrame:
    """Fingerprint every whole text and group rows that fingerprints within `radius` bits connect.

    Equal fingerprints become one point first, so copies cost nothing further; `2 ** (radius + 1) - 1` tables of a
    covering code then bring every pair within the radius together in some bucket. Each bucket gives a forest of its
    links, not its pairs, and `components` joins the forests.

    Returns a row for each row of `docs`: `<id_col>, fingerprint` (16 lowercase hex digits)`, component_id` (the
    smallest identifier that can be reached, itself included). Null and empty texts have fingerprint zero and are linked
    like any other. Rows that repeat an identifier each get their own text's result. A null identifier is never the
    smallest unless its component has no other. Other columns are not read.
    """
    rows = stored(fingerprints(docs, id_col, text_col, shingle))
    points = stored(rows.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(points, radius, most))
    points = points.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = points.groupBy("root").agg(F.min("least").alias("component_id"))
    named = points.select("fp", "root").join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """The rows of `docs` that stay, with their columns, whatever these are called: of every component the document with the
    smallest identifier, and if several rows have that, all of them. Rows without an identifier cannot be named by a
    decision, so they all stay. Null and empty texts are one component."""
    groups = near_groups(docs.filter(quoted(id_col).isNotNull()), id_col, text_col, shingle, radius)
    kept = groups.filter(quoted(id_col) == F.col("component_id")).select(quoted(id_col).alias("id")).distinct()
    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("row")).withColumn("own", F.col("row")[id_col])
    stay = rows.filter("own IS NOT NULL").join(kept, F.col("own") == F.col("id"), "left_semi")
    return stay.union(rows.filter("own IS NULL")).select("row.*")

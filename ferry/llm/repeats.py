"""Substring deduplication by suffix trees that are partitioned by prefixes of variable length.

The suffixes are those that start at each word, down to a depth of `4 * edge` words (20), as only nodes at that depth
matter. A path from the root has four edges of five words each, and an edge is its words' hash. Steps, each a job whose
rows name batches of documents in a store in the shared folder:

1. Store the texts in batches and find documents whose word sequences are the same; only the first of them goes on.
2. Leave out suffixes that cannot reach a deep internal node: those whose 20 words, by a short hash, occur in no other
   batch and once in their own. What is left of each batch is stored; the next steps read that.
3. Count suffixes by the hash of their first edge; a prefix with more than a group may hold is made longer by an edge,
   and so on.
4. Build the subtree of each group: sort the paths, compare neighbours. A deep internal node holds the starts of one
   sequence of 20 words; all but the first start are repeats.
5. Remove the words that repeats cover.

What goes to a group is one entry per path and batch, so a passage in very many documents weighs no more than the
batches it is in.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import binary, filesystem, shared_folder, stored, whole

EDGE, EDGES = 5, 4
DEPTH = EDGE * EDGES
BATCH_BYTES = 4 << 20
#: Suffixes per group, and hashes per part of the search for repeated ones: what a task holds.
GROUP = 2 << 20
EDGE_BITS = 48
_ODD = [
    np.uint64(x) for x in (
        0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
    )
]


class _Hashes(dict):
    """Hashes of the words seen so far; starts anew when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_HASHES = _Hashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of several in order."""
    total = np.zeros(len(parts[0]), np.uint64)
    for k, part in enumerate(parts):
        total = _mixed(total * _ODD[k % len(_ODD)] + part)
    return total


def _distinct(values: np.ndarray) -> np.ndarray:
    """Ascending, each once; by sorting, as numpy's own way by a hash table takes several times as long."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


class Suffixes:
    """The suffixes of some documents that are DEPTH words long or longer: for each its document, its start, and the
    edges of its path."""

    def __init__(self, words: list[list[bytes]]):
        lengths = np.array([len(w) for w in words], np.int64)
        total = int(lengths.sum())
        hashes = np.fromiter(map(_HASHES.__getitem__, chain.from_iterable(words)), np.uint64, total)
        first = np.cumsum(lengths) - lengths
        room = np.maximum(lengths - DEPTH + 1, 0)
        self.doc = np.repeat(np.arange(len(words)), room)
        self.start = np.arange(int(room.sum())) - np.repeat(np.cumsum(room) - room, room)
        at = first[self.doc] + self.start
        if not len(at):
            self.edges = [np.empty(0, np.uint64)] * EDGES
            return
        n = total - EDGE + 1
        edge = _joined([hashes[k : k + n] for k in range(EDGE)]) >> np.uint64(64 - EDGE_BITS)
        self.edges = [edge[at + EDGE * k] for k in range(EDGES)]

    def short(self, bits: int) -> np.ndarray:
        """A hash of the whole path, of so many bits."""
        return _joined(self.edges) >> np.uint64(64 - bits)

    def prefix(self, edges: int, bits: int) -> np.ndarray:
        """The part that prefixes of so many edges fall into."""
        return _joined(self.edges[:edges]) >> np.uint64(64 - bits) if bits else np.zeros(len(self.start), np.uint64)

    def taken(self, chosen: np.ndarray) -> Suffixes:
        other = object.__new__(Suffixes)
        other.doc, other.start, other.edges = self.doc[chosen], self.start[chosen], [e[chosen] for e in self.edges]
        return other


def planes(values: np.ndarray, width: int) -> bytes:
    """The low bytes of numbers, all first bytes first: alike bytes lie together."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplanes(blob: bytes, width: int) -> np.ndarray:
    n = len(blob) // width
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(blob, np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8").astype(np.uint64)


def pack(ascending: np.ndarray) -> bytes:
    """Ascending numbers as steps of a common width, which the first byte gives."""
    steps = np.diff(ascending, prepend=np.uint64(0))
    width = max(1, -(-int(steps.max(initial=np.uint64(0))).bit_length() // 8))
    return bytes([width]) + planes(steps, width)


def unpack(blob: bytes) -> np.ndarray:
    return np.cumsum(unplanes(blob[1:], blob[0]), dtype=np.uint64)


# Step 1

def store(docs: DataFrame, folder: str, id_col: str, text_col: str, batch_bytes: int) -> DataFrame:
    """Write the texts in batches to files that tasks open later, and return a row for each document: `batch, file, no`
    (of the batch in the file)`, place` (of the document in the batch)`, id, n_words, h1, h2` (of the word sequence).
    Files have names of their task attempt, and only those of committed attempts are in the table that is returned."""
    system, path = filesystem(folder)
    system.create_dir(path, recursive=True)
    names = ["batch", "file", "no", "place", "id", "n_words", "h1", "h2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        writer, file, no, ids, texts, size = None, uuid.uuid4().hex, 0, [], [], 0
        schema = pa.schema([("id", pa.int64()), ("text", pa.binary())])

        def flush() -> pa.RecordBatch:
            nonlocal writer, no, ids, texts, size
            if writer is None:
                writer = pa.ipc.new_file(
                    system.open_output_stream(f"{path}/{file}"), schema, options=pa.ipc.IpcWriteOptions(compression="zstd")
                )
            writer.write_batch(pa.record_batch([pa.array(ids, pa.int64()), pa.array(texts, pa.binary())], schema=schema))
            n, rows = len(ids), [t.split() for t in texts]
            digests = np.array([np.frombuffer(xxhash.xxh3_128_digest(b" ".join(w)), "<i8") for w in rows]).reshape(n, 2)
            made = pa.RecordBatch.from_arrays([
                pa.array([f"{file}-{no}"] * n), pa.array([file] * n), pa.array([no] * n, pa.int64()),
                pa.array(range(n), pa.int64()), pa.array(ids, pa.int64()), pa.array([len(w) for w in rows], pa.int64()),
                pa.array(np.ascontiguousarray(digests[:, 0])), pa.array(np.ascontiguousarray(digests[:, 1])),
            ], names)
            no, ids, texts, size = no + 1, [], [], 0
            return made

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), binary(batch.column(1))):
                ids.append(i)
                texts.append(text)
                size += len(text) + 64
                if size >= batch_bytes:
                    yield flush()
        if ids:
            yield flush()
        if writer is not None:
            writer.close()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text"))
    return stored(
        rows.mapInArrow(run, "batch string, file string, no long, place long, id long, n_words long, h1 long, h2 long")
    )


def read_batch(folder: str, file: str, no: int) -> tuple[list[int | None], list[bytes]]:
    system, path = filesystem(folder)
    with system.open_input_file(f"{path}/{file}") as f:
        batch = pa.ipc.open_file(f).get_batch(no)
        return batch.column(0).to_pylist(), batch.column(1).to_pylist()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {k: v[0] for k, v in batch.slice(i, 1).to_pydict().items()}


def _loaded(folder: str, row: dict) -> tuple[list[int | None], list[list[bytes]]]:
    """Identifiers and words of the documents of a batch that go on, in ascending order of the identifiers (null last)."""
    ids, texts = read_batch(folder, row["file"], row["no"])
    gone = set(row["gone"] or ())
    order = sorted((k for k in range(len(ids)) if k not in gone), key=lambda k: (ids[k] is None, ids[k] or 0, k))
    return [ids[k] for k in order], [texts[k].split() for k in order]


# Step 2

def _short_hashes(folder: str, bits: int, parts: int):
    def run(batches):
        for row in _rows(batches):
            found = _distinct(Suffixes(_loaded(folder, row)[1]).short(bits))
            some, starts = np.unique(found >> np.uint64(bits - parts), return_index=True)
            blobs = [pack(found[a:b]) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(found)])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(some.astype(np.int64)), pa.array([row["batch"]] * len(some), pa.string()),
                    pa.array(blobs, pa.binary()),
                ],
                ["part", "batch", "blob"],
            )

    return run


def _in_several(table: pa.Table) -> pa.Table:
    """For each batch's hashes in a part, one bit each: whether another batch has it as well."""
    lists = [unpack(b) for b in table.column("blob").to_pylist()]
    every = np.concatenate(lists)
    every.sort()
    several = _distinct(every[1:][every[1:] == every[:-1]])
    bits = [np.packbits(np.isin(x, several, assume_unique=True)).tobytes() for x in lists]
    return pa.table({"batch": table.column("batch"), "part": table.column("part"), "bits": pa.array(bits, pa.binary())})


def _repeated(suffixes: Suffixes, row: dict, bits: int, parts: int) -> Suffixes:
    """The suffixes whose short hash another batch has, or this one more than once."""
    hashes = suffixes.short(bits)
    found, which, times = np.unique(hashes, return_inverse=True, return_counts=True)
    keep = times > 1
    of = found >> np.uint64(bits - parts)
    for told in row["several"] or ():
        a, b = (int(np.searchsorted(of, np.uint64(told["part"]), side)) for side in ("left", "right"))
        keep[a:b] |= np.unpackbits(np.frombuffer(told["bits"], np.uint8), count=b - a).astype(bool)
    return suffixes.taken(keep[which])


def _survivors(folder: str, bits: int, parts: int, prefix_bits: int):
    """Write the repeated suffixes of each batch to a file, and count them by the part their first edge falls into. The row
    of a batch comes first; a file of another attempt is never named."""
    names = ["batch", "left", "group", "n"]

    def run(batches):
        system, path = filesystem(folder)
        for row in _rows(batches):
            ids, words = _loaded(folder, row)
            suffixes = _repeated(Suffixes(words), row, bits, parts)
            name = f"left-{uuid.uuid4().hex}"
            columns = [suffixes.doc.astype(np.int32), suffixes.start.astype(np.int32), *suffixes.edges]
            table = pa.table([pa.array(c) for c in columns], names=["doc", "start", *(f"e{k}" for k in range(EDGES))])
            table = table.append_column("id", pa.array(ids, pa.int64()).take(pa.array(suffixes.doc)))
            with system.open_output_stream(f"{path}/{name}") as f, pa.ipc.new_file(f, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table)
            kinds, times = np.unique(_groups(suffixes, prefix_bits, {}), return_counts=True)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["batch"]] * (len(kinds) + 1)), pa.array([name] + [None] * len(kinds), pa.string()),
                pa.array([None, *kinds.astype(np.int64).tolist()], pa.int64()), pa.array([None, *times.tolist()], pa.int64()),
            ], names)

    return run


def _left(folder: str, row: dict) -> tuple[Suffixes, pa.Array]:
    """The repeated suffixes of a batch, and the identifiers of their documents."""
    system, path = filesystem(folder)
    with system.open_input_file(f"{path}/{row['left']}") as f:
        table = pa.ipc.open_file(f).read_all().combine_chunks()
    suffixes = object.__new__(Suffixes)
    suffixes.doc, suffixes.start = (table.column(c).to_numpy().astype(np.int64) for c in ("doc", "start"))
    suffixes.edges = [table.column(f"e{k}").to_numpy() for k in range(EDGES)]
    return suffixes, table.column("id")


# Steps 3 and 4

def _groups(suffixes: Suffixes, bits: int, hot: dict[int, np.ndarray]) -> np.ndarray:
    """The group of each suffix: the part its first edge falls into, or, while that is one of the hot ones, the part of
    a prefix longer by an edge."""
    group = suffixes.prefix(1, bits) * np.uint64(EDGES)
    for level in range(1, EDGES):
        longer = np.isin(group, hot.get(level, np.empty(0, np.uint64)))
        if not longer.any():
            break
        group[longer] = suffixes.taken(longer).prefix(level + 1, bits) * np.uint64(EDGES) + np.uint64(level)
    return group


def _prefix_counts(folder: str, bits: int, hot: dict[int, np.ndarray], level: int):
    def run(batches):
        for row in _rows(batches):
            groups = _groups(_left(folder, row)[0], bits, hot)
            kinds, times = np.unique(groups[groups % np.uint64(EDGES) == level], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.astype(np.int64)), pa.array(times)], ["group", "n"])

    return run


def _entries(suffixes: Suffixes, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes sorted by group and path, then by document and start: the order, where each new path begins, and the
    number of the path of each."""
    order = np.lexsort((suffixes.start, suffixes.doc, *suffixes.edges[::-1], groups))
    columns = [groups[order], *(e[order] for e in suffixes.edges)]
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return order, new, np.cumsum(new) - 1


def _to_groups(folder: str, prefix_bits: int, hot: dict[int, np.ndarray]):
    def run(batches):
        for row in _rows(batches):
            suffixes, ids = _left(folder, row)
            groups = _groups(suffixes, prefix_bits, hot)
            order, new, _ = _entries(suffixes, groups)
            firsts = order[new]
            of = groups[firsts]
            kinds, starts = np.unique(of, return_index=True)
            least = pc.fill_null(ids, np.iinfo(np.int64).max).to_numpy()[firsts]
            rank = (least.view(np.uint64) ^ np.uint64(1 << 63)) if len(least) else np.empty(0, np.uint64)
            blobs = []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(of)]):
                blobs.append(
                    b"".join([*(planes(e[firsts[a:b]], EDGE_BITS // 8) for e in suffixes.edges), planes(rank[a:b], 8)])
                )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(kinds.astype(np.int64)), pa.array([row["batch"]] * len(kinds), pa.string()),
                    pa.array(blobs, pa.binary()),
                ],
                ["group", "batch", "blob"],
            )

    return run


def _subtree(table: pa.Table) -> pa.Table:
    """The subtree of a group, as its sorted paths: neighbours whose paths agree on all edges hang from one deep
    internal node. For each batch's entries, in their order, one bit each: whether the node has an earlier start."""
    width, size = EDGE_BITS // 8, EDGE_BITS // 8 * EDGES + 8
    batches = table.column("batch").to_pylist()
    by_name = np.argsort(np.argsort(np.array(batches, object)))
    columns: list[list[np.ndarray]] = [[] for _ in range(EDGES + 1)]
    counts = []
    for blob in table.column("blob").to_pylist():
        n = len(blob) // size
        counts.append(n)
        for k in range(EDGES):
            columns[k].append(unplanes(blob[k * n * width : (k + 1) * n * width], width))
        columns[EDGES].append(unplanes(blob[EDGES * n * width :], 8))
    *edges, rank = (np.concatenate(c) for c in columns)
    order = np.lexsort((np.repeat(by_name, counts), rank, *edges[::-1]))
    common = np.zeros(len(order), np.int64)  # edges that each path has in common with the one before it
    alike = np.ones(max(0, len(order) - 1), bool)
    for e in edges:
        alike &= e[order][1:] == e[order][:-1]
        common[1:] += alike
    later = np.zeros(len(order), bool)
    later[order] = common == EDGES
    ends = np.cumsum(counts)
    bits = [np.packbits(later[e - n : e]).tobytes() for e, n in zip(ends.tolist(), counts)]
    return pa.table({"batch": table.column("batch"), "group": table.column("group"), "bits": pa.array(bits, pa.binary())})


# Step 5

def _kept(folder: str, prefix_bits: int, hot: dict[int, np.ndarray]):
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for row in _rows(batches):
            (ids, words), (suffixes, _) = _loaded(folder, row), _left(folder, row)
            groups = _groups(suffixes, prefix_bits, hot)
            order, new, path = _entries(suffixes, groups)
            later, of = np.zeros(int(new.sum()), bool), groups[order[new]]
            for told in row["later"] or ():
                a, b = np.searchsorted(of, np.uint64(told["group"]), "left"), np.searchsorted(
                    of, np.uint64(told["group"]), "right"
                )
                later[a:b] = np.unpackbits(np.frombuffer(told["bits"], np.uint8), count=int(b - a)).astype(bool)
            repeat = order[~new | later[path]] if len(order) else order
            docs, starts = suffixes.doc[repeat], suffixes.start[repeat]
            sort = np.lexsort((starts, docs))
            docs, starts = docs[sort], starts[sort]
            firsts, lasts = np.searchsorted(docs, np.arange(len(ids)), "left"), np.searchsorted(
                docs, np.arange(len(ids)), "right"
            )
            out_ids, n_words, removed, kept, spans = [], [], [], [], []
            for k in range(len(ids)):
                at = starts[firsts[k] : lasts[k]]
                breaks = np.flatnonzero(np.diff(at) > DEPTH) + 1
                covered = [(int(p[0]), int(p[-1]) + DEPTH) for p in np.split(at, breaks)] if len(at) else []
                rest, end = [], 0
                for a, b in covered:
                    rest += words[k][end:a]
                    end = b
                rest += words[k][end:]
                out_ids.append(ids[k])
                n_words.append(len(words[k]))
                removed.append(len(words[k]) - len(rest))
                kept.append(b" ".join(rest).decode())
                spans.append([{"start": a, "end": b} for a, b in covered])
            for a in range(0, len(out_ids), 256):
                part = slice(a, a + 256)
                yield pa.RecordBatch.from_arrays([
                    pa.array(out_ids[part], pa.int64()), pa.array(n_words[part], pa.int64()),
                    pa.array(removed[part], pa.int64()), pa.array(kept[part], pa.string()),
                    pa.array(spans[part], spans_type),
                ], ["id", "n_words", "n_removed", "kept", "spans"])

    return run


def _copies(rows: DataFrame) -> DataFrame:
    """Documents whose word sequence an earlier document has. Equal ones are summed up in 64 runs, then over the runs,
    and the first of all is told back the same way, so that no task has more than a run's share of very many copies."""
    key = ["h1", "h2", "n_words"]
    rows = rows.filter(F.col("n_words") >= DEPTH).withColumn("run", F.pmod(F.xxhash64("batch", "place"), F.lit(64)))
    order = F.struct(F.col("id").isNull().alias("null"), "id", "batch", "place")
    leaves = rows.groupBy("run", *key).agg(F.min(order).alias("first"), F.count("*").alias("n"))
    top = leaves.groupBy(*key).agg(F.min("first").alias("first"), F.sum("n").alias("n")).filter("n > 1")
    told = leaves.select("run", *key).join(top, key)
    told = told.select("run", *key, F.col("first.batch").alias("b"), F.col("first.place").alias("p"))
    copies = rows.join(told.hint("merge"), ["run", *key]).filter("batch != b OR place != p")
    return copies.select("batch", "place", "id", "n_words")


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP, batch_bytes: int = BATCH_BYTES
) -> DataFrame:
    """Remove every word that lies in 20 consecutive words of a document which also start earlier: in a document with a
    smaller identifier, or earlier in the same one. Windows are judged on the input.

    Returns a row for each row of `docs`: `<id_col>, n_words, n_removed, kept` (the words that stay, joined by one
    space)`, spans` (what is removed, in words from 0, ends exclusive, touching spans as one). Null text has no words.
    Null identifiers come last; of rows that repeat an identifier, one (by its place in the store) counts as the
    earlier. Sequences are told apart by four 48-bit hashes of five words each; whole documents by 128 bits. Other
    columns are not read.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/texts"
    rows = store(docs, folder, id_col, text_col, batch_bytes)
    copies = stored(_copies(rows))
    gone = copies.groupBy("batch").agg(F.collect_list("place").alias("gone"))
    batches = stored(
        rows.groupBy("batch", "file", "no").agg(F.sum(F.greatest(F.col("n_words") - (DEPTH - 1), F.lit(0))).alias("n")).join(
            gone, "batch", "left"
        )
    )
    total = batches.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("batches")).first()
    bits = min(60, max(24, int(total.n).bit_length() + 12))
    parts = min(30, max(0, (int(total.n) // group).bit_length()) + 1)
    tasks = max(1, min(total.batches, max(int(spark.conf.get("spark.sql.shuffle.partitions")), total.batches // 64)))
    batches = batches.drop("n")

    # repartition() without a key deals batches out evenly, whatever their names
    hashes = batches.repartition(tasks).mapInArrow(
        _short_hashes(folder, bits, parts), "part long, batch string, blob binary"
    )
    several = hashes.groupBy("part").applyInArrow(_in_several, "batch string, part long, bits binary")
    several = several.groupBy("batch").agg(F.collect_list(F.struct("part", "bits")).alias("several"))
    # merge joins: what is told about a batch compresses so well that Spark would take it for small and broadcast it
    told = batches.join(several.hint("merge"), "batch", "left").repartition(tasks)
    prefix_bits, hot = parts + 1, {}
    left = stored(told.mapInArrow(_survivors(folder, bits, parts, prefix_bits), "batch string, left string, group long, n long"))
    batches = stored(batches.join(left.filter("left IS NOT NULL").select("batch", "left").hint("merge"), "batch"))

    counts = left.filter("group IS NOT NULL").select("group", "n")
    for level in range(EDGES - 1):
        large = [r.group for r in counts.groupBy("group").agg(F.sum("n").alias("n")).filter(F.col("n") > group).collect()]
        if not large:
            break
        hot[level + 1] = np.array(sorted(large), np.uint64)
        if level + 2 < EDGES:
            counts = batches.repartition(tasks).mapInArrow(_prefix_counts(folder, prefix_bits, hot, level + 1), "group long, n long")

    sent = batches.repartition(tasks).mapInArrow(_to_groups(folder, prefix_bits, hot), "group long, batch string, blob binary")
    later = sent.groupBy("group").applyInArrow(_subtree, "batch string, group long, bits binary")
    later = later.groupBy("batch").agg(F.collect_list(F.struct("group", "bits")).alias("later"))
    final = batches.join(later.hint("merge"), "batch", "left").repartition(tasks)
    schema = "id long, n_words long, n_removed long, kept string, spans array<struct<start:int,end:int>>"
    done = final.mapInArrow(_kept(folder, prefix_bits, hot), schema)
    span = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    whole_ = copies.select(
        "id", "n_words", F.col("n_words").alias("n_removed"), F.lit("").alias("kept"), span.alias("spans")
    )
    return done.unionByName(whole_).withColumnRenamed("id", id_col)


def repeat_report(docs: DataFrame) -> DataFrame:
    """What stays of each document, as counts and a digest: a row for each row of `docs`. Null and empty texts have no words and
    the digest of an empty text; of rows that repeat an identifier and a passage one keeps it."""
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
     places AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM docs),
     starts AS (SELECT doc_id, p, string_agg(word, ' ') OVER next AS words, count(*) OVER next AS n FROM places
                WINDOW next AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
     ranked AS (SELECT doc_id, p, row_number() OVER (PARTITION BY words ORDER BY doc_id, p) AS n FROM starts WHERE n = 20),
     gone AS (SELECT DISTINCT doc_id, p + i AS p FROM ranked, range(20) t(i) WHERE n > 1),
     kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS words FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(d.words) AS n_words, len(d.words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.words, '')) AS kept_sha256
FROM docs d LEFT JOIN kept USING (doc_id)"""

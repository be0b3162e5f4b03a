"""Language-model scores of texts by a weighted backoff automaton over smoothed n-grams of the corpus.

A state is a context, the n-gram of the last tokens read, of any length that training saw; an arc is an n-gram that goes
on from it, with the logarithm of its smoothed probability; a failure arc leads to the state that forgets the oldest
token, with the logarithm of what smoothing keeps for it. Probabilities are Dirichlet-smoothed towards the next shorter
context: (c(h w) + m P(w | h')) / (c(h) + m), down to add-one counts of single tokens; so they sum to one.

The automaton grows with the corpus, so no task holds it. Texts lie in batches of bounded size. Each batch sends the
distinct n-grams of all orders in it, with how often its training texts have them, to parts by hash; a part adds up what
all batches have and tells each batch its n-grams' totals. With these a batch builds the piece of the automaton that its
own texts can reach, and all its texts walk through it from left to right.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import filesystem, shared_folder, stored, whole

ORDER = 2
#: Weight of the shorter context, in tokens.
WEIGHT = 300.0
BATCH_BYTES = 8 << 20
#: n-grams of a part, about: what a task holds when it adds them up.
PART = 2 << 20
#: Stand for the end of a text and for what is before its first token.
END, START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_ODD = np.uint64(0x9FB21C651E98DF25)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


@dataclass
class Grams:
    """The n-grams of one order in a batch: `keys`, sorted and distinct, and for each place in the texts where one ends
    the place and the number of its key."""

    keys: np.ndarray
    at: np.ndarray
    of: np.ndarray


class Texts:
    """Texts as tokens, all in a row: for each a start mark, its words with A-Z lowered, and an end."""

    def __init__(self, texts: pa.Array):
        words = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        flat, parents = words.values, pc.list_parent_indices(words).to_numpy()
        some = pc.not_equal(flat, "")
        flat, parents = flat.filter(some).dictionary_encode(), parents[some.to_numpy(zero_copy_only=False)]
        kinds = np.fromiter(map(xxhash.xxh64_intdigest, flat.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(flat.dictionary))
        self.lengths = np.bincount(parents, minlength=len(texts)) + 2
        self.first = np.cumsum(self.lengths) - self.lengths
        self.text = np.repeat(np.arange(len(texts), dtype=np.int32), self.lengths)
        self.place = np.arange(len(self.text), dtype=np.int32) - self.first.astype(np.int32)[self.text]
        inner = np.ones(len(self.text), bool)
        inner[self.first], inner[self.first + self.lengths - 1] = False, False
        self.hashes = np.full(len(self.text), END)
        self.hashes[self.first] = START
        self.hashes[inner] = kinds[flat.indices.to_numpy()]

    def grams(self, order: int) -> Iterator[Grams]:
        """Order by order. An n-gram that ends at a text's place k has k tokens before it, the start mark included."""
        key = self.hashes
        for n in range(1, order + 1):
            if n > 1:
                longer = np.zeros_like(key)
                longer[1:] = _mixed(key[:-1] * _ODD + self.hashes[1:])
                key = longer
            at = np.flatnonzero(self.place >= max(1, n - 1)).astype(np.int32)
            keys, of = np.unique(key[at], return_inverse=True)
            yield Grams(keys, at, of.astype(np.int32))


class Automaton:
    """The piece of the automaton that the n-grams of some texts reach. totals: for each order how often training has
    each of the n-grams; tokens, kinds: of training; starts: training texts."""

    def __init__(self, totals: list[np.ndarray], tokens: int, kinds: int, starts: int, weight: float = WEIGHT):
        self.totals, self.room, self.starts, self.weight = totals, tokens + kinds + 1, starts, weight

    def walk(self, texts: Texts, grams: list[Grams]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each token, in the order of the texts: how often training has it, the logarithm of its add-one
        probability, and the weight the automaton adds on reading it.

        The state before a token is the longest context training has; from there failure arcs are followed until a state
        has an arc for the token. As states are the suffixes of what was read, all places go through the states of one
        length at a time: an arc that is there gives the weight, a place without one carries its failure weights on.
        """
        single = grams[0]
        counts = self.totals[0][single.of].astype(np.float64)
        chance = (counts + 1) / self.room
        base = np.log10(chance)
        score, seen = base.copy(), np.zeros(len(texts.text))
        seen[single.at] = counts
        seen[texts.first] = self.starts
        state = seen  # by place: how often the state that ends there was left in training
        number = np.full(len(texts.text), -1, np.int32)
        number[single.at] = np.arange(len(single.at), dtype=np.int32)
        for gram, total in zip(grams[1:], self.totals[1:]):
            token, left = number[gram.at], state[gram.at - 1]
            taken = total[gram.of].astype(np.float64)
            chance[token] = (taken + self.weight * chance[token]) / (left + self.weight)
            failed = np.log10(self.weight / (left + self.weight))
            score[token] = np.where(taken > 0, np.log10(chance[token]), score[token] + failed)
            state = np.zeros(len(texts.text))
            state[gram.at] = taken
        return counts, base, score


# Batches of texts

def _store(folder: str, batch_bytes: int):
    schema = pa.schema([("id", pa.int64()), ("train", pa.bool_()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        writer, file, no, held, size = None, uuid.uuid4().hex, 0, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal writer, no, held, size
            if writer is None:
                writer = pa.ipc.new_file(
                    system.open_output_stream(f"{path}/{file}"), schema, options=pa.ipc.IpcWriteOptions(compression="zstd")
                )
            table = pa.Table.from_batches(held, schema).combine_chunks()
            writer.write_batch(table.to_batches()[0])
            row = {"batch": f"{file}-{no}", "file": file, "no": no, "room": size, "starts": pc.sum(table.column("train")).as_py()}
            no, held, size = no + 1, [], 0
            return pa.RecordBatch.from_pylist([row])

        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column(2)).to_numpy() + 2)
            start = 0
            while start < batch.num_rows:
                before = int(ends[start - 1]) if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + batch_bytes - size, "right")))
                held.append(pa.RecordBatch.from_arrays(batch.slice(start, stop - start).columns, schema=schema))
                size += int(ends[stop - 1]) - before
                start = stop
                if size >= batch_bytes or start < batch.num_rows:
                    yield flush()
        if held:
            yield flush()
        if writer is not None:
            writer.close()

    return run


def _loaded(folder: str, file: str, no: int) -> tuple[pa.RecordBatch, Texts]:
    system, path = filesystem(folder)
    with system.open_input_file(f"{path}/{file}") as f:
        batch = pa.ipc.open_file(f).get_batch(no)
    return batch, Texts(batch.column(2))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


# Counting

def _planes(values: np.ndarray) -> bytes:
    """Numbers in as many bytes as the largest needs, which the first byte says; all first bytes first, as alike bytes
    that lie together compress."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    return bytes([width]) + np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _numbers(blob: bytes) -> np.ndarray:
    width = blob[0]
    out = np.zeros(((len(blob) - 1) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(blob, np.uint8, offset=1).reshape(width, -1).T
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _steps(keys: np.ndarray) -> bytes:
    """Ascending keys: the first, then the steps from one to the next."""
    return keys[:1].astype("<u8").tobytes() + _planes(np.diff(keys))


def _keys(blob: bytes) -> np.ndarray:
    first = np.frombuffer(blob[:8], "<u8").astype(np.uint64)
    return np.concatenate([first, first + np.cumsum(_numbers(blob[8:]), dtype=np.uint64)])


def _asked(folder: str, order: int, bits: int):
    """For each batch, order and part: the keys, and how often training texts of the batch have them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            batch, texts = _loaded(folder, row["file"], row["no"])
            train = batch.column(1).to_numpy(zero_copy_only=False)[texts.text]
            for n, gram in enumerate(texts.grams(order), 1):
                counts = np.bincount(gram.of[train[gram.at]], minlength=len(gram.keys))
                parts, first = np.unique(gram.keys >> np.uint64(64 - bits), return_index=True)
                ends = [*first[1:].tolist(), len(gram.keys)]
                yield pa.RecordBatch.from_pydict({
                    "n": pa.array([n] * len(parts), pa.int32()), "part": parts.astype(np.int64),
                    "batch": pa.array([row["batch"]] * len(parts), pa.string()),
                    "keys": pa.array([_steps(gram.keys[a:b]) for a, b in zip(first.tolist(), ends)], pa.binary()),
                    "counts": pa.array([_planes(counts[a:b]) for a, b in zip(first.tolist(), ends)], pa.binary()),
                })

    return run


def _totals(table: pa.Table) -> pa.Table:
    """For each batch's keys in a part their totals over all batches; in one row of the part how many there are in training."""
    lists = [_keys(b) for b in table.column("keys").to_pylist()]
    keys, of = np.unique(np.concatenate(lists), return_inverse=True)
    counts = np.concatenate([_numbers(b) for b in table.column("counts").to_pylist()]).astype(np.int64)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, of, counts)
    ends = np.cumsum([len(x) for x in lists]).tolist()
    blobs = [_planes(sums[of[a:b]]) for a, b in zip([0, *ends], ends)]
    others = [0] * (len(lists) - 1)
    return pa.table({
        "n": table.column("n"), "part": table.column("part"), "batch": table.column("batch"), "totals": pa.array(blobs, pa.binary()),
        "tokens": pa.array([int(sums.sum()), *others]), "kinds": pa.array([int((sums > 0).sum()), *others]),
    })


# Scoring

def _scored(folder: str, order: int, facts: tuple[int, int, int], weight: float):
    names = ["id", "train", "n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            batch, texts = _loaded(folder, row["file"], row["no"])
            told: list[list] = [[] for _ in range(order)]
            for x in sorted(row["told"] or (), key=lambda x: x["part"]):
                told[x["n"] - 1].append(_numbers(x["totals"]))
            totals = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in told]
            counts, base, score = Automaton(totals, *facts, weight).walk(texts, grams := list(texts.grams(order)))
            of, n = texts.text[grams[0].at], len(texts.lengths)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(texts.lengths - 1), pa.array(np.bincount(of, counts > 0, n).astype(np.int64)),
                pa.array(np.bincount(of, base, n)), pa.array(np.bincount(of, score, n)),
            ], names)

    return run


def scored(
    docs: DataFrame, train: Column, order: int = ORDER, weight: float = WEIGHT, id_col: str = "doc_id", text_col: str = "text",
    batch_bytes: int = BATCH_BYTES, part: int = PART,
) -> DataFrame:
    """Learn n-grams up to `order` from the rows where `train` holds (null: not), and score every row:
    `<id_col>, train, n_tokens, n_known, train_tokens, base_score, score`.

    Tokens are the words of the whole text, A-Z lowered, and one end, which counts as a token. n_known: tokens that
    training has; base_score: the sum of log10((c + 1) / (N + V + 1)) with c a token's count, N all and V distinct tokens of
    training; score: the log10 probability of the text by the automaton. Null and empty texts are their end. Rows that
    repeat each count and each get a row; null identifiers stay. Without training rows all tokens are unknown. Counts are
    exact, up to equal 64-bit hashes of different n-grams.
    """
    if order < 1 or weight <= 0:
        raise ValueError("order must be one or more, weight more than zero")
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/texts"
    system, path = filesystem(folder)
    system.create_dir(path, recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(train, F.lit(False)).alias("train"), whole(text_col).alias("text"))
    batches = stored(rows.mapInArrow(_store(folder, batch_bytes), "batch string, file string, no long, room long, starts long"))
    size = batches.agg(F.coalesce(F.sum("room"), F.lit(0)).alias("room"), F.coalesce(F.sum("starts"), F.lit(0)).alias("starts"), F.count("*").alias("n")).first()
    bits = max(1, (size.room // 6 // part).bit_length())  # a token and the space behind it take six bytes or more, mostly
    tasks = max(1, min(size.n, max(int(spark.conf.get("spark.sql.shuffle.partitions")), size.n // 16)))

    # repartition() without a key deals batches out evenly, whatever their names
    asked = batches.repartition(tasks).mapInArrow(
        _asked(folder, order, bits), "n int, part long, batch string, keys binary, counts binary"
    )
    told = stored(asked.groupBy("n", "part").applyInArrow(
        _totals, "n int, part long, batch string, totals binary, tokens long, kinds long"
    ))
    facts = told.filter("n = 1").agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("kinds"), F.lit(0)).alias("kinds")).first()
    by_batch = told.groupBy("batch").agg(F.collect_list(F.struct("n", "part", "totals")).alias("told"))
    # a merge join: totals compress so well that Spark would take them for small and broadcast them
    final = batches.join(by_batch.hint("merge"), "batch", "left").repartition(tasks)
    found = final.mapInArrow(
        _scored(folder, order, (facts.tokens, facts.kinds, size.starts), weight),
        "id long, train boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return found.select(
        F.col("id").alias(id_col), "train", "n_tokens", "n_known", F.lit(facts.tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


def held_out(id_col: str = "doc_id") -> Column:
    """A seventh of the rows, by the CRC-32 of the identifier's text (null: of an empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def score_report(docs: DataFrame) -> DataFrame:
    return scored(docs, ~held_out()).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )

"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import operator
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import binary, pieces

#: Most labelled rows to learn from, those with the smallest hash of their identifier: a documented bound. All
#: statistics
#: but the model are over all rows.
MOST_TRAINED = 8000
WORDS, BINS, RANK = 1 << 14, 24, 8
_UPPER, _DIGITS, _SYMBOLS = (s.encode() for s in (string.ascii_uppercase, string.digits, string.punctuation))

#: Structure statistics and metadata: name, and the scale that spreads the value over its bins.
STATISTICS = (
    "upper", "digits", "symbols", "bangs", "bars", "stops", "word_length", "distinct", "repeated", "line_copies", "line_length",
    "log_words", "short_words", "stated_length",
)
#: All features share one numbering: hashed words, then a row of bins for each statistic.
FEATURES = WORDS + BINS * len(STATISTICS)


def statistics(text: bytes, words: list[bytes], counts: Counter, stated: int | None) -> list[float]:
    """Values, mostly from 0 to 1, of the structure of a text; lines and words as bytes."""
    n, size = max(1, len(words)), max(1, len(text))
    lines = [line for line in text.split(b"\n") if line.strip()]
    letters = max(1, size - text.count(b" "))
    return [
        *((len(text) - len(text.translate(None, kind))) / letters for kind in (_UPPER, _DIGITS, _SYMBOLS)),
        text.count(b"!") / n, text.count(b"|") / n, (text.count(b".") + text.count(b",")) / n, min(1.0, letters / n / 16),
        len(counts) / n, sum(map(operator.eq, words, words[1:])) / n, 1 - len(set(lines)) / max(1, len(lines)),
        min(1.0, np.log1p(size / max(1, len(lines))) / 12), min(1.0, np.log1p(len(words)) / 12), sum(
            c for w, c in counts.items() if len(w) < 3
        ) / n,
        0.0 if stated is None else min(1.0, np.log1p(max(0, stated)) / 16),
    ]


class _Numbers(dict):
    """Numbers of words seen so far; starts anew when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        found = self[word] = zlib.crc32(word) & (WORDS - 1)
        return found


_NUMBERS = _Numbers()


def features(text: bytes, stated: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and values of a text's features. Words get log counts of unit length together; a statistic gets two
    neighbouring bins of its row, shared out by where its square root falls, so scores change smoothly."""
    words = text.split()
    counts = Counter(words)
    numbers = np.fromiter(map(_NUMBERS.__getitem__, counts), np.int32, len(counts))
    values = np.log1p(np.fromiter(counts.values(), np.float32, len(counts)))
    values /= max(1e-6, float(np.sqrt((values * values).sum())))
    at = np.sqrt(np.clip(statistics(text, words, counts, stated), 0, 1)) * (BINS - 1)
    low = np.minimum(at.astype(np.int32), BINS - 2)
    rows = WORDS + BINS * np.arange(len(STATISTICS), dtype=np.int32)
    share = (at - low).astype(np.float32)
    return np.concatenate((numbers, rows + low, rows + low + 1)), np.concatenate((values, 1 - share, share))


@dataclass
class Machine:
    """score = sigmoid(bias + sum w x + half of sum over factors of ((sum v x)^2 - sum (v x)^2))."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, numbers: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of rows whose features start at `starts` (none empty), in time linear in the features: the
        sum-of-squares identity replaces the sum over pairs. Also the sums and products that the gradient needs."""
        products = self.factors[numbers] * values[:, None]
        sums = np.add.reduceat(products, starts)
        squares = np.add.reduceat(products * products, starts)
        linear = np.add.reduceat(self.linear[numbers] * values, starts)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums, products

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        numbers, values, starts = _packed(rows)
        return 1 / (1 + np.exp(-np.clip(self.raw(numbers, values, starts)[0].astype(np.float64), -30, 30)))


def _packed(rows):
    starts = np.cumsum([0] + [len(n) for n, _ in rows[:-1]])
    return np.concatenate([n for n, _ in rows]), np.concatenate([v for _, v in rows]), starts


def fitted(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.05,
    decay: float = 1e-4, seed: int = 7,
) -> Machine:
    """Logistic loss, steps scaled by the root of summed squares of each weight's gradient; the same rows give the same
    machine. No row, or labels of one kind alone: the machine says their (smoothed) share for every text."""
    rng = np.random.default_rng(seed)
    share = (labels.sum() + 1) / (len(labels) + 2)
    machine = Machine(
        float(np.log(share / (1 - share))), np.zeros(FEATURES, np.float32),
        rng.normal(0, 0.02, (FEATURES, RANK)).astype(np.float32),
    )
    if len(set(labels.tolist())) < 2:
        machine.factors[:] = 0
        return machine
    sum_w, sum_v, sum_b = np.full(FEATURES, 1e-6, np.float32), np.full((FEATURES, RANK), 1e-6, np.float32), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            numbers, values, starts = _packed([rows[i] for i in chosen])
            raw, sums, products = machine.raw(numbers, values, starts)
            slope = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen]).astype(np.float32) / len(chosen)
            of = np.repeat(np.arange(len(chosen)), np.diff(np.append(starts, len(numbers))))
            by_w = slope[of] * values
            by_v = by_w[:, None] * (sums[of] - products)
            kinds, where = np.unique(numbers, return_inverse=True)
            step_w, step_v = np.zeros(len(kinds), np.float32), np.zeros((len(kinds), RANK), np.float32)
            np.add.at(step_w, where, by_w)
            np.add.at(step_v, where, by_v)
            step_w += decay * machine.linear[kinds]
            step_v += decay * machine.factors[kinds]
            sum_w[kinds] += step_w * step_w
            sum_v[kinds] += step_v * step_v
            sum_b += float(slope.sum()) ** 2
            machine.linear[kinds] -= rate * step_w / np.sqrt(sum_w[kinds])
            machine.factors[kinds] -= rate * step_v / np.sqrt(sum_v[kinds])
            machine.bias -= rate * float(slope.sum()) / sum_b**0.5
    return machine


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learnt from: crc32 of the identifier as text leaves 2 when divided by 4. A null identifier
    has no label and is not one of them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_TRAINED
) -> Machine:
    """Learn `labels.quality` from labelled rows that are not held out. Identifiers with contrary labels, and labels
    other than 0 and 1, are not used; of rows that repeat an identifier the smallest text is. Label, language, source
    and identifier are no features."""
    chosen = (
        labels.filter(F.col("quality").isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high")).filter("low = high")
        .select("id", F.col("low").cast("int").alias("quality")).orderBy(F.xxhash64("id"), "id").limit(most)
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _stated(docs))
    rows = rows.join(F.broadcast(chosen), "id")  # `chosen` has at most `most` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                made = [features(t, s) for t, s in zip(binary(part.column(1)), part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(3), pa.array([n.astype("<i4").tobytes() for n, _ in made], pa.binary()),
                    pa.array([v.astype("<f4").tobytes() for _, v in made], pa.binary())], ["id", "quality", "numbers", "values"])

    rows = rows.groupBy("id", "quality").agg(F.min(F.struct("text", "stated")).alias("first"))  # at most `most` rows
    rows = rows.select(F.col("id").cast("long"), "first.text", "first.stated", "quality")
    found = rows.mapInArrow(run, "id long, quality int, numbers binary, values binary").collect()
    found.sort(key=lambda r: (zlib.crc32(str(r["id"]).encode()), r["id"]))
    made = [(np.frombuffer(r["numbers"], "<i4"), np.frombuffer(r["values"], "<f4")) for r in found]
    return fitted(made, np.array([r["quality"] for r in found], np.float32))


def _stated(docs: DataFrame) -> Column:
    return (F.col("n_chars") if "n_chars" in docs.columns else F.lit(None)).cast("long").alias("stated")


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id, score` for each row, from its whole text (null: empty) and its stated length. Nothing is shuffled; the model
    that each task gets has a fixed size, about 0.6 MB."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 256):
                made = [features(t, s) for t, s in zip(binary(part.column(1)), part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(model.value.scores(made) if made else [], pa.float64())], ["id", "score"]
                )

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _stated(docs))
    return source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, score double")


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """A row for each row of `docs`: `doc_id, held_out, score, predicted`. Null and empty texts have the score of a text without
    words; a null identifier is never held out; rows that repeat are scored alike. Without labelled rows all scores are the
    same. Other columns but `n_chars` are not read."""
    scored = score(docs, train(docs, labels))
    return scored.select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7
) -> DataFrame:
    """The rows of `docs` that the classifier accepts, with their columns, whatever these are called; scored where they are
    read. Null and empty texts are scored as texts without words, and rows that repeat stay or go together."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col))
    names = [f.name for f in docs.schema.fields]
    at, stated = names.index(text_col), names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 256):
                lengths = part.column(stated).to_pylist() if stated is not None else [None] * part.num_rows
                scores = model.value.scores([features(t, s) for t, s in zip(binary(part.column(at)), lengths)])
                yield part.filter(pa.array(scores >= threshold))

    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))  # Python functions do not take names with points
    return plain.mapInArrow(run, plain.schema).toDF(*names)

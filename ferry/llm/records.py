"""Token ids as length-delimited binary records with masked checksums and an offset index."""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ferry.llm.common import binary, filesystem, shared_folder, stored, whole

CACHE = 200_000
#: Bytes of text that are encoded at once.
SLICE = 16 << 20
STOPS = b".,;:!?"
#: The settings of tokenizers for which words can be encoded one by one.
SETTINGS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
    "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False, "ignore_merges": False},
}
#: The polynomial of CRC-32C (reflected) and the mask that TFRecord files put over it.
POLYNOMIAL = 0x82F63B78
MASK = 0xA282EAD8
CHUNK = 256


def _tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """CRC of one byte, and what CHUNK zero bytes make of each byte of a CRC."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    moved = []
    for shift in (0, 8, 16, 24):
        crc = np.arange(256, dtype=np.uint32) << np.uint32(shift)
        for _ in range(CHUNK):
            crc = table[crc & 0xFF] ^ (crc >> 8)
        moved.append(crc)
    return table, moved


TABLE, MOVED = _tables()


def crc32c(blobs: list[bytes]) -> np.ndarray:
    """CRC-32C of each blob (4 bytes or longer), all at once.

    Leading zeros do not change a CRC that starts from zero, so blobs are filled up in front to whole chunks; starting
    from all ones is the same as flipping the first four bytes. All chunks are worked on byte by byte side by side, then
    each blob's chunks are joined in turn."""
    counts = np.array([-(-len(b) // CHUNK) for b in blobs], np.int64)
    data = np.zeros(int(counts.sum()) * CHUNK, np.uint8)
    ends = np.cumsum(counts) * CHUNK
    for blob, end in zip(blobs, ends.tolist()):
        start = end - len(blob)
        data[start:end] = np.frombuffer(blob, np.uint8)
        data[start : start + 4] ^= 0xFF
    columns = np.ascontiguousarray(data.reshape(-1, CHUNK).T)
    crc = np.zeros(columns.shape[1], np.uint32)
    for column in columns:
        crc = TABLE[(crc ^ column) & 0xFF] ^ (crc >> 8)
    first = np.cumsum(counts) - counts
    found = np.zeros(len(blobs), np.uint32)
    order = np.argsort(-counts, kind="stable")
    for k in range(int(counts.max(initial=0))):
        live = order[: int(np.searchsorted(-counts[order], -k, side="left"))]
        c = found[live]
        found[live] = MOVED[0][c & 0xFF] ^ MOVED[1][c >> 8 & 0xFF] ^ MOVED[2][c >> 16 & 0xFF] ^ MOVED[3][c >> 24] ^ crc[first[live] + k]
    return found ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> 15) | (crc << 17)) + np.uint32(MASK)


def frame(payloads: list[bytes]) -> list[bytes]:
    """Each payload as a record: length (8 bytes), its masked CRC, the payload, its masked CRC; all little-endian."""
    lengths = [len(p).to_bytes(8, "little") for p in payloads]
    heads, tails = masked(crc32c(lengths)), masked(crc32c(payloads))
    return [
        n + h.tobytes() + p + t.tobytes() for n, h, p, t in zip(lengths, heads.astype("<u4"), payloads, tails.astype("<u4"))
    ]


def unframe(records: list[bytes]) -> list[bytes]:
    """The payloads of records; an error if a length or a checksum does not agree."""
    payloads = [r[12:-4] for r in records]
    heads = np.array([int.from_bytes(r[8:12], "little") for r in records], np.uint32)
    tails = np.array([int.from_bytes(r[-4:], "little") for r in records], np.uint32)
    whole_ = all(len(r) >= 16 and int.from_bytes(r[:8], "little") == len(p) for r, p in zip(records, payloads))
    if not whole_ or (masked(crc32c([r[:8] for r in records])) != heads).any() or (masked(crc32c(payloads)) != tails).any():
        raise ValueError("a record is damaged")
    return payloads


def serialise(doc_id: int | None, ids: np.ndarray) -> bytes:
    """One byte with the width of an id (2 or 4) and, as bit 7, whether there is a doc_id; the doc_id; the ids."""
    width = 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    head = bytes([width | (0x80 if doc_id is not None else 0)]) + (doc_id or 0).to_bytes(8, "little", signed=True)
    return head + ids.astype(f"<u{width}").tobytes()


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id = int.from_bytes(payload[1:9], "little", signed=True) if payload[0] & 0x80 else None
    return doc_id, np.frombuffer(payload, f"<u{payload[0] & 0x7F}", offset=9).astype("<u4")


class Words:
    """Ids of whole texts from a tokenizer file.

    A tokenizer with the SETTINGS never joins characters across ASCII white space and gives no ids for it, ignores case,
    and parts letters from the stops after them: then each distinct word of some texts is looked up once, and encoded if it
    was not met lately. Words of ASCII letters, with or without stops at the end, go straight to the library's model; the
    others go through all of its steps, many at a time, joined by blanks, and the place where a token starts says whose it
    is. The tests compare both with whole texts. For any other tokenizer the library encodes the whole texts.

    What was met is kept in two generations: when the young one is full it becomes the old one, and words that are met
    again come back from there, so frequent words stay and rare ones go.
    """

    def __init__(self, path: str, most: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.tokenizer, self.young, self.old, self.most = Tokenizer.from_file(path), {}, {}, most
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        model = {k: settings["model"].get(k) for k in SETTINGS["model"]}
        found = {"normalizer": settings["normalizer"], "pre_tokenizer": settings["pre_tokenizer"], "model": model}
        self.own = [t["content"].lower() for t in settings["added_tokens"]]
        blanks = any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"] for t in settings["added_tokens"])
        self.by_words = found == SETTINGS and not blanks

    @staticmethod
    @cache
    def of(path: str) -> Words:
        """One for all tasks of a Python worker."""
        return Words(path)

    def _known(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of words that were met lately; those of the old generation come into the young one."""
        found = [*map(self.young.get, words)]
        for k in [k for k, ids in enumerate(found) if ids is None]:
            ids = self.old.get(words[k])
            if ids is not None:
                found[k] = self.young[words[k]] = ids
        return found

    def look_up(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words, four bytes each."""
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        found, young = self._known(words), self.young
        new = [k for k, ids in enumerate(found) if ids is None]
        cores = [words[k].lower().rstrip(STOPS) for k in new]
        plain = [core.isalpha() for core in cores]  # of bytes: ASCII letters alone
        stops = {words[k][len(core) :] for k, core, letters in zip(new, cores, plain) if letters} - {b""}
        others = [words[k] for k, letters in zip(new, plain) if not letters]
        unmet = [s for s, ids in zip(stops, self._known([*stops])) if ids is None]
        young.update(zip(unmet, self._others(unmet)))
        made = dict(zip(others, self._others(others)))
        tokenize = self.model.tokenize
        for k, core, letters in zip(new, cores, plain):
            word = words[k]
            if letters:
                ids = young.get(core) or self.old.get(core)
                if ids is None:
                    ids = young[core] = np.array([t.id for t in tokenize(core.decode())], "<u4").tobytes()
                if word != core:
                    ids = ids + young[word[len(core) :]] if len(word) > len(core) else ids
                found[k] = ids
            else:
                found[k] = made[word]
            young[word] = found[k]
        return found

    def _others(self, words: list[bytes], joined: int = 64) -> list[bytes]:
        out = []
        groups = [words[at : at + joined] for at in range(0, len(words), joined)]
        for at in range(0, len(groups), 64):
            part = [[w.decode() for w in group] for group in groups[at : at + 64]]
            for texts, encoding in zip(part, self.tokenizer.encode_batch([" ".join(group) for group in part], add_special_tokens=False)):
                ids = np.array(encoding.ids, "<u4").tobytes()
                starts = [a for a, _ in encoding.offsets]
                end = k = 0
                for text in texts:
                    end += len(text) + 1
                    last = bisect_left(starts, end, k)
                    out.append(ids[4 * k : 4 * last])
                    k = last
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts in a row, and how many each text has. Null is empty."""
        texts = pc.fill_null(texts, "")
        if not self.by_words:
            found = [e.ids for e in self.tokenizer.encode_batch(texts.to_pylist(), add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], "<u4"), np.array([len(ids) for ids in found], np.int64)
        lower = pc.ascii_lower(texts)  # so that fewer words differ; but not into strings that have ids of their own
        words = pc.ascii_split_whitespace(texts if any(pc.any(pc.match_substring(lower, t)).as_py() for t in self.own) else lower)
        flat, parents = words.values, pc.list_parent_indices(words).to_numpy()
        some = pc.not_equal(flat, "")
        flat, parents = flat.filter(some).dictionary_encode(), parents[some.to_numpy(zero_copy_only=False)]
        kinds = self.look_up(binary(flat.dictionary))
        each = np.array([len(ids) // 4 for ids in kinds], np.int64)
        codes = flat.indices.to_numpy()
        lengths = each[codes]
        # where a word's ids begin among those of the distinct words, less where they begin in the texts
        away = (np.cumsum(each) - each)[codes] - (np.cumsum(lengths) - lengths)
        ids = np.frombuffer(b"".join(kinds), "<u4")[np.repeat(away, lengths) + np.arange(int(lengths.sum()))]
        return ids, np.bincount(parents, lengths, len(texts)).astype(np.int64)


def _slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about so many bytes of a column: of one row, if that is larger."""
    ends, start = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy() + 8), 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _cuts(rows: DataFrame, parts: int) -> np.ndarray:
    """Identifiers that part the rows into about equal numbers, ascending; one that many rows have may be several of them."""
    shares = [k / parts for k in range(1, parts)]
    found = rows.agg(F.percentile_approx("id", shares, 100 * max(100, parts)).alias("cuts")).first().cuts if shares else None
    return np.array(sorted(found or []), np.int64)


def _part(cuts: np.ndarray):
    """The file of a row, by its identifier; rows of one that is a cut lie on both sides of it, by `tie`, in its order."""
    @F.pandas_udf("int")
    def part(ids: pd.Series, ties: pd.Series) -> pd.Series:
        null, values = ids.isna().to_numpy(), ids.fillna(0).to_numpy(np.int64)
        low, high = np.searchsorted(cuts, values, "left"), np.searchsorted(cuts, values, "right")
        share = (ties.to_numpy(np.int64) >> 33) + (1 << 30)  # 0 to 2**31 - 1, in the order of the ties
        return pd.Series(np.where(null, 0, low + ((share * (high - low + 1)) >> 31))).astype("int32")

    return part


def write_records(
    docs: DataFrame, tokenizer: str, folder: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every whole text, append `end_id`, and write the records in ascending order of `id_col` to files in
    `folder`.

    Rows are dealt to files by ranges of the identifier (then of a hash of the text, so that one identifier with very
    many rows does not make one file). Beside each file lies an index: the offset of every record and the end, 8 bytes
    each. A task writes under a name of its own attempt and hands on one row, so the manifest that is returned, a
    written table `part, file, n_records, n_ids`, names the files of successful attempts alone, in order. Null text is
    empty: its record holds the end id alone. Null identifiers come first. Rows that repeat an identifier each get a
    record.
    """
    system, path = filesystem(folder)
    system.create_dir(path, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        words, part = Words.of(tokenizer), TaskContext.get().partitionId()
        name, offsets, n_ids = f"part-{part:06d}-{uuid.uuid4().hex}", [0], 0
        with system.open_output_stream(f"{path}/{name}.rec", buffer_size=1 << 20) as out:
            for batch in batches:
                for rows in _slices(batch, 1, SLICE):
                    ids, lengths = words.encode(rows.column(1))
                    ends = np.cumsum(lengths)
                    ids = np.insert(ids, ends, np.uint32(end_id))
                    n_ids += len(ids)
                    each = np.split(ids, ends[:-1] + np.arange(1, len(ends)))
                    for record in frame([serialise(i, x) for i, x in zip(rows.column(0).to_pylist(), each)]):
                        offsets.append(offsets[-1] + len(record))
                        out.write(record)
        with system.open_output_stream(f"{path}/{name}.idx") as out:
            out.write(np.array(offsets, "<u8").tobytes())
        if len(offsets) > 1:
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "file": [name], "n_records": [len(offsets) - 1], "n_ids": [n_ids]}
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole(text_col).alias("text")).withColumn(
        "tie", F.xxhash64("text")
    )
    # by cuts of the identifiers alone: a range partitioning would read all texts a second time for its sample
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionById(parts, _part(_cuts(rows.select("id"), parts))("id", "tie"))
    rows = rows.sortWithinPartitions("id", "tie").select("id", "text")
    return stored(rows.mapInArrow(run, "part long, file string, n_records long, n_ids long"))


def read_index(system: pafs.FileSystem, path: str, file: str) -> np.ndarray:
    with system.open_input_stream(f"{path}/{file}.idx") as f:
        return np.frombuffer(f.read(), "<u8").astype(np.int64)


def read_some(folder: str, file: str, numbers: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """The records of these numbers, in this order, found by the index: for shuffled reads."""
    system, path = filesystem(folder)
    offsets = read_index(system, path, file)
    with system.open_input_file(f"{path}/{file}.rec") as f:
        return [parse(p) for p in unframe([f.read_at(int(offsets[n + 1] - offsets[n]), int(offsets[n])) for n in numbers])]


def read_records(spark: SparkSession, manifest: DataFrame, folder: str, at_once: int = 512) -> DataFrame:
    """Read the files back, a task per file: `doc_id, start, n_tokens, ids_crc32` for each record.

    start: ids of all records before it, in the order of the manifest. The running sum over files has a row per file.
    Lengths and checksums are verified; damage is an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = filesystem(folder)
        for batch in batches:
            for file, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                offsets = read_index(system, path, file)
                with system.open_input_file(f"{path}/{file}.rec") as f:
                    for at in range(0, len(offsets) - 1, at_once):
                        part = offsets[at : at + at_once + 1]
                        block, places = f.read_at(int(part[-1] - part[0]), int(part[0])), (part - part[0]).tolist()
                        found = [parse(p) for p in unframe([block[a:b] for a, b in zip(places, places[1:])])]
                        lengths = np.array([len(x) for _, x in found], np.int64)
                        yield pa.RecordBatch.from_arrays([
                            pa.array([i for i, _ in found], pa.int64()), pa.array(start + np.cumsum(lengths) - lengths), pa.array(lengths),
                            pa.array([zlib.crc32(x.tobytes()) for _, x in found], pa.int64()),
                        ], ["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += int(lengths.sum())

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))
    return files.repartition(max(1, manifest.count())).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def token_records(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Write the documents' ids to the shared folder and read them back: a row for each row of `docs`, `doc_id, start,
    n_tokens, ids_crc32`. Null and empty texts are the end id alone; null identifiers come first, and rows that repeat one
    follow each other, ordered by a hash of their texts, each with a row. Other columns are not read."""
    folder = shared_folder(docs.sparkSession)
    manifest = write_records(docs, tokenizer, f"{folder}/records", end_id)
    return read_records(docs.sparkSession, manifest, f"{folder}/records")

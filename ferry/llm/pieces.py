"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm import common
from ferry.llm.common import binary

SPACE = "▁"
CACHE = 200_000
LONGEST_KEPT = 64
#: Fixed value: how far below the lowest score an unknown character is.
UNKNOWN_PENALTY = 10.0
#: Texts that rules other than the identity change.
PROBES = ("a", "ﬁ Ａ", "e\u0301", "Two  Blanks", "tab\tend")


class Pieces:
    """A vocabulary of pieces with scores. Blanks become `\\u2581`, one is put in front, and nothing else is normalised,
    as this library's models with the identity rule have it.

    encode: the pieces whose scores add up highest; of equal sums the one found first, that is with the longest last
    piece. A character that begins no piece of its own costs more than any piece and is written as its UTF-8 bytes if
    the vocabulary has byte pieces, else as the unknown piece.
    """

    def __init__(self, pieces: list[tuple[str, float]], byte_ids: dict[int, int], unknown: int, most: int = CACHE, silent: frozenset[int] = frozenset()):
        """pieces: text and score by id; those that no text is to give (control, byte, unknown) with an empty text.
        silent: ids that decode to nothing."""
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for i, (text, score) in enumerate(pieces):
            if text:
                self.automaton.add_word(text, (len(text), score, i))
        self.automaton.make_automaton()
        self.texts = [text for text, _ in pieces]
        self.single = {text for text, _ in pieces if len(text) == 1}
        self.lowest = min((s for t, s in pieces if t), default=0.0) - UNKNOWN_PENALTY
        self.byte_ids, self.bytes_of, self.unknown = byte_ids, {i: b for b, i in byte_ids.items()}, unknown
        # No piece goes over from other characters to a blank, nor over a line end: a text can be cut there, and the
        # best
        # path of the whole is made of the best paths of the parts.
        cuts = not any(re.search(f"[^{SPACE}]{SPACE}", t) for t in self.texts)
        lines = not any("\n" in t for t in self.texts if len(t) > 1)
        if cuts:
            rest = f"{SPACE}\n" if lines else SPACE
            self.cut = re.compile((r"\n|" if lines else "") + f"{SPACE}*[^{rest}]+|{SPACE}+").findall
        else:
            self.cut = lambda text: [text] if text else []
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.most, self.silent = most, silent

    @classmethod
    def load(cls, path: str) -> Pieces:
        """From the file of a SentencePiece model, read by its library. An error for a model that changes texts other than by
        marking their blanks. Of a BPE model the scores are ranks: the ids are those of the best sum of them, not those of
        the library's merges."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        for text in PROBES:
            if model.normalize(text) != SPACE + text.replace(" ", SPACE):
                raise ValueError(f"the model's normaliser changes {text!r}: only the identity rule is known here")
        pieces, byte_ids = [], {}
        for i in range(model.get_piece_size()):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(text[1:-1], 16)] = i
            hidden = model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
            pieces.append(("" if hidden else text, model.get_score(i)))
        silent = frozenset(i for i in range(model.get_piece_size()) if model.is_control(i) or model.is_unused(i))
        return cls(pieces, byte_ids, model.unk_id(), silent=silent)

    def best(self, text: str) -> list[int]:
        """One pass over the text: at each position the automaton's state and its output links give every piece that
        ends there, longest first, and each relaxes the best score of that position."""
        n = len(text)
        score, start, piece = [0.0] + [float("-inf")] * n, [0] * (n + 1), [-1] * (n + 1)
        done = 0  # positions up to here are final

        def unknown_to(end: int) -> None:
            nonlocal done
            while done < end:
                if text[done] not in self.single and score[done] + self.lowest > score[done + 1]:
                    score[done + 1], start[done + 1], piece[done + 1] = score[done] + self.lowest, done, -1
                done += 1

        for last, (length, s, i) in self.automaton.iter(text):
            end = last + 1
            if end - 1 > done:
                unknown_to(end - 1)
            reached = score[end - length] + s
            if reached > score[end]:
                score[end], start[end], piece[end] = reached, end - length, i
        unknown_to(n)
        found, at = [], n
        while at:
            if piece[at] >= 0:
                found.append(piece[at])
            elif self.byte_ids:
                found += [self.byte_ids[b] for b in reversed(text[start[at] : at].encode())]
            else:
                found.append(self.unknown)
            at = start[at]
        return found[::-1]

    def _part(self, part: str) -> bytes:
        """A part that was not met lately: kept in two generations, so that frequent ones stay."""
        made = self.old.get(part)
        if made is None:
            made = np.array(self.best(part), "<u4").tobytes()
        if len(part) <= LONGEST_KEPT:
            if len(self.young) >= self.most:
                self.young, self.old = {}, self.young
            self.young[part] = made
        return made

    def encode(self, text: str) -> np.ndarray:
        marked = (SPACE + text.replace(" ", SPACE)) if text else ""
        known, one = self.young.get, self._part
        if len(self.young) + len(marked) > self.most:  # the young ones may become the old ones on the way
            return np.frombuffer(b"".join([self.young.get(p) or one(p) for p in self.cut(marked)]), "<u4")
        return np.frombuffer(b"".join([known(p) or one(p) for p in self.cut(marked)]), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of any ids, as the library writes it: bytes that are no UTF-8 become replacement characters, control
        and unused pieces nothing, the unknown piece ` ⁇ `. A blank in front goes, the one that encoding puts there, and a
        `\u2581` of the original text comes back as a blank: it cannot be told from one."""
        texts, bytes_of, found, run = self.texts, self.bytes_of, [], bytearray()
        for i in ids.tolist():
            if i in bytes_of:
                run.append(bytes_of[i])
                continue
            if run:
                found.append(run.decode(errors="replace"))
                run.clear()
            if i not in self.silent:
                found.append(texts[i] or " ⁇ ")
        found.append(run.decode(errors="replace"))
        text = "".join(found)
        return (text[1:] if text.startswith(SPACE) else text).replace(SPACE, " ")


def encoded(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`<id_col>, ids` (an array) for each row's whole text. Null text is empty and gives no id. Nothing is shuffled.
    Other columns are not read, and rows that repeat are encoded alike."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.load(model)
        for batch in batches:
            for part in common.pieces(batch, 256):
                made = [pieces.encode(t.decode()) for t in binary(part.column(1))]
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in made], dtype=np.int64))).astype(np.int32)
                flat = np.concatenate(made).astype(np.int32) if made else np.empty(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["id", "ids"]
                )

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, ids array<int>").withColumnRenamed("id", id_col)


def decoded(ids: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """`<id_col>, text` for each row of ids. Null ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.load(model)
        for batch in batches:
            for part in common.pieces(batch, 256):
                texts = [pieces.decode(np.array(x or [], np.uint32)) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["id", "text"])

    source = ids.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, text string").withColumnRenamed("id", id_col)


def piece_report(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every whole text: `<id_col>, n_pieces, n_bytes` (byte pieces among them)`, ids_crc32` (of the
    ids as little-endian 32-bit numbers)`, decoded_crc32` (of the decoded text in UTF-8)`, round_trip` (whether the
    decoded text is the original, blanks for `\\u2581`). A row for each row of `docs`: null and empty texts have no piece and
    come back empty, rows that repeat are each encoded, and other columns are not read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.load(model)
        low, high = min(pieces.bytes_of, default=0), max(pieces.bytes_of, default=-1)
        for batch in batches:
            for part in common.pieces(batch, 256):
                rows = []
                for text in binary(part.column(1)):
                    text = text.decode()
                    ids = pieces.encode(text)
                    back = pieces.decode(ids)
                    in_bytes = sum(i in pieces.bytes_of for i in ids[(ids >= low) & (ids <= high)].tolist())
                    rows.append(
                        (
                            len(ids), in_bytes, zlib.crc32(ids.tobytes()), zlib.crc32(back.encode()),
                            back == text.replace(SPACE, " "),
                        )
                    )
                columns = list(zip(*rows)) if rows else [()] * 5
                kinds = [pa.int64()] * 4 + [pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *map(pa.array, columns, kinds)],
                    ["id", "n_pieces", "n_bytes", "ids_crc32", "decoded_crc32", "round_trip"],
                )

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {dict(source.dtypes)['id']}, n_pieces long, n_bytes long, ids_crc32 long, decoded_crc32 long, round_trip boolean"
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)

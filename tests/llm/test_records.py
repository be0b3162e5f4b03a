import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import brute
from ferry.llm import records
from ferry.session import work_folder

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_checksums():
    assert hex(int(records.crc32c([b"123456789"])[0])) == "0xe3069283"
    blobs = [bytes(range(256)) * n + b"tail" for n in (0, 1, 2, 7)]
    assert [int(records.crc32c([b])[0]) for b in blobs] == records.crc32c(blobs).tolist()
    assert int(records.crc32c([bytes(32)])[0]) == 0x8A9136AA  # from the public test vectors of CRC-32C


def test_records_survive_and_damage_is_found():
    payloads = [records.serialise(i, np.arange(i, dtype=np.uint32) * 37) for i in (0, 5, 3000)] + [records.serialise(None, np.array([70000], np.uint32))]
    framed = records.frame(payloads)
    assert records.unframe(framed) == payloads
    assert records.parse(payloads[3])[0] is None and records.parse(payloads[3])[1].tolist() == [70000]
    for at in (0, 9, 20, len(framed[2]) - 1):
        bad = bytearray(framed[2])
        bad[at] ^= 1
        with pytest.raises(ValueError):
            records.unframe([framed[0], bytes(bad)])


def test_against_the_library_on_whole_texts(spark):
    tokenizer = Tokenizer.from_file(PATH)
    texts = brute.TEXTS + ["<|ENDOFTEXT|> A", "It's <|endoftext|>x <|startoftext|> I'LL é ́a    b 12 3,4!? ΣΑΣ Σ", "a\x1cb\x85c\x00d", "﻿x", "ﬁ ﾊﾝ 한글"]
    found = {r.doc_id: r for r in records.token_records(brute.documents(spark, texts), PATH).collect()}
    start = 0
    for i, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes())), i
        start += len(ids)


@pytest.mark.parametrize("name, by_words", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_any_tokenizer(spark, name, by_words):
    """One whose settings are not known to go word by word encodes whole texts."""
    path = public_tokenizers.path(name)
    tokenizer = Tokenizer.from_file(path)
    assert records.Words(path).by_words == by_words
    texts = ["hello world, again", " two  blanks", "a\n\nb", None, ""] + brute.TEXTS[:8]
    found = {r.doc_id: r for r in records.token_records(brute.documents(spark, texts), path).collect()}
    for i, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        assert (found[i].n_tokens, found[i].ids_crc32) == (len(ids), zlib.crc32(ids.tobytes())), text


def test_what_is_kept_changes_nothing():
    texts = pa.array([f"word{k % 7} Alpha{chr(97 + k % 26) * (k % 5)} frequent, frequent ..; {k}" for k in range(400)])
    small, large = records.Words(PATH, 5), records.Words(PATH)
    for at in range(0, 400, 50):
        a, b = small.encode(texts[at : at + 50]), large.encode(texts[at : at + 50])
        assert (a[0] == b[0]).all() and (a[1] == b[1]).all()
    assert len(small.young) < 300 and len(small.old) < 300  # a slice's words at most, beyond its size


def test_one_identifier_of_most_rows_is_in_several_files(spark):
    texts = [f"text {k}" for k in range(300)]
    folder = work_folder(spark)
    docs = brute.documents(spark, texts, ids=[7] * 200 + list(range(1000, 1100)))
    manifest = records.write_records(docs, PATH, folder)
    assert max(r.n_records for r in manifest.collect()) < 150
    rows = records.read_records(spark, manifest, folder).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [7] * 200 + list(range(1000, 1100))


def test_null_and_repeated_identifiers_and_no_rows(spark):
    rows = records.token_records(brute.documents(spark, ["a b", None, "c", "c d e"], ids=[5, None, 5, None]), PATH).collect()
    rows.sort(key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, None, 5, 5] and sum(r.n_tokens for r in rows) == rows[-1].start + rows[-1].n_tokens
    assert records.token_records(brute.documents(spark, []), PATH).count() == 0


def test_shuffled_reads_by_the_index(spark):
    folder = work_folder(spark)
    manifest = records.write_records(brute.documents(spark, [f"word {i}" for i in range(50)]), PATH, folder).collect()
    tokenizer = Tokenizer.from_file(PATH)
    for row in manifest:
        numbers = np.random.default_rng(1).permutation(row.n_records).tolist()
        for doc_id, ids in records.read_some(folder, row.file, numbers):
            assert ids.tolist() == tokenizer.encode(f"word {doc_id}").ids + [1]
    assert sum(r.n_records for r in manifest) == 50

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ferry.llm import queries, spelling
from brute import documents
from conftest import DATA
from oracle import compare, connect


def edits(word, alphabet):
    cuts = [(word[:k], word[k:]) for k in range(len(word) + 1)]
    found = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in alphabet} | {a + c + b[1:] for a, b in cuts if b for c in alphabet}
    return found - {word}


def plain(words, ratio=5):
    """Every word against every edit of it."""
    alphabet = sorted(set("".join(words)))
    near = {w: [x for x in edits(w, alphabet) if x in words] for w in words}
    best = {w: min(x, key=lambda o: (-words[o], o)) for w, x in near.items() if x}
    form = {w: b for w, b in best.items() if words[b] >= ratio * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()}


def rows(frame):
    found = [tuple(r) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len({r[0] for r in found}) == len(found)
    return {r[0]: r[1:] for r in found}


@pytest.mark.parametrize("chunk", [3, 2048])
def test_variants_against_all_edits(spark, chunk):
    rng = random.Random(chunk)
    words = {"".join(rng.choice("abé") for _ in range(rng.randrange(8))): rng.choice([1, 2, 5, 10, 25, 50, 125]) for _ in range(900)}
    words |= {"漢字": 3, "漢": 20, "😀😀": 4, "😀": 4, "ab" * 3000: 5, "ab" * 3000 + "a": 50, "ab" * 1500 + "b" + "ab" * 1499 + "a": 7}
    frame = spark.createDataFrame([(w, n, "x") for w, n in words.items()], "word string, n long, block string")
    assert rows(spelling.variants(frame, chunk=chunk)) == plain(words)


def test_products_find_what_counts_say():
    rng = random.Random(3)
    for n in (0, 1, 5):
        x, y = (["".join(rng.choice("abc") for _ in range(m)) for _ in range(40)] for m in (n, n + 1))
        i, j = spelling.near_pairs(x, y, False)
        assert {(x[a], y[b]) for a, b in zip(i, j)} == {(a, b) for a in x for b in y if b in edits(a, "abc")}
    far = np.full((1, 9000), 97, "<u4")
    assert len(spelling.close_counts(far, far)[0]) == 1  # in double precision


def counted(texts):
    words = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            words[run[: crc % len(run)] + run[crc % len(run) + 1 :] if crc % 199 == 0 else run] += 1
    return {w: n for w, n in words.items() if len(w) >= 6 and n >= 5}


def test_words_of_texts(spark):
    rng = random.Random(1)
    texts = [None, "", "ABCDEF abcdef abcdéf ÀBCDEF short", "x" * 70_000, "nation×nation÷ ÿÿÿÿÿÿ"] + [" ".join(rng.choice(["nation", "Nations", "national", "natíon", "aa"]) for _ in range(300)) for _ in range(40)]
    spoiled = next(i for i in range(1000, 9000) if zlib.crc32(f"{i}:nations".encode()) % 199 == 0)
    ids = [None, 7, 7, *range(100, 100 + len(texts) - 4), spoiled]
    truth = counted(zip(ids, texts))
    found = {r.word: r.n for r in spelling.corpus_words(documents(spark, texts, ids=ids)).collect()}
    assert found == truth and len(truth) == 5
    assert rows(spelling.spelling_report(documents(spark, texts, ids=ids))) == plain(truth)


def test_no_words(spark):
    assert spelling.spelling_report(documents(spark, [])).count() == 0
    assert spelling.spelling_report(documents(spark, [None, "", "one"])).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([("a", 1)], "word string, n long"), ratio=1)


def test_the_given_documents(spark):
    name = "op13_spelling_variants"
    assert compare(spark, connect(DATA), name, queries.QUERIES[name], queries.ORACLES[name], DATA) == ""

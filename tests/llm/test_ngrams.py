import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ferry.llm import ngrams, queries
from brute import TEXTS, documents, words
from conftest import DATA

START, END = object(), object()


class Plain:
    """The automaton whole, as dictionaries, walked a token at a time."""

    def __init__(self, texts, order, weight):
        self.order, self.weight, self.counts = order, weight, Counter()
        for text in texts:
            tokens = [START, *self.tokens(text)]
            for n in range(1, order + 1):
                self.counts.update(tuple(tokens[k - n + 1 : k + 1]) for k in range(max(1, n - 1), len(tokens)))
        single = {k: v for k, v in self.counts.items() if len(k) == 1}
        self.n, self.v = sum(single.values()), len(single)
        self.counts[START,] = len(texts)

    @staticmethod
    def tokens(text):
        return [*words(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), END]

    def base(self, token):
        return (self.counts[token,] + 1) / (self.n + self.v + 1)

    def chance(self, state, token):
        if not state:
            return self.base(token)
        return (self.counts[state + (token,)] + self.weight * self.chance(state[1:], token)) / (self.counts[state] + self.weight)

    def score(self, text):
        state, total = (START,), 0.0
        for token in self.tokens(text):
            state = state[len(state) - self.order + 1 :] if len(state) >= self.order else state
            while state and not self.counts[state]:
                state = state[1:]
            while state and not self.counts[state + (token,)]:
                total += math.log10(self.weight / (self.counts[state] + self.weight))
                state = state[1:]
            total += math.log10(self.chance(state, token))
            state += (token,)
        return total

    def row(self, text):
        tokens = self.tokens(text)
        return len(tokens), sum(self.counts[t,] > 0 for t in tokens), self.n, sum(math.log10(self.base(t)) for t in tokens), self.score(text)


def check(rows, found, model, column):
    truth = sorted(((i, t, *model.row(x)) for i, t, x in rows), key=repr)
    assert len(found) == len(truth)
    for a, b in zip(sorted((tuple(r) for r in found), key=repr), truth):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9), column


@pytest.mark.parametrize("order,weight,batch", [(1, 300.0, 1 << 24), (2, 3.0, 500), (3, 0.5, 20_000), (4, 7.0, 1 << 24)])
def test_against_a_walk_token_by_token(spark, order, weight, batch):
    texts = TEXTS + ["the cat sat on the mat", "The cat sat on the hat", "the cat sat", "mat the on", "\x1c\x85odd\xa0space"] * 3
    ids = [None, 3, 3, *range(10, 10 + len(texts) - 3)]
    docs = documents(spark, texts, ids=ids).withColumn("train", F.lit("x"))
    learns = F.coalesce(F.col("doc_id") % 4 != 1, F.lit(True))
    found = ngrams.scored(docs, learns, order, weight, batch_bytes=batch, part=64).collect()
    rows = [(i, i is None or i % 4 != 1, t) for i, t in zip(ids, texts)]
    check(rows, found, Plain([t for _, train, t in rows if train], order, weight), order)


def test_chances_sum_to_one():
    texts = pa.array(["a b a c", "b a", "", "a b a b c"])
    whole = ngrams.Texts(texts)
    totals = [np.bincount(g.of) for g in whole.grams(3)]
    grams = list(whole.grams(3))
    single = totals[0]
    automaton = ngrams.Automaton(totals, int(single.sum()), len(single), 4, 2.0)
    model = Plain(texts.to_pylist(), 3, 2.0)
    counts, base, score = automaton.walk(whole, grams)
    sums = np.bincount(whole.text[grams[0].at], score)
    assert sums == pytest.approx([model.score(t) for t in texts.to_pylist()])
    for state in ((), ("a",), ("a", "b"), (START,), (START, "a"), ("c",)):
        known = [t for t, *more in model.counts if not more and t is not START]
        unknown = model.chance(state, "never seen")
        assert sum(model.chance(state, t) for t in known) + unknown == pytest.approx(1)


def test_nothing_to_learn_from_and_no_rows(spark):
    rows = ngrams.scored(documents(spark, ["a b", None]), F.lit(None).cast("boolean")).collect()
    assert all((r.n_known, r.train_tokens, r.base_score, r.score) == (0, 0, 0.0, 0.0) for r in rows) and len(rows) == 2
    assert ngrams.score_report(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        ngrams.scored(documents(spark, []), F.lit(True), order=0)


def test_texts_go_to_batches_whole(spark):
    one = ngrams.scored(documents(spark), F.lit(True)).drop("score", "base_score").collect()
    many = ngrams.scored(documents(spark), F.lit(True), batch_bytes=1).drop("score", "base_score").collect()
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, many), key=repr)


def test_the_given_documents(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall()
    rows = [(i, zlib.crc32(str(i).encode()) % 7 == 2, t) for i, t in rows]
    model = Plain([t for _, out, t in rows if not out], ngrams.ORDER, ngrams.WEIGHT)
    found = queries.op11_language_model(spark, DATA).collect()
    check(rows, found, model, "given")
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_counts_against_sql(spark):
    sql = r"""
    WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS w FROM docs),
         k AS (SELECT doc_id, unnest(list_append(list_transform(w, lambda x: 'w' || x), 'end')) AS token FROM t),
         c AS (SELECT token, count(*) FILTER (NOT held) AS c FROM k JOIN docs USING (doc_id) GROUP BY token),
         n AS (SELECT sum(c) AS n, count(*) FILTER (c > 0) AS v FROM c)
    SELECT doc_id, count(*), count(*) FILTER (c > 0), max(n), sum(log10((c + 1) / (n + v + 1))) FROM k JOIN c USING (token), n GROUP BY doc_id"""
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").df()
    docs["held"] = [zlib.crc32(str(i).encode()) % 7 == 2 for i in docs.doc_id]
    truth = {r[0]: r[1:] for r in duckdb.sql(sql).fetchall()}
    for r in queries.op11_language_model(spark, DATA).collect():
        assert (r.n_tokens, r.n_known, r.train_tokens) == truth[r.doc_id][:3] and r.base_score == pytest.approx(truth[r.doc_id][3], rel=1e-9)

import itertools
import random

import numpy as np
import pytest

import brute
from ferry.llm import simhash
from ferry.llm.components import components


def expected(rows):
    fps = [brute.simhash(t) for _, t in rows]
    roots = brute.groups(fps)
    least = {r: min((rows[i][0] for i in range(len(rows)) if roots[i] == r and rows[i][0] is not None), default=None) for r in roots}
    return sorted(((i, f"{fp:016x}", least[r]) for (i, _), fp, r in zip(rows, fps, roots)), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


@pytest.mark.parametrize("ids", [None, [None] * 3 + [7, 7] + list(range(10, 26))])
def test_awkward_rows(spark, ids):
    ids = list(range(len(brute.TEXTS))) if ids is None else ids
    assert found(simhash.near_groups(brute.documents(spark, ids=ids))) == expected(list(zip(ids, brute.TEXTS)))


def test_near_copies_in_chains_and_hot_groups(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=120)
        for _ in range(15):
            base = list(base)
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
            texts.append(" ".join(base))
    texts += [texts[0]] * 100
    rows = list(enumerate(texts))
    assert found(simhash.near_groups(brute.documents(spark, texts))) == expected(rows)
    assert found(simhash.near_groups(brute.documents(spark, texts), most=24)) == expected(rows)  # buckets are dealt again


def test_every_pair_within_the_radius_meets():
    for level, radius in itertools.product(range(3), (1, 3, 4)):
        masks = [m % 2**64 for m in simhash.masks(radius, level)]
        rng = random.Random(level)
        for _ in range(3000):
            differs = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(m & differs == 0 for m in masks)
        assert all(m.bit_count() > 24 for m in masks)


def test_close_points_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, np.int64).repeat(30)
    flips = np.array([sum(1 << int(b) for b in rng.choice(62, rng.integers(0, 4), replace=False)) for _ in base], np.int64)
    fps = sorted(set((base ^ flips).tolist()))
    roots = brute.groups(fps)
    for most in (4096, 14):
        links = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), most=most)
        assert all(bin((r.a ^ r.b) % 2**64).count("1") <= 64 for r in links.collect())
        labels = {r.node: r.root for r in components(links).collect()}
        assert [labels.get(f, f) for f in fps] == [fps[r] for r in roots]


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1001 + i) for i in range(300)]
    rows = chain + star + [(5000, 5000), (7000, 6999)]
    labels = {r.node: r.root for r in components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert all(labels[i] == 0 for i in range(301)) and all(labels[1000 + i] == 1000 for i in range(301))
    assert labels[7000] == 6999 and 5000 not in labels


def test_empty_table(spark):
    assert simhash.near_groups(brute.documents(spark, [])).count() == 0


def test_dedup_keeps_one_of_each_group(spark):
    docs = brute.documents(spark)
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    want = {c for _, _, c in expected(list(enumerate(brute.TEXTS)))}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)

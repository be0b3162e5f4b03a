import pytest

import brute
from ferry.llm import exact


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.mark.parametrize("ids", [None, [None] * 3 + [7, 7] + list(range(10, 26)), [5] * len(brute.TEXTS)])
def test_against_brute_force(spark, ids):
    ids = list(range(len(brute.TEXTS))) if ids is None else ids
    docs = brute.documents(spark, ids=ids)
    assert rows_of(exact.exact_groups(docs)) == brute.exact(list(zip(ids, brute.TEXTS)))


def test_hot_group_and_every_depth_of_the_tree(spark):
    texts = ["copy  of a text"] * 300 + [f"text {i % 40}" for i in range(100)]
    expected = brute.exact(list(enumerate(texts)))
    for rounds, fan_in in ((0, 2), (1, 4), (3, 2)):
        assert rows_of(exact.exact_groups(brute.documents(spark, texts), rounds=rounds, fan_in=fan_in)) == expected


def test_texts_that_share_a_digest_stay_apart(spark, monkeypatch):
    """Forced collisions of the digest: the other parts of the key tell texts apart."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(exact.F, "sha2", lambda c, n: F.lit("00" * 32))
    docs = brute.documents(spark, ["a", "b", "a", "c c"])
    found = {r.doc_id: (r.keep_id, r.group_size) for r in exact.exact_groups(docs).collect()}
    assert found == {0: (0, 2), 1: (1, 1), 2: (0, 2), 3: (3, 1)}


def test_empty_table(spark):
    assert exact.exact_groups(brute.documents(spark, [])).count() == 0
    assert exact.exact_dedup(brute.documents(spark, [])).count() == 0


def test_dedup_keeps_the_columns_and_the_smallest(spark):
    docs = brute.documents(spark)
    kept = exact.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in sorted(brute.exact(list(enumerate(brute.TEXTS)))) if r[3]]


def test_no_python_on_the_executors(spark):
    plan = exact.exact_groups(brute.documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_runs_are_merged_in_sorted_blocks(spark):
    """Each round of the plan merges sorted blocks; small blocks give the same result."""
    texts = [f"text {i % 90}" for i in range(400)]
    groups = exact.exact_groups(brute.documents(spark, texts), block=16)
    assert rows_of(groups) == brute.exact(list(enumerate(texts)))
    plan = groups._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_sort(flatten(collect_list(") == 3 and plan.count("array_sort(collect_list(") == 1

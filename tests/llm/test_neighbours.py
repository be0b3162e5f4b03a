import numpy as np

from ferry.llm import neighbours


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id string, dim string").repartition(3)


def brute_force(rows, k=5):
    usable = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    found = {}
    for q in usable:
        if q % 50 == 0:
            scores = [(-(v @ usable[q]) / np.sqrt((v @ v) * (usable[q] @ usable[q])), i) for i, v in usable.items() if i != q and len(v) == len(usable[q])]
            found[q] = sorted(scores)[:k]
    return found


def test_recall_scores_and_ties(spark):
    rng = np.random.default_rng(0)
    centres = rng.standard_normal((12, 24))
    data = [(i, (centres[i % 12] + 0.4 * rng.standard_normal(24)).tolist()) for i in range(1500)]
    data += [(2000 + i, centres[0].tolist()) for i in range(300)] + [(4000 + i, rng.standard_normal(24).tolist()) for i in range(500)]
    truth = brute_force(data)
    found = neighbours.neighbours(vectors(spark, [(i, v, 0, "x", "y") for i, v in data]), block=400 * 24).collect()
    by = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append(r)
    assert by.keys() == truth.keys()
    hits = sum(r.vec_id in {i for _, i in truth[q]} for q, rows in by.items() for r in rows)
    assert hits >= 0.95 * 5 * len(truth)
    for q, rows in by.items():
        assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5] and [-r.score for r in rows] == sorted(-r.score for r in rows)
    assert [r.vec_id for r in by[2000]] == [2001, 2002, 2003, 2004, 2005]  # equal vectors: smaller identifiers


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (None, [1.0, 2.0]),
            (50, [0.0, 2.0]), (50, [0.0, 2.0]), (8, [1.0, 2.0, 3.0]), (100, [5.0, 1.0, 1.0])]
    found = neighbours.neighbours(vectors(spark, [(i, v, 0, "x", "y") for i, v in rows])).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found) == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0), (100, 1, 8)]
    assert neighbours.neighbours(vectors(spark, [])).count() == 0
    assert neighbours.neighbours(vectors(spark, [(0, [1.0], 0, "", "")])).count() == 0


def test_recall_and_share_on_the_given_vectors():
    """Nine of ten are found though most vectors are not compared, by searches of whole and of bounded radius."""
    import pyarrow.parquet as pq

    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    ids, data = table.column("vec_id").combine_chunks().to_numpy(), np.array(table.column("embedding").to_pylist(), float)
    unit = data / np.linalg.norm(data, axis=1)[:, None]
    asked = np.flatnonzero(ids % 50 == 0)
    cosines = unit[asked] @ unit.T
    cosines[np.arange(len(asked)), asked] = -9
    truth = [set(ids[r]) for r in np.argsort(-cosines, axis=1)[:, :5]]
    radius = np.sqrt(2 - 2 * np.sort(cosines, axis=1)[:, -5])
    for within, most in ((None, 0.55), (radius, 0.25)):
        block = neighbours.Block(ids, data)
        found = {}
        for q, v, _ in block.search(ids[asked], data[asked], 5, within):
            found.setdefault(q, set()).add(v)
        recall = sum(len(found.get(i, set()) & t) for i, t in zip(ids[asked], truth)) / 5 / len(asked)
        assert recall >= 0.9 and block.compared <= most * len(ids) * len(asked), (recall, block.compared / len(ids) / len(asked))

"""The cell index against every pair scored."""

import numpy as np
import pytest

from tomelight.operators import cells, topk


def side(spark, rows, parts=3):
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "id long, v array<double>")
    return topk.side(df.repartition(parts), "id", "v", None, None)


def clustered(n=400, dim=6, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dim)) * 4
    vectors = centres[rng.integers(0, 20, n)] + rng.normal(size=(n, dim)) * 0.2
    vectors[50:180] = vectors[50]  # a third of all rows are copies
    vectors[7] = 0
    return list(enumerate(vectors))


def brute(queries, rows, k, cosine, skip_self):
    unit = lambda v: v / (np.linalg.norm(v) or 1) if cosine else v
    out = []
    for q, v in queries:
        scores = [(-topk.fixed_point(np.array(unit(v) @ unit(w))).item(), i) for i, w in rows if not (skip_self and i == q)]
        out += [(q, r + 1, i) for r, (_, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


@pytest.mark.parametrize("cosine", [True, False])
@pytest.mark.parametrize("block_rows,group", [(4096, 4096), (30, 11)])
def test_best_rows(spark, monkeypatch, cosine, block_rows, group):
    monkeypatch.setattr(cells, "QUERY_GROUP", group)
    rows = clustered()
    found = cells.best(side(spark, rows), side(spark, rows), 4, cosine, True, block_rows)
    assert found.columns == ["query_id", "rank", "item_id", "dense", "lexical"]
    assert sorted((r.query_id, r.rank, r.item_id) for r in found.collect()) == brute(rows, rows, 4, cosine, True)


def test_most_cells_are_skipped(spark):
    rows = [(i, v) for i, v in clustered(900) if i < 50 or i >= 180]
    corpus = side(spark, rows)
    index = cells.build(corpus, True)
    assert index.counts.sum() == len(rows) and len(index.centroids) == 28
    floor = topk.nearest(corpus, corpus, 3, skip_self=True).groupBy("query_id").min("score")
    asked = corpus.join(floor.withColumnsRenamed({"query_id": "id", "min(score)": "floor"}), "id")
    met = cells.asked_cells(asked, index, 4, True, False).union(cells.asked_cells(asked, index, 4, True, True)).collect()
    assert len(met) == len(set(met))
    share = sum(index.counts[r.cell] for r in met) / len(rows) ** 2
    assert share < 0.25


def test_few_and_no_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])]
    found = cells.best(side(spark, rows), side(spark, rows), 5, False, False)
    assert sorted((r.query_id, r.rank, r.item_id) for r in found.collect()) == brute(
        [(i, np.array(v)) for i, v in rows], [(i, np.array(v)) for i, v in rows], 5, False, False
    )
    none = side(spark, rows).limit(0)
    assert cells.best(side(spark, rows), none, 5).collect() == [] == cells.best(none, side(spark, rows), 5).collect()


def test_large_sides_meet_in_cells(spark):
    rows = clustered(120)
    df = side(spark, rows)
    limits = {"max_broadcast_rows": 5, "block_rows": 40}
    found, grid = (topk.nearest(df, df, 3, skip_self=True, **limits, large=large).collect() for large in ("cells", "grid"))
    assert sorted((r.query_id, r.rank, r.item_id) for r in found) == sorted((r.query_id, r.rank, r.item_id) for r in grid)
    with pytest.raises(ValueError):
        topk.nearest(df, df, 3, large="other")

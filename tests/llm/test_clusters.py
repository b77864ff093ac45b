import hashlib
import math

import numpy as np
import pytest

from tests.llm.conftest import SF_DIR
from tests.oracle import connect, difference
from tidelane.llm import clusters
from tidelane.llm.queries import ORACLES, QUERIES
from tidelane.session import shared_folder
from tidelane.sources.files import child_names


def brute(rows, k=8, dims=64, rounds=10):
    """Rows of (vec_id, embedding): every vector against every centroid, in Python integers."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:k]]

    def assign():
        every = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids] for _, v in kept]
        return [(min(range(len(d)), key=d.__getitem__), min(d)) for d in every]

    for _ in range(rounds):
        placed = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (at, _) in zip(kept, placed, strict=True) if at == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    placed = assign()
    total = sum(d for _, d in placed)
    each = [sum(d for at, d in placed if at == c) for c in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((str(i), c, d, each[c], total, sha[c]) for (i, _), (c, d) in zip(kept, placed, strict=True))


def found(frame):
    assert frame.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((str(r[0]), *r[1:]) for r in frame.collect())


def test_query_against_sql_and_brute_force(spark):
    frame = QUERIES["op11_drift_clusters"](spark, SF_DIR)
    assert difference(frame, connect(SF_DIR), ORACLES["op11_drift_clusters"]) is None
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert found(frame) == brute(rows)


def vectors(spark, rows, more=""):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<double>{more}")


def test_odd_rows(spark):
    random = np.random.default_rng(5)
    rows = [(i % 40, random.normal(size=64).tolist()) for i in range(120)]
    same = rows[3][1]
    rows += [(500 + i, same) for i in range(60)] + [(7, same), (7, same), (None, same), (None, rows[1][1])]
    bad = [(600, None), (601, []), (602, same[:63]), (603, [*same, 0.0]), (604, [None, *same[1:]]), (605, [math.nan, *same[1:]]), (606, [math.inf, *same[1:]])]
    wide = [(*r, "a", 1, 2) for r in rows + bad]
    assert found(clusters.cluster_vectors(vectors(spark, wide, ", cluster string, row int, vector int"))) == brute(rows + bad)


@pytest.mark.parametrize("n", [1, 3, 8])
def test_fewer_vectors_than_centroids(spark, n):
    rows = [(i, [float(i % 2)] * 64) for i in range(n)]  # ties: equal vectors make equal centroids
    assert found(clusters.cluster_vectors(vectors(spark, rows))) == brute(rows)


def test_no_vectors(spark):
    empty = clusters.cluster_vectors(vectors(spark, []))
    assert found(empty) == [] and dict(empty.dtypes)["inertia"] == "bigint"
    assert found(clusters.cluster_vectors(vectors(spark, [(1, [1.0])]))) == []


def test_a_component_that_is_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="is beyond"):
        clusters.cluster_vectors(vectors(spark, [(1, [1e30] * 64)])).collect()


def test_nothing_is_left_but_the_result(spark):
    def left():
        return [n for n in child_names(spark, shared_folder(spark)) if n.startswith("clusters-")]

    before = left()
    clusters.cluster_vectors(vectors(spark, [(i, [float(i)] * 64) for i in range(30)])).collect()
    assert left() == before
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tidelane_")]


def test_loosening_is_a_bound_below_the_full_drift():
    random = np.random.default_rng(1)
    less = 0
    for _ in range(400):
        dims = int(random.integers(1, 6))
        center, old = random.normal(size=(2, dims)) * 5
        new = old + random.normal(size=dims) * random.choice([0.01, 1, 10])
        radius = float(random.choice([0.0, 0.1, 2.0]))
        bound = clusters.loosening(center, radius, old, new)
        around = random.normal(size=(2000, dims))
        around = center + radius * around / np.linalg.norm(around, axis=1)[:, None]
        nearer = np.linalg.norm(around - old, axis=1) - np.linalg.norm(around - new, axis=1)
        drift = np.linalg.norm(new - old)
        assert nearer.max() <= bound + 1e-9 and bound <= drift
        less += bound < 0.9 * drift
    assert less > 100
    assert clusters.loosening(old, 1.0, old, old) == 0.0


def test_bounds_save_scans_and_change_nothing():
    random = np.random.default_rng(2)
    x = (random.normal(size=(3000, 8)) * 200 + random.integers(0, 6, 3000)[:, None] * 900).astype(np.int64)
    centroids = x[:6].copy()
    state = clusters.State(x, centroids)
    state.scan(np.arange(len(x)))
    full = clusters.State(x, centroids)
    full.scan(np.arange(len(x)))
    whole = clusters.loosenings
    for _ in range(8):
        sums = clusters._sums(x, state.cluster, 6)
        centroids = clusters._moved(centroids, sums.astype(object))
        state.move(centroids)
        try:  # the same with the largest drift for every cluster
            clusters.loosenings = lambda old, new, radii: np.full(len(old), np.linalg.norm(new - old, axis=1).max())
            full.move(centroids)
        finally:
            clusters.loosenings = whole
        distances = clusters.squared_distances(x, centroids)
        assert (state.cluster == distances.argmin(1)).all() and (full.cluster == state.cluster).all()
        assert (state.upper**2 >= distances[np.arange(len(x)), state.cluster] * (1 - 1e-9)).all()
    assert state.scanned < full.scanned < 9 * len(x)


def test_squared_distances_are_exact_at_any_size():
    for size in (10, 1 << 20, 1 << 26):
        random = np.random.default_rng(size)
        x, c = random.integers(-size, size, (20, 64)), random.integers(-size, size, (5, 64))
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, w, strict=True)) for w in c] for v in x]
        assert clusters.squared_distances(x, c).tolist() == want


def test_rounds_move_no_vectors_between_tasks(spark):
    """Vectors and state are bucketed alike: the join of a round needs no exchange."""
    rows = spark.range(1000).selectExpr("id AS row", "array(1, 2) AS vector")
    a, b = clusters._Bucketed(rows, 4), clusters._Bucketed(rows.selectExpr("row", "1 AS cluster"), 4)
    plan = a.read().join(b.read().hint("shuffle_hash"), "row")._jdf.queryExecution().executedPlan().toString()
    a.drop()
    b.drop()
    assert "ShuffledHashJoin" in plan and "Exchange" not in plan

import hashlib
import math

import duckdb
import numpy as np

from tendril.llm import centroids as C

SCHEMA = "vec_id long, embedding array<float>, cluster int, numbers string"


def brute(rows, k, rounds, dim, scale=64):
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    cents = [list(v) for _, v in start]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        groups = [[] for _ in cents]
        for _, v in kept:
            groups[near(v)[1]].append(v)
        cents = [[sum(x) // len(g) for x in zip(*g, strict=True)] if g else c for g, c in zip(groups, cents, strict=True)]
    return sorted(((i is None, i or 0), *near(v)) for i, v in kept), cents


def odd_vectors():
    rng = np.random.default_rng(1)
    rows = [(k, [float(np.float32(x)) for x in rng.normal(size=4)]) for k in range(60)]
    rows += [(3, rows[3][1])] * 20 + [(90, None), (91, [1.0, 2.0]), (92, [1.0, None, 2.0, 3.0]), (93, [1.0, float("nan"), 2.0, 3.0]), (94, [float("inf"), 0.0, 0.0, 0.0]), (None, [0.0, -0.5, 0.25, 0.0]), (95, []), (96, [-1e-9, 0.0, 0.0, -0.0])]
    return rows


def test_clusters_of_odd_vectors_equal_brute_force(spark):
    rows = odd_vectors()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(4)
    for k, rounds in ((5, 3), (16, 3), (3, 0), (200, 2)):
        found, cents = C.clustered(df, k, rounds, 4)
        expected, at = brute(rows, k, rounds, 4)
        assert sorted(((r.vec_id is None, r.vec_id or 0), r.distance, r.cluster) for r in found.collect()) == expected and cents == at


def test_no_vectors_and_huge_components(spark):
    found, cents = C.clustered(spark.createDataFrame([], SCHEMA))
    assert found.count() == 0 and cents == []
    df = spark.createDataFrame([(1, [3e38] * 64, 0, ""), (2, [-3e38] * 64, 0, "")], SCHEMA)
    found, cents = C.clustered(df, 1, 0)
    assert sorted(abs(v) for c in cents for v in c) == [C.MOST] * 64 and max(r.distance for r in found.collect()) == 64 * (2 * C.MOST) ** 2


def test_tables_give_the_squared_distances():
    rng = np.random.default_rng(0)
    x, cents = rng.integers(-30, 30, (200, 64)), rng.integers(-30, 30, (7, 64))
    assert (C.distances(x, cents) == ((x[:, None] - cents[None]) ** 2).sum(axis=2)).all()


def test_query_equals_brute_force_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    got = sorted(tuple(r[x] for x in names) for r in C.op13_lookup_table_clusters(spark, folder).collect())
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected, cents = brute(rows, 16, 3, 64)
    assert [(i, d, c) for (_, i), d, c in expected] == [(r[0], r[2], r[1]) for r in got]
    assert {r[1]: r[5] for r in got} == {k: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for k, c in enumerate(cents) if k in {r[1] for r in got}}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    assert sorted(con.execute(f"SELECT {', '.join(names)} FROM ({C.OP13_SQL})").fetchall()) == got

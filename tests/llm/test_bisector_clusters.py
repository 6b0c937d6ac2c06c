import hashlib
import math
import random

import numpy as np
import pytest

from tableflow.llm import bisector_clusters as B
from tests.llm.helpers import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, `packed` int"


def brute(rows, k=40, rounds=5, dims=64, seed=2):
    """Every distance computed, in whole Python numbers."""
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), np.array(v, "<i4").tobytes(), v)
                   for i, v in kept if i is not None)
    centres = [v for *_, v in first[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds if centres else 0):
        held = [[] for _ in centres]
        for _, v in kept:
            held[near(v)[1]].append(v)
        centres = [[sum(x) // len(h) for x in zip(*h)] if h else c for h, c in zip(held, centres)]
    out = [(i, near(v)[1], near(v)[0]) for i, v in kept] if centres else []
    total, per = sum(d for *_, d in out), {}
    for _, c, d in out:
        per[c] = per.get(c, 0) + d
    return sorted(((i, c, d, per[c], total, hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest())
                   for i, c, d in out), key=str)


def answer(df, **options):
    placed, centres = B.cluster(df, **options)
    out = B.with_inertia(placed, centres)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, out.collect()), key=str)


def test_equals_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    assert answer(df) == brute([(r.vec_id, r.embedding) for r in df.collect()])


def test_odd_vectors(spark):
    rng = random.Random(5)
    rows = [(k, [float(rng.randint(-3, 3)) / 256 for _ in range(64)]) for k in range(60)]
    rows += [(k % 7, rows[k][1]) for k in range(20)] + [(None, rows[3][1]), (None, None), (100, None), (101, [1.0] * 63),
             (102, [1.0] * 65), (103, [float("nan")] + [0.0] * 63), (104, [float("inf")] * 64), (105, [None] + [1.0] * 63),
             (106, []), (107, [0.0] * 64), (108, [-0.001] * 64), (109, [1000.5] * 64)]
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA).repartition(5)
    assert answer(df) == brute(rows)
    assert answer(df.limit(0)) == []
    assert answer(df.where("vec_id IS NULL")) == []
    assert answer(df.where("vec_id < 5")) == brute([r for r in rows if r[0] is not None and r[0] < 5])


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    rows = [(k, [float(k % 4)] + [0.0] * 63) for k in range(200)]
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA).repartition(4)
    got = answer(df)
    assert got == brute(rows)
    assert len({c for _, c, *_ in got}) == 4  # forty first centroids, four places


def test_a_third_of_the_vectors_are_alike(spark):
    rng = random.Random(1)
    rows = [(k, [0.5] * 64 if k % 3 == 0 else [rng.gauss(0, 1) for _ in range(64)]) for k in range(300)]
    df = spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], SCHEMA)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert answer(df, k=7, rounds=2) == brute(rows, k=7, rounds=2)


@pytest.mark.parametrize("scale", [1, 300, 1 << 18])
def test_the_tournament_finds_the_nearest(scale):
    rng = np.random.default_rng(3)
    centres = rng.integers(-256 * scale, 256 * scale, (40, 64))
    centres[7] = centres[3]
    vectors = np.concatenate([rng.integers(-256 * scale, 256 * scale, (500, 64)), centres, (centres[:20] + centres[20:]) // 2])
    number, distance = B.Bisectors(centres, 256 * scale).nearest(vectors)
    every = [[sum(int(a - b) ** 2 for a, b in zip(v, c)) for c in centres] for v in vectors]
    assert number.tolist() == [d.index(min(d)) for d in every]
    assert distance.tolist() == [min(d) for d in every]


def test_components_too_large_for_exact_longs_raise(spark):
    df = spark.createDataFrame([(1, [6e5] * 64, 0, "x", 1)], SCHEMA)
    with pytest.raises(Exception, match="would not fit a long"):
        B.cluster(df)

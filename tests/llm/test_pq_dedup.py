import math

import numpy as np
import pytest

from tableflow.llm import pq_dedup as P
from tests.llm.helpers import SF_SMALL, Union

SCHEMA = "vec_id long, embedding array<float>, label int, n long, node long, vector string"


def brute(rows, threshold=0.98):
    """All pairs in double precision; rows are (id, vector, label)."""
    unit, union = {}, Union()
    for k, (_, v, label) in enumerate(rows):
        union.find(k)
        ok = v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v) and any(v or [])
        if ok:
            x = np.asarray(np.asarray(v, np.float32), float)
            unit[k] = x / np.linalg.norm(x)
    links = dict.fromkeys(range(len(rows)), 0)
    keys = list(unit)
    for a, i in enumerate(keys):
        for j in keys[a + 1:]:
            if rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                union.join(i, j)
    lowest = {}
    for k in range(len(rows)):
        if rows[k][0] is not None:
            lowest[union.find(k)] = min(lowest.get(union.find(k), rows[k][0]), rows[k][0])
    return sorted(((str(rows[k][0]), links[k], lowest.get(union.find(k))) for k in range(len(rows))), key=str)


def _check(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)
    got = P.near_duplicates(df, **options).collect()
    assert sorted(((str(r.vec_id), r.n_links, r.component_id) for r in got), key=str) == brute(rows)
    assert all(r.kept is (r.vec_id == r.component_id) for r in got)


def _clumps(seed, n=150, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    out = []
    for k in range(n):
        v = centres[k % 8] + rng.normal(size=dim) * rng.choice([0.0, 0.03, 0.12, 1.0])
        out.append((k, [float(np.float32(x)) for x in v * rng.choice([1.0, 7.0])], int(rng.integers(0, 3))))
    return out


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("list_vectors", [5, 1000])
def test_finds_every_link(spark, seed, list_vectors):
    _check(spark, _clumps(seed), list_vectors=list_vectors)


def test_small_blocks_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_VECTORS", 7)
    _check(spark, _clumps(9), list_vectors=20)


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = P.near_duplicates(df).collect()
    assert sorted(((str(r.vec_id), r.n_links, r.component_id) for r in got), key=str) == brute(rows)


def test_odd_vectors(spark):
    a = [1.0, 0.0, 0.0]
    rows = [(1, a, 0), (2, a, 0), (2, a, 0), (3, a, 1), (4, a, None), (5, None, 0), (6, [], 0), (7, [0.0, 0.0, 0.0], 0),
            (8, [1.0, None, 0.0], 0), (9, [float("nan"), 1.0, 0.0], 0), (10, [float("inf"), 0.0, 0.0], 0), (None, a, 0),
            (11, [1.0, 0.0], 0), (12, [5.0, 0.0], 0), (13, [-1.0, 0.0, 0.0], 0), (None, [0.0, 1.0, 0.0], 5), (14, [1e30, 1e-30, 0.0], 0)]
    _check(spark, rows)
    assert P.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    _check(spark, [(5, None, 0)])


def test_large_group_of_copies_is_one_node(spark):
    _check(spark, [(k, [1.0, 2.0, 3.0], 0) for k in range(200)] + [(500, [1.0, 2.0, 3.01], 0)])


@pytest.mark.parametrize("lists", [4, 40])
def test_quantiser_distances_are_within_the_code_errors(monkeypatch, lists):
    monkeypatch.setattr(P, "MAX_CENTRES", 8)
    rng = np.random.default_rng(4)
    x = P.unit_rows(rng.normal(size=(300, 16)))
    q = P.fit(x, lists)
    assert len(q.second) == (1 if lists == 4 else 5)
    c = q.base(np.array([1]))[0]
    codes, error = q.encode(x - c)
    true = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    assert (np.abs(q.table_distances(x - c, codes) - true) <= error[None, :] + 1e-6).all()
    members, asking = P.near_codes(codes, error, x[:50], q, c, 0.9, np.arange(50))
    np.fill_diagonal(true, 9)
    assert members[(true[:50] <= 0.9).any(axis=0)].all() and asking[(true[:50] <= 0.9).any(axis=1)].all()


@pytest.mark.parametrize("lists", [12, 60])
def test_probes_reach_every_near_list(monkeypatch, lists):
    monkeypatch.setattr(P, "MAX_CENTRES", 12)
    rng = np.random.default_rng(6)
    x = P.unit_rows(rng.normal(size=(400, 8)))
    y = P.unit_rows(x + rng.normal(size=x.shape) * 0.05)
    q = P.fit(x, lists)
    reach = np.sqrt(((x - y) ** 2).sum(axis=1)).max() + 1e-9
    row, found = q.probes(x, reach)
    pairs = set(zip(row.tolist(), found.tolist()))
    assert all((k, own) in pairs for k, own in enumerate(q.assign(y).tolist()))
    assert (np.diff(row) >= 0).all() and len(pairs) == len(row) < 400 * lists


def test_two_levels_of_lists_find_every_link(spark, monkeypatch):
    monkeypatch.setattr(P, "MAX_CENTRES", 4)
    _check(spark, _clumps(11, n=220), list_vectors=6)


def test_whole_vectors_go_only_where_codes_are_near(spark, monkeypatch):
    """Of far vectors with one close pair, the rerank gets little more than the pair."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 32))
    x[1] = x[0] + 0.01
    df = spark.createDataFrame([(k, [float(v) for v in row], 0, 1, 2, "x") for k, row in enumerate(x)], SCHEMA)
    sizes = spark.sparkContext.accumulator(0)
    exact = P.exact_links

    def counted(queries, members, threshold):
        sizes.add(len(queries) + len(members))
        return exact(queries, members, threshold)

    monkeypatch.setattr(P, "exact_links", counted)
    assert P.near_duplicates(df).where("n_links > 0").count() == 2
    assert sizes.value < 300


def test_any_number_of_lengths(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = []
    for dim in range(1, 91):
        v = rng.normal(size=dim)
        rows += [(4 * dim + k, [float(np.float32(x)) for x in v + rng.normal(size=dim) * e], 1) for k, e in enumerate((0, 0, 0.01, 2))]
    _check(spark, rows)
    monkeypatch.setattr(P, "SAMPLE_VECTORS", 40)  # most lengths are not in the sample
    _check(spark, rows)

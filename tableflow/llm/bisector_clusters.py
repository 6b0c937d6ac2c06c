"""Centroid clustering in exact integers by a bisector tournament.

For two centroids the set of points as near to one as to the other is a plane,
so which is nearer is the sign of one linear form: normal times vector minus
threshold.  Normals and thresholds of all pairs are integers made once a round;
a vector finds its centroid by k - 1 such tests, each of which eliminates one
centroid, and only the distance to the last one is computed.

Vectors are integers, so every test, sum and distance is exact and the result
does not depend on how rows are spread over tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import col, stored

#: A component times this, rounded down, is its integer.
SCALE = 256
CENTROIDS, ROUNDS, DIMENSIONS, SEED = 40, 5, 64, 2
#: With components below this, all distances of 64 dimensions fit a long.
LIMIT = 1 << 27
#: Rows of a batch that are tested at once.
CHUNK = 4096


class Bisectors:
    """The planes between all pairs of centroids."""

    def __init__(self, centroids: np.ndarray, most: int):
        """``most``: no component of a vector or centroid is larger, either way."""
        self.centroids = centroids
        squares = (centroids * centroids).sum(axis=1)
        # below 2^53 doubles are exact as well, and faster
        small = 4 * centroids.shape[1] * most * most < 1 << 53
        self.kind = np.float64 if small else np.int64
        self.normals = (2 * (centroids[None, :, :] - centroids[:, None, :])).astype(self.kind)
        self.thresholds = (squares[None, :] - squares[:, None]).astype(self.kind)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid (ties: the smaller number) and its squared distance."""
        winner = np.zeros(len(vectors), np.int64)
        for start in range(0, len(vectors), CHUNK):
            part = vectors[start:start + CHUNK].astype(self.kind)
            best = winner[start:start + CHUNK]
            for rival in range(1, len(self.centroids)):
                normal = self.normals[best, rival]
                # above zero: nearer to the rival; zero: as near, and the smaller number stays
                best[np.einsum("ij,ij->i", normal, part) > self.thresholds[best, rival]] = rival
        apart = vectors - self.centroids[winner]
        return winner, (apart * apart).sum(axis=1)


def _packed(dimensions: int):
    """Components to integers ``floor(SCALE * x)``, kept as four bytes each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
            whole = np.floor(values * float(SCALE))
            if (np.abs(whole) >= LIMIT).any():
                raise ValueError(f"a component is {LIMIT // SCALE} or more: distances would not fit a long")
            rows = [row.tobytes() for row in whole.astype("<i4")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary()),
                                              pa.array(np.abs(whole).max(axis=1).astype(np.int64))], ["vec_id", "packed", "most"])

    return pack


def _unpacked(packed: pa.Array, dimensions: int) -> np.ndarray:
    return np.frombuffer(b"".join(p.as_py() for p in packed), "<i4").reshape(-1, dimensions).astype(np.int64)


def integer_vectors(embeddings: DataFrame, id_col: str, vec_col: str, dimensions: int) -> DataFrame:
    """``vec_id, packed, most``: the vectors of ``dimensions`` finite components as integers.

    Null vectors, those of other lengths and those with a null, NaN or infinite
    component are left out.  A component of 2^19 or more raises.
    """
    vector = col(vec_col).cast("array<double>")
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = (embeddings.where((F.size(vector) == dimensions) & whole)
            .select(col(id_col).alias("vec_id"), vector.alias("vector")))
    id_type = kept.schema["vec_id"].dataType.simpleString()
    return stored(kept.mapInArrow(_packed(dimensions), f"vec_id {id_type}, packed binary, most long"))


def first_centroids(vectors: DataFrame, k: int, dimensions: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of ``<seed>:<vec_id>``, in hash order; null ids have none.

    Rows alike in id follow the order of their components' bytes.
    """
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.where("vec_id IS NOT NULL").orderBy(rank, "packed").select("packed").limit(k).collect()
    return np.array([np.frombuffer(r["packed"], "<i4") for r in rows], np.int64).reshape(-1, dimensions)


def _summed(planes: Bisectors, dimensions: int):
    """Per task: for every cluster the number of its vectors and their componentwise sums."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(planes.centroids)
        count, sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for batch in batches:
            if batch.num_rows:
                vectors = _unpacked(batch.column(0), dimensions)
                cluster, _ = planes.nearest(vectors)
                count += np.bincount(cluster, minlength=k)
                order = np.argsort(cluster, kind="stable")
                present, begin = np.unique(cluster[order], return_index=True)
                sums[present] += np.add.reduceat(vectors[order], begin)
        used = np.flatnonzero(count)
        # place -1 holds the count, the others the sums
        rows = np.concatenate([count[used, None], sums[used]], axis=1)
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(np.repeat(used, dimensions + 1).astype(np.int32)),
                                          "place": pa.array(np.tile(np.arange(-1, dimensions, dtype=np.int32), len(used))),
                                          "total": pa.array(rows.ravel())})

    return add


def updated(vectors: DataFrame, centroids: np.ndarray, most: int) -> np.ndarray:
    """The centroids after one round: the floor of the mean of their vectors, empty ones as they were.

    Tasks send one row per cluster and component, so a cluster that holds most
    vectors costs no more than another; k rows a component reach the driver.
    """
    dimensions = centroids.shape[1]
    totals = (vectors.select("packed").mapInArrow(_summed(Bisectors(centroids, most), dimensions), "cluster int, place int, total long")
              .groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect())
    sums: dict[int, list[int]] = {}
    for r in totals:
        sums.setdefault(r["cluster"], [0] * (dimensions + 1))[r["place"] + 1] = r["total"]
    out = centroids.copy()
    for cluster, (count, *parts) in sums.items():
        out[cluster] = [s // count for s in parts]
    return out


def cluster(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: int = SEED,
            id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` for every kept vector, and the final centroids.

    With fewer than ``k`` vectors there are as many centroids as vectors.  A null
    id is clustered but never a first centroid; where no row has an id, and in an
    empty table, there is no centroid and no row.  Repeated rows are vectors each.
    """
    vectors = integer_vectors(embeddings, id_col, vec_col, dimensions)
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, cluster int, distance long"
    centroids = first_centroids(vectors, k, dimensions, seed)
    if not len(centroids):
        return embeddings.sparkSession.createDataFrame([], schema), centroids
    most = vectors.agg(F.max("most")).first()[0]
    for _ in range(rounds):
        centroids = updated(vectors, centroids, most)
    planes = Bisectors(centroids, most)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                number, distance = planes.nearest(_unpacked(batch.column(1), dimensions))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number.astype(np.int32)), pa.array(distance)],
                                                 ["vec_id", "cluster", "distance"])

    return stored(vectors.select("vec_id", "packed").mapInArrow(place, schema)), centroids


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def with_inertia(placed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``placed`` with ``cluster_inertia``, ``inertia`` and the ``centroid_sha256`` of its cluster.

    The sums of distances, one row per cluster, reach the driver.
    """
    found = {r["cluster"]: r["n"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    if not found:
        return placed.select("*", F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"),
                             F.lit("").alias("centroid_sha256"))
    known = [(c, n, centroid_digest(centroids[c])) for c, n in sorted(found.items())]
    per_cluster = placed.sparkSession.createDataFrame(known, "cluster int, cluster_inertia long, centroid_sha256 string")
    return (placed.join(F.broadcast(per_cluster), "cluster")
            .select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(sum(found.values())).cast("long").alias("inertia"),
                    "centroid_sha256"))

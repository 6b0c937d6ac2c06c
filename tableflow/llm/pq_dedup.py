"""Near-duplicate vectors by product quantisation.

A coarse quantiser puts every vector into an inverted list of its label: the nearest
centre and, where there are many vectors, the nearest of a second set of centres to
what remains.  The rest is coded per subspace, a byte each; a list holds codes and
their errors, not vectors.  A vector probes every list whose cell can hold a partner:
those with the bisector towards their centre closer than the largest distance of a
link, which loses none.  Distances to a list's codes come from lookup tables, widened
by each code's own error; only vectors with a code that near are fetched whole and
reranked by exact cosine in double precision.

Vectors of different lengths have quantisers of their own, fitted on their share of
the sample, and meet in different units.  Equal vectors are one node with a count;
labels and vectors are identified by a 64-bit hash of both.  Lists are cut into blocks
of a bounded size: a task scans a block of codes for a block of probing vectors and
names those that are near something, and the rerank of such a unit returns link counts
and a spanning forest, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import col, fresh, prepared, stored
from tableflow.llm.graph import components, spread_join
from tableflow.llm.ngram_join import spanning

#: Vectors that the quantisers are fitted on at most, chosen by hash.
SAMPLE_VECTORS = 16_384
#: A list aims at this many vectors of a label.  Up to MAX_CENTRES lists have a centre each; beyond,
#: each centre has up to MAX_CENTRES lists, by a second set of centres that all of them share.
LIST_VECTORS = 1024
MAX_CENTRES = 512
BLOCK_VECTORS = 1024
SUBSPACES = 8
CODEWORDS = 64
#: Distances held at once.
_CELLS = 1 << 22
#: What single precision of probing vectors may add to a distance.
_SLACK = 1e-4


@dataclass
class Quantiser:
    """Coarse and second centres and one codebook per subspace, for vectors of one length."""

    coarse: np.ndarray
    second: np.ndarray
    codebooks: list[np.ndarray]
    cuts: list[int]

    def base(self, lists: np.ndarray) -> np.ndarray:
        """The points around which vectors of these lists are coded."""
        return self.coarse[lists // len(self.second)] + self.second[lists % len(self.second)]

    def assign(self, x: np.ndarray) -> np.ndarray:
        first = _nearest(x, self.coarse)
        return first * len(self.second) + _nearest(x - self.coarse[first], self.second)

    def encode(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals and the distance from each to what its code stands for."""
        codes = np.empty((len(residual), len(self.codebooks)), np.uint8)
        error = np.zeros(len(residual))
        for k, book in enumerate(self.codebooks):
            part = residual[:, self.cuts[k]:self.cuts[k + 1]]
            codes[:, k] = _nearest(part, book)
            error += ((part - book[codes[:, k]]) ** 2).sum(axis=1)
        return codes, np.sqrt(error)

    def table_distances(self, residual: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Distance from every (query) residual to every code, by table lookup."""
        total = np.zeros((len(residual), len(codes)))
        for k, book in enumerate(self.codebooks):
            table = _distances(residual[:, self.cuts[k]:self.cuts[k + 1]], book)
            total += table[:, codes[:, k]]
        return np.sqrt(total)

    def probes(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """``row, list`` of the lists that can hold a vector within ``reach``: both bisectors are no farther."""
        row, first = np.nonzero(_reached(x, self.coarse, reach))
        if len(self.second) == 1:
            return row, first
        rows, lists, step = [], [], max(1, _CELLS // len(self.second))
        for k in range(0, len(row), step):
            part, centre = row[k:k + step], first[k:k + step]
            at, second = np.nonzero(_reached(x[part] - self.coarse[centre], self.second, reach))
            rows.append(part[at])
            lists.append(centre[at] * len(self.second) + second)
        return np.concatenate(rows), np.concatenate(lists)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin(_distances(x, centres), axis=1)


def _reached(x: np.ndarray, centres: np.ndarray, reach: float) -> np.ndarray:
    """Whether a point within ``reach`` of a row can be nearest to each of the centres."""
    d = _distances(x, centres)
    own = np.argmin(d, axis=1)
    apart = np.sqrt(_distances(centres, centres))[own]
    near = d - d[np.arange(len(x)), own][:, None] <= 2 * apart * reach + 1e-9
    near[np.arange(len(x)), own] = True
    return near


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``."""
    return np.maximum((a ** 2).sum(axis=1)[:, None] + (b ** 2).sum(axis=1)[None, :] - 2 * a @ b.T, 0)


def _centres(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centres of ``k`` groups (Lloyd's rounds from evenly spaced rows); fewer if rows repeat."""
    found = np.unique(x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)], axis=0)
    for _ in range(rounds):
        at = np.argmin(_distances(x, found), axis=1)
        held = np.bincount(at, minlength=len(found))
        total = np.zeros_like(found)
        np.add.at(total, at, x)
        found = np.where(held[:, None] > 0, total / np.maximum(held, 1)[:, None], found)
    return found


def fit(sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, codewords: int = CODEWORDS) -> Quantiser:
    """Quantisers from unit vectors (rows), with about ``lists`` lists."""
    coarse = _centres(sample, min(lists, MAX_CENTRES))
    rest = sample - coarse[_nearest(sample, coarse)]
    many = min(-(-lists // MAX_CENTRES), MAX_CENTRES)
    second = _centres(rest, many) if many > 1 else np.zeros((1, sample.shape[1]))
    rest = rest - second[_nearest(rest, second)]
    cuts = [round(k * sample.shape[1] / min(subspaces, sample.shape[1])) for k in range(min(subspaces, sample.shape[1]) + 1)]
    books = [_centres(rest[:, a:b], codewords) for a, b in zip(cuts, cuts[1:])]
    return Quantiser(coarse, second, books, cuts)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _usable(vector: Column, label: Column) -> Column:
    bad = F.exists(vector, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return F.coalesce(label.isNotNull() & ~bad & F.exists(vector, lambda e: e != 0), F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim))


def near_codes(codes: np.ndarray, error: np.ndarray, queries: np.ndarray, quantiser: Quantiser, base: np.ndarray,
               reach: float, itself: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which members (given by codes) and which queries have one of the other side that can be within ``reach``.

    ``itself``: a query's own place among the members, which does not count, or -1.
    """
    members, asking = np.zeros(len(codes), bool), np.zeros(len(queries), bool)
    step = max(1, _CELLS // max(1, len(codes)))
    for k in range(0, len(queries), step):
        near = quantiser.table_distances(queries[k:k + step] - base, codes) <= reach + _SLACK + error[None, :]
        own = itself[k:k + step]
        near[np.flatnonzero(own >= 0), own[own >= 0]] = False
        members |= near.any(axis=0)
        asking[k:k + step] = near.any(axis=1)
    return members, asking


def exact_links(queries: np.ndarray, members: np.ndarray, threshold: float) -> np.ndarray:
    """``(query, member)`` pairs with cosine at or above the threshold, as an n x 2 array."""
    step = max(1, _CELLS // max(1, len(members)))
    found = []
    for k in range(0, len(queries), step):
        pairs = np.argwhere(queries[k:k + step] @ members.T >= threshold - 1e-9)
        pairs[:, 0] += k
        # a matrix product may round otherwise than the product of one pair
        exact = np.einsum("ij,ij->i", queries[pairs[:, 0]], members[pairs[:, 1]])
        found.append(pairs[exact >= threshold])
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", list_vectors: int = LIST_VECTORS) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per input row.

    Vectors of one label and length link at a cosine of ``threshold`` or more;
    ``n_links`` counts the other rows linked directly.  ``component_id`` is the
    smallest id reachable, ``kept`` tells whether it is the row's own.  Null, zero
    and non-finite vectors and those with a null label link with nothing; a null id
    stays null, and is kept where its component has no other.  Repeated rows link with each other.  An
    empty table gives no rows; other columns are not carried.
    """
    prepared(vectors.sparkSession)
    rows = vectors.select(col(id_col).alias("vec_id"), col(label_col).cast("string").alias("label"),
                          col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.withColumn("node", F.when(_usable(F.col("vector"), F.col("label")), F.xxhash64("label", "vector")))
    ids = stored(rows.select("vec_id", "node"))
    nodes = stored(rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("label").alias("label"),
        F.first("vector").alias("vector")).withColumn("dim", F.size("vector")))
    links = stored(_links(nodes, threshold, list_vectors))
    direct = links.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(links.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "member")
    known = (nodes.select("node", "first_id", "copies").join(direct, "node", "left")
             .join(roots, F.col("node") == F.col("member"), "left").withColumn("root", F.coalesce("root", "node")))
    lowest = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = spread_join(known, lowest, "root", "node").select("node", "component_id",
                                                (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out_id = fresh(["n_links", "component_id", "kept"], id_col)
    return ids.join(classes, "node", "left").select(
        F.col("vec_id").alias(out_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")
    ).withColumn("kept", F.col(out_id).eqNullSafe(F.col("component_id")))


def _quantisers(nodes: DataFrame, list_vectors: int) -> dict[int, Quantiser]:
    """Quantisers by vector length, fitted on one bounded sample of all vectors.

    A length that the sample misses has one list around 0 and no codes to speak of:
    its vectors are all compared exactly.  A row per length reaches the driver.
    """
    counted = nodes.groupBy("dim").agg(F.count("*").alias("n"), F.approx_count_distinct("label").alias("labels")).collect()
    share = min(1.0, SAMPLE_VECTORS / max(1, sum(r["n"] for r in counted)))
    chance = F.pmod(F.xxhash64(F.lit("pq"), "node"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample: dict[int, list] = {}
    for r in nodes.where(chance < share).select("dim", "node", "vector").collect():
        sample.setdefault(r["dim"], []).append((r["node"], r["vector"]))
    out = {}
    for r in counted:
        lists = max(1, round(r["n"] / max(1, r["labels"]) / list_vectors))
        chosen = np.array([v for _, v in sorted(sample.get(r["dim"], []))], float).reshape(-1, r["dim"])
        out[r["dim"]] = fit(unit_rows(chosen) if len(chosen) else np.zeros((1, r["dim"])), lists)
    return out


_CELL = ("dim", "label", "list")
_UNIT = (*_CELL, "i", "j")


def _index(nodes: DataFrame, held: Broadcast, reach: float) -> DataFrame:
    """``node, dim, label, copies, query, own, codes, error, probes``: every vector coded in its list.

    ``query`` is the unit vector in single precision, by which it probes others.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part, q = batch.filter(pa.array(dims == dim)), held.value[dim]
                x = unit_rows(_matrix(part.column("vector"), dim))
                own = q.assign(x)
                codes, error = q.encode(x - q.base(own))
                row, lists = q.probes(x, reach)
                ends = np.searchsorted(row, np.arange(len(x) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("node", "dim", "label", "copies")),
                     pa.array([v.tobytes() for v in x.astype("<f4")], pa.binary()), pa.array(own, pa.int32()),
                     pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error.astype(np.float32) + np.float32(1e-6)),
                     pa.ListArray.from_arrays(ends, lists.astype(np.int32))],
                    ["node", "dim", "label", "copies", "query", "own", "codes", "error", "probes"])

    return nodes.select("node", "dim", "label", "copies", "vector").mapInArrow(
        place, "node long, dim int, label string, copies long, query binary, own int, codes binary, error float, probes array<int>")


def _units(index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (codes) and queries dealt into units: a block of a list's codes and a block of those that probe it."""
    probing = index.select("dim", "label", F.explode("probes").alias("list")).groupBy(*_CELL) \
        .agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("query_blocks"))
    holding = index.groupBy("dim", "label", F.col("own").alias("list")) \
        .agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("member_blocks"))
    sizes = holding.join(probing, [*_CELL])

    def block(blocks: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(blocks), "node"), F.col(blocks)).cast("int")

    def upto(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    members = (index.withColumnRenamed("own", "list").join(sizes, [*_CELL])
               .select(*_CELL, block("member_blocks").alias("i"), upto("query_blocks").alias("j"),
                       F.lit(True).alias("member"), "node", F.col("codes").alias("held"), "error"))
    queries = (index.select("dim", "label", F.explode("probes").alias("list"), "node", "query")
               .join(sizes, [*_CELL])
               .select(*_CELL, upto("member_blocks").alias("i"), block("query_blocks").alias("j"),
                       F.lit(False).alias("member"), "node", F.col("query").alias("held"), F.lit(None).cast("float").alias("error")))
    return members, queries


def _links(nodes: DataFrame, threshold: float, list_vectors: int) -> DataFrame:
    """``a, b, n``: link counts (``b`` null) and forests of links (``n`` 0)."""
    held = nodes.sparkSession.sparkContext.broadcast(_quantisers(nodes, list_vectors))
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    members, queries = _units(stored(_index(nodes, held, reach)))

    def scan(key: tuple, unit: pa.Table) -> pa.Table:
        member, dim = unit["member"].to_numpy(), key[0].as_py()
        data, m, q = unit["held"].combine_chunks(), np.flatnonzero(member), np.flatnonzero(~member)
        kept = np.zeros(len(member), bool)
        if len(m) and len(q):
            quantiser = held.value[dim]
            codes = np.frombuffer(b"".join(data[k].as_py() for k in m.tolist()), np.uint8).reshape(len(m), -1)
            asked = np.frombuffer(b"".join(data[k].as_py() for k in q.tolist()), "<f4").reshape(len(q), dim).astype(float)
            error = unit["error"].to_numpy()[m].astype(float)
            node = unit["node"].to_numpy()
            order = np.argsort(node[m])
            at = np.minimum(np.searchsorted(node[m], node[q], sorter=order), len(m) - 1)
            itself = np.where(node[m][order[at]] == node[q], order[at], -1)
            base = quantiser.base(np.array([key[2].as_py()]))[0]
            kept[m], kept[q] = near_codes(codes, error, asked, quantiser, base, reach, itself)
        return unit.select([*_UNIT, "member", "node"]).filter(pa.array(kept))

    survivors = members.union(queries).groupBy(*_UNIT).applyInArrow(
        scan, "dim int, label string, list int, i int, j int, member boolean, node long")

    def rerank(key: tuple, unit: pa.Table) -> pa.Table:
        unit = unit.combine_chunks()
        member = unit["member"].to_numpy()
        node, copies = unit["node"].to_numpy(), unit["copies"].to_numpy()
        x = unit_rows(_matrix(unit["vector"].chunk(0), key[0].as_py()))
        m, q = np.flatnonzero(member), np.flatnonzero(~member)
        pairs = exact_links(x[q], x[m], threshold)
        pairs = np.column_stack([q[pairs[:, 0]], m[pairs[:, 1]]])
        pairs = pairs[node[pairs[:, 0]] != node[pairs[:, 1]]]
        linked = np.bincount(pairs[:, 0], weights=copies[pairs[:, 1]], minlength=len(node)).astype(np.int64)
        some = np.flatnonzero(linked)
        forest = spanning(pairs, len(node))
        a = [*node[some].tolist(), *(int(node[r]) for r, _ in forest)]
        b = [*[None] * len(some), *(int(node[k]) for _, k in forest)]
        count = [*linked[some].tolist(), *[0] * len(forest)]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(count, pa.int64())})

    whole = survivors.join(nodes.select("node", "copies", "vector"), "node")
    return whole.groupBy(*_UNIT).applyInArrow(rerank, "a long, b long, n long")

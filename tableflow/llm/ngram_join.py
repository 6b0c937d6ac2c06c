"""Exact Jaccard join on word n-grams by vertical partitioning of their global order.

A document's set is its distinct n-grams, as 64-bit hashes.  Documents with
equal sets are one node.  All n-grams have one global order, roughly rarest
first: by how often their bucket of a counting sketch occurs, then by hash.  The
order is cut at pivots, the same for all documents, into ``FRAGMENTS`` fragments
that hold about as many n-grams each.  A node is a row per fragment.

Two sets as similar as asked must share an n-gram among the first few of both
(their prefixes), so prefixes are matched to find candidates, and these are dealt
into units of two blocks bounded in nodes and n-grams.  For every unit and fragment
a task counts the partial overlaps of all its pairs; the counts of the fragments are
summed per pair, and only the sums decide.  Short posting lists give candidate
pairs, and two blocks meet where a pair joins them.  The nodes of long lists (large
groups of near copies) are never paired in a table: their blocks all meet, unless
their lengths rule it out.  Nothing is capped: every pair that can be similar is
counted in some unit.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.llm.common import WORD, col, fresh, lower_words_of, prepared, stored
from tableflow.llm.graph import components, spread_join

#: Buckets of the counting sketch, two for each document between these bounds; broadcast, 4 bytes each.
SKETCH_BUCKETS, MOST_BUCKETS = 1 << 21, 1 << 26
SKETCH_CHUNK = 4096
#: Documents whose n-grams a worker holds at once when counting.
SKETCH_ROWS = 1000
#: Bits of the membership maps that spare later steps most rows, 16 for each value between these
#: bounds; broadcast.  A fuller map lets more rows through, never fewer.
MAP_BITS, MOST_MAP_BITS = 1 << 20, 1 << 31
#: Posting lists up to this long are paired, longer ones go to blocks.
SHORT_LIST = 64
#: Nodes of a block; a node of more n-grams than NODE_NGRAMS counts as several.
BLOCK_NODES, NODE_NGRAMS = 512, 2048
#: Fragments of the global order of n-grams.
FRAGMENTS = 8
#: N-grams that two blocks have in common and that are counted by one matrix product.
BLOCK_NGRAMS = 2048

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams; of the whole sequence if it is shorter."""
    if not words:
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - size + 1
    h = np.full(n, size, np.uint64)
    for j in range(size):
        h = (h ^ word[j:j + n]) * _MUL
        h ^= h >> np.uint64(29)
    h *= _MIX
    return np.unique(h ^ (h >> np.uint64(32)))


def prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n) // 100 + 1


def prefix(tokens: np.ndarray, sketch: np.ndarray, percent: int) -> np.ndarray:
    """The first n-grams in the global order, as signed hashes."""
    first = np.argsort(_frequency(tokens, sketch), kind="stable")[:prefix_length(len(tokens), percent)]
    return tokens[first].view(np.int64)


def _frequency(tokens: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    return sketch[(tokens & np.uint64(len(sketch) - 1)).astype(np.int64)]


def _order_key(tokens: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Numbers that follow the global order (up to the lower half of the hashes)."""
    return (_frequency(tokens, sketch).astype(np.uint64) << np.uint64(32)) | (tokens >> np.uint64(32))


def pivots(sketch: np.ndarray, fragments: int) -> np.ndarray:
    """Keys of the global order at which it is cut so that fragments hold as many n-grams each.

    From the counts alone: of the n-grams of one frequency, the hashes up to the
    share that is still missing go to the earlier fragment.
    """
    count, buckets = np.unique(sketch[sketch > 0], return_counts=True)
    if not len(count):
        return np.zeros(fragments - 1, np.uint64)
    mass = np.cumsum(count.astype(np.float64) * buckets)
    out = []
    for k in range(1, fragments):
        asked = mass[-1] * k / fragments
        at = int(np.searchsorted(mass, asked))
        before = mass[at - 1] if at else 0.0
        share = min(max((asked - before) / (mass[at] - before), 0.0), 1.0)
        out.append((int(count[at]) << 32) + min(int(share * (1 << 32)), (1 << 32) - 1))
    return np.array(out, np.uint64)


def fragments_of(tokens: np.ndarray, sketch: np.ndarray, cuts: np.ndarray) -> list[np.ndarray]:
    """The n-grams of a set (sorted hashes) by fragment of the global order, sorted in each."""
    part = np.searchsorted(cuts, _order_key(tokens, sketch), side="right")
    order = np.argsort(part, kind="stable")
    return np.split(tokens[order], np.searchsorted(part[order], np.arange(1, len(cuts) + 1)))


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[str | None]:
    return (x.as_py() for x in batch.column(name))


def _between(least: int, n: int, most: int) -> int:
    """The power of two from ``n`` on, within bounds."""
    return max(least, min(most, 1 << max(0, n - 1).bit_length()))


def _sketch(texts: DataFrame, size: int) -> np.ndarray:
    """How often the n-grams of each bucket occur over all documents."""
    buckets = _between(SKETCH_BUCKETS, 2 * texts.count(), MOST_BUCKETS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for k in range(0, batch.num_rows, SKETCH_ROWS):
                held = [shingle_hashes(lower_words_of(t), size) for t in _texts(batch.slice(k, SKETCH_ROWS), "text")]
                bucket = (np.concatenate(held) & np.uint64(buckets - 1)).astype(np.int64)
                total += np.bincount(bucket, minlength=buckets)
        if total.any():
            chunks = total.reshape(-1, SKETCH_CHUNK)
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(chunks)), pa.int32()),
                 pa.array([TaskContext.get().partitionId() % 32] * len(chunks), pa.int32()),
                 pa.array([zlib.compress(c.tobytes(), 1) for c in chunks], pa.binary())], ["chunk", "lot", "counts"])

    def add(rows: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(c.as_py()), np.int64) for c in rows["counts"])
        return rows.slice(0, 1).set_column(2, "counts", pa.array([zlib.compress(total.tobytes(), 1)], pa.binary()))

    schema = "chunk int, lot int, counts binary"
    part = texts.mapInArrow(count, schema).groupBy("chunk", "lot").applyInArrow(add, schema)
    out = np.zeros(buckets, np.int64)
    for row in part.groupBy("chunk").applyInArrow(add, schema).collect():  # a count per bucket
        out[row["chunk"] * SKETCH_CHUNK:][:SKETCH_CHUNK] = np.frombuffer(zlib.decompress(row["counts"]), np.int64)
    return np.minimum(out, np.iinfo(np.int32).max).astype(np.int32)


def _bitmap(values: DataFrame, name: str) -> np.ndarray:
    """Bit ``value mod n`` set for every value; n, a power of two, follows the number of rows."""
    bits = _between(MAP_BITS, 16 * values.count(), MOST_MAP_BITS)
    bit = F.pmod(col(name).cast("long"), F.lit(bits))
    rows = (values.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")))
    out = np.zeros(bits // 8 + 8192, np.uint8)
    for row in rows.toLocalIterator():  # buckets are numbered from 1 where the value is not 0
        at = max(0, row["bucket"] - 1) * 4096
        out[at:at + len(row["bits"])] |= np.frombuffer(bytes(row["bits"]), np.uint8)
    return out


def _in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """True for every value that was put in (and for some others).

    Bit numbers follow Spark's bitmap functions, where position 0 of a bucket is
    that of its first value, values counting from 1, and 0 a bucket of its own.
    """
    bit = np.mod(values.astype(np.int64), (len(bitmap) - 8192) * 8)
    at = np.where(bit > 0, bit - 1, 0)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _node_rows(docs: DataFrame, held: Broadcast, size: int, percent: int, id_type: str) -> DataFrame:

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, fp, first = [], [], []
            for text in _texts(batch, "text"):
                tokens = shingle_hashes(lower_words_of(text), size)
                n.append(len(tokens))
                fp.append(int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64)) if len(tokens) else None)
                first.append(prefix(tokens, held.value, percent) if len(tokens) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("rowkey"), pa.array(n, pa.int64()), pa.array(fp, pa.int64()),
                 pa.array(first, pa.list_(pa.int64()))], ["doc_id", "rowkey", "n", "fp", "prefix"])

    return docs.mapInArrow(describe, f"doc_id {id_type}, rowkey long, n long, fp long, prefix array<long>")


def _shared_entries(nodes: DataFrame) -> DataFrame:
    """``token, c, fp, n, pos``: places of prefix n-grams that ``c`` > 1 nodes have in their prefixes."""
    counted = (nodes.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("c"))
               .where("c > 1"))
    counted = stored(counted)
    held = nodes.sparkSession.sparkContext.broadcast(_bitmap(counted, "token"))

    def list_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("prefix")
            lengths = np.diff(lists.offsets.to_numpy())
            tokens = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            pos = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            kept = _in_bitmap(held.value, tokens)
            rows = pa.array(owner[kept])
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens[kept]), batch.column("fp").take(rows), batch.column("n").take(rows),
                 pa.array(pos[kept], pa.int64())], ["token", "fp", "n", "pos"])

    places = nodes.select("fp", "n", "prefix").mapInArrow(list_places, "token long, fp long, n long, pos long")
    return places.join(counted, "token")


def _required(a: Column, b: Column, percent: int) -> Column:
    """The least overlap of sets of ``a`` and ``b`` n-grams that are similar enough."""
    return F.ceil((a + b) * percent / F.lit(100 + percent) - F.lit(1e-9))


def _short_pairs(entries: DataFrame, percent: int) -> DataFrame:
    """``a, b, na, nb``: pairs that share n-grams of short posting lists and can be similar, and their lengths.

    Length and the places of each shared n-gram bound the overlap.  So does the
    number of shared prefix n-grams: the prefix that ends first in the order
    misses only what lies behind it.  Shared n-grams of long lists are not
    counted here; both nodes can have at most the fewer of theirs in common.
    """
    lists = F.col("c") <= SHORT_LIST
    a = entries.where(lists).select("token", F.col("fp").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"))
    b = entries.where(lists).select("token", F.col("fp").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"))
    na, nb = F.col("na"), F.col("nb")
    most = F.least("pa", "pb") + F.least(na - F.col("pa"), nb - F.col("pb"))
    ordered = (na < nb) | ((na == nb) & (F.col("a") < F.col("b")))
    need = _required(na, nb, percent)
    shared = (a.join(b, "token").where(ordered & (nb * percent <= na * 100) & (most >= need))
              .groupBy("a", "b", "na", "nb").agg(F.count("*").alias("shared")))
    unlisted = entries.where(~lists).groupBy("fp").agg(F.count("*").alias("more"))
    both = (shared.join(unlisted.select(F.col("fp").alias("a"), F.col("more").alias("more_a")), "a", "left")
            .join(unlisted.select(F.col("fp").alias("b"), F.col("more").alias("more_b")), "b", "left"))
    others = F.least(F.coalesce("more_a", F.lit(0)), F.coalesce("more_b", F.lit(0)))
    behind = F.ceil(F.greatest(na, nb) * percent / F.lit(100)) - 1
    return both.where(F.col("shared") + others + behind >= need).select("a", "b", "na", "nb")


def _tokens(docs: DataFrame, wanted: DataFrame, sketch: Broadcast, size: int) -> DataFrame:
    """``fp, fragment, n, tokens``: the nodes whose row key is wanted (and some others), a row per fragment.

    ``tokens`` are the n-grams of the fragment, ``n`` counts those of the whole set.
    """
    held = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted, "rowkey"))
    cuts = pivots(sketch.value, FRAGMENTS)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("rowkey").to_numpy()
            fp, n, held_tokens = [], [], []
            for k in np.flatnonzero(_in_bitmap(held.value, key)).tolist():
                tokens = shingle_hashes(lower_words_of(batch.column("text")[k].as_py()), size)
                if len(tokens):
                    fp.append(int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).view(np.int64)))
                    n.append(len(tokens))
                    held_tokens += [part.tobytes() for part in fragments_of(tokens, sketch.value, cuts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(fp, np.int64), FRAGMENTS)), pa.array(list(range(FRAGMENTS)) * len(fp), pa.int32()),
                 pa.array(np.repeat(np.array(n, np.int64), FRAGMENTS)), pa.array(held_tokens, pa.binary())],
                ["fp", "fragment", "n", "tokens"])

    found = docs.select("rowkey", "text").mapInArrow(read, "fp long, fragment int, n long, tokens binary")
    return found.dropDuplicates(["fp", "fragment"])


def block_overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Overlap of every set of ``a`` with every set of ``b``, by matrix products over the n-grams they share."""
    def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        lengths = [len(s) for s in sets]
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths)

    (ta, ia), (tb, ib) = flat(a), flat(b)
    common = np.intersect1d(ta, tb)
    out = np.zeros((len(a), len(b)), np.int64)

    def dense(tokens: np.ndarray, owner: np.ndarray, rows: int, part: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(part, tokens), len(part) - 1)
        hit = part[at] == tokens
        grid = np.zeros((rows, len(part)), np.float32)
        grid[owner[hit], at[hit]] = 1
        return grid

    for k in range(0, len(common), BLOCK_NGRAMS):
        part = common[k:k + BLOCK_NGRAMS]
        out += (dense(ta, ia, len(a), part) @ dense(tb, ib, len(b), part).T).astype(np.int64)
    return out


def spanning(pairs: np.ndarray, size: int) -> list[tuple[int, int]]:
    """``(root, member)`` of a forest that connects what the pairs of ``range(size)`` connect."""
    parent = list(range(size))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in pairs.tolist():
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [(find(x), x) for x in range(size) if find(x) != x]


_UNIT = ("root", "low", "i", "high", "j")


def _weight(n: Column) -> Column:
    """What a node counts in a block."""
    return F.ceil(n / NODE_NGRAMS)


def _pair_units(pairs: DataFrame) -> DataFrame:
    """Nodes of candidate pairs dealt into units: ``root, low, i, high, j, side, node``.

    A pair goes with the smallest candidate of its two nodes, so groups of copies
    mostly meet in one unit.  Small groups share a unit, a large one is cut into
    blocks, and two blocks meet if a pair joins them.
    """
    least = (pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
             .groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("least")))
    grouped = stored(pairs.join(least.select(F.col("node").alias("a"), F.col("least").alias("least_a")), "a")
                     .join(least.select(F.col("node").alias("b"), F.col("least").alias("least_b")), "b")
                     .select("a", "b", "na", "nb", F.least("least_a", "least_b").alias("root")))
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("na").alias("n")), F.struct(F.col("b").alias("node"), F.col("nb").alias("n"))))
    sizes = stored(grouped.select("root", ends.alias("e")).select("root", "e.*").distinct()
                   .groupBy("root").agg(F.sum(_weight(F.col("n"))).alias("size")))
    few = F.col("size") <= BLOCK_NODES // 4
    shared = max(1, -(-(sizes.where(few).agg(F.sum("size")).first()[0] or 0) // BLOCK_NODES))

    def block(node: str) -> Column:
        own = F.pmod(F.xxhash64(node), F.ceil(F.col("size") / BLOCK_NODES))
        return F.when(few, F.pmod(F.xxhash64("root"), F.lit(shared))).otherwise(own).cast("int")

    first, last = F.least("at_a", "at_b"), F.greatest("at_a", "at_b")
    ends = F.explode(F.array(*[F.struct(F.when(F.col(f"at_{x}") == first, F.lit(0)).otherwise(F.lit(1)).alias("side"),
                                        F.col(x).alias("node")) for x in "ab"])).alias("end")
    return (grouped.join(sizes, "root").withColumns({"at_a": block("a"), "at_b": block("b")})
            .withColumn("low", F.when(few, F.lit(-1)).otherwise(F.lit(0)))
            .select(F.when(few, F.lit(0)).otherwise(F.col("root")).alias("root"), "low", first.alias("i"),
                    F.col("low").alias("high"), last.alias("j"), ends)
            .select(*_UNIT, "end.side", "end.node").distinct())


def _list_units(entries: DataFrame, percent: int) -> DataFrame:
    """Nodes of long posting lists dealt into units.

    Lists with the same smallest node are one group; of its blocks every two meet
    whose lengths can be similar.
    """
    leaders = entries.groupBy("token").agg(F.min("fp").alias("root"))
    ratio = float(np.log(100 / percent))
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(ratio) + F.lit(1e-9)).cast("int")
    nodes = stored(entries.join(leaders, "token").select("root", band.alias("band"), F.col("fp").alias("node"), "n").distinct())
    # at most a row per band in a map: lengths grow by a factor from band to band
    sizes = (nodes.groupBy("root", "band").agg(F.ceil(F.sum(_weight(F.col("n"))) / BLOCK_NODES).cast("int").alias("blocks"))
             .groupBy("root").agg(F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("bands")))
    here, above, below = (F.coalesce(F.try_element_at("bands", F.col("band") + k), F.lit(0)) for k in (0, 1, -1))
    dealt = (nodes.join(sizes, "root").withColumns({"blocks": here, "above": above, "below": below})
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))

    def unit(side: int, low: Column, i: Column, high: Column, j: Column) -> Column:
        return F.struct(low.alias("low"), i.alias("i"), high.alias("high"), j.alias("j"), F.lit(side).alias("side"))

    def over(first: Column, past: Column, make) -> Column:
        return F.when(past > first, F.transform(F.sequence(first, past - 1), make)).otherwise(F.array())

    band, block, zero = F.col("band"), F.col("block"), F.lit(0)
    units = F.concat(
        over(block, F.col("blocks"), lambda j: unit(0, band, block, band, j)),
        over(zero, block, lambda i: unit(1, band, i, band, block)),
        over(zero, F.col("above"), lambda j: unit(0, band, block, band + 1, j)),
        over(zero, F.col("below"), lambda i: unit(1, band - 1, i, band, block)))
    return dealt.select("root", "node", F.explode(units).alias("u")).select("root", "u.low", "u.i", "u.high", "u.j", "u.side", "node")


def _partial_counts(units: DataFrame, tokens: DataFrame) -> DataFrame:
    """For every unit and fragment the overlaps of its pairs: the nodes of both sides in order, and a count for each pair.

    A block that meets itself is both sides.  Counts are a packed matrix, a row
    for each node of the first side.
    """
    work = units.join(tokens.withColumnRenamed("fp", "node"), "node")

    def count(rows: pa.Table) -> pa.Table:
        same = rows["low"][0] == rows["high"][0] and rows["i"][0] == rows["j"][0]
        node, side = rows["node"].to_numpy(), rows["side"].to_numpy()
        n, tokens = rows["n"].to_numpy(), rows["tokens"].combine_chunks()
        order = np.argsort(node, kind="stable")  # every fragment has the same nodes: the same order
        left = order[side[order] == 0]
        right = left if same else order[side[order] == 1]
        sets = {k: np.frombuffer(tokens[k].as_buffer(), np.uint64) for k in {*left.tolist(), *right.tolist()}}
        shared = np.zeros((len(left), len(right)), np.int64)
        if len(left) and len(right):
            shared = block_overlaps([sets[k] for k in left.tolist()], [sets[k] for k in right.tolist()])
        ends = [[node[left].tolist()], [n[left].tolist()], [node[right].tolist()], [n[right].tolist()]]
        arrays = [pa.array(x, pa.list_(pa.int64())) for x in ends] + [pa.array([_packed(shared)], pa.binary())]
        return pa.table([*(rows[c].slice(0, 1) for c in _UNIT), *arrays], [*_UNIT, *_COUNTED])

    kinds = dict(units.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in _UNIT) + ", left array<long>, left_n array<long>, right array<long>, " \
        "right_n array<long>, counts binary"
    return work.groupBy(*_UNIT, "fragment").applyInArrow(count, schema)


_COUNTED = ("left", "left_n", "right", "right_n", "counts")


def _packed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<i4").tobytes(), 1)


def _unit_links(partial: DataFrame, percent: int) -> DataFrame:
    """Links within the units, as spanning forests ``a, b``: partial counts are summed per pair, and the sums decide."""

    def link(rows: pa.Table) -> pa.Table:
        left, left_n, right, right_n = (np.array(rows[c][0].as_py(), np.int64) for c in _COUNTED[:4])
        shared = np.zeros(len(left) * len(right), np.int64)
        for counts in rows["counts"]:
            shared += np.frombuffer(zlib.decompress(counts.as_py()), "<i4")
        shared = shared.reshape(len(left), len(right))
        hits = np.argwhere((100 + percent) * shared >= percent * (left_n[:, None] + right_n[None, :]))
        node, place = np.unique(np.concatenate([left, right]), return_inverse=True)
        forest = spanning(np.column_stack([place[hits[:, 0]], place[len(left) + hits[:, 1]]]), len(node))
        return pa.table({"a": pa.array([int(node[x]) for x, _ in forest], pa.int64()),
                         "b": pa.array([int(node[y]) for _, y in forest], pa.int64())})

    return partial.groupBy(*_UNIT).applyInArrow(link, "a long, b long")


def jaccard_classes(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, rowkey, n_shingles, component_id, component``: one row per input row.

    Documents link when ``100 * |intersection| >= percent * |union|`` of their
    distinct ``size``-word n-grams (A-Z lower-cased); a shorter text is one n-gram
    of all its words.  ``component_id`` is the smallest id reachable by links.
    Null, empty and blank texts have an empty set and link with nothing.  Null ids
    stay null; a component of null ids only has a null ``component_id``.
    ``rowkey`` is the hash of id and text (:func:`row_key`), ``component`` numbers the
    classes (null for empty sets).  Other columns are not carried.  Identity of sets and
    n-grams is that of 64-bit hashes.
    """
    prepared(docs.sparkSession)
    kind = docs.select(col(id_col)).dtypes[0][1]
    texts = docs.select(col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("rowkey"), col(text_col).alias("text"))
    sketch = docs.sparkSession.sparkContext.broadcast(_sketch(texts.select("text"), size))
    rows = stored(_node_rows(texts, sketch, size, percent, kind))
    nodes = stored(rows.where("fp IS NOT NULL").groupBy("fp").agg(
        F.min("rowkey").alias("rowkey"), F.min("doc_id").alias("first_id"), F.first("n").alias("n"),
        F.first("prefix").alias("prefix")))
    entries = stored(_shared_entries(nodes))
    pairs = stored(_short_pairs(entries, percent))
    units = stored(_pair_units(pairs).union(_list_units(entries.where(F.col("c") > SHORT_LIST), percent)))
    wanted = units.select(F.col("node").alias("fp")).distinct().join(nodes.select("fp", "rowkey"), "fp")
    tokens = stored(_tokens(texts, stored(wanted), sketch, size))
    links = _unit_links(_partial_counts(units, tokens), percent)
    labels = components(links)
    known = (nodes.select("fp", "first_id").join(labels.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("root", F.coalesce("root", "fp")))
    lowest = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = spread_join(known.select("fp", "root"), lowest, "root", "fp").select("fp", "component_id", "root")
    return (rows.select("doc_id", "rowkey", F.col("n").alias("n_shingles"), "fp").join(classes, "fp", "left")
            .select("doc_id", "rowkey", "n_shingles",
                    F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.col("root").alias("component")))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with one row of each class: that of the smallest id (null last).

    Texts without words have no class and all stay.
    """
    classes = jaccard_classes(docs, size, percent, id_col, text_col).where("component IS NOT NULL")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rowkey")
    key, kept_key = fresh(docs.columns, "_rowkey"), fresh(docs.columns, "_kept_rowkey")
    kept = classes.groupBy("component").agg(F.min(order).alias("first")).select(F.col("first.rowkey").alias(kept_key))
    chosen = (docs.withColumn(key, row_key(id_col, text_col)).join(kept, F.col(key) == F.col(kept_key))
              .dropDuplicates([key]).drop(key, kept_key))
    wordless = docs.where(~F.coalesce(F.rlike(col(text_col), F.lit(WORD)), F.lit(False)))
    return chosen.unionByName(wordless)


def row_key(id_col: str, text_col: str) -> Column:
    """Rows alike in id and text have one key."""
    return F.xxhash64(col(id_col).isNull(), col(id_col), col(text_col).isNull(), col(text_col))

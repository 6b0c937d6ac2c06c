import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tableflow.llm import mixture as M
from tableflow.llm.queries import weight_by_place
from tests.llm.helpers import documents, odd_documents, words


def brute_seats(votes, seats, most):
    given = [0] * len(votes)
    for _ in range(min(seats, sum(m for v, m in zip(votes, most) if v > 0))):
        open_ = [i for i in range(len(votes)) if given[i] < most[i] and votes[i] > 0]
        best = max(open_, key=lambda i: (votes[i] / (2 * given[i] + 1), -i))
        given[best] += 1
    return given


@pytest.mark.parametrize("seed", range(25))
def test_seats_match_highest_quotients(seed):
    rng = random.Random(seed)
    votes = [rng.choice([0, rng.randint(1, 50), rng.randint(1, 9000)]) for _ in range(rng.randint(1, 12))]
    most = [rng.choice([3, 40, 10_000]) for _ in votes]
    seats = rng.randint(0, 300)
    assert M.sainte_lague(votes, seats, most) == brute_seats(votes, seats, most)


def test_ties_go_to_the_first():
    assert M.sainte_lague([5, 5, 5], 4, [9, 9, 9]) == [2, 1, 1]
    assert M.sainte_lague([], 3, []) == [] and M.sainte_lague([0, 0], 3, [5, 5]) == [0, 0]


@pytest.mark.parametrize("seed", range(25))
def test_shares_match_repeated_resharing(seed):
    rng = random.Random(seed)
    size = [rng.choice([0, rng.randint(1, 20), rng.randint(1, 5000)]) for _ in range(rng.randint(1, 9))]
    weight = [rng.randint(1, 3) for _ in size]
    target, full = [0.0] * len(size), {i for i, s in enumerate(size) if s == 0}
    while True:  # share what is left by weight, fix who is above, again
        left = sum(size) - sum(3 * size[i] for i in full)
        rest = [i for i in range(len(size)) if i not in full]
        for i in rest:
            target[i] = left * weight[i] / sum(weight[j] for j in rest)
        over = {i for i in rest if target[i] > 3 * size[i]}
        if not over:
            break
        full |= over
        for i in over:
            target[i] = 3.0 * size[i]
    assert M.capped_shares(size, weight, sum(size)) == pytest.approx(target)


@pytest.mark.parametrize("shard_words", [1 << 17, 500])
def test_mix_meets_targets(spark, shard_words):
    df = documents(spark)
    rows = M.mix(df, weight_by_place, shard_words=shard_words).collect()
    texts = {r.doc_id: (r.text, r.source) for r in df.collect()}
    assert len(rows) == len(texts)
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert r["size"] == len(words(texts[r.doc_id][0])) and r.source == texts[r.doc_id][1]
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
        size[r.source] += r["size"]
        target[r.source] = r.target
    for s in target:
        assert abs(taken[s] - target[s]) <= M.BLOCK_WORDS + 1e-6
        assert target[s] <= 3 * size[s] + 1e-6
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    again = {r.doc_id: r.taken for r in M.mix(df.repartition(7), weight_by_place, shard_words=shard_words).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_odd_rows(spark):
    df = odd_documents(spark)
    rows = M.mix(df, weight_by_place).collect()
    assert len(rows) == df.count()
    assert all(r.taken == 0 for r in rows if r["size"] == 0)
    assert {r.source for r in rows} == {"a", "b", "ü", None}
    assert M.mix(df.limit(0), weight_by_place).count() == 0


def test_mixed_rows_repeat_whole_documents_and_cut_one(spark):
    df = documents(spark)
    decided = {r.doc_id: (r["size"], r.taken) for r in M.mix(df, weight_by_place).collect()}
    texts = {r.doc_id: r.text for r in df.collect()}
    out = M.mixed_rows(df, weight_by_place, chars_col="n_chars")
    assert out.columns == df.columns
    got = defaultdict(list)
    for r in out.collect():
        got[r.doc_id].append(r.text)
        assert r.n_chars == len(r.text)
    for i, (size, taken) in decided.items():
        assert sum(len(words(t)) for t in got[i]) == taken
        assert sum(t == texts[i] for t in got[i]) == (taken // size if size else 0)
        assert all(texts[i].startswith(t) for t in got[i])
    odd = odd_documents(spark)
    assert M.mixed_rows(odd, weight_by_place).columns == odd.columns
    assert M.mixed_rows(odd, weight_by_place).count() > 0


def _alike(spark, n, texts=("one two three four five six seven eight nine ten eleven",), source="hot"):
    rows = spark.range(n).select(F.lit(None).cast("long").alias("doc_id"), F.element_at(
        F.array(*[F.lit(t) for t in texts]), (F.col("id") % len(texts) + 1).cast("int")).alias("text"), F.lit(source).alias("source"))
    other = spark.range(400).selectExpr("id AS doc_id", "concat('other words of text ', id, ' and more') AS text",
                                        "IF(id % 2 = 0, 'b', NULL) AS source")
    return rows.repartition(6).union(other)


@pytest.mark.parametrize("n,weights", [(3000, (1, 2, 3)), (1500, (3, 1, 1)), (2500, (1, 0, 0))])
def test_rows_alike_have_a_share_each(spark, n, weights):
    df = _alike(spark, n, ("a b c d e f g h i j k", "k j i h g f e d c b a"))

    def weight(place, _name):
        return float(weights[place % 3])

    decided = M.mix(df, weight).collect()
    assert len(decided) == df.count()
    rows = M.mixed_rows(df, weight).collect()
    for source in ("hot", "b", None):
        taken = sum(r.taken for r in decided if r.source == source)
        assert sum(len(words(r.text)) for r in rows if r.source == source) == taken
        target = next(r.target for r in decided if r.source == source)
        assert abs(taken - target) <= M.BLOCK_WORDS


def test_a_hundred_thousand_alike_rows_are_dealt_in_pieces(spark):
    df = _alike(spark, 100_000)
    pieces = M._laid_pieces(df.select(*M._slim("doc_id", "text", "source")), weight_by_place, 64, 1 << 14, 3, "mix-1").collect()
    hot = [p for p in pieces if p.source == "hot"]
    assert sum(p["rows"] for p in hot) == 100_000 and max(p["rows"] for p in hot) == M.PIECE_ROWS
    assert len({p.shard for p in hot}) > 10
    out = M.mix(df, weight_by_place, shard_words=1 << 14)
    sums = out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= M.BLOCK_WORDS for r in sums)


def test_numbers_of_alike_rows_are_one_to_one(spark):
    df = _alike(spark, 1000).withColumn("number", F.monotonically_increasing_id()).checkpoint()
    rows = M._numbered(df.select("number", *M._slim("doc_id", "text", "source")), "number").collect()
    hot = sorted(r.nth for r in rows if r.doc_id is None)
    assert hot == list(range(1000)) and len(rows) == 1400
    assert all(r.nth == 0 for r in rows if r.doc_id is not None)


def test_a_full_source_is_taken_exactly_three_times(spark):
    df = _alike(spark, 50)
    got = M.mix(df, lambda place, name: 1000.0 if name == "hot" else 1.0, shard_words=64).where("source = 'hot'").collect()
    assert all(r.taken == 3 * r["size"] for r in got) and got[0].target == 3 * got[0].source_size


def test_many_sources_need_no_broadcast(spark, monkeypatch):
    df = spark.range(300).selectExpr("id AS doc_id", "concat('text of ', id, ' here') AS text", "concat('s', id % 90) AS source")
    before = sorted(map(tuple, M.mix(df, weight_by_place).collect()))
    monkeypatch.setattr(M, "BROADCAST_SOURCES", 10)
    assert sorted(map(tuple, M.mix(df, weight_by_place).collect())) == before

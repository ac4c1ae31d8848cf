"""Similarity join and leaders: both candidate methods, chains, dense and sparse data, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenlake.operators import screen as SC
from screenlake.operators import similarity as SIM


def table(spark, bits, ids=None):
    ids = range(len(bits)) if ids is None else ids
    return spark.createDataFrame([(int(i), [int(x) for x in b]) for i, b in zip(ids, bits)], "row_id long, bits array<int>")


def similarities(bits):
    inter = bits @ bits.T
    pop = bits.sum(1)
    union = pop[:, None] + pop[None, :] - inter
    return np.where(union > 0, inter / np.maximum(union, 1), 0.0)


def true_pairs(bits, t):
    sim = similarities(bits)
    return {(i, j) for i in range(len(bits)) for j in range(i + 1, len(bits)) if sim[i, j] >= t - 1e-9}


def scan(bits, t):
    sim, leaders = similarities(bits), []
    for i in range(len(bits)):
        if not any(sim[i, j] >= t - 1e-9 for j in leaders):
            leaders.append(i)
    return leaders


def half_full(n, width=64, seed=1):
    return np.random.default_rng(seed).integers(0, 2, (n, width))


def sparse(n, width=300, seed=2):
    rng = np.random.default_rng(seed)
    out = (rng.random((n, width)) < 0.04).astype(int)
    for i in range(0, n - 1, 3):                       # near copies
        out[i + 1] = out[i]
        out[i + 1, rng.integers(0, width)] ^= 1
    out[-1] = 0
    return out


def forced(prep, t, parts):
    """A plan of the given method, whatever the estimate says."""
    stats = SIM.bit_stats(prep)
    plan = SIM.plan_join(stats, t)
    if not parts:
        return SIM.JoinPlan(t, plan.words, plan.most, plan.rank, ())
    width = len(plan.rank)
    k = min(width, max(parts, -(-width // 30)))
    cuts = [width * i // k for i in range(k + 1)]
    return SIM.JoinPlan(t, plan.words, plan.most, plan.rank, tuple((a, b - a) for a, b in zip(cuts, cuts[1:])))


@pytest.mark.parametrize("t", [0.4, 0.5, 0.8])
def test_prefix_and_parts_find_the_same_pairs(spark, t):
    bits = np.vstack([half_full(120), np.repeat(half_full(1, seed=9), 4, axis=0), np.zeros((1, 64), int), np.ones((1, 64), int)])
    prep = SIM.prepare(table(spark, bits), "row_id", "bits")
    want = true_pairs(bits, t)
    for parts in (0, 9, 13):
        got = [(r.id_l, r.id_r) for r in SIM.similarity_join(prep, prep, forced(prep, t, parts), self_join=True).collect()]
        assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("t", [0.6, 0.9])
def test_sparse_vectors_of_several_words(spark, t):
    bits = sparse(150)
    prep = SIM.prepare(table(spark, bits), "row_id", "bits")
    want = true_pairs(bits, t)
    assert {(r.id_l, r.id_r) for r in SIM.tanimoto_pairs(table(spark, bits), "row_id", "bits", t).collect()} == want
    got = SIM.similarity_join(prep, prep, forced(prep, t, 13), self_join=True).collect()
    assert {(r.id_l, r.id_r) for r in got} == want


def test_two_sides(spark):
    bits = half_full(160, seed=4)
    sim = similarities(bits)
    prep = SIM.prepare(table(spark, bits), "row_id", "bits")
    left, right = prep.filter("id < 40"), prep.filter("id >= 40")
    want = {(i, j) for i in range(40) for j in range(40, 160) if sim[i, j] >= 0.5 - 1e-9}
    for parts in (0, 9):
        got = [(r.id_l, r.id_r) for r in SIM.similarity_join(left, right, forced(prep, 0.5, parts)).collect()]
        assert len(got) == len(want) and set(got) == want


def test_candidates_of_half_full_vectors_are_fewer_than_all_pairs(spark):
    bits = half_full(600, seed=3)
    prep = SIM.prepare(table(spark, bits), "row_id", "bits")
    stats = SIM.bit_stats(prep)
    for t, share in ((0.5, 0.9), (0.7, 0.25), (0.8, 0.06)):
        plan = SIM.plan_join(stats, t)
        assert plan.parts                                 # the prefix join would meet nearly all pairs
        got = SIM.candidates(prep, prep, plan, self_join=True)
        pairs = got.select(F.least("id_l", "id_r"), F.greatest("id_l", "id_r"))
        n = got.count()
        assert n == pairs.distinct().count() < share * 600 * 599 / 2


def test_methods_follow_the_data(spark):
    stats = SIM.BitStats(100_000, 32, 40.0, 90, tuple([0.02] * 2048))
    assert not SIM.plan_join(stats, 0.8).parts
    assert SIM.plan_join(SIM.BitStats(100_000, 1, 32.0, 50, tuple([0.5] * 64)), 0.8).parts


def test_masks_and_thresholds():
    assert sorted(SIM._masks(5, 2)) == sorted(m for m in range(32) if m.bit_count() <= 2)
    for d in range(40):
        for k in range(1, 12):
            assert sum(t + 1 for t in SIM._taus(d, k)) == d + 1


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    """Each row is near the next only; the scan alternates along the chain."""
    bits = np.zeros((200, 200 * 2 + 8), int)
    for i in range(200):
        bits[i, 2 * i:2 * i + 6] = 1
    assert len(true_pairs(bits, 0.5)) == 199
    rounds = []
    cut = SIM.cut_lineage
    monkeypatch.setattr(SIM, "cut_lineage", lambda df, *a: rounds.append(1) or cut(df, *a))
    got = SIM.leader_pick(table(spark, bits), "row_id", "bits", 0.5)
    assert [r.row_id for r in got.orderBy("cluster_id").collect()] == scan(bits, 0.5) == list(range(0, 200, 2))
    assert len(rounds) <= 9


@pytest.mark.parametrize("width", [7, 64, 4096])
def test_conflicts_are_settled_alike_in_any_ranges(spark, width):
    rng = np.random.default_rng(width)
    edges = {(min(a, b), max(a, b)) for a, b in rng.integers(0, 150, (220, 2)).tolist() if a != b}
    lost = set()
    for v in range(150):
        if any((u, v) in edges and u not in lost for u in range(v)):
            lost.add(v)
    df = spark.createDataFrame(sorted(edges), "id_l long, id_r long")
    got = [r.id for r in SIM._settled(df, width).collect()]
    assert set(got) == lost and len(got) == len(lost)


@pytest.mark.parametrize("distance, block", [(0.65, 16), (0.5, 32), (0.3, 4096)])
def test_leaders_in_growing_blocks(spark, distance, block):
    bits = np.vstack([half_full(150, seed=8), np.repeat(half_full(2, seed=5), 5, axis=0)])
    ids = np.arange(len(bits)) * 7 - 300
    got = SIM.leader_pick(table(spark, bits, ids).repartition(5), "row_id", "bits", distance, first_block=block)
    rows = got.orderBy("cluster_id").collect()
    assert [r.row_id for r in rows] == [int(ids[i]) for i in scan(bits, 1 - distance)]
    assert [r.cluster_id for r in rows] == list(range(len(rows)))


def test_no_rows_and_null_vectors(spark):
    none = spark.createDataFrame([(1, None), (2, None)], "row_id long, bits array<int>")
    assert SIM.tanimoto_pairs(none, "row_id", "bits", 0.5).collect() == []
    assert SIM.leader_pick(none, "row_id", "bits").collect() == []
    some = none.unionByName(table(spark, np.zeros((2, 64), int), [3, 4]))
    assert SIM.tanimoto_pairs(some, "row_id", "bits", 0.5).collect() == []
    assert sorted(r.row_id for r in SIM.leader_pick(some, "row_id", "bits").collect()) == [3, 4]


def test_many_leaders_are_joined_alike(spark, monkeypatch):
    """Beyond the table that goes to the tasks, pruning and assignment use the join."""
    bits = np.vstack([half_full(120, seed=11), np.repeat(half_full(2, seed=6), 4, axis=0)])
    df, out = table(spark, bits), []
    for few in (4096, 5):
        monkeypatch.setattr(SIM, "FEW", few)
        leaders = SIM.leader_pick(df, "row_id", "bits", 0.55, first_block=40)
        rows = SIM.assign_to_leaders(df, "row_id", "bits", leaders, 0.55).collect()
        out.append(sorted((r.row_id, r.cluster_id, round(r.similarity, 9)) for r in rows))
    assert out[0] == out[1] and len(out[0]) == len(bits)
    lead = scan(bits, 0.45)
    sim = similarities(bits)
    for row, cluster, similarity in out[0]:
        assert similarity == pytest.approx(1.0 if row in lead else sim[row, lead].max(), abs=1e-9)
        assert lead[cluster] == (row if row in lead else lead[int(sim[row, lead].argmax())])


def test_best_of_a_cluster_by_text_keys_and_first_present_values(spark):
    rows = [(1, "b", 0.9, None, 1), (1, "a", 0.9, None, None), (1, "c", 0.8, "x", 3), (2, "z", None, "y", 4), (None, "q", 0.1, "n", 5)]
    df = spark.createDataFrame(rows, "cluster long, key string, score double, name string, n int")
    got = {r.cluster: (r.key, r.score, r.name, r.n, r.members) for r in SC.best_per_cluster(df, "cluster", "score", "key", "members").collect()}
    assert got == {1: ("a", 0.9, None, None, 3), 2: ("z", None, "y", 4, 1), None: ("q", 0.1, "n", 5, 1)}
    got = {r.cluster: (r.key, r.score, r.name, r.n) for r in SC.best_per_cluster_first_nonnull(df, "cluster", "score", "key").collect()}
    assert got == {1: ("a", 0.9, "x", 1), 2: ("z", None, "y", 4), None: ("q", 0.1, "n", 5)}


def test_probes_of_a_vector_do_not_grow_with_the_table(spark):
    """They are what is shuffled; at 0.5 a table of 600,000 vectors had 3,021 of them for each."""
    for n in (2_000, 100_000, 600_000, 10 ** 8):
        plan = SIM.plan_join(SIM.BitStats(n, 1, 32.0, 48, tuple([0.5] * 64)), 0.5)
        taus = SIM._taus(SIM.differing_bits(0.5, 64), len(plan.parts))
        assert plan.parts and sum(SIM._within(w, t) for (_, w), t in zip(plan.parts, taus)) <= 256
    prep = SIM.prepare(table(spark, half_full(20)), "row_id", "bits")
    found = SIM.candidates(prep, prep, plan, self_join=True)
    assert "parts_l" not in found._jdf.queryExecution().analyzed().toString()


def test_probes_and_tokens_are_never_broadcast(spark):
    """After the vectors' own exchange a table of 120,000 looked small enough, and all its probes went through the driver."""
    bits = half_full(300, seed=12)
    prep = SIM.prepare(table(spark, bits), "row_id", "bits")
    for parts in (0, 8):
        plan = forced(prep, 0.5, parts)
        for found in (SIM.similarity_join(prep, prep, plan, self_join=True), SIM.similarity_join(prep.filter("id < 9"), prep, plan)):
            run = found._jdf.queryExecution()
            assert "SortMergeJoin" in run.executedPlan().toString()
            n = run.executedPlan().executeCollect()
            assert len(list(n)) and "Broadcast" not in run.executedPlan().toString()

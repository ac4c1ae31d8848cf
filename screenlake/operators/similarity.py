"""Tanimoto similarity join, leader (sphere-exclusion) clustering, nearest-leader assignment.

Similarity join (exact; each pair is verified once).  Two ways to candidates, both equi-joins; ``plan_join`` takes the one
for which bit frequencies predict fewer rows, and the pairs found are the same:

  prefix (sparse vectors; Bayardo et al. 2007, Xiao et al. 2008).  Bits are ordered rarest first; a vector with L set bits
  only needs its first L - ceil(t * L) + 1 (its prefix) for any partner with Tanimoto >= t to share one.  A pair counts at
  its first shared bit alone, and only if the places of that bit leave room for the overlap it needs.

  parts (half-full vectors, where every pair shares a prefix bit; Norouzi et al. 2012, Qin et al. 2018).  A pair with
  Tanimoto >= t differs in at most D = (1 - t) / (1 + t) * (|a| + |b|) bits.  The bits are cut into parts; thresholds tau with
  sum(tau + 1) = D + 1 make one part differ in at most tau bits (pigeonhole), so the vector with more bits probes every
  value of a part within its tau, the other one its own value.  A pair counts at its first such part alone.

Both joins are always shuffled; hot bits and part values are spread by AQE's skew-join splitting.

Leader picking (a row is a leader unless an earlier leader is within the threshold) is the sequential scan's result:
  take a block of undecided rows, the first in id order (blocks double in size); join the block with itself; settle its
  conflict edges in ranges of ids, each scanned by one task in memory bounded by the range (see ``_settled``); prune the rest
  against the new leaders; checkpoint.  Dense data are pruned by few leaders before blocks grow, sparse data have few edges.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import pack_bits, tanimoto_from_counts
from ..session import cut_lineage

EPS = 1e-9
MOST_PROBES = 4096       # values of one part that a vector may probe
PROBES = 256             # values of all parts that the mean vector may probe: more save comparisons, but all of them are shuffled
FIRST_BLOCK = 512        # rows of the first block of leader picking; later ones double
RANGE = 4096             # rows of a range of conflict edges that one task scans
FEW = 4096               # leaders up to which rows are compared with a broadcast table of them
CELLS = 1 << 22          # comparisons of a batch held at a time


def check_threshold(threshold: float) -> None:
    """At threshold 0 pairs that share no bit count too, which no prefix join can find."""
    if not threshold > 0:
        raise ValueError(f"the similarity threshold must be above 0, got {threshold}")


def prepare(df: DataFrame, id_col: str, bits_col: str) -> DataFrame:
    """(id, set-bit positions, packed words, popcount) from a 0/1 (or count) vector.
    Rows without a vector (NULL: a failed row) have no similarity and are left out."""
    df = df.filter(F.col(bits_col).isNotNull())
    setbits = F.filter(F.transform(bits_col, lambda x, i: F.when(x > 0, i)), lambda b: b.isNotNull())
    return df.select(F.col(id_col).alias("id"),
                     setbits.alias("setbits"),
                     pack_bits(F.transform(bits_col, lambda x: F.when(x > 0, 1).otherwise(0))).alias("packed")) \
             .withColumn("pop", F.size("setbits"))


# ---- choosing a join -------------------------------------------------------------------

@dataclass(frozen=True)
class JoinPlan:
    """``rank`` of every bit, rarest first; ``parts`` as (first bit, bits), none for the prefix join."""

    threshold: float
    words: int
    most: int                          # set bits of the fullest vector
    rank: tuple[int, ...]
    parts: tuple[tuple[int, int], ...]


@dataclass(frozen=True)
class BitStats:
    """Rows, width in bits, mean and largest popcount, share of the rows that have each bit set (as many as bits)."""

    rows: int
    words: int
    mean: float
    most: int
    share: tuple[float, ...]


def bit_stats(prepared: DataFrame) -> BitStats:
    """Two aggregates; what comes back is bounded by the vector width."""
    n, words, mean, most = prepared.agg(F.count(F.lit(1)), F.max(F.size("packed")), F.avg("pop"), F.max("pop")).first()
    share = [0.0] * (64 * (words or 0))
    for bit, k in prepared.select(F.explode("setbits").alias("bit")).groupBy("bit").agg(F.count(F.lit(1))).collect():
        share[bit] = k / n
    return BitStats(n, words or 0, mean or 0.0, most or 0, tuple(share))


def differing_bits(threshold: float, pops: float) -> int:
    """Bits in which vectors of ``pops`` set bits together may differ at the threshold."""
    return int(math.floor((1 - threshold) / (1 + threshold) * pops + EPS))


def _within(width: int, tau: int) -> int:
    return sum(math.comb(width, k) for k in range(tau + 1))


def _share_within(mismatch: list[float], tau: int) -> float:
    """Chance of at most ``tau`` mismatches, bits taken as independent."""
    dist = [1.0] + [0.0] * tau
    for q in mismatch:
        dist = [d * (1 - q) + (dist[k - 1] * q if k else 0.0) for k, d in enumerate(dist)]
    return sum(dist) if tau >= 0 else 0.0


def _taus(differing: int, parts: int) -> list[int]:
    base, rest = divmod(differing + 1, parts)
    return [base - (i >= rest) for i in range(parts)]


def _prefix_rows(stats: BitStats, threshold: float) -> float:
    """Join rows a pair that the prefix join would make."""
    length = stats.mean - math.ceil(stats.mean * threshold - EPS) + 1
    before = spread = rows = 0.0
    for f in sorted(x for x in stats.share if x > 0):
        z = (length - 0.5 - before) / math.sqrt(spread) if spread > 0 else math.inf
        rows += (f * 0.5 * (1 + math.erf(z / math.sqrt(2)))) ** 2
        before, spread = before + f, spread + f * (1 - f)
    return rows


def plan_join(stats: BitStats, threshold: float, left: int | None = None, right: int | None = None) -> JoinPlan:
    """The cheaper join of ``left`` by ``right`` rows (a self-join of all rows where None) by its expected rows."""
    check_threshold(threshold)
    pairs = stats.rows ** 2 / 2 if left is None else left * right
    probing = stats.rows if left is None else left + right
    rank = [0] * len(stats.share)
    for r, bit in enumerate(sorted(range(len(rank)), key=lambda b: (stats.share[b], b))):
        rank[bit] = r
    width = len(rank)
    used = [i for i, f in enumerate(stats.share) if f > 0]
    width = used[-1] + 1 if used else 0
    d_mean, d_most = (differing_bits(threshold, 2 * p) for p in (stats.mean, stats.most))
    best = (pairs * _prefix_rows(stats, threshold) + probing * stats.mean * (1 - threshold), ())
    for k in range(1, min(width, d_mean + 1) + 1):
        size = -(-width // k)
        if size > 62 or _within(size, max(_taus(d_most, k))) > MOST_PROBES:
            continue
        cuts = [width * i // k for i in range(k + 1)]
        parts = tuple((a, b - a) for a, b in zip(cuts, cuts[1:]))
        taus = _taus(d_mean, k)
        rows = pairs * sum(_share_within([2 * f * (1 - f) for f in stats.share[a:a + w]], t) for (a, w), t in zip(parts, taus))
        probes = sum(_within(w, t) for (_, w), t in zip(parts, taus))
        if probes <= max(PROBES, k):
            best = min(best, (rows + probing * (k + probes), parts))
    return JoinPlan(threshold, stats.words, stats.most, tuple(rank), best[1])


# ---- joining ---------------------------------------------------------------------------

def _similarity(plan: JoinPlan) -> Column:
    """Tanimoto of a pair as a plain sum of bit_count terms (whole-stage codegen, no lambda)."""
    terms = [F.bit_count(F.get("packed_l", w).bitwiseAND(F.get("packed_r", w))) for w in map(F.lit, range(plan.words))]
    return tanimoto_from_counts(reduce(lambda a, b: a + b, terms, F.lit(0)), F.col("pop_l"), F.col("pop_r"))


def _sided(df: DataFrame, side: str, *more: Column) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{c}_{side}") for c in ("id", "packed", "pop")], *more)


def _shuffled(df: DataFrame) -> DataFrame:
    """For a join with tokens or probes: the planner takes exploded rows for as many as there were vectors, and so would
    broadcast hundreds of times what it allows, by way of the driver's memory."""
    return df.hint("merge")


def _prefixed(df: DataFrame, plan: JoinPlan, side: str) -> DataFrame:
    """A row for each prefix bit (``tok``, as rank) with its place in the rarest-first order (``at``)."""
    rank = F.expr("array(" + ", ".join(map(str, plan.rank)) + ")") if plan.rank else F.array().cast("array<int>")
    length = F.col("pop") - F.ceil(F.col("pop") * F.lit(plan.threshold) - F.lit(EPS)) + 1
    ranks = F.array_sort(F.transform("setbits", lambda b: F.get(rank, b)))
    cut = df.select("id", "packed", "pop", F.slice(ranks, 1, F.greatest(length.cast("int"), F.lit(0))).alias("prefix"))
    return _sided(cut, side, F.col("prefix").alias(f"prefix_{side}"), F.posexplode("prefix").alias(f"at_{side}", "tok"))


def _prefix_candidates(left: DataFrame, right: DataFrame, plan: JoinPlan, self_join: bool) -> DataFrame:
    t = plan.threshold
    lx, rx = _prefixed(left, plan, "l"), _prefixed(right, plan, "r")
    need = F.ceil((F.col("pop_l") + F.col("pop_r")) * F.lit(t / (1 + t)) - F.lit(EPS))
    room = F.least(F.col("pop_l") - F.col("at_l"), F.col("pop_r") - F.col("at_r"))
    fits = ((F.col("pop_r") >= F.col("pop_l") * t - EPS) & (F.col("pop_r") * t - EPS <= F.col("pop_l")) & (room >= need))
    if self_join:
        fits &= F.col("id_l") < F.col("id_r")
    # the array test is the dearer one: codegen filters come first
    shared = F.array_min(F.array_intersect("prefix_l", "prefix_r")) == F.col("tok")
    return lx.join(_shuffled(rx), "tok").filter(fits).filter(shared).select("id_l", "packed_l", "pop_l", "id_r", "packed_r", "pop_r")


def _part(word_at: Callable[[int], Column], first: int, width: int) -> Column:
    word, off = divmod(first, 64)
    c = F.shiftrightunsigned(word_at(word), off)
    if off + width > 64:
        c = c.bitwiseOR(F.shiftleft(word_at(word + 1), 64 - off))
    return c.bitwiseAND(F.lit((1 << width) - 1))


def _with_parts(df: DataFrame, plan: JoinPlan) -> DataFrame:
    return df.select("id", "packed", "pop", F.array(*[_part(lambda w: F.get("packed", F.lit(w)), *p) for p in plan.parts]).alias("parts"))


def _masks(width: int, tau: int) -> list[int]:
    """All values of ``width`` bits with at most ``tau`` set."""
    out, last = [0], [(0, 0)]
    for _ in range(tau):
        last = [(m | 1 << b, b + 1) for m, start in last for b in range(start, width)]
        out += [m for m, _ in last]
    return out


def _part_candidates(probe: DataFrame, index: DataFrame, plan: JoinPlan, smaller: Column) -> DataFrame:
    """Pairs of a probe (``_l``) and an indexed vector (``_r``) for which ``smaller`` holds (no more set bits on the right)."""
    k, t = len(plan.parts), plan.threshold
    size = max(w for _, w in plan.parts)
    lists = [_masks(size, tau) for tau in range(max(_taus(differing_bits(t, 2 * plan.most), k)) + 1)]
    masks = F.expr("array(" + ", ".join("array(" + ", ".join(f"{m}L" for m in ms) + ")" for ms in lists) + ")")
    most = F.floor(F.col("pop") * F.lit(2 * (1 - t) / (1 + t)) + EPS).cast("int") + 1
    # a few rows become very many: deal them out before
    spread = probe.repartition(int(probe.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    lx = (_with_parts(spread, plan).withColumns({"base": F.floor(most / k).cast("int"), "rest": F.pmod(most, F.lit(k))})
          .select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("part"))
          .withColumn("tau", F.col("base") - (F.col("part") >= F.col("rest")).cast("int")).filter("tau >= 0")
          .select("*", F.explode(F.get(masks, F.col("tau"))).alias("mask")))
    # parts are taken from the words again after the join: probes are many, and would carry them all through the shuffle
    lx = _sided(lx, "l", "base", "rest", "part", F.get("parts", F.col("part")).bitwiseXOR(F.col("mask")).alias("value"))
    rx = _sided(_with_parts(index, plan), "r", F.posexplode("parts").alias("part", "value"))

    def differ(w: int) -> Column:
        return F.get("packed_l", F.lit(w)).bitwiseXOR(F.get("packed_r", F.lit(w)))

    first = reduce(lambda later, i: F.when(
        F.bit_count(_part(differ, *plan.parts[i])) <= F.col("base") - (F.col("rest") <= i).cast("int"), i).otherwise(later), reversed(range(k)), F.lit(k))
    fits = smaller & (F.col("pop_r") >= F.col("pop_l") * t - EPS)
    return (lx.join(_shuffled(rx), ["part", "value"]).filter(fits & (first == F.col("part")))
            .select("id_l", "packed_l", "pop_l", "id_r", "packed_r", "pop_r"))


def candidates(left: DataFrame, right: DataFrame, plan: JoinPlan, self_join: bool = False) -> DataFrame:
    """Pairs to verify, each once; of a self-join in one of the two orders."""
    if not plan.parts:
        return _prefix_candidates(left, right, plan, self_join)
    fewer = F.col("pop_r") < F.col("pop_l")
    if self_join:
        before = (F.col("pop_r") == F.col("pop_l")) & (F.col("id_r") < F.col("id_l"))
        return _part_candidates(left, right, plan, fewer | before)
    turned = _part_candidates(right, left, plan, fewer)
    return _part_candidates(left, right, plan, F.col("pop_r") <= F.col("pop_l")).unionByName(
        turned.select(*[F.col(f"{c}_{b}").alias(f"{c}_{a}") for a, b in ("lr", "rl") for c in ("id", "packed", "pop")]))


def similarity_join(left: DataFrame, right: DataFrame, plan: JoinPlan, self_join: bool = False) -> DataFrame:
    """All pairs (id_l, id_r, similarity) of ``prepare``d rows with Tanimoto >= threshold (id_l < id_r when ``self_join``)."""
    found = candidates(left, right, plan, self_join).select("id_l", "id_r", _similarity(plan).alias("similarity")) \
        .filter(F.col("similarity") >= plan.threshold - EPS)
    if self_join:
        found = found.select(F.least("id_l", "id_r").alias("id_l"), F.greatest("id_l", "id_r").alias("id_r"), "similarity")
    return found


def tanimoto_pairs(df: DataFrame, id_col: str, bits_col: str, threshold: float) -> DataFrame:
    prep = prepare(df, id_col, bits_col)
    return similarity_join(prep, prep, plan_join(bit_stats(prep), threshold), self_join=True)


# ---- leader picking -------------------------------------------------------------------

def id_rank(df: DataFrame, id_col: str) -> DataFrame:
    """Adds ``rank``, the 0-based place of each row in the order of ``id_col`` (any orderable
    type): range partitions, their counts (one row per partition) and a local row number."""
    placed = cut_lineage(df.repartitionByRange(id_col).withColumn("_p", F.spark_partition_id()))
    counts = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.row_number().over(Window.partitionBy("_p").orderBy(id_col))
    return placed.join(offsets, "_p").withColumn("rank", F.col("_off") + local - 1).drop("_p", "_off")


def _scan_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v), u < v, sorted by range and v, with (u, u) for every node of the range: decides, in the order of v, each
    node whose earlier neighbours in the range lead it to a decision and whose neighbours outside are of no matter."""
    state: dict[int, bool | None] = {}     # leads, doesn't, open; of one range
    here = node = None
    led = unsure = False
    out: list[tuple[int, bool]] = []

    def close() -> None:
        if node is not None:
            state[node] = False if led else None if unsure else True
            if state[node] is not None:
                out.append((node, state[node]))

    for batch in batches:
        for part, u, v in zip(*(c.to_pylist() for c in batch.columns)):
            if part != here or v != node:
                close()
                if part != here:
                    state, here = {}, part
                node, led, unsure = v, False, False
            if u != v:
                known = state.get(u)
                led, unsure = led or known is True, unsure or known is None
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in out], pa.int64()), pa.array([x for _, x in out])], ["node", "leads"])
            out.clear()
    close()
    yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in out], pa.int64()), pa.array([x for _, x in out], pa.bool_())], ["node", "leads"])


def _settled(edges: DataFrame, width: int = RANGE) -> DataFrame:
    """Of a conflict graph (id_l < id_r) the nodes that are no leaders, as ``id``.

    Ranges of ``width`` ids are scanned side by side, each by one task that holds a state for each id of its range; edges
    stream through.  A node with an open neighbour in an earlier range waits for the next round; the first range
    with edges is always decided, and a chain inside a range takes one round, whatever its length."""
    out = edges.select(F.col("id_r").alias("id")).limit(0)
    left = cut_lineage(edges.select("id_l", "id_r"))
    while not left.isEmpty():
        nodes = left.select("id_l").union(left.select("id_r")).distinct().select("id_l", F.col("id_l").alias("id_r"))
        span = F.floor(F.col("id_r") / width)
        decided = cut_lineage(left.unionByName(nodes).select(span.alias("part"), "id_l", "id_r").repartition("part")
                              .sortWithinPartitions("part", "id_r", "id_l").mapInArrow(_scan_range, "node long, leads boolean"))
        lead = decided.filter("leads").select(F.col("node").alias("id_l"))
        gone = cut_lineage(decided.filter("not leads").select(F.col("node").alias("id")).unionByName(
            left.join(lead, "id_l", "left_semi").select(F.col("id_r").alias("id"))).distinct())
        out = out.unionByName(gone)
        # a decided node's edges say no more: a leader's neighbours are gone, one that is gone stands in nobody's way
        over = gone.unionByName(lead.select(F.col("id_l").alias("id")))
        left = cut_lineage(left.join(over.select(F.col("id").alias("id_l")), "id_l", "left_anti")
                           .join(over.select(F.col("id").alias("id_r")), "id_r", "left_anti"))
    return out


class _Few:
    """A table of at most ``FEW`` rows (packed vectors in pick order), as matrices that go to the tasks."""

    def __init__(self, rows: list):
        self.packed = np.array([r["packed"] for r in rows], "int64").view("uint64")
        self.pop = np.array([r["pop"] for r in rows], "int64")

    def similarities(self, packed: pa.Array) -> Iterator[np.ndarray]:
        """Blocks of a batch's rows against all of the table."""
        own = packed.flatten().to_numpy(zero_copy_only=False).view("uint64").reshape(len(packed), -1)
        step = max(1, CELLS // max(1, len(self.pop)))
        for lo in range(0, len(own), step):
            part = own[lo:lo + step]
            inter = np.zeros((len(part), len(self.pop)), "int64")
            for w in range(own.shape[1]):
                inter += np.bitwise_count(part[:, w, None] & self.packed[None, :, w])
            union = np.bitwise_count(part).sum(1, dtype="int64")[:, None] + self.pop - inter
            yield np.where(union > 0, inter / np.maximum(union, 1), 0.0)

    @classmethod
    def of(cls, table: DataFrame, order: str) -> _Few | None:
        """None where the table has more rows than ``FEW``, or none."""
        rows = table.select("packed", "pop", order).orderBy(order).limit(FEW + 1).collect()
        return cls(rows) if 0 < len(rows) <= FEW else None


def _near_any(few: _Few, threshold: float):
    @F.arrow_udf("boolean")
    def near(packed: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([(s >= threshold - EPS).any(1) for s in few.similarities(packed)]))
    return near


def _nearest(rows: DataFrame, few: _Few) -> DataFrame:
    """``row_id, cluster_id, similarity``: the most similar of the table's rows, the first of equal ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [(s.argmax(1), s.max(1)) for s in few.similarities(batch.column(1))] if batch.num_rows else []
            if best:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.concatenate([a for a, _ in best]), pa.int64()),
                     pa.array(np.concatenate([m for _, m in best]))], ["row_id", "cluster_id", "similarity"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "packed").mapInArrow(run, f"row_id {kind}, cluster_id long, similarity double")


def _far_from(rest: DataFrame, leaders: DataFrame, stats: BitStats, threshold: float, left: int) -> DataFrame:
    """Rows without a leader at the threshold: compared in their own task with up to ``FEW`` leaders, joined with more."""
    few = _Few.of(leaders, "id")
    if few:
        return rest.filter(~_near_any(few, threshold)(F.col("packed")))
    near = similarity_join(leaders, rest, plan_join(stats, threshold, leaders.count(), left))
    return rest.join(near.select(F.col("id_r").alias("id")), "id", "left_anti")


def leader_pick(df: DataFrame, id_col: str, bits_col: str, max_distance: float = 0.65,
                first_block: int = FIRST_BLOCK) -> DataFrame:
    """Leaders in pick order with ``cluster_id`` (0-based).  A row joins an earlier leader
    when Tanimoto similarity >= 1 - max_distance; rows with a NULL vector take no part."""
    sim = 1.0 - max_distance
    check_threshold(sim)
    undecided = cut_lineage(id_rank(prepare(df, id_col, bits_col), "id").withColumnsRenamed({"id": "row_id", "rank": "id"}))
    stats = bit_stats(undecided)
    found, left, size = undecided.select("row_id", "id").limit(0), stats.rows, first_block
    while left:
        if left > size:
            # the size-th undecided id or a little beyond: exact enough, and every block is a prefix in id order
            cut = undecided.agg(F.percentile_approx("id", size / left, 10000)).first()[0]
            block, rest = undecided.filter(F.col("id") <= cut), undecided.filter(F.col("id") > cut)
        else:
            block, rest = undecided, None
        inside = min(size, left)
        plan = plan_join(stats, sim, inside, inside)
        losers = _settled(similarity_join(block, block, plan, self_join=True))
        leaders = cut_lineage(block.join(losers, "id", "left_anti"))
        found = found.unionByName(leaders.select("row_id", "id"))
        if rest is None:
            break
        undecided = cut_lineage(_far_from(rest, leaders, stats, sim, left))
        left, size = undecided.count(), 2 * size
    return id_rank(found, "id").select("row_id", F.col("rank").cast("long").alias("cluster_id"))


def assign_to_leaders(df: DataFrame, id_col: str, bits_col: str, leaders: DataFrame,
                      max_distance: float = 0.65) -> DataFrame:
    """Every row -> most similar leader (ties: earliest leader); leaders keep their own.
    With up to ``FEW`` leaders each row finds its own in its task.  With more, the threshold join does: every non-leader has a
    leader at similarity >= threshold (that is why it is not a leader), so its best one is among its partners."""
    sim = 1.0 - max_distance
    prep = prepare(df, id_col, bits_col)
    leaders = cut_lineage(leaders.select(F.col("row_id").alias("id"), "cluster_id"))
    table = prep.join(leaders, "id")
    few = _Few.of(table, "cluster_id")
    own = leaders.select(F.col("id").alias("row_id"), "cluster_id", F.lit(1.0).alias("similarity"))
    if few:
        # cluster ids count the leaders in pick order, the table's
        assigned = _nearest(prep, few).filter(F.col("similarity") >= sim - EPS)
    else:
        stats = bit_stats(prep)
        pairs = similarity_join(table.drop("cluster_id"), prep, plan_join(stats, sim, leaders.count(), stats.rows))
        best = pairs.join(leaders.withColumnRenamed("id", "id_l"), "id_l").groupBy(F.col("id_r").alias("row_id")).agg(
            F.max_by(F.struct("cluster_id", "similarity"),
                     F.struct(F.col("similarity"), -F.col("cluster_id"))).alias("b"))
        assigned = best.select("row_id", "b.cluster_id", "b.similarity")
    return assigned.join(own.select("row_id"), "row_id", "left_anti").unionByName(own)

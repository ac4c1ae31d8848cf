"""Similarity and clustering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import similarity as SIM
from . import fixtures as fx
from .catalog import register
from .fixture_sql import with_views

PAIR_THRESHOLD = 0.5
MAX_DISTANCE = 0.65          # reference default: similarity >= 0.35 joins a leader
LEADER_SIM = round(1 - MAX_DISTANCE, 12)

SIM_SQL = """(list_dot_product(CAST(a.bits AS DOUBLE[]), CAST(b.bits AS DOUBLE[]))
              / nullif(list_sum(a.bits) + list_sum(b.bits)
                       - list_dot_product(CAST(a.bits AS DOUBLE[]), CAST(b.bits AS DOUBLE[])), 0))"""


def leaders_sql(sim: float) -> list[tuple[str, str]]:
    """Sequential leader scan as a recursive CTE (oracle only)."""
    return [
        ("near", f"""SELECT a.row_id AS r, b.row_id AS earlier
                      FROM vectors a JOIN vectors b ON b.row_id < a.row_id
                      WHERE coalesce({SIM_SQL}, 0) >= {sim} - 1e-9"""),
        ("ord", """SELECT v.row_id, row_number() OVER (ORDER BY v.row_id) AS rn,
                          coalesce(n.nbrs, []::BIGINT[]) AS nbrs
                   FROM vectors v LEFT JOIN (SELECT r, list(earlier) AS nbrs FROM near GROUP BY r) n
                        ON n.r = v.row_id"""),
        ("scan", """SELECT 0::BIGINT AS rn, []::BIGINT[] AS leaders
                    UNION ALL
                    SELECT o.rn, CASE WHEN list_has_any(s.leaders, o.nbrs) THEN s.leaders
                                      ELSE list_append(s.leaders, o.row_id) END
                    FROM scan s JOIN ord o ON o.rn = s.rn + 1"""),
        ("leaders", """SELECT row_id, CAST(row_number() OVER (ORDER BY row_id) - 1 AS BIGINT) AS cluster_id
                       FROM (SELECT unnest(leaders) AS row_id FROM scan
                             WHERE rn = (SELECT max(rn) FROM ord))"""),
        ("assigned", f"""SELECT row_id, cluster_id, similarity FROM (
                           SELECT a.row_id, l.cluster_id, coalesce({SIM_SQL}, 0) AS similarity,
                                  row_number() OVER (PARTITION BY a.row_id
                                                     ORDER BY coalesce({SIM_SQL}, 0) DESC, l.cluster_id) AS k
                           FROM vectors a, leaders l JOIN vectors b ON b.row_id = l.row_id
                           WHERE a.row_id NOT IN (SELECT row_id FROM leaders))
                         WHERE k = 1
                         UNION ALL SELECT row_id, cluster_id, 1.0 FROM leaders"""),
    ]


def _with_recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@register("tanimoto_pairs", with_views(f"""
    SELECT a.row_id AS row_a, b.row_id AS row_b, round({SIM_SQL}, 6) AS similarity
    FROM vectors a JOIN vectors b ON a.row_id < b.row_id
    WHERE {SIM_SQL} >= {PAIR_THRESHOLD} - 1e-9""", "vectors"))
def q_tanimoto_pairs(spark, sf):
    pairs = SIM.tanimoto_pairs(fx.vectors(spark, sf), "row_id", "bits", PAIR_THRESHOLD)
    return pairs.select(F.col("id_l").alias("row_a"), F.col("id_r").alias("row_b"),
                        F.round("similarity", 6).alias("similarity"))


def _leaders(spark, sf):
    return SIM.leader_pick(fx.vectors(spark, sf), "row_id", "bits", MAX_DISTANCE)


@register("leader_pick", _with_recursive(with_views(
    "SELECT row_id, cluster_id FROM leaders", "vectors", extra=leaders_sql(LEADER_SIM)[:4])))
def q_leader_pick(spark, sf):
    return _leaders(spark, sf)


@register("assign_to_leaders", _with_recursive(with_views(
    "SELECT row_id, cluster_id, round(similarity, 6) AS similarity FROM assigned", "vectors",
    extra=leaders_sql(LEADER_SIM))))
def q_assign_to_leaders(spark, sf):
    v = fx.vectors(spark, sf)
    out = SIM.assign_to_leaders(v, "row_id", "bits", _leaders(spark, sf), MAX_DISTANCE)
    return out.select("row_id", "cluster_id", F.round("similarity", 6).alias("similarity"))


@register("cluster_sizes", _with_recursive(with_views(
    "SELECT cluster_id, count(*) AS n_members FROM assigned GROUP BY cluster_id", "vectors",
    extra=leaders_sql(LEADER_SIM))))
def q_cluster_sizes(spark, sf):
    v = fx.vectors(spark, sf)
    out = SIM.assign_to_leaders(v, "row_id", "bits", _leaders(spark, sf), MAX_DISTANCE)
    return out.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_members"))

"""Screening queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rules import rule_sql
from ..operators import ensemble as EN
from ..operators import fingerprint as FP
from ..functions import rules as RL
from ..operators import screen as SC
from ..operators import similarity as SIM
from ..sources.tables import read_table
from . import fixtures as fx
from .catalog import register
from .fixture_sql import with_views
from .similarity_queries import LEADER_SIM, MAX_DISTANCE, leaders_sql
from .vector_queries import _SPARSE_FP_SQL, N_BITS

FLAGS_SQL = ("flags", f"SELECT doc_id, {rule_sql()} FROM props")


def _flags(spark, sf):
    return SC.apply_rules(fx.props(spark, sf), "doc_id")


@register("rule_filters", with_views("SELECT * FROM flags", "props", extra=[FLAGS_SQL]))
def q_rule_filters(spark, sf):
    return _flags(spark, sf)


@register("rule_pass_all", with_views("""
    SELECT p.doc_id, CAST(p.quality AS DOUBLE) AS quality, p.n_chars FROM props p JOIN flags f USING (doc_id)
    WHERE f.pass_all_filters""", "props", extra=[FLAGS_SQL]))
def q_rule_pass_all(spark, sf):
    p = fx.props(spark, sf)
    flagged = p.select("doc_id", "quality", "n_chars", *RL.rule_columns())
    # nullable label emitted as double (NULL when unlabelled)
    return flagged.filter("pass_all_filters").select(
        "doc_id", F.col("quality").cast("double").alias("quality"), "n_chars")


# Property records under the reference's names: one for each order line, with exact bound values among them and, where
# the line was returned by accident of the flag A, no surface area.
_COMPOUNDS = {
    "molecular_weight": "CAST(l_quantity * 10 AS DOUBLE)", "logp": "CAST(round(l_discount * 100) AS DOUBLE) - 0.4",
    "h_bond_donor": "l_linenumber", "h_bond_acceptors": "CAST(l_quantity AS INTEGER) % 14", "rotatable_bonds": "CAST(l_suppkey % 13 AS INTEGER)",
    "num_atoms": "CAST(l_partkey % 90 AS INTEGER)", "molar_refractivity": "CAST(round(l_tax * 100) * 20 AS DOUBLE)",
    "topo_surface_area": "CASE WHEN l_returnflag <> 'A' THEN CAST(l_quantity * 5 AS DOUBLE) END",
}


@register("compound_rules", f"""
    SELECT row_id, {rule_sql(RL.COMPOUND_RULES)}
    FROM (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id,
                 {', '.join(f'{e} AS {n}' for n, e in _COMPOUNDS.items())} FROM lineitem)""")
def q_compound_rules(spark, sf):
    lines = read_table(spark, sf, "lineitem", [*fx.SCORED_KEY, "l_quantity", "l_discount", "l_tax", "l_returnflag"])
    row_id = F.concat_ws("-", *[F.col(c).cast("string") for c in fx.SCORED_KEY])
    props = lines.select(row_id.alias("row_id"), *[F.expr(e).alias(n) for n, e in _COMPOUNDS.items()])
    return SC.apply_rules(props, "row_id", RL.COMPOUND_RULES)


@register("join_flags", with_views("""
    SELECT p.doc_id, p.word_count, CAST(p.quality AS DOUBLE) AS quality, f.pass_all_filters
    FROM props p JOIN flags f USING (doc_id)""", "props", extra=[FLAGS_SQL]))
def q_join_flags(spark, sf):
    # two separately derived tables merged on the explicit key (not by row position)
    p = fx.props(spark, sf).select("doc_id", F.col("word_count").cast("bigint").alias("word_count"), F.col("quality").cast("double").alias("quality"))
    return p.join(_flags(spark, sf).select("doc_id", "pass_all_filters"), "doc_id")


@register("semi_join_nominees", with_views("""
    SELECT tok_id, count(*) AS n_set, CAST(sum(value) AS BIGINT) AS total
    FROM sparse_fp WHERE tok_id IN (SELECT 'd' || doc_id FROM flags WHERE pass_all_filters)
    GROUP BY tok_id""", "tokens", "props", extra=_SPARSE_FP_SQL + [FLAGS_SQL]))
def q_semi_join_nominees(spark, sf):
    nominees = _flags(spark, sf).filter("pass_all_filters").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("tok_id"))
    # only nominees' texts are fingerprinted
    kept = FP.sparse_fingerprint(fx.tokens(spark, sf).join(nominees, "tok_id", "left_semi"), "tok_id", "text", "ngram", 2, N_BITS)
    return kept.groupBy("tok_id").agg(F.count(F.lit(1)).alias("n_set"), F.sum("value").alias("total"))


# ---- vectors: score, cluster, keep the best per cluster ---------------------------------

AVG_SQL = ("avg_scores", "SELECT row_id, round(avg(y_proba), 8) AS average_yprob FROM multi_scored GROUP BY row_id")


def _clustered_scores(spark, sf):
    v = fx.vectors(spark, sf)
    leaders = SIM.leader_pick(v, "row_id", "bits", MAX_DISTANCE)
    clusters = SIM.assign_to_leaders(v, "row_id", "bits", leaders, MAX_DISTANCE).select("row_id", "cluster_id")
    avg = EN.ensemble(fx.multi_scored(spark, sf), ["row_id"]).select(
        "row_id", F.round("average_yprob", 8).alias("average_yprob"))
    return clusters.join(avg, "row_id")


def _best_sql(select: str) -> str:
    sql = with_views(f"""
    {select}""", "multi_scored", extra=leaders_sql(LEADER_SIM) + [AVG_SQL, ("best", """
        SELECT cluster_id, row_id, average_yprob FROM (
            SELECT a.cluster_id, a.row_id, s.average_yprob,
                   row_number() OVER (PARTITION BY a.cluster_id ORDER BY s.average_yprob DESC, a.row_id) AS k
            FROM assigned a JOIN avg_scores s USING (row_id)) WHERE k = 1""")])
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@register("best_per_cluster", _best_sql("SELECT cluster_id, row_id, average_yprob FROM best"))
def q_best_per_cluster(spark, sf):
    return SC.best_per_cluster(_clustered_scores(spark, sf), "cluster_id", "average_yprob", "row_id")


@register("screen_cluster_best", _best_sql("""
    SELECT b.cluster_id, b.row_id, b.average_yprob, c.n_members
    FROM best b JOIN (SELECT cluster_id, count(*) AS n_members FROM assigned GROUP BY cluster_id) c
         USING (cluster_id)"""))
def q_screen_cluster_best(spark, sf):
    return SC.best_per_cluster(_clustered_scores(spark, sf), "cluster_id", "average_yprob", "row_id", "n_members")


@register("screen_rank", with_views(
    "SELECT s.row_id, " + ", ".join(f"max(m.y_proba) FILTER (WHERE m.model_id = '{x}') AS model_{x}_yprob"
                                    for x in fx.MODELS)
    + ", round(avg(m.y_proba), 8) AS average_yprob FROM multi_scored m JOIN (SELECT DISTINCT row_id FROM "
      "multi_scored) s USING (row_id) GROUP BY s.row_id", "multi_scored"))
def q_screen_rank(spark, sf):
    ms = fx.multi_scored(spark, sf)
    wide = EN.scores_pivot(ms, "row_id", fx.MODELS)
    avg = EN.ensemble(ms, ["row_id"]).select("row_id", F.round("average_yprob", 8).alias("average_yprob"))
    return wide.join(avg, "row_id")

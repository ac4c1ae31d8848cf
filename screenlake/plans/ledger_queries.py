"""Ledger queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ledger as L
from ..operators.evaluation import METRIC_COLUMNS, evaluate, fold_means
from ..session import scratch_path, stored
from ..sources.tables import read_table
from . import fixtures as fx
from .catalog import register
from .fixture_sql import md5_bits_sql, with_views
from .metric_queries import CLUSTERED_SQL, KEYS, clustered, eval_select, rounded, unrounded

LEDGER_ID = ["model_path", "test_file_name", "run_time"]
METRICS = ["test_accuracy", "test_precision", "test_recall", "test_f1score", "test_totalhits_text",
           "test_missing_metric"]
LEDGER_COLS = ["model_type", "column_name", "model_path", "train_file", "test_file_name", "hyperparameters",
               "test_accuracy", "test_precision", "test_recall", "test_f1score", "test_totalhits_text",
               "cv_accuracy", "cv_precision", "cv_recall", "cv_f1", "status"]
_PART = ", ".join(LEDGER_COLS)
ORDER_SQL = ", ".join([*(f"{c} DESC NULLS LAST" for c in L.EVAL_COLUMNS),
                       *(f"{c} ASC NULLS LAST" for c in ("model_path", "test_file_name", "run_date", "run_time"))])

# The ledger with all metrics of its (model, test file): those of the file as test_*, the folds' means as cv_*.  The column
# names of some rows are those of fused columns, and one model never ran on one column.
_MORE = [m for m in METRIC_COLUMNS if m not in ("accuracy", "precision", "recall", "f1")]
_FULL = [*(f"test_{m}" for m in _MORE), *(f"cv_{m}" for m in _MORE), "cv_f1score"]
FULL_SQL = [CLUSTERED_SQL, ("folded", f"SELECT *, {md5_bits_sql('row_id')} % 2 AS fold FROM clustered"), ("full_ledger", f"""
    SELECT l.*, {', '.join(f'e.{m} AS test_{m}' for m in _MORE)}, {', '.join(f'c.{m} AS cv_{m}' for m in _MORE)}, l.cv_f1 AS cv_f1score
    FROM ledger l
    LEFT JOIN ({eval_select('clustered')}) e
      ON l.model_type = list_extract(['rf', 'lr', 'svc', 'nb', 'dt', 'knn', 'gb'], e.model_id) AND l.test_file_name = 'test_' || e.test_file || '.parquet'
    LEFT JOIN (SELECT model_id, test_file, {', '.join(f'round(avg({m}), 6) AS {m}' for m in _MORE)}
               FROM ({unrounded(eval_select('folded', 'model_id, test_file, fold'))}) GROUP BY model_id, test_file) c
      ON c.model_id = e.model_id AND c.test_file = e.test_file
    WHERE NOT (l.model_type = 'knn' AND l.column_name = 'MACCS')""")]


def _full_ledger(spark, sf):
    s = stored(fx.folded(clustered(spark, sf)), "predictions")   # read by every metric below
    led = fx.ledger(spark, sf, s)
    test = rounded(evaluate(s, KEYS)).select(*KEYS, *[F.col(m).alias(f"test_{m}") for m in _MORE])
    cv = rounded(fold_means(evaluate(s, KEYS + ["fold"]), KEYS)).select(*KEYS, *[f"cv_{m}" for m in _MORE])
    kind = F.element_at(F.array(*[F.lit(x) for x in fx.MODEL_TYPES]), F.col("model_id"))
    both = test.join(cv, KEYS).select(kind.alias("model_type"), F.concat(F.lit("test_"), "test_file", F.lit(".parquet")).alias("test_file_name"),
                                      *[f"test_{m}" for m in _MORE], *[f"cv_{m}" for m in _MORE])
    full = led.join(both, ["model_type", "test_file_name"], "left").withColumn("cv_f1score", F.col("cv_f1"))
    return full.filter(~((F.col("model_type") == "knn") & (F.col("column_name") == "MACCS"))).select(*led.columns, *_FULL)


def _ledger(spark, sf):
    return fx.ledger(spark, sf)


@register("ledger_append_union", with_views("""
    SELECT run_id, count(*) AS n_rows, count(fusion_method) AS n_fusion, count(status) AS n_status
    FROM (SELECT *, 1 AS run_id FROM ledger
          UNION ALL BY NAME
          SELECT * EXCLUDE (status), 'none' AS fusion_method, 2 AS run_id FROM ledger WHERE test_file_name = 'test_F.parquet')
    GROUP BY run_id""", "ledger"))
def q_ledger_append_union(spark, sf):
    led = _ledger(spark, sf)
    path = scratch_path(spark, "ledger")
    L.append_to_path(led.withColumn("run_id", F.lit(1)), path)
    second = (led.filter(F.col("test_file_name") == "test_F.parquet").drop("status")
              .withColumn("fusion_method", F.lit("none")).withColumn("run_id", F.lit(2))
              .withColumn("fused_columns", L.list_to_text(F.array(F.lit("ECFP4"), F.lit("MACCS")))))
    L.append_to_path(second, path)
    back = L.read_ledger(spark, path)
    return back.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                      F.count("fusion_method").alias("n_fusion"),
                                      F.count("status").alias("n_status"))


_TRAINED = ["model_type", "column_name", "model_path", "train_file", "hyperparameters", "cv_accuracy", "cv_precision", "cv_recall", "cv_f1"]


@register("ledger_test_rewrite", with_views(f"""
    SELECT t.*, 'test_' || f.test_file || '.parquet' AS test_file_name,
           {', '.join(f'CAST(e.{m} AS DOUBLE) AS test_{m}' for m in METRIC_COLUMNS)}, 3 AS ledger_version
    FROM (SELECT DISTINCT {', '.join(_TRAINED)} FROM ledger WHERE model_type <> '') t
    CROSS JOIN (SELECT DISTINCT test_file FROM scored) f
    LEFT JOIN ({eval_select('clustered')}) e
      ON e.test_file = f.test_file AND t.model_type = list_extract(['rf', 'lr', 'svc', 'nb', 'dt', 'knn', 'gb'], e.model_id)""",
    "ledger", extra=[CLUSTERED_SQL]))
def q_ledger_test_rewrite(spark, sf):
    """Version 1 holds the trained models, version 2 a row for each with every test file, version 3 has all test metrics beside
    the identity, configuration and cross-validation columns of these rows."""
    path = scratch_path(spark, "ledger")
    trained = fx.ledger(spark, sf).filter(F.col("model_type") != "").select(*_TRAINED).distinct()
    L.append_to_path(trained, path)
    files = fx.scored(spark, sf).select(F.concat(F.lit("test_"), "test_file", F.lit(".parquet")).alias("test_file_name"))
    cells = L.grid({"model_path": L.read_ledger(spark, path).select("model_path"), "test_file_name": files})
    L.replace_rows(spark, path, L.read_ledger(spark, path).join(cells, "model_path"))
    ev = rounded(evaluate(clustered(spark, sf), KEYS))
    kind = F.element_at(F.array(*[F.lit(x) for x in fx.MODEL_TYPES]), F.col("model_id"))
    tested = ev.select(kind.alias("model_type"), F.concat(F.lit("test_"), "test_file", F.lit(".parquet")).alias("test_file_name"),
                       *[F.col(m).cast("double").alias(f"test_{m}") for m in METRIC_COLUMNS])
    known = L.read_ledger(spark, path).select("model_type", "model_path", "test_file_name")
    L.upsert(spark, path, known.join(tested, ["model_type", "test_file_name"]).drop("model_type"), ["model_path", "test_file_name"])
    return L.read_ledger(spark, path).withColumn("ledger_version", F.lit(L.manifest(spark, path)["version"]))


@register("clean_blank_rows", with_views("""
    SELECT nullif(trim(model_path), '') AS model_path, nullif(trim(status), '') AS status,
           test_f1score, nullif(trim(run_time), '') AS run_time
    FROM ledger
    WHERE NOT (nullif(trim(model_path), '') IS NULL AND nullif(trim(status), '') IS NULL
               AND test_f1score IS NULL AND nullif(trim(run_time), '') IS NULL)""", "ledger"))
def q_clean_blank_rows(spark, sf):
    led = _ledger(spark, sf).select("model_path", "status", "test_f1score", "run_time")
    return L.blanks_to_null(led)


@register("metrics_unpivot", with_views("""
    SELECT model_path, test_file_name, run_time, metric, value FROM (
      SELECT model_path, test_file_name, run_time, metric, TRY_CAST(raw AS DOUBLE) AS value FROM (
        UNPIVOT (SELECT model_path, test_file_name, run_time,
                        CAST(test_accuracy AS VARCHAR) AS test_accuracy, CAST(test_precision AS VARCHAR) AS test_precision,
                        CAST(test_recall AS VARCHAR) AS test_recall, CAST(test_f1score AS VARCHAR) AS test_f1score,
                        test_totalhits_text FROM ledger)
        ON test_accuracy, test_precision, test_recall, test_f1score, test_totalhits_text
        INTO NAME metric VALUE raw))
    WHERE value IS NOT NULL""", "ledger"))
def q_metrics_unpivot(spark, sf):
    return L.metrics_long(_ledger(spark, sf), LEDGER_ID, METRICS)


@register("params_unpivot", with_views("""
    SELECT model_path, test_file_name, run_time, key, value, 'param' AS kind FROM (
      UNPIVOT (SELECT model_path, test_file_name, run_time, model_type AS model_type,
                      column_name AS column_name, train_file AS train_file FROM ledger)
      ON model_type, column_name, train_file INTO NAME key VALUE value)
    WHERE value IS NOT NULL
    UNION ALL
    SELECT model_path, test_file_name, run_time, 'status', coalesce(status, 'unknown'), 'tag' FROM ledger""",
    "ledger"))
def q_params_unpivot(spark, sf):
    # parameter names arrive in mixed case and are lower-cased on the way out
    led = _ledger(spark, sf).withColumnsRenamed(
        {"model_type": "Model_Type", "column_name": "Column_Name", "train_file": "Train_File"})
    return L.params_long(led, LEDGER_ID, ["Model_Type", "Column_Name", "Train_File"], ["status"])


@register("parse_param_map", """
    SELECT event_id, k AS param, json_extract_string(props, '$."' || k || '"') AS value
    FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""")
def q_parse_param_map(spark, sf):
    ev = L.parse_params(read_table(spark, sf, "events", ["event_id", "props"]), "props")
    return ev.select("event_id", F.explode("params").alias("param", "value"))


@register("derive_model_keys", with_views("""
    SELECT DISTINCT model_path, regexp_replace(model_path, '_model$', '') AS model_key,
           regexp_replace(regexp_replace(model_path, '_model$', ''), '^[^_]*_', '') AS column_key
    FROM (SELECT model_path FROM ledger
          UNION ALL SELECT replace(model_path, '_ECFP4_', '_ECFP4_MACCS_') FROM ledger) WHERE model_path <> ''""", "ledger"))
def q_derive_model_keys(spark, sf):
    # models of single columns, and of both columns fused
    led = _ledger(spark, sf).select("model_path")
    fused = led.select(F.replace("model_path", F.lit("_ECFP4_"), F.lit("_ECFP4_MACCS_")).alias("model_path"))
    return L.model_keys(led.unionByName(fused).filter(F.col("model_path") != "").distinct())


@register("experiment_grid", with_views("""
    SELECT t.train_file, m.model_type, c.column_name
    FROM (SELECT DISTINCT train_file FROM ledger WHERE train_file <> '') t,
         (SELECT DISTINCT model_type FROM ledger WHERE model_type <> '') m,
         (SELECT DISTINCT column_name FROM ledger WHERE column_name <> '') c""", "ledger"))
def q_experiment_grid(spark, sf):
    led = _ledger(spark, sf)
    dims = {c: led.filter(F.col(c) != "").select(c) for c in ("train_file", "model_type", "column_name")}
    return L.grid(dims)


@register("ledger_dedupe", with_views(f"""
    SELECT * EXCLUDE (k) FROM (
      SELECT *, row_number() OVER (PARTITION BY {_PART}
                                   ORDER BY run_date NULLS LAST, run_time NULLS LAST) AS k FROM ledger)
    WHERE k = 1""", "ledger"))
def q_ledger_dedupe(spark, sf):
    return L.dedupe(_ledger(spark, sf))


@register("rank_ledger", with_views(f"""
    SELECT model_path, test_file_name, run_time, row_number() OVER (ORDER BY {ORDER_SQL})
           AS rank FROM full_ledger""", "ledger", extra=FULL_SQL))
def q_rank_ledger(spark, sf):
    return L.rank_ledger(_full_ledger(spark, sf)).select("model_path", "test_file_name", "run_time", F.col("rank").cast("bigint"))


@register("best_row_per_model", with_views(f"""
    SELECT model_path, test_file_name, run_time, CAST(test_hits_at_200 AS DOUBLE) AS test_hits_at_200, test_f1score FROM (
      SELECT *, row_number() OVER (PARTITION BY model_path ORDER BY {ORDER_SQL}) AS k FROM full_ledger)
    WHERE k = 1""", "ledger", extra=FULL_SQL))
def q_best_row_per_model(spark, sf):
    return L.best_per_model(_full_ledger(spark, sf)).select("model_path", "test_file_name", "run_time", F.col("test_hits_at_200").cast("double"),
                                                           "test_f1score")


def _top_sql(k: int, select: str) -> str:
    part = ", ".join([*LEDGER_COLS, *_FULL])
    return with_views(select, "ledger", extra=[*FULL_SQL, ("dd", f"""
               SELECT * EXCLUDE (kk) FROM (
               SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY run_date NULLS LAST, run_time NULLS LAST) AS kk
               FROM full_ledger WHERE train_file IN ('train_F.parquet')) WHERE kk = 1"""), ("best", f"""
               SELECT * EXCLUDE (kk) FROM (
               SELECT *, row_number() OVER (PARTITION BY model_path ORDER BY {ORDER_SQL}) AS kk FROM dd)
               WHERE kk = 1"""), ("top", f"SELECT * FROM best ORDER BY {ORDER_SQL} LIMIT {k}")])


@register("select_top_models", _top_sql(3, "SELECT model_path, test_file_name, test_hits_at_200, test_f1score FROM top"))
def q_select_top_models(spark, sf):
    return L.select_top(_full_ledger(spark, sf), 3, train_files=["train_F.parquet"]).select(
        "model_path", "test_file_name", "test_hits_at_200", "test_f1score")


_MEANS_SQL = ", ".join(f"round(avg({m}), 6) AS {m}" for m in L.PLOTTED)


@register("metrics_by_model_feature", with_views(f"""
    SELECT model_type, column_name, {_MEANS_SQL}
    FROM full_ledger WHERE model_type <> '' GROUP BY model_type, column_name""", "ledger", extra=FULL_SQL))
def q_metrics_by_model_feature(spark, sf):
    return rounded(L.mean_metrics(_full_ledger(spark, sf).filter(F.col("model_type") != "")))


@register("metric_grid", with_views(f"""
    SELECT g.model_type, g.column_name, {', '.join(f'coalesce(a.{m}, 0.0) AS {m}' for m in L.PLOTTED)}
    FROM (SELECT * FROM (SELECT DISTINCT model_type FROM full_ledger WHERE model_type <> '') m0
          CROSS JOIN (SELECT DISTINCT column_name FROM full_ledger WHERE column_name <> '') c0) g
    LEFT JOIN (SELECT model_type, column_name, {_MEANS_SQL} FROM full_ledger
               WHERE model_type <> '' GROUP BY ALL) a USING (model_type, column_name)""", "ledger", extra=FULL_SQL))
def q_metric_grid(spark, sf):
    # knn never ran on MACCS: its cell has zeros
    return rounded(L.metric_grid(_full_ledger(spark, sf).filter(F.col("model_type") != "")))


@register("topk_metric_profile", _top_sql(3, f"""
    SELECT {', '.join(f'round(avg({c}), 6) AS {c}' for c in L.RADAR)} FROM top"""))
def q_topk_metric_profile(spark, sf):
    return rounded(L.radar_profile(L.select_top(_full_ledger(spark, sf), 3, train_files=["train_F.parquet"])))


@register("status_tally", with_views("""
    SELECT coalesce(nullif(trim(status), ''), 'skipped') AS outcome, count(*) AS n
    FROM ledger GROUP BY 1""", "ledger"))
def q_status_tally(spark, sf):
    # blank or missing status counts as skipped
    led = _ledger(spark, sf)
    outcome = F.coalesce(F.nullif(F.trim("status"), F.lit("")), F.lit("skipped"))
    return led.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))

"""Results-ledger operators: append with schema union, cleaning, long-form reshaping,
dedupe, multi-key ranking, best row per model, top-k selection, grids and tallies.

The ledger holds one row per experiment (model x feature column x test file), so it is
small by nature; still, every step is a plain DataFrame operation.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .prefix import global_rank

# The reference's configured ranking columns, its plotted means and its radar columns.
RANKING = ["hits_at_200", "hits_at_500", "precision_at_200", "precision_at_500", "total_hits", "f1score", "precision", "recall",
           "accuracy", "plate_ppv"]
EVAL_COLUMNS = [f"test_{m}" for m in RANKING]
CV_COLUMNS = [f"cv_{m}" for m in RANKING]
PLOTTED = [f"{part}_{m}" for part in ("cv", "test")
           for m in ("hits_at_500", "precision_at_200", "hits_at_200", "precision_at_500", "total_hits")]
RADAR = ["cv_f1score", "cv_precision", "cv_recall", "cv_accuracy", "cv_plate_ppv", "cv_diverse_plate_ppv"]
TIME_COLUMNS = ["run_date", "run_time"]


def append_union(ledger: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Union by column name; columns missing on either side become NULL."""
    return ledger.unionByName(new_rows, allowMissingColumns=True)


# A ledger on disk is a folder of Parquet folders and of manifests, one line of JSON each: version, schema, and the data folders
# that make it up.  Data are written first and the manifest last, into a folder that must not exist; so an interrupted write
# leaves the former version, of two writers of one version the second fails, and a reader opens one manifest
# and no Parquet footer for its schema.

def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The newest manifest (or that of ``version``); None before the first write."""
    try:
        lines = spark.read.option("recursiveFileLookup", True).text(f"{path}/manifests")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    own = lines.select(F.from_json("value", "version int").version.alias("version"), "value")
    own = own if version is None else own.filter(F.col("version") == version)
    newest = own.agg(F.max_by("value", "version")).first()[0]
    return json.loads(newest) if newest else None


def _union_schema(old: StructType, new: StructType) -> StructType:
    kinds = {f.name: f.dataType for f in old}
    for f in new:
        if kinds.setdefault(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} is {kinds[f.name].simpleString()} in the ledger, not {f.dataType.simpleString()}")
    return StructType([StructField(k, t, True) for k, t in kinds.items()])


def _write_version(rows: DataFrame, path: str, before: dict | None, keep: bool) -> int:
    spark, version = rows.sparkSession, (before["version"] if before else 0) + 1
    old = StructType.fromJson(before["schema"]) if before else StructType([])
    schema = _union_schema(old, rows.schema)
    part = f"data-{uuid.uuid4().hex}"
    rows.write.mode("errorifexists").parquet(f"{path}/{part}")
    line = json.dumps({"version": version, "schema": schema.jsonValue(), "parts": [*(before["parts"] if before and keep else []), part]})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("errorifexists").text(f"{path}/manifests/{version:08d}")
    return version


def append_to_path(new_rows: DataFrame, path: str) -> int:
    """The next version: all rows so far and the new ones, columns united by name."""
    return _write_version(new_rows, path, manifest(new_rows.sparkSession, path), keep=True)


def read_ledger(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Rows of a version; columns that a part lacks are NULL."""
    found = manifest(spark, path, version)
    if found is None:
        raise ValueError(f"no ledger version at {path}")
    return spark.read.schema(StructType.fromJson(found["schema"])).parquet(*[f"{path}/{p}" for p in found["parts"]])


def replace_rows(spark: SparkSession, path: str, rows: DataFrame) -> int:
    """The next version: these rows alone; columns known before stay in its schema."""
    return _write_version(rows, path, manifest(spark, path), keep=False)


def upsert(spark: SparkSession, path: str, rows: DataFrame, keys: list[str]) -> int:
    """The next version: columns of ``rows`` (unique by ``keys``) replace those of the ledger rows with their keys, other columns and
    other rows stay, rows with new keys are added.  NULL keys match NULL keys."""
    before = manifest(spark, path)
    if before is None:
        return _write_version(rows, path, None, keep=False)
    old = read_ledger(spark, path, before["version"])
    new = rows.select(*[F.col(c).alias(f"_new_{c}") for c in rows.columns], F.lit(True).alias("_is_new"))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    both = old.withColumn("_is_old", F.lit(True)).join(new, on, "full")
    is_new = F.col("_is_new").isNotNull()
    out = both.select(*[F.when(is_new, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in rows.columns else F.col(c) for c in old.columns],
                      *[F.col(f"_new_{c}").alias(c) for c in rows.columns if c not in old.columns])
    return _write_version(out, path, before, keep=False)


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Blank strings -> NULL; rows with every column NULL are dropped."""
    cols = [F.nullif(F.trim(F.col(c)), F.lit("")).alias(c) if t == "string" else F.col(c)
            for c, t in df.dtypes]
    return df.select(*cols).na.drop(how="all")


def metrics_long(df: DataFrame, id_cols: list[str], metric_cols: list[str]) -> DataFrame:
    """Listed metric columns that exist -> (ids..., metric, value); values that are NULL or
    not castable to double are skipped."""
    present = [c for c in metric_cols if c in df.columns]
    if not present:
        return df.select(*id_cols, F.lit(None).cast("string").alias("metric"),
                         F.lit(None).cast("double").alias("value")).limit(0)
    long = df.select(*id_cols, *[F.col(c).cast("string").alias(c) for c in present]).unpivot(
        id_cols, present, "metric", "raw")
    return long.select(*id_cols, "metric", F.col("raw").try_cast("double").alias("value")) \
               .filter(F.col("value").isNotNull())


def params_long(df: DataFrame, id_cols: list[str], param_cols: list[str],
                tag_cols: list[str] | None = None) -> DataFrame:
    """Parameters -> (ids..., key lower-cased, value as text), NULL values skipped; tags
    -> same with NULL replaced by 'unknown'."""
    p = df.select(*id_cols, *[F.col(c).cast("string").alias(c.lower()) for c in param_cols]).unpivot(
        id_cols, [c.lower() for c in param_cols], "key", "value").filter(F.col("value").isNotNull())
    p = p.withColumn("kind", F.lit("param"))
    if tag_cols:
        t = df.select(*id_cols, *[F.coalesce(F.col(c).cast("string"), F.lit("unknown")).alias(c.lower())
                                  for c in tag_cols]).unpivot(
            id_cols, [c.lower() for c in tag_cols], "key", "value").withColumn("kind", F.lit("tag"))
        p = p.unionByName(t)
    return p


def parse_params(df: DataFrame, text_col: str) -> DataFrame:
    """JSON object text -> map<string,string> (values kept as text)."""
    return df.withColumn("params", F.from_json(F.col(text_col), "map<string,string>"))


def model_keys(df: DataFrame, path_col: str = "model_path") -> DataFrame:
    """'<model>_<column>_model' -> model key (suffix stripped) and column key: what follows the first token, so that the name of
    fused columns ('rf_ECFP4_MACCS_model') stays whole."""
    key = F.regexp_replace(F.col(path_col), "_model$", "")
    return df.withColumn("model_key", key).withColumn(
        "column_key", F.when(F.instr(key, "_") > 0, F.regexp_replace(key, "^[^_]*_", "")).otherwise(key))


def grid(dims: dict[str, DataFrame]) -> DataFrame:
    """Cartesian product of small dimension lists (the experiment grid itself), built from
    each dimension's distinct values (bounded by the number of configured values)."""
    sets = [d.agg(F.array_sort(F.collect_set(name)).alias(name)) for name, d in dims.items()]
    row = reduce(lambda a, b: a.join(b, how="inner"), sets)  # one row each
    out = row
    for name in dims:
        out = out.withColumn(name, F.explode(name))
    return out


def dedupe(df: DataFrame, ignore: list[str] = TIME_COLUMNS) -> DataFrame:
    """Exact duplicates ignoring date/time columns; the earliest run is kept."""
    keys = [c for c in df.columns if c not in ignore]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*[F.col(c).asc_nulls_last() for c in ignore])
    return df.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def sort_columns(df: DataFrame, evaluation: list[str] = EVAL_COLUMNS, crossvalidation: list[str] = CV_COLUMNS) -> list[str]:
    """Evaluation columns if all exist, else CV columns if all exist, else none."""
    for wanted in (evaluation, crossvalidation):
        if wanted and all(c in df.columns for c in wanted):
            return wanted
    return []


TIEBREAK = ["model_path", "test_file_name", "run_date", "run_time"]


def order_exprs(df: DataFrame, columns: list[str] | None = None, tiebreak: list[str] = TIEBREAK):
    """Metric columns descending (nulls last; the configured ones by default), then a total order over the identity and
    run time, so duplicate runs with equal metrics resolve the same way every time."""
    wanted = sort_columns(df) if columns is None else columns
    return [F.col(c).desc_nulls_last() for c in wanted] + [F.col(c).asc_nulls_last() for c in tiebreak if c in df.columns]


def rank_ledger(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``rank`` (1 is best) of every row, without one task that holds them all."""
    return global_rank(df, order_exprs(df, columns))


def best_per_model(df: DataFrame, model_col: str = "model_path", columns: list[str] | None = None) -> DataFrame:
    w = Window.partitionBy(model_col).orderBy(*order_exprs(df, columns))
    return df.withColumn("_k", F.row_number().over(w)).filter("_k = 1").drop("_k")


def select_top(df: DataFrame, k: int, train_files: list[str] | None = None,
               test_files: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Optional file filters -> dedupe -> best row per model -> top k (k > available -> all)."""
    if train_files:
        df = df.filter(F.col("train_file").isin(train_files))
    if test_files:
        df = df.filter(F.col("test_file_name").isin(test_files))
    best = best_per_model(dedupe(df), columns=columns)
    return best.orderBy(*order_exprs(best, columns)).limit(k)


def mean_metrics(df: DataFrame, metrics: list[str] = PLOTTED, by: list[str] = ["model_type", "column_name"]) -> DataFrame:  # noqa: B006
    """Group means of the listed metrics; a null takes no part."""
    return df.groupBy(*by).agg(*[F.avg(F.col(m).cast("double")).alias(m) for m in metrics])


def metric_grid(df: DataFrame, metrics: list[str] = PLOTTED) -> DataFrame:
    """``mean_metrics`` for every model type with every column; a cell without runs, or without a value, has 0."""
    cells = grid({c: df.select(c) for c in ("model_type", "column_name")})
    return cells.join(mean_metrics(df, metrics), ["model_type", "column_name"], "left").select(
        "model_type", "column_name", *[F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in metrics])


def radar_profile(top: DataFrame, columns: list[str] = RADAR) -> DataFrame:
    """Means of the radar columns over the chosen models, named without a ``test_`` prefix; no row unless all exist."""
    if not all(c in top.columns for c in columns):
        return top.select(*[F.lit(None).cast("double").alias(c.removeprefix("test_")) for c in columns]).limit(0)
    return top.agg(*[F.avg(F.col(c).cast("double")).alias(c.removeprefix("test_")) for c in columns])


def list_to_text(c, sep: str = ","):
    """List-valued ledger fields are stored as comma-joined text (other values as text)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.concat_ws(sep, col)

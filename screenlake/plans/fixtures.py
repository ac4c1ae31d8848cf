"""Fixture views: how the driver tables stand in for the screening inputs.

Each view is defined twice, identically: here with the DataFrame API, and in
``fixture_sql.py`` as DuckDB SQL for the oracle.  All views derive from the given
tables, so their size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import md5_bits, md5_unit
from ..functions.vectors import binarize, format_text_vector
from ..sources.tables import read_table

SCORED_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train/test vectors: row_id, v (array<float>), bits (array<int>), y (label = 0 -> 1)."""
    emb = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    return emb.select(
        F.col("vec_id").alias("row_id"),
        F.col("embedding").alias("v"),
        binarize("embedding").alias("bits"),
        (F.col("label") == 0).cast("int").alias("y"),
    )


def text_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bits of ``vectors`` written as text, ', ' separated (the reference's on-disk form)."""
    return vectors(spark, sf_dir).select("row_id", format_text_vector("bits").alias("bits_text"), "y")


def _scored_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem",
                    SCORED_KEY + ["l_returnflag", "l_linestatus", "l_discount"])
    row_id = F.concat_ws("-", *[F.col(c).cast("string") for c in SCORED_KEY])
    return li.select(
        row_id.alias("row_id"),
        F.col("l_linenumber").alias("model_id"),
        F.col("l_linestatus").alias("test_file"),
        (F.col("l_returnflag") == "R").cast("int").alias("y_true"),
        "l_discount",
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long prediction table: one row per (row_id, model_id, test_file)."""
    base = _scored_base(spark, sf_dir)
    out = base.select("row_id", "model_id", "test_file", "y_true", md5_unit("row_id").alias("y_proba"))
    return out.withColumn("y_pred", (F.col("y_proba") > 0.5).cast("int"))


def folded(pred: DataFrame) -> DataFrame:
    """A prediction table with one of two folds for each row."""
    return pred.withColumn("fold", F.pmod(md5_bits("row_id"), F.lit(2)))


def scored_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``scored`` with few distinct scores (l_discount * 10), to exercise ties."""
    base = _scored_base(spark, sf_dir)
    out = base.select("row_id", "model_id", "test_file", "y_true",
                      (F.col("l_discount") * 10).alias("y_proba"))
    return out.withColumn("y_pred", (F.col("y_proba") > 0.5).cast("int"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String column to fingerprint: part names and whole document texts, one id space."""
    parts = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"]).select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("tok_id"),
        F.col("p_name").alias("text"))
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"]).select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("tok_id"), "text")
    return parts.unionByName(docs)


# ---- multi_scored: four closed-form scorers over ``vectors`` ---------------------------

MODELS = ["centroid", "gnb", "dot", "noise"]


def fit_class_stats(v: DataFrame) -> dict:
    """Per class and dimension: mean and population variance; prior of class 1.
    A fitted model sized by the vector width (2 x dims numbers), like an MLlib model."""
    ex = v.select("y", F.posexplode("v").alias("pos", "x"))
    st = ex.groupBy("y", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"),
                                    F.var_pop(F.col("x").cast("double")).alias("var"))
    rows = st.collect()  # 2 * dims rows
    dims = max(r["pos"] for r in rows) + 1
    out = {k: {"m": [0.0] * dims, "var": [0.0] * dims} for k in (0, 1)}
    for r in rows:
        out[r["y"]]["m"][r["pos"]] = r["m"]
        out[r["y"]]["var"][r["pos"]] = r["var"]
    out["p1"] = v.agg(F.avg(F.col("y").cast("double"))).first()[0]
    return out


def _sum_over(arr_fn, dims: int):
    return F.aggregate(F.sequence(F.lit(0), F.lit(dims - 1)), F.lit(0.0), lambda acc, i: acc + arr_fn(i))


def multi_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long prediction table (row_id, model_id, test_file, y_true, y_proba, y_pred) for four
    scorers; probabilities rounded to 6 places before thresholding."""
    v = vectors(spark, sf_dir)
    return score_with(v, fit_class_stats(v))


def score_with(v: DataFrame, st: dict, *more: str) -> DataFrame:
    """Predictions of the four scorers fitted as ``st``, with columns ``more`` of the vectors."""
    import math

    dims = len(st[0]["m"])
    lit_arr = lambda xs: F.array(*[F.lit(float(x)) for x in xs])
    m0, m1 = lit_arr(st[0]["m"]), lit_arr(st[1]["m"])
    v0 = lit_arr([x + 1e-9 for x in st[0]["var"]])
    v1 = lit_arr([x + 1e-9 for x in st[1]["var"]])
    x = lambda i: F.get(F.col("v"), i).cast("double")
    d0 = F.sqrt(_sum_over(lambda i: F.pow(x(i) - F.get(m0, i), 2), dims))
    d1 = F.sqrt(_sum_over(lambda i: F.pow(x(i) - F.get(m1, i), 2), dims))
    dot = _sum_over(lambda i: x(i) * (F.get(m1, i) - F.get(m0, i)), dims)
    ll = lambda m, var, prior: F.lit(math.log(prior)) + _sum_over(
        lambda i: F.lit(-0.5) * F.ln(F.lit(2 * math.pi) * F.get(var, i))
        - F.pow(x(i) - F.get(m, i), 2) / (F.lit(2.0) * F.get(var, i)), dims)
    p1 = st["p1"]
    l0, l1 = ll(m0, v0, 1 - p1), ll(m1, v1, p1)
    sig = lambda z: F.lit(1.0) / (F.lit(1.0) + F.exp(z))
    clamp = lambda z: F.least(F.greatest(z, F.lit(-700.0)), F.lit(700.0))
    scores = F.array(
        F.struct(F.lit("centroid").alias("model_id"), sig(d1 - d0).alias("p")),
        F.struct(F.lit("gnb").alias("model_id"), sig(clamp(l0 - l1)).alias("p")),
        F.struct(F.lit("dot").alias("model_id"), sig(F.lit(-10.0) * dot).alias("p")),
        F.struct(F.lit("noise").alias("model_id"),
                 md5_unit(F.concat(F.lit("noise|"), F.col("row_id").cast("string"))).alias("p")))
    long = v.select("row_id", *more, F.col("y").alias("y_true"), F.explode(scores).alias("s"))
    out = long.select("row_id", *more, "s.model_id", F.lit("embeddings").alias("test_file"), "y_true",
                      F.round("s.p", 6).alias("y_proba"))
    return out.withColumn("y_pred", (F.col("y_proba") > 0.5).cast("int"))


# Character classes of the property record (ASCII digits, ASCII upper case,
# and the whitespace characters of the regex class \s: space, \t, \n, \x0b, \f, \r).
DIGITS = "0123456789"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = " \t\n\x0b\f\r"


def props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-document property record (whole texts) + quality label (left join ``labels``)."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "n_chars"])
    labels = read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
    words = F.filter(F.split("text", r"\s+"), lambda t: t != "")
    chars = F.char_length("text")
    base = docs.select("doc_id", "n_chars", "text", words.alias("_w"), chars.alias("_c"))

    def share(num, den):
        return F.when(den > 0, num.cast("double") / den.cast("double"))

    def count_of(chars: str):
        # characters from a fixed set, counted with translate (no regex pass)
        return F.col("_c") - F.char_length(F.translate("text", chars, ""))

    wc = F.size("_w")
    out = base.select(
        "doc_id", "n_chars",
        wc.alias("word_count"),
        share(count_of(DIGITS), F.col("_c")).alias("digit_share"),
        share(F.size(F.array_distinct("_w")), wc).alias("distinct_share"),
        share(F.col("_c") - count_of(SPACES), wc).alias("mean_word_len"),
        (count_of("\n") + 1).alias("line_count"),
        share(count_of(UPPER), F.col("_c")).alias("upper_share"))
    return out.join(labels, "doc_id", "left")


# ---- ledger: one row per (model, test file) experiment, derived from ``scored`` -------

MODEL_TYPES = ["rf", "lr", "svc", "nb", "dt", "knn", "gb"]


def ledger(spark: SparkSession, sf_dir: str, predictions: DataFrame | None = None) -> DataFrame:
    """Results ledger: identity, hyperparameters (JSON text), Test_* and CV_* metrics,
    date/time text, status; plus duplicate runs, blank rows and missing values.  ``predictions``: ``folded`` rows that are
    computed already."""
    from ..operators.metrics import basic_metrics, confusion_counts

    s = folded(scored(spark, sf_dir)) if predictions is None else predictions
    keys = ["model_id", "test_file"]
    test = basic_metrics(confusion_counts(s, keys))
    folds = basic_metrics(confusion_counts(s, keys + ["fold"]))
    cv = folds.groupBy(*keys).agg(*[F.avg(m).alias(f"cv_{m}") for m in ("accuracy", "precision", "recall", "f1")])
    j = test.join(cv, keys)
    mtype = F.element_at(F.array(*[F.lit(x) for x in MODEL_TYPES]), F.col("model_id"))
    column = F.when(F.col("test_file") == "F", "ECFP4").otherwise("MACCS")
    mid = F.col("model_id")
    base = j.select(
        mtype.alias("model_type"), column.alias("column_name"),
        F.concat(mtype, F.lit("_"), column, F.lit("_model")).alias("model_path"),
        F.concat(F.lit("train_"), "test_file", F.lit(".parquet")).alias("train_file"),
        F.concat(F.lit("test_"), "test_file", F.lit(".parquet")).alias("test_file_name"),
        F.concat(F.lit('{"max_depth": '), mid.cast("string"), F.lit(', "n_estimators": '),
                 (mid * 10).cast("string"), F.lit("}")).alias("hyperparameters"),
        F.round("accuracy", 6).alias("test_accuracy"), F.round("precision", 6).alias("test_precision"),
        F.round("recall", 6).alias("test_recall"),
        F.when(mid != 3, F.round("f1", 6)).alias("test_f1score"),
        F.when(mid == 5, F.lit("n/a")).otherwise(F.col("tp").cast("string")).alias("test_totalhits_text"),
        *[F.round(f"cv_{m}", 6).alias(f"cv_{m}") for m in ("accuracy", "precision", "recall", "f1")],
        F.concat(F.lit("2024-01-0"), mid.cast("string")).alias("run_date"),
        F.lit("10:00:00").alias("run_time"),
        F.when(mid == 7, "skipped").when((mid == 6) & (F.col("test_file") == "O"), "failed")
         .when(mid == 4, F.lit(None)).otherwise("success").alias("status"),
        mid.alias("_mid"))
    dups = base.filter(F.col("_mid") <= 2).withColumn("run_time", F.lit("10:00:01"))
    strings = [c for c, t in base.dtypes if t == "string"]
    blanks = base.filter(F.col("_mid") == 1).select(
        *[(F.lit("") if c in strings else F.lit(None).cast(t)).alias(c) for c, t in base.dtypes])
    return base.unionByName(dups).unionByName(blanks).drop("_mid")

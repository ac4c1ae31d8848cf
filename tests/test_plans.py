"""Plan-shape checks: the scale properties the operators rely on."""

from screenlake.operators import metrics as M
from screenlake.operators import ranking as R
from screenlake.operators import similarity as SIM
from screenlake.operators import fingerprint as FP
from screenlake.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def explain(df) -> str:
    return df._jdf.queryExecution().toString()


def test_topk_uses_partial_window_group_limit(spark):
    df = R.hits_at_k(fx.scored(spark, SF), ["model_id", "test_file"])
    text = explain(df)
    assert "WindowGroupLimit" in text and "Partial" in text


def test_scored_scan_is_pruned(spark):
    import re
    text = explain(M.confusion_counts(fx.scored(spark, SF), ["model_id", "test_file"]))
    schemas = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    assert schemas, text
    for unused in ("l_quantity", "l_extendedprice", "l_tax", "l_shipdate", "l_discount"):
        assert all(unused not in s for s in schemas)


def test_similarity_join_is_an_equi_join(spark):
    df = SIM.tanimoto_pairs(fx.vectors(spark, SF), "row_id", "bits", 0.5)
    text = explain(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_vectors_from_strings_shuffle_nothing(spark):
    """(Before, tokens were counted in part and then shuffled by row.)"""
    src = fx.tokens(spark, SF)
    for mode in ("ngram", "class_ngram", "key_presence", "path4", "token_pairs"):
        assert "Exchange" not in plan(FP.sparse_fingerprint(src, "tok_id", "text", mode, 2))
    every = FP.fingerprints(src, "tok_id", "text", list(FP.KINDS))
    assert "Exchange" not in plan(every) and plan(every).count("MapInArrow") == 1
    assert "Exchange" not in plan(FP.with_vectors(src, "text"))

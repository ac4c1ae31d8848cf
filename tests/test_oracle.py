"""Spark vs DuckDB on the same tables (the driver's correctness gate).  A fast subset runs
by default; SCREENLAKE_ORACLE=all runs every key (several minutes)."""

import os

import pytest

import sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from harness import compare  # noqa: E402

FAST = ["confusion_counts", "hits_at_k", "auc_roc_ties", "plate_ppv", "balance_multi", "stratified_folds",
        "format_text_vector", "binarize_pack", "fp_key_presence", "rule_filters", "ensemble_vote",
        "status_tally", "select_top_models", "tanimoto_pairs"]


def _keys():
    import __spark_entry__ as E
    keys = sorted(E.oracle_sql())
    return keys if os.environ.get("SCREENLAKE_ORACLE") == "all" else [k for k in FAST if k in keys]


@pytest.mark.parametrize("name", _keys())
def test_matches_oracle(spark, name):
    import __spark_entry__ as E
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name])
    assert r["ok"], r

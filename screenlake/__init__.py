"""screenlake: Spark-native screening analytics.

Subpackages
-----------
sources    readers and writers (parquet, CSV, multi-file, ledger append)
functions  Column factories: hashing, vector packing, Tanimoto, rules, safe maths
operators  DataFrame -> DataFrame operators (metrics, sampling, similarity, clustering, ...)
plans      fixture views, the query catalogue and its DuckDB oracle SQL
"""

__version__ = "0.1.0"

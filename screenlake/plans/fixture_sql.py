"""DuckDB SQL for the fixture views (see ``fixtures.py`` for the Spark side).

``with_views(sql, *names)`` prefixes a query with the CTEs it needs, in
dependency order.
"""

from __future__ import annotations


def md5_bits_sql(expr: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({expr} AS VARCHAR)), 1, 8)) AS BIGINT)"


def md5_unit_sql(expr: str) -> str:
    return f"(CAST({md5_bits_sql(expr)} AS DOUBLE) / 4294967296.0::DOUBLE)"


_ROW_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

_COUNTS = """SELECT {keys},
        count(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS tp,
        count(*) FILTER (WHERE y_true = 0 AND y_pred = 1) AS fp,
        count(*) FILTER (WHERE y_true = 0 AND y_pred = 0) AS tn,
        count(*) FILTER (WHERE y_true = 1 AND y_pred = 0) AS fn,
        count(*) AS n
      FROM {src} GROUP BY {keys}"""

_METRICS_NOROUND = """
    CASE WHEN n = 0 THEN 0.0 ELSE (tp + tn)::DOUBLE / n END AS accuracy,
    CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp) END AS precision,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fn) END AS recall,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END AS f1"""

VIEWS: dict[str, tuple[list[str], str]] = {
    "vectors": ([], """
        SELECT vec_id AS row_id, embedding AS v,
               [CAST(x > 0 AS INTEGER) FOR x IN embedding] AS bits,
               CAST(label = 0 AS INTEGER) AS y
        FROM embeddings"""),
    "text_vectors": (["vectors"], """
        SELECT row_id, array_to_string([CAST(b AS VARCHAR) FOR b IN bits], ', ') AS bits_text, y
        FROM vectors"""),
    "scored": ([], f"""
        SELECT row_id, model_id, test_file, y_true, y_proba,
               CAST(y_proba > 0.5 AS INTEGER) AS y_pred
        FROM (SELECT {_ROW_ID} AS row_id, l_linenumber AS model_id, l_linestatus AS test_file,
                     CAST(l_returnflag = 'R' AS INTEGER) AS y_true,
                     {md5_unit_sql(_ROW_ID)} AS y_proba
              FROM lineitem)"""),
    "scored_ties": ([], f"""
        SELECT row_id, model_id, test_file, y_true, y_proba,
               CAST(y_proba > 0.5 AS INTEGER) AS y_pred
        FROM (SELECT {_ROW_ID} AS row_id, l_linenumber AS model_id, l_linestatus AS test_file,
                     CAST(l_returnflag = 'R' AS INTEGER) AS y_true,
                     l_discount * 10 AS y_proba
              FROM lineitem)"""),
    "tokens": ([], """
        SELECT 'p' || p_partkey AS tok_id, p_name AS text FROM part
        UNION ALL
        SELECT 'd' || doc_id AS tok_id, text FROM documents"""),
    "ms_ex": (["vectors"], """
        SELECT row_id, y, CAST(unnest(v) AS DOUBLE) AS x, unnest(range(len(v))) AS pos FROM vectors"""),
    "ms_stats": (["ms_ex"], """
        SELECT pos, avg(x) FILTER (WHERE y = 0) AS m0, avg(x) FILTER (WHERE y = 1) AS m1,
               var_pop(x) FILTER (WHERE y = 0) + 1e-9 AS v0, var_pop(x) FILTER (WHERE y = 1) + 1e-9 AS v1
        FROM ms_ex GROUP BY pos"""),
    "ms_per": (["ms_ex", "ms_stats"], """
        SELECT e.row_id, any_value(e.y) AS y,
               sqrt(sum((x - m0) * (x - m0))) AS d0, sqrt(sum((x - m1) * (x - m1))) AS d1,
               sum(x * (m1 - m0)) AS dt,
               sum(-0.5 * ln(2 * pi() * v0) - (x - m0) * (x - m0) / (2.0 * v0)) AS l0,
               sum(-0.5 * ln(2 * pi() * v1) - (x - m1) * (x - m1) / (2.0 * v1)) AS l1
        FROM ms_ex e JOIN ms_stats s USING (pos) GROUP BY e.row_id"""),
    "multi_scored": (["ms_per", "vectors"], f"""
        SELECT row_id, model_id, 'embeddings' AS test_file, y AS y_true, y_proba,
               CAST(y_proba > 0.5 AS INTEGER) AS y_pred
        FROM (
          SELECT row_id, y, 'centroid' AS model_id, round(1.0 / (1.0 + exp(d1 - d0)), 6) AS y_proba FROM ms_per
          UNION ALL
          SELECT row_id, y, 'gnb', round(1.0 / (1.0 + exp(least(greatest(
                 (ln(1 - (SELECT avg(y) FROM vectors)) + l0) - (ln((SELECT avg(y) FROM vectors)) + l1),
                 -700.0), 700.0))), 6) FROM ms_per
          UNION ALL
          SELECT row_id, y, 'dot', round(1.0 / (1.0 + exp(-10.0 * dt)), 6) FROM ms_per
          UNION ALL
          SELECT row_id, y, 'noise', round({md5_unit_sql("'noise|' || row_id")}, 6) FROM ms_per)"""),
    "props": ([], """
        SELECT d.doc_id, d.n_chars, len(w) AS word_count,
               CASE WHEN c > 0 THEN length(regexp_replace(text, '[^0-9]', '', 'g'))::DOUBLE / c END AS digit_share,
               CASE WHEN len(w) > 0 THEN len(list_distinct(w))::DOUBLE / len(w) END AS distinct_share,
               CASE WHEN len(w) > 0 THEN length(regexp_replace(text, '[ \t\n\x0b\f\r]', '', 'g'))::DOUBLE / len(w) END
                    AS mean_word_len,
               len(string_split(text, chr(10))) AS line_count,
               CASE WHEN c > 0 THEN length(regexp_replace(text, '[^A-Z]', '', 'g'))::DOUBLE / c END AS upper_share,
               l.quality
        FROM (SELECT doc_id, n_chars, text, length(text) AS c,
                     [t FOR t IN string_split_regex(text, '\\s+') IF t <> ''] AS w FROM documents) d
        LEFT JOIN labels l USING (doc_id)"""),
    "ledger_base": (["scored"], f"""
        SELECT list_extract(['rf', 'lr', 'svc', 'nb', 'dt', 'knn', 'gb'], t.model_id) AS model_type,
               CASE WHEN t.test_file = 'F' THEN 'ECFP4' ELSE 'MACCS' END AS column_name,
               list_extract(['rf', 'lr', 'svc', 'nb', 'dt', 'knn', 'gb'], t.model_id) || '_'
                   || (CASE WHEN t.test_file = 'F' THEN 'ECFP4' ELSE 'MACCS' END) || '_model' AS model_path,
               'train_' || t.test_file || '.parquet' AS train_file,
               'test_' || t.test_file || '.parquet' AS test_file_name,
               '{{"max_depth": ' || t.model_id || ', "n_estimators": ' || (t.model_id * 10) || '}}' AS hyperparameters,
               round(t.accuracy, 6) AS test_accuracy, round(t.precision, 6) AS test_precision,
               round(t.recall, 6) AS test_recall,
               CASE WHEN t.model_id <> 3 THEN round(t.f1, 6) END AS test_f1score,
               CASE WHEN t.model_id = 5 THEN 'n/a' ELSE CAST(t.tp AS VARCHAR) END AS test_totalhits_text,
               round(c.cv_accuracy, 6) AS cv_accuracy, round(c.cv_precision, 6) AS cv_precision,
               round(c.cv_recall, 6) AS cv_recall, round(c.cv_f1, 6) AS cv_f1,
               '2024-01-0' || t.model_id AS run_date, '10:00:00' AS run_time,
               CASE WHEN t.model_id = 7 THEN 'skipped' WHEN t.model_id = 6 AND t.test_file = 'O' THEN 'failed'
                    WHEN t.model_id = 4 THEN NULL ELSE 'success' END AS status,
               t.model_id AS _mid
        FROM (SELECT *, {_METRICS_NOROUND} FROM ({_COUNTS.format(src='scored', keys='model_id, test_file')})) t
        JOIN (SELECT model_id, test_file, avg(accuracy) AS cv_accuracy, avg(precision) AS cv_precision,
                     avg(recall) AS cv_recall, avg(f1) AS cv_f1
              FROM (SELECT *, {_METRICS_NOROUND} FROM ({_COUNTS.format(
                  src='(SELECT *, ' + md5_bits_sql('row_id') + ' % 2 AS fold FROM scored)',
                  keys='model_id, test_file, fold')}))
              GROUP BY model_id, test_file) c USING (model_id, test_file)"""),
    "ledger": (["ledger_base"], """
        SELECT * EXCLUDE (_mid) FROM ledger_base
        UNION ALL
        SELECT * EXCLUDE (_mid) REPLACE ('10:00:01' AS run_time) FROM ledger_base WHERE _mid <= 2
        UNION ALL
        SELECT '', '', '', '', '', '', NULL, NULL, NULL, NULL, '', NULL, NULL, NULL, NULL, '', '', ''
        FROM ledger_base WHERE _mid = 1"""),
}


def _ordered(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for dep in VIEWS[n][0]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(sql: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``sql`` with fixture CTEs (and optional extra named CTEs after them)."""
    ctes = [(n, VIEWS[n][1]) for n in _ordered(names)] + list(extra or [])
    if not ctes:
        return sql
    body = ",\n".join(f"{n} AS ({q})" for n, q in ctes)
    return f"WITH {body}\n{sql}"

"""Vector and fingerprint queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.vectors import format_text_vector
from ..operators import fingerprint as FP
from ..operators import vectors as V
from ..sources.files import as_float_vector
from ..sources.tables import read_table
from . import fixtures as fx
from .catalog import register
from .fixture_sql import md5_bits_sql, with_views

N_BITS = 2048
_CLASS_SQL = f"translate(lower(text), '{FP.CLASS_FROM}', '{FP.CLASS_TO}')"


def _weighted_checksum(arr: str):
    """sum(x_i * i) with 1-based i: a position-sensitive checksum (exact for integers)."""
    return F.aggregate(F.sequence(F.lit(1), F.size(arr)), F.lit(0.0),
                       lambda acc, i: acc + F.get(F.col(arr), i - 1).cast("double") * i)


def _int_vectors(spark, sf):
    """Three integer vector columns derived from ``vectors`` (for fusion)."""
    v = fx.vectors(spark, sf)
    return v.select("row_id", "bits",
                    F.transform("v", lambda x: F.when(x > 0.1, 1).otherwise(0)).alias("hi"),
                    F.transform("v", lambda x: F.when(x < -0.1, 1).otherwise(0)).alias("lo"))


INT_VECTORS_SQL = ("int_vectors", """
    SELECT row_id, bits,
           [CAST(x > 0.1 AS INTEGER) FOR x IN v] AS hi,
           [CAST(x < -0.1 AS INTEGER) FOR x IN v] AS lo
    FROM vectors""")


@register("parse_text_vector", with_views("""
    SELECT row_id, len(p) AS width, CAST(list_sum(p) AS BIGINT) AS n_set,
           round(list_sum(list_transform(p, lambda x, i: x * i)), 6) AS checksum
    FROM (SELECT row_id, [TRY_CAST(trim(t) AS FLOAT) FOR t IN string_split(bits_text, ',')] AS p
          FROM text_vectors)""", "text_vectors"))
def q_parse_text_vector(spark, sf):
    df = as_float_vector(fx.text_vectors(spark, sf), "bits_text")
    return df.select("row_id", F.size("bits_text").cast("bigint").alias("width"),
                     F.aggregate("bits_text", F.lit(0.0), lambda a, x: a + x).cast("bigint").alias("n_set"),
                     F.round(_weighted_checksum("bits_text"), 6).alias("checksum"))


@register("format_text_vector", with_views("SELECT row_id, bits_text FROM text_vectors", "text_vectors"))
def q_format_text_vector(spark, sf):
    return fx.vectors(spark, sf).select("row_id", format_text_vector("bits").alias("bits_text"))


@register("expand_vector_long", with_views("""
    SELECT row_id, 'bits_' || (i - 1) AS feature, i - 1 AS pos, bits[i] AS value
    FROM (SELECT row_id, bits, unnest(range(1, len(bits) + 1)) AS i FROM vectors)""", "vectors"))
def q_expand_vector_long(spark, sf):
    return V.expand_long(fx.vectors(spark, sf), "row_id", "bits")


_FUSE_OUT_SQL = """SELECT row_id, fused_name, len(f) AS width,
       CAST(list_sum(list_transform(f, lambda x, i: x * i)) AS BIGINT) AS checksum FROM ({src})"""


@register("fuse_all", with_views(_FUSE_OUT_SQL.format(
    src="SELECT row_id, 'bits_hi_lo' AS fused_name, list_concat(list_concat(bits, hi), lo) AS f "
        "FROM int_vectors"), "vectors", extra=[INT_VECTORS_SQL]))
def q_fuse_all(spark, sf):
    df, names = V.fuse_columns(_int_vectors(spark, sf), ["bits", "hi", "lo"], "All")
    (name,) = names
    return df.select("row_id", F.lit(name).alias("fused_name"), F.size(name).cast("bigint").alias("width"),
                     _weighted_checksum(name).cast("bigint").alias("checksum"))


@register("fuse_pairwise", with_views(_FUSE_OUT_SQL.format(src="""
    SELECT row_id, 'bits_hi' AS fused_name, list_concat(bits, hi) AS f FROM int_vectors
    UNION ALL SELECT row_id, 'bits_lo', list_concat(bits, lo) FROM int_vectors
    UNION ALL SELECT row_id, 'hi_lo', list_concat(hi, lo) FROM int_vectors"""),
    "vectors", extra=[INT_VECTORS_SQL]))
def q_fuse_pairwise(spark, sf):
    df, names = V.fuse_columns(_int_vectors(spark, sf), ["bits", "hi", "lo"], "pairwise")
    # wide -> long: one stack() over the fused columns, no shuffle
    stacked = df.select("row_id", F.explode(F.array(*[
        F.struct(F.lit(n).alias("fused_name"), F.col(n).alias("f")) for n in names])).alias("s"))
    return stacked.select("row_id", "s.fused_name", F.size("s.f").cast("bigint").alias("width"),
                          _weighted_checksum("s.f").cast("bigint").alias("checksum"))


def _signed64(expr: str) -> str:
    return f"CAST(CASE WHEN {expr} >= 9223372036854775808 THEN {expr} - 18446744073709551616 ELSE {expr} END AS BIGINT)"


@register("binarize_pack", with_views(f"""
    SELECT row_id, {_signed64('w')} AS word0, CAST(list_sum(bits) AS INTEGER) AS popcount
    FROM (SELECT row_id, bits,
                 list_sum(list_transform(bits, lambda b, i: CAST(b AS HUGEINT) * (CAST(1 AS HUGEINT) << (i - 1))))
                 AS w FROM vectors)""", "vectors"))
def q_binarize_pack(spark, sf):
    df = V.binarize_pack(fx.vectors(spark, sf), "v")
    return df.select("row_id", F.get("packed", 0).alias("word0"), F.col("packed_popcount").alias("popcount"))


# ---- fingerprints over the ``tokens`` view (whole texts) ------------------------------

def _fp_summary(sparse):
    return sparse.groupBy("tok_id").agg(
        F.count(F.lit(1)).alias("n_set"), F.sum("value").alias("total"),
        F.sum(F.col("bit").cast("bigint") * F.col("value")).alias("checksum"))


def _units_sql(units: str, lookahead: int) -> list[tuple[str, str]]:
    """Oracle helper: one row per unit (character or word) with the next ``lookahead``
    units beside it (lead windows), so n-grams need no list comprehension."""
    leads = ", ".join(f"lead(u, {k}) OVER w AS u{k + 1}" for k in range(1, lookahead + 1))
    return [
        ("units", f"""
            SELECT tok_id, unnest(arr) AS u, unnest(range(1, len(arr) + 1)) AS pos
            FROM (SELECT tok_id, {units} AS arr FROM tokens
                  WHERE text IS NOT NULL AND length(trim(text)) > 0)"""),
        ("win", f"""SELECT tok_id, pos, u AS u1, {leads} FROM units
                    WINDOW w AS (PARTITION BY tok_id ORDER BY pos)"""),
    ]


def _ngram_tokens_sql(radius: int) -> str:
    parts = []
    for w in range(1, radius + 2):
        cat = " || ".join(f"u{k}" for k in range(1, w + 1))
        parts.append(f"SELECT tok_id, '{w}:' || {cat} AS tok FROM win WHERE u{w} IS NOT NULL")
    return " UNION ALL ".join(parts)


def _fp_summary_sql(units: str, lookahead: int, tokens_sql: str, binary: bool = False,
                    n_bits: int = N_BITS) -> str:
    value = "1" if binary else "count(*)"
    return with_views(f"""
        SELECT tok_id, count(*) AS n_set, CAST(sum(value) AS BIGINT) AS total,
               CAST(sum(bit * value) AS BIGINT) AS checksum
        FROM (SELECT tok_id, bit, {value} AS value FROM (
                SELECT tok_id, CAST({md5_bits_sql('tok')} % {n_bits} AS INTEGER) AS bit FROM toks)
              GROUP BY tok_id, bit)
        GROUP BY tok_id""", "tokens", extra=_units_sql(units, lookahead) + [("toks", tokens_sql)])


_WORDS = "[t FOR t IN string_split_regex(text, '\\s+') IF t <> '']"
_CHARS = "string_split(text, '')"
_CLASS_CHARS = f"string_split({_CLASS_SQL}, '')"
_PATH4 = "SELECT tok_id, u1 || ' ' || u2 || ' ' || u3 || ' ' || u4 AS tok FROM win WHERE u4 IS NOT NULL"
_PAIRS = " UNION ALL ".join(
    f"SELECT tok_id, least(u1, u{d + 1}) || '|' || greatest(u1, u{d + 1}) || '|{d}' AS tok "
    f"FROM win WHERE u{d + 1} IS NOT NULL" for d in (1, 2, 3))


def _fp_query(mode, radius=2, binary=False):
    def q(spark, sf):
        sparse = FP.sparse_fingerprint(fx.tokens(spark, sf), "tok_id", "text", mode, radius,
                                       N_BITS, binary)
        return _fp_summary(sparse)
    return q


register("fp_ngram_r2", _fp_summary_sql(_CHARS, 2, _ngram_tokens_sql(2)))(_fp_query("ngram", 2))
register("fp_ngram_r3", _fp_summary_sql(_CHARS, 3, _ngram_tokens_sql(3)))(_fp_query("ngram", 3))
register("fp_class_ngram", _fp_summary_sql(_CLASS_CHARS, 2, _ngram_tokens_sql(2)))(
    _fp_query("class_ngram", 2))
register("fp_path4", _fp_summary_sql(_WORDS, 3, _PATH4))(_fp_query("path4"))
register("fp_token_pairs", _fp_summary_sql(_WORDS, 3, _PAIRS, binary=True))(
    _fp_query("token_pairs", binary=True))

_KEYS_SQL = "[" + ", ".join("'" + k.replace("'", "''") + "'" for k in FP.PRESENCE_KEYS) + "]"


@register("fp_key_presence", with_views(f"""
    SELECT tok_id, count(*) AS n_set, count(*) AS total, CAST(sum(bit) AS BIGINT) AS checksum
    FROM (SELECT tok_id, unnest([i FOR i IN range(0, {len(FP.PRESENCE_KEYS)})
                                 IF instr(text, {_KEYS_SQL}[i + 1]) > 0]) AS bit
          FROM tokens WHERE text IS NOT NULL AND length(trim(text)) > 0)
    GROUP BY tok_id""", "tokens"))
def q_fp_key_presence(spark, sf):
    return _fp_summary(FP.sparse_fingerprint(fx.tokens(spark, sf), "tok_id", "text", "key_presence"))


_SPARSE_FP_SQL = _units_sql(_CHARS, 2) + [("toks", _ngram_tokens_sql(2)), ("sparse_fp", f"""
        SELECT tok_id, bit, count(*) AS value FROM (
            SELECT tok_id, CAST({md5_bits_sql('tok')} % {N_BITS} AS INTEGER) AS bit FROM toks)
        GROUP BY tok_id, bit""")]


@register("fp_dense", with_views(f"""
    SELECT tok_id, {N_BITS} AS width, count(*) AS n_set,
           CAST(sum(CAST(bit + 1 AS BIGINT) * value) AS BIGINT) AS checksum
    FROM sparse_fp GROUP BY tok_id""", "tokens", extra=_SPARSE_FP_SQL))
def q_fp_dense(spark, sf):
    dense = FP.dense_vectors(fx.tokens(spark, sf), "tok_id", "text", "ngram", 2, N_BITS)
    return dense.select("tok_id", F.size("fp").alias("width"),
                        F.size(F.filter("fp", lambda x: x > 0)).cast("bigint").alias("n_set"),
                        _weighted_checksum("fp").cast("bigint").alias("checksum"))


def _docs_with_fp(spark, sf):
    docs = read_table(spark, sf, "documents", ["doc_id", "text", "lang", "source"]).withColumn(
        "tok_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    return FP.with_vectors(docs, "text", "ngram", 2, N_BITS)


_DOC_FP_SQL = [("doc_fp", """
    SELECT tok_id, count(*) AS n_set FROM sparse_fp GROUP BY tok_id"""),
               ("docs", "SELECT doc_id, 'd' || doc_id AS tok_id, text, lang, source FROM documents")]


# Every seventh text is missing and every eleventh is blank.
_FAILING = "CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN '   ' ELSE text END"


@register("fp_invalid_rows", with_views(f"""
    SELECT doc_id, (text IS NOT NULL AND length(trim(text)) > 0) AS is_valid,
           CASE WHEN text IS NOT NULL AND length(trim(text)) > 0 THEN CAST({N_BITS} AS DOUBLE) END AS width,
           CASE WHEN text IS NOT NULL AND length(trim(text)) > 0 THEN CAST(f.total AS DOUBLE) END AS total
    FROM (SELECT doc_id, {_FAILING} AS text FROM documents) d
    LEFT JOIN (SELECT tok_id, sum(value) AS total FROM sparse_fp GROUP BY tok_id) f ON f.tok_id = 'd' || d.doc_id""",
    "tokens", extra=_SPARSE_FP_SQL))
def q_fp_invalid_rows(spark, sf):
    docs = read_table(spark, sf, "documents", ["doc_id", "text"]).withColumn("text", F.expr(_FAILING))
    df = FP.with_vectors(docs, "text", "ngram", 2, N_BITS)
    total = F.aggregate("fp", F.lit(0).cast("bigint"), lambda a, x: a + x).cast("double")
    return df.select("doc_id", "is_valid", F.when(F.col("fp").isNotNull(), F.size("fp").cast("double")).alias("width"), total.alias("total"))


@register("fp_attach", with_views("""
    SELECT d.doc_id, d.lang, d.source, coalesce(f.n_set, 0) AS n_set
    FROM docs d LEFT JOIN doc_fp f USING (tok_id)""", "tokens",
    extra=_SPARSE_FP_SQL + _DOC_FP_SQL))
def q_fp_attach(spark, sf):
    df = _docs_with_fp(spark, sf)
    return df.select("doc_id", "lang", "source",
                     F.when(F.col("fp").isNull(), F.lit(0)).otherwise(F.size(F.filter("fp", lambda x: x > 0))).cast("bigint")
                     .alias("n_set"))

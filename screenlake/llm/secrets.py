"""Secret spans, and multipart credential linking by an interval join.

Strong patterns report on their own: assignments, access keys and long hexadecimal strings.  Weak ones
(a login or key identifier, a token-like string, a service endpoint) are reported only where a complementary part
lies within ``scope`` code points: an identifier needs a secret, a secret an identifier or an endpoint,
an endpoint a secret.  Strong spans serve as parts as well; a weak part that lies wholly in a strong span is that span.
Parts that overlap are not linked, but for a secret in the user part (between :// and @) or in the query of an endpoint.

Matching parts are joined on (text digest, position cell); every part within a scope of a weak one lies in a
cell the weak one is listed under.  A cell holds few spans, since spans of a kind don't overlap, so the join stays linear in the text.
Equal texts are linked once.

Defined cases: null text counts as empty and has no span; rows with equal or null ids are reported separately, one row each;
empty tables give no row; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenlake.llm.tables import text_or_empty, whole_rows
from screenlake.session import cut_lineage

# kind, pattern, group whose length counts, least length, strings without which nothing can match (lower case)
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
STRONG = (
    ("assign", ASSIGN, 2, 6, ("passw", "secret", "token", "apikey", "api_key")),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, ("akia",)),
    ("hex", r"[0-9a-f]{24,}", 0, 24, ()),
)
WEAK = (
    ("id", r"""(?i)(?:access_?key(?:_?id)?|client_?id|account|username|user|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})""",
     0, 5, ("access", "client", "account", "user", "login")),
    ("key", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[0-9+/_-]*[A-Za-z])[A-Za-z0-9+/_-]{16,}={0,2}", 0, 16, ()),
    ("endpoint", r"""(?i)(?:https?|s3|jdbc:[a-z]+|amqp|redis|postgres(?:ql)?|mysql|mongodb)://[^\s"'<>]+""", 0, 8, ("://",)),
)
KINDS = tuple(k for k, *_ in STRONG + WEAK)
ROLE = {"assign": "key", "access": "id", "hex": "key", "id": "id", "key": "key", "endpoint": "endpoint"}
NEEDS = {"id": ("key",), "key": ("id", "endpoint"), "endpoint": ("key",)}
SCOPE = 200
_SPAN = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"
# scheme, user part with its @, host and path, query of an endpoint
_URL = r"^([^/]*:)(//(?:[^/?#]*@)?)([^?#]*)(\?[^#]*)?"


def _spans(text: Column, low: Column, kind: str, pattern: str, group: int, least: int, hints: tuple) -> Column:
    """Spans of the leftmost matches, each taken at full length; those with a too short group are dropped."""
    gaps = F.split(text, pattern, -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sized = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    rank = KINDS.index(kind)
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), F.arrays_zip(hits.alias("h"), sized.alias("g")),
                       lambda gap, x: F.struct(F.length(gap).cast("long").alias("gap"),
                                               F.length(x["h"]).cast("long").alias("len"),
                                               (F.length(x["g"]) >= least).alias("ok")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPAN).alias("found"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + x["len"]
        one = F.array(F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["ok"], F.concat(acc["found"], one.cast(_SPAN)))
                        .otherwise(acc["found"]).alias("found"))

    found = F.aggregate(steps, start, step, lambda acc: acc["found"])
    possible = text.rlike(pattern)
    if hints:
        some = low.contains(hints[0])
        for h in hints[1:]:
            some = some | low.contains(h)
        possible = some & possible
    return F.when(possible, found).otherwise(F.array().cast(_SPAN))


def _all(text: Column, low: Column, patterns: tuple) -> Column:
    return F.concat(*[_spans(text, low, *p) for p in patterns])


def _cells(start: Column, end: Column, scope: int) -> Column:
    return F.sequence(F.floor(start / scope), F.floor(end / scope))


def _role(kind: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, r in ROLE.items():
        out = F.when(kind == k, r).otherwise(out)
    return out


def _placed(text: Column, parts: Column) -> Column:
    """Parts with where secrets may stand in an endpoint: up to ``user`` (from ``begin`` on) and from ``query`` up to ``close``."""

    def place(p: Column) -> Column:
        url = F.substring(text, (p["start"] + 1).cast("int"), (p["end"] - p["start"]).cast("int"))
        size = [F.when(p["kind"] == "endpoint", F.length(F.regexp_extract(url, _URL, g))).cast("long") for g in (1, 2, 3, 4)]
        begin, query = p["start"] + size[0], p["start"] + size[0] + size[1] + size[2]
        return F.struct(p["start"].alias("start"), p["rank"].alias("rank"), p["kind"].alias("kind"), p["end"].alias("end"),
                        begin.alias("begin"), (begin + size[1] - 1).alias("user"), query.alias("query"), (query + size[3]).alias("close"))

    return F.transform(parts, place)


def _inside(key: str, point: str) -> Column:
    """Whether the span with column prefix ``key`` stands in the user part or query of the endpoint with prefix ``point``."""
    start, end = F.col(f"{key}start"), F.col(f"{key}end")
    return F.coalesce((start >= F.col(f"{point}begin")) & (end <= F.col(f"{point}user"))
                      | (start > F.col(f"{point}query")) & (end <= F.col(f"{point}close")), F.lit(False))


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """``digest, linked``: per text its weak spans with a complementary part in scope."""
    one = parts.where("digest is not null").dropDuplicates(["digest"])
    spans = one.select("digest", F.explode("parts").alias("p")).select(
        "digest", "p.*", _role(F.col("p.kind")).alias("role"))
    weak = (spans.where(F.col("kind").isin([k for k, *_ in WEAK]))
            .withColumn("cell", F.explode(_cells(F.col("start") - scope, F.col("end") + scope, scope))))
    other = (spans.select("digest", *[F.col(c).alias(f"o_{c}") for c in ("role", "start", "end", "begin", "user", "query", "close")])
             .withColumn("cell", F.explode(_cells(F.col("o_start"), F.col("o_end"), scope))))
    fits = F.lit(False)
    for role, needs in NEEDS.items():
        fits = fits | ((F.col("role") == role) & F.col("o_role").isin(list(needs)))
    apart = (F.col("o_start") >= F.col("end")) | (F.col("o_end") <= F.col("start"))
    near = (F.col("o_start") - F.col("end") <= scope) & (F.col("start") - F.col("o_end") <= scope)
    held = (F.col("role") == "key") & _inside("", "o_") | (F.col("o_role") == "key") & _inside("o_", "")
    pairs = weak.join(other, ["digest", "cell"]).where(fits & (apart | held) & near)
    found = pairs.select("digest", "start", "rank", "kind", "end").distinct()
    return found.groupBy("digest").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).cast(_SPAN).alias("linked"))


def _with_parts(docs: DataFrame) -> DataFrame:
    """Adds ``_base``, the strong spans, and for texts where a weak span has company ``_parts`` and ``_digest``."""
    text = text_or_empty(F.col("text"))
    low = F.lower(text)
    weak = F.filter("_weak", lambda w: ~F.exists("_base", lambda b: (b["start"] <= w["start"]) & (w["end"] <= b["end"])))
    several = (F.size("_weak") > 0) & (F.size("_weak") + F.size("_base") > 1)
    return (docs.withColumns({"_base": F.sort_array(_all(text, low, STRONG)), "_weak": _all(text, low, WEAK)})
            .withColumn("_weak", weak)
            .withColumns({"_parts": F.when(several, _placed(text, F.concat("_base", "_weak"))),
                          "_digest": F.when(several, F.sha2(text, 256))})
            .drop("_weak"))


def _with_spans(parted: DataFrame, linked: DataFrame) -> DataFrame:
    """Adds ``_spans``: strong spans with the linked weak ones; texts without any company skip the join."""
    alone = parted.where("_digest is null").withColumn("_spans", F.col("_base"))
    linked = linked.select(F.col("digest").alias("_of"), F.col("linked").alias("_linked"))
    rest = parted.where("_digest is not null").join(linked, F.col("_digest") == F.col("_of"), "left")
    rest = rest.withColumn("_spans", F.when(F.col("_linked").isNull(), F.col("_base"))
                           .otherwise(F.sort_array(F.concat("_base", "_linked")))).drop("_of", "_linked")
    return alone.unionByName(rest)


def _parts(parted: DataFrame) -> DataFrame:
    return parted.select(F.col("_digest").alias("digest"), F.col("_parts").alias("parts"))


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``doc_id, base, spans`` per row: strong spans, and strong with linked weak spans; a span is
    (start, rank, kind, end) in code points, ordered by start, then kind."""
    narrow = cut_lineage(_with_parts(docs.select("doc_id", "text")).drop("text"))
    return _with_spans(narrow, _linked(_parts(narrow), scope)).select(
        "doc_id", F.col("_base").alias("base"), F.col("_spans").alias("spans"))


def redact(docs: DataFrame, scope: int = SCOPE, mark: str = "[secret]") -> DataFrame:
    """``docs`` (all columns) with every span of its text replaced by ``mark``, overlapping ones by one; ``n_chars``, where present,
    follows the text.  Texts without a span, and null ones, stay as they are."""
    linked = _linked(cut_lineage(_parts(_with_parts(docs.select("text")).where("_digest is not null"))), scope)
    marked = _with_spans(_with_parts(whole_rows(docs).withColumn("text", F.col("row.text"))), linked)
    text = F.col("text")
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("_spans", begin, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"].cast("int") + 1, F.length(text))))
    new = F.when(F.size("_spans") > 0, done).otherwise(text)
    out = marked.select("row", "_spans", new.alias("text"))
    own = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        own["n_chars"] = F.when(F.size("_spans") > 0, length).otherwise(F.col("row.n_chars"))
    return out.select(*(own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def render(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

"""Chat formatting with a grammar round trip.

Grammar of a formatted conversation: ``turn*``, a turn being ``### role: text</turn>\\n``.  Inside role
and text the strings ``###`` and ``</turn>`` may not occur (in a role also ``:``), and a backslash must start one of
the escapes ``\\b`` (backslash), ``\\l`` (<), ``\\h`` (#), ``\\c`` (:).

Each turn is rendered as it is and parsed back; where the parser refuses it or gives other content, the turn's content is
escaped.  The whole conversation is parsed once more and compared with its source (``round_trip``).

Defined cases: null role or text count as empty; turns are ordered by (turn, role, text), nulls first, repeated
rows stay; a null conversation id is a conversation of its own; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenlake.llm.tables import text_or_empty

HEAD, MID, TAIL = "### ", ": ", "</turn>\n"
TURN = r"(?s)\A### ([^:]*): (.*)\z"
REFUSED = r"###|</turn>|\\(?![blhc])"


def escape(c: Column) -> Column:
    for plain, coded in (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c")):
        c = F.replace(c, F.lit(plain), F.lit(coded))
    return c


def unescape(c: Column) -> Column:
    """Every backslash starts a two-character code, so the code of the backslash itself is undone last."""
    for plain, coded in (("<", "\\l"), ("#", "\\h"), (":", "\\c"), ("\\", "\\b")):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def parse_turn(body: Column) -> Column:
    """struct(role, text) of one turn without its end mark; null where the grammar refuses it."""
    role, text = F.regexp_extract(body, TURN, 1), F.regexp_extract(body, TURN, 2)
    fits = body.rlike(TURN) & ~role.rlike(REFUSED) & ~text.rlike(REFUSED)
    return F.when(fits, F.struct(unescape(role).alias("role"), unescape(text).alias("text")))


def parse(formatted: Column) -> Column:
    """array<struct(role, text)>: the conversation read back."""
    bodies = F.split(formatted, "</turn>\n", -1)
    return F.transform(F.slice(bodies, F.lit(1), F.size(bodies) - 1), parse_turn)


def _render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), role, F.lit(MID), text, F.lit(TAIL))


def format_conversations(rows: DataFrame, train_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, turns, loss_spans, round_trip``: the text, the turns parsed from it, the
    code point spans [start, end) under the loss mask, and whether the parsed turns equal the source."""
    src = rows.select("conv_id", "turn", text_or_empty(F.col("role")).alias("role"),
                      text_or_empty(F.col("text")).alias("text"))
    body = F.concat(F.lit(HEAD), F.col("role"), F.lit(MID), F.col("text"))
    back = parse_turn(body)
    # the end mark closes the turn, so a body that holds it is refused by the grammar already
    same = F.coalesce((back["role"] == F.col("role")) & (back["text"] == F.col("text")), F.lit(False))
    plain = src.withColumn("_plain", same)
    shown = plain.withColumns({
        "_r": F.when(F.col("_plain"), F.col("role")).otherwise(escape(F.col("role"))),
        "_t": F.when(F.col("_plain"), F.col("text")).otherwise(escape(F.col("text")))})
    seg = shown.withColumn("_seg", _render(F.col("_r"), F.col("_t")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = seg.withColumns({
        "_n": F.row_number().over(order),
        "_end": F.sum(F.length("_seg")).over(order.rowsBetween(Window.unboundedPreceding, 0))})
    turn = F.struct("_n", "_seg", "_end", "role", "text", F.length("_t").alias("_len"))
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_turns"))
    tail = len(TAIL)
    out = whole.select(
        "conv_id",
        F.array_join(F.transform("_turns", lambda t: t["_seg"]), "").alias("formatted"),
        F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("_source"),
        F.transform(F.filter("_turns", lambda t: t["role"] == train_role),
                    lambda t: F.struct((t["_end"] - tail - t["_len"]).alias("start"),
                                       (t["_end"] - tail).alias("end"))).alias("loss_spans"))
    out = out.withColumn("turns", parse(F.col("formatted")))
    return out.select("conv_id", "formatted", "turns", "loss_spans",
                      (F.col("turns") == F.col("_source")).alias("round_trip"))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped, joined without anything between."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")))), "")

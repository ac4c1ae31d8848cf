"""Repair of conversation structure: the cheapest edits that give role initials ``(s?(ua)+)?``.

The grammar has four states (nothing yet, after s, after u, after a).  A row, with the insertions before it, is a four-by-four table of
costs and edit letters, and so is a run of rows: tables compose like matrices over (min, +).  Hirschberg's divide and conquer
(1975) finds the states between the rows: a forward cost vector over the first half and a backward one over the second meet in the
middle, the cheapest crossing (of these the one whose audit is least) is taken, and both halves recur; memory stays
linear.  Audits are compared without being held: beside its cost a vector keeps the rank of its least audit among
the four, which a step updates.  (Insertions belong to the row after them, so no audit of the same rows is the beginning of another.)

1. Equal rows are counted, not kept apart, and only a digest of role and text travels.  Range partitions of (conversation, turn, role,
   digest) are cut into blocks; a block of a conversation that may go on elsewhere is summed up to its table.
2. Conversations of several blocks find the states between their blocks from the tables; then every block recurs alone.
3. Texts are sorted by conversation once; a task reads them beside the audit and digests the repaired rows as they pass.

So a conversation of any length is spread over tasks; its audit (one cell of the result) and the digest of its repaired text, which can
only be taken in order, are all that one task does for it, in a stream.

Defined cases: null role or text is one space; turns rise with nulls first, equal turns by role and by the SHA-256 of role and text
(both as binary); null conversation ids are one conversation; a row keeps its role only if its first letter is s, u or a; an empty role
has no initial, so it is never kept; repeated rows are duplicates; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenlake.session import cut_lineage

BLANKS = "\t\n\x0b\x0c\r "
BLANK, DUPLICATE = 8, 9      # codes of rows that must go; below them: initial (s, u, a, other) + 4 if truncated
INITIALS = "sua"
BLOCK = 1 << 16              # rows of a block
DELETE, CHANGE, INSERT, CUT = 3, 2, 2, 1
BLOCKS = "conv_id long, part long, seq long, codes binary, costs array<int>, ranks array<int>"
Vector = tuple  # (cost, rank) or None for each state
LEGAL = {"su", "ua", "au"}


# ---- the four-state program ------------------------------------------------------------

def _tables() -> list[list[list[tuple[int, str] | None]]]:
    """By code: cost and letters from state to state, with the insertions before the row.  States: 0 start, 1 s, 2 u, 3 a."""
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    inserted = []
    for p in range(4):
        reach, q = {p: 0}, p
        for k in (1, 2):
            q = 3 if q == 2 else 2
            reach.setdefault(q, k)
        inserted.append(reach)
    tables = []
    for code in range(DUPLICATE + 1):
        table = [[None] * 4 for _ in range(4)]
        for p in range(4):
            for mid, k in inserted[p].items():
                edits = [(mid, DELETE, "D")]
                if code < BLANK:
                    cut = CUT if code & 4 else 0
                    initial = (INITIALS + "?")[code & 3]
                    edits += [(after[mid][initial], cut, "K")] if initial in after[mid] else []
                    edits += [(after[mid][c], CHANGE + cut, "R") for c in "ua" if c in after[mid]]
                for q, cost, letter in edits:
                    option = (INSERT * k + cost, "I" * k + letter)
                    if table[p][q] is None or option < table[p][q]:
                        table[p][q] = option
        tables.append(table)
    return tables


ROW_EDITS = _tables()
LETTERS = sorted({e[1] for t in ROW_EDITS for r in t for e in r if e})
ROW_TABLES = [[[e and (e[0], LETTERS.index(e[1])) for e in r] for r in t] for t in ROW_EDITS]
# what may follow the last row: nothing after start or a, an answer after u, a pair after s
ENDINGS = ("", "II", "I", "")
END = tuple((INSERT * len(e), sorted(set(ENDINGS)).index(e)) for e in ENDINGS)
START = ((0, 0), None, None, None)


def _ranked(keys: list[tuple | None]) -> tuple[Vector, int]:
    """(cost, *text) by state to (cost over the least, rank of text), with the least cost."""
    least = min(k[0] for k in keys if k)
    order = {t: i for i, t in enumerate(sorted({k[1:] for k in keys if k}))}
    return tuple(k and (k[0] - least, order[k[1:]]) for k in keys), least


class Program:
    """Steps of cost vectors over items, which index into tables of (cost, rank of letters)."""

    def __init__(self, tables: list):
        self.tables = tables
        self.done: dict = {}

    def forward(self, vec: Vector, item: int) -> tuple[Vector, int]:
        """Vectors of 4 states, or of 16 pairs (start, state)."""
        got = self.done.get((vec, item))
        if got is None:
            table = self.tables[item]
            got = self.done[vec, item] = _ranked([
                min(((a[0] + table[p][q][0], a[1], table[p][q][1])
                     for p, a in enumerate(vec[g:g + 4]) if a and table[p][q]), default=None)
                for g in range(0, len(vec), 4) for q in range(4)])
        return got

    def backward(self, vec: Vector, item: int) -> tuple[Vector, int]:
        got = self.done.get((item, vec))
        if got is None:
            table = self.tables[item]
            got = self.done[item, vec] = _ranked([
                min(((t[0] + b[0], t[1], b[1]) for t, b in zip(table[p], vec) if t and b), default=None)
                for p in range(4)])
        return got

    def summary(self, items) -> Vector:
        """The table of a run of items: cost and rank for every pair of states."""
        vec, base = tuple((0, 0) if g == q else None for g in range(4) for q in range(4)), 0
        for item in items:
            vec, more = self.forward(vec, item)
            base += more
        return tuple(v and (v[0] + base, v[1]) for v in vec)

    def states(self, items, start: int, end: Vector) -> list[int]:
        """The state after every item on the audit-least of the cheapest ways from ``start`` to ``end``."""
        out = [0] * len(items)
        todo = [(0, len(items), start, end)] if len(items) else []
        while todo:
            lo, hi, p, end = todo.pop()
            if hi - lo == 1:
                first = self.tables[items[lo]][p]
                out[lo] = min((t[0] + b[0], t[1], b[1], q) for q, (t, b) in enumerate(zip(first, end)) if t and b)[3]
                continue
            mid = (lo + hi) // 2
            ahead, back = tuple((0, 0) if q == p else None for q in range(4)), end
            for k in range(lo, mid):
                ahead = self.forward(ahead, items[k])[0]
            for k in range(hi - 1, mid - 1, -1):
                back = self.backward(back, items[k])[0]
            q = min((a[0] + b[0], a[1], b[1], q) for q, (a, b) in enumerate(zip(ahead, back)) if a and b)[3]
            todo.append((lo, mid, p, unit(q)))
            todo.append((mid, hi, q, end))
        return out


def unit(state: int) -> Vector:
    return tuple((0, 0) if q == state else None for q in range(4))


def audit(program: Program, codes: bytes, start: int = 0, end: int | None = None) -> str:
    """Letters of a block from ``start`` to state ``end``, or to the end of the conversation."""
    states = program.states(codes, start, END if end is None else unit(end))
    out, p = [], start
    for code, q in zip(codes, states):
        out.append(ROW_EDITS[code][p][q][1])
        p = q
    if end is None:
        out.append(ENDINGS[p])
    return "".join(out)


# ---- rows ------------------------------------------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """Faults planted by crc32 of ``conv_id:turn``, modulo 20: 0 drops the row, 1 empties its text, 2 removes its ``[.!?]``, 3
    repeats it, 4 makes its role user."""
    kind = F.crc32(F.concat(_or_space(F.col("conv_id").cast("string")), F.lit(":"),
                            _or_space(F.col("turn").cast("string")))) % 20
    text = _or_space(F.col("text"))
    return (rows.select("conv_id", "turn", _or_space(F.col("role")).alias("role"), text.alias("text"), kind.alias("kind"))
            .where("kind != 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


def _or_space(c: Column) -> Column:
    return F.coalesce(c, F.lit(" "))


def _with_digest(rows: DataFrame) -> DataFrame:
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                       _or_space(F.col("role").cast("string")).alias("role"), _or_space(F.col("text").cast("string")).alias("text"))
    both = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.withColumn("digest", F.unhex(F.sha2(both, 256)))


def _counted_codes(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, digest, copies, code``: distinct rows with their code (duplicates but the first one)."""
    said = F.rtrim(F.col("text"), F.lit(BLANKS))
    kind = F.when(said == "", BLANK).otherwise(
        F.when(F.col("role").startswith("s"), 0).when(F.col("role").startswith("u"), 1)
        .when(F.col("role").startswith("a"), 2).otherwise(3)
        + F.when(F.right(said, F.lit(1)).isin(".", "!", "?"), 0).otherwise(4))
    place = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    distinct = rows.select("conv_id", "turn", "role", "digest", kind.alias("code")).groupBy(
        "conv_id", "turn", "role", "digest", "code").agg(F.count(F.lit(1)).alias("copies"))
    first = distinct.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min(place).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d"))
    code = F.when((F.col("code") == BLANK) | place.eqNullSafe(F.col("first")), F.col("code")).otherwise(DUPLICATE)
    return distinct.join(first, same).select("conv_id", "turn", "role", "digest", "copies", code.cast("int").alias("code"))


def _order() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _cut_blocks(block: int):
    """Runs of a conversation in a partition's sorted rows, at most ``block`` rows long.  A table goes with those that
    may not be all of it: at the partition's ends, or cut."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, program, seq = TaskContext.get().partitionId(), Program(ROW_TABLES), 0
        conv, codes, whole = None, bytearray(), False

        def row(closed: bool) -> pa.RecordBatch:
            table = None if whole and closed else program.summary(codes)
            split = [[v[i] if v else None for v in table] if table else None for i in (0, 1)]
            return pa.RecordBatch.from_arrays(
                [pa.array([conv], pa.int64()), pa.array([part], pa.int64()), pa.array([seq], pa.int64()),
                 pa.array([bytes(codes)], pa.binary()), *[pa.array([s], pa.list_(pa.int32())) for s in split]],
                ["conv_id", "part", "seq", "codes", "costs", "ranks"])

        started = False
        for batch in batches:
            for c, copies, code in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if not started or c != conv:
                    if codes:
                        yield row(True)
                        seq += 1
                    conv, codes, whole, started = c, bytearray(), started, True
                rest = DUPLICATE if code < BLANK else code
                while copies:
                    if len(codes) >= block:
                        yield row(False)
                        seq, codes, whole = seq + 1, bytearray(), False
                    if code != rest:
                        codes.append(code)
                        code, copies = rest, copies - 1
                    else:
                        n = min(copies, block - len(codes))
                        codes += bytes([rest]) * n
                        copies -= n
        if codes:
            yield row(False)
    return run


def _crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """States at the ends of each block, from tables sorted by conversation; the last block's end is null."""
    def found(conv, blocks: list[dict]) -> pa.RecordBatch:
        tables = [[[None if b["costs"][4 * p + q] is None else (b["costs"][4 * p + q], b["ranks"][4 * p + q])
                    for q in range(4)] for p in range(4)] for b in blocks]
        ends = Program(tables).states(range(len(tables)), 0, END)
        return pa.RecordBatch.from_arrays(
            [pa.array([conv] * len(blocks), pa.int64()), pa.array([b["part"] for b in blocks], pa.int64()),
             pa.array([b["seq"] for b in blocks], pa.int64()), pa.array([0, *ends[:-1]], pa.int32()),
             pa.array([*ends[:-1], None], pa.int32())], ["c", "part", "seq", "first", "last"])

    conv, blocks = None, []
    for batch in batches:
        for b in batch.to_pylist():
            if blocks and b["conv_id"] != conv:
                yield found(conv, blocks)
                blocks = []
            conv = b["conv_id"]
            blocks.append(b)
    if blocks:
        yield found(conv, blocks)


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    program = Program(ROW_TABLES)
    for batch in batches:
        out = {k: [] for k in ("conv_id", "part", "seq", "audit", "blank", "duplicate", "truncated", "cost")}
        for b in batch.to_pylist():
            codes, letters = b["codes"], audit(program, b["codes"], b["first"] or 0, b["last"])
            kept = (code for code, edit in zip(codes, letters.replace("I", "")) if edit != "D")
            for k in ("conv_id", "part", "seq"):
                out[k].append(b[k])
            out["audit"].append(letters)
            out["blank"].append(codes.count(BLANK))
            out["duplicate"].append(codes.count(DUPLICATE))
            out["truncated"].append(sum(codes.count(c) for c in range(4, 8)))
            out["cost"].append(INSERT * letters.count("I") + CHANGE * letters.count("R") + DELETE * letters.count("D")
                               + CUT * sum(code >> 2 for code in kept))
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.string() if k == "audit" else pa.int64()) for k, v in out.items()})


def audits(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``conv_id, audit, blank, duplicate, truncated, cost`` of every conversation with rows."""
    slim = cut_lineage(_counted_codes(_with_digest(rows)))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = cut_lineage(slim.repartitionByRange(parts, *_order()).sortWithinPartitions(*_order())
                         .select("conv_id", "copies", "code").mapInArrow(_cut_blocks(block), BLOCKS))
    tables = blocks.where("costs is not null").select("conv_id", "part", "seq", "costs", "ranks")
    ends = (tables.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
            .mapInArrow(_crossings, "c long, part long, seq long, first int, last int"))
    done = blocks.select("conv_id", "part", "seq", "codes").join(
        ends.drop("c"), ["part", "seq"], "left").mapInArrow(
        _letters, "conv_id long, part long, seq long, audit string, blank long, duplicate long, truncated long, cost long")
    # one letter a row: the list is as long as the audit it becomes
    pieces = F.array_sort(F.collect_list(F.struct("part", "seq", "audit")))
    return done.groupBy("conv_id").agg(
        F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit"),
        *[F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated", "cost")])


class _Conversation:
    """What a conversation's rows, passing in order, leave behind."""

    def __init__(self, conv_id):
        self.conv_id, self.audit, self.counts = conv_id, "", [0] * 4
        self.at = self.gaps = self.illegal = self.rows = self.turns = 0
        self.low = self.high = self.before = None
        self.digest, self.inside, self.said = hashlib.sha256(), None, 0

    def _inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._say(None, "")
            self.at += 1

    def _say(self, role: str | None, text: str) -> None:
        """A repaired row; without a role it gets the one that the grammar has at its place."""
        if role is None:
            role = "assistant" if (self.said - self.system) % 2 else "user"
        self.digest.update(f"{chr(10) if self.said else ''}{role}:{text}".encode())
        self.said += 1

    @property
    def system(self) -> int:
        """1 if the repaired rows begin with s: their number is odd then."""
        if self.inside is None:
            self.inside = (len(self.audit) - self.audit.count("D")) % 2
        return self.inside

    def row(self, turn, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            self._say(role if edit == "K" else None, text)
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.rows and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before, self.rows = role[:1], self.rows + 1

    def result(self) -> dict:
        self._inserts()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        blank, duplicate, truncated, cost = self.counts
        return {"conv_id": self.conv_id, "gaps": gaps, "blank": blank, "duplicate": duplicate, "truncated": truncated,
                "illegal": self.illegal, "cost": cost, "audit": self.audit, "repaired_sha256": self.digest.hexdigest()}


RESULT = pa.schema([("conv_id", pa.int64()), *[(k, pa.int64()) for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                    ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, out = None, []
    for batch in batches:
        for r in batch.to_pylist():
            if conv is None or r["conv_id"] != conv.conv_id:
                if conv:
                    out.append(conv.result())
                conv = _Conversation(r["conv_id"])
            if r["audit"] is not None:
                conv.audit, conv.counts = r["audit"], [r[k] for k in ("blank", "duplicate", "truncated", "cost")]
            elif r["text"] is not None:
                conv.row(r["turn"], r["role"], r["text"])
        if out:
            yield pa.RecordBatch.from_pylist(out, RESULT)
            out = []
    if conv:
        yield pa.RecordBatch.from_pylist([conv.result()], RESULT)


def repair(rows: DataFrame, conversations: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of the conversations of ``rows``, and
    of the conv_ids of ``conversations`` that have none."""
    texts = _with_digest(rows).withColumn("kind", F.lit(2))
    heads = audits(rows, block).withColumn("kind", F.lit(1))
    if conversations is not None:
        heads = heads.unionByName(conversations.select(F.col("conv_id").cast("long")).distinct().withColumn("kind", F.lit(0)), True)
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return (texts.unionByName(heads, True).repartition(parts, "conv_id")
            .sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "kind", *_order()[1:])
            .select("conv_id", "turn", "role", "text", "audit", "blank", "duplicate", "truncated", "cost")
            .mapInArrow(_results, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                                  "audit string, repaired_sha256 string"))

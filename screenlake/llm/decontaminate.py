"""Benchmark decontamination by template canonicalisation.

A text becomes words, lower-cased; numbers, names (capitalised inside a sentence) and units of measure become typed
placeholders, whose values are the slots.  Windows of ``width`` words are hashed twice, with placeholders (template) and without
(literal).  Document windows are equi-joined with the benchmark's by hash.  A document holds an item when it has at least
``least`` of its distinct literal windows, or at least ``least`` of its template windows and its slots are consistent: every
item value stands for one document value, and for names and units the other way round too (two numbers may happen to become
one), so re-parameterised copies count and chance agreements of a template don't.  It also holds an item, whatever the item's
length, when it has a passage of it: ``RUN`` words or more inside matching windows that follow each other in both texts, with at
most ``GAP`` other words in between; replaced words leave the windows at one offset, inserted or left out ones move it a little.
Of a passage of template windows only words outside its slots count, or its share of the item's windows; its slots are consistent
in themselves, whatever values the document has elsewhere.

Before the join, document windows pass a bitmap of the benchmark's hashes (``BITS`` bits, a fixed size, broadcast); it only
drops windows that can't join.  The join itself is left to the planner, whatever the benchmark's size.  Equal texts
have one digest and are judged once; a window counts once a text for the shares, passages see all its places.

An item with fewer than ``width`` words has one window holding them all; one without words matches nothing.

Defined cases: null texts count as empty and hold nothing; rows with equal or null ids are judged by their own texts;
repeated benchmark rows count once, null item ids stay apart as null; empty tables give no row; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from screenlake.llm.tables import text_or_empty, whole_rows

WIDTH, LEAST, BITS = 8, 0.5, 1 << 23
RUN, GAP = 13, 8  # words of a passage that match, words between its parts that don't
PIECE = 4096  # document places looked at together
NUMBER, NAME, UNIT = 1, 2, 3
# units of measure taken as placeholders (fixed value)
UNITS = frozenset("""mm cm m km inch inches feet foot yard yards mile miles mg g kg gram grams kilogram kilograms ton tons ounce
ounces pound pounds lb lbs ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days
week weeks month months year years percent dollar dollars euro euros cent cents mph kmh degree degrees celsius fahrenheit
watt watts volt volts joule joules newton newtons""".split())
TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?\n]")
MIX = np.uint64(0x9E3779B97F4A7C15)
_ENDS = frozenset(".!?\n")


class _Codes(dict):
    """64-bit codes of words, their lowest three bits the kind of slot they may be; forgets all when it holds too many."""

    most = 300_000

    def __missing__(self, t: str) -> int:
        low = t.lower()
        raw = low.encode()
        code = (zlib.crc32(raw) << 32 | zlib.crc32(raw, 0x5BD1E995)) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFF8
        kind = (4 if t in _ENDS else NUMBER if t[0].isdigit() else UNIT if low in UNITS else NAME if t[0].isupper() else 0)
        self[t] = code | kind
        return code | kind

    def of(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > self.most:
            self.clear()
        both = np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))
        return both & ~np.uint64(7), (both & np.uint64(7)).astype(np.uint8)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


def _rolled(codes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each window of ``width`` codes: the polynomial of its codes in ``MIX``, from windows of doubled length."""
    n = len(codes) - width + 1
    done, h = 0, None                       # h: of the first ``done`` codes of each window
    power, size, step = codes, 1, np.full(1, MIX)   # power: of ``size`` codes from each place on; step = MIX ** size
    left = width
    while True:
        if left & 1:
            h = power[done:done + n] if h is None else h * step + power[done:done + n]
            done += size
        left >>= 1
        if not left:
            return _mixed(h * MIX + np.uint64(width))
        power = power[:-size] * step + power[size:]
        size, step = 2 * size, step * step


class Canon:
    """A canonicalised text: words, their kinds, and template and literal codes."""

    def __init__(self, text: str, codes: _Codes):
        tokens = TOKEN.findall(text)
        code, kind = codes.of(tokens)
        stop = kind == 4
        starts = np.ones(len(tokens), bool)
        starts[1:] = stop[:-1]
        kind = np.where(starts & (kind == NAME), 0, kind)  # a capital at the start of a sentence names nothing
        keep = ~stop
        self.at = np.flatnonzero(keep)
        self.tokens, self.literal, self.kind = tokens, code[keep], kind[keep]
        self.template = np.where(self.kind > 0, self.kind.astype(np.uint64), self.literal)

    def __len__(self) -> int:
        return len(self.literal)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Template and literal hashes; an odd hash is a literal one, so that the two never meet."""
        one, literal = np.uint64(1), _rolled(self.literal, width)
        template = _rolled(self.template, width) if self.kind.any() else literal
        return template & ~one, literal | one

    def slots(self, i: int, width: int) -> str:
        """Slots of a window: place in it, kind and value of each."""
        return " ".join(f"{k - i}:{self.kind[k]}{self.tokens[self.at[k]].lower()}" for k in range(i, min(i + width, len(self)))
                        if self.kind[k])


PLACES = StructType([StructField("at", LongType()), StructField("slots", StringType())])
ITEM = StructType([StructField("item_id", LongType()), StructField("item", StringType()), StructField("hash", LongType()),
                   StructField("windows", LongType()), StructField("literal", LongType()), StructField("width", LongType()),
                   StructField("words", LongType()), StructField("places", ArrayType(PLACES))])
HIT = "digest string, hash long, found array<struct<at:bigint,slots:string>>"
_PLACES = pa.list_(pa.struct([("at", pa.int64()), ("slots", pa.string())]))


def _by_hash(hashes: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """Each hash with its places, in order."""
    order = np.argsort(hashes, kind="stable")
    own, start = np.unique(hashes[order], return_index=True)
    for h, places in zip(own.view("int64").tolist(), np.split(order, start[1:]) if len(own) else ()):
        yield h, places.tolist()


def benchmark_windows(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct windows of each item: ``item_id, item`` (a key of id and text), ``hash, windows, literal``
    (how many distinct ones of that kind the item has, and whether literal), ``width, words`` (of the item), ``places`` (first words
    and slots)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for batch in batches:
            rows = []
            for item_id, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                c = Canon(text, codes)
                w = min(width, len(c))
                if not w:
                    continue
                for literal, hashes in enumerate(c.windows(w)):
                    own = list(_by_hash(hashes))
                    rows += [(item_id, key, h, len(own), literal, w, len(c),
                              [{"at": i, "slots": "" if literal else c.slots(i, w)} for i in places]) for h, places in own]
            yield pa.RecordBatch.from_pylist([dict(zip(ITEM.names, r)) for r in rows], schema=_arrow(ITEM))

    key = F.concat_ws(":", F.col("item_id").cast("string"), F.md5(text_or_empty(F.col("text"))))
    read = items.select(F.col("item_id").cast("long").alias("item_id"), key.alias("key"),
                        text_or_empty(F.col("text")).alias("text")).distinct()
    return read.mapInArrow(run, ITEM)


def _arrow(schema: StructType) -> pa.Schema:
    kinds = {LongType: pa.int64(), StringType: pa.string(), DoubleType: pa.float64(), BooleanType: pa.bool_(), ArrayType: _PLACES}
    return pa.schema([(f.name, kinds[type(f.dataType)]) for f in schema.fields])


def bitmap(hashes: DataFrame, bits: int = BITS) -> np.ndarray:
    """A bit for each value of the long column ``hash`` modulo ``bits``; of fixed size, built from at most bits / 64 words."""
    spot = F.expr(f"pmod(hash, {bits}L)")
    words = (hashes.select(F.shiftright(spot, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(hash, 64L) as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bit")))
    out = np.zeros(bits // 64, np.int64)
    for word, bit in words.toPandas().itertuples(index=False):
        out[word] = bit
    return np.unpackbits(out.view("uint8"), bitorder="little").astype(bool)


def document_windows(docs: DataFrame, seen: np.ndarray, widths: list[int]) -> DataFrame:
    """``digest, hash, found``: all places of each window that the bitmap lets through, a row for each hash of a text."""
    mask = np.uint64(len(seen) - 1)
    shared = docs.sparkSession.sparkContext.broadcast(seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, bits = _Codes(), shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = []
                for digest, text in zip(*(c.to_pylist() for c in batch.slice(lo, 256).columns)):
                    c = Canon(text, codes)
                    for w in widths:
                        if len(c) < w:
                            continue
                        for literal, hashes in enumerate(c.windows(w)):
                            hit = np.flatnonzero(bits[hashes & mask])
                            if len(hit):
                                at = hit.tolist()
                                rows += [{"digest": digest, "hash": h,
                                          "found": [{"at": at[i], "slots": "" if literal else c.slots(at[i], w)} for i in places]}
                                         for h, places in _by_hash(hashes[hit])]
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                    [("digest", pa.string()), ("hash", pa.int64()), ("found", _PLACES)]))

    return docs.mapInArrow(run, HIT)


def text_digest():
    return F.md5(text_or_empty(F.col("text")))


class Match:
    """Windows of one document and one item that follow each other at one offset, or several such after each other."""

    def __init__(self, places: list[int], offset: int, width: int, slots: dict[int, tuple[str, str]] | None = None):
        self.places, self.offset, self.width = set(places), offset, width
        self.slots = slots or {}  # item and document value by item place
        self.first, self.end = places[0], places[-1] + width
        self.at, self.at_end = self.first + offset, self.end + offset

    def words(self) -> int:
        """How many words of the item are in the windows, without slots."""
        return len({p + k for p in self.places for k in range(self.width)} - self.slots.keys())

    def joined(self, then: Match) -> Match | None:
        """With the windows of another offset that come right after; None where they don't."""
        if (then.offset == self.offset or then.end <= self.end or then.at_end <= self.at_end
                or not -self.width <= then.first - self.end <= GAP or not -self.width <= then.at - self.at_end <= GAP):
            return None
        if self.slots and then.slots and not _consistent({*self.slots.values(), *then.slots.values()}):
            return None
        both = Match([then.first], then.offset, self.width, self.slots | then.slots)
        both.places, both.end, both.at_end = self.places | then.places, then.end, then.at_end
        return both


def _offsets(windows: list[tuple[list, list]], lo: int, hi: int) -> dict[int, list[tuple[int, str, str]]]:
    """Item places and slots by document place minus item place, for document places from ``lo`` up to ``hi``."""
    out = defaultdict(list)
    for places, found in windows:
        for f in found:
            if lo <= f["at"] < hi:
                for p in places:
                    out[f["at"] - p["at"]].append((p["at"], p["slots"], f["slots"]))
    return out


def _consistent_parts(run: list[tuple[int, str, str]], offset: int, width: int) -> Iterator[Match]:
    """The longest parts of windows at one offset whose slots are consistent."""
    if not any(slots for _, slots, _ in run):
        yield Match([p for p, *_ in run], offset, width)
        return
    left = 0
    seen: dict[tuple[str, str], tuple[str, int]] = {}  # the other value, and the last window that had it
    pairs = [{p + int(i.partition(":")[0]): x for i, x in zip(item.split(), _pairs(item, doc))} for p, item, doc in run]

    def part(i: int, j: int) -> Match:
        return Match([p for p, *_ in run[i:j]], offset, width, {k: v for own in pairs[i:j] for k, v in own.items()})

    for n, own in enumerate(pairs):
        start = left
        for i, d in own.values():
            for key, other in ((("item", i), d), (("doc", d), i))[:1 if d.startswith(str(NUMBER)) else 2]:
                if key in seen and seen[key][0] != other:
                    start = max(start, seen[key][1] + 1)
                seen[key] = (other, n)
        if start > left:
            if n > left:
                yield part(left, n)
            left = start
    if left < len(run):
        yield part(left, len(run))


def _has_passage(windows: list[tuple[list, list]], width: int, words: int, enough) -> bool:
    """Whether windows (item places, document places) hold a match that is ``enough``."""
    last = max((f["at"] for _, found in windows for f in found), default=-1)
    step = max(PIECE, words)
    for lo in range(0, last + 1, step):  # pieces lap over by two items, so that no passage is cut
        matches = []
        for offset, places in _offsets(windows, lo, lo + step + 2 * words).items():
            places.sort()
            cut = [0, *(i for i in range(1, len(places)) if places[i][0] - places[i - 1][0] > width + GAP), len(places)]
            for i, j in zip(cut, cut[1:]):
                matches += _consistent_parts(places[i:j], offset, width)
        if any(map(enough, matches)):
            return True
        matches.sort(key=lambda m: (m.at, m.first))
        for i, m in enumerate(matches):
            for then in matches[i + 1:]:
                if then.at - m.at_end > GAP:
                    break
                if (both := m.joined(then)) is not None:
                    m = both
                    if enough(m):
                        return True
    return False


def _consistent(pairs: set[tuple[str, str]]) -> bool:
    """Whether each item value has one document value, and names and units the other way round."""
    named = [d for _, d in pairs if not d.startswith(str(NUMBER))]
    return len({i for i, _ in pairs}) == len(pairs) and len(set(named)) == len(named)


def _pairs(item: str, doc: str) -> Iterator[tuple[str, str]]:
    """Item and document values of a window's slots, without their places."""
    for i, d in zip(item.split(), doc.split()):
        yield i.partition(":")[2], d.partition(":")[2]


LEAK = StructType([StructField("digest", StringType()), StructField("item_id", LongType()), StructField("literal_share", DoubleType()),
                   StructField("template_share", DoubleType()), StructField("consistent", BooleanType()),
                   StructField("first_word", LongType())])


def _judge(windows: list[dict], least: float) -> dict | None:
    """Shares of the windows an item and a document have in common, or None where the document doesn't hold the item."""
    by_kind = [[(w["places"], w["found"]) for w in windows if w["literal"] == kind] for kind in (0, 1)]
    n, width, words = windows[0]["windows"], windows[0]["width"], windows[0]["words"]
    template, literal = (len(k) / max((w["windows"] for w in windows if w["literal"] == kind), default=n)
                         for kind, k in enumerate(by_kind))
    # shares take the first place of a window
    consistent = _consistent({x for p, f in by_kind[0] for x in _pairs(p[0]["slots"], f[0]["slots"])})
    if not (literal >= least or template >= least and consistent or _has_passage(by_kind[1], width, words, lambda m: m.words() >= RUN)):
        hash_of = {p["at"]: k for k, (places, _) in enumerate(by_kind[0]) for p in places}

        def enough(m: Match) -> bool:
            return m.words() >= RUN or len({hash_of[p] for p in m.places}) / n >= least

        if not _has_passage(by_kind[0], width, words, enough):
            return None
        consistent = True
    return {"literal_share": literal, "template_share": template, "consistent": consistent,
            "first_word": min(f["at"] for w in windows for f in w["found"])}


def leaks(docs: DataFrame, items: DataFrame, width: int = WIDTH, least: float = LEAST) -> DataFrame:
    """``digest, item_id, literal_share, template_share, consistent, first_word``: which distinct texts hold which items."""
    bench = benchmark_windows(items, width)
    facts = bench.select("hash", "width").distinct()
    widths = sorted(r[0] for r in facts.select("width").distinct().collect())  # at most ``width`` values
    texts = docs.select(text_digest().alias("digest"), text_or_empty(F.col("text")).alias("text")).where("text != ''")
    hits = document_windows(texts, bitmap(facts), widths)
    once = hits.groupBy("digest", "hash").agg(F.first("found").alias("found"))  # equal texts have equal places
    per = once.join(bench, "hash").groupBy("digest", "item_id", "item").agg(
        F.collect_list(F.struct("literal", "windows", "width", "words", "places", "found")).alias("both"))
    # a single window is a share at most of items with one or two
    some = per.where((F.size("both") > 1) | (F.col("both")[0]["windows"] * least <= 1)).select("digest", "item_id", "both")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, 256):
                for digest, item_id, both in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    if (said := _judge(both, least)) is not None:
                        rows.append({"digest": digest, "item_id": item_id} | said)
            yield pa.RecordBatch.from_pylist(rows, schema=_arrow(LEAK))

    return some.mapInArrow(run, LEAK)


def contaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH, least: float = LEAST) -> DataFrame:
    """``doc_id, item_id, literal_share, template_share, consistent, first_word``: a row for each document and item it holds."""
    found = leaks(docs, items, width, least)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("digest"))
            .join(found, "digest").drop("digest"))


def clean(docs: DataFrame, items: DataFrame, width: int = WIDTH, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that hold no item, all their columns."""
    found = leaks(docs, items, width, least).select(F.col("digest").alias("_leak")).distinct()
    rows = whole_rows(docs).withColumn("text", F.col("row.text"))
    return rows.join(found, text_digest() == F.col("_leak"), "left_anti").select("row.*")

"""Document fingerprints from prefix polynomial hashes.

``Spans`` keeps, for a text of n code points, modular prefix sums S[i] = c0 + c1 B + ... + c(i-1) B^(i-1) for two bases modulo
2^31 - 1.  Any span's hash is (S[j] - S[i]) B^-i, so two spans are compared in constant time, and the longest common
extension of two places is found by binary search.

A fingerprint is the length, the hash of the whole text, and the ``KEEP`` smallest mixed hashes among all its
``WIDTH``-spans; likeness is the share of the ``KEEP`` smallest hashes of both that occur in both (1 for equal fingerprints).

``edited_pairs`` walks the documents in descending order of doc_id.  Bucket bounds come from quantiles of the ids; each document
is sent once to its bucket, and the head of a bucket also to the bucket before it, whose last document it follows.  Only ids and a head
per bucket are seen by the driver, and texts are shuffled once.

Defined cases: null text counts as empty; rows of one doc_id are ordered by text, null ids come last; a single row is its own next
one; an empty table gives no row; other columns are not read.  Two empty texts are alike (1), an empty and another are not (0).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenlake.llm.tables import text_or_empty

P = np.uint64((1 << 31) - 1)
BASES = (1_000_003, 91_138_233)
WIDTH, KEEP = 16, 64
_UP: list[np.ndarray] = [np.ones(1, np.uint64) for _ in BASES]
_DOWN: list[np.ndarray] = [np.ones(1, np.uint64) for _ in BASES]


def _mod(x: np.ndarray) -> np.ndarray:
    """x mod 2^31 - 1 of values below 2^62."""
    x = (x & P) + (x >> np.uint64(31))
    x = (x & P) + (x >> np.uint64(31))
    return np.where(x >= P, x - P, x)


def _powers(n: int, b: int, down: bool) -> np.ndarray:
    """Powers of a base, or of its inverse, up to n; kept and grown by doubling."""
    kept = (_DOWN if down else _UP)
    have = kept[b]
    base = pow(BASES[b], int(P) - 2, int(P)) if down else BASES[b]
    while len(have) <= n:
        have = np.concatenate([have, _mod(have * np.uint64(pow(base, len(have), int(P))))])
        kept[b] = have
    return have


class Spans:
    """Prefix hashes of one text."""

    def __init__(self, text: str, bases: int = len(BASES)):
        # surrogates can't come from a UTF-8 column; "surrogatepass" keeps the class total
        self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        self.n = len(self.codes)
        self.prefix = []
        for b in range(bases):
            s = np.zeros(self.n + 1, np.uint64)
            np.cumsum(_mod((self.codes + np.uint64(1)) * _powers(self.n, b, False)[:self.n]), out=s[1:])
            self.prefix.append(_mod(s))

    def span(self, i: int, j: int) -> tuple[int, ...]:
        """Hash of the code points [i, j); equal spans of any texts have equal hashes."""
        return tuple((int(s[j]) - int(s[i])) % int(P) * int(_powers(self.n, b, True)[i]) % int(P)
                     for b, s in enumerate(self.prefix))

    def equal(self, i: int, j: int, other: Spans, k: int, m: int) -> bool:
        return j - i == m - k and self.span(i, j) == other.span(k, m)

    def common(self, i: int, other: Spans, k: int) -> int:
        """Longest common extension: how many code points agree from place i here and k there on."""
        low, high = 0, min(self.n - i, other.n - k)
        while low < high:
            mid = (low + high + 1) // 2
            if self.equal(i, i + mid, other, k, k + mid):
                low = mid
            else:
                high = mid - 1
        return low

    def windows(self, width: int = WIDTH) -> np.ndarray:
        """Hashes (first base) of all spans of a width; of the whole text where it is shorter."""
        width = min(width, self.n)
        if not self.n:
            return np.zeros(0, np.uint64)
        s = self.prefix[0]
        diff = s[width:] + P - s[:len(s) - width]
        return _mod(_mod(diff) * _powers(self.n, 0, True)[:len(diff)])


def _sketch(hashes: np.ndarray) -> np.ndarray:
    mixed = (hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    if len(mixed) > 8 * KEEP:
        low = np.unique(np.partition(mixed, 4 * KEEP)[:4 * KEEP])
        if len(low) >= KEEP:
            return low[:KEEP]
    return np.unique(mixed)[:KEEP]


class Fingerprint:
    def __init__(self, spans: Spans):
        whole = spans.span(0, spans.n)
        self.sketch = _sketch(spans.windows())
        self.text = f"{spans.n:x}-" + "".join(f"{h:08x}" for h in whole) + "-" + self.sketch.astype(">u4").tobytes().hex()

    @classmethod
    def parse(cls, text: str) -> Fingerprint:
        made = cls.__new__(cls)
        made.text = text
        made.sketch = np.frombuffer(bytes.fromhex(text.rsplit("-", 1)[1]), ">u4").astype(np.uint64)
        return made

    def likeness(self, other: Fingerprint) -> float:
        if self.text == other.text:
            return 1.0
        if not len(self.sketch) or not len(other.sketch):
            return 0.0
        both = np.union1d(self.sketch, other.sketch)[:KEEP]
        shared = np.isin(both, self.sketch, assume_unique=True) & np.isin(both, other.sketch, assume_unique=True)
        return float(shared.sum()) / len(both)


PAIRS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
         "near_edited double, near_next double, same_prefix long, next_prefix long")


def _row(doc_id, text: str, spans: Spans, mark: Fingerprint, after: str, next_spans: Spans, next_mark: Fingerprint) -> tuple:
    half = len(text) // 2
    edited = text[:len(text) - half] + after[:half]
    e = Spans(edited)
    em = Fingerprint(e)
    return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), mark.text, em.text,
            mark.likeness(em), mark.likeness(next_mark), spans.common(0, e, 0), spans.common(0, next_spans, 0))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (bucket, order); a guest only serves as the next of the row before it."""
    names = [f.strip().split(" ")[0] for f in PAIRS.split(",")]
    out: list[tuple] = []
    held = None

    def table(rows):
        return pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))))

    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            cols = [c.to_pylist() for c in batch.slice(at, 128).columns]
            for bucket, guest, doc_id, text in zip(*cols):
                spans = Spans(text)
                mark = Fingerprint(spans)
                if held and held[0] == bucket and not held[1]:
                    out.append(_row(held[2], held[3], held[4], held[5], text, spans, mark))
                held = (bucket, guest, doc_id, text, spans, mark)
            if out:
                yield table(out)
                out = []


def _bucket(doc_id, bounds: list[int]):
    """Number of bounds above an id, looked up in two steps; null ids come after all."""
    step = max(1, int(len(bounds) ** 0.5))
    above = F.array(*[F.lit(b).cast("long") for b in bounds])
    coarse = F.array(*[F.lit(b).cast("long") for b in bounds[step - 1::step]])
    k = F.size(F.filter(coarse, lambda x: x > doc_id)) * step
    fine = F.size(F.filter(F.slice(above, k + 1, F.lit(step)), lambda x: x > doc_id))
    return F.when(doc_id.isNull(), F.lit(len(bounds))).otherwise(k + fine)


def edited_pairs(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Per row: its fingerprint, that of its edited text (the last half replaced by the head of the next document in
    descending order of doc_id), likenesses, and the common prefixes found by binary search."""
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    share = [i / buckets for i in range(1, buckets)]
    found = ids.agg(F.percentile_approx("doc_id", share, max(10_000, 10 * buckets))).first()[0] if share else None
    bounds = sorted(set(found or []), reverse=True)
    place = _bucket(F.col("doc_id"), bounds) if bounds else F.lit(0)
    heads = ids.withColumn("b", place).groupBy("b").agg(F.max("doc_id").alias("m")).orderBy("b").collect()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text"))
    rows = rows.withColumn("bucket", place)
    # the head of each bucket (all rows of its largest id) is a guest in the bucket before; the first one in the last
    after = {h["b"]: heads[i - 1]["b"] for i, h in enumerate(heads)}
    to = F.lit(None).cast("int")
    for h in heads:
        mine = F.col("doc_id").isNull() if h["m"] is None else F.col("doc_id") == h["m"]
        to = F.when((F.col("bucket") == h["b"]) & mine, F.lit(after[h["b"]])).otherwise(to) if len(heads) < 200 else to
    if len(heads) >= 200:
        pairs = spark.createDataFrame([(h["b"], h["m"], after[h["b"]]) for h in heads], "b int, m long, t int")
        rows = rows.join(pairs, (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("m")), "left")
        to = F.col("t")
    copies = F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest")),
                     F.struct(to.alias("bucket"), F.lit(True).alias("guest")))
    sent = (rows.select("doc_id", "text", F.explode(copies).alias("c")).where("c.bucket is not null")
            .select("c.bucket", "c.guest", "doc_id", "text"))
    sorted_ = sent.repartition(max(1, len(heads)), "bucket").sortWithinPartitions(
        "bucket", "guest", F.col("doc_id").desc_nulls_last(), "text")
    return sorted_.mapInArrow(_walk, PAIRS)

"""Token counts of whole texts without token ids.

A sentencepiece BPE model merges only what one of its pieces spells, so a text falls into pre-tokens that never
influence each other: a run of spaces with what follows it, a run without spaces, or a line break.  (``cut_rule`` holds the
model to it: no piece has a space after another character, none but the break's own holds a break.)  The
text's count is the sum of its pre-tokens' counts.

1. A task cuts its documents into blocks, codes their pre-tokens by a dictionary of the block and keeps
   (pre-token, document, frequency) as packed arrays.  A block sends each bucket of the pre-tokens' hash one row.
2. A bucket's task counts the pieces of each distinct pre-token once and joins them to the frequencies, which
   gives sums by document of the block.
3. A block's sums meet its document ids in one task.

Texts and ids never cross a shuffle.  Buckets follow the bytes read (``BUCKET_BYTES``), so a bucket's dictionary is bounded.  A
pre-token that more than 1/16 of a block's documents hold goes to a bucket that also depends on the block: a pre-token
that the whole corpus holds is no single task's work.

Defined cases: null or empty text has no token and no byte; rows with equal or null ids are counted separately; an empty table
gives no row; other columns are not read; U+2581, the model's letter for a space, counts as a space, as the library has it.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE, BREAK = "▁", "\n"
PRE_TOKEN = re.compile(f" +[^ {BREAK}]*|[^ {BREAK}]+")
BLOCK_CHARS = 4_000_000      # a block ends with the document that reaches it
BUCKET_BYTES = 4_000_000     # bytes of text for each bucket of pre-tokens
ROWS = "bucket int, block long, home boolean, payload binary"


def cut_rule(sp) -> None:
    """Raises ValueError for a model whose pieces cross pre-tokens or whose normalisation isn't the identity."""
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i):
            continue
        if SPACE in piece.lstrip(SPACE) or (BREAK in piece and piece != BREAK):
            raise ValueError(f"piece {piece!r} crosses pre-tokens")
    if sp.normalize("  ﬁ \n") != SPACE * 3 + "ﬁ" + SPACE + BREAK:
        raise ValueError("the model normalises texts")


class PieceCounter:
    """Pieces of a pre-token, each distinct one counted once.  A break before it keeps the library's own leading space away."""

    def __init__(self, model_path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        cut_rule(self.sp)
        self.before = len(self.sp.encode(BREAK))
        self.counts: dict[str, int] = {}

    def of(self, words: list[str]) -> np.ndarray:
        new = [w for w in words if w not in self.counts]
        if new:
            got = self.sp.encode([BREAK + w for w in new], num_threads=1)
            self.counts.update(zip(new, (len(ids) - self.before for ids in got)))
        return np.fromiter(map(self.counts.__getitem__, words), "int64", len(words))

    def forget(self) -> None:
        self.counts.clear()


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text that isn't empty, without its breaks; the first gets the library's leading space."""
    return PRE_TOKEN.findall(" " + text.replace(SPACE, " "))


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers, each in its least width, then compressed."""
    out = [np.array([len(arrays)], "<u4").tobytes()]
    for a in arrays:
        width = next(w for w in ("<u1", "<u2", "<u4", "<u8") if not len(a) or a.max() <= np.iinfo(w).max)
        out += [np.array([len(a), int(width[2])], "<u4").tobytes(), a.astype(width).tobytes()]
    return zlib.compress(b"".join(out), 1)


def _unpacked(data: bytes) -> list[np.ndarray]:
    data, at, out = zlib.decompress(data), 4, []
    for _ in range(int(np.frombuffer(data, "<u4", 1)[0])):
        n, width = map(int, np.frombuffer(data, "<u4", 2, at))
        out.append(np.frombuffer(data, f"<u{width}", n, at + 8).astype("int64"))
        at += 8 + n * width
    return out


def _hash(words: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode()) for w in words), "int64", len(words))


class _Block:
    """Documents of a block and the codes of their pre-tokens."""

    def __init__(self, number: int):
        self.number, self.chars = number, 0
        self.code: defaultdict[str, int] = defaultdict()
        self.code.default_factory = self.code.__len__
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.breaks: list[int] = []
        self.codes: list[np.ndarray] = []

    def add(self, doc_id: int | None, text: str) -> None:
        words = pre_tokens(text) if text else []
        self.ids.append(doc_id)
        self.sizes.append(len(text.encode()))
        self.breaks.append(text.count(BREAK))
        self.codes.append(np.fromiter(map(self.code.__getitem__, words), "int64", len(words)))
        self.chars += len(text) + 1

    def rows(self, buckets: int) -> Iterator[tuple]:
        docs = len(self.ids)
        # place of a null id: a flag beside a zero
        ids = np.array([i or 0 for i in self.ids], "int64")
        yield (self.number % buckets, self.number, True, _packed(
            ids.view("uint64"), np.array([i is None for i in self.ids], "int64"), np.array(self.sizes, "int64"),
            np.array(self.breaks, "int64")))
        doc = np.repeat(np.arange(docs), [len(c) for c in self.codes])
        if not len(doc):
            return
        pair, freq = np.unique(np.concatenate(self.codes) * docs + doc, return_counts=True)
        held = np.bincount(pair // docs, minlength=len(self.code))   # documents holding each pre-token
        words = list(self.code)
        hashed = _hash(words)
        spread = held * 16 > max(docs, 64)
        hashed[spread] += zlib.crc32(b"%d" % self.number)
        bucket = hashed % buckets
        order = np.argsort(bucket, kind="stable")
        ends = np.cumsum(held)
        doc_of = pair % docs
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for mine in np.split(order, cuts):
            n = held[mine]
            # positions of the chosen pre-tokens' pairs, one run after the other
            at = np.repeat(ends[mine] - n - (np.cumsum(n) - n), n) + np.arange(n.sum())
            text = np.frombuffer(BREAK.join(words[i] for i in mine).encode(), "u1")
            yield int(bucket[mine[0]]), self.number, False, _packed(text, n, doc_of[at], freq[at])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    b, k, h, p = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(b, pa.int32()), pa.array(k, pa.int64()), pa.array(h, pa.bool_()), pa.array(p, pa.binary())],
        ["bucket", "block", "home", "payload"])


def _frequencies(buckets: int, block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = _Block(number)
        for batch in batches:
            for d, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(d, t.as_py() or "")
                if block.chars >= block_chars:
                    yield _batch(list(block.rows(buckets)))
                    block = _Block(block.number + 1)
        if block.ids:
            yield _batch(list(block.rows(buckets)))
    return run


def _sums(model_path: str):
    """Rows come bucket by bucket; home rows pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, bucket = PieceCounter(model_path), None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["home"]:
                    out.append((0, row["block"], True, row["payload"]))
                    continue
                if row["bucket"] != bucket:
                    counter.forget()
                    bucket = row["bucket"]
                text, n, doc, freq = _unpacked(row["payload"])
                pieces = counter.of(text.astype("u1").tobytes().decode().split(BREAK))
                total = np.bincount(doc, np.repeat(pieces, n) * freq)
                hit = np.flatnonzero(total)
                out.append((0, row["block"], False, _packed(hit, total[hit].astype("int64"))))
            if out:
                yield _batch(out)
    return run


def _totals(model_path: str):
    """Rows come block by block, the home row first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_break = len(PieceCounter(model_path).sp.encode(BREAK * 2)) - len(PieceCounter(model_path).sp.encode(BREAK))
        home = None

        def done() -> pa.RecordBatch:
            ids, missing, sizes, total = home
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64(), mask=missing.astype(bool)), pa.array(sizes, pa.int64()), pa.array(total, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["home"]:
                    if home:
                        yield done()
                    ids, missing, sizes, breaks = _unpacked(row["payload"])
                    home = ids, missing, sizes, breaks * a_break
                else:
                    hit, total = _unpacked(row["payload"])
                    home[3][hit] += total
        if home:
            yield done()
    return run


def count_tokens(docs: DataFrame, model_path: str, block_chars: int = BLOCK_CHARS,
                 bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row, as sentencepiece gives them without begin and end."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // (16 * bucket_bytes)))
    buckets = max(4 * parts, -(-total // bucket_bytes))
    freq = docs.mapInArrow(_frequencies(buckets, block_chars), ROWS)
    summed = (freq.repartition(parts, "bucket").sortWithinPartitions("bucket")
              .mapInArrow(_sums(model_path), ROWS))
    return (summed.repartition(parts, "block").sortWithinPartitions("block", F.desc("home"))
            .mapInArrow(_totals(model_path), "doc_id long, n_bytes long, n_tokens long"))

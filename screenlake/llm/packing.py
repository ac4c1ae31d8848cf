"""Packing by power-of-two decomposition.

A document's ids (with an end id) are cut into as many pieces of ``max_len`` as fit, then into one piece for each
binary digit of the rest, longest first.  Every piece is a sequence of its own, so none crosses documents
and none needs padding, and sequences of one length form a bucket (``write_buckets``).

Tokens never cross a shuffle: pieces are made where the text is read, and a sequence id is the number of the task's
partition with a counter, as ``monotonically_increasing_id`` has it; the same input partition gives the same ids again.

Defined cases: null or empty text gives one piece holding only the end id; rows with equal or null ids are packed separately;
an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LEN, END_ID = 2048, 1
# pre-tokens of the byte-level vocabulary (fixed value, public)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa0-\u024f\u0370-\u03ff\u0400-\u04ff\u2010-\u2027\u2030-\u205e\u20ac]")
ROWS = 64  # documents tokenized at a time
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class TextTokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit integers, as the tokenizer file gives them.

    The file's vocabulary numbers its merges in order, so tiktoken's encoder gives the same ids over it about
    four times as fast.  It is used for texts of characters whose classes agree in both pattern engines
    (none of ``UNUSUAL``) without the string of an added token; any other text goes through the tokenizer itself."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        special = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        self.special = tuple(special)
        to_byte = _byte_of_letter()
        ranks = {bytes(to_byte[c] for c in token): i for token, i in self.tok.get_vocab().items() if token not in special}
        self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[bytes]:
        odd = [any(a in t for a in self.special) or bool(UNUSUAL.search(t)) for t in texts]
        slow = iter(self.tok.encode_batch_fast([t for t, o in zip(texts, odd) if o], add_special_tokens=False))
        return [array("I", next(slow).ids).tobytes() if o else
                self.fast.encode_to_numpy(t, disallowed_special=()).astype("<u4").tobytes()
                for t, o in zip(texts, odd)]


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies spell printable bytes as themselves and the others as letters from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def cut_lengths(n: int, max_len: int = MAX_LEN) -> list[int]:
    """Lengths of the pieces of n ids: full ones, then the binary digits of the rest."""
    rest = n % max_len
    return [max_len] * (n // max_len) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``; ids are packed as
    little-endian unsigned 32-bit integers.  ``max_len`` is a power of two."""
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, made = TextTokenizer(tokenizer_path), TaskContext.get().partitionId() << 40
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                doc, start, length, ids, total = [], [], [], [], []
                for d, b in zip(part.column(0).to_pylist(),
                                tok.encode([t or "" for t in part.column(1).to_pylist()])):
                    b += end
                    n, pos = len(b) // 4, 0
                    for size in cut_lengths(n, max_len):
                        doc.append(d)
                        start.append(pos)
                        length.append(size)
                        ids.append(b[4 * pos:4 * (pos + size)])
                        total.append(n)
                        pos += size
                seq = np.arange(made, made + len(doc), dtype="int64")
                made += len(doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(ids, pa.binary()), pa.array(total, pa.int64()), pa.array(seq),
                     pa.array(np.zeros(len(doc), "int64"))],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SCHEMA)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Sequences by length, a folder for each power of two."""
    pieces.withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(path)


def ids_crc32(ids: Column) -> Column:
    return F.crc32(ids)

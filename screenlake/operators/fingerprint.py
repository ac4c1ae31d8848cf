"""Hashed fixed-width vectors from a string column (the Spark job shape of fingerprinting).

Every vector is made in the task that reads its text: batches of texts become arrays of unit codes (characters or
words), windows over them are numbered, each distinct token of a batch is hashed once, and one ``bincount`` gives the
counts of all rows.  No text and no token is ever shuffled; a batch is bounded by ``CELLS`` counters and units.

Modes mirror the reference's parameterisations:
  ngram(radius r)     substrings of 1..r+1 characters          (circular, radius 2/3)
  class ngram         the same after mapping characters to classes   (feature-class variant)
  key presence        a fixed dictionary of keys, one bit each  (key-dictionary variant)
  path4               shingles of exactly 4 word tokens        (torsion-like)
  token pairs         word pairs within a distance, with the distance  (pair-like)
Count vs binary output is ``binary=``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 1 << 20      # counters, and characters, of the texts looked at together
DIRECT = 1 << 22     # window numbers up to which a table, not a sort, tells the distinct ones
HASHED = 1 << 13     # tokens hashed together
BLOCK = 64           # bytes of an MD5 block, the last nine of them padding at least
WORD = re.compile("[^ \t\n\x0b\f\r]+")

# The character-class map of the class n-gram mode (letters -> vowel 'v'
# or consonant 'c', digits -> 'd'; everything else unchanged).
CLASS_FROM = "abcdefghijklmnopqrstuvwxyz0123456789"
CLASS_TO = "vcccvcccvcccccvcccccvccccc" + "dddddddddd"

# Fixed values (our own choice): the key dictionary of the key-presence mode
# (bit i = key i occurs in the text).
PRESENCE_KEYS = [
    "the", "and", "ing", "tion", "ent", "ion", "her", "for", "tha", "nth",
    "int", "ere", "tio", "ter", "est", "ers", "ati", "hat", "ate", "all",
    "eth", "hes", "ver", "his", "oft", "ith", "fth", "sth", "oth", "res",
    "ont", "de", "la", "le", "en", "es", "qu", "ei", "ch", "sch",
    ".", ",", "ou", "  ", "0", "1", "2", "@", "http", "://",
]


def class_map(text: Column) -> Column:
    return F.translate(F.lower(text), CLASS_FROM, CLASS_TO)


def valid_text(text: Column) -> Column:
    """A row is fingerprintable when its text is present and not blank."""
    return text.isNotNull() & (F.length(F.trim(text)) > 0)


# ---- tokens of a batch -----------------------------------------------------------------

def _numbered(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes (below ``size``), rising, and the place of each code among them."""
    if size > DIRECT:
        return np.unique(codes, return_inverse=True)
    there = np.zeros(size, bool)
    there[codes] = True
    own = np.flatnonzero(there)
    place = np.zeros(size, "int64")
    place[own] = np.arange(len(own))
    return own, place[codes]


def _bit_of(tokens: Iterator[str], n_bits: int) -> np.ndarray:
    """First 32 bits of each token's MD5, modulo the width."""
    digests = b"".join(hashlib.md5(t.encode()).digest()[:4] for t in tokens)
    return np.frombuffer(digests, ">u4").astype("int64") % n_bits


_SINES = [int(abs(math.sin(i + 1)) * 2 ** 32) for i in range(BLOCK)]
_TURNS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _first_bits(message: np.ndarray, length: np.ndarray) -> np.ndarray:
    """First 32 bits of the MD5 of each row's first ``length`` bytes (at most 55; the rest is zero), for all rows at once."""
    n = len(message)
    message[np.arange(n), length] = 0x80
    word = np.ascontiguousarray(message.view("<u4").T)
    word[14] = length * 8
    a, b, c, d = (np.full(n, v, "uint32") for v in _START)
    for i in range(BLOCK):
        if i < 16:
            f, g = d ^ (b & (c ^ d)), i
        elif i < 32:
            f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif i < 48:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * i % 16
        f += a
        f += np.uint32(_SINES[i])
        f += word[g]
        turn = _TURNS[i // 16][i % 4]
        turned = f << np.uint32(turn)
        turned |= f >> np.uint32(32 - turn)
        turned += b
        a, b, c, d = d, turned, b, c
    return (a + np.uint32(_START[0])).byteswap()


def _word_bits(names: list[bytes], words: np.ndarray, end: bytes, n_bits: int) -> np.ndarray:
    """As ``_bit_of`` for tokens that are words, each followed by a separator (the last one by ``end``): ``words`` has the words'
    places in ``names``, which hold the separators, a row for each token."""
    size = np.fromiter(map(len, names), "int64", len(names))
    place = np.concatenate([[0], np.cumsum(size)])
    units = np.frombuffer(b"".join(names) + b" ", "uint8")
    out = np.empty(len(words), "int64")
    for lo in range(0, len(words), HASHED):
        part = words[lo:lo + HASHED]
        total = size[part].sum(axis=1) + len(end)
        short = np.flatnonzero(total <= BLOCK - 9)
        message = np.zeros((len(short), BLOCK), "uint8")
        at = np.zeros(len(short), "int64")
        for column in part[short].T:
            own = size[column]
            inside = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            message.reshape(-1)[np.repeat(np.arange(len(short)) * BLOCK + at, own) + inside] = units[np.repeat(place[column], own) + inside]
            at += own
        for i, unit in enumerate(end):
            message[np.arange(len(short)), at + i] = unit
        out[lo + short] = _first_bits(message, total[short]) % n_bits
        for i in np.flatnonzero(total > BLOCK - 9):
            token = b"".join(names[w] for w in part[i]) + end
            out[lo + i] = int.from_bytes(hashlib.md5(token).digest()[:4], "big") % n_bits
    return out


def _char_tokens(texts: list[str], most: int, n_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bit) of every substring of 1..most characters, tagged with its width ('2:ab')."""
    units = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype("int64")
    length = np.array([len(t) for t in texts], "int64")
    row = np.repeat(np.arange(len(texts)), length)
    if not len(units):
        return
    last = np.repeat(np.cumsum(length), length)      # first place after the own text
    letters, code = _numbered(units, 0x110000)
    letters = [chr(c) for c in letters]
    names, number = letters, code
    for width in range(1, most + 1):
        if width > 1:
            starts = np.flatnonzero(np.arange(len(number)) + width <= last[:len(number)])
            own, dense = _numbered(number[starts] * len(letters) + code[starts + width - 1], len(names) * len(letters))
            names = [names[k // len(letters)] + letters[k % len(letters)] for k in own.tolist()]
            number = np.zeros(len(number), "int64")
            number[starts] = dense
        else:
            starts = np.arange(len(units))
        if len(starts):
            yield row[starts], _bit_of((f"{width}:{n}" for n in names), n_bits)[number[starts]]


def _word_codes(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Words in rising order, and of each word of the texts its code, its row and the first place after its text."""
    words = [WORD.findall(t) for t in texts]
    names = sorted(dict.fromkeys(chain.from_iterable(words)))
    place = dict(zip(names, range(len(names))))
    length = np.array([len(w) for w in words], "int64")
    code = np.fromiter(map(place.__getitem__, chain.from_iterable(words)), "int64", int(length.sum()))
    return names, code, np.repeat(np.arange(len(texts)), length), np.repeat(np.cumsum(length), length)


def _path_tokens(texts: list[str], size: int, n_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bit) of the shingles of exactly ``size`` words."""
    names, code, row, last = _word_codes(texts)
    at = np.flatnonzero(np.arange(len(code)) + size <= last)
    if len(at):
        # shingles are numbered word by word, which sorts one number a shingle; ``first`` is where each distinct one begins
        dense = code[at]
        for k in range(1, size):
            _, first, dense = np.unique(dense * len(names) + code[at + k], return_index=True, return_inverse=True)
        parts = [n.encode() + b" " for n in names] + [n.encode() for n in names]
        words = np.stack([code[at[first] + k] + (k == size - 1) * len(names) for k in range(size)], axis=1)
        yield row[at], _word_bits(parts, words, b"", n_bits)[dense]


def _pair_tokens(texts: list[str], far: int, n_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bit) of the unordered word pairs at distance 1..far, as 'a|b|d'."""
    names, code, row, last = _word_codes(texts)
    parts = [n.encode() + b"|" for n in names]
    for d in range(1, far + 1):
        at = np.flatnonzero(np.arange(len(code)) + d < last)
        if len(at):
            a, b = code[at], code[at + d]
            own, dense = np.unique(np.minimum(a, b) * len(names) + np.maximum(a, b), return_inverse=True)
            yield row[at], _word_bits(parts, np.stack([own // len(names), own % len(names)], axis=1), b"%d" % d, n_bits)[dense]


def _key_marks(texts: list[str], n_bits: int) -> np.ndarray:
    """1 at the number of each key that occurs in the text."""
    marks = np.zeros((len(texts), n_bits), "int64")
    for i, key in enumerate(PRESENCE_KEYS):
        marks[:, i] = [key in t for t in texts]
    return marks


MODES = ("ngram", "class_ngram", "path4", "token_pairs", "key_presence")


def check_mode(mode: str, n_bits: int) -> None:
    if mode not in MODES:
        raise ValueError(f"unknown fingerprint mode {mode}")
    if mode == "key_presence" and n_bits < len(PRESENCE_KEYS):
        raise ValueError(f"{len(PRESENCE_KEYS)} keys need as many bits")


def _counts(mode: str, texts: list[str], radius: int, n_bits: int) -> np.ndarray:
    """Token counts of each text by bit (rows x n_bits)."""
    if mode == "key_presence":
        return _key_marks(texts, n_bits)
    if mode in ("ngram", "class_ngram"):
        found = _char_tokens(texts, radius + 1, n_bits)
    elif mode == "path4":
        found = _path_tokens(texts, 4, n_bits)
    else:
        found = _pair_tokens(texts, 3, n_bits)
    total = np.zeros(len(texts) * n_bits, "int64")
    for row, bit in found:
        total += np.bincount(row * n_bits + bit, minlength=len(total))
    return total.reshape(len(texts), n_bits)


def _pieces(texts: list[str], n_bits: int) -> Iterator[tuple[int, int]]:
    return _ranges(map(len, texts), n_bits)


def _ranges(lengths: Iterable[int], n_bits: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts, of these lengths, with at most ``CELLS`` counters and characters, or one text."""
    lo = size = hi = 0
    for i, length in enumerate(lengths):
        if i > lo and ((i + 1 - lo) * n_bits > CELLS or size + length > CELLS):
            yield lo, i
            lo, size = i, 0
        size += length
        hi = i + 1
    if lo < hi:
        yield lo, hi


def _lengths(texts: pa.Array) -> list[int]:
    """Characters of each text, none for a missing one; the texts stay in Arrow."""
    return pc.fill_null(pc.utf8_length(texts), 0).to_pylist()


# ---- vectors ---------------------------------------------------------------------------

def _source(mode: str) -> str:
    return "mapped" if mode == "class_ngram" else "text"


def _bit_lists(df: DataFrame, id_col: str, text_col: str, kinds: dict[str, tuple[str, int, bool]], n_bits: int) -> DataFrame:
    """``id, kind, bits, counts`` of every valid text and kind, in one pass over the texts and without an exchange."""
    text = F.col(text_col)
    valid = df.filter(valid_text(text))
    for mode, *_ in kinds.values():
        check_mode(mode, n_bits)
    mapped = class_map(text) if any(m == "class_ngram" for m, *_ in kinds.values()) else F.lit("")
    src = valid.select(F.col(id_col).alias("id"), text.alias("text"), mapped.alias("mapped"))
    id_kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in _ranges(_lengths(batch.column(1)), n_bits):
                columns = {c: batch.column(i).slice(lo, hi - lo).to_pylist() for i, c in ((1, "text"), (2, "mapped"))}
                for kind, (mode, radius, binary) in kinds.items():
                    count = _counts(mode, columns[_source(mode)], radius, n_bits)
                    row, bit = np.nonzero(count)
                    value = np.ones(len(row), "int64") if binary else count[row, bit]
                    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=hi - lo))]).astype("int32")
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(lo, hi - lo), pa.array([kind] * (hi - lo)),
                         pa.ListArray.from_arrays(ends, pa.array(bit.astype("int32"))), pa.ListArray.from_arrays(ends, pa.array(value))],
                        ["id", "kind", "bits", "counts"])

    return src.mapInArrow(run, f"id {id_kind}, kind string, bits array<int>, counts array<bigint>")


def _long(lists: DataFrame, id_col: str, *more: str) -> DataFrame:
    pairs = lists.select("id", *more, F.explode(F.arrays_zip("bits", "counts")).alias("b"))
    return pairs.select(F.col("id").alias(id_col), *more, F.col("b.bits").alias("bit"), F.col("b.counts").alias("value"))


def sparse_fingerprint(df: DataFrame, id_col: str, text_col: str, mode: str = "ngram",
                       radius: int = 2, n_bits: int = 2048, binary: bool = False) -> DataFrame:
    """Long form (id, bit, value): value = token count (or 1 when ``binary``).
    Invalid rows produce no entries; see ``with_vectors``."""
    return _long(_bit_lists(df, id_col, text_col, {mode: (mode, radius, binary)}, n_bits), id_col)


def with_vectors(df: DataFrame, text_col: str, mode: str = "ngram", radius: int = 2, n_bits: int = 2048,
                 binary: bool = False, name: str = "fp", flag: str = "is_valid") -> DataFrame:
    """The source columns with a vector (array<int> of width n_bits) and a validity flag beside them, map-only.
    Invalid rows get a NULL vector and ``false``; valid rows without tokens get all zeros."""
    check_mode(mode, n_bits)
    text = F.col(text_col)
    ok = F.coalesce(valid_text(text), F.lit(False))
    src = df.withColumn(flag, ok).withColumn("_units", F.when(ok, class_map(text) if mode == "class_ngram" else text))
    columns = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in _ranges(_lengths(batch.column(batch.num_columns - 1)), n_bits):
                texts = batch.column(batch.num_columns - 1).slice(lo, hi - lo).to_pylist()
                there = np.array([t is not None for t in texts])
                count = _counts(mode, [t for t in texts if t is not None], radius, n_bits)
                flat = pa.array((np.minimum(count, 1) if binary else count).astype("int32").ravel())
                ends = np.concatenate([[0], np.cumsum(there) * n_bits]).astype("int32")
                vectors = pa.ListArray.from_arrays(ends, flat, mask=pa.array(~there))
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], vectors],
                                                 [*columns, flag, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]) + f", `{name}` array<int>"
    return src.mapInArrow(run, schema).select(*[F.col(f"`{c}`") for c in columns], name, flag)


def dense_vectors(df: DataFrame, id_col: str, text_col: str, mode: str = "ngram", radius: int = 2,
                  n_bits: int = 2048, binary: bool = False) -> DataFrame:
    """(id, fp array<int> of width n_bits) of the valid rows, map-only."""
    return with_vectors(df.select(id_col, text_col), text_col, mode, radius, n_bits, binary).filter("is_valid").select(id_col, "fp")


def dense_fingerprint(sparse: DataFrame, id_col: str, n_bits: int = 2048) -> DataFrame:
    """Sparse (id, bit, value) -> (id, fp array<int> of width n_bits).  One group per row id,
    bounded by n_bits entries; a batch of groups is scattered at once."""
    @F.arrow_udf("array<int>")
    def scatter(bits: pa.Array, values: pa.Array) -> pa.Array:
        row = np.repeat(np.arange(len(bits)), bits.value_lengths().to_numpy())
        dense = np.zeros(len(bits) * n_bits, "int32")
        dense[row * n_bits + bits.flatten().to_numpy()] = values.flatten().to_numpy()
        return pa.ListArray.from_arrays(np.arange(len(bits) + 1, dtype="int32") * n_bits, pa.array(dense))

    per = sparse.groupBy(id_col).agg(F.collect_list("bit").alias("_b"), F.collect_list("value").alias("_v"))
    return per.select(id_col, scatter("_b", "_v").alias("fp"))


# Fingerprint kinds by name -> (mode, radius, binary).
KINDS = {
    "ngram_r2": ("ngram", 2, False),
    "ngram_r3": ("ngram", 3, False),
    "class_ngram_r2": ("class_ngram", 2, False),
    "class_ngram_r3": ("class_ngram", 3, False),
    "key_presence": ("key_presence", 0, True),
    "path4": ("path4", 0, True),
    "token_pairs": ("token_pairs", 0, True),
}


def fingerprints(df: DataFrame, id_col: str, text_col: str, kinds: list[str],
                 n_bits: int = 2048) -> DataFrame:
    """Several kinds in one long table (id, kind, bit, value), in one pass over the texts; unknown kind names are
    ignored, as are repeated ones."""
    chosen = {k: KINDS[k] for k in kinds if k in KINDS}
    if not chosen:
        return df.select(id_col, F.lit(None).cast("string").alias("kind"), F.lit(None).cast("int").alias("bit"),
                         F.lit(None).cast("bigint").alias("value")).limit(0)
    return _long(_bit_lists(df, id_col, text_col, chosen, n_bits), id_col, "kind")

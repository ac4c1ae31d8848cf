"""Exact Jaccard join of documents as a metric-space join.

A document is its set of word shingles; Jaccard distance d = 1 - |A n B| / |A u B| is a metric, and two sets link when
d <= e.  The join goes down through regions around pivots and loses no link:

1. Root regions.  Sizes fall into bands, so that linked sets lie in one band or in neighbouring ones, and differ in at most t
   shingles, t given by the band and e.  A band deals all shingles into m > t parts; the parts are pivots, a set's trace in
   a part is its place there, and sets with one trace form a cell.  Linked sets have one trace in at least m - t parts, so each set is replicated to
   its cells in all parts (of its own band, and of the next one where a partner can be that large) and linked sets meet at least once.
   Traces are of rare shingles alone: those that ``FREQUENT`` sets or more hold (or a higher power of two of them, so many as a bitmap
   of fixed size tells apart) would tie documents that only share a passage.  Linked sets differ in at most t rare shingles too.  Empty
   traces are left out: where a set has at most m - t - 1 of them, another cell remains to meet in.  Sets with more empty traces, which
   consist of frequent shingles, are dealt a second time with all their shingles, and meet each other there.  Sets that meet are tied to the smallest one in the cell; the components of these ties are regions that no link leaves.  Cells are first exchanged as
   48-bit hashes alone; sets travel (as digests) only to cells that hold two of them, by a bitmap of fixed size.  Bitmaps are
   put together in tasks, each for a range of the places, so that the driver gets a few pieces and no row for a word or a bit.  A
   task ties the sets of a cell among themselves and sends one of them.
2. Inside a region, sets are pivots in turn.  Those within e of the pivot link to it.  A link from one of them to a set
   outside leads to the ring e < d <= 2e around the pivot (triangle inequality), and from a ring set at
   distance r only to those at r - e or more.  These windows are compared, then the pivot and its ball leave and the rest of the region
   is joined recursively.
3. A region above ``LIMIT`` shingles, or of so many sets that a task would compare too long, is split over tasks.  ``PIVOTS`` pivots are
   compared with all its sets, which gathers large clusters.  What is left is joined in the cells of the root, where linked
   sets meet: first each set with one partner of a cell, then all pairs of a cell whose components still differ.  Only pairs whose
   sizes and sketches (which bound the shingles not shared from below) allow a link are compared.  The steps are as many for any region.

Identical sets are one class from the start.  Links found are those to pivots and one per ring set, which is all
that components need; no group is expanded into pairs.

Defined cases: null, empty or blank text has an empty set and no link; with fewer words than a shingle the whole
sequence is the only one; rows with a null doc_id take part, components ignore their id; repeated rows stay; an empty
table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenlake.llm.components import components
from screenlake.llm.tables import text_or_empty, whole_rows
from screenlake.session import cut_lineage, stored

LIMIT, PIVOTS = 4_000_000, 32
COMPARED = 2000  # a region's sets times its shingles, above ``LIMIT`` times this it is split
FREQUENT, HEAVY_BITS = 16, 1 << 25
BLOCK = 4_000_000  # shingles of a bucket, on the average
MEMBER_BITS, CELL_BITS = 1 << 23, 1 << 25
PENDING = 2_000_000  # cells of sets a task gathers before it sends them
_KEYS = 1 << 16  # sets a task gathers at most
_PIECE = 1 << 20  # bytes of text hashed at a time, or one document
_BYTE = np.random.default_rng(9).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_M = 0x9E3779B97F4A7C15
_INV = pow(_M, -1, 1 << 64)
_C1, _C2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFF51AFD7ED558CCD)


def _mixed(h: np.ndarray, c: np.uint64 = _C1) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * c
    return h ^ (h >> np.uint64(29))


def _power_table(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out[:n]


class Shingler:
    """Shingle sets of texts given as bytes: sorted distinct 64-bit hashes."""

    def __init__(self, words: int):
        self.words = words
        self.up, self.down = _power_table(_M, _PIECE + 1), _power_table(_INV, _PIECE + 1)

    def sets(self, texts: pa.Array) -> Iterator[np.ndarray]:
        texts = texts.cast(pa.large_binary())
        if not len(texts):
            return
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        i = 0
        while i < len(texts):
            j = i + 1
            while j < len(texts) and bounds[j + 1] - bounds[i] <= _PIECE:
                j += 1
            yield from self._piece(data[bounds[i]:bounds[j]], bounds[i:j + 1] - bounds[i])
            i = j

    def _piece(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        n = len(data)
        if n >= len(self.up):
            self.up, self.down = _power_table(_M, n + 1), _power_table(_INV, n + 1)
        solid = ~_BLANK[data]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        inner = bounds[1:-1]
        cut = inner[inner < n]
        first[cut] = solid[cut]
        last = solid.copy()
        last[:-1] &= ~solid[1:]
        cut = inner[(inner > 0)] - 1
        last[cut] = solid[cut]
        begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * self.up[:n], out=total[1:])
        word = _mixed((total[end] - total[begin]) * self.down[begin])
        of = np.searchsorted(begin, bounds)
        k = self.words
        rolled = np.zeros(max(len(word) - k + 1, 0), np.uint64)
        for t in range(k):
            rolled = rolled * np.uint64(_M) + word[t:t + len(rolled)]
        rolled = _mixed(rolled)
        for a, b in zip(of[:-1], of[1:]):
            if b - a >= k:
                yield np.unique(rolled[a:b - k + 1])
            elif b > a:
                h = np.zeros(1, np.uint64)
                for w in word[a:b]:
                    h = h * np.uint64(_M) + w
                yield _mixed(h + np.uint64(b - a), _C2)
            else:
                yield np.zeros(0, np.uint64)


def set_key(tokens: np.ndarray) -> bytes:
    """128-bit digest of a set."""
    a = np.add.reduce(_mixed(tokens, _C2))
    b = np.bitwise_xor.reduce(_mixed(tokens + np.uint64(len(tokens))))
    return a.astype(">u8").tobytes() + b.astype(">u8").tobytes()


# ---- root regions ----------------------------------------------------------------------------------------------------

class Bands:
    """Bands of set sizes, and the parts of each."""

    def __init__(self, near: Fraction):
        self.near, self.low, self.high, self.parts, self.spare = near, [1], [], [], []
        self._grow(1)

    def _grow(self, n: int) -> None:
        near = self.near
        while not self.high or self.high[-1] < n:
            high = int(self.low[-1] / near)
            apart = int((1 - near) / (1 + near) * 2 * high)  # shingles in which linked sets of the band differ at most
            # parts that the band's smallest sets leave empty are about Poisson; few sets have more than ``spare``
            spare = 0
            for _ in range(8):
                empty = (apart + 1 + spare) * float(np.exp(-float(high * near * near / (apart + 1 + spare))))
                spare = max(spare, int(np.ceil(empty + 4 * empty ** 0.5)) if empty > 1e-3 else 0)
            self.high.append(high)
            self.parts.append(apart + 1 + spare)
            self.spare.append(spare)
            self.low.append(high + 1)

    def of(self, n: int) -> list[int]:
        """The band of a size, and the next one if a linked set may lie there."""
        self._grow(int(n / self.near) + 1)
        own = int(np.searchsorted(self.high, n))
        return [own, own + 1] if int(n / self.near) >= self.low[own + 1] else [own]

    def cells(self, tokens: np.ndarray, rare: np.ndarray | None = None) -> np.ndarray:
        """48-bit hashes of the cells of a set: band, part and trace of its rare shingles (all without ``rare``), and
        of all of them where too few are rare."""
        rare, out = tokens if rare is None else rare, []
        for band in self.of(len(tokens)):
            cell, empty = self._dealt(rare, band, 0)
            out.append(cell[~empty])
            if empty.sum() > self.spare[band]:
                cell, empty = self._dealt(tokens, band, 1)
                out.append(cell[~empty] if empty.sum() <= self.spare[band] else cell)
        return np.concatenate(out)

    def _dealt(self, tokens: np.ndarray, band: int, dealing: int) -> tuple[np.ndarray, np.ndarray]:
        """The cell of every part, and which traces are empty."""
        m = self.parts[band]
        mixed = _mixed(tokens + np.uint64(band * 2 + 1), _C2)
        part = (mixed % np.uint64(m)).astype(np.int64)
        trace = np.zeros(m, np.uint64)
        np.add.at(trace, part, _mixed(mixed))
        place = np.uint64(_M) * np.arange(1, m + 1, dtype=np.uint64) + np.uint64((band << 40) + (dealing << 60))
        return _mixed(trace + place) & np.uint64((1 << 48) - 1), np.bincount(part, minlength=m) == 0


_ROOT_SQL = "bucket int, tie boolean, a binary, b binary"
_ROOT = pa.schema([("bucket", pa.int32()), ("tie", pa.bool_()), ("a", pa.binary()), ("b", pa.binary())])
_COUNT = pa.schema([("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])
_LINK = pa.schema([("a", pa.binary()), ("b", pa.binary())])
_LINK_SQL = "a binary, b binary"
_PIECE_SQL = "at long, words binary"


def _batch(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * len(schema), schema)], schema=schema)


def _packed(h: np.ndarray, width: int) -> bytes:
    """The low bytes of each value, the highest ones of all values first: those of sorted values repeat, which compresses."""
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, width - 1::-1].T.tobytes()


def _unpacked(raws: list[bytes], width: int) -> np.ndarray:
    n = [len(raw) // width for raw in raws]
    out, at = np.zeros((sum(n), 8), np.uint8), 0
    for raw, k in zip(raws, n):
        out[at:at + k, :width] = np.frombuffer(raw, np.uint8).reshape(width, k)[::-1].T
        at += k
    return out.view("<u8").ravel()


def _starts(values: np.ndarray) -> np.ndarray:
    """Where the runs of equal values start."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)


def _spot(value: np.ndarray, width: int, bits: int) -> np.ndarray:
    """Places of values of ``width`` bits in a bitmap: their highest bits, so that sorted values have sorted places."""
    return (value >> np.uint64(width - bits.bit_length() + 1)).astype(np.int64)


def _cell_spot(cell: np.ndarray) -> np.ndarray:
    return _spot(cell, 48, CELL_BITS)


def _by_bucket(spot: np.ndarray, bits: int, buckets: int) -> Iterator[tuple[int, slice]]:
    """(bucket, where its values lie) of sorted values; buckets are ranges of the bitmap's words, so each makes a piece of it."""
    to = (spot >> 6) * buckets // (bits >> 6)
    edge = np.append(_starts(to), len(to))
    for i, j in zip(edge, edge[1:]):
        yield int(to[i]), slice(i, j)


def _short(tokens: np.ndarray) -> np.ndarray:
    """40 bits of shingles, by which they are counted."""
    return tokens >> np.uint64(24)


def _short_spot(short: np.ndarray) -> np.ndarray:
    return _spot(short, 40, HEAVY_BITS)


def _holds(bits: np.ndarray, spot: np.ndarray) -> np.ndarray:
    return bits[spot >> 6] >> (spot & 63) & 1 == 1


def _counts(words: int, buckets: int):
    """Arrow batches of (body) -> shingles of a task's sets by bucket, with the number of sets that hold them (255 or more: 255)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, seen, sets, pending = Shingler(words), set(), [], 0

        def send() -> pa.RecordBatch:
            value, count = np.unique(np.concatenate(sets), return_counts=True)
            count = np.minimum(count, 255).astype(np.uint8)
            return _batch(_COUNT, [(to, _packed(value[at], 5), count[at].tobytes())
                                   for to, at in _by_bucket(_short_spot(value), HEAVY_BITS, buckets)])

        for batch in batches:
            for s in make.sets(batch.column(0)):
                if len(s) and (key := set_key(s)) not in seen:
                    seen.add(key)
                    sets.append(_short(s))
                    pending += len(s)
                    if pending > PENDING:
                        yield send()
                        sets, pending = [], 0
        if sets:
            yield send()

    return run


def _piece(spot: np.ndarray) -> pa.Table:
    """The words of a bitmap from the first to the last that has one of these places."""
    at = int(spot.min() >> 6) if len(spot) else 0
    held = np.zeros((int(spot.max() >> 6) - at + 1 if len(spot) else 0) * 64, bool)
    held[spot - at * 64] = True
    rows = slice(0, 1 if len(spot) else 0)
    return pa.table({"at": pa.array([at][rows], pa.int64()), "words": pa.array([np.packbits(held, bitorder="little").tobytes()][rows], pa.binary())})


def _bitmap(pieces: DataFrame, bits: int) -> np.ndarray:
    """(at, words) rows, at most as many as there are ranges, as one array."""
    out = np.zeros(bits // 64, np.int64)
    for r in pieces.collect():
        words = np.frombuffer(r["words"], "<i8")
        out[r["at"]:r["at"] + len(words)] |= words
    return out


def _frequent(rows: pa.Table) -> pa.Table:
    """Of a bucket's shingles those that ``FREQUENT`` sets hold: a row for each binary logarithm of the number, with their places in the bitmap."""
    value = _unpacked(rows.column("a").to_pylist(), 5)
    count = np.frombuffer(b"".join(rows.column("b").to_pylist()), np.uint8)
    order = np.argsort(value)
    start = _starts(value[order])
    total = np.add.reduceat(count[order].astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
    many = total >= FREQUENT
    spot, level = _short_spot(value[order][start][many]).astype("<i4"), np.log2(total[many]).astype(np.int32)
    of = [(int(x), spot[level == x]) for x in np.unique(level)]
    return pa.table({"bucket": pa.array([rows.column("bucket")[0].as_py()] * len(of), pa.int32()), "level": pa.array([x for x, _ in of], pa.int32()),
                     "n": pa.array([len(y) for _, y in of], pa.int64()), "spots": pa.array([y.tobytes() for _, y in of], pa.binary())})


def _frequent_piece(rows: pa.Table) -> pa.Table:
    return _piece(np.frombuffer(b"".join(rows.column("spots").to_pylist()), "<i4").astype(np.int64))


def _heavy(body: DataFrame, words: int, buckets: int) -> np.ndarray:
    """Bitmap of frequent shingles, at most one bit in 16 set."""
    found = cut_lineage(body.mapInArrow(_counts(words, buckets), "bucket int, a binary, b binary")
                        .groupBy("bucket").applyInArrow(_frequent, "bucket int, level int, n long, spots binary"))
    above, least = 0, 64
    for r in found.groupBy("level").agg(F.sum("n").alias("n")).orderBy(F.desc("level")).collect():  # one row a power of two
        above += r["n"]
        if above > HEAVY_BITS // 16:
            break
        least = r["level"]
    return _bitmap(found.where(F.col("level") >= least).select("bucket", "spots").groupBy("bucket").applyInArrow(_frequent_piece, _PIECE_SQL), HEAVY_BITS)


def _cells(words: int, near: Fraction, buckets: int, heavy, wanted=None):
    """Arrow batches of (body) -> without ``wanted`` the cells of a task with a flag for those it has twice; with it (a bitmap) the
    cells it lets through with one set each, and the ties of a cell's other sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, bands, keys, index, cells, many = Shingler(words), Bands(near), [], set(), [], []
        bits = wanted.value if wanted is not None else None
        often = heavy.value
        pending = 0

        def send() -> pa.RecordBatch:
            cell = np.concatenate(cells)
            cells.clear()
            if bits is None:
                cell.sort()
                start = _starts(cell)
                twice, first = np.diff(np.append(start, len(cell))) > 1, cell[start]
                return _batch(_ROOT, [(to, None, _packed(first[at], 6), np.packbits(twice[at]).tobytes())
                                      for to, at in _by_bucket(_cell_spot(first), CELL_BITS, buckets)])
            halves = np.frombuffer(b"".join(keys), ">u8").reshape(-1, 2)
            by_value = np.lexsort((halves[:, 1], halves[:, 0]))
            place = np.empty(len(keys), np.uint64)
            place[by_value] = np.arange(len(keys), dtype=np.uint64)
            cell <<= np.uint64(16)  # a cell has 48 bits, the place of its set 16: one value to sort
            cell |= np.repeat(place, many)
            cell.sort()
            own = by_value[(cell & np.uint64(_KEYS - 1)).astype(np.int64)]
            cell >>= np.uint64(16)
            start = _starts(cell)
            head = np.repeat(start, np.diff(np.append(start, len(cell))))
            name = np.frombuffer(b"".join(keys), "V16")
            tied = np.unique((own * len(keys) + own[head])[own != own[head]])
            first, of = cell[start], own[start]
            rows = [(to, False, _packed(first[at], 6), name[of[at]].tobytes()) for to, at in _by_bucket(_cell_spot(first), CELL_BITS, buckets)]
            if len(tied):
                rows.append((int(tied[0] % buckets), True, name[tied // len(keys)].tobytes(), name[tied % len(keys)].tobytes()))
            return _batch(_ROOT, rows)

        for batch in batches:
            for s in make.sets(batch.column(0)):
                if not len(s):
                    continue
                key = set_key(s)
                if key in index:
                    continue
                index.add(key)
                mine = bands.cells(s, s[~_holds(often, _short_spot(_short(s)))])
                if bits is not None:
                    mine = mine[_holds(bits, _cell_spot(mine))]
                if len(mine):
                    cells.append(mine)
                    many.append(len(mine))
                    keys.append(key)
                    pending += len(mine)
                if pending > PENDING or len(keys) == _KEYS:
                    yield send()
                    keys, cells, many, pending = [], [], [], 0
                    index.clear()
        if keys:
            yield send()

    return run


def _held_twice(rows: pa.Table) -> pa.Table:
    """Of a bucket's cells those with two sets, as a piece of the bitmap."""
    cell = [_unpacked([a], 6) for a in rows.column("a").to_pylist()]
    twice = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(c)).astype(bool) for b, c in zip(rows.column("b").to_pylist(), cell)]
    cell, twice = np.concatenate(cell), np.concatenate(twice)
    values = np.sort(cell)
    start = _starts(values)
    several = values[start[np.diff(np.append(start, len(values))) > 1]]
    return _piece(_cell_spot(np.concatenate([several, cell[twice]])))


def _meet(rows: pa.Table) -> pa.Table:
    """Ties the sets that meet in a cell to the smallest of them; ties found by tasks pass."""
    tie = np.array(rows.column("tie").to_pylist(), bool)
    a, b = rows.column("a").to_pylist(), rows.column("b").to_pylist()
    both = lambda xs: np.frombuffer(b"".join(xs), np.uint8).reshape(-1, 16)
    ready = np.concatenate([both([x for x, t in zip(a, tie) if t]), both([x for x, t in zip(b, tie) if t])], axis=1)
    cell = _unpacked([x for x, t in zip(a, tie) if not t], 6)
    key = both([x for x, t in zip(b, tie) if not t])
    high, low = key[:, :8].copy().view(">u8").ravel(), key[:, 8:].copy().view(">u8").ravel()
    order = np.lexsort((low, high, cell))
    start = _starts(cell[order])
    head = np.repeat(start, np.diff(np.append(start, len(order))))
    x, y = key[order], key[order][head]
    pairs = np.unique(np.concatenate([np.concatenate([x, y], axis=1)[(x != y).any(axis=1)], ready]), axis=0)
    return pa.table({"a": pa.array([p[:16].tobytes() for p in pairs], pa.binary()),
                     "b": pa.array([p[16:].tobytes() for p in pairs], pa.binary())})


def _sizes(words: int):
    """Arrow batches of (doc_id, body, text_key) -> (doc_id, n_shingles, set_key, text_key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Shingler(words)
        for batch in batches:
            sets = [(len(s), set_key(s) if len(s) else None) for s in make.sets(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _ in sets], pa.int64()), pa.array([k for _, k in sets], pa.binary()), batch.column(2)],
                ["doc_id", "n_shingles", "set_key", "text_key"])

    return run


# ---- inside a region -------------------------------------------------------------------------------------------------

class _Sets:
    """Sets of a region end to end, with local token numbers."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets])
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        _, self.local = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(int(self.local.max()) + 1 if len(self.local) else 1, bool)

    def of(self, i: int) -> np.ndarray:
        return self.local[self.start[i]:self.start[i + 1]]

    def shared(self, i: int, others: np.ndarray) -> np.ndarray:
        """Shingles that set i shares with each of the others."""
        size = self.size[others]
        begin = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(begin, size) + np.repeat(self.start[others], size)
        self.mark[self.of(i)] = True
        out = np.add.reduceat(self.mark[self.local[place]].astype(np.int64), begin)
        self.mark[self.of(i)] = False
        return out


def _linked(shared, n, m, near: Fraction):
    return shared * near.denominator >= near.numerator * (n + m - shared)


def join_region(sets: list[np.ndarray], near: Fraction) -> list[tuple[int, int]]:
    """Links of a region that keep its components: (set, pivot) for every set within reach of a pivot, and one link
    of each ring set that has any in the pivot's ball."""
    if len(sets) < 2:
        return []
    s = _Sets(sets)
    reach = float(1 - near)
    links: list[tuple[int, int]] = []
    active = np.argsort(s.size, kind="stable")
    while len(active) > 1:
        p, rest = int(active[0]), active[1:]
        # a linked set has at most n / near shingles; its ball's links lead to at most n / near^2
        rest_near = rest[s.size[rest] * near.numerator ** 2 <= s.size[p] * near.denominator ** 2]
        if not len(rest_near):
            active = rest
            continue
        shared = s.shared(p, rest_near)
        union = s.size[p] + s.size[rest_near] - shared
        d = 1 - shared / union
        ball = _linked(shared, s.size[p], s.size[rest_near], near)
        links += [(int(x), p) for x in rest_near[ball]]
        inside, d_in = rest_near[ball], d[ball]
        ring = ~ball & (d <= 2 * reach + 1e-9)
        for z, r in zip(rest_near[ring], d[ring]):
            window = inside[d_in >= r - reach - 1e-9]
            if len(window):
                hit = _linked(s.shared(int(z), window), s.size[z], s.size[window], near)
                if hit.any():
                    links.append((int(z), int(window[hit.argmax()])))
        active = rest[~np.isin(rest, inside, assume_unique=True)] if len(inside) else rest
    return links


def _regions(near: Fraction):
    """Arrow batches of (region, key, tokens) sorted by region -> links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, keys, sets = None, [], []

        def links() -> pa.RecordBatch:
            found = join_region(sets, near)
            return pa.RecordBatch.from_pydict({"a": pa.array([keys[i] for i, _ in found], pa.binary()),
                                               "b": pa.array([keys[j] for _, j in found], pa.binary())})

        for batch in batches:
            for r, k, t in zip(*(c.to_pylist() for c in batch.columns)):
                if r != region:
                    if len(keys) > 1:
                        yield links()
                    region, keys, sets = r, [], []
                keys.append(k)
                sets.append(np.frombuffer(t, "<u8"))
        if len(keys) > 1:
            yield links()

    return run


def _to_pivots(near: Fraction):
    """Arrow batches of (key, tokens, pivots) -> links of each set to its region's pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for k, t, pivots in zip(*(c.to_pylist() for c in batch.columns)):
                mine = np.frombuffer(t, "<u8")
                for p in pivots:
                    other = np.frombuffer(p["tokens"], "<u8")
                    if k != p["key"] and _linked(len(np.intersect1d(mine, other, assume_unique=True)), len(mine), len(other), near):
                        a.append(k)
                        b.append(p["key"])
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _sketch(tokens: np.ndarray) -> bytes:
    """256 bits; a bit that one set has and another lacks stands for a shingle, at least, that they don't share."""
    bits = np.zeros(256, bool)
    bits[(tokens & np.uint64(255)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


_SEAT = pa.schema([("cell", pa.int64()), ("key", pa.binary()), ("n", pa.int64()), ("label", pa.binary()), ("sketch", pa.binary())])
_SEAT_SQL = "cell long, key binary, n long, label binary, sketch binary"


def _seats(near: Fraction, heavy):
    """Arrow batches of (key, tokens, label) -> a row for each cell of a set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, often = Bands(near), heavy.value

        def sent(cells: list[np.ndarray], rows: list[tuple]) -> pa.RecordBatch:
            at = pa.array(np.repeat(np.arange(len(rows)), [len(c) for c in cells]), pa.int64())
            each = [pa.array(c, f.type).take(at) for c, f in zip(zip(*rows), list(_SEAT)[1:])]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(cells).astype(np.int64)), *each], schema=_SEAT)

        for batch in batches:
            cells, rows, pending = [], [], 0
            for k, t, label in zip(*(c.to_pylist() for c in batch.columns)):
                s = np.frombuffer(t, "<u8")
                cells.append(np.unique(bands.cells(s, s[~_holds(often, _short_spot(_short(s)))])))
                rows.append((k, len(s), label, _sketch(s)))
                pending += len(cells[-1])
                if pending > 1 << 16:
                    yield sent(cells, rows)
                    cells, rows, pending = [], [], 0
            if rows:
                yield sent(cells, rows)

    return run


def _fixed(c: pa.Array, words: int) -> np.ndarray:
    """Binary values of 8 * ``words`` bytes each, as rows of numbers."""
    return np.frombuffer(b"".join(c.to_pylist()), np.uint64).reshape(-1, words)


def _pairs(near: Fraction, every: bool):
    """Arrow batches of seats sorted by cell and key -> pairs of a cell that may link and have different labels: all of them, or
    one earlier partner for each set."""
    up, down = near.numerator, near.denominator

    def may_link(x, y, n, label, sketch) -> np.ndarray:
        out = (label[x] != label[y]).any(axis=1) & (n[x] * down >= n[y] * up) & (n[y] * down >= n[x] * up)
        for a, b in ((x, y), (y, x)):
            # linked sets share (n + m) * near / (1 + near) shingles or more
            alone = np.bitwise_count(sketch[a] & ~sketch[b]).sum(axis=1, dtype=np.int64)
            out &= (n[a] - alone) * (up + down) >= (n[a] + n[b]) * up
        return out

    def found(cell, key, n, label, sketch) -> pa.RecordBatch:
        later, earlier = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        met = np.zeros(len(cell), bool)
        i, d = np.arange(len(cell)), 0
        while len(i):  # all pairs d places apart, of all cells
            d += 1
            i = i[i + d < len(cell)]
            i = i[cell[i] == cell[i + d]]
            x = i if every else i[~met[i + d]]
            x = x[may_link(x, x + d, n, label, sketch)]
            met[x + d] = True
            earlier.append(x)
            later.append(x + d)
        name = lambda at: pa.array([r.tobytes() for r in key[np.concatenate(at)]], pa.binary())
        return pa.RecordBatch.from_arrays([name(later), name(earlier)], schema=_LINK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(0).to_numpy(), _fixed(batch.column(1), 2), batch.column(2).to_numpy(), _fixed(batch.column(3), 2), _fixed(batch.column(4), 4)]
            rows = rows if kept is None else [np.concatenate(z) for z in zip(kept, rows)]
            last = int(np.searchsorted(rows[0], rows[0][-1]))  # its cell may go on
            kept = [z[last:] for z in rows]
            yield found(*(z[:last] for z in rows))
        if kept is not None:
            yield found(*kept)

    return run


def _verified(near: Fraction):
    """Arrow batches of (a, b, tokens of a, tokens of b) -> those that link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            hit = []
            for x, y in zip(a, b):
                x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
                hit.append(_linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), near))
            yield batch.select([0, 1]).filter(pa.array(hit, pa.bool_()))

    return run


def _large_regions(sets: DataFrame, near: Fraction, heavy) -> DataFrame:
    """Links of regions too large for a task, in three steps over all their sets."""
    order = Window.partitionBy("region").orderBy(F.xxhash64("key"), "key")
    chosen = stored(sets.select("region", "key").withColumn("i", F.row_number().over(order)).where(F.col("i") <= PIVOTS).select("region", "key"))
    pivots = (sets.select("key", "tokens").join(chosen.hint("merge"), "key").groupBy("region")
              .agg(F.collect_list(F.struct("key", "tokens")).alias("pivots")))
    links = stored(sets.join(pivots.hint("merge"), "region").select("key", "tokens", "pivots").mapInArrow(_to_pivots(near), _LINK_SQL))
    tokens = sets.select("key", "tokens")
    for every in (False, True):
        label = components(links).withColumnRenamed("node", "key")
        seats = (tokens.join(label.hint("merge"), "key", "left").select("key", "tokens", F.coalesce("label", "key").alias("label"))
                 .mapInArrow(_seats(near, heavy), _SEAT_SQL).repartition("cell").sortWithinPartitions("cell", "key"))
        pairs = stored(seats.mapInArrow(_pairs(near, every), _LINK_SQL).distinct())
        of = lambda side: tokens.select(F.col("key").alias(side), F.col("tokens").alias(f"tokens_{side}")).hint("merge")
        met = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "tokens_a", "tokens_b")
        links = stored(links.unionByName(met.mapInArrow(_verified(near), _LINK_SQL)))
    return links


# ---- the join --------------------------------------------------------------------------------------------------------

def _members(nodes: DataFrame) -> np.ndarray:
    """Bitmap of set keys (MEMBER_BITS bits, fixed size)."""
    spot = F.conv(F.hex(F.substring("node", 14, 3)), 16, 10).cast("long").bitwiseAND(F.lit(MEMBER_BITS - 1))
    pieces = (nodes.select(spot.alias("spot")).select("spot", F.expr(f"spot div {MEMBER_BITS // 1024}").alias("range")).groupBy("range")
              .applyInArrow(lambda rows: _piece(rows.column("spot").to_numpy()), _PIECE_SQL))
    return _bitmap(pieces, MEMBER_BITS)


def _has(bits: np.ndarray, key: bytes) -> bool:
    spot = int.from_bytes(key[13:], "big") & (MEMBER_BITS - 1)
    return bool(int(bits[spot >> 6]) >> (spot & 63) & 1)


def _sets_of(words: int, members):
    """Arrow batches of (body) -> (key, n, tokens) of the sets that the bitmap lets through, each once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, bits, seen = Shingler(words), members.value, set()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                rows = []
                for s in make.sets(batch.slice(lo, 256).column(0)):
                    if len(s) and (key := set_key(s)) not in seen and _has(bits, key):
                        seen.add(key)
                        rows.append((key, len(s), s.astype("<u8").tobytes()))
                k, n, t = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_pydict({"key": pa.array(k, pa.binary()), "n": pa.array(n, pa.int64()), "tokens": pa.array(t, pa.binary())})

    return run


def text_key(body):
    """128-bit digest of a text's bytes."""
    return F.unhex(F.md5(body))


def jaccard_join(docs: DataFrame, words: int = 3, near: Fraction = Fraction(9, 10), limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    """(members, links): ``doc_id, n_shingles, set_key, text_key`` of every row, and links ``a, b`` between keys of different sets
    that join exactly the components of the relation d <= 1 - near."""
    if not 0 < near <= 1:
        raise ValueError("near must lie in (0, 1]")
    spark = docs.sparkSession
    body = text_or_empty(F.col("text")).cast("binary").alias("body")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body)
    members = cut_lineage(read.withColumn("text_key", text_key(F.col("body"))).mapInArrow(
        _sizes(words), "doc_id long, n_shingles long, set_key binary, text_key binary"))
    total = members.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BLOCK))
    body = read.select("body")
    heavy = spark.sparkContext.broadcast(_heavy(body, words, buckets))
    held = body.mapInArrow(_cells(words, near, buckets, heavy), _ROOT_SQL).groupBy("bucket").applyInArrow(_held_twice, _PIECE_SQL)
    wanted = spark.sparkContext.broadcast(_bitmap(held, CELL_BITS))
    region = components(body.mapInArrow(_cells(words, near, buckets, heavy, wanted), _ROOT_SQL)
                        .groupBy("bucket").applyInArrow(_meet, _LINK_SQL))
    bits = spark.sparkContext.broadcast(_members(region))
    sets = read.select("body").mapInArrow(_sets_of(words, bits), "key binary, n long, tokens binary").dropDuplicates(["key"])
    sets = cut_lineage(sets.join(region.select(F.col("node").alias("key"), F.col("label").alias("region")).hint("merge"), "key")
                       .select("region", "key", "n", "tokens"))
    weight = sets.groupBy("region").agg(F.sum("n").alias("w"), F.count(F.lit(1)).alias("sets"))
    large = cut_lineage(weight.where((F.col("w") > limit) | (F.col("w") * F.col("sets") > limit * COMPARED)).select("region"))
    small = sets.join(large, "region", "left_anti")
    links = (small.select("region", "key", "tokens").repartition("region").sortWithinPartitions("region")
             .mapInArrow(_regions(near), _LINK_SQL))
    if not large.isEmpty():
        links = links.unionByName(_large_regions(sets.join(large, "region"), near, heavy))
    return members, cut_lineage(links)


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """``set_key, label`` of every non-empty set; sets of one component share a label."""
    keys = members.where("set_key is not null").select("set_key").distinct()
    label = components(links).withColumnRenamed("node", "set_key")
    return keys.join(label.hint("merge"), "set_key", "left").select("set_key", F.coalesce("label", "set_key").alias("label"))


def near_components(docs: DataFrame, words: int = 3, near: Fraction = Fraction(9, 10), limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_shingles, set_key, component_id`` per row: the smallest doc_id reachable by links, itself included."""
    members, links = jaccard_join(docs, words, near, limit)
    label = _labelled(members, links)
    own = members.where("set_key is not null")
    least = own.groupBy("set_key").agg(F.min("doc_id").alias("least")).join(label.hint("merge"), "set_key")
    least = label.join(least.groupBy("label").agg(F.min("least").alias("component_id")).hint("merge"), "label").select("set_key", "component_id")
    empty = members.where("set_key is null").withColumn("component_id", F.col("doc_id"))
    out = ["doc_id", "n_shingles", "set_key", "component_id"]
    return own.join(least.hint("merge"), "set_key").select(*out).unionByName(empty.select(*out))


def one_of_each(docs: DataFrame, words: int = 5, near: Fraction = Fraction(4, 5), limit: int = LIMIT) -> DataFrame:
    """The rows of ``docs`` (all columns) that stand for their component: the one of the smallest doc_id, nulls last, then of the
    smallest text digest.  Rows without words are components of their own; of rows equal in id and text one stays."""
    members, links = jaccard_join(docs, words, near, limit)
    label = _labelled(members, links)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("m")
    own = members.where("set_key is not null").groupBy("set_key").agg(first).join(label.hint("merge"), "set_key")
    kept = own.groupBy("label").agg(F.min("m").alias("m")).select(F.col("m.doc_id").alias("_id"), F.col("m.text_key").alias("_key"))
    kept = kept.unionByName(members.where("set_key is null").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))).distinct()
    # plain keys: the semi-join's exchange then serves the duplicates too, so whole rows are shuffled once
    key = lambda doc, body: [doc.isNull().alias("none"), F.coalesce(doc, F.lit(0)).alias("doc"), body.alias("body")]
    row = whole_rows(docs)
    marked = row.select("row", *key(F.col("row.doc_id").cast("long"), text_key(text_or_empty(F.col("row.text")).cast("binary"))))
    found = marked.join(kept.select(*key(F.col("_id"), F.col("_key"))).hint("merge"), ["none", "doc", "body"], "left_semi")
    return found.dropDuplicates(["none", "doc", "body"]).select("row.*")

"""Toxicity by a convolutional text classifier trained in numpy.

A word's vector is the sum of hashed embeddings of the word and of its first letters, so that inflected forms
share what their stem has learned.  Filters of several widths slide over the words, each keeps its largest response in the text (max
pooling), and a logistic layer scores them.  Whole texts are read, in slices that overlap where they are long.

Training takes every labelled text, once.  Texts are dealt by id into shards, numbered and stored; a fifth of each shard is held back to
calibrate.  Evidence is counted over all others; then, in each of ``EPOCHS`` rounds, every shard learns its texts and the
shards' parameters are averaged (iterative parameter mixing), so what meets is a few MB a shard, of which there are at most ``MOST_SHARDS``.
The score is shifted so that 0.7 is the best single threshold on the held-back texts, by running sums over them; each
language whose own best threshold makes fewer errors on its held-back texts gets that one (``threshold``), so language decides on rejection but
never enters a score.  Buckets without clear evidence in at least ``MIN_TEXTS`` training texts, copies not counted, have zero embeddings, so rare
words can't score.

Scoring is one pass without a shuffle; the model (a few MB, of fixed size) is broadcast.

Defined cases: a null text scores as an empty one; null labels and labels without a document are not trained on; with
one class or none, every score is the share of toxic rows (0 without rows); of several texts of one id the least is trained on, with its
largest label; rows are scored one by one, so repeated rows and null ids stay; a null language uses the common threshold; other columns are not read.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenlake.operators.prefix import running_sums
from screenlake.session import cut_lineage, stored

BUCKETS, DIM, WIDTHS, FILTERS = 1 << 16, 16, (1, 2, 3), 12
STEMS = (3, 4, 5, 6)
MIN_TEXTS, SURE, CUT = 3, 0.8, 0.7
EPOCHS, BATCH, RATE = 5, 32, 0.01
SLICE = 40_000  # words scored at a time
SHARD, MOST_SHARDS = 8192, 96  # texts that make a shard of the training set; beyond so many, shards grow instead
CHUNK = 128  # texts numbered together
SLICE_FLOATS = 1 << 14  # numbers of a vector that are added in one group
WORD = re.compile(r"\w+")


def _hash(s: str, kind: int) -> int:
    return zlib.crc32(s.encode(), kind * 0x9E37) % BUCKETS


def word_buckets(word: str) -> list[int]:
    """Buckets of a word and of its stems; bucket lists have one length, missing stems repeat the word."""
    own = _hash(word, 1)
    return [own] + [_hash(word[:k], k) if len(word) > k else own if k > 3 else _hash(word[:3], 3) for k in STEMS]


class _Words:
    """Numbers for words, and their buckets; forgets all when it holds too many."""

    def __init__(self, most: int = 400_000):
        self.number: dict[str, int] = {}
        self.most = most
        self.buckets = np.zeros((1024, 1 + len(STEMS)), np.int32)
        self.restarts = 0

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self.number) > self.most:
            self.number.clear()
            self.restarts += 1
        known = self.number
        new = set(words).difference(known)
        at = len(known)
        if at + len(new) > len(self.buckets):
            grown = np.zeros((max(2 * len(self.buckets), at + len(new)), self.buckets.shape[1]), np.int32)
            grown[:at] = self.buckets[:at]
            self.buckets = grown
        for w in sorted(new):
            self.buckets[at] = word_buckets(w)
            known[w] = at
            at += 1
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


class Model:
    def __init__(self, rng: np.random.Generator):
        self.row = np.zeros(BUCKETS, np.int32)  # of the embedding; 0: the bucket tells nothing
        self.emb = np.zeros((1, DIM), np.float32)
        self.conv = [rng.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32)
        self.base = np.float32(0)
        self.constant: float | None = None
        self.shift, self.scale = 0.0, 1.0
        self.thresholds: dict[str, float] = {}

    def projected(self, buckets: np.ndarray) -> list[np.ndarray]:
        """Per width the responses of each word at each place of the filter: [words, width, FILTERS]."""
        return self.projected_rows(self.row[buckets])

    def projected_rows(self, rows: np.ndarray) -> list[np.ndarray]:
        e = self.emb[rows].sum(axis=1)
        return [np.einsum("nd,wdf->nwf", e, c, optimize=True) for c in self.conv]

    def logits(self, texts: list[np.ndarray], buckets: np.ndarray) -> np.ndarray:
        """texts: numbers of rows of ``buckets``."""
        used, back = np.unique(np.concatenate(texts), return_inverse=True) if texts else (np.zeros(0, int),) * 2
        proj = self.projected(buckets[used])
        out, at = np.empty(len(texts)), 0
        for i, t in enumerate(texts):
            idx = back[at:at + len(t)]
            at += len(t)
            out[i] = self.base + self.out @ self._pooled(idx, proj)[0]
        return out

    def _pooled(self, idx: np.ndarray, proj: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest response of each filter, and where; an empty text, or places beyond its end, respond with 0."""
        best, where = [], []
        for w, p, b in zip(WIDTHS, proj, self.bias):
            top, arg = np.zeros(FILTERS, np.float32), np.full(FILTERS, -1)
            for lo in range(0, len(idx), SLICE):
                part = idx[lo:lo + SLICE + w - 1]
                n = min(SLICE, len(idx) - lo)
                r = p[part[:n], 0] + b
                for k in range(1, w):
                    tail = part[k:k + n]
                    r[:len(tail)] += p[tail, k]
                a = r.argmax(axis=0)
                v = r[a, np.arange(FILTERS)]
                win = v > top
                top, arg = np.where(win, v, top), np.where(win, a + lo, arg)
            best.append(top)
            where.append(arg)
        return np.concatenate(best), where

    def score(self, logits: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(logits), self.constant)
        x = np.clip(np.log(CUT / (1 - CUT)) + self.scale * (logits - self.shift), -30, 30)
        return 1 / (1 + np.exp(-x))


def _sketch(own: np.ndarray) -> list[int]:
    """The 8 smallest hashes of three-word runs, of the words' own buckets; near copies share most of them."""
    b = np.concatenate([own, [0, 0]]).astype(np.int64)
    return np.unique((b[:-2] * 0x9E3779B1 + b[1:-1] * 0x85EBCA6B + b[2:] * 0xC2B2AE35) * 0x27D4EB2F & 0xFFFFFFFF)[:8].tolist()


CHUNKS = ("shard int, chunk int, ids array<string>, toxic array<int>, langs array<string>, held array<boolean>, "
          "sizes array<int>, words binary, buckets binary, sketches array<array<bigint>>")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, toxic, lang, text) of a shard, in order, as ``CHUNKS``: words as numbers of rows of ``buckets``.

    Of rows of one id, which follow each other, the first counts.  Every fifth one is held back."""
    table, last, seen, chunk = _Words(100_000), None, 0, 0
    shard = TaskContext.get().partitionId()
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            rows = []
            for row in zip(*(c.to_pylist() for c in batch.slice(at, CHUNK).columns)):
                if row[0] != last:
                    rows.append(row)
                last = row[0]
            if not rows:
                continue
            words = [words_of(r[3]) for r in rows]
            sizes = [len(ws) for ws in words]
            used, flat = np.unique(table.numbers([w for ws in words for w in ws]), return_inverse=True)
            buckets = table.buckets[used]
            texts = np.split(flat, np.cumsum(sizes)[:-1])
            out = {"shard": shard, "chunk": chunk, "ids": [r[0] for r in rows], "toxic": [r[1] for r in rows],
                   "langs": [r[2] for r in rows], "held": [(seen + i) % 5 == 4 for i in range(len(rows))], "sizes": sizes,
                   "words": flat.astype(np.int32).tobytes(), "buckets": buckets.astype(np.uint16).tobytes(),
                   "sketches": [_sketch(buckets[t, 0]) for t in texts]}
            yield pa.RecordBatch.from_pylist([out], schema=CHUNK_SCHEMA)
            seen, chunk = seen + len(rows), chunk + 1


CHUNK_SCHEMA = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("ids", pa.list_(pa.string())), ("toxic", pa.list_(pa.int32())),
                          ("langs", pa.list_(pa.string())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())),
                          ("words", pa.binary()), ("buckets", pa.binary()), ("sketches", pa.list_(pa.list_(pa.int64())))])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray]]:
    """Each chunk as (its columns, words, sizes, buckets)."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns)}
            yield (row, np.frombuffer(row["words"], np.int32), np.array(row["sizes"], np.int64),
                   np.frombuffer(row["buckets"], np.uint16).reshape(-1, 1 + len(STEMS)).astype(np.int32))


def _summed(df: DataFrame, of_partition, length: int) -> np.ndarray:
    """The sum of one vector of ``length`` for each partition; slices of them are added side by side, in the order of ``at``."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, at = of_partition(batches), TaskContext.get().partitionId()
        if v is not None:
            for i in range(0, length, SLICE_FLOATS):
                yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()), "at": pa.array([at], pa.int32()),
                                                  "v": pa.array([v[i:i + SLICE_FLOATS].astype(np.float64).tobytes()], pa.binary())})

    def add(group: pa.Table) -> pa.Table:
        rows = sorted(zip(group["at"].to_pylist(), group["v"].to_pylist()))
        total = np.zeros(len(rows[0][1]) // 8)
        for _, v in rows:
            total += np.frombuffer(v)
        return pa.table({"slice": group["slice"][:1], "v": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(length)
    for r in df.mapInArrow(parts, "slice int, at int, v binary").groupBy("slice").applyInArrow(add, "slice int, v binary").collect():
        out[r["slice"]:r["slice"] + SLICE_FLOATS] = np.frombuffer(bytes(r["v"]))
    return out


def _copies(chunks: DataFrame, split: bool) -> DataFrame:
    """Places (``shard, chunk, copies``) of texts of which half the sketch is in texts before them (in the order of the
    hashes of doc_id), so that near copies don't count as evidence."""
    texts = chunks.select("shard", "chunk", F.posexplode(F.arrays_zip("ids", "held", "sketches")).alias("place", "t"))
    texts = texts.where(~F.col("t.held")) if split else texts
    order = F.struct(F.crc32(F.col("t.ids")), F.col("t.ids"))
    hashes = texts.select("shard", "chunk", "place", order.alias("order"), F.size("t.sketches").alias("n"),
                          F.explode("t.sketches").alias("hash"))
    first = hashes.groupBy("hash").agg(F.min("order").alias("first"))
    shared = (hashes.join(first, "hash").where(F.col("first") < F.col("order"))
              .groupBy("shard", "chunk", "place", "n").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") * 2 >= F.col("n")))
    return shared.groupBy("shard", "chunk").agg(F.collect_list("place").alias("copies"))


def _evidence(chunks: DataFrame, split: bool) -> np.ndarray:
    """Per bucket the log odds of a toxic text, less two standard errors towards 0; every text counts that is no near copy."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        counts, n = np.zeros((2, BUCKETS)), np.zeros(2)
        for row, words, sizes, buckets in _chunks(batches):
            use = ~np.array(row["held"]) if split else np.ones(len(sizes), bool)
            use[row["copies"] or []] = False
            seen = np.zeros((len(sizes), BUCKETS), bool)
            seen[np.repeat(np.arange(len(sizes)), sizes)[:, None], buckets[words]] = True
            for c in (0, 1):
                mine = use & (np.array(row["toxic"]) == c)
                counts[c] += seen[mine].sum(axis=0)
                n[c] += mine.sum()
        return np.concatenate([counts.ravel(), n])

    # a stored table has a known size: few copies go to every task, only many have the chunks shuffled
    copies = stored(_copies(chunks, split), "copies")
    got = _summed(chunks.drop("ids", "langs", "sketches").join(copies, ["shard", "chunk"], "left"), count, 2 * BUCKETS + 2)
    counts, n = got[:-2].reshape(2, BUCKETS) + 0.5, np.maximum(1, got[-2:]) + 1
    odds = np.log(counts[1] / n[1]) - np.log(counts[0] / n[0])
    sure = np.abs(odds) - 2 * np.sqrt(1 / counts[1] + 1 / counts[0])
    return np.where((sure > SURE) & (counts.sum(axis=0) >= MIN_TEXTS + 1), np.sign(odds) * np.minimum(sure, 5), 0)


def _compact(words: np.ndarray, sizes: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and sizes of texts with runs of words that tell nothing (not ``live``) cut to the widest filter.

    No filter tells the shorter run from the longer one, so responses, maxima and gradients stay."""
    most = max(WIDTHS)
    ends = np.cumsum(sizes)
    told, keep = live[words], np.arange(len(words)) - np.repeat(ends - sizes, sizes) < most
    for k in range(most + 1):
        keep[k:] |= told[:len(words) - k]
    before = np.concatenate([[0], np.cumsum(keep)])
    return words[keep], before[ends] - before[ends - sizes]


class _Trainer:
    """Adam on the weighted log loss; gradients reach only the places that won a maximum."""

    def __init__(self, model: Model):
        self.model = model
        self.params = [model.emb, *model.conv, *model.bias, model.out]
        self.first, self.second = [np.zeros_like(p) for p in self.params], [np.zeros_like(p) for p in self.params]
        self.step = 0.0

    def flat(self) -> np.ndarray:
        return np.concatenate([[self.step, self.model.base], *(a.ravel() for a in (*self.params, *self.first, *self.second))]).astype(np.float64)

    def load(self, flat: np.ndarray) -> None:
        self.step, self.model.base, at = float(flat[0]), np.float32(flat[1]), 2
        for a in (*self.params, *self.first, *self.second):
            a[...] = flat[at:at + a.size].reshape(a.shape)
            at += a.size

    def learn(self, rows: np.ndarray, sizes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """A step on a batch of texts; ``rows``: the embeddings of their words, one text after the other."""
        model, pad = self.model, max(WIDTHS) - 1
        # words beyond the end respond as embeddings of zero: ``pad`` of them after every text
        n = int(sizes.sum()) + pad * len(sizes)
        starts = np.cumsum(sizes + pad) - sizes - pad
        at = np.arange(len(rows)) + np.repeat(np.arange(len(sizes)) * pad, sizes)
        e = np.zeros((n + pad, DIM), np.float32)
        e[at] = model.emb[rows].sum(axis=1)
        beyond = np.ones(n, bool)
        beyond[at] = False
        places, best = [], []
        for w, conv, bias in zip(WIDTHS, model.conv, model.bias):
            r = sum(e[k:k + n] @ conv[k] for k in range(w)) + bias
            r[beyond] = -np.inf
            top = np.maximum.reduceat(r, starts, axis=0)
            hit = r == np.repeat(top, sizes + pad, axis=0)
            places.append(np.minimum.reduceat(np.where(hit, np.arange(n)[:, None], n), starts, axis=0))
            best.append(np.maximum(top, 0))
        pooled = np.concatenate(best, axis=1)
        p = 1 / (1 + np.exp(-np.clip(model.base + pooled @ model.out, -30, 30)))
        g = (weight * (p - y) / BATCH).astype(np.float32)
        convs, biases, ge = [np.zeros_like(c) for c in model.conv], [], np.zeros_like(e)
        for j, w in enumerate(WIDTHS):
            gf = g[:, None] * model.out[j * FILTERS:(j + 1) * FILTERS] * (best[j] > 0)
            biases.append(gf.sum(axis=0))
            for k in range(w):
                convs[j][k] = np.einsum("bf,bfd->df", gf, e[places[j] + k])
                np.add.at(ge, places[j] + k, gf[:, :, None] * model.conv[j][k].T)
        emb = np.zeros_like(model.emb)
        moved = np.flatnonzero(ge[at].any(axis=1))
        np.add.at(emb, rows[moved], ge[at[moved]][:, None, :])
        emb[0] = 0
        self.step += 1
        for p, g_p, m, v in zip(self.params, [emb, *convs, *biases, g @ pooled], self.first, self.second):
            m *= 0.9
            m += 0.1 * g_p
            v *= 0.999
            v += 0.001 * g_p * g_p
            rate = RATE * (0.1 if p is model.emb else 1)
            p -= rate * (m / (1 - 0.9 ** self.step)) / (np.sqrt(v / (1 - 0.999 ** self.step)) + 1e-8)
        model.base -= np.float32(RATE * 10 * g.sum())


def _train(model: Model, chunks: DataFrame, split: bool, share: float, seed: int) -> None:
    """Every shard learns all its texts, then the shards' parameters are averaged by rows; ``EPOCHS`` times.

    The first dimension starts as a bucket's evidence, and filters start by looking along it."""
    told = _evidence(chunks, split)
    rng = np.random.default_rng(seed)
    alive = np.flatnonzero(told)
    model.row[alive] = np.arange(1, len(alive) + 1)
    model.emb = np.zeros((len(alive) + 1, DIM), np.float32)
    model.emb[1:] = rng.normal(0, 0.05, (len(alive), DIM))
    model.emb[1:, 0] = told[alive]
    for c in model.conv:
        c[:, 0, :FILTERS * 2 // 3] = 0.5
    for j in range(len(WIDTHS)):
        model.out[j * FILTERS:j * FILTERS + FILTERS * 2 // 3] = 0.1
    model.base = np.float32(-1)
    weights = np.array([0.5 / max(1 - share, 1e-6), 0.5 / max(share, 1e-6)])
    state = _Trainer(model).flat()

    def epoch(number: int, state: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
            trainer, rows_seen = _Trainer(pickle.loads(pickle.dumps(model))), 0
            trainer.load(state)
            for row, words, sizes, buckets in _chunks(batches):
                rows = model.row[buckets]
                words, sizes = _compact(words, sizes, rows.any(axis=1))
                ends, y = np.cumsum(sizes), np.array(row["toxic"])
                order = np.random.default_rng([seed, number, row["shard"], row["chunk"]]).permutation(len(sizes))
                order = order[~np.array(row["held"])[order]] if split else order
                for lo in range(0, len(order), BATCH):
                    mine = order[lo:lo + BATCH]
                    texts = np.concatenate([words[ends[i] - sizes[i]:ends[i]] for i in mine])
                    trainer.learn(rows[texts], sizes[mine], y[mine], weights[y[mine]])
                rows_seen += len(order)
            return np.concatenate([[rows_seen], rows_seen * trainer.flat()]) if rows_seen else None
        return run

    for number in range(EPOCHS):
        got = _summed(chunks, epoch(number, state.astype(np.float32)), len(state) + 1)
        state = got[1:] / got[0]
    _Trainer.load(_Trainer(model), state)


def _cuts(logits: DataFrame) -> DataFrame:
    """Of rows (kind, x, y) a row for each cut of a kind: it lies after ``x`` and before ``next``, with the toxic rows up to
    it, the clean ones up to it, all of both.  Range partitions and their borders, as in ``running_sums``."""
    kept = logits.groupBy("kind", "x").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    below = kept.groupBy("kind").agg((F.min("x") - 2).alias("x")).select("kind", "x", F.lit(0).alias("pos"), F.lit(0).alias("neg"))
    n = int(logits.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(kept.unionByName(below).repartitionByRange(n, "kind", "x").withColumn("at", F.spark_partition_id()))
    borders = placed.groupBy("kind", "at").agg(F.min("x").alias("border"))
    after = borders.select("kind", "at", F.lead("border").over(Window.partitionBy("kind").orderBy("at")).alias("border"))
    near = F.lead("x").over(Window.partitionBy("kind", "at").orderBy("x"))
    ends = placed.join(after, ["kind", "at"]).select("kind", "x", "pos", "neg",
                                                     F.coalesce(near, "border", F.col("x") + 2).alias("next"))
    return running_sums(ends, ["kind"], "x", ["pos", "neg"], totals="all_")


def _best_cuts(cuts: DataFrame) -> dict[str, dict]:
    """For each kind the middle of the widest gap among the cuts with fewest errors, the errors, the medians of both classes."""
    errors = F.col("cum_pos") + F.col("all_neg") - F.col("cum_neg")
    best = F.max(F.struct(-errors, F.col("next") - F.col("x"), -F.col("x"), ((F.col("x") + F.col("next")) / 2).alias("cut")))

    def median(c: str):
        half, most = F.col(f"cum_{c}") * 2, F.col(f"all_{c}")
        return (F.min(F.when(half >= most, F.col("x"))) + F.min(F.when(half > most, F.col("x")))) / 2

    rows = cuts.groupBy("kind").agg(best.alias("best"), median("pos").alias("pos"), median("neg").alias("neg"),
                                    F.max("all_pos").alias("n_pos"), F.max("all_neg").alias("n_neg")).collect()
    return {r["kind"]: {"cut": r["best"]["cut"], "errors": -r["best"][0], **r.asDict()} for r in rows}


def _calibrate(model: Model, chunks: DataFrame, split: bool) -> None:
    """Shift, scale and thresholds from all rows held back (all rows if none are)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, words, sizes, buckets in _chunks(batches):
            words, sizes = _compact(words, sizes, model.row[buckets].any(axis=1))
            use = np.flatnonzero(row["held"]) if split else np.arange(len(sizes))
            texts = np.split(words, np.cumsum(sizes)[:-1])
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([row["langs"][i] for i in use], pa.string()),
                "x": pa.array(model.logits([texts[i] for i in use], buckets), pa.float64()),
                "y": pa.array([row["toxic"][i] for i in use], pa.int32())})

    logits = cut_lineage(chunks.mapInArrow(run, "lang string, x double, y int"))
    every = logits.select(F.lit("").alias("kind"), "x", "y")
    each = logits.where("lang is not null").select(F.concat(F.lit("="), "lang").alias("kind"), "x", "y")
    cuts = cut_lineage(_cuts(every.unionByName(each)))
    best = _best_cuts(cuts)
    model.shift = best[""]["cut"]
    model.scale = float(6 / max(best[""]["pos"] - best[""]["neg"], 1e-3))
    rejected = F.col("x") >= F.lit(model.shift)
    now = cuts.groupBy("kind").agg(F.sum(F.when(rejected, F.col("neg")).otherwise(F.col("pos"))).alias("errors")).collect()
    for kind, errors in sorted((r["kind"], r["errors"]) for r in now):
        own = best[kind]
        if kind and own["n_pos"] and own["n_neg"] and own["errors"] < errors:
            model.thresholds[kind[1:]] = float(model.score(np.array([own["cut"]]))[0])


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, seed: int = 7) -> Model:
    """Trains on ``docs`` (doc_id, text, lang) joined with ``labels`` (doc_id, toxic); ``usable`` filters the labels."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.where(usable) if usable is not None else known
    known = known.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("_y"))
    shards = min(MOST_SHARDS, 1 + known.count() // SHARD)
    # both sides are dealt by id, which the join and the grouping keep: a shard holds the same rows however the tables are split
    known = known.repartition(shards, "_id").groupBy("_id").agg(F.max("_y").alias("_y"))
    texts = docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"), F.col("lang").cast("string").alias("_lang"))
    rows = texts.where("_id is not null").repartition(shards, "_id").join(known, "_id")
    rows = rows.select(F.col("_id").cast("string").alias("_id"), "_y", "_lang", "_text")
    chunks = cut_lineage(rows.sortWithinPartitions(F.crc32(F.col("_id")), "_id", "_text", "_lang").mapInArrow(_numbered, CHUNKS))

    each = F.explode(F.arrays_zip("held", "toxic")).alias("t")
    n = {(r["held"], r["toxic"]): r["n"] for r in chunks.select(each).groupBy("t.held", "t.toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rng = np.random.default_rng(seed)
    model = Model(rng)
    toxic, clean = (n.get((False, c), 0) + n.get((True, c), 0) for c in (1, 0))
    if not toxic or not clean:
        model.constant = 1.0 if toxic else 0.0
        return model
    split = len(n) == 4
    share = n[False, 1] / (n[False, 0] + n[False, 1]) if split else toxic / (toxic + clean)
    _train(model, chunks, split, share, seed)
    _calibrate(model, chunks, split)
    return model


def scorer(model: Model):
    """A function of Arrow batches (any columns, text last) that adds the score after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Words()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                words = [words_of(t) for t in part.column(part.num_columns - 1).to_pylist()]
                # one call for all texts, since the table may forget between calls
                flat = table.numbers([w for ws in words for w in ws])
                told = model.row[table.buckets[flat]].any(axis=1)
                kept, sizes = _compact(np.arange(len(flat)), np.array([len(ws) for ws in words], np.int64), told)
                scores = model.score(model.logits(np.split(flat[kept], np.cumsum(sizes)[:-1]), table.buckets))
                cols = [part.column(i) for i in range(part.num_columns - 1)] + [pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(cols, [*part.schema.names[:-1], "score"])

    return run


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang, score, threshold, rejected`` per row."""
    cuts = F.lit(CUT)
    for lang, cut in sorted(model.thresholds.items()):
        cuts = F.when(F.col("lang") == lang, F.lit(cut)).otherwise(cuts)
    scored = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), "text").mapInArrow(
        scorer(model), "doc_id long, lang string, score double")
    return scored.withColumn("threshold", cuts).withColumn("rejected", F.col("score") >= F.col("threshold"))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` (all columns) that the classifier doesn't reject."""
    text, lang = docs.columns.index("text"), docs.columns.index("lang")
    cuts = model.thresholds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(model)
        for batch in batches:
            at = 0
            for scored in score(iter([pa.RecordBatch.from_arrays([batch.column(lang), batch.column(text)], ["lang", "text"])])):
                limit = np.array([cuts.get(x, CUT) for x in scored.column(0).to_pylist()])
                clean = scored.column(1).to_numpy() < limit
                yield batch.slice(at, len(clean)).filter(pa.array(clean))
                at += len(clean)

    return docs.mapInArrow(run, docs.schema)

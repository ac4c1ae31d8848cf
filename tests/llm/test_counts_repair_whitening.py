"""Token counts, conversation repair and whitening against the library, a search over all edits, and exact algebra."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenlake.llm import conversation_repair as cr
from screenlake.llm import token_counts, whitening
from screenlake.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
MODEL = "piece_bpe_32k.model"


# ---- token counts ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(MODEL))


def test_counts_equal_the_library_on_odd_texts(spark, library):
    rnd = random.Random(1)
    bits = ["a", "the", " ", "  ", "   ", "\n", "\r", "\t", "▁", "é", "日本", "①", "<s>", "</s>", "<unk>", "<0x0A>", ".", "1",
            "2024", "\xa0", "​", "\0", "xyzzy", "ing", " word", "tion", "\U0001f600"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(1500)]
    texts += [None, "", " ", "\n", "  ", "\n\n", " \n", "a" * 50_000, "word " * 20_000, "same", "same"]
    rows = [(i if i % 7 else None, t, "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(5)
    got = token_counts.count_tokens(docs, tokenizer_path(MODEL), block_chars=5_000, bucket_bytes=20_000)
    want = [(d, len((t or "").encode()), len(library.encode(t or ""))) for d, t, _ in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert token_counts.count_tokens(docs.limit(0), tokenizer_path(MODEL)).collect() == []


def test_counts_of_the_table(spark, library):
    got = {r.doc_id: r for r in QUERIES["op11_token_counts"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        n = len(library.encode(d.text or ""))
        assert (got[d.doc_id].n_tokens, got[d.doc_id].over_limit) == (n, n > 4096)


def test_a_pre_token_of_every_document_is_spread(spark):
    """Rows of a bucket by block: a word that all documents hold is in many buckets."""
    docs = spark.createDataFrame([(i, f"all of w{i} x{i}") for i in range(2000)], "doc_id long, text string")
    rows = docs.mapInArrow(token_counts._frequencies(64, 2_000), token_counts.ROWS).where("not home").collect()
    buckets = {r.bucket for r in rows if b" all" in token_counts._unpacked(r.payload)[0].astype("u1").tobytes()}
    assert len(buckets) > 5


# ---- conversation repair ---------------------------------------------------------------

AFTER = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
NAMES = {"u": "user", "a": "assistant"}


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        core = text.strip("\t\n\x0b\x0c\r ")
        out.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) by a search over single edits in the order of (cost, audit)."""
    fault, done, heap = faults(rows), set(), [(0, "", 0, 0, ())]
    while heap:
        cost, audit, i, q, made = heapq.heappop(heap)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == len(rows) and q in (0, 3):
            return cost, audit, made
        options = [(2, "I", i, q2, (NAMES[c], "")) for c, q2 in AFTER[q].items() if c in NAMES]
        if i < len(rows):
            role, text = rows[i]
            options.append((3, "D", i + 1, q, None))
            if fault[i] not in ("blank", "duplicate"):
                cut = int(fault[i] == "truncated")
                options += [(cut, "K", i + 1, AFTER[q][role[:1]], (role, text))] if role[:1] in AFTER[q] else []
                options += [(2 + cut, "R", i + 1, q2, (NAMES[c], text)) for c, q2 in AFTER[q].items() if c in NAMES]
        for more, letter, i2, q2, row in options:
            heapq.heappush(heap, (cost + more, audit + letter, i2, q2, made + ((row,) if row else ())))


def codes_of(rows):
    return bytes(cr.BLANK if f == "blank" else cr.DUPLICATE if f == "duplicate" else
                 ("sua".index(role[0]) if role[:1] in ("s", "u", "a") else 3) + 4 * (f == "truncated")
                 for (role, _), f in zip(rows, faults(rows)))


def test_audits_are_the_cheapest_and_least(spark):
    rnd, program = random.Random(5), cr.Program(cr.ROW_TABLES)
    for _ in range(2500):
        rows = [(rnd.choice(["system", "user", "assistant", "tool", "user", "assistant", ""]),
                 rnd.choice(["x.", "y!", "z", "w?", "v", " ", "p.", "q.", "r."])) for _ in range(rnd.randint(0, 9))]
        _, want, _ = cheapest(rows)
        codes = codes_of(rows)
        assert cr.audit(program, codes) == want
        cuts = sorted(rnd.sample(range(1, len(codes)), min(2, len(codes) - 1))) if len(codes) > 2 else []
        blocks = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        if cuts:
            sums = [program.summary(b) for b in blocks]
            ends = cr.Program([[s[4 * p:4 * p + 4] for p in range(4)] for s in sums]).states(range(len(blocks)), 0, cr.END)
            ways = zip(blocks, [0, *ends], [*ends[:-1], None])
            assert "".join(cr.audit(program, b, p, q) for b, p, q in ways) == want


def repaired(rows):
    """The contract's columns of one conversation's damaged (turn, role, text) rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(),
                                       hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    said, turns = [(r, t) for _, r, t in rows], [t for t, *_ in rows if t is not None]
    fault = faults(said)
    cost, audit, made = cheapest(said)
    legal = {"su", "ua", "au"}
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, fault.count("blank"), fault.count("duplicate"),
            fault.count("truncated"), sum(a[0][:1] + b[0][:1] not in legal for a, b in zip(said, said[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())


def damaged(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv] += []
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {conv: repaired(r) for conv, r in out.items()}


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def by_conversation(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}


def test_repair_of_the_table(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SF}/conversations.parquet").collect()]
    assert by_conversation(QUERIES["op12_conversation_repair"](spark, SF)) == damaged(rows)


@pytest.mark.parametrize("block", [3, 1 << 16])
def test_repair_of_nulls_ties_repeats_and_long_conversations(spark, block):
    rnd = random.Random(7)
    rows = [(c, rnd.choice([None, *range(8)]), rnd.choice(["system", "user", "assistant", "tool", None, ""]),
             rnd.choice(["one.", "two!", "three", None, "", " \t", "four? ", "five."])) for c in [None, *range(40)] for _ in range(9)]
    rows += [(100, t, "user" if t % 2 == 0 else "assistant", f"t{t}." if t % 5 else "again.") for t in range(300)]
    rows += [(101, 1, "user", "same.")] * 50 + [(102, None, None, None)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, audit int")
    got = by_conversation(cr.repair(cr.damage(table), table, block).select("conv_id", *COLUMNS))
    assert got == damaged(rows)


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert cr.repair(cr.damage(empty), empty).collect() == []
    # 7:11 has crc32 % 20 = 0 somewhere below: a conversation without rows keeps its place
    turn = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    one = spark.createDataFrame([(7, turn, "user", "gone.")], "conv_id long, turn long, role string, text string")
    assert by_conversation(cr.repair(cr.damage(one), one)) == {7: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


# ---- whitening -------------------------------------------------------------------------

def exact_model(vectors):
    x = [[int(np.floor(1024.0 * c)) + 100_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    y = [[n * a - s for a, s in zip(row, sums)] for row in x]
    width = len(sums)
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n ** 3)) for j in range(width)] for i in range(width)])
    return n, y, cov


def check(rows, vectors_by_id):
    ids = list(vectors_by_id)
    n, y, cov = exact_model([vectors_by_id[i] for i in ids])
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    k = min(8, len(values))
    assert len(rows) == len(ids) * k
    white = {(r.vec_id, r.component): r for r in rows}
    centred = np.array(y, "float64") / n
    out = np.array([[white[i, c + 1].whitened for c in range(k)] for i in ids])
    want = centred @ basis[:, :k] / np.sqrt(values[:k])
    out *= np.sign((out * want).sum(0))
    assert np.abs(out - want).max() < 1e-8
    for i, row in zip(ids, y):
        r = white[i, 1]
        assert (r.n, r.deviation) == (n, sum(v * v for v in row))
    for c in range(k):
        assert abs(white[ids[0], c + 1].explained - values[c] / np.trace(cov)) < 1e-9
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9


def test_whitening_of_the_table(spark):
    rows = QUERIES["op13_whitening"](spark, SF).collect()
    check(rows, {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()})


def test_whitening_of_null_repeated_and_many_small_partitions(spark):
    rnd = np.random.default_rng(3)
    vectors = {i: rnd.normal(0, 0.1, 6).astype("float32").tolist() for i in range(400)}
    vectors |= {1000 + i: vectors[5] for i in range(200)}
    bad = [(5000, None), (5001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (5002, [float("nan")] * 6), (5003, [float("inf")] * 6)]
    df = spark.createDataFrame([(i, v, "x") for i, v in [*vectors.items(), *bad]],
                               "vec_id long, embedding array<float>, whitened string").repartition(37)
    check(whitening.whiten(df).collect(), vectors)


def test_whitening_without_variance_or_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, []), (2, None)], schema)).collect() == []
    same = whitening.whiten(spark.createDataFrame([(1, [0.5, 1.0]), (None, [0.5, 1.0])], schema)).collect()
    assert [(r.component, r.whitened, r.deviation) for r in same] == [(1, None, 0), (2, None, 0)] * 2
    wide = whitening.whiten(spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30]), (3, [0.0, 1.0])], schema)).collect()
    assert len(wide) == 6 and all(r.deviation > 0 for r in wide)


def test_rank_one_updates_keep_the_eigenpairs():
    rnd = np.random.default_rng(0)
    for width, n in ((5, 60), (33, 200), (8, 3)):
        x = np.floor(1024 * rnd.normal(0, 0.14, (n, width))) + 100_000
        x[n // 2] = x[0]
        halves = []
        for part in (x[:n // 2], x[n // 2:]):
            s = whitening.Spectrum.empty(width)
            for row in part:
                s.add(row, 1)
            halves.append(s)
        halves[0].merge(halves[1])
        s, c = halves[0], (x - x.mean(0)).T @ (x - x.mean(0))
        assert np.abs(s.basis * s.values @ s.basis.T - c).max() < 1e-11 * np.abs(c).max()
        assert np.abs(s.basis.T @ s.basis - np.eye(width)).max() < 1e-12


def test_secular_roots_lie_between_their_poles():
    d = np.array([0.0, 1.0, 1.0 + 1e-9, 4.0])
    delta = whitening.secular_roots(d, np.array([1e-12, 0.3, 0.3, 2.0]))
    roots = d[0] - delta[:, 0]
    assert (roots[:-1] >= d[:-1]).all() and (roots[:-1] <= d[1:]).all() and roots[-1] > d[-1]

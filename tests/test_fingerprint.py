"""Vectors from strings against a count of tokens by hand."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenlake.operators import fingerprint as FP

BITS = 97


def tokens(mode, text, radius):
    words = text.split()
    if mode == "key_presence":
        return [k for k in FP.PRESENCE_KEYS if k in text]
    if mode == "class_ngram":
        text = text.lower().translate(str.maketrans(FP.CLASS_FROM, FP.CLASS_TO))
    if mode in ("ngram", "class_ngram"):
        return [f"{w}:{text[i:i + w]}" for w in range(1, radius + 2) for i in range(len(text) - w + 1)]
    if mode == "path4":
        return [" ".join(words[i:i + 4]) for i in range(len(words) - 3)]
    return [f"{min(a, b)}|{max(a, b)}|{d}" for d in (1, 2, 3) for a, b in zip(words, words[d:])]


def counts(mode, text, radius, binary):
    if mode == "key_presence":
        return {FP.PRESENCE_KEYS.index(k): 1 for k in tokens(mode, text, radius)}
    out = Counter(int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % BITS for t in tokens(mode, text, radius))
    return {b: 1 for b in out} if binary else dict(out)


def texts(n=120):
    rnd = random.Random(2)
    alphabet = "abcABC 019 .,é日\U0001f600\n\t  "
    some = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    return some + [None, "", "   ", "x", "\n\t", "one two three four five", "same", "same", "ab " * 4000]


@pytest.mark.parametrize("mode, radius, binary", [("ngram", 2, False), ("ngram", 3, False), ("class_ngram", 2, False),
                                                  ("path4", 0, False), ("token_pairs", 0, True), ("key_presence", 0, True)])
def test_sparse_and_dense(spark, monkeypatch, mode, radius, binary):
    rows = [(i, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "id long, text string").repartition(3)
    valid = {i: t for i, t in rows if t is not None and t.strip(" ")}
    want = {i: counts(mode, t, radius, binary) for i, t in valid.items()}
    got = {}
    for r in FP.sparse_fingerprint(df, "id", "text", mode, radius, BITS, binary).collect():
        assert r.bit not in got.setdefault(r.id, {})
        got[r.id][r.bit] = r.value
    assert got == {i: c for i, c in want.items() if c}
    beside = {r.id: r for r in FP.with_vectors(df, "text", mode, radius, BITS, binary).collect()}
    assert len(beside) == len(rows)
    for i, t in rows:
        assert beside[i].text == t and beside[i].is_valid == (i in valid)
        assert beside[i].fp == ([want[i].get(b, 0) for b in range(BITS)] if i in valid else None)


def test_windows_by_table_and_by_sort(monkeypatch):
    """Small limits cut batches into pieces and number windows by sorting; nothing changes."""
    some = [t for t in texts() if t]
    whole = {m: FP._counts(m, some, 3, BITS) for m in ("ngram", "path4", "token_pairs")}
    monkeypatch.setattr(FP, "DIRECT", 50)
    monkeypatch.setattr(FP, "CELLS", 500)
    cuts = list(FP._pieces(some, BITS))
    assert [lo for lo, _ in cuts[1:]] == [hi for _, hi in cuts[:-1]] and cuts[0][0] == 0 and cuts[-1][1] == len(some)
    for m, w in whole.items():
        assert (w == sum(([*FP._counts(m, some[lo:hi], 3, BITS)] for lo, hi in cuts), []) ).all()


def test_clashing_columns_and_unknown_modes(spark):
    df = spark.createDataFrame([(1, "abc", "k", 2.0)], "id long, text string, kind string, bits double")
    assert {r.bit for r in FP.fingerprints(df, "id", "text", ["ngram_r2", "path4", "nothing"]).collect()}
    assert FP.with_vectors(df, "text").columns == ["id", "text", "kind", "bits", "fp", "is_valid"]
    assert FP.fingerprints(df, "id", "text", ["nothing"]).collect() == []
    with pytest.raises(ValueError):
        FP.sparse_fingerprint(df, "id", "text", "no_such_mode")
    with pytest.raises(ValueError):
        FP.with_vectors(df, "text", "key_presence", n_bits=8)


def test_pieces_stay_small_whatever_the_text_lengths():
    cuts = list(FP._pieces(["x" * 1000] * 9000, BITS))
    assert max(hi - lo for lo, hi in cuts) * 1000 <= 1 << 20 and sum(hi - lo for lo, hi in cuts) == 9000


def test_bits_of_word_tokens_are_those_of_their_md5():
    import hashlib

    words = ["", "a", "été", "x" * 20, "y" * 53, "z" * 54, "w" * 90]
    parts = [w.encode() + b"|" for w in words]
    pairs = np.array([(i, j) for i in range(len(words)) for j in range(len(words))])
    got = FP._word_bits(parts, pairs, b"12", BITS)
    want = [int(hashlib.md5(f"{words[i]}|{words[j]}|12".encode()).hexdigest()[:8], 16) % BITS for i, j in pairs]
    assert got.tolist() == want

"""HTML, packing, toxicity, fingerprints, decontamination, suffix runs and the Jaccard join against brute force."""

import collections
import hashlib
import random
import re
import time
import zlib
from fractions import Fraction
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from screenlake.llm import (components, decontaminate, fingerprints, html_text, jaccard_join, packing, queries,
                            suffix_dedup, toxicity)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, digest string, body string"


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", 0, 0.0, "x", "y") for d, t in rows], DOCS)


HARD = [(None, None), (5, ""), (5, ""), (1, None), (2, " \n\t "), (3, "one"), (None, "one two three four"), (7, "é𝒳 ß" * 9000),
        (8, "a" * 70000), (9, "one two three four"), (9, "One two three four"), (-4, "\0zero\0 byte")]

# ---- HTML ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<script>x", ""), ("<!-- open", ""), ("<div class='ad'>buy</div>", ""),
    ("<p>a&amp;b &#233;<br>c\n\n d", "a&b é c d"), ("<ul><li>a<li>b</ul>", "a\n\nb"),
    ("<nav><a href=x>menu</a></nav><article><h1>T</h1><p><b>bold<p>next</article><footer>f</footer>", "T\n\nbold\n\nnext"),
    ("<body><div id=side-bar class=sidebar><p>" + "s " * 500 + "</p></div><main><p>short</p></main></body>", "short"),
    ("<article><p>a</p><div class='comments'><p>" + "talk " * 300 + "</p></div><form><p>f</p></form><p>b</p></article>", "a\n\nb"),
    ("<div><p>" + "w " * 99 + "</p><p>x</p></div><div class=menu><a>1</a><a>2</a></div>", " ".join("w" * 99) + "\n\nx"),
    ("plain text only", "plain text only"), ("<b>" * 5000 + "deep", "deep"),
])
def test_main_text(html, text):
    assert html_text.main_text(html) == text


def test_extract_keeps_rows(spark):
    rows = [(1, "u", "<p>a</p>", "x"), (1, "u", "<p>a</p>", "x"), (None, None, None, None)]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted(map(tuple, got), key=str) == [(1, "u", "a"), (1, "u", "a"), (None, None, "")]


def test_articles_of_the_pages_table(spark):
    import html as entities
    got = {r["page_id"]: r["text"] for r in queries.op2_html_text(spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        cut = re.sub(r"</?b>", "", re.sub("<br>", " ", re.sub(r"</?(p|h1)>", "\0", inside)))
        blocks = (" ".join(entities.unescape(x).split()) for x in cut.split("\0"))
        assert got[r["page_id"]] == "\n\n".join(b for b in blocks if b)

# ---- packing ---------------------------------------------------------------------------------------------------------


def test_cut_lengths():
    for n in (1, 2, 2047, 2048, 2049, 6000, 4095):
        cut = packing.cut_lengths(n)
        assert sum(cut) == n and all(x & (x - 1) == 0 and x <= 2048 for x in cut) and cut == sorted(cut, reverse=True)
    with pytest.raises(ValueError):
        packing.pack(None, "", max_len=3)


def test_tokens_are_those_of_the_tokenizer():
    tok = packing.TextTokenizer(queries.tokenizer_path())
    rnd = random.Random(0)
    common = " \n\t.,'s ABCabcäéñß0123²½%$-–“”’<|endoftext|>"
    texts = ["".join(rnd.choice(common + ("日\0\x1c\x85　🙂" if n % 3 == 0 else "")) for _ in range(rnd.randint(0, 60))) for n in range(6000)]
    want = [np.array(e.ids, "<u4").tobytes() for e in tok.tok.encode_batch(texts, add_special_tokens=False)]
    assert tok.encode(texts) == want


def test_strings_of_added_tokens_are_their_ids():
    from tokenizers import Tokenizer
    plain, tok = Tokenizer.from_file(queries.tokenizer_path()), packing.TextTokenizer(queries.tokenizer_path())
    added = [t.content for t in plain.get_added_tokens_decoder().values()]
    texts = ["a <|endoftext|> b"] + [x for a in added for x in (a, f"a {a} b", f"x{a}{a}y\n", a[:-1], f"{a}日", f"  {a}  ", a.upper())]
    want = [np.array(plain.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in texts]
    assert added and tok.encode(texts) == want
    assert np.frombuffer(tok.encode(texts[:1])[0], "<u4").tolist() == [64, 220, 50256, 275]


def test_pieces_hold_every_id_once(spark, tmp_path):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(queries.tokenizer_path())
    pieces = packing.pack(docs_of(spark, HARD).repartition(3), queries.tokenizer_path())
    got = pieces.collect()
    assert len({r["sequence_id"] for r in got}) == len(got) and all(r["offset"] == 0 for r in got)
    found = collections.defaultdict(list)
    for r in got:
        found[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], bytes(r["ids"])))
    want = collections.Counter((d, np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for d, t in HARD)
    for (d, n), parts in found.items():
        same = sum(c for (x, ids), c in want.items() if x == d and len(ids) == 4 * n)
        parts = sorted(set(parts))
        assert b"".join(p[2] for p in parts if True) in {ids for x, ids in want if x == d} or same > 1
    assert sum(r["length"] for r in got) == sum(len(ids) // 4 * c for (_, ids), c in want.items())
    packing.write_buckets(pieces, str(tmp_path / "b"))
    assert {r["bucket"] for r in spark.read.parquet(str(tmp_path / "b")).select("bucket").distinct().collect()} == {r["length"] for r in got}
    assert packing.pack(docs_of(spark, HARD).where("false"), queries.tokenizer_path()).count() == 0


def test_crc_of_ids(spark):
    r = packing.pack(docs_of(spark, [(1, "hello")]), queries.tokenizer_path()).withColumn("c", packing.ids_crc32(F.col("ids"))).collect()
    assert all(x["c"] == zlib.crc32(bytes(x["ids"])) for x in r)

# ---- toxicity --------------------------------------------------------------------------------------------------------


def _toxic_rows(n):
    rnd = random.Random(4)
    words = ["w%d" % i for i in range(400)]
    out = []
    for i in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randint(5, 80))]
        if bad := i % 4 == 0:
            for _ in range(2):
                text.insert(rnd.randint(0, len(text)), rnd.choice(["slimeball", "slimy", "grotto", "grottos"]))
        out.append((i, " ".join(text), int(bad)))
    return out


def test_classifier_on_held_out_rows(spark):
    rows = _toxic_rows(700)
    docs = docs_of(spark, [(i, t) for i, t, _ in rows] + HARD[:2])
    labels = spark.createDataFrame([(i, y, "c") for i, _, y in rows] + [(None, 1, "c"), (10 ** 9, 1, "c"), (3, None, "c")],
                                   "doc_id long, toxic int, score string")
    model = toxicity.fit(docs, labels, F.col("doc_id") % 3 != 1)
    got = collections.defaultdict(list)
    for r in toxicity.score_documents(docs, model).collect():
        got[r["doc_id"]].append(r)
    right = [(got[i][0]["score"] >= 0.7) == bool(y) for i, _, y in rows if i % 3 == 1]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= r["score"] <= 1 for rs in got.values() for r in rs) and len(got[None]) == 1
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns
    want = [r for rs in got.values() for r in rs if not r["rejected"]]
    assert kept.count() == len(want)


def test_classifier_without_usable_labels(spark):
    docs = docs_of(spark, HARD)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(3, 1)], "doc_id long, toxic int")
    for labels, score in ((none, 0.0), (one, 1.0)):
        got = toxicity.score_documents(docs, toxicity.fit(docs, labels)).collect()
        assert len(got) == len(HARD) and {r["score"] for r in got} == {score}
    assert toxicity.score_documents(docs.where("false"), toxicity.fit(docs, none)).count() == 0


def test_every_labelled_text_is_trained_on_in_any_partitions(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD", 100)
    taken, train = [], toxicity._train

    def seen(model, chunks, *more):
        taken.append(chunks.select("shard", F.explode("ids").alias("id")).collect())
        train(model, chunks, *more)

    monkeypatch.setattr(toxicity, "_train", seen)
    rows = _toxic_rows(700)
    docs = docs_of(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] * 2, "doc_id long, toxic int")
    models = [toxicity.fit(docs.repartition(n), labels.repartition(n), F.col("doc_id") % 3 != 1) for n in (2, 5)]
    for got in taken:
        assert sorted(int(r.id) for r in got) == [i for i, *_ in rows if i % 3 != 1] and len({r.shard for r in got}) > 3
    a, b = models
    assert np.array_equal(a.row, b.row) and np.allclose(a.emb, b.emb, atol=1e-5) and abs(a.shift - b.shift) < 1e-4
    got = toxicity.score_documents(docs, a).collect()
    right = [(r["score"] >= 0.7) == bool(rows[r["doc_id"]][2]) for r in got if r["doc_id"] % 3 == 1]
    assert sum(right) / len(right) > 0.95


def test_cuts_are_the_best_of_all_rows(spark):
    rnd = random.Random(6)
    rows = [(k, round(rnd.gauss(y, 1), 1), y) for k in "abc" for y in (0, 0, 1) for _ in range(150)]
    got = toxicity._best_cuts(toxicity._cuts(spark.createDataFrame(rows, "kind string, x double, y int").repartition(5)))
    for k in "abc":
        mine = [(x, y) for kind, x, y in rows if kind == k]
        xs = sorted({x for x, _ in mine})
        ends = [xs[0] - 2, *xs, xs[-1] + 2]
        cuts = [(-sum((x > (a + b) / 2) != y for x, y in mine), b - a, -a, (a + b) / 2) for a, b in zip(ends, ends[1:])]
        assert got[k]["errors"] == -max(c[0] for c in cuts)
        assert any(c[0] == max(cuts)[0] and c[1] > max(cuts)[1] - 1e-9 and abs(c[3] - got[k]["cut"]) < 1e-9 for c in cuts)
        for y, c in ((1, "pos"), (0, "neg")):
            assert got[k][c] == pytest.approx(np.median([x for x, label in mine if label == y]))


def test_shorter_runs_of_words_that_tell_nothing_score_alike():
    rng = np.random.default_rng(3)
    model = toxicity.Model(rng)
    model.row[:40] = np.arange(1, 41)
    model.emb = rng.normal(size=(41, toxicity.DIM)).astype(np.float32)
    model.emb[0] = 0
    model.bias = [rng.normal(size=toxicity.FILTERS).astype(np.float32) for _ in toxicity.WIDTHS]
    buckets = np.repeat(np.arange(400)[:, None], 5, axis=1).astype(np.int32)
    sizes = np.array([0, 1, 2, 3, 4, 9, 60, 500, 0])
    words = rng.integers(0, 400, sizes.sum())
    kept, short = toxicity._compact(words, sizes, model.row[buckets].any(axis=1))
    texts, less = (np.split(w, np.cumsum(n)[:-1]) for w, n in ((words, sizes), (kept, short)))
    assert len(kept) < len(words) and np.allclose(model.logits(texts, buckets), model.logits(less, buckets), atol=1e-5)


def test_long_texts_score_as_in_one_slice(monkeypatch):
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng)
    model.row[:] = rng.integers(0, 50, len(model.row))
    model.emb = rng.normal(size=(50, toxicity.DIM)).astype(np.float32)
    buckets = rng.integers(0, toxicity.BUCKETS, (300, 5)).astype(np.int32)
    texts = [rng.integers(0, 300, n) for n in (0, 1, 2, 7, 50, 1000)]
    whole = model.logits(texts, buckets)
    monkeypatch.setattr(toxicity, "SLICE", 7)
    assert np.allclose(whole, model.logits(texts, buckets), atol=1e-4)

# ---- fingerprints ----------------------------------------------------------------------------------------------------


def test_spans_and_common_extensions():
    rnd = random.Random(2)
    for _ in range(60):
        a = "".join(rnd.choice("abé𝒳") for _ in range(rnd.randint(0, 80)))
        b = a[rnd.randint(0, len(a)):] + "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 30)))
        x, y = fingerprints.Spans(a), fingerprints.Spans(b)
        for _ in range(20):
            i, k = rnd.randint(0, len(a)), rnd.randint(0, len(b))
            n = 0
            while i + n < len(a) and k + n < len(b) and a[i + n] == b[k + n]:
                n += 1
            assert x.common(i, y, k) == n
            j, m = rnd.randint(i, len(a)), rnd.randint(k, len(b))
            assert x.equal(i, j, y, k, m) == (a[i:j] == b[k:m])


@pytest.mark.parametrize("buckets", [1, 7])
def test_edited_texts(spark, buckets):
    rows = HARD + [(i, f"text number {i} " * (i % 7)) for i in range(20, 60)]
    got = fingerprints.edited_pairs(docs_of(spark, rows).repartition(4), buckets).collect()
    order = sorted([r for r in rows if r[0] is not None], key=lambda r: (-r[0], r[1] or "")) + sorted(
        [r for r in rows if r[0] is None], key=lambda r: r[1] or "")
    want = []
    for n, (d, t) in enumerate(order):
        t, after = t or "", order[(n + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        marks = [fingerprints.Fingerprint(fingerprints.Spans(x)) for x in (t, edited, after)]
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), marks[0].text, marks[1].text,
                     marks[0].likeness(marks[1]), marks[0].likeness(marks[2])))
        assert fingerprints.Fingerprint.parse(marks[0].text).likeness(marks[1]) == want[-1][5]
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted(want, key=str)
    assert fingerprints.edited_pairs(docs_of(spark, rows).where("false")).count() == 0


def test_likeness_follows_shared_text():
    rnd = random.Random(3)
    words = [str(rnd.randint(0, 10 ** 6)) for _ in range(600)]
    mark = lambda w: fingerprints.Fingerprint(fingerprints.Spans(" ".join(w)))
    same, close, far = mark(words), mark(words[:580] + ["x"] * 20), mark([str(rnd.random()) for _ in words])
    assert same.likeness(mark(words)) == 1 and same.likeness(close) > 0.8 and same.likeness(far) < 0.05

# ---- decontamination -------------------------------------------------------------------------------------------------

ITEM = "A train leaves the old station at 40 mph and after 3 hours Alice meets Bob who walked 12 miles along the river to the bridge"


def test_leaks(spark):
    other = "the quiet garden behind a small house was painted green before winter came again to our village by the lake"
    swapped = ITEM.replace("40", "65").replace("Alice", "Carol").replace("12", "7.5").replace("Bob", "Dave")
    broken = ITEM.replace("Alice meets Bob", "Carol meets Carol")  # two names became one
    rows = [(1, "before words. " + ITEM + " and after it"), (2, "x " + swapped + " y"), (3, broken.replace("40", "3").replace("the old", "an").replace("walked", "ran")),
            (4, other), (5, ITEM.lower()), (6, ITEM[:40]), (7, ITEM * 3 + " " + other), (None, ITEM), (8, None), (8, ""), (1, "clean row of a repeated id")]
    items = spark.createDataFrame([(10, ITEM, "c"), (10, ITEM, "c"), (11, other, "c"), (12, "tiny one", "c"), (13, "", "c"), (14, None, "c")],
                                  "item_id long, text string, digest string")
    got = decontaminate.contaminated(docs_of(spark, rows), items).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=str) == sorted(
        [(1, 10), (2, 10), (4, 11), (5, 10), (7, 10), (7, 11), (None, 10)], key=str)
    assert {r["doc_id"]: r["literal_share"] for r in got}[1] == 1.0
    kept = decontaminate.clean(docs_of(spark, rows), items)
    assert kept.columns == docs_of(spark, rows).columns
    assert sorted((r["doc_id"] for r in kept.collect())) == [1, 3, 6, 8, 8]
    empty = items.where("false")
    assert decontaminate.contaminated(docs_of(spark, rows), empty).count() == 0
    assert decontaminate.contaminated(docs_of(spark, rows).where("false"), items).count() == 0


def test_planted_items_are_found_and_no_more(spark):
    sf = "/root/testdata/sf0.001"
    got = {(r["doc_id"], r["item_id"]) for r in queries.op10_decontamination(spark, sf).collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    planted = {(r["doc_id"], i) for r in docs for i, t in items if t in r["text"]}

    def grams(text):
        words = re.findall(r"\w+", text.lower())
        return set(zip(*(words[k:] for k in range(8))))

    of_items = {i: grams(t) for i, t in items}
    touched = {(r["doc_id"], i) for r in docs for own in [grams(r["text"])] for i, g in of_items.items() if g & own}
    assert planted and planted <= got <= touched


def test_rolled_windows_are_polynomials():
    rnd = random.Random(4)
    codes = [rnd.getrandbits(64) for _ in range(40)]
    mix, mask = int(decontaminate.MIX), (1 << 64) - 1
    for width in range(1, 14):
        got = decontaminate._rolled(np.array(codes, np.uint64), width)
        want = np.array([len(codes)] * 0, np.uint64)
        for k in range(len(codes) - width + 1):
            h = 0
            for c in codes[k:k + width]:
                h = h * mix + c
            want = np.append(want, np.uint64((h * mix + width) & mask))
        # narrower windows join from parts, whose order of powers is their own: equal windows must get equal hashes
        assert len(got) == len(want)
        if width & (width - 1) == 0:
            assert (got == decontaminate._mixed(want)).all()
        again = decontaminate._rolled(np.array(codes[5:] + codes[:width + 5], np.uint64), width)
        assert (got[5:] == again[:len(got) - 5]).all() and len(set(got.tolist())) == len(got)


def _long_item(n):
    rnd = random.Random(n)
    return ["".join(rnd.choice("abcdefghijklmnoprstuvwy") for _ in range(7)) for _ in range(n)]


def test_passages_of_long_items(spark):
    short, long = _long_item(59), _long_item(500)
    filler = ["filler%s" % c for c in "abcdefghijklmnopqrstuvwxyz"]
    edited = lambda words, every: [("changed" if i % every == every - 1 else w) for i, w in enumerate(words)]
    added = [x for i, w in enumerate(short) for x in ((w, "added") if i % 12 == 11 else (w,))]
    left = [w for i, w in enumerate(short) if i % 13 != 12]
    texts = {1: filler + short[10:42] + filler, 2: filler + long[100:350] + filler, 3: edited(short, 13), 4: filler + edited(long[200:280], 13),
             5: added, 6: left, 7: long[20:33], 8: filler + long[20:32] + filler, 9: short[:8] + filler + short[30:38],
             10: short[:8] + ["x"] * 9 + short[17:25], 11: short[40:48] + ["x"] + short[20:28], 12: filler + long[1:9] + filler * 400 + short[5:20]}
    items = spark.createDataFrame([(1, " ".join(short)), (2, " ".join(long))], "item_id long, text string")
    docs = docs_of(spark, [(d, " ".join(t)) for d, t in texts.items()])
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(1, 1), (2, 2), (3, 1), (4, 2), (5, 1), (6, 1), (7, 2), (12, 1)}
    assert sorted(r["doc_id"] for r in decontaminate.clean(docs, items).collect()) == [8, 9, 10, 11]


def test_slots_are_judged_by_passage(spark):
    copy = ITEM.replace("40", "65").replace("Alice", "Carol").replace("12", "7.5").replace("Bob", "Dave")
    stray = "leaves the old station at 99 mph and"
    one_value = ITEM.replace("40", "4").replace("after 3", "after 4")  # two numbers became one
    two_names = ITEM.replace("Alice meets Bob", "Carol meets Carol").replace("40", "65")
    swap = "Then it says that Alice leaves 5 miles of the old wall to our friend and walks on by the river with Bob to Alice at home"
    texts = {1: f"It {stray} stops. {copy}", 2: one_value, 3: f"{copy}. It {stray} stops", 4: two_names, 5: f"It {stray} stops",
             6: swap.replace("to Alice", "to Carol").replace("Bob", "Dave"), 7: f"{two_names}. {copy}",
             8: "leaves the old garden " + " ".join("1 2 3 4 5 6 7 8 9 10 11 12 13 14 15".split() * 30)}
    items = spark.createDataFrame([(1, ITEM), (2, " ".join(str(n) for n in range(20, 36)) + " are the numbers of our streets and lanes")],
                                  "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs_of(spark, list(texts.items())), items).collect()}
    assert {(1, 1), (2, 1), (3, 1), (7, 1)} <= got and not {4, 5, 6} & {d for d, _ in got}


def test_parts_with_consistent_slots_are_the_longest():
    rnd = random.Random(9)
    for _ in range(300):
        run = [(p, *(" ".join(f"0:{k}{v}" for k, v in x) for x in zip(*[((k, rnd.choice("ab")), (k, rnd.choice("cd"))) for k in rnd.choices("12", k=1)])))
               for p in range(rnd.randint(1, 12))]
        fits = lambda i, j: decontaminate._consistent({x for _, a, b in run[i:j] for x in decontaminate._pairs(a, b)})
        spans = [(i, j) for i in range(len(run)) for j in range(i + 1, len(run) + 1) if fits(i, j)]
        want = {(i, j) for i, j in spans if not any((a, b) != (i, j) and a <= i and j <= b for a, b in spans)}
        got = {(m.first, m.end) for m in decontaminate._consistent_parts(run, 0, 1)}
        assert got == want

# ---- suffix runs -----------------------------------------------------------------------------------------------------


def brute_dedup(rows, length):
    first = {}
    keyed = [(d, suffix_dedup.NO_ID if d is None else d, (t or "").encode()) for d, t in rows]
    for _, k, t in keyed:
        for i in range(len(t) - length + 1):
            w = t[i:i + length]
            first[w] = min(first.get(w, k), k)
    out = []
    for d, k, t in keyed:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if first[t[i:i + length]] < k:
                gone[i:i + length] = b"\1" * length
        runs = [(m.start(), m.end()) for m in re.finditer(b"\1+", gone)]
        out.append((d, len(t), bytes(c for c, g in zip(t, gone) if not g), runs))
    return sorted(out, key=str)


@pytest.mark.parametrize("length, gram, blocks", [(50, 20, 5), (6, 3, 3), (9, 1, 1)])
def test_suffix_dedup_against_brute_force(spark, length, gram, blocks):
    rnd = random.Random(length)
    rows = [(d, t if t is None or len(t) < 2000 else t[:1500]) for d, t in HARD]
    shared = ["".join(rnd.choice("abc é") for _ in range(rnd.randint(3, 120))) for _ in range(6)]
    for i in range(60):
        parts = [rnd.choice(shared) if rnd.random() < 0.5 else "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 90))) for _ in range(3)]
        rows.append((rnd.choice([None, *range(40)]), "".join(parts)))
    got = suffix_dedup.dedup(docs_of(spark, rows).repartition(3), length, gram, blocks).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], bytes(r["kept"]), list(zip(r["starts"], r["ends"]))) for r in got),
                  key=str) == brute_dedup(rows, length)
    assert suffix_dedup.dedup(docs_of(spark, rows).where("false")).count() == 0


def test_merge_reads_no_known_prefix(monkeypatch):
    rnd = random.Random(6)
    runs = [sorted("".join(rnd.choice("ab") for _ in range(rnd.randint(1, 30))).encode() for _ in range(rnd.randint(0, 40))) for _ in range(7)]
    plain = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    shared = [bytes([0] + [plain(a, b) for a, b in zip(r, r[1:])])[:len(r)] for r in runs]
    real, looked = suffix_dedup._agree, []

    def agree(a, b, known):
        assert a[:known] == b[:known]
        looked.append(real(a, b, known) - known + 1)
        return real(a, b, known)

    monkeypatch.setattr(suffix_dedup, "_agree", agree)
    out = list(suffix_dedup.merge_runs(runs, shared))
    keys = [runs[r][i] for r, i, _ in out]
    assert keys == sorted(k for r in runs for k in r)
    assert [s for _, _, s in out][1:] == [plain(a, b) for a, b in zip(keys, keys[1:])]
    # each look ends at the first byte not known yet, so looks read no more than the bytes of the keys put out
    assert sum(looked) <= sum(len(k) + 8 for k in keys)

# ---- Jaccard join and components -------------------------------------------------------------------------------------


def brute_components(rows, k, near):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            n = len(a & sets[j])
            if n and n * near.denominator >= near.numerator * (len(a) + len(sets[j]) - n):
                up[root(i)] = root(j)
    return sets, [root(i) for i in range(len(rows))]


def near_rows(rnd, groups):
    rows = [(d, t if t is None or len(t) < 5000 else t[:3000]) for d, t in HARD]
    for _ in range(groups):
        base = [f"w{rnd.randint(0, 70)}" for _ in range(rnd.randint(3, 150))]
        for _ in range(rnd.randint(1, 8)):
            p = rnd.choice([0, 0.005, 0.02])
            rows.append((rnd.randint(10, 300), " ".join(w if rnd.random() > p else f"z{rnd.randint(0, 99)}" for w in base)))
    return rows


@pytest.mark.parametrize("k, near, limit, pivots", [(3, Fraction(9, 10), jaccard_join.LIMIT, 32), (1, Fraction(1, 2), 200, 8)])
def test_components_against_brute_force(spark, monkeypatch, k, near, limit, pivots):
    monkeypatch.setattr(jaccard_join, "PIVOTS", pivots)
    monkeypatch.setattr(jaccard_join, "PENDING", 500)
    monkeypatch.setattr(jaccard_join, "BLOCK", 100)
    rows = near_rows(random.Random(k), 7)
    sets, root = brute_components(rows, k, near)
    least = collections.defaultdict(list)
    for (d, _), r in zip(rows, root):
        least[r].append(d)
    want = [(d, len(s), min((x for x in least[r] if x is not None), default=None) if s else d) for (d, _), s, r in zip(rows, sets, root)]
    docs = docs_of(spark, rows).repartition(3)
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.near_components(docs, k, near, limit).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    if k == 1:  # the split of large regions is the point of this case
        return
    kept = jaccard_join.one_of_each(docs, k, near, limit)
    assert kept.columns == docs.columns
    firsts = {}
    for (d, t), s, r in zip(rows, sets, root):
        key = (d is None, d or 0, hashlib.md5((t or "").encode()).hexdigest())
        group = r if s else ("alone", d, t or "")
        firsts[group] = min(firsts.get(group, (key, d, t or "")), (key, d, t or ""), key=lambda x: x[0])
    assert sorted(((r["doc_id"], r["text"] or "") for r in kept.collect()), key=str) == sorted({(d, t) for _, d, t in firsts.values()}, key=str)


PROSE = [f"Paragraph {i} tells at some length how the river {w}, and what the people on its banks made of it." for i, w in enumerate(("rose", "fell", "froze", "turned", "sank"))]


@pytest.mark.parametrize("before, after", [
    ('<div class="site nav-open">', "</div>"), ('<div class="page search-results"><article>', "</article></div>"),
    ('<div class="article share">', "</div>"), ('<div class="elementor elementor-widget">', "</div>"), ("<form action='/x'>", "</form>")])
def test_named_boxes_that_hold_the_text_stay(before, after):
    inner = "".join(f"<p>{p}</p>" for p in PROSE)
    aside = '<nav><a href="/">Home</a></nav><div class="newsletter">Sign up now</div><div class="comments"><p>Nice one</p></div>'
    page = f"<html><body>{before}{inner}{after}{aside}<footer>Imprint</footer></body></html>"
    assert html_text.main_text(page) == "\n\n".join(PROSE)
    page = f"<html><body>{before}{inner}{aside}{after}<footer>Imprint</footer></body></html>"
    assert html_text.main_text(page) == "\n\n".join(PROSE)


def test_named_boxes_beside_an_article_go():
    talk = "".join(f"<li><article><p>{p * 3}</p></article></li>" for p in PROSE)
    inner = "".join(f"<p>{p}</p>" for p in PROSE)
    for form in ("<form><label>Your name</label><p>" + PROSE[0] * 9 + "</p></form>", ""):
        page = f'<body><article>{inner}</article><ol class="comments">{talk}</ol>{form}</body>'
        assert html_text.main_text(page) == "\n\n".join(PROSE)
    assert html_text.main_text('<body><form><input name="q"><button>Search</button></form></body>') == ""


def test_stray_tags_take_no_walk():
    began = time.perf_counter()
    html_text.main_text("<body><i><article>" + "<b>x" * 20000 + "</i>" * 20000)
    html_text.main_text("<body>" + "<b>x" * 20000 + "</i></p>" * 20000)
    assert time.perf_counter() - began < 5


def test_linked_sets_meet_in_a_cell():
    rnd, linked = random.Random(1), 0
    for near in (Fraction(9, 10), Fraction(4, 5), Fraction(3, 4), Fraction(1, 2)):
        bands = jaccard_join.Bands(near)
        for _ in range(400):
            n = rnd.choice([1, 2, 3, 4, 5, 6, 8, 10, 15, 20, 30, 60, 120, 300])
            a = np.unique(np.array([rnd.getrandbits(64) for _ in range(n)], np.uint64))
            cut, more = rnd.randint(0, int(n * (1 - near)) + 1), rnd.randint(0, int(n * (1 / near - 1)) + 1)
            b = np.unique(np.concatenate([a[cut:], np.array([rnd.getrandbits(64) for _ in range(more)], np.uint64)]))
            both = len(np.intersect1d(a, b))
            if len(b) and both * near.denominator >= near.numerator * (len(a) + len(b) - both):
                linked += 1
                assert len(np.intersect1d(bands.cells(a), bands.cells(b)))
                share = np.uint64(rnd.choice([0, 1, 5, 9, 10]))  # tenths of the shingles that count as frequent
                assert len(np.intersect1d(bands.cells(a, a[a % np.uint64(10) >= share]), bands.cells(b, b[b % np.uint64(10) >= share])))
    assert linked > 500


def test_links_of_a_region_keep_its_components():
    rnd = random.Random(8)
    for near in (Fraction(9, 10), Fraction(4, 5), Fraction(1, 2)):
        base = set(range(60))
        sets = [np.array(sorted(rnd.sample(sorted(base), rnd.randint(40, 60)) + [100 + rnd.randint(0, 30) for _ in range(rnd.randint(0, 9))]), np.uint64)
                for _ in range(60)]
        sets = [np.unique(s) for s in sets]

        def labels(links):
            up = list(range(len(sets)))
            for a, b in links:
                ra, rb = a, b
                while up[ra] != ra:
                    ra = up[ra]
                while up[rb] != rb:
                    rb = up[rb]
                up[ra] = rb
            out = []
            for i in range(len(sets)):
                while up[i] != i:
                    i = up[i]
                out.append(i)
            return [out.index(x) for x in out]

        every = [(i, j) for i in range(len(sets)) for j in range(i)
                 if len(np.intersect1d(sets[i], sets[j])) * near.denominator >= near.numerator * len(np.union1d(sets[i], sets[j]))]
        found = jaccard_join.join_region(sets, near)
        assert {(max(x), min(x)) for x in found} <= set(every) and labels(found) == labels(every)


def test_pieces_make_the_bitmap():
    rnd = np.random.default_rng(4)
    for n in (0, 1, 5000):
        spot = np.unique(rnd.integers(0, 1 << 16, n))
        for buckets in (1, 7, 3000):
            out = np.zeros(1 << 10, np.int64)
            for _, at in jaccard_join._by_bucket(spot, 1 << 16, buckets):
                for r in jaccard_join._piece(spot[at]).to_pylist():
                    words = np.frombuffer(r["words"], "<i8")
                    assert not out[r["at"]:r["at"] + len(words)].any()  # no two buckets share a word
                    out[r["at"]:r["at"] + len(words)] = words
            assert np.flatnonzero(jaccard_join._holds(out, np.arange(1 << 16))).tolist() == spot.tolist()
    assert jaccard_join._piece(np.zeros(0, np.int64)).num_rows == 0


def test_driver_gets_pieces_and_no_rows_of_the_join(spark, monkeypatch):
    """Bitmaps of cells, frequent shingles and sets reach the driver as a few pieces, whatever they hold."""
    rnd, got = random.Random(3), []
    common = " ".join(f"c{i}" for i in range(400))
    rows = [(2 * i + j, " ".join(w) + f" {common}" * (i % 2)) for i in range(60) for w in [[f"w{rnd.random()}" for _ in range(600)]] for j in range(2)]
    rows = [(d, t + " end" * (d % 2)) for d, t in rows]
    docs = docs_of(spark, rows)
    for name in ("collect", "toPandas"):
        monkeypatch.setattr(type(docs), name, lambda self, f=getattr(type(docs), name): got.append(len(out := f(self))) or out)
    _, links = jaccard_join.jaccard_join(docs, 5, Fraction(4, 5))
    monkeypatch.undo()
    assert links.count() == 60
    assert got and max(got) <= 1024 and sum(got) < 2000


def test_empty_documents_table(spark):
    none = docs_of(spark, HARD).where("false")
    assert jaccard_join.one_of_each(none).count() == 0


def test_connected_components(spark):
    rnd = random.Random(5)
    edges = [(f"{rnd.random()}"[2:6], f"{rnd.random()}"[2:6]) for _ in range(1500)] + [(f"p{i}", f"p{i + 1}") for i in range(20)] + [("x", "x"), (None, "y")]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(edges, "a string, b string")).collect()}
    up = {}
    find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
    for a, b in edges:
        if a is not None and a != b:
            up[find(a)] = find(b)
    assert set(got) == set(up)
    pairs = {(find(n), lab) for n, lab in got.items()}
    assert len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs)
    assert components.components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_size_estimates_do_not_grow_with_the_rounds(spark):
    """(Before, the planner's estimate of bytes had three times as many digits after each round, in the driver's memory.)"""
    name = [hashlib.md5(str(i).encode()).hexdigest() for i in range(301)]
    got = components.components(spark.createDataFrame(list(zip(name, name[1:])), "a string, b string"))
    assert got.count() == 301 and got.select("label").distinct().count() == 1
    assert got._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 10 ** 9


def test_pairs_of_a_large_region_have_all_links():
    """(Before, each set of a large region without a link took its turn in a round of 32 pivots.)"""
    rnd, none = random.Random(6), SimpleNamespace(value=np.zeros(jaccard_join.HEAVY_BITS // 64, np.int64))
    for near in (Fraction(4, 5), Fraction(1, 2)):
        word = lambda: rnd.getrandbits(64)
        bases = [[word() for _ in range(rnd.randint(1, 60))] for _ in range(8)]
        sets = [np.unique(np.array(rnd.sample(b, max(1, len(b) - rnd.randint(0, 6))) + [word() for _ in range(rnd.randint(0, 6))], np.uint64))
                for b in bases for _ in range(8)]
        keys = [jaccard_join.set_key(s) for s in sets]
        of = dict(zip(keys, sets))
        batch = pa.RecordBatch.from_pydict({"key": pa.array(keys, pa.binary()), "tokens": pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary()),
                                            "label": pa.array(keys, pa.binary())})
        seats = pa.Table.from_batches(jaccard_join._seats(near, none)([batch])).sort_by([("cell", "ascending"), ("key", "ascending")])
        want = {(max(a, b), min(a, b)) for a in of for b in of if a != b
                and jaccard_join._linked(len(np.intersect1d(of[a], of[b])), len(of[a]), len(of[b]), near)}
        for size in (211, 100_000):  # cells may go on in the next batch
            rows = pa.Table.from_batches(jaccard_join._pairs(near, True)(seats.to_batches(size))).to_pylist()
            every = {(r["a"], r["b"]) for r in rows}
            assert len(want) > 50 and want <= every and len(every) < 3 * len(want) + 300
            one = pa.Table.from_batches(jaccard_join._pairs(near, False)(seats.to_batches(size))).to_pylist()
            assert {(r["a"], r["b"]) for r in one} <= every and {a for a, _ in want} <= {r["a"] for r in one}
        tokens = lambda ks: pa.array([of[k].astype("<u8").tobytes() for k in ks], pa.binary())
        a, b = zip(*sorted(every))
        met = pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), tokens(a), tokens(b)], names=["a", "b", "tokens_a", "tokens_b"])
        assert {(r["a"], r["b"]) for out in jaccard_join._verified(near)([met]) for r in out.to_pylist()} == want

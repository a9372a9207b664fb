"""Texts with very many matches, rows that differ in one column only, double vectors, and walks against the exact search."""

import random
import re
import time
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from hazeline.llm import decontaminate, mixing, neighbours, secrets, spans

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS)


def test_places_of_very_many_matches(spark):
    many = "ab12 " * 200_000
    texts = [many, "x " + "7 " * 700 + "é 9", "1", "", "none", "1" * 300 + " 2 " * 256, "3," * 257]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    started = time.time()
    got = {r["i"]: r for r in df.select("i", spans.spans(F.col("t"), "[0-9]++").alias("s")).collect()}
    assert time.time() - started < 60
    for i, t in enumerate(texts):
        want = [(m.start(), m.end(), m[0], t[max(0, m.start() - 24):m.start()], t[m.end():m.end() + 24]) for m in re.finditer("[0-9]+", t)]
        s = got[i]["s"]
        assert [(x["start"], x["stop"], x["value"]) for x in s] == [w[:3] for w in want]
    few = df.select("i", spans.spans(F.col("t"), "[0-9]++", lambda v: v != "7").alias("s")).where("i = 1").first()["s"]
    assert [(x["start"], x["value"]) for x in few] == [(texts[1].index("9"), "9")]


def test_repeats_with_many_strings_stay_whole(spark):
    regex = "(?:abc|def|ghi|jkl|mno|pqr|stu|vwx){2}"
    rules = [("pairs", regex, None)]
    docs = frame(spark, [(0, "vwxvwx"), (1, "abcdef"), (2, "vwx vwx"), (3, None)])
    got = {r["doc_id"]: [(s["start"], s["stop"]) for s in r["pairs"]] for r in secrets.scanned(docs, rules).collect()}
    assert got == {0: [(0, 6)], 1: [(0, 6)], 2: [], 3: []}
    assert len(secrets.trigram_query("(?:ab|cd){2}x")) == 4


def test_mix_of_rows_that_differ_in_one_column(spark):
    rng = random.Random(1)
    rows = [(i % 40, f"text of {i % 7} words " * (i % 7), "en", rng.choice(["a", "b", None]), i % 3) for i in range(2000)]
    data = spark.createDataFrame(rows, DOCS)
    key = lambda df: Counter(tuple(r) for r in df.collect())
    first = key(mixing.take(data))
    assert first == key(mixing.take(data.repartition(7))) == key(mixing.take(data.orderBy(F.rand(3))))
    plan = mixing.mixed(data).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("t"), F.max("target").alias("w")).collect()
    taken = Counter()
    for r, n in first.items():
        taken[r[3]] += n * len((r[1] or "").split())
    assert {r["source"]: r["t"] for r in plan} == {s: taken[s] for s in ("a", "b", None)}


def test_double_vectors_keep_their_digits(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 100)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 10)) + 1e-9
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = neighbours.nearest(rows, rows.where("id % 20 = 0")).collect()
    right = 0
    for q in range(0, 500, 20):
        s = x @ x[q]
        best = set([i for i in np.lexsort((np.arange(500), -s)) if i != q][:20])
        own = [r for r in got if r["query_id"] == q]
        right += len(best & {r["vec_id"] for r in own})
        assert len(own) == 20 and all(abs(r["score"] - s[r["vec_id"]]) < 1e-12 for r in own)
    assert right >= 0.9 * 20 * 25


def test_walks_reach_their_recall(spark):
    """Occurrences with all allowed edits, against the exact search and against what was planted."""
    rng = random.Random(12)
    common = [f"w{i}" for i in range(30)]
    text = lambda n: [rng.choice(common) if rng.random() < 0.4 else f"v{rng.randrange(3000)}" for _ in range(n)]
    items = [(i, " ".join(text(n))) for i, n in enumerate([8, 9, 12, 16, 20, 27, 33, 40, 64, 100] * 3)]
    docs, planted = [], {}
    for k in range(600):
        i, t = items[k % len(items)]
        w = t.split()
        for _ in range(decontaminate.edits(len(w)) - k % 2):
            kind, at = rng.randrange(3), rng.randrange(len(w))
            w[at:at + (kind != 0)] = [f"v{rng.randrange(3000)}"] if kind != 1 else []
        docs.append((k, " ".join(text(rng.randrange(40)) + w + text(rng.randrange(40)))))
        planted[k] = i
    docs += [(1000 + k, " ".join(text(200))) for k in range(100)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    pairs = lambda exact: {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(frame(spark, docs), bench, exact=exact).collect()}
    walked, exact = pairs(False), pairs(True)
    assert walked <= exact and set(planted.items()) <= exact
    assert len(walked) >= 0.97 * len(exact)
    assert not [p for p in exact if p[0] >= 1000]


def test_walks_say_little_of_other_windows():
    """What selects: hardly any unrelated window has a hash of an item."""
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(f"v{x}" for x in rng.integers(0, 5000, 40))) for i in range(20)]
    items = decontaminate.Items(rows)
    h = np.concatenate([items.words[0], rng.integers(1, 1 << 62, 4000, np.uint64)])
    start = np.arange(0, 4000)
    window, found = items._selected(h, start, np.full(4000, 40), np.full(4000, len(h)))
    assert (0, 0) in set(zip(window.tolist(), found.tolist()))
    assert len(set(window[window > 60].tolist())) < 0.02 * 4000
    assert 1 < items.walks[40] < 400 and decontaminate.needed(5, 0) == 1

"""The operators against brute force on small tables with nulls, empty and repeated rows, ties and clashing names."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hazeline.llm import (decontaminate, mixing, neighbours, ngram_join, passages, pii, quality, secrets, sharding, toxicity,
                          words)

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, scope string, row string, `key` string"
BLANK = re.compile(rb"[\x20\x09-\x0D]+")


def frame(spark, rows, source=lambda i: f"s{i % 3}"):
    """Documents with extra columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, "en", source(i) if i is not None else None, None, "x", "y", "z") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, odd blanks, very short and one long text, nulls and repeated rows."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["Émile", "straße", "日本", "a", "the"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base, passage = [text(60) for _ in range(12)], text(30)
    out = [(10 + i, t) for i, t in enumerate(base)]
    for i in range(40):
        found = rng.choice(base).split(" ")
        for _ in range(rng.randint(0, 5)):
            found[rng.randrange(len(found))] = rng.choice(vocabulary)
        out.append((100 + i, rng.choice([" ", "\n", "\t ", "  "]).join(found).upper() if i % 7 == 0 else " ".join(found)))
    out += [(200 + i, text(15) + " " + passage + "\x0b" + text(9)) for i in range(8)]
    out += [(300, ""), (301, None), (302, "  \n"), (303, "one two"), (304, "one two"), (305, "a b c d e"), (306, text(3000) + passage),
            (None, base[0]), (None, "null id"), (10, base[0]), (10, base[0]), (307, "  nbsp word")]
    return out


def split(t):
    return [w for w in BLANK.split((t or "").encode()) if w]


def test_words_and_windows():
    texts = ["a  b\tc", None, "", "x", " é ü\n", "b c d e f g"]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())}).slice(0)
    (w,) = words.texts(batch, "text")
    assert w.counts().tolist() == [len(split(t)) for t in texts]
    h = w.hashes()
    found = [bytes(w.data[a:b]) for a, b in zip(w.start, w.end)]
    assert found == [x for t in texts for x in split(t)]
    assert all((h[i] == h[j]) == (found[i] == found[j]) for i in range(len(h)) for j in range(len(h)))
    value, place = w.windows(h, 2)
    assert [tuple(found[p:p + 2]) for p in place] == [(x[i], x[i + 1]) for t in texts for x in [split(t)] for i in range(len(x) - 1)]
    assert not list(words.texts(batch.slice(0, 0), "text"))


def test_passages_against_brute_force(spark, rows):
    first = {}
    for i, t in rows:
        w = split(t)
        for k in range(len(w) - 12):
            if i is not None:
                g = tuple(w[k:k + 13])
                first[g] = min(first.get(g, i), i)
    want = Counter()
    for i, t in rows:
        w = split(t)
        gone = {k + j for k in range(len(w) - 12) for j in range(13) if i is not None and first[tuple(w[k:k + 13])] < i}
        want[i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()] += 1
    for size in (300, 1 << 20):
        got = passages.deduplicated(frame(spark, rows), scope_bytes=size).collect()
        assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == want
    assert passages.deduplicated(frame(spark, [])).count() == 0


def shingles(t):
    w = [x.lower() for x in split(t)]
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)].append(i)
    return Counter((i, len(sets[k]), (i if not sets[k] else min(least[find(k)], default=None))) for k, (i, _) in enumerate(rows))


def test_ngram_join_against_brute_force(spark, rows, monkeypatch):
    want = components(rows)
    for held in (ngram_join.HELD, 500):
        monkeypatch.setattr(ngram_join, "HELD", held)
        got = ngram_join.joined(frame(spark, rows)).collect()
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    assert ngram_join.joined(frame(spark, [])).count() == 0


def test_packed_hashes_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 2, 50, 3000):
        x = np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
        assert (ngram_join._unpack(ngram_join._pack(x)) == x).all()
    assert len(ngram_join._unpack(ngram_join._pack(np.zeros(0, np.uint64)))) == 0


def test_ngram_join_answers_one_bucket_at_a_time():
    rng = np.random.default_rng(2)

    def asked(bucket):
        token = np.sort(rng.integers(0, 1 << 62, 100_000, np.uint64))
        return ngram_join._row(bucket, 0, np.arange(2, dtype=np.int64), np.full(2, 50_000, np.int32), rng.integers(0, 2, len(token)).astype(np.uint16),
                               ngram_join._pack(token), token[:1].copy())

    def peak(batches):
        tracemalloc.start()
        try:
            told = list(ngram_join._answer(16)(iter(batches)))
            return sum(b.num_rows for b in told), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    batches = [asked(b) for b in range(16)]
    peak(batches[:1])
    one, all_ = peak(batches[:1]), peak(batches)
    assert one[0] and all_[0] and all_[1] < 2 * one[1]


PII = ["mail a.b@c.d_e@f.gh x@y", "10.0.0.1 999.1.1.1 1.2.3.4.5 007.8.9.10", "card 4111 1111-1111 1111, 4111111111111112 5 5", "+49 (30) 1234-5678. +1 2 +12345678901234567890",
        "é😀 u@v.w +1-202-555-0147x", "", None, "1" * 3000, "@" * 50 + "a@b", "a" * 20000 + "@", "1." * 5000, "reach me: jane [at] site [dot] org", "9 " * 4000]
BASE_PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(x) * 2, 10)) if k % 2 else int(x) for k, x in enumerate(reversed(d))) % 10 == 0


def good_pii(kind, v):
    d = re.sub("[^0-9]", "", v)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in v.split(".")), "card": 16 <= len(d) <= 19 and luhn(d),
            "phone": 8 <= len(d) <= 15}[kind]


def test_pii_base_spans(spark):
    rows = list(enumerate(PII)) + [(0, PII[0]), (None, PII[1])]
    got = pii.detected(frame(spark, rows)).select("doc_id", secrets.listed(pii.KINDS, True).alias("s")).collect()
    want = Counter()
    for i, t in rows:
        found = [f"{k}:{m.start()}:{m.end()}" for k, p in BASE_PII.items() for m in re.finditer(p, t or "") if good_pii(k, m[0])]
        want[i, ",".join(found)] += 1
    assert Counter((r["doc_id"], r["s"]) for r in got) == want
    assert pii.detected(frame(spark, [])).count() == 0


def test_pii_trees_add_loose_forms_and_leave_words_alone(spark):
    rng = random.Random(2)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    cards = ["4111111111111111", "5500005555555559", "4012888888881881"]
    docs = [(i, f"text {i} mail me at user{i}@host{i}.org or call +49 30 {number(7)} from 10.0.{i % 256}.{i % 200} card {cards[i % 3]} ref {number(16)} host 300.{i}.1.1 {number(5)}") for i in range(300)]
    docs += [(1000, "write to jane [at] site [dot] org today"), (1001, "only plain words at noon, dot the i"), (1002, "at 3 of 5")]
    got = {r["doc_id"]: r for r in pii.detected(frame(spark, docs)).collect()}
    assert [(s["start"], s["stop"]) for s in got[1000]["more_email"]] == [(9, 33)]
    for i in (1001, 1002):
        assert not any(got[i][f"{m}{k}"] for m in ("", "more_") for k in pii.KINDS)


def test_pii_trees_see_every_labelled_candidate(spark, monkeypatch):
    seen = []

    class Stop(Exception):
        pass

    def fit(self, data):
        seen.append(data.agg(F.sum("n" if "n" in data.columns else F.lit(1))).first()[0])
        raise Stop

    monkeypatch.setattr(pii.GBTClassifier, "fit", fit)
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("host 10.1."), F.col("id") % 400, F.lit("."), F.col("id")).alias("text"))
    with pytest.raises(Stop):
        pii.detected(docs)
    # three of four candidates (the addresses and the numbers in them); the others set the threshold
    assert 90_000 < seen[0] < 110_000


SECRETS = ['password = "hunter22"', "TOKEN:abc", "api_key='A/b+c=d.e_f-' Api-Key: no apikey:xyz123", "AKIA" + "A1" * 8 + " AKIAAKIA" + "B" * 12 + "x", "deadbeef" * 3 + "g" + "0" * 23,
           "", None, "secret" * 500, "token=" * 300, "a" * 30000, "é😀 passwd:  ünicode secret =abcdef1", "ghp_" + "a" * 36, "xoxb-1234567890-abc", "Key apiKey=abcdefgh tokenſ=abcdef"]
BASE_SECRETS = [("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
                ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24)]


def test_secret_base_spans(spark):
    rows = list(enumerate(SECRETS)) + [(0, SECRETS[0]), (None, SECRETS[3])]
    got = secrets.scanned(frame(spark, rows)).select("doc_id", secrets.listed(secrets.BASE, False).alias("s"), F.size("forge").alias("f"), F.size("chat").alias("c")).collect()
    want = Counter()
    for i, t in rows:
        # letters there in either case means A-Z and a-z only
        found = sorted((m.start(), k, f"{n}:{m.start()}:{m.end()}") for k, (n, p, ok) in enumerate(BASE_SECRETS) for m in re.finditer(p, t or "", re.A) if ok(m))
        want[i, ",".join(x[2] for x in found)] += 1
    assert Counter((r["doc_id"], r["s"]) for r in got) == want
    assert {r["doc_id"] for r in got if r["f"]} == {11} and {r["doc_id"] for r in got if r["c"]} == {12}
    assert secrets.scanned(frame(spark, [])).count() == 0


def test_trigram_queries():
    assert secrets.trigram_query("abcd") == [["abc", "bcd"]]
    assert secrets.trigram_query("(?:abc|xyz)d?") == [["abc"], ["xyz"]]
    assert secrets.trigram_query("[a-z]+") == [] and secrets.trigram_query("abc|[0-9]+") == []
    assert secrets.trigram_query("abc[0-9]+def") == [["abc", "def"]]


@pytest.mark.parametrize("query", ["op2_pii_boosted", "op4_secret_trigrams"])
def test_native_operators_run_no_python(spark, query):
    from hazeline.llm.queries import QUERIES

    plan = QUERIES[query](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_toxicity_chain_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    learn = labels.where("doc_id % 4 != 0")
    got = toxicity.judged(docs.withColumn("number", F.lit(1)), learn).join(labels.where("doc_id % 4 = 0").select("doc_id", F.col("toxic").alias("y")), "doc_id").collect()
    assert got and all(0 <= r["p_toxic"] <= 1 for r in got)
    assert sum(r["toxic"] == 1 and r["y"] == 0 for r in got) <= 0.02 * len(got)
    plain = [r for r in got if r["y"] == 1 and r["lang"] == "en"]
    assert sum(r["toxic"] for r in plain) >= 0.7 * len(plain)


def test_toxicity_edges(spark):
    docs = frame(spark, [(1, "a b"), (2, None), (None, "x"), (1, "a b")])
    for labels in ([], [(1, 1, 1)], [(None, 1, 1), (7, 0, 0)], [(1, None, None)]):
        out = toxicity.judged(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
        assert len(out) == 4 and all(r["p_toxic"] is not None for r in out)
    assert toxicity.judged(frame(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_shards(spark, rows):
    many = rows + [(1000 + i, "same text") for i in range(200)]
    got = sharding.sharded(frame(spark, many)).collect()
    n = Counter(r["shard"] for r in got)
    assert len(got) == len(many) and set(n) == set(range(8)) and max(n.values()) - min(n.values()) <= 1
    for b in n:
        assert sorted(r["slot"] for r in got if r["shard"] == b) == list(range(n[b]))
    text = lambda t: (t or "").encode()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len(text(t)) + 1, zlib.crc32(text(t))) for i, t in many)
    # the small groups of copies are whole
    groups = defaultdict(set)
    for r in got:
        if r["linked"]:
            groups[r["group_key"]].add(r["shard"])
    assert sum(len(g) == 1 for g in groups.values()) >= len(groups) - 1
    assert sharding.sharded(frame(spark, [])).count() == 0
    assert [r["shard"] for r in sharding.sharded(frame(spark, [(1, None)])).collect()] == [0]


def test_copies_stay_whole_in_full_shards(spark):
    """Most rows are copies and shards fill up with them: no more groups are cut than shards have borders."""
    rng, sizes = random.Random(4), []
    while sum(sizes) < 3600:
        sizes.append(rng.randint(2, 50))
    rows = [(f"g{g}", g) for g, n in enumerate(sizes) for _ in range(n)] + [("large", -1)] * 2000
    for free in (0, 600):
        many = frame(spark, [(i, t) for i, (t, _) in enumerate(rows)] + [(10_000 + i, f"free {i}") for i in range(free)])
        got = sharding.sharded(many).select("group_key", "shard", "linked").collect()
        n, groups = Counter(r["shard"] for r in got), defaultdict(set)
        assert max(n.values()) - min(n.values()) <= 1
        for r in got:
            if r["linked"]:
                groups[r["group_key"]].add(r["shard"])
        cut = sorted(len(g) for g in groups.values() if len(g) > 1)
        assert len(groups) == len(sizes) + 1 and len(cut) <= (8 if not free else 1), cut
    # a group that is larger than a part, but not than a shard, is whole
    got = sharding.sharded(frame(spark, [(i, "half a shard" if i < 100 else f"free {i}") for i in range(1600)])).collect()
    assert len({r["shard"] for r in got if r["linked"]}) == 1


def test_quality_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.scored(docs, labels.where(~quality.held_out("doc_id"))).join(labels.where(quality.held_out("doc_id")), "doc_id").collect()
    right = sum((r["score"] >= quality.CUT) == (r["quality"] == 1) for r in got)
    assert right >= 0.95 * len(got)
    edge = frame(spark, [(1, None), (None, ""), (2, "a"), (2, "a"), (3, "x" * 100000)])
    for own in ([], [(1, 1)], [(2, 0), (None, 1)]):
        out = quality.scored(edge, spark.createDataFrame(own, "doc_id long, quality int")).collect()
        assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)
    assert quality.scored(frame(spark, []), labels).count() == 0


def test_quality_learns_from_every_labelled_document(spark):
    docs = spark.range(21_000).select(F.col("id").alias("doc_id"), F.lit("a plain text").alias("text"))
    labels = spark.range(21_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    # the documents of the smallest hashes come first; only the last one is poor, and it shouts
    last = labels.orderBy(F.xxhash64("doc_id").desc()).first()["doc_id"]
    docs = docs.withColumn("text", F.when(F.col("doc_id") == last, "BUY NOW 100 !!!").otherwise(F.col("text")))
    weights, middle = quality.fitted(docs, labels.withColumn("quality", F.when(F.col("doc_id") == last, 0).otherwise(1)))
    assert np.abs(weights).max() > 0
    good, poor = [r["score"] for r in quality.scored(frame(spark, [(1, "a plain text"), (2, "BUY NOW 100 !!!")]), labels, (weights, middle)).orderBy("doc_id").collect()]
    assert good >= quality.CUT - 1e-9 and poor < quality.CUT


def test_decontamination_against_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([9, 15, 24, 40, 5, 3])]
    docs = []
    for k in range(160):
        i = k % 5
        found, d = items[i][1].split(), k // 5 % 13
        for _ in range(d):
            kind, at = rng.randrange(3), rng.randrange(len(found))
            found[at:at + (kind != 0)] = [rng.choice(vocabulary)] if kind != 1 else []
            found = found or ["x"]
        text = " ".join([rng.choice(vocabulary) for _ in range(rng.randrange(30))] + found + [rng.choice(vocabulary) for _ in range(rng.randrange(30))])
        docs.append((k, text.upper().replace(" ", ", ") if k % 3 else text))
    docs += [(500, None), (501, ""), (None, items[3][1]), (502, items[5][1]), (502, items[5][1])]

    def least(item, doc):
        row = [0] * (len(doc) + 1)
        for i, x in enumerate(item, 1):
            new = [i]
            for j, y in enumerate(doc, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return min(row)

    want = Counter()
    for i, t in docs:
        w = re.findall(r"[a-z0-9]+", (t or "").lower())
        own = tuple(j for j, x in items if least(x.split(), w) <= decontaminate.edits(len(x.split())))
        want[i, own] += 1
    bench = spark.createDataFrame([*items, (None, "w1 w2"), (77, None), (78, " .. "), items[0]], "item_id long, text string")
    for size in (decontaminate.BLOCK_BYTES, 150):
        got = Counter((r["doc_id"], tuple(r["__items"])) for r in decontaminate.flagged(frame(spark, docs), bench, size).collect())
        found, all_ = sum((got & want).values()), sum(want.values())
        assert found >= 0.98 * all_
        assert not [x for x, n in (got - want).items() if set(x[1]) - {j for (i, own), _ in want.items() if i == x[0] for j in own}]
    assert decontaminate.flagged(frame(spark, []), bench).count() == 0
    assert decontaminate.flagged(frame(spark, docs), bench.limit(0)).where(F.size("__items") > 0).count() == 0


def test_decontamination_with_many_short_items(spark):
    """Short items allow no edits; they come first and are most of the benchmark, and edited copies of long ones are found."""
    rng = random.Random(3)
    text = lambda n: [f"w{rng.randrange(400)}" for _ in range(n)]
    items = [(i, " ".join(text(4))) for i in range(100)] + [(1000 + i, " ".join(text(n))) for i, n in enumerate([40, 100] * 6)]
    docs, want = [], {}
    for k in range(240):
        i, t = items[100 + k % 12]
        w, d = t.split(), decontaminate.edits(len(t.split()))
        for at in rng.sample(range(len(w)), d - k % 3):
            w[at] = "other"
        docs.append((k, " ".join(text(k % 40) + w + text(k % 30))))
        want[k] = i
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r["__items"] for r in decontaminate.flagged(frame(spark, docs), bench).collect()}
    assert all(i in got[k] for k, i in want.items())
    # where an occurrence is
    doc = "a b c " + items[100][1] + " d e"
    [r] = [r for r in decontaminate.matches(frame(spark, [(1, doc)]), bench).collect() if r["item_id"] == 1000]
    assert (r["edits"], r["start"], r["stop"]) == (0, 3, 43)


def test_mix(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(["w"] * (rng.randint(0, 60) if i % 97 else 4000))) for i in range(3000)] + [(None, "a b"), (5, None), (5, "a b c"), (5, "a b c")]
    source = lambda i: None if i % 11 == 0 else "hot" if i % 3 == 0 else f"s{i % 5}"
    data = frame(spark, docs, source)
    got = mixing.mixed(data).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 3
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    want, left, open_ = {}, sum(sizes.values()), set(order)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            want.update(share)
            break
        for s in over:
            want[s] = 3 * sizes[s]
            left -= want[s]
        open_ -= over
    assert len(got) == len(docs)
    for s in order:
        assert math.isclose(target[s], want[s], rel_tol=1e-9)
        assert abs(taken[s] - want[s]) <= max(5, 0.02 * want[s])
    again = mixing.mixed(data.repartition(3)).collect()
    key = lambda r: (r["doc_id"], r["source"], r["size"], r["copies"])
    assert Counter(map(key, got)) == Counter(map(key, again))
    assert mixing.take(data).columns == data.columns and mixing.take(data).count() == sum(r["copies"] for r in got)
    assert mixing.mixed(frame(spark, [])).count() == 0
    assert [r["copies"] for r in mixing.mixed(frame(spark, [(1, None)])).collect()] == [0]


def test_flight_keeps_totals():
    rng = np.random.default_rng(0)
    size, chance = rng.integers(1, 500, 400).astype(float), np.full(400, 0.37)
    flown = mixing.fly(chance, size, 2, rng)
    assert math.isclose(flown @ size, chance @ size, rel_tol=1e-9) and math.isclose(flown.sum(), chance.sum(), rel_tol=1e-9)
    assert ((flown > 0) & (flown < 1)).sum() <= 2


def test_neighbours_recall_and_edges(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 12)).astype(np.float32)
    x[300:340] = x[0]
    data = [(int(i), [float(v) for v in row]) for i, row in enumerate(x)]
    data += [(2000, None), (2001, []), (2002, [0.0] * 12), (2003, [float("nan")] + [1.0] * 11), (2004, [None] + [1.0] * 11), (2005, [float("inf")] * 12), (2006, [1.0] * 3), (None, [1.0] * 12), data[5]]
    rows = spark.createDataFrame(data, "id long, v array<float>")
    got = defaultdict(list)
    for r in neighbours.nearest(rows, rows.where("id % 20 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    exact = x.astype(float)
    right = 0
    for q in range(0, 900, 20):
        s = exact @ exact[q]
        best = [i for i in np.lexsort((np.arange(900), -s)) if i != q][:20]
        right += len({i for i, _ in got[q]} & set(best))
        assert len(got[q]) == 20 and all(math.isclose(v, s[i], rel_tol=1e-9, abs_tol=1e-12) for i, v in got[q])
        assert got[q] == sorted(got[q], key=lambda p: (-p[1], p[0]))
    assert set(got) == set(range(0, 900, 20)) and right >= 0.95 * 20 * len(got)
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "id long, v array<float>")
    out = neighbours.nearest(few, few.where("id = 0")).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in out] == [(1, 1.0), (2, 0.0)]
    assert neighbours.nearest(few.limit(0), few.limit(0)).count() == 0

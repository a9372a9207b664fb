"""The stages on a small folder against plain Python, and on odd rows."""

from collections import Counter

import pytest

import corpus_pipeline as P

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, __h long, p_toxic double"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, "a b c d e f g", "en", "s", 1, 5, 0.1), (2, "a b c d e f g", "en", "s", 1, 5, 0.1), (2, "a b c d e f g", "en", "t", 1, 5, 0.1),
            (3, None, None, None, None, None, None), (None, "a b c d e f g", "en", "s", 1, 5, 0.1), (None, "alone without id", None, "s", None, None, None),
            (4, "", "en", "s", 0, 5, 0.1), (5, "q " * 20000, "en", None, 1, 5, 0.1)]
    return spark.createDataFrame(rows, DOCS)


def test_names_and_columns(spark, odd):
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_join", "decontaminate", "mix", "shard"]
    for _, stage in P.STAGES:
        got = stage(spark, odd, SF)
        if stage is not P.shard:
            assert got.columns == odd.columns and [f.dataType for f in got.schema] == [f.dataType for f in odd.schema]
        assert stage(spark, odd.limit(0), SF).count() == 0


def test_near_copies_keep_one_of_each_group(spark, odd):
    got = Counter((r["doc_id"], (r["text"] or "")[:9]) for r in P.drop_near_copies(spark, odd, SF).collect())
    assert got == Counter({(1, "a b c d e"): 1, (3, ""): 1, (4, ""): 1, (None, "alone wit"): 1, (5, "q q q q q"): 1})


def test_near_copies_of_repeated_ids_keep_one_of_each_group(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(5, "a b c d e f g"), (5, long), (9, long + " more"), (7, "one two three four five"), (7, "six seven eight nine ten"),
            (None, "no id at all here"), (None, "no id at all here"), (None, "no  ID at all here")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 5, 0.1) for i, t in rows], DOCS)
    got = Counter((r["doc_id"], r["text"][:5]) for r in P.drop_near_copies(spark, docs, SF).collect())
    assert sum(got.values()) == 5
    assert got == Counter({(5, "a b c"): 1, (5, "w0 w1"): 1, (7, "one t"): 1, (7, "six s"): 1, (None, "no  I"): 1})


def test_filters_keep_clean_rows(spark, odd):
    everything = Counter(r["doc_id"] for r in odd.collect())
    for stage in (P.drop_toxic, P.drop_leaks):
        assert Counter(r["doc_id"] for r in stage(spark, odd, SF).collect()) == everything


def test_run(spark):
    out = P.run(spark, SF).collect()
    n = Counter(r["shard"] for r in out)
    assert max(n.values()) - min(n.values()) <= 1
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert all(r["doc_id"] in docs and not any(b in docs[r["doc_id"]] for b in bench) for r in out)

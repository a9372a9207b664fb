import random

from pyspark.sql import functions as F

from hazeline.operators import clean as C
from hazeline.operators import evaluate as E
from hazeline.operators import filters as FL
from hazeline.operators import joins as J
from hazeline.operators import profile as P
from hazeline.operators import splits as S
from hazeline.operators import summary as A
from hazeline.operators import topk as K
from hazeline.operators import windows as W
from hazeline.operators.quantiles import quantiles


def test_quantiles_are_exact(spark):
    random.seed(1)
    rows = [("a", random.choice([0.0, 1.0, random.gauss(0, 1)])) for _ in range(4000)] + [("b", 5.0)] + [("c", None)]
    rows += [("d", 1e12 * random.random() if i % 100 == 0 else float(i % 7)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, v double").cache()
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    want = {r.g: list(r.q) for r in df.filter("v is not null").groupBy("g").agg(F.percentile("v", probs).alias("q")).collect()}
    got = {r.g: [r[f"q{i}"] for i in range(len(probs))] for r in quantiles(df, ["g"], "v", probs).collect()}
    assert got == want
    whole = df.filter("v is not null").agg(F.percentile("v", probs).alias("q")).first().q
    r = quantiles(df, [], "v", probs).first()
    assert [r[f"q{i}"] for i in range(len(probs))] == list(whole)


def test_samples_have_exact_sizes(panel):
    s = FL.sample_n(panel, 50, 1, ["city", "dt"])
    assert s.count() == 50 and s.exceptAll(panel).count() == 0
    assert FL.sample_n(panel, 10_000, 1, ["city", "dt"]).count() == panel.count()
    assert FL.sample_n(panel, 50, 1, ["city", "dt"]).exceptAll(s).count() == 0


def test_stratified_sample_adds_up(panel):
    for n in (7, 100, 101, 10_000):
        s = FL.sample_strat(panel, n, "aqi_category", 2, ["city", "dt"])
        assert s.count() == min(n, panel.count())
        sizes = {r.aqi_category: r["count"] for r in panel.groupBy("aqi_category").count().collect()}
        for r in s.groupBy("aqi_category").count().collect():
            assert abs(r["count"] - min(n, panel.count()) * sizes[r.aqi_category] / panel.count()) < 1


def test_splits(panel):
    s = S.split_chrono(panel)
    ends = {r.split: (r.a, r.b) for r in s.groupBy("split").agg(F.min("dt").alias("a"), F.max("dt").alias("b")).collect()}
    assert ends["train"][1] < ends["validation"][0] and ends["validation"][1] < ends["test"][0]
    assert s.count() == panel.count()
    strat = {(r.aqi_category, r.split): r["count"] for r in S.split_strat(panel, "aqi_category", 0.8, 3, ["city", "dt"]).groupBy("aqi_category", "split").count().collect()}
    for r in panel.groupBy("aqi_category").count().collect():
        assert strat[(r.aqi_category, "train")] == round(0.8 * r["count"])
        assert strat[(r.aqi_category, "train")] + strat[(r.aqi_category, "test")] == r["count"]
    pos = S.split_position(panel.filter("city = 'A'")).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in pos} == {"train": 139, "validation": 20, "test": 40}
    hold = S.city_holdout(panel, 0.5)
    assert hold.filter("split = 'train' and city = 'B'").count() == 0


def test_weights_sum_to_row_count(panel):
    w = S.balanced_weights(panel, "aqi_category")
    assert abs(w.agg(F.sum("weight")).first()[0] - panel.count()) < 1e-6


def test_metrics_with_absent_and_stray_classes(spark):
    rows = [(0, 0), (0, 0), (0, 1), (1, 1), (1, 5), (2, 1)]
    df = spark.createDataFrame(rows, "y int, p int")
    cm = E.confusion(df, "y", "p")
    assert cm.count() == 36 and cm.agg(F.sum("n")).first()[0] == len(rows)
    rep = E.class_report(cm)
    by = {r.label_id: r for r in rep.collect()}
    assert (by[5].precision, by[5].recall, by[5].support) == (0.0, 0.0, 0)
    assert by[3].f1 == 0.0
    m = E.evaluate(df, "y", "p").first()
    assert m.accuracy == m.recall_weighted == 0.5
    # classes 0, 1, 2 have rows; 5 is only predicted
    assert abs(m.balanced_accuracy - (2 / 3 + 1 / 2 + 0) / 3) < 1e-12
    assert abs(m.macro_recall - (2 / 3 + 1 / 2 + 0 + 0) / 4) < 1e-12
    assert m.hazardous_support == 0 and m.severe_class_recall == 0.0
    assert E.balanced_accuracy(rep, variant="macro").first()[0] == m.macro_recall


def test_vote_tie_goes_to_the_severe_label(spark):
    df = spark.createDataFrame([(1, 0), (1, 3), (2, 2), (2, 2), (2, 4)], "row int, label_id int")
    got = {r.row: (r.consensus, r.agreement_score) for r in E.consensus(df, ["row"]).collect()}
    assert got == {1: ("Unhealthy", "1/2"), 2: ("Unhealthy_Sensitive", "2/3")}


def test_mode_tie_and_summary(spark):
    df = spark.createDataFrame([("A", "Moderate"), ("A", "Good"), ("B", None), ("B", "Hazardous")], "city string, aqi_category string")
    got = {r.city: (r.records, r.avg_aqi_score, r.dominant_category) for r in A.city_summary(df).collect()}
    assert got == {"A": (2, 0.5, "Good"), "B": (2, 5.0, "Hazardous")}


def test_columns(spark):
    df = spark.createDataFrame([(1, 1, 1.0, 7, None), (2, 2, 2.0, 7, None), (None, None, None, None, None)], "a int, b int, c double, k int, e int")
    assert [tuple(r) for r in P.duplicate_columns(df).collect()] == [("a", "b")]
    assert [r.column for r in P.constant_columns(df).collect()] == ["k"]
    assert C.drop_duplicate_columns(df).columns == ["a", "c", "k", "e"]
    assert {r.column: r.missing for r in P.null_profile(df).collect()} == {"a": 1, "b": 1, "c": 1, "k": 1, "e": 3}


def test_dedupe_keeps_the_first(spark):
    df = spark.createDataFrame([("A", 1, 9), ("A", 1, 3), ("B", 1, 5)], "city string, dt int, n int")
    assert sorted(tuple(r) for r in C.dedupe_ts(df, ["city", "dt"], ["n"]).collect()) == [("A", 1, 3), ("B", 1, 5)]


def test_mentions_both_ways(spark):
    docs = spark.createDataFrame([(1, "smog in NEW DELHI and Agra"), (2, "nothing"), (3, "O'Hare\nAgra's"), (4, "")], "doc_id int, text string")
    names = spark.createDataFrame([("Agra",), ("New Delhi",), ("O'Hare",)], "city string")
    want = [(1, "Agra"), (2, "Delhi"), (3, "Agra"), (4, "Delhi")]
    assert sorted(tuple(r) for r in J.city_mentions(docs, names).collect()) == want
    many = names.unionByName(spark.createDataFrame([("Ub",), (None,), ("",), *[(f"Zz{i}",) for i in range(600)]], "city string"))
    twice = docs.unionByName(spark.createDataFrame([(1, "only the hub"), (1, None)], "doc_id int, text string"))
    assert sorted(tuple(r) for r in J.city_mentions(twice, many).collect()) == sorted([*want, (1, "Ub"), (1, "Delhi")])
    assert sorted(tuple(r) for r in J.city_mentions(docs, names, block_bytes=5).collect()) == want
    assert J.city_mentions(docs, names.limit(0)).filter("city = 'Delhi'").count() == 4


def test_rows_without_key_or_time_stay(spark):
    df = spark.createDataFrame([("A", 1, 1.0), ("A", 2, 2.0), ("A", None, 9.0), (None, 3, 8.0)], "city string, i int, co double")
    df = df.selectExpr("city", "timestamp'2024-01-25 00:00:00' + make_interval(0, 0, 0, 0, i) AS dt", "co")
    got = {r.co: r.co_lag_1h for r in W.lags(df, ["co"], [1]).collect()}
    assert got == {1.0: None, 2.0: 1.0, 9.0: None, 8.0: None}


def test_metric_table_updates(spark):
    m = spark.createDataFrame([("LSTM", 0.5, 1.0), ("Tree", 0.7, 2.0)], "model string, accuracy double, time double")
    new = spark.createDataFrame([("LSTM", 0.9)], "model string, accuracy double")
    assert sorted(tuple(r) for r in J.update_metrics(m, new).collect()) == [("LSTM", 0.9, 1.0), ("Tree", 0.7, 2.0)]
    assert sorted(tuple(r) for r in J.replace_models(m, new, ["LSTM"]).collect()) == [("LSTM", 0.9, None), ("Tree", 0.7, 2.0)]
    board = K.leaderboard(m.withColumn("severe", F.lit(0.0)), "severe", "accuracy").select("model", "place").collect()
    assert [tuple(r) for r in board] == [("Tree", "best"), ("LSTM", "worst")]


def test_downsample_positions(spark):
    df = spark.sql("SELECT timestamp'2024-01-01' + make_interval(0,0,0,0,CAST(id AS INT)) AS dt, id FROM range(1000)")
    got = sorted(r.id for r in A.downsample(df, 400).collect())
    assert got == [i * 999 // 399 for i in range(400)]
    assert A.downsample(df.filter("id < 300"), 400).count() == 300


def test_tail_before_falls_back(panel):
    early = FL.tail_before(panel, "2000-01-01", 5)
    assert early.groupBy("city").count().filter("count = 5").count() == 2
    assert "WindowGroupLimit" in early._jdf.queryExecution().executedPlan().toString()


def test_city_or_all_and_guard(panel):
    assert FL.city_or_all(panel, "a").select("city").distinct().count() == 1
    assert FL.city_or_all(panel, "zz").count() == panel.count()
    assert FL.min_rows(panel, 10).count() == panel.count()
    assert FL.min_rows(panel.limit(9), 10).count() == 0

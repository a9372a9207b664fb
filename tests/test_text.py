"""The measure-based stemmer on words whose published stems are known."""

from hazeline.operators import text as X

# Examples of the published description of the method, with their stems.
STEMS = """caresses caress|ponies poni|ties ti|caress caress|cats cat|feed feed|agreed agre|plastered plaster|bled bled|motoring motor|sing sing
conflated conflat|troubled troubl|sized size|hopping hop|tanned tan|falling fall|hissing hiss|fizzed fizz|failing fail|filing file|happy happi
sky sky|relational relat|conditional condit|rational ration|valenci valenc|hesitanci hesit|digitizer digit|conformabli conform|radicalli radic
differentli differ|vileli vile|analogousli analog|vietnamization vietnam|predication predic|operator oper|feudalism feudal|decisiveness decis
hopefulness hope|callousness callous|formaliti formal|sensitiviti sensit|sensibiliti sensibl|triplicate triplic|formative form|formalize formal
electriciti electr|electrical electr|hopeful hope|goodness good|revival reviv|allowance allow|inference infer|airliner airlin|gyroscopic gyroscop
adjustable adjust|defensible defens|irritant irrit|replacement replac|adjustment adjust|dependent depend|adoption adopt|homologou homolog
communism commun|activate activ|angulariti angular|homologous homolog|effective effect|bowdlerize bowdler|probate probat|rate rate|cease ceas
controll control|roll roll|is is|Running run|y y|syzygy syzygi|oscillators oscil|generalizations gener"""


def test_published_stems(spark):
    want = dict(pair.split() for line in STEMS.split("\n") for pair in line.split("|"))
    words = spark.createDataFrame([(w,) for w in want] + [(None,), ("cats",)], "term string")
    assert {r["term"]: r["stem"] for r in X.stem_table(words).collect()} == want


def test_counts_of_one_stem_are_summed(spark):
    rows = spark.createDataFrame([(1, "cat", 2), (1, "Cats", 3), (2, "cats", 1)], "doc_id int, term string, n long")
    assert sorted(tuple(r) for r in X.measured_stems(rows, ["doc_id"]).collect()) == [(1, "cat", 5), (2, "cat", 1)]


def test_terms_meet_their_stems_by_hash(spark):
    words = spark.createDataFrame([(1, "running"), (1, "running"), (1, "runs"), (2, "generalizations"), (2, None)], "d long, term string").selectExpr("*", "1 AS n")
    out = X.measured_stems(words, ["d"])
    assert sorted(map(tuple, out.collect())) == [(1, "run", 3), (2, "gener", 1)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan

from __future__ import annotations

import math
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assayer.functions.fixed_values import INDICATOR_TERMS
from assayer.functions.stem import porter_stem
from assayer.functions.text import bigrams, ngram_terms, words
from assayer.operators import lexicon as lex
from assayer.operators import metrics, sweep, tokens
from assayer.operators.lookup import join_terms
from assayer.operators.roots import noun_dictionary, stem_dictionary
from assayer.operators.tfidf import counted_terms, fit_vocabulary, tfidf, top_term_lists
from assayer.operators.tokens import dictionary_for, replace_terms

# Examples printed in the 1980 paper.
PAPER = """caresses caress|ponies poni|ties ti|caress caress|cats cat|feed feed|agreed agre
plastered plaster|bled bled|motoring motor|sing sing|conflated conflat|troubled troubl|sized size
hopping hop|tanned tan|falling fall|hissing hiss|fizzed fizz|failing fail|filing file|happy happi
sky sky|relational relat|conditional condit|rational ration|valenci valenc|digitizer digit
radicalli radic|vileli vile|vietnamization vietnam|operator oper|feudalism feudal|hopefulness hope
formaliti formal|sensibiliti sensibl|triplicate triplic|formative form|electriciti electr
hopeful hope|goodness good|revival reviv|airliner airlin|gyroscopic gyroscop|adjustable adjust
replacement replac|adjustment adjust|dependent depend|adoption adopt|communism commun
activate activ|effective effect|bowdlerize bowdler|probate probat|rate rate|cease ceas
controll control|roll roll|generalizations gener|oscillators oscil|by by|enjoy enjoi"""


def test_stems_of_the_paper(spark):
    pairs = [tuple(p.split()) for line in PAPER.splitlines() for p in line.split("|")]
    df = spark.createDataFrame(pairs, "term string, want string")
    wrong = df.withColumn("got", porter_stem(F.col("term"))).where("got <> want").collect()
    assert wrong == []


def test_words(spark):
    df = spark.createDataFrame([("The CAT's 2 cats,\n a dog!  ",), ("",), ("é",)], "text string")
    got = [r["w"] for r in df.select(words(F.col("text"), ["the"]).alias("w")).collect()]
    assert got == [["cat", "cats", "dog"], [], []]


def test_bigrams_of_short_arrays(spark):
    df = spark.createDataFrame([(["a1", "b1", "c1"],), (["a1"],), ([],)], "t array<string>")
    assert [r["b"] for r in df.select(bigrams(F.col("t")).alias("b")).collect()] == [
        ["a1 b1", "b1 c1"], [], []]
    # One-letter tokens that a lemma left behind drop out before pairs are built.
    row = spark.createDataFrame([(["us", "u", "them"],)], "t array<string>")
    assert row.select(ngram_terms(F.col("t")).alias("n")).first()["n"] == ["us", "them", "us them"]


DOCS = [(1, ["good", "good", "dogs"]), (2, []), (3, ["bad", "man", "man"]), (4, ["ran", "dogs"])]
LEXICON = [("good", "positive"), ("bad", "negative"), ("man", "indicator"), ("man", "negative")]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "id int, tokens array<string>")


@pytest.fixture
def lexicon(spark):
    return spark.createDataFrame(LEXICON, "term string, kind string")


@pytest.mark.parametrize("inline_terms", [100, 0])
def test_lexicon_features_count_repeats(docs, lexicon, inline_terms):
    out = lex.lexicon_features(docs, "id", "tokens", lexicon, inline_terms=inline_terms)
    split = lex.with_score(lex.joined_features(docs, "id", "tokens", lexicon, limit=0))
    assert sorted(out.collect()) == sorted(split.collect())
    got = {r["id"]: (r["n_tokens"], r["positive"], r["negative"], r["indicator"], r["score"])
           for r in out.collect()}
    assert got == {1: (3, 2, 0, 0, 2 / 3), 2: (0, 0, 0, 0, 0.0), 3: (3, 0, 3, 2, -1.0), 4: (2, 0, 0, 0, 0.0)}


def test_indicator_list():
    assert len(INDICATOR_TERMS) == len(set(INDICATOR_TERMS)) == 41


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_replaced_terms_keep_order_and_empty_documents(spark, docs, limit):
    roots = spark.createDataFrame([("dogs", "dog"), ("ran", "run"), ("good", "good")], "term string, root string")
    dictionary = dictionary_for(docs, "tokens", roots, limit)
    out = replace_terms(docs, "id", "tokens", dictionary, limit=limit)
    got = {r["id"]: r["tokens"] for r in out.collect()}
    assert got == {1: ["good", "good", "dog"], 2: [], 3: ["bad", "man", "man"], 4: ["run", "dog"]}


def test_replacing_keeps_null_arrays_and_every_batch(spark):
    df = spark.range(300).select(
        "id",
        F.when(F.col("id") % 7 == 0, None)
        .when(F.col("id") % 5 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.concat(F.lit("w"), F.col("id") % 9), F.lit("dogs"))).alias("tokens"),
    )
    dictionary = spark.createDataFrame([("dogs", "dog", 300), ("w3", "", 30)], "term string, root string, n bigint")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        got = {r["id"]: r["tokens"] for r in replace_terms(df, "id", "tokens", dictionary).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 300 and got[7] is None and got[5] == []
    assert got[3] == ["", "dog"] and got[4] == ["w4", "dog"]


def test_extended_stems(spark):
    """Worked by hand; the second column is the paper's stem where the two differ."""
    cases = {
        "dies": "die", "flies": "fli", "died": "die", "spied": "spi", "enjoy": "enjoy", "joy": "joy", "happy": "happi",
        "fly": "fli", "by": "by", "sky": "sky", "skies": "sky", "dying": "die", "news": "news", "innings": "inning",
        "proceed": "proceed", "succeed": "succeed", "used": "use", "use": "use", "ease": "eas",
        "hopefully": "hope", "rationally": "ration", "geology": "geolog", "apology": "apolog", "caresses": "caress",
        "agreed": "agre", "feed": "feed", "hopping": "hop", "falling": "fall", "relational": "relat", "as": "as",
    }
    df = spark.createDataFrame(list(cases.items()), "term string, want string")
    wrong = df.withColumn("got", porter_stem(F.col("term"), "extended")).where("got <> want").collect()
    assert wrong == []
    paper = {"dies": "di", "enjoy": "enjoi", "joy": "joi", "news": "new", "dying": "dy", "used": "us"}
    df = spark.createDataFrame(list(paper.items()), "term string, want string")
    assert df.withColumn("got", porter_stem(F.col("term"))).where("got <> want").collect() == []
    with pytest.raises(ValueError, match="variant"):
        porter_stem(F.col("term"), "other")


def test_stem_and_noun_dictionaries(spark, docs):
    stems = {r["term"]: r["root"] for r in stem_dictionary(docs, "tokens").collect()}
    assert stems["dogs"] == "dog" and stems["good"] == "good"
    words_used = spark.createDataFrame(
        [(1, ["dogs", "women", "churches", "ponies", "wolves", "geese", "news", "zzz"])], "id int, tokens array<string>"
    )
    nouns = spark.createDataFrame(
        [(w,) for w in ("dog", "woman", "church", "pony", "wolf", "goose", "news")], "term string"
    )
    odd = spark.createDataFrame([("geese", "goose")], "term string, root string")
    got = {r["term"]: r["root"] for r in noun_dictionary(words_used, "tokens", nouns, odd).collect()}
    assert got == {"dogs": "dog", "women": "woman", "churches": "church", "ponies": "pony",
                   "wolves": "wolf", "geese": "goose"}


def test_salted_join_equals_broadcast_join(spark):
    # One term holds a third of all rows.
    rows = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 50)).alias("term")
    )
    table = rows.where("term <> 't7'").groupBy("term").agg(F.count("*").alias("n"))
    for how in ("inner", "left"):
        small = join_terms(rows, table, "term", "n", "id", how)
        large = join_terms(rows, table, "term", "n", "id", how, limit=0)
        assert sorted(small.select("id", "n").collect()) == sorted(large.select("id", "n").collect())


TERMS = [(1, ["a a", "x", "x", "y"]), (2, ["x", "y"]), (3, ["x", "z"]), (4, ["x", "y", "q"]), (5, [])]


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_tfidf_by_hand(spark, limit):
    df = spark.createDataFrame(TERMS, "id int, terms array<string>")
    vocabulary = fit_vocabulary(df, "terms", min_documents=1, max_share=0.6)
    idf = {r["term"]: r["idf"] for r in vocabulary.collect()}
    # x is in 4 of 5 documents, above the bound of 3; y is in exactly 3.
    assert set(idf) == {"a a", "y", "z", "q"}
    assert idf["y"] == pytest.approx(math.log(6 / 4) + 1)
    got = {(r["id"], r["term"]): r["weight"] for r in tfidf(df, "id", "terms", vocabulary, limit).collect()}
    norm = math.hypot(idf["a a"], idf["y"])
    assert got[1, "y"] == pytest.approx(idf["y"] / norm)
    assert got[2, "y"] == pytest.approx(1.0)
    assert {k for k, _ in got} == {1, 2, 3, 4}
    tops = {r["id"]: r["top_terms"] for r in
            top_term_lists(tfidf(df, "id", "terms", vocabulary), "id", 1).collect()}
    assert tops[4] == ["q"] and tops[1] == ["a a"]


def test_sublinear_counts(spark):
    df = spark.createDataFrame([(1, ["x", "x", "x", "y"]), (2, ["x", "y"])], "id int, terms array<string>")
    vocabulary = fit_vocabulary(df, "terms", max_share=1.0)
    got = {r["term"]: r["weight"] for r in tfidf(df.where("id = 1"), "id", "terms", vocabulary).collect()}
    assert got["x"] / got["y"] == pytest.approx(1 + math.log(3))


def test_sweep_equals_scoring_each_point(spark):
    df = spark.range(400).select(
        F.round(F.rand(3) - 0.5, 2).alias("score"),
        (F.rand(4) * 4).cast("int").alias("indicator"),
        (F.rand(5) < 0.4).cast("int").alias("label"),
    ).cache()
    scores, counts = [-0.2, 0.0, 0.05], [1, 2, 3]
    point = ["grid_pos", "min_score", "min_indicators"]
    swept = metrics.binary_scores(lex.sweep_lexicon(df, "label", scores, counts), by=point)
    got = {(r["min_score"], r["min_indicators"]): r["f1"] for r in swept.collect()}
    assert len(got) == 9
    for s in scores:
        for c in counts:
            one = metrics.confusion(lex.with_lexicon_rule(df, s, c), "label", "prediction")
            assert got[s, c] == pytest.approx(metrics.binary_scores(one).first()["f1"])


def test_neutral_rows_pass_the_threshold_just_below_zero(spark):
    df = spark.createDataFrame([(0.0, 0)], "score double, indicator int")
    just_below = lex.with_lexicon_rule(df, -5.551115123125783e-17, 1).first()["prediction"]
    assert (just_below, lex.with_lexicon_rule(df, 0.0, 1).first()["prediction"]) == (1, 0)


def test_best_point_takes_the_earliest_of_a_tie(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.7), (2, 0.7 + 1e-15)], "grid_pos int, f1 double")
    assert sweep.best_point(df).first()["grid_pos"] == 1
    assert [r["grid_pos"] for r in sweep.top_points(df, k=2).collect()] == [1, 2]


def test_forms_agree_on_null_arrays_and_repeated_keys(spark):
    rows = [(1, ["good", "bad"]), (1, ["good"]), (2, None), (3, []), (4, [None, "good"])]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    words = spark.createDataFrame([("good", "positive"), ("bad", "negative")], "term string, kind string")
    forms = [lex.lexicon_features(df, "id", "tokens", words, inline_terms=n).collect() for n in (10, 0)]
    assert sorted(forms[0], key=str) == sorted(forms[1], key=str) and len(forms[0]) == 5
    roots = spark.createDataFrame([("bad", "worse", 1)], "term string, root string, n bigint")
    swapped = [replace_terms(df, "id", "tokens", roots, limit=n).collect() for n in (1 << 20, 0)]
    assert sorted(swapped[0], key=str) == sorted(swapped[1], key=str) and len(swapped[0]) == 5


def test_large_vocabulary_counts_documents_where_they_are(spark):
    """Beyond a broadcast, terms are counted where their documents are, before any shuffle."""
    odd = [(60, []), (61, None), (62, [None, "a", None])]
    docs = spark.createDataFrame([*[(i, ["a", "b", "b", f"t{i % 7}"]) for i in range(60)], *odd], "id long, terms array<string>")
    known = fit_vocabulary(docs, "terms", max_share=1.0)
    small, large = (tfidf(docs, "id", "terms", known, limit=n) for n in (1 << 26, 0))
    rows = [sorted((r.id, r.term, round(r.weight, 9)) for r in t.collect()) for t in (small, large)]
    assert rows[0] == rows[1] and len(rows[0]) == 181
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(id#\d+L, term#", plan)


def test_only_documents_of_a_split_have_terms(spark, small):
    from assayer.plans import headlines, standins

    rows = headlines.term_arrays(spark, small)
    assert rows.where("split IS NULL").isEmpty()
    assert rows.count() == standins.headlines(spark, small).count()


def test_batches_are_cut_by_their_terms(spark, monkeypatch):
    docs = [(1, ["a", "bs"]), (2, None), (3, ["bs"] * 5), (4, []), (5, ["c"]), (6, ["c", "a"])]
    df = spark.createDataFrame(docs, "id bigint, tokens array<string>").coalesce(1)
    roots = spark.createDataFrame([("bs", "b")], "term string, root string")

    def results():
        swapped = replace_terms(df, "id", "tokens", dictionary_for(df, "tokens", roots))
        return swapped.orderBy("id").collect(), counted_terms(swapped, "id", "tokens").orderBy("id", "term").collect()

    whole = results()
    monkeypatch.setattr(tokens, "TERMS_AT_ONCE", 3)
    batch = pa.RecordBatch.from_arrays([pa.array([d[1] for d in docs], pa.list_(pa.string()))], ["tokens"])
    assert [p.num_rows for p in tokens.pieces(batch, 0)] == [2, 1, 3]
    assert results() == whole
    assert [r["tokens"] for r in whole[0]] == [["a", "b"], None, ["b"] * 5, [], ["c"], ["c", "a"]]


def test_side_by_side_rule_cuts_texts_once_and_counts_test_documents_only(spark, small, monkeypatch):
    from assayer.plans import headlines

    stored, counted = [], []
    settle, plain = headlines.settle, headlines.lex.lexicon_features
    monkeypatch.setattr(headlines, "settle", lambda df, name: stored.append(name) or settle(df, name))
    monkeypatch.setattr(
        headlines.lex, "lexicon_features", lambda df, *a, **k: counted.append(df.count()) or plain(df, *a, **k)
    )
    rows = headlines.side_by_side_rule(spark, small).count()
    assert stored.count("tokens") == 1 and counted == [rows] and rows > 0


def test_features_among_ids_are_those_of_all_rows_with_them(spark, small):
    from assayer.plans import headlines, standins

    rows = headlines.stored_tokens(spark, small)
    rows = rows.unionByName(rows.where("id % 3 = 0").withColumn("label", 1 - F.col("label"))).cache()  # an id twice, each with a label
    terms, some = standins.distinct_terms(rows), rows.where("id % 2 = 0")
    all_of = headlines.features_of(rows, terms).join(some.select("id").distinct(), "id")
    found = headlines.features_of(rows, terms, among=some)
    assert sorted(found.collect()) == sorted(all_of.select(found.columns).collect()) and found.count() > 0

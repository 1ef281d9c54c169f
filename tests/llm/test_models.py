"""Language identification and toxicity: held-out accuracy, and the defined results of odd rows."""

import os
import random

import pytest
from pyspark.sql import functions as F

from stratafold.llm import langid, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.predict_language(docs, langid.fit(docs)).join(docs, "doc_id").where("held_out and lang is not null")
    right, n = got.agg(F.avg(F.expr("int(lang = lang_pred)")), F.count("*")).first()
    assert n > 100 and right > 0.97
    assert got.where("score < 0 or score > 1").count() == 0


def test_language_of_odd_rows(spark):
    rows = [(i, t, k, None, None) for i in range(60) for t, k in [("the cat and the dog " * 3, "en"), ("der Hund und die Katze " * 3, "de")]]
    rows += [(900, None, "en", None, None), (901, " 12 !", None, None, None), (902, "the dog", None, None, None), (None, "die Katze und der Hund", None, None, None), (903, "the dog and the cat " * 100_000, None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.doc_id: r for r in langid.predict_language(docs, langid.fit(docs)).collect()}
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[900].score == 0
    assert got[902].lang_pred == got[903].lang_pred == "en" and got[None].lang_pred == "de"
    none = spark.createDataFrame([(1, "the dog", None, None, None)], DOCS)
    assert langid.predict_language(none, langid.fit(none)).first().lang_pred == "und"
    empty = spark.createDataFrame([], DOCS)
    assert langid.predict_language(empty, langid.fit(empty)).count() == 0


def test_grams_do_not_hang_on_slices(monkeypatch):
    text = "Der Hund, und die Katze; 12 naïve Tests " * 20
    whole = sorted(x for h in langid.grams(text) for x in h)
    monkeypatch.setattr(langid, "_SLICE", 7)
    assert sorted(x for h in langid.grams(text) for x in h) == whole


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_toxicity_accuracy(spark):
    sf = "/root/testdata/sf0.1" if os.path.isdir("/root/testdata/sf0.1") else SF
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.score_toxicity(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").where("held_out")
    n = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert n.get((1, 1), 0) >= 0.85 * (n.get((1, 1), 0) + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.02 * (n.get((0, 0), 0) + n.get((0, 1), 0))


def outcome(text):
    g = toxicity.Grammar({"idiot": 2.0, "moron": 2.0}, {})
    return dict(zip((*toxicity.PATTERNS, "variety"), g.features(text)))


def test_grammar_patterns():
    assert outcome("what an idiot.")["bare"] > 0
    assert outcome("you are an idiot.")["aimed"] > 0 and outcome("idiot you!")["aimed"] > 0
    assert outcome("he is not an idiot.")["negated"] > 0 and outcome("he is not an idiot.")["aimed"] == 0
    assert outcome('she said an idiot came')["reported"] > 0 and outcome('the word "idiot" is old')["reported"] > 0
    assert outcome("i will kill you now")["aimed_threat"] > 0 and outcome("to kill time")["threat"] > 0
    assert not any(outcome("idiotic videos, an antidiotic").values()) and not any(outcome("").values()) and not any(outcome(None).values())
    assert outcome("not so. idiot.")["bare"] > 0
    assert outcome("idiot " * 50_000)["variety"] < 1


def test_aimed_threats_count_without_insults():
    import numpy as np

    for text in ("i will kill you", "you will get killed", "we're killing them all", "ich töte dich", "vous serez tués"):
        assert outcome(text)["aimed_threat"] > 0
    rng = np.random.default_rng(4)
    toxic = np.c_[rng.uniform(1, 4, (300, 2)), np.zeros((300, 4)), np.ones(300)]
    x = np.r_[toxic, np.zeros((3000, 7))]
    g = toxicity.Grammar({"idiot": 2.0}, {}, toxicity._fit(x, np.r_[np.ones(300), np.zeros(3000)]))
    assert g.score("I will kill you") >= 0.5 > g.score("a plain text")
    assert not any(outcome("he was killed in the war and she shot the film").values())


def test_long_clauses_are_parsed_whole():
    fill = "word " * 1500
    said = outcome("she said " + fill + "idiot")
    assert said["reported"] > 0 and said["bare"] == 0
    quoted = outcome('"' + fill + "idiot " + fill + 'moron"')
    assert quoted["reported"] > 0 and quoted["bare"] == 0
    # the old cut lay 2,000 characters behind a hit: here between a target or a negation and the next insult
    gap = "idiot " + "x" * 1994 + " "
    assert outcome(gap + "you are moron")["aimed"] > 0 and outcome("idiot " + "x" * 1990 + " not moron")["negated"] > 0


def test_composition_equals_running_in_turn():
    rng = random.Random(3)
    neg, rep, tgt = toxicity.negation(), toxicity.reported(), toxicity.targeted()
    for _ in range(200):
        text = [rng.choice("ITUNRQo") for _ in range(12)]
        states, out = [neg.start, rep.start, tgt.start], []
        for s in text:
            for k, t in enumerate((neg, rep, tgt)):
                states[k], s = t.step(states[k], s)
            out.append(s)
        state, got = toxicity.GRAMMAR.start, []
        for s in text:
            state, o = toxicity.GRAMMAR.arcs[state, s]
            got.append(o)
        assert got == out


def test_toxicity_of_odd_rows(spark):
    rows = [(i, "you idiot" if i % 2 else "fine words here", None, None, None) for i in range(40)] + [(90, None, None, None, None), (91, "", None, None, None), (None, "you idiot moron", None, None, None), (1, "you idiot", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)] + [(3, 1, 1), (None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.score_toxicity(docs, toxicity.fit(docs, labels)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and by[90].predicted == by[91].predicted == 0 and by[None].predicted == by[1].predicted == 1
    none = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score_toxicity(docs.limit(0), none).count() == 0
    assert toxicity.keep_clean(docs, none).columns == docs.columns

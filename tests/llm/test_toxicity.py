import random

import numpy as np
import pytest

from tenura.llm.texts import table
from tenura.llm.toxicity import FEATURES, Automaton, Model, Scanner, Toxicity, fitted_weights, toxicity
from tests.llm.samples import SCHEMA, documents, messy_rows

HOW = Toxicity()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_against_edit_distance():
    rng = random.Random(7)
    terms = ["idiot", "moron", "worthless", "disgusting", "scum", "abcabcabc", "abcabc", "ab"]
    automaton = Automaton(terms, HOW)
    words = []
    for _ in range(3000):
        word = list(rng.choice(terms))
        for _ in range(rng.randrange(0, 4)):
            at = rng.randrange(0, len(word) + 1)
            word[at : at + rng.randrange(0, 2)] = rng.choice(["", "a", "b", "t", "é"])
        words.append("".join(word))
    for word in words:
        allowed = [d for t in terms if (d := distance(word, t)) <= HOW.edits(t)]
        assert automaton.errors(word) == min(allowed, default=-1), word


def test_stems_match_the_start_of_words():
    automaton = Automaton(["lowei*", "worthlessly*", "idiot"], HOW)
    assert automaton.errors("loweischaft") == 0 and automaton.errors("lowei") == 0
    assert automaton.errors("lower") == -1 and automaton.errors("aloweix") == -1
    assert automaton.errors("worthlesslyness") == 0 and automaton.errors("worthlesly") == 1


def test_a_full_table_of_states_changes_nothing(monkeypatch):
    terms = ["idiot", "disgusting", "pathetic"]
    words = ["idiots", "idyot", "disgustingly", "pathetik", "disgust", "patience"] * 3
    wide = Automaton(terms, HOW)
    expected = [wide.errors(w) for w in words]
    monkeypatch.setattr(Automaton, "STATES", 3)
    narrow = Automaton(terms, HOW)
    assert [narrow.errors(w) for w in words] == expected


def test_quotation_lowers_the_score():
    model = Model(("idiot", "worthless"), (3.0, 1.0, 0.5, 0.0, -0.5, 0.5, 0.0, 0.0), -3.0, HOW)
    scanner = Scanner(model.terms, HOW)

    def score(text):
        return model.score(np.array([scanner.features(text)]))[0]

    abuse = score("you are such an idiot and so wothless all day long")
    quoted = score('the teacher said “idiot” is not a word to use and “worthless” is none either')
    assert abuse > 0.5 > quoted
    assert score("a calm text about trees") < 0.1 and score(None) < 0.1
    assert [s[:3] for s in scanner.spans("An IDIOT, a “wortless” man")] == [(3, 8, 0), (13, 21, 1)]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = toxicity(table(spark, folder, "documents"), table(spark, folder, "labels")).join(table(spark, folder, "labels"), "doc_id").where("held_out AND toxic IS NOT NULL").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) >= 0.97


def test_messy_rows_and_missing_labels(spark):
    rows = messy_rows() + [(70, "you idiot, you worthles moron", "en", "s"), (71, '"idiot"', "en", "s")]
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1), (70, 1, None)], "doc_id bigint, quality int, toxic int")
    found = {(r.doc_id, r.held_out): r for r in toxicity(documents(spark, rows), labels).collect()}
    assert len(toxicity(documents(spark, rows), labels).collect()) == len(rows)
    by_id = {k[0]: r for k, r in found.items()}
    assert by_id[70].predicted == 1 and by_id[1].predicted == 0 and by_id[4].score == by_id[5].score
    assert toxicity(spark.createDataFrame([], SCHEMA), labels).count() == 0


def test_weights_of_separable_rows_stay_finite():
    x = np.zeros((40, len(FEATURES)))
    x[:20, 0] = 1
    weights, intercept = fitted_weights(x, (np.arange(40) < 20).astype(float))
    assert np.isfinite(weights).all() and weights[0] + intercept > 0 > intercept
    assert weights[1] == pytest.approx(0)

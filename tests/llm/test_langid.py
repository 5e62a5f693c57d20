from itertools import product

import numpy as np

from tenura.llm.langid import (
    LanguageField, Tagger, fit, forward_backward, identified, learned_lexicon, tagged_words, text_lines, text_shares, trained, word_features,
)
from tenura.llm.texts import table
from tests.llm.samples import SCHEMA, documents, messy_rows


def test_forward_backward_against_enumeration():
    draw = np.random.default_rng(2)
    sizes = np.array([3, 1, 4, 2])
    emission, start, move = draw.normal(size=(sizes.sum(), 3)), draw.normal(size=3), draw.normal(size=(3, 3))
    posterior, pairs, first = forward_backward(emission, sizes, start, move)
    expected, counted, begun, at = [], np.zeros((3, 3)), np.zeros(3), 0
    for size in sizes:
        local = emission[at : at + size]
        at += size
        weights = {}
        for path in product(range(3), repeat=size):
            score = start[path[0]] + sum(local[i, k] for i, k in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:]))
            weights[path] = np.exp(score)
        total = sum(weights.values())
        table_ = np.zeros((size, 3))
        for path, w in weights.items():
            for i, k in enumerate(path):
                table_[i, k] += w / total
            for a, b in zip(path, path[1:]):
                counted[a, b] += w / total
            begun[path[0]] += w / total
        expected.append(table_)
    assert np.allclose(posterior, np.concatenate(expected)) and np.allclose(pairs, counted) and np.allclose(first, begun)


def test_inference_leaves_transitions_out():
    draw = np.random.default_rng(4)
    sizes = np.array([5, 2, 2])
    emission, start, move = draw.normal(size=(9, 3)), draw.normal(size=3), draw.normal(size=(3, 3))
    whole, short = (forward_backward(emission, sizes, start, move, expected) for expected in (True, False))
    assert np.array_equal(whole[0], short[0]) and whole[1].sum() > 0 and not short[1].any()


def test_letters_only():
    assert text_lines("²½ 34 Ⅷ _ ٣") == []
    assert text_lines("नमस्ते दुनिया\n\nสวัสดี e\u0301te") == [["नमस्ते", "दुनिया"], ["สวัสดี", "e\u0301te"]]


def test_word_features():
    words = ["a", "ab", "abcde", "b" * 5_000, "abcde"]
    flat, counts = word_features(words, 16)
    assert counts.tolist() == [2 * len(w) + 5 for w in words] and flat.min() >= 0 and flat.max() < 1 << 16
    ends = np.cumsum(counts)
    each = [flat[a:b].tolist() for a, b in zip(ends - counts, ends)]
    assert each[2] == each[4] and each[0] != each[1][: len(each[0])]
    assert word_features([], 16)[0].tolist() == []
    # The same bigrams and trigrams whatever stands beside the word.
    alone, _ = word_features(["abcde"], 16)
    assert alone.tolist() == each[2]


def test_lexicon_has_words_of_one_language():
    how = LanguageField(lexicon_count=2, lexicon_share=0.9)
    lexicon = learned_lexicon([["und", "die", "rare"], ["und", "die"], ["die", "the"], ["the"]], [0, 0, 1, 1], how)
    known, unknown = word_features(["und"], 16, lexicon)[0], word_features(["und"], 16)[0]
    assert len(lexicon[0]) == 2 and known[1] != unknown[1]
    both = word_features(["die", "rare"], 16, lexicon)[0], word_features(["die", "rare"], 16)[0]
    assert both[0].tolist() == both[1].tolist()


def small_model():
    left = ["der hund geht nicht schnell", "die katze schläft ruhig", "das haus ist nicht groß", "der mann schläft"] * 6
    right = ["the dog walks quickly", "a cat sleeps here", "this house was big", "the man walks there"] * 6
    lines = [t.split() for t in left + right]
    return trained(lines, [0] * len(left) + [1] * len(right), ["de", "en"], LanguageField(bits=12, epochs=8))


def test_words_of_switched_text_are_tagged():
    model = small_model()
    tags = [t for _, t, _ in tagged_words(model, "der hund schläft nicht the dog walks there")]
    assert tags == ["de"] * 4 + ["en"] * 4


def test_a_full_cache_changes_nothing(monkeypatch):
    model = small_model()
    lines = [["der", "hund", "walks"], ["the", "katze"], ["neu", "der", "the"]]
    expected = Tagger(model).posteriors(lines)
    monkeypatch.setattr("tenura.llm.langid.CACHE_WORDS", 4)
    tagger = Tagger(model)
    got = np.concatenate([tagger.posteriors(lines[:1]), tagger.posteriors(lines[1:2]), tagger.posteriors(lines[2:])])
    assert np.allclose(got, expected)


def test_shares_are_of_whole_texts():
    model = small_model()
    tail = " the dog walks" * 300
    shares = text_shares(Tagger(model), ["der hund" + tail, None, "12 ²", "der hund\nder hund\nthe dog", "der hund"])
    assert shares[0][1] > 0.95 and not shares[1].any() and not shares[2].any()
    assert shares[3][0] > 0.5 and np.allclose(shares.sum(axis=1), [1, 0, 0, 1, 1])


def test_long_lines_are_learned_from_runs_by_hash(spark):
    rows = [(i, " ".join(f"{'abc'[k // 150]}{'xyz'[k % 3]}" for k in range(450)), "l", "s", 0) for i in range(60)]
    how = LanguageField(line_words=10, epochs=1, lexicon_count=1)
    found = fit(spark.createDataFrame(rows, SCHEMA), how)
    wanted = learned_lexicon([[f"{a}{b}" for a in "abc" for b in "xyz"]], [0], how)
    assert set(found.lexicon[0]) == set(wanted[0])


def test_only_the_most_frequent_languages_are_learned(spark):
    rows = [(i, f"wort{i % 7} haus", ["de", "en", "fr"][0 if i % 6 < 3 else 1 if i % 6 < 5 else 2], "s", 0) for i in range(60)]
    assert fit(spark.createDataFrame(rows, SCHEMA), LanguageField(languages=2, epochs=1)).labels == ("de", "en")


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = identified(docs).join(docs, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) >= 0.95


def test_messy_rows(spark):
    rows = messy_rows() + [(300 + i, "the quick dog walks over there", "en", "s") for i in range(20)] + [(400, "²½ 34", "de", "s")]
    found = identified(documents(spark, rows)).collect()
    assert len(found) == len(rows) and {r.lang_pred for r in found} <= {"en", "de", "und"}
    by_id = {r.doc_id: r for r in found}
    assert (by_id[400].lang_pred, by_id[400].score) == ("und", 0.0)
    assert (by_id[5].lang_pred, by_id[5].score) == ("und", 0.0) and by_id[4].lang_pred == by_id[6].lang_pred == "und"


def test_nothing_to_learn_from(spark):
    rows = [(1, "some text", None, "s"), (2, None, "en", "s")]
    assert {r.lang_pred for r in identified(documents(spark, rows)).collect()} == {"und"}
    assert identified(spark.createDataFrame([], SCHEMA)).count() == 0

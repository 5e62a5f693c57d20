import random
import re
import zlib
from collections import Counter

import public_tokenizers

from tenura.llm.fertility import COUNTS, Fertility, PieceCounter, kept_documents, quality_rules, repeated_words, script
from tests.llm.samples import SCHEMA, documents, messy_rows

HOW = Fertility(public_tokenizers.path("piece_bpe_32k.model"))


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(hit)


def clean_rows(n=300):
    rng = random.Random(8)
    return [(1000 + i, " ".join(rng.choice(["water", "house", "walking", "green", "mountain", "people", "river", "because"]) + rng.choice(["", "s", "ly"]) for _ in range(rng.randrange(60, 700))) + f" end{i}", "en", "s") for i in range(n)]


def test_against_brute_force(spark):
    rows = messy_rows() + [(20, "a b c a b c\na b c a b c\n\n \nx # $ <b>\nx # $ <b>", "en", "s"), (21, "a a a a", "en", "s")]
    found = sorted((tuple(r[c] for c in ["doc_id", *COUNTS[:5]]) + (r.base_failed,) for r in quality_rules(documents(spark, rows), HOW).collect()), key=repr)
    expected = []
    for r in rows:
        c = brute(r[1])
        expected.append((r[0], *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert found == sorted(expected, key=repr)


def test_bands_reject_what_does_not_look_like_its_language(spark):
    rng = random.Random(2)
    noise = " ".join("".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(9)) for _ in range(60))
    foreign = " ".join("ᚠᛇ" + str(i) for i in range(60))
    rows = clean_rows() + [(1, noise, "en", "s"), (2, foreign, "en", "s")]
    found = {r.doc_id: r for r in quality_rules(documents(spark, rows), HOW).collect()}
    assert not found[1].kept and not found[1].base_failed
    assert not found[2].kept and found[2].byte_share > 0.3
    assert all(r.kept for d, r in found.items() if d >= 1000 and not r.base_failed)


def noisy(seed, n_words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(9)) for _ in range(n_words))


def test_copies_of_junk_do_not_move_their_band(spark):
    rows = clean_rows() + [(i, noisy(5, 60), "en", "s") for i in range(300)]
    found = quality_rules(documents(spark, rows), HOW).collect()
    assert not any(r.kept or r.base_failed for r in found if r.doc_id < 1000)
    assert all(r.kept for r in found if r.doc_id >= 1000 and not r.base_failed)


def test_a_rare_length_takes_in_the_next_ones(spark):
    rows = clean_rows() + [(1, noisy(6, 4000), "en", "s"), (2, " ".join(r[1] for r in clean_rows(5)), "en", "s")]
    found = {r.doc_id: r for r in quality_rules(documents(spark, rows), HOW).collect()}
    assert found[1].n_tokens >= 2 * max(r.n_tokens for d, r in found.items() if d > 1)
    assert not found[1].kept and not found[1].base_failed and found[2].kept


def test_widths_are_learned_from_good_rows(spark):
    """Good rows of a wide group stay, what a stated width keeps beside a narrow group goes; others take the widths of all."""
    rng = random.Random(3)
    odd = [(5000 + i, " ".join(rng.choice(["zyxwv", "qpqpq", "wvuts"]) + str(i % 7) for _ in range(70)) + f" e{i}", "en", "s") for i in range(40)]
    rows = clean_rows() + odd + [(1, noisy(9, 60), "en", "s")]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(r[0], 1, 0) for r in rows if r[0] >= 1000] + [(1, 0, 0)], "doc_id bigint, quality int, toxic int")
    narrow = Fertility(HOW.vocabulary, widths={"chars_per_token": (1.0, 1.0), "byte_share": (1.0, 1.0), "entropy": (1.0, 1.0)})
    stated = {r.doc_id: r for r in quality_rules(docs, narrow).collect()}
    fitted = {r.doc_id: r for r in quality_rules(docs, narrow, labels).collect()}
    assert any(not r.kept for d, r in stated.items() if d >= 1000 and not r.base_failed)
    learned = [r for d, r in fitted.items() if d >= 1000 and not r.base_failed and zlib.crc32(str(d).encode()) % 5]
    assert learned and all(r.kept for r in learned) and not fitted[1].kept
    few = labels.limit(5)
    assert {d: r.kept for d, r in stated.items()} == {r.doc_id: r.kept for r in quality_rules(docs, narrow, few).collect()}


def test_kept_documents_are_unchanged(spark):
    docs = documents(spark, messy_rows() + clean_rows(20))
    left = kept_documents(docs, HOW)
    assert left.columns == docs.columns
    expected = [r.doc_id for r in quality_rules(docs, HOW).collect() if r.kept]
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted(expected, key=repr)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality_rules(empty, HOW).count() == 0 and kept_documents(empty, HOW).count() == 0


def test_measures_of_words():
    counter = PieceCounter(HOW.vocabulary)
    counter.learn({b"the", "ᚠ".encode()})
    n, per_token, share, entropy = counter.measures([b"the", b"the"], 6)
    assert (n, per_token, share, entropy) == (2, 3.0, 0.0, 0.0)
    assert counter.measures(["ᚠ".encode()], 1)[2] > 0.5


def test_repeats_and_scripts():
    assert repeated_words([b"a"] * 3) == 0 and repeated_words([b"a"] * 4) == 4
    assert script("Привет мир abc") == "Cyrillic" and script("12 !") == "" and script("漢字かな漢") == "Han"

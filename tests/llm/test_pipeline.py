"""Queries against their SQL, and the pipeline's stages against the operators and brute force."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tenura.llm import queries
from tenura.llm.mixing import mix
from tests.llm import test_fertility, test_mixing, test_near_duplicates, test_positions
from tests.llm.samples import documents, messy_rows
from verification.compare import connection, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, name):
    con = connection(FOLDER)
    assert differences(queries.QUERIES[name](spark, FOLDER), queries.ORACLES[name], con) == []
    con.close()


def test_one_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES) == list(range(1, 14))


def plain(docs):
    return [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]


def test_stages_take_effect_one_after_another(spark, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert [n.split()[0] for n in names] == ["quality", "MinHash", "benchmark", "mixing", "token-ID"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    columns = docs.columns
    kept = corpus_pipeline.quality(spark, docs, FOLDER)
    assert kept.columns == columns
    rows, left = plain(docs), plain(kept)
    short = {r[0] for r in rows if test_fertility.brute(r[1])[0] < 50}
    assert set(left) < set(rows) and not short & {r[0] for r in left}
    kept.write.parquet(f"{tmp_path}/1")
    kept = spark.read.parquet(f"{tmp_path}/1")
    single = corpus_pipeline.near_dedup(spark, kept, FOLDER)
    expected = {r[0] for r in test_near_duplicates.brute(left, 5) if r[3]}
    assert single.columns == columns and {r[0] for r in plain(single)} == expected
    clean = corpus_pipeline.decontamination(spark, single, FOLDER)
    expected = [r[0] for r in test_positions.brute(plain(single), items) if not r[5]]
    assert clean.columns == columns and sorted(r[0] for r in plain(clean)) == sorted(expected)
    mixed = corpus_pipeline.mixing(spark, clean, FOLDER)
    taken = {r[0]: r[5] for r in test_mixing.brute(plain(clean))[0]}
    assert mixed.columns == columns
    sizes: dict = {}
    for r in plain(mixed):
        sizes[r[0]] = sizes.get(r[0], 0) + len(r[1].encode().split())
    assert sizes == {d: n for d, n in taken.items() if n}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at, expected = 0, []
    for r in sorted(plain(mixed)):
        ids = [*library.encode(r[1], add_special_tokens=False).ids, 1]
        expected.append((r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    written = corpus_pipeline.token_output(spark, mixed, FOLDER)
    assert sorted(tuple(r) for r in written.collect()) == expected
    assert sorted(tuple(r) for r in corpus_pipeline.run(spark, FOLDER).collect()) == expected


def test_clashing_names_change_nothing(spark):
    rows = [(i, f"{i % 40} " + " ".join(f"wort{(i % 40) * 7 + k}" for k in range(60)), "en", "ab"[i % 2]) for i in range(80)]
    plain_docs = documents(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        own = plain_docs.select("doc_id", "text", "lang", "source", "n_chars")
        assert sorted(plain(stage(spark, plain_docs, FOLDER))) == sorted(plain(stage(spark, own, FOLDER)))


def test_every_stage_takes_messy_and_empty_tables(spark):
    for rows in (messy_rows(), []):
        docs = documents(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            left = stage(spark, docs, FOLDER)
            assert left.columns == docs.columns
            assert left.count() <= 3 * len(rows)
        assert corpus_pipeline.token_output(spark, docs, FOLDER).count() == len(rows)
        assert mix(docs).count() == len(rows)

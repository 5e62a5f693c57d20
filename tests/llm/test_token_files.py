import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tenura.llm import rans
from tenura.llm.texts import shared_folder
from tenura.llm.token_files import TokenFiles, WordEncoder, read_tokens, token_documents, write_token_files
from tests.llm.samples import SCHEMA, documents, messy_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, rows):
    """Rows in file order: NULL ids first; of equal ids any order of their texts gives the same set of token counts."""
    out = []
    for r in rows:
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 1]
        out.append((r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


def check(rows, found, library):
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in found], key=repr) == sorted(expected(library, rows), key=repr)
    ordered = sorted(found, key=lambda r: (r.start, r.n_tokens))
    at = 0
    for r in ordered:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in ordered]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_files_of_messy_rows(spark, library):
    rows = messy_rows() + [(50, "a <|endoftext|> b<|startoftext|>", "", ""), (51, "İSTANBUL ΣΊΣΥΦΟΣ É é <|ENDOFTEXT|>", "", ""), (52, "ctrl\x01char \x1c x", "", "")]
    for how in (TokenFiles(PATH), TokenFiles(PATH, shard_tokens=500, cache_words=50)):
        check(rows, token_documents(documents(spark, rows), shared_folder(spark, "t"), how).collect(), library)


def test_empty_table(spark):
    assert token_documents(spark.createDataFrame([], SCHEMA), shared_folder(spark, "t"), TokenFiles(PATH)).collect() == []


def test_runs_of_tokens_are_read_from_checkpoints(spark, library):
    rows = [(i, f"token number {i} of many", "", "") for i in range(40)]
    path = shared_folder(spark, "t")
    write_token_files(documents(spark, rows).coalesce(1), path, TokenFiles(PATH))
    part = spark.read.parquet(path).select("part").first()[0]
    ids = []
    for r in rows if spark.read.parquet(path).count() == 1 else []:
        ids += [*library.encode(r[1], add_special_tokens=False).ids, 1]
    if ids:
        assert read_tokens(spark, path, part, 0, 17, 60) == ids[17:77]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_words_encode_as_texts(texts):
    library = Tokenizer.from_file(PATH) if not hasattr(test_words_encode_as_texts, "t") else test_words_encode_as_texts.t
    test_words_encode_as_texts.t = library
    encoder = getattr(test_words_encode_as_texts, "e", None) or WordEncoder(PATH, 200)
    test_words_encode_as_texts.e = encoder
    got = [list(map(int, x)) for x in encoder.texts(texts, None)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 5000), st.integers(1, 300), st.integers(0, 2**32 - 1))
def test_shards_round_trip(n, symbols, seed):
    draw = np.random.default_rng(seed)
    ids = (draw.geometric(0.05, n) % symbols * 7).astype(np.uint16)
    layout = rans.Layout(lanes=8, steps=32, every=16, scale_bits=12)
    shard = rans.Shard(rans.encode(ids, [5, None], [n, 0], layout))
    assert shard.doc_ids == [5, None] and list(shard.doc_sizes) == [n, 0]
    assert (shard.tokens() == ids).all()
    first, count = int(draw.integers(0, n + 1)), int(draw.integers(0, 400))
    assert (shard.tokens(first, count) == ids[first : first + count]).all()


def test_damage_is_found():
    image = rans.encode(np.arange(5000, dtype=np.uint16) % 900, [1], [5000])
    for at in (0, 10, 60, len(image) // 2, len(image) - 300):
        broken = bytearray(image)
        broken[at] ^= 0x41
        with pytest.raises((rans.CorruptShard, zlib.error)):
            rans.Shard(bytes(broken)).tokens()
    with pytest.raises(rans.CorruptShard):
        rans.Shard(image[:-4])


def test_frequencies_fill_the_scale():
    for counts in ([1], [10**9, 1, 1, 1], [1] * 4096, [3] * 4000 + [10**7]):
        scaled = rans.frequencies(np.array(counts), 12)
        assert scaled.sum() == 4096 and scaled.min() >= 1


def test_parted_signs_change_no_id():
    rng = random.Random(4)
    signs = [*"ab.,'\"!? \n\t19é漢ß²½Σİ\u0301 -_#<|>sт", "n't", "'s", ". ", ", ", "..", ",.", "a.", "b,", " .", "c. d", "Σ. ", "é, "]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(4_000)]
    encoder = WordEncoder(PATH, 5_000)
    assert encoder.parts
    for start in range(0, len(texts), 256):
        some = texts[start : start + 256]
        assert [x.tolist() for x in encoder.texts(some, None)] == [encoder.library.encode(t, add_special_tokens=False).ids for t in some]

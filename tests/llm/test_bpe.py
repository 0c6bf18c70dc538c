"""Byte-pair encoding against the public library."""

import hashlib
import random

import pytest
import public_tokenizers
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from longspan.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", None, "Hello, World's  end!", "aaaa aaaaaaa bbbbbb", "é é ÀÉÎ ΣΑΣ ς İstanbul ß", "a<|endoftext|>b <|STARTOFTEXT|> <|startoftext|><",
       "１２３ ½ 4567 x\x1cy\x85z w ​ 　 中文字 emoji 👩‍👩‍👧 'S 'LL we'Re don't", "́ á 한글 한", "der " * 3000,
       "x" * 5000, "a\tb\nc\r\nd", "100% *** $$$ <b> | |", "ﬁ ⅷ ͅ ǆ ǅ Ⓐ"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.load(PATH))


def same(encoder, library, texts):
    ids, offsets = encoder(texts)
    for k, t in enumerate(texts):
        want = library.encode(t or "", add_special_tokens=False).ids
        got = ids[offsets[k]:offsets[k + 1]]
        assert got.tolist() == want, t
        assert bpe.decode_ids(encoder.v, got) == library.decode(want, skip_special_tokens=False)


def test_odd_texts(encoder, library):
    same(encoder, library, ODD)


def test_mixed_scripts(encoder, library):
    rng = random.Random(1)
    pools = [(0x20, 0x7F), (0xA0, 0x250), (0x370, 0x400), (0x400, 0x500), (0x590, 0x700), (0x900, 0xA00), (0x3040, 0x3100), (0x4E00, 0x5000),
             (0x1F300, 0x1F700), (0x2000, 0x2070), (0x1, 0x20)]
    texts = ["".join(chr(rng.randrange(*pools[rng.randrange(len(pools))])) for _ in range(rng.randrange(60))) for _ in range(800)]
    same(encoder, library, texts)


@settings(max_examples=200, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=40), max_size=6))
def test_any_texts(encoder, library, texts):
    same(encoder, library, texts)


def test_new_cache_changes_nothing(library):
    small = bpe.Encoder(bpe.load(PATH), cache_words=2)
    for _ in range(3):
        same(small, library, ODD)


def test_query_and_columns(spark, library):
    rows = [(i, t, "own") for i, t in enumerate(ODD)] + [(None, "again", "x"), (0, "", "y"), (0, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, token_ids string")
    got = bpe.digest(docs, PATH).collect()
    want = {}
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    assert len(got) == len(rows)
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == want[r.doc_id] for r in got)
    decoded = bpe.decode(bpe.encode(docs, PATH), PATH).where("doc_id = 3").first()
    ids = library.encode(ODD[3], add_special_tokens=False).ids
    assert decoded.token_ids == ids and decoded.decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.digest(docs.limit(0), PATH).count() == 0

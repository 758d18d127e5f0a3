from __future__ import annotations

import json
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.llm import tokens
from orderloom.llm.queries import END_ID, QUERIES, tokenizer_path
from orderloom.llm.wavelet import WaveletMatrix
from orderloom.session import run_dir

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(tokenizer_path())
    return lambda text: made.encode(text or "", add_special_tokens=False).ids


def brute(rows, plain):
    out, at = [], 0
    for i, text in rows:
        ids = np.array([*plain(text), END_ID], "<u4")
        out.append((i, at, len(ids), crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_query_against_brute_force(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    found = QUERIES["op2_token_shards"](spark, SF).collect()
    assert sorted(map(tuple, found)) == brute([(d.doc_id, d.text) for d in docs], plain)


def test_odd_rows_and_small_shards(spark, plain):
    rows = [(None, "first"), (1, None), (2, ""), (3, "a  b <|endoftext|> c"), (5, "long word " * 30_000), (6, "é漢字 😀")]
    docs = spark.createDataFrame([(*r, "c", 1) for r in [*rows, (4, "same"), (4, "same")]], "doc_id long, text string, id string, start int")
    path = run_dir(spark, "tokens_test")
    manifest = tokens.write_shards(docs, path, tokenizer_path(), END_ID, shard_tokens=50)
    found = tokens.decoded(spark, path, manifest).collect()
    every = sorted([*rows, (4, "same"), (4, "same")], key=lambda r: -1 if r[0] is None else r[0])
    assert sorted(map(tuple, found), key=lambda r: r[1]) == brute(every, plain)
    assert manifest.count() >= 2
    word = plain(" word")[0]
    hits = tokens.find_token(spark, path, word).groupBy("doc_id").agg(F.count("*"), F.min("position"), F.max("position")).collect()
    ids = plain("long word " * 30_000)
    assert [tuple(h) for h in hits] == [(5, 30_000, ids.index(word), max(i for i, t in enumerate(ids) if t == word))]
    assert tokens.count_token(spark, path, word) == 30_000
    assert tokens.count_token(spark, path, END_ID) == len(every)


def test_queries_follow_the_plain_call_of_the_tokenizer(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(tokenizer_path())
    plain = lambda text: made.encode(text or "", add_special_tokens=False).ids
    assert plain("a <|endoftext|> b") == [64, 220, 50256, 275]
    rows = [(1, "a <|endoftext|> b"), (2, "x<|endoftext|>y <|endoftext|>"), (3, "a <|endoftext| > b"), (4, "word é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = brute(rows, plain)
    assert sorted(map(tuple, QUERIES["op2_token_shards"](spark, str(tmp_path)).collect())) == want
    assert sorted(map(tuple, corpus_pipeline.token_output(spark, docs, str(tmp_path)).collect())) == want


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    path = run_dir(spark, "tokens_test")
    assert tokens.decoded(spark, path, tokens.write_shards(docs, path, tokenizer_path())).count() == 0


ENCODER = []


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(list(" \n\t'.,|aZ9éñßЖ漢　᠎​\x1c\xa0ſĠ̈́")), st.characters(codec="utf-8")), max_size=40))
def test_encoder_against_the_tokenizer(text):
    if not ENCODER:
        from tokenizers import Tokenizer

        ENCODER.extend([tokens.Encoder(tokenizer_path(), END_ID), Tokenizer.from_file(tokenizer_path())])
    mine, made = ENCODER
    texts = [text, f"it's {text} don't", text.replace(" ", "  "), f"a.\n{text}\nB", f"x<|endoftext|>{text}"]
    found = mine.encode(texts)
    for t, f in zip(texts, found):
        want = made.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(f, "<u4").tolist() == [*want, END_ID]


@pytest.mark.parametrize("kept", [1, 50, 10**6])
def test_encoder_on_documents_with_a_small_table(spark, plain, monkeypatch, kept):
    monkeypatch.setattr(tokens, "WORDS_KEPT", kept)
    monkeypatch.setattr(tokens, "PIECES_KEPT", kept)
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 5000)
    encoder = tokens.Encoder(tokenizer_path(), END_ID)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    for at in range(0, len(texts), 100):
        for text, found in zip(texts[at : at + 100], encoder.encode(texts[at : at + 100])):
            assert np.frombuffer(found, "<u4").tolist() == [*plain(text), END_ID]


def test_special_names_as_text():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(tokenizer_path())
    made.encode_special_tokens = True
    mine = tokens.Encoder(tokenizer_path(), END_ID, special_as_text=True)
    for text in ("a <|endoftext|> b", "x<|endoftext|>", "plain"):
        want = made.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(mine.encode([text])[0], "<u4").tolist() == [*want, END_ID]


def test_other_tokenizer_files(tmp_path):
    """Files that do more than cut into bytes: their tokenizer is followed on whole texts."""
    from tokenizers import Tokenizer

    config = json.load(open(tokenizer_path()))
    others = {
        "lower": {"normalizer": {"type": "Lowercase"}},
        "prefix": {"pre_tokenizer": {**config["pre_tokenizer"], "add_prefix_space": True}},
        "uncut": {"pre_tokenizer": {**config["pre_tokenizer"], "use_regex": False}},
        "digits": {"pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "Digits", "individual_digits": True}, config["pre_tokenizer"]]}},
    }
    texts = ["Hello World HELLO", "it is 1234 o'clock", " two  blanks", "", "é\nß"]
    for name, change in others.items():
        path = tmp_path / f"{name}.json"
        path.write_text(json.dumps(config | change))
        made = Tokenizer.from_file(str(path))
        for text, found in zip(texts, tokens.Encoder(str(path), END_ID).encode(texts)):
            want = made.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(found, "<u4").tolist() == [*want, END_ID], (name, text)


@pytest.mark.parametrize("n", [0, 1, 2, 511, 512, 513, 5000])
@pytest.mark.parametrize("most", [1, 2, 50_257, 1 << 20])
def test_wavelet_matrix(n, most):
    ids = (np.random.default_rng(n).zipf(1.3, n) % most).astype(np.uint32)
    made = WaveletMatrix.of(ids)
    assert (made.decode() == ids).all() and made.decode().dtype == np.uint32
    assert (made.access(np.arange(n)) == ids).all()
    for token in {0, 1, most - 1, most, *ids[:5].tolist()}:
        where = np.flatnonzero(ids == token)
        assert made.count(token) == len(where)
        assert (made.occurrences(token) == where).all()
        some = where[(where >= n // 3) & (where < n - 1)]
        assert made.count(token, n // 3, max(n - 1, n // 3)) == len(some)
        assert (made.occurrences(token, n // 3, max(n - 1, n // 3)) == some).all()

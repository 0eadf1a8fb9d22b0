"""Token counts against the library, and what the cache saves."""

import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from holdsift.llm import tokencounts as tc

SCHEMA = "doc_id long, text string, content string, n_tokens string, version int"
TEXTS = [None, "", " \t\n ", "Hello  World", "hello world", "HELLO WORLD", "é é É  É", "a<|startoftext|>b", "A<|STARTOFTEXT|>B",
         "a <|endoftext|>  <|endoftext|> b", "it's WE'LL 12 ½ ²", "İ İ Σας ΣΑΣ", "\x85 x　y", "x\x0b\x0cy", "日本語のテキスト 👩‍👩‍👧", "̀ x  ̀", "\x1c\x1f\x00"]


def library(name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return path, lambda t: len(sp.encode(t or ""))
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return path, lambda x: len(t.encode(x or "", add_special_tokens=False).ids)


def some_texts(seed, n):
    rng = random.Random(seed)
    signs = ["a", "B", "é", "É", "İ", "Σ", " ", "  ", "\t", "\n", "\x0b", " ", "<|", "|>", "<|startoftext|>", "<|EndOfText|>", "'s", "'LL", "1", "½", "-", "字"]
    return ["".join(rng.choice(signs) for _ in range(rng.randrange(12))) for _ in range(n)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_equal_the_library(spark, tmp_path, name):
    path, count = library(name)
    texts = TEXTS + some_texts(3, 400) + ["Long words and " * 30_000]
    rows = [(i if i % 50 else None, t, "c", "n", 1) for i, t in enumerate(texts)] + [(1, "x", "c", "n", 1)] * 3
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = tc.token_counts(df, path, tc.CountCache(spark, f"{tmp_path}/cache"))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = sorted((repr(d), len((t or "").encode()), count(t), count(t) > tc.LIMIT) for d, t, *_ in rows)
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()) == want


@pytest.mark.parametrize("sent", [0, tc.SENT_BYTES])
def test_only_distinct_misses_are_encoded_and_appended(spark, tmp_path, monkeypatch, sent):
    monkeypatch.setattr(tc, "SENT_BYTES", sent)
    path, count = library("word_bpe_49k.json")
    cache = tc.CountCache(spark, f"{tmp_path}/cache")
    version = tc.tokenizer_version(path)
    make = lambda texts: spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], SCHEMA)
    assert tc.token_counts(make([]), path, cache).count() == 0 and cache.counts(version).count() == 0
    first = ["One two", "one  TWO", "one two ", "three", "three"]
    tc.token_counts(make(first), path, cache)
    stored = spark.read.parquet(cache.folder)
    # "one two " ends in a space of its own, the three others are two contents
    assert stored.count() == 3
    # a planted count comes back for what is stored, so stored contents are not encoded again
    other = tc.CountCache(spark, f"{tmp_path}/other")
    other.append(cache.counts(version).selectExpr("content", "n_tokens + 1000 as n_tokens"), version)
    got = tc.token_counts(make(first + ["new text", "NEW  text"]), path, other).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == [
        *((i, count(t) + 1000) for i, t in enumerate(first)), (5, count("new text")), (6, count("new text"))]
    assert spark.read.parquet(other.folder).count() == 4
    assert cache.counts("another version").count() == 0


def test_normal_form_keeps_counts(spark):
    path, count = library("word_bpe_49k.json")
    texts = [t for t in TEXTS if t] + some_texts(9, 3000)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select("text", tc._content_of(path)(df.text).alias("content")).collect():
        assert count(r.content) == count(r.text), (r.text, r.content)


def test_words_are_encoded_once_and_add_up(monkeypatch):
    path, count = library("word_bpe_49k.json")
    assert tc.counts_by_words(path)
    assert not any(tc.counts_by_words(library(n)[0]) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    sent = []
    whole = tc._counter(path)
    counter = tc.WordCounter(lambda texts: sent.extend(texts) or whole(texts))
    # each text several times over, so that words repeat; then all of them again
    texts = [" ".join([t] * 9) for t in TEXTS[1:] + some_texts(4, 2000)]
    assert counter(texts) == [count(t) for t in texts]
    met = len(sent)
    assert len(set(sent)) == met and sum(map(len, sent)) * 8 < sum(map(len, texts))
    assert counter(texts[::-1]) == [count(t) for t in texts[::-1]] and len(sent) == met
    # texts of new words go whole; a full memory starts anew with the same counts
    new = [f"{i}x{i * 7919} q{i}" for i in range(50)]
    assert counter(new) == [count(t) for t in new] and sent[met:] == new
    monkeypatch.setattr(tc, "REMEMBERED", 5)
    assert counter(texts) == [count(t) for t in texts] and not counter.known
    assert counter(texts) == [count(t) for t in texts]

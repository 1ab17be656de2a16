"""Long words on which sums of powers modulo 2^64 agree: two words are two words everywhere."""

import hashlib

import public_tokenizers
import pytest

from paperlens.llm.byte_bpe import encode_documents
from paperlens.llm.ngram_join import similar_documents
from paperlens.llm.phrase_automata import without_repeats
from paperlens.llm.simple8b import token_report


def thue_morse(n):
    return "".join("ab"[bin(k).count("1") % 2] for k in range(n))


@pytest.fixture(scope="module", params=[1024, 4096])
def words(request):
    one = thue_morse(request.param)
    return one, one.translate(str.maketrans("ab", "ba"))


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_such_words_are_not_linked(spark, words):
    made = similar_documents(docs_of(spark, [f"{w} x y z w" for w in words])).collect()
    assert {r["doc_id"]: r["component_id"] for r in made} == {0: 0, 1: 1}


def test_such_words_make_no_passage(spark, words):
    rest = " ".join(f"w{k}" for k in range(19))
    made = without_repeats(docs_of(spark, [f"{w} {rest}" for w in words] + [f"{words[0]} {rest}"])).collect()
    assert {r["doc_id"]: r["n_removed"] for r in made} == {0: 0, 1: 0, 2: 20}


def test_such_words_have_their_own_ids(spark, words):
    docs = docs_of(spark, words)
    made = {r["doc_id"]: r for r in encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).collect()}
    for k, word in enumerate(words):
        assert made[k]["decoded_sha256"] == hashlib.sha256(word.encode()).hexdigest()
    found = {r["doc_id"]: r["ids_crc32"] for r in token_report(spark, docs, public_tokenizers.path("byte_bpe_50k.json")).collect()}
    assert found[0] != found[1]

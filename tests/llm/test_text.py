"""Arrays of words and pieces, packed ids, byte-level BPE: against the libraries and round trips."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pyspark.sql import functions as F

from paperlens.llm import byte_bpe, pieces, simple8b, textblocks

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["'s", "'re", "'ll", "'", "  ", " ", "\n", "\t", "a", "ab", "é", "日本", "1", "23", "!", "?!", "'d", "\r\n", "S", " ", "\U0001f600", "\x1c", "\x85"]
TEXTS = st.one_of(st.text(max_size=40), st.lists(st.sampled_from(ODD), max_size=25).map("".join))


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(texts, table):
    out = []
    for _, data, offsets in textblocks.blocks(pa.array(texts, pa.string()), limit=200):
        ids, bounds = table.encoded(data, offsets)
        out += [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
    return out


@settings(deadline=None, max_examples=150)
@given(st.lists(TEXTS, max_size=8))
def test_ids_equal_those_of_the_libraries(library, texts):
    assert encoded(texts, byte_bpe.encoder(RANKS)[1]) == [library.encode_ordinary(t) for t in texts]
    tokenizer = Tokenizer.from_file(JSON)
    expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts if "<|endoftext|>" not in t]
    assert encoded([t for t in texts if "<|endoftext|>" not in t], simple8b.piece_table(JSON)) == expected


END = "<|endoftext|>"
PLANTED = ["a <|endoftext|> b", END, END + END, f"  {END}  ", f"x{END}'s", f"<|endo{END}ftext|>", f"é \n{END}\n日本 {END[:-1]}", "<|endo", "ftext|>", "<" + END + ">", "", END[:-2]]
WITH_END = st.lists(st.sampled_from([*ODD, END, END[:6], END[6:], "<", "|>"]), max_size=12).map("".join)


@settings(deadline=None, max_examples=150)
@given(st.lists(WITH_END, max_size=8))
def test_added_tokens_are_ids_of_their_own(library, texts):
    tokenizer = Tokenizer.from_file(JSON)
    for some in (texts, PLANTED):
        assert encoded(some, simple8b.piece_table(JSON)) == [tokenizer.encode(t, add_special_tokens=False).ids for t in some]
        assert encoded(some, byte_bpe.encoder(RANKS)[1]) == [library.encode_ordinary(t) for t in some]
    assert encoded(["a <|endoftext|> b"], simple8b.piece_table(JSON)) == [[64, 220, 50256, 275]]


def test_token_files_with_added_tokens(spark):
    tokenizer = Tokenizer.from_file(JSON)
    docs = spark.createDataFrame(list(enumerate(PLANTED)), "doc_id long, text string")
    expected, start = [], 0
    for k, text in enumerate(PLANTED):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        expected.append((k, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, simple8b.token_report(spark, docs, JSON).collect())) == expected


@settings(deadline=None, max_examples=100)
@given(st.binary(max_size=40))
def test_backtracking_gives_the_merges(text):
    bpe = byte_bpe.encoder(RANKS)[0]
    ids = bpe.piece(text)
    assert ids == bpe.merged(text)
    assert bpe.decode(np.array(ids, np.int64)).tobytes() == text


def test_table_forgets_and_still_encodes(library):
    table = pieces.PieceTable(byte_bpe.encoder(RANKS)[0].encode_pieces, most=3)
    for text in ("some words here", "others there", "some words here"):
        assert encoded([text], table) == [library.encode_ordinary(text)]


@settings(deadline=None, max_examples=100)
@given(st.lists(st.text(alphabet="ab \t\n\x0b\x1c é", max_size=30), max_size=6), st.booleans())
def test_words(texts, lower):
    column = pa.array(texts + [None], pa.string())
    found = []
    for _, data, offsets in textblocks.blocks(column, limit=20):
        starts, ends, rows = textblocks.word_bounds(data, offsets)
        for a, b in zip(rows, rows[1:]):
            found.append([data[s:e].tobytes() for s, e in zip(starts[a:b], ends[a:b])])
    assert found == [t.encode().split() for t in texts] + [[]]


def test_equal_words_have_equal_hashes():
    column = pa.array(["A b a", "b A", "ab"])
    _, data, offsets = next(textblocks.blocks(column))
    plain, _ = textblocks.word_hashes(data, offsets)
    folded, _ = textblocks.word_hashes(data, offsets, lower=True)
    assert plain[0] == plain[4] != plain[2] and plain[1] == plain[3] and folded[0] == folded[2] == folded[4]
    assert len(set(plain.tolist())) == 4


@settings(deadline=None, max_examples=60)
@given(st.integers(0, 64), st.integers(0, 1200), st.integers(0, 1 << 30))
def test_packed_ids_come_back(bits, count, seed):
    rng = random.Random(seed)
    ids = np.array([rng.getrandbits(rng.randint(0, bits)) for _ in range(count)], np.uint64)
    if count > 3:
        ids[1:4] = [simple8b.PAYLOAD, simple8b.PAYLOAD - np.uint64(1), np.uint64((1 << 64) - 1)]
    words, ends, escapes, _ = simple8b.pack(ids)
    assert (simple8b.unpack(words, ends, escapes, count) == ids).all()
    cuts = np.array([0, count // 2, count])
    docs, back, read = simple8b.from_bytes(simple8b.to_bytes([5, None, -1], cuts, ids))
    assert docs == [5, None, -1] and (back == cuts).all() and (read == ids).all()


def test_zeros_pack_into_few_words():
    words, ends, _, _ = simple8b.pack(np.zeros(240 * 16, np.uint64))
    assert len(words) <= 2 * len(ends)


def test_not_a_token_file():
    with pytest.raises(ValueError):
        simple8b.from_bytes(b"something else" * 9)


def test_encoded_documents(spark, odd, odd_rows, none, library):
    rows = byte_bpe.encode_documents(odd, RANKS, keep_ids=True).collect()
    expected = []
    for row in odd_rows:
        ids = library.encode_ordinary(row[1] or "")
        expected.append((row[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256((row[1] or "").encode()).hexdigest(), ids))
    assert sorted(map(tuple, rows), key=repr) == sorted(expected, key=repr)
    assert byte_bpe.encode_documents(none, RANKS).count() == 0


def test_token_files(spark, odd, odd_rows, none, tmp_path):
    tokenizer = Tokenizer.from_file(JSON)
    ordered = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected, start = [], 0
    for row in ordered:
        ids = [*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 0]
        expected.append((row[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, simple8b.token_report(spark, odd, JSON).collect()), key=repr) == sorted(expected, key=repr)
    # Files are closed early; what is read back does not depend on it.
    folder = str(tmp_path / "tokens")
    listed = spark.createDataFrame(simple8b.write_tokens(odd, folder, JSON, file_ids=50).collect())
    assert listed.count() > 5
    tasks = simple8b.read_tokens(listed, folder).select(F.spark_partition_id()).distinct().count()
    assert tasks == listed.count()  # one task for each file
    back = simple8b.read_tokens(listed, folder).collect()
    assert sorted((r.doc_id, r.start, r.n_tokens) for r in back if r.doc_id is not None) == sorted(e[:3] for e in expected if e[0] is not None)
    assert all(len(r.ids) == r.n_tokens for r in back)
    assert simple8b.token_report(spark, none, JSON).count() == 0

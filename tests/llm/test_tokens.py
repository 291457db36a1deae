import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import SF, docs_of
from tokenizers import Tokenizer

from shelfcast.llm import tokens
from shelfcast.llm.common import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(rows):
    tok, out, start = Tokenizer.from_file(PATH), [], 0
    for doc_id, text in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


EDGE = [(0, None), (1, ""), (2, " a  b\n\n c\t"), (3, "it's we'll 'tis 12½ x² naïve ÀÉ ßʼn"), (4, "漢字 и кириллица 🙂"),
        (5, "before <|endoftext|> after"), (6, "a\x1cb\x85c\xa0d \x1f e"), (7, "word " * 30_000), (8, "!!! ???  \r\n"),
        (9, "x" * 5_000), (10, "'s's 's"), (11, " "), (12, "\n \n"), (13, "éé́"),
        (14, "  two   three    four\n  x \n y \t z  "), (15, " lead"), (16, "  lead"), (17, "   lead"), (18, "trail "),
        (19, "trail  "), (20, "trail\n "), (21, "a \n\n b\xa0 c \xa0 d"), (22, "one\n two\n\n three")]


def test_edge_texts_match_the_tokenizer(spark):
    got = tokens.encode_documents(docs_of(spark, EDGE, extra=("part", "frame", "ids")), PATH).collect()
    assert sorted(map(tuple, got)) == brute(EDGE)


def test_whole_table_and_document_access(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    path = scratch_path(spark, "tokens-test")
    tokens.write_tokens(docs.repartition(3), path, PATH)
    assert sorted(map(tuple, tokens.token_digest(spark, path).collect())) == brute(rows)
    tok = Tokenizer.from_file(PATH)
    for doc_id, text in rows[::60]:
        assert tokens.read_document(spark, path, doc_id) == [[*tok.encode(text, add_special_tokens=False).ids, 2]]


def test_repeated_and_null_ids_and_empty_table(spark):
    got = tokens.encode_documents(docs_of(spark, [(None, "b"), (1, "a"), (1, "a a"), (None, "b")]), PATH).collect()
    assert sum(r.n_tokens for r in got) == 9
    assert sorted(r.start for r in got) == [0, 2, 4, 6] and [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None, None, 1, 1]
    assert tokens.encode_documents(docs_of(spark, []), PATH).count() == 0


def test_a_changed_dictionary_is_noticed(spark):
    path = scratch_path(spark, "tokens-bad")
    tokens.write_tokens(docs_of(spark, [(1, "a")]), path, PATH)
    d = spark.read.parquet(f"{path}_dictionary").first()
    other = scratch_path(spark, "tokens-bad2")
    spark.read.parquet(path).write.parquet(other)
    spark.createDataFrame([(d.dict_sha256, bytearray(b"other"), 2)], "dict_sha256 string, dictionary binary, width int") \
        .write.parquet(f"{other}_dictionary")
    with pytest.raises(ValueError, match="dictionary"):
        tokens.read_tokens(spark, other)


def test_other_tokenizers_are_encoded_whole():
    enc = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert not enc.by_piece
    ids = np.frombuffer(enc.ids("Hello there"), dtype=f"<u{enc.width}").tolist()
    assert ids == Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode("Hello there", add_special_tokens=False).ids

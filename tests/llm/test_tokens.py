import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from strata.llm import bpe, token_counts
from tests.llm.fixtures import ODD_DOCS, empty_docs, odd_docs

PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    chars = [chr(i) for i in range(0x3100) if not 0xD800 <= i < 0xE000] + ["\U0001f600", "▁", "　"]
    out = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    out += ["".join(rng.choice(["a", "b", " ", "  ", "\n", "\t", "\r", "▁", "'s", "1", "é", "<|endoftext|>", "\x1c", "\x85"]) for _ in range(rng.randint(0, 40))) for _ in range(600)]
    return [*out, "", " ", "\n", "a" * 5000, " " * 3000, "ab" * 3000, "aaa bbbb aaaaa", *[r[1] or "" for r in ODD_DOCS]]


def test_counts_equal_the_library(texts):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counter = token_counts.PieceCounter(PIECES, cache_size=500)
    assert [counter.count(t) for t in texts] == [len(x) for x in library.encode(texts, num_threads=1)]


def test_ids_equal_the_library(texts):
    library, own = Tokenizer.from_file(BYTES), bpe.ByteBpe(BYTES, cache_size=700)
    for at in range(0, len(texts), 100):
        for text, ids in zip(texts[at : at + 100], own.encode(texts[at : at + 100])):
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == want
            assert own.decode(ids) == library.decode(want, skip_special_tokens=False) == text


def test_caches_are_bounded_by_bytes(texts, spark):
    """Long runs without blanks are encoded right and leave nothing behind in a worker or the broadcast table."""
    rng = random.Random(6)
    long = ["".join(rng.choice("abcdefgh") for _ in range(3000)) for _ in range(40)]
    mixed = [*long, *(f"{a} word {b} word" for a, b in zip(long, long[1:])), *long]
    library, pieces = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    own, counter = bpe.ByteBpe(BYTES), token_counts.PieceCounter(PIECES)
    for text in mixed:
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert counter.count(text) == len(pieces.encode(text))
    assert max(map(len, own.cache)) <= bpe.LONGEST and max(map(len, counter.known)) <= token_counts.LONGEST
    table = token_counts.frequent_lengths(spark.createDataFrame([(t,) for t in mixed], "text string"), "text", PIECES)
    assert " word" in table and max(map(len, table)) <= token_counts.LONGEST


def test_odd_rows(spark):
    library, pieces = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = bpe.encode_decode(odd_docs(spark), BYTES, keep=("doc_id", "n_chars", "text", "ids")).collect()
    assert len(got) == len(ODD_DOCS)
    for r in got:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["n_tokens"] == len(want) and r["decoded"] == (r["text"] or "")
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    counted = token_counts.count_tokens(odd_docs(spark), PIECES, keep=("doc_id", "text", "n_tokens")).collect()
    assert len(counted) == len(ODD_DOCS) and all(r["n_tokens"] == len(pieces.encode(r["text"] or "")) for r in counted)
    plain = token_counts.count_tokens(odd_docs(spark), PIECES, keep=("doc_id", "n_chars"), table={}).collect()
    assert sorted(x["n_tokens"] for x in plain) == sorted(x["n_tokens"] for x in counted)  # the table decides nothing


def test_empty(spark):
    assert bpe.encode_decode(empty_docs(spark), BYTES).collect() == []
    assert token_counts.count_tokens(empty_docs(spark), PIECES).collect() == []

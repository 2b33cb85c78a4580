import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from strata.llm import token_alignment
from tests.llm.fixtures import ODD_DOCS, empty_docs, odd_docs

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def brute(texts):
    """Token by token, with both libraries and a loop over all offsets."""
    left, right = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    left.encode_special_tokens = True
    # the printable stand-ins of the bytes in a byte-level vocabulary
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    docs = []
    for text in texts:
        text = text or ""
        want = b" " + text.encode()
        a = left.encode(" " + text, add_special_tokens=False).ids
        b = right.encode(text)
        a_bytes = [bytes(byte_of[c] for c in left.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if right.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, right.id_to_piece(i)) for i in b)]
        if not text or b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            docs.append(None)
            continue
        spans = []
        for tokens, parts in ((a, a_bytes), (b, b_bytes)):
            at, side = 0, []
            for i, p in zip(tokens, parts):
                side.append((i, at, at + len(p)))
                at += len(p)
            spans.append(side)
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, links, upto = [], Counter(), [0, 0]
        for cut in cuts:
            sides = []
            for k in (0, 1):
                start = upto[k]
                while upto[k] < len(spans[k]) and spans[k][upto[k]][2] <= cut:
                    upto[k] += 1
                sides.append(spans[k][start : upto[k]])
            links.update((x[0], y[0]) for x in sides[0] for y in sides[1] if x[1] < y[2] and y[1] < x[2])
            groups.append("|".join(",".join(str(x[0]) for x in side) for side in sides))
        docs.append((a, b, groups, links))
    count = Counter(p for d in docs if d for p in d[3])
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (len(d[0]), len(d[1]), len(d[2]), sum(d[3].values()), sum(t for p, t in d[3].items() if count[p] == best[p[0]]),
             sum(t * count[p] for p, t in d[3].items()), hashlib.sha256(";".join(d[2]).encode()).hexdigest()) for d in docs]


def random_texts(n, seed=5):
    rng = random.Random(seed)
    parts = ["the", " quick", "  ", "\n", "\r\n", "\t", "é", "ß", "语言", "\U0001f600", "<|endoftext|>", "<s>", "</s>", "▁", " ", "don't", "123", "4567", "#!", "\x00", "ﬁ", "a" * 40, " ", "X", "́", "<0x41>"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(n)]


def test_equals_brute_force_on_odd_texts():
    texts = [t for t in random_texts(400)] + [r[1] for r in ODD_DOCS if r[1] is None or len(r[1]) < 2000]
    want = brute(texts)
    found = token_alignment.Aligner(A, B).documents(texts)
    for i, w in enumerate(want):
        assert (*(found[c][i] for c in COLUMNS[:4]), found["groups_sha256"][i]) == (*w[:4], w[6]), repr(texts[i])
        pairs = slice(found["starts"][i], found["starts"][i + 1])
        assert sum(found["times"][pairs]) == w[3] and len(set(found["pairs"][pairs].tolist())) == pairs.stop - pairs.start


def test_small_caches_change_nothing():
    texts = random_texts(200, 7)
    small = token_alignment.Aligner(A, B)
    small.b.cache_chars = small.b.room = 500
    small.a.cache_size, small.stretch_chars = 20, 3000
    whole = token_alignment.Aligner(A, B)
    for i in range(0, 200, 10):
        x, y = small.documents(texts[i : i + 10]), whole.documents(texts[i : i + 10])
        assert all(list(x[c]) == list(y[c]) for c in x)


def test_new_stretches_are_encoded_in_a_row():
    """The libraries get many new stretches as one text, odd ones (space marks, white space at the end) by themselves."""
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**6)}é" for _ in range(50)) for _ in range(40)] + ["a▁b c", "end of it \n ", "<|endoftext|> <s>", "x\x00 y"]
    aligner, calls = token_alignment.Aligner(A, B), []

    class Counted:
        def encode(self, what, **options):
            calls.extend([what] if isinstance(what, str) else what)
            return library.encode(what, **options)

    library, aligner.b.library = aligner.b.library, Counted()
    found = aligner.documents(texts)
    assert len(calls) < 20 < 2000 < len(aligner.place)
    for i, w in enumerate(brute(texts)):
        assert (*(found[c][i] for c in COLUMNS[:4]), found["groups_sha256"][i]) == (*w[:4], w[6]), repr(texts[i])


def test_stretches_cover_the_text():
    for text in [*random_texts(2000, 11), " ", "a ", "a \n", "\t b", "a\t \u00a0b  c\x1cd \n"]:
        assert "".join(token_alignment.STRETCH.findall(" " + text)) == " " + text


def test_long_chains_end_at_their_last_token():
    """Ends that meet only at the last byte: one group, found in the logarithm of its length of rounds."""
    import numpy as np
    a, b = np.arange(2, 200_001, 2), np.append(np.arange(1, 200_000, 2), 200_000)
    label = token_alignment.terminals(a, b)
    assert set(label.tolist()) == {len(a) - 1}
    at_a, at_b = token_alignment.overlapping(a, b)
    assert len(at_a) == 2 * len(a)


@pytest.mark.parametrize("table_size", [token_alignment.TABLE_SIZE, 500, 0])
def test_corpus_counts(spark, table_size):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(random_texts(100, 9))], "doc_id long, text string")
    both = docs.select("doc_id", "text").union(odd)
    rows = both.orderBy("doc_id").collect()
    want = dict(zip([r["doc_id"] for r in rows], brute([r["text"] for r in rows])))
    got = token_alignment.align(both, A, B, table_size=table_size).collect()
    assert len(got) == len(rows) and {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in got} == want


def test_odd_rows(spark):
    got = token_alignment.align(odd_docs(spark).withColumn("_row", F.lit("old")).withColumn("n_a", F.lit("old")), A, B).collect()
    assert len(got) == len(ODD_DOCS)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[3]["n_a"] == by_id[4]["n_links"] == by_id[11]["count_sum"] == 0 and by_id[4]["groups_sha256"] == ""
    assert by_id[5]["n_a"] > 0 and by_id[10]["n_groups"] > 0
    # equal texts count as often as they are there
    assert by_id[1]["count_sum"] == by_id[2]["count_sum"] >= 4 * by_id[1]["n_links"]
    assert token_alignment.align(empty_docs(spark), A, B).count() == 0

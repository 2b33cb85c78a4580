"""Byte-level BPE encoding and decoding with batched numpy merge rounds.

Words that a worker has not met are encoded together: the symbols of all of
them lie in one flat array. A round looks up the rank of every adjacent pair
by binary search over the sorted pair keys, takes the lowest rank of each
word, and merges all its places at once; words without a mergeable pair
leave the array. Texts are then put together from the ids of their stretches
(a word with its punctuation, or white space), which a bounded cache keeps;
longer stretches than ``LONGEST`` are kept only while their texts are encoded.

Strings of the tokenizer's added tokens inside a text become their ids, as
the library does by default; no other special token is added. Decoding joins
the bytes of the ids and reads them as UTF-8, bad bytes replaced.

Defined results: a null or empty text has no ids and decodes to the empty
text; rows are kept as they are, repeated ids included; an empty table gives
an empty result; extra columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the pattern that splits a text before byte-level merges.
PRE_TOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# White space as the library's pattern engine has it, and the stretches of a text whose words do not
# depend on their surroundings: a run of other characters with the space before it, or white space.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
STRETCH = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
CACHE_SIZE = 400_000  # stretches whose ids a worker keeps
LONGEST = 64  # characters of a stretch that a worker keeps, at most
NO_RANK = np.iinfo(np.int64).max


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    def __init__(self, path: str, cache_size: int = CACHE_SIZE):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, to_byte = spec["model"]["vocab"], byte_symbols()
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        keys, merged = (left << 32) | right, np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), merged[order]
        self.first = np.array([vocab[c] for c, _ in sorted(to_byte.items(), key=lambda x: x[1])], np.int64)
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.split = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.bytes_of = {i: bytes(to_byte[c] for c in s) for s, i in vocab.items()}
        self.bytes_of |= {i: s.encode() for s, i in self.added.items()}
        self.cache: dict[str, bytes] = {}
        self.cache_size = cache_size

    def rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each pair the rank, NO_RANK if it has none, and its place among the sorted keys."""
        key = (left << 32) | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], NO_RANK), at

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each (non-empty) word, as little-endian unsigned 32-bit integers."""
        symbols = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        rank, at = self.rank(symbols[:-1], symbols[1:])
        rank[word[:-1] != word[1:]] = NO_RANK  # a pair stands at its left symbol; a word's last symbol has none
        rank, at = np.append(rank, NO_RANK), np.append(at, 0)
        done_ids, done_word = [], []
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            lengths = np.diff(np.append(starts, len(word)))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), lengths)
            stay = lowest != NO_RANK
            if not stay.all():
                done_ids.append(symbols[~stay])
                done_word.append(word[~stay])
            places = np.flatnonzero((rank == lowest) & stay)
            if len(places):
                # of a run of one symbol, whose pairs overlap, every second pair from the left
                run = np.flatnonzero(np.append(True, np.diff(places) != 1))
                offset = np.arange(len(places)) - np.repeat(run, np.diff(np.append(run, len(places))))
                places = places[offset % 2 == 0]
                symbols[places] = self.merged[at[places]]
                stay[places + 1] = False
            now = np.cumsum(stay)[places] - 1  # where the merged symbols stand after the others have gone
            symbols, word, rank, at = symbols[stay], word[stay], rank[stay], at[stay]
            for left in (now, now[now > 0] - 1):
                right = np.minimum(left + 1, len(symbols) - 1)
                rank[left], at[left] = self.rank(symbols[left], symbols[right])
                rank[left[(left == right) | (word[left] != word[right])]] = NO_RANK
        ids, owner = np.concatenate(done_ids), np.concatenate(done_word)
        ends = np.cumsum(np.bincount(owner, minlength=len(words))) * 4
        ids = ids[np.argsort(owner, kind="stable")].astype("<u4").tobytes()
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def stretches(self, text: str) -> list[str]:
        """The stretches of a text and, whole, the added tokens in it."""
        if self.split is None or not any(t in text for t in self.added):
            return STRETCH.findall(text)
        found = []
        for i, part in enumerate(self.split.split(text)):
            found += [part] if i % 2 else STRETCH.findall(part)
        return found

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        parts = [self.stretches(t) for t in texts]
        needed = set().union(*parts)
        new = [x for x in needed if x not in self.cache]
        if self.cache and len(self.cache) + len(new) > self.cache_size:
            self.cache.clear()
            new = list(needed)
        self.learn(new)
        ids = [b"".join(map(self.cache.__getitem__, p)) for p in parts]
        for x in new:
            if len(x) > LONGEST:
                del self.cache[x]
        return ids

    def learn(self, stretches: list[str]) -> None:
        """Put the ids of these stretches into the cache."""
        self.cache.update((x, self.added[x].to_bytes(4, "little")) for x in stretches if x in self.added)
        stretches = [x for x in stretches if x not in self.added]
        words = [PRE_TOKEN.findall(x) for x in stretches]
        new = list(set().union(*words))
        if new:
            ids = dict(zip(new, self.encode_words([w.encode() for w in new])))
            self.cache.update((x, b"".join(map(ids.__getitem__, w))) for x, w in zip(stretches, words))

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def encode_decode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", keep: Sequence[str] = ("doc_id",),
                  with_ids: bool = True, ahead: int = 1_000_000, cache_size: int = CACHE_SIZE) -> DataFrame:
    """``keep`` columns of ``docs`` plus n_tokens, ids_sha256, decoded_sha256 and, if asked for, the
    ids and the decoded text. ``ahead``: characters of the texts whose unknown words are encoded
    together (a longer text goes alone)."""
    names = ["n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if with_ids else [])]
    kept = docs.select(*[c for c in keep if c not in names], F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    cols = [c for c in kept.columns if c != "_text"]
    kinds = dict(zip(names, (T.LongType(), T.StringType(), T.StringType(), T.ArrayType(T.LongType()), T.StringType())))
    schema = T.StructType([kept.schema[c] for c in cols] + [T.StructField(n, kinds[n]) for n in names])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(tokenizer_path, cache_size)
        for whole in batches:
            size = np.cumsum([0, *pc.utf8_length(whole.column("_text")).to_pylist()])
            cuts = np.unique(size[:-1] // ahead, return_index=True)[1]
            for at, end in zip(cuts.tolist(), [*cuts.tolist()[1:], whole.num_rows]):
                batch = whole.slice(at, end - at)
                found = {n: [] for n in names}
                for ids in bpe.encode(batch.column("_text").to_pylist()):
                    decoded = bpe.decode(ids)
                    found["n_tokens"].append(len(ids) // 4)
                    found["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
                    found["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                    if with_ids:
                        found["ids"].append(np.frombuffer(ids, "<u4").astype(np.int64))
                        found["decoded"].append(decoded)
                types = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int64())}
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in cols), *(pa.array(found[n], types.get(n, pa.string())) for n in names)], [*cols, *names])

    return kept.mapInArrow(coded, schema)

"""Alignment of the tokens of two tokenizers over the bytes of the same texts.

1. ``aligned``: one pass cuts each text into stretches, where no token of
   either side can reach from one into the next, encodes those that are new to
   the worker with both libraries, many in a row, and aligns them (``Aligner.align``). Many
   stretches lie on one line of bytes; as both sides spell the same bytes, the
   ends of stretches fall together and nothing is linked across them. Every
   token points to its farthest-right overlapping token of the other side;
   where both end together, the token of the first side is the last one of its
   group and points to itself. Doubling the pointers (each takes the pointer of
   what it points to) ends at these tokens after the logarithm of the longest
   chain of rounds: they label the groups. The groups, the links (pairs of
   overlapping tokens) and their numbers are read from the labels. A text's
   are those of its stretches in a row; of its different id pairs it keeps how
   often they occur.
2. ``link_counts``: how many texts hold each id pair, and whether that is the
   highest number of its first id. Pairs are counted map-side; a key is a pair
   of vocabulary entries, so what is shuffled grows with the vocabularies.
3. ``align``: the pairs held by most texts, at most ``table_size``, are
   broadcast, and a text's sums over its links come from binary search in that
   table. Pairs that are not in it (only where a corpus has more) are rare
   ones; they are joined with their counts and summed by row.

The first side encodes a space and the text with a byte-level BPE, strings of
special tokens as plain text; the second encodes the text with a
SentencePiece BPE, which adds the space itself.

Defined results: a null or empty text, or one that either side does not spell
byte by byte (a space mark in it, for one), has no tokens: zeros and an empty
digest; rows are kept as they are, repeated ids included, and a repeated text
counts as often as it is there; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.bpe import ByteBpe
from strata.llm.near_dup import blocks
from strata.llm.token_counts import SPACE_MARK, separable
from strata.sources.checkpoint import materialize

PIECE = re.compile(r" +[^ \n]*|[^ \n]+|\n")  # what the piece model encodes by itself
# A stretch starts with a blank behind anything but white space: there both sides begin a new word.
STRETCH = re.compile(r" \s*\S+(?:[^\S ]\s*\S+)*(?:[^\S ]\s*\Z)?| \s*\Z")
CACHE_CHARS = 4_000_000  # room of a worker's cache of words, an entry taking its characters and ENTRY
ENTRY = 300
STRETCH_CHARS, LINK_CHARS = 90_000_000, 16  # room of a worker's aligned stretches; what one link in them takes
ROW_CHARS = 100_000  # characters of stretches that the libraries encode in a row
TABLE_SIZE = 1 << 18  # id pairs of the broadcast table
NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


class Pieces:
    """Ids of texts under a SentencePiece model, its pre-tokens kept in a cache bounded by characters."""

    def __init__(self, model_path: str, cache_chars: int = CACHE_CHARS):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.separable = separable(self.library)
        self.cache: dict[str, bytes] = {}
        self.room = self.cache_chars = cache_chars
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        if not self.separable:
            return [np.array(ids, "<u4").tobytes() for ids in self.library.encode(texts, num_threads=1)]
        words = [PIECE.findall(" " + t.replace(SPACE_MARK, " ")) for t in texts]
        wanted = set().union(*words)
        new = [w for w in wanted if w not in self.cache]
        needed = sum(map(len, new)) + ENTRY * len(new)
        if needed > self.room:
            self.cache, new = {}, list(wanted)
            needed = sum(map(len, new)) + ENTRY * len(new)
            self.room = self.cache_chars
        # behind a line feed no space is added; the two tokens of space mark and line feed are taken off
        ids = self.library.encode(["\n" + w for w in new], num_threads=1)
        self.cache.update((w, array("I", i[2:]).tobytes()) for w, i in zip(new, ids))
        self.room -= needed  # a call may take more than the room; the next unknown word clears it
        return [b"".join(map(self.cache.__getitem__, w)) for w in words]


class PlainBytes(ByteBpe):
    """A byte-level BPE that reads strings of added tokens as plain text."""

    def __init__(self, path: str, cache_size: int = 20_000):
        super().__init__(path, cache_size)
        self.added, self.split = {}, None


def overlapping(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of overlapping tokens: their places on either side, by the ends of the tokens on one line."""
    a_start = np.concatenate(([0], a_end[:-1]))
    first, last = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_end, a_end, "left")
    n = last - first + 1
    a = np.repeat(np.arange(len(a_end)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Label of every token (the first side's, then the second's): the last token of the first side in its group."""
    to_b, to_a = np.searchsorted(b_end, a_end, "left"), np.searchsorted(a_end, b_end, "left")
    points = np.concatenate([np.where(b_end[to_b] == a_end, np.arange(len(a_end)), len(a_end) + to_b), to_a])
    while True:
        further = points[points]
        if np.array_equal(further, points):
            return points
        points = further


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.a, self.b = PlainBytes(a_path), Pieces(b_path)
        self.a_library = Tokenizer.from_file(a_path)
        self.a_library.encode_special_tokens = True  # their strings are plain text
        self.a_library.no_truncation()
        self.a_library.no_padding()
        top = max(self.a.bytes_of) + 1
        self.a_bytes = [self.a.bytes_of.get(i, b"") for i in range(top)]
        self.width = len(self.b.bytes_of)  # a pair of ids is the one number a * width + b
        self.a_length, self.b_length = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b.bytes_of))
        # an id as text with what follows it: the next of its side, the other side, the next group
        size = max(top, self.width)
        self.texts = np.array([f"{i}{end}" for end in ",|;" for i in range(size)], object)
        self.size, self.pairs = size, len(self.a_bytes) * self.width
        # aligned stretches: their places, and what ``align`` found for them
        self.place: dict[str, int] = {}
        self.known: dict | None = None
        self.taken, self.stretch_chars = 0, STRETCH_CHARS

    def spelled(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For either side the ids of all texts in a row and their numbers by text, 0 where a text has no tokens."""
        want = [b" " + t.encode() for t in texts]
        good, sides = np.ones(len(texts), bool), []
        for ids, spells, length in ((self.a.encode([" " + t for t in texts]), self.a_bytes, self.a_length), (self.b.encode(texts), self.b.bytes_of, self.b_length)):
            n = np.array([len(x) // 4 for x in ids], np.int64)
            flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int64)
            line = b"".join(map(spells.__getitem__, flat.tolist()))
            ends = np.concatenate(([0], np.cumsum(length[flat])))[np.cumsum(n)].tolist()
            good &= np.fromiter((line[i:j] == w for i, j, w in zip([0, *ends], ends, want)), bool, len(texts))
            sides.append((flat, n))
        return [(flat[np.repeat(good, n)], np.where(good, n, 0)) for flat, n in sides]

    def in_a_row(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """As ``spelled``, for stretches with their blanks that neither end in white space nor hold a space mark: the
        libraries encode many of them as one text, as tokens end where stretches do. Should a row of them not be
        spelled byte by byte, its stretches are encoded one by one."""
        found, chars = [], np.cumsum([0, *map(len, words)])
        cuts = np.unique(np.searchsorted(chars, np.append(np.arange(0, chars[-1], ROW_CHARS), chars[-1]))).tolist()
        for i, j in zip(cuts, cuts[1:]):
            row = words[i:j]
            line = "".join(row)
            want, sides = line.encode(), []
            ends = np.cumsum([len(w) for w in row] if len(want) == len(line) else [len(w.encode()) for w in row])
            for ids, spells, length in ((self.a_library.encode_batch_fast([line], add_special_tokens=False)[0].ids, self.a_bytes, self.a_length),
                                        (self.b.library.encode(line[1:], num_threads=1), self.b.bytes_of, self.b_length)):
                if b"".join(map(spells.__getitem__, ids)) != want:
                    break
                ids = np.array(ids, np.int64)
                upto = np.cumsum(length[ids])
                last = np.searchsorted(upto, ends)
                if not np.array_equal(upto[last], ends):
                    break
                sides.append((ids, np.diff(last + 1, prepend=0)))
            found.append(sides if len(sides) == 2 else self.spelled([w[1:] for w in row]))
        return [tuple(map(np.concatenate, zip(*(sides[k] for sides in found)))) for k in (0, 1)]

    def align(self, texts: list[str], plain: int = 0) -> dict[str, list | np.ndarray]:
        """For each text n_a, n_b, n_groups, n_links and ``groups``, as text; its different pairs and their times, flat,
        with ``starts``. The first ``plain`` texts can be encoded in a row."""
        parts = [self.in_a_row([" " + t for t in texts[:plain]])] if plain else []
        if plain < len(texts):
            parts.append(self.spelled(texts[plain:]))
        (a, n_a), (b, n_b) = [tuple(map(np.concatenate, zip(*(sides[k] for sides in parts)))) for k in (0, 1)]
        out = {"n_a": n_a, "n_b": n_b, "n_groups": np.zeros(len(texts), np.int64), "n_links": np.zeros(len(texts), np.int64),
               "groups": [""] * len(texts), "pairs": np.empty(0, np.int64), "times": np.empty(0, np.int64), "starts": np.zeros(len(texts) + 1, np.int64)}
        if not n_a.any():
            return out
        doc_a, doc_b = np.repeat(np.arange(len(texts)), n_a), np.repeat(np.arange(len(texts)), n_b)
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        label = terminals(a_end, b_end)
        last = np.unique(label)
        group = np.searchsorted(last, label)
        out["n_groups"] = np.bincount(doc_a[last], minlength=len(texts))
        at_a, at_b = overlapping(a_end, b_end)
        out["n_links"] = np.bincount(doc_a[at_a], minlength=len(texts))
        # texts in their order, in each its pairs in theirs
        found, times = np.unique(doc_a[at_a] * self.pairs + a[at_a] * self.width + b[at_b], return_counts=True)
        out["pairs"], out["times"], out["starts"] = found % self.pairs, times, np.searchsorted(found // self.pairs, np.arange(len(texts) + 1))
        # groups in order, in each the first side's tokens before the second's
        place = np.concatenate([2 * group[: len(a)], 2 * group[len(a):] + 1])
        order = np.argsort(place, kind="stable")
        place, doc = place[order], np.concatenate([doc_a, doc_b])[order]
        ends = np.append(place[1:] != place[:-1], True)
        texts_of = self.texts[np.concatenate([a, b])[order] + self.size * np.where(ends, 1 + place % 2, 0)].tolist()
        cuts = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
        for i in np.flatnonzero(n_a).tolist():
            out["groups"][i] = "".join(texts_of[cuts[i] : cuts[i + 1]])[:-1]
        return out

    def learn(self, words: set[str]) -> None:
        """Align the stretches that are not known yet; forget all others first if there is no room."""
        new = [w for w in words if w not in self.place]
        if not new:
            return
        if self.place and self.taken + sum(map(len, new)) + ENTRY * len(new) > self.stretch_chars:
            self.place, self.known, self.taken, new = {}, None, 0, list(words)
        odd = [w for w in new if w[-1].isspace() or SPACE_MARK in w] if self.b.separable else new
        plain = len(new) - len(odd)
        if odd and plain:
            apart = set(odd)
            new = [w for w in new if w not in apart] + odd
        found = self.align([w[1:] for w in new], plain)
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.taken += sum(map(len, new)) + ENTRY * len(new) + LINK_CHARS * len(found["pairs"])
        if self.known is not None:
            old = self.known
            found["starts"] = np.concatenate([old["starts"], old["starts"][-1] + found["starts"][1:]])
            found["groups"] = old["groups"] + found["groups"]
            found |= {c: np.concatenate([old[c], found[c]]) for c in (*NUMBERS, "pairs", "times")}
        self.known = found

    def documents(self, texts: list[str | None]) -> dict[str, list | np.ndarray]:
        """For each text its numbers and groups_sha256; its different pairs and their times, flat, with ``starts``."""
        words = [[] if not t else STRETCH.findall(" " + t) if self.b.separable else [" " + t] for t in texts]
        self.learn(set(chain.from_iterable(words)))
        known = self.known
        sizes = np.array([len(w) for w in words], np.int64)
        doc, at = np.repeat(np.arange(len(texts)), sizes), np.fromiter(map(self.place.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
        out = {"groups_sha256": [""] * len(texts), "pairs": np.empty(0, np.int64), "times": np.empty(0, np.int64), "starts": np.zeros(len(texts) + 1, np.int64)}
        if not len(at):
            return out | {n: np.zeros(len(texts), np.int64) for n in NUMBERS}
        # a text with a stretch that has no tokens has none
        good = (sizes > 0) & (np.bincount(doc, known["n_a"][at] == 0, len(texts)) == 0)
        cuts, keep = np.concatenate(([0], np.cumsum(sizes))), good[doc]
        for i in np.flatnonzero(good).tolist():
            joined = ";".join([known["groups"][x] for x in at[cuts[i] : cuts[i + 1]].tolist()])
            out["groups_sha256"][i] = hashlib.sha256(joined.encode()).hexdigest()
        doc, at = doc[keep], at[keep]
        out |= {n: np.bincount(doc, known[n][at], len(texts)).astype(np.int64) for n in NUMBERS}
        # each different stretch of a text once, with its times; then the pairs in it
        which, each = pd.factorize(doc * len(self.place) + at)
        again, doc, at = np.bincount(which, minlength=len(each)), each // len(self.place), each % len(self.place)
        first = known["starts"][at]
        n = known["starts"][at + 1] - first
        link = np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)
        which, each = pd.factorize(np.repeat(doc * self.pairs, n) + known["pairs"][link])
        out["times"] = np.bincount(which, known["times"][link] * np.repeat(again, n), len(each)).astype(np.int64)
        out["pairs"], out["starts"] = each % self.pairs, np.searchsorted(each // self.pairs, np.arange(len(texts) + 1))
        return out


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id``, the numbers and the digest of every row, and its different id pairs (``_pairs``, ``_times``)."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = T.StructType([rows.schema["_id"], *[T.StructField(n, T.LongType()) for n in NUMBERS], T.StructField("groups_sha256", T.StringType()),
                           T.StructField("_pairs", T.ArrayType(T.LongType())), T.StructField("_times", T.ArrayType(T.LongType()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for whole in batches:
            for batch in blocks(whole, "_text"):
                found = aligner.documents(batch.column("_text").to_pylist())
                lists = [pa.ListArray.from_arrays(pa.array(found["starts"], pa.int32()), pa.array(found[c], pa.int64())) for c in ("pairs", "times")]
                yield pa.RecordBatch.from_arrays([batch.column("_id"), *(pa.array(found[n], pa.int64()) for n in NUMBERS),
                                                  pa.array(found["groups_sha256"], pa.string()), *lists], schema.fieldNames())

    return rows.mapInArrow(work, schema)


def link_counts(rows: DataFrame, width: int) -> DataFrame:
    """``_pair``, ``_n`` (texts that hold it) and ``_best`` (no pair of the same first id has more)."""
    counts = materialize(rows.select(F.explode("_pairs").alias("_pair")).groupBy("_pair").agg(F.count(F.lit(1)).alias("_n")))
    counts = counts.withColumn("_a", F.floor(F.col("_pair") / width))
    top = counts.groupBy("_a").agg(F.max("_n").alias("_top"))
    return counts.join(top, "_a").select("_pair", "_n", (F.col("_n") == F.col("_top")).alias("_best"))


def frequent(counts: DataFrame, table_size: int) -> tuple[DataFrame, bool]:
    """The pairs held by most texts, at most ``table_size``, and whether these are all pairs.

    The least count of the table is a power of two, so that choosing it takes one row for each of 64 sizes."""
    sizes = counts.groupBy(F.floor(F.log2("_n")).cast("int").alias("_size")).agg(F.count(F.lit(1)).alias("_pairs")).collect()
    total, least = 0, None
    for r in sorted(sizes, key=lambda r: -r["_size"]):
        total += r["_pairs"]
        if total > table_size:
            break
        least = r["_size"]
    if least is None:  # no pair, or too many even of the most frequent ones
        return counts.limit(0), not sizes
    return counts.where(F.col("_n") >= (1 << least)), total <= table_size


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", table_size: int = TABLE_SIZE) -> DataFrame:
    """One row per row of ``docs``: its id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    rows = materialize(aligned(docs, a_path, b_path, id_col, text_col).withColumn("_row", F.monotonically_increasing_id()))
    width = len(Pieces(b_path).bytes_of)
    counts = materialize(link_counts(rows, width))
    table, whole = frequent(counts, table_size)
    known = table.orderBy("_pair").toArrow()  # at most table_size rows
    shared = docs.sparkSession.sparkContext.broadcast(tuple(known.column(c).to_numpy(zero_copy_only=False) for c in ("_pair", "_n", "_best")))
    kept = ["_row", "_id", *NUMBERS, "groups_sha256"]
    sums = ("n_best", "count_sum")
    schema = T.StructType([*[rows.schema[c] for c in kept], *[T.StructField(c, T.LongType()) for c in sums],
                           T.StructField("_pairs", T.ArrayType(T.LongType())), T.StructField("_times", T.ArrayType(T.LongType()))])

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for batch in batches:
            starts = np.concatenate(([0], np.cumsum(pc.list_value_length(batch.column("_pairs")).to_numpy(zero_copy_only=False))))
            pairs, times = (np.asarray(batch.column(c).flatten()) for c in ("_pairs", "_times"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(starts))
            at = np.searchsorted(pair, pairs)
            at[at == len(pair)] = 0
            hit = pair[at] == pairs if len(pair) else np.zeros(len(pairs), bool)
            found = [total(row[hit], (times * w[at])[hit] if len(pair) else times[hit], batch.num_rows) for w in (best.astype(np.int64), n)]
            left = np.concatenate(([0], np.cumsum(~hit)))[starts]
            lists = [pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(x[~hit], pa.int64())) for x in (pairs, times)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(f, pa.int64()) for f in found), *lists], schema.fieldNames())

    found = rows.mapInArrow(looked_up, schema)
    if not whole:
        found = with_rare(materialize(found), counts, sums)
    return found.select(F.col("_id").alias(id_col), *NUMBERS, *sums, "groups_sha256")


def total(row: np.ndarray, what: np.ndarray, n: int) -> np.ndarray:
    """Sums of whole numbers by row, the rows in order."""
    upto = np.concatenate(([0], np.cumsum(what)))
    return np.diff(upto[np.searchsorted(row, np.arange(n + 1))])


def with_rare(found: DataFrame, counts: DataFrame, sums: Sequence[str]) -> DataFrame:
    """``found`` with the sums over the links whose pairs the table lacks added: a pair of few texts is no hot key."""
    each = found.select("_row", F.explode(F.arrays_zip("_pairs", "_times")).alias("_x")).select("_row", F.col("_x._pairs").alias("_pair"), F.col("_x._times").alias("_t"))
    more = each.join(counts, "_pair").groupBy("_row").agg(F.sum(F.when(F.col("_best"), F.col("_t")).otherwise(0)).alias("_more_n_best"),
                                                         F.sum(F.col("_t") * F.col("_n")).alias("_more_count_sum"))
    return found.drop("_pairs", "_times").join(more, "_row", "left").withColumns(
        {c: F.col(c) + F.coalesce(F.col(f"_more_{c}"), F.lit(0)) for c in sums})

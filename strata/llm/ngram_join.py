"""Documents linked by the Jaccard similarity of their sets of word n-grams, filtered under several global token orders.

1. ``parts``: two linked sets differ in at most d tokens, a share of their
   sizes. Tokens are dealt to more than d parts by hash, so one part at least
   is equal in both. One pass gives each row the digest of its set and the
   hashes of its parts, by class of sizes; equal sets are one node. A part
   holds several tokens, so chance makes few equal ones in a corpus of any
   size; a node without an equal part in another has no link.
2. ``frequencies`` and ``prefixes``, for the nodes left: tokens (hashes of
   n-grams) that are frequent somewhere are counted by partition and added up;
   a bounded table of the most frequent ones is broadcast. An order puts rarer
   classes of tokens first, and within a class a permutation of its own
   decides. The table only shapes the orders: any order that all sets share
   gives the same links. Two sets of similarity t share, under every order,
   one of the first n - ceil(t n) + 1 tokens of each.
3. ``linked``: nodes with an equal part are in one group. Each group's nodes
   are first met by one of them, the one that shares most; that joins families
   of near copies. What is left are groups whose nodes are of several classes:
   there, pairs of different classes are joined by part and size if the
   ``sketches`` of their sets allow a link: bits that differ are tokens that
   differ. So a family whose nodes are alike but not linked makes few pairs. A group in
   which too many would meet is split by the prefix tokens of one order
   after the other, which its pairs must share as well.
4. A pair goes on only if its sketches allow a link and its prefixes meet under every order; then
   the sets of its nodes are made again from their texts and intersected.
5. Links are contracted to components; copies join theirs by their digest.

Tables that grow with the input are joined by sorting, none is broadcast: the
driver holds the bitmaps and the bounded table only.

Defined results: a null or empty text, or one without words, has no n-gram
and is linked with nothing, its component its own id; one with fewer words
than an n-gram has them as one; equal sets are linked; an id that stands for
several texts joins their components; a row without an id gets the smallest
id of its component, null if that has none; repeated rows are kept; an empty
table gives an empty result; extra columns are ignored. Tokens are 64-bit
hashes: a set's size is short by one for a collision within a text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.bag_minhash import mixed
from strata.llm.common import dealt_join, salted_join, sorted_join
from strata.llm.near_dup import blocks, label, merged
from strata.sources.checkpoint import Scratch, materialize

NGRAM = 3
PERCENT = 90  # of the union that two sets must share
ORDERS = 3
SEEDS = [np.uint64(s) for s in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xAEF17502108EF2D9)]
TABLE_SIZE = 1 << 17  # frequent tokens that the orders know
CHUNK = 1 << 21  # tokens that a partition counts at once
FROM = 8  # times in one partition from which a token is reported
REPORTED = 1 << 13  # tokens that a partition reports
FEW_SALTS = 4
PAIRS_AT_ONCE = 100_000  # pairs of one group beyond which the next order splits it
SHARE = 4096  # pairs of one node that go to one task
PART_CLASS = 1.3  # ratio of the largest sizes of a class and the next, for parts
SKETCH = 8  # 64-bit words of a set's sketch
BATCH_CONF, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", str(2 << 20)
BITMAP = 1 << 27  # bits of the broadcast table of wanted rows, at most: 16 MB
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches that Spark hands to Python workers while the sets are made hold BATCH of text, not 10,000 rows of any length:
    both sides keep a few copies of a batch outside the heap."""
    old = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, BATCH)
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, old)


def ngrams(text: str | None, n: int = NGRAM) -> np.ndarray:
    """The set of n-grams of a text, lower-cased in A-Z, as sorted hashes."""
    words = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = max(1, len(h) - n + 1)
    out = np.zeros(size, np.uint64)
    for i in range(min(n, len(h))):
        out = mixed(out ^ h[i : i + size])
    return np.unique(out)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + 1


def part_classes(percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each class of sizes its largest size, the number of parts and how many of them may be empty unseen: more
    than that many parts stay equal if the tokens differ that two linked sets of the class can differ in."""
    top = [1]
    while top[-1] < 1 << 32:
        top.append(max(top[-1] + 1, int(top[-1] * PART_CLASS)))
    tops = np.array(top, np.int64)
    differ = 2 * tops * (100 - percent) // (100 + percent)
    spare = np.where(differ < 4, 0, np.where(differ < 16, 1, 2))
    return tops, differ + 1 + spare, spare


def part_hashes(sets: list[np.ndarray], percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the parts of each set, flat, and where each set's start. A set has the parts of its own class and, if
    larger sets of the next can be linked with it, of that. Empty parts count only for sets with too many of them: if
    either of two has few, one of the equal parts is not empty."""
    tops, parts, spare = part_classes(percent)
    n = np.array([len(x) for x in sets], np.int64)
    flat = np.concatenate([np.empty(0, np.uint64), *sets])
    to_part, to_sum = mixed(flat ^ SEEDS[3]), mixed(flat ^ SEEDS[0])
    own = np.searchsorted(tops, n)
    out, of = [], []
    for step, some in ((0, n > 0), (1, n * 100 // percent > tops[own])):
        sets_at = np.flatnonzero(some)
        c, token = own[sets_at] + step, np.repeat(some, n)
        m = parts[c]
        start = np.cumsum(m) - m
        at = np.repeat(start, n[sets_at]) + (to_part[token] % np.repeat(m, n[sets_at]).astype(np.uint64)).astype(np.int64)
        sums = np.zeros(int(m.sum()), np.uint64)
        np.add.at(sums, at, to_sum[token])
        empty = np.bincount(at, minlength=len(sums)) == 0
        which = np.repeat(np.arange(len(m)), m)
        name = (np.repeat(c, m) << 40) + np.arange(len(sums)) - np.repeat(start, m)
        kept = ~empty | (np.bincount(which, empty, len(m)) > spare[c])[which]
        out.append(mixed(sums ^ mixed(name.astype(np.uint64)))[kept])
        of.append(sets_at[which[kept]])
    of = np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return np.concatenate(out)[order], np.searchsorted(of[order], np.arange(len(sets) + 1))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of SKETCH words for each set: a bit tells whether an odd number of the set's tokens have its number. Tokens of
    two sets cancel each other out, so no more bits differ than tokens do."""
    flat = np.concatenate([np.empty(0, np.uint64), *sets])
    of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    out = np.zeros(len(sets) * SKETCH, np.uint64)
    np.bitwise_xor.at(out, of * SKETCH + (flat >> np.uint64(6)).astype(np.int64) % SKETCH, np.uint64(1) << (flat & np.uint64(63)))
    return out.reshape(-1, SKETCH)


def parts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id``, ``_tag``, ``_n``, ``_key`` (digest of the set, null without words) and ``_parts`` of every row."""
    rows = tagged(docs, id_col, text_col)
    schema = T.StructType([rows.schema["_id"], rows.schema["_tag"], T.StructField("_n", T.LongType()), T.StructField("_key", T.BinaryType()),
                           T.StructField("_parts", T.ArrayType(T.LongType()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, "_text"):
                sets = [ngrams(t) for t in batch.column("_text").to_pylist()]
                keys = [hashlib.md5(x.tobytes()).digest() if len(x) else None for x in sets]
                hashes, starts = part_hashes(sets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), batch.column("_tag"), pa.array([len(x) for x in sets], pa.int64()), pa.array(keys, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(hashes.view(np.int64)))], schema.fieldNames())

    return rows.select("_id", "_tag", "_text").mapInArrow(work, schema)


def frequencies(docs: DataFrame, text_col: str, table_size: int = TABLE_SIZE, wanted: Broadcast | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens of all texts, sorted, and the class (a power of two) of their counts. With ``wanted``, a
    ``bitmap``, only of rows whose ``_tag`` it lists; the worker that makes the tokens looks it up, no second one."""

    def compact(new: np.ndarray, known: tuple) -> tuple:
        """``known`` tokens and counts with those of ``new``, which is sorted in place: few copies, a worker's memory is small."""
        new.sort()
        starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(new)), bool), new[1:] != new[:-1]]))
        tokens, counts = new[starts], np.diff(starts, append=len(new))
        if len(known[0]):
            at = np.minimum(np.searchsorted(tokens, known[0]), max(0, len(tokens) - 1))
            found = tokens[at] == known[0] if len(tokens) else np.zeros(len(known[0]), bool)
            counts[at[found]] += known[1][found]
            tokens, counts = np.concatenate([tokens, known[0][~found]]), np.concatenate([counts, known[1][~found]])
            order = np.argsort(tokens)
            tokens, counts = tokens[order], counts[order]
        if len(tokens) > CHUNK // 2:
            keep = np.argpartition(counts, -CHUNK // 4)[-CHUNK // 4 :]
            keep.sort()
            tokens, counts = tokens[keep], counts[keep]
        return tokens, counts

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, buffer, size = (np.empty(0, np.uint64), np.empty(0, np.int64)), np.empty(CHUNK, np.uint64), 0
        for whole in batches:
            for batch in blocks(kept(whole, wanted), text_col):
                for text in batch.column(0).to_pylist():
                    found = ngrams(text)
                    while len(found):
                        taken = found[: CHUNK - size]
                        buffer[size : size + len(taken)] = taken
                        found, size = found[len(taken) :], size + len(taken)
                        if size == CHUNK:
                            known, size = compact(buffer, known), 0
        tokens, counts = compact(buffer[:size], known)
        often = np.flatnonzero(counts >= FROM)
        often = often[np.argsort(-counts[often], kind="stable")[:REPORTED]]
        yield pa.RecordBatch.from_pydict({"x": pa.array(tokens[often].view(np.int64)), "n": pa.array(counts[often])})

    read = docs.select(text_col) if wanted is None else docs.select(text_col, "_tag")
    sums = materialize(read.mapInArrow(report, "x long, n long").groupBy("x").agg(F.sum("n").alias("n"))
                       .select("x", F.floor(F.log2("n")).cast("int").alias("n")))
    total, least = 0, 64
    for r in sorted(sums.groupBy("n").count().collect(), key=lambda r: -r["n"]):  # at most 64 rows
        total += r["count"]
        if total > table_size:
            break
        least = r["n"]
    table = sums.where(F.col("n") >= least).toArrow()  # at most table_size rows
    tokens, classes = table.column("x").to_numpy().view(np.uint64), table.column("n").to_numpy().astype(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], classes[order]


def ordered(tokens: np.ndarray, classes: np.ndarray, length: int, which: int) -> np.ndarray:
    """The first ``length`` tokens of a set under one order: by class of frequency, then by a permutation."""
    rank = (classes << np.uint64(58)) | (mixed(tokens ^ SEEDS[which]) >> np.uint64(6))
    return tokens[np.argsort(rank, kind="stable")[:length]]


def tagged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id``, ``_text`` and ``_tag``, a hash of both that names the rows of one id and text."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return rows.withColumn("_tag", F.xxhash64("_id", "_text"))


def prefixes(docs: DataFrame, id_col: str, text_col: str, frequent: tuple[np.ndarray, np.ndarray], orders: int = ORDERS, wanted: Broadcast | None = None) -> DataFrame:
    """``_id``, ``_tag``, ``_n``, ``_key`` (digest of the set, null without words), ``_sketch`` and the prefixes ``_p0``, ``_p1``, ... of every row,
    with ``wanted`` of the rows that this ``bitmap`` lists."""
    rows = tagged(docs, id_col, text_col)
    names = [f"_p{k}" for k in range(orders)]
    schema = T.StructType([rows.schema["_id"], rows.schema["_tag"], T.StructField("_n", T.LongType()), T.StructField("_key", T.BinaryType()),
                           T.StructField("_sketch", T.ArrayType(T.LongType())), *[T.StructField(n, T.ArrayType(T.LongType())) for n in names]])
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, levels = shared.value
        for whole in batches:
            for batch in blocks(kept(whole, wanted), "_text"):
                sets = [ngrams(t) for t in batch.column("_text").to_pylist()]
                flat = np.concatenate(sets)
                at = np.searchsorted(hot, flat)
                at[at == len(hot)] = 0
                classes = np.where(hot[at] == flat, levels[at], 0).astype(np.uint64) if len(hot) else np.zeros(len(flat), np.uint64)
                ends = np.cumsum([len(x) for x in sets]).tolist()
                found: dict[str, list] = {n: [] for n in names}
                for x, end in zip(sets, ends):
                    for k, name in enumerate(names):
                        found[name].append(ordered(x, classes[end - len(x) : end], prefix_length(len(x)), k).view(np.int64) if len(x) else None)
                keys = [hashlib.md5(x.tobytes()).digest() if len(x) else None for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), batch.column("_tag"), pa.array([len(x) for x in sets], pa.int64()), pa.array(keys, pa.binary()),
                     pa.array(list(sketches(sets).view(np.int64)), pa.list_(pa.int64())), *(pa.array(found[n], pa.list_(pa.int64())) for n in names)], schema.fieldNames())

    return rows.select("_id", "_tag", "_text").mapInArrow(work, schema)


def bitmap(tags: DataFrame) -> Broadcast:
    """A broadcast bitmap of the ``_tag`` of ``tags``, of at least eight bits for each, BITMAP bits at most."""
    n = min(BITMAP, 1 << max(6, (8 * tags.count() - 1).bit_length()))
    bit = F.pmod("_tag", F.lit(n))
    words = tags.select(F.floor(bit / 64).cast("long").alias("_word"), F.expr(f"shiftleft(1L, cast(pmod(_tag, {n}) % 64 as int))").alias("_bit"))
    found = words.groupBy("_word").agg(F.bit_or("_bit").alias("_bits")).toArrow()  # at most n / 64 rows
    bits = np.zeros(n // 64, np.int64)
    bits[found.column("_word").to_numpy()] = found.column("_bits").to_numpy()
    return tags.sparkSession.sparkContext.broadcast(bits.view(np.uint64))


def among(tags: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether each tag may be one of those that a ``bitmap`` was made of."""
    at = tags % (64 * len(bits))
    return bits[at // 64] >> (at % 64).astype(np.uint64) & np.uint64(1) == 1


def kept(batch: pa.RecordBatch, wanted: Broadcast | None) -> pa.RecordBatch:
    """The rows of a batch whose ``_tag`` may be listed in ``wanted``, a ``bitmap``; all without one."""
    return batch if wanted is None else batch.filter(pa.array(among(batch.column("_tag").to_numpy(), wanted.value)))


def listed(tags: DataFrame) -> Column:
    """Whether ``_tag`` may be among ``tags``, for rows that no Python worker reads in the same task."""
    shared = bitmap(tags)

    @F.pandas_udf("boolean")
    def marked(tag: pd.Series) -> pd.Series:
        return pd.Series(among(tag.to_numpy(), shared.value))

    return marked("_tag")


def token_sets(docs: DataFrame, tags: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_node`` and ``_set`` of the rows with these (stored) tags (``_tag``, ``_node``, ``_key``); each set once. The
    bitmap keeps other texts from being shuffled."""
    rows = sorted_join(tagged(docs, id_col, text_col).where(listed(tags)), tags, "_tag")
    rows = rows.groupBy("_tag", "_node", "_key").agg(F.first("_text").alias("_text")).select("_node", "_key", "_text")  # repeated rows once

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, "_text"):
                sets = [ngrams(t) for t in batch.column("_text").to_pylist()]
                same = [hashlib.md5(x.tobytes()).digest() == k for x, k in zip(sets, batch.column("_key").to_pylist())]
                yield pa.RecordBatch.from_arrays([batch.column("_node").filter(pa.array(same)), pa.array([x.view(np.int64) for x, kept in zip(sets, same) if kept], pa.list_(pa.int64()))],
                                                 ["_node", "_set"])

    return rows.mapInArrow(work, "_node long, _set array<long>")


def similar_sizes(a: Column, b: Column) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def may_link(left: Column, right: Column, sizes: Column) -> Column:
    """Whether sets of these sketches, with ``sizes`` tokens together, can be linked: linked ones differ in few enough tokens."""
    differ = sum((F.bit_count(left[i].bitwiseXOR(right[i])) for i in range(SKETCH)), F.lit(0))
    return differ * (100 + PERCENT) <= sizes * (100 - PERCENT)


def beside(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """``pairs`` (``a``, ``b``) with the columns of their nodes' rows in ``left`` and ``right`` (by ``_node``). The pairs of
    a node that has more than SHARE are dealt to several tasks; only such a node's row is sent more than once."""
    for on, rows in (("b", right), ("a", left)):
        many = materialize(pairs.groupBy(on).agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("_tasks")).where("_tasks > 1"))
        rows, keys = rows.withColumnRenamed("_node", on), [on]
        if many.take(1):
            keys = [on, f"_salt_{on}"]
            tasks = F.coalesce("_tasks", F.lit(1))
            pairs = pairs.join(many, on, "left").withColumn(keys[1], F.pmod(F.xxhash64("a", "b"), tasks).cast("int")).drop("_tasks")
            rows = rows.join(many, on, "left").withColumn(keys[1], F.explode(F.sequence(F.lit(0), tasks - 1))).drop("_tasks")
        if on == "b":
            to_right, rows_right = keys, rows
    return sorted_join(sorted_join(pairs, rows_right, to_right), rows, keys)


def meeting(pairs: DataFrame, nodes: DataFrame, orders: int = ORDERS) -> DataFrame:
    """The pairs (``a``, ``b``) whose sketches allow a link and whose prefixes share a token under every order."""
    others = [f"_p{k}" for k in range(orders)]
    side = lambda s: nodes.select("_node", *[F.col(p).alias(s + p) for p in ("_n", "_sketch", *others)])
    both = beside(pairs, side("a"), side("b"))
    both = both.where(may_link(F.col("a_sketch"), F.col("b_sketch"), F.col("a_n") + F.col("b_n")))
    for p in others:
        both = both.where(F.arrays_overlap(f"a{p}", f"b{p}"))
    return both.select("a", "b")


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pairs (stored) whose sets share PERCENT of their union, stored; sets are made for their nodes only."""
    scratch = Scratch(docs.sparkSession)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("_node")).distinct()
    tags = scratch.store(sorted_join(nodes.select("_node", "_tag", "_key"), wanted, "_node", "left_semi"))
    sets = scratch.store(token_sets(docs, tags, id_col, text_col))
    both = beside(pairs, sets.withColumnRenamed("_set", "_left"), sets.withColumnRenamed("_set", "_right"))
    common = F.size(F.array_intersect("_left", "_right"))
    links = materialize(both.where(common * 100 >= (F.size("_left") + F.size("_right") - common) * PERCENT).select("a", "b"))
    scratch.drop()
    return links


def by_token(nodes: DataFrame, prefix: str) -> DataFrame:
    """``_x`` (a prefix token or part of several nodes), ``_node``, ``_n`` and ``_at``, its place in the set's order."""
    each = nodes.select("_node", "_n", F.posexplode(prefix).alias("_at", "_x"))
    several = each.groupBy("_x").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1").select("_x")
    return salted_join(each, several, ["_x"], F.col("_node"), "left_semi", FEW_SALTS, grows=True)


def size_class(n: Column) -> Column:
    """Sizes in classes about 10 % wide, each small size a class of its own."""
    return F.when(n < 10, n).otherwise(F.floor(F.log(n / F.lit(10.0)) / F.lit(float(np.log(1.1)))) + 10).cast("int")


def reach(rows: DataFrame) -> DataFrame:
    """Rows (``_n``, ``_at``) with their ``_class`` and the classes of sizes (``_from``, ``_to``) that can reach the similarity with what
    lies from ``_at`` on: of sizes n and s, PERCENT / (100 + PERCENT) of n + s must be shared, and no more than n - _at can be."""
    n, left = F.col("_n"), F.col("_n") - F.col("_at")
    low = F.ceil(n * PERCENT / 100)
    high = F.least(F.floor(n * 100 / PERCENT), F.floor(left * (100 + PERCENT) / PERCENT) - n)
    return rows.where(low <= high).withColumns({"_class": size_class(n), "_from": size_class(low), "_to": size_class(high)})


def can_meet(rows: DataFrame) -> DataFrame:
    """Rows (``_n``, ``_at``) once for each class of sizes (``_other``) in their ``reach``."""
    return reach(rows).withColumn("_other", F.explode(F.sequence("_from", "_to"))).drop("_from", "_to")


def across(groups: DataFrame, nodes: DataFrame, on: list[str], order: int, orders: int) -> DataFrame:
    """``a``, ``b``: pairs of nodes with different labels that are in one group (``on``), sizes and sketches matched.

    ``groups``: rows with ``_node``, ``_n``, ``_label``, ``_class``, ``_other`` and the columns ``on``."""
    keys = [*on, "_low", "_high"]
    rows = materialize(groups.select("_node", "_n", "_label", "_class", *on, F.least("_class", "_other").alias("_low"), F.greatest("_class", "_other").alias("_high")))
    is_low, is_high = F.col("_class") == F.col("_low"), F.col("_class") == F.col("_high")
    size = rows.groupBy(*keys).agg(F.count(F.when(is_low, 1)).alias("_lows"), F.count(F.when(is_high, 1)).alias("_highs"),
                                   F.min("_label").alias("_first"), F.max("_label").alias("_last"))
    size = materialize(size.where("_lows > 0 and _highs > 0 and _first < _last").select(*keys, (F.col("_lows") * F.col("_highs")).alias("_pairs")))
    if order + 1 < orders:
        many, few = size.where(F.col("_pairs") > PAIRS_AT_ONCE), size.where(F.col("_pairs") <= PAIRS_AT_ONCE)
    else:
        many, few = size.limit(0), size
    kept = salted_join(rows, few.select(*keys), keys, F.col("_node"), "left_semi", FEW_SALTS, grows=True)
    kept = sorted_join(kept, nodes.select("_node", "_sketch"), "_node")
    one = kept.where(is_low).select(*keys, F.col("_node").alias("_one"), F.col("_n").alias("_n1"), F.col("_label").alias("_l1"), F.col("_sketch").alias("_s1"))
    two = kept.where(is_high).select(*keys, F.col("_node").alias("_two"), F.col("_n").alias("_n2"), F.col("_label").alias("_l2"), F.col("_sketch").alias("_s2"))
    met = sorted_join(one, two, keys).where((F.col("_l1") != F.col("_l2")) & similar_sizes(F.col("_n1"), F.col("_n2"))
                                    & ((F.col("_low") < F.col("_high")) | (F.col("_one") < F.col("_two")))
                                    & may_link(F.col("_s1"), F.col("_s2"), F.col("_n1") + F.col("_n2")))
    pairs = met.select(F.least("_one", "_two").alias("a"), F.greatest("_one", "_two").alias("b"))
    if order + 1 < orders and many.take(1):
        hot = salted_join(rows, many.select(*keys), keys, F.col("_node"), "left_semi", FEW_SALTS)
        tokens = sorted_join(hot, nodes.select("_node", f"_p{order + 1}"), "_node")
        tokens = tokens.select(*hot.columns, F.posexplode(f"_p{order + 1}").alias("_at", f"_x{order + 1}"))
        finer = reach(tokens).withColumn("_other", F.when(F.col("_class") == F.col("_low"), F.col("_high")).otherwise(F.col("_low")))
        finer = finer.where(F.col("_other").between(F.col("_from"), F.col("_to"))).drop("_low", "_high", "_from", "_to")
        pairs = pairs.union(across(finer, nodes, [*on, f"_x{order + 1}"], order + 1, orders))
    return pairs


def with_prefixes(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, orders: int) -> DataFrame:
    """The (stored) nodes with their sketches and prefixes, made from the texts of their rows only."""
    rows, wanted = tagged(docs, id_col, text_col), bitmap(nodes)
    wide = prefixes(docs, id_col, text_col, frequencies(rows, "_text", wanted=wanted), orders, wanted)
    names = ["_sketch", *[f"_p{k}" for k in range(orders)]]
    found = sorted_join(nodes, wide.select("_tag", "_key", *names), ["_tag", "_key"])
    return found.groupBy("_node", "_tag", "_key", "_n").agg(*[F.first(p).alias(p) for p in names])  # repeated rows once


def linked(docs: DataFrame, nodes: DataFrame, same: DataFrame, id_col: str, text_col: str, orders: int = ORDERS) -> DataFrame:
    """Labels of the nodes that have a link; ``same`` holds links known before."""
    tokens = materialize(by_token(nodes, "_parts").withColumn("_at", F.lit(0)))
    if not tokens.take(1):
        return merged(None, same)
    some = materialize(sorted_join(nodes.select("_node", "_tag", "_key", "_n"), tokens.select("_node").distinct(), "_node", "left_semi"))
    nodes = materialize(with_prefixes(docs, some, id_col, text_col, orders))
    company = tokens.groupBy("_node").agg(F.count(F.lit(1)).alias("_shared"))
    ranked = sorted_join(tokens, company, "_node")
    first = ranked.groupBy("_x").agg(F.max(F.struct("_shared", "_n", "_node")).alias("_first")).select("_x", "_first")
    others = salted_join(tokens, first, ["_x"], F.col("_node"), "inner", FEW_SALTS, grows=True).where("_node <> _first._node")
    others = others.where(similar_sizes(F.col("_n"), F.col("_first._n")))
    pairs = materialize(others.select(F.col("_first._node").alias("a"), F.col("_node").alias("b")).distinct())
    links = verified(materialize(meeting(pairs, nodes, orders)), docs, nodes, id_col, text_col)
    labels = merged(None, links.union(same))
    # groups that are of one class by now have no link to add
    rows = label(labels, tokens, "_node", "_label")
    mixed_groups = rows.groupBy("_x").agg(F.min("_label").alias("_low"), F.max("_label").alias("_high")).where("_low < _high").select("_x")
    left = materialize(salted_join(rows, mixed_groups, ["_x"], F.col("_node"), "left_semi", FEW_SALTS, grows=True))
    if not left.take(1):
        return labels
    pairs = materialize(across(can_meet(left), nodes, ["_x"], -1, orders).distinct())
    return merged(labels, verified(materialize(meeting(pairs, nodes, orders)), docs, nodes, id_col, text_col))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", orders: int = ORDERS) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles`` and ``component_id``. All that Python workers do is stored here."""
    with small_batches(docs.sparkSession):
        return classified(docs, id_col, text_col, orders)


def classified(docs: DataFrame, id_col: str, text_col: str, orders: int) -> DataFrame:
    scratch = Scratch(docs.sparkSession)
    wide = scratch.store(parts(docs, id_col, text_col))
    rows = materialize(wide.select("_id", "_n", "_key"))
    # a set is a node; its number is given once, as the nodes are stored
    nodes = wide.where(F.col("_key").isNotNull()).groupBy("_key").agg(
        F.min("_id").alias("_first"), F.min("_tag").alias("_tag"), F.first("_n").alias("_n"), F.first("_parts").alias("_parts"))
    nodes = materialize(nodes.withColumn("_node", F.monotonically_increasing_id()))
    scratch.drop()
    full = rows.where(F.col("_key").isNotNull())
    # an id that stands for several sets joins them
    several = full.where(F.col("_id").isNotNull()).groupBy("_id").agg(F.min("_key").alias("_one"), F.max("_key").alias("_last")).where("_one < _last").select("_id", "_one")
    same = salted_join(full.select("_id", "_key"), several, ["_id"], F.col("_key"), "inner", FEW_SALTS, grows=True).where("_key <> _one").select("_one", "_key").distinct()
    number = lambda key, name: nodes.select(F.col("_key").alias(key), F.col("_node").alias(name))
    same = materialize(sorted_join(sorted_join(same, number("_one", "a"), "_one"), number("_key", "b"), "_key").select("a", "b"))
    labels = linked(docs, nodes, same, id_col, text_col, orders)
    named = materialize(label(labels, nodes.select("_node", "_key", "_first"), "_node", "_label"))
    smallest = named.groupBy("_label").agg(F.min("_first").alias("component_id"))
    named = salted_join(named, smallest, ["_label"], F.col("_node"), salts=FEW_SALTS, grows=True).select("_key", "component_id")
    out = dealt_join(rows, named, ["_key"], F.struct("_id", "_n"))
    return out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"),
                      F.when(F.col("_key").isNull(), F.col("_id")).otherwise(F.col("component_id")).alias("component_id"))

"""Near-duplicate documents: classes of texts linked by a weighted Jaccard similarity of five-word runs.

1. ``signed``: one pass over the texts gives each row the MD5 of its text and
   the band hashes of its BagMinHash signature.
2. Rows of one text are one node, numbered as the nodes are stored; copies
   join their node's class through the text's MD5 and are never paired.
3. ``linked``: nodes that share a band hash are in one bucket. First each
   node is compared with one pivot of each of its buckets, the node that has
   most company in all of its buckets (of a family of copies, the original or
   one like it); that joins most buckets to one class. What is left are buckets whose
   other nodes are of several classes. Those nodes are compared across classes if they
   share one of their rarest shingles: of two sets of similarity t, the
   n - ceil(t n) + 1 rarest elements of each have one in common. So every link
   between nodes that share a band is found, or joins what is one class
   already, and no group is ever paired off.
4. A candidate pair counts if the multisets' overlap, counted on the shingles
   themselves, reaches the threshold.
5. ``merged`` keeps a class label for each node by contracting links.

With 125 components in bands of five, a pair of similarity 0.8 shares no band
with a probability of 5e-5, one of 0.9 with 1e-10.

Defined results: a null or empty text, or one without words, equals texts
with the same characters only; a text of one to four words is one shingle;
an id that stands for several texts makes them one class, but ``keep_one``
keeps a row for each class of texts that are alike; a row with a null id gets
the smallest id of its class, null if that has none; of repeated rows one is
kept; an empty table gives an empty result; extra columns, however they are
named, are ignored by ``classes`` and left as they are by ``keep_one``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import bag_minhash
from strata.llm.common import FEW_ROWS, SALTS, salted_join, sorted_join
from strata.sources.checkpoint import materialize

THRESHOLD = 0.8
BAND_ROWS = 5
FEW_SALTS = 4  # buckets are many and mostly tiny; a large one is dealt to so many tasks
BLOCK = 2_000_000  # characters of the texts that are signed together


def blocks(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about BLOCK bytes of text each."""
    size, start = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        size += n or 0
        if size >= BLOCK:
            yield batch.slice(start, i + 1 - start)
            size, start = 0, i + 1
    if start < batch.num_rows:
        yield batch.slice(start)


def signed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id``, ``_key`` (MD5 of the text) and ``_bands`` (null without words) of every row."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = T.StructType([rows.schema["_id"], T.StructField("_key", T.BinaryType()), T.StructField("_bands", T.ArrayType(T.LongType()))])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, "_text"):
                texts = batch.column("_text").to_pylist()
                bags = [np.unique(bag_minhash.shingles(t), return_counts=True) for t in texts]
                full = [i for i, b in enumerate(bags) if len(b[0])]
                found: list = [None] * len(texts)
                if full:
                    hashes = bag_minhash.bands(bag_minhash.signatures([bags[i] for i in full]), BAND_ROWS).view(np.int64)
                    for i, h in zip(full, hashes):
                        found[i] = h
                keys = [hashlib.md5(t.encode("utf-8", "replace")).digest() for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64()))], ["_id", "_key", "_bands"])

    return rows.mapInArrow(sign, schema)


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a``, ``b`` and ``sim``: overlap over union of the numbered shingles of each pair, from ``sets`` (``_node``, ``_set``)."""
    # pairs are narrow: where one node has many, adaptive execution splits them, and no set is sent twice
    left = pairs.join(sets.select(F.col("_node").alias("a"), F.col("_set").alias("_left")), "a")
    both = left.join(sets.select(F.col("_node").alias("b"), F.col("_set").alias("_right")), "b")
    common = F.size(F.array_intersect("_left", "_right"))
    return both.select("a", "b", (common / (F.size("_left") + F.size("_right") - common)).alias("sim"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_doc`` (the whole row), ``_text``, its MD5 ``_key`` and ``_tag``, a hash of id and key."""
    rows = docs.select(F.struct("*").alias("_doc"), F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return rows.withColumn("_key", F.unhex(F.md5("_text"))).withColumn("_tag", F.xxhash64("_id", "_key"))


def shingle_sets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_node`` and ``_set``, the numbered shingles, of the rows whose tag and text are a node's (``_node``, ``_tag``, ``_key``)."""
    rows = keyed(docs, id_col, text_col).select("_tag", "_key", "_text").join(nodes, ["_tag", "_key"]).select("_node", "_text")
    schema = T.StructType([rows.schema["_node"], T.StructField("_set", T.ArrayType(T.LongType()))])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in blocks(whole, "_text"):
                found = [bag_minhash.numbered(bag_minhash.shingles(t)).view(np.int64) for t in batch.column("_text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("_node"), pa.array(found, pa.list_(pa.int64()))], ["_node", "_set"])

    return rows.mapInArrow(sets, schema)


def label(labels: DataFrame | None, rows: DataFrame, node: str, out: str) -> DataFrame:
    """``rows`` with the class label of ``node``, which is the node itself while it has no link."""
    if labels is None:
        return rows.withColumn(out, F.col(node))
    named = sorted_join(rows, labels.select(F.col("_node").alias(node), F.col("_label").alias(out)), node, "left")
    return named.withColumn(out, F.coalesce(out, node))


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (``_node``, ``_label``: the smallest node of its class) after links (``a``, ``b``) are added.

    A round lets every label take the smallest label that it is linked to, follows that label's own
    choice, and contracts the links; each round at least halves what is left of a class. What a round joins has a row for
    each end of a link at most, once for each salt: it may be broadcast if that is few."""
    edges = label(labels, label(labels, links, "a", "_a"), "b", "_b").select(F.col("_a").alias("a"), F.col("_b").alias("b")).where("a <> b").distinct()
    found = None
    while True:
        edges = materialize(edges)
        n = edges.count()
        if not n:
            break
        grows = 2 * n * SALTS > FEW_ROWS
        both = edges.union(edges.select("b", "a"))
        chosen = materialize(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("_to")))
        nxt = chosen.select(F.col("a").alias("_to"), F.col("_to").alias("_then"))
        step = materialize(salted_join(chosen, nxt, ["_to"], F.col("a"), grows=grows).select("a", F.coalesce("_then", "_to").alias("_to")))
        if found is None:
            found = step.select(F.col("a").alias("_node"), F.col("_to").alias("_label"))
        else:
            moved = step.select(F.col("a").alias("_label"), F.col("_to").alias("_new"))
            found = materialize(salted_join(found, moved, ["_label"], F.col("_node"), grows=grows).select("_node", F.coalesce("_new", "_label").alias("_label")))
        to = lambda c: step.select(F.col("a").alias(c), F.col("_to").alias(f"_{c}"))
        edges = salted_join(salted_join(edges, to("a"), ["a"], F.col("b"), grows=grows), to("b"), ["b"], F.col("a"), grows=grows).select(
            F.col("_a").alias("a"), F.col("_b").alias("b")).where("a <> b").distinct()
    if found is None:
        return labels if labels is not None else links.select(F.col("a").alias("_node"), F.col("a").alias("_label")).limit(0)
    if labels is None:
        return found
    moved = found.select(F.col("_node").alias("_label"), F.col("_label").alias("_new"))
    old = salted_join(labels, moved, ["_label"], F.col("_node"), grows=True).select("_node", F.coalesce("_new", "_label").alias("_label"))
    return materialize(old.union(sorted_join(found, labels.select("_node"), "_node", "left_anti")))


def linked(members: DataFrame, sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Class labels of the nodes in buckets (``_bucket``, ``_node``) that have a link."""
    sizes = members.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    company = salted_join(members, sizes, ["_bucket"], F.col("_node"), "inner", FEW_SALTS).groupBy("_node").agg(F.sum("_n").alias("_n"))
    ranked = materialize(members.join(company, "_node"))
    first = ranked.groupBy("_bucket").agg(F.max(F.struct("_n", "_node")).alias("_first")).select("_bucket", F.col("_first._node").alias("_first"))
    beside = materialize(salted_join(members, first, ["_bucket"], F.col("_node"), "inner", FEW_SALTS).where("_node <> _first"))
    pairs = materialize(beside.select(F.least("_first", "_node").alias("a"), F.greatest("_first", "_node").alias("b")).distinct())
    labels = merged(None, materialize(overlaps(pairs, sets)).where(F.col("sim") >= threshold).select("a", "b"))
    # a pivot has met its whole bucket: only its other nodes may have links across classes left
    rows = materialize(label(labels, beside.select("_bucket", "_node"), "_node", "_label"))
    mixed = rows.groupBy("_bucket").agg(F.min("_label").alias("_low"), F.max("_label").alias("_high")).where("_low < _high").select("_bucket")
    left = materialize(salted_join(rows, mixed, ["_bucket"], F.col("_node"), "left_semi", FEW_SALTS).select("_node", "_label").distinct())
    if not left.take(1):
        return labels
    pairs = materialize(sharing_rare(left.join(sets, "_node"), threshold))
    return merged(labels, materialize(overlaps(pairs, sets)).where(F.col("sim") >= threshold).select("a", "b"))


def sharing_rare(rows: DataFrame, threshold: float) -> DataFrame:
    """``a`` < ``b``: pairs of nodes (``_node``, ``_label``, ``_set``) of different labels that share one of the elements
    that are, in either's set, among the rarest of all these sets, and whose sets are long enough behind it: if it is
    the first that they share, the overlap is at most 1 and what is left of the shorter. Elements of one set only are
    the rarest of all; they are counted, not joined."""
    each = rows.select("_node", "_label", F.size("_set").alias("_n"), F.explode("_set").alias("_x"))
    known = each.groupBy("_x").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1")
    shared = salted_join(each, known, ["_x"], F.col("_node"), "inner", FEW_SALTS)
    own = shared.groupBy("_node", "_label", "_n").agg(F.sort_array(F.collect_list(F.struct("_times", "_x"))).alias("_own"))
    prefix = F.col("_n") - F.ceil(F.col("_n") * threshold - 1e-9) + 1 - (F.col("_n") - F.size("_own"))
    rare = own.select("_node", "_label", "_n", F.size("_own").alias("_joined"), F.posexplode(F.slice("_own", 1, F.greatest(prefix, F.lit(0)).cast("int"))).alias("_i", "_r"))
    # elements from this one on: those of several sets, less the ones before it
    rare = materialize(rare.select("_node", "_label", "_n", (F.col("_joined") - F.col("_i")).alias("_rest"), F.col("_r._x").alias("_x")))
    mixed = rare.groupBy("_x").agg(F.min("_label").alias("_low"), F.max("_label").alias("_high")).where("_low < _high").select("_x")
    rare = materialize(salted_join(rare, mixed, ["_x"], F.col("_node"), "left_semi", FEW_SALTS))
    other = rare.select("_x", *[F.col(f"_{c}").alias(f"_other_{c}") for c in ("node", "label", "n", "rest")])
    needed = (F.col("_n") + F.col("_other_n")) * (threshold / (1 + threshold)) - 1e-9
    met = rare.join(other, "_x").where((F.col("_node") < F.col("_other_node")) & (F.col("_label") != F.col("_other_label"))
                                       & (F.least("_rest", "_other_rest") >= needed))
    return met.select(F.col("_node").alias("a"), F.col("_other_node").alias("b")).distinct()


def alike(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (``_id``, ``_key``), nodes (``_node``, ``_key``, ``_tag``, ``_first``: the smallest id) and the labels of nodes that have a link, all stored."""
    rows = materialize(signed(docs, id_col, text_col))
    # a text is a node; its number is given once, as the nodes are stored
    nodes = rows.groupBy("_key").agg(F.min("_id").alias("_first"), F.min(F.xxhash64("_id", "_key")).alias("_tag"), F.first("_bands").alias("_bands"))
    nodes = materialize(nodes.withColumn("_node", F.monotonically_increasing_id()))
    spread = nodes.where("_bands is not null").select(F.explode("_bands").alias("_bucket"), "_node").distinct()
    shared = spread.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_bucket")
    members = materialize(salted_join(spread, shared, ["_bucket"], F.col("_node"), "left_semi", FEW_SALTS))
    nodes = nodes.drop("_bands")
    wanted = nodes.join(members.select("_node").distinct(), "_node", "left_semi").select("_node", "_tag", "_key")
    sets = materialize(shingle_sets(docs, wanted, id_col, text_col).groupBy("_node").agg(F.max("_set").alias("_set")))
    return rows.select("_id", "_key"), nodes, linked(members, sets, threshold)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: its id and ``class_id``, the smallest id of its class."""
    rows, nodes, labels = alike(docs, id_col, text_col, threshold)
    # an id that stands for several texts joins them
    several = rows.where("_id is not null").groupBy("_id").agg(F.min("_key").alias("_one"), F.max("_key").alias("_last")).where("_one < _last").select("_id", "_one")
    same = salted_join(rows, several, ["_id"], F.col("_key"), "inner", FEW_SALTS).where("_key <> _one").select("_one", "_key").distinct()
    number = lambda key, name: nodes.select(F.col("_key").alias(key), F.col("_node").alias(name))
    labels = merged(labels, same.join(number("_one", "a"), "_one").join(number("_key", "b"), "_key").select("a", "b"))
    named = materialize(label(labels, nodes, "_node", "_label").select("_key", "_node", "_label", "_first"))
    smallest = named.groupBy("_label").agg(F.min("_first").alias("class_id"))
    named = salted_join(named, smallest, ["_label"], F.col("_node"), salts=FEW_SALTS).select("_key", "class_id")
    return salted_join(rows, named, ["_key"], F.col("_id")).select(F.col("_id").alias(id_col), "class_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class of texts that are alike: that of the smallest id, rows without an id last."""
    rows, nodes, labels = alike(docs, id_col, text_col, threshold)
    named = label(labels, nodes, "_node", "_label")
    best = F.min(F.struct(F.col("_first").isNull(), "_first", "_key")).alias("_best")
    kept = named.groupBy("_label").agg(best).select(F.col("_best._key").alias("_key"), F.xxhash64("_best._first", "_best._key").alias("_tag"))
    kept = materialize(kept)
    found = keyed(docs, id_col, text_col).select("_doc", "_key", "_tag").join(kept, ["_key", "_tag"], "left_semi")
    tagged = rows.select("_key", F.xxhash64("_id", "_key").alias("_tag"))
    if tagged.join(kept, ["_key", "_tag"], "left_semi").groupBy("_key", "_tag").count().where("count > 1").take(1):
        found = found.dropDuplicates(["_key", "_tag"])
    return found.select("_doc.*")

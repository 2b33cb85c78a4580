"""Audit of how filters interact: what each one removes in every order in which they could be applied.

1. ``failures``: one pass over the rows gives each the set of filters that it
   fails, as a bit mask, beside its part and its labels. The copy filter needs
   the other rows: digests of texts (never the texts) are grouped, and only
   those of repeated texts are joined back.
2. Rows are counted by part and mask: at most 2**k rows for a part, whatever
   the input holds.
3. ``paths``: the subset lattice of the filters has one state for each set of
   filters applied so far, and an edge for each filter that comes next. Orders
   that reach a state are counted forwards over the edges, orders that leave
   it backwards; an edge lies on forward(state) * backward(state + filter) of
   the k! orders. The lattice depends on the filters alone.
4. ``edges``: each edge gets its removals from the counts by mask. The Shapley
   sum of a filter is the sum of the removals of its edges, weighted by their
   paths; the k steps of an order are the k edges of its path.

Defined results: a null text counts as empty (no words, no characters), so
null and empty texts are copies of each other; a row with a null id is
neither a copy nor makes others copies; rows of the same id and text are no
copies of each other; a null part is the empty string; an id with several
labels has a label if any of them has it; repeated rows count each; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import salted_join
from strata.sources.checkpoint import materialize

COPY = "E"
FEW_SALTS = 4  # digests and ids with many rows are dealt to so many tasks
SPACE = r"[\x20\x09-\x0D]+"


def text_filters(text: Column) -> dict[str, Column]:
    """Conditions under which a text fails: too few words, too few different words, too many capitals, symbols."""
    words = F.array_remove(F.split(text, SPACE), "")
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * 10,
        "D": text.rlike(r"[#$%&*|]"),
    }


def mask_of(filters: dict[str, Column]) -> Column:
    """The filters that a row fails: bit i for the i-th one."""
    bits = [F.when(failed, F.lit(1 << i)).otherwise(F.lit(0)) for i, failed in enumerate(filters.values())]
    return sum(bits[1:], bits[0])


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``_id``, ``_part`` and ``_mask`` (bits A to E) of every row."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("_part"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    filters = text_filters(F.col("_text"))
    seen = materialize(rows.select("_id", "_part", mask_of(filters).alias("_mask"), F.unhex(F.sha2("_text", 256)).alias("_key")))
    first = seen.groupBy("_key").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_key", "_first")
    both = salted_join(seen, first, ["_key"], F.struct("_id", "_mask"), salts=FEW_SALTS)
    copy = F.coalesce(F.col("_id") > F.col("_first"), F.lit(False))
    return both.select("_id", "_part", (F.col("_mask") + F.when(copy, 1 << len(filters)).otherwise(0)).alias("_mask"))


def paths(n_filters: int) -> dict[tuple[int, int], int]:
    """Of each edge (state, filter) of the subset lattice the number of orders that pass it."""
    states = range(1 << n_filters)
    forward, backward = [0] * (1 << n_filters), [0] * (1 << n_filters)
    forward[0], backward[-1] = 1, 1
    for state in states:  # a state comes after all its subsets
        for f in range(n_filters):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in reversed(states):
        backward[state] += sum(backward[state | 1 << f] for f in range(n_filters) if not state >> f & 1)
    return {(s, f): forward[s] * backward[s | 1 << f] for s in states for f in range(n_filters) if not s >> f & 1}


def counted(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id", marks: Sequence[str] = ("quality", "toxic")) -> DataFrame:
    """``_part``, ``_mask``, ``_n`` and one count for each mark: rows whose label has the mark 1."""
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(
        *[F.max(F.when(F.col(m) == 1, 1).otherwise(0)).alias(f"_{m}") for m in marks])
    rows = salted_join(failed, known, ["_id"], F.struct("_part", "_mask"), salts=FEW_SALTS)
    return rows.groupBy("_part", "_mask").agg(F.count(F.lit(1)).alias("_n"), *[F.coalesce(F.sum(f"_{m}"), F.lit(0)).alias(f"_{m}") for m in marks])


def edges(counts: DataFrame, n_filters: int, marks: Sequence[str] = ("quality", "toxic")) -> DataFrame:
    """One row per part and lattice edge (``_state``, ``_filter``): kept, removed, redundant, unique_fails, lost marks, and ``_paths``.

    Every row of counts meets every edge of the fixed lattice, k * 2**(k-1) of them, and the sums are grouped by edge."""
    lattice = fixed([(s, f, n) for (s, f), n in paths(n_filters).items()], "_state int, _filter int, _paths int")
    each = counts.withColumn("_edge", F.explode(lattice)).select("*", "_edge.*")
    bit = F.expr("shiftleft(1, _filter)")
    here, fails = F.col("_mask").bitwiseAND(F.col("_state")) == 0, F.col("_mask").bitwiseAND(bit) != 0
    total = lambda when, what="_n": F.sum(F.when(when, F.col(what)).otherwise(0))
    return each.groupBy("_part", "_state", "_filter", "_paths").agg(
        total(here & ~fails).alias("kept"), total(here & fails).alias("removed"), total(~here & fails).alias("redundant"),
        total(F.col("_mask") == bit).alias("unique_fails"), *[total(here & fails, f"_{m}").alias(f"lost_{m}") for m in marks])


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, order of the five filters and step, with what the step's filter does there."""
    names = [*text_filters(F.lit("")), COPY]
    counts = materialize(counted(failures(docs, id_col, text_col, part_col), labels, id_col))
    edge = edges(counts, len(names))
    weighted = F.sum(F.col("_paths") * F.col("removed")).over(Window.partitionBy("_part", "_filter"))
    orders = fixed([("".join(names[f] for f in order), i + 1, sum(1 << f for f in order[:i]), order[i])
                    for order in permutations(range(len(names))) for i in range(len(names))],
                   "filter_order string, step int, _state int, _filter int")
    steps = F.broadcast(docs.sparkSession.range(1).select(F.inline(orders)))  # k! * k rows, whatever the input holds
    each = edge.withColumn("shapley", weighted).join(steps, ["_state", "_filter"])
    return each.select(F.col("_part").alias("part"), "filter_order", "step", *[F.col(c).cast("long").alias(c) for c in ("kept", "removed", "redundant", "unique_fails")],
                       F.col("lost_quality").cast("long").alias("good_lost"), F.col("lost_toxic").cast("long").alias("toxic_lost"), F.col("shapley").cast("long").alias("shapley"))


def fixed(rows: Sequence[tuple], fields: str) -> Column:
    """An array of structs from values known to the driver, as one literal."""
    names = [f.split()[0] for f in fields.split(", ")]
    return F.from_json(F.lit(json.dumps([dict(zip(names, r)) for r in rows])), f"array<struct<{fields.replace(' ', ':').replace(',:', ',')}>>")

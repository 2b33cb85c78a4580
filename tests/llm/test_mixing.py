import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import mixing
from strata.llm.common import n_words
from tests.llm.fixtures import ODD_DOCS, empty_docs, odd_docs


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def water_filled(sizes, weights, share=1.0, most=3):
    """Targets by handing the excess on, source by source."""
    target = {s: 0.0 for s in sizes}
    full = set()
    rest = sum(sizes.values()) * share
    while True:
        open_ = [s for s in sizes if s not in full]
        left = rest - sum(most * sizes[s] for s in full)
        total = sum(weights[s] for s in open_)
        target = {s: most * sizes[s] if s in full else left * weights[s] / total for s in sizes}
        over = [s for s in open_ if target[s] >= most * sizes[s]]
        if not over:
            return target
        full |= set(over)
        if len(full) == len(sizes):
            return {s: float(most * sizes[s]) for s in sizes}


def test_odd_rows(spark):
    got = mixing.mix(odd_docs(spark), n_words(F.col("text")), keep=["doc_id", "text", "source", "n_chars"]).collect()
    assert len(got) == len(ODD_DOCS)
    sizes = defaultdict(int)
    for r in ODD_DOCS:
        sizes[r[3]] += words(r[1])
    names = sorted(sizes, key=lambda s: (s is None, s))
    want = water_filled(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)})
    for r in got:
        assert r["size"] == words(r["text"]) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]]) and r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(odd_docs(spark), n_words(F.col("text")), keep=["doc_id", "text", "source", "n_chars"]).collect()))


def test_budgets_are_met_and_nested(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"),
                                    F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"), (F.col("id") % 11).alias("n"))
    taken = []
    for share in (0.2, 0.5, 1.0):
        got = mixing.mix(rows, F.col("n"), keep=["doc_id", "source"], share=share).collect()
        sums, target = defaultdict(int), {}
        for r in got:
            sums[r["source"]] += r["taken"]
            target[r["source"]] = r["target"]
        assert all(abs(sums[s] - target[s]) <= 5.5 for s in target)  # half of the largest row's size
        taken.append({r["doc_id"]: r["copies"] for r in got if r["size"]})
    assert all(a <= taken[1][i] <= taken[2][i] for i, a in taken[0].items())


def test_empty(spark):
    assert mixing.mix(empty_docs(spark), n_words(F.col("text"))).collect() == []

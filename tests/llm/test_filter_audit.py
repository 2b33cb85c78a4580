import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import types as T

from strata.llm import filter_audit
from tests.llm.fixtures import ODD_DOCS, SENTENCE, empty_docs, odd_docs

MANY = " ".join(f"w{i}" for i in range(150))
ROWS = [*ODD_DOCS, (20, MANY, "en", "s", 0), (21, MANY, "en", "s", 0), (22, MANY, "de", "s", 0), (22, MANY, "de", "s", 0),
        (None, MANY, "en", "s", 0), (23, MANY.upper(), None, "s", 0), (24, MANY + " #", "", "s", 0), (25, "a b " * 80, "de", "s", 0),
        (19, MANY.upper() + " $ " + SENTENCE, "de", "s", 0), (26, "\x0b".join("é" * 3 for _ in range(99)), "fr", "s", 0)]
LABELS = [(20, 1, 0), (21, 1, 1), (21, 0, 0), (22, None, 1), (23, 1, None), (None, 1, 1), (99, 1, 1), (1, 1, 0), (25, 0, 1)]


def labels_of(spark, rows=LABELS):
    return spark.createDataFrame(rows, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())]))


def brute(rows, labels):
    """Every order applied to every row, one by one."""
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    texts, docs = defaultdict(list), []
    for i, text, *_ in rows:
        texts[text or ""].append(i)
    for i, text, lang, *_ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and any(j is not None and j < i for j in texts[t])}
        docs.append((lang or "", {k for k, v in fails.items() if v}, i in good and i is not None, i in toxic and i is not None))
    want, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        for order in permutations("ABCDE"):
            left, gone = [d for d in docs if d[0] == part], []
            for step, f in enumerate(order, 1):
                out = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[part, f] += len(out)
                want[part, "".join(order), step] = [len(left), len(out), sum(f in d[1] for d in gone), sum(d[1] == {f} for d in docs if d[0] == part),
                                                    sum(d[2] for d in out), sum(d[3] for d in out)]
                gone += out
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in want.items()}


def test_equals_every_order_applied(spark):
    got = filter_audit.audit(odd_docs(spark, ROWS), labels_of(spark)).collect()
    found = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"]) for r in got}
    assert len(found) == len(got) and found == brute(ROWS, LABELS)


def test_clashing_names_and_repeated_ids(spark):
    docs = odd_docs(spark, ROWS).withColumnRenamed("size", "_mask").withColumnRenamed("kept", "_key").withColumnRenamed("rule", "_salt").withColumnRenamed("spans", "step")
    assert filter_audit.audit(docs, labels_of(spark)).count() == 600 * len({r[2] or "" for r in ROWS})


def test_empty_tables(spark):
    assert filter_audit.audit(empty_docs(spark), labels_of(spark)).count() == 0
    got = filter_audit.audit(odd_docs(spark), labels_of(spark, [])).agg({"good_lost": "max", "toxic_lost": "max"}).first()
    assert tuple(got) == (0, 0)


@pytest.mark.parametrize("n", [1, 3, 5])
def test_paths(n):
    """Every order passes one edge of each filter; an edge's paths are the orders that pass it."""
    want = Counter((sum(1 << f for f in order[:i]), order[i]) for order in permutations(range(n)) for i in range(n))
    assert filter_audit.paths(n) == want

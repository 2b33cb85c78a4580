import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from strata.llm import common, near_dup, ngram_join
from strata.llm.queries import QUERIES
from strata.sources import checkpoint
from tests.llm.fixtures import ODD_DOCS, SENTENCE, empty_docs, odd_docs


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 3]) for i in range(len(words) - 2)} if len(words) > 2 else {tuple(words)} if words else set()


def brute(rows):
    """(n_shingles, component) of every row: all pairs compared, ids of equal value joined."""
    sets = [shingle_set(t) for _, t in rows]
    to = list(range(len(rows)))

    def root(i):
        while to[i] != i:
            i = to[i]
        return i

    by_token = {}
    for i, s in enumerate(sets):
        for x in s:
            by_token.setdefault(x, []).append(i)
    met = {(i, j) for at in by_token.values() for n, i in enumerate(at) for j in at[n + 1 :]}
    met |= {(i, j) for i in range(len(rows)) for j in range(i) if rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]}
    for i, j in met:
        shared = len(sets[i] & sets[j])
        if (rows[i][0] is not None and rows[i][0] == rows[j][0]) or 100 * shared >= 90 * len(sets[i] | sets[j]):
            to[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            r = root(i)
            least[r] = min(doc, least.get(r, doc))
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def check(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = ngram_join.components(docs, **options).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(rows)


def variants(rng, words, n, changes):
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, changes)):
            w[rng.randrange(len(w))] = f"z{rng.randrange(10_000)}"
        out.append(" ".join(w))
    return out


def corpus(seed):
    """Families whose similarities lie around the threshold, a passage that many share, short texts, edges of the threshold."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = [" ".join(word() for _ in range(rng.randint(1, 120))) for _ in range(60)]
    for size in (12, 32, 60, 150, 300):
        texts += variants(rng, [word() for _ in range(size)], 15, 1 + size // 40)
    passage = " ".join(word() for _ in range(60))
    texts += [passage + " " + " ".join(word() for _ in range(rng.randint(2, 9))) for _ in range(40)]
    texts += [passage + " " + passage.upper(), passage.upper(), "A b", "a B", "one", "", None, " \n"]
    base = [word() for _ in range(102)]  # 100 n-grams
    texts += [" ".join(base), " ".join(base[:92]), " ".join(base[:91]), " ".join(base[3:95]), " ".join(base + [word() for _ in range(11)])]
    chain = [word() for _ in range(400)]
    texts += [" ".join(chain[i : i + 200]) for i in range(0, 200, 9)]
    return texts


@pytest.mark.parametrize("seed,orders,at_once", [(1, 3, 100_000), (2, 3, 3), (3, 1, 100_000), (4, 2, 0)])
def test_equals_all_pairs(spark, monkeypatch, seed, orders, at_once):
    monkeypatch.setattr(ngram_join, "PAIRS_AT_ONCE", at_once)
    monkeypatch.setattr(ngram_join, "SHARE", 5)
    monkeypatch.setattr(ngram_join, "FROM", 2)
    texts = corpus(seed)
    ids = list(range(len(texts)))
    random.Random(seed).shuffle(ids)
    rows = list(zip(ids, texts))
    # ids of several texts, copies, rows without an id
    rows += [(rows[5][0], rows[70][1]), (rows[5][0], rows[90][1]), (None, rows[75][1]), (None, "no id has this text at all"), rows[80], rows[80], (None, None)]
    check(spark, rows, orders=orders)


def test_query_equals_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = QUERIES["op11_ngram_join"](spark, SF_SMALL).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(docs)


def test_family_of_one_template_tries_few_pairs(spark):
    """Sets that share 82 %: frequent tokens come last, and sizes that cannot reach the threshold behind them do not meet."""
    common = " ".join(f"c{i}" for i in range(90))
    rows = [(i, common + " " + " ".join(f"o{i}x{k}" for k in range(9 + i % 3))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    frequent = ngram_join.frequencies(docs, "text")
    assert len(frequent[0]) >= 88
    nodes = ngram_join.prefixes(docs, "doc_id", "text", frequent).withColumnRenamed("_key", "_node")
    tokens = ngram_join.by_token(nodes, "_p0").withColumn("_label", F.col("_node"))
    assert ngram_join.across(ngram_join.can_meet(tokens), nodes, ["_x"], 0, 3).count() < 10 * len(rows)
    got = ngram_join.components(docs)
    assert got.where("doc_id <> component_id").count() == 0


def test_no_more_bits_of_sketches_differ_than_tokens():
    rng = np.random.default_rng(6)
    sets = [np.empty(0, np.uint64), *(np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 5, 60, 700, 5000))]
    for a in sets:
        for gone, new in ((0, 0), (1, 0), (0, 1), (3, 4), (len(a) // 10, 5)):
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 63, new).astype(np.uint64)]))
            left, empty, right = ngram_join.sketches([a, sets[0], b])
            differ = int(np.bitwise_count(left ^ right).sum())
            tokens = len(np.setxor1d(a, b))
            assert not empty.any() and differ <= tokens and (tokens > 20 or differ > tokens // 2 - 1)


def test_family_that_is_alike_but_not_linked_makes_few_pairs(spark, monkeypatch):
    """Edits of one text, each linked with it or nearly so: members that are not linked do not meet one by one."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 400):
        words = list(base)
        for place in rng.sample(range(2, 148), 2 if i % 4 == 0 else 4):
            words[place] = f"e{i}x{place}"
        rows.append((i, " ".join(words)))
    compared, verified = [], ngram_join.verified

    def counted(pairs, *args):
        compared.append(pairs.count())
        return verified(pairs, *args)

    monkeypatch.setattr(ngram_join, "verified", counted)
    check(spark, rows)
    assert len(compared) == 2 and sum(compared) < 4 * len(rows)


def test_linked_sets_have_an_equal_part():
    rng = np.random.default_rng(5)
    for n in [*range(1, 60), 100, 333, 2000]:
        for _ in range(20 if n < 100 else 5):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            gone = rng.integers(0, len(a) // 10 + 1)
            new = rng.integers(0, 100 * (len(a) - gone) // 90 - len(a) + 1) if 100 * (len(a) - gone) >= 90 * len(a) else 0
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 63, new).astype(np.uint64)]))
            if 100 * (len(a) - gone) < 90 * (len(a) + new):
                continue
            hashes, starts = ngram_join.part_hashes([a, np.empty(0, np.uint64), b])
            assert starts[1] == starts[2] and set(hashes[: starts[1]].tolist()) & set(hashes[starts[2] :].tolist()), (n, gone, new)


def test_shared_shingles_alone_are_no_company(spark):
    """Texts that share many shingles by chance, as those of a large corpus do, have no equal part."""
    rng = random.Random(8)
    lines = [" ".join(f"l{i}x{k}" for k in range(6)) for i in range(40)]
    rows = [(i, " ".join(rng.sample(lines, 10))) for i in range(400)]
    nodes = ngram_join.parts(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").withColumnRenamed("_key", "_node")
    assert ngram_join.by_token(nodes, "_parts").select("_node").distinct().count() < len(rows) // 4


def test_a_task_has_one_worker_and_small_batches(spark, monkeypatch):
    """An executor's memory holds one Python worker for each task that makes tokens, and batches by their bytes."""
    seen, store, default = [], ngram_join.materialize, spark.conf.get(ngram_join.BATCH_CONF)

    def stored(df, name=None):
        seen.append((df._jdf.queryExecution().executedPlan().toString(), spark.conf.get(ngram_join.BATCH_CONF)))
        return store(df, name)

    monkeypatch.setattr(ngram_join, "materialize", stored)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words[:i], f"x{i}", *words[i:]])) for i in range(20)]
    assert ngram_join.components(spark.createDataFrame(rows, "doc_id long, text string")).count() == 20
    tokens = [x for x in seen if "MapInArrow" in x[0]]
    assert tokens and not [x for x in tokens if "ArrowEvalPython" in x[0]]
    assert {x[1] for x in seen} == {ngram_join.BATCH} != {default} and spark.conf.get(ngram_join.BATCH_CONF) == default


def test_no_table_that_grows_is_broadcast(spark, monkeypatch):
    """A stored table's compressed file may be far smaller than its rows: the driver is not to hold them, whatever the file's size."""
    plans, store = [], checkpoint.materialize

    def seen(df, name=None):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return store(df, name)

    for module in (checkpoint, common, ngram_join, near_dup):
        monkeypatch.setattr(module, "materialize", seen, raising=False)
    monkeypatch.setattr(near_dup, "FEW_ROWS", 0, raising=False)
    rng, base = random.Random(4), [f"b{i}" for i in range(150)]
    rows = [(0, " ".join(base)), (0, "another text"), (7, "another text")]
    for i in range(1, 80):
        words = list(base)
        for place in rng.sample(range(2, 148), 2 if i % 4 == 0 else 4):
            words[place] = f"e{i}x{place}"
        rows.append((i, " ".join(words)))
    got = ngram_join.components(spark.createDataFrame(rows, "doc_id long, text string"))
    plans.append(got._jdf.queryExecution().sparkPlan().toString())
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=str) == brute(rows)
    assert sum("SortMergeJoin" in p for p in plans) >= 20 and not [p for p in plans if "Broadcast" in p]


def test_frequent_tokens_are_counted_in_full(spark, monkeypatch):
    """Counts of tokens go on over several buffers, also within one text."""
    monkeypatch.setattr(ngram_join, "FROM", 1)
    words = " ".join(f"c{i}" for i in range(400))
    docs = spark.createDataFrame([(i, words + f" d{i} e{i}") for i in range(33)], "doc_id long, text string").coalesce(1)
    tokens, classes = ngram_join.frequencies(docs, "text")
    assert len(tokens) == 398 + 2 * 33 and sorted(classes.tolist()) == [0] * 66 + [5] * 398
    monkeypatch.setattr(ngram_join, "CHUNK", 4096)  # more than all tokens, less than all occurrences
    again = ngram_join.frequencies(docs, "text")
    assert again[0].tolist() == tokens.tolist() and again[1].tolist() == classes.tolist()


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumn("_key", F.lit("old")).withColumn("component_id", F.lit("old")).withColumn("_salt", F.lit("old"))
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.components(docs).collect()), key=str)
    assert got == brute([(r[0], r[1]) for r in ODD_DOCS])
    assert ngram_join.components(empty_docs(spark)).count() == 0
    one = odd_docs(spark, [(7, SENTENCE, "en", "s", 1)], clash=False)
    assert [tuple(r) for r in ngram_join.components(one).collect()] == [(7, 16, 7)]

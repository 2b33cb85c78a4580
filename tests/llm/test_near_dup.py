import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from strata.llm import bag_minhash, near_dup
from tests.llm.fixtures import ODD_DOCS, empty_docs, odd_docs


def runs(text):
    words = (text or "").encode().split()
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)] if words else [])


def similarity(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def forest():
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(x, y):
        x, y = sorted((find(x), find(y)))
        parent[y] = x

    return find, join


def alike(texts, threshold=0.8):
    """A class for each different text: paths of pairs of the threshold or more. Pairs are met through their rarest runs."""
    (find, join), texts = forest(), sorted(set(texts))
    bags = [Counter({(k, j): 1 for k, n in runs(t).items() for j in range(n)}) for t in texts]
    times, seen = Counter(x for b in bags for x in b), defaultdict(list)
    for i, bag in enumerate(bags):
        rare = sorted(bag, key=lambda x: (times[x], x))[: len(bag) - math.ceil(threshold * len(bag)) + 1]
        for j in {j for x in rare for j in seen[x]}:
            if similarity(bag, bags[j]) >= threshold:
                join(i, j)
        for x in rare:
            seen[x].append(i)
    return {t: find(i) for i, t in enumerate(texts)}


def brute_classes(rows, threshold=0.8):
    """Smallest id of each row's class; an id joins the classes of its texts."""
    of, (find, join) = alike([t or "" for _, t in rows], threshold), forest()
    first = {}
    for i, t in rows:
        if i is not None:
            join(of[t or ""], first.setdefault(i, of[t or ""]))
    least = {}
    for i, t in rows:
        if i is not None:
            c = find(of[t or ""])
            least[c] = min(i, least.get(c, i))
    return sorted((str(i), str(least.get(find(of[t or ""])))) for i, t in rows)


def brute_kept(rows):
    of, best = alike([t or "" for _, t in rows]), {}
    for i, t in rows:
        key = (i is None, i or 0, hashlib.md5((t or "").encode()).digest(), t or "")
        best[of[t or ""]] = min(key, best.get(of[t or ""], key))
    return sorted((str(None if no_id else i), t) for no_id, i, _, t in best.values())


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "old", "old", "old") for i, t in rows], "doc_id long, text string, class_id string, _key string, _salt string")
    got = sorted((str(r["doc_id"]), str(r["class_id"])) for r in near_dup.classes(df).collect())
    assert got == brute_classes(rows)
    kept = near_dup.keep_one(df)
    assert kept.columns == df.columns and kept.where("class_id = 'old' and _key = 'old' and _salt = 'old'").count() == kept.count()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect()) == brute_kept(rows)


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.random()}"
    return " ".join(words)


def test_unbiased():
    rng = np.random.default_rng(0)
    for heaviest in (1, 3, 40):
        errors = []
        for _ in range(30):
            e = rng.integers(0, 2**63, 40).astype(np.uint64)
            a = rng.integers(0, heaviest + 1, 40)
            b = np.where(rng.random(40) < 0.6, a, rng.integers(0, heaviest + 1, 40))
            s = bag_minhash.signatures([(e[a > 0], a[a > 0]), (e[b > 0], b[b > 0])], 1000)
            errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
        assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.03


def test_overlap_of_numbered_shingles():
    rng = random.Random(1)
    for _ in range(50):
        a, b = (" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(2))
        x, y = (bag_minhash.numbered(bag_minhash.shingles(t)) for t in (a, b))
        assert len(np.intersect1d(x, y)) == sum((runs(a) & runs(b)).values()) and len(x) == sum(runs(a).values())


def test_odd_rows(spark):
    check(spark, [(r[0], r[1]) for r in ODD_DOCS])
    assert near_dup.classes(odd_docs(spark)).columns == ["doc_id", "class_id"]
    assert near_dup.classes(empty_docs(spark)).collect() == [] and near_dup.keep_one(empty_docs(spark)).collect() == []


def test_groups(spark):
    """A large family of near copies, a chain whose ends are unlike, texts that repeat, copies, and texts that share passages."""
    rng = random.Random(2)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, edited(rng, base, rng.randint(0, 4))) for i in range(10, 90)]
    chain = [f"c{i}" for i in range(100)]
    for i in range(100, 112):
        rows.append((i, " ".join(chain)))
        chain[(i * 7) % 100] = f"n{i}"
    rows += [(i, "copy of one text that is long enough to have runs") for i in range(200, 240)]
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(i, passage + " " + " ".join(f"q{i}_{j}" for j in range(rng.randint(5, 60)))) for i in range(300, 340)]
    rows += [(400, "la " * 50), (401, "la " * 45), (402, "la " * 20), (403, "la la la"), (404, "La la la")]
    rng.shuffle(rows)
    check(spark, rows)


def test_ids_of_several_texts(spark):
    """An id may stand for several unequal texts, and near copies may have no id: no text without a like is lost."""
    rng = random.Random(4)
    a, b, c = ([f"{x}{i}" for i in range(80)] for x in "abc")
    text = " ".join
    check(spark, [(5, text(a)), (5, text(b)), (6, edited(rng, a, 1)), (7, edited(rng, b, 1)), (8, text(c)), (None, edited(rng, c, 1)), (None, "x y z " * 20), (None, "x y z " * 20)])
    check(spark, [(5, text(a)), (5, text(b)), (3, text(b)), (3, text(b)), (None, edited(rng, a, 1)), (None, text(c)), (None, edited(rng, c, 1))])


def test_one_bucket_for_all(spark):
    """All nodes in one bucket: the links that its smallest node lacks are found by rare shingles."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(80)]
    rows = [(i, edited(rng, base, rng.choice([1, 2, 3, 6, 8]))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = near_dup.materialize(near_dup.signed(df, "doc_id", "text"))
    members = near_dup.materialize(nodes.select(F.lit(1).alias("_bucket"), F.col("_id").alias("_node")))
    wanted = nodes.select(F.col("_id").alias("_node"), "_key", F.xxhash64("_id", "_key").alias("_tag"))
    sets = near_dup.materialize(near_dup.shingle_sets(df, wanted, "doc_id", "text"))
    found = {r["_node"]: r["_label"] for r in near_dup.linked(members, sets).collect()}
    assert sorted((str(i), str(found.get(i, i))) for i, _ in rows) == brute_classes(rows)

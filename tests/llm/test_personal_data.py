import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from strata.llm import personal_data
from strata.sources.checkpoint import materialize
from tests.llm.fixtures import ODD_DOCS, empty_docs, odd_docs

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum((d * 2 - 9 if d > 4 else d * 2) if i % 2 else d for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base(text):
    out = {k: [] for k in PATTERNS}
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and max(map(int, m[0].split("."))) <= 255 or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits) or \
                    kind == "phone" and 8 <= len(digits) <= 15:
                out[kind].append(f"{kind}:{m.start()}:{m.end()}")
    return out


def digest(found):
    return found.select("*", F.sha2(personal_data.listed(F.col("base")), 256).alias("sha"), personal_data.listed(F.col("spans")).alias("list"))


def check(rows, n):
    assert len(rows) == n
    for r in rows:
        want = base(r["text"])
        flat = [x for k in PATTERNS for x in want[k]]
        assert [r[f"n_{k}"] for k in PATTERNS] == [len(want[k]) for k in PATTERNS], r
        assert r["sha"] == hashlib.sha256(",".join(flat).encode()).hexdigest(), r
        assert set(flat) <= set(r["list"].split(",")) | {""}


def fuzz():
    rng = random.Random(3)
    parts = ["a@b.c", "x.y@mail.example.com", "@", ".", "a", "+1", "+", "(", "12", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", " ", "-", "1.2.3.4",
             "999.1.1.1", "1.2.3", "..", "0", "\n", "é", "\U0001f600", "_d@e.f", "%", "5", "+49 30 1234567", "555-1234", 'token = "abcdef0123456789abcd"', "joe [at] mail [dot] com"]
    rows = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(800)]
    return rows + ["a" * 60_000, "1" * 60_000, "1." * 30_000, "a@" + "b." * 20_000 + "c", "1 " * 20_000, "+1" * 10_000, "a@b.c " * 500]


def test_base_spans(spark):
    rows = list(enumerate(fuzz()))
    df = materialize(spark.createDataFrame(rows, "doc_id long, text string"))
    check(digest(personal_data.find(df, keep=("doc_id", "text"), model=personal_data.Model((), {}))).collect(), len(rows))


def test_odd_rows(spark):
    check(digest(personal_data.find(odd_docs(spark), keep=("doc_id", "text"))).collect(), len(ODD_DOCS))
    assert personal_data.find(empty_docs(spark)).collect() == [] and personal_data.redact(empty_docs(spark)).collect() == []


def test_trees_add_spans(spark, model):
    """Trained on the small tables: secrets and masked forms are added, base spans and plain numbers stay as they are."""
    assert model.trees and set(model.thresholds) >= {"email", "card", "secret"}
    texts = ["a key: token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" here", "write to joe.doe [at] mail [dot] example [dot] com now",
             "the year 2020 had 366 days and 1234567 hours", "pages 100-200 and 3.14159 of 10.5", "call +1 (743) 555-3824 or 4111 1111 1111 1111"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["list"] for r in digest(personal_data.find(rows, model=model)).collect()}
    assert found[0].startswith("secret:7:") and found[1] == f"email:9:{texts[1].index(' now')}" and found[2] == found[3] == ""
    assert found[4] == "card:26:45,phone:5:22"
    clean = {r["doc_id"]: r["text"] for r in personal_data.redact(rows, model=model).collect()}
    assert clean[4] == "call [PHONE] or [CARD]" and clean[2] == texts[2] and "24be" not in clean[0]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 6000")
    return personal_data.train(materialize(personal_data.proposed(docs.select("text")).drop("text")))


def test_overlapping_candidates(spark, model):
    """Numbers beside each other have spans of their own, masked addresses of any length and both forms of
    addresses are found whole, and nothing of them stays; book numbers, times and dates do."""
    phones = " ".join(f"415-555-01{i}" for i in range(32, 36))
    found = [(f"call {phones} now", "call [PHONE] [PHONE] [PHONE] [PHONE] now"), ("pay 4111 1111 1111 1111 415-555-0133 ok", "pay [CARD] [PHONE] ok"),
             ("pay 4111111111111111 4111111111111111 ok", "pay [CARD] [CARD] ok"), ("tel 415-555-0132 2024 x", "tel [PHONE] 2024 x"), ("call (415) 555-0133 now", "call [PHONE] now"),
             ("host 2001:0db8:85a3:0000:0000:8a2e:0370:7334 and 2001:db8::1 up", "host [IP] and [IP] up"), ("server 10 . 0 . 0 . 255 down", "server [IP] down"),
             (f"write {'j' * 700} [at] {'mail.' * 60}example [dot] com now", "write [EMAIL] now"), ("card 4111.1111.1111.1111 gone", "card [CARD] gone")]
    left = ["ISBN 978-0-306-40615-7 print", "time 12:30:45 and 2020-01-02 12:30:45", "mac 00:1b:44:11:3a:b7", "1 2 3 4 5 6 7 8 9 10 11 12 13", "", "7" * 30_000, "-.( " * 5_000]
    texts = [t for t, _ in found] + left
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in personal_data.redact(df, model=model).collect()}
    assert [clean[i] for i in range(len(texts))] == [c for _, c in found] + left
    spans = {r["doc_id"]: r["list"] for r in digest(personal_data.find(df, model=model)).collect()}
    assert spans[0] == "phone:5:17,phone:18:30,phone:31:43,phone:44:56" and spans[1] == "card:4:23,phone:24:36" and spans[6] == "ip:7:23"


def test_every_run_of_groups_is_a_number(spark):
    """Against all pairs of groups: runs of 7 to 19 digits, with a check digit from 13 on."""
    rng = random.Random(8)
    parts = ["1", "22", "333", "4444", "55555", "0132", "4111", "1111", " ", " ", "-", ".", " - ", "    ", "(", "+", "x"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: {(x["start"], x["end"], x["value"], x["before"], x["after"]) for x in r["n"]} for r in
           rows.select("doc_id", personal_data.numbers(F.col("text")).alias("n")).collect()}
    octets = re.compile(r"^(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}$")
    for i, text in enumerate(texts):
        want = set()
        for chain in re.finditer(personal_data.CHAIN, text):
            groups = [(chain.start() + m.start(), chain.start() + m.end()) for m in re.finditer(r"[+(]{0,2}[0-9]+", chain[0])]
            for a, b in itertools.combinations_with_replacement(range(len(groups)), 2):
                s, e = groups[a][0], groups[b][1]
                digits = re.sub("[^0-9]", "", text[s:e])
                near = all(y[0] - x[1] <= 3 for x, y in zip(groups[a:b], groups[a + 1 : b + 1]))
                card = luhn(digits) and not (len(digits) == 13 and digits[:3] in ("978", "979"))
                if near and (7 <= len(digits) <= 12 and b - a < 7 or 13 <= len(digits) <= 19 and card) and not re.match("[A-Za-z0-9]", text[e:]) and not octets.match(text[s:e].replace(" ", "")):
                    want.add((s, e, text[s:e], text[max(0, s - 24) : s], text[e : e + 4]))
        assert got[i] == want, text


def test_heaviest_spans(spark):
    """Against all subsets of spans that do not overlap."""
    rng = random.Random(9)
    cases = [[(s, s + rng.randint(1, 9), rng.randint(1, 50) / 4) for s in (rng.randint(0, 20) for _ in range(rng.randint(0, 9)))] for _ in range(60)]
    rows = spark.createDataFrame([(i, [(e, s, "card", float(w)) for s, e, w in c]) for i, c in enumerate(cases)],
                                 "id int, spans array<struct<end:int,start:int,kind:string,weight:double>>")
    for r in rows.select("id", personal_data.heaviest(F.col("spans")).alias("best")).collect():
        weights = {}
        for s, e, w in cases[r["id"]]:
            weights[s, e] = max(w, weights.get((s, e), 0))
        free = lambda some: all(a[1] <= b[0] for a, b in zip(sorted(some), sorted(some)[1:]))
        most = max(sum(weights[x] for x in some) for n in range(len(weights) + 1) for some in itertools.combinations(weights, n) if free(some))
        best = [(x["start"], x["end"]) for x in r["best"]]
        assert free(best) and sum(weights[x] for x in best) == most


def test_long_secrets(spark, model):
    """A secret of thousands of characters is one span and leaves nothing in the text."""
    rng = random.Random(5)
    long = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_") for _ in range(n)) for n in (471, 5_000, 300_000)]
    texts = [f'a key: token = "{v}" here' for v in long] + [f"a key: api_key={'.'.join(long)} here"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["list"].split(",") for r in digest(personal_data.find(rows, model=model)).collect()}
    assert all(f"secret:7:{max(t.rfind(chr(34)), t.rfind(' here') * (chr(34) not in t))}" in found[i] for i, t in enumerate(texts))
    clean = {r["doc_id"]: r["text"] for r in personal_data.redact(rows, model=model).collect()}
    assert [re.sub('"', "", clean[i]) for i in range(4)] == ["a key: [SECRET] here"] * 4


def test_spans_that_reach_beyond_base_spans(spark):
    """A secret that holds an address is a span of its own, and redaction covers the union."""
    texts = ["x api_key=ab12@host.example.org/9f8e7d6c5b4a3f2e y", "x token=9f8e7d6c5b4a-10.0.0.255 y", "x a@b.cc y"]
    rows, model = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), personal_data.Model(((1.0, 1.0),), {k: 0.5 for k in ("secret", "email", "ip")})
    found = {r["doc_id"]: r["list"] for r in digest(personal_data.find(rows, model=model)).collect()}
    assert found == {0: "email:10:31,secret:2:48", 1: "ip:21:31,secret:2:31", 2: "email:2:8"}
    clean = {r["doc_id"]: r["text"] for r in personal_data.redact(rows, model=model).collect()}
    assert clean == {0: "x [SECRET] y", 1: "x [SECRET] y", 2: "x [EMAIL] y"}


def test_redaction(spark):
    rows = [(1, "é a@b.cc, 1.2.3.4 é", "old"), (2, None, "old"), (3, "", None), (4, "nothing", "old"), (5, "a@b.cc", "old"), (6, "9a@b.cc+49 30 1234567", "old")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = {r["doc_id"]: (r["text"], r["spans"]) for r in personal_data.redact(df, model=personal_data.Model((), {})).collect()}
    assert got == {1: ("é [EMAIL], [IP] é", "old"), 2: (None, "old"), 3: ("", None), 4: ("nothing", "old"), 5: ("[EMAIL]", "old"), 6: ("[EMAIL][PHONE]", "old")}


def test_all_examples_train(spark, monkeypatch):
    """Every example counts, however many there are; equal ones are one weighted row."""
    texts = [" ".join(f"{i}.{j}.7.{i + j}" for j in range(60)) for i in range(60)]
    found = materialize(personal_data.proposed(spark.createDataFrame([(t,) for t in texts], "text string")).drop("text"))
    each = found.select(F.explode("_candidates").alias("x")).select(F.explode(personal_data.variants(F.col("x"))).alias("e"))
    wanted = each.where(F.pmod(F.xxhash64("e.x.value", "e.x.before", "e.x.after"), F.lit(3)) != 0).count()
    seen = []

    class Seen(personal_data.GBTClassifier):
        def fit(self, rows):
            weight = F.col(self.getWeightCol()) if self.isDefined("weightCol") else F.lit(1)
            seen.append(rows.agg(F.sum(weight), F.count(F.lit(1))).first())
            return super().fit(rows)

    monkeypatch.setattr(personal_data, "GBTClassifier", Seen)
    assert personal_data.train(found).trees
    assert wanted > 15_000 and round(seen[0][0]) == wanted and seen[0][1] < wanted

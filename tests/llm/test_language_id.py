import random
import string

import numpy as np
from pyspark.sql import functions as F

from strata.llm import language_id
from tests.llm.fixtures import ODD_DOCS, empty_docs, odd_docs

SF = "/root/testdata/sf0.01"


def identified(df, suffix=None):
    return language_id.identify(df, F.col("text"), F.col("lang"), F.col("source"), F.lit(suffix).cast("string") if suffix is None else F.col(suffix))


def test_odd_rows(spark):
    rows = identified(odd_docs(spark).drop("n_chars")).collect()
    assert len(rows) == len(ODD_DOCS)
    for r in rows:
        words = bool((r["text"] or "").split())
        assert (r["language"] is not None) == words == (r["confidence"] > 0) and r["accepted"] == (r["confidence"] >= 0.7)
    assert {r["language"] for r in rows if r["doc_id"] == 7} == {"fr"}
    assert identified(empty_docs(spark)).collect() == []


def test_declared_languages_are_found_again(spark):
    rows = identified(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert sum(r["language"] == r["lang"] for r in rows) >= 0.98 * len(rows) and all(r["accepted"] for r in rows)


def test_wrong_and_missing_declarations(spark):
    """Of the documents, a tenth is declared as another language and a tenth not at all: the text decides."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars > 200").withColumn("true", F.col("lang"))
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 10 == 0, F.when(F.col("lang") == "en", "fr").otherwise("en")).when(F.col("doc_id") % 10 != 1, F.col("lang")))
    rows = identified(docs).collect()
    assert sum(r["language"] == r["true"] for r in rows) >= 0.97 * len(rows)


def test_texts_outside_of_the_languages_are_rejected(spark):
    """Beside the documents, texts of other languages, random letters, symbols and code are rejected, however they are declared."""
    rng = random.Random(4)
    letters = "".join(rng.choice(string.ascii_lowercase) for _ in range(300))
    odd = ["我们今天去公园散步，天气很好，孩子们都很高兴。", "Сегодня мы пошли гулять в парк, погода была хорошая.", letters, " ".join(letters[i : i + 6] for i in range(0, 300, 6)),
           "La ragazza che abita nella casa vicino alla chiesa ha comprato una bicicletta nuova per andare a scuola ogni mattina con gli amici.",
           "12 34 #### $$ 5% 6/7 (8) [9] {0} == != <> 3.14 2,71 -- ++ ** && || 100 200 300",
           "for i, x in enumerate(sorted(rows, key=lambda r: r['id'])): out[i] = x.get('name', None)"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    more = [(-1 - i, text, said, "src1") for i, (text, said) in enumerate((t, s) for t in odd for s in (None, "xx"))]
    rows = identified(docs.unionByName(spark.createDataFrame(more, docs.schema))).collect()
    assert [r["text"] for r in rows if r["doc_id"] < 0 and r["accepted"]] == []
    assert all(r["accepted"] and r["language"] == r["lang"] for r in rows if r["doc_id"] >= 0)


def test_unseen_trigrams_favour_no_language(spark):
    """A trigram that no language has counts alike for all, however unequal their training texts are, and less than for none."""
    rows = [("the cat and the dog", "en")] * 200 + [("le chat et le chien", "fr")] * 3 + [("我们", "other"), ("我们", None)]
    model = language_id.train_text(spark.createDataFrame(rows, "_text string, _declared string"), ("en", "fr"))
    seen = {int(b) for t, _ in rows[:-2] for b in np.concatenate(list(language_id.buckets(t)))}
    new = [b for b in range(language_id.BUCKETS) if b not in seen]
    assert np.allclose(model[new, 0], model[new, 1]) and (model[new, 2] > model[new, 0]).all()
    assert np.allclose(np.exp(model.astype(float)).sum(axis=0), 1, atol=1e-4)


def test_priors_decide_where_the_text_does_not(spark):
    """A text without trigrams of any language goes with its host; a new host with its suffix."""
    texts = {"fr": "le chat est dans la maison avec les enfants et le chien du voisin", "de": "der hund ist nicht in dem haus und die katze schläft auf der bank"}
    rows = [(i, texts[k], k, f"{k}{i % 3}.example", k) for i in range(60) for k in texts] + [(100, "%", None, "fr1.example", "fr"), (101, "%", None, "new.example", "de"), (102, "%", None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, suffix string")
    got = {r["doc_id"]: r for r in language_id.identify(df, F.col("text"), F.col("lang"), F.col("source"), F.col("suffix"), ("de", "fr")).where("doc_id >= 100").collect()}
    assert got[100]["language"] == "fr" and got[101]["language"] == "de" and got[102]["confidence"] < 0.7 and not got[102]["accepted"]


def test_pages(spark):
    html = "<!doctype html><HTML class=a lang='fr-FR'><script>var the = 1;</script><p>le &amp; chat</p>"
    df = spark.createDataFrame([(html, "https://www.a.example.fr:80/x"), (None, None)], "html string, url string")
    got = df.select(F.trim(language_id.page_text(F.col("html"))), language_id.page_language(F.col("html")), language_id.url_host(F.col("url"))).collect()
    assert got[0][0].split() == ["le", "chat"] and got[0][1] == "fr-FR" and got[0][2] == "www.a.example.fr" and got[1][0] is None

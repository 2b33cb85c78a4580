"""Language identification by Bayesian fusion of text, markup and address evidence.

1. ``train_text``: hashed byte trigrams of every text with a declared language
   are counted by language, and the single bytes of all texts; a partition
   emits its sums (languages times buckets, at most), which are added up. The
   background, "none of the languages", draws the three bytes of a trigram one
   by one. A language is its own counts mixed with a share ``UNSEEN`` of the
   background, the same for all, so a trigram that no language has speaks
   against each of them alike, however much text they were trained on. The
   model is one logarithm for each language, or the background, and bucket.
2. ``scored``: the log likelihoods of each whole text under the model.
3. ``Evidence``: from the hypotheses (languages or background) that the texts
   alone point to, grouped aggregation gives how often each declaration goes
   with each of them, and priors by level: of a host, smoothed towards those of
   its address suffix, which are smoothed towards those of the whole corpus.
4. ``identify`` adds the logarithms up and normalises them over the languages
   and the background; the language is the likeliest of the languages, and its
   confidence is low where the background wins.

A hot host or suffix costs nothing extra: counts are combined before the
shuffle, and the priors' joins are salted.

Defined results: a null text is an empty one; a row without a word gets no
language, confidence 0 and is rejected; a null declaration, host or suffix is
no evidence (the prior of the level above holds); a declaration outside the
languages counts as "other", which speaks for the background; a language
without training text has the background's share only; of equally likely
languages the first named wins; rows are kept as they are; an empty table gives an empty result; a
column of the input that is named like a new one is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import n_words, salted_join
from strata.sources.checkpoint import materialize

LANGUAGES = ("en", "fr", "de", "es")
BUCKETS = 1 << 15
FACTORS = (2533, 7989, 9541)  # of the three bytes, in the hash of a trigram
BLOCK = 1 << 20  # bytes of a text that are worked on at once
INDEPENDENT = 1 / 3  # share of the trigrams that counts as evidence: neighbours overlap in two bytes
UNSEEN = 0.15  # share of a language's trigrams that are drawn from the background
SMOOTHING = 20.0  # rows that the level above is worth
MIN_CONFIDENCE = 0.7


def text_bytes(text: str) -> np.ndarray:
    return np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8)


def buckets(text: str) -> Iterator[np.ndarray]:
    """Buckets of the byte trigrams of a text, block by block."""
    data = text_bytes(text).astype(np.int32)
    for at in range(0, len(data) - 2, BLOCK):
        b = data[at : at + BLOCK + 2]
        yield (b[:-2] * FACTORS[0] + b[1:-1] * FACTORS[1] + b[2:] * FACTORS[2]) & (BUCKETS - 1)


def background(singles: np.ndarray) -> np.ndarray:
    """Share of each bucket if the bytes of a trigram are drawn one by one, from counts of the 256 bytes."""
    share = (singles + 1) / (singles.sum() + 256)
    out = np.zeros(BUCKETS)
    out[0] = 1.0
    for factor in FACTORS:
        at, before = np.arange(256) * factor & (BUCKETS - 1), out
        out = sum(np.roll(before, a) * p for a, p in zip(at, share))
    return out


def train_text(rows: DataFrame, languages: Sequence[str] = LANGUAGES) -> np.ndarray:
    """Model of buckets times languages and background: trigrams of all rows of ``_text`` whose ``_declared`` is among
    the languages, single bytes of all rows."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(languages) + 1, BUCKETS), np.int64)  # the last ones are of single bytes
        waiting, size = [], 0  # count a block of texts at once

        def add() -> None:
            if waiting:
                sums.reshape(-1)[:] += np.bincount(np.concatenate(waiting), minlength=sums.size)
                waiting.clear()

        for batch in batches:
            for text, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[-1, :256] += np.bincount(text_bytes(text), minlength=256)
                for b in buckets(text) if k is not None else ():
                    waiting.append(b + k * BUCKETS)
                    size += len(b)
                    if size > BLOCK:
                        add()
                        size = 0
        add()
        k, b = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(b, pa.int32()), pa.array(sums[k, b])], ["k", "b", "n"])

    known = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("_declared")).cast("int") - 1
    known = F.when(known >= 0, known)
    sums = rows.select("_text", known.alias("k")).mapInArrow(counted, "k int, b int, n long").groupBy("k", "b").agg(F.sum("n").alias("n"))
    counts = np.zeros((BUCKETS, len(languages) + 1))
    for r in sums.toLocalIterator():  # at most languages times buckets rows, and 256
        counts[r["b"], r["k"]] = r["n"]
    trigrams, none = counts[:, :-1], background(counts[:256, -1])[:, None]
    model = (1 - UNSEEN) * trigrams / np.maximum(trigrams.sum(axis=0), 1) + UNSEEN * none
    return np.log(np.hstack([model, none])).astype(np.float32)


def scored(rows: DataFrame, model: np.ndarray) -> DataFrame:
    """``rows`` with ``_likelihood``: the log likelihood of ``_text`` for each language and the background, weighed for overlap."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def likelihood(texts: pd.Series) -> pd.Series:
        table = shared.value
        return pd.Series([sum((table.take(b, axis=0).sum(axis=0) for b in buckets(text)), np.zeros(table.shape[1])) * INDEPENDENT for text in texts], dtype=object)

    return rows.withColumn("_likelihood", likelihood("_text"))


def prepared(rows: DataFrame, text: Column, declared: Column, host: Column, suffix: Column, languages: Sequence[str]) -> DataFrame:
    """``rows`` with ``_text``, ``_declared`` (a language, "other" or null), ``_host`` and ``_suffix``."""
    tag = F.lower(F.regexp_extract(declared, "^[ ]*([A-Za-z]{2,3})(?![A-Za-z])", 1))
    kind = F.when(tag.isin(*languages), tag).when(F.trim(declared) != "", "other")
    blank_null = lambda c: F.when(F.trim(c) != "", F.lower(c))
    text = F.coalesce(text, F.lit(""))
    return rows.withColumns({"_text": text, "_declared": kind, "_host": blank_null(host), "_suffix": blank_null(suffix), "_words": n_words(text)})


def first_of_most(scores: Column) -> Column:
    """Place (from 1) of the largest element, the first of equal ones."""
    return F.array_position(scores, F.array_max(scores)).cast("int")


def priors(votes: DataFrame, languages: Sequence[str], smoothing: float = SMOOTHING) -> tuple[list[float], DataFrame, DataFrame, dict[str, list[float]]]:
    """From stored votes (_vote, _declared, _host, _suffix), each for a language or, the last, the background: the
    corpus's shares, the suffixes' and hosts' smoothed shares (``_suffix``/``_host`` with ``_prior``), and
    log P(declaration | language or background)."""
    votes = votes.where("_vote is not null")
    hypotheses = range(len(languages) + 1)
    each = [F.sum((F.col("_vote") == i + 1).cast("long")).alias(f"n{i}") for i in hypotheses]
    total = votes.agg(*each).first()
    whole = [((n or 0) + 1) / (sum(x or 0 for x in total) + len(hypotheses)) for n in total]
    counts = lambda: F.array(*[F.col(f"n{i}").cast("double") for i in hypotheses])
    size = F.aggregate(counts(), F.lit(0.0), lambda a, x: a + x)

    def smoothed(above: Column) -> Column:
        return F.zip_with(counts(), above, lambda n, p: (n + smoothing * p) / (size + smoothing))

    everywhere = F.array(*[F.lit(p) for p in whole])
    suffixes = materialize(votes.where("_suffix is not null").groupBy("_suffix").agg(*each).select("_suffix", smoothed(everywhere).alias("_above")))
    hosts = votes.where("_host is not null").groupBy("_host").agg(*each, F.min("_suffix").alias("_suffix"))
    hosts = salted_join(hosts, suffixes, ["_suffix"], F.col("_host"))
    hosts = materialize(hosts.select("_host", smoothed(F.coalesce("_above", everywhere)).alias("_prior")))
    kinds = [*languages, "other"]
    said = {r["_declared"]: r for r in votes.where("_declared is not null").groupBy("_declared").agg(*each).collect()}  # at most one row a kind
    of_language = [sum(r[f"n{i}"] for r in said.values()) for i in hypotheses]
    declared = {k: [float(np.log(((said[k][f"n{i}"] if k in said else 0) + 0.5) / (of_language[i] + 0.5 * len(kinds)))) for i in hypotheses] for k in kinds}
    return whole, suffixes, hosts, declared


def identify(rows: DataFrame, text: Column, declared: Column, host: Column, suffix: Column, languages: Sequence[str] = LANGUAGES,
             min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``rows`` with ``language``, ``confidence`` and ``accepted``, all levels learned from ``rows``."""
    ready = prepared(rows, text, declared, host, suffix, languages)
    model = train_text(ready, languages)
    voted = scored(ready.select("_text", "_declared", "_host", "_suffix", "_words"), model)
    vote = F.when(F.col("_words") > 0, first_of_most(F.col("_likelihood")))
    whole, suffixes, hosts, said = priors(materialize(voted.select(vote.alias("_vote"), "_declared", "_host", "_suffix")), languages)
    found = salted_join(scored(ready, model), hosts, ["_host"], F.xxhash64("_text"))
    found = salted_join(found, suffixes, ["_suffix"], F.xxhash64("_text"))
    prior = F.transform(F.coalesce("_prior", "_above", F.array(*[F.lit(p) for p in whole])), lambda p: F.log(p))
    declaration = F.array(*[F.lit(0.0) for _ in whole])
    for kind, logs in said.items():
        declaration = F.when(F.col("_declared") == kind, F.array(*[F.lit(x) for x in logs])).otherwise(declaration)
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    found = found.withColumn("_score", add(add("_likelihood", prior), declaration))
    best = F.array_max(F.slice("_score", 1, len(languages)))
    top = F.array_max("_score")
    odds = F.aggregate(F.transform("_score", lambda x: F.exp(x - top)), F.lit(0.0), lambda a, x: a + x)
    has_words = F.col("_words") > 0
    names = F.array(*[F.lit(x) for x in languages])
    out = found.withColumns({"language": F.when(has_words, F.element_at(names, first_of_most(F.slice("_score", 1, len(languages))))),
                             "confidence": F.when(has_words, F.exp(best - top) / odds).otherwise(0.0)})
    out = out.withColumn("accepted", F.col("confidence") >= min_confidence)
    return out.select(*[c for c in rows.columns if c not in ("language", "confidence", "accepted")], "language", "confidence", "accepted")


def page_text(html: Column) -> Column:
    """What a page shows: without scripts, styles, tags and entities."""
    shown = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    return F.regexp_replace(shown, r"<[^>]*+>|&#?[A-Za-z0-9]{1,10};", " ")


def page_language(html: Column) -> Column:
    """The language that the markup declares."""
    return F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"(?i)^[a-z]+://([^/?#:]+)", 1)

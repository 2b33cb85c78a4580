"""Quality rules: statistics of whole texts, and a learned decision list over them.

``with_stats`` counts words, symbols, repeated lines and words in repeated
five-word windows of each whole text, with built-in functions only. A text's
own windows never leave its row: their hashes and places are packed into
longs and sorted, neighbours of equal hash are compared as text, and the
covered places are added up.

``learn_rules`` builds an ordered list of threshold conjunctions that pick
out low quality, by sequential covering: a rule grows on two thirds of the
labelled rows by the condition of the highest information gain, is cut back
to its best prefix on the other third, and joins the list if it is precise
enough there; the rows it covers leave, and the next rule grows. Every step
is one grouped count over the stored, binned sample, of which some hundred
rows (features times bins) come to the driver.

``verdict`` emits the list as one ordered conditional expression.

Defined results: a null or empty text has no words and every count 0, and
fails the base rule; rows are kept as they are, repeated ids included; labels
that are null or name no document are left out, of several labels for one
document the lowest holds; without labels of both kinds the list is empty and
only the base rule decides; an empty table gives an empty result; a column of
the input that is named like a statistic is replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD
from strata.sources.checkpoint import materialize

WINDOW = 5
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10  # below it the base rule fails a text
MAX_REPEAT_PERCENT = 20
TRAIN_ROWS = 20_000  # labelled rows that the rules are learned on, at most
BINS = 32
MAX_RULES, MAX_CONDITIONS = 12, 3
MIN_PRECISION, MIN_COVERED = 0.95, 5

FEATURES = {  # of the statistics, as SQL
    "words": "n_words",
    "word_length": "try_divide(word_chars, n_words)",
    "symbol_share": "try_divide(n_symbols, word_chars)",
    "dup_line_share": "try_divide(n_dup_lines, n_lines)",
    "repeat_share": "try_divide(n_repeat_words, n_words)",
    "kind_share": "try_divide(n_word_kinds, n_words)",
    "capital_share": "try_divide(n_capitals, word_chars)",
    "exclamation_share": "try_divide(n_exclamations, n_words)",
}


def feature(name: str) -> Column:
    return F.coalesce(F.expr(FEATURES[name]).cast("double"), F.lit(0.0))


def bound(value: Column, fn) -> Column:
    """``fn`` of a value that is worked out once, however often ``fn`` uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def word_stats(text: Column) -> Column:
    """Struct of ``n`` words, ``chars`` in them, ``kinds`` of them, and ``repeats``: the words that stand
    in a five-word window found at least twice in the text."""

    def equal_neighbour(a: Column, k: Column, part) -> Column:
        same = lambda j: F.coalesce(part(F.get(a, j)) == part(F.get(a, k)), F.lit(False))
        return same(k - 1) | same(k + 1)

    def high(x: Column) -> Column:
        return F.shiftright(x, 32)

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")

    def covered(words: Column, windows: Column) -> Column:
        packed = F.transform(windows, lambda h, i: F.shiftleft(high(h), 32).bitwiseOR(i.cast("long")))
        likely = bound(F.sort_array(packed), lambda a: F.filter(a, lambda x, k: equal_neighbour(a, k, high)))
        texts = F.sort_array(F.transform(likely, lambda x: F.struct(F.array_join(F.slice(words, place(x) + 1, WINDOW), " ").alias("s"), place(x).alias("at"))))
        equal = bound(texts, lambda a: F.filter(a, lambda x, k: equal_neighbour(a, k, lambda v: v["s"])))
        places = F.sort_array(F.transform(equal, lambda x: x["at"]))
        steps = bound(places, lambda a: F.transform(a, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(a, k + 1) - p, F.lit(WINDOW)))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda n, x: n + x)

    def repeats(words: Column) -> Column:
        window = lambda x, i: F.xxhash64(x, *[F.get(words, i + j) for j in range(1, WINDOW)])
        windows = F.slice(F.transform(words, window), 1, F.size(words) - WINDOW + 1)
        # no hash twice, as in most texts: no window twice
        return bound(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(words, w)))

    return bound(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda words: F.struct(
        F.size(words).cast("long").alias("n"), F.length(F.array_join(words, "")).cast("long").alias("chars"),
        F.size(F.array_distinct(words)).cast("long").alias("kinds"),
        F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(repeats(words)).alias("repeats")))


def with_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_word_kinds,
    n_capitals, n_exclamations and base_failed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    left = lambda pattern: F.length(F.regexp_replace(text, pattern, "")).cast("long")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.withColumns({
        "_words": word_stats(text),
        "n_symbols": left(f"[^{SYMBOLS}]+"), "n_capitals": left("[^A-Z]+"), "n_exclamations": left("[^!]+"),
        "_lines": bound(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("kinds")))})
    counted = counted.withColumns({"n_words": F.col("_words.n"), "word_chars": F.col("_words.chars"), "n_word_kinds": F.col("_words.kinds"),
                                   "n_repeat_words": F.col("_words.repeats"),
                                   "n_lines": F.col("_lines.n").cast("long"), "n_dup_lines": (F.col("_lines.n") - F.col("_lines.kinds")).cast("long")})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.drop("_lines", "_words").withColumn("base_failed", failed)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > value, else feature <= value
    value: float

    def column(self) -> Column:
        value = feature(self.feature)
        return value > self.value if self.above else value <= self.value


def gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information gain of narrowing p0 positive and n0 negative rows to p and n."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def covers(rule: list[tuple[str, bool, int]]) -> Column:
    """Whether a row of the binned sample fulfils a rule of (feature, above, bin)."""
    out = F.lit(True)
    for feature, above, cut in rule:
        out = out & (F.col(feature) > cut if above else F.col(feature) <= cut)
    return out


def learn_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                train_rows: int = TRAIN_ROWS, min_precision: float = MIN_PRECISION) -> list[list[Condition]]:
    """The decision list, as conjunctions that mean low quality, from at most ``train_rows`` labelled
    documents (those of the lowest hash of their id); labels: 0 is low quality."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg((F.min(label_col) == 0).alias("_bad"))
    known = materialize(known.orderBy(F.xxhash64("_id"), "_id").limit(train_rows))
    # at most train_rows narrow rows, so the documents stay where they are
    # stored, so that the statistics are of the labelled texts alone
    rows = materialize(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(known), "_id"))
    stats = with_stats(rows).where(~F.col("base_failed"))
    sample = materialize(stats.select("_bad", (F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(3)) == 0).alias("_prune"),
                                      *[feature(f).alias(f) for f in FEATURES]))
    steps = [i / BINS for i in range(1, BINS)]
    at = sample.groupBy("_bad").agg(*[F.percentile_approx(f, steps, 10_000).alias(f) for f in FEATURES]).collect()
    cuts = {f: sorted({x for row in at for x in row[f] or []}) for f in FEATURES}
    binned = materialize(sample.select("_bad", "_prune", *[bin_of(F.col(f), cuts[f]).alias(f) for f in FEATURES]))
    rules: list[list[tuple[str, bool, int]]] = []
    while len(rules) < MAX_RULES:
        free = F.lit(True)
        for rule in rules:
            free = free & ~covers(rule)
        rule = grow(binned.where(free & ~F.col("_prune")))
        if not rule:
            break
        rest = binned.where(free & F.col("_prune"))
        counts = rest.agg(*[F.sum((covers(rule[:i]) & (F.col("_bad") == bad)).cast("long")) for i in range(1, len(rule) + 1) for bad in (True, False)]).first()
        best = max(range(len(rule)), key=lambda i: ((counts[2 * i] or 0) - (counts[2 * i + 1] or 0)) / max(1, (counts[2 * i] or 0) + (counts[2 * i + 1] or 0)))
        p, n = counts[2 * best] or 0, counts[2 * best + 1] or 0
        if p < MIN_COVERED or p < min_precision * (p + n):
            break
        rules.append(rule[: best + 1])
    return [[Condition(f, above, cuts[f][cut]) for f, above, cut in rule] for rule in rules]


def bin_of(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts lie below a value."""
    return F.size(F.filter(F.array(*[F.lit(x) for x in cuts]), lambda x: x < value)) if cuts else F.lit(0)


def grow(rows: DataFrame) -> list[tuple[str, bool, int]]:
    """The rule of up to MAX_CONDITIONS conditions that gains most at each step."""
    rule: list[tuple[str, bool, int]] = []
    while len(rule) < MAX_CONDITIONS:
        bins = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("bin")) for f in FEATURES]))
        counts = rows.where(covers(rule)).select("_bad", bins.alias("x")).groupBy("x.f", "x.bin").agg(
            F.sum(F.col("_bad").cast("long")).alias("p"), F.sum((~F.col("_bad")).cast("long")).alias("n")).collect()
        options = []
        for f in FEATURES:
            own = sorted((r["bin"], r["p"], r["n"]) for r in counts if r["f"] == f)
            p0, n0 = sum(x[1] for x in own), sum(x[2] for x in own)
            if not p0 or not n0:
                return rule
            p = n = 0
            for cut, dp, dn in own[:-1]:
                p, n = p + dp, n + dn
                options += [(gain(p, n, p0, n0), f, False, cut), (gain(p0 - p, n0 - n, p0, n0), f, True, cut)]
        if not options or max(options)[0] <= 1e-9:
            return rule
        rule.append(max(options)[1:])
    return rule


def verdict(rules: list[list[Condition]]) -> Column:
    """The number (from 1) of the first rule that a row fulfils, 0 if none: one ordered conditional."""
    out = F
    for i, rule in enumerate(rules):
        test = F.lit(True)
        for condition in rule:
            test = test & condition.column()
        out = out.when(test, i + 1)
    return out.otherwise(0) if rules else F.lit(0)


def judge(docs: DataFrame, rules: list[list[Condition]], text_col: str = "text") -> DataFrame:
    """``docs`` with the statistics, ``rule`` (the first that holds, 0 if none) and ``kept``."""
    judged = with_stats(docs, text_col).withColumn("rule", verdict(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))

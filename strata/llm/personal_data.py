"""Personal data in whole texts: exact base spans, and candidates that boosted trees accept.

Everything runs on built-in expressions inside a row; no span leaves its
document. ``located`` finds where a pattern matches by cutting the text at the
matches: lengths of the gaps and of the matches add up to code-point places.

* Base spans follow fixed patterns (leftmost, non-overlapping per kind) and
  checks: parts of an address up to 255, card numbers by Luhn, digits of a
  phone number. They are always part of the result.
* Generators of high recall propose further spans, which may overlap: masked
  mail addresses, spaced or colon-separated addresses, values assigned to a
  secret's name, and numbers: of a chain of digit groups, every run of groups
  that holds 7 to 12 digits in up to 7 groups (a phone number) or 13 to 19
  with the check digit of a card, so numbers beside each other have spans of their own.
* A gradient-boosted forest (Spark ML, trained on the candidates of all
  documents) scores each candidate by its format and context. Candidates
  that are base spans are positive examples, and so are variants of them in
  the formats of every generator; candidates that cut or exceed a base span,
  others without the format of their kind, and variants with broken check
  digits, address parts or borders are negative. Others that may well be
  personal data are no examples at all. The trees become conditional
  expressions over a candidate's features.
* For each kind, held-out candidates, weighted by how many the corpus has,
  give the lowest score from which on ``precision`` of them are positive.
  Candidates from there on that lie in no base span are accepted, and numbers
  only if they touch none. Of accepted numbers and addresses that overlap,
  those are added whose digits, times score, are most (interval selection).

Patterns take possessive repeats and look behind at the start of a run, so
that their time is linear in the text. Between groups of a number stand at
most three separators, and a domain name has at most 127 labels; other parts
of a candidate have no limit.

Defined results: a null or empty text has no spans; rows are kept as they
are, repeated ids included; without candidates of both classes no model is
trained and only base spans are given; an empty table gives an empty result;
a column of the input that is named like a new one is replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.checkpoint import materialize

# The kinds in the order in which spans are listed, and the base patterns.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # a whole chain of digits with single separators, of 16 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Candidates: kind, pattern.
GENERATORS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\[at\]|\(at\))\x20?[A-Za-z0-9-]++"
              r"(?:(?:\.|\x20?\[dot\]\x20?|\x20?\(dot\)\x20?)[A-Za-z0-9-]++){1,126}+"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}+(?:\x20?\.\x20?[0-9]{1,3}+){3}+(?![0-9])"),
    ("ip", r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}+::?){2,7}+[0-9A-Fa-f]{1,4}+(?![0-9A-Za-z:])"),
    ("secret", r"(?i)(?<![a-z])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?[^\s\"',;]{12,}+"),
)
CHAIN = r"(?<![A-Za-z0-9+(])[+(]{0,2}+[0-9][0-9\x20().\-]{5,}+"  # digit groups of which runs are numbers
GROUP = r"[+(]{0,2}+[0-9]++"
FEWEST, MOST, APART = 7, 19, 3  # digits of a number; separators between two of its groups, at most
PHONE_GROUPS = 7  # digit groups of a phone number, at most
PIECE = 256  # code points or matches that are counted at once
OVERLAPS = 512  # more than the candidates that end inside one number: 19 ends of 19 starts
PHONE_SHAPE = r"^(?:\+?[0-9]{1,3}[ .-])?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{4}$"
CARD_SHAPE = "^(?:[0-9]{4}[ .-]){3}[0-9]{4}$|^[0-9]{15,16}$|^[0-9]{4}[ .-][0-9]{6}[ .-][0-9]{5}$"
HINTS = r"(?i)(?:mail|phone|tel|call|fax|mobile|card|visa|credit|host|server|\bip\b|token|secret|password|key)"
SPAN = "struct<start:int,end:int,value:string>"
TREES, DEPTH, STEP = 20, 4, 0.3
PRECISION = 0.98
FEATURES = ("length", "digits", "letters", "separators", "dots", "plus", "luhn", "octets", "at", "ending", "glued_before", "glued_after",
            "hint", "digit_kinds", "mixed", "groups", "last_group", "phone_shape", "card_shape", "number_before", "number_after", "colons", "doubled", "zero",
            *(f"is_{k}" for k in KINDS))


def bound(value: Column, fn) -> Column:
    """``fn`` of a value that is worked out once, however often ``fn`` uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def located(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of the matches of a pattern, in code points. Lengths add up within pieces of
    PIECE matches and then over pieces, since a growing array is copied with each row that it takes."""
    none = F.array().cast(f"array<{SPAN}>")
    span = lambda start, end, value: F.struct(start.alias("start"), end.alias("end"), value.alias("value"))

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["value"])
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span(start, end, x["value"]))).alias("out"))

    def then(state: Column, piece: Column) -> Column:
        return F.struct((state["at"] + piece["at"]).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out"))

    def moved(piece: Column, by: Column) -> Column:
        return F.transform(piece["out"], lambda x: span(x["start"] + by, x["end"] + by, x["value"]))

    def in_pieces(pairs: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.size(pairs), F.lit(PIECE))
        return F.transform(firsts, lambda i: F.aggregate(F.slice(pairs, i, PIECE), F.struct(F.lit(0).alias("at"), none.alias("out")), add))

    def places(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        pairs = F.zip_with(gaps, found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
        starts = lambda pieces: F.aggregate(pieces, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), then, lambda s: s["out"])
        return bound(bound(pairs, in_pieces), lambda pieces: F.flatten(F.zip_with(pieces, starts(pieces), moved)))

    return bound(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) == 0, none).otherwise(places(found)))


def paged(text: Column) -> Column:
    """The text in pieces of PIECE code points, so that a place is found without counting from the start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def read(pages: Column, start: Column, length: Column | int) -> Column:
    """At most PIECE code points from ``start`` (0 is the first) on."""
    page = F.floor(start / PIECE).cast("int")
    return F.substr(F.concat_ws("", F.get(pages, page), F.get(pages, page + 1)), start % PIECE + 1, F.lit(length) if isinstance(length, int) else length)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of 12 to 19 digits passes the Luhn check."""

    def total(back: Column) -> Column:
        def add(n: Column, i: Column) -> Column:
            d = F.substr(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
            return n + F.when(d > 9, d - 9).otherwise(d)

        return F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), add)

    return F.when(F.length(digits).between(12, 19), bound(F.reverse(digits), total) % 10 == 0).otherwise(F.lit(False))


def base_spans(text: Column) -> Column:
    """Struct with the base spans of each kind."""
    checks = {"email": lambda v: F.lit(True), "ip": lambda v: v.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), "card": lambda v: luhn(digits_of(v)),
              "phone": lambda v: F.length(digits_of(v)).between(8, 15)}
    needs = {"email": text.contains("@"), "phone": text.contains("+")}
    spans = {k: checked(located(F.when(needs[k], text).otherwise("") if k in needs else text, p), checks[k]) for k, p in BASE.items()}
    return F.struct(*[s.alias(k) for k, s in spans.items()])


def checked(spans: Column, check) -> Column:
    return F.filter(spans, lambda x: check(x["value"]))


def features(kind: Column, value: Column, before: Column, after: Column) -> list[Column]:
    """Format and context of a candidate, in the order of FEATURES."""
    count = lambda pattern: F.length(F.regexp_replace(value, pattern, ""))
    digits, bare = digits_of(value), F.regexp_replace(value, " ", "")
    number, secret = kind.isin("card", "phone"), kind == "secret"
    upto = lambda n: F.when(secret, F.least(n, F.lit(16))).otherwise(n)  # noqa: E731  # a secret may be of any length
    flags = [upto(F.length(value)), upto(F.length(digits)), upto(count("[^A-Za-z]")), F.when(~secret, count(r"[^ ().\-/]")), F.when(~secret, count("[^.]")), value.startswith("+"), card_number(digits),
             bare.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"), value.rlike(r"@|\[at\]|\(at\)"), value.rlike(r"(?:\.|\[dot\] ?|\(dot\) ?)[A-Za-z]{2,}$"),
             before.rlike("[A-Za-z0-9]$"), after.rlike("^[A-Za-z0-9]"), before.rlike(HINTS), F.size(F.array_distinct(F.split(digits, ""))),
             value.rlike("[0-9]") & value.rlike("[A-Za-z]"), F.when(number, F.regexp_count(value, F.lit("[0-9]+"))), F.when(number, F.length(F.regexp_extract(value, "[0-9]+$", 0))),
             number & value.rlike(PHONE_SHAPE), number & value.rlike(CARD_SHAPE), number & before.rlike("[0-9][ ().-]{1,3}$"), number & after.rlike("^[ ().-]{1,3}[0-9]"),
             F.when(kind == "ip", count("[^:]")), (kind == "ip") & value.contains("::"), number & value.startswith("0"), *[kind == k for k in KINDS]]
    return [F.coalesce(f.cast("double"), F.lit(0.0)) for f in flags]


def card_number(digits: Column) -> Column:
    """Whether digits pass the check of a card and are no book number."""
    return luhn(digits) & ~((F.length(digits) == 13) & digits.rlike("^97[89]"))


def candidate(kind: Column, start: Column, end: Column, value: Column, before: Column, after: Column) -> Column:
    return F.struct(kind.alias("kind"), start.alias("start"), end.alias("end"), value.alias("value"), before.alias("before"), after.alias("after"))


def described(kind: Column, start: Column, end: Column, value: Column, before: Column, after: Column) -> Column:
    return F.struct(kind.alias("kind"), start.alias("start"), end.alias("end"), value.alias("value"), before.alias("before"), after.alias("after"),
                    *[f.alias(n) for n, f in zip(FEATURES, features(kind, value, before, after))])


def candidates(text: Column, base: Column) -> Column:
    """Array of described candidates of all generators; ``on_base``: touches a base span, ``inside``: lies in
    one, ``exact``: is one of its kind."""

    def full(x: Column) -> Column:
        known = described(*[x[c] for c in ("kind", "start", "end", "value", "before", "after")])

        def marked(near: Column) -> Column:
            any_base = lambda test: reduce(lambda a, b: a | b, [F.coalesce(test(near[b], b), F.lit(False)) for b in BASE_KINDS])
            holds = lambda y, b: (y["start"] <= x["start"]) & (x["end"] <= y["end"])
            same = lambda y, b: (x["kind"] == b) & (y["start"] == x["start"]) & (x["end"] == y["end"])
            return known.withField("on_base", any_base(lambda y, b: y["start"] < x["end"])).withField("inside", any_base(holds)).withField("exact", any_base(same))

        return bound(F.struct(*[ends_behind(base[b], x["start"]).alias(b) for b in BASE_KINDS]), marked)

    def near(kind: str, pattern: str) -> Column:
        gate = {"email": r"@|at[\])]", "secret": "[:=]"}.get(kind)
        found = located(F.when(text.rlike(gate), text).otherwise("") if gate else text, pattern)
        return each_on_pages(text, found, lambda x, pages: candidate(F.lit(kind), x["start"], x["end"], x["value"], *around(pages, x["start"], x["end"])))

    return F.transform(F.concat(*[near(k, p) for k, p in GENERATORS], numbers(text)), full)


def ends_behind(spans: Column, start: Column) -> Column:
    """The first of sorted spans without overlaps that ends behind ``start``, by binary search; null if none does."""

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        behind = F.coalesce(F.get(spans, middle)["end"] > start, F.lit(True))
        return F.struct(F.when(behind, state["low"]).otherwise(middle + 1).alias("low"), F.when(behind, middle).otherwise(state["high"]).alias("high"))

    steps = F.array_repeat(F.lit(0), F.ceil(F.log2(F.size(spans) + F.lit(1))).cast("int"))
    at = F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.size(spans).alias("high")), halve, lambda s: s["low"])
    return F.get(spans, at)


def each_on_pages(text: Column, spans: Column, fn) -> Column:
    """``fn`` of each span and the pages of the text, which are made only if there is a span."""
    return bound(spans, lambda found: bound(F.when(F.size(found) > 0, paged(text)), lambda pages: F.transform(found, lambda x: fn(x, pages))))


def around(pages: Column, start: Column, end: Column) -> tuple[Column, Column]:
    """The 24 characters before a span and the 4 behind it."""
    return read(pages, F.greatest(start - 24, F.lit(0)), F.least(start, F.lit(24))), read(pages, end, 4)


def numbers(text: Column) -> Column:
    """Array of numbers: of each chain every run of digit groups that holds FEWEST to MOST digits."""
    longest = MOST * (APART + 3) + 4  # characters of a number and those behind it
    none = F.array().cast("array<struct<length:int,digits:int>>")
    first_state = lambda g: F.struct(g["start"].alias("from"), g["start"].alias("at"), F.lit(0).alias("n"), F.lit(0).alias("groups"), F.lit(True).alias("going"), none.alias("out"))

    def add(state: Column, x: Column) -> Column:
        """Takes one more group into the run that starts at ``from``."""
        n = state["n"] + x["digits"]
        going, groups = state["going"] & (x["start"] - state["at"] <= APART) & (n <= MOST), state["groups"] + 1
        number = going & ((n > 12) | (n >= FEWEST) & (groups <= PHONE_GROUPS))
        run = F.array(F.struct((x["end"] - state["from"]).alias("length"), n.alias("digits")))
        return F.struct(state["from"].alias("from"), x["end"].alias("at"), n.alias("n"), groups.alias("groups"), going.alias("going"),
                        F.when(number, F.concat(state["out"], run)).otherwise(state["out"]).alias("out"))

    def of_chain(chain: Column, pages: Column) -> Column:

        def of_group(first: Column, groups: Column, i: Column) -> Column:
            runs = F.aggregate(F.slice(groups, i + 1, MOST), first_state(first), add, lambda s: s["out"])
            begin = chain["start"] + first["start"]
            seen = F.struct(around(pages, begin, begin)[0].alias("before"), read(pages, begin, longest).alias("window"))

            def of_run(run: Column, near: Column) -> Column:
                value, behind = F.substr(near["window"], F.lit(1), run["length"]), F.substr(near["window"], run["length"] + 1, F.lit(4))
                return candidate(F.when(run["digits"] >= 13, "card").otherwise("phone"), begin, begin + run["length"], value, near["before"], behind)

            return bound(runs, lambda runs: bound(F.when(F.size(runs) > 0, seen), lambda near: F.transform(runs, lambda run: of_run(run, near))))

        counted = F.transform(located(chain["value"], GROUP), lambda g: F.struct(g["start"].alias("start"), g["end"].alias("end"), F.length(digits_of(g["value"])).alias("digits")))
        return bound(counted, lambda groups: F.flatten(F.transform(groups, lambda g, i: of_group(g, groups, i))))

    dotted = lambda x: F.regexp_replace(x["value"], " ", "").rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    found = F.flatten(each_on_pages(text, located(text, CHAIN), of_chain))
    whole = lambda x: ~x["after"].rlike("^[A-Za-z0-9]") & ~dotted(x)
    return F.filter(found, lambda x: whole(x) & ((x["kind"] == "phone") | card_number(digits_of(x["value"]))))


def proposed(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_base`` (struct of base spans) and ``_candidates``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn("_base", base_spans(text)).withColumn("_candidates", candidates(text, F.col("_base")))


def variants(x: Column) -> Column:
    """The training examples that a candidate gives: a base span itself and changed formats (positive) and broken
    ones (negative); another candidate itself, unless it is ``unsure``."""
    kind, value, digits = x["kind"], x["value"], digits_of(x["value"])
    swap = lambda *steps: reduce(lambda v, step: F.regexp_replace(v, *step), steps, value)
    of_kind = lambda **by: reduce(lambda w, k: w.when(kind == k, by[k]), by, F).otherwise(value)
    local, hexes = F.substr(digits, F.length(digits) - 9, F.lit(10)), F.substr(F.md5(value), F.lit(1), F.lit(32))
    part = lambda at, n: F.substr(hexes, F.lit(at), F.lit(n))
    # groups of zeros, as many addresses have them
    sparse = F.when(F.crc32(value) % 2 == 0, F.concat(part(1, 4), F.lit("0"), part(6, 3), F.lit("0" * 8), part(17, 4), F.lit("0"), part(22, 11))).otherwise(hexes)
    cut = lambda v, *groups: F.regexp_replace(v, "^" + "".join(f"([0-9]{{{n}}})" for n, _ in groups), "".join(f"${i + 1}{sep}" for i, (_, sep) in enumerate(groups)))
    masked = (
        of_kind(email=swap(("@", " [at] "), (r"\.", " [dot] ")), phone=swap((r"^\+?[0-9]{0,2} ?", "")), card=swap(("(?<=[0-9]{4})(?=[0-9])", ".")), ip=swap((r"\.", " . "))),
        of_kind(email=swap(("@", "(at)")), phone=F.regexp_replace(local, "^([0-9]{3})([0-9]{3})", "($1) $2-"), card=F.regexp_replace(digits, "([0-9]{4})(?=[0-9])", "$1 "),
                ip=F.regexp_replace(sparse, "([0-9a-f]{4})(?=[0-9a-f])", "$1:")),
        of_kind(phone=F.regexp_replace(local, "^([0-9]{3})([0-9]{3})", F.when(F.crc32(value) % 2 == 0, "$1-$2-").otherwise("$1.$2.")), card=digits,
                ip=F.concat(F.substr(hexes, F.lit(1), F.lit(4)), F.lit(":"), F.substr(hexes, F.lit(5), F.lit(2) + F.crc32(value) % 3), F.lit("::"),
                            F.substr(hexes, F.lit(9), F.lit(1) + F.crc32(digits) % 4))),
        of_kind(phone=F.concat(F.lit("0"), cut(F.substr(local, F.lit(2), F.lit(9)), (1, " "), (2, " "), (2, " "), (2, " ")))))
    digits_apart = F.regexp_replace(local, "([0-9])(?=[0-9])", "$1 ")
    broken = (
        of_kind(email=swap((r"\.[A-Za-z]+$", ".1")), card=F.concat(F.substr(value, F.lit(2), F.length(value)), F.lit("3")), ip=swap(("^[0-9]+", "999")), phone=digits),
        of_kind(ip=swap((r"\.", ":")), phone=cut(local, (4, " "), (3, "-")), card=cut(digits, (2, " "), (3, "-"), (4, " "), (3, "-"))),
        of_kind(ip=F.regexp_replace(F.substr(hexes, F.lit(1), F.lit(12)), "([0-9a-f]{2})(?=[0-9a-f])", "$1:"), phone=F.concat(F.lit("20"), cut(local, (2, "-"), (2, "-"), (2, " "))),
                card=cut(digits, (8, " "), (3, "-"))),
        of_kind(phone=digits_apart, card=cut(digits, (3, " "), (3, "-"), (4, " ")), ip=F.concat_ws(":", F.substr(digits, F.lit(1), F.lit(2)), F.substr(digits, F.lit(2), F.lit(2)), F.substr(digits, F.lit(3), F.lit(2)))),
        of_kind(phone=F.concat(F.lit("9 "), cut(F.substr(local, F.lit(2), F.lit(8)), (2, " "), (2, " "), (2, " ")))),
        of_kind(phone=cut(local, (1, ".")), card=F.regexp_replace(digits, "([0-9])(?=[0-9])", "$1 ")))
    # two thirds of the changed formats stand before or behind another number of their kind
    turn = lambda v, i: F.when(kind.isin("card", "phone"), F.pmod(F.crc32(value) + i, F.lit(3))).otherwise(2)
    before = lambda v, i: F.when(turn(v, i) == 0, F.concat(F.substr(v, F.greatest(F.length(v) - 22, F.lit(1)), F.lit(23)), F.lit(" "))).otherwise(x["before"])
    after = lambda v, i: F.when(turn(v, i) == 1, F.concat(F.lit(" "), F.substr(v, F.lit(1), F.lit(3)))).otherwise(x["after"])
    again = lambda v, i, good: F.struct(described(kind, x["start"], x["end"], v, before(v, i), after(v, i)).alias("x"), F.lit(good).alias("good"))
    itself = lambda good: F.array(F.struct(x.dropFields("on_base", "inside", "exact").alias("x"), good.alias("good")))
    made = F.filter(F.array(*[again(v, i, True) for i, v in enumerate(masked)], *[again(v, i, False) for i, v in enumerate(broken)]),
                    lambda e: e["good"] | (e["x"]["value"] != value))
    one = itself(secret_like(x))
    return F.when(x["exact"], F.concat(itself(F.lit(True)), made)).when(unsure(x), F.slice(one, 1, 0)).otherwise(one)


def unsure(x: Column) -> Column:
    """Whether a candidate that is no base span may be personal data, so that it must not count as a negative example."""
    value = x["value"]
    number = ~x["on_base"] & ((x["phone_shape"] == 1) | ((x["luhn"] == 1) & (x["card_shape"] == 1)) | (x["hint"] == 1))
    return (F.when(x["kind"] == "secret", F.lit(False)).when(x["kind"] == "email", x["ending"] == 1)
            .when(x["kind"] == "ip", (x["octets"] == 1) | value.contains("::") | value.rlike("[A-Fa-f]")).otherwise(number))


def secret_like(x: Column) -> Column:
    """Whether an assigned value mixes digits and letters over at least 16 characters."""
    value = F.regexp_extract(x["value"], r"(?<![^\s\"':=])[^\s\"':=]++$", 0)
    return (x["kind"] == "secret") & (F.length(value) >= 16) & value.rlike("[0-9].*[0-9].*[0-9]") & value.rlike("[A-Za-z]")


@dataclass(frozen=True)
class Model:
    trees: tuple  # of (weight, tree); a tree is a number or (feature, value, tree if at most, tree if above)
    thresholds: dict[str, float]

    def score(self, x: Column) -> Column:
        def column(tree) -> Column:
            if isinstance(tree, float):
                return F.lit(tree)
            feature, value, low, high = tree
            return F.when(x[FEATURES[feature]] <= value, column(low)).otherwise(column(high))

        margin = F.lit(0.0)
        for weight, tree in self.trees:
            margin = margin + F.lit(weight) * column(tree)
        return 1 / (1 + F.exp(-2 * margin))

    def accepts(self, x: Column) -> Column:
        limit = F
        for k in KINDS:
            limit = limit.when(x["kind"] == k, F.lit(self.thresholds.get(k, 2.0)))
        return self.score(x) >= limit.otherwise(2.0)


def parsed(model) -> tuple:
    """The trees of a trained forest, read from its printed form."""
    trees = []
    for part in re.split(r"\n\s*Tree \d+ ", model.toDebugString)[1:]:
        weight = float(re.match(r"\(weight ([-\d.E]+)\)", part)[1])
        lines = iter([line.strip() for line in part.splitlines()[1:] if line.strip()])

        def node():
            line = next(lines)
            if line.startswith("Predict:"):
                return float(line.split(":")[1])
            feature, value = re.match(r"If \(feature (\d+) <= ([-\d.E]+)\)", line).groups()
            low = node()
            next(lines)  # Else
            return int(feature), float(value), low, node()

        trees.append((weight, node()))
    return tuple(trees)


def example_groups(found: DataFrame) -> DataFrame:
    """All examples of the stored candidates: how many (``n``) have the same kind, features and label. ``held``: kept
    from training to calibrate, a third of them by hash."""
    each_one = found.select(F.explode("_candidates").alias("x"))
    examples = each_one.select(F.explode(variants(F.col("x"))).alias("e")).select("e.x.*", F.col("e.good").cast("double").alias("label"))
    held = F.pmod(F.xxhash64("value", "before", "after"), F.lit(3)) == 0
    return examples.withColumn("held", held).groupBy("held", "kind", "label", *FEATURES).agg(F.count(F.lit(1)).alias("n"))


def train(found: DataFrame, precision: float = PRECISION) -> Model:
    """Forest and thresholds from all stored candidates (``_candidates``) of all documents: two thirds of their examples
    train, one calibrates. Equal examples are one weighted row; either class weighs half."""
    x, natural = F.col("x"), {}
    good, bad = x["exact"] | secret_like(x), ~x["exact"] & ~secret_like(x) & ~unsure(x)
    natural[1.0], natural[0.0] = found.select(F.explode("_candidates").alias("x")).agg(F.sum(good.cast("long")), F.sum(bad.cast("long"))).first()
    groups = materialize(example_groups(found))
    to_train = groups.where(~F.col("held"))
    sizes = {r["label"]: r["n"] for r in to_train.groupBy("label").agg(F.sum("n").alias("n")).collect()}  # at most two rows
    if len(sizes) < 2:
        return Model((), {})
    weight = F.col("n") * F.when(F.col("label") == 1, sum(sizes.values()) / 2 / sizes[1.0]).otherwise(sum(sizes.values()) / 2 / sizes[0.0])
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(to_train.withColumn("weight", weight))
    forest = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, maxBins=32, seed=7, weightCol="weight").fit(rows.select("label", "features", "weight"))
    model = Model(parsed(forest), {})
    row = F.struct("kind", *FEATURES)
    scores = groups.where("held").select("kind", "label", "n", F.floor(model.score(row) * 200).alias("bin")).groupBy("kind", "bin").agg(
        F.sum(F.col("label") * F.col("n")).alias("good"), F.sum("n").alias("n")).collect()
    # an example weighs as many candidates of the corpus as stand behind it
    n_good = sum(r["good"] for r in scores)
    weight = {1.0: (natural[1.0] or 0) / max(n_good, 1), 0.0: (natural[0.0] or 0) / max(sum(r["n"] for r in scores) - n_good, 1)}
    limits = {}
    for kind in KINDS:
        good = bad = 0.0
        for r in sorted((r for r in scores if r["kind"] == kind), key=lambda r: -r["bin"]):
            good, bad = good + weight[1.0] * r["good"], bad + weight[0.0] * (r["n"] - r["good"])
            if good >= precision * (good + bad) and r["bin"] >= 100:
                limits[kind] = r["bin"] / 200
    return Model(model.trees, limits)


def with_spans(found: DataFrame, model: Model) -> DataFrame:
    """Adds ``_base_spans`` and ``_spans``: arrays of (order, start, end, kind), sorted."""
    span = lambda kind, x: F.struct(F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind).cast("int").alias("order"),
                                    x["start"].alias("start"), x["end"].alias("end"), kind.alias("kind"))
    base = F.concat(*[each(F.col("_base")[k], k, span) for k in BASE_KINDS])
    found = found.withColumn("_base_spans", F.sort_array(base))
    if not model.trees:
        return found.withColumn("_spans", F.col("_base_spans"))
    free = F.filter("_candidates", lambda x: ~F.when(x["kind"].isin("card", "phone"), x["on_base"]).otherwise(x["inside"]))
    scored = F.transform(free, lambda x: F.struct(x["end"].alias("end"), x["start"].alias("start"), x["kind"].alias("kind"), (model.score(x) * x["digits"]).alias("weight"),
                                                  model.accepts(x).alias("taken")))
    single = lambda x: x["kind"].isin("card", "phone", "ip")
    spans = lambda some: F.transform(some, lambda x: span(x["kind"], x))
    more = bound(F.filter(scored, lambda x: x["taken"]), lambda taken: F.concat(
        spans(F.filter(taken, lambda x: ~single(x))), spans(heaviest(F.transform(F.filter(taken, single), lambda x: x.dropFields("taken"))))))
    return found.withColumn("_spans", F.sort_array(F.array_union("_base_spans", more)))


def heaviest(spans: Column) -> Column:
    """The spans (end, start, kind, weight) that do not overlap and weigh most together. In the order of their ends,
    each row notes the most that spans up to it weigh, whether it is one of them, and the row before it."""
    fields = "end:int,start:int,kind:string"
    rows_type, out_type = f"array<struct<{fields},total:double,taken:boolean,last:int>>", f"array<struct<{fields}>>"
    total = lambda rows, i: F.when(i == 0, F.lit(0.0)).otherwise(F.get(rows, i - 1)["total"])

    def add(rows: Column, x: Column) -> Column:
        n = F.size(rows)
        late = F.size(F.filter(F.slice(rows, F.greatest(n - OVERLAPS + 1, F.lit(1)), OVERLAPS), lambda r: r["end"] > x["start"]))
        with_it = total(rows, n - late) + x["weight"]
        taken = with_it > total(rows, n)
        row = F.struct(x["end"].alias("end"), x["start"].alias("start"), x["kind"].alias("kind"), F.greatest(with_it, total(rows, n)).alias("total"),
                       taken.alias("taken"), F.when(taken, n - late).otherwise(n).alias("last"))
        return F.concat(rows, F.array(row)).cast(rows_type)

    def back(rows: Column) -> Column:
        start = F.struct(F.size(rows).alias("at"), F.array().cast(out_type).alias("out"))
        numbered = F.reverse(F.transform(rows, lambda r, i: F.struct((i + 1).alias("i"), r.alias("r"))))
        one = lambda r: F.array(F.struct(r["end"].alias("end"), r["start"].alias("start"), r["kind"].alias("kind")))

        def step(state: Column, x: Column) -> Column:
            here, r = state["at"] == x["i"], x["r"]
            return F.struct(F.when(here, r["last"]).otherwise(state["at"]).alias("at"),
                            F.when(here & r["taken"], F.concat(state["out"], one(r))).otherwise(state["out"]).cast(out_type).alias("out"))

        return F.aggregate(numbered, start, step, lambda s: s["out"])

    return bound(F.aggregate(F.sort_array(spans), F.array().cast(rows_type), add), back)


def each(spans: Column, kind: str, span) -> Column:
    return F.transform(spans, lambda x: span(F.lit(kind), x))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    in_order = F.sort_array(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))

    def add(state: Column, x: Column) -> Column:
        piece = F.concat(state["out"], F.substr(text, state["at"] + 1, x["start"] - state["at"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), F.when(x["start"] < state["at"], state["out"]).otherwise(piece).alias("out"))

    return F.aggregate(in_order, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), add,
                       lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text))))


def find(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), model: Model | None = None) -> DataFrame:
    """``keep`` columns with ``base``, ``spans`` and the number of base spans by kind (n_email, ...).
    Spans and candidates are stored once, without the texts."""
    found = materialize(proposed(docs.select(*keep, F.col(text_col).alias("_text")), "_text").drop("_text"))
    model = model or train(found)
    return with_spans(found, model).select(*keep, *[F.size(F.col("_base")[k]).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
                                           F.col("_base_spans").alias("base"), F.col("_spans").alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", model: Model | None = None) -> DataFrame:
    """``docs`` with all spans of the text replaced; a null text stays null."""
    if model is None:
        model = train(materialize(proposed(docs.select(F.col(text_col).alias("_text")), "_text").drop("_text")))
    found = with_spans(proposed(docs, text_col), model)
    return found.withColumn(text_col, F.when(F.size("_spans") > 0, redacted(F.col(text_col), F.col("_spans"))).otherwise(F.col(text_col))).select(*docs.columns)

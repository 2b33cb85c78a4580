"""Token counts of whole texts by a two-tier lookup of pre-token lengths.

A SentencePiece BPE model whose pieces carry the space mark only at their
start never merges across the beginning of a run of spaces, and a character
that occurs in no piece of several characters (a line feed, for one) never
merges at all. So a text falls into *pre-tokens* that can be counted one by
one, and the same pre-tokens come back all over a corpus.

1. ``frequent_lengths``: every partition keeps a bounded count of its own
   pre-tokens and emits only those above a share of what it read; the
   summaries are added up (never the pre-tokens themselves) and the
   ``table_size`` most frequent ones are encoded once.
2. ``count_tokens``: that table, of at most ``table_size`` entries, is
   broadcast. Tier one is the table; what it misses goes to a worker's own
   cache and, the first time, to the library. No pre-token is shuffled.
   Table and cache hold pre-tokens of up to ``LONGEST`` characters, so their
   bytes are bounded too; a longer one is encoded wherever it stands.

The table only decides what is looked up instead of encoded; the counts do
not depend on it.

Defined results: a null or empty text has 0 tokens and 0 bytes; rows are
kept as they are, repeated ids included; an empty table gives an empty
result; extra columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE_MARK = "▁"
PRE_TOKEN = re.compile(r" +[^ \n]*|[^ \n]+")
TABLE_SIZE = 32_768  # entries of the broadcast table
CACHE_SIZE = 400_000  # entries of a worker's table and cache together
COUNTER_SIZE = 300_000  # pre-tokens that a partition counts at once
LONGEST = 64  # characters of a pre-token that a table or cache keeps, at most
SHARE = 2e-5  # of a partition's pre-tokens, from which one is emitted


class PieceCounter:
    """Token counts for one model file, with a bounded cache over a fixed table."""

    def __init__(self, model_path: str, table: dict[str, int] | None = None, cache_size: int = CACHE_SIZE):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.table, self.cache_size = table or {}, cache_size
        self.known = dict(self.table)
        self.separable = separable(self.library)

    def lengths(self, pre_tokens: list[str]) -> list[int]:
        """Encode pre-tokens. The library puts a space mark before a text, so each goes behind a line
        feed, and the two tokens of mark and line feed are taken off."""
        return [len(ids) - 2 for ids in self.library.encode(["\n" + w for w in pre_tokens], num_threads=1)]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not self.separable:
            return len(self.library.encode(text))
        words = pre_tokens_of(text)
        try:
            n = sum(map(self.known.__getitem__, words))
        except KeyError:
            new = [w for w in set(words) if w not in self.known]
            if len(self.known) + len(new) > self.cache_size:
                self.known = dict(self.table)
                new = [w for w in set(words) if w not in self.known]
            lengths = dict(zip(new, self.lengths(new)))
            n = sum(self.known[w] if w in self.known else lengths[w] for w in words)
            if len(self.known) + len(lengths) <= self.cache_size:
                self.known.update((w, x) for w, x in lengths.items() if len(w) <= LONGEST)
        return n + text.count("\n")


def separable(library) -> bool:
    """Whether the model's texts may be counted by pre-token: no piece has a space mark after another
    character or a line feed beside one, and a lone line feed behind the mark is two tokens."""
    pieces = (library.id_to_piece(i) for i in range(library.get_piece_size()))
    whole = not any(re.search(f"[^{SPACE_MARK}]{SPACE_MARK}|\n", p) for p in pieces)
    return whole and len(library.encode("\n")) == 2 and len(library.encode("a  b\tc")) == len(
        library.encode("a")) + len(library.encode(" b\tc"))


def pre_tokens_of(text: str) -> list[str]:
    """The pre-tokens of a text, the leading space that the library adds included; line feeds, which
    always stand alone, are left out."""
    return PRE_TOKEN.findall(" " + text.replace(SPACE_MARK, " "))


def frequent_lengths(docs: DataFrame, text_col: str, model_path: str, table_size: int = TABLE_SIZE,
                     counter_size: int = COUNTER_SIZE, share: float = SHARE) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of all texts; at most ``table_size`` of them."""

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = Counter(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    words = pre_tokens_of(text)
                    seen += len(words)
                    counts.update(w for w in words if len(w) <= LONGEST)
                    if len(counts) > counter_size:
                        counts = Counter(dict(counts.most_common(counter_size // 4)))
        top = [x for x in counts.most_common(table_size) if x[1] > share * seen]
        yield pa.RecordBatch.from_pydict({"w": pa.array([w for w, _ in top], pa.string()),
                                          "n": pa.array([n for _, n in top], pa.int64())})

    sums = (docs.select(F.col(text_col)).mapInArrow(summaries, "w string, n long")
            .groupBy("w").agg(F.sum("n").alias("n")))
    words = [r["w"] for r in sums.orderBy(F.desc("n"), "w").limit(table_size).collect()]
    counter = PieceCounter(model_path)
    return dict(zip(words, counter.lengths(words))) if words and counter.separable else {}


def count_tokens(docs: DataFrame, model_path: str, text_col: str = "text", keep: Sequence[str] = ("doc_id",),
                 out: str = "n_tokens", table: dict[str, int] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` plus the token count of each whole text.

    ``table``: lengths of frequent pre-tokens; by default those of ``docs``.
    """
    if table is None:
        table = frequent_lengths(docs, text_col, model_path)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    kept = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = T.StructType([kept.schema[c] for c in keep if c != out] + [T.StructField(out, T.LongType())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(model_path, shared.value)
        for batch in batches:
            n = pa.array([counter.count(x) for x in batch.column("_text").to_pylist()], pa.int64())
            cols = [c for c in keep if c != out]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in cols), n], [*cols, out])

    return kept.mapInArrow(counted, schema)

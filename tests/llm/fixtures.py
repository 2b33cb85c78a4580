"""Documents with every odd case that the operators define a result for."""

from pyspark.sql import types as T

LONG = "alpha beta gamma delta " * 12_000
SENTENCE = "the quick brown fox jumps over the lazy dog while the small cat sleeps near the warm stove"

ODD_DOCS = [
    (1, SENTENCE, "en", "src0", 1), (1, SENTENCE, "en", "src0", 1), (2, SENTENCE, "en", "src1", 2),
    (3, None, "en", "src1", 3), (4, "", None, "src1", 4), (5, " \t\n ", "xx", None, 5), (6, LONG, "en", "src0", 6),
    (7, "le chat est dans la maison avec les enfants et le chien", "fr", None, 7), (8, "one two", "", "", 8),
    (None, SENTENCE, "en", "src0", 9), (None, "a text that no id has at all, with ten words or more", "en", None, 10), (None, None, None, None, None),
    (9, "mail joe.doe@example.com or call +1 (743) 555-3824, card 4111 1111 1111 1111 at 10.0.0.255", "en", "src2", 11),
    (10, "x" * 50_000, "en", "src2", 12), (11, "é ü \U0001f600 <|endoftext|> ▁x\r\n\r\ny", "de", "src2", 13),
]
CLASHING = ["size", "source_size", "target", "taken", "copies", "n_tokens", "ids", "language", "confidence", "accepted", "kept", "rule",
            "n_words", "spans", "base", "class_id"]


def odd_docs(spark, rows=ODD_DOCS, clash=True):
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
              T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    more = CLASHING if clash else []
    schema = T.StructType(fields + [T.StructField(c, T.StringType()) for c in more])
    return spark.createDataFrame([(*r, *["old"] * len(more)) for r in rows], schema)


def empty_docs(spark):
    return odd_docs(spark, [])

"""The training-data pipeline: from documents to packed token sequences.

Each stage reads all rows its predecessor kept and is written before the next one begins.  The
first four return the columns of the documents, whatever these are and whatever their names: no
column clashes with one a stage uses inside.  Null texts are empty, texts of any length are read
whole, null and repeated ids are rows of their own, and an empty table stays empty.
"""

from rollcall.llm import exact, leaks, packing, quality, simhash
from rollcall.llm.common import shipped, stored, table, without_dropped
from rollcall.llm.queries import WORD_VOCABULARY


def quality_classifier(spark, docs, sf_dir):
    """Documents that the classifier accepts; it is fitted to the labels of this stage's input.

    An empty text has a score too.  Without labelled rows all documents stay.
    """
    return quality.accepted(docs, table(shipped(spark), sf_dir, "labels"))


def exact_dedup(spark, docs, sf_dir):
    """One row of each group of equal texts, the one with the smallest id; null ids come last.

    Null and empty texts are one group.
    """
    return without_dropped(docs, lambda rows, row: exact.exact_groups(rows, row=row))


def simhash_dedup(spark, docs, sf_dir):
    """One row of each group of linked fingerprints: three-word shingles, two bits or fewer.

    The row with the smallest id stays; a text without words has a fingerprint like any other.
    """
    shipped(spark)
    return without_dropped(
        docs, lambda rows, row: simhash.near_groups(rows, words=3, bits=2, row=row)
    )


def secret_scan(spark, docs, sf_dir):
    """All documents, their secrets masked; ``n_chars`` follows where there is such a column."""
    shipped(spark)
    return leaks.redacted(docs)


def mixture_packing(spark, docs, sf_dir):
    """The pieces of sequences the documents are packed into, with their ids.

    A document without text is its end id; null sources are one source.
    """
    shipped(spark)
    return packing.packed(docs, WORD_VOCABULARY, end_id=2)


STAGES = [
    ("quality", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("secrets", secret_scan),
    ("packing", mixture_packing),
]

#: No statement: a fitted model, XXH64 and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(shipped(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training corpus from raw documents: five operators in a row.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of ``documents``, and pass columns that are not theirs through.

Defined results of every stage: an empty table gives an empty one.  Language: a null text, or one without
a letter, has no language and goes, and so does one with less of a language than labelled texts have.  Lines: null and empty texts stay as they are; a text whose every line is
a repeat becomes empty; ``n_chars`` is counted anew.  Near copies: of rows that are equal, or whose texts have
no word, one stays, that of the least doc_id (nulls last).  Leaks: null and empty texts stay; equal rows stay
or go together.  Packing: a null text is empty.  Very long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import decontamination, language_id, line_dedup, near_texts, packing
from shelfwise.llm.common import materialise, read, row_key
from shelfwise.llm.queries import tokenizer_path

#: Share of the rightly labelled documents whose scores lie above the floor of the language stage, and how exactly
#: the floor is found; without any labelled document a majority of the words is asked for.
STAYS, EXACTNESS, MAJORITY = 0.999, 100_000, 0.5


def _with_text(docs: DataFrame) -> DataFrame:
    """Characters counted anew after a stage that changes texts."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents go without a letter (``und``), and those that the random field is less sure of than
    of ``STAYS`` of the documents whose label it finds, held-out ones left out: texts of several languages, or of none.

    A table without one labelled text has no languages to learn, and all its documents stay.
    """
    model = language_id.train(language_id.training_sample(docs))
    if not model.languages:
        return docs
    keyed = docs.select(row_key().alias("__key"), "doc_id", "lang", "text")
    found = language_id.predict(keyed, model, with_row=True)
    right = ~language_id.held_out(F.col("row.doc_id")) & (F.col("lang_pred") == F.col("row.lang"))
    found = materialise(found.select("row.__key", "lang_pred", "score", right.alias("right")), "languages")
    floor = found.where("right").agg(F.percentile_approx("score", 1 - STAYS, EXACTNESS)).first()[0]
    rejected = found.where((F.col("lang_pred") == "und") | (F.col("score") < F.lit(MAJORITY if floor is None else floor)))
    rejected = materialise(rejected.select("__key").distinct(), "rejected")  # of known size, so documents need no shuffle where it is small
    return docs.join(rejected, row_key() == F.col("__key"), "left_anti")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: repeated runs of lines are cut out of the texts; every document stays."""
    return _with_text(line_dedup.deduplicate(docs, counts=False))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1 on shingles of five words, completed to every pair of Jaccard 0.8 or more: one document
    of each group stays."""
    return near_texts.keep_one_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that hold a window of a benchmark item go."""
    keyed = docs.select(row_key().alias("__leak"), "text")
    found = decontamination.contamination(keyed, read(spark, sf_dir, "benchmark"), ids=("__leak",)).where("contaminated")
    return docs.join(materialise(found.select("__leak").distinct(), "leaks"), row_key() == F.col("__leak"), "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: where every piece of every document lies in the training sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again in the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Training, fingerprints over hashes and tokenising are beyond SQL; the tests have brute force.
ORACLE_SQL = None

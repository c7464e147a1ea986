"""A corpus from raw documents to tokens, in four stages, each over all that the one before kept.

1. `language_id`: documents go whose text has no letter, or no feature that tells one language from
   the others. If no training row has a language, only texts without a letter go.
2. `near_duplicates`: of documents with at least 0.8 of their five-word n-grams in common,
   directly or through others, the one with the smallest id stays.
3. `mix_sources`: sources are brought nearer to equal weights by reading the smaller ones up to twice.
   Every document is read at least once.
4. `bpe`: the tokens of each reading, with digests of them and of the decoded text.

Extra columns of the input, whatever their names, pass through the first three stages. Rows with NULL ids or texts are
handled as the operators' docstrings say; a NULL text goes in the first stage, as it has no letter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm import op2_source_mixing, op5_ngram_join, op6_bpe, op10_language_id
from mercato.llm.common import free_name, id_remainder, stored, table, workers_import_package

MIX = op2_source_mixing.Mix(entropy=None, max_repeats=2.0, whole=True)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    training = docs.filter(id_remainder("doc_id", 3) != 1).select("doc_id", "text", "lang")
    model = op10_language_id.train(training)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    names = free_name(docs, "lang_pred"), free_name(docs, "lang_score")
    found = op10_language_id.identify(docs, model, to=names)
    known = F.col(names[0]) != op10_language_id.UNKNOWN
    if len(model.languages) > 1:  # all equally likely: nothing in the text is known of any language
        known = known & (F.col(names[1]) > (1 + 1e-9) / len(model.languages))
    return found.filter(known).drop(*names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op5_ngram_join.one_of_each_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_source_mixing.mixed(docs, MIX)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op6_bpe.tokens(docs.select("doc_id", "source", "text"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("bpe", bpe),
]

# Neither the language model nor byte-pair encoding can be said in SQL; see tests/llm.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result but the last is written and read again."""
    workers_import_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

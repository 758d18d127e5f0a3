"""The corpus pipeline: documents through the stages below, each written as Parquet and reread.

``run`` gives the rows of the last stage. ORACLE_SQL is None: XXH64 fingerprints, a trained
classifier and tokenisation are beyond SQL; tests hold the stages against brute force.

Every stage takes and gives the columns of ``documents``, whatever others come with them and under
any names; values are never changed. Defined results: a null text counts as an empty one, which has a
score, fingerprint zero, no benchmark words, a size of one and the end token alone. Rows with a null id
are scored and mixed like others; of near copies, the least id stays, a null one only among nulls.
Repeated rows are kept or dropped alike by the filters, deduplicated to one, and replicated alike by
the mix. An empty table gives no rows at any stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import decontaminate, mixing, quality, simhash, tokens
from orderloom.llm.common import fresh, stored, table
from orderloom.llm.queries import END_ID, tokenizer_path
from orderloom.session import run_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier rejects (score below the threshold)."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "score")
    scored = quality.with_score(docs, model, out=score)
    return scored.filter(F.col(score) >= quality.THRESHOLD).drop(score)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the least id."""
    return simhash.keep_one(docs, shingle=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), window=10)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated to the target weights of their sources, in shuffled order."""
    copy, order = fresh(docs, "copy"), fresh(docs, "shuffle_key")
    return mixing.poisson_mix(docs, copy=copy, order=order).select(docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of the mix; the result is read back from the files."""
    path = run_dir(spark, "pipeline_tokens")
    manifest = tokens.write_shards(docs, path, tokenizer_path(), END_ID, special_as_text=False)
    return tokens.decoded(spark, path, manifest)


STAGES: list[tuple[str, Stage]] = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix", mix),
    ("token_output", token_output),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to token shards: five stages, each stored before the next one starts.

1. ``quality``: the rule ensemble learns from ``labels``; documents that score below its cut go.
2. ``near_dedup``: of each group of near-copies (five-word shingles: fingerprints that differ in at most 3 bits, or a
   similarity of 0.8 or more) the document with the smallest id stays.
3. ``decontaminate``: documents that contain an item of ``benchmark`` go.
4. ``mix``: sources are brought to their target weights. A document stands as often as the mix takes it, at
   most twice, in the order of its training positions, and always whole: the one at a source's bound is taken if that
   is nearer to the target.
5. ``tokens``: the texts become token shards, in the order in which the mix has stored them; the rows are what is read back from them.

All but the last return the columns of ``documents``. A stage first removes the
intermediate tables of the one before it, whose output is stored by then; the
stored outputs are what a lost run goes on from.

In every stage rows that repeat an id, and rows without one, are documents of
their own; NULL and empty texts are texts without words, alike among each other
for ``near_dedup`` and not taken by ``mix``; other columns, whatever their names,
are carried along; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegrid.llm import decontaminate as leaks
from tidegrid.llm import mixing, rules, simhash
from tidegrid.llm import tokens as shards
from tidegrid.llm.common import staged, stored, table


@staged
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.kept_by_quality(docs, table(spark, sf_dir, "labels"))


@staged
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each_group(docs)


@staged
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


@staged
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, whole=True)


@staged
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shards.round_trip(docs, shards.vocabulary(), as_stored=True)


STAGES = [
    ("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("tokens", tokens),
]

#: The first stage learns a model, which SQL cannot state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

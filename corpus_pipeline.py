"""From raw documents to packed training sequences.

Each stage works on all that its predecessor kept: junk documents go, one document of each group of near copies stays,
passages that repeat across documents stay in the first of them, and what is left is packed into bins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from isohyet.llm import jaccard_join, packing, quality, substring_dedup
from isohyet.llm.common import collecting, remove, table, written
from isohyet.shipping import ship

#: Tables that a stage wrote on its way; the next stage starts when that one's result is written and removes them.
_scratch: list[str] = []


def _stage(operator):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        remove(spark, _scratch)
        with collecting(_scratch):
            return operator(docs)

    return run


#: Word shingles: five words, similarity of 0.8 or more.  Passages: 50 words.  Bins: 2048 words.
STAGES = [
    ("quality_classifier", _stage(quality.keep_good)),
    ("ngram_jaccard_join", _stage(lambda docs: jaccard_join.first_of_each_group(docs, 5, 80))),
    ("substring_dedup", _stage(lambda docs: substring_dedup.without_repeats(docs, 50, 13))),
    ("packing", _stage(lambda docs: packing.pack_documents(docs, 2048))),
]

#: SQL expresses neither the classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs

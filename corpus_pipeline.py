"""A cleaning pipeline for documents: what each stage keeps is the next one's input.

Stages return the columns of ``documents``; the last one adds the token ids. ``run``
writes each stage to the shared folder and reads it again, so that a lost executor
costs at most one stage. Rows with NULL texts count as empty texts; an empty table
gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from snapsync.llm import bpe, decontaminate, quality_classifier, quality_rules, simhash
from snapsync.llm.common import importable, table, written

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def rules(spark, docs, sf_dir):
    """Documents that no rule of the current policy rejects."""
    # As one column, so that no name of theirs meets one of the ledger's.
    rows = docs.select(F.struct("*").alias("document"), "text")
    return quality_rules.apply_policy(quality_rules.ledger(rows)).select("document.*")


def classifier(spark, docs, sf_dir):
    """Documents that the classifier, learnt from the labelled ones among them, keeps."""
    labels = table(spark, sf_dir, "labels")
    return quality_classifier.kept(docs, labels)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates."""
    return simhash.representatives(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that share no window with a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark, docs, sf_dir):
    """Documents with their token ids and the text that the ids give back."""
    return bpe.encode(docs, BYTE_BPE, check=True)


def _ready(stage):
    def run_stage(spark, docs, sf_dir):
        importable(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality_rules", _ready(rules)),
    ("quality_classifier", _ready(classifier)),
    ("simhash_near_dedup", _ready(near_duplicates)),
    ("decontamination", _ready(decontamination)),
    ("bpe", _ready(tokens)),
]

# A trained classifier is no SQL: tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

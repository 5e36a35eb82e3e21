"""Corpus preparation for language-model training, stage by stage.

Each stage is a function of (spark, docs, sf_dir); its result is written as Parquet
to the shared folder and read again as the next stage's ``docs``.

1. ``quality_classifier``: documents that the co-trained classifier rejects go.
2. ``simhash_near_dedup``: of each group of documents whose five-word shingles are alike
   by 0.8 or more, as four fingerprints tell, the smallest doc_id stays.
3. ``substring_dedup``: sentences in repeated spans go; a document that held text and
   keeps none goes too.
4. ``benchmark_decontamination``: documents with a window of a benchmark item go.
5. ``byte_bpe``: whole texts become token ids, with digests of ids and of the text
   decoded from them.

Stages 1 to 4 return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.llm import bpe, classifier, decontam, simhash
from skeinwork.llm import substring_dedup as spans
from skeinwork.llm.common import Tables, cut, table
from skeinwork.llm.queries import tokenizer_file


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_similar(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = spans.remove_repeated_spans(docs)
    changed = F.col("n_removed") > 0
    emptied = changed & (F.length(F.btrim("row.text", F.lit(" \t\n\r"))) == 0)
    columns = []
    for field in docs.schema:
        value = F.col("row").getField(field.name)
        if field.name == "n_chars":
            value = F.when(changed, F.length("row.text").cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return cleaned.filter(~emptied).select(*columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path, pattern = tokenizer_file()
    return bpe.bpe_encode(docs, path, pattern)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE encoding and decoding", byte_bpe),
]

#: SQL expresses neither the classifier nor XXH64 nor BPE; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with Tables() as tables:
        for i, (_, stage) in enumerate(STAGES):
            docs = cut(stage(spark, docs, sf_dir), f"stage{i + 1}")
            tables.drop(spark, keep=f"stage{i + 1}")
    return docs

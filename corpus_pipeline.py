"""The corpus pipeline: language ID, n-gram Jaccard join, suffix-array dedup, packing.

STAGES are (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.

Every stage judges rows. Where doc_id is unique and never null it tells them apart; else a stored row number does, so
rows that share an id are documents of their own, in the table's order. Null and empty texts and texts without letters
go in the first stage; of equal texts the first row stays. An empty table stays empty through all stages. Other
columns stay as they are, whatever their names; texts of any length are taken whole."""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import jaccard_join, language_id, packing, suffix_dedup
from panelspark.llm.common import join_small, small_batches, stored

#: A document goes if it has no letters or its likeliest language holds less than half of its words' weight.
LEAST_SCORE = 0.5
#: The columns that tell rows apart where doc_id doesn't, and that hold spans to cut; with more _ if the table has them.
ROW, SPANS = "pipeline_row_number", "pipeline_spans"


def free_name(docs: DataFrame, name: str) -> str:
    """name, with as many _ behind it as make it no column of docs."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def with_keys(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs and the column that tells its rows apart: doc_id, or a row number in a stored copy if ids repeat or lack."""
    ids = docs.groupBy("doc_id").count()
    if ids.where("count > 1 or doc_id is null").isEmpty():
        return docs, "doc_id"
    row = free_name(docs, ROW)
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), "keyed"), row


def without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """docs without the rows that gone names, and without the row number."""
    gone = stored(gone.select(F.col("doc_id").alias(key)), "gone")
    kept = join_small(docs, gone, key, "left_anti", gone.count())
    return kept if key == "doc_id" else kept.drop(key)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in a language that the model knows; it learns from the languages given in docs. Without any labelled row
    nothing is known and nothing stays. At a tie of languages the first by name counts."""
    keyed, key = with_keys(docs)
    got = language_id.identify_language(keyed, id_col=key)
    return without(keyed, got.where((F.col("lang_pred") == "und") | (F.col("score") < LEAST_SCORE)), key)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each group that is linked by five-word shingles at 0.75 or more; rows without words stay."""
    keyed, key = with_keys(docs)
    got = jaccard_join.jaccard_components(keyed, id_col=key)
    return without(keyed, got.where("component_id <> doc_id"), key)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that stand in an earlier 100-byte string; rows of which nothing is left go.

    A character that is cut in two goes as a whole; n_chars of a cut text is counted anew. Rows of which nothing is
    taken stay as they are, null and empty texts too."""
    keyed, key = with_keys(docs)
    spans, columns = stored(suffix_dedup.repeated_spans(keyed, id_col=key).withColumnRenamed("doc_id", key), "spans"), docs.columns
    cuts = free_name(keyed, SPANS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [suffix_dedup.kept_bytes((t or "").encode(), s).decode(errors="ignore") for t, s in zip(b.column("text").to_pylist(), b.column(cuts).to_pylist(), strict=True)]
            text = pa.array(texts, pa.string())
            cols = {n: text if n == "text" else pa.array(list(map(len, texts)), b.schema.field(n).type) if n == "n_chars" else b.column(n) for n in columns}
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    n, size = spans.agg(F.count("*"), F.sum(F.size("spans") * 16 + 48)).first()
    clean = join_small(keyed, spans.select(key), key, "left_anti", n).select(docs.columns)
    touched = join_small(small_batches(keyed), spans.withColumnRenamed("spans", cuts), key, "inner", size or 0, 1).select(*docs.columns, cuts)
    return clean.union(touched.mapInArrow(cut, docs.schema).where("text <> ''"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 2,048 ids: one row per piece. A null or empty text is its end id alone."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_stage), ("jaccard_join", jaccard_stage), ("suffix_dedup", repeats_stage), ("packing", packing_stage)]

#: Forward-backward and a tokenizer's merges can't be told in SQL; tests/llm/test_pipeline.py compares run() with the
#: stages in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage's result is stored in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

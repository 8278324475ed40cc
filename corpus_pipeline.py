"""A corpus pipeline of five stages over the table documents.

toxicity          rejects toxic documents
near_duplicates   keeps one document of each near-duplicate group
repeats           cuts passages out that occur more than once
decontamination   rejects documents that hold a benchmark item
packing           packs what remains into windows of 4096 ids

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept.
All but the last return the columns of documents.  Between stages the rows are
written as Parquet and read again, which also cuts the lineage, so a lost
executor repeats work of one stage only.

Edge cases (every stage): null and empty texts pass the filters; repeated rows
fall to near_duplicates; an empty table passes through; further columns are
carried along.
"""
from __future__ import annotations

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timewise.llm import toxicity as toxicity_model
from timewise.llm.common import checkpointed, shared_folder, small, table, tidy
from timewise.llm.decontaminate import contaminated
from timewise.llm.packing import pack
from timewise.llm.parity_join import near_duplicates as near_duplicate_classes
from timewise.llm.suffix_dedup import PASSAGE, kept_bytes, repeated_spans
from timewise.llm.textblock import lean


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    model = toxicity_model.fit(docs, table(spark, sf_dir, "labels"))
    gone = small(toxicity_model.score(docs, model).where("predicted = 1").select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least id stays; of
    repeated rows of one id, one."""
    gone = small(near_duplicate_classes(docs).where("component_id <> doc_id").select("doc_id").distinct())
    rest = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    twice = checkpointed(rest.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id"))
    if not twice.take(1):
        return rest
    once = rest.join(twice, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id"])
    return rest.join(twice, "doc_id", "left_anti").select(docs.columns).unionByName(once)


#: Bytes of the shortest passage that the stage repeats cuts: a passage of 51
#: words is longer in any of the languages, so a stage-wide 400 would miss it.
REPEAT_BYTES = PASSAGE


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes covered by a repeated string of ``REPEAT_BYTES`` bytes go, with
    characters they cut; a document of which nothing remains goes too."""
    schema, counted = docs.schema, dict(docs.dtypes).get("n_chars")

    def cut(batches):
        for batch in batches:
            text = [b.as_py().decode("utf-8", "ignore") for b in batch.column("kept_of_text")]
            out = [batch.column(c) for c in schema.names]
            out[schema.names.index("text")] = pa.array(text, batch.schema.field("text").type)
            if counted:
                out[schema.names.index("n_chars")] = pa.array([len(t) for t in text]).cast(batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(out, schema.names)

    spans = repeated_spans(docs, length=REPEAT_BYTES)
    ids = small(spans.select("doc_id").distinct())
    hit = (docs.join(ids, "doc_id", "left_semi").join(spans.withColumnRenamed("spans", "spans_of_text"), "doc_id")
           .select(*docs.columns, kept_bytes(F.col("text").cast("binary"), F.col("spans_of_text")).alias("kept_of_text"))
           .mapInArrow(lean(cut), schema).where("text <> ''"))
    return docs.join(ids, "doc_id", "left_anti").select(docs.columns).unionByName(hit)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    gone = small(contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct())
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a window."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("repeats", repeats),
          ("decontamination", decontamination), ("packing", packing)]

#: Fitted models, byte windows and a tokenizer: SQL cannot express them.
#: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written as Parquet and reread."""
    folder = shared_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        tidy(spark)
    return docs

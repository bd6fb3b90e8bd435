"""Corpus pipeline: five operators of ``casewise.llm`` in a row over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and
returns a DataFrame, which is written as Parquet to the shared folder and read again as
the next stage's input.  All stages but the last return the columns of ``documents``; the
last adds each document's slot and place in the mix, and ``run`` returns its rows in that order.

Defined edge cases: a null, empty or letterless text goes in the first stage; without a single
labelled language every document goes there, and without labels of both kinds toxicity keeps all
documents or none, by the labels' one value (none at all: all stay); of repeated rows near-duplicate
removal keeps one; null ids and null sources take part; very long texts are scored and encoded whole;
an empty table gives an empty result at every stage; further columns, whatever their names, come
through the first four stages as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.llm import bpe, langid, pfair, simhash, toxicity
from casewise.llm.common import stored
from casewise.llm.queries import BYTE_BPE

#: A document goes if it has no letters, or no language scores at least this (a text in two
#: languages scores about 0.4 to 0.6 and stays).
LEAST_LANGUAGE_SCORE = 0.3
#: A document goes if its calibrated probability of being toxic reaches this.
TOXIC = 0.7
#: Columns of the pipeline's result.
RESULT = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``docs`` is called so in any case of letters."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lang, score = fresh(docs, "pipeline_lang"), fresh(docs, "pipeline_score")
    found = langid.predict(docs, langid.fit(docs), pred=lang, score=score)
    kept = found.filter((F.col(lang) != langid.UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE_SCORE))
    return kept.drop(lang, score)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = fresh(docs, "pipeline_score")
    return toxicity.score(docs, model, out=score).filter(F.col(score) < TOXIC).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_group(docs, shingle=3, max_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of the mix."""
    own = [f"in_{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, own, strict=True))
    mixed = pfair.mix(docs.toDF(*own), id_col=at["doc_id"], source_col=at["source"])
    return pfair.in_order(mixed).select(*own).toDF(*docs.columns)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the tokens with the slot and place that ``mix_sources`` gave each document.

    The mix is a function of the rows, so it is taken again here, on the short rows: files
    are not read in the order in which they were written.
    """
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select("doc_id", "source", "text", whole.alias("row_hash"))
    out = bpe.encode_decode(rows, BYTE_BPE, keep=["doc_id", "source", "row_hash"])
    out = out.select("doc_id", "source", "row_hash", F.size("ids").cast("long").alias("n_tokens"),
                     F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                     F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
    return pfair.mix(stored(out, "pipeline-digests"), tie_col="row_hash").select(*RESULT, "slot", "place")


STAGES = [("language_id", language_id), ("toxicity", toxicity_filter), ("near_duplicates", near_duplicates),
          ("mix_sources", mix_sources), ("bpe_tokens", bpe_tokens)]

#: SQL cannot express the learned stages; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs.orderBy("slot", "place").select(*RESULT)

"""From raw documents to packed training sequences.

Stages, each a function (spark, docs, sf_dir) -> DataFrame over all rows that
its predecessor kept: the quality classifier drops what it rejects, line dedup
cuts repeated lines, SimHash keeps one document of each near-duplicate group,
mixing repeats or drops documents towards the sources' target weights, packing
turns the rest into sequences. All but the last return the columns of documents,
and further columns of the input, whatever their names, pass through.

Part of the subpackage llm: without that it cannot be imported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import materialize
from weftline.llm.lines import dedup_lines
from weftline.llm.mixing import mix_sources, take_copies
from weftline.llm.packing import pack
from weftline.llm.quality import fit_quality, score_quality
from weftline.llm.simhash import first_of_groups
from weftline.session import bound_workers


#: Near duplicates: bits in which fingerprints may differ, and the similarity of
#: five-word shingles that links texts which fingerprints don't (most differ in 2 to
#: 11 of 64 bits).
NEAR_BITS = 3
NEAR_SIMILARITY = 0.8


def _like(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or more by a classifier trained on labels.quality.
    Null and empty texts get the prior, like any short text; repeated rows are
    judged alike; an empty table stays empty."""
    bound_workers(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_quality(docs, labels, label="quality")
    return _like(score_quality(docs, model, score="__score").where("__score >= 0.3"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier line equals within one edit. A
    null text stays null, a document may end up empty; equal rows are treated
    alike, rows that share an id and differ in text are documents of their own."""
    bound_workers(spark)
    return _like(dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group whose fingerprints link at ``NEAR_BITS``
    bits, or whose five-word shingles have ``NEAR_SIMILARITY``. Null and empty texts have the fingerprint zero and form a group; of rows
    that share an id one stays for each group it leads, equal rows stay once; rows
    with a null id stay."""
    bound_workers(spark)
    return first_of_groups(docs, max_bits=NEAR_BITS, least=NEAR_SIMILARITY).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. Null and empty texts have no
    words and go with the rate of their source; the null source is a source."""
    bound_workers(spark)
    return take_copies(docs, mix_sources(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens; a null text is an empty one, that is
    its end token; copies are packed each on its own."""
    bound_workers(spark)
    return pack(docs)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: No SQL tokenizes or trains; tests/llm compares each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs)
    return docs

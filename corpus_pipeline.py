"""A corpus pipeline from the operators of ``locus.llm``; see STAGES.

Every stage takes all documents that the stage before it kept.  All but the last return the columns of
``documents`` (and any further ones), with ``n_chars`` as long as the text now is; the last returns token
pieces with their places in sequences.  Nulls, empty texts and repeated rows are treated as the operators say; of
repeated rows the near-duplicate stage keeps one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from locus.llm import line_dedup, packing, pii, simhash, toxicity
from locus.llm.queries import LINE_DOCS, SIMHASH_RADIUS, SIMHASH_SHINGLE, TOKEN_LIMIT, read
from locus.runtime import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
OWN, REST = ("doc_id", "text"), "document_rest"


def sealed(stage: Stage) -> Stage:
    """A stage that sees doc_id, text and one struct of all other columns, so that no name of theirs can clash
    with one of an operator; they come back under their names, in their order, with ``n_chars`` set to the length of the text."""
    @wraps(stage)
    def opened(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rest = {c: f"c{i}" for i, c in enumerate(c for c in docs.columns if c not in OWN)}
        struct = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(inner) for c, inner in rest.items()])
        out = stage(spark, docs.select(*OWN, struct.alias(REST)), sf_dir)
        column = {c: F.col(REST)[inner] for c, inner in rest.items()} | {c: F.col(c) for c in OWN}
        if "n_chars" in rest:
            column["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
        return out.select(*[column[c].alias(c) for c in docs.columns])

    return opened


@sealed
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below one half."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, carry=[REST]).filter("score < 0.5")


@sealed
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them have."""
    index = line_dedup.LineIndex(spark, min_chars=1).insert(docs)
    return index.drop(docs, min_docs=LINE_DOCS, carry=[REST]).withColumnRenamed("kept", "text")


@sealed
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.representatives(docs, shingle=SIMHASH_SHINGLE, radius=SIMHASH_RADIUS)


@sealed
def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and what gives it away generalised or removed."""
    return pii.sanitise(docs, carry=[REST]).withColumnRenamed("sanitised", "text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences."""
    import public_tokenizers as vocab

    return packing.pack(docs, vocab.path("byte_bpe_50k.json"), vocab.PATTERN, TOKEN_LIMIT)


#: (name, function) in order; each function takes (spark, docs, sf_dir).
STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash", drop_near_duplicates),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: SQL can't express these stages; tests/llm checks what they hand on.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over ``documents``, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs

"""From raw documents to training sequences: five stages, each stored before the next.

``STAGES`` names the stages in order. Each function takes the session, the documents that
the stage before kept, and the folder of the tables; all but the last return the columns of
``documents``, and other columns too, whatever their names.

Defined results, for every stage: an empty table stays empty; nulls in lang, source or n_chars
are values like any other, and stay; names of columns may differ in letter case. What becomes
of null and empty texts, rows without an id, ties and repeated rows is told by each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tributary.llm import mixing, packing, personal, quality, simhash
from tributary.llm.tables import read, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go.

    A null or empty text has fewer words than the base rules ask for and goes; a row without
    an id is judged like any other, only not learned from. Repeated rows stay or go together.
    """
    rules = quality.fit_rules(docs, read(spark, sf_dir, "labels"))
    return quality.keep_good(docs, rules)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id.

    Null and empty texts are one group, whose fingerprint is zero. Of rows that repeat an id
    and a text one stays; a row without an id stays if its group has no id at all.
    """
    return simhash.keep_one(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to the names of its kinds.

    Every row stays. Null and empty texts stay as they are; repeated rows change alike.
    """
    return personal.redact(docs, personal.fit_tagger(personal.labelled_table(spark)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stays as many times as the mixture takes it.

    Null and empty texts have no words and go. The null source is a source of its own. Which
    of the documents of equal length are taken is settled by a hash of id and text; repeated
    rows are taken one by one, rows without an id like others.
    """
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their token ids, sequences and places in these.

    A null or empty text is one piece that holds the end mark alone. Rows are packed one by
    one, whether they repeat others or have no id; of equally long pieces any may come first.
    """
    packed = packing.pack(docs)
    return packed.withColumn("piece", packed["piece"].cast("int"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("mixing", mix),
    ("packing", pack),
]

# No SQL can state the trained stages; tests/llm compares the pipeline with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: documents in, a clean and weighted mixture out.

Every row is judged by itself, whether it has a doc_id, shares it with others or has none. Rows
that agree in doc_id, source and text are one document. Joins that move whole texts are sorted and
merged whatever the size, so a run over more data has the same plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, forest, lines, mixing, rules
from tidemark.llm.common import saved, table


def _keyed(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` as ``row``, and k1 and k2: 128 bits of hash of its doc_id, source and
    text. The columns of ``docs`` may have any names."""
    content = [c for name in ("doc_id", "source", "text") for c in (F.isnull(name), F.col(name))]
    return docs.select(
        F.struct("*").alias("row"),
        F.xxhash64(*content).alias("k1"),
        F.xxhash64(F.lit("twin"), *content).alias("k2"),
    )


def _by_key(keyed: DataFrame) -> DataFrame:
    """What an operator reads, with the key as the doc_id."""
    return keyed.select(F.struct("k1", "k2").alias("doc_id"), "row.source", "row.text")


def _rows(keyed: DataFrame, like: DataFrame) -> DataFrame:
    return keyed.select(*[F.col("row").getField(c).alias(c) for c in like.columns])


def _without(keyed: DataFrame, dropped: DataFrame) -> DataFrame:
    """``keyed`` without the rows whose keys are listed as doc_id.

    The list grows with the corpus, so it is sorted and merged at every size, never broadcast.
    """
    listed = saved(dropped.select("doc_id.k1", "doc_id.k2").distinct(), "dropped")
    return keyed.join(listed.hint("merge"), ["k1", "k2"], "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose host passes.

    NULL and empty texts have no words and go. A NULL source is no host. Texts of any length are
    judged whole, repeated rows each by itself. An empty table gives no rows.
    """
    return rules.passing(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that others repeat; n_chars follows the text.

    Documents are in the order of their doc_id, those without one first; rows that differ count as
    different documents. NULL and empty texts stay as they are, with 0 in n_chars for empty ones.
    Texts of any length are split whole. Other columns, whatever their names, are passed on. An
    empty table gives no rows.
    """
    own = F.struct("row.doc_id", "k1", "k2")
    cleaned = lines.drop_lines(_keyed(docs).select(own.alias("doc_id"), "row", "row.text"))
    rest = {c: F.col("row").getField(c).alias(c) for c in docs.columns}
    rest["text"] = F.col("text")
    rest["n_chars"] = F.char_length("text").cast("long").alias("n_chars")
    return cleaned.select(*[rest[c] for c in docs.columns])


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of similar ones; one without an id only
    where no other has one, and of repeated rows one.

    Links are searched by half of the key, which the forest takes as an id. Documents of fewer
    words than a shingle, NULL and empty texts among them, are similar to none. Other columns,
    whatever their names, are passed on. An empty table gives no rows.
    """
    keyed = _keyed(docs)
    classes = forest.similar(keyed.select(F.col("k1").alias("doc_id"), "row.text"))
    classes = classes.select(F.col("doc_id").alias("k1"), "class_id")
    rows = saved(keyed.select("row.doc_id", "k1", "k2").join(classes, "k1"), "rows")
    order = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "k1", "k2")
    least = rows.groupBy("class_id").agg(F.min(order).alias("least"), F.count("*").alias("n"))
    least = saved(least.where("n > 1").select("class_id", "least"), "least")
    others = rows.join(least, "class_id").where("k1 <> least.k1 OR k2 <> least.k2")
    kept = _without(keyed, others.select(F.struct("k1", "k2").alias("doc_id")))
    repeated = rows.groupBy("k1", "k2").agg(F.count("*").alias("n")).where("n > 1")
    repeated = saved(repeated.select("k1", "k2"), "repeated")
    if repeated.isEmpty():
        return _rows(kept, docs)
    copies = kept.join(repeated, ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    return _rows(kept.join(repeated, ["k1", "k2"], "left_anti").unionByName(copies), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    NULL and empty texts hold none and stay. Texts of any length are searched whole. Other
    columns, whatever their names, are passed on. An empty table gives no rows.
    """
    keyed = _keyed(docs)
    held = decontam.contaminated(_by_key(keyed), table(spark, sf_dir, "benchmark"))
    return _rows(_without(keyed, held), docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, with the number of copies that each has in it.

    Adds size, source_size, target, copies and taken to the columns of ``docs``, in place of any
    columns of these names. Rows that agree in doc_id, source and text are one document here,
    which takes their copies together. NULL and empty texts have no size and are not taken. Texts
    are shuffled once, to meet their copies. An empty table gives no rows.
    """
    keyed = _keyed(docs)
    mixed = mixing.mix(keyed.select(F.col("k1").alias("doc_id"), "row.source", "row.text"))
    mixed = mixed.where("copies > 0").groupBy(F.col("doc_id").alias("k1")).agg(
        F.first("size").alias("size"),
        F.first("source_size").alias("source_size"),
        F.first("target").alias("target"),
        F.sum("copies").cast("int").alias("copies"),
        F.sum("taken").alias("taken"),
    )
    added = ["size", "source_size", "target", "copies", "taken"]
    taken = keyed.join(saved(mixed, "mixed").hint("merge"), "k1").dropDuplicates(["k1", "k2"])
    own = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in added]
    return taken.select(*own, *added)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
]

# Similarity classes, random walks and drawn copies have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = saved(docs, f"stage-{number}")
    return docs

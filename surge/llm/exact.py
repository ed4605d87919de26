"""Exact dedup by content-defined chunk recipes, with DataFrame functions only.

A normalised text is cut where its content says so: a chunk ends at the first
sentence or line end after ``LEAST`` characters, or after ``MOST``.  Chunks are
grouped by SHA-256 and every group is verified byte for byte (its smallest and
largest text are equal), so a digest is a chunk's identifier; a chunk whose
digest is shared by different texts is identified by its text.  A document is
then its ordered list of identifiers: equal lists are equal texts.  Texts move
once, as chunks, to be verified; all later steps move lists of 32 bytes a chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surge.llm.staging import staged

LEAST, MOST = 512, 4096
CHUNK = rf"(?s).{{{LEAST},{MOST}}}?(?:[.!?]\s|\n|\z)|(?s).{{1,{MOST}}}"
#: Parts into which the rows of every group are dealt when they meet their group's result.
SALTS = 32


def normalised(text: Column) -> Column:
    """Lower-case A-Z only; null as empty."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(text, F.lit("")), upper, upper.lower())


def chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def chunk_id(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def clashing_chunks(texts: DataFrame) -> DataFrame:
    """Digests that stand for more than one chunk text (column ``digest``), from a table with column ``text``."""
    each = texts.select(F.explode(chunks(F.col("text"))).alias("chunk"))
    store = each.groupBy(chunk_id(F.col("chunk")).alias("digest")).agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
    return store.where(F.col("least") != F.col("most")).select("digest")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, keep_id, group_size, kept, text_sha256).

    Null and empty texts form one group.  Of equal texts the row with the largest
    id stays (null ids below all others); of rows that repeat both text and id,
    one stays.  An empty table gives an empty result; other columns are not read.
    """
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), normalised(F.col(f"`{text_col}`")).alias("text"))
    # SHA-256 has no known clash, so this holds no rows unless one is found; then those chunks go by their text.
    clashes = staged(clashing_chunks(texts), "exact-clashes")
    known = clashes.agg(F.collect_list("digest").alias("digests"))
    names = F.transform(chunks(F.col("text")), lambda c: F.when(
        F.array_contains("clashes", chunk_id(c)), c.cast("binary")).otherwise(chunk_id(c)))
    rows = texts.withColumn("clashes", known.select("digests").scalar()).select("doc_id", names.alias("recipe"), F.sha2("text", 256).alias("text_sha256"))
    rows = staged(rows.groupBy("doc_id", "recipe", "text_sha256").agg(F.count(F.lit(1)).alias("times")), "exact-recipes")
    groups = rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.sum("times").alias("group_size")) \
        .where("group_size > 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.hash("doc_id"), F.lit(SALTS)))
    found = dealt.join(groups, ["recipe", "salt"], "left") \
        .withColumn("keep_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))) \
        .withColumn("group_size", F.coalesce("group_size", F.lit(1)).cast("long"))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return found.withColumn("copy", copy).select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256")


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one of the largest id; columns unchanged.

    Rows are told apart by id and normalised text, so an id may stand for several texts; of rows that repeat both, one stays.
    """
    pairs = exact_groups(docs, id_col, text_col).groupBy("doc_id", "text_sha256").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("times")).where("NOT kept OR times > 1")
    pairs = staged(pairs.select(F.col("doc_id").alias("_exact_doc"), F.col("text_sha256").alias("_exact_text"), F.col("kept").alias("_exact_kept")), "exact-pairs")
    rows = docs.withColumns({"_exact_id": F.col(f"`{id_col}`"), "_exact_sha": F.sha2(normalised(F.col(f"`{text_col}`")), 256)})
    same = (F.col("_exact_sha") == F.col("_exact_text")) & F.col("_exact_id").eqNullSafe(F.col("_exact_doc"))
    single = rows.join(pairs, same, "left_anti")
    again = rows.join(pairs.where("_exact_kept"), same, "left_semi").dropDuplicates(["_exact_id", "_exact_sha"])
    return single.unionAll(again).drop("_exact_id", "_exact_sha")

"""Mix sources to target weights by nested hash thresholds.

Every document has a 60-bit hash of its id.  A source that is to give R words
takes the documents whose hash is below a threshold t(R): thresholds of larger
budgets contain those of smaller ones.  The threshold is found without a sort:
sizes are summed by (source, top 12 bits of the hash), a running sum over that
histogram names the boundary bucket, and only the documents of the boundary
bucket are summed again by the next 12 bits, five levels in all.  The documents
below the boundary are then a filter on the hash.

A source whose target exceeds its size is taken whole ``target // size`` times
and the rest by threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surge.llm.staging import staged

LEVELS, BITS = 5, 12
#: White space between words: U+0020 and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; null counts as empty."""
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def id_hash(doc_id: Column) -> Column:
    """60 bits of the MD5 of the id as text (null as the empty text)."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], budget: float, most: float) -> DataFrame:
    """Words each source is to give: (source, source_size, target).

    ``sizes`` has (source, source_size), one row per source.  Sources by code
    point, null last, take the weights in turn; ``budget`` times all words is
    shared by weight, no source above ``most`` times its size, the excess shared
    again by weight.  That is a water level L with target = min(cap, weight * L):
    sorted by cap / weight, the sources before the first one whose ratio reaches
    the level of the rest are capped (from there on that level only falls, so it
    is the largest one below its ratio).
    """
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    sizes.createOrReplaceTempView("llm_mix_sizes")
    spark = sizes.sparkSession
    ranked = spark.sql("SELECT source, source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank FROM llm_mix_sizes")
    ranked = ranked.withColumn("weight", pick).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    ranked.createOrReplaceTempView("llm_mix_ranked")
    return spark.sql(f"""
        WITH run AS (
          SELECT *, {float(budget)}D * sum(source_size) OVER () AS total,
                 coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0D) AS capped,
                 sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
          FROM llm_mix_ranked),
        level AS (SELECT *, max(CASE WHEN (total - capped) / free <= cap / weight THEN (total - capped) / free END) OVER () AS water FROM run)
        SELECT source, source_size, least(cap, coalesce(weight * water, cap)) AS target FROM level""")


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, rounds, below): documents with hash < below are taken once more.

    ``rows`` has (source, hash, size).  The taken words are the largest running
    sum in hash order that does not exceed the rest of the target.
    """
    spark = rows.sparkSession
    left = targets.withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")) \
        .withColumn("left", F.col("target") - F.col("rounds") * F.col("source_size")).withColumn("prefix", F.lit(0).cast("long"))
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        inside = rows.alias("r").join(left.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source"))
                                      & (F.shiftright(F.col("r.hash"), shift + BITS) == F.col("s.prefix")))
        counts = inside.groupBy(F.col("r.source").alias("source"), F.shiftright(F.col("r.hash"), shift).alias("bucket")) \
            .agg(F.sum("r.size").alias("words"))
        counts.createOrReplaceTempView("llm_mix_histogram")
        left.createOrReplaceTempView("llm_mix_left")
        # At most 2^12 buckets a source: the window runs over the histogram, not over rows.
        left = spark.sql(f"""
            WITH run AS (
              SELECT h.source, h.bucket, h.words,
                     sum(h.words) OVER (PARTITION BY h.source ORDER BY h.bucket) AS upto FROM llm_mix_histogram h),
            edge AS (
              SELECT s.source, min(r.bucket) AS bucket, min(r.upto - r.words) AS before
              FROM llm_mix_left s JOIN run r ON r.source <=> s.source WHERE r.upto > s.left GROUP BY s.source)
            SELECT s.source, s.source_size, s.target, s.rounds,
                   s.left - coalesce(e.before, 0) AS left,
                   coalesce(e.bucket, (s.prefix + 1) * {1 << BITS}L) AS prefix
            FROM llm_mix_left s LEFT JOIN edge e ON e.source <=> s.source""")
        left = staged(left, "mix-level")  # one row a source
    return left.select("source", "source_size", "target", "rounds", F.col("prefix").alias("below"))


def _cuts(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple[float, ...], budget: float,
          most: float) -> tuple[DataFrame, DataFrame]:
    rows = staged(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                              id_hash(F.col(f"`{id_col}`")).alias("hash"), word_count(F.col(f"`{text_col}`")).alias("size")), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = staged(source_targets(sizes, weights, budget, most), "mix-targets")
    cut = thresholds(rows, targets).withColumn("most", F.lit(most))
    return rows, cut


def _copies() -> Column:
    more = F.col("rounds") + F.when(F.col("hash") < F.col("below"), 1).otherwise(0)
    return F.least(more, F.ceil("most")).cast("int")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (3, 1, 2), budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """Size, target and taken words of every row: (doc_id, source, size, source_size, target, copies, taken).

    Null and empty texts have size 0.  A null source is a source of its own; a source without words is taken whole.
    Rows that share an id share its hash: they are taken or left together, each with its own size.  An empty table
    gives an empty result; other columns are not read.
    """
    rows, cut = _cuts(docs, id_col, text_col, source_col, weights, budget, most)
    return rows.alias("r").join(cut.alias("c"), F.col("r.source").eqNullSafe(F.col("c.source"))) \
        .select("doc_id", F.col("r.source").alias("source"), "size", "source_size", "target",
                _copies().alias("copies"), (_copies() * F.col("size")).cast("long").alias("taken"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              weights: tuple[float, ...] = (3, 1, 2), budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the mix takes it, its columns unchanged.

    Texts do not move: the thresholds, one row a source, are joined to the rows.
    """
    _, cut = _cuts(docs, id_col, text_col, source_col, weights, budget, most)
    cut = cut.select(F.col("source").alias("_mix_source"), "rounds", "below", "most")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_mix_row"),
                       F.col(f"`{source_col}`").cast("string").alias("_mix_of"), id_hash(F.col(f"`{id_col}`")).alias("hash"))
    return rows.join(cut, F.col("_mix_of").eqNullSafe(F.col("_mix_source"))).withColumn("_mix_copies", _copies()) \
        .where("_mix_copies > 0").withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies")))) \
        .select(*[F.col("_mix_row").getField(c).alias(c) for c in docs.columns])

"""Typed ingestion of the CSV feeds: declared schemas, several date formats, rescued values and rejects.

A feed is a header-bearing CSV folder.  ``read_feed`` reads every column as text in
the file's own order, finds the declared columns by name, and types them: dates by
the first format that fits, numbers leniently, keys in canonical form.  Nothing is
lost silently: a value that does not fit its type is kept in ``_rescued`` (column ->
raw text) and its cell is NULL; a row that cannot be used (broken line, no date, no
key) carries the reason in ``_reject``.  ``accepted`` and ``rejected`` part the two, and
``reject_counts`` is the report.  One scan, no shuffle; undeclared columns never leave the reader.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surge.functions.columns import DATE_FORMATS, canonical_key, coerce_numeric, parse_dates
from surge.sources.stations import stack_frames

BROKEN = "_broken_line"


@dataclass(frozen=True)
class Feed:
    """A feed's declared columns; ``date`` and ``key`` must be present in every usable row, ``required`` in every file."""

    name: str
    schema: T.StructType
    date: str
    key: str
    required: tuple[str, ...]


def _feed(name: str, ddl: list[tuple[str, T.DataType]], date: str, key: str, required: Sequence[str]) -> Feed:
    return Feed(name, T.StructType([T.StructField(c, t) for c, t in ddl]), date, key, tuple(required))


_D, _S = T.DoubleType(), T.StringType()
WEATHER = _feed("weather", [("STATION", _S), ("DATE", T.DateType()), *[(c, _D) for c in (
    "AWND", "PRCP", "SNOW", "SNWD", "TMAX", "TMIN", "WDF2", "WDF5", "AWDR", "RHAV", "RHMX", "RHMN", "ADPT", "ASLP", "ASTP", "AWBT")],
    ("borough", _S), ("year", T.IntegerType())], "DATE", "borough", ["DATE", "borough"])
#: Counts stay text: their parser is the aggregation's (``coerce_numeric``).
VISITS = _feed("visits", [("Date", T.DateType()), ("Dim1Value", _S), ("Count", _S)], "Date", "Dim1Value", ["Date", "Dim1Value", "Count"])
AIR_QUALITY = _feed("air_quality", [("Start_Date", T.DateType()), ("Geo Place Name", _S), ("Name", _S), ("Data Value", _D)],
                    "Start_Date", "Geo Place Name", ["Start_Date", "Geo Place Name", "Name", "Data Value"])


def write_feed(df: DataFrame, path: str) -> None:
    """Land rows as a header-bearing CSV folder (quotes doubled, as spreadsheets write them)."""
    df.write.mode("errorifexists").option("header", True).option("escape", '"').option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)


def header(spark: SparkSession, path: str) -> list[str]:
    """The column names of a CSV folder, from its first line."""
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


def _typed(c: Column, kind: T.DataType, formats: Sequence[str]) -> Column:
    if isinstance(kind, T.DateType):
        return parse_dates(c, formats)
    if isinstance(kind, T.NumericType):
        number = coerce_numeric(c)
        return number if isinstance(kind, T.DoubleType) else number.try_cast(kind)
    return c


def read_feed(spark: SparkSession, path: str, feed: Feed, *, formats: Sequence[str] = DATE_FORMATS, strict: bool = True) -> DataFrame:
    """The feed's declared columns that the files have, typed, with ``_rescued`` (map) and ``_reject`` (reason or NULL).

    ``strict``: a file without a required column raises; otherwise the column is absent from the result, and rows
    without its value count as rejected if it is the date or the key.  Extra columns are not read.  Lines with fewer or
    more cells than the header, or broken quotes, are rejected as ``broken line``.
    """
    names = header(spark, path)
    missing = [c for c in feed.required if c not in names]
    if missing and strict:
        raise ValueError(f"feed {feed.name}: missing columns {missing}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*names, BROKEN]])
    raw = spark.read.schema(text).option("header", True).option("escape", '"').option("mode", "PERMISSIVE") \
        .option("columnNameOfCorruptRecord", BROKEN).option("columnPruning", False).csv(path)  # broken lines show only when all cells are parsed
    present = [f for f in feed.schema.fields if f.name in names]
    return typed_rows(raw.select(*[F.col(f"`{f.name}`") for f in present], BROKEN), feed, formats=formats)


def read_feeds(spark: SparkSession, paths: Sequence[str], feed: Feed, *, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Several folders of one feed whose files may lack different columns (stations, years), stacked; a missing column is NULL."""
    return stack_frames([read_feed(spark, p, feed, formats=formats, strict=False) for p in paths])


def typed_rows(raw: DataFrame, feed: Feed, *, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Text rows (and ``_broken_line``, where there is one) in the feed's types, with ``_rescued`` and ``_reject``."""
    present = [f for f in feed.schema.fields if f.name in raw.columns]
    # Typed in a step of their own: each value is parsed once, though the value, its rescue and the reject ask for it.
    cells = raw.select("*", *[_typed(F.col(f"`{f.name}`"), f.dataType, formats).alias(f"_typed {f.name}") for f in present])
    typed = {f.name: F.col(f"`_typed {f.name}`") for f in present}

    def empty(name: str) -> Column:
        return F.trim(F.col(f"`{name}`")) == ""

    bad = [F.when(F.col(f"`{f.name}`").isNotNull() & ~empty(f.name) & typed[f.name].isNull(),
                  F.struct(F.lit(f.name).alias("key"), F.col(f"`{f.name}`").alias("value")))
           for f in present if not isinstance(f.dataType, T.StringType)]
    found = F.array_compact(F.array(*bad)) if bad else F.array()
    rescued = F.when(F.size(found) > 0, F.map_from_entries(found)) if bad else F.lit(None).cast("map<string,string>")
    broken = F.col(BROKEN).isNotNull() if BROKEN in raw.columns else F.lit(False)

    def lacks(name: str, label: str) -> Column:
        if name not in typed:
            return F.lit(f"no {label}")
        blank = F.coalesce(empty(name), F.lit(True))
        return F.when(blank, F.lit(f"no {label}")).when(typed[name].isNull(), F.lit(f"bad {label}"))

    reject = F.coalesce(F.when(broken, F.lit("broken line")), lacks(feed.date, "date"), lacks(feed.key, "key"))
    values = {n: canonical_key(c) if n == feed.key else c for n, c in typed.items()}
    return cells.select(*[c.alias(n) for n, c in values.items()], rescued.alias("_rescued"), reject.alias("_reject"))


def accepted(df: DataFrame) -> DataFrame:
    """The usable rows, in the feed's columns."""
    return df.where(F.col("_reject").isNull()).drop("_rescued", "_reject")


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col("_reject").isNotNull())


def reject_counts(df: DataFrame) -> DataFrame:
    """(issue, n_rows): rejected rows by reason, and accepted rows with a rescued value by column."""
    why = F.when(F.col("_reject").isNotNull(), F.array("_reject")).otherwise(
        F.transform(F.map_keys(F.coalesce("_rescued", F.create_map().cast("map<string,string>"))), lambda c: F.concat(F.lit("rescued "), c)))
    return df.select(F.explode(why).alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("n_rows"))

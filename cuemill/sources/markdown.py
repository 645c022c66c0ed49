"""Tables and sections of markdown texts, and JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Heading of the glossary section and the first cell of its header.
GLOSSARY_HEADING = "人物与专有名词"
HEADER_CELLS = ("原文", "原名", "Source", "source")


def section(text: Column, heading: str) -> Column:
    """What stands under a ## heading, up to the next one; empty if it isn't there."""
    return F.regexp_extract(text, rf"(?ms)^##[ \t]+\Q{heading}\E[ \t]*$\n?(.*?)(?=^##\s|\z)", 1)


def cells(row: Column) -> Column:
    inner = F.regexp_extract(row, r"^\|(.+)\|\s*$", 1)
    return F.transform(F.split(inner, r"\|"), lambda x: F.trim(x))


def glossary(files: DataFrame, key: str, text: str, heading: str = GLOSSARY_HEADING) -> DataFrame:
    """(key, ord, source, target) of the rows of the glossary section's tables."""
    rows = files.select(key, F.posexplode(F.split(section(F.col(text), heading), "\n")).alias("ord", "row"))
    rows = rows.where(F.col("row").rlike(r"^\|(.+)\|\s*$") & ~F.col("row").rlike(r"^[\s|:-]+$")).withColumn("c", cells(F.col("row")))
    named = rows.where((F.size("c") >= 2) & ~F.get("c", F.lit(0)).isin(*HEADER_CELLS))
    return named.select(key, "ord", F.get("c", F.lit(0)).alias("source"), F.get("c", F.lit(1)).alias("target"))


def manifest(files: DataFrame, key: str, text: str) -> DataFrame:
    """(key, ord, action, source, destination, commit_message): the rows that follow the first separator without a gap."""
    lines = files.select(key, F.split(text, "\n").alias("l"))
    after = F.expr("slice(l, array_position(transform(l, x -> x rlike '^[\\\\s|:-]*-[\\\\s|:-]*$' and x like '%|%'), true) + 1, size(l))")
    cut = lines.select(key, F.when(F.array_position(F.transform("l", lambda x: x.rlike(r"^[\s|:-]*-[\s|:-]*$") & x.contains("|")), True) > 0, after).alias("l"))
    run = F.aggregate("l", F.struct(F.array().cast("array<string>").alias("rows"), F.lit(True).alias("on")), lambda a, x: F.struct(F.when(a["on"] & x.rlike(r"^\|(.+)\|\s*$"), F.concat(a["rows"], F.array(x))).otherwise(a["rows"]).alias("rows"), (a["on"] & x.rlike(r"^\|(.+)\|\s*$")).alias("on")), lambda a: a["rows"])
    rows = cut.where(F.col("l").isNotNull()).select(key, F.posexplode(run).alias("ord", "row")).withColumn("c", cells(F.col("row"))).where(F.size("c") >= 4)
    return rows.select(key, "ord", *[F.get("c", F.lit(i)).alias(n) for i, n in enumerate(("action", "source", "destination", "commit_message"))])


def json_lines(spark: SparkSession, path: str, schema: str, order: tuple[str, ...] = ("seq", "direction")) -> DataFrame:
    """Recorded calls in the order of their number, then direction; blank lines don't count."""
    rows = spark.read.text(path).where(F.trim("value") != "")
    out = rows.select(F.from_json("value", schema).alias("r")).select("r.*")
    return out.orderBy(*[c for c in order if c in out.columns])

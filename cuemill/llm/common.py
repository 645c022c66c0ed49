"""Shared pieces of the training-data operators: tables, languages, splitting, spreading."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LANGS = ("en", "zh", "fr", "de", "es", "pt", "ru", "ja")

#: ISO 639 codes and English names of the languages in scope.
LANGUAGE_NAMES = {
    "en": ("en", "eng", "english"),
    "zh": ("zh", "zho", "chi", "cmn", "yue", "chinese", "mandarin"),
    "fr": ("fr", "fra", "fre", "french"),
    "de": ("de", "deu", "ger", "german"),
    "es": ("es", "spa", "spanish", "castilian"),
    "pt": ("pt", "por", "portuguese"),
    "ru": ("ru", "rus", "russian"),
    "ja": ("ja", "jpn", "japanese"),
}
_CODE_OF = {name: code for code, names in LANGUAGE_NAMES.items() for name in names}

#: A time line of a numbered caption block.
TIME_LINE = re.compile(r"^\s*\d{1,3}:\d{2}:\d{2}[,.]\d{1,3}\s*-->\s*\d{1,3}:\d{2}:\d{2}[,.]\d{1,3}.*$")


def language_code(column):
    """Column: the two-letter code that a language tag or name stands for; null if none of LANGS."""
    base = F.lower(F.trim(F.split(column, "[-_]").getItem(0)))
    table = F.create_map(*[F.lit(x) for pair in _CODE_OF.items() for x in pair])
    return F.try_element_at(table, base)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Uses the shared folder that the session names; sets a local one only where none is named (tests)."""
    context = spark.sparkContext
    if spark.conf.get("spark.checkpoint.dir", None) is None and context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cuemill-"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Splits a scan of a few large files over the cores when per-row work is heavy; a scan of enough splits stays as it is.

    The size comes from the plan's statistics: nothing runs while the plan is built."""
    session = df.sparkSession
    cores = session.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = session._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if size >= 4 * cores * split:
        return df
    return df.repartition(max(2 * cores, int(session.conf.get("spark.sql.shuffle.partitions"))), *keys)


def batches(frames: Iterator, rows: int) -> Iterator:
    """Cuts incoming pandas frames so that the arrays of one step stay small."""
    for frame in frames:
        for at in range(0, len(frame), rows):
            yield frame.iloc[at : at + rows]

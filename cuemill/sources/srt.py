"""Subtitle files: bytes to text, text to cues, cues to text and bytes."""

from __future__ import annotations

import codecs

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions import rules as R

#: Byte order marks, longer ones first, and the encodings tried after UTF-8.
MARKS = ((codecs.BOM_UTF32_LE, "utf-32-le"), (codecs.BOM_UTF32_BE, "utf-32-be"), (codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
FALLBACKS = ("cp1252", "gb18030", "big5", "shift_jis", "euc-kr", "iso-8859-1")
#: A time line, and where a file of an edition and language lies.
TIME_LINE = r"(\d{2}:\d{2}:\d{2}[,.]\d{3})\s*-->\s*(\d{2}:\d{2}:\d{2}[,.]\d{3})"
PATH = r"subtitles/([^/]+)/work/source/([^/]+)\.srt$"


def decode(raw: bytes) -> tuple[str, str, bool]:
    """(text, encoding, had a byte order mark); undecodable bytes become U+FFFD at the very end of the trials."""
    for mark, name in MARKS:
        if raw.startswith(mark):
            return raw[len(mark) :].decode(name.removesuffix("-sig"), "replace"), name, True
    for name in ("utf-8", *FALLBACKS):
        try:
            return raw.decode(name), name, False
        except UnicodeDecodeError:
            continue
    return raw.decode("utf-8", "replace"), "utf-8", False


def encode(text: str, encoding: str, mark: bool, newline: str) -> bytes:
    """The bytes of a text; UTF-8 where the encoding is unknown or lacks a character."""
    text = text.replace("\n", {"crlf": "\r\n", "cr": "\r"}.get(newline, "\n"))
    name = encoding.removesuffix("-sig")
    try:
        raw = text.encode(name)
    except (LookupError, UnicodeEncodeError):
        name, raw = "utf-8", text.encode("utf-8")
    marks = {n.removesuffix("-sig"): m for m, n in MARKS}
    return (marks.get(name, b"") if mark else b"") + raw


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("encoding", T.StringType()), T.StructField("bom", T.BooleanType())]))
def decoded(contents: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([(None, None, None) if x is None else decode(bytes(x)) for x in contents], columns=["text", "encoding", "bom"])


@F.pandas_udf(T.BinaryType())
def encoded(texts: pd.Series, encodings: pd.Series, marks: pd.Series, newlines: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else encode(t, e or "utf-8", bool(m), n or "lf") for t, e, m, n in zip(texts, encodings, marks, newlines)])


def read(spark: SparkSession, folder: str, edition: str | None = None, lang: str | None = None) -> DataFrame:
    """Files under a folder as rows: path, edition, lang, text, encoding, bom, newline. Filters go to the listing before a byte is read."""
    glob = f"{folder}/subtitles/{edition or '*'}/work/source/{lang or '*'}.srt"
    raw = spark.read.format("binaryFile").load(glob)
    one = raw.select("path", F.regexp_extract("path", PATH, 1).alias("edition"), F.regexp_extract("path", PATH, 2).alias("lang"), decoded("content").alias("d"))
    return one.select("path", "edition", "lang", "d.text", "d.encoding", "d.bom", C.newline_style(F.col("d.text")).alias("newline"))


def editions(spark: SparkSession, folder: str) -> DataFrame:
    listed = spark.read.format("binaryFile").load(f"{folder}/subtitles/*/*").select(F.regexp_extract("path", r"subtitles/([^/]+)/", 1).alias("edition"))
    return listed.distinct()


def cues(files: DataFrame, key: str, text: str, sdh: bool = False) -> DataFrame:
    """Cues of each file: key, cue_id, start_time, end_time, start_ms, end_ms, lines, text, dropped, stripped.

    Blocks are parted by blank lines; the time line is a block's first or second; numbers in the file don't count, and
    neither does a cue without text, whose id the next one gets. A file's cues lie in one array of its own text, so
    ids need no shuffle."""
    plain = F.regexp_replace(F.regexp_replace(F.col(text), "\r\n", "\n"), "\r", "\n")
    blocks = F.split(F.regexp_replace(plain, r"^\s+|\s+$", ""), r"\n[^\S\n]*(?:\n[^\S\n]*)*\n")
    first = files.select(key, F.posexplode(blocks).alias("pos", "block")).withColumn("l", F.split(F.regexp_replace("block", r"^\n+|\n+$", ""), "\n"))
    at = F.when(F.get("l", F.lit(0)).rlike(TIME_LINE), 0).when(F.get("l", F.lit(1)).rlike(TIME_LINE), 1)
    timed = first.withColumn("at", at).where(F.col("at").isNotNull()).withColumn("time", F.get("l", F.col("at")))
    raw = F.slice("l", F.col("at") + 2, F.size("l"))
    body = F.filter(F.transform(raw, lambda x: C.collapse(C.keep_style_tags(x))), lambda x: x != "")
    rows = timed.withColumn("before", body)
    rows = rows.withColumn("lines", R.clean_cue("before") if sdh else F.col("before"))
    rows = rows.select(key, "pos", F.regexp_extract("time", TIME_LINE, 1).alias("start_time"), F.regexp_extract("time", TIME_LINE, 2).alias("end_time"), "lines", C.collapse_style_wraps(F.array_join("lines", " ")).alias("text"), (F.col("lines") != F.col("before")).alias("changed"))
    # one array per file gives the ids after empty cues are out; it is no larger than the file was
    whole = rows.groupBy(key).agg(
        F.array_sort(F.collect_list(F.when(F.col("text") != "", F.struct("pos", "start_time", "end_time", "lines", "text")))).alias("c"),
        F.count(F.when(F.col("changed") & (F.col("text") == ""), 1)).alias("dropped"),
        F.count(F.when(F.col("changed") & (F.col("text") != ""), 1)).alias("stripped"),
    )
    out = whole.select(key, "dropped", "stripped", F.posexplode("c").alias("i", "c"))
    return out.select(key, (F.col("i") + 1).alias("cue_id"), "c.start_time", "c.end_time", C.time_ms(F.col("c.start_time")).alias("start_ms"), C.time_ms(F.col("c.end_time")).alias("end_ms"), "c.lines", "c.text", "dropped", "stripped")


def render(cues_: DataFrame, key: str) -> DataFrame:
    """SRT text of each file: (key, content). A cue's translation stands above its text; null is no translation, positions count from 1."""
    time = lambda c: F.replace(c, F.lit("."), F.lit(","))
    body = F.when(F.col("translation").isNull(), F.col("text")).otherwise(F.concat_ws("\n", "translation", "text"))
    block = F.struct("cue_id", time(F.col("start_time")).alias("s"), time(F.col("end_time")).alias("e"), body.alias("b"))
    files = cues_.groupBy(key).agg(F.array_sort(F.collect_list(block)).alias("c"))
    numbered = F.transform("c", lambda x, i: F.concat((i + 1).cast("string"), F.lit("\n"), x["s"], F.lit(" --> "), x["e"], F.lit("\n"), x["b"]))
    return files.select(key, F.concat(F.array_join(numbered, "\n\n"), F.lit("\n")).alias("content"))


def write(rendered: DataFrame, folder: str, path: str = "path") -> int:
    """Writes files (path, content, encoding, bom, newline) into a folder, in their own encoding; gives their number. A file written twice is the same."""
    import os

    ready = rendered.select(path, encoded("content", "encoding", "bom", "newline").alias("raw"))

    def save(rows):
        for row in rows:
            target = os.path.join(folder, row[path])
            os.makedirs(os.path.dirname(target), exist_ok=True)
            part = f"{target}.part-{os.getpid()}"
            with open(part, "wb") as file:
                file.write(bytes(row["raw"]))
            os.replace(part, target)

    ready.foreachPartition(save)
    return rendered.count()

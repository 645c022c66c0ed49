"""Command line: python -m cuemill units|render|query ... Each command is one plan from folder to folder."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def units(spark: SparkSession, args: argparse.Namespace) -> None:
    """Subtitle files of a folder (subtitles/EDITION/work/source/LANG.srt) as translation units."""
    from .plans import subtitles
    from .sources import srt

    files = srt.read(spark, args.folder, args.edition, args.lang)
    cues = srt.cues(files, "path", "text", sdh=args.sdh).join(files.select("path", "lang"), "path")
    subtitles.units(cues, "path", F.col("lang")).write.mode("overwrite").parquet(args.output)


def render(spark: SparkSession, args: argparse.Namespace) -> None:
    """Cues (file_id, cue_id, start_time, end_time, text, translation) as subtitle texts, a row a file."""
    from .sources import srt

    srt.render(spark.read.parquet(args.cues), args.key).write.mode("overwrite").parquet(args.output)


def query(spark: SparkSession, args: argparse.Namespace) -> None:
    """A registered query over a folder of tables."""
    from .plans import registry

    found = registry.queries()
    if args.name not in found:
        raise SystemExit(f"no query {args.name}; there are {', '.join(sorted(found))}")
    found[args.name](spark, args.tables).write.mode("overwrite").parquet(args.output)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="cuemill", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("units", help=units.__doc__)
    one.add_argument("folder")
    one.add_argument("output")
    one.add_argument("--edition")
    one.add_argument("--lang")
    one.add_argument("--sdh", action="store_true", help="take out sound descriptions and speaker labels")
    one.set_defaults(run=units)
    two = commands.add_parser("render", help=render.__doc__)
    two.add_argument("cues")
    two.add_argument("output")
    two.add_argument("--key", default="file_id")
    two.set_defaults(run=render)
    three = commands.add_parser("query", help=query.__doc__)
    three.add_argument("name")
    three.add_argument("tables")
    three.add_argument("output")
    three.set_defaults(run=query)
    args = parser.parse_args(argv)
    args.run(SparkSession.builder.appName("cuemill").getOrCreate(), args)


if __name__ == "__main__":
    main()

"""Which film a request means: by an id that was typed in, by the links of its page, or by its repository's name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import rules as R
from ..operators import lookup

#: Fixed value: where an id fits several kinds, the first of these holds.
MEDIA_TYPES = ("movie", "tv")
FIELDS = ("media_type", "tmdb_id", "imdb_id", "title_en", "title_zh", "year")


def identities(requests: DataFrame, manual: str, readme: str, repo_name: str) -> DataFrame:
    """Adds kind (tmdb, imdb, name or null), media_type, value: a typed id goes before the page's links (TMDB before IMDb), these before the name."""
    typed, linked = C.manual_id(F.col(manual)), C.readme_ids(F.col(readme))
    by_hand = F.coalesce(F.trim(manual) != "", F.lit(False))
    by_page = linked["tmdb_id"].isNotNull()
    kind = F.when(by_hand, typed["kind"]).when(by_page, "tmdb").when(linked["imdb_id"].isNotNull(), "imdb").when(F.col(repo_name).isNotNull(), "name")
    value = F.when(by_hand, typed["value"]).when(by_page, linked["tmdb_id"]).when(linked["imdb_id"].isNotNull(), linked["imdb_id"]).otherwise(F.col(repo_name))
    lacking = F.when(by_hand & typed["kind"].isNull(), "invalid_repo_name").when(kind.isNull(), "readme_not_found")
    return requests.withColumns({"kind": kind, "media_type": F.when(~by_hand & by_page, linked["media_type"]), "value": value, "lacking": lacking})


def entities(identified: DataFrame, catalogue: DataFrame, key: str) -> DataFrame:
    """(key, success, reason, FIELDS, canonical_repo_name) of each request, from a catalogue of FIELDS.

    An id that no kind knows is a failed call (network_error), an IMDb id without entry is not_found; names are searched
    by likeness, and must then agree in title and year. The canonical name is given where a name is another one."""
    rank = F.coalesce(*[F.when(F.col("c.media_type") == m, F.lit(k)) for k, m in enumerate(MEDIA_TYPES)], F.lit(len(MEDIA_TYPES)))
    asked, known = identified.alias("a"), catalogue.select(*FIELDS).alias("c")

    def first(on, kind: str) -> DataFrame:
        own = asked.where(F.col("kind") == kind).join(known, on)
        return own.groupBy(f"a.{key}").agg(F.min_by(F.struct(*[f"c.{x}" for x in FIELDS]), F.struct(rank, "c.tmdb_id")).alias("found"))

    by_tmdb = first((F.try_to_number("a.value", F.lit("999999999999")).cast("bigint") == F.col("c.tmdb_id")) & (F.col("a.media_type").isNull() | (F.col("a.media_type") == F.col("c.media_type"))), "tmdb")
    by_imdb = first(F.col("a.value") == F.col("c.imdb_id"), "imdb")
    ids = asked.where(F.col("kind").isin("tmdb", "imdb") | F.col("kind").isNull()).join(by_tmdb.unionByName(by_imdb), key, "left")
    reason = F.when(F.col("lacking").isNotNull(), F.col("lacking")).when(F.col("found").isNull(), F.when(F.col("kind") == "tmdb", C.http_reason(F.lit(404))).otherwise("not_found"))
    done = ids.select(key, reason.isNull().alias("success"), reason.alias("reason"), *[F.col(f"found.{x}").alias(x) for x in FIELDS], F.lit(None).cast("string").alias("canonical_repo_name"))

    names = identified.where(F.col("kind") == "name").withColumn("p", C.parse_repo_name(F.col("value"))).select(F.col(key).alias("_request"), "value", "p.title", "p.year", "p.strict")
    entries = catalogue.select(F.col("tmdb_id").alias("id"), F.col("title_en").alias("name"), F.col("year").alias("released"))
    found = names.join(lookup.best_titles(names, entries, "_request"), "_request", "left")
    judged = lookup.resolution(found, "_request").alias("j").join(catalogue.select(*FIELDS).dropDuplicates(["tmdb_id"]).alias("c"), F.col("j.id") == F.col("c.tmdb_id"), "left")
    good, canonical = F.col("j.reason").isNull(), F.concat_ws("_", F.regexp_replace(R.safe("j.name"), r"\s+", "_"), F.col("j.released").cast("string"))
    by_name = judged.select(F.col("j._request").alias(key), good.alias("success"), "j.reason", *[F.when(good, F.col(f"c.{x}")).alias(x) for x in FIELDS], F.when(good & (canonical != F.col("j.value")), canonical).alias("canonical_repo_name"))
    return done.unionByName(by_name)

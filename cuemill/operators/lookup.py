"""Joins with small reference data, name matching and candidate ranking."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import rules as R
from .ordered import ranks, settled

#: Code that a subtitle site gives each language, where it isn't the three-letter code of the same name.
SITE_CODE_OF = {
    "sq": "alb", "ar": "ara", "hy": "arm", "az": "aze", "eu": "baq", "be": "bel", "bn": "ben", "bs": "bos", "bg": "bul", "my": "bur",
    "ca": "cat", "zh": "chi", "hr": "hrv", "cs": "cze", "da": "dan", "nl": "dut", "en": "eng", "eo": "epo", "et": "est", "fi": "fin",
    "fr": "fre", "gl": "glg", "ka": "geo", "de": "ger", "el": "gre", "gu": "guj", "he": "heb", "hi": "hin", "hu": "hun", "is": "ice",
    "id": "ind", "ga": "gle", "it": "ita", "ja": "jpn", "kn": "kan", "kk": "kaz", "km": "khm", "ko": "kor", "ku": "kur", "ky": "kir",
    "lo": "lao", "la": "lat", "lv": "lav", "lt": "lit", "lb": "ltz", "mk": "mac", "ms": "may", "ml": "mal", "mt": "mlt", "mr": "mar",
    "mn": "mon", "ne": "nep", "no": "nor", "or": "ori", "fa": "per", "pl": "pol", "pt": "por", "pa": "pan", "ro": "rum", "ru": "rus",
    "sr": "srp", "si": "sin", "sk": "slo", "sl": "slv", "so": "som", "es": "spa", "sw": "swa", "sv": "swe", "tl": "tgl", "tg": "tgk",
    "ta": "tam", "tt": "tat", "te": "tel", "th": "tha", "bo": "tib", "tr": "tur", "tk": "tuk", "uk": "ukr", "ur": "urd", "uz": "uzb",
    "vi": "vie", "cy": "wel", "af": "afr", "am": "amh", "as": "asm", "br": "bre", "fy": "fry", "gd": "gla", "ha": "hau", "ig": "ibo",
    "ps": "pus", "sa": "san", "xh": "xho", "yo": "yor", "zu": "zul",
}
#: What a title search must reach.
LEAST_SIMILARITY, YEAR_TOLERANCE, LEAST_SCORE = 0.5, 1, 0.4


def site_code(tag: Column) -> Column:
    return F.try_element_at(C.literal_map(SITE_CODE_OF), C.primary_subtag(tag))


def checked_broadcast(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """Broadcasts a side whose row count is within the bound; else the join shuffles it."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def language_index(languages: DataFrame) -> DataFrame:
    """(key, code, rank): every tag stands for itself; its base stands for the base's own entry, else for the first tag of that base."""
    own = languages.select(F.lower(F.replace("tag", F.lit("_"), F.lit("-"))).alias("tag"), "code", "ord")
    exact = own.select(F.col("tag").alias("key"), "code", F.lit(0).alias("rank"))
    base = own.withColumn("key", F.split("tag", "-").getItem(0))
    first = base.groupBy("key").agg(F.min_by("code", F.struct(F.col("tag") != F.col("key"), "ord")).alias("code")).select("key", "code", F.lit(1).alias("rank"))
    return exact.unionByName(first).groupBy("key").agg(F.min_by("code", "rank").alias("code"))


#: Older tags and what they are called now.
LEGACY_TAGS = {
    "tl": "fil", "lug": "lg", "mww": "hmn", "kmr": "ku", "zh-cn": "zh-Hans", "zh-sg": "zh-Hans", "zh-tw": "zh-Hant", "zh-hk": "zh-Hant", "zh-mo": "zh-Hant", "nb": "no", "nn": "no",
    "iw": "he", "jw": "jv", "nya": "ny", "run": "rn", "mni": "mni-Mtei", "sr-cyrl": "sr", "mn-cyrl": "mn", "in": "id",
}


def resolve_languages(tags: DataFrame, column: str, index: DataFrame) -> DataFrame:
    """Adds provider_code: of what the tag is called now, else of its base."""
    small = checked_broadcast(index)
    given = F.lower(F.replace(F.trim(column), F.lit("_"), F.lit("-")))
    low = F.coalesce(F.lower(F.try_element_at(C.literal_map(LEGACY_TAGS), given)), given)
    one = tags.withColumn("_tag", low).withColumn("_base", F.split(low, "-").getItem(0))
    exact = one.join(small.select(F.col("key").alias("_tag"), F.col("code").alias("_exact")), "_tag", "left")
    return exact.join(small.select(F.col("key").alias("_base"), F.col("code").alias("_by_base")), "_base", "left").withColumn("provider_code", F.coalesce("_exact", "_by_base")).drop("_tag", "_base", "_exact", "_by_base")


def glossary_hits(texts: DataFrame, key: str, text: str, glossary: list[tuple[str, str]]) -> DataFrame:
    """One row per hit of a glossary term: key, start, end, matched, target."""
    return texts.select(key, F.explode(R.glossary_matches(glossary)(text)).alias("m")).select(key, "m.start", "m.end", "m.matched", "m.target")


def contained_matches(matches: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """Matches that lie inside a span of their unit, with offsets in the span: an equality on the unit and a range."""
    m, s = matches.alias("m"), spans.alias("s")
    inside = (F.col(f"m.{key}") == F.col(f"s.{key}")) & (F.col("s.start") <= F.col("m.start")) & (F.col("m.end") <= F.col("s.end"))
    return m.join(s, inside).select(F.col(f"m.{key}").alias(key), F.col("s.span_no").alias("span_no"), (F.col("m.start") - F.col("s.start")).alias("start"), (F.col("m.end") - F.col("s.start")).alias("end"), F.col("m.matched").alias("matched"))


def forced_words(targets: Column) -> Column:
    """Distinct Latin words of two letters or more inside glossary targets."""
    return F.array_distinct(F.flatten(F.transform(targets, lambda t: F.regexp_extract_all(t, F.lit("[A-Za-z]{2,}"), 0))))


def name_key(c: Column) -> Column:
    return F.lower(C.collapse(F.coalesce(c, F.lit(""))))


def without_known(people: DataFrame, name: str, known: DataFrame, known_name: str) -> DataFrame:
    """People whose name is not among the known ones; case and spacing don't count."""
    keys = known.select(name_key(F.col(known_name)).alias("_key")).distinct()
    return people.withColumn("_key", name_key(F.col(name))).join(keys, "_key", "left_anti").drop("_key")


def topics(media_type: Column, title: Column, by_type: dict[str, list[str]], default: str) -> Column:
    """Topic list of the media type, and the title's slug if it isn't there."""
    listed = F.coalesce(*[F.when(media_type == k, F.array(*map(F.lit, v))) for k, v in by_type.items()], F.array(*map(F.lit, by_type[default])))
    return F.array_distinct(F.array_union(listed, F.filter(F.array(C.slug(title)), lambda x: x != "")))


def name_pairs(original: Column, translated: Column) -> Column:
    """array<struct<term, target>>: the whole names, and their first parts if both have as many parts, two at least."""
    a, b = F.split(F.trim(original), r"\s+"), F.split(F.trim(translated), "[·・]")
    first = F.struct(a.getItem(0).alias("term"), b.getItem(0).alias("target"))
    whole = F.struct(F.trim(original).alias("term"), F.trim(translated).alias("target"))
    return F.when((F.size(a) == F.size(b)) & (F.size(a) >= 2), F.array(whole, first)).otherwise(F.array(whole))


def glossary_from_pairs(rows: DataFrame, order: str = "ord") -> DataFrame:
    """(term, target, ord): the first definition of a term holds."""
    each = rows.select(order, F.posexplode(name_pairs(F.col("source"), F.col("target"))).alias("k", "p")).select(F.col("p.term").alias("term"), F.col("p.target").alias("target"), F.struct(order, "k").alias("at"))
    return each.where(F.col("term") != "").groupBy("term").agg(F.min_by("target", "at").alias("target"), F.min("at").alias("at")).select("term", "target", F.col(f"at.{order}").alias(order))


# ---- catalogues ----
def ranked_candidates(candidates: DataFrame, key: str) -> DataFrame:
    """Adds place: by score (none is 0), then by how often the id occurs, then in the given order ``pos``."""
    often = candidates.groupBy(key, "id").agg(F.count("*").alias("_n"))
    joined = candidates.join(often, [key, "id"])
    return ranks(joined, [key], [-F.coalesce("score", F.lit(0.0)), -F.col("_n"), F.col("pos")]).drop("_n")


def candidate_status(candidates: DataFrame, key: str) -> DataFrame:
    """(key, id, status): success if the best score suffices, or if no score is given and one id stands alone; else low_confidence. One pass of aggregation."""
    often = candidates.groupBy(key, "id").agg(F.count("*").alias("n"), F.max(F.coalesce("score", F.lit(0.0))).alias("top"))
    best = candidates.join(often, [key, "id"]).groupBy(key).agg(
        F.min_by(F.struct("id", "score"), F.struct(-F.coalesce("score", F.lit(0.0)), -F.col("n"), "pos")).alias("b"), F.count_distinct("id").alias("ids")
    )
    good = F.when(F.col("b.score").isNotNull(), F.col("b.score") >= LEAST_SCORE).otherwise(F.col("ids") == 1)
    return best.select(key, F.col("b.id").alias("id"), F.when(good, "success").otherwise("low_confidence").alias("status"))


#: What a subject page adds to its title.
PAGE_SUFFIX = r"\s*-\s*(?:电影|电视剧|剧集|综艺|纪录片)\s*(?:-\s*豆瓣\s*)?$"


def evaluated(candidates: DataFrame, hints: DataFrame, key: str) -> DataFrame:
    """(key, status, ids): success with the best candidate if it is sure; else by titles: one id of an exact title is a success, several are ambiguous, and so are those of a partial title; else none.

    Candidates are (key, id, title, score, pos), hints (key, hints array<string>). The ids stand in the order of the best
    candidate of each. All steps aggregate; a key's ids meet in one row only as the answer does."""
    sure = candidate_status(candidates, key).where(F.col("status") == "success").select(key, F.col("id").alias("_sure"))
    often = candidates.groupBy(key, "id").agg(F.count("*").alias("_n"))
    bare = C.sub(F.coalesce("title", F.lit("")), PAGE_SUFFIX, "")
    kinds = F.transform(F.filter("hints", lambda h: h.isNotNull() & (h != "")), lambda h: group_match(h, bare))
    matched = candidates.join(often, [key, "id"]).join(hints, key, "left").withColumn("_kind", F.when(F.array_contains(kinds, "exact"), 0).when(F.array_contains(kinds, "partial"), 1))
    order = F.struct(-F.coalesce("score", F.lit(0.0)), -F.col("_n"), F.col("pos"))
    each = matched.where(F.col("_kind").isNotNull()).groupBy(key, "_kind", "id").agg(F.min(order).alias("at"))
    lists = each.groupBy(key, "_kind").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "id"))), lambda x: x["id"]).alias("ids"))
    both = lists.groupBy(key).agg(F.min_by("ids", "_kind").alias("ids"), F.min("_kind").alias("_kind"))
    all_ = candidates.select(key).distinct().join(sure, key, "left").join(both, key, "left")
    status = F.when(F.col("_sure").isNotNull(), "success").when((F.col("_kind") == 0) & (F.size("ids") == 1), "success").when(F.col("_kind").isNotNull(), "ambiguous").otherwise("none")
    ids = F.when(F.col("_sure").isNotNull(), F.array("_sure")).otherwise(F.coalesce("ids", F.array().cast("array<string>")))
    return all_.select(key, status.alias("status"), ids.alias("ids"))


def with_fallback(requests: DataFrame, first: DataFrame, second: DataFrame, hints: DataFrame, errors: DataFrame, key: str) -> DataFrame:
    """(key, success, id, reason, ids) of each request: the second provider's candidates count only where the first one's give nothing, and then together with them.

    errors are (key, type). Without any candidate the reason is the error, multiple_errors if they differ, else not_found."""
    one = evaluated(first, hints, key)
    open_ = requests.select(key).distinct().join(one.where(F.col("status") != "none"), key, "left_anti")
    # places of the second provider follow those of the first
    more = first.join(open_, key, "left_semi").unionByName(second.join(open_, key, "left_semi").withColumn("pos", F.col("pos") + F.lit(1 << 32)))
    two = evaluated(more, hints, key)
    found = one.where(F.col("status") != "none").unionByName(two)
    none_at_all = open_.join(more.select(key).distinct(), key, "left_anti")
    why = errors.join(none_at_all, key, "left_semi").groupBy(key).agg(F.when(F.count_distinct("type") == 1, F.first("type")).otherwise("multiple_errors").alias("error"))
    out = requests.select(key).distinct().join(found, key, "left").join(why, key, "left")
    success = F.coalesce(F.col("status") == "success", F.lit(False))
    reason = F.when(success, F.lit(None)).when(F.coalesce("status", F.lit("none")) == "none", F.coalesce("error", F.lit("not_found"))).otherwise("low_confidence")
    return out.select(key, success.alias("success"), F.when(success, F.get("ids", F.lit(0))).alias("id"), reason.alias("reason"), F.when(success | F.col("ids").isNull(), F.array().cast("array<string>")).otherwise(F.col("ids")).alias("ids"))


def title_groups(c: Column) -> Column:
    """Runs of word characters in lower case; digits at the end of the last run stand alone."""
    plain = F.lower(c)
    parted = C.sub(plain, r"([\p{L}_])(\p{N}+)[^\p{L}\p{N}_]*$", "$1 $2")
    return F.filter(F.split(parted, r"[^\p{L}\p{N}_]+"), lambda x: x != "")


def group_match(hint: Column, candidate: Column) -> Column:
    """exact, partial (all but the last of the shorter agree) or none."""
    a, b = title_groups(hint), title_groups(candidate)
    n = F.least(F.size(a), F.size(b)) - 1
    return F.when(a == b, "exact").when((n > 0) & (F.slice(a, 1, F.greatest(n, F.lit(1))) == F.slice(b, 1, F.greatest(n, F.lit(1)))), "partial").otherwise("none")


#: Titles of one search: as many wanted ones against as many entries, of the years that fit.
CELL = (256, 8192)


def best_titles(wanted: DataFrame, catalogue: DataFrame, key: str) -> DataFrame:
    """For each wanted (key, title, year) the catalogue entry (id, name, released) at most a year apart and similar enough: the most similar, then the nearest year.

    Titles are compared as they are plain (safe, in lower case), once for each year. Those with an equal entry are found by
    a join. The others meet all entries of their years in cells of bounded size, so that a year of any size is
    spread; in a cell only entries are compared that can still be the most similar (rules.Offers), which changes no answer."""
    plain = lambda c: F.lower(R.safe(c))
    asked = wanted.where(F.col("year").isNotNull() & F.col("title").isNotNull()).select(key, F.col("year").cast("bigint").alias("_year"), plain("title").alias("_text"))
    entries = catalogue.where(F.col("released").isNotNull() & F.col("name").isNotNull()).withColumns({"_released": F.col("released").cast("bigint"), "_name": plain("name")})
    entries = settled(entries.groupBy("_name", "_released").agg(F.min(F.struct("id", "name", "released")).alias("entry")))
    around = lambda c: F.explode(F.sequence(c - YEAR_TOLERANCE, c + YEAR_TOLERANCE))
    away = lambda: F.abs(F.col("_released") - F.col("_year"))
    near = asked.select("_text", "_year").distinct().withColumn("_y", around(F.col("_year"))).alias("a")
    equal = near.join(entries.alias("e"), (F.col("_y") == F.col("_released")) & (F.col("_text") == F.col("_name")), "left")
    equal = settled(equal.groupBy("_text", "_year").agg(F.min_by("entry", F.when(F.col("entry").isNotNull(), F.struct(away(), "entry"))).alias("entry")))

    left = equal.where(F.col("entry").isNull()).select("_text", "_year", F.lit(None).cast("bigint").alias("_released"))
    right = entries.select(F.col("_name").alias("_text"), around(F.col("_released")).alias("_year"), "_released")
    blocks = lambda df, size, name: df.groupBy("_year").agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    cut = blocks(left, CELL[0], "_rows").join(blocks(right, CELL[1], "_columns"), "_year")
    own = lambda name: F.array(F.pmod(F.xxhash64("_text"), F.col(name)).cast("int"))
    all_ = lambda name: F.sequence(F.lit(0), F.col(name) - 1)
    cells = [df.join(cut, "_year").withColumn("_row", F.explode(i)).withColumn("_column", F.explode(j)) for df, i, j in ((left, own("_rows"), all_("_columns")), (right, all_("_rows"), own("_columns")))]
    session = wanted.sparkSession
    # a number of tasks: cells are small and heavy, and sized in bytes they would be put together
    tasks = max(4 * session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    both = cells[0].unionByName(cells[1]).select("_year", "_row", "_column", "_text", "_released").repartition(tasks, "_year", "_row", "_column")

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        offered = pdf["_released"].notna()
        years = pdf.loc[offered, "_released"].astype("int64").tolist()
        offers, found = R.Offers(pdf.loc[offered, "_text"].tolist()), []
        for text, year in zip(pdf.loc[~offered, "_text"], pdf.loc[~offered, "_year"]):
            similarity, places = offers.best(text, LEAST_SIMILARITY)
            closest = min((abs(years[k] - year) for k in places), default=0)
            found += [(text, year, offers.texts[k], years[k], similarity) for k in places if abs(years[k] - year) == closest]
        return pd.DataFrame(found, columns=["_text", "_year", "_name", "_released", "similarity"])

    alike = both.groupBy("_year", "_row", "_column").applyInPandas(search, "_text string, _year bigint, _name string, _released bigint, similarity double")
    alike = alike.join(entries, ["_name", "_released"]).groupBy("_text", "_year").agg(F.min_by(F.struct("entry", "similarity"), F.struct(-F.col("similarity"), away(), "entry")).alias("b"))
    same = equal.where(F.col("entry").isNotNull()).select("_text", "_year", F.struct("entry", F.lit(1.0).alias("similarity")).alias("b"))
    return asked.join(alike.unionByName(same), ["_text", "_year"]).select(key, "b.entry.id", "b.entry.name", "b.entry.released", "b.similarity")


def resolution(found: DataFrame, key: str) -> DataFrame:
    """Adds reason: not_found, title_mismatch, year_mismatch, or null where the entry is the wanted one; parsed loosely it is invalid_repo_name."""
    same_title = R.safe("name") == R.safe("title")
    return found.withColumn("reason", F.when(F.col("title").isNull() | ~F.col("strict"), "invalid_repo_name").when(F.col("id").isNull(), "not_found").when(~same_title, "title_mismatch").when(F.col("released") != F.col("year"), "year_mismatch"))


def edition_jobs(editions: DataFrame, tags: list[str]) -> DataFrame:
    """One job per edition with the languages (tags, in their order) that the site knows."""
    named = F.transform(F.array(*map(F.lit, tags)), lambda x: F.struct(x.alias("tag"), site_code(x).alias("code")))
    known = editions.withColumn("languages", F.filter(named, lambda x: x["code"].isNotNull()))
    return known.where(F.size("languages") > 0).withColumn("keywords", C.release_keywords(F.col("edition")))

"""Film pages, credits and catalogue entries into the messages for a language model, and its answer into documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import lookup
from ..operators.ordered import settled
from ..sources import connector
from ..sources.connector import Transport

#: Budget of estimated tokens, languages dropped in this order, sections that an answer must have.
TARGET_TOKENS, HARD_TOKENS = 10_000, 14_000
REDUCIBLE = ("es", "de", "fr")
REQUIRED = ("简介", "人物与译名对照", "情节线", "背景故事", "剧情", "主题")


def language_order(original: Column, priority: list[str], limit: int | None = None) -> Column:
    """The original language first, then the others in order of priority, each once."""
    order = F.array_distinct(F.concat(F.array(original), F.array(*map(F.lit, priority))))
    return F.slice(order, 1, limit) if limit else order


def within_budget(plots: Column, fixed_tokens: Column, original: Column, target: int = TARGET_TOKENS, hard: int = HARD_TOKENS) -> Column:
    """map<language, plot> with plots dropped, least needed first, until the estimate fits; the original's and the English stay, the Chinese goes only beyond the hard limit."""

    def estimate(m: Column) -> Column:
        return fixed_tokens + F.aggregate(F.map_values(m), F.lit(0.0), lambda a, x: a + C.token_estimate(x))

    def without(lang: str):
        return lambda k, _: k != lang

    out = plots
    for lang in REDUCIBLE:
        over = (estimate(out) > target) & (original != lang)
        out = F.when(over, F.map_filter(out, without(lang))).otherwise(out)
    return F.when((estimate(out) > hard) & (original != "zh"), F.map_filter(out, lambda k, _: k != "zh")).otherwise(out)


def messages(payload: Column, system: str) -> Column:
    """Two chat messages: the instructions, and the payload as JSON."""
    return F.array(F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")), F.struct(F.lit("user").alias("role"), F.to_json(payload).alias("content")))


def crew_by_role(credits: DataFrame, key: str, roles: dict[str, str], most_cast: int = 10) -> DataFrame:
    """(key, crew map<role, names>, cast): crew by mapped job in order, and the first of the cast."""
    job = F.try_element_at(C.literal_map(roles), F.col("job"))
    crew = credits.where(job.isNotNull()).groupBy(key, job.alias("role")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("names"))
    maps = crew.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("role", "names")))).alias("crew"))
    first = credits.where((F.col("job") == "cast") & (F.col("pos") < most_cast)).groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]).alias("cast"))
    return maps.join(first, key, "full")


def wiki_links(plots: Column, sitelinks: Column) -> Column:
    """array<struct<lang, title>> of the plot's languages that have a page, in the plot's order."""
    return F.transform(F.filter(F.map_keys(plots), lambda k: F.map_contains_key(sitelinks, k)), lambda k: F.struct(k.alias("lang"), sitelinks[k].alias("title")))


def sections_of(answer: Column) -> Column:
    """map<name, body> of an answer's ## sections; of two with one name the last holds."""
    items = C.markdown_sections(C.emphasis_spacing(F.trim(answer)))
    last = F.aggregate(items, F.create_map().cast("map<string,string>"), lambda m, s: F.map_concat(F.map_filter(m, lambda k, _: k != s["name"]), F.create_map(s["name"], s["body"])))
    return last


def required(sections: Column) -> Column:
    """struct<found map, missing>: each required section, by its name or the first that contains it; the first that is missing."""
    def pick(name: str) -> Column:
        other = F.get(F.filter(F.map_keys(sections), lambda k: k.contains(name)), F.lit(0))
        return F.coalesce(F.try_element_at(sections, F.lit(name)), F.try_element_at(sections, other))

    found = F.map_from_arrays(F.array(*map(F.lit, REQUIRED)), F.array(*[pick(n) for n in REQUIRED]))
    absent = F.get(F.filter(F.array(*[F.when(pick(n).isNull(), F.lit(n)) for n in REQUIRED]), lambda x: x.isNotNull()), F.lit(0))
    return F.struct(F.map_filter(found, lambda _, v: v.isNotNull()).alias("found"), absent.alias("missing"))


def tables_of(block: Column) -> Column:
    """The pipe tables of a section; two are wanted."""
    return F.transform(F.regexp_extract_all(block, F.lit(r"(\|.+\|(?:\n\|.+\|)+)"), 1), F.trim)


def well_formed(sections: Column) -> Column:
    """Whether all required sections are there, and the table of names has exactly two tables."""
    own = required(sections)
    return own["missing"].isNull() & (F.size(tables_of(F.try_element_at(own["found"], F.lit(REQUIRED[1])))) == 2)


#: How often a malformed answer is asked for again, and the retry from which a plot less is sent each time.
MOST_RETRIES, DROP_FROM = 3, 2


def without(plots: Column, gone: tuple[str, ...]) -> Column:
    return F.map_filter(plots, lambda k, _: ~k.isin(*gone)) if gone else plots


def answered(facts: DataFrame, key: str, plots: str, others: list[str], transport: Transport, parallel: int = 8) -> DataFrame:
    """(key, retries, success, reason, sections): the facts sent as JSON, the answer cut into sections.

    A failed call ends at once with its reason; a malformed answer is asked for again, from the second retry on with one
    of the plots REDUCIBLE less each time. Each round sends only what the rounds before left open."""
    open_, done = settled(facts), None
    for retry in range(MOST_RETRIES + 1):
        gone = REDUCIBLE[: max(0, retry - DROP_FROM + 1)]
        payload = F.struct(without(F.col(plots), gone).alias("plots"), *others)
        sent = connector.call(open_.withColumn("_payload", F.to_json(payload)), "_payload", transport, parallel)
        read = settled(sent.withColumn("sections", sections_of(F.col("body"))).withColumn("_good", F.col("error").isNull() & F.coalesce(well_formed(F.col("sections")), F.lit(False))))
        again = F.col("error").isNull() & ~F.col("_good") if retry < MOST_RETRIES else F.lit(False)
        ended = read.where(~again).select(key, F.lit(retry).alias("retries"), F.col("_good").alias("success"), F.when(~F.col("_good"), F.coalesce("error", F.lit("malformed_llm_output"))).alias("reason"), "sections")
        done = ended if done is None else done.unionByName(ended)
        open_ = read.where(again).select(*facts.columns)
    return done


def paragraphs(text: Column) -> Column:
    """A blank line between plain lines; never more than one."""
    plain = r"(?m)^(?=\S)(?![#|])(?!.*<br>)(.*)\n(?=[^\S\n]*[^\s#|])(?![^\n]*<br>)"
    return F.regexp_replace(F.regexp_replace(text, plain, "$1\n\n"), r"\n{3,}", "\n\n")


def source_links(title: Column, year: Column, links: Column, fallback: Column) -> Column:
    head = F.concat(F.lit("**"), title, F.lit(" ("), year.cast("string"), F.lit(")**"))
    anchors = F.array_join(F.transform(links, lambda x: F.concat(F.lit("["), x["label"], F.lit("]("), x["url"], F.lit(")"))), " · ")
    return F.concat(head, F.lit(" · "), F.when(F.size(links) > 0, anchors).otherwise(F.concat(F.lit("[TMDB]("), fallback, F.lit(")"))))


def credits_without_known(people: DataFrame, cast: DataFrame) -> DataFrame:
    return lookup.without_known(people, "name", cast, "name")

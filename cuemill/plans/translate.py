"""Units through a translation service: batches out, replies back, recovery of what came back wrong."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import rules as R
from ..operators.ordered import settled, with_running_sum
from ..operators.sequence import chapter_batches
from ..sources import connector


@dataclass
class Provider:
    """A translation service: its transport, the characters it takes at once, and what joins cues that come back apart."""

    transport: connector.Transport
    batch_chars: int = 8000
    overhead: int = 16
    parallel: int = 8
    joiner: str = " "


def reply_texts(reply: Column, letter: str) -> Column:
    """map<id, text> of a marked reply; an id that comes twice is left out."""
    pattern = rf"⟦{letter}(\d+)⟧([^⟦]*(?:⟦(?!{letter}\d+⟧)[^⟦]*)*)"
    clean = C.normalize_markers(reply)
    ids = F.regexp_extract_all(clean, F.lit(pattern), 1)
    texts = F.transform(F.regexp_extract_all(clean, F.lit(pattern), 2), C.strip)
    pairs = F.filter(F.arrays_zip(ids.alias("id"), texts.alias("text")), lambda p: F.size(F.filter(ids, lambda i: i == p["id"])) == 1)
    return F.map_from_entries(pairs)


def first_pass(units: DataFrame, key: str, provider: Provider) -> DataFrame:
    """(key, unit_id, new): the translation that the batch's reply holds for the unit. Chapters stay together where they fit; oversized units stay missing."""
    items = units.withColumn("cost_", F.length("text") + provider.overhead)
    batched = chapter_batches(items.select(key, "unit_id", "chapter_id", "text", "cost_"), key, "chapter_id", "unit_id", "cost_", provider.batch_chars).where(~F.col("oversized"))
    marked = F.struct("unit_id", F.concat(F.lit("⟦t"), F.col("unit_id").cast("string"), F.lit("⟧ "), "text").alias("t"))
    batches = batched.groupBy(key, "batch_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(marked)), lambda x: x["t"]), "\n").alias("payload"))
    replies = connector.call(batches, "payload", provider.transport, provider.parallel)
    texts = replies.where(F.col("body").isNotNull()).select(key, "batch_no", reply_texts(F.col("body"), "t").alias("m"))
    return batched.join(texts, [key, "batch_no"]).select(key, "unit_id", F.try_element_at("m", F.col("unit_id").cast("string")).alias("new"))


def problem(original: Column, translated: Column, source: Column, target: Column) -> Column:
    """Why a translation can't stand: missing, untranslated, marker, length, leak; null if it can."""
    return (
        F.when(translated.isNull() | ((F.trim(translated) == "") & C.has_content(original)), "missing")
        .when(C.untranslated(translated, source, target), "untranslated")
        .when(C.marker_leak(original, translated), "marker")
        .when(~C.length_plausible(original, translated), "length")
        .when(C.leaked_untranslated(original, translated, source, target), "leak")
    )


def windowed(units: DataFrame, suspects: DataFrame, key: str, provider: Provider, radius: int) -> DataFrame:
    """(key, unit_id, new) for suspects sent with ``radius`` units of context on either side; accepted only if every unit of the window came back once and plausibly long."""
    placed = with_running_sum(units.select(key, "unit_id", "text"), [key], "unit_id", F.lit(1), "_at")
    centre = suspects.select(key, F.col("unit_id").alias("_suspect")).join(placed.select(key, F.col("unit_id").alias("_suspect"), F.col("_at").alias("_centre")), [key, "_suspect"])
    places = centre.withColumn("_at", F.explode(F.sequence(F.col("_centre") - radius, F.col("_centre") + radius)))
    members = places.join(placed, [key, "_at"])
    one = F.struct("_at", F.col("unit_id").cast("string").alias("id"), "text")
    windows = members.groupBy(key, "_suspect").agg(F.array_sort(F.collect_list(one)).alias("w"))
    payload = F.array_join(F.transform("w", lambda x: F.concat(F.lit("⟦u"), x["id"], F.lit("⟧ "), x["text"])), " ")
    sent = connector.call(windows.withColumn("payload", payload).where(F.length("payload") <= provider.batch_chars), "payload", provider.transport, provider.parallel)
    back = sent.where(F.col("body").isNotNull()).withColumn("m", reply_texts(F.col("body"), "u"))
    fine = F.forall("w", lambda x: F.try_element_at(F.col("m"), x["id"]).isNotNull() & (F.lit(radius == 0) | C.length_plausible(x["text"], F.try_element_at(F.col("m"), x["id"]))))
    return back.where(fine).select(key, F.col("_suspect").alias("unit_id"), F.try_element_at("m", F.col("_suspect").cast("string")).alias("new"))


def translate(units: DataFrame, key: str, source: Column, target: Column, provider: Provider, ladder: tuple[int, ...] = (5, 3, 1, 0)) -> DataFrame:
    """Adds translation and problem. Resolved units need no call; suspects are sent again in ever smaller windows; what stays wrong keeps its problem."""
    own = units.withColumn("_s", source).withColumn("_t", target)
    open_ = own.where(F.col("resolved").isNull())
    state = open_.join(first_pass(open_, key, provider), [key, "unit_id"], "left")
    expected = F.transform(F.filter("spans", lambda s: s["boundary"] == "marker"), lambda s: s["marker_id"])
    state = state.withColumn("new", R.repaired(C.normalize_markers(F.col("new")), expected))
    state = settled(state.withColumn("problem", problem(F.col("text"), F.col("new"), F.col("_s"), F.col("_t"))).select(key, "unit_id", "text", "_s", "_t", "new", "problem"))
    for radius in ladder:
        suspects = state.where(F.col("problem").isNotNull()).select(key, "unit_id")
        if suspects.limit(1).count() == 0:
            break
        found = windowed(units, suspects, key, provider, radius).withColumnRenamed("new", "_again")
        tried = state.join(found, [key, "unit_id"], "left").withColumn("_why", problem(F.col("text"), F.col("_again"), F.col("_s"), F.col("_t")))
        better = F.col("problem").isNotNull() & F.col("_again").isNotNull() & F.col("_why").isNull()
        state = settled(tried.withColumn("new", F.when(better, F.col("_again")).otherwise(F.col("new"))).withColumn("problem", F.when(better, None).otherwise(F.col("problem"))).drop("_again", "_why"))
    done = state.select(key, "unit_id", C.sanitize_style(F.col("new")).alias("_new"), "problem")
    return own.join(done, [key, "unit_id"], "left").withColumn("translation", F.coalesce("resolved", "_new")).drop("_s", "_t", "_new")


def missing_cues(units: DataFrame, key: str) -> DataFrame:
    """(key, unit_id, marker_id) of marked spans that the translation lacks, in their order."""
    chunks = C.cue_chunks(F.coalesce("translation", F.lit("")))
    marked = F.filter("spans", lambda s: s["boundary"] == "marker")
    return units.select(key, "unit_id", F.explode(F.array_except(F.transform(marked, lambda s: s["marker_id"]), F.map_keys(chunks))).alias("marker_id"))


def leaked_cues(units: DataFrame, key: str, source: Column, target: Column) -> DataFrame:
    """(key, unit_id, cue) of cues that came back as they were: marked spans by their chunks, a unit of a single unmarked cue by its text."""
    marked = F.filter("spans", lambda s: s["boundary"] == "marker")
    ids = F.array_distinct(F.transform("spans", lambda s: s["id"]))
    chunks = C.cue_chunks(F.coalesce("translation", F.lit("")))
    single = F.when(F.size(ids) == 1, F.array(F.struct(F.get(ids, F.lit(0)).cast("string").alias("cue"), F.col("text").alias("own"), F.col("translation").alias("got"))))
    each = F.when(F.size(marked) > 0, F.transform(marked, lambda s: F.struct(s["marker_id"].alias("cue"), s["text"].alias("own"), F.try_element_at(chunks, s["marker_id"]).alias("got")))).otherwise(single)
    rows = units.select(key, "unit_id", source.alias("_s"), target.alias("_t"), F.explode(each).alias("x")).where(F.col("x.got").isNotNull())
    return rows.where(C.leaked_untranslated(F.col("x.own"), F.col("x.got"), F.col("_s"), F.col("_t"))).select(key, "unit_id", "x.cue")


def pinned_languages(calls: DataFrame, keys: list[str], requested: Column, detected: Column, order: Column) -> DataFrame:
    """(keys, language): the language that was asked for; where it is "auto" or none, the first that a call detected holds for all later ones."""
    asked = F.nullif(requested, F.lit("auto"))
    return calls.groupBy(*keys).agg(F.coalesce(F.min_by(asked, F.when(asked.isNotNull(), order)), F.min_by(detected, F.when(detected.isNotNull(), order)), F.lit("auto")).alias("language"))


def prepared_context(raw: Column, reference: Column, detected: Column, translated: Column, most: int = 500) -> Column:
    """The context to send: none where the subtitle's language is unknown, itself where it has that language, else its translation, cut, or itself where there is none."""
    same = F.coalesce(C.primary_subtag(detected) == C.primary_subtag(reference), F.lit(False))
    return F.when((F.coalesce(raw, F.lit("")) == "") | reference.isNull(), F.lit(None)).when(same, raw).otherwise(F.coalesce(C.truncate_context(translated, most), raw))


def apply_terms(text: Column, matches: Column, target: Column) -> Column:
    """Replaces source terms that leaked into a translation by their targets, the longest first."""
    ordered = F.array_sort(F.transform(matches, lambda m: F.struct((-F.length(m["matched"])).alias("n"), m["matched"].alias("matched"), m["target"].alias("target"))))
    cjk = C.script_of(target) == "cjk"
    quoted = lambda m: F.concat(F.lit("\\Q"), m["matched"], F.lit("\\E"))
    bound = F.when(cjk, F.lit(r"\s*")).otherwise(F.lit(r"\b"))
    return F.aggregate(ordered, text, lambda acc, m: F.regexp_replace(acc, F.concat(bound, quoted(m), bound), C.sub(m["target"], r"([\\$])", r"\\\\$1")))


def sample_text(units: DataFrame, key: str, most: int = 500) -> DataFrame:
    """(key, sample): unit texts in order up to so many characters, for language detection."""
    run = with_running_sum(units.where(F.length("text") > 0).select(key, "unit_id", "text"), [key], "unit_id", F.length("text") + 1, "_upto")
    used = run.where(F.col("_upto") - F.length("text") - 1 < most)
    return used.groupBy(key).agg(F.left(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("unit_id", "text"))), lambda x: x["text"]), " "), F.lit(most)).alias("sample"))


def isolated_cues(units: DataFrame, key: str, provider: Provider, source: Column, target: Column, radius: int = 3) -> DataFrame:
    """(key, unit_id, marker_id, new) of marked cues that a translation lacks, each sent with its neighbours of the unit as context and taken if it came back once and plausible."""
    lost = missing_cues(units, key)
    marked = units.select(key, "unit_id", F.posexplode(F.filter("spans", lambda s: s["boundary"] == "marker")).alias("at", "s")).select(key, "unit_id", "at", F.col("s.marker_id").alias("marker_id"), F.col("s.text").alias("text"))
    centre = lost.join(marked, [key, "unit_id", "marker_id"]).select(key, "unit_id", F.col("marker_id").alias("_lost"), F.col("text").alias("_text"), F.explode(F.sequence(F.col("at") - radius, F.col("at") + radius)).alias("at"))
    windows = centre.join(marked, [key, "unit_id", "at"]).groupBy(key, "unit_id", "_lost", "_text").agg(F.array_sort(F.collect_list(F.struct("at", "marker_id", "text"))).alias("w"))
    payload = F.array_join(F.transform("w", lambda x: F.concat(F.lit("⟦c"), x["marker_id"], F.lit("⟧ "), x["text"])), " ")
    back = connector.call(windows.withColumn("payload", payload), "payload", provider.transport, provider.parallel).where(F.col("body").isNotNull())
    new = F.try_element_at(C.cue_chunks(C.normalize_markers(F.col("body"))), F.col("_lost"))
    return back.select(key, "unit_id", F.col("_lost").alias("marker_id"), new.alias("new"), "_text").where(problem(F.col("_text"), F.col("new"), source, target).isNull()).drop("_text")


def patched(units: DataFrame, recovered: DataFrame, key: str, joiner: str = " ") -> DataFrame:
    """Units whose translation takes in recovered cues, all chunks in the order of the spans."""
    maps = recovered.groupBy(key, "unit_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("marker_id", "new")))).alias("_new"))
    both = units.join(maps, [key, "unit_id"], "left")
    ids = F.transform(F.filter("spans", lambda s: s["boundary"] == "marker"), lambda s: s["marker_id"])
    own = C.cue_chunks(F.coalesce("translation", F.lit("")))
    chunk = lambda i: F.coalesce(F.try_element_at("_new", i), F.try_element_at(own, i))
    text = F.array_join(F.transform(F.filter(ids, lambda i: chunk(i).isNotNull()), lambda i: F.concat(F.lit("⟦c"), i, F.lit("⟧ "), chunk(i))), joiner)
    return both.withColumn("translation", F.when(F.col("_new").isNotNull(), text).otherwise(F.col("translation"))).drop("_new")


def skip_done(targets: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Targets whose output isn't there yet."""
    return targets.join(existing.select(*keys).distinct(), keys, "left_anti")

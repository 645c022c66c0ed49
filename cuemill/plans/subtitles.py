"""From cues to translation units, and from translated units back to cues."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions import rules as R
from ..operators import align
from ..operators import sequence as S
from ..operators.ordered import settled, with_running_sum


def resolve_text(text: str, glossary: list[tuple[str, str]], latin: bool) -> str | None:
    """The text itself if it has no word; its translation if it is glossary terms and nothing else, or one term with a stammer; else None."""
    if not re.search(r"\w", text):
        return text
    residual = (lambda t: re.findall(f"[{C.LATIN}]", t)) if latin else (lambda t: list(t.strip()))
    rest = out = text
    hit = False
    for term, target in sorted((g for g in glossary if g[0]), key=lambda g: -len(g[0])):
        pattern = re.compile(rf"(?<![A-Za-z0-9]){re.escape(term)}(?![A-Za-z0-9])", re.I)
        rest, n = pattern.subn("", rest)
        out = pattern.sub(lambda _, t=target: t, out)
        hit = hit or n > 0
    if hit and not residual(rest):
        return out
    if latin:
        for term, target in sorted((g for g in glossary if g[0]), key=lambda g: -len(g[0])):
            m = re.search(rf"(?<![A-Za-z0-9]){re.escape(term)}(?![A-Za-z0-9])", text, re.I)
            if m and 0 < len(residual(text[: m.start()] + text[m.end() :])) < len(residual(term)):
                end = re.search(r"[!?…]+(?=(?:</[ibu]>)*$)", text, re.I)
                return target + (end.group().replace("?", "？").replace("!", "！") if end else "")
    return None


def segments(cues: DataFrame, key: str, glossary: list[tuple[str, str]], language: Column) -> DataFrame:
    """Segments of cues: key, seq, cue_id, dash_index, text, start_ms, end_ms, start_time, end_time, resolved, style_wrap, music. A dash line is a segment; a tag that wraps it whole is taken off. The rules for stammers and residual text follow the script of the language."""
    cues = cues.withColumn("_language", language).withColumn("_latin", C.primary_subtag(language).isin(*S.LATIN_LANGUAGES))

    @F.pandas_udf(T.StringType())
    def resolve(texts: pd.Series, latin: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else resolve_text(x, glossary, bool(y)) for x, y in zip(texts, latin)])

    whole = cues.withColumn("_w", C.full_wrap(F.col("text"))).withColumn("_parts", C.dialogue_parts(F.col("_w.body")))
    parts = whole.select(key, "cue_id", "start_time", "end_time", "start_ms", "end_ms", "_latin", "_language", "_w", F.size("_parts").alias("_n"), F.posexplode("_parts").alias("dash_index", "_part"))
    own = C.full_wrap(F.col("_part"))
    single = F.col("_w.tag").isNotNull() | (F.col("_n") == 1)
    text = F.when(single, F.col("_part")).otherwise(own["body"])
    rows = parts.withColumn("_text", text).withColumn("style_wrap", F.when(single, F.col("_w.tag")).otherwise(own["tag"]))
    # without a glossary only texts without words resolve, which needs no Python
    resolved = resolve("_text", "_latin") if glossary else F.when(~C.has_content(F.col("_text")), F.col("_text"))
    rows = rows.withColumn("resolved", resolved)
    final = F.when(F.col("resolved").isNull() & F.col("_latin"), C.strip_stutter(F.col("_text"))).otherwise(F.col("_text"))
    return rows.select(key, (F.col("cue_id").cast("bigint") * 64 + F.col("dash_index")).alias("seq"), "cue_id", "dash_index", final.alias("text"), "start_time", "end_time", "start_ms", "end_ms", "resolved", "style_wrap", C.is_music(final).alias("music"), F.col("_language").alias("language"))


def units(cues: DataFrame, key: str, language: Column, glossary: list[tuple[str, str]] | None = None) -> DataFrame:
    """Translation units: key, unit_id, chapter_id, kind, text, resolved, spans.

    Ids count over the chapters in order, so that songs between dialogue make them differ from the order of time."""
    own = settled(segments(cues, key, glossary or [], language))
    # texts are written once: what follows carries numbers, and the texts join at the end
    grouped = settled(S.grouped_segments(own, [key], "seq", F.col("language")).select(key, "seq", "group_no", "marker_boundary", "start_ms", "end_ms", "music", "resolved"))
    groups = grouped.groupBy(key, "group_no").agg(F.min_by("start_ms", "seq").alias("start_ms"), F.max_by("end_ms", "seq").alias("end_ms"), F.when(F.bool_or("music"), "music").otherwise("dialogue").alias("kind"), F.count("*").alias("n"), F.max("resolved").alias("resolved"))
    chaptered = S.chapters(groups, [key], "kind", "group_no", "start_ms", "end_ms", settle=False)
    key_type = groups.schema[key].dataType.simpleString()

    def fuse(frame: pd.DataFrame) -> pd.DataFrame:
        """Groups of a song run together up to the length of a chain."""
        size, head, out = 0, None, []
        for g in frame.sort_values("group_no").itertuples(index=False):
            alone = g.resolved is not None and g.resolved == g.resolved or g.kind != "music"
            if head is None or alone or size + g.n > S.MOST_CHAINED:
                head, size = g.group_no, 0
            size = S.MOST_CHAINED if alone else size + g.n
            out.append((getattr(g, key), g.group_no, head))
        return pd.DataFrame(out, columns=[key, "group_no", "head_no"])

    music = chaptered.where(F.col("kind") == "music").select(key, "chapter_id", "group_no", "n", "kind", "resolved").groupBy(key, "chapter_id").applyInPandas(fuse, f"{key} {key_type}, group_no bigint, head_no bigint")
    heads = settled(chaptered.join(music, [key, "group_no"], "left").select(key, "group_no", "chapter_id", "kind", F.coalesce("head_no", "group_no").alias("head_no")))
    firsts = heads.select(key, "chapter_id", "head_no").distinct().withColumn("_at", F.col("chapter_id").cast("bigint") * (1 << 32) + F.col("head_no"))
    numbered = with_running_sum(firsts, [key], "_at", F.lit(1), "unit_id").select(key, "head_no", F.col("unit_id").cast("int").alias("unit_id"))
    placed = heads.join(numbered, [key, "head_no"]).select(key, "group_no", "unit_id", "chapter_id", "kind")
    spans = own.join(grouped.select(key, "seq", "group_no", "marker_boundary"), [key, "seq"]).join(placed, [key, "group_no"]).withColumn("marked", (F.col("kind") == "music") | F.col("marker_boundary"))
    spans = S.marker_ids(spans, [key, "unit_id"])
    piece = F.when(F.col("marked"), F.concat(F.lit("⟦c"), "marker_id", F.lit("⟧ "), F.when(F.col("kind") == "music", C.strip_edge_notes(F.col("text"))).otherwise(F.col("text")))).otherwise(F.col("text"))
    span = F.struct("seq", F.col("cue_id").alias("id"), "start_time", "end_time", "text", F.when(F.col("marked"), "marker").alias("boundary"), "dash_index", "style_wrap", "kind", "marker_id", piece.alias("piece"), "resolved")
    whole = spans.groupBy(key, "unit_id", "chapter_id", "kind").agg(F.array_sort(F.collect_list(span)).alias("s"))
    alone = (F.size("s") == 1) & F.get("s", F.lit(0))["resolved"].isNotNull()
    fields = ("id", "start_time", "end_time", "text", "boundary", "dash_index", "style_wrap", "kind", "marker_id")
    return whole.select(
        key, "unit_id", "chapter_id", "kind",
        F.when(alone, "").otherwise(F.array_join(F.transform("s", lambda x: x["piece"]), " ")).alias("text"),
        F.when(alone, F.get("s", F.lit(0))["resolved"]).alias("resolved"),
        F.transform("s", lambda x: F.struct(*[x[f].alias(f) for f in fields])).alias("spans"),
    )


def dash_style(cues: DataFrame, key: str, order: str = "cue_id", enough: int = 9) -> DataFrame:
    """(key, style): "- " if at least two thirds of the first nine or more dash lines have a space behind the dash, else "-"."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.trim(C.without_style(x)))
    counted = cues.select(key, F.col(order).cast("bigint").alias("_o"), F.size(F.filter(lines, lambda x: x.startswith("- "))).alias("spaced"), F.size(F.filter(lines, lambda x: x.startswith("-"))).alias("dashed"))
    run = with_running_sum(counted, [key], "_o", F.col("dashed"), "_upto")
    used = run.where(F.col("_upto") - F.col("dashed") < enough).groupBy(key).agg(F.sum("spaced").alias("s"), F.sum("dashed").alias("d"))
    return used.select(key, F.when((F.col("d") > 0) & (F.col("s") / F.col("d") >= 2 / 3), "- ").otherwise("-").alias("style"))


def bilingual_cues(cues: DataFrame, units_: DataFrame, translations: DataFrame, key: str, target: str, source: str = "en", wrap: bool = False, full_width: bool = False, keep_terminators: bool = False) -> DataFrame:
    """Cues with their translation (null if any part is missing), the split method of their units, and reading speed.

    ``translations`` has key, unit_id, text; a unit's own resolved text stands for its translation."""
    t = translations.select(key, "unit_id", F.col("text").alias("_t"))
    joined = units_.join(t, [key, "unit_id"], "left").withColumn("_t", F.coalesce("resolved", "_t"))
    to, frm = F.lit(target), F.lit(source)
    normal = C.normalize_translation(F.col("_t"), to)
    split = align.split_parts(normal, F.transform("spans", lambda s: s["text"]), F.transform("spans", lambda s: s["marker_id"]), to, frm)
    parts = joined.withColumn("_p", split).select(key, "unit_id", "_p.method", F.posexplode("spans").alias("_i", "_s"), "_p.parts")
    pieces = parts.select(key, F.col("_s.id").alias("cue_id"), F.col("_s.dash_index").alias("dash_index"), "unit_id", "_i", "method", (F.col("_s.kind") == "music").alias("music"), F.get("parts", F.col("_i")).alias("part"))
    per_cue = pieces.groupBy(key, "cue_id").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("dash_index", F.lit(0)).alias("d"), "unit_id", "_i", F.coalesce("part", F.lit("")).alias("part")))).alias("ps"),
        F.bool_or(F.col("part").isNull()).alias("missing"), F.bool_and("music").alias("all_music"), F.array_sort(F.collect_set("method")).alias("methods"),
    )
    style = dash_style(cues, key)
    many = F.array_join(F.transform("ps", lambda p: F.concat(F.lit("-"), C.sub(p["part"], r"^[-–—\s]+", ""))), " ")
    text = F.when(F.col("missing"), None).when(F.size("ps") > 1, many).otherwise(F.get("ps", F.lit(0))["part"])
    both = cues.join(per_cue.withColumn("_tr", text), [key, "cue_id"], "left").join(style, key, "left")
    dashed = F.when(F.size("ps") > 1, F.when(F.col("style") == "- ", C.sub(F.col("_tr"), r"(^|\s)-\s*", "$1- ")).otherwise(F.col("_tr"))).otherwise(F.col("_tr"))
    sung = F.when(F.col("all_music") & (F.coalesce(dashed, F.lit("")) != ""), C.music_line(dashed)).otherwise(dashed)
    styled = C.trim_final_space(C.restyle_punctuation(sung, to, full_width, keep_terminators), F.col("text")) if target.split("-")[0] != "fr" else C.restyle_punctuation(sung, to, full_width, keep_terminators)
    out = both.withColumn("translation", align.wrapped(styled, to) if wrap else styled)
    speed = C.reading_speed(F.col("translation"), F.col("end_ms") - F.col("start_ms"), C.language_key(to))
    out = out.withColumn("_speed", F.when(F.col("translation").isNotNull(), speed))
    top = F.when(F.col("all_music") & F.col("translation").isNotNull(), F.concat(F.lit("{\\an7}"), "translation")).otherwise(F.col("translation"))
    return out.select(key, "cue_id", "start_time", "end_time", "text", top.alias("translation"), "methods", "_speed.cps", "_speed.over_cps", "_speed.over_length")

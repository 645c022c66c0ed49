"""Operators along the order of cues: merging, chapters, marker ids, packing."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions import rules as R
from .ordered import ranks, settled, with_previous, with_running_sum

#: A scene ends after a longer pause (ms), a chain holds so many segments, a quotation stays open over so many.
SCENE_CHANGE_MS, MOST_CHAINED, MOST_QUOTED = 30_000, 16, 10
#: Islands of segments that one call folds.
ISLANDS = 256
#: Languages written in Latin letters.
LATIN_LANGUAGES = (
    "en", "es", "fr", "de", "it", "pt", "nl", "pl", "sv", "da", "no", "fi", "ro", "cs", "hu", "tr", "id", "vi", "ms", "tl", "ca", "eu", "gl", "la",
    "hr", "sk", "sl", "lt", "lv", "et", "sq", "cy", "is", "af",
)


# ---- chapters ----
def chapters(groups: DataFrame, keys: list[str], kind: str, order: str, start: str, end: str, gap_ms: int = SCENE_CHANGE_MS, settle: bool = True) -> DataFrame:
    """Adds chapter_id: per kind a new chapter after a pause longer than the gap since the last row's end; numbered by first appearance over all kinds.

    Null times count as no pause. A row whose end lies before an earlier row's end still sets the pause, as the last row does."""
    # what decides is written once, as each step below reads it twice; ``settle`` is off where it is written already
    slim = groups.select(*keys, kind, order, start, end)
    slim = settled(slim) if settle else slim
    own = with_previous(slim, [*keys, kind], order, [end], "_prior")
    breaks = F.when(F.col("_prior").isNull() | (F.col(start) - F.col(f"_prior.{end}") > gap_ms), 1).otherwise(0)
    begun = settled(own.select(*keys, kind, order, breaks.alias("_break")))
    numbered = with_running_sum(begun, [*keys, kind], order, F.col("_break"), "_no").drop("_break")
    firsts = numbered.groupBy(*keys, kind, "_no").agg(F.min(order).alias("_at"))
    ranked = ranks(firsts, keys, [F.col("_at")], "chapter_id").withColumn("chapter_id", F.col("chapter_id").cast("int")).drop("_at")
    placed = numbered.join(ranked, [*keys, kind, "_no"]).select(*keys, order, "chapter_id")
    return groups.join(placed, [*keys, order])


# ---- merging segments ----
def latin_rule(tail: Column, head: Column, gap: Column) -> Column:
    """Whether a segment goes on with the one before, by the signs at its ends (Latin script)."""
    touching = gap <= R.TOUCH_MS
    return (
        F.when(tail["terminal"], False)
        .when(tail["dash"], touching & head["lower"])
        .when(tail["ellipsis"] & head["ellipsis"], gap <= R.SCENE_MS)
        .when(tail["ellipsis"] & head["upper"], False)
        .when(~tail["ellipsis"] & tail["continuing"] & (gap <= R.SCENE_MS), True)
        .otherwise(touching | head["lower"])
    )


def unpunctuated_caption(text: Column, tail: Column) -> Column:
    """One to three words in capitals without an end sign."""
    signs = tail["terminal"] | tail["ellipsis"] | tail["continuing"] | tail["dash"] | tail["opener"]
    words = C.count(text, rf"[{C.LATIN}]+(?:['’][{C.LATIN}]+)*")
    return ~signs & words.between(1, 3) & (text == F.upper(text)) & (text != F.lower(text))


@F.pandas_udf(T.BooleanType())
def _music_goes_on(texts: pd.Series) -> pd.Series:
    return pd.Series([R.music_goes_on(x or "") for x in texts])


@F.pandas_udf(T.BooleanType())
def _cjk_goes_on(base: pd.Series, before: pd.Series, after: pd.Series, gap: pd.Series) -> pd.Series:
    out = []
    for lang, a, b, g in zip(base, before, after, gap):
        edges = R.EDGES.get(lang)
        out.append(bool(edges and a is not None and b is not None and edges.go_on(a, R.tail_of(a), b, 10**9 if g != g or g is None else int(g))))
    return pd.Series(out)


def merge_reasons(segments: DataFrame, keys: list[str], order: str, language: Column) -> DataFrame:
    """Adds ``reason``: dash, music, gap or null, why a segment goes on with the one before.

    Needs text, cue_id, start_ms, end_ms, music. Segments of different music flags never merge."""
    own = segments.withColumn("_tail", R.classify_tail("text")).withColumn("_head", R.classify_head("text")).withColumn("_base", C.primary_subtag(language))
    own = with_previous(own, keys, order, ["cue_id", "text", "end_ms", "music", "_tail"], "_p")
    gap = F.col("start_ms") - F.col("_p.end_ms")
    latin = F.col("_base").isin(*LATIN_LANGUAGES)
    spaceless = F.col("_base").isin(*R.EDGES)
    goes_on = F.when(spaceless, _cjk_goes_on("_base", "_p.text", "text", gap)).otherwise(latin_rule(F.col("_p._tail"), F.col("_head"), gap))
    reason = (
        F.when(F.col("_p").isNull() | (F.col("_p.music") != F.col("music")), None)
        .when(F.col("_p.cue_id") == F.col("cue_id"), F.when(F.when(latin, C.short_reply(F.col("text"))).otherwise(C.short_reply(F.col("text"), False)), "dash"))
        .when(F.col("music"), F.when(_music_goes_on("text"), "music"))
        .when(gap < -R.OVERLAP_MS, None)
        .when(F.col("_head.closer") | F.col("_p._tail.opener"), F.when(gap <= R.SCENE_MS, "gap"))
        .when(latin & unpunctuated_caption(F.col("_p.text"), F.col("_p._tail")) & ~F.col("_head.lower"), None)
        .when(goes_on, "gap")
    )
    return own.withColumn("reason", reason).withColumn("gap_ms", gap).drop("_tail", "_head", "_base", "_p")


def grouped_segments(segments: DataFrame, keys: list[str], order: str, language: Column) -> DataFrame:
    """Adds group_no (per key, in order) and marker_boundary: segments that one sentence or quotation joins.

    What merges depends on the segments before (open quotations, length of the chain), but never over a pause longer
    than a scene's without a reason to merge, nor over a resolved segment: there the order is cut into islands, and
    the fold runs over a few hundred islands at a time, so that a long file isn't one task and an island isn't a call."""
    own = settled(merge_reasons(segments, keys, order, language))
    sure = F.col("gap_ms").isNull() | F.col("resolved").isNotNull() | (F.col("reason").isNull() & (F.col("gap_ms") > R.SCENE_MS))
    islands = with_running_sum(own, keys, order, F.when(sure, 1).otherwise(0), "_island")
    key_fields = {k: islands.schema[k].dataType.simpleString() for k in keys}

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        size, pending, quoted, group, island, out = 0, False, 0, -1, None, []
        for row in frame.sort_values(order).itertuples(index=False):
            if row.island_ != island:
                island, size, pending, quoted = row.island_, 0, False, 0
            resolved = row.resolved is not None and row.resolved == row.resolved
            full, reason = size >= MOST_CHAINED, row.reason if isinstance(row.reason, str) else None
            merged = marked = False
            if size and not resolved:
                merged = pending and not full and row.gap_ms <= R.SCENE_MS
                if not merged and reason and not (full and reason in ("gap", "music")):
                    merged, marked = True, reason in ("dash", "marker")
            if resolved:
                group, size, pending, quoted = group + 1, 0, False, 0
            elif merged:
                size += 1
            else:
                group, size, pending, quoted = group + 1, 1, False, 0
            if not resolved:
                pending = R.quote_pending(row.text or "", pending)
                quoted = quoted + 1 if pending else 0
                if quoted >= MOST_QUOTED:
                    pending = False
            out.append((*[getattr(row, k) for k in keys], getattr(row, order), row.part_, group, marked))
        return pd.DataFrame(out, columns=[*keys, order, "part_", "_inner", "marker_boundary"])

    schema = ", ".join([*[f"{k} {t}" for k, t in key_fields.items()], f"{order} {islands.schema[order].dataType.simpleString()}", "part_ bigint", "_inner int", "marker_boundary boolean"])
    needed = islands.select(*keys, order, F.col("_island").alias("island_"), F.floor(F.col("_island") / ISLANDS).alias("part_"), "text", "resolved", "reason", "gap_ms")
    folded = settled(needed.groupBy(*keys, "part_").applyInPandas(fold, schema))
    per_part = folded.groupBy(*keys, "part_").agg((F.max("_inner") + 1).alias("_groups"))
    numbered = with_running_sum(per_part, keys, "part_", F.col("_groups"), "_upto")
    groups = folded.join(numbered.select(*keys, "part_", (F.col("_upto") - F.col("_groups")).alias("_from")), [*keys, "part_"])
    return own.join(groups.select(*keys, order, (F.col("_from") + F.col("_inner") + 1).cast("bigint").alias("group_no"), "marker_boundary"), [*keys, order])


def merge_sides(segments: DataFrame, keys: list[str], order: str, latin: bool = True, words: int = 0) -> DataFrame:
    """Adds merge_side: an isolated short segment goes with the next if it is near, else with the one before, never over music. Off while ``words`` is 0."""
    from .ordered import with_next

    own = with_next(with_previous(segments, keys, order, ["end_ms", "music"], "_p"), keys, order, ["start_ms", "music"], "_n")
    short = F.col("resolved").isNull() & ~F.col("music") & C.isolated_short(F.col("text"), latin, words)
    near_next = ~F.col("_n.music") & (F.col("_n.start_ms") - F.col("end_ms") <= R.SCENE_MS)
    near_prior = ~F.col("_p.music") & (F.col("start_ms") - F.col("_p.end_ms") <= R.SCENE_MS)
    return own.withColumn("merge_side", F.when(short & near_next, "next").when(short & near_prior, "prev")).drop("_p", "_n")


def marker_ids(spans: DataFrame, unit: list[str], cue: str = "cue_id", order: str = "dash_index") -> DataFrame:
    """Adds marker_id: the cue's id, with .k where several marked spans of a unit share a cue. A unit's spans are few."""
    marked = F.col("marked")
    w = Window.partitionBy(*unit, cue, "marked")
    many = F.count("*").over(w) > 1
    k = F.row_number().over(w.orderBy(order))
    return spans.withColumn("marker_id", F.when(marked & many, F.concat_ws(".", F.col(cue).cast("string"), k.cast("string"))).otherwise(F.col(cue).cast("string")))


# ---- packing ----
def pack_next_fit(items: DataFrame, keys: list[str], order: str, cost: str, limit: int, most_items: int = 50) -> DataFrame:
    """Adds batch_no: an item that would pass the limit, or the number of items, opens the next batch.

    Only (order, cost) of a key's items meet in a task, a few bytes an item, and are folded once; a key is a request's worth of work."""
    schema = ", ".join(f"{c} {items.schema[c].dataType.simpleString()}" for c in [*keys, order]) + ", batch_no int"

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order)
        batch, used, held, out = 0, 0, most_items, []
        for own in frame[cost].fillna(0).astype("int64").tolist():
            if held >= most_items or used + own > limit:
                batch, used, held = batch + 1, 0, 0
            used, held = used + own, held + 1
            out.append(batch)
        return frame.assign(batch_no=out)[[*keys, order, "batch_no"]]

    packed = items.select(*keys, order, cost).groupBy(*keys).applyInPandas(fold, schema)
    return items.join(packed, [*keys, order])


def chapter_batches(items: DataFrame, file_key: str, chapter: str, order: str, cost: str, limit: int, group_overhead: int = 0) -> DataFrame:
    """Adds batch_no and oversized: whole chapters fill a batch in order; one that is larger than the limit is split by itself; an item larger than the limit is marked, never cut."""
    schema = f"{file_key} {items.schema[file_key].dataType.simpleString()}, {order} {items.schema[order].dataType.simpleString()}, batch_no int, oversized boolean"

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        batch, used, out = 0, None, []
        for _, own in frame.sort_values([chapter, order]).groupby(chapter, sort=True):
            total = int(own[cost].sum()) + group_overhead
            if total > limit:
                used, inner = None, None
                for row in own.itertuples(index=False):
                    c = int(getattr(row, cost))
                    if c + group_overhead > limit:
                        out.append((getattr(row, file_key), getattr(row, order), None, True))
                        continue
                    if inner is None or inner + c > limit:
                        batch, inner = batch + 1, group_overhead
                    inner += c
                    out.append((getattr(row, file_key), getattr(row, order), batch, False))
                continue
            if used is None or used + total > limit:
                batch, used = batch + 1, 0
            used += total
            out += [(k, o, batch, False) for k, o in zip(own[file_key], own[order])]
        return pd.DataFrame(out, columns=[file_key, order, "batch_no", "oversized"]).astype({"batch_no": "Int32"})

    slim = items.select(file_key, chapter, order, cost)
    return items.join(slim.groupBy(file_key).applyInPandas(fold, schema), [file_key, order])

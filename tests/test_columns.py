"""Scalar functions against expected values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from cuemill.functions import columns as C
from cuemill.functions import rules as R


def one(spark, f, *values):
    row = spark.createDataFrame([values], ", ".join(f"c{i} {'string' if isinstance(v, str) or v is None else 'int'}" for i, v in enumerate(values)))
    return row.select(f(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "f, value, expected",
    [
        (C.time_ms, "00:00:01,500", 1500),
        (C.time_ms, "01:02:03.004", 3723004),
        (C.time_ms, "123:00:00,1", 442800100),
        (C.time_ms, None, None),
        (C.time_ms, "soon", None),
        (C.slug, "Directors Cut!", "directors-cut"),
        (C.slug, "  UK ", "uk"),
        (C.slug, "导演剪辑", ""),
        (C.strip_stutter, "I-I can", "I can"),
        (C.strip_stutter, "B-but why", "but why"),
        (C.strip_stutter, "W-w-what", "what"),
        (C.strip_stutter, "well-known", "well-known"),
        (C.dialogue_parts, "- Hi. - Yo.", ["Hi.", "Yo."]),
        (C.dialogue_parts, "A -- B", ["A -- B"]),
        (C.dialogue_parts, "Well - no", ["Well", "no"]),
        (C.dialogue_parts, "x-ray", ["x-ray"]),
        (C.dialogue_parts, "-Go!", ["Go!"]),
        (C.boundary_class, "Wait...", "trail_off"),
        (C.boundary_class, "a--", "trail_off"),
        (C.boundary_class, "Well,", "comma"),
        (C.boundary_class, "Go!", "period"),
        (C.boundary_class, 'Yes."', "period"),
        (C.boundary_class, "Said:", "colon"),
        (C.boundary_class, "No end", None),
        (C.content_weight, "Hello world", 5.0),
        (C.content_weight, "don't", 2.5),
        (C.content_weight, "你好 2 次", 3.5),
        (C.content_weight, "", 0.0),
        (C.token_estimate, "abcd", 1.0),
        (C.token_estimate, "你好ab", 2.5),
        (C.token_estimate, None, 0.0),
        (C.keep_style_tags, "<font x>A</font> <I>b</I> {\\an8}c", "A <i>b</i> c"),
        (C.collapse_style_wraps, "<i>a</i> <i>b</i>", "<i>a b</i>"),
        (C.music_line, "la ♪ la", "♪la la♪"),
        (C.strip_foreign_markers, "⟦c3⟧ a ⟦t1⟧ b ⟦", "⟦c3⟧ a  b "),
        (C.normalize_markers, "⟦ c 12 ⟧", "⟦c12⟧"),
        (C.style_balanced, "<i>a</i>", True),
        (C.style_balanced, "</i><i>", False),
        (C.sanitize_style, "<i>a /i>", "<i>a </i>"),
        (C.language_key, "zh_TW", "zh-hant"),
        (C.language_key, "zh", "zh-hans"),
        (C.language_key, "nb", "no"),
        (C.imdb_number, "TT0123", "0123"),
        (C.release_keywords, "web-directors_cut", "web,directors,cut"),
        (C.emphasis_spacing, "a**b**c", "a **b** c"),
        (C.unescape_html, "&lt;b&gt; &amp;amp;", "<b> &amp;"),
        (C.clean_reference_text, "A[1]  b [note 2]", "A b"),
    ],
)
def test_values(spark, f, value, expected):
    assert one(spark, f, value) == expected


def test_chunks_drop_repeated_ids(spark):
    assert one(spark, C.cue_chunks, "⟦c3⟧ a ⟦c4.1⟧ b") == {"3": "a", "4.1": "b"}
    assert one(spark, C.cue_chunks, "⟦c3⟧ a ⟦c3⟧ b") == {}
    assert one(spark, C.cue_chunks, "") == {}


def test_full_wrap(spark):
    assert tuple(one(spark, C.full_wrap, "<i> a b </i>")) == ("a b", "i")
    assert tuple(one(spark, C.full_wrap, "♪ <I>la</I> ♪")) == ("♪ la ♪", "i")
    assert tuple(one(spark, C.full_wrap, "<i>a</i> b <i>c</i>")) == ("<i>a</i> b <i>c</i>", None)


def test_length_ratio_bounds_are_inclusive(spark):
    assert one(spark, C.length_plausible, "a" * 20, "b" * 3) is True
    assert one(spark, C.length_plausible, "a", "b" * 6) is True
    assert one(spark, C.length_plausible, "a", "b" * 7) is False
    assert one(spark, C.length_plausible, "♪", "whatever") is True
    assert one(spark, C.length_plausible, None, None) is True


def test_untranslated(spark):
    f = C.untranslated
    assert one(spark, f, "Hello my dear friend", "en", "zh") is True
    assert one(spark, f, "他叫 Tom", "en", "zh") is False
    assert one(spark, f, "", "en", "zh") is False
    assert one(spark, f, "hola", "en", "es") is False


def test_edition(spark):
    row = spark.createDataFrame([(True, False, None), (False, True, None), (True, False, "uk"), (False, True, "directors-cut"), (False, False, "hdtv-broadcast"), (True, True, None), (False, False, "")], "w boolean, b boolean, l string")
    out = [tuple(r.e) for r in row.select(C.edition(F.col("w"), F.col("b"), F.col("l")).alias("e")).collect()]
    assert out == [("web", None), ("bluray", None), ("web-uk", None), ("bluray-directors-cut", None), ("hdtv-broadcast", None), (None, "conflict"), (None, "empty")]


def test_repo_names(spark):
    assert tuple(one(spark, C.parse_repo_name, "The_Salt-Meridian_2011")) == ("The Salt Meridian", 2011, True)
    assert tuple(one(spark, C.parse_repo_name, "2011 Odyssey")) == ("Odyssey", 2011, False)
    assert tuple(one(spark, C.parse_repo_name, "nothing"))[:2] == (None, None)


def test_punctuation_policy(spark):
    zh = lambda c: C.restyle_punctuation(c, F.lit("zh-Hans"))
    assert one(spark, zh, "你好，世界。") == "你好 世界"
    assert one(spark, zh, "真的！走吧") == "真的! 走吧"
    assert one(spark, zh, "1,000人") == "1,000人"
    assert one(spark, lambda c: C.restyle_punctuation(c, F.lit("fr")), "Bien！") == "Bien!"


def test_reading_speed(spark):
    out = spark.range(1).select(C.reading_speed(F.lit("Hello there"), F.lit(1000), F.lit("en")).alias("s")).first().s
    assert (out.cps, out.over_cps, out.over_length) == (11.0, False, False)
    out = spark.range(1).select(C.reading_speed(F.lit("你好你好你好你好你好"), F.lit(1000), F.lit("zh-hans")).alias("s")).first().s
    assert (out.cps, out.over_cps) == (10.0, True)


def test_sdh_rules():
    assert R.strip_cue_sdh(["[DOOR OPENS]"]) == []
    assert R.strip_cue_sdh(["JOHN: we should go"]) == ["We should go"]
    assert R.strip_cue_sdh(["JOHN: Hi.", "MARY: Yo."]) == ["- Hi.", "- Yo."]
    assert R.strip_cue_sdh(["♪ [soft] ♪"]) == ["♪ ♪"]
    assert R.strip_cue_sdh(["At 10:30 we go"]) == ["At 10:30 we go"]
    assert R.strip_cue_sdh(["(A (nested) note) Go"]) == ["Go"]
    assert R.strip_cue_sdh([]) == []


def test_segment_ends():
    assert R.tail_of("Wait...")["ellipsis"] and R.tail_of("Go!")["terminal"] and R.tail_of("a,")["continuing"]
    assert R.tail_of('Yes."')["closed"] and R.tail_of("a--")["terminal"] and R.tail_of("a-")["dash"]
    assert R.head_of("...and")["ellipsis"] and R.head_of("<i>and")["lower"] and R.head_of("♪ And")["upper"]
    assert R.tail_of("")["end"] == 0 and not any(R.head_of("").values())


def test_term_matches_prefer_the_longest():
    hits = R.term_matches("The palace guard saw the palace.", [("palace", "宫"), ("the palace", "宫殿")])
    assert [(h["start"], h["matched"]) for h in hits] == [(0, "The palace"), (21, "the palace")]
    assert R.term_matches("palaces", [("palace", "宫")]) == []


def test_markers():
    assert R.sanitize_markers("⟦c1⟧ a ⟦c1⟧ b ⟦c2", "⟦c1⟧ x") == "⟦c1⟧ a b"
    assert R.repair_markers("⟦c1⟧ a ⟦2⟧ b", "c", ["1", "2"]) == "⟦c1⟧ a ⟦c2⟧ b"
    assert R.strip_unsourced_brackets("a", "b (c (d))") == "b "

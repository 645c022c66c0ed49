"""Worked cases: rules that SQL can't state, over literal rows whose results were worked out by hand.

Each query applies an operator to all rows of its table of cases; its SQL counterpart lists the wanted results."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions import rules as R
from ..operators import align, lookup
from ..operators import sequence as S
from ..sources import connector, html, markdown, srt
from . import synopsis, translate

QUERIES: dict = {}
SQL: dict[str, str] = {}


def cases(name: str, rows: list[tuple], got: Callable[..., Column]) -> None:
    """Registers the rows (inputs, wanted result as text); ``got`` gives the result of the input columns a, b, c ..."""
    width = len(rows[0]) - 1
    inputs = "abcdef"[:width]

    def run(spark, d):
        schema = "case_no int, " + ", ".join(f"{c} string" for c in inputs)
        own = spark.createDataFrame([(k, *row[:-1]) for k, row in enumerate(rows)], schema)
        return own.select("case_no", got(*map(F.col, inputs)).cast("string").alias("got"))

    run.__name__, run.__doc__ = name, f"Worked cases of {name}."
    quoted = lambda x: "CAST(NULL AS VARCHAR)" if x is None else "'" + x.replace("'", "''") + "'"
    QUERIES[name] = run
    SQL[name] = "SELECT * FROM (VALUES " + ", ".join(f"(CAST({k} AS INT), {quoted(row[-1])})" for k, row in enumerate(rows)) + ") AS v(case_no, got)"


def arrow(f: Callable[..., object]):
    """An Arrow function of a plain one; what is no text becomes JSON."""

    def text(x: object) -> str | None:
        return x if x is None or isinstance(x, str) else json.dumps(x, ensure_ascii=False)

    @F.pandas_udf(T.StringType())
    def one(a: pd.Series) -> pd.Series:
        return pd.Series([text(f(x)) for x in a])

    @F.pandas_udf(T.StringType())
    def two(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([text(f(x, y)) for x, y in zip(a, b)])

    @F.pandas_udf(T.StringType())
    def three(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([text(f(x, y, z)) for x, y, z in zip(a, b, c)])

    return lambda *columns: (one, two, three)[len(columns) - 1](*columns)


def flags(struct: Column, names: tuple[str, ...]) -> Column:
    """Names of the flags that are set."""
    return F.array_join(F.array(*[F.when(struct[n], n).otherwise("") for n in names]), " ")


def lines(c: Column) -> Column:
    return F.split(c, r"\|")


# ---- descriptions and labels ----
cases(
    "case_descriptions",
    [
        ("[DOOR OPENS] Hello.", "Hello."),
        ("He said (quietly) no.", "He said no."),
        ("(SIGHS)", ""),
        ("- [COUGHS]", ""),
        ("<i>[RADIO]</i>", ""),
        ("♪ [MUSIC PLAYING] ♪", "♪ ♪"),
        ("（笑）好的。", "好的。"),
        ("Plain text.", "Plain text."),
        ("[one (two)] three", "three"),
    ],
    lambda a: R.clean_line(a),
)
cases(
    "case_labels",
    [
        ("JOHN: Hello.", "Hello."),
        ("JOHN: Hi.|MARY: Ho.", "- Hi.|- Ho."),
        ("JOHN: Hi.|JOHN: Ho.", "Hi.|Ho."),
        ("(LAUGHS|LOUDLY) Yes.", "Yes."),
        ("<i>Hello|there</i>", "<i>Hello|there</i>"),
        ("♪ JOHN: la ♪", "♪ JOHN: la ♪"),
        ("At 12:30 sharp.", "At 12:30 sharp."),
        ("- MAN: Go.|- Where?", "- Go.|- Where?"),
        ("John: Hello.", "John: Hello."),
    ],
    lambda a: F.array_join(R.clean_cue(lines(a)), "|"),
)
cases(
    "case_tags",
    [
        ("<i>one</i> <i>two</i>", "<i>one two</i>"),
        ("<b>one</b> <i>two</i>", "<b>one</b> <i>two</i>"),
        ("<i>a</i><i>b</i>", "<i>ab</i>"),
        ("plain", "plain"),
    ],
    C.collapse_style_wraps,
)
cases(
    "case_style_repair",
    [("<i>one</i>", "<i>one</i>", "<i>one</i>"), ("<i>one", "<i>one</i>", "one"), ("one</b>", "<b>one</b>", "one"), ("plain", "plain", "plain")],
    lambda a, b: C.sanitize_style(a),
)

# ---- ends of segments ----
TAIL = ("terminal", "ellipsis", "continuing", "dash", "closed")
cases(
    "case_tails",
    [
        ("Hello.", "terminal    "),
        ("Wait...", " ellipsis   "),
        ("and so,", "  continuing  "),
        ("but -", "   dash "),
        ("but --", "terminal    "),
        ("\"Go!\"", "terminal    closed"),
        ("end</i>", "    "),
        ("plain", "    "),
        ("等等……", " ellipsis   "),
        ("好。", "terminal    "),
    ],
    lambda a: flags(R.classify_tail(a), TAIL),
)
HEAD = ("ellipsis", "lower", "upper", "closer")
cases(
    "case_heads",
    [("hello", " lower  "), ("Hello", "  upper "), ("...and", "ellipsis lower  "), ("<i>and</i>", " lower  "), ("♪ la", " lower  "), ("）好", "   closer"), ("12 men", " lower  "), ("", "   ")],
    lambda a: flags(R.classify_head(a), HEAD),
)
cases("case_music_goes_on", [("♪ and on we go ♪", "true"), ("♪ And on", "false"), ("♪ ...and on", "false"), ("la la", "true"), ("♪", "false")], S._music_goes_on)
cases(
    "case_leading",
    [("  hello", "2"), ("<i>x</i>", "3"), ("♪ x", "2"), ("x", "0"), ("", "0"), ("<b> y", "4")],
    arrow(lambda x: str(R.skip_leading(x))),
)
cases(
    "case_open_quotes",
    [('"Come', "false", "true"), ('in," he said', "true", "false"), ('"again', "true", "true"), ("(aside", "false", "true"), ("no) more", "true", "false"), ("plain", "true", "true"), ("plain", "false", "false")],
    arrow(lambda x, y: json.dumps(R.quote_pending(x, y == "true"))),
)
cases(
    "case_next_captions",
    [
        ("zh", "他在", "港口等她。", "true"),
        ("zh", "他走了。", "的确如此", "false"),
        ("zh", "他说", "的话", "true"),
        ("zh", "我们走，", "谢谢你", "false"),
        ("zh", "我们走，", "他留下", "true"),
        ("zh", "他走", "他留", "false"),
        ("zh", "他留下", "但是她走", "true"),
        ("ja", "港を", "出た", "true"),
        ("ja", "船が来た", "を", "true"),
        ("ja", "こんにちは", "船が来た", "false"),
        ("ja", "待って…", "を", "false"),
        ("yue", "佢喺", "度", "true"),
    ],
    lambda a, b, c: S._cjk_goes_on(a, b, c, F.lit(100)),
)
cases(
    "case_short_captions",
    [("Yes.", "true"), ("Now!", "true"), ("No, no!", "false"), ("I do not know him at all.", "false"), ("No. 5", "true")],
    lambda a: C.short_reply(C.without_style(a)),
)
cases(
    "case_capitals",
    [("THE END", "true"), ("THE END.", "false"), ("The End", "false"), ("ONE TWO THREE FOUR", "false"), ("BANG", "true"), ("42", "false")],
    lambda a: S.unpunctuated_caption(a, R.classify_tail(a)),
)

# ---- a translation on its spans ----
cases(
    "case_brackets",
    [("a (b) c", "[2, false]"), ("a (b", "[1, true]"), (")(", "[2, true]"), ("plain", "[0, false]"), ("【音】（x", "[3, true]"), ("", "[0, false]")],
    arrow(lambda x: list(align.brackets(x))),
)
cases("case_bracket_costs", [("x", "(y)", "1.0"), ("(x)", "y", "0.5"), ("(x)", "(y)", "0.0"), ("(x", "(y)", "0.5"), ("(x", "y", "1.0"), ("x", "y", "0.0")], arrow(align.bracket_cost))
cases(
    "case_whole_words",
    [
        ("阿诺德·施瓦辛格", "zh", "[]"),
        ("我们走", "zh", "[2]"),
        ("他的船", "zh", "[2]"),
        ("我在家", "zh", "[1]"),
        ("one two", "fr", "[4]"),
        ("他说「好」了吧", "zh-Hant", "[1, 2]"),
        ("3 km", "en", "[2]"),
        ("5% oui", "fr", "[3]"),
    ],
    arrow(lambda x, y: align.Cuts(x, y).words()),
)
cases(
    "case_terms_stay",
    [("去红石镇吧", "红石镇", "[1]"), ("去红石镇吧", "", "[1, 2, 3]"), ("New York now", "New York", "[9]")],
    arrow(lambda x, y: align.Cuts(x, "zh" if "去" in x else "fr", (y,)).words()),
)
cases("case_runs", [("[2]", "6", "[[1, 3]]"), ("[0]", "3", "[[0, 1]]"), ("[1, 4]", "6", "[[0, 5]]"), ("[0, 5]", "6", "[[0, 1], [4, 5]]"), ("[]", "3", "[]")], arrow(lambda x, y: align.bad_runs(json.loads(x), int(y))))
cases(
    "case_goals",
    [("[4.0, 8.0]", "{}", "[4.0, 8.0]"), ("[4.0, 8.0]", '{"0": 6}', "[4.0, 9.0]"), ("[4.0, 8.0]", '{"1": 10}', "[5.0, 8.0]")],
    arrow(lambda x, y: align.between_anchors(json.loads(x), [align.Span("一二三四")] * 3, {int(k): v for k, v in json.loads(y).items()}, 12)),
)
cases("case_nearest", [("[3, 7, 9]", "6", "7"), ("[3, 7]", "5", "3"), ("[]", "5", "null"), ("[1, 20]", "5", "1")], arrow(lambda x, y: json.dumps(align.nearest(json.loads(x), float(y), 0, 15))))
cases(
    "case_edge_signs",
    [("你好|，再见", "你好，|再见"), ("他（|走）", "他|（走）"), ("one|two", "one|two"), ("“|好”", "|“好”")],
    arrow(lambda x: "|".join(align.place_punctuation(x.split("|")))),
)
cases(
    "case_empty_parts",
    [("|你好世界我们再见", "Hello world|we part", "zh", "你好世界|我们再见"), ("un deux|", "one|two", "fr", "un|deux"), ("un|", "one|...", "fr", "un|"), ("a|b", "x|y", "fr", "a|b")],
    arrow(lambda x, y, z: "|".join(align.fill_empty(x.split("|"), [align.Span(s) for s in y.split("|")], z))),
)
cases(
    "case_quote_closure",
    [("他说「好的我|们走」吧", "zh-Hant", "他说「好的我」|「们走」吧"), ("说“好|的”", "zh", "说“好”|“的”"), ("say “so|then”", "en", "say “so|then”"), ("「好」|走", "ja", "「好」|走")],
    arrow(lambda x, y: "|".join(align.close_quotes(x.split("|"), y))),
)
cases(
    "case_empty_styles",
    [("<i>—</i>你好", "<i>Hi</i>", "你好"), ("<i>—</i>你好", "<i>Hi there</i>", "<i>—</i>你好"), ("<b>好</b>", "Hi", "<b>好</b>"), ("<i> </i>嗯", "Hm", "嗯")],
    arrow(align.drop_marker_only),
)
cases(
    "case_bracket_cuts",
    [
        ("（门开了）他走进来", "(DOOR OPENS)|He walks in.", "[3]", "[5]"),
        ("（门开了）他走进来", "(DOOR OPENS)|He walks in.", "[7]", "[7]"),
        ("他走进来", "He walks|in.", "[2]", "[2]"),
    ],
    arrow(lambda x, y, z: align.align_brackets(x, [align.Span(s) for s in y.split("|")], json.loads(z), {}, align.Cuts(""))),
)


def _split(text: str, spans: str, target: str) -> str:
    own = [align.Span(s.split("#")[0], s.split("#")[1] if "#" in s else None) for s in spans.split("|")]
    parts, method = align.split_translation(text, own, target)
    return "|".join(parts) + " " + method


cases(
    "case_splits",
    [
        ("⟦c1⟧ 你好 ⟦c2⟧ 再见", "Hello#1|goodbye#2", "zh", "你好|再见 marker_boundary"),
        ("单个", "one", "zh", "单个 whole"),
        ("他说「好的我们走吧」然后离开", "He said OK, let's go|and then left.", "zh-Hant", "他说「好的我们走吧」|然后离开 word_boundary"),
        ("我们今晚离开，因为船在等。", "We leave tonight,|because the boat waits.", "zh", "我们今晚离开，|因为船在等。 original_boundary"),
        ("Nous partons ce soir. Il attend.", "We leave tonight.|He waits.", "fr", "Nous partons ce soir.|Il attend. original_boundary"),
    ],
    arrow(_split),
)
cases(
    "case_two_lines",
    [
        ("Short line.", "en", "Short line."),
        ("We leave tonight because the boat is waiting in the old harbor.", "en", "We leave tonight because the boat\nis waiting in the old harbor."),
        ("我们今晚离开", "zh", "我们今晚离开"),
        ("我们今晚离开，因为他的船已经在旧港口等了很久了。", "zh", "我们今晚离开，因为他的船\n已经在旧港口等了很久了。"),
        ("<i>We leave tonight because the boat is waiting in the old harbor.</i>", "en", "<i>We leave tonight because the boat\nis waiting in the old harbor.</i>"),
        ("Nobody waits. We will leave before the sun is up again.", "en", "Nobody waits. We will leave\nbefore the sun is up again."),
    ],
    align.wrapped,
)

# ---- markers and replies ----
cases(
    "case_chunks",
    [("⟦c1⟧ one ⟦c2⟧ two", "1=one;2=two"), ("before ⟦c3.1⟧ x", "3.1=x"), ("none", ""), ("⟦c1⟧ a ⟦c1⟧ b ⟦c2⟧ c", "2=c")],
    lambda a: F.array_join(F.transform(F.map_entries(C.cue_chunks(a)), lambda x: F.concat(x["key"], F.lit("="), x["value"])), ";"),
)
cases("case_foreign_markers", [("⟦c1⟧ one ⟦x⟧", "⟦c1⟧ one"), ("[c1] one", "[c1] one"), ("plain", "plain")], lambda a: C.strip(C.strip_foreign_markers(a)))
cases("case_protected", [("a <b>c</b> <x> Kalo", "Kalo", 'a <b>c</b> &lt;x&gt; <span translate="no">Kalo</span>'), ("x & y", "Kalo", "x &amp; y")], lambda a, b: R.protected_html(a, R.glossary_matches([("Kalo", "卡洛")])(a)))
cases(
    "case_translatable",
    [("Kalo!", "false"), ("Kalo runs", "true"), ("...", "false"), ("Kalo, Kalo?", "false"), ("go", "true")],
    lambda a: C.translatable(a, R.glossary_matches([("Kalo", "卡洛")])(a)),
)
cases(
    "case_stops",
    [
        ('<div><span data-id="1">a</span><span data-id="2">b</span></div>', "0,5,31"),
        ('<span data-id="1">a</span> <span data-id="1">b</span>', "0"),
        ("<div>x</div><div>y</div>", "0,12"),
        ("plain", ""),
    ],
    lambda a: F.array_join(C.boundary_stops(a).cast("array<string>"), ","),
)
cases(
    "case_addressable",
    [("marker", "other", "", "true,false"), ("other", "other", "", "false,false"), ("marker", "marker", "done", "true,true")],
    lambda a, b, c: F.array_join(C.addressable(F.array(F.struct(a.alias("boundary")), F.struct(b.alias("boundary"))), F.nullif(c, F.lit(""))).cast("array<string>"), ","),
)
cases("case_single_spans", [("", "true"), ("done", "false")], lambda a: F.array_join(C.addressable(F.array(F.struct(F.lit("end").alias("boundary"))), F.nullif(a, F.lit(""))).cast("array<string>"), ","))

# ---- names, ids, answers ----
cases("case_manual_ids", [("see tt0123456 now", "imdb tt0123456"), ("movie/42", "tmdb 42"), ("none", None), ("", None), ("tt12 7", "tmdb 12")], lambda a: F.when(C.manual_id(a)["kind"].isNotNull(), F.concat_ws(" ", C.manual_id(a)["kind"], C.manual_id(a)["value"])))
cases("case_safe_titles", [("L'été à Kalo-Mo!", "L ete a Kalo Mo"), ("片名", ""), ("A_B  C.", "A B C.")], R.safe)
cases("case_similar_titles", [("The Harbor", "the harbor", "1.0"), ("abcd", "efgh", "0.0"), ("abcd", "abxy", "0.5")], lambda a, b: R.title_similarity(a, b))
cases("case_title_kinds", [("红石 镇2", "红石 镇 2", "exact"), ("红石 镇 一", "红石 镇 二", "partial"), ("红石", "白石", "none"), ("a b", "a c", "partial")], lambda a, b: lookup.group_match(a, b))
cases("case_forced_words", [("NASA 局|X 与 DVD", "NASA,DVD"), ("无", "")], lambda a: F.array_join(lookup.forced_words(lines(a)), ","))
cases("case_quota", [("Quota exceeded", "true"), ("out of CREDIT", "true"), ("bad key", "false"), (None, "false")], C.quota_text)
cases("case_html_lines", [("<div><p>x</p></div>", "<div>\n  <p>\n    x\n  </p>\n</div>"), ("<br/>y", "<br/>\ny"), ("<br>y", "<br>\n  y")], arrow(R.pretty_html))
cases("case_html_inside", [('{"a": [1, "x"], "b": {"c": "<p>1</p>"}}', "<p>1</p>"), ('["a < b", "<i>x</i>"]', "<i>x</i>"), ('{"a": 1}', None)], arrow(lambda x: R.html_inside(json.loads(x))))
cases(
    "case_two_tables",
    [("| a |\n|---|\n| b |\n\n| c |\n|---|", "2"), ("| a |\n| b |", "1"), ("none", "0")],
    lambda a: F.size(synopsis.tables_of(a)),
)
cases("case_terms_back", [("Kalo geht", "Kalo=卡洛", "卡洛 geht"), ("nichts", "Kalo=卡洛", "nichts")], lambda a, b: translate.apply_terms(a, F.array(F.struct(F.split(b, "=").getItem(0).alias("matched"), F.split(b, "=").getItem(1).alias("target"))), F.lit("de")))

# ---- services, files, pages ----
cases(
    "case_event_text",
    [
        ('data: {"choices": [{"delta": {"content": "a"}}]}|data: {"choices": [{"delta": {"content": "b"}, "finish_reason": "length"}]}', '["ab", true]'),
        ('data: {"choices": [{"delta": {"content": "a"}}]}|data: [DONE]|data: {"choices": [{"delta": {"content": "b"}}]}', '["a", false]'),
        (": ping|data: no json", '["", false]'),
    ],
    arrow(lambda x: list(connector.event_text(x.split("|")))),
)
cases(
    "case_halving",
    [("a,b,c,d", '["A", "B", "C", "D"]'), ("a,x,c", '["A", null, "C"]'), ("x", "[null]")],
    arrow(lambda s: connector.halving(lambda items: None if "x" in items else [i.upper() for i in items], s.split(","))),
)
cases("case_merged_turns", [("user:a|user:b|system:c", '[["user", "a\\n\\nb"], ["system", "c"]]'), ("user:a", '[["user", "a"]]')], arrow(lambda s: connector.merge_turns([tuple(x.split(":")) for x in s.split("|")])))
cases(
    "case_file_bytes",
    [("efbbbf4869", '["Hi", "utf-8-sig", true]'), ("fffe48006900", '["Hi", "utf-16-le", true]'), ("4869", '["Hi", "utf-8", false]')],
    arrow(lambda x: list(srt.decode(bytes.fromhex(x)))),
)
_PAGE = '<section data-mw-section-id="0"><p>Lead[1].</p></section><section><h2>{}</h2><p>Body.</p><ul><li>Ana Lo {} Kira</li></ul></section>'
cases(
    "case_page_sections",
    [
        (_PAGE.format("Plot", "as"), "plot", "en", "Body."),
        (_PAGE.format("Plot summary", "as"), "plot", "en", "Body."),
        (_PAGE.format("Handlung", "als"), "plot", "de", "Body."),
        (_PAGE.format("Trivia", "as"), "plot", "en", None),
    ],
    arrow(lambda x, kind, lang: (lambda s: html.paragraphs(s) if s else None)(html.find_section(html.parse(x), kind, lang))),
)
cases(
    "case_page_casts",
    [(_PAGE.format("Cast", "as"), "en", '[["Ana Lo", "Kira"]]'), (_PAGE.format("Besetzung", "als"), "de", '[["Ana Lo", "Kira"]]')],
    arrow(lambda x, lang: [list(p) for p in html.cast(html.find_section(html.parse(x), "cast", lang), lang)]),
)
cases("case_page_leads", [(_PAGE.format("Plot", "as"), "Lead."), ("<p>no lead</p>", None)], arrow(lambda x: html.lead(html.parse(x))))
cases(
    "case_sections",
    [("## A\n\none\n## B\ntwo", "A", "\none\n"), ("## A\none", "C", "")],
    lambda a, b: markdown.section(a, "A") if b is None else F.when(b == "A", markdown.section(a, "A")).otherwise(markdown.section(a, "C")),
)
cases(
    "case_contexts",
    [("A plot.", "en-US", "en", "x", "A plot."), ("Une intrigue.", "en", "fr", "A plot.", "A plot."), ("Une intrigue.", "en", "fr", None, "Une intrigue."), ("A plot.", None, "en", "x", None), ("", "en", "en", "x", None), ("A plot.", "en", None, "B", "B")],
    translate.prepared_context,
)
cases(
    "case_wiki_links",
    [("en=x;fr=y", "fr=Page;de=Seite", "fr:Page"), ("en=x;fr=y", "en=Page;fr=Une page", "en:Page,fr:Une page"), ("en=x", "de=Seite", "")],
    lambda a, b: F.array_join(F.transform(synopsis.wiki_links(F.str_to_map(a, F.lit(";"), F.lit("=")), F.str_to_map(b, F.lit(";"), F.lit("="))), lambda x: F.concat(x["lang"], F.lit(":"), x["title"])), ","),
)
cases(
    "case_source_links",
    [("Kalo", "1999", "A>u;B>v", "t", "**Kalo (1999)** · [A](u) · [B](v)"), ("Kalo", "1999", "", "t", "**Kalo (1999)** · [TMDB](t)")],
    lambda a, b, c, d: synopsis.source_links(a, b, F.transform(F.filter(F.split(c, ";"), lambda x: x != ""), lambda x: F.struct(F.split(x, ">").getItem(0).alias("label"), F.split(x, ">").getItem(1).alias("url"))), d),
)
cases(
    "case_markers_and_tags",
    [("<i>Go</i> now", "<i>Go</i>now"), ("a < b", "a < b"), ("<b>x</b><i>y</i>", "<b>x</b><i>y</i>")],
    lambda a: C.markers_to_tags(C.tags_to_markers(a)),
)


def _retried(fails: str) -> list:
    left = [int(fails)]

    def send(request: str) -> tuple[str | None, str | None]:
        left[0] -= 1
        return (None, "rate_limit") if left[0] >= 0 else (request.upper(), None)

    return list(connector.retrying(send, 3)("go"))


cases("case_retries", [("0", '["GO", null]'), ("2", '["GO", null]'), ("3", '[null, "rate_limit"]')], arrow(_retried))

"""Queries of the subtitle plans: units, alignment, rendering, translation with a stub, pages and prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import align
from ..operators.ordered import latest
from ..sources import connector, html, srt
from . import subtitles, synopsis, translate
from .queries_flow import timed
from .queries_text import SPACE, pairs, t

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def whole_cues(spark, d):
    c = t(spark, d, "cues").groupBy("file_id", "cue_id").agg(F.max_by(F.struct("text", "start_time", "end_time", "lang"), "ingested_at").alias("c"))
    return c.select("file_id", "cue_id", F.coalesce(C.collapse(F.col("c.text")), F.lit("")).alias("text"), "c.start_time", "c.end_time", "c.lang", C.time_ms(F.col("c.start_time")).alias("start_ms"), C.time_ms(F.col("c.end_time")).alias("end_ms")).where(F.col("text") != "")


@query()
def segments(spark, d):
    """Dash lines of captions as segments."""
    return subtitles.segments(whole_cues(spark, d), "file_id", [], F.col("lang")).select("file_id", "cue_id", "dash_index", "text", "resolved", "style_wrap", "music")


@query()
def units(spark, d):
    """Translation units of all files; tested against a loop."""
    own = whole_cues(spark, d)
    lang = own.groupBy("file_id").agg(F.min("lang").alias("l"))
    out = subtitles.units(own.join(lang, "file_id"), "file_id", F.col("l"))
    return out.select("file_id", "unit_id", "chapter_id", "kind", "text", "resolved", F.size("spans").alias("n_spans"))


def translated_units(spark, d):
    u = latest(t(spark, d, "units").select("file_id", "unit_id", "chapter_id", "text", "resolved", "spans"), ["file_id", "unit_id"], ["chapter_id"])
    tr = latest(t(spark, d, "translations").select("file_id", "unit_id", "text", "target_lang", "source_lang", "requested_at", "translation_id"), ["file_id", "unit_id"], ["requested_at", "translation_id"])
    return u, tr


@query()
def split_translations(spark, d):
    """Each translation on the spans of its unit, with the method; tested for one part per span and no lost text."""
    u, tr = translated_units(spark, d)
    j = tr.select("file_id", "unit_id", F.col("text").alias("x"), "source_lang", "target_lang").join(u, ["file_id", "unit_id"])
    p = align.split_parts("x", F.transform("spans", lambda s: s["text"]), F.transform("spans", lambda s: s["marker_id"]), "target_lang", "source_lang")
    return j.select("file_id", "unit_id", p.alias("p"), F.size("spans").alias("n")).select("file_id", "unit_id", "n", "p.parts", "p.method")


@query()
def bilingual_cues(spark, d):
    """Chinese translations on their captions, with reading speed."""
    u, tr = translated_units(spark, d)
    files = tr.where(F.col("target_lang") == "zh").select("file_id").distinct()
    cues = whole_cues(spark, d).join(files, "file_id", "left_semi")
    return subtitles.bilingual_cues(cues, u.join(files, "file_id", "left_semi"), tr, "file_id", "zh-Hans", wrap=True)


@query()
def wrapped_lines(spark, d):
    """Long captions on two lines."""
    own = t(spark, d, "cues").groupBy("cue_key").agg(F.max_by(F.struct("text", "lang"), "ingested_at").alias("c"))
    return own.select("cue_key", align.wrapped(C.collapse(F.col("c.text")), "c.lang").alias("text"))


@query("""WITH c AS (SELECT file_id, cue_id, max_by(text, ingested_at) AS x, max_by(start_time, ingested_at) AS s, max_by(end_time, ingested_at) AS e FROM cues GROUP BY file_id, cue_id),
f AS (SELECT file_id, cue_id, trim(regexp_replace(x, '""" + SPACE + r"""+', ' ', 'g')) AS x, s, e FROM c), g AS (SELECT * FROM f WHERE x <> '')
SELECT file_id, count(*) AS cues, sum(len(x)) AS chars, min(replace(s, '.', ',')) AS first_time, max(replace(e, '.', ',')) AS last_time FROM g GROUP BY file_id""")
def srt_round_trip(spark, d):
    """Captions rendered as files, parsed again and counted. Tags go out first, so that both sides keep them: they are escaped as markers."""
    own = whole_cues(spark, d).withColumn("text", F.translate("text", "<>{}", "‹›⦃⦄")).withColumn("translation", F.lit(None).cast("string"))
    back = srt.cues(srt.render(own, "file_id"), "file_id", "content")
    return back.groupBy("file_id").agg(F.count("*").alias("cues"), F.sum(F.length("text")).alias("chars"), F.min("start_time").alias("first_time"), F.max("end_time").alias("last_time"))


@query("""WITH b AS (SELECT doc_id, unnest(regexp_extract_all(text, '\\d{2}:\\d{2}:\\d{2}[,.]\\d{3}\\s*-->\\s*\\d{2}:\\d{2}:\\d{2}[,.]\\d{3}')) AS x FROM documents WHERE source = 'srt_source') SELECT doc_id, count(*) AS times FROM b GROUP BY doc_id""")
def srt_times(spark, d):
    own = t(spark, d, "documents").where(F.col("source") == "srt_source")
    return own.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(srt.TIME_LINE), 0))).groupBy("doc_id").agg(F.count("*").alias("times"))


@query()
def srt_cues(spark, d):
    """Captions parsed from documents that are subtitle files, without sound descriptions."""
    return srt.cues(t(spark, d, "documents").where(F.col("source") == "srt_source").select("doc_id", "text"), "doc_id", "text", sdh=True).select("doc_id", "cue_id", "start_ms", "end_ms", "text", "dropped", "stripped")


def upper_reply(request: str) -> str:
    """The stub's translation: capitals, markers kept; every seventh unit of a batch is lost, so that recovery has work."""
    import re

    parts = re.split(r"(⟦[a-z]\d+(?:\.\d+)?⟧)", request)
    out = []
    for k, x in enumerate(parts):
        lost = re.fullmatch(r"⟦t(\d+)⟧", x) and int(re.findall(r"\d+", x)[0]) % 7 == 3
        out.append("" if lost else x if x.startswith("⟦") else " ".join(f"{w[::-1]}" for w in x.split()))
    return " ".join(out)


@query()
def translated(spark, d):
    """All units through the stub service and its recovery."""
    u, _ = translated_units(spark, d)
    provider = translate.Provider(connector.Stub(rule=upper_reply))
    out = translate.translate(u, "file_id", F.lit("en"), F.lit("eo"), provider)
    return out.select("file_id", "unit_id", "translation", "problem")


@query("""WITH x AS (SELECT t.file_id, t.unit_id, t.x, u.spans FROM (SELECT file_id, unit_id, max_by(text, (requested_at, translation_id)) AS x FROM translations GROUP BY file_id, unit_id) t JOIN (SELECT file_id, unit_id, max_by(spans, chapter_id) AS spans FROM units GROUP BY file_id, unit_id) u USING (file_id, unit_id)),
m AS (SELECT file_id, unit_id, x, unnest(list_filter(spans, lambda s: s.boundary = 'marker')) AS s FROM x) SELECT file_id, unit_id, s.marker_id AS marker_id FROM m WHERE s.marker_id IS NOT NULL AND NOT contains(coalesce(x, ''), '⟦c' || s.marker_id || '⟧')""")
def missing_cues(spark, d):
    u, tr = translated_units(spark, d)
    own = u.join(tr.select("file_id", "unit_id", F.col("text").alias("translation")), ["file_id", "unit_id"])
    return translate.missing_cues(own, "file_id")


@query("""WITH o AS (SELECT file_id, unit_id, max_by(text, chapter_id) AS x FROM units GROUP BY file_id, unit_id), n AS (SELECT file_id, unit_id, x, sum(len(x) + 1) OVER (PARTITION BY file_id ORDER BY unit_id) - len(x) - 1 AS before FROM o WHERE len(x) > 0)
SELECT file_id, string_agg(x, ' ' ORDER BY unit_id)[1:500] AS sample FROM n WHERE before < 500 GROUP BY file_id""")
def sample_texts(spark, d):
    u, _ = translated_units(spark, d)
    return translate.sample_text(u, "file_id")


_CLEAN = r"trim(regexp_replace(regexp_replace({0}, '\[(\d+|[a-z]|note \d+|注 ?\d+)\]', '', 'g'), '" + SPACE + r"+', ' ', 'g'))"


@query(f"""SELECT doc_id, {_CLEAN.replace("{0}", "split_part(text, chr(10), 1)")} AS lead, {_CLEAN.replace("{0}", "text")} AS plot, coalesce(repo_name, '?') AS director FROM documents WHERE text IS NOT NULL""")
def page_facts(spark, d):
    """Pages made of documents: a lead, a plot section, a fact box of title data."""
    own = t(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", "text", "repo_name")
    page = F.concat(F.lit('<section data-mw-section-id="0"><p>'), C.escape_html(F.substring_index("text", "\n", 1)), F.lit("[1]</p></section><section><h2>Plot</h2><p>"), C.escape_html(F.col("text")), F.lit('</p></section><table class="infobox"><tr><th>Directed by</th><td>'), F.coalesce(C.escape_html(F.col("repo_name")), F.lit("?")), F.lit("</td></tr></table>"))
    out = html.pages(own.select("doc_id", page.alias("html"), F.lit("en").alias("lang")), "doc_id", "html", "lang")
    return out.select("doc_id", "lead", "plot", F.array_join(F.get("infobox", F.lit(0))["values"], "|").alias("director"))


@query("""WITH w AS (SELECT repo_name, max_by(text, (len(text), doc_id)) FILTER (lang = 'en') AS en, max_by(text, (len(text), doc_id)) FILTER (lang = 'es') AS es, max_by(text, (len(text), doc_id)) FILTER (lang = 'de') AS de, max_by(text, (len(text), doc_id)) FILTER (lang = 'fr') AS fr FROM documents WHERE source = 'wiki_plot' AND repo_name IS NOT NULL GROUP BY repo_name),
t AS (SELECT repo_name, k, v, 9000.0 AS f FROM w UNPIVOT (v FOR k IN (en, es, de, fr))), e AS (SELECT repo_name, k, (len(regexp_extract_all(v, '[㐀-䶿一-鿿぀-ヿ가-힯豈-﫿]')) + (len(v) - len(regexp_extract_all(v, '[㐀-䶿一-鿿぀-ヿ가-힯豈-﫿]'))) / 4.0) AS n FROM t),
s AS (SELECT repo_name, coalesce(sum(n) FILTER (k = 'en'), 0) AS en, coalesce(sum(n) FILTER (k = 'es'), 0) AS es, coalesce(sum(n) FILTER (k = 'de'), 0) AS de, coalesce(sum(n) FILTER (k = 'fr'), 0) AS fr, list_sort(list(k)) AS ks FROM e GROUP BY repo_name),
a AS (SELECT *, 9000 + en + es + de + fr > 10000 AS d1 FROM s), b AS (SELECT *, 9000 + en + de + fr + CASE WHEN d1 THEN 0 ELSE es END > 10000 AS d2 FROM a), c AS (SELECT *, 9000 + en + fr + CASE WHEN d1 THEN 0 ELSE es END + CASE WHEN d2 THEN 0 ELSE de END > 10000 AS d3 FROM b)
SELECT repo_name, array_to_string(list_filter(ks, lambda k: NOT ((k = 'es' AND d1) OR (k = 'de' AND d2) OR (k = 'fr' AND d3))), ',') AS kept FROM c""")
def prompt_budgets(spark, d):
    """Plots per film that fit the budget beside 9,000 fixed tokens: Spanish goes first, then German, then French."""
    own = t(spark, d, "documents").where((F.col("source") == "wiki_plot") & F.col("repo_name").isNotNull() & F.col("lang").isin("en", "es", "de", "fr"))
    best = own.groupBy("repo_name", "lang").agg(F.max_by("text", F.struct(F.length("text"), "doc_id")).alias("text"))
    plots = best.groupBy("repo_name").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", "text")))).alias("plots"))
    kept = synopsis.within_budget(F.col("plots"), F.lit(9000.0), F.lit("en"))
    return plots.select("repo_name", F.array_join(F.array_sort(F.map_keys(kept)), ",").alias("kept"))


@query("""SELECT DISTINCT original_language, array_to_string(list_concat([original_language], list_filter(['en', 'zh', 'fr', 'de', 'es'], lambda x: original_language IS NULL OR x <> original_language))[1:3], ',') AS languages FROM titles""")
def language_orders(spark, d):
    order = synopsis.language_order(F.col("original_language"), ["en", "zh", "fr", "de", "es"], 3)
    return t(spark, d, "titles").select("original_language").distinct().select("original_language", F.array_join(order, ",").alias("languages"))


@query("""WITH r AS (SELECT tmdb_id, unnest(max_by(struct_pack(o := original_language, t := title_en, h := overview_zh), updated_at)) FROM titles GROUP BY tmdb_id)
SELECT tmdb_id, '[{"role":"system","content":"Write a synopsis."},{"role":"user","content":' || to_json('{' || array_to_string(list_filter(['"original_language":' || to_json(o), '"title":' || to_json(t), '"human_overview":' || to_json(h)], lambda x: x IS NOT NULL), ',') || '}') || '}]' AS messages FROM r""")
def prompt_messages(spark, d):
    """Chat messages of each film's facts."""
    own = latest(t(spark, d, "titles").select("tmdb_id", "title_en", "title_zh", "overview_zh", "original_language", "updated_at"), ["tmdb_id"], ["updated_at"])
    payload = F.struct("original_language", F.col("title_en").alias("title"), F.col("overview_zh").alias("human_overview"))
    return own.select("tmdb_id", F.to_json(synopsis.messages(payload, "Write a synopsis.")).alias("messages"))


_REQUIRED = ", ".join(f"'{x}'" for x in synopsis.REQUIRED)


@query(f"""WITH s AS (SELECT doc_id, string_split(chr(10) || trim(text, chr(10) || ' ') || chr(10), chr(10) || '## ') AS p FROM documents WHERE source = 'synopsis_md' AND text IS NOT NULL),
n AS (SELECT doc_id, list_transform(p[2:], lambda b: trim(split_part(b, chr(10), 1))) AS all_ FROM s), u AS (SELECT doc_id, list_filter(all_, lambda x, i: NOT list_contains(all_[i + 1:], x)) AS names FROM n)
SELECT doc_id, names, list_filter([{_REQUIRED}], lambda r: NOT list_bool_or(list_prepend(false, list_transform(names, lambda x: contains(x, r)))))[1] AS missing FROM u""")
def synopsis_sections(spark, d):
    """Sections of synopses, and the required one that is missing first."""
    own = t(spark, d, "documents").where(F.col("source") == "synopsis_md").select("doc_id", synopsis.sections_of(F.col("text")).alias("s"))
    return own.select("doc_id", F.map_keys("s").alias("names"), synopsis.required(F.col("s"))["missing"].alias("missing"))


@query("""WITH c AS (SELECT file_id, cue_id, max_by(text, ingested_at) AS x, replace(max_by(start_time, ingested_at), '.', ',') AS s, replace(max_by(end_time, ingested_at), '.', ',') AS e FROM cues GROUP BY file_id, cue_id),
n AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY cue_id) AS i FROM c WHERE trim(x) <> '') SELECT file_id, string_agg(i || chr(10) || s || ' --> ' || e || chr(10) || x, chr(10) || chr(10) ORDER BY cue_id) || chr(10) AS content FROM n GROUP BY file_id""")
def rendered_files(spark, d):
    """Whole subtitle files as text."""
    own = timed(spark, d).where(F.trim("text") != "").select("file_id", "cue_id", F.col("text"), C.time_text(F.col("s")).alias("start_time"), C.time_text(F.col("e")).alias("end_time"), F.lit(None).cast("string").alias("translation"))
    return srt.render(own, "file_id")


@query("""SELECT file_path, regexp_extract(file_path, 'subtitles/([^/]+)/work/source/([^/]+)\\.srt$', 1) AS edition, regexp_extract(file_path, 'subtitles/([^/]+)/work/source/([^/]+)\\.srt$', 2) AS lang FROM subtitle_files GROUP BY file_path""")
def file_targets(spark, d):
    f = t(spark, d, "subtitle_files").select("file_path").distinct().withColumn("t", C.target_of(F.col("file_path")))
    return f.select("file_path", "t.edition", "t.lang")


@query("""WITH tr AS (SELECT file_id, unit_id, max_by(text, (requested_at, translation_id)) AS x FROM translations GROUP BY file_id, unit_id), w AS (SELECT file_id, unit_id, unnest(list_distinct(regexp_extract_all(regexp_replace(x, '\\{\\\\[^}]*\\}|<[^>]*>|⟦[^⟦⟧]*⟧', ' ', 'g'), '[A-Za-z]{2,}'))) AS w FROM tr WHERE x IS NOT NULL AND regexp_matches(x, '[一-鿿]'))
SELECT file_id, unit_id, w AS word FROM w WHERE w NOT IN ('TV', 'DVD')""")
def latin_leaks(spark, d):
    """Latin words left in Chinese translations."""
    own = pairs(spark, d).where(F.col("x").rlike("[一-鿿]"))
    return own.select("file_id", "unit_id", F.explode(C.latin_leaks(F.col("x"), F.array(F.lit("TV"), F.lit("DVD")))).alias("word"))


@query("""WITH a AS (SELECT DISTINCT file_id, unit_id FROM units), b AS (SELECT DISTINCT file_id, unit_id FROM translations WHERE text IS NOT NULL) SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.file_id = a.file_id AND b.unit_id = a.unit_id)""")
def untranslated_targets(spark, d):
    """Units without an output yet."""
    return translate.skip_done(t(spark, d, "units").select("file_id", "unit_id").distinct(), t(spark, d, "translations").where(F.col("text").isNotNull()), ["file_id", "unit_id"])


@query("""SELECT tmdb_id, '(site:movie.douban.com OR site:douban.com) ' || title_en AS q, '# ' || title_en || ' (' || coalesce(CAST(year AS VARCHAR), '') || ')' AS heading FROM titles WHERE title_en IS NOT NULL""")
def search_queries(spark, d):
    own = t(spark, d, "titles").where(F.col("title_en").isNotNull())
    return own.select("tmdb_id", C.scoped_query(F.col("title_en"), ["movie.douban.com", "douban.com"]).alias("q"), C.fill_template(F.lit("# {title} ({year})"), {"title": F.col("title_en"), "year": F.col("year").cast("int")}).alias("heading"))


@query("""WITH s AS (SELECT file_id, unit_id, max_by(spans, chapter_id) AS spans FROM units GROUP BY file_id, unit_id), m AS (SELECT file_id, unit_id, unnest(list_filter(spans, lambda s: s.marker_id IS NOT NULL)) AS s FROM s)
SELECT file_id, unit_id, string_agg(s.marker_id, ' ' ORDER BY CAST(split_part(s.marker_id, '.', 1) AS INT), coalesce(TRY_CAST(nullif(split_part(s.marker_id, '.', 2), '') AS INT), 0)) AS ids FROM m GROUP BY file_id, unit_id""")
def marker_orders(spark, d):
    u, _ = translated_units(spark, d)
    m = u.select("file_id", "unit_id", F.explode("spans").alias("s")).where(F.col("s.marker_id").isNotNull()).select("file_id", "unit_id", F.col("s.marker_id").alias("m"))
    return m.groupBy("file_id", "unit_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(C.marker_order(F.col("m")).alias("o"), "m"))), lambda x: x["m"]), " ").alias("ids"))


@query()
def protected_payloads(spark, d):
    """Unit texts as HTML in which names stay."""
    from ..functions import rules as R
    from .queries_flow import TERMS

    u, _ = translated_units(spark, d)
    return u.select("file_id", "unit_id", R.protected_html("text", R.glossary_matches(TERMS)("text")).alias("html"))


@query()
def patched_units(spark, d):
    """Cues that translations lack, recovered through the stub service."""
    u, tr = translated_units(spark, d)
    own = u.join(tr.select("file_id", "unit_id", F.col("text").alias("translation")), ["file_id", "unit_id"])
    provider = translate.Provider(connector.Stub(rule=upper_reply))
    again = translate.isolated_cues(own, "file_id", provider, F.lit("en"), F.lit("eo"))
    return translate.patched(own, again, "file_id").select("file_id", "unit_id", "translation")

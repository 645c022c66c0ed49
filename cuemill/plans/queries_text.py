"""Queries of the scalar text operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import rules as R
from ..operators import lookup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def cue_texts(spark: SparkSession, d: str, *fields: str) -> DataFrame:
    """Each caption once, with the named fields: a repeated key's rows differ in when they came, and the latest holds. Only what is named is read and shuffled."""
    return t(spark, d, "cues").groupBy("cue_key").agg(F.max_by(F.struct(*(fields or ("text",))), "ingested_at").alias("c")).select("cue_key", "c.*")


#: The captions in SQL, as cue_texts gives them.
CUES = "cu AS (SELECT cue_key, arg_max(text, ingested_at) AS text, arg_max(lang, ingested_at) AS lang, arg_max(start_time, ingested_at) AS start_time, arg_max(end_time, ingested_at) AS end_time, arg_max(file_id, ingested_at) AS file_id, arg_max(cue_id, ingested_at) AS cue_id FROM cues GROUP BY cue_key)"


@query(r"""
WITH s AS (SELECT doc_id, lang, unnest(regexp_extract_all(text, '[^.!?。！？\n]+[.!?。！？]*')) AS s FROM documents WHERE text IS NOT NULL),
k AS (SELECT lang, CASE WHEN regexp_matches(s, '(\.{2,}|-{2,}|—+|…+)\s*$') THEN 'trail_off' WHEN regexp_matches(s, '[,，、]\s*$') THEN 'comma'
  WHEN regexp_matches(s, '[.。!?！？][''"”’)\]」』]*\s*$') THEN 'period' WHEN regexp_matches(s, '[:：]\s*$') THEN 'colon' END AS kind FROM s)
SELECT lang, kind, count(*) AS n FROM k GROUP BY lang, kind""")
def boundary_classes(spark, d):
    """Sentences by language and by how they end."""
    s = t(spark, d, "documents").select("lang", F.explode(F.regexp_extract_all("text", F.lit(r"[^.!?。！？\n]+[.!?。！？]*"), 0)).alias("s"))
    return s.groupBy("lang", C.boundary_class(F.col("s")).alias("kind")).agg(F.count("*").alias("n"))


@query(f"""WITH {CUES} SELECT cue_key,
 (CAST(split_part(replace(start_time, '.', ','), ':', 1) AS BIGINT) * 60 + CAST(split_part(start_time, ':', 2) AS BIGINT)) * 60000 + CAST(replace(replace(split_part(start_time, ':', 3), ',', ''), '.', '') AS BIGINT) AS start_ms,
 (CAST(split_part(end_time, ':', 1) AS BIGINT) * 60 + CAST(split_part(end_time, ':', 2) AS BIGINT)) * 60000 + CAST(replace(replace(split_part(end_time, ':', 3), ',', ''), '.', '') AS BIGINT) AS end_ms FROM cu""")
def cue_times(spark, d):
    return cue_texts(spark, d, "start_time", "end_time").select("cue_key", C.time_ms(F.col("start_time")).alias("start_ms"), C.time_ms(F.col("end_time")).alias("end_ms"))


@query(f"""WITH {CUES}, m AS (SELECT file_id, max((CAST(split_part(end_time, ':', 1) AS BIGINT) * 60 + CAST(split_part(end_time, ':', 2) AS BIGINT)) * 60000 + CAST(replace(replace(split_part(end_time, ':', 3), ',', ''), '.', '') AS BIGINT)) AS last_ms FROM cu GROUP BY file_id)
SELECT file_id, last_ms, printf('%02d:%02d:%02d,%03d', last_ms // 3600000, last_ms // 60000 % 60, last_ms // 1000 % 60, last_ms % 1000) AS last_time FROM m""")
def file_ends(spark, d):
    m = cue_texts(spark, d, "file_id", "end_time").groupBy("file_id").agg(F.max(C.time_ms(F.col("end_time"))).alias("last_ms"))
    return m.withColumn("last_time", C.time_text(F.col("last_ms")))


@query(r"""SELECT doc_id, CASE WHEN contains(text, chr(13) || chr(10)) THEN 'crlf' WHEN contains(text, chr(13)) THEN 'cr' ELSE 'lf' END AS newline FROM documents WHERE text IS NOT NULL""")
def newline_styles(spark, d):
    return t(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", C.newline_style(F.col("text")).alias("newline"))


@query(rf"""WITH {CUES} SELECT cue_key, replace(replace(replace(replace(replace(replace(
 regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '<i>', chr(1)), '</i>', chr(2)), '<b>', chr(3)), '</b>', chr(4)), '<u>', chr(5)), '</u>', chr(6)), '<I>', chr(1)), '</I>', chr(2)), '<B>', chr(3)), '</B>', chr(4)), '<U>', chr(5)), '</U>', chr(6)), '<[^>]+>|\{{[^}}]*\}}', '', 'g'),
 chr(1), '<i>'), chr(2), '</i>'), chr(3), '<b>'), chr(4), '</b>'), chr(5), '<u>'), chr(6), '</u>') AS text FROM cu""")
def tags_kept(spark, d):
    return cue_texts(spark, d).select("cue_key", C.keep_style_tags(F.col("text")).alias("text"))


@query(rf"""WITH {CUES} SELECT cue_key, regexp_replace(text, '</?[ibuIBU]>', '', 'g') AS plain, array_to_string(regexp_extract_all(text, '</?[ibuIBU]>'), '') AS tags FROM cu""")
def style_parts(spark, d):
    return cue_texts(spark, d).select("cue_key", C.without_style(F.col("text")).alias("plain"), C.only_style(F.col("text")).alias("tags"))


@query(rf"""WITH {CUES}, w AS (SELECT cue_key, trim(text, chr(10) || chr(32) || chr(9)) AS s FROM cu),
e AS (SELECT cue_key, s, regexp_extract(s, '(?is)^[♩♪♫♬\s]*<([ibu])>', 1) AS tag, regexp_replace(s, '[♩♪♫♬\s]+$', '') AS cut FROM w),
f AS (SELECT *, tag <> '' AND regexp_matches(cut, '(?i)</' || tag || '>$') AND len(regexp_extract_all(s, '(?i)</?[ibu]>')) = 2 AS hit FROM e)
SELECT cue_key, CASE WHEN hit THEN lower(tag) END AS tag, CASE WHEN hit THEN regexp_replace(regexp_replace(s, '(?i)</?[ibu]>', '', 'g'), '\s', '', 'g') ELSE regexp_replace(s, '\s', '', 'g') END AS body FROM f""")
def full_wraps(spark, d):
    w = cue_texts(spark, d).select("cue_key", C.full_wrap(F.col("text")).alias("w"))
    return w.select("cue_key", "w.tag", C.sub(F.col("w.body"), r"\s", "").alias("body"))


@query(rf"""WITH {CUES} SELECT cue_key, regexp_matches(text, '[♩♪♫♬]') AS music, regexp_matches(text, '[\p{{L}}\p{{N}}_]') AS content,
 len(regexp_extract_all(text, '[A-Za-zªºÀ-ÖØ-öø-ʸḀ-ỿⱠ-Ɀ꜠-ꟿＡ-Ｚａ-ｚ\p{{Nd}}]')) <= 3 AS short, regexp_matches(text, '[A-Za-zªºÀ-ÖØ-öø-ʸḀ-ỿⱠ-Ɀ꜠-ꟿＡ-Ｚａ-ｚ]') AS residual FROM cu""")
def segment_flags(spark, d):
    c = F.col("text")
    return cue_texts(spark, d).select("cue_key", C.is_music(c).alias("music"), C.has_content(c).alias("content"), C.short_reply(c).alias("short"), C.residual_text(c).alias("residual"))


@query(rf"""WITH {CUES} SELECT cue_key, regexp_replace(text, '^[♩♪♫♬\s]+|[♩♪♫♬\s]+$', '', 'g') AS text FROM cu WHERE regexp_matches(text, '[♩♪♫♬]')""")
def edge_notes(spark, d):
    return cue_texts(spark, d).where(C.is_music(F.col("text"))).select("cue_key", C.strip_edge_notes(F.col("text")).alias("text"))


_LETTERS = "string_split('a b c d e f g h i j k l m n o p q r s t u v w x y z', ' ')"


@query(rf"""WITH {CUES}, a AS (SELECT cue_key, text, list_reduce(list_prepend(text, {_LETTERS}), lambda x, l: regexp_replace(x, '(?i)(^|[^a-z])(' || l || ')-' || l || '($|[^a-z])', '\1\2\3', 'g')) AS once FROM cu WHERE text IS NOT NULL),
b AS (SELECT cue_key, text, list_reduce(list_prepend(once, {_LETTERS}), lambda x, l: regexp_replace(x, '(?i)(^|[^a-z])' || l || '-(' || l || '[a-z])', '\1\2', 'g')) AS clean FROM a) SELECT * FROM b WHERE clean <> text""")
def stutters(spark, d):
    """Captions with a stammer, and without it."""
    c = F.col("text")
    return cue_texts(spark, d).select("cue_key", c, C.strip_stutter(c).alias("clean")).where(F.col("clean") != c)


@query(rf"""WITH {CUES}, s AS (SELECT cue_key, list_filter(list_transform(string_split(regexp_replace(regexp_replace(chr(10) || text, '(\s)((?:</?[ibuIBU]>)*)-((?:</?[ibuIBU]>)*[^-]|$)', '\1' || chr(1) || '\3', 'g'), chr(1) || '\s', chr(1), 'g'), chr(1)), lambda x: trim(x, chr(10) || chr(32) || chr(9))), lambda x: x <> '') AS p FROM cu)
SELECT cue_key, greatest(len(p), 1) AS parts FROM s""")
def dialogue_counts(spark, d):
    own = cue_texts(spark, d)
    return own.select("cue_key", F.size(C.dialogue_parts(F.col("text"))).cast("bigint").alias("parts"))


#: Content weight in SQL of the column {0}.
WEIGHT = "(len(regexp_extract_all({0}, '[a-zA-Z]+(?:[''’][a-zA-Z]+)*')) * CAST(2.5 AS DOUBLE) + len(regexp_extract_all({0}, '\\p{{Nd}}')) * CAST(0.5 AS DOUBLE) + len(regexp_extract_all({0}, '[\\p{{L}}\\p{{N}}]')) - len(regexp_extract_all({0}, '[A-Za-z0-9]')))"
#: White space as Unicode has it, for SQL's regular expressions.
SPACE = r"[\s\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@query("SELECT doc_id, " + WEIGHT.format("text") + " AS weight FROM documents WHERE text IS NOT NULL")
def content_weights(spark, d):
    return t(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", C.content_weight(F.col("text")).alias("weight"))


@query("""SELECT lang, count(*) AS docs, sum(w + (len(text) - w) / 4.0) AS tokens FROM (SELECT lang, text, len(regexp_extract_all(text, '[㐀-䶿一-鿿぀-ヿ가-힯豈-﫿]')) AS w FROM documents WHERE text IS NOT NULL) GROUP BY lang""")
def token_estimates(spark, d):
    return t(spark, d, "documents").where(F.col("text").isNotNull()).groupBy("lang").agg(F.count("*").alias("docs"), F.sum(C.token_estimate(F.col("text"))).alias("tokens"))


@query(rf"""WITH {CUES}, m AS (SELECT cue_key, lang, regexp_replace(text, '\{{[^}}]*\}}|</?[a-zA-Z][^>]*>', '', 'g') AS x,
 (CAST(split_part(end_time, ':', 1) AS BIGINT) * 60 + CAST(split_part(end_time, ':', 2) AS BIGINT)) * 60000 + CAST(replace(replace(split_part(end_time, ':', 3), ',', ''), '.', '') AS BIGINT)
 - ((CAST(split_part(start_time, ':', 1) AS BIGINT) * 60 + CAST(split_part(start_time, ':', 2) AS BIGINT)) * 60000 + CAST(replace(replace(split_part(start_time, ':', 3), ',', ''), '.', '') AS BIGINT)) AS ms FROM cu WHERE lang IN ('en', 'fr', 'de', 'es', 'pt', 'ru')),
l AS (SELECT *, list_filter(list_transform(string_split(x, chr(10)), lambda y: trim(regexp_replace(y, '{SPACE}+', ' ', 'g'))), lambda y: y <> '') AS ls FROM m),
p AS (SELECT *, CASE lang WHEN 'en' THEN 20 WHEN 'ru' THEN 17 ELSE 17 END AS c, CASE lang WHEN 'ru' THEN 39 ELSE 42 END AS w FROM l)
SELECT cue_key, round(len(array_to_string(ls, ' ')) / greatest(ms / 1000.0, 0.001), 6) AS cps, len(array_to_string(ls, ' ')) / greatest(ms / 1000.0, 0.001) > c AS over_cps, coalesce(list_max(list_transform(ls, lambda y: len(y))), 0) > w AS over_length FROM p""")
def reading_speeds(spark, d):
    own = cue_texts(spark, d, "text", "lang", "start_time", "end_time").where(F.col("lang").isin("en", "fr", "de", "es", "pt", "ru"))
    s = C.reading_speed(F.col("text"), C.time_ms(F.col("end_time")) - C.time_ms(F.col("start_time")), C.language_key(F.col("lang")))
    return own.select("cue_key", s.alias("s")).select("cue_key", F.round("s.cps", 6).alias("cps"), "s.over_cps", "s.over_length")


_W = "coalesce(nullif(" + WEIGHT.format("y") + ", 0), len(y))"


@query(rf"""WITH {{CUES}}, m AS (SELECT cue_key, lang, regexp_replace(text, '\{{[^}}]*\}}|</?[a-zA-Z][^>]*>', '', 'g') AS x,
 (CAST(split_part(end_time, ':', 1) AS BIGINT) * 60 + CAST(split_part(end_time, ':', 2) AS BIGINT)) * 60000 + CAST(replace(replace(split_part(end_time, ':', 3), ',', ''), '.', '') AS BIGINT)
 - ((CAST(split_part(start_time, ':', 1) AS BIGINT) * 60 + CAST(split_part(start_time, ':', 2) AS BIGINT)) * 60000 + CAST(replace(replace(split_part(start_time, ':', 3), ',', ''), '.', '') AS BIGINT)) AS ms FROM cu WHERE lang IN ('zh', 'ja')),
l AS (SELECT *, list_filter(list_transform(string_split(x, chr(10)), lambda y: trim(regexp_replace(y, '{SPACE}+', ' ', 'g'))), lambda y: y <> '') AS ls FROM m),
n AS (SELECT *, coalesce(list_sum(list_transform(ls, lambda y: {WEIGHT.format("y")})), 0) AS w, coalesce(list_max(list_transform(ls, lambda y: {_W})), 0) AS widest FROM l), k AS (SELECT *, CASE WHEN w > 0 THEN w ELSE len(array_to_string(ls, ' ')) END / greatest(ms / 1000.0, 0.001) AS c FROM n)
SELECT cue_key, round(c, 6) AS cps, c > CASE lang WHEN 'zh' THEN 9 ELSE 4 END AS over_cps, widest > CASE lang WHEN 'zh' THEN 16 ELSE 13 END AS over_length FROM k""".replace("{CUES}", CUES))
def reading_speeds_weighted(spark, d):
    """Captions whose script weighs its characters."""
    own = cue_texts(spark, d, "text", "lang", "start_time", "end_time").where(F.col("lang").isin("zh", "ja"))
    s = C.reading_speed(F.col("text"), C.time_ms(F.col("end_time")) - C.time_ms(F.col("start_time")), C.language_key(F.col("lang")))
    return own.select("cue_key", s.alias("s")).select("cue_key", F.round("s.cps", 6).alias("cps"), "s.over_cps", "s.over_length")


@query(rf"""WITH x AS (SELECT doc_id, lower(replace(trim(coalesce(detectedlanguage, '')), '_', '-')) AS tag FROM documents)
SELECT doc_id, CASE WHEN split_part(tag, '-', 1) <> 'zh' THEN CASE split_part(tag, '-', 1) WHEN 'cantonese' THEN 'yue' WHEN 'lzh' THEN 'zh-hant' WHEN 'iw' THEN 'he' WHEN 'in' THEN 'id' WHEN 'nb' THEN 'no' WHEN 'nn' THEN 'no' WHEN 'fil' THEN 'tl' ELSE split_part(tag, '-', 1) END
 WHEN list_contains(string_split(tag, '-')[2:], 'hant') THEN 'zh-hant' WHEN list_contains(string_split(tag, '-')[2:], 'hans') THEN 'zh-hans' WHEN list_has_any(string_split(tag, '-')[2:], ['tw', 'hk', 'mo']) THEN 'zh-hant' ELSE 'zh-hans' END AS language_key,
 split_part(lower(coalesce((SELECT detectedlanguage FROM documents d WHERE d.doc_id = x.doc_id), '')), '-', 1) AS subtag FROM x""")
def language_keys(spark, d):
    c = F.col("detectedlanguage")
    return t(spark, d, "documents").select("doc_id", C.language_key(c).alias("language_key"), C.primary_subtag(c).alias("subtag"))


_SITE = ", ".join(f"('{k}', '{v}')" for k, v in lookup.SITE_CODE_OF.items())


@query(f"""WITH m(tag, code) AS (VALUES {_SITE}) SELECT coalesce(code, 'none') AS code, count(*) AS docs FROM documents LEFT JOIN m ON split_part(lower(coalesce(detectedlanguage, '')), '-', 1) = m.tag GROUP BY 1""")
def site_codes(spark, d):
    return t(spark, d, "documents").groupBy(F.coalesce(lookup.site_code(F.col("detectedlanguage")), F.lit("none")).alias("code")).agg(F.count("*").alias("docs"))


_SCRIPT = ", ".join(f"('{k}', '{v}')" for k, v in C.SCRIPT_OF.items())
_TR = "tr AS (SELECT file_id, unit_id, arg_max(source_lang, (requested_at, translation_id)) AS s0, max_by(struct_pack(s := source_lang, t := target_lang, x := text), (requested_at, translation_id)) AS r FROM translations GROUP BY file_id, unit_id), un AS (SELECT file_id, unit_id, max_by(text, chapter_id) AS src FROM units GROUP BY file_id, unit_id), pr AS (SELECT file_id, unit_id, r.s AS sl, r.t AS tl, r.x AS x, src FROM tr JOIN un USING (file_id, unit_id))"


def pairs(spark, d):
    """Units with their latest translation."""
    tr = t(spark, d, "translations").groupBy("file_id", "unit_id").agg(F.max_by(F.struct("source_lang", "target_lang", "text"), F.struct("requested_at", "translation_id")).alias("r"))
    un = t(spark, d, "units").groupBy("file_id", "unit_id").agg(F.max_by("text", "chapter_id").alias("src"))
    return tr.join(un, ["file_id", "unit_id"]).select("file_id", "unit_id", F.col("r.source_lang").alias("sl"), F.col("r.target_lang").alias("tl"), F.col("r.text").alias("x"), "src")


@query(rf"""WITH {_TR}, m(code, script) AS (VALUES {_SCRIPT}),
j AS (SELECT pr.*, a.script AS ss, b.script AS ts, trim(regexp_replace(x, '\{{\\[^}}]*\}}|<[^>]*>|⟦[^⟦⟧]*⟧', '', 'g')) AS clean FROM pr LEFT JOIN m a ON split_part(lower(coalesce(sl, '')), '-', 1) = a.code LEFT JOIN m b ON split_part(lower(coalesce(tl, '')), '-', 1) = b.code)
SELECT file_id, unit_id, coalesce(x <> '' AND ss IS NOT NULL AND ts IS NOT NULL AND ss <> ts AND clean <> '' AND
 (CASE ss WHEN 'latin' THEN len(regexp_extract_all(clean, '[A-Za-z]+')) WHEN 'cyrillic' THEN len(regexp_extract_all(clean, '[Ѐ-ӿ]+')) ELSE len(regexp_extract_all(clean, '[㐀-䶿一-鿿぀-ヿ가-힯]')) END)
 > (CASE WHEN (ss = 'latin' AND ts IN ('cjk', 'latin', 'cyrillic')) OR (ss = 'cyrillic' AND ts IN ('latin', 'cyrillic')) THEN 2 ELSE 0 END), false) AS untranslated FROM j""")
def untranslated_units(spark, d):
    return pairs(spark, d).select("file_id", "unit_id", C.untranslated(F.col("x"), F.col("sl"), F.col("tl")).alias("untranslated"))


@query(rf"""WITH {_TR}, n AS (SELECT file_id, unit_id, len(regexp_extract_all(coalesce(src, ''), '[\p{{L}}\p{{N}}_]')) AS a, len(regexp_extract_all(coalesce(x, ''), '[\p{{L}}\p{{N}}_]')) AS b,
 len(regexp_extract_all(coalesce(x, ''), '[⟦⟧]')) > len(regexp_extract_all(coalesce(src, ''), '[⟦⟧]')) AS marker_leak FROM pr)
SELECT file_id, unit_id, CASE WHEN a = 0 THEN true ELSE b / a BETWEEN 0.15 AND 6.0 END AS plausible, marker_leak FROM n""")
def plausible_lengths(spark, d):
    p = pairs(spark, d)
    return p.select("file_id", "unit_id", C.length_plausible(F.col("src"), F.col("x")).alias("plausible"), C.marker_leak(F.col("src"), F.col("x")).alias("marker_leak"))


@query(rf"""WITH {_TR}, o AS (SELECT *, regexp_replace(coalesce(src, ''), '(?i)</?[ibu]>', '', 'g') AS s1, regexp_replace(coalesce(x, ''), '(?i)</?[ibu]>', '', 'g') AS x1 FROM pr),
n AS (SELECT file_id, unit_id, sl, tl, regexp_replace(s1, '[\s\p{{P}}\p{{N}}♩♪♫♬]', '', 'g') AS a, regexp_replace(x1, '[\s\p{{P}}\p{{N}}♩♪♫♬]', '', 'g') AS b, len(regexp_extract_all(s1, '[\p{{L}}\p{{N}}_]+')) AS w FROM o)
SELECT file_id, unit_id, a <> '' AND a = b AND (w > 1 OR coalesce((sl IN ('zh', 'ja')) <> (tl IN ('zh', 'ja')) AND sl <> 'ru' AND tl <> 'ru', false)) AS leaked FROM n""")
def equal_translations(spark, d):
    p = pairs(spark, d)
    return p.select("file_id", "unit_id", C.leaked_untranslated(F.col("src"), F.col("x"), F.col("sl"), F.col("tl")).alias("leaked"))


@query(r"""SELECT tmdb_id, trim(regexp_replace(lower(title_en), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM titles WHERE title_en IS NOT NULL""")
def title_slugs(spark, d):
    return t(spark, d, "titles").where(F.col("title_en").isNotNull()).select("tmdb_id", C.slug(F.col("title_en")).alias("slug"))


@query(r"""WITH x AS (SELECT repo_name, trim(repo_name, '_-') AS n FROM (SELECT DISTINCT repo_name FROM documents WHERE repo_name IS NOT NULL))
SELECT repo_name, trim(regexp_replace(regexp_extract(n, '^(.+)[_-](\d{4})$', 1), '[_-]+', ' ', 'g')) AS title, CAST(regexp_extract(n, '^(.+)[_-](\d{4})$', 2) AS INT) AS year FROM x WHERE regexp_matches(n, '^.+[_-]\d{4}$')""")
def repo_names(spark, d):
    n = t(spark, d, "documents").where(F.col("repo_name").isNotNull()).select("repo_name").distinct().withColumn("p", C.parse_repo_name(F.col("repo_name")))
    return n.where("p.strict").select("repo_name", "p.title", "p.year")


@query(r"""WITH e AS (SELECT DISTINCT edition FROM subtitle_files), x AS (SELECT edition, edition LIKE 'web%' AS web, edition LIKE 'bluray%' AS bluray, regexp_replace(edition, '^(web|bluray)-?', '') AS label FROM e),
s AS (SELECT *, trim(regexp_replace(lower(label), '[^a-z0-9]+', '-', 'g'), '-') AS g FROM x)
SELECT edition, CASE WHEN web AND bluray THEN NULL WHEN web THEN 'web' || CASE WHEN g <> '' THEN '-' || g ELSE '' END WHEN bluray THEN 'bluray' || CASE WHEN g <> '' THEN '-' || g ELSE '' END WHEN g <> '' THEN g END AS name,
 array_to_string(list_filter(regexp_split_to_array(edition, '[-_]+'), lambda k: k <> ''), ',') AS keywords FROM s""")
def edition_names(spark, d):
    e = t(spark, d, "subtitle_files").select("edition").distinct()
    e = e.withColumn("n", C.edition(F.col("edition").startswith("web"), F.col("edition").startswith("bluray"), C.sub(F.col("edition"), "^(web|bluray)-?", "")))
    return e.select("edition", "n.name", C.release_keywords(F.col("edition")).alias("keywords"))


@query(r"""SELECT tmdb_id, nullif(regexp_replace(imdb_id, '^[tT][tT]', ''), '') AS number FROM titles""")
def imdb_numbers(spark, d):
    return t(spark, d, "titles").select("tmdb_id", C.imdb_number(F.col("imdb_id")).alias("number"))


@query(r"""SELECT douban_id, nullif(regexp_extract(url, '/subject/(\d+)', 1), '') AS subject, contains(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1), 'douban.com') AS on_site FROM douban_subjects""")
def subject_ids(spark, d):
    return t(spark, d, "douban_subjects").select("douban_id", C.subject_id(F.col("url")).alias("subject"), C.on_host(F.col("url"), "douban.com").alias("on_site"))


@query(r"""SELECT tmdb_id, CASE WHEN regexp_matches(coalesce(nullif(title_zh, ''), title_en), '[㐀-䶿一-鿿]') THEN '《' || coalesce(nullif(title_zh, ''), title_en) || '》' ELSE coalesce(nullif(title_zh, ''), title_en) END AS title FROM titles""")
def display_titles(spark, d):
    return t(spark, d, "titles").select("tmdb_id", C.display_title(F.col("title_zh"), F.col("title_en")).alias("title"))


@query(r"""WITH s AS (SELECT doc_id, string_split(chr(10) || text || chr(10), chr(10) || '## ') AS p FROM documents WHERE source = 'synopsis_md'), e AS (SELECT doc_id, unnest(p[2:]) AS b FROM s)
SELECT doc_id, trim(split_part(b, chr(10), 1)) AS name, trim(b[len(split_part(b, chr(10), 1)) + 1:], chr(10) || chr(32)) AS body FROM e""")
def markdown_sections(spark, d):
    own = t(spark, d, "documents").where(F.col("source") == "synopsis_md").select("doc_id", F.explode(C.markdown_sections(F.col("text"))).alias("s"))
    return own.select("doc_id", "s.name", "s.body")


@query(r"""SELECT doc_id, replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped, text AS back FROM documents WHERE text IS NOT NULL""")
def html_escapes(spark, d):
    e = C.escape_html(F.col("text"))
    return t(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", e.alias("escaped"), C.unescape_html(e).alias("back"))


@query(rf"""WITH {CUES}, b AS (SELECT cue_key, regexp_replace(regexp_replace(text, '([^\s])([♩♪♫♬])', '\1 \2', 'g'), '([^\s])([♩♪♫♬])', '\1 \2', 'g') AS x FROM cu WHERE regexp_matches(text, '[♩♪♫♬]'))
SELECT cue_key, regexp_replace(regexp_replace(x, '([♩♪♫♬])([^\s])', '\1 \2', 'g'), '([♩♪♫♬])([^\s])', '\1 \2', 'g') AS text FROM b""")
def music_spacing(spark, d):
    return cue_texts(spark, d).where(C.is_music(F.col("text"))).select("cue_key", C.music_spacing(F.col("text")).alias("text"))


@query(r"""SELECT doc_id, regexp_replace(text, '⟦\s*([a-zA-Z]{1,3})\s*(\d+(?:\.\d+)?)\s*⟧', '⟦\1\2⟧', 'g') AS text, len(regexp_extract_all(text, '⟦c\d+(?:\.\d+)?⟧')) AS markers FROM documents WHERE contains(text, '⟦')""")
def markers(spark, d):
    return t(spark, d, "documents").where(F.col("text").contains("⟦")).select("doc_id", C.normalize_markers(F.col("text")).alias("text"), C.count(F.col("text"), r"⟦c\d+(?:\.\d+)?⟧").alias("markers"))


@query(r"""SELECT doc_id, trim(CASE WHEN len(text) <= 120 THEN text WHEN regexp_matches(text[120:120], '[A-Za-z0-9]') AND regexp_matches(text[121:121], '[A-Za-z0-9]') AND contains(text[1:120], ' ') THEN regexp_replace(text[1:120], '\S+$', '') ELSE text[1:120] END, chr(32) || chr(10) || chr(9)) AS context FROM documents WHERE len(text) > 120""")
def contexts(spark, d):
    return t(spark, d, "documents").where(F.length("text") > 120).select("doc_id", C.truncate_context(F.col("text"), 120).alias("context"))


@query()
def cleaned_cues(spark, d):
    """English captions without sound descriptions and speaker labels."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: C.collapse(C.keep_style_tags(x))), lambda x: x != "")
    own = cue_texts(spark, d, "text", "lang").where(F.col("lang") == "en").select("cue_key", lines.alias("lines"))
    return own.select("cue_key", "lines", R.clean_cue("lines").alias("clean"))


def _class(signs) -> str:
    """SQL pattern of a character class, inside quotes."""
    return "[" + "".join("\\x{" + format(ord(c), "x") + "}" for c in sorted(signs)) + "]"


_TAIL_STRIP = rf"(?i)(?:\s|{SPACE}|[\x{{feff}}]|{_class(R.EDGE_MARKS)}|{_class(R.CLOSERS | set(chr(34) + chr(39)))}|</[ibu]>)+$"
HEAD_STRIP = rf"(?i)^(?:\s|{SPACE}|[\x{{feff}}]|{_class(R.EDGE_MARKS)}|</?[ibu]>)+"
#: SQL of the flags of both ends, over a relation x with a column text.
ENDS = rf"""tl AS (SELECT *, regexp_replace(text, '{_TAIL_STRIP}', '') AS body, regexp_replace(text, '{HEAD_STRIP}', '') AS lead FROM x),
td AS (SELECT *, text[len(body) + 1:] AS gone, body[-1:] AS last1, body[-2:] AS last2, regexp_replace(lead, '^["'']+', '') AS inner_, regexp_extract(regexp_replace(lead, '(?i)</?[ibu]>', '', 'g'), '\p{{L}}') AS letter FROM tl),
tf AS (SELECT *, last1 IN ('…', '⋯') OR last2 = '..' AS tail_ellipsis, inner_[1:1] = '…' OR inner_[1:2] = '..' AS head_ellipsis FROM td),
ends AS (SELECT *, last2 = '--' OR (regexp_full_match(last1, '{_class(R.TERMINAL)}') AND NOT tail_ellipsis) AS tail_terminal, regexp_full_match(last1, '{_class(R.CONTINUING)}') AS tail_continuing, last1 = '-' AND last2 <> '--' AS tail_dash,
regexp_matches(gone, '{_class(R.CLOSERS | set(chr(34) + chr(39)))}') AS tail_closed, regexp_full_match(last1, '{_class(R.OPENERS)}') AS tail_opener, CAST(len(body) AS INT) AS tail_end,
regexp_full_match(letter, '\p{{Ll}}') AS head_lower, regexp_full_match(letter, '\p{{Lu}}|\p{{Lt}}') AS head_upper, NOT head_ellipsis AND regexp_full_match(inner_[1:1], '{_class(R.BOUND)}') AS head_closer FROM tf)"""


@query(f"""WITH {CUES}, x AS (SELECT * FROM cu WHERE text IS NOT NULL), {ENDS}
SELECT cue_key, tail_terminal, tail_ellipsis, tail_continuing, tail_dash, tail_closed, tail_opener, tail_end, head_ellipsis, head_lower, head_upper, head_closer FROM ends""")
def segment_ends(spark, d):
    """Flags of how captions begin and end."""
    own = cue_texts(spark, d).select("cue_key", R.classify_tail("text").alias("tail"), R.classify_head("text").alias("head"))
    return own.select("cue_key", *[F.col(f"tail.{f.name}").alias(f"tail_{f.name}") for f in R.TAIL_TYPE], *[F.col(f"head.{f.name}").alias(f"head_{f.name}") for f in R.HEAD_TYPE])


@query()
def normalized_translations(spark, d):
    """Translations in the target's style of punctuation and quotation."""
    p = pairs(spark, d).where(F.col("x").isNotNull())
    normal = C.normalize_translation(F.col("x"), F.col("tl"))
    return p.select("file_id", "unit_id", C.restyle_punctuation(C.trim_final_space(C.rectify_quotes(normal, F.col("src"), F.col("tl")), F.col("src")), F.col("tl")).alias("text"))


@query(r"""SELECT tmdb_id, concat_ws('_', replace(trim(regexp_replace(regexp_replace(replace(replace(regexp_replace(strip_accents(title_en), '[^\x00-\x7F]', '', 'g'), '-', ' '), '_', ' '), '[^A-Za-z0-9 .]+', ' ', 'g'), ' +', ' ', 'g')), ' ', '_'), CAST(year AS VARCHAR)) AS name FROM titles""")
def safe_titles(spark, d):
    """Titles as repository names."""
    return t(spark, d, "titles").select("tmdb_id", F.concat_ws("_", C.sub(R.safe("title_en"), " ", "_"), F.col("year").cast("string")).alias("name"))

"""Queries of the ordered operators, the lookups and the catalogue ranking over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import lookup
from ..operators import sequence as S
from ..operators.ordered import latest, ranks, with_previous, with_running_sum
from ..functions import rules as R
from .queries_text import CUES, ENDS, HEAD_STRIP, cue_texts, t

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


#: Milliseconds of a time text in SQL.
MS = "((CAST(split_part({0}, ':', 1) AS BIGINT) * 60 + CAST(split_part({0}, ':', 2) AS BIGINT)) * 60000 + CAST(replace(replace(split_part({0}, ':', 3), ',', ''), '.', '') AS BIGINT))"
TIMED = f"ti AS (SELECT file_id, cue_id, max_by(text, ingested_at) AS text, {MS.format('max_by(start_time, ingested_at)')} AS s, {MS.format('max_by(end_time, ingested_at)')} AS e FROM cues GROUP BY file_id, cue_id)"


TIMED_LANG = TIMED.replace("max_by(text, ingested_at) AS text", "max_by(text, ingested_at) AS text, max_by(lang, ingested_at) AS lang")


def timed(spark, d):
    c = t(spark, d, "cues").groupBy("file_id", "cue_id").agg(F.max_by(F.struct("text", "start_time", "end_time", "lang"), "ingested_at").alias("c"))
    return c.select("file_id", "cue_id", "c.text", "c.lang", C.time_ms(F.col("c.start_time")).alias("s"), C.time_ms(F.col("c.end_time")).alias("e"))


@query(f"""WITH {TIMED}, k AS (SELECT *, CASE WHEN regexp_matches(text, '[♩♪♫♬]') THEN 'music' ELSE 'dialogue' END AS kind FROM ti),
f AS (SELECT *, CASE WHEN lag(e) OVER w IS NULL OR s - lag(e) OVER w > 30000 THEN 1 ELSE 0 END AS brk FROM k WINDOW w AS (PARTITION BY file_id, kind ORDER BY cue_id)),
n AS (SELECT *, sum(brk) OVER (PARTITION BY file_id, kind ORDER BY cue_id) AS kno FROM f), m AS (SELECT *, min(cue_id) OVER (PARTITION BY file_id, kind, kno) AS p FROM n)
SELECT file_id, cue_id, kind, CAST(dense_rank() OVER (PARTITION BY file_id ORDER BY p) AS INT) AS chapter_id FROM m""")
def chapters(spark, d):
    own = timed(spark, d).withColumn("kind", F.when(C.is_music(F.col("text")), "music").otherwise("dialogue"))
    return S.chapters(own, ["file_id"], "kind", "cue_id", "s", "e").select("file_id", "cue_id", "kind", "chapter_id")


@query("""WITH x AS (SELECT event_id, user_id, event_type, epoch_ms(ts) AS ms, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
f AS (SELECT *, CASE WHEN lag(ms) OVER w IS NULL OR ms - lag(ms) OVER w > 21600000 THEN 1 ELSE 0 END AS brk FROM x WINDOW w AS (PARTITION BY user_id, event_type ORDER BY pos)),
n AS (SELECT *, sum(brk) OVER (PARTITION BY user_id, event_type ORDER BY pos) AS kno FROM f), m AS (SELECT *, min(pos) OVER (PARTITION BY user_id, event_type, kno) AS p FROM n)
SELECT event_id, CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY p) AS INT) AS session_no FROM m""")
def event_sessions(spark, d):
    """Gap sessions of events per user and kind, numbered over all kinds."""
    ms = F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ '1970-01-01', ts)")
    # users' events are ordered by time, event_id breaks ties; their places make the order a whole number
    own = t(spark, d, "events").select("event_id", "user_id", "event_type", ms.alias("ms"))
    pos = ranks(own, ["user_id"], [F.col("ms"), F.col("event_id")], "pos")
    return S.chapters(pos, ["user_id"], "event_type", "pos", "ms", "ms", 21_600_000).select("event_id", F.col("chapter_id").alias("session_no"))


@query(f"""WITH {TIMED} SELECT file_id, cue_id, s - lag(e) OVER (PARTITION BY file_id ORDER BY cue_id) AS gap_ms FROM ti""")
def cue_gaps(spark, d):
    own = with_previous(timed(spark, d), ["file_id"], "cue_id", ["e"])
    return own.select("file_id", "cue_id", (F.col("s") - F.col("previous.e")).alias("gap_ms"))


def _words(own, single: bool = False) -> str:
    own = [w for w in own if len(w) == 1] if single else own
    return "|".join(own) or "[^\\s\\S]"


def _go_on(words) -> str:
    """SQL: whether b goes on with a in a script without spaces, from the columns pbody, lead and pt_ flags."""
    open_end = f"(regexp_matches(pbody, '(?:{_words(words['phrase'])})$') OR (regexp_matches(pbody, '(?:{_words(words['end'], True)})$') AND NOT regexp_matches(pbody, '(?:{_words(words['complete'])})$')))"
    new = f"regexp_matches(lead, '^(?:{_words(words['new'])}|[（(【\\[－―-])')"
    bound = f"regexp_matches(lead, '^(?:{_words(words['start'], True)}|{_words(words['go_on'])})')"
    return f"NOT (pt OR pe OR pcl OR pd) AND gap <= 1500 AND CASE WHEN {open_end} OR pc THEN NOT {new} ELSE {bound} END"


_LATIN_SQL = ", ".join(f"'{x}'" for x in S.LATIN_LANGUAGES)


@query(rf"""WITH {TIMED_LANG}, x AS (SELECT *, split_part(lower(coalesce(lang, '')), '-', 1) AS base, regexp_matches(text, '[♩♪♫♬]') AS music FROM ti), {ENDS},
mu AS (SELECT *, trim(regexp_replace(text, '[♩♪♫♬]', '')) AS bare FROM ends), mv AS (SELECT *, regexp_replace(bare, '{HEAD_STRIP}', '') AS ml FROM mu),
mw AS (SELECT *, regexp_full_match(regexp_extract(regexp_replace(ml, '(?i)</?[ibu]>', '', 'g'), '\p{{L}}'), '\p{{Ll}}') AND NOT regexp_matches(regexp_replace(ml, '^["'']+', ''), '^(…|\.\.)') AS music_on FROM mv),
p AS (SELECT *, s - lag(e) OVER w AS gap, lag(text) OVER w AS ptext, lag(body) OVER w AS pbody, lag(music) OVER w AS pm, lag(cue_id) OVER w AS pcue, lag(tail_terminal) OVER w AS pt, lag(tail_ellipsis) OVER w AS pe, lag(tail_continuing) OVER w AS pc, lag(tail_dash) OVER w AS pd, lag(tail_closed) OVER w AS pcl, lag(tail_opener) OVER w AS po FROM mw WINDOW w AS (PARTITION BY file_id ORDER BY cue_id)),
g AS (SELECT *, base IN ({_LATIN_SQL}) AS latin, CASE base WHEN 'ja' THEN {_go_on(R.JA)} WHEN 'zh' THEN {_go_on(R.ZH)} WHEN 'yue' THEN {_go_on(R.YUE)}
ELSE CASE WHEN pt THEN false WHEN pd THEN gap <= 200 AND head_lower WHEN pe AND head_ellipsis THEN gap <= 1500 WHEN pe AND head_upper THEN false WHEN NOT pe AND pc AND gap <= 1500 THEN true ELSE gap <= 200 OR head_lower END END AS on_,
NOT (pt OR pe OR pc OR pd OR po) AND len(regexp_extract_all(ptext, '[{C.LATIN}]+(?:[''’][{C.LATIN}]+)*')) BETWEEN 1 AND 3 AND ptext = upper(ptext) AND ptext <> lower(ptext) AS shout FROM p)
SELECT file_id, cue_id, CASE WHEN ptext IS NULL OR pm <> music THEN NULL WHEN music THEN CASE WHEN music_on THEN 'music' END WHEN gap < -1000 THEN NULL WHEN head_closer OR po THEN CASE WHEN gap <= 1500 THEN 'gap' END WHEN latin AND shout AND NOT head_lower THEN NULL WHEN on_ THEN 'gap' END AS reason, gap AS gap_ms FROM g""")
def merge_reasons(spark, d):
    """Why each caption goes on with the one before."""
    own = timed(spark, d).select("file_id", "cue_id", F.col("cue_id").cast("bigint").alias("seq"), "text", F.col("s").alias("start_ms"), F.col("e").alias("end_ms"), "lang", C.is_music(F.col("text")).alias("music"))
    return S.merge_reasons(own, ["file_id"], "seq", F.col("lang")).select("file_id", "cue_id", "reason", "gap_ms")


@query("""WITH c AS (SELECT file_id, unit_id, max_by(len(text), chapter_id) AS n FROM units GROUP BY file_id, unit_id),
o AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY unit_id) AS i FROM c),
r AS (WITH RECURSIVE r AS (SELECT file_id, unit_id, i, n, 1 AS batch, n AS used, 1 AS k FROM o WHERE i = 1
  UNION ALL SELECT o.file_id, o.unit_id, o.i, o.n, CASE WHEN r.used + o.n > 2000 OR r.k >= 50 THEN r.batch + 1 ELSE r.batch END, CASE WHEN r.used + o.n > 2000 OR r.k >= 50 THEN o.n ELSE r.used + o.n END, CASE WHEN r.used + o.n > 2000 OR r.k >= 50 THEN 1 ELSE r.k + 1 END
  FROM r JOIN o ON o.file_id = r.file_id AND o.i = r.i + 1) SELECT * FROM r)
SELECT file_id, unit_id, batch AS batch_no FROM r""")
def request_batches(spark, d):
    own = t(spark, d, "units").groupBy("file_id", "unit_id").agg(F.max_by(F.length("text"), "chapter_id").alias("n"))
    return S.pack_next_fit(own, ["file_id"], "unit_id", "n", 2000).select("file_id", "unit_id", "batch_no")


@query("""WITH c AS (SELECT file_id, unit_id, max(chapter_id) AS chapter_id, max_by(len(text), chapter_id) AS n FROM units GROUP BY file_id, unit_id),
k AS (SELECT file_id, chapter_id, sum(n) + 8 AS total FROM c GROUP BY 1, 2), o AS (SELECT c.*, total, total > 4000 AS big, n + 8 > 4000 AS over_, row_number() OVER (PARTITION BY c.file_id ORDER BY c.chapter_id, unit_id) AS i FROM c JOIN k USING (file_id, chapter_id)),
r AS (WITH RECURSIVE r AS (SELECT file_id, unit_id, chapter_id, i, over_ AND big AS oversized, CASE WHEN big AND over_ THEN 0 ELSE 1 END AS batch, CASE WHEN big THEN NULL ELSE total END AS used, CASE WHEN big AND NOT over_ THEN n + 8 END AS inner_ FROM o WHERE i = 1
UNION ALL SELECT o.file_id, o.unit_id, o.chapter_id, o.i, o.big AND o.over_,
CASE WHEN o.big AND o.over_ THEN r.batch WHEN o.big THEN CASE WHEN o.chapter_id <> r.chapter_id OR r.inner_ IS NULL OR r.inner_ + o.n > 4000 THEN r.batch + 1 ELSE r.batch END WHEN o.chapter_id = r.chapter_id THEN r.batch WHEN r.used IS NULL OR r.used + o.total > 4000 THEN r.batch + 1 ELSE r.batch END,
CASE WHEN o.big THEN NULL WHEN o.chapter_id = r.chapter_id THEN r.used WHEN r.used IS NULL OR r.used + o.total > 4000 THEN o.total ELSE r.used + o.total END,
CASE WHEN NOT o.big THEN NULL WHEN o.over_ THEN CASE WHEN o.chapter_id = r.chapter_id THEN r.inner_ END WHEN o.chapter_id <> r.chapter_id OR r.inner_ IS NULL OR r.inner_ + o.n > 4000 THEN o.n + 8 ELSE r.inner_ + o.n END
FROM r JOIN o ON o.file_id = r.file_id AND o.i = r.i + 1) SELECT * FROM r)
SELECT file_id, unit_id, CASE WHEN NOT oversized THEN CAST(batch AS INT) END AS batch_no, oversized FROM r""")
def chapter_batches(spark, d):
    """Whole chapters into batches; tested for capacity, order and completeness."""
    own = latest(t(spark, d, "units").select("file_id", "unit_id", "chapter_id", F.length("text").alias("n")), ["file_id", "unit_id"], ["chapter_id"])
    return S.chapter_batches(own, "file_id", "chapter_id", "unit_id", "n", 4000, 8).select("file_id", "unit_id", "batch_no", "oversized")


@query("""WITH s AS (SELECT file_id, unit_id, unnest(spans) AS s FROM (SELECT file_id, unit_id, max_by(spans, chapter_id) AS spans FROM units GROUP BY file_id, unit_id)),
f AS (SELECT file_id, unit_id, s.id AS cue_id, coalesce(s.dash_index, 0) AS dash_index, s.dash_index IS NOT NULL AS marked FROM s),
g AS (SELECT *, count(*) OVER (PARTITION BY file_id, unit_id, cue_id, marked) AS n, row_number() OVER (PARTITION BY file_id, unit_id, cue_id, marked ORDER BY dash_index) AS k FROM f)
SELECT file_id, unit_id, cue_id, dash_index, CASE WHEN marked AND n > 1 THEN cue_id || '.' || k ELSE CAST(cue_id AS VARCHAR) END AS marker_id FROM g""")
def marker_ids(spark, d):
    own = latest(t(spark, d, "units").select("file_id", "unit_id", "chapter_id", "spans"), ["file_id", "unit_id"], ["chapter_id"])
    spans = own.select("file_id", "unit_id", F.explode("spans").alias("s")).select("file_id", "unit_id", F.col("s.id").alias("cue_id"), F.coalesce("s.dash_index", F.lit(0)).alias("dash_index"), F.col("s.dash_index").isNotNull().alias("marked"))
    return S.marker_ids(spans, ["file_id", "unit_id"]).select("file_id", "unit_id", "cue_id", "dash_index", "marker_id")


@query("""WITH s AS (SELECT file_id, unnest(spans) AS s FROM (SELECT file_id, unit_id, max_by(spans, chapter_id) AS spans FROM units GROUP BY file_id, unit_id))
SELECT file_id, s.id AS cue_id, bool_and(s.kind = 'music') AS music FROM s GROUP BY file_id, s.id""")
def music_cues(spark, d):
    own = latest(t(spark, d, "units").select("file_id", "unit_id", "chapter_id", "spans"), ["file_id", "unit_id"], ["chapter_id"])
    return own.select("file_id", F.explode("spans").alias("s")).groupBy("file_id", F.col("s.id").alias("cue_id")).agg(F.bool_and(F.col("s.kind") == "music").alias("music"))


@query(f"""WITH {TIMED}, l AS (SELECT file_id, cue_id, unnest(string_split(text, chr(10))) AS x FROM ti), y AS (SELECT file_id, cue_id, trim(regexp_replace(x, '</?[ibuIBU]>', '', 'g')) AS x FROM l),
c AS (SELECT file_id, cue_id, count(*) FILTER (x LIKE '- %') AS sp, count(*) FILTER (x LIKE '-%') AS da FROM y GROUP BY file_id, cue_id),
r AS (SELECT *, sum(da) OVER (PARTITION BY file_id ORDER BY cue_id) - da AS before FROM c), g AS (SELECT file_id, sum(sp) AS s, sum(da) AS t FROM r WHERE before < 9 GROUP BY file_id)
SELECT file_id, CASE WHEN t > 0 AND s / t >= 2 / 3 THEN '- ' ELSE '-' END AS style FROM g""")
def dash_styles(spark, d):
    from .subtitles import dash_style

    return dash_style(timed(spark, d), "file_id")


@query("""SELECT md5(text) AS h, count(*) AS copies, min(doc_id) AS first_id FROM documents WHERE text IS NOT NULL GROUP BY text""")
def unique_payloads(spark, d):
    """Equal texts once, as they would be sent once."""
    return t(spark, d, "documents").where(F.col("text").isNotNull()).groupBy("text").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")).select(F.md5("text").alias("h"), "copies", "first_id")


@query("""WITH a AS (SELECT DISTINCT speaker_id, actor_name FROM cast_members), k AS (SELECT DISTINCT lower(trim(regexp_replace(director_name, '\\s+', ' ', 'g'))) AS n FROM titles WHERE director_name IS NOT NULL)
SELECT speaker_id, actor_name FROM a WHERE lower(trim(regexp_replace(coalesce(actor_name, ''), '\\s+', ' ', 'g'))) NOT IN (SELECT n FROM k)""")
def actors_not_directing(spark, d):
    actors = t(spark, d, "cast_members").select("speaker_id", "actor_name").distinct()
    return lookup.without_known(actors, "actor_name", t(spark, d, "titles").where(F.col("director_name").isNotNull()), "director_name")


#: Terms for the glossary queries: places that captions and synopses name.
TERMS = [("Ladulu", "拉杜鲁"), ("Salu", "萨鲁"), ("the lighthouse", "灯塔"), ("lighthouse", "灯塔"), ("Mosalo", "莫萨洛"), ("the palace", "宫殿")]


_TERMS_SQL = ", ".join(f"({k}, '{a}', '{b}')" for k, (a, b) in enumerate(sorted(TERMS, key=lambda x: -len(x[0]))))


@query(f"""WITH tm(rank, term, target) AS (VALUES {_TERMS_SQL}), x AS (SELECT doc_id, text, rank, term, target, unnest(range(len(text) - len(term) + 1)) AS s FROM documents, tm WHERE text IS NOT NULL AND contains(lower(text), lower(term))),
h AS (SELECT doc_id, rank, target, s, s + len(term) AS e, text[s + 1:s + len(term)] AS matched FROM x WHERE lower(text[s + 1:s + len(term)]) = lower(term) AND NOT regexp_matches(text[s:s], '[A-Za-z0-9]') AND NOT regexp_matches(text[s + len(term) + 1:s + len(term) + 1], '[A-Za-z0-9]'))
SELECT doc_id, CAST(s AS INT) AS start, CAST(e AS INT) AS "end", matched, target FROM h WHERE NOT EXISTS (SELECT 1 FROM h o WHERE o.doc_id = h.doc_id AND o.rank < h.rank AND o.s < h.e AND h.s < o.e)""")
def glossary_hits(spark, d):
    """Whole-word hits of terms in all documents, the longest first."""
    return lookup.glossary_hits(t(spark, d, "documents").where(F.col("text").isNotNull()), "doc_id", "text", TERMS)


@query("""WITH w AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
p AS (SELECT doc_id, unnest(l) AS x, unnest(range(len(l))) AS i FROM w), s AS (SELECT doc_id, i AS span_no, x, sum(len(x) + 1) OVER (PARTITION BY doc_id ORDER BY i) - len(x) - 1 AS b FROM p),
c AS (SELECT doc_id, text, unnest(range(len(text) - 2)) AS b FROM documents WHERE contains(lower(text), 'the')),
m AS (SELECT doc_id, b FROM c WHERE lower(text[b + 1:b + 3]) = 'the' AND NOT regexp_matches(text[b:b], '[A-Za-z0-9]') AND NOT regexp_matches(text[b + 4:b + 4], '[A-Za-z0-9]'))
SELECT m.doc_id, s.span_no, CAST(m.b - s.b AS BIGINT) AS start, CAST(m.b + 3 - s.b AS BIGINT) AS "end" FROM m JOIN s ON m.doc_id = s.doc_id AND s.b <= m.b AND m.b + 3 <= s.b + len(s.x)""")
def matches_in_lines(spark, d):
    """The articles of all documents, placed in their lines: equality on the document and a range."""
    own = t(spark, d, "documents").where(F.col("text").isNotNull()).select("doc_id", "text")
    lines = own.select("doc_id", F.posexplode(F.split("text", "\n")).alias("span_no", "x"))
    spans = with_running_sum(lines, ["doc_id"], "span_no", F.length("x") + 1, "_upto").select("doc_id", F.col("span_no").cast("bigint").alias("span_no"), (F.col("_upto") - F.length("x") - 1).alias("start"), (F.col("_upto") - 1).alias("end"))
    found = lookup.glossary_hits(own, "doc_id", "text", [("the", "")]).select("doc_id", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "matched")
    return lookup.contained_matches(found, spans, "doc_id").select("doc_id", "span_no", "start", "end")


@query("""SELECT tmdb_id, list_sort(list_distinct(list_concat(CASE media_type WHEN 'tv' THEN ['subtitles', 'tv-show'] ELSE ['subtitles', 'movie'] END, list_filter([trim(regexp_replace(lower(title_en), '[^a-z0-9]+', '-', 'g'), '-')], lambda x: x <> '')))) AS topics FROM titles WHERE title_en IS NOT NULL""")
def title_topics(spark, d):
    kinds = {"movie": ["subtitles", "movie"], "tv": ["subtitles", "tv-show"]}
    return t(spark, d, "titles").where(F.col("title_en").isNotNull()).select("tmdb_id", F.array_sort(lookup.topics(F.col("media_type"), F.col("title_en"), kinds, "movie")).alias("topics"))


_RANK = "c AS (SELECT year AS k, douban_id AS id, score, row_number() OVER (PARTITION BY year ORDER BY douban_id, fetched_at) AS pos FROM douban_subjects WHERE year IS NOT NULL), n AS (SELECT k, id, count(*) AS n FROM c GROUP BY k, id)"


def by_year(spark, d):
    own = t(spark, d, "douban_subjects").where(F.col("year").isNotNull()).select(F.col("year").alias("k"), F.col("douban_id").alias("id"), "score", "fetched_at")
    return ranks(own, ["k"], [F.col("id"), F.col("fetched_at")], "pos").select("k", "id", "score", "pos")


@query(f"""WITH {_RANK} SELECT c.k, c.id, c.pos, row_number() OVER (PARTITION BY c.k ORDER BY coalesce(score, 0) DESC, n.n DESC, pos) AS place FROM c JOIN n ON c.k = n.k AND c.id = n.id""")
def ranked_candidates(spark, d):
    return lookup.ranked_candidates(by_year(spark, d), "k").select("k", "id", "pos", "place")


@query(f"""WITH {_RANK}, r AS (SELECT c.k, c.id, score, row_number() OVER (PARTITION BY c.k ORDER BY coalesce(score, 0) DESC, n.n DESC, pos) AS place FROM c JOIN n ON c.k = n.k AND c.id = n.id),
u AS (SELECT k, count(DISTINCT id) AS ids FROM c GROUP BY k)
SELECT r.k, r.id, CASE WHEN CASE WHEN score IS NOT NULL THEN score >= 0.4 ELSE ids = 1 END THEN 'success' ELSE 'low_confidence' END AS status FROM r JOIN u ON r.k = u.k WHERE place = 1""")
def candidate_status(spark, d):
    return lookup.candidate_status(by_year(spark, d), "k")


@query()
def best_titles(spark, d):
    """For each title the most similar subject of about its year."""
    wanted = latest(t(spark, d, "titles").select("tmdb_id", F.col("title_en").alias("title"), "year", "updated_at"), ["tmdb_id"], ["updated_at"])
    subjects = latest(t(spark, d, "douban_subjects").select(F.col("douban_id").alias("id"), F.col("title_en").alias("name"), F.col("year").alias("released"), "fetched_at"), ["id"], ["fetched_at"]).where(F.col("name").isNotNull())
    return lookup.best_titles(wanted, subjects, "tmdb_id")


@query("""WITH x AS (SELECT tmdb_id, lower(title_en) AS a, lower(repo_name) AS b FROM titles WHERE title_en IS NOT NULL),
g AS (SELECT tmdb_id, list_filter(regexp_split_to_array(regexp_replace(a, '([\\p{L}_])(\\p{N}+)[^\\p{L}\\p{N}_]*$', '\\1 \\2'), '[^\\p{L}\\p{N}_]+'), lambda z: z <> '') AS g FROM x) SELECT tmdb_id, len(g) AS groups, g[1] AS first FROM g""")
def title_groups(spark, d):
    own = t(spark, d, "titles").where(F.col("title_en").isNotNull()).withColumn("g", lookup.title_groups(F.col("title_en")))
    return own.select("tmdb_id", F.size("g").cast("bigint").alias("groups"), F.get("g", F.lit(0)).alias("first"))


@query("""WITH e AS (SELECT DISTINCT edition FROM subtitle_files) SELECT edition, array_to_string(list_filter(regexp_split_to_array(edition, '[-_]+'), lambda k: k <> ''), ',') AS keywords, 'en:eng,zh-Hans:chi,fr:fre' AS languages FROM e""")
def edition_jobs(spark, d):
    jobs = lookup.edition_jobs(t(spark, d, "subtitle_files").select("edition").distinct(), ["en", "zh-Hans", "tlh", "fr"])
    return jobs.select("edition", "keywords", F.array_join(F.transform("languages", lambda x: F.concat(x["tag"], F.lit(":"), x["code"])), ",").alias("languages"))


_OLD = ", ".join(f"('{a}', '{b.lower()}')" for a, b in lookup.LEGACY_TAGS.items())


@query(f"""WITH old_(tag_, new_) AS (VALUES {_OLD}), l(ord, tag, code) AS (VALUES (1, 'en', 'en'), (2, 'zh-Hans', 'zh-CN'), (3, 'zh-Hant', 'zh-TW'), (4, 'pt-BR', 'pt-BR'), (5, 'pt', 'pt'), (6, 'fr', 'fr'), (7, 'de', 'de'), (8, 'es', 'es'), (9, 'ru', 'ru'), (10, 'ja', 'ja')),
b AS (SELECT split_part(lower(tag), '-', 1) AS k, arg_min(code, (CASE WHEN lower(tag) = split_part(lower(tag), '-', 1) THEN 0 ELSE 1 END) * 100 + ord) AS code FROM l GROUP BY 1)
SELECT doc_id, coalesce((SELECT code FROM l WHERE lower(tag) = g), (SELECT code FROM b WHERE k = split_part(g, '-', 1))) AS provider_code FROM (SELECT doc_id, coalesce((SELECT new_ FROM old_ WHERE tag_ = replace(lower(trim(detectedlanguage)), '_', '-')), replace(lower(trim(detectedlanguage)), '_', '-')) AS g FROM documents)""")
def provider_languages(spark, d):
    tags = ("en", "zh-Hans", "zh-Hant", "pt-BR", "pt", "fr", "de", "es", "ru", "ja")
    codes = {"zh-Hans": "zh-CN", "zh-Hant": "zh-TW"}
    languages = spark.createDataFrame([(i + 1, x, codes.get(x, x)) for i, x in enumerate(tags)], "ord int, tag string, code string")
    return lookup.resolve_languages(t(spark, d, "documents").select("doc_id", "detectedlanguage"), "detectedlanguage", lookup.language_index(languages)).select("doc_id", "provider_code")


@query("""WITH p AS (SELECT tmdb_id, max_by(title_en, updated_at) AS source, max_by(title_zh, updated_at) AS target FROM titles GROUP BY tmdb_id), x AS (SELECT tmdb_id, trim(source) AS term, trim(target) AS target FROM p WHERE source IS NOT NULL AND target IS NOT NULL)
SELECT term, arg_min(target, tmdb_id) AS target FROM x WHERE len(regexp_split_to_array(term, '\\s+')) <> len(regexp_split_to_array(target, '[·・]')) OR len(regexp_split_to_array(term, '\\s+')) < 2 GROUP BY term""")
def glossary_from_titles(spark, d):
    """Terms from title pairs; the first definition holds."""
    own = latest(t(spark, d, "titles").select("tmdb_id", F.col("title_en").alias("source"), F.col("title_zh").alias("target"), "updated_at"), ["tmdb_id"], ["updated_at"])
    return lookup.glossary_from_pairs(own.where(F.col("source").isNotNull() & F.col("target").isNotNull()).select(F.col("tmdb_id").alias("ord"), "source", "target")).select("term", "target")


@query(f"""WITH {CUES} SELECT file_id, count(*) AS cues, count(DISTINCT lang) AS langs, min(cue_id) AS first_id, max(cue_id) AS last_id FROM cu GROUP BY file_id""")
def file_summary(spark, d):
    return cue_texts(spark, d, "file_id", "lang", "cue_id").groupBy("file_id").agg(F.count("*").alias("cues"), F.count_distinct("lang").alias("langs"), F.min("cue_id").alias("first_id"), F.max("cue_id").alias("last_id"))

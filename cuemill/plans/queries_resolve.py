"""Queries of the resolution plans: requests to catalogue entries, search results to subjects, answers with retries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import lookup
from ..operators.ordered import latest, ranks
from ..sources import connector
from . import resolution, synopsis, translate
from .queries_text import t

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_TITLES = """ti AS (SELECT tmdb_id, unnest(max_by(struct_pack(imdb_id := imdb_id, repo_name := repo_name, media_type := media_type, title_en := title_en, title_zh := title_zh, year := year), updated_at)) FROM titles GROUP BY tmdb_id)"""


def _titles(spark, d):
    return latest(t(spark, d, "titles").select("tmdb_id", "imdb_id", "repo_name", "media_type", "title_en", "title_zh", "year", "updated_at"), ["tmdb_id"], ["updated_at"])


_REQUESTS = _TITLES + """, r AS (SELECT tmdb_id AS request,
CASE tmdb_id % 6 WHEN 0 THEN ' ' || imdb_id || ' please' WHEN 1 THEN 'tmdb ' || tmdb_id WHEN 2 THEN 'no id' ELSE '' END AS manual,
CASE WHEN tmdb_id % 6 = 3 THEN 'see https://www.themoviedb.org/' || media_type || '/' || tmdb_id || ' and https://www.imdb.com/title/tt0000001' WHEN tmdb_id % 6 = 4 THEN '[x](https://www.imdb.com/title/' || imdb_id || '/)' END AS readme FROM ti)"""


def _requests(spark, d):
    i = F.col("tmdb_id")
    manual = F.when(i % 6 == 0, F.concat(F.lit(" "), "imdb_id", F.lit(" please"))).when(i % 6 == 1, F.concat(F.lit("tmdb "), i.cast("string"))).when(i % 6 == 2, "no id").otherwise("")
    readme = F.when(i % 6 == 3, F.concat(F.lit("see https://www.themoviedb.org/"), "media_type", F.lit("/"), i.cast("string"), F.lit(" and https://www.imdb.com/title/tt0000001"))).when(i % 6 == 4, F.concat(F.lit("[x](https://www.imdb.com/title/"), "imdb_id", F.lit("/)")))
    return _titles(spark, d).select(F.col("tmdb_id").alias("request"), manual.alias("manual"), readme.alias("readme"), F.lit(None).cast("string").alias("repo"))


@query(f"""WITH {_REQUESTS},
k AS (SELECT request, CASE WHEN trim(manual) <> '' THEN CASE WHEN regexp_matches(manual, 'tt\\d{{6,9}}') THEN 'imdb' WHEN regexp_matches(manual, '\\d') THEN 'tmdb' END WHEN readme LIKE '%themoviedb%' THEN 'tmdb' WHEN regexp_matches(readme, 'title/tt\\d+') THEN 'imdb' END AS kind,
CASE WHEN trim(manual) <> '' THEN coalesce(nullif(regexp_extract(manual, 'tt\\d{{6,9}}'), ''), nullif(regexp_extract(manual, '\\d+'), '')) WHEN readme LIKE '%themoviedb%' THEN regexp_extract(readme, 'themoviedb\\.org/(movie|tv)/(\\d+)', 2) ELSE nullif(regexp_extract(readme, 'title/(tt\\d+)', 1), '') END AS value, CASE WHEN trim(manual) <> '' THEN 'invalid_repo_name' ELSE 'readme_not_found' END AS lack FROM r),
h AS (SELECT k.request, arg_min(ti.tmdb_id, (CASE media_type WHEN 'movie' THEN 0 WHEN 'tv' THEN 1 ELSE 2 END, ti.tmdb_id)) AS tmdb_id FROM k JOIN ti ON (kind = 'imdb' AND ti.imdb_id = value) OR (kind = 'tmdb' AND CAST(ti.tmdb_id AS VARCHAR) = value) GROUP BY 1)
SELECT k.request, h.tmdb_id IS NOT NULL AS success, CASE WHEN kind IS NULL THEN lack WHEN h.tmdb_id IS NULL THEN CASE kind WHEN 'tmdb' THEN 'network_error' ELSE 'not_found' END END AS reason, h.tmdb_id, ti.imdb_id, ti.title_en, ti.year FROM k LEFT JOIN h ON h.request = k.request LEFT JOIN ti ON ti.tmdb_id = h.tmdb_id""")
def resolved_ids(spark, d):
    """Requests by typed ids and by links of their pages."""
    own = resolution.identities(_requests(spark, d), "manual", "readme", "repo")
    return resolution.entities(own, _titles(spark, d), "request").select("request", "success", "reason", "tmdb_id", "imdb_id", "title_en", "year")


@query()
def resolved_names(spark, d):
    """Requests by the repository's name alone; the search by likeness has no SQL, tests hold it against a loop."""
    own = _titles(spark, d).where(F.col("repo_name").isNotNull()).select(F.col("tmdb_id").alias("request"), F.lit(None).cast("string").alias("manual"), F.lit(None).cast("string").alias("readme"), F.col("repo_name").alias("repo"))
    return resolution.entities(resolution.identities(own, "manual", "readme", "repo"), _titles(spark, d), "request").select("request", "success", "reason", "tmdb_id", "canonical_repo_name")


# Search results of a title: the subjects of its latin title in lower case; the first provider has every second one.
_FOUND = """s AS (SELECT douban_id, unnest(max_by(struct_pack(title := title, title_en := title_en, score := score), (fetched_at, title))) FROM douban_subjects GROUP BY douban_id),
c AS (SELECT lower(title_en) AS k, douban_id AS id, title, CASE WHEN ascii(right(douban_id, 1)) % 3 = 0 THEN NULL ELSE score / 10 END AS score, ascii(right(douban_id, 1)) % 2 AS p, row_number() OVER (PARTITION BY lower(title_en) ORDER BY douban_id) AS pos FROM s WHERE title_en IS NOT NULL),
q AS (SELECT lower(title_en) AS k, list(DISTINCT title_zh) FILTER (title_zh <> '') AS hints FROM titles WHERE title_en IS NOT NULL GROUP BY 1)"""
_GROUPS = r"list_filter(regexp_split_to_array(regexp_replace(lower(X), '([\p{L}_])(\p{N}+)[^\p{L}\p{N}_]*$', '\1 \2'), '[^\p{L}\p{N}_]+'), lambda z: z <> '')"
_SUFFIX = r"regexp_replace(c.title, '\s*-\s*(电影|电视剧|剧集|综艺|纪录片)\s*(-\s*豆瓣\s*)?$', '')"


def _status(source: str) -> str:
    """SQL of evaluated() over candidates of the given name."""
    return f"""n AS (SELECT k, id, count(*) AS n FROM {source} GROUP BY 1, 2), o AS (SELECT c.*, row_number() OVER (PARTITION BY c.k ORDER BY coalesce(score, 0) DESC, n.n DESC, pos) AS place FROM {source} c JOIN n USING (k, id)),
u AS (SELECT k, count(DISTINCT id) AS ids FROM {source} GROUP BY k), top AS (SELECT o.k, o.id FROM o JOIN u USING (k) WHERE place = 1 AND CASE WHEN score IS NOT NULL THEN score >= 0.4 ELSE ids = 1 END),
hg AS (SELECT k, unnest(hints) AS h FROM q), g AS (SELECT hg.k, {_GROUPS.replace('X', 'h')} AS a FROM hg), cg AS (SELECT c.k, c.id, c.place, {_GROUPS.replace('X', _SUFFIX)} AS b FROM o c),
m AS (SELECT cg.k, cg.id, cg.place, min(CASE WHEN a = b THEN 0 WHEN least(len(a), len(b)) > 1 AND a[1:least(len(a), len(b)) - 1] = b[1:least(len(a), len(b)) - 1] THEN 1 END) AS kind FROM cg JOIN g USING (k) GROUP BY 1, 2, 3),
e AS (SELECT k, kind, id, min(place) AS place FROM m WHERE kind IS NOT NULL GROUP BY 1, 2, 3), l AS (SELECT k, kind, string_agg(id, ',' ORDER BY place) AS ids, count(*) AS n FROM e GROUP BY 1, 2), b AS (SELECT k, arg_min(ids, kind) AS ids, arg_min(n, kind) AS n, min(kind) AS kind FROM l GROUP BY 1)
SELECT u.k, CASE WHEN top.id IS NOT NULL OR (b.kind = 0 AND b.n = 1) THEN 'success' WHEN b.kind IS NOT NULL THEN 'ambiguous' ELSE 'none' END AS status, coalesce(top.id, b.ids, '') AS ids FROM u LEFT JOIN top USING (k) LEFT JOIN b USING (k)"""


def _search(spark, d):
    s = latest(t(spark, d, "douban_subjects").select("douban_id", "title", "title_en", "score", "fetched_at"), ["douban_id"], ["fetched_at", "title"]).where(F.col("title_en").isNotNull())
    last = F.ascii(F.right("douban_id", F.lit(1)))
    rows = s.select(F.lower("title_en").alias("k"), F.col("douban_id").alias("id"), "title", F.when(last % 3 == 0, F.lit(None)).otherwise(F.col("score") / 10).alias("score"), (last % 2).alias("p"))
    hints = t(spark, d, "titles").where(F.col("title_en").isNotNull()).groupBy(F.lower("title_en").alias("k")).agg(F.collect_set(F.when(F.col("title_zh") != "", F.col("title_zh"))).alias("hints"))
    return ranks(rows, ["k"], [F.col("id")], "pos"), hints


@query(f"WITH {_FOUND}, {_status('c')}")
def evaluated_candidates(spark, d):
    """Search results of each title: sure, exact, ambiguous or none."""
    rows, hints = _search(spark, d)
    return lookup.evaluated(rows, hints, "k").select("k", "status", F.array_join("ids", ",").alias("ids"))


@query(f"""WITH {_FOUND}, c1 AS (SELECT * FROM c WHERE p = 0), one AS (WITH {_status('c1')}), left_ AS (SELECT k FROM q WHERE k NOT IN (SELECT k FROM one WHERE status <> 'none')),
c2 AS (SELECT k, id, title, score, p, pos + p * 4294967296 AS pos FROM c WHERE k IN (SELECT k FROM left_)), two AS (WITH {_status('c2')}), f AS (SELECT * FROM one WHERE status <> 'none' UNION ALL SELECT * FROM two)
SELECT q.k, coalesce(status = 'success', false) AS success, CASE WHEN status = 'success' THEN split_part(ids, ',', 1) END AS id,
CASE WHEN status = 'success' THEN NULL WHEN status = 'ambiguous' THEN 'low_confidence' WHEN q.k IN (SELECT k FROM c2) THEN 'not_found' WHEN len(q.k) % 3 = 0 THEN 'multiple_errors' WHEN len(q.k) % 3 = 1 THEN 'rate_limit' ELSE 'not_found' END AS reason, CASE WHEN status = 'ambiguous' THEN ids ELSE '' END AS ids FROM q LEFT JOIN f ON f.k = q.k""")
def resolved_subjects(spark, d):
    """Two search providers in turn; where both fail, why."""
    rows, hints = _search(spark, d)
    n = F.length("k") % 3
    errors = hints.select("k", F.explode(F.when(n == 0, F.array(F.lit("rate_limit"), F.lit("server_error"))).when(n == 1, F.array(F.lit("rate_limit"), F.lit("rate_limit"))).otherwise(F.array().cast("array<string>"))).alias("type"))
    out = lookup.with_fallback(hints.select("k"), rows.where("p = 0"), rows.where("p = 1"), hints, errors, "k")
    return out.select("k", "success", "id", "reason", F.array_join("ids", ",").alias("ids"))


@query("""SELECT tmdb_id, CASE WHEN s IN (401, 403) THEN 'auth_error' WHEN s = 429 THEN 'rate_limit' WHEN s >= 500 THEN 'server_error' ELSE 'network_error' END AS reason FROM (SELECT DISTINCT tmdb_id, [200, 400, 401, 403, 404, 429, 500, 503][1 + tmdb_id % 8] AS s FROM titles)""")
def call_errors(spark, d):
    """Statuses of failed calls as reasons."""
    own = t(spark, d, "titles").select("tmdb_id").distinct()
    status = F.element_at(F.array(*map(F.lit, (200, 400, 401, 403, 404, 429, 500, 503))), (F.col("tmdb_id") % 8 + 1).cast("int"))
    return own.select("tmdb_id", C.http_reason(status).alias("reason"))


def _answer(request: str) -> str | None:
    """The stub's answer: sections are whole only where few plots were sent; a film of a year that ends in 9 never gets them."""
    import json

    own = json.loads(request)
    whole = len(own["plots"]) <= 2 and own["year"] % 10 != 9
    names = synopsis.REQUIRED if whole else synopsis.REQUIRED[:-1]
    table = "| a | b |\n|---|---|\n| x | y |"
    return "\n\n".join(f"## {n}\n\n{table}\n\n{table}" for n in names)


_PLOTS = """w AS (SELECT repo_name, list_sort(list(DISTINCT lang)) AS langs FROM documents WHERE source = 'wiki_plot' AND repo_name IS NOT NULL AND text IS NOT NULL AND lang IN ('en', 'de', 'es', 'fr') GROUP BY 1)"""


@query(f"""WITH {_PLOTS}, f AS (SELECT repo_name, langs, CAST(regexp_extract(repo_name, '(\\d)$', 1) AS INT) = 9 AS never, len(langs) AS n, len(list_filter(langs, lambda x: x <> 'es')) AS n2, len(list_filter(langs, lambda x: x NOT IN ('es', 'de'))) AS n3 FROM w WHERE regexp_matches(repo_name, '_\\d{{4}}$'))
SELECT repo_name, CAST(CASE WHEN never THEN 3 WHEN n <= 2 THEN 0 WHEN n2 <= 2 THEN 2 ELSE 3 END AS INT) AS retries, NOT never AND (n <= 2 OR n2 <= 2 OR n3 <= 2) AS success, CASE WHEN never OR NOT (n <= 2 OR n2 <= 2 OR n3 <= 2) THEN 'malformed_llm_output' END AS reason FROM f""")
def answered_synopses(spark, d):
    """Facts, prompt, answer and sections, again where the answer was malformed; from the second retry on a plot less each time."""
    own = t(spark, d, "documents").where((F.col("source") == "wiki_plot") & F.col("repo_name").rlike(r"_\d{4}$") & F.col("text").isNotNull() & F.col("lang").isin("en", "de", "es", "fr"))
    best = own.groupBy("repo_name", "lang").agg(F.max_by("text", F.struct(F.length("text"), "doc_id")).alias("text"))
    facts = best.groupBy("repo_name").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("lang", "text")))).alias("plots")).withColumn("year", F.regexp_extract("repo_name", r"_(\d{4})$", 1).cast("int"))
    return synopsis.answered(facts, "repo_name", "plots", ["year"], connector.Stub(rule=_answer)).select("repo_name", "retries", "success", "reason")


_JOBS = "CASE cast_order WHEN 0 THEN 'Director' WHEN 1 THEN 'Screenplay' WHEN 2 THEN 'Writer' ELSE 'cast' END"
_PEOPLE = f"p AS (SELECT DISTINCT tmdb_id, cast_order AS pos, actor_name AS name, {_JOBS} AS job FROM cast_members)"


def _people(spark, d):
    job = F.when(F.col("cast_order") == 0, "Director").when(F.col("cast_order") == 1, "Screenplay").when(F.col("cast_order") == 2, "Writer").otherwise("cast")
    return t(spark, d, "cast_members").select("tmdb_id", F.col("cast_order").alias("pos"), F.col("actor_name").alias("name"), job.alias("job")).distinct()


@query(f"""WITH {_PEOPLE}, r AS (SELECT tmdb_id, CASE job WHEN 'Director' THEN 'director' ELSE 'writer' END AS role, string_agg(name, '|' ORDER BY pos, name) AS names FROM p WHERE job <> 'cast' GROUP BY 1, 2),
c AS (SELECT tmdb_id, string_agg(role || '=' || names, ';' ORDER BY role) AS crew FROM r GROUP BY 1), a AS (SELECT tmdb_id, string_agg(name, '|' ORDER BY pos, name) AS "cast" FROM p WHERE job = 'cast' AND pos < 5 GROUP BY 1)
SELECT coalesce(c.tmdb_id, a.tmdb_id) AS tmdb_id, crew, "cast" FROM c FULL JOIN a ON c.tmdb_id = a.tmdb_id""")
def film_credits(spark, d):
    """Crew by role and the first of the cast; the first three of each film's cast stand for its crew."""
    own = synopsis.crew_by_role(_people(spark, d), "tmdb_id", {"Director": "director", "Screenplay": "writer", "Writer": "writer"}, 5)
    crew = F.array_join(F.transform(F.map_entries("crew"), lambda x: F.concat(x["key"], F.lit("="), F.array_join(x["value"], "|"))), ";")
    return own.select("tmdb_id", crew.alias("crew"), F.array_join("cast", "|").alias("cast"))


@query(f"""WITH {_PEOPLE}, k AS (SELECT DISTINCT lower(trim(regexp_replace(coalesce(name, ''), '\\s+', ' ', 'g'))) AS n FROM p WHERE job = 'cast') SELECT tmdb_id, name, job FROM p WHERE job <> 'cast' AND lower(trim(regexp_replace(coalesce(name, ''), '\\s+', ' ', 'g'))) NOT IN (SELECT n FROM k)""")
def crew_outside_casts(spark, d):
    """Crew that plays in no film."""
    p = _people(spark, d)
    return synopsis.credits_without_known(p.where(F.col("job") != "cast"), p.where(F.col("job") == "cast")).select("tmdb_id", "name", "job")


@query("""SELECT file_id, coalesce(arg_min(nullif(source_lang, 'auto'), (unit_id, requested_at, translation_id)), arg_min(detected_source_lang, (unit_id, requested_at, translation_id)), 'auto') AS language FROM translations GROUP BY file_id""")
def pinned_languages(spark, d):
    """Source language of each file's calls."""
    tr = t(spark, d, "translations")
    return translate.pinned_languages(tr, ["file_id"], F.col("source_lang"), F.col("detected_source_lang"), F.struct("unit_id", "requested_at", "translation_id"))


@query(r"""WITH t AS (SELECT file_id, unit_id, max_by(struct_pack(s := source_lang, t := target_lang, x := text), (requested_at, translation_id)) AS r FROM translations GROUP BY 1, 2), u AS (SELECT file_id, unit_id, max_by(struct_pack(text := text, spans := spans), chapter_id) AS u FROM units GROUP BY 1, 2),
j AS (SELECT file_id, unit_id, r.s AS sl, r.t AS tl, coalesce(r.x, '') AS x, r.x AS raw, u.text AS text, u.spans AS spans FROM t JOIN u USING (file_id, unit_id)), m AS (SELECT *, list_filter(spans, lambda s: s.boundary = 'marker') AS ms, list_distinct(list_transform(spans, lambda s: s.id)) AS ids FROM j),
e AS (SELECT file_id, unit_id, sl, tl, unnest(ms).marker_id AS cue, unnest(ms).text AS own, x FROM m WHERE len(ms) > 0),
c AS (SELECT file_id, unit_id, sl, tl, cue, own, CASE WHEN len(string_split(x, '⟦c' || cue || '⟧')) = 2 THEN trim(regexp_replace(string_split(x, '⟦c' || cue || '⟧')[2], '⟦c\d+(\.\d+)?⟧.*$', '', 's')) END AS got FROM e
UNION ALL SELECT file_id, unit_id, sl, tl, CAST(ids[1] AS VARCHAR), text, raw FROM m WHERE len(ms) = 0 AND len(ids) = 1),
n AS (SELECT file_id, unit_id, cue, sl, tl, regexp_replace(regexp_replace(coalesce(own, ''), '(?i)</?[ibu]>', '', 'g'), '[\s\p{P}\p{N}♩♪♫♬]', '', 'g') AS a, regexp_replace(regexp_replace(coalesce(got, ''), '(?i)</?[ibu]>', '', 'g'), '[\s\p{P}\p{N}♩♪♫♬]', '', 'g') AS b, len(regexp_extract_all(regexp_replace(coalesce(own, ''), '(?i)</?[ibu]>', '', 'g'), '[\p{L}\p{N}_]+')) AS w FROM c WHERE got IS NOT NULL)
SELECT file_id, unit_id, cue FROM n WHERE a <> '' AND a = b AND (w > 1 OR coalesce((sl IN ('zh', 'ja')) <> (tl IN ('zh', 'ja')) AND sl <> 'ru' AND tl <> 'ru', false))""")
def leaked_cues(spark, d):
    """Cues that came back as they were."""
    tr = latest(t(spark, d, "translations").select("file_id", "unit_id", "source_lang", "target_lang", F.col("text").alias("translation"), "requested_at", "translation_id"), ["file_id", "unit_id"], ["requested_at", "translation_id"])
    u = latest(t(spark, d, "units").select("file_id", "unit_id", "chapter_id", "text", "spans"), ["file_id", "unit_id"], ["chapter_id"])
    return translate.leaked_cues(u.join(tr, ["file_id", "unit_id"]), "file_id", F.col("source_lang"), F.col("target_lang"))

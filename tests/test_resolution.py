"""Worked cases, ranks, resolution of requests, search results and repeated answers."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from cuemill.operators import lookup
from cuemill.operators.ordered import ranks
from cuemill.plans import cases, resolution, synopsis
from cuemill.sources import connector


@pytest.mark.parametrize("name", sorted(cases.QUERIES))
def test_worked_cases(spark, name):
    got = {r["case_no"]: r["got"] for r in cases.QUERIES[name](spark, "").collect()}
    assert got == dict(duckdb.sql(cases.SQL[name]).fetchall())


def test_ranks_against_a_loop(spark):
    r = random.Random(2)
    rows = [("hot" if r.random() < 0.5 else r.choice("abc"), r.randrange(50), i) for i in range(600)] + [(None, 1, 900), (None, 0, 901)]
    df = spark.createDataFrame(rows, "k string, v int, i int")
    got = {x.i: x.place for x in ranks(df, ["k"], [-F.col("v"), F.col("i")]).collect()}
    for key in {k for k, *_ in rows}:
        own = sorted((-v, i) for k, v, i in rows if k == key)
        assert [got[i] for _, i in own] == list(range(1, len(own) + 1))
    assert ranks(df.limit(0), ["k"], [F.col("v")]).count() == 0


CATALOGUE = [("movie", 5, "tt0000005", "The Harbor", "港口", 1999), ("tv", 5, "tt0000006", "The Harbour", "海港", 2001), ("movie", 7, "tt0000007", "A Mill", None, 2004)]


def test_requests_find_their_film(spark):
    known = spark.createDataFrame(CATALOGUE, "media_type string, tmdb_id long, imdb_id string, title_en string, title_zh string, year int").withColumn("extra", F.lit(1))
    asked = [
        (1, "5", None, None), (2, "tt0000006", None, None), (3, "nothing", None, "The_Harbor_1999"), (4, "", "themoviedb.org/tv/5 imdb.com/title/tt0000007", None),
        (5, None, "imdb.com/title/tt0000007", "The_Harbor_1999"), (6, None, None, "The_Harbor_1999"), (7, None, None, "the-harbor-1999"), (8, None, None, None), (9, "999", None, None),
        (10, "tt9999999", None, None), (11, None, None, "The_Harbor_2000"), (12, None, None, "Something_Else_1950"), (13, None, None, "harbor"),
    ]
    df = spark.createDataFrame(asked, "id int, manual string, readme string, repo string")
    got = {r["id"]: r for r in resolution.entities(resolution.identities(df, "manual", "readme", "repo"), known, "id").collect()}
    found = {k: (v["media_type"], v["tmdb_id"]) for k, v in got.items() if v["success"]}
    assert found == {1: ("movie", 5), 2: ("tv", 5), 4: ("tv", 5), 5: ("movie", 7), 6: ("movie", 5)}
    assert {k: v["reason"] for k, v in got.items() if not v["success"]} == {3: "invalid_repo_name", 7: "title_mismatch", 8: "readme_not_found", 9: "network_error", 10: "not_found", 11: "year_mismatch", 12: "not_found", 13: "invalid_repo_name"}
    assert resolution.entities(resolution.identities(df.limit(0), "manual", "readme", "repo"), known.limit(0), "id").count() == 0


def test_best_titles_against_all_pairs(spark):
    from cuemill.functions import rules as R

    r = random.Random(4)
    word = lambda: "".join(r.choice("abcde") for _ in range(r.randint(1, 9)))
    wanted = [(i, " ".join(word() for _ in range(r.randint(1, 4))), r.randint(2000, 2003)) for i in range(60)] + [(90, None, 2000), (91, "x", None)]
    entries = [(i, " ".join(word() for _ in range(r.randint(1, 4))), r.randint(1999, 2004)) for i in range(80)] + [(200, wanted[0][1], wanted[0][2])]
    got = {x.k: (x.id, round(x.similarity, 6)) for x in lookup.best_titles(spark.createDataFrame(wanted, "k int, title string, year int"), spark.createDataFrame(entries, "id int, name string, released int"), "k").collect()}
    want = {}
    for k, title, year in wanted:
        if title is None or year is None:
            continue
        offers = [(-R.ratcliff(R.safe_title(title).lower(), R.safe_title(name).lower()), abs(released - year), i) for i, name, released in entries if abs(released - year) <= 1]
        offers = [o for o in offers if -o[0] >= 0.5]
        if offers:
            want[k] = (min(offers)[2], round(-min(offers)[0], 6))
    assert got == want


def _most_similar_of_all(wanted, entries):
    from cuemill.functions import rules as R

    plain = lambda x: R.safe_title(x).lower()
    want = {}
    for k, title, year in wanted:
        offers = [(-R.ratcliff(plain(title), plain(name)), abs(released - year), i) for i, name, released in entries if abs(released - year) <= 1]
        if offers and -min(offers)[0] >= 0.5:
            want[k] = (min(offers)[2], round(-min(offers)[0], 6))
    return want


def test_a_year_of_many_titles_is_cut_into_cells(spark, monkeypatch):
    """Cells of 3 wanted titles and 5 entries, with equal titles, ties of similarity and of year, and titles without a letter."""
    monkeypatch.setattr(lookup, "CELL", (3, 5))
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcd") for _ in range(r.randint(1, 5)))
    entries = [(i, " ".join(word() for _ in range(r.randint(1, 3))), r.choice([2000, 2000, 2000, 1999, 2001])) for i in range(120)] + [(200, "港口", 2000), (201, "ABC abd!", 2001), (202, "abc-abd", 1999)]
    wanted = [(i, r.choice(entries)[1].upper() if i % 3 else " ".join(word() for _ in range(2)), 2000) for i in range(60)] + [(90, "海港", 2001), (91, "abc abd", 2000), (92, "abc abdd", 2000), (93, "abc", 1950)]
    got = {x.k: (x.id, round(x.similarity, 6)) for x in lookup.best_titles(spark.createDataFrame(wanted, "k int, title string, year int"), spark.createDataFrame(entries, "id int, name string, released int"), "k").collect()}
    assert got == _most_similar_of_all(wanted, entries)
    assert got[90] == (200, 1.0) and got[91] == (201, 1.0) and 93 not in got


def test_names_of_a_full_year_find_their_film(spark, tmp_path):
    """Before, the names of a request met all films of their years in one join that scored every pair."""
    from cuemill.plans import queries_resolve

    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 6))).capitalize()
    titles = [f"{word()} {word()} {word()}" for _ in range(150)]
    names = [f"{(x if k % 3 else x[1:] + 'x').replace(' ', '_')}_1999" for k, x in enumerate(titles)]
    rows = [(k, f"tt{k:07}", names[k], "movie", titles[k], None, 1999, None) for k in range(150)]
    schema = "tmdb_id long, imdb_id string, repo_name string, media_type string, title_en string, title_zh string, year int, updated_at timestamp_ntz"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "titles.parquet"))
    found = queries_resolve.resolved_names(spark, str(tmp_path))
    got = {x.request: (x.success, x.reason, x.tmdb_id) for x in found.collect()}
    most = _most_similar_of_all([(k, names[k][:-5].replace("_", " "), 1999) for k in range(150)], [(k, titles[k], 1999) for k in range(150)])
    for k in range(150):
        same = k in most and titles[most[k][0]] == names[k][:-5].replace("_", " ")
        assert got[k] == (same, None if same else "title_mismatch" if k in most else "not_found", most[k][0] if same else None)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "title_similarity" not in plan and "search(" in plan


def test_few_titles_are_compared_letter_by_letter(monkeypatch):
    """Before, each wanted title was compared with every entry of its years."""
    from cuemill.functions import rules as R

    r = random.Random(6)
    words = [a + b + c for a in ("ha", "mo", "vel", "sto", "cris") for b in ("r", "n", "tt", "vi") for c in ("bor", "lis", "ta", "en")]
    title = lambda n: " ".join(r.choice(words) for _ in range(n))
    texts = [title(r.choice([1, 3, 3, 4, 4, 12, 40])) for _ in range(400)] + ["", "a", "a" * 300, "ab" * 130]
    offers, asked = R.Offers(texts), [*[x.replace("b", "d", 1)[1:] for x in texts[:60]], title(4), title(45), "", "zzzz", "a" * 290]
    judged, compare = [], R.Offers.similarity
    monkeypatch.setattr(R.Offers, "similarity", lambda self, text, k: judged.append(k) or compare(self, text, k))
    for text in asked:
        all_ = [R.ratcliff(text, x) for x in texts]
        top = max(0.5, *all_)
        similarity, places = offers.best(text, 0.5)
        assert (similarity, sorted(places)) == (top, [k for k, x in enumerate(all_) if x == top])
    assert len(judged) < 0.1 * len(asked) * len(texts)


def test_second_provider_only_where_the_first_gives_nothing(spark):
    c = "k string, id string, title string, score double, pos long"
    first = spark.createDataFrame([("a", "1", "红石", 0.9, 1), ("b", "2", "别的", 0.1, 1), ("d", "4", "红石 一", 0.1, 1), ("d", "5", "红石 二", 0.2, 2)], c)
    second = spark.createDataFrame([("a", "9", "x", 0.99, 1), ("b", "3", "白石 - 电影 - 豆瓣", None, 1)], c)
    hints = spark.createDataFrame([("a", []), ("b", ["白石"]), ("c", ["黑石"]), ("d", ["红石 三"]), ("e", None)], "k string, hints array<string>")
    errors = spark.createDataFrame([("c", "rate_limit"), ("c", "server_error"), ("a", "auth_error")], "k string, type string")
    got = {x.k: (x.success, x.id, x.reason, x.ids) for x in lookup.with_fallback(hints.select("k"), first, second, hints, errors, "k").collect()}
    assert got == {"a": (True, "1", None, []), "b": (True, "3", None, []), "c": (False, None, "multiple_errors", []), "d": (False, None, "low_confidence", ["5", "4"]), "e": (False, None, "not_found", [])}


def test_answers_are_asked_for_again(spark):
    table = "| a |\n|---|\n| b |"
    good = "\n\n".join(f"## {n}\n\n{table}\n\n{table}" for n in synopsis.REQUIRED)
    facts = spark.createDataFrame([("ok", {"en": "x"}), ("drops", {"en": "x", "es": "y"}), ("never", {"fr": "x"}), ("fails", {"ru": "x"})], "id string, plots map<string,string>").withColumn("who", F.col("id"))
    rule = lambda q: None if '"fails"' in q else good if '"ok"' in q or '"drops"' in q and '"es"' not in q else "## no"
    got = {x.id: (x.retries, x.success, x.reason) for x in synopsis.answered(facts, "id", "plots", ["who"], connector.Stub(rule=rule, reason="rate_limit")).collect()}
    assert got == {"ok": (0, True, None), "drops": (2, True, None), "never": (3, False, "malformed_llm_output"), "fails": (0, False, "rate_limit")}


def test_command_line(spark, tmp_path):
    from cuemill.__main__ import main

    folder = tmp_path / "repo" / "subtitles" / "web" / "work" / "source"
    folder.mkdir(parents=True)
    (folder / "en.srt").write_text("1\n00:00:01,000 --> 00:00:02,000\nWe leave\n\n2\n00:00:02,100 --> 00:00:03,000\ntonight.\n")
    main(["units", str(tmp_path / "repo"), str(tmp_path / "units")])
    assert [(x.unit_id, x.text, len(x.spans)) for x in spark.read.parquet(str(tmp_path / "units")).collect()] == [(1, "We leave tonight.", 2)]
    with pytest.raises(SystemExit):
        main(["query", "none", str(tmp_path), str(tmp_path / "out")])

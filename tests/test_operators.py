"""Ordered operators, lookups, alignment and sources against loops and by properties."""

import random

import pytest
from pyspark.sql import functions as F

from cuemill.functions import rules as R
from cuemill.operators import align, lookup, ordered
from cuemill.operators import sequence as S
from cuemill.plans import subtitles, synopsis, translate
from cuemill.sources import connector, html, markdown, srt


#: (end of the segment, begin of the next, longest pause in ms for which it goes on), by hand; the first that fits counts, a pause of -1 never fits.
LATIN_CASES = [
    ("terminal", "any", -1),
    ("dash", "lower", 200),
    ("dash", "any", -1),
    ("ellipsis", "ellipsis", 1500),
    ("ellipsis", "upper", -1),
    ("ellipsis", "lower", 10**9),
    ("ellipsis", "any", 200),
    ("any", "lower", 10**9),
    ("continuing", "any", 1500),
    ("any", "any", 200),
]


def latin_case(tail, head, gap):
    longest = next(most for end, begin, most in LATIN_CASES if (end == "any" or tail[end]) and (begin == "any" or head[begin]))
    return gap <= longest


def test_previous_and_running_sum_cross_chunks(spark):
    rows = [(k, o, o * 3 % 7) for k in "ab" for o in random.Random(1).sample(range(200), 60)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    got = {(r.k, r.o): (r.p and r.p.v, r.s) for r in ordered.with_running_sum(ordered.with_previous(df, ["k"], "o", ["v"], "p", 16), ["k"], "o", F.col("v"), "s", 16).collect()}
    for k in "ab":
        before, total = None, 0
        for _, o, v in sorted(r for r in rows if r[0] == k):
            total += v
            assert got[k, o] == (before, total)
            before = v


def test_chapters_against_a_loop(spark):
    r = random.Random(2)
    rows, t = [], 0
    for pos in range(300):
        t += r.choice([500, 20_000, 30_000, 31_000, 60_000])
        rows.append(("f", pos, r.choice(["music", "dialogue"]), t, t + r.choice([100, 5000])))
    df = spark.createDataFrame(rows, "f string, pos int, kind string, s int, e int")
    got = {x.pos: x.chapter_id for x in S.chapters(df, ["f"], "kind", "pos", "s", "e").collect()}
    last, current, count = {}, {}, 0
    for _, pos, kind, s, e in rows:
        if kind not in last or s - last[kind] > 30_000:
            count += 1
            current[kind] = count
        last[kind] = e
        assert got[pos] == current[kind]


def loop_groups(segments):
    """The merging of segments as a plain loop."""
    groups, current, pending, quoted = [], [], False, 0
    for s in segments:
        if s["resolved"] is not None:
            groups += [current] if current else []
            groups.append([s])
            current, pending, quoted = [], False, 0
            continue
        merged = False
        if current:
            p, full = current[-1], len(current) >= 16
            gap = s["start_ms"] - p["end_ms"]
            merged = pending and not full and gap <= 1500
            reason = None
            if p["music"] == s["music"]:
                if p["cue_id"] == s["cue_id"]:
                    reason = "dash" if sum(c.isalnum() for c in s["text"]) <= 3 else None
                elif s["music"]:
                    reason = "music" if R.music_goes_on(s["text"]) else None
                elif gap >= -1000:
                    tail, head = R.tail_of(p["text"]), R.head_of(s["text"])
                    if head["closer"] or tail["opener"]:
                        reason = "gap" if gap <= 1500 else None
                    else:
                        reason = "gap" if latin_case(tail, head, gap) else None
            merged = merged or bool(reason and not (full and reason in ("gap", "music")))
        if merged:
            current.append(s)
        else:
            groups += [current] if current else []
            current, pending, quoted = [s], False, 0
        pending = R.quote_pending(s["text"], pending)
        quoted = quoted + 1 if pending else 0
        if quoted >= 10:
            pending = False
    return groups + ([current] if current else [])


def test_groups_against_a_loop(spark):
    r = random.Random(3)
    texts = ["We should go", "before dark.", "and then,", "He said \"wait", "no\" now", "♪ la la", "♪ and so", "Ok", "Why...", "...because", "No.", "(open", "end)"]
    rows, t = [], 0
    for cue in range(1, 260):
        t += r.choice([0, 100, 199, 201, 1400, 1600, 5000, -1200])
        text = r.choice(texts)
        rows.append(dict(file="f", seq=cue * 64, cue_id=cue, text=text, start_ms=t, end_ms=t + 900, resolved="x" if r.random() < 0.03 else None, music="♪" in text))
        t += 900
    df = spark.createDataFrame(rows, "file string, seq long, cue_id int, text string, start_ms long, end_ms long, resolved string, music boolean")
    got = {x.seq: x.group_no for x in S.grouped_segments(df, ["file"], "seq", F.lit("en")).collect()}
    expected = {}
    for n, group in enumerate(loop_groups(rows), 1):
        for s in group:
            expected[s["seq"]] = n
    assert got == expected


def test_next_fit_and_chapter_batches(spark):
    r = random.Random(4)
    rows = [(f, c, u, r.choice([10, 300, 900, 1200])) for f in "ab" for c in range(1, 6) for u in range(c * 10, c * 10 + 6)]
    df = spark.createDataFrame(rows, "f string, chapter int, u int, n int")
    packed = S.pack_next_fit(df, ["f"], "u", "n", 2000, 4).collect()
    for f in "ab":
        batch, used, count = 1, 0, 0
        for x in sorted((p for p in packed if p.f == f), key=lambda p: p.u):
            if count and (used + x.n > 2000 or count >= 4):
                batch, used, count = batch + 1, 0, 0
            used, count = used + x.n, count + 1
            assert x.batch_no == batch
    out = S.chapter_batches(df, "f", "chapter", "u", "n", 1000).collect()
    assert len(out) == len(rows) and all(x.oversized == (x.n > 1000) for x in out)
    load = {}
    for x in out:
        if not x.oversized:
            load[x.f, x.batch_no] = load.get((x.f, x.batch_no), 0) + x.n
    assert max(load.values()) <= 1000


def test_empty_tables(spark):
    df = spark.createDataFrame([], "f string, chapter int, u int, n int")
    assert S.pack_next_fit(df, ["f"], "u", "n", 10).count() == 0
    assert S.chapter_batches(df, "f", "chapter", "u", "n", 10).count() == 0
    cues = spark.createDataFrame([], "f string, cue_id int, text string, start_time string, end_time string, start_ms long, end_ms long")
    assert subtitles.units(cues, "f", F.lit("en")).count() == 0


def test_candidates_and_titles(spark):
    c = spark.createDataFrame([(1, "a", 0.3, 1), (1, "b", 0.5, 2), (2, "c", None, 1), (2, "c", None, 2), (3, "d", None, 1), (3, "e", None, 2)], "k int, id string, score double, pos int")
    assert {(r.k, r.id, r.status) for r in lookup.candidate_status(c, "k").collect()} == {(1, "b", "success"), (2, "c", "success"), (3, "d", "low_confidence")}
    g = lambda a, b: spark.range(1).select(lookup.group_match(F.lit(a), F.lit(b)).alias("x")).first().x
    assert g("Star Wars 2", "star wars2") == "exact" and g("Star Wars One", "star wars two") == "partial" and g("A", "B") == "none"
    w = spark.createDataFrame([(1, "Cosmos Laundromat", 2015)], "k int, title string, year int")
    cat = spark.createDataFrame([("x", "Cosmic Laundromat", 2016), ("y", "Cosmos Laundromat", 2018), ("z", "Other", 2015)], "id string, name string, released int")
    best = lookup.best_titles(w, cat, "k").first()
    assert best.id == "x" and 0.88 < best.similarity < 0.89


def test_glossary_and_manifest(spark):
    text = "# T\n\n## 人物与专有名词\n\n| 原文 | 译名 |\n|---|---|\n| Tom Ford | 汤姆·福特 |\n| Ann | 安 |\n\n## Next\n| x | y |\n"
    rows = markdown.glossary(spark.createDataFrame([("f", text)], "k string, t string"), "k", "t")
    assert [(r.source, r.target) for r in rows.orderBy("ord").collect()] == [("Tom Ford", "汤姆·福特"), ("Ann", "安")]
    pairs = {(r.term, r.target) for r in lookup.glossary_from_pairs(rows).collect()}
    assert pairs == {("Tom Ford", "汤姆·福特"), ("Tom", "汤姆"), ("Ann", "安")}
    m = "intro\n\n| a | b | c | d |\n|---|---|---|---|\n| copy | s | d | msg |\n| touch | | e | m2 |\n\n| no | no | no | no |\n"
    got = markdown.manifest(spark.createDataFrame([("f", m)], "k string, t string"), "k", "t").orderBy("ord").collect()
    assert [(r.action, r.destination) for r in got] == [("copy", "d"), ("touch", "e")]


SAMPLE = """1
00:00:01,000 --> 00:00:02,000
[DOOR OPENS]

2
00:00:02,100 --> 00:00:03,000
JOHN: W-we should go

3
00:00:03,100 --> 00:00:04,000
before dark.

4
00:00:40,000 --> 00:00:42,000
<i>♪ la la la ♪</i>

5
00:01:30,000 --> 00:01:32,000
- Ready?
- Yes.
"""


def test_sample_file(spark):
    cues = srt.cues(spark.createDataFrame([("f", SAMPLE.replace("\n", "\r\n"))], "k string, t string"), "k", "t", sdh=True)
    rows = cues.orderBy("cue_id").collect()
    assert [r.cue_id for r in rows] == [1, 2, 3, 4] and rows[0].dropped == 1 and rows[0].stripped == 1
    assert rows[0].text == "W-we should go"
    units = subtitles.units(cues.drop("dropped", "stripped", "lines"), "k", F.lit("en")).orderBy("unit_id").collect()
    assert [(u.chapter_id, u.kind, len(u.spans)) for u in units] == [(1, "dialogue", 2), (2, "music", 1), (3, "dialogue", 2)]
    assert units[0].text == "we should go before dark." and "⟦c4⟧" in units[2].text


def test_round_trip_and_bytes(spark):
    rows = [("f", i, f"00:00:{i:02d},000", f"00:00:{i:02d},900", f"line {i}", None) for i in range(1, 30)]
    df = spark.createDataFrame(rows, "k string, cue_id int, start_time string, end_time string, text string, translation string")
    back = srt.cues(srt.render(df, "k"), "k", "content").orderBy("cue_id").collect()
    assert [(r.cue_id, r.start_time, r.end_time, r.text) for r in back] == [r[1:5] for r in rows]
    for name, mark in (("utf-8", True), ("utf-16-le", True), ("utf-8", False)):
        raw = srt.encode("é\nb", name, mark, "crlf")
        text, _, bom = srt.decode(raw)
        assert text == "é\r\nb" and bom == mark
    assert srt.encode("你", "cp1252", False, "lf") == "你".encode()
    assert srt.decode(b"caf\xe9")[1] == "cp1252"


def test_split_gives_a_part_per_span():
    r = random.Random(5)
    words = ["我们", "今晚", "离开", "，", "港口", "。", "(注)", "1,000枚", "Tom", "！", " "]
    for _ in range(300):
        spans = [align.Span(" ".join(r.choice(["we", "go", "now,", "to", "the harbor."]) for _ in range(r.randint(1, 8))), str(k)) for k in range(r.randint(1, 5))]
        text = "".join(r.choice(words) for _ in range(r.randint(1, 40)))
        parts, _ = align.split_translation(text, spans, "zh")
        assert len(parts) == len(spans)
        assert "".join("".join(parts).split()) == "".join(text.split())


def test_split_takes_markers_and_punctuation():
    spans = [align.Span("We leave tonight,", "1"), align.Span("from the harbor.", "2")]
    assert align.split_translation("⟦c1⟧ 我们今晚走 ⟦c2⟧ 从港口", spans, "zh") == (["我们今晚走", "从港口"], "marker_boundary")
    assert align.split_translation("我们今晚走，从港口出发。", spans, "zh")[0] == ["我们今晚走，", "从港口出发。"]
    assert align.split_translation("", spans, "zh")[0] == ["", ""]


def test_wrap():
    text = "This is a caption that is clearly too long for a single line of text"
    out = align.wrap_lines(text, "en")
    assert out.count("\n") == 1 and out.replace("\n", " ") == text and max(map(len, out.split("\n"))) <= 42
    assert align.wrap_lines("short", "en") == "short"
    assert align.wrap_lines("<i>" + text + "</i>", "en").replace("\n", " ") == "<i>" + text + "</i>"


def test_pages(spark):
    page = """<section data-mw-section-id="0"><p>Lead<sup>[1]</sup> text.</p></section>
    <section><h2>Plot summary</h2><p>One.</p><p>Two<br>lines.</p></section>
    <section><h2>Cast</h2><ul><li>Ann Lee as Mia</li><li>Bo</li></ul></section>
    <section><h2>Reception</h2><section><h3>Box office</h3><p>Money.</p></section><section><h3>Critical response</h3><p>Good.</p></section></section>
    <table class="infobox x"><tr><th>Directed by</th><td>Cy</td></tr><tr><th>Starring</th><td><ul><li>A</li><li>B</li></ul></td></tr></table>"""
    row = html.pages(spark.createDataFrame([("p", page, "en"), ("q", None, "en")], "k string, h string, lang string"), "k", "h", "lang").orderBy("k").collect()
    assert (row[0].lead, row[0].plot, row[0].reception) == ("Lead text.", "One. Two lines.", "Good.")
    assert [tuple(c) for c in row[0].cast] == [("Ann Lee", "Mia"), (None, "Bo")]
    assert [(i.field, i.values, i.is_list) for i in row[0].infobox] == [("director", ["Cy"], False), ("starring", ["A", "B"], True)]
    assert row[1].plot is None


def test_connector_sends_equal_requests_once(spark, tmp_path):
    def reply(x):
        with open(tmp_path / "log", "a") as f:
            f.write(x + "\n")
        return x.upper()

    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "r string")
    out = connector.call(df, "r", connector.Stub(rule=reply)).collect()
    assert sorted((x.r or "", x.body) for x in out) == [("", None), ("a", "A"), ("a", "A"), ("b", "B")]
    assert sorted(open(tmp_path / "log").read().split()) == ["a", "b"]
    assert connector.halving(lambda items: None if len(items) > 2 else [i * 2 for i in items], [1, 2, 3, 4, 5]) == [2, 4, 6, 8, 10]
    assert connector.event_text(['data: {"choices":[{"delta":{"content":"a"}}]}', "", 'data: {"choices":[{"delta":{"content":"b"},"finish_reason":"length"}]}', "data: [DONE]"]) == ("ab", True)


def test_translation_recovers_lost_units(spark):
    def lossy(request):
        import re

        out = []
        for head, body in re.findall(r"(⟦[a-z]\d+⟧)([^⟦]*)", request):
            out.append("" if head in ("⟦t2⟧", "⟦t5⟧") else f"{head} {body[::-1].strip()}")
        return " ".join(out)

    rows = [("f", i, 1, f"unit number {i} here", None, []) for i in range(1, 8)] + [("f", 8, 1, "", "♪", [])]
    u = spark.createDataFrame(rows, "k string, unit_id int, chapter_id int, text string, resolved string, spans array<struct<boundary:string,marker_id:string>>")
    out = {r.unit_id: (r.translation, r.problem) for r in translate.translate(u, "k", F.lit("en"), F.lit("eo"), translate.Provider(connector.Stub(rule=lossy))).collect()}
    assert all(out[i] == (f"unit number {i} here"[::-1], None) for i in range(1, 8)) and out[8][0] == "♪"


def test_budget_and_sections(spark):
    plots = {"en": "a" * 8000, "es": "b" * 8000, "de": "c" * 8000, "fr": "d" * 4000}
    df = spark.createDataFrame([(plots,)], "p map<string,string>")
    kept = df.select(synopsis.within_budget(F.col("p"), F.lit(5000.0), F.lit("es")).alias("k")).first().k
    assert set(kept) == {"en", "es", "fr"}
    text = "intro\n## 简介\nA\n\n## 剧情\nold\n## 剧情\nnew\n"
    row = spark.createDataFrame([(text,)], "t string").select(synopsis.sections_of(F.col("t")).alias("s")).select("s", synopsis.required(F.col("s"))["missing"].alias("m")).first()
    assert row.s == {"简介": "A", "剧情": "new"} and row.m == "人物与译名对照"


def test_decoys_in_keys_and_nulls(spark):
    df = spark.createDataFrame([("a", 1, None, None, None), (None, 2, "x", 5, 9)], "f string, pos int, kind string, s int, e int")
    assert S.chapters(df, ["f"], "kind", "pos", "s", "e").count() in (0, 1, 2)


def test_stream_adds_each_file_once(spark, tmp_path):
    from cuemill.streaming import incremental

    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.srt").write_text(SAMPLE)
    plan = lambda batch: srt.cues(batch, "path", "text").groupBy("path").agg(F.count("*").alias("n"))
    for _ in range(2):
        incremental.process_new(incremental.file_stream(spark, str(folder)), plan, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        (folder / "b.srt").write_text(SAMPLE)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


@pytest.mark.parametrize("name", ["boundary_classes", "chapters", "request_batches", "srt_round_trip"])
def test_queries_run(spark, name):
    import os

    from cuemill.plans import registry

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test data")
    assert registry.queries()[name](spark, d).count() > 0


def test_isolated_cues_are_patched_in(spark):
    spans = [("marker", "1", "Go home now"), ("marker", "2", "Not today my friend")]
    u = spark.createDataFrame([("f", 1, "⟦c1⟧ won emoh oG", spans)], "k string, unit_id int, translation string, spans array<struct<boundary:string,marker_id:string,text:string>>")
    reply = lambda x: "".join(p if p.startswith("⟦") else f" {p.strip()[::-1]} " for p in __import__("re").split(r"(⟦[^⟧]*⟧)", x))
    found = translate.isolated_cues(u, "k", translate.Provider(connector.Stub(rule=reply)), F.lit("en"), F.lit("eo"))
    assert [(r.marker_id, r.new) for r in found.collect()] == [("2", "dneirf ym yadot toN")]
    assert translate.patched(u, found, "k").first().translation == "⟦c1⟧ won emoh oG ⟦c2⟧ dneirf ym yadot toN"


def test_small_text_helpers(spark):
    from cuemill.functions import columns as C

    assert R.protected("a <i>b</i> & c", [(0, 1), (1, 2)]) == '<span translate="no">a </span><i>b</i> &amp; c'
    assert R.pretty_html("<div><p>x</p></div>") == "<div>\n  <p>\n    x\n  </p>\n</div>"
    row = spark.range(1).select(C.nearest(F.array(F.lit(3), F.lit(7)), F.lit(5)).alias("n"), C.replace_section(F.lit("a<s>x<e>b"), "<s>", "<e>", F.lit("y")).alias("r")).first()
    assert row.n == 3 and tuple(row.r) == ("a<s>y<e>b", True)

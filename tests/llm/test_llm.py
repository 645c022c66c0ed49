"""Training-data operators against brute force, round trips and held-out labels, with nulls, empties, repeats and clashing columns."""

import itertools
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cuemill.llm import alignment, encoding, language, leakage, matching, packing, residue, turns

PROSE = {
    "en": ["The council of {} closes the bridge for {} weeks.", "Nobody in {} believes the story about the cellar.", "She hides the letters before the trial of {} begins.", "Where did you leave the garden, {}?"],
    "fr": ["Le conseil de {} ferme le pont pendant {} semaines.", "Personne à {} ne croit l'histoire de la cave.", "Elle cache les lettres avant le procès de {}.", "Où as-tu laissé le jardin, {} ?"],
    "de": ["Der Rat von {} schließt die Brücke für {} Wochen.", "Niemand in {} glaubt die Geschichte über den Keller.", "Sie versteckt die Briefe vor dem Prozess von {}.", "Wo hast du den Garten gelassen, {}?"],
    "es": ["El concejo de {} cierra el puente durante {} semanas.", "Nadie en {} cree la historia del sótano.", "Ella esconde las cartas antes del juicio de {}.", "¿Dónde dejaste el jardín, {}?"],
    "pt": ["O conselho de {} fecha a ponte durante {} semanas.", "Ninguém em {} acredita na história do porão.", "Ela esconde as cartas antes do julgamento de {}.", "Onde deixaste o jardim, {}?"],
    "ru": ["Совет города {} закрывает мост на {} недель.", "Никто в городе {} не верит рассказам про подвал.", "Она прячет письма перед судом города {}.", "Где ты оставил сад, {}?"],
    "zh": ["{}的议会把桥关闭了{}个星期。", "{}没有人相信关于地窖的故事。", "审判开始之前，{}把信件藏进了花园。", "{}，你把花园丢在哪儿了？"],
    "ja": ["{}の議会は橋を{}週間閉鎖する。", "{}では誰も地下室の話を信じない。", "{}は裁判が始まる前に手紙を隠す。", "{}、庭をどこに置いてきたの？"],
}
NAMES = ["Lodulu", "Salutati", "Komane", "Visa", "Rerebo", "Nedari", "Tilame", "Mosako"]


def sentence(lang, r):
    return r.choice(PROSE[lang]).replace("{}", r.choice(NAMES), 1).replace("{}", str(r.randint(2, 90)))


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(11)
    return [(i, lang, " ".join(sentence(lang, r) for _ in range(r.randint(2, 5)))) for i, lang in enumerate(r.choice(sorted(PROSE)) for _ in range(600))]


# ---- residue ----
def test_residue(spark, corpus):
    r = random.Random(1)
    bad = ["Lorem ipsum dolor sit amet sed do eiusmod tempor incididunt ut labore.", "Please enable JavaScript and cookies to view this page.", "{{ film_name }}", "The page you requested could not be found.", "这里是占位文本，请替换为正式简介。", "[TODO: add director]"]
    good = ["She learns JavaScript in prison and sells the code to Komane.", "[DOOR OPENS] He steps in with 100% of the money.", "{\\an8}Visa lost $5 at the fair."]
    rows = [(i, t) for i, _, t in corpus] + [(1000 + k, sentence("en", r) + "\n\n" + b) for k, b in enumerate(bad)] + [(2000 + k, sentence("en", r) + "\n\n" + g) for k, g in enumerate(good)] + [(3000, None), (3001, ""), (3002, "x"), (3003, "word " * 40_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kind", F.lit("clash")).withColumn("k", F.lit(1)).withColumn("t", F.lit("clash"))
    found = {x.doc_id for x in residue.residue_spans(df).select("doc_id").collect()}
    assert found == {1000 + k for k in range(len(bad))}
    assert residue.residue_documents(df.limit(0)).count() == 0


def test_short_notices_between_prose_are_looked_at():
    notice = "请启用脚本。"
    text = "她在审判之前把信件藏进了花园里面。" * 3 + notice + "她在审判之前把信件藏进了花园里面。" * 3

    class Model:
        def ratios(self, codes):
            out = np.full((len(codes), 3), -2.0)
            at = 3 + text.index(notice)
            out[at : at + len(notice)] = 1.2
            return out, out > 0

    assert {text[b:e] for b, e, _ in residue.find_spans([text], Model())[0]} == {notice}


def test_small_samples_have_the_prose_seeds():
    model = residue.fit_counts({residue.PROSE: ["We go home."] * 20, **residue.seeds()}, 17)
    seed = residue.hashes(residue.code_points(residue.PROSE_SEEDS[0]), 17)[3]
    assert (model.counts[4][seed, residue.PROSE] > 0).all()


def test_the_model_of_residue_counts_every_document(spark, corpus):
    texts = [t for _, _, t in corpus]
    whole, parts = residue.counted(texts, 14), [residue.counted(x, 14) for x in (texts[:7], texts[7:300], texts[300:])]
    assert all((whole[k] == sum(x[k] for x in parts)).all() for k in (0, 1)) and whole[0][0].sum() == sum(len(t) + 1 for t in texts)
    # more documents than any sample held, and one longer than what was read of it
    rows = [(i, f"We go home {i}.") for i in range(4000)] + [(4000, "We stay here. " * 2000 + "~")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = residue.fit(df, rounds=0)
    local = residue.fit_counts({residue.PROSE: [t for _, t in rows], **residue.seeds()}, 18)
    assert all((model.counts[k] == local.counts[k]).all() for k in residue.ORDERS)
    found = next(residue.tallied(iter([pd.DataFrame(rows, columns=["doc_id", "t"])]), None, 18))
    assert found.loc[(found["kind"] == residue.PROSE) & (found["level"] == 0), "n"].sum() == sum(len(t) + 1 for _, t in rows)


# ---- language ----
def test_gradient_agrees_with_differences():
    net = language.Network.fresh(5, 3, 0)
    r = np.random.default_rng(1)
    x, y = r.integers(0, 256, (7, 4)), r.integers(-1, 3, (7, 4))
    _, grad = net.gradient(x, y)
    for name, at in (("W", (2, 1)), ("Uf", (1, 7)), ("Ub", (3, 12)), ("cf", (4,)), ("d", (0,)), ("Ef", (int(x[2, 1]), 3))):
        old, losses = net.w[name][at], []
        for step in (1e-2, -1e-2):
            net.w[name][at] = old + step
            losses.append(net.gradient(x, y)[0])
        net.w[name][at] = old
        assert abs((losses[0] - losses[1]) / 2e-2 - grad[name][at]) < 2e-3


def _one_direction(net, side, x):
    """States and what the gradient needs, a direction by itself and a step at a time."""
    h, state, kept = net.hidden, np.zeros((x.shape[1], net.hidden), np.float32), []
    for row in x:
        a, g = net.w[f"E{side}"][row], state @ net.w[f"U{side}"] + net.w[f"c{side}"]
        gates = (np.tanh((a[:, : 2 * h] + g[:, : 2 * h]) * np.float32(0.5)) + np.float32(1)) * np.float32(0.5)
        z, r = gates[:, :h], gates[:, h:]
        new = np.tanh(a[:, 2 * h :] + r * g[:, 2 * h :])
        kept.append((state, z, r, new, g[:, 2 * h :]))
        state = new + z * (state - new)
    return np.stack([*[k[0] for k in kept[1:]], state]), kept


def _plain_gradient(net, x, label, weights):
    h = net.hidden
    (forward, kept_f), (backward, kept_b) = _one_direction(net, "f", x), _one_direction(net, "b", x[::-1])
    both = np.concatenate([forward, backward[::-1]], -1)
    y = both @ net.w["W"] + net.w["d"]
    p = np.exp(y - y.max(-1, keepdims=True))
    p /= p.sum(-1, keepdims=True)
    own = np.where(label >= 0, label, 0)
    valid = (label >= 0) * weights[own].astype(np.float32)
    np.put_along_axis(p, own[..., None], np.take_along_axis(p, own[..., None], -1) - 1, -1)
    dy = p * (valid[..., None] / max(1e-6, float(valid.sum()))).astype(np.float32)
    grad, dboth = {"W": np.einsum("tbi,tbj->ij", both, dy, optimize=True), "d": dy.sum((0, 1))}, dy @ net.w["W"].T
    for side, kept, ds, xs in (("f", kept_f, dboth[..., :h], x), ("b", kept_b, dboth[::-1, :, h:], x[::-1])):
        u = net.w[f"U{side}"]
        ge, gu, gc, carry = np.zeros_like(net.w[f"E{side}"]), np.zeros_like(u), np.zeros(3 * h, np.float32), np.zeros_like(kept[0][0])
        for t in range(len(xs) - 1, -1, -1):
            state, z, r, new, gn = kept[t]
            d = ds[t] + carry
            dnew = d * (1 - z) * (1 - new * new)
            dz, dr = d * (state - new) * z * (1 - z), dnew * gn * r * (1 - r)
            dg = np.concatenate([dz, dr, dnew * r], 1)
            np.add.at(ge, xs[t], np.concatenate([dz, dr, dnew], 1))
            gu += state.T @ dg
            gc += dg.sum(0)
            carry = d * z + dg @ u.T
        grad |= {f"E{side}": ge, f"U{side}": gu, f"c{side}": gc}
    return grad


def test_both_directions_at_once_give_the_gradient_of_each_for_less_work():
    net, r = language.Network.fresh(32, 8, 4), np.random.default_rng(4)
    x, y = np.minimum(256, r.gamma(2, 40, (112, 64)).astype(np.int64)), r.integers(-1, 8, (112, 64))
    weights = np.linspace(0.25, 4, 8)
    states = net.states(x)[0]
    assert np.array_equal(states[:, 0], _one_direction(net, "f", x)[0]) and np.array_equal(states[:, 1], _one_direction(net, "b", x[::-1])[0])
    want, got = _plain_gradient(net, x, y, weights), net.gradient(x, y, weights)[1]
    assert want.keys() == got.keys() and all(np.allclose(got[k], want[k], rtol=1e-5, atol=1e-8) for k in want)

    def seconds(f):
        began = time.process_time()
        f(x, y, weights)
        return time.process_time() - began

    # the plain form is what training took before
    plain, own = (min(seconds(f) for _ in range(9)) for f in (lambda *a: _plain_gradient(net, *a), net.gradient))
    assert own < 0.95 * plain


def test_language_on_held_out_lines(spark, corpus):
    r = random.Random(2)
    lines = [[sentence(lang, r) for _ in range(120)] for lang in language.LANGS]
    net = language.train(lines, hidden=16, steps=220, rows=32, length=80)
    held = [(i, lang, "\n".join(sentence(lang, r) for _ in range(5))) for i, lang in enumerate(r.choice(language.LANGS) for _ in range(120))]
    mixed = (900, "en", "\n".join([sentence("en", r), sentence("zh", r), "12:30", sentence("en", r) + " " + sentence("ru", r), sentence("en", r)]))
    rows = [(i, t, lang) for i, lang, t in [*held, mixed]] + [(901, None, "en"), (902, "", "en"), (903, "12 34", None), (904, "\n".join([sentence("fr", r)] * 400), "eng")]
    df = spark.createDataFrame(rows, "doc_id long, text string, detectedlanguage string").withColumn("lang_code", F.lit("clash"))
    out = language.detect(df, net).collect()
    main = {x.doc_id: x.lang_code for x in out if x.seg_no == 0}
    assert sum(main[i] == lang for i, lang, _ in held) >= 0.97 * len(held)
    assert main[900] == "en" and {(x.seg_no, x.lang_code) for x in out if x.doc_id == 900 and x.seg_no} == {(2, "zh"), (4, "ru")}
    assert not {901, 902, 903} & set(main) and main[904] == "fr"
    wrong = {x.doc_id for x in language.corrections(df, net).where("seg_no = 0").collect()}
    assert 904 in wrong and 900 not in wrong
    assert language.detect(df.limit(0), net).count() == 0


def test_every_line_trains_the_network(spark):
    lines = [["We go home.", "x" * 5000], ["Nous partons."] * 40]
    batches, size = language.every_byte(lines, np.random.default_rng(5), 8, 16)
    assert size == sum(int((x != 256).sum()) for x, _, _ in batches) >= 5000 + 40 * 12
    net = language.Network.fresh(4, 8, 0)
    # a thousand documents of a language, of which a sample holds 250; what is said far behind in a text of 8,000 characters
    rows = [(i, f"We go home {i}.", "en", "en") for i in range(1000)]
    schema = "doc_id long, text string, lang string, detectedlanguage string"
    one = language.train_on_all(spark.createDataFrame(rows, schema), None, net)
    two = language.train_on_all(spark.createDataFrame(rows[:-1] + [(999, "We stay. " * 900 + "\u0451" * 40, "en", "eng")], schema), None, net)
    assert (one.w["Ef"][0xD1] == net.w["Ef"][0xD1]).all() and (two.w["Ef"][0xD1] != net.w["Ef"][0xD1]).any()
    many = language.train_on_all(spark.createDataFrame(rows, schema), None, net, shard_bytes=150)
    assert np.isfinite(many.w["W"]).all() and (many.w["W"] != net.w["W"]).any()


def test_long_lines_are_labelled_whole():
    net = language.Network.fresh(4, 8, 0)
    raw = [b"a" * n for n in (0, 1, 223, 224, 225, 1000)]
    assert [len(y) for y in language.position_scores(net, raw)] == [len(x) for x in raw]


# ---- leakage ----
def test_index_against_brute_force():
    r = np.random.default_rng(3)
    for n, sigma in ((1, 2), (50, 3), (400, 5), (300, 60)):
        s = np.concatenate([r.integers(1, sigma, n), [0]])
        index = leakage.FMIndex(s, sigma, rate=7)
        phrases = np.array([[r.integers(1, sigma) if k >= skip else -1 for k in range(3)] for skip in (0, 1, 2) for _ in range(15)])
        begin, end = index.search(phrases)
        for p, b, e in zip(phrases, begin, end):
            own = [x for x in p if x >= 0]
            want = [i for i in range(n) if list(s[i : i + len(own)]) == own]
            assert sorted(index.locate(np.arange(b, e)).tolist()) == want


def test_leaks(spark):
    r = random.Random(4)
    words = ["".join(r.choice("bdklmnrstv") + r.choice("aeiou") for _ in range(3)) for _ in range(900)]
    items = [(i, "en", " ".join(r.choice(words) for _ in range(50))) for i in range(30)]
    items += [(100, "zh", "".join(chr(0x4E00 + r.randint(0, 3000)) for _ in range(60))), (101, "en", None), (102, "en", "")]
    noise = lambda n: " ".join(r.choice(words) for _ in range(n))
    docs, want = [], set()
    for i, _, text in items[:30]:
        own = text.split()
        kind = i % 3
        if kind == 0:
            part = own[: 40 - i % 5]
            part[7], part[20] = "changed", "other"
            body = "\n\n2\n00:00:01,000 --> 00:00:02,000\n".join([" ".join(part[:15]).upper(), " ".join(part[15:])])
            want.add((i, i))
        elif kind == 1:
            body = " ".join(own[:15])
        else:
            body = " ".join(own[:20]) + " " + noise(4) + " " + " ".join(own[20:40])
            want.add((i, i))
        docs.append((i, noise(80) + " " + body + " " + noise(60)))
    docs += [(100, "前言" + items[30][2][5:55] + "后记"), (200, None), (201, ""), (202, noise(30_000))]
    want.add((100, 100))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("spans", F.lit(0))
    ev = spark.createDataFrame(items, "item_id long, lang string, text string")
    found = leakage.leaks(df, ev)
    assert {(x.doc_id, x.item_id) for x in found.collect()} == want
    for x in found.collect():
        assert all(0 <= s.begin < s.end <= len(dict(docs)[x.doc_id]) for s in x.spans)
    assert leakage.removal_spans(found).count() == len({a for a, _ in want})
    assert leakage.leaks(df.limit(0), ev).count() == 0 and leakage.leaks(df, ev.limit(0)).count() == 0


def test_items_go_in_as_many_passes_as_their_size_needs(spark):
    r = random.Random(24)
    words = ["".join(r.choice("bdklmnrstv") + r.choice("aeiou") for _ in range(3)) for _ in range(900)]
    items = [(i, "en", " ".join(r.choice(words) for _ in range(50))) for i in range(5)]
    docs = [(i, " ".join(r.choice(words) for _ in range(60)) + " " + text) for i, _, text in items]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    ev = spark.createDataFrame(items, "item_id long, lang string, text string")
    for most in (1000, 100):  # three passes and more, then a limit that each single item exceeds
        got = sorted((x.doc_id, x.item_id) for x in leakage.leaks(df, ev, most_item_chars=most).collect())
        assert got == [(i, i) for i in range(5)]


# ---- encoding ----
def test_repair_round_trips(corpus):
    clean = [t for _, _, t in corpus]
    model = encoding.fit_texts(clean[:400], clean[400:500])
    assert sum(encoding.repair(t, model)[0] for t in clean[500:]) == 0
    by = {lang: [t for _, own, t in corpus[500:] if own == lang] for lang in PROSE}
    for lang, pair in (("fr", ("utf-8", "cp1252")), ("de", ("utf-8", "latin-1")), ("es", ("utf-8", "cp437")), ("zh", ("gb18030", "cp1252")), ("ru", ("cp1251", "cp1252")), ("ja", ("utf-8", "cp1252")), ("ru", ("utf-8", "cp1251"))):
        texts = [t for t in by[lang] if not t.isascii()]
        out = [encoding.repair(encoding.misread(t, pair), model) for t in texts]
        assert all(x[0] for x in out), (lang, pair)
        assert np.mean([x[1] == t for x, t in zip(out, texts)]) >= 0.8, (lang, pair)
    twice = encoding.misread(encoding.misread("Nadie cree la historia del sótano.", ("utf-8", "cp1252")), ("utf-8", "cp1252"))
    assert encoding.repair(twice, model)[1] == "Nadie cree la historia del sótano."


def test_damaged_rows(spark, corpus):
    clean = [t for _, _, t in corpus]
    model = encoding.fit_texts(clean, [])
    rows = [(1, "Elle cache les lettres."), (2, "Nadie cree la historia del sÃ³tano."), (3, "temp�te"), (4, None), (5, ""), (6, "plain"), (2, "Nadie cree la historia del sÃ³tano.")]
    out = encoding.damaged(spark.createDataFrame(rows, "k long, t string").withColumn("restored", F.lit(1)), "k", "t", model).collect()
    assert sorted(x.k for x in out) == [2, 2, 3] and {x.restored for x in out if x.k == 2} == {"Nadie cree la historia del sótano."}
    assert encoding.damaged(spark.createDataFrame([], "k long, t string"), "k", "t", model).count() == 0


def test_question_marks_for_letters_are_damage(spark, corpus):
    model = encoding.fit_texts([t for _, _, t in corpus], [])
    lost = ["????????50????????????", "???1956??????\n?????????????", "??? ?????? ?? ????.", "The temp?te of Visa.", "Сад закрыт.\n\n??????????", "Visa: ?????? ???? ???????"]
    clean = ["What??", "Why????", "Quoi ???? Non.", "???", "? ? ?", "What?? Who??", "See http://x.org/a?id=2&b=c", "Visa?\nNo.", "?!?!", "In 1920???"]
    rows = [(k, t) for k, t in enumerate(lost)] + [(100 + k, t) for k, t in enumerate(clean)]
    out = encoding.damaged(spark.createDataFrame(rows, "k long, t string"), "k", "t", model).collect()
    assert sorted(x.k for x in out) == list(range(len(lost)))
    assert all(x.restored == lost[x.k] and {s.encodings for s in x.spans} == {"lost"} for x in out)


def test_the_model_of_encodings_counts_every_text(spark, corpus):
    clean = [t for _, _, t in corpus]
    parts = encoding.summed([encoding.counted(clean[:250]), encoding.counted(clean[250:])])
    whole = encoding.counted(clean)
    key = ["kind", "code"]
    assert parts.sort_values(key).values.tolist() == whole.sort_values(key).values.tolist()
    # what a misread text holds, word by word with weights, against the text misread as a whole
    own = {k: [x for x in clean if encoding.script(x) == k] for k in encoding.SCRIPTS}
    for k, true, assumed in encoding.WIDE:
        if k in ("han", "kana") and own[k]:
            codes = encoding.codes_of(encoding.misread("\n".join(own[k]), (true, assumed)))
            rows = whole[whole["kind"] == encoding.GRAMS + 1 + encoding.WIDE.index((k, true, assumed))]
            assert rows["n"].sum() == (codes > 127).sum() and set(rows["code"]) == set(codes[codes > 127].tolist())
    # more rows than any sample held, and a sign that stands far behind in a long text
    rows = [(i, f"We go home {i}.") for i in range(5000)] + [(5000, "We stay here. " * 400 + "~")]
    fitted = encoding.fit(spark.createDataFrame([("We go home.",)], "text string"), [(spark.createDataFrame(rows, "k long, t string"), "k", "t")])
    assert fitted.context[ord("~")] == 1 and fitted.context[ord("W")] >= 5000 + 400


def test_second_rounds_of_labels_are_found_together(corpus, monkeypatch):
    """Restored texts are labelled again, to see whether they were damaged twice: those of a batch in one call a round, not one each."""
    clean = [t for _, _, t in corpus]
    model = encoding.fit_texts(clean[:300], [])
    once = [encoding.misread(t, ("utf-8", "cp1252")) for _, lang, t in corpus[300:400] if lang in ("fr", "es", "ru")]
    texts = [None, "", "plain", *once, encoding.misread(once[0], ("utf-8", "cp1252"))]
    want = [encoding.repair(t, model) for t in texts]
    assert sum(x[0] for x in want) >= 20
    calls, own = [], encoding.labelled
    monkeypatch.setattr(encoding, "labelled", lambda some, m: calls.append(len(some)) or own(some, m))
    assert encoding.repairs(texts, model) == want and len(calls) <= 6


def test_pairs_that_the_runs_rule_out(corpus):
    """What is told from runs beyond ASCII alone is what the whole text tells."""
    model = encoding.fit_texts([t for _, _, t in corpus], [])
    texts = [encoding.misread(t, pair) for k, (_, _, t) in enumerate(corpus[:60]) for pair in [(("utf-8", "cp1252"), ("cp1251", "cp1252"), ("utf-8", "cp437"), ("gb18030", "cp1252"), ("shift_jis", "cp437"))[k % 5]]]
    told = 0
    for text in [x for x in texts if not x.isascii()] + ["é1é1é", "caf\xe9 1\xe90", "\xe9"]:
        runs = model.prepared(text, "\n")[0]
        assert "".join(x[1] for x in runs) == "".join(x for x in text if x > "\x7f")
        order = tuple(range(len(model.pairs)))
        left = set(model.worth(runs, (-1, order)))
        for k, (true, assumed) in enumerate(model.pairs):
            fixed = encoding.reread(text, (true, assumed))
            saved = -np.inf
            if fixed not in (None, text) and encoding.LOST not in fixed and not encoding.CONTROL.search(fixed) and encoding.of_language(fixed, true):
                saved = model.total(fixed, "\n") - model.total(text, "\n") - model.asked(k, 6.0)
                saved -= 0.0 if encoding.sound((true, assumed)) else 2.0 * max(0, len(text) - len(fixed))
            got = model.trial(text, runs, k, 6.0, "\n")
            if saved > 1.0:
                assert k in left and got[0] == fixed and got[1] == pytest.approx(saved)
                told += 1
            elif true != "euc_jp":  # its kana are asked for later
                assert got == (None, 0.0)
    assert told >= 50


# ---- turns ----
def test_segments_and_labels():
    cast = turns.Cast([(1, "Savovo Kolula"), (2, "Bedalo Luvolu"), (3, "Lokasa Luvote")])
    read = lambda t: turns.read_segment(t, cast)[:2]
    assert read(">> SAVOVO: Hola.") == ("c1", 1) and read("[Savovo Kolula]: Hola.") == ("c1", 1) and read("(Bedalo) No.") == ("c2", 2)
    assert read("<i>BEDALO:</i> No.") == ("c2", 2) and read("S. KOLULA (on phone): No.") == ("c1", 1) and read("Kolula, Savovo: No.") == ("c1", 1)
    assert read("SVAOVO: No.") == ("c1", 1) and read("(45:43) >> BEDALO: Ya.") == ("c2", 2) and read("(PASOS) BEDALO：Ya.") == ("c2", 2)
    assert read("MULTITUD: Ya.") == ("xmultitud", 0) and read("MAN 2: Go.") == ("xman 2", 0)
    assert read("Una cosa está clara: ¿quién?") == (None, 0) and read("[Savovo hums]") == (None, 0) and read("(PASOS)") == (None, 0)
    assert read("♪ BEDALO: la la ♪") == (None, 0) and read("") == (None, 0)
    assert turns.read_segment("[00:05:24] Um, S-Si (tose) vienen", cast)[2] == "Si vienen"
    assert turns.ordered([(2, 0, 5), (1, 1, 9), (1, 0, 9), (3, 0, None)]) == [2, 1, 0, 3]
    # a caption without number goes where its time puts it; without either it comes last
    assert turns.ordered([(1, 0, 10), (2, 0, 20), (3, 0, 30), (None, 0, 25), (None, 0, None)]) == [0, 1, 3, 2, 4]
    # number against time: the number holds, and what only time places keeps to the times that are left
    assert turns.ordered([(1, 0, 40), (2, 0, 20), (3, 0, 50), (None, 0, 45)]) == [0, 1, 3, 2]


def test_cycles_lose_their_least_trusted_constraint():
    r = random.Random(3)
    for _ in range(300):
        n = r.randint(2, 9)
        order = list(range(n))
        r.shuffle(order)
        rank = {k: i for i, k in enumerate(order)}
        edges = []
        for _ in range(r.randint(1, 20)):
            a, b = r.sample(range(n), 2)
            if rank[a] > rank[b]:
                a, b = b, a
            edges.append((2, a, b))
        noise = [(1, *r.sample(range(n), 2)) for _ in range(r.randint(0, 6))]
        got = {k: i for i, k in enumerate(turns.topological(n, edges + noise, lambda k: k))}
        assert sorted(got) == list(range(n)) and all(got[a] < got[b] for _, a, b in edges)
        if not any(rank[a] > rank[b] for _, a, b in noise):
            assert all(got[a] < got[b] for _, a, b in noise)


def test_turns_over_chunks_against_a_loop(spark):
    r = random.Random(6)
    labels = ["ANN: ", "BO: ", "CROWD: ", "", "", "", ""]
    cues, spans, expected, now = [], [], [], None
    for i in range(1, 700):
        label = r.choice(labels)
        text = label + "We go home."
        if label and label != now:
            expected.append((1, i, {"ANN: ": 7, "BO: ": 8}.get(label, 0)))
        now = label or now
        spans.append((i, "00:00:01,000", "00:00:02,000", text, None))
        if i % 50:
            cues.append((i, 1, i, "00:00:01,000", "00:00:02,000", text, "2025-01-02"))
            if i % 9 == 0:
                cues.append((i, 1, i, "00:00:01,000", "00:00:02,000", "OLD: text", "2025-01-01"))
    cues.append((9999, 1, None, None, None, None, None))
    c = spark.createDataFrame(cues, "cue_key long, file_id long, cue_id int, start_time string, end_time string, text string, ingested_at string")
    u = spark.createDataFrame([(1, [s]) for s in spans], "file_id long, spans array<struct<id:int,start_time:string,end_time:string,text:string,dash_index:int>>")
    files = spark.createDataFrame([(1, "F_2000"), (2, None)], "file_id long, repo_name string")
    titles = spark.createDataFrame([("F_2000", 5)], "repo_name string, tmdb_id long")
    cast = spark.createDataFrame([(5, 7, 0, "Ann Lee"), (5, 8, 1, "Bo Day"), (5, 8, 1, "Bo Day")], "tmdb_id long, speaker_id long, cast_order int, char_name string")
    marked = turns.marked_segments(turns.segments_of(turns.captions_of(c, u), turns.cast_of(files, titles, cast)))
    assert sorted((x.file_id, x.cue_id, x.speaker_id) for x in marked.where("begins").collect()) == expected
    merged = turns.turns(marked).collect()
    assert len({x.turn_no for x in merged}) == len(expected)
    assert turns.marked_segments(turns.segments_of(turns.captions_of(c.limit(0), u.limit(0)), turns.cast_of(files, titles, cast))).count() == 0


def test_captions_without_a_number_stand_where_their_time_puts_them(spark):
    clock = lambda s: f"{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d},000"
    cues = [(i, 1, i, clock(10 * i), clock(10 * i + 2), ("ANN: " if i % 100 == 1 else "") + "We go home.", "2025-01-01") for i in range(1, 601)]
    for k, s in ((0, 1504), (1, 5504)):  # after captions 150 and 550, in different chunks
        cues.append((900 + k, 1, None, clock(s), clock(s + 1), "BO: We stay.", "2025-01-01"))
        cues.append((910 + k, 1, None, clock(s), clock(s + 1), "BO: We stay.", "2025-01-02"))
    cues.append((920, 1, None, clock(2010), clock(2012), "ANN: We go home.", "2025-01-01"))  # caption 201 again, without its number
    cues += [(1000 + s, 2, None, clock(s), clock(s + 1), text, "2025-01-01") for s, text in ((900, "BO: Later."), (5, "ANN: First."), (1900, "ANN: Last."))]
    c = spark.createDataFrame(cues, "cue_key long, file_id long, cue_id int, start_time string, end_time string, text string, ingested_at string")
    u = spark.createDataFrame([(f, [(1, "00:00:10,000", "00:00:12,000", "ANN: We go home.", None)]) for f in (1,)] + [(2, [(None, None, None, "ANN: First.", None)])], "file_id long, spans array<struct<id:int,start_time:string,end_time:string,text:string,dash_index:int>>")
    files = spark.createDataFrame([(1, "F_2000"), (2, "F_2000")], "file_id long, repo_name string")
    titles = spark.createDataFrame([("F_2000", 5)], "repo_name string, tmdb_id long")
    cast = spark.createDataFrame([(5, 7, 0, "Ann Lee"), (5, 8, 1, "Bo Day")], "tmdb_id long, speaker_id long, cast_order int, char_name string")
    marked = turns.marked_segments(turns.segments_of(turns.captions_of(c, u), turns.cast_of(files, titles, cast)))
    rows = marked.orderBy("file_id", "chunk", "place").collect()
    assert [(x.cue_id, x.speaker_id) for x in rows if x.file_id == 1 and x.begins] == [(1, 7), (None, 8), (201, 7), (None, 8)]
    assert sum(x.file_id == 1 for x in rows) == 602
    near = [k for k, x in enumerate(rows) if x.file_id == 1 and x.cue_id is None]
    assert [rows[k - 1].cue_id for k in near] == [150, 550] and [rows[k + 1].cue_id for k in near] == [151, 551]
    assert [x.text for x in rows if x.file_id == 2 and x.begins] == ["First.", "Later.", "Last."]


# ---- matching ----
def test_assignment_is_optimal():
    r = random.Random(7)
    for _ in range(150):
        lefts, rights = [f"l{i}" for i in range(r.randint(1, 4))], [f"r{i}" for i in range(r.randint(1, 5))]
        pairs = [(a, b, round(r.random(), 3)) for a in lefts for b in rights if r.random() < 0.7]
        if not pairs:
            continue
        gain = {(a, b): c for a, b, c in pairs}
        for slots in (1, 2):
            got = [(a, b, c) for a, b, c, n in matching.optimal([(a, b, c, slots, 1) for a, b, c in pairs]) if n == 1]
            assert len({b for _, b, _ in got}) == len(got) and all(sum(x[0] == a for x in got) <= slots for a in lefts)
            best = max(
                sum(gain[a, b] for b, a in zip(rights, chosen) if a)
                for chosen in itertools.product([None, *lefts], repeat=len(rights))
                if all((a, b) in gain for b, a in zip(rights, chosen) if a) and all(chosen.count(a) <= slots for a in lefts)
            )
            assert sum(c for *_, c in got) >= best - 1e-4


def brute(pairs, slots, copies):
    """Total of the best assignment with every record of its own."""
    rights = [(b, k) for b in sorted({b for _, b, _ in pairs}) for k in range(copies[b])]
    places = [(a, k) for a in sorted({a for a, *_ in pairs}) for k in range(slots * copies[a])]
    gain = {(a, b): c for a, b, c in pairs}
    best = {0: 0.0}
    for b, _ in rights:
        now = dict(best)
        for used, total in best.items():
            for i, (a, _) in enumerate(places):
                if not used >> i & 1 and (a, b) in gain:
                    key = used | 1 << i
                    now[key] = max(now.get(key, 0.0), total + gain[a, b])
        best = now
    return max(best.values())


def test_assignment_of_copies_is_optimal():
    r = random.Random(17)
    for _ in range(80):
        copies = {**{f"l{i}": r.randint(1, 2) for i in range(3)}, **{f"r{i}": r.randint(1, 3) for i in range(3)}}
        pairs = [(f"l{i}", f"r{j}", round(r.random(), 2)) for i in range(3) for j in range(3) if r.random() < 0.7]
        if pairs:
            for slots in (1, 2):
                got = matching.optimal([(a, b, c, slots * copies[a], copies[b]) for a, b, c in pairs])
                assert all(sum(n for a, *_, n in got if a == x) <= slots * copies[x] for x in copies) and all(sum(n for _, b, _, n in got if b == x) <= copies[x] for x in copies)
                assert abs(sum(c * n for *_, c, n in got) - brute(pairs, slots, copies)) < 1e-4


def test_equal_bids_end_at_once():
    pairs = [(f"l{i}", f"r{j}", 0.9, 2, 1) for i in range(3) for j in range(50)]
    began = time.time()
    got = matching.optimal(pairs)
    assert len(got) == 6 and time.time() - began < 0.1


def test_large_components_by_bids_come_near_the_optimum(spark):
    r = random.Random(13)
    pairs = list({(f"l{r.randrange(30)}", f"r{r.randrange(40)}"): None for _ in range(200)})
    pairs = [(a, b, round(r.uniform(0.5, 1), 3)) for a, b in pairs]
    df = spark.createDataFrame(pairs, "left_id string, right_id string, confidence double").withColumn("copies_l", F.lit(1)).withColumn("copies_r", F.lit(1))
    for most in (5, 1000):  # both sides of the bound
        got = [tuple(x) for x in matching.assign(df, 2, most_pairs=most, epsilon=0.05).collect()]
        best = matching.optimal([(a, b, c, 2, 1) for a, b, c in pairs])
        assert len({b for _, b, *_ in got}) == len(got) and max(sum(x[0] == a for x in got) for a, *_ in got) <= 2
        short = sum(x[2] for x in best) - sum(x[2] for x in got)
        assert short <= (1e-6 if most == 1000 else 0.05 * 40)


def test_copies_are_dealt_to_each_other(spark):
    row = ("The Hot Harbor", None, 1999, "Dana Lo", 100)
    schema = "id string, title_en string, title_zh string, year int, director string, runtime int"
    left = spark.createDataFrame([(f"{i:03d}", *row) for i in range(60)] + [("900", "A Quiet Mill", None, 2001, None, 90)], schema)
    right = spark.createDataFrame([(f"{i:03d}", *row) for i in range(100)] + [("900", "A Quiet Mill", None, 2001, None, None)], schema)
    got = [(x.left_id, x.right_id) for x in matching.matches(left, right).collect()]
    assert len(got) == 101 and len({b for _, b in got}) == 101 and ("900", "900") in got
    held = [sum(a == f"{i:03d}" for a, _ in got) for i in range(60)]
    assert min(held) == 1 and max(held) == 2 and sum(held) == 100


def test_films(spark):
    t = [(1, "The Silent Harbor of Kalamo", "卡拉莫的寂静港口", 2004, "Tako Sesavisa", 120), (2, "The Silent Harbor of Kalamo", None, 1984, "Movo Monolu", 95), (3, "A Final Library", "最后的图书馆", 2010, None, None), (4, None, None, None, None, None), (1, "The Silent Harbor of Kalamo", "卡拉莫的寂静港口", 2004, "Tako Sesavisa", 120)]
    s = [("a", "卡拉莫的寂静港口 - 电影 - 豆瓣", "Teh Silent Habror of Kalamo", 2004, "T. Sesavisa", 121), ("b", "别的 (1984)", "The_Silent_Harbor_of_Kalamo", 1984, "MOVO MONOLU", 95), ("c", "《最后的图书馆2》", "A Final Library 2", 2010, None, None), ("d", "《最后的图书馆》", None, 2010, None, None), ("e", "卡拉莫的寂静港口", None, 2005, "Sesavisa Tako", None)]
    titles = spark.createDataFrame(t, "tmdb_id long, title_en string, title_zh string, year int, director_name string, runtime_min int").withColumn("updated_at", F.lit(1)).withColumn("id", F.lit("clash"))
    subjects = spark.createDataFrame(s, "douban_id string, title string, title_en string, year int, director_name string, runtime_min int").withColumn("fetched_at", F.lit(1))
    left, right = matching.film_sides(titles, subjects)
    got = {(x.left_id, x.right_id) for x in matching.matches(left, right).collect()}
    assert got == {("1", "a"), ("1", "e"), ("2", "b"), ("3", "d")}
    empty = matching.film_sides(titles.limit(0), subjects.limit(0))
    assert matching.matches(*empty).count() == 0


def test_blocks_lose_no_pair(spark):
    rows = [(str(i), f"Film {chr(97 + i % 26)}{i}", None, 1990 + i % 30, f"Dana Lo{i}", 80 + i % 60) for i in range(300)]
    schema = "id string, title_en string, title_zh string, year int, director string, runtime int"
    df = spark.createDataFrame(rows, schema)
    small = {(x.left_id, x.right_id) for x in matching.candidates(df, df, window=6, block=20).collect()}
    assert small == {(x.left_id, x.right_id) for x in matching.candidates(df, df, window=6, block=100_000).collect()} and len(small) >= 300


def test_a_title_of_many_films_loses_no_pair(spark):
    r = random.Random(23)
    name = lambda: "".join(r.choice("bdklmnrst") + r.choice("aeiou") for _ in range(4))
    left, right = [], []
    for i in range(1200):
        year, director, runtime = r.randint(1950, 2020), f"{name().title()} {name().title()}", r.randint(70, 170)
        left.append((str(i), "The Hot Harbor", None, year, director, runtime))
        kind = i % 3
        right.append((str(i), "The Hot Harbor", None, None if kind == 0 else year + r.choice((-1, 1)), None if kind == 2 else director, None if kind == 1 else runtime + (kind == 2) * r.choice((-2, -1, 1, 2))))
    schema = "id string, title_en string, title_zh string, year int, director string, runtime int"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    records = [[matching.Record(x) for x in df.toPandas().itertuples()] for df in (a, b)]
    want = {x.key for x, y in zip(*records) if matching.confidence(x, y) >= 0.5}  # brute force over the planted pairs
    got = {x.left_id for x in matching.candidates(a, b).where("left_id = right_id").collect()}
    print("recall", len(want & got) / len(want))
    assert len(want) > 1100 and len(want & got) >= 0.97 * len(want)


# ---- alignment ----
def test_sentences():
    text = "One. Two! Three? 四。Five"
    assert [text[b:e].strip() for b, e in alignment.sentences(text)] == ["One.", "Two!", "Three?", "四。", "Five"]
    assert alignment.sentences("") == [] and alignment.sentences(None) == [] and len(alignment.sentences("...")) == 0
    spans = [{"id": 1, "dash_index": None, "text": "We leave"}, {"id": 2, "dash_index": None, "text": "tonight. Go!"}, {"id": 3, "dash_index": None, "text": None}]
    assert alignment.source_sentences(spans) == [("We leave tonight.", [1, 2]), ("Go!", [2])]


def test_alignment_finds_planted_links(spark):
    r = random.Random(8)
    units, translations, want = [], [], set()
    for u in range(150):
        own = [(k, r.randrange(4), r.choice(NAMES), r.randint(2, 90)) for k in range(5)]
        make = lambda lang, x: PROSE[lang][x[1]].replace("{}", x[2], 1).replace("{}", str(x[3]))
        spans = [(k + 1, make("en", x), None) for k, x in enumerate(own)]
        target = [x for x in own if r.random() > 0.15]
        if len(target) > 2 and r.random() < 0.5:
            target[0], target[1] = target[1], target[0]
        units.append((1, u, 1, spans))
        translations.append((u, 1, u, "en", None, "fr", " ".join(make("fr", x) for x in target), 1))
        want |= {(u, x[0] + 1, j + 1) for j, x in enumerate(target)}
    units += [(1, 900, 1, []), (1, 901, 1, [(1, "Alone.", None)])]
    translations += [(901, 1, 901, None, None, "fr", None, 1), (902, 1, 902, "en", None, "fr", "", 1)]
    df = spark.createDataFrame(units, "file_id long, unit_id int, chapter_id int, spans array<struct<id:int,text:string,dash_index:int>>")
    tr = spark.createDataFrame(translations, "translation_id long, file_id long, unit_id int, source_lang string, detected_source_lang string, target_lang string, text string, requested_at int")
    got = {(x.unit_id, x.span_id, x.sent_no) for x in alignment.aligned_spans(df, tr, rounds=3).collect()}
    assert len(got & want) >= 0.9 * len(want) and len(got & want) >= 0.9 * len(got)
    assert alignment.aligned_spans(df.limit(0), tr.limit(0), rounds=1).count() == 0


def shards_of(spark, rows):
    """Shards from rows (pair, shard, source sentences, target sentences) of tokens, and the names of the words."""
    groups = {}
    for pair, shard, source, target in rows:
        groups.setdefault((pair, shard), []).append((source, [[] for _ in source], target))
    packed = [alignment.packed(*key, list(range(len(own))), list(range(len(own))), own) for key, own in groups.items()]
    names = {alignment.word_id(x): x for row in rows for side in row[2:] for own in side for x in own}
    return alignment.with_once(spark.createDataFrame(packed, alignment.SHARD)), names


def entries_by_name(table, names):
    out = {}
    for x in table.collect():
        for o, p, b in zip(x.others, x.ps, x.bs):
            s, t = (x.word, o) if x.side == 0 else (o, x.word)
            out[names[s], names[t]] = p, b
    return out


def test_words_thinly_spread_over_shards_count(spark):
    r = random.Random(21)
    rows = []
    for shard in range(4):
        for u in range(200):
            own = r.sample(range(40), 3)
            source, target = [f"s{x}" for x in own], [f"t{x}" for x in own]
            if u == 50 * shard:
                source, target = [*source, "thin"], [*target, "mince"]
            if u == shard == 3:
                source, target = [*source, "once"], [*target, "une fois"]
            rows.append(("en-fr", shard, [source], [target]))
    shards, names = shards_of(spark, rows)
    table = entries_by_name(alignment.train(shards), names)
    assert table["thin", "mince"][0] > 0.5
    assert not [k for k in table if "once" in k or "une fois" in k]


def test_counts_of_all_shards_are_added(spark):
    r, floor = random.Random(22), 0.01
    rows = []
    for u in range(1600):
        own = [*r.sample(range(70), 45), 100 + u // 8]  # the last is in each shard once
        rows.append(("en-fr", u % 8, [[f"s{x}" for x in own]], [[f"t{x}" for x in own if x >= 100 or r.random() < 0.8]]))
    want, of_s, of_t = {}, {}, {}
    for _, _, (source,), (target,) in rows:
        for t in target:
            for s in source:
                c = 1 / (len(source) + 0.02)
                want[s, t], of_s[s], of_t[t] = want.get((s, t), 0) + c, of_s.get(s, 0) + c, of_t.get(t, 0) + c
    shards, names = shards_of(spark, rows)
    table = entries_by_name(alignment.train(shards, rounds=1, floor=floor), names)
    share = {(s, t): (c / (of_s[s] + 0.5), c / (of_t[t] + 0.5)) for (s, t), c in want.items()}
    assert {k for k, v in share.items() if max(v) >= 1.5 * floor + 1e-6} <= set(table)
    assert all(share[k][i] - floor / 2 - 1e-5 <= v[i] <= share[k][i] + 1e-5 for k, v in table.items() for i in (0, 1))


def test_the_table_is_the_same_however_units_are_dealt(spark):
    r = random.Random(23)
    units = []
    for _ in range(600):
        own = r.sample(range(90), 6)
        units.append(([[f"s{x}" for x in own]], [[f"t{x}" for x in own if r.random() < 0.9] or ["t"]]))
    tables = []
    for n in (1, 6, 40):
        shards, names = shards_of(spark, [("en-fr", k % n, *u) for k, u in enumerate(units)])
        tables.append(entries_by_name(alignment.train(shards, rounds=3), names))
    for other in tables[1:]:
        big = {k for k, v in tables[0].items() if max(v) > 0.05}
        assert len(big) >= 90 and all(abs(tables[0][k][0] - other.get(k, (0, 0))[0]) < 0.05 for k in big)


# ---- packing ----
def test_placement_minimises_the_sum_of_squares():
    r = random.Random(9)
    packer, levels = packing.Packer(20), {}
    for _ in range(400):
        size = r.randint(1, 20)
        n = packer.levels.copy()

        def squares(h, n=n, size=size):
            m = n.astype(int).tolist()
            if h:
                m[h] -= 1
            if h + size < 20:
                m[h + size] += 1
            return sum(x * x for x in m[1:20])

        options = [h for h in range(0, 21 - size) if h == 0 or n[h]]
        container = packer.place(size)
        level = levels.get(container, 0)
        assert squares(level) == min(map(squares, options))
        levels[container] = level + size
        assert levels[container] <= 20


def test_packing_is_complete(spark):
    rows = [(i, "word " * n) for i, n in enumerate([1, 5, 40, 100, 300, 1000, 7])] + [(7, None), (8, ""), (9, "word " * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("container", F.lit(1))
    profiles = spark.createDataFrame([(1, 64), (2, 256), (3, 0)], "profile_id int, capacity_tokens int")
    sizes = {x.doc_id: x.n_tokens for x in packing.token_counts(df).collect()}
    out = packing.pack(df, profiles).toPandas()
    for profile, capacity in ((1, 64), (2, 256)):
        own = out[out.profile_id == profile]
        assert own.groupby("doc_id").n_tokens.sum().to_dict() == sizes
        assert own.groupby(["shard", "container"]).n_tokens.sum().max() <= capacity
        pieces = own.groupby("doc_id").size()
        assert all(n == 1 for k, n in pieces.items() if sizes[k] <= capacity)
    assert packing.pack(df.limit(0), profiles).count() == 0
    assert packing.fill(packing.pack(df, profiles), profiles).count() == 2
    assert isinstance(out, pd.DataFrame)


def test_short_items_are_found(spark):
    r = random.Random(31)
    words = ["".join(r.choice("bdklmnrstv") + r.choice("aeiou") for _ in range(3)) for _ in range(3000)]
    items = [(n * 10 + k, "en", " ".join(r.choice(words) for _ in range(n))) for n in range(2, 12) for k in range(3)]
    docs = [(i, " ".join(r.choice(words) for _ in range(30)) + " " + text + " " + " ".join(r.choice(words) for _ in range(30))) for i, _, text in items]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(x.doc_id, x.item_id) for x in leakage.leaks(df, spark.createDataFrame(items, "item_id long, lang string, text string")).collect()}
    assert {(i, i) for i, *_ in items} <= found


def test_labels_are_those_of_the_whole_model(corpus):
    """Leaving out stretches and states changes no path: held against one path over all characters and all states."""
    clean = [t for _, _, t in corpus]
    model = encoding.fit_texts(clean[:300], [])
    texts = [encoding.misread(t, pair) if k % 2 else t for k, t in enumerate(clean[300:340]) for pair in [(("utf-8", "cp1252"), ("cp1251", "cp1252"), ("utf-8", "cp437"))[k % 3]]]
    texts += ["", "plain", "\n".join(texts[:4]), "Nadie cree la historia del sÃ³tano."]
    batch = encoding.labelled(texts, model)
    assert batch == [encoding.labelled([t], model)[0] for t in texts] and sum(map(bool, batch)) >= 10
    for text, spans in zip(texts, batch):
        codes = encoding.codes_of(text)
        at = np.flatnonzero(codes > 127)
        path = encoding.viterbi(model.ratios(codes[at], model.likelihood(text)[at])) if len(at) else []
        want = {int(k) for k, state in zip(at, path) if state}
        got = {k for b, e, _ in spans for k in range(b, e) if codes[k] > 127}
        assert got == want, text


def test_segments_side_by_side():
    """Paths of many segments at once, held against those of one after the other: all lengths, numbers of states, ends and groups."""
    r = np.random.default_rng(5)
    sizes, states, ends = r.integers(1, 40, 300), r.integers(1, 12, 300), r.random(300) < 0.3
    tables = [np.clip(r.normal(0, 6, (n, s)), -9, 12).round() for n, s in zip(sizes, states)]

    def table(some):
        out = np.full((sizes[some].max(), len(some), states[some].max()), -99.0)
        for i, g in enumerate(some):
            out[: sizes[g], i, : states[g]] = tables[g]
        return out

    got = np.split(encoding.viterbi_all(sizes, states, ends, table), np.cumsum(sizes)[:-1])
    for own, path, end in zip(tables, got, ends):
        whole = own if end else np.vstack([own, np.full((1, own.shape[1]), -99.0)])
        assert path.tolist() == encoding.viterbi(whole)[: len(own)].tolist()

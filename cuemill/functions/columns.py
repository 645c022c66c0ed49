"""Scalar text functions as Column expressions: they stay inside generated code and need no Python worker.

Java's classes are ASCII unless ``(?U)`` is given, so patterns that follow Unicode say so. All functions give null for
null unless their docstring says otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values: characters and patterns that results depend on ----
NOTES = "♩♪♫♬"
LATIN = "A-Za-zªºÀ-ÖØ-öø-ʸḀ-ỿⱠ-Ɀ꜠-ꟿＡ-Ｚａ-ｚ"
WORD = r"[\p{L}\p{N}_]"
CJK = "㐀-䶿一-鿿"
LINE_START_FORBIDDEN = r"”」』）)\]}＞〉》】〕»›、，,。.！!？?；;：:·'\"’"
LINE_END_FORBIDDEN = r"“「『（(\[{＜〈《【〔„‚«‹¿¡'\"‘"


def sub(c: Column, pattern: str, to: str) -> Column:
    return F.regexp_replace(c, pattern, to)


def chain(c: Column, *steps: tuple[str, str]) -> Column:
    return reduce(lambda col, step: sub(col, *step), steps, c)


def count(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def collapse(c: Column) -> Column:
    """White space runs become one space, the ends are trimmed."""
    return F.trim(sub(c, r"(?U)\s+", " "))


def strip(c: Column) -> Column:
    return sub(c, r"(?U)^\s+|\s+$", "")


# ---- time ----
def time_ms(c: Column) -> Column:
    """HH:MM:SS,mmm (or with a point) in milliseconds; hours may pass 23, missing millis count as 0."""
    at = lambda g: F.nullif(F.regexp_extract(c, r"^\s*(\d+):(\d+):(\d+)(?:[,.](\d+))?\s*$", g), F.lit("")).cast("bigint")
    millis = F.rpad(F.coalesce(F.nullif(F.regexp_extract(c, r"^\s*\d+:\d+:\d+[,.](\d+)\s*$", 1), F.lit("")), F.lit("0")), 3, "0").cast("bigint")
    return ((at(1) * 60 + at(2)) * 60 + at(3)) * 1000 + millis


def time_text(ms: Column) -> Column:
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3600000), F.floor(ms / 60000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def newline_style(c: Column) -> Column:
    return F.when(c.contains("\r\n"), "crlf").when(c.contains("\r"), "cr").otherwise("lf")


def apply_newline(c: Column, style: Column) -> Column:
    return F.when(style == "crlf", F.replace(c, F.lit("\n"), F.lit("\r\n"))).when(style == "cr", F.replace(c, F.lit("\n"), F.lit("\r"))).otherwise(c)


# ---- tags ----
def keep_style_tags(c: Column) -> Column:
    """Removes tags and override blocks but i, b and u, which become lower case."""
    kept = sub(c, r"(?i)<(?!/?[ibu]>)[^>]+>|\{[^}]*\}", "")
    return chain(kept, ("<I>", "<i>"), ("</I>", "</i>"), ("<B>", "<b>"), ("</B>", "</b>"), ("<U>", "<u>"), ("</U>", "</u>"))


def collapse_style_wraps(c: Column) -> Column:
    return sub(c, r"(?i)</(i|b|u)>(\s*)<\1>", "$2")


def without_style(c: Column) -> Column:
    return sub(c, r"(?i)</?[ibu]>", "")


def only_style(c: Column) -> Column:
    return F.array_join(F.regexp_extract_all(c, F.lit(r"(?i)</?[ibu]>"), 0), "")


def full_wrap(c: Column) -> Column:
    """struct<body, tag>: the text without a style tag that wraps it whole (edge notes apart); tag is null if none does."""
    text = strip(c)
    edge = rf"([{NOTES}\s]*)"
    pattern = rf"(?is)^{edge}<(i|b|u)>((?:(?!</?[ibu]>).)*)</\2>{edge}$"
    inner = F.concat(F.regexp_extract(text, pattern, 1), strip(F.regexp_extract(text, pattern, 3)), F.regexp_extract(text, pattern, 4))
    hit = text.rlike(pattern)
    return F.struct(F.when(hit, inner).otherwise(text).alias("body"), F.when(hit, F.lower(F.regexp_extract(text, pattern, 2))).alias("tag"))


def style_balanced(c: Column) -> Column:
    """Whether i, b and u tags nest: per tag no close comes before its open, and none stays open."""
    tokens = F.transform(F.regexp_extract_all(c, F.lit(r"(?i)</?[ibu]>"), 0), F.lower)

    def of(tag: str) -> Column:
        start = F.struct(F.lit(0).alias("depth"), F.lit(True).alias("ok"))
        step = lambda acc, t: F.struct((acc["depth"] + F.when(t == f"<{tag}>", 1).when(t == f"</{tag}>", -1).otherwise(0)).alias("depth"), (acc["ok"] & ((t != f"</{tag}>") | (acc["depth"] > 0))).alias("ok"))
        return F.aggregate(tokens, start, step, lambda acc: acc["ok"] & (acc["depth"] == 0))

    return of("i") & of("b") & of("u")


def sanitize_style(c: Column) -> Column:
    """Mends dangling tags; drops all of them if they still don't balance."""
    mended = c
    for tag in "ibu":
        mended = chain(mended, (rf"(?i)<{tag}(?![a-zA-Z>])", f"</{tag}>"), (rf"(?i)(?<!<)/{tag}>", f"</{tag}>"))
    return F.when(~c.rlike(r"(?i)</?[ibu]>"), c).when(style_balanced(mended), mended).otherwise(without_style(mended))


def escape_html(c: Column) -> Column:
    return reduce(lambda col, p: F.replace(col, F.lit(p[0]), F.lit(p[1])), (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")), c)


def unescape_html(c: Column) -> Column:
    return reduce(lambda col, p: F.replace(col, F.lit(p[0]), F.lit(p[1])), (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")), c)


def escape_keeping_style(c: Column) -> Column:
    out = escape_html(c)
    for tag in "ibu":
        out = chain(out, (rf"(?i)&lt;{tag}&gt;", f"<{tag}>"), (rf"(?i)&lt;/{tag}&gt;", f"</{tag}>"))
    return out


def tags_to_markers(c: Column) -> Column:
    """Style tags as markers, with the white space around them: <i> to ⟦i⟧, </i> to ⟦/i⟧."""
    return chain(c, (r"(?i)\s*<(/?)([ibu])>\s*", "⟦$1$2⟧"))


def markers_to_tags(c: Column) -> Column:
    return chain(c, (r"(?i)\s*⟦\s*(/?)\s*([ibu])\s*⟧\s*", "<$1$2>"))


# ---- predicates on segments ----
def is_music(c: Column) -> Column:
    return c.rlike(f"[{NOTES}]")


def strip_edge_notes(c: Column) -> Column:
    return sub(c, rf"(?U)^[{NOTES}\s]+|[{NOTES}\s]+$", "")


def has_content(c: Column) -> Column:
    return c.rlike(WORD)


def short_reply(c: Column, latin: bool = True, most: int = 3) -> Column:
    return count(c, rf"[{LATIN}\p{{Nd}}]") <= most if latin else F.length(strip(c)) <= most


def isolated_short(c: Column, latin: bool = True, words: int = 0, chars: int = 4) -> Column:
    """Off while ``words`` is 0."""
    if not words:
        return F.when(c.isNotNull(), F.lit(False))
    return count(c, rf"[{LATIN}]+(?:['’][{LATIN}]+)*") <= words if latin else F.length(strip(c)) <= chars


def residual_text(c: Column, latin: bool = True) -> Column:
    return c.rlike(f"[{LATIN}]") if latin else F.length(strip(c)) > 0


def strip_stutter(c: Column) -> Column:
    return chain(c, (r"(?i)(?<![A-Za-z])([A-Za-z])-\1(?![A-Za-z])", "$1"), (r"(?i)(?<![A-Za-z])([A-Za-z])-(?=\1[a-z])", ""))


def dialogue_parts(c: Column) -> Column:
    """The parts of a cue at dashes that begin it or follow white space; a cue without such a dash is one part."""
    parts = F.filter(F.transform(F.split(c, r"(?i)(?:^|(?<=\s))(?:</?[ibu]>)*-(?!-)(?:</?[ibu]>)*\s?"), strip), lambda x: x != "")
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(c))


def boundary_class(c: Column) -> Column:
    """trail_off, comma, period or colon by the end of the text, the first that fits; else null."""
    return (
        F.when(c.rlike(r"(?U)(\.{2,}|-{2,}|—+|…+)\s*$"), "trail_off")
        .when(c.rlike(r"(?U)[,，、]\s*$"), "comma")
        .when(c.rlike(r"(?U)[.。!?！？]['\"”’)\]」』]*\s*$"), "period")
        .when(c.rlike(r"(?U)[:：]\s*$"), "colon")
    )


# ---- measures ----
def content_weight(c: Column) -> Column:
    """2.5 a Latin word (plain letters), 0.5 a digit, 1 another letter; null texts weigh null."""
    return count(c, r"[a-zA-Z]+(?:['’][a-zA-Z]+)*") * 2.5 + count(c, r"\p{Nd}") * 0.5 + count(c, r"[\p{L}\p{N}&&[^A-Za-z0-9]]")


def effective_length(c: Column) -> Column:
    plain = without_style(c)
    weight = content_weight(plain)
    return F.when(weight > 0, weight).otherwise(F.length(plain).cast("double"))


def token_estimate(c: Column) -> Column:
    """CJK characters count 1, others a quarter; null counts 0."""
    wide = count(c, f"[{CJK}぀-ヿ가-힯豈-﫿]")
    return F.coalesce(wide + (F.length(c) - wide) / 4.0, F.lit(0.0))


#: Reading profile by language key, (characters a second, characters a line, weighted or plain).
READING = {"zh-hans": (9, 16, True), "zh-hant": (9, 16, True), "yue": (9, 16, True), "ja": (4, 13, True), "ko": (12, 16, True), "en": (20, 42, False), "hi": (22, 42, False), "ru": (17, 39, False), "th": (17, 35, False)}


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def reading_speed(c: Column, duration_ms: Column, language: Column) -> Column:
    """struct<cps, over_cps, over_length> of a caption under the profile of its language key."""
    lines = F.filter(F.transform(F.split(F.replace(sub(c, r"\{[^}]*\}|</?[a-zA-Z][^>]*>", ""), F.lit("\\N"), F.lit("\n")), "\n"), collapse), lambda x: x != "")
    weighted = F.coalesce(F.try_element_at(literal_map({k: v[2] for k, v in READING.items()}), language), F.lit(False))
    most_cps = F.coalesce(F.try_element_at(literal_map({k: v[0] for k, v in READING.items()}), language), F.lit(17))
    most_line = F.coalesce(F.try_element_at(literal_map({k: v[1] for k, v in READING.items()}), language), F.lit(42))
    joined = F.length(F.array_join(lines, " ")).cast("double")
    sizes = F.transform(lines, lambda x: F.when(weighted & (content_weight(x) > 0), content_weight(x)).otherwise(F.length(x).cast("double")))
    total = F.aggregate(F.transform(lines, content_weight), F.lit(0.0), lambda a, x: a + x)
    length = F.when(weighted & (total > 0), total).otherwise(joined)
    cps = length / F.greatest(duration_ms / 1000.0, F.lit(0.001))
    return F.struct(cps.alias("cps"), (cps > most_cps).alias("over_cps"), (F.coalesce(F.array_max(sizes), F.lit(0.0)) > most_line).alias("over_length"))


# ---- language ----
#: Aliases of language codes, and regions of traditional Chinese.
ALIASES = {"cantonese": "yue", "lzh": "zh-hant", "iw": "he", "in": "id", "nb": "no", "nn": "no", "fil": "tl"}
#: Script of each language.
SCRIPTS = {
    "latin": "en es fr de it pt nl pl sv da no fi ro cs hu tr id vi ms tl ca eu gl la fil nb",
    "cjk": "zh ja ko yue lzh",
    "cyrillic": "ru uk bg",
    "arabic": "ar fa ur",
    "devanagari": "hi ne mr",
    "thai": "th",
    "hebrew": "he iw",
    "greek": "el",
}
SCRIPT_OF = {code: script for script, codes in SCRIPTS.items() for code in codes.split()}
#: Characters of each script; scripts written in words are counted by words.
SCRIPT_RANGES = {"latin": "A-Za-z", "cyrillic": "Ѐ-ӿ", "arabic": "؀-ۿ", "devanagari": "ऀ-ॿ", "thai": "฀-๿", "hebrew": "֐-׿", "greek": "Ͱ-Ͽ", "cjk": f"{CJK}぀-ヿ가-힯"}
BY_WORD = ("latin", "cyrillic", "arabic", "devanagari", "hebrew", "greek")


def primary_subtag(c: Column) -> Column:
    return F.lower(F.split(F.coalesce(c, F.lit("")), "-").getItem(0))


def language_key(c: Column) -> Column:
    """Primary language, aliases resolved; Chinese becomes zh-hans or zh-hant by script, else by region."""
    tag = F.replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), F.lit("_"), F.lit("-"))
    parts = F.split(tag, "-")
    base = parts.getItem(0)
    rest = F.slice(parts, 2, 8)
    chinese = F.when(F.array_contains(rest, "hant"), "zh-hant").when(F.array_contains(rest, "hans"), "zh-hans").when(F.arrays_overlap(rest, F.array(F.lit("tw"), F.lit("hk"), F.lit("mo"))), "zh-hant").otherwise("zh-hans")
    return F.when(base == "zh", chinese).otherwise(F.coalesce(F.try_element_at(literal_map(ALIASES), base), base))


def script_of(c: Column) -> Column:
    return F.try_element_at(literal_map(SCRIPT_OF), primary_subtag(c))


def untranslated(text: Column, source: Column, target: Column) -> Column:
    """Whether runs of the source script remain in a text of another script: more than two where names are let pass, else any."""
    s, t = script_of(source), script_of(target)
    clean = F.trim(sub(text, r"\{\\[^}]*\}|<[^>]*>|⟦[^⟦⟧]*⟧", ""))
    runs = reduce(lambda col, name: col.when(s == name, count(clean, f"[{SCRIPT_RANGES[name]}]" + ("+" if name in BY_WORD else ""))), SCRIPT_RANGES, F.when(F.lit(False), F.lit(0)))
    names_pass = s.isin(*BY_WORD) & (t.isin(*BY_WORD) | ((s == "latin") & (t == "cjk")))
    return F.coalesce((text != "") & s.isNotNull() & t.isNotNull() & (s != t) & (clean != "") & (runs > F.when(names_pass, 2).otherwise(0)), F.lit(False))


def bare(c: Column) -> Column:
    """A text without tags, white space, notes, punctuation and numbers, for comparison."""
    return sub(without_style(F.coalesce(c, F.lit(""))), rf"(?U)[\s\p{{P}}\p{{N}}{NOTES}]", "")


def words(c: Column) -> Column:
    return count(without_style(F.coalesce(c, F.lit(""))), rf"{WORD}+")


def leaked_untranslated(original: Column, translated: Column, source: Column, target: Column) -> Column:
    """Whether a translation is its source again; single words may be, except between Latin script and CJK."""
    s, t = script_of(source), script_of(target)
    across = F.coalesce(((s == "latin") & (t == "cjk")) | ((s == "cjk") & (t == "latin")), F.lit(False))
    return (bare(original) != "") & (bare(original) == bare(translated)) & (across | (words(original) > 1))


def length_plausible(original: Column, translated: Column, least: float = 0.15, most: float = 6.0) -> Column:
    own, other = count(F.coalesce(original, F.lit("")), WORD), count(F.coalesce(translated, F.lit("")), WORD)
    return F.when(own == 0, True).otherwise((other / own).between(least, most))


# ---- markers ----
def marker_leak(original: Column, translated: Column) -> Column:
    return count(F.coalesce(translated, F.lit("")), "[⟦⟧]") > count(F.coalesce(original, F.lit("")), "[⟦⟧]")


def normalize_markers(c: Column) -> Column:
    return sub(c, r"⟦\s*([a-zA-Z]{1,3})\s*(\d+(?:\.\d+)?)\s*⟧", "⟦$1$2⟧")


def strip_foreign_markers(c: Column) -> Column:
    """Keeps cue markers ⟦cN⟧ and ⟦cN.M⟧, drops other markers and stray brackets."""
    return sub(c, r"(?i)(⟦c\d+(?:\.\d+)?⟧)|⟦[^⟦⟧]*⟧|[⟦⟧]", "$1")


def remove_residual_markers(c: Column) -> Column:
    return chain(c, (r"(?U)\s+⟦[^⟦⟧]*⟧\s+", " "), (r"⟦[^⟦⟧]*⟧", ""))


def cue_chunks(c: Column) -> Column:
    """map<marker id, text up to the next marker>; an id that comes twice is left out."""
    hits = F.regexp_extract_all(c, F.lit(r"⟦c(\d+(?:\.\d+)?)⟧([^⟦]*(?:⟦(?!c\d+(?:\.\d+)?⟧)[^⟦]*)*)"), 1)
    bodies = F.transform(F.regexp_extract_all(c, F.lit(r"⟦c(\d+(?:\.\d+)?)⟧([^⟦]*(?:⟦(?!c\d+(?:\.\d+)?⟧)[^⟦]*)*)"), 2), strip)
    pairs = F.arrays_zip(hits.alias("id"), bodies.alias("text"))
    once = F.filter(pairs, lambda p: F.size(F.filter(hits, lambda h: h == p["id"])) == 1)
    return F.map_from_entries(once)


# ---- target text ----
def music_spacing(c: Column) -> Column:
    return chain(c, (rf"(?U)(?<=\S)([{NOTES}])", " $1"), (rf"(?U)([{NOTES}])(?=\S)", "$1 "))


def music_line(c: Column) -> Column:
    """Inner notes go, the line begins and ends with one."""
    inner = F.when(F.length(c) > 1, sub(c, rf"(?<!^)[{NOTES}](?!$)", "")).otherwise(c)
    line = collapse(inner)
    line = F.when(line == "", F.lit(NOTES[0])).when(line.rlike(f"^[{NOTES}]"), line).otherwise(F.concat(F.lit("♪"), line))
    return F.when(line.rlike(f"[{NOTES}]$"), line).otherwise(F.concat(line, F.lit("♪")))


def line_edges(c: Column) -> Column:
    """Drops characters that may not begin or end a line."""
    return chain(c, (rf"(?U)^(?:[{LINE_START_FORBIDDEN}]\s*)+", ""), (rf"(?U)(?:\s*[{LINE_END_FORBIDDEN}])+$", ""))


def defers_punctuation(target: Column) -> Column:
    return language_key(target).rlike("^(zh|yue|ja)(-|$)")


def normalize_translation(c: Column, target: Column) -> Column:
    """Dashes to dots, one form of ellipsis (not for Chinese and Japanese), spaces around notes, single spaces, legal edges."""
    dashed = sub(c, "—+|-{2,}", "...")
    spaced = chain(dashed, (rf"(?U)(?:\.{{2,}}|…+)(?=$|\s|[{LINE_START_FORBIDDEN}])", "..."), (r"(?U)(?:\.{2,}|…+)(?![.…])(?=[^\s])", "..."))
    spaced = sub(spaced, rf"(?U)\.\.\.(?![\s{LINE_START_FORBIDDEN}]|$)", "... ")
    return line_edges(collapse(music_spacing(F.when(defers_punctuation(target), dashed).otherwise(spaced))))


def trim_final_space(c: Column, source: Column) -> Column:
    """No space before final punctuation unless the source has one."""
    end = r"(?U)\s+(?=[.!?…]+(?:[\"'”’»)\]]|</[ibu]>)*$)"
    return F.when(source.rlike(r"(?U)\s[.!?…]+(?:[\"'”’»)\]]|</[ibu]>)*\s*$"), c).otherwise(sub(c, end, ""))


_CLOSING = r"(?:</(?:i|b|u)>|\{[^}]*\}|['\"”’»›」』）)}\]】♪♫♬♩])"
_NO_SPACE = rf"(?={_CLOSING}*(?:$|\s|[、，。！？；：,.!?;:…]))"


def halve_marks(c: Column, pairs: dict[str, str]) -> Column:
    for wide, narrow in pairs.items():
        c = chain(c, (rf"{wide}{_NO_SPACE}", narrow), (wide, narrow + " "))
    return c


def restyle_punctuation(c: Column, target: Column, full_width: bool = False, keep_terminators: bool = False) -> Column:
    """Punctuation policy of Chinese and Japanese targets: terminators dropped, kept or halved, one form of ellipsis; ！ and ？ become half width unless ``full_width``."""
    cjk = defers_punctuation(target)
    if full_width:
        dots = sub(c, r"\.{2,}", "…")
    else:
        dots = chain(c, (rf"(?:\.{{2,}}|…+){_NO_SPACE}", "..."), (r"…+", "... "), (r"\.{2,}(?![\s.]|$|[、，。！？；：,!?;:…'\"”’»›」』）)}\]】♪♫♬♩<{])", "... "))
    if not keep_terminators:
        gone = chain(dots, (r"(?:[、，。]|(?<!\d),(?!\d))(?=[\s\S]*[\p{L}\p{N}_])", " "), (r"[、，。]|(?<!\d),(?!\d)", ""))
        own = F.array_join(F.transform(F.split(sub(gone, " {2,}", " "), "\n"), strip), "\n")
        own = F.when(gone == dots, dots).otherwise(own)
    elif not full_width:
        japanese = F.when(primary_subtag(target) == "ja", halve_marks(dots, {"，": ",", "。": ".", "、": ","})).otherwise(halve_marks(dots, {"，": ",", "。": "."}))
        own = japanese
    else:
        own = dots
    styled = F.when(cjk, own).otherwise(c)
    halved = chain(F.translate(styled, "！？", "!?"), (rf"([!?]+)(?![!?]){_NO_SPACE}", "$1"))
    spaced = sub(halved, rf"([!?]+)(?![!?])(?!{_CLOSING}*(?:$|\s|[、，。！？；：,.!?;:…]))", "$1 ")
    return F.when(cjk & F.lit(full_width), styled).otherwise(spaced)


#: Quotation marks by target language key.
QUOTES = {"zh-hans": "“”", "zh-hant": "「」", "yue": "「」"}


def rectify_quotes(c: Column, source: Column, target: Column) -> Column:
    """Mends reversed and doubled quotation marks of Chinese targets; drops them if the source has none."""
    key, out = language_key(target), c
    for name, (o, e) in QUOTES.items():
        inside = rf"([^{o}{e}。！？…\n]+)"

        def mended(a: str, z: str, o=o, e=e, inside=inside) -> Column:
            return chain(c, (rf"{e}{inside}{o}", f"{a}$1{z}"), (rf"{e}{inside}{e}", f"{a}$1{z}"), (rf"{o}{inside}{o}", f"{a}$1{z}"), (rf"{o}(\s*)$", f"{z}$1"), (rf"{o}(\s*[。！？…])", f"{z}$1"), (rf"^(\s*){e}", f"$1{a}"))

        quoted = source.rlike("[\"”“]")
        out = F.when((key == name) & c.rlike(f"[{o}{e}]"), F.when(quoted, mended(o, e)).otherwise(mended("", ""))).otherwise(out)
    return out


def truncate_context(c: Column, most: int) -> Column:
    """At most so many characters; a word of ASCII letters that the cut would split goes whole."""
    cut = F.left(c, F.lit(most))
    split = F.substring(c, most, 1).rlike("[A-Za-z0-9]") & F.substring(c, most + 1, 1).rlike("[A-Za-z0-9]") & cut.contains(" ")
    return F.when(F.length(c) <= most, c).otherwise(strip(F.when(split, sub(cut, r"\S+$", "")).otherwise(cut)))


# ---- names and ids ----
def slug(c: Column) -> Column:
    return F.btrim(sub(F.lower(c), "[^a-z0-9]+", "-"), F.lit("-"))


def edition(web: Column, bluray: Column, label: Column) -> Column:
    """struct<name, reason>: both sources are a conflict, neither without a label is empty."""
    own = F.coalesce(slug(label), F.lit(""))
    tail = F.when(own != "", F.concat(F.lit("-"), own)).otherwise("")
    name = F.when(web & bluray, F.lit(None)).when(web, F.concat(F.lit("web"), tail)).when(bluray, F.concat(F.lit("bluray"), tail)).when(own != "", own)
    return F.struct(name.alias("name"), F.when(web & bluray, "conflict").when(name.isNull(), "empty").alias("reason"))


def parse_repo_name(c: Column) -> Column:
    """struct<title, year, strict>: Title_2015, else the first 19xx or 20xx anywhere; nulls if neither."""
    name = F.btrim(c, F.lit("_-"))
    strict = name.rlike(r"^.+[_-]\d{4}$")
    title = F.trim(sub(F.regexp_extract(name, r"^(.+)[_-](\d{4})$", 1), "[_-]+", " "))
    year = F.nullif(F.regexp_extract(name, r"^(.+)[_-](\d{4})$", 2), F.lit("")).cast("int")
    loose_year = F.nullif(F.regexp_extract(c, r"(19\d{2}|20\d{2})", 1), F.lit("")).cast("int")
    rest = F.btrim(F.concat(F.regexp_extract(c, r"(?s)^(.*?)(?:19\d{2}|20\d{2})(.*)$", 1), F.regexp_extract(c, r"(?s)^(.*?)(?:19\d{2}|20\d{2})(.*)$", 2)), F.lit("_- "))
    loose = F.trim(sub(rest, r"[_\-]+", " "))
    usable = loose_year.isNotNull() & (loose != "")
    return F.struct(F.when(strict, title).when(usable, loose).alias("title"), F.when(strict, year).when(usable, loose_year).alias("year"), strict.alias("strict"))


def imdb_number(c: Column) -> Column:
    return F.nullif(sub(c, "(?i)^tt", ""), F.lit(""))


def release_keywords(c: Column) -> Column:
    return F.array_join(F.filter(F.split(c, "[-_]+"), lambda x: x != ""), ",")


def http_reason(code: Column) -> Column:
    """Kind of a failed call by its status; any other status, and none at all, is the network's."""
    return F.when(code.isin(401, 403), "auth_error").when(code == 429, "rate_limit").when(code >= 500, "server_error").otherwise("network_error")


def quota_text(c: Column) -> Column:
    """Whether an error text says that a quota is used up."""
    return F.lower(F.coalesce(c, F.lit(""))).rlike("quota|resource_exhausted|credit|included usage")


def subject_id(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"/subject/(\d+)", 1), F.lit(""))


def on_host(url: Column, host: str) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("HOST")).contains(host), F.lit(False))


def display_title(zh: Column, en: Column) -> Column:
    title = F.coalesce(F.nullif(zh, F.lit("")), en)
    return F.when(title.rlike(f"[{CJK}]"), F.concat(F.lit("《"), title, F.lit("》"))).otherwise(title)


def replace_section(text: Column, start: str, end: str, body: Column) -> Column:
    """struct<text, found>: what stands between two anchors replaced once."""
    q = lambda s: "\\Q" + s + "\\E"
    pattern = rf"(?s)^(.*?{q(start)})(.*?)({q(end)}.*)$"
    found = text.rlike(pattern)
    new = F.concat(F.regexp_extract(text, pattern, 1), body, F.regexp_extract(text, pattern, 3))
    return F.struct(F.when(found, new).otherwise(text).alias("text"), found.alias("found"))


def clean_reference_text(c: Column) -> Column:
    """Without [1] and note references, white space collapsed."""
    return collapse(sub(F.coalesce(c, F.lit("")), r"\[(?:\d+|[a-z]|note \d+|注 ?\d+)\]", ""))


def emphasis_spacing(c: Column) -> Column:
    """A space between markdown emphasis and a word character beside it."""
    spans = r"(\*\*[^\n*]+?\*\*|\*[^\n*]+?\*)"
    return chain(c, (rf"(?U)(?<=\w){spans}", " $1"), (rf"(?U){spans}(?=\w)", "$1 "))


def markdown_sections(c: Column) -> Column:
    """array<struct<name, body>> of the ## sections, in order."""
    names = F.transform(F.regexp_extract_all(F.concat(c, F.lit("\n")), F.lit(r"(?m)^## (.+?)[ \t]*$\n"), 1), F.trim)
    pieces = F.split(F.concat(F.lit("\n"), c, F.lit("\n")), r"(?m)^## .+$\n")
    bodies = F.slice(pieces, 2, F.size(pieces))
    return F.transform(F.arrays_zip(names.alias("name"), F.transform(bodies, strip).alias("body")), lambda s: F.struct(s["name"].alias("name"), s["body"].alias("body")))


def fill_template(template: Column, values: dict[str, Column]) -> Column:
    """A template with {name} placeholders filled; a null value leaves nothing."""
    return reduce(lambda col, item: F.replace(col, F.lit("{" + item[0] + "}"), F.coalesce(item[1].cast("string"), F.lit(""))), values.items(), template)


def scoped_query(terms: Column, sites: list[str]) -> Column:
    """A search limited to sites."""
    clause = f"site:{sites[0]}" if len(sites) == 1 else "(" + " OR ".join(f"site:{s}" for s in sites) + ")"
    return F.concat(F.lit(clause + " "), terms)


def target_of(path: Column) -> Column:
    """struct<edition, lang> of a source file's path; nulls for other paths."""
    pattern = r"subtitles/([^/]+)/work/source/([^/]+)\.srt$"
    hit = path.rlike(pattern)
    return F.struct(F.when(hit, F.regexp_extract(path, pattern, 1)).alias("edition"), F.when(hit, F.regexp_extract(path, pattern, 2)).alias("lang"))


def nearest(places: Column, goal: Column) -> Column:
    """The element nearest to the goal, the lower one of two; null for none."""
    return F.array_min(F.transform(places, lambda x: F.struct(F.abs(x - goal).alias("d"), x.alias("x"))))["x"]


def latin_leaks(text: Column, forced: Column) -> Column:
    """Distinct Latin words of two letters or more outside markup that no glossary target forces."""
    plain = sub(text, r"\{\\[^}]*\}|<[^>]*>|⟦[^⟦⟧]*⟧", " ")
    return F.array_distinct(F.filter(F.regexp_extract_all(plain, F.lit("[A-Za-z]{2,}"), 0), lambda w: ~F.array_contains(forced, w)))


def marker_order(marker: Column) -> Column:
    """struct<cue, part> to sort marker ids by number: 9 before 10, 10 before 10.1."""
    parts = F.split(marker, r"\.")
    return F.struct(parts.getItem(0).cast("int").alias("cue"), F.coalesce(F.get(parts, F.lit(1)).cast("int"), F.lit(0)).alias("part"))


# ---- ids of a film ----
def manual_id(c: Column) -> Column:
    """struct<kind, value> of what was typed in: an IMDb id anywhere, else the first digits as a TMDB id."""
    imdb = F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"tt\d{6,9}", 0), F.lit(""))
    digits = F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), r"\d+", 0), F.lit(""))
    return F.struct(F.when(imdb.isNotNull(), "imdb").when(digits.isNotNull(), "tmdb").alias("kind"), F.coalesce(imdb, digits).alias("value"))


def readme_ids(c: Column) -> Column:
    """struct<media_type, tmdb_id, imdb_id>: the first links of each kind."""
    link = lambda pattern, group: F.nullif(F.regexp_extract(F.coalesce(c, F.lit("")), pattern, group), F.lit(""))
    tmdb = r"themoviedb\.org/(movie|tv)/(\d+)"
    return F.struct(link(tmdb, 1).alias("media_type"), link(tmdb, 2).alias("tmdb_id"), link(r"imdb\.com/title/(tt\d+)", 1).alias("imdb_id"))


# ---- spans and cues of a unit ----
def translatable(text: Column, hits: Column) -> Column:
    """Whether a word character is left beside the glossary hits (start, end)."""
    blanked = F.aggregate(hits, text, lambda x, h: F.concat(F.substr(x, F.lit(1), h["start"]), F.repeat(F.lit(" "), h["end"] - h["start"]), F.substr(x, h["end"] + 1)))
    return F.coalesce(blanked, text).rlike(r"[\p{L}\p{N}_]")


def addressable(spans: Column, resolved: Column) -> Column:
    """Of each span whether it can be asked for alone: it has a marker of its own, or is the only one of an open unit."""
    return F.transform(spans, lambda s: F.coalesce(s["boundary"] == "marker", F.lit(False)) | ((F.size(spans) == 1) & resolved.isNull()))


def boundary_stops(html: Column) -> Column:
    """Places (from 0, in order) at which a reply's pieces may end: the first tag or group marker of each numbered span, every other one, and every div."""
    def places(pattern: str) -> Column:
        # the text in front of each match, piece by piece
        pieces = F.split(html, pattern)
        found = F.regexp_extract_all(html, F.lit(pattern), 0)
        zipped = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda before, m: F.struct(F.length(before).alias("n"), m.alias("m")))
        summed = F.aggregate(
            zipped,
            F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<at:int,m:string>>").alias("l")),
            lambda a, z: F.struct((a["at"] + z["n"] + F.length(z["m"])).alias("at"), F.concat(a["l"], F.array(F.struct((a["at"] + z["n"]).alias("at"), z["m"].alias("m")))).alias("l")),
        )
        return summed["l"]

    tags = F.concat(places(r"<span[^>]*>"), places("⟦[^⟦⟧]*⟧"))
    number = lambda m: F.nullif(F.regexp_extract(m, r"(?:data-)?id=\"?[a-z]*(\d+)\"?|⟦[a-z]*(\d+)⟧", 1), F.lit(""))
    second = lambda m: F.nullif(F.regexp_extract(m, r"⟦[a-z]*(\d+)⟧", 1), F.lit(""))
    numbered = F.transform(tags, lambda x: F.struct(F.coalesce(number(x["m"]), second(x["m"])).alias("id"), x["at"].alias("at")))
    first = F.filter(numbered, lambda x: x["id"].isNull() | ~F.exists(numbered, lambda y: (y["id"] == x["id"]) & (y["at"] < x["at"])))
    return F.array_sort(F.concat(F.transform(first, lambda x: x["at"]), F.transform(places("<div[^>]*>"), lambda x: x["at"])))

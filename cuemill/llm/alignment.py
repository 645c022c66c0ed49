"""Sentence alignment of bilingual units.

Translation tables of each language pair are estimated by expectation-maximization (word translation probabilities as
in the first of the classical statistical models, with a null word and a mild preference for like positions). The
expectation runs over shards of units next to the current table, the maximization is one aggregation; neither the
units nor the table pass through the driver: a shard gets the part of the table that its words name. Sentences are
then linked competitively: the best-scoring pair of sentences anywhere in the unit is accepted first, further pairs
while they are compatible (each side may be merged or split into a few), and what scores too low stays unaligned.

Tokens: words, numbers, the characters and character pairs of scripts without spaces, and the syllables of
capitalised words, which names keep when they are transcribed. Within the tables a token is a hash of 63 bits. Words
that a single unit of all holds can tell nothing about another unit and have no entries.

Defined results: a unit without spans or with a null or empty translation gives no rows; repeated rows count once
(the latest request holds); captions of blank text are no part of a sentence; ties go to the earlier sentences; a
pair of languages with a single unit still aligns by numbers, names and positions; empty tables give an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ensure_checkpoint_dir

SPACELESS = re.compile(r"[぀-ヿ㐀-鿿]")
WORD = re.compile(r"[぀-ヿ㐀-鿿]|[^\W_぀-ヿ㐀-鿿]+(?:['’][^\W\d_]+)?")
ENDS = ".!?。！？"
SYLLABLE = re.compile(r"[^aeiouyаеиоуыэюяё]*[aeiouyаеиоуыэюяё]", re.I)
TAGS = re.compile(r"</?[a-zA-Z][^<>\n]*>|\{\\[^{}\n]*\}|[♪♫]")


def sentences(text: str | None) -> list[tuple[int, int]]:
    """(begin, end) of the sentences: one ends after . ! ? 。 ！ or ？, and nothing else ends one; the rest after the last mark is one if it holds words."""
    out, begin = [], 0
    text = text or ""
    for at, c in enumerate(text):
        if c in ENDS:
            # a run of marks and the quotes behind belong to the sentence; a mark without words before it makes none
            if at + 1 < len(text) and text[at + 1] in ENDS:
                continue
            if WORD.search(text, begin, at):
                out.append((begin, at + 1))
                begin = at + 1
            elif out:
                out[-1] = (out[-1][0], at + 1)
                begin = at + 1
    if WORD.search(text, begin):
        out.append((begin, len(text)))
    return out


def tokens(text: str) -> list[str]:
    """Tokens of a sentence, each once."""
    text = TAGS.sub(" ", text)
    out: dict[str, None] = {}
    before = ""
    for m in WORD.finditer(text):
        word = m.group()
        if SPACELESS.match(word):
            out[word] = None
            if before and m.start() == last:
                out[before + word] = None
            before, last = word, m.end()
            continue
        before = ""
        low = word.lower()
        if low.isdigit():
            out["#" + low] = None
            continue
        out[low] = None
        if len(low) > 5 and not word[:1].isupper():
            out[low[:5] + "~"] = None
        if word[:1].isupper() and len(word) > 2:
            for s in SYLLABLE.findall("".join(c for c in unicodedata.normalize("NFKD", low) if not unicodedata.combining(c))):
                out["^" + s] = None
    return list(out)


def source_sentences(spans: list) -> list[tuple[str, list[int]]]:
    """Sentences of a unit's spans as (text, span ids that hold a piece of it); a sentence may run over spans, a span may hold several."""
    ordered = sorted((s for s in spans if s is not None and s["text"] and s["id"] is not None), key=lambda s: (s["id"], -1 if s["dash_index"] is None else s["dash_index"]))
    text, owner = "", []
    for s in ordered:
        own = TAGS.sub(" ", s["text"]).replace("\n", " ").strip()
        if not own:
            continue
        text += own + " "
        owner += [s["id"]] * (len(own) + 1)
    out = []
    for b, e in sentences(text):
        held = dict.fromkeys(owner[k] for k in range(b, e) if not text[k].isspace() and (text[k].isalnum() or text[k] in ENDS))
        out.append((text[b:e].strip(), list(held)))
    return out


STRONG_BIT = 1
#: In place of a token where a count is of the other one alone; tokens are not negative.
NONE = -1


def word_id(token: str) -> int:
    """A token as a number of 63 bits; its lowest bit says whether the token, found unchanged on the other side, speaks for itself (numbers, syllables of names, longer words)."""
    return (xxhash.xxh3_64_intdigest(token.encode("utf-8", "replace")) >> 1) & ~STRONG_BIT | int(token[:1] in "#^" or len(token) > 3)


@dataclass
class Side:
    """One side of a shard's units: its words, and for all sentences in order the places of their tokens among the words."""

    words: np.ndarray
    ids: np.ndarray
    begins: np.ndarray  # of each sentence in ids, and the end
    first: np.ndarray  # sentence with which each unit begins, and the end

    @staticmethod
    def of(row, name: str) -> Side:
        arrays = [np.asarray(getattr(row, f"{name}_{part}")) for part in ("words", "ids", "lengths", "sentences")]
        starts = lambda x: np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
        return Side(arrays[0].astype(np.int64), arrays[1].astype(np.int64), starts(arrays[2]), starts(arrays[3]))

    def unit(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of a unit, and the length of each of its sentences."""
        begins = self.begins[self.first[k] : self.first[k + 1] + 1]
        return self.ids[begins[0] : begins[-1]], np.diff(begins)


def parts(source: Side, target: Side, known: tuple[np.ndarray, np.ndarray], most_cells: int) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
    """Units of a shard with the places of their words (source, target) in a matrix of at most ``most_cells`` cells, or of one unit.

    Only words that are ``known`` to give counts have a place; the others have -1."""
    stack = [range(len(source.first) - 1)]
    while stack:
        own = stack.pop()
        places = []
        for side, learns in zip((source, target), known):
            held = np.unique(side.ids[side.begins[side.first[own.start]] : side.begins[side.first[own.stop]]])
            held = held[learns[held]]
            place = np.full(len(side.words), -1, np.int64)
            place[held] = np.arange(len(held))
            places.append(place)
        if (places[0].max(initial=-1) + 1) * (places[1].max(initial=-1) + 1) > most_cells and len(own) > 1:
            half = own.start + len(own) // 2
            stack += [range(half, own.stop), range(own.start, half)]
        else:
            yield own, places[0], places[1]


Entries = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # s, t, p, b


def matrix(source: Side, target: Side, places: tuple[np.ndarray, np.ndarray], entries: Entries | None, column: int, rest: float) -> np.ndarray:
    """The part of the table that the words with a place name; ``rest`` where it has no entry."""
    shape = [max(1, int(x.max(initial=-1)) + 1) for x in places]
    table = np.full([x + 1 for x in shape], rest, np.float32)  # the last row and column are those of words without a place
    if entries is not None and len(entries[0]):
        at = []
        for side, place, words in zip((source, target), places, entries[:2]):
            order = np.argsort(side.words)
            spot = order[np.searchsorted(side.words, words, sorter=order).clip(0, len(order) - 1)] if len(order) else np.zeros(len(words), np.int64)
            at.append(np.where(side.words[spot] == words, place[spot], -1) if len(order) else np.full(len(words), -1))
        held = (at[0] >= 0) & (at[1] >= 0)
        table[at[0][held], at[1][held]] = entries[column][held]
    return table


def expectation(source: Side, target: Side, entries: Entries | None, once: tuple[np.ndarray, np.ndarray], small: float = 0.0, most_cells: int = 8_000_000) -> pd.DataFrame:
    """Expected counts (s, t, c) of token pairs over the units of a shard; without a known table all pairs are alike.

    Rows with NONE for t or s hold the whole count of a source or a target token. A pair whose count is below the share
    ``small`` of both its tokens' counts is left to these; added over all shards, what is left out of a pair is below
    that share of its tokens' whole counts, whatever the shards are. The words ``once``, which no other unit has, can
    tell nothing about another unit and give no counts."""
    learns = tuple(~np.isin(side.words, x) for side, x in zip((source, target), once))
    out = []
    for own, sp, tp in parts(source, target, learns, most_cells):
        table = matrix(source, target, (sp, tp), entries, 2, 1.0 if entries is None else 1e-6)[:-1, :-1]
        counts = np.zeros(table.size, np.float32)
        for k in own:
            sides = []
            for side, place in ((source, sp), (target, tp)):
                ids, lengths = side.unit(k)
                where, sentence = place[ids], np.repeat((np.arange(len(lengths)) + 0.5) / max(1, len(lengths)), lengths)
                held = where >= 0
                sides.append((where[held], sentence[held].astype(np.float32)))
            (a, at), (b, bt) = sides
            if not len(a) or not len(b):
                continue
            # sentences in like positions are likelier to correspond; 0.02 is the null word
            p = np.exp(-3.0 * np.abs(at[:, None] - bt[None, :])) * table[a[:, None], b[None, :]]
            p /= p.sum(0, keepdims=True) + 0.02
            np.add.at(counts, (a[:, None] * table.shape[1] + b[None, :]).ravel(), p.ravel())
        counts = counts.reshape(table.shape)
        del table
        of_s, of_t = counts.sum(1, dtype=np.float64), counts.sum(0, dtype=np.float64)
        words_s, words_t = (side.words[np.argsort(np.where(place < 0, len(place), place), kind="stable")[: int(place.max(initial=-1)) + 1]] for side, place in ((source, sp), (target, tp)))
        if not len(words_s) or not len(words_t):
            continue
        low = (small * of_t).astype(np.float32)
        for at in range(0, len(words_s), 256):
            rows = counts[at : at + 256]
            s, t = np.nonzero((rows > 0) & (rows >= np.minimum((small * of_s[at : at + 256]).astype(np.float32)[:, None], low[None, :])))
            out.append((words_s[at + s], words_t[t], rows[s, t]))
        none = np.full(max(len(words_s), len(words_t)), NONE)
        out += [(words_s, none[: len(words_s)], of_s), (none[: len(words_t)], words_t, of_t)]
    s, t, c = (np.concatenate(x) for x in zip(*out)) if out else (np.array([], np.int64),) * 3
    return pd.DataFrame({"s": s, "t": t, "c": c.astype(float)})


def entries_of(dealt: pd.DataFrame) -> Entries:
    """The dealt rows (side, word, others, ps, bs) as entries."""
    if not len(dealt):
        none = np.array([], np.int64)
        return none, none, np.array([], np.float32), np.array([], np.float32)
    others, p, b = (np.concatenate([np.asarray(x) for x in dealt[name]]) for name in ("others", "ps", "bs"))
    sizes = dealt["others"].map(len).to_numpy()
    words, of_source = np.repeat(dealt["word"].to_numpy(np.int64), sizes), np.repeat(dealt["side"].to_numpy() == 0, sizes)
    return np.where(of_source, words, others), np.where(of_source, others, words), p, b


def per_shard(shards: DataFrame, table: DataFrame | None, step, schema: str) -> DataFrame:
    """Applies step(row of a shard, entries) to all shards; a shard gets of its pair's table what its words name.

    An entry goes along with the token of which it is a large share, so that a token brings no more entries than there
    are such shares, however frequent it is."""
    if table is None:

        def alone(frames):
            for frame in frames:
                for row in frame.itertuples():
                    found = step(row, None)
                    for at in range(0, len(found), 50_000):
                        yield found.iloc[at : at + 50_000]

        return shards.mapInPandas(alone, schema)
    words = F.array_except("s_words", "once_s"), F.array_except("t_words", "once_t")
    named = [shards.select(F.col("pair").alias("of_pair"), F.col("shard").alias("of_shard"), F.lit(k).alias("of_side"), F.explode(own).alias("of_word")) for k, own in enumerate(words)]
    own = named[0].unionByName(named[1])
    dealt = table.join(own, (F.col("pair") == F.col("of_pair")) & (F.col("side") == F.col("of_side")) & (F.col("word") == F.col("of_word"))).select("of_pair", "of_shard", "side", "word", "others", "ps", "bs")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = [step(row, entries_of(right)) for row in left.itertuples()]
        return found[0] if found else pd.DataFrame({x.split()[0]: [] for x in schema.split(", ")})

    return shards.groupBy("pair", "shard").cogroup(dealt.groupBy("of_pair", "of_shard")).applyInPandas(run, schema)


def train(shards: DataFrame, rounds: int = 4, floor: float = 0.01) -> DataFrame:
    """Translation tables of all language pairs, estimated on the shards: rows (pair, side, word, others, ps, bs).

    p is the share of the source token's counts, b that of the target token's, both of the counts of all shards. Entries
    with both below ``floor`` say no more than the smoothing that stands for them and are left out. The shards together
    keep back less than half the floor of each share, so that in a round no entry of one and a half floors is missing,
    and none is more than half a floor too low. An entry is listed with its source token (side 0) where p reaches the
    floor, else with its target token (side 1): at most 1 / floor with each."""
    ensure_checkpoint_dir(shards.sparkSession)
    table, small = None, floor / 2

    def step(row, entries: Entries | None) -> pd.DataFrame:
        once = np.asarray(row.once_s, np.int64), np.asarray(row.once_t, np.int64)
        found = expectation(Side.of(row, "s"), Side.of(row, "t"), entries, once, small)
        found.insert(0, "pair", row.pair)
        return found

    for _ in range(rounds):
        expected = per_shard(shards, table, step, "pair string, s bigint, t bigint, c double")
        counts = expected.groupBy("pair", "s", "t").agg(F.sum("c").cast("float").alias("c")).checkpoint()
        by_s = counts.where(F.col("t") == NONE).select("pair", "s", F.col("c").alias("of_s"))
        by_t = counts.where(F.col("s") == NONE).select("pair", "t", F.col("c").alias("of_t"))
        p, b = F.col("c") / (F.col("of_s") + 0.5), F.col("c") / (F.col("of_t") + 0.5)
        shares = counts.where((F.col("s") != NONE) & (F.col("t") != NONE)).join(by_s, ["pair", "s"]).join(by_t, ["pair", "t"]).select("pair", "s", "t", p.cast("float").alias("p"), b.cast("float").alias("b"))
        own = F.col("p") >= floor
        kept = shares.where(own | (F.col("b") >= floor)).select("pair", F.when(own, 0).otherwise(1).alias("side"), F.when(own, F.col("s")).otherwise(F.col("t")).alias("word"), F.struct(F.when(own, F.col("t")).otherwise(F.col("s")).alias("o"), "p", "b").alias("e"))
        lists = kept.groupBy("pair", "side", "word").agg(F.collect_list("e").alias("e"))
        table = lists.select("pair", "side", "word", F.col("e.o").alias("others"), F.col("e.p").alias("ps"), F.col("e.b").alias("bs")).checkpoint()
    return table


def link(n: int, m: int, fore: np.ndarray, back: np.ndarray, ws: list[np.ndarray], wt: list[np.ndarray], fores: list[np.ndarray], backs: list[np.ndarray], least: float = 0.3, more: float = 0.5, share: float = 0.4) -> list[tuple[int, int, float]]:
    """Competitive linking: the best free pair anywhere first; then pairs that merge or split an already linked sentence, if the tokens that are left over speak for it.

    fore and back: how much of a source (target) sentence the other one explains. fores[i][x, j] and backs[j][y, i]: the
    same of each token, with the weights ws[i] and wt[j]."""
    score = 0.5 * (fore + back) - 0.06 * np.abs((np.arange(n)[:, None] + 0.5) / n - (np.arange(m)[None, :] + 0.5) / m)
    order = [divmod(k, m) for k in np.argsort(-score.ravel(), kind="stable").tolist()]
    free_i, free_j, links = set(range(n)), set(range(m)), []
    for i, j in order:
        if score[i, j] < least:
            break
        if i in free_i and j in free_j:
            free_i.discard(i)
            free_j.discard(j)
            links.append((i, j, float(score[i, j])))
    # A free sentence joins a linked one if it is explained by it, and explains tokens of it better than the first
    # partner does: a merged sentence brings its own tokens, a split-off piece leaves them unexplained.
    for i, j in order:
        if (i in free_i) == (j in free_j):
            continue
        if i in free_i:  # source sentence i, merged into the linked target j
            own, small, weight = fore[i, j], backs[j][:, i], wt[j]
            first = backs[j][:, [k for k, q, _ in links if q == j]].max(1)
        else:  # target sentence j, split off the linked source i
            own, small, weight = back[i, j], fores[i][:, j], ws[i]
            first = fores[i][:, [q for k, q, _ in links if k == i]].max(1)
        held = float(weight @ small)
        fresh = float(weight @ np.maximum(small - first, 0))
        if own >= more and held > 0 and fresh >= share * held and fresh >= 0.08 * weight.sum():
            links.append((i, j, float(own)))
            free_i.discard(i)
            free_j.discard(j)
    return sorted(links)


def linked(source: Side, target: Side, k: int, places: tuple[np.ndarray, np.ndarray], tables: tuple[np.ndarray, np.ndarray], known: tuple[np.ndarray, np.ndarray]) -> list[tuple[int, int, float]]:
    """Links (source sentence, target sentence, score) of a unit; tables hold p and b of the words that have a place."""
    a, na = source.unit(k)
    b, nb = target.unit(k)
    n, m = len(na), len(nb)
    if not len(a) or not len(b):
        return []
    pa, pb = places[0][a], places[1][b]
    p, q = (x[pa[:, None], pb[None, :]] for x in tables)
    wa, wb = source.words[a], target.words[b]
    same = wa[:, None] == wb[None, :]
    strong = same & (wa & STRONG_BIT).astype(bool)[:, None]
    of_a, of_b = np.repeat(np.arange(n), na), np.repeat(np.arange(m), nb)
    to_a, to_b = np.eye(n, dtype=np.float32)[of_a], np.eye(m, dtype=np.float32)[of_b]  # token to sentence
    # of each token the share of its counts that fall on words of a sentence; what stands there unchanged counts whole
    f = np.where(strong @ to_b > 0, 1.0, np.minimum(1.0, p @ to_b))
    g = np.where(strong.T @ to_a > 0, 1.0, np.minimum(1.0, q.T @ to_a))

    def weights(words: np.ndarray, count: int, found: np.ndarray, known_words: np.ndarray) -> np.ndarray:
        # tokens in most sentences of a unit can't tell them apart (each is once in a sentence); those that the table
        # doesn't know and the other side doesn't have weigh little: names that occur once
        _, at, often = np.unique(words, return_inverse=True, return_counts=True)
        return np.log1p(count / often[at]) * np.where(known_words | found, 1.0, 0.25)

    w, v = weights(wa, n, same.any(1), known[0][a]), weights(wb, m, same.any(0), known[1][b])
    fore = (to_a.T @ (w[:, None] * f)) / np.maximum(1e-9, to_a.T @ w)[:, None]
    back = ((to_b.T @ (v[:, None] * g)) / np.maximum(1e-9, to_b.T @ v)[:, None]).T
    cut_a, cut_b = np.cumsum(na)[:-1], np.cumsum(nb)[:-1]
    return link(n, m, fore, back, np.split(w, cut_a), np.split(v, cut_b), np.split(f, cut_a), np.split(g, cut_b))


SHARD = "pair string, shard int, file_ids array<bigint>, unit_ids array<int>, s_words array<bigint>, s_ids array<int>, s_lengths array<int>, s_sentences array<int>, s_units array<int>, t_words array<bigint>, t_ids array<int>, t_lengths array<int>, t_sentences array<int>, t_units array<int>, spans array<array<int>>"


def packed(pair: str, shard: int, file_ids: list[int], unit_ids: list[int], units: list[tuple[list[list[str]], list[list[int]], list[list[str]]]]) -> tuple:
    """The units (tokens of the source sentences, spans of each, tokens of the target sentences) of a shard as one row of SHARD."""
    sides = []
    for which in (0, 2):
        places: dict[int, int] = {}
        ids, lengths, counts, held = [], [], [], []
        for unit in units:
            seen = set()
            for sentence in unit[which]:
                lengths.append(len(sentence))
                for x in map(word_id, sentence):
                    at = places.setdefault(x, len(places))
                    ids.append(at)
                    seen.add(at)
            counts.append(len(unit[which]))
            held += [0] * (len(places) - len(held))
            for at in seen:
                held[at] += 1
        sides += [list(places), ids, lengths, counts, held]
    return (pair, shard, file_ids, unit_ids, *sides, [[int(x) for x in own] for unit in units for own in unit[1]])


def as_shard(frame: pd.DataFrame) -> pd.DataFrame:
    """The units (pair, shard, file_id, unit_id, spans, text) of a shard, tokenised."""
    units = []
    for row in frame.itertuples():
        source = source_sentences(list(row.spans))
        units.append(([tokens(x) for x, _ in source], [own for _, own in source], [tokens(row.text[b:e]) for b, e in sentences(row.text)]))
    row = packed(frame["pair"].iloc[0], int(frame["shard"].iloc[0]), frame["file_id"].tolist(), frame["unit_id"].tolist(), units)
    return pd.DataFrame([row], columns=[x.split()[0] for x in SHARD.split(", ")])


def with_once(shards: DataFrame) -> DataFrame:
    """Adds once_s and once_t: the words of a shard that no other unit of the language pair has, counted over all shards."""
    for side in "st":
        words = shards.select("pair", "shard", F.explode(F.arrays_zip(f"{side}_words", f"{side}_units")).alias("w")).select("pair", "shard", F.col("w")[f"{side}_words"].alias("word"), F.col("w")[f"{side}_units"].alias("n"))
        rare = words.groupBy("pair", "word").agg(F.sum("n").alias("n"), F.min("shard").alias("shard")).where(F.col("n") == 1)
        once = rare.groupBy("pair", "shard").agg(F.collect_list("word").alias(f"once_{side}"))
        shards = shards.join(once, ["pair", "shard"], "left").withColumn(f"once_{side}", F.coalesce(f"once_{side}", F.array().cast("array<bigint>")))
    return shards.drop("s_units", "t_units")


def bitext(units: DataFrame, translations: DataFrame, shard_units: int = 1000) -> DataFrame:
    """The units that have a translation, tokenised: one row of SHARD per shard, and the words (once_s, once_t) of it that no other unit of the language pair has."""
    own = translations.where((F.length("text") > 0) & F.col("target_lang").isNotNull()).groupBy("file_id", "unit_id").agg(
        F.max_by(F.struct("source_lang", "detected_source_lang", "target_lang", "text"), F.struct("requested_at", "translation_id")).alias("t")
    )
    few = F.transform("spans", lambda s: F.struct(s["id"].alias("id"), s["dash_index"].alias("dash_index"), s["text"].alias("text")))
    one = units.where(F.size("spans") > 0).groupBy("file_id", "unit_id").agg(F.max_by(few, F.coalesce(F.col("chapter_id"), F.lit(0))).alias("spans"))
    both = own.join(one, ["file_id", "unit_id"]).select("file_id", "unit_id", F.col("t.text").alias("text"), "spans", F.coalesce("t.source_lang", "t.detected_source_lang").alias("given"), F.col("t.target_lang").alias("to"))
    # a unit of unknown source language is of its file's
    file_lang = both.where(F.col("given").isNotNull()).groupBy("file_id").agg(F.mode("given").alias("usual"))
    both = both.join(file_lang, "file_id", "left").withColumn("pair", F.concat_ws("-", F.coalesce("given", "usual", F.lit("und")), "to")).drop("given", "usual", "to").checkpoint()
    # a pair of languages may hold most units: it is spread over as many shards as its units need
    sizes = both.groupBy("pair").agg(F.ceil(F.count("*") / shard_units).cast("int").alias("shards"))
    dealt = both.join(F.broadcast(sizes), "pair").withColumn("shard", F.pmod(F.xxhash64("file_id", "unit_id"), F.col("shards")).cast("int"))
    shards = dealt.select("pair", "shard", "file_id", "unit_id", "spans", "text").groupBy("pair", "shard").applyInPandas(as_shard, SHARD).checkpoint()
    return with_once(shards)


def aligned_sentences(units: DataFrame, translations: DataFrame, rounds: int = 4, shard_units: int = 1000) -> DataFrame:
    """Linked sentences: file_id, unit_id, source_no, sent_no, spans of the source sentence, score."""
    ensure_checkpoint_dir(units.sparkSession)
    shards = bitext(units, translations, shard_units).checkpoint()
    table = train(shards, rounds)

    def align(row, entries: Entries) -> pd.DataFrame:
        source, target = Side.of(row, "s"), Side.of(row, "t")
        known = np.isin(source.words, entries[0]), np.isin(target.words, entries[1])
        out = []
        for own, sp, tp in parts(source, target, known, 8_000_000):
            tables = tuple(matrix(source, target, (sp, tp), entries, column, 0.0) for column in (2, 3))
            for k in own:
                for i, j, score in linked(source, target, k, (sp, tp), tables, known):
                    out.append((row.file_ids[k], row.unit_ids[k], i + 1, j + 1, [int(x) for x in row.spans[int(source.first[k]) + i]], score))
        return pd.DataFrame(out, columns=["file_id", "unit_id", "source_no", "sent_no", "spans", "score"])

    return per_shard(shards, table, align, "file_id bigint, unit_id int, source_no int, sent_no int, spans array<int>, score double")


def aligned_spans(units: DataFrame, translations: DataFrame, rounds: int = 4) -> DataFrame:
    """(file_id, unit_id, span_id, sent_no) of each span and each target sentence that renders a source sentence of which the span holds a piece."""
    found = aligned_sentences(units, translations, rounds)
    return found.select("file_id", "unit_id", F.explode("spans").alias("span_id"), "sent_no").distinct()

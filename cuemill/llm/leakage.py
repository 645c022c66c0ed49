"""Passages of held-out test items in a corpus.

Each shard of the corpus gets an FM-index over its token sequence: suffix array by prefix doubling, Burrows-Wheeler
transform in a wavelet matrix, and every ``rate``-th suffix position sampled. The phrases of the items (windows of
words, or of characters in scripts without spaces) are searched backward, all at once; their occurrences are located
by walking to sampled positions. Occurrences of an item that lie together in a document name a candidate; an
alignment of the item with that passage then measures which share of the item's words stands there in order, and the
spans to remove are merged.

The items are the query set: they are broadcast after a check of their size (``most_item_chars``), which a test suite
has and a corpus has not; more items are searched in several passes. Tokens that no item has share one symbol, so the
index alphabet is bounded by the items.

Defined results: null and empty texts hold nothing; repeated documents each count; an item that occurs twice in a
document gives one row with all spans; ties cannot change the set of rows; very long texts are indexed whole; a shard
never exceeds its rows' text; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread

#: Words, or single characters of scripts that are written without spaces.
TOKEN = re.compile(r"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]|[^\W_\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]+")
SPACELESS = re.compile(r"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]")
MARKS = re.compile(r"[\u0300-\u036f]+")
#: Numbers and time lines of caption blocks, cue markers, and tags stand between words without being any.
NOISE = re.compile(r"(?m)^[ \t]*\d+[ \t]*\r?\n(?=[ \t]*\d{1,3}:\d\d:\d\d[,.]\d+[ \t]*-->)|^[ \t]*\d{1,3}:\d\d:\d\d[,.]\d+[ \t]*-->[^\n]*$|⟦[^⟧\n]{0,12}⟧|</?[a-zA-Z][^<>\n]{0,40}>|\{\\[^{}\n]{0,40}\}")
END, OTHER, FIRST = 0, 1, 2


def normal(word: str) -> str:
    word = word.lower()
    return word if word.isascii() else MARKS.sub("", unicodedata.normalize("NFKD", word))


def blank(m: re.Match) -> str:
    return " " * len(m.group())


def tokens(text: str | None) -> list[str]:
    return [normal(x) for x in TOKEN.findall(NOISE.sub(blank, text or ""))]


def token_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in TOKEN.finditer(NOISE.sub(blank, text))]


class FMIndex:
    """Backward search and location in a sequence of symbols below ``sigma``; symbol 0 ends the sequence and occurs once."""

    def __init__(self, sequence: np.ndarray, sigma: int, rate: int = 16):
        self.n, self.rate = len(sequence), rate
        suffixes = suffix_array(sequence)
        last = sequence[suffixes - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(sequence, minlength=sigma))]).astype(np.int64)
        self.bits = max(1, int(sigma - 1).bit_length())
        self.ranks, self.zeros, self.planes = [], [], []
        level = last.astype(np.int64)
        for b in range(self.bits - 1, -1, -1):
            plane = (level >> b) & 1
            ones = np.concatenate([[0], np.cumsum(plane)]).astype(np.int32)
            self.ranks.append(ones)
            self.planes.append(plane.astype(bool))
            self.zeros.append(int(self.n - ones[-1]))
            level = np.concatenate([level[plane == 0], level[plane == 1]])
        sampled = suffixes % rate == 0
        self.sampled = sampled
        self.sample_rank = np.concatenate([[0], np.cumsum(sampled)]).astype(np.int32)
        self.samples = suffixes[sampled].astype(np.int32)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position of the transform."""
        begin, end = np.zeros_like(at), at.copy()
        for k in range(self.bits):
            one = ((symbol >> (self.bits - 1 - k)) & 1).astype(bool)
            rb, re_ = self.ranks[k][begin], self.ranks[k][end]
            begin = np.where(one, self.zeros[k] + rb, begin - rb)
            end = np.where(one, self.zeros[k] + re_, end - re_)
        return end - begin

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The transform's symbol at each position, and how often it occurs before."""
        symbol, begin, here = np.zeros_like(at), np.zeros_like(at), at.copy()
        for k in range(self.bits):
            one = self.planes[k][here]
            rb, rh = self.ranks[k][begin], self.ranks[k][here]
            symbol = symbol * 2 + one
            begin = np.where(one, self.zeros[k] + rb, begin - rb)
            here = np.where(one, self.zeros[k] + rh, here - rh)
        return symbol, here - begin

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals [begin, end) of the phrases, one per row; unused leading places of a row are -1."""
        begin, end = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for k in range(phrases.shape[1] - 1, -1, -1):
            live = np.flatnonzero((phrases[:, k] >= 0) & (begin < end))
            c = phrases[live, k]
            begin[live] = self.first[c] + self.rank(c, begin[live])
            end[live] = self.first[c] + self.rank(c, end[live])
        return begin, np.maximum(begin, end)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the sequence of the suffixes at the given rows."""
        out, at = np.zeros(len(rows), np.int64), rows.astype(np.int64)
        live, steps = np.arange(len(rows)), 0
        while len(live):
            hit = self.sampled[at[live]]
            done = live[hit]
            out[done] = self.samples[self.sample_rank[at[done]]] + steps
            live = live[~hit]
            symbol, before = self.symbol_and_rank(at[live])
            at[live] = self.first[symbol] + before
            steps += 1
        return out


def suffix_array(sequence: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by prefix doubling; past the end counts as less than any symbol."""
    n = len(sequence)
    rank, width = sequence.astype(np.int64), 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:-width] = rank[width:] + 1 if width < n else 0
        keys = rank * (int(rank.max()) + 2) + ahead
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        fresh = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        width *= 2
        if width >= n:
            return order


@dataclass
class Items:
    """The items as token ids, and their phrases."""

    words: int
    chars: int
    vocabulary: dict[str, int] = field(default_factory=dict)
    ids: list = field(default_factory=list)
    texts: list[np.ndarray] = field(default_factory=list)
    phrases: np.ndarray | None = None
    postings: list[list[tuple[int, int]]] = field(default_factory=list)
    anchors: list[np.ndarray] = field(default_factory=list)
    sigma: int = FIRST

    @staticmethod
    def build(rows: list[tuple[object, str]], words: int = 4, chars: int = 7) -> Items:
        self = Items(words, chars)
        places: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for key, text in rows:
            own = tokens(text)
            if not own:
                continue
            ids = np.array([self.vocabulary.setdefault(x, FIRST + len(self.vocabulary)) for x in own], np.int64)
            spaceless = sum(1 for x in own if SPACELESS.match(x)) > len(own) / 2
            width = min(chars if spaceless else words, len(ids))
            for at in range(len(ids) - width + 1):
                places.setdefault(tuple(ids[at : at + width].tolist()), []).append((len(self.ids), at))
            self.ids.append(key)
            self.texts.append(ids)
        self.sigma = FIRST + len(self.vocabulary)
        # an item is sought by the rarer half of its phrases, so that wording common among the items starts no candidate
        spread_of = {p: len({i for i, _ in own}) for p, own in places.items()}
        of_item: list[list[int]] = [[] for _ in self.ids]
        for p, own in places.items():
            for i, _ in own:
                of_item[i].append(spread_of[p])
        limit = [float(np.median(x)) if x else 0.0 for x in of_item]
        chosen = {p: [(i, at) for i, at in own if spread_of[p] <= limit[i]] for p, own in places.items()}
        chosen = {p: own for p, own in chosen.items() if own}
        widest = max(words, chars)
        self.phrases = np.full((len(chosen), widest), -1, np.int64)
        for k, (p, own) in enumerate(chosen.items()):
            self.phrases[k, widest - len(p) :] = p
            self.postings.append(own)
        places_of: list[list[int]] = [[] for _ in self.ids]
        for own in self.postings:
            for i, at in own:
                places_of[i].append(at)
        self.anchors = [np.array(sorted(x), np.int64) for x in places_of]
        return self


def covered(item: np.ndarray, passage: np.ndarray, run: int) -> list[tuple[int, int, int]]:
    """Blocks (item position, passage position, length) of at least ``run`` equal tokens, in order on both sides, that cover the most of the item."""
    where: dict[int, list[int]] = {}
    for j, x in enumerate(passage.tolist()):
        where.setdefault(x, []).append(j)
    blocks, open_ = [], {}
    for i, x in enumerate(item.tolist()):
        now = {}
        for j in where.get(x, ()):
            now[j] = open_.get(j - 1, 0) + 1
        for j, n in open_.items():
            if j + 1 not in now and n >= run:
                blocks.append((i - n, j - n + 1, n))
        open_ = now
    blocks += [(len(item) - n, j - n + 1, n) for j, n in open_.items() if n >= run]
    blocks.sort()
    best: list[tuple[int, int]] = []
    for k, (i, j, n) in enumerate(blocks):
        top, before = n, -1
        for q in range(k):
            qi, qj, qn = blocks[q]
            if qi < i and qj < j:
                overlap = max(0, qi + qn - i, qj + qn - j)
                if n - overlap > 0 and best[q][0] + n - overlap > top:
                    top, before = best[q][0] + n - overlap, q
        best.append((top, before))
    if not best:
        return []
    k = max(range(len(best)), key=lambda q: best[q][0])
    chain = []
    while k >= 0:
        chain.append(blocks[k])
        k = best[k][1]
    return chain[::-1]


def block_cover(chain: list[tuple[int, int, int]]) -> int:
    total, end_i, end_j = 0, 0, 0
    for i, j, n in chain:
        overlap = max(0, end_i - i, end_j - j)
        total += max(0, n - overlap)
        end_i, end_j = max(end_i, i + n), max(end_j, j + n)
    return total


def search_shard(keys: list, texts: list[str], items: Items, share: float, least: int, run_words: int, run_chars: int, rare: float = 0.32) -> list[tuple]:
    """Rows (key, item, share, [(begin, end)]) of the shard's texts that hold more than ``share`` of an item."""
    lookup, parts, starts, at = items.vocabulary, [], [], 0
    for text in texts:
        own = [lookup.get(x, OTHER) for x in tokens(text)]
        starts.append(at)
        parts.append(np.array([*own, OTHER], np.int64))
        at += len(own) + 1
    if not parts or items.phrases is None or not len(items.phrases):
        return []
    sequence = np.concatenate([*parts, np.array([END])])
    index = FMIndex(sequence, items.sigma)
    begin, end = index.search(items.phrases)
    counts = end - begin
    phrase = np.repeat(np.arange(len(counts)), counts)
    rows = np.repeat(begin - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(int(counts.sum()))
    places = index.locate(rows)
    documents = np.searchsorted(np.array(starts), places, "right") - 1
    hits: dict[tuple[int, int], list[int]] = {}
    for p, place, doc in zip(phrase.tolist(), places.tolist(), documents.tolist()):
        for item, offset in items.postings[p]:
            hits.setdefault((doc, item), []).append((place - offset, offset))
    found = []
    for (doc, item), own_hits in hits.items():
        enough = min(least, len(items.anchors[item]))  # a short item has fewer phrases
        if len(own_hits) < enough:
            continue
        own = items.texts[item]
        n = len(own)
        spaceless = items.phrases.shape[1] and n and SPACELESS.match(items_token(items, int(own[0]))) is not None
        run = run_chars if spaceless else run_words
        own_hits.sort()
        diagonals = [x for x, _ in own_hits]
        slack = n // 2 + 12
        k, spans = 0, []
        while k < len(diagonals):
            last = k
            while last + 1 < len(diagonals) and diagonals[last + 1] - diagonals[last] <= slack:
                last += 1
            if last - k + 1 >= enough:
                low = max(starts[doc], diagonals[k] - slack)
                high = min(starts[doc] + len(parts[doc]) - 1, diagonals[last] + n + slack)
                chain = covered(own, sequence[low:high], run)
                if block_cover(chain) > share * n and distinct(items.anchors[item], {o for _, o in own_hits[k : last + 1]}, chain) >= rare:
                    spans.append((low - starts[doc] + chain[0][1], low - starts[doc] + chain[-1][1] + chain[-1][2], block_cover(chain) / n))
            k = last + 1
        if spans:
            offsets = token_spans(texts[doc])
            merged: list[list[int]] = []
            for b, e, _ in sorted(spans):
                b, e = offsets[b][0], offsets[e - 1][1]
                if merged and b <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([b, e])
            found.append((keys[doc], items.ids[item], max(s for *_, s in spans), merged))
    return found


def distinct(anchors: np.ndarray, hit: set[int], chain: list[tuple[int, int, int]]) -> float:
    """Of the item's rare phrases within the part that the passage spans, the share that the passage has word for word: shared common wording has few of them."""
    low, high = chain[0][0], chain[-1][0] + chain[-1][2]
    inside = anchors[(anchors >= low) & (anchors < high)].tolist()
    return sum(1 for x in inside if x in hit) / len(inside) if inside else 1.0


def items_token(items: Items, symbol: int) -> str:
    if not hasattr(items, "_names"):
        items._names = {v: k for k, v in items.vocabulary.items()}
    return items._names.get(symbol, "")


def leaks(documents: DataFrame, evaluation: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", share: float = 0.5, least: int = 3, run_words: int = 2, run_chars: int = 3, shard_chars: int = 2_000_000, most_item_chars: int = 20_000_000) -> DataFrame:
    """One row per document and item that leaked: share of the item's words, and the spans (code points) to remove."""
    size = evaluation.agg(F.sum(F.length(item_text))).first()[0] or 0
    if size > most_item_chars:
        # as many passes as the size needs; an item goes whole into one, however long it is
        passes = -(-size // most_item_chars)
        parts = [evaluation.where(F.pmod(F.xxhash64(item_key), F.lit(passes)) == k) for k in range(passes)]
        return reduce(DataFrame.unionByName, [leaks(documents, part, key, text, item_key, item_text, share, least, run_words, run_chars, shard_chars, size) for part in parts])
    rows = evaluation.where(F.length(item_text) > 0).select(item_key, item_text).orderBy(item_key).collect()
    items = documents.sparkSession.sparkContext.broadcast(Items.build([(r[0], r[1]) for r in rows]))

    def search(frames):
        keys, texts, size = [], [], 0
        for frame in frames:
            for k, t in zip(frame["k"].tolist(), frame["t"].tolist()):
                keys.append(k)
                texts.append(t)
                size += len(t)
                if size >= shard_chars:
                    yield as_frame(search_shard(keys, texts, items.value, share, least, run_words, run_chars))
                    keys, texts, size = [], [], 0
        yield as_frame(search_shard(keys, texts, items.value, share, least, run_words, run_chars))

    def as_frame(found):
        return pd.DataFrame([(k, i, s, [{"begin": b, "end": e} for b, e in spans]) for k, i, s, spans in found], columns=["k", "i", "share", "spans"])

    kinds = documents.schema[key].dataType.simpleString(), evaluation.schema[item_key].dataType.simpleString()
    own = spread(documents.where(F.length(text) > 0).select(F.col(key).alias("k"), F.col(text).alias("t")))
    found = own.mapInPandas(search, f"k {kinds[0]}, i {kinds[1]}, share double, spans array<struct<begin:int,end:int>>")
    return found.select(F.col("k").alias(key), F.col("i").alias(item_key), "share", "spans")


def removal_spans(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Of each document the merged, ordered spans to cut, over all items (a document's spans are as few as its leaks)."""
    one = found.select(key, F.explode("spans").alias("s")).select(key, "s.begin", "s.end")
    merged = F.aggregate(
        F.array_sort(F.collect_list(F.struct("begin", "end"))),
        F.array().cast("array<struct<begin:int,end:int>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["begin"] <= F.element_at(acc, -1)["end"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(F.element_at(acc, -1)["begin"].alias("begin"), F.greatest(s["end"], F.element_at(acc, -1)["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(s))),
    )
    return one.groupBy(key).agg(merged.alias("spans"))

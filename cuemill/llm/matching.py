"""Same film in two tables that share no key.

Sorted neighbourhood: every record gets several composite sort keys, records of both tables are sorted by (kind of key,
key), and a window slides over the order; records in a window are compared by weighted similarities of title, original
title, year, director and running time. The confident pairs then go through an assignment that maximises the total
confidence: a subject has one film, a film at most ``slots`` subjects.

Records of equal fields are one class and are dealt to each other's copies at the end, so that copies need no window.
The order is cut into blocks of positions and each block carries the last rows of the block before it, so that no task
holds more than a block however often a key occurs; keys end in the other fields, so that equal titles are sorted by
what tells them apart. A title of more records than a window holds is sorted by each of the other fields in turn.

Defined results: rows without any title give no match; repeated rows count once (the latest holds); a null field is
neither for nor against; ties in confidence go to the smaller ids; extra columns are ignored; an empty table on either
side gives an empty result.
"""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
from collections import deque
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ensure_checkpoint_dir

#: What catalogue pages put around a title.
PAGE_NOISE = re.compile(r"\s*[-–|｜]\s*(?:电影|電影|豆瓣|影评)\s*|\(豆瓣\)|《|》")
YEAR_NOTE = re.compile(r"[\[(（]\s*(?:19|20)\d\d\s*[\])）]")
FORM_NOTE = re.compile(r"\(\s*(?:film|movie|tv|series|电影)\s*\)", re.I)
#: How a title says that it is a later part.
PART = re.compile(r"(?:[\s:：,·-]*(?:part|vol(?:ume)?|chapter|teil|partie|parte)\s+(two|three|four|five|ii|iii|iv|v|[2-9])|(?<=\S)\s+(ii|iii|iv|[2-9])|(?<=[一-鿿])\s*([2-9二三四五]|续集|第[二三四五]部))\s*$", re.I)
PART_NUMBER = {"two": 2, "three": 3, "four": 4, "five": 5, "ii": 2, "iii": 3, "iv": 4, "v": 5, "二": 2, "三": 3, "四": 4, "五": 5, "续集": 2, "第二部": 2, "第三部": 3, "第四部": 4, "第五部": 5}
CJK = re.compile(r"[㐀-鿿]")
STOP = {"a", "an", "the", "of", "and", "in", "to"}


def plain(text: str) -> str:
    text = unicodedata.normalize("NFKD", text.lower())
    text = "".join(c for c in text if not unicodedata.combining(c)).replace("&", " and ").replace("’", "").replace("'", "")
    return " ".join(re.sub(r"[\W_]+", " ", text).split())


def latin_title(text: str | None) -> tuple[str, int]:
    """Plain title and part number (1 where it names none)."""
    if not text:
        return "", 1
    text = FORM_NOTE.sub(" ", text.replace("_", " ")).strip(" .!")
    m = PART.search(text)
    part = 1
    if m:
        own = next(g for g in m.groups() if g).lower()
        part = PART_NUMBER.get(own, int(own) if own.isdigit() else 1)
        text = text[: m.start()]
    return plain(text), part


def chinese_title(text: str | None) -> tuple[str, int, str]:
    """Title without punctuation, part number, and the Latin title that follows it."""
    if not text:
        return "", 1, ""
    text = YEAR_NOTE.sub(" ", PAGE_NOISE.sub(" ", text)).strip()
    m = re.search(r"[A-Za-z][^㐀-鿿]*$", text)
    latin = m.group() if m and CJK.search(text) else ""
    text = text[: m.start()] if latin else text
    text = text.strip()
    m = PART.search(text)
    part = 1
    if m:
        own = next(g for g in m.groups() if g).lower()
        part = PART_NUMBER.get(own, int(own) if own.isdigit() else 1)
        text = text[: m.start()]
    return re.sub(r"[\W_]+", "", text).replace("之", "的"), part, latin


def person(name: str | None) -> tuple[tuple[str, ...], str]:
    """Latin name parts, and the Chinese name."""
    if not name:
        return (), ""
    cjk = "".join(CJK.findall(name))
    return tuple(plain(re.sub(r"[㐀-鿿·・]+", " ", name)).split()), cjk


@lru_cache(200_000)
def edits(a: str, b: str) -> float:
    """Similarity from the edit distance with swaps."""
    if a == b:
        return 1.0
    if not a or not b or min(len(a), len(b)) / max(len(a), len(b)) < 0.4:
        return 0.0
    two, one = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[j - 1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        two, one = one, row
    return 1 - one[-1] / max(len(a), len(b))


@lru_cache(200_000)
def title_similarity(a: str, b: str) -> float:
    """Words are paired in order of their similarity; common words weigh less."""
    if a == b:
        return 1.0
    left, right = a.split(), b.split()
    pairs = sorted(((edits(x, y), i, j) for i, x in enumerate(left) for j, y in enumerate(right)), reverse=True)
    weight = lambda w: 0.25 if w in STOP else 1.0
    used_i, used_j, total = set(), set(), 0.0
    for s, i, j in pairs:
        if s < 0.5:
            break
        if i not in used_i and j not in used_j:
            used_i.add(i)
            used_j.add(j)
            total += s * (weight(left[i]) + weight(right[j]))
    words = total / max(1e-9, sum(map(weight, left)) + sum(map(weight, right)))
    return max(words, edits(a.replace(" ", ""), b.replace(" ", "")))


def person_similarity(a: tuple[tuple[str, ...], str], b: tuple[tuple[str, ...], str]) -> float | None:
    """None where the names can't be compared."""
    if a[0] and b[0]:
        x, y = list(a[0]), list(b[0])
        if len(x) >= 2 and len(y) >= 2 and (min(map(len, x)) == 1 or min(map(len, y)) == 1):
            last = max(edits(p, q) for p in x for q in y if len(p) > 1 and len(q) > 1)
            initials = {p[0] for p in x} & {q[0] for q in y}
            return last * (0.95 if len(initials) >= 1 else 0.6)
        return max(edits(" ".join(sorted(x)), " ".join(sorted(y))), edits("".join(x), "".join(y)), edits("".join(x), "".join(reversed(y))))
    if a[1] and b[1]:
        return edits(a[1], b[1])
    return None


class Record:
    __slots__ = ("key", "latin", "part", "zh", "zh_part", "year", "director", "runtime")

    def __init__(self, row):
        self.key = row.id
        self.zh, self.zh_part, behind = chinese_title(row.title_zh)
        self.latin, self.part = latin_title(row.title_en or behind)
        self.year = None if row.year is None or row.year != row.year else int(row.year)
        self.runtime = None if row.runtime is None or row.runtime != row.runtime else int(row.runtime)
        self.director = person(row.director)


#: The most that equal titles add.
BEST_TITLES = 8.0


def confidence(a: Record, b: Record, least: float = 0.0) -> float:
    """Probability that two records are the same film, from weighted field similarities (log-odds add up); 0 if its log-odds can't reach ``least``."""
    odds = -3.0
    # the cheap fields first: a pair that not even equal titles could save needs no comparison of titles
    if max(a.part, a.zh_part) != max(b.part, b.zh_part):
        odds -= 10.0
    if a.year is not None and b.year is not None:
        gap = abs(a.year - b.year)
        odds += 2.0 if gap == 0 else 1.0 if gap == 1 else -2.5 if gap == 2 else -5.0
    if a.runtime is not None and b.runtime is not None:
        gap = abs(a.runtime - b.runtime)
        odds += 1.5 if gap <= 2 else 0.8 if gap <= 5 else -0.3 if gap <= 12 else -2.5
    if odds + BEST_TITLES + 3.0 < least:
        return 0.0
    s = person_similarity(a.director, b.director)
    if s is not None:
        odds += 3.0 if s > 0.92 else 2.2 if s > 0.75 else 0.0 if s > 0.6 else -4.0
    if odds + BEST_TITLES < least:
        return 0.0
    chinese = edits(a.zh, b.zh) if a.zh and b.zh else 0.0
    if a.latin and b.latin:
        s = title_similarity(a.latin, b.latin)
        # a film may be listed under another title in one of the languages
        odds += 4.5 if s > 0.97 else 3.5 if s > 0.88 else 2.2 if s > 0.78 else 0.5 if s > 0.65 else -1.0 if chinese > 0.9 else -4.0
    if a.zh and b.zh:
        s = chinese
        odds += 3.5 if s > 0.95 else 2.0 if s > 0.8 else 0.0 if s > 0.6 else -0.7
    if not (a.latin and b.latin) and not (a.zh and b.zh):
        odds -= 1.0
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def sort_keys(r: Record) -> list[tuple[int, str]]:
    """Composite sort keys: (kind, key). Each ends with the other fields."""
    year = "" if r.year is None else str(r.year)
    runtime = "" if r.runtime is None else f"{r.runtime // 4:03d}"
    words = [w for w in r.latin.split() if w not in STOP]
    bones = " ".join(sorted(re.sub(r"[aeiou]", "", w) or w for w in words))
    name = " ".join(sorted(r.director[0]))
    longest = max(r.director[0], key=len) if r.director[0] else ""
    out = []
    if words:
        out.append((0, f"{' '.join(words)}|{year}|{name}|{runtime}"))
        out.append((1, f"{bones}|{year}|{name}|{runtime}"))
        out.append((2, f"{' '.join(sorted(words, key=lambda w: (-len(w), w)))}|{year}|{name}|{runtime}"))
    if r.zh:
        out.append((3, f"{r.zh}|{year}|{name}|{runtime}"))
        out.append((4, f"{r.zh[::-1]}|{year}|{name}|{runtime}"))
    if longest:
        out.append((5, f"{longest}|{year}|{name}|{runtime}|{bones}"))
        out.append((6, f"{year}|{longest[0]}|{name}|{runtime}|{bones}"))
    if r.year is not None and r.runtime is not None:
        # neighbouring years and running times: a record stands at its own place, the other table's rows come near it
        out.append((7, f"{year}|{r.runtime:03d}|{name}|{bones}"))
        out.append((8, f"{r.runtime:03d}|{year}|{name}|{bones}"))
    return out


def run_keys(r: Record, side: int) -> list[tuple[int, str, str]]:
    """(kind, title, key) for titles that more records share than a window holds: under the title they are sorted by each other field.

    The left records stand at the years before and after theirs, too."""
    runtime = "" if r.runtime is None else f"{r.runtime:03d}"
    year = "" if r.year is None else str(r.year)
    name = " ".join(sorted(r.director[0]))
    longest = max(r.director[0], key=len) if r.director[0] else ""
    out = []
    for kind, title in ((20, " ".join(w for w in r.latin.split() if w not in STOP)), (30, r.zh)):
        if not title:
            continue
        if longest:
            out.append((kind + 1, title, f"{title}|{longest}|{name}|{year}|{runtime}"))
        if r.director[1]:
            out.append((kind + 2, title, f"{title}|{r.director[1]}|{year}|{runtime}"))
        if runtime:
            out.append((kind + 3, title, f"{title}|{runtime}|{year}|{name}"))
        if year:
            for y in (r.year,) if side else (r.year - 1, r.year, r.year + 1):
                out.append((kind + 4, title, f"{title}|{y}|{runtime}|{name}"))
    return out


FIELDS = "id string, side int, title_en string, title_zh string, year int, director string, runtime int"


def window_pairs(frame: pd.DataFrame, window: int, least: float) -> list[tuple[str, str, float]]:
    """Confident pairs of records of different tables at most ``window`` places apart within the block."""
    held: deque = deque()
    out, records = {}, {}
    for row in frame.itertuples():
        own = records.get((row.side, row.id)) or records.setdefault((row.side, row.id), Record(row))
        while held and row.place - held[0][0] > window:
            held.popleft()
        for _, side, other in held:
            if side != row.side:
                a, b = (own, other) if row.side == 0 else (other, own)
                if (a.key, b.key) not in out:
                    out[a.key, b.key] = confidence(a, b)
        held.append((row.place, row.side, own))
    return [(a, b, c) for (a, b), c in out.items() if c >= least]


def candidates(left: DataFrame, right: DataFrame, window: int = 14, block: int = 2000, least: float = 0.5) -> DataFrame:
    """Pairs (left_id, right_id, confidence) found by the sorted neighbourhood. Both tables have the columns of FIELDS without side."""
    ensure_checkpoint_dir(left.sparkSession)
    both = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)))

    def keyed(frames):
        for frame in frames:
            out = []
            for row in frame.itertuples():
                own = Record(row)
                out += [(*row[1:], kind, None, key) for kind, key in sort_keys(own)]
                out += [(*row[1:], *x) for x in run_keys(own, row.side)]
            yield pd.DataFrame(out, columns=[*frame.columns, "kind", "title", "key"]).astype({"year": "Int32", "runtime": "Int32"})

    rows = both.select("id", "side", "title_en", "title_zh", "year", "director", "runtime").mapInPandas(keyed, f"{FIELDS}, kind int, title string, key string").checkpoint()
    # titles of more records than a window holds
    keyed_by_title = rows.where(F.col("title").isNotNull()).withColumn("of", F.floor(F.col("kind") / 10))
    runs = keyed_by_title.groupBy("of", "title").agg(F.count("*").alias("n")).where(F.col("n") > window).select("of", "title")
    rows = rows.where(F.col("title").isNull()).drop("title").unionByName(keyed_by_title.join(runs, ["of", "title"], "left_semi").drop("of", "title"))
    # the two sides are mixed where keys are equal
    rows = rows.withColumn("_mix", F.xxhash64("id"))
    # the order is written once: a second reading of a range partitioning could cut it elsewhere
    ordered = rows.repartitionByRange("kind", "key", "_mix", "side", "id").sortWithinPartitions("kind", "key", "_mix", "side", "id")
    ordered = ordered.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id() % F.lit(1 << 33)).checkpoint()
    sizes = ordered.groupBy("_part").agg(F.count("*").alias("n"))
    offsets = sizes.withColumn("_before", F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_before")
    placed = ordered.join(F.broadcast(offsets), "_part").withColumn("place", F.col("_before") + F.col("_at")).drop("_part", "_at", "_before", "_mix", "key")
    # a row also goes to the next block if that one's first rows still see it
    blocks = F.array_distinct(F.array(F.floor(F.col("place") / block), F.floor((F.col("place") + window) / block)))
    spread = placed.withColumn("block", F.explode(blocks))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(window_pairs(frame.sort_values("place"), window, least), columns=["left_id", "right_id", "confidence"])

    # comparing takes far longer than its rows' size tells: a task for each few blocks
    tasks = max(1, -(-rows.count() // (4 * block)))
    found = spread.repartition(tasks, "block").groupBy("block").applyInPandas(compare, "left_id string, right_id string, confidence double")
    return found.groupBy("left_id", "right_id").agg(F.max("confidence").alias("confidence"))


def optimal(pairs: list[tuple[str, str, float, int, int]]) -> list[tuple[str, str, float, int]]:
    """(left, right, gain, amount) of the assignment with the highest total gain, from pairs (left, right, gain, room, number).

    A left has room for so many rights, a right stands for a number of equal records, each of which may stay alone (gain
    0). Rights enter one after the other, each along the shortest augmenting path over prices of the lefts and profits
    of the rights (gain = profit + price on used pairs, no more elsewhere). Gains are integers, so that the result
    doesn't depend on the order of additions."""
    lefts, rights = sorted({p[0] for p in pairs}), sorted({p[1] for p in pairs})
    li, ri = {k: i for i, k in enumerate(lefts)}, {k: i for i, k in enumerate(rights)}
    edges: list[dict[int, int]] = [{} for _ in rights]
    room, number, shown = [0] * len(lefts), [0] * len(rights), {}
    for a, b, c, n, m in sorted(pairs):
        edges[ri[b]][li[a]] = round(c * 1_000_000)
        room[li[a]], number[ri[b]], shown[li[a], ri[b]] = n, m, c
    price, profit = [0] * len(lefts), [0] * len(rights)
    used: list[dict[int, int]] = [{} for _ in lefts]  # of each left the amount of each right
    for j in range(len(rights)):
        profit[j] = max(0, max((g - price[i] for i, g in edges[j].items()), default=0))
        waiting = number[j]
        while waiting and profit[j] > 0:
            # nodes: (distance, 0, right) or (distance, 1, left); an end is a left with room, or a right that rather stays alone
            heap, far_r, far_l, from_l, from_r = [(0, 0, j)], {j: 0}, {}, {}, {}
            best, end = profit[j], (0, j)
            while heap:
                d, kind, k = heapq.heappop(heap)
                if d >= best:
                    break
                if kind == 0:
                    if d > far_r[k]:
                        continue
                    if d + profit[k] < best:
                        best, end = d + profit[k], (0, k)
                    for i, g in edges[k].items():
                        far = d + profit[k] + price[i] - g
                        if far < best and far < far_l.get(i, far + 1):
                            far_l[i], from_l[i] = far, k
                            heapq.heappush(heap, (far, 1, i))
                elif d == far_l[k]:
                    if room[k] > 0:
                        best, end = d, (1, k)
                        break
                    for r in used[k]:
                        if d < far_r.get(r, d + 1):
                            far_r[r], from_r[r] = d, k
                            heapq.heappush(heap, (d, 0, r))
            for r, d in far_r.items():
                if d < best:
                    profit[r] -= best - d
            for i, d in far_l.items():
                if d < best:
                    price[i] += best - d
            # along the path each left gives a place of a right to the one before
            path, kind, k = [], *end
            amount = waiting if kind == 0 else min(waiting, room[k])
            while (kind, k) != (0, j):
                if kind == 1:
                    path.append((k, from_l[k], 1))
                    kind, k = 0, from_l[k]
                else:
                    i = from_r[k]
                    amount = min(amount, used[i][k])
                    path.append((i, k, -1))
                    kind, k = 1, i
            if end == (0, j):
                break
            if end[0] == 1:
                room[end[1]] -= amount
            for i, r, sign in path:
                now = used[i].get(r, 0) + sign * amount
                if now:
                    used[i][r] = now
                else:
                    del used[i][r]
            waiting -= amount
    return [(lefts[i], rights[r], shown[i, r], n) for i, own in enumerate(used) for r, n in sorted(own.items())]


def components(pairs: DataFrame) -> DataFrame:
    """Adds ``component``: the smallest label reachable. Labels go along edges and through each other until none changes."""
    edges = pairs.select(F.concat(F.lit("l"), F.col("left_id")).alias("a"), F.concat(F.lit("r"), F.col("right_id")).alias("b"))
    edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).checkpoint()
    labels = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label"))
    while True:
        seen = edges.join(labels.select(F.col("a").alias("b"), F.col("label").alias("other")), "b").groupBy("a").agg(F.min("other").alias("other"))
        stepped = labels.join(seen, "a").select("a", "label", F.least("label", "other").alias("near"))
        jumped = stepped.join(labels.select(F.col("a").alias("near"), F.col("label").alias("far")), "near", "left")
        new = jumped.select("a", F.least("near", F.coalesce("far", "near")).alias("label"), (F.least("near", F.coalesce("far", "near")) != F.col("label")).alias("moved")).checkpoint()
        labels = new.select("a", "label")
        if new.where("moved").limit(1).count() == 0:
            break
    return pairs.withColumn("a", F.concat(F.lit("l"), F.col("left_id"))).join(labels.withColumnRenamed("label", "component"), "a").drop("a")


FLOWS = "left_id string, right_id string, confidence double, amount bigint"


def bidding(pairs: DataFrame, epsilon: float) -> DataFrame:
    """An assignment (FLOWS) of pairs (left_id, right_id, confidence, room, number) by rounds of bids over the whole table.

    Each round all rights that wait bid for their best left as much as it is worth more to them than the second best,
    and ``epsilon``; a left keeps the highest bids for which it has room, the lowest of them being its price once it is
    full. The total is at most epsilon times the number of records below the highest. No group of pairs meets in one
    task: a left has no more rights than the windows of its keys hold."""
    pairs = pairs.checkpoint()
    held = pairs.select("left_id", "right_id", F.lit(0).cast("bigint").alias("amount"), F.lit(0.0).alias("bid")).limit(0)
    room = pairs.groupBy("left_id").agg(F.max("room").alias("room"))
    while True:
        full = held.groupBy("left_id").agg(F.sum("amount").alias("sum"), F.min("bid").alias("low")).join(room, "left_id").where(F.col("sum") >= F.col("room")).select("left_id", "low")
        placed = held.groupBy("right_id").agg(F.sum("amount").alias("placed"))
        open_ = pairs.join(placed, "right_id", "left").withColumn("waits", F.col("number") - F.coalesce("placed", F.lit(0))).where(F.col("waits") > 0)
        valued = open_.join(full, "left_id", "left").withColumn("price", F.coalesce("low", F.lit(0.0))).withColumn("value", F.col("confidence") - F.col("price")).where(F.col("value") > 0)
        best = valued.groupBy("right_id").agg(
            F.max_by(F.struct("left_id", "price", "waits"), F.struct("value", "left_id")).alias("b"), F.max("value").alias("top"), F.sort_array(F.collect_list("value"), asc=False).alias("values")
        )
        second = F.coalesce(F.try_element_at("values", F.lit(2)), F.lit(0.0))
        bids = best.select(F.col("b.left_id").alias("left_id"), "right_id", F.col("b.waits").cast("bigint").alias("amount"), (F.col("b.price") + F.col("top") - second + F.lit(epsilon)).alias("bid")).checkpoint()
        if not bids.limit(1).count():
            break
        order = Window.partitionBy("left_id").orderBy(F.desc("bid"), "right_id")
        all_bids = held.unionByName(bids).join(room, "left_id").withColumn("before", F.sum("amount").over(order.rowsBetween(Window.unboundedPreceding, -1)))
        got = F.least(F.col("amount"), F.col("room") - F.coalesce("before", F.lit(0)))
        held = all_bids.withColumn("amount", got).where(F.col("amount") > 0).select("left_id", "right_id", "amount", "bid").checkpoint()
    flows = held.groupBy("left_id", "right_id").agg(F.sum("amount").alias("amount"))
    return flows.join(pairs, ["left_id", "right_id"]).select("left_id", "right_id", "confidence", "amount")


def assign(pairs: DataFrame, slots: int = 2, most_pairs: int = 200_000, epsilon: float = 0.01) -> DataFrame:
    """FLOWS of the assignment with the highest total confidence, of pairs (left_id, right_id, confidence, copies_l, copies_r).

    Ids stand for so many equal records. Records that are linked are solved together and exactly; where more than
    ``most_pairs`` pairs are linked, they are solved by bids over the table, which come within ``epsilon`` a record of
    the highest total, so that no task holds an unbounded group."""
    ensure_checkpoint_dir(pairs.sparkSession)
    pairs = pairs.select("left_id", "right_id", "confidence", (F.col("copies_l") * slots).alias("room"), F.col("copies_r").alias("number")).checkpoint()

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        rows = list(frame[["left_id", "right_id", "confidence", "room", "number"]].itertuples(index=False, name=None))
        return pd.DataFrame(optimal(rows), columns=["left_id", "right_id", "confidence", "amount"])

    # pairs whose records have no other pair need no assignment
    by_left, by_right = Window.partitionBy("left_id"), Window.partitionBy("right_id")
    counted = pairs.withColumn("_l", F.count("*").over(by_left)).withColumn("_r", F.count("*").over(by_right))
    alone = counted.where((F.col("_l") == 1) & (F.col("_r") == 1)).select("left_id", "right_id", "confidence", F.least("room", "number").cast("bigint").alias("amount"))
    contested = counted.where((F.col("_l") > 1) | (F.col("_r") > 1)).drop("_l", "_r")
    linked = components(contested).checkpoint()
    large = linked.groupBy("component").count().where(F.col("count") > most_pairs).select("component").checkpoint()
    solved = linked.join(large, "component", "left_anti").groupBy("component").applyInPandas(solve, FLOWS)
    whole = alone.unionByName(solved)
    if large.limit(1).count():
        whole = whole.unionByName(bidding(linked.join(large, "component", "left_semi").drop("component"), epsilon))
    return whole


def ranked(members: DataFrame) -> DataFrame:
    """Adds ``rank`` (from 0) of each id within its class. The order is cut by ranges, so that a class of any size is spread over tasks."""
    ordered = members.repartitionByRange("class", "id").sortWithinPartitions("class", "id")
    ordered = ordered.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id() % F.lit(1 << 33)).checkpoint()
    before = ordered.groupBy("_part").agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_before")
    placed = ordered.join(F.broadcast(before), "_part").withColumn("_place", F.col("_before") + F.col("_at"))
    first = placed.groupBy("class").agg(F.min("_place").alias("_first"))
    return placed.join(first, "class").select("class", "id", (F.col("_place") - F.col("_first")).alias("rank"))


def classes(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records of different fields with their number of copies, (class, id, rank) of all records): equal records are one class, named by its smallest id."""
    fields = [c for c in records.columns if c != "id"]
    own = records.groupBy(*fields).agg(F.min("id").alias("class"), F.count("*").alias("copies")).checkpoint()
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in fields]
    copied = own.where("copies > 1")
    members = records.alias("r").join(copied.alias("c"), same).select("c.class", "r.id")
    single = own.where("copies = 1").select("class", F.col("class").alias("id"), F.lit(0).cast("bigint").alias("rank"))
    return own.select(F.col("class").alias("id"), *fields, "copies"), single.unionByName(ranked(members))


def matches(left: DataFrame, right: DataFrame, slots: int = 2, **options) -> DataFrame:
    """Pairs (left_id, right_id, confidence) of the same thing: candidates and assignment of the different records, dealt out to their copies.

    Of equal records any dealing has the same total: the k-th place of a left class and the k-th record of the right
    class go together, and each left record gets a first right one before any gets a second."""
    (lc, lm), (rc, rm) = classes(left), classes(right)
    pairs = candidates(lc.drop("copies"), rc.drop("copies"), **options)
    pairs = pairs.join(lc.select(F.col("id").alias("left_id"), F.col("copies").alias("copies_l")), "left_id").join(rc.select(F.col("id").alias("right_id"), F.col("copies").alias("copies_r")), "right_id")
    flows = assign(pairs, slots).join(lc.select(F.col("id").alias("left_id"), F.col("copies").alias("copies_l")), "left_id").checkpoint()
    upto = lambda key, other: F.sum("amount").over(Window.partitionBy(key).orderBy(other)) - F.col("amount")
    flows = flows.withColumn("of_l", upto("left_id", "right_id")).withColumn("of_r", upto("right_id", "left_id"))
    dealt = rm.withColumnRenamed("id", "own").join(flows.withColumnRenamed("right_id", "class"), "class").where((F.col("rank") >= F.col("of_r")) & (F.col("rank") < F.col("of_r") + F.col("amount")))
    dealt = dealt.select("own", "confidence", F.col("left_id").alias("class"), F.pmod(F.col("of_l") + F.col("rank") - F.col("of_r"), F.col("copies_l")).alias("rank"))
    return dealt.join(lm, ["class", "rank"]).select(F.col("id").alias("left_id"), F.col("own").alias("right_id"), "confidence")


def film_sides(titles: DataFrame, subjects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two tables as records, the latest row of each id."""
    t = titles.where(F.col("tmdb_id").isNotNull()).groupBy("tmdb_id").agg(F.max_by(F.struct("title_en", "title_zh", "year", "director_name", "runtime_min"), F.struct("updated_at", "title_en")).alias("r"))
    s = subjects.where(F.col("douban_id").isNotNull()).groupBy("douban_id").agg(F.max_by(F.struct("title_en", F.col("title").alias("title_zh"), "year", "director_name", "runtime_min"), F.struct("fetched_at", "title")).alias("r"))
    return tuple(
        df.select(F.col(key).cast("string").alias("id"), "r.title_en", "r.title_zh", F.col("r.year").cast("int").alias("year"), F.col("r.director_name").alias("director"), F.col("r.runtime_min").cast("int").alias("runtime"))
        for df, key in ((t, "tmdb_id"), (s, "douban_id"))
    )

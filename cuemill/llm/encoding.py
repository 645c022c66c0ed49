"""Text that was decoded with the wrong character encoding.

A hidden Markov model with one clean state and one state per encoding pair (true encoding, encoding it was read as)
labels the characters. Emissions are character frequencies: of the clean state from all texts of the corpus in which no
strong damage is found, of a pair's state from the same texts put through that pair. A span labelled with a pair gets the pair's inverse
transform, again and again while it helps (text can be damaged twice). An exact check follows: the bytes must decode,
and the restored text must be likelier than the damaged one under a model of clean character pairs.

Defined results: null and empty texts are clean, and so are ASCII texts without lost letters; characters lost for good
(U+FFFD, or question marks in place of letters) are always damage and stay in the restored text; equal texts get equal results; long texts are labelled whole, in pieces that overlap by
nothing but carry the state; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import codecs
import gc
import re
import zlib
from collections import Counter
from collections.abc import Generator, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, ensure_checkpoint_dir, spread

#: Encodings that texts of each script come in, and encodings that readers assume.
TRUE = {"latin": ("utf-8", "cp1252", "mac_roman", "cp850"), "cyrillic": ("utf-8", "cp1251", "koi8-r", "cp866", "mac_cyrillic", "iso8859-5"), "han": ("utf-8", "gb18030", "big5"), "kana": ("utf-8", "shift_jis", "euc_jp")}
ASSUMED = ("cp1252", "latin-1", "cp1250", "cp1251", "cp437", "cp850", "cp866", "mac_roman", "koi8-r", "iso8859-5", "gb18030", "big5", "shift_jis", "euc_jp", "utf-8")
LOST = "�"
#: True encodings in which no sequence of bytes goes on into ASCII: a text in them comes back run by run.
LOCAL = ("utf-8", "euc_jp", "cp1252", "mac_roman", "cp850", "cp1251", "koi8-r", "cp866", "mac_cyrillic", "iso8859-5")
#: Characters that no restored text may hold.
CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x9f]")
#: Characters that are damage of themselves: lost ones and C1 controls.
BROKEN = re.compile("[�\x80-\x9f]")
ASCII_RUN, WIDE_RUN, WIDE_SPAN = re.compile("[\x00-\x7f]+"), re.compile("[^\x00-\x7f]+"), re.compile("[^\x00-\x7f](?:.*[^\x00-\x7f])?", re.DOTALL)
RUNS = re.compile("([\x00-\x7f]?)([^\x00-\x7f]+)(?=([\x00-\x7f]?))")
#: Log-probability of a character that a state can't emit.
FLOOR = float(np.log(1e-7)) + 0.01
#: Punctuation and signs of clean captions that a small corpus may miss.
SIGNS = "“”‘’„«»‹›—–…♪♫¿¡£€$°C·•©®™№§±×÷½¼ ´`¨ªº「」『』（）《》【】、。！？；：，〜・ー→←…　"

#: Cost, in nats, of entering and of leaving a state of damage.
ENTER, LEAVE = 6.0, 0.5
#: Nats by which the emissions of a span may prefer another pair and the pair still be tried.
DOUBT = 6.0


@lru_cache(None)
def single_byte(encoding: str) -> list[str] | None:
    """The 256 characters of a single-byte encoding; unassigned bytes give the C1 control of the same value."""
    if encoding in ("gb18030", "big5", "shift_jis", "euc_jp", "utf-8"):
        return None
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(encoding))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


@lru_cache(None)
def byte_of(encoding: str) -> dict[str, int]:
    return {c: b for b, c in enumerate(single_byte(encoding))}


def misread(text: str, pair: tuple[str, str]) -> str:
    raw = text.encode(pair[0], "ignore")
    table = single_byte(pair[1])
    return "".join([table[b] for b in raw]) if table else raw.decode(pair[1], "replace")


@lru_cache(None)
def byte_map(encoding: str) -> dict[int, int]:
    return {ord(c): b for c, b in byte_of(encoding).items()}


@lru_cache(4096)
def bytes_of(text: str, encoding: str) -> bytes | None:
    """The bytes that a reader with this encoding saw as the text; None where it can't have seen it."""
    try:
        return codecs.charmap_encode(text, "strict", byte_map(encoding))[0] if single_byte(encoding) else text.encode(encoding)
    except UnicodeError:
        return None


def reread(text: str, pair: tuple[str, str]) -> str | None:
    """The inverse of misread, or None where the text can't come from it."""
    raw = bytes_of(text, pair[1])
    try:
        return None if raw is None else raw.decode(pair[0])
    except UnicodeError:
        return None


def script(text: str) -> str:
    return "latin" if text.isascii() else "kana" if re.search("[぀-ヿ]", text) else "han" if re.search("[一-鿿]", text) else "cyrillic" if re.search("[Ѐ-ӿ]", text) else "latin"


def codes_of(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 65535).astype(np.int64)


@dataclass
class EncodingModel:
    pairs: list[tuple[str, str]]
    row: np.ndarray  # code point -> row of ratios
    emission: np.ndarray  # (rows, pairs): log P(char | pair)
    top: np.ndarray  # (rows,): the highest of them
    unigram: np.ndarray
    bigram: np.ndarray
    context: np.ndarray
    follow: np.ndarray  # how many different characters follow each: the weight of the unigrams
    bits: int
    strong: list[int]  # pairs whose damage is valid UTF-8
    local: list[bool]  # whether a pair works run by run
    logs: dict = field(default_factory=dict)
    barren: set = field(default_factory=set)
    orders: dict = field(default_factory=dict)
    chains: dict = field(default_factory=dict)
    rereads: dict = field(default_factory=dict)
    begins: dict = field(default_factory=dict)
    places: dict = field(default_factory=dict)
    kept: dict = field(default_factory=dict)  # the texts tried last: their runs beyond ASCII and the results by pair
    sorts: dict = field(default_factory=dict)  # numbers of the orders of pairs

    def candidates(self, span: str, pair: int) -> tuple[tuple, tuple, tuple, tuple, int]:
        """Pairs to try for a span (over a part of a word, a word, a longer line, a line that is the word), and its number of characters beyond ASCII: the state's own pair, those of valid UTF-8 that the characters allow, and those that the emissions prefer or hardly disfavour."""
        wide = span if len(span) == 1 else ASCII_RUN.sub("", span)
        found = self.orders.get((wide, pair))
        if found is None:
            codes = codes_of(wide)
            table = self.emission[self.row[codes]]
            score = table.sum(0)
            # pairs from which most of the characters can come
            possible = (table > FLOOR).mean(0) >= 0.8
            likely = possible & (score >= min(score.max(initial=0.0, where=possible), score[pair]) - DOUBT)
            strong = [k for k in self.strong if possible[k]]
            ranked = np.argsort(-score)
            order = list(dict.fromkeys([pair, *strong, *ranked[likely[ranked]].tolist()]))
            # an encoding of single bytes damages whole words, one of several bytes whole lines
            bytewise = [k for k in order if single_byte(self.pairs[k][1])]
            valid = [k for k in bytewise if sound(self.pairs[k])]
            lined = [k for k in order if k == pair or k in valid or not single_byte(self.pairs[k][1])]
            if len(self.sorts) > 100_000:
                self.sorts.clear()
                self.places.clear()
                self.kept.clear()
                self.orders.clear()
            # numbers of orders are negative, those of pairs not
            found = *[(self.sorts.setdefault(x, -1 - len(self.sorts)), x) for x in map(tuple, (valid, bytewise, lined, order))], len(codes)
            if len(wide) <= 12:
                self.orders[wide, pair] = found
            if len(self.orders) > 100_000:
                self.orders.clear()
        return found

    def likelihood(self, text: str, before: str = "\n") -> np.ndarray:
        """Log-probability of each character after the one before, in clean text."""
        c = codes_of(before + text)
        h = pair_hash(c[:-1], c[1:], self.bits)
        return self.clean(c[1:], c[:-1], h)

    def total(self, text: str, before: str) -> float:
        """Sum of likelihood(); of short texts by the pairs of characters that were seen before."""
        if len(text) > 24:
            return float(self.likelihood(text, before).sum())
        out, last, logs = 0.0, before, self.logs
        for c in text:
            one = logs.get(last + c)
            if one is None:
                if len(logs) > 500_000:
                    logs.clear()
                # the pairs that the text holds besides are new as well, mostly
                every = before + text
                logs.update(zip([every[i : i + 2] for i in range(len(text))], self.likelihood(text, before).tolist()))
                one = logs[last + c]
            out += one
            last = c
        return out

    def chain(self, text: str) -> float:
        """total() of a text behind its first character."""
        out = self.chains.get(text)
        if out is None:
            out = self.total(text[1:], text[0])
            if len(text) <= 24:
                self.chains[text] = out
            if len(self.chains) > 200_000:
                self.chains.clear()
        return out

    def piece(self, run: str, k: int) -> str | None:
        """A run of characters beyond ASCII reread by a pair; None where no text holds what comes out."""
        fixed = self.rereads.get((run, k), LOST)
        if fixed == LOST:
            fixed = reread(run, self.pairs[k])
            if fixed is not None and (LOST in fixed or CONTROL.search(fixed)):
                fixed = None
            if len(run) <= 24:
                self.rereads[run, k] = fixed
            if len(self.rereads) > 200_000:
                self.rereads.clear()
        return fixed

    def clean(self, own: np.ndarray, before: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        """Log-probability of characters after those before them (Witten-Bell)."""
        weight = self.follow[before]
        return np.log((self.bigram[hashed] + weight * np.exp(self.unigram[own])) / (self.context[before] + weight))

    def prepared(self, own: str, before: str) -> tuple[list[tuple], dict]:
        """Of a text to try its runs beyond ASCII (the character before, the run, the ASCII character behind, what each pair saves there at most), and the results so far by pair. The spans of a line try the same texts again and again."""
        found = self.kept.get((own, before))
        if found is None:
            runs = []
            for first, run, after in RUNS.findall(own):
                first = first or before
                saves = self.places.get((first, run, after))
                if saves is None:
                    saves = {}
                    if len(run) <= 12:
                        if len(self.places) > 30_000:
                            self.places.clear()
                        self.places[first, run, after] = saves
                runs.append((first, run, after, saves))
            if len(self.kept) >= 16:
                self.kept.clear()
            found = self.kept[own, before] = runs, {}
        return found

    def most(self, place: tuple, k: int) -> float:
        """What a pair saves at a run at most: nats of a pair that works run by run, else 0; -inf where the run can't come from it."""
        first, run, after, saves = place
        out = saves.get(k)
        if out is None:
            if self.local[k]:
                one = self.piece(run, k)
                if one is None or one == run:
                    out = -np.inf if one is None else 0.0
                else:
                    held = saves.get(None)
                    if held is None:
                        held = saves[None] = self.chain(first + run + after)
                    out = self.chain(first + one + after) - held
            else:  # four bytes of gb18030 may reach over a digit into the next run
                out = 0.0 if self.pairs[k][0] == "gb18030" and first.isdigit() or self.viable(run, after, k) else -np.inf
            saves[k] = out
        return out

    def worth(self, runs: list[tuple], order: tuple[int, tuple[int, ...]]) -> list[int]:
        """The pairs, of those in the order, that the runs of a text leave: what works run by run must save something at one of them, what doesn't must suit all."""
        some, every = set(), None
        number, order = order
        for place in runs:
            saves = place[3]
            found = saves.get(number)
            if found is None:
                most = [(k, saves[k] if k in saves else self.most(place, k)) for k in order]
                found = saves[number] = [k for k, x in most if x > 0.0], {k for k, x in most if x == 0.0 and not self.local[k]}
            if found[0]:
                some.update(found[0])
            every = found[1] if every is None else every & found[1] if every else every
        return [k for k in order if k in some or k in every] if some or every else []

    def hopeless(self, runs: list[tuple], k: int, gain: float) -> bool:
        """Whether the runs of a text already tell that a pair can't reread it, or that it gets hardly likelier."""
        saved = 0.0
        for place in runs:
            saved += self.most(place, k)
            if saved == -np.inf:
                return True
        return self.local[k] and saved - self.asked(k, gain) <= 1.0

    def asked(self, k: int, gain: float) -> float:
        """Nats that a pair must save more than one of valid UTF-8, whose bytes are evidence of their own."""
        true, assumed = self.pairs[k]
        return 0.0 if sound((true, assumed)) else (gain if single_byte(assumed) else 2 * gain) + (gain if true in RARE else 0)

    def trial(self, own: str, runs: list[tuple], k: int, gain: float, before: str) -> tuple[str | None, float]:
        """The text reread by a pair, and how much likelier it is behind the character before; None where it can't be or is hardly likelier."""
        if self.hopeless(runs, k, gain):
            return None, 0.0
        return self._local(own, runs, k, gain) if self.local[k] else self._trial(own, k, gain, before)

    def _local(self, own: str, runs: list[tuple], k: int, gain: float) -> tuple[str | None, float]:
        """Run by run: what stands between is ASCII and stays, so that only the runs and the characters behind them tell."""
        saved = sum([saves[k] for *_, saves in runs]) - self.asked(k, gain)
        fixed = [self.piece(run, k) for _, run, _, _ in runs]
        if self.asked(k, gain):  # a text isn't likelier by being shorter
            saved -= 2.0 * max(0, sum([len(x[1]) - len(y) for x, y in zip(runs, fixed)]))
        if saved <= 1.0:
            return None, 0.0
        put = iter(fixed)
        out = WIDE_RUN.sub(lambda _: next(put), own)
        return (None, 0.0) if out == own or CONTROL.search(out) else (out, saved)

    def _trial(self, own: str, k: int, gain: float, before: str) -> tuple[str | None, float]:
        true, assumed = self.pairs[k]
        fixed = reread(own, (true, assumed))
        if fixed is None or fixed == own or LOST in fixed or CONTROL.search(fixed) or not of_language(fixed, true):
            return None, 0.0
        # only what lies from the first run to three characters behind the last one can differ
        begin = WIDE_RUN.search(own).start()
        rest = own[begin + len(WIDE_SPAN.search(own).group()) + 3 :]
        first = own[begin - 1] if begin else before
        if fixed[:begin] != own[:begin] or not fixed.endswith(rest) or len(fixed) < begin + len(rest):
            saved = self.total(fixed, before) - self.total(own, before)
        else:
            stop = max(0, len(rest) - 1)
            saved = self.chain(first + fixed[begin : len(fixed) - stop]) - self.chain(first + own[begin : len(own) - stop])
        saved -= 2.0 * max(0, len(own) - len(fixed)) + self.asked(k, gain)
        return (fixed, saved) if saved > 1.0 else (None, 0.0)

    def viable(self, run: str, after: str, k: int) -> bool:
        """Whether a run beyond ASCII, and the character behind it, may begin a text that the pair can reread."""
        found = self.begins.get((run, after, k))
        if found is None:
            true, assumed = self.pairs[k]
            raw = bytes_of(run, assumed)
            try:
                found = raw is not None and codecs.getincrementaldecoder(true)().decode(raw + after.encode(), not after) is not None
            except UnicodeError:
                found = False
            if len(run) <= 24:
                self.begins[run, after, k] = found
            if len(self.begins) > 200_000:
                self.begins.clear()
        return found

    def ratios(self, codes: np.ndarray, clean: np.ndarray) -> np.ndarray:
        """Log-likelihood ratios of the pairs' states to the clean state, whose emission depends on the character before."""
        return np.clip(self.emission[self.row[codes]] - clean[:, None], -9, 12)


def pair_hash(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    return ((a * 0x9E3779B1 + b * 0x85EBCA6B) & 0xFFFFFFFF) >> (32 - bits)


#: Encodings of several bytes that readers assume: what a misread text holds depends on the bytes beside each other.
SEVERAL = tuple(x for x in ASSUMED if single_byte(x) is None)
#: Kinds of counts: characters of each script, pairs of neighbours, and characters of each script misread by several bytes.
SCRIPTS = tuple(TRUE)
GRAMS = len(SCRIPTS)
WIDE = [(name, true, assumed) for name in SCRIPTS for true in TRUE[name] for assumed in SEVERAL if true != assumed]
#: What no pair changes ends at ASCII white space, and so does every misread sequence of bytes.
WIDE_WORD = re.compile("[^ \t\r\n]*[^\x00-\x7f][^ \t\r\n]*")


def tallied(codes: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The different values, and how often (or with what weight) each stands there; those below 65,536 without sorting."""
    small = codes < 65536
    rest = np.zeros(0, np.int64), np.zeros(0)
    if not small.all():
        own, at = np.unique(codes[~small], return_inverse=True)
        rest = own, np.bincount(at, None if weight is None else weight[~small], len(own))
        codes, weight = codes[small], None if weight is None else weight[small]
    often = np.bincount(codes, weight)
    own = np.flatnonzero(often)
    return np.concatenate([own, rest[0]]), np.concatenate([often[own], rest[1]])


def counted(texts: list[str], by: dict[str, list[str]] | None = None) -> pd.DataFrame:
    """Rows (kind, code, n): how often characters and pairs of neighbours stand in the texts, each with a line feed around, and in what misread texts give.

    A fourth of the Latin and Cyrillic texts (by hash) counts in capitals too: captions shout, documents rarely do. Counts
    of parts add up to those of the whole. ``by`` gives the texts by script instead."""
    if by is None:
        by = {k: [] for k in SCRIPTS}
        for text in texts:
            own = by[script(text)]
            own.append(text)
            if own is by["latin"] or own is by["cyrillic"]:
                if zlib.crc32(text.encode("utf-8", "surrogatepass")) % 4 == 0:
                    own.append(text.upper())
    out, grams = [], []
    for kind, name in enumerate(SCRIPTS):
        if not by[name]:
            continue
        joined = "\n" + "\n".join(by[name]) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        out.append((kind, *tallied(codes[1:])))
        codes = np.minimum(codes, 65535)
        a, b = codes[:-1], codes[1:]
        near = (a < 256) & (b < 256)
        code, n = tallied((a[near] << 8) + b[near])
        grams.append(((code >> 8 << 16) + (code & 255), n))
        grams.append(tallied((a[~near] << 16) + b[~near]))
        words = Counter(WIDE_WORD.findall("\n".join([x for x in joined.split("\n") if not x.isascii()])))
        if not words:
            continue
        often = np.array([0, *words.values()], np.float64)
        lines = "\n" + "\n".join(words)
        for true in TRUE[name]:
            raw = lines.encode(true, "ignore")
            for assumed in SEVERAL:
                if true == assumed:
                    continue
                codes = codes_of(raw.decode(assumed, "replace"))
                places = np.cumsum(codes == 10)
                wide = codes > 127
                out.append((GRAMS + 1 + WIDE.index((name, true, assumed)), *tallied(codes[wide], often[places[wide]])))
    if grams:
        code, at = np.unique(np.concatenate([x for x, _ in grams]), return_inverse=True)
        out.append((GRAMS, code, np.bincount(at, np.concatenate([n for _, n in grams]), len(code))))
    if not out:
        return summed([])
    kinds = np.repeat(np.array([x for x, _, _ in out], np.int32), [len(x) for _, x, _ in out])
    return pd.DataFrame({"kind": kinds, "code": np.concatenate([x for _, x, _ in out]), "n": np.concatenate([n for _, _, n in out]).astype(np.float64)})


def summed(parts: list[pd.DataFrame]) -> pd.DataFrame:
    parts = [x for x in parts if len(x)] or [pd.DataFrame({"kind": np.zeros(0, np.int32), "code": np.zeros(0, np.int64), "n": np.zeros(0)})]
    return parts[0] if len(parts) == 1 else pd.concat(parts).groupby(["kind", "code"], as_index=False, sort=False)["n"].sum()


@lru_cache(None)
def signs() -> pd.DataFrame:
    return counted([], {k: [SIGNS] for k in SCRIPTS})


def build(clean: list[str], bits: int = 18) -> EncodingModel:
    return modelled(*reduced(counted(clean), bits), bits)


def reduced(counts: pd.DataFrame, bits: int) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """Counts of the characters, counts of the hashed pairs, and of each character how many different ones follow it."""
    grams = counts[(counts["kind"] == GRAMS) & (counts["n"] > 0)]
    a, b = grams["code"].to_numpy() >> 16, grams["code"].to_numpy() & 65535
    bigram = np.bincount(pair_hash(a, b, bits), grams["n"].to_numpy(), 1 << bits)
    return counts[counts["kind"] != GRAMS], bigram, np.bincount(a, minlength=65536)


def modelled(counts: pd.DataFrame, bigram: np.ndarray, follow: np.ndarray, bits: int) -> EncodingModel:
    """The model of counted texts and the signs. A pair of single bytes changes each character on its own, so that what it gives follows from the counts of characters."""
    extra = reduced(signs(), bits)
    counts = summed([counts, extra[0]])
    bigram, follow = bigram + extra[1], np.maximum(follow, extra[2])
    of_kind = {int(k): (x["code"].to_numpy(), x["n"].to_numpy()) for k, x in counts[counts["n"] > 0].groupby("kind")}
    total = np.zeros(65536)
    for kind in range(len(SCRIPTS)):
        if kind in of_kind:
            np.add.at(total, np.minimum(of_kind[kind][0], 65535), of_kind[kind][1])
    pairs, found = [], []
    for assumed in ASSUMED:
        chars = single_byte(assumed)
        table = np.array([ord(c) for c in chars]) if chars else None
        for true in sorted({t for v in TRUE.values() for t in v}):
            if true == assumed or {true, assumed} <= {"cp1252", "latin-1"}:
                continue
            own = np.zeros(65536)
            for kind, name in enumerate(SCRIPTS):
                if true not in TRUE[name]:
                    continue
                part = np.zeros(65536)
                if chars:
                    seen = bytes_counted(of_kind.get(kind), true)
                    np.add.at(part, table, seen)
                else:
                    codes, n = of_kind.get(GRAMS + 1 + WIDE.index((name, true, assumed)), (np.zeros(0, np.int64), np.zeros(0)))
                    part[codes] = n
                part[:128] = 0
                own += part / max(1.0, part.sum())
            if own.any():
                pairs.append((true, assumed))
                found.append(own)
    floor = 1e-7
    unigram = np.log((total + 0.02) / (total.sum() + 0.02 * 65536) + floor)
    vocabulary = np.flatnonzero((total > 0) | (np.stack(found).sum(0) > 0))
    row = np.zeros(65536, np.int32)
    row[vocabulary] = np.arange(1, len(vocabulary) + 1)
    emission = np.full((len(vocabulary) + 1, len(pairs)), np.log(floor), np.float32)
    for k, own in enumerate(found):
        emission[1:, k] = np.log(own[vocabulary] / own.sum() + floor)
    return EncodingModel(pairs, row, emission, emission.max(1), unigram, bigram.astype(np.float32), total, np.maximum(2.0, follow), bits, [k for k, p in enumerate(pairs) if sound(p)], [p[0] in LOCAL for p in pairs])


def bytes_counted(characters: tuple[np.ndarray, np.ndarray] | None, encoding: str) -> np.ndarray:
    """How often each byte stands in the encoded characters."""
    out = np.zeros(256)
    if characters is not None:
        for c, n in zip(characters[0].tolist(), characters[1].tolist()):
            for byte in chr(c).encode(encoding, "ignore"):
                out[byte] += n
    return out


def viterbi(ratios: np.ndarray, enter: float = ENTER, leave: float = LEAVE) -> np.ndarray:
    """Most likely states (0 clean, k + 1 for column k), of the ratios (n, states)."""
    n, s = ratios.shape
    damage, clean = np.full((n + 1, s), -enter), 0.0
    into, before = np.empty(n), [0] * n
    now = damage[0]
    for t, (after, ratio) in enumerate(zip(damage[1:], ratios)):
        top = now.item(now.argmax())
        enters = clean - enter
        if top - enter - leave > enters:
            enters = top - enter - leave
            before[t] = 2
        into[t] = enters
        np.maximum(now, enters, out=after)
        np.add(after, ratio, out=after)
        now = after
        if top - leave > clean:
            clean = top - leave
            before[t] += 1
    best = damage.argmax(1) + 1
    stay = damage[:-1] >= into[:, None]
    best = best.tolist()
    state = best[n] if damage[n, best[n] - 1] > clean else 0
    path = np.empty(n, np.int16)
    for t in range(n - 1, -1, -1):
        path[t] = state
        if state == 0:
            state = best[t] if before[t] & 1 else 0
        elif not stay[t, state - 1]:
            state = best[t] if before[t] & 2 else 0
    return path


#: Cells (characters x segments x states) that viterbi_all() works on at once.
CELLS = 1_600_000


def viterbi_all(sizes: np.ndarray, states: np.ndarray, ends: np.ndarray, table, enter: float = ENTER, leave: float = LEAVE) -> np.ndarray:
    """viterbi() of many segments side by side, one behind the other in the result: their numbers of characters, their numbers of states, and whether a segment ends its text (else a clean character follows, to which every state must return).

    ``table`` gives the ratios (characters, segments, states) of some segments, -99 where a segment has no such state."""
    path = np.zeros(int(sizes.sum()), np.int16)
    offsets = np.cumsum(sizes) - sizes
    # segments of like size go together, longest first, so that those still running are the first ones
    kind = np.ceil(np.log2(states) / 2).astype(int) * 64 + np.ceil(np.log2(sizes)).astype(int)
    order = np.lexsort((-sizes, kind))
    kind = kind[order]
    for group in np.split(order, np.flatnonzero(np.diff(kind)) + 1):
        step = max(1, CELLS // int(sizes[group[0]] * states[group].max()))
        for at in range(0, len(group), step):
            own = group[at : at + step]
            length, ratios = sizes[own], table(own)
            if len(own) < 4:
                for i, g in enumerate(own.tolist()):
                    some = ratios[: length[i], i]
                    if not ends[g]:
                        some = np.vstack([some, np.full((1, some.shape[1]), -99.0)])
                    path[offsets[g] : offsets[g] + length[i]] = viterbi(some, enter, leave)[: length[i]]
                continue
            steps, n, s = ratios.shape
            running = n - np.searchsorted(length[::-1], np.arange(steps), "right")
            damage, clean, each = np.full((n, s), -enter), np.zeros(n), np.arange(n)
            stay = np.empty((steps, n, s), bool)
            source, before = np.zeros((steps, n), np.int16), np.zeros((steps, n), np.int16)
            for t, m in enumerate(running.tolist()):
                d, c = damage[:m], clean[:m]
                best = d.argmax(1)
                top = d[each[:m], best]
                best += 1
                other, into = top - enter - leave, c - enter
                np.multiply(best, other > into, out=source[t, :m], casting="unsafe")
                into = np.maximum(into, other)[:, None]
                np.greater_equal(d, into, out=stay[t, :m])
                np.maximum(d, into, out=d)
                d += ratios[t, :m]
                top -= leave
                np.multiply(best, top > c, out=before[t, :m], casting="unsafe")
                np.maximum(c, top, out=c)
            best = damage.argmax(1)
            state = np.where(damage[each, best] - np.where(ends[own], 0.0, leave) > clean, best + 1, 0)
            places = offsets[own]
            for t in range(steps - 1, -1, -1):
                m = running[t]
                now = state[:m]
                path[places[:m] + t] = now
                state[:m] = np.where(now == 0, before[t, :m], np.where(stay[t, each[:m], now - 1], now, source[t, :m]))
    return path


def labelled(texts: list[str], model: EncodingModel) -> list[list[tuple[int, int, int]]]:
    """Of each text the spans (begin, end, pair) that the hidden Markov model labels as damaged. ASCII, which no pair changes, carries the state on.

    Every pair is a state. Only stretches of characters are worked on in which some best path could be damaged: a
    damaged span whose first characters speak against it would begin later, so that the sum of the best ratios since its
    begin stays above 0, and it must somewhere make up for entering; and of the states those that can make up for it, of
    several that can't emit any of the characters the first."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    codes = codes_of("\n" + "\n".join(texts))
    before, codes = codes[:-1], codes[1:]
    at = np.flatnonzero(codes > 127)
    if not len(at):
        return out
    starts = np.cumsum([0, *[len(x) + 1 for x in texts[:-1]]])
    owner = np.searchsorted(starts, at, "right") - 1
    own = codes[at]
    rows = model.row[own]
    clean = model.clean(own, before[at], pair_hash(before[at], own, model.bits))
    sums = np.cumsum(np.clip(model.top[rows] - clean, -9, 12), dtype=np.float64)
    fall = 1e4 * owner  # between texts, so that no sum goes on into the next one
    run = sums - fall - np.minimum.accumulate(np.concatenate([[0.0], sums[:-1]]) - fall)
    fresh = np.concatenate([[True], owner[1:] != owner[:-1]])
    inside = run > 0
    first = np.flatnonzero(inside & (fresh | ~np.concatenate([[False], inside[:-1]])))
    last = np.flatnonzero(inside & np.concatenate([fresh[1:] | ~inside[1:], [True]])) + 1
    if not len(first):
        return out
    worth = np.maximum.reduceat(run, first) > ENTER
    first, last = first[worth], last[worth]
    ends = np.concatenate([fresh[1:], [True]])[last - 1]  # the last character of a text: no clean one follows
    # states by segment: what a state gains at most is the sum of the ratios that speak for it
    sizes, keep = last - first, []
    for part in np.split(np.arange(len(first)), np.flatnonzero(np.diff(np.cumsum(sizes) // 4096)) + 1) if len(first) else []:
        places = within(first[part], sizes[part])
        edges = np.cumsum(sizes[part]) - sizes[part]
        emission = model.emission[rows[places]]
        can = np.maximum.reduceat(emission, edges, axis=0) > FLOOR
        emission -= clean[places, None].astype(np.float32)
        gain = np.add.reduceat(np.maximum(emission, 0, out=emission), edges, axis=0) > ENTER - 0.01
        never = gain & ~can
        gain &= can
        some = np.flatnonzero(never.any(1))
        gain[some, never[some].argmax(1)] = True
        keep.append(gain)
    if not keep:
        return out
    keep = np.concatenate(keep)
    states = keep.sum(1)
    possible = states > 0
    first, sizes, ends, keep, states = first[possible], sizes[possible], ends[possible], keep[possible], states[possible]
    if not len(first):
        return out
    listed = np.cumsum(states) - states
    pairs = np.nonzero(keep)[1]

    def table(some: np.ndarray) -> np.ndarray:
        length, width = sizes[some], states[some]
        t, k = np.arange(length[0])[:, None], np.arange(width.max())
        place = first[some] + np.minimum(t, length - 1)
        state = pairs[listed[some][:, None] + np.minimum(k, width[:, None] - 1)]
        ratios = np.clip(model.emission[rows[place][:, :, None], state[None]] - clean[place][:, :, None], -9, 12)
        ratios[:, k >= width[:, None]] = -99.0
        return ratios

    path = viterbi_all(sizes, states, ends, table)
    places, segment = within(first, sizes), np.repeat(np.arange(len(first)), sizes)
    # a line feed between two characters parts their spans
    lines = np.cumsum(codes == 10)[at[places]]
    edges = np.flatnonzero(np.concatenate([[True], (np.diff(path) != 0) | (np.diff(segment) != 0) | (np.diff(lines) != 0)]))
    stop = np.concatenate([edges[1:], [len(path)]]) - 1
    hit = path[edges] > 0
    edges, stop = edges[hit], stop[hit]
    of, pair = owner[places[edges]], pairs[listed[segment[edges]] + path[edges] - 1]
    begin, end = at[places[edges]] - starts[of], at[places[stop]] + 1 - starts[of]
    for i, x, y, k in zip(of.tolist(), begin.tolist(), end.tolist(), pair.tolist()):
        out[i].append((x, y, k))
    return out


def within(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all segments, one behind the other."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


#: Encodings that few texts come in; a span needs more evidence for them.
RARE = ("mac_roman", "cp850", "iso8859-5", "mac_cyrillic", "cp866", "koi8-r")


#: Question marks in place of letters: long runs, runs in a row with nothing but signs and digits between, one inside a word.
RUN = re.compile(r"\?{2,}")
ROW = re.compile(r"(?<![^\W\d_])(?<!\?)(?:\?{8,}|\?{2,}(?:[\s\d,.:;-]+\?{2,})+)")
INSIDE = re.compile(r"(?<=[^\W\d_])\?{1,3}(?=[a-z])")
ADDRESS = re.compile(r"[/=&@]|www\.")
#: Java form of what a text holds that may have lost letters or is not ASCII.
TO_READ = "[^\\x00-\\x7F]|\\?\\?|\\p{L}\\?[a-z]"


def lost_letters(text: str) -> list[tuple[int, int]]:
    """Spans of question marks that stand for lost letters. Marks behind a word are its own, and so are up to three alone on a line."""
    out = []
    if "?" not in text or "??" not in text and not INSIDE.search(text):
        return out
    for line in re.finditer(r"[^\n]+", text):
        own = TAG.sub("", line.group())
        runs = [len(x) for x in RUN.findall(own)]
        if runs:
            if re.search(r"[^\W\d_]", own):
                lost = any(m.group().count("?") >= 5 for m in ROW.finditer(own))
            else:
                lost = max(runs) >= 4 or len(runs) >= 2 and max(runs) >= 3
            if lost:
                out += [(line.start() + m.start(), line.start() + m.end()) for m in RUN.finditer(line.group())]
                continue
        for m in INSIDE.finditer(line.group()):
            word = re.search(r"\S*$", line.group()[: m.start()]).group() + re.match(r"\S*", line.group()[m.end() :]).group()
            if not ADDRESS.search(word):
                out.append((line.start() + m.start(), line.start() + m.end()))
    return out


def sound(pair: tuple[str, str]) -> bool:
    return pair[0] == "utf-8" and single_byte(pair[1]) is not None


LETTER = {"latin": re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ]"), "cyrillic": re.compile(r"[Ѐ-ӿ]"), "cjk": re.compile(r"[぀-ヿ㐀-鿿]")}
TAG = re.compile(r"<[^<>]*>|\{[^{}]*\}")
KANA = re.compile("[\u3040-\u30ff]")
BLANK = re.compile("[ \t\r\n\u3000]")


def fits(fixed: str, before: str, after: str) -> bool:
    """Whether restored letters suit their line: a few letters of another script inside a word or sentence don't."""
    held = [x for x in (LETTER["cyrillic"], LETTER["cjk"]) if x.search(fixed)]
    if not held:
        return True
    line = TAG.sub("", before + fixed + after)
    total = sum(len(x.findall(line)) for x in LETTER.values())
    return all(len(x.findall(line)) >= 0.34 * total for x in held)


def of_language(fixed: str, true: str) -> bool:
    """Japanese encodings give text with kana, Chinese ones without."""
    if true in ("gb18030", "big5"):
        return not KANA.search(fixed)
    return true not in ("shift_jis", "euc_jp") or len(KANA.findall(fixed)) >= 0.2 * len(LETTER["cjk"].findall(fixed))


def best_inverse(text: str, begin: int, end: int, pair: int, model: EncodingModel, gain: float, usual: bool = False) -> tuple[int, int, str, tuple[str, str], float] | None:
    """The likeliest restoration of the span: by its own pair or another that its characters allow, over the span, its word or its line.

    Text that was read as a multi-byte encoding is damaged by the line, so that the whole line must come from the pair."""
    span = text[begin:end]
    parts, bytewise, lined, everything, wide = model.candidates(span, pair)
    line = text.rfind("\n", 0, begin) + 1, text.find("\n", end)
    line = line[0], line[1] if line[1] >= 0 else len(text)
    behind = BLANK.search(text, end, line[1])
    word = max(line[0], *[text.rfind(x, line[0], begin) + 1 for x in " \t\r\u3000"]), behind.start() if behind else line[1]
    best = None
    for b, e in dict.fromkeys([(begin, end), word, line]):
        own = text[b:e]
        # short pieces recur: what no pair restores is tried once
        before = text[b - 1] if b else "\n"
        known = (before, span, own, begin - b, pair)
        if known in model.barren:
            continue
        runs, results = model.prepared(own, before)
        promising = False
        whole = (b, e) == line
        order = (everything if line == word else lined) if whole else bytewise if (b, e) == word else parts
        few = sum([len(x[1]) for x in runs]) < 6
        for k in model.worth(runs, order):
            true, assumed = model.pairs[k]
            if assumed == "utf-8" and LOST in own:
                continue
            if few and true in RARE:
                continue  # a word or two can look like anything
            done = results.get(k)
            if done is None:
                done = results[k] = model.trial(own, runs, k, gain, before)
            fixed, saved = done
            if fixed is None:
                continue
            promising = True
            if best is None or (sound((true, assumed)), saved) > (sound(best[3]), best[4]):
                if not fits(fixed, text[line[0] : b], text[e : line[1]]) or not of_language(fixed, true):
                    continue
                best = (b, e, fixed, (true, assumed), saved)
                if k == pair and (usual or saved > 2.0 * wide):
                    return best
        if best is not None:
            break
        if not promising and (b, e) != line and len(own) <= 40:
            model.barren.add(known)
            if len(model.barren) > 200_000:
                model.barren.clear()
    return best


Repair = tuple[bool, str | None, list[tuple[int, int, str]]]


def repair(text: str | None, model: EncodingModel, gain: float = 6.0, rounds: int = 3, spans: list[tuple[int, int, int]] | None = None, any_span: bool = False) -> Repair:
    """(damaged, restored text, [(begin, end, pair)]) of a text (and its spans, where they are known); positions are those of the first round. With ``any_span`` it ends at the first span, where only whether there is one matters."""
    return repairs([text], model, gain, rounds, [spans], any_span)[0]


def repairs(texts: list[str | None], model: EncodingModel, gain: float = 6.0, rounds: int = 3, spans: list | None = None, any_span: bool = False) -> list[Repair]:
    """repair() of many texts, whose labels are found together."""
    steps = [repairing(text, model, gain, rounds, own, any_span) for text, own in zip(texts, spans or [None] * len(texts))]
    out: list = [None] * len(steps)
    sent: dict = dict.fromkeys(range(len(steps)))
    while sent:
        asked = {}
        for i, labels in sent.items():
            try:
                asked[i] = steps[i].send(labels)
            except StopIteration as end:
                out[i] = end.value
        sent = dict(zip(asked, labelled(list(asked.values()), model))) if asked else {}
    return out


def repairing(text: str | None, model: EncodingModel, gain: float, rounds: int, spans: list[tuple[int, int, int]] | None, any_span: bool) -> Generator[str, list, Repair]:
    """The steps of repair(): gives texts out and takes their labels."""
    gone = lost_letters(text) if text else []
    if not text or text.isascii() and not gone:
        return False, text, []
    found, fixed = [], text
    for turn in range(rounds):
        if spans is None:
            spans = yield fixed
        parts, last, changed = [], 0, False
        usual, gaps = None, LOST in fixed
        for begin, end, pair in spans:
            if begin < last:
                continue
            if any_span and found:
                break
            if gaps and LOST in fixed[fixed.rfind("\n", 0, begin) + 1 : fixed.find("\n", end) if "\n" in fixed[end:] else len(fixed)]:
                continue  # what is lost can't be put back, and its line is damaged anyway
            done = best_inverse(fixed, begin, end, pair if usual is None else usual, model, gain, usual is not None)
            if done and done[0] >= last:
                usual = model.pairs.index(done[3])
                parts += [fixed[last : done[0]], done[2]]
                last, changed = done[1], True
                if turn == 0:
                    found.append((done[0], done[1], "/".join(done[3])))
            elif turn == 0 and not done:
                if BROKEN.search(fixed, begin, end) or strange(fixed[begin:end], pair, model):
                    found.append((begin, end, "lost"))
        fixed = "".join([*parts, fixed[last:]])
        # damaged twice? what was put back shows it
        spans = None
        if not changed or turn + 1 == rounds or not (yield "\n".join(parts[1::2])):
            break
    found += [(m.start(), m.end(), "lost") for m in re.finditer(LOST + "+", text)] + [(b, e, "lost") for b, e in gone if not any(x < e and b < y for x, y, _ in found)]
    return bool(found), fixed, sorted(found)


def strange(span: str, pair: int, model: EncodingModel) -> bool:
    """Whether the characters of a span that can't be given back speak for its pair beyond doubt."""
    if len(span) <= 5 or len(ASCII_RUN.sub("", span)) <= 5:
        return False  # a ratio is 12 at most
    codes = codes_of(span)
    wide = codes > 127
    ratios = np.clip(model.emission[model.row[codes[wide]], pair] - model.likelihood(span)[wide], -9, 12)
    return bool(ratios.sum() > 60 and ratios.mean() > 5)


def fit_texts(clean: list[str], mixed: list[str], rounds: int = 2) -> EncodingModel:
    """From texts known to be clean, then also from those of the mixed ones in which the last model finds no strong damage."""
    known, every = counted(clean), counted(mixed)
    model = modelled(*reduced(known, 18), 18)
    for _ in range(rounds):
        gone = counted([x for x, spans in zip(mixed, labelled(mixed, model)) if strong_damage(x, model, spans)])
        model = modelled(*reduced(summed([known, every, gone.assign(n=-gone["n"])]), 18), 18)
    return model


def strong_damage(text: str, model: EncodingModel, spans: list[tuple[int, int, int]] | None = None) -> bool:
    if BROKEN.search(text) or lost_letters(text):
        return True
    if spans is not None and not spans:
        return False
    # less evidence is asked for than of damage that is reported: what a whole file repeats would else count as clean
    latin = script(text) == "latin"
    spans = repair(text, model, gain=1.0, rounds=1, spans=spans, any_span=latin)[2]
    if latin:
        return bool(spans)
    return any(sound(tuple(p.split("/"))) for *_, p in spans if p != "lost") or sum(e - b for b, e, _ in spans) > 0.2 * len(text) or len(spans) >= 4


@contextmanager
def no_cycles() -> Generator[None]:
    """Without the search for cycles among objects: the many that are kept here form none."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def portions(frames: Iterator, characters: int = 2_000_000) -> Iterator:
    """Cuts incoming frames at so many characters (column t): the more texts at once, the more segments go side by side."""
    for frame in batches(frames, 10_000):
        lengths = frame["t"].str.len()
        for _, part in frame.groupby(((lengths.cumsum() - lengths) // characters).to_numpy(), sort=False):
            yield part


def tallies(texts: DataFrame, model: EncodingModel | None = None) -> DataFrame:
    """Rows (kind, code, n) of all texts (column t); with a model, of those in which it finds strong damage, which count against."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def count(frames):
        held, size, own = [], 0, []
        for frame in portions(frames):
            some = frame["t"].tolist()
            with no_cycles():
                own += some if shared.value is None else [x for x, spans in zip(some, labelled(some, shared.value)) if strong_damage(x, shared.value, spans)]
            if sum(map(len, own)) > 1_000_000:
                held.append(counted(own))
                own, size = [], size + len(held[-1])
                if size > 2_000_000:
                    held = [summed(held)]
                    if len(held[0]) > 1_000_000:
                        yield held.pop()
                    size = sum(map(len, held))
        if own:
            held.append(counted(own))
        if held:
            yield summed(held)

    found = texts.mapInPandas(count, "kind int, code bigint, n double")
    return found if model is None else found.withColumn("n", -F.col("n"))


def fit(clean: DataFrame, mixed: list[tuple[DataFrame, str, str]], rounds: int = 2, bits: int = 18) -> EncodingModel:
    """Fits on all of the clean texts (a table with a column text) and all rows of each (table, key, text column), as fit_texts() does.

    The texts are counted where they lie; a round counts those that its model finds damaged, and takes them off. What
    comes to the driver are counts of characters and of hashed pairs, whatever the size."""
    ensure_checkpoint_dir(clean.sparkSession)
    known = tallies(clean.where(F.length("text") > 0).select(F.col("text").alias("t")))
    texts = reduce(DataFrame.unionByName, [df.where(F.length(text) > 0).select(F.col(text).alias("t")) for df, _, text in mixed])
    totalled = lambda rows: rows.groupBy("kind", "code").agg(F.sum("n").alias("n"))
    every = totalled(known.unionByName(tallies(spread(texts)))).checkpoint()
    # a text without what TO_READ asks for can't be damaged
    doubtful = spread(texts.where(F.col("t").rlike(TO_READ)))
    model = collected(totalled(known), bits)
    for _ in range(rounds):
        model = collected(totalled(every.unionByName(tallies(doubtful, model))), bits)
    return model


def collected(counts: DataFrame, bits: int) -> EncodingModel:
    counts = counts.where("n > 0").checkpoint()
    a, b = F.shiftright("code", 16), F.col("code").bitwiseAND(F.lit(65535))
    hashed = F.shiftright((a * F.lit(0x9E3779B1) + b * F.lit(0x85EBCA6B)).bitwiseAND(F.lit(0xFFFFFFFF)), 32 - bits)
    grams = counts.where(F.col("kind") == GRAMS)
    bigram, follow = np.zeros(1 << bits), np.zeros(65536)
    own = grams.groupBy(hashed.alias("h")).agg(F.sum("n").alias("n")).toPandas()
    bigram[own["h"].to_numpy(np.int64)] = own["n"]
    own = grams.groupBy(a.alias("a")).agg(F.count("*").alias("n")).toPandas()
    follow[own["a"].to_numpy(np.int64)] = own["n"]
    return modelled(counts.where(F.col("kind") != GRAMS).toPandas(), bigram, follow, bits)


def damaged(df: DataFrame, key: str, text: str, model: EncodingModel) -> DataFrame:
    """One row per damaged row of the table: key, restored text, and the damaged spans with the encodings to blame."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[key].dataType.simpleString()

    def scan(frames):
        for frame in portions(frames):
            texts = frame["t"].tolist()
            with no_cycles():
                some = [(k, t, own) for k, t, own in zip(frame["k"].tolist(), texts, labelled(texts, shared.value)) if own or LOST in t or "?" in t]
                done = repairs([t for _, t, _ in some], shared.value, spans=[own for *_, own in some])
            out = [(k, fixed, [{"begin": b, "end": e, "encodings": p} for b, e, p in spans]) for (k, _, _), (hit, fixed, spans) in zip(some, done) if hit]
            if out:
                yield pd.DataFrame(out, columns=["k", "restored", "spans"])

    rows = df.where(F.col(text).rlike(TO_READ)).select(F.col(key).alias("k"), F.col(text).alias("t"))
    found = rows.mapInPandas(scan, f"k {kind}, restored string, spans array<struct<begin:int,end:int,encodings:string>>")
    return found.select(F.col("k").alias(key), "restored", "spans")

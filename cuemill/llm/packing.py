"""Documents into containers of fixed token capacity.

Sizes are counted with a public tokenizer. Placement is online by sum of squares: each document goes to the fill level
where it keeps the sum of squared counts of partly filled containers smallest; the counts are kept in a level array,
the containers of a level in a stack. A text larger than the capacity gives full containers and one rest; no other
text is cut.

Documents are dealt to shards by hash, each packed by itself; a shard holds ``shard_rows`` documents, so that the few
containers that stay open at its end are a small share of all.

Defined results: null and empty texts have no tokens and are in no container; repeated documents are packed each;
equal changes of the sum of squares go to the fullest level; a text of exactly the capacity fills a container alone;
profiles without a positive capacity are left out; empty tables give an empty result.
"""

from __future__ import annotations

import base64
import os

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, spread

#: Where the vocabulary file of the public tokenizer lies unless the caller names another.
VOCABULARY = os.environ.get("CUEMILL_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: Fixed value: the pre-split pattern that goes with byte-level pair vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_encodings: dict = {}


def encoding(path: str, pattern: str = PATTERN):
    """The tokenizer, read once per worker."""
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        _encodings[path] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


def token_counts(documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, n_tokens) of each document with a text."""
    kind = documents.schema[key].dataType.simpleString()

    def count(frames):
        own = encoding(vocabulary)
        for frame in batches(frames, 500):
            yield pd.DataFrame({key: frame["k"], "n_tokens": [len(own.encode_ordinary(t)) for t in frame["t"]]})

    rows = spread(documents.where(F.length(text) > 0).select(F.col(key).alias("k"), F.col(text).alias("t")))
    return rows.mapInPandas(count, f"{key} {kind}, n_tokens bigint")


class Packer:
    """Online sum-of-squares packing into containers of one capacity."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.levels = np.zeros(capacity + 1, np.int64)
        self.stacks: dict[int, list[int]] = {}
        self.containers = 0

    def place(self, size: int) -> int:
        """Number of the container that takes an item of the size (1 to capacity)."""
        n, c = self.levels, self.capacity
        top = c - size
        # change of the sum of squares when a container goes from level h to h + size; full containers don't count
        change = 2 * (n[size : c + 1] - n[: top + 1]) + 2
        change[top] = -2 * n[top] + 1
        change[0] = 2 * n[size] + 1 if size < c else 0
        open_ = n[: top + 1] > 0
        open_[0] = True
        change = np.where(open_, change, np.iinfo(np.int64).max)
        best = int(top - change[::-1].argmin())
        if best == 0:
            container = self.containers
            self.containers += 1
        else:
            container = self.stacks[best].pop()
            n[best] -= 1
        level = best + size
        if level < c:
            n[level] += 1
            self.stacks.setdefault(level, []).append(container)
        return container


def pieces(size: int, capacity: int) -> list[int]:
    """A size that fits, as it is; a larger one in full pieces and a rest."""
    full, rest = divmod(size, capacity)
    return [size] if size <= capacity else [capacity] * full + ([rest] if rest else [])


def pack(documents: DataFrame, profiles: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, shard_rows: int = 10_000, most_profiles: int = 1000) -> DataFrame:
    """Rows (profile_id, shard, container, key, piece_no, begin_token, n_tokens): where each document or piece goes. A container is known by profile, shard and number."""
    capacities = [(r[0], r[1]) for r in profiles.where(F.col("capacity_tokens") > 0).select("profile_id", "capacity_tokens").distinct().orderBy("profile_id", "capacity_tokens").limit(most_profiles + 1).collect()]
    if len(capacities) > most_profiles:
        raise ValueError(f"more than {most_profiles} profiles")
    shards = max(1, -(-documents.count() // shard_rows))
    kind = documents.schema[key].dataType.simpleString()
    sizes = token_counts(documents, key, text, vocabulary).withColumn("shard", F.pmod(F.xxhash64(key, "n_tokens"), F.lit(shards)).cast("int"))

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([key, "n_tokens"])
        shard = int(frame["shard"].iloc[0])
        out = []
        for profile, capacity in capacities:
            packer = Packer(capacity)
            for k, size in zip(frame[key].tolist(), frame["n_tokens"].tolist()):
                begin = 0
                for number, own in enumerate(pieces(size, capacity)):
                    out.append((profile, shard, packer.place(own), k, number, begin, own))
                    begin += own
        return pd.DataFrame(out, columns=["profile_id", "shard", "container", key, "piece_no", "begin_token", "n_tokens"])

    # a task per shard: a shard's sizes are few bytes, its placing takes long
    return sizes.repartition(shards, "shard").groupBy("shard").applyInPandas(place, f"profile_id int, shard int, container int, {key} {kind}, piece_no int, begin_token bigint, n_tokens bigint")


def fill(packed: DataFrame, profiles: DataFrame) -> DataFrame:
    """Per profile: containers, tokens, and the share of room that is filled."""
    used = packed.groupBy("profile_id", "shard", "container").agg(F.sum("n_tokens").alias("tokens"))
    total = used.groupBy("profile_id").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("fullest"))
    own = profiles.select("profile_id", "capacity_tokens").distinct()
    return total.join(own, "profile_id").select("profile_id", "capacity_tokens", "containers", "tokens", "fullest", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 4).alias("filled"))

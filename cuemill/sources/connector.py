"""Outside services behind one interface: a transport answers requests; the stub answers from recorded rows.

Calls run inside partitions, one transport per partition, and give (body, error) rows instead of raising, so that a
lost executor only repeats its partition's calls. Identical requests are sent once."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Transport = Callable[[str], tuple[str | None, str | None]]


@dataclass
class Stub:
    """Answers from a map of request to reply; what it doesn't know is an error of the given reason. ``rule`` may compute replies."""

    replies: dict[str, str] = field(default_factory=dict)
    rule: Callable[[str], str | None] | None = None
    reason: str = "not_found"

    def __call__(self, request: str) -> tuple[str | None, str | None]:
        body = self.replies.get(request)
        if body is None and self.rule:
            body = self.rule(request)
        return (body, None) if body is not None else (None, self.reason)


def retrying(transport: Transport, attempts: int = 3, wait_s: float = 0.0) -> Transport:
    import time

    def call(request: str) -> tuple[str | None, str | None]:
        error = "network_error"
        for k in range(attempts):
            body, error = transport(request)
            if error is None:
                return body, None
            if k + 1 < attempts and wait_s:
                time.sleep(wait_s)
        return None, error

    return call


def call(requests: DataFrame, request: str, transport: Transport, parallel: int = 8) -> DataFrame:
    """Adds body and error. Equal requests are called once; ``parallel`` bounds the calls at a time."""
    once = requests.select(F.col(request).alias("_request")).where(F.col("_request").isNotNull()).distinct().repartition(parallel, "_request")

    def answer(frames):
        for frame in frames:
            out = [transport(x) for x in frame["_request"]]
            yield pd.DataFrame({"_request": frame["_request"], "body": [b for b, _ in out], "error": [e for _, e in out]})

    answers = once.mapInPandas(answer, "_request string, body string, error string")
    return requests.join(answers, requests[request] == answers["_request"], "left").drop("_request")


def halving(send: Callable[[list[str]], list[str] | None], items: list[str]) -> list[str | None]:
    """Replies to a list of items; when their number is wrong, each half is sent by itself, down to single items."""
    replies = send(items)
    if replies is not None and len(replies) == len(items):
        return list(replies)
    if len(items) == 1:
        return [None]
    middle = len(items) // 2
    return halving(send, items[:middle]) + halving(send, items[middle:])


def event_text(lines: list[str]) -> tuple[str, bool]:
    """(text, cut off) of a streamed reply: the deltas of its data lines, up to the end mark."""
    import json

    out, cut = [], False
    for line in lines:
        if not line.startswith("data:"):
            continue
        body = line[5:].strip()
        if body == "[DONE]":
            break
        try:
            choice = (json.loads(body).get("choices") or [{}])[0]
        except ValueError:
            continue
        out.append((choice.get("delta") or {}).get("content") or "")
        cut = cut or choice.get("finish_reason") == "length"
    return "".join(out), cut


def merge_turns(messages: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Chat messages with neighbouring turns of one role joined."""
    out: list[tuple[str, str]] = []
    for role, content in messages:
        if out and out[-1][0] == role:
            out[-1] = (role, out[-1][1] + "\n\n" + content)
        else:
            out.append((role, content))
    return out

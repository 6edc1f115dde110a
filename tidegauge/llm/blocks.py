"""Keys dealt out over blocks, which work in turns and send one another messages of many values each.

A block is the home of the keys that hash to it. What it knows of them is kept in a few rows of arrays, and what it sends
to another block in one turn is one row, so that rows, and the work on them in the JVM, are per pair of blocks in place
of per value. Blocks have about the same number of keys however many keys there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: A message: the block it is for, what it is, a number (the sender or a count), another count, and arrays as bytes.
NAMES = ["block", "kind", "num", "total", "a", "b", "c", "d", "e"]
SCHEMA = "block int, kind string, num long, total long, a binary, b binary, c binary, d binary, e binary"
#: Bytes of messages handed over at once, and rows that are gathered before they are dealt out.
FRAME, GATHERED = 8 << 20, 1 << 18
#: Up to so many blocks each has a task of its own; of more, up to ``SHARED`` share one.
TASKS, SHARED = 64, 4

#: The messages of a block by kind.
Got = dict[str, list[Any]]


def mixed(keys: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each key."""
    x = keys.astype(np.int64).view(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def message(block: int, kind: str, num: int, arrays: Iterable[np.ndarray], total: int = 0) -> tuple:
    data = [np.ascontiguousarray(x).tobytes() for x in arrays]
    return (int(block), kind, int(num), int(total), *data, *[None] * (5 - len(data)))


def dealt(kind: str, num: int, keys: np.ndarray, blocks: int, *columns: np.ndarray) -> Iterator[tuple]:
    """For each block that is home to some of ``keys`` a message with the ``columns`` of these."""
    for block, these in shares(keys, blocks):
        yield message(block, kind, num, [c[these] for c in columns])


def shares(keys: np.ndarray, blocks: int) -> Iterator[tuple[int, np.ndarray]]:
    """(block, the places in ``keys`` of those it is home to)."""
    home = (mixed(keys) % np.uint64(blocks)).astype(np.int32)
    order = np.argsort(home, kind="stable")
    home = home[order]
    starts = run_starts(home)
    for start, end in zip(starts, np.append(starts[1:], len(home))):
        yield int(home[start]), order[start:end]


def run_starts(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a new value begins in columns sorted together."""
    if not len(sorted_columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(sorted_columns[0]), bool)
    new[0] = True
    for column in sorted_columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def places(*sorted_columns: np.ndarray) -> np.ndarray:
    """The place of each row in its run of equal values, from 0."""
    n, starts = len(sorted_columns[0]), run_starts(*sorted_columns)
    return np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))


def joined(messages: list[Any], column: str, kind: str) -> np.ndarray:
    """One column of several messages, end to end."""
    return np.frombuffer(b"".join(getattr(m, column) for m in messages), kind)


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each span, one span after the other."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))


def framed(messages: Iterable[tuple]) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for m in messages:
        held.append(m)
        size += sum(len(x) for x in m[4:] if x is not None)
        if size > FRAME:
            yield pd.DataFrame(held, columns=NAMES)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=NAMES)


def sent(rows: DataFrame, send: Callable[[pd.DataFrame], Iterable[tuple]]) -> DataFrame:
    """The messages that ``send`` makes of some ten thousands of rows at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= GATHERED:
                yield from framed(send(pd.concat(held, ignore_index=True)))
                held, size = [], 0
        if size:
            yield from framed(send(pd.concat(held, ignore_index=True)))

    return rows.mapInPandas(run, SCHEMA)


def told(state: DataFrame, say: Callable[[Any], Iterable[tuple]]) -> DataFrame:
    """The messages that ``say`` makes of each row of ``state``, without a shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                yield from framed(say(row))

    return state.mapInPandas(run, SCHEMA)


def turn(messages: DataFrame, blocks: int, step: Callable[[int, Got], Iterable[tuple]]) -> DataFrame:
    """The messages that ``step`` makes for each block of what has come for it."""

    def run(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got: Got = {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                got.setdefault(row.kind, []).append(row)
        yield from framed(step(int(key[0]), got))

    tasks = min(blocks, max(TASKS, -(-blocks // SHARED)))
    return messages.repartition(tasks, "block").groupBy("block").applyInPandas(run, SCHEMA)

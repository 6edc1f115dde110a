"""Approximate nearest neighbours: a neighbour graph by NN-descent, searched greedily.

NN-descent starts from rough neighbours (nodes on the same side of random hyperplanes) and improves them by the rule
that a neighbour's neighbour is likely a neighbour: every node introduces its neighbours (in both directions) to one
another, and each keeps the best it has met. A round brings the vectors of all whom a node introduces to the node's
block, compares within a bounded list per node, and keeps the best per receiver. Only pairs with at least one new neighbour are compared, and a node
introduces at most ``sample`` neighbours per direction and round; those not introduced now stay new and come later. Rounds
go on until hardly an edge is left to introduce.

A query walks the graph: the best nodes found so far are expanded to their neighbours until all of them are expanded.
All queries walk at once, one exchange of messages per step. Random partitions and starts of walks grow with the logarithm of the nodes.

Nodes and queries live in blocks (``blocks``): edges, views and vectors travel as arrays, one message per pair of blocks.

Equal vectors are one node, so that a vector that occurs very often neither fills neighbour lists nor makes a group; its
rows are put back at the end.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm import blocks
from tidegauge.session import settings, stored

#: Neighbours kept per node, and neighbours introduced per direction and round.
DEGREE, SAMPLE = 40, 20
#: Random partitions to start from at least, and the nodes of one of their groups on average.
TREES, GROUP = 4, 64
#: The graph is settled when no more than this share of its edges is still to be introduced.
SETTLED = 0.01
#: Nodes that a query keeps in view, and that it starts from at least besides its own.
VIEW, STARTS = 128, 24
#: Unexpanded nodes in view, the best, that a step of a walk expands.
EXPANDED = 16
#: Nodes of a block at most, bytes of the vectors that they introduce, and queries that walk in one block.
BLOCK_NODES, BLOCK_BYTES, BLOCK_QUERIES = 2048, 48 << 20, 128
#: Rows of groups on one side of hyperplanes that are worked on in one call, such calls in a task, nodes whose
#: introductions are computed together.
CALL_NODES, CALLS, TOGETHER = 8192, 4, 64
#: Shuffle files go when the round that needed them is over, not when the driver happens to collect its garbage.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, and not zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nodes(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """(members, nodes): (vec_id, node) of every usable row, and (node, vector, unit) of distinct vectors, both stored.

    A node is named by the smallest id of its rows. ``unit`` is the vector at unit length in 32-bit floats, for the graph;
    ``vector`` keeps the doubles that final scores are made of.
    """
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    kept = rows.filter(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("vec_id"), doubles.alias("vector")
    )

    @F.pandas_udf("binary")
    def unit(vectors: pd.Series) -> pd.Series:
        def one(v) -> bytes:
            v = np.asarray(v, np.float64)
            v = v / np.abs(v).max()  # keeps very large and very small vectors finite
            return (v / np.linalg.norm(v)).astype("<f4").tobytes()

        return vectors.map(one)

    single = kept.groupBy("vector").agg(F.min("vec_id").alias("node"))
    single = stored(single.select("node", "vector", unit("vector").alias("unit")), "vectors")
    members = stored(kept.join(single.select("node", "vector"), "vector").select("vec_id", "node"), "vector-members")
    return members, single


def _matrix(units) -> np.ndarray:
    return np.frombuffer(b"".join(units), "<f4").reshape(len(units), -1)


def _blocked(units: DataFrame) -> tuple[DataFrame, int]:
    """("v" messages (names, units) by home block, stored; the number of blocks) of (node, unit).

    A block has no more nodes than let the vectors of all whom they introduce in a round take ``BLOCK_BYTES``.
    """
    total, width = units.agg(F.count(F.lit(1)), F.coalesce(F.max(F.length("unit")), F.lit(4))).first()
    count = max(1, math.ceil(total / min(BLOCK_NODES, max(1, BLOCK_BYTES // (4 * SAMPLE * width)))))

    def send(batch: pd.DataFrame) -> Iterator[tuple]:
        names = batch["node"].to_numpy(np.int64)
        return blocks.dealt("v", 0, names, count, names, _matrix(batch["unit"]))

    def gathered(block: int, got: blocks.Got) -> Iterator[tuple]:
        names = blocks.joined(got["v"], "a", "i8")
        order = np.argsort(names)
        unit = blocks.joined(got["v"], "b", "<f4").reshape(len(names), -1)
        yield blocks.message(block, "v", 0, [names[order], unit[order]], len(names))

    placed = blocks.turn(blocks.sent(units.select("node", "unit"), send), count, gathered)
    return stored(placed, "neighbour-vectors"), count


def _found(names: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each key in the sorted names, whether it is there)."""
    at = np.minimum(np.searchsorted(names, keys), max(0, len(names) - 1))
    return at, names[at] == keys if len(names) else np.zeros(len(keys), bool)


def _best(
    n: int, most: int, row: np.ndarray, other: np.ndarray, score: np.ndarray, fresh: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(other, score, fresh), each ``n`` rows of ``most``: the best edges of each row; known ones stay known.

    Best come first, the smaller name of equal ones; a row with fewer edges ends with scores of minus infinity.
    """
    order = np.lexsort((other, row))
    row, other, score, fresh = row[order], other[order], score[order].astype("<f4"), fresh[order]
    first = blocks.run_starts(row, other)
    if len(first):
        score, fresh = np.maximum.reduceat(score, first), np.logical_and.reduceat(fresh, first)
    row, other = row[first].astype(np.int64), other[first]
    # The bits of floats, the lower ones of negative ones turned round, are in the order of the floats.
    bits = score.view("<i4")
    down = (1 << 31) - (bits ^ ((bits >> 31) & 0x7FFFFFFF)).astype(np.int64)
    order = np.argsort((row << 33) + down, kind="stable")
    place = blocks.places(row[order])
    order, place = order[place < most], place[place < most]
    out = np.zeros((n, most), np.int64), np.full((n, most), -np.inf, "<f4"), np.zeros((n, most), bool)
    for to, column in zip(out, (other, score, fresh)):
        to[row[order], place] = column[order]
    return out


def _thinned(to: np.ndarray, other: np.ndarray, score: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """The edges without those that can't be among the ``most`` best of their node, where a node has very many."""
    names, row, counts = np.unique(to, return_inverse=True, return_counts=True)
    many = counts[row] > 4 * most
    if not many.any():
        return to, other, score
    best, value, _ = _best(len(names), most, row[many], other[many], score[many], np.ones(many.sum(), bool))
    kept, place = np.nonzero(value > -np.inf)
    few = ~many
    return (
        np.concatenate([to[few], names[kept]]),
        np.concatenate([other[few], best[kept, place]]),
        np.concatenate([score[few], value[kept, place]]),
    )


def _edges(kind: str, to: np.ndarray, other: np.ndarray, score: np.ndarray, most: int, count: int) -> Iterator[tuple]:
    """Messages of edges to the homes of the nodes ``to``."""
    to, other, score = _thinned(to, other, score, most)
    return blocks.dealt(kind, 0, to, count, to, other, score.astype("<f4"))


def _edge_rows(messages: DataFrame) -> DataFrame:
    """(node, other, score) of the edges in "c" messages, or in the "g" messages of a graph."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for m in batch.itertuples(index=False):
                node, other = np.frombuffer(m.a, "i8"), np.frombuffer(m.b, "i8")
                score = np.frombuffer(m.c, "<f4")
                if m.kind == "g":
                    real = score > -np.inf
                    node, other, score = np.repeat(node, len(other) // len(node))[real], other[real], score[real]
                yield pd.DataFrame({"node": node, "other": other, "score": score.astype(np.float64)})

    return messages.mapInPandas(rows, "node long, other long, score double")


def _first_messages(units: DataFrame, degree: int, count: int) -> DataFrame:
    """"c" messages (node, other, score): the best neighbours of each node among those on its side of some random hyperplanes.

    Nodes with the same signs form a group; a group that is too large is cut by hash. This is done ``trees`` times, once
    per hyperplane of a partition, as more of them part more neighbours.
    """
    total = units.count()
    planes = max(1, int(math.log2(max(2, total / GROUP))))
    trees = max(TREES, planes)

    def coded(unit: np.ndarray, tree: int) -> np.ndarray:
        normals = np.random.default_rng(tree).normal(size=(unit.shape[1], planes))
        return (unit @ normals > 0) @ (1 << np.arange(planes))

    def sides(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                unit = _matrix(batch["unit"])
                for tree in range(trees):
                    yield pd.DataFrame({"tree": tree, "code": coded(unit, tree), "node": batch["node"], "unit": batch["unit"]})

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                unit = _matrix(batch["unit"])
                for tree in range(trees):
                    code, n = np.unique(coded(unit, tree), return_counts=True)
                    yield pd.DataFrame({"tree": tree, "code": code, "n": n})

    placed = units.select("node", "unit").mapInPandas(sides, "tree int, code long, node long, unit binary")
    crowd = units.select("unit").mapInPandas(counts, "tree int, code long, n long")
    crowd = crowd.groupBy("tree", "code").agg(F.sum("n").alias("n"))
    parts = F.ceil(F.col("n") / (2 * GROUP))
    cut = placed.join(crowd, ["tree", "code"]).withColumn("part", F.pmod(F.xxhash64("node", "tree"), parts))
    # Many groups are one call; a group of many parts is spread.
    calls = max(1, math.ceil(total * trees / CALL_NODES))
    cut = cut.withColumn("call", F.pmod(F.xxhash64("tree", "code", "part"), F.lit(calls)).cast("int"))

    def pairs(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches), ignore_index=True)
        names, unit = rows["node"].to_numpy(np.int64), _matrix(rows["unit"])
        group = [rows[c].to_numpy() for c in ("part", "code", "tree")]
        order = np.lexsort(group)
        starts = blocks.run_starts(*[g[order] for g in group])
        to, new, score = [], [], []
        for these in np.split(order, starts[1:]):
            few = min(degree // 2, len(these) - 1)
            if few > 0:
                scores = unit[these] @ unit[these].T
                np.fill_diagonal(scores, -2)
                best = np.argpartition(-scores, few - 1, axis=1)[:, :few]
                to.append(np.repeat(names[these], few))
                new.append(names[these][best].ravel())
                score.append(np.take_along_axis(scores, best, 1).ravel())
        if to:
            edges = np.concatenate(to), np.concatenate(new), np.concatenate(score)
            yield from blocks.framed(_edges("c", *edges, degree, count))

    dealt = cut.select("call", "tree", "code", "part", "node", "unit").repartition(max(1, calls // CALLS), "call")
    return dealt.groupBy("call").applyInPandas(pairs, blocks.SCHEMA)


def _first_edges(units: DataFrame, degree: int) -> DataFrame:
    """(node, other, score) of ``_first_messages``."""
    return _edge_rows(_first_messages(units, degree, 1))


def _graph(row: Any) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(names, other, score, fresh) of a "g" message: the nodes of a block in order and a row of edges of each."""
    names = np.frombuffer(row.a, "i8")
    other, score, fresh = (np.frombuffer(x, t).reshape(len(names), -1) for x, t in zip((row.b, row.c, row.d), ("i8", "<f4", "?")))
    return names, other, score, fresh


def _graph_message(block: int, names: np.ndarray, other: np.ndarray, score: np.ndarray, fresh: np.ndarray) -> tuple:
    return blocks.message(block, "g", fresh.sum(), [names, other, score, fresh], (score > -np.inf).sum())


def _chosen(
    names: np.ndarray, other: np.ndarray, score: np.ndarray, fresh: np.ndarray, sample: int, turn: int
) -> np.ndarray:
    """Which edges are introduced in this turn: ``sample`` of the fresh and of the known ones of each node, by hash."""
    key = blocks.mixed(blocks.mixed(names)[:, None] ^ other.view(np.uint64) ^ blocks.mixed(np.array([turn])))
    key >>= np.uint64(1)
    real, out = score > -np.inf, np.zeros(other.shape, bool)
    for kind in (fresh & real, ~fresh & real):
        ranked = np.where(kind, key, np.uint64(2**64 - 1))
        last = min(sample, ranked.shape[1]) - 1
        out |= kind & (ranked <= np.partition(ranked, last, axis=1)[:, last : last + 1])
    return out


def _introduced(graph: DataFrame, vectors: DataFrame, count: int, degree: int, sample: int, turn: int) -> DataFrame:
    """The graph after a round: what has been introduced is known, what has been found is among the best.

    Blocks tell the others of their nodes' edges, ask for the vectors of all whom their nodes introduce, and send what is
    worth it to the receiver's block.
    """

    def tell(row: Any) -> Iterator[tuple]:
        names, other, score, fresh = _graph(row)
        node, place = np.nonzero(_chosen(names, other, score, fresh, sample, turn))
        to = other[node, place]
        return blocks.dealt("r", row.block, to, count, to, names[node], fresh[node, place])

    def ask(block: int, got: blocks.Got) -> Iterator[tuple]:
        names, other, score, fresh = _graph(got["g"][0])
        node, place = np.nonzero(_chosen(names, other, score, fresh, sample, turn))
        met, new = other[node, place], fresh[node, place]
        if "r" in got:
            back, known = _found(names, blocks.joined(got["r"], "a", "i8"))
            behind, late = blocks.joined(got["r"], "b", "i8"), blocks.joined(got["r"], "c", "?")
            back, behind, late = back[known], behind[known], late[known]
            key = blocks.mixed(blocks.mixed(names)[back] ^ behind.view(np.uint64) ^ blocks.mixed(np.array([-turn])))
            order = np.lexsort((key, late, back))
            # A popular node is met by many: it introduces the first few of each kind in this round, others in later ones.
            order = order[blocks.places(back[order], late[order]) < sample]
            node, met, new = (np.concatenate(x) for x in ((node, back[order]), (met, behind[order]), (new, late[order])))
        order = np.lexsort((~new, met, node))
        order = order[blocks.run_starts(node[order], met[order])]
        # Who has nobody new to introduce introduces nobody.
        order = order[np.bincount(node[new], minlength=len(names))[node[order]] > 0]
        order = order[np.lexsort((~new[order], node[order]))]
        node, met, new = node[order], met[order], new[order]
        if len(node):
            rows, both = np.unique(node, return_counts=True)
            late = np.bincount(node[new], minlength=len(names))[rows]
            yield blocks.message(block, "m", 0, [late.astype("i4"), both.astype("i4"), met])
            asked = np.unique(met)
            yield from blocks.dealt("q", block, asked, count, asked)

    def answer(block: int, got: blocks.Got) -> Iterator[tuple]:
        for m in got.get("m", []):
            yield tuple(m)
        if "q" in got:
            names, _, score, _ = _graph(got["g"][0])
            unit = np.frombuffer(got["v"][0].b, "<f4").reshape(len(names), -1)
            # What a receiver already has as good is not worth sending: its worst kept score is the bar.
            bar = np.maximum(score[:, -1], np.float32(-2))
            for q in got["q"]:
                at = np.searchsorted(names, asked := np.frombuffer(q.a, "i8"))
                yield blocks.message(q.num, "w", block, [asked, unit[at], bar[at]])

    def introduce(block: int, got: blocks.Got) -> Iterator[tuple]:
        if "m" not in got:
            return
        (m,) = got["m"]
        late, both, met = np.frombuffer(m.a, "i4"), np.frombuffer(m.b, "i4"), np.frombuffer(m.c, "i8")
        names = blocks.joined(got["w"], "a", "i8")
        none = len(names)
        unit = np.zeros((none + 1, 2 * len(got["w"][0].b) // len(got["w"][0].a)), "<f4")
        at = 0
        for w in got["w"]:
            part = np.frombuffer(w.b, "<f4").reshape(-1, unit.shape[1])
            unit[at : at + len(part)] = part
            at += len(part)
        bar = np.append(blocks.joined(got["w"], "c", "<f4"), np.float32(np.inf))
        got.clear()
        order = np.argsort(names)
        spot = order[np.searchsorted(names[order], met)]
        starts = np.cumsum(both) - both
        to, new, value = [], [], []
        for i in range(0, len(both), TOGETHER):
            start, news, olds = starts[i : i + TOGETHER], late[i : i + TOGETHER], (both - late)[i : i + TOGETHER]
            left, right = (
                np.where(np.arange(most.max()) < most[:, None], spot[np.minimum(begin[:, None] + np.arange(most.max()), len(spot) - 1)], none)
                for begin, most in ((start, news), (start + news, olds))
            )
            every = np.concatenate([left, right], axis=1)
            vectors = unit[every]
            scores = np.matmul(vectors[:, : left.shape[1]], vectors.transpose(0, 2, 1))
            scores[left == none] = -3
            scores.transpose(0, 2, 1)[every == none] = -3
            scores[:, np.arange(left.shape[1]), np.arange(left.shape[1])] = -3  # nobody meets itself
            # The new ones get everybody, the known ones get the new ones.
            a, b, c = np.nonzero(scores > bar[left][:, :, None])
            to.append(left[a, b])
            new.append(every[a, c])
            value.append(scores[a, b, c])
            a, b, c = np.nonzero(scores[:, :, left.shape[1] :] > bar[right][:, None, :])
            to.append(right[a, c])
            new.append(left[a, b])
            value.append(scores[a, b, left.shape[1] + c])
        to, new, value = np.concatenate(to), np.concatenate(new), np.concatenate(value)
        if len(to):
            yield from _edges("c", names[to], names[new], value, degree, count)

    asked = blocks.turn(blocks.told(graph, tell).unionByName(graph), count, ask)
    answered = blocks.turn(asked.unionByName(graph).unionByName(vectors), count, answer)
    return _met(graph, blocks.turn(answered, count, introduce), count, degree, sample, turn)


def _met(graph: DataFrame, found: DataFrame, count: int, degree: int, sample: int = 0, turn: int = 0) -> DataFrame:
    """The graph with the "c" messages ``found`` taken in, and what was introduced in ``turn`` marked as known."""

    def take(block: int, got: blocks.Got) -> Iterator[tuple]:
        names, other, score, fresh = _graph(got["g"][0])
        if turn:
            fresh = fresh & ~_chosen(names, other, score, fresh, sample, turn)
        if "c" in got:
            node, place = np.nonzero(score > -np.inf)
            to, known = _found(names, blocks.joined(got["c"], "a", "i8"))
            new, value = blocks.joined(got["c"], "b", "i8"), blocks.joined(got["c"], "c", "<f4")
            other, score, fresh = _best(
                len(names),
                degree,
                np.concatenate([node, to[known]]),
                np.concatenate([other[node, place], new[known]]),
                np.concatenate([score[node, place], value[known]]),
                np.concatenate([fresh[node, place], np.ones(known.sum(), bool)]),
            )
        yield _graph_message(block, names, other, score, fresh)

    return blocks.turn(found.unionByName(graph), count, take)


def neighbour_graph(
    units: DataFrame, degree: int = DEGREE, sample: int = SAMPLE, settled: float = SETTLED
) -> DataFrame:
    """(node, other, score): about the ``degree`` nearest of each node by cosine, by NN-descent over (node, unit).

    Lists only get better and there are finitely many, so the rounds end.
    """
    vectors, count = _blocked(units)

    def bare(row: Any) -> Iterator[tuple]:
        names = np.frombuffer(row.a, "i8")
        none = np.zeros((len(names), degree), np.int64)
        yield _graph_message(row.block, names, none, np.full(none.shape, -np.inf, "<f4"), none > 0)

    with settings(units.sparkSession, TIDY):
        graph = stored(_met(blocks.told(vectors, bare), _first_messages(units, degree, count), count, degree), "neighbours")
        turn = 0
        while True:
            fresh, edges = graph.agg(F.sum("num"), F.sum("total")).first()
            if (fresh or 0) <= settled * (edges or 0):
                break
            turn += 1
            graph = stored(_introduced(graph, vectors, count, degree, sample, turn), "neighbours")
    return _edge_rows(graph)


def searched(
    queries: DataFrame,
    vectors: DataFrame,
    graph: DataFrame,
    view: int = VIEW,
    starts: int | None = None,
    expanded: int = EXPANDED,
) -> DataFrame:
    """(query, node, score) of the nodes in each query's view at the end of its walk.

    ``queries`` has (query, unit, entry), ``vectors`` (node, unit): the walk starts at ``entry`` (may be null) and at ``starts`` nodes that are
    the same for all queries, by default four per doubling of the nodes. Edges are walked in both directions. A walk ends when
    every node in view is expanded; as a node is expanded once at most, it does end.

    Only the view of a query is kept: what has once been too far for it is too far whenever it is reached again.
    """
    if starts is None:
        starts = max(STARTS, 4 * math.ceil(math.log2(max(2, vectors.count()))))
    homes, count = _blocked(vectors)
    walkers = max(1, math.ceil(queries.count() / BLOCK_QUERIES))

    def both_ways(batch: pd.DataFrame) -> Iterator[tuple]:
        node, other = batch["node"].to_numpy(np.int64), batch["other"].to_numpy(np.int64)
        score = batch["score"].to_numpy("<f4")
        there, back = np.concatenate([node, other]), np.concatenate([other, node])
        return _edges("c", there, back, np.concatenate([score, score]), 2 * DEGREE, count)

    def linked(block: int, got: blocks.Got) -> Iterator[tuple]:
        # A node that many others point to is left by its nearest edges only.
        names, row = np.unique(blocks.joined(got["c"], "a", "i8"), return_inverse=True)
        other, score = blocks.joined(got["c"], "b", "i8"), blocks.joined(got["c"], "c", "<f4")
        other, score, _ = _best(len(names), 2 * DEGREE, row, other, score, np.ones(len(row), bool))
        real = score > -np.inf
        yield blocks.message(block, "l", 0, [names, real.sum(axis=1).astype("i4"), other[real]])

    common = vectors.orderBy(F.xxhash64("node")).limit(starts).select("node")
    sown = np.array([r["node"] for r in common.collect()], np.int64)

    def enter(batch: pd.DataFrame) -> Iterator[tuple]:
        names = batch["query"].to_numpy(np.int64)
        entry, known = batch["entry"].to_numpy(np.int64), batch["known"].to_numpy(bool)
        return blocks.dealt("e", 0, names, walkers, names, _matrix(batch["unit"]), entry, known)

    def begun(block: int, got: blocks.Got) -> Iterator[tuple]:
        """The queries of a block with nothing in view yet, and what they look at first."""
        names, first = np.unique(blocks.joined(got["e"], "a", "i8"), return_index=True)
        unit = np.concatenate([np.frombuffer(m.b, "<f4").reshape(len(m.a) // 8, -1) for m in got["e"]])[first]
        entry, known = blocks.joined(got["e"], "c", "i8")[first], blocks.joined(got["e"], "d", "?")[first]
        none = np.full((len(names), view), -np.inf, "<f4")
        yield blocks.message(block, "s", 0, [names, unit, np.zeros(none.shape, np.int64), none, none > 0])
        query = np.concatenate([np.flatnonzero(known), np.repeat(np.arange(len(names)), len(sown))])
        node = np.concatenate([entry[known], np.tile(sown, len(names))])
        order = np.lexsort((node, query))
        order = order[blocks.run_starts(query[order], node[order])]
        yield from look(block, query[order], node[order], unit, none[:, -1])

    def look(block: int, query: np.ndarray, node: np.ndarray, unit: np.ndarray, bar: np.ndarray) -> Iterator[tuple]:
        """Messages to the nodes' homes: which queries look at which nodes, the queries' vectors, their worst scores in view."""
        for home, these in blocks.shares(node, count):
            who, which = np.unique(query[these], return_inverse=True)
            yield blocks.message(home, "k", block, [who.astype("i4"), unit[who], bar[who], which.astype("i4"), node[these]])

    def state(row: Any) -> tuple[np.ndarray, ...]:
        """(query, unit, node, score, open, now) of an "s" message: the queries, their views, what is yet to be expanded, what next."""
        names = np.frombuffer(row.a, "i8")
        unit, node, score, still = (
            np.frombuffer(x, t).reshape(len(names), -1) for x, t in zip((row.b, row.c, row.d, row.e), ("<f4", "i8", "<f4", "?"))
        )
        return names, unit, node, score, still, still & (np.cumsum(still, axis=1) <= expanded)

    def step(row: Any) -> Iterator[tuple]:
        _, _, node, _, _, now = state(row)
        front = np.unique(node[now])
        return blocks.dealt("f", row.block, front, count, front)

    def leave(block: int, got: blocks.Got) -> Iterator[tuple]:
        """The neighbours of nodes asked for."""
        if "f" not in got or "l" not in got:
            return
        (m,) = got["l"]
        names, n, other = np.frombuffer(m.a, "i8"), np.frombuffer(m.b, "i4").astype(np.int64), np.frombuffer(m.c, "i8")
        begin = np.cumsum(n) - n
        for f in got["f"]:
            front = np.frombuffer(f.a, "i8")
            at, known = _found(names, front)
            front, at = front[known], at[known]
            yield blocks.message(f.num, "o", block, [front, n[at], other[blocks.spans(begin[at], n[at])]])

    def reach(block: int, got: blocks.Got) -> Iterator[tuple]:
        """Looks at the neighbours of the expanded nodes that are not in view."""
        if "o" not in got:
            return
        _, unit, node, score, _, now = state(got["s"][0])
        front, n = blocks.joined(got["o"], "a", "i8"), blocks.joined(got["o"], "b", "i8")
        others, spot = np.unique(blocks.joined(got["o"], "c", "i8"), return_inverse=True)
        order, begin = np.argsort(front), np.cumsum(n) - n
        query, place = np.nonzero(now)
        at, known = _found(front[order], node[query, place])
        query, at = query[known], order[at[known]]
        pairs = np.unique(np.repeat(query, n[at]) * len(others) + spot[blocks.spans(begin[at], n[at])])
        query, place = np.nonzero(score > -np.inf)
        at, known = _found(others, node[query, place])
        pairs = np.setdiff1d(pairs, query[known] * len(others) + at[known], assume_unique=True)
        yield from look(block, pairs // max(1, len(others)), others[pairs % max(1, len(others))], unit, score[:, -1])

    def measure(block: int, got: blocks.Got) -> Iterator[tuple]:
        """The scores of nodes looked at that may come into view."""
        if "k" not in got or "v" not in got:
            return
        (v,) = got["v"]
        names = np.frombuffer(v.a, "i8")
        unit = np.frombuffer(v.b, "<f4").reshape(len(names), -1)
        for k in got["k"]:
            who, which, node = np.frombuffer(k.a, "i4"), np.frombuffer(k.d, "i4"), np.frombuffer(k.e, "i8")
            asked, bar = np.frombuffer(k.b, "<f4").reshape(len(who), -1), np.frombuffer(k.c, "<f4")
            at, known = _found(names, node)
            which, node, at = which[known], node[known], at[known]
            score = np.concatenate(
                [np.zeros(0, "<f4")]
                + [np.einsum("ij,ij->i", unit[at[i : i + 8192]], asked[which[i : i + 8192]]) for i in range(0, len(at), 8192)]
            )
            near = score >= bar[which]
            if near.any():
                yield blocks.message(k.num, "t", block, [who[which[near]], node[near], score[near]])

    def see(block: int, got: blocks.Got) -> Iterator[tuple]:
        """The queries with the best of what they had in view and of what they looked at."""
        names, unit, node, score, still, now = state(got["s"][0])
        still = still & ~now
        if "t" in got:
            query, place = np.nonzero(score > -np.inf)
            who = blocks.joined(got["t"], "a", "i4")
            node, score, still = _best(
                len(names),
                view,
                np.concatenate([query, who]),
                np.concatenate([node[query, place], blocks.joined(got["t"], "b", "i8")]),
                np.concatenate([score[query, place], blocks.joined(got["t"], "c", "<f4")]),
                np.concatenate([still[query, place], np.ones(len(who), bool)]),
            )
        yield blocks.message(block, "s", still.any(axis=1).sum(), [names, unit, node, score, still])

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for m in batch.itertuples(index=False):
                names, _, node, score, _, _ = state(m)
                query, place = np.nonzero(score > -np.inf)
                yield pd.DataFrame({"query": names[query], "node": node[query, place], "score": score[query, place].astype(np.float64)})

    with settings(vectors.sparkSession, TIDY):
        ways = stored(blocks.turn(blocks.sent(graph.select("node", "other", "score"), both_ways), count, linked), "neighbour-ways")
        entry = F.coalesce("entry", F.lit(0).cast("long")).alias("entry")
        entered = blocks.sent(queries.select("query", "unit", entry, F.col("entry").isNotNull().alias("known")), enter)
        first = stored(blocks.turn(entered, walkers, begun), "neighbour-queries")
        seen, looks = first.filter("kind = 's'"), first.filter("kind = 'k'")
        while True:
            measured = blocks.turn(looks.unionByName(homes), count, measure)
            seen = stored(blocks.turn(measured.unionByName(seen), walkers, see), "neighbour-view")
            if not seen.agg(F.sum("num")).first()[0]:
                break
            left = blocks.turn(blocks.told(seen, step).unionByName(ways), count, leave)
            looks = blocks.turn(left.unionByName(seen), walkers, reach)
    return seen.mapInPandas(rows, "query long, node long, score double")


def nearest(
    rows: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest rows found for every query row: (query_id, rank, vec_id, score).

    Nearness is the cosine in double precision of the vectors as given; ties go to the smaller id. Vectors that are null,
    zero, or hold null or non-finite components take no part, nor do rows without an id; vectors of different lengths
    must not be mixed. With fewer than ``k`` other rows a query gets them all. Rows repeated under one id are one row.
    An empty table gives an empty result.
    """
    members, vectors = nodes(rows, vec_id, vector)
    members = members.distinct()
    units = vectors.select("node", "unit")
    graph = stored(neighbour_graph(units), "neighbour-graph")
    asked = members.join(
        rows.filter(is_query).select(F.col(vec_id).cast("long").alias("vec_id")).distinct(), "vec_id", "left_semi"
    ).select(F.col("vec_id").alias("query"), F.col("node").alias("entry"))
    # Queries with the same vector walk once.
    walks = asked.select("entry").distinct().join(vectors, F.col("entry") == F.col("node"))
    walks = walks.select(F.col("entry").alias("query"), "unit", "entry")
    found = searched(walks, units, graph)
    own = walks.select("query", F.col("entry").alias("node"), F.lit(1.0).alias("score"))
    met = stored(found.join(own.select("query", "node"), ["query", "node"], "left_anti").unionByName(own), "neighbour-met")

    # Each node stands for its k + 1 smallest rows at most: more cannot be among a query's nearest. They are numbered
    # within small cells of a node first, so that no task sorts all rows of a common vector.
    cell = Window.partitionBy("node", F.pmod(F.xxhash64("vec_id"), F.lit(256))).orderBy("vec_id")
    few = members.withColumn("nth", F.row_number().over(cell)).filter(F.col("nth") <= k + 1)
    of_node = Window.partitionBy("node").orderBy("vec_id")
    few = few.withColumn("nth", F.row_number().over(of_node)).filter(F.col("nth") <= k + 1).select("node", "vec_id")
    reach = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    close = met.withColumn("place", F.row_number().over(reach)).filter(F.col("place") <= 4 * (k + 1))
    pairs = (
        asked.select(F.col("query").alias("query_id"), F.col("entry"))
        .join(close.select(F.col("query").alias("entry"), "node"), "entry")
        .join(few, "node")
        .filter(F.col("vec_id") != F.col("query_id"))
    )

    @F.pandas_udf("double")
    def exactly(a: pd.Series, b: pd.Series) -> pd.Series:
        out = np.empty(len(a))
        for i, (x, y) in enumerate(zip(a, b)):
            x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
            out[i] = np.dot(x, y) / (np.linalg.norm(x) * np.linalg.norm(y))
        return pd.Series(out)

    entry_vectors = vectors.select(F.col("node").alias("entry"), F.col("vector").alias("asked"))
    final = pairs.join(vectors.select("node", "vector"), "node").join(entry_vectors, "entry")
    final = final.select("query_id", "vec_id", exactly("vector", "asked").alias("score"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        final.withColumn("rank", F.row_number().over(rank))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )

"""Fingerprints, shards, mixtures, joins, neighbours: against brute force on small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.llm.conftest import ODD
from tests.oracle import compare, connect
from tidegauge.llm import blocks, components, fingerprints, mixing, neighbours, ngram_join, sharding, words


def text_of(r):
    return r["text"] or ""


def test_fingerprints(docs):
    table = docs.select("doc_id", "text").collect()
    order = sorted(table, key=lambda r: -r["doc_id"])
    found = {r["doc_id"]: r for r in fingerprints.edited(docs).collect()}
    plain = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprinted(docs).collect()}
    assert len(found) == len(table)
    changed = []
    for i, r in enumerate(order):
        text, following = text_of(r), text_of(order[(i + 1) % len(order)])
        third = len(text) // 3
        new = text[: len(text) - third] + following[:third]
        got = found[r["doc_id"]]
        assert got["n_chars"] == len(text) and got["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert got["fingerprint"] == plain[r["doc_id"]]
        changed.append((r["doc_id"], new))
    # The edited fingerprint, made by subtracting and adding vectors, is that of the edited text.
    again = docs.sparkSession.createDataFrame(changed, "doc_id long, text string")
    direct = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprinted(again).collect()}
    assert direct == {i: r["edited_fingerprint"] for i, r in found.items()}
    assert len(set(plain.values())) == len({text_of(r) for r in table})
    nearer = sum(r["near_edited"] > r["near_next"] for r in found.values())
    assert nearer >= 0.95 * len(found)


def test_fingerprints_forget_order(workers):
    texts = ["a b.\nc d.\n\ne", "e\n\nc d.\na b.", "a b.\nc d.\ne", "", None]
    table = workers.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprinted(table).collect()}
    assert found[0] == found[1] != found[2] and found[3] == found[4]


def test_fingerprint_likeness(workers):
    """Against the exact likeness of the clause multisets; sums of very many equal clauses do not wrap."""
    texts = ["same line.\n" * 100_000, "same line.\n" * 50_000, "a, b, c, d", "a, b, c, x", "p; q; r", "a, b, c, d"]
    table = workers.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sums = fingerprints.summed(table, "text", "sums")
    pairs = sums.alias("l").join(sums.alias("r"), F.expr("l.doc_id <= r.doc_id"))
    pairs = pairs.select(F.col("l.doc_id").alias("i"), F.col("r.doc_id").alias("j"), F.col("l.sums").alias("a"), F.col("r.sums").alias("b"))

    def exact(one, other):
        a, b = (Counter(re.split(fingerprints.CLAUSE_END, t)) for t in (one, other))
        squares = sum(n * n for n in a.values()) + sum(n * n for n in b.values())
        return 2 * sum(n * b[c] for c, n in a.items()) / squares

    for r in fingerprints.with_likeness(pairs, "a", "b", "near").collect():
        one, other = texts[r["i"]], texts[r["j"]]
        want = exact(one, other)
        assert r["near"] == 1.0 if one == other else abs(r["near"] - want) < 0.25
        if {r["i"], r["j"]} == {0, 1}:
            assert abs(r["near"] - 0.8) < 1e-3


def test_fingerprints_odd(odd, empty):
    found = fingerprints.edited(odd).collect()
    assert len(found) == len(ODD)
    assert all(0 <= r[c] <= 1 for r in found for c in ("near_edited", "near_next"))
    assert len({r["fingerprint"] for r in found if r["doc_id"] in (4, 5)}) == 1
    # After the last (a null id) comes the first by descending id.
    last = next(r for r in found if r["doc_id"] is None)
    text = ODD[9][1]
    third = len(text) // 3
    head = "Élan vital, déjà vu. Où est le café?"[:third]
    assert last["edited_sha256"] == hashlib.sha256((text[: len(text) - third] + head).encode()).hexdigest()
    assert fingerprints.edited(empty).count() == 0


def test_shards(docs, odd, empty):
    for table in (docs, odd):
        texts = table.select("doc_id", "text").collect()
        found = sharding.sharded(table, 5).collect()
        assert sorted((repr(r["doc_id"]), r["size"], r["text_crc32"]) for r in found) == sorted(
            (repr(r["doc_id"]), len(text_of(r).encode()) + 8, zlib.crc32(text_of(r).encode())) for r in texts
        )
        by_text = {}
        for r in found:
            by_text.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
        assert all(len(s) == 1 for s in by_text.values())
        for shard in {r["shard"] for r in found}:
            slots = sorted(r["slot"] for r in found if r["shard"] == shard)
            assert slots == list(range(len(slots)))
    loads = [0] * 5
    for r in sharding.sharded(docs, 5).collect():
        loads[r["shard"]] += r["size"]
    assert max(loads) - min(loads) <= 0.01 * sum(loads) / 5
    assert sharding.sharded(empty).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 1000), max_size=40), st.integers(1, 6))
def test_schedule_within_the_known_bound(sizes, shards):
    loads = [0] * shards
    for size, shard in zip(sizes, sharding.schedule(sizes, shards)):
        loads[shard] += size
    # Every shard but the fullest has at least what the fullest had before its last unit.
    if sizes:
        assert max(loads) <= sum(sizes) / shards + max(sizes)


def test_mixture_odd_against_sql(odd, tmp_path):
    folder = str(tmp_path)
    odd.write.parquet(f"{folder}/odd")
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{folder}/odd/*.parquet')")
    got = mixing.mixed(odd).select("doc_id", "size", "source_size", "target", "taken")
    assert compare(got, con, mixing.SQL) == ""


def test_mixture_targets(docs, empty):
    found = mixing.mixed(docs).collect()
    per = {}
    for r in found:
        per.setdefault(r["source"], []).append(r)
        assert 0 <= r["taken"] <= 3 * r["size"]
    for group in per.values():
        gap = abs(sum(r["taken"] for r in group) - group[0]["target"])
        assert gap <= max(r["size"] for r in group) / 2
    total = sum(r["size"] for r in found)
    assert math.isclose(sum(g[0]["target"] for g in per.values()), total, rel_tol=1e-9)
    assert rows(mixing.mixed(docs)) == rows(mixing.mixed(docs.repartition(5)))
    assert mixing.mixed(empty).count() == 0


def plain_sets(texts):
    sets = []
    for t in texts:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for c in "\n\t\r\x0b\x0c":
            words = words.replace(c, " ")
        words = [w for w in words.split(" ") if w]
        sets.append(frozenset([tuple(words)] if 0 < len(words) < 5 else [tuple(words[i : i + 5]) for i in range(len(words) - 4)]))
    return sets


def plain_links(sets):
    return {
        (i, j)
        for i in range(len(sets))
        for j in range(i + 1, len(sets))
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    }


def plain_groups(ids, sets):
    name = list(range(len(sets)))

    def top(x):
        while name[x] != x:
            x = name[x]
        return x

    for i, j in plain_links(sets):
        a, b = top(i), top(j)
        name[max(a, b)] = min(a, b)
    out = []
    for i in range(len(sets)):
        members = [ids[j] for j in range(len(sets)) if top(j) == top(i) and ids[j] is not None]
        out.append((ids[i], len(sets[i]), min(members, default=None) if sets[i] else ids[i]))
    return sorted(out, key=repr)


def varied(rng, base, changes):
    words = list(base)
    for _ in range(changes):
        words[rng.integers(len(words))] = f"w{rng.integers(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    """Groups of copies with more and more changes, a passage in most texts, short texts, and chains."""
    rng = np.random.default_rng(3)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = []
    for length in (3, 4, 6, 9, 13, 18, 24, 40, 90, 200):
        base = [f"b{length}x{i}" for i in range(length)]
        texts += [varied(rng, base, c) for c in [0, 0, *rng.integers(0, max(2, length // 12), 14)]]
    texts += [passage + " " + " ".join(f"u{k}x{i}" for i in range(int(rng.integers(1, 60)))) for k in range(60)]
    texts += [" ".join(f"p{i}" for i in range(int(rng.integers(25, 40)))) for _ in range(30)]
    chain = [f"c{i}" for i in range(120)]
    texts += [" ".join(chain[6 * k : 6 * k + 60]) for k in range(10)]
    return texts


@pytest.mark.parametrize("rare", [1, 4, 48])
def test_join_finds_every_link(workers, copies, rare):
    """Whatever counts as rare, each link between different sets has an index entry in common, in both indexes."""
    sets = plain_sets(copies)
    singles = {ngram_join.class_of(ngram_join.shingles(t)): i for i, t in reversed(list(enumerate(copies)))}
    tokens = {i: ngram_join.shingles(copies[i]) for i in singles.values()}
    values, counts = np.unique(np.concatenate(list(tokens.values())), return_counts=True)
    index = []
    for i, own in tokens.items():
        often = counts[np.searchsorted(values, own)]
        order = np.lexsort((own, often))
        shared = own[order][often[order] > 1]
        if len(own) and 4 * len(shared) >= 3 * len(own):
            few = int(np.count_nonzero((often > 1) & (often <= rare)))
            index.append((i, len(own), shared.view(np.int64).tolist(), few))
    table = workers.createDataFrame(index, "class long, n int, tokens array<long>, rare int")
    wide = table.withColumns({"low": F.ceil(F.col("n") * 0.75), "high": F.floor(F.col("n") / 0.75)})
    narrow = ngram_join.narrowed(table)
    for sized, combined in ((wide, True), (wide, False), (narrow, True), (narrow, False)):
        entries = {}
        for r in ngram_join.postings(sized, combined).collect():
            entries.setdefault(r["signature"], []).append(r["class"])
        candidates = {(i, j) for group in entries.values() for i in group for j in group if i != j}
        for i, j in plain_links(sets):
            if i in tokens and j in tokens and sets[i] != sets[j]:
                assert (i, j) in candidates


def test_join_groups(workers, copies):
    table = workers.createDataFrame(list(enumerate(copies)), "doc_id long, text string").repartition(4)
    assert rows(ngram_join.linked(table)) == plain_groups(list(range(len(copies))), plain_sets(copies))
    index = ngram_join.prepared(table, "doc_id", "text")[1]
    names = {ngram_join.class_of(ngram_join.shingles(t)): s for t, s in zip(copies, plain_sets(copies))}
    got = {frozenset((names[r["a"]], names[r["b"]])) for r in ngram_join.links(index).collect()}
    distinct = list(dict.fromkeys(names.values()))
    assert got == {frozenset((distinct[i], distinct[j])) for i, j in plain_links(distinct)}


def test_join_documents(docs):
    table = docs.select("doc_id", "text").orderBy("doc_id").collect()
    want = plain_groups([r["doc_id"] for r in table], plain_sets([r["text"] for r in table]))
    assert rows(ngram_join.linked(docs)) == want


def test_join_odd(odd, empty):
    want = plain_groups([r[0] for r in ODD], plain_sets([r[1] for r in ODD]))
    assert rows(ngram_join.linked(odd)) == want
    assert ngram_join.linked(empty).count() == 0


def test_join_splits_long_texts(monkeypatch):
    text = "ab cd\tef\ngh  ij kl " * 50 + "x" * 300 + " end"
    whole = ngram_join.word_hashes(text)
    monkeypatch.setattr(words, "PIECE", 16)
    assert ngram_join.word_hashes(text).tolist() == whole.tolist()


def test_join_compares_whole_tokens(workers):
    """One shingle each, nothing in common: also among very many tokens none of them may be taken for another."""
    texts = [(i, f"q1 q2 q3 q4 z{i}") for i in [2265975, 2356712, *range(30_000)]]
    found = ngram_join.linked(workers.createDataFrame(texts, "doc_id long, text string"))
    assert found.filter("doc_id <> component_id").count() == 0
    many = ngram_join.mix(np.arange(3_000_000, dtype=np.uint64))
    assert len(np.unique(many)) == len(many)


def test_mixture_prefers_long_documents(workers):
    """Inclusion odds follow the size: of a source that is not taken whole, long documents are drawn more often."""
    texts = [(i, " ".join(["w"] * (10 if i % 2 else 100)), "ab"[i % 20 == 0]) for i in range(4000)]
    docs = workers.createDataFrame(texts, "doc_id long, text string, source string")
    found = [r for r in mixing.mixed(docs, weights=(1, 8)).collect() if r["source"] == "a"]
    rest = [(r["size"], r["times"]) for r in found]
    short, long = ([t for s, t in rest if s == size] for size in (10, 100))
    assert sum(long) / len(long) > 1.5 * sum(short) / len(short)
    assert abs(sum(r["taken"] for r in found) - found[0]["target"]) <= 50


def test_components(workers):
    links = [(1, 2), (2, 3), (5, 4), (4, 6), (6, 7), (9, 9)] + [(i, i + 1) for i in range(20, 60)] + [(60, 20)]
    found = components.components(workers.createDataFrame(links, "x long, y long"), "x", "y")
    want = {**{i: 1 for i in (1, 2, 3)}, **{i: 4 for i in (4, 5, 6, 7)}, **{i: 20 for i in range(20, 61)}}
    assert {r["node"]: r["component"] for r in found.collect()} == want
    assert components.components(workers.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def plain_nearest(ids, vectors, queries, k):
    out = {}
    for q in queries:
        a = vectors[q]
        scores = [
            (-float(np.dot(a, v) / (np.linalg.norm(a) * np.linalg.norm(v))), i) for i, v in vectors.items() if i != q
        ]
        out[q] = sorted(scores)[:k]
    return out


def test_neighbours_recall(workers):
    table = workers.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in table.collect()}
    found = neighbours.nearest(table, F.col("vec_id") % 50 == 0).collect()
    want = plain_nearest(list(vectors), vectors, [i for i in vectors if i % 50 == 0], 5)
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r)
    hits = sum(len({r["vec_id"] for r in got[q]} & {i for _, i in w}) for q, w in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, group in got.items():
        assert [r["rank"] for r in group] == [1, 2, 3, 4, 5]
        for r in group:
            a, b = vectors[q], vectors[r["vec_id"]]
            assert math.isclose(r["score"], np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)), abs_tol=1e-12)


def test_neighbours_odd(workers):
    nan, inf = float("nan"), float("inf")
    some = [(i, [float(i), 1.0, 0.5], "clash") for i in range(8)]
    bad = [(20, None, "x"), (21, [0.0, 0.0, 0.0], "x"), (22, [nan, 1.0, 1.0], "x"), (23, [inf, 1.0, 1.0], "x"), (24, [None, 1.0, 1.0], "x"), (None, [1.0, 1.0, 1.0], "x")]
    equal = [(100 + i, [3.0, 1.0, 0.5], "x") for i in range(30)] + [(3, [3.0, 1.0, 0.5], "clash")]
    schema = "vec_id long, embedding array<float>, score string"
    table = workers.createDataFrame(some + bad + equal, schema)
    found = neighbours.nearest(table, F.col("vec_id") % 50 == 0)
    vectors = {i: np.array(v) for i, v, _ in some + equal}
    want = plain_nearest(list(vectors), vectors, [0, 100], 5)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in found.collect()}
    for q, nearest in want.items():
        assert [got[q, n + 1][0] for n in range(5)] == [i for _, i in sorted((round(s, 9), i) for s, i in nearest)]
    two = workers.createDataFrame(some[:2], schema)
    assert rows(neighbours.nearest(two, F.col("vec_id") == 0).select("query_id", "rank", "vec_id")) == [(0, 1, 1)]
    assert neighbours.nearest(table.limit(0), F.lit(True)).count() == 0


def test_walks_go_on_until_all_in_view_is_expanded(workers):
    """A chain of nodes, entered at one end by a query that is nearest to the other end."""
    names = [r["node"] for r in workers.range(15).select(F.col("id").alias("node")).orderBy(F.xxhash64("node")).collect()]
    spots = {n: np.array([math.cos(0.1 * i), math.sin(0.1 * i)], "<f4") for i, n in enumerate(names)}
    units = workers.createDataFrame([(n, bytearray(v.tobytes())) for n, v in spots.items()], "node long, unit binary")
    edges = [(a, b, float(spots[a] @ spots[b])) for a, b in zip(names, names[1:])]
    graph = workers.createDataFrame(edges, "node long, other long, score double")
    asked = units.filter(F.col("node") == names[-1]).select(F.lit(-1).cast("long").alias("query"), "unit", F.lit(names[0]).alias("entry"))
    found = neighbours.searched(asked, units, graph, starts=1).collect()
    assert {r["node"] for r in found} == set(names)


def test_partitions_of_more_nodes_are_more(workers):
    def first(n):
        vectors = np.random.default_rng(5).normal(size=(n, 8)).astype("<f4")
        units = workers.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(vectors)], "node long, unit binary")
        return neighbours._first_edges(units, 4).groupBy("node", "other").count().count() / n

    # Each partition adds to the distinct edges of a node, two per partition at most.
    assert first(64 << 7) > 2 * 4.5 > first(64 << 4)


def test_neighbours_travel_in_messages(workers, monkeypatch):
    """Lists, views and vectors are arrays of a block, so that rows are far fewer than edges."""
    sizes = {}
    stored = neighbours.stored

    def counted(df, name):
        out = stored(df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(neighbours, "stored", counted)
    vectors = np.random.default_rng(7).normal(size=(3000, 16))
    table = workers.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(table, F.col("vec_id") % 500 == 0).collect()
    want = plain_nearest(list(range(3000)), dict(enumerate(vectors)), range(0, 3000, 500), 5)
    hits = sum((r["vec_id"] in {i for _, i in want[r["query_id"]]}) for r in found)
    assert len(found) == 30 and hits >= 27
    # 3,000 nodes with up to 40 edges each, 6 queries with up to 128 nodes in view each.
    assert sizes.pop("neighbours") <= 8 and sizes["neighbour-view"] <= 8 and sizes["neighbour-ways"] <= 8


def test_best_edges_of_a_row():
    random = np.random.default_rng(3)
    row, other = random.integers(0, 20, 4000), random.integers(-30, 30, 4000)
    score, fresh = (random.integers(-8, 9, 4000) / 8).astype("<f4"), random.random(4000) < 0.5
    got = neighbours._best(20, 12, row, other, score, fresh)
    for n in range(20):
        best = {}
        for o, v, f in zip(other[row == n], score[row == n], fresh[row == n]):
            v0, f0 = best.get(o, (v, f))
            best[o] = (max(v, v0), f and f0)
        want = sorted(((-v, o, f) for o, (v, f) in best.items()), key=lambda x: x[:2])[:12]
        assert [(-v, o, f) for o, v, f in zip(*(x[n] for x in got))] == want


def test_very_many_edges_are_thinned_to_the_best():
    to, other = np.repeat([1, 2], [1000, 5]), np.arange(1005)
    score = (np.arange(1005) / 1005).astype("<f4")
    node, kept, value = neighbours._thinned(to, other, score, 4)
    assert sorted(zip(node, kept)) == [(1, 996), (1, 997), (1, 998), (1, 999)] + [(2, i) for i in range(1000, 1005)]
    assert all(value == score[kept])


def test_shares_are_the_same_wherever_they_are_made():
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    home = {k: b for b, these in blocks.shares(keys, 7) for k in keys[these]}
    again = {k: b for b, these in blocks.shares(keys[::-3], 7) for k in keys[::-3][these]}
    assert len(home) == len(set(keys)) and again.items() <= home.items() and set(home.values()) == set(range(7))


def test_native_operators_run_no_python(docs):
    for found in (fingerprints.edited(docs), mixing.mixed(docs)):
        text = found._jdf.queryExecution().executedPlan().toString()
        assert not any(word in text for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))

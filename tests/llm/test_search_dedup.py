"""Presence-mask search and difference-cover dedup against brute force; both also run against SQL with the other queries."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.conftest import rows
from tidegauge.llm import lexical_search, substring_dedup, words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def best_documents(items, docs, k=10):
    bodies = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    bodies = [(d, c) for d, c in bodies if c]
    n_docs, words = len(bodies), sum(c.total() for _, c in bodies)
    holding = Counter(t for _, c in bodies for t in c)
    for item, text in items:
        found = []
        for d, c in bodies:
            m = 25 + 75 * c.total() * n_docs // words
            score = 0
            for t in TERM.findall((text or "").translate(LOWER)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[t] + 1)))
                    score += w * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        for rank, (score, _, _, d) in enumerate(sorted(found)[:k], 1):
            yield item, rank, d, -score


def kept_words(docs, window):
    bodies = [(d, WORD.findall(t or "")) for d, t in docs]
    first = {}
    for d, words in bodies:
        for i in range(len(words) - window + 1):
            key, at = tuple(words[i : i + window]), (d is None, d or 0, i)
            first[key] = min(first.get(key, at), at)
    for d, words in bodies:
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < (d is None, d or 0, i):
                gone.update(range(i, i + window))
        yield d, words, [i for i in range(len(words)) if i not in gone]


def random_texts(n, seed, words):
    pick = random.Random(seed)
    phrases = [[f"w{pick.randrange(words)}" for _ in range(pick.randrange(3, 60))] for _ in range(12)]
    for _ in range(n):
        parts = []
        for _ in range(pick.randrange(0, 6)):
            phrase = pick.choice(phrases)
            cut = pick.randrange(len(phrase))
            parts += phrase[cut:] if pick.random() < 0.5 else phrase
            parts += [f"w{pick.randrange(words)}" for _ in range(pick.randrange(4))]
        yield pick.choice([" ", "\n", " \t"]).join(parts)


@pytest.mark.parametrize("window", [3, 8, 13, 20, 40])
def test_dedup_as_brute_force(workers, odd, window):
    texts = [r for r in odd.select("doc_id", "text").collect() if r["text"] is None or len(r["text"]) < 1000]
    texts = [tuple(r) for r in texts] + [(100 + i % 150, t) for i, t in enumerate(random_texts(200, window, 30))]
    table = workers.createDataFrame(texts, "doc_id long, text string").repartition(7)
    want = []
    for d, words, left in kept_words(texts, window):
        body = " ".join(words[i] for i in left)
        want.append((d, len(words), len(words) - len(left), hashlib.sha256(body.encode()).hexdigest()))
    assert rows(substring_dedup.kept_digests(table, window=window)) == sorted(want, key=repr)


def test_dedup_returns_texts_and_runs(workers):
    texts = [(i, t) for i, t in enumerate(random_texts(60, 5, 25))]
    got = {r["doc_id"]: r for r in substring_dedup.without_repeats(workers.createDataFrame(texts, "doc_id long, text string")).collect()}
    for d, words, left in kept_words(texts, 20):
        r = got[d]
        assert r["kept"] == " ".join(words[i] for i in left)
        gone = [i for s, e in r["removed"] for i in range(s, e)]
        assert sorted(gone + left) == list(range(len(words))) and r["n_removed"] == len(gone)


def test_dedup_of_odd_and_empty_tables(odd, empty):
    got = rows(substring_dedup.kept_digests(odd))
    assert len(got) == odd.count()
    # The third of the long text's 13 * 977 words starts again after as many words.
    assert {r[0]: r[2] for r in got}[6] > 0
    assert substring_dedup.kept_digests(empty).collect() == []


def test_covers_hold_every_difference():
    for period, cover in substring_dedup.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_run_hashes_depend_on_words_only():
    raw = np.frombuffer(b"a bb a bb  a\nbb ab b ", np.uint8)
    hashes = words.word_hashes(raw, *words.word_places(raw))
    pairs = words.run_hashes(hashes, 2, words.Powers(substring_dedup.WORD))
    assert pairs[0] == pairs[2] == pairs[4] and len(set(pairs.tolist())) == 4


def test_search_as_brute_force(workers, docs, odd):
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect() + odd.select("doc_id", "text").collect()]
    items = [(i, " ".join((t or "").split()[3:30])) for i, (_, t) in enumerate(texts[::7])]
    # More than 64 distinct terms, repeated terms, none, null, and terms that are nowhere.
    items += [(900, " ".join((texts[0][1] or "").split() * 2)), (901, None), (902, "?!"), (903, "THE the nowhere"), (903, "THE the nowhere")]
    table = workers.createDataFrame(texts, "doc_id long, text string").repartition(5)
    asked = workers.createDataFrame(items, "item_id long, text string")
    for k in (1, 10):
        want = sorted(best_documents(items, texts, k), key=repr)
        assert rows(lexical_search.ranked(asked, table, k=k)) == want


def test_search_of_empty_tables(workers, docs, empty):
    items = workers.createDataFrame([(1, "the")], "item_id long, text string")
    assert lexical_search.ranked(items, empty).collect() == []
    assert lexical_search.ranked(items.limit(0), docs).collect() == []


def test_search_in_blocks_of_items(workers, docs, monkeypatch):
    items = docs.limit(7).selectExpr("doc_id as item_id", "substr(text, 1, 200) as text")
    whole = rows(lexical_search.ranked(items, docs))
    monkeypatch.setattr(lexical_search, "ITEMS", 3)
    assert rows(lexical_search.ranked(items, docs)) == whole

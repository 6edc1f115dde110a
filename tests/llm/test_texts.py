"""Licences, token counts, BPE, language, toxicity: against brute force, the tokenizer library, and held-out labels."""

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import rows
from tests.llm.conftest import ODD
from tidegauge.llm import bpe, language, licences, token_counts, toxicity

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def coder():
    spec = bpe.load(WORDS)
    return bpe.Encoder(spec), bpe.Decoder(spec)


def digests(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    back = tokenizer.decode(ids, skip_special_tokens=False)
    raw = np.array(ids, "<u4").tobytes()
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_bpe_as_the_library(request, library, which):
    table = request.getfixturevalue(which)
    texts = table.select("doc_id", "text").collect()
    got = rows(bpe.token_digests(table, WORDS))
    assert got == sorted(((r["doc_id"], *digests(library, r["text"])) for r in texts), key=repr)


def test_bpe_round_trip_of_ids(docs):
    few = docs.limit(20)
    tokens = bpe.encoded(few, WORDS)
    texts = {r["doc_id"]: r["text"] for r in bpe.decoded(tokens, WORDS).collect()}
    library = Tokenizer.from_file(WORDS)
    for r in tokens.collect():
        assert texts[r["doc_id"]] == library.decode(r["ids"], skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdefghij stlnrRE'\n.,!<|>0123äéßñ日本½ΣİǺ", max_size=60))
def test_bpe_any_text(library, coder, text):
    encoder, decoder = coder
    ids = np.frombuffer(encoder.encode(text), "<u4")
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert decoder.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcdenrst", min_size=1, max_size=14))
def test_backtracking_equals_merging(coder, word):
    encoder, _ = coder
    spelled = word[:-1] + chr(ord(word[-1]) + bpe.FINAL)
    ranks = {}
    names = {i: s for s, i in encoder.ids.items()}
    for (a, b), rank in encoder.joined.items():
        ranks[names[a], names[b]] = rank
    assert [names[i] for i in encoder.word(spelled)] == bpe.merged(spelled, ranks)


def plain_scan(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    found = []
    for phrase, label in licences.BASE.items():
        part = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(part)] == part]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_licence_base(request, which):
    table = request.getfixturevalue(which)
    got = licences.scanned(table)
    want = [(r["doc_id"], *plain_scan(r["text"])) for r in table.select("doc_id", "text").collect()]
    assert rows(got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")) == sorted(want, key=repr)
    assert all(0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got.collect())


@pytest.mark.parametrize(
    "expression,labels,freedom",
    [
        ("mit", {"mit"}, 1.0),
        ("mit or gpl-2.0+ and apache-2.0", {"mit", "gpl-2.0+", "gpl", "apache-2.0", "apache"}, 1.0),
        ("(mit or gpl-2.0+) and gpl-3.0", {"mit", "gpl-2.0+", "gpl", "gpl-3.0"}, 0.2),
        ("gpl-2.0 with classpath-exception-2.0", {"gpl-2.0", "gpl", "gpl-2.0 with classpath-exception-2.0"}, 0.5),
        ("unheard-of", {"unheard-of"}, 0.0),
    ],
)
def test_licence_expressions(expression, labels, freedom):
    found = licences.evaluate(expression)
    assert found[0] == labels and found[1] == pytest.approx(freedom)


@pytest.mark.parametrize("expression", ["", "mit or", "and mit", "(mit", "mit)", "mit apache", "()"])
def test_malformed_expressions(expression):
    assert licences.evaluate(expression) is None


def test_licence_tag_in_text(odd):
    found = licences.scanned(odd).filter("doc_id = 10").first()
    assert found["labels"] == "apache,apache-2.0,gpl,gpl-2.0+,mit" and found["base_labels"] == "mit"
    assert found["freedom"] == 1.0 and [s["label"] for s in found["spans"]] == ["mit", "tag"]


@pytest.mark.parametrize(
    "line,labels,freedom",
    [
        ("MIT (see LICENSE)", "mit", 1.0),
        ("Apache-2.0 applies here", "apache,apache-2.0", 1.0),
        ("MIT.", "mit", 1.0),
        ("MIT OR GPL-2.0+. See the file COPYING.", "gpl,gpl-2.0+,mit", 1.0),
        ("(MIT AND GPL-3.0) OR", "gpl,gpl-3.0,mit", 0.2),
        ("MIT, with thanks", "mit", 1.0),
        ("(MIT", "", None),
        ("", "", None),
    ],
)
def test_licence_tag_before_prose(line, labels, freedom):
    finder = licences.automaton(licences.BASE, licences.MORE)
    found = dict(zip(licences.NAMES, licences.scan_text(f"// SPDX-License-Identifier: {line}\nmore", finder)))
    assert found["labels"] == labels and found["freedom"] == freedom


def plain_count(costs, fallback, word):
    """Cheapest segmentation by trying every split of the word."""
    best = [(0, 0)]
    for end in range(1, len(word) + 1):
        options = [
            (best[start][0] + costs[word[start:end]], best[start][1] + 1)
            for start in range(end)
            if word[start:end] in costs
        ]
        if word[end - 1] not in costs:
            parts = word[end - 1].encode()
            options.append((best[end - 1][0] + sum(fallback[b] for b in parts), best[end - 1][1] + len(parts)))
        best.append(min(options))
    return best[-1][1]


def test_token_counts(odd, docs):
    spec = token_counts.load(PIECES)
    for table in (odd.filter("doc_id <> 9 or doc_id is null"), docs.limit(40)):
        want = []
        for r in table.select("doc_id", "text").collect():
            words = (r["text"] or "").split()
            count = {w: plain_count(spec["costs"], spec["bytes"], "▁" + w) for w in set(words)}
            want.append((r["doc_id"], len(words), sum(count[w] for w in words)))
        assert rows(token_counts.counted(table, PIECES)) == sorted(want, key=repr)


def test_language_held_out(docs):
    found = language.identified(docs)
    assert set(found.columns) == {"doc_id", "held_out", "lang_pred", "score", "coverage"}
    right = found.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").selectExpr(
        "avg(cast(lang_pred = lang as double)) as share", "min(score) as low", "max(score) as high"
    ).first()
    assert right["share"] >= 0.95 and right["low"] >= 0 and right["high"] <= 1


def test_language_reads_text_only(docs):
    filters = language.fit(language.training_rows(docs))
    texts = [r["text"] for r in docs.limit(50).collect()]
    alone = language.decide(texts, filters)
    assert alone == [language.decide([t], filters)[0] for t in texts]
    cut = language.BLOCK
    language.BLOCK = 500  # long texts are worked on in blocks
    try:
        small = language.decide(texts, filters)
    finally:
        language.BLOCK = cut
    assert [a[0] for a in alone] == [s[0] for s in small]


def test_language_odd(odd, empty):
    found = {r["doc_id"]: r for r in language.identified(odd).collect()}
    assert len(ODD) == language.identified(odd).count()
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (1, 2, 3, 8))
    assert found[12]["lang_pred"] in {"en", "de", "fr"}
    unlabelled = language.identified(odd.withColumn("lang", odd["lang"].substr(100, 1)).replace("", None, ["lang"]))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}
    assert language.identified(empty).count() == 0


def test_many_languages():
    texts = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}q" * 3 for i in range(70)]
    grams = [np.unique(np.concatenate([language.grams(c, 3)[0] for c, _ in language.blocks([t])])) for t in texts]
    filters = language.build([f"l{i:02}" for i in range(70)], grams, 0)
    assert len(filters.masks) == 2
    assert [x[0] for x in language.decide(texts, filters)] == filters.languages


def test_ordinal_gradient():
    rng = np.random.default_rng(1)
    grades = rng.integers(0, 3, 300)
    at = np.arange(300)
    weights, thresholds = toxicity.fit_ordinal(at, grades, grades, 3, rounds=800)
    assert weights[0] < thresholds[0] < weights[1] < thresholds[1] < weights[2]


def test_toxicity(workers, docs):
    labels = workers.read.parquet("/root/testdata/sf0.01/labels.parquet")
    table = workers.read.parquet("/root/testdata/sf0.01/documents.parquet")
    joined = toxicity.scored(table, labels).join(labels, "doc_id")
    shares = {r["toxic"]: r for r in joined.groupBy("toxic").agg({"severity": "avg", "*": "count"}).collect()}
    hit = joined.filter("toxic = 1 and severity >= 0.5").count()
    wrong = joined.filter("toxic = 0 and severity >= 0.5").count()
    assert hit >= 0.5 * shares[1]["count(1)"] and wrong <= 0.02 * shares[0]["count(1)"]


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_toxicity_per_language(workers, size):
    labels = workers.read.parquet(f"/root/testdata/{size}/labels.parquet")
    table = workers.read.parquet(f"/root/testdata/{size}/documents.parquet")
    joined = toxicity.scored(table, labels).join(labels, "doc_id").join(table.select("doc_id", "lang"), "doc_id")
    caught = {}
    for r in joined.filter("toxic = 1").select("lang", "severity").collect():
        caught.setdefault(r["lang"], []).append(r["severity"] >= 0.5)
    assert len(caught) > 2 and all(sum(hits) >= 0.7 * len(hits) for hits in caught.values())
    assert joined.filter("toxic = 0 and severity >= 0.5").count() <= 0.02 * joined.filter("toxic = 0").count()


def test_words_within_long_runs_of_letters():
    found = set(toxicity.word_features("y" * 60 + "idiotic" + "z" * 60))
    assert {"idi*", "idiot*", "idiotic*"} <= found
    assert set(toxicity.word_features("Idiot")) == {"idiot", "idi*", "idio*"}


def test_toxicity_odd(workers, odd, empty):
    labels = workers.createDataFrame(
        [(1, 1, 1), (4, None, 0), (None, 1, 1), (6, 0, None), (5, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int"
    )
    found = toxicity.scored(odd, labels).collect()
    assert len(found) == len(ODD) and all(0 <= r["severity"] <= 2 for r in found)
    assert toxicity.scored(odd, labels.limit(0)).count() == len(ODD)
    assert toxicity.scored(empty, labels).count() == 0


def test_empty_tables(empty):
    for found in (
        bpe.token_digests(empty, WORDS),
        bpe.encoded(empty, WORDS),
        licences.scanned(empty),
        token_counts.counted(empty, PIECES),
    ):
        assert found.count() == 0


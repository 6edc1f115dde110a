"""Cross-tokenizer alignment against the two libraries and a plain merge of byte ranges."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.conftest import rows
from tidegauge.llm import alignment

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
STRANGE = [
    (20, " two  blanks,\t tab \n and  end  ", "en", "a", 30),
    (21, "with ▁ the sign of a blank", "en", "a", 30),
    (22, "<s> <unk> <0x41> <|endoftext|> in a text", "en", "a", 30),
    (23, "\x1c \x1f 　 ​\U0001f600 \x00 zero", "en", "a", 30),
    (24, "abc \x85 def\xa0 ghi  \n\n  x", "en", "a", 30),
    (25, " ", "en", "a", 1),
    (26, "   'll we'll WE'LL  don't 123abc456 %%%%", "en", "a", 1),
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    a.no_truncation()
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(alignment.load(A, B))


def tokens(libraries, text):
    """[(id, bytes)] of both sides; empty where bytes are lost."""
    if not text:
        return [], []
    byte_of = {c: b for b, c in enumerate(alignment.byte_characters())}
    found = libraries[0].encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(byte_of[c] for c in t)) for i, t in zip(found.ids, found.tokens)]
    right = []
    for i in libraries[1].encode(text):
        piece = libraries[1].id_to_piece(i)
        right.append((i, bytes([int(piece[3:-1], 16)]) if libraries[1].is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (left, right) if all(b"".join(t for _, t in side) == whole for side in (left, right)) else ([], [])


def ranges(side):
    at, out = 0, []
    for i, raw in side:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain(libraries, text):
    """(n_a, n_b, groups, links as pairs of ids) by comparing every byte."""
    left, right = (ranges(side) for side in tokens(libraries, text))
    owner_a = [i for i, (_, s, e) in enumerate(left) for _ in range(s, e)]
    owner_b = [i for i, (_, s, e) in enumerate(right) for _ in range(s, e)]
    links = sorted(set(zip(owner_a, owner_b)))
    ends = sorted({e for _, _, e in left} & {e for _, _, e in right})
    groups, at = [], 0
    for end in ends:
        groups.append(
            ",".join(str(i) for i, _, e in left if at < e <= end) + "|" + ",".join(str(i) for i, _, e in right if at < e <= end)
        )
        at = end
    return len(left), len(right), groups, [(left[i][0], right[j][0]) for i, j in links]


def expected(libraries, texts):
    found = [(name, plain(libraries, text)) for name, text in texts]
    counts = Counter(link for _, (_, _, _, links) in found for link in links)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for name, (n_a, n_b, groups, links) in found:
        best = sum(counts[x] == most[x[1]] for x in links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else ""
        yield name, n_a, n_b, len(groups), len(links), best, sum(counts[x] for x in links), digest


@pytest.fixture(scope="module")
def short(docs, odd):
    """Texts short enough for the brute force, which is quadratic in a text's tokens."""
    both = odd.select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    more = docs.sparkSession.createDataFrame([r[:2] for r in STRANGE], "doc_id long, text string")
    return both.unionByName(more).filter("text is null or length(text) < 4000")


def test_digests_as_brute_force(libraries, short):
    want = sorted(expected(libraries, [tuple(r) for r in short.collect()]), key=repr)
    assert rows(alignment.digests(short, A, B)) == want
    assert rows(alignment.digests(short, A, B, broadcast_pairs=0)) == want


def test_tokens_of_all_texts_as_the_libraries(libraries, pair, docs, odd):
    for r in docs.select("text").unionByName(odd.select("text")).collect():
        left, right = tokens(libraries, r["text"])
        a, b = pair.encode([r["text"]])[0]
        assert a.tolist() == [i for i, _ in left] and b.tolist() == [i for i, _ in right]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abeinorst THE'd,.!12 \n\t\x1c\x85\xa0▁　äñ日本🙂<s>|", max_size=60))
def test_tokens_of_any_text_as_the_libraries(libraries, pair, text):
    left, right = tokens(libraries, text)
    a, b = pair.encode([text])[0]
    assert a.tolist() == [i for i, _ in left] and b.tolist() == [i for i, _ in right]


def test_lanes_do_not_matter(pair, libraries, docs, monkeypatch):
    texts = [r["text"] for r in docs.limit(30).collect()]
    whole = [plain(libraries, t) for t in texts if t and len(t) < 3000]
    for lane in (1, 7, 1 << 20):
        monkeypatch.setattr(alignment, "LANE", lane)
        found = alignment.Aligned(pair, pair.encode([t for t in texts if t and len(t) < 3000]))
        assert found.links().tolist() == [len(w[3]) for w in whole]
        assert [t.decode() for t in found.group_texts()] == [";".join(w[2]) for w in whole]


def test_aligned_arrays(libraries, docs):
    some = docs.select("doc_id", "text").filter("text is null or length(text) < 4000").limit(40)
    got = {r["doc_id"]: r for r in alignment.aligned(some, A, B).collect() if r["doc_id"] is not None}
    for name, text in some.collect():
        if name is None:
            continue
        n_a, n_b, groups, links = plain(libraries, text)
        r = got[name]
        assert (len(r["a_ids"]), len(r["b_ids"])) == (n_a, n_b)
        assert sorted((r["a_ids"][i], r["b_ids"][j]) for i, j in zip(r["left"], r["right"])) == sorted(links)
        cuts = list(zip([0, *r["a_cuts"]], r["a_cuts"], [0, *r["b_cuts"]], r["b_cuts"]))
        texts = [",".join(map(str, r["a_ids"][s:e])) + "|" + ",".join(map(str, r["b_ids"][t:f])) for s, e, t, f in cuts]
        assert texts == groups


def test_a_very_long_word(libraries, pair):
    text = "ab" * 40_000 + " " + "x" * 20_000
    left, right = tokens(libraries, text)
    a, b = pair.encode([text])[0]
    assert a.tolist() == [i for i, _ in left] and b.tolist() == [i for i, _ in right]


def test_empty(empty):
    assert alignment.digests(empty, A, B).collect() == []

"""BPE encoding by backtracking over longest matches, and decoding through an offset table.

Ordinary BPE merges the best-ranked adjacent pair again and again. The same tokens come out of a left-to-right
search: at each place the longest vocabulary token is tried, then its next shorter prefixes; a token may follow the
previous one only if the two are compatible, which means that merging their joint string would keep the border between
them. A place from which nothing compatible leads on is marked dead and the previous token is shortened. Every place is
marked at most once, so the work is linear in the text.

Words that end a chunk carry their own symbols (``x</w>``), so the alphabet has 512 symbols: a byte's character, or
that character moved by ``FINAL`` when it ends a word.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
import uuid
from collections.abc import Iterator
from typing import Any

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import once_per_worker, text_udf

FINAL = 0x1000
SUFFIX = "</w>"
#: Distinct chunks and token pairs that a worker remembers before it starts afresh.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 64
#: Ids decoded at a time, which bounds the memory of a very long text.
DECODE_BLOCK = 1 << 17

# The splitting pattern and the white space of the vocabulary file's tokenizer.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + WHITE + r"\p{L}\p{N}]+")
CHUNKS = re.compile(f"[^{WHITE}]+")
SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_characters() -> str:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in chars:
            chars[b] = chr(spare)
            spare += 1
    return "".join(chars[b] for b in range(256))


def symbols(token: str) -> str:
    """A vocabulary entry as a string over the 512 symbols."""
    if not token.endswith(SUFFIX) or token == SUFFIX:
        return token
    body = token[: -len(SUFFIX)]
    return body[:-1] + chr(ord(body[-1]) + FINAL)


def merged(word: str, ranks: dict[tuple[str, str], int]) -> list[str]:
    """Plain BPE: merge the best-ranked pair, leftmost first. Used for single vocabulary entries and in tests."""
    parts = list(word)
    while len(parts) > 1:
        best = min(((ranks.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:]))))
        if best[0] == 1 << 60:
            break
        parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
    return parts


def load(path: str) -> dict[str, Any]:
    """The parts of a tokenizer file that encoding needs, small enough to broadcast (one entry per token)."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab = spec["model"]["vocab"]
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
    pairs = [(symbols(a), symbols(b)) for a, b in merges]
    ranks = {p: i for i, p in enumerate(pairs)}
    ids = {symbols(t): i for t, i in vocab.items()}
    #: Entries that plain BPE cannot reach as a whole never appear in an encoding.
    reached = [s for s in ids if len(s) == 1 or merged(s, ranks) == [s]]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    strings = {i: t for t, i in [*vocab.items(), *special.items()]}
    return {"key": uuid.uuid4().hex, "ids": ids, "pairs": pairs, "reached": reached, "special": special, "strings": strings}


class Encoder(dict):
    """Chunk of text without white space -> its ids as little-endian bytes; remembers short chunks."""

    def __init__(self, spec: dict[str, Any]):
        super().__init__()
        self.ids = spec["ids"]
        self.length = {i: len(s) for s, i in self.ids.items()}
        self.joined = {}  # (left id, right id) -> (rank, id of the merge)
        self.parts = {}  # id -> (rank, left id, right id) of the merge that makes it
        for rank, (a, b) in enumerate(spec["pairs"]):
            if a + b in self.ids:
                left, right, whole = self.ids[a], self.ids[b], self.ids[a + b]
                self.joined[left, right] = rank
                self.parts.setdefault(whole, (rank, left, right))
        self.matcher = ahocorasick.Automaton()
        for s in spec["reached"]:
            self.matcher.add_word(s, (self.ids[s], len(s)))
        self.matcher.make_automaton()
        reached = set(spec["reached"])
        self.shorter = {}  # id -> id of the longest proper prefix that is a token
        for s in reached:
            self.shorter[self.ids[s]] = next((self.ids[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in reached), None)
        self.compatible: dict[tuple[int, int], bool] = {}
        self.special = spec["special"]
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.chars = byte_characters()

    def keeps_border(self, left: int, right: int) -> bool:
        """Whether BPE over the joint string of two tokens leaves both whole.

        The merges that build the two tokens are undone from the latest on. While both halves at the border stand, a
        merge across the border that ranks before the next undone merge would have happened first.
        """
        known = self.compatible.get((left, right))
        if known is not None:
            return known
        if len(self.compatible) > REMEMBERED:
            self.compatible.clear()
        a, b, limit, good = left, right, 1 << 60, True
        while True:
            across = self.joined.get((a, b))
            if across is not None and across < limit:
                good = False
                break
            made_a, made_b = self.parts.get(a), self.parts.get(b)
            if made_a is None and made_b is None:
                break
            # Of equal merges the left one happens first, so the right one is undone first: the border pair then
            # competes from the left of it and wins a tie.
            if made_b is not None and (made_a is None or made_b[0] >= made_a[0]):
                limit, b = made_b[0] + 1, made_b[1]
            else:
                limit, a = made_a[0], made_a[2]
        self.compatible[left, right] = good
        return good

    def word(self, word: str) -> list[int]:
        """Ids of one pre-token given as symbols."""
        longest: list[int | None] = [None] * (len(word) + 1)
        for end, (token, n) in self.matcher.iter(word):
            longest[end - n + 1] = token  # ends ascend, so the longest stays
        alive = bytearray(b"\x01") * (len(word) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < len(word):
            last = out[-1] if out else None
            while token is not None:
                end = at + self.length[token]
                if alive[end] and (last is None or self.keeps_border(last, token)):
                    break
                token = self.shorter[token]
            if token is not None:
                out.append(token)
                at = end
                token = longest[at] if at < len(word) else None
            elif last is None:
                raise ValueError(f"no tokens for {word[:50]!r}")
            else:
                alive[at] = 0
                out.pop()
                at -= self.length[last]
                token = self.shorter[last]
        return out

    def __missing__(self, chunk: str) -> bytes:
        text = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        ids: list[int] = []
        for piece in WORDS.findall(text):
            chars = piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.chars)
            ids += self.word(chars[:-1] + chr(ord(chars[-1]) + FINAL))
        packed = np.array(ids, "<u4").tobytes()
        if len(chunk) <= LONGEST_REMEMBERED:
            if len(self) > REMEMBERED:
                self.clear()
            self[chunk] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if "<" in text:
            parts = self.cut.split(text)
            if len(parts) > 1:
                return b"".join(
                    np.array([self.special[p]], "<u4").tobytes() if i % 2 else self.encode_plain(p)
                    for i, p in enumerate(parts)
                )
        return self.encode_plain(text)

    def encode_plain(self, text: str) -> bytes:
        # str.split also splits at four separators that the tokenizer does not count as white space.
        chunks = CHUNKS.findall(text) if SEPARATORS.search(text) else text.split()
        return b"".join(map(self.__getitem__, chunks))


class Decoder:
    """Ids -> text: every token's bytes lie in one pool, found by an offset table."""

    def __init__(self, spec: dict[str, Any]):
        strings = spec["strings"]
        tokens = [strings.get(i, "").encode() + b" " for i in range(max(strings) + 1)]
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        self.pool = np.frombuffer(b"".join(tokens), np.uint8)

    def blocks(self, ids: np.ndarray):
        """The decoded bytes in blocks; the tokens are joined by single spaces."""
        for start in range(0, len(ids), DECODE_BLOCK):
            block = ids[start : start + DECODE_BLOCK]
            lengths = self.lengths[block]
            ends = np.cumsum(lengths)
            places = np.arange(ends[-1]) + np.repeat(self.offsets[block] - (ends - lengths), lengths)
            decoded = self.pool[places].tobytes()
            yield decoded if start + DECODE_BLOCK < len(ids) else decoded[:-1]

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(self.blocks(ids)).decode()


def tables(spark: SparkSession, path: str):
    """Broadcast encoder parts of the vocabulary file ``path``, read on the driver (bounded by the vocabulary)."""
    return spark.sparkContext.broadcast(load(path))


def _pair(spec) -> tuple[Encoder, Decoder]:
    parts = spec.value
    return once_per_worker(("bpe", parts["key"]), lambda: (Encoder(parts), Decoder(parts)))


def encoded(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids of every text: (doc_id, ids array<int>). A null text counts as empty and has no ids."""
    spec = tables(docs.sparkSession, path)

    def build():
        encoder, _ = _pair(spec)
        return lambda t: (np.frombuffer(encoder.encode(t or ""), "<u4").astype("<i4"),)

    ids = text_udf(build, ["ids"], "ids array<int>")(F.col(text))
    return docs.select(F.col(doc_id).alias("doc_id"), ids["ids"].alias("ids"))


def decoded(tokens: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Texts of id arrays: (doc_id, text). Null and empty arrays decode to the empty text."""
    spec = tables(tokens.sparkSession, path)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        _, decoder = _pair(spec)
        for batch in batches:
            yield batch.map(lambda x: "" if x is None else decoder.decode(np.asarray(x, np.int64)))

    return tokens.select(F.col(doc_id).alias("doc_id"), decode(F.col(ids)).alias("text"))


def token_digests(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text, decode the ids again, and return one row per input row.

    Columns: doc_id, n_tokens, ids_sha256 (ids as little-endian 32-bit integers), decoded_sha256 (UTF-8). Null and
    empty texts have no tokens and the digests of nothing. Repeated rows give repeated results; other columns are
    not read. Ids and decoded text stay inside the worker, so long texts cost no shuffle.
    """
    spec = tables(docs.sparkSession, path)

    def build():
        encoder, decoder = _pair(spec)

        def one(t: str | None) -> tuple:
            packed = encoder.encode(t or "")
            ids = np.frombuffer(packed, "<u4")
            back = hashlib.sha256()
            for block in decoder.blocks(ids):
                back.update(block)
            return len(ids), hashlib.sha256(packed).hexdigest(), back.hexdigest()

        return one

    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    result = text_udf(build, names, "n_tokens long, ids_sha256 string, decoded_sha256 string")(F.col(text))
    return docs.select(F.col(doc_id).alias("doc_id"), result.alias("r")).select("doc_id", "r.*")

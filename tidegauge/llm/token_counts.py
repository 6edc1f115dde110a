"""Token counts under a unigram vocabulary: one forward pass over a trie of all distinct pre-tokens.

The cheapest segmentation of a pre-token is found from left to right: the best score of a prefix is the best score of
a shorter prefix plus the cost of the vocabulary piece between them. Pre-tokens that share a prefix share these
scores, so each node of the trie of the distinct pre-tokens is scored once, and the count that belongs to a whole
pre-token is kept at its terminal node. Sorting the pre-tokens walks this trie depth first: the path to the current
node is a stack, and only the part beyond the common prefix with the previous pre-token is new.

Piece costs are integers made from the vocabulary's order, 1000 ln(2 + rank), so that results don't depend on the order
of additions; equal costs go to fewer pieces.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator
from typing import Any

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import once_per_worker

BEGIN = "▁"
#: Distinct pre-tokens whose counts a worker keeps, and the longest that it keeps.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 64


def load(path: str) -> dict[str, Any]:
    """Piece costs of a sentencepiece file, in characters, and the cost of each byte's fallback piece."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    costs, fallback = {}, {}
    for i in range(model.get_piece_size()):
        cost = round(1000 * math.log(2 + i))
        if model.is_byte(i):
            fallback[int(model.id_to_piece(i)[3:5], 16)] = cost
        elif not (model.is_control(i) or model.is_unknown(i)):
            costs[model.id_to_piece(i)] = cost
    return {"key": uuid.uuid4().hex, "costs": costs, "bytes": fallback}


class Counter(dict):
    """Pre-token -> number of pieces of its cheapest segmentation."""

    def __init__(self, spec: dict[str, Any]):
        super().__init__()
        self.costs, self.bytes = spec["costs"], spec["bytes"]
        self.longest = max(map(len, self.costs))

    def step(self, word: str, best: list[tuple[int, int]], end: int) -> tuple[int, int]:
        """(cost, pieces) of the prefix that ends at ``end``, from the scores of the shorter prefixes."""
        costs = self.costs
        found = None
        for start in range(max(0, end - self.longest), end):
            cost = costs.get(word[start:end])
            if cost is not None:
                here = (best[start][0] + cost, best[start][1] + 1)
                if found is None or here < found:
                    found = here
        if word[end - 1] not in costs:  # a character outside the vocabulary falls back to its bytes
            parts = [self.bytes[b] for b in word[end - 1].encode("utf-8", "surrogatepass")]
            here = (best[end - 1][0] + sum(parts), best[end - 1][1] + len(parts))
            found = here if found is None or here < found else found
        return found

    def count_all(self, words: Iterable[str]) -> dict[str, int]:
        """Terminal counts of distinct pre-tokens, each trie node scored once."""
        counts: dict[str, int] = {}
        previous, best = "", [(0, 0)]
        for word in sorted(words):
            shared, most = 0, min(len(previous), len(word))
            while shared < most and previous[shared] == word[shared]:
                shared += 1
            del best[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                best.append(self.step(word, best, end))
            counts[word] = best[-1][1]
            previous = word
        return counts

    def texts(self, texts: list[str]) -> list[tuple[int, int]]:
        """(pre-tokens, pieces) of each text; the texts' new distinct pre-tokens are scored together."""
        split = [t.split() for t in texts]
        if len(self) > REMEMBERED:
            self.clear()
        new = set().union(*split)
        new.difference_update(self)
        counted = self.count_all(BEGIN + w for w in new)
        for w in new:
            self[w] = counted[BEGIN + w]
        found = [(len(words), sum(map(self.__getitem__, words))) for words in split]
        for w in new:
            if len(w) > LONGEST_REMEMBERED:
                del self[w]
        return found


def counted(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokens per document: (doc_id, n_pretokens, n_tokens), one row per input row; other columns are not read.

    Pre-tokens are what white space separates, each with a mark of its beginning. Null, empty and blank texts have
    none. Texts of an Arrow batch, which is bounded in bytes, share one trie; nothing is shuffled.
    """
    spec = docs.sparkSession.sparkContext.broadcast(load(path))  # one entry per vocabulary piece

    @F.pandas_udf("n_pretokens long, n_tokens long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parts = spec.value
        counter = once_per_worker(("unigram", parts["key"]), lambda: Counter(parts))
        for batch in batches:
            found = counter.texts([t if isinstance(t, str) else "" for t in batch])
            yield pd.DataFrame(found, columns=["n_pretokens", "n_tokens"], dtype="int64")

    return docs.select(F.col(doc_id).alias("doc_id"), count(F.col(text)).alias("r")).select("doc_id", "r.*")

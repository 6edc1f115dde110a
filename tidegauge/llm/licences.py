"""Licence scans: one Aho-Corasick automaton finds notice phrases and identifier tags, a shunting-yard parser reads
the tags' and/or/with expressions.

Texts are reduced to words first: ASCII letters become lower case, every other ASCII character but digits separates.
The automaton runs over the words joined by single spaces, so a phrase is found wherever its words stand consecutively,
whatever stands between them. Tags are looked at again in the raw line, as expressions need brackets, dots and pluses.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import text_udf

# The notice phrases that always count, and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Further notice phrases with labels of this scan's own.
MORE = {
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd license": "bsd",
    "isc license": "isc",
    "eclipse public license": "epl",
    "creative commons": "cc",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
}
# How free a licence family is, from 0 (reciprocal or unknown) to 1 (permissive).
FREEDOM = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "cc0": 1.0, "unlicense": 1.0, "zlib": 1.0, "cc-by": 0.8,
    "mpl": 0.6, "epl": 0.6, "lgpl": 0.5, "cc-by-sa": 0.4, "gpl": 0.2, "agpl": 0.1,
}
#: What a linking exception adds to a reciprocal licence.
EXCEPTION = 0.3
TAG = "spdx license identifier"
TAG_LINE = re.compile(rb"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)")
PARTS = re.compile(r"\(|\)|[a-z0-9][a-z0-9.+-]*")
BINDS = {"with": 3, "and": 2, "or": 1}

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def normal(text: str) -> tuple[str, int]:
    """The text's words between single spaces (bytes as characters), and their number."""
    words = text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()
    return f" {b' '.join(words).decode('latin-1')} ", len(words)


def family(identifier: str) -> str | None:
    """The longest known licence family that an identifier belongs to."""
    fits = [f for f in FREEDOM if identifier == f or identifier.startswith(f + "-")]
    return max(fits, key=len, default=None)


def operands_and_operators(expression: str) -> list[str]:
    """The expression's parts up to the first character that belongs to none, or up to the dot that ends a sentence."""
    parts: list[str] = []
    at = 0
    for found in PARTS.finditer(expression):
        if expression[at : found.start()].strip(" \t"):
            break
        part = found.group()
        parts.append(part.rstrip(".") if part not in "()" else part)
        if part.endswith("."):
            break
        at = found.end()
    return parts


def to_postfix(parts: list[str]) -> tuple[list[str], int]:
    """Shunting-yard over the longest valid leading expression: its postfix form and how many parts it has.

    Operators wait on a stack until one that binds less arrives. After every part that could be the last one, the form
    that the expression has if it ends there is known; prose behind an expression only ends it. ([], 0) if not even the
    first parts are valid.
    """
    out: list[str] = []
    waiting: list[str] = []
    opened = 0
    operand_next = True
    ended: tuple[int, list[str]] | None = None  # length of ``out`` and the operators waiting
    used = 0
    for number, part in enumerate(parts, 1):
        if part in BINDS and not operand_next:
            while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= BINDS[part]:
                out.append(waiting.pop())
            waiting.append(part)
            operand_next = True
        elif part == "(" and operand_next:
            waiting.append(part)
            opened += 1
        elif part == ")" and not operand_next and opened:
            while waiting[-1] != "(":
                out.append(waiting.pop())
            waiting.pop()
            opened -= 1
        elif operand_next and part not in BINDS and part not in "()":
            out.append(part)
            operand_next = False
        else:
            break
        if not operand_next and not opened:
            ended, used = (len(out), waiting[::-1]), number
    return (out[: ended[0]] + ended[1], used) if ended else ([], 0)


def evaluate(expression: str, leading: bool = False) -> tuple[set[str], float] | None:
    """Labels named by a licence expression and how free its best reading is; None if malformed.

    With ``leading`` the longest valid expression at the beginning counts, and what follows, as the prose after a tag, is
    not read. ``or`` leaves the choice, so the freer side counts; ``and`` binds to the stricter side; ``with`` names an exception
    that loosens the licence before it. Every identifier is a label, and so is its family.
    """
    parts = operands_and_operators(expression)
    postfix, used = to_postfix(parts)
    if not used or (used < len(parts) and not leading):
        return None
    stack: list[tuple[set[str], float, str]] = []
    for part in postfix:
        if part not in BINDS:
            known = family(part.rstrip("+"))
            stack.append(({part, *([known] if known else [])}, FREEDOM.get(known or "", 0.0), part))
            continue
        right, left = stack.pop(), stack.pop()
        if part == "with":
            name = f"{left[2]} with {right[2]}"
            stack.append((left[0] | {name}, min(1.0, left[1] + EXCEPTION), name))
        else:
            pick = max if part == "or" else min
            stack.append((left[0] | right[0], pick(left[1], right[1]), part))
    return stack[0][0], stack[0][1]


def automaton(base: Mapping[str, str], more: Mapping[str, str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, phrases in ((2, {TAG: ""}), (1, more), (0, base)):  # a phrase in both counts as base
        for phrase, label in phrases.items():
            key = normal(phrase)[0]
            found.add_word(key, (kind, label, len(key), key.count(" ") - 1))
    found.make_automaton()
    return found


def scan_text(text: str, finder: ahocorasick.Automaton) -> tuple:
    """All findings in one text; see ``scanned`` for the columns."""
    words, n_words = normal(text)
    base, labels, starts, spans = set(), set(), [], []
    freedom: float | None = None
    counted = word = 0
    hits = sorted((end - hit[2] + 1, hit) for end, hit in finder.iter(words))
    for at, (kind, label, _, length) in hits:
        word += words.count(" ", counted, at)
        counted = at
        spans.append((word, word + length, label or "tag"))
        if kind == 0:
            base.add(label)
            starts.append(word)
        elif kind == 1:
            labels.add(label)
    tags = 0
    if any(hit[0] == 2 for _, hit in hits):
        for line in TAG_LINE.findall(text.encode("utf-8", "surrogatepass").lower()):
            found = evaluate(line.decode("utf-8", "replace").rstrip(" \t*/#->\"'"), leading=True)
            if found:
                tags += 1
                labels |= found[0]
                freedom = found[1] if freedom is None else min(freedom, found[1])
    known = [FREEDOM[x] for x in base | labels if x in FREEDOM]
    if freedom is None and known:
        freedom = min(known)
    evidence = len(starts) + 2 * tags + 0.5 * sum(hit[0] == 1 for _, hit in hits)
    return (
        n_words,
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | labels)),
        1.0 - 0.5**evidence,
        freedom,
        [{"start": a, "end": b, "label": c} for a, b, c in spans],
    )


NAMES = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "freedom", "spans"]
SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "freedom double, spans array<struct<start:long, end:long, label:string>>"
)


def scanned(
    docs: DataFrame,
    base: Mapping[str, str] = BASE,
    more: Mapping[str, str] = MORE,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Licence findings, one row per input row; other columns are not read.

    n_words; n_base, first_word, last_word: places of base phrases and their smallest and largest start, in words from
    0 (null without any); base_labels and labels: distinct, sorted, comma-joined (empty without any); score: strength of
    the evidence, 0 without any, a tag weighing twice a base phrase and another phrase half of it; freedom: of the
    strictest finding, null if unknown; spans: word ranges of all phrases and tags. Null and empty texts find nothing.
    """

    def build():
        finder = automaton(base, more)
        return lambda t: scan_text(t or "", finder)

    found = text_udf(build, NAMES, SCHEMA)(F.col(text))
    return docs.select(F.col(doc_id).alias("doc_id"), found.alias("r")).select("doc_id", "r.*")

"""Document fingerprints: a homomorphic multiset hash of paragraphs.

Every paragraph is hashed to a wide vector, and a text's fingerprint is the sum of its paragraphs' vectors modulo
a power of two. Sums forget the order, so texts of the same paragraphs are equal; inserting or deleting paragraphs adds
or subtracts their vectors, without reading the rest of the text.

The vector has two parts. ``DENSE`` lanes, modulo 2^32, tell different multisets apart. ``SIGNS`` lanes, modulo 2^32 too,
are sums of signs over the paragraph's clauses, of which no text has that many; two such sums are as far apart as the clause multisets are, which
gives a likeness of two fingerprints: 2 a.b / (a.a + b.b), cut at 0. It is 1 for equal fingerprints.

In flight a fingerprint is an array of 64-bit sums: the dense lanes, then for each pair of sign lanes how many clauses
have the first and (32 bits higher) the second bit set, then the numbers of paragraphs and clauses. Lines are
paragraphs; a clause ends at a line end or at punctuation before a space. Everything is a column expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.operators.ordered import row_numbers
from tidegauge.session import stored

DENSE = 16
SIGNS = 128
_PAIRS = SIGNS // 2
_LOW = "4294967295L"
_BOTH = "4294967297L"  # one bit in each half
CLAUSE_END = r"\n|[.!?,;:|] "
#: Positions in the array of sums, from 0.
_PARAGRAPHS, _CLAUSES = DENSE + _PAIRS, DENSE + _PAIRS + 1
LANES = DENSE + _PAIRS + 2


def summed(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the sums of the non-null column ``text`` as ``name`` (array of ``LANES`` longs)."""
    rest = rows.columns
    split = rows.withColumns(
        {"_paragraphs": F.split(F.col(text), "\n", -1), "_clauses": F.split(F.col(text), CLAUSE_END, -1)}
    )
    hashed = split.withColumns(
        {
            "_first": F.transform("_clauses", lambda c: F.xxhash64(c)),
            "_second": F.transform("_clauses", lambda c: F.xxhash64(c, F.lit(1))),
        }
    )
    dense = [f"aggregate(_paragraphs, 0L, (s, p) -> s + (xxhash64(p, {i}) & {_LOW}))" for i in range(DENSE)]
    signs = [
        f"aggregate({column}, 0L, (s, h) -> s + (shiftrightunsigned(h, {bit}) & {_BOTH}))"
        for column in ("_first", "_second")
        for bit in range(_PAIRS // 2)
    ]
    counts = ["cast(size(_paragraphs) as bigint)", "cast(size(_clauses) as bigint)"]
    return hashed.withColumn(name, F.expr(f"array({', '.join(dense + signs + counts)})")).select(*rest, name)


def inserted(sums: Column, more: Column) -> Column:
    return F.zip_with(sums, more, lambda a, b: a + b)


def deleted(sums: Column, less: Column) -> Column:
    return F.zip_with(sums, less, lambda a, b: a - b)


def _signed(sums: Column) -> Column:
    """Sign sums per lane: twice the set bits less the clauses."""
    clauses = F.element_at(sums, _CLAUSES + 1)
    halves = F.slice(sums, DENSE + 1, _PAIRS)

    def lane(bits: Column) -> Column:
        return 2 * bits - clauses

    low = F.transform(halves, lambda x: lane(x.bitwiseAND(F.lit(4294967295))))
    high = F.transform(halves, lambda x: lane(F.shiftrightunsigned(x, 32)))
    return F.concat(low, high)


def fingerprint(sums: Column) -> Column:
    """Hexadecimal text: paragraphs, dense lanes and sign lanes modulo 2^32."""
    wide = F.concat(F.slice(sums, _PARAGRAPHS + 1, 1), F.slice(sums, 1, DENSE), _signed(sums))
    return F.lower(F.array_join(F.transform(wide, lambda x: F.lpad(F.hex(x.bitwiseAND(F.lit(4294967295))), 8, "0")), ""))


def with_likeness(rows: DataFrame, one: str, other: str, name: str) -> DataFrame:
    """``rows`` with the likeness (0 to 1) of the fingerprints whose sums are ``one`` and ``other``."""
    signed = rows.withColumns({"_a": _signed(F.col(one)), "_b": _signed(F.col(other))})

    def product(left: str, right: str) -> Column:
        terms = F.zip_with(left, right, lambda a, b: a.cast("double") * b)  # squares of long texts exceed 64 bits
        return F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)

    parts = signed.withColumns({"_ab": product("_a", "_b"), "_squares": product("_a", "_a") + product("_b", "_b")})
    likeness = F.when(F.col("_squares") == 0, 1.0).otherwise(F.greatest(F.lit(0.0), 2 * F.col("_ab") / F.col("_squares")))
    return parts.withColumn(name, likeness).select(*rows.columns, name)


def fingerprinted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row; a null text counts as empty, equal texts have equal fingerprints."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return summed(rows, "text", "sums").select("doc_id", fingerprint(F.col("sums")).alias("fingerprint"))


def successors(rows: DataFrame) -> DataFrame:
    """(doc_id, next_id, need, several) for each distinct id: the next one by descending id, and round again.

    ``need`` is the most that any row of the id takes of the next text, ``several`` whether any id has more than one
    row. Only ids move; they are numbered in slices, not by one task.
    """
    ids = rows.groupBy("doc_id").agg(F.max("need").alias("need"), F.count(F.lit(1)).alias("rows"))
    numbered = stored(row_numbers(ids, [], [F.col("doc_id").desc_nulls_last()], "at"), "fingerprint-order")
    size = numbered.agg(F.count(F.lit(1)).alias("n"), F.max("rows").alias("rows")).first()
    following = numbered.select((F.pmod(F.col("at") - 2, F.lit(max(1, size["n"]))) + 1).alias("at"), F.col("doc_id").alias("next_id"))
    found = numbered.join(following, "at").select("doc_id", "next_id", "need")
    return found.withColumn("several", F.lit((size["rows"] or 0) > 1))


def edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, one row per input row.

    The last third of the code points is replaced by as many of the beginning of the next document, by descending id,
    null last; the first follows the last. Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited and near_next (likeness of the fingerprint to the edited text's and to the next document's). A null
    text counts as empty. Rows that share an id are one place in the order, and the smallest of their texts' beginnings
    (then fingerprints) follows. The edited fingerprint comes from the text's: vectors of the paragraphs from the cut on
    are subtracted and those of the new end added.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    third = F.floor(F.char_length("text") / 3).cast("int")
    order = stored(successors(base.select("doc_id", third.alias("need"))), "fingerprint-next")
    several = order.filter("several").limit(1).count() > 0

    whole = summed(base, "text", "sums")
    wanted = order.select(F.col("doc_id").alias("for_id"), "next_id", "need")
    heads = whole.join(wanted, F.col("doc_id").eqNullSafe(F.col("next_id"))).select(
        "for_id", F.expr("substring(text, 1, need)").alias("head"), F.col("sums").alias("next_sums")
    )
    if several:
        heads = heads.groupBy("for_id").agg(F.min(F.struct("head", "next_sums")).alias("first")).select("for_id", "first.*")
    joined = whole.join(heads, F.col("doc_id").eqNullSafe(F.col("for_id"))).drop("for_id")

    # From here on the kept part, the beginning of its last line, and what stands after that before and after.
    cut = joined.withColumns({"n_chars": F.char_length("text").cast("long"), "third": third})
    cut = cut.withColumns(
        {"kept": F.expr("substring(text, 1, cast(n_chars as int) - third)"), "head": F.expr("substring(head, 1, third)")}
    )
    cut = cut.withColumn("line", F.char_length(F.substring_index("kept", "\n", -1)))
    cut = cut.withColumns(
        {
            "edited_sha256": F.sha2(F.concat("kept", "head"), 256),
            "old_end": F.expr("substring(text, length(kept) - line + 1)"),
            "new_end": F.expr("concat(substring(kept, length(kept) - line + 1), head)"),
        }
    ).drop("text", "kept", "head", "line", "third")
    ends = summed(summed(cut, "old_end", "old_sums").drop("old_end"), "new_end", "new_sums").drop("new_end")
    new = inserted(deleted(F.col("sums"), F.col("old_sums")), F.col("new_sums"))
    found = ends.withColumn("edited_sums", new).drop("old_sums", "new_sums")
    found = with_likeness(found, "sums", "edited_sums", "near_edited")
    found = with_likeness(found, "sums", "next_sums", "near_next")
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("sums")).alias("fingerprint"),
        fingerprint(F.col("edited_sums")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )

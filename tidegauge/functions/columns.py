"""Column-wise building blocks over telemetry rows: types, ids, dates, status, names, masking."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the types a staging table keeps as they are; everything else becomes text.
PLAIN_TYPES = (
    T.DateType,
    T.StringType,
    T.BooleanType,
    T.LongType,
    T.IntegerType,
    T.DoubleType,
    T.FloatType,
)
NESTED_TYPES = (T.StructType, T.ArrayType, T.MapType)


def complex_to_text(df: DataFrame) -> DataFrame:
    """Cast every non-primitive column to text, so that schemas may drift; nested values become JSON."""
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, NESTED_TYPES):
            col = F.to_json(col)
        elif not isinstance(field.dataType, PLAIN_TYPES):
            col = col.cast("string")
        out.append(col.alias(field.name))
    return df.select(*out)


def upper_ids(df: DataFrame, ids: Iterable[str]) -> DataFrame:
    """Upper-case those of the listed id columns that exist."""
    wanted = set(ids)
    return df.withColumns({c: F.upper(c) for c in df.columns if c in wanted})


def date_parts(iso: Column) -> dict[str, Column]:
    """Date, yyyyMMdd key, hour and minute text out of an ISO timestamp text."""
    return {
        "CreationDate": F.to_date(F.substring(iso, 1, 10), "yyyy-MM-dd"),
        "CreationDateKey": F.regexp_replace(F.substring(iso, 1, 10), "-", ""),
        "CreationHour": F.substring(iso, 12, 2).cast("int").cast("string"),
        "CreationMinute": F.substring(iso, 15, 2),
    }


def status_of(result: Column, is_success: Column) -> Column:
    """Result text first, then the success flag, else N/A."""
    return (
        F.when(result.isin("Failed", "InProgress", "Succeeded"), result)
        .when(is_success == 1, F.lit("Succeeded"))
        .otherwise(F.lit("N/A"))
    )


def optional_filters(df: DataFrame, **wanted: Any) -> DataFrame:
    """Filter by the parameters that are set.

    ``col=value`` is equality, a list is IN, a ``(low, high)`` tuple is BETWEEN, text holding ``%``
    is LIKE, the same with a leading ``!`` is NOT LIKE, and ``None`` drops the predicate.
    """
    for name, value in wanted.items():
        col = F.col(name)
        if value is None:
            continue
        if isinstance(value, tuple):
            df = df.filter(col.between(*value))
        elif isinstance(value, list):
            df = df.filter(col.isin(value))
        elif isinstance(value, str) and "%" in value:
            df = df.filter(~col.like(value[1:]) if value.startswith("!") else col.like(value))
        else:
            df = df.filter(col == value)
    return df


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from start to end; an end in year 1 marks "never ended" and gives null."""
    return F.when(F.year(end) > 1, F.unix_timestamp(end) - F.unix_timestamp(start))


def match_name(name: Column) -> Column:
    """Name reduced to lower-case letters and digits, for comparing spellings."""
    return F.lower(F.regexp_replace(name, "[^A-Za-z0-9]", ""))


def camel_case(name: str) -> str:
    words = re.split(r"[^A-Za-z0-9]+", name.strip())
    return words[0][:1].lower() + words[0][1:] + "".join(w[:1].upper() + w[1:] for w in words[1:])


def rename_all(df: DataFrame, rule) -> DataFrame:
    return df.toDF(*[rule(c) for c in df.columns])


def mask_all(df: DataFrame, user: str) -> DataFrame:
    return df.withColumn(user, F.lit("Masked"))


def pseudonym(user: Column, salt: str) -> Column:
    """Stable stand-in for a user, equal for spellings that differ in case or outer blanks.

    A salted hash needs no pseudonym table and no driver round trip, and every run agrees.
    """
    return F.sha2(F.concat(F.lit(salt), F.lower(F.trim(user))), 256)


def mask_older(df: DataFrame, user: str, day: Column, cutoff: Column) -> DataFrame:
    """Mask users on rows dated before the cutoff."""
    return df.withColumn(user, F.when(day < cutoff, F.lit("Masked")).otherwise(F.col(user)))


def name_variants(name: Column, table: Column | None = None) -> Column:
    """Spellings under which an object is written in query text, one row each."""
    if table is None:
        return F.explode(F.array(name, F.concat(F.lit("["), name, F.lit("]"))))
    return F.explode(
        F.array(
            F.concat(F.lit("'"), table, F.lit("'["), name, F.lit("]")),
            F.concat(table, F.lit("["), name, F.lit("]")),
            F.concat(F.lit("["), name, F.lit("]")),
        )
    )


def hash_key(*cols: Column) -> Column:
    """Surrogate BIGINT: the last 16 hex digits of an MD5 over the null-safe text of the columns."""
    text = F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.right(F.md5(text), F.lit(16)), 16, -10).cast("bigint")


def content_hash(col: Column) -> Column:
    return F.sha2(col, 256)


def decode(code: Column, meanings: Mapping[str, str]) -> Column:
    """Meaning of a code, null where the code is unknown."""
    out = F.lit(None).cast("string")
    for key, meaning in meanings.items():
        out = F.when(code == key, F.lit(meaning)).otherwise(out)
    return out


def decode_strict(code: Column, meanings: Mapping[str, str]) -> Column:
    """Meaning of a code; an unknown code fails the query."""
    known = decode(code, meanings)
    return F.when(known.isNotNull() | code.isNull(), known).otherwise(
        F.raise_error(F.concat(F.lit("unknown code "), code))
    )


def split_known(df: DataFrame, code: str, known: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a known code, and the quarantined rest (null codes included)."""
    ok = F.coalesce(F.col(code).isin(list(known)), F.lit(False))
    return df.filter(ok), df.filter(~ok)


# Codes of the price-paid files.
PROPERTY_TYPES = {"D": "Detached", "S": "SemiDetached", "T": "Terraced", "F": "FlatMaisonette", "O": "Other"}
DURATIONS = {"F": "Freehold", "L": "Leasehold", "C": "Commonhold", "U": "Unknown"}
CATEGORIES = {"A": "StandardPricePaid", "B": "AdditionalPricePaid"}
RECORD_STATUS = {"A": "Added", "C": "Changed", "D": "Deleted", "U": "Unknown"}


def display_success(flag: Column) -> Column:
    return F.when(flag == "Y", "Success").when(flag == "N", "Error").otherwise("N/A")


def cardinality_text(from_side: Column, to_side: Column) -> Column:
    return F.concat(F.initcap(from_side), F.lit(" to "), F.initcap(to_side))


def mapped_type(coltype: Column, maxlen: Column, precision: Column, scale: Column) -> Column:
    """Target type text of a source column type, for moving tables between SQL dialects."""
    half = (maxlen / 2).cast("int").cast("string")
    fraction = F.least(scale, F.lit(6)).cast("string")

    def sized(name: str | Column, size: Column | str) -> Column:
        head = F.lit(name) if isinstance(name, str) else name
        return F.concat(head, F.lit("("), F.lit(size) if isinstance(size, str) else size, F.lit(")"))

    digits = F.concat_ws(",", precision.cast("string"), scale.cast("string"))
    unbounded = maxlen == -1
    return (
        F.when(coltype.isin("numeric", "decimal"), sized(coltype, digits))
        .when(coltype.isin("money", "smallmoney"), sized("decimal", digits))
        .when(coltype.isin("smalldatetime", "datetime", "datetime2", "datetimeoffset"), sized("datetime2", fraction))
        .when(coltype == "time", sized("time", fraction))
        .when(coltype.isin("binary", "varbinary", "image"), F.lit("varbinary"))
        .when(coltype.isin("char", "varchar", "text", "ntext") & unbounded, sized(coltype, "8000"))
        .when(coltype.isin("char", "varchar", "text"), sized(coltype, maxlen.cast("string")))
        .when(coltype == "ntext", sized("ntext", half))
        .when(coltype == "sysname", F.lit("varchar(8000)"))
        .when(coltype == "nchar", F.when(unbounded, F.lit("char(8000)")).otherwise(sized("char", half)))
        .when(coltype == "nvarchar", F.when(unbounded, F.lit("varchar(8000)")).otherwise(sized("varchar", half)))
        .when(coltype == "tinyint", F.lit("smallint"))
        .otherwise(coltype)
    )

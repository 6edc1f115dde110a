"""Getting values out of log text: JSON in text, base64, XML properties, regular expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How an engine prints its size estimates.
ESTIMATED_SIZE = r"(?i)Estimated size[^:]*:\s*(\d+),\s*(\d+)"
ESTIMATED_ROWS = r"(?i)rows\s*=\s*(\d+(?:,\d+)*)"
ESTIMATED_BYTES = r"(?i)bytes\s*=\s*(\d+(?:,\d+)*)"


def json_attribute(text: Column, name: str) -> Column:
    return F.get_json_object(text, f"$.{name}")


def expand_json_list(df: DataFrame, text: str, out: str) -> DataFrame:
    """One row per element of a JSON array whose elements are themselves JSON texts."""
    return df.withColumn(out, F.explode_outer(F.from_json(F.col(text), "array<string>")))


def source_kind_and_path(item: Column) -> tuple[Column, Column]:
    """Kind (or ConnectorType) of a data source, and its path (or the remaining values joined)."""
    fields = F.from_json(item, "map<string,string>")
    kind = F.coalesce(fields["kind"], fields["ConnectorType"])
    rest = F.map_filter(fields, lambda k, _: ~k.isin("kind", "ConnectorType"))
    return kind, F.coalesce(fields["path"], F.array_join(F.map_values(rest), ";"))


CONTEXTS = "array<struct<id:string,traceIds:array<struct<id:string,values:array<struct<key:string,value:string>>>>>>"


def expand_contexts(df: DataFrame, text: str, without: str) -> DataFrame:
    """contexts → traceIds → key/value rows, leaving out one key."""
    return (
        df.withColumn("_c", F.explode(F.from_json(text, CONTEXTS)))
        .withColumn("_t", F.explode("_c.traceIds"))
        .withColumn("_v", F.explode("_t.values"))
        .withColumns({"context_id": F.col("_c.id"), "trace_id": F.col("_t.id"), "key": F.col("_v.key")})
        .withColumn("value", F.col("_v.value"))
        .drop("_c", "_t", "_v")
        .filter(F.col("key") != without)
    )


APPLICATION = "DatasetId string, Sources array<struct<ReportId:string,VisualId:string,HostProperties:string>>"


def expand_application_context(df: DataFrame, value: str) -> DataFrame:
    """DatasetId and one row per source out of an application context held as JSON text."""
    return (
        df.withColumn("_a", F.from_json(value, APPLICATION))
        .withColumn("_s", F.explode_outer("_a.Sources"))
        .withColumns(
            {
                "DatasetId": F.col("_a.DatasetId"),
                "ReportId": F.col("_s.ReportId"),
                "VisualId": F.col("_s.VisualId"),
                "HostProperties": F.col("_s.HostProperties"),
            }
        )
        .drop("_a", "_s")
    )


def _western() -> tuple[str, str]:
    """The control characters of Latin-1 that windows-1252 gives a printable meaning, and those."""
    pairs = []
    for byte in range(0x80, 0xA0):
        char = bytes([byte]).decode("cp1252", errors="ignore")
        if char:
            pairs.append((chr(byte), char))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def decode_query_text(encoded: Column, charset: str = "windows-1252") -> Column:
    """Base64 text, decoded, with its lines joined by blanks."""
    raw = F.unbase64(encoded)
    if charset == "windows-1252":  # not among Spark's charsets: Latin-1 but for 27 characters
        text = F.translate(F.decode(raw, "ISO-8859-1"), *_western())
    else:
        text = F.decode(raw, charset)
    return F.regexp_replace(text, r"\R", " ")


def bracket_sum(text: Column) -> Column:
    """``... [12,30] ...`` → 42."""
    inner = F.regexp_extract(text, r"\[([^\]]*)\]", 1)
    numbers = F.transform(F.split(inner, ","), lambda x: F.trim(x).try_cast("bigint"))
    return F.aggregate(numbers, F.lit(0).cast("bigint"), lambda acc, x: acc + F.coalesce(x, F.lit(0).cast("bigint")))


def xml_json_property(xml: Column, xml_path: str, json_path: str) -> Column:
    """A JSON value held as the text of an XML property."""
    return F.get_json_object(F.xpath_string(xml, F.lit(xml_path)), json_path)


def all_matches(df: DataFrame, text: str, pattern: str, group: int, out: str) -> DataFrame:
    """One row per match of the pattern in the whole text."""
    found = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group))
    return df.withColumn(out, F.explode(found))


def _number(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_extract(text, pattern, group), ",", ""), F.lit("")).cast("bigint")


def estimated_rows(text: Column) -> Column:
    return F.coalesce(_number(text, ESTIMATED_SIZE, 1), _number(text, ESTIMATED_ROWS, 1), F.lit(0).cast("bigint"))


def estimated_kb(text: Column) -> Column:
    """Estimated bytes in whole KB, at least 1 when an estimate is present, else 0."""
    size = F.coalesce(_number(text, ESTIMATED_SIZE, 2), _number(text, ESTIMATED_BYTES, 1))
    kb = F.floor(size / 1024)
    return F.when(size.isNull(), F.lit(0).cast("bigint")).otherwise(F.greatest(F.lit(1).cast("bigint"), kb))


def running_statement(text: Column, start: Column, end: Column) -> Column:
    """The part of a batch now running, from byte offsets of two-byte text; -1 means to the end."""
    stop = F.when(end == -1, F.length(text) * 2).otherwise(end)
    first = F.floor(start / 2).cast("int") + 1
    return F.substring(text, first, F.floor((stop - start) / 2).cast("int") + 1)


def report_measure_parts(text: Column, marker: str) -> tuple[Column, Column]:
    """Table and measure name of ``MEASURE 'table'[name] = ... <marker>`` text."""
    table = F.coalesce(
        F.nullif(F.regexp_extract(text, r"MEASURE\s+'([^']+)'\[", 1), F.lit("")),
        F.nullif(F.regexp_extract(text, r"MEASURE\s+([^\s'\[]+)\[", 1), F.lit("")),
    )
    head = F.substring_index(text, marker, 1)
    return table, F.nullif(F.regexp_extract(head, r"\[([^\]]+)\]", 1), F.lit(""))

"""Best-practice rules over model metadata.

A rule is a Spark SQL predicate over one object of its scope. Objects of a scope are one DataFrame,
so all rules of a scope are evaluated in one pass and give one row per violation.

Columns a scope may use. Column: name, table_name, data_type, column_type, is_hidden,
table_hidden, description, format_string, summarize_by, data_category, table_category,
source_column, is_key, sort_by, in_mdx, expression, relationships, many_side, one_side,
in_hierarchy, sorts_others, direct (the model reads its storage directly). Measure: name, is_hidden, description, format_string, expression,
referenced_by, same_definition, is_reference, unqualified_columns, qualified_measures. Table: name, is_hidden, description, data_category,
table_type, partitions, import_partitions, row_count, relationships, from_side, to_side, one_side,
many_to_many, has_security, activated_in_measures, model_hybrid, direct, field_parameter,
calculation_items (null unless the table is a calculation group).
Relationship: name, from_cardinality, to_cardinality, cross_filter, from_type, to_type, is_active,
activated. Partition: name, mode, source_type, expression, coverage, hybrid. Security: name,
filter_expression. Model: name, date_tables, bad_relationship_share, dual_partitions,
query_partitions, uses_views. CalculationItem: name, expression. Hierarchy: name.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    id: int
    category: str
    severity: str
    impact: str
    scopes: tuple[str, ...]
    predicate: str


def _r(id_: int, category: str, severity: str, impact: str, scopes: str, predicate: str) -> Rule:
    return Rule(id_, category, severity, impact, tuple(scopes.split(",")), predicate)


PERF, ERR, EXPR, MAINT, FMT, NAMES = (
    "Performance",
    "Error Prevention",
    "Expressions",
    "Maintenance",
    "Formatting",
    "Naming Conventions",
)
QUERY, BACK, USE = "Query Operation", "Background Operation", "Usability"
NUMERIC = "data_type IN ('Int64', 'Decimal', 'Double')"
ALL = "Table,Column,Measure,Partition,Hierarchy"

# The rule catalogue (ids, severities, thresholds and patterns).
RULES = [
    _r(1, PERF, "Warning", QUERY, "Column", "data_type = 'Double'"),
    _r(2, PERF, "Warning", BACK, "Column", "column_type = 'Calculated'"),
    _r(
        3,
        PERF,
        "Warning",
        QUERY,
        "Relationship",
        "(from_cardinality = 'many' AND to_cardinality = 'many') OR cross_filter = 'BothDirections'",
    ),
    _r(
        4,
        PERF,
        "Info",
        QUERY,
        "Security",
        r"filter_expression RLIKE r'(?i)USER(PRINCIPAL)?NAME\(\)'",
    ),
    _r(
        5,
        PERF,
        "Warning",
        QUERY,
        "Table",
        "many_to_many > 0 AND has_security",
    ),
    _r(
        6,
        PERF,
        "Warning",
        QUERY,
        "Relationship",
        "from_cardinality = 'many' AND to_cardinality = 'many' AND cross_filter = 'BothDirections'",
    ),
    _r(
        7,
        PERF,
        "Warning",
        QUERY,
        "Column",
        "in_mdx AND (is_hidden OR table_hidden) AND sort_by IS NULL AND NOT sorts_others AND NOT in_hierarchy AND NOT direct",
    ),
    _r(
        8,
        PERF,
        "Warning",
        QUERY,
        "Partition",
        "hybrid AND mode = 'DirectQuery' AND coverage IS NULL",
    ),
    _r(
        9,
        PERF,
        "Warning",
        QUERY,
        "Model",
        "dual_partitions > 0 AND query_partitions = 0",
    ),
    _r(
        10,
        PERF,
        "Warning",
        BACK,
        "Table",
        "import_partitions = 1 AND partitions = 1 AND model_hybrid AND one_side > 0",
    ),
    _r(
        11,
        PERF,
        "Warning",
        BACK,
        "Partition",
        r"source_type = 'M' AND expression RLIKE r'Table\.(Combine|Join|NestedJoin|AddColumn|Group|Sort|Pivot|Unpivot|UnpivotOtherColumns|Distinct)\(\"|\[Query=\(\"\"SELECT|Value\.NativeQuery|OleDb\.Query|Odbc\.Query'",
    ),
    _r(
        12,
        PERF,
        "Warning",
        QUERY,
        "Table",
        "calculation_items IS NULL AND from_side > 0 AND to_side > 0",
    ),
    _r(13, PERF, "Warning", QUERY, "Model", "uses_views"),
    _r(
        14,
        PERF,
        "Warning",
        QUERY,
        "Measure",
        r"replace(expression, ' ', '') LIKE '0+%' OR replace(expression, ' ', '') LIKE '%+0' OR expression RLIKE r'(?i)DIVIDE\s*\(\s*[^,]+,\s*[^,]+,\s*0\s*\)' OR expression RLIKE r'(?i)IFERROR\s*\(\s*[^,]+,\s*0\s*\)'",
    ),
    _r(15, PERF, "Warning", BACK, "Table", "table_type = 'Calculated' AND NOT field_parameter"),
    _r(
        16,
        PERF,
        "Warning",
        QUERY,
        "Column",
        r"column_type = 'Calculated' AND expression RLIKE r'(?i)related\s*\('",
    ),
    _r(
        17,
        PERF,
        "Warning",
        QUERY,
        "Model",
        "bad_relationship_share > 0.3",
    ),
    _r(
        18,
        PERF,
        "Warning",
        QUERY,
        "Table",
        "table_type = 'Calculated' AND (name LIKE 'DateTableTemplate\\_%' OR name LIKE 'LocalDateTable\\_%')",
    ),
    _r(
        19,
        PERF,
        "Warning",
        USE,
        "Table",
        "name RLIKE '(?i)date|calendar' AND NOT (data_category <=> 'Time')",
    ),
    _r(
        20,
        PERF,
        "Warning",
        BACK,
        "Table",
        "partitions = 1 AND row_count > 25000000 AND NOT direct",
    ),
    _r(
        21,
        PERF,
        "Warning",
        QUERY,
        "Security",
        r"filter_expression RLIKE r'(?i)(right|left|filter|upper|lower|find)\('",
    ),
    _r(22, PERF, "Warning", USE, "Model", "date_tables = 0"),
    _r(
        23,
        ERR,
        "Error",
        USE,
        "CalculationItem",
        "coalesce(expression, '') = ''",
    ),
    _r(
        24,
        ERR,
        "Warning",
        QUERY,
        "Relationship",
        "from_type <> to_type",
    ),
    _r(
        25,
        ERR,
        "Error",
        USE,
        "Column",
        "column_type = 'Data' AND coalesce(source_column, '') = ''",
    ),
    _r(
        26,
        ERR,
        "Warning",
        QUERY,
        "Column",
        "NOT in_mdx AND (sorts_others OR in_hierarchy OR sort_by IS NOT NULL) AND NOT direct",
    ),
    _r(
        27,
        ERR,
        "Error",
        QUERY,
        "Table",
        "activated_in_measures AND has_security",
    ),
    _r(28, EXPR, "Warning", QUERY, "Measure", r"expression RLIKE r'(?i)iferror\s*\('"),
    _r(
        29,
        EXPR,
        "Warning",
        QUERY,
        "Measure",
        r"expression RLIKE r'(?i)intersect\s*\('",
    ),
    _r(
        30,
        EXPR,
        "Warning",
        USE,
        "Measure",
        r"expression RLIKE r'(?i)evaluateandlog\s*\('",
    ),
    _r(31, EXPR, "Warning", USE, "Measure", "is_reference"),
    _r(32, EXPR, "Warning", USE, "Measure", "same_definition > 1"),
    _r(
        33,
        EXPR,
        "Warning",
        QUERY,
        "Measure",
        r"expression RLIKE r'(?i)DIVIDE\s*\((\s*.*?)\)\s*[+-]\s*1|\/\s*.*(?=[-+]\s*1)'",
    ),
    _r(
        34,
        EXPR,
        "Warning",
        QUERY,
        "Measure",
        r"expression RLIKE r'(?i)[0-9]+\s*[-+]\s*DIVIDE\s*\('",
    ),
    _r(
        35,
        EXPR,
        "Warning",
        QUERY,
        "Measure",
        r"expression RLIKE r'(?i)CALCULATE(TABLE)?\s*\(\s*[^,]+,\s*FILTER\s*\(\s*\x27*[A-Za-z0-9 _]+\x27*\s*,\s*\['",
    ),
    _r(
        36,
        EXPR,
        "Warning",
        QUERY,
        "Measure",
        r"expression RLIKE r'(?i)CALCULATE(TABLE)?\s*\([^,]*,\s*FILTER\s*\(\s*\x27*[A-Za-z0-9 _]+\x27*\s*,\s*\x27*[A-Za-z0-9 _]+\x27*\[[A-Za-z0-9 _]+\]'",
    ),
    _r(
        37,
        EXPR,
        "Warning",
        QUERY,
        "Measure",
        r"expression RLIKE r'[\])]\s*/(?!/)(?!\*)'",
    ),
    _r(38, EXPR, "Error", USE, "Measure", "unqualified_columns > 0"),
    _r(39, EXPR, "Error", USE, "Measure", "qualified_measures > 0"),
    _r(
        40,
        EXPR,
        "Warning",
        USE,
        "Relationship",
        "NOT is_active AND NOT activated",
    ),
    _r(
        41,
        MAINT,
        "Warning",
        USE,
        "Column",
        "(is_hidden OR table_hidden) AND relationships = 0 AND NOT in_hierarchy AND NOT sorts_others",
    ),
    _r(42, MAINT, "Warning", USE, "Measure", "is_hidden AND referenced_by = 0"),
    _r(
        43,
        MAINT,
        "Warning",
        USE,
        "Table",
        "relationships = 0 AND calculation_items IS NULL",
    ),
    _r(44, MAINT, "Warning", USE, "Table", "calculation_items = 0"),
    _r(
        45,
        MAINT,
        "Info",
        USE,
        "Column,Measure,Table",
        "NOT is_hidden AND coalesce(description, '') = ''",
    ),
    _r(
        46,
        FMT,
        "Warning",
        USE,
        "Column",
        "name RLIKE '(?i)date' AND data_type = 'DateTime' AND NOT (format_string <=> 'mm/dd/yyyy')",
    ),
    _r(
        47,
        FMT,
        "Warning",
        QUERY,
        "Column",
        f"{NUMERIC} AND NOT (summarize_by <=> 'None') AND NOT (is_hidden OR table_hidden)",
    ),
    _r(
        48,
        FMT,
        "Info",
        USE,
        "Measure",
        "NOT is_hidden AND coalesce(format_string, '') = ''",
    ),
    _r(
        49,
        FMT,
        "Info",
        USE,
        "Column",
        "coalesce(data_category, '') = '' AND name RLIKE '(?i)^(country|city|continent|latitude|longitude)'",
    ),
    _r(
        50,
        FMT,
        "Warning",
        USE,
        "Measure",
        "format_string LIKE '%\\%%' AND format_string <> '#,0.0%;-#,0.0%;#,0.0%'",
    ),
    _r(
        51,
        FMT,
        "Warning",
        USE,
        "Measure",
        "NOT contains(coalesce(format_string, ''), '$') AND NOT contains(coalesce(format_string, ''), '%') AND coalesce(format_string, '') NOT IN ('#,0', '#,0.0')",
    ),
    _r(52, FMT, "Info", USE, "Column", "NOT is_hidden AND many_side > 0"),
    _r(
        53,
        FMT,
        "Info",
        USE,
        "Column",
        "one_side > 0 AND NOT is_key AND NOT (table_category <=> 'Time')",
    ),
    _r(
        54,
        FMT,
        "Info",
        USE,
        "Column",
        "name RLIKE '(?i)month' AND NOT name RLIKE '(?i)months' AND data_type = 'String' AND coalesce(sort_by, '') = ''",
    ),
    _r(
        55,
        FMT,
        "Warning",
        QUERY,
        "Relationship",
        "from_type <> 'Int64' OR to_type <> 'Int64'",
    ),
    _r(
        56,
        FMT,
        "Warning",
        USE,
        "Column",
        "name RLIKE '(?i)month' AND data_type = 'DateTime' AND NOT (format_string <=> 'MMMM yyyy')",
    ),
    _r(
        57,
        FMT,
        "Info",
        USE,
        "Column",
        "NOT (is_hidden OR table_hidden) AND ((lower(name) LIKE 'is%' AND data_type = 'Int64') OR (lower(name) LIKE '% flag' AND data_type <> 'String'))",
    ),
    _r(58, FMT, "Error", USE, ALL, "name LIKE ' %' OR name LIKE '% '"),
    _r(
        59,
        FMT,
        "Info",
        USE,
        ALL,
        "left(name, 1) <> upper(left(name, 1))",
    ),
    _r(60, NAMES, "Warning", USE, ALL, r"name RLIKE r'[\t\r\n]'"),
]


def catalogue(spark, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per rule; ``rule`` is the predicate that a violating object fulfils."""
    rows = [(r.id, r.category, r.severity, r.impact, ",".join(r.scopes), r.predicate) for r in rules]
    return spark.createDataFrame(
        rows, "rule_id int, category string, severity string, impact string, scopes string, rule string"
    )


def violations(objects: Mapping[str, DataFrame], rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per violated rule and object; ``objects`` maps a scope to its metadata rows.

    ``table_name`` tells equal names of different tables apart; it is null in scopes that have none.
    """
    out = None
    for scope, df in objects.items():
        hits = [
            F.when(
                F.expr(r.predicate),
                F.struct(
                    F.lit(r.id).alias("rule_id"),
                    F.lit(r.category).alias("category"),
                    F.lit(r.severity).alias("severity"),
                    F.lit(r.impact).alias("impact"),
                ),
            )
            for r in rules
            if scope in r.scopes
        ]
        if not hits:
            continue
        owner = F.col("table_name") if "table_name" in df.columns else F.lit(None).cast("string").alias("table_name")
        part = df.select(
            F.col("name").alias("object_name"), owner, F.explode(F.array_compact(F.array(*hits))).alias("v")
        ).select(F.lit(scope).alias("object_type"), "table_name", "object_name", "v.*")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no scope with rules")
    return out


def with_definition_facts(measures: DataFrame) -> DataFrame:
    """Measures with the facts about other measures that the rules need: equal definitions, plain
    references and the number of referencing measures."""
    squeezed = F.regexp_replace("expression", r"\s+", "")
    same = measures.groupBy(squeezed.alias("_d")).agg(F.count_distinct("name").alias("same_definition"))
    refs = measures.select(
        F.explode(F.regexp_extract_all("expression", F.lit(r"\[([^\]]+)\]"), F.lit(1))).alias("_ref"),
        F.col("name").alias("_by"),
    )
    used = refs.groupBy("_ref").agg(F.count_distinct("_by").alias("referenced_by"))
    names = measures.select(
        F.concat(F.lit("["), F.col("name"), F.lit("]")).alias("_plain")
    ).distinct().withColumn("is_reference", F.lit(True))
    return (
        measures.withColumn("_d", squeezed)
        .join(same, "_d")
        .join(used, F.col("name") == F.col("_ref"), "left")
        .join(names, F.col("expression") == F.col("_plain"), "left")
        .drop("_d", "_ref", "_plain")
        .fillna({"referenced_by": 0, "is_reference": False})
    )


def with_relationship_facts(tables: DataFrame, relationships: DataFrame) -> DataFrame:
    """Tables with their relationships: in all, as the from and the to side, as the one side, and
    many-to-many. Relationships carry from_table, to_table and the cardinalities of both ends."""
    many_to_many = (F.col("from_cardinality") == "many") & (F.col("to_cardinality") == "many")
    ends = F.array(
        F.struct(F.col("from_table").alias("t"), F.lit(1).alias("f"), F.lit(0).alias("o")),
        F.struct(
            F.col("to_table").alias("t"), F.lit(0).alias("f"), (F.col("to_cardinality") == "one").cast("int").alias("o")
        ),
    )
    sides = relationships.select(many_to_many.cast("int").alias("m"), F.explode(ends).alias("e"))
    facts = sides.groupBy(F.col("e.t").alias("_table")).agg(
        F.count(F.lit(1)).alias("relationships"),
        F.sum("e.f").alias("from_side"),
        F.sum(1 - F.col("e.f")).alias("to_side"),
        F.sum("e.o").alias("one_side"),
        F.sum("m").alias("many_to_many"),
    )
    joined = tables.join(facts, F.col("name") == F.col("_table"), "left").drop("_table")
    return joined.fillna(0, ["relationships", "from_side", "to_side", "one_side", "many_to_many"])


def with_key_facts(columns: DataFrame, relationships: DataFrame) -> DataFrame:
    """Columns with the relationships they take part in, on the many side and on the one side."""
    ends = F.array(
        F.struct(
            F.col("from_table").alias("t"),
            F.col("from_column").alias("c"),
            (F.col("from_cardinality") == "many").cast("int").alias("m"),
            F.lit(0).alias("o"),
        ),
        F.struct(
            F.col("to_table").alias("t"),
            F.col("to_column").alias("c"),
            F.lit(0).alias("m"),
            (F.col("to_cardinality") == "one").cast("int").alias("o"),
        ),
    )
    facts = (
        relationships.select(F.explode(ends).alias("e"))
        .groupBy(F.col("e.t").alias("_table"), F.col("e.c").alias("_column"))
        .agg(F.count(F.lit(1)).alias("relationships"), F.sum("e.m").alias("many_side"), F.sum("e.o").alias("one_side"))
    )
    own = (F.col("table_name") == F.col("_table")) & (F.col("name") == F.col("_column"))
    joined = columns.join(facts, own, "left").drop("_table", "_column")
    return joined.fillna(0, ["relationships", "many_side", "one_side"])


def summary(found: DataFrame, severity: str | None = None, category: str | None = None) -> DataFrame:
    """Violations counted by severity, by category and by object type, optionally filtered first."""
    if severity is not None:
        found = found.filter(F.col("severity") == severity)
    if category is not None:
        found = found.filter(F.col("category") == category)
    sides = F.array(
        *[
            F.struct(
                F.lit(k).alias("grouped_by"), F.col(k).alias("value")
            ) for k in ("severity", "category", "object_type")
        ]
    )
    return found.select(F.explode(sides).alias("s")).select("s.*").groupBy("grouped_by", "value").agg(
        F.count(F.lit(1)).alias("violations")
    )

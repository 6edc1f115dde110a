"""Raw JSON drops: documents with one top-level array of records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_documents(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """Documents of a drop. A multi-line file is one document and one task; a file with a document
    per line is split. Without a schema Spark infers one, which costs a pass over the drop."""
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def records(docs: DataFrame, *array_fields: str) -> DataFrame:
    """One row per record of the first listed array field that the documents have."""
    for field in array_fields:
        if field in docs.columns:
            exploded = docs.select(F.explode(field).alias("d"))
            inner = exploded.schema["d"].dataType
            return exploded.select("d.*") if isinstance(inner, T.StructType) else exploded
    raise ValueError(f"none of {array_fields} in {docs.columns}")


def read_json_drop(
    spark: SparkSession, path: str, *array_fields: str, schema=None, multi_line: bool = True
) -> DataFrame:
    return records(read_documents(spark, path, schema, multi_line), *array_fields)


def with_defaults(df: DataFrame, drop: Sequence[str] = (), **defaults: Column) -> DataFrame:
    """Add the missing optional columns with their defaults, and drop unwanted ones."""
    missing = {c: v for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing).drop(*drop)


def list_records(
    docs: DataFrame, array_field: str = "value", fields: str = "fields", columns: Sequence[str] | None = None
) -> DataFrame:
    """Records of an API page as text columns, optionally only the listed ones."""
    rows = docs.select(F.explode(array_field).alias("r")).select(f"r.{fields}.*")
    wanted = list(columns) if columns is not None else rows.columns
    return rows.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in wanted])


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Struct fields as columns of their own, to any depth."""
    out = df
    while any(isinstance(f.dataType, T.StructType) for f in out.schema.fields):
        cols = []
        for f in out.schema.fields:
            if isinstance(f.dataType, T.StructType):
                cols += [F.col(f"`{f.name}`.`{c}`").alias(f"{f.name}{sep}{c}") for c in f.dataType.fieldNames()]
            else:
                cols.append(F.col(f"`{f.name}`"))
        out = out.select(*cols)
    return out


def artifact_rows(
    containers: DataFrame, container_id: str, array_field: str, rename: Mapping[str, str], upper: Sequence[str], drop: Sequence[str] = (), dates: Mapping[str, str] | None = None
) -> DataFrame | None:
    """One artifact type of an inventory scan as flat rows, or None when the scan has none.

    Records without an id are dropped, id columns are upper-cased, and ``dates`` adds day columns
    cut from timestamp texts.
    """
    if array_field not in containers.columns:
        return None
    rows = containers.select(container_id, F.explode_outer(array_field).alias("_a")).filter(F.col("_a").isNotNull())
    if not isinstance(rows.schema["_a"].dataType, T.StructType):
        return None
    flat = flatten(rows.select(container_id, "_a.*"))
    key = "id" if "id" in flat.columns else "objectId"
    flat = flat.filter(F.col(f"`{key}`").isNotNull()).drop(*drop)
    out = flat.select(*[F.col(f"`{c}`").alias(rename.get(c, c)) for c in flat.columns])
    out = out.withColumns({c: F.upper(f"`{c}`") for c in upper if c in out.columns})
    return out.withColumns({new: F.substring(old, 1, 10) for new, old in (dates or {}).items() if old in out.columns})


# Fields that hold a user's right when the artifact type has none of its own.
COMMON_RIGHTS = ("artifactUserAccessRight", "groupUserAccessRight")


def own_right(kind: str) -> str:
    """The right field of an artifact type: ``reports`` keep it in ``reportUserAccessRight``."""
    return f"{kind.removesuffix('s')}UserAccessRight"


def _fields(dt: T.DataType) -> set[str]:
    if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
        return set(dt.elementType.fieldNames())
    return set()


def access_matrix(containers: DataFrame, container_id: str) -> DataFrame:
    """One row per container, item and user with the user's right, over all artifact types.

    Every array of records with ``users`` is an artifact type.
    """
    parts = []
    for kind in containers.columns:
        if "users" not in _fields(containers.schema[kind].dataType):
            continue
        item_fields = _fields(containers.schema[kind].dataType)
        items = containers.select(F.upper(container_id).alias("WorkspaceId"), F.explode(kind).alias("i"))
        users = items.select("WorkspaceId", "i", F.explode("i.users").alias("u"))
        user_fields = set(users.schema["u"].dataType.fieldNames())

        def first(struct: str, have: set[str], *names: str) -> Column:
            found = [F.nullif(F.col(f"{struct}.{n}"), F.lit("")) for n in names if n in have]
            return F.coalesce(*found, F.lit(""))

        parts.append(
            users.select(
                "WorkspaceId",
                F.upper(first("i", item_fields, "id", "objectId")).alias("ItemId"),
                F.lit(kind).alias("ItemType"),
                first("i", item_fields, "name", "displayName").alias("ItemName"),
                first("u", user_fields, own_right(kind), *COMMON_RIGHTS).alias("AccessRight"),
                first("u", user_fields, "emailAddress").alias("EmailAddress"),
                first("u", user_fields, "displayName").alias("DisplayName"),
                first("u", user_fields, "identifier").alias("Identifier"),
                F.upper(first("u", user_fields, "graphId")).alias("GraphId"),
                first("u", user_fields, "principalType").alias("PrincipalType"),
                first("u", user_fields, "userType").alias("UserType"),
            )
        )
    if not parts:
        raise ValueError("no artifact type with users in the scan")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.filter((F.col("ItemId") != "") | (F.col("ItemName") != ""))

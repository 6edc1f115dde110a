import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.conftest import rows
from tidegauge.functions import columns as C
from tidegauge.functions import texts as X
from tidegauge.jobs import profile, rules, telemetry
from tidegauge.operators import measures as M
from tidegauge.operators import sets as S
from tidegauge.sources import billing, databases, delimited, files, json_drop, metadata
from tidegauge.tables import maintenance as K
from tidegauge.tables import versioned as V

MONTHLY = '"{34222872-B554-4D2B-E063-4704A8C07853}","375000","2004-04-27 00:00","SW13 0NP","D","N","F","10A","","THE TERRACE","","LONDON","RICHMOND UPON THAMES","GREATER LONDON","A","A"'
YEARLY = '"{7130F2C1-B3E4-41A5-9103-3DC40A6A5466}","166500","1995-11-22 00:00","CM23 4PA","D","Y","F","19","","MAYFLOWER GARDENS","BISHOP\'S STORTFORD","BISHOP\'S STORTFORD","EAST HERTFORDSHIRE","HERTFORDSHIRE","A"'


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_price_paid_lines(spark, tmp_path):
    write(f"{tmp_path}/in/pp.csv", MONTHLY + "\n" + YEARLY + "\n")
    got = {r["TransactionId"]: r for r in delimited.read_price_paid(spark, f"{tmp_path}/in").collect()}
    first = got["{34222872-B554-4D2B-E063-4704A8C07853}"]
    assert first["Price"] == 375000 and str(first["DateOfTransfer"]) == "2004-04-27 00:00:00"
    assert (first["PropertyType"], first["IsNew"], first["DurationType"]) == ("Detached", False, "Freehold")
    assert (first["SecondaryAddressableObjectName"], first["Street"], first["Locality"]) == ("", "THE TERRACE", "")
    assert (first["CategoryType"], first["RecordStatus"]) == ("StandardPricePaid", "A")
    second = got["{7130F2C1-B3E4-41A5-9103-3DC40A6A5466}"]
    assert second["IsNew"] is True and second["TownCity"] == "BISHOP'S STORTFORD" and second["RecordStatus"] is None


def test_price_paid_unknown_code_fails(spark, tmp_path):
    write(f"{tmp_path}/in/pp.csv", MONTHLY.replace('"D","N"', '"Q","N"') + "\n")
    with pytest.raises(Exception, match="unknown code Q"):
        delimited.read_price_paid(spark, f"{tmp_path}/in").collect()


def test_price_paid_changes_put_the_marker_last(spark, tmp_path):
    write(f"{tmp_path}/in/pp.csv", MONTHLY + "\n")
    out = delimited.price_paid_changes(delimited.read_price_paid(spark, f"{tmp_path}/in"))
    assert out.columns[-1] == "__rowMarker__" and out.first()["__rowMarker__"] == 0


def test_json_drop_of_multi_line_documents(spark, tmp_path):
    for i in range(3):
        doc = {"activityEventEntities": [{"Id": f"a{i}", "Extra": {"x": i}}, {"Id": f"b{i}"}]}
        write(f"{tmp_path}/raw/{i}.json", json.dumps(doc, indent=2))
    df = json_drop.read_json_drop(spark, f"{tmp_path}/raw", "activityEventEntities")
    assert sorted(r["Id"] for r in df.collect()) == ["a0", "a1", "a2", "b0", "b1", "b2"]
    flat = C.complex_to_text(df)
    assert dict(flat.dtypes)["Extra"] == "string"
    assert flat.filter("Id = 'a2'").first()["Extra"] == '{"x":2}'


def test_fallback_field_and_defaults(spark, tmp_path):
    write(f"{tmp_path}/raw/1.json", json.dumps({"value": [{"id": "1", "hasSettings": True}]}))
    df = json_drop.read_json_drop(spark, f"{tmp_path}/raw", "Overrides", "value")
    out = json_drop.with_defaults(df, drop=["hasSettings"], description=F.lit(""))
    assert rows(out) == [("1", "")]
    with pytest.raises(ValueError):
        json_drop.read_json_drop(spark, f"{tmp_path}/raw", "absent")


def test_inventory_skips_types_the_scan_lacks(spark, tmp_path):
    scan = {
        "workspaces": [
            {
                "id": "w",
                "reports": [
                    {"id": "r1", "name": "R", "users": [{"identifier": "u", "reportUserAccessRight": "Owner"}]},
                    {"name": "no id"},
                ],
            },
            {"id": "v"},
        ]
    }
    write(f"{tmp_path}/raw/1.json", json.dumps(scan))
    ws = json_drop.read_json_drop(spark, f"{tmp_path}/raw", "workspaces").withColumnRenamed("id", "WorkspaceId")
    assert json_drop.artifact_rows(ws, "WorkspaceId", "datasets", {}, []) is None
    reports = json_drop.artifact_rows(ws, "WorkspaceId", "reports", {"id": "ReportId"}, ["ReportId"], ["users"])
    assert rows(reports.select("WorkspaceId", "ReportId")) == [("w", "R1")]
    matrix = json_drop.access_matrix(ws, "WorkspaceId")
    assert rows(matrix.select("WorkspaceId", "ItemId", "AccessRight")) == [("W", "R1", "Owner")]


def test_billing_periods():
    import datetime as dt

    assert billing.periods(dt.date(2024, 3, 1), -1, 0) == [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    assert billing.folder_of(dt.date(2024, 2, 1)) == "20240201-20240229"
    assert billing.folder_of(dt.date(2023, 12, 1)) == "20231201-20231231"


def test_billing_reader_skips_missing_months(spark, tmp_path):
    import datetime as dt

    spark.range(5).write.parquet(f"{tmp_path}/20240201-20240229/guid")
    df = billing.read_billing_period(spark, str(tmp_path), dt.date(2024, 3, 1), -3, 0)
    assert df.count() == 5
    assert billing.read_billing_period(spark, str(tmp_path), dt.date(2020, 3, 1), 0, 0) is None


def test_rejects(spark, tmp_path):
    write(f"{tmp_path}/in/a.tbl", '1|"x|y"|2.5\nbad|z|1\n2|w|oops\n3|v|0\n')
    schema = T.StructType(
        [T.StructField("k", T.LongType()), T.StructField("s", T.StringType()), T.StructField("d", T.DoubleType())]
    )
    good, bad = delimited.load_with_rejects(spark, f"{tmp_path}/in", schema, f"{tmp_path}/out")
    assert rows(good) == [(1, "x|y", 2.5), (3, "v", 0.0)]
    assert rows(good.select("k")) == [(1,), (3,)]
    assert rows(bad) == [("a.tbl", "2|w|oops"), ("a.tbl", "bad|z|1")]


def test_log_folder_and_bad_records(spark, tmp_path):
    write(f"{tmp_path}/logs/Query_1.log", 'id,js\n1,"{""a"":1}"\n2,{broken\n3,"[1]"\n')
    write(f"{tmp_path}/logs/sub/Query_2.log", "id,js\n4,nope}\n")
    write(f"{tmp_path}/logs/Other.log", "id,js\n9,x\n")
    write(f"{tmp_path}/logs/Query.txt", "id,js\n9,x\n")
    df = delimited.read_logs(spark, f"{tmp_path}/logs", "Query", "id int, js string", ["id"])
    assert rows(df) == [(1, "Query_1.log"), (2, "Query_1.log"), (3, "Query_1.log"), (4, "Query_2.log")]
    raw = spark.read.schema("id int, js string").options(
        header=True, escape='"', recursiveFileLookup=True, pathGlobFilter="*Query*.log"
    ).csv(f"{tmp_path}/logs")
    assert rows(delimited.unparsable(raw, "js")) == [("Query_1.log", 3, "{broken"), ("Query_2.log", 2, "nope}")]


def test_storage_summary(spark, tmp_path):
    write(f"{tmp_path}/t/a.parquet", "12345")
    write(f"{tmp_path}/t/log/0.json", "123")
    got = {r["kind"]: (r["files"], r["bytes"]) for r in files.storage_summary(spark, f"{tmp_path}/t").collect()}
    assert got == {"data": (1, 5), "log": (1, 3)}


def test_blank_rules(spark):
    df = spark.createDataFrame(
        [(1, True, "Reservation", 2), (2, None, None, 0), (4, False, "Plan", None)],
        "v int, flag boolean, kind string, d int",
    )
    out = df.agg(
        M.filtered(F.sum, F.col("v"), M.is_false(F.col("flag"))).alias("not_true"),
        M.filtered(F.sum, F.col("v"), M.differs(F.col("kind"), "Reservation")).alias("others"),
        M.distinct_values(F.col("kind")).alias("kinds"),
        M.or_zero(M.filtered(F.sum, F.col("v"), F.col("kind") == "none")).alias("none"),
        M.ratio(F.lit(1), F.lit(0)).alias("blank"),
    ).first()
    assert tuple(out) == (6, 6, 3, 0, None)


def test_month_over_month_with_a_gap(spark):
    df = spark.createDataFrame(
        [("2024-01-01", 10), ("2024-02-01", 15), ("2024-04-01", 30)], "m string, n int"
    ).withColumn("m", F.to_date("m"))
    got = {str(r["m"]): r["g"] for r in M.period_over_period(df, [], "m", g="n").collect()}
    assert got == {"2024-01-01": None, "2024-02-01": 0.5, "2024-04-01": None}


def test_text_functions(spark):
    row = spark.range(1).select(
        X.bracket_sum(F.lit("a [12,30] b")).alias("s"),
        X.estimated_rows(F.lit("Estimated size (rows, bytes): 10, 2048")).alias("r"),
        X.estimated_kb(F.lit("Estimated size (rows, bytes): 10, 2048")).alias("kb"),
        X.estimated_kb(F.lit("bytes=1,000")).alias("floor"),
        X.estimated_kb(F.lit("nothing")).alias("none"),
        X.decode_query_text(F.lit("bGluZQpuZXh0DQrkgA==")).alias("text"),
    ).first()
    assert tuple(row) == (42, 10, 2, 1, 0, "line next ä€")


def test_equivalence_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    b = spark.createDataFrame([(1,), (2,), (2,)], "v int")
    out = S.equivalence(a, b).first()
    assert out["same_count"] and not out["equal"] and out["different_rows"] == 2
    assert S.equivalence(a, a.repartition(3)).first()["equal"]
    same, other = S.content_signature(a).first(), S.content_signature(b).first()
    assert same != other and same == S.content_signature(a.repartition(3)).first()


def test_drift_and_sync(spark):
    old = metadata.column_metadata(spark, {"t": spark.createDataFrame([], "a int, b string, c int")})
    new = metadata.column_metadata(spark, {"t": spark.createDataFrame([], "a bigint, c int, d date")})
    assert rows(metadata.drift_report(metadata.drift(old, new))) == [
        ("t", "added", "d"), ("t", "dropped", "b"), ("t", "retyped", "a")
    ]
    definition = spark.createDataFrame(
        [("t", "a", "int"), ("t", "z", "date"), ("t", "s", "struct<a:int>")],
        "table_name string, column_name string, data_type string",
    )
    assert [r["column_name"] for r in V.missing_columns(definition, old).collect()] == ["z"]


def test_clean_names():
    assert V.clean_name("a (b);{c}\t.d e") == "a_bc_d_e"
    assert C.camel_case("Event Class") == "eventClass"


def test_all_rules_are_valid_predicates(spark):
    """Each scope's rules resolve against the documented columns."""
    shapes = {
        "Column": "name string, table_name string, data_type string, column_type string, is_hidden boolean, table_hidden boolean, description string, format_string string, summarize_by string, data_category string, table_category string, source_column string, is_key boolean, sort_by string, in_mdx boolean, expression string, relationships int, many_side int, one_side int, in_hierarchy boolean, sorts_others boolean, direct boolean",
        "Measure": "name string, is_hidden boolean, description string, format_string string, expression string, referenced_by int, same_definition int, is_reference boolean, unqualified_columns int, qualified_measures int",
        "Table": "name string, is_hidden boolean, description string, data_category string, table_type string, partitions int, import_partitions int, row_count bigint, relationships int, from_side int, to_side int, one_side int, many_to_many int, has_security boolean, activated_in_measures boolean, model_hybrid boolean, direct boolean, field_parameter boolean, calculation_items int",
        "Relationship": "name string, from_cardinality string, to_cardinality string, cross_filter string, from_type string, to_type string, is_active boolean, activated boolean",
        "Partition": "name string, mode string, source_type string, expression string, coverage string, hybrid boolean",
        "Security": "name string, filter_expression string",
        "Model": "name string, date_tables int, bad_relationship_share double, dual_partitions int, query_partitions int, uses_views boolean",
        "CalculationItem": "name string, expression string",
        "Hierarchy": "name string",
    }
    rows_ = {
        "Relationship": [("r", "many", "many", "BothDirections", "Int64", "String", False, False)],
        "Table": [("LocalDateTable_1", False, None, None, "Calculated", 1, 1, 30000000, 0, 1, 1, 1, 1, True, True, True, False, False, None), ("Group", False, "d", None, "Group", 1, 0, 1, 0, 0, 0, 0, 0, False, False, False, False, False, 0), ("Direct", False, "d", None, "Calculated", 1, 0, 30000000, 1, 0, 0, 0, 0, False, False, False, True, True, None)],
        "Partition": [("P", "DirectQuery", "M", 'x = Table.Join("a")', None, True)],
        "Security": [("S", "USERPRINCIPALNAME() = upper(x)")],
        "Model": [("Model", 0, 0.5, 1, 0, True)],
        "CalculationItem": [("Item", "")],
        "Hierarchy": [(" h",)],
        "Measure": [
            ("M", False, "d", "#,0", "CALCULATE([x], FILTER('Sales Q', [y] > 1))", 0, 1, False, 1, 1),
            ("N", False, "d", "#,0", "CALCULATE([x], FILTER(Sales, Sales[y] = 1))", 0, 1, False, 0, 0),
        ],
    }
    objects = {k: spark.createDataFrame(rows_.get(k, []), v) for k, v in shapes.items()}
    found = {}
    for r in rules.violations(objects).collect():
        assert r["object_name"] != "Direct"
        found.setdefault(r["object_type"], set()).add(r["rule_id"])
    assert found["Relationship"] == {3, 6, 24, 40, 55}
    assert found["Table"] == {5, 10, 12, 15, 18, 19, 20, 27, 43, 44, 45}
    assert found["CalculationItem"] == {23}
    assert found["Hierarchy"] == {58}
    assert found["Measure"] == {35, 36, 38, 39}
    assert found["Partition"] == {8, 11}
    assert found["Security"] == {4, 21}
    assert found["Model"] == {9, 13, 17, 22}
    scopes = {s for r in rules.RULES for s in r.scopes}
    assert scopes == set(shapes) and rules.catalogue(spark).count() == len(rules.RULES) == 60
    assert [r.id for r in rules.RULES] == list(range(1, 61))


def test_relationship_facts(spark):
    schema = "from_table string, from_column string, from_cardinality string, to_table string, to_column string, to_cardinality string"
    links = spark.createDataFrame(
        [("Sales", "k", "many", "Item", "k", "one"), ("Item", "g", "many", "Group", "g", "many")], schema
    )
    tables = spark.createDataFrame([("Sales",), ("Item",), ("Group",), ("Alone",)], "name string")
    got = {r["name"]: tuple(r)[1:] for r in rules.with_relationship_facts(tables, links).collect()}
    assert got == {
        "Sales": (1, 1, 0, 0, 0), "Item": (2, 1, 1, 1, 1), "Group": (1, 0, 1, 0, 1), "Alone": (0, 0, 0, 0, 0)
    }
    columns = spark.createDataFrame([("Sales", "k"), ("Item", "k"), ("Item", "x")], "table_name string, name string")
    got = {tuple(r)[:2]: tuple(r)[2:] for r in rules.with_key_facts(columns, links).collect()}
    assert got == {("Sales", "k"): (1, 1, 0), ("Item", "k"): (1, 0, 1), ("Item", "x"): (0, 0, 0)}


def test_profile_with_empty_pipelines(spark):
    pipelines = spark.createDataFrame([("a",), ("b",)], "name string")
    activities = spark.createDataFrame(
        [("a", "Copy"), ("a", "ExecutePipeline"), ("a", None)], "pipeline string, type string"
    )
    out = profile.activity_metrics(pipelines, activities).first()
    assert tuple(out) == (2, 3, 1.5, 3, "a", 1)
    assert rows(profile.activities_by_type(activities)) == [("Copy", 1), ("ExecutePipeline", 1), ("Unknown", 1)]


def test_new_meters_continue_the_keys(spark):
    meters = spark.createDataFrame([("known", 5)], "Name_Lower string, MeterKey bigint")
    focus = spark.createDataFrame(
        [("KNOWN", "c", None), ("New B", "c", None), ("new a", "Cap", "x")],
        "x_SkuMeterName string, ChargeDescription string, BillingType string",
    )
    out = telemetry.all_meters(meters, focus, {"Cap": "Units"})
    got = {r["Name_Lower"]: (r["MeterKey"], r["Category"], r["Included"]) for r in out.collect()}
    assert got["new a"] == (6, "Units", "TRUE") and got["new b"] == (7, "c", "FALSE") and got["known"][0] == 5


def test_static_tables_keep_unknown_and_null_names(spark):
    df = spark.createDataFrame([(1, "Dubai"), (2, "UAE North"), (3, None)], "k int, region string")
    out = metadata.with_static(df, metadata.regions(spark), "region", "region")
    assert rows(out.select("k", "location")) == [(1, None), (2, "Dubai"), (3, None)]


def test_moved_paths_replace_whole_names_only(spark):
    paths = [("abfss://w@h/l.Lakehouse/Tables/a",), ("abfss://w2@h/l.Lakehouse/Tables/a",), ("abfss://w@h/al.Lakehouse/Tables/l",), (None,)]
    df = spark.createDataFrame(paths, "p string")
    out = [r[0] for r in df.select(K.moved_path(F.col("p"), ("w", "x"), ("l", "m"), suffix="_r")).collect()]
    assert out == ["abfss://x@h/m.Lakehouse/Tables/a_r", "abfss://w2@h/m.Lakehouse/Tables/a_r", "abfss://x@h/al.Lakehouse/Tables/l_r", None]


def test_moved_ledger_takes_new_ids_only(spark, tmp_path):
    path = f"{tmp_path}/ledger"
    changes = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, "c")], "id int, v string")
    databases.record_moved(changes.filter("id = 1"), "id", path)
    batch = databases.unmoved(changes, spark.read.parquet(path), "id")
    assert rows(batch) == [(2, "b"), (2, "b"), (3, "c")]
    databases.record_moved(batch, "id", path)
    ledger = spark.read.parquet(path)
    assert rows(ledger) == [(1,), (2,), (3,)]
    databases.record_moved(changes.filter("id = 3"), "id", path)  # repeated after a failure
    assert databases.unmoved(changes, spark.read.parquet(path), "id").count() == 0

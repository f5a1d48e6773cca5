import datetime
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from feedkit.functions import (
    cast_as,
    map_all,
    map_by_index,
    map_by_name,
    map_by_position,
    row_hash,
    spark_type,
    sql_expression,
    substring_columns,
    with_function,
)
from feedkit.functions.declared import declare_functions
from feedkit.functions.lenient import lenient
from feedkit.functions.types import spark_pattern
from feedkit.operators import apply_mapping, compare_layout, conform, rename, rename_by_mapping

RUN = "2023-05-10"


def to(source, name, type_name=None, expression=None, source_type=""):
    target = {"name": name}
    if type_name:
        target["type"] = type_name
    if expression:
        target["expression"] = expression
    return {"source": {"name": source, "type": source_type}, "target": target}


MAPPING = {
    "mappings": [
        to("LONGITUDE", "LONGITUDE_NEW", "DOUBLE"),
        to("Country", "Country", "VARCHAR(5)"),
        to("SOURCE_DATE", "TARGET_DATE", "DATE", "TO_DATE(SOURCE_DATE,'dd/mm/yyyy')"),
        to("", "TARGET_EXP", "VARCHAR", " LONGITUDE ||','|| Country "),
        to("SOURCE_TIMESTAMP", "TARGET_TIMESTAMP", "TIMESTAMP", "to_timestamp(SOURCE_TIMESTAMP, 'yyyy/MM/dd HH:mm:ss')"),
        to("", "COUNTRY_FLAG", "VARCHAR", "substring(Country, 1, 3)"),
        to("", "STATIC_VALUE", "VARCHAR", "concat('', 'Im constant string')"),
        to("", "dt2_business", "DATE", "current_date()"),
    ]
}
LAYOUT = {
    "properties": [
        {"name": "LONGITUDE_NEW", "type": "DOUBLE"},
        {"name": "Country", "type": "VARCHAR(5)"},
        {"name": "TARGET_DATE", "type": "DATE"},
        {"name": "TARGET_EXP", "type": "VARCHAR"},
        {"name": "TARGET_TIMESTAMP", "type": "TIMESTAMP"},
        {"name": "COUNTRY_FLAG", "type": "VARCHAR"},
        {"name": "STATIC_VALUE", "type": "VARCHAR"},
    ]
}


@pytest.fixture
def feed(spark):
    return spark.createDataFrame(
        [
            ("1.2", "INDIA    ", "13/12/2023", "2022/05/10 12:30:00"),
            ("2.4", "AUSTRELIA", "02/01/2022", "2023/02/28 10:30:00"),
        ],
        "LONGITUDE string, Country string, SOURCE_DATE string, SOURCE_TIMESTAMP string",
    )


def test_mapping(feed, rows):
    result = apply_mapping(feed, MAPPING, run_date=RUN)
    assert result.columns == [m["target"]["name"] for m in MAPPING["mappings"]]
    day, moment = datetime.date, datetime.datetime
    assert rows(result) == [
        (1.2, "INDIA", day(2023, 12, 13), "1.2,INDIA    ", moment(2022, 5, 10, 12, 30), "IND",
         "Im constant string", day(2023, 5, 10)),
        (2.4, "AUSTR", day(2022, 1, 2), "2.4,AUSTRELIA", moment(2023, 2, 28, 10, 30), "AUS",
         "Im constant string", day(2023, 5, 10)),
    ]


def test_documents_from_files(feed, rows, tmp_path):
    mapping, layout = tmp_path / "mapping.json", tmp_path / "layout.json"
    mapping.write_text(json.dumps(MAPPING, indent=2))
    layout.write_text(json.dumps(LAYOUT))
    mapped = apply_mapping(feed, str(mapping), run_date=RUN)
    assert rows(mapped) == rows(apply_mapping(feed, MAPPING, run_date=RUN))
    assert conform(mapped, str(layout), on_extra="drop").columns == [p["name"] for p in LAYOUT["properties"]]


def test_date_dialect_of_spark_reads_minutes(feed, rows):
    result = apply_mapping(feed, {"mappings": MAPPING["mappings"][2:3]}, date_dialect="spark")
    assert rows(result)[1] == (datetime.date(2023, 1, 13),)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("to_date('13.12.2023','dd.mm.yyyy')", datetime.date(2023, 12, 13)),
        ("TO_DATE('2023-12-13', 'YYYY-MM-DD')", datetime.date(2023, 12, 13)),
        ("to_date(concat('2023-12', '-13'),'yyyy-mm-dd')", datetime.date(2023, 12, 13)),
        ("to_date(date_format(DATE'2023-12-13', 'dd/mm/yyyy'), 'dd/mm/yyyy')", datetime.date(2023, 12, 13)),
        ("date_format(TIMESTAMP'2023-12-13 10:20:30', 'mm')", "20"),
        ("replace('mm-yy', '-', 'mm')", "mmmmyy"),
        ("to_timestamp('10:20', 'HH:mm')", datetime.datetime(1970, 1, 1, 10, 20)),
    ],
)
def test_date_patterns(spark, text, expected):
    assert spark.range(1).select(sql_expression(text)).first()[0] == expected


def test_constants_and_repeated_sources(feed, rows):
    mapping = {
        "mappings": [
            to("LONGITUDE", "A", "DOUBLE"),
            to("LONGITUDE", "B", "VARCHAR"),
            to("I'm Constant", "STATIC_VALUE", "VARCHAR", source_type="constant"),
            to("12", "NUMBER", "INTEGER", source_type="CONSTANT"),
        ]
    }
    assert rows(apply_mapping(feed, mapping))[0] == (1.2, "1.2", "I'm Constant", 12)


def test_expressions_see_the_source(feed, rows):
    mapping = {"mappings": [to("Country", "Country", "VARCHAR(2)"), to("", "Long", None, "Country || '!'")]}
    assert rows(apply_mapping(feed, mapping))[0] == ("AU", "AUSTRELIA!")


def test_unmapped_columns_follow(feed):
    mapping = {"mappings": [to("country", "NATION", "VARCHAR"), to("LONGITUDE", "LON")]}
    result = apply_mapping(feed, mapping, keep_unmapped=True)
    assert result.columns == ["NATION", "LON", "SOURCE_DATE", "SOURCE_TIMESTAMP"]


def test_mapping_errors(feed):
    with pytest.raises(ValueError, match="no column Nation"):
        apply_mapping(feed, {"mappings": [to("Nation", "N", "VARCHAR")]})
    with pytest.raises(ValueError, match="more than one column named country"):
        apply_mapping(feed, {"mappings": [to("LONGITUDE", "COUNTRY")]}, keep_unmapped=True)


def test_values_that_cannot_be_converted(feed, rows):
    mapping = {"mappings": [to("Country", "N", "INTEGER"), to("", "D", "DATE", "to_date(Country, 'dd/mm/yyyy')")]}
    assert rows(apply_mapping(feed, mapping, on_error="null")) == [(None, None), (None, None)]
    with pytest.raises(PySparkException):
        apply_mapping(feed, mapping).collect()


def test_length_policy(spark, rows):
    df = spark.createDataFrame([("abcdefghi",), (None,)], "s string")

    def cast(policy):
        return rows(df.select(cast_as(F.col("s"), "VARCHAR(5)", length_policy=policy)))

    assert cast("truncate") == [("abcde",), (None,)]
    assert cast("ignore") == [("abcdefghi",), (None,)]
    with pytest.raises(PySparkException, match="longer than"):
        cast("error")
    with pytest.raises(ValueError, match="length_policy"):
        cast("shorten")


def test_type_names():
    assert spark_type("VARHCAR") == ("string", None)
    assert spark_type(" varchar ( 5 ) ") == ("string", 5)
    assert spark_type("STRING(10)") == ("string", 10)
    assert spark_type("INTEGER") == ("int", None)
    assert spark_type("decimal(10,2)") == ("decimal(10,2)", None)


def test_rename(spark, rows):
    df = spark.createDataFrame([("Java", "20000"), ("Python", "100000")], "language string, users_count string")
    assert rename(df, {"LANGUAGE": "lang"}).columns == ["lang", "users_count"]
    mapping = {"mappings": [to("language", "lang"), to("elsewhere", "x")]}
    assert rename_by_mapping(df, mapping).columns == ["lang", "users_count"]
    with pytest.raises(ValueError, match="more than one column"):
        rename(df, {"language": "users_count"})


def test_layout(feed):
    mapped = apply_mapping(feed, MAPPING, run_date=RUN)
    difference = compare_layout(mapped, LAYOUT)
    assert (difference.missing, difference.extra, difference.mistyped) == ([], ["dt2_business"], [])
    with pytest.raises(ValueError, match="dt2_business"):
        conform(mapped, LAYOUT)
    assert conform(mapped, LAYOUT, on_extra="drop").columns == [p["name"] for p in LAYOUT["properties"]]
    with pytest.raises(ValueError, match="TARGET_DATE"):
        conform(mapped.drop("TARGET_DATE"), LAYOUT, on_extra="drop")
    filled = conform(mapped.drop("TARGET_DATE"), LAYOUT, on_extra="drop", on_missing="null")
    assert dict(filled.dtypes)["TARGET_DATE"] == "date"
    assert compare_layout(feed.withColumnRenamed("LONGITUDE", "longitude_new"), LAYOUT).mistyped == [
        "LONGITUDE_NEW: string instead of DOUBLE"
    ]


# ---------------------------------------------------------------- column functions


def cut(start, length):
    return lambda c: F.substring(c, start, length)


PEOPLE = [("John", "Doe", "123 Main St."), ("Jane", "Smith", "456 Oak Ave."), ("Bob", "Johnson", "789 Elm St.")]
LETTERS = [("abcd", "efgh", "ijkl"), ("mnop", "qrst", "uvwx"), ("yz12", "3456", "7890")]


def test_map_all_and_by_position(spark, rows):
    df = spark.createDataFrame(PEOPLE, "first_name string, last_name string, address string")
    assert rows(map_all(df, cut(1, 3))) == [("Bob", "Joh", "789"), ("Jan", "Smi", "456"), ("Joh", "Doe", "123")]
    assert rows(map_by_position(df, [cut(1, 3), cut(2, 4), cut(4, 6)])) == [
        ("Bob", "ohns", " Elm S"), ("Jan", "mith", " Oak A"), ("Joh", "oe", " Main "),
    ]
    assert rows(map_by_position(df, [cut(1, 1)])) == [("B", "J", "7"), ("J", "D", "1"), ("J", "S", "4")]


def test_map_by_index_and_name(spark, rows):
    df = spark.createDataFrame(LETTERS, "col1 string, col2 string, col3 string")
    cuts = [cut(1, 2), cut(2, 3), cut(3, 4)]
    assert rows(map_by_index(df, [("col1", 0), ("col2", 1), ("col3", 2)], cuts)) == [
        ("ab", "fgh", "kl"), ("mn", "rst", "wx"), ("yz", "456", "90"),
    ]
    assert map_by_index(df, [("COL3", 0)], cuts).columns == ["col3"]
    assert rows(map_by_name(df, {"col2": F.upper}))[0] == ("abcd", "EFGH", "ijkl")
    assert map_by_name(df, {"col2": F.upper}, keep_others=False).columns == ["col2"]


def test_substring_columns(spark, rows):
    df = spark.createDataFrame([("abcdef", "ghijkl", "x"), ("mnopqr", "stuvwx", "y")], "col1 string, col2 string, c string")
    layout = {"properties": [{"name": "col1", "position": "1,2"}, {"name": "col2", "position": "3,6"}]}
    assert rows(substring_columns(df, layout)) == [("ab", "ijkl", "x"), ("mn", "uvwx", "y")]
    assert rows(substring_columns(df, layout, keep_others=False)) == [("ab", "ijkl"), ("mn", "uvwx")]


def test_function(spark, rows):
    df = spark.createDataFrame([("John",), ("J",), (None,)], "first_name string")
    result = with_function(df, "short_name", "first_name", lambda s: s[:2])
    assert rows(result) == [("J", "J"), ("John", "Jo"), (None, None)]


def test_odd_column_names(spark, rows):
    df = spark.createDataFrame([("ab", "cd")], ["a.b", "c `d"])
    assert rows(map_all(df, F.upper)) == [("AB", "CD")]
    assert rows(apply_mapping(df, {"mappings": [to("a.b", "x y", "VARCHAR(1)")]}, keep_unmapped=True)) == [("a", "cd")]


# ---------------------------------------------------------------- hashing


def test_row_hash_tells_rows_apart(spark):
    values = [("a", None, "b"), ("a", "b", None), ("a|1:b", None, None), ("a", "", "b"), ("", None, "~"), ("", "~", None)]
    df = spark.createDataFrame(values, "x string, y string, z string")
    assert df.select(row_hash(["x", "y", "z"]).alias("h")).distinct().count() == len(values)
    assert df.select((row_hash(["z", "x", "y"]) == row_hash(["x", "y", "z"])).alias("e")).distinct().first()[0]


# ---------------------------------------------------------------- expressions


@pytest.mark.parametrize(
    "text, expected",
    [
        ("try_to_date('13/10/2023', 'dd/mm/yyyy')", "2023-10-13"),
        ("TO_TIMESTAMP( '13/10/2023' , 'dd/mm/yyyy' )", "2023-10-13 00:00:00"),
        ("to_date(concat('13/10/', '2023'), 'dd/mm/yyyy')", "2023-10-13"),
        ("date_format(to_date('2023-10-13'), 'dd/mm/yyyy')", "13/10/2023"),
        ("concat('to_date(x, ', 'dd/mm/yyyy')", "to_date(x, dd/mm/yyyy"),
        ("to_timestamp('2023-10-13 07:45', 'yyyy-MM-dd HH:mm')", "2023-10-13 07:45:00"),
        ("'it''s current_date() in dd/mm/yyyy'", "it's current_date() in dd/mm/yyyy"),
    ],
)
def test_patterns_of_date_functions(spark, text, expected):
    assert str(spark.range(1).select(sql_expression(text, run_date="2020-01-01")).first()[0]) == expected


def test_lenient_expressions_give_null(spark):
    rows = spark.createDataFrame([("1",), ("x",)], "s string")
    for text in ("cast(s as int) + 1", "CAST (s AS date)", "to_date(s, 'dd/mm/yyyy')", "upper(cast(s as int))"):
        assert rows.where("s = 'x'").select(sql_expression(text, on_error="null")).first()[0] is None
    assert rows.select(sql_expression("concat('cast(', s)", on_error="null")).first()[0] == "cast(1"


def test_function_gets_the_declared_type(spark, rows):
    frame = spark.createDataFrame([(1,), (None,), (7,)], "n int").coalesce(1)
    assert rows(with_function(frame, "text", "n", str), "text") == [("1",), ("7",), (None,)]
    assert rows(with_function(frame, "next", "n", lambda n: n + 1, "bigint"), "next") == [(2,), (8,), (None,)]


@pytest.mark.parametrize(
    "pattern, expected",
    [
        ("dd/mm/yyyy", "dd/MM/yyyy"), ("dd/mm/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm:ss"), ("YYYY-MM-DD HH24:MI:SS", "yyyy-MM-dd HH:mm:ss"),
        ("dd-mon-yyyy hh:mi am", "dd-MMM-yyyy hh:mm a"), ("hh24:mm dd.mm.yy", "HH:mm dd.MM.yy"), ("HH:mm", "HH:mm"), ("mm", "mm"), ("mm:ss", "mm:ss"),
        ("yyyymmddhh24miss", "yyyyMMddHHmmss"), ("DD MONTH YYYY", "dd MMMM yyyy"), ("d/m/yy h:m a", "d/M/yy h:m a"), ('yyyy-mm-dd"T"hh24', "yyyy-MM-dd''T''HH"),
        ("yyyy-'T'", "yyyy-'T'"), ("EEE dd", "EEE dd"), ("yyyy-MM-dd HH:mm:ss.ff3", "yyyy-MM-dd HH:mm:ss.SSS"), ("", ""),
    ],
)
def test_warehouse_patterns(pattern, expected):
    assert spark_pattern(pattern) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("to_timestamp('03/12/2023 10:20:30', 'dd/mm/yyyy HH:mm:ss')", "2023-12-03 10:20:30"), ("to_date('03/12/2023 10:20', 'dd/mm/yyyy hh24:mi')", "2023-12-03"),
        ("to_timestamp('2023-12-03T10', 'yyyy-mm-dd\"T\"hh24')", "2023-12-03 10:00:00"), ("date_format(TIMESTAMP'2023-12-03 22:20:00', 'dd mon yyyy hh:mi am')", "03 Dec 2023 10:20 PM"),
    ],
)
def test_patterns_with_times_and_names(spark, text, expected):
    assert str(spark.range(1).select(sql_expression(text)).first()[0]) == expected


@pytest.mark.parametrize(
    "text",
    [
        "b::int", "int(b)", "date(b)", "timestamp (b)", "unix_timestamp(b)", "unix_timestamp(b, 'yyyy')", "to_unix_timestamp(b, 'dd/mm/yyyy')", "upper(b)::date", "(b || 'x') :: decimal(10,2)",
        "s.`f.g`::int", "a[0]::int::string", "CASE WHEN (b)::int > 1 THEN 1 END", "to_date(b, 'dd/mm/yyyy')::string", "float(substr(b, 2))", "-b::int", "cast(b AS int) + int(b)", "double(trim(b))",
    ],
)
def test_casts_of_every_form_give_null(spark, text):
    row = spark.sql("SELECT 'no number' AS b, named_struct('f.g', 'x') AS s, array('y') AS a")
    assert row.select(sql_expression(text, on_error="null")).first()[0] is None
    with pytest.raises(PySparkException):
        row.select(sql_expression(text)).collect()


def test_lenient_text_is_changed_where_it_converts_only():
    assert lenient("concat('b::int', \"int(b)\", `date(x)`, point(b), x.int(b), t IN (1))") == "concat('b::int', \"int(b)\", `date(x)`, point(b), x.int(b), t IN (1))"
    assert lenient("f(a, b)::int + (c)::date") == "try_cast(f(a, b) AS int) + try_cast((c) AS date)"
    assert lenient("x IN (1)::int") == "x IN try_cast((1) AS int)"
    assert lenient("unix_timestamp()") == "unix_timestamp()"
    with pytest.raises(ValueError, match="not closed"):
        lenient("int(b")


def test_declared_functions_are_expressions(spark, rows, tmp_path):
    path = tmp_path / "functions.json"
    path.write_text(json.dumps({"functions": [
        {"name": "ts_half", "parameters": [{"name": "n", "type": "INTEGER"}], "returns": "DOUBLE", "body": "n / 2"},
        {"name": "ts_day", "parameters": [{"name": "s", "type": "VARCHAR"}], "returns": "DATE", "body": "to_date(s, 'dd/mm/yyyy')"},
        {"name": "ts_none", "returns": "VARCHAR(3)", "body": "'abc'"},
    ]}))
    assert declare_functions(spark, str(path)) == ["ts_half", "ts_day", "ts_none"]
    frame = spark.createDataFrame([(3, "13/12/2023"), (None, None)], "a int, b string")
    mapped = apply_mapping(frame, {"mappings": [to("", "x", None, "ts_half(a) + 1"), to("", "y", None, "ts_day(b)"), to("", "z", None, "ts_none()")]})
    assert rows(mapped) == [(2.5, datetime.date(2023, 12, 13), "abc"), (None, None, "abc")]
    plan = mapped._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ts_half" not in plan
    again = {"functions": [{"name": "ts_half", "parameters": [{"name": "n", "type": "INT"}], "returns": "DOUBLE", "body": "n / 4"}]}
    declare_functions(spark, again)
    assert frame.selectExpr("ts_half(a) AS h").where("h IS NOT NULL").first()["h"] == 0.75
    for wrong in ({"functions": again["functions"] * 2}, {"functions": [{**again["functions"][0], "parameters": [{"name": "n", "type": "INT"}] * 2}]}):
        with pytest.raises(ValueError, match="more than one"):
            declare_functions(spark, wrong)

"""The dashboard in SQL, and the store's annotated answers."""

from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridsky.plans import dashboard
from gridsky.plans.questions import QUESTIONS, register_questions
from gridsky.registry.queries import Tables, tidy
from gridsky.schemas import SERVING
from gridsky.sources.annotated import annotated_rows, annotated_tables, read_answers, series_from_annotated
from gridsky.sources.tables import read_serving, register_serving, write_serving

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def asked(spark, tmp_path_factory):
    """A session with the questions over stored tables, and the tables."""
    if not os.path.isdir(SF):
        pytest.skip("shared tables not present")
    root = str(tmp_path_factory.mktemp("serving"))
    t = Tables(spark, SF)
    for name, rows in zip(SERVING, (t.point_data, t.weather_data, t.energy_analytics, t.energy_weather)):
        write_serving(rows, f"{root}/{name}", name)
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    register_serving(session, root)
    register_questions(session)
    return session, {n: read_serving(session, f"{root}/{n}", n) for n in SERVING}


QUESTIONS_ASKED = {
    "recent_days('GENERADOR 2')": lambda t: dashboard.recent_days(t["point_data"], "GENERADOR 2"),
    "recent_days()": lambda t: dashboard.recent_days(t["point_data"]),
    "consumption_by_time()": lambda t: dashboard.consumption_by_time(t["point_data"]),
    "latest_weather('mall')": lambda t: dashboard.latest_weather(t["weather_data"], "mall"),
    "recent_balance()": lambda t: dashboard.recent_balance(t["energy_analytics"]),
    "latest_ratio()": lambda t: dashboard.latest_ratio(t["energy_analytics"]),
    "avg_per_degree()": lambda t: dashboard.avg_per_degree(t["energy_weather_analytics"]),
    "avg_by_rain()": lambda t: dashboard.avg_by_rain(t["energy_weather_analytics"]),
    "hourly_profile()": lambda t: dashboard.hourly_profile(t["weather_data"], t["energy_analytics"]),
    "hourly_profile('solar')": lambda t: dashboard.hourly_profile(t["weather_data"], t["energy_analytics"], "solar"),
    "daily_change()": lambda t: dashboard.daily_change(t["energy_analytics"]),
    "generator_ids()": lambda t: dashboard.generator_ids(t["point_data"]),
    "generator_ids('mall')": lambda t: dashboard.generator_ids(t["point_data"], "mall"),
    "newest_days()": lambda t: dashboard.newest_days(t["point_data"]),
}


@pytest.mark.parametrize("question", QUESTIONS_ASKED)
def test_sql_answers_as_the_dataframe_does(asked, question):
    session, tables = asked
    got, want = (tidy(f) for f in (session.sql(f"SELECT * FROM {question}"), QUESTIONS_ASKED[question](tables)))
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) != []


def test_every_question_has_its_function(asked):
    assert {q.split("(")[0] for q in QUESTIONS_ASKED} == set(QUESTIONS)


def test_an_argument_is_a_value(asked):
    session, _ = asked
    assert session.sql("SELECT * FROM recent_days('x'' OR true --')").isEmpty()
    assert session.sql("SELECT * FROM latest_weather('nowhere')").isEmpty()
    bound = session.sql("SELECT count(*) AS n FROM recent_days(:id)", args={"id": "GENERADOR 2"})
    assert bound.first().n == session.sql("SELECT * FROM recent_days('GENERADOR 2')").count() > 0


def test_the_newest_days_alone_are_read(asked):
    session, _ = asked
    frame = session.sql("SELECT * FROM recent_days('GENERADOR 2') ORDER BY time_stamp DESC")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "EqualTo(id,GENERADOR 2)" in plan


ANSWER = ''',result,table,x\r
,_result,0,1\r
\r
#datatype,string,long,dateTime:RFC3339,double,string\r
#group,false,false,false,false,true\r
#default,_result,,,,tag\r
,result,table,_time,_value,ID\r
,,0,2024-01-01T00:00:00.000001Z,1.5,\r
,other,0,2024-01-01T00:00:01Z,,"a,b ""c"""\r
,other,1,not a time,not a number,z,too many\r
#datatype,string,string\r
#group,true,true\r
,error,reference\r
,failed,897\r
\r
\r
#datatype,string
,result,result

'''


def test_tables_of_an_answer(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(ANSWER.encode())
    (tmp_path / "b.csv").write_bytes(b"")
    rows = annotated_rows(read_answers(spark, str(tmp_path))).orderBy("block", "line").collect()
    assert [r.fields for r in rows] == [
        {"result": "_result", "table": "0", "x": "1"},
        {"result": "_result", "table": "0", "_time": "2024-01-01T00:00:00.000001Z", "_value": "1.5", "ID": "tag"},
        {"result": "other", "table": "0", "_time": "2024-01-01T00:00:01Z", "_value": None, "ID": 'a,b "c"'},
        {"result": "other", "table": "1", "_time": "not a time", "_value": "not a number", "ID": "z"},
    ]
    assert rows[1].group == ["ID"] and rows[1].datatypes["_value"] == "double" and rows[0].group == []
    assert [r.answer.endswith("a.csv") for r in rows] == [True] * 4
    typed = series_from_annotated(annotated_rows(read_answers(spark, str(tmp_path))), "site").orderBy("_time").collect()
    assert [(r.ID, r._value, r.bucket) for r in typed if r._time] == [("tag", 1.5, "site"), ('a,b "c"', None, "site")]


def test_a_table_that_is_too_wide_is_refused(spark):
    names = ",".join(f"c{k}" for k in range(70))
    frame = spark.createDataFrame([("a", f",{names}\n,{names}\n")], "answer string, body string")
    with pytest.raises(Exception, match="64 columns"):
        annotated_rows(frame).collect()


def test_answers_hold_what_was_asked(spark, tmp_path):
    rows = [
        ("b", "m,1", 'i"d', "f", datetime(2024, 1, 1, 0, 0, 0, k), None if k == 3 else k / 3) for k in range(5)
    ] + [("b", None, "#x", "f", datetime(2024, 1, 2), 1e-300)]
    frame = spark.createDataFrame(rows, "bucket string, _measurement string, ID string, _field string, _time timestamp, _value double")
    ranged = frame.withColumns({c: F.lit("2024-01-01").cast("timestamp") for c in ("_start", "_stop")})
    keys = ("bucket", "_measurement", "ID", "_field", "_start", "_stop")
    annotated_tables(ranged, keys).coalesce(1).write.text(str(tmp_path / "out"))
    back = series_from_annotated(annotated_rows(read_answers(spark, str(tmp_path / "out"))))
    assert back.columns == ranged.columns
    assert sorted(map(repr, back.collect())) == sorted(map(repr, ranged.collect()))


def test_a_long_table_is_read_by_many_tasks(spark):
    body = ",result,x\n" + "\n".join(f",r,{k}" for k in range(20_500)) + "\n\n,result,y\n,r,z\n"
    frame = spark.createDataFrame([("a", body)], "answer string, body string")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = annotated_rows(frame).select("block", "line", "fields", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sorted((r.line, r.fields["x"]) for r in rows if r.block == 0) == [(k + 1, str(k)) for k in range(20_500)]
    assert [(r.line, r.fields) for r in rows if r.block == 1] == [(1, {"result": "r", "y": "z"})]
    assert len({r.task for r in rows}) > 1


def test_a_large_group_is_told_in_several_tables(spark):
    rows = [(s, k % 600, None if k % 7 == 0 else k % 600 / 3) for s in ("a", None) for k in range(700)] + [("b", 1, 1.0)]
    frame = spark.createDataFrame(rows, "ID string, n long, _value double")
    tables = [r.value for r in annotated_tables(frame, ("ID",), records=100).collect()]
    sizes = [t.count("\n") - 4 for t in tables]
    assert sum(sizes) == len(rows) and max(sizes) < 200 and min(sizes) == 1
    read = annotated_rows(spark.createDataFrame([(str(k), t) for k, t in enumerate(tables)], "answer string, body string"))
    back = read.selectExpr("fields.ID", "cast(fields.n AS long)", "cast(fields._value AS double)").collect()
    assert sorted(map(repr, map(tuple, back))) == sorted(map(repr, rows))
    # Without a limit reached, each group is one table.
    assert annotated_tables(frame, ("ID",)).count() == 3
    assert annotated_tables(frame, ()).count() == 1

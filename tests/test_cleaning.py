"""Invariants of the cleaned table, and the raw CSV path."""

import pytest
from pyspark.sql import functions as F

from raregrain import schema as S
from raregrain.functions.scratch import scratch_path
from raregrain.operators import cleaning as C
from raregrain.operators.features import impute_for_exploration
from raregrain.plans.base import RULES, clean_lots
from raregrain.sources import csv_source, sinks
from raregrain.sources import tables as T


@pytest.fixture(scope="module")
def lots(spark, sf):
    return clean_lots(spark, sf).persist()


def test_cleaning_invariants(lots):
    assert lots.where("score <= 0 OR processing = 'Other' OR moisture = 0").isEmpty()
    assert lots.where("altitude NOT BETWEEN -900 AND 9900").isEmpty()
    assert lots.where("variety IS NULL OR processing IS NULL OR color IS NULL").isEmpty()
    assert not set(lots.columns) & set(T.ADMIN)


def test_label_domains(lots):
    assert {r[0] for r in lots.select("processing").distinct().collect()} <= {"Urgent", "High", "Medium", "Unknown"}
    assert {r[0] for r in lots.select("color").distinct().collect()} <= {"o", "f", "Unknown"}


def test_audit_ends_with_the_clean_table(spark, sf, lots):
    a = C.cleaning_audit(T.raw_lots(spark, sf), RULES).orderBy("step_no").collect()
    rows = [r["rows"] for r in a]
    assert rows == sorted(rows, reverse=True) and rows[-1] == lots.count() and a[-1]["recoded"] > 0


def test_target(lots):
    assert lots.where((F.col("score") >= T.SCORE_CUT) != (F.col("label") == 1)).isEmpty()
    rate = lots.agg(F.avg("label")).first()[0]
    assert 0.05 < rate < 0.12


def test_no_leaking_column(lots):
    assert not set(C.model_matrix(lots).columns) & {S.SCORE, *S.COMPONENTS}


def test_exploration_imputation(lots):
    out = impute_for_exploration(lots)
    assert out.where("altitude IS NULL OR moisture IS NULL").isEmpty() and out.count() == lots.count()
    a, b = (d.agg(F.median("moisture")).first()[0] for d in (lots, out))
    assert a == pytest.approx(b)


def test_missing_subregion_matches_missing(spark):
    d = spark.createDataFrame([(1, "A", None), (2, "A", "x"), (3, "B", None)], "row_id long, country string, subregion string")
    g = spark.createDataFrame([("A", None, 1.0, 2.0)], "country string, subregion string, latitude double, longitude double")
    out = {r["row_id"]: r["latitude"] for r in C.attach_coordinates(d, g).collect()}
    assert out == {1: 1.0, 2: None, 3: None}


def test_band_of_missing_is_the_last(spark):
    d = spark.createDataFrame([(1, 100.0), (2, 1200.0), (3, 1800.0), (4, None)], "row_id long, altitude double")
    assert [r[0] for r in d.orderBy("row_id").select(C.band("altitude")).collect()] == [0, 1, 2, 2]


def test_raw_csv_to_clean_table(spark):
    headers = [*S.ADMIN_HEADERS, *S.RAW_NAMES, *S.COMPONENT_HEADERS]
    row = {h: "x" for h in headers} | {h: "7.5" for h in S.COMPONENT_HEADERS}
    base = row | {"Total.Cup.Points": "86", "Country.of.Origin": " Brazil ", "Region": "NaN", "Variety": "None",
                  "Processing.Method": "Washed / Wet", "Color": "Bluish-Green", "Moisture": "0", "altitude_mean_meters": "NaN",
                  "Quakers": "", "Category.One.Defects": "1", "Category.Two.Defects": "2"}
    rows = [base, base | {"Total.Cup.Points": "0"}, base | {"altitude_mean_meters": "190164"},
            base | {"Processing.Method": "Other"}, base | {"Country.of.Origin": "NA"}, base | {"Processing.Method": "NaN"}]
    path = scratch_path(spark)
    raw_text = spark.createDataFrame([tuple(r[h] for h in headers) for r in rows],
                                     ", ".join(f"`{h}` string" for h in headers))
    sinks.write_csv(raw_text, path, single_file=True)
    raw = csv_source.load_raw(spark, path, headers)
    assert len(raw.columns) == 44 and raw.count() == 6
    out = C.add_target(C.clean(raw, None))
    got = out.orderBy("processing").collect()
    assert [r["processing"] for r in got] == ["Unknown", "Washed"]
    r = got[1]
    assert (r["country"], r["subregion"], r["variety"], r["color"], r["moisture"], r["altitude"], r["quakers"], r["label"]) == \
        ("Brazil", None, "Unknown", "blue-green", None, None, 0.0, 1)
    steps = C.cleaning_audit(raw).orderBy("step_no").collect()
    assert [s["rows"] for s in steps] == [6, 5, 4, 3, 2, 2] and steps[-1]["recoded"] == 2


def test_report_and_single_files(spark):
    d = spark.createDataFrame([("a", 1.5, 2)], "term string, coef double, n int")
    path = scratch_path(spark)
    sinks.write_report(d, path)
    lines = [r[0] for r in spark.read.text(path).collect()]
    assert len(lines) == 2 and any("term" in x for x in lines)

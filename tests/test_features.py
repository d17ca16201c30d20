"""Exact values of the learned transforms on a seven-row frame."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from raregrain import schema as S
from raregrain.functions.scratch import scratch_path
from raregrain.operators import features as X

ROWS = [
    (0, "Brazil", "minas", 1000.0, 0.11, 0, 2, "Bourbon", "Natural", "green"),
    (1, "Brazil", "minas", 1200.0, None, 1, 0, "Bourbon", "Natural", "green"),
    (2, "Brazil", "sul", None, 0.12, 0, 5, "Typica", "Washed", "blue-green"),
    (3, "Kenya", "nyeri", 1800.0, 0.10, 0, 1, "SL28", "Washed", "green"),
    (4, "Kenya", None, None, 0.13, 3, 0, "SL28", "Washed", "Unknown"),
    (5, "Japan", None, None, None, 0, 8, "Typica", "Unknown", "green"),
    (6, "Mexico", "chiapas", 1400.0, 0.11, 0, 1, "Caturra", "Washed", "green"),
]
TYPES = ("row_id long, country string, subregion string, altitude double, moisture double, c1 int, c2 int, "
         "variety string, processing string, color string")


@pytest.fixture(scope="module")
def toy(spark):
    return spark.createDataFrame(ROWS, TYPES)


def column(df, c):
    return [r[c] for r in df.orderBy("row_id").collect()]


def test_altitude_hierarchy(toy):
    out = column(X.GroupMeanImputer().fit(toy).transform(toy), "altitude")
    assert out == [1000, 1200, 1100, 1800, 1800, 1300, 1400]


def test_altitude_learns_from_fit_rows_only(toy):
    out = column(X.GroupMeanImputer().fit(toy.where("row_id < 3")).transform(toy), "altitude")
    assert out[4] == 1100 and out[3] == 1800


def test_missing_subregion_is_its_own_group(spark):
    d = spark.createDataFrame([(0, "A", None, 10.0), (1, "A", "x", 30.0), (2, "A", None, None)],
                              "row_id long, country string, subregion string, altitude double")
    assert column(X.GroupMeanImputer().fit(d).transform(d), "altitude")[2] == 10


def test_moisture_flag_and_median(toy):
    out = X.MedianFlagImputer().fit(toy).transform(toy)
    assert column(out, S.MOISTURE_FLAG) == [0, 1, 0, 0, 0, 1, 0]
    assert column(out, "moisture")[1] == pytest.approx(0.11)


def test_macro_area(spark, toy):
    m = X.AreaMapper(X.default_area_map(spark))
    out = m.transform(toy)
    assert column(out, "macro_area") == ["South America"] * 3 + ["Africa"] * 2 + [
        "Maritime Asia/Pacific", "Central/North America"]
    assert "country" not in out.columns
    other = toy.withColumn("country", F.lit("Atlantis"))
    assert set(column(m.transform(other), "macro_area")) == {"Unknown"}


def test_engineered_columns(toy):
    d = X.MedianFlagImputer().fit(toy).transform(X.GroupMeanImputer().fit(toy).transform(toy))
    out = X.DefectEngineer().transform(d)
    assert column(out, "has_c1") == [0, 1, 0, 0, 1, 0, 0]
    assert "c1" not in out.columns
    assert {"log_c1", "log_c2", "log_altitude_moisture"} <= set(out.columns)


def fitted(spark, toy, **options):
    return X.feature_pipeline(X.default_area_map(spark), **options).fit(toy)


def test_reference_drop_removes_four_columns(spark, toy):
    full, less = fitted(spark, toy), fitted(spark, toy, reference=S.REFERENCE_LEVELS)
    assert len(X.feature_names(full)) - len(X.feature_names(less)) == 4
    m = X.to_matrix(full, toy)
    assert m.where("features IS NULL").count() == 0 and m.count() == 7
    assert len(m.first()["features"]) == len(X.feature_names(full))


def test_selector_ignores_unknown_names(spark, toy):
    e = X.encoder_of(fitted(spark, toy)).select(["moisture", "no_such_column", "color_green"])
    assert e.feature_names == ["moisture", "color_green"]


def test_rare_pooling_keeps_nine_and_pools_the_rest(spark):
    rows = [(i, f"v{j:02d}") for i, j in enumerate(j for j in range(12) for _ in range(12 - j))]
    d = spark.createDataFrame(rows, "row_id long, variety string")
    e = X.Encoder([], ["variety"]).fit(d)
    assert e.feature_names == [f"variety_v{j:02d}" for j in range(9)] + ["variety_Rare"]
    new = spark.createDataFrame([(99, "unseen")], "row_id long, variety string")
    assert e.wide(new, []).first()["variety_Rare"] == 1.0
    few = X.Encoder([], ["variety"]).fit(d.where("variety < 'v05'"))
    assert set(few.wide(new, []).first()) == {0.0}
    assert few.unseen(new).first()["n_unseen"] == 1


def test_pooling_tie_keeps_larger_name(spark):
    d = spark.createDataFrame([(i, f"v{i:02d}") for i in range(11)], "row_id long, variety string")
    assert X.Encoder([], ["variety"]).fit(d).levels["variety"] == [f"v{i:02d}" for i in range(2, 11)]


def test_constant_column_scales_to_zero(spark):
    d = spark.createDataFrame([(1, 5.0, 1.0), (2, 5.0, 3.0)], "row_id long, a double, b double")
    out = X.standardise(d, ["a", "b"])
    assert column(out, "a") == [0.0, 0.0] and column(out, "b") == [-1.0, 1.0]


def test_pipeline_survives_saving(spark, toy):
    from pyspark.ml import PipelineModel
    m = fitted(spark, toy)
    path = scratch_path(spark)
    m.write().overwrite().save(path)
    again = PipelineModel.load(path)
    a = [r["features"] for r in X.to_matrix(m, toy).orderBy("row_id").collect()]
    b = [r["features"] for r in X.to_matrix(again, toy).orderBy("row_id").collect()]
    assert a == b


def test_fold_features_equal_separate_fits(spark, toy):
    big = toy.unionByName(toy.withColumn("row_id", F.col("row_id") + 10).withColumn("altitude", F.col("altitude") + 50))
    d = big.withColumn("fold", (F.col("row_id") % 3).cast("int")).withColumn("label", (F.col("row_id") % 2).cast("int"))
    area = X.default_area_map(spark)
    ff = X.FoldFeatures(d, area, [-1, 0, 1, 2])
    for f in (-1, 1):
        m = X.feature_pipeline(area).fit(d.where(F.col("fold") != f))
        a = {r["row_id"]: list(r["features"].toArray().round(9)) for r in X.to_matrix(m, d).collect()}
        b = {r["row_id"]: list(r["features"].toArray().round(9)) for r in ff.encoded(f).collect()}
        assert X.feature_names(m) == ff.encoder(f).feature_names
        assert a == b


def test_groups_of_folds_are_fitted_together_and_encoded_in_one_scan(spark):
    from raregrain.operators import penalised as P
    rng = np.random.default_rng(8)
    n, area = 240, spark.createDataFrame([("A", "north"), ("B", "south")], "country string, macro_area string")
    pick = lambda *v: [v[i] for i in rng.integers(0, len(v), n)]
    d = spark.createDataFrame(
        [(i, int(a), c, s, al, m, int(x), int(y), v, p, co, f, g) for i, (a, c, s, al, m, x, y, v, p, co, f, g) in enumerate(zip(
            rng.integers(0, 2, n), pick("A", "B", "C", None), pick("s", "t", None), pick(1.0, 7.5, 30.0, None), pick(0.1, 0.2, None),
            rng.integers(0, 3, n), rng.integers(0, 4, n), pick(*"abcdefghijklmn"), pick("Urgent", "High", None), pick("o", "f"),
            pick(0, 1, None), pick(-1, 0)))],
        "row_id long, label int, country string, subregion string, altitude double, moisture double, c1 int, c2 int, "
        "variety string, processing string, color string, fold int, outer int")
    both = X.FoldFeatures(d, area, [-1, 0, 1], group="outer", reference={"color": "o"})
    packed = P.pack_features(both, {both.code(o, f): 10 * (o + 1) + f + 1 for o in (-1, 0) for f in (-1, 0, 1)})
    blocks = [(r["design"], r["learn"], P.pickle.loads(r["body"])) for r in packed.blocks.collect()]
    for o in (-1, 0):
        alone = X.FoldFeatures(d.where(F.col("outer") == o).drop("outer"), area, [-1, 0, 1], reference={"color": "o"})
        for f in (-1, 0, 1):
            want = {r["row_id"]: (r["fold"], r["features"].toArray()) for r in alone.encoded(f).collect()}
            seen = {}
            for learn, b in ((learn, b) for design, learn, b in blocks if design == 10 * (o + 1) + f + 1):
                width = len(b[0]) + len(b[1])
                for i, row in enumerate(b[6]):
                    x = np.zeros(width)
                    x[b[0]], x[b[1]] = b[2][:, i], b[4][np.searchsorted(b[3], i, side="right") - 1]
                    seen[int(row)] = (learn, x)
            assert seen.keys() == want.keys()
            for row, (fold, x) in want.items():
                assert np.allclose(seen[row][1], x, atol=1e-12)
                assert seen[row][0] == (fold is not None and fold != f)

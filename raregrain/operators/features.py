"""Learned feature transforms as ``pyspark.ml`` stages, fitted on the given rows only.

Fitted state is either a few scalars or a grouped DataFrame; group means are
joined, never collected, so the number of groups may grow with the data.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.ranking import attach, exact_medians, exact_quantiles, melt
from ..functions.scratch import materialise


# --------------------------------------------------------------------------- persistence
class _StateWriter(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        st = self.stage
        plain = {k: v for k, v in st.state().items() if not isinstance(v, DataFrame)}
        frames = {k: v for k, v in st.state().items() if isinstance(v, DataFrame)}
        DefaultParamsWriter.saveMetadata(st, path, self.sparkSession,
                                         extraMetadata={"state": json.dumps(plain), "frames": sorted(frames)})
        for k, df in frames.items():
            df.write.mode("overwrite").parquet(f"{path}/frames/{k}")


class _StateReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        state = json.loads(meta["state"])
        for k in meta["frames"]:
            state[k] = self.sparkSession.read.parquet(f"{path}/frames/{k}")
        out = self.cls(**state)
        out._resetUid(meta["uid"])
        return out


class _Stateful(MLWritable, MLReadable):
    """Stages whose constructor arguments are their whole state."""

    _fields: tuple = ()

    def state(self) -> dict:
        return {k: getattr(self, k) for k in self._fields}

    def write(self):
        return _StateWriter(self)

    @classmethod
    def read(cls):
        return _StateReader(cls)


# --------------------------------------------------------------------------- imputation
class GroupMeanImputer(Estimator, _Stateful):
    """Missing values <- mean of (country, subregion), else of country, else global median.

    A missing subregion is a group of its own.  Every value is rounded half to
    even afterwards.
    """

    _fields = ("country", "subregion", "col")

    def __init__(self, country="country", subregion="subregion", col="altitude"):
        super().__init__()
        self.country, self.subregion, self.col = country, subregion, col

    def _fit(self, dataset):
        known = dataset.select(self.country, self.subregion, self.col).where(F.col(self.col).isNotNull())
        by_sub = materialise(known.groupBy(self.country, self.subregion).agg(F.avg(self.col).alias("__mean_sub")))
        by_country = materialise(known.groupBy(self.country).agg(F.avg(self.col).alias("__mean_country")))
        median = exact_medians(dataset, [self.col])[self.col]
        return GroupMeanImputerModel(self.country, self.subregion, self.col, by_sub, by_country, median)


class GroupMeanImputerModel(Model, _Stateful):
    _fields = ("country", "subregion", "col", "by_sub", "by_country", "median")

    def __init__(self, country, subregion, col, by_sub, by_country, median):
        super().__init__()
        self.country, self.subregion, self.col = country, subregion, col
        self.by_sub, self.by_country, self.median = by_sub, by_country, median

    def _transform(self, dataset):
        d = attach(dataset, self.by_sub, [self.country, self.subregion])
        d = attach(d, self.by_country, [self.country])
        filled = F.coalesce(F.col(self.col), F.col("__mean_sub"), F.col("__mean_country"),
                            F.lit(self.median).cast("double"))
        return d.withColumn(self.col, F.bround(filled, 0)).drop("__mean_sub", "__mean_country")


def impute_for_exploration(df: DataFrame) -> DataFrame:
    """Fill altitude (group means, then median) and moisture (median) on all rows, unrounded.

    Only for exploration and unsupervised work, where nothing is held out.
    """
    med = exact_medians(df, ["altitude", "moisture"])
    known = df.where("altitude IS NOT NULL")
    by_sub = materialise(known.groupBy(*S.GEO).agg(F.avg("altitude").alias("__s")))
    by_country = materialise(known.where("country IS NOT NULL").groupBy("country").agg(F.avg("altitude").alias("__c")))
    d = attach(attach(df, by_sub, S.GEO), by_country, ["country"])
    return d.withColumns({
        "altitude": F.coalesce("altitude", "__s", "__c", F.lit(med["altitude"]).cast("double")),
        "moisture": F.coalesce("moisture", F.lit(med["moisture"]).cast("double")),
    }).drop("__s", "__c")


class MedianFlagImputer(Estimator, _Stateful):
    """0/1 indicator of missing values, then median fill."""

    _fields = ("col", "flag")

    def __init__(self, col="moisture", flag=S.MOISTURE_FLAG):
        super().__init__()
        self.col, self.flag = col, flag

    def _fit(self, dataset):
        return MedianFlagImputerModel(self.col, self.flag, exact_medians(dataset, [self.col])[self.col])


class MedianFlagImputerModel(Model, _Stateful):
    _fields = ("col", "flag", "median")

    def __init__(self, col, flag, median):
        super().__init__()
        self.col, self.flag, self.median = col, flag, median

    def _transform(self, dataset):
        c = F.col(self.col)
        return dataset.withColumns({self.flag: c.isNull().cast("int"),
                                    self.col: F.coalesce(c, F.lit(self.median).cast("double"))})


# --------------------------------------------------------------------------- mapping, engineering
def default_area_map(spark: SparkSession) -> DataFrame:
    rows = [(c, area) for area, countries in S.MACRO_AREA_COUNTRIES.items() for c in countries]
    return spark.createDataFrame(rows, "country string, macro_area string")


class AreaMapper(Transformer, _Stateful):
    """country -> macro area by a lookup table, ``Unknown`` outside it; drops the geography."""

    _fields = ("mapping", "drop_geo")

    def __init__(self, mapping: DataFrame, drop_geo: bool = True):
        super().__init__()
        self.mapping, self.drop_geo = mapping, drop_geo

    def _transform(self, dataset):
        d = dataset.join(self.mapping.select("country", "macro_area"), "country", "left")
        d = d.fillna(S.UNKNOWN, subset=["macro_area"])
        return d.drop(*S.GEO) if self.drop_geo else d


class DefectEngineer(Transformer, _Stateful):
    """log1p counts, has-defect flag and the log altitude / moisture ratio.

    A negative ratio has no logarithm and counts as 0.
    """

    _fields = ("drop_raw",)

    def __init__(self, drop_raw: bool = True):
        super().__init__()
        self.drop_raw = drop_raw

    def _transform(self, dataset):
        d = dataset.withColumns({
            "log_c1": F.log1p("c1"), "log_c2": F.log1p("c2"), "has_c1": (F.col("c1") > 0).cast("int"),
            "log_altitude_moisture": F.log1p(
                F.greatest(F.col("altitude") / (F.col("moisture") + F.lit(1e-4)), F.lit(0.0)))})
        return d.drop("c1", "c2") if self.drop_raw else d


# --------------------------------------------------------------------------- encoding
class Encoder(Estimator, _Stateful):
    """Population-scaled numeric columns and 0/1 columns with rare-level pooling.

    A column with more than ``max_categories`` levels keeps its
    ``max_categories - 1`` most frequent ones (on equal counts the larger
    name) and pools the rest as ``Rare``.  Unseen levels go to ``Rare`` where
    it exists, else all 0/1 columns are 0.  ``reference`` names one level per
    column whose 0/1 column is left out; if that level was pooled, the pooled
    column is left out, so that the columns never add up to the intercept.
    """

    _fields = ("numeric", "categorical", "scale", "reference", "max_categories")

    def __init__(self, numeric=tuple(S.NUMERIC_MODEL), categorical=tuple(S.CATEGORICAL), scale=True,
                 reference=None, max_categories=S.MAX_CATEGORIES):
        super().__init__()
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.scale, self.reference, self.max_categories = scale, dict(reference or {}), max_categories

    def _fit(self, dataset):
        d = dataset.withColumn("fit", F.lit(0))
        return _fit_encoders(d, [0], self.numeric, self.categorical, self.scale, self.reference,
                             self.max_categories)[0]


class EncoderModel(Model, _Stateful):
    _fields = ("numeric", "categorical", "levels", "pooled", "stats", "reference", "keep")

    def __init__(self, numeric, categorical, levels, pooled, stats, reference, keep=None):
        super().__init__()
        self.numeric, self.categorical, self.levels, self.pooled = numeric, categorical, levels, pooled
        self.stats, self.reference, self.keep = stats, reference, keep

    def _columns(self):
        out = {}
        for c in self.numeric:
            x = F.col(c).cast("double")
            if self.stats:
                m, s = self.stats[c]
                x = (x - F.lit(m)) / F.lit(s) if s else F.lit(0.0)
            out[c] = x
        for c in self.categorical:
            ref = self._reference_level(c)
            for lv in self.levels[c]:
                if ref != lv:
                    out[f"{c}_{lv}"] = F.coalesce((F.col(c) == lv).cast("double"), F.lit(0.0))
            if self.pooled[c] and ref != S.RARE:
                out[f"{c}_{S.RARE}"] = F.coalesce((~F.col(c).isin(*self.levels[c])).cast("double"), F.lit(0.0))
        return out

    def _reference_level(self, c):
        """The level without a column; a pooled reference level means the pooled column."""
        ref = self.reference.get(c)
        return S.RARE if ref is not None and self.pooled[c] and ref not in self.levels[c] else ref

    @property
    def feature_names(self) -> list[str]:
        names = list(self._columns())
        return [n for n in names if n in self.keep] if self.keep is not None else names

    def select(self, names: list[str]) -> EncoderModel:
        """Restrict to the listed encoded columns; names that do not exist are ignored."""
        wanted = {n.replace("infrequent_sklearn", S.RARE) for n in names}
        return EncoderModel(self.numeric, self.categorical, self.levels, self.pooled, self.stats,
                            self.reference, sorted(wanted))

    def plain(self) -> dict:
        """What ``encode_batch`` needs, without references to the session."""
        levels = []
        for c in self.categorical:
            ref = self._reference_level(c)
            levels.append((c, [lv for lv in self.levels[c] if lv != ref], self.levels[c], self.pooled[c] and ref != S.RARE))
        names = [*self.numeric, *[f"{c}_{lv}" for c, wanted, _, pooled in levels for lv in [*wanted, *[S.RARE] * pooled]]]
        return {"numeric": [(c, *(self.stats[c] if self.stats else (0.0, 1.0))) for c in self.numeric], "levels": levels,
                "keep": [self.keep is None or n in self.keep for n in names]}

    def unseen(self, dataset) -> DataFrame:
        """Rows whose level was unseen and has no pooled bucket, per variable."""
        return dataset.agg(*[
            F.count_if(~F.col(c).isin(*self.levels[c])).alias(c) if not self.pooled[c]
            else F.lit(0).cast("long").alias(c) for c in self.categorical]).unpivot(
            [], self.categorical, "variable", "n_unseen")

    def wide(self, dataset, keep_cols) -> DataFrame:
        """The encoded matrix as plain named columns."""
        cols = self._columns()
        return dataset.select(*keep_cols, *[cols[n].alias(n) for n in self.feature_names])

    def _transform(self, dataset):
        cols, names = self._columns(), self.feature_names
        tmp = [f"__x{i}" for i in range(len(names))]
        d = dataset.withColumns({t: cols[n] for t, n in zip(tmp, names)})
        return VectorAssembler(inputCols=tmp, outputCol="features").transform(d).drop(*tmp)


def encode_batch(plain: dict, b: pa.RecordBatch) -> np.ndarray:
    """The matrix of an encoder for a batch of imputed rows: its feature vectors without a pass through the planner."""
    out = []
    for c, mean, sd in plain["numeric"]:
        x = b.column(c).cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
        x = (x - mean) / sd if sd else np.zeros(len(x))
        if np.isnan(x).any():
            raise ValueError(f"{c} is missing or not a number")
        out.append(x[:, None])
    for c, wanted, known, pooled in plain["levels"]:
        coded = pc.dictionary_encode(b.column(c))
        names = coded.dictionary.to_pylist()
        each = np.array([[lv == n for lv in wanted] + [n not in known] * pooled for n in names] + [[False] * (len(wanted) + pooled)], float)
        out.append(each[coded.indices.fill_null(len(names)).to_numpy(zero_copy_only=False)])
    return np.concatenate(out, axis=1)[:, plain["keep"]]


def feature_stages(area_map: DataFrame, *, engineer=False, reference=None, scale=True) -> list:
    """altitude -> moisture -> macro area -> (engineering) -> scaling and 0/1 columns."""
    stages = [GroupMeanImputer(), MedianFlagImputer(), AreaMapper(area_map)]
    if engineer:
        stages.append(DefectEngineer())
    numeric = S.NUMERIC_ENGINEERED if engineer else S.NUMERIC_MODEL
    return [*stages, Encoder(numeric, S.CATEGORICAL, scale, reference)]


def feature_pipeline(area_map: DataFrame, **options) -> Pipeline:
    return Pipeline(stages=feature_stages(area_map, **options))


def model_pipeline(area_map: DataFrame, classifier, **options) -> Pipeline:
    return Pipeline(stages=[*feature_stages(area_map, **options), classifier])


class FoldFeatures:
    """The feature pipeline fitted once per fold and once on all rows, in a few jobs for all of them.

    Fit ``f`` >= 0 learns from the rows of every other fold, fit -1 from all
    rows.  Medians, group means, scaling and levels of all fits come from
    shared aggregations; no job is repeated per fold.  ``df`` has a ``fold``
    column; rows without a fold (the hold-out) are never learned from and are
    carried by fit -1 only. With ``group``, a column of whole numbers, the rows
    of each of its values have fits of their own, again in the same jobs; their
    encoders are named by ``code``.
    """

    def __init__(self, df: DataFrame, area_map: DataFrame, fits: list[int], *, engineer=False, reference=None,
                 scale=True, altitude="altitude", moisture="moisture", group=None):
        self.fits, self.group, by = list(fits), group, [group] if group else []
        code = self.code(F.col(group), F.col("fit")) if group else F.col("fit")
        codes = [self.code(r[0], f) for r in df.select(group).distinct().collect() for f in self.fits] if group else self.fits
        outs = F.array(*[F.lit(f) for f in self.fits])
        numeric = S.NUMERIC_ENGINEERED if engineer else S.NUMERIC_MODEL

        def spread(d):  # every row once per fit that may learn from it
            return d.withColumn("fit", F.explode(outs)).where(F.col("fit") != F.col("fold"))

        counts = (melt(df, [*by, "fold"], [altitude, moisture]).where("value IS NOT NULL")
                  .groupBy(*by, "fold", "feature", "value").agg(F.count(F.lit(1)).alias("n")))
        rows = exact_quantiles(spread(counts).select(code.alias("fit"), "feature", "value", "n"), "value", {"m": 0.5},
                               ["fit", "feature"], weight="n").collect()
        med = {(r["fit"], r["feature"]): r["m"] for r in rows}
        # written first, so that the joins below know its size
        parts = materialise(df.where(F.col(altitude).isNotNull()).groupBy(*by, "fold", *S.GEO)
                            .agg(F.sum(altitude).alias("s"), F.count(altitude).alias("n")))

        def means(keys, out):
            return spread(parts).groupBy(*by, "fit", *keys).agg((F.sum("s") / F.sum("n")).alias(out))
        by_sub, by_country = means(S.GEO, "__mean_sub"), means(["country"], "__mean_country")

        def per_fit(name):
            pairs = [x for f in codes for x in (F.lit(f), F.lit(med.get((f, name))).cast("double"))]
            return F.element_at(F.create_map(*pairs), code)
        d = df.withColumn("fit", F.explode(outs)).where("fold IS NOT NULL OR fit = -1")
        d = attach(attach(d, by_sub, [*by, "fit", *S.GEO]), by_country, [*by, "fit", "country"])
        d = d.withColumns({
            altitude: F.bround(F.coalesce(F.col(altitude), F.col("__mean_sub"), F.col("__mean_country"),
                                          per_fit(altitude)), 0),
            S.MOISTURE_FLAG: F.col(moisture).isNull().cast("int"),
            moisture: F.coalesce(F.col(moisture), per_fit(moisture))}).drop("__mean_sub", "__mean_country")
        mapper = AreaMapper(area_map)
        d = mapper.transform(d)
        shared = [mapper]
        if engineer:
            shared.append(DefectEngineer())
            d = shared[-1].transform(d)
        self.imputed = materialise(d, None if group else "fit")
        self.encoders = _fit_encoders(self.imputed.where(F.col("fit") != F.col("fold")).withColumn("fit", code), codes, numeric,
                                      S.CATEGORICAL, scale, reference)
        if group:
            return
        self.models = {f: PipelineModel([
            GroupMeanImputerModel(*S.GEO, altitude, by_sub.where(F.col("fit") == f).drop("fit"),
                                  by_country.where(F.col("fit") == f).drop("fit"), med.get((f, altitude))),
            MedianFlagImputerModel(moisture, S.MOISTURE_FLAG, med.get((f, moisture))),
            *shared, self.encoders[f]]) for f in self.fits}

    def code(self, group, fit):
        """The name of a fit of a group, numbers or columns."""
        return group * (max(self.fits) - min(self.fits) + 1) + fit

    def encoder(self, fit: int) -> EncoderModel:
        return self.encoders[fit]

    def imputed_for(self, fit: int) -> DataFrame:
        """All rows as fit ``fit`` sees them, before scaling and 0/1 columns."""
        return self.imputed.where(F.col("fit") == fit)

    def encoded(self, fit: int) -> DataFrame:
        """row_id, label, fold and the feature vector of one fit: a projection of stored rows."""
        return self.encoder(fit).transform(self.imputed_for(fit)).select(S.ROW_ID, S.LABEL, "fold", "features")


def _fit_encoders(d: DataFrame, fits, numeric, categorical, scale, reference,
                  max_categories=S.MAX_CATEGORIES) -> dict[int, EncoderModel]:
    """One encoder per value of ``fit``, from one job for levels and one for scaling."""
    rows, stats = [], {f: {} for f in fits}
    if categorical:
        long = d.select("fit", *categorical).unpivot(["fit"], list(categorical), "variable", "level")
        counts = long.where("level IS NOT NULL").groupBy("fit", "variable", "level").count()
        order = Window.partitionBy("fit", "variable").orderBy(F.desc("count"), F.desc("level"))
        # one row more than the maximum tells whether pooling is needed
        rows = counts.withColumn("r", F.row_number().over(order)).where(F.col("r") <= max_categories + 1).collect()
    if scale and numeric:
        for r in d.groupBy("fit").agg(*[g(F.col(c).cast("double")).alias(f"{n}_{c}") for c in numeric
                                        for n, g in (("m", F.avg), ("s", F.stddev_pop))]).collect():
            stats[r["fit"]] = {c: [r[f"m_{c}"], r[f"s_{c}"]] for c in numeric}
    out = {}
    for f in fits:
        levels, pooled = {}, {}
        for c in categorical:
            found = sorted((r["r"], r["level"]) for r in rows if r["variable"] == c and r["fit"] == f)
            pooled[c] = len(found) > max_categories
            levels[c] = sorted(lv for _, lv in (found[:max_categories - 1] if pooled[c] else found))
        out[f] = EncoderModel(list(numeric), list(categorical), levels, pooled, stats[f], dict(reference or {}))
    return out


def encoder_of(fitted) -> EncoderModel:
    return next(s for s in fitted.stages if isinstance(s, EncoderModel))


def feature_names(fitted) -> list[str]:
    """Names of the encoded columns, in the order of the feature vector."""
    return encoder_of(fitted).feature_names


def to_matrix(fitted, df: DataFrame) -> DataFrame:
    """Run every stage of a fitted pipeline up to and including the encoder."""
    for stage in fitted.stages:
        df = stage.transform(df)
        if isinstance(stage, EncoderModel):
            break
    return df


def standardise(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean 0, population sd 1; a constant column becomes 0."""
    m = Encoder(cols, [], True).fit(df)
    scaled = m._columns()
    return df.withColumns({c: scaled[c] for c in cols})

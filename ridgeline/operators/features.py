"""Feature vectors: level dictionaries, encoders, names, scaling, health check.

The levels of a column are a table, not a list on the driver: ranked across
ranges, joined to the rows, and written beside the scaling of the numbers. So a
column may have as many levels as the table has rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.ml.feature import StandardScaler, StandardScalerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.model import Roles
from ridgeline.operators.ranking import with_places
from ridgeline.sources.scratch import staged

LEVEL_SCHEMA = "column string, level string, n long, place long"
# What the encoded names are made of.
KEEP_NAME, KEEP_UNKNOWN = "{column}_indexed_encoded_", "__unknown"
IGNORE_NUMBER, IGNORE_NAME = "num__", "cat__{column}_"
SPARSE = 0


def level_dictionary(train: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """(column, level, n, place) of every level that occurs: by ``frequency``, then name, or by ``name``.

    Frequent levels are counted on the map side; the ranks come from the sizes
    of ranges. A missing value is no level.
    """
    if not columns:
        return train.sparkSession.createDataFrame([], LEVEL_SCHEMA)
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns]
    counted = train.select(F.inline(F.array(*cells))).filter(F.col("level").isNotNull())
    counted = counted.groupBy("column", "level").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("level")] if by == "frequency" else [F.col("level")]
    return with_places(counted, ["column"], order, "place")


@dataclass
class Encoder:
    """What was learnt from the training rows.

    ``keep`` gives every column a slot for unknown levels, otherwise those are
    all zeros and the numbers are centred and scaled. ``levels`` is a scan of
    LEVEL_SCHEMA; the driver holds two numbers per numeric column and one count
    per categorical one. ``scaler`` centres and scales whole vectors.
    """

    roles: Roles
    keep: bool
    levels: DataFrame
    sizes: dict[str, int]
    scaling: dict[str, tuple[float, float]]
    train_rows: int
    scaler: StandardScalerModel | None = None

    @property
    def width(self) -> int:
        return len(self.roles.numeric) + sum(self.sizes[c] + self.keep for c in self.roles.categorical)

    def starts(self) -> dict[str, int]:
        """The first entry of every categorical column."""
        out, at = {}, len(self.roles.numeric)
        for c in self.roles.categorical:
            out[c] = at
            at += self.sizes[c] + self.keep
        return out

    def _number(self, column: str, invalid: str) -> Column:
        value = F.col(column).cast("double")
        if invalid == "error":
            missing = value.isNull() | F.isnan(value)
            value = F.when(missing, F.raise_error(F.lit(f"{column} has a missing value")).cast("double")).otherwise(value)
        else:
            value = F.coalesce(value, F.lit(float("nan")))
        if column in self.scaling:
            mean, deviation = self.scaling[column]
            # A column that never varies is centred only.
            value = (value - mean) / (deviation or 1.0)
        return value

    def transform(self, df: DataFrame, invalid: str = "error") -> DataFrame:
        """``df`` with ``features``, written once and scanned from then on.

        Every column is joined to its levels, which Spark broadcasts only where
        the written dictionary is small. A missing number raises, or with
        ``invalid="keep"`` becomes NaN; a missing category is unknown.
        """
        columns, out = df.columns, df
        entries = [F.struct(F.lit(i).alias("i"), self._number(c, invalid).alias("v")) for i, c in enumerate(self.roles.numeric)]
        for c, start in self.starts().items():
            found = self.levels.filter(F.col("column") == c).select(F.col("level").alias(f"_level_{c}"), F.col("place").alias(f"_place_{c}"))
            out = out.join(found, F.col(c).cast("string") == F.col(f"_level_{c}"), "left")
            place = F.col(f"_place_{c}")
            if self.keep:
                place = F.coalesce(place, F.lit(self.sizes[c]).cast("long"))
            entries.append(F.struct((place + start).cast("int").alias("i"), F.lit(1.0).alias("v")))
        kept = F.filter(F.array(*entries), lambda e: e["i"].isNotNull() & (e["v"] != 0))
        vector = F.struct(
            F.lit(SPARSE).cast("byte").alias("type"),
            F.lit(self.width).alias("size"),
            F.transform("_entries", lambda e: e["i"]).alias("indices"),
            F.transform("_entries", lambda e: e["v"]).alias("values"),
        )
        laid_out = out.select(*columns, kept.alias("_entries")).select(*columns, vector.alias("features"))
        # Written in the layout of a vector, read as one: no row passes through Python.
        schema = T.StructType([*df.schema.fields, T.StructField("features", VectorUDT())])
        rows = staged(laid_out, "vectors", schema)
        if self.scaler is None:
            return rows
        return self.scaler.transform(rows.withColumnRenamed("features", "_unscaled")).drop("_unscaled")

    def names(self) -> DataFrame:
        """(position, name) of every entry of the vectors."""
        spark = self.levels.sparkSession
        prefix = "" if self.keep else IGNORE_NUMBER
        pattern = KEEP_NAME if self.keep else IGNORE_NAME
        fixed = [(i, f"{prefix}{c}") for i, c in enumerate(self.roles.numeric)]
        starts = self.starts()
        if self.keep:
            fixed += [(starts[c] + self.sizes[c], pattern.format(column=c) + KEEP_UNKNOWN) for c in starts]
        out = spark.createDataFrame(fixed, "position long, name string")
        if starts:
            table = spark.createDataFrame([(c, at, pattern.format(column=c)) for c, at in starts.items()], "column string, start long, prefix string")
            levels = self.levels.join(F.broadcast(table), "column")  # one row per categorical column
            out = out.unionByName(levels.select((F.col("start") + F.col("place")).alias("position"), F.concat("prefix", "level").alias("name")))
        return out

    def fits(self, df: DataFrame) -> bool:
        """Whether ``df`` has the columns, and numbers where numbers are wanted; no row is read."""
        types = {f.name: f.dataType for f in df.schema.fields}
        return set(self.roles.features) <= set(types) and all(isinstance(types[c], T.NumericType) for c in self.roles.numeric)

    def save(self, path: str) -> None:
        """Write everything under ``path``, replacing what is there."""
        spark = self.levels.sparkSession
        facts = {
            "roles": [self.roles.id, self.roles.numeric, self.roles.categorical, self.roles.target],
            "keep": self.keep, "sizes": self.sizes, "scaling": self.scaling, "train_rows": self.train_rows, "scaled": self.scaler is not None,
        }
        self.levels.write.mode("overwrite").parquet(f"{path}/levels")
        if self.scaler is not None:
            self.scaler.write().overwrite().save(f"{path}/scaler")
        # Last, so that a broken-off save is not taken for a whole one.
        spark.createDataFrame([(json.dumps(facts),)], "facts string").coalesce(1).write.mode("overwrite").text(f"{path}/encoder")


def load_encoder(spark: SparkSession, path: str) -> Encoder:
    facts = json.loads(spark.read.text(f"{path}/encoder").first()[0])
    id_column, numeric, categorical, target = facts["roles"]
    return Encoder(
        Roles(id_column, tuple(numeric), tuple(categorical), target),
        facts["keep"],
        spark.read.schema(LEVEL_SCHEMA).parquet(f"{path}/levels"),
        facts["sizes"],
        {c: tuple(v) for c, v in facts["scaling"].items()},
        facts["train_rows"],
        StandardScalerModel.load(f"{path}/scaler") if facts["scaled"] else None,
    )


def load_or_fit(path: str, fit: Callable[[], Encoder], probe: DataFrame) -> tuple[Encoder, bool]:
    """Stored encoder and True, or a newly fitted and stored one and False.

    An encoder is missing when nothing is stored under ``path``, and unusable
    when it does not fit the probe's columns; only then it is fitted again. Any
    other failure, such as a denied read or a broken table, is raised and what
    is stored stays as it is. No row of the probe is read.
    """
    spark = probe.sparkSession
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(sc._jsc.hadoopConfiguration()).exists(place):
        stored = load_encoder(spark, path)
        if stored.fits(probe):
            return stored, True
    fitted = fit()
    fitted.save(path)
    return fitted, False


def _sizes(levels: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    counted = {r["column"]: r["n"] for r in levels.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {c: counted.get(c, 0) for c in columns}


def fit_keep_unknown(train: DataFrame, roles: Roles, scale: bool = False) -> Encoder:
    """Levels by frequency, each column with a slot of its own for unknown values.

    A column with K levels takes K + 1 places after the numbers. With ``scale``
    whole vectors are centred and scaled by the sample deviation, which makes
    every row as wide as the vector; trees do not need it, so large runs leave
    it out and keep sparse rows.
    """
    levels = staged(level_dictionary(train, roles.categorical, "frequency"), "levels")
    encoder = Encoder(roles, True, levels, _sizes(levels, roles.categorical), {}, train.count())
    if not scale:
        return encoder
    vectors = encoder.transform(train).withColumnRenamed("features", "_unscaled")
    scaler = StandardScaler(inputCol="_unscaled", outputCol="features", withMean=True, withStd=True)
    return replace(encoder, scaler=scaler.fit(vectors))


def fit_ignore_unknown(train: DataFrame, roles: Roles) -> Encoder:
    """Numbers centred and scaled by the population deviation, then K places per category.

    Levels are alphabetical; unknown and missing values give all zeros.
    """
    levels = staged(level_dictionary(train, roles.categorical, "name"), "levels")
    moments = [f(F.col(c).cast("double")).alias(f"{n}_{i}") for i, c in enumerate(roles.numeric) for n, f in (("mean", F.avg), ("dev", F.stddev_pop))]
    row = train.agg(F.count(F.lit(1)).alias("rows"), *moments).first()
    scaling = {c: (row[f"mean_{i}"] or 0.0, row[f"dev_{i}"] or 0.0) for i, c in enumerate(roles.numeric)}
    return Encoder(roles, False, levels, _sizes(levels, roles.categorical), scaling, row["rows"])


def feature_matrix_check(transformed: DataFrame, *by: str, features: str = "features") -> DataFrame:
    """Rows, width, NaN and infinite entries of the feature vectors."""
    cells = vector_to_array(features)
    bad = lambda test: F.coalesce(F.sum(F.size(F.filter(cells, test)).cast("long")), F.lit(0))
    return transformed.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.size(cells)).cast("long").alias("n_features"),
        bad(lambda v: F.isnan(v)).cast("long").alias("n_nan"),
        bad(lambda v: F.abs(v) == F.lit(float("inf"))).cast("long").alias("n_infinite"),
    )

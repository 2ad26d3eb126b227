"""Result tables that another program wrote, under the names this library uses.

A layout says which of the file's columns holds what, and of which type. Cells
that do not fit their type count as missing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridgeline.functions.scalars import depth_text, nan_to_null
from ridgeline.model import Roles
from ridgeline.sources.files import MISSING_TOKENS, require_columns


@dataclass(frozen=True)
class Field:
    """A column by its name here, the names it may have in the file, in order, and its type.

    ``row_number`` fields need no column: they number the rows as they come.
    """

    name: str
    sources: tuple[str, ...]
    type: str = "double"
    row_number: bool = False


def field(name: str, *sources: str, type: str = "double") -> Field:
    return Field(name, sources or (name,), type)


ROW = Field("place", (), "long", row_number=True)
METRICS = (field("split", type="string"), field("MAE"), field("RMSE"), field("R2"))
IMPORTANCES = (field("feature", "feature", "feature_name", type="string"), field("importance"))


@dataclass(frozen=True)
class Layout:
    """How a framework writes its results.

    ``label`` lists what a configuration's text shows: the name it prints and the
    column it takes the number from.
    """

    framework: str
    search: tuple[Field, ...]
    label: tuple[tuple[str, str], ...]
    metrics: tuple[Field, ...] = METRICS
    importances: tuple[Field, ...] = IMPORTANCES

    def predictions(self, roles: Roles) -> tuple[Field, ...]:
        return (
            field(roles.id, type="long"),
            field(f"actual_{roles.target}"),
            field(f"predicted_{roles.target}"),
        )

    def configuration(self) -> Column:
        """The text of a configuration; a depth that is missing has no limit."""
        parts: list[Column] = []
        for shown, column in self.label:
            value = depth_text(F.col(column)) if column == "depth" else F.col(column).cast("int").cast("string")
            parts += [F.lit(f"{', ' if parts else ''}{shown}="), value]
        return F.concat(*parts)


# Column names of the two result sets that can be read.
SINGLE_NODE = Layout(
    "scikit-learn",
    search=(
        ROW,
        field("trees", "n_estimators", type="int"),
        field("depth", "max_depth", type="int"),
        field("min_leaf", "min_samples_leaf", type="int"),
        field("validation_MAE", "mae_val"),
        field("validation_RMSE", "rmse_val"),
        field("validation_R2", "r2_val"),
        field("fit_seconds", "train_time_s"),
        field("predict_seconds", "pred_time_s"),
    ),
    label=(("n_estimators", "trees"), ("max_depth", "depth"), ("min_samples_leaf", "min_leaf")),
)
DISTRIBUTED = Layout(
    "PySpark Spark MLlib",
    search=(
        ROW,
        field("trees", "numTrees", type="int"),
        field("depth", "maxDepth", type="int"),
        field("validation_MAE"),
        field("validation_RMSE"),
        field("validation_R2"),
        field("fit_seconds", "fit_time_seconds"),
    ),
    label=(("numTrees", "trees"), ("maxDepth", "depth")),
)


def mapped(df: DataFrame, fields: Sequence[Field], origin: str) -> DataFrame:
    """``df`` with the columns of ``fields`` only, coerced to their types.

    A field takes the first of its names that ``df`` has; all fields that have
    none, or whose name stands twice, are reported in one error. Missing tokens,
    texts that are no number, and NaN become NULL; a whole number may be written
    with a fraction of zero. Other columns are ignored, and no job is run.
    """
    chosen: dict[str, str] = {}
    for f in fields:
        if not f.row_number:
            chosen[f.name] = next((s for s in f.sources if s in df.columns), f.sources[0])
    require_columns(df, chosen.values(), origin)

    def cell(f: Field) -> Column:
        if f.row_number:
            return F.monotonically_increasing_id().alias(f.name)
        text = F.col(f"`{chosen[f.name]}`").cast("string")
        if f.type == "string":
            return F.when(~text.isin(*MISSING_TOKENS), text).alias(f.name)
        text = F.trim(text)
        number = F.when(~text.isin(*MISSING_TOKENS), text)
        if f.type == "double":
            return nan_to_null(number.try_cast("double")).alias(f.name)
        # Exact for whole numbers of any size; 20.0 is 20, and 20.5 is none.
        whole = number.try_cast("decimal(38,6)")
        return F.when(whole == F.floor(whole), whole.try_cast(f.type)).alias(f.name)

    return df.select(*[cell(f) for f in fields])


def read_mapped(spark: SparkSession, path: str, fields: Sequence[Field]) -> DataFrame:
    """A CSV with a header, mapped; only the header decides which columns there are."""
    return mapped(spark.read.option("header", True).csv(path), fields, path)

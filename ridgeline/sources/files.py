"""Reading and writing tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.functions.scalars import nan_to_null

# Cell texts that mean "missing" in a delimited file.
MISSING_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def require_columns(df: DataFrame, columns: Iterable[str], origin: str) -> DataFrame:
    """``df`` itself if each of ``columns`` names exactly one of its columns, else one error with all that do not. Runs no job."""
    found = Counter(df.columns)
    wrong = {c: found[c] for c in columns if found[c] != 1}
    if absent := [c for c, n in wrong.items() if n == 0]:
        raise ValueError(f"{origin}: missing columns {sorted(absent)}")
    if wrong:
        raise ValueError(f"{origin}: ambiguous columns {sorted(wrong)}")
    return df


def normalised(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column, so later operators see one kind."""
    changed = {
        f.name: nan_to_null(F.col(f.name).cast("double")).cast(f.dataType)
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(changed) if changed else df


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, missing: Sequence[str] = MISSING_TOKENS
) -> DataFrame:
    """Scan a CSV with a header and a declared schema.

    Cells are read as text, the missing tokens become NULL, then the text is cast
    to the declared types; a value that does not fit its type is an error, not a
    silent NULL. The header must name the declared columns, in their order.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path)

    def cell(f: T.StructField):
        c = F.col(f.name)
        if not isinstance(f.dataType, T.StringType):
            c = F.trim(c)
        return F.when(~c.isin(*missing), c).cast(f.dataType).alias(f.name)

    return normalised(raw.select(*[cell(f) for f in schema.fields]))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return normalised(spark.read.parquet(path))


def coerced(df: DataFrame, columns: Sequence[str], type_name: str = "double") -> DataFrame:
    """Cast text to a type; what does not fit becomes NULL."""
    return df.withColumns({c: F.expr(f"try_cast(`{c}` AS {type_name})") for c in columns})


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write part files from the executors, replacing what is at ``path``."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).option("emptyValue", '""').csv(path)
    else:
        writer.format(fmt).save(path)


def write_small_csv(df: DataFrame, path: str) -> None:
    """One CSV part file, for result tables of a few rows only."""
    write_table(df.coalesce(1), path, "csv")

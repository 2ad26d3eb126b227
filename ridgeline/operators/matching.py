"""One-to-one joins, agreement of shared columns, reconciliation, positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridgeline.functions.scalars import agrees
from ridgeline.operators.ranking import with_starts
from ridgeline.sources.scratch import staged

# Rows of a task that sorts or groups by identifier or place, whose memory follows their number.
ROWS_PER_PARTITION = 250_000
FEWEST_PARTITIONS = 4


def _unique(df: DataFrame, key: str, side: str) -> DataFrame:
    """One row per key; running it fails on a repeated key.

    The grouping hashes by the key, which the following join needs anyway, so
    the check adds no shuffle; copies of a hot key are combined before it.
    """
    others = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"), *[F.first(c).alias(c) for c in others])
    problem = F.format_string(f"{side}: {key} %s is not unique", F.col(key).cast("string"))
    valid = F.when(F.col("_copies") == 1, F.lit(True)).otherwise(F.raise_error(problem).cast("boolean"))
    return grouped.filter(valid).select(key, *others)


def one_to_one_join(left: DataFrame, right: DataFrame, key: str, suffixes: tuple[str, str]) -> DataFrame:
    """Inner join that fails unless the key is unique on both sides.

    Columns both sides have get the suffixes. A missing key matches nothing;
    ``reconcile`` counts such rows.
    """
    shared = [c for c in left.columns if c in right.columns and c != key]
    sides = [
        _unique(side.withColumnsRenamed({c: c + suffix for c in shared}), key, name)
        for side, suffix, name in zip((left, right), suffixes, ("left", "right"))
    ]
    return sides[0].join(sides[1], key)


def disagreements(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: how many rows hold values that differ beyond tolerance."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~agrees(F.col(a), F.col(b))).alias("n_disagree"),
    )


def required_agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """``df`` with ``b`` merged into ``a``; running it fails on a real difference."""
    problem = F.format_string(f"{a} and {b} differ: %s, %s", F.col(a).cast("string"), F.col(b).cast("string"))
    valid = F.when(agrees(F.col(a), F.col(b)), F.lit(True)).otherwise(F.raise_error(problem).cast("boolean"))
    return df.filter(valid).drop(b)


def reconcile(
    predictions: DataFrame, source: DataFrame, key: str, actual: str
) -> DataFrame:
    """(check, violations) of a prediction table against the rows it came from.

    Both tables are stacked and reduced to one row per key before the shuffle,
    so repeated or missing keys of any number cannot pile up in one task. Actual
    values must be equal, not just close.
    """
    tagged = predictions.select(F.col(key).alias("k"), F.col(actual).alias("y"), F.lit(True).alias("p")).unionByName(
        source.select(F.col(key).alias("k"), F.col(actual).alias("y"), F.lit(False).alias("p"))
    )
    p, s, y = F.col("p"), ~F.col("p"), F.col("y")
    per_key = tagged.groupBy("k").agg(
        F.count_if(p).alias("np"),
        F.count_if(s).alias("ns"),
        F.min(F.when(p, y)).alias("p_low"),
        F.max(F.when(p, y)).alias("p_high"),
        F.min(F.when(s, y)).alias("s_low"),
        F.max(F.when(s, y)).alias("s_high"),
        F.count_if(p & y.isNull()).alias("p_missing"),
        F.count_if(s & y.isNull()).alias("s_missing"),
    )
    known, both = F.col("k").isNotNull(), (F.col("np") > 0) & (F.col("ns") > 0)
    same = (
        F.col("p_low").eqNullSafe(F.col("s_low"))
        & F.col("p_high").eqNullSafe(F.col("s_high"))
        & ((F.col("p_missing") > 0) == (F.col("s_missing") > 0))
    )
    counts = {
        "row_count_difference": F.abs(F.sum("np") - F.sum("ns")),
        "missing_key": F.sum(F.when(~known, F.col("np"))),
        "repeated_key": F.sum(F.when(known & (F.col("np") > 1), F.col("np") - 1)),
        "not_predicted": F.count_if(known & (F.col("np") == 0)),
        "not_in_source": F.count_if(known & (F.col("ns") == 0)),
        "actual_changed": F.count_if(known & both & ~same),
    }
    row = per_key.agg(*[F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in counts.items()])
    cells = [F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in counts]
    return row.select(F.inline(F.array(*cells)))


def require_reconciled(predictions: DataFrame, source: DataFrame, key: str, actual: str) -> None:
    """Raise when any reconciliation check counts a violation (six numbers are read)."""
    bad = reconcile(predictions, source, key, actual).filter(F.col("violations") > 0).collect()
    if bad:
        raise ValueError("; ".join(f"{r['check']}: {r['violations']}" for r in bad))


def partitions(rows: int) -> int:
    """How many tasks ``rows`` rows are dealt to."""
    return max(FEWEST_PARTITIONS, -(-rows // ROWS_PER_PARTITION))


def with_position(files: DataFrame) -> DataFrame:
    """Add ``position``, the 0-based row number over files in path order.

    ``files`` must be a plain file scan. Rows keep their order inside a block of
    a file; the number of rows per block gives each block its offset. Where a
    block starts depends on how the files are cut when a job is planned, so the
    rows are written once with their labels, and offsets and result both come
    from that copy. Blocks are added up in two levels, within ranges of their
    order and over the ranges, however many files there are. Rows get the offset of
    their block where they are: there is one offset per block of the files, which
    the driver lists anyway.
    """
    labelled = files.withColumns(
        {
            "_path": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_seq": F.monotonically_increasing_id(),
        }
    )
    rows = staged(labelled, "positions")
    blocks = rows.groupBy("_path", "_block").agg(F.count(F.lit(1)).alias("_rows"), F.min("_seq").alias("_first"))
    starts = with_starts(blocks, [F.col("_path"), F.col("_block")], "_rows", "_start")
    offsets = starts.select("_path", "_block", (F.col("_start") - F.col("_first")).alias("_offset"))
    placed = rows.join(F.broadcast(offsets), ["_path", "_block"]).withColumn("position", F.col("_offset") + F.col("_seq"))
    return placed.select(*files.columns, "position")


def attach_ids(files: DataFrame, id_files: DataFrame, id_column: str) -> DataFrame:
    """Give the rows of ``files`` the identifiers that stand at the same place.

    For data whose identifiers were written to a separate one-column file. Names,
    lengths, missing and repeated identifiers are checked first, on the copies
    that are joined; running the result fails on a place only one side has. The
    rows of a task are bounded, so its memory does not grow with the files.
    """
    if id_files.columns != [id_column]:
        raise ValueError(f"expected exactly the column {id_column}, found {id_files.columns}")
    if id_column in files.columns:
        raise ValueError(f"{id_column} is already present")
    rows, ids = with_position(files), with_position(id_files)
    expected = rows.count()
    tasks = partitions(expected)
    checked = ids.repartition(tasks, id_column).groupBy(id_column).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count_if(F.col(id_column).isNull()).alias("missing"),
        F.count_if(F.col("n") > 1).alias("repeated"),
    ).first()
    if checked["rows"] != expected or checked["missing"] or checked["repeated"]:
        raise ValueError(f"{id_column}: {expected} rows expected, found {checked.asDict()}")
    sides = rows.withColumn("_row", F.lit(True)), ids
    both = sides[0].repartition(tasks, "position").join(sides[1].repartition(tasks, "position"), "position", "full_outer")
    paired = F.col("_row").isNotNull() & F.col(id_column).isNotNull()
    problem = F.format_string(f"{id_column}: position %s is on one side only", F.col("position").cast("string"))
    valid = F.when(paired, F.lit(True)).otherwise(F.raise_error(problem).cast("boolean"))
    return both.filter(valid).select(id_column, *files.columns)


def rows_in_order(df: DataFrame, keys: Sequence[str], key_column: str) -> DataFrame:
    """Rows of a small result table, looked up and ordered by a list of keys."""
    rank = F.array_position(F.array(*[F.lit(k) for k in keys]), F.col(key_column))
    return df.filter(F.col(key_column).isin(*keys)).orderBy(rank)

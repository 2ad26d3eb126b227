"""Exact stratified split and seeded sampling by hashed identifier.

A row's place is the rank of ``md5(seed|id)`` in its stratum. Ranking every row
would sort the table; instead only the hash value at each cut is looked for, by
counting hash prefixes. A split is then a plain projection and a sample a plain
filter, with no shuffle of rows at all.

Repeated identifiers share a hash. Where a cut falls among the rows of one
identifier, only those rows are ranked further: by a hash of the whole row, and
rows that are alike in everything by the order in which they were written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ridgeline.model import SPLITS
from ridgeline.operators.ranking import with_places
from ridgeline.sources.scratch import staged

# Hash digits counted per round, and rows that may be ranked one by one.
DIGITS = 3
RANK_LIMIT = 200_000
HASH_LENGTH = 32


def hash_of(id_column: str, seed: int) -> Column:
    """Hash of an identifier; rows without one share the hash of an empty text."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))))


@dataclass(frozen=True)
class Cut:
    """The hash at a cut, and how many of the ``copies`` rows with that hash lie before the cut or on it."""

    hash: str
    inside: int
    copies: int


NOTHING = Cut("", 0, 0)  # no hash is below the empty text


@dataclass(frozen=True)
class _Search:
    stratum: bool
    name: str
    rank: int  # 1-based, counted from the start of ``prefix``
    prefix: str
    rows: int


def hash_cuts(
    rows: DataFrame,
    cuts_of: Callable[[int], dict[str, int]],
    rank_limit: int = RANK_LIMIT,
) -> dict[tuple[bool, str], Cut]:
    """Hash value at given ranks of each stratum.

    ``rows`` has (stratum boolean, hash string); ``cuts_of`` maps a stratum's
    size to named 1-based ranks. Returns {(stratum, name): Cut}; a rank of 0
    gives one that nothing is below. Only counts and the found hash values reach
    the driver: two strata with a few cuts each.
    """
    first = F.substring("hash", 1, DIGITS)
    counted = rows.groupBy("stratum", first.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    prefixes = sorted((r["stratum"], r["prefix"], r["n"]) for r in counted.collect())  # 2 x 16**DIGITS at most
    found: dict[tuple[bool, str], Cut] = {}
    cuts: list[_Search] = []
    for stratum in sorted({s for s, _, _ in prefixes}):
        counts = [(p, n) for s, p, n in prefixes if s == stratum]
        for name, rank in cuts_of(sum(n for _, n in counts)).items():
            if rank == 0:
                found[stratum, name] = NOTHING
            else:
                cuts.append(_within(stratum, name, rank, counts))

    def members(some: Sequence[_Search]) -> DataFrame:
        """Rows under a cut's prefix, labelled with the cut."""
        label = F.array_compact(
            F.array(
                *[
                    F.when((F.col("stratum") == c.stratum) & F.col("hash").startswith(c.prefix), F.lit(i))
                    for i, c in enumerate(some)
                ]
            )
        )
        return rows.select("hash", F.explode(label).alias("cut"))

    while wide := [c for c in cuts if c.rows > rank_limit and len(c.prefix) < HASH_LENGTH]:
        keep = [c for c in cuts if c not in wide]
        upto = F.get(F.array(*[F.lit(len(c.prefix) + DIGITS) for c in wide]), F.col("cut"))
        counted = (
            members(wide)
            .withColumn("prefix", F.col("hash").substr(F.lit(1), upto))
            .groupBy("cut", "prefix")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        got = sorted((r["cut"], r["prefix"], r["n"]) for r in counted.collect())
        cuts = keep + [
            _within(c.stratum, c.name, c.rank, [(p, n) for k, p, n in got if k == i]) for i, c in enumerate(wide)
        ]
    # A full-length prefix is one hash value; only copies of one identifier share it.
    found.update({(c.stratum, c.name): Cut(c.prefix, c.rank, c.rows) for c in cuts if len(c.prefix) == HASH_LENGTH})
    cuts = [c for c in cuts if len(c.prefix) < HASH_LENGTH]
    if cuts:
        ranks = F.get(F.array(*[F.lit(c.rank) for c in cuts]), F.col("cut"))
        order = Window.partitionBy("cut").orderBy("hash")
        alike = Window.partitionBy("cut", "hash")
        exact = members(cuts).withColumns(
            {"rank": F.row_number().over(order), "first": F.rank().over(order), "copies": F.count(F.lit(1)).over(alike)}
        )
        for r in exact.filter(F.col("rank") == ranks).collect():
            c = cuts[r["cut"]]
            found[c.stratum, c.name] = Cut(r["hash"], r["rank"] - r["first"] + 1, r["copies"])
    return found


def _within(stratum, name, rank, counts) -> _Search:
    for prefix, n in counts:
        if rank <= n:
            return _Search(stratum, name, rank, prefix, n)
        rank -= n
    raise ValueError(f"rank beyond the rows of stratum {stratum}")


def _below(key: Column, cut: Cut, occurrence: Column | None) -> Column:
    """Whether a row lies before a cut or on it; rows on it by their occurrence, if they are numbered."""
    if occurrence is None:
        return key <= F.lit(cut.hash)
    return (key < F.lit(cut.hash)) | ((key == F.lit(cut.hash)) & (occurrence <= cut.inside))


def _placed(
    df: DataFrame, key: Column, stratum: Column, cuts: dict[tuple[bool, str], Cut], rule: Callable[[Column | None], Column], name: str
) -> DataFrame:
    """``df`` with the column ``name`` by ``rule``, which gets the occurrence of rows that a cut parts from their like."""
    parted = sorted({c.hash for c in cuts.values() if c.inside < c.copies})
    if not parted:
        return df.withColumn(name, rule(None))
    content = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    alike = df.filter(key.isin(parted)).withColumns(
        {"_key": key, "_stratum": stratum, "_content": F.xxhash64(*content), "_written": F.monotonically_increasing_id()}
    )
    # Written, so that rows which are alike in everything keep their number.
    ranked = with_places(staged(alike, "alike"), ["_stratum", "_key"], [F.col("_content"), F.col("_written")], "_place")
    rest = ranked.withColumn(name, rule(F.col("_place") + 1)).select(*df.columns, name)
    return df.filter(~key.isin(parted)).withColumn(name, rule(None)).unionByName(rest)


def stratified_split(
    df: DataFrame,
    id_column: str,
    target: str,
    seed: int = 42,
    train_percent: int = 70,
    validation_percent: int = 15,
    rank_limit: int = RANK_LIMIT,
) -> DataFrame:
    """Add ``split``: exact shares of the rows, separately for zero and other targets.

    ``df`` is scanned a few times, so hand in a table or a staged frame rather
    than a chain of joins. Identifiers may repeat or be missing; the shares stay
    exact. An empty table gives an empty result.
    """
    flag = F.coalesce(F.col(target) == 0, F.lit(False))
    key = hash_of(id_column, seed)

    def cuts_of(n: int) -> dict[str, int]:
        return {
            "train": n * train_percent // 100,
            "validation": n * (train_percent + validation_percent) // 100,
        }

    cuts = hash_cuts(df.select(flag.alias("stratum"), key.alias("hash")), cuts_of, rank_limit)
    train, validation, test = SPLITS

    def rule(occurrence: Column | None) -> Column:
        def below(name: str) -> Column:
            by_stratum = [_below(key, cuts.get((s, name), NOTHING), occurrence) for s in (True, False)]
            return F.when(flag, by_stratum[0]).otherwise(by_stratum[1])

        return F.when(below("train"), train).when(below("validation"), validation).otherwise(test)

    return _placed(df, key, flag, cuts, rule, "split")


def seeded_sample(
    df: DataFrame, id_column: str, n: int, seed: int = 42, rank_limit: int = RANK_LIMIT
) -> DataFrame:
    """Exactly min(n, rows) rows, always the same ones for a seed, also where identifiers repeat."""
    key = hash_of(id_column, seed)
    hashes = df.select(F.lit(False).alias("stratum"), key.alias("hash"))
    cuts = hash_cuts(hashes, lambda size: {"last": min(n, size)}, rank_limit)
    last = cuts.get((False, "last"), NOTHING)
    placed = _placed(df, key, F.lit(False), cuts, lambda occurrence: _below(key, last, occurrence), "_sampled")
    return placed.filter("_sampled").drop("_sampled")

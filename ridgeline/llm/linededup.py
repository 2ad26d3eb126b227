"""Line dedup by a tree of line templates, in DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import fresh
from ridgeline.sources.scratch import staged

BLANKS = "[ \\t\\u000B\\f\\r]+"
#: A token with a digit in it is a variable field from the start.
WITH_DIGIT = "(?<![^ \\t\\u000B\\f\\r])[^ \\t\\u000B\\f\\r0-9]*+[0-9][^ \\t\\u000B\\f\\r]*+"
FIELD = "<*>"


@dataclass(frozen=True)
class Settings:
    """``depth`` leading tokens below the token count make a leaf of the tree.

    In a leaf, the token at a position is part of the template when at least
    two documents and ``share`` of the leaf's documents have it there, else a
    field. A template recurs when ``(documents - 1) * constant tokens`` reaches
    ``evidence``, it has ``shortest`` constant tokens and they are ``similarity``
    of the line: many documents for a short line, two for a long one.
    """

    depth: int = 3
    share: float = 0.25
    similarity: float = 0.6
    evidence: int = 20
    shortest: int = 3


def _tokens(line: Column) -> Column:
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, WITH_DIGIT, FIELD)).otherwise(line)
    return F.filter(F.split(masked, BLANKS), lambda t: t != "")


def line_keys(docs: DataFrame, depth: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_key, at, n, leaf, line`` for every line that has tokens: its place, token count and hashes."""
    text = F.col(text_col).cast("string")
    lines = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), F.posexplode(F.split(text, "\n")).alias("at", "l")
    )
    cut = lines.filter("doc_id is not null").withColumn("t", _tokens(F.col("l"))).withColumn("n", F.size("t"))
    return cut.filter("n > 0").select(
        "doc_id",
        "text_key",
        "at",
        "n",
        F.xxhash64("n", F.slice("t", 1, depth)).alias("leaf"),
        F.xxhash64(F.lit(1), "t").alias("line"),
    )


def _recurs(documents: str, constant: str, s: Settings) -> Column:
    d, c = F.col(documents), F.col(constant)
    return (d >= 2) & (c >= s.shortest) & (c >= s.similarity * F.col("n")) & ((d - 1) * c >= s.evidence)


def recurring(docs: DataFrame, keys: DataFrame, s: Settings, id_col: str, text_col: str) -> DataFrame:
    """``leaf, line, keep``: lines whose template recurs, and the smallest document that has the template."""
    in_docs = keys.groupBy("leaf", "line", "n", "doc_id").agg(F.min(F.struct("at", "text_key")).alias("p"))
    in_docs = staged(in_docs.select("leaf", "line", "n", "doc_id", "p.at", "p.text_key"), "line_docs")
    variants = in_docs.groupBy("leaf", "line", "n").agg(
        F.count(F.lit(1)).alias("docs"), F.min(F.struct("doc_id", "at", "text_key")).alias("first")
    )
    variants = staged(variants, "variants")
    whole = variants.filter(_recurs("docs", "n", s)).select("leaf", "line", F.col("first.doc_id").alias("keep"))

    # Leaves with several lines: tell constant tokens from fields by counting documents per position.
    leaves = variants.groupBy("leaf").agg(F.count(F.lit(1)).alias("lines"), F.sum("docs").alias("leaf_docs"), F.max("n").alias("n"))
    leaves = leaves.filter((F.col("lines") > 1) & ((F.col("leaf_docs") - 1) * F.col("n") >= s.evidence) & (F.col("n") >= s.shortest))
    mixed = variants.join(staged(leaves.select("leaf", "leaf_docs"), "leaves"), "leaf")
    wanted = mixed.select(
        F.col("first.doc_id").alias("doc_id"), F.col("first.text_key").alias("text_key"), F.col("first.at").alias("at"), "leaf", "line", "n", "docs", "leaf_docs"
    )
    wanted = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("at", "leaf", "line", "n", "docs", "leaf_docs")).alias("w"))
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), F.split(text, "\n").alias("ls"))
    picked = texts.join(staged(wanted, "wanted"), ["doc_id", "text_key"])
    picked = picked.select(F.explode(F.transform("w", lambda w: F.struct(w.alias("w"), F.get("ls", w["at"]).alias("l")))).alias("x"))
    tokens = picked.select("x.w.*", "x.l").dropDuplicates(["leaf", "line"])
    tokens = tokens.select("leaf", "line", "n", "docs", "leaf_docs", F.posexplode(_tokens(F.col("l"))).alias("place", "token"))
    tokens = staged(tokens.withColumn("token", F.xxhash64("token")), "tokens")
    constant = tokens.groupBy("leaf", "place", "token").agg(F.sum("docs").alias("d"), F.first("leaf_docs").alias("of"))
    constant = staged(constant.filter((F.col("d") >= 2) & (F.col("d") >= s.share * F.col("of"))).select("leaf", "place", "token"), "constant")
    shape = (
        tokens.join(constant, ["leaf", "place", "token"])
        .groupBy("leaf", "line", "n")
        .agg(F.count(F.lit(1)).alias("constant"), F.bit_xor(F.xxhash64("place", "token")).alias("template"))
        .filter((F.col("constant") >= s.shortest) & (F.col("constant") >= s.similarity * F.col("n")))
    )
    shape = staged(shape, "shape")
    members = in_docs.join(shape.select("leaf", "line", "constant", "template"), ["leaf", "line"])
    per_doc = members.groupBy("leaf", "template", "constant", "n", "doc_id").agg(F.lit(1).alias("one"))
    counted = per_doc.groupBy("leaf", "template", "constant", "n").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("keep"))
    counted = staged(counted.filter(_recurs("docs", "constant", s)).select("leaf", "template", "keep"), "templates")
    general = shape.join(counted, ["leaf", "template"]).select("leaf", "line", "keep")
    return whole.union(general).groupBy("leaf", "line").agg(F.min("keep").alias("keep"))


def dropped_lines(docs: DataFrame, s: Settings, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_key, gone``: the places of the lines that go, for documents that lose any."""
    keys = staged(line_keys(docs, s.depth, id_col, text_col), "line_keys")
    drop = staged(recurring(docs, keys, s, id_col, text_col), "recurring")
    rows = keys.join(drop, ["leaf", "line"]).filter("doc_id != keep")
    return rows.groupBy("doc_id", "text_key").agg(F.collect_set("at").alias("gone"))


def deduplicated(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with recurring lines dropped from ``text_col``, and ``n_lines``, ``n_dropped``.

    A line whose template recurs across documents stays in the document with
    the smallest id and goes from all others. Repeats inside one document are
    no recurrence. Lines without tokens, and the order of the rest, stay as
    they are; a text without a dropped line stays byte for byte.

    NULL and empty texts stay (a NULL has 0 lines). Rows with a NULL id are
    neither counted nor changed; rows with the same id count as one document.
    Other columns are passed through whatever their names; the two new columns
    get a trailing underscore if their names are taken. An empty table gives
    an empty result.
    """
    gone = staged(dropped_lines(docs, settings, id_col, text_col), "dropped")
    lines, key, place = fresh(docs, "_lines"), fresh(docs, "_text_key"), fresh(docs, "_gone")
    text = F.col(text_col).cast("string")
    wide = docs.withColumn(key, F.xxhash64(text)).withColumn(lines, F.split(text, "\n")).drop(text_col)
    gone_id, gone_key = fresh(docs, "_gone_id"), fresh(docs, "_gone_key")
    gone = gone.select(F.col("doc_id").alias(gone_id), F.col("text_key").alias(gone_key), F.col("gone").alias(place))
    joined = wide.join(gone, (F.col(id_col).cast("long") == F.col(gone_id)) & (F.col(key) == F.col(gone_key)), "left")
    n = F.coalesce(F.size(lines), F.lit(0))
    n = F.when(F.col(lines).isNull(), 0).otherwise(n)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(place))
    some = F.array_join(F.transform(kept, lambda i: F.get(F.col(lines), i)), "\n")
    new = F.when(F.col(place).isNull(), F.array_join(F.col(lines), "\n")).otherwise(some)
    n_lines, n_dropped = fresh(docs, "n_lines"), fresh(docs, "n_dropped")
    cols = [new.alias(c) if c == text_col else F.col(c) for c in docs.columns]
    return joined.select(*cols, n.cast("long").alias(n_lines), F.coalesce(F.size(place), F.lit(0)).cast("long").alias(n_dropped))

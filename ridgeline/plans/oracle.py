"""The registered queries as plain SQL over the same tables, whole tables throughout."""

from __future__ import annotations

PROFILE = """
lines AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty,
         sum(CAST(round(l_discount * 100) AS BIGINT)) AS disc_pts,
         sum(CASE WHEN l_returnflag = 'R' THEN CAST(round(l_extendedprice * 100) AS BIGINT) END) AS cents
  FROM lineitem GROUP BY l_orderkey),
order_profile AS (
  SELECT o_orderkey AS record_id,
         CAST(coalesce(n_lines, 0) AS DOUBLE) AS n_lines,
         CAST(coalesce(qty, 0) AS DOUBLE) AS qty,
         CAST(coalesce(disc_pts, 0) AS DOUBLE) AS disc_pts,
         o_totalprice AS totalprice, c_acctbal AS acctbal,
         o_orderstatus AS status, o_orderpriority AS priority,
         c_mktsegment AS segment, n_name AS nation,
         CAST(coalesce(cents, 0) AS DOUBLE) / 100 AS target
  FROM orders
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN lines ON o_orderkey = l_orderkey)"""

SPLIT = (
    PROFILE
    + """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY target = 0 ORDER BY md5('42|' || CAST(record_id AS VARCHAR))) AS place,
         count(*) OVER (PARTITION BY target = 0) AS size
  FROM order_profile),
split_rows AS (
  SELECT *, CASE WHEN place <= size * 70 // 100 THEN 'train'
                 WHEN place <= size * 85 // 100 THEN 'validation' ELSE 'test' END AS split
  FROM placed)"""
)

PREDICTORS = (
    SPLIT
    + """,
p_mean AS (SELECT priority, round(avg(target), 2) AS by_priority FROM split_rows WHERE split = 'train' GROUP BY priority),
s_mean AS (SELECT segment, round(avg(target), 2) AS by_segment FROM split_rows WHERE split = 'train' GROUP BY segment),
overall AS (SELECT round(avg(target), 2) AS mean_target FROM split_rows WHERE split = 'train'),
both_predicted AS (
  SELECT record_id, split, target AS actual, coalesce(by_priority, mean_target) AS by_priority, coalesce(by_segment, mean_target) AS by_segment
  FROM split_rows LEFT JOIN p_mean USING (priority) LEFT JOIN s_mean USING (segment) CROSS JOIN overall),
predicted AS (
  SELECT 'priority' AS model, record_id, split, actual, by_priority AS predicted FROM both_predicted
  UNION ALL
  SELECT 'segment', record_id, split, actual, by_segment FROM both_predicted)"""
)

METRICS = (
    PREDICTORS
    + """,
metrics AS (
  SELECT model, split, count(*) AS n, avg(abs(actual - predicted)) AS mae,
         sqrt(avg((actual - predicted) * (actual - predicted))) AS rmse,
         1 - avg((actual - predicted) * (actual - predicted)) / var_pop(actual) AS r2
  FROM predicted GROUP BY model, split)"""
)

SPLIT_PLACE = "CASE split WHEN 'train' THEN 1 WHEN 'validation' THEN 2 ELSE 3 END"


def describe(source: str, column: str, extra: str = "", group: str = "", digits: int = 4) -> str:
    """One describe line of one column."""
    numbers = {
        "mean": "avg(x)",
        "std": "stddev_samp(x)",
        "min": "min(x)",
        "q25": "quantile_cont(x, 0.25)",
        "q50": "quantile_cont(x, 0.5)",
        "q75": "quantile_cont(x, 0.75)",
        "max": "max(x)",
    }
    cells = ", ".join(f'round({e}, {digits}) AS "{n}"' for n, e in numbers.items())
    return (
        f"SELECT {extra} '{column}' AS \"column\", count(x) AS \"count\", {cells} "
        f"FROM (SELECT *, CAST({column} AS DOUBLE) AS x FROM {source}) AS t {group}"
    )


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


LINE_NUMERICS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
NUMERIC = ("n_lines", "qty", "disc_pts", "totalprice", "acctbal")
CATEGORICAL = ("status", "priority", "segment", "nation")

FENCES = """
SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {t})"""


def iqr(source: str, column: str) -> str:
    fences = FENCES.format(c=column, t=source)
    return f"""SELECT '{column}' AS "column", round(any_value(q1), 6) AS q1, round(any_value(q3), 6) AS q3,
  round(any_value(lower), 6) AS lower, round(any_value(upper), 6) AS upper,
  CAST(sum(CASE WHEN {column} < lower OR {column} > upper THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers,
  round(sum(CASE WHEN {column} < lower OR {column} > upper THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) * 100, 6) AS percent
FROM {source}, ({fences}) AS f"""


def zero_rate(source: str, *by: str) -> str:
    keys = "".join(f"{k}, " for k in by)
    group = f"GROUP BY {', '.join(by)}" if by else ""
    return f"""SELECT {keys}count(*) AS total, CAST(sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_count,
  round(sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) * 100, 6) AS zero_percent
FROM {source} {group}"""


EDGES = (0, 25, 50, 100, 150, 200, 250, 300)
BIN = (
    "CASE "
    + " ".join(f"WHEN qty > {a} AND qty <= {b} THEN '({a}, {b}]'" for a, b in zip(EDGES, EDGES[1:]))
    + " END"
)


def bin_number(value: str, low: str, high: str, bins: int) -> str:
    """Equal-width bin number with the correction next to an edge."""
    step = f"(({high} - {low}) / {bins})"
    guess = f"least(CAST(floor(({value} - {low}) / {step}) AS BIGINT), {bins - 1})"
    return f"""(CASE WHEN {value} < {low} + {guess} * {step} AND {guess} > 0 THEN {guess} - 1
     WHEN {value} >= {low} + ({guess} + 1) * {step} AND {guess} < {bins - 1} THEN {guess} + 1
     ELSE {guess} END)"""


HISTOGRAM = f"""
WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
binned AS (SELECT {bin_number('value', 'lo', 'hi', 50)} AS bin FROM events, b),
counted AS (SELECT bin, count(*) AS n FROM binned GROUP BY bin)
SELECT i AS bin, round(lo + i * ((hi - lo) / 50), 6) AS lower, round(lo + (i + 1) * ((hi - lo) / 50), 6) AS upper,
       coalesce(n, 0) AS n
FROM (SELECT range AS i FROM range(50)) AS r CROSS JOIN b LEFT JOIN counted ON bin = i"""

HISTOGRAM_DAMAGED = f"""
WITH kept AS (SELECT value FROM events WHERE event_id % 97 NOT IN (1, 2, 3, 4)),
b AS (SELECT min(value) AS lo, max(value) AS hi FROM kept),
binned AS (SELECT {bin_number('value', 'lo', 'hi', 50)} AS bin FROM kept, b),
counted AS (SELECT bin, count(*) AS n FROM binned GROUP BY bin)
SELECT i AS bin, round(lo + i * ((hi - lo) / 50), 6) AS lower, round(lo + (i + 1) * ((hi - lo) / 50), 6) AS upper,
       coalesce(n, 0) AS n
FROM (SELECT range AS i FROM range(50)) AS r CROSS JOIN b LEFT JOIN counted ON bin = i
UNION ALL SELECT -1, NULL, any_value(round(lo, 6)), count(*) FROM events, b WHERE event_id % 97 = 4
UNION ALL SELECT 50, any_value(round(hi, 6)), NULL, count(*) FROM events, b WHERE event_id % 97 = 3
UNION ALL SELECT NULL, NULL, NULL, count(*) FROM events WHERE event_id % 97 = 2"""

GRID = f"""
WITH b AS (SELECT min(l_quantity) AS x0, max(l_quantity) AS x1, min(l_extendedprice) AS y0, max(l_extendedprice) AS y1 FROM lineitem),
cells AS (SELECT {bin_number('l_quantity', 'x0', 'x1', 20)} AS x_bin,
                 {bin_number('l_extendedprice', 'y0', 'y1', 20)} AS y_bin FROM lineitem, b)
SELECT x_bin, y_bin, count(*) AS n FROM cells GROUP BY x_bin, y_bin"""


def top_values(column: str) -> str:
    return f"""SELECT '{column}' AS "column", place, value, n FROM (
  SELECT {column} AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {column}) AS place
  FROM part WHERE {column} IS NOT NULL GROUP BY {column}) WHERE place <= 20"""


def category_targets(column: str) -> str:
    return f"""SELECT * FROM (
  SELECT '{column}' AS feature, {column} AS category, count(target) AS "count", round(avg(target), 4) AS "mean",
         round(quantile_cont(target, 0.5), 4) AS median,
         row_number() OVER (ORDER BY avg(target) DESC, {column}) AS place
  FROM split_rows WHERE split = 'train' GROUP BY {column}) WHERE place <= 10"""


def correlations(source: str) -> str:
    return union(f"SELECT '{c}' AS feature, corr({c}, target) AS r FROM {source}" for c in NUMERIC)


SUBSET_SPLITS = ("same split", "test"), ("other split", "validation")


def reconcile(label: str, split: str) -> str:
    """Checks of the priority predictions of one split against the test rows."""
    p = f"(SELECT * FROM predicted WHERE model = 'priority' AND split = '{split}')"
    s = "(SELECT * FROM predicted WHERE model = 'segment' AND split = 'test')"
    checks = {
        "row_count_difference": f"SELECT abs((SELECT count(*) FROM {p}) - (SELECT count(*) FROM {s}))",
        "missing_key": f"SELECT count(*) FROM {p} WHERE record_id IS NULL",
        "repeated_key": f"SELECT count(record_id) - count(DISTINCT record_id) FROM {p}",
        "not_predicted": f"SELECT count(*) FROM {s} AS s WHERE NOT EXISTS (SELECT 1 FROM {p} AS p WHERE p.record_id = s.record_id)",
        "not_in_source": f"SELECT count(*) FROM {p} AS p WHERE NOT EXISTS (SELECT 1 FROM {s} AS s WHERE p.record_id = s.record_id)",
        "actual_changed": f"SELECT count(*) FROM {p} AS p JOIN {s} AS s ON p.record_id = s.record_id WHERE p.actual <> s.actual",
    }
    return union(f"SELECT '{n}' AS \"check\", CAST(({q}) AS BIGINT) AS violations, '{label}' AS against" for n, q in checks.items())


def reconciled(predictions: str, source: str) -> str:
    """Checks of one table of (record_id, actual) against another."""
    p, s = predictions, source
    checks = {
        "row_count_difference": f"SELECT abs((SELECT count(*) FROM {p}) - (SELECT count(*) FROM {s}))",
        "missing_key": f"SELECT count(*) FROM {p} WHERE record_id IS NULL",
        "repeated_key": f"SELECT count(record_id) - count(DISTINCT record_id) FROM {p}",
        "not_predicted": f"SELECT count(*) FROM {s} AS s WHERE NOT EXISTS (SELECT 1 FROM {p} AS p WHERE p.record_id = s.record_id)",
        "not_in_source": f"SELECT count(*) FROM {p} AS p WHERE record_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {s} AS s WHERE p.record_id = s.record_id)",
        "actual_changed": f"SELECT count(DISTINCT p.record_id) FROM {p} AS p JOIN {s} AS s ON p.record_id = s.record_id WHERE p.actual <> s.actual",
    }
    return union(f"SELECT '{n}' AS \"check\", CAST(({q}) AS BIGINT) AS violations" for n, q in checks.items())


def bad_entries() -> str:
    """Counts of NaN and infinite numbers over all numeric columns."""
    tests = {"n_nan": "isnan({c})", "n_infinite": "isinf({c})"}
    sums = {n: " + ".join(f"count(*) FILTER (WHERE {t.format(c=c)})" for c in NUMERIC) for n, t in tests.items()}
    return ", ".join(f"CAST({e} AS BIGINT) AS {n}" for n, e in sums.items())


SHARES = {
    "ignore": {"p_brand": 0.35, "p_type": 0.15, "p_name": 0.1},
    "keep": {"p_brand": 0.05, "p_type": 0.3, "p_name": 0.25},
}


def importances() -> str:
    """Rolled-up importances, computed from the base columns."""
    parts = []
    for model, shares in SHARES.items():
        for c, s in shares.items():
            parts.append(
                f"SELECT '{model}' AS model, '{c}' AS feature, sum({s} * n / total) AS v "
                f"FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM part GROUP BY {c}), "
                f"(SELECT CAST(count(*) AS DOUBLE) AS total FROM part)"
            )
        for c in ("p_size", "p_retailprice"):
            parts.append(f"SELECT '{model}', '{c}', CASE WHEN count(*) > 0 THEN 0.2 END FROM part")
    return union(parts)


IMPORTANCE = f"""rolled AS ({importances()}),
cleaned AS (SELECT model, feature, CAST(round(v, 9) AS DOUBLE) AS v FROM rolled),
ranked AS (SELECT model, feature, v, rank() OVER (PARTITION BY model ORDER BY v DESC) AS place FROM cleaned)"""

ROLLED_ALL = f"WITH {IMPORTANCE}, everything AS (SELECT model, feature FROM rolled UNION ALL SELECT DISTINCT model, 'p_container' FROM rolled)"

MEAN_SEARCH = (
    SPLIT
    + ",\n"
    + ",\n".join(
        f"m_{c} AS (SELECT {c}, round(avg(target), 2) AS by_{c} FROM split_rows WHERE split = 'train' GROUP BY {c})"
        for c in CATEGORICAL
    )
    + ",\noverall AS (SELECT round(avg(target), 2) AS mean_target FROM split_rows WHERE split = 'train')"
    + ",\nsearch AS ("
    + union(
        f"SELECT {i} AS place, {10 * i} AS trees, {'CAST(NULL AS INTEGER)' if c == 'nation' else i} AS depth, "
        f"sqrt(avg(power(target - coalesce(by_{c}, mean_target), 2))) AS rmse, count(*) / 1000.0 AS seconds, "
        f"avg(abs(target - coalesce(by_{c}, mean_target))) AS mae, "
        f"1 - avg(power(target - coalesce(by_{c}, mean_target), 2)) / var_pop(target) AS r2 "
        f"FROM split_rows LEFT JOIN m_{c} USING ({c}) CROSS JOIN overall WHERE split = 'validation'"
        for i, c in enumerate(CATEGORICAL, start=1)
    )
    + ")"
)

RUN_INFO = """
SELECT 'orders' AS spark_version, 'local[' || count(DISTINCT o_orderstatus) || ']' AS spark_master,
  round(min(o_totalprice), 2) AS preprocessing_fit_time_s, round(max(o_totalprice), 2) AS final_train_time_s,
  round(max(o_totalprice) - min(o_totalprice), 2) AS pipeline_time_s,
  count(DISTINCT o_orderpriority) AS best_num_trees, count(DISTINCT o_orderstatus) AS best_max_depth"""


FINAL_METRICS = ", ".join(
    f"(SELECT round({m.lower()}, 4) FROM metrics WHERE model = 'priority' AND split = '{s}') AS \"{s}_{m}\""
    for s in ("train", "validation", "test")
    for m in ("MAE", "RMSE", "R2")
)
MODE = "'Local mode: local[' || count(DISTINCT o_orderstatus) || ']' AS mode, 'N/A (local mode)' AS executors"


def best_line(model: str, places: str, info: bool, names: str = "trees=,depth=", framework: str = "group means", mode: str = "table") -> str:
    best = f"(SELECT * FROM search WHERE place IN {places} ORDER BY rmse, place LIMIT 1)"
    shown = dict(zip(names.split(","), ("trees", "coalesce(CAST(depth AS VARCHAR), 'None')", "place")))
    text = " || ', ' || ".join(f"'{n}' || {v}" for n, v in shown.items())
    seconds = "final_train_time_s" if info else "CAST(round(seconds, 4) AS DOUBLE)"
    run = "pipeline_time_s" if info else "CAST(NULL AS DOUBLE)"
    mode = "spark_master" if info else f"'{mode}'"
    return f"""SELECT '{model}' AS model, '{framework}' AS framework, {text} AS best_configuration,
  (SELECT count(*) FROM search WHERE place IN {places}) AS tuning_configurations, round(rmse, 4) AS best_validation_rmse,
  {seconds} AS best_train_time_s, {run} AS pipeline_time_s, {mode} AS execution_mode
FROM {best} AS b, info"""


# Alphabetical levels without an unknown slot, and levels by frequency with one.
IGNORE_LEVELS = union(
    f"SELECT {i} AS part, level, row_number() OVER (ORDER BY level) AS place, '{c}' AS origin "
    f"FROM (SELECT DISTINCT {c} AS level FROM split_rows WHERE split = 'train')"
    for i, c in enumerate(CATEGORICAL)
)
KEEP_LEVELS = union(
    f"SELECT {i} AS part, level, place, '{c}' AS origin FROM ("
    f"SELECT {c} AS level, row_number() OVER (ORDER BY count(*) DESC, {c}) AS place "
    f"FROM split_rows WHERE split = 'train' GROUP BY {c} UNION ALL SELECT '__unknown', 1000000)"
    for i, c in enumerate(CATEGORICAL)
)


def encoded(levels: str) -> str:
    value = "CASE origin " + " ".join(f"WHEN '{c}' THEN {c}" for c in CATEGORICAL) + " END"
    return f"""WITH {SPLIT}, levels AS ({levels})
SELECT record_id, string_agg(CASE WHEN {value} = level THEN '1' ELSE '0' END, '' ORDER BY levels.part, levels.place) AS encoded
FROM split_rows CROSS JOIN levels GROUP BY record_id"""


def names(encoder: str, levels: str, numeric: str, joint: str) -> str:
    fixed = union(f"SELECT -1 AS part, {i} AS place, '{numeric}{c}' AS name" for i, c in enumerate(NUMERIC))
    return (
        f"SELECT '{encoder}' AS encoder, row_number() OVER (ORDER BY part, place) - 1 AS position, name FROM ("
        f"{fixed} UNION ALL SELECT part, place, {joint} FROM ({levels}) AS l) AS n"
    )


def vector_columns() -> str:
    """The twelve entries of the fully scaled two-by-two vector."""
    cells = ["totalprice", "acctbal"]
    for c in ("status", "priority"):
        n = 3 if c == "status" else 5
        for k in range(1, n + 1):
            cells.append(f"CASE WHEN {c} = (SELECT level FROM l_{c} WHERE place = {k}) THEN 1.0 ELSE 0.0 END")
        cells.append("0.0")
    plain = ", ".join(f"CAST({e} AS DOUBLE) AS e{i}" for i, e in enumerate(cells))
    stats = ", ".join(f"avg(e{i}) AS m{i}, stddev_samp(e{i}) AS s{i}" for i in range(len(cells)))
    scaled = ", ".join(
        f"round(CASE WHEN s{i} = 0 THEN 0.0 ELSE (e{i} - m{i}) / s{i} END, 6) AS v{i}" for i in range(len(cells))
    )
    levels = ", ".join(
        f"l_{c} AS (SELECT {c} AS level, row_number() OVER (ORDER BY count(*) DESC, {c}) AS place "
        f"FROM split_rows WHERE split = 'train' GROUP BY {c})"
        for c in ("status", "priority")
    )
    return f"""WITH {SPLIT}, {levels},
vectors AS (SELECT record_id, split, {plain} FROM split_rows),
stats AS (SELECT {stats} FROM vectors WHERE split = 'train')
SELECT record_id, {scaled} FROM vectors, stats"""


SCALED = ", ".join(f"round(({c} - avg_{c}) / dev_{c}, 6) AS {c}" for c in NUMERIC)
SCALES = ", ".join(f"avg({c}) AS avg_{c}, stddev_pop({c}) AS dev_{c}" for c in NUMERIC)
LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
MISSING_TOTAL = " + ".join(f"count(*) - count({c})" for c in LINE_COLUMNS)
PROFILE_COLUMNS = ("record_id", *NUMERIC, *CATEGORICAL, "target")

COMPARED = (
    PREDICTORS
    + """,
compared AS (
  SELECT record_id, actual AS actual_target, by_priority AS prediction_priority, by_segment AS prediction_segment,
         actual - by_priority AS error_priority, abs(actual - by_priority) AS absolute_error_priority,
         actual - by_segment AS error_segment, abs(actual - by_segment) AS absolute_error_segment,
         by_segment - by_priority AS prediction_difference
  FROM both_predicted WHERE split = 'test')"""
)


def delta(metric: str, better: str) -> str:
    b, c = f"b.{metric.lower()}", f"c.{metric.lower()}"
    digits, shown = (6, 6) if metric == "R2" else (4, 3)
    return f"""SELECT '{metric}' AS metric, round({b}, {digits}) AS baseline, round({c}, {digits}) AS candidate,
  round({c} - {b}, {digits}) AS difference,
  round(abs({c} - {b}) / {b} * 100, 2) AS percent,
  CASE WHEN {c} {better} {b} THEN 'better' ELSE 'worse' END AS verdict,
  printf('%+.{shown}f', round({c} - {b}, {shown})) AS difference_text
FROM metrics AS b, metrics AS c
WHERE b.model = 'priority' AND c.model = 'segment' AND b.split = 'test' AND c.split = 'test'"""


ORACLE: dict[str, str] = {
    "zero_rate_by_category": f"WITH {PROFILE} {zero_rate('order_profile', 'priority')}",
    "zero_rate_by_bin": f"WITH {PROFILE}, binned AS (SELECT {BIN} AS bin, target FROM order_profile) "
    + zero_rate("(SELECT * FROM binned WHERE bin IS NOT NULL) AS t", "bin"),
    "zero_share": f"WITH {PROFILE} {zero_rate('order_profile')}",
    "null_profile": union(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing, {MISSING_TOTAL} AS total_missing, "
        f"count(*) - count({c}) > 0 AS warn FROM lineitem"
        for c in LINE_COLUMNS
    ),
    "schema_profile": f"WITH {PROFILE} "
    + union(
        f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS \"column\", "
        f"lower(replace(any_value(typeof({c})), 'VARCHAR', 'STRING')) AS type, count(*) AS n_rows, "
        f"CAST({len(PROFILE_COLUMNS)} AS BIGINT) AS n_columns FROM order_profile"
        for i, c in enumerate(PROFILE_COLUMNS, start=1)
    ),
    "preview": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 10",
    "duplicate_rows": "SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_duplicates "
    f"FROM (SELECT count(*) AS n FROM lineitem GROUP BY {', '.join(LINE_COLUMNS)})",
    "describe_numeric": union(describe("lineitem", c) for c in LINE_NUMERICS),
    "quantiles_by_counting": union(
        f"SELECT '{c}' AS \"column\", CAST({p} AS DOUBLE) AS prob, round(quantile_cont({c}, {p}), 4) AS value FROM {t}"
        for t, cs in (("lineitem", LINE_NUMERICS), ("events", ("value",)))
        for c in cs
        for p in (0.25, 0.5, 0.75)
    ),
    "describe_by_zero": f"WITH {PROFILE}, flagged AS (SELECT *, CASE WHEN target = 0 THEN 'zero' WHEN target > 0 THEN 'positive' END AS subset FROM order_profile) "
    + union(
        describe("(SELECT * FROM flagged WHERE subset IS NOT NULL) AS f", c, "subset,", "GROUP BY subset")
        for c in ("n_lines", "qty", "totalprice")
    ),
    "cardinality": union(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM part" for c in ("p_brand", "p_type", "p_name")
    ),
    "value_counts_top": union(top_values(c) for c in ("p_brand", "p_type", "p_name")),
    "rule_violations": union(
        f"SELECT '{n}' AS rule, CAST(count(*) FILTER (WHERE {c}) AS BIGINT) AS n FROM lineitem"
        for n, c in {
            "l_quantity < 0": "l_quantity < 0",
            "l_quantity <= 1": "l_quantity <= 1",
            "l_discount outside [0, 0.05]": "l_discount < 0 OR l_discount > CAST(0.05 AS DOUBLE)",
            "l_tax outside [0, 1]": "l_tax < 0 OR l_tax > 1",
            "l_extendedprice <= 0": "l_extendedprice <= 0",
            "l_extendedprice < 1000": "l_extendedprice < 1000",
        }.items()
    ),
    "dataset_summary": f"WITH {PROFILE} "
    + union(
        f"SELECT '{k}' AS key, CAST({e} AS VARCHAR) AS value FROM {t}"
        for k, e, t in (
            ("records", "count(*)", "order_profile"),
            ("columns", str(len(PROFILE_COLUMNS)), "(SELECT 1)"),
            ("missing_values", " + ".join(f"count(*) - count({c})" for c in PROFILE_COLUMNS), "order_profile"),
            ("duplicate_rows", "(SELECT count(*) FROM order_profile) - count(*)", "(SELECT DISTINCT * FROM order_profile)"),
            ("target", "'target'", "(SELECT 1)"),
            ("target_zero", "count(*) FILTER (WHERE target = 0)", "order_profile"),
            ("target_zero_rate", "printf('%.2f%%', avg(CASE WHEN target = 0 THEN 1.0 ELSE 0.0 END) * 100)", "order_profile"),
        )
    ),
    "iqr_outliers": union([*(iqr("lineitem", c) for c in LINE_NUMERICS), iqr("events", "value")]),
    "upper_outlier_describe": f"WITH f AS ({FENCES.format(c='value', t='events')}), high AS (SELECT events.*, upper FROM events, f WHERE value > upper) "
    + union(describe("high", c, "round(any_value(upper), 4) AS threshold,") for c in ("value", "user_id")),
    "upper_outlier_top": f"WITH f AS ({FENCES.format(c='value', t='events')}) SELECT event_id, event_type, value FROM events, f WHERE value > upper ORDER BY value DESC, event_id LIMIT 20",
    "target_by_category": f"WITH {SPLIT} " + union(category_targets(c) for c in CATEGORICAL),
    "correlation_with_target": f"WITH {SPLIT}, c AS ({correlations('(SELECT * FROM split_rows WHERE split = ' + chr(39) + 'train' + chr(39) + ') AS t')}) "
    "SELECT feature, round(r, 6) AS correlation, row_number() OVER (ORDER BY abs(r) DESC, feature) AS place_by_strength FROM c",
    "correlation_ascending": f"WITH {PROFILE}, c AS ({correlations('order_profile')}) "
    "SELECT feature, round(r, 6) AS correlation, row_number() OVER (ORDER BY r, feature) AS place_by_value FROM c",
    "stratified_split": f"WITH {SPLIT} SELECT record_id, split FROM split_rows",
    "split_zero_ratio": f"WITH {SPLIT}, rates AS ({zero_rate('split_rows', 'split')}) "
    f"SELECT CAST({SPLIT_PLACE} AS BIGINT) AS place, * FROM rates",
    "seeded_sample": "SELECT event_id, value FROM events ORDER BY md5('42|' || CAST(event_id AS VARCHAR)) LIMIT 3000",
    "equal_width_histogram": HISTOGRAM,
    "scatter_grid": GRID,
    "one_to_one_compare": f"WITH {COMPARED} SELECT record_id, "
    + ", ".join(
        f"round({c}, 6) AS {c}"
        for c in (
            "actual_target", "prediction_priority", "prediction_segment", "error_priority", "absolute_error_priority",
            "error_segment", "absolute_error_segment", "prediction_difference",
        )
    )
    + " FROM compared",
    "reconcile_predictions": f"WITH {PREDICTORS} " + union(reconcile(*s) for s in SUBSET_SPLITS),
    "actual_agreement": f"WITH {COMPARED} SELECT count(*) AS n_rows, count(*) FILTER (WHERE NOT "
    "abs(prediction_priority - prediction_segment) <= 1e-8 + 1e-5 * abs(prediction_segment)) AS n_disagree FROM compared",
    "positional_attach": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders",
    "regression_metrics": f'WITH {METRICS} SELECT model, split, n, round(mae, 4) AS "MAE", round(rmse, 4) AS "RMSE", round(r2, 6) AS "R2" FROM metrics',
    "comparison_metrics": f'WITH {METRICS} SELECT CAST({SPLIT_PLACE} AS BIGINT) AS place, split, model, round(mae, 4) AS "MAE", round(rmse, 4) AS "RMSE", round(r2, 6) AS "R2" FROM metrics',
    "generalisation_gap": f"WITH {METRICS} SELECT a.model, round(a.rmse, 4) AS train_rmse, round(b.rmse, 4) AS test_rmse, round(b.rmse - a.rmse, 4) AS gap "
    "FROM metrics AS a JOIN metrics AS b ON a.model = b.model AND a.split = 'train' AND b.split = 'test'",
    "metric_deltas": f"WITH {METRICS} " + union(delta(m, b) for m, b in (("MAE", "<"), ("RMSE", "<"), ("R2", ">"))),
    "prediction_difference": f"WITH {COMPARED} SELECT count(*) AS n, round(avg(prediction_difference), 4) AS mean_difference, "
    "round(avg(abs(prediction_difference)), 4) AS mean_absolute_difference, bool_and(actual_target IS NOT NULL) AS all_actual_present FROM compared",
    "prediction_bounds": f"WITH {COMPARED} SELECT least(min(actual_target), min(prediction_priority), min(prediction_segment)) AS low, "
    "greatest(max(actual_target), max(prediction_priority), max(prediction_segment)) AS high FROM compared",
    "best_config": f"WITH {MEAN_SEARCH}, info AS ({RUN_INFO} FROM orders) "
    + union(f"SELECT * FROM ({best_line(*a)}) AS l{i}" for i, a in enumerate((("first", "(1, 2)", False), ("second", "(3, 4)", True)))),
    "configs_in_order": f'WITH {MEAN_SEARCH} SELECT CAST(place AS BIGINT) AS place, CAST(trees AS BIGINT) AS trees, round(rmse, 4) AS "RMSE" FROM search WHERE place IN (1, 2, 4)',
    "importance_rollup": f"WITH {IMPORTANCE} SELECT model, feature, round(v, 6) AS importance_encoded, round(v, 6) AS importance, place AS \"rank\" FROM ranked",
    "importance_expected_set": f"{ROLLED_ALL} SELECT DISTINCT model, 'p_mfgr' AS feature, 'missing' AS problem FROM rolled "
    "UNION ALL SELECT model, feature, 'extra' FROM everything WHERE feature NOT IN ('p_size', 'p_retailprice', 'p_brand', 'p_type', 'p_name', 'p_mfgr')",
    "importance_checks": f"{ROLLED_ALL}, t AS (SELECT model, CAST(round(sum(v), 6) AS DOUBLE) AS total FROM rolled GROUP BY model) "
    "SELECT e.model, count(*) AS n_features, count(*) FILTER (WHERE NOT isfinite(coalesce(r.v, 0))) AS n_not_finite, "
    "count(*) FILTER (WHERE r.v < 0) AS n_negative, any_value(total) AS total, abs(any_value(total) - 1) <= 0.01001 AS total_is_one "
    "FROM everything AS e JOIN t ON e.model = t.model LEFT JOIN rolled AS r ON r.model = e.model AND r.feature = e.feature GROUP BY e.model",
    "importance_by_model": f"WITH {IMPORTANCE} SELECT feature, "
    "coalesce(max(CASE WHEN model = 'ignore' THEN round(v, 6) END), 0) AS \"ignore\", "
    "coalesce(max(CASE WHEN model = 'keep' THEN round(v, 6) END), 0) AS keep, "
    "round(max(v), 6) AS strongest FROM ranked GROUP BY feature",
    "importance_totals": f"WITH {IMPORTANCE} SELECT model, round(sum(v), 6) AS total FROM ranked GROUP BY model",
    "top_features_per_model": f"WITH {IMPORTANCE}, t AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY v DESC, feature) AS k FROM ranked) "
    "SELECT model, k AS place, feature, round(v, 6) AS importance FROM t WHERE k <= 5",
    "run_info_parse": f"WITH {METRICS} {RUN_INFO}, {MODE}, {FINAL_METRICS} FROM orders",
    "run_info_sink": f"WITH {METRICS} {RUN_INFO}, {MODE}, {FINAL_METRICS}, 'orders' AS app_name, "
    "count(DISTINCT o_orderpriority) AS default_parallelism, count(*) AS train_partitions, count(*) AS validation_partitions, "
    "count(*) AS test_partitions, CAST(42 AS BIGINT) AS seed FROM orders",
    "csv_roundtrip": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "csv_missing_tokens": "SELECT p_partkey, CASE WHEN p_size BETWEEN 5 AND 40 THEN CAST(p_size AS DOUBLE) END AS p_size, "
    "CASE WHEN p_type NOT IN ('ECONOMY', 'PROMO') THEN p_type END AS p_type FROM part",
    "coerced_cast": "SELECT count(TRY_CAST(substr(p_brand, 7) AS DOUBLE)) AS brand_numbers, sum(TRY_CAST(substr(p_brand, 7) AS DOUBLE)) AS brand_sum, "
    "count(TRY_CAST(p_type AS DOUBLE)) AS type_numbers FROM part",
    "scaled_numeric": f"WITH {SPLIT}, stats AS (SELECT {SCALES} FROM split_rows WHERE split = 'train') SELECT record_id, {SCALED} FROM split_rows, stats",
    "onehot_ignore": encoded(IGNORE_LEVELS),
    "onehot_keep": encoded(KEEP_LEVELS),
    "encoded_feature_names": f"WITH {SPLIT} "
    + union(
        (
            names("ignore", IGNORE_LEVELS, "num__", "'cat__' || origin || '_' || level"),
            names("keep", KEEP_LEVELS, "", "origin || '_indexed_encoded_' || level"),
        )
    ),
    "full_vector_scaled": vector_columns(),
    "feature_matrix_check": f"WITH {SPLIT}, width AS (SELECT {len(NUMERIC)} + "
    + " + ".join(f"count(DISTINCT {c}) + 1" for c in CATEGORICAL)
    + " AS w FROM split_rows WHERE split = 'train') "
    f"SELECT split, count(*) AS n_rows, any_value(w) AS n_features, {bad_entries()} FROM split_rows, width GROUP BY split",
    "forest_prediction_records": f"WITH {SPLIT} SELECT record_id, target AS actual_target, true AS predicted FROM split_rows WHERE split = 'test'",
    "forest_reconciled": f"WITH {SPLIT}, source AS (SELECT record_id, target AS actual FROM split_rows WHERE split = 'test') "
    + reconciled("source", "source"),
    "feature_model_roundtrip": f"WITH {SPLIT}, stored AS (SELECT * FROM split_rows) SELECT count(*) AS n_rows, "
    "count(*) FILTER (WHERE a.qty IS DISTINCT FROM b.qty OR a.status IS DISTINCT FROM b.status) AS n_disagree, count(*) > 0 AS was_stored "
    "FROM split_rows AS a JOIN stored AS b ON a.record_id = b.record_id",
    "loaded_encoder_vectors": encoded(KEEP_LEVELS),
    "level_dictionary": union(
        f"SELECT '{c}' AS \"column\", level, n, row_number() OVER (ORDER BY n DESC, level) - 1 AS place FROM "
        f"(SELECT {c} AS level, count(*) AS n FROM part WHERE {c} IS NOT NULL GROUP BY {c})"
        for c in ("p_name", "p_brand", "p_type")
    ),
    "forest_checks": f"WITH {SPLIT}, width AS (SELECT {len(NUMERIC)} + "
    + " + ".join(f"count(DISTINCT {c}) + 1" for c in CATEGORICAL)
    + " AS w FROM split_rows WHERE split = 'train') "
    + union(
        (
            "SELECT split || ' rows' AS \"check\", count(*) AS value FROM split_rows GROUP BY split",
            "SELECT 'encoded features', w FROM width",
            f"SELECT 'features', {len(NUMERIC) + len(CATEGORICAL)}",
            "SELECT 'importances in thousandths', 1000",
            *(f"SELECT '{c}', 0" for c in ("RMSE below MAE", "no better than the mean", "predictions outside the training targets", "negative importances")),
        )
    ),
    "forest_search_checks": union(
        f"SELECT CAST({i} AS BIGINT) AS place, CAST({t} AS INTEGER) AS trees, CAST({d} AS INTEGER) AS depth, CAST(1 AS INTEGER) AS min_leaf, "
        "true AS errors_in_order, true AS better_than_the_mean, true AS best_is_chosen"
        for i, (t, d) in enumerate(((50, 8), (100, 8), (100, 12), (200, 12)), start=1)
    ),
    "null_profile_damaged": "WITH bad AS (SELECT * REPLACE (CASE WHEN l_orderkey % 97 <> 1 THEN l_quantity END AS l_quantity, "
    f"CASE WHEN l_orderkey % 97 <> 2 THEN l_tax END AS l_tax) FROM lineitem) "
    + union(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing, {MISSING_TOTAL} AS total_missing, "
        f"count(*) - count({c}) > 0 AS warn FROM bad"
        for c in LINE_COLUMNS
    ),
    "reconcile_damaged": f"WITH {PREDICTORS}, source AS (SELECT record_id, actual FROM predicted WHERE model = 'segment' AND split = 'test'), "
    "bad AS (SELECT CASE WHEN record_id % 97 <> 1 THEN record_id END AS record_id, actual + CASE WHEN record_id % 97 = 7 THEN 1 ELSE 0 END AS actual "
    "FROM predicted, (SELECT range AS copy FROM range(2)) WHERE model = 'priority' AND split = 'test' AND record_id % 97 <> 6 AND (copy = 0 OR record_id % 97 = 5)) "
    + reconciled("bad", "source"),
    "feature_matrix_damaged": f"WITH {SPLIT}, bad AS (SELECT * REPLACE (CASE record_id % 97 WHEN 1 THEN CAST('nan' AS DOUBLE) ELSE qty END AS qty, "
    "CASE record_id % 97 WHEN 2 THEN CAST('nan' AS DOUBLE) ELSE totalprice END AS totalprice, "
    "CASE record_id % 97 WHEN 3 THEN CAST('inf' AS DOUBLE) WHEN 4 THEN CAST('-inf' AS DOUBLE) ELSE acctbal END AS acctbal) FROM split_rows), "
    f"width AS (SELECT {len(NUMERIC)} + "
    + " + ".join(f"count(DISTINCT {c}) + 1" for c in CATEGORICAL)
    + " AS w FROM split_rows WHERE split = 'train') "
    f"SELECT split, count(*) AS n_rows, any_value(w) AS n_features, {bad_entries()} FROM bad, width GROUP BY split",
    "importance_checks_damaged": "WITH b AS (SELECT DISTINCT p_brand FROM part), v AS (SELECT substr(p_brand, 1, 7) AS model, "
    "CASE right(p_brand, 1) WHEN '1' THEN 0.0 WHEN '2' THEN -0.5 WHEN '3' THEN CAST('inf' AS DOUBLE) ELSE 0.25 END AS v FROM b) "
    "SELECT model, count(*) AS n_features, count(*) FILTER (WHERE NOT isfinite(v)) AS n_not_finite, count(*) FILTER (WHERE v < 0) AS n_negative, "
    "abs(sum(v) - 1) <= 0.01001 AS total_is_one FROM v GROUP BY model",
    "histogram_damaged": HISTOGRAM_DAMAGED,
    "foreign_summary": f"WITH {MEAN_SEARCH}, info AS ({RUN_INFO} FROM orders) "
    + union(
        f"SELECT * FROM ({best_line(*a)}) AS l{i}"
        for i, a in enumerate(
            (
                ("single", "(2, 4)", False, "n_estimators=,max_depth=,min_samples_leaf=", "scikit-learn", "one machine"),
                ("spread", "(1, 3)", True, "numTrees=,maxDepth=", "PySpark Spark MLlib", "cluster"),
            )
        )
    ),
    "foreign_search_rows": f"WITH {MEAN_SEARCH} SELECT CASE WHEN place % 2 = 0 THEN 'single' ELSE 'spread' END AS model, trees, depth, "
    'round(mae, 4) AS "validation_MAE", round(rmse, 4) AS "validation_RMSE", round(r2, 4) AS "validation_R2", '
    "CAST(round(seconds, 4) AS DOUBLE) AS fit_seconds, CAST(NULL AS DOUBLE) AS predict_seconds FROM search",
    "foreign_comparison": f'WITH {METRICS} SELECT CAST({SPLIT_PLACE} AS BIGINT) AS place, split, model, round(mae, 4) AS "MAE", round(rmse, 4) AS "RMSE", round(r2, 6) AS "R2" FROM metrics',
    "foreign_importances": f"WITH {IMPORTANCE} SELECT model, feature, round(v, 6) AS importance_encoded, round(v, 6) AS importance, place AS \"rank\" FROM ranked",
}

"""Rule-driven quality checks as aggregate expressions.

A dataset is checked in one aggregate pass without a shuffle of its rows, plus one pass over the
merge keys when the rule has some. Everything up to the audit row stays a DataFrame, so the runs
of all datasets are one query. ``by`` evaluates a rule per group (for instance per day) in the
same two passes.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.functions.time import as_of_column, utc_date
from candlewick.operators.quality_rules import Rule
from candlewick.schemas import TABLES


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def _text(value: str | None) -> str:
    """A SQL string literal."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _texts(values: Sequence[str]) -> str:
    return f"CAST(array({', '.join(_text(v) for v in values)}) AS array<string>)"


def metrics(df: DataFrame, rule: Rule, by: Sequence[str] = ()) -> DataFrame:
    """Row count, null counts, value range and newest timestamp of one dataset, per ``by`` group."""
    parts = ["count(1) AS row_count"]
    parts += [f"count_if(`{c}` IS NULL) AS null__{c}" for c in rule.null_ratios if c in df.columns]
    for column in rule.bounded:
        if column in df.columns:
            # Bronze prices are text; compared as text, "9" would exceed "10".
            number = f"try_cast(`{column}` AS double)"
            parts += [f"min({number}) AS low__{column}", f"max({number}) AS high__{column}"]
    if rule.freshness and rule.freshness[0] in df.columns:
        parts.append(f"max(CAST(`{rule.freshness[0]}` AS timestamp)) AS newest")
    return df.groupBy(*by).agg(*[F.expr(p) for p in parts])


def duplicate_count(
    df: DataFrame, keys: Sequence[str], where: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Rows beyond the first of each key. Keys are pre-counted per task, so hot keys stay small."""
    rows = df.where(where) if where else df
    per_key = rows.groupBy(*dict.fromkeys([*by, *keys])).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.groupBy(*by).agg(F.expr("coalesce(sum(copies - 1), 0) AS duplicate_count"))


def measure(df: DataFrame, rule: Rule, by: Sequence[str] = ()) -> DataFrame:
    """What a rule observes on a dataset, with the rule's limits beside it; one row per ``by`` group.

    The columns are the same for every rule, so measurements of all datasets can be stacked.
    """
    found = metrics(df, rule, by)
    if rule.keys and not missing_columns(df, rule.keys):
        counted = duplicate_count(df, rule.keys, rule.duplicates_where, by)
        # Both sides hold one row per group: stack them and fold, instead of a join.
        both = found.unionByName(counted, allowMissingColumns=True)
        found = both.groupBy(*by).agg(*[F.max(c).alias(c) for c in both.columns if c not in by])
    return _beside_limits(found, rule, set(df.columns), by)


def partial_measures(df: DataFrame, rule: Rule, moment: str | None) -> DataFrame:
    """What a rule observes on each UTC date of ``moment`` (one null date without it), in rows that fold over dates.

    ``measured_date``, ``measure``, ``total``, ``low``, ``high``, ``newest``: totals add up, ranges and times widen. Key
    counts add up over dates where the key tells the date; where it does not, ``date_keys`` give the residual.
    """
    day = utc_date(moment) if moment else F.lit(None).cast("date")
    dated, by = df.withColumn("_date", day), ("_date",)
    found = metrics(dated, rule, by)
    if rule.keys and not missing_columns(df, rule.keys):
        rows = dated.where(rule.duplicates_where) if rule.duplicates_where else dated
        copies = rows.groupBy("_date", *rule.keys).agg(F.count(F.lit(1)).alias("copies"))
        counted = copies.groupBy("_date").agg(F.sum("copies").alias("key_rows"), F.count(F.lit(1)).alias("key_groups"))
        both = found.unionByName(counted, allowMissingColumns=True)
        found = both.groupBy("_date").agg(*[F.max(c).alias(c) for c in both.columns if c != "_date"])
    return found.selectExpr("_date AS measured_date", f"inline({_stacked(found.columns, rule)})").where(
        "total IS NOT NULL OR low IS NOT NULL OR high IS NOT NULL"
    )


def _stacked(columns: Sequence[str], rule: Rule) -> str:
    """SQL of an array with one struct for each measure of a date."""
    rows = [("rows", "row_count", "NULL", "NULL", "newest" if "newest" in columns else "NULL")]
    rows += [(c, f"`{c}`", "NULL", "NULL", "NULL") for c in columns if c.startswith("null__") or c in ("key_rows", "key_groups")]
    rows += [(f"range__{c}", "NULL", f"`low__{c}`", f"`high__{c}`", "NULL") for c in rule.bounded if f"low__{c}" in columns]
    structs = [
        f"named_struct('measure', {_text(name)}, 'total', CAST({total} AS bigint), 'low', CAST({low} AS double), "
        f"'high', CAST({high} AS double), 'newest', CAST({newest} AS timestamp))"
        for name, total, low, high, newest in rows
    ]
    return f"array({', '.join(structs)})"


def date_keys(df: DataFrame, rule: Rule, moment: str | None) -> DataFrame:
    """The distinct keys of each date as ``one`` and ``two``, 128 bits that stand for a key."""
    rows = df.where(rule.duplicates_where) if rule.duplicates_where else df
    # Hashes pass over nulls, so a null is told apart by its flag.
    parts = [p for c in rule.keys for p in (F.col(c).isNull(), F.col(c))]
    at = F.col(moment) if moment else F.lit(None).cast("timestamp")
    marks = rows.select(F.date_trunc("day", at).alias("measured_at"), F.xxhash64(*parts).alias("one"), F.xxhash64(F.lit(1), *parts).alias("two"))
    return marks.distinct()


def fold_measures(parts: DataFrame, rule: Rule, keys: DataFrame | None = None) -> DataFrame:
    """``measure`` of the whole dataset from its dates' measures; ``keys`` holds the dates' keys where these may recur."""
    table = TABLES[rule.table]
    total = lambda name: f"sum(total) FILTER (WHERE measure = '{name}')"
    exprs = [f"coalesce({total('rows')}, 0L) AS row_count", "max(newest) AS newest", f"{total('key_rows')} AS key_rows", f"{total('key_groups')} AS key_groups"]
    exprs += [f"coalesce({total(f'null__{c}')}, 0L) AS null__{c}" for c in rule.null_ratios if c in table.columns]
    for c in (c for c in rule.bounded if c in table.columns):
        exprs += [f"{f}({end}) FILTER (WHERE measure = 'range__{c}') AS {end}__{c}" for f, end in (("min", "low"), ("max", "high"))]
    found = parts.agg(*[F.expr(e) for e in exprs])
    if keys is not None:
        distinct = keys.select("one", "two").distinct().agg(F.count(F.lit(1)).alias("key_groups"))
        both = found.drop("key_groups").unionByName(distinct, allowMissingColumns=True)
        found = both.agg(*[F.max(c).alias(c) for c in both.columns])
    found = found.withColumn("duplicate_count", F.col("key_rows") - F.col("key_groups"))
    return _beside_limits(found, rule, set(table.columns))


def _beside_limits(
    found: DataFrame, rule: Rule, present: set[str], by: Sequence[str] = (), error: str | None = None
) -> DataFrame:
    absent = "column is missing"
    nulls, bounds = [], []
    for column, limit in rule.null_ratios.items() if error is None else ():
        known = column in present
        count, fault = (f"null__{column}", None) if known else ("CAST(NULL AS bigint)", absent)
        nulls.append(
            f"named_struct('column', {_text(column)}, 'nulls', {count}, 'limit', {float(limit)}D, 'error', {_text(fault)})"
        )
    for column in rule.bounded if error is None else ():
        known = column in present
        low, high = (f"low__{column}", f"high__{column}") if known else ("CAST(NULL AS double)",) * 2
        least, most = (
            "CAST(NULL AS double)" if limit is None else f"{float(limit)}D"
            for limit in (rule.minimum.get(column), rule.maximum.get(column))
        )
        bounds.append(
            f"named_struct('column', {_text(column)}, 'low', {low}, 'high', {high}, 'min', {least}, 'max', {most}, "
            f"'error', {_text(None if known else absent)})"
        )
    keys = rule.keys if error is None else ()
    lacking = [k for k in keys if k not in present]
    counted = keys and not lacking
    aged, limit = rule.freshness if rule.freshness and error is None else (None, 0)
    newest = "newest" if aged in present else "CAST(NULL AS timestamp)"
    missing = sorted(set(rule.required) - present) if error is None else []
    return found.selectExpr(
        *[f"`{c}`" for c in by],
        f"{_text(rule.dataset)} AS dataset_name",
        f"{_text(TABLES[rule.table].layer)} AS layer",
        f"{_text(error)} AS read_error",
        "row_count",
        f"CAST({rule.min_rows} AS bigint) AS min_row_count",
        f"{_texts(rule.required)} AS required_columns",
        f"{_texts(missing)} AS missing_columns",
        f"CAST(array({', '.join(nulls)}) AS {_NULLS}) AS nulls",
        f"{_texts(keys)} AS key_columns",
        f"{_text('missing key columns: ' + ', '.join(lacking) if lacking else None)} AS key_error",
        f"{'coalesce(duplicate_count, 0L)' if counted else 'CAST(NULL AS bigint)'} AS duplicate_count",
        f"CAST({rule.max_duplicates} AS bigint) AS max_duplicate_count",
        f"{_text(aged)} AS aged_column",
        f"{newest} AS newest",
        f"{int(limit)} AS max_age_seconds",
        f"{_text(absent if aged and aged not in present else None)} AS age_error",
        f"CAST(array({', '.join(bounds)}) AS {_BOUNDS}) AS bounds",
    )


_NULLS = "array<struct<column:string,nulls:bigint,limit:double,error:string>>"
_BOUNDS = "array<struct<column:string,low:double,high:double,min:double,max:double,error:string>>"

# Per-check results as SQL over the measured columns.
_JUDGED = {
    "nulls": """transform(nulls, n -> named_struct('column', n.column, 'limit', n.limit, 'error', n.error,
        'ratio', CASE WHEN n.error IS NULL THEN if(row_count > 0, n.nulls / row_count, 0D) END,
        'passed', n.error IS NULL AND if(row_count > 0, n.nulls / row_count, 0D) <= n.limit))""",
    "bounds": """transform(bounds, b -> named_struct('column', b.column, 'low', b.low, 'high', b.high, 'min', b.min,
        'max', b.max, 'error', b.error,
        'passed', b.low IS NOT NULL AND coalesce(b.low >= b.min, true) AND coalesce(b.high <= b.max, true)))""",
    "age_error": """coalesce(age_error,
        CASE WHEN aged_column IS NOT NULL AND newest IS NULL THEN 'no timestamp values available' END)""",
    "age_seconds": """CASE WHEN newest IS NOT NULL
        THEN greatest((unix_micros(_as_of) - unix_micros(newest)) / 1000000D, 0D) END""",
    "schema_passed": "size(missing_columns) = 0",
    "duplicate_check_passed": "key_error IS NULL AND coalesce(duplicate_count <= max_duplicate_count, true)",
}
_FLAGS = {
    "null_checks_passed": "forall(nulls, n -> n.passed)",
    "freshness_check_passed": "aged_column IS NULL OR coalesce(age_seconds <= max_age_seconds, false)",
    "bounds_check_passed": "forall(bounds, b -> b.passed)",
}

# Wording, order and number formats of the violations.
_VIOLATIONS = """array_compact(flatten(array(
    array(concat(_name, 'unable to read dataset: ', read_error)),
    array(CASE WHEN row_count < min_row_count
        THEN format_string('%srow_count %d is below minimum %d', _name, row_count, min_row_count) END),
    array(CASE WHEN NOT schema_passed
        THEN concat(_name, 'missing required columns: ', array_join(missing_columns, ', ')) END),
    transform(nulls, n -> CASE
        WHEN n.error IS NOT NULL THEN concat(_name, 'null check for ', n.column, ' failed: ', n.error)
        WHEN NOT n.passed
        THEN format_string('%snull ratio for %s %.6f exceeds max %.6f', _name, n.column, n.ratio, n.limit) END),
    array(CASE
        WHEN key_error IS NOT NULL THEN concat(_name, 'duplicate check failed: ', key_error)
        WHEN NOT duplicate_check_passed
        THEN format_string('%sduplicate_count %d exceeds max %d for keys [%s]', _name, duplicate_count,
            max_duplicate_count, array_join(key_columns, ', ')) END),
    array(CASE
        WHEN age_error IS NOT NULL THEN concat(_name, 'freshness check failed: ', age_error)
        WHEN NOT freshness_check_passed
        THEN format_string('%sfreshness age %.2fs exceeds max %ds for column %s', _name, age_seconds,
            max_age_seconds, aged_column) END),
    flatten(transform(bounds, b -> array(
        CASE WHEN b.error IS NOT NULL THEN concat(_name, 'bounds check for ', b.column, ' failed: ', b.error) END,
        CASE WHEN b.low < b.min
        THEN format_string('%sobserved minimum for %s %.8f is below allowed %.8f', _name, b.column, b.low, b.min) END,
        CASE WHEN b.high > b.max
        THEN format_string('%sobserved maximum for %s %.8f exceeds allowed %.8f', _name, b.column, b.high, b.max) END,
        CASE WHEN b.error IS NULL AND b.low IS NULL
        THEN concat(_name, 'bounds check for ', b.column, ' has no comparable values') END)))
)))"""

# Keys in alphabetical order, absent checks null.
_SUMMARY = """to_json(named_struct(
    'bounds_check', named_struct(
        'metrics', map_from_entries(transform(bounds, b -> struct(b.column, named_struct('error', b.error, 'max', b.max,
            'min', b.min, 'observed_max', b.high, 'observed_min', b.low, 'passed', b.passed)))),
        'passed', bounds_check_passed),
    'duplicate_check', CASE WHEN size(key_columns) > 0 THEN named_struct('duplicate_count', duplicate_count,
        'error', key_error, 'key_columns', key_columns, 'max_duplicate_count', max_duplicate_count,
        'passed', duplicate_check_passed) END,
    'freshness_check', CASE WHEN aged_column IS NOT NULL THEN named_struct('age_seconds', age_seconds,
        'column', aged_column, 'error', age_error, 'max_age_seconds', max_age_seconds,
        'passed', freshness_check_passed) END,
    'null_checks', named_struct(
        'metrics', map_from_entries(transform(nulls, n -> struct(n.column, named_struct('error', n.error,
            'max_null_ratio', n.limit, 'null_ratio', n.ratio, 'passed', n.passed)))),
        'passed', null_checks_passed),
    'schema', named_struct('missing_columns', missing_columns, 'passed', schema_passed,
        'required_columns', required_columns)), map('ignoreNullFields', 'false'))"""


def judge(
    measured: DataFrame, as_of: datetime | Column | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Verdict per measured row: violations in a fixed order, a flag per check and the JSON summary."""
    rows = measured.withColumn("_as_of", as_of_column(as_of))
    rows = rows.withColumns({name: F.expr(sql) for name, sql in _JUDGED.items()})
    rows = rows.withColumns({name: F.expr(sql) for name, sql in _FLAGS.items()})
    rows = rows.withColumn("_name", F.expr("concat('[', dataset_name, '] ')"))
    rows = rows.withColumns({"violations": F.expr(_VIOLATIONS), "summary_json": F.expr(_SUMMARY)})
    return rows.selectExpr(
        *[f"`{c}`" for c in by],
        "dataset_name", "layer", "size(violations) = 0 AS passed", "row_count", "min_row_count", "violations",
        "schema_passed", "null_checks_passed", "duplicate_check_passed", "freshness_check_passed",
        "bounds_check_passed", "summary_json",
    )


def check_dataset(
    df: DataFrame, rule: Rule, as_of: datetime | Column | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """The verdict of one rule over one dataset: one row, or one per ``by`` group."""
    return judge(measure(df, rule, by), as_of, by)


def unreadable_dataset(spark: SparkSession, rule: Rule, error: str) -> DataFrame:
    """The measurement of a dataset that cannot be opened: it becomes a violation, not a crash."""
    return _beside_limits(spark.range(1).selectExpr("0L AS row_count"), rule, set(), error=error)


def check_datasets(
    spark: SparkSession,
    datasets: dict[str, DataFrame | Exception],
    rules: Sequence[Rule],
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """All verdicts of a run as one DataFrame. A dataset that failed to open is given by its error."""
    found = {rule.dataset: datasets[rule.dataset] for rule in rules if rule.dataset in datasets}
    measured = {r.dataset: measure(df, r) if isinstance(df := found[r.dataset], DataFrame) else df for r in rules if r.dataset in found}
    return judge_datasets(spark, measured, rules, as_of)


def judge_datasets(
    spark: SparkSession,
    measured: dict[str, DataFrame | Exception],
    rules: Sequence[Rule],
    as_of: datetime | Column | None = None,
) -> DataFrame:
    """The verdicts over measurements, or over errors in their place, in the order of the rules."""
    rows = []
    for rule in rules:
        found = measured.get(rule.dataset, LookupError("dataset not found"))
        rows.append(found if isinstance(found, DataFrame) else unreadable_dataset(spark, rule, str(found)))
    return judge(reduce(DataFrame.union, rows), as_of)


def audit_rows(
    verdicts: DataFrame,
    audit_run_id: str | Column,
    checked_at: datetime | Column | None = None,
    environment: str = "dev",
    job_name: str | None = None,
    task_name: str | None = None,
    locations: dict[str, tuple[str, str | None]] | None = None,
) -> DataFrame:
    """Verdicts as ``audit.quality_check_runs`` rows. ``locations``: dataset -> (table name, path)."""
    # Without a given location, the name after the layer prefix.
    table_name = F.col("dataset_name").substr(F.length("layer") + 2, F.length("dataset_name"))
    path = F.lit(None).cast("string")
    for dataset, (table, stored_at) in (locations or {}).items():
        here = F.col("dataset_name") == dataset
        table_name = F.when(here, F.lit(table)).otherwise(table_name)
        path = F.when(here, F.lit(stored_at)).otherwise(path)
    run_id = audit_run_id if isinstance(audit_run_id, Column) else F.lit(audit_run_id)
    # One JSON string per violation, joined the way the stored text separates them.
    quoted = F.transform("violations", lambda v: F.regexp_replace(F.to_json(F.array(v)), r"^\[|\]$", ""))
    rows = verdicts.withColumns(
        {
            "audit_run_id": run_id,
            "checked_at": as_of_column(checked_at),
            "environment": F.lit(environment),
            "job_name": F.lit(job_name).cast("string"),
            "task_name": F.lit(task_name).cast("string"),
            "table_name": table_name,
            "storage_path": path,
            "violation_count": F.size("violations"),
            "violations_json": F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")),
        }
    )
    return TABLES["audit.quality_check_runs"].conform(rows)

"""A quality run over the stored tables, its audit trail and the gate."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.time import utc_date
from candlewick.operators.quality import audit_rows, check_datasets, date_keys, fold_measures, judge_datasets, measure, partial_measures
from candlewick.operators.quality_rules import RULES, Rule
from candlewick.plans import ledger
from candlewick.schemas import TABLES
from candlewick.sinks.lake import Store
from candlewick.sinks.workspace import new_folder

AUDIT, MEASURES, KEYS = "audit.quality_check_runs", "audit.quality_measures", "audit.quality_keys"
PIPELINE = "quality_checks"


# A file that cannot be read reaches Python in either form.
READ_ERRORS = (PySparkException, Py4JJavaError)


class QualityError(RuntimeError):
    """A gated quality run found violations."""


def open_datasets(lake: Store, rules: Sequence[Rule] = RULES) -> dict[str, DataFrame | Exception]:
    found: dict[str, DataFrame | Exception] = {}
    for rule in rules:
        try:
            found[rule.dataset] = (
                lake.read(rule.table) if lake.exists(rule.table) else LookupError("dataset not found")
            )
        except PySparkException as error:
            found[rule.dataset] = error
    return found


def measurable_datasets(
    datasets: dict[str, DataFrame | Exception], rules: Sequence[Rule] = RULES
) -> dict[str, DataFrame | Exception]:
    """The datasets with those that fail while they are measured given by their error.

    Each is measured by itself, so this runs only after a run over all of them failed.
    """
    found = dict(datasets)
    for rule in rules:
        df = found.get(rule.dataset)
        if isinstance(df, DataFrame):
            try:
                measure(df, rule).write.format("noop").mode("overwrite").save()
            except READ_ERRORS as error:
                found[rule.dataset] = RuntimeError(_message(error))
    return found


def folded_measures(lake: Store, rules: Sequence[Rule] = RULES) -> dict[str, DataFrame | Exception]:
    """Every dataset's measurement from the stored measures of its dates, after those of changed dates were renewed.

    A table without dates is measured whole when it changed. What changed is told by the ledger, which is written last, so a
    run that dies midway renews the same dates again. Keys that may recur on several dates are kept as hashes by date: of
    these only the changed dates are rewritten, and only they are read in full for the count of distinct keys.
    """
    found: dict[str, DataFrame | Exception] = {}
    renewed: list[tuple[Rule, list[date], DataFrame, DataFrame | None]] = []
    batches = []
    for rule in rules:
        try:
            if not lake.exists(rule.table):
                raise LookupError("dataset not found")
            batch = ledger.arrivals(lake, rule.table, PIPELINE)
            batches.append(batch)
            if batch.changed:
                renewed.append(_renewed(lake, rule, batch.dates()))
        except (*READ_ERRORS, LookupError) as error:
            found[rule.dataset] = RuntimeError(_message(error)) if not isinstance(error, LookupError) else error
    if renewed:
        stored = lake.read(MEASURES)
        for rule, days, *_ in renewed:
            here = F.col("measured_date").isNull() | F.col("measured_date").isin(days)
            stored = stored.where(~((F.col("dataset_name") == rule.dataset) & here))
        lake.overwrite(MEASURES, reduce(DataFrame.unionByName, [stored, *(rows for _, _, rows, _ in renewed)]).coalesce(1))
        _replace_keys(lake, [(rule, days, keys) for rule, days, _, keys in renewed if keys is not None])
    measured = [b for b in batches if b.table.replace(".", "_", 1) not in found]
    if any(b.changed for b in measured):
        ledger.consume(lake, PIPELINE, measured)
    for rule in (r for r in rules if r.dataset not in found):
        mine = F.col("dataset_name") == rule.dataset
        keys = lake.read(KEYS).where(mine) if _keys_recur(rule) else None
        found[rule.dataset] = fold_measures(lake.read(MEASURES).where(mine), rule, keys)
    return found


def _keys_recur(rule: Rule) -> bool:
    """Whether a key can stand on several dates, so that the dates' counts don't add up."""
    table = TABLES[rule.table]
    return bool(rule.keys) and table.dated_by is not None and table.dated_by not in rule.keys


def _renewed(lake: Store, rule: Rule, days: list[date]) -> tuple[Rule, list[date], DataFrame, DataFrame | None]:
    """Measures of the dates, read from these only, and their keys if these can recur, as written tables."""
    moment, tagged = TABLES[rule.table].dated_by, F.lit(rule.dataset).alias("dataset_name")
    rows = lake.read(rule.table, [*days, None]) if moment else lake.read(rule.table)

    def kept(found: DataFrame, table: str) -> DataFrame:
        folder = new_folder(lake.spark, "measures")
        found.select(tagged, "*").write.parquet(folder)
        return lake.spark.read.schema(TABLES[table].ddl).parquet(folder)

    keys = kept(date_keys(rows, rule, moment), KEYS) if _keys_recur(rule) else None
    return rule, days, kept(partial_measures(rows, rule, moment), MEASURES), keys


def _replace_keys(lake: Store, renewed: Sequence[tuple[Rule, list[date], DataFrame]]) -> None:
    """The keys of all renewed datasets in place of the former ones of their dates: every date is rewritten once."""
    if not renewed:
        return
    dates: list[date | None] = [*sorted({day for _, days, _ in renewed for day in days}), None]
    kept, day = lake.read(KEYS, dates), utc_date("measured_at")
    for rule, days, _ in renewed:
        kept = kept.where(~((F.col("dataset_name") == rule.dataset) & (day.isNull() | day.isin(days))))
    lake.replace_dates(KEYS, reduce(DataFrame.unionByName, [kept, *(keys for *_, keys in renewed)]), dates)


def _message(error: Exception) -> str:
    told = error.java_exception.getMessage() if isinstance(error, Py4JJavaError) else str(error)
    return told.strip().splitlines()[0]


def run_quality(
    lake: Store,
    audit_run_id: str,
    rules: Sequence[Rule] = RULES,
    checked_at: datetime | None = None,
    environment: str = "dev",
    job_name: str | None = None,
    task_name: str | None = None,
    fail_on_violation: bool = True,
    incremental: bool = False,
) -> DataFrame:
    """Check all datasets, append the audit rows, then fail if any check found a violation.

    ``incremental`` reads only dates that changed since the last such run and folds their measures with the stored ones of
    all other dates; the verdicts are the same. A dataset that cannot be read to its end, such as one with a damaged file, is a violation of its own; the
    others are judged as usual.
    """
    if not rules:  # nothing checked, nothing written
        return lake.read(AUDIT).limit(0)
    checked_at = checked_at or datetime.now(timezone.utc)
    locations = {rule.dataset: (rule.table.partition(".")[2], lake.path(rule.table)) for rule in rules}

    def record(verdicts: DataFrame) -> None:
        # At most one row per rule.
        rows = audit_rows(verdicts, audit_run_id, checked_at, environment, job_name, task_name, locations).coalesce(1)
        lake.append(AUDIT, rows)

    if incremental:
        record(judge_datasets(lake.spark, folded_measures(lake, rules), rules, checked_at))
    else:
        opened = open_datasets(lake, rules)
        try:
            record(check_datasets(lake.spark, opened, rules, checked_at))  # one job for all
        except READ_ERRORS:
            record(check_datasets(lake.spark, measurable_datasets(opened, rules), rules, checked_at))
    stored = lake.read(AUDIT).where(F.col("audit_run_id") == audit_run_id)
    if fail_on_violation:
        gate(stored)
    return stored


def gate(audit: DataFrame) -> None:
    """Raise when any dataset of the run failed, naming its violations."""
    failed = audit.where("NOT passed").select("violations_json").collect()
    if failed:
        raise QualityError("\n".join(row[0] for row in failed))

"""Data-quality checks over Silver: ten checks, a report, its history and its summary.

A check is declared by a rule: a condition on rows, a key that occurs more than once, or a missing partner. From the rules
follow its listing, its count and its samples. Counts and samples of all checks are compiled together: rules on
rows of one table share one scan, and all rules on one key share one census of that key. Adding a check means
adding an entry to ``CHECKS``.
"""

from __future__ import annotations

import logging
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopstrata.functions.parse import instant
from shopstrata.operators.census import key_census
from shopstrata.operators.keyed import match, without_match
from shopstrata.operators.parts import concatenated_parts

Tables = Mapping[str, DataFrame]
LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class Rows:
    """Rows of ``table`` that meet a condition."""

    table: str
    condition: str


@dataclass(frozen=True)
class Repeated:
    """Values of ``key``, NULL included, that occur more than once in ``table``.

    ``more`` are further aggregates of their rows; without any, the count comes with the census of the key.
    """

    table: str
    key: str
    more: tuple[str, ...] = ()


@dataclass(frozen=True)
class Alone:
    """Rows of ``table`` whose ``key`` does not occur in ``other``; a NULL key never does."""

    table: str
    other: str
    key: str


@dataclass(frozen=True)
class Check:
    """A named check. ``fields`` are the SQL columns of its listing, the first one orders the samples.

    ``rule`` may also be a function from the tables to the listing; such a check is counted and sampled by itself.
    """

    check_id: str
    check_name: str
    category: str
    description: str
    rule: Rows | Repeated | Alone | Callable[[Tables], DataFrame]
    fields: tuple[str, ...]
    on: str | None = None

    @property
    def table(self) -> str:
        return f"silver_{self.on or self.rule.table}"

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.names[0],)

    @property
    def names(self) -> list[str]:
        """The names of the listing's columns."""
        return [field.rpartition(" AS ")[2] for field in self.fields]

    def violations(self, t: Tables) -> DataFrame:
        """The listing: one row per issue."""
        rule = self.rule
        if isinstance(rule, Rows):
            found = t[rule.table].where(rule.condition)
        elif isinstance(rule, Repeated):
            found = _occurrences(t[rule.table], rule.key, *rule.more)
        elif isinstance(rule, Alone):
            found = without_match(t[rule.table], t[rule.other], rule.key)
        else:
            found = rule(t)
        return found.selectExpr(*self.fields)


def _occurrences(df: DataFrame, key: str, *more: str) -> DataFrame:
    counts = [F.count(F.lit(1)).alias("occurrences"), *map(F.expr, more)]
    return df.groupBy(key).agg(*counts).where("occurrences > 1")


def shared_email_members(t: Tables) -> DataFrame:
    """One row for each customer row whose email is shared; no cell grows with the group."""
    group = F.coalesce(F.concat(F.lit("="), "email"), F.lit("-")).alias("_group")
    members = t["customers"].select("customer_id", "email", group)
    groups = _occurrences(members, "_group")
    return match(members, groups, "_group", "inner").select("email", "occurrences", "customer_id")


def shared_email_lists(t: Tables) -> DataFrame:
    """One row per shared email with all its customer ids in order, in one cell.

    For data in which no email has more customers than a cell can hold; other data is read with
    :func:`shared_email_parts` or :func:`shared_email_members`, which have the same content.
    """
    return (
        t["customers"]
        .groupBy("email")
        .agg(
            F.count(F.lit(1)).alias("occurrences"),
            F.expr("listagg(customer_id, ', ') within group (order by customer_id)").alias("customer_ids"),
        )
        .where("occurrences > 1")
    )


def shared_email_parts(t: Tables, rows: int = 1000) -> DataFrame:
    """The lists of :func:`shared_email_lists` in parts of ``rows`` customer ids, for groups of any size.

    (email, occurrences, part, first, offset, customer_ids); customers without an id are counted, but have no place.
    """
    members = shared_email_members(t)
    parts = concatenated_parts(members, "email", "customer_id", ", ", rows).drop("occurrences")
    # One row per shared email on this side.
    groups = _occurrences(t["customers"].select("email"), "email")
    keyed = F.coalesce(F.concat(F.lit("="), "email"), F.lit("-"))
    counted = groups.select(keyed.alias("_group"), "occurrences")
    return match(parts.withColumn("_group", keyed), counted, "_group", "inner").select(
        "email", "occurrences", "part", "first", "offset", F.col("text").alias("customer_ids")
    )


# Ids, names, tables, categories and descriptions as they appear in the report.
CHECKS = [
    Check(
        "DQ-001", "Duplicate order IDs", "Uniqueness",
        "Order IDs that appear more than once in the orders table.",
        Repeated("orders", "order_id"), ("order_id", "occurrences"),
    ),
    Check(
        "DQ-002", "Missing customer_id on orders", "Completeness",
        "Orders with no linked customer. Cannot attribute revenue.",
        Rows("orders", "customer_id IS NULL OR customer_id = 'nan'"), ("order_id", "order_date", "order_total"),
    ),
    Check(
        "DQ-003", "Returns without matching order", "Referential Integrity",
        "Returns that reference an order_id that does not exist in orders.",
        Alone("returns", "orders", "order_id"), ("return_id", "order_id", "return_date", "refund_amount"),
    ),
    Check(
        "DQ-004", "Orders with no line items", "Completeness",
        "Orders that have no corresponding items in order_items.",
        Alone("orders", "order_items", "order_id"), ("order_id", "order_date", "order_total", "status"),
    ),
    Check(
        "DQ-005", "Invalid shipping dates", "Validity",
        "Shipments where ship_date is after actual_delivery date.",
        Rows("shipping_events", "_invalid_ship_date"),
        (
            "shipment_id", "order_id", "carrier", "ship_date", "actual_delivery",
            "datediff(actual_delivery, ship_date) AS days_diff",
        ),
    ),
    Check(
        "DQ-006", "Orphan order items", "Referential Integrity",
        "Order items that reference an order_id that does not exist.",
        Alone("order_items", "orders", "order_id"), ("item_id", "order_id", "product_id", "line_total"),
    ),
    Check(
        # A missing email is a group of its own. Who the customers are is listed by shared_email_members.
        "DQ-007", "Duplicate customer emails", "Uniqueness",
        "Email addresses linked to more than one customer record.",
        Repeated(
            "customers", "email",
            ("min(customer_id) AS first_customer_id", "max(customer_id) AS last_customer_id"),
        ),
        ("email", "occurrences", "first_customer_id", "last_customer_id"),
    ),
    Check(
        "DQ-008", "Products with invalid price", "Validity",
        "Products with zero/null price or cost exceeding selling price.",
        Rows("products", "unit_price IS NULL OR unit_price <= 0 OR cost_price > unit_price"),
        ("product_id", "product_name", "unit_price", "cost_price"),
    ),
    Check(
        "DQ-009", "Orders with null order_total", "Completeness",
        "Orders missing a total amount — cannot be used in revenue reporting.",
        Rows("orders", "order_total IS NULL"), ("order_id", "order_date", "status", "customer_id"),
    ),
    Check(
        "DQ-010", "Returns with no refund amount", "Completeness",
        "Returns marked approved but with no refund amount recorded.",
        Rows("returns", "refund_amount IS NULL OR refund_amount = 0"), ("return_id", "order_id", "reason", "status"),
    ),
]

BY_ID = {check.check_id: check for check in CHECKS}


# Counts and samples that checks share


def _census_tables(checks: Sequence[Check], key: str) -> list[str]:
    """The tables in which rules ask for ``key``."""
    rules = [c.rule for c in checks if isinstance(c.rule, (Repeated, Alone)) and c.rule.key == key]
    return sorted({t for r in rules for t in ((r.table,) if isinstance(r, Repeated) else (r.table, r.other))})


def _count_in_census(rule: Repeated | Alone) -> str:
    """The issues of a rule, from a census with a row per key and a count per table."""
    if isinstance(rule, Repeated):
        return f"count_if({rule.table} > 1)"
    # A missing key matches nothing, not even another missing one.
    return f"coalesce(sum(CASE WHEN {rule.key} IS NULL OR {rule.other} = 0 THEN {rule.table} END), 0)"


def shared_counts(checks: Sequence[Check]) -> list[tuple[tuple[str, ...], Callable[[Tables], DataFrame]]]:
    """Plans that count several checks at once: one scan per table and one census per key.

    Each gives one row with a column per check id.
    """
    by_table, by_key, plans = defaultdict(list), defaultdict(list), []
    for check in checks:
        if isinstance(check.rule, Rows):
            by_table[check.rule.table].append(check)
        elif isinstance(check.rule, (Repeated, Alone)):
            by_key[check.rule.key].append(check)
        else:
            plans.append(((check.check_id,), partial(count_issues, check)))

    def of_rows(table: str, t: Tables) -> DataFrame:
        return t[table].selectExpr(*[f"count_if({c.rule.condition}) AS `{c.check_id}`" for c in by_table[table]])

    def of_key(key: str, t: Tables) -> DataFrame:
        census = key_census({n: t[n] for n in _census_tables(by_key[key], key)}, key)
        return census.selectExpr(*[f"{_count_in_census(c.rule)} AS `{c.check_id}`" for c in by_key[key]])

    for groups, plan in ((by_table, of_rows), (by_key, of_key)):
        plans += [(tuple(c.check_id for c in found), partial(plan, name)) for name, found in groups.items()]
    return plans


def count_issues(check: Check, tables: Tables) -> DataFrame:
    """The number of issues of one check, as one row."""
    return check.violations(tables).agg(F.count(F.lit(1)).alias(check.check_id))


REPORT_SCHEMA = (
    "run_time timestamp, check_id string, check_name string, `table` string, category string, "
    "description string, status string, issue_count long, message string"
)


def _counted(counts: DataFrame, check_ids: tuple[str, ...], message: str | None = None) -> DataFrame:
    """One row of counts as one row per check."""
    pairs = ", ".join(f"'{i}', CAST(`{i}` AS BIGINT)" for i in check_ids)
    rows = counts.selectExpr(f"stack({len(check_ids)}, {pairs}) AS (check_id, issue_count)")
    return rows.withColumn("message", F.lit(message).cast("string"))


def _labelled(counted: DataFrame, run_time: datetime, checks: Sequence[Check]) -> DataFrame:
    """Counts with the texts of their checks, which are looked up in a literal map."""
    entries = []
    for c in checks:
        texts = {"check_name": c.check_name, "table": c.table, "category": c.category, "description": c.description}
        entries += [F.lit(c.check_id), F.struct(*[F.lit(text).alias(name) for name, text in texts.items()])]
    status = """CASE WHEN issue_count < 0 THEN 'ERROR' WHEN issue_count > 0 THEN 'FAIL'
                     ELSE 'PASS' END AS status"""
    return (
        counted.withColumns({"run_time": F.expr(instant(run_time)), "check": F.create_map(*entries)[F.col("check_id")]})
        .select("run_time", "check_id", "check.*", F.expr(status), "issue_count", "message")
    )


def _error_count(spark: SparkSession, check_id: str) -> DataFrame:
    return spark.range(1).selectExpr(f"-1 AS `{check_id}`")


def quality_report(
    spark: SparkSession, tables: Tables, run_time: datetime, checks: Sequence[Check] | None = None
) -> DataFrame:
    """One row per check as a single lazy plan; ``checks`` are ``CHECKS`` unless given.

    A check whose query cannot even be planned (its table or a column is missing) becomes an
    ERROR row. Failures while running are isolated by :func:`run_quality_checks`.
    """
    checks = CHECKS if checks is None else checks
    by_id = {check.check_id: check for check in checks}
    parts = []
    for check_ids, build in shared_counts(checks):
        try:
            parts.append(_counted(build(tables), check_ids))
            continue
        except Exception as problem:  # noqa: BLE001 - fall back to one plan per check
            LOG.warning("%s are counted one by one: %s", ", ".join(check_ids), problem)
        for check_id in check_ids:
            try:
                parts.append(_counted(count_issues(by_id[check_id], tables), (check_id,)))
            except Exception as problem:  # noqa: BLE001 - any failure is a result of the check
                parts.append(_counted(_error_count(spark, check_id), (check_id,), str(problem)))
    return _labelled(reduce(DataFrame.unionByName, parts), run_time, checks).orderBy("check_id")


def run_quality_checks(
    spark: SparkSession, tables: Tables, run_time: datetime, checks: Sequence[Check] | None = None
) -> DataFrame:
    """The report with its counts already computed; one failing check never stops the others.

    All checks run as one job. If that job fails, each check runs on its own, and those that
    fail again are reported as ERROR with -1 issues. Only the report's rows, one per check, reach the driver.
    """
    checks = CHECKS if checks is None else checks
    report = quality_report(spark, tables, run_time, checks)
    try:
        rows = report.collect()
    except Exception as failure:  # noqa: BLE001
        LOG.warning("the checks run one by one: %s", failure)
        rows = []
        for check in checks:
            try:
                counts = count_issues(check, tables)
                rows += _labelled(_counted(counts, (check.check_id,)), run_time, checks).collect()
            except Exception as problem:  # noqa: BLE001
                counts = _error_count(spark, check.check_id)
                rows += _labelled(_counted(counts, (check.check_id,), str(problem)), run_time, checks).collect()
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def latest_run(history: DataFrame) -> DataFrame:
    """The rows of the newest run in an append-only history."""
    return history.where(F.col("run_time") == history.agg(F.max("run_time")).scalar())


def displayed(run: DataFrame) -> DataFrame:
    """One run under display names; ``LayerStore.newest_run`` finds the newest without reading the others."""
    # The headings of the displayed table.
    headings = {
        "check_id": "ID",
        "check_name": "Check",
        "category": "Category",
        "status": "Status",
        "issue_count": "Issues Found",
    }
    return run.select(*headings).withColumnsRenamed(headings).orderBy("ID")


def latest_report(history: DataFrame) -> DataFrame:
    """The newest run of a history of any kind, under display names."""
    return displayed(latest_run(history))


def quality_summary(report: DataFrame) -> DataFrame:
    """Checks run, passed, failed and in error, and total issues (an error adds none).

    ``all_passed`` means that no check failed; an error does not reset it.
    """
    status = F.col("status")
    return report.agg(
        F.count(F.lit(1)).alias("checks_run"),
        F.count_if(status == "PASS").alias("passed"),
        F.count_if(status == "FAIL").alias("failed"),
        F.count_if(status == "ERROR").alias("errors"),
        F.coalesce(F.sum(F.greatest("issue_count", F.lit(0))), F.lit(0)).alias("total_issues"),
        (F.count_if(status == "FAIL") == 0).alias("all_passed"),
    )


def sample_violations(check: Check, tables: Tables) -> DataFrame:
    """Offending rows of one check as text: all of them up to five, else the first three.

    Six rows are enough to tell the cases apart, so this is a top-k and never a full sort.
    """
    found = check.violations(tables)
    fields = ", ".join(
        f"concat('{c}=', coalesce(CAST({c} AS STRING), 'NULL'))" for c in found.columns
    )
    record = F.expr(f"concat_ws(', ', {fields})")
    order = [F.col(c).asc_nulls_last() for c in check.keys]
    first = found.select(*check.keys, record.alias("record")).orderBy(*order, "record").limit(6)
    keys_then_record = F.struct(
        *[s for c in check.keys for s in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))], "record"
    )
    return (
        first.agg(F.sort_array(F.collect_list(keys_then_record)).alias("rows"))
        .select(
            F.lit(check.check_id).alias("check_id"),
            F.posexplode(
                F.slice("rows", 1, F.when(F.size("rows") <= 5, 5).otherwise(3))
            ).alias("at", "row"),
        )
        .select("check_id", (F.col("at") + 1).alias("sample_no"), F.col("row.record").alias("record"))
    )


def _record(check: Check) -> str:
    """A row of the listing as text."""
    cells = [
        f"concat('{name}=', coalesce(CAST({field.rpartition(' AS ')[0] or field} AS STRING), 'NULL'))"
        for name, field in zip(check.names, check.fields)
    ]
    return f"concat_ws(', ', {', '.join(cells)})"


def _marked(df: DataFrame, conditions: Mapping[Check, str]) -> DataFrame:
    """(check_id, key, record) for every check whose condition a row meets, in one scan of ``df``."""
    found = [
        f"if({condition}, named_struct('check_id', '{check.check_id}', 'key', CAST({check.fields[0]} AS STRING), "
        f"'record', {_record(check)}), NULL)"
        for check, condition in conditions.items()
    ]
    marks = f"explode(filter(array({', '.join(found)}), x -> x IS NOT NULL)) AS mark"
    return df.selectExpr(marks).select("mark.*")


def quality_samples(tables: Tables, checks: Sequence[Check] | None = None) -> DataFrame:
    """Samples of all checks: every table is read once, besides the shared census of each key.

    The first six per check, by the listing's first column as text, are kept before anything is shuffled; six tell "up
    to five" from more.
    """
    checks = CHECKS if checks is None else checks
    census = {
        key: key_census({n: tables[n] for n in _census_tables(checks, key)}, key)
        for key in {c.rule.key for c in checks if isinstance(c.rule, Alone) or isinstance(c.rule, Repeated) and not c.rule.more}
    }
    conditions: dict[str, dict[Check, str]] = defaultdict(dict)
    joined, marks = dict(tables), []
    for check in checks:
        rule = check.rule
        if isinstance(rule, Rows):
            conditions[rule.table][check] = rule.condition
        elif isinstance(rule, Alone):
            flag = f"_{rule.key}_not_in_{rule.other}"
            if flag not in joined[rule.table].columns:
                missing = census[rule.key].where(f"{rule.other} = 0").selectExpr(rule.key, f"true AS {flag}")
                joined[rule.table] = match(joined[rule.table], missing, rule.key, "left")
            conditions[rule.table][check] = f"{rule.key} IS NULL OR coalesce({flag}, false)"
        elif isinstance(rule, Repeated) and not rule.more:
            counted = census[rule.key].withColumnRenamed(rule.table, "occurrences")
            marks.append(_marked(counted, {check: "occurrences > 1"}))
        elif isinstance(rule, Repeated):
            marks.append(_marked(_occurrences(tables[rule.table], rule.key, *rule.more), {check: "true"}))
        else:
            marks.append(_marked(rule(tables), {check: "true"}))
    marks += [_marked(joined[table], found) for table, found in conditions.items()]
    order = Window.partitionBy("check_id").orderBy(F.col("key").asc_nulls_last(), "record")
    first = (
        reduce(DataFrame.unionByName, marks)
        .withColumn("sample_no", F.row_number().over(order)).where("sample_no <= 6")
    )
    rows = F.sort_array(F.collect_list(F.struct("sample_no", "record")))
    return (
        first.groupBy("check_id").agg(rows.alias("rows"))
        .select("check_id", F.explode(F.slice("rows", 1, F.when(F.size("rows") <= 5, 5).otherwise(3))).alias("row"))
        .select("check_id", "row.sample_no", "row.record")
    )

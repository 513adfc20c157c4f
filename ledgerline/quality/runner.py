"""Running many checks: failures per check, and a status from severity and tolerance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.cuts import cut
from ..sources.tables import write_failures
from . import checks as c

ROW_KINDS = ("not_null", "accepted_range", "expression_is_true")
VALUE_KINDS = ("unique", "accepted_values", "relationships")
#: Conditions in one number, whose sign is left alone.
MASK_BITS = 62


@dataclass(frozen=True)
class Check:
    """One check of a table. ``arguments`` are those of the function named by ``kind``;
    ``parent`` or ``other`` among them name a table. ``warn_above`` and ``error_above``
    are the failures tolerated; a check of severity ``warn`` never fails."""

    table: str
    kind: str
    column: str | None = None
    arguments: dict = field(default_factory=dict)
    where: str | None = None
    severity: str = "error"
    warn_above: int = 0
    error_above: int = 0
    store_failures: bool = False

    @property
    def name(self) -> str:
        text = " ".join(f"{key}={value}" for key, value in self.arguments.items())
        parts = [self.kind, self.column, text, self.where and f"where {self.where}"]
        return " ".join(part for part in parts if part)


def failing_rows(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    arguments = dict(check.arguments)
    for role in ("parent", "other"):
        if role in arguments:
            arguments[role] = tables[arguments[role]]
    if check.column is not None:
        arguments["column"] = check.column
    if check.where is not None:
        arguments["where"] = check.where
    return getattr(c, check.kind)(tables[check.table], **arguments)


def _row_condition(check: Check) -> Column:
    fails = {
        "not_null": c.null_fails,
        "accepted_range": c.range_fails,
        "expression_is_true": c.expression_fails,
    }[check.kind]
    arguments = dict(check.arguments)
    if check.column is not None:
        arguments["column"] = check.column
    condition = fails(**arguments)
    return condition if check.where is None else condition & F.expr(check.where)


def _as_counted(check: Check, first: dict[str, str]) -> Check:
    """What is counted for a check, whatever is tolerated, with the first name of each table."""
    arguments = {
        key: first[value] if key in ("parent", "other") else value for key, value in check.arguments.items()
    }
    return Check(first[check.table], check.kind, check.column, arguments, check.where)


def _masks(
    table: str, numbered: list[tuple[int, Check]], start: int
) -> tuple[list[Column], list[tuple[int, int, int | None, int]]]:
    """Entries with the conditions that a row fails, as bits of a number that stands for a value, and their
    ``feeds``: which check counts the rows of an entry, by which bit or all of them, with which sign. A table counts
    for an equal_rowcount check, the other table against it. Entries are numbered from ``start``."""
    failing = [(i, _row_condition(check)) for i, check in numbered if check.table == table and check.kind in ROW_KINDS]
    feeds = []
    for i, check in numbered:
        if check.kind == "equal_rowcount":
            sides = (check.table == table) - (check.arguments["other"] == table)
            if sides:
                feeds.append((start, i, None, sides))
    every_row = bool(feeds)
    entries = []
    for at in range(0, max(len(failing), int(every_row)), MASK_BITS):
        number, mask = start + len(entries), F.lit(0).cast("long")
        for bit, (i, fails) in enumerate(failing[at : at + MASK_BITS]):
            mask = mask.bitwiseOR(F.when(fails, F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")))
            feeds.append((number, i, 1 << bit, 1))
        entry = _entry(number, mask, 1)
        entries.append(entry if every_row and at == 0 else F.when(mask != 0, entry))
    return entries, feeds


def _entry(number: int, value: Column, here: int) -> Column:
    """A value as the bytes of its text: before an aggregate's keys of text Spark puts a small table of keys, which
    is soon full and then only looked up in vain, as most values come once."""
    row = {"number": F.lit(number), "value": value.cast("string").cast("binary")}
    row |= {"here": F.lit(here).cast("long"), "there": F.lit(1 - here).cast("long")}
    return F.struct(*(c.alias(name) for name, c in row.items()))


def _value_entries(table: str, numbered: list[tuple[int, Check]]) -> list[Column]:
    """The values of a table that its unique, accepted_values and relationships checks ask for, and those in which
    other tables' relationships look. Values are compared as text."""
    found = []

    def value(i: int, column: str, counts: Column, here: int) -> None:
        entry = _entry(i, F.col(column), here)
        found.append(F.when(F.col(column).isNotNull() & counts, entry))

    for i, check in numbered:
        scope = F.lit(True) if check.where is None else F.expr(check.where)
        if check.table == table and check.kind in VALUE_KINDS:
            if check.kind == "accepted_values":
                scope = scope & c.value_fails(check.column, check.arguments["values"])
            value(i, check.column, scope, 1)
        if check.kind == "relationships" and check.arguments["parent"] == table:
            known = check.arguments.get("parent_where")
            value(i, check.arguments["field"], F.lit(True) if known is None else F.expr(known), 0)
    return found


def _spread(entries: list[Column], df: DataFrame) -> DataFrame | None:
    """The entries of all rows of a table: ``number, value, here, there`` in one scan."""
    if not entries:
        return None
    # entries that do not count are left out as rows: array_compact would run outside generated code
    return df.select(F.inline(F.array(*entries))).where(F.col("number").isNotNull())


def _failing_values(values: DataFrame, numbered: list[tuple[int, Check]]) -> DataFrame:
    """One aggregate by check and value, with ``n``: values met twice, values not accepted, rows whose value is
    nowhere in the parent."""
    by_value = values.groupBy("number", "value").agg(
        F.sum("here").alias("here"), F.sum("there").alias("there")
    )

    def of_kind(kind: str) -> Column:
        return F.col("number").isin([i for i, check in numbered if check.kind == kind])

    failures = (
        F.when(of_kind("unique"), (F.col("here") > 1).cast("long"))
        .when(of_kind("accepted_values"), 1)
        .otherwise(F.when(F.col("there") == 0, F.col("here")).otherwise(0))
    )
    text = F.col("value").cast("string").alias("value")
    return by_value.select("number", text, failures.cast("long").alias("n")).where("n > 0")


def _counted_alone(number: int, check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    failing = failing_rows(check, tables)
    return failing.agg(F.lit(number).alias("number"), F.count(F.lit(1)).alias("n"))


def run_checks(checks: Iterable[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """One row per check: table, check, severity, failures and status.

    A table is scanned once, however many checks there are and under however many names it is given: for the
    values that checks ask for, and for the conditions that each row fails, as one more value. All
    tables' values are then aggregated together.
    """
    checks = list(checks)
    spark = next(iter(tables.values())).sparkSession
    named: dict[int, str] = {}
    first = {name: named.setdefault(id(df), name) for name, df in tables.items()}
    alike: dict[str, int] = {}
    numbered, feeds, counted = [], [], []
    for i, check in enumerate(checks):
        check = _as_counted(check, first)
        number = alike.setdefault(repr(check), i)
        if number == i and check.kind not in (*ROW_KINDS, *VALUE_KINDS, "equal_rowcount"):
            counted.append(_counted_alone(i, check, tables))
        elif number == i:
            numbered.append((i, check))
    asked = {check.table for _, check in numbered}
    asked |= {check.arguments[r] for _, check in numbered for r in ("parent", "other") if r in check.arguments}
    values, masks = [], len(checks)
    for table in (name for name in tables if name in asked):
        conditions, fed = _masks(table, numbered, masks)
        masks += len(conditions)
        feeds += fed
        spread = _spread([*conditions, *_value_entries(table, numbered)], tables[table])
        if spread is not None:
            values.append(spread)
    feeds += [(i, i, None, 1) for i, check in numbered if check.kind in VALUE_KINDS]
    if values:
        failing = _failing_values(reduce(DataFrame.unionByName, values), numbered)
        mask = F.when(F.col("number") >= len(checks), F.col("value")).cast("long")
        found = failing.groupBy(F.col("number").alias("entry"), mask.alias("mask")).agg(F.sum("n").alias("n"))
        to = spark.createDataFrame(feeds, "entry int, number int, bit long, sign int")
        met = found.join(F.broadcast(to), "entry").where(
            F.col("bit").isNull() | (F.col("mask").bitwiseAND(F.col("bit")) != 0)
        )
        counted.append(met.select("number", (F.col("sign") * F.col("n")).alias("n")))
    every = reduce(DataFrame.unionByName, counted)
    # an equal_rowcount check has its table's rows and, negative, the other's
    failures = every.groupBy("number").agg(F.abs(F.sum("n")).alias("failures"))

    listed = spark.createDataFrame(
        [
            (alike[repr(_as_counted(check, first))], check.table, check.name, check.severity,
             check.warn_above, check.error_above)
            for check in checks
        ],
        "number int, table string, check string, severity string, warn_above long, error_above long",
    )
    n = F.coalesce("failures", F.lit(0))
    fails = (F.col("severity") == "error") & (n > F.col("error_above"))
    status = F.when(fails, "fail").when(n > F.col("warn_above"), "warn").otherwise("pass")
    return listed.join(failures, "number", "left").select(
        "table", "check", "severity", n.alias("failures"), status.alias("status")
    )


def _identity(check: Check) -> str:
    # two checks of one kind on a column may differ in their condition
    digest = hashlib.md5(repr(check).encode()).hexdigest()[:8]
    return f"{check.kind}__{check.column}__{digest}"


def store_rows(
    checks: Iterable[Check], tables: dict[str, DataFrame], audit_dir: str, run: str
) -> dict[str, str]:
    """Write the failing rows of all checks on rows and values, a folder for each table: the row with ``check``, by
    ``run`` and ``check_id``. A run is replaced, other runs stay. Returns the folders.

    The values that fail are found first, as for counting; one pass over a table then tags its rows with
    every check that they fail. Rows fail a unique check by their value, whichever came first.
    """
    numbered = [(i, check) for i, check in enumerate(checks) if check.kind in (*ROW_KINDS, *VALUE_KINDS)]
    spread = [_spread(_value_entries(table, numbered), df) for table, df in tables.items()]
    spread = [values for values in spread if values is not None]
    failing = None
    if spread:
        failing = _failing_values(reduce(DataFrame.unionByName, spread), numbered).select("number", "value")
        failing = cut(failing.withColumn("_fails", F.lit(True)), "failing-values")
    stored = {}
    for table in dict.fromkeys(check.table for _, check in numbered):
        here = [(i, check) for i, check in numbered if check.table == table]
        entries = []
        for i, check in here:
            value, fails = F.lit(None).cast("string"), None
            if check.kind in ROW_KINDS:
                fails = _row_condition(check)
            else:
                value = F.col(check.column).cast("string")
                fails = F.col(check.column).isNotNull()
                if check.kind == "accepted_values":
                    fails = c.value_fails(check.column, check.arguments["values"])
                if check.where is not None:
                    fails = fails & F.expr(check.where)
            entries.append(F.when(fails, F.struct(F.lit(i).alias("number"), value.alias("value"))))
        df = tables[table]
        tagged = df.select("*", F.inline(F.array_compact(F.array(*entries))))
        by_value = [i for i, check in here if check.kind in VALUE_KINDS]
        if by_value:
            tagged = tagged.join(failing, ["number", "value"], "left")
            tagged = tagged.where(F.col("_fails") | ~F.col("number").isin(by_value))
        listed = _listed(df, here)
        rows = tagged.join(F.broadcast(listed), "number").select(*df.columns, "check", "check_id")
        stored[table] = f"{audit_dir.rstrip('/')}/{table}"
        rows.write.mode("overwrite").partitionBy("check_id").parquet(f"{stored[table]}/run={run}")
    return stored


def _listed(df: DataFrame, numbered: list[tuple[int, Check]]) -> DataFrame:
    """The names of a table's checks, one row each."""
    rows = [(i, check.name, _identity(check)) for i, check in numbered]
    return df.sparkSession.createDataFrame(rows, "number int, check string, check_id string")


def store_failures(
    checks: Iterable[Check], tables: dict[str, DataFrame], audit_dir: str
) -> dict[str, str]:
    """Write the failing rows of the checks that ask for it; returns the paths."""
    stored = {}
    for check in checks:
        if check.store_failures:
            name = f"{check.table}__{_identity(check)}"
            stored[check.name] = write_failures(failing_rows(check, tables), audit_dir, name)
    return stored

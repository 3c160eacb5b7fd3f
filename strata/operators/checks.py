"""Rule-template table checks and the check runner.

A check is a boolean *failure* column (NULL = pass) plus metadata. Checks that need
other rows (uniqueness, foreign keys, SCD2 neighbours) contribute a ``prepare`` step
that adds helper columns with an aggregate + join or a keyed window; the runner then
evaluates every check in one projection, so the table is read once however many
checks there are (the reference re-reads it per template).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import materialise


@dataclass
class Check:
    name: str
    function: str
    fails: Column
    columns: Sequence[str]
    message: str
    criticality: str = "error"
    prepare: list[Callable[[DataFrame], DataFrame]] = field(default_factory=list)
    helpers: list[str] = field(default_factory=list)


def _safe(name: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in name)


def check_not_null(col: str, criticality: str = "error", name: str | None = None) -> Check:
    """D9"""
    return Check(name or f"{col}_is_not_null", "is_not_null", F.col(col).isNull(), [col],
                 f"Column '{col}' value is null", criticality)


def check_unique(cols: Sequence[str], nulls_distinct: bool = False, criticality: str = "error",
                 name: str | None = None) -> Check:
    """Composite key occurs more than once. NULLs compare equal unless
    ``nulls_distinct`` (then a key with a NULL part never fails). The count per key is
    a partial aggregate joined back null-safely."""
    name = name or ("_".join(cols) + "_is_unique")
    helper = f"__n_{_safe(name)}"

    def prep(df: DataFrame) -> DataFrame:
        counts = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(helper))
        cond = [F.col(f"_d.{c}").eqNullSafe(F.col(f"_c.{c}")) for c in cols]
        return df.alias("_d").join(counts.alias("_c"), cond, "left").select("_d.*", F.col(f"_c.{helper}"))

    fails = F.col(helper) > 1
    if nulls_distinct:
        fails = fails & ~reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return Check(name, "is_unique", fails, list(cols), f"Value of {', '.join(cols)} is not unique",
                 criticality, [prep], [helper])


def check_in_range(col: str, lo, hi, criticality: str = "error", name: str | None = None) -> Check:
    """Inclusive bounds; NULL passes."""
    return Check(name or f"{col}_in_range", "is_in_range",
                 F.coalesce(~F.col(col).between(F.lit(lo), F.lit(hi)), F.lit(False)), [col],
                 f"Value of '{col}' is outside [{lo}, {hi}]", criticality)


def check_no_future(col: str, now, criticality: str = "error", name: str | None = None) -> Check:
    """Non-NULL and later than ``now`` (a parameter, for determinism)."""
    n = F.lit(now) if not isinstance(now, Column) else now
    return Check(name or f"{col}_not_in_future", "is_not_in_future",
                 F.col(col).isNotNull() & (F.col(col) > n), [col], f"Value of '{col}' is in the future", criticality)


def check_pattern(col: str, regex: str, criticality: str = "error", name: str | None = None) -> Check:
    """Non-NULL and not matching ``regex``."""
    return Check(name or f"{col}_matches_pattern", "regex_match",
                 F.col(col).isNotNull() & ~F.col(col).rlike(regex), [col],
                 f"Value of '{col}' does not match pattern", criticality)


def check_fk(col: str, refs: Sequence[tuple[DataFrame, str]], allow_nulls: bool = False,
             criticality: str = "error", name: str | None = None) -> Check:
    """Value must exist in the union of several reference columns. A NULL FK
    fails unless ``allow_nulls``."""
    name = name or f"{col}_fk_exists"
    helper = f"__fk_{_safe(name)}"

    def prep(df: DataFrame) -> DataFrame:
        ref = reduce(DataFrame.unionByName, [r.select(F.col(c).alias("__fk_key")) for r, c in refs]).distinct()
        ref = ref.withColumn(helper, F.lit(True))
        j = df.alias("_d").join(ref.alias("_r"), F.col(f"_d.{col}") == F.col("_r.__fk_key"), "left")
        return j.select("_d.*", F.col(f"_r.{helper}"))

    missing = F.col(col).isNotNull() & F.col(helper).isNull()
    fails = missing if allow_nulls else (missing | F.col(col).isNull())
    return Check(name, "foreign_key", fails, [col], f"Value of '{col}' has no match in the reference",
                 criticality, [prep], [helper])


def check_scd2_unique(keys: Sequence[str], start: str, criticality: str = "error") -> Check:
    """Entity key + start timestamp unique."""
    c = check_unique(list(keys) + [start], criticality=criticality, name="scd2_pk_unique")
    c.function = "scd2_pk_unique"
    return c


def check_scd2_overlap(keys: Sequence[str], start: str, end: str, strict: bool = False,
                       criticality: str = "error") -> Check:
    """Previous version's end later than this start. A NULL previous end passes
    (reference behaviour) unless ``strict`` (an open earlier version then fails)."""
    own = _safe("_".join([*keys, start, end, str(strict)]))
    helper, helper2 = f"__prev_end_{own}", f"__has_prev_{own}"

    def prep(df: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(start)
        return df.withColumns({helper: F.lag(end).over(w), helper2: F.lag(F.lit(1)).over(w).isNotNull()})

    fails = F.coalesce(F.col(helper) > F.col(start), F.lit(False))
    if strict:
        fails = fails | (F.col(helper2) & F.col(helper).isNull())
    return Check("scd2_no_overlap", "scd2_no_overlap", fails, list(keys) + [start, end],
                 "Version overlaps the previous version", criticality, [prep], [helper, helper2])


def check_scd2_contiguous(keys: Sequence[str], start: str, end: str, criticality: str = "warn") -> Check:
    """End differs from the next version's start (gap or overlap)."""
    helper = f"__next_start_{_safe('_'.join([*keys, start, end]))}"

    def prep(df: DataFrame) -> DataFrame:
        return df.withColumn(helper, F.lead(start).over(Window.partitionBy(*keys).orderBy(start)))

    fails = F.coalesce(F.col(end) != F.col(helper), F.lit(False))
    return Check("scd2_contiguous", "scd2_contiguous", fails, list(keys) + [start, end],
                 "Version is not contiguous with the next version", criticality, [prep], [helper])


def check_scd2_chronology(start: str, end: str, criticality: str = "error") -> Check:
    """Start after end (both non-NULL)."""
    return Check("scd2_chronology", "scd2_chronology",
                 F.coalesce(F.col(start) > F.col(end), F.lit(False)), [start, end], "Start is after end", criticality)


def check_scd2_zero_length(start: str, end: str, criticality: str = "warn") -> Check:
    """Start equals end."""
    return Check("scd2_zero_length", "scd2_zero_length",
                 F.coalesce(F.col(start) == F.col(end), F.lit(False)), [start, end], "Zero-length version", criticality)


_FINDING = "struct<name:string,function:string,message:string,columns:string>"


def evaluate(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Add ``_errors`` / ``_warnings`` arrays of failed-check structs in one projection."""
    prepared = reduce(lambda d, f: f(d), [p for c in checks for p in c.prepare], df)

    def bucket(crit: str) -> Column:
        items = [F.when(F.coalesce(c.fails, F.lit(False)),
                        F.struct(F.lit(c.name).alias("name"), F.lit(c.function).alias("function"),
                                 F.lit(c.message).alias("message"),
                                 F.lit(",".join(c.columns)).alias("columns")))
                 for c in checks if (c.criticality == "warn") == (crit == "warn")]
        if not items:
            return F.array().cast(f"array<{_FINDING}>")
        return F.filter(F.array(*items), lambda x: x.isNotNull())

    helpers = [h for c in checks for h in c.helpers]
    return prepared.select(*[c for c in df.columns], bucket("error").alias("_errors"),
                           bucket("warn").alias("_warnings")).drop(*[h for h in helpers if h in df.columns])


def valid_rows(evaluated: DataFrame) -> DataFrame:
    """Rows of :func:`evaluate` without an error."""
    return evaluated.where(F.size("_errors") == 0).drop("_errors", "_warnings")


def findings(evaluated: DataFrame, pk: Sequence[str]) -> DataFrame:
    """One row per failed check of :func:`evaluate`."""
    return (evaluated.select(*pk, F.explode(F.concat(
                F.transform("_errors", lambda x: F.struct(x.alias("f"), F.lit("ERROR").alias("criticality"))),
                F.transform("_warnings", lambda x: F.struct(x.alias("f"), F.lit("WARN").alias("criticality")))
            )).alias("_x"))
              .select(*pk, F.col("_x.f.name").alias("check_name"), F.col("_x.f.function").alias("check_function"),
                      F.col("_x.f.message").alias("check_message"), F.col("_x.f.columns").alias("check_columns"),
                      F.col("_x.criticality").alias("criticality")))


def summarise(evaluated: DataFrame, pk: Sequence[str], table: str, checks_run: int) -> DataFrame:
    """One row: total rows, distinct failing PKs for error and warning checks, success rate = (total - failing PKs) /
    total * 100 to 2 dp, status, checks run. Failing PKs are one flag per PK, summed."""
    flags = evaluated.select(*pk, (F.size("_errors") > 0).cast("int").alias("e"), (F.size("_warnings") > 0).cast("int").alias("w"))
    per_pk = flags.groupBy(*pk).agg(F.count(F.lit(1)).alias("n"), F.max("e").alias("e"), F.max("w").alias("w"))
    zero = F.lit(0).cast("bigint")
    s = per_pk.agg(*[F.coalesce(F.sum(c), zero).alias(n) for c, n in (("n", "total_rows"), ("e", "failed_rows"), ("w", "warning_rows"))])
    return s.select(
        F.lit(table).alias("table_name"), "total_rows", "failed_rows", "warning_rows",
        F.when(F.col("total_rows") > 0,
               F.round((F.col("total_rows") - F.col("failed_rows")) * 100.0 / F.col("total_rows"), 2))
         .otherwise(F.lit(100.0)).alias("success_rate"),
        F.when(F.col("failed_rows") > 0, "Issues Found").when(F.col("warning_rows") > 0, "Warning")
         .otherwise("Success").alias("status"),
        F.lit(checks_run).cast("bigint").alias("checks_run"))


def run_checks(df: DataFrame, checks: Sequence[Check], pk: Sequence[str], table: str
               ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid rows, findings one row per failed check, one-row summary). The checks are evaluated once: the
    evaluated table is written to the shared scratch folder and all three read it. Who wants one output only
    takes :func:`valid_rows`, :func:`findings` or :func:`summarise` of :func:`evaluate`, without that write."""
    ev = materialise(evaluate(df, checks), "evaluated-checks")
    return valid_rows(ev), findings(ev, pk), summarise(ev, pk, table, len(checks))


# ---------------------------------------------------------------- templates and roles

class Templates(dict):
    """Check templates by name: name -> builder(params, roles) -> Check or list of Checks. ``extended`` gives a
    copy with templates added or overridden (a table's own ones)."""

    def extended(self, **more: Callable) -> "Templates":
        return Templates({**self, **more})


def role_columns(params: dict, roles: dict) -> list[str]:
    """The columns that a check item names, itself (``columns``) or by roles (``roles``), without repeats."""
    named = list(params.get("columns", []))
    for role in params.get("roles", []):
        held = roles[role]
        named += [held] if isinstance(held, str) else held
    return list(dict.fromkeys(named))


def _scd2(build: Callable) -> Callable:
    """A template over the roles that name an SCD2 table's keys, start and end."""
    def made(params: dict, roles: dict):
        return build(roles[params.get("keys_role", "system_keys")], roles[params.get("start_role", "start")], roles[params.get("end_role", "end")])
    return made


TEMPLATES = Templates({
    "not_null": lambda p, r: [check_not_null(c) for c in role_columns(p, r)],
    "unique": lambda p, r: check_unique(role_columns(p, r), p.get("nulls_distinct", False)),
    "in_range": lambda p, r: [check_in_range(c, p["min"], p["max"]) for c in role_columns(p, r)],
    "no_future": lambda p, r: [check_no_future(c, p["now"]) for c in role_columns(p, r)],
    "pattern": lambda p, r: [check_pattern(c, p["regex"]) for c in role_columns(p, r)],
    "foreign_key": lambda p, r: [check_fk(c, p["references"], p.get("allow_nulls", False)) for c in role_columns(p, r)],
    "scd2_unique": _scd2(lambda k, s, e: check_scd2_unique(k, s)),
    "scd2_overlap": _scd2(lambda k, s, e: check_scd2_overlap(k, s, e)),
    "scd2_contiguous": _scd2(lambda k, s, e: check_scd2_contiguous(k, s, e)),
    "scd2_chronology": _scd2(lambda k, s, e: check_scd2_chronology(s, e)),
    "scd2_zero_length": _scd2(lambda k, s, e: check_scd2_zero_length(s, e)),
})


def checks_for(df: DataFrame, table: dict, defaults: dict | None = None, templates: Templates = TEMPLATES) -> list[Check]:
    """The checks of one table from its configuration and the defaults of all tables.

    Both are {"roles": {role: column or columns}, "checks": [item, ...]}; the table's roles override the defaults', its
    items those of the same name, and an item with ``enabled: False`` switches one off. An item is {"template": name,
    "name": optional, "criticality": "error" or "warn", "params": {...}, "when_roles_present": [role, ...]}. A role is
    present when it is named and all its columns are in ``df``; an item whose roles are not all present is skipped."""
    defaults = defaults or {}
    roles = {**defaults.get("roles", {}), **table.get("roles", {})}
    have = set(df.columns)
    present = {r for r, c in roles.items() if c and set([c] if isinstance(c, str) else c) <= have}
    items: dict[str, dict] = {}
    for item in [*defaults.get("checks", []), *table.get("checks", [])]:
        items[item.get("name") or f"{item['template']}:{sorted(item.get('params', {}).items(), key=str)}"] = item
    out = []
    for item in items.values():
        if not item.get("enabled", True) or not set(item.get("when_roles_present", [])) <= present:
            continue
        if item["template"] not in templates:
            raise ValueError(f"unknown check template {item['template']!r}")
        made = templates[item["template"]](item.get("params", {}), roles)
        made = made if isinstance(made, list) else [made]
        for i, c in enumerate(made):
            name = item.get("name")
            out.append(replace(c, name=c.name if name is None else f"{name}_{i}" if len(made) > 1 else name,
                               criticality=item.get("criticality", c.criticality)))
    return out


def dq_report_merge(existing: DataFrame, new: DataFrame, key: str = "table_name") -> DataFrame:
    """Replace the report rows of the tables just run (anti-join, no driver list)."""
    ran = new.select(key).distinct()
    return existing.join(ran, key, "left_anti").unionByName(new)

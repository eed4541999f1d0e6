"""Cleaning with an explained quarantine.

For each table the raw row, its normalised values, a changed mark and the ordered
reasons for rejecting it are kept side by side in one *judged* frame. The clean
rows, the rejected rows and the counts are projections of that frame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from types import MappingProxyType

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harborline.contract import CASCADING_PARENT, CONTRACT, REJECT, Table, known
from harborline.operators import keysets
from harborline.operators.parsing import ISO, found_sql, once_sql, parsed_sql, strip_sql, title_sql
from harborline.operators.storage import staged
from harborline.operators.validate import findings

KEY_REASONS = "_key_reasons"  # column of a raw frame with the reasons that its keys give

# What of a judged frame is written: all of it, the verdicts, what the clean and the rejected layer show of a row, or
# what the clean layer alone shows.
WHOLE = ("raw", "value", "changed", "reasons")
VERDICTS = ("changed", "reasons")
LAYERS = ("CASE WHEN size(reasons) > 0 THEN raw END AS raw", "CASE WHEN size(reasons) = 0 THEN value END AS value",
          "changed", "reasons")
RETAINED = LAYERS[1:]


@dataclass(frozen=True)
class Cleaned:
    """Result of cleaning a bundle."""

    judged: dict[str, DataFrame]

    @property
    def clean(self) -> dict[str, DataFrame]:
        return {name: clean_rows(CONTRACT[name], df) for name, df in self.judged.items()}

    @property
    def rejected(self) -> dict[str, DataFrame]:
        return {name: rejected_rows(df) for name, df in self.judged.items()}

    @property
    def summary(self) -> DataFrame:
        return summary(self.judged)


def normalise(table: Table, raw: DataFrame, formats: Mapping[str, str] = MappingProxyType({})) -> DataFrame:
    """Raw struct, normalised struct, ``changed`` and the reasons one row gives by itself.

    ``formats`` names the formats of date columns that are not ISO. ``raw`` carries ``source_row``. Extra columns pass through.
    """
    missing = [c for c in table.columns if c not in raw.columns]
    if missing:
        raise ValueError(f"{table.name} is missing required columns: {', '.join(missing)}")
    carried = ["source_row", *[c for c in raw.columns if c == KEY_REASONS]]
    given = [c for c in raw.columns if c not in carried]
    # Each step is a projection of plain columns that the next one refers to more than
    # once, so Catalyst keeps the steps apart and evaluates every parser once per row.
    stripped = raw.selectExpr(
        *carried, f"struct({', '.join(given)}) AS raw",
        *[f"{strip_sql(c)} AS s_{c}" for c in table.columns],
    )
    edges = " OR ".join(f"NOT (raw.{c} <=> s_{c})" for c in table.columns)
    texts = stripped.selectExpr(
        *carried, "raw", f"{edges} AS edged",
        *[f"CASE WHEN s_{c} <> '' THEN s_{c} END AS t_{c}" for c in table.columns],
    )
    typed = texts.selectExpr(
        *carried, "raw", "edged",
        *[f"t_{f.name}" for f in table.fields if f.kind != "string"],
        *[f"{parsed_sql('t_' + f.name, f.kind, formats.get(f.name, ISO))} AS v_{f.name}" for f in table.fields],
        *([f"{title_sql('t_' + table.title_cased)} AS cased"] if table.title_cased else []),
    )
    # Order of the reasons: types by column, then missing values by column, then
    # negative numbers, date order, duplicate key and parents.
    reasons = [(f"t_{f.name} IS NOT NULL AND v_{f.name} IS NULL", f"invalid_type:{f.name}")
               for f in table.fields if f.kind != "string"]
    reasons += [(f"v_{f.name} IS NULL", f"null_required:{f.name}") for f in table.fields if not f.optional]
    reasons += [(f"v_{c} < 0", f"negative_value:{c}") for c in table.non_negative]
    if table.ordered_dates:
        first, second = table.ordered_dates
        reasons.append((f"v_{second} < v_{first}", "delivered_before_shipped"))
    changed = ["edged"] + [f"v_{f.name} IS NULL" for f in table.fields if f.default is not None]
    final = {f.name: f"v_{f.name}" if f.default is None else f"coalesce(v_{f.name}, '{f.default}')"
             for f in table.fields}
    if table.title_cased:
        changed.append(f"coalesce(cased <> v_{table.title_cased}, false)")
        final[table.title_cased] = "cased"
    final.update({c: f"raw.{c}" for c in given if c not in table.columns})
    values = ", ".join(f"{e} AS {c}" for c, e in final.items())
    found = found_sql([(condition, f"'{text}'") for condition, text in reasons], "STRING")
    found = f"concat({found}, array_compact({KEY_REASONS}))" if KEY_REASONS in carried else found
    # Rows are filtered by their reasons, which every parser takes part in.
    return typed.selectExpr(
        "source_row", "raw", f"struct({values}) AS value", f"{' OR '.join(changed)} AS changed",
        f"{once_sql(found, 'CAST(array() AS ARRAY<STRING>)')} AS reasons",
    )


@dataclass(frozen=True)
class KeyStatus:
    """The keys of a judged table that any row has (if its children ask for them), and those that a retained row has."""

    given: keysets.KeySet | None
    retained: keysets.KeySet


def key_status(table: Table, judged: DataFrame) -> KeyStatus:
    """The keys of a judged table; they become bitmaps, so they may repeat."""
    key = "key" if "key" in judged.columns else f"value.{table.key}"
    given = judged.selectExpr(f"{key} AS k", "reasons").filter("k IS NOT NULL")
    retained = keysets.key_set(given.filter("size(reasons) = 0").select("k"), "k")
    return KeyStatus(keysets.key_set(given.select("k"), "k") if table.name == CASCADING_PARENT else None, retained)


def _firsts(table: Table, df: DataFrame) -> DataFrame:
    """The first row in file order of each key that repeats."""
    keys = df.selectExpr("source_row", f"{key_sql(table.key)} AS _own")
    return staged(keysets.repeated(keys, "_own").groupBy("_own").agg(F.min("source_row").alias("_first")), "firsts")


def _with_duplicates(table: Table, df: DataFrame, firsts: DataFrame) -> DataFrame:
    """Mark in ``_repeats`` all rows of a key after its first one, whatever became of the first, by the key itself."""
    # Rows without a key get a value of their own, so they do not meet in one task if the firsts are many. It starts
    # with a NUL character and a line number, which no key has.
    own = F.coalesce(F.expr(key_sql(table.key)), F.concat(F.expr("char(0)"), F.col("source_row").cast("string")))
    marked = df.withColumn("_key", own).join(firsts, F.col("_key") == F.col("_own"), "left")
    return marked.select(*df.columns, F.coalesce(F.col("source_row") > F.col("_first"), F.lit(False)).alias("_repeats"))


def key_sql(column: str) -> str:
    """The key that a raw text stands for: stripped, null if nothing is left."""
    return f"nullif({strip_sql(column)}, '')"


def with_key_reasons(table: Table, raw: DataFrame, statuses: Mapping[str, KeyStatus]) -> DataFrame:
    """A raw frame with ``KEY_REASONS``: repeated keys, then parents that are missing or not retained.

    Keys that repeat are found on hashes, and the lines after the first of a key become a set of bitmaps like the parents,
    so rows are marked where they lie and are not shuffled; only sets too large for a broadcast make the planner shuffle
    rows, which are raw at this point.

    Reasons belong to lines: rows that share a line number share the reasons of all of them, one row for each, and
    rows without a line number have none.
    """
    keys = raw.selectExpr("source_row", f"{key_sql(table.key)} AS _own")
    repeats = keysets.key_set(keysets.after_first(keys, "_own", "source_row"), "source_row")
    marked = _with_marks(table, keysets.with_members(raw, "source_row", repeats, "_repeats"), statuses)
    # ``array_compact`` changes nothing here. Spark does not compile it with its neighbours, so the code of joins and
    # parsers, which together would be too long for the JIT, is cut at this column (and once more in ``normalise``).
    own = f"CASE WHEN source_row IS NULL THEN slice({KEY_REASONS}, 1, 0) ELSE array_compact({KEY_REASONS}) END"
    lines = keysets.repeated_numbers(raw, "source_row")
    if lines is not None:
        few = _with_duplicates(table, raw.join(lines, "source_row", "left_semi"), _firsts(table, raw))
        shared = _with_marks(table, few, statuses).filter(f"size({KEY_REASONS}) > 0")
        shared = staged(shared.selectExpr("source_row AS _line", f"{KEY_REASONS} AS _shared"), "shared-reasons")
        marked = marked.join(shared, F.col("source_row") == F.col("_line"), "left")
        own = own.replace("ELSE", "WHEN _shared IS NOT NULL THEN _shared ELSE")
    return marked.select(*raw.columns, F.expr(own).alias(KEY_REASONS))


def _with_marks(table: Table, df: DataFrame, statuses: Mapping[str, KeyStatus]) -> DataFrame:
    """A raw frame with ``_repeats`` and the reasons that each row's own keys give."""
    marks = [("_repeats", f"'duplicate_primary_key:{table.key}'")]
    extra = ["_repeats"]
    for column, status in statuses.items():
        key, kept, known_key = f"_p_{column}", f"_kept_{column}", f"_known_{column}"
        df = df.withColumn(key, F.expr(key_sql(column)))
        df = keysets.with_members(df, key, status.retained, kept)
        reason = f"'orphan_foreign_key:{column}'"
        extra += [key, kept]
        if table.parents[column] == CASCADING_PARENT:
            df = keysets.with_members(df, key, status.given, known_key)
            reason = f"CASE WHEN {known_key} THEN 'cascade_parent_order_rejected' ELSE {reason} END"
            extra.append(known_key)
        marks.append((f"{key} IS NOT NULL AND NOT {kept}", reason))
    return df.withColumn(KEY_REASONS, F.expr(found_sql(marks, "STRING"))).drop(*extra)


def judge(tables: Mapping[str, DataFrame], stage: bool = False,
          formats: Mapping[str, Mapping[str, str]] = MappingProxyType({}), keep: Sequence[str] = WHOLE,
          leaves: bool = True) -> dict[str, DataFrame]:
    """Judged frame per table; parents are judged before their children.

    Each raw frame carries a unique ``source_row`` that follows the file order. Keys of parents and repeated keys are
    written to the shared folder when their children are judged. With ``stage`` every judged frame is written there
    too, so that it is computed once although its children and several results read it; ``keep`` says what of it.
    Without ``leaves`` those that no other table refers to are left out, for a caller that reads each of them once.
    """
    known(tables)
    judged: dict[str, DataFrame] = {}
    keyed: dict[str, DataFrame] = {}
    status: dict[str, KeyStatus] = {}
    for name, table in CONTRACT.items():
        if name not in tables:
            continue
        parents = {c: p for c, p in table.parents.items() if p in judged}
        for parent in set(parents.values()) - set(status):
            status[parent] = key_status(CONTRACT[parent], keyed[parent])
        raw = with_key_reasons(table, tables[name], {c: status[p] for c, p in parents.items()})
        df = normalise(table, raw, formats.get(name, {}))
        referred = any(name in CONTRACT[child].parents.values() for child in tables)
        if stage and (leaves or referred):
            own = [f"value.{table.key} AS key"] if referred else []
            # The key of a rejected row is kept apart, because ``keep`` may leave out its value.
            keyed[name] = staged(df.selectExpr("source_row", *keep, *own), f"judged-{name}")
            judged[name] = keyed[name].drop("key")
        else:
            judged[name] = df
            keyed[name] = df
    return judged


def clean_rows(table: Table, judged: DataFrame) -> DataFrame:
    """Normalised values of the retained rows."""
    return judged.filter(F.size("reasons") == 0).select("value.*")


def rejected_rows(judged: DataFrame) -> DataFrame:
    """Raw values (if they were kept) of the rejected rows with their position and reasons."""
    given = ["raw.*"] if "raw" in judged.columns else []
    return judged.filter(F.size("reasons") > 0).select(
        "source_row", *given, F.concat_ws("; ", "reasons").alias("reject_reason")
    )


def summary(judged: Mapping[str, DataFrame]) -> DataFrame:
    """Rows before, after, fixed and rejected per table, and in total."""
    bad = F.size("reasons") > 0
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("rows_before"),
            F.count_if(~bad).alias("rows_after"),
            F.count_if(F.col("changed") & ~bad).alias("fixed"),
            F.count_if(bad).alias("rejected"),
        ).select(F.lit(name).alias("table"), "*")
        for name, df in judged.items()
    ]
    counts = ["rows_before", "rows_after", "fixed", "rejected"]
    per_table = reduce(DataFrame.union, parts)
    return per_table.rollup("table").agg(*[F.sum(c).alias(c) for c in counts]).withColumn(
        "table", F.coalesce("table", F.lit("TOTAL"))
    )


def clean(tables: Mapping[str, DataFrame], stage: bool = True,
          formats: Mapping[str, Mapping[str, str]] = MappingProxyType({}), keep: Sequence[str] = LAYERS,
          leaves: bool = True) -> Cleaned:
    """Judge all tables of a bundle; ``formats`` as found by ``date_formats``, ISO where it names none.

    ``keep`` and ``leaves`` are those of ``judge``; with ``RETAINED`` the rejected rows lack their values.
    """
    return Cleaned(judge(tables, stage, formats, keep, leaves))


def reject_findings(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of clean output that break a reject rule when it is validated again, as one row ``reject_findings``."""
    as_text = {
        name: df.select(
            *[F.col(c).cast("string").alias(c) for c in df.columns],
            F.monotonically_increasing_id().alias("data_row"),
        )
        for name, df in tables.items()
    }
    return findings(as_text).filter(F.col("severity") == REJECT).agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("reject_findings"))


def assert_clean(tables: Mapping[str, DataFrame]) -> None:
    """Validate clean output again; raise if a reject-severity finding is left."""
    left = reject_findings(tables).first()["reject_findings"]
    if left:
        raise RuntimeError(f"clean output still has {left} rows that break a reject rule")

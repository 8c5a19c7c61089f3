"""The load job: read, clean, judge, and only then publish."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillgrain.model import UNFIT, as_delivered
from tillgrain.operators import clean, rfm
from tillgrain.operators.keys import keep_first, keep_first_reread
from tillgrain.operators.quality import (
    ConstraintViolation, KeyCounts, broken_constraints, constraint_report, gate, quality_report)
from tillgrain.plans.views import register_views
from tillgrain.session import pin, scratch_path, shuffles_dropped
from tillgrain.sources.flatfiles import (
    BROKEN, JUDGED, SEQUENCE, BrokenRecords, UnfitValue, as_judged, fits, narrowed, read_all_delivered,
    to_stored_places)
from tillgrain.sources.snapshots import Draft
from tillgrain.sources.star import Star
from tillgrain.sources.warehouse import SCORES, open_star, read_table, write_report, write_table

FITS = " fits its column"


def run_load(spark: SparkSession, delivered: str, warehouse: str, reports: str | None = None,
             as_of: dt.date | str | None = None, multi_line: bool = False,
             quarantine: str | None = None) -> Star:
    """Load delivered files into the warehouse folder and register the views.

    Tables are cleaned into a new version of the warehouse, in the layout in which they are read later.
    Then the rules and the model's constraints judge them. A failing rule, a row that breaks a constraint,
    an amount that its column can't store, dates of several forms, and a record with too few or
    too many fields stop the load, and readers keep the version before. With a ``quarantine`` folder such
    records are written there instead, and the others loaded. Files with line breaks inside of quotes
    need ``multi_line``.
    """
    with shuffles_dropped(spark):
        _publish(spark, delivered, warehouse, reports, as_of, multi_line, quarantine)
    star = open_star(spark, warehouse)
    register_views(spark, star, as_of)
    return star


def _publish(spark: SparkSession, delivered: str, warehouse: str, reports: str | None,
             as_of: dt.date | str | None, multi_line: bool, quarantine: str | None) -> None:
    raw = read_all_delivered(spark, delivered, multi_line, wide=True, broken=True)
    came = {t: survey(t, raw[t]) for t in raw}
    _broken_records(raw, {t: n["broken"] for t, n in came.items()}, quarantine)
    draft = Draft(spark, warehouse)
    try:
        staged = _staged(
            spark, raw | {t: to_stored_places(raw[t], t) for t in JUDGED}, list(SEQUENCE),
            {t: n["form"] for t, n in came.items()}, draft.path)
        judged = staged | {t: as_judged(staged[t]) for t in JUDGED}
        # The keys of the judged tables are the staged ones.
        keys = KeyCounts(staged)
        report = pin(quality_report(judged, as_of, keys))
        if reports:
            write_report(_rows_removed(spark, came, staged), reports, "rows_removed")
            write_report(report.coalesce(1), reports, "data_quality_report")
        gate(report)
        _promises(staged, reports, keys)
        tables = {t: df.drop(UNFIT) for t, df in staged.items()}
        write_table(rfm.stored_scores(Star(**tables)), draft.path(SCORES), SCORES)
    except BaseException:
        draft.discard()
        raise
    draft.publish()


def judge_delivered(spark: SparkSession, delivered: str, reports: str,
                    as_of: dt.date | str | None = None, multi_line: bool = False) -> DataFrame:
    """The quality rules on the files as they were delivered, without cleaning or loading."""
    raw = {t: df.drop(*SEQUENCE)
           for t, df in read_all_delivered(spark, delivered, multi_line, wide=True).items()}
    report = pin(quality_report(raw, as_of))
    write_report(report.coalesce(1), reports, "data_quality_report")
    return report


def survey(table: str, raw: DataFrame) -> dict:
    """One look at a delivered table: its records, broken ones among them, and the form of its dates."""
    broken = F.col(BROKEN).isNotNull() if BROKEN in raw.columns else F.lit(False)
    column = clean.DATES.get(table, raw.columns[0])
    dates = F.when(~broken, F.col(column).cast("string"))
    if table in clean.DATES:
        texts = raw.groupBy(dates.alias("_text"), broken.alias("_broken")).agg(F.count(F.lit(1)).alias("_rows"))
        found = F.col("_rows")
        counts = texts.agg(
            F.coalesce(F.sum(found), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("_broken"), found)), F.lit(0)).alias("broken"),
            *clean.form_counts(F.col("_text"), found)).first()
    else:
        counts = raw.agg(F.count(F.lit(1)).alias("rows"), F.count_if(broken).alias("broken"),
                         F.count(dates)).first()
    form = clean.elected(counts, column) if table in clean.DATES else "ISO"
    return {"rows": counts["rows"], "broken": counts["broken"], "form": form}


def _broken_records(raw: dict[str, DataFrame], broken: dict[str, int], quarantine: str | None) -> None:
    """Stop at broken records, or write them out; a file is read again only if it has some."""
    found = {t: n for t, n in broken.items() if n}
    if not found:
        return
    if quarantine is None:
        raise BrokenRecords("too few or too many fields: " + ", ".join(
            f"{n} records of {t}" for t, n in found.items()))
    rows = None
    for table in found:
        # The text alone can't be read: Spark needs a column of the file beside it.
        first = as_delivered(table).names[0]
        own = (raw[table].where(F.col(BROKEN).isNotNull())
               .select(F.col(first).cast("string").alias("first_value"), F.lit(table).alias("table_name"), F.col("_file").alias("file"),
                       F.col(BROKEN).alias("record")))
        rows = own if rows is None else rows.unionByName(own)
    rows.write.mode("overwrite").parquet(f"{quarantine}/broken_records")


def _rows_removed(spark: SparkSession, came: dict[str, dict], staged: dict[str, DataFrame]
                  ) -> DataFrame:
    """Rows before, after and removed per table; stored files know their number of rows."""
    lines = [(t, n["rows"], staged[t].count()) for t, n in came.items()]
    return spark.createDataFrame(
        [(t, before, after, before - after) for t, before, after in lines],
        "table_name string, rows_before bigint, rows_after bigint, rows_removed bigint").coalesce(1)


def _promises(staged: dict[str, DataFrame], reports: str | None, keys: KeyCounts) -> None:
    """Stop if a row breaks a constraint or holds a number that its column can't store."""
    more = {t: {f"{c}{FITS}": ok for c, ok in fits(staged[t]).items()} for t in JUDGED}
    report = pin(constraint_report(staged, more, keys))
    if reports:
        write_report(report.coalesce(1), reports, "constraint_report")
    broken = broken_constraints(report)
    unfit = {rule: n for rule, n in broken.items() if rule.endswith(FITS)}
    if unfit:
        table = next(iter(unfit)).split(":")[0]
        raise UnfitValue(f"{table} has values that its columns can't store: " + ", ".join(
            f"{n} in {rule.removeprefix(f'{table}: ').removesuffix(FITS)}" for rule, n in unfit.items()))
    if broken:
        raise ConstraintViolation("broken constraints: " + "; ".join(
            f"{rule} ({n} rows)" for rule, n in broken.items()))


def clean_and_stage(spark: SparkSession, raw: dict[str, DataFrame],
                    sequence: list[str] | None = None) -> dict[str, DataFrame]:
    """Clean parents before children, each child against the stored parent."""
    folder = scratch_path(spark, "staged")
    return _staged(spark, raw, list(sequence or SEQUENCE), {}, lambda t: f"{folder}/{t}")


def rows_removed(spark: SparkSession, raw: dict[str, DataFrame], sequence: list[str] | None = None
                 ) -> DataFrame:
    """What cleaning takes out of each table."""
    came = {t: survey(t, df) for t, df in raw.items()}
    return _rows_removed(spark, came, clean_and_stage(spark, raw, sequence))


def _staged(spark: SparkSession, raw: dict[str, DataFrame], seq: list[str], forms: dict[str, str],
            path) -> dict[str, DataFrame]:
    """The cleaned tables, written and read back."""
    done: dict[str, DataFrame] = {}

    def kept(table: str, cleaned) -> None:
        df, from_files = raw[table], BROKEN in raw[table].columns
        if from_files:
            df = df.where(F.col(BROKEN).isNull()).drop(BROKEN)
        df = cleaned(df, forms.get(table, "ISO")).drop(*seq)
        if table in JUDGED and from_files:
            df = narrowed(df, table)
        write_table(df, path(table), table)
        done[table] = spark.read.parquet(path(table)).drop("order_month")

    kept("date_dimension", lambda df, form: clean.clean_calendar(df, form))
    kept("customers", lambda df, form: clean.clean_customers(df, seq, form))
    kept("products", lambda df, form: clean.clean_products(df, seq))
    kept("employees", lambda df, form: clean.clean_employees(df, seq, form))
    # Files can be read again at little cost, other frames may be joins.
    first = keep_first_reread if BROKEN in raw["orders"].columns else keep_first
    kept("orders", lambda df, form: clean.clean_orders(
        df, done["customers"], done["products"], done["employees"], seq, form, first))
    kept("returns", lambda df, form: clean.clean_returns(df, done["orders"], seq, form, first))
    kept("targets", lambda df, form: clean.clean_targets(df, done["employees"], seq))
    return done

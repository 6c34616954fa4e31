"""Interval packing: maximal runs of records per key with a grace window.

Two records of one key belong to the same run when the later one starts no
more than ``grace_days`` after the latest end seen so far (running maximum,
not the previous row's end). A run's end is the latest raw end in it.

Plan shape (skew-safe by construction)
--------------------------------------
1. Records become day rows: one row per (keys, start day), with counts, latest
   end and summed length. Records with one start day always share a run, so
   this loses nothing. Every exchange on the way follows a map-side partial
   aggregate, so a hot ``(key, day)`` arrives as at most one row per map task.
   Where ids are counted, a first aggregate by ``(keys, start, id)`` leaves one
   row for each id; its exchange hashes on the id as well, which spreads a hot
   ``(key, day)`` over all tasks and collapses copies before they travel.
2. A window ``partitionBy(keys).orderBy(start)`` over those day rows numbers
   the runs. Its per-key input is bounded by the number of distinct start
   days of that key (a calendar bound: ~36,500 rows for a century of daily
   records), times the number of split values where the rows are numbered at
   a split grain, never by the number of records, so no task holds an
   unbounded group.
3. Eras are taken from the last row of each run by windows that reuse the
   partitioning and order of the first: no further exchange, and no hash table
   of eras. A split adds one sort by ``(keys, era_seq, split, start)``.

Row-level outputs (:func:`pack_intervals`, :func:`assign_era_end`,
:func:`attach_run_ends`) deal the records once, by ``(keys, start, salt)``. The
numbered rows are made from that exchange, and come back to it by an equi-join
on the same columns, so the source is read once and its rows move once. The
salt (a hash of the record) cuts a hot ``(key, day)`` into ``ROW_SALTS`` parts.

Over a stored table (``weigh=True``) the keys are counted first, by bucket, in one
more read of their columns. Records of keys that hold no more than a 1,024th of all
move once, by their keys, and all else is done where they lie; only those of heavier
keys take the exchanges above. Both ways give the same rows.

Preconditions: ``start`` and ``end`` are DATE columns and ``end >= start``
(the target builders quarantine or clamp other rows). Rows with a NULL key,
start or end are dropped, as the equality joins of the SQL original drop them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanpack.functions.dates import covered_days, days_between, opens_new_run
from spanpack.operators.spread import split_by_weight

# internal column names
N = "_n"
N_INTERVALS = "_n_intervals"
DAY_END = "_day_end"
LEN = "_len"
PREV = "_prev_end"
OPEN = "_open"
COVERED = "_covered"
SEQ = "era_seq"
TYPED = "_typed"
SALT = "_salt"

#: What day rows count by id: records (``ids``), record intervals (``intervals``).
MEASURES = ("ids", "intervals")
#: Interval lengths in days, from 0, that an id's row holds as bits of a long.
LENGTH_BITS = 64
#: Parts into which the records of one (key, day) are dealt at row level.
ROW_SALTS = 1024
# grains that an id is counted at
_IDS, _INTERVALS, _SPLIT_IDS = 0, 1, 2


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def drop_null_keys(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Remove rows that can never join a run (NULL key, start or end).

    Applied before any exchange so NULL keys cannot form a skewed partition.
    """
    cond = F.lit(True)
    for c in [*keys, start, end]:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def day_summary(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    split: str | None = None,
    id_col: str | None = None,
    measures: Sequence[str] = MEASURES,
    plain: bool | None = None,
) -> DataFrame:
    """One row per (keys, start day[, split]): record count, latest end, number
    and summed length of the record intervals. Partial aggregation runs before
    each shuffle.

    With ``id_col`` a record id counts once per (keys, start[, split]), with
    its latest end; intervals count once per id and end. ``measures`` names
    what is asked for (counts not asked for are 0). ``plain`` and ``split``
    together give rows at both grains, marked by ``TYPED``: an id under two
    split values counts once in the plain rows and once for each value in the
    others. By default ``plain`` is the grain without ``split``."""
    group = [*keys, start, *([split] if split else [])]
    if id_col is None:
        return df.groupBy(*group).agg(
            F.count(F.lit(1)).alias(N),
            F.max(end).alias(DAY_END),
            F.count(F.lit(1)).alias(N_INTERVALS),
            F.sum(days_between(start, end)).alias(LEN),
        )
    plain = split is None if plain is None else plain
    grains = [_SPLIT_IDS] if split else []
    if plain:
        grains += [g for g, name in ((_IDS, "ids"), (_INTERVALS, "intervals")) if name in measures]
    if not grains:
        raise ValueError(f"measures must name some of {MEASURES}")
    return _counted_by_id(df, keys, start, end, split, id_col, grains)


def _counted_by_id(
    df: DataFrame, keys: Sequence[str], start: str, end: str, split: str | None, id_col: str, grains: list[int]
) -> DataFrame:
    """One aggregate leaves an id once, a second one makes the day rows."""
    intervals = _INTERVALS in grains
    rows = _rows_by_grain(df, keys, start, end, split, id_col, grains)
    once = ["_grain", "_of_end", *(["_split"] if split else [])]
    lengths = [F.bit_or("_lengths").alias("_lengths")] if intervals else []
    per_id = rows.groupBy(*keys, start, id_col, *once).agg(F.max(end).alias(DAY_END), *lengths)
    long = F.col("_of_end").isNotNull()
    n_intervals, summed = F.lit(0), F.lit(0).cast("long")
    if intervals:
        n_intervals = F.when(long, 1).otherwise(F.bit_count("_lengths"))
        summed = F.when(long, days_between(start, DAY_END)).otherwise(_sum_of_bits(F.col("_lengths")))
    marks = []
    if split:
        marks = [F.col("_split").alias(split)]
        marks += [(F.col("_grain") == _SPLIT_IDS).alias(TYPED)] if len(grains) > 1 else []
    return per_id.groupBy(*keys, start, *marks).agg(
        F.sum(F.when(F.col("_grain") == _INTERVALS, 0).otherwise(1)).alias(N),
        F.max(DAY_END).alias(DAY_END),
        F.sum(n_intervals).alias(N_INTERVALS),
        F.sum(summed).alias(LEN),
    )


def _rows_by_grain(
    df: DataFrame, keys: Sequence[str], start: str, end: str, split: str | None, id_col: str, grains: list[int]
) -> DataFrame:
    """The records as they are counted by id.

    The intervals of an id are its different lengths: those below ``LENGTH_BITS``
    days are bits of one number in the id's row, so that a record travels once
    however much is counted of it. A longer one stands as a row of its own for
    each end, and an id under a split value as a row for each value."""
    types = {f.name: f.dataType for f in df.schema}
    no_end, intervals = F.lit(None).cast(types[end]), _INTERVALS in grains
    days = days_between(start, end)
    dates = isinstance(types[start], T.DateType) and isinstance(types[end], T.DateType)
    short = days.between(0, LENGTH_BITS - 1) if dates else F.lit(False)
    bit = F.when(short, F.call_function("shiftleft", F.lit(1).cast("long"), days.cast("int"))).otherwise(F.lit(0).cast("long"))

    def row(grain: int, of_end=no_end, bits=F.lit(0).cast("long")) -> list:
        cols = [F.lit(grain).alias("_grain"), of_end.alias("_of_end")]
        cols += [bits.alias("_lengths")] if intervals else []
        return cols + ([(F.col(split) if grain == _SPLIT_IDS else F.lit(None).cast(types[split])).alias("_split")] if split else [])

    always = []
    if _IDS in grains:
        always.append(row(_IDS, bits=bit))
    elif intervals:
        always.append(row(_INTERVALS, F.when(~short, F.col(end)), bit))
    if _SPLIT_IDS in grains:
        always.append(row(_SPLIT_IDS))
    at_times = [row(_INTERVALS, F.col(end))] if intervals and _IDS in grains else []
    base = [*keys, start, end, id_col]
    if len(always) == 1 and not at_times:
        return df.select(*base, *always[0])
    stands = [F.struct(*r) for r in always]
    standing = F.array(*stands)
    if at_times:
        standing = F.when(short, standing).otherwise(F.array(*stands, F.struct(*at_times[0])))
    return df.select(*base, F.inline(standing))


def _sum_of_bits(bits: Column) -> Column:
    """The sum of the positions of a number's set bits."""
    total = F.lit(0).cast("long")
    for j in range(LENGTH_BITS.bit_length() - 1):
        mask = sum(1 << i for i in range(LENGTH_BITS) if i >> j & 1)
        mask -= (1 << 64) if mask >> 63 else 0
        total = total + F.bit_count(bits.bitwiseAND(F.lit(mask).cast("long"))) * (1 << j)
    return total


def number_runs(days: DataFrame, keys: Sequence[str], start: str, grace_days: int) -> DataFrame:
    """Add ``era_seq`` (1-based run number per key, in time order), the running
    maximum end before each row and the days each row adds to the covered set."""
    order = Window.partitionBy(*keys).orderBy(F.col(start), F.col(DAY_END))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        days.withColumn(PREV, F.max(DAY_END).over(before))
        .withColumn(OPEN, opens_new_run(start, F.col(PREV), grace_days).cast("int"))
        .withColumn(SEQ, F.sum(OPEN).over(upto))
        .withColumn(COVERED, covered_days(start, DAY_END, F.col(PREV)))
    )


def numbered_day_rows(
    df: DataFrame,
    keys: str | Sequence[str],
    start: str,
    end: str,
    grace_days: int = 30,
    split: str | None = None,
    id_col: str | None = None,
    measures: Sequence[str] = MEASURES,
    plain: bool | None = None,
) -> DataFrame:
    """Day rows (see :func:`day_summary`) with their run number: the shared
    input of :func:`collapse_eras`. Rows numbered with ``split`` also serve the
    unsplit eras: without ``id_col`` their counts add up, with it ``plain=True``
    carries the unsplit counts as rows of their own."""
    keys = _keys(keys)
    clean = drop_null_keys(df, keys, start, end)
    days = day_summary(clean, keys, start, end, split, id_col, measures, plain)
    return number_runs(days, keys, start, grace_days)


def collapse_eras(numbered: DataFrame, keys: str | Sequence[str], start: str, split: str | None = None) -> DataFrame:
    """Eras from :func:`numbered_day_rows` (see :func:`summarize_eras` for the
    columns). ``split`` must be None or the split the rows were numbered with.

    The rows already lie in time order, so running totals taken at the last row
    of each run give the eras; a hash table of them would hold nearly as many
    groups as rows where most runs are short."""
    keys = _keys(keys)
    both = TYPED in numbered.columns
    if split is None:
        count = F.when(F.col(TYPED), 0).otherwise(F.col(N)) if both else F.col(N)
        sums = {"record_count": count, "interval_count": F.col(N_INTERVALS), "sum_days": F.col(LEN), "covered_days": F.col(COVERED)}
        order = Window.partitionBy(*keys).orderBy(F.col(start), F.col(DAY_END))
        upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        following = F.lead(SEQ).over(order)
        latest = F.max(F.struct(F.col(SEQ), F.col(DAY_END))).over(upto)
        last = numbered.select(
            *keys, SEQ, start, DAY_END,
            F.max(F.when(F.col(OPEN) == 1, F.col(start))).over(upto).alias("era_start"),
            latest.alias("_latest"),
            *[F.sum(c).over(upto).alias(name) for name, c in sums.items()],
            (following.isNull() | (following != F.col(SEQ))).alias("_last"),
        ).where("_last")
        # totals so far, less those at the end of the run before
        return last.select(
            *keys, SEQ, "era_start", F.col("_latest")[DAY_END].alias("era_end"),
            *[(F.col(name) - F.coalesce(F.lag(name).over(order), F.lit(0).cast("long"))).alias(name) for name in sums],
        )
    rows = numbered.where(TYPED) if both else numbered
    # one sort serves both windows
    run = Window.partitionBy(*keys, SEQ).orderBy(split, start)
    part = Window.partitionBy(*keys, SEQ, split).orderBy(start)
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.select(
        *keys, SEQ, split, F.col(start).alias("era_start"),
        F.sum(N).over(part.rowsBetween(*whole)).alias("record_count"),
        F.max(DAY_END).over(run.rowsBetween(*whole)).alias("era_end"),
        F.row_number().over(part).alias("_nth"),
    ).where(F.col("_nth") == 1).drop("_nth")


def summarize_eras(
    df: DataFrame,
    keys: str | Sequence[str],
    start: str,
    end: str,
    grace_days: int = 30,
    split: str | None = None,
    id_col: str | None = None,
    measures: Sequence[str] = MEASURES,
    weigh: bool = False,
) -> DataFrame:
    """Era table: one row per (keys, run[, split]).

    Columns: ``keys``, [``split``], ``era_seq``, ``era_start``, ``era_end``,
    ``record_count``, and without ``split`` also ``interval_count``,
    ``sum_days`` (summed interval lengths) and ``covered_days`` (length of the
    union of the records).

    Without ``id_col`` every row is a record and an interval. With it, rows
    that repeat an id, key and start are one record that lasts to its latest
    end; each different end is an interval of its own. ``measures`` then says
    which of ``record_count`` (``ids``) and ``interval_count`` with
    ``sum_days`` (``intervals``) are wanted; asking for one saves work, and the
    other is 0.

    With ``split`` the run boundaries ignore the split column; each run is
    reported once per split value present in it, with the run's end and the
    earliest start *of that split value* (rows of one run share the end and
    may overlap in time).

    ``weigh`` is for a table that is cheap to read again, as a stored one is:
    records travel once, by their keys, unless these are heavy.
    """
    def eras(rows: DataFrame) -> DataFrame:
        numbered = numbered_day_rows(rows, keys, start, end, grace_days, split, id_col, measures)
        return collapse_eras(numbered, keys, start, split)

    if not weigh:
        return eras(df)
    keys = _keys(keys)
    used = list(dict.fromkeys([*keys, start, end, *[c for c in (split, id_col) if c]]))
    ((light, heavy),) = split_by_weight([drop_null_keys(df, keys, start, end).select(*used)], keys)
    return eras(light.repartition(*keys)).unionByName(eras(heavy))


def era_end_dates(
    df: DataFrame, keys: str | Sequence[str], start: str, end: str, grace_days: int = 30
) -> DataFrame:
    """The distinct end dates of the runs of each key: (keys, era_end_date)."""
    keys = _keys(keys)
    numbered = numbered_day_rows(df, keys, start, end, grace_days)
    return collapse_eras(numbered, keys, start).select(*keys, F.col("era_end").alias("era_end_date"))


def _salted(df: DataFrame, keys: list[str], start: str) -> DataFrame:
    """Records dealt by (keys, start, salt), with the salt. The hash takes in
    every column that can be hashed, so an exchange of the same records is the
    same exchange whatever is read from it, and Spark runs it once."""
    plain = [f.name for f in df.schema if not _unhashable(f.dataType)]
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), F.lit(ROW_SALTS))
    # never NULL; said here so that no branch infers it for itself and differs from the other
    return df.repartition(*keys, start, salt).withColumn(SALT, salt).where(F.col(SALT).isNotNull())


def _unhashable(dtype: T.DataType) -> bool:
    text = dtype.simpleString()
    return "map<" in text or "variant" in text


def _attach(dealt: DataFrame, found: DataFrame, keys: list[str], start: str, columns: list[str], how: str = "inner") -> DataFrame:
    """``columns`` of ``found`` (a row per keys, start and salt) at the records."""
    mine = [c for c in dealt.columns if c != SALT]
    on = [*keys, start, SALT]
    right = found.select(*[F.col(c).alias(f"_at_{i}") for i, c in enumerate(on)], *[F.col(c).alias(f"_new_{c}") for c in columns])
    match = F.lit(True)
    for i, c in enumerate(on):
        match = match & (dealt[c] == right[f"_at_{i}"])
    joined = dealt.join(right, match, how)
    return joined.select(*[dealt[c] for c in mine], *[F.col(f"_new_{c}").alias(c) for c in columns])


def _runs_of_records(df: DataFrame, keys: list[str], start: str, end: str, grace_days: int) -> tuple[DataFrame, DataFrame]:
    """The records, dealt, and (keys, start, salt) -> run number and run end."""
    dealt = _salted(drop_null_keys(df, keys, start, end), keys, start)
    days = dealt.groupBy(*keys, start, SALT).agg(F.max(end).alias(DAY_END))
    run = Window.partitionBy(*keys, SEQ)
    numbered = number_runs(days, keys, start, grace_days)
    return dealt, numbered.withColumn("era_end_date", F.max(DAY_END).over(run))


def pack_intervals(
    df: DataFrame,
    keys: str | Sequence[str],
    start: str,
    end: str,
    grace_days: int = 30,
    seq_col: str = "era_seq",
) -> DataFrame:
    """Every record with the number of its run (``seq_col``, 1-based per key)."""
    keys = _keys(keys)
    dealt, runs = _runs_of_records(df, keys, start, end, grace_days)
    return _attach(dealt, runs.withColumnRenamed(SEQ, seq_col), keys, start, [seq_col])


def assign_era_end(
    df: DataFrame,
    keys: str | Sequence[str],
    start: str,
    end: str,
    grace_days: int = 30,
    end_col: str = "era_end_date",
) -> DataFrame:
    """Every record with the end date of its run (the earliest run end on or
    after its start)."""
    keys = _keys(keys)
    dealt, runs = _runs_of_records(df, keys, start, end, grace_days)
    return _attach(dealt, runs.withColumnRenamed("era_end_date", end_col), keys, start, [end_col])


def attach_run_ends(
    df: DataFrame,
    ends: DataFrame,
    keys: str | Sequence[str],
    start: str,
    run_end: str = "era_end_date",
    how: str = "inner",
    weigh: bool = False,
) -> DataFrame:
    """Every record with the earliest of the *given* run ends of its key that
    lies on or after its start, as ``run_end`` (P3 where runs were built, or
    stored, before). ``ends`` holds ``keys`` and ``run_end``; repeated and NULL
    ends do no harm. Records without such an end are dropped, or with
    ``how="left"`` kept with NULL, as are then records with a NULL key or start.

    A forward as-of join without a range predicate: the start days of the
    records and the ends form one table, and a window in descending order of
    date carries the nearest end to each day. It sees days and ends, bounded
    by the calendar, and never records.

    With ``weigh``, for tables that are cheap to read again, that holds for heavy
    keys; the records of the others go through the window themselves."""
    keys = _keys(keys)
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    known = drop_null_keys(df, keys, start, start) if how == "inner" else df
    if not weigh:
        return _attach_by_day(known, ends, keys, start, run_end, how)
    given = drop_null_keys(ends, keys, run_end, run_end).select(*keys, run_end)
    (light, heavy), (light_ends, heavy_ends) = split_by_weight([known, given], keys)
    rows = _attach_by_record(light, light_ends, keys, start, run_end, how)
    return rows.unionByName(_attach_by_day(heavy, heavy_ends, keys, start, run_end, how))


def _attach_by_record(df: DataFrame, ends: DataFrame, keys: list[str], start: str, run_end: str, how: str) -> DataFrame:
    """:func:`attach_run_ends` by a window over the records and the ends, which move once."""
    types = {f.name: f.dataType for f in df.schema}
    rows = df.withColumn("_end", F.lit(None).cast("date"))
    end = F.col(run_end).cast("date")
    others = [F.lit(None).cast(types[c]).alias(c) for c in df.columns if c not in (*keys, start)]
    given = ends.select(*keys, end.cast(types[start]).alias(start), *others, end.alias("_end"))
    # of one date, ends come before records
    order = Window.partitionBy(*keys).orderBy(F.col(start).desc(), F.col("_end").isNull())
    near = F.last("_end", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # a record without a start comes last; no end lies after it
    found = rows.unionByName(given).withColumn(run_end, F.when(F.col(start).isNotNull(), near)).where(F.col("_end").isNull())
    return (found.where(F.col(run_end).isNotNull()) if how == "inner" else found).drop("_end")


def _attach_by_day(known: DataFrame, ends: DataFrame, keys: list[str], start: str, run_end: str, how: str) -> DataFrame:
    """:func:`attach_run_ends` by a window over days and ends, that go back to the dealt records."""
    dealt = _salted(known, keys, start)
    days = drop_null_keys(dealt, keys, start, start).groupBy(*keys, start, SALT).agg(F.lit(None).cast("date").alias("_end"))
    days = days.withColumnRenamed(start, "_date")
    given = drop_null_keys(ends, keys, run_end, run_end).select(*keys, F.col(run_end).cast("date").alias("_date")).distinct()
    given = given.select(*keys, "_date", F.lit(None).cast("long").alias(SALT), F.col("_date").alias("_end"))
    # of one date, ends come before days
    order = Window.partitionBy(*keys).orderBy(F.col("_date").desc(), F.col("_end").isNull())
    near = F.last("_end", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = days.select(*keys, "_date", SALT, "_end").unionByName(given).withColumn(run_end, near)
    found = found.where(F.col(SALT).isNotNull() & F.col(run_end).isNotNull()).withColumnRenamed("_date", start)
    return _attach(dealt, found, keys, start, [run_end], how)


def merge_overlaps(df: DataFrame, keys: str | Sequence[str], start: str, end: str) -> DataFrame:
    """Sub-exposures: overlapping or touching records merged (grace 0).

    Columns: keys, ``sub_start``, ``sub_end``, ``record_count``.
    """
    keys = _keys(keys)
    eras = summarize_eras(df, keys, start, end, grace_days=0)
    return eras.select(
        *keys,
        F.col("era_start").alias("sub_start"),
        F.col("era_end").alias("sub_end"),
        F.col("record_count"),
    )


def sub_exposure_days(df: DataFrame, keys: str | Sequence[str], start: str, end: str) -> DataFrame:
    """:func:`merge_overlaps` plus the length of each sub-exposure in days."""
    subs = merge_overlaps(df, keys, start, end)
    return subs.withColumn("days_exposed", days_between("sub_start", "sub_end"))

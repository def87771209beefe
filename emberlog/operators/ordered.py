"""Order-dependent operators that never sort a whole table in one task.

Everything here follows one idea: cut the ordered axis into ranges, do the ordered work
inside each range in parallel, and carry a small per-range summary across the borders.

* ``range_buckets``       cut points from a quantile sketch; hot values get a second cut
* ``ordered_running``     running sums over a global (or per-key) order
* ``with_position``       exact row numbers
* ``with_lags``           lag by any number of rows
* ``exact_percentiles``   interpolated or nearest-rank percentiles without a per-group buffer
* ``trailing_window``     time-trailing aggregates ``(t - width, t]`` in linear time
* ``time_gaps``           gaps in a time series from per-slot extremes
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.session import range_parts, stored


def _join_on(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") if c in names else F.col(c) for c in right.columns]
    )
    condition = reduce(
        lambda a, b: a & b,
        [F.col(name).eqNullSafe(F.col(f"_r_{name}")) for name in names],
    )
    return left.join(renamed, condition, how).drop(*[f"_r_{name}" for name in names])


def _axis(df: DataFrame, column: str) -> Column:
    """The column as a number that sorts like it."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column)
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("bigint")
    if isinstance(kind, T.NumericType):
        return F.col(column).cast("double")
    raise TypeError(f"cannot cut {column} of type {kind.simpleString()} into ranges")


def _cut_points(df: DataFrame, column: str, parts: int) -> list[float]:
    """At most ``parts - 1`` sorted quantiles, brought to the driver once.

    A sketch may come out differently each time it is run, so the cut points have to be
    fixed before two branches of a plan (or a repeated task) rely on them. Sketches are
    merged in groups first, so that no task merges those of every partition.
    """
    fractions = [i / parts for i in range(1, parts)]
    value = _axis(df, column)
    grouped = (
        df.select(value.alias("v"), F.pmod(F.spark_partition_id(), F.lit(64)).alias("g"))
        .where(F.col("v").isNotNull())
        .groupBy("g")
        .agg(F.percentile_approx("v", fractions, 4 * parts).alias("c"))
    )
    points = grouped.select(F.explode("c").alias("v")).agg(F.percentile_approx("v", fractions, 4 * parts).alias("c"))
    found = points.first()["c"]
    return sorted({x for x in found or [] if x == x and abs(x) != float("inf")})


def _rank_in_cuts(value: Column, cuts: Column, parts: int) -> Column:
    """How many of the sorted ``cuts`` lie below ``value``, by binary search."""
    steps, step = [], parts // 2
    while step:
        steps.append(step)
        step //= 2
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, s: F.when(F.get(cuts, at + s - 1) < value, at + s).otherwise(at),
    )


def _literal(cuts: Sequence[float]) -> Column:
    suffix = "L" if all(isinstance(c, int) for c in cuts) else "D"
    return F.expr(f"array({', '.join(f'{c!r}{suffix}' for c in cuts)})")


def range_buckets(
    df: DataFrame, order: str, tie: str | None = None, parts: int | None = None, name: str = "_bucket"
) -> DataFrame:
    """Add an order-preserving bucket id with about equal row counts.

    The cut points are a few literals whatever the table size. A value that equals a cut
    point may be hot, so its rows are cut again by ``tie``. Only the balance depends on
    the sketch, never the result. NULLs go to the first bucket.
    """
    parts = parts or range_parts(df.sparkSession)
    cuts = _cut_points(df, order, parts)
    if not cuts:
        return df.withColumn(name, F.lit(0).cast("bigint"))
    value, points = _axis(df, order), _literal(cuts)
    placed = df.select("*", _rank_in_cuts(value, points, parts).alias("_at"))
    on_cut = F.coalesce(F.get(points, F.col("_at")) == value, F.lit(False))
    bucket = F.col("_at").cast("bigint") * 2 + on_cut.cast("bigint")
    if tie is not None:
        ties = _cut_points(df, tie, parts)
        minor = _rank_in_cuts(_axis(df, tie), _literal(ties), parts) if ties else F.lit(0)
        bucket = bucket * parts + F.when(on_cut, minor).otherwise(0)
    return placed.select(*[F.col(c) for c in df.columns], bucket.alias(name))


def ordered_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    tie: str | None = None,
    parts: int | None = None,
    bucketed: bool = False,
) -> DataFrame:
    """Inclusive running sums ``name`` and per-key totals ``name_total``.

    ``order`` sorts the rows, its first column is cut into ranges. One shuffle of the
    rows by (keys, range); the offsets are one row per (key, range).
    """
    keys = list(keys)
    base = df if bucketed else range_buckets(df, order[0], tie, parts)
    group = [*keys, "_bucket"]
    inside = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    running = base.select("*", *[F.sum(c).over(inside).alias(f"_in_{n}") for n, c in sums.items()])

    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = (
        base.groupBy(*group)
        .agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()])
        .select(
            *group,
            *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in sums],
            *[F.sum(f"_sum_{n}").over(whole).alias(f"{n}_total") for n in sums],
        )
    )
    joined = _join_on(running, offsets, group)
    return joined.select(
        *df.columns if not bucketed else [c for c in df.columns if c != "_bucket"],
        *[(F.col(f"_in_{n}") + F.col(f"_off_{n}")).alias(n) for n in sums],
        *[F.col(f"{n}_total") for n in sums],
    )


def with_position(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tie: str | None = None,
    name: str = "position",
    parts: int | None = None,
) -> DataFrame:
    """Exact 1-based row number per key, plus ``<name>_total`` rows per key."""
    return ordered_running(df, keys, order, {name: F.lit(1).cast("bigint")}, tie, parts)


def with_lags(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, tuple[str, int]],
    tie: str | None = None,
    block: int = 65536,
) -> DataFrame:
    """Add ``out = lag(column, k)`` for each ``out: (column, k)``.

    Rows are numbered first, so the windows run on blocks of exactly ``block`` rows even
    if one key owns most of the table; the last ``k`` rows of a block are repeated as
    context at the head of the next one.
    """
    reach = max(k for _, k in columns.values())
    if reach > block:
        raise ValueError("block must hold at least the largest lag")
    numbered = with_position(df, keys, order, tie, name="_pos")
    slot = F.floor((F.col("_pos") - 1) / block)
    edge = (F.col("_pos") - 1) % block >= block - reach
    spread = numbered.withColumn("_own", slot).withColumn(
        "_slot", F.explode(F.when(edge, F.array(slot, slot + 1)).otherwise(F.array(slot)))
    )
    inside = Window.partitionBy(*keys, "_slot").orderBy("_pos")
    return (
        spread.select("*", *[F.lag(c, k).over(inside).alias(out) for out, (c, k) in columns.items()])
        .where(F.col("_slot") == F.col("_own"))
        .select(*df.columns, *columns)
    )


def exact_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    points: Mapping[str, float],
    nearest_rank: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Percentiles of the non-null values per key, one output column per point.

    Default is linear interpolation between closest ranks; ``nearest_rank`` picks the
    value at index ``floor(n * p)`` of the sorted values instead. Range counts decide
    which ranges hold a wanted rank, and only the rows of those ranges are collapsed to
    (value, count) and ranked. No group is gathered.
    """
    keys = list(keys)
    # finer ranges than tasks: the fewer rows share a range with a wanted rank, the better
    parts = parts or max(256, range_parts(df.sparkSession))
    values = df.where(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("_v"))
    ranged = range_buckets(values, "_v", parts=parts)
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        ranged.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumns(
            {
                "_before": F.coalesce(F.sum("_c").over(before), F.lit(0)),
                "_n": F.sum("_c").over(Window.partitionBy(*keys)),
            }
        )
    )

    def rank_of(p: Column, up: bool) -> Column:
        if nearest_rank:
            return F.least(F.floor(F.col("_n") * p), F.col("_n") - 1)
        spot = (F.col("_n") - 1) * p
        return F.ceil(spot) if up else F.floor(spot)

    wanted = F.array(*[F.lit(float(p)) for p in points.values()])
    ranks = F.transform(wanted, lambda p: rank_of(p, False))
    if not nearest_rank:
        ranks = F.array_distinct(F.concat(ranks, F.transform(wanted, lambda p: rank_of(p, True))))
    targets = (
        counts.withColumn(
            "_ranks",
            F.filter(ranks, lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_c"))),
        )
        .where(F.size("_ranks") > 0)
        .drop("_c")
    )
    # a written table has a known size: the planner broadcasts it only when that is small
    # and joins by key otherwise, so the scanned column is normally not shuffled
    targets = stored(targets)
    group = [*keys, "_bucket"]
    counted = (
        _join_on(ranged, targets.select(*group), group, "left_semi")
        .groupBy(*group, "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    hit = _join_on(counted, targets, group)
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    # each wanted rank falls on exactly one value: at most two rows per point and key remain
    found = hit.withColumn("_cum", F.col("_before") + F.sum("_c").over(inside)).select(
        *keys, "_n", "_v",
        F.explode(
            F.filter("_ranks", lambda r: (r >= F.col("_cum") - F.col("_c")) & (r < F.col("_cum")))
        ).alias("_r"),
    )
    by_rank = found.groupBy(*keys).agg(
        F.max("_n").alias("_n"), F.map_from_entries(F.collect_list(F.struct("_r", "_v"))).alias("_at")
    )
    out = []
    for name, p in points.items():
        low = F.element_at("_at", rank_of(F.lit(float(p)), False))
        if nearest_rank:
            out.append(low.alias(name))
        else:
            high = F.element_at("_at", rank_of(F.lit(float(p)), True))
            spot = (F.col("_n") - 1) * F.lit(float(p))
            out.append((low + (high - low) * (spot - F.floor(spot))).alias(name))
    return by_rank.select(*keys, *out)


_MERGE = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}
_START = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}


def _combine(kind: str, parts: Sequence[Column]) -> Column:
    if kind == "max":
        return F.greatest(*parts)
    if kind == "min":
        return F.least(*parts)
    total = reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)) for p in parts])
    if kind == "count":
        return total
    return F.when(F.coalesce(*parts).isNotNull(), total)


def trailing_points(
    df: DataFrame,
    ts: str,
    width_us: int,
    measures: Mapping[str, tuple[str, Column]],
    keys: Sequence[str] = (),
    slices: int = 50,
) -> DataFrame:
    """Trailing aggregates over ``(t - width, t]`` for every distinct instant ``t``.

    A sliding RANGE frame re-reads its whole frame for every row. Here the axis is cut
    into slices of ``width / slices``; a trailing window is then the prefix of its own
    slice, the totals of the slices in between and the suffix of one older slice. Each
    part is a running aggregate, so the work is linear, and a burst only fills its own
    slices. Rows sharing an instant are collapsed up front (they share their window).

    ``measures`` maps a name to ``(sum | count | max | min, column)``.
    """
    if width_us % slices:
        raise ValueError("width must be a multiple of the slice count")
    keys = list(keys)
    step = width_us // slices
    names = list(measures)
    kinds = {n: kind for n, (kind, _) in measures.items()}

    points = (
        df.where(F.col(ts).isNotNull())
        .groupBy(*keys, F.unix_micros(F.col(ts).cast("timestamp")).alias("_t"))
        .agg(*[_START[kind](c).alias(n) for n, (kind, c) in measures.items()])
        .withColumn("_s", F.floor(F.col("_t") / step))
    )

    def merged(over: Window, suffix: str) -> list[Column]:
        return [_MERGE[kinds[n]](n).over(over).alias(f"{n}{suffix}") for n in names]

    slice_of = Window.partitionBy(*keys, "_s")
    up = slice_of.orderBy("_t").rowsBetween(Window.unboundedPreceding, 0)
    down = slice_of.orderBy(F.col("_t").desc()).rowsBetween(Window.unboundedPreceding, 0)
    both = points.select("*", *merged(up, "_pre"), *merged(down, "_suf"))

    def none(n: str) -> Column:
        return F.lit(None).cast(both.schema[f"{n}_pre"].dataType)

    own = F.struct(
        F.col("_s").alias("s"), F.col("_t").alias("at"), F.lit(0).alias("kind"),
        *[F.col(f"{n}_pre").alias(f"{n}_pre") for n in names],
        *[none(n).alias(f"{n}_suf") for n in names],
    )
    older = F.struct(
        (F.col("_s") + slices).alias("s"), (F.col("_t") + width_us).alias("at"), F.lit(1).alias("kind"),
        *[none(n).alias(f"{n}_pre") for n in names],
        *[F.col(f"{n}_suf").alias(f"{n}_suf") for n in names],
    )
    events = both.select(*keys, F.explode(F.array(own, older)).alias("e")).select(*keys, "e.*")

    # Totals of the slices strictly between the own slice and the partly covered one.
    totals = points.groupBy(*keys, "_s").agg(*[_MERGE[kinds[n]](n).alias(n) for n in names])
    span = 1024 * slices
    home = F.floor(F.col("_s") / span)
    ahead = F.floor((F.col("_s") + slices - 1) / span)
    grouped = totals.withColumn("_home", home).withColumn(
        "_g", F.explode(F.array_distinct(F.array(home, ahead)))
    )
    between = Window.partitionBy(*keys, "_g").orderBy("_s").rangeBetween(-(slices - 1), -1)
    middle = (
        grouped.select(
            "*", *[_MERGE[kinds[n]](n).over(between).alias(f"{n}_mid") for n in names]
        )
        .where(F.col("_g") == F.col("_home"))
        .select(*keys, F.col("_s").alias("s"), *[f"{n}_mid" for n in names])
    )
    if slices == 1:
        middle = middle.limit(0)

    stacked = events.unionByName(
        middle.withColumn("at", F.lit(2**63 - 1)).withColumn("kind", F.lit(2)), allowMissingColumns=True
    )
    # Descending: the slice totals come first, then at equal positions own rows come
    # before older ones, which leaves out an event exactly ``width`` ago.
    walk = (
        Window.partitionBy(*keys, "s")
        .orderBy(F.col("at").desc(), F.col("kind") == 1)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    filled = stacked.select(
        *keys, "at", "kind", *[f"{n}_pre" for n in names],
        *[F.last(f"{n}_suf", ignorenulls=True).over(walk).alias(f"{n}_suf") for n in names],
        *[F.last(f"{n}_mid", ignorenulls=True).over(walk).alias(f"{n}_mid") for n in names],
    ).where(F.col("kind") == 0)
    return filled.select(
        *keys,
        F.col("at").alias("_t"),
        *[
            _combine(kinds[n], [F.col(f"{n}_pre"), F.col(f"{n}_mid"), F.col(f"{n}_suf")]).alias(n)
            for n in names
        ],
    )


def trailing_window(
    df: DataFrame,
    ts: str,
    width_us: int,
    measures: Mapping[str, tuple[str, Column]],
    keys: Sequence[str] = (),
    slices: int = 50,
) -> DataFrame:
    """Attach :func:`trailing_points` to every row of ``df``."""
    keys = list(keys)
    points = trailing_points(df, ts, width_us, measures, keys, slices)
    left = df.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp")))
    return _join_on(left, points, [*keys, "_t"], "left").select(*df.columns, *measures)


def time_gaps(
    df: DataFrame, ts: str, gap_us: int, keys: Sequence[str] = (), block: int = 4096
) -> DataFrame:
    """Gaps longer than ``gap_us`` between neighbouring instants.

    Two neighbours further apart than the slot width cannot share a slot, so the first
    and last instant per slot decide every gap; the raw rows are only aggregated. The
    slot table is walked in blocks with the block ends carried across.
    """
    keys = list(keys)
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    slots = (
        df.where(F.col(ts).isNotNull())
        .groupBy(*keys, F.floor(micros / gap_us).alias("_slot"))
        .agg(F.min(micros).alias("_first"), F.max(micros).alias("_last"))
        .withColumn("_block", F.floor(F.col("_slot") / block))
    )
    blocks = slots.groupBy(*keys, "_block").agg(F.max("_last").alias("_block_last"))
    across = Window.partitionBy(*keys).orderBy("_block")
    carried = blocks.select(*keys, "_block", F.lag("_block_last").over(across).alias("_carry"))
    inside = Window.partitionBy(*keys, "_block").orderBy("_slot")
    linked = _join_on(slots, carried, [*keys, "_block"]).withColumn(
        "_previous", F.coalesce(F.lag("_last").over(inside), F.col("_carry"))
    )
    return linked.where(F.col("_first") - F.col("_previous") > gap_us).select(
        *keys,
        F.timestamp_micros("_first").alias("timestamp"),
        ((F.col("_first") - F.col("_previous")) / 60e6).alias("gap_minutes"),
    )

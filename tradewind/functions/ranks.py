"""Global ranks, and sums and values carried along within keys, without a sort of everything or of a hot key in one task.

``ntile``, ``percent_rank`` and consecutive keys need every row's position in the whole table. Spark deals the rows into
ranges of (value, tie) - so rows of one value spread over as many ranges as they need - and sorts each; a row's position
is its place in its range plus the rows of the ranges before. The sorted rows are stored, so places stay as they are;
what is known of each range is one row of a table that grows with the number of ranges, not of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewind.functions.store import save

ROWS_PER_RANGE = 1_000_000


def _sorted(df: DataFrame, order: list[Column], ranges: int) -> DataFrame:
    """``df``, stored, with ``__range`` and ``__place`` (from 1 in each range)."""
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # The id counts up from 0 in each partition, from the partition's number times 2^33 on.
    stored = save(dealt.withColumn("__id", F.monotonically_increasing_id()), "ranked")
    place = (F.col("__id") % F.lit(1 << 33) + 1).cast("bigint")
    return stored.withColumns({"__range": F.floor(F.col("__id") / F.lit(1 << 33)).cast("int"), "__place": place}).drop("__id")


def _before(ranges: DataFrame) -> DataFrame:
    """``ranges`` (__range, __n, ...) with the rows of all ranges before and of all ranges: a few rows."""
    upto = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    every = F.sum("__n").over(Window.partitionBy())
    return ranges.withColumns({"__before": F.coalesce(F.sum("__n").over(upto), F.lit(0)), "__every": every})


def _ranges(df: DataFrame, ranges: int | None) -> int:
    return ranges or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_PER_RANGE))


def numbered(df: DataFrame, order: list[str], name: str, start: int = 1, ranges: int | None = None) -> DataFrame:
    """``df`` with consecutive numbers from ``start`` in the given order; nulls come first."""
    found = _sorted(df, [F.col(c) for c in order], _ranges(df, ranges))
    before = _before(found.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))).select("__range", "__before")
    out = found.join(F.broadcast(before), "__range")
    return out.withColumn(name, (F.col("__place") + F.col("__before") + (start - 1)).cast("bigint")).drop("__range", "__place", "__before")


def global_positions(df: DataFrame, values: dict[str, tuple[str, bool]], tie: str, ranked: tuple[str, ...] = (), ranges: int | None = None) -> DataFrame:
    """``df`` with, for each name in ``values`` (name: column, descending), ``name``_row (1 to n by the column, then
    ``tie`` ascending) and ``name``_n; for those in ``ranked`` also ``name``_rank (equal values share the smallest
    position). Columns are not null. Broadcasts have a row per range."""
    df = save(df, "ranked")
    ranges = _ranges(df, ranges)
    for name, (column, down) in values.items():
        x = F.col(column)
        df = _sorted(df, [x.desc() if down else x.asc(), F.col(tie)], ranges)
        if name not in ranked:
            of = _before(df.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))).select("__range", "__before", "__every")
            df = df.join(F.broadcast(of), "__range")
        else:
            first = df.groupBy("__range", x.alias("__x")).agg(F.min("__place").alias("__first"), F.count(F.lit(1)).alias("__k"))
            first = save(first, "ranks")
            of = _before(first.groupBy("__range").agg(F.sum("__k").alias("__n"))).select("__range", "__before", "__every")
            # A value that goes on over several ranges has the rank of its first row.
            each = first.join(F.broadcast(of), "__range")
            rank = each.groupBy("__x").agg(F.min(F.col("__first") + F.col("__before")).alias(f"{name}_rank"))
            df = df.join(F.broadcast(of), "__range").join(rank, x == F.col("__x")).drop("__x")
        df = df.withColumns({f"{name}_row": F.col("__place") + F.col("__before"), f"{name}_n": F.col("__every").cast("bigint")})
        df = df.drop("__range", "__place", "__before", "__every")
    return df


#: Size of a sketch: its ranks are off by about 1.1 / SKETCH^0.9 with 99 % probability (0.3 % here), at some 20 KB.
SKETCH, FINE, COARSE = 1000, 1024, 32


def approximate_positions(df: DataFrame, values: dict[str, tuple[str, bool]], tie: str = "", ranked: tuple[str, ...] = (), k: int = SKETCH) -> DataFrame:
    """As ``global_positions``, from one KLL sketch per column in one pass over ``df`` (whole numbers, not null): nothing
    is sorted or stored. ``name``_row and ``name``_rank are the smallest position that the sketch gives the value, to one
    in ``FINE`` besides the sketch's own error; equal values share it. The sketches' cut points are one broadcast row."""
    fine, coarse = (F.array(*[F.lit((i + 1) / n) for i in range(n)]) for n in (FINE, FINE // COARSE))
    cuts = df.agg(*[F.kll_sketch_agg_bigint(F.col(c).cast("bigint"), k).alias(name) for name, (c, _) in values.items()], F.count(F.lit(1)).alias("__n"))
    points = [F.kll_sketch_get_quantile_bigint(F.col(n), at).alias(f"__{what}_{n}") for n in values for what, at in (("fine", fine), ("coarse", coarse))]
    df = df.crossJoin(F.broadcast(cuts.where("__n > 0").select("__n", *points)))

    def under(cuts: Column, x: Column, down: bool) -> Column:
        """How many cut points are below the value, or (descending) not above it."""
        return F.size(F.filter(cuts, (lambda c: c <= x) if down else (lambda c: c < x)))

    for name, (column, down) in values.items():
        # Whole stretches first, then one stretch.
        whole = under(F.col(f"__coarse_{name}"), F.col(column), down)
        part = under(F.slice(f"__fine_{name}", whole * COARSE + 1, COARSE), F.col(column), down)
        share = (whole * COARSE + part) / F.lit(FINE)
        before = F.floor((1 - share if down else share) * F.col("__n"))
        at = F.least(before + 1, F.col("__n")).cast("bigint")
        df = df.withColumns({f"{name}_row": at, f"{name}_n": F.col("__n")} | ({f"{name}_rank": at} if name in ranked else {}))
    return df.drop("__n", *[f"__{what}_{n}" for n in values for what in ("fine", "coarse")])


def carried(
    df: DataFrame,
    key: list[str],
    order: list[str],
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``df`` with what goes on along ``order`` within ``key``, each row included: for each name in ``sums`` the sum so
    far (0 at first), for each in ``lasts`` the last value so far that is not null. Nulls come first in the order, which
    should tell all rows of a key apart; null keys are a key.

    Segmented prefix sums: rows are dealt into ranges of (key, order), so a key with very many rows spreads over as many
    as it needs; each range goes on by itself, and takes over what the ranges before leave of the key that it begins
    with, one row a range. A table that fits one range has plain windows; both give the same.
    """
    sums, lasts = sums or {}, lasts or {}
    both = {n: F.coalesce(c, F.lit(0)) for n, c in sums.items()} | dict(lasts)
    # Rows that the order leaves equal still spread over ranges.
    df = save(df.withColumns({f"__of_{n}": c for n, c in both.items()} | {"__tie": F.monotonically_increasing_id()}), "carried")
    ranges = -(-df.count() // rows_per_range)

    def going_on(w: Window, of: str) -> dict[str, Column]:
        kept = {n: F.last(F.col(f"{of}{n}"), ignorenulls=True).over(w) for n in lasts}
        return {n: F.sum(F.col(f"{of}{n}")).over(w) for n in sums} | kept

    if ranges <= 1:
        w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns(going_on(w, "__of_")).drop("__tie", *[f"__of_{n}" for n in both])
    found = _sorted(df, [F.col(c) for c in [*key, *order, "__tie"]], ranges)
    ends = [F.sum(f"__of_{n}").alias(f"__end_{n}") for n in sums]
    ends += [F.max_by(f"__of_{n}", F.when(F.col(f"__of_{n}").isNotNull(), F.col("__place"))).alias(f"__end_{n}") for n in lasts]
    ends = found.groupBy(*key, "__range").agg(*ends, F.min("__place").alias("__from"))
    upto = Window.partitionBy(*key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = {f"__before_{n}": c for n, c in going_on(upto, "__end_").items()}
    # A key comes from the range before only where it begins one: at most a row for each range.
    ends = ends.withColumns(before | {"__more": F.count(F.lit(1)).over(upto) > 0}).where("__more and __from = 1")
    ends = save(ends.select(*[F.col(c).alias(f"__key_{c}") for c in key], F.col("__range").alias("__at"), *before), "carried-ends")
    inside = Window.partitionBy(*key, "__range").orderBy("__place").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumns({f"__own_{n}": c for n, c in going_on(inside, "__of_").items()})
    same = F.col("__range") == F.col("__at")
    for c in key:
        same = same & F.col(c).eqNullSafe(F.col(f"__key_{c}"))
    found = found.join(F.broadcast(ends), same, "left")
    out = {n: F.col(f"__own_{n}") + F.coalesce(F.col(f"__before_{n}"), F.lit(0)) for n in sums}
    out |= {n: F.coalesce(F.col(f"__own_{n}"), F.col(f"__before_{n}")) for n in lasts}
    done = ["__range", "__place", "__tie", "__at", *[c for c in found.columns if c.startswith(("__of_", "__own_", "__before_", "__key_"))]]
    return found.withColumns(out).drop(*done)


def tile(name: str, tiles: int) -> Column:
    """``ntile``: the first n mod tiles groups have one row more."""
    n, row = F.col(f"{name}_n"), F.col(f"{name}_row")
    q, r = F.floor(n / tiles), n % tiles
    big = r * (q + 1)
    return F.when(row <= big, F.floor((row - 1) / (q + 1)) + 1).otherwise(r + F.floor((row - big - 1) / F.greatest(q, F.lit(1))) + 1).cast("bigint")


def percent_rank(name: str) -> Column:
    n = F.col(f"{name}_n")
    return F.when(n > 1, (F.col(f"{name}_rank") - 1) / (n - 1).cast("double")).otherwise(0.0)

"""Range joins, nearest intervals, islands and depth over half-open integer intervals [s, e).

A row with a null coordinate lies nowhere: it overlaps nothing, belongs to no island and adds
no depth. Null keys are a key like any other where rows are grouped, and match nothing in joins.
Repeated rows each count.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lengths up to this lie in bins of this width; each further level holds SPREAD times longer ones.
BASE, SPREAD, LEVELS = 64, 16, 12


def hidden(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def join_same(a: DataFrame, b: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which nulls are equal; the keys appear once."""
    named = {k: hidden(f"_k{i}", a, b) for i, k in enumerate(keys)}
    right = b.withColumnsRenamed(named)
    met = a.join(right, [a[k].eqNullSafe(right[n]) for k, n in named.items()], how)
    return met.drop(*named.values())


def bins(s: Column, e: Column, width) -> Column:
    """The bins of ``width`` that an interval touches; a zero-length interval touches the one of its start."""
    return F.sequence(F.floor(s / width), F.floor(F.greatest(e - 1, s) / width))


def level_of(s: Column, e: Column) -> Column:
    """The least level whose bins are as wide as the interval."""
    out = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        out = F.when(e - s <= BASE * SPREAD**k, k).otherwise(out)
    return F.when(s.isNotNull() & e.isNotNull(), out)


def _levels(df: DataFrame, s: str, e: str) -> list[int]:
    """The levels that a side has, LEVELS at most."""
    return sorted(x for x in df.select(F.collect_set(level_of(F.col(s), F.col(e)))).first()[0] if x is not None)


def _no_clash(left: DataFrame, right: DataFrame, keys: list[str], r: tuple[str, str]) -> tuple[DataFrame, tuple[str, str]]:
    """Right columns that left has too get the suffix _right, the keys excepted."""
    clash = {c: hidden(f"{c}_right", left, right) for c in right.columns if c in left.columns and c not in keys}
    return right.withColumnsRenamed(clash), (clash.get(r[0], r[0]), clash.get(r[1], r[1]))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], *, l: tuple[str, str] = ("s", "e"), r: tuple[str, str] = ("s2", "e2"), width: int | None = None) -> DataFrame:
    """Pairs with equal keys where right.e > left.s and right.s < left.e.

    Both sides go to the bins they touch, so the join has an equi key and a hot key is spread
    by position; a pair is kept in the first bin that both touch, which needs no distinct.

    Without ``width`` the bins follow the lengths: an interval lies in the bins of its own
    level, one or two, and is sought in those of the longer levels that the other side has. So
    an interval of any length is in a few bins, and long ones meet short ones without being cut
    up; a job over either side finds the levels. With ``width`` all bins are that wide, which
    needs no job and suits sides of lengths of about that.

    Right columns that left has too, the keys excepted, get the suffix _right.
    """
    right, r = _no_clash(left, right, keys, r)
    bin_, level, a0, b0 = (hidden(n, left, right) for n in ("_bin", "_level", "_a0", "_b0"))
    crossed = (F.col(r[1]) > F.col(l[0])) & (F.col(r[0]) < F.col(l[1]))

    def at_width(a: DataFrame, b: DataFrame, size: int) -> DataFrame:
        a = a.withColumn(a0, F.floor(F.col(l[0]) / size)).withColumn(bin_, F.explode(bins(F.col(l[0]), F.col(l[1]), size)))
        b = b.withColumn(b0, F.floor(F.col(r[0]) / size)).withColumn(bin_, F.explode(bins(F.col(r[0]), F.col(r[1]), size)))
        return a.join(b, [*keys, bin_]).filter(crossed & (F.greatest(a0, b0) == F.col(bin_))).drop(bin_, a0, b0)

    if width:
        return at_width(left, right, width)
    ll, rl = _levels(left, *l), _levels(right, *r)
    if len({*ll, *rl}) <= 1:
        return at_width(left, right, BASE * SPREAD ** max([0, *ll]))

    def spread(df: DataFrame, s: str, e: str, first: str, at: list[int], own: bool, strict: bool = False) -> DataFrame:
        """A row for each bin of the row's own level, or of those of ``at`` from it (beyond it if strict)."""
        mine = level_of(F.col(s), F.col(e))
        asked = F.array(mine) if own else F.filter(F.array(*[F.lit(x) for x in at]), lambda x: (x > mine) if strict else (x >= mine))
        size = F.lit(BASE).cast("long") * F.pow(F.lit(SPREAD), F.col(level)).cast("long")
        df = df.withColumn(level, F.explode(asked)).withColumn(first, F.floor(F.col(s) / size))
        return df.withColumn(bin_, F.explode(bins(F.col(s), F.col(e), size)))

    hit = crossed & (F.greatest(a0, b0) == F.col(bin_))
    longer = spread(left, *l, a0, [], True).join(spread(right, *r, b0, ll, False), [*keys, level, bin_]).filter(hit)
    shorter = spread(left, *l, a0, rl, False, True).join(spread(right, *r, b0, [], True), [*keys, level, bin_]).filter(hit)
    return longer.unionByName(shorter).drop(level, bin_, a0, b0)


def overlap_totals(left: DataFrame, right: DataFrame, keys: list[str], *, l: tuple[str, str] = ("s", "e"), r: tuple[str, str] = ("s2", "e2"), width: int | None = None) -> DataFrame:
    """(keys, pairs, bases): how many pairs ``overlap_join`` has by key and how many bases they share.

    Equal intervals of a side are met once, with their number, so copies are not expanded into pairs.
    """
    n, m = hidden("_n", left, right), hidden("_m", left, right)
    one = lambda df, ends, name: df.groupBy(*keys, *ends).agg(F.count(F.lit(1)).alias(name))
    met = overlap_join(one(left, l, n), one(right, r, m), keys, l=l, r=r, width=width)
    times = F.col(n) * F.col(m)
    return met.groupBy(*keys).agg(F.sum(times).alias("pairs"), F.sum((F.least(l[1], r[1]) - F.greatest(l[0], r[0])) * times).alias("bases"))


def overlap_exists(left: DataFrame, right: DataFrame, keys: list[str], *, anti: bool = False, l: tuple[str, str] = ("s", "e"), r: tuple[str, str] = ("s2", "e2"), width: int | None = None) -> DataFrame:
    """Rows of left that some right interval overlaps (``anti``: that none does), each as often as it is there.

    Left columns have to be of types that can be compared. Only distinct coordinates of the
    right side are met.
    """
    named = {c: hidden(f"_q{i}", left) for i, c in enumerate(left.columns)}
    one = left.select(*dict.fromkeys([*keys, *l])).distinct()
    met = overlap_join(one, right.select(*keys, *r).distinct(), keys, l=l, r=r, width=width).select(*one.columns).distinct().withColumnsRenamed(named)
    same = [left[c].eqNullSafe(met[named[c]]) for c in one.columns]
    return left.join(met, same, "left_anti" if anti else "left_semi")


def nearest(queries: DataFrame, intervals: DataFrame, keys: list[str], *, pos: str = "p", side: str = "before", k: int = 1, max_dist: int = 2500, ends: tuple[str, str] = ("s", "e"), ties: list[str] | None = None) -> DataFrame:
    """The k intervals nearest before (0 <= p - 1 - e < max_dist) or after (0 <= s - p - 1 < max_dist) a position.

    Adds distance and rank. Equal distances go by ``ties``, then the interval; equal intervals each
    take a rank, and equal queries each get their answer. A null key or coordinate meets nothing.
    Interval columns that queries have too, the keys excepted, get the suffix _right.

    No pairs are made. Positions are cut into bins of ``max_dist``; an interval goes to the two bins
    from which it can be reached. In a bin's order each interval knows the k up to it, and a query
    takes those of the last interval before it.
    """
    intervals, (s, e) = _no_clash(queries, intervals, keys, ends)
    bin_, x, nth, asked, up_to = (hidden(n, queries, intervals) for n in ("_bin", "_x", "_nth", "_asked", "_up_to"))
    known = lambda *cs: reduce(lambda p, q: p & q, [F.col(c).isNotNull() for c in cs])
    # on the axis x an interval lies at or before the positions that ask for it, the nearest last
    at, spot = (F.col(e), F.col(pos) - 1) if side == "before" else (-F.col(s), -(F.col(pos) + 1))
    held = intervals.filter(known(*keys, s, e)).withColumn(x, at.cast("long"))
    held = held.withColumn(bin_, F.explode(F.array(F.floor(F.col(x) / max_dist), F.floor(F.col(x) / max_dist) + 1)))
    place = Window.partitionBy(*keys, bin_)
    order = place.orderBy(x, *[F.col(c).desc() for c in (*(ties or []), s, e)])
    item = F.struct(x, *[c for c in intervals.columns if c not in keys])
    held = held.select(*keys, bin_, x, F.row_number().over(order).alias(nth), F.collect_list(item).over(order.rowsBetween(1 - k, 0)).alias(up_to))
    rows = queries.filter(known(*keys, pos)).withColumn(x, spot.cast("long"))
    rows = rows.select(*keys, F.floor(F.col(x) / max_dist).alias(bin_), x, F.lit(0).alias(nth), F.struct(*[F.col(c) for c in queries.columns]).alias(asked))
    both = held.unionByName(rows, allowMissingColumns=True)
    so_far = place.orderBy(x, F.col(asked).isNotNull(), nth).rowsBetween(Window.unboundedPreceding, 0)
    met = both.withColumn(up_to, F.last(up_to, True).over(so_far)).filter(F.col(asked).isNotNull() & F.col(up_to).isNotNull())
    each = met.select(x, asked, F.posexplode(F.reverse(up_to)).alias(nth, up_to))
    distance = F.col(x) - F.col(f"{up_to}.{x}")
    named = [F.col(f"{asked}.{c}").alias(c) for c in queries.columns] + [F.col(f"{up_to}.{c}").alias(c) for c in intervals.columns if c not in keys]
    return each.filter(distance < max_dist).select(*named, distance.alias("distance"), (F.col(nth) + 1).alias("rank"))


def nearest_stranded(queries: DataFrame, intervals: DataFrame, keys: list[str], *, strand: str = "strand", direction: str = "upstream", **how) -> DataFrame:
    """``nearest`` before for + and after for - (upstream), or the other way round."""
    minus = F.col(strand) == "-"
    first, second = ("before", "after") if direction == "upstream" else ("after", "before")
    return nearest(queries.filter(~minus), intervals, keys, side=first, **how).unionByName(nearest(queries.filter(minus), intervals, keys, side=second, **how))


def _runs(rows: DataFrame, within: list[str], s: str, e: str, max_gap: int, name: str) -> DataFrame:
    """Numbers the islands of ``within``; both windows share one sort."""
    reach = hidden("_max", rows)
    order = Window.partitionBy(*within).orderBy(s, e)
    opened = rows.withColumn(reach, F.max(e).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    new = F.when(F.col(reach).isNull() | (F.col(s) > F.col(reach) + max_gap), 1).otherwise(0)
    return opened.withColumn(name, F.sum(new).over(order.rowsBetween(Window.unboundedPreceding, 0))).drop(reach)


def _tiled(df: DataFrame, keys: list[str], s: str, e: str, max_gap: int, tile: int) -> tuple[DataFrame, DataFrame, tuple[str, str]]:
    """Rows with their island in a tile of starts, these islands with the whole island they belong to, and the names of tile and island."""
    at, local_ = hidden("_tile", df), hidden("_local", df)
    placed = df.filter(F.col(s).isNotNull() & F.col(e).isNotNull()).withColumn(at, F.floor(F.col(s) / tile))
    tiled = _runs(placed, [*keys, at], s, e, max_gap, local_)
    local = tiled.groupBy(*keys, at, local_).agg(F.min(s).alias("_s"), F.max(e).alias("_e"), F.count(F.lit(1)).alias("_n"))
    return tiled, _runs(local, keys, "_s", "_e", max_gap, "_island"), (at, local_)


def label_islands(df: DataFrame, keys: list[str], *, s: str = "s", e: str = "e", max_gap: int = 0, tile: int = 4096) -> DataFrame:
    """Adds island_start and island_end: intervals with gaps of up to ``max_gap`` belong together; touching counts.

    Two steps: islands inside tiles of starts, so that one hot key is spread over tasks, and
    then islands of these, of which there are few. Rows with a null coordinate are left out.
    """
    if clash := {"island_start", "island_end"} & {c.lower() for c in df.columns}:
        raise ValueError(f"rename {sorted(clash)}: the islands' columns have these names")
    tiled, whole, at = _tiled(df, keys, s, e, max_gap, tile)
    span = Window.partitionBy(*keys, "_island")
    named = whole.select(*keys, *at, F.min("_s").over(span).alias("island_start"), F.max("_e").over(span).alias("island_end"))
    return join_same(tiled, named, [*keys, *at]).drop(*at)


def _closed(rows: DataFrame, within: list[str], s: str, e: str, n: Column, max_gap: int, first: dict[str, Column] | None = None) -> DataFrame:
    """(within, _s, _e, _n): a row for each island of ``within``; _n sums ``n``, and ``first`` adds values of its first row.

    An island is told at its last row by running windows, which share one sort, so a task holds its sorted rows and no aggregate.
    """
    first = first or {}
    known = rows.select(*within, F.col(s).alias("_s"), F.col(e).alias("_e"), n.alias("_n"), *[x.alias(name) for name, x in first.items()])
    order = Window.partitionBy(*within).orderBy("_s", "_e")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    begun = lambda x: F.last(F.when(F.col("_new"), F.struct(x.alias("x"))), True).over(so_far)["x"]
    reach = F.max("_e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = known.withColumn("_reach", reach).withColumn("_new", F.col("_reach").isNull() | (F.col("_s") > F.col("_reach") + max_gap)).drop("_reach")
    told = opened.withColumns({"_nth": F.sum(F.col("_new").cast("int")).over(so_far), "_sum": F.sum("_n").over(so_far), "_last": F.coalesce(F.lead("_new").over(order), F.lit(True))})
    ends = told.select(*within, "_last", begun(F.col("_s")).alias("_s"), F.max(F.struct("_nth", "_e")).over(so_far)["_e"].alias("_e"), (F.col("_sum") - begun(F.col("_sum") - F.col("_n"))).alias("_n"), *[begun(F.col(name)).alias(name) for name in first])
    return ends.filter("_last").drop("_last")


def islands(df: DataFrame, keys: list[str], *, s: str = "s", e: str = "e", max_gap: int = 0, min_members: int = 1, tile: int = 4096) -> DataFrame:
    """(keys, island_start, island_end, members) of the islands with ``min_members`` or more.

    Needs no join and no aggregate: tiles' islands carry their counts. Rows with a null coordinate are left out.
    """
    at = hidden("_tile", df)
    placed = df.filter(F.col(s).isNotNull() & F.col(e).isNotNull()).withColumn(at, F.floor(F.col(s) / tile))
    local = _closed(placed, [*keys, at], s, e, F.lit(1).cast("long"), max_gap)
    found = _closed(local, keys, "_s", "_e", F.col("_n"), max_gap).select(*keys, F.col("_s").alias("island_start"), F.col("_e").alias("island_end"), F.col("_n").alias("members"))
    return found.filter(F.col("members") >= min_members)


def list_islands(df: DataFrame, keys: list[str], item: str, *, s: str = "s", e: str = "e", max_gap: int = 0, min_members: int = 1, tile: int = 4096) -> DataFrame:
    """(keys, island_start, island_end, items): islands with the sorted items of their members, repeats kept.

    Items are listed by the tiles' islands first, and these are put together by whole ones, so rows are joined with nothing.
    """
    at, local_ = hidden("_tile", df), hidden("_local", df)
    placed = df.filter(F.col(s).isNotNull() & F.col(e).isNotNull()).select(*keys, F.floor(F.col(s) / tile).alias(at), F.col(s).alias("_s"), F.col(e).alias("_e"), F.col(item).alias("_item"))
    local = _runs(placed, [*keys, at], "_s", "_e", max_gap, local_).groupBy(*keys, at, local_).agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"), F.collect_list("_item").alias("_items"))
    whole = _runs(local.drop(at, local_), keys, "_s", "_e", max_gap, "_island").groupBy(*keys, "_island")
    named = whole.agg(F.min("_s").alias("island_start"), F.max("_e").alias("island_end"), F.array_sort(F.flatten(F.collect_list("_items"))).alias("items")).drop("_island")
    return named.filter(F.size("items") >= min_members)


def island_links(df: DataFrame, keys: list[str], item: str, *, s: str = "s", e: str = "e", max_gap: int = 0, tile: int = 4096) -> DataFrame:
    """(a, b): links that make the items of each island one component; an item alone is linked to itself.

    A row is linked to the greatest item before it in its tile's island, and these islands' greatest items in
    the same way by key, so there are no more links than rows and no island is listed or joined.
    """
    at = hidden("_tile", df)
    rows = df.filter(F.col(s).isNotNull() & F.col(e).isNotNull()).select(*keys, F.floor(F.col(s) / tile).alias(at), F.col(s).alias("_s"), F.col(e).alias("_e"), F.col(item).alias("_item"))

    def linked(rows: DataFrame, within: list[str]) -> DataFrame:
        order = Window.partitionBy(*within).orderBy("_s", "_e")
        so_far = order.rowsBetween(Window.unboundedPreceding, 0)
        told = _runs(rows, within, "_s", "_e", max_gap, "_nth").withColumns({"_top": F.max(F.struct("_nth", "_item")).over(so_far), "_end": F.max(F.struct("_nth", "_e")).over(so_far), "_begin": F.min(F.struct(-F.col("_nth"), F.col("_s").alias("_s"))).over(so_far)})
        return told.withColumns({"_before": F.lag("_top").over(order), "_last": F.coalesce(F.lead("_nth").over(order) != F.col("_nth"), F.lit(True))})

    def links(told: DataFrame) -> DataFrame:
        before = F.when(F.col("_before")["_nth"] == F.col("_nth"), F.col("_before")["_item"])
        return told.filter("_item is not null").select(F.col("_item").alias("a"), F.coalesce(before, F.col("_item")).alias("b"))

    tiled = linked(rows, [*keys, at])
    local = tiled.filter("_last").select(*keys, F.col("_begin")["_s"].alias("_s"), F.col("_end")["_e"].alias("_e"), F.col("_top")["_item"].alias("_item"))
    return links(tiled).unionByName(links(linked(local, keys)).filter("a <> b"))


def _events(df: DataFrame, keys: list[str], s: str, e: str) -> DataFrame:
    """(keys, at, d): the change of depth at every start and end, events of one position summed; ends go before starts."""
    known = df.filter(F.col(s).isNotNull() & F.col(e).isNotNull())
    both = F.array(F.struct(F.col(s).alias("at"), F.lit(1).alias("d")), F.struct(F.col(e).alias("at"), F.lit(-1).alias("d")))
    return known.select(*keys, F.explode(both).alias("x")).select(*keys, "x.at", "x.d").groupBy(*keys, "at").agg(F.sum("d").alias("d"))


def depths(df: DataFrame, keys: list[str], *, s: str = "s", e: str = "e", tile: int = 4096) -> DataFrame:
    """(keys, at, depth) at every start and end. Depth is summed inside tiles of positions, and the tiles' own sums by key."""
    placed = _events(df, keys, s, e).withColumn("_tile", F.floor(F.col("at") / tile))
    inside = placed.withColumn("depth", F.sum("d").over(Window.partitionBy(*keys, "_tile").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)))
    sums = placed.groupBy(*keys, "_tile").agg(F.sum("d").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return join_same(inside, sums.select(*keys, "_tile", before.alias("_before")), [*keys, "_tile"]).select(*keys, "at", (F.col("depth") + F.col("_before")).alias("depth"), (F.col("d") != 0).alias("changed"))


def max_depth(df: DataFrame, keys: list[str], *, s: str = "s", e: str = "e", tile: int = 4096) -> DataFrame:
    """(keys, depth): the most intervals over one position; ends go before starts. A window over a key sees a row a tile."""
    placed = _events(df, keys, s, e).withColumn("_tile", F.floor(F.col("at") / tile))
    run = F.sum("d").over(Window.partitionBy(*keys, "_tile").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    tiles = placed.withColumn("_run", run).groupBy(*keys, "_tile").agg(F.sum("d").alias("_sum"), F.max("_run").alias("_most"))
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_tile").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return tiles.withColumn("_most", F.col("_most") + before).groupBy(*keys).agg(F.max("_most").alias("depth"))


def contiguous_runs(df: DataFrame, keys: list[str], index: str) -> DataFrame:
    """(keys, first, last, n) of runs of consecutive distinct indices; null indices are in none."""
    one = df.select(*keys, index).filter(F.col(index).isNotNull()).distinct()
    n, g = F.row_number().over(Window.partitionBy(*keys).orderBy(index)), hidden("_g", one)
    return one.withColumn(g, F.col(index) - n).groupBy(*keys, g).agg(F.min(index).alias("first"), F.max(index).alias("last"), F.count(F.lit(1)).alias("n")).drop(g)


def unambiguous(df: DataFrame, keys: list[str], *, s: str = "s", e: str = "e", shape: list[str], min_length: int, width: int | None = None) -> DataFrame:
    """Distinct intervals that no interval of another shape overlaps, of ``min_length`` or more."""
    one = df.select(*keys, s, e, *shape).distinct()
    s2, e2, other_, shape_ = (hidden(n, one) for n in ("_s2", "_e2", "_other", "_shape"))
    other = one.select(*keys, F.col(s).alias(s2), F.col(e).alias(e2), F.struct(s, e, *shape).alias(shape_))
    met = overlap_join(one, other, keys, l=(s, e), r=(s2, e2), width=width)
    alone = met.groupBy(*keys, s, e, *shape).agg(F.max((F.struct(s, e, *shape) != F.col(shape_)).cast("int")).alias(other_))
    return alone.filter((F.col(other_) == 0) & (F.col(e) - F.col(s) >= min_length)).drop(other_)

"""Rebalancing moves between zones of a slot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hailgrid.functions.geo import cell_distance_squared, degree_km_between, km_between
from hailgrid.functions.number import non_negative
from hailgrid.operators.balance import SLOT_KEYS
from hailgrid.operators.sizes import shuffle_partitions
from hailgrid.params import ZONE_STRIDE, GridSpec
from hailgrid.sources.tables import scratch_store

NOTHING_TAKEN = "CAST(array() AS ARRAY<STRUCT<i: INT, n: BIGINT>>)"
NO_MOVES = "CAST(array() AS ARRAY<STRUCT<from_zone: BIGINT, to_zone: BIGINT, drivers: BIGINT>>)"


def _take(near: Column, wants: Column) -> Column:
    """What one wanting zone takes from givers in order of ``near``: their places and a number each."""

    def from_one(state: Column, giver: Column) -> Column:
        n = F.least(state["open"], giver["left"])
        more = F.concat(state["taken"], F.array(F.struct(giver["i"].alias("i"), n.alias("n"))))
        return F.struct((state["open"] - n).alias("open"), F.when(n > 0, more).otherwise(state["taken"]).alias("taken"))

    start = F.struct(wants.alias("open"), F.expr(NOTHING_TAKEN).alias("taken"))
    return F.aggregate(near, start, from_one, lambda state: state["taken"])


def _serve(givers: Column, takers: Column) -> Column:
    """All moves of one slot: a fold over the wanting zones in their order.

    What one zone takes is gone for the next, so the state carries what every
    giver has left. Distances are whole cells, ties go to the smaller id.
    """

    def one(state: Column, taker: Column) -> Column:
        def offer(left: Column, i: Column) -> Column:
            x, y = givers[i]["zone_x"] - taker["zone_x"], givers[i]["zone_y"] - taker["zone_y"]
            return F.struct((x * x + y * y).alias("d2"), i.alias("i"), left.alias("left"))

        near = F.array_sort(F.filter(F.transform(state["left"], offer), lambda g: g["left"] > 0))
        took = F.struct(state["left"].alias("left"), state["moves"].alias("moves"), _take(near, taker["wants"]).alias("taken"), taker["zone_id"].alias("to_zone"))
        # a fold over this one value binds it to a name, so that it is computed once
        return F.aggregate(F.array(took), state, lambda _, t: _after(givers, t))

    start = F.struct(F.transform(givers, lambda g: -g["wants"]).alias("left"), F.expr(NO_MOVES).alias("moves"))
    return F.aggregate(takers, start, one, lambda state: state["moves"])


def _after(givers: Column, took: Column) -> Column:
    """What is left, and the moves, after one wanting zone was served."""
    given = F.map_from_entries(took["taken"])
    left = F.transform(took["left"], lambda n, i: n - F.coalesce(F.try_element_at(given, i), F.lit(0)))
    made = F.transform(
        took["taken"], lambda t: F.struct(givers[t["i"]]["zone_id"].alias("from_zone"), took["to_zone"].alias("to_zone"), t["n"].alias("drivers"))
    )
    return F.struct(left.alias("left"), F.concat(took["moves"], made).alias("moves"))


def _moves(zones: DataFrame, wants: Column, keys: list[str], largest_first: bool) -> DataFrame:
    """One row of two sorted arrays per group of keys; a group holds the zones of one slot, bounded by the grid.

    The explicit partition count keeps adaptive execution from merging the
    groups, small in bytes but not in work, into one task.
    """
    places = ["zone_id", "zone_x", "zone_y"]
    open_zones = zones.select(
        *keys, F.col("zone_id").cast("long").alias("zone_id"), "zone_x", "zone_y", wants.cast("long").alias("wants")
    ).filter("wants <> 0")
    turn = -F.col("wants") if largest_first else F.lit(0).cast("long")
    sides = {
        "givers": F.when(F.col("wants") < 0, F.struct(*places, "wants")),
        "takers": F.when(F.col("wants") > 0, F.struct(turn.alias("turn"), *places, "wants")),
    }
    spread = open_zones.repartition(shuffle_partitions(zones), *keys)
    slots = spread.groupBy(*keys).agg(*[F.sort_array(F.collect_list(side)).alias(name) for name, side in sides.items()])
    return slots.select(*keys, F.inline(_serve(F.col("givers"), F.col("takers"))))


def rebalancing_moves(allocated: DataFrame, grid: GridSpec, keys: list[str] | None = None) -> DataFrame:
    """Moves that bring every zone from its current to its assigned drivers, largest want first."""
    keys = keys or SLOT_KEYS
    km = F.round(km_between(F.col("from_zone"), F.col("to_zone"), grid), 2)
    return _moves(allocated, F.col("gap"), keys, largest_first=True).select(
        "from_zone", "to_zone", "drivers", km.alias("km"), *keys
    )


def rebalancing_moves_by_zone(allocated: DataFrame, grid: GridSpec, keys: list[str] | None = None) -> DataFrame:
    """The second variant: zones are served in order of their id and the gap has the other sign."""
    keys = keys or SLOT_KEYS
    km = degree_km_between(F.col("from_zone"), F.col("to_zone"), grid)
    return _moves(allocated, -F.col("gap"), keys, largest_first=False).select(
        "from_zone", "to_zone", "drivers", km.alias("distance_km"), *keys
    )


def apply_moves(allocated: DataFrame, moves: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Drivers after all moves, and the need that stays unmet."""
    keys = keys or SLOT_KEYS
    sides = F.array(
        F.struct(F.col("from_zone").alias("zone_id"), (-F.col("drivers")).alias("change")),
        F.struct(F.col("to_zone").alias("zone_id"), F.col("drivers").alias("change")),
    )
    change = moves.select(*keys, F.inline(sides)).groupBy(*keys, "zone_id").agg(F.sum("change").alias("change"))
    return (
        allocated.join(change, [*keys, "zone_id"], "left")
        .withColumn("assigned", F.col("current") + F.coalesce("change", F.lit(0)))
        .withColumn("short_after", non_negative(F.col("needed") - F.col("assigned")))
        .drop("change")
    )


def first_choice(allocated: DataFrame, keys: list[str] | None = None, stride: int = ZONE_STRIDE) -> DataFrame:
    """The nearest giving zone of every wanting zone, ties to the smaller id.

    The givers of a slot, at most one a zone, travel as one array; each wanting
    zone looks through it in place, so no pair of zones ever becomes a row.
    """
    keys = keys or SLOT_KEYS
    givers = (
        allocated.filter("gap < 0")
        .groupBy(*keys)
        .agg(F.collect_list("zone_id").alias("givers"))
    )
    nearest = F.array_min(
        F.transform(
            "givers",
            lambda giver: F.struct(cell_distance_squared(giver, F.col("zone_id"), stride).alias("d2"), giver.alias("id")),
        )
    )
    return (
        allocated.filter("gap > 0")
        .join(givers, keys)
        .withColumns({"nearest": nearest, "candidates": F.size("givers")})
        .select(*keys, "zone_id", "gap", F.col("nearest.id").alias("from_zone"), "candidates")
    )


def ranked_choices(
    allocated: DataFrame, grid: GridSpec, k: int = 5, keys: list[str] | None = None, radius: int | None = None
) -> DataFrame:
    """The ``k`` nearest giving zones of every wanting zone, in order, by rings of cells.

    Returns the keys, zone_id, gap, rank (1 to k), from_zone, spare (drivers it
    can give) and km. Nearer givers come first, ties go to the smaller id; a
    slot with fewer givers gives fewer rows, one without gives none.

    A wanting zone looks up the cells of a square around it, each of which
    holds one giver at most, so it meets the givers nearby and not all of its
    slot. A giver outside a square of radius r is at least r + 1 cells away:
    once k of those found are nearer than that, the zone is done. The others
    try again with twice the radius, at most until the square covers the grid.
    The first radius (unless given) is one that holds 2k givers on average.
    Each round is written to the shared folder, so building this runs jobs.
    """
    keys = keys or SLOT_KEYS
    store = scratch_store(allocated.sparkSession, "choices")
    givers = allocated.filter("gap < 0").select(
        *keys, F.col("zone_x").alias("x"), F.col("zone_y").alias("y"), F.col("zone_id").alias("from_zone"), (-F.col("gap")).alias("spare")
    )
    counts = store.write(givers.groupBy(*keys).agg(F.count("*").alias("candidates")), "counts")
    left = allocated.filter("gap > 0").select(*keys, "zone_id", "zone_x", "zone_y", "gap").join(counts, keys)
    if radius is None:
        mean = counts.agg(F.avg("candidates")).first()[0]
        radius = 1 if not mean else max(1, round(((2 * k * grid.n_cells / mean) ** 0.5 - 1) / 2))
    zone = [*keys, "zone_id"]
    nearest = Window.partitionBy(*zone).orderBy("d2", "from_zone")
    found, turn, reach = [], 0, max(grid.n_x, grid.n_y) - 1
    while True:
        square = left.withColumn("x", F.explode(F.sequence(F.greatest(F.lit(0), F.col("zone_x") - radius), F.least(F.lit(grid.n_x - 1), F.col("zone_x") + radius))))
        square = square.withColumn("y", F.explode(F.sequence(F.greatest(F.lit(0), F.col("zone_y") - radius), F.least(F.lit(grid.n_y - 1), F.col("zone_y") + radius))))
        dx, dy = F.col("x") - F.col("zone_x"), F.col("y") - F.col("zone_y")
        hits = square.join(givers, [*keys, "x", "y"]).withColumn("d2", dx * dx + dy * dy)
        sure = F.count_if(F.col("d2") < (radius + 1) ** 2).over(Window.partitionBy(*zone))
        done = F.lit(radius >= reach) | (sure >= F.least(F.lit(k), F.col("candidates")))
        ranked = hits.withColumns({"rank": F.row_number().over(nearest), "done": done}).filter(F.col("done") & (F.col("rank") <= k))
        found.append(store.write(ranked.select(*zone, "gap", "rank", "from_zone", "spare"), f"found-{turn}"))
        if radius >= reach:
            break
        left = store.write(left.join(found[-1].select(*zone), zone, "left_anti"), f"left-{turn}")
        if left.isEmpty():
            break
        turn, radius = turn + 1, 2 * radius + 1
    km = F.round(km_between(F.col("from_zone"), F.col("zone_id"), grid), 2)
    whole = found[0]
    for part in found[1:]:
        whole = whole.unionByName(part)
    return whole.withColumn("km", km)

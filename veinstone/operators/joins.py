"""Joins that equality alone does not express: tolerance, nearest, windows, rank pairs, as-of."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veinstone.session import looked_up, stored


def band_candidates(pred: DataFrame, gold: DataFrame, entity: str, x: str, y: str, tol_x: float, tol_y: float) -> DataFrame:
    """Pairs of equal entity within both tolerances. x is cut into cells of the tolerance's width, so that this is an equality join with the neighbouring cells."""
    p = pred.withColumn("_cell", F.explode(F.array(*[F.floor(F.col(x) / tol_x) + k for k in (-1, 0, 1)])))
    g = gold.select(F.col(entity).alias("_entity"), F.col(x).alias("gold_x"), F.col(y).alias("gold_y"), F.col("gold_id"), F.floor(F.col(x) / tol_x).alias("_gcell"))
    joined = p.join(g, (F.col("_cell") == F.col("_gcell")) & (F.col(entity) == F.col("_entity")))
    return joined.where((F.abs(F.col(x) - F.col("gold_x")) <= tol_x) & (F.abs(F.col(y) - F.col("gold_y")) <= tol_y)).drop("_cell", "_gcell", "_entity")


def places(rows: DataFrame, entity: str, x: str, y: str) -> DataFrame:
    """Each place (entity, x, y) once; what has none is within no tolerance."""
    return rows.select(entity, x, y).where(F.col(entity).isNotNull() & F.col(x).isNotNull() & F.col(y).isNotNull()).distinct()


def band_counts(pred: DataFrame, gold: DataFrame, entity: str, x: str, y: str, tol_x: float, tol_y: float, key: str) -> DataFrame:
    """Per entity the pairs within both tolerances, and the distinct predictions and gold rows in them. Pairs are made of places, which stand for as many rows as lie there."""
    at = [entity, x, y]
    p, g = (t.groupBy(*at).agg(F.count(F.lit(1)).alias("_n")) for t in (pred, gold))
    # the gold place's number of rows goes by the name of its id
    met = band_candidates(p, g.withColumn("gold_id", F.col("_n")), entity, x, y, tol_x, tol_y)
    met = stored(met.groupBy(*at).agg(F.sum(F.col("_n") * F.col("gold_id")).alias("n")), "met")
    back = band_candidates(places(gold, *at), places(pred, *at).withColumn("gold_id", F.lit(0)), entity, x, y, tol_x, tol_y).select(*at).distinct()
    n = met.groupBy(entity).agg(F.sum("n").alias("n"))
    n_pred = pred.join(met.select(*at), at, "left_semi").groupBy(entity).agg(F.countDistinct(key).alias("n_pred"))
    n_gold = gold.join(back, at, "left_semi").groupBy(entity).agg(F.countDistinct("gold_id").alias("n_gold"))
    return n.join(n_pred, entity).join(n_gold, entity)


#: Rows of either side, or pairs, that are matched one by one in a task per entity; more go by rounds, with the same result.
TOGETHER = 1_000_000
#: Keys that are looked at to cut predictions by order.
CUTS = 10_000


def about(rows: DataFrame, others: DataFrame, entity: str, x: str, y: str, tol_x: float, tol_y: float) -> DataFrame:
    """The rows with others of their entity in their cell or a neighbouring one: all that have any within tolerance, and some more."""
    cells = {"_cx": F.floor(F.col(x) / tol_x), "_cy": F.floor(F.col(y) / tol_y)}
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    spots = others.select(entity, *[c.alias(n) for n, c in cells.items()]).distinct().withColumn("_s", F.explode(steps))
    spots = spots.select(entity, (F.col("_cx") + F.col("_s.i")).alias("_cx"), (F.col("_cy") + F.col("_s.j")).alias("_cy")).distinct()
    return rows.withColumns(cells).join(spots, [entity, "_cx", "_cy"], "left_semi").select(*rows.columns)


def taken_in_turn(pred: pd.DataFrame, gold: pd.DataFrame, order: str, x: str, y: str, tol_x: float, tol_y: float) -> pd.DataFrame:
    """order and gold_id: predictions of one entity by order each take their first free gold row within tolerance. Per x of gold rows a tree of least free ids over their y is asked."""
    none, trees, at = float("inf"), [], {}
    for gx, own in gold.groupby("x"):
        ys, ids = own["y"].to_numpy(), own["gold_id"].tolist()
        by = np.argsort(ys, kind="stable")
        values, starts = np.unique(ys[by], return_index=True)
        n = len(by)
        tree = [none] * n + [ids[i] for i in by]
        for i in range(n - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        for i in range(n, 2 * n):
            at.setdefault(tree[i], []).append((len(trees), i))
        trees.append((gx, values, np.append(starts, n), n, tree))
    every = np.array([t[0] for t in trees])
    pred = pred.sort_values(order, kind="stable")
    px, py, keys = pred[x].to_numpy(), pred[y].to_numpy(), pred[order].tolist()
    # per tree the first and last leaf of each prediction's reach; |y - value| <= tol_y exactly as Spark computes it
    reach = [[] for _ in keys]
    for t in np.flatnonzero([bool((np.abs(np.unique(px) - gx) <= tol_x).any()) for gx in every]):
        gx, values, starts, n, _ = trees[t]
        rows = np.flatnonzero(np.abs(px - gx) <= tol_x)
        v = py[rows]
        low, high = np.searchsorted(values, v - tol_y), np.searchsorted(values, v + tol_y, "right")
        pick = lambda i: values[np.clip(i, 0, len(values) - 1)]  # noqa: E731,B023
        low = np.where((low > 0) & (np.abs(v - pick(low - 1)) <= tol_y), low - 1, low)
        low = np.where((low < len(values)) & (pick(low) < v) & (np.abs(v - pick(low)) > tol_y), low + 1, low)
        high = np.where((high < len(values)) & (np.abs(v - pick(high)) <= tol_y), high + 1, high)
        high = np.where((high > 0) & (pick(high - 1) > v) & (np.abs(v - pick(high - 1)) > tol_y), high - 1, high)
        for r, a, b in zip(rows.tolist(), starts[low].tolist(), starts[high].tolist()):
            if a < b:
                reach[r].append((t, a + n, b + n))
    out, i = [], 0
    while i < len(keys):
        best, key = none, keys[i]
        while i < len(keys) and keys[i] == key:  # rows of one key are one prediction
            for t, a, b in reach[i]:
                tree = trees[t][4]
                while a < b:
                    if a & 1:
                        best = min(best, tree[a])
                        a += 1
                    if b & 1:
                        b -= 1
                        best = min(best, tree[b])
                    a, b = a >> 1, b >> 1
            i += 1
        if best != none:
            out.append((key, best))
            for t, leaf in at[best]:
                tree = trees[t][4]
                tree[leaf] = none
                while leaf > 1:
                    leaf >>= 1
                    tree[leaf] = min(tree[2 * leaf], tree[2 * leaf + 1])
    return pd.DataFrame(out, columns=[order, "gold_id"])


def greedy_match(pred: DataFrame, gold: DataFrame, entity: str, x: str, y: str, tol_x: float, tol_y: float, order: str) -> DataFrame:
    """Predictions by order each take their first free gold row (by gold_id) within tolerance: order and gold_id of each match.

    Predictions are cut by order into blocks of about TOGETHER rows. A block is matched with the gold
    rows that are free, which leaves few of them where predictions are, so few later predictions have
    any about them and the rest is left out. No pairs are made, unless a block or the gold rows about
    it are more than TOGETHER: these go by `matched_in_rounds`, with the same result.
    """
    fine = lambda t: t.where(F.col(x).isNotNull() & ~F.isnan(F.col(x).cast("double")) & F.col(y).isNotNull() & ~F.isnan(F.col(y).cast("double")))
    where = (entity, x, y, tol_x, tol_y)
    free = stored(fine(gold).select("gold_id", entity, x, y), "free")
    rest = stored(about(fine(pred).select(order, entity, x, y), free, *where), "rest")
    kind, id_kind, found = pred.schema[order].dataType.simpleString(), gold.schema["gold_id"].dataType.simpleString(), []
    while True:
        n, block = rest.count(), rest
        if n > TOGETHER:
            keys = [r[0] for r in rest.where(F.pmod(F.xxhash64(order), F.lit(max(1, n // CUTS))) == 0).select(order).orderBy(order).collect()]
            cut = keys[int(len(keys) * 0.9 * TOGETHER / n)] if keys else None
            block = rest if cut is None else rest.where(F.col(order) <= F.lit(cut))
        own = stored(about(free, block, *where), "own")
        if own.count() <= TOGETHER and (n <= TOGETHER or block.count() <= TOGETHER):
            run = lambda p, g: taken_in_turn(p, g, order, x, y, tol_x, tol_y)
            golds = own.select(F.col(entity).alias("_entity"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), "gold_id")
            hits = block.select(order, entity, F.col(x).cast("double").alias(x), F.col(y).cast("double").alias(y)).groupBy(entity).cogroup(golds.groupBy("_entity")).applyInPandas(run, f"{order} {kind}, gold_id {id_kind}")
        else:
            hits = matched_in_rounds(block, own, *where, order)
        found.append(stored(hits, "matches"))
        if n <= TOGETHER or block is rest:
            return reduce(DataFrame.unionByName, found)
        free = stored(free.join(found[-1].select("gold_id"), "gold_id", "left_anti"), "free")
        rest = stored(about(rest.where(F.col(order) > F.lit(cut)), free, *where), "rest")


def matched_in_rounds(pred: DataFrame, gold: DataFrame, entity: str, x: str, y: str, tol_x: float, tol_y: float, order: str) -> DataFrame:
    """greedy_match over pairs.

    A prediction that passes a free gold row by takes another one near it, so a gold row goes to one
    of its first D predictions, D the gold rows of its entity within twice the tolerances: later
    pairs are left out. What remains is matched one by one if it is at most TOGETHER pairs, else by
    rounds: every prediction asks its first gold row, every gold row holds the earliest that asked,
    and pairs that this rules out (a gold row's later predictions) go. A gold row only ever changes
    to an earlier prediction, so what is left when no pair goes is the sequential result.
    """
    near = band_candidates(gold.select(entity, x, y, F.col("gold_id").alias("gold_of")), gold, entity, x, y, 2 * tol_x, 2 * tol_y)
    depth = near.groupBy("gold_of").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    first = Window.partitionBy("gold_id").orderBy(order)
    pairs = band_candidates(pred, gold, entity, x, y, tol_x, tol_y).select(F.col(entity).alias("_e"), order, "gold_id").distinct().withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") <= depth)
    pairs = stored(pairs.select("_e", order, "gold_id"), "pairs")
    n, kind = pairs.count(), pred.schema[order].dataType.simpleString()
    if n <= TOGETHER:

        def run(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values([order, "gold_id"])
            used, done, out = set(), set(), []
            for o, g in zip(part[order], part["gold_id"]):
                if o not in done and g not in used:
                    done.add(o)
                    used.add(g)
                    out.append((o, g))
            return pd.DataFrame(out, columns=[order, "gold_id"])

        return pairs.groupBy("_e").applyInPandas(run, f"{order} {kind}, gold_id long")
    while True:
        asked = pairs.groupBy(order).agg(F.min("gold_id").alias("gold_id"))
        held = asked.groupBy("gold_id").agg(F.min(order).alias("_holder"))
        left = stored(pairs.join(held, "gold_id", "left").where(F.col("_holder").isNull() | (F.col(order) <= F.col("_holder"))).select(order, "gold_id"), "pairs")
        m = left.count()
        if m == n:
            return held.select(F.col("_holder").alias(order), "gold_id")
        pairs, n = left, m


#: Gold rows of a cell that are few at any number of rows, that its array holds at most, and rows times gold rows above which it is cut; how often cells are cut.
FEW, MOST, WORK, ROUNDS = 16, 1024, 1 << 16, 24
#: Gold rows in all arrays up to which these are broadcast; gold rows of all cells to be cut, if also over a quarter of the rows, above which these go by pairs.
ARRAYS, SPREAD = 1 << 20, 1 << 22


def closest(x: Column, y: Column, golds: Column, of_gold: tuple[str, ...] = ()) -> Column:
    """Of an array of gold rows the nearest: d (9 digits), gold_id, dx, dy and of_gold, ties by gold_id. Only what is about as near as the nearest is rounded."""
    far = lambda g: F.abs(x - g["_gx"]) + F.abs(y - g["_gy"])
    one = lambda g: F.struct(F.round(far(g), 9).alias("d"), g["gold_id"].alias("gold_id"), F.abs(x - g["_gx"]).alias("dx"), F.abs(y - g["_gy"]).alias("dy"), *[g[c].alias(c) for c in of_gold])
    least = F.array_min(F.transform(golds, far))
    # an array of one binds the least distance, which would else be counted for each gold row
    return F.transform(F.array(least), lambda m: F.array_min(F.transform(F.filter(golds, lambda g: far(g) <= m + 1e-8), one)))[0]


def kept_near(golds: DataFrame, cells: DataFrame, on: list[str], of_gold: tuple[str, ...]) -> DataFrame:
    """Per cell (_cx, _cy, the box of its rows) the gold rows that are as near to the box as the nearest can be to any point of it, among those of the cell it is cut from."""
    g = [F.col(c).cast("double") for c in ("_gx", "_gy")]
    near = sum((F.greatest(F.col(f"_min{i}") - g[i], g[i] - F.col(f"_max{i}"), F.lit(0.0)) for i in (0, 1)), F.lit(0.0))
    far = sum((F.greatest(F.abs(F.col(f"_min{i}") - g[i]), F.abs(F.col(f"_max{i}") - g[i])) for i in (0, 1)), F.lit(0.0))
    size = F.greatest(*[F.abs(c) for c in ("_min0", "_max0", "_min1", "_max1")])
    met = golds.join(cells, on) if on else golds.crossJoin(F.broadcast(cells))
    ends = looked_up(met.groupBy("_cx", "_cy").agg(F.min(far).alias("_end")), "ends")
    slack = 1e-8 + 1e-14 * (F.col("_end") + size)  # more than rounding can change
    return stored(met.join(ends, ["_cx", "_cy"]).where(near <= F.col("_end") + slack).select("_cx", "_cy", "_gx", "_gy", "gold_id", *of_gold), "kept")


def nearest(rows: DataFrame, gold: DataFrame, x: str, y: str, key: str, width: float, of_rows: tuple[str, ...] = (), of_gold: tuple[str, ...] = ()) -> DataFrame:
    """key, gold_id, distance (sum of both coordinates' differences), dx and dy of the nearest gold row, ties by gold_id, and the columns of_rows and of_gold; none without gold rows.

    Gold rows of one place are looked up as one, the least gold_id. The rows' box is cut into cells,
    width times a power of four, each with the gold rows that can be the nearest of any of its rows.
    Cells are cut further while their rows times gold rows are many. Then a cell's gold rows are one
    array and each row meets one array, so rows make no pairs and, while the arrays can be broadcast,
    are not shuffled. Cells whose gold rows stay too many go by pairs of their places. Rows that are
    not finite look at a gold row of each kind of place: their distances differ by kind only.
    """
    spark, cell, before = rows.sparkSession, ["_cx", "_cy"], ["_px", "_py"]
    rows = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*dict.fromkeys([key, x, y, *of_rows]))
    finite = lambda *cs: reduce(Column.__and__, [F.abs(F.col(c).cast("double")) < float("inf") for c in cs])  # noqa: E731 - NaN is greater
    shown = lambda t: t.withColumn("_b", closest(F.col(x), F.col(y), F.col("_golds"), of_gold)).select(key, "_b.gold_id", F.col("_b.d").alias("distance"), "_b.dx", "_b.dy", *of_rows, *[f"_b.{c}" for c in of_gold])
    each = F.struct("_gx", "_gy", "gold_id", *of_gold)
    g = gold.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).alias("_gx"), F.col(y).alias("_gy"))
    g = stored(g.agg(F.min("gold_id").alias("gold_id"), *[F.min_by(c, "gold_id").alias(c) for c in of_gold]), "gold")
    kind = lambda c: F.when(finite(c), 0.0).otherwise(F.col(c).cast("double"))
    kinds = g.groupBy(kind("_gx").alias("_kx"), kind("_gy").alias("_ky")).agg(F.min_by(each, "gold_id").alias("_g")).agg(F.collect_list("_g").alias("_golds")).where(F.size("_golds") > 0)
    by_kind = lambda t: shown(t.crossJoin(F.broadcast(kinds)))

    box = lambda ok: [f(F.when(ok, F.col(c).cast("double"))).alias(n + str(i)) for i, c in enumerate((x, y)) for n, f in (("_min", F.min), ("_max", F.max))]
    fine = rows.where(finite(x, y))
    top = rows.agg(F.count_if(~finite(x, y)).alias("odd"), F.count_if(finite(x, y)).alias("_n"), *box(finite(x, y))).first().asDict()
    odd = top.pop("odd")
    if not top["_n"] or g.where(finite("_gx", "_gy")).isEmpty():
        return by_kind(rows)
    out = [by_kind(rows.where(~finite(x, y)))] if odd else []

    at = lambda w, names=cell: [(F.floor(F.col(c).cast("double") / w) if w else F.lit(0).cast("long")).alias(n) for c, n in zip((x, y), names)]
    cells, w, leaves, n_golds = spark.range(1).select(*[F.lit(0).cast("long").alias(c) for c in cell], *[F.lit(v).alias(c) for c, v in top.items()]), None, [], 0
    kept = kept_near(g.where(finite("_gx", "_gy")), cells, [], of_gold)
    for turn in range(ROUNDS):
        extent, n = F.greatest(F.col("_max0") - F.col("_min0"), F.col("_max1") - F.col("_min1")), F.col("_g")
        leaf = (n <= MOST) & ((n <= FEW) | (F.col("_n") * n <= WORK) | (extent == 0))
        state = F.when(leaf, "leaf").when((extent == 0) | F.lit(turn == ROUNDS - 1), "rest").otherwise("cut")
        states = stored(cells.join(kept.groupBy(*cell).agg(F.count(F.lit(1)).alias("_g")), cell).select(*cell, "_g", extent.alias("extent"), state.alias("state")), "states")
        says = {r["state"]: r for r in states.groupBy("state").agg(F.sum("_g").alias("n"), F.max("extent").alias("extent")).collect()}
        if "cut" in says and says["cut"]["n"] > max(SPREAD, top["_n"] // 4):  # gold rows at equal distances, which cuts do not part
            states = states.replace("cut", "rest", "state")
            says["rest"] = says.pop("cut")
        are = {s: looked_up(states.where(F.col("state") == s).select(*cell), s) for s in says}
        if "leaf" in says:
            arrays = kept.join(are["leaf"], cell).groupBy(*cell).agg(F.collect_list(each).alias("_golds"))
            leaves.append((turn, w, stored(arrays.withColumn("_turn", F.lit(turn)), "leaves")))
            n_golds += says["leaf"]["n"]
        if "rest" in says:
            out.append(shown(by_pairs(fine.select("*", *at(w)).join(are["rest"], cell), kept.join(are["rest"], cell), x, y, each)))
        if "cut" not in says:
            break
        power = math.floor(math.log(min(says["cut"]["extent"], 1e308) / 4 / width, 4))
        w, wide = max(width * 4.0**power, 1e-300), w
        cut = are["cut"].toDF(*before)
        cells = looked_up(fine.select(x, y, *at(wide, before), *at(w)).join(cut, before, "left_semi").groupBy(*before, *cell).agg(F.count(F.lit(1)).alias("_n"), *box(F.lit(True))), "cells")
        kept = kept_near(kept.join(are["cut"], cell).withColumnsRenamed(dict(zip(cell, before))), cells, before, of_gold)
    if leaves:
        spots = F.array(*[F.struct(F.lit(turn).alias("_turn"), *at(w)) for turn, w, _ in leaves])
        arrays, on = reduce(DataFrame.unionByName, [t for _, _, t in leaves]), ["_turn", *cell]
        there = fine.withColumn("_s", F.explode(spots)).select(*fine.columns, "_s.*")
        if n_golds > ARRAYS:  # each row finds its cell before it is shuffled
            there = there.join(looked_up(arrays.select(*on), "leaf"), on)
        out.append(shown(there.join(arrays if n_golds > ARRAYS else F.broadcast(arrays), on)))
    return reduce(DataFrame.unionByName, out)


def by_pairs(rows: DataFrame, golds: DataFrame, x: str, y: str, each: Column) -> DataFrame:
    """rows with an array of the one gold row of their cell that is the nearest, over pairs of places. Pairs are made twice, for the distance and for the least gold_id at it, and neither sorted nor shuffled whole."""
    at, far = [x, y, "_cx", "_cy"], F.abs(F.col(x) - F.col("_gx")) + F.abs(F.col(y) - F.col("_gy"))
    spots, golds = stored(rows.select(*at).distinct(), "spots"), looked_up(golds, "golds")
    least = stored(spots.join(golds, at[2:]).groupBy(*at).agg(F.min(far).alias("_d")), "least")
    hits = least.join(golds, at[2:]).where((far <= F.col("_d") + 1e-8) & (F.round(far, 9) == F.round("_d", 9))).groupBy(*at).agg(F.min("gold_id").alias("gold_id"))
    return rows.join(stored(hits.join(golds, [*at[2:], "gold_id"]).select(x, y, F.array(each).alias("_golds")), "hits"), [x, y])


def miss_reason(entity: Column, gold_entity: Column, dx: Column, dy: Column, tol_x: float, tol_y: float) -> Column:
    """Why a prediction has no match, by its nearest gold row."""
    same = F.lower(F.trim(F.coalesce(entity, F.lit("")))) == F.lower(F.trim(F.coalesce(gold_entity, F.lit(""))))
    return F.when(~same, "entity_mismatch").when((dx > tol_x) & (dy > tol_y), "x_y_outside_tolerance").when(dx > tol_x, "x_outside_tolerance").when(dy > tol_y, "y_outside_tolerance").otherwise("duplicate_or_collision")


def nearest_context(rows: DataFrame, contexts: DataFrame, by: str, line: str, key: str) -> DataFrame:
    """Each row with its group's context of the nearest line; ties go to the higher score, then the earlier context. Line 0 is far from everything."""
    c = contexts.select(F.col(by).alias("_by"), F.col(line).alias("context_line"), "score", "context")
    gap = F.when((F.col(line) == 0) | (F.col("context_line") == 0), 999999).otherwise(F.abs(F.col(line) - F.col("context_line")))
    joined = rows.join(c, F.col(by) == F.col("_by"))
    return joined.groupBy(key).agg(F.min_by("context", F.struct(gap.alias("d"), (-F.col("score")).alias("s"), "context_line")).alias("context"), F.min(gap).alias("gap"))


def window_assemble(rows: DataFrame, by: str, line: str, k: int) -> DataFrame:
    """Around each line the best x and y values within k lines: the nearest, then the most confident, then the earliest."""
    anchors = rows.select(F.col(by).alias("_by"), F.col(line).alias("anchor")).distinct()
    near = rows.join(anchors, (F.col(by) == F.col("_by")) & F.col(line).between(F.col("anchor") - k, F.col("anchor") + k))
    rank = F.struct(F.abs(F.col(line) - F.col("anchor")).alias("d"), (-F.col("confidence")).alias("c"), F.col(line).alias("l"))
    pick = lambda v: F.min_by(F.when(F.col("variable_name") == v, F.col("value")), F.when(F.col("variable_name") == v, rank))
    return near.groupBy(by, "anchor").agg(pick("x").alias("x"), pick("y").alias("y"))


def rank_zip(left: DataFrame, right: DataFrame, by: str, order_left: list[Column], order_right: list[Column], most: int) -> DataFrame:
    """The i-th of left with the i-th of right in each group, for i up to most."""
    rank = lambda t, o: t.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*o))).where(F.col("rank") <= most)
    return rank(left, order_left).join(rank(right, order_right), [by, "rank"])


def as_of(rows: DataFrame, facts: DataFrame, by: str, at: str, value: str) -> DataFrame:
    """rows with the last fact at or before them in their group: one sort of the union, no range join."""
    both = rows.withColumn("_fact", F.lit(None).cast(facts.schema[value].dataType)).withColumn("_row", F.lit(1)).unionByName(facts.select(by, at, F.col(value).alias("_fact"), F.lit(0).alias("_row")), allowMissingColumns=True)
    w = Window.partitionBy(by).orderBy(at, "_row").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last("_fact", ignorenulls=True).over(w)).where("_row = 1").drop("_fact", "_row")


def prf(tp: Column, fp: Column, fn: Column) -> list[Column]:
    precision = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    return [precision.alias("precision"), recall.alias("recall"), F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0).alias("f1")]

"""Regression trees grown level by level, with one histogram aggregate per level.

Rows hold ``codes`` (per feature the number of its value among the sorted distinct values), a target
``y``, a weight ``w`` (copies of the row) and the ``node`` they are in. For each level every task sends
its rows down the tree and adds up rows and targets per (node, feature, code), whole Arrow batches at a
time; Spark adds up the tasks' histograms, and running totals per (node, feature) give every cut between
neighbouring values. The best cut per open node and feature comes to the driver, never rows of the
table. While the histograms of all tasks together have at most ``FEW_CELLS`` cells, as those of few open
nodes over few values do, they come to the driver instead, which saves both shuffles. Several trees grow at once, so a forest takes as many passes as one tree. Only rows in open nodes
are read on; they are stored every ``STORE_EVERY`` levels, so a tree may be as deep as it needs to be.

Everything random is drawn from a digest of (seed, tree, node, feature), never from the order or place
of rows: a seed gives the same trees on any partitioning. Cuts whose gains agree to nine digits count
as equal, and the first feature and lowest cut of them is taken. A tree's nodes are numbered like a
heap for this: the root is 1 and the children of n are 2n and 2n + 1.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable
from contextlib import ExitStack
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.ml.trees import Flat, Nodes, constant, descend
from shelfcast.operators.quantiles import running_totals, value_at
from shelfcast.session import materialized, ship_package

STORE_EVERY = 6  # levels
MOST_VALUES = 65_536  # distinct values of a feature that are told apart at most
MEDIAN_VALUES = 256  # the same for the median criterion, which visits every row once per cut
MOST_CELLS = 1 << 22  # of a task's histogram that is kept whole; beyond it goes out batch by batch
FEW_CELLS = 1 << 20  # of all tasks' histograms up to which the driver adds them up and looks for cuts
SAME_GAIN = 1e-9
PURE = 1e-12  # spread of a node's targets, as a share of their squares, from which it is not divided


@dataclass(frozen=True)
class Rules:
    criterion: str = "squared_error"  # or friedman_mse (the same splits), poisson, absolute_error
    splitter: str = "best"  # or random: one cut per node and feature, drawn within the node's range
    max_depth: int | None = None
    max_features: int | None = None  # varying features tried per node; None is all
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    min_weight_fraction_leaf: float = 0.0
    min_impurity_decrease: float = 0.0  # of the whole table: the node's share times its own decrease
    max_bins: int | None = None
    seed: int | str = 42

    @property
    def most_values(self) -> int:
        return min(self.max_bins or MOST_VALUES, MEDIAN_VALUES if self.criterion == "absolute_error" else MOST_VALUES)


def draw(*parts) -> float:
    """A number from 0 to below 1 out of the MD5 digest of the parts, joined by slashes."""
    return int(hashlib.md5("/".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 2.0**32


def draw_column(*parts: Column | str | int) -> Column:
    """``draw`` for rows."""
    text = F.concat_ws("/", *[part if isinstance(part, Column) else F.lit(str(part)) for part in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / 2.0**32


def poisson_count(chance: Column) -> Column:
    """How often a row is drawn when as many rows as there are are drawn with replacement: Poisson(1)."""
    count, below, term = F.when(F.lit(False), 0), 0.0, math.exp(-1)
    for number in range(16):
        below += term
        term /= number + 1
        count = count.when(chance < below, number)
    return count.otherwise(16)


@dataclass(frozen=True)
class Codes:
    """What the codes of each feature stand for."""

    edges: list[np.ndarray]  # sorted values; the largest of each bin where values were put together
    wide: list[bool]  # whether they were

    @property
    def offsets(self) -> np.ndarray:
        """Place of each feature's first code in a histogram, and the size of it."""
        return np.concatenate([[0], np.cumsum([max(len(own), 1) for own in self.edges])])

    def cut(self, feature: int, code: int, following: int) -> float:
        """Between two values; a bin's own largest value, as others lie behind it."""
        own = self.edges[feature]
        return float(own[code]) if self.wide[feature] else float((own[code] + own[following]) / 2)

    @staticmethod
    def of(rows: DataFrame, width: int, most: int) -> "Codes":
        """Codes of the ``width`` features in ``x``. Bins of a feature with more than ``most`` values hold
        about as many rows each, ``w`` of them per row if there is such a column; only their edges come to
        the driver."""
        number = F.col("w").cast("long") if "w" in rows.columns else F.lit(1).cast("long")
        values = rows.select(F.posexplode("x").alias("feature", "v"), number.alias("copies"))
        with materialized(values.groupBy("feature", "v").agg(F.sum("copies").alias("rows")), "feature-values") as counts:
            sizes = {row["feature"]: row["count"] for row in counts.groupBy("feature").count().collect()}
            wide = [sizes.get(feature, 0) > most for feature in range(width)]
            few = [feature for feature in range(width) if not wide[feature]]
            found = counts.filter(F.col("feature").isin(few)).select("feature", "v").collect()
            if any(wide):
                many = counts.filter(~F.col("feature").isin(few))
                with running_totals(many, ["feature"], "v") as running:
                    number = F.floor(F.col("before") * most / F.col("total"))
                    found += running.groupBy("feature", number.alias("bin")).agg(F.max("v").alias("v")).select("feature", "v").collect()
        edges = [[] for _ in range(width)]
        for feature, value in found:
            edges[feature].append(value)
        return Codes([np.array(sorted(own)) for own in edges], wide)

    def encode(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``codes`` instead of ``x``."""
        ship_package(rows.sparkSession)
        edges, rest = self.edges, [column for column in rows.columns if column != "x"]

        def encode(batches):
            for batch in batches:
                values = matrix(batch.column(0), len(edges))
                codes = np.stack([np.searchsorted(own, values[:, place]) for place, own in enumerate(edges)], axis=1)
                yield pa.RecordBatch.from_arrays([lists(codes), *batch.columns[1:]], ["codes", *rest])

        kinds = "".join(f", {column} {rows.schema[column].dataType.simpleString()}" for column in rest)
        return rows.select("x", *rest).mapInArrow(encode, f"codes array<int>{kinds}")


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def lists(codes: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.astype(np.int32).ravel()))


# Codes, target, weight and node of each row of a batch.
State = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Stored:
    """State of rows with columns ``codes, y, w, node``."""

    width: int

    def __call__(self, batch: pa.RecordBatch):
        own = [batch.column(name).to_numpy(zero_copy_only=False) for name in ("y", "w", "node")]
        return matrix(batch.column("codes"), self.width), own[0], own[1], own[2].astype(np.int64)


def histograms(rows: DataFrame, state: State, flat: Flat, steps: int, first: int, opened: int, offsets: np.ndarray) -> DataFrame:
    """``node, feature, code, n, s, q`` of the ``opened`` nodes from ``first`` on: rows, sum and squares of
    targets. A row per task or batch; they are still to be added up."""
    ship_package(rows.sparkSession)
    size = int(offsets[-1])

    def cells(keys: np.ndarray, sums: Iterable[np.ndarray]) -> pa.RecordBatch:
        feature = np.searchsorted(offsets, keys % size, side="right") - 1
        columns = [first + keys // size, feature, keys % size - offsets[feature]]
        return pa.RecordBatch.from_arrays(
            [*[pa.array(column.astype(np.int32)) for column in columns], *map(pa.array, sums)], ["node", "feature", "code", "n", "s", "q"]
        )

    def add_up(batches):
        whole = [np.zeros(opened * size) for _ in range(3)] if opened * size <= MOST_CELLS else None
        for batch in batches:
            codes, target, weight, node = state(batch)
            node = flat.descend(codes, node, steps)
            here = node >= first
            keys = ((node[here] - first)[:, None] * size + offsets[:-1] + codes[here]).ravel()
            width = codes.shape[1]
            target, weight = np.repeat(target[here], width), np.repeat(weight[here], width)
            found = None
            if whole is None:
                found, keys = np.unique(keys, return_inverse=True)
            length = opened * size if found is None else len(found)
            sums = [np.bincount(keys, values, length) for values in (weight, weight * target, weight * target * target)]
            if whole is None:
                yield cells(found, sums)
            else:
                for total, part in zip(whole, sums):
                    total += part
        if whole is not None:
            filled = np.flatnonzero(whole[0])
            yield cells(filled, [total[filled] for total in whole])

    return rows.mapInArrow(add_up, "node int, feature int, code int, n double, s double, q double")


def _gain(criterion: str) -> str:
    """SQL for how much a cut lowers the node's impurity, summed over its rows; NULL if it may not be made."""
    if criterion == "poisson":
        return "if(sl > 0 AND s - sl > 0, sl * ln(sl / nl) + (s - sl) * ln((s - sl) / (n - nl)) - s * ln(s / n), NULL)"
    return "sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n"


def _gain_of(criterion: str, n: np.ndarray, s: np.ndarray, nl: np.ndarray, sl: np.ndarray) -> np.ndarray:
    """``_gain`` for arrays; NaN if a cut may not be made."""
    if criterion == "poisson":
        gain = sl * np.log(sl / nl) + (s - sl) * np.log((s - sl) / (n - nl)) - s * np.log(s / n)
        return np.where((sl > 0) & (s - sl > 0), gain, np.nan)
    return sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n


OWN = "PARTITION BY node, feature"


@dataclass(frozen=True)
class Best:
    """The best cut of a node along a feature; ``gain`` is None if there is none that is allowed."""

    node: int
    feature: int
    n: float
    varies: bool
    gain: float | None
    code: int | None
    cut: float | None
    nl: float | None
    left: float | None
    right: float | None


class Grower:
    """Grows the trees with roots 0, 1, ... over rows that ``state`` understands."""

    def __init__(self, rules: Rules, codes: Codes, roots: int = 1):
        self.rules, self.codes, self.roots, self.nodes = rules, codes, roots, Nodes()
        self.paths = [1] * roots
        self.tree = list(range(roots))
        self.whole = [0.0] * roots  # weight of each tree's rows

    def grow(self, rows: DataFrame, state: State | None = None) -> Nodes:
        """``state`` is for rows other than ``codes, y, w, node``; those of a tree that is stored on the
        way have to have just these columns."""
        state = state or Stored(len(self.codes.edges))
        self.tasks = rows.rdd.getNumPartitions()
        for root in range(self.roots):
            self.nodes.add(0.0, 0)
        first, stored_level, level, opened = 0, 0, 0, list(range(self.roots))
        with ExitStack() as stack:
            while opened and (self.rules.max_depth is None or level < self.rules.max_depth):
                if level - stored_level == STORE_EVERY:
                    node = descend(self.nodes, "codes", F.col("node"), level - stored_level, first)
                    rows = stack.enter_context(materialized(rows.withColumn("node", node).filter(F.col("node") >= min(opened)), "open-rows"))
                    first, stored_level = min(opened), level
                found = self._found(rows, state, first, level - stored_level, opened)
                opened = [child for best in self._chosen(found) for child in self._split(best, level)]
                level += 1
        return self.nodes

    def _found(self, rows: DataFrame, state: State, first: int, steps: int, opened: list[int]) -> list[Best]:
        if self.rules.criterion == "absolute_error":
            here = rows.withColumn("node", descend(self.nodes, "codes", F.col("node"), steps, first))
            return self._median_cuts(here.filter(F.col("node") >= min(opened)), min(opened))
        parts = histograms(rows, state, Flat.of(self.nodes, first), steps, min(opened), len(self.paths) - min(opened), self.codes.offsets)
        cells = (len(self.paths) - min(opened)) * int(self.codes.offsets[-1])
        if self.rules.splitter == "best" and cells * self.tasks <= FEW_CELLS:
            return self._added_up(parts.toArrow(), min(opened))
        counts = parts.groupBy("node", "feature", "code").agg(F.expr("sum(n) AS n"), F.expr("sum(s) AS s"), F.expr("sum(q) AS q"))
        cuts = counts.selectExpr(
            "node", "feature", "code", f"lead(code) OVER ({OWN} ORDER BY code) AS following", "n AS nv", "s AS sv",
            f"sum(n) OVER ({OWN}) AS n", f"sum(s) OVER ({OWN}) AS s", f"sum(q) OVER ({OWN}) AS q",
            f"sum(n) OVER ({OWN} ORDER BY code) AS nl", f"sum(s) OVER ({OWN} ORDER BY code) AS sl",
            f"min(code) OVER ({OWN}) AS least", f"max(code) OVER ({OWN}) AS most",
        )
        if self.rules.splitter == "random":
            cuts = self._at_random(cuts, min(opened)).groupBy("node", "feature", "n", "s", "q", "least", "most", "cut").agg(
                F.expr("sum(if(goes_left, nv, 0)) AS nl"), F.expr("sum(if(goes_left, sv, 0)) AS sl"),
                F.expr("max(if(goes_left, code, NULL)) AS code"), F.expr("CAST(NULL AS INT) AS following"),
            )
        else:
            cuts = cuts.selectExpr("*", "CAST(NULL AS DOUBLE) AS cut")
        whole = "n" if not self.whole[0] else f"get({self._per_node(self.whole, min(opened))}, node - {min(opened)})"
        least = f"greatest({float(self.rules.min_samples_leaf)}D, {float(self.rules.min_weight_fraction_leaf)}D * {whole})"
        allowed = (
            f"code < most AND n >= {self.rules.min_samples_split} AND q - s * s / n > {PURE} * q AND nl >= {least} AND n - nl >= {least}"
        )
        gains = cuts.selectExpr("*", f"if({allowed}, {_gain(self.rules.criterion)}, NULL) AS gain")
        best = _first_best(gains, "struct(code, following, cut, nl, sl, gain)", "any_value(n) AS n", "any_value(s) AS s", "any_value(least < most) AS varies")
        return [self._read(row) for row in best.collect()]

    def _added_up(self, parts: pa.Table, first: int) -> list[Best]:
        """The same cuts from the histograms of all tasks."""
        rules, offsets, size = self.rules, self.codes.offsets, int(self.codes.offsets[-1])
        node, feature, code, *sums = (parts.column(name).to_numpy() for name in ("node", "feature", "code", "n", "s", "q"))
        keys, length = (node - first) * size + offsets[feature] + code, (len(self.paths) - first) * size
        whole = [np.bincount(keys, values, length).reshape(-1, size) for values in sums]
        found = []
        for feature in range(len(self.codes.edges)):
            n, s, q = (total[:, offsets[feature]:offsets[feature + 1]] for total in whole)
            nl, sl = n.cumsum(axis=1), s.cumsum(axis=1)
            rows, total, squares = nl[:, -1:], sl[:, -1:], q.sum(axis=1, keepdims=True)
            if first < self.roots:
                for root in range(self.roots):
                    self._start(root, rows[root, 0], total[root, 0])
            weight = np.array([self.whole[tree] for tree in self.tree[first:]])[:, None]
            least = np.maximum(rules.min_samples_leaf, rules.min_weight_fraction_leaf * weight)
            there = n > 0
            last = there.shape[1] - 1 - there[:, ::-1].argmax(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                allowed = (
                    there & (np.arange(there.shape[1]) < last[:, None]) & (rows >= rules.min_samples_split)
                    & (squares - total * total / rows > PURE * squares) & (nl >= least) & (rows - nl >= least)
                )
                gain = _gain_of(rules.criterion, rows, total, nl, sl)
            gain = np.where(allowed & ~np.isnan(gain), gain, -np.inf)
            top = gain.max(axis=1)
            near = np.isfinite(gain) & (gain >= (top - SAME_GAIN * np.abs(top))[:, None])
            for at in np.flatnonzero(rows[:, 0] > 0).tolist():
                varies = bool(there[at].argmax() < last[at])
                if not near[at].any():
                    found.append(Best(first + at, feature, rows[at, 0], varies, *[None] * 6))
                    continue
                best = int(near[at].argmax())
                following = best + 1 + int(there[at, best + 1:].argmax())
                left, right = sl[at, best] / nl[at, best], (total[at, 0] - sl[at, best]) / (rows[at, 0] - nl[at, best])
                cut = self.codes.cut(feature, best, following)
                found.append(Best(first + at, feature, rows[at, 0], varies, gain[at, best], best, cut, nl[at, best], left, right))
        return found

    def _start(self, root: int, rows: float, total: float) -> None:
        if rows and not self.whole[root]:
            self.whole[root], self.nodes.value[root] = float(rows), float(total / rows)

    def _read(self, row) -> Best:
        if row["node"] < self.roots:
            self._start(row["node"], row["n"], row["s"])
        own = row["best"]
        if own is None:
            return Best(row["node"], row["feature"], row["n"], row["varies"], *[None] * 6)
        cut = own["cut"] if own["cut"] is not None else self.codes.cut(row["feature"], own["code"], own["following"])
        left, right = own["sl"] / own["nl"], (row["s"] - own["sl"]) / (row["n"] - own["nl"])
        return Best(row["node"], row["feature"], row["n"], row["varies"], own["gain"], own["code"], cut, own["nl"], left, right)

    def _per_node(self, per_tree: list[float], first: int) -> str:
        return constant([per_tree[tree] for tree in self.tree[first:]], "double")

    def _at_random(self, cuts: DataFrame, first: int) -> DataFrame:
        """Adds ``cut``, drawn between the node's least and greatest value, and whether a code ``goes_left``."""
        width, offsets = len(self.codes.edges), self.codes.offsets
        chances = [
            draw(self.rules.seed, self.tree[node], self.paths[node], feature, "cut")
            for node in range(first, len(self.paths)) for feature in range(width)
        ]
        values = np.concatenate([own if len(own) else [0.0] for own in self.codes.edges]).tolist()

        def value(code: str) -> str:
            return f"get({constant(values, 'double')}, get({constant(offsets[:-1].tolist(), 'int')}, feature) + {code})"

        chance = f"get({constant(chances, 'double')}, (node - {first}) * {width} + feature)"
        drawn = cuts.filter("least < most").selectExpr("*", f"{value('least')} AS low", f"{value('most')} AS high", f"{value('code')} AS v")
        drawn = drawn.selectExpr("*", f"low + {chance} * (high - low) AS at").selectExpr("*", "if(at < high, at, low) AS cut")
        varying = drawn.selectExpr("*", "v <= cut AS goes_left")
        rest = cuts.filter("least = most").selectExpr("*", *[f"CAST(NULL AS DOUBLE) AS {c}" for c in ("low", "high", "v", "at", "cut")], "false AS goes_left")
        return varying.unionByName(rest)

    def _chosen(self, found: list[Best]) -> list[Best]:
        """The best split of each node among the features tried."""
        per_node: dict[int, list[Best]] = {}
        for best in found:
            if best.varies:
                per_node.setdefault(best.node, []).append(best)
        chosen = []
        for node, own in sorted(per_node.items()):
            if self.rules.max_features is not None:
                own.sort(key=lambda best: (draw(self.rules.seed, self.tree[node], self.paths[node], best.feature, "feature"), best.feature))
                own = own[:self.rules.max_features]
            own = [best for best in own if best.gain is not None]
            if own:
                top = max(best.gain for best in own)
                chosen.append(min((best for best in own if best.gain >= top - SAME_GAIN * abs(top)), key=lambda best: best.feature))
        return chosen

    def _split(self, best: Best, level: int) -> list[int]:
        """Children of a node that the split is good enough for."""
        nodes, node = self.nodes, best.node
        if best.gain / self.whole[self.tree[node]] + 2.3e-16 < self.rules.min_impurity_decrease:
            return []
        children = []
        for value in (best.left, best.right):
            children.append(nodes.add(float(value), level + 1))
            self.paths.append(2 * self.paths[node] + len(children) - 1)
            self.tree.append(self.tree[node])
        nodes.feature[node], nodes.cut[node], nodes.code[node] = best.feature, float(best.cut), best.code
        nodes.left[node], nodes.right[node] = children
        return children

    def _median_cuts(self, here: DataFrame, first: int) -> list[Best]:
        """The best cuts by the fall of the summed distance to the median, with the medians of both sides.

        Every row is counted on one side of each cut of its node, so the work is rows times cuts.
        """
        with ExitStack() as stack:
            counts = here.selectExpr("node", "y", "w", "posexplode(codes) AS (feature, code)").groupBy("node", "feature", "code", "y").agg(F.expr("sum(w) AS rows"))
            counts = stack.enter_context(materialized(counts, "value-counts"))
            values = counts.groupBy("node", "feature", "code").agg(F.expr("sum(rows) AS nv")).selectExpr(
                "node", "feature", "code", f"lead(code) OVER ({OWN} ORDER BY code) AS following",
                f"min(code) OVER ({OWN}) AS least", f"max(code) OVER ({OWN}) AS most",
            )
            if self.rules.splitter == "random":
                cuts = self._at_random(values, first).filter("goes_left").groupBy("node", "feature", "cut").agg(
                    F.expr("max(code) AS code"), F.expr("CAST(NULL AS INT) AS following")
                )
            else:
                cuts = values.filter("following IS NOT NULL").selectExpr("node", "feature", "code", "following", "CAST(NULL AS DOUBLE) AS cut")
            sides = counts.withColumnRenamed("code", "own").join(cuts.select("node", "feature", "code"), ["node", "feature"]).groupBy(
                "node", "feature", "code", F.expr("own > code AS side"), "y"
            ).agg(F.expr("sum(rows) AS rows"))
            divided = _distances(sides, ["node", "feature", "code", "side"], stack).groupBy("node", "feature", "code").agg(
                F.expr("max(if(side, NULL, n)) AS nl"), F.expr("max(if(side, NULL, median)) AS left_value"),
                F.expr("max(if(side, median, NULL)) AS right_value"), F.expr("sum(distance) AS divided"),
            )
            counted = here.groupBy("node", "y").agg(F.expr("sum(w) AS rows"))
            nodes = _distances(counted, ["node"], stack).withColumnsRenamed({"median": "middle", "distance": "undivided"})
            nodes = stack.enter_context(materialized(nodes, "node-medians"))
            if not self.whole[0]:
                for row in nodes.collect():
                    self.whole[row["node"]], self.nodes.value[row["node"]] = row["n"], row["middle"]
            whole = f"get({self._per_node(self.whole, first)}, node - {first})"
            least = f"greatest({float(self.rules.min_samples_leaf)}D, {float(self.rules.min_weight_fraction_leaf)}D * {whole})"
            allowed = f"undivided > 0 AND n >= {self.rules.min_samples_split} AND nl >= {least} AND n - nl >= {least}"
            gains = divided.join(cuts, ["node", "feature", "code"]).join(nodes, "node").selectExpr("*", f"if({allowed}, undivided - divided, NULL) AS gain")
            found = _first_best(gains, "struct(code, following, cut, nl, left_value, right_value, gain)", "any_value(n) AS n").collect()
        result = []
        for row in found:
            own = row["best"]
            if own is None:
                result.append(Best(row["node"], row["feature"], row["n"], True, *[None] * 6))
                continue
            cut = own["cut"] if own["cut"] is not None else self.codes.cut(row["feature"], own["code"], own["following"])
            result.append(Best(row["node"], row["feature"], row["n"], True, own["gain"], own["code"], cut, own["nl"], own["left_value"], own["right_value"]))
        return result


def _first_best(gains: DataFrame, entry: str, *more: str) -> DataFrame:
    """Per node and feature ``best``: the entry with the lowest code among those with the largest gain, or NULL."""
    near = gains.selectExpr("*", f"max(gain) OVER ({OWN}) AS top")
    best = F.expr(f"min(if(gain >= top - {SAME_GAIN}D * abs(top), {entry}, NULL)) AS best")
    return near.groupBy("node", "feature").agg(best, *map(F.expr, more))


def _distances(counts: DataFrame, by: list[str], stack: ExitStack) -> DataFrame:
    """Per group: rows ``n``, ``median``, and the summed ``distance`` of ``y`` to it. ``counts`` has ``rows`` per ``y``."""
    running = stack.enter_context(running_totals(counts, by, "y"))
    half = F.col("total") / 2
    below = F.least(F.col("before") + F.col("rows"), half) - F.least(F.col("before"), half)
    middle = (value_at(F.floor((F.col("total") - 1) / 2), "y") + value_at(F.floor(half), "y")) / 2
    return running.groupBy(*by).agg(
        F.max("total").alias("n"), middle.alias("median"), F.sum(F.col("y") * (F.col("rows") - 2 * below)).alias("distance")
    )

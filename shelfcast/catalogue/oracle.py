"""The same results in DuckDB SQL over the same tables, written independently of the Spark code."""

from __future__ import annotations

import math

INPUTS = {
    "transactions": """
        SELECT CAST(o_orderdate AS DATE) AS date, c_nationkey + 1 AS store_nbr,
               CAST(count(*) AS BIGINT) AS transactions
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
    "sales": """
        SELECT CAST(date - DATE '1995-01-01' AS BIGINT) * 150 + (store_nbr - 1) * 6
               + CASE family WHEN 'ECONOMY' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'MEDIUM' THEN 2
                             WHEN 'PROMO' THEN 3 WHEN 'SMALL' THEN 4 ELSE 5 END AS id, *
        FROM (SELECT CAST(o_orderdate AS DATE) AS date, c_nationkey + 1 AS store_nbr, p_type AS family,
                     sum(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END) AS sales,
                     CAST(sum(CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END) AS BIGINT) AS onpromotion
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                            JOIN customer ON o_custkey = c_custkey
                            JOIN part ON l_partkey = p_partkey
              GROUP BY 1, 2, 3) q""",
    "train": "SELECT * FROM sales WHERE date < DATE '2001-01-01'",
    "test": "SELECT id, date, store_nbr, family, onpromotion FROM sales WHERE date >= DATE '2001-01-01'",
    "oil": """
        SELECT CAST(o_orderdate AS DATE) AS date,
               CASE WHEN day(CAST(o_orderdate AS DATE)) <> 1
                    THEN CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE)
                         / CAST(count(*) * 100000 AS DOUBLE) END AS dcoilwtico
        FROM orders WHERE extract(DOW FROM CAST(o_orderdate AS DATE)) BETWEEN 1 AND 5
        GROUP BY CAST(o_orderdate AS DATE)""",
    "holidays": """
        SELECT CAST(o_orderdate AS DATE) AS date, o_orderstatus AS type
        FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 10 = 0""",
    "year_train": "SELECT * FROM train WHERE year(date) = 1997",
    "enriched": """
        SELECT t.id, t.date, store_nbr, family, sales, CASE WHEN onpromotion > 0 THEN 1 ELSE 0 END AS onpromotion,
               dcoilwtico, type, CASE WHEN type IS NULL THEN 0 ELSE 1 END AS is_holiday
        FROM year_train t LEFT JOIN oil o ON t.date = o.date LEFT JOIN holidays h ON t.date = h.date""",
    "enriched_test": """
        SELECT t.id, t.date, store_nbr, family, CASE WHEN onpromotion > 0 THEN 1 ELSE 0 END AS onpromotion,
               dcoilwtico, type, CASE WHEN type IS NULL THEN 0 ELSE 1 END AS is_holiday
        FROM test t LEFT JOIN oil o ON t.date = o.date LEFT JOIN holidays h ON t.date = h.date""",
    "folded": """
        SELECT *, CAST(ntile(5) OVER (ORDER BY date, store_nbr, family, type) - 1 AS INTEGER) AS fold
        FROM enriched""",
}

WITH_INPUTS = "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in INPUTS.items())


def _q(sql: str) -> str:
    return f"{WITH_INPUTS}\n{sql}"


def _moving(where: str) -> str:
    averages = ", ".join(
        f"""CASE WHEN count(transactions) OVER (ORDER BY date ROWS {n - 1} PRECEDING) = {n}
            THEN round(avg(transactions) OVER (ORDER BY date ROWS {n - 1} PRECEDING), 6) END AS "{n}_day_MA\""""
        for n in (7, 14, 30, 60)
    )
    return f"""SELECT date, transactions, {averages}
        FROM (SELECT date, CAST(sum(transactions) AS BIGINT) AS transactions
              FROM transactions WHERE {where} GROUP BY date) d"""


def _filled(oil: str) -> str:
    return f"""SELECT id, type, CAST(store_nbr AS DOUBLE) AS store_nbr, CAST(onpromotion AS DOUBLE) AS onpromotion,
        coalesce(dcoilwtico, round({oil}, 6)) AS dcoilwtico, CAST(is_holiday AS DOUBLE) AS is_holiday FROM enriched"""


LEVELS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

SCALED = """
    SELECT id, type, family,
           round((store_nbr - min(store_nbr) OVER ()) / (max(store_nbr) OVER () - min(store_nbr) OVER ())::DOUBLE, 6) AS store_nbr,
           round((onpromotion - min(onpromotion) OVER ())::DOUBLE, 6) AS onpromotion,
           round((oil - min(oil) OVER ()) / (max(oil) OVER () - min(oil) OVER ()), 6) AS dcoilwtico,
           round((is_holiday - min(is_holiday) OVER ())::DOUBLE, 6) AS is_holiday
    FROM (SELECT *, coalesce(dcoilwtico, avg(dcoilwtico) OVER ()) AS oil FROM enriched) e"""


def _box(column: str) -> str:
    return f"""
    SELECT round(min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
           round(any_value(q1), 6) AS q1, round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3,
           round(max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
           count(*) FILTER (v NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
    FROM (SELECT coalesce({column}, 0)::DOUBLE AS v FROM enriched) e,
         (SELECT quantile_cont(coalesce({column}, 0)::DOUBLE, 0.25) AS q1,
                 quantile_cont(coalesce({column}, 0)::DOUBLE, 0.5) AS q2,
                 quantile_cont(coalesce({column}, 0)::DOUBLE, 0.75) AS q3 FROM enriched) s"""


def _least_squares(train: str, score: str) -> str:
    """CTEs that regress ``y`` on x1..x4 within families, per group ``g``, and predict ``score`` rows.

    ``train``: g, family, y, x1..x4. ``score``: g, family, x1..x4 and more. Family slots and the
    intercept are removed by centring within families; the four slopes follow by orthogonalising
    one column after another. Scaling of the columns changes no prediction and is left out.
    """
    def slope(name: str, of: str, on: str) -> str:
        return f"sum({of} * {on}) OVER (PARTITION BY g) / sum({on} * {on}) OVER (PARTITION BY g) AS {name}"

    return f"""
    fit_rows AS ({train}),
    centre AS (SELECT g, family, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, avg(x4) AS m4
               FROM fit_rows GROUP BY g, family),
    c0 AS (SELECT r.g, y - my AS y, x1 - m1 AS x1, x2 - m2 AS x2, x3 - m3 AS x3, x4 - m4 AS x4
           FROM fit_rows r JOIN centre c ON r.g = c.g AND r.family = c.family),
    s1 AS (SELECT *, {slope('a12', 'x2', 'x1')}, {slope('a13', 'x3', 'x1')}, {slope('a14', 'x4', 'x1')},
                  {slope('c1', 'y', 'x1')} FROM c0),
    c1 AS (SELECT * REPLACE (y - c1 * x1 AS y, x2 - a12 * x1 AS x2, x3 - a13 * x1 AS x3, x4 - a14 * x1 AS x4) FROM s1),
    s2 AS (SELECT *, {slope('a23', 'x3', 'x2')}, {slope('a24', 'x4', 'x2')}, {slope('c2', 'y', 'x2')} FROM c1),
    c2 AS (SELECT * REPLACE (y - c2 * x2 AS y, x3 - a23 * x2 AS x3, x4 - a24 * x2 AS x4) FROM s2),
    s3 AS (SELECT *, {slope('a34', 'x4', 'x3')}, {slope('c3', 'y', 'x3')} FROM c2),
    c3 AS (SELECT * REPLACE (y - c3 * x3 AS y, x4 - a34 * x3 AS x4) FROM s3),
    s4 AS (SELECT DISTINCT ON (g) *, {slope('b4', 'y', 'x4')} FROM c3),
    b3 AS (SELECT *, c3 - a34 * b4 AS b3 FROM s4),
    b2 AS (SELECT *, c2 - a23 * b3 - a24 * b4 AS b2 FROM b3),
    b1 AS (SELECT *, c1 - a12 * b2 - a13 * b3 - a14 * b4 AS b1 FROM b2),
    fitted AS (SELECT s.*, my + b1 * (s.x1 - m1) + b2 * (s.x2 - m2) + b3 * (s.x3 - m3) + b4 * (s.x4 - m4) AS p
               FROM ({score}) s JOIN centre c ON s.g = c.g AND s.family = c.family JOIN b1 ON b1.g = s.g)"""


# Training and scoring rows of a model: the whole year and the test table (g = 0), or per fold g all
# other folds and that fold.
YEAR_ROWS = """
    SELECT 0 AS g, family, greatest(sales, 0) AS y, store_nbr::DOUBLE AS x1, onpromotion::DOUBLE AS x2,
           coalesce(dcoilwtico, avg(dcoilwtico) OVER ()) AS x3, is_holiday::DOUBLE AS x4 FROM enriched"""
TEST_ROWS = """
    SELECT 0 AS g, id, family, store_nbr::DOUBLE AS x1, onpromotion::DOUBLE AS x2,
           coalesce(dcoilwtico, (SELECT avg(dcoilwtico) FROM enriched)) AS x3, is_holiday::DOUBLE AS x4
    FROM enriched_test"""
OTHER_FOLDS = """
    SELECT k.g, family, greatest(sales, 0) AS y, store_nbr::DOUBLE AS x1, onpromotion::DOUBLE AS x2,
           coalesce(dcoilwtico, avg(dcoilwtico) OVER (PARTITION BY k.g)) AS x3, is_holiday::DOUBLE AS x4
    FROM folded, (SELECT unnest(range(5)) AS g) k WHERE fold <> k.g"""
HELD_OUT_FOLD = """
    SELECT fold AS g, family, greatest(sales, 0) AS y, store_nbr::DOUBLE AS x1, onpromotion::DOUBLE AS x2,
           coalesce(dcoilwtico, oil_mean) AS x3, is_holiday::DOUBLE AS x4
    FROM folded JOIN (SELECT k.g, avg(dcoilwtico) AS oil_mean FROM folded, (SELECT unnest(range(5)) AS g) k
                      WHERE fold <> k.g GROUP BY k.g) m ON fold = m.g"""

SPLIT_VALUE = f"""CASE feat WHEN 0 THEN x1 WHEN 1 THEN x2 WHEN 2 THEN x3 WHEN 3 THEN x4
    ELSE (family = {LEVELS}[feat - 3])::DOUBLE END"""


FEATURES = 4 + len(LEVELS)


def _draw(*parts: str) -> str:
    """A number from 0 to below 1 out of the digest of the parts, given as SQL."""
    return f"(('0x' || substr(md5(concat_ws('/', {', '.join(parts)})), 1, 8))::BIGINT / 4294967296.0)"


def _gain(criterion: str) -> str:
    if criterion == "poisson":
        return "CASE WHEN sl > 0 AND s - sl > 0 THEN sl * ln(sl / nl) + (s - sl) * ln((s - sl) / (n - nl)) - s * ln(s / n) END"
    return "sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n"


def _grow(
    rows: str, name: str, criterion: str = "squared_error", tried: int | None = None, seed: str = "42", random: bool = False,
    weight: str = "1", least_split: int = 2, least_decrease: float = 0.0,
) -> str:
    """CTEs ``<name>_best``: the best split of each (g, node) of ``rows``; g is the tree or the fold.

    ``tried`` features are taken in an order drawn per node, ``random`` draws one cut per feature.
    """
    drawn = _draw(f"'{seed}'", "g", "node", "feat", "'cut'")
    if random:
        cuts = f"""
            SELECT s.g, s.node, s.feat, cut, sum(n) FILTER (v <= cut) AS nl, sum(s) FILTER (v <= cut) AS sl, sum(n) AS n, sum(s) AS s, sum(q) AS q
            FROM {name}_sums s JOIN (SELECT g, node, feat, min(v) + {drawn} * (max(v) - min(v)) AS cut
                                     FROM {name}_sums GROUP BY g, node, feat HAVING min(v) < max(v)) c
              ON s.g = c.g AND s.node = c.node AND s.feat = c.feat GROUP BY ALL"""
    else:
        cuts = f"""
            SELECT g, node, feat, (v + lead(v) OVER by_value) / 2 AS cut, sum(n) OVER by_value AS nl, sum(s) OVER by_value AS sl,
                   sum(n) OVER whole AS n, sum(s) OVER whole AS s, sum(q) OVER whole AS q
            FROM {name}_sums
            WINDOW by_value AS (PARTITION BY g, node, feat ORDER BY v), whole AS (PARTITION BY g, node, feat)"""
    lots = f"""
        SELECT g, node, feat, row_number() OVER (PARTITION BY g, node ORDER BY {_draw(f"'{seed}'", "g", "node", "feat", "'feature'")}, feat) AS lot
        FROM (SELECT DISTINCT g, node, feat FROM {name}_cuts WHERE cut IS NOT NULL) d"""
    among = f"JOIN {name}_lots USING (g, node, feat)" if tried else ""
    few = f"AND lot <= {tried}" if tried else ""
    enough = f"AND n >= {least_split} AND gain >= {least_decrease} * (SELECT sum({weight}) FROM {rows} r0 WHERE r0.g = c.g)" if (
        least_split > 2 or least_decrease
    ) else ""
    return f"""
    {name}_sums AS MATERIALIZED (SELECT g, node, feat, {SPLIT_VALUE} AS v, sum({weight}) AS n, sum({weight} * y) AS s, sum({weight} * y * y) AS q
                    FROM {rows}, (SELECT unnest(range({FEATURES})) AS feat) f GROUP BY ALL),
    {name}_cuts AS MATERIALIZED ({cuts}),
    {f"{name}_lots AS MATERIALIZED ({lots})," if tried else ""}
    {name}_best AS MATERIALIZED (
        SELECT g, node, feat, cut FROM (
            SELECT *, round(gain / nullif(max(gain) OVER (PARTITION BY g, node), 0), 9) AS near
            FROM (SELECT *, {_gain(criterion)} AS gain FROM {name}_cuts) c {among}
            WHERE cut IS NOT NULL AND gain IS NOT NULL AND q - s * s / n > 1e-12 * q {few} {enough}) b
        QUALIFY row_number() OVER (PARTITION BY g, node ORDER BY near DESC, feat, cut) = 1)"""


def _grow_by_medians(rows: str, name: str) -> str:
    """The same for the summed distance to the median of either side."""
    return f"""
    {name}_values AS (SELECT DISTINCT g, node, feat, {SPLIT_VALUE} AS v FROM {rows}, (SELECT unnest(range({FEATURES})) AS feat) f),
    {name}_cand AS MATERIALIZED (SELECT g, node, feat, (v + lead(v) OVER (PARTITION BY g, node, feat ORDER BY v)) / 2 AS cut FROM {name}_values),
    {name}_sides AS (SELECT r.g, r.node, feat, cut, ({SPLIT_VALUE}) > cut AS side, y
                     FROM {rows} r JOIN {name}_cand c ON r.g = c.g AND r.node = c.node AND cut IS NOT NULL),
    {name}_medians AS (SELECT *, median(y) OVER (PARTITION BY g, node, feat, cut, side) AS m FROM {name}_sides),
    {name}_best AS MATERIALIZED (
        SELECT g, node, feat, cut FROM (
            SELECT *, round(distance / nullif(min(distance) OVER (PARTITION BY g, node), 0), 9) AS near
            FROM (SELECT g, node, feat, cut, sum(abs(y - m)) AS distance FROM {name}_medians GROUP BY ALL) d) b
        QUALIFY row_number() OVER (PARTITION BY g, node ORDER BY near, feat, cut) = 1)"""


def _descend(rows: str, name: str) -> str:
    """``rows`` with ``node`` moved to the child that the split in ``<name>_best`` sends them to."""
    return f"""SELECT r.* REPLACE (r.node * 2 + CASE WHEN {SPLIT_VALUE} > cut THEN 1 ELSE 0 END AS node)
               FROM {rows} r LEFT JOIN {name}_best b ON r.g = b.g AND r.node = b.node"""


def _tree(depth: int, train: str, score: str, value: str = "avg(y)", grow=_grow, **rules) -> str:
    """CTEs of a regression tree: ``tree<depth>`` are the ``score`` rows with prediction ``p``.

    ``train`` may have several trees g; each predicts the score rows of its g.
    """
    name = f"t{depth}"
    ctes = [
        f"{name}_fit0 AS MATERIALIZED (SELECT *, 1 AS node FROM ({train}) t)",
        f"{name}_score0 AS MATERIALIZED (SELECT *, 1 AS node FROM ({score}) t)",
    ]
    for level in range(depth):
        split = f"{name}_{level}"
        ctes.append(grow(f"{name}_fit{level}", split, **rules))
        ctes.append(f"{name}_fit{level + 1} AS MATERIALIZED ({_descend(f'{name}_fit{level}', split)})")
        ctes.append(f"{name}_score{level + 1} AS MATERIALIZED ({_descend(f'{name}_score{level}', split)})")
    ctes.append(
        f"""tree{depth} AS (SELECT s.*, p FROM {name}_score{depth} s JOIN
            (SELECT g, node, {value} AS p FROM {name}_fit{depth} GROUP BY g, node) l ON s.g = l.g AND s.node = l.node)"""
    )
    return ",\n".join(ctes)


def _predicted_tree(depth: int, **rules) -> str:
    return _q(f", {_tree(depth, YEAR_ROWS, TEST_ROWS, **rules)} SELECT id, round(p, 2) AS sales FROM tree{depth}")


def _scaled(x: str) -> str:
    return f"coalesce(({x} - min({x}) OVER ()) / nullif(max({x}) OVER () - min({x}) OVER (), 0), 0)"


def _digits(x: str) -> str:
    return f"round(({x}) * 1000000)::DECIMAL(38, 0)::VARCHAR"


def _drawn_rows(trees: int, seed: int = 42) -> str:
    """The year's rows once per tree g with ``w``, how often the tree draws them: Poisson(1) of a digest."""
    slots = ", ".join(_digits(f"(family = '{level}')::DOUBLE") for level in LEVELS)
    below, term, count = 0.0, math.exp(-1), "CASE"
    for number in range(16):
        below += term
        term /= number + 1
        count += f" WHEN u < {below!r} THEN {number}"
    content = f"md5(concat_ws('/', {', '.join(_digits(x) for x in ('z1', 'z2', 'z3', 'z4'))}, {slots}, {_digits('y')}, copy))"
    return f"""
    SELECT * FROM (SELECT *, {count} ELSE 16 END AS w FROM (SELECT r.* REPLACE (k.g AS g), {_draw(f"'{seed}'", "k.g", "content")} AS u FROM (
        SELECT *, {content} AS content FROM (
            SELECT *, row_number() OVER (PARTITION BY family, y, x1, x2, x3, x4) - 1 AS copy FROM (
                SELECT *, {_scaled('x1')} AS z1, {_scaled('x2')} AS z2, {_scaled('x3')} AS z3, {_scaled('x4')} AS z4 FROM ({YEAR_ROWS}) y0
            ) y1) y2) r, (SELECT unnest(range({trees})) AS g) k) y3) y4 WHERE w > 0"""


def _forest(trees: int, depth: int) -> str:
    """Predictions of a forest that tries a third of the features (the root of ten, rounded down) per split."""
    score = f"SELECT s.* REPLACE (k.g AS g) FROM ({TEST_ROWS}) s, (SELECT unnest(range({trees})) AS g) k"
    grown = _tree(depth, _drawn_rows(trees), score, value="sum(w * y) / sum(w)", weight="w", tried=3)
    # An id with several holidays is there once for each of them.
    numbered = f"(SELECT *, row_number() OVER (PARTITION BY g, id ORDER BY x4) AS nth FROM tree{depth}) t"
    return _q(f", {grown} SELECT id, round(avg(p), 2) AS sales FROM {numbered} GROUP BY id, nth")


def _boosted(stages: int, depth: int, loss: str = "squared_error", rate: float = 0.1, tried: int | None = None) -> str:
    """Predictions of boosting from the best constant, every tree shrunk."""
    best = {"squared_error": "avg({0})", "absolute_error": "median({0})", "huber": "median({0})", "quantile": "quantile_cont({0}, 0.9)"}[loss]
    gradient = {
        "squared_error": "y0 - f", "absolute_error": "CASE WHEN y0 < f THEN -1.0 ELSE 1.0 END",
        "quantile": "CASE WHEN y0 < f THEN -0.1 ELSE 0.9 END", "huber": "greatest(-clip, least(clip, y0 - f))",
    }[loss]
    ctes = [
        f"start AS MATERIALIZED (SELECT {best.format('y')} AS f FROM ({YEAR_ROWS}) t)",
        f"f0 AS MATERIALIZED (SELECT t.*, y AS y0, f FROM ({YEAR_ROWS}) t, start)",
        f"s0 AS MATERIALIZED (SELECT t.*, f FROM ({TEST_ROWS}) t, start)",
    ]
    for stage in range(stages):
        fit, score = f"b{stage}_fit", f"b{stage}_score"
        ctes += [
            f"c{stage} AS MATERIALIZED (SELECT quantile_cont(abs(y0 - f), 0.9) AS clip FROM f{stage})",
            f"{fit}0 AS MATERIALIZED (SELECT f{stage}.* REPLACE ({gradient} AS y), 1 AS node FROM f{stage}, c{stage})",
            f"{score}0 AS MATERIALIZED (SELECT *, 1 AS node FROM s{stage})",
        ]
        for level in range(depth):
            ctes += [
                _grow(f"{fit}{level}", f"b{stage}_{level}", tried=tried, seed=f"42/{stage}"),
                f"{fit}{level + 1} AS MATERIALIZED ({_descend(f'{fit}{level}', f'b{stage}_{level}')})",
                f"{score}{level + 1} AS MATERIALIZED ({_descend(f'{score}{level}', f'b{stage}_{level}')})",
            ]
        leaves = f"SELECT node, {best.format('y0 - f')} AS v FROM {fit}{depth} GROUP BY node"
        if loss == "huber":
            leaves = f"""SELECT r.node, any_value(v) + avg(sign(y0 - f - v) * least(abs(y0 - f - v), clip)) AS v
                         FROM {fit}{depth} r JOIN ({leaves}) m ON r.node = m.node, c{stage} GROUP BY r.node"""
        ctes += [
            f"l{stage} AS MATERIALIZED ({leaves})",
            f"f{stage + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node) REPLACE (f + {rate} * v AS f) FROM {fit}{depth} r JOIN l{stage} l ON r.node = l.node)",
            f"s{stage + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node) REPLACE (f + {rate} * v AS f) FROM {score}{depth} r JOIN l{stage} l ON r.node = l.node)",
        ]
    return _q(", " + ",\n".join(ctes) + f" SELECT id, round(f, 2) AS sales FROM s{stages}")


def _mean_r2(rows: str) -> str:
    return f"""SELECT round(avg(r2), 6) FROM (
        SELECT g, 1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)) AS r2 FROM {rows} GROUP BY g) f"""


def _tree_params(depth: int) -> str:
    return (
        f'{{"criterion": "friedman_mse", "max_depth": {depth}, "max_features": null, "min_impurity_decrease": 0.0, '
        '"min_samples_leaf": 1, "min_samples_split": 2, "min_weight_fraction_leaf": 0.0, "splitter": "best"}'
    )


def _linear_scores(projection: str) -> str:
    """Mean R2 of the linear model over the five folds, as ``score`` in ``projection``."""
    return f"""{WITH_INPUTS}, {_least_squares(OTHER_FOLDS, HELD_OUT_FOLD)},
    score(score) AS ({_mean_r2("fitted")})
    {projection}"""


def _constant_oil(rows: str) -> str:
    """Fold rows with missing prices as 0 instead of the mean."""
    return (
        rows.replace("coalesce(dcoilwtico, avg(dcoilwtico) OVER (PARTITION BY k.g))", "coalesce(dcoilwtico, 0)")
        .replace("coalesce(dcoilwtico, oil_mean)", "coalesce(dcoilwtico, 0)")
    )


def _row_counts(in_range: bool) -> str:
    extra = ", CAST(count(*) AS BIGINT) AS in_range" if in_range else ""
    return _q(f"""SELECT id, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS predicted{extra}
                  FROM enriched_test GROUP BY id""")


def _tree_grid_point(number: int, depth: int, features: str) -> str:
    params = _tree_params(depth).replace('"max_features": null', f'"max_features": {features}')
    return f"SELECT {number} AS grid_point, '{params}' AS params, CAST(1 AS BIGINT) AS best_points"


def _edge(axis: str, cells: int) -> str:
    """Lower edge of the part of an axis that a value is in, given the extremes over all rows."""
    low, high = f"min({axis}) OVER ()", f"max({axis}) OVER ()"
    part = f"least(floor(({axis} - {low}) * {cells} / nullif({high} - {low}, 0)), {cells - 1})"
    return f"{low} + coalesce({part}, 0) * (({high} - {low}) / {cells})"


def _grid(x: str, y: str, z: str, rows: str, cells: int, day: bool = False) -> str:
    """Counts per cell of the axes; x is a date (``day``) or a text."""
    first = f"DATE '1970-01-01' + CAST(floor({_edge('x', cells)}) AS INTEGER)" if day else "x"
    return _q(f"""SELECT x, round(y, 6) AS y, round(z, 6) AS z, count(*) AS count FROM (
        SELECT {first} AS x, {_edge('y', cells)} AS y, {_edge('z', cells)} AS z
        FROM (SELECT {x} AS x, ({y})::DOUBLE AS y, ({z})::DOUBLE AS z FROM {rows}) a) b GROUP BY x, y, z""")


GRID_SCORES_FULL_TREE = _q(
    f""", {_tree(1, OTHER_FOLDS, HELD_OUT_FOLD)}, {_tree(2, OTHER_FOLDS, HELD_OUT_FOLD)},
    scores AS (SELECT 0 AS grid_point, '{_tree_params(1)}' AS params, ({_mean_r2("tree1")}) AS mean_r2 UNION ALL
               SELECT 1 AS grid_point, '{_tree_params(2)}' AS params, ({_mean_r2("tree2")}) AS mean_r2)
    SELECT *, grid_point = (SELECT arg_max(grid_point, mean_r2) FROM scores) AS best FROM scores"""
)

ORACLE: dict[str, str] = {
    "predict_decision_rows": _row_counts(True),
    "predict_forest_rows": _row_counts(True),
    "predict_gbt_rows": _row_counts(False),
    "grid_points_tree": " UNION ALL ".join([
        _tree_grid_point(0, 2, '"sqrt"'), _tree_grid_point(1, 2, "null"),
        _tree_grid_point(2, 5, '"sqrt"'), _tree_grid_point(3, 5, "null"),
    ]),
    "grid_scores_linear_constant": f"""{WITH_INPUTS}, {_least_squares(_constant_oil(OTHER_FOLDS), _constant_oil(HELD_OUT_FOLD))},
        score(score) AS ({_mean_r2("fitted")})
        SELECT 0 AS grid_point, '{{"fit_intercept": true}}' AS params, score AS mean_r2 FROM score""",
    "csv_roundtrip_linear": _q(f", {_least_squares(YEAR_ROWS, TEST_ROWS)} SELECT id, round(p, 2) AS sales FROM fitted"),
    "read_train_csv": _q("SELECT id, date, CAST(store_nbr AS INTEGER) AS store_nbr, family, round(sales, 2) AS sales, onpromotion FROM train"),
    "read_test_csv": _q("SELECT id, date, CAST(store_nbr AS INTEGER) AS store_nbr, family, onpromotion FROM test"),
    "read_oil_csv": _q("SELECT date, dcoilwtico FROM oil"),
    "read_holidays_csv": _q("SELECT date, type FROM holidays"),
    "read_transactions_csv": _q("SELECT date, CAST(store_nbr AS INTEGER) AS store_nbr, transactions FROM transactions"),
    "hist_family_missing": _q(
        "SELECT nullif(family, 'PROMO') AS value, count(*) AS count FROM enriched GROUP BY nullif(family, 'PROMO')"
    ),
    "parse_dates": _q("SELECT CAST(date AS VARCHAR) AS date_text, date, store_nbr, transactions FROM transactions"),
    "filter_year_train": _q(
        "SELECT id, date, store_nbr, family, round(sales, 2) AS sales, onpromotion FROM year_train"
    ),
    "filter_year_transactions": _q("SELECT * FROM transactions WHERE year(date) = 1997"),
    "promo_flag": _q("SELECT id, CAST(onpromotion > 0 AS INTEGER) AS onpromotion FROM train"),
    "holiday_flag": _q(
        """SELECT id, type, CAST(type IS NOT NULL AS INTEGER) AS is_holiday
           FROM train t LEFT JOIN holidays h ON t.date = h.date"""
    ),
    "month_day": _q("SELECT id, date, strftime(date, '%m-%d') AS monthday FROM train"),
    "clip_sales": _q("SELECT id, round(CASE WHEN sales < 0 THEN 0 ELSE sales END, 2) AS sales FROM train"),
    "feature_frame": _q(
        "SELECT family, store_nbr, onpromotion, dcoilwtico, is_holiday FROM enriched"
    ),
    "join_oil": _q(
        """SELECT id, t.date, dcoilwtico FROM train t LEFT JOIN oil o ON t.date = o.date"""
    ),
    "join_holidays": _q("SELECT id, t.date, type FROM train t LEFT JOIN holidays h ON t.date = h.date"),
    "join_holidays_dedupe": _q(
        """SELECT id, t.date, type FROM train t
           LEFT JOIN (SELECT date, min(type) AS type FROM holidays GROUP BY date) h ON t.date = h.date"""
    ),
    "enrich_train": _q(
        """SELECT id, date, store_nbr, family, round(sales, 2) AS sales, onpromotion,
                  dcoilwtico, type, is_holiday FROM enriched"""
    ),
    "enrich_test": _q(
        """SELECT id, date, store_nbr, family, onpromotion, dcoilwtico, type, is_holiday
           FROM enriched_test"""
    ),
    "sorted_transactions": _q("SELECT * FROM transactions ORDER BY date, store_nbr"),
    "daily_transactions": _q(
        "SELECT date, CAST(sum(transactions) AS BIGINT) AS transactions FROM transactions GROUP BY date ORDER BY date"
    ),
    "daily_ma_year": _q(_moving("date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'")),
    "daily_ma_span": _q(_moving("date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'")),
    "daily_ma_new_span": _q(_moving("date BETWEEN DATE '1998-01-01' AND DATE '1999-12-31'")),
    "daily_ma_all": _q(_moving("date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'")),
    "impute_mean": _q(_filled("(SELECT avg(dcoilwtico) FROM enriched)")),
    "impute_mode": _q(
        _filled(
            """(SELECT dcoilwtico FROM enriched WHERE dcoilwtico IS NOT NULL
                GROUP BY dcoilwtico ORDER BY count(*) DESC, dcoilwtico LIMIT 1)"""
        )
    ),
    "impute_constant": _q(_filled("0")),
    "impute_family": _q(
        """SELECT id, type,
                  CASE WHEN family = 'PROMO' THEN
                      (SELECT family FROM enriched WHERE family <> 'PROMO'
                       GROUP BY family ORDER BY count(*) DESC, family LIMIT 1)
                  ELSE family END AS most_frequent_family,
                  CASE WHEN family = 'PROMO' THEN 'missing_value' ELSE family END AS constant_family
           FROM enriched"""
    ),
    "minmax_scale": _q(f"SELECT id, type, store_nbr, onpromotion, dcoilwtico, is_holiday FROM ({SCALED}) s"),
    "scale_label": _q(
        """SELECT id, round((greatest(sales, 0) - low) / (high - low), 6) AS scaled
           FROM train, (SELECT min(greatest(sales, 0)) AS low, max(greatest(sales, 0)) AS high FROM year_train) b
           WHERE year(date) = 1998"""
    ),
    "one_hot_family": _q(
        "SELECT id, type, "
        + ", ".join(f"CAST(family = '{level}' AS INTEGER) AS family_{level}" for level in LEVELS)
        + " FROM enriched"
    ),
    "features_vector": _q(
        "SELECT id, type, store_nbr, onpromotion, dcoilwtico, is_holiday, "
        + ", ".join(f"CAST(family = '{level}' AS DOUBLE) AS family_{level}" for level in LEVELS)
        + f" FROM ({SCALED}) s"
    ),
    "assign_folds": _q("SELECT id, type, fold FROM folded"),
    "r2_group_mean": _q(
        """SELECT round(1 - sum((y - p) * (y - p)) / (sum(y * y) - sum(y) * sum(y) / count(*)), 6) AS r2
           FROM (SELECT family, greatest(sales, 0) AS y FROM train WHERE year(date) = 1998) t
           JOIN (SELECT family, avg(greatest(sales, 0)) AS p FROM year_train GROUP BY family) m
             ON t.family = m.family"""
    ),
    "predict_linear": _q(f", {_least_squares(YEAR_ROWS, TEST_ROWS)} SELECT id, round(p, 2) AS sales FROM fitted"),
    "predict_tree": _predicted_tree(2),
    "predict_tree_levels": _predicted_tree(2),
    "predict_tree_sqrt": _predicted_tree(3, tried=3),
    "predict_tree_poisson": _predicted_tree(2, criterion="poisson"),
    "predict_tree_median": _predicted_tree(2, value="median(y)", grow=_grow_by_medians),
    "predict_tree_random": _predicted_tree(3, random=True),
    "predict_tree_stopped": _predicted_tree(4, least_split=400, least_decrease=500_000.0),
    "predict_forest_trees": _forest(3, 2),
    "predict_boosted_stumps": _boosted(2, 1),
    "predict_boosted_trees": _boosted(3, 2, tried=3),
    "predict_boosted_absolute": _boosted(2, 2, "absolute_error"),
    "predict_boosted_huber": _boosted(2, 2, "huber"),
    "predict_boosted_quantile": _boosted(2, 2, "quantile"),
    "grid_scores_full_tree": GRID_SCORES_FULL_TREE,
    "grid_scores_levels": GRID_SCORES_FULL_TREE,
    # Without an intercept the family slots span the same space, so both points score alike.
    "grid_scores_linear": _linear_scores(
        """SELECT 0 AS grid_point, '{"fit_intercept": true}' AS params, score AS mean_r2 FROM score UNION ALL
           SELECT 1 AS grid_point, '{"fit_intercept": false}' AS params, score AS mean_r2 FROM score"""
    ),
    "best_linear": _linear_scores("""SELECT '{"fit_intercept": true}' AS params, score AS mean_r2 FROM score"""),
    "csv_roundtrip": _q(
        """SELECT id, round(p, 6) AS sales FROM test t
           JOIN (SELECT family, avg(greatest(sales, 0)) AS p FROM year_train GROUP BY family) m
             ON t.family = m.family"""
    ),
    "scatter_transactions": _q("SELECT date AS x, store_nbr AS y, transactions AS z FROM transactions"),
    "scatter_daily": _q(
        f"""SELECT date AS x, transactions AS y, coalesce("60_day_MA", 0) AS z
            FROM ({_moving("date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'")}) m"""
    ),
    "scatter_features": _q(
        "SELECT family AS x, store_nbr AS y, coalesce(dcoilwtico, 0) AS z FROM enriched"
    ),
    "scatter_transactions_counts": _q(
        "SELECT store_nbr AS x, store_nbr AS y, transactions AS z, count(*) AS count FROM transactions GROUP BY ALL"
    ),
    "scatter_transactions_grid": _grid("(date - DATE '1970-01-01')::DOUBLE", "store_nbr", "transactions", "transactions", 20, day=True),
    "scatter_features_grid": _grid("family", "store_nbr", "coalesce(dcoilwtico, 0)", "enriched", 10),
    "line_store_oil_columns": _q(
        """, placed AS (SELECT row_number() OVER (ORDER BY date, store_nbr, family, type) - 1 AS place, count(*) OVER () AS rows,
                           store_nbr AS x, coalesce(dcoilwtico, 0) AS y FROM enriched),
           cut AS (SELECT *, CAST(floor(place * 100 / rows) AS INTEGER) AS col FROM placed),
           ranked AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY place) AS a,
                             row_number() OVER (PARTITION BY col ORDER BY place DESC) AS b,
                             row_number() OVER (PARTITION BY col ORDER BY y, place) AS c,
                             row_number() OVER (PARTITION BY col ORDER BY y DESC, place) AS d FROM cut)
           SELECT col AS "column", place, x, y FROM ranked WHERE least(a, b, c, d) = 1 ORDER BY place"""
    ),
    "bar_store_promo": _q(
        "SELECT store_nbr AS x, CAST(sum(onpromotion) AS BIGINT) AS y FROM enriched GROUP BY store_nbr"
    ),
    "line_store_promo": _q(
        "SELECT store_nbr AS x, onpromotion AS y FROM enriched ORDER BY date, store_nbr, family, type"
    ),
    "line_store_promo_summary": _q(
        """SELECT store_nbr AS x, min(onpromotion) AS y_min, round(avg(onpromotion), 6) AS y_mean,
                  max(onpromotion) AS y_max FROM enriched GROUP BY store_nbr"""
    ),
    "pie_family": _q(
        """SELECT family AS category, count(*) AS count FROM enriched GROUP BY family
           ORDER BY count(*) DESC, family"""
    ),
    "hist_store": _q(
        """, span AS (SELECT min(store_nbr)::DOUBLE AS lo, max(store_nbr)::DOUBLE AS hi FROM enriched),
           counted AS (SELECT CAST(least(floor((store_nbr - lo) * 10 / (hi - lo)) + 1, 10) AS INTEGER) AS bin,
                              count(*) AS n FROM enriched, span GROUP BY 1)
           SELECT CAST(b AS INTEGER) AS bin, round(lo + (b - 1) * (hi - lo) / 10, 6) AS low,
                  round(lo + b * (hi - lo) / 10, 6) AS high, coalesce(n, 0) AS count
           FROM (SELECT unnest(range(1, 11)) AS b) bins LEFT JOIN counted ON bin = b, span"""
    ),
    "hist_family": _q("SELECT family AS value, count(*) AS count FROM enriched GROUP BY family"),
    "box_store": _q(_box("store_nbr")),
    "box_oil": _q(_box("dcoilwtico")),
}

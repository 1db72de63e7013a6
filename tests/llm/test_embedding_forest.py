"""Near duplicates among embeddings against all pairs."""

import numpy as np
import pytest
from pyspark.sql import types as T

from shelfcast.llm import catalogue, components, embedding_forest
from shelfcast.llm.embedding_forest import Settings

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
])


def brute(rows, similarity=0.93):
    """Links and component of each row, by all pairs."""
    sound = [
        vec_id is not None and label is not None and bool(vector) and all(x is not None and np.isfinite(x) for x in vector) and any(vector)
        for vec_id, vector, label in rows
    ]
    links, reached = [0] * len(rows), list(range(len(rows)))
    units = [np.array(row[1], np.float32).astype(float) if ok else None for row, ok in zip(rows, sound)]
    units = [x / np.linalg.norm(x) if x is not None else None for x in units]
    find = lambda i: i if reached[i] == i else find(reached[i])
    for i in range(len(rows)):
        for j in range(i):
            if sound[i] and sound[j] and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= similarity:
                links[i] += 1
                links[j] += 1
                reached[find(i)] = find(j)
    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(find(i), []).append(row[0])
    found = []
    for i, row in enumerate(rows):
        component = None if row[0] is None else min(groups[find(i)])
        found.append((str(row[0]), links[i], str(component), row[0] is not None and component == row[0]))
    return sorted(found)


def as_tuples(df):
    return sorted((str(row["vec_id"]), row["n_links"], str(row["component_id"]), row["kept"]) for row in df.collect())


def clouds(seed, groups, loose, size=24):
    """Vectors in groups (members, noise) and loose ones, in three labels."""
    draw = np.random.default_rng(seed)
    vectors = []
    for label, (members, noise) in enumerate(groups):
        heart = draw.normal(size=size)
        vectors += [(heart + draw.normal(size=size) * noise, label % 3) for _ in range(members)]
    vectors += [(draw.normal(size=size), number % 3) for number in range(loose)]
    order = draw.permutation(len(vectors))
    return [(int(place) * 3, vectors[number][0].astype(np.float32).tolist(), vectors[number][1]) for place, number in enumerate(order)]


ODD = [
    (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, float("nan")], 1), (6, [1.0, float("inf")], 1),
    (7, [1.0, 0.0], None), (None, [1.0, 0.0], 1), (8, [1.0, 0.0], 1), (8, [1.0, 0.0], 1), (9, [2.0, 0.0], 1), (10, [1.0, 0.0], 2),
    (11, [1.0, 0.0, 0.0], 1), (12, [0.93, float(np.sqrt(1 - 0.9301**2))], 1), (13, [-1.0, 0.0], 1), (14, [3e38, 1e-38], 1), (10, [1.0, 0.0], 2),
]


def test_odd_vectors(spark):
    rows = spark.createDataFrame(ODD, SCHEMA).selectExpr("*", "1 AS node", "'x' AS cell", "2 AS copies").repartition(3)
    assert as_tuples(embedding_forest.near_duplicates(rows)) == brute(ODD)
    kept = [row["vec_id"] for row in embedding_forest.keep_one_each(rows).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [1, 2, 3, 4, 5, 6, 7, None, 8, 8, 10, 10, 11, 13]))


@pytest.mark.parametrize("settings", [
    Settings(), Settings(leaf=30), Settings(leaf=30, chunk=7), Settings(leaf=200, sample_floats=2000, chunk=16), Settings(chunk=20, trees=1),
])
def test_links_and_components_are_those_of_all_pairs(spark, settings):
    rows = clouds(1, [(150, 0.1), (60, 0.22), (40, 0.3), (2, 0.05), (2, 0.05), (3, 0.2)], 250) + [(10_000 + n, [1.0] * 24, 0) for n in range(40)]
    got = as_tuples(embedding_forest.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), settings))
    expected = brute(rows)
    assert sum(row[1] > 0 for row in expected) > 250
    assert got == expected


def test_recall_of_pairs_at_the_limit(spark):
    draw, rows = np.random.default_rng(5), []
    for number in range(600):
        one = draw.normal(size=64)
        one /= np.linalg.norm(one)
        away = draw.normal(size=64)
        away -= (away @ one) * one
        away /= np.linalg.norm(away)
        two = 0.935 * one + np.sqrt(1 - 0.935**2) * away
        rows += [(2 * number, one.tolist(), 1), (2 * number + 1, two.tolist(), 1)]
    # leaves of some 20 vectors, so that the trees are deep
    got = embedding_forest.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(4), Settings(leaf=20)).collect()
    assert sum(row["n_links"] for row in got) >= 0.98 * len(rows)


def test_trees_cut_leaves_down_and_leave_dense_groups_whole():
    draw = np.random.default_rng(3)
    apart = embedding_forest.unit(draw.normal(size=(4000, 64)))
    dense = embedding_forest.unit(draw.normal(size=64) + 0.05 * draw.normal(size=(4000, 64)))
    margin = embedding_forest._margin(64, 0.93, 0.5)
    towards = embedding_forest.directions(64, 1)[0]
    for vectors, most in ((apart, 600), (dense, 4000)):
        tree = embedding_forest.grow(vectors, towards, 1.0, margin, 512, 1000, np.random.default_rng(0))
        found = list(embedding_forest.leaves(tree, vectors @ towards[:len(tree.splits)].T, margin))
        sizes = np.concatenate([np.unique(paths, return_counts=True)[1] for _, paths, _ in found])
        assert sizes.max() <= most and {*np.concatenate([rows for *_, rows in found]).tolist()} == set(range(4000))
        assert bool(tree.chunks) == (vectors is dense)


def test_components_of_chains(spark):
    from shelfcast.llm.tables import scratch

    links = [(n, n + 1) for n in range(40)] + [(100, 103), (102, 103)]
    with scratch(spark) as put:
        found = components.components(spark.createDataFrame(links, "a long, b long"), put)
        assert {row["node"]: row["label"] for row in found.collect()} == {**{n: 0 for n in range(41)}, 100: 100, 102: 100, 103: 100}


def test_an_empty_table(spark):
    assert embedding_forest.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_equals_brute_force(spark):
    rows = [tuple(row) for row in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert as_tuples(catalogue.QUERIES["op13_embedding_forest"](spark, "/root/testdata/sf0.01")) == brute(rows)

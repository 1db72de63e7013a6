"""Near duplicates among embeddings of one label, by a forest of random-projection trees with overlap.

1. Rows of equal label and vector are one node with a count of copies.
2. Every tree splits the vectors of a label again and again along random directions, near the median of
   a bounded sample (``SAMPLE_FLOATS`` numbers for all labels). Vectors near a split go to both sides:
   the overlap is ``SPILL`` times the spread that a pair at the similarity limit shows along a random
   direction. A split that would send half of the vectors to both sides is not made. Trees only say
   where vectors meet: all vectors go down all trees.
3. Vectors of a leaf are compared by their cosine in double precision. A leaf with more vectors than
   ``CHUNK`` is dealt to chunks, and every two chunks meet in a task of their own, so nothing is dropped
   and no task grows. A task puts out as many links as join what it found, not all pairs.
4. These links are united to components, and the members of each component are compared once more, in
   chunks likewise, to count the links of every vector; no pair is put out.

A pair is missed if it is apart in every tree and no chain of found links joins it either. Each split
separates a pair at the limit with a chance of some 2.5 %, a closer one with less, so with six trees
fewer than 1 in 1,000 of the pairs at the limit are apart after ten splits.

Defined results: vectors that are null, empty or zero, or hold null or non-finite components, and those
without a label link with nothing; vectors of different lengths are never compared; rows that repeat a
``vec_id`` are vectors of their own and both are kept; rows with a null ``vec_id`` link with nothing,
are in no component (null) and are not kept; an empty table gives an empty result; only ``vec_id,
embedding`` and ``label`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.columns import ship
from shelfcast.llm.components import components, merge
from shelfcast.llm.tables import Put, scratch, stored

SIMILARITY = 0.93
TREES = 6
LEAF = 512  # vectors of a leaf, about
SPILL = 0.5
SAMPLE_FLOATS = 8_000_000
LEAST_SAMPLE = 16  # sampled vectors that a node needs to be split
DEEPEST = 20
CHUNK = 8192  # vectors of a task on either side, about
BLOCK = 1024  # vectors compared at once
SEED = 20240613


def directions(size: int, trees: int) -> np.ndarray:
    """Unit directions of every tree and level for vectors of ``size`` numbers."""
    drawn = np.random.default_rng((SEED, size)).normal(size=(trees, DEEPEST, size))
    return drawn / np.linalg.norm(drawn, axis=2, keepdims=True)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; scaled first, so that no square overflows."""
    rows = rows.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


@dataclass
class Tree:
    """Splits by level and path: a path's children are twice it and the next one. NaN is a leaf."""

    splits: list[np.ndarray] = field(default_factory=list)
    chunks: dict[tuple[int, int], int] = field(default_factory=dict)  # of leaves with several

    def split_at(self, level: int, paths: np.ndarray) -> np.ndarray:
        return self.splits[level][paths] if level < len(self.splits) else np.full(len(paths), np.nan)


def grow(sample: np.ndarray, towards: np.ndarray, share: float, margin: float, leaf: int, chunk: int, rng) -> Tree:
    """A tree over unit vectors of which ``sample`` is a ``share``."""
    tree, level = Tree(), {0: np.arange(len(sample))}
    for depth in range(DEEPEST + 1):
        following, splits = {}, np.full(1 << depth, np.nan)
        for path, members in level.items():
            most = depth == DEEPEST or len(members) < LEAST_SAMPLE or len(members) / share <= leaf
            if not most:
                along = sample[members] @ towards[depth]
                split = np.quantile(along, rng.uniform(0.4, 0.6))
                left, right = along <= split + margin, along >= split - margin
                most = (left & right).sum() * 2 > len(members) or left.all() or right.all()
            if most:
                if (count := int(np.ceil(len(members) / share / chunk))) > 1:
                    tree.chunks[depth, path] = count
                continue
            splits[path] = split
            following[2 * path], following[2 * path + 1] = members[left], members[right]
        if not following:
            return tree
        tree.splits.append(splits)
        level = following
    return tree


def leaves(tree: Tree, along: np.ndarray, margin: float):
    """Level, paths and rows of the leaves that rows with projections ``along`` levels fall into."""
    rows, paths = np.arange(len(along)), np.zeros(len(along), np.int64)
    for level in range(len(tree.splits) + 1):
        split = tree.split_at(level, paths)
        ends = np.isnan(split)
        if ends.any():
            yield level, paths[ends], rows[ends]
        rows, paths, split = rows[~ends], paths[~ends], split[~ends]
        if not len(rows):
            return
        value = along[rows, level]
        left, right = value <= split + margin, value >= split - margin
        rows, paths = np.r_[rows[left], rows[right]], np.r_[2 * paths[left], 2 * paths[right] + 1]


Forest = dict[tuple[str, int], list[Tree]]


def _by_kind(labels: list[str], sizes: np.ndarray) -> dict[tuple[str, int], np.ndarray]:
    """Row numbers of each label and vector length."""
    kinds: dict[tuple[str, int], list[int]] = {}
    for row, kind in enumerate(zip(labels, sizes.tolist())):
        kinds.setdefault(kind, []).append(row)
    return {kind: np.array(rows) for kind, rows in kinds.items()}


def _matrix(lists: pa.ListArray, rows: np.ndarray, size: int) -> np.ndarray:
    starts = lists.offsets.to_numpy()[rows] - lists.offsets[0].as_py()
    return lists.flatten().to_numpy()[starts[:, None] + np.arange(size)]


def _margin(size: int, similarity: float, spill: float) -> float:
    return spill * np.sqrt((2 - 2 * similarity) / size)


@dataclass(frozen=True)
class Settings:
    similarity: float = SIMILARITY
    trees: int = TREES
    leaf: int = LEAF
    spill: float = SPILL
    sample_floats: int = SAMPLE_FLOATS
    chunk: int = CHUNK


def _finite(vector: str) -> Column:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def _nodes(vectors: DataFrame, put: Put) -> DataFrame:
    """``node, label, vector, one, two, copies, least_id`` of the distinct vectors of each label."""
    kinds = vectors.filter("sound").groupBy("label", "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id"))
    return put(kinds.select(F.monotonically_increasing_id().alias("node"), "*", *_hashes("vector")), "distinct-vectors")


def _hashes(vector: str) -> list[Column]:
    return [F.xxhash64(vector).alias("one"), F.xxhash64(F.lit(SEED), vector).alias("two")]


def fit_forest(nodes: DataFrame, settings: Settings) -> Forest:
    """Trees of every label and vector length that fills more than a leaf, from a bounded sample."""
    most = nodes.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("vector")).alias("size")).first()
    if not most["rows"]:
        return {}
    share = min(1.0, settings.sample_floats / (most["rows"] * most["size"]))
    sample = nodes.filter(F.pmod("one", F.lit(1 << 40)) < int(share * (1 << 40))).select("label", "vector").toArrow().combine_chunks()
    lists, forest = sample.column("vector"), {}
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) and lists.num_chunks else lists
    if not len(sample):
        return {}
    for (label, size), rows in sorted(_by_kind(sample.column("label").to_pylist(), np.diff(lists.offsets.to_numpy())).items()):
        if len(rows) / share <= settings.leaf:
            continue
        own, margin = unit(_matrix(lists, rows, size)), _margin(size, settings.similarity, settings.spill)
        towards = directions(size, settings.trees)
        forest[label, size] = [
            grow(own, towards[number], share, margin, settings.leaf, settings.chunk, np.random.default_rng((SEED, number)))
            for number in range(settings.trees)
        ]
    return forest


def _routed(nodes: DataFrame, forest: Forest, settings: Settings) -> DataFrame:
    """``name, chunks, node, copies, vector`` for every leaf that a vector falls into."""
    known = nodes.sparkSession.sparkContext.broadcast(forest)
    kind = nodes.schema["vector"].dataType.simpleString()

    def route(batches):
        for batch in batches:
            lists, labels = batch.column("vector"), batch.column("label").to_pylist()
            names, chunks, rows = [], [], []
            for (label, size), own in _by_kind(labels, np.diff(lists.offsets.to_numpy())).items():
                trees = known.value.get((label, size))
                if trees is None:
                    names += [f"{size}/{label}"] * len(own)
                    chunks += [1] * len(own)
                    rows.append(own)
                    continue
                units, towards = unit(_matrix(lists, own, size)), directions(size, len(trees))
                margin = _margin(size, settings.similarity, settings.spill)
                for number, tree in enumerate(trees):
                    for level, paths, found in leaves(tree, units @ towards[number, :len(tree.splits)].T, margin):
                        names += [f"{size}/{label}/{number}.{level}.{path}" for path in paths.tolist()]
                        chunks += [tree.chunks.get((level, path), 1) for path in paths.tolist()]
                        rows.append(own[found])
            taken = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(chunks, pa.int32()), *[batch.column(name).take(taken) for name in ("node", "copies", "vector")]],
                ["name", "chunks", "node", "copies", "vector"],
            )

    return nodes.select("node", "label", "copies", "vector").mapInArrow(
        route, f"name string, chunks int, node bigint, copies bigint, vector {kind}"
    )


def _dealt(groups: DataFrame) -> DataFrame:
    """``cell, side, node, copies, vector`` for every task of rows with ``name, chunks``.

    A row belongs to one chunk of its group. Each chunk meets itself in one cell, where all rows have
    side 0, and each other chunk in another, where the later of the two has side 1.
    """
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    each = groups.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    pair = F.concat_ws(".", F.least("own", "other"), F.greatest("own", "other"))
    return each.select(
        F.concat_ws("/", "name", pair).alias("cell"), (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "copies", "vector"
    ).repartition("cell").sortWithinPartitions("cell", "node")


def _cells(batches):
    """Whole cells of sorted batches, as tables."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.column(0)
        run = names.dictionary_encode().indices.to_numpy()  # sorted, so each name is one stretch
        cuts = np.r_[0, np.flatnonzero(np.diff(run)) + 1, batch.num_rows].tolist()
        for begin, end in zip(cuts, cuts[1:]):
            if held and held[-1].column(0)[0].as_py() != names[begin].as_py():
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(begin, end - begin))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(table: pa.Table, name: str):
    column = table.column(name)
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors of a cell's rows, and the rows that meet: those of both sides, or all with all."""
    lists = _column(table, "vector")
    units = unit(_matrix(lists, np.arange(len(lists)), int(np.diff(lists.offsets.to_numpy()[:2])[0])))
    side = _column(table, "side").to_numpy()
    one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    own = table.column("cell")[0].as_py().rsplit("/", 1)[-1].split(".")
    return units, one, one if own[0] == own[-1] else two


def _blocks(units: np.ndarray, one: np.ndarray, two: np.ndarray, similarity: float):
    """Which rows link, a block of both sides at a time; with itself only above the diagonal."""
    same = one is two
    for begin in range(0, len(one), BLOCK):
        rows = one[begin:begin + BLOCK]
        for other in range(begin if same else 0, len(two), BLOCK):
            columns = two[other:other + BLOCK]
            linked = units[rows] @ units[columns].T >= similarity
            if same and begin == other:
                linked = np.triu(linked, 1)
            yield rows, columns, linked


def _links(routed: DataFrame, settings: Settings) -> DataFrame:
    """Links ``a, b`` that join what is linked in each cell."""

    def compare(batches):
        for table in _cells(batches):
            if table.num_rows < 2:
                continue
            units, one, two = _sides(table)
            labels = np.arange(table.num_rows)
            for rows, columns, linked in _blocks(units, one, two, settings.similarity):
                i, j = np.nonzero(linked & (labels[rows][:, None] != labels[columns]))
                if len(i):
                    labels = merge(labels, rows[i], columns[j])
            joined, nodes = np.flatnonzero(labels != np.arange(len(labels))), _column(table, "node").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(nodes[labels[joined]]), pa.array(nodes[joined])], ["a", "b"])

    return _dealt(routed).mapInArrow(compare, "a bigint, b bigint")


def _link_counts(members: DataFrame, settings: Settings) -> DataFrame:
    """``node, links``: linked rows of other nodes of the component; ``members`` have ``label, members``."""

    chunks = F.ceil(F.col("members") / settings.chunk).cast("int").alias("chunks")

    def count(batches):
        for table in _cells(batches):
            units, one, two = _sides(table)
            weights, found = _column(table, "copies").to_numpy(), np.zeros(table.num_rows, np.int64)
            for rows, columns, linked in _blocks(units, one, two, settings.similarity):
                found[rows] += linked @ weights[columns]
                found[columns] += weights[rows] @ linked
            yield pa.RecordBatch.from_arrays([_column(table, "node"), pa.array(found)], ["node", "links"])

    dealt = _dealt(members.select(F.col("label").cast("string").alias("name"), chunks, "node", "copies", "vector"))
    return dealt.mapInArrow(count, "node bigint, links bigint").groupBy("node").agg(F.sum("links").alias("links"))


def _grouped(vectors: DataFrame, settings: Settings, put: Put) -> DataFrame:
    nodes = _nodes(vectors, put)
    forest = fit_forest(nodes, settings)
    links = put(_links(_routed(nodes, forest, settings), settings).distinct(), "forest-links")
    labels = components(links, put)
    sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("members"))
    members = labels.join(sizes, "label").join(nodes.select("node", "copies", "least_id", "vector"), "node")
    members = put(members, "component-members")
    least = members.groupBy("label").agg(F.min("least_id").alias("component_id"))
    counts = _link_counts(members.select("node", "label", "members", "copies", "vector"), settings)
    placed = members.select("node", "label").join(least, "label").join(counts, "node").select("node", "component_id", "links")
    return put(
        nodes.join(placed, "node", "left").select(
            F.col("label").alias("own_label"), "one", "two", F.coalesce("component_id", "least_id").alias("component_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "placed-vectors",
    )


def near_duplicates(table: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``table`` (``vec_id, embedding, label``).

    ``n_links`` are the other rows that a row links with, ``component_id`` is the smallest ``vec_id``
    reachable by links, and the row that has it is ``kept``.
    """
    ship(table.sparkSession)
    kind = table.schema["embedding"].dataType.simpleString()
    vector = F.col("embedding") if kind in ("array<float>", "array<double>") else F.col("embedding").cast("array<double>")
    vectors = table.select("vec_id", F.col("label").cast("string").alias("label"), vector.alias("vector"))
    sound = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & _finite("vector")
    vectors = vectors.withColumn("sound", sound)
    with scratch(table.sparkSession) as put:
        placed = _grouped(vectors, settings, put)
        rows = vectors.select("vec_id", F.when(F.col("sound"), F.col("label")).alias("label"), *_hashes("vector"))
        same = (F.col("label") == F.col("own_label")) & (rows["one"] == placed["one"]) & (rows["two"] == placed["two"])
        component = F.coalesce("component_id", "vec_id")
        return stored(
            rows.join(placed, same, "left").select(
                "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
            ),
            "near-duplicates",
        )


def keep_one_each(table: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``table`` without the vectors that are not kept; rows with a null ``vec_id`` stay."""
    gone = near_duplicates(table, settings).filter("NOT kept AND vec_id IS NOT NULL").select(F.col("vec_id").alias("__gone"))
    return table.join(gone, table["vec_id"] == gone["__gone"], "left_anti").select(*table.columns)

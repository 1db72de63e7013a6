"""Exact Jaccard join of word shingle sets, and the components of its links.

Texts with equal sets are one node. Two nodes can only link if they share a shingle in their
prefixes: the first ``n - ceil(n * 3 / 4) + 1`` shingles in one global order, hashes first to last
with very common ones at the end. A tile holds the nodes with one prefix shingle, sorted by size and
cut into size bands, so only sizes within a ratio of 3 to 4 meet.

1. In each band every node has the band's first one as leader. Each node is verified against one of
   its leaders, and in further turns, while most of these pairs link, against others that it is still apart
   from: at most as many pairs a turn as nodes, which settle large groups of near copies. The links give
   first components.
2. In tiles that still hold several components, nodes of different ones are compared by bitmap
   signatures, as wide as their sets are large: a set flips the bit of each element, so differing bits of two signatures bound the
   difference of the sets from below and their overlap from above. Only pairs that pass are emitted. Of each
   node's tiles the ``FIRST`` ones whose shingles have the smallest hashes are known, wherever they stand in the
   order, so near copies share some; a pair is emitted only in the tile of the smallest one shared. A row of a
   large tile passes its closest partners first; while some had more, this is repeated for them, with the
   components that these links give and many times as many partners, until every pair has passed or lies in
   one component.
3. Passing pairs are verified by intersecting sorted arrays of the whole sets.

No pair of linked nodes is missed: it shares a tile, and there it is in one component already or
compared. Common shingles only change the order, never what is found; their list is broadcast and
bounded by ``MOST_COMMON``.

Defined results: null, empty and wordless texts have no shingle and link with nothing; texts of fewer
than five words have one shingle, the whole sequence; rows repeat as given and equal texts share a
component; rows with a null ``doc_id`` are in no component (null); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from shelfcast.llm.columns import fresh, ship
from shelfcast.llm.components import components
from shelfcast.llm.encoding import slices
from shelfcast.llm.tables import Put, scratch, stored
from shelfcast.llm.word_hashes import mixed, runs, words_of

SHINGLE = 5
LEAST_BITS = 128
COMMON_TILE = 500  # rows from which a tile's shingle is moved to the end of the order
MOST_COMMON = 4_000_000
LEADERS = 6  # turns in which nodes are verified against a leader
MEMBERS = 200  # verified against one copy of a text
BLOCK = 4096  # nodes of a tile compared with at once
FEW = 64  # rows up to which tiles are compared together with others
PAIRS = 100_000  # of such tiles, about, at a time
FIRST = 16  # tiles of a node that tell in which one it meets others first
CLOSEST = 16  # partners of a row of a large tile that are passed on in the first turn
MORE = 64  # times as many in each further turn


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, ASCII letters lower-cased."""
    words = words_of([text.lower() for text in texts])
    whole = runs(words.hashes, SHINGLE)
    found = []
    for first, count in zip(words.firsts.tolist(), words.counts.tolist()):
        if count >= SHINGLE:
            found.append(np.unique(whole[first:first + count - SHINGLE + 1]))
        else:
            found.append(runs(words.hashes[first:first + count], count) if count else np.zeros(0, np.uint64))
    return found


def width_of(size: int) -> int:
    """Bits of a signature: a power of two, at least as many as elements, so that it prunes at any size."""
    return max(LEAST_BITS, 1 << max(size - 1, 0).bit_length())


def signature(shingles: np.ndarray) -> bytes:
    """Parity of the number of shingles that fall on each bit.

    Folding its halves onto each other gives the signature of half the width.
    """
    width = width_of(len(shingles))
    counts = np.bincount((mixed(shingles) & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(bits: np.ndarray) -> np.ndarray:
    """Rows of 64-bit words at half their width."""
    half = bits.shape[-1] // 2
    return bits[..., :half] ^ bits[..., half:]


def least_overlap(sizes: np.ndarray | int) -> np.ndarray | int:
    """Smallest overlap with which sets of this total size link: 100 * overlap >= 75 * union."""
    return -(-3 * sizes // 7)


def prefix(shingles: np.ndarray, common: np.ndarray) -> np.ndarray:
    count = len(shingles) - -(-3 * len(shingles) // 4) + 1 if len(shingles) else 0
    if len(common) and count:
        place = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        late = common[place] == shingles
        shingles = np.r_[shingles[~late], shingles[late]]
    return shingles[:count]


def _text_batches(batches, place: int):
    for batch in batches:
        for begin, end in slices(batch.column(place), 1 << 18):
            part = batch.slice(begin, end - begin)
            yield part, [text or b"" for text in part.column(place).cast(pa.binary()).to_pylist()]


def _described(docs: DataFrame, put: Put) -> DataFrame:
    """``doc_id, text_hash``, identity, size and signature of each row's set."""

    def describe(batches):
        for part, texts in _text_batches(batches, 1):
            sets = shingle_sets(texts)
            ones = [int(mixed(own).sum()) if len(own) else 0 for own in sets]
            twos = [int(mixed(own ^ np.uint64(0x5555)).sum()) if len(own) else 0 for own in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(2),
                    pa.array(np.array(ones, np.uint64).view(np.int64)), pa.array(np.array(twos, np.uint64).view(np.int64)),
                    pa.array([len(own) for own in sets], pa.int32()), pa.array([signature(own) for own in sets], pa.binary()),
                ],
                ["doc_id", "text_hash", "one", "two", "size", "bits"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash bigint, one bigint, two bigint, size int, bits binary"
    return put(docs.select("doc_id", "text", "text_hash").mapInArrow(describe, schema), "shingle-sets")


def _nodes(described: DataFrame, put: Put) -> DataFrame:
    """``node``, its set's identity, size and signature, and one row that has the text."""
    groups = described.filter("size > 0 AND doc_id IS NOT NULL").groupBy("one", "two")
    picked = groups.agg(F.min(F.struct("doc_id", "text_hash", "size", "bits")).alias("pick"))
    return put(picked.select(F.monotonically_increasing_id().alias("node"), "one", "two", "pick.*"), "shingle-nodes")


def _texts_of(docs: DataFrame, nodes: DataFrame, repeated: bool) -> DataFrame:
    """``node, text`` of nodes; with few of them ``docs`` need not be shuffled."""
    texts = nodes.select("node", "doc_id", "text_hash").join(docs, ["doc_id", "text_hash"]).select("node", "text")
    return texts.dropDuplicates(["node"]) if repeated else texts


def _prefixes(texts: DataFrame, common: np.ndarray) -> DataFrame:
    """``shingle, size, node`` of each node's prefix."""

    def find(batches):
        for part, raw in _text_batches(batches, 1):
            sets = shingle_sets(raw)
            parts = [prefix(own, common) for own in sets]
            counts = np.array([len(own) for own in parts], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((np.concatenate(parts) if parts else np.zeros(0, np.uint64)).view(np.int64)),
                    pa.array(np.repeat(np.array([len(own) for own in sets], np.int32), counts)),
                    part.column(0).take(pa.array(np.repeat(np.arange(len(sets)), counts))),
                ],
                ["shingle", "size", "node"],
            )

    return texts.select("node", "text").mapInArrow(find, "shingle bigint, size int, node bigint")


def _common(prefixes: DataFrame, put: Put) -> np.ndarray:
    """Sorted shingles of tiles with many rows: at most ``MOST_COMMON`` of them, whatever the input."""
    counts = put(prefixes.groupBy("shingle").count().filter(F.col("count") > COMMON_TILE), "common-shingles")
    rows = counts.agg(F.sum("count")).first()[0] or 0
    least = max(COMMON_TILE, rows // MOST_COMMON)
    found = counts.filter(F.col("count") > least).select("shingle").toArrow().column(0).to_numpy()
    return np.sort(found.view(np.uint64))


def _band_leaders(size: np.ndarray, node: np.ndarray, leader: tuple[int, int] | None) -> tuple[np.ndarray, tuple[int, int]]:
    """First node of each row's size band, and size and node of the last one; ``size`` is sorted."""
    found, at = np.empty(len(node), np.int64), 0
    leader = leader or (int(size[0]), int(node[0]))
    while True:
        following = int(np.searchsorted(size, 4 * leader[0] // 3, side="right"))
        found[at:following] = leader[1]
        at = max(at, following)
        if at >= len(node):
            return found, leader
        leader = int(size[at]), int(node[at])


def _tiles(prefixes: DataFrame, put: Put) -> DataFrame:
    """Rows of tiles with several nodes: ``shingle, size, node, leader``, the leader of the size band."""

    def lead(batches):
        # What is open when a batch ends: the last row's tile, its band's first row, and the row
        # itself if it is the tile's only one so far.
        open_tile = leader = single = None
        for batch in batches:
            shingle, size, node = (column.to_numpy() for column in batch.columns)
            if not len(shingle):
                continue
            goes_on = int(np.searchsorted(shingle != open_tile, True)) if shingle[0] == open_tile else 0
            begins = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
            ends = np.r_[begins[1:], len(shingle)]
            first = np.repeat(begins, ends - begins)
            leaders, kept = node[first].copy(), np.repeat(ends - begins, ends - begins) > 1
            banded = 3 * size[ends - 1].astype(np.int64) > 4 * size[begins].astype(np.int64)
            if goes_on:
                leaders[:goes_on], kept[:goes_on] = _band_leaders(size[:goes_on], node[:goes_on], leader)[0], True
                banded[0] = False
            for tile in np.flatnonzero(banded & (ends - begins > 1)).tolist():
                own = slice(begins[tile], ends[tile])
                leaders[own] = _band_leaders(size[own], node[own], None)[0]
            extra = [single] if goes_on and single else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[np.array([row[0] for row in extra], np.int64), shingle[kept]]),
                    pa.array(np.r_[np.array([row[1] for row in extra], np.int32), size[kept]]),
                    pa.array(np.r_[np.array([row[2] for row in extra], np.int64), node[kept]]),
                    pa.array(np.r_[np.array([row[2] for row in extra], np.int64), leaders[kept]]),
                ],
                ["shingle", "size", "node", "leader"],
            )
            last = slice(begins[-1], len(shingle))
            same = goes_on and len(begins) == 1
            leader = _band_leaders(size[last], node[last], leader if same else None)[1]
            alone = not same and last.stop - last.start == 1
            single = (int(shingle[-1]), int(size[-1]), int(node[-1])) if alone else None
            open_tile = shingle[-1]

    ordered = prefixes.repartition("shingle").sortWithinPartitions("shingle", "size", "node")
    return put(ordered.mapInArrow(lead, "shingle bigint, size int, node bigint, leader bigint"), "shingle-tiles")


def _may_link(total: np.ndarray, differing: np.ndarray) -> np.ndarray:
    """Whether sets of this total size with at least so many differing elements can link."""
    return (total - differing) // 2 >= least_overlap(total)


def _differing(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Differing bits of signatures, rows of 64-bit words, the wider ones folded to the narrower width."""
    while one.shape[-1] > two.shape[-1]:
        one = folded(one)
    while two.shape[-1] > one.shape[-1]:
        two = folded(two)
    return np.bitwise_count(one ^ two).sum(axis=-1, dtype=np.int64)


def _passing(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs ``a, b`` whose signatures leave room for a link."""

    @F.arrow_udf("boolean")
    def may(size_a: pa.Array, size_b: pa.Array, bits_a: pa.Array, bits_b: pa.Array) -> pa.Array:
        differing = [
            int(_differing(np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)))
            for one, two in zip(bits_a.to_pylist(), bits_b.to_pylist())
        ]
        total = size_a.to_numpy().astype(np.int64) + size_b.to_numpy()
        return pa.array(_may_link(total, np.array(differing, np.int64)))

    for side in "ab":
        own = nodes.select(F.col("node").alias(side), F.col("size").alias(f"size_{side}"), F.col("bits").alias(f"bits_{side}"))
        pairs = pairs.join(own, side)
    return pairs.filter(may("size_a", "size_b", "bits_a", "bits_b")).select("a", "b")


def _firsts(tiles: DataFrame) -> DataFrame:
    """``node, firsts``: the shingles of each node's tiles with the smallest hashes, its own number in place of
    missing ones."""
    own = F.sort_array(F.collect_list(F.struct(F.xxhash64("shingle").alias("hash"), "shingle")))
    known = tiles.groupBy("node").agg(F.slice(own, 1, FIRST)["shingle"].alias("known"))
    return known.select("node", F.slice(F.concat("known", F.array_repeat("node", FIRST)), 1, FIRST).alias("firsts"))


def _meet_first(firsts: np.ndarray, shingles: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether the tile is the one of the first shingle that is known to be in the prefixes of both rows.

    Both rows are in the tile of each such shingle, so the pair is found there. With none known it is
    found in every tile that both are in.
    """
    shared = (firsts[one][:, :, None] == firsts[two][:, None, :]).any(axis=2)
    first = firsts[one, shared.argmax(axis=1)] if len(one) else np.zeros(0, np.uint64)
    return ~shared.any(axis=1) | (first == shingles[one])


def _across(tiles: DataFrame, described: DataFrame, labels: DataFrame, more: DataFrame | None, closest: int, put: Put) -> DataFrame:
    """Pairs of one tile in different components that pass by size and signature: of a row of a large tile
    the ``closest`` ones, and a pair of the row with itself if it has more.

    After the first turn only pairs of a node in ``more`` in large tiles are left to be found.
    """
    named = tiles.select("shingle", "node").join(labels, "node", "left").select(
        "shingle", "node", F.coalesce("label", "node").alias("label")
    )
    if more is None:
        named = named.withColumn("had_more", F.lit(True))
    else:
        own = more.select("node", F.lit(True).alias("had_more"))
        named = named.join(own, "node", "left").withColumn("had_more", F.coalesce("had_more", F.lit(False)))
    several = named.groupBy("shingle").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("rows"), F.max("had_more").alias("left")
    ).filter("low < high" if more is None else f"low < high AND left AND rows > {FEW}")
    # Stored, so that the join reads two plain exchanges and Spark can split a very common shingle.
    rows = put(named.join(put(several.select("shingle"), "mixed-shingles"), "shingle"), "mixed-tiles")
    full = rows.join(described, "node").select("shingle", "size", "node", "label", "had_more", "bits", "firsts")

    def compare(batches):
        from itertools import chain

        held: pa.Table | None = None
        for batch in chain(batches, [None]):
            table = pa.Table.from_batches([batch]) if batch is not None else None
            if table is not None and not table.num_rows:
                continue
            if held is not None:
                table = pa.concat_tables([held, table]) if table is not None else held
            if table is None:
                return
            shingles = table.column(0).to_numpy()
            begins = np.flatnonzero(np.r_[True, shingles[1:] != shingles[:-1]])
            if batch is None:
                ends, held = np.r_[begins[1:], len(shingles)], None
            else:  # the last tile may go on in the next batch
                ends, held, begins = begins[1:], table.slice(int(begins[-1])), begins[:-1]
            yield _compared(table, begins, ends, closest)

    ordered = full.repartition("shingle").sortWithinPartitions("shingle", "size", "node")
    return ordered.mapInArrow(compare, "a bigint, b bigint").distinct()


def _compared_at_once(size, node, label, bits, firsts, shingles, begins, ends) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Passing pairs of small tiles, all pairs of a stretch of tiles at a time."""
    left, right = [], []
    counts = (ends - begins) * (ends - begins - 1) // 2
    for part in np.split(np.arange(len(begins)), np.flatnonzero(np.diff(np.cumsum(counts) // PAIRS)) + 1):
        rows = np.repeat(begins[part], ends[part] - begins[part])
        rows = rows + np.arange(len(rows)) - np.repeat(np.cumsum(ends[part] - begins[part]) - (ends[part] - begins[part]), ends[part] - begins[part])
        later = np.repeat(ends[part], ends[part] - begins[part]) - rows - 1
        one = np.repeat(rows, later)
        two = one + 1 + np.arange(len(one)) - np.repeat(np.cumsum(later) - later, later)
        near = (label[one] != label[two]) & (4 * size[one] >= 3 * size[two])
        one, two = one[near], two[near]
        if not len(one):
            continue
        width = np.array([len(bits[row]) for row in rows.tolist()])
        by_width = {}
        for own in np.unique(width).tolist():
            having = rows[width == own]
            matrix = np.frombuffer(b"".join([bits[row] for row in having.tolist()]), np.uint64).reshape(len(having), -1)
            by_width[own] = having, matrix
        width_one, width_two = width[np.searchsorted(rows, one)], width[np.searchsorted(rows, two)]
        differing = np.zeros(len(one), np.int64)
        for first in by_width:
            for second in by_width:
                picked = np.flatnonzero((width_one == first) & (width_two == second))
                if len(picked):
                    (rows_a, bits_a), (rows_b, bits_b) = by_width[first], by_width[second]
                    differing[picked] = _differing(
                        bits_a[np.searchsorted(rows_a, one[picked])], bits_b[np.searchsorted(rows_b, two[picked])]
                    )
        passed = _may_link(size[one] + size[two], differing)
        one, two = one[passed], two[passed]
        here = _meet_first(firsts, shingles, one, two)
        one, two = node[one[here]], node[two[here]]
        left.append(np.minimum(one, two))
        right.append(np.maximum(one, two))
    return left, right


def _compared(table: pa.Table, begins: np.ndarray, ends: np.ndarray, closest: int) -> pa.RecordBatch:
    size, node, label = (table.column(name).to_numpy().astype(np.int64) for name in ("size", "node", "label"))
    had_more = table.column("had_more").to_numpy()
    bits, shingles = table.column("bits").to_pylist(), table.column("shingle").to_numpy().view(np.uint64)
    firsts = pc.list_flatten(table.column("firsts")).to_numpy().view(np.uint64).reshape(-1, FIRST)
    few = ends - begins <= FEW
    left, right = _compared_at_once(size, node, label, bits, firsts, shingles, begins[few], ends[few])
    for begin, end in zip(begins[~few].tolist(), ends[~few].tolist()):
        values, counts = np.unique(label[begin:end], return_counts=True)
        main = values[counts.argmax()]
        # Rows are sorted by size, so those of one signature width are neighbours.
        widths = np.array([len(own) for own in bits[begin:end]])
        cuts = begin + np.flatnonzero(np.r_[True, np.diff(widths) != 0, True])
        parts = [
            (low, high, np.frombuffer(b"".join(bits[low:high]), np.uint64).reshape(high - low, -1))
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist())
        ]
        for one in (begin + np.flatnonzero(label[begin:end] != main)).tolist():
            # all partners of the largest component, and earlier ones of the others
            least = begin + np.searchsorted(size[begin:end], -(-3 * size[one] // 4))
            most = begin + np.searchsorted(size[begin:end], 4 * size[one] // 3, side="right")
            own, found, apart = np.frombuffer(bits[one], np.uint64), [], []
            for low, high, rows in parts:
                for block in range(max(low, least), min(high, most), BLOCK):
                    other = np.arange(block, min(block + BLOCK, high, most))
                    other = other[(label[other] == main) | ((label[other] != label[one]) & (other < one))]
                    other = other if had_more[one] else other[had_more[other]]
                    differing, total = _differing(own, rows[other - low]), size[one] + size[other]
                    passed = _may_link(total, differing)
                    found.append(other[passed])
                    apart.append(differing[passed] / total[passed])
            found = np.concatenate(found) if found else np.zeros(0, np.int64)
            # The closest ones of all tiles are much the same; each is emitted in one of them.
            rest = len(found) > closest
            if rest:
                found = found[np.argpartition(np.concatenate(apart), closest)[:closest]]
            found = found[_meet_first(firsts, shingles, np.full(len(found), one), found)]
            if rest:  # a pair of the row with itself says that it has more
                found = np.r_[found, one]
            left.append(np.minimum(node[one], node[found]))
            right.append(np.maximum(node[one], node[found]))
    columns = [np.concatenate(part) if part else np.zeros(0, np.int64) for part in (left, right)]
    return pa.RecordBatch.from_arrays([pa.array(column) for column in columns], ["a", "b"])


def _verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, repeated: bool, put: Put) -> DataFrame:
    """Pairs ``a, b`` that link, by intersection of their whole sets; ``pairs`` are stored.

    Members ``b`` travel to the text of ``a``. An ``a`` with many members is repeated for parts of them.
    """
    needed = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    keys = put(nodes.select("node", "doc_id", "text_hash").join(needed, "node"), "passing-nodes")
    known = put(_texts_of(docs, keys, repeated), "passing-texts")
    copies = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("copies"))
    heads = copies.join(known.withColumnRenamed("node", "a"), "a").select(
        "a", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(None).cast("long").alias("b"), "text"
    )
    members = pairs.join(copies, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("copies")).cast("int").alias("copy"))
    members = members.join(known.withColumnRenamed("node", "b"), "b").select("a", "copy", "b", "text")

    def verify(batches):
        head, own = None, None
        for part, texts in _text_batches(batches, 3):
            a, b = [], []
            for key, copy, member, shingles in zip(
                part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), shingle_sets(texts)
            ):
                if member is None:
                    head, own = (key, copy), shingles
                    continue
                assert head == (key, copy)
                overlap = len(np.intersect1d(own, shingles, assume_unique=True))
                if 100 * overlap >= 75 * (len(own) + len(shingles) - overlap):
                    a.append(key)
                    b.append(member)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    ordered = heads.unionByName(members).repartition("a", "copy").sortWithinPartitions("a", "copy", "b")
    return put(ordered.mapInArrow(verify, "a bigint, b bigint"), "verified-links")


def _joined(labels: DataFrame | None, links: DataFrame, put: Put) -> DataFrame:
    """``node, label`` after further links; the label is the smallest node reachable.

    Links are first taken between labels, so that what is joined already is not gone through again.
    """
    if labels is None:
        return components(links, put)
    ends = links
    for side in "ab":
        own = labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
        ends = ends.join(own, side, "left").withColumn(f"label_{side}", F.coalesce(f"label_{side}", side))
    between = put(ends.filter("label_a <> label_b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b")).distinct(), "label-links")
    moved = components(between, put)
    fresh_ends = between.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left_anti")
    every = labels.unionByName(fresh_ends.select("node", F.col("node").alias("label")))
    onward = moved.select(F.col("node").alias("label"), F.col("label").alias("onward"))
    return put(every.join(onward, "label", "left").select("node", F.coalesce("onward", "label").alias("label")), "labels")


def _one_leader(led: DataFrame, turn: int) -> DataFrame:
    """One pair ``a, b`` per node, with its smallest leader at first and another one in each turn."""
    order = F.xxhash64("node", "leader", F.lit(turn)) if turn else F.col("leader")
    chosen = led.groupBy("node").agg(F.min_by("leader", order).alias("leader"))
    return chosen.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()


def _apart(led: DataFrame, labels: DataFrame) -> DataFrame:
    """Nodes and leaders that are not in one component."""
    for side in ("node", "leader"):
        own = labels.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label"))
        led = led.join(own, side, "left").withColumn(f"{side}_label", F.coalesce(f"{side}_label", side))
    return led.filter("node_label <> leader_label").select("node", "leader")


def similar_components(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, size, component_id`` of every row of ``docs`` (``doc_id, text, text_hash``)."""
    ship(docs.sparkSession)
    with scratch(docs.sparkSession) as put:
        return stored(_labelled(docs, put), "components")


def _labelled(docs: DataFrame, put: Put) -> DataFrame:
    described = _described(docs, put)
    nodes = _nodes(described, put)
    repeated = _repeated(described)
    texts = _texts_of(docs, nodes, repeated)
    common = _common(_prefixes(texts, np.zeros(0, np.uint64)), put)
    tiles = _tiles(_prefixes(texts, common), put)
    led = put(tiles.filter("node <> leader").select("node", "leader").distinct(), "led-nodes")
    # A node of a large group has many leaders; one is tried at a time, while it is still apart from
    # it, so that groups grow together from ever fewer parts. What then is left are mostly parts that do
    # not link, and these are found faster by comparing them.
    labels, apart = None, led
    for turn in range(LEADERS):
        tried = put(_passing(_one_leader(apart, turn), nodes), "leader-pairs")
        new = _verified(tried, docs, nodes, repeated, put)
        labels = _joined(labels, new, put)
        if 2 * new.count() <= tried.count():
            break
        apart = put(_apart(led, labels), "apart")
        if apart.isEmpty():
            break
    full = put(nodes.select("node", "size", "bits").join(_firsts(tiles), "node"), "full-nodes")
    closest, more = CLOSEST, None
    while more is None or not more.isEmpty():
        passed = put(_across(tiles, full, labels, more, closest, put), "across-pairs")
        labels = _joined(labels, _verified(passed.filter("a <> b"), docs, nodes, repeated, put), put)
        closest, more = MORE * closest, passed.filter("a = b").select(F.col("a").alias("node"))
    placed = described.join(nodes.select("one", "two", "node"), ["one", "two"], "left").join(labels, "node", "left")
    placed = put(placed.select("doc_id", "text_hash", "size", F.coalesce("label", "node").alias("label")), "labelled")
    smallest = put(placed.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("smallest")), "smallest")
    return placed.join(smallest, "label", "left").select(
        "doc_id", "text_hash", "size",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "doc_id")).alias("component_id"),
    )


def _repeated(described: DataFrame) -> bool:
    """Whether some document occurs more than once with the same text."""
    return described.groupBy("doc_id", "text_hash").count().filter("count > 1").limit(1).count() > 0


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))


def join_components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row."""
    return similar_components(_hashed(docs)).select("doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id")


def keep_one_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per component, that of its smallest ``doc_id``; same columns.

    Rows without shingles and rows with a null ``doc_id`` all stay.
    """
    found = similar_components(_hashed(docs)).filter(
        "component_id <> doc_id"
    ).select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).distinct()
    key = fresh(docs, "text_hash")
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    kept = keyed.join(found, (keyed["doc_id"] == found["__doc"]) & (keyed[key] == found["__hash"]), "left_anti")
    return kept.select(*docs.columns)


def keep_one_row_each(docs: DataFrame) -> DataFrame:
    """Exactly one row of ``docs`` per component, whatever its ``doc_id``; same columns.

    Unlike in ``keep_one_each``, rows with a null ``doc_id`` and different texts of one ``doc_id`` are
    members like any other. The row with the smallest ``doc_id`` stays, null last, then that with the
    smallest hash of the text; of rows equal in both, one stays. Rows without shingles all stay.
    """
    text = F.coalesce("text", F.lit(""))
    # A struct is never null itself, and inside of it null equals null. Two hashes tell all texts apart.
    key = F.struct(
        F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"),
        F.xxhash64(text).alias("one"), F.xxhash64(F.lit("second"), text).alias("two"),
    )
    found = similar_components(docs.select(key.alias("doc_id"), "text", F.xxhash64(text).alias("text_hash")))
    leading = found.filter("size > 0 AND component_id = doc_id").groupBy("doc_id").count().filter("count > 1")
    repeated = stored(leading.select(F.col("doc_id").alias("__key")), "repeated-leading-rows")
    others = found.filter("component_id <> doc_id").select(F.col("doc_id").alias("__key")).distinct()
    name = fresh(docs, "row_key")
    keyed = docs.withColumn(name, key)
    gone = others.unionByName(repeated)
    kept = keyed.join(gone, keyed[name] == gone["__key"], "left_anti").select(*docs.columns)
    once = keyed.join(repeated, keyed[name] == repeated["__key"], "left_semi").dropDuplicates([name])
    return kept.unionByName(once.select(*docs.columns))

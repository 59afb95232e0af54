"""Near-duplicate classes by a MinHash LSH forest, with every link confirmed on full shingle sets.

Texts with equal sets are one node (a 128-bit hash of the set; so groups of copies never pair up).
Every tree of the forest gives a node a signature: the tree's number and its MinHash values, two
bytes each, so that signatures sort as bytes. A region is a run of that order with one common prefix
of at least the forest's depth, and neighbours are nodes of one region. The first depth grows with
the logarithm of the rows, so that regions of unlike texts stay small, and the trees with it.

Depth adapts: a region in which more than BLOCK nodes stand outside the largest component is not
searched but split, its nodes' signatures getting STEP more values, up to LEVELS depths. These nodes
get more trees too, as many as the new depth needs: a pair that shares a region to be split has both
its nodes there. So at each depth a pair at the threshold shares no region with a chance of
MISS / LEVELS at most, and is missed with a chance of MISS at most, at any size. What the last depth
can't split is searched whole, in tiles.

Three rounds of candidates at each depth, and no list of all pairs of a region:

1. In each region every node is paired with the region's head, the node that shares most regions.
   Links found give components.
2. Regions that still hold several components are sorted by their trees' whole signatures (a range
   sort over all trees), and nodes that stand next to each other there, so have the longest common
   prefix, are candidates if their components differ. The sort cuts regions wherever it likes: a
   neighbour lost to a cut is met in round 3.
3. In regions that even then hold several components, nodes outside the largest are compared with
   all nodes of other components there by their MinHash values (SKETCH of them); pairs whose
   estimate lies within ESTIMATE of the threshold are candidates, each in its first common tree,
   and confirmed where they are found, until their components are one. So a tile yields fewer
   links than it has components. A region's nodes and those of them outside the largest component
   are dealt by hash into blocks of about BLOCK each, and a tile is one block of each kind: a task
   holds two blocks at a time, whatever the region's size. Tiles first go by signatures alone; texts
   are fetched only for nodes that a pair of the tile needs.

Pairs inside a component need no test, so what later rounds leave out can't change a class.
Candidates are confirmed on the texts themselves: the sets' 64-bit shingle hashes are intersected
and counted in integers. Components are found by contraction: every node joins its least neighbour,
edges are renamed, and what is left is done again; ids are hashes, so long chains shrink fast.

Defined cases: null texts, empty texts and texts without words have an empty set and are linked
with nothing; a text with fewer words than a shingle has one shingle of all its words; null
doc_ids count after all others in component_id; rows that repeat a doc_id each get a row, and such
rows are all kept if one is; other columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from simsift.llm._ftrl import map_texts
from simsift.llm._space import bounded, written
from simsift.llm._text import Chunk, chunks, mix, shingles, words

WIDTH, PERCENT = 5, 80
MISS, SKETCH, ESTIMATE = 1e-6, 224, 0.16
#: Nodes of a region that one task compares at once; pairs with a head that one task confirms.
BLOCK, PAIRS_A_TASK = 1024, 256
#: Depths of the forest and how many values one has more than the one before. Signatures have STEP
#: values beyond the depth, to sort by; a tree has at most TREE_VALUES.
LEVELS, STEP, TREE_VALUES = 3, 4, 64


def forest_shape(rows: int, percent: int = PERCENT) -> tuple[int, int]:
    """Depth and trees: 4 levels to a million rows, one more for each factor of 30 beyond."""
    depth = 4 + max(0, math.ceil(math.log(max(rows, 1) / 1e6) / math.log(30)))
    return depth, trees_at(depth, percent)


def trees_at(depth: int, percent: int) -> int:
    return math.ceil(math.log(MISS / LEVELS) / math.log(1 - (percent / 100) ** depth))


def set_ids(sets: list[np.ndarray]) -> list[bytes | None]:
    """A 128-bit hash of each set, None for an empty one."""
    out: list[bytes | None] = []
    for s in sets:
        if len(s):
            one, two = mix(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64), mix(s + np.uint64(0x3C6EF372FE94F82B)).sum(dtype=np.uint64)
            out.append(int(one).to_bytes(8, "big") + int(two).to_bytes(8, "big"))
        else:
            out.append(None)
    return out


def minhashes(sets: list[np.ndarray], numbers: np.ndarray) -> np.ndarray:
    """sets (none empty) x hash functions of these numbers."""
    low = np.concatenate(sets)
    low = (low >> np.uint64(17)).astype(np.uint32)
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    seeds = mix((numbers.astype(np.uint64) + np.uint64(11)) * np.uint64(0x9E3779B97F4A7C15))
    salts, odds = seeds.astype(np.uint32), (seeds >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    out = np.empty((len(sets), len(numbers)), np.uint32)
    for k in range(len(numbers)):
        h = (low ^ salts[k]) * odds[k]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        out[:, k] = np.minimum.reduceat(h, first)
    return out


def hash_numbers(depth: int, trees: int) -> np.ndarray:
    """trees x depth: numbers of the hash functions; a tree's are the same at any depth."""
    return np.arange(trees)[:, None] * TREE_VALUES + np.arange(depth)[None]


def signatures(sets: list[np.ndarray], depth: int, trees: int) -> list[bytes]:
    """Of each set (none empty) its signatures in all trees, one after another."""
    values = minhashes(sets, hash_numbers(depth + STEP, trees).ravel())
    out = np.empty((len(sets), trees, depth + STEP + 1), ">u2")
    out[:, :, 0] = np.arange(trees)
    out[:, :, 1:] = (values * np.uint32(0x85EBCA6B) >> np.uint32(16)).reshape(len(sets), trees, -1)
    return [row.tobytes() for row in out]


def sketched(docs: DataFrame, width: int, depth: int, trees: int) -> DataFrame:
    """doc_id, n_shingles, sid, signs (of all trees) of docs(doc_id, text)."""

    def work(chunk: Chunk) -> dict:
        sets = shingles(*words(chunk), width)
        full = [k for k, s in enumerate(sets) if len(s)]
        signs = [None] * chunk.rows
        if full:
            for k, sign in zip(full, signatures([sets[k] for k in full], depth, trees)):
                signs[k] = sign
        return {
            "n_shingles": np.array([len(s) for s in sets], np.int64),
            "sid": pa.array(set_ids(sets), pa.binary()),
            "signs": pa.array(signs, pa.binary()),
        }

    return map_texts(docs.select("doc_id", "text"), "n_shingles long, sid binary, signs binary", lambda: work)


def deeper(texts: DataFrame, width: int, depth: int, trees: int) -> DataFrame:
    """sid, signs of texts(sid, text), none without words."""

    def work(chunk: Chunk) -> dict:
        return {"signs": pa.array(signatures(shingles(*words(chunk), width), depth, trees), pa.binary())}

    return map_texts(texts.dropDuplicates(["sid"]), "signs binary", lambda: work)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def texts_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """sid, text of the wanted nodes (sid); of rows that share a doc_id those with the node's set."""
    need = written(wanted.select("sid").distinct().join(nodes.select("sid", "lo"), "sid"), "wanted-texts")
    rows = docs.select("doc_id", "text").join(bounded(need), F.col("doc_id").eqNullSafe(F.col("lo"))).select("text", "sid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = []
            for chunk in chunks(batch.column(0)):
                names += set_ids(shingles(*words(chunk), width))
            same = [a == b for a, b in zip(names, batch.column(1).to_pylist())]
            yield batch.filter(pa.array(same, pa.bool_()))

    return rows.mapInArrow(run, "text string, sid binary")


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """a, b of those pairs (a written table of set ids leaf, hub) whose full sets are similar."""
    loads = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / PAIRS_A_TASK).alias("parts"))
    loads = bounded(written(loads.where("parts > 1"), "large-hubs"))
    part = F.pmod(F.xxhash64("leaf"), F.coalesce("parts", F.lit(1))).alias("part")
    dealt = written(pairs.join(loads, "hub", "left").select("hub", part, "leaf"), "dealt-pairs")
    wanted = dealt.select("hub", "part", F.lit(1).alias("role"), F.col("leaf").alias("sid")).unionByName(
        dealt.select("hub", "part", F.lit(0).alias("role"), F.col("hub").alias("sid")).distinct()
    )
    rows = wanted.join(texts_of(wanted, nodes, docs, width), "sid")
    rows = rows.repartition("hub", "part").sortWithinPartitions("hub", "part", "role").select("text", "hub", "part", "role", "sid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.uint64)
        for batch in batches:
            hubs, _, roles, sids = (batch.column(k).to_pylist() for k in range(1, 5))
            found: list[tuple[bytes, bytes]] = []
            for chunk in chunks(batch.column(0)):
                for k, s in enumerate(shingles(*words(chunk), width), chunk.first):
                    if roles[k] == 0:
                        held = s
                    elif similar(s, held, percent):
                        found.append((sids[k], hubs[k]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*found)], names=["a", "b"])

    return written(rows.mapInArrow(run, "a binary, b binary"), "links")


def components(links: DataFrame) -> DataFrame:
    """v, root of every node of links(a, b), a written table; root is the same for all that are linked."""
    edges, steps = links.select("a", "b"), []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("v"), F.least("a", "b").alias("root"))
        parents = written(parents, "parents")
        steps.append(parents)
        for end in ("a", "b"):
            renamed = parents.select(F.col("v").alias(end), F.col("root").alias("_root"))
            edges = edges.join(renamed, end).drop(end).withColumnRenamed("_root", end)
        edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        edges = written(edges, "edges")
    if not steps:
        return links.select(F.col("a").alias("v"), F.col("b").alias("root"))
    label = steps[0]
    for step in steps[1:]:
        next_ = step.select(F.col("v").alias("_v"), F.col("root").alias("_root"))
        label = label.join(next_, F.col("root") == F.col("_v"), "left").select("v", F.coalesce("_root", "root").alias("root"))
    return written(label, "labels") if len(steps) > 1 else label


class Region:
    """The rows of one tile of a region; without a column of texts only its candidates can be asked for."""

    def __init__(self, rows: pa.Table, width: int):
        self.rows, self.width, self.sets = rows, width, {}
        k = rows.column("k")[0].as_py()
        self.tree = int.from_bytes(k[:2], "big")
        self.sid = rows.column("sid").to_pylist()
        names = [x.hex() for x in rows.column("root").to_pylist()]
        self.root = np.unique(names, return_inverse=True)[1].tolist()
        self.asks, self.here = np.array(rows.column("asks")), np.array(rows.column("here"))
        self.n = np.array(rows.column("n_shingles"))
        depth = len(k) // 2
        signs = np.frombuffer(b"".join(rows.column("signs").to_pylist()), np.uint16).reshape(len(self.n), -1, depth + STEP)
        self.sketch = np.ascontiguousarray(signs[:, :, 1:].reshape(len(self.n), -1)[:, :SKETCH])
        self.prefixes = np.ascontiguousarray(signs[:, :, :depth]).view(f"S{2 * depth}")[:, :, 0]
        self.parent = list(range(len(self.n)))

    def component(self, i: int) -> int:
        """Of row i, by the number of its root."""
        r = self.root[i]
        while self.parent[r] != r:
            r = self.parent[r]
        return r

    def set_of(self, i: int) -> np.ndarray:
        if i not in self.sets:
            [chunk] = chunks(self.rows.column("text").slice(i, 1).combine_chunks())
            [self.sets[i]] = shingles(*words(chunk), self.width)
        return self.sets[i]

    def candidates(self, percent: int) -> Iterator[tuple[int, int]]:
        """Pairs of different components, those that look most alike first within each step."""
        a_all, b_all, root = np.flatnonzero(self.asks), np.flatnonzero(self.here), np.array(self.root)
        step = max(1, (1 << 23) // max(1, len(b_all) * self.sketch.shape[1]))
        for at in range(0, len(a_all), step):
            a = a_all[at : at + step]
            x, y = self.n[a][:, None], self.n[b_all]
            near = (np.minimum(x, y) * 100 >= percent * np.maximum(x, y)) & (root[a][:, None] != root[b_all])
            if not near.any():
                continue
            alike = (self.sketch[a][:, None, :] == self.sketch[b_all][None]).mean(2)
            i, j = np.nonzero(near & (alike >= percent / 100 - ESTIMATE))
            for q in np.argsort(-alike[i, j]).tolist():
                x, y = int(a[i[q]]), int(b_all[j[q]])
                if (self.prefixes[x] == self.prefixes[y]).argmax() == self.tree:
                    yield x, y

    def likely(self, percent: int) -> np.ndarray:
        """The rows that some candidate holds."""
        held = np.zeros(len(self.n), bool)
        for pair in self.candidates(percent):
            held[list(pair)] = True
        return np.flatnonzero(held)

    def links(self, percent: int) -> Iterator[tuple[bytes, bytes]]:
        for x, y in self.candidates(percent):
            r, s = self.component(x), self.component(y)
            if r != s and similar(self.set_of(x), self.set_of(y), percent):
                self.parent[r] = s
                yield self.sid[x], self.sid[y]


TILE = ["k", "askers", "block"]


def tiles(rows: DataFrame) -> DataFrame:
    """rows(k, sid, root, asks, size, n_asks) of open regions, each in every tile that needs it: k,
    askers, block (of the tile), sid, root, asks and here (whether it is of the tile's askers, of its block)."""
    across, down = (F.ceil(F.col(n) / BLOCK).cast("int") for n in ("n_asks", "size"))
    own, mine = F.pmod(F.xxhash64("sid"), down).cast("int"), F.pmod(F.xxhash64(F.lit("asks"), "sid"), across).cast("int")
    placed = rows.withColumns({"own": own, "mine": F.when(F.col("asks"), mine)})
    here = placed.withColumn("askers", F.explode(F.sequence(F.lit(0), across - 1)))
    here = here.select("k", "askers", F.col("own").alias("block"), "sid", "root", F.coalesce(F.col("askers") == F.col("mine"), F.lit(False)).alias("asks"), F.lit(True).alias("here"))
    asks = placed.where("asks").withColumn("block", F.explode(F.sequence(F.lit(0), down - 1))).where("block <> own")
    return here.unionByName(asks.select("k", F.col("mine").alias("askers"), "block", "sid", "root", F.lit(True).alias("asks"), F.lit(False).alias("here")))


def _by_tile(rows: DataFrame, work: Callable, schema: str | StructType) -> DataFrame:
    """What work makes of the table of each tile of rows, whose first columns are the tile's."""
    rows = rows.select(*TILE, *[c for c in rows.columns if c not in TILE]).repartition(*TILE).sortWithinPartitions(*TILE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, name = [], None
        for batch in batches:
            names = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
            cuts = [k for k in range(1, len(names)) if names[k] != names[k - 1]]
            for x, y in zip([0, *cuts], [*cuts, len(names)]):
                if y > x and name != names[x]:
                    if group:
                        yield from work(pa.Table.from_batches(group))
                    group, name = [], names[x]
                if y > x:
                    group.append(batch.slice(x, y - x))
        if group:
            yield from work(pa.Table.from_batches(group))

    return rows.mapInArrow(run, schema)


def open_regions(regions: DataFrame, label: DataFrame) -> DataFrame:
    """k, sid, root, size, n_asks, asks of regions(k, sid, size) that hold several components."""
    placed = regions.select("k", "sid", "size").join(label, F.col("sid") == F.col("v"), "left")
    placed = written(placed.select("k", "sid", "size", F.coalesce("root", "sid").alias("root")), "placed")
    counts = placed.groupBy("k", "root").count().groupBy("k")
    counts = counts.agg(F.max(F.struct("count", "root")).alias("most"), F.sum("count").alias("all"), F.count(F.lit(1)).alias("n"))
    open_ = counts.where("n > 1").select("k", F.col("most.root").alias("largest"), (F.col("all") - F.col("most.count")).alias("n_asks"))
    open_ = bounded(written(open_, "open-regions"))  # so a region of one large component reaches no task whole
    rows = placed.join(open_, "k").withColumn("asks", F.col("root") != F.col("largest"))
    return written(rows.drop("largest"), "open-rows")


def sign_in(k: Column, signs: Column, size: int) -> Column:
    """The signature (size bytes) of the tree of prefix k."""
    return F.substring(signs, F.conv(F.hex(F.substring(k, 1, 2)), 16, 10).cast("int") * size + 1, F.lit(size))


def neighbours(rows: DataFrame) -> DataFrame:
    """leaf, hub: nodes of rows(k, sid, root, sign) next to each other in the order of sign, of one
    region but of different components."""
    ordered = rows.repartitionByRange("sign", "sid").sortWithinPartitions("sign", "sid").select("k", "root", "sid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            k, root, sid = pa.Table.from_batches([*held, batch]).combine_chunks().columns
            held = [batch.slice(len(batch) - 1)]
            near = pc.and_(pc.equal(k[1:], k[:-1]), pc.not_equal(root[1:], root[:-1])).combine_chunks()
            yield pa.RecordBatch.from_arrays([x.combine_chunks().filter(near) for x in (sid[1:], sid[:-1])], names=["leaf", "hub"])

    found = ordered.mapInArrow(run, "leaf binary, hub binary")
    return written(found.select(F.least("leaf", "hub").alias("leaf"), F.greatest("leaf", "hub").alias("hub")).distinct(), "neighbours")


def searched(rows: DataFrame, at: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """a, b: links between components of open regions, enough to join those that are linked."""
    dealt = tiles(rows).join(at.select("sid", "n_shingles", "signs"), "sid")

    def likely(tile: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = Region(tile, width).likely(percent)
        if len(rows):
            yield from tile.take(pa.array(rows)).combine_chunks().to_batches()

    def links(tile: pa.Table) -> Iterator[pa.RecordBatch]:
        found = list(Region(tile, width).links(percent))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*found)], names=["a", "b"])

    dealt = dealt.select(*TILE, "sid", "root", "asks", "here", "n_shingles", "signs")
    near = written(_by_tile(dealt, likely, dealt.schema), "likely-rows")
    near = near.join(texts_of(near, nodes, docs, width), "sid")
    return written(_by_tile(near, links, "a binary, b binary"), "more-links")


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs(doc_id, text)."""
    depth, trees = forest_shape(docs.count(), percent)
    rows = written(sketched(docs, width, depth, trees), "sketches")
    nodes = rows.where("sid IS NOT NULL").groupBy("sid").agg(F.min("doc_id").alias("lo"), *(F.first(c).alias(c) for c in ("n_shingles", "signs")))
    at = nodes = written(nodes, "nodes")
    found = label = None
    for level in range(LEVELS):
        size = 2 * (depth + STEP + 1)
        each = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.substring("signs", t * size + 1, F.lit(2 * (depth + 1))))
        members = at.select("sid", F.explode(each).alias("k"))
        sizes = written(members.groupBy("k").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "region-sizes")
        regions = members.join(sizes, "k").withColumn("root", F.col("sid"))
        if label is not None:
            regions = regions.drop("root").join(label, F.col("sid") == F.col("v"), "left").select("k", "sid", "size", F.coalesce("root", "sid").alias("root"))
        regions = written(regions, "regions")
        shared = regions.groupBy("sid").agg(F.sum("size").alias("shared"))
        heads = regions.join(shared, "sid").groupBy("k").agg(F.max(F.struct("shared", "sid", "root")).alias("head"))
        heads = written(heads.select("k", F.col("head.sid").alias("hub"), F.col("head.root").alias("hub_root")), "heads")
        pairs = regions.join(heads, "k").where("root <> hub_root").select(F.col("sid").alias("leaf"), "hub").distinct()
        links = confirmed(written(pairs, "head-pairs"), nodes, docs, width, percent)
        found = links if found is None else written(found.unionByName(links), "links-so-far")
        label = components(found)

        rows_left = open_regions(regions, label)
        signed = rows_left.join(at.select("sid", "signs"), "sid").select("k", "sid", "root", sign_in(F.col("k"), F.col("signs"), size).alias("sign"))
        pairs = neighbours(signed)
        if not (links := confirmed(pairs, nodes, docs, width, percent)).isEmpty():
            found = written(found.unionByName(links), "links-so-far")
            label = components(found)
            rows_left = open_regions(rows_left, label)
        hot = None
        if level < LEVELS - 1 and not rows_left.where(F.col("n_asks") > BLOCK).isEmpty():
            hot = written(rows_left.where(F.col("n_asks") > BLOCK).select("sid").distinct(), "nodes-to-split")
            rows_left = rows_left.where(F.col("n_asks") <= BLOCK)
        links = searched(rows_left, at, nodes, docs, width, percent)
        if not links.isEmpty():
            found = written(found.unionByName(links), "all-links")
            label = components(found)
        if hot is None:
            break
        depth, trees = depth + STEP, trees_at(depth + STEP, percent)
        deep = deeper(texts_of(hot, nodes, docs, width), width, depth, trees)
        at = written(deep.join(nodes.select("sid", "n_shingles"), "sid"), "deeper-nodes")
    named = label.join(nodes.select("sid", "lo"), F.col("v") == F.col("sid")).select("v", "root", "lo")
    least = named.groupBy("root").agg(F.min("lo").alias("component_id"))
    linked = named.join(least, "root").select("v", "component_id")
    classes = nodes.select("sid", "lo").join(linked, F.col("sid") == F.col("v"), "left")
    classes = written(classes.select("sid", F.coalesce("component_id", "lo").alias("component_id")), "set-classes")
    out = rows.select("doc_id", "n_shingles", "sid").join(classes, "sid", "left")
    own = F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.withColumn("component_id", own)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))

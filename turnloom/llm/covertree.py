"""Exact near-duplicate pairs of embeddings by dual traversal of cover trees.

Vectors of one label with cosine t or more are within sqrt(2 - 2t) of each other
on the unit sphere.  Equal vectors are one class with a count.  Classes are
routed to the nearest of a label's pivots and dealt into blocks of bounded size;
each block gets a cover tree: nested levels, each with half the radius of the one
above, whose nodes cover all that hangs below them.  Two trees are walked together: a pair
of nodes is dropped when the distance of the centers is beyond both covering
radii and the threshold, taken whole when even the farthest members are within
it, and else replaced by the pairs of their children.  Single members are
compared by cosine in double precision.

Blocks that can't hold a pair are dropped by the same bound before any vectors
are read.  Each block is one file in the shared folder, so only the numbers of
two blocks are shuffled a pair: tasks take pairs of the same few blocks and read
these from their files.  Pivots come from a bounded sample and change only how
well blocks are bounded, never which pairs are found.

* Vectors that are null, empty, zero, or hold null or non-finite components, and
  those without a label, link with nothing.  Lengths must agree to be compared.
* Repeated vectors link with each other; rows that share a vec_id are kept.
* An empty table gives an empty result.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.common import file_system, publish
from turnloom.llm.graph import components
from turnloom.session import cut_lineage, drop_scratch, scratch_path

COSINE = 0.93
GROUP = 2048
BLOCK = 1024
PIVOTS = 4096
SAMPLE_PER_PIVOT = 16
LEVELS = 7
TILE = 32  # blocks of either side that a run of pairs meets, at most
HELD_BYTES = 128 << 20  # of blocks that a task keeps while it walks pairs
MAX_TASKS = 10_000
_EDGE = 1e-9  # what rounding may move a bound
_TREE = ["level", "start", "center", "radius"]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)))


class Tree:
    """A cover tree of unit vectors, kept as levels of contiguous nodes.

    Level 0 is one node; the nodes of level k are balls of radius at most 2^(1-k),
    each inside one node of the level above; the last level has single members.
    """

    def __init__(self, level: np.ndarray, start: np.ndarray, center: np.ndarray, radius: np.ndarray, n: int):
        self.n = n
        self.levels = []
        for k in range(int(level.max()) + 1):
            at = level == k
            self.levels.append((start[at], center[at], radius[at]))

    @classmethod
    def build(cls, vectors: np.ndarray) -> tuple[Tree, np.ndarray, pd.DataFrame]:
        """The tree, the order of its members, and its nodes as a table."""
        n = len(vectors)
        d = distances(vectors, vectors)
        nodes = [(0, np.arange(n))]
        levels = [nodes]
        for k in range(1, LEVELS):
            scale = 2.0 ** (1 - k)
            below = []
            for center, members in nodes:
                left = members
                near = left[d[center, left] <= scale]
                below.append((center, near))
                left = left[d[center, left] > scale]
                while len(left):
                    c = left[0]
                    close = d[c, left] <= scale
                    below.append((c, left[close]))
                    left = left[~close]
            nodes = below
            levels.append(nodes)
        levels.append([(m, np.array([m])) for _, members in nodes for m in members])
        order = np.array([m for m, _ in levels[-1]])
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        rows = []
        for k, nodes in enumerate(levels):
            at = 0
            for center, members in nodes:
                rows.append((k, at, place[center], d[center, members].max()))
                at += len(members)
        table = pd.DataFrame(rows, columns=["level", "start", "center", "radius"])
        return cls(*(table[c].to_numpy() for c in table.columns), n), order, table

    def sizes(self, k: int) -> np.ndarray:
        return np.diff(np.append(self.levels[k][0], self.n))

    def parents(self, k: int) -> np.ndarray:
        """The node of level k - 1 that each node of level k is in."""
        return np.searchsorted(self.levels[k - 1][0], self.levels[k][0], "right") - 1


def dual(a: Tree, va: np.ndarray, b: Tree, vb: np.ndarray, cosine: float = COSINE) -> np.ndarray:
    """Which members of two trees link, as a matrix."""
    reach = np.sqrt(2 - 2 * cosine)
    links = np.zeros((a.n, b.n), bool)
    alive = np.ones((1, 1), bool)
    last = min(len(a.levels), len(b.levels)) - 1
    for k in range(last):
        (_, ca, ra), (_, cb, rb) = a.levels[k], b.levels[k]
        i, j = np.nonzero(alive)
        if not len(i):
            return links
        (mine, x), (theirs, y) = np.unique(i, return_inverse=True), np.unique(j, return_inverse=True)
        d = distances(va[ca[mine]], vb[cb[theirs]])[x, y]
        both = ra[i] + rb[j]
        whole = d + both <= reach - _EDGE
        open_ = (d - both <= reach + _EDGE) & ~whole
        for x, y in zip(i[whole].tolist(), j[whole].tolist()):
            sa, sb = a.levels[k][0], b.levels[k][0]
            links[sa[x] : sa[x + 1] if x + 1 < len(sa) else a.n, sb[y] : sb[y + 1] if y + 1 < len(sb) else b.n] = True
        kept = np.zeros_like(alive)
        kept[i[open_], j[open_]] = True
        alive = kept[np.ix_(a.parents(k + 1), b.parents(k + 1))]
    i, j = np.nonzero(alive)
    for at in range(0, len(i), 1 << 16):
        x, y = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        links[x, y] = np.einsum("ij,ij->i", va[x], vb[y]) >= cosine
    return links


def joined(links: np.ndarray, same: bool) -> np.ndarray:
    """For each row and column with a link, one member of its component; -1 without. Rows count from 0, columns after them."""
    n, m = links.shape
    if same:
        m = 0
    root = np.full(n + m, -1)
    for r in np.flatnonzero(links.any(1)):
        if root[r] >= 0:
            continue
        mine, todo = np.zeros(n, bool), np.zeros(n, bool)
        todo[r] = True
        seen = np.zeros(links.shape[1], bool)
        while todo.any():
            mine |= todo
            new = links[todo].any(0) & ~seen
            seen |= new
            todo = ((new if same else links[:, new].any(1)) & ~mine)
        root[np.flatnonzero(mine)] = r
        if not same:
            root[n + np.flatnonzero(seen)] = r
    return root


def _unit(vectors: list) -> np.ndarray:
    v = np.array([np.asarray(x, float) for x in vectors])
    v /= np.abs(v).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _classes(rows: DataFrame) -> DataFrame:
    """One row per distinct vector of a label: cls, low (smallest vec_id), m (rows)."""
    groups = rows.groupBy("label", "dim", "k1", "k2").agg(F.min("vec_id").alias("low"), F.count("*").alias("m"), F.first("embedding").alias("vector"))
    return cut_lineage(groups.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")[0]


def _pivots(classes: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Pivots of the larger labels: far apart members of a sample; PIVOTS in all at most."""
    per_label = classes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    total = classes.count()
    shares = F.floor(F.least(F.col("n") / GROUP, F.col("n") * PIVOTS / F.lit(max(1, total)))).cast("int")
    large = per_label.withColumn("k", shares).where("k > 1")  # at most PIVOTS / 2 labels
    draw = F.pmod(F.xxhash64(F.lit(3), "k1", "k2"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = classes.join(F.broadcast(large), ["label", "dim"]).where(draw * F.col("n") < F.col("k") * SAMPLE_PER_PIVOT)

    def far_apart(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["k1", "k2"])
        v = _unit(group["vector"].tolist())
        chosen, gap = [0], distances(v, v[:1])[:, 0]
        while len(chosen) < min(int(group["k"].iloc[0]), len(v)):
            chosen.append(int(gap.argmax()))
            gap = np.minimum(gap, distances(v, v[chosen[-1:]])[:, 0])
        return pd.DataFrame({"label": group["label"].iloc[0], "dim": group["dim"].iloc[0], "vector": list(v[chosen])})

    found = sample.groupBy("label", "dim").applyInPandas(far_apart, "label long, dim int, vector array<double>").collect()
    pivots: dict[tuple[int, int], list] = {}
    for r in found:
        pivots.setdefault((r["label"], r["dim"]), []).append(r["vector"])
    return {k: np.array(v) for k, v in pivots.items()}


def _block_bytes(vectors: np.ndarray, cls: np.ndarray, m: np.ndarray, tree: pd.DataFrame) -> bytes:
    """A block as one Arrow file: vectors as they were given, classes and their rows, nodes of the tree."""
    columns = {"vectors": vectors.ravel(), "cls": cls, "m": m, "level": tree["level"].astype("int32"), "start": tree["start"].astype("int32"),
               "center": tree["center"].astype("int32"), "radius": tree["radius"]}
    arrays = [pa.array(np.asarray(c)) for c in columns.values()]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in arrays]
    batch = pa.record_batch(lists, names=list(columns))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


class _Shelf:
    """Blocks of a folder, read when they are asked for; the last ones used are held, up to so many bytes of vectors."""

    def __init__(self, fs: pafs.FileSystem, folder: str, most: int = HELD_BYTES):
        self.fs, self.folder, self.most = fs, folder, most
        self.held: OrderedDict[int, tuple] = OrderedDict()
        self.size = 0

    def get(self, block: int) -> tuple[Tree, np.ndarray, np.ndarray, np.ndarray]:
        if block in self.held:
            self.held.move_to_end(block)
            return self.held[block]
        with self.fs.open_input_file(f"{self.folder}/{block}.arrow") as source:
            batch = pa.ipc.open_file(source).get_batch(0)
        part = {c: batch.column(c).flatten().to_numpy() for c in batch.schema.names}
        vectors = _unit(part["vectors"].reshape(len(part["cls"]), -1))
        found = Tree(*(part[c] for c in _TREE), len(vectors)), vectors, part["cls"], part["m"]
        self.held[block] = found
        self.size += vectors.nbytes
        while self.size > self.most and len(self.held) > 2:
            self.size -= self.held.popitem(last=False)[1][1].nbytes
        return found


def _blocks(classes: DataFrame) -> tuple[DataFrame, str]:
    """(label, dim, block, middle, reach) of blocks of at most BLOCK classes, and the folder of their files.

    Vectors are shuffled once, as they were given; the cell of each is found twice
    instead of written: first to count the cells.
    """
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(_pivots(classes))
    vector = classes.schema["vector"].dataType.simpleString()

    def route(batches: Iterator[pd.DataFrame], whole: bool) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, part in batch.groupby(["label", "dim"]):
                pivots = shared.value.get((int(key[0]), int(key[1])))
                cell = np.zeros(len(part), np.int32) if pivots is None else distances(_unit(part["vector"].tolist()), pivots).argmin(1).astype(np.int32)
                yield part.assign(cell=cell) if whole else part[["label", "dim"]].assign(cell=cell)

    given = classes.select("label", "dim", "cls", "m", "vector")
    cells = given.mapInPandas(lambda batches: route(batches, False), "label long, dim int, cell int")
    parts = cells.groupBy("label", "dim", "cell").agg(F.ceil(F.count("*") / GROUP).alias("parts")).where("parts > 1")
    routed = given.mapInPandas(lambda batches: route(batches, True), f"label long, dim int, cls long, m long, vector {vector}, cell int")
    # Only cells of more than GROUP classes are in the table of parts.
    dealt = routed.join(F.broadcast(parts), ["label", "dim", "cell"], "left").withColumn("part", F.pmod(F.xxhash64("cls"), F.coalesce("parts", F.lit(1))))
    root = scratch_path(spark, "blocks")

    def plant(group: pd.DataFrame) -> pd.DataFrame:
        fs, folder = file_system(root)
        group = group.sort_values("cls")
        given = np.array(group["vector"].tolist())
        v = _unit(given)
        _, order, _ = Tree.build(v)
        out = []
        for a in range(0, len(v), BLOCK):
            own = order[a : a + BLOCK]
            _, inner, table = Tree.build(v[own])
            own = own[inner]
            center = v[own].mean(0)
            block = int(group["cls"].iloc[own[0]])
            body = _block_bytes(given[own], group["cls"].to_numpy()[own], group["m"].to_numpy()[own], table)
            publish(fs, folder, f"{block}.arrow", TaskContext.get().taskAttemptId(), iter([body]))
            out.append({
                "label": group["label"].iloc[0], "dim": group["dim"].iloc[0], "block": block,
                "middle": center, "reach": float(distances(v[own], center[None]).max()),
            })
        return pd.DataFrame(out)

    fields = "label long, dim int, block long, middle array<double>, reach double"
    planted = dealt.select("label", "dim", "cell", "part", "cls", "m", "vector").groupBy("label", "dim", "cell", "part").applyInPandas(plant, fields)
    return cut_lineage(planted, "block-bounds")[0], root


def _pairs(blocks: DataFrame, cosine: float) -> DataFrame:
    """(block, other) of blocks that the bounds leave, dealt out so that a run of pairs meets few blocks.

    Tiles are the pairs of two groups of blocks of a label; they get smaller where
    there would be too few to keep all cores at work.
    """
    spark = blocks.sparkSession
    per_label = blocks.groupBy("label", "dim").agg(F.count("*").alias("n"))
    most = per_label.agg(F.sum(F.col("n") * (F.col("n") + 1) / 2)).first()[0] or 0
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    side = max(1, min(TILE, int((most / (8 * width)) ** 0.5)))
    tasks = max(width, min(MAX_TASKS, int(most / (8 * side * side))))
    tiles = per_label.select("label", "dim", F.ceil(F.col("n") / side).alias("tiles"))
    meta = blocks.join(tiles, ["label", "dim"]).withColumn("tile", F.pmod(F.xxhash64("block"), F.col("tiles")))
    gap = F.sqrt(F.aggregate(F.zip_with("a.middle", "b.middle", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    can = gap <= F.col("a.reach") + F.col("b.reach") + F.lit(float(np.sqrt(2 - 2 * cosine)) + _EDGE)
    same_label = (F.col("a.label") == F.col("b.label")) & (F.col("a.dim") == F.col("b.dim"))
    pairs = meta.alias("a").join(meta.alias("b"), same_label & (F.col("a.block") <= F.col("b.block")) & can)
    at = [F.col("a.label").alias("label"), F.col("a.dim").alias("dim"), F.col("a.tile").alias("left"), F.col("b.tile").alias("right")]
    placed = pairs.select(*at, F.col("a.block").alias("block"), F.col("b.block").alias("other"))
    tile = ["label", "dim", "left", "right"]
    # With a number of tasks, as pairs are few bytes and much work.
    return placed.repartition(tasks, *tile).sortWithinPartitions(*tile, "block", "other").select("block", "other")


def _near(blocks: DataFrame, folder: str, cosine: float) -> DataFrame:
    """(cls, links, root) per class and pair of blocks in which it links; a class links with itself."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shelf = _Shelf(*file_system(folder))
        for batch in batches:
            for block, other in zip(batch["block"].tolist(), batch["other"].tolist()):
                (ta, va, ca, ma), (tb, vb, cb, mb) = shelf.get(block), shelf.get(other)
                links = dual(ta, va, tb, vb, cosine)
                same = block == other
                member = joined(links, same)
                count = links @ mb if same else np.concatenate([links @ mb, links.T @ ma])
                who = ca if same else np.concatenate([ca, cb])
                some = member >= 0
                yield pd.DataFrame({"cls": who[some], "links": count[some], "root": who[member[some]]})

    return _pairs(blocks, cosine).mapInPandas(walk, "cls long, links long, root long")


def link(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), "embedding", F.coalesce(usable, F.lit(False)).alias("usable"))
    keyed = rows.where("usable").withColumns({
        "dim": F.size("embedding"), "k1": F.xxhash64(F.lit(1), "embedding"), "k2": F.xxhash64(F.lit(2), "embedding"),
    })
    classes = _classes(keyed)
    blocks, folder = _blocks(classes)
    near, _ = cut_lineage(_near(blocks, folder, cosine), "near-vectors")
    drop_scratch(vectors.sparkSession, folder)
    counts = near.groupBy("cls").agg((F.sum("links") - 1).alias("n_links"))
    roots = components(near.where("cls <> root").select(F.col("cls").alias("u"), F.col("root").alias("v")))
    rooted = classes.select("cls", "label", "dim", "k1", "k2", "low").join(roots, F.col("cls") == F.col("node"), "left")
    rooted, _ = cut_lineage(rooted.select("cls", "label", "dim", "k1", "k2", "low", F.coalesce("root", "cls").alias("root")), "vector-roots")
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").join(counts, "cls").select("label", "dim", "k1", "k2", "n_links", "component_id")
    named, _ = cut_lineage(named, "vector-components")
    linked = keyed.select("vec_id", "label", "dim", "k1", "k2").join(named, ["label", "dim", "k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))

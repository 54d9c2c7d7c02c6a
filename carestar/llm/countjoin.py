"""Jaccard joins of word shingles through R-trees over counts of hashed groups.

The shingles of a text are hashed into groups; the counts by group are a point. Two texts share
at most the sum of the smaller counts of each group, and no point of an R-tree node shares more
with a query than the sum of the smaller of its counts and the node's largest. What that bound
lets through is compared exactly.

Points are dealt to trees by whole stretches of groups ("bands"). A pair that links differs in at
most d shingles, so of d + 1 bands at least one holds the same shingles in both: the pair meets
in the tree of that band, and no pair needs to be sought elsewhere.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestar.llm.common import column_lists, flag_likely, likely_in, per_batch, stored
from carestar.llm.components import components
from carestar.llm.dartminhash import mixed

GROUPS_PER_BAND = 4
LEAF = 16
FEW = 64
CHUNK = 2048
QUERIES = 1024
POINTS = 8192
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class Hashes(dict):
    """Word -> hash, for a bounded number of words."""

    def __missing__(self, word):
        if len(self) >= 1 << 16:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words between space, tab to carriage return."""
    return (text or "").encode().lower().split()


def shingle_set(words: list[bytes], hashes: Hashes, length: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; fewer words than ``length`` are one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    coded = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n, length = max(1, len(words) - length + 1), min(length, len(words))
    total = np.full(n, length, np.uint64)
    for k in range(length):
        total = (total + coded[k : k + n]) * _GOLDEN
        total ^= total >> np.uint64(29)
    return np.unique(mixed(total))


class Classes:
    """Size classes and what they need to find all pairs of a Jaccard similarity in percent.

    Class k holds sets of ``starts[k]`` shingles or more, up to the next start. Classes grow so
    fast that sets that link are of one class or of two neighbours; a set that may link with one
    of the next class has a point there too.
    """

    def __init__(self, percent: int):
        self.percent = percent
        # Smaller sets than the first start link with equal ones only.
        self.starts = [max(1, -(-percent // (100 - percent)))]
        self.growth = (100 / percent) ** 2

    def _start(self, k: int) -> int:
        while len(self.starts) <= k:
            last = self.starts[-1]
            self.starts.append(max(last + 2, int(np.ceil(last * self.growth)) + 1))
        return self.starts[k]

    def of(self, size: int) -> list[int]:
        """The classes in which a set of this size has points."""
        if size < self.starts[0]:
            return []
        while self._start(len(self.starts) - 1) <= size:
            self._start(len(self.starts))
        k = bisect.bisect_right(self.starts, size) - 1
        return [k, k + 1] if 100 * size // self.percent >= self._start(k + 1) else [k]

    def bands(self, k: int) -> int:
        """One more than the most shingles in which sets that meet in class k may differ."""
        return (100 - self.percent) * (self._start(k + 1) - 1) // self.percent + 1


def point_of(values: np.ndarray, k: int, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts by group, and for each band a key that equals for equal contents of the band."""
    group = (values % np.uint64(GROUPS_PER_BAND * bands)).astype(np.int64)
    counts = np.bincount(group, minlength=GROUPS_PER_BAND * bands)
    sums = np.zeros(bands, np.uint64)
    np.add.at(sums, group // GROUPS_PER_BAND, mixed(values ^ _GOLDEN))
    number = np.arange(bands, dtype=np.uint64) + np.uint64(k << 40)
    keys = mixed(sums + mixed(number)).view(np.int64)
    # A group holds some two shingles, so two bytes are ample.
    return np.minimum(counts, 0xFFFF).astype(np.uint16), keys


def may_link(own: int, others: np.ndarray, shared: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes that share no more than ``shared`` can be similar enough."""
    return 100 * shared >= percent * (own + others - shared)


class CountTree:
    """A packed R-tree over points: leaves of neighbours by size and counts, above them nodes of
    leaves, each with its largest counts and its range of sizes."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        # Tiles: slabs of like size, within a slab by the heavier half of the groups.
        half = counts[:, ::2].sum(axis=1, dtype=np.int64)
        slab = np.argsort(np.argsort(sizes, kind="stable"), kind="stable") // (LEAF * LEAF)
        self.order = np.lexsort((half, slab))
        self.counts, self.sizes = counts[self.order], sizes[self.order].astype(np.int64)
        self.leaves = self._cover(self.counts, self.sizes, self.sizes)
        self.nodes = self._cover(*self.leaves)

    @staticmethod
    def _cover(tops, least, most):
        at = np.arange(0, len(tops), LEAF)
        return np.maximum.reduceat(tops, at), np.minimum.reduceat(least, at), np.maximum.reduceat(most, at)

    @staticmethod
    def _under(above: np.ndarray, n: int) -> np.ndarray:
        below = (above[:, None] * LEAF + np.arange(LEAF)).ravel()
        return below[below < n]

    def search(self, point: np.ndarray, size: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the points that may link with a query, and the most that each shares."""
        held = np.arange(len(self.nodes[0]))
        for tops, least, most in (self.nodes, self.leaves):
            shared = np.minimum(tops[held], point).sum(axis=1, dtype=np.int64)
            shared = np.minimum(np.minimum(shared, most[held]), size)
            held = held[may_link(size, least[held], shared, percent)]
            held = self._under(held, len(self.leaves[0]) if tops is self.nodes[0] else len(self.counts))
        shared = np.minimum(self.counts[held], point).sum(axis=1, dtype=np.int64)
        good = may_link(size, self.sizes[held], shared, percent)
        return self.order[held[good]], shared[good]


def signed(docs: DataFrame, length: int, percent: int) -> DataFrame:
    """(id, node, n, keys, first_keys, classes, counts) of (id, text): n distinct shingles, node a
    digest of them; for each of its classes the counts as bytes, and all keys in a row, of which
    ``first_keys`` are of the first class."""
    schema = (
        "id long, node binary, n long, keys array<long>, first_keys long, classes array<long>, "
        "counts array<binary>"
    )

    def start():
        hashes, classes = Hashes(), Classes(percent)

        def work(batch):
            out = {k: [] for k in ("id", "node", "n", "keys", "first_keys", "classes", "counts")}
            for doc, text in zip(*column_lists(batch, "id", "text"), strict=True):
                values = shingle_set(words_of(text), hashes, length)
                own = classes.of(len(values))
                points = [point_of(values, k, classes.bands(k)) for k in own]
                out["id"].append(doc)
                out["node"].append(xxhash.xxh3_128_digest(values.tobytes()))
                out["n"].append(len(values))
                out["keys"].append(np.concatenate([keys for _, keys in points]) if points else [])
                out["first_keys"].append(len(points[0][1]) if points else 0)
                out["classes"].append(own)
                out["counts"].append([counts.tobytes() for counts, _ in points])
            return out

        return work

    return per_batch(docs, start, schema)


def searched(blocks: DataFrame, points: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Pairs (a, b) that may link, of a query and a point of one block but of two components.

    ``blocks`` has (block, class, query, node, component); ``points`` the counts by node and
    class. A task reads a block's queries, then its points, a tree of at most 2,048 at a time.
    With ``nearest`` each query names only the point that may be most similar, of each tree.
    """
    placed = blocks.join(points, ["node", "class"]).select("block", "query", "node", "component", "n", "counts")

    def run(batches):
        block, queries, held = None, [], []

        def found():
            pairs = []
            if queries and held:
                tree = CountTree(np.stack([p[3] for p in held]), np.array([p[2] for p in held]))
                for node, component, size, counts in queries:
                    at, shared = tree.search(counts, size, percent)
                    apart = [
                        (size + held[k][2] - s, k) for k, s in zip(at.tolist(), shared.tolist(), strict=True)
                        if held[k][1] != component
                    ]
                    if nearest and apart:
                        apart = [min(apart, key=lambda x: (x[0] / held[x[1]][2], x[1]))]
                    pairs += [(node, held[k][0]) for _, k in apart]
            held.clear()
            return pairs

        for batch in batches:
            pairs = []
            names = ("block", "query", "node", "component", "n", "counts")
            for key, query, node, component, n, counts in zip(*column_lists(batch, *names), strict=True):
                if key != block:
                    pairs += found()
                    block, queries = key, []
                point = (node, component, n, np.frombuffer(counts, np.uint16))
                if query:
                    queries.append(point)
                elif queries:
                    held.append(point)
                    if len(held) == CHUNK:
                        pairs += found()
            yield _pair_batch(pairs)
        yield _pair_batch(found())

    ordered = placed.repartition("block").sortWithinPartitions("block", F.desc("query"), "node")
    return ordered.mapInArrow(run, "a binary, b binary")


def _pair_batch(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    columns = [pa.array([pair[k] for pair in pairs], pa.binary()) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def verified(pairs: DataFrame, texts: DataFrame, length: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar enough.

    The pairs of one a are a block; those of an a with many are 32 blocks. A task holds the set
    of a and one b after the other, so a block may be of any size.
    """
    sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("rows"))
    often = stored(sizes.where(F.col("rows") > FEW).select("a"), "often")
    part = F.lit(0) if often.isEmpty() else F.when(F.col("o").isNotNull(), F.pmod(F.xxhash64("b"), F.lit(32))).otherwise(0)
    dealt = pairs.join(often.select("a", F.lit(True).alias("o")), "a", "left").withColumn("part", part.cast("int"))
    dealt = stored(dealt.select("a", "part", "b"), "dealt")
    heads = dealt.select("a", "part").distinct().select("a", "part", F.lit(True).alias("head"), F.col("a").alias("node"))
    rows = heads.unionByName(dealt.select("a", "part", F.lit(False).alias("head"), F.col("b").alias("node")))
    rows = rows.join(texts, "node").select("a", "part", "head", "node", "text")

    def run(batches):
        hashes, own, key = Hashes(), None, None
        for batch in batches:
            for piece in _pieces(batch):
                links = []
                for a, part, head, node, text in zip(*column_lists(piece, "a", "part", "head", "node", "text"), strict=True):
                    values = shingle_set(words_of(text), hashes, length)
                    if head:
                        own, key = values, (a, part)
                        continue
                    assert key == (a, part)
                    shared = len(np.intersect1d(own, values, assume_unique=True))
                    if 100 * shared >= percent * (len(own) + len(values) - shared):
                        links.append((a, node))
                yield _pair_batch(links)

    ordered = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.desc("head"), "node")
    return ordered.mapInArrow(run, "a binary, b binary")


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for low in range(0, batch.num_rows, 256):
        yield batch.slice(low, 256)


def _block(*parts: str) -> Column:
    return F.xxhash64(*parts)


def texts_of(taken: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(node, text) for the nodes of ``wanted`` (node, rep, rep_rows): the text of a row of the
    node's smallest id. Rows that repeat that id are told apart by their shingles."""

    @F.arrow_udf("binary")
    def node_of(texts: pa.Array) -> pa.Array:
        hashes = Hashes()
        sets = [shingle_set(words_of(t), hashes, length) for t in texts.to_pylist()]
        return pa.array([xxhash.xxh3_128_digest(v.tobytes()) for v in sets], pa.binary())

    def read(nodes):
        likely = likely_in(taken, F.col("id"), nodes, F.col("rep"))
        found = likely.join(nodes, F.col("id").eqNullSafe(F.col("rep"))).select("node", "text")
        return found.where(node_of("text") == F.col("node"))

    found = read(wanted.where("rep_rows = 1"))
    often = wanted.where("rep_rows is null or rep_rows > 1")
    if not often.isEmpty():
        found = found.unionAll(read(often).groupBy("node").agg(F.min("text").alias("text")))
    return stored(found, "texts")


def _facing_leaders(seats: DataFrame) -> DataFrame:
    """Blocks of a leader as query and the nodes that share a band with it as points. A band's
    leader is its node that meets most others in all its bands, so that the middle of a group
    of edited copies leads all its bands and faces each copy once."""
    met = seats.groupBy("node").agg(F.sum("n_seats").alias("met"))
    ranked = stored(seats.join(met, "node").select("key", "class", "node", "met"), "ranked")
    leaders = ranked.groupBy("key").agg(F.max(F.struct("met", "node")).alias("top"))
    leaders = leaders.select("key", F.col("top.node").alias("leader"))
    facing = stored(ranked.join(leaders, "key").where("node <> leader").select("class", "leader", "node"), "facing")
    facing = facing.distinct().withColumn("part", F.pmod(F.xxhash64("node"), F.lit(8)))
    block = _block("class", "leader", "part")
    points = facing.select(block.alias("block"), "class", F.lit(False).alias("query"), "node", F.col("node").alias("component"))
    heads = facing.select("class", "leader", "part").distinct()
    queries = heads.select(block.alias("block"), "class", F.lit(True).alias("query"), F.col("leader").alias("node"), F.col("leader").alias("component"))
    return points.unionByName(queries)


def _across(seats: DataFrame, labels: DataFrame | None, more_than: int = 0) -> DataFrame | None:
    """Blocks for the bands of over ``more_than`` nodes that are not yet of one component: nodes
    outside the band's largest component are queries, against all nodes of the band. None if
    there is no such band."""
    seats = seats.where(F.col("n_seats") > more_than)
    placed = seats if labels is None else seats.join(labels, "node", "left")
    component = F.col("node") if labels is None else F.coalesce("component", "node")
    placed = stored(placed.select("key", "class", "node", component.alias("component")), "placed")
    inside = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    most = inside.groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("most"),
        F.sum("n").alias("all"),
        (F.sum("n") - F.max("n")).alias("others"),
    )
    cuts, parts = F.ceil(F.col("others") / QUERIES), F.ceil(F.col("all") / POINTS)
    most = stored(most.where("others > 0").select("key", "most", cuts.alias("cuts"), parts.alias("parts")), "most")
    if most.isEmpty():
        return None
    open_bands = stored(placed.join(most, "key"), "open")
    other = F.col("component") != F.col("most")
    part, cut = F.pmod(F.xxhash64("node"), F.col("parts")), F.pmod(F.xxhash64("node", F.lit("cut")), F.col("cuts"))
    queries = open_bands.where(other).withColumn("cut", cut)
    queries = queries.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    points = open_bands.withColumn("part", part)
    points = points.withColumn("cut", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)))

    def rows(df, query):
        return df.select(_block("key", "cut", "part").alias("block"), "class", F.lit(query).alias("query"), "node", "component")

    return rows(points, False).unionByName(rows(queries, True))


def count_join(
    docs: DataFrame,
    percent: int = 90,
    length: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id.

    A text's set are its distinct shingles of ``length`` words (A-Z lower-cased, between space,
    tab to carriage return); fewer words are one shingle, no words the empty set, which links
    with nothing. Two texts link if 100 times the shingles they share is at least ``percent``
    times those of either. component_id is the smallest id that links reach.

    Equal sets collapse to a node first. The bands of a node deal its point to trees (see the
    module). Each tree first answers the band's leader; what the count bound lets through is
    compared exactly, which joins groups of copies without listing their pairs. Bands with nodes
    of several components are searched again. In those of over 64 nodes, each node outside the
    largest component first names the nearest point of another one. The last pass takes, in all
    such bands, all points of other components that the bound lets through. So every link that
    would join two components is compared, and no pair within one needs to be.

    A null text counts as empty. A null id is kept; alone it has no component_id. Repeated rows
    are answered each. An empty table gives no rows. Other columns are not read.
    """
    text = F.col(text_column)
    taken = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"))
    signs = signed(taken, length, percent).withColumn("row", F.monotonically_increasing_id())
    signs = stored(signs, "signs")
    full = signs.where("n > 0")
    narrow = full.groupBy("node", "id").agg(F.count(F.lit(1)).alias("rows"), F.min("row").alias("first"))
    narrow = narrow.groupBy("node").agg(
        F.min("id").alias("rep"),
        F.min_by("rows", "id").alias("rep_rows"),
        F.sum("rows").alias("copies"),
        F.min("first").alias("first"),
    )
    nodes = stored(narrow, "nodes")
    content = _first_rows(full, nodes)
    number = F.when(F.col("pos") < F.col("first_keys"), 0).otherwise(1)
    members = content.select("node", "first_keys", "classes", F.posexplode("keys").alias("pos", "key"))
    members = members.select("node", "key", F.get("classes", number).alias("class"))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("n_seats")).where("n_seats > 1")
    shared = stored(shared, "shared")
    likely = likely_in(members, F.col("key"), shared, F.col("key"))
    seats = stored(likely.join(shared, "key"), "seats")
    labels = None if seats.isEmpty() else _labels(taken, nodes, content, seats, length, percent)
    placed = nodes.select("node", "rep")
    if labels is None:
        placed = placed.withColumn("component", F.col("node"))
    else:
        placed = placed.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = stored(placed, "placed")
    least = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    least = stored(placed.join(least, "component").select("node", "component_id"), "least")
    own = signs.select("id", "node", "n")
    joined = own.where("n > 0").join(least, "node").select("id", "n", "component_id")
    alone = own.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return joined.unionByName(alone).select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), "component_id")


def _first_rows(full: DataFrame, nodes: DataFrame) -> DataFrame:
    """Of the rows of each node one. The other rows, of copies, are left out by their numbers, so
    that the wide rows need not come together by node."""
    many = nodes.where("copies > 1").select("node", "first")
    copies = full.select("node", "row").join(many, "node").where("row <> first").select("row")
    copies = stored(copies, "copies")
    if copies.isEmpty():
        return full
    flagged = flag_likely(full, F.col("row"), copies, F.col("row"), "likely")
    sure, maybe = flagged.where("not likely"), flagged.where("likely")
    return sure.unionByName(maybe.join(copies, "row", "left_anti")).drop("likely")


def _labels(taken, nodes, content, seats, length, percent) -> DataFrame | None:
    """(node, component) for the nodes that have links."""
    at = F.explode(F.arrays_zip("classes", "counts")).alias("at")
    wanted = nodes.join(seats.select("node").distinct(), "node")
    wanted = content.select("node", "n", "classes", "counts").join(wanted, "node")
    wanted = stored(wanted.select("node", "rep", "rep_rows", "n", "classes", "counts"), "wanted")
    points = wanted.select("node", "n", at)
    points = points.select("node", F.col("at.classes").alias("class"), "n", F.col("at.counts").alias("counts"))
    texts = links = labels = None
    for step in ("leaders", "nearest", "all"):
        if step == "leaders":
            blocks = _facing_leaders(seats)
        else:
            # Few nodes have few pairs, so small bands go straight to the last pass.
            blocks = _across(seats, labels, FEW if step == "nearest" else 0)
        if blocks is None:
            continue
        pairs = searched(blocks, points, percent, step == "nearest").distinct()
        pairs = stored(pairs, "pairs")
        if texts is None:
            texts = texts_of(taken, wanted.select("node", "rep", "rep_rows"), length)
        found = stored(verified(pairs, texts, length, percent), "links")
        links = found if links is None else links.unionAll(found)
        labels = components(links)
    return labels

"""Near duplicates: DartMinHash bands, exact comparison around bucket leaders, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestar.llm.common import column_lists, flag_likely, free_names, likely_in, per_batch, stored, stored_and_any
from carestar.llm.components import components
from carestar.llm.dartminhash import DartSignature, WordHashes, shingles

SIMILARITY = 0.8
BLOCK = 128
COLUMNS = 1 << 14


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _node(words: list[str]) -> bytes:
    """Texts with the same words in a row are one node."""
    return xxhash.xxh3_128_digest(" ".join(words))


def signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(id, mark, node, keys) of (id, mark, text): one key for each band, none for a text
    without words."""

    def start():
        hashes, darts = WordHashes(), DartSignature(bands, rows)

        def work(batch):
            ids, marks, texts = column_lists(batch, "id", "mark", "text")
            nodes, full, sets = [], [], []
            for i, text in enumerate(texts):
                words = words_of(text)
                nodes.append(_node(words))
                if words:
                    full.append(i)
                    sets.append(shingles(words, hashes))
            keys: list = [[]] * len(texts)
            for i, row in zip(full, darts.band_keys(sets) if sets else [], strict=True):
                keys[i] = row
            return {"id": ids, "mark": marks, "node": nodes, "keys": keys}

        return work

    return per_batch(docs, start, "id long, mark long, node binary, keys array<long>")


def links_in_block(nodes: list[bytes], sets: list[tuple], similarity: float) -> list[tuple[bytes, bytes]]:
    """Links that join what any links between the members of a block join.

    All pairs are compared exactly, by products of the matrix of members and shingles (a count
    of c is c columns), some columns at a time; of the links found, a spanning forest is given.
    """
    marks = [
        np.repeat(values, counts) + np.uint64(0x9E3779B97F4A7C15) * _nth(counts).astype(np.uint64)
        for values, counts in sets
    ]
    sizes = np.array([len(m) for m in marks], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    column = np.unique(np.concatenate(marks), return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)))
    width = min(COLUMNS, int(column[-1]) + 1 if len(column) else 1)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        part = slice(*np.searchsorted(column, (low, low + width)))
        matrix = np.zeros((len(sets), width), np.float32)
        matrix[owner[part], column[part] - low] = 1
        common += matrix @ matrix.T
    union = sizes[:, None] + sizes[None, :] - common
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for i, j in np.argwhere(np.triu(common >= similarity * union - 1e-9, 1)).tolist():
        a, b = find(i), find(j)
        if a != b:
            root[b] = a
            links.append((nodes[i], nodes[j]))
    return links


def _nth(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... for each count in a row."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def compared(members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) within the blocks of ``members`` (block, node). A block is small by its
    making; its rows come together by a sort, and a task holds one block at a time."""
    rows = members.join(texts, "node").select("block", "node", "text")

    def run(batches):
        hashes, block, nodes, sets = WordHashes(), None, [], []
        for batch in batches:
            found = []
            for key, node, text in zip(*column_lists(batch, "block", "node", "text"), strict=True):
                if key != block:
                    found += links_in_block(nodes, sets, similarity) if len(nodes) > 1 else []
                    block, nodes, sets = key, [], []
                nodes.append(node)
                sets.append(shingles(words_of(text), hashes))
            yield _link_batch(found)
        yield _link_batch(links_in_block(nodes, sets, similarity) if len(nodes) > 1 else [])

    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(run, "a binary, b binary")


def _link_batch(links: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    columns = [pa.array([link[k] for link in links], pa.binary()) for k in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _block(*parts) -> Column:
    return F.concat_ws("/", *(F.hex(p) if p == "leader" else F.col(p).cast("string") for p in parts))


def _facing(buckets: DataFrame) -> DataFrame:
    """(leader, node, part, parts): every member of a bucket faces its leader, and the members
    that face one leader are dealt into parts of about BLOCK nodes. The leader of a bucket is its
    member that meets most others in all its buckets, so the middle of a group of edited copies
    leads it everywhere."""
    met = buckets.groupBy("node").agg(F.sum("n").alias("met"))
    leaders = buckets.join(met, "node").groupBy("key").agg(F.max(F.struct("met", "node")).alias("l"))
    pairs = buckets.join(leaders.select("key", F.col("l.node").alias("leader")), "key")
    pairs = stored(pairs.select("leader", "node").distinct(), "facing")
    sizes = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    return pairs.join(sizes, "leader").withColumn("part", part)


def _links(buckets: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links that join what all links between members of one bucket join, as (a, b).

    First, each part is compared within itself and with its leader. Where a leader has several
    parts, members of its largest component are joined already; the others are dealt into parts
    of their own, each of which is compared with every part of that leader's members.
    """
    facing, several = stored_and_any(_facing(buckets), "facing", F.col("parts") > 1)
    with_leader = facing.select("leader", "part", F.col("leader").alias("node")).distinct()
    first = facing.select("leader", "part", "node").where("node <> leader").unionAll(with_leader)
    links = stored(compared(first.select(_block("leader", "part").alias("block"), "node"), texts, similarity), "links")
    if not several:
        return links
    labels = components(links)
    placed = facing.where("parts > 1").join(labels, "node", "left")
    placed = stored(placed.withColumn("component", F.coalesce("component", "node")), "placed")
    inside = placed.groupBy("leader", "component").agg(F.count(F.lit(1)).alias("n"))
    most = inside.groupBy("leader").agg(
        F.max_by("component", F.struct("n", "component")).alias("most"), (F.sum("n") - F.max("n")).alias("others")
    )
    most = most.where("others > 0").withColumn("cuts", F.ceil(F.col("others") / BLOCK)).select("leader", "most", "cuts")
    placed = placed.join(most, "leader")
    cut = F.pmod(F.xxhash64("node", F.lit("cut")), F.col("cuts"))
    others = placed.where("component <> most").withColumn("cut", cut)
    parts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    cuts = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut")
    rows = others.select("leader", "cut", "node", parts).unionByName(placed.select("leader", "part", "node", cuts))
    rows = rows.select(_block("leader", "cut", "part").alias("block"), "node").distinct()
    # The labels join what the links so far join, with fewer rounds to the component.
    joined = labels.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return joined.unionAll(stored(compared(rows, texts, similarity), "links"))


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    bands: int = 32,
    rows: int = 5,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: id, class_id, class_size.

    A class is a connected component of links; a link is a weighted Jaccard similarity of at
    least ``similarity`` of five-word shingles with their counts, over lower-cased words split
    at white space. class_id is the smallest id of the class, class_size its number of rows.

    Texts with equal words collapse to a node first. Each node throws darts for bands * rows
    coordinates; nodes with an equal band meet in a bucket (at 0.8 and 32 bands of 5, a pair
    meets nowhere with a probability of 3e-6). Members of a bucket face its leader; the members
    that face a leader are compared exactly, in blocks of bounded size, as ``_links`` says. No
    pair of a bucket is left out, and pairs are compared in numpy, never listed as rows.

    A null text counts as empty; texts without words are one class. A null id is kept and gives
    no class_id unless the class has another id. Repeated rows are of one class. An empty table
    gives no rows. Other columns are not read.
    """
    classed = _classed(docs, similarity, bands, rows, id_column, text_column)
    return classed.select(F.col("id").alias(id_column), "class_id", "class_size")


def _classed(docs, similarity, bands, rows, id_column, text_column) -> DataFrame:
    """(id, mark, component, class_id, class_size); mark is a hash of the text as it is."""
    text = F.col(text_column)
    taken = docs.select(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    signs = stored(signed(taken, bands, rows), "signs")
    rows_of = signs.groupBy("node", "id").agg(
        F.count(F.lit(1)).alias("rows"), F.any_value("keys").alias("keys")
    )
    nodes = rows_of.groupBy("node").agg(
        F.min("id").alias("rep"),
        F.min_by("rows", "id").alias("rep_rows"),
        F.sum("rows").alias("copies"),
        F.any_value("keys").alias("keys"),
    )
    nodes = stored(nodes, "nodes")
    members = nodes.select(F.explode("keys").alias("key"), "node")
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(shared, "shared")
    likely = likely_in(members, F.col("key"), shared, F.col("key"))
    buckets, any_shared = stored_and_any(likely.join(shared, "key"), "buckets")
    labels = None
    if any_shared:
        labels = components(_links(buckets, _texts_of(taken, nodes, buckets), similarity))
    placed = nodes.select("node", "rep", "copies")
    if labels is None:
        placed = placed.withColumn("component", F.col("node"))
    else:
        placed = placed.join(labels, "node", "left")
        placed = placed.withColumn("component", F.coalesce("component", "node"))
    sums = placed.groupBy("component").agg(
        F.min("rep").alias("class_id"), F.sum("copies").alias("class_size")
    )
    classes = placed.select("node", "component").join(sums, "component")
    joined = signs.select("id", "mark", "node").join(classes, "node")
    return joined.select("id", "mark", "component", "class_id", "class_size")


def _texts_of(taken: DataFrame, nodes: DataFrame, buckets: DataFrame) -> DataFrame:
    """(node, text) for the nodes that share a bucket, read from the row of each one's
    smallest id; rows that repeat that id are told apart by their words."""
    wanted = nodes.join(buckets.select("node").distinct(), "node").select("node", "rep", "rep_rows")
    wanted, any_often = stored_and_any(wanted, "wanted", F.col("rep_rows").isNull() | (F.col("rep_rows") > 1))

    @F.arrow_udf("binary")
    def node_of(texts: pa.Array) -> pa.Array:
        return pa.array([_node(words_of(t)) for t in texts.to_pylist()], pa.binary())

    def read(nodes):
        likely = likely_in(taken, F.col("id"), nodes, F.col("rep"))
        found = likely.join(nodes, F.col("id").eqNullSafe(F.col("rep"))).select("node", "text")
        return found.where(node_of("text") == F.col("node"))

    found = read(wanted.where("rep_rows = 1"))
    if any_often:
        often = wanted.where("rep_rows is null or rep_rows > 1")
        found = found.unionAll(read(often).groupBy("node").agg(F.min("text").alias("text")))
    return stored(found, "texts")


def one_of_each(
    docs: DataFrame, similarity: float = SIMILARITY, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class one row of the smallest id.

    All columns stay as they are. A class without any id keeps one row. Of rows of a class that
    share the kept id, those of one text stay, and of rows that repeat it one. Columns may have
    any names, dots and those of this library's own columns among them.
    """
    classed = stored(_classed(docs, similarity, 32, 5, id_column, text_column), "classed")
    same_text = classed.groupBy("component", "id", "mark").agg(F.count(F.lit(1)).alias("rows"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark", "rows")).alias("first")
    firsts = same_text.groupBy(F.col("component").alias("of")).agg(first)
    of_id, of_mark, stays, likely = free_names(docs, "__id", "__mark", "__stays", "__likely")
    firsts = firsts.select(
        "of", F.col("first.id").alias(of_id), F.col("first.mark").alias(of_mark), F.col("first.rows").alias("first_rows")
    )
    # The key is the row, not its class, so that a large class is not one task's work.
    is_first = (
        (F.col("component") == F.col("of")) & F.col("id").eqNullSafe(F.col(of_id)) & (F.col("mark") == F.col(of_mark))
    )
    gone = same_text.join(firsts, is_first, "left_anti")
    gone = gone.select(F.col("id").alias(of_id), F.col("mark").alias(of_mark), F.lit(False).alias(stays))
    repeats = firsts.where("first_rows > 1").select(of_id, of_mark, F.lit(True).alias(stays))
    # Rows that go, and rows of which one stays: few. All others stay without a look-up.
    doubtful, any_repeated = stored_and_any(gone.unionAll(repeats), "doubtful", F.col(stays))
    of, text = F.col(f"`{id_column}`").cast("long"), F.col(f"`{text_column}`")
    flagged = flag_likely(docs, F.struct(of, F.xxhash64(text)), doubtful, F.struct(of_id, of_mark), likely)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    sure = flagged.where(~F.col(likely)).select(*columns)
    maybe = flagged.where(F.col(likely)).select(*columns)
    same = of.eqNullSafe(F.col(of_id)) & (F.xxhash64(text) == F.col(of_mark))
    kept = sure.unionAll(maybe.join(doubtful, same, "left_anti"))
    if not any_repeated:
        return kept
    often = maybe.join(doubtful.where(F.col(stays)), same, "left_semi")
    return kept.unionAll(often.dropDuplicates([id_column, text_column]))

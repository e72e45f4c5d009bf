"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its 2-word shingles. Documents with equal sets form a class; classes go on as one. Every class has ``COORDINATES``
min-hash values. A tree starts with all classes in its root. A node chooses ``BRANCHES`` coordinates and hands its members
on to one child for each value there: sets of similarity s stay together with probability s for each choice, so a pair at the threshold of 0.8
survives at least one path of a tree with probability 0.93 at any depth, and unrelated sets part at once. Nodes of at most ``LEAF`` members
are compared exhaustively. ``TREES`` trees choose their coordinates by seeds of their own, but from the same values of a class; tests
measure what is found. A large node compares its members with ``PIVOTS`` of them. If these cover half of the members the node holds
similar sets, which branching would keep together: it ends there, and so does one at the last level.

What the trees find are clusters: classes connected by pairs that agree on ``PROPOSE`` values (see there). The members of a node that ended are compared
by their values in blocks of ``SKETCH_BLOCK``. The pivots near a member connect it already: the smallest of them in all nodes of a level is its label, and
what has equal labels is connected and needs no further edge. So each member tells one edge to its label at a level, whatever the number of nodes that hold
its group, and a node tells edges between labels only. All members meet those of their own block; of a node of many blocks, those whose label is not
the node's most frequent one visit the other blocks too. Besides, each member's best pair is told, that with a pivot or a better one of its block.
Components are made of the edges between labels alone. Then sets meet in tasks, which return forests of the links that they confirm:

- a cluster of at most ``BLOCK`` classes is compared exhaustively by one task, all pairs of sets by matrix products;
- of a larger one, each class first confirms its best pair. Classes that are not connected to the cluster's largest component by then
  visit its blocks, of about ``BLOCK`` classes each, and are compared with all of them. Its pairs are never rows, but a cluster
  of m classes most of which are no links, only near to it, still sends up to m / ``BLOCK`` copies of a class.

Defined results: a text without words (null, empty, blank) has an empty set and is linked with nothing. A document without doc_id is
linked with nothing, its component_id is null, and it is kept. Rows that repeat a doc_id are judged by their own texts; all rows of a kept id and
text are kept. Of tied representatives the smallest doc_id stays. Extra columns are ignored by ``near_report`` and kept by ``keep_first``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_map, batch_of, mix, row_key, small_batches, words, write_aside
from .components import connected_components

SIMILAR_PERCENT = 80
SHINGLE_WORDS = 2
COORDINATES = 128
TREES = 6
BRANCHES = 2
LEAF = 32
DEPTH = 5
PIVOTS = 8
#: Equal min-hash values out of COORDINATES that make a proposal. A pair at the threshold has 102 on average; 9 pairs in a million have fewer than 82.
PROPOSE = 82
#: Equal values by which a pivot covers a member, and the covered share that ends a node.
COVER, COVERED = 90, 0.5
#: Classes whose sets a task holds at a time to compare all of them, and shingles in one matrix product.
BLOCK, PRODUCT = 512, 4096
#: The same for sketches.
SKETCH_BLOCK = 2048
#: Bits for each class of a cluster in the bitmap by which other documents are left out before texts move: one in 16 of them still moves.
WANTED_BITS = 16
CACHED_WORDS = 200_000

_ODD = mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_STEP = np.uint64(0xD6E8FEB86659FD93)


class Shingles:
    """The sorted distinct 64-bit hashes of a text's shingles of lower-cased words."""

    def __init__(self, size: int = SHINGLE_WORDS) -> None:
        self.size = size
        self.hashes: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        found = [] if not text else words(text)
        known = self.hashes
        if len(known) > CACHED_WORDS:
            known.clear()
        for word in set(found):
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word.lower())
        hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        size = min(self.size, len(hashes))
        if not size:
            return hashes
        rolled = np.full(len(hashes) - size + 1, size, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(size):
                rolled = mix(rolled * _STEP + hashes[k : len(hashes) - size + 1 + k])
        return np.unique(rolled)


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for part in range(0, len(shingles), 2048):
            least = np.minimum(least, (shingles[part : part + 2048, None] * _ODD).min(axis=0))
    return mix(least).astype(np.uint32)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _profile_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingle = Shingles()
    for batch in batches:
        sets = [shingle(text) for text in batch.column("text").to_pylist()]
        there = np.array([len(s) > 0 for s in sets], bool)
        sigs = np.array([signature(s) for s in sets if len(s)], np.uint32).reshape(-1, COORDINATES)
        roots = np.stack([node for tree in range(TREES) for node in children(np.full(len(sigs), tree, np.int64), sigs)], axis=1)
        spread = lambda rows: pa.array([next(rows) if t else None for t in there])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("row"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                spread(iter(roots)).cast(pa.list_(pa.int64())), spread(iter([s.astype(np.uint8).tobytes() for s in sigs])).cast(pa.binary()),
            ],
            names=["doc_id", "row", "n_shingles", "set_key", "roots", "sketch"],
        )


def profiles(docs: DataFrame) -> DataFrame:
    texts = docs.select("doc_id", "text", row_key(F.col("text")).alias("row"))
    return arrow_map(texts, _profile_task, "doc_id long, row long, n_shingles long, set_key binary, roots array<long>, sketch binary")


# -- trees -----------------------------------------------------------------------------------------


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDINATES)


def children(nodes: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    """A member's children: two different coordinates that depend on the node alone, and the member's values there."""
    with np.errstate(over="ignore"):
        seed = mix(nodes.astype(np.uint64) + _STEP)
        first = seed % np.uint64(COORDINATES)
        second = (first + np.uint64(1) + (seed >> np.uint64(32)) % np.uint64(COORDINATES - 1)) % np.uint64(COORDINATES)
        rows = np.arange(len(values))
        return [
            mix(seed * _STEP + (chosen << np.uint64(32)) + values[rows, chosen.astype(np.int64)]).view(np.int64)
            for chosen in (first, second)
        ]


BRANCH = pa.schema([
    ("node", pa.int64()), ("cls", pa.int64()), ("covered", pa.bool_()), ("left", pa.int64()), ("right", pa.int64()),
    ("least", pa.int64()), ("best", pa.int64()), ("equal", pa.int32()), ("also", pa.list_(pa.int64())),
])
BRANCH_DDL = "node long, cls long, covered boolean, left long, right long, least long, best long, equal int, also array<long>"
EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("equal", pa.int32())])
EDGES_DDL = "a long, b long, equal int"


def _sizes_allow(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sets whose sizes differ too much cannot be similar enough, whatever they share."""
    return 100 * np.minimum(a, b) >= SIMILAR_PERCENT * np.maximum(a, b)


def _branch_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of large nodes: the smallest and the best of the pivots that are near, whether one covers the member, and the member's children. What else
    is near is told for the first member only that connects it with that smallest one."""
    told: set[tuple[int, int]] = set()
    for batch in batches:
        if not batch.num_rows:
            continue
        if len(told) > CACHED_WORDS:
            told.clear()
        values, nodes, cls = _bytes(batch.column("sketch")), batch.column("node").to_numpy(), batch.column("cls").to_numpy()
        covered, least, best, most, also = [], [], [], [], []
        columns = (cls, values, batch.column("n_shingles").to_pylist(), batch.column("pivots").to_pylist())
        for own, mine, size, pivots in zip(*columns, strict=True):
            others = [p for p in pivots if p["b"] != own]
            table = np.frombuffer(b"".join(p["sketch"] for p in others), np.uint8).reshape(-1, COORDINATES)
            equal = (table == mine).sum(axis=1)
            good = (equal >= PROPOSE) & _sizes_allow(np.array([p["n_shingles"] for p in others], np.int64), np.int64(size))
            covered.append(bool((equal >= COVER).any()))
            near = [(-int(equal[k]), others[k]["b"]) for k in np.flatnonzero(good)]
            first = min((b for _, b in near), default=None)
            new = {(first, b) for _, b in near if b != first} - told
            told |= new
            least.append(first)
            best.append(min(near)[1] if near else None)
            most.append(-min(near)[0] if near else None)
            also.append([b for _, b in new])
        left, right = children(nodes, values)
        yield batch_of(BRANCH, node=nodes, cls=cls, covered=covered, left=left, right=right, least=least, best=best, equal=most, also=also)


def _labels(branched: DataFrame) -> DataFrame:
    """(cls, label, pivot, least, best, equal) of the members of a level that have near pivots: the smallest of these is ``pivot``, and ``label`` is its own
    pivot if that is smaller, as groups have more pivots than one member is near to. ``least`` are the smallest ones by node."""
    near = branched.filter("least IS NOT NULL").groupBy("cls").agg(
        F.min("least").alias("pivot"), F.collect_set("least").alias("least"), F.max_by("best", F.struct("equal", "best")).alias("best"), F.max("equal").alias("equal")
    ).withColumn("pivot", F.least("cls", "pivot"))
    up = near.select(F.col("cls").alias("pivot"), F.col("pivot").alias("label"))
    return near.join(up, "pivot", "left").withColumn("label", F.coalesce("label", "pivot"))


def _label_edges(branched: DataFrame, labels: DataFrame) -> DataFrame:
    """What near pivots connect: members and pivots with the smallest one, and each member's best pair."""
    ends = lambda b: (F.least("a", b).alias("a"), F.greatest("a", b).alias("b"))
    own = labels.select("cls", F.col("pivot").alias("a"), F.explode(F.array_union(F.array("cls"), "least")).alias("b"))
    pivots = branched.select(F.col("least").alias("a"), F.explode("also").alias("b"))
    stars = own.select("a", "b").union(pivots).filter("a <> b").select(*ends("b")).distinct().withColumn("equal", F.lit(0))
    return stars.union(labels.select(F.col("cls").alias("a"), "best", "equal").select(*ends("best"), "equal"))


def _together(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of ``count`` places that each can reach by the pairs (a, b)."""
    least = np.arange(count)
    while True:
        before = least.copy()
        np.minimum.at(least, a, least[b])
        np.minimum.at(least, b, least[a])
        least = least[least]
        if (least == before).all():
            return least


def _leaf_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges within small nodes. Rows come sorted by node; a node is at most LEAF rows long."""
    nodes, cls, sizes, values = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, COORDINATES), np.uint8)
    for batch in batches:
        if not batch.num_rows:
            continue
        # The last rows stay for the next batch, whose first node may have begun in them.
        nodes = np.concatenate([nodes[-LEAF:], batch.column("node").to_numpy()])
        cls = np.concatenate([cls[-LEAF:], batch.column("cls").to_numpy()])
        sizes = np.concatenate([sizes[-LEAF:], batch.column("n_shingles").to_numpy()])
        values = np.concatenate([values[-LEAF:], _bytes(batch.column("sketch"))])
        old = len(nodes) - batch.num_rows
        found = []
        for step in range(1, LEAF):
            later = np.arange(max(old, step), len(nodes))
            later = later[nodes[later] == nodes[later - step]]
            if not len(later):
                break
            equal = (values[later] == values[later - step]).sum(axis=1)
            good = (equal >= PROPOSE) & _sizes_allow(sizes[later], sizes[later - step])
            found.append(np.stack([later[good], later[good] - step, equal[good]]))
        a, b, equal = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
        if len(a):
            yield _forest(cls, cls, np.zeros(len(cls), np.int64), a, b, equal)


def _forest(cls: np.ndarray, label: np.ndarray, known: np.ndarray, a: np.ndarray, b: np.ndarray, equal: np.ndarray) -> pa.RecordBatch:
    """Edges that connect what the pairs (a, b) of places connect: one to the smallest label that a label is connected with. Besides, each member's best
    pair if it is better than the one known."""
    ends, partners, equals = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([equal, equal])
    better = equals > known[ends]
    ends, partners, equals = cls[ends[better]], cls[partners[better]], equals[better]
    order = np.lexsort((partners, -equals, ends))
    best = order[np.unique(ends[order], return_index=True)[1]]
    names, place = np.unique(label, return_inverse=True)
    least = _together(len(names), place[a], place[b])
    apart = np.flatnonzero(least != np.arange(len(names)))
    x, y = np.concatenate([ends[best], names[apart]]), np.concatenate([partners[best], names[least[apart]]])
    weights = np.concatenate([equals[best], np.zeros(len(apart), np.int64)])
    return batch_of(EDGES, a=np.minimum(x, y), b=np.maximum(x, y), equal=weights.astype(np.int32))


def _ended_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges between the members of a block of a node, and between these and visitors with other labels. Rows come sorted by node and block, residents
    before visitors."""
    place: tuple[int, int] | None = None
    residents: list[tuple[int, int, int, int, bytes]] = []
    visitors: list[tuple[int, int, int, int, bytes]] = []

    def compared(visiting: bool) -> Iterator[pa.RecordBatch]:
        members = residents + visitors if visiting else residents
        if len(members) < 2 or visiting and not (residents and visitors):
            visitors.clear()
            return
        cls, label, known, sizes = (np.array([m[k] for m in members], np.int64) for k in range(4))
        values = np.frombuffer(b"".join(m[4] for m in members), np.uint8).reshape(-1, COORDINATES)
        if visiting:  # a member has its best pair from its own block
            known[:] = COORDINATES
        found = []
        for one in range(len(residents) if visiting else 0, len(members)):
            others = np.arange(len(residents) if visiting else one)
            allowed = _sizes_allow(sizes[others], sizes[one])
            others = others[allowed & (label[others] != label[one]) if visiting else allowed]
            equal = (values[others] == values[one]).sum(axis=1)
            good = equal >= PROPOSE
            found.append(np.stack([np.full(int(good.sum()), one), others[good], equal[good]]))
        visitors.clear()
        a, b, equal = np.concatenate(found, axis=1)
        if len(a):
            yield _forest(cls, label, known, a, b, equal)

    columns = ("node", "block", "visiting", "cls", "label", "known", "n_shingles", "sketch")
    met = False
    for batch in batches:
        for node, block, visiting, *member in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            if (node, block) != place or visiting and not met:
                yield from compared(met)
                met = visiting
            if (node, block) != place:
                place = (node, block)
                residents, visitors = [], []
            (visitors if visiting else residents).append(tuple(member))
            if len(visitors) >= SKETCH_BLOCK:
                yield from compared(True)
    yield from compared(met)


def _ended_edges(ended: DataFrame) -> DataFrame:
    """Edges between the members (node, size, cls, label, known, n_shingles, sketch) of nodes that ended, compared by their sketches in tasks. A member of the
    label that most of its node have stays in its block, as it is connected with the others of this label; the rest visit every block."""
    blocks = F.ceil(F.col("size") / SKETCH_BLOCK).cast("int")
    kept = ["node", "block", "visiting", "cls", "label", "known", "n_shingles", "sketch"]
    own = ended.withColumns({"block": F.pmod(F.xxhash64("cls"), blocks).cast("int"), "visiting": F.lit(False)})
    large = own.filter(F.col("size") > SKETCH_BLOCK)
    main = large.groupBy("node", "label").count().groupBy("node").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
    away = large.join(main, "node").filter("label <> main").withColumns({
        "block": F.explode(F.array_remove(F.sequence(F.lit(0), blocks - 1), F.col("block"))), "visiting": F.lit(True),
    })
    met = own.select(*kept).union(away.select(*kept))
    return arrow_map(met.repartition("node", "block").sortWithinPartitions("node", "block", "visiting", "cls"), _ended_task, EDGES_DDL)


def find_edges(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b, equal): the edges that connect the clusters have an ``equal`` of 0; the others are pairs to confirm, which connect nothing more."""
    sketches = classes.select("cls", "n_shingles", "sketch")
    edges: list[DataFrame] = []
    frontier = classes.select(F.explode("roots").alias("node"), "cls")
    for level in range(1, DEPTH + 1):
        sizes = scratch.keep(frontier.groupBy("node").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
        members = scratch.keep(frontier.join(sizes, "node"), "members")
        small = members.filter(F.col("size") <= LEAF).select("node", "cls").join(sketches, "cls")
        ordered = small.repartition("node").sortWithinPartitions("node")
        edges.append(scratch.keep(arrow_map(ordered, _leaf_task, EDGES_DDL), "edges"))
        large = members.filter(F.col("size") > LEAF).select("node", "cls")
        if large.isEmpty():
            break
        # A pivot is the member whose id, scrambled by the node and its own constant, is smallest.
        keys = [F.col("node").bitwiseXOR(F.lit(int(mix(np.array([k], np.uint64)).view(np.int64)[0]))) for k in range(1, PIVOTS + 1)]
        least = large.groupBy("node").agg(*(F.min(F.col("cls").bitwiseXOR(key)).alias(f"p{k}") for k, key in enumerate(keys)))
        found = F.array_distinct(F.array(*(F.col(f"p{k}").bitwiseXOR(key) for k, key in enumerate(keys))))
        pivots = least.select("node", F.explode(found).alias("b"))
        pivots = pivots.join(sketches.withColumnRenamed("cls", "b"), "b")
        pivots = pivots.groupBy("node").agg(F.collect_list(F.struct("b", "n_shingles", "sketch")).alias("pivots"))
        branched = scratch.keep(arrow_map(large.join(sketches, "cls").join(pivots, "node"), _branch_task, BRANCH_DDL), "branches")
        cover = branched.groupBy("node").agg((F.avg(F.col("covered").cast("int")) >= COVERED).alias("dense"))
        told = scratch.keep(branched.select("node", "cls", "left", "right").join(cover.withColumn("dense", F.lit(level == DEPTH) | F.col("dense")), "node"), "told")
        labels = scratch.keep(_labels(branched), "labels")
        edges.append(scratch.keep(_label_edges(branched, labels), "edges"))
        ended = told.filter("dense").select("node", "cls").join(sizes.filter(F.col("size") > LEAF), "node").join(sketches, "cls")
        ended = ended.join(labels.select("cls", "label", F.col("equal").alias("known")), "cls", "left")
        ended = ended.withColumns({"label": F.coalesce("label", "cls"), "known": F.coalesce("known", F.lit(0))})
        edges.append(scratch.keep(_ended_edges(ended), "edges"))
        frontier = told.filter("NOT dense").select(F.explode(F.array("left", "right")).alias("node"), "cls")
    return scratch.keep(reduce(DataFrame.union, edges).distinct(), "edges")


# -- confirmation ----------------------------------------------------------------------------------


def _set_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingle = Shingles()
    for batch in batches:
        kept, sets = [], []
        for cls, key, text in zip(*(batch.column(c).to_pylist() for c in ("cls", "set_key", "text")), strict=True):
            found = shingle(text)
            if len(found) and _digest(found) == key:  # two texts can share a row's key
                kept.append(cls)
                sets.append(found.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(kept, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["cls", "shingles"]
        )


def wanted_rows(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` without most of those whose keys are not in ``wanted``, so that these are not shuffled. What goes to every task is a bitmap of
    ``WANTED_BITS`` bits for each wanted row, in parts of 32,768 bits."""
    parts = wanted.count() * WANTED_BITS // 32768 + 1
    number = F.xxhash64(*keys, F.lit("wanted"))
    part, bit = F.pmod(number, F.lit(parts)), F.pmod(F.shiftright(number, 24), F.lit(32768))
    bitmaps = wanted.groupBy(part.alias("__part")).agg(F.bitmap_construct_agg(bit).alias("__bitmap"))
    byte = F.conv(F.hex(F.substring("__bitmap", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    there = F.call_function("getbit", byte, F.pmod(bit, F.lit(8)).cast("int")) == 1
    return rows.join(F.broadcast(bitmaps), (part == F.col("__part")) & there, "left_semi")


def with_texts(docs: DataFrame, members: DataFrame) -> DataFrame:
    """The members of a table of classes (cls, set_key, least_doc, least_row, ...) with one text each."""
    texts = docs.select(F.col("doc_id").alias("least_doc"), row_key(F.col("text")).alias("least_row"), "text")
    texts = wanted_rows(texts, members, ["least_doc", "least_row"])
    return members.join(texts, ["least_doc", "least_row"]).dropDuplicates(["least_doc", "least_row", "cls"])


def confirm(texts: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs whose full sets are similar enough. ``texts`` are (cls, set_key, text)."""
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    sets = scratch.keep(arrow_map(texts.join(wanted, "cls", "left_semi"), _set_task, "cls long, shingles array<long>"), "sets")
    both = (
        pairs.select("a", "b")
        .join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("left")), "a")
        .join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("right")), "b")
    )
    common = both.select("a", "b", (F.size("left") + F.size("right")).alias("total"), F.size(F.array_intersect("left", "right")).alias("common"))
    return common.filter(100 * F.col("common") >= SIMILAR_PERCENT * (F.col("total") - F.col("common"))).select("a", "b")


def similar(left: list[np.ndarray], right: list[np.ndarray] | None = None) -> np.ndarray:
    """Which sets of one list are similar enough to which of the other, or of the same, by the sizes of all intersections."""
    one = right is None
    right = left if one else right
    a_sizes, b_sizes = (np.array([len(s) for s in sets], np.int64) for sets in (left, right))
    a, b = np.concatenate(left), np.concatenate(right)
    if one:
        shared, times = np.unique(a, return_counts=True)
        shared = shared[times > 1]
    else:
        shared = np.intersect1d(np.unique(a), np.unique(b), assume_unique=True)

    def placed(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(shared, values)
        known = at < len(shared)
        known[known] = shared[at[known]] == values[known]
        at, owner = at[known], np.repeat(np.arange(len(sizes)), sizes)[known]
        order = np.argsort(at, kind="stable")
        return at[order], owner[order]

    def matrix(at: np.ndarray, owner: np.ndarray, rows: int, begin: int) -> np.ndarray:
        part = slice(*np.searchsorted(at, [begin, begin + PRODUCT]))
        cells = np.zeros((rows, min(PRODUCT, len(shared) - begin)), np.float32)  # sums of ones are exact up to 2^24
        cells[owner[part], at[part] - begin] = 1
        return cells

    a_at, b_at = placed(a, a_sizes), None if one else placed(b, b_sizes)
    common = np.zeros((len(left), len(right)), np.int64)
    for begin in range(0, len(shared), PRODUCT):
        cells = matrix(*a_at, len(left), begin)
        others = cells if one else matrix(*b_at, len(right), begin)
        common += (cells @ others.T).astype(np.int64)
    return 100 * common >= SIMILAR_PERCENT * (a_sizes[:, None] + b_sizes[None, :] - common)


class Forest:
    """Joins labels; tells which joins were new."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def top(self, label: int) -> int:
        while (up := self.above.get(label, label)) != label:
            self.above[label] = label = self.above.get(up, up)
        return label

    def join(self, a: int, b: int) -> bool:
        a, b = self.top(a), self.top(b)
        self.above[max(a, b)] = min(a, b)
        return a != b


def _meet_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the classes that meet in a block. Rows come sorted by block, residents before visitors.

    In a cluster of one block all residents are compared with each other, else visitors with residents of another component.
    """
    shingle = Shingles()
    place: tuple[int, int] | None = None
    residents: dict[int, tuple[int, np.ndarray]] = {}
    visitors: dict[int, tuple[int, np.ndarray]] = {}
    forest = Forest()
    links: list[tuple[int, int]] = []

    def compare_residents() -> None:
        if len(residents) > 1:
            names = list(residents)
            a, b = np.nonzero(similar([found for _, found in residents.values()]))
            least = _together(len(names), a, b)
            links.extend((names[least[k]], names[k]) for k in np.flatnonzero(least != np.arange(len(names))))

    def compare_visitors() -> None:
        if residents and visitors:
            v_roots, r_roots = (np.array([root for root, _ in side.values()]) for side in (visitors, residents))
            near = similar([found for _, found in visitors.values()], [found for _, found in residents.values()])
            v, r = np.nonzero(near & (v_roots[:, None] != r_roots[None, :]))
            for a, b in np.unique(np.stack([v_roots[v], r_roots[r]], axis=1), axis=0).tolist():
                if forest.join(a, b):
                    links.append((a, b))
        visitors.clear()

    def told() -> pa.RecordBatch:
        found = np.array(links, np.int64).reshape(-1, 2)
        links.clear()
        return pa.RecordBatch.from_arrays([pa.array(found.min(axis=1)), pa.array(found.max(axis=1))], names=["a", "b"])

    whole = True
    for batch in batches:
        columns = ("cluster", "block", "whole", "visiting", "root", "cls", "set_key", "text")
        for cluster, block, alone, visiting, root, cls, key, text in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
            if (cluster, block) != place:
                compare_residents() if whole else compare_visitors()
                place, whole, forest = (cluster, block), alone, Forest()
                residents.clear()
                visitors.clear()
            found = shingle(text)
            if len(found) and _digest(found) == key:  # two texts can share a row's key
                (visitors if visiting else residents)[cls] = (root, found)
            if len(visitors) >= BLOCK:
                compare_visitors()
        if links:
            yield told()
    compare_residents() if whole else compare_visitors()
    if links:
        yield told()


def _best(pairs: DataFrame) -> DataFrame:
    """For every end its best pair."""
    both = pairs.select("a", "b", "equal").union(pairs.select("b", "a", "equal"))
    best = both.groupBy("a").agg(F.max_by("b", "equal").alias("b"))
    return best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def link_clusters(docs: DataFrame, classes: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(vertex, root): connected classes, by links between their full sets."""
    rooted = scratch.keep(connected_components(edges.filter("equal = 0").select("a", "b"), scratch).toDF("cls", "cluster"), "clusters")
    sizes = rooted.groupBy("cluster").agg(F.count("*").alias("size"))
    named = rooted.join(sizes, "cluster").join(classes.select("cls", "set_key", "least_doc", "least_row"), "cls")
    named = scratch.keep(named, "named")
    # The texts of the clusters, and few others, move here and once more to where they meet.
    texts = scratch.keep(with_texts(docs, named).select("cls", "cluster", "size", "set_key", "text"), "texts")
    named = named.drop("set_key", "least_doc", "least_row")
    large = named.filter(F.col("size") > BLOCK)
    place = lambda block, visiting: F.struct(block.cast("int").alias("block"), F.lit(visiting).alias("visiting"))
    told = ["cluster", "block", "whole", "visiting", "root", "cls", "set_key", "text"]
    alone = texts.filter(F.col("size") <= BLOCK).withColumns({
        "block": F.lit(0), "whole": F.lit(True), "visiting": F.lit(False), "root": F.col("cls"),
    })
    met = alone.select(*told)
    confirmed = edges.select("a", "b").limit(0)
    if not large.isEmpty():
        pairs = edges.filter("equal > 0").join(large.select(F.col("cls").alias("a")), "a", "left_semi")
        texts = texts.filter(F.col("size") > BLOCK).select("cls", "set_key", "text")
        confirmed = scratch.keep(confirm(texts, _best(pairs), scratch), "confirmed")
        roots = connected_components(confirmed, scratch).withColumnRenamed("vertex", "cls")
        large = scratch.keep(large.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls")), "rooted")
        main = large.groupBy("cluster", "root").count().groupBy("cluster").agg(F.max_by("root", F.struct("count", "root")).alias("main"))
        blocks = F.ceil(F.col("size") / BLOCK).cast("int")
        own = F.array(place(F.pmod(F.xxhash64("cls"), blocks), False))
        visits = F.transform(F.sequence(F.lit(0), blocks - 1), lambda block: place(block, True))
        places = F.when(F.col("root") == F.col("main"), own).otherwise(F.concat(own, visits)).alias("places")
        parted = large.join(main, "cluster").select("cluster", F.lit(False).alias("whole"), "root", "cls", places).join(texts, "cls")
        parted = parted.select("cluster", "whole", "root", "cls", "set_key", "text", F.explode("places").alias("place"))
        met = met.union(parted.select("cluster", "place.block", "whole", "place.visiting", "root", "cls", "set_key", "text"))
    met = met.repartition("cluster", "block").sortWithinPartitions("cluster", "block", "visiting", "cls")
    links = scratch.keep(arrow_map(met, _meet_task, "a long, b long"), "links")
    return connected_components(links.union(confirmed), scratch)


def label_components(docs: DataFrame) -> DataFrame:
    """(doc_id, row, n_shingles, component_id, kept) for every row of ``docs``."""
    small_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "near")
    found = scratch.keep(profiles(docs), "profiles")
    usable = found.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("set_key").agg(
        F.min(F.struct("doc_id", "row")).alias("least"), *(F.first(c).alias(c) for c in ("n_shingles", "roots", "sketch"))
    )
    classes = classes.select("set_key", F.col("least.doc_id").alias("least_doc"), F.col("least.row").alias("least_row"), "n_shingles", "roots", "sketch")
    classes = scratch.keep(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
    edges = find_edges(classes, scratch)
    roots = link_clusters(docs, classes, edges, scratch)

    rooted = classes.select("cls", "set_key", "least_doc").join(roots.withColumnRenamed("vertex", "cls"), "cls", "left")
    rooted = scratch.keep(rooted.withColumn("root", F.coalesce("root", "cls")).drop("cls"), "rooted")
    first = rooted.groupBy("root").agg(F.min("least_doc").alias("component_id"))
    labels = rooted.join(first, "root").select("set_key", "component_id")
    linked = usable.select("doc_id", "row", "n_shingles", "set_key").join(labels, "set_key")
    alone = found.filter("NOT (n_shingles > 0 AND doc_id IS NOT NULL)").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "row", "n_shingles", "component_id"]
    together = linked.select(*columns).union(alone.select(*columns))
    told = write_aside(together.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))), "components")
    scratch.drop_all()
    return told


def near_report(docs: DataFrame) -> DataFrame:
    return label_components(docs).drop("row")


def keep_first(docs: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """One document of each component, with all its columns.

    ``others`` (doc_id, text) are other texts of the same documents, such as the texts before lines were cut from them: documents are linked if
    any of their texts are, and go with the smallest doc_id that is left.
    """
    if others is None:
        told = label_components(docs)
    else:
        told = _merge_views(label_components(docs.select("doc_id", "text").unionByName(others.select("doc_id", "text"))))
    lost = told.filter("NOT kept").select(F.col("doc_id").alias("__near_doc"), F.col("row").alias("__near_row"))
    same = (F.col("doc_id") == F.col("__near_doc")) & (row_key(F.col("text")) == F.col("__near_row"))
    return docs.join(lost, same, "left_anti")


def _merge_views(told: DataFrame) -> DataFrame:
    """Components of which some document has texts in both become one, named by the smallest of them."""
    known = told.filter("doc_id IS NOT NULL")
    edges = known.join(known.groupBy("doc_id").agg(F.min("component_id").alias("a")), "doc_id")
    edges = edges.select("a", F.col("component_id").alias("b")).filter("a <> b").distinct()
    roots = connected_components(edges)
    merged = known.join(roots.withColumnRenamed("vertex", "component_id"), "component_id", "left")
    merged = merged.withColumn("component_id", F.coalesce("root", "component_id"))
    return merged.withColumn("kept", F.col("doc_id") == F.col("component_id"))

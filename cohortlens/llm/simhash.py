"""SimHash near-duplicates found with BK-trees.

``fingerprints`` gives every document a 64-bit fingerprint: A-Z lower-cased, words, shingles of
``shingle`` words (fewer words: the whole sequence), XXH64 with seed 42 of each; a bit is set if it is set in more
than half of the hashes. Two fingerprints are linked at ``radius`` or fewer differing bits, documents
with one fingerprint always.

``links`` finds the links between distinct fingerprints. Two fingerprints that differ in at most 3 bits
agree in at least one of 4 pieces of 16 bits, so a shard is all fingerprints with one value of
one piece, and no link is lost between shards. Within a shard a BK-tree is built: children are keyed by their
Hamming distance to the parent, and a search follows only the edges within ``radius`` of its distance to the
node. All trees of a task are built and searched together, level by level, in numpy.

Deviation from the usual form: broadcasting the trees to all searchers would send every fingerprint
everywhere. Instead each fingerprint is sent to the four trees that can hold its neighbours.

How it scales. Copies share a fingerprint and are combined before the first shuffle. A shard above
``SHARD_LIMIT`` is divided by the same argument once more: pairs in it agree in a further piece of the
remaining bits (16, 28, 37, 44 bits in all), so its members are dealt to finer shards until the shards are
small; whatever still shares 44 bits is searched as it is. A task returns at most one link per member, to the
smallest member it is connected with, so a large group of near copies does not become all its pairs. Links
are joined to components by propagating the smallest id with pointer jumping, in joins over written tables.

Defined results: a document without words, null text included, has fingerprint 0 and is linked like any
other. The component id is the smallest id among all documents of the component; null ids are ignored
(a component of null ids only has a null id). Repeated rows are returned as often as they come. An empty table
gives no rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_groups
from ..session import Workspace

SHINGLE = 3
RADIUS = 3
SEED = 42
SHARD_LIMIT = 4096

# Pieces at every depth: how many bits the shard key gains when 4 pieces of what remains are told apart.
PIECE_BITS = (16, 12, 9, 7)
PIECES = RADIUS + 1

# Pairs of (searcher, node) looked at in one numpy step.
STEP = 1 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLOCK = 1 << 14


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text."""
    # The separators of bytes.split() are the six characters of ASCII white space.
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    width = min(shingle, len(words))
    total = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, dtype=np.int64)
    for start in range(0, total, _BLOCK):
        end = min(start + _BLOCK, total)
        columns = (words[start + k : end + k] for k in range(width))
        hashes = np.fromiter(
            (digest(b" ".join(run), SEED) for run in zip(*columns, strict=True)),
            dtype="<u8",
            count=end - start,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``key``, ``fp``, the fingerprint as a signed long, and ``mark``, a hash of key and text."""

    @F.pandas_udf("long")
    def fp(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
            yield pd.Series(values.view(np.int64))

    return docs.select(F.col(key).alias("key"), fp(F.col(text)).alias("fp"), F.xxhash64(key, text).alias("mark"))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class BKForest:
    """BK-trees over many groups at once; ``group`` and ``code`` are parallel arrays."""

    def __init__(self, group: np.ndarray, code: np.ndarray):
        n = len(code)
        self.code = code
        self.parent = np.full(n, -1, dtype=np.int64)
        self.edge = np.zeros(n, dtype=np.int64)
        # Root of a group: its first member. Everything else descends, a level per turn; those that reach
        # the same node at the same distance choose their first as that node's child and go on below it.
        _, first, inverse = np.unique(group, return_index=True, return_inverse=True)
        self.root = first[inverse]
        waiting = np.flatnonzero(self.root != np.arange(n))
        at = self.root[waiting]
        while len(waiting):
            d = distance(code[waiting], code[at])
            _, first, inverse = np.unique(at * 65 + d, return_index=True, return_inverse=True)
            child = waiting[first[inverse]]
            placed = child == waiting
            self.parent[waiting[placed]] = at[placed]
            self.edge[waiting[placed]] = d[placed]
            waiting, at = waiting[~placed], child[~placed]
        # Children in order of (parent, edge), so that an interval of edges is a slice.
        self.kids = np.flatnonzero(self.parent >= 0)
        self.kids = self.kids[np.lexsort((self.edge[self.kids], self.parent[self.kids]))]
        self.slot = self.parent[self.kids] * 128 + self.edge[self.kids]

    def search(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of positions within ``radius``, each member searching its own tree."""
        step = max(1, STEP // 64)
        for start in range(0, len(self.code), step):
            seeker = np.arange(start, min(start + step, len(self.code)))
            stack = [(seeker, self.root[seeker])]
            while stack:
                seeker, node = stack.pop()
                if len(seeker) > STEP:
                    half = len(seeker) // 2
                    stack += [(seeker[:half], node[:half]), (seeker[half:], node[half:])]
                    continue
                d = distance(self.code[seeker], self.code[node])
                near = (d <= radius) & (seeker != node)
                if near.any():
                    yield seeker[near], node[near]
                low = np.searchsorted(self.slot, node * 128 + np.maximum(d - radius, 0))
                high = np.searchsorted(self.slot, node * 128 + d + radius, side="right")
                counts = high - low
                total = int(counts.sum())
                if total:
                    offsets = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
                    stack.append((np.repeat(seeker, counts), self.kids[np.repeat(low, counts) + offsets]))


def smallest_connected(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest position each position is connected with."""
    label = np.arange(n)
    for a, b in pairs:
        while True:
            la, lb = label[a], label[b]
            if (la == lb).all():
                break
            low = np.minimum(la, lb)
            np.minimum.at(label, la, low)
            np.minimum.at(label, lb, low)
            while True:
                jumped = label[label]
                if (jumped == label).all():
                    break
                label = jumped
    return label


def _shard_links(radius: int):
    def links_of(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node")
        node = part["node"].to_numpy()
        code = part["fp"].to_numpy().view(np.uint64)
        group = part["shard"].to_numpy()
        label = smallest_connected(len(node), BKForest(group, code).search(radius))
        linked = np.flatnonzero(label != np.arange(len(node)))
        return pd.DataFrame({"a": node[linked], "b": node[label[linked]]})

    return links_of


def _dealt(nodes: DataFrame, depth: int) -> DataFrame:
    """Each node once per piece of its remaining bits: ``shard`` identifies pieces and values so far.

    ``rest`` holds the bits not yet used, in the low ``width`` bits; a piece is cut out of it.
    """
    width = 64 - sum(PIECE_BITS[:depth])
    bits = PIECE_BITS[depth]
    choices = []
    for piece in range(PIECES):
        # Pieces don't overlap and leave nothing out; the last one is shorter where 4 does not divide the width.
        shift = piece * bits
        size = bits if piece < PIECES - 1 else width - shift
        cut = F.shiftrightunsigned("rest", shift).bitwiseAND(F.lit((1 << size) - 1).cast("long"))
        low = F.col("rest").bitwiseAND(F.lit((1 << shift) - 1).cast("long"))
        above = F.lit(0).cast("long")
        if shift + size < width:
            above = F.shiftleft(F.shiftrightunsigned("rest", shift + size), shift)
        choices.append(
            F.struct(
                F.xxhash64("shard", F.lit(depth), F.lit(piece), cut).alias("shard"),
                low.bitwiseOR(above).alias("rest"),
            )
        )
    dealt = nodes.withColumn("to", F.explode(F.array(*choices)))
    return dealt.select("node", "fp", F.col("to.shard").alias("shard"), F.col("to.rest").alias("rest"))


def links(nodes: DataFrame, workspace: Workspace, *, radius: int = RADIUS, limit: int = SHARD_LIMIT) -> DataFrame:
    """Links ``a > b`` between nodes (``node``, ``fp``; one per fingerprint), enough to connect all that are linked."""
    if radius >= PIECES:
        raise ValueError(f"shards are complete up to radius {PIECES - 1}")
    pending = nodes.select("node", "fp", F.lit(0).cast("long").alias("shard"), F.col("fp").alias("rest"))
    found = None
    for depth in range(len(PIECE_BITS)):
        dealt = workspace.write(_dealt(pending, depth), f"dealt-{depth}")
        large = None
        small = dealt
        if depth + 1 < len(PIECE_BITS):
            over = workspace.write(dealt.groupBy("shard").count().filter(F.col("count") > limit), f"large-{depth}")
            if not over.isEmpty():
                large = dealt.join(over.select("shard"), "shard", "left_semi")
                small = dealt.join(over.select("shard"), "shard", "left_anti")
        # Trees of many small shards are built together: a bucket holds about as much as a large shard may.
        total = dealt.count()
        least = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(least, -(-total // (8 * limit)))
        part = small.select("node", "fp", "shard").withColumn("bucket", F.pmod(F.hash("shard"), F.lit(buckets)))
        some = part.groupBy("bucket").applyInPandas(_shard_links(radius), "a long, b long")
        found = some if found is None else found.unionByName(some)
        if large is None:
            break
        pending = large.select("node", "fp", "shard", "rest")
    return workspace.write(found.distinct(), "links")


def components(edges: DataFrame, workspace: Workspace) -> DataFrame:
    """``node`` and ``root``, the smallest node connected with it, for every node that has an edge.

    In each round a node takes the smallest root among its own, its neighbours' and that root's root.
    Roots only fall, and jumping halves the way to the smallest one, so few rounds are needed.
    """
    both = workspace.write(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges"
    )
    roots = workspace.write(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "roots")
    while True:
        root_of = roots.select(F.col("node").alias("b"), F.col("root").alias("near"))
        near = both.join(root_of, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = roots.join(near, "node").select("node", "root", F.least("root", "near").alias("next"))
        jump = roots.select(F.col("node").alias("next"), F.col("root").alias("jump"))
        stepped = lower.join(jump, "next").select("node", F.least("next", "jump").alias("next"), "root")
        stepped = workspace.write(stepped, "roots")
        if stepped.filter(F.col("next") < F.col("root")).isEmpty():
            return stepped.select("node", F.col("next").alias("root"))
        roots = stepped.select("node", F.col("next").alias("root"))


def near_duplicates(
    docs: DataFrame,
    *,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    limit: int = SHARD_LIMIT,
    key: str = "doc_id",
    text: str = "text",
    workspace: Workspace | None = None,
) -> DataFrame:
    """Per document: key, ``fingerprint`` (16 hex digits), ``component_id``, ``class`` and ``mark``.

    ``class`` identifies the component by its smallest fingerprint, ``mark`` is a hash of key and text.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    marked = workspace.write(fingerprints(docs, shingle=shingle, key=key, text=text), "fingerprints")
    # The fingerprint itself is the node: ids may be null or repeated, fingerprints are not.
    nodes = workspace.write(marked.groupBy("fp").agg(F.min("key").alias("first"), F.count("*").alias("rows")), "nodes")
    edges = links(nodes.select(F.col("fp").alias("node"), "fp"), workspace, radius=radius, limit=limit)
    roots = components(edges, workspace)
    classes = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", "rows", F.coalesce("root", "fp").alias("class")
    )
    smallest = classes.groupBy("class").agg(F.min("first").alias("component_id"))
    table = workspace.write(classes.select("fp", "rows", "class").join(smallest, "class"), "classes")
    # One fingerprint, as that of texts without words, may be a large part of all.
    return join_groups(marked, table, ["fp"], "rows").select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "class",
        "mark",
    )


def pick(docs: DataFrame, mark: Column, chosen: DataFrame) -> DataFrame:
    """One row, as ``_row``, for every ``mark`` in ``chosen``, beside its columns; ``rows`` is how many rows have it.

    Whole documents pass by a hash table of the marks, unsorted. Only of rows that come more than once
    all but one are taken out.
    """
    rows = docs.select(F.struct("*").alias("_row"), mark.alias("mark"))
    single = rows.join(chosen.filter("rows = 1").hint("shuffle_hash"), "mark")
    repeated = rows.join(chosen.filter("rows > 1").hint("shuffle_hash"), "mark").dropDuplicates(["mark"])
    return single.unionByName(repeated)


def keep_first(docs: DataFrame, *, key: str = "doc_id", text: str = "text", workspace: Workspace | None = None, **options) -> DataFrame:
    """One document of each component, that with the smallest key, with the columns it came with."""
    workspace = workspace or Workspace(docs.sparkSession)
    found = near_duplicates(docs, key=key, text=text, workspace=workspace, **options)
    chosen = found.filter(F.col(key).eqNullSafe(F.col("component_id")))
    # Rows may share the smallest key, or have none: one text among them is chosen, then one of equal rows.
    marks = chosen.groupBy("class", "mark").agg(F.count("*").alias("rows"))
    one = marks.groupBy("class").agg(F.min(F.struct("mark", "rows")).alias("one"))
    one = workspace.write(one.select("one.*"), "chosen")
    return pick(docs, F.xxhash64(key, text), one).select("_row.*")

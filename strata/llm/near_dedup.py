"""Near duplicates by chosen-path set similarity join.

A document is the set of its word shingles. Equal sets become one class; every class gets
``COORDINATES`` minwise tokens. In each of ``TREES`` independent trees a class branches, at
every node, into the children named by the two tokens that the node's own path chooses, so
similar sets meet again and again while others part. Each node compares its members with one of
them, its leader, which joins most of a large group of near copies at linear cost. Small nodes
that then still hold several components are compared exhaustively, larger ones branch on.

Signatures only select: members that look similar to one of another component are gathered by
what they look similar to, and compared on their full sets, cell by cell; cells and nodes report
no more pairs than they have members.

At similarity 0.8 two sets miss each other in a tree with probability 0.054, in four with 1e-5;
a signature of 128 tokens misses the selection limit with probability 1e-4.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.components import connected_components
from strata.llm.shared import (
    NOT_SPACE,
    Words,
    discard,
    keep_rows,
    mixed,
    rolling,
    stored,
    text_blocks,
    text_hash,
)

COORDINATES = 128
TREES = 4
#: Nodes of up to so many members are compared exhaustively, in cells of two blocks of BLOCK.
SMALL_NODE, BLOCK = 4096, 256
#: Larger nodes branch so many times; what then is left is compared exhaustively all the same.
LEVELS = 6
#: Bytes of text in a block of full sets.
BLOCK_TEXT = 8 << 20
#: Estimates deviate by up to 0.14 (four deviations at 0.8).
SLACK = 0.14
#: Bits of the table that tells which texts take part in a confirmation.
FILTER_BITS = 25

_seeds = mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
FACTORS, SHIFTS = _seeds[:COORDINATES] | np.uint64(1), _seeds[COORDINATES:]
#: The leader of a node is the member whose number is smallest after this exclusive or.
MASKS = [int(x) >> 2 for x in mixed(np.arange(101, 101 + TREES, dtype=np.uint64))]


class Shingles:
    """Shingle hashes of a block of texts: those of text i are ``hash[at[i]:at[i + 1]]``."""

    def __init__(self, texts: list[bytes], n: int):
        words = Words(texts, NOT_SPACE).lower_ascii()
        hashes, counts = words.hash, words.counts
        first = np.concatenate(([0], np.cumsum(counts)))
        runs = rolling(hashes, n)
        sizes = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
        self.at = np.concatenate(([0], np.cumsum(sizes)))
        position = np.repeat(first[:-1] - self.at[:-1], sizes) + np.arange(self.at[-1])
        short = np.repeat(counts < n, sizes)
        self.hash = np.empty(self.at[-1], dtype=np.uint64)
        self.hash[~short] = runs[position[~short]]
        for i in np.flatnonzero((counts > 0) & (counts < n)):
            self.hash[self.at[i]] = rolling(hashes[first[i] : first[i + 1]], int(counts[i]))[0]

    def sets(self) -> list[np.ndarray]:
        return [np.unique(self.hash[a:b]) for a, b in zip(self.at[:-1], self.at[1:])]

    def signatures(self) -> np.ndarray:
        """Minwise tokens (32 bits) per text and coordinate; 0 for empty sets."""
        out = np.zeros((len(self.at) - 1, COORDINATES), dtype=np.uint32)
        full = np.flatnonzero(self.at[1:] > self.at[:-1])
        if len(full):
            for i in range(COORDINATES):
                values = (self.hash ^ SHIFTS[i]) * FACTORS[i]
                out[full, i] = (mixed(np.minimum.reduceat(values, self.at[:-1][full])) >> np.uint64(32)).astype(np.uint32)
        return out


def _rows(matrix: np.ndarray) -> pa.Array:
    width = matrix.shape[1] * matrix.itemsize
    raw = pa.py_buffer(np.ascontiguousarray(matrix))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(matrix), [None, raw]).cast(pa.binary())


def _matrix(column: pa.Array, kind) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=kind).reshape(len(values), -1)


def _printer(n: int):
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, block in text_blocks(batch.column(2)):
                shingles = Shingles(block, n)
                sets = shingles.sets()
                signatures = shingles.signatures()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        batch.column(1).slice(start, stop - start),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in sets], pa.binary()),
                        _rows(signatures),
                        _rows(signatures.astype(np.uint8)),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "digest", "tokens", "sketch"],
                )

    return prints


def shingle_prints(docs: DataFrame, n: int, text: str, key: str) -> DataFrame:
    """doc_id, text_hash, n_shingles, digest of the set, its minwise tokens and their low bytes."""
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(F.col(key).alias("doc_id"), text_hash(text).alias("text_hash"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(
        _printer(n), f"doc_id {kind}, text_hash bigint, n_shingles bigint, digest binary, tokens binary, sketch binary"
    )


def _children(path: np.ndarray, tokens: np.ndarray) -> list[np.ndarray]:
    """Paths of the two children: the path itself chooses the coordinates."""
    choice = mixed(path ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    one = choice % np.uint64(COORDINATES)
    two = (one + np.uint64(1) + (choice >> np.uint64(32)) % np.uint64(COORDINATES - 1)) % np.uint64(COORDINATES)
    rows = np.arange(len(path))
    return [
        mixed(path * np.uint64(3) + mixed((c << np.uint64(32)) + tokens[rows, c.astype(np.int64)]))
        for c in (one, two)
    ]


def _sprout(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, tokens) -> (path, tree, node): two levels of every tree."""
    for batch in batches:
        node = batch.column(0).to_numpy()
        tokens = _matrix(batch.column(1), np.uint32)
        for tree in range(TREES):
            root = np.full(len(node), mixed(np.array([tree + 1], dtype=np.uint64))[0])
            for child in _children(root, tokens):
                for leaf in _children(child, tokens):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(leaf.view(np.int64)),
                            pa.array(np.full(len(node), tree, dtype=np.int32)),
                            pa.array(node),
                        ],
                        names=["path", "tree", "node"],
                    )


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, tree, node, tokens) -> (path, tree, node): one level further."""
    for batch in batches:
        path = batch.column(0).to_numpy().view(np.uint64)
        tokens = _matrix(batch.column(3), np.uint32) if batch.num_rows else np.zeros((0, COORDINATES), np.uint32)
        for child in _children(path, tokens):
            yield pa.RecordBatch.from_arrays(
                [pa.array(child.view(np.int64)), batch.column(1), batch.column(2)], names=["path", "tree", "node"]
            )


def _selector(limit: float):
    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(a, b, sketch of a, sketch of b) -> (a, b) of the pairs above the limit."""
        for batch in batches:
            if batch.num_rows:
                same = _matrix(batch.column(2), np.uint8) == _matrix(batch.column(3), np.uint8)
                estimate = same.mean(axis=1)
                yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(estimate >= limit))

    return select


class _Forest:
    """Union-find over the positions of a cell; positions of equal component start united."""

    def __init__(self, component: np.ndarray):
        _, first, inverse = np.unique(component, return_index=True, return_inverse=True)
        self.parent = first[inverse]

    def union(self, i: int, j: int) -> bool:
        a, b = self.parent[i], self.parent[j]
        if a == b:
            return False
        self.parent[self.parent == b] = a
        return True


def _may_meet(side: np.ndarray, i: int) -> np.ndarray:
    """Positions that position i is compared with: later ones of its own side 2, or side 1 for
    side 0."""
    if side[i] == 2:
        return np.arange(i + 1, len(side))
    return np.flatnonzero(side == 1) if side[i] == 0 else np.zeros(0, np.int64)


def _alike(limit: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(members: node, component, side, sketch) -> (a, b): for every member whose estimate
        with one of another component is above the limit a pair, and pairs that connect all such
        members as they are connected by such estimates."""
        for batch in batches:
            ones, others = [], []
            for row in batch.column(0):
                flat = row.values
                node, part = flat.field("node").to_numpy(), flat.field("component").to_numpy()
                side = flat.field("side").to_numpy()
                sketch = _matrix(flat.field("sketch"), np.uint8)
                forest, named = _Forest(part), np.zeros(len(node), dtype=bool)
                for i in range(len(node)):
                    j = _may_meet(side, i)
                    j = j[part[j] != part[i]]
                    j = j[(sketch[j] == sketch[i]).mean(axis=1) >= limit] if len(j) else j
                    for k in j.tolist():
                        if forest.union(i, k) or not named[k] or not named[i]:
                            named[i] = named[k] = True
                            ones.append(node[i])
                            others.append(node[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ones, pa.int64()), pa.array(others, pa.int64())], names=["a", "b"]
            )

    return compare


def _similar(n: int, percent: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(members: node, component, side, text) -> (a, b): pairs similar by their full sets
        that connect all components of the cell that such pairs connect."""
        for batch in batches:
            ones, others = [], []
            for row in batch.column(0):
                flat = row.values
                node, part = flat.field("node").to_numpy(), flat.field("component").to_numpy()
                side = flat.field("side").to_numpy()
                sets = [s for _, _, block in text_blocks(flat.field("text")) for s in Shingles(block, n).sets()]
                sizes = np.array(list(map(len, sets)))
                starts = np.cumsum(sizes) - sizes
                kinds, ids = np.unique(np.concatenate(sets), return_inverse=True)
                forest, mark = _Forest(part), np.zeros(len(kinds), dtype=np.int64)
                for i in range(len(node)):
                    j = _may_meet(side, i)
                    j = j[forest.parent[j] != forest.parent[i]]
                    if len(j):
                        own = ids[starts[i] : starts[i] + sizes[i]]
                        mark[own] = 1
                        common = np.add.reduceat(mark[ids], starts)[j]
                        mark[own] = 0
                        for k in j[100 * common >= percent * (sizes[i] + sizes[j] - common)].tolist():
                            if forest.union(i, k):
                                ones.append(node[i])
                                others.append(node[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ones, pa.int64()), pa.array(others, pa.int64())], names=["a", "b"]
            )

    return compare


def _wanted_texts(n: int, bits: np.ndarray):
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(text) -> (digest, text) of the texts whose digest is in the bit table, each set once
        per batch."""
        for batch in batches:
            column, seen, digests, rows = batch.column(0), set(), [], []
            for start, _, block in text_blocks(column):
                for i, s in enumerate(Shingles(block, n).sets()):
                    digest = hashlib.blake2b(s, digest_size=16).digest()
                    at = int.from_bytes(digest[:8], "big") & ((1 << FILTER_BITS) - 1)
                    if digest not in seen and bits[at >> 3] >> (at & 7) & 1:
                        seen.add(digest)
                        digests.append(digest)
                        rows.append(start + i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), column.take(pa.array(rows, pa.int64()))], names=["digest", "text"]
            )

    return pick


def _bit_table(digests: DataFrame) -> np.ndarray:
    """2 ** FILTER_BITS bits, set for the low bits of the digests: a fixed size for any input."""
    low = F.conv(F.hex(F.substring("digest", 1, 8)), 16, 10).cast("decimal(20,0)")
    at = F.pmod(low, F.lit(1 << FILTER_BITS).cast("decimal(20,0)")).cast("long")
    words = (
        digests.select(at.alias("at"))
        .groupBy(F.shiftright("at", 5).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 31 as int))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (FILTER_BITS - 5), dtype=np.uint32)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return table.view(np.uint8)


def _confirmer(n: int, percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(a, b, text of a, text of b) -> (a, b) where 100 * intersection >= percent * union."""
        last: tuple[bytes, np.ndarray] = (b"", np.zeros(0, np.uint64))
        for batch in batches:
            good = []
            for start, _, block in text_blocks(batch.column(2)):
                for i, one in enumerate(Shingles(block, n).sets()):
                    other = batch.column(3)[start + i].as_buffer().to_pybytes()
                    if other != last[0]:
                        last = (other, Shingles([other], n).sets()[0])
                    common = len(np.intersect1d(one, last[1], assume_unique=True))
                    good.append(100 * common >= percent * (len(one) + len(last[1]) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return confirm


class _Join:
    def __init__(self, docs: DataFrame, n: int, percent: int, text: str):
        self.texts = docs.select(F.col(text).cast("string").alias("text"))
        self.n, self.percent = n, percent
        self.limit = percent / 100 - SLACK

    def classes(self, prints: DataFrame) -> DataFrame:
        """node, digest, tokens, sketch: one row for each distinct set that is not empty."""
        return stored(
            prints.filter("n_shingles > 0")
            .groupBy("digest")
            .agg(F.min("row").alias("node"), F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch"))
        )

    def sketched(self, pairs: DataFrame, classes: DataFrame, limit: float) -> DataFrame:
        """The pairs (a, b) whose estimated similarity is at least the limit."""
        sketch = classes.select("node", "sketch")
        both = pairs.join(sketch.withColumnsRenamed({"node": "a", "sketch": "sa"}), "a").join(
            sketch.withColumnsRenamed({"node": "b", "sketch": "sb"}), "b"
        )
        return both.select("a", "b", "sa", "sb").mapInArrow(_selector(limit), "a bigint, b bigint")

    def texts_of(self, nodes: DataFrame, classes: DataFrame) -> DataFrame:
        """node, text: one text for each of the nodes. Other texts mostly stay where they are."""
        needed = stored(classes.select("node", "digest").join(nodes, "node", "left_semi"))
        bits = self.texts.sparkSession.sparkContext.broadcast(_bit_table(needed))
        pick = _late(_wanted_texts, self.n, bits)
        found = stored(
            self.texts.mapInArrow(pick, "digest binary, text string")
            .join(needed, "digest")
            .groupBy("node")
            .agg(F.min("text").alias("text"))
        )
        discard(needed)
        return found

    def confirmed(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs (a, b) that are similar by their full sets."""
        nodes = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "node")
        texts = self.texts_of(nodes, classes)
        both = pairs.join(texts.withColumnsRenamed({"node": "a", "text": "ta"}), "a").join(
            texts.withColumnsRenamed({"node": "b", "text": "tb"}), "b"
        )
        found = stored(
            both.select("a", "b", "ta", "tb").mapInArrow(_confirmer(self.n, self.percent), "a bigint, b bigint")
        )
        discard(texts)
        return found

    def leaders(self, members: DataFrame) -> DataFrame:
        """path, leader of the nodes with two members or more."""
        mask = F.element_at(F.array(*[F.lit(m) for m in MASKS]), F.col("tree") + 1)
        return stored(
            members.groupBy("path", "tree")
            .agg(F.count("*").alias("size"), F.min(F.col("node").bitwiseXOR(mask)).alias("low"))
            .filter("size > 1")
            .select("path", F.col("low").bitwiseXOR(mask).alias("leader"))
        )

    def merged(self, parts: DataFrame, links: DataFrame) -> DataFrame:
        """node, component of every class: those so far, joined by further links."""
        named = links.join(parts.withColumnsRenamed({"node": "a", "component": "ca"}), "a").join(
            parts.withColumnsRenamed({"node": "b", "component": "cb"}), "b"
        )
        found = connected_components(named.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        found = found.select(F.col("node").alias("component"), F.col("component").alias("to"))
        return stored(
            parts.join(found, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        )

    def mixed_nodes(self, members: DataFrame, parts: DataFrame) -> DataFrame:
        """path, tree, node, component, size, low: the members of tree nodes that hold more than
        one component, low being the smallest of these."""
        marked = stored(members.select("path", "tree", "node").join(parts, "node"))
        several = stored(
            marked.groupBy("path")
            .agg(F.count("*").alias("size"), F.min("component").alias("low"), F.max("component").alias("high"))
            .filter("low <> high")
            .select("path", "size")
        )
        found = stored(marked.join(several, "path"))
        discard(marked, several)
        return found

    def linked(self, members: DataFrame, parts: DataFrame, classes: DataFrame) -> DataFrame | None:
        """Links (a, b) that connect what is similar among the members (path, size, node,
        component) of each tree node; None if there are none."""
        sketched = members.join(classes.select("node", "sketch"), "node")
        cells = _cells(sketched, "path", F.ceil(F.col("size") / BLOCK), "sketch")
        seen = stored(cells.mapInArrow(_alike(self.limit), "a bigint, b bigint").distinct())
        if seen.isEmpty():
            return None
        # What may be connected, directly or through others, is gathered in one family.
        named = seen.join(parts.withColumnsRenamed({"node": "a", "component": "ca"}), "a").join(
            parts.withColumnsRenamed({"node": "b", "component": "cb"}), "b"
        )
        families = connected_components(named.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        families = families.select(F.col("node").alias("component"), F.col("component").alias("family"))
        nodes = stored(seen.select("a").union(seen.select("b")).distinct().withColumnRenamed("a", "node"))
        texts = self.texts_of(nodes, classes)
        placed = stored(nodes.join(parts, "node").join(families, "component").select("family", "node", "component"))
        sized = placed.join(texts.select("node", F.octet_length("text").alias("n")), "node")
        sizes = stored(
            sized.groupBy("family").agg(
                F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_TEXT)).alias("blocks")
            )
        )
        whole = placed.join(sizes, "family").join(texts, "node")
        cells = _cells(whole, "family", F.col("blocks"), "text")
        found = stored(cells.mapInArrow(_similar(self.n, self.percent), "a bigint, b bigint"))
        discard(seen, nodes, texts, placed, sizes)
        return found

    def components(self, classes: DataFrame) -> DataFrame:
        """node, component of every class."""
        parts = stored(classes.select("node", F.col("node").alias("component")))
        members = classes.select("node", "tokens").mapInArrow(_sprout, "path bigint, tree int, node bigint")
        for level in range(LEVELS + 1):
            # The sharing of a node is counted first: a class alone in its nodes goes no further.
            leaders = self.leaders(members)
            members = stored(members.join(leaders, "path"))
            pairs = members.filter("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))
            pairs = stored(self.sketched(pairs.distinct(), classes, self.limit))
            if not pairs.isEmpty():
                found = self.confirmed(pairs, classes)
                parts = self.merged(parts, found)
                discard(found)
            mixed_ = self.mixed_nodes(members, parts)
            discard(leaders, members, pairs)

            now = mixed_ if level == LEVELS else mixed_.filter(F.col("size") <= SMALL_NODE)
            found = self.linked(now, parts, classes)
            if found is not None:
                parts = self.merged(parts, found)
                discard(found)
            large = mixed_.filter(F.col("size") > SMALL_NODE)
            if level == LEVELS or large.isEmpty():
                break
            deeper = large.join(classes.select("node", "tokens"), "node").select("path", "tree", "node", "tokens")
            members = deeper.mapInArrow(_branch, "path bigint, tree int, node bigint")
        return parts


def _cells(members: DataFrame, group: str, blocks: Column, value: str) -> DataFrame:
    """members (arrays of node, component, side and the value): cells of at most about twice
    BLOCK members in which any two members of a group meet."""
    placed = members.withColumn("_n", blocks.cast("int")).withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_n")).cast("int"))
    spread = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    own, other = F.col("_own"), F.col("_other")
    side = F.when(own == other, 2).when(own < other, 0).otherwise(1)
    return (
        spread.groupBy(group, F.least(own, other).alias("_i"), F.greatest(own, other).alias("_j"))
        .agg(F.collect_list(F.struct("node", "component", side.alias("side"), value)).alias("members"))
        .select("members")
    )


def _late(make, n, sent):
    """The function built from a broadcast value, on the executor."""

    def run(batches):
        return make(n, sent.value)(batches)

    return run


def _components(docs: DataFrame, n: int, percent: int, text: str, key: str) -> DataFrame:
    prints = stored(shingle_prints(docs, n, text, key).withColumn("row", F.monotonically_increasing_id()))
    join = _Join(docs, n, percent, text)
    classes = join.classes(prints)
    parts = join.components(classes)
    # Rows -> class -> component; empty sets stand alone.
    named = stored(classes.select("digest", "node").join(parts, "node").select("digest", "component"))
    rows = prints.select("doc_id", "text_hash", "n_shingles", "row", "digest")
    found = rows.filter("n_shingles > 0").join(named, "digest").drop("digest")
    alone = rows.filter("n_shingles = 0").drop("digest").withColumn("component", -F.col("row") - 1)
    placed = stored(found.unionByName(alone))
    first = stored(
        placed.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    )
    return placed.join(first, "component").select(
        "doc_id",
        "n_shingles",
        F.col("first.doc_id").alias("component_id"),
        (F.col("first.row") == F.col("row")).alias("kept"),
        "text_hash",
    )


def near_duplicates(
    docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Words are runs of anything but white space, A-Z as a-z; a set holds the distinct shingles of
    ``n`` words, of a shorter text its whole word sequence. Null texts and texts without words
    have empty sets and stand alone. Two rows are linked when 100 * intersection >= percent *
    union; component_id is the smallest doc_id (nulls last) that links lead to, and its row is
    kept, one row if several carry that id. An empty table gives no rows; further columns of the
    input play no part.
    """
    return _components(docs, n, percent, text, key).drop("text_hash")


def drop_near_duplicates(
    docs: DataFrame, n: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns."""
    return keep_rows(docs, _components(docs, n, percent, text, key).filter("kept"), text, key)

"""Hard negatives by vertical scans of vectors in blocks.

A block holds its vectors by column, one run of numbers per dimension. For an anchor a block is
read dimension by dimension in the order of the anchor's descending magnitudes. What the unread
dimensions can still add lies between bounds from their smallest and largest values, so each row
has a lowest and a highest score; rows that can no longer matter leave the candidates, and the
scan ends with exact scores of the few that are left. Nearest rows of the anchor's own label
give score windows; a second scan finds the rows of other labels within them.

Anchors meet the blocks in pairs of a block and a chunk of anchors, both of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.shared import reread, stored

#: Rows of a block and anchors of a chunk, on average.
BLOCK, CHUNK = 2048, 1024
#: Dimensions that are read between two looks at the bounds.
STEP = 8
SCALE = 256.0
#: Scaled components beyond it could overflow a sum of products.
MAX_COMPONENT = 1 << 26


def integer_vectors(
    embeddings: DataFrame, scale: float, vector: str = "embedding", key: str = "vec_id", **extra: Column
) -> DataFrame:
    """vec_id, row, v (floor(scale * x) of each component x as a double), and ``extra`` columns.

    Rows with a null vector or component, or a component that is not finite, are left out.
    ``row`` tells rows with the same key apart. A result beyond MAX_COMPONENT is an error.
    """
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    checked = F.transform(
        F.transform(x, lambda c: F.floor(F.lit(scale) * c)),
        lambda c: F.when(F.abs(c) > MAX_COMPONENT, F.raise_error(F.lit("component too large"))).otherwise(c.cast("int")),
    )
    return embeddings.filter(F.col(vector).isNotNull() & ~odd).select(
        F.col(key).cast("long").alias("vec_id"),
        F.monotonically_increasing_id().alias("row"),
        *[c.alias(n) for n, c in extra.items()],
        checked.alias("v"),
    )


def matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as a matrix by dimension: row d holds component d of all of them."""
    vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.ascontiguousarray(flat.reshape(len(vectors), len(flat) // len(vectors)).T)


class Block:
    """Vectors by dimension, with the smallest and largest value of each."""

    def __init__(self, rows: pa.Table):
        self.ids = rows.column("vec_id").to_numpy()
        self.rows = rows.column("row").to_numpy()
        self.values = matrix(rows.column("v"))
        self.low, self.high = self.values.min(axis=1), self.values.max(axis=1)

    def scan(self, anchor: np.ndarray, live: np.ndarray, prune) -> tuple[np.ndarray, np.ndarray]:
        """(positions, exact scores) of the rows of ``live`` that ``prune`` leaves.

        ``prune(lowest, highest)`` says which candidates stay, given bounds of their scores.
        """
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack((anchor * self.low, anchor * self.high))[:, order]
        # What the dimensions from a place of the order on add at least and at most.
        least = np.append(np.cumsum(ends.min(axis=0)[::-1])[::-1], 0)
        most = np.append(np.cumsum(ends.max(axis=0)[::-1])[::-1], 0)
        score = np.zeros(len(live), dtype=np.int64)
        for at in range(0, len(order), STEP):
            part = order[at : at + STEP]
            values = self.values[part] if len(live) == self.values.shape[1] else self.values[np.ix_(part, live)]
            score += anchor[part] @ values
            done = min(at + STEP, len(order))
            keep = prune(score + least[done], score + most[done])
            if not keep.all():
                live, score = live[keep], score[keep]
            if not len(live):
                break
        return live, score

    def first(self, live: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
        """Places of the ``n`` first by score, highest first, then by id."""
        return np.lexsort((self.ids[live], -score))[:n]


def nearest(block: Block, anchor: np.ndarray, row: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, scores) of the ``n`` first rows but ``row`` itself."""

    def prune(lowest: np.ndarray, highest: np.ndarray) -> np.ndarray:
        if len(lowest) <= n:
            return np.ones(len(lowest), dtype=bool)
        return highest >= np.partition(lowest, len(lowest) - n)[len(lowest) - n]

    live, score = block.scan(anchor, np.flatnonzero(block.rows != row), prune)
    best = block.first(live, score, n)
    return live[best], score[best]


def in_windows(
    block: Block, anchor: np.ndarray, live: np.ndarray, windows: list[tuple[int, int]], n: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each (low, high) the (positions, scores) of the first ``n`` rows scored within it."""

    def prune(lowest: np.ndarray, highest: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(lowest), dtype=bool)
        for low, high in windows:
            may = (highest >= low) & (lowest <= high)
            sure = lowest[(lowest >= low) & (highest <= high)]
            if len(sure) >= n:
                # n rows are in the window for certain and score at least this.
                may &= highest >= np.partition(sure, len(sure) - n)[len(sure) - n]
            keep |= may
        return keep

    live, score = block.scan(anchor, live, prune)
    out = []
    for low, high in windows:
        inside = np.flatnonzero((score >= low) & (score <= high))
        best = inside[block.first(live[inside], score[inside], n)]
        out.append((live[best], score[best]))
    return out


def _scan_positives(n: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        """A block of one label, a chunk of its anchors -> their nearest rows of the block."""
        out = []
        if rows.num_rows and anchors.num_rows:
            block = Block(rows)
            values = matrix(anchors.column("v"))
            for k, row in enumerate(anchors.column("row").to_pylist()):
                at, score = nearest(block, values[:, k], row, n)
                out += zip([row] * len(at), block.ids[at].tolist(), block.rows[at].tolist(), score.tolist())
        columns = list(zip(*out)) or [()] * 4
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("row", "other_id", "other_row", "score"), columns)})

    return run


def _scan_negatives(n: int, low: int, high: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        """A block of all labels, a chunk of anchors with the scores of their positives -> the
        first rows of other labels in the window of each positive."""
        out = []
        if rows.num_rows and anchors.num_rows:
            block = Block(rows)
            names, labels = np.unique(rows.column("label").to_numpy(), return_inverse=True)
            number = {name: i for i, name in enumerate(names.tolist())}
            values = matrix(anchors.column("v"))
            for k, anchor in enumerate(anchors.select(["row", "label", "scores"]).to_pylist()):
                # low * score <= 100 * other <= high * score; nothing is below a negative score.
                windows = [(-(-low * s // 100), high * s // 100) for s in anchor["scores"]]
                live = np.flatnonzero(labels != number.get(anchor["label"], -1))
                for score, (at, found) in zip(anchor["scores"], in_windows(block, values[:, k], live, windows, n)):
                    out += zip([anchor["row"]] * len(at), [score] * len(at), block.ids[at].tolist(), found.tolist())
        columns = list(zip(*out)) or [()] * 4
        names = ("row", "positive_score", "negative_id", "negative_score")
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(names, columns)})

    return run


def _spread(df: DataFrame, parts: Column, others: Column, mine: str, theirs: str) -> DataFrame:
    """Each row in one of ``parts`` by a hash of its number, once for each of ``others``."""
    return df.withColumn(mine, F.pmod(F.xxhash64("row"), parts)).withColumn(
        theirs, F.explode(F.sequence(F.lit(0).cast("long"), others - 1))
    )


def _parts(count: Column, size: int) -> Column:
    return F.ceil(count / F.lit(size)).cast("long")


def mine_hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column,
    vector: str = "embedding",
    key: str = "vec_id",
    label: str = "label",
    scale: float = SCALE,
    n_positives: int = 5,
    n_negatives: int = 5,
    window: tuple[int, int] = (80, 100),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Scores are inner products of vectors of integers floor(scale * x). An anchor (``is_anchor``,
    a condition on the columns of ``embeddings``) has as positives its first ``n_positives``
    other rows of the same label; for each, the first ``n_negatives`` rows of other labels come
    whose score is between ``window`` percent of the positive's. Higher scores come first, ties
    by smaller id.

    Rows without key, label or vector, or with a null or non-finite component, take no part. Only
    vectors of the same length are compared. Rows that repeat a key are rows of their own; a row
    is no positive of itself, a copy of it is. Anchors without positives, positives without rows
    in their window and empty tables give nothing.
    """
    named = embeddings.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    table = stored(
        integer_vectors(
            named, scale, vector, key, label=F.col(label).cast("string"), anchor=F.coalesce(is_anchor, F.lit(False)),
            dims=F.size(vector),
        )
    )
    anchors = reread(table).filter("anchor")

    # Positives: blocks of one label meet chunks of its anchors.
    sizes = table.groupBy("dims", "label").agg(
        _parts(F.count("*"), BLOCK).alias("blocks"), _parts(F.count_if("anchor"), CHUNK).alias("chunks")
    ).filter("chunks > 0")
    sizes = stored(sizes)
    keys = ["dims", "label", "block", "chunk"]
    mine = _spread(table.join(sizes, ["dims", "label"]), F.col("blocks"), F.col("chunks"), "block", "chunk")
    theirs = _spread(anchors.join(sizes, ["dims", "label"]), F.col("chunks"), F.col("blocks"), "chunk", "block")
    near = (
        mine.select(*keys, "vec_id", "row", "v")
        .groupBy(*keys)
        .cogroup(theirs.select(*keys, "row", "v").groupBy(*keys))
        .applyInArrow(_scan_positives(n_positives), "row bigint, other_id bigint, other_row bigint, score bigint")
    )
    best = Window.partitionBy("row").orderBy(F.desc("score"), "other_id", "other_row")
    positives = stored(near.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= n_positives))

    # Negatives: blocks of all labels meet chunks of the anchors with the scores of their positives.
    # Equal scores give equal windows, so each is looked for once; negative ones have none.
    scores = positives.filter("score >= 0").groupBy("row").agg(F.collect_set("score").alias("scores"))
    wanted = stored(anchors.join(scores, "row").select("row", "label", "dims", "v", "scores"))
    sizes = stored(
        table.groupBy("dims")
        .agg(_parts(F.count("*"), BLOCK).alias("blocks"))
        .join(wanted.groupBy("dims").agg(_parts(F.count("*"), CHUNK).alias("chunks")), "dims")
    )
    keys = ["dims", "block", "chunk"]
    mine = _spread(table.join(sizes, "dims"), F.col("blocks"), F.col("chunks"), "block", "chunk")
    theirs = _spread(wanted.join(sizes, "dims"), F.col("chunks"), F.col("blocks"), "chunk", "block")
    found = (
        mine.select(*keys, "vec_id", "row", "label", "v")
        .groupBy(*keys)
        .cogroup(theirs.select(*keys, "row", "label", "v", "scores").groupBy(*keys))
        .applyInArrow(
            _scan_negatives(n_negatives, *window),
            "row bigint, positive_score bigint, negative_id bigint, negative_score bigint",
        )
    )
    best = Window.partitionBy("row", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n_negatives)
    named = positives.select(
        "row", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")
    ).join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return named.join(ranked, ["row", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )

"""Quality and toxicity by hierarchical empirical Bayes.

A classifier of each text's own features (logistic, fitted by Newton steps) gives evidence; the documents of a host, and of a path
within it, give priors for one another. Sites with few documents shrink toward their host, hosts
toward the whole, by as much as the sites differ beyond chance. All site figures come from
grouped aggregates over every document.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import ALNUM, Words, byte_table, discard, mixed, stored, text_blocks

#: Features are counted in so many buckets, which bounds the model whatever the vocabulary.
BUCKETS = 1 << 18
#: The classifier is fitted on at most so many labelled rows, those of the smallest id hashes.
MAX_LABELS = 20_000
#: Features whose two rates differ by fewer standard errors do not count, and of the others so
#: many of the clearest at most do; RIDGE holds their weights near 0.
SIGNIFICANT, MAX_FEATURES, RIDGE = 3.0, 1_000, 1.0
STEPS = 30
#: Probabilities of sites and texts stay that far from 0 and 1.
EDGE = 1e-4
HELD_OUT = 5

SYMBOL = byte_table((33, 47), (58, 64), (91, 96), (123, 126))
_LINE = re.compile(rb"[^\n]+")
TARGETS = ("quality", "toxic")


def _level(value: float, steps: int = 20) -> int:
    return int(min(max(value, 0.0), 1.0) * steps)


def text_features(texts: list[bytes]) -> list[np.ndarray]:
    """For each text the distinct buckets of its words, symbol runs and measured properties:
    shares of symbols, capitals, digits and distinct words, repeated lines, word length."""
    words = Words(texts, ALNUM)
    upper = np.concatenate(([0], np.cumsum((words.buffer >= 65) & (words.buffer <= 90))))
    digit = np.concatenate(([0], np.cumsum((words.buffer >= 48) & (words.buffer <= 57))))
    words.lower_ascii()
    hashes = words.hash
    runs = Words(texts, SYMBOL)
    symbols = mixed(runs.hash + np.uint64(1))
    symbol_bytes = np.concatenate(([0], np.cumsum(runs.end - runs.start)))
    w, s = np.concatenate(([0], np.cumsum(words.counts))), np.concatenate(([0], np.cumsum(runs.counts)))
    out = []
    for i, text in enumerate(texts):
        own = np.unique(hashes[w[i] : w[i + 1]])
        n_words, size = int(words.counts[i]), max(1, len(text))
        a, b = words.offsets[i], words.offsets[i] + len(text)
        lines = [x.strip() for x in _LINE.findall(text)]
        longest = int((words.end[w[i] : w[i + 1]] - words.start[w[i] : w[i + 1]]).max(initial=0))
        traits = (
            _level((symbol_bytes[s[i + 1]] - symbol_bytes[s[i]]) / size),
            _level((upper[b] - upper[a]) / size),
            _level((digit[b] - digit[a]) / size),
            _level(len(own) / max(1, n_words)) if n_words >= 20 else 99,
            _level(1 - len(set(lines)) / max(1, len(lines))),
            int(math.log2(n_words + 1)),
            _level(size / (n_words + 1) / 40),
            int(math.log2(longest + 1)),
        )
        marks = mixed(np.array([(k + 1) * 1000 + t for k, t in enumerate(traits)], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        every = np.concatenate((own, np.unique(symbols[s[i] : s[i + 1]]), marks))
        out.append(np.unique((every & np.uint64(BUCKETS - 1)).astype(np.int32)))
    return out


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(quality, toxic, text) -> (quality, toxic, its buckets)."""
    for batch in batches:
        for start, stop, block in text_blocks(batch.column(2)):
            found = text_features(block)
            ends = np.cumsum([0, *map(len, found)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found), pa.int32()))
            own = [batch.column(i).slice(start, stop - start) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*own, lists], names=[*TARGETS, "buckets"])


def _scorer(sent):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(..., text) -> (..., log odds of quality, of toxic)."""
        priors, weights = sent.value
        for batch in batches:
            odds = []
            for _, _, block in text_blocks(batch.column(batch.num_columns - 1)):
                odds += [priors + weights[:, f].sum(axis=1) for f in text_features(block)]
            columns = np.array(odds, dtype=np.float64).reshape(-1, len(TARGETS))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(columns[:, i]) for i in range(len(TARGETS)))],
                names=[*batch.schema.names[:-1], *(f"{t}_odds" for t in TARGETS)],
            )

    return score


def held_out(key: str) -> Column:
    """Every fifth id by its checksum takes no part in fitting."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % HELD_OUT == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, text: str, key: str) -> tuple[np.ndarray, np.ndarray]:
    """(log odds of each target, weights per target and bucket) from the labelled rows.

    At most MAX_LABELS labels, and as many labelled rows, are used: the ids may be sent to the
    documents, and the rows with their chosen features to the driver. The counts that choose the
    features come back as one row per bucket; they are those of the rows themselves, so that
    repeated documents count in both.
    """
    usable = labels.filter(F.col(key).isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
    usable = usable.filter(~held_out(key)).select(F.col(key).alias("_id"), *[F.col(t).cast("int").alias(t) for t in TARGETS])
    chosen = stored(usable.orderBy(F.xxhash64("_id"), *TARGETS).limit(MAX_LABELS))
    rows = docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("text")).join(F.broadcast(chosen), "_id")
    rows = rows.orderBy(F.xxhash64("_id"), F.xxhash64("text"), *TARGETS).limit(MAX_LABELS)
    found = stored(rows.select(*TARGETS, "text").mapInArrow(_features, "quality int, toxic int, buckets array<int>"))
    discard(chosen)
    totals = found.agg(F.count("*"), *[F.count_if(F.col(t) > 0) for t in TARGETS]).first()
    table = (
        found.select(*TARGETS, F.explode("buckets").alias("bucket"))
        .groupBy("bucket")
        .agg(F.count("*").alias("n"), *[F.count_if(F.col(t) > 0).alias(t) for t in TARGETS])
        .toArrow()
    )
    bucket, n = table.column("bucket").to_numpy(), table.column("n").to_numpy()
    priors, weights = np.zeros(len(TARGETS)), np.zeros((len(TARGETS), BUCKETS))
    for i, t in enumerate(TARGETS):
        with_, without = totals[i + 1], totals[0] - totals[i + 1]
        priors[i] = math.log((with_ + 0.5) / (without + 0.5))
        if with_ and without:
            some = bucket[_clearest(n, table.column(t).to_numpy(), with_, without)]
            kept = found.select(t, F.array_intersect("buckets", F.lit(some.tolist()).cast("array<int>")).alias("b"))
            priors[i], weights[i, some] = _newton(kept.toArrow(), some, priors[i])
    discard(found)
    return priors, weights


def _clearest(n: np.ndarray, yes: np.ndarray, with_: int, without: int) -> np.ndarray:
    """Places of the features whose rates with and without the label differ most clearly."""
    p, q = (yes + 0.5) / (with_ + 1), (n - yes + 0.5) / (without + 1)
    error = np.sqrt(p * (1 - p) / (with_ + 1) + q * (1 - q) / (without + 1)) + 1e-12
    clear = np.abs(p - q) / error
    order = np.lexsort((np.arange(len(n)), -clear))[:MAX_FEATURES]
    return order[clear[order] >= SIGNIFICANT]


def _newton(rows: pa.Table, buckets: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """(intercept, weights) of the ridge logistic regression of a label on the given features."""
    y = (rows.column(0).to_numpy() > 0).astype(np.float64)
    place = np.full(BUCKETS, -1)
    place[buckets] = np.arange(len(buckets))
    lists = rows.column(1).combine_chunks()
    x = np.zeros((len(y), len(buckets) + 1), dtype=np.float32)
    x[:, -1] = 1
    x[np.repeat(np.arange(len(y)), lists.value_lengths().to_numpy()), place[lists.flatten().to_numpy()]] = 1
    w = np.zeros(len(buckets) + 1)
    w[-1] = prior
    ridge = np.full(len(w), RIDGE)
    ridge[-1] = 1e-3

    def loss(w: np.ndarray) -> float:
        odds = x @ w
        return float(np.logaddexp(0, odds).sum() - odds @ y + (ridge * w * w).sum() / 2)

    before = loss(w)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        curve = (x * (p * (1 - p)).astype(np.float32)[:, None]).T @ x + np.diag(ridge)
        step, size = np.linalg.solve(curve.astype(np.float64), x.T @ (y - p) - ridge * w), 1.0
        while loss(w + size * step) > before and size > 1e-6:
            size /= 2
        w = w + size * step
        after = loss(w)
        if before - after < 1e-9 * max(1.0, before):
            break
        before = after
    return float(w[-1]), w[:-1]


def _logit(p: Column) -> Column:
    inside = F.least(F.greatest(p, F.lit(EDGE)), F.lit(1 - EDGE))
    return F.ln(inside / (1 - inside))


def _expit(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _strength(groups: DataFrame, total: str, mean: Column | float) -> float:
    """How many documents the prior of a group of ``groups`` (n, total) counts for: the more the
    groups' means agree beyond chance, the more."""
    mean = F.lit(mean) if isinstance(mean, float) else mean
    share = F.col(total) / F.col("n")
    row = groups.filter("n > 1").agg(
        F.sum(F.col("n") * (share - mean) * (share - mean)),
        F.sum(mean * (1 - mean)),
        F.sum(F.col("n") * mean * (1 - mean)),
        F.sum("n"),
    ).first()
    if row[3] is None or not row[2]:
        return 10.0
    spread = max((row[0] - row[1]) / row[3], 1e-6)
    return min(max(row[2] / row[3] / spread - 1, 1.0), 1e6)


def site_quality(scored: DataFrame) -> DataFrame:
    """``scored`` (doc_id, host, path, quality_odds, toxic_odds) with site and document
    probabilities of both targets."""
    probability = {t: _expit(F.col(f"{t}_odds")) for t in TARGETS}
    paths = stored(
        scored.groupBy("host", "path").agg(F.count("*").alias("n"), *[F.sum(p).alias(t) for t, p in probability.items()])
    )
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("n"), *[F.sum(t).alias(t) for t in TARGETS]))
    totals = hosts.agg(F.sum("n"), *[F.sum(t) for t in TARGETS]).first()
    n = totals[0] or 1
    overall = {t: min(max((totals[i + 1] or 0.0) / n, EDGE), 1 - EDGE) for i, t in enumerate(TARGETS)}
    by_host = {t: _strength(hosts, t, overall[t]) for t in TARGETS}
    hosts = hosts.select(
        F.col("host").alias("_h"),
        *[((F.col(t) + by_host[t] * overall[t]) / (F.col("n") + by_host[t])).alias(f"{t}_host") for t in TARGETS],
    )
    sites = stored(paths.join(hosts, paths["host"].eqNullSafe(hosts["_h"])).drop("_h"))
    by_path = {t: _strength(sites, t, F.col(f"{t}_host")) for t in TARGETS}
    sites = sites.withColumnsRenamed({"host": "_h", "path": "_p", "n": "_n", **{t: f"_{t}" for t in TARGETS}})
    both = scored.join(sites, scored["host"].eqNullSafe(sites["_h"]) & scored["path"].eqNullSafe(sites["_p"]))

    def site(t: str) -> Column:
        # What the other documents of the path say: a document is no evidence for itself.
        others = F.greatest(F.col(f"_{t}") - probability[t], F.lit(0.0))
        return (others + by_path[t] * F.col(f"{t}_host")) / (F.col("_n") - 1 + by_path[t])

    return both.select(
        "doc_id",
        *[site(t).alias(f"site_{t}") for t in TARGETS],
        *[_expit(F.col(f"{t}_odds") + _logit(site(t)) - _logit(F.lit(overall[t]))).alias(f"p_{t}") for t in TARGETS],
    )


def classify_quality(
    docs: DataFrame,
    labels: DataFrame,
    host: Column | None = None,
    path: Column | None = None,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """One row per input row: doc_id, site_quality, site_toxic, p_quality, p_toxic, keep.

    ``labels`` (key, quality 0/1, toxic 0/1) fit the text classifier; labels with nulls, and a
    fifth of the ids for tests, are left out; without labels every text counts as even. ``host``
    and ``path`` default to source and lang; null is a site of its own. Null and empty texts are
    judged by their measured properties alone. Kept is what is more likely good than not, and
    less likely toxic than not. Repeated rows count like others; an empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, text, key))
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(
        F.col(key).alias("doc_id"),
        (F.col("source") if host is None else host).cast("string").alias("host"),
        (F.col("lang") if path is None else path).cast("string").alias("path"),
        F.col(text).cast("string").alias("text"),
    )
    scored = stored(
        source.mapInArrow(
            _scorer(sent), f"doc_id {kind}, host string, path string, quality_odds double, toxic_odds double"
        )
    )
    return site_quality(scored).withColumn("keep", (F.col("p_quality") >= 0.5) & (F.col("p_toxic") < 0.5))

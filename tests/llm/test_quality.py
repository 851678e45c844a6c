import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm.quality import classify_quality, site_quality, text_features
from tests.llm.support import documents, no_documents, odd_documents, prose

SF_DIR = os.environ.get("QUALITY_SF_DIR", "/root/testdata/sf0.1")
LABELS = "doc_id bigint, quality int, toxic int"


def made(n=400):
    given, labels = [], []
    for i in range(n):
        text = prose(i, 80)
        bad, toxic = i % 5 == 0, i % 7 == 0
        if bad:
            text = " ".join(w + "***" for w in text.split())
        if toxic:
            text += " awfulword nastyword"
        given.append((i, text, "en", f"s{i % 9}"))
        labels.append((i, int(not bad), int(toxic)))
    return given, labels


def test_junk_and_toxic_words_are_learned(spark):
    given, labels = made()
    found = {r.doc_id: r for r in classify_quality(documents(spark, given), spark.createDataFrame(labels, LABELS)).collect()}
    held = [row for row in labels if zlib.crc32(str(row[0]).encode()) % 5 == 0]
    assert len(held) > 50 and len(found) == len(given)
    assert all((found[d].p_quality >= 0.5) == (q == 1) and (found[d].p_toxic >= 0.5) == (t == 1) for d, q, t in held)
    assert all(found[d].keep == (q == 1 and t == 0) for d, q, t in held)


def test_sparse_sites_shrink_toward_their_host(spark):
    rows = [("good", "a", 3.0)] * 400 + [("good", "b", 3.0)] * 2 + [("bad", "a", -3.0)] * 400 + [("bad", "b", 3.0)]
    frame = spark.createDataFrame(
        [(i, h, p, o, -5.0) for i, (h, p, o) in enumerate(rows)],
        "doc_id bigint, host string, path string, quality_odds double, toxic_odds double",
    )
    found = {r.doc_id: r for r in site_quality(frame).collect()}
    good, few, bad, alone = (found[i] for i in (0, 400, 402, 802))
    assert good.site_quality > 0.9 and bad.site_quality < 0.1
    # Two good documents of a good host, and one that says nothing about itself on a bad host.
    assert few.site_quality > 0.8 and alone.site_quality < 0.3
    assert alone.p_quality < 1 / (1 + np.exp(-3.0)) < few.p_quality


def plain_sites(rows):
    """{doc_id: (site, posterior)} of the quality by loops over hosts and paths."""
    sigmoid = lambda x: 1 / (1 + np.exp(-x))
    logit = lambda p: np.log(p / (1 - p))
    inside = lambda p: min(max(p, 1e-4), 1 - 1e-4)
    p = {d: sigmoid(o) for d, _, _, o, _ in rows}
    overall = inside(sum(p.values()) / len(p))
    hosts, paths = {}, {}
    for d, h, q, _, _ in rows:
        hosts.setdefault(h, []).append(p[d])
        paths.setdefault((h, q), []).append(p[d])

    def strength(groups):
        several = [(values, mean) for values, mean in groups if len(values) > 1]
        if not several:
            return 10.0
        n = sum(len(v) for v, _ in several)
        spread = sum(len(v) * (np.mean(v) - m) ** 2 for v, m in several) - sum(m * (1 - m) for _, m in several)
        within = sum(len(v) * m * (1 - m) for v, m in several)
        return min(max(within / n / max(spread / n, 1e-6) - 1, 1.0), 1e6)

    a = strength([(v, overall) for v in hosts.values()])
    host = {h: (sum(v) + a * overall) / (len(v) + a) for h, v in hosts.items()}
    b = strength([(v, host[h]) for (h, _), v in paths.items()])
    out = {}
    for d, h, q, o, _ in rows:
        others = paths[h, q]
        site = (max(sum(others) - p[d], 0) + b * host[h]) / (len(others) - 1 + b)
        out[d] = (site, sigmoid(o + logit(inside(site)) - logit(overall)))
    return out


def test_host_and_path_posteriors_match_plain_loops(spark):
    rng = np.random.default_rng(1)
    rows = [
        (i, None if i % 11 == 0 else f"h{rng.integers(6)}", None if i % 13 == 0 else f"p{rng.integers(3)}", float(rng.normal(1, 3)), -2.0)
        for i in range(300)
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, host string, path string, quality_odds double, toxic_odds double")
    found = {r.doc_id: (r.site_quality, r.p_quality) for r in site_quality(frame).collect()}
    wanted = plain_sites(rows)
    assert found.keys() == wanted.keys()
    assert all(np.allclose(found[d], wanted[d], atol=1e-9) for d in wanted)


def test_repeated_documents_count_in_rates_and_totals(spark):
    given, labels = made(200)
    given = [*given, *[given[1]] * 300]
    found = {r.doc_id: r for r in classify_quality(documents(spark, given), spark.createDataFrame(labels, LABELS)).collect()}
    held = [row for row in labels if zlib.crc32(str(row[0]).encode()) % 5 == 0]
    assert sum((found[d].p_quality >= 0.5) == (q == 1) for d, q, _ in held) >= 0.9 * len(held)


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(7, 1, 0), (8, 0, 1), (None, 1, 1), (4, None, 0), (7, 1, 0)], LABELS)
    found = classify_quality(odd_documents(spark), labels).collect()
    assert len(found) == 14 and all(0 <= r.p_quality <= 1 and 0 <= r.p_toxic <= 1 for r in found)
    none = spark.createDataFrame([], LABELS)
    assert classify_quality(no_documents(spark), labels).collect() == []
    assert len(classify_quality(odd_documents(spark), none).collect()) == 14


def test_features_do_not_depend_on_the_block():
    texts = [t.encode() for t in ("a B c!!", "", "one\none\none", prose(1, 300), "\x00 é")]
    together = text_features(texts)
    assert all((a == text_features([t])[0]).all() for a, t in zip(together, texts))


@pytest.mark.skipif(not os.path.exists(SF_DIR), reason="no test tables")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels"))
    found = classify_quality(docs, labels).join(labels, "doc_id").filter(F.crc32(F.col("doc_id").cast("string")) % 5 == 0).collect()
    assert sum((r.p_quality >= 0.5) == (r.quality == 1) for r in found) >= 0.95 * len(found)
    assert sum((r.p_toxic >= 0.5) == (r.toxic == 1) for r in found) >= 0.95 * len(found)

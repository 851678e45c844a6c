"""Licence notices by MinHash bands over overlapping word windows.

Templates are sets of word pairs. For each class of template lengths a text is cut into windows
of twice that length, overlapping by half, so that some window holds any notice whole. A window
and a template become candidates when they agree in a minwise hash (a band of one row); with
``BANDS`` bands a notice is retrieved with probability 1 - (1 - J) ** BANDS, J >= 0.2 for every
template and its window: more than 0.9998. Candidates are verified by exact containment.

Everything is built from Spark's own functions and runs where the text lies. Only windows with as
many pairs of templates as the smallest template of their class must share are hashed: fewer
cannot contain one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.shared import reread, stored

#: Notices, fixed values: the wording is that of the licences' own recommended notices.
NOTICES = (
    ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-2-Clause", "licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "licensed under the BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "dedicated to the public domain under CC0 1.0"),
    ("EPL-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("ISC", "Released under the ISC License"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MPL-2.0", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("Proprietary", "All rights reserved"),
)
#: What licence files and headers say, beside the notices: the clauses that grant, and the usual
#: short forms. A licence has several; each is a template of its own.
_VERBS = ("Licensed under", "Released under", "Distributed under", "Available under")
_SHORT = (
    ("AGPL-3.0", ("the GNU AGPL v3", "the AGPL 3.0 license")),
    ("Apache-2.0", ("the Apache License, Version 2.0", "the Apache 2.0 License", "the Apache-2.0 license")),
    ("BSD-2-Clause", ("the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License")),
    ("BSD-3-Clause", ("the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License", "the Modified BSD License")),
    ("EPL-2.0", ("the Eclipse Public License 2.0", "the Eclipse Public License, version 2.0")),
    ("GPL-2.0", ("the GNU GPL v2", "the GPLv2 license")),
    ("GPL-3.0", ("the GNU GPL v3", "the GPLv3 license")),
    ("ISC", ("the ISC License",)),
    ("LGPL-3.0", ("the GNU LGPL v3", "the LGPL 3.0 license")),
    ("MIT", ("the MIT License",)),
    ("MPL-2.0", ("the Mozilla Public License 2.0", "the Mozilla Public License, version 2.0", "the MPL 2.0")),
    ("Unlicense", ("the Unlicense",)),
)
_SPDX = (
    ("AGPL-3.0", ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later")),
    ("Apache-2.0", ("Apache-2.0",)),
    ("BSD-2-Clause", ("BSD-2-Clause",)),
    ("BSD-3-Clause", ("BSD-3-Clause",)),
    ("CC-BY-4.0", ("CC-BY-4.0",)),
    ("CC-BY-NC-4.0", ("CC-BY-NC-4.0",)),
    ("CC-BY-SA-4.0", ("CC-BY-SA-4.0",)),
    ("CC0-1.0", ("CC0-1.0",)),
    ("EPL-2.0", ("EPL-2.0",)),
    ("GPL-2.0", ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later")),
    ("GPL-3.0", ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later")),
    ("ISC", ("ISC",)),
    ("LGPL-3.0", ("LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later")),
    ("MIT", ("MIT",)),
    ("MPL-2.0", ("MPL-2.0",)),
    ("Unlicense", ("Unlicense",)),
)
_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version"
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
TEXTS = (
    ("AGPL-3.0", _GNU.format("Affero General Public License", 3)),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", 'you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", _BSD),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal"),
    ("CC-BY-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("GPL-2.0", _GNU.format("General Public License", 2)),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", _GNU.format("General Public License", 3)),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("LGPL-3.0", _GNU.format("Lesser General Public License", 3)),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    *((name, f"{verb} {form}") for name, forms in _SHORT for verb in _VERBS for form in forms),
    *((name, f"SPDX-License-Identifier: {tag}") for name, tags in _SPDX for tag in tags),
)
BANDS = 40
CONTAINMENT = 0.8
#: Up to so many notices (about 20 MB with their bands) are broadcast.
MAX_BROADCAST_NOTICES = 5_000
#: Bits of the table of the pairs of all templates.
TABLE_BITS = 1 << 16


def _words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _pairs(words: str) -> Column:
    """Hash of each word of the array column and the next; of a single word nothing."""
    n = F.size(words)
    at = F.when(n > 1, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.get(F.col(words), i), F.get(F.col(words), i + 1)))


def _band_list(pairs: Column) -> Column:
    """The smallest hash of the pairs under each of BANDS hash functions."""
    numbers = F.sequence(F.lit(0), F.lit(BANDS - 1))
    return F.transform(numbers, lambda j: F.struct(j.alias("band"), F.array_min(F.transform(pairs, lambda x: F.xxhash64(x, j))).alias("value")))


def _needed(n: int, containment: float) -> int:
    """The fewest of ``n`` pairs that are a share of ``containment``; one at least."""
    return next(m for m in range(1, n + 1) if m / n >= containment or m == n)


def templates(spark: SparkSession, notices=NOTICES) -> DataFrame:
    """license, length (its class: words rounded up to a power of two), pairs: as many rows as
    there are notices of two words or more."""
    given = spark.createDataFrame([tuple(n) for n in notices], "license string, notice string")
    words = given.select("license", _words(F.col("notice")).alias("words")).filter(F.size("words") > 1)
    length = F.pow(F.lit(2), F.ceil(F.log2(F.size("words")))).cast("int")
    return words.select("license", length.alias("length"), F.array_distinct(_pairs("words")).alias("pairs"))


def scan_licenses(
    docs: DataFrame,
    notices=NOTICES + TEXTS,
    containment: float = CONTAINMENT,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """One row per document and licence found in it: doc_id, license, containment (the largest
    share of a notice's word pairs in a window), n_windows (windows that hold it), first_word
    (where the first of them starts). A text of the BSD 3-Clause licence holds the clauses of the
    2-Clause one and gives both.

    Words are runs of letters and digits in lower case. A notice whose shared pairs are all among
    those of a notice of larger share, in its window or a neighbour of it, does not count (``BY``
    within ``BY-NC``).
    Null, empty and one-word texts hold none; repeated rows are found row by row, as many times
    as they occur; an empty table gives no rows.
    """
    spark = docs.sparkSession
    # As many rows as notices, held as one small relation.
    known = templates(spark, notices).collect()
    lengths = sorted({r["length"] for r in known})
    rows = [(i, r["license"], r["length"], r["pairs"]) for i, r in enumerate(known)]
    schema = "template int, license string, length int, pairs array<bigint>"
    base = spark.createDataFrame(rows, schema)
    bands = base.select("template", F.col("length").alias("t_length"), F.explode(_band_list(F.col("pairs"))).alias("b"))
    bands = bands.select("template", "t_length", F.col("b.band").alias("t_band"), F.col("b.value").alias("t_value"))
    bits = [0] * (TABLE_BITS // 64)
    for x in {x for r in known for x in r["pairs"]}:
        at = x % TABLE_BITS
        bits[at // 64] |= 1 << (at % 64)
    table = F.array(*[F.lit(b - (1 << 64) if b >= 1 << 63 else b).cast("long") for b in bits])
    # A window that holds a template has at least so many pairs of templates.
    least = {n: min(_needed(len(r["pairs"]), containment) for r in known if r["length"] == n) for n in lengths}

    def possible(x: Column) -> Column:
        at = x.bitwiseAND(F.lit(TABLE_BITS - 1)).cast("int")
        word = F.get(F.col("table"), F.shiftright(at, 6))
        return F.bit_get(word, at.bitwiseAND(F.lit(63))) == 1

    # Words and pairs are columns of their own, so that each is made once for a text.
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    worded = docs.select(
        F.col(key).alias("doc_id"), F.monotonically_increasing_id().alias("row"), _words(body).alias("words")
    )
    paired = worded.select("doc_id", "row", _pairs("words").alias("pairs"), table.alias("table"))
    hits = paired.select(
        "doc_id",
        "row",
        "pairs",
        F.filter(F.transform("pairs", lambda x, i: F.when(possible(x), i)), lambda i: i.isNotNull()).alias("hits"),
    )

    def starts(length: int) -> Column:
        """Windows start at multiples of the length and hold twice as many words. Each that has
        enough hits is found from the first of them."""
        place = lambda i: F.floor(i / length).cast("int")
        last = lambda j: F.get(F.col("hits"), j + (least[length] - 1))
        full = F.transform(
            "hits",
            lambda i, j: F.filter(
                F.array(place(i), place(i) - 1), lambda k: (k >= 0) & (last(j) <= k * length + (2 * length - 2))
            ),
        )
        return F.transform(
            F.array_distinct(F.flatten(full)), lambda k: F.struct(F.lit(length).alias("length"), (k * length).alias("first"))
        )

    placed = F.flatten(F.array(*[starts(n) for n in lengths]))
    # Stored, for its bands and its pairs are read apart: bands move without the pairs.
    window = stored(
        hits.select("doc_id", "row", "pairs", F.explode(placed).alias("w")).select(
            "doc_id", "row", "w.length", "w.first", F.slice("pairs", F.col("w.first") + 1, F.col("w.length") * 2 - 1).alias("pairs")
        )
    )
    banded = window.select("row", "length", "first", F.explode(_band_list(F.col("pairs"))).alias("b"))
    small = len(rows) <= MAX_BROADCAST_NOTICES
    alike = (
        banded.join(
            F.broadcast(bands) if small else bands,
            (F.col("length") == F.col("t_length")) & (F.col("b.band") == F.col("t_band")) & (F.col("b.value") == F.col("t_value")),
        )
        # A licence has several templates of one length.
        .select("row", "length", "first", "template")
        .distinct()
    )
    named = base.select("template", "license", F.col("pairs").alias("t_pairs"))
    candidates = alike.join(F.broadcast(named) if small else named, "template").join(
        reread(window), ["row", "length", "first"]
    )
    shared = F.array_intersect("t_pairs", "pairs")
    share = F.size(shared) / F.size("t_pairs")
    # Stored, for it is read twice below.
    verified = stored(
        candidates.select(
            "doc_id", "row", "length", "first", "license", shared.alias("shared"), share.alias("share")
        ).filter(F.col("share") >= containment)
    )
    # A notice that lies wholly in one window may reach into its neighbours, where the rest of it
    # can look like another notice.
    near = F.array(F.col("first") - F.col("length"), F.col("first"), F.col("first") + F.col("length"))
    better = verified.select(
        F.col("row").alias("o_row"),
        F.col("length").alias("o_length"),
        F.explode(near).alias("o_first"),
        F.col("share").alias("o_share"),
        F.col("shared").alias("o_shared"),
    )
    kept = verified.join(
        better,
        (F.col("row") == F.col("o_row"))
        & (F.col("length") == F.col("o_length"))
        & (F.col("first") == F.col("o_first"))
        & (F.col("o_share") > F.col("share"))
        & (F.size(F.array_except("shared", "o_shared")) == 0),
        "left_anti",
    )
    return (
        kept.groupBy("row", "license")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.max("share").alias("containment"),
            F.count_distinct("length", "first").alias("n_windows"),
            F.min("first").cast("long").alias("first_word"),
        )
        .select("doc_id", "license", "containment", "n_windows", "first_word")
    )

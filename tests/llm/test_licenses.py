from strata.llm.licenses import NOTICES, scan_licenses
from tests.llm.support import documents, no_documents, odd_documents, prose


def result(df):
    return sorted((r.doc_id, r.license, round(r.containment, 2)) for r in df.collect())


def test_every_notice_is_found_wherever_it_stands(spark):
    given = [
        (100 * k + pad, f"{prose(pad, pad, 50)} {notice.upper()}. {prose(pad + 1, 40, 50)}")
        for k, (_, notice) in enumerate(NOTICES)
        for pad in range(0, 40, 3)
    ]
    found = {(d, name) for d, name, share in result(scan_licenses(documents(spark, given))) if share == 1.0}
    assert found >= {(100 * k + pad, name) for k, (name, _) in enumerate(NOTICES) for pad in range(0, 40, 3)}
    # A notice within a longer one is not reported beside it.
    assert len(found) == len(given)


def test_parts_and_other_words_do_not_count(spark):
    given = [
        (1, "licensed under a tree"), (2, "All rights"), (3, "Released under the MIT"), (4, prose(1, 500)), (5, "reserved all rights"),
        (6, "Licensed under CC BY-NC 4.0. All rights reserved."), (7, "licensed under the apache license version 3 0"),
    ]
    found = result(scan_licenses(documents(spark, given)))
    assert found == [(6, "CC-BY-NC-4.0", 1.0), (6, "Proprietary", 1.0)]


def test_many_in_a_long_text(spark):
    text = " ".join(f"{prose(i, 30)} Released under the MIT License." for i in range(300))
    (row,) = scan_licenses(documents(spark, [(1, text)])).collect()
    assert row.license == "MIT" and row.n_windows >= 300 and 0 <= row.first_word <= 40


def test_awkward_rows(spark):
    assert scan_licenses(odd_documents(spark)).collect() == []
    assert scan_licenses(no_documents(spark)).collect() == []
    twice = documents(spark, [(1, "All rights reserved"), (1, "All rights reserved"), (None, "All rights reserved")])
    assert [r.doc_id for r in scan_licenses(twice).collect() if r.license == "Proprietary"].count(1) == 2


def test_everything_stays_with_sparks_functions(spark):
    plan = scan_licenses(documents(spark, [(1, "x")]))._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_licence_texts_tags_and_other_verbs_are_found(spark):
    bsd = (
        "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the "
        "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.\n\n"
    )
    third = (
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.\n"
    )
    gnu = (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public "
        "License as published by the Free Software Foundation, either version {} of the License, or (at your option) any "
        "later version.\n\nThis program is distributed in the hope that it will be useful."
    )
    given = [
        (1, "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated "
            "documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation", {"MIT"}),
        (2, bsd, {"BSD-2-Clause"}), (3, bsd + third, {"BSD-2-Clause", "BSD-3-Clause"}),
        (4, "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby "
            "granted, provided that the above\ncopyright notice and this permission notice appear in all copies.", {"ISC"}),
        (5, "This is free and unencumbered software released into the public domain.", {"Unlicense"}),
        (6, "# SPDX-License-Identifier: MIT", {"MIT"}), (7, "// SPDX-License-Identifier: GPL-2.0-or-later", {"GPL-2.0"}),
        (8, "Licensed under the MIT License", {"MIT"}), (9, "Distributed under the ISC License.", {"ISC"}),
        (10, gnu.format("", 2), {"GPL-2.0"}), (11, gnu.format("", 3), {"GPL-3.0"}), (12, gnu.format("Lesser ", 3), {"LGPL-3.0"}),
        (13, "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
             "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", {"Apache-2.0"}),
        (14, "Redistribution of goods in source and binary stars", set()), (15, "SPDX-License-Identifier: BSD-3-Clause", {"BSD-3-Clause"}),
    ]
    placed = [(100 * d + pad, f"{prose(d, pad)} {text} {prose(d + 50, 40)}") for d, text, _ in given for pad in (0, 7, 30)]
    found = {}
    for d, name, _ in result(scan_licenses(documents(spark, placed))):
        found.setdefault(d, set()).add(name)
    wanted = {100 * d + pad: names for d, _, names in given for pad in (0, 7, 30) if names}
    assert {d: (found.get(d), wanted.get(d)) for d in found.keys() | wanted if found.get(d) != wanted.get(d)} == {}

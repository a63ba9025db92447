from weftline.llm.licences import NONE, NOTICES, UNKNOWN, fit_licences, scan_licences

PLAIN = ["The river ran under the bridge.", "He has a license to drive a car.", "Und mit dem alten Haus war nicht viel los."]


def test_scan(spark, odd, empty):
    lines = [(10 + i, f"{PLAIN[i % 3]}\n{notice}\n{PLAIN[0]}") for i, notice in enumerate(n for own in NOTICES.values() for n in own)]
    families = [name for name, own in NOTICES.items() for _ in own]
    rows = [*lines, (1, PLAIN[0]), (2, "\n".join(PLAIN)), (3, "Licensed under the Frobnicate License."), (4, "x " * 3000 + "Released under the MIT License. " + "y " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = fit_licences(df)
    found = {}
    for r in scan_licences(df, model).collect():
        found.setdefault(r.doc_id, []).append(r)
    right = 0
    for i, name in enumerate(families):
        own = [r for r in found.get(10 + i, []) if r.paragraph == 1]
        right += len(own) == 1 and own[0].family == name and own[0].confirmed
    assert right >= len(families) - 1
    assert 1 not in found and 2 not in found
    assert [r.family for r in found[3]] == [UNKNOWN] and not found[3][0].confirmed
    assert [r.family for r in found[4]] == ["MIT"]
    # the native scores are the model's
    for i, notice in enumerate(n for own in NOTICES.values() for n in own):
        p = model.probabilities(notice)
        best = max(p, key=p.get)
        hit = [r for r in found.get(10 + i, []) if r.paragraph == 1]
        assert (best == NONE) == (not hit)
        if hit:
            assert abs(hit[0].probability - p[best]) < 1e-9
    assert scan_licences(odd, model).count() == 0 and scan_licences(empty, model).count() == 0
    assert fit_licences(empty).probabilities("")[NONE] > 0.5


def test_wrapped_notices(spark):
    mit = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
    bsd = """Redistribution and use in source and binary
forms, with or without modification,
are permitted provided that the following
conditions are met:"""
    prose = "\n".join(PLAIN[i % 3] for i in range(80))
    rows = [(1, mit), (2, bsd), (3, f"{prose}\n{bsd}\n{prose}"), (4, prose), (5, mit.replace("\n", "\r\n"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.paragraph, r.family) for r in scan_licences(df, fit_licences(df)).collect() if r.confirmed}
    assert got == {(1, 4, "MIT"), (2, 0, "BSD"), (3, 0, "BSD"), (5, 4, "MIT")}


HELD_OUT = {
    "CC-BY-ND": ["Text licensed under CC BY-ND 4.0.", "The photo is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC-BY-NC-SA": ["Content is licensed under CC BY-NC-SA 4.0.", "These slides are licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "CC-BY-NC-ND": ["Article released under CC BY-NC-ND 4.0", "It is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "CC-BY": ["The data are licensed under CC BY 4.0", "This article is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Wiki text is licensed under CC BY-SA 4.0."],
    "CC-BY-NC": ["Pictures: licensed under CC BY-NC 4.0."],
    "Apache-1.1": ["This library is licensed under the Apache Software License, Version 1.1"],
    "Apache-2.0": ["The code is licensed under the Apache License, Version 2.0 (the License);", "// Licensed under the Apache License 2.0"],
    "MIT": ["# Licensed under the MIT License", "The project is released under the MIT license."],
    "BSD": ["* Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "GPL": ["The game is licensed under the GNU General Public License, version 3.", "You should have received a copy of the GNU General Public License along with this program. If not, write to us."],
    "LGPL": ["It is licensed under the GNU Lesser General Public License."],
    "MPL-2.0": ["This file is subject to the terms of the Mozilla Public License, v. 2.0."],
    "Proprietary": ["Copyright 2020 Some Firm. All rights reserved."],
}
#: Near to notices, and of none of the families.
NOT_SO = [
    "This program is not licensed under the GNU General Public License.",
    "The code is no longer released under the MIT License.",
    "All rights reserved to the people of the town.",
    "Licensed under the MIT License with the Commons Clause.",
    "This isn't licensed under CC BY 4.0.",
    "Licensed under the Mozilla Public License, Version 1.1.",
    "The library is not distributed under the BSD License.",
    "It was never released under the Apache License 2.0.",
]


def test_held_out_notices_and_what_only_looks_like_them(spark):
    notices = [(name, text) for name, own in HELD_OUT.items() for text in own]
    rows = [(i, f"{PLAIN[0]}\n\n{text}\n\n{PLAIN[1]}") for i, (_, text) in enumerate(notices)] + [(500 + i, text) for i, text in enumerate(NOT_SO + PLAIN)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = [r for r in scan_licences(df, fit_licences(df)).collect() if r.confirmed]
    right = [r for r in found if r.doc_id < 500 and r.family == notices[r.doc_id][0]]
    wrong = [(r.family, rows[[i for i, _ in rows].index(r.doc_id)][1]) for r in found if r not in right]
    assert not wrong  # precision
    missed = [n for i, n in enumerate(notices) if i not in {r.doc_id for r in right}]
    assert len(missed) <= 0.1 * len(notices), missed  # recall

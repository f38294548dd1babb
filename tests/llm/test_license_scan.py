import re
import textwrap

from noticeworks.llm import license_scan as L

MIT = """Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_3 = BSD_2.replace("1. ", "(a) ").replace("2. ", "(b) ") + "\n(c) Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
REAL = {
    MIT: "MIT",
    BSD_2: "BSD-2-Clause",
    BSD_3: "BSD-3-Clause",
    APACHE: "Apache-2.0",
    GNU.format("General Public License"): "GPL-3.0",
    GNU.format("Lesser General Public License"): "LGPL-3.0",
    GNU.format("Affero General Public License"): "AGPL-3.0",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.": "GPL-2.0",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.": "LGPL-2.1",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.": "MPL-2.0",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.": "ISC",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
    "This work is licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.": "CC-BY-NC-SA-4.0",
}


def wrapped(text, mark=""):
    return "\n".join(mark + line for part in text.split("\n") for line in (textwrap.wrap(part, 72, break_on_hyphens=False) or [""]))


FORMS = [lambda t: t, wrapped, lambda t: wrapped(t, " * "), lambda t: wrapped(t, "# "), lambda t: f"The licence\n{wrapped(t)}\nAnd more prose\nfollows."]
TEXTS = [f(t) for t in REAL for f in FORMS] + [
    None, "", "plain text here.", "Some prose. Released under the MIT License. More prose.", "licensed under the apache license, version 2.0!\nAll Rights Reserved;",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.\nmore\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "Redistributions in binary form must reproduce the above copyright notice.\nRedistributions of source code must retain the above copyright notice.",
    "Redistributions of source code must retain the above copyright notice. x. Redistributions in binary form must reproduce the above copyright notice. Neither the name of the copyright holder nor the names of its contributors may be used.",
    "Released under the MIT License. Released under the MIT License.", "not released under the MIT license at all", "All rights reserved" + " x" * 50000,
    "Licensed under CC BY-NC 4.0.\nThis work is licensed under the GNU General Public License, version 3.",
]


def brute(text):
    found, sentence = [], []
    # sentences as lists of lines: a blank line, or punctuation before white space, ends one
    sentences = []
    for part in re.split(r"(?<=\n)(?=[^A-Za-z0-9\n]*\n)", (text or "").replace("\x01", "")):
        sentences += [x.split("\n") for x in re.split(r"[.!?;]+(?=\s|$)", part)]
    for sentence in sentences:
        for i, line in enumerate(sentence):
            for s in ("\n".join(sentence[i:]), line) if L.normal(line) else ():
                if L.normal(s) in L.SENTENCES:
                    found.append(L.SENTENCES[L.normal(s)])
                    break

    def follows(rule):
        it = iter(found)
        return all(x in it for x in rule)

    hits = [(n, r) for n, r in sorted(L.RULES, key=lambda r: -len(r[1])) if follows(r)]
    kept = [n for n, r in hits if not any(len(q) > len(r) and set(r) <= set(q) for _, q in hits)]
    kept = list(dict.fromkeys(kept))
    return found, [n for n in kept if n != "Proprietary"] or kept


def test_against_brute_force(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, license string").repartition(3)
    for r in L.scan_licenses(df).collect():
        ids, names = brute(TEXTS[r["doc_id"]])
        assert (r["sentence_ids"], r["licenses"], r["license"], r["n_licenses"]) == (ids, names, names[0] if names else None, len(names))
    assert L.scan_licenses(df.limit(0)).collect() == []


def test_real_licence_texts_are_recognised(spark):
    rows = [(i, f(t), name) for i, (t, name, f) in enumerate((t, n, f) for t, n in REAL.items() for f in FORMS)]
    for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, name string").repartition(3)).collect():
        assert r["license"] == r["name"] and r["n_licenses"] == 1, (r["doc_id"] % len(FORMS), r["name"], r["sentence_ids"])


def test_files_as_they_are_found(spark):
    """What people's files hold, written out here apart from the operator's tables."""
    bsd = 'Copyright (c) 2019, Some Body\nAll rights reserved.\n\n' + BSD_2 + '\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.'
    apache = '                                 Apache License\n                           Version 2.0, January 2004\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n   1. Definitions.\n\n      "License" shall mean the terms and conditions for use, reproduction,\n      and distribution as defined by Sections 1 through 9 of this document.\n'
    gpl = "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n  The GNU General Public License is a free, copyleft license for\nsoftware and other kinds of works.\n"
    want = [
        (bsd, ["BSD-2-Clause"]), (apache, ["Apache-2.0"]), (gpl, ["GPL-3.0"]), ("// SPDX-License-Identifier: Apache-2.0\nint main;", ["Apache-2.0"]), ("# SPDX-License-Identifier: GPL-2.0-or-later", ["GPL-2.0"]),
        ("Notes.\nThis code is MIT licensed.\nMore.", ["MIT"]), ("All rights reserved.", ["Proprietary"]), ("We reserve all rights to change this.", []), ("SPDX-License-Identifier: CC-BY-SA-4.0", ["CC-BY-SA-4.0"]),
        ("This is free and unencumbered software released into the public domain.", ["Unlicense"]), (wrapped(apache, "// "), ["Apache-2.0"]),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(want)], "doc_id long, text string")
    got = {r["doc_id"]: r["licenses"] for r in L.scan_licenses(df).collect()}
    assert [got[i] for i in range(len(want))] == [names for _, names in want]


def test_callers_table_and_working_names(spark):
    df = spark.createDataFrame([(1, "Use \"as\" is. x", 2)], "doc_id long, text string, known int")
    got = L.scan_licenses(df, sentences={"use as is": "it's \"so\""}, rules=[("Own", ["it's \"so\""])]).first()
    assert got["license"] == "Own" and got["known"] == 2

"""License scans: sentence-rule recognition.

A text is cut into sentences, which are normalised and mapped to identifiers of known licence
sentences; the identifiers, in the order of the text, are matched against ordered licence rules (a
rule's identifiers must follow one another in the sequence, other sentences between them aside).
The longest rules are taken first. A line feed does not end a sentence: at each of its lines, what is left of
the sentence from there on is looked up and, if it isn't known, the line alone. So sentences are found
whether a licence is wrapped, commented out (the marks before each line are no words), under a heading or
on a line of its own. Everything is a row-wise expression of built-in functions: no shuffle, no Python. The
two tables are fixed and small; they are constants of the plan.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentences of licence texts and notices, by identifier.
TEXTS = {
    "reserved": ["All rights reserved"],
    "mit-grant": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "mit-notice": [
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software.",
    ],
    "isc-grant": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "bsd-source": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions of source code must retain the above copyright notice",
    ],
    "bsd-binary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Redistributions in binary form must reproduce the above copyright notice",
    ],
    "bsd-name": [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Neither the name of the copyright holder nor the names of its contributors may be used",
        "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "apache-2": ["Licensed under the Apache License, Version 2.0 (the \"License\")"],
    "apache-use": ["you may not use this file except in compliance with the License."],
    "apache-copy": ["You may obtain a copy of the License at", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0"],
    "free-program": ["This program is free software", "This file is free software"],
    "free-library": ["This library is free software"],
    "gpl-terms": ["you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "lgpl-terms": ["you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "version-2": ["either version 2 of the License, or (at your option) any later version."],
    "version-2.1": ["either version 2.1 of the License, or (at your option) any later version."],
    "version-3": ["either version 3 of the License, or (at your option) any later version."],
    "mpl-2": ["This Source Code Form is subject to the terms of the Mozilla Public License, v"],
    # sentences of the licences themselves
    "apache-2-text": ["\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document."],
    "gpl-2-text": ["The licenses for most software are designed to take away your freedom to share and change it."],
    "gpl-3-text": ["The GNU General Public License is a free, copyleft license for software and other kinds of works."],
    "agpl-3-text": ["The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software."],
    "lgpl-3-text": ["This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below."],
    "mpl-2-text": ["\"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software."],
    "unlicense-text": ["This is free and unencumbered software released into the public domain."],
    # disclaimers, which several licences share
    "mit-disclaimer": ["THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."],
    "bsd-disclaimer": [f"THIS SOFTWARE IS PROVIDED BY THE {who} \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED." for who in ("COPYRIGHT HOLDERS AND CONTRIBUTORS", "AUTHOR AND CONTRIBUTORS", "AUTHOR", "REGENTS AND CONTRIBUTORS")],
}
#: What grants under a version 3 of the GNU licences, in one sentence.
GNU_3 = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
GNU = {"gpl-3": "General Public License", "lgpl-3": "Lesser General Public License", "agpl-3": "Affero General Public License"}
#: Names of licences in statements, and how such statements begin.
NAMES = {
    "mit-release": ["the MIT License", "the terms of the MIT License", "MIT"],
    "apache-2": ["the Apache License, Version 2.0", "the Apache License 2.0", "the terms of the Apache License, Version 2.0", "Apache 2.0"],
    "gpl-2": ["the GNU General Public License, version 2", "the GNU GPL v2"],
    "gpl-3": ["the GNU General Public License, version 3", "the GNU General Public License v3.0", "the GNU GPL v3"],
    "lgpl-3": ["the GNU Lesser General Public License, version 3"],
    "agpl-3": ["the GNU Affero General Public License, version 3"],
    "mpl-2": ["the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0"],
    "bsd-3-release": ["the BSD 3-Clause License", "the 3-Clause BSD License"],
    "bsd-2-release": ["the BSD 2-Clause License", "the 2-Clause BSD License"],
    "isc-release": ["the ISC License"],
    "cc-0": ["CC0 1.0", "CC0 1.0 Universal"],
}
CC = {"cc-by-4": ("BY", "Attribution"), "cc-by-sa-4": ("BY-SA", "Attribution-ShareAlike"), "cc-by-nc-4": ("BY-NC", "Attribution-NonCommercial"), "cc-by-nd-4": ("BY-ND", "Attribution-NoDerivatives"), "cc-by-nc-sa-4": ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), "cc-by-nc-nd-4": ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")}
#: Licences by their SPDX identifiers, and how short names stand in statements such as "This code is MIT licensed".
SPDX = {
    "mit-release": ["MIT"], "isc-release": ["ISC"], "apache-2": ["Apache-2.0"], "gpl-2": ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later"], "gpl-3": ["GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"],
    "lgpl-3": ["LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"], "agpl-3": ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"], "mpl-2": ["MPL-2.0"], "bsd-2-release": ["BSD-2-Clause"], "bsd-3-release": ["BSD-3-Clause"],
    "cc-0": ["CC0-1.0"], "unlicense-text": ["Unlicense"],
}
SHORT = {"mit-release": "MIT", "isc-release": "ISC", "apache-2": "Apache 2.0", "gpl-2": "GPLv2", "gpl-3": "GPLv3", "lgpl-3": "LGPLv3", "agpl-3": "AGPLv3", "mpl-2": "MPL 2.0"}
SUBJECTS = ["this code is", "this project is", "this software is", "this library is", "the code is"]
BEGINNINGS = ["licensed under", "released under", "distributed under", "this work is licensed under", "this project is licensed under", "this software is released under"]
#: Ordered rules; (licence, the identifiers in order).
RULES = [
    ("BSD-3-Clause", ["bsd-source", "bsd-binary", "bsd-name"]),
    ("BSD-2-Clause", ["bsd-source", "bsd-binary"]),
    ("Apache-2.0", ["apache-2", "apache-use", "apache-copy"]),
    ("GPL-2.0", ["free-program", "gpl-terms", "version-2"]),
    ("GPL-3.0", ["free-program", "gpl-terms", "version-3"]),
    ("LGPL-2.1", ["free-library", "lgpl-terms", "version-2.1"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("ISC", ["isc-grant"]),
    ("Apache-2.0", ["apache-2"]),
    ("MIT", ["mit-release"]),
    ("GPL-3.0", ["gpl-3"]),
    ("GPL-2.0", ["gpl-2"]),
    ("LGPL-3.0", ["lgpl-3"]),
    ("AGPL-3.0", ["agpl-3"]),
    ("BSD-3-Clause", ["bsd-3-release"]),
    ("BSD-2-Clause", ["bsd-2-release"]),
    ("ISC", ["isc-release"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-ND-4.0", ["cc-by-nd-4"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa-4"]),
    ("CC-BY-NC-ND-4.0", ["cc-by-nc-nd-4"]),
    ("CC0-1.0", ["cc-0"]),
    ("MPL-2.0", ["mpl-2"]),
    ("Apache-2.0", ["apache-2-text"]),
    ("GPL-2.0", ["gpl-2-text"]),
    ("GPL-3.0", ["gpl-3-text"]),
    ("AGPL-3.0", ["agpl-3-text"]),
    ("LGPL-3.0", ["lgpl-3-text"]),
    ("MPL-2.0", ["mpl-2-text"]),
    ("Unlicense", ["unlicense-text"]),
    ("Proprietary", ["reserved"]),
]
#: Licences that are none beside another: "All rights reserved" stands in many open licences' copyright lines.
ALONE = ("Proprietary",)
#: A word of a sentence; a list mark before a line; a sentence's end; a line without a letter or digit; what separates sentences then.
WORD, MARK, END, BLANK, CUT = "[a-z0-9]+(?:[.+-]+[a-z0-9]+)*", r"^[^A-Za-z0-9]*[0-9A-Za-z]{1,2}\)\s*", r"[.!?;]+(\s|$)", r"\n[^A-Za-z0-9\n\x01]*\n", "\x01"


def normal(sentence: str) -> str:
    return " ".join(re.findall(WORD, re.sub(MARK, "", sentence).lower()))


def known_sentences() -> dict[str, str]:
    """Every known sentence, normalised, with its identifier; statements are made from their beginnings and the licences' names."""
    out = {normal(s): k for k, sentences in TEXTS.items() for s in sentences}
    out |= {normal(GNU_3.format(name)): k for k, name in GNU.items()}
    names = {k: list(v) for k, v in NAMES.items()}
    for k, (short, long) in CC.items():
        names[k] = [f"CC {short} 4.0", f"CC-{short}-4.0", *(f"{a} Creative Commons {long} 4.0 International{b}" for a in ("a", "the") for b in (" License", " Public License"))]
    out |= {normal(f"{b} {n}"): k for k, found in names.items() for n in found for b in BEGINNINGS}
    out |= {normal(f"SPDX-License-Identifier: {n}"): k for k, found in (SPDX | {k: [f"CC-{short}-4.0"] for k, (short, _) in CC.items()}).items() for n in found}
    return out | {normal(f"{b} {n} licensed"): k for k, n in SHORT.items() for b in SUBJECTS}


SENTENCES = known_sentences()


def known_ids(text: Column, known: dict[str, str]) -> Column:
    """The identifiers of the known sentences of a text, in order."""
    firsts = sorted({k.split(" ")[0] for k in known})
    longest = max(len(k.split(" ")) for k in known)
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    marked = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), END, CUT + "$1"), BLANK, CUT)
    words_of = lambda s: F.array_join(F.regexp_extract_all(F.lower(F.regexp_replace(s, MARK, "")), F.lit(WORD), F.lit(0)), " ")
    # only where a known sentence's first word stands; a sentence can't have more lines with words than words
    may_start = lambda s: s.rlike(rf"(?i)^[^A-Za-z0-9]*(?:[0-9A-Za-z]{{1,2}}\)\s*)?(?:{'|'.join(map(re.escape, firsts))})(?:[^A-Za-z0-9]|$)")

    def of_sentence(sentence: Column) -> Column:
        lines = F.split(sentence, "\n")
        at = lambda x, i: F.coalesce(F.when(F.size(lines) - i <= 2 * longest, F.element_at(table, words_of(F.array_join(F.slice(lines, i + 1, F.size(lines)), "\n")))), F.element_at(table, words_of(x)))
        return F.transform(lines, lambda x, i: F.when(may_start(x), at(x, i)))

    sentences = F.filter(F.split(marked, CUT), lambda s: s.rlike(rf"(?i)\b(?:{'|'.join(map(re.escape, firsts))})\b"))
    return F.array_compact(F.flatten(F.transform(sentences, of_sentence)))


def scan_licenses(df: DataFrame, text_col: str = "text", sentences: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """df with sentence_ids (array: the known sentences in order), licenses (array: one entry for each rule
    matched, longest rules first, then in the order of `rules`, without repeats; those of ALONE only where there is no other), license
    (the first, or null) and n_licenses. Columns of these names are replaced, others stay. `sentences` are normalised as
    normal() does. Null, empty and plain texts have empty arrays; repeated rows are scanned alike; an empty table gives no rows."""
    known, rules = sentences or SENTENCES, rules or RULES
    sequence = F.concat(F.lit("|"), F.array_join("sentence_ids", "|"), F.lit("|"))
    ordered = sorted(rules, key=lambda r: -len(r[1]))

    def fits(rule: list[str]) -> Column:
        if len(rule) == 1:
            return F.array_contains("sentence_ids", rule[0])
        return sequence.rlike(_pattern(rule))

    covered = lambda k: [fits(r) for _, r in ordered[:k] if len(r) > len(ordered[k][1]) and set(ordered[k][1]) <= set(r)]
    one = [F.when(reduce(lambda a, b: a & ~b, covered(k), fits(rule)), F.lit(name)) for k, (name, rule) in enumerate(ordered)]
    out = df.withColumn("sentence_ids", known_ids(F.col(text_col), known)).withColumn("licenses", F.array_distinct(F.array_compact(F.array(*one))))
    others = F.filter("licenses", lambda x: ~x.isin(*ALONE))
    out = out.withColumn("licenses", F.when(F.size(others) > 0, others).otherwise(F.col("licenses")))
    return out.withColumns({"license": F.get("licenses", F.lit(0)), "n_licenses": F.size("licenses").cast("long")})


def _pattern(rule: list[str]) -> str:
    return r"\|" + r"\|(?:[^|]+\|)*?".join(map(re.escape, rule)) + r"\|"


def op2_license_scan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = scan_licenses(docs)
    return out.select("doc_id", F.array_join("sentence_ids", "|").alias("sentence_ids"), F.array_join("licenses", "|").alias("licenses"), "license", "n_licenses")


_values = ", ".join(f"('{k}', '{v}')" for k, v in SENTENCES.items())
_ordered = sorted(RULES, key=lambda r: -len(r[1]))
_fits = [f"regexp_matches(seq, '{_pattern(r)}')" for _, r in _ordered]
_tests = []
for _k, (_name, _rule) in enumerate(_ordered):
    _longer = [f" and not {_fits[_i]}" for _i in range(_k) if len(_ordered[_i][1]) > len(_rule) and set(_rule) <= set(_ordered[_i][1])]
    _tests.append(f"case when {_fits[_k]}{''.join(_longer)} then '{_name}' end")
_longest = max(len(k.split(" ")) for k in SENTENCES)
_norm = lambda x: f"array_to_string(regexp_extract_all(lower(regexp_replace({x}, '{MARK}', '')), '{WORD}'), ' ')"
OP2_SQL = rf"""
with known(s, id) as (values {_values}),
cut as (
    select doc_id, string_split(unnest(ss), e'\n') as lines, generate_subscripts(ss, 1) as pos
    from (select doc_id, string_split(regexp_replace(regexp_replace(coalesce(text, ''), '{END}', e'\x01\\1', 'g'), '{BLANK}', e'\x01', 'g'), e'\x01') as ss from documents)
), spots as (
    select doc_id, pos, i, {_norm('lines[i]')} as one,
           case when len(lines) - i + 1 <= {2 * _longest} then {_norm("array_to_string(lines[i:], e'\n')")} end as rest
    from (select *, generate_subscripts(lines, 1) as i from cut)
), found as (
    select doc_id, pos, i, coalesce(a.id, b.id) as id from spots left join known a on a.s = spots.rest left join known b on b.s = spots.one where one <> '' and (a.id is not null or b.id is not null)
), seqs as (
    select d.doc_id, coalesce(string_agg(id, '|' order by pos, i), '') as ids, '|' || coalesce(string_agg(id, '|' order by pos, i), '') || '|' as seq
    from documents d left join found f on d.doc_id = f.doc_id group by d.doc_id
), named as (
    select doc_id, ids, list_filter([{', '.join(_tests)}], lambda x: x is not null) as ls from seqs
), once as (
    select doc_id, ids, list_filter(ls, lambda x, i: list_position(ls, x) = i and (x not in ({', '.join(f"'{x}'" for x in ALONE)}) or len(list_filter(ls, lambda y: y not in ({', '.join(f"'{x}'" for x in ALONE)}))) = 0)) as ls from named
)
select doc_id, ids as sentence_ids, array_to_string(ls, '|') as licenses, ls[1] as license, cast(len(ls) as bigint) as n_licenses from once
"""

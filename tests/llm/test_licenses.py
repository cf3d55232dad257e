import random
import re

import fixtures as X
import pytest

from hydrolens.llm import licenses as L
from hydrolens.sources.folders import RunFolder


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", X.ascii_lower(text or ""))


def shingles(words):
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def brute(rows):
    """Every window of every text against every template by exact sets."""
    out = []
    for key, text in rows:
        at, best = shingles(terms(text)), {}
        for name, notice in L.TEMPLATES:
            words = terms(notice)
            wanted, stride = set(shingles(words)), max(1, len(words) // 4)
            reach = len(shingles(words)) + stride - 1
            for start in range(0, len(at), stride):
                part = len(wanted & set(at[start : start + reach])) / len(wanted)
                if part >= L.LEAST:
                    best.setdefault(name, []).append((-part, start))
        out += [(key, name, len({s for _, s in found}), -min(found)[0], min(found)[1]) for name, found in best.items()]
    return sorted(out, key=str)


def texts():
    rng = random.Random(12)
    found = X.awkward_texts()
    for _, notice in L.TEMPLATES:
        words = notice.split()
        found.append(X.sentence(rng, rng.randrange(40)) + " " + notice.upper() + "\n" + X.sentence(rng, rng.randrange(30)))
        for drop in (1, 3):
            cut = [w for i, w in enumerate(words) if i not in rng.sample(range(len(words)), min(drop, len(words) - 1))]
            found.append(X.sentence(rng, 7) + " " + " ".join(cut) + " " + X.sentence(rng, 9))
        found.append(X.sentence(rng, 20) + " " + " ".join(words[: len(words) * 9 // 10]))
        found.append(notice + " " + X.sentence(rng, 300) + " " + notice)
    return found


def result(docs):
    scanned = L.scan(docs, L.templates(docs.sparkSession), RunFolder(docs.sparkSession))
    return sorted(map(tuple, scanned.collect()), key=str)


@pytest.mark.parametrize("constant", [0, 20_000])
def test_equals_brute_force(spark, monkeypatch, constant):
    monkeypatch.setattr(L, "CONSTANT_SHINGLES", constant)
    docs = X.documents(spark, texts(), extra=True)
    found = result(docs)
    assert found == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert {r[1] for r in found} == {name for name, _ in L.TEMPLATES}


def test_query_empty_repeated_and_native(spark, tmp_path):
    docs = spark.createDataFrame([(None, "Released under the MIT License."), (4, "Released under the MIT License."), (4, None), (4, "released under the mit license")], "doc_id long, text string")
    scanned = L.document_licenses(spark, X.folder_of(tmp_path, documents=docs))
    assert sorted((str(r.doc_id), r.license, r.containment, r.first_word) for r in scanned.collect()) == [("4", "MIT", 1.0, 0)] * 2 + [("None", "MIT", 1.0, 0)]
    assert not re.search("Python|Arrow|Cartesian", scanned._jdf.queryExecution().toString())
    assert result(docs.limit(0)) == []
    assert L.scan(docs, L.templates(spark).limit(0), RunFolder(spark)).collect() == []


GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
LINE = "This work is licensed under the GNU {}General Public License, version {}."
VERSIONS = [("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3")]
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
{}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
FOURTH = "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization. " + THIRD.replace("3.", "4.")
FEE = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{}. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES"
# Clauses of full texts that name other licenses.
MPL = 'Mozilla Public License Version 2.0. This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "Secondary License" means either the GNU General Public License, Version 2.0, the GNU Lesser General Public License, Version 2.1, the GNU Affero General Public License, Version 3.0, or any later versions of those licenses.'
LGPL = "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999. You must alter all the notices so that they refer to the ordinary GNU General Public License, version 2, instead of to this License."
GPL = "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007. You have permission to link or combine any covered work with a work licensed under version 3 of the GNU Affero General Public License into a single combined work"


def test_versions_and_sisters_are_told_apart(spark):
    cases = [(form.format(kind, version), {name}) for form in (GNU, LINE) for name, kind, version in VERSIONS]
    cases += [(BSD.format(more), {"BSD", name}) for name, more in (("BSD-2-Clause", ""), ("BSD-3-Clause", THIRD), ("BSD-4-Clause", FOURTH))]
    cases += [(FEE.format(", provided that the above copyright notice and this permission notice appear in all copies"), {"ISC", "ISC or 0BSD"}), (FEE.format(""), {"0BSD", "ISC or 0BSD"})]
    cases += [(MPL, {"MPL-2.0"}), (LGPL, {"LGPL-2.1"}), (GPL, {"GPL-3.0"})]
    found = {}
    for key, name, *_ in result(spark.createDataFrame(list(enumerate(text for text, _ in cases)), "doc_id long, text string")):
        found.setdefault(key, set()).add(name)
    assert [(text[:200], found.get(i), want) for i, (text, want) in enumerate(cases) if found.get(i) != want] == []


def test_no_template_holds_enough_of_another_license():
    listed = [(name, set(shingles(terms(text)))) for name, text in L.TEMPLATES]
    assert [(a, b) for a, x in listed for b, y in listed if a != b and len(x & y) >= L.LEAST * len(x)] == []

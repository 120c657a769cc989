import re
import textwrap

import duckdb

from sievework.llm.licenses import OP9_SQL, RULES, SENTENCES, WORDINGS, license_scan, op9


def plain(text):
    lines = re.sub(r"[.!?;][ \t]+", "\n", text or "").replace("\r", "\n")
    s = [re.sub("[^a-z0-9]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), x)).strip() for x in lines.split("\n")]
    ids = [SENTENCES.index(x) + 1 for x in s if x in SENTENCES]
    left, found = list(ids), set()
    for name, rule in RULES:
        i = 0
        while i + len(rule) <= len(left):
            if tuple(left[i : i + len(rule)]) == rule:
                found.add(name)
                left[i : i + len(rule)] = [0]
            i += 1
    return ids, sorted(found)


def texts():
    say = [s.capitalize().replace(" 2 0", " 2.0") + "." for s in SENTENCES]
    apache = "Licensed under the Apache License, Version 2.0. You may not use this file except in compliance with the License."
    bsd = "\n".join(say[8:12])
    return [None, "", " \n ", apache, bsd, "\n".join(say[8:11]), "\r\n".join(say), apache + "\n" + apache, "x " + say[4], "Some words.\n" + say[4] + " More words.", "Released under the MIT License.\nLicensed under CC BY-NC 4.0.", "é " * 5000 + "\n" + say[12], say[5] + " " + say[6] + " " + say[7], "ALL RIGHTS RESERVED", "Licensed; under the apache license"]


def test_same_as_plain_matching(spark):
    rows = [(i, t, 1, "z") for i, t in enumerate(texts())] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, licenses int, k string")
    got = sorted((r.doc_id, list(r.sentence_ids), list(r.licenses)) for r in license_scan(df).collect())
    assert got == sorted((i, *plain(t)) for i, t, *_ in rows)
    assert license_scan(df.limit(0)).collect() == []


def test_same_as_sql(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts())]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    for at, path in ((str(tmp_path), f"{tmp_path}/documents.parquet/*.parquet"), ("/root/testdata/sf0.01", "/root/testdata/sf0.01/documents.parquet")):
        con.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{path}'")
        want = con.sql(f"SELECT doc_id, n_sentences, sentence_ids, licenses FROM ({OP9_SQL})").fetchall()
        assert sorted(map(tuple, op9(spark, at).select("doc_id", "n_sentences", "sentence_ids", "licenses").collect())) == sorted(want)
    assert sum(bool(x[3]) for x in want) > 20


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE."""
BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD3 = BSD2 + "\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
GPL3 = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
GPL2 = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS."""


MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"""
UNLICENSE = "This is free and unencumbered software released into the public domain."
LGPL = "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
AGPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
EPL = "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
MORE = [
    (MPL, [MPL.split(". ")[0], "2 0", MPL.split(". ")[2]], "MPL-2.0"),
    (ISC, [ISC], "ISC"),
    (ZLIB, [ZLIB.split(". ")[0], ZLIB.split(". ")[1].split("\n")[0], ZLIB.split("\n\n")[1]], "Zlib"),
    (UNLICENSE, [UNLICENSE], "Unlicense"),
    (LGPL, LGPL.split("; ")[1:], "LGPL-2.1-or-later"),
    (AGPL, [AGPL], "AGPL-3.0-or-later"),
    (EPL, [EPL], "EPL-2.0"),
    (BSD3 + "\n" + DISCLAIMER, [*BSD3.replace("\n1. ", "\n").replace("\n2. ", "\n").replace("\n3. ", "\n").strip().split("\n\n"), *re.split("[.;] ", DISCLAIMER)], "BSD-3-Clause"),
    ("SPDX-License-Identifier: GPL-2.0-or-later", ["spdx license identifier gpl 2 0 or later"], "GPL-2.0-or-later"),
    ("SPDX-License-Identifier: MIT", ["spdx license identifier mit"], "MIT"),
]


def ids(*sentences):
    """Identifiers of sentences in their own wording."""
    known = {x: i + 1 for i, x in enumerate(SENTENCES)} | dict(WORDINGS)
    return [known[re.sub("[^a-z0-9]+", " ", x.lower()).strip()] for x in sentences]


def test_real_texts_wrapped_and_unwrapped(spark):
    want = [(MIT, [6, 7, 8], ["MIT"]), (BSD2, [9, 10, 11], ["BSD-2-Clause"]), (BSD3, [9, 10, 11, 12], ["BSD-3-Clause"]), (GPL3, ids(GPL3), ["GPL-3.0-or-later"]), (GPL2, ids(*GPL2.split("; ")[1:]), ["GPL-2.0-or-later"]), (APACHE, [2, 3, 4], ["Apache-2.0"])]
    want += [(t, ids(*named), [name]) for t, named, name in MORE]
    cases = []
    for text, numbers, names in want:
        for width in (None, 70, 80):
            wrapped = "\n".join(textwrap.fill(p, width, initial_indent="# ", subsequent_indent="# ") for p in text.split("\n\n")) if width else text
            cases += [(wrapped, numbers, names), ("Copyright 2020 A Person\n\n" + wrapped.replace("\n", "\r\n"), numbers, names)]
    cases += [("Not so: " + GPL3, [], []), (MIT.replace("free of charge", "at a price"), [7, 8], [])]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: (list(r.sentence_ids), list(r.licenses)) for r in license_scan(df).collect()}
    assert got == {i: (numbers, names) for i, (_, numbers, names) in enumerate(cases)}

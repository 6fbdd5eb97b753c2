"""Licence scans by sentence rules, DataFrame operations only.

A text falls apart into sentences, after . ! or ? before white space and at
lines without an ASCII letter or digit. Any other line end may end a sentence
or be white space within it, comment marks and all: a known licence sentence
is found where it makes up a run of whole lines, or of such lines and the
parts of lines before and after them; of those that begin at one place the
longest counts, and what it covers is used up. The identifiers of a text, in
order, are then matched against an ordered list of rules. A rule is a run of
identifiers; what it matches is used up, so a longer rule placed before a
shorter one wins. Nothing is shuffled.
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcheck.llm.common import free_name

# Known sentences of public licence texts and notices, normalised
# as normal() does it, with the identifier that rules use.
SENTENCES = {
    "released under the mit license": "mit-ref",
    "licensed under the mit license": "mit-ref",
    "spdx license identifier mit": "mit-ref",
    "mit license": "mit-title",
    "the mit license": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit-liability",
    "licensed under the apache license version 2 0": "apache-2-ref",
    "licensed under the apache license version 2 0 the license": "apache-2-ref",
    "spdx license identifier apache 2 0": "apache-2-ref",
    "you may not use this file except in compliance with the license": "apache-2-use",
    "you may obtain a copy of the license at": "apache-2-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache-2-warranty",
    "see the license for the specific language governing permissions and limitations under the license": "apache-2-see",
    "this work is licensed under the gnu general public license version 3": "gpl-3-ref",
    "licensed under the gnu general public license version 3": "gpl-3-ref",
    "spdx license identifier gpl 3 0 only": "gpl-3-ref",
    "spdx license identifier gpl 3 0 or later": "gpl-3-plus-ref",
    "licensed under the gnu general public license version 2": "gpl-2-ref",
    "spdx license identifier gpl 2 0 only": "gpl-2-ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3-plus-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl-2-plus-grant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "see the gnu general public license for more details": "gpl-see",
    "you should have received a copy of the gnu general public license along with this program": "gpl-copy",
    "licensed under cc by nc 4 0": "cc-by-nc-4-ref",
    "licensed under cc by 4 0": "cc-by-4-ref",
    "licensed under cc by sa 4 0": "cc-by-sa-4-ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4-ref",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-4-ref",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc-4-ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-endorse",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "bsd-warranty",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2-ref",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl-2-copy",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "reserved",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache-2-notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "gpl-2-grant",
    "if not see https www gnu org licenses": "gnu-address",
    "if not see http www gnu org licenses": "gnu-address",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "lgpl-21-plus-grant",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl-3-plus-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl-3-plus-grant",
    "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "see the gnu lesser general public license for more details": "lgpl-see",
    "you should have received a copy of the gnu lesser general public license along with this library": "lgpl-copy",
    "you should have received a copy of the gnu lesser general public license along with this program": "lgpl-copy",
    "you should have received a copy of the gnu lesser general public license along with this library if not write to the free software foundation inc 51 franklin street fifth floor boston ma 02110 1301 usa": "lgpl-copy",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl-3-plus-grant",
    "see the gnu affero general public license for more details": "agpl-see",
    "you should have received a copy of the gnu affero general public license along with this program": "agpl-copy",
    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage": "bsd-liability",
    "isc license": "isc-title",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd-grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "isc-warranty",
    "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software": "isc-liability",
    "this software is provided as is without any express or implied warranty": "zlib-warranty",
    "in no event will the authors be held liable for any damages arising from the use of this software": "zlib-liability",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "the origin of this software must not be misrepresented you must not claim that you wrote the original software": "zlib-origin",
    "if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required": "zlib-thanks",
    "altered source versions must be plainly marked as such and must not be misrepresented as being the original software": "zlib-altered",
    "this notice may not be removed or altered from any source distribution": "zlib-notice",
    "distributed under the boost software license version 1 0": "bsl-ref",
    "boost software license version 1 0 august 17th 2003": "bsl-title",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "bsl-grant",
    "the copyright notices in the software and this entire statement including the above license grant this restriction and the following disclaimer must be included in all copies of the software in whole or in part and all derivative works of the software unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor": "bsl-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose title and non infringement": "bsl-warranty",
    "in no event shall the copyright holders or anyone distributing the software be liable for any damages or other liability whether in contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "bsl-liability",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl-2-ref",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v 2 0 which is available at http www eclipse org legal epl 2 0": "epl-2-ref",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "cc0-waiver",
    "cc0 1 0 universal": "cc0-title",
    "the contents of this file are subject to the terms of the common development and distribution license the license": "cddl-ref",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "unlicense-grant",
}
# SPDX names of which notices are made by rule: "SPDX-License-Identifier: NAME", "licensed under the NAME license", "licensed under NAME".
SPDX = """MIT Apache-2.0 BSD-2-Clause BSD-3-Clause ISC 0BSD Zlib BSL-1.0 MPL-2.0 EPL-2.0 CDDL-1.0 Unlicense CC0-1.0
GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later
AGPL-3.0-only AGPL-3.0-or-later CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0""".split()
for _name in SPDX:
    _words = " ".join(_name.lower().replace("-", " ").replace(".", " ").split())
    for _notice in (f"spdx license identifier {_words}", f"licensed under the {_words} license", f"licensed under {_words}"):
        SENTENCES.setdefault(_notice, f"{_name.lower().replace('.', '-')}-name")
# Rules in the order in which they are tried.
RULES = [
    ("MIT", ("mit-title", "mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")),
    ("MIT", ("mit-ref",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty", "bsd-liability")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty", "bsd-liability")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty")),
    ("Apache-2.0", ("apache-2-ref", "apache-2-use", "apache-2-copy", "apache-2-warranty", "apache-2-see")),
    ("Apache-2.0", ("apache-2-notice", "apache-2-copy", "apache-2-warranty", "apache-2-see")),
    ("Apache-2.0", ("apache-2-notice",)),
    ("Apache-2.0", ("apache-2-ref",)),
    ("GPL-3.0-or-later", ("gpl-3-plus-grant", "gpl-warranty", "gpl-see", "gpl-copy", "gnu-address")),
    ("GPL-2.0-or-later", ("gpl-2-plus-grant", "gpl-warranty", "gpl-see", "gpl-copy", "gnu-address")),
    ("LGPL-2.1-or-later", ("lgpl-21-plus-grant", "gpl-warranty", "lgpl-see", "lgpl-copy")),
    ("LGPL-2.1-or-later", ("lgpl-21-plus-grant",)),
    ("LGPL-3.0-or-later", ("lgpl-3-plus-grant", "gpl-warranty", "lgpl-see", "lgpl-copy", "gnu-address")),
    ("LGPL-3.0-or-later", ("lgpl-3-plus-grant", "gpl-warranty", "lgpl-see", "lgpl-copy")),
    ("LGPL-3.0-or-later", ("lgpl-3-plus-grant",)),
    ("AGPL-3.0-or-later", ("agpl-3-plus-grant", "gpl-warranty", "agpl-see", "agpl-copy", "gnu-address")),
    ("AGPL-3.0-or-later", ("agpl-3-plus-grant", "gpl-warranty", "agpl-see", "agpl-copy")),
    ("AGPL-3.0-or-later", ("agpl-3-plus-grant",)),
    ("ISC", ("isc-title", "isc-grant", "isc-warranty", "isc-liability")),
    ("ISC", ("isc-grant", "isc-warranty", "isc-liability")),
    ("0BSD", ("0bsd-grant", "isc-warranty", "isc-liability")),
    ("Zlib", ("zlib-warranty", "zlib-liability", "zlib-grant", "zlib-origin", "zlib-thanks", "zlib-altered", "zlib-notice")),
    ("BSL-1.0", ("bsl-title", "bsl-grant", "bsl-notice", "bsl-warranty", "bsl-liability")),
    ("BSL-1.0", ("bsl-ref",)),
    ("EPL-2.0", ("epl-2-ref",)),
    ("CDDL-1.0", ("cddl-ref", "apache-2-use")),
    ("CDDL-1.0", ("cddl-ref",)),
    ("CC0-1.0", ("cc0-title",)),
    ("CC0-1.0", ("cc0-waiver",)),
    ("GPL-2.0-only", ("gpl-2-grant", "gpl-warranty", "gpl-see", "gpl-copy")),
    ("GPL-2.0-only", ("gpl-2-grant",)),
    ("GPL-3.0-or-later", ("gpl-3-plus-grant", "gpl-warranty", "gpl-see", "gpl-copy")),
    ("GPL-3.0-or-later", ("gpl-3-plus-grant",)),
    ("GPL-3.0-or-later", ("gpl-3-plus-ref",)),
    ("GPL-2.0-or-later", ("gpl-2-plus-grant", "gpl-warranty", "gpl-see", "gpl-copy")),
    ("GPL-2.0-or-later", ("gpl-2-plus-grant",)),
    ("GPL-3.0-only", ("gpl-3-ref",)),
    ("GPL-2.0-only", ("gpl-2-ref",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-ref",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-ref",)),
    ("CC-BY-4.0", ("cc-by-4-ref",)),
    ("MPL-2.0", ("mpl-2-ref", "mpl-2-copy")),
    ("MPL-2.0", ("mpl-2-ref",)),
    ("Unlicense", ("unlicense", "unlicense-grant")),
    ("Unlicense", ("unlicense",)),
    ("All-Rights-Reserved", ("reserved",)),
]
RULES += [(n, (f"{n.lower().replace('.', '-')}-name",)) for n in SPDX if f"{n.lower().replace('.', '-')}-name" in SENTENCES.values()]


def _hints(sentences) -> list[str]:
    """Words of at least six letters, or the longest of a sentence, one of which every sentence holds: the most frequent first."""
    left, found = [s.split() for s in sentences], []
    long = lambda s: [w for w in s if len(w) >= 6] or [max(s, key=len)]
    while left:
        count = Counter(w for s in left for w in set(long(s)))
        best = min(count, key=lambda w: (-count[w], w))
        found.append(best)
        left = [s for s in left if best not in s]
    return found


#: Texts without any of these words hold no known sentence and need no normalising.
HINT = "(?i)" + "|".join(_hints(SENTENCES))
#: Marks for the end of a sentence and for a line end that may be within one.
STOP, LINE = "\x01", "\x02"
#: A known sentence between marks, the longest first.
KNOWN = (
    f"(?<=[{STOP}{LINE}])(?:"
    + "|".join(s.replace(" ", f"[ {LINE}]") for s in sorted(SENTENCES, key=len, reverse=True))
    + f")(?=[{STOP}{LINE}])"
)


def normal(text: Column) -> Column:
    """Lower case, with each run of what is no ASCII letter or digit as one space, or as the mark of the break it holds; a mark at both ends."""
    steps = [
        (f"[{STOP}{LINE}]", "-"),
        (r"(?<=[.!?])[\x20\x09-\x0D]+", STOP),
        (r"\n[^a-z0-9\n]*(?=\n)", STOP),
        (r"\n", LINE),
        (f"[^a-z0-9{STOP}{LINE}]+", " "),
        (f"[ {STOP}{LINE}]*{STOP}[ {STOP}{LINE}]*", STOP),
        (f" ?{LINE} ?", LINE),
    ]
    out = F.lower(text)
    for pattern, by in steps:
        out = F.regexp_replace(out, pattern, by)
    return F.concat(F.lit(STOP), F.trim(out), F.lit(STOP))


def scan(docs: DataFrame) -> DataFrame:
    """docs with n_known (known licence sentences), sentence_ids (in order,
    separated by ;), licences (names of the rules that matched, in the rules'
    order, separated by ;) and leftover (identifiers that no rule used).

    Defined cases: a null or empty text has none of either; any length is read
    whole; equal rows give equal results; an empty table gives an empty
    result; other columns pass through, and clashing ones are replaced.
    """
    new = ["n_known", "sentence_ids", "licences", "leftover"]
    kept = [c for c in docs.columns if c.lower() not in new]
    known = F.create_map(*[F.lit(x) for x in chain.from_iterable(SENTENCES.items())])
    found = F.regexp_extract_all(normal(F.col("text")), F.lit(KNOWN), F.lit(0))
    ids = F.transform(found, lambda s: F.element_at(known, F.translate(s, LINE, " ")))
    ids_, state_ = free_name(docs, "_ids", "_state")
    none = F.array().cast("array<string>")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.when(F.col("text").rlike(HINT), ids), none).alias(ids_))
    used = lambda state, rule: F.struct(
        F.replace(state["left"], rule["run"], F.lit(";;")).alias("left"),
        F.when(F.contains(state["left"], rule["run"]), F.array_append(state["found"], rule["name"])).otherwise(state["found"]).alias("found"),
    )
    rules = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(_run(r)).alias("run")) for n, r in RULES])
    # Each identifier has a mark on both sides, so that runs match whole identifiers only.
    first = F.struct(
        F.array_join(F.transform(ids_, lambda i: F.concat(F.lit(";"), i, F.lit(";"))), "").alias("left"),
        none.alias("found"),
    )
    rows = rows.withColumn(state_, F.when(F.size(ids_) > 0, F.aggregate(rules, first, used)))
    rest = F.trim(F.regexp_replace(F.col(state_)["left"], ";+", " "))
    return rows.select(
        *[F.col(f"`{c}`") for c in kept],
        F.size(ids_).cast("long").alias("n_known"),
        F.array_join(ids_, ";").alias("sentence_ids"),
        F.coalesce(F.array_join(F.array_distinct(F.col(state_)["found"]), ";"), F.lit("")).alias("licences"),
        F.coalesce(F.replace(rest, F.lit(" "), F.lit(";")), F.lit("")).alias("leftover"),
    )


def _run(ids: tuple[str, ...]) -> str:
    return "".join(f";{i};" for i in ids)


def digest(docs: DataFrame) -> DataFrame:
    return scan(docs.select("doc_id", "text")).select("doc_id", "n_known", "sentence_ids", "licences", "leftover")


def _sql() -> str:
    known = ", ".join(f"('{k}', '{v}')" for k, v in SENTENCES.items())
    steps, found = [], []
    for k, (name, ids) in enumerate(RULES):
        run = _run(ids)
        steps.append(f"s{k + 1} AS (SELECT *, replace(l{k}, '{run}', ';;') AS l{k + 1} FROM s{k})")
        found.append(f"CASE WHEN contains(l{k}, '{run}') THEN '{name}' END")
    names = list(dict.fromkeys(n for n, _ in RULES))
    order = ", ".join(f"'{n}'" for n in names)
    return f"""
WITH known(sentence, id) AS (VALUES {known}),
lines AS (
  SELECT doc_id, k, l[k] AS line
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS k FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))
), parts AS (
  SELECT doc_id, k, j, p[j] AS part
  FROM (SELECT doc_id, k, p, unnest(range(1, len(p) + 1)) AS j
        FROM (SELECT doc_id, k, string_split(regexp_replace(line, '([.!?])[\\x20\\x09-\\x0D]+', '\\1' || chr(10), 'g'), chr(10)) AS p FROM lines))
), hits AS (
  SELECT doc_id, k, j, id FROM parts JOIN known ON sentence = trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g'))
), s0 AS (
  SELECT d.doc_id, count(h.id) AS n_known, coalesce(string_agg(h.id, ';' ORDER BY k, j), '') AS sentence_ids,
         coalesce(string_agg(';' || h.id || ';', '' ORDER BY k, j), '') AS l0
  FROM documents d LEFT JOIN hits h ON h.doc_id = d.doc_id GROUP BY d.doc_id
), {', '.join(steps)}
SELECT doc_id, n_known, sentence_ids,
       array_to_string(list_filter([{order}], lambda n: list_contains([{', '.join(found)}], n)), ';') AS licences,
       replace(trim(regexp_replace(l{len(RULES)}, ';+', ' ', 'g')), ' ', ';') AS leftover
FROM s{len(RULES)}
"""


SQL = _sql()

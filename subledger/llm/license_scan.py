"""Operator 2, licence scans: sentence-rule recognition.

Texts are cut into pieces (line ends, and full stops, semicolons and colons before a blank) and normalised (lower
case, signs to blanks, runs of blanks to one). A run of whole pieces that reads as one of a table of known licence
sentences is found, so wrapped lines and marks inside a sentence do not hide it; the longest run counts. The
identifiers found, in text order, form the document's sequence. Ordered rules - an identifier sequence and the
licence it stands for, longer and more special ones first - are matched against it; a matched stretch is
used up, so a document can name several licences. What no rule uses is reported as left over.

All of it is one projection over the scan (patterns, map lookup, higher-order functions): no shuffle, no join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind

# Known licence sentences, normalised (fixed values: the published texts of the licences).
SENTENCES = {
    "released under the mit license": "MITref",
    "licensed under the mit license": "MITref",
    "this project is licensed under the mit license": "MITref",
    "the mit license": "MITtitle",
    "mit license": "MITtitle",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITperm",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITnotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITwarranty",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MITliability",
    "licensed under the apache license version 2 0": "Apache2ref",
    "licensed under the apache license version 2 0 the license": "Apache2ref",
    "this project is licensed under the apache license version 2 0": "Apache2ref",
    "you may not use this file except in compliance with the license": "ApacheComply",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "Apache2url",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "Apache2url",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "ApacheWarranty",
    "see the license for the specific language governing permissions and limitations under the license": "ApacheSee",
    "this work is licensed under the gnu general public license version 3": "GPL3ref",
    "licensed under the gnu general public license version 3": "GPL3ref",
    "this work is licensed under the gnu general public license version 2": "GPL2ref",
    "licensed under the gnu general public license version 2": "GPL2ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3orLater",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2orLater",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GPLwarranty",
    "see the gnu general public license for more details": "GPLsee",
    "you should have received a copy of the gnu general public license along with this program": "GPLcopy",
    "licensed under the gnu lesser general public license version 3": "LGPL3ref",
    "licensed under the gnu lesser general public license version 2 1": "LGPL21ref",
    "licensed under the gnu affero general public license version 3": "AGPL3ref",
    "licensed under cc by nc 4 0": "CCBYNC4ref",
    "licensed under cc by 4 0": "CCBY4ref",
    "licensed under cc by sa 4 0": "CCBYSA4ref",
    "licensed under cc by nd 4 0": "CCBYND4ref",
    "licensed under cc by nc sa 4 0": "CCBYNCSA4ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "CCBY4ref",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "CCBYSA4ref",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "CCBYNC4ref",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "CC0",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDpre",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDsource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDendorse",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BSDwarranty",
    "licensed under the mozilla public license version 2 0": "MPL2ref",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "MPL2form",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCperm",
    "this is free and unencumbered software released into the public domain": "Unlicense",
    "all rights reserved": "AllRights",
}
# Ordered rules (identifier sequence, licence); the first that fits takes its stretch.
RULES = [
    ("MITtitle MITperm MITnotice MITwarranty MITliability", "MIT"),
    ("MITperm MITnotice MITwarranty MITliability", "MIT"),
    ("MITperm MITnotice MITwarranty", "MIT"),
    ("MITperm MITnotice", "MIT"),
    ("Apache2ref ApacheComply Apache2url ApacheWarranty ApacheSee", "Apache-2.0"),
    ("Apache2ref ApacheComply Apache2url", "Apache-2.0"),
    ("GPL3orLater GPLwarranty GPLsee GPLcopy", "GPL-3.0-or-later"),
    ("GPL2orLater GPLwarranty GPLsee GPLcopy", "GPL-2.0-or-later"),
    ("GPL3orLater GPLwarranty GPLsee", "GPL-3.0-or-later"),
    ("GPL2orLater GPLwarranty GPLsee", "GPL-2.0-or-later"),
    ("BSDpre BSDsource BSDbinary BSDendorse BSDwarranty", "BSD-3-Clause"),
    ("BSDpre BSDsource BSDbinary BSDwarranty", "BSD-2-Clause"),
    ("GPL3orLater", "GPL-3.0-or-later"),
    ("GPL2orLater", "GPL-2.0-or-later"),
    ("MITref", "MIT"),
    ("MITtitle", "MIT"),
    ("Apache2ref", "Apache-2.0"),
    ("GPL3ref", "GPL-3.0-only"),
    ("GPL2ref", "GPL-2.0-only"),
    ("LGPL3ref", "LGPL-3.0-only"),
    ("LGPL21ref", "LGPL-2.1-only"),
    ("AGPL3ref", "AGPL-3.0-only"),
    ("CCBYNC4ref", "CC-BY-NC-4.0"),
    ("CCBYNCSA4ref", "CC-BY-NC-SA-4.0"),
    ("CCBYSA4ref", "CC-BY-SA-4.0"),
    ("CCBYND4ref", "CC-BY-ND-4.0"),
    ("CCBY4ref", "CC-BY-4.0"),
    ("CC0", "CC0-1.0"),
    ("MPL2ref", "MPL-2.0"),
    ("MPL2form", "MPL-2.0"),
    ("ISCperm", "ISC"),
    ("Unlicense", "Unlicense"),
]
SENTENCE_END = r"\n|[.;:] |[.;:]$"
SIGNS = r"[^a-z0-9]+"
# one known sentence between two piece ends ("|"), the longest first
KNOWN = r"\| ?(" + "|".join(x.replace(" ", "[ |]+") for x in sorted(SENTENCES, key=len, reverse=True)) + r")(?= ?\|)"


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    table = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    plain = F.translate(F.lower(F.coalesce(text, F.lit(""))), "|", " ")
    pieces = F.regexp_replace(F.regexp_replace(plain, SENTENCE_END, "|"), "[^a-z0-9|]+", " ")
    found = F.regexp_extract_all(F.concat(F.lit("|"), pieces, F.lit("|")), F.lit(KNOWN), F.lit(1))
    return F.transform(found, lambda s: table[F.regexp_replace(s, "[ |]+", " ")])


def matched(ids: Column) -> Column:
    """Struct (left, licenses): the rules in order, each as often as it fits."""
    rules = F.array(*[F.struct(F.lit(f" {seq} ").alias("seq"), F.lit(name).alias("name")) for seq, name in RULES])
    start = F.struct(F.concat(F.lit(" "), F.array_join(ids, "  "), F.lit(" ")).alias("left"),
                     F.array().cast("array<string>").alias("found"))

    def step(acc, rule):
        seq = F.replace(rule["seq"], F.lit(" "), F.lit("  "))  # identifiers stand between double blanks
        seq = F.substr(seq, F.lit(2), F.length(seq) - 2)
        rest = F.replace(acc["left"], seq, F.lit(" | "))
        return F.when(rest != acc["left"], F.struct(
            rest.alias("left"), F.array_union(acc["found"], F.array(rule["name"])).alias("found"))).otherwise(acc)

    return F.aggregate(rules, start, step)


def op2_license_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences (known ones), sentence_ids, licenses (in rule order, joined by a blank; empty string:
    none), leftover (known sentences that no rule used).

    NULL and empty texts have no sentences. Repeated rows are scanned each; other columns are ignored."""
    ids = docs.select("doc_id", sentence_ids(F.col("text")).alias("ids"))
    found = ids.select("doc_id", "ids", F.when(F.size("ids") > 0, matched(F.col("ids"))).alias("m"))
    left = F.filter(F.split(F.coalesce(F.col("m.left"), F.lit("")), " +"), lambda x: ~x.isin("", "|"))
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", " ").alias("sentence_ids"),
        F.coalesce(F.array_join("m.found", " "), F.lit("")).alias("licenses"),
        F.size(left).cast("long").alias("leftover"))


def oracle() -> str:
    """DuckDB SQL: the rules unrolled as nested replacements."""
    keys = ", ".join("'" + s + "'" for s in SENTENCES)
    names = ", ".join("'" + s + "'" for s in SENTENCES.values())
    steps, last = [], "s0"
    for i, (seq, name) in enumerate(RULES, 1):
        padded = " " + "  ".join(seq.split()) + " "
        steps.append(f"s{i} as (select * exclude (seq, found), replace(seq, '{padded}', ' | ') as seq, "
                     f"case when contains(seq, '{padded}') and not list_contains(found, '{name}') "
                     f"then list_append(found, '{name}') else found end as found from {last})")
        last = f"s{i}"
    return f"""
with known as (select unnest([{keys}]) as sentence, unnest([{names}]) as id),
d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
parts as (select r, generate_subscripts(p, 1) as i, unnest(p) as s
          from (select r, string_split_regex(text, '\\n|[.;:] |[.;:]$') as p from d)),
ids as (select r, list(id order by i) as ids from parts
        join known on known.sentence = trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) group by r),
s0 as (select d.doc_id, coalesce(ids, []) as ids, ' ' || array_to_string(coalesce(ids, []), '  ') || ' ' as seq,
              cast([] as varchar[]) as found from d left join ids using (r)),
{', '.join(steps)}
select doc_id, cast(len(ids) as bigint) as n_sentences, array_to_string(ids, ' ') as sentence_ids,
       array_to_string(found, ' ') as licenses,
       cast(len(list_filter(string_split_regex(seq, ' +'), lambda x: x not in ('', '|'))) as bigint) as leftover
from {last}
"""

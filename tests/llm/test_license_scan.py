import re
import textwrap

from subledger.llm import license_scan as L


def brute(text):
    ids = []
    for s in re.split(L.SENTENCE_END, text or ""):
        normal = re.sub(L.SIGNS, " ", s.lower()).strip()
        if normal in L.SENTENCES:
            ids.append(L.SENTENCES[normal])
    found, left = [], list(ids)
    for seq, name in L.RULES:
        seq, i = seq.split(), 0
        while i + len(seq) <= len(left):
            if left[i : i + len(seq)] == seq:
                left[i : i + len(seq)] = ["|"]
                if name not in found:
                    found.append(name)
            i += 1
    return len(ids), " ".join(ids), " ".join(found), sum(x != "|" for x in left)


MIT = ("MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software "
       "and associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
       "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies "
       "of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
       "conditions:\nThe above copyright notice and this permission notice shall be included in all copies or "
       "substantial portions of the Software.\n")


def test_rules(spark, docs):
    rows = [(1, MIT), (2, "Some words.\nLicensed under CC BY-NC 4.0."), (3, "All rights reserved."),
            (4, "Released under the MIT License. Licensed under the Apache License, Version 2.0."),
            (5, "the license of poetry"), (6, MIT + "All rights reserved. Released under the MIT License."), (7, "")]
    got = L.op2_license_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = {r["doc_id"]: r for r in got}
    assert by[1]["licenses"] == "MIT" and by[2]["licenses"] == "CC-BY-NC-4.0"
    assert by[3]["licenses"] == "" and by[3]["leftover"] == 1
    assert by[4]["licenses"] == "MIT Apache-2.0"
    for i, text in rows:
        assert (by[i]["n_sentences"], by[i]["sentence_ids"], by[i]["licenses"], by[i]["leftover"]) == brute(text), i
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in L.op2_license_rules(docs).collect():
        assert (r["n_sentences"], r["sentence_ids"], r["licenses"], r["leftover"]) == brute(texts[r["doc_id"]])


def test_odd_and_empty(odd_docs, no_docs):
    got = L.op2_license_rules(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r["licenses"] == "" for r in got)
    assert L.op2_license_rules(no_docs).count() == 0


GPL = ("This program is free software{} you can redistribute it and/or modify it under the terms of the GNU General "
       "Public License as published by the Free Software Foundation{} either version {} of the License, or (at your "
       "option) any later version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY "
       "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the "
       "GNU General Public License for more details.\n\nYou should have received a copy of the GNU General Public "
       "License along with this program.  If not, see <https://www.gnu.org/licenses/>.")
BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
       "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this "
       "list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above "
       "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
       "materials provided with the distribution.\n\n{}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
       "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED "
       "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT")
ENDORSE = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
           "promote products derived from this software without specific prior written permission.\n\n")
APACHE = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
          "with the License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0"
          "\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is "
          "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See "
          "the License for the specific language governing permissions and limitations under the License.")
MPL = ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
       "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.")
ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
       "granted, provided that the above copyright notice and this permission notice appear in all copies.")


def test_published_texts_wrapped_or_not(spark):
    texts = [(GPL.format(":", ",", 3), "GPL-3.0-or-later", 4), (GPL.format(";", ";", 2), "GPL-2.0-or-later", 4),
             (BSD.format(""), "BSD-2-Clause", 4), (BSD.format(ENDORSE), "BSD-3-Clause", 5), (APACHE, "Apache-2.0", 5),
             (MPL, "MPL-2.0", 1), (ISC, "ISC", 1), (MIT, "MIT", 3)]
    # every sentence of the table and every rule, on one line and wrapped behind comment signs
    texts += [(s, None, 1) for s in L.SENTENCES]
    first = {name: s for s, name in reversed(L.SENTENCES.items())}
    texts += [("\n".join(first[x] + "." for x in seq.split()), name, len(seq.split())) for seq, name in L.RULES]
    rows, want = [], []
    for text, name, n in texts:
        for width in (None, 76, 40):
            lines = [x if width is None else textwrap.fill(x, width, initial_indent=" * ", subsequent_indent=" * ",
                                                           break_long_words=False) for x in text.split("\n")]
            rows.append((len(rows), "Some words before.\n\n" + "\n".join(lines) + "\n\nand some after\n"))
            want.append((name, n))
    got = L.op2_license_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in got:
        name, n = want[r["doc_id"]]
        assert r["n_sentences"] == n, rows[r["doc_id"]]
        assert name is None or (r["licenses"], r["leftover"]) == (name, 0), rows[r["doc_id"]]

"""Licence headers and texts, with weights from the corpus (DataFrame functions only).

A segment is a sentence, or 1 to 48 lines from one that holds a licence word
(``ANCHOR``); lines without a word are left out, windows of more than one line
end at ``LONGEST`` characters. Its TF-IDF vector is compared with those of
``TEMPLATES``; document frequencies are counted over all rows. A template counts
only where all its ``need`` words and none of its ``bar`` words occur, which
tells versions and families apart that differ by a word.

Of a text's segments the one with the most evidence (score times matched weight)
names the license: a long notice beats a short one, a clean cut a padded one.
Ties: the earlier line, then the smaller license name.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefit.llm.common import keep_table, lower_ascii, text_key, text_or_empty

THRESHOLD = 0.6
LONGEST = 4000
LINES = (1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 20, 24, 32, 40, 48)
ANCHOR = "licen[sc]e|permission|redistribut|reserved|proprietary|public domain"
WORD = "[a-z]+|[0-9]+(?:[.][0-9]+)*"
SAME = {**{f"licen{c}{e}": "license" for c in "sc" for e in ("e", "ed", "es")}, "gplv": "gpl", "lgplv": "lgpl", "agplv": "agpl"}

_GNU = {"GPL-2.0": ("General", "2"), "GPL-3.0": ("General", "3"), "LGPL-2.1": ("Lesser General", "2.1"),
        "LGPL-3.0": ("Lesser General", "3"), "AGPL-3.0": ("Affero General", "3")}
_CC = {"BY": "Attribution", "SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
_CC_BAR = {"sa": "sa sharealike share", "nc": "nc noncommercial", "nd": "nd noderivatives noderivs"}
#: License, its names, words that say it is another.
NAMES = [
    ("Apache-2.0", ["Apache License, Version 2.0", "Apache 2.0 License"], ""),
    ("BSD-2-Clause", ["BSD 2-Clause License", "Simplified BSD License"], ""),
    ("BSD-3-Clause", ["BSD 3-Clause License", "New BSD License"], ""),
    ("BSL-1.0", ["Boost Software License, Version 1.0"], ""),
    ("CC0-1.0", ["CC0 1.0 Universal license", "Creative Commons Zero v1.0 Universal license"], ""),
    ("EPL-2.0", ["Eclipse Public License, version 2.0"], ""),
    ("ISC", ["ISC License"], ""),
    ("MIT", ["MIT License"], ""),
    ("MPL-2.0", ["Mozilla Public License, version 2.0"], ""),
    ("Zlib", ["zlib License"], ""),
    *[(k, [f"GNU {family} Public License, version {v}", f"{k.split('-')[0]} version {v} license"],
       " ".join({"lesser", "library", "affero"} - set(family.lower().split()))) for k, (family, v) in _GNU.items()],
    *[(f"CC-{kind}-{v}", [f"CC {kind} {v} license", f"Creative Commons {'-'.join(_CC[p] for p in kind.split('-'))} {v} International License"],
       " ".join(x for p, x in _CC_BAR.items() if p.upper() not in kind.split("-")))
      for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for v in ("3.0", "4.0")],
]
FRAMES = ["{}", "Licensed under {}", "Released under the {}.", "Licensed under the {}.", "This work is licensed under the {}.",
          "This file is distributed under the terms of the {}. See the LICENSE file for details."]
_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions: """
_GNU_HEADER = """This {} is free software; you can redistribute it and/or modify it under the terms of the GNU {} Public License as published
by the Free Software Foundation; either version {} of the License, or (at your option) any later version."""
#: License, words of a notice, words it must hold, words that say it is another.
TEXTS = [
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0""", "apache license 2", ""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed
to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
     "apache license 2", ""),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, "
     "AND DISTRIBUTION", "apache license 2", ""),
    ("BSD-2-Clause", _BSD, "redistribution source binary", "neither endorse"),
    ("BSD-3-Clause", _BSD + """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission.""", "redistribution source binary neither endorse", ""),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted.",
     "redistribution source binary", "conditions"),
    ("BSL-1.0", """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the
Software, and to prepare derivative works of the Software""", "permission granted organization license", ""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies.""", "permission fee purpose granted", ""),
    ("MIT", _MIT, "permission granted charge person", "organization"),
    ("MIT", _MIT + """The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""", "permission granted charge person", "organization"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.", "permission granted charge person",
     "organization"),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""", "mozilla public license 2", ""),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla public license 2", ""),
    ("EPL-2.0", """This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is
available at https://www.eclipse.org/legal/epl-2.0/""", "eclipse public license 2", ""),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered public domain", ""),
    ("Zlib", """Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions""", "permission granted anyone alter freely", ""),
    ("Proprietary", "Proprietary and confidential. Unauthorized copying of this file, via any medium, is strictly prohibited.",
     "proprietary confidential", ""),
    ("Proprietary", "All rights reserved. This software is the confidential and proprietary information of the company. You shall not "
     "disclose it.", "proprietary confidential", ""),
    ("Proprietary", "All rights reserved. No part of this work may be reproduced, distributed or transmitted in any form or by any means "
     "without the prior written permission of the publisher.", "rights reserved reproduced permission", ""),
    *[(k, _GNU_HEADER.format(thing, family, v), f"{family.lower()} public license {v}",
       " ".join({"lesser", "library", "affero"} - set(family.lower().split())))
      for k, (family, v) in _GNU.items() for thing in ("program", "library")],
    *[(k, f"GNU {family} PUBLIC LICENSE Version {v} Copyright (C) Free Software Foundation, Inc. Everyone is permitted to copy and distribute "
       "verbatim copies of this license document, but changing it is not allowed.", f"{family.lower()} public license {v} everyone verbatim",
       " ".join({"lesser", "library", "affero"} - set(family.lower().split()))) for k, (family, v) in _GNU.items()],
]


def words(text: str) -> list[str]:
    return [SAME.get(w, re.sub("([.]0)+$", "", w)) for w in re.findall(WORD, text.lower())]


def _templates():
    out = [(k, t, set(need.split()), set(bar.split())) for k, t, need, bar in TEXTS]
    for k, names, bar in NAMES:
        for name in names:
            need = set(words(name)) - {"version", "v", "license", "international", "universal"} | {"license"}
            out += [(k, f.format(name), need, set(bar.split())) for f in FRAMES]
        for tail in ("", "-only", "-or-later") if k in _GNU else ("",):
            out.append((k, f"SPDX-License-Identifier: {k}{tail}", {"spdx", "license", *words(k)}, set(bar.split())))
    # CC names are also given without the word "license".
    out += [(k, f"Licensed under CC {k[3:-4]} {k[-3:]}.", {"license", *words(k)}, set(bar.split())) for k, _, bar in NAMES if k[:3] == "CC-"]
    return [(k, Counter(words(t)), need, bar) for k, t, need, bar in out]


TEMPLATES = _templates()


def same(w: Column) -> Column:
    """A word in the form of ``words``."""
    known = F.create_map(*[F.lit(x) for p in SAME.items() for x in p])
    return F.when(w.isin(*SAME), known[w]).when(w.endswith(".0"), F.regexp_replace(w, "([.]0)+$", "")).otherwise(w)


def tokens(c: str) -> Column:
    return F.expr(f"regexp_extract_all({c}, '{WORD}', 0)")


def document_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``w, df``: in how many rows a word occurs."""
    return (docs.select(lower_ascii(text_or_empty(text_col)).alias("t"))
            .select(F.explode(F.array_distinct(F.transform(F.array_distinct(tokens("t")), same))).alias("w"))
            .groupBy("w").agg(F.count(F.lit(1)).alias("df")))


def segments(t: str) -> Column:
    """``array<struct<pos, seg>>`` of the lines ``ls`` of a text."""
    cut = "regexp_replace(ls[i], '([.!?])[ \\\\t]+', '$1\\n')"
    sizes = ", ".join(map(str, LINES))
    return F.expr(f"""flatten(transform(filter(sequence(0, size({t}) - 1), i -> {t}[i] rlike '{ANCHOR}'), i -> transform(array_distinct(concat(
        filter(split({cut}, '\\n'), s -> s rlike '{ANCHOR}'),
        transform(filter(transform(array({sizes}), n -> slice({t}, i + 1, n)),
                         w -> size(w) = 1 OR aggregate(w, 0, (a, l) -> a + length(l) + 1) <= {LONGEST}), w -> array_join(w, '\\n')))),
        s -> struct(i AS pos, s AS seg))))""")


def scored_segments(segs: DataFrame, df: DataFrame, n_docs: int) -> DataFrame:
    """``h, license, score, evidence`` of the segments (``h, seg``) that reach the threshold."""
    spark = segs.sparkSession
    rows = [(k, name, w, tf.get(w, 0), w in need, w in bar) for k, (name, tf, need, bar) in enumerate(TEMPLATES) for w in sorted({*tf, *need, *bar})]
    fixed = spark.createDataFrame(rows, "template int, license string, w string, n int, need boolean, bar boolean")
    idf = F.log(F.lit(float(n_docs + 1)) / (F.coalesce("df", F.lit(0)) + 1)) + 1
    # The templates are a fixed list of a few thousand words.
    weights = fixed.join(df, "w", "left").withColumn("v", F.col("n") * idf)
    norms = weights.groupBy("template").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"),
                                            F.sum(F.col("need").cast("int")).alias("needed"))
    weights = weights.join(F.broadcast(norms), "template").select("template", "w", (F.col("v") / F.col("norm")).alias("x"), "need", "bar")
    names = fixed.select("template", "license").distinct().join(norms.select("template", "needed"), "template")
    tf = (segs.select("h", F.explode(tokens("seg")).alias("w")).groupBy("h", same(F.col("w")).alias("w")).agg(F.count(F.lit(1)).alias("tf"))
          .join(df, "w", "left").select("h", "w", (F.col("tf") * idf).alias("v")))
    # A segment's words in one partition: products with the templates are summed where they arise.
    tf = keep_table(tf, "license-words").repartition("h")
    norm = tf.groupBy("h").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    dot = (tf.join(F.broadcast(weights), "w").groupBy("h", "template")
           .agg(F.sum(F.col("v") * F.col("x")).alias("dot"), F.sum(F.col("need").cast("int")).alias("has"), F.max("bar").alias("barred"))
           .filter("NOT barred").join(F.broadcast(names), "template").filter("has = needed"))
    score = F.round(F.col("dot") / F.col("norm"), 6)
    evidence = F.round(F.col("dot") * F.col("dot") / F.col("norm"), 6)
    return (dot.join(norm, "h").withColumn("score", score).withColumn("evidence", evidence).filter(F.col("score") >= THRESHOLD)
            .groupBy("h").agg(F.min(F.struct((-F.col("evidence")).alias("e"), "license", "score")).alias("b"))
            .select("h", "b.license", "b.score", (-F.col("b.e")).alias("evidence")))


def notices(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``key, license, score, pos`` per distinct text that has a notice; ``pos`` counts lines with words from 0."""
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike("[a-z0-9]"))
    found = (docs.select(text_key(text_col).alias("key"), lower_ascii(text_or_empty(text_col)).alias("t")).filter(F.col("t").rlike(ANCHOR))
             .select("key", lines.alias("ls")).select("key", F.explode(segments("ls")).alias("s"))
             .select("key", "s.pos", "s.seg", F.md5(F.col("s.seg")).alias("h")))
    found = keep_table(found, "license-segments")
    df = keep_table(document_frequencies(docs, text_col), "license-words-df")
    scored = scored_segments(found.groupBy("h").agg(F.any_value("seg").alias("seg")), df, docs.count())
    return (found.select("key", "pos", "h").join(scored, "h").groupBy("key")
            .agg(F.min(F.struct((-F.col("evidence")).alias("e"), "pos", "license", "score")).alias("b"))
            .select("key", "b.license", "b.score", "b.pos"))

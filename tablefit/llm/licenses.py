"""License scan: TF-IDF cosine of text segments to notices, then inheritance.

A text is cut into segments (lines, and sentences within them). A segment's
sparse TF-IDF vector is compared with those of known notices; words outside the
notices' vocabulary count in its norm at the highest weight. Equal segments are
scored once. Segments without any of a notice's heaviest words cannot reach the
threshold (the rest of the notice's norm is below it), so a pattern of those
words discards nearly all text exactly, inside the scan.

A document takes the license of its best segment. A licence file (by a condition
that the caller gives) also speaks for its directory; documents without a notice
inherit from the nearest ancestor directory that has one. Directories are made
distinct before their ancestors are expanded, so a directory that holds a third
of all files is one row there.

Ties: the higher score, then the earlier segment, then the smaller license name;
between licence files of one directory the higher score, then the smaller name.
Null or empty texts have no notice but may inherit; a null path has no
directory; null IDs and repeated rows are answered like others. Only DataFrame
functions are used.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm.common import LOWER, UPPER, keep_table, lower_ascii, table, text_key, text_or_empty

THRESHOLD = 0.6
#: Notices by which licenses are known (fixed values: the usual wording).
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "Licensed under the Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
WORD = "[a-z0-9]+"
#: Stop words: not part of any vector.
COMMON = set("a and any by for in is of on or the this to v with without".split())


def _vectors():
    tfs = [Counter(w for w in re.findall(WORD, text.lower()) if w not in COMMON) for _, text in NOTICES]
    df = Counter(w for tf in tfs for w in tf)
    idf = {w: math.log((len(tfs) + 1) / (n + 1)) + 1 for w, n in df.items()}
    out = []
    for (name, _), tf in zip(NOTICES, tfs):
        v = {w: n * idf[w] for w, n in tf.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        out.append((name, {w: x / norm for w, x in v.items()}))
    return idf, math.log(len(tfs) + 1) + 1, out


IDF, IDF_OTHER, VECTORS = _vectors()


def cue_words(threshold: float = THRESHOLD) -> list[str]:
    """Words of which every segment that reaches the threshold holds one."""
    cues = set()
    for _, v in VECTORS:
        rest = 1.0
        for w, x in sorted(v.items(), key=lambda p: (-p[1], p[0])):
            if rest < 0.999 * threshold ** 2:
                break
            cues.add(w)
            rest -= x * x
    return sorted(cues)


CUES = f"(^|[^a-z0-9])({'|'.join(cue_words())})($|[^a-z0-9])"
CUT = "([.!?])[ \\t]+"


def scored_segments(segments: DataFrame) -> DataFrame:
    """``seg, license, score`` of the distinct ``seg`` that reach the threshold."""
    spark = segments.sparkSession
    idf = spark.createDataFrame(sorted(IDF.items()), "w string, idf double")
    weights = spark.createDataFrame([(k, name, w, x) for k, (name, v) in enumerate(VECTORS) for w, x in sorted(v.items())],
                                    "notice int, license string, w string, x double")  # a fixed list
    tf = (segments.select("seg", F.explode(F.expr(f"regexp_extract_all(seg, '{WORD}', 0)")).alias("w"))
          .filter(~F.col("w").isin(*sorted(COMMON)))
          .groupBy("seg", "w").agg(F.count(F.lit(1)).alias("tf"))
          .join(F.broadcast(idf), "w", "left")
          .withColumn("v", F.col("tf") * F.coalesce("idf", F.lit(IDF_OTHER))))
    norm = tf.groupBy("seg").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    dot = tf.join(F.broadcast(weights), "w").groupBy("seg", "notice", "license").agg(F.sum(F.col("v") * F.col("x")).alias("dot"))
    score = F.round(F.col("dot") / F.col("norm"), 6)
    best = F.max_by(F.struct("license", "score"), F.struct("score", (-F.col("notice")).alias("o"))).alias("b")
    return (dot.join(norm, "seg").withColumn("score", score).filter(F.col("score") >= THRESHOLD)
            .groupBy("seg").agg(best).select("seg", "b.license", "b.score"))


def notices(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``key, license, score, pos`` per distinct text that has a notice; ``pos`` counts segments from 0."""
    norm = lower_ascii(text_or_empty(text_col))
    found = (docs.select(text_key(text_col).alias("key"), norm.alias("t")).filter(F.col("t").rlike(CUES))
             .select("key", F.posexplode(F.split(F.regexp_replace("t", CUT, "$1\n"), "\n", -1)).alias("pos", "seg"))
             .filter(F.col("seg").rlike(CUES)))
    found = keep_table(found, "license-segments")
    scored = scored_segments(found.select("seg").distinct())
    # max_by of a struct: score first, then the earliest segment.
    return (found.join(scored, "seg").groupBy("key")
            .agg(F.max_by(F.struct("license", "score", "pos"), F.struct("score", (-F.col("pos")).alias("o"))).alias("b"))
            .select("key", "b.license", "b.score", "b.pos"))


def directory(path: Column) -> Column:
    return F.when(path.isNotNull(), F.regexp_replace(path, "/?[^/]*$", ""))


def ancestors(d: Column) -> Column:
    """The directory and those above it, the root (empty) last."""
    parts = F.split(d, "/")
    return F.transform(F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def license_scan(docs: DataFrame, path: Column, is_license_file: Column, id_col: str = "doc_id",
                 text_col: str = "text", find=notices) -> DataFrame:
    """``id, license, origin, score``: origin is ``notice``, ``inherited`` or ``none``.

    ``is_license_file`` may use ``pos``, the place of the notice in the text;
    ``find`` gives the notices of the texts, as ``notices`` does.
    """
    found = find(docs, text_col)
    rows = docs.select(F.col(id_col).alias("id"), path.alias("path"), text_key(text_col).alias("key"))
    own = keep_table(rows.join(found, "key", "left").withColumn("dir", directory(F.col("path")))
                     .withColumn("speaks", F.coalesce(is_license_file, F.lit(False)) & F.col("license").isNotNull())
                     .select("id", "dir", "license", "score", "speaks"), "licenses")
    per_dir = (own.filter("speaks AND dir IS NOT NULL").groupBy("dir", "license").agg(F.max("score").alias("score"))
               .groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("license").alias("l"))).alias("b"))
               .select(F.col("dir").alias("up"), F.col("b.l").alias("given"), (-F.col("b.s")).alias("given_score")))
    dirs = own.filter("dir IS NOT NULL").select("dir").distinct()
    nearest = (dirs.select("dir", F.posexplode(ancestors(F.col("dir"))).alias("away", "up")).join(per_dir, "up")
               .groupBy("dir").agg(F.min_by(F.struct("given", "given_score"), "away").alias("b"))
               .select("dir", "b.given", "b.given_score"))
    return (own.join(nearest, "dir", "left")
            .select("id", F.coalesce("license", "given").alias("license"),
                    F.when(F.col("license").isNotNull(), "notice").when(F.col("given").isNotNull(), "inherited")
                    .otherwise("none").alias("origin"),
                    F.coalesce("score", "given_score").alias("score")))


def document_path() -> Column:
    """``source/<thousand>/<hundred>/<id>.txt``; documents whose ID ends in 0 lie one level higher."""
    return F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.expr("doc_id div 1000").cast("string"),
                       F.when(F.col("doc_id") % 10 != 0, F.expr("doc_id div 100").cast("string")),
                       F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie by ``document_path``; one that opens with a notice stands
    for the licence file of its directory."""
    docs = table(spark, sf_dir, "documents")
    return license_scan(docs, document_path(), F.col("pos") == 0).select(F.col("id").alias("doc_id"), "license", "origin", "score")


def query_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence files are the documents whose ID ends in 0 and that hold a
    notice, wherever it stands; notices are found by ``license_texts``."""
    from tablefit.llm import license_texts

    docs = table(spark, sf_dir, "documents")
    return license_scan(docs, document_path(), F.col("id") % 10 == 0, find=license_texts.notices).select(F.col("id").alias("doc_id"), "license", "origin", "score")


def _oracle() -> str:
    sq = lambda s: s.replace("'", "''")
    idf = ", ".join(f"('{w}', {x!r}::DOUBLE)" for w, x in sorted(IDF.items()))
    wts = ", ".join(f"({k}, '{n}', '{w}', {x!r}::DOUBLE)" for k, (n, v) in enumerate(VECTORS) for w, x in sorted(v.items()))
    return f"""
WITH idf(w, idf) AS (VALUES {idf}), weights(notice, license, w, x) AS (VALUES {wts}),
lines AS (SELECT doc_id, unnest(string_split(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
            '([.!?])[ \\t]+', '\\1' || chr(10), 'g'), chr(10))) AS seg,
            generate_subscripts(string_split(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
            '([.!?])[ \\t]+', '\\1' || chr(10), 'g'), chr(10)), 1) - 1 AS pos FROM documents),
found AS (SELECT * FROM lines WHERE regexp_matches(seg, '{sq(CUES)}')),
words AS (SELECT seg, unnest(regexp_extract_all(seg, '{WORD}')) AS w FROM (SELECT DISTINCT seg FROM found)),
tf AS (SELECT seg, w, count(*) * coalesce(any_value(idf), {IDF_OTHER!r}::DOUBLE) AS v FROM words LEFT JOIN idf USING (w)
       WHERE w NOT IN ({", ".join(f"'{w}'" for w in sorted(COMMON))}) GROUP BY seg, w),
norm AS (SELECT seg, sqrt(sum(v * v)) AS norm FROM tf GROUP BY seg),
dot AS (SELECT seg, notice, license, sum(v * x) AS dot FROM tf JOIN weights USING (w) GROUP BY seg, notice, license),
scored AS (SELECT seg, license, round(dot / norm, 6) AS score FROM dot JOIN norm USING (seg)
           WHERE round(dot / norm, 6) >= {THRESHOLD}
           QUALIFY row_number() OVER (PARTITION BY seg ORDER BY round(dot / norm, 6) DESC, notice) = 1),
own AS (SELECT doc_id, license, score, pos FROM found JOIN scored USING (seg)
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) = 1),
placed AS (SELECT d.doc_id, coalesce(source, 'unknown') || '/' || (d.doc_id // 1000) AS up,
                  CASE WHEN d.doc_id % 10 != 0 THEN d.doc_id // 100 END AS sub, license, score, pos
           FROM documents d LEFT JOIN own USING (doc_id)),
speaks AS (SELECT up, sub, license, score FROM placed WHERE pos = 0
           QUALIFY row_number() OVER (PARTITION BY up, sub ORDER BY score DESC, license) = 1)
SELECT p.doc_id, coalesce(p.license, g.license, h.license) AS license,
       CASE WHEN p.license IS NOT NULL THEN 'notice' WHEN coalesce(g.license, h.license) IS NOT NULL THEN 'inherited'
            ELSE 'none' END AS origin,
       coalesce(p.score, g.score, h.score) AS score
FROM placed p LEFT JOIN speaks g ON p.up = g.up AND p.sub = g.sub
     LEFT JOIN speaks h ON p.up = h.up AND h.sub IS NULL
"""


ORACLE = _oracle()

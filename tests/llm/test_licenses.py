import re

from pyspark.sql import functions as F

from tablefit.llm import licenses


def scan(df):
    out = licenses.license_scan(df, F.col("path"), F.coalesce(F.col("path").rlike("/LICENSE$"), F.lit(False)))
    return {r.id: (r.license, r.origin) for r in out.collect()}


def test_notices_and_inheritance(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/c/x.txt", "nothing"), (3, "a/b/LICENSE", "LICENSED UNDER CC BY-NC 4.0."),
        (4, "a/b/y.txt", None), (5, "z/x.txt", ""), (6, "a/q.txt", "x\nThis work is licensed under the GNU General Public License, version 3.\nz"),
        (7, None, "Licensed under the Apache License, Version 2.0. And then some prose."), (8, None, None), (9, "a/b/c/d/e.txt", "the mit license"),
        (None, "a/n.txt", "x"), (2, "a/b/c/x.txt", "nothing"), (10, "top.txt", "y" * 100_000), (11, "ab/x.txt", "MIT 4.0 general work"),
    ]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, path string, text string, license string, score int")
    assert scan(df) == {
        1: ("MIT", "notice"), 2: ("CC-BY-NC-4.0", "inherited"), 3: ("CC-BY-NC-4.0", "notice"), 4: ("CC-BY-NC-4.0", "inherited"),
        5: (None, "none"), 6: ("GPL-3.0", "notice"), 7: ("Apache-2.0", "notice"), 8: (None, "none"), 9: ("MIT", "notice"),
        None: ("MIT", "inherited"), 10: (None, "none"), 11: (None, "none")}


def test_segments_without_cues_stay_below_the_threshold():
    cues = set(licenses.cue_words())
    for _, v in licenses.VECTORS:
        assert sum(x * x for w, x in v.items() if w not in cues) ** 0.5 < licenses.THRESHOLD
    assert not re.search(licenses.CUES, "plain prose of the day")


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, path string, text string")
    assert scan(df) == {}

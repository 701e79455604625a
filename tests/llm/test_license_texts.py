import pytest

from tablefit.llm import license_texts

APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
import os
x = os.getcwd()
"""
GNU = """/* This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU {} Public License as published by
 * the Free Software Foundation, either version {} of the License, or
 * (at your option) any later version.
 */
int main() {{ return 0; }}"""
MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:
"""
BSD = """Copyright (c) 2020, Someone. All rights reserved.
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
THIRD = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
CASES = [
    (APACHE, "Apache-2.0"),
    ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', "Apache-2.0"),
    (MIT, "MIT"), (" ".join(MIT.split()), "MIT"), (BSD, "BSD-2-Clause"), (BSD + THIRD, "BSD-3-Clause"),
    (GNU.format("General", "2"), "GPL-2.0"), (GNU.format("General", "3"), "GPL-3.0"), (GNU.format("Lesser General", "2.1"), "LGPL-2.1"),
    (GNU.format("Lesser General", "3"), "LGPL-3.0"), (GNU.format("Affero General", "3"), "AGPL-3.0"),
    ("SPDX-License-Identifier: MIT", "MIT"), ("// SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
    ("# SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"), ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("Some prose. Released under the MIT License. More prose of the day.", "MIT"), ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.", "Proprietary"),
    ("mit!! wir gehen mit.", None), ("They need a license to drive, with permission of the owner.", None), (None, None), ("", None),
]


@pytest.mark.parametrize("plain", [0, 400])
def test_headers_and_confusable_pairs(spark, plain):
    """In a small corpus and among many rows of prose."""
    rows = [(k, t) for k, (t, _) in enumerate(CASES)]
    rows += [(1000 + k, "the work of this day and the form of a file, with all the words that you use in it") for k in range(plain)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    from tablefit.llm.common import text_key

    found = {r.key: r.license for r in license_texts.notices(docs).collect()}
    keys = {r.doc_id: r.key for r in docs.select("doc_id", text_key("text").alias("key")).collect()}
    got = [(t, found.get(keys[k])) for k, (t, _) in enumerate(CASES)]
    assert [g for g, c in zip(got, CASES) if g != c] == []
    assert found.get(keys.get(1000)) is None


def test_empty(empty):
    assert license_texts.notices(empty).count() == 0


def test_document_frequencies_count_rows(spark):
    docs = spark.createDataFrame([("Licensed, license LICENSE 2.0 v2",), ("a license",), (None,)], "text string")
    assert {r.w: r.df for r in license_texts.document_frequencies(docs).collect()} == {"license": 2, "2": 1, "v": 1, "a": 1}

"""Denied notices, SPDX lines and the licenses added to the first eleven."""

import pytest

from shipwise.llm import license_scan

ASIDE = "A long line went on about ships and weather and never came to a point, and then it said that "
CASES = [
    ("This file is NOT released under the MIT License.", ""),
    ("These files were once released under the MIT License but are now proprietary.", ""),
    ("It is no longer licensed under the BSD 3-Clause License.", ""),
    ("It isn't licensed under the Apache License, Version 2.0.", ""),
    (ASIDE * 3 + "this part is not released under the MIT License.", ""),
    ("Copying is not wanted. Released under the MIT License.", "MIT"),
    ("It is not licensed under the Apache License, Version 2.0.\n\nReleased under the MIT License.", "MIT"),
    ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
     "Apache-2.0"),
    ("# SPDX-License-Identifier: Zlib", ""),
    ("# SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0"),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", "Apache-2.0,MIT"),
    ("/* SPDX-License-Identifier: (GPL-2.0-only OR BSD-3-Clause) AND ISC */", "BSD-3-Clause,GPL-2.0,ISC"),
    ("Licensed under the ISC License.", "ISC"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies.", "ISC"),
    ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"),
    ("This is free and unencumbered software released into the public domain.", "Unlicense"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.", "EPL-2.0"),
]
CASES += [(f"// SPDX-License-Identifier: {name}\nint main() {{ return 0; }}", name) for name in license_scan.TEMPLATES]


@pytest.fixture(scope="module")
def judged():
    p = license_scan.LicenseParams()
    finder, matcher = license_scan.Blocks(license_scan.TEMPLATES, p), license_scan.Matcher(license_scan.TEMPLATES, p)
    return lambda text: ",".join(sorted({n for b in finder.of(text) for n, *_ in matcher.notices(b)}))


@pytest.mark.parametrize("text,name", CASES, ids=lambda x: x[:40])
def test_text(judged, text, name):
    assert judged(text) == name


def test_scan_gives_the_same(spark):
    rows = [(i, t) for i, (t, _) in enumerate(CASES)]
    got = {r["id"]: r["licenses"] for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: name for i, (_, name) in enumerate(CASES)}

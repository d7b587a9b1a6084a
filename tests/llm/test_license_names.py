"""Operator 6: a label needs the words that name the license."""

import pytest

from access_lake.llm import license_scan


@pytest.mark.parametrize("text, labels", [
    ("licensed under CC BY-ND 4.0", ""), ("licensed under CC BY-SA 3.0", ""), ("licensed under CC BY-SA 4.0", "cc-by-sa"), ("licenced under cc by nc 4 0", "cc-by-nc"),
    ("licensed under the Apache License, Version 1.0", "apache"),  # a base phrase stays
    ("licensed under the apache licence version 1 0", ""), ("licensed under the apache licence version 2 0", "apache"),
    ("released under the mit licence", "mit"), ("released under the nit license", ""), ("released under the mitt license", ""),
    ("under the terms of the GNU Lesser General Public Licence", "lgpl"), ("under the terms of the gnu general public licence", ""),
    ("Permission to use, copy, modify, and/or distribute this sofware for any purpose", "isc"),
    ("This is free and unencumbered software released in to the public domain", "unlicense"),
    ("SPDX-License-Identifier: MIT", "mit"), ("SPDX-License-Identifier: Apache-2.0", "apache"), ("SPDX-License-Identifier: BSD-3-Clause", "bsd"),
    ("SPDX-Licence-Identifier: GPL-3.0-only", "gpl"), ("SPDX-License-Identifier: GPL-2.0", ""), ("SPDX-License-Identifier: ISC", ""),
    ("This software is provided 'as-is', without any express or implied warranty", "zlib"), ("", "")])
def test_labels(text, labels):
    scanner = license_scan.Scanner(license_scan.PHRASES, license_scan.NOTICES)
    got = scanner.scan(text.encode())
    assert got[5] == labels
    assert 0 <= got[6] <= 1 and (got[6] > 0) == bool(labels)


def test_every_naming_word_is_in_its_notice():
    for notice, words in license_scan.NAMING.items():
        assert notice in license_scan.NOTICES and all(b" " + w + b" " in b" " + notice + b" " for w in words)

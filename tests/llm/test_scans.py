"""Spans of personal data and secrets against plain searches; licences and inheritance."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from small_corpus import frame, texts

from tablesync.llm import licenses, pii, secret_scan
from tablesync.session import Scratch

PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def confirmed(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(part) < 256 for part in match.split(".")),
        "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 9 <= len(digits) <= 15,
    }[kind]()


def pii_spans(text: str | None) -> str:
    found = [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PII.items()
        for m in re.finditer(pattern, text or "")
        if confirmed(kind, m.group())
    ]
    return ",".join(found)


def secret_spans(text: str | None) -> str:
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found))


def noise(parts: list[str], n: int) -> list[str]:
    rng = random.Random(9)
    return ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(n)]


def check(df, given, want, extra: tuple[str, ...] = ()):
    rows = sorted(df.collect(), key=lambda r: r.doc_id)
    assert len(rows) == len(given)
    for row, text in zip(rows, given):
        spans = want(text)
        assert row.base_sha256 == hashlib.sha256(spans.encode()).hexdigest(), (text or "")[:200]
        kept = [s for s in row.spans.split(",") if s and s.split(":")[0] not in extra]
        assert ",".join(kept) == spans


def test_pii_equals_plain_search(spark):
    parts = ["a", "b.c", "@", "x.y", ".", "1", "255", "256", "4111 1111 1111 1111", "-", " ", "+49", "(0)", "é", "\n", "_"]
    given = texts() + noise(parts, 400) + ["a@b.c" * 3000, "1.2.3.4 " * 2000]
    check(pii.report(frame(spark, given)), given, pii_spans, ("iban", "ssn"))


def test_pii_added_kinds_and_scores(spark):
    given = [
        "iban GB82WEST12345698765432 ok",
        "iban GB82WEST12345698765433 no",
        "account: GB82 WEST 1234 5698 7654 32",
        "my ssn is 123-45-6789",
        "code 123-45-6789",
        "call +49 30 1234567 now",
        "version 1.2.3.4",
    ]
    rows = pii.with_pii(frame(spark, given)).orderBy("doc_id").collect()
    assert [[s.kind for s in r.pii] for r in rows] == [["iban"], [], ["iban"], ["ssn"], [], ["phone"], ["ip"]]
    assert rows[5].pii[0].score == 0.9 and rows[6].pii[0].score == 0.4


def test_pii_context_is_by_position(spark):
    """Lists of any length, words after a span, and matches that are not confirmed before it."""
    given = [
        "SSN: 123-45-6789, 234-56-7890, 345-67-8901",
        "SSN: " + ", ".join(["123-45-6789"] * 600),
        ", ".join(["123-45-6789"] * 300) + " and 234-56-7890 are tax ids of a tax id list",
        "123-45-6789 is the ssn",
        "ssn 000-45-6789 123-45-6789",
        "123-45-6789 " + "far away " * 6 + "ssn",
        "ssn " + "é\U0001f600" * 25 + " 123-45-6789",
    ]
    rows = pii.with_pii(frame(spark, given)).orderBy("doc_id").collect()
    assert [len([s for s in r.pii if s.kind == "ssn"]) for r in rows] == [3, 600, 301, 1, 1, 0, 0]
    assert all(given[1][s.start : s.end] == "123-45-6789" for s in rows[1].pii if s.kind == "ssn")


def test_pii_main_path_has_no_python(spark, capsys):
    pii.report(frame(spark, ["a"])).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def test_secrets_equal_plain_search(spark):
    parts = ["token", "Secret", "=", ":", " ", '"', "abcdef", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "api_key", "passwd", "é", "K", "İ", "x"]
    given = texts() + noise(parts, 800)
    check(secret_scan.report(frame(spark, given)), given, secret_spans, ("github", "npm"))


def checked_token(prefix: str, body: str) -> str:
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, rest = divmod(value, 62)
        digits = secret_scan.BASE62[rest] + digits
    return prefix + body + digits.rjust(6, "0")


def test_checksums_and_masks(spark):
    good = checked_token("ghp_", "abcdefghijABCDEFGHIJ0123456789")
    bad = good[:-1] + ("a" if good[-1] != "a" else "b")
    given = [f"x {good} y", f"x {bad} y", checked_token("npm_", "z" * 30), "password = hunter22!", None]
    rows = secret_scan.report(frame(spark, given)).orderBy("doc_id").collect()
    assert [r.spans.split(":")[0] for r in rows] == ["github", "", "npm", "assign", ""]
    masked = secret_scan.mask_secrets(frame(spark, given)).orderBy("doc_id").collect()
    assert [r.text for r in masked] == ["x [github] y", f"x {bad} y", "[npm]", "[assign]!", None]
    assert [r.n_chars for r in masked] == [12, len(given[1]), 5, 9, None]


@pytest.mark.parametrize("module", [pii, secret_scan])
def test_scans_of_empty_and_repeated(spark, module):
    assert module.report(frame(spark, [])).collect() == []
    rows = module.report(frame(spark, ["a@b.cd token=abcdef"] * 3, [7, 7, None])).collect()
    assert len(rows) == 3 and len({r.spans for r in rows}) == 1


def plain_vector(words: list[str], frequency: dict[str, int], n: int) -> dict[str, float]:
    least = n * licenses.LEAST_SHARE
    weight = {w: c * (math.log((n + 1) / (max(frequency.get(w, 0), least) + 1)) + 1) for w, c in Counter(words).items()}
    norm = math.sqrt(sum(x * x for x in weight.values()))
    return {w: x / norm for w, x in weight.items()}


def brute_licenses(files: list[tuple[str | None, str | None]]) -> list[tuple]:
    """Every line, paragraph and window of words against every template; directories by walking up."""
    n = len(files)
    words = lambda t: re.findall("[a-z]+|[0-9]+", (t or "").lower())
    frequency = Counter(w for _, t in files for w in set(words(t)))
    templates = [(name, plain_vector(words(t), frequency, n), len(words(t)), licenses.naming(t)) for name, t in licenses.TEMPLATES]

    def cosine(passage, other):
        return round(sum(v * other.get(w, 0) for w, v in plain_vector(words(passage), frequency, n).items()), 9)

    def own(text):
        text, best = text or "", (None, 0.0)
        for passage in [*text.split("\n"), *text.split("\n\n")]:
            if not licenses.CUE.search(passage):
                continue
            for name, other, _, named in templates:
                score = cosine(passage, other) if named == licenses.naming(passage) else 0
                if score >= licenses.THRESHOLD and score > best[1]:
                    best = (name, score)
        if len(text) < 1000 and licenses.CUE.search(text) and best[1] < 1:
            at = [m.span() for m in re.finditer("[A-Za-z]+|[0-9]+", text)]
            for name, other, size, named in templates:
                for length in {size, size + max(1, size // 4), size - 1 if size > 4 else size}:
                    for i in range(len(at) - length + 1):
                        passage = text[at[i][0] : at[i + length - 1][1]]
                        score = cosine(passage, other) if named == licenses.naming(passage) else 0
                        if score >= licenses.THRESHOLD and score > best[1]:
                            best = (name, score)
        return best

    found = [own(t) for _, t in files]
    holders = {}
    for (path, _), (name, score) in zip(files, found):
        if path and name and re.match(licenses.LICENCE_FILE, path.rsplit("/", 1)[-1]):
            directory = path.rpartition("/")[0]
            holders[directory] = min(holders.get(directory, (0, "~", "")), (-score, path, name))
    answer = []
    for (path, _), (name, _) in zip(files, found):
        directory, given, at = (path or "").rpartition("/")[0], None, None
        while path and not name:
            if directory in holders:
                given, at = holders[directory][2], directory
                break
            if not directory:
                break
            directory = directory.rpartition("/")[0]
        answer.append((name, name or given, at))
    return answer


def test_licenses_equal_plain_search(spark):
    long = "Prose without meaning. " * 3000
    files = [
        ("a/LICENSE", "Released under the MIT License."),
        ("a/x.txt", "nothing"),
        ("a/b/c/deep.py", long),
        ("a/b/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        ("a/b/notice.py", long + "\nLicensed under the Apache License, Version 2.0.\n" + long),
        ("a/b/license.md", "Licensed under CC BY 4.0."),
        ("top.txt", None),
        ("z/q.txt", ""),
        (None, "Released under the ISC License."),
        (None, "plain"),
        ("LICENSES/x", "copyright someone, all rights reserved"),
        ("w/1", "as of May this thing is licensed under the terms of the MIT license, with love to you all"),
        ("w/2", "one\ntwo, licensed under the Apache\nLicense, Version 2.0, three"),
        ("w/3", "this old work is licensed under the GNU General Public License, version 4, of course"),
        ("a/x.txt", "nothing"),
        *((f"r{i % 3}/{'LICENSE' if i % 5 == 0 else i}", licenses.TEMPLATES[i][1]) for i in range(len(licenses.TEMPLATES))),
    ]
    df = frame(spark, [t for _, t in files])
    paths = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(files)], "doc_id long, path string")
    scratch = Scratch(spark)
    rows = licenses.scan(df.join(paths, "doc_id"), scratch).orderBy("doc_id").collect()
    got = [(r.own_license, r.license, r.license_from) for r in rows]
    assert got == brute_licenses(files)
    assert rows[4].start == len(long) + 1 and rows[4].license_from is None
    scratch.clear()


CLAUSES = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions
and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of
conditions and the following disclaimer in the documentation.
"""
THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior permission.
"""
HEADER = """/* This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU {}General Public License as published by
 * the Free Software Foundation; either version {} of the License, or
 * (at your option) any later version. */"""
NOTICES = [
    ("Copyright 2020, Someone\n\n" + CLAUSES, ["BSD-2-Clause"]),
    ("Copyright 2020, Someone\n\n" + CLAUSES + THIRD, ["BSD-3-Clause"]),
    ("Released under the 2-clause BSD License.", ["BSD-2-Clause"]),
    (HEADER.format("", 2), ["GPL-2.0"]),
    (HEADER.format("", 3), ["GPL-3.0"]),
    (HEADER.format("Affero ", 3), ["AGPL-3.0"]),
    (HEADER.format("Lesser ", 3), ["LGPL-3.0"]),
    (HEADER.format("Lesser ", "2.1"), ["LGPL-2.1"]),
    (HEADER.format("", 7), []),
    ("# SPDX-License-Identifier: GPL-3.0-only", ["GPL-3.0"]),
    ("/* SPDX-License-Identifier: GPL-2.0+ */", ["GPL-2.0"]),
    ("SPDX-License-Identifier: MPL-2.0", ["MPL-2.0"]),
    ("SPDX-License-Identifier: BSD-2-Clause", ["BSD-2-Clause"]),
    ("SPDX-License-Identifier: ISC", ["ISC"]),
    ("SPDX-License-Identifier: AGPL-3.0-only\nint x;", ["AGPL-3.0"]),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", ["MIT", "Apache-2.0"]),
    ("spdx-license-identifier:(GPL-2.0-or-later WITH MIT) and (mit or Unheard-1.0) Apache-2.0", ["GPL-2.0", "MIT"]),
    ("SPDX-License-Identifier: OR MIT", []),
    ("SPDX-License-Identifier:", []),
    (
        "ISC License\n\nCopyright (c) 2021 Someone\n\nPermission to use, copy, modify, and/or distribute this "
        "software for any purpose with or without fee is hereby granted, provided that the above copyright "
        "notice and this permission notice appear in all copies.",
        ["ISC"],
    ),
    (
        "                 Apache License\n           Version 2.0, January 2004\n        http://www.apache.org/licenses/"
        "\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n   1. Definitions.",
        ["Apache-2.0"],
    ),
]


@pytest.mark.parametrize("rows", [1_000, 6_000_000])
@pytest.mark.parametrize("common", [{}, {"the": 1.0, "of": 0.5, "and": 0.9, "license": 0.05}])
def test_licenses_are_told_apart(rows, common):
    """What a reader would say, for either table of words."""
    matcher = licenses.Matcher(licenses.TEMPLATES, {w: int(rows * share) for w, share in common.items()}, rows)
    for text, want in NOTICES:
        found = matcher.detect(text)
        assert [f[0] for f in found] == want, (text[:70], found)
        assert all(text[start:end].strip() == text[start:end] or score < 1 for _, score, start, end in found)


def test_licenses_of_empty_and_repeated(spark):
    scratch = Scratch(spark)
    empty = frame(spark, []).withColumn("path", F.lit("a/b"))
    assert licenses.scan(empty, scratch).collect() == []
    twice = frame(spark, ["Released under the MIT License.", "x", "x"], [4, 4, None])
    rows = licenses.scan(twice.withColumn("path", F.lit("d/LICENSE")), scratch).collect()
    assert len(rows) == 3 and {r.license for r in rows} == {"MIT"}
    assert sorted(r.license_from or "" for r in rows) == ["", "d", "d"]
    scratch.clear()


def test_licenses_in_other_words():
    """Notices that are not verbatim templates; the weights do not depend on the rows' number."""
    prose = "The tools in this folder read tables and write them back in another order. "
    given = {
        "Copyright (c) 2024 Example Inc. Licensed under the MIT License.": "MIT",
        "Licensed under the MIT License, see LICENSE.": "MIT",
        "Licensed under the Apache License, Version 2.0, see LICENSE for details.": "Apache-2.0",
        "SPDX-FileCopyrightText: 2024 Example SPDX-License-Identifier: MIT": "MIT",
        prose + "Released under the ISC License.": "ISC",
        prose * 400 + "It is licensed under the terms of the MIT license. " + prose * 400: "MIT",
        "This work is licensed under the GNU Lesser General Public License, version 3, or later": "LGPL-3.0",
        "A permission slip, copyright 2024, all rights reserved, licensed to nobody.": None,
    }
    for rows in (10_000, 6_000_000):
        matcher = licenses.Matcher(licenses.TEMPLATES, {"the": rows, "license": rows // 20, "licensed": rows // 20}, rows)
        for text, want in given.items():
            found = matcher.detect(text)
            assert [f[0] for f in found] == ([want] if want else []), (text[:80], found)


def test_several_licenses(spark):
    """Two notices in a file, and two licence files in a directory."""
    mit, apache = "Licensed under the MIT License.", "Licensed under the Apache License, Version 2.0."
    files = [
        ("d/LICENSE-MIT", mit),
        ("d/LICENSE-APACHE", apache),
        ("d/e/x.py", "nothing"),
        ("both.py", f"# {mit}\n\nsome code\n\n# Or: {apache}"),
        ("f/LICENSE", f"{mit} {apache}"),
        ("f/y.py", None),
        ("z.py", "nothing"),
    ]
    df = frame(spark, [t for _, t in files])
    paths = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(files)], "doc_id long, path string")
    scratch = Scratch(spark)
    rows = licenses.scan(df.join(paths, "doc_id"), scratch).orderBy("doc_id").collect()
    scratch.clear()
    both = ["Apache-2.0", "MIT"]
    assert [r.licenses for r in rows] == [["MIT"], ["Apache-2.0"], both, both, both, both, []]
    assert [r.license_from for r in rows] == [None, None, "d", None, None, "f", None]
    for row, (_, text) in zip(rows, files):
        for found in row.own_licenses:
            assert ("MIT" if found.license == "MIT" else "Apache") in text[found.start : found.end]
        assert (row.own_licenses[0].license if row.own_licenses else None) == row.own_license

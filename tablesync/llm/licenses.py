"""Licences of files: TF-IDF cosine to notice templates, then nearest-ancestor inheritance."""

from __future__ import annotations

import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from math import log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import cut_batch, map_batches, texts_of
from tablesync.session import Scratch

# Short notices and opening paragraphs of well-known licences.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "Apache-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND "
        "CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Released under the GNU General Public License v3.0."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either version "
        "3 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation; either version "
        "2 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software "
        "Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this "
        "license document, but changing it is not allowed.",
    ),
    (
        "GPL-3.0",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software "
        "Foundation, Inc. Everyone is permitted to copy and distribute verbatim copies of this "
        "license document, but changing it is not allowed.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of "
        "the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 2.1 of the License, or (at your option) any later version.",
    ),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    ("BSD-3-Clause", "Released under the 3-clause BSD License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ),
    ("BSD-2-Clause", "Released under the 2-clause BSD License."),
    ("ISC", "Released under the ISC License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0 Universal, public domain dedication."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
THRESHOLD = 0.8
CUE = re.compile("licen[sc]|copyright|spdx|permission|redistribut|public domain", re.IGNORECASE)
WORD = re.compile(r"[a-z]+|[0-9]+")
ANY_WORD = re.compile(r"[A-Za-z]+|[0-9]+")
# Words that tell licences apart, and marks of Creative Commons licences.
FAMILY = frozenset("mit apache gnu lesser affero gpl lgpl agpl bsd isc mozilla mpl cc creative commons unencumbered".split())
CC, CC_MARKS = frozenset(("cc", "creative")), frozenset(("sa", "nc", "nd"))
# A number is a version behind such a word, or before "clause".
VERSION = re.compile(
    r"(?<![a-z0-9])(?:version|v|licen[sc]e|by|sa|nc|nd|cc0?|attribution|sharealike|noncommercial|"
    r"(?:[al]?gpl|mpl|apache)v?)[\s,-]{0,2}(?:v\.?\s*)?([0-9]+(?:\.[0-9]+)*)|([0-9])[\s-]clause"
)
SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*", re.IGNORECASE)
SPDX_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9](?:[A-Za-z0-9.+-]*[A-Za-z0-9+])?)")
SPDX_ENDINGS = ("-only", "-or-later", "+")
# Two members of one family open alike; the third clause, if any, follows within so much text.
BSD_OPENING, BSD_CLAUSE = "redistribution and use", "redistributions of source code"
BSD_THIRD = re.compile(r"neither\s+the\s+names?|endorse\s+or\s+promote", re.IGNORECASE)
BSD_REACH = 2_500
# Characters around a cue that windows are taken from, as a multiple of the longest template.
REACH = 3
BLOCK = 4096
# Words in fewer documents weigh as if they were in this share of them, so the table of
# words is bounded and no word's weight grows with the number of rows.
LEAST_SHARE = 1e-3
FLUSH = 200_000
LICENCE_FILE = r"(?i)^(licen[sc]e|copying|unlicense)([._-].*)?$"


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def naming(text: str) -> frozenset[str]:
    """Words and versions that say which licence a passage is about; 2.0 is version 2."""
    lower = text.lower()
    words = set(WORD.findall(lower))
    named = words & FAMILY
    if named & CC:
        named |= words & CC_MARKS
    for found in VERSION.finditer(lower):
        version, clauses = found.groups()
        named.add(f"{clauses} clauses" if clauses else re.sub(r"(\.0+)+$", "", version))
    return frozenset(named)


def spdx(text: str, known: dict[str, str]) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """(licence, start, end) of every known identifier in SPDX lines, and where these lines are.

    An expression joins identifiers with AND and OR, in any letters; each of them counts.
    What follows WITH is an exception, no licence. Endings that only say which later
    versions hold are left out of the licence's name.
    """
    found, places = [], []
    for line in SPDX.finditer(text):
        at, wants_name, skip = line.end(), True, False
        while token := SPDX_TOKEN.match(text, at):
            word = token.group(1)
            joins = word.upper() in ("AND", "OR", "WITH")
            if word not in "()":
                if joins == wants_name:
                    break
                if not joins and not skip:
                    name = word
                    for ending in SPDX_ENDINGS:
                        name = name[: -len(ending)] if name.lower().endswith(ending) else name
                    if name.lower() in known:
                        found.append((known[name.lower()], token.start(1), token.end(1)))
                skip = word.upper() == "WITH"
                wants_name = joins
            at = token.end()
        places.append((line.start(), at))
    return found, places


class Matcher:
    """Unit vectors of the templates, with inverted lists of their words."""

    def __init__(self, templates: tuple[tuple[str, str], ...], frequency: dict[str, int], rows: int) -> None:
        self.ids = [name for name, _ in templates]
        self.known = {name.lower(): name for name in self.ids}
        def weight(n: int) -> float:
            return log((rows + 1) / (max(n, rows * LEAST_SHARE) + 1)) + 1

        self.rare = weight(0)
        self.idf = {word: weight(n) for word, n in frequency.items() if n >= rows * LEAST_SHARE}
        self.lists: dict[str, list[tuple[int, float]]] = {}
        for at, (_, text) in enumerate(templates):
            for word, weight in self.vector(words_of(text)).items():
                self.lists.setdefault(word, []).append((at, weight))
        sizes = [len(words_of(text)) for _, text in templates]
        self.sizes = [sorted({n, n + max(1, n // 4), *([n - 1] if n > 4 else [])}) for n in sizes]
        self.longest = max((max(s) for s in self.sizes), default=0)
        self.reach = REACH * max((len(text) for _, text in templates), default=0)
        self.naming = [naming(text) for _, text in templates]
        # what a word adds to the product with each template; the last column is for other words
        self.column = {word: i for i, word in enumerate(self.lists)}
        self.gain = np.zeros((len(templates), len(self.column) + 1))
        for word, entries in self.lists.items():
            for at, weight in entries:
                self.gain[at, self.column[word]] = weight * self.idf.get(word, self.rare)

    def vector(self, words: list[str]) -> dict[str, float]:
        weights = {w: n * self.idf.get(w, self.rare) for w, n in Counter(words).items()}
        norm = sqrt(sum(v * v for v in weights.values()))
        return {w: v / norm for w, v in weights.items()}

    def best(self, text: str) -> tuple[float, str]:
        """Highest cosine of a passage to a template that names the same; of equal ones the first."""
        scores: dict[int, float] = {}
        named = naming(text)
        for word, weight in sorted(self.vector(words_of(text)).items()):
            for at, other in self.lists.get(word, ()):
                if self.naming[at] == named:
                    scores[at] = scores.get(at, 0.0) + weight * other
        if not scores:
            return 0.0, ""
        at = min(scores, key=lambda a: (-round(scores[a], 9), a))
        return round(min(1.0, scores[at]), 9), self.ids[at]

    def windows(self, text: str, begin: int, end: int) -> Iterator[tuple[float, int, int, int]]:
        """(cosine, template, start, end) of word windows of about a template's length."""
        words = [(m.start(), m.end(), m.group().lower()) for m in ANY_WORD.finditer(text, begin, end)]
        # words that the limits may have cut
        words = words[bool(begin) : len(words) - (end < len(text))]
        for at in range(0, max(1, len(words) - self.longest + 1), BLOCK):
            yield from self._windows(text, words[at : at + BLOCK + self.longest - 1])

    def _windows(self, text: str, words: list[tuple[int, int, str]]) -> Iterator[tuple[float, int, int, int]]:
        columns = [self.column.get(w, -1) for _, _, w in words]
        products = np.cumsum(self.gain[:, columns], axis=1)
        products = np.concatenate([np.zeros((len(self.ids), 1)), products], axis=1)
        squares = np.concatenate([[0], np.cumsum([self.idf.get(w, self.rare) ** 2 for _, _, w in words])])
        for template, sizes in enumerate(self.sizes):
            for size in sizes:
                if size > len(words):
                    continue
                # repeated words only make a vector longer, so this is at least the cosine
                product = products[template, size:] - products[template, :-size]
                most = product / np.sqrt(squares[size:] - squares[:-size])
                for at in np.flatnonzero(most >= THRESHOLD - 1e-9).tolist():
                    found = [w for _, _, w in words[at : at + size]]
                    if self.naming[template] != naming(text[words[at][0] : words[at + size - 1][1]]):
                        continue
                    norm = sqrt(sum((n * self.idf.get(w, self.rare)) ** 2 for w, n in Counter(found).items()))
                    score = round(min(1.0, float(product[at]) / norm), 9)
                    if score >= THRESHOLD:
                        yield score, template, words[at][0], words[at + size - 1][1]

    def detect(self, text: str) -> list[tuple[str, float, int, int]]:
        """(licence, cosine, start, end) of each licence of a whole text that reaches THRESHOLD.

        SPDX lines are read as expressions, exactly, with a score of 1. Elsewhere passages are the lines that carry a cue, the paragraphs around them, and windows
        of words around each cue, wherever they stand. Of passages that overlap, the one
        of the highest cosine counts, then lines and paragraphs before windows, then the
        first. Each licence comes once, with its best passage, the best licence first.
        """
        declared, places = spdx(text, self.known)
        passages = [(-1.0, -1, start, name, start, end) for name, start, end in declared]
        whole = text
        for start, end in places:
            text = text[:start] + " " * (end - start) + text[end:]
        found, paragraphs, regions = [], set(), []
        at = 0
        for cue in CUE.finditer(text):
            begin, finish = max(0, cue.start() - self.reach), min(len(text), cue.end() + self.reach)
            if regions and begin <= regions[-1][1]:
                regions[-1][1] = finish
            else:
                regions.append([begin, finish])
            if cue.start() < at:
                continue
            start = text.rfind("\n", 0, cue.start()) + 1
            end = text.find("\n", cue.end())
            end = len(text) if end < 0 else end
            found.append((start, end))
            first, last = text.rfind("\n\n", 0, cue.start()), text.find("\n\n", cue.end())
            around = (first + 2 if first >= 0 else 0, last if last >= 0 else len(text))
            if around != (start, end) and around not in paragraphs:
                paragraphs.add(around)
                found.append(around)
            at = end
        for order, (start, end) in enumerate(found):
            score, name = self.best(text[start:end])
            if score >= THRESHOLD:
                passages.append((-score, 0, order, name, start, end))
        for begin, finish in regions:
            for score, template, start, end in self.windows(text, begin, finish):
                passages.append((-score, 1, start, self.ids[template], start, end))
        kept: dict[str, tuple[str, float, int, int]] = {}
        taken: list[tuple[int, int]] = []
        for score, _, _, name, start, end in sorted(passages):
            place = bisect(taken, (start, end))
            before = place and taken[place - 1][1] > start
            if before or place < len(taken) and taken[place][0] < end:
                continue
            taken.insert(place, (start, end))
            name = bsd_member(whole, start, end) if name.startswith("BSD-") else name
            kept.setdefault(name, (name, -score, start, end))
        return list(kept.values())


def bsd_member(text: str, start: int, end: int) -> str:
    """Which licence a notice of the family is: named by its clauses, or told by the third one.

    An opening without any clause behind it counts as the licence with three.
    """
    passage = text[start:end].lower()
    if BSD_OPENING not in " ".join(passage.split()):
        return "BSD-2-Clause" if "2 clauses" in naming(passage) else "BSD-3-Clause"
    after = " ".join(text[start : end + BSD_REACH].split())
    more = after.lower().find(BSD_OPENING, len(BSD_OPENING))  # the next notice
    after = after[:more] if more > 0 else after
    two = BSD_CLAUSE in after.lower() and not BSD_THIRD.search(after)
    return "BSD-2-Clause" if two else "BSD-3-Clause"


def word_frequencies(docs: DataFrame, scratch: Scratch, text: str = "text") -> tuple[dict[str, int], int]:
    """In how many of all documents each word occurs, and how many documents there are.

    Words below LEAST_SHARE, which all weigh the same, are left out; that bounds the table
    by the mean number of words in a document.
    """

    def made(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
            names=["word", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for part in cut_batch(batch, "text"):
                for whole in texts_of(part, "text"):
                    seen[""] += 1
                    seen.update(set(words_of(whole)))
                    if len(seen) > FLUSH:
                        yield made(seen)
                        seen = Counter()
        yield made(seen)

    parts = docs.select(F.col(text).alias("text")).mapInArrow(count, "word string, n bigint")
    counts = scratch.write(parts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    rows = counts.where("word = ''").first()
    rows = rows.n if rows else 0
    common = counts.where((F.col("word") != "") & (F.col("n") >= rows * LEAST_SHARE))
    return dict(common.collect()), rows


def _directory(path: Column) -> Column:
    return F.when(F.instr(path, "/") > 0, F.regexp_extract(path, "^(.*)/[^/]*$", 1)).otherwise("")


def scan(
    df: DataFrame,
    scratch: Scratch,
    key: str = "doc_id",
    path: str = "path",
    text: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
) -> DataFrame:
    """One row per file: its own licences with scores and spans, and those that hold for it.

    Returns doc_id, path, own_license, own_score, start, end (code points, end exclusive),
    license, license_from, own_licenses (array of license, score, start, end; best first)
    and licenses (array of names, in order). A file's own notices hold for it; without one,
    the licence files in the nearest directory at or above it do, all of them with all
    their licences (``license_from`` is that directory). The single columns name the best:
    the highest cosine, of several licence files then the smallest path, then licence name.
    NULL and empty texts have no notice; rows without a path inherit nothing; without a
    licence the arrays are empty; repeated rows each come back; an empty table gives an
    empty result; other columns are not read.
    """
    matcher = Matcher(templates, *word_frequencies(df, scratch, text))
    rows = df.select(F.col(key).alias("doc_id"), F.col(path).alias("path"), F.col(text).alias("text"))

    fields = ("license", "score", "start", "end")
    notice = pa.struct(list(zip(fields, (pa.string(), pa.float64(), pa.int64(), pa.int64()))))

    def detect(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [[dict(zip(fields, f)) for f in matcher.detect(t)] for t in texts_of(batch, "text")]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("path"), pa.array(found, pa.list_(notice))],
            names=["doc_id", "path", "own_licenses"],
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, path string, "
        "own_licenses array<struct<license:string,score:double,start:bigint,end:bigint>>"
    )
    own = map_batches(rows, detect, schema, "text").withColumn("directory", _directory(F.col("path")))
    own = scratch.write(own, "notices")
    best = F.get("own_licenses", F.lit(0))
    own = own.select(
        "*",
        best["license"].alias("own_license"),
        best["score"].alias("own_score"),
        best["start"].alias("start"),
        best["end"].alias("end"),
    )
    name = F.regexp_extract("path", "([^/]*)$", 1)
    files = own.where(F.col("own_license").isNotNull() & F.rlike(name, F.lit(LICENCE_FILE)))
    # as many notices of a file as there are licences, at most
    files = files.select("directory", "path", "own_score", "own_license", F.explode("own_licenses").alias("one"))
    first = F.min(F.struct(-F.col("own_score"), "path", "own_license"))
    holders = files.groupBy("directory").agg(
        first.alias("best"), F.sort_array(F.collect_set("one.license")).alias("all")
    )
    holders = holders.select(F.col("directory").alias("above"), F.col("best.own_license").alias("given"), "all")
    # every directory looks at itself and all above it, once, however many files it has
    parts = F.split("directory", "/")
    directories = own.where("path IS NOT NULL").select("directory").distinct()
    ancestors = directories.select(
        "directory",
        F.posexplode(
            F.concat(
                F.array(F.lit("")),
                F.transform(
                    F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/")
                ),
            )
        ).alias("depth", "above"),
    )
    nearest = ancestors.join(holders, "above").groupBy("directory")
    nearest = nearest.agg(F.max(F.struct("depth", "above", "given", "all")).alias("nearest"))
    nearest = scratch.write(nearest, "inherited")
    alone = F.col("own_license").isNull() & F.col("path").isNotNull()
    names = F.sort_array(F.transform("own_licenses", lambda f: f["license"]))
    return own.join(nearest, "directory", "left").select(
        "doc_id",
        "path",
        "own_license",
        "own_score",
        "start",
        "end",
        F.coalesce("own_license", F.when(alone, F.col("nearest.given"))).alias("license"),
        F.when(alone, F.col("nearest.above")).alias("license_from"),
        "own_licenses",
        F.coalesce(F.when(alone, F.col("nearest.all")), names).alias("licenses"),
    )

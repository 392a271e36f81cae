"""License scans by patience alignment.

A template and a stretch of text are anchored on the words that are unique in both; the longest increasing subsequence
of the anchors' places stays, and the gaps between anchors are aligned in the same way. The share of the template's
words that get a partner is its coverage. Stretches are found by counting: one whose coverage reaches the threshold
holds that many of the template's words, so all windows of the whole text with fewer are passed over.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tally.llm.batches import balanced, byte_slices, texts_of
from tally.llm.words import Words

COVERAGE = 0.8


@dataclass(frozen=True)
class Template:
    """``key``: words without which the text is another license's."""

    name: str
    kind: str
    text: str
    key: tuple[str, ...]


# fixed values: notices as their licenses word them
TEMPLATES = (
    Template("mit-notice", "permissive", "Released under the MIT License.", ("mit", "license")),
    Template("apache-2.0-notice", "permissive", "Licensed under the Apache License, Version 2.0.", ("apache", "2", "0")),
    Template("bsd-notice", "permissive", "Released under the BSD License.", ("bsd", "license")),
    Template("gpl-3.0-notice", "copyleft", "This work is licensed under the GNU General Public License, version 3.", ("gnu", "general", "3")),
    Template("gpl-2.0-notice", "copyleft", "This work is licensed under the GNU General Public License, version 2.", ("gnu", "general", "2")),
    Template("agpl-3.0-notice", "copyleft", "This work is licensed under the GNU Affero General Public License, version 3.", ("gnu", "affero", "3")),
    Template("lgpl-3.0-notice", "copyleft", "This work is licensed under the GNU Lesser General Public License, version 3.", ("gnu", "lesser", "3")),
    Template("mpl-2.0-notice", "copyleft", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("mozilla", "public")),
    Template("cc-by-4.0-notice", "attribution", "Licensed under CC BY 4.0.", ("cc", "by", "4", "0")),
    Template("cc-by-sa-4.0-notice", "copyleft", "Licensed under CC BY-SA 4.0.", ("cc", "by", "sa", "4", "0")),
    Template("cc-by-nc-4.0-notice", "noncommercial", "Licensed under CC BY-NC 4.0.", ("cc", "by", "nc", "4", "0")),
    Template("all-rights-reserved", "reserved", "All rights reserved.", ("all", "rights", "reserved")),
    Template(
        "mit", "permissive",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
        ("permission", "granted", "sublicense"),
    ),
    Template(
        "apache-2.0", "permissive",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may '
        "obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express '
        "or implied. See the License for the specific language governing permissions and limitations under the License.",
        ("apache", "compliance"),
    ),
    Template(
        "bsd", "permissive",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
        ("redistribution", "binary"),
    ),
    Template(
        "gpl-3.0", "copyleft",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in "
        "the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        ("gnu", "redistribute", "3"),
    ),
    Template(
        "isc", "permissive",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
        ("permission", "fee", "granted"),
    ),
)

_MARKS_TO_SPACE = bytes(b if b >= 0x80 or chr(b).isalnum() or b in (9, 10, 11, 12, 13) else 32 for b in range(256))


def plain_words(texts: list[str]) -> Words:
    """Words of ASCII letters and digits (A to Z lowered) and of all other characters; ASCII marks part them."""
    words = Words.of(texts, lower=True)
    return Words(np.frombuffer(words.buffer.tobytes().translate(_MARKS_TO_SPACE), np.uint8), words.begins, words.ends, True)


def increasing(places: list[int]) -> list[int]:
    """Indexes of a longest increasing subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    for i, x in enumerate(places):
        k = bisect_left(tails, x)
        before.append(ends[k - 1] if k else -1)
        if k == len(tails):
            tails.append(x)
            ends.append(i)
        else:
            tails[k], ends[k] = x, i
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(text: list[int], template: list[int]) -> list[tuple[int, int]]:
    """Pairs of places (text, template) of the alignment, in order."""
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a >= b or c >= d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        at = {w: i for i, w in enumerate(text[a:b], a) if here[w] == 1}
        anchors = [(at[w], j) for j, w in enumerate(template[c:d], c) if there[w] == 1 and w in at]
        kept = [anchors[i] for i in increasing([i for i, _ in anchors])]
        if not kept:
            continue
        pairs += kept
        edges = [(a - 1, c - 1), *kept, (b, d)]
        gaps += [(x + 1, y, u + 1, v) for (x, u), (y, v) in zip(edges, edges[1:], strict=False)]
    return sorted(pairs)


def _longest(found: list[tuple[int, int, str, float, int]]) -> list[tuple[int, int, str, float]]:
    """Finds in order of place, without those within a find that has more words: a notice's shorter namesakes."""
    kept: list[tuple[int, int, str, float, int]] = []
    for f in sorted(found, key=lambda f: (-f[4], f)):
        if not any(k[0] <= f[0] and f[1] <= k[1] and k[4] > f[4] for k in kept):
            kept.append(f)
    return sorted(f[:4] for f in kept)


class Scanner:
    """The templates as hashes of their words."""

    def __init__(self, templates: tuple[Template, ...] = TEMPLATES, coverage: float = COVERAGE):
        self.templates, self.coverage = templates, coverage
        words = plain_words([t.text for t in templates])
        self.words = [words.hashes[a:b].tolist() for a, b in zip(words.first, words.first[1:], strict=False)]
        keys = plain_words([" ".join(t.key) for t in templates])
        self.keys = [set(keys.hashes[a:b].tolist()) for a, b in zip(keys.first, keys.first[1:], strict=False)]
        self.vocabulary = np.unique(words.hashes)
        self.member = np.array([np.isin(self.vocabulary, np.array(w, np.uint64)) for w in self.words])

    def scan(self, texts: list[str]) -> list[list[tuple[int, int, str, float]]]:
        """Of each text: (first word, end, template, coverage) of all its licenses, in order."""
        words = plain_words(texts)
        hashes, n = words.hashes, len(words.hashes)
        found: list[list[tuple[int, int, str, float, int]]] = [[] for _ in texts]
        if not n:
            return found
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        hit = np.flatnonzero(self.vocabulary[at] == hashes)
        text_of = np.searchsorted(words.first, hit, side="right") - 1
        for t, template in enumerate(self.words):
            mine = self.member[t][at[hit]]
            places, owners = hit[mine], text_of[mine]
            need = int(np.ceil(self.coverage * len(template) - 1e-9))
            span = len(template) + len(template) // 2 + 2
            if len(places) < need:
                continue
            # from each hit on, do enough hits of the same text lie within the span?
            last = np.arange(len(places)) + need - 1
            inside = last < len(places)
            starts = np.flatnonzero(inside)
            last = last[inside]
            close = (places[last] - places[starts] < span) & (owners[last] == owners[starts])
            done = -1
            for i in starts[close].tolist():
                begin, owner = int(places[i]), int(owners[i])
                if begin < done:
                    continue
                end = min(begin + span, int(words.first[owner + 1]))
                stretch = hashes[begin:end].tolist()
                if not self.keys[t] <= set(stretch):
                    continue
                pairs = patience(stretch, template)
                if len(pairs) >= need and self.keys[t] <= {stretch[a] for a, _ in pairs}:
                    zero = int(words.first[owner])
                    done = begin + pairs[-1][0] + 1
                    found[owner].append((begin + pairs[0][0] - zero, done - zero, self.templates[t].name, len(pairs) / len(template), len(pairs)))
        return [_longest(f) for f in found]


def license_scan(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates: tuple[Template, ...] = TEMPLATES, coverage: float = COVERAGE
) -> DataFrame:
    """One row per row of ``docs``: id, n_licenses, licenses (name:first word:end, comma-joined, in order of place),
    kinds (distinct kinds, sorted, comma-joined), best_license (highest coverage, ties to the longer, then the earlier)
    and best_coverage (0 without one).

    Words are runs of letters and digits, without regard to case; a license is found wherever ``coverage`` of its
    template's words align within one and a half times its length. Null and empty texts have none; repeated rows are
    scanned each; an empty table gives an empty one; further columns are left behind. Texts are read whole. No shuffle.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, coverage)
        kinds = {t.name: t.kind for t in templates}
        for part in byte_slices(batches):
            found = scanner.scan(texts_of(part))
            best = [max(f, key=lambda x: (x[3], x[1] - x[0], -x[0])) if f else None for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array([len(f) for f in found], pa.int32()),
                    pa.array([",".join(f"{name}:{a}:{b}" for a, b, name, _ in f) for f in found], pa.string()),
                    pa.array([",".join(sorted({kinds[x[2]] for x in f})) for f in found], pa.string()),
                    pa.array([b[2] if b else None for b in best], pa.string()),
                    pa.array([b[3] if b else 0.0 for b in best], pa.float64()),
                ],
                schema.names,
            )

    narrow = balanced(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")))
    schema = T.StructType(
        [
            narrow.schema["id"],
            T.StructField("n_licenses", T.IntegerType()),
            T.StructField("licenses", T.StringType()),
            T.StructField("kinds", T.StringType()),
            T.StructField("best_license", T.StringType()),
            T.StructField("best_coverage", T.DoubleType()),
        ]
    )
    return narrow.mapInArrow(scan, schema).withColumnRenamed("id", id_column)

"""License scans by patience alignment.

Texts and license templates are sequences of lower-cased words (letters and digits). A stretch of text is
aligned with a template by anchoring on words that occur exactly once in both, keeping the longest
increasing run of anchors, and aligning every gap between anchors in the same way. Coverage is the share of template words
aligned; a stretch that covers ``BOUND`` of a template is reported, every occurrence on its own.

Alignment is tried only where it can succeed: a text must hold one of the template's longest words
(so many of them that a text without any can not reach the bound), and the stretch must hold enough of the template's
words; both are necessary conditions. A stretch is at most one and a half template lengths (``STRETCH``) by definition: a notice
with more foreign words in between than half its own is not reported. Texts are read whole.

Defined results: null, empty and wordless texts give no rows. Several licenses, or several
occurrences of one, give a row each; of overlapping stretches the best covered stays (ties: more words, then the name). A declaration names its license: its own word
must be among the aligned ones, so the phrase of one license is not taken for another.
Repeated documents give repeated rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import share, shared_model, table

BOUND = 0.8
STRETCH = 1.5
WORD = re.compile(r"[^\W_]+")

# The notices that licenses ask for, and the usual one-line declarations with the word that names the license.
TEMPLATES = (
    ("MIT", "Released under the MIT License.", "mit"),
    ("MIT", "Licensed under the MIT License.", "mit"),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", "apache"),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", "gnu"),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "nc"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "commons"),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer.",
    ),
)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs (sorted by the first) whose second rises."""
    tops: list[int] = []
    heads: list[int] = []
    before: list[int] = []
    for i, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        before.append(heads[at - 1] if at else -1)
        tops[at : at + 1] = [b]
        heads[at : at + 1] = [i]
    out, i = [], heads[-1] if heads else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned positions of two word sequences; gaps wait on a list, so depth is no concern."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:  # a gap starts and ends at its anchors
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = increasing([(i, where[w]) for i, w in enumerate(a[a0:a1], a0) if w in where and in_a[w] == 1])
        if not anchors:
            continue
        found += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(found)


@dataclass
class Template:
    license: str
    words: list[str]
    bound: float
    own: str | None = None
    need: int = field(init=False)
    bag: Counter = field(init=False)
    stretch: int = field(init=False)

    def __post_init__(self):
        n = len(self.words)
        self.need = -int(-self.bound * n // 1)
        self.bag = Counter(self.words)
        self.stretch = int(STRETCH * n + 0.5)

    def markers(self) -> list[str]:
        """Words of which a text that reaches the bound holds at least one."""
        spare, out = len(self.words) - self.need, []
        for w in sorted(self.bag, key=lambda w: (-len(w), w)):
            out.append(w)
            spare -= self.bag[w]
            if spare < 0:
                break
        return out

    def matches(self, words: list[str], inside: list[bool]) -> Iterator[tuple[int, int, int]]:
        """(first word, end, aligned words) of each stretch that reaches the bound, left to right."""
        at, n = 0, len(words)
        ahead = 0  # template words in words[at : at + stretch]
        for x in inside[: self.stretch]:
            ahead += x
        while at < n:
            step = 1
            if inside[at] and ahead >= self.need:
                piece = words[at : at + self.stretch]
                held = Counter(piece)
                if sum(min(k, held[w]) for w, k in self.bag.items()) >= self.need:
                    pairs = align(piece, self.words)
                    named = self.own is None or any(self.words[j] == self.own for _, j in pairs)
                    if len(pairs) >= self.need and pairs[0][0] == 0 and named:
                        end = at + pairs[-1][0] + 1
                        yield at, end, len(pairs)
                        step = end - at
            for _ in range(step):
                ahead -= inside[at]
                at += 1
                if at + self.stretch - 1 < n:
                    ahead += inside[at + self.stretch - 1]


def templates(texts=TEMPLATES, bound: float = BOUND) -> list[Template]:
    return [Template(name, words_of(text), bound, *own) for name, text, *own in texts]


def scan_text(text: str | None, known: list[Template]) -> list[tuple[str, float, int, int, int]]:
    """(license, coverage, aligned words, first word, end) of every license found in a text."""
    words = words_of(text)
    present = set(words)
    found = []
    for t in known:
        if sum(k for w, k in t.bag.items() if w in present) < t.need:
            continue
        inside = [w in t.bag for w in words]
        found += [(t.license, n / len(t.words), n, a, b) for a, b, n in t.matches(words, inside)]
    found.sort(key=lambda f: (-f[1], -f[2], f[3], f[0]))
    kept: list[tuple[str, float, int, int, int]] = []
    for f in found:
        if all(f[4] <= k[3] or k[4] <= f[3] for k in kept):
            kept.append(f)
    return sorted(kept, key=lambda f: (f[3], f[0]))


def scan(docs: DataFrame, known: list[Template] | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per license found: ``keep`` columns, license, coverage, matched, first_word, end_word."""
    known = templates() if known is None else known
    marks = sorted({w for t in known for w in t.markers()})
    pattern = r"(?iu)(?<![\p{L}\p{N}])(?:" + "|".join(re.escape(w) for w in marks) + r")(?![\p{L}\p{N}])"
    shared = share(docs.sparkSession, known)
    picked = docs.select(*keep, F.col("text").alias("__text")).where(F.col("__text").rlike(pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared_model(shared)
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(batch.column(batch.num_columns - 1)):
                for f in scan_text(text.as_py(), known):
                    rows.append(i)
                    found.append(f)
            names, coverage, matched, first, end = zip(*found) if found else ((), (), (), (), ())
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[c.take(at) for c in batch.columns[:-1]],
                    pa.array(names, pa.string()),
                    pa.array(coverage, pa.float64()),
                    *[pa.array(x, pa.int64()) for x in (matched, first, end)],
                ],
                [*batch.schema.names[:-1], "license", "coverage", "matched", "first_word", "end_word"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return picked.mapInArrow(
        run, f"{schema}, license string, coverage double, matched long, first_word long, end_word long"
    )


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))

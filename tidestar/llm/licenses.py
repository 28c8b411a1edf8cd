"""License scans by patience alignment.

A text is aligned with each license template it may hold: words unique to both are anchors, their
longest increasing subsequence is kept, and the gaps between anchors are aligned in the same way. A
gap without such words is aligned by its longest common subsequence. Coverage is the share of the
template's words aligned in one place of the text.

Where to align is found without loss: a copy that covers the share ``c`` of ``m`` words leaves out
``(1 - c) m`` of them at most, so it holds one of any ``(1 - c) m + 1``. Those with the most letters are
looked for in the whole text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame

from tidestar.llm.batches import map_rows

WORD = re.compile(r"[^\W_]+")
COVERAGE = 0.8
#: Words that may stand between any two aligned words of one copy.
GAP = 12
#: Words that longer insertions in one copy may have in all, as a share of the template's words.
INSERTED = 1.0
SCHEMA = "doc_id bigint, license string, n_matched bigint, n_template bigint, coverage double, start bigint, stop bigint, notice string"

#: Notices and permission texts of public licenses.
TEMPLATES = {
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software.""",
    "Apache-2.0-text": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required
by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    "GPL-3.0-text": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "BSD-2-Clause-text": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""",
}


def increasing(values: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence."""
    tops: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[k], at[k] = v, i
        before[i] = at[k - 1] if k else -1
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Pairs of a longest common subsequence."""
    if not a or not b:
        return []
    length = np.zeros((len(a) + 1, len(b) + 1), np.int32)
    other = np.array(b)
    for i in range(len(a) - 1, -1, -1):
        match = np.where(other == a[i], length[i + 1, 1:] + 1, 0)
        length[i, :-1] = np.maximum.accumulate(np.maximum(match, length[i + 1, :-1])[::-1])[::-1]
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b) and length[i, j]:
        if a[i] == b[j] and length[i, j] == length[i + 1, j + 1] + 1:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif length[i, j + 1] == length[i, j]:  # rather leave a word of the template out than go far in the text
            j += 1
        else:
            i += 1
    return pairs


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned positions of two word sequences, increasing in both."""
    pairs: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        if a0 == a1 or b0 == b1:
            continue
        ours, theirs = Counter(a[a0:a1]), {w: n for w, n in Counter(b[b0:b1]).items() if n == 1}
        where = {w: j for j, w in enumerate(b[b0:b1], b0) if w in theirs}
        anchors = [(i, where[w]) for i, w in enumerate(a[a0:a1], a0) if ours[w] == 1 and w in where]
        if not anchors:
            if a0 == b0 == 0 and (a1, b1) != (len(a), len(b)):  # before the first anchor, words near to it go first
                pairs += [(a1 - 1 - i, b1 - 1 - j) for i, j in common(a[:a1][::-1], b[:b1][::-1])]
            else:
                pairs += [(a0 + i, b0 + j) for i, j in common(a[a0:a1], b[b0:b1])]
            continue
        kept = [anchors[k] for k in increasing([j for _, j in anchors])]
        pairs += kept
        edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False)]
    return sorted(pairs)


class Template:
    def __init__(self, name: str, text: str, coverage: float) -> None:
        self.name, self.words = name, [w.casefold() for w in WORD.findall(text)]
        self.least = -int(-coverage * len(self.words) // 1)
        left_out = len(self.words) - self.least
        order = sorted(range(len(self.words)), key=lambda i: (-len(self.words[i]), i))
        self.seeds = {self.words[i] for i in order[: left_out + 1]}

    def aligned(self, words: list[str], low: int, high: int, joint: int = 0) -> tuple[int, int, int]:
        """Most aligned words of a copy among words ``low`` to ``high``, the first and the last; ``joint`` words may stand between its runs."""
        runs: list[list[int]] = []  # aligned words, first and last of each
        for i, _ in patience(words[low:high], self.words):
            if runs and i - runs[-1][2] <= GAP + 1:
                runs[-1][0], runs[-1][2] = runs[-1][0] + 1, i
            else:
                runs.append([1, i, i])
        best = (0, low, low)
        for k, (n, first, last) in enumerate(runs):
            left = joint
            best = max(best, (n, low + first, low + last), key=lambda c: c[0])
            for more, start, stop in runs[k + 1 :]:
                left -= start - last - 1
                if left < 0:
                    break
                n, last = n + more, stop
                best = max(best, (n, low + first, low + last), key=lambda c: c[0])
        return best

    def found(self, words: list[str]) -> list[tuple[int, int, int]]:
        """Copies in a text: number of aligned words, first and last word."""
        m, out, after = len(self.words), [], 0
        reach = m + GAP * max(1, m - self.least) + GAP
        seeds = [i for i, w in enumerate(words) if w in self.seeds]
        for seed in seeds:
            if seed >= after:
                copy = self.aligned(words, max(after, seed - reach), seed + reach + 1)
                if copy[0] >= self.least:
                    out.append(copy)
                    after = copy[2] + 1
        joint = int(INSERTED * m)
        if joint <= GAP:
            return out
        # Copies with longer insertions lie between those found.
        edges = [0, *(e for _, first, last in out for e in (first, last + 1)), len(words)]
        for low, high in zip(edges[::2], edges[1::2], strict=True):
            after = low
            for seed in seeds[bisect_left(seeds, low) : bisect_left(seeds, high)]:
                if seed < after:
                    continue
                copy = self.aligned(words, max(after, seed - reach - joint), min(high, seed + reach + joint + 1), joint)
                if copy[0] >= self.least:
                    # The window may have ended within the copy.
                    copy = max(copy, self.aligned(words, copy[1], min(high, copy[1] + reach + joint + 1), joint), key=lambda c: c[0])
                    out.append(copy)
                    after = copy[2] + 1
        return sorted(out, key=lambda c: c[1])


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """The license notices in the whole texts of ``docs`` (``doc_id``, ``text``).

    One row for each copy of a template of which ``coverage`` or more of the words align: ``doc_id``,
    ``license``, ``n_matched``, ``n_template``, ``coverage``, and the span of characters with its text.
    Words are letters and digits, compared without case. Templates that overlap in the text are all
    reported. Null and empty texts have no rows; repeated rows are scanned each; a null ``doc_id``
    stays null. An empty table gives no rows; other columns are ignored. Nothing is shuffled.
    """
    known = [Template(name, text, coverage) for name, text in (templates or TEMPLATES).items()]
    seeds = frozenset().union(*(t.seeds for t in known))

    def make() -> Callable[[dict[str, list]], dict[str, list]]:
        def scanned(rows: dict[str, list]) -> dict[str, list]:
            out: dict[str, list] = {name.split()[0]: [] for name in SCHEMA.split(", ")}
            for doc_id, text in zip(rows["doc_id"], rows["text"], strict=True):
                words = [w.casefold() for w in WORD.findall(text or "")]
                if seeds.isdisjoint(words):
                    continue
                spans: list[tuple[int, int]] = []
                for template in known:
                    if template.seeds.isdisjoint(words):
                        continue
                    for n, first, last in template.found(words):
                        spans = spans or [m.span() for m in WORD.finditer(text)]
                        start, stop = spans[first][0], spans[last][1]
                        m = len(template.words)
                        for name, value in zip(out, (doc_id, template.name, n, m, n / m, start, stop, text[start:stop]), strict=True):
                            out[name].append(value)
            return out

        return scanned

    return map_rows(docs.select("doc_id", "text"), SCHEMA, make)

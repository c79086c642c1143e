"""License scans by conditional compression.

Texts with license vocabulary are searched for candidate windows: places, over lines, blank lines, comment marks and
within a line, that share a run of words with a template, widened to the template's length and the words that may be
added. A template within the tolerance has such a run (pigeonhole), so the runs lose nothing. In each window the
words of template and text are aligned and the part with the fewest differences is taken: the words left out of the
template and added within the part are counted, and at most ``TOLERANCE`` percent of the words may differ. Where parts
overlap, the one with the most words in common (less those that differ) wins.

Each part is compressed with zstandard, once alone and once with every license template as a raw dictionary; a template
that the part repeats makes it much smaller. Templates are ranked by that reduction; the best ones that gain, and the
one that was aligned, are compared with the part word by word. The template with the fewest differences wins, the
larger reduction breaks ties, then the name. What is left of the lines with vocabulary, in runs of consecutive lines,
goes the same way as a block of its own.

Texts are preselected with the JVM's regular expressions; only texts with such a line reach Python, whole. Templates are
a parameter; the default holds the usual one-line grants, the standard header notices and the complete license texts of
the folder ``license_texts``, a fixed list.

Defined results: null and empty texts, and texts without license vocabulary, give no row; a block that no template
explains gives a row with license null; repeated rows each give their rows; a null id stays null; empty tables give an
empty result; only the two named columns are read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher
from importlib.resources import files

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Per cent of the template's and block's words that may differ.
TOLERANCE = 20
#: Templates that are compared word by word: the best by size reduction.
CONFIRMED = 4
#: Words of the longest run that opens a window.
RUN = 4

VOCABULARY = (r"licen[sc]|copyright|©|spdx|warrant|permission is|redistribut|public domain|all rights reserved"
              r"|creative commons|\bcc by\b|\bcc0\b")

def _notice(license: str, first: str, last: str) -> str:
    """The notice at the start of a program's files under a license of the GNU family."""
    return (f"{first} is free software{':' if '3' in last else ';'} you can redistribute it and/or modify it under the "
            f"terms of the {license} as published by the Free Software Foundation; either {last}, or (at your option) "
            f"any later version. {first} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
            f"without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
            f"{license} for more details. You should have received a copy of the {license} along with this program. "
            f"If not, see <https://www.gnu.org/licenses/>.")


# Standard grants and notices, by SPDX name; the complete texts are added below.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS "
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."],
    "BSD-3-Clause": [
        "Released under the 3-Clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:"],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        _notice("GNU General Public License", "This program", "version 2 of the License")],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        _notice("GNU General Public License", "This program", "version 3 of the License")],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        _notice("GNU Lesser General Public License", "This library", "version 2.1 of the License")],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        _notice("GNU Lesser General Public License", "This library", "version 3 of the License")],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        _notice("GNU Affero General Public License", "This program", "version 3 of the License")],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0."],
    "CC0-1.0": ["Released into the public domain under CC0 1.0."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Proprietary": ["All rights reserved."],
}
for _file in sorted((files(__package__) / "license_texts").iterdir(), key=lambda f: f.name):
    TEMPLATES.setdefault(_file.name.removesuffix(".txt"), []).append(" ".join(_file.read_text("utf-8").split()))

_SCHEMA = ("doc_id bigint, first_line int, n_lines int, license string, reduction int, n_missing int, n_extra int, "
           "exact boolean, runner_up string, block string")
_ARROW = pa.schema([("doc_id", pa.int64()), ("first_line", pa.int32()), ("n_lines", pa.int32()), ("license", pa.string()),
                    ("reduction", pa.int32()), ("n_missing", pa.int32()), ("n_extra", pa.int32()), ("exact", pa.bool_()),
                    ("runner_up", pa.string()), ("block", pa.string())])
_WORD = re.compile(r"\w+(?:[.-]\w+)*")
#: Marks that directly follow a part's last word belong to it.
_MARKS = re.compile(r"[^\w\s]*")


def wording(text: str) -> list[str]:
    """Words for the comparison: lower case, version numbers and hyphenated names kept together."""
    return [w.lower() for w in _WORD.findall(text)]


def align(target: list[str], words: list[str]) -> tuple[int, int, int, int, int]:
    """(first word, end, common words, template words before and after) of the part that differs least from target."""
    best, at = (0, 0, 0, 0, 0), None
    for a, b, n in SequenceMatcher(None, target, words, autojunk=False).get_matching_blocks()[:-1]:
        # a part goes on over a gap while its common words outweigh the words between
        if at is None or gain <= b - end:
            at, gain, common, before = b, 0, 0, a
        else:
            gain -= b - end
        gain, common, end = gain + n, common + n, b + n
        if 2 * common - (end - at) > 2 * best[2] - (best[1] - best[0]):
            best = at, end, common, before, len(target) - a - n
    return best


class Scanner:
    """Templates as raw dictionaries and indexed by runs, with a memory of the blocks of the current batch."""

    def __init__(self, templates: dict[str, list[str]], tolerance: int, confirmed: int):
        self.tolerance, self.confirmed = tolerance, confirmed
        self.plain = zstandard.ZstdCompressor(level=19)
        self.known = []
        #: run length -> run -> (template, place)
        self.runs: dict[int, dict[tuple, list]] = defaultdict(lambda: defaultdict(list))
        for name, texts in sorted(templates.items()):
            for text in texts:
                content = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                content.precompute_compress(level=19)
                target = wording(text)
                missing, extra = self._may_differ(target)
                # so many common words, cut at each difference, leave a run of this length at least
                n = max(1, min(RUN, -(-(len(target) - missing) // (missing + 1)), -(-len(target) // (extra + 1))))
                for i in range(len(target) - n + 1):
                    self.runs[n][tuple(target[i: i + n])].append((len(self.known), i))
                self.known.append((name, target, zstandard.ZstdCompressor(level=19, dict_data=content), Counter(target)))
        self.seen: dict[tuple, tuple] = {}

    def _may_differ(self, target: list[str]) -> tuple[int, int]:
        """The most words that may be missing, and the most that may be added."""
        allowed = min(self.tolerance, 99)
        return allowed * len(target) // 100, allowed * len(target) // (100 - allowed)

    def parts(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(first word, end, template) of the parts of a text that a template explains, apart from each other."""
        starts = defaultdict(set)
        for n, runs in self.runs.items():
            for i, run in enumerate(zip(*(words[k:] for k in range(n)))):
                for t, place in runs.get(run, ()):
                    starts[t].add(i - place)
        found = set()
        for t, places in starts.items():
            _, target, _, bag = self.known[t]
            missing, extra = self._may_differ(target)
            first = last = None
            for s in [*sorted(places), None]:
                if first is not None and (s is None or s > first + extra):
                    low, high = max(0, first - extra), last + len(target) + extra
                    if (Counter(words[low:high]) & bag).total() >= len(target) - missing:
                        found.add(self._part(words, low, high, t))
                    first = None
                first, last = s if first is None else first, s
        chosen: list[tuple[int, int, int]] = []
        for _, _, a, b, t in sorted((f for f in found if f), key=lambda f: (f[0], f[1], f[2], self.known[f[4]][0], f[4])):
            if all(b <= c or d <= a for c, d, _ in chosen):
                chosen.append((a, b, t))
        return sorted(chosen)

    def _part(self, words: list[str], low: int, high: int, t: int) -> tuple | None:
        """The aligned part of a window, and its rank, if it is within the tolerance."""
        target = self.known[t][1]
        a, b, _, before, after = align(target, words[low:high])
        # once more without the text beyond the template's ends, which may hold the words of another copy
        a, b = low + a, low + b
        low, high = max(0, a - before - (before + 3) // 4), b + after + (after + 3) // 4
        a, b, common, _, _ = align(target, words[low:high])
        differ = len(target) - common + b - a - common
        if not common or 100 * differ > self.tolerance * max(len(target), b - a):
            return None
        return differ - common, differ, low + a, low + b, t

    def classify(self, block: str, aligned: int | None = None) -> tuple:
        """(license, reduction, n_missing, n_extra, exact, runner_up) of a block."""
        key = block, aligned
        if key not in self.seen:
            self.seen[key] = self._classify(block, aligned)
        return self.seen[key]

    def _classify(self, block: str, aligned: int | None) -> tuple:
        raw, words = block.encode("utf-8", "surrogatepass"), wording(block)
        alone = len(self.plain.compress(raw))
        ranked = sorted(((alone - len(c.compress(raw)), name, target, t) for t, (name, target, c, _) in enumerate(self.known)),
                        key=lambda r: (-r[0], r[1], len(r[2])))
        ranked = [r for r in ranked if r[0] > 0]
        # every template with the reduction of the last one compared is compared too
        last = ranked[min(self.confirmed, len(ranked)) - 1][0] if ranked else 0
        confirmed = []
        for reduction, name, target, _ in (r for r in ranked if r[0] >= last or r[3] == aligned):
            missing = extra = 0
            for tag, a, b, c, d in SequenceMatcher(None, target, words, autojunk=False).get_opcodes():
                if tag != "equal":
                    missing, extra = missing + b - a, extra + d - c
            if 100 * (missing + extra) <= self.tolerance * max(len(target), len(words)):
                confirmed.append((missing + extra, -reduction, name, missing, extra))
        runner_up = next((name for _, name, _, _ in ranked if not confirmed or name != min(confirmed)[2]), None)
        if not confirmed:
            return None, ranked[0][0] if ranked else 0, None, None, False, runner_up
        differ, reduction, name, missing, extra = min(confirmed)
        return name, -reduction, missing, extra, differ == 0, runner_up

    def blocks(self, text: str, vocabulary: re.Pattern) -> Iterator[tuple]:
        """(first line, lines, license, ..., runner_up, block) of the parts and of the vocabulary lines left over."""
        places = list(_WORD.finditer(text))
        ends = [n for n, c in enumerate(text) if c == "\n"]
        done = 0
        for a, b, t in [*self.parts([m.group().lower() for m in places]), (None, None, None)]:
            start = len(text) if a is None else places[a].start()
            above = bisect_right(ends, done - 1)
            for first, lines, block in candidate_blocks(text[done:start], vocabulary):
                yield above + first, lines, *self.classify(block), block
            if a is not None:
                done = _MARKS.match(text, places[b - 1].end()).end()
                part = text[start:done]
                block = "\n".join(line.strip() for line in part.split("\n"))
                yield bisect_right(ends, start - 1), part.count("\n") + 1, *self.classify(block, t), block


def candidate_blocks(text: str, vocabulary: re.Pattern) -> Iterator[tuple[int, int, str]]:
    """(first line, lines, text) of the maximal runs of lines with license vocabulary."""
    run: list[str] = []
    first = 0
    for n, line in enumerate([*text.split("\n"), ""]):
        if vocabulary.search(line):
            if not run:
                first = n
            run.append(line.strip())
        elif run:
            yield first, len(run), "\n".join(run)
            run = []


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, tolerance: int = TOLERANCE,
         confirmed: int = CONFIRMED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per candidate block: place, license, size reduction, wording differences, runner-up and the block."""
    known = templates or TEMPLATES
    rows = (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("t"))
            .where(F.col("t").rlike(f"(?i){VOCABULARY}")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = re.compile(VOCABULARY, re.IGNORECASE)
        scanner = Scanner(known, tolerance, confirmed)
        for batch in batches:
            out = []
            scanner.seen.clear()
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out.extend((doc_id, *row) for row in scanner.blocks(text, vocabulary))
            columns = list(zip(*out)) if out else [[]] * len(_ARROW)
            yield pa.record_batch([pa.array(list(c), f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)

    return rows.mapInArrow(run, _SCHEMA)

"""License scans by conditional compression.

A block of text that speaks of a license is compressed with zstandard once plainly and once with each template as a raw-content
dictionary. The more of the block a template explains, the more bytes it saves: templates are ranked by these reductions.

Candidates are confirmed by exact wording: the least number of words that must be inserted, dropped or changed to find the template
somewhere in the block, and which words these are. Where several templates can be read out of the same passage, the passage is compressed with each of
them: the one that explains more of it takes it, also where a shorter one differs in fewer words. Reductions that differ by no more than a match or two costs
(TIE bytes) say nothing; among those the nearest wording goes first, then the longer template, then the ranks in passage and block. The ranking has
no end before the last template: only those of whose words the block lacks more than may differ are passed over, as they can't be confirmed. What lies
between the notices found is ranked and confirmed again until nothing is left. Long blocks are searched in overlapping windows.
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The usual notices of common licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work, CC0 1.0",
    "Unlicense": "This is free and unencumbered software released into the public domain",
}
#: The usual headers of the GNU licenses: with a later version allowed (two wordings), without saying so, and with the version named first.
for _name, _kind, _version in (
    ("GPL-1.0", "General", "1"), ("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"), ("LGPL-2.0", "Library General", "2"),
    ("LGPL-2.1", "Lesser General", "2.1"), ("LGPL-3.0", "Lesser General", "3"), ("AGPL-3.0", "Affero General", "3"),
):
    _by = "as published by the Free Software Foundation"
    TEMPLATES[f"{_name}-or-later"] = f"GNU {_kind} Public License {_by}, either version {_version} of the License, or (at your option) any later version"
    TEMPLATES[f"{_name}-or-later-short"] = f"GNU {_kind} Public License {_by}, either version {_version}, or (at your option) any later version"
    TEMPLATES[f"{_name}-header"] = f"GNU {_kind} Public License {_by}, version {_version}"
    TEMPLATES[f"{_name}-header-version-first"] = f"GNU {_kind} Public License version {_version} {_by}"
#: Words that make a place a candidate.
TRIGGER = r"licen[sc]e|copyright|public[\W_]+domain|permission[\W_]+(?:is|to)|redistribution|mozilla[\W_]+public|waived[\W_]+all"
#: Share of a template's words that may differ.
MAX_DIFFERENT = 0.15
#: Words of a block that are searched at a time; more if templates are so long that windows would hardly move on.
WINDOW = 4096
LEVEL = 3
#: Bytes by which two sizes may differ before the smaller one counts as smaller: what a match more costs, and the rounding of the entropy coder.
TIE = 6
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def reach(templates: dict[str, str]) -> int:
    """Words of the longest place that one of the templates can be found in."""
    return max((n + int(MAX_DIFFERENT * n) for n in (len(words(t)) for t in templates.values())), default=0)


#: Words before and after a trigger that a block takes, across the ends of lines: no notice around the trigger is longer.
REACH = reach(TEMPLATES)


def _before(text: str, at: int, n: int, least: int) -> int:
    """Where the n-th last word before ``at`` begins; not before ``least``."""
    size = 16 * n
    while True:
        low = max(least, at - size)
        starts = [m.start() for m in _WORD.finditer(text, low, at)]
        if len(starts) > n:  # the first one may be cut
            return starts[-n] if n else at
        if low == least:
            return least
        size *= 4


def blocks(text: str, trigger: re.Pattern, around: int = REACH) -> list[tuple[int, int]]:
    """Spans of candidate blocks: each trigger with the words around it, whatever signs and ends of lines are between; overlapping ones joined."""
    out: list[tuple[int, int]] = []
    for m in trigger.finditer(text):
        least = out[-1][1] if out else 0
        begin = min(m.start(), _before(text, m.start(), around, least)) if m.start() > least else least
        end = len(text)
        for k, w in enumerate(_WORD.finditer(text, m.end())):
            if k == around:
                end = w.start()
                break
        if out and begin <= least:
            out[-1] = (out[-1][0], max(least, end))
        else:
            out.append((begin, end))
    return out


def _align(template: list[str], block: list[str], end: int | None = None) -> tuple[int, str, int, int]:
    """(least number of differing words of the template found anywhere in the block, the differences as -word and +word, first word of
    the place, word after it); with ``end``, of the places that end there."""
    rows = [[0] * (len(block) + 1)]
    for i, t in enumerate(template, 1):
        above, row = rows[-1], [i]
        for j, b in enumerate(block, 1):
            row.append(min(above[j - 1] + (t != b), above[j] + 1, row[-1] + 1))
        rows.append(row)
    end = min(range(len(block) + 1), key=lambda k: rows[-1][k]) if end is None else end
    j, i, said = end, len(template), []
    while i:
        if j and rows[i][j] == rows[i - 1][j - 1] + (template[i - 1] != block[j - 1]):
            i, j = i - 1, j - 1
            if template[i] != block[j]:
                said += [f"+{block[j]}", f"-{template[i]}"]
        elif rows[i][j] == rows[i - 1][j] + 1:
            i -= 1
            said.append(f"-{template[i]}")
        else:
            j -= 1
            said.append(f"+{block[j]}")
    return rows[-1][end], " ".join(reversed(said)), j, end


def wording(template: list[str], block: list[str]) -> tuple[int, str]:
    """(least number of differing words of the template found anywhere in the block, the differences as -word and +word)."""
    return _align(template, block)[:2]


def _least(template: np.ndarray, block: np.ndarray) -> np.ndarray:
    """For each end of a place in the block, 0 to its length, the least number of differing words."""
    at = np.arange(len(block) + 1)
    row = np.zeros(len(block) + 1, dtype=np.int64)
    for i, t in enumerate(template, 1):
        made = np.empty_like(row)
        made[0] = i
        made[1:] = np.minimum(row[:-1] + (block != t), row[1:] + 1)
        row = np.minimum.accumulate(made - at) + at
    return row


class Scanner:
    """Compressors and words of each template, kept for a task."""

    def __init__(self, templates: dict[str, str]):
        import zstandard

        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.trained = {}
        for name, text in templates.items():
            raw = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.trained[name] = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw)
        self.words = {name: own for name, text in templates.items() if (own := words(text))}
        self.ids = {w: k for k, w in enumerate(sorted({w for own in self.words.values() for w in own}))}
        self.coded = {name: np.array([self.ids[w] for w in own]) for name, own in self.words.items()}
        self.limit = {name: int(MAX_DIFFERENT * len(own)) for name, own in self.words.items()}
        self.needs = np.array([np.bincount(x, minlength=len(self.ids)) for x in self.coded.values()])
        self.spare = np.array(list(self.limit.values()))
        self.longest = reach(templates)

    def savings(self, text: str, names) -> dict[str, tuple[int, float]]:
        """(bytes saved, their share) of each template, as the dictionary with which the text is compressed."""
        raw = text.encode("utf-8", "replace")
        plain = len(self.plain.compress(raw))
        sizes = {name: len(self.trained[name].compress(raw)) for name in names}
        return {name: (plain - size, 1 - size / plain) for name, size in sizes.items()}

    def _places(self, name: str, own: list[str], coded: np.ndarray) -> list[tuple]:
        """(differing words, first word, word after it, differences) of the nearest places of one template."""
        t, limit = self.words[name], self.limit[name]
        n = _least(self.coded[name], coded)
        around = np.concatenate(([n.max() + 1], n, [n.max() + 1]))
        out = []
        for end in np.flatnonzero((n <= limit) & (n <= around[:-2]) & (n <= around[2:])).tolist():
            low = max(0, end - len(t) - limit)
            least, said, first, _ = _align(t, own[low:end], end - low)
            out.append((least, first + low, end, said))
        return out

    def _confirmed(self, text: str, own: list[str], spans: list[tuple[int, int]], coded: np.ndarray, saved: dict[str, tuple[int, float]] | None = None) -> list[tuple]:
        """Places (first word, word after it, name, reduction, differing words, differences) that don't overlap."""
        has = np.bincount(coded[coded >= 0], minlength=len(self.ids))
        lacks = np.maximum(self.needs - has, 0).sum(axis=1)  # words of a template that can't be found differ
        names = [name for name, may in zip(self.words, lacks <= self.spare) if may]
        if not names:
            return []
        saved = self.savings(text[spans[0][0]:spans[-1][1]], names) if saved is None else saved
        places = [(first, end, least, name, said) for name in sorted(names, key=lambda name: -saved[name][0]) for least, first, end, said in self._places(name, own, coded)]
        places.sort(key=lambda x: x[:2])
        taken, out, i = np.zeros(len(own), dtype=bool), [], 0
        while i < len(places):  # places that overlap contend for a passage
            j, upto = i + 1, places[i][1]
            while j < len(places) and places[j][0] < upto:
                upto = max(upto, places[j][1])
                j += 1
            rivals = places[i:j]
            here = self.savings(text[spans[rivals[0][0]][0]:spans[upto - 1][1]], {x[3] for x in rivals})
            while rivals:
                most = max(here[x[3]][0] for x in rivals)
                alike = [x for x in rivals if here[x[3]][0] >= most - TIE]
                rivals = [x for x in rivals if here[x[3]][0] < most - TIE]
                for first, end, least, name, said in sorted(alike, key=lambda x: (x[2], -len(self.words[x[3]]), -here[x[3]][0], -saved[x[3]][0], x[3])):
                    if not taken[first:end].any():
                        taken[first:end] = True
                        out.append((first, end, name, here[name][1], least, said))
            i = j
        return out

    def _window(self, text: str, own: list[str], spans: list[tuple[int, int]]) -> list[tuple]:
        """All places of a window in order: what the first ones leave is ranked and searched again."""
        coded = np.array([self.ids.get(w, -1) for w in own], dtype=np.int64)
        left, out = [(0, len(own))], []
        saved = self.savings(text[spans[0][0]:spans[-1][1]], self.words) if spans else None  # the whole window with every template
        while left:
            i, j = left.pop()
            got = sorted(self._confirmed(text, own[i:j], spans[i:j], coded[i:j], saved))
            saved = None
            out += [(i + first, i + end, *rest) for first, end, *rest in got]
            if got:
                borders = [i, *[i + b for first, end, *_ in got for b in (first, end)], j]
                left += [(a, b) for a, b in zip(borders[::2], borders[1::2]) if a < b]
        return sorted(out)

    def confirm(self, text: str) -> list[tuple[str, float, int, str, int, int]]:
        """(name, reduction, differing words, differences, begin, end) of every notice in a block, in order; begin and end in characters."""
        size, at, out = max(WINDOW, 4 * self.longest), 0, []
        while self.words:
            spans = [m.span() for m in islice(_WORD.finditer(text, at), size)]
            found = self._window(text, [text[a:b].lower() for a, b in spans], spans)
            last = len(spans) < size
            # places that end in the last words may be cut: the next window has them whole
            found = found if last else [f for f in found if f[1] <= size - self.longest]
            out += [(*f[2:], spans[f[0]][0], spans[f[1] - 1][1]) for f in found]
            if last:
                break
            at = spans[max(size - 2 * self.longest, found[-1][1] if found else 0)][0]
        return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", trigger: str = TRIGGER) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_blocks (candidates), n_found, licenses (distinct names, in order), found (array of: name, begin, end,
    reduction, n_different, differences, notice_begin, notice_end; all begins and ends are characters of the text, the first two those of the
    block, the last two those of the notice itself; reduction is that of the passage for which the template contended). A block has as many entries as it has
    notices. What ties in all goes by name.

    Null and empty texts have no candidates; rows that repeat are scanned one by one; other columns aren't read; an empty table gives no rows."""
    templates = TEMPLATES if templates is None else templates

    def run(batches):
        scanner, pattern = Scanner(templates), re.compile(trigger, re.IGNORECASE)
        kind = pa.list_(pa.struct([("name", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("reduction", pa.float64()), ("n_different", pa.int32()), ("differences", pa.string()), ("notice_begin", pa.int64()), ("notice_end", pa.int64())]))
        for batch in batches:
            n, found = [], []
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or ""
                spans = blocks(text, pattern, scanner.longest)
                n.append(len(spans))
                out = []
                for begin, end in spans:
                    for name, reduction, n_different, said, first, last in scanner.confirm(text[begin:end]):
                        out.append({"name": name, "begin": begin, "end": end, "reduction": reduction, "n_different": n_different, "differences": said, "notice_begin": begin + first, "notice_end": begin + last})
                found.append(out)
            names = [sorted({f["name"] for f in x}) for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array([len(x) for x in found], pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(found, kind)],
                names=["doc_id", "n_blocks", "n_found", "licenses", "found"],
            )

    schema = "doc_id long, n_blocks long, n_found long, licenses array<string>, found array<struct<name string, begin long, end long, reduction double, n_different int, differences string, notice_begin long, notice_end long>>"
    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, schema)

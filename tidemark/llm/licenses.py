"""License scan by conditional compression.

Every template has cues: places where it mentions licensing.  Where a text shows a
cue, each template with that cue lays a window of its own size over the text, so
that the cues meet, with some room at both ends: the candidate block.  Blocks may
lie anywhere, inside a line, over several lines or beside another notice.  A block,
its white space evened out, is compressed by itself and with the template as
zstandard raw dictionary; what this saves, as a share of the template's own compressed
size, ranks the templates.  All that save ``MIN_SAVED`` are confirmed by their exact wording: the
word difference between block and template says which words are added, missing or
changed, and a match has few of them.  Of matches that overlap, the one with the
most wording in common stays; all others are returned.

Edge cases: null or empty texts have no blocks; repeated rows are scanned one by
one; very long texts are scanned whole, window by window; an empty table gives no
rows; other columns are ignored or passed on.
"""

from __future__ import annotations

import bisect
import difflib
import re
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from . import _text as T

# License notices by SPDX id.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    ],
    "BSD-2-Clause": ["Released under the BSD 2-Clause License."],
    "ISC": ["Released under the ISC License."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "CC0-1.0": ["Released under CC0 1.0 Universal.", "To the extent possible under law, the author has waived all copyright to this work."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND-4.0": ["Licensed under CC BY-ND 4.0."],
    "CC-BY-NC-ND-4.0": ["Licensed under CC BY-NC-ND 4.0."],
    "All-Rights-Reserved": ["All rights reserved."],
}
# What a notice mentions; every template holds one of them.
CUES = ("licens", "licenc", "rights reserved", "public domain", "permission is hereby", "redistribut", "waived all copyright", "cc by", "cc0")
CUE = re.compile("|".join(c.replace(" ", r"\W{1,12}") for c in CUES), re.I)  # line breaks and comment marks may lie between
LEVEL = 3
MIN_SAVED = 0.2
MIN_WORDING = 0.9
#: Room of a window at both ends: a share of the template's length, and characters.
ROOM, ROOM_CHARS = 0.15, 16

_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")
_SPDX = re.compile(r"SPDX-License-Identifier:\s*([A-Za-z0-9.+-]+)")
SCHEMA = ("licenses array<struct<license:string,start:bigint,end:bigint,saved:double,wording:double,differences:array<string>>>")


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def _cue(m: re.Match) -> str:
    """The cue as it is listed; both spellings of the noun are one."""
    return " ".join(re.findall(r"\w+", m.group().lower())).replace("licenc", "licens")


def _size(data: bytes) -> int:
    return len(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False).compress(data))


@lru_cache(maxsize=1)
def _templates() -> tuple[list[tuple[str, list[str], zstandard.ZstdCompressor, int]], dict[str, list[tuple[int, int, int]]]]:
    """The templates (name, words, compressor, own size compressed), and by cue the templates that hold it
    with its distance from their start and from their end."""
    out, by = [], {}
    for name, texts in TEMPLATES.items():
        for t in texts:
            data = t.lower().encode() + b"\n"  # twice, as the end of a dictionary is not indexed
            d = zstandard.ZstdCompressionDict(data * 2, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            for m in CUE.finditer(t):
                by.setdefault(_cue(m), []).append((len(out), m.start(), len(t) - m.start()))
            out.append((name, words(t), zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False), _size(data)))
    return out, by


def candidate_blocks(text: str) -> list[tuple[int, int, int]]:
    """Windows of the text to be compared: (start, end, template)."""
    low = text.lower()
    if not any(c in low for c in ("licen", "reserved", "domain", "hereby", "redistribut", "waived", "cc")):
        return []
    _, by = _templates()
    out = []
    for m in CUE.finditer(text):
        for k, before, after in by.get(_cue(m), ()):
            room = int(ROOM * (before + after)) + ROOM_CHARS
            out.append((max(0, m.start() - before - room), min(len(text), m.start() + after + room), k))
    return out


def _confirm(text: str, mine: list[str], places: list[tuple[int, int]], k: int) -> tuple[float, int, int, list[str], int] | None:
    """How the words of a block match a template: likeness, start, end, differing words, words in common."""
    theirs = _templates()[0][k][1]
    blocks = [b for b in difflib.SequenceMatcher(None, mine, theirs, autojunk=False).get_matching_blocks() if b.size]
    if sum(b.size for b in blocks) < MIN_WORDING * len(theirs):
        return None
    best = None
    for i in range(len(blocks)):  # a stray word far from the rest is no part of the notice
        same = 0
        for b in blocks[i:]:
            same += b.size
            lo, hi = blocks[i].a, b.a + b.size
            likeness = 2 * same / (hi - lo + len(theirs))
            if same >= MIN_WORDING * len(theirs) and likeness >= MIN_WORDING and (best is None or (likeness, same) > best[:2]):
                best = (likeness, same, lo, hi)
    if best is None:
        return None
    likeness, same, lo, hi = best
    diff = [x for x in difflib.ndiff(theirs, mine[lo:hi]) if x[0] in "+-"] if same < max(len(theirs), hi - lo) else []
    return likeness, places[lo][0], places[hi - 1][1], diff, same


def identify(text: str, start: int, end: int, wanted: list[int]) -> list[tuple]:
    """Templates found in a block, as (words in common times likeness, start, end, license, saved share, likeness, differing words)."""
    data = " ".join(text[start:end].lower().split()).encode()
    plain = _size(data)
    templates, out = _templates()[0], []
    saved = sorted(((min(1.0, (plain - len(templates[k][2].compress(data))) / templates[k][3]), k) for k in wanted), reverse=True)
    saved = [(s, k) for s, k in saved if s >= MIN_SAVED]
    if saved:
        places = [(m.start(), m.end()) for m in _WORD.finditer(text, start, end)]
        mine = [text[a:b].lower() for a, b in places]
        for share, k in saved:
            found = _confirm(text, mine, places, k)
            if found:
                likeness, a, b, diff, same = found
                out.append((same * likeness, a, b, templates[k][0], share, likeness, diff))
    return out


def find(text: str) -> list[dict]:
    """All licenses of a whole text, by place (code points)."""
    by: dict[tuple[int, int], list[int]] = {}
    for a, b, k in candidate_blocks(text):
        by.setdefault((a, b), []).append(k)
    out = [(float("inf"), m.start(), m.end(), m.group(1), 1.0, 1.0, []) for m in _SPDX.finditer(text)]
    for (a, b), wanted in by.items():
        out += identify(text, a, b, wanted)
    kept: list[tuple] = []
    starts: list[int] = []
    for x in sorted(out, key=lambda x: (-x[0], -x[4], x[1], x[3])):
        i = bisect.bisect(starts, x[1])  # what is kept does not overlap, so only its neighbours by place can
        if (i == 0 or kept[i - 1][2] <= x[1]) and (i == len(kept) or x[2] <= kept[i][1]):
            kept.insert(i, x)
            starts.insert(i, x[1])
    return [{"license": n, "start": a, "end": b, "saved": s, "wording": w, "differences": d} for _, a, b, n, s, w, d in kept]


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document its id and ``licenses`` (``SCHEMA``)."""
    schema = T.schema([T.field(docs, id_col, id_col)], SCHEMA)
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("saved", pa.float64()),
                               ("wording", pa.float64()), ("differences", pa.list_(pa.string()))]))

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [find(t.decode()) for t in T.raw(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=schema.names)

    return T.map_groups(docs.select(id_col, text_col), fn, schema, text_col)

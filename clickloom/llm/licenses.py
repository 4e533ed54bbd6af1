"""License scan by conditional compression.

Blocks of a text that speak of licensing are compressed alone and with each template as raw dictionary; the template that
saves the largest share of a block is its winner, and an exact comparison of wording confirms it: the block must
hold the template's words in order, and what differs is counted. Short notices and full texts are templates alike.

Defined cases: a null or empty text has no block; a block that no template wins is reported without license when it
speaks of a license at all; rows are scanned one by one, so repeated rows give repeated results; an empty table gives an empty table;
other columns are not read, whatever their names. A line longer than any template is cut around the words that made it a candidate.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.shipping import ship_package

# Wordings of public licenses and their usual notices.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR "
        "IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0-1.0": ("Released under CC0 1.0 Universal, dedicated to the public domain.",),
    "proprietary": ("All rights reserved.",),
}
CANDIDATE = r"licen[sc]e|permission|redistribut|free software|creative commons|public domain|all rights reserved|\bcc0\b"
ROWS = (
    "doc_id long, block int, start long, length long, license string, saved double, "
    "missing int, changed int, confirmed boolean"
)
#: A winner saves this share of a block's compressed size at least.
LEAST_SAVED = 0.25
_CANDIDATE = re.compile(CANDIDATE, re.IGNORECASE)
_WORD = re.compile(r"[\w.+-]*\w")


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@lru_cache(maxsize=1)
def _templates() -> list[tuple]:
    import zstandard

    alone = zstandard.ZstdCompressor(level=9, write_content_size=False)
    found = [("", [], alone, 0)]
    for name, wordings in TEMPLATES.items():
        for wording in wordings:
            raw = zstandard.ZstdCompressionDict(wording.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coder = zstandard.ZstdCompressor(level=9, dict_data=raw, write_content_size=False)
            found.append((name, _words(wording), coder, len(wording)))
    return found


def blocks(text: str) -> Iterator[tuple[int, str]]:
    """(start, block): runs of lines in which each but the last is followed by another candidate or a short distance."""
    longest = max(size for *_, size in _templates())
    spans: list[list[int]] = []
    for hit in _CANDIDATE.finditer(text):
        start = text.rfind("\n", 0, hit.start()) + 1
        end = text.find("\n", hit.end())
        end = len(text) if end < 0 else end
        start, end = max(start, hit.start() - longest), min(end, hit.end() + longest)
        if spans and start <= spans[-1][1] + 80:
            spans[-1][1] = max(end, spans[-1][1])
        else:
            spans.append([start, end])
    for start, end in spans:
        yield start, text[start:end]


def _difference(template: list[str], block: list[str]) -> tuple[int, int]:
    """Words of the template that the block lacks, and words that stand inside the block's share of it instead."""
    match = difflib.SequenceMatcher(None, template, block, autojunk=False)
    same = [m for m in match.get_matching_blocks() if m.size]
    if not same:
        return len(template), 0
    hit = sum(m.size for m in same)
    inside = same[-1].b + same[-1].size - same[0].b
    return len(template) - hit, inside - hit


def judge(block: str) -> tuple[str | None, float, int, int, bool]:
    """(license, share saved, words missing, words changed, confirmed) of one block."""
    (_, _, alone, _), *templates = _templates()
    raw = block.encode("utf-8", "surrogatepass")
    size = len(alone.compress(raw))
    ranked = sorted(((len(c.compress(raw)), i) for i, (*_, c, _) in enumerate(templates)))
    words, best = _words(block), None
    # Wording decides among the best few: short notices of one family save nearly the same.
    for packed, i in ranked[:5]:
        saved = 1 - packed / size
        if saved < LEAST_SAVED:
            break
        name, template, *_ = templates[i]
        missing, changed = _difference(template, words)
        rank = (missing + changed == 0, -(missing + changed) / len(template), saved)
        if best is None or rank > best[0]:
            best = rank, (name, saved, missing, changed, missing + changed == 0)
    return best[1] if best else (None, 0.0, 0, 0, False)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for every candidate block of every text, with its place, its license and how the wording differs."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.where(F.col("text").rlike(f"(?i){CANDIDATE}"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [f.split() for f in ROWS.split(", ")]
        kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
        for batch in batches:
            out = []
            for doc, body in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                for number, (start, block) in enumerate(blocks(body)):
                    out.append((doc, number, start, len(block), *judge(block)))
            columns = list(zip(*out, strict=True)) or [()] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields]
            )

    return rows.mapInArrow(find, ROWS)

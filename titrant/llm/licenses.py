"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

A block is a paragraph: lines up to the next blank line; a license's templates are the paragraphs of its text or notice.
A template ``T`` is found in a block ``B`` if ``|B & T| >= THRESHOLD * |T|`` over distinct words. The join is exact: words are ordered by how often they stand in all
documents, rare ones first (ties: by word), and

- prefix: such a block has one of the template's first ``|T| - ceil(THRESHOLD * |T|) + 1`` words;
- length: it has at least ``ceil(THRESHOLD * |T|)`` distinct words of the templates' vocabulary;
- positional: from the first common word on, the shorter rest bounds what can still be common.

Only template words need a rank, so what is counted and broadcast is bounded by the templates, not by the corpus.
The label of a template is added to the labels of the phrases; ``score`` is the greatest share of a template found.

Edge cases: a null, empty or wordless text has no words, no labels and score 0. Repeated rows are scanned one by one;
long texts and long blocks are scanned whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import LOWER, NORMAL, Slice, map_text, slices

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
THRESHOLD = 0.8
# The texts and notices of licenses, paragraph by paragraph, as blocks are paragraphs. Left out are headings,
# copyright lines, and the disclaimer that several of them share word for word.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    ),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative Commons, PO Box 1866, Mountain View, CA 94042, USA.", "This work is licensed under a Creative Commons Attribution International License. To view a copy of this license, visit creativecommons.org/licenses/by"),
}
Templates = dict[str, Sequence[str]]
FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def _hashes(words: Sequence[str]) -> np.ndarray:
    """As :meth:`Slice.span_hash` gives for lower-cased words."""
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw])
    part = Slice(0, 1, np.frombuffer(b"".join(raw), np.uint8), np.array([0, int(ends[-1]) if len(ends) else 0]), np.zeros(1, bool))
    return part.span_hash(part.prefix_hash(), np.concatenate([[0], ends[:-1]]).astype(np.int64), ends.astype(np.int64))


def _tokens(text: str) -> list[str]:
    raw = text.encode()
    part = Slice(0, 1, np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), np.zeros(1, bool))
    low = LOWER[part.buf].tobytes()
    return [low[a:b].decode() for a, b in zip(*part.words(NORMAL)[:2], strict=True)]


class Index:
    """Templates over a global order of their words."""

    def __init__(self, templates: Templates, frequency: dict[str, int], threshold: float):
        sets = [(label, set(_tokens(text))) for label, texts in templates.items() for text in texts]
        self.vocabulary = sorted({w for _, s in sets for w in s}, key=lambda w: (frequency.get(w, 0), w))
        rank = {w: i for i, w in enumerate(self.vocabulary)}
        self.templates = [(label, np.array(sorted(rank[w] for w in s)), math.ceil(round(threshold * len(s), 9))) for label, s in sets if s]
        self.postings: dict[int, list[tuple[int, int]]] = {}
        for t, (_, ranks, least) in enumerate(self.templates):
            for place in range(len(ranks) - least + 1):
                self.postings.setdefault(int(ranks[place]), []).append((t, place))
        hashes = _hashes(self.vocabulary)
        self.order = np.argsort(hashes)
        self.sorted_hashes = hashes[self.order]
        self.in_prefix = np.zeros(len(self.vocabulary) + 1, bool)
        self.in_prefix[list(self.postings)] = True

    def ranks(self, hashes: np.ndarray) -> np.ndarray:
        """The rank of each word; the vocabulary's size if it isn't in it."""
        at = np.minimum(np.searchsorted(self.sorted_hashes, hashes), len(self.sorted_hashes) - 1)
        return np.where(self.sorted_hashes[at] == hashes, self.order[at], len(self.vocabulary))

    def matches(self, block: np.ndarray) -> Iterator[tuple[str, float]]:
        """Templates found in a block, given its distinct ranks in order."""
        seen = set()
        for j, r in enumerate(block.tolist()):
            for t, place in self.postings.get(r, ()):
                if t in seen:
                    continue
                seen.add(t)  # j and place are the first common word: nothing before it is common
                label, ranks, least = self.templates[t]
                if len(block) < least or min(len(ranks) - place, len(block) - j) < least:
                    continue
                common = len(np.intersect1d(ranks[place:], block[j:], assume_unique=True))
                if common >= least:
                    yield label, common / len(ranks)


def template_frequency(docs: DataFrame, templates: Templates | None = None, text: str = "text") -> dict[str, int]:
    """How often each template word stands in all documents: one row for each such word and task, then one for each word."""
    words = Index(templates or TEMPLATES, {}, THRESHOLD).vocabulary
    schema = "word int, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates or TEMPLATES, {}, THRESHOLD)
        counts = np.zeros(len(index.vocabulary) + 1, np.int64)
        for batch in batches:
            for part in slices(batch.column(0)):
                starts, ends, _ = part.words(NORMAL)
                counts += np.bincount(index.ranks(part.span_hash(part.prefix_hash(lower=True), starts, ends)), minlength=len(counts))
        at = np.flatnonzero(counts[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], names=["word", "n"])

    rows = docs.select(F.col(f"`{text}`")).mapInArrow(run, schema).groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {words[r.word]: r.n for r in rows}


def _blocks(part: Slice) -> np.ndarray:
    """The places where blocks begin: texts, and lines after a blank one."""
    cuts = np.flatnonzero(part.buf == 10)
    line_start = np.union1d(part.offs[:-1][np.diff(part.offs) > 0], cuts + 1)
    line_start = line_start[line_start < len(part.buf)]
    solid = np.concatenate([[0], np.cumsum((part.buf > 32) & (part.buf != 127))])
    blank = solid[np.concatenate([line_start[1:], [len(part.buf)]])] == solid[line_start]
    opens = np.concatenate([[True], blank[:-1]]) if len(line_start) else np.zeros(0, bool)
    return line_start[opens | np.isin(line_start, part.offs[:-1])]


def block_matches(part: Slice, index: Index, hashes: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, str, float]]:
    """Row, first and end byte in the slice, label and share of every template found in a block."""
    ranks = index.ranks(hashes)
    probe = np.flatnonzero(index.in_prefix[ranks])
    if not len(probe):
        return []
    begins = _blocks(part)
    out = []
    for b in np.unique(np.searchsorted(begins, starts[probe], "right") - 1).tolist():
        lo, hi = int(begins[b]), int(begins[b + 1]) if b + 1 < len(begins) else len(part.buf)
        i, j = np.searchsorted(starts, [lo, hi])
        block = np.unique(ranks[i:j])
        block = block[block < len(index.vocabulary)]
        row = int(np.searchsorted(part.offs, lo, "right")) - 1
        out += [(row, lo, hi, label, share) for label, share in index.matches(block)]
    return out


def _phrases(part: Slice, low: bytes, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, places: np.ndarray, first: dict[int, list]) -> list[list[tuple[int, str]]]:
    """By row, the first word's number and the label of every phrase."""
    out: list[list[tuple[int, str]]] = [[] for _ in range(part.n)]
    at = np.flatnonzero(np.isin(hashes, np.array(list(first), np.uint64)))
    for i in at.tolist():
        row = int(np.searchsorted(places, i, "right")) - 1
        for words, label in first[int(hashes[i])]:
            if i + len(words) <= places[row + 1] and all(low[starts[i + k] : ends[i + k]] == w for k, w in enumerate(words)):
                out[row].append((i - int(places[row]), label))
    return out


def scan(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), templates: Templates | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``keep``, the phrases' counts and labels, all labels and the score."""
    templates = templates or TEMPLATES
    frequency = template_frequency(docs, templates, text)

    def make():
        index = Index(templates, frequency, threshold)
        first: dict[int, list] = {}
        for phrase, label in PHRASES.items():
            words = phrase.split(" ")
            first.setdefault(int(_hashes(words[:1])[0]), []).append(([w.encode() for w in words], label))

        def compute(part: Slice, _) -> dict:
            starts, ends, places = part.words(NORMAL)
            hashes = part.span_hash(part.prefix_hash(lower=True), starts, ends)
            base = _phrases(part, LOWER[part.buf].tobytes(), hashes, starts, ends, places, first)
            labels, score = [{x for _, x in b} for b in base], [0.0] * part.n
            base_labels = [",".join(sorted(s)) for s in labels]
            for row, _lo, _hi, label, share in block_matches(part, index, hashes, starts):
                labels[row].add(label)
                score[row] = max(score[row], share)
            return {
                "n_words": np.diff(places),
                "n_base": [len(b) for b in base],
                "first_word": [min((i for i, _ in b), default=None) for b in base],
                "last_word": [max((i for i, _ in b), default=None) for b in base],
                "base_labels": base_labels,
                "labels": [",".join(sorted(s)) for s in labels],
                "score": score,
            }

        return compute

    return map_text(docs, text, keep, FIELDS, make)


def blocks(docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), templates: Templates | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` and ``matches``: the bytes, label and share of every block that has a template."""
    templates = templates or TEMPLATES
    frequency = template_frequency(docs, templates, text)

    def make():
        index = Index(templates, frequency, threshold)

        def compute(part: Slice, _) -> dict:
            starts, ends, _ = part.words(NORMAL)
            out: list[list[dict]] = [[] for _ in range(part.n)]
            for row, lo, hi, label, share in block_matches(part, index, part.span_hash(part.prefix_hash(lower=True), starts, ends), starts):
                out[row].append({"first_byte": lo - int(part.offs[row]), "end_byte": hi - int(part.offs[row]), "label": label, "share": share})
            return {"matches": out}

        return compute

    return map_text(docs, text, keep, "matches array<struct<first_byte:long,end_byte:long,label:string,share:double>>", make)


def query(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def sql() -> str:
    from .url_filter import SMALL, UPPER

    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    templates = ", ".join(f"('{label}', {quoted(sorted(set(_tokens(t))))})" for label, texts in TEMPLATES.items() for t in texts)
    phrases = ", ".join(f"({quoted(p.split(' '))}, '{label}')" for p, label in PHRASES.items())
    return rf"""
WITH template(label, ws) AS (VALUES {templates}), phrase(ws, label) AS (VALUES {phrases}),
doc AS (SELECT row_number() OVER () AS k, doc_id, translate(coalesce(text, ''), '{UPPER}', '{SMALL}') AS low FROM documents),
w AS (SELECT k, regexp_extract_all(low, '{word}') AS ws FROM doc),
base AS (SELECT k, i - 1 AS pos, label FROM (SELECT k, p.label, p.ws AS pw, w.ws, unnest(range(1, len(w.ws) - len(p.ws) + 2)) AS i FROM w, phrase p WHERE len(w.ws) >= len(p.ws)) WHERE list_slice(ws, i, i + len(pw) - 1) = pw),
bsum AS (SELECT k, count(*) AS n, min(pos) AS lo, max(pos) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY k),
block AS (SELECT k, list_distinct(regexp_extract_all(unnest(regexp_split_to_array(low, '\n[\x00-\x20\x7F]*\n')), '{word}')) AS ws FROM doc),
found AS (SELECT k, label, len(list_intersect(block.ws, template.ws)) / len(template.ws) AS share FROM block, template
          WHERE len(list_intersect(block.ws, template.ws)) >= ceil(round({THRESHOLD} * len(template.ws), 9))),
fmax AS (SELECT k, max(share) AS score FROM found GROUP BY k),
every AS (SELECT k, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT k, label FROM base UNION ALL SELECT k, label FROM found) GROUP BY k)
SELECT doc_id, CAST(len(w.ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
       coalesce(bsum.labels, '') AS base_labels, coalesce(every.labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM doc JOIN w USING (k) LEFT JOIN bsum USING (k) LEFT JOIN fmax USING (k) LEFT JOIN every USING (k)
"""

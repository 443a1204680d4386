"""License texts and notices in documents: MinHash bands over overlapping windows find candidates, exact
containment of word shingles verifies them.

Words are runs of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased, so punctuation and layout
don't matter. Shingles are five words (a shorter template is one shingle). A template with q shingles
belongs to the class Q, the next power of two. Texts are cut into blocks of Q shingles, and every two
neighbouring blocks are a window, so each stretch of Q shingles lies in a window whole. If a stretch holds
the share ``contained`` of a template, its window's Jaccard similarity J to it is at least
contained * q / (2 Q + (1 - contained) * q) with q > Q / 2. With bands of one row, the chance that no band agrees is
(1 - J)^bands: with 48 bands and 0.8 below 5e-5 at worst, and 1e-9 for whole templates that fill half
their window. Blocks shorter than Q at a text's end are windows too.

The least hashes of all templates of a class are looked up in one sorted table per band, so the work does not grow with the
templates. A window whose band agrees is compared with its template shingle by shingle. Texts of one family differ in
a few words only (version 2 or 3 of the GPL): of templates found in overlapping stretches, those with the most stay.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sleeveworks.llm.flatbytes import flat, mix, pieces
from sleeveworks.llm.words import word_hashes

#: Words in a shingle, bands of one row each, and the share of a template's shingles that must occur.
SHINGLE, BANDS, CONTAINED = 5, 48, 0.8
#: Bytes of text worked on at a time.
BLOCK = 1 << 20

# Notices and openings of public licenses.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "Apache-2.0-header": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied."
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
        "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
    ),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-no-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."
    ),
    "BSD-disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "EPL-2.0-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/"
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions"
    ),
    "BSL-1.0": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and "
        "transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software "
        "is furnished to do so"
    ),
    "CC0-1.0-notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-SA-4.0-notice": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-SA-4.0-short": "Licensed under CC BY-SA 4.0.",
    "MIT-short": "Licensed under the MIT License.",
    "Apache-2.0-short": "Licensed under the Apache License 2.0.",
    "LGPL-notice": "Licensed under the GNU Lesser General Public License.",
}

_SOLID = np.zeros(256, bool)
for _range in (b"09", b"az", b"AZ", b"\x80\xff"):
    _SOLID[_range[0]:_range[1] + 1] = True
_STEP = np.uint64(0x9FB21C651E98DF25)
_SEEDS = mix(np.arange(1, 1 << 10, dtype=np.uint64)) | np.uint64(1)


@dataclass
class _Shingled:
    """Shingles of the texts in a flat array: hashes, first byte, end byte, and where each text begins."""

    hashes: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray


def _shingled(data: np.ndarray, at: np.ndarray) -> _Shingled:
    solid = _SOLID[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    begin = np.flatnonzero(solid & (cut[:-1] | ~np.append(False, solid[:-1])))
    end = np.flatnonzero(solid & (cut[1:] | ~np.append(solid[1:], False))) + 1
    first = np.searchsorted(begin, at, "left")
    words = word_hashes(data, begin, end)
    counts = np.diff(first)
    made = np.where(counts >= SHINGLE, counts - SHINGLE + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), made)
    start = np.arange(int(made.sum())) - (np.cumsum(made) - made)[owner] + first[:-1][owner]
    used = np.minimum(counts, SHINGLE)[owner]
    found = np.zeros(len(start), np.uint64)
    for k in range(SHINGLE):
        has = used > k
        found[has] = mix(found[has] * _STEP + words[start[has] + k])
    return _Shingled(found, begin[start], end[start + used - 1], np.append(0, np.cumsum(made)))


class Scanner:
    """Templates, ready to be looked for."""

    def __init__(self, templates: dict[str, str], contained: float, bands: int):
        self.contained, self.bands, self.names = contained, bands, list(templates)
        self.sets = [np.unique(_shingled(*flat(pa.array([t]))).hashes) for t in templates.values()]
        self.by_class: dict[int, list[int]] = {}
        for i, members in enumerate(self.sets):
            if len(members):
                self.by_class.setdefault(1 << (len(members) - 1).bit_length(), []).append(i)
        # Per class and band: the templates' least hashes in order, and the templates they belong to.
        self.keys: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for size, templates in self.by_class.items():
            for band in range(bands):
                least = np.array([self._permuted(self.sets[t], band).min() for t in templates])
                order = np.argsort(least, kind="stable")
                self.keys.setdefault(size, []).append((least[order], np.array(templates)[order]))

    @staticmethod
    def _permuted(hashes: np.ndarray, band: int) -> np.ndarray:
        return (hashes ^ _SEEDS[2 * band]) * _SEEDS[2 * band + 1]

    def scan(self, data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, float, int, int]]:
        """Text, template, contained share, first and end byte of the best window of every match."""
        rows = _shingled(data, at)
        if not len(rows.hashes):
            return
        starts, owners, hits = {}, {}, {}
        for size in self.by_class:
            blocks = -(-np.diff(rows.first) // size)
            owners[size] = np.repeat(np.arange(len(blocks)), blocks)
            nth = np.arange(int(blocks.sum())) - (np.cumsum(blocks) - blocks)[owners[size]]
            starts[size] = rows.first[:-1][owners[size]] + nth * size
        for band in range(self.bands):
            permuted = self._permuted(rows.hashes, band)
            for size in self.by_class:
                least = np.minimum.reduceat(permuted, starts[size]) if size > 1 else permuted
                same = np.append(owners[size][1:] == owners[size][:-1], False)
                window = np.where(same, np.minimum(least, np.append(least[1:], least[-1:])), least)
                keys, templates = self.keys[size][band]
                spot = np.minimum(np.searchsorted(keys, window), len(keys) - 1)
                found = np.flatnonzero(keys[spot] == window)
                for w, k in zip(found.tolist(), spot[found].tolist()):
                    # Templates of one family may have their least hash in common.
                    while k < len(keys) and keys[k] == window[w]:
                        hits.setdefault((size, int(templates[k])), set()).add(w)
                        k += 1
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for (size, t), windows in hits.items():
            for w in sorted(windows):
                text = int(owners[size][w])
                low, high = int(starts[size][w]), min(int(starts[size][w]) + 2 * size, int(rows.first[text + 1]))
                inside = np.isin(rows.hashes[low:high], self.sets[t])
                share = len(np.unique(rows.hashes[low:high][inside])) / len(self.sets[t])
                if share >= self.contained and share > best.get((text, t), (0.0,))[0]:
                    where = np.flatnonzero(inside)
                    best[text, t] = share, int(rows.begin[low + where[0]] - at[text]), int(rows.end[low + where[-1]] - at[text])
        yield from self._strongest(best)

    @staticmethod
    def _strongest(best: dict[tuple[int, int], tuple[float, int, int]]) -> Iterator[tuple[int, int, float, int, int]]:
        """Matches without those that overlap one with a larger share in the same text."""
        by_text: dict[int, list[tuple[int, float, int, int]]] = {}
        for (text, t), found in sorted(best.items()):
            by_text.setdefault(text, []).append((t, *found))
        for text, found in by_text.items():
            for t, share, begin, end in found:
                if not any(more > share and first < end and begin < last for _, more, first, last in found):
                    yield text, t, share, begin, end


_MATCH = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("containment", pa.float64()),
                    ("start_byte", pa.int64()), ("end_byte", pa.int64())])


def _scan(templates: dict[str, str], contained: float, bands: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        scanner = Scanner(templates, contained, bands)
        for batch in pieces(batches, 1, BLOCK):
            found = list(scanner.scan(*flat(batch.column(1))))
            if found:
                text, template, share, begin, end = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(text)), pa.array([scanner.names[t] for t in template]),
                    pa.array(share, pa.float64()), pa.array(begin, pa.int64()), pa.array(end, pa.int64())], schema=_MATCH)
    return run


def licenses(docs: DataFrame, id: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None,
             contained: float = CONTAINED, bands: int = BANDS) -> DataFrame:
    """``doc_id, license, containment, start_byte, end_byte``: a row for each document and template in it.

    ``containment`` is the share of the template's distinct shingles in the best window of the document,
    ``contained`` or more; the bytes run from the first to the last of them there. A template that overlaps one with a
    larger share gives no row. Null, empty and other
    texts without a license give no row; a repeated row gives its rows again, a null id keeps its null.
    Other columns are ignored. ``templates`` (name: text) are sent to every task, so they are to be few.
    """
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(_scan(templates or TEMPLATES, contained, bands),
                           "doc_id long, license string, containment double, start_byte long, end_byte long")

"""License scan with a positional rare-token index.

Templates are license notices, each with key phrases that must stand in a file in their order. Words are weighed by their inverse
document frequency over the whole table, counted in a pass of its own. The index holds the places of each template's rarest
words, as many as hold ``RARE`` of its weight. The way into a file is its own license words, highest weight first: each is looked up,
and a posting at template place p seen at file place f says that the template may start around f - p, as far off as the file may be
shifted there. These ranges are intersected by weight: a start is left only where the rare words in range weigh so much that the
template could reach ``SIMILAR``. Only there the key phrases are checked, word for word and in order, with every place of a
phrase that is in reach; the best share of the template's weight that stands in place is its similarity. The first key
phrase may stand ``SLACK`` words off its place; between key phrases the file may have up to ``INSERTED`` words more than the
template, and what follows is laid over from there. No start or place that could pass is left out.

The base phrases are templates of one phrase that is its own key: every place of a phrase holds its rarest
word, so intersecting the postings of all its words around each place of that word finds every place.

A null or empty text has no words, no labels and score 0. Rows are returned one for one. Columns besides
``doc_id`` and ``text`` are left out. No rows give no rows.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortgram.llm.text import alnum_words, parts, texts_of

#: Share of a template's weight that its indexed words hold at least.
RARE = 0.7
#: Places by which a file's words may be shifted against the template.
SLACK = 3
#: Words a file may have between two key phrases beyond those of the template.
INSERTED = 16
#: Share of a template's weight that must stand in place.
SIMILAR = 0.6
#: Sums of weights may differ by this share of the total, by their order of adding.
_ROUNDING = 1e-9

# Base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Label, notice, key phrases. Notices are the wording that licenses recommend for files.
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("apache license",)),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl-3", "under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ("gnu general public license", "version 3 of the license")),
    ("gpl-3", "under the terms of the gnu general public license version 3 as published by the free software foundation", ("gnu general public license", "version 3")),
    ("gpl-3", "licensed under version 3 of the gnu general public license", ("version 3", "gnu general public license")),
    ("gpl-3", "either version 3 of the license or at your option any later version gnu general public license", ("version 3 of the license", "gnu general public license")),
    ("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license", "version 2")),
    ("gpl-2", "under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", ("gnu general public license", "version 2 of the license")),
    ("gpl-2", "under the terms of the gnu general public license version 2 as published by the free software foundation", ("gnu general public license", "version 2")),
    ("gpl-2", "licensed under version 2 of the gnu general public license", ("version 2", "gnu general public license")),
    ("lgpl", "licensed under the gnu lesser general public license", ("lesser general public license",)),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("lesser general public license",)),
    ("agpl-3", "licensed under the gnu affero general public license version 3", ("affero general public license",)),
    ("agpl-3", "under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license", ("affero general public license", "version 3 of the license")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("bsd", "use of this source code is governed by a bsd style license", ("bsd style license",)),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    ("cc0", "this work is dedicated to the public domain under cc0 1 0 universal", ("cc0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
)
# Label, whole notice, key phrases.
WHOLE = (
    (
        "mit",
        """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation
        files the software to deal in the software without restriction including without limitation the rights to use copy modify
        merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is
        furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be
        included in all copies or substantial portions of the software the software is provided as is without warranty of any kind
        express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and
        noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability
        whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or
        other dealings in the software""",
        ("permission is hereby granted free of charge", "the software is provided as is"),
    ),
    (
        "isc",
        """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
        provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and
        the author disclaims all warranties with regard to this software including all implied warranties of merchantability and
        fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages
        whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action
        arising out of or in connection with the use or performance of this software""",
        ("permission to use copy modify", "the software is provided as is"),
    ),
    (
        "bsd-3",
        """redistribution and use in source and binary forms with or without modification are permitted provided that the following
        conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the
        following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and
        the following disclaimer in the documentation and or other materials provided with the distribution neither the name of the
        copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
        without specific prior written permission this software is provided by the copyright holders and contributors as is and any
        express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a
        particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect
        incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or
        services loss of use data or profits or business interruption however caused and on any theory of liability whether in
        contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even
        if advised of the possibility of such damage""",
        ("redistribution and use in source and binary forms", "endorse or promote products", "as is and any express or implied warranties"),
    ),
    (
        "apache-2",
        """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
        you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed
        to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of
        any kind either express or implied see the license for the specific language governing permissions and limitations under the
        license""",
        ("apache license", "unless required by applicable law"),
    ),
)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    keys: tuple[tuple[bytes, ...], ...]

    def places(self) -> list[int]:
        """Where its key phrases start, in order."""
        found, at = [], 0
        for key in self.keys:
            at = next(i for i in range(at, len(self.words)) if self.words[i : i + len(key)] == key)
            found.append(at)
            at += len(key)
        return found


def _words(text: str) -> tuple[bytes, ...]:
    return tuple(alnum_words(text.encode()))


TEMPLATES = tuple(Template(label, _words(notice), tuple(map(_words, keys))) for label, notice, keys in (*NOTICES, *WHOLE))
KEYS = frozenset(key for t in TEMPLATES for key in t.keys)
PHRASES = {_words(phrase): label for phrase, label in BASE.items()}
VOCABULARY = frozenset(w for t in TEMPLATES for w in t.words) | frozenset(w for p in PHRASES for w in p)


def _reach(template: Template) -> list[tuple[int, int]]:
    """By place of the template, where its word may stand in a file, seen from the template's start."""
    keys, out = template.places(), []
    for place in range(len(template.words)):
        passed = sum(k <= place for k in keys)
        off = (passed + 1) * SLACK
        out.append((place - off, place + off + max(0, passed - 1) * INSERTED))
    return out


class Index:
    """Places of rare template words, and what each word weighs."""

    def __init__(self, frequencies: dict[bytes, int], documents: int):
        self.weight = {w: math.log((1 + documents) / (1 + frequencies.get(w, 0))) + 1e-6 for w in VOCABULARY}
        self.anchors = {p: max(range(len(p)), key=lambda i: self.weight[p[i]]) for p in (*PHRASES, *KEYS)}
        self.key_places = [t.places() for t in TEMPLATES]
        self.reach = [_reach(t) for t in TEMPLATES]
        self.total = [sum(self.weight[w] for w in t.words) for t in TEMPLATES]
        #: Postings of rare words, and the weight that must be found of those of a template.
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        self.rest, self.need = [], []
        for number, (template, total) in enumerate(zip(TEMPLATES, self.total)):
            held = 0.0
            for word in sorted(set(template.words), key=self._rarest):
                if held >= RARE * total:
                    break
                places = [p for p, w in enumerate(template.words) if w == word]
                self.postings[word] += [(number, p) for p in places]
                held += self.weight[word] * len(places)
            self.rest.append(total - held)
            self.need.append(held - (1 - SIMILAR + _ROUNDING) * total)
        self.entry = frozenset(p[self.anchors[p]] for p in PHRASES) | frozenset(self.postings)

    def _rarest(self, word: bytes) -> tuple:
        return -self.weight[word], word

    def starts(self, phrase: tuple[bytes, ...], places: dict[bytes, list[int]]) -> list[int]:
        """Every place of a phrase, ascending."""
        anchor = self.anchors[phrase]
        found = {at - anchor for at in places.get(phrase[anchor], ())}
        for shift, word in enumerate(phrase):
            if not found:
                break
            found &= {at - shift for at in places.get(word, ())}
        return sorted(found)

    def base(self, places: dict[bytes, list[int]]) -> list[tuple[int, str]]:
        """Start and label of every place of a base phrase."""
        return sorted((start, label) for phrase, label in PHRASES.items() for start in self.starts(phrase, places))

    def ranges(self, places: dict[bytes, list[int]]) -> Iterator[tuple[int, list[tuple[int, int, float]]]]:
        """By template the ranges of starts that it may have, each with the weight of the rare words in reach."""
        held = sorted(self.postings.keys() & places.keys(), key=self._rarest)
        weighs: Counter[int] = Counter()
        for word in held:
            for number, _ in self.postings[word]:
                weighs[number] += self.weight[word]
        open_ = {n: [] for n, weight in weighs.items() if weight >= self.need[n]}
        for word in held:
            for number, place in self.postings[word]:
                if number in open_:
                    first, last = self.reach[number][place]
                    end = None
                    for at in places[word]:
                        # Ranges of one place of the template count once.
                        if end is None or at - last >= end:
                            if end is not None:
                                open_[number].append((end, -self.weight[word]))
                            open_[number].append((at - last, self.weight[word]))
                        end = at - first + 1
                    open_[number].append((end, -self.weight[word]))
        for number, edges in open_.items():
            edges.sort()
            weight, found = 0.0, []
            for (at, change), (until, _) in zip(edges, [*edges[1:], edges[-1]]):
                weight += change
                if until > at and weight >= self.need[number]:
                    found.append((at, until, weight))
            if found:
                yield number, found

    def notices(self, words: list[bytes], places: dict[bytes, list[int]]) -> dict[str, float]:
        """The best similarity by label."""
        best: dict[str, float] = {}
        keys: dict[tuple[bytes, ...], list[int]] = {}
        for number, ranges in self.ranges(places):
            template = TEMPLATES[number]
            for key in template.keys:
                if key not in keys:
                    keys[key] = self.starts(key, places)
            if not all(keys[key] for key in template.keys):
                continue
            first, total = self.key_places[number][0], self.total[number]
            shown = sorted({at - first + off for at in keys[template.keys[0]] for off in range(-SLACK, SLACK + 1)})
            passed = best.get(template.label, 0.0)
            for begin, end, weight in sorted(ranges, key=lambda r: -r[2]):
                # No start of this range can be better.
                if (weight + self.rest[number]) / total + _ROUNDING < passed:
                    break
                for i in range(bisect_left(shown, begin), bisect_left(shown, end)):
                    passed = max(passed, self._laid_over(number, words, shown[i], keys))
                    if passed == 1.0:
                        break
            if passed >= SIMILAR:
                best[template.label] = passed
        return best

    def _laid_over(self, number: int, words: list[bytes], start: int, keys: dict[tuple[bytes, ...], list[int]]) -> float:
        """The best share in place, over all places of the key phrases."""
        template, key_places = TEMPLATES[number], self.key_places[number]
        best = -1.0

        def follow(k: int, shift: int, end: int, share: float) -> None:
            nonlocal best
            before = key_places[k - 1] if k else 0
            upto = key_places[k] if k < len(template.keys) else len(template.words)
            for place in range(before, upto):
                at, word = shift + place, template.words[place]
                if 0 <= at < len(words) and words[at] == word:
                    share += self.weight[word]
                elif word in words[max(0, at - SLACK) : max(0, at + SLACK + 1)]:
                    share += self.weight[word] / 2
            if k == len(template.keys):
                best = max(best, share)
                return
            found, more = keys[template.keys[k]], SLACK + (INSERTED if k else 0)
            for i in range(bisect_left(found, max(shift + upto - SLACK, end)), bisect_left(found, shift + upto + more + 1)):
                follow(k + 1, found[i] - upto, found[i] + len(template.keys[k]), share)

        follow(0, start, 0, 0.0)
        share = best / self.total[number]
        return 1.0 if share > 1 - _ROUNDING else max(share, 0.0)

    def scan(self, text: bytes) -> tuple:
        words = alnum_words(text)
        present = self.entry.intersection(words)
        if not present:
            return len(words), 0, None, None, "", "", 0.0
        places: dict[bytes, list[int]] = defaultdict(list)
        for at, word in enumerate(words):
            if word in VOCABULARY:
                places[word].append(at)
        base, notices = self.base(places), self.notices(words, places)
        for label in {label for _, label in base}:
            notices[label] = 1.0
        labels = ",".join(sorted({label for _, label in base}))
        first, last = (base[0][0], base[-1][0]) if base else (None, None)
        return len(words), len(base), first, last, labels, ",".join(sorted(notices)), max(notices.values(), default=0.0)


_SCANNED = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)


def _documents_with(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a task, and those of them that hold each word of the vocabulary."""
    seen: Counter[bytes] = Counter()
    for batch in parts(rows):
        for text in texts_of(batch.column("text")):
            seen.update(VOCABULARY.intersection(alnum_words(text)))
        seen[b""] += batch.num_rows
    yield pa.record_batch([pa.array([w.decode() for w in seen], pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "documents"])


def scan(docs: DataFrame) -> DataFrame:
    """Base places, labels and score of every document."""
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    counted = docs.select("text").mapInArrow(_documents_with, "word string, documents long")
    # At most one row per word of the vocabulary.
    frequencies = {r["word"].encode(): r["n"] for r in counted.groupBy("word").agg(F.sum("documents").alias("n")).collect()}
    documents = frequencies.pop(b"", 0)

    def look(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(frequencies, documents)
        for batch in parts(rows):
            found = list(zip(*map(index.scan, texts_of(batch.column("text")))))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            columns = [pa.array(c, k) for c, k in zip(found, kinds)]
            yield pa.record_batch([batch.column("doc_id"), *columns], names=[c.split()[0] for c in _SCANNED.split(", ")])

    return docs.mapInArrow(look, _SCANNED)

import random
import re

import pytest

from cohortgram.llm import license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_by_brute_force(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = []
    for phrase, label in license_scan.BASE.items():
        parts = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({l for _, l in found}))


@pytest.fixture
def texts():
    choose = random.Random(2)
    pool = "under the mit license apache version 2 cc by nc Under THE Mit.License été ß9 x".split()
    made = [" ".join(choose.choice(pool) for _ in range(choose.randint(0, 400))) for _ in range(120)]
    return [*made, None, "", "...", "under-the-mit-license", "é" * 5000 + " CC BY-NC", "x " * 60_000 + "Apache License, Version 2.0"]


def test_base_agrees_with_brute_force(docs, texts):
    rows = list(enumerate(texts))
    found = {r.doc_id: tuple(r)[1:6] for r in license_scan.scan(docs(rows)).collect()}
    assert found == {i: base_by_brute_force(t) for i, t in rows}


@pytest.mark.parametrize(
    "text, labels",
    [
        ("Released under the MIT License.", "mit"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        ("(c) X. All rights reserved.", "all-rights-reserved"),
        (
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files (the Software)",
            "mit",
        ),
        ("Use of this source code is governed by a BSD-style license that can be found here", "bsd"),
        ("The general public of the version 3 is free", ""),
        ("Public license", ""),
    ],
)
def test_labels(docs, text, labels):
    row = license_scan.scan(docs([(1, "word " * 300 + text), (2, "nothing of it")])).where("doc_id = 1").first()
    assert row.labels == labels and 0 <= row.score <= 1 and (row.score > 0) == bool(labels)


def test_base_labels_stay(docs):
    row = license_scan.scan(docs([(1, "under the mit license and under the mit license")])).first()
    assert (row.n_base, row.first_word, row.last_word, row.base_labels, row.labels) == (2, 0, 5, "mit", "mit")


def test_repeated_rows_clashing_names_and_no_rows(docs):
    frame = docs([(1, "cc by nc", "z"), (1, "cc by nc", "z"), (None, None, None)], "doc_id long, text string, labels string")
    found = license_scan.scan(frame).collect()
    assert sorted((r.doc_id or 0, r.labels) for r in found) == [(0, ""), (1, "cc-by-nc"), (1, "cc-by-nc")]
    assert license_scan.scan(docs([])).count() == 0


GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public "
    "License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
)


@pytest.mark.parametrize(
    "text, labels",
    [
        (GNU.format("", "3"), "gpl-3"),
        (GNU.format("", "2"), "gpl-2"),
        (GNU.format("Lesser ", "2.1"), "lgpl"),
        (GNU.format("Affero ", "3"), "agpl-3"),
        (GNU.format("", "3").replace("Foundation,", "Foundation, which is found in the town of Boston in the United States,"), "gpl-3"),
        ("under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.", "gpl-2"),
        ("It is licensed under version 3 of the GNU General Public License.", "gpl-3"),
        ("GNU General Public License " + "word " * 40 + "version 3 of the License", ""),
    ],
)
def test_gnu_notices(docs, text, labels):
    row = license_scan.scan(docs([(1, "word " * 300 + text), (2, "nothing of it")])).where("doc_id = 1").first()
    assert row.labels == labels


def test_a_start_with_fewer_votes_passes_where_the_first_does_not():
    notice = "redistribution and use {} source and binary forms with or without {} are permitted provided that the following conditions are met"
    common = {*notice.split(), "in"} - {"redistribution", "binary", "forms"}
    index = license_scan.Index({w.encode(): 90 for w in common}, 100)
    # The first has all rare words in place, but no key phrase; the second has the key phrase and one rare word less.
    text = f"{notice.format('of', 'modification')} {'word ' * 40}{notice.format('in', 'changes')}"
    assert index.scan(text.encode())[5] == "bsd"


def best_by_brute_force(index, words):
    """Every template at every start, with every choice of places for its key phrases."""
    best = {}
    for template, total in zip(license_scan.TEMPLATES, index.total):
        at_keys = [[i for i in range(len(words)) if tuple(words[i : i + len(k)]) == k] for k in template.keys]

        def laid(shifts):
            share = 0.0
            for place, word in enumerate(template.words):
                at = shifts[sum(k <= place for k in template.places())] + place
                if 0 <= at < len(words) and words[at] == word:
                    share += index.weight[word]
                elif word in words[max(0, at - license_scan.SLACK) : max(0, at + license_scan.SLACK + 1)]:
                    share += index.weight[word] / 2
            return share / total

        def choices(shifts, end):
            k = len(shifts) - 1
            if k == len(template.keys):
                yield shifts
                return
            here = shifts[-1] + template.places()[k]
            most = here + license_scan.SLACK + (license_scan.INSERTED if k else 0)
            for at in at_keys[k]:
                if max(end, here - license_scan.SLACK) <= at <= most:
                    yield from choices([*shifts, at - template.places()[k]], at + len(template.keys[k]))

        for start in range(-len(template.words) - 30, len(words) + 30):
            for shifts in choices([start], 0):
                score = laid(shifts)
                if score >= license_scan.SIMILAR - 1e-9:
                    best[template.label] = max(best.get(template.label, 0.0), score)
    return best


def test_notices_agree_with_all_templates_at_all_starts():
    """Notices with words changed, left out, put in and moved, decoys of key phrases and words of other weights."""
    choose = random.Random(31)
    vocabulary = sorted(license_scan.VOCABULARY)
    index = license_scan.Index({w: choose.choice([0, 3, 40, 90]) for w in vocabulary}, 100)
    seen = set()
    for _ in range(60):
        words = []
        for _ in range(choose.randint(1, 3)):
            template = choose.choice(license_scan.TEMPLATES)
            part = list(template.words)
            for _ in range(choose.randint(0, max(1, len(part) // 6))):
                at = choose.randrange(len(part))
                act = choose.random()
                if act < 0.4:
                    part[at] = choose.choice(vocabulary)
                elif act < 0.6 and len(part) > 1:
                    del part[at]
                elif act < 0.8:
                    part[at:at] = [choose.choice(vocabulary)] * choose.randint(1, 4)
                else:
                    part[at:at] = choose.choice(template.keys)
            words += [b"x"] * choose.randint(0, 5) + part
        expected = best_by_brute_force(index, words)
        places = {}
        for at, word in enumerate(words):
            if word in license_scan.VOCABULARY:
                places.setdefault(word, []).append(at)
        found = index.notices(words, places)
        assert found.keys() == expected.keys()
        assert all(abs(found[label] - min(1.0, expected[label])) < 1e-6 for label in found)
        seen |= found.keys()
    assert len(seen) > 10


def test_a_decoy_of_a_key_phrase_costs_nothing(docs):
    notice = GNU.format("", "3")
    decoy = notice.replace("either", "version 3 of the License either")
    rows = [(1, notice), (2, decoy), (3, "nothing")]
    found = {r.doc_id: r for r in license_scan.scan(docs(rows)).collect()}
    assert found[1].labels == found[2].labels == "gpl-3" and found[1].score == 1.0 and found[2].score > 0.9


@pytest.mark.parametrize("label, notice, keys", license_scan.WHOLE)
def test_whole_notices(docs, label, notice, keys):
    row = license_scan.scan(docs([(1, "Copyright (c) X\n" + notice.upper() + "."), (2, "word")])).where("doc_id = 1").first()
    assert label in row.labels.split(",") and row.score == 1.0

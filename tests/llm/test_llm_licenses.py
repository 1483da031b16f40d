import math
import random
import re
import string

import pytest

from strataline.llm.common import ROW
from strataline.llm.licenses import ANCHORS, LEAST, PHRASES, SLACK, TEMPLATES, Index, find_licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def base(text):
    words = WORD.findall((text or "").translate(LOWER))
    starts, labels = [], set()
    for phrase, label in PHRASES:
        phrase = phrase.split()
        for k in range(len(words)):
            if words[k : k + len(phrase)] == phrase:
                starts.append(k)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), sorted(labels)


TEXTS = [
    "Released under the MIT License.",
    "x " * 40 + "Licensed under the Apache License, Version 2.0. " * 3 + "y CC BY-NC 4.0",
    "under the mit under the mit license under the mit license",
    "apache license version 3",
    "cc-by-nc cc by\nnc",
    "",
    None,
    "no licence at all",
    "This work is licensed under the GNU General Public License, version 3.",
]


def test_base_places_agree_with_brute_force(docs):
    rows = find_licenses(docs(TEXTS)).orderBy(f"{ROW}.doc_id").collect()
    got = [(r.n_words, r.n_base, r.first_word, r.last_word, list(r.base_labels)) for r in rows]
    assert got == [base(t) for t in TEXTS]
    assert all(set(r.base_labels) <= set(r["labels"]) and 0 <= r.score <= 1 for r in rows)
    assert [r.score == 1 for r in rows][:3] == [True] * 3
    assert rows[-1]["labels"] == ["gpl-3"] and rows[-1].score > 0.9


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("this work is licensed under a gnu general public license version 3", ["gpl-3"]),
        ("this work is licensed under the gnu general private license version 3", []),
        ("All rights reserved.", ["all-rights-reserved"]),
        ("all the rights we reserved", []),
        ("general public license", []),
        ("Redistribution and use in source and binary forms, with or without changes, are permitted", ["bsd"]),
    ],
)
def test_templates_need_place_and_key(text, labels):
    assert Index({}, 100).scan(text.encode())[5] == labels


MIT = next(text for label, text, _ in TEMPLATES if label == "mit" and len(text.split()) > 100)


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Permission is hereby granted, entirely free of charge, to any person obtaining a copy of this software"
         " and associated documentation files", ["mit"]),
        ("x y " + MIT.replace("without limitation", "without any limitation").replace("sublicense ", "") + " z", ["mit"]),
        ("Released under the new MIT license", ["mit"]),
        ("All rights reserved. Licensed under the Apache License, Version 2.0; parts are subject to the terms of the"
         " Mozilla Public License, v. 2.0.", ["all-rights-reserved", "apache-2", "mpl-2"]),
        (" ".join(reversed(MIT.split())), []),
    ],
)
def test_words_put_in_and_several_licences(text, labels):
    assert Index({b"the": 90, b"of": 90, b"a": 80, b"to": 80}, 100).scan(text.encode())[5] == labels


def naive_common(a, b, weight):
    best = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            both = best[i][j] + weight[a[i]] if a[i] == b[j] else 0
            best[i + 1][j + 1] = max(both, best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def naive(text, frequencies, n):
    """Labels and score as the module's text says, without an index."""
    words = WORD.findall(text.translate(LOWER))
    weight = {w: math.log((n + 1) / (frequencies.get(w.encode(), 0) + 1)) + 1e-6 for _, t, _ in TEMPLATES for w in t.split()}
    labels, best = set(base(text)[4]), 0.0
    for label, template, keys in TEMPLATES:
        own = template.split()
        total = sum(weight[w] for w in own)
        shared = sorted(set(own) & set(words), key=lambda w: (-weight[w], w))
        if sum(weight[w] for w in own if w in shared) < LEAST * total:
            continue
        anchors = shared[:ANCHORS]
        spoken = {w: {p - q for q, x in enumerate(own) if x == w for p, y in enumerate(words) if y == w} for w in anchors}
        last = None
        for start in range(-len(own), len(words)):
            here = [w for w in anchors if start in spoken[w]]
            near = [w for w in anchors if spoken[w] & set(range(start, start + SLACK + 1))]
            if not here or len(near) < min(2, len(anchors)) or (last is not None and start <= last + SLACK):
                continue
            last = start
            place = words[max(0, start - SLACK) : start + len(own) + SLACK]
            score = naive_common(own, place, weight) / total
            joined = f" {' '.join(place)} "
            if score >= LEAST and any(f" {key} " in joined for key in keys):
                labels.add(label)
                best = max(best, score)
    return sorted(labels), 1.0 if base(text)[4] else best


def test_labels_agree_with_a_naive_scan():
    rng = random.Random(13)
    frequencies = {w.encode(): rng.randrange(100) for _, t, _ in TEMPLATES for w in t.split()}
    index, seen = Index(frequencies, 100), set()
    for _ in range(400):
        words = []
        for _ in range(rng.randrange(1, 4)):
            own = rng.choice(TEMPLATES)[1].split()
            for word in own:
                turn = rng.random()
                words += [word] if turn > 0.12 else [rng.choice(own)] if turn > 0.08 else [] if turn > 0.04 else ["or", word]
            words += rng.choices(["filler", "the", "of", "license"], k=rng.randrange(5))
        text = " ".join(words)
        found = index.scan(text.encode())
        labels, score = naive(text, frequencies, 100)
        assert found[5] == labels and found[6] == pytest.approx(score)
        seen |= set(labels)
    assert len(seen) > 10


def test_awkward_documents(awkward, nothing):
    rows = find_licenses(awkward).collect()
    assert len(rows) == awkward.count() and all(r.score == 0 for r in rows)
    assert find_licenses(nothing).collect() == []

"""License scans with a positional index of rare words.

Each template is a notice or a whole short licence, with a label, its words and key
phrases. Document frequencies of the templates' words, over all documents, give their
rarity. The index has the places of every word in every template. A file's licence words
are looked up from the rarest on; templates of which it has too few words by weight go
at once. For each other one the postings of the ``ANCHORS`` rarest words that the file
shares with it are intersected by relative position: a word at ``p`` in the file and
at ``q`` in the template speaks for the start ``p - q``, and a start counts if two different
words speak for it, or for one at most ``SLACK`` words off, as a word put in or left out
moves what follows. There the template is laid along the file, and its score is the share of
its words, weighed by rarity, that stand in the same order (their heaviest common
subsequence). A template is found if the score reaches ``LEAST`` and one of its mandatory
key phrases stands within the place.

Besides, fixed phrases are searched for word by word; their labels always count.

Defined results: null and empty texts have no words, no places and score 0; a text
of any length is scanned whole; of several places of a template each is tried; repeated
rows get equal results; a corpus without any of the words gives all of them the same
rarity.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.llm.common import ROW, Shared, alnum_words, map_rows, packed, quoted, utf8_list

# Phrases with their labels, and notices with label, text and key phrases.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
TEMPLATES = (
    ("mit", "released under the mit license", ("mit license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software"
        " and associated documentation files",
        ("permission is hereby granted",),
    ),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    (
        "gpl-2",
        "this program is free software you can redistribute it and or modify it under the terms of the"
        " gnu general public license version 2",
        ("general public license version 2",),
    ),
    ("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted",
        ("source and binary forms",),
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    (
        "cc-by-nc",
        "licensed under a creative commons attribution noncommercial 4 0 international license",
        ("attribution noncommercial",),
    ),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("commons attribution 4",)),
    ("cc0", "to the extent possible under law the author has waived all copyright", ("waived all copyright",)),
    ("all-rights-reserved", "all rights reserved", ("all rights reserved",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files the software to deal in the software without restriction including without limitation"
        " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to"
        " permit persons to whom the software is furnished to do so subject to the following conditions the above"
        " copyright notice and this permission notice shall be included in all copies or substantial portions of the"
        " software the software is provided as is without warranty of any kind express or implied including but not"
        " limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no"
        " event shall the authors or copyright holders be liable for any claim damages or other liability whether in"
        " an action of contract tort or otherwise arising from out of or in connection with the software or the use or"
        " other dealings in the software",
        ("permission is hereby granted", "the software is provided as is"),
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted provided that the above copyright notice and this permission notice appear in all copies",
        ("with or without fee is hereby granted",),
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met redistributions of source code must retain the above copyright notice this"
        " list of conditions and the following disclaimer redistributions in binary form must reproduce the above"
        " copyright notice this list of conditions and the following disclaimer in the documentation and or other"
        " materials provided with the distribution",
        ("source and binary forms",),
    ),
    (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance"
        " with the license you may obtain a copy of the license at",
        ("apache license version 2",),
    ),
    (
        "gpl-3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
        " public license as published by the free software foundation either version 3 of the license or at your"
        " option any later version",
        ("gnu general public license",),
    ),
)
ANCHORS = 3
SLACK = 2
LEAST = 0.7
FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.ArrayType(T.StringType())),
        T.StructField("labels", T.ArrayType(T.StringType())),
        T.StructField("score", T.DoubleType()),
    ]
)


def vocabulary() -> set[bytes]:
    return {w for _, text, _ in TEMPLATES for w in text.encode().split()}


def document_frequencies(documents: DataFrame, text: str = "text") -> tuple[dict[bytes, int], int]:
    """How many documents have each template word, and how many there are."""
    words = vocabulary()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = Counter(), 0
        for batch in batches:
            for value in utf8_list(batch):
                total += 1
                seen.update(words.intersection(alnum_words(value)))
        rows = [(w.decode(), n) for w, n in seen.items()] + [("", total)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in rows]), pa.array([n for _, n in rows], pa.int64())], names=["word", "n"]
        )

    texts = documents.select(quoted(text).cast("string").alias("text"))
    counted = texts.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).collect()
    found = {r.word.encode(): r.n for r in counted}
    return found, found.pop(b"", 0)


class Index:
    """Where each licence word stands in the templates, and how rare it is."""

    def __init__(self, frequencies: dict[bytes, int], n_documents: int):
        self.rarity = {
            word: math.log((n_documents + 1) / (frequencies.get(word, 0) + 1)) + 1e-6 for word in vocabulary()
        }
        self.templates = []
        self.postings: dict[bytes, dict[int, list[int]]] = {word: defaultdict(list) for word in self.rarity}
        for k, (label, text, keys) in enumerate(TEMPLATES):
            words = text.encode().split()
            weights = [self.rarity[w] for w in words]
            self.templates.append((label, words, weights, sum(weights), [key.encode().split() for key in keys]))
            for q, word in enumerate(words):
                self.postings[word][k].append(q)
        self.phrases = [(phrase.encode().split(), label) for phrase, label in PHRASES]

    def scan(self, text: bytes | None) -> tuple:
        words = alnum_words(text)
        places: dict[bytes, list[int]] = defaultdict(list)
        for p, word in enumerate(words):
            if word in self.rarity:
                places[word].append(p)
        starts, base = [], set()
        for phrase, label in self.phrases:
            found = [p for p in places.get(phrase[0], ()) if words[p : p + len(phrase)] == phrase]
            starts += found
            base |= {label} if found else set()
        best, labels = 0.0, set(base)
        for k, anchors in self._shared(places).items():
            label, own, _, _, keys = self.templates[k]
            for start in self._starts(k, anchors, places):
                place = words[max(0, start - SLACK) : start + len(own) + SLACK]
                score = self._along(k, place)
                if score >= LEAST and self._has_key(place, keys):
                    labels.add(label)
                    best = max(best, score)
        if base:
            best = 1.0
        return (
            len(words),
            len(starts),
            min(starts, default=None),
            max(starts, default=None),
            sorted(base),
            sorted(labels),
            min(1.0, best),
        )

    def _shared(self, places: dict[bytes, list[int]]) -> dict[int, list[bytes]]:
        """The templates that a file has enough words of, each with its anchors."""
        weight: dict[int, float] = defaultdict(float)
        anchors: dict[int, list[bytes]] = defaultdict(list)
        for word in sorted(places, key=lambda w: (-self.rarity[w], w)):
            for k, at in self.postings[word].items():
                weight[k] += self.rarity[word] * len(at)
                if len(anchors[k]) < ANCHORS:
                    anchors[k].append(word)
        return {k: anchors[k] for k in sorted(weight) if weight[k] >= LEAST * self.templates[k][3] * (1 - 1e-9)}

    def _starts(self, k: int, anchors: list[bytes], places: dict[bytes, list[int]]) -> Iterator[int]:
        """Starts that two anchors speak for, or the only one, in order and without close repetitions."""
        spoken = sorted({(p - q, n) for n, w in enumerate(anchors) for q in self.postings[w][k] for p in places[w]})
        needed, last = min(2, len(anchors)), None
        for i, (start, own) in enumerate(spoken):
            if last is not None and start <= last + SLACK:
                continue
            near = {own}
            for other, n in spoken[i + 1 : i + 1 + ANCHORS * (SLACK + 1)]:
                if other > start + SLACK:
                    break
                near.add(n)
            if len(near) >= needed:
                last = start
                yield start

    def _along(self, k: int, place: list[bytes]) -> float:
        """The weight of the heaviest common subsequence of template and place, as a share."""
        _, own, weights, total, _ = self.templates[k]
        row = [0.0] * (len(place) + 1)
        for word, weight in zip(own, weights, strict=True):
            before = 0.0
            for j, other in enumerate(place):
                above = row[j + 1]
                row[j + 1] = before + weight if word == other else max(above, row[j])
                before = above
        return row[-1] / total

    @staticmethod
    def _has_key(place: list[bytes], keys: list[list[bytes]]) -> bool:
        return any(place[k : k + len(key)] == key for key in keys for k in range(len(place) - len(key) + 1))


def find_licenses(documents: DataFrame, text: str = "text", keep_text: bool = False) -> DataFrame:
    """The other columns (``row``), the text if wanted, and what the scan finds in it."""
    index = Index(*document_frequencies(documents, text))
    shared = Shared(documents.sparkSession, index)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        own = shared.get()
        for batch in batches:
            found = [own.scan(t) for t in utf8_list(batch)]
            yield {name: [f[k] for f in found] for k, name in enumerate(FOUND.names)}

    return map_rows(documents.select(*packed(documents, text)), FOUND, work, [ROW, "text"] if keep_text else [ROW])

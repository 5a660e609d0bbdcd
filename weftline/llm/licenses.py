"""License scans: phrases, and an exact set-similarity join of text blocks with notice templates."""

from __future__ import annotations

import re
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# The wording of public notices, in lower case without punctuation, with the label of each.
TEMPLATES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under the creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "this work is licensed under the creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    "licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl-3",
    "licensed under the gnu lesser general public license version 3": "lgpl-3",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl-3",
    "subject to the terms of the mozilla public license version 2 0": "mpl-2",
    "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at": "mpl-2",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
}
#: Share of a template's distinct words that a block must hold; up to 19 distinct words that is all of them.
CONTAINMENT = 0.95
#: Words of a block for each word of the template that it is compared with.
BLOCK = 1.5


def words_of(text: bytes) -> list[bytes]:
    """Runs of letters, digits and non-ASCII after A-Z are lower-cased."""
    return WORD.findall(text.lower())


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(start word, label) of every place where a phrase's words stand consecutively."""
    places = []
    present = None
    for phrase, label in phrases.items():
        want = phrase.encode().split()
        if present is None:
            present = set(words)
        if any(w not in present for w in want):
            continue
        i, k = -1, len(want)
        while True:
            try:
                i = words.index(want[0], i + 1)
            except ValueError:
                break
            if words[i:i + k] == want:
                places.append((i, label))
    return places


def frequency_order(docs: DataFrame, text_col: str, tokens: list[bytes]) -> dict[bytes, int]:
    """Occurrences in the whole corpus of each of the templates' words; one row a word is gathered."""
    def run(batches):
        import pyarrow as pa

        found = dict.fromkeys(tokens, 0)
        known = set(tokens)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for w in words_of((text or "").encode("utf-8", "surrogatepass")):
                    if w in known:
                        found[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in found]), pa.array(list(found.values()), pa.int64())], names=["w", "n"])

    rows = map_batches(docs.select(F.col(text_col).cast("string").alias("text")), run, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    return dict.fromkeys(tokens, 0) | {r["w"].encode(): r["n"] for r in rows}


class ContainmentJoin:
    """Finds every template of whose distinct words a block of a text holds at least ``threshold``.

    A block is a run of ``BLOCK`` times the template's words, rounded up, anywhere in the text, line breaks or not.
    Each template's words are put in order of rising corpus frequency. A block that qualifies lacks
    at most size - need of them, so it holds one of the first size - need + 1 (prefix filter); the text has ``need`` or more of
    them (length filter); and a block whose first word in that order stands at place i
    shares at most size - i (positional filter). So only blocks around words of the prefix are counted, each exactly.
    """

    def __init__(self, templates: dict[str, str], frequency: dict[bytes, int], threshold: float):
        self.sets, self.prefix = [], {}
        for text, label in templates.items():
            given = text.encode().split()
            order = sorted(set(given), key=lambda w: (frequency.get(w, 0), w))
            need = ceil(threshold * len(order) - 1e-9)
            self.sets.append(({w: i for i, w in enumerate(order)}, need, ceil(BLOCK * len(given)), label))
            for w in order[:len(order) - need + 1]:
                self.prefix.setdefault(w, []).append(len(self.sets) - 1)

    def find(self, words: list[bytes], present: set[bytes]) -> list[tuple[str, float]]:
        """(label, largest share) of each template found; ``present`` are the distinct words."""
        out = []
        for k in sorted({k for w in self.prefix.keys() & present for k in self.prefix[w]}):
            order, need, length, label = self.sets[k]
            if len(order.keys() & present) >= need and (most := self.most_shared(words, order, need, length)) >= need:
                out.append((label, most / len(order)))
        return out

    @staticmethod
    def most_shared(words: list[bytes], order: dict[bytes, int], need: int, length: int) -> int:
        """Distinct words of ``order`` in the best block of ``length`` words, if that has ``need`` or more."""
        at = [(i, order[w]) for i, w in enumerate(words) if w in order]
        last_prefix, best = len(order) - need, 0
        count, shared, prefixes, tail = [0] * len(order), 0, 0, 0
        for i, place in at:  # blocks that end at a shared word
            count[place] += 1
            shared += count[place] == 1
            prefixes += place <= last_prefix
            while at[tail][0] <= i - length:
                old = at[tail][1]
                count[old] -= 1
                shared -= count[old] == 0
                prefixes -= old <= last_prefix
                tail += 1
            if prefixes and shared > best and len(order) - next(p for p, c in enumerate(count) if c) >= need:
                best = shared
        return best


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None, threshold: float = CONTAINMENT) -> DataFrame:
    """License findings of every row's whole text.

    Returns ``doc_id``, ``n_words``, ``n_base`` (places of phrases), ``first_word`` and ``last_word``
    (least and largest start of one, from 0; else null), ``base_labels``, ``labels`` (with those of
    :class:`ContainmentJoin` over all blocks of the text; both distinct, sorted, comma-joined, maybe
    empty) and ``score``: 1 with a phrase, else the largest containment found, else 0. Texts of any length are read whole, a row at
    a time. A notice whose words hold those of another one (lesser and general public license) carries both labels. Null texts count as empty, a null id is returned as such. Ties don't matter: every template found gives its label.
    Repeated rows are kept, an empty table gives no rows, other columns, whatever their names, are ignored.
    """
    phrases, templates = PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates
    tokens = sorted({w for t in templates for w in t.encode().split()})
    join = ContainmentJoin(templates, frequency_order(docs, text_col, tokens), threshold)
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"

    def scan(text: str | None) -> tuple:
        data = (text or "").encode("utf-8", "surrogatepass")
        words = words_of(data)
        places = phrase_places(words, phrases)
        base = {label for _, label in places}
        labels, best = set(base), 1.0 if places else 0.0
        for label, share in join.find(words, set(words)):
            labels.add(label)
            best = max(best, share)
        starts = [i for i, _ in places]
        return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best

    def run(batches):
        import pyarrow as pa

        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        names = [x.split()[0] for x in schema.split(", ")]
        for batch in batches:
            found = [*zip(*map(scan, batch.column(1).to_pylist()))] or [()] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(found, kinds))], names=names)

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), run, schema)

"""License scans by a generalised suffix automaton over the words of license templates."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from locusflow.llm.words import words_of

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices and passages of public licenses and their labels.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met",
    "cc-by-sa": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                  "Public License as published by the Free Software Foundation",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "bsd-disclaimer": "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, "
                      "including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are "
                      "disclaimed. In no event shall the copyright holder or contributors be liable for any direct, indirect, incidental, "
                      "special, exemplary, or consequential damages",
    "mit-disclaimer": "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the "
                      "warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or "
                      "copyright holders be liable for any claim, damages or other liability",
    "lgpl-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                   "Public License as published by the Free Software Foundation",
    "gpl-preamble": "The GNU General Public License is a free, copyleft license for software and other kinds of works. The licenses for most "
                    "software and other practical works are designed to take away your freedom to share and change the works",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                 "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
            "damages arising from the use of this software",
    "boost": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
             "documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software",
}


class LicenseAutomaton:
    """Recognises every run of words of any template; keeps for each state where its run ends in the templates."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.phrases = {tuple(words_of(p)): label for p, label in phrases.items()}
        self.templates = [(label, tuple(words_of(t))) for label, t in templates.items()]
        self.words = {w: i for i, w in enumerate(sorted({w for t in [*self.phrases, *[t for _, t in self.templates]] for w in t}))}
        self.next, self.link, self.length, self.ends = [{}], [-1], [0], [set()]
        for k, text in enumerate([*[t for _, t in self.templates], *self.phrases]):
            last = 0
            for at, word in enumerate(text):
                last = self._extend(last, self.words[word])
                if k < len(self.templates):
                    self.ends[last].add((k, at + 1))
        by_length = sorted(range(1, len(self.next)), key=lambda s: -self.length[s])
        for s in by_length:  # a state's run ends wherever those of its extensions end
            self.ends[self.link[s]] |= self.ends[s]
        spelled = {}
        for phrase, label in self.phrases.items():
            s = 0
            for word in phrase:
                s = self.next[s][self.words[word]]
            spelled.setdefault(s, []).append((len(phrase), label))
        self.heard = [()] * len(self.next)  # phrases that end wherever a state is reached
        for s in reversed(by_length):
            self.heard[s] = (*self.heard[self.link[s]], *spelled.get(s, ()))

    def _state(self, length: int, following: dict, link: int) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            q = self.next[last][word]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, word)
        new, p = self._state(self.length[last] + 1, {}, 0), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return new

    def scan(self, words: list[bytes], least: int):
        """Streams the words: places ``(start, label)`` of the phrases, and maximal matches ``(end, length, state)`` of
        at least ``least`` words."""
        following, link, length, heard = self.next, self.link, self.length, self.heard
        found, matches, s, n = [], [], 0, 0
        for i, w in enumerate(map(self.words.get, words)):
            if w is None:
                if n >= least:
                    matches.append((i, n, s))
                s = n = 0
                continue
            if w in following[s]:
                s, n = following[s][w], n + 1
            else:
                if n >= least:
                    matches.append((i, n, s))
                while s > 0 and w not in following[s]:
                    s = link[s]
                n = length[s] + 1 if w in following[s] else 0
                s = following[s].get(w, 0)
            for size, label in heard[s]:
                if n >= size:
                    found.append((i - size + 1, label))
        if n >= least:
            matches.append((len(words), n, s))
        return found, matches

    def spans(self, matches: list, max_gap: int, least_cover: float) -> list[tuple[str, int, int, float]]:
        """Chains matches that follow each other in the text and in a template: ``(label, start, end, cover)``.

        A chain goes on while the next match starts within ``max_gap`` words of its end in both; words of the text or of
        the template that both matches hold (next to a deletion or a doubled word) count once. Only chains that cover at least ``least_cover`` of their template are returned.
        """
        out, open_chains = [], {}

        def close(k):
            chain = open_chains.pop(k)
            cover = chain[3] / len(self.templates[k][1])
            if cover >= least_cover:
                out.append((self.templates[k][0], chain[0], chain[1], min(1.0, cover)))

        for end, n, s in matches:
            for k, at in sorted(self.ends[s]):
                start, chain = end - n, open_chains.get(k)
                if chain:
                    shared = max(chain[1] - start, chain[2] - (at - n), 0)
                    if shared < n and start + shared - chain[1] <= max_gap and at - n + shared - chain[2] <= max_gap:
                        open_chains[k] = (chain[0], end, at, chain[3] + n - shared)
                        continue
                if chain and chain[1] > start - max_gap and n <= chain[3]:
                    continue  # a shorter match at another place of the same template
                if chain:
                    close(k)
                open_chains[k] = (start, end, at, n)
        for k in list(open_chains):
            close(k)
        return sorted(out, key=lambda x: (x[1], x[0]))


_SCHEMA = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
           "spans string")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict | None = None,
                  templates: dict | None = None, least: int = 5, max_gap: int = 8, least_cover: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: phrase counts and places, labels, template spans and a score.

    ``score`` is the largest share of a template (or phrase) that one chain covers; ``spans`` lists ``label:start:end`` of
    the chains in words. A null text counts as empty: no words, null places, empty labels, score 0. Repeated rows give
    repeated rows; a null id is kept; other columns are left out; an empty table gives no rows.
    """
    automaton = LicenseAutomaton(PHRASES if phrases is None else phrases, TEMPLATES if templates is None else templates)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", *[c.split()[0] for c in _SCHEMA.split(", ")]]
    types = [{"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.split()[1]] for c in _SCHEMA.split(", ")]

    def row(text):
        words = words_of(text)
        found, matches = automaton.scan(words, least)
        chains = automaton.spans(matches, max_gap, least_cover) if matches else []
        base = {label for _, label in found}
        places = [at for at, _ in found]
        return (len(words), len(found), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
                ",".join(sorted(base | {c[0] for c in chains})), 1.0 if base else max([0.0, *[c[3] for c in chains]]),
                ",".join(f"{c[0]}:{c[1]}:{c[2]}" for c in chains))

    def scan(batches):
        for batch in batches:
            columns = list(zip(*[row(t) for t in batch.column(1).to_pylist()], strict=True)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, f"id {kind}, {_SCHEMA}").withColumnRenamed("id", id_col)

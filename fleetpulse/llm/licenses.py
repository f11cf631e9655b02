"""License scan with a generalised suffix automaton of licence words.

The automaton holds every run of words of every template. A text's words
are streamed through it, which gives the matching statistics: at each word
the longest run ending there that occurs in a template. Runs that cannot
grow are matches. A match counts for every template that shares LEAST
words or more of it (or is a whole template), with the runs that it shares:
another template's longer run hides none. These are chained per template, in order in both the text and the template and with
gaps of at most GAP words, and a chain that covers COVER of a template is
a span of it. A phrase occurs where the automaton's state ends with it.

Defined cases: a null text has no words. Overlapping places all count.
Repeated rows give repeated results; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import Batches, letter_words, table, text_column

LEAST = 3  # words of a match that is chained
GAP = 3  # words between matches of a chain, in the text and in the template
COVER = 0.75  # share of a template's words that a span covers

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Words of licence notices and their labels.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it": "gpl",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
}


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, templates: list[tuple[list[bytes], str]], phrases: list[tuple[list[bytes], str]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.templates = templates
        self.first: dict[int, list[bytes]] = {}  # words up to an end of the state
        self.credits: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
        ends: list[list[tuple[int, int]]] = [[]]  # (template, its words up to the state's end)
        for t, (words, _) in enumerate([*templates, *phrases]):
            last = 0
            for i, w in enumerate(words):
                last = self._extend(last, w)
                while len(ends) < len(self.next):
                    ends.append([])
                if t < len(templates):
                    ends[last].append((t, i + 1))
                self.first[last] = words[: i + 1]
        for s in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[s] > 0:
                ends[self.link[s]].extend(ends[s])
                self.first.setdefault(self.link[s], self.first[s])
        self.ends = [sorted(set(e)) for e in ends]
        self.phrases: list[list[tuple[int, str]]] = [[] for _ in self.next]
        for words, label in phrases:
            s = 0
            for w in words:
                s = self.next[s][w]
            self.phrases[s].append((len(words), label))
        for s in sorted(range(1, len(self.next)), key=lambda s: self.length[s]):
            if self.link[s] > 0:
                self.phrases[s] = [*self.phrases[s], *self.phrases[self.link[s]]]

    def _state(self, length: int, link: int, follow: dict[bytes, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, p: int, w: bytes) -> int:
        """The state of p's longest run and w, on its own if a longer run's state holds it so far."""
        q = self.next[p][w]
        if self.length[q] == self.length[p] + 1:
            return q
        own = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = own
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = own
            p = self.link[p]
        return own

    def _extend(self, last: int, w: bytes) -> int:
        if w in self.next[last]:  # another template holds this run
            return self._split(last, w)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, w)
        return new

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, str]], list[tuple[int, int, int]]]:
        """Places (start, label) of phrases, and matches (end, length, state) of two words or more that cannot grow."""
        follow, link, length, phrases = self.next, self.link, self.length, self.phrases
        places, matches = [], []
        state = run = 0
        for i, w in enumerate(words):
            to = follow[state].get(w)
            if to is None:
                if not state:
                    continue
                if run > 1:
                    matches.append((i, run, state))
                while to is None and state:
                    state = link[state]
                    to = follow[state].get(w)
                run = length[state]
                if to is None:
                    continue
            state = to
            run += 1
            for n, label in phrases[state]:
                if n <= run:
                    places.append((i - n + 1, label))
        if run > 1:
            matches.append((len(words), run, state))
        return places, matches

    def shared(self, run: int, state: int) -> list[tuple[int, int, int, int]]:
        """(template, start in the match, start in the template, words) of the runs that templates share with a match and that cannot grow in it."""
        if (run, state) in self.credits:
            return self.credits[run, state]
        words, out = self.first[state][-run:], []
        for t, (own, _) in enumerate(self.templates):
            least = min(LEAST, len(own))
            for shift in range(1 - len(own), run):  # start in the match less start in the template
                n = 0
                for i in range(max(0, shift), min(run, shift + len(own)) + 1):
                    if i < min(run, shift + len(own)) and words[i] == own[i - shift]:
                        n += 1
                        continue
                    if n >= least:
                        out.append((t, i - n, i - n - shift, n))
                    n = 0
        self.credits[run, state] = out
        return out

    def spans(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
        """Spans (template, start, end, coverage) of chained matches that cover enough of a template."""
        # By template and start in the text less start in the template: (start, end) in the text.
        runs: dict[tuple[int, int], list[list[int]]] = defaultdict(list)
        for end, run, state in matches:
            for t, at, t_at, n in self.shared(run, state):
                at += end - run
                so_far = runs[t, at - t_at]
                if so_far and at <= so_far[-1][1]:  # matches overlap, and their shares are one run
                    so_far[-1][0] = min(at, so_far[-1][0])
                    so_far[-1][1] = max(at + n, so_far[-1][1])
                else:
                    so_far.append([at, at + n])
        by: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for (t, shift), some in runs.items():
            by[t] += [(at, at - shift, end - at) for at, end in some]
        out = []
        for t, parts in by.items():
            size = len(self.templates[t][0])
            chains: list[list[int]] = []  # start, end in the text, end in the template, words covered
            found: dict[int, list[int]] = {}
            for at, t_at, run in [*sorted(parts), (None, 0, 0)]:
                past = [c for c in chains if at is None or at - c[1] > GAP]
                for c in past:
                    if c[3] >= COVER * size and c[3] > found.get(c[0], [0, 0, 0, 0])[3]:
                        found[c[0]] = c
                if at is None:
                    break
                chains = [c for c in chains if at - c[1] <= GAP]
                fits = [c for c in chains if c[1] <= at and 0 <= t_at - c[2] <= GAP]
                best = max(fits, key=lambda c: c[3], default=[at, at, t_at, 0])
                chains.append([best[0], at + run, t_at + run, best[3] + run])
            out += [(t, c[0], c[1], c[3] / size) for c in found.values()]
        return sorted(out)


def _words(texts: dict[str, str]) -> list[tuple[list[bytes], str]]:
    return [(letter_words(k), v) for k, v in texts.items()]


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> DataFrame:
    """Per document: doc_id, n_words, places (start, label) of phrases, spans (template, label, start, end, coverage)."""
    places = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
    spans = pa.list_(pa.struct([("template", pa.string()), ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("places", places), ("spans", spans)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = list(templates)
        auto = Automaton(_words(templates), _words(phrases))
        for b in batches:
            out = Batches(schema)
            for doc, text in zip(*b.columns, strict=True):
                words = letter_words(text.as_py())
                found, matches = auto.scan(words)
                chained = [(names[t], auto.templates[t][1], s, e, c) for t, s, e, c in auto.spans(matches)]
                full = out.add((doc.as_py(), len(words), found, chained), 50 * (len(found) + len(chained)))
                if full is not None:
                    yield full
            if (rest := out.flush()) is not None:
                yield rest

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    return base.mapInArrow(
        run, "doc_id long, n_words long, places array<struct<start:long,label:string>>, spans array<struct<template:string,label:string,start:long,end:long,coverage:double>>"
    )


def digests(scanned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of `scan`'s rows."""
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    base, own = F.col("places.label"), F.col("spans.label")
    cover = F.coalesce(F.array_max("spans.coverage"), F.lit(0.0))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"),
        F.array_max("places.start").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, own)).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.least(cover, F.lit(1.0))).alias("score"),
    )


def q_licenses(spark, sf_dir):
    return digests(scan(table(spark, sf_dir, "documents")))

"""Operator 6: license scan with fuzzy search for short notices.

A text becomes its words (letters, digits and every non-ASCII character,
A-Z lower-cased) joined by one space. Base labels are exact phrases in it.
Notices are then searched with edits: a notice that occurs with at most k
edits contains one of its k + 1 pieces unchanged (pigeonhole), so exact
search for the pieces locates all candidates, and the ``regex`` library's
bounded-error matching verifies each stretch of whole words around them and
counts the edits. Of stretches that overlap the one with the fewest edits is
listed, so every notice of a text with many of them is found. A span gives
its label to the text only if the words that name the license and its version
stand there unchanged: a notice of another license is near, but not this one.

Defined cases: a null or empty text has no words and no labels (empty
strings, score 0); rows repeat as in the input; a null id is kept; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text
from .words import text_buffer

#: Exact phrases and their labels.
PHRASES = {b"mit license": "mit", b"apache license": "apache", b"general public license": "gpl"}

#: Short notices in normal form, and their labels.
NOTICES = {
    b"released under the mit license": "mit",
    b"permission is hereby granted free of charge to any person obtaining a copy": "mit",
    b"licensed under the apache license version 2 0": "apache",
    b"this work is licensed under the gnu general public license": "gpl",
    b"you can redistribute it and or modify it under the terms of the gnu": "gpl",
    b"redistribution and use in source and binary forms with or without modification": "bsd",
    b"subject to the terms of the mozilla public license": "mpl",
    b"licensed under cc by nc 4 0": "cc-by-nc",
    b"licensed under cc by sa 4 0": "cc-by-sa",
    b"creative commons attribution 4 0 international license": "cc-by",
    b"under the terms of the gnu lesser general public license": "lgpl",
    b"permission to use copy modify and or distribute this software for any purpose": "isc",
    b"this software is provided as is without any express or implied warranty": "zlib",
    b"this is free and unencumbered software released into the public domain": "unlicense",
    b"licensed under the 3 clause bsd license": "bsd",
    b"spdx license identifier mit": "mit",
    b"spdx license identifier apache 2 0": "apache",
    b"spdx license identifier bsd 3 clause": "bsd",
    b"spdx license identifier gpl 3 0": "gpl",
}

#: Words of a notice that name the license or its version: edits elsewhere
#: are tolerated, but without these words as they are it names another one.
NAMING = {
    b"released under the mit license": [b"mit"],
    b"licensed under the apache license version 2 0": [b"apache", b"2 0"],
    b"this work is licensed under the gnu general public license": [b"gnu"],
    b"you can redistribute it and or modify it under the terms of the gnu": [b"gnu"],
    b"subject to the terms of the mozilla public license": [b"mozilla"],
    b"licensed under cc by nc 4 0": [b"cc by nc 4 0"],
    b"licensed under cc by sa 4 0": [b"cc by sa 4 0"],
    b"creative commons attribution 4 0 international license": [b"creative commons attribution 4 0"],
    b"under the terms of the gnu lesser general public license": [b"lesser general"],
    b"licensed under the 3 clause bsd license": [b"bsd"],
    b"spdx license identifier mit": [b"mit"],
    b"spdx license identifier apache 2 0": [b"apache 2 0"],
    b"spdx license identifier bsd 3 clause": [b"bsd 3 clause"],
    b"spdx license identifier gpl 3 0": [b"gpl 3 0"],
}
LETTERS_PER_EDIT, MOST_EDITS = 12, 4

WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

RESULT = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "spans array<struct<label:string,first_word:long,words:long,edits:long>>")


def edits_allowed(notice: bytes) -> int:
    return max(1, min(MOST_EDITS, len(notice) // LETTERS_PER_EDIT))


def seeds(notice: bytes, edits: int) -> list[tuple[int, bytes]]:
    """(offset, piece): the notice cut into edits + 1 pieces."""
    n = len(notice)
    cut = [n * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cut, cut[1:])]


def places(line: bytes, what: bytes, start: int = 0, end: int | None = None) -> list[int]:
    out, at = [], line.find(what, max(start, 0), end)
    while at >= 0:
        out.append(at)
        at = line.find(what, at + 1, end)
    return out


def best_spans(spans: list[tuple]) -> list[tuple]:
    """Spans (edits, first word, label, words, notice, named), those with the fewest
    edits first, without those that overlap a kept one with fewer edits or
    of the same notice; kept spans are looked up by word, so a long text
    with many notices takes linear time."""
    kept: list[tuple] = []
    at_word: dict[int, list[tuple]] = {}
    for s in sorted(spans, key=lambda s: (s[0], s[1], -s[3], s[2], s[4])):
        words = range(s[1], s[1] + s[3])
        if not any(k[0] < s[0] or k[4] == s[4] for w in words for k in at_word.get(w, ())):
            kept.append(s)
            for w in words:
                at_word.setdefault(w, []).append(s)
    return kept


class Scanner:
    def __init__(self, phrases: dict[bytes, str], notices: dict[bytes, str]) -> None:
        import regex

        self.phrases = [(b" " + p + b" ", label) for p, label in phrases.items()]
        self.notices = []
        for notice, label in notices.items():
            k = edits_allowed(notice)
            rx = regex.compile(rb"(?b)(?:" + regex.escape(notice, literal_spaces=True) + rb"){e<=%d}" % k)
            self.notices.append((notice, label, k, seeds(notice, k), rx))

    def stretches(self, line: bytes, length: int, k: int, pieces: list[tuple[int, bytes]]) -> set[tuple[int, int]]:
        """All stretches of whole words that hold an exact piece, and start
        and end within k bytes of where the notice would."""
        near = {at - offset for offset, piece in pieces for at in places(line, piece) if at - offset + k > 0}
        starts = {space + 1 for a in near for space in places(line, b" ", a - k - 1, a + k)}
        return {(a, b) for a in starts for b in places(line, b" ", a + max(length - k, 1), a + length + k + 1)}

    def scan(self, text: bytes) -> tuple:
        words = text.translate(WORD_BYTES).split()
        line = b" " + b" ".join(words) + b" "
        at = [(p, label) for phrase, label in self.phrases for p in places(line, phrase)]
        base = {label for _, label in at}
        matches = []
        for notice, label, k, pieces, rx in self.notices:
            for a, b in self.stretches(line, len(notice), k, pieces):
                if m := rx.fullmatch(line, a, b):
                    own = b" " + line[a:b] + b" "
                    named = all(b" " + w + b" " in own for w in NAMING.get(notice, ()))
                    matches.append((sum(m.fuzzy_counts), a, label, line.count(b" ", a, b) + 1, notice, named))
        if at or matches:  # from byte to word: the spaces before it
            spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        found = [(int(np.searchsorted(spaces, p)), label) for p, label in at]
        spans = best_spans([(e, int(np.searchsorted(spaces, p)) - 1, *rest) for e, p, *rest in matches])
        best = 1.0 if base else 0.0
        best = max([best, *(1 - s[0] / len(s[4]) for s in spans if s[5])])
        starts = [s for s, _ in found]
        labels = base | {s[2] for s in spans if s[5]}
        return (len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best,
                [{"label": x[2], "first_word": x[1], "words": x[3], "edits": x[0]} for x in sorted(spans, key=lambda x: x[1])])


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", phrases: dict[bytes, str] = PHRASES, notices: dict[bytes, str] = NOTICES) -> DataFrame:
    """One row per text: counts and places of the base phrases, base labels,
    all labels, the best score (1 less edits per letter) and fuzzy ``spans``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(RESULT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(phrases, notices)
        for batch in batches:
            buf, offsets = text_buffer(batch.column("text"))
            data, at = buf.tobytes(), offsets.tolist()
            rows = [scanner.scan(data[a:b]) for a, b in zip(at, at[1:])]
            cols = list(zip(*rows)) if rows else [[] for _ in schema.names[1:]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), f.type) for c, f in zip(cols, list(schema)[1:]))], schema=schema)

    return id_and_text(docs, doc_id, text).mapInArrow(run, RESULT)

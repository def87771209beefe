"""Licence scan: notice phrases and identifier tags by Aho-Corasick, expressions by a
shunting-yard parser.

A text's words are the runs of ASCII letters and digits and of all characters beyond ASCII,
with A-Z in lower case. One automaton runs over the words joined by spaces and finds all
phrases at once, each where its words stand consecutively: the three base notices, further
notices, and the tags that announce a licence expression. Behind a tag the original text is
read: identifiers joined by AND, OR, WITH (or / for OR) and parentheses, WITH binding
closest and OR loosest. The expression gets the labels of its licences and a value from 0
to 1, how freely the text may be used: the least for AND, the greatest for OR, raised by an
exception for WITH.

Every text is scanned whole in its own task, without a shuffle; a hit is a row of the
``hits`` array, with its place in words and in code points of the text.

Cases: a null or empty text has no words and no hits; rows are handled one by one, so
repeated rows and ids give repeated rows; a null id stays; an expression ends before what
cannot go on with it (a dangling operator or an open parenthesis is passed over); an
unknown identifier behind an SPDX tag is ``other`` with value 0, behind other tags it is no
licence; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What may be done under a licence, from 0 (nothing) to 1.
FREE, WEAK, SHARED, STRONG, LIMITED, CLOSED = 1.0, 0.75, 0.6, 0.5, 0.2, 0.0
#: What WITH an exception adds.
EXCEPTION = 0.25

BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
VALUES = {
    "mit": FREE, "apache-2": FREE, "bsd": FREE, "bsd-2-clause": FREE, "bsd-3-clause": FREE, "isc": FREE, "zlib": FREE,
    "unlicense": FREE, "cc0": FREE, "bsl-1": FREE, "wtfpl": FREE, "public-domain": FREE, "cc-by": FREE, "python-2": FREE,
    "mpl": WEAK, "mpl-2": WEAK, "epl": WEAK, "epl-2": WEAK, "lgpl": WEAK, "lgpl-2": WEAK, "lgpl-2.1": WEAK, "lgpl-3": WEAK,
    "ofl-1.1": WEAK, "artistic-2": WEAK, "cc-by-sa": SHARED, "odbl": SHARED, "gfdl": SHARED,
    "gpl": STRONG, "gpl-2": STRONG, "gpl-3": STRONG, "agpl": STRONG, "agpl-3": STRONG,
    "cc-by-nc": LIMITED, "cc-by-nd": LIMITED, "cc-by-nc-sa": LIMITED, "cc-by-nc-nd": LIMITED,
    "all-rights-reserved": CLOSED, "other": CLOSED,
}
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under mit": "mit",
    "the mit license": "mit",
    "apache license 2": "apache-2",
    "redistribution and use in source and binary forms": "bsd",
    "bsd 2 clause": "bsd-2-clause",
    "bsd 3 clause": "bsd-3-clause",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "isc license": "isc",
    "zlib license": "zlib",
    "boost software license": "bsl-1",
    "free and unencumbered software released into the public domain": "unlicense",
    "cc0 1 0 universal": "cc0",
    "python software foundation license": "python-2",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "gnu free documentation license": "gfdl",
    "mozilla public license": "mpl",
    "mozilla public license version 2": "mpl-2",
    "eclipse public license": "epl",
    "sil open font license": "ofl-1.1",
    "open database license": "odbl",
    "creative commons attribution 4 0": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "cc by 4 0": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "all rights reserved": "all-rights-reserved",
}
#: Tags before an expression; only the first takes unknown identifiers.
TAGS = ("spdx license identifier", "license", "licence", "license expression", "pkg license")
IDENTIFIERS = {
    "mit": "mit", "mit-0": "mit", "apache-2.0": "apache-2", "bsd-2-clause": "bsd-2-clause", "bsd-3-clause": "bsd-3-clause",
    "bsd": "bsd", "isc": "isc", "zlib": "zlib", "unlicense": "unlicense", "cc0-1.0": "cc0", "bsl-1.0": "bsl-1", "wtfpl": "wtfpl",
    "python-2.0": "python-2", "psf-2.0": "python-2", "mpl-2.0": "mpl-2", "mpl-1.1": "mpl", "epl-1.0": "epl", "epl-2.0": "epl-2",
    "lgpl-2.0": "lgpl-2", "lgpl-2.1": "lgpl-2.1", "lgpl-3.0": "lgpl-3", "ofl-1.1": "ofl-1.1", "artistic-2.0": "artistic-2",
    "odbl-1.0": "odbl", "gfdl-1.3": "gfdl", "gpl-1.0": "gpl", "gpl-2.0": "gpl-2", "gpl-3.0": "gpl-3", "agpl-3.0": "agpl-3",
    "cc-by-3.0": "cc-by", "cc-by-4.0": "cc-by", "cc-by-sa-3.0": "cc-by-sa", "cc-by-sa-4.0": "cc-by-sa", "cc-by-nd-4.0": "cc-by-nd",
    "cc-by-nc-3.0": "cc-by-nc", "cc-by-nc-4.0": "cc-by-nc", "cc-by-nc-sa-4.0": "cc-by-nc-sa", "cc-by-nc-nd-4.0": "cc-by-nc-nd",
    "proprietary": "all-rights-reserved",
}

HIT = "struct<kind: string, labels: array<string>, word: long, n_words: int, start: long, end: long, text: string, value: double>"
SCHEMA = f"doc_id long, n_words long, hits array<{HIT}>"

#: A-Z to lower case, what is no word to a space; bytes beyond ASCII are words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_IS_WORD = np.frombuffer(_WORD_BYTES, np.uint8) != 32
_AFTER_TAG = re.compile(rb"[\"']?[ \t]*[:=][ \t]*[\"']?")
_TOKEN = re.compile(rb"[ \t]*([()/]|[A-Za-z0-9][A-Za-z0-9.:+-]*)")
_BINDS = {"or": 1, "and": 2, "with": 3}


def licence(identifier: str, any_name: bool) -> str | None:
    """The label of an identifier; without one ``other`` if ``any_name``."""
    name = identifier.lower().rstrip(".:").removesuffix("+").removesuffix("-only").removesuffix("-or-later")
    return IDENTIFIERS.get(name) or ("other" if any_name or name.startswith("licenseref-") else None)


def read_expression(raw: bytes, at: int, any_name: bool) -> tuple[list[tuple[str, str]], int]:
    """Tokens (kind, text) of the longest expression from ``at`` on, and its end. Kinds are
    ``name``, ``exception``, ``(``, ``)`` and the operators."""
    tokens: list[tuple[str, str]] = []
    whole, end, depth, operand = 0, at, 0, True
    while found := _TOKEN.match(raw, at):
        text, at = found[1].decode(), found.end()
        word = "or" if text == "/" else text.lower()
        if operand:
            if text == "(":
                tokens.append(("(", text))
                depth += 1
                continue
            after = tokens[-1] if tokens else None
            if word in _BINDS or not text[0].isalnum():
                break
            if after and after[0] == "with":
                tokens.append(("exception", text))
            elif licence(text, any_name and (after is None or after[1].isupper() or after[0] == "(")) is not None:
                tokens.append(("name", text))
            else:
                break
            operand, whole, end = False, len(tokens), found.end() - (len(text) - len(text.rstrip(".:")))
            if text[-1] in ".:":
                break
        elif text == ")" and depth:
            depth -= 1
            tokens.append((")", text))
            whole, end = len(tokens), at
        elif word in _BINDS:
            tokens.append((word, text))
            operand = True
        else:
            break
    return tokens[:whole], end


def evaluate(tokens: list[tuple[str, str]], any_name: bool) -> tuple[list[str], float] | None:
    """The labels and the value of an expression; None if it has no licence."""
    operators: list[str] = []
    values: list[float] = []
    labels: list[str] = []

    def apply(operator: str) -> None:
        if operator != "(" and len(values) > 1:
            right, left = values.pop(), values.pop()
            values.append({"or": max, "and": min, "with": lambda a, b: min(1.0, a + b)}[operator](left, right))

    for kind, text in tokens:
        if kind == "name":
            label = licence(text, any_name) or "other"
            labels.append(label)
            values.append(VALUES[label])
        elif kind == "exception":
            values.append(EXCEPTION)
        elif kind == "(":
            operators.append(kind)
        elif kind == ")":
            while operators and (last := operators.pop()) != "(":
                apply(last)
        else:
            while operators and operators[-1] != "(" and _BINDS[operators[-1]] >= _BINDS[kind]:
                apply(operators.pop())
            operators.append(kind)
    while operators:
        apply(operators.pop())
    return (sorted(set(labels)), values[0]) if labels else None


@functools.lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    known: dict[str, list] = {}
    for kind, phrases in (("base", BASE.items()), ("notice", NOTICES.items()), ("tag", [(t, "") for t in TAGS])):
        for phrase, label in phrases:
            known.setdefault(phrase, []).append((kind, label, phrase.count(" ") + 1))
    for phrase, entries in known.items():
        found.add_word(f" {phrase} ", (len(phrase) + 2, entries))
    found.make_automaton()
    return found


def scan(raw: bytes) -> tuple[int, list[tuple]]:
    """The number of words of a text in UTF-8 and its hits, as ``HIT`` has them."""
    words = raw.translate(_WORD_BYTES).split()
    line = b" %b " % b" ".join(words)
    places = [(end - size + 1, entries) for end, (size, entries) in _automaton().iter(line.decode("latin-1"))]
    if not places:
        return len(words), []
    found, word, counted = [], 0, 0
    for start, entries in sorted(places, key=lambda p: p[0]):
        # the space before a word closes the word before it
        word, counted = word + line.count(b" ", counted, start), start
        found += [(kind, label, word, n) for kind, label, n in entries]
    is_word = _IS_WORD[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(np.diff(is_word, prepend=False, append=False))
    firsts, lasts = edges[::2], edges[1::2]
    point = np.append(0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))

    def hit(kind, labels, word, n, begin, end, value):
        return kind, labels, word, n, int(point[begin]), int(point[end]), raw[begin:end].decode("utf-8", "replace"), value

    out = []
    longest = {}
    for kind, label, word, n in found:
        if kind == "notice":
            longest.update((w, max(n, longest.get(w, 0))) for w in range(word, word + n))
    for kind, label, word, n in found:
        begin, end = int(firsts[word]), int(lasts[word + n - 1])
        if kind == "base":
            out.append(hit(kind, [label], word, n, begin, end, VALUES[label]))
        elif kind == "notice":
            # a longer notice says more than those inside it
            if all(longest[w] == n for w in range(word, word + n)):
                out.append(hit(kind, [label], word, n, begin, end, VALUES[label]))
        elif tag := _AFTER_TAG.match(raw, end):
            any_name = n == 3
            tokens, stop = read_expression(raw, tag.end(), any_name)
            if value := evaluate(tokens, any_name):
                out.append(hit(kind, value[0], word, n, begin, stop, value[1]))
    return len(words), out


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words and hits (``HIT``) of each document, base places first in ties."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct(
                [("kind", pa.string()), ("labels", pa.list_(pa.string())), ("word", pa.int64()), ("n_words", pa.int32()),
                 ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string()), ("value", pa.float64())]
            )
        )
        names = [kind.value_type.field(i).name for i in range(8)]
        for batch in batches:
            found = [scan(text.as_buffer().to_pybytes()) for text in batch.column("text").cast(pa.binary())]
            hits = [[dict(zip(names, h, strict=True)) for h in one] for _, one in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([n for n, _ in found], pa.int64()), pa.array(hits, kind)],
                ["doc_id", "n_words", "hits"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def license_digest(scanned: DataFrame) -> DataFrame:
    """Base places and labels, all labels, and the score: the least value of a document's
    hits, as all of its terms hold together; 0 without any, as nothing grants its use."""
    base = F.filter("hits", lambda h: h["kind"] == "base")
    word = F.transform(base, lambda h: h["word"])
    joined = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.flatten(F.transform(hits, lambda h: h["labels"])))), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(word).alias("first_word"),
        F.array_max(word).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("hits")).alias("labels"),
        F.coalesce(F.array_min(F.transform("hits", lambda h: h["value"])), F.lit(0.0)).alias("score"),
        F.size(F.filter("hits", lambda h: h["kind"] == "tag")).cast("long").alias("n_expressions"),
    )

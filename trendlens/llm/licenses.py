"""Licence scans: Aho-Corasick over words, licence expressions by shunting-yard.

A text's words are what ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` finds after
``A-Z`` are lower-cased. One automaton over the words, joined by single
spaces, finds notice phrases and the words of identifier tags. Where the tag
occurs, the expressions after it are parsed from the raw text: ids joined by
``AND``, ``OR`` and ``WITH`` (any case) and brackets; ``WITH`` binds closest, then
``AND``, then ``OR``. An expression's value says whether it can be met with
permissive licences alone.

Labels: those of the notice phrases, and every id of a valid expression in
lower case. The score is 0 without any find; 1 with a valid expression; else
``1 - 2^-k`` for ``k`` places of notice phrases.

Defined results: null or empty text has no words, no places, empty labels and
score 0; an expression that doesn't parse adds no labels; overlapping phrases
all count; repeated rows are scanned alike; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

#: Phrases whose places are counted, and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further notice phrases of well-known licences, and their labels.
NOTICE_PHRASES = {
    "permission is hereby granted free of charge": "mit", "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd", "mozilla public license": "mpl", "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl", "eclipse public license": "epl", "isc license": "isc",
    "creative commons": "cc", "licensed under cc by": "cc", "all rights reserved": "proprietary",
    "this is free and unencumbered software": "unlicense", "boost software license": "bsl",
    "permission to use copy modify and or distribute this software": "isc", "without warranties or conditions of any kind either express or implied": "apache",
    "neither the name of the copyright holder nor the names of its contributors": "bsd", "free software foundation either version": "gpl",
    "european union public licence": "eupl", "common development and distribution license": "cddl", "server side public license": "sspl",
    "business source license": "busl", "elastic license": "elastic", "artistic license": "artistic", "zlib license": "zlib",
    "python software foundation license": "psf", "open data commons": "odc", "open database license": "odbl", "sil open font license": "ofl",
    "university of illinois ncsa open source license": "ncsa", "postgresql license": "postgresql",
    "common public attribution license": "cpal", "microsoft public license": "mspl", "gnu free documentation license": "gfdl",
}
#: The words of identifier tags.
TAGS = ("spdx license identifier",)
#: The identifiers of permissive licences, in lower case; ``+`` (or later) may follow.
PERMISSIVE = frozenset("""
0bsd aal afl-1.1 afl-1.2 afl-2.0 afl-2.1 afl-3.0 apache-1.0 apache-1.1 apache-2.0 artistic-1.0 artistic-2.0 beerware blueoak-1.0.0
bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 bzip2-1.0.6
cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc0-1.0 curl ecl-1.0 ecl-2.0 efl-1.0 efl-2.0 fair fsfap ftl hpnd icu ijg imagemagick isc
libpng libpng-2.0 libtiff mirros mit mit-0 mit-modern-variant mulanpsl-1.0 mulanpsl-2.0 ncsa nist-pd ntp odc-by-1.0 openssl pddl-1.0 php-3.0 php-3.01
postgresql psf-2.0 python-2.0 ruby tcl unicode-3.0 unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 xnet zend-2.0 zlib zlib-acknowledgement zpl-2.0 zpl-2.1
""".split())

_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_TAG = re.compile(r"spdx[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+license[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+identifier[ \t]*:?[ \t]*([^\n]*)", re.I | re.A)
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+-]+")
_BINDS = {"or": 1, "and": 2, "with": 3}


def parse_expression(text: str) -> list[str] | None:
    """The expression's tokens in postfix order (shunting-yard), or null if it isn't one.

    Reads as far as tokens reach; ids become lower case.
    """
    out: list[str] = []
    stack: list[str] = []
    operand_next, at = True, 0
    while at < len(text):
        if text[at] in " \t":
            at += 1
            continue
        m = _TOKEN.match(text, at)
        if not m:
            break
        token, at = m[0].lower(), m.end()
        if token == "(":
            if not operand_next:
                return None
            stack.append(token)
        elif token == ")":
            if operand_next:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif token in _BINDS:
            if operand_next:
                return None
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[token]:
                out.append(stack.pop())
            stack.append(token)
            operand_next = True
        else:
            if not operand_next:
                break  # a word after a whole expression: prose follows
            out.append(token.rstrip(".") or token)
            operand_next = False
    if operand_next or "(" in stack:
        return None
    return out + stack[::-1]


def permissive(postfix: list[str]) -> bool:
    """Whether permissive licences alone can meet the expression."""
    stack: list[bool] = []
    for token in postfix:
        if token in _BINDS:
            b, a = stack.pop(), stack.pop()
            stack.append(a or b if token == "or" else a and b if token == "and" else a)
        else:
            stack.append(token.removesuffix("+") in PERMISSIVE)
    return stack[0]


@lru_cache(maxsize=4)
def _automaton(base: tuple, more: tuple) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, phrases in (("base", base), ("notice", more), ("tag", tuple((t, "") for t in TAGS))):
        for phrase, label in phrases:
            found.add_word(f" {phrase} ", (kind, label, len(phrase) + 2))
    found.make_automaton()
    return found


def _after(postfix: list[str]) -> set[str]:
    """Ids of an expression; exceptions after ``with`` aren't licences."""
    ids: list[tuple[str, ...]] = []
    for token in postfix:
        if token in _BINDS:
            b, a = ids.pop(), ids.pop()
            ids.append(a if token == "with" else a + b)
        else:
            ids.append((token,))
    return set(ids[0])


def scan_text(text: str | None, automaton: ahocorasick.Automaton) -> tuple:
    """``n_words, n_base, first_word, last_word, base_labels, labels, score, expression, permissive``."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()
    line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    base, labels, starts, places, tagged = set(), set(), [], 0, False
    for end, (kind, label, size) in automaton.iter(line):
        if kind == "tag":
            tagged = True
            continue
        places += 1
        labels.add(label)
        if kind == "base":
            base.add(label)
            starts.append(end - size + 1)
    # a word's index is the number of spaces before its place
    ordered, seen, at = [], 0, 0
    for s in sorted(starts)[:1] + sorted(starts)[-1:]:
        seen, at = seen + line.count(" ", at, s), s
        ordered.append(seen)
    valid = []
    if tagged:
        valid = [(m, p) for m, p in ((m, parse_expression(m)) for m in _TAG.findall(text)) if p]
        for _, p in valid:
            labels |= _after(p)
    score = 1.0 if valid else 1.0 - 2.0 ** -min(places, 60) if places else 0.0
    return (len(words), len(starts), ordered[0] if ordered else None, ordered[1] if ordered else None,
            ",".join(sorted(base)), ",".join(sorted(labels)), score,
            " ".join(valid[0][1]) if valid else None, all(permissive(p) for _, p in valid) if valid else None)


_FOUND = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
          ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("expression", pa.string()), ("permissive", pa.bool_())]
_SPARK = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expression string, permissive boolean"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] | None = None,
                  notices: dict[str, str] | None = None) -> DataFrame:
    """One row of finds per document, without any shuffle; batches stream through each task."""
    base_items = tuple((BASE_PHRASES if base is None else base).items())
    more = tuple((NOTICE_PHRASES if notices is None else notices).items())
    d = docs.select(id_col, text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(base_items, more)
        for batch in batches:
            rows = [scan_text(t, automaton) for t in batch.column(1).to_pylist()]
            columns = list(zip(*rows, strict=True)) or [[]] * len(_FOUND)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, type=t) for c, (_, t) in zip(columns, _FOUND, strict=True))],
                names=[id_col, *(n for n, _ in _FOUND)])
    return d.mapInArrow(scan, f"`{id_col}` {d.schema[0].dataType.simpleString()}, {_SPARK}")

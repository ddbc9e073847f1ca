"""License scan by ordered signature rules.

A rule is a regular expression over the words of a text, joined by one space, with a
label, a priority and keywords. A rule is tried only on texts that hold one of them.
Matches are taken in order of priority, then length, then place; one that lies inside
an interval already taken is suppressed, so that "licensed under the apache license
version 2.0" counts once and not again as "apache license".

The rules are families times forms: each family gives its names, each form what stands
around a name.
"""

import re
from bisect import bisect_left
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from gradeloom.llm.catalog import query
from gradeloom.llm.tables import read

#: Phrases that are counted as they stand, with their labels (fixed values).
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# label, keywords between bars, name as an expression over lower-case words, short name or "".
FAMILIES = [
    ("gpl", "gnu", r"gnu (?:gpl|general public licen[cs]e)", "gpl"),
    ("lgpl", "lesser|library general", r"gnu (?:lesser|library) general public licen[cs]e", ""),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl", "lgpl"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e", ""),
    ("agpl", "agpl", r"(?:gnu )?agpl", "agpl"),
    ("gfdl", "free documentation", r"gnu free documentation licen[cs]e", "gfdl"),
    ("apache", "apache", r"apache (?:software )?licen[cs]e", "apache"),
    ("mit", "mit", r"mit(?: expat)? licen[cs]e", "mit"),
    ("expat", "expat", r"expat licen[cs]e", "expat"),
    ("x11", "x11", r"x11 licen[cs]e", "x11"),
    ("bsd", "bsd", r"(?:new |modified |simplified |revised |original )?bsd(?: style)? licen[cs]e", "bsd"),
    ("bsd-3-clause", "clause bsd", r"(?:3|three) clause bsd(?: licen[cs]e)?", "bsd 3 clause"),
    ("bsd-2-clause", "clause bsd", r"(?:2|two) clause bsd(?: licen[cs]e)?", "bsd 2 clause"),
    ("bsd-4-clause", "clause bsd", r"(?:4|four) clause bsd(?: licen[cs]e)?", "bsd 4 clause"),
    ("0bsd", "0bsd|zero clause bsd", r"(?:0bsd|zero clause bsd)(?: licen[cs]e)?", "0bsd"),
    ("isc", "isc", r"isc licen[cs]e", "isc"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e", ""),
    ("mpl", "mpl", r"mpl licen[cs]e", "mpl"),
    ("epl", "eclipse", r"eclipse public licen[cs]e", ""),
    ("epl", "epl", r"epl licen[cs]e", "epl"),
    ("edl", "eclipse", r"eclipse distribution licen[cs]e", "edl"),
    ("eupl", "european union", r"european union public licen[cs]e", "eupl"),
    ("cddl", "development and distribution", r"common development and distribution licen[cs]e", "cddl"),
    ("cpl", "common public", r"common public licen[cs]e", "cpl"),
    ("ipl", "ibm public", r"ibm public licen[cs]e", "ipl"),
    ("artistic", "artistic", r"(?:perl )?artistic licen[cs]e", "artistic"),
    ("boost", "boost", r"boost software licen[cs]e", "bsl"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", "zlib"),
    ("libpng", "libpng", r"libpng licen[cs]e", "libpng"),
    ("python", "python", r"python (?:software foundation )?licen[cs]e", "psf"),
    ("php", "php", r"php licen[cs]e", "php"),
    ("ruby", "ruby", r"ruby licen[cs]e", "ruby"),
    ("openssl", "openssl", r"openssl licen[cs]e", "openssl"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", "postgresql"),
    ("unlicense", "unlicense", r"unlicense", "unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl", "wtfpl"),
    ("ofl", "open font", r"(?:sil )?open font licen[cs]e", "ofl"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa (?:open source )?licen[cs]e", "ncsa"),
    ("ms-pl", "microsoft public", r"microsoft public licen[cs]e", "ms pl"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal licen[cs]e", "ms rl"),
    ("osl", "open software", r"open software licen[cs]e", "osl"),
    ("afl", "academic free", r"academic free licen[cs]e", "afl"),
    ("qpl", "q public", r"q public licen[cs]e", "qpl"),
    ("upl", "universal permissive", r"universal permissive licen[cs]e", "upl"),
    ("cecill", "cecill", r"cecill(?: (?:b|c))?", "cecill"),
    ("mulan", "mulan", r"mulan (?:permissive software|public|psl) ?(?:licen[cs]e)?", "mulanpsl"),
    ("odbl", "open database", r"open (?:data commons open )?database licen[cs]e", "odbl"),
    ("odc-by", "data commons attribution", r"open data commons attribution licen[cs]e", "odc by"),
    ("pddl", "public domain dedication", r"public domain dedication and licen[cs]e", "pddl"),
    ("cc-by-nc-nd", "cc|creative commons", r"(?:cc|creative commons) (?:by nc nd|attribution non ?commercial no ?deriv(?:ative)?s?)", "cc by nc nd"),
    ("cc-by-nc-sa", "cc|creative commons", r"(?:cc|creative commons) (?:by nc sa|attribution non ?commercial share ?alike)", "cc by nc sa"),
    ("cc-by-nc", "cc|creative commons", r"(?:cc|creative commons) (?:by nc|attribution non ?commercial)", "cc by nc"),
    ("cc-by-nd", "cc|creative commons", r"(?:cc|creative commons) (?:by nd|attribution no ?deriv(?:ative)?s?)", "cc by nd"),
    ("cc-by-sa", "cc|creative commons", r"(?:cc|creative commons) (?:by sa|attribution share ?alike)", "cc by sa"),
    ("cc-by-nc-nd", "creative commons", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?", ""),
    ("cc-by-nc-sa", "creative commons", r"creative commons attribution non ?commercial share ?alike", ""),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial", ""),
    ("cc-by-nd", "creative commons", r"creative commons attribution no ?deriv(?:ative)?s?", ""),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike", ""),
    ("cc-by", "creative commons", r"creative commons attribution", ""),
    ("cc-by", "cc by", r"cc by", "cc by"),
    ("cc0", "cc0", r"cc0", "cc0"),
    ("cc0", "creative commons zero", r"creative commons zero", ""),
    ("commons-clause", "commons clause", r"commons clause", ""),
    ("sspl", "server side public", r"server side public licen[cs]e", "sspl"),
    ("busl", "business source", r"business source licen[cs]e", "busl"),
    ("elastic", "elastic", r"elastic licen[cs]e", "elastic"),
    ("openrail", "openrail|rail", r"(?:creativeml |bigscience )?(?:open ?rail|rail)(?: m)? licen[cs]e", "openrail"),
    ("vim", "vim", r"vim licen[cs]e", "vim"),
    ("latex", "latex", r"latex project public licen[cs]e", "lppl"),
    ("sleepycat", "sleepycat", r"sleepycat licen[cs]e", "sleepycat"),
    ("w3c", "w3c", r"w3c (?:software(?: notice)?(?: and)? )?licen[cs]e", "w3c"),
]
_VERSION = r"(?: (?:version|v|ver))? ?v?[0-9]+(?: [0-9]+)?(?: (?:or|and) (?:any )?later(?: version)?)?"
_GRANT = (
    r"(?:dual )?(?:licen[cs]ed|released|distributed|available|published|provided|covered|made available)"
    r"(?: to you)? under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?:an? )?"
)
# form, priority, weight of one match, expression with the family's name as {name}.
FORMS = [
    ("identifier", 90, 0.99, r"spdx license identifier {short}" + rf"(?:{_VERSION})?(?: only)?"),
    ("grant-version", 80, 0.97, _GRANT + r"{name}" + _VERSION),
    ("grant", 70, 0.95, _GRANT + r"{name}"),
    ("see", 65, 0.9, r"(?:see|read|refer to|copy of|subject to|governed by) (?:the )?{name}(?:" + _VERSION + ")?"),
    ("version", 60, 0.85, r"{name}" + _VERSION),
    ("name", 50, 0.7, r"{name}"),
]
# label, keyword, priority, weight, expression: texts that name no family.
PHRASES = [
    ("mit", "permission is hereby granted", 85, 0.97, r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission to use copy modify", 85, 0.97, r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribution and use in source", 85, 0.97, r"redistribution and use in source and binary forms"),
    ("zlib", "this software is provided as is", 85, 0.9, r"this software is provided as is without any express or implied warranty"),
    ("gpl", "free software you can redistribute", 85, 0.9, r"this (?:program|library|file) is free software you can redistribute it"),
    ("unlicense", "released into the public domain", 85, 0.95, r"free and unencumbered software released into the public domain"),
    ("wtfpl", "do what the", 85, 0.95, r"do what the \w+ you want to public licen[cs]e"),
    ("public-domain", "public domain", 55, 0.7, r"(?:released|placed|dedicated|is) (?:in|into|to) the public domain"),
    ("proprietary", "all rights reserved", 40, 0.5, r"all rights reserved"),
    ("proprietary", "proprietary and confidential", 45, 0.7, r"proprietary and confidential"),
    ("copyright", "copyright", 30, 0.3, r"copyright (?:c )?(?:©? ?)[0-9]{4}(?: [0-9]{4})?(?: by)?"),
]


class Rule(NamedTuple):
    name: str
    label: str
    keywords: tuple
    priority: int
    weight: float
    pattern: re.Pattern


def _compiled(expression):
    return re.compile(f" (?:{expression})(?= )".encode())


def _keywords(gate):
    return tuple(b" " + keyword.encode() for keyword in gate.split("|"))


@lru_cache(1)
def rules():
    """All rules, highest priority first."""
    found = []
    for number, (label, keyword, name, short) in enumerate(FAMILIES):
        for form, priority, weight, expression in FORMS:
            if "{short}" in expression:
                if not short:
                    continue
                gate, expression = f"identifier {short}", expression.replace("{short}", short)
            else:
                gate, expression = keyword, expression.replace("{name}", f"(?:{name})")
            rule = Rule(f"{number}-{label}-{form}", label, _keywords(gate), priority, weight, _compiled(expression))
            found.append(rule)
    for number, (label, keyword, priority, weight, expression) in enumerate(PHRASES):
        rule = Rule(f"p{number}-{label}", label, _keywords(keyword), priority, weight, _compiled(expression))
        found.append(rule)
    return sorted(found, key=lambda r: (-r.priority, r.name))


@lru_cache(1)
def _gates():
    gated = {}
    for rule in rules():
        gated.setdefault(rule.keywords, []).append(rule)
    return list(gated.items())


#: ASCII letters to lower case, other ASCII but digits to a space; the rest stays.
_TO_WORDS = bytes(
    ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)
) + bytes(range(128, 256))
_BASE = [(_compiled(re.escape(p)), label) for p, label in BASE.items()]


def suppress(matches):
    """Matches ``(rule, start, end)`` that lie in no stronger one that is taken."""
    ordered = sorted(matches, key=lambda m: (-m[0].priority, m[1] - m[2], m[1], m[0].name))
    starts, ends, taken = [], [], []
    for match in ordered:
        _, start, end = match
        # Taken intervals never contain one another, so ends rise with starts.
        at = bisect_left(starts, start + 1) - 1
        if at >= 0 and ends[at] >= end:
            continue
        inner = at + 1 if at < 0 or starts[at] < start else at
        last = inner
        while last < len(ends) and ends[last] <= end:
            last += 1
        starts[inner:last], ends[inner:last] = [start], [end]
        taken.append(match)
    return sorted(taken, key=lambda m: (m[1], m[2]))


class Scan(NamedTuple):
    n_words: int
    base: list  # (first word, label) of each place of a base phrase
    matches: list  # (rule, first word, word after the last), in order


def scan(text):
    """Scan of one text; None counts as empty."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()
    joined = b" " + b" ".join(words) + b" "
    base, matches = [], []
    for keywords, gated in _gates():
        for keyword in keywords:
            if keyword in joined:
                for rule in gated:
                    matches += [(rule, *m.span()) for m in rule.pattern.finditer(joined)]
                break
    if b" cc by " in joined or b" license " in joined:
        for pattern, label in _BASE:
            base += [(m.start(), label) for m in pattern.finditer(joined)]
    if not base and not matches:
        return Scan(len(words), [], [])
    # The n-th space stands before the n-th word.
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    word_at = lambda place: int(np.searchsorted(spaces, place))
    return Scan(
        len(words),
        sorted((word_at(place), label) for place, label in base),
        [(rule, word_at(start), word_at(end)) for rule, start, end in suppress(matches)],
    )


def _score(found):
    """How sure it is that the text names a license, from 0 to 1."""
    none = 1.0
    for weight in [m[0].weight for m in found.matches] + [0.7] * bool(found.base):
        none *= 1 - weight
    return 1 - none


RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "detections",
            T.ArrayType(
                T.StructType()
                .add("rule", "string")
                .add("label", "string")
                .add("first_word", "long")
                .add("end_word", "long")
            ),
        ),
    ]
)
_ARROW = [pa.int64()] * 4 + [
    pa.string(),
    pa.string(),
    pa.float64(),
    pa.list_(
        pa.struct(
            [("rule", pa.string()), ("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64())]
        )
    ),
]


def _row(text):
    found = scan(text)
    base_labels = {label for _, label in found.base}
    labels = base_labels | {rule.label for rule, _, _ in found.matches}
    return (
        found.n_words,
        len(found.base),
        found.base[0][0] if found.base else None,
        found.base[-1][0] if found.base else None,
        ",".join(sorted(base_labels)),
        ",".join(sorted(labels)),
        _score(found),
        [
            {"rule": rule.name, "label": rule.label, "first_word": first, "end_word": end}
            for rule, first, end in found.matches
        ],
    )


def scan_licenses(df, text="text"):
    """Add what ``scan`` finds in each text: counts, labels, score and detections.

    One narrow stage over whole texts. A null or empty text has no words, empty labels
    and score 0. Repeated rows are kept; columns named like an added one are replaced.
    """
    kept = [c for c in df.columns if c == text or c not in RESULT.names]
    schema = T.StructType([df.schema[c] for c in kept] + RESULT.fields)

    def scan_batches(batches):
        for batch in batches:
            rows = [_row(t.as_py()) for t in batch.column(text)]
            columns = list(zip(*rows)) if rows else [()] * len(_ARROW)
            added = [pa.array(c, t) for c, t in zip(columns, _ARROW)]
            own = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*own, *added], schema.names)

    return df.select(*kept).mapInArrow(scan_batches, schema)


@query("op6_license_rules")
def op6_license_rules(spark, sf_dir):
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(documents).drop("text", "detections")

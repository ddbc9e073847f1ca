import re
from re import _parser

import pytest

from gradeloom.llm import license_rules as lic


def labels(text):
    return [m[0].label for m in lic.scan(text).matches]


def test_hundreds_of_rules():
    assert len(lic.rules()) > 300
    assert len({r.name for r in lic.rules()}) == len(lic.rules())


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Licensed under the Apache License, Version 2.0.", ["apache"]),
        ("This work is licensed under the GNU General\nPublic License, version 3.", ["gpl"]),
        ("Licensed under CC BY-NC 4.0.", ["cc-by-nc"]),
        ("Released under the MIT License.", ["mit"]),
        ("SPDX-License-Identifier: BSD-3-Clause", ["bsd-3-clause"]),
        ("GNU Lesser General Public License v2.1 or later", ["lgpl"]),
        ("MIT License. Apache License.", ["mit", "apache"]),
        ("mit dem", []),
        ("", []),
        (None, []),
    ],
)
def test_labels(text, expected):
    assert labels(text) == expected


def test_contained_matches_are_suppressed():
    rule = lic.rules()[0]
    weak = rule._replace(priority=1)
    assert lic.suppress([(weak, 2, 5), (rule, 0, 9), (weak, 8, 12)]) == [(rule, 0, 9), (weak, 8, 12)]
    assert lic.suppress([(weak, 0, 9), (rule, 2, 5)]) == [(weak, 0, 9), (rule, 2, 5)]


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [
        (i, label)
        for phrase, label in lic.BASE.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = sorted(i for i, _ in places)
    return (
        len(words),
        len(places),
        starts[0] if starts else None,
        starts[-1] if starts else None,
        ",".join(sorted({label for _, label in places})),
    )


ODD = [None, "", "  ", "CC BY CC-BY cc\nby", "ÉCC BY", "cc by " * 30000, "a\x00mit license\x7fÀÉ", "xmit license"]


def test_rows(spark):
    rows = [(i, t, "keep") for i, t in enumerate(ODD)] + [(3, ODD[3], "keep")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = lic.scan_licenses(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(r.text)
        assert 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
    assert lic.scan_licenses(df.limit(0)).collect() == []


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = {d.doc_id: d.text for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = lic.op6_license_rules(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
    assert {"gpl", "apache", "cc-by-nc,cc-by", "mit"} & {r.labels for r in rows}


def wordings(parsed):
    """Every text of a parsed expression; repeats stand as often as they must and as they may, once more at most."""
    texts = [""]
    for op, value in parsed:
        if str(op) == "LITERAL":
            more = [chr(value)]
        elif str(op) == "IN":
            code, first = value[0]
            more = [chr(c) for c in ([v for _, v in value] if str(code) == "LITERAL" else first[:1] if str(code) == "RANGE" else [97])]
        elif str(op) == "BRANCH":
            more = [t for branch in value[1] for t in wordings(branch)]
        elif str(op) == "SUBPATTERN":
            more = wordings(value[3])
        elif str(op) == "MAX_REPEAT":
            low, _, inner = value
            more = [t * n for t in wordings(inner) for n in {low, max(low, 1)}]
        else:
            assert str(op) == "ASSERT", op
            more = [""]
        texts = [a + b for a in texts for b in dict.fromkeys(more)]
    return texts


def test_every_wording_passes_its_own_gate():
    for rule in lic.rules():
        if rule.name.startswith("p") or rule.name.endswith("-identifier"):
            texts = wordings(_parser.parse(rule.pattern.pattern.decode()))
        else:
            name = lic.FAMILIES[int(rule.name.split("-")[0])][2]
            texts = [f" {t}" for t in wordings(_parser.parse(name))]
        for text in texts:
            assert any(k in f"{text} ".encode() for k in rule.keywords), (rule.name, text)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("CreativeML Open RAIL-M License", ["openrail"]),
        ("the BigScience RAIL License v1.0", ["openrail"]),
        ("BigScience OpenRAIL-M license", ["openrail"]),
        ("Zero-Clause BSD License", ["0bsd"]),
        ("Licensed under Creative Commons BY-NC-SA 4.0.", ["cc-by-nc-sa"]),
        ("a railway license", []),
    ],
)
def test_wordings_beside_the_first_keyword(text, expected):
    assert labels(text) == expected

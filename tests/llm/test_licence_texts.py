"""Licence texts, headers and notices anywhere in a text against windows and lines compared one by one."""

import collections
import random
import re

import pytest

from tableloom.llm import licences
from tableloom.llm.queries import LICENCES, QUERIES, licence_templates

TINY = "/root/testdata/sf0.001"
NOTICES = [(name, "notice", text) for name, text in LICENCES.items()]
TEXTS = {(licence, kind): text for licence, kind, text in licences.licence_texts()}


def words_of(text):
    return [m.span() for m in re.finditer(r"[^\W_]+", text)]


def grams(words):
    return set(zip(words, words[1:]))


def dice(x, y):
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 0.0


def told(words, templates):
    telling = licences.NAME_WORDS | {w for licence, _, _ in templates for w in re.findall(r"[^\W_]+", licence.lower())}
    return collections.Counter(w for w in words if w in telling or re.fullmatch(r"\d\d?", w))


def names_it(words, template, templates):
    x, y = (told([w.lower() for w in ws], templates) for ws in (words, template))
    return all(abs(x[w] - y[w]) <= max(x[w], y[w]) // 4 for w in set(x) | set(y))


def brute(text, templates, threshold=licences.THRESHOLD):
    places = words_of(text)
    words = [text[a:b].lower() for a, b in places]
    spans, at = [], 0
    for line in text.split("\n"):
        spans.append((at, at + len(words_of(line))))
        at = spans[-1][1]
    found = []
    for k, (_, _, template) in enumerate(templates):
        own = [template[a:b].lower() for a, b in words_of(template)]
        last = max(len(words) - len(own), 0)
        windows = [(i, min(i + len(own), len(words))) for i in range(last + 1)]
        rated = sorted((-dice(grams(words[a:b]), grams(own)), a, b) for a, b in windows + spans if b - a > 1)
        kept = []
        for score, a, b in rated:
            if -score >= threshold and all(b <= c or d <= a for _, c, d in kept):
                kept.append((score, a, b))
        found += [(score, a - b, k, a, b) for score, a, b in kept]
    rows, winners = set(), []
    for score, _, k, a, b in sorted(found):
        licence, kind, template = templates[k]
        own = [template[c:d] for c, d in words_of(template)]
        best = names_it(words[a:b], own, templates) and all(b <= c or d <= a or licence == other for other, c, d in winners)
        winners += [(licence, a, b)] if best else []
        start, end = places[a][0], places[b - 1][1]
        rows.add((licence, kind, text.count("\n", 0, start), start, end, -score, best))
    return rows


def found(spark, texts, templates):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = {i: [] for i in range(len(texts))}
    for r in licences.find(df, templates).collect():
        out[r.doc_id].append(tuple(r)[1:])
    return out


def test_windows_and_lines(spark):
    rng = random.Random(3)
    pieces = [*LICENCES.values(), "the MIT License", "Foo and bar were here.", "MIT", "version 2", "Public\nLicense,", "licensed under", "é_x İ"]
    texts = ["", "MIT", "the mit license", "Released under\nthe MIT License."]
    texts += [rng.choice([" ", "\n"]).join(rng.choice(pieces) for _ in range(rng.randrange(1, 9))).replace("İ", "i") for _ in range(150)]
    got = found(spark, [None, *texts], NOTICES)
    nothing = [(None, None, None, None, None, 0.0, False)]
    assert got[0] == nothing
    for i, text in enumerate(texts, 1):
        want = brute(text, NOTICES)
        assert len(got[i]) == max(len(want), 1) and set(got[i]) == (want or set(nothing)), text


def test_what_lines_did_not_find(spark):
    filler = "Foo and bar were here. "
    cases = [
        (filler * 3 + "Released under the MIT License.", {("MIT", "notice")}),
        ("Copyright (c) 2020 A. Person\n\n" + TEXTS["MIT", "text"], {("MIT", "text")}),
        ("// " + TEXTS["GPL-3.0", "header"].replace("\n", "\n// ") + "\nint main() { return 0; }", {("GPL-3.0", "header")}),
        (TEXTS["BSD-3-Clause", "text"].replace("COPYRIGHT HOLDERS", "REGENTS"), {("BSD-3-Clause", "text")}),
        ("Released under the MIT License.\n" + filler + "\nLicensed under CC BY 4.0.", {("MIT", "notice"), ("CC-BY-4.0", "notice")}),
    ]
    got = found(spark, [t for t, _ in cases], NOTICES + [(*k, t) for k, t in TEXTS.items()])
    for i, (text, want) in enumerate(cases):
        assert {r[:2] for r in got[i] if r[-1]} == want, text
    start, end = next((r[3], r[4]) for r in got[0] if r[0] == "MIT")
    assert cases[0][0][start:end] == "Released under the MIT License"


def test_every_text_and_header_is_found(spark):
    given = NOTICES + [(*k, t) for k, t in TEXTS.items()]
    got = found(spark, [f"Some words before.\n{t}\nSome words after." for t in TEXTS.values()], given)
    for i, (licence, kind) in enumerate(TEXTS):
        assert {r[0] for r in got[i] if r[-1]} == {licence}
        assert (licence, kind, 1.0) in {(r[0], r[1], r[5]) for r in got[i] if r[-1]}


# a notice, and the licence that it names
NAMED = [
    ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"), ("Licensed under CC BY-NC-SA 4.0", "CC-BY-NC-SA-4.0"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1"), ("Released under the 2-Clause BSD License.", "BSD-2-Clause"),
    ("Licensed under the Apache License, Version 1.1.", "Apache-1.1"), ("SPDX-License-Identifier: MIT", "MIT"), ("// SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0"),
    ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"), ("MIT License", "MIT"), ("See the ISC License for more.", "ISC"), ("Released under the ISC License.", "ISC"),
    ("Licensed under the European Union Public Licence, version 1.2.", "EUPL-1.2"), ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("Licensed under CC BY-SA 3.0.", None), ("SPDX-License-Identifier: Zlib", None), ("Released under the 4-Clause BSD License.", None),
    ("Licensed under the Apache License, Version 1.0.", None), ("This work is licensed under the GNU General Public License, version 1.", None),
]


def test_relatives_are_told_apart(spark):
    templates = licence_templates()
    renamed = TEXTS["GPL-3.0", "text"].replace("GNU General Public License", "GNU Affero General Public License").replace("GNU GENERAL", "GNU AFFERO GENERAL")
    texts = [t for t, _ in NAMED] + [f"Foo bar was here. {t} And more words follow here." for t, _ in NAMED] + [renamed, TEXTS["AGPL-3.0", "header"]]
    got = found(spark, texts, templates)
    for i, (text, want) in enumerate(NAMED * 2):
        assert {r[0] for r in got[i] if r[-1]} == ({want} if want else set()), text
    for i in (len(texts) - 2, len(texts) - 1):
        assert "AGPL-3.0" in {r[0] for r in got[i] if r[-1]} and "GPL-3.0" not in {r[0] for r in got[i] if r[-1] and r[1] != "identifier"}


def test_a_very_long_text(spark):
    text = "Foo and bar were here, again and again. " * 30_000 + "Released under the MIT License. " + "x " * 200_000
    (row, *more) = [r for r in found(spark, [text], licence_templates())[0] if r[-1]]
    assert {row[0], *(r[0] for r in more)} == {"MIT"} and text[row[3] : row[4]].endswith("MIT License")


def test_places_when_lower_case_is_longer(spark):
    text = "İİ İ. Released under the MIT License."
    (row,) = [r for r in found(spark, [text], NOTICES)[0]]
    assert text[row[3] : row[4]] == "Released under the MIT License"
    with pytest.raises(ValueError):
        licences.Templates([("x", "notice", "one")], 0.6)


def test_query_finds_notices_in_lines(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").collect()
    rows = [tuple(r) for r in QUERIES["op7_licence_scan"](spark, TINY).collect()]
    lines = {(d.doc_id, name) for d in docs for name, text in LICENCES.items() if text in (d.text or "").split("\n")}
    assert {r[0] for r in rows} == {d.doc_id for d in docs} and lines
    assert {(r[0], r[1]) for r in rows if r[-1]} == lines

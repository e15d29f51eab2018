"""Licenses told apart by their telling words, and spans against a plain alignment."""

import random

import pytest

from ticketloom.llm import licenses
from ticketloom.llm.licenses import Index, TEMPLATES, align, scan, telling, words

INDEX = Index(TEMPLATES)
GPL = TEMPLATES["GPL-header"]
CC = "This work is licensed under a Creative Commons {} License."


@pytest.mark.parametrize("text, names", [
    ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0-notice"]),
    ("This work is licensed under the GNU General Public License, version 1.", []),
    ("This work is licensed under the GNU General Public License v3.0", ["GPL-3.0-notice"]),
    ("Licensed under the Apache License, Version 1.1.", ["Apache-1.1-notice"]),
    ("Licensed under the Apache License, Version 1.0.", []),
    (TEMPLATES["Apache-2.0-header"].replace("2.0", "1.1"), ["Apache-1.1-notice"]),
    (CC.format("Attribution 3.0 Unported"), ["CC-BY-3.0"]),
    (CC.format("Attribution 2.5 Generic"), []),
    (CC.format("Attribution-NonCommercial 4.0 International"), ["CC-BY-NC-4.0-notice"]),
    (CC.format("Attribution-ShareAlike 4.0 International"), ["CC-BY-SA-4.0"]),
    (CC.format("Attribution-NonCommercial-ShareAlike 3.0 Unported"), []),
    (CC.format("Attribution - NonCommercial 4.0 International"), []),
    (CC.format("Attribution 4.0 International"), ["CC-BY-4.0"]),
    (GPL, ["GPL-header"]),
    (GPL.replace("program", "library"), ["GPL-header"]),
    (GPL.replace("GNU General", "GNU Affero General"), ["AGPL-header"]),
    (GPL.replace("GNU General", "GNU Lesser General"), ["LGPL-header"]),
    (GPL.replace("program", "library").replace("GNU General", "GNU Library General"), ["LGPL-2.0-header"]),
    ("Released under the BSD License.", []), ("Released under the MIT License!", ["MIT-notice"]),
    ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]), ("Licensed under CC BY-NC-SA 4.0.", []), ("Licensed under CC BY 4.0.", [])])
def test_other_licenses_are_not_the_templates(text, names):
    for around in ("{}", "By the way, see 3.2 and GNU make. {} Written by hand in 1.5 hours for Apache."):
        assert [m[0] for m in scan(INDEX, around.format(text))] == names


def test_each_template_is_found_as_itself():
    for name, text in TEMPLATES.items():
        found = scan(INDEX, "some words before it. " + text + " And some words after it.")
        if name != "Apache-2.0-header":
            assert [m[0] for m in found] == [name], name
        assert any(m[0] == name and m[1] == m[2] for m in found), name


def plain(template, text):
    """Best local alignment over the whole table: score and matched words."""
    best, last = (0, 0), [(0, 0)] * (len(text) + 1)
    for word in template:
        row = [(0, 0)]
        for j, other in enumerate(text):
            s, m = max(last[j], (0, 0)) if last[j][0] > 0 else (0, 0)
            cell = (s + 2, m + 1) if word == other else (s - 1, m)
            for o in (last[j + 1], row[j]):
                if o[0] - 1 > cell[0]:
                    cell = (o[0] - 1, o[1])
            row.append(cell)
            if word == other:
                best = max(best, cell)
        last = row
    return best


def test_spans_equal_a_plain_alignment():
    r = random.Random(8)
    vocabulary = [f"w{k}".encode() for k in range(500)]
    checked = 0
    for round_ in range(60):
        template = [r.choice(vocabulary) for _ in range(r.choice((12, 40)))]
        copy = list(template)
        for _ in range(r.randint(0, len(copy) // 8)):
            k = r.randrange(len(copy))
            copy[k:k + 1] = r.choice(([], [b"new"], [copy[k], b"more"]))
        before, after = ([b"x%d" % r.randrange(99) for _ in range(r.randint(0, 30))] for _ in range(2))
        text = before + copy + after
        matched, a, b, pairs = align(template, text, len(before), 8)
        assert (2 * matched - (plain(template, text)[0])) >= 0 and matched == plain(template, text)[1]
        assert plain(template, text[a:b])[1] == matched and text[a] == template[pairs[0][0]] and text[b - 1] == template[pairs[-1][0]]
        assert len(pairs) == matched and all(template[i] == text[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        checked += len(before) <= a and b <= len(before) + len(copy)
    assert checked == 60


def test_versions_are_written_alike():
    assert words(b"v2 v2.0 Version 2, (2.0) 2 2.0.0 2.1.0 v") == [b"2.0", b"2.0", b"version", b"2.0", b"2.0", b"2", b"2.0", b"2.1", b"v"]
    assert telling(words(b"gnu library 2.1 by me 7 library cc by-nc attribution")) == {0, 1, 2, 7, 8, 9}

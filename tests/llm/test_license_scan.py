import pytest

from llm.data import rows, table, with_extra
from vantage.llm import license_scan as S
from vantage.llm.license_texts import TEXTS


def run(spark, lines, **more):
    data = [(i, t, "en", "s", 1) for i, t in enumerate(lines)]
    return {r.doc_id: r for r in S.scan(with_extra(table(spark, data)), **more).collect()}


@pytest.mark.parametrize("name", list(TEXTS))
def test_known_texts_in_other_clothes(spark, name):
    t = TEXTS[name]
    loud = "Copyright (c) 2020 Some Body\n© 2021 [holder]\n\n" + t.upper().replace(",", " ,").replace("\n", "\r\n  ")
    spelled = t.replace("acknowledgment", "acknowledgement").replace("COPYRIGHT HOLDER", "copyright owner")
    got = run(spark, [t, loud, spelled, t + " and more", t[:-40]])
    assert [got[i].license for i in range(5)] == [name, name, name, None, None]


def test_usual_files(spark):
    """Headings, reservations of rights, long licences with and without how to apply them."""
    c = "Copyright (c) 2020 Some Body\n"
    texts = [
        ("MIT", "MIT License\n\n" + c + "\n" + TEXTS["MIT"]), ("MIT", "The MIT License (MIT)\n" + c + "All rights reserved.\n" + TEXTS["MIT"]),
        ("BSD-3-Clause", "BSD 3-Clause License\n\n" + c + "All rights reserved.\n" + TEXTS["BSD-3-Clause"]),
        ("BSD-2-Clause (bullets)", c + TEXTS["BSD-2-Clause"].replace("1. ", "* ").replace("2. ", "* ")),
        ("ISC", "# ISC License\r\n" + c + TEXTS["ISC"]), ("0BSD", "BSD Zero Clause License\n" + TEXTS["0BSD"]),
        ("Apache-2.0", TEXTS["Apache-2.0"].replace("[yyyy] [name of copyright owner]", "2021 Some Body")),
        ("GPL-3.0", TEXTS["GPL-3.0"].replace("https:", "http:")), ("GPL-3.0 (terms only)", TEXTS["GPL-3.0"].split("How to Apply")[0]),
        (None, "We all love the MIT License\n" + TEXTS["MIT"]),
    ]
    got = run(spark, [t for _, t in texts])
    assert [got[i].license for i in range(len(texts))] == [name for name, _ in texts]
    header = """// Licensed under the Apache License, Version 2.0 (the "License");\n// SPDX-License-Identifier: GPL-2.0-or-later"""
    assert run(spark, [header])[0].notices == "Apache-2.0,GPL-2.0"


def test_notices(spark):
    got = run(spark, ["Some prose.\nReleased under the MIT Licence.\nLicensed under CC BY-NC 4.0\nreleased under the mit license",
                      "We talk about the MIT License.", None, ""])
    assert (got[0].n_notice_lines, got[0].notices) == (3, "CC-BY-NC-4.0,MIT")
    assert [(got[i].n_notice_lines, got[i].notices, got[i].license) for i in (1, 2, 3)] == [(0, "", None)] * 3


def test_awkward_rows_and_own_tables(spark):
    assert S.scan(table(spark, rows())).count() == len(rows())
    assert S.scan(table(spark, [])).count() == 0
    own = S.known_table(spark, {"B": "My  Text!", "A": "my text"})
    got = run(spark, ["MY TEXT", "x"], texts=own, notices={})
    assert (got[0].license, got[1].license, got[0].n_notice_lines) == ("A", None, 0)


def test_canonical_forms_by_hand(spark):
    """Forms written out by hand, not through the operator's expressions."""
    by_hand = {
        "The  \"Quick\"\tBrown-Fox,\r\njumps!": "the quick brown fox jumps",
        "Copyright (c) 2020 Some Body\nKeep this line": "keep this line",
        "   © 1999-2003 A, B\n\n * All rights reserved. *\nrest": "rest",
        "MIT License\n\nPermission": "permission",
        "the copyright notice stays in a sentence": "the copyright notice stays in a sentence",
        "The copyright owners keep it\nend": "the copyright holders keep it end",
        "Licence and ACKNOWLEDGEMENT": "license and acknowledgment",
        "ünïcode — dashes … and №5": "ünïcode dashes and 5",
        "": "",
        " \n\t ": "",
    }
    rows_ = spark.createDataFrame([(k, v) for k, v in by_hand.items()], "text string, want string")
    got = {r.text: r.c for r in rows_.select("text", S.canonical(rows_.text).alias("c")).collect()}
    assert got == by_hand

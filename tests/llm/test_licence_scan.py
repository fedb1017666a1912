from __future__ import annotations

from compare import compare, duck
from llm_helpers import SF_DIR

from kessan.llm import licence_scan, queries


def test_query_against_sql(spark):
    for folder in (SF_DIR, "/root/testdata/sf0.01"):
        name = "op10_licence_scan"
        ok, note = compare(spark, duck(folder), folder, name, queries.QUERIES[name], queries.SQL[name])
        assert ok, note


def test_no_python_in_the_plan(spark):
    plan = queries.op10_licence_scan(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def scanned(spark, rows):
    # Further columns with names that the operator uses inside.
    rows = [(*r, 0.5, "x") for r in rows]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string, score double, dir string")
    out = licence_scan.scan(df)
    assert out.columns == ["doc_id", "path", "licence", "score", "inherited_from"]
    return {r["doc_id"]: (r["licence"], r["inherited_from"], r["score"] is not None) for r in out.collect()}


def test_own_and_inherited_licences(spark):
    mit, apache = licence_scan.TEMPLATES["MIT"], licence_scan.TEMPLATES["Apache-2.0"]
    got = scanned(spark, [
        (1, "a/LICENSE", f"{mit}."),
        (2, "a/b/c.txt", "plain words. More of them."),
        (3, "a/b/d.txt", f"Some words first.\n{apache}. And more! Copyright nobody."),
        (4, "a/x/y/COPYING.txt", licence_scan.TEMPLATES["GPL-3.0"]),
        (5, "a/x/y/z/e.txt", None),
        (6, "a/x/f.txt", ""),
        (7, "other/f.txt", "licence of an unknown kind that nobody wrote down anywhere else before"),
        (8, "root.txt", "words"),
        (9, None, None),
        (10, "ab/f.txt", "words"),
        (11, "a/b/c.txt", f"{mit} " * 3000),
        (12, "a/x/NOTICE", "nothing said here"),
    ])
    assert got == {
        1: ("MIT", None, True), 2: ("MIT", "a", False), 3: ("Apache-2.0", None, True), 4: ("GPL-3.0", None, True),
        5: ("GPL-3.0", "a/x/y", False), 6: ("MIT", "a", False), 7: (None, None, False), 8: (None, None, False),
        9: (None, None, False), 10: (None, None, False), 11: ("MIT", None, True), 12: ("MIT", "a", False),
    }


def test_every_template_finds_itself_and_equal_rows(spark):
    rows = [(i, f"d{i}/LICENSE", text) for i, text in enumerate(licence_scan.TEMPLATES.values())]
    got = scanned(spark, rows + rows)
    assert [got[i][0] for i in range(len(rows))] == list(licence_scan.TEMPLATES)
    assert scanned(spark, []) == {}


def test_root_licence_covers_all(spark):
    got = scanned(spark, [(1, "LICENSE", licence_scan.TEMPLATES["MIT"]), (2, "x.txt", "w"), (3, "p/q/r.txt", "w")])
    assert got[2] == ("MIT", "", False) and got[3] == ("MIT", "", False)




def test_real_licence_texts(spark):
    """A whole text with its copyright line, a source file with a header, and a notice in comments."""
    mit = "MIT License\n\nCopyright (c) 2019 Some Person\n\n" + licence_scan.TEXTS["MIT"].replace("\n", " ")
    commented = lambda name, mark: "\n".join(f"{mark} {line}" for line in licence_scan.TEXTS[name].split("\n"))
    got = scanned(spark, [
        (1, "a/LICENSE", mit),
        (2, "b/main.py", "#!/usr/bin/env python\n# Copyright 2020 The Authors.\n#\n" + commented("Apache-2.0", "#") + "\nimport os\nprint(os.getcwd())\n"),
        (3, "c/prog.c", commented("GPL-3.0", " *") + "\n */\nint main(void) { return 0; }\n"),
        (4, "d/old.c", commented("GPL-2.0", " *") + "\n */\nint x;\n"),
        (5, "e/COPYING", "Copyright 2001 Others\n" + licence_scan.TEXTS["BSD-3-Clause"]),
        (6, "f/lib.js", commented("MPL-2.0", "//") + "\nlet x = 1;\n"),
        (7, "g/LICENCE.txt", "Copyright 1999 One\n" + licence_scan.TEXTS["ISC"]),
        (8, "a/deep/er/f.txt", "words only"),
        (9, "h/prose.txt", "A novel about a ship. The captain had a licence to sail, and little else."),
    ])
    assert [got[i][0] for i in range(1, 10)] == ["MIT", "Apache-2.0", "GPL-3.0", "GPL-2.0", "BSD-3-Clause", "MPL-2.0", "ISC", "MIT", None]
    assert got[8][1] == "a"

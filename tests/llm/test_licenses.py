import re

import duckdb
import licence_texts
import pytest
from support import ROWS, documents, empty

from millrace.llm import licenses as lic

MIT = """Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy of
this software and associated documentation files (the "Software"), to deal in
the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of
the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
TEXTS = [
    ("Some prose.\nReleased under the MIT License.", "MIT", 0),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0", 0),
    ("X. This work is licensed under the GNU General Public License, version 3. Y", "GPL-3.0-only", 0),
    ("Licensed under CC BY-NC 4.0.\nReleased under the MIT License", "CC-BY-NC-4.0,MIT", 0),
    (MIT, "MIT", 0),
    ("Licensed under terms nobody knows.", "", 1),
    ("RELEASED   UNDER *the* MIT license!", "MIT", 0),
    ("unreleased under the mit licenses", "", 1),
    ("a" * 100_000 + ". Released under the MIT License.", "MIT", 0),
    ("Copyright 2001. All rights reserved.", "All-Rights-Reserved", 0),
    ("", "", 0),
    (None, "", 0),
]


def test_texts_and_sql(spark):
    rows = [(i, t, None, None, None) for i, (t, *_) in enumerate(TEXTS)]
    df = lic.license_scan(documents(spark, rows))
    assert {r.doc_id: (r.licenses, r.n_unknown) for r in df.collect()} == {i: (name, n) for i, (_, name, n) in enumerate(TEXTS)}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    assert sorted(con.sql(lic.sql()).fetchall()) == sorted(tuple(r) for r in df.collect())


def test_odd_rows(spark):
    out = lic.license_scan(documents(spark)).collect()
    assert sorted([r.doc_id for r in out], key=str) == sorted([r[0] for r in ROWS], key=str)
    assert all((r.licenses, r.sentence_ids, r.n_unknown) == ("", "", 0) for r in out)
    assert lic.license_scan(empty(spark)).count() == 0


def test_longer_rules_use_up_their_sentences(spark):
    text = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    one = lic.license_scan(documents(spark, [(1, text, None, None, None)])).first()
    assert one.licenses == "BSD-3-Clause" and one.sentence_ids == "bsd-grant,bsd-source,bsd-binary,bsd-endorse"


@pytest.mark.parametrize("sentence", [s for sentences in lic.SENTENCES.values() for s in sentences])
def test_known_sentences_are_normal_and_have_an_anchor(sentence):
    assert re.fullmatch("[a-z0-9]+( [a-z0-9]+)*", sentence) and any(a in sentence for a in lic.ANCHORS)


def test_rules_name_known_identifiers():
    known = {i for ids in [*lic.SENTENCES, *lic.TEMPLATES] for i in ids.split()}
    assert all(i in known for ids, _ in lic.RULES for i in ids)


def test_native_plan(spark):
    """Nothing but the scan and projections: no worker process, join or exchange."""
    df = lic.license_scan(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    steps = re.findall(r"^[ :*()0-9+-]*([A-Z][A-Za-z]*)", df._jdf.queryExecution().executedPlan().toString(), re.M)
    assert "Project" in steps and set(steps) <= {"Project", "ColumnarToRow", "FileScan"}


LEADERS = {"plain": ("", "", ""), "hash": ("", "# ", ""), "slashes": ("", "// ", ""), "stars": ("/*\n", " * ", " */\n"), "dashes": ("", "-- ", "")}


def compared(spark, texts):
    """licenses and n_unknown of each text by Spark, after a comparison with the SQL."""
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    df = lic.license_scan(documents(spark, rows, clashing=False))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    found = sorted(tuple(r) for r in df.collect())
    assert sorted(con.sql(lic.sql()).fetchall()) == found
    return [(licenses, n) for _, licenses, _, n in found]


def test_canonical_notices(spark):
    wanted, texts = [], []
    for (first, leader, last), (name, text) in [(way, item) for way in LEADERS.values() for item in licence_texts.TEXTS.items()]:
        texts.append("Some prose before.\n\n" + first + "".join((leader + line).rstrip() + "\n" for line in text.splitlines()) + last + "\nint main() { return 0; }\n")
        wanted.append((name, 0))
    assert compared(spark, texts) == wanted


def test_tags_and_titles(spark):
    cases = [
        *((f"// SPDX-License-Identifier: {name}\nint x;", name, 0) for name in lic.SPDX),
        ("/* SPDX-License-Identifier: MIT */", "MIT", 0),
        ("# SPDX-License-Identifier: (MIT OR Apache-2.0)\ncode", "Apache-2.0,MIT", 0),
        ("# SPDX-License-Identifier: GPL-2.0-only AND MIT", "GPL-2.0-only,MIT", 0),
        ("SPDX-License-Identifier: Nobody-1.0", "", 1),
        ("MIT License", "MIT", 0),
        ("# The MIT License (MIT)\n\nSome prose.", "MIT", 0),
        ("Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)", "BSL-1.0", 0),
        ("                                 Apache License\n                           Version 2.0, January 2004\n", "Apache-2.0", 0),
        ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n", "GPL-3.0-only", 0),
    ]
    assert compared(spark, [t for t, *_ in cases]) == [c[1:] for c in cases]


def test_a_used_rule_parts_its_neighbours(spark):
    sentence = lambda i: max(lic.SENTENCES[i], key=len) + ". "
    bsd = "".join(map(sentence, ["bsd-grant", "bsd-source", "bsd-binary"]))
    texts = [sentence("mit-grant") + bsd + sentence("mit-notice"), bsd + bsd, sentence("mit-grant") + sentence("mit-notice") + bsd]
    texts.append("".join(map(sentence, ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse"])) * 2)
    assert compared(spark, texts) == [("BSD-2-Clause", 0), ("BSD-2-Clause", 0), ("BSD-2-Clause,MIT", 0), ("BSD-3-Clause", 0)]


EXPRESSIONS = {
    "MIT": "MIT", "mit": "MIT", "(MIT)": "MIT", "0BSD": "0BSD", "GPL-2.0": "GPL-2.0-only", "GPL-2.0+": "GPL-2.0-or-later", "LGPL-2.1": "LGPL-2.1-only",
    "LGPL-2.1+": "LGPL-2.1-or-later", "AGPL-3.0": "AGPL-3.0-only", "GPL-3.0-or-later": "GPL-3.0-or-later", "Apache-2.0+": "Apache-2.0+",
    "MIT OR Apache-2.0 OR ISC": "Apache-2.0,ISC,MIT", "(MIT OR Apache-2.0) AND BSD-3-Clause": "Apache-2.0,BSD-3-Clause,MIT", "MIT AND (ISC OR (Zlib AND 0BSD))": "0BSD,ISC,MIT,Zlib",
    "GPL-2.0-only WITH Linux-syscall-note": "GPL-2.0-only WITH Linux-syscall-note", "GPL-2.0 WITH Classpath-exception-2.0": "GPL-2.0-only WITH Classpath-exception-2.0",
    "GPL-2.0+ WITH GCC-exception-3.1 OR MIT": "GPL-2.0-or-later WITH GCC-exception-3.1,MIT", "(GPL-2.0-or-later WITH Bison-exception-2.2) AND LGPL-3.0+": "GPL-2.0-or-later WITH Bison-exception-2.2,LGPL-3.0-or-later",
    "Apache-2.0 WITH LLVM-exception": "Apache-2.0 WITH LLVM-exception", "GPL-2.0-or-later OR MIT": "GPL-2.0-or-later,MIT", "MIT AND MIT": "MIT", "CC-BY-SA-4.0 OR CC0-1.0": "CC-BY-SA-4.0,CC0-1.0",
    "MPL-2.0 or EPL-2.0 and LGPL-2.1-only": "EPL-2.0,LGPL-2.1-only,MPL-2.0", "((ISC))": "ISC", "Artistic-2.0+": "Artistic-2.0+", "OFL-1.1": "OFL-1.1", "WTFPL OR Unlicense OR X11 OR PSF-2.0": "PSF-2.0,Unlicense,WTFPL,X11",
    "GPL-1.0+ OR GPL-2.0-only": "GPL-1.0-or-later,GPL-2.0-only", "EPL-1.0 WITH Nothing-known": "EPL-1.0", "BSL-1.0 AND MIT-0 AND CC-BY-3.0": "BSL-1.0,CC-BY-3.0,MIT-0",
}


def test_spdx_expressions(spark):
    ways = ["// SPDX-License-Identifier: {}\nint x;", "/* SPDX-License-Identifier: {} */", "# spdx-license-identifier: {}\n\nSome prose."]
    texts = [ways[i % 3].format(e) for i, e in enumerate(EXPRESSIONS)] + ["SPDX-License-Identifier: MIT OR Nobody-1.0", "SPDX-License-Identifier: LicenseRef-mine AND Nobody-1.0"]
    assert compared(spark, texts) == [*((x, 0) for x in EXPRESSIONS.values()), ("MIT", 1), ("", 2)]


def test_notices_with_open_parts(spark):
    assert compared(spark, [t for _, t in licence_texts.NOTICES]) == [(name, 0) for name, _ in licence_texts.NOTICES]


def test_rights_reserved_stand_alone_only(spark):
    texts = ["Copyright 2001 X. All rights reserved.", "Copyright 2001 X. All rights reserved.\nUnder a license of our own.", "Copyright 2001 X. All rights reserved.\nReleased under the MIT License."]
    assert compared(spark, texts) == [("All-Rights-Reserved", 0), ("", 1), ("All-Rights-Reserved,MIT", 0)]

import re

from streammetrics.llm import licenses as L
from streammetrics.llm.common import table


def names(text):
    return [n for n, _, _ in L.licences(L.sentences(text))]


def test_every_known_sentence_has_a_keyword_and_is_found():
    for ident, forms in L.SENTENCES.items():
        for form in forms:
            assert any(k in form.lower() for k in L.KEYWORDS) or "unlicense" in ident, form
            assert [s[0] for s in L.sentences("Some prose.\n# " + form.replace("*", "2020 A B") + ".\nMore.")] == [ident], form


def test_rules_are_ordered_and_wrap_over_lines():
    mit = " ".join(L.SENTENCES[k][0] + "." for k in ("mit-grant", "mit-notice", "mit-as-is", "mit-liability"))
    wrapped = re.sub(r"(.{50,60}) ", r"\1\n * ", mit)
    assert names("MIT License\n\nCopyright (c) 2020 X\n\n" + wrapped) == ["MIT", "MIT"]
    bsd = [L.SENTENCES[k][0] for k in ("bsd-grant", "bsd-source", "bsd-binary")]
    assert names(": ".join(bsd) + ".") == ["BSD-2-Clause"]
    assert names(": ".join(bsd) + ".\nNeither the name of X nor of Y.") == ["BSD-3-Clause"]
    apache = "\n".join(L.SENTENCES[k][0].replace("*", "http://x.org/a") + "." for k in L.RULES[11][1])
    assert names("/* " + apache) == ["Apache-2.0"]
    assert names("LICENSED!! UNDER!! THE!! APACHE!! LICENSE,!! VERSION!! 2.0.") == ["Apache-2.0"]
    assert names("x\nSPDX-License-Identifier: GPL-3.0-or-later\ny") == ["GPL-3.0-or-later"]
    assert names("This talks of a licensed pilot and the MIT campus. Permission is needed.") == []


def test_query_finds_every_planted_line(spark, sf_dir):
    lines = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
             "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
             "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0."}
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents").collect()}
    got = {r["doc_id"]: r for r in L.op8_license_scan(spark, sf_dir).collect()}
    assert set(got) == set(docs)
    some = 0
    for d, text in docs.items():
        want = {n for n, line in lines.items() if line in text}
        assert want <= set(filter(None, got[d]["licenses"].split(",")))
        some += bool(want)
        for part in filter(None, got[d]["spans"].split(",")):
            name, a, b = part.split(":")
            assert "licen" in text[int(a):int(b)].lower()
    assert some


def test_nulls_repeats_long_and_clashing_columns(spark):
    line = "Released under the MIT License."
    rows = [(1, line, "x"), (1, line, "x"), (None, line, "x"), (2, None, "x"), (3, "", "x"),
            (4, "word. " * 100_000 + line, "x"), (5, "İ " + line, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, licenses string")
    got = sorted(((r["doc_id"], r["licenses"], r["spans"]) for r in L.scan(docs).collect()), key=str)
    assert got == sorted([(1, "MIT", "MIT:0:30"), (1, "MIT", "MIT:0:30"), (None, "MIT", "MIT:0:30"), (2, "", ""), (3, "", ""),
                          (4, "MIT", "MIT:600000:600030"), (5, "MIT", "MIT:2:32")], key=str)
    assert L.scan(docs.limit(0)).count() == 0


GPL = """This program is free software{0} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{1} {2} of the License{3}

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
LATER = ", or\n(at your option) any later version."


def test_gpl_notices_as_published():
    for notice, name in ((GPL.format(";", ";", "either version 2", LATER), "GPL-2.0"), (GPL.format(":", ",", "either version 3", LATER), "GPL-3.0"),
                         (GPL.format(";", ";", "version 2", "."), "GPL-2.0"), (GPL.format(":", ",", "version 3", "."), "GPL-3.0"),
                         (GPL.format(":", " and", "others", "."), "GPL")):
        for text in (notice, " ".join(notice.split()), re.sub("^", " * ", notice, flags=re.MULTILINE)):
            assert names(text) == [name], text


def test_sentences_parted_by_lines_and_marks_are_found():
    for ident, forms in L.SENTENCES.items():
        for form in forms:
            words = form.replace("*", "2020 A B").split()
            for gap in ("\n", "\n# ", "\n *  ", "  "):
                found = [s[0] for s in L.sentences("Some prose.\n" + gap.join(words) + ".")]
                assert found == [ident] or form.endswith("*") and found[:1] == [ident], (form, gap)
    assert names("Released\nunder CC0") == ["CC0-1.0"] and names("released into the public\n# domain") == ["public-domain"]
    assert names("Released\n// under CC BY 4.0") == ["CC-BY-4.0"]

import re

import brute
import pytest

from feira.llm import licenses
from feira.llm.queries import QUERIES

TEXTS = {
    None: ("", ""), "": ("", ""), "mit": ("", ""),
    "MIT License mit license MIT LICENSE.": ("mit", "mit"),
    "Licensed under the Apache License, Version 2.0 (the": ("apache", "apache,apache-2.0"),
    "GNU Lesser General Public License v2.1 or later": ("gpl", "gpl,lgpl-2.1"),
    "under CC BY-NC-SA 4.0. SPDX-License-Identifier: GPL-2.0": ("", "cc-by-nc-sa-4.0,gpl-2.0"),
    "é license İ mit lİcense": ("", ""),
    "dedicated to the public domain": ("", "public-domain"),
    "the 3-clause BSD": ("", "bsd-3-clause"),
    "CC0 1.0 or the Unlicense": ("", "cc0-1.0,unlicense"),
    "general public license general public license": ("gpl", "gpl"),
    "mit license " * 3000: ("mit", "mit"),
}


def test_labels_and_places(frame):
    docs = list(enumerate([*TEXTS, list(TEXTS)[3]]))
    rows = licenses.scan(frame(docs, "doc_id int, text string")).select("doc_id", "text", "licenses.*").collect()
    assert len(rows) == len(docs)
    for r in rows:
        found = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
        assert found == brute.base_licenses(r.text)
        assert (r.base_labels, r.labels) == TEXTS[r.text]
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")


def test_contained_detections_go(spark):
    df = spark.createDataFrame([("licensed under the GNU General Public License version 3",)], "text string")
    found = licenses.scan(df).first().licenses.detections
    assert [(d.label, d.start, d.end) for d in found] == [("gpl-3", 0, 9)]


@pytest.mark.parametrize("text, label, words", [
    ("licensed under the terms of the do what the fuck you want to public license version 2", "wtfpl-2", 17),
    ("licensed under the terms of the creative commons attribution noncommercial sharealike license, version v4.0",
     "cc-by-nc-sa-4.0", None),
])
def test_the_longest_rules_see_all_their_words(spark, text, label, words):
    found = licenses.scan(spark.createDataFrame([(text,)], "text string")).first().licenses
    assert [d.label for d in found.detections] == [label] and found.score == licenses.SURE[3]
    assert words is None or found.detections[0].end == words


def test_rules_without_a_greatest_length_are_refused():
    rule = {"keyword": "mit", "label": "mit", "priority": 1}
    assert licenses.span_of(licenses.rules()) >= 19
    for pattern in ("^mit( [a-z]+)+(?= |$)", "^mit(?: x){2,}(?= |$)", "^mit .*(?= |$)"):
        with pytest.raises(ValueError, match="greatest"):
            licenses.span_of([{**rule, "pattern": pattern}])


def test_rules():
    rules = licenses.rules()
    assert len(rules) > 300
    for r in rules:
        first = re.match(r"\^([a-z0-9\[\]]+)(?= |\(|$)", r["pattern"])[1]
        assert re.fullmatch(first, r["keyword"]) and r["priority"] in licenses.SURE


def test_no_python_in_the_plan(spark, sf_dir, capsys):
    QUERIES["op6_licenses"](spark, sf_dir).explain()
    QUERIES["op4_fingerprints"](spark, sf_dir).explain()
    plan = capsys.readouterr().out
    assert "Scan parquet" in plan and not re.search("Python|Pandas|Arrow", plan)


def test_empty_table(frame):
    assert licenses.scan(frame([], "doc_id int, text string")).count() == 0


def test_all_documents(spark, sf_dir, table):
    rows = {r.doc_id: tuple(r)[1:6] for r in QUERIES["op6_licenses"](spark, sf_dir).collect()}
    assert rows == {k: brute.base_licenses(t) for k, t in table("documents", "doc_id", "text")}

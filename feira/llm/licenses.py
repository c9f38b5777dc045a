"""Licence mentions by ordered signature rules, in DataFrame functions alone.

A rule is a pattern over the words of a text, a label and a priority. Its pattern begins
with a keyword, and only where a text has that word is the pattern tried, on the words that
follow. Of detections that begin at the same word the one of highest priority, then the
longest, stays; one that another contains goes, unless it has the higher priority, and one
that contains another of higher priority goes.

Rules are made from a table of licence names and versions: a name alone, a name with a
version, either of them in a grant ("licensed under ..."), and identifiers as in headers of
source files.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Phrases that are always reported, wherever their words stand one after the other.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# label: names, versions. Names are patterns over lower-cased words.
FAMILIES = {
    "mit": (["mit licen[cs]e", "mit licensed", "mit x11 licen[cs]e", "mit expat licen[cs]e", "expat licen[cs]e"], []),
    "x11": (["x11 licen[cs]e", "x consortium licen[cs]e"], []),
    "apache": (["apache licen[cs]e", "apache software licen[cs]e", "apache public licen[cs]e"], ["1.0", "1.1", "2.0"]),
    "gpl": (["gnu general public licen[cs]e", "general public licen[cs]e", "gnu gpl"], ["1", "2", "3", "1.0", "2.0", "3.0"]),
    "lgpl": (["gnu lesser general public licen[cs]e", "lesser general public licen[cs]e",
              "gnu library general public licen[cs]e", "library general public licen[cs]e", "gnu lgpl"],
             ["2", "2.1", "3", "2.0", "3.0"]),
    "agpl": (["gnu affero general public licen[cs]e", "affero general public licen[cs]e", "gnu agpl"], ["1", "3", "1.0", "3.0"]),
    "gfdl": (["gnu free documentation licen[cs]e", "free documentation licen[cs]e"], ["1.1", "1.2", "1.3"]),
    "bsd": (["bsd licen[cs]e", "bsd style licen[cs]e", "berkeley software distribution licen[cs]e"], []),
    "bsd-0-clause": (["zero clause bsd(?: licen[cs]e)?", "0 clause bsd(?: licen[cs]e)?"], []),
    "bsd-1-clause": (["1 clause bsd(?: licen[cs]e)?", "bsd 1 clause(?: licen[cs]e)?"], []),
    "bsd-2-clause": (["2 clause bsd(?: licen[cs]e)?", "bsd 2 clause(?: licen[cs]e)?", "simplified bsd licen[cs]e", "freebsd licen[cs]e"], []),
    "bsd-3-clause": (["3 clause bsd(?: licen[cs]e)?", "bsd 3 clause(?: licen[cs]e)?", "new bsd licen[cs]e", "modified bsd licen[cs]e", "revised bsd licen[cs]e"], []),
    "bsd-4-clause": (["4 clause bsd(?: licen[cs]e)?", "bsd 4 clause(?: licen[cs]e)?", "original bsd licen[cs]e"], []),
    "mpl": (["mozilla public licen[cs]e"], ["1.0", "1.1", "2.0"]),
    "npl": (["netscape public licen[cs]e"], ["1.0", "1.1"]),
    "epl": (["eclipse public licen[cs]e"], ["1.0", "2.0"]),
    "edl": (["eclipse distribution licen[cs]e"], ["1.0"]),
    "cpl": (["common public licen[cs]e"], ["0.5", "1.0"]),
    "ipl": (["ibm public licen[cs]e"], ["1.0"]),
    "cddl": (["common development and distribution licen[cs]e"], ["1.0", "1.1"]),
    "eupl": (["european union public licen[cs]e", "eupl licen[cs]e"], ["1.0", "1.1", "1.2"]),
    "cecill": (["cecill licen[cs]e", "cecill free software licen[cs]e"], ["1.0", "1.1", "2.0", "2.1"]),
    "artistic": (["artistic licen[cs]e", "perl artistic licen[cs]e"], ["1.0", "2.0"]),
    "osl": (["open software licen[cs]e"], ["1.0", "1.1", "2.0", "2.1", "3.0"]),
    "afl": (["academic free licen[cs]e"], ["1.1", "1.2", "2.0", "2.1", "3.0"]),
    "apsl": (["apple public source licen[cs]e"], ["1.0", "1.1", "1.2", "2.0"]),
    "boost": (["boost software licen[cs]e"], ["1.0"]),
    "isc": (["isc licen[cs]e", "internet systems consortium licen[cs]e"], []),
    "zlib": (["zlib licen[cs]e", "zlib libpng licen[cs]e"], []),
    "libpng": (["libpng licen[cs]e"], ["2.0"]),
    "openssl": (["openssl licen[cs]e"], []),
    "postgresql": (["postgresql licen[cs]e"], []),
    "php": (["php licen[cs]e"], ["3.0", "3.01"]),
    "psf": (["python software foundation licen[cs]e", "python licen[cs]e", "psf licen[cs]e"], ["2", "2.0"]),
    "ruby": (["ruby licen[cs]e"], []),
    "vim": (["vim licen[cs]e"], []),
    "w3c": (["w3c software(?: notice and)? licen[cs]e", "w3c licen[cs]e"], []),
    "ncsa": (["university of illinois ncsa open source licen[cs]e", "ncsa open source licen[cs]e"], []),
    "ofl": (["sil open font licen[cs]e", "open font licen[cs]e"], ["1.0", "1.1"]),
    "upl": (["universal permissive licen[cs]e"], ["1.0"]),
    "unlicense": (["unlicen[cs]e"], []),
    "wtfpl": (["do what the fuck you want to public licen[cs]e", "wtfpl licen[cs]e"], ["1", "2"]),
    "ms-pl": (["microsoft public licen[cs]e"], []),
    "ms-rl": (["microsoft reciprocal licen[cs]e"], []),
    "qpl": (["q public licen[cs]e"], ["1.0"]),
    "sleepycat": (["sleepycat licen[cs]e"], []),
    "lppl": (["latex project public licen[cs]e"], ["1.0", "1.1", "1.2", "1.3"]),
    "busl": (["business source licen[cs]e"], ["1.0", "1.1"]),
    "sspl": (["server side public licen[cs]e"], ["1"]),
    "elastic": (["elastic licen[cs]e"], ["2.0"]),
    "odbl": (["open database licen[cs]e", "open data commons open database licen[cs]e"], ["1.0"]),
    "odc-by": (["open data commons attribution licen[cs]e"], ["1.0"]),
    "mulan": (["mulan permissive software licen[cs]e"], ["1", "2"]),
    "public-domain": (["public domain dedication", "dedicated to the public domain", "released into the public domain"], []),
    "cc0": (["cc0", "creative commons zero", "cc zero"], ["1.0"]),
    "proprietary": (["proprietary licen[cs]e", "end user licen[cs]e agreement", "commercial licen[cs]e"], []),
}
CREATIVE_COMMONS = {"by": "attribution", "nc": "non ?commercial", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s?"}
CREATIVE_COMMONS_KINDS = ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")
CREATIVE_COMMONS_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
GRANTS = ("licen[cs]ed", "released", "distributed", "published", "available")
# How sure a detection by a rule of each priority is.
SURE = {1: 0.6, 2: 0.8, 3: 0.9, 4: 1.0}

RULES_BY_KEYWORD = "map<string, array<struct<pattern: string, label: string, priority: int>>>"


def families() -> dict[str, tuple[list[str], list[str]]]:
    kinds = {}
    for kind in CREATIVE_COMMONS_KINDS:
        parts = kind.split("-")
        names = ["cc " + " ".join(parts), "creative commons " + " ".join(CREATIVE_COMMONS[p] for p in parts)]
        kinds[f"cc-{kind}"] = (names, CREATIVE_COMMONS_VERSIONS)
    return FAMILIES | kinds


def rules() -> list[dict]:
    """keyword, pattern (from the keyword on), label and priority of every rule."""
    out = []

    def add(pattern: str, label: str, priority: int) -> None:
        keyword = re.match(r"[a-z0-9\[\]]+", pattern)[0]
        # A keyword that is itself a pattern stands for each of its spellings.
        for spelling in ("s", "c") if "[cs]" in keyword else ("",):
            word = keyword.replace("[cs]", spelling)
            out.append({"keyword": word, "pattern": f"^{pattern}(?= |$)", "label": label, "priority": priority})

    for label, (names, versions) in families().items():
        either = "(?:" + "|".join(names) + ")"
        for name in names:
            add(name, label, 1)
        for version in versions:
            words = version.replace(".", " ")
            said = rf"(?: licen[cs]e)?,?(?: version| v| ver)? v?{words}"
            for name in names:
                add(name + said, f"{label}-{version}", 2)
            add(rf"spdx licen[cs]e identifier {label.replace('-', ' ')} {words}(?: only| or later)?", f"{label}-{version}", 4)
            add(rf"{GRANTS[0]} under (?:the )?(?:terms of the )?(?:gnu )?{either}{said}", f"{label}-{version}", 3)
        if not versions:
            add(rf"spdx licen[cs]e identifier {label.replace('-', ' ')}", label, 4)
        for grant in GRANTS:
            add(rf"{grant} under (?:the )?(?:terms of the )?(?:gnu )?{either}", label, 2)
    return out


def literal_rules(all_rules: list[dict]) -> Column:
    """A constant: the rules of each keyword."""
    by_keyword: dict[str, list[dict]] = {}
    for rule in all_rules:
        by_keyword.setdefault(rule["keyword"], []).append(rule)
    return F.from_json(F.lit(json.dumps(by_keyword)), RULES_BY_KEYWORD)


def may_mention(text: Column) -> Column:
    """Whether any rule or base phrase can match: all hold one of these."""
    lower = F.lower(text)
    return (
        lower.contains("licen") | lower.contains("domain") | lower.contains("cc")
        & (lower.contains("cc0") | lower.rlike(r"cc[\x00-\x2F\x3A-\x60\x7B-\x7F]+(?:by|zero)"))
        | lower.contains("commons") | lower.contains("clause") | lower.contains("gnu")
    )


def base_places(words: Column) -> Column:
    """(label, place) of each base phrase, by place."""
    def here(i: Column) -> Column:
        found = F.lit(None).cast("string")
        for phrase, label in BASE.items():
            parts = phrase.split(" ")
            same = [F.get(words, i + k) == part for k, part in enumerate(parts)]
            test = same[0]
            for s in same[1:]:
                test = test & s
            found = F.when(test, label).otherwise(found)
        return F.struct(found.alias("label"), i.cast("long").alias("place"))

    # "license" ends every phrase; its places are few.
    return F.filter(F.transform(F.sequence(F.lit(0), F.size(words)), here), lambda p: p["label"].isNotNull())


def span_of(all_rules: list[dict]) -> int:
    """A number of words that no match of a rule exceeds, its keyword included.

    A pattern that repeats no group matches at most as many blanks as it has; one of those is
    in the lookahead that ends every rule.
    """
    repeating = [r["pattern"] for r in all_rules if re.search(r"[{*]|\)\+|[\])] ?\+ ", r["pattern"])]
    if repeating:
        raise ValueError(f"rules without a greatest number of words: {repeating[:3]}")
    return max((r["pattern"].count(" ") for r in all_rules), default=1)


def detections(words: Column, all_rules: list[dict]) -> Column:
    """start, end (words), priority, label: at most one for each word."""
    span = span_of(all_rules)
    keywords = F.array(*[F.lit(k) for k in sorted({r["keyword"] for r in all_rules})])
    table = literal_rules(all_rules)

    def at(word: Column) -> Column:
        seen = F.array_join(F.slice(words, word["at"] + 1, span), " ")
        tried = F.transform(
            F.try_element_at(table, word["word"]),
            lambda r: F.struct(
                r["priority"].alias("priority"),
                F.call_function("regexp_extract", seen, r["pattern"], F.lit(0)).alias("match"), r["label"].alias("label"),
            ),
        )
        sized = F.transform(
            F.filter(tried, lambda m: m["match"] != ""),
            lambda m: F.struct(
                m["priority"].alias("priority"), F.size(F.split(m["match"], " ")).alias("size"),
                m["label"].alias("label"),
            ),
        )
        return F.struct(word["at"].alias("start"), F.array_max(sized).alias("best"))

    hits = F.filter(
        F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
        lambda x: F.array_contains(keywords, x["word"]),
    )
    found = F.filter(F.transform(hits, at), lambda d: d["best"].isNotNull())
    return F.transform(found, lambda d: F.struct(
        d["start"].alias("start"), (d["start"] + d["best"]["size"]).alias("end"),
        d["best"]["priority"].alias("priority"), d["best"]["label"].alias("label"),
    ))


def surviving(found: Column, span: int) -> Column:
    """found without detections that a neighbour suppresses. They are ordered by start, one
    for each, and have at most `span` words, so neighbours are at most that many places off."""
    def keep(d: Column, i: Column) -> Column:
        near = F.slice(found, F.greatest(i - (span - 2), F.lit(1)), 2 * span)
        return ~F.exists(near, lambda o: (o["start"] != d["start"]) & (
            (o["start"] <= d["start"]) & (o["end"] >= d["end"]) & (o["priority"] >= d["priority"])
            | (o["start"] >= d["start"]) & (o["end"] <= d["end"]) & (o["priority"] > d["priority"])
        ))

    return F.filter(found, keep)


def scan(docs: DataFrame, column: str = "text", all_rules: list[dict] | None = None) -> DataFrame:
    """docs with a struct column `licenses`, replacing one of that name: n_words, n_base,
    first_word, last_word, base_labels, labels (both distinct, sorted, comma-joined),
    detections and score.

    A null text is empty: no words, no places, empty labels, score 0. Texts of any length are
    read whole. Rows are independent of each other, repeated ones too; other columns pass
    through. An empty table gives an empty result.
    """
    all_rules = rules() if all_rules is None else all_rules
    text = F.coalesce(F.col(f"`{column}`"), F.lit(""))
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() != "licenses"]
    none = F.array().cast("array<string>")
    # One projection after the other: each value is computed once.
    words = docs.select(*kept, F.struct(
        F.regexp_count(text, F.lit(ANY_CASE_WORD)).cast("long").alias("n_words"),
        F.when(may_mention(text), F.regexp_extract_all(
            F.translate(text, CAPITALS, CAPITALS.lower()), F.lit(WORD), 1
        )).otherwise(none).alias("words"),
    ).alias("licenses"))
    own = F.col("licenses.words")
    places = words.withColumn("licenses", F.struct(
        F.col("licenses.n_words").alias("n_words"),
        F.when(F.size(own) > 0, base_places(own)).otherwise(
            F.array().cast("array<struct<label: string, place: bigint>>")).alias("base"),
        F.when(F.size(own) > 0, detections(own, all_rules)).otherwise(
            F.array().cast("array<struct<start: int, end: int, priority: int, label: string>>")).alias("found"),
    ))
    kept_found = places.withColumn("licenses", F.struct(
        F.col("licenses.n_words").alias("n_words"), F.col("licenses.base").alias("base"),
        surviving(F.col("licenses.found"), span_of(all_rules)).alias("found"),
    ))
    base, found = F.col("licenses.base"), F.col("licenses.found")
    base_labels = F.array_sort(F.array_distinct(base["label"]))
    labels = F.array_sort(F.array_distinct(F.concat(base["label"], found["label"])))
    sure = F.array_max(F.transform(found["priority"], lambda p: F.element_at(
        F.create_map(*[F.lit(x) for pair in SURE.items() for x in pair]), p)))
    return kept_found.withColumn("licenses", F.struct(
        F.col("licenses.n_words").alias("n_words"), F.size(base).cast("long").alias("n_base"),
        F.array_min(base["place"]).alias("first_word"), F.array_max(base["place"]).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        found.alias("detections"),
        F.greatest(F.coalesce(sure, F.lit(0.0)), F.when(F.size(base) > 0, SURE[1]).otherwise(0.0)).alias("score"),
    ))

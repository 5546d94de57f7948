"""License scan by ordered signature rules, in DataFrame functions only.

Hundreds of regular expressions run over a text's normalised words: sentences of the license texts and their headers, addresses
of licenses, and forms of notice made from license names and versions. A name that is also plain words ("open software")
counts only with the word license beside it; a plus sign after a version reads "or later". They are grouped by the name they all hold: a group runs only where one of the
name's words and then the name itself stands in the normalised words, so most texts run none of them. Detections
have a priority by form; one that lies within another of at least its priority is suppressed. All
of it happens within the row: there is no shuffle.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base phrases and their labels.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

# License families as (label, names that need the word license beside them, names that are the license's own,
# versions, gate words). Names are in normalised words.
FAMILIES = [
    ("gpl", "(?:gnu )?general public", "gnu gpl|gpl", ("1", "2", "3"), "gpl|general"),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public", "gnu lgpl|lgpl", ("2", "2 1", "3"), "lgpl|lesser|library"),
    ("agpl", "(?:gnu )?affero general public", "gnu agpl|agpl", ("1", "3"), "agpl|affero"),
    ("gfdl", "(?:gnu )?free documentation", "gnu fdl|gfdl", ("1 1", "1 2", "1 3"), "gfdl|fdl|documentation"),
    ("apache", "apache software(?: foundation)?", "apache", ("1 0", "1 1", "2"), "apache"),
    ("mpl", "mozilla public", "mpl", ("1 0", "1 1", "2"), "mpl|mozilla"),
    ("epl", "eclipse public", "epl", ("1", "2"), "epl|eclipse"),
    ("edl", "eclipse distribution", "edl", ("1",), "edl|eclipse"),
    ("cddl", "common development and distribution", "cddl", ("1 0", "1 1"), "cddl|common"),
    ("cpl", "common public", "cpl", ("1",), "cpl|common"),
    ("eupl", "european union public", "eupl", ("1 0", "1 1", "1 2"), "eupl|european"),
    ("artistic", "(?:perl )?artistic", "", ("1", "2"), "artistic"),
    ("afl", "academic free", "afl", ("1 1", "1 2", "2 0", "2 1", "3"), "afl|academic"),
    ("osl", "open software", "osl", ("1", "2", "2 1", "3"), "osl|software"),
    ("ofl", "sil open font|open font", "ofl", ("1 0", "1 1"), "ofl|font"),
    ("odc-by", "open data commons attribution", "odc by", ("1",), "odc|commons"),
    ("odbl", "open database", "odbl", ("1",), "odbl|database"),
    ("bsl", "boost software", "bsl", ("1",), "bsl|boost"),
    ("busl", "business source", "busl", ("1 1",), "busl|business"),
    ("sspl", "server side public", "sspl", ("1",), "sspl|server"),
    ("lppl", "latex project public", "lppl", ("1 0", "1 2", "1 3"), "lppl|latex"),
    ("zpl", "zope public", "zpl", ("1 1", "2 0", "2 1"), "zpl|zope"),
    ("php", "php", "", ("3 0", "3 01"), "php"),
    ("psf", "python software foundation|psf", "", ("2",), "psf|python"),
    ("cecill", "", "cecill", ("1", "2", "2 1"), "cecill"),
    ("upl", "universal permissive", "upl", ("1",), "upl|universal"),
    ("mit", "x11", "mit|expat", (), "mit|expat|x11"),
    ("isc", "internet systems consortium", "isc", (), "isc|internet"),
    ("bsd", "berkeley software distribution", "bsd", (), "bsd|berkeley"),
    ("bsd-0-clause", "", "(?:0|zero) clause bsd|0bsd|bsd (?:0|zero) clause", (), "bsd|0bsd"),
    ("bsd-1-clause", "", "(?:1|one) clause bsd|bsd (?:1|one) clause", (), "bsd"),
    ("bsd-2-clause", "", "(?:2|two) clause bsd|bsd (?:2|two) clause|(?:simplified|freebsd) bsd", (), "bsd"),
    ("bsd-3-clause", "", "(?:3|three) clause bsd|bsd (?:3|three) clause|(?:new|modified|revised) bsd", (), "bsd"),
    ("bsd-4-clause", "", "(?:4|four) clause bsd|bsd (?:4|four) clause|original bsd", (), "bsd"),
    ("zlib", "zlib(?: libpng)?", "", (), "zlib"),
    ("unlicense", "", "unlicense", (), "unlicense"),
    ("wtfpl", "do what the fuck you want to public", "wtfpl", (), "wtfpl|fuck"),
    ("ncsa", "university of illinois(?: ncsa)?|ncsa", "", (), "ncsa|illinois"),
    ("postgresql", "postgresql", "", (), "postgresql"),
    ("ms-pl", "microsoft public", "ms pl", (), "ms|microsoft"),
    ("ms-rl", "microsoft reciprocal", "ms rl", (), "ms|microsoft"),
    ("ruby", "ruby", "", (), "ruby"),
    ("vim", "vim", "", (), "vim"),
    ("json", "json", "", (), "json"),
    ("beerware", "beer ?ware", "", (), "beer|beerware"),
    ("openssl", "openssl", "", (), "openssl"),
    ("w3c", "w3c(?: software)?", "", (), "w3c"),
    ("curl", "curl", "", (), "curl"),
    ("ftl", "freetype(?: project)?", "ftl", (), "ftl|freetype"),
    ("blueoak", "blue oak model", "", ("1 0 0",), "blue"),
]
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
CC_PARTS = {"by": "attribution", "nc": "non ?commercial", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s?(?: works)?"}
CC_KINDS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")

# Sentences of license texts as (priority, label, gate words, pattern in normalised words). A sentence that only
# one license holds has priority 4, one that several share, or a beginning of one, a lower priority, so that the fuller
# sentence suppresses it.
TEXTS = [
    (2, "mit", "hereby", "permission is hereby granted free of charge"),
    (3, "mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    (4, "mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
                         "the software to deal in the software without restriction"),
    (3, "mit", "portions", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    (4, "ncsa", "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
                          "the software to deal with the software without restriction"),
    (4, "bsl-1", "hereby", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying "
                           "documentation covered by this license"),
    (4, "upl-1", "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software associated documentation and or data"),
    (2, "isc", "permission", "permission to use copy modify"),
    (4, "isc", "permission", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted "
                             "provided that the above copyright notice and this permission notice appear in all copies"),
    (3, "bsd-0-clause", "permission", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    (4, "hpnd", "permission", "permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose "
                              "(?:and without fee )?is hereby granted(?: without fee)?"),
    (4, "postgresql", "permission", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and "
                                    "without a written agreement is hereby granted"),
    (2, "bsd", "redistribution", "redistribution and use in source and binary forms"),
    (3, "bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    (4, "bsd-2-clause", "redistributions", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
                                           "disclaimer in the documentation and or other materials provided with the distribution this software is provided"),
    (4, "bsd-3-clause", "endorse", "neither the names? of (?:the )?(?:copyright holders?|[a-z]+|[a-z]+ [a-z]+|[a-z]+ [a-z]+ [a-z]+) nor the names of (?:its|the|any|other) "
                                   "contributors may be used to endorse or promote products derived from this software"),
    (4, "bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    (4, "apache-2", "apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    (4, "apache-2", "applicable", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    (4, "apache-2", "apache", "apache license version 2 0 january 2004"),
    (3, "apache-1.1", "apache", "this product includes software developed by the apache software foundation"),
    (3, "gpl", "redistribute", "free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    (3, "lgpl", "redistribute", "free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    (3, "agpl", "redistribute", "free software you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    (4, "gpl-2", "general", "gnu general public license version 2 june 1991"),
    (4, "gpl-3", "general", "gnu general public license version 3 29 june 2007"),
    (4, "lgpl-2.1", "lesser", "gnu lesser general public license version 2 1 february 1999"),
    (4, "lgpl-3", "lesser", "gnu lesser general public license version 3 29 june 2007"),
    (4, "agpl-3", "affero", "gnu affero general public license version 3 19 november 2007"),
    (4, "gfdl-1.3", "documentation", "gnu free documentation license version 1 3 3 november 2008"),
    (4, "mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    (3, "mpl-2", "mpl", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    (4, "mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    (3, "zlib", "liable", "in no event will the authors be held liable for any damages arising from the use of this software"),
    (4, "zlib", "misrepresented", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    (4, "unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    (4, "unlicense", "anyone", "anyone is free to copy modify publish use compile sell or distribute this software"),
    (3, "cc", "redistribute", "you are free to share copy and redistribute the material in any medium or format"),
    (4, "cc0-1.0", "deed", "the person who associated a work with this deed has dedicated the work to the public domain"),
    (4, "cc0-1.0", "affirmer", "affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    (4, "wtfpl", "fuck", "you just do what the fuck you want to"),
    (4, "beerware", "beer", "you think this stuff is worth it you can buy me a beer in return"),
    (4, "artistic-1", "package", "the intent of this document is to state the conditions under which a package may be copied"),
    (4, "epl", "eclipse", "the accompanying program is provided under the terms of this eclipse public license"),
    (3, "cddl", "common", "the contents of this file are subject to the terms of the common development and distribution license"),
    (4, "ofl-1.1", "font", "this font software is licensed under the sil open font license version 1 1"),
    (4, "json", "evil", "the software shall be used for good not evil"),
    (4, "psf-2", "psf", "psf is making python available to licensee on an as is basis"),
    (4, "openssl", "openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    (4, "lppl", "latex", "this work may be distributed and or modified under the conditions of the latex project public license"),
    (4, "busl-1.1", "licensor", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    (4, "sspl-1", "functionality", "if you make the functionality of the program or a modified version available to third parties as a service"),
    (4, "ruby", "verbatim", "you may make and give away verbatim copies of the source form of the software without restriction"),
    (4, "ftl", "freetype", "portions of this software are copyright (?:the years )?(?:[0-9]+ )?the freetype project"),
    (4, "blueoak-1.0.0", "contributors", "this license gives everyone as much permission to work with this software as possible while protecting contributors from liability"),
]
# Addresses of licenses as (label, gate word, pattern in normalised words).
ADDRESSES = [
    ("apache-2", "apache", "apache org licenses license 2 0"), ("mit", "opensource", "opensource org licenses? mit"),
    ("isc", "opensource", "opensource org licenses? isc"), ("bsd-2-clause", "opensource", "opensource org licenses? bsd 2 clause"),
    ("bsd-3-clause", "opensource", "opensource org licenses? bsd 3 clause"), ("apache-2", "opensource", "opensource org licenses? apache 2 0"),
    ("zlib", "opensource", "opensource org licenses? zlib"), ("mpl-2", "mozilla", "mozilla org (?:en us )?mpl 2 0"),
    ("mpl-1.1", "mozilla", "mozilla org mpl mpl 1 1"), ("bsl-1", "boost", "boost org license 1 0(?: txt)?"), ("unlicense", "unlicense", "unlicense org"),
    ("epl-2", "eclipse", "eclipse org legal epl 2 0"), ("epl-1", "eclipse", "eclipse org legal epl v10"),
    ("cc0-1.0", "creativecommons", "creativecommons org publicdomain zero 1 0"), ("ofl-1.1", "sil", "scripts sil org ofl"),
    ("wtfpl", "wtfpl", "www wtfpl net"),
    *[(f"{k}-{v.replace(' ', '.')}", "gnu", f"gnu org licenses (?:old licenses )?{k} {v}(?: 0)?(?: html| txt)?")
      for k, v in [("gpl", "2"), ("gpl", "3"), ("lgpl", "2 1"), ("lgpl", "3"), ("agpl", "3"), ("gfdl", "1 3")]],
]
#: What the phrase "license" may look like.
LICENSE = "licen[sc]e"
GRANT = "(?:licen[sc]ed|released|distributed|available|published|provided|offered|covered|use|used|made available|redistributed)"

#: Confidence of each priority, for the score.
CONFIDENCE = {4: 1.0, 3: 0.95, 2: 0.8, 1: 0.5}


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    gates: tuple[str, ...]  # one of these words must be there
    name: str  # a pattern of whole words that every match holds
    pattern: str


def rules() -> list[Rule]:
    """All rules, in order of priority, then label, then pattern."""
    out: set[Rule] = set()

    def add(priority, label, gates, name, pattern):
        out.add(Rule(priority, label, tuple(gates.split("|")), f"(?<= )(?:{name})(?= )", f"(?<= )(?:{pattern})(?= )"))

    def forms(label, long, own, gates, version=None):
        every = "|".join(x for x in (long, own) if x)
        tail, versions = "", ""
        if version is not None:
            # "2 0" and "2" name the same version, and so do "v2" and "version 2"
            number = version if " " in version and not version.endswith(" 0") else version.removesuffix(" 0") + "(?: 0)?"
            number = f"(?:v |version |v)?{number}"
            tail, versions = f"(?: version)? {number}", f" {number}"
        # names that are also plain words count only with the word license beside them
        for name, word in ((long, f" {LICENSE}"), (own, f"(?: {LICENSE})?")):
            if not name:
                continue
            add(3, label, gates, name, f"{GRANT} under (?:the )?(?:terms of )?(?:the )?(?:{name}){word}{tail}")
            if version is not None:
                add(3, f"{label}-or-later", gates, name, f"(?:{name}){word}(?: as published by the free software foundation)?(?: either)?{tail} "
                                                         "(?:of the license )?or (?:at your option )?(?:any )?later(?: version)?")
        add(4, label, gates, every, f"spdx {LICENSE} identifier (?:{every}){versions}(?: only)?")
        if version is None:
            add(2, label, gates, every, f"(?:the )?(?:{every}) (?:public )?{LICENSE}")
            return
        add(4, f"{label}-or-later", gates, every, f"spdx {LICENSE} identifier (?:{every}){versions} or later")
        add(2, label, gates, every, f"(?:the )?(?:{every})(?: public)? {LICENSE}(?: version)? (?:v)?{number}")
        # the bare name and number; glued to each other below. A further number would be another version
        bare = "" if label.startswith("apache") else own
        if bare:
            add(1, label, gates, bare, f"(?:{bare}){versions}(?! [0-9])")
        for short in own.split("|"):
            if short and " " not in short:
                first, *rest = version.removesuffix(" 0").split(" ")
                glued = [f"{short}v{first}", f"{short}{first}"]
                more = "".join(f" {x}" for x in rest) or "(?: 0)?"
                name = "|".join(glued)
                add(2, label, name, name, f"(?:{name}){more}(?: only| {LICENSE})?")
                add(3, f"{label}-or-later", name, name, f"(?:{name}){more}(?: {LICENSE})? or (?:at your option )?(?:any )?later(?: version)?")

    for label, long, own, versions, gates in FAMILIES:
        forms(label, long, own, gates)
        for v in versions:
            forms(f"{label}-{v.replace(' ', '.')}", long, own, gates, v)
    for priority, label, gate, pattern in TEXTS:
        add(priority, label, gate, pattern, pattern)
    for label, gate, pattern in ADDRESSES:
        add(3, label, gate, pattern, pattern)
    for kind in CC_KINDS:
        short = "cc " + kind.replace("-", " ")
        long = "creative commons " + " ".join(CC_PARTS[p] for p in kind.split("-"))
        for gate, name in (("cc", short), ("creative", long)):
            add(2, f"cc-{kind}", gate, name, name)
            add(3, f"cc-{kind}", gate, name, f"{GRANT} under (?:an? |the )?(?:terms of )?(?:the )?{name}(?: {LICENSE})?")
            if gate == "cc":
                address = f"creativecommons org licenses {kind.replace('-', ' ')}"
                add(3, f"cc-{kind}", "creativecommons", address, address)
            for v in CC_VERSIONS:
                if gate == "cc":
                    add(4, f"cc-{kind}-{v.replace(' ', '.')}", "creativecommons", address, f"{address} {v}")
                add(3, f"cc-{kind}-{v.replace(' ', '.')}", gate, name, f"{name}(?: international| unported| generic)? {v}")
                add(4, f"cc-{kind}-{v.replace(' ', '.')}", gate, name, f"{GRANT} under (?:an? |the )?{name}(?: international)? {v}(?: {LICENSE})?")
    add(3, "cc0-1.0", "cc0", "cc0", "cc0(?: 1 0)?(?: universal)?")
    add(3, "cc0-1.0", "creative", "creative commons zero", "creative commons zero(?: v1 0| 1 0)?")
    add(2, "public-domain", "public", "the public domain", "(?:released|placed|dedicated|is) (?:in|into|to) the public domain")
    add(1, "proprietary", "reserved", "all rights reserved", "all rights reserved")
    add(3, "proprietary", "proprietary", "proprietary", f"proprietary {LICENSE}|proprietary and confidential")
    return sorted(out, key=lambda r: (-r.priority, r.label, r.pattern))


WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A plus sign right after a version number.
OR_LATER = r"(?<=[0-9])\+(?![0-9A-Za-z+])"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once: within a lambda a plain column is worked out for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _constant(value, schema: str) -> Column:
    """A literal of nested type; the optimizer folds it once."""
    return F.from_json(F.lit(json.dumps(value)), schema)


DETECTIONS = "array<struct<s:int,back:int,rank:int,label:string>>"


def _matches(normal: Column, rule: Column) -> Column:
    """Detections of one rule, in characters of the normalised text; ends and priorities are negated for sorting."""
    none = F.array().cast(DETECTIONS)

    def chunks(steps):
        """About √n chunks of √n hits: sums over chunks, then within each, so that work stays far below n² appends."""
        size = F.ceil(F.sqrt(F.size(steps))).cast("int")
        return _let(size, lambda c: F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / c).cast("int")), lambda k: F.slice(steps, k * c + 1, c)))

    def starts(cut):
        """Where each chunk starts in the text."""
        def step(acc, chunk):
            length = F.aggregate(chunk, F.lit(0), lambda n, x: n + x["gap"] + x["hit"])
            return F.struct((acc["at"] + length).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

        return F.aggregate(cut, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), step, lambda acc: acc["out"])

    def within(chunk, at):
        def step(acc, x):
            s = acc["at"] + x["gap"]
            e = s + x["hit"]
            one = F.array(F.struct(s.alias("s"), (-e).alias("back"), (-rule["p"]).alias("rank"), rule["label"].alias("label")))
            return F.struct(e.alias("at"), F.concat(acc["out"], one).alias("out"))

        return F.aggregate(chunk, F.struct(at.alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    def placed(found):
        between = F.slice(F.split(normal, rule["pattern"], -1), 1, F.size(found))
        steps = F.transform(F.arrays_zip(between.alias("gap"), found.alias("hit")),
                            lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit")))
        whole = _let(steps, lambda t: _let(chunks(t), lambda cut: F.flatten(F.zip_with(cut, starts(cut), within))))
        return F.when(F.size(found) == 0, none).otherwise(whole)

    return _let(F.regexp_extract_all(normal, rule["pattern"], F.lit(0)), placed)


def _groups() -> list[dict]:
    """The rules by name, each name with its gate words."""
    out: dict[tuple, list] = {}
    for r in rules():
        out.setdefault((r.gates, r.name), []).append({"p": r.priority, "label": r.label, "pattern": r.pattern})
    return [{"gates": gates, "name": name, "rules": group} for (gates, name), group in out.items()]


def _sorted_detections(words: Column, normal: Column) -> Column:
    """All detections of a text: those that start first, reach furthest, rank highest, come first."""
    table = _groups()
    every = _constant(table, "array<struct<gates:array<string>,name:string,rules:array<struct<p:int,label:string,pattern:string>>>>")
    gates = _constant(sorted({g for group in table for g in group["gates"]}), "array<string>")

    def run(present):
        open_groups = F.filter(every, lambda g: F.arrays_overlap(g["gates"], present) & F.rlike(normal, g["name"]))
        return F.flatten(F.transform(F.flatten(F.transform(open_groups, lambda g: g["rules"])), lambda r: _matches(normal, r)))

    # equal detections suppress one another: no need to compare all with all for distinct ones
    return F.array_sort(_let(F.array_intersect(gates, words), run))


def _kept(detections: Column) -> Column:
    """(labels, best) after suppression: a detection goes if an earlier one of at least its priority reaches as far."""
    start = F.struct(*[F.lit(-1).alias(f"m{p}") for p in range(1, 5)], F.array().cast("array<string>").alias("labels"), F.lit(0).alias("best"),
                     F.lit(0).cast("long").alias("n"))

    def step(acc, d):
        p, e = -d["rank"], -d["back"]
        reach = F.element_at(F.array(*[acc[f"m{k}"] for k in range(1, 5)]), p)
        keep = reach < e
        # m_k: how far detections of priority k or more reach
        return F.struct(*[F.when(keep & (p >= k), F.greatest(acc[f"m{k}"], e)).otherwise(acc[f"m{k}"]).alias(f"m{k}") for k in range(1, 5)],
                        F.when(keep, F.array_union(acc["labels"], F.array(d["label"]))).otherwise(acc["labels"]).alias("labels"),
                        F.when(keep, F.greatest(acc["best"], p)).otherwise(acc["best"]).alias("best"),
                        (acc["n"] + keep.cast("long")).alias("n"))

    return F.aggregate(detections, start, step)


def _places(words: Column, phrase: str) -> Column:
    """Word indexes (from 0) where the phrase's words stand consecutively."""
    parts = phrase.split(" ")

    def find(w):
        def here(i):
            return reduce(lambda a, b: a & b, [F.get(w, i + k) == part for k, part in enumerate(parts)])

        return F.when(F.size(w) >= len(parts), F.filter(F.sequence(F.lit(0), F.size(w) - len(parts)), here)).otherwise(
            F.array().cast("array<int>"))

    return _let(words, find)


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_detections) of each row's whole text.

    ``n_base`` counts all places of base phrases; labels are distinct, sorted and comma-joined, and base
    labels are always among them. ``score`` is the confidence of the best kept detection, 1 for a base phrase, else 0.
    Null and empty texts have no words and no labels. Repeated rows give repeated rows; other columns are ignored.
    """
    lower = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    words = lambda text: F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    # base phrases are looked for in the words as they stand, rules also know the plus sign of "gplv2+"
    plus = F.contains(lower, F.lit("+")) & F.rlike(lower, F.lit(OR_LATER))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words(lower).alias("words"),
                       F.when(plus, words(F.regexp_replace(lower, OR_LATER, " or later "))).alias("plus"))
    # white space around the normalised text lets patterns ask for whole words
    spaced = lambda w: F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))
    rows = rows.select("doc_id", "words", spaced("words").alias("normal"), F.coalesce("plus", "words").alias("read"))
    kept = _let(F.struct("read", spaced("read").alias("normal")), lambda t: _kept(_sorted_detections(t["read"], t["normal"])))
    found = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), kept.alias("kept"),
                        *[F.when(F.contains("normal", F.lit(f" {p} ")), _places(F.col("words"), p)).alias(f"b{k}") for k, p in enumerate(BASE_PHRASES)])
    none = F.array().cast("array<int>")
    places = F.concat(*[F.coalesce(F.col(f"b{k}"), none) for k in range(len(BASE_PHRASES))])
    base = F.filter(F.array(*[F.when(F.size(F.coalesce(F.col(f"b{k}"), none)) > 0, label) for k, label in enumerate(BASE_PHRASES.values())]),
                    lambda x: x.isNotNull())
    sure = reduce(lambda c, p: c.when(F.col("kept.best") == p, CONFIDENCE[p]), CONFIDENCE, F.when(F.size(base) > 0, 1.0))
    return found.select(
        "doc_id", "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"), F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.col("kept.labels"))), ",").alias("labels"),
        sure.otherwise(0.0).alias("score"), F.col("kept.n").alias("n_detections"))

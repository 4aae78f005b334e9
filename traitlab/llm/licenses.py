"""License scans: ordered signature rules over normalized words.

A text becomes its lower-cased words with single spaces between. Rules are
regular expressions over that form, each behind a keyword that every match of
it holds: only rules whose keyword occurs are tried, and only those that match
are located. Detections are word intervals. Where they overlap, priority
decides: a class of rules takes its places first, and what shares a word with
them is dropped from the classes after it. Within a class, one that lies inside
another is suppressed (of equal ones the first label stands); those that only
cross both stand.

Defined results: null and empty texts have no words and no detections;
repeated rows are scanned one by one; an empty table gives an empty result;
input columns are carried, those named like results are replaced. Texts of any
length are scanned whole: every step is linear or n log n in their length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower

# Everything below U+0080 that is no digit and no lower-case letter.
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Rule classes in priority order: (priority, score of a detection).
TAG, GRANT, VERSIONED, NOTICE, NAME = PRIORITIES = (0, 1.0), (1, 0.95), (2, 0.85), (3, 0.8), (4, 0.7)

# label, keyword (part of every match, with the spaces around it), name (over
# normalized words), versions that may follow
FAMILIES = (
    ("mit", " mit ", "mit(?: style)?", ""),
    ("mit", " expat ", "expat(?: style)?", ""),
    ("mit", " x11 ", "x11(?: style)?", ""),
    ("mit-0", " mit ", "mit (?:no attribution|0)", ""),
    ("apache-2.0", "apache", "apache(?: software)?(?: foundation)?(?: license)?(?: version)? 2(?: 0)?", ""),
    ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version)? 1 1", ""),
    ("apache", "apache", "apache(?: software)?", ""),
    ("gpl-3.0", "general public", "(?:gnu )?general public license (?:version |v )?3(?: 0)?", ""),
    ("gpl-2.0", "general public", "(?:gnu )?general public license (?:version |v )?2(?: 0)?", ""),
    ("gpl-1.0", "general public", "(?:gnu )?general public license (?:version |v )?1(?: 0)?", ""),
    ("gpl-3.0", "gpl", "(?:gnu )?gpl(?:v| v| version)? ?3(?: 0)?", ""),
    ("gpl-2.0", "gpl", "(?:gnu )?gpl(?:v| v| version)? ?2(?: 0)?", ""),
    ("gpl", "gpl", "gnu gpl", ""),
    ("gpl", "general public", "(?:gnu )?general public", ""),
    ("lgpl-2.1", "lesser general", "(?:gnu )?lesser general public license (?:version |v )?2 1", ""),
    ("lgpl-3.0", "lesser general", "(?:gnu )?lesser general public license (?:version |v )?3(?: 0)?", ""),
    ("lgpl", "lesser general", "(?:gnu )?lesser general public", ""),
    ("lgpl-2.0", "library general", "(?:gnu )?library general public", "2(?: 0)?"),
    ("lgpl-2.1", "lgpl", "lgpl(?:v| v| version)? ?2 1", ""),
    ("lgpl-3.0", "lgpl", "lgpl(?:v| v| version)? ?3(?: 0)?", ""),
    ("agpl-3.0", "affero", "(?:gnu )?affero general public license(?: version| v)? 3(?: 0)?", ""),
    ("agpl-1.0", "affero", "affero general public license(?: version| v)? 1(?: 0)?", ""),
    ("agpl", "affero", "(?:gnu )?affero general public", ""),
    ("agpl-3.0", "agpl", "agpl(?:v| v| version)? ?3(?: 0)?", ""),
    ("gfdl-1.3", "free documentation", "(?:gnu )?free documentation license(?: version)? 1 3", ""),
    ("gfdl-1.2", "free documentation", "(?:gnu )?free documentation license(?: version)? 1 2", ""),
    ("gfdl", "free documentation", "(?:gnu )?free documentation", ""),
    ("bsd-0-clause", "bsd", "(?:zero clause|0 clause) bsd", ""),
    ("bsd-1-clause", "bsd", "(?:one clause|1 clause) bsd", ""),
    ("bsd-2-clause", "bsd", "(?:two clause|2 clause|simplified|freebsd) bsd", ""),
    ("bsd-2-clause", "bsd", "bsd (?:two clause|2 clause)", ""),
    ("bsd-3-clause", "bsd", "(?:three clause|3 clause|new|revised|modified) bsd", ""),
    ("bsd-3-clause", "bsd", "bsd (?:three clause|3 clause)", ""),
    ("bsd-4-clause", "bsd", "(?:four clause|4 clause|original) bsd", ""),
    ("bsd", "bsd", "bsd(?: style)?", ""),
    ("isc", " isc ", "isc", ""),
    ("mpl-2.0", "mozilla", "mozilla public license(?: version| v)? 2(?: 0)?", ""),
    ("mpl-1.1", "mozilla", "mozilla public license(?: version| v)? 1 1", ""),
    ("mpl", "mozilla", "mozilla public", ""),
    ("epl-2.0", "eclipse", "eclipse public license(?: version| v)? 2(?: 0)?", ""),
    ("epl-1.0", "eclipse", "eclipse public license(?: version| v)? 1(?: 0)?", ""),
    ("epl", "eclipse", "eclipse public", ""),
    ("eupl-1.2", "european union", "european union public licen[cs]e(?: version| v)? 1 2", ""),
    ("eupl", "european union", "european union public", ""),
    ("cddl-1.0", "common development", "common development and distribution license(?: version)? 1 0", ""),
    ("cddl", "common development", "common development and distribution", ""),
    ("cpl-1.0", "common public", "common public", "1 0"),
    ("cecill", "cecill", "cecill(?: [abc])?", "[12](?: [01])?"),
    ("artistic-2.0", "artistic", "artistic license(?: version)? 2(?: 0)?", ""),
    ("artistic-1.0", "artistic", "artistic license(?: version)? 1(?: 0)?", ""),
    ("artistic", "artistic", "artistic", ""),
    ("zlib", "zlib", "zlib(?: libpng)?", ""),
    ("boost-1.0", "boost software", "boost software", "1 0"),
    ("unlicense", "unlicense", "(?:the )?unlicense", ""),
    ("wtfpl", "do what the", "do what the fuck you want to public", "2"),
    ("postgresql", "postgresql", "postgresql", ""),
    ("python-2.0", "python software", "python software foundation", "2"),
    ("php-3.01", " php ", "php license(?: version)? 3(?: 01)?", ""),
    ("ruby", " ruby ", "ruby", ""),
    ("openssl", "openssl", "openssl", ""),
    ("ofl-1.1", "open font", "(?:sil )?open font", "1 1"),
    ("odbl-1.0", "open database", "open database", "1 0"),
    ("odc-by-1.0", "open data commons", "open data commons attribution", "1 0"),
    ("pddl-1.0", "open data commons", "open data commons public domain dedication", "1 0"),
    ("osl-3.0", "open software", "open software", "[123] 0"),
    ("afl-3.0", "academic free", "academic free", "[123] [012]"),
    ("ms-pl", "microsoft public", "microsoft public", ""),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal", ""),
    ("upl-1.0", "universal permissive", "universal permissive", "1 0"),
    ("ecl-2.0", "educational community", "educational community", "[12] 0"),
    ("bsl-1.1", "business source", "business source", "1 1"),
    ("sspl-1.0", "server side public", "server side public", "1"),
    ("openrail", "openrail", "(?:creativeml |bigscience )?openrail(?: m)?", ""),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?", ""),
    ("cc-by-nc-nd", "noncommercial", "(?:creative commons )?attribution noncommercial no ?deriv(?:ative)?s", "[1234] [05]"),
    ("cc-by-nc-sa", "noncommercial", "(?:creative commons )?attribution noncommercial share ?alike", "[1234] [05]"),
    ("cc-by-nc", "noncommercial", "(?:creative commons )?attribution noncommercial", "[1234] [05]"),
    ("cc-by-nd", "attribution no", "(?:creative commons )?attribution no ?deriv(?:ative)?s", "[1234] [05]"),
    ("cc-by-sa", "attribution share", "(?:creative commons )?attribution share ?alike", "[1234] [05]"),
    ("cc-by", "creative commons", "creative commons attribution", "[1234] [05]"),
    ("cc", "creative commons", "creative commons", "[1234] [05]"),
    ("cc-by-nc-nd", "cc by", "cc by nc nd", "[1234] [05]"),
    ("cc-by-nc-sa", "cc by", "cc by nc sa", "[1234] [05]"),
    ("cc-by-nc", "cc by", "cc by nc", "[1234] [05]"),
    ("cc-by-nd", "cc by", "cc by nd", "[1234] [05]"),
    ("cc-by-sa", "cc by", "cc by sa", "[1234] [05]"),
    ("cc-by", "cc by", "cc by", "[1234] [05]"),
)

# Wording of the licenses and of notices: label, keyword, pattern.
NOTICES = (
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "without restriction", "to deal in the software without restriction including without limitation the rights"),
    ("isc", "permission to use", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "neither the name", "neither the name of (?:[^ ]+ ){1,12}may be used to endorse or promote products"),
    ("bsd-4-clause", "all advertising materials", "all advertising materials mentioning features or use of this software"),
    ("apache-2.0", "you may not use", "you may not use this file except in compliance with the license"),
    ("gpl", "you can redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "you can redistribute", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "you can redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl", "copyleft", "copyleft license"),
    ("mpl-2.0", "source code form", "this source code form is subject to the terms of the mozilla public license"),
    ("epl", "accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("boost-1.0", "boost", "distributed under the boost software license version 1 0"),
    ("zlib", "altered source", "altered source versions must be plainly marked as such"),
    ("wtfpl", "do what", "you just do what the fuck you want to"),
    ("unlicense", "public domain", "this is free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", "(?:released|dedicated|placed) (?:in|into|to) the public domain"),
    ("public-domain", "public domain", "(?:is|are) in the public domain"),
    ("cc0-1.0", "public domain", "cc0 (?:1 0 )?(?:universal )?public domain dedication"),
    ("cc", "some rights", "some rights reserved"),
    ("proprietary", "all rights", "all rights reserved"),
    ("proprietary", "proprietary", "proprietary and confidential"),
    ("proprietary", "reproduced", "(?:may not be|no part of this) (?:[^ ]+ ){0,8}reproduced (?:[^ ]+ ){0,8}without (?:the )?(?:prior )?(?:written )?permission"),
)

_LICENSE = " licen[cs]e"
_GRANTED = "(?:licensed|released|distributed|available|provided|covered|published)"


def build_rules() -> list[tuple[int, float, str, str, str]]:
    """(priority, score, label, keyword, pattern) of every rule, in order.

    Each family gives a tag, a grant, a versioned-name and a name rule; a bare
    name counts only together with the word license unless it is a code.
    """
    rules = []
    for label, keyword, name, versions in FAMILIES:
        version = f"(?:(?: version| v)? (?:{versions}))" if versions else ""
        licensed = name if "license" in name or name.startswith(("cc ", "cc0")) else f"{name}{_LICENSE}s?"
        plain = f"{name}(?:{_LICENSE}s?)?"
        tail = f"{version}?" if version else ""
        rules.append((*TAG, label, keyword, f"spdx license identifier {plain}{tail}"))
        rules.append((*GRANT, label, keyword,
                      f"{_GRANTED} (?:in )?under (?:the )?(?:terms of )?(?:the )?{plain}{tail}(?: only| or later)?"))
        if version:
            rules.append((*VERSIONED, label, keyword, f"{plain}{version}"))
        rules.append((*NAME, label, keyword, licensed))
    rules += [(*NOTICE, label, keyword, pattern) for label, keyword, pattern in NOTICES]
    return sorted(rules, key=lambda r: r[0])


def normalized(text: Column) -> Column:
    """Lower-cased words with one space between."""
    return F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, " "))


def _spans(norm: Column, pattern: Column) -> Column:
    """Word intervals [start, end] of the matches of ``pattern`` in ``norm``.

    Matches are bracketed with two control characters (which no word has), so
    the first and last word of each show in the split text.
    """
    words = F.split(F.trim(F.regexp_replace(norm, pattern, F.lit("\x01$1\x02"))), " ")
    starts = F.array_compact(F.transform(words, lambda w, i: F.when(w.startswith("\x01"), i)))
    ends = F.array_compact(F.transform(words, lambda w, i: F.when(w.endswith("\x02"), i)))
    return F.arrays_zip(starts.alias("start"), ends.alias("end"))


def _whole(pattern: str) -> str:
    return f"(?<= )({pattern})(?= )"


_DETECTION = "struct<start:int,down:int,priority:int,label:string,score:double,end:int>"


def _swept(items: Column, edge: int, kept, moved, value=lambda x: x) -> Column:
    """The ``value`` of items for which ``kept(edge, item)`` holds, in one scan
    that moves the edge on with ``moved(edge, item)``.

    Kept ones are collected in runs of a thousand, so that a text with very
    many detections does not copy a growing list at every step.
    """
    empty = F.expr(f"cast(array() as array<{_DETECTION}>)")
    none = F.expr(f"cast(array() as array<array<{_DETECTION}>>)")
    start = F.struct(F.lit(edge).alias("edge"), empty.alias("run"), none.alias("runs"))

    def step(state: Column, x: Column) -> Column:
        run = F.when(kept(state["edge"], x), F.concat(state["run"], F.array(value(x)))).otherwise(state["run"])
        full = F.size(run) >= 1000
        return F.struct(moved(state["edge"], x).alias("edge"),
                        F.when(full, empty).otherwise(run).alias("run"),
                        F.when(full, F.concat(state["runs"], F.array(run)))
                        .otherwise(state["runs"]).alias("runs"))

    return F.aggregate(items, start, step, lambda s: F.flatten(F.concat(s["runs"], F.array(s["run"]))))


def _outermost(detections: Column) -> Column:
    """Detections that lie in no other, equal ones once."""
    return _swept(F.sort_array(detections), -1, lambda top, x: x["end"] > top,
                  lambda top, x: F.greatest(top, x["end"]))


def _clear(detections: Column, taken: Column) -> Column:
    """Detections that share no word with one of ``taken``: none that begins
    before reaches into them, and none begins in them."""
    def both(own: Column, place) -> Column:
        tagged = lambda of, mine: F.transform(of, lambda x: F.struct(
            place(x).alias("place"), F.lit(mine).alias("mine"), x.alias("x")))
        return F.sort_array(F.concat(tagged(taken, 0), tagged(own, 1)))

    mine = lambda x: x["mine"] == 1
    ahead = _swept(both(detections, lambda x: x["start"]), -1,
                   lambda top, t: mine(t) & (t["x"]["start"] > top),
                   lambda top, t: F.when(mine(t), top).otherwise(F.greatest(top, t["x"]["end"])), lambda t: t["x"])
    return _swept(both(ahead, lambda x: -x["start"]), 2 ** 31 - 1,
                  lambda low, t: mine(t) & (t["x"]["end"] < low),
                  lambda low, t: F.when(mine(t), low).otherwise(F.least(low, t["x"]["start"])), lambda t: t["x"])


def _resolved(df: DataFrame, found: str, out: str) -> DataFrame:
    """``df`` with the detections of ``found`` that stand, as ``out``: a class
    of rules takes its places before the next one, which gets only what shares
    no word with them; within a class, one that lies in another gives way."""
    none = F.expr(f"cast(array() as array<{_DETECTION}>)")
    some = F.size(found) > 0
    df = df.withColumn(out, none)
    for priority in range(len(PRIORITIES)):
        own = _outermost(F.filter(found, lambda x: x["priority"] == priority))  # noqa: B023
        df = df.withColumn("_own", F.when(some, own)).withColumn(
            out, F.when(F.size("_own") > 0, F.concat(out, _clear(F.col("_own"), F.col(out)))).otherwise(F.col(out)))
    return df.withColumn(out, F.when(some, F.sort_array(out))).drop("_own")


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``base`` (word places and labels of the base
    phrases), ``detections`` (intervals with label, priority and score that
    stand), ``base_labels``, ``labels`` and ``score``."""
    rules = build_rules()
    keywords = sorted({r[3] for r in rules})
    table = F.array(*[F.struct(
        F.lit(p).alias("priority"), F.lit(s).alias("score"), F.lit(label).alias("label"),
        F.lit(k).alias("keyword"), F.lit(_whole(x)).alias("pattern")) for p, s, label, k, x in rules])
    norm = F.col("_norm")
    docs = docs.drop("n_words", "base", "detections", "base_labels", "labels", "score", "_norm", "_own")
    one = docs.withColumn("_core", normalized(F.col(text)))
    one = one.withColumns({
        "_norm": F.concat(F.lit(" "), F.col("_core"), F.lit(" ")),
        "n_words": F.when(F.col("_core") == "", F.lit(0)).otherwise(
            F.length("_core") - F.length(F.translate("_core", " ", "")) + 1).cast("long")}).drop("_core")

    def base_places(phrase: str, label: str) -> Column:
        found = F.transform(_spans(norm, F.lit(_whole(phrase))), lambda x: F.struct(
            x["start"].cast("long").alias("start"), F.lit(label).alias("label")))
        return F.when(norm.contains(f" {phrase} "), found).otherwise(
            F.expr("cast(array() as array<struct<start:bigint,label:string>>)"))

    present = F.filter(F.array(*map(F.lit, keywords)), lambda k: norm.contains(k))
    tried = F.filter(table, lambda r: F.array_contains(F.col("_present"), r["keyword"]))
    matching = F.filter(tried, lambda r: F.rlike(norm, r["pattern"]))
    found = F.flatten(F.transform(matching, lambda r: F.transform(
        _spans(norm, r["pattern"]), lambda s: F.struct(
            s["start"].alias("start"), (-s["end"]).alias("down"), r["priority"].alias("priority"),
            r["label"].alias("label"), r["score"].alias("score"), s["end"].alias("end")))))
    two = one.withColumns({
        "base": F.concat(*[base_places(p, x) for p, x in BASE]),
        "_present": present})
    three = two.withColumn("_found", F.when(F.size("_present") > 0, found))
    four = _resolved(three, "_found", "detections")
    own = F.coalesce(F.transform("detections", lambda d: d["label"]), F.array().cast("array<string>"))
    base_labels = F.array_distinct(F.transform("base", lambda b: b["label"]))
    scores = F.concat(
        F.coalesce(F.transform("detections", lambda d: d["score"]), F.array().cast("array<double>")),
        F.when(F.size("base") > 0, F.array(F.lit(NAME[1]))).otherwise(F.array().cast("array<double>")))
    return four.withColumns({
        "base_labels": F.concat_ws(",", F.sort_array(base_labels)),
        "labels": F.concat_ws(",", F.sort_array(F.array_union(base_labels, own))),
        "score": F.coalesce(F.array_max(scores), F.lit(0.0)),
    }).drop("_norm", "_present", "_found")

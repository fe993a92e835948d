"""Operator 5, licenses: ordered signature rules on Spark's own functions.

A text is brought to its plain form: A-Z in lower case, words of letters and digits
with one space around each. Rules are regular expressions over that form. There are
some hundreds: license names in phrasings, and some 170 written each for itself, which are
identifiers, sentences of license texts, notices and exceptions. Each has keywords, of which every match holds one as a word, and is tried only on texts that do.
A phrasing sets the priority of a rule. A detection that lies within another of higher
priority, or of the same but longer, or first in the order of rules, is suppressed. The three base phrases are rules too, of the highest priority; their
labels stay whatever lies around them.

All of it is a projection: one pass, no shuffle, no Python. The time a text takes grows
with its length and the rules whose keywords it holds.

Defined results: a null text is an empty one, without words and labels; empty label
lists are empty strings; ``score`` is the largest weight of the detections that stay, 0
without any; a null ``doc_id`` stays null; repeated rows are scanned each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm.common import table

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FLAG = "\x01"  # in no plain form

#: Fixed by the contract: phrase and label; with a word of the phrase as its keyword.
BASE = (
    ("under the mit license", "mit", "mit"),
    ("apache license version 2", "apache-2", "apache"),
    ("cc by nc", "cc-by-nc", "cc"),
)

#: Label, keywords (every match holds one of them as a word), names in plain form.
LICENSES = (
    ("mit", "mit expat", r"(?:mit|expat) licen[cs]e"),
    ("mit", "mit", r"mit style licen[cs]e"),
    ("apache-2", "apache", r"apache (?:software )?licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("apache-2", "apache", r"apache 2(?: 0)?(?: licen[cs]e)?"),
    ("apache-1.1", "apache", r"apache (?:software )?licen[cs]e(?: version| v)? ?1 1"),
    ("apache", "apache", r"apache (?:software )?licen[cs]e"),
    ("gpl-2", "gpl gpl2 gplv gplv2", r"(?:gnu )?gpl(?: version| ?v)? ?2(?: 0)?"),
    ("gpl-2", "general", r"(?:gnu )?general public licen[cs]e(?: version| v)? 2(?: 0)?"),
    ("gpl-3", "gpl gpl3 gplv gplv3", r"(?:gnu )?gpl(?: version| ?v)? ?3(?: 0)?"),
    ("gpl-3", "general", r"(?:gnu )?general public licen[cs]e(?: version| v)? 3(?: 0)?"),
    ("gpl", "general", r"gnu general public licen[cs]e"),
    ("gpl", "gpl", r"gnu gpl"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public licen[cs]e(?: version| v)? 2 1"),
    ("lgpl-3", "lesser", r"(?:gnu )?lesser general public licen[cs]e(?: version| v)? 3(?: 0)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public licen[cs]e"),
    ("lgpl-2.1", "lgpl lgpl2 lgplv lgplv2", r"(?:gnu )?lgpl(?: version| ?v)? ?2 1"),
    ("lgpl-3", "lgpl lgpl3 lgplv lgplv3", r"(?:gnu )?lgpl(?: version| ?v)? ?3(?: 0)?"),
    ("agpl-3", "affero", r"(?:gnu )?affero general public licen[cs]e(?: version| v)? 3(?: 0)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e"),
    ("agpl-3", "agpl agpl3 agplv agplv3", r"(?:gnu )?agpl(?: version| ?v)? ?3(?: 0)?"),
    ("bsd-2", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: licen[cs]e)?"),
    ("bsd-3", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)(?: licen[cs]e)?"),
    ("bsd", "bsd", r"bsd licen[cs]e"),
    ("isc", "isc", r"isc licen[cs]e"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e(?: version| v)? 1 1"),
    ("mpl-2", "mozilla", r"mozilla public licen[cs]e(?: version| v)? 2(?: 0)?"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e"),
    ("epl-1", "eclipse", r"eclipse public licen[cs]e(?: version| v)? 1(?: 0)?"),
    ("epl-2", "eclipse", r"eclipse public licen[cs]e(?: version| v)? 2(?: 0)?"),
    ("cddl-1", "cddl cddl1", r"cddl(?: version| v)? ?1(?: 0)?"),
    ("eupl", "european", r"european union public licen[cs]e"),
    ("artistic-2", "artistic", r"artistic licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e"),
    ("boost-1", "boost", r"boost software licen[cs]e(?: version| v)? ?1(?: 0)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("ofl-1.1", "font", r"(?:sil )?open font licen[cs]e(?: version| v)? ?1 1"),
    ("cc0-1", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [234] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [234] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [234] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [234] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [234] [05])?"),
    ("cc-by", "cc", r"cc by(?: [234] [05])?"),
    ("cc-by-nc-nd", "creative", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s"),
    ("cc-by-nc-sa", "creative", r"creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc", "creative", r"creative commons attribution non ?commercial"),
    ("cc-by-sa", "creative", r"creative commons attribution share ?alike"),
    ("cc-by", "creative", r"creative commons attribution"),
    ("cc", "creative", r"creative commons licen[cs]e"),
)

_CHUNK = 256

#: Priority, weight, phrasing; {} is the name.
PHRASINGS = (
    (8, 1.0, r"spdx licen[cs]e identifier {}"),
    (7, 0.95, r"(?:licen[cs]ed|released|distributed|published|provided|issued) under (?:the )?(?:terms of (?:the )?)?{}"),
    (6, 0.9, r"(?:made )?available under (?:the )?(?:terms of (?:the )?)?{}"),
    (5, 0.85, r"under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{}"),
    (4, 0.8, r"(?:subject to|governed by) (?:the )?(?:terms of (?:the )?)?{}"),
    (3, 0.7, r"(?:see|read) (?:the )?{} for"),
    (2, 0.6, r"licen[cs]e {}"),
    (1, 0.5, r"{}"),
)

#: Label, keywords, identifiers behind the SPDX tag that are no name above.
SPDX = (
    ("mit", "mit", r"mit"),
    ("isc", "isc", r"isc"),
    ("zlib", "zlib", r"zlib"),
    ("mpl-1.1", "mpl", r"mpl 1 1"),
    ("mpl-2", "mpl", r"mpl 2 0"),
    ("epl-1", "epl", r"epl 1 0"),
    ("epl-2", "epl", r"epl 2 0"),
    ("eupl", "eupl", r"eupl 1 [12]"),
    ("apache-1.1", "apache", r"apache 1 1"),
    ("lgpl-2.1", "lgpl", r"lgpl 2 1 (?:only|or later)"),
    ("artistic-2", "artistic", r"artistic 2 0"),
    ("boost-1", "bsl", r"bsl 1 0"),
    ("ofl-1.1", "ofl", r"ofl 1 1"),
    ("0bsd", "spdx", r"0bsd"),
    ("aal", "spdx", r"aal"),
    ("afl-3", "spdx", r"afl 3 0"),
    ("apsl-2", "spdx", r"apsl 2 0"),
    ("blueoak-1", "spdx", r"blueoak 1 0 0"),
    ("bsd-1", "spdx", r"bsd 1 clause"),
    ("bsd-4", "spdx", r"bsd 4 clause(?: uc)?"),
    ("busl-1.1", "spdx", r"busl 1 1"),
    ("cc0-1", "spdx", r"cc0 1 0"),
    ("cecill-2.1", "spdx", r"cecill 2 1"),
    ("cecill-b", "spdx", r"cecill b"),
    ("cecill-c", "spdx", r"cecill c"),
    ("cern-ohl-p-2", "spdx", r"cern ohl p 2 0"),
    ("cern-ohl-s-2", "spdx", r"cern ohl s 2 0"),
    ("cern-ohl-w-2", "spdx", r"cern ohl w 2 0"),
    ("cpal-1", "spdx", r"cpal 1 0"),
    ("cpl-1", "spdx", r"cpl 1 0"),
    ("curl", "spdx", r"curl"),
    ("ecl-2", "spdx", r"ecl 2 0"),
    ("efl-2", "spdx", r"efl 2 0"),
    ("elastic-2", "spdx", r"elastic 2 0"),
    ("fair", "spdx", r"fair"),
    ("ftl", "spdx", r"ftl"),
    ("gfdl-1.2", "spdx", r"gfdl 1 2(?: only| or later)?"),
    ("gfdl-1.3", "spdx", r"gfdl 1 3(?: only| or later)?"),
    ("hpnd", "spdx", r"hpnd"),
    ("ijg", "spdx", r"ijg"),
    ("ipl-1", "spdx", r"ipl 1 0"),
    ("json", "spdx", r"json"),
    ("libpng-2", "spdx", r"libpng 2 0"),
    ("libtiff", "spdx", r"libtiff"),
    ("lppl-1.3", "spdx", r"lppl 1 3[ac]"),
    ("mit-0", "spdx", r"mit 0"),
    ("ms-pl", "spdx", r"ms pl"),
    ("ms-rl", "spdx", r"ms rl"),
    ("mulan-2", "spdx", r"mulanpsl 2 0"),
    ("naist-2003", "spdx", r"naist 2003"),
    ("nasa-1.3", "spdx", r"nasa 1 3"),
    ("ncsa", "spdx", r"ncsa"),
    ("ntp", "spdx", r"ntp"),
    ("odbl-1", "spdx", r"odbl 1 0"),
    ("odc-by-1", "spdx", r"odc by 1 0"),
    ("openssl", "spdx", r"openssl"),
    ("osl-3", "spdx", r"osl 3 0"),
    ("pddl-1", "spdx", r"pddl 1 0"),
    ("php-3", "spdx", r"php 3 01?"),
    ("postgresql", "spdx", r"postgresql"),
    ("python-2", "spdx", r"(?:psf|python) 2 0"),
    ("qpl-1", "spdx", r"qpl 1 0"),
    ("rpl-1.5", "spdx", r"rpl 1 5"),
    ("ruby", "spdx", r"ruby"),
    ("sissl", "spdx", r"sissl"),
    ("sleepycat", "spdx", r"sleepycat"),
    ("sspl-1", "spdx", r"sspl 1 0"),
    ("tcl", "spdx", r"tcl"),
    ("unicode-2016", "spdx", r"unicode dfs 2016"),
    ("unicode-3", "spdx", r"unicode 3 0"),
    ("upl-1", "spdx", r"upl 1 0"),
    ("vim", "spdx", r"vim"),
    ("w3c", "spdx", r"w3c"),
    ("x11", "spdx", r"x11"),
    ("zpl-2.1", "spdx", r"zpl 2 1"),
    ("classpath-exception", "spdx", r"gpl 2 0(?: only| or later)? with classpath exception 2 0"),
    ("linux-syscall-note", "spdx", r"gpl 2 0(?: only| or later)? with linux syscall note"),
    ("gcc-exception", "spdx", r"gpl 3 0(?: only| or later)? with gcc exception 3 1"),
    ("llvm-exception", "spdx", r"apache 2 0 with llvm exception"),
)
SPDX_PRIORITY = 8

#: Label, keywords, opening sentences of license texts.
OPENINGS = (
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("boost-1", "hereby", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("isc", "hereby", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("zlib", "implied", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("postgresql", "hereby", r"distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("unicode-2016", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy of the unicode data files"),
    ("busl-1.1", "hereby", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use"),
    ("gpl-2", "freedom", r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3", "copyleft", r"the gnu general public licen[cs]e is a free copyleft licen[cs]e"),
    ("agpl-3", "copyleft", r"the gnu affero general public licen[cs]e is a free copyleft licen[cs]e"),
    ("lgpl-3", "incorporates", r"this version of the gnu lesser general public licen[cs]e incorporates the terms and conditions of version 3"),
    ("gfdl", "documentation", r"modify this document under the terms of the gnu free documentation licen[cs]e"),
    ("artistic-1", "intent", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-2", "establishes", r"this licen[cs]e establishes the terms under which a given free software package may be copied"),
    ("wtfpl", "verbatim", r"distribute verbatim or modified copies of this licen[cs]e document and changing it is allowed"),
    ("ms-pl", "governs", r"this licen[cs]e governs use of the accompanying software if you use the software you accept this licen[cs]e"),
)

#: Label, keywords, sentences within license texts.
SENTENCES = (
    ("mit", "substantial", r"shall be included in all copies or substantial portions of the software"),
    ("mit", "deal", r"to deal in the software without restriction"),
    ("ncsa", "deal", r"to deal with the software without restriction"),
    ("isc", "disclaims", r"the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("apache-2", "irrevocable", r"perpetual worldwide non exclusive no charge royalty free irrevocable copyright licen[cs]e"),
    ("apache-2", "reproduction", r"terms and conditions for use reproduction and distribution"),
    ("apache-1.1", "apache", r"this product includes software developed by the apache software foundation"),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3", "endorse", r"nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4", "advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("x11", "consortium", r"the name of the x consortium shall not be used in advertising"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
    ("zlib", "altered", r"altered source versions must be plainly marked as such"),
    ("gpl", "hope", r"this program is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl", "hope", r"this library is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl", "derivative", r"contains no derivative of any portion of the library but is designed to work with the library"),
    ("mpl-2", "incompatible", r"this source code form is incompatible with secondary licen[cs]es"),
    ("epl", "eclipse", r"the accompanying program is provided under the terms of this eclipse public licen[cs]e"),
    ("cddl", "development", r"common development and distribution licen[cs]e"),
    ("unlicense", "compile", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("unlicense", "dedication", r"we make this dedication for the benefit of the public at large"),
    ("cc0-1", "deed", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc0-1", "waived", r"has waived all copyright and related or neighbou?ring rights"),
    ("ofl-1.1", "fonts", r"the fonts and derivatives however cannot be released under any other type of licen[cs]e"),
    ("python-2", "psf", r"psf is making python available to licensee on an as is basis"),
    ("php-3", "php", r"this product includes php software freely available from"),
    ("openssl", "openssl", r"this product includes software developed by the openssl project"),
    ("json", "evil", r"the software shall be used for good not evil"),
    ("beerware", "beer", r"you think this stuff is worth it you can buy me a beer in return"),
    ("w3c", "licensee", r"you the licensee agree that you have read understood and will comply"),
    ("sspl-1", "functionality", r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("elastic-2", "hosted", r"you may not provide the software to third parties as a hosted or managed service"),
    ("commons-clause", "sell", r"the licen[cs]e does not grant to you the right to sell the software"),
    ("odbl-1", "database", r"open data commons open database licen[cs]e"),
    ("pddl-1", "dedication", r"open data commons public domain dedication"),
    ("all-rights-reserved", "reproduced", r"all rights reserved no part of this (?:publication|document|book) may be reproduced"),
)

#: Label, keywords, notices that point to a license, and places it is found at.
NOTICES = (
    ("apache-2", "compliance", r"you may not use this file except in compliance with the licen[cs]e"),
    ("apache-2", "apache", r"apache org licen[cs]es licen[cs]e 2 0"),
    ("gpl", "received", r"you should have received a copy of the gnu general public licen[cs]e"),
    ("lgpl", "received", r"you should have received a copy of the gnu lesser general public licen[cs]e"),
    ("agpl", "received", r"you should have received a copy of the gnu affero general public licen[cs]e"),
    ("mpl-2", "mpl", r"if a copy of the mpl was not distributed with this file you can obtain one"),
    ("mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1"),
    ("mpl-2", "mozilla", r"mozilla org mpl 2 0"),
    ("epl-2", "eclipse", r"eclipse org legal epl (?:v20|2 0)"),
    ("epl-1", "eclipse", r"eclipse org legal epl v10"),
    ("mit", "opensource", r"opensource org licen[cs]es? mit"),
    ("isc", "opensource", r"opensource org licen[cs]es? isc"),
    ("bsd-2", "opensource", r"opensource org licen[cs]es? bsd 2 clause"),
    ("bsd-3", "opensource", r"opensource org licen[cs]es? bsd 3 clause"),
    ("gpl-2", "gnu", r"gnu org licen[cs]es (?:old licen[cs]es )?gpl 2 0"),
    ("gpl-3", "gnu", r"gnu org licen[cs]es gpl 3 0"),
    ("lgpl-2.1", "gnu", r"gnu org licen[cs]es (?:old licen[cs]es )?lgpl 2 1"),
    ("lgpl-3", "gnu", r"gnu org licen[cs]es lgpl 3 0"),
    ("agpl-3", "gnu", r"gnu org licen[cs]es agpl 3 0"),
    ("gfdl", "gnu", r"gnu org licen[cs]es fdl 1 [123]"),
    ("boost-1", "boost", r"boost org licen[cs]e 1 0 txt"),
    ("ofl-1.1", "sil", r"scripts sil org ofl"),
    ("unlicense", "unlicense", r"unlicense org"),
    ("wtfpl", "wtfpl", r"wtfpl net"),
    ("cc-by", "creativecommons", r"creativecommons org licen[cs]es by [1234] [05]"),
    ("cc-by-sa", "creativecommons", r"creativecommons org licen[cs]es by sa [1234] [05]"),
    ("cc-by-nd", "creativecommons", r"creativecommons org licen[cs]es by nd [1234] [05]"),
    ("cc-by-nc", "creativecommons", r"creativecommons org licen[cs]es by nc [1234] [05]"),
    ("cc-by-nc-sa", "creativecommons", r"creativecommons org licen[cs]es by nc sa [1234] [05]"),
    ("cc-by-nc-nd", "creativecommons", r"creativecommons org licen[cs]es by nc nd [1234] [05]"),
    ("cc0-1", "creativecommons", r"creativecommons org publicdomain zero 1 0"),
)

#: Label, keywords, exceptions that are granted beside a license.
EXCEPTIONS = (
    ("classpath-exception", "statically", r"linking this library statically or dynamically with other modules is making a combined work"),
    ("font-exception", "font", r"as a special exception if you create a document which uses this font"),
    ("gcc-exception", "runtime", r"additional permissions described in the gcc runtime library exception"),
    ("libstdc-exception", "exception", r"as a special exception you may use this file as part of a free software library without restriction"),
    ("autoconf-exception", "autoconf", r"part of a program that contains a configuration script generated by autoconf"),
    ("bison-exception", "bison", r"you may create a larger work that contains part or all of the bison parser skeleton"),
    ("openssl-exception", "openssl", r"permission to link the code of portions of this program with the openssl library"),
    ("llvm-exception", "compiling", r"as a result of your compiling your source code portions of this software are embedded into an object form"),
    ("linux-syscall-note", "syscalls", r"does not cover user programs that use syscalls"),
)
OPENING_PRIORITY, OPENING_WEIGHT = 7, 0.95
BASE_PRIORITY = 9
LEVELS = BASE_PRIORITY + 1


@dataclass(frozen=True)
class Rule:
    """A pattern that starts at the space before its first word."""

    number: int
    label: str
    keywords: tuple[str, ...]
    pattern: str
    priority: int
    weight: float
    base: bool = False


def rules() -> list[Rule]:
    """All rules in their order: the base phrases, phrasing by phrasing, the written ones."""
    made = [
        (label, keyword, phrase, BASE_PRIORITY, 1.0, True) for phrase, label, keyword in BASE
    ]
    for priority, weight, phrasing in PHRASINGS:
        for label, keyword, name in LICENSES:
            made.append((label, keyword, phrasing.format(name), priority, weight, False))
    for label, keyword, name in SPDX:
        pattern = f"spdx licen[cs]e identifier {name}"
        made.append((label, keyword, pattern, SPDX_PRIORITY, 1.0, False))
    for label, keyword, pattern in (*OPENINGS, *SENTENCES, *NOTICES, *EXCEPTIONS):
        made.append((label, keyword, pattern, OPENING_PRIORITY, OPENING_WEIGHT, False))
    return [
        Rule(i, label, tuple(keywords.split()), f" {pattern}(?= )", priority, weight, base)
        for i, (label, keywords, pattern, priority, weight, base) in enumerate(made)
    ]


def plain_form(text: Column) -> Column:
    """Words of a text, A-Z in lower case, with a space around each; " " if there is none."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), BREAKS, " ")


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _of_rule(plain: Column, rule: Column) -> Column:
    """Detections of one rule: (first, last, number, label, priority, weight, base)."""
    pattern = F.concat(F.lit("("), rule["pattern"], F.lit(")"))
    # A flag goes to the end of the word before each match, which is numbered like
    # the first word of the match: the empty word in front is 0.
    flagged = F.regexp_replace(plain, pattern, F.lit(f"{_FLAG}$1"))
    places = F.transform(
        F.split(flagged, " "), lambda word, i: F.when(F.endswith(word, F.lit(_FLAG)), i)
    )
    places = F.filter(places, lambda i: i.isNotNull())
    found = F.regexp_extract_all(plain, pattern, F.lit(1))
    return F.zip_with(
        places,
        found,
        lambda first, match: F.struct(
            first.cast("long").alias("first"),
            (first + _spaces(match) - 1).cast("long").alias("last"),
            rule["number"].alias("number"),
            rule["label"].alias("label"),
            rule["priority"].alias("priority"),
            rule["weight"].alias("weight"),
            rule["base"].alias("base"),
        ),
    )


_DETECTION = (
    "struct<first:bigint,last:bigint,number:int,label:string,priority:int,weight:double,base:boolean>"
)


def detections(plain: Column, known: list[Rule] | None = None) -> Column:
    """All detections of a plain form, by first word, the longer and the stronger first."""
    by_keywords: dict[tuple[str, ...], list[Rule]] = {}
    for rule in rules() if known is None else known:
        by_keywords.setdefault(rule.keywords, []).append(rule)
    listed = F.array(
        *[
            F.struct(
                F.array(*map(F.lit, keywords)).alias("keywords"),
                F.array(
                    *[
                        F.struct(
                            F.lit(r.number).alias("number"), F.lit(r.label).alias("label"),
                            F.lit(r.pattern).alias("pattern"),
                            F.lit(r.priority).alias("priority"),
                            F.lit(r.weight).alias("weight"), F.lit(r.base).alias("base"),
                        )
                        for r in own
                    ]
                ).alias("rules"),
            )
            for keywords, own in by_keywords.items()
        ]
    )
    # The text's words meet the keywords once, by hash, not each keyword the text.
    keywords = F.array(*map(F.lit, dict.fromkeys(k for group in by_keywords for k in group)))
    held = F.transform(
        F.array(F.array_intersect(F.split(plain, " "), keywords)),
        lambda words: F.filter(listed, lambda group: F.arrays_overlap(words, group["keywords"])),
    )
    tried = F.flatten(F.transform(F.flatten(held), lambda group: group["rules"]))
    tried = F.filter(tried, lambda r: F.rlike(plain, r["pattern"]))
    found = F.flatten(F.transform(tried, lambda r: _of_rule(plain, r)))

    def before(a, b):
        return (
            F.when(a["first"] != b["first"], a["first"] - b["first"])
            .when(a["last"] != b["last"], b["last"] - a["last"])
            .when(a["priority"] != b["priority"], (b["priority"] - a["priority"]).cast("long"))
            .otherwise((a["number"] - b["number"]).cast("long"))
            .cast("int")
        )

    return F.array_sort(found, before)


def standing(found: Column) -> Column:
    """Detections that are not suppressed.

    Along the order of ``detections`` whatever can contain a detection comes before it.
    So it is enough to keep, for each priority, the farthest last word so far. What
    stands is gathered in chunks, as an array is copied whenever it grows.
    """
    far = F.array_repeat(F.lit(-1).cast("long"), LEVELS)
    start = F.struct(far.alias("far"), F.array().cast(f"array<{_DETECTION}>").alias("kept"))

    def step(state, one):
        level = one["priority"]
        rivals = F.slice(state["far"], level + 1, F.lit(LEVELS))
        inside = F.array_max(rivals) >= one["last"]
        moved = F.transform(
            state["far"],
            lambda end, i: F.when(i == level, F.greatest(end, one["last"])).otherwise(end),
        )
        kept = F.when(inside, state["kept"]).otherwise(F.concat(state["kept"], F.array(one)))
        return F.struct(moved.alias("far"), kept.alias("kept"))

    def chunk_step(state, n):
        fresh = F.struct(state["far"].alias("far"), start["kept"].alias("kept"))
        own = F.aggregate(F.slice(found, n * _CHUNK + 1, F.lit(_CHUNK)), fresh, step)
        # The chunk is worked through once, by a function of an array's element.
        return F.get(
            F.transform(
                F.array(own),
                lambda done: F.struct(
                    done["far"].alias("far"), F.concat(state["kept"], done["kept"]).alias("kept")
                ),
            ),
            F.lit(0),
        )

    chunks = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _CHUNK).cast("int"))
    return F.aggregate(chunks, start, chunk_step, lambda state: state["kept"])


def scan(documents: DataFrame, known: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, found (all detections), stand (those not suppressed)."""
    plain = plain_form(F.coalesce(F.col("text").cast("string"), F.lit("")))
    # A function of an array's element computes the element once, a column may not.
    read = F.transform(
        F.array(plain),
        lambda p: F.struct(
            (_spaces(p) - 1).cast("long").alias("n_words"), detections(p, known).alias("found")
        ),
    )
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), read.alias("read"))
    docs = docs.select("doc_id", F.explode("read").alias("read")).select("doc_id", "read.*")
    none = F.array().cast(f"array<{_DETECTION}>")
    stand = F.when(F.size("found") > 0, standing(F.col("found"))).otherwise(none)
    return docs.withColumn("stand", stand)


def license_labels(documents: DataFrame) -> DataFrame:
    """The base columns, the labels and the score of each row."""
    found = scan(documents)
    base = F.filter("found", lambda d: d["base"])
    kept = F.concat(base, F.col("stand"))

    def labels(of):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda d: d["label"]))), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda d: d["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda d: d["first"])).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(kept).alias("labels"),
        F.coalesce(F.array_max(F.transform(kept, lambda d: d["weight"])), F.lit(0.0)).alias("score"),
        F.size("found").cast("long").alias("n_found"),
        F.size("stand").cast("long").alias("n_standing"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of all documents."""
    return license_labels(table(spark, sf_dir, "documents"))

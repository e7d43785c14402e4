"""License scans by sentence rules, in DataFrame operations only.

A text is cut into sentences: at sentence marks before white space, at colons that end a line or stand before a list
item, at blank lines, and before lines that begin as notices do (OPENERS); comment marks at line beginnings go, and the
point of "v. 2" is no sentence's end. A sentence is normalised to lower-case ASCII letters and digits with single
spaces, without a list item's number, with one holder's name for any, and mapped to the identifier of the known
sentence that it is. One that isn't known is cut again before lines that begin with a capitalised word: what was
wrapped stays together, and a line of its own is found too. A short statement (STATED) that names licences is mapped to the
identifiers of their names and of the words that connect them; one that names none known here is STATED_UNKNOWN. Identifiers in text order are a sequence, which the rules rewrite in their order: each replaces the identifiers that it
matches by the licence they state, so that rules of more identifiers come before those of fewer; licences with a
connecting word between them become one expression. What no rule takes stays as a sentence without a licence.

Texts without any of the ANCHORS, one of which is in every known sentence, have no identifiers; they are told by a
substring search alone. Each row is scanned for itself, in one pass and without a shuffle, whatever its length. Null and
empty texts have no identifiers, an empty table gives an empty result; repeated rows and null ids are nothing special,
so there are no ties. Of rules that match at the same place the first in order is taken. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Licences that short statements name: identifier, names.
NAMED = [
    ("Apache-2.0", ["apache license version 2 0", "apache license 2 0", "apache 2 0 license", "apache 2 0", "apache license"]),
    ("MIT", ["mit license", "mit licence", "mit", "expat license"]),
    ("ISC", ["isc license", "isc"]),
    ("BSD-2-Clause", ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "bsd 2 clause"]),
    ("BSD-3-Clause", ["bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "bsd 3 clause"]),
    ("BSD", ["bsd license", "bsd style license"]),
    ("GPL-2.0-only", ["gnu general public license version 2", "gnu gpl version 2", "gpl version 2", "gplv2", "gpl v2", "gpl 2 0", "gpl 2 0 only"]),
    ("GPL-2.0-or-later", ["gnu general public license version 2 or later", "gplv2 or later", "gpl 2 0 or later"]),
    ("GPL-3.0-only", ["gnu general public license version 3", "gnu gpl version 3", "gpl version 3", "gplv3", "gpl v3", "gpl 3 0", "gpl 3 0 only"]),
    ("GPL-3.0-or-later", ["gnu general public license version 3 or later", "gplv3 or later", "gpl 3 0 or later"]),
    ("GPL", ["gnu general public license", "gnu gpl", "gpl"]),
    ("LGPL-2.1-only", ["gnu lesser general public license version 2 1", "lgpl version 2 1", "lgplv2 1", "lgpl 2 1", "lgpl 2 1 only"]),
    ("LGPL-3.0-only", ["gnu lesser general public license version 3", "lgpl version 3", "lgplv3", "lgpl 3 0", "lgpl 3 0 only"]),
    ("LGPL", ["gnu lesser general public license", "lgpl"]),
    ("AGPL-3.0-only", ["gnu affero general public license version 3", "gnu affero general public license", "agplv3", "agpl 3 0", "agpl 3 0 only"]),
    ("MPL-2.0", ["mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license 2 0", "mpl 2 0"]),
    ("EPL-2.0", ["eclipse public license version 2 0", "eclipse public license v 2 0", "eclipse public license 2 0", "epl 2 0"]),
    ("BSL-1.0", ["boost software license version 1 0", "boost software license 1 0", "bsl 1 0"]),
    ("CC0-1.0", ["creative commons zero", "cc0 1 0 universal", "cc0 1 0", "cc0"]),
    ("Unlicense", ["unlicense"]),
    ("Zlib", ["zlib license", "zlib"]),
    *[
        (f"CC-{kind}-{version}", [f"cc {kind.lower().replace('-', ' ')} {version.replace('.', ' ')}", *(f"creative commons {words} {number}" for n in [version.replace(".", " ")] for number in (n, f"{n} license", f"license {n}", f"{n} international", f"{n} international license", f"{n} unported license", f"license version {n}"))])
        for kind, words in [("BY", "attribution"), ("BY-SA", "attribution sharealike"), ("BY-NC", "attribution noncommercial"), ("BY-ND", "attribution noderivatives"), ("BY-NC-SA", "attribution noncommercial sharealike"), ("BY-NC-ND", "attribution noncommercial noderivatives")]
        for version in ("4.0", "3.0")
    ],
    ("WTFPL", ["do what the fuck you want to public license", "do what the f you want to public license"]),
    ("Artistic-2.0", ["artistic license 2 0", "artistic license version 2 0"]),
    ("Artistic-1.0", ["artistic license 1 0", "artistic license"]),
    ("PostgreSQL", ["postgresql license", "postgres license"]),
    ("EUPL-1.2", ["european union public license version 1 2", "european union public licence version 1 2", "european union public license 1 2", "european union public licence v 1 2", "eupl v 1 2", "eupl"]),
    ("EPL-1.0", ["eclipse public license version 1 0", "eclipse public license v 1 0", "eclipse public license 1 0"]),
    ("MPL-1.1", ["mozilla public license version 1 1", "mozilla public license 1 1"]),
    ("OFL-1.1", ["sil open font license version 1 1", "sil open font license 1 1", "sil open font license", "open font license"]),
    ("0BSD", ["zero clause bsd license", "bsd zero clause license", "0 clause bsd license"]),
    ("BSD-4-Clause", ["4 clause bsd license", "original bsd license"]),
    ("NCSA", ["university of illinois ncsa open source license", "ncsa license"]),
    ("Python-2.0", ["python software foundation license", "python software foundation license version 2", "psf license"]),
    ("CDDL-1.0", ["common development and distribution license", "common development and distribution license version 1 0", "cddl"]),
    ("MS-PL", ["microsoft public license"]),
    ("LPPL-1.3c", ["latex project public license", "lppl"]),
    ("AFL-3.0", ["academic free license version 3 0", "academic free license 3 0"]),
    ("UPL-1.0", ["universal permissive license version 1 0", "universal permissive license"]),
    ("MulanPSL-2.0", ["mulan psl v2", "mulan permissive software license v2"]),
    ("BlueOak-1.0.0", ["blue oak model license 1 0 0", "blue oak model license"]),
    ("Ruby", ["ruby license"]),
    ("OpenSSL", ["openssl license"]),
    ("X11", ["x11 license", "mit x11 license"]),
    ("Vim", ["vim license"]),
    ("CC-PDDC", ["creative commons public domain dedication"]),
    ("LGPL-2.1-or-later", ["gnu lesser general public license version 2 1 or later", "lgplv2 1 or later", "lgpl version 2 1 or later"]),
    ("LGPL-3.0-or-later", ["gnu lesser general public license version 3 or later", "lgplv3 or later", "lgpl version 3 or later"]),
    ("AGPL-3.0-or-later", ["gnu affero general public license version 3 or later", "agplv3 or later"]),
    ("LLVM-exception", ["llvm exceptions"]),
    ("Classpath-exception-2.0", ["classpath exception"]),
    ("GCC-exception-3.1", ["gcc runtime library exception"]),
    ("Linux-syscall-note", []),
    ("Autoconf-exception-3.0", []),
    ("Bison-exception-2.2", []),
    ("Font-exception-2.0", []),
]
#: Short statements: what they say before licences' names, and the names; the first kinds are about licences for sure.
_SURE = (
    "(?:(?:dual |triple |multi )?(?:licensed|released|distributed|published|available|provided) under "
    "|this (?:work|software|project|program|library|package|crate|file|code|document|article|text|content) is (?:(?:dual |triple |multi )?licensed|released|distributed|available) under |spdx license identifier )"
)
OPENED = f"^{_SURE}"
STATED = f"^(?:{_SURE}|licen[sc]e )(.+)$"
#: What may follow the names in a statement, and words between them that name nothing.
TRAILING = r" (?:see|which|whose|that|found|available|a copy|the full|for (?:details|more)|in the (?:file|license|licence)|at your option|unless|copyright|as (?:found|described|stated|given|published))\b.*$"
FILLERS = ["the", "a", "an", "of", "either", "both", "any", "terms", "conditions", "license", "licenses", "licence", "licences", "version", "under", "this", "following"]
CONNECTORS = {"and": "AND", "or": "OR", "with": "WITH"}
#: A statement about a licence that has no name known here.
UNKNOWN = "STATED_UNKNOWN"
_GNU = [("GPL", "general"), ("LGPL", "lesser general"), ("AGPL", "affero general")]
_VERSIONS = [("2", "2.0"), ("2 1", "2.1"), ("3", "3.0")]
_SUBJECTS = ["", "this program is free software ", "this library is free software ", "this software is free software ", "it is free software "]
_TERMS = "you can redistribute it and or modify it under the terms of the gnu {} public license"
_OPTION = ["either version {} of the license or at your option any later version", "either version {} of the license or any later version"]
#: Sentences of licence texts and notices: identifier, normalised sentences.
SENTENCES = [
    ("MIT_GRANT", ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"]),
    ("MIT_NOTICE", ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software"]),
    ("MIT_WARRANTY", ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"]),
    ("MIT_LIABILITY", ["in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"]),
    ("ISC_GRANT", [f"permission to use copy modify and {x}distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies" for x in ("or ", "")]),
    ("ISC_WARRANTY", ["the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"]),
    ("BSD_GRANT", ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"]),
    ("BSD_SOURCE", ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"]),
    ("BSD_BINARY", ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"]),
    ("BSD_NAMES", ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "the name of the author may not be used to endorse or promote products derived from this software without specific prior written permission"]),
    ("BSD_WARRANTY", ["this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"]),
    ("APACHE_GRANT", ["licensed under the apache license version 2 0 the license"]),
    ("APACHE_COMPLY", ["you may not use this file except in compliance with the license"]),
    ("APACHE_COPY", ["you may obtain a copy of the license at http www apache org licenses license 2 0", "you may obtain a copy of the license at https www apache org licenses license 2 0"]),
    ("APACHE_AT", ["you may obtain a copy of the license at"]),
    ("APACHE_ADDRESS", ["http www apache org licenses license 2 0", "https www apache org licenses license 2 0"]),
    ("APACHE_WARRANTY", ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"]),
    ("APACHE_SEE", ["see the license for the specific language governing permissions and limitations under the license"]),
    *[(f"{kind}_FREE", [f"{who}{_TERMS.format(words)} as published by the free software foundation" for who in _SUBJECTS]) for kind, words in _GNU],
    *[(f"{kind}_{n.replace(' ', '')}_FREE_LATER", [f"{who}{_TERMS.format(words)} as published by the free software foundation {option.format(n)}" for who in _SUBJECTS for option in _OPTION]) for kind, words in _GNU for n, _ in _VERSIONS],
    *[(f"{kind}_{n.replace(' ', '')}_FREE_ONLY", [f"{who}{terms}" for who in _SUBJECTS for terms in (f"{_TERMS.format(words)} version {n} as published by the free software foundation", f"{_TERMS.format(words)} as published by the free software foundation version {n}", f"{_TERMS.format(words)} as published by the free software foundation version {n} of the license")]) for kind, words in _GNU for n, _ in _VERSIONS],
    *[(f"GNU_{n.replace(' ', '')}_LATER", [option.format(n) for option in _OPTION]) for n, _ in _VERSIONS],
    ("GNU_HOPE", ["without even the implied warranty of merchantability or fitness for a particular purpose"]),
    ("GNU_SEE", [f"see the gnu {words} public license for more details" for _, words in _GNU]),
    ("GNU_COPY", [f"you should have received a copy of the gnu {words} public license along with this {what}" for _, words in _GNU for what in ("program", "library", "software")]),
    ("MPL_FORM", ["this source code form is subject to the terms of the mozilla public license v 2 0"]),
    ("MPL_COPY", [f"if a copy of the mpl was not distributed with this file you can obtain one at {address}" for address in ("http mozilla org mpl 2 0", "https mozilla org mpl 2 0", "http mozilla org mpl 2 0 license")]),
    ("EPL_TERMS", ["the accompanying program is provided under the terms of this eclipse public license agreement"]),
    ("BSL_GRANT", ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"]),
    ("ZLIB_GRANT", ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"]),
    ("APACHE_TITLE", ["apache license version 2 0 january 2004", "apache license version 2 0 january 2004 http www apache org licenses"]),
    ("GPL_2_TITLE", ["gnu general public license version 2 june 1991"]),
    ("GPL_3_TITLE", ["gnu general public license version 3 29 june 2007"]),
    ("LGPL_21_TITLE", ["gnu lesser general public license version 2 1 february 1999"]),
    ("LGPL_3_TITLE", ["gnu lesser general public license version 3 29 june 2007"]),
    ("AGPL_3_TITLE", ["gnu affero general public license version 3 19 november 2007"]),
    ("MPL_TITLE", ["mozilla public license version 2 0"]),
    ("PUBLIC_DOMAIN", ["this is free and unencumbered software released into the public domain", "this work is in the public domain", "released into the public domain", "this file is in the public domain"]),
    ("RESERVED", ["all rights reserved"]),
    ("COPYRIGHT_RESERVED", ["copyright all rights reserved"]),
]
_AFTER = [["GNU_HOPE", "GNU_SEE", "GNU_COPY"], ["GNU_HOPE", "GNU_SEE"], ["GNU_HOPE"], []]
#: Rules in their order: licence, the identifiers that state it.
RULES = [
    ("MIT", ["MIT_GRANT", "MIT_NOTICE", "MIT_WARRANTY", "MIT_LIABILITY"]),
    ("MIT", ["MIT_GRANT", "MIT_NOTICE", "MIT_WARRANTY"]),
    ("MIT", ["MIT_GRANT", "MIT_NOTICE"]),
    ("BSD-3-Clause", ["BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_NAMES", "BSD_WARRANTY"]),
    ("BSD-3-Clause", ["BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_NAMES"]),
    ("BSD-2-Clause", ["BSD_GRANT", "BSD_SOURCE", "BSD_BINARY", "BSD_WARRANTY"]),
    ("Apache-2.0", ["APACHE_GRANT", "APACHE_COMPLY", "APACHE_AT", "APACHE_ADDRESS", "APACHE_WARRANTY", "APACHE_SEE"]),
    ("Apache-2.0", ["APACHE_GRANT", "APACHE_COMPLY", "APACHE_COPY", "APACHE_WARRANTY", "APACHE_SEE"]),
    ("Apache-2.0", ["APACHE_GRANT", "APACHE_COMPLY"]),
    ("Apache-2.0", ["APACHE_GRANT"]),
    *[(f"{kind}-{version}-or-later", [f"{kind}_FREE", f"GNU_{n.replace(' ', '')}_LATER", *rest]) for rest in _AFTER for kind, _ in _GNU for n, version in _VERSIONS],
    *[(f"{kind}-{version}-or-later", [f"{kind}_{n.replace(' ', '')}_FREE_LATER", *rest]) for rest in _AFTER for kind, _ in _GNU for n, version in _VERSIONS],
    *[(f"{kind}-{version}-only", [f"{kind}_{n.replace(' ', '')}_FREE_ONLY", *rest]) for rest in _AFTER for kind, _ in _GNU for n, version in _VERSIONS],
    ("GPL", ["GPL_FREE"]),
    ("LGPL", ["LGPL_FREE"]),
    ("AGPL", ["AGPL_FREE"]),
    ("ISC", ["ISC_GRANT", "ISC_WARRANTY"]),
    ("ISC", ["ISC_GRANT"]),
    ("MIT", ["MIT_GRANT"]),
    ("BSD", ["BSD_GRANT"]),
    ("MPL-2.0", ["MPL_FORM", "MPL_COPY"]),
    ("MPL-2.0", ["MPL_FORM"]),
    ("EPL-2.0", ["EPL_TERMS"]),
    ("BSL-1.0", ["BSL_GRANT"]),
    ("Zlib", ["ZLIB_GRANT"]),
    ("Apache-2.0", ["APACHE_TITLE"]),
    ("GPL-2.0-only", ["GPL_2_TITLE"]),
    ("GPL-3.0-only", ["GPL_3_TITLE"]),
    ("LGPL-2.1-only", ["LGPL_21_TITLE"]),
    ("LGPL-3.0-only", ["LGPL_3_TITLE"]),
    ("AGPL-3.0-only", ["AGPL_3_TITLE"]),
    ("MPL-2.0", ["MPL_TITLE"]),
    ("Public-Domain", ["PUBLIC_DOMAIN"]),
    *[(name, [f"NAMED_{name}"]) for name, _ in NAMED],
    ("All-Rights-Reserved", ["COPYRIGHT_RESERVED"]),
    ("All-Rights-Reserved", ["RESERVED"]),
]
#: After the rules: licences with a word between them are one expression, in which WITH binds more than AND, and AND more than OR; other connecting words go.
EXPRESSIONS = [(rf";=([^;]+);;{word};;=([^;]+);", rf";=\1 {word} \2;") for word in ("WITH", "AND", "OR") for _ in range(1 if word == "WITH" else 4)] + [(";(?:AND|OR|WITH);", "")]
ANCHORS = ["licen", "rights reserved", "hereby granted", "permi", "warrant", "liable", "redistribut", "gnu general public", "public domain", "under the", "under ", "version", "mozilla"]
#: Words that begin the lines of notices.
OPENERS = ["This", "The", "It", "Licensed", "Released", "Distributed", "Published", "Available", "Provided", "Licen[sc]e:", "SPDX", "Permission", "Redistributions?", "Neither", "Unless", "See", "If", "All", "Copyright"]
#: Before sentences are cut: pattern, replacement.
MARKS = [(r"\n[ \t]*(//+|/\*+|\*+/?|#+|--+|;+)[ \t]?", "\n"), (r"\b([Vv])(er)?\.[ \t]*([0-9])", r"\1 \3")]
CUT, SOFT = "\x1e", "\x1d"
#: Ends of sentences: pattern, replacement. The last are soft.
ENDS = [
    (r"((?:SPDX|spdx)-[Ll]icense-[Ii]dentifier:[^\n]*)\n", rf"\1{CUT}"), (r"([.!?;])\s+", rf"\1{CUT}"), (r":[ \t]*\n", CUT), (r":\s+([(]?[0-9a-h][.)]\s)", rf"{CUT}\1"), (r"\n\s*\n", CUT),
    (rf"\n([ \t]*(?:{'|'.join(OPENERS)}))", rf"{CUT}\1"), (r"\n(\s*\p{Lu}\p{Ll})", rf"{SOFT}\1"),
]
#: In normalised sentences: pattern, replacement.
SAME = [
    (r"^([0-9]{1,2}|[a-h]|i{1,3}) (redistributions|neither|the name)", r"\2"),
    (r"^neither the name of [a-z0-9 ]+ nor the names? of (its|their|any|the) contributors", "neither the name of the copyright holder nor the names of its contributors"),
    (r"^this software is provided by [a-z0-9 ]+ as is and any express", "this software is provided by the copyright holders and contributors as is and any express"),
]


def known_sentences(sentences: Iterable = SENTENCES) -> dict[str, str]:
    """Identifiers by normalised sentence."""
    return {s: id for id, every in sentences for s in every}


def known_names(named: Iterable = NAMED) -> dict[str, str]:
    """Identifiers of licences by the names that statements have for them; a licence's own identifier is one."""
    own = {re.sub("[^a-z0-9]+", " ", name.lower()).strip(): f"NAMED_{name}" for name, _ in named}
    return {n: f"NAMED_{name}" for name, names in named for n in names} | own


def _pieces(names: Iterable[str]) -> str:
    """Names, the longest first, and what connects them."""
    return rf"\b({'|'.join(sorted([*names, *CONNECTORS], key=lambda n: (-len(n), n)))})\b"


def _others(names: Iterable[str]) -> str:
    return rf"\b(?:{'|'.join(sorted([*names, *CONNECTORS, *FILLERS], key=lambda n: (-len(n), n)))})\b"


#: No known sentence or statement is shorter or longer.
LENGTHS = (8, 1000)


def _pattern(ids: list[str]) -> str:
    return ";" + ";;".join(i.replace(".", r"\.") for i in ids) + ";"


def _table(known: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in known.items() for x in pair])


def _java(replacement: str) -> str:
    return replacement.replace("\\1", "$1").replace("\\2", "$2").replace("\\3", "$3")


def _replaced(text: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, _java(replacement))
    return text


def _stated(s: Column, names: dict[str, str], final: Column) -> Column:
    """The identifiers of a statement's names with what connects them; UNKNOWN, where `final`, if anything else stands there."""
    rest = F.regexp_replace(F.regexp_replace(F.regexp_extract(s, STATED, 1), TRAILING, ""), r"\band or\b", "or")
    pieces = F.regexp_extract_all(rest, F.lit(_pieces(names)), F.lit(1))
    table = _table(names | CONNECTORS)
    clear = (F.btrim(F.regexp_replace(rest, _others(names), "")) == "") & F.exists(pieces, lambda p: ~p.isin(list(CONNECTORS)))
    return F.when(clear, F.transform(pieces, lambda p: table[p])).when(final & s.rlike(OPENED) & F.contains(s, F.lit("licen")), F.array(F.lit(UNKNOWN)))


def sentence_ids(text: Column, known: dict[str, str], names: dict[str, str]) -> Column:
    """The identifiers of a text's known sentences and of what its statements name, in text order."""
    marked = _replaced(F.concat(F.lit("\n"), text), MARKS + ENDS)
    normal = lambda s: _replaced(F.btrim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")), SAME)
    likely = lambda s: F.length(s).between(*LENGTHS) & s.rlike("|".join(ANCHORS))
    table = _table(known)
    one = lambda s: F.when(table[s].isNotNull(), F.array(table[s]))
    look = lambda s, final: F.when(likely(s), F.coalesce(one(s), F.when(s.rlike(STATED), _stated(s, names, final))))
    whole = lambda s: ~F.contains(s, F.lit(SOFT))
    told = F.transform(F.split(marked, CUT, -1), lambda s: F.struct(s.alias("s"), look(normal(s), whole(s)).alias("ids")))
    none = F.array().cast("array<string>")
    parts = lambda s: F.flatten(F.transform(F.split(s, SOFT, -1), lambda x: F.coalesce(look(normal(x), F.lit(True)), none)))
    return F.flatten(F.transform(told, lambda x: F.when(x["ids"].isNull() & ~whole(x["s"]), parts(x["s"])).otherwise(F.coalesce(x["ids"], none))))


def scan(docs: DataFrame, text: str = "text", id: str = "doc_id", known: dict[str, str] | None = None, names: dict[str, str] | None = None, rules: list | None = None) -> DataFrame:
    """(doc_id, n_sentences, sentences, licenses, unruled): identifiers, licences and identifiers without one, comma-separated in text order."""
    known, names, rules = known or known_sentences(), names or known_names(), rules or RULES
    low = F.lower(F.col("text"))
    gate = F.lit(False)
    for a in ANCHORS:
        gate = gate | F.contains(low, F.lit(a))
    rows = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ids = rows.select("doc_id", F.when(gate, sentence_ids(F.col("text"), known, names)).otherwise(F.array().cast("array<string>")).alias("ids"))
    sequence = F.concat(F.lit(";"), F.array_join(F.transform("ids", lambda i: F.concat(i, F.lit(";"))), ";"))
    read = ids.select("doc_id", F.size("ids").cast("long").alias("n_sentences"), F.array_join("ids", ",").alias("sentences"), sequence.alias("sequence"))
    ruled = F.col("sequence")
    for name, of in rules:
        ruled = F.regexp_replace(ruled, _pattern(of), f";={name};")
    ruled = _replaced(ruled, EXPRESSIONS)
    read = read.withColumn("ruled", F.when(F.col("n_sentences") > 0, ruled).otherwise(F.lit("")))
    parts = F.filter(F.split("ruled", ";"), lambda x: x != "")
    read = read.withColumn("parts", parts)
    licenses = F.transform(F.filter("parts", lambda x: F.startswith(x, F.lit("="))), lambda x: F.substring(x, 2, 1000))
    return read.select("doc_id", "n_sentences", "sentences", F.array_join(licenses, ",").alias("licenses"), F.array_join(F.filter("parts", lambda x: ~F.startswith(x, F.lit("="))), ",").alias("unruled"))


def scan_sql() -> str:
    """The same over the table documents, for DuckDB."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    table, names = ("MAP {" + ", ".join(f"{quote(k)}: {quote(v)}" for k, v in known.items()) + "}" for known in (known_sentences(), known_names() | CONNECTORS))
    ruled = "sequence"
    for name, of in RULES:
        ruled = f"regexp_replace({ruled}, {quote(_pattern(of))}, {quote(f';={name};')}, 'g')"
    for pattern, replacement in EXPRESSIONS:
        ruled = f"regexp_replace({ruled}, {quote(pattern)}, {quote(replacement)}, 'g')"

    def replaced(text: str, steps: list[tuple[str, str]]) -> str:
        for pattern, replacement in steps:
            text = f"regexp_replace({text}, {quote(pattern)}, {quote(replacement)}, 'g')"
        return text

    marked = replaced("chr(10) || coalesce(text, '')", MARKS + ENDS)
    normal = replaced("trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))", SAME)
    rest = f"regexp_replace(regexp_replace(regexp_extract(n, {quote(STATED)}, 1), {quote(TRAILING)}, ''), {quote(chr(92) + 'band or' + chr(92) + 'b')}, 'or', 'g')"
    pieces = f"regexp_extract_all({rest}, {quote(_pieces(known_names()))}, 1)"
    connect = ", ".join(map(quote, CONNECTORS))
    clear = f"trim(regexp_replace({rest}, {quote(_others(known_names()))}, '', 'g')) = '' and len(list_filter({pieces}, lambda p: p not in ({connect}))) > 0"
    stated = lambda final: f"case when not regexp_matches(n, {quote(STATED)}) then null when {clear} then list_transform({pieces}, lambda p: ({names})[p]) when {final} and regexp_matches(n, {quote(OPENED)}) and contains(n, 'licen') then [{quote(UNKNOWN)}] end"
    look = lambda final: f"case when length(n) between {LENGTHS[0]} and {LENGTHS[1]} and regexp_matches(n, {quote('|'.join(ANCHORS))}) then case when ({table})[n] is not null then [({table})[n]] else {stated(final)} end end"
    return f"""
with sentences as (
    select doc_id, list_transform(list_transform(string_split({marked}, chr(30)), lambda s: {{'s': s, 'n': {normal}}}), lambda x: {{'s': x.s, 'ids': list_transform([x.n], lambda n: {look("not contains(x.s, chr(29))")})[1]}}) as told from documents
), found as (
    select doc_id, flatten(list_transform(told, lambda x: case when x.ids is null and contains(x.s, chr(29)) then flatten(list_transform(list_transform(string_split(x.s, chr(29)), lambda s: {normal}), lambda n: coalesce({look("true")}, []))) else coalesce(x.ids, []) end)) as ids from sentences
), sequences as (
    select doc_id, cast(len(ids) as bigint) as n_sentences, array_to_string(ids, ',') as sentences, ';' || array_to_string(list_transform(ids, lambda i: i || ';'), ';') as sequence from found
), ruled as (
    select doc_id, n_sentences, sentences, list_filter(string_split(case when n_sentences > 0 then {ruled} else '' end, ';'), lambda x: x <> '') as parts from sequences
)
select doc_id, n_sentences, sentences, array_to_string(list_transform(list_filter(parts, lambda x: starts_with(x, '=')), lambda x: substring(x, 2)), ',') as licenses,
    array_to_string(list_filter(parts, lambda x: not starts_with(x, '=')), ',') as unruled
from ruled
"""

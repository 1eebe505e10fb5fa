"""The ordered signatures of the license scan: regular expressions over text with A-Z in lower case.

A family line gives a label, a keyword that every text with the name contains, an expression for the name, and the SPDX
identifiers. Each family makes four signatures: identifier tag, grant ("licensed under ..."), link, plain name. The
phrases of license texts and notices are written out one by one. Lower numbers have priority.

A space in an expression or in a gate word stands for any gap between words: white space, and where a line ends, the end
of a comment and the comment marks of the next line (``wrapped``). A full stop passes such gaps, each as one character.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

TAG, GRANT, TEXT, NAME = range(4)
LEVELS = 4


BLANK = r"[ \t\x0b\f]"
MARKS = r"[ \t\x0b\f\r\n*#/;%>|!\"'.-]"
LINE = rf"{BLANK}*(?:\*/{BLANK}*)?[\r\n]{MARKS}*(?:(?:rem|dnl) )?"
GAP = rf"(?:{BLANK}+|{LINE})"
ANY = rf"(?>[^ \t\x0b\f\r\n*]|{LINE}|{BLANK}+|\*)"  # one way to read each text, so that a search never explodes


def wrapped(regex: str) -> str:
    """``regex`` with its spaces as gaps; a character class that holds a space may be a gap too."""
    tokens = re.findall(r"\\.|\[(?:\\.|[^\]])*\]|.", regex)
    gap = {" ": GAP, "\\s": GAP, ".": ANY}
    return "".join(gap.get(t) or (f"(?:{t}|{GAP})" if t[0] == "[" and t[1] != "^" and " " in t else t) for t in tokens)


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    keyword: str
    regex: str
    confidence: float


#: label, keyword, name, SPDX identifier, part of an address.
FAMILIES = [
    ("mit", "mit", r"mit(?: \(?expat\)?)? licen[cs]e", r"mit", r"licenses/mit"),
    ("mit-0", "attribution", r"mit no attribution", r"mit-0", r"licenses/mit-0"),
    ("apache-1.0", "apache", r"apache (?:software )?licen[cs]e,? (?:version |v)?1\.0", r"apache-1\.0", r"license-1\.0"),
    ("apache-1.1", "apache", r"apache (?:software )?licen[cs]e,? (?:version |v)?1\.1", r"apache-1\.1", r"license-1\.1"),
    ("apache-2.0", "apache", r"apache (?:software )?licen[cs]e,? (?:version |v)?2(?:\.0)?", r"apache-2\.0", r"license-2\.0"),
    ("gpl-1.0", "general public", r"(?:gnu )?general public licen[cs]e,? (?:version |v)1(?:\.0)?", r"gpl-1\.0(?:-only|-or-later|\+)?", r"licenses/gpl-1\.0"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public licen[cs]e,? (?:version |v)2(?:\.0)?", r"gpl-2\.0(?:-only|-or-later|\+)?", r"licenses/gpl-2\.0"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public licen[cs]e,? (?:version |v)3(?:\.0)?", r"gpl-3\.0(?:-only|-or-later|\+)?", r"licenses/gpl-3\.0"),
    ("lgpl-2.0", "general public", r"(?:gnu )?library general public licen[cs]e(?:,? (?:version |v)2(?:\.0)?)?", r"lgpl-2\.0(?:-only|-or-later|\+)?", r"licenses/lgpl-2\.0"),
    ("lgpl-2.1", "general public", r"(?:gnu )?lesser general public licen[cs]e,? (?:version |v)2\.1", r"lgpl-2\.1(?:-only|-or-later|\+)?", r"licenses/lgpl-2\.1"),
    ("lgpl-3.0", "general public", r"(?:gnu )?lesser general public licen[cs]e,? (?:version |v)3(?:\.0)?", r"lgpl-3\.0(?:-only|-or-later|\+)?", r"licenses/lgpl-3\.0"),
    ("lgpl", "general public", r"(?:gnu )?lesser general public licen[cs]e", r"lgpl", r"licenses/lgpl"),
    ("agpl-3.0", "general public", r"(?:gnu )?affero general public licen[cs]e(?:,? (?:version |v)3(?:\.0)?)?", r"agpl-3\.0(?:-only|-or-later|\+)?", r"licenses/agpl"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation licen[cs]e", r"gfdl-1\.[123](?:-only|-or-later)?", r"licenses/fdl"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|bsd 2-clause|two-clause bsd|2-clause bsd) licen[cs]e", r"bsd-2-clause", r"licenses/bsd-2-clause"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|bsd 3-clause|three-clause bsd|3-clause bsd) licen[cs]e", r"bsd-3-clause", r"licenses/bsd-3-clause"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4-clause|four-clause bsd|4-clause bsd) licen[cs]e", r"bsd-4-clause", r"licenses/bsd-4-clause"),
    ("bsd-0-clause", "bsd", r"(?:zero-clause bsd|bsd zero clause|0-clause bsd) licen[cs]e", r"0bsd", r"licenses/0bsd"),
    ("bsd", "bsd", r"bsd(?:-style)? licen[cs]e", r"bsd", r"licenses/bsd-license"),
    ("isc", "isc", r"isc licen[cs]e", r"isc", r"licenses/isc"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e,? (?:version |v)?1\.1", r"mpl-1\.1", r"mpl/1\.1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[cs]e,? (?:version |v)?2\.0", r"mpl-2\.0", r"mpl/2\.0"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e", r"mpl", r"mozilla\.org/mpl"),
    ("epl-1.0", "eclipse", r"eclipse public licen[cs]e(?:,)?(?: -)? (?:version |v)?1\.0", r"epl-1\.0", r"legal/epl-v10"),
    ("epl-2.0", "eclipse", r"eclipse public licen[cs]e(?:,)?(?: -)? (?:version |v)?2\.0", r"epl-2\.0", r"legal/epl-2\.0"),
    ("cddl", "distribution", r"common development and distribution licen[cs]e", r"cddl-1\.[01]", r"licenses/cddl"),
    ("cpl-1.0", "common public", r"common public licen[cs]e", r"cpl-1\.0", r"licenses/cpl"),
    ("eupl", "european", r"european union public licen[cs]e", r"eupl-1\.[012]", r"eupl"),
    ("artistic-2.0", "artistic", r"artistic licen[cs]e,? (?:version |v)?2(?:\.0)?", r"artistic-2\.0", r"artistic-license-2"),
    ("artistic", "artistic", r"artistic licen[cs]e", r"artistic-1\.0", r"artistic-license"),
    ("bsl-1.0", "boost", r"boost software licen[cs]e(?:,? (?:version |- version )?1\.0)?", r"bsl-1\.0", r"boost\.org/license"),
    ("zlib", "zlib", r"zlib(?:/libpng)? licen[cs]e", r"zlib", r"licenses/zlib"),
    ("unlicense", "unlicense", r"the unlicense", r"unlicense", r"unlicense\.org"),
    ("wtfpl", "what the", r"do what the f\S+ you want to public licen[cs]e", r"wtfpl", r"wtfpl\.net"),
    ("python-2.0", "python", r"python software foundation licen[cs]e", r"(?:psf|python)-2\.0", r"psf/license"),
    ("php", "php", r"php licen[cs]e", r"php-3\.0[01]?", r"php\.net/license"),
    ("ruby", "ruby", r"ruby licen[cs]e", r"ruby", r"ruby-lang\.org/en/about/license"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", r"postgresql", r"licenses/postgresql"),
    ("openssl", "openssl", r"openssl licen[cs]e", r"openssl", r"openssl\.org/source/license"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e", r"ms-pl", r"licenses/ms-pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e", r"ms-rl", r"licenses/ms-rl"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[cs]e(?:,? (?:version )?1\.1)?", r"ofl-1\.1", r"scripts\.sil\.org/ofl"),
    ("odbl", "database", r"open (?:data commons open )?database licen[cs]e", r"odbl-1\.0", r"licenses/odbl"),
    ("cc0-1.0", "cc0", r"cc0(?: 1\.0)?(?: universal)?", r"cc0-1\.0", r"publicdomain/zero/1\.0"),
    ("cc-by-3.0", "cc", r"cc[ -]by[ -]3\.0", r"cc-by-3\.0", r"licenses/by/3\.0"),
    ("cc-by-4.0", "cc", r"cc[ -]by[ -]4\.0", r"cc-by-4\.0", r"licenses/by/4\.0"),
    ("cc-by-sa-3.0", "cc", r"cc[ -]by-sa[ -]3\.0", r"cc-by-sa-3\.0", r"licenses/by-sa/3\.0"),
    ("cc-by-sa-4.0", "cc", r"cc[ -]by-sa[ -]4\.0", r"cc-by-sa-4\.0", r"licenses/by-sa/4\.0"),
    ("cc-by-nd-4.0", "cc", r"cc[ -]by-nd[ -]4\.0", r"cc-by-nd-4\.0", r"licenses/by-nd/4\.0"),
    ("cc-by-nc-3.0", "cc", r"cc[ -]by-nc[ -]3\.0", r"cc-by-nc-3\.0", r"licenses/by-nc/3\.0"),
    ("cc-by-nc-4.0", "cc", r"cc[ -]by-nc[ -]4\.0", r"cc-by-nc-4\.0", r"licenses/by-nc/4\.0"),
    ("cc-by-nc-sa-4.0", "cc", r"cc[ -]by-nc-sa[ -]4\.0", r"cc-by-nc-sa-4\.0", r"licenses/by-nc-sa/4\.0"),
    ("cc-by-nc-nd-4.0", "cc", r"cc[ -]by-nc-nd[ -]4\.0", r"cc-by-nc-nd-4\.0", r"licenses/by-nc-nd/4\.0"),
    ("cc", "creative commons", r"creative commons(?: attribution)?(?:[ -](?:sharealike|noncommercial|noderivs))*(?: licen[cs]e)?", r"cc-by", r"creativecommons\.org/licenses"),
]

#: label, keyword, expression, confidence: wording of license texts and notices.
PHRASES = [
    ("mit", "permission is hereby granted", r"permission is hereby granted, free of charge, to any person obtaining a copy", 0.95),
    ("mit", "permission notice", r"the above copyright notice and this permission notice shall be included in all copies", 0.9),
    ("mit", "mit", r"(?:released|distributed|available|provided) under (?:the )?(?:terms of (?:the )?)?mit licen[cs]e", 0.95),
    ("isc", "permission to use", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose", 0.9),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms, with or without modification", 0.9),
    ("bsd-3-clause", "endorse or promote", r"neither the name of .{1,80}? may be used to endorse or promote", 0.9),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software", 0.9),
    ("bsd", "redistributions", r"redistributions (?:of source code|in binary form) must (?:retain|reproduce) the above copyright", 0.85),
    ("apache-2.0", "apache", r"licensed to the apache software foundation \(asf\) under one or more", 0.95),
    ("apache", "apache", r"(?:licensed|released|distributed) under (?:the )?apache licen[cs]e", 0.95),
    ("apache-2.0", "warranties", r"on an \"as is\" basis, without warranties or conditions of any kind", 0.85),
    ("apache-2.0", "license for the", r"see the license for the specific language governing permissions", 0.85),
    ("gpl", "general public", r"under the terms of the gnu general public licen[cs]e", 0.95),
    ("gpl", "general public", r"(?:gnu )?general public licen[cs]e", 0.9),
    ("gpl", "free software", r"this program is free software[;:,] you can redistribute it", 0.9),
    ("gpl", "any later version", r"(?:either )?version [23](?:\.0)?(?: of the license)?, or \(?at your option\)? any later version", 0.85),
    ("gpl", "gpl", r"\bgpl(?:v?[123](?:\.0)?)?\b", 0.7),
    ("lgpl", "lgpl", r"\blgpl(?:v?[23](?:\.[01])?)?\b", 0.7),
    ("agpl-3.0", "agpl", r"\bagpl(?:v?3(?:\.0)?)?\b", 0.7),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public licen[cs]e", 0.95),
    ("epl-2.0", "eclipse", r"made available under the terms of the eclipse public licen[cs]e", 0.9),
    ("zlib", "provided 'as-is'", r"this software is provided 'as-is', without any express or implied warranty", 0.85),
    ("zlib", "plainly marked", r"altered source versions must be plainly marked as such", 0.85),
    ("bsl-1.0", "boost", r"distributed under the boost software licen[cs]e", 0.95),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", 0.95),
    ("public-domain", "public domain", r"(?:released|placed|dedicated) (?:in)?to the public domain", 0.85),
    ("public-domain", "public domain", r"\bpublic domain\b", 0.5),
    ("cc0-1.0", "waived", r"has waived all copyright and related or neighboring rights", 0.9),
    ("cc-by", "creative commons", r"creative commons attribution(?: [0-9]\.[0-9])?(?: international| unported)? licen[cs]e", 0.9),
    ("cc-by-sa", "sharealike", r"creative commons attribution-?\s?sharealike", 0.9),
    ("cc-by-nc", "noncommercial", r"creative commons attribution-?\s?noncommercial", 0.9),
    ("cc-by-nc", "cc", r"licensed under (?:a )?cc[ -]by-nc", 0.9),
    ("cc-by", "cc", r"licensed under (?:a )?cc[ -]by(?![-a-z])", 0.9),
    ("proprietary", "rights reserved", r"all rights reserved", 0.6),
    ("proprietary", "proprietary", r"proprietary and confidential", 0.8),
    ("proprietary", "prohibited", r"unauthori[sz]ed (?:copying|use|reproduction|distribution)[^.]{0,80} (?:is )?(?:strictly )?prohibited", 0.8),
    ("proprietary", "agreement", r"end[- ]user licen[cs]e agreement", 0.7),
    ("proprietary", "commercial licen", r"(?:under|with) a commercial licen[cs]e", 0.7),
    ("non-commercial", "use only", r"for (?:non-?commercial|personal) use only", 0.7),
    ("non-commercial", "commercial", r"may not be used for commercial purposes", 0.7),
    ("notice", "copyright", r"copyright (?:\(c\)|©)? ?(?:19|20)[0-9]{2}", 0.5),
    ("notice", "warranty", r"without (?:any )?warranty of any kind", 0.5),
    ("notice", "merchantability", r"merchantability(?: and|,| or) fitness for a particular purpose", 0.5),
]


def rules() -> list[Rule]:
    out = []
    for label, keyword, name, spdx, link in FAMILIES:
        out += [
            Rule(TAG, label, "spdx-license-identifier", rf"spdx-license-identifier: ?\(?{spdx}(?![-.\w])", 1.0),
            Rule(GRANT, label, keyword, rf"(?:licen[cs]ed|released|distributed|available|published) under (?:the |a )?(?:terms of the )?{name}", 0.95),
            Rule(TEXT, label, "://", rf"https?://\S{{0,60}}{link}", 0.9),
            Rule(NAME, label, keyword, rf"\b{name}", 0.8),
        ]
    out += [Rule(TEXT, label, keyword, regex, confidence) for label, keyword, regex, confidence in PHRASES]
    return out


#: Every match of every rule lies in a text that contains one of these.
GATE = [
    "licen", "copyright", "permission", "redistribut", "gpl", "public domain", "warrant", "rights reserved",
    "commercial", "proprietary", "prohibited", "creative commons", "creativecommons", "cc by", "cc-by", "cc0",
    "mit no attribution", "use only", "advertising", "free software", "later version", "unencumbered", "mozilla.org/mpl",
    "legal/epl", "marked as such", "as-is", "endorse", "merchantability", "waived", "eupl", "scripts.sil.org", "wtfpl",
    "publicdomain", "mpl/",
]

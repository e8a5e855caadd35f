"""License signature rules: patterns over lower-case words that single spaces part.

A rule names a label, a priority, the words of which one must be present before
the pattern is tried, and the pattern. Each licence gives its titles, its tag and
its address; the sentence forms are common to all.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    keywords: frozenset[bytes]
    pattern: re.Pattern


#: label; titles, most specific first ("?" marks an optional word); identifier words of a tag; words of an address.
LICENSES: tuple[tuple[str, tuple[str, ...], str, str], ...] = (
    ("mit", ("mit license", "expat license", "mit"), "mit", "opensource org licenses mit"),
    ("mit-0", ("mit no attribution license", "mit 0"), "mit 0", "opensource org licenses mit 0"),
    ("apache-2", ("apache license version 2 0?", "apache software license 2 0?", "apache 2 0 license", "apache 2"), "apache 2 0", "apache org licenses license 2 0"),
    ("apache-1.1", ("apache software license version 1 1", "apache license 1 1"), "apache 1 1", "apache org licenses license 1 1"),
    ("bsd-2", ("bsd 2 clause simplified? license", "simplified bsd license", "freebsd license"), "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    ("bsd-3", ("bsd 3 clause new? license", "new bsd license", "modified bsd license", "revised bsd license"), "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    ("bsd-4", ("bsd 4 clause license", "original bsd license"), "bsd 4 clause", "spdx org licenses bsd 4 clause"),
    ("0bsd", ("bsd zero clause license", "zero clause bsd", "0bsd"), "0bsd", "opensource org licenses 0bsd"),
    ("isc", ("isc license", "internet systems consortium license"), "isc", "opensource org licenses isc"),
    ("gpl-1", ("gnu general public license version 1", "gpl v1"), "gpl 1 0", "gnu org licenses old licenses gpl 1 0"),
    ("gpl-2", ("gnu general public license version 2", "gnu gpl version 2", "gplv2", "gpl v2"), "gpl 2 0", "gnu org licenses old licenses gpl 2 0"),
    ("gpl-3", ("gnu general public license version 3", "gnu gpl version 3", "gplv3", "gpl v3"), "gpl 3 0", "gnu org licenses gpl 3 0"),
    ("gpl", ("gnu general public license", "gnu gpl", "gnu public license"), "gpl", "gnu org licenses gpl"),
    ("lgpl-2", ("gnu library general public license version 2", "lgpl v2"), "lgpl 2 0", "gnu org licenses old licenses lgpl 2 0"),
    ("lgpl-2.1", ("gnu lesser general public license version 2 1", "lgpl v2 1"), "lgpl 2 1", "gnu org licenses old licenses lgpl 2 1"),
    ("lgpl-3", ("gnu lesser general public license version 3", "lgplv3", "lgpl v3"), "lgpl 3 0", "gnu org licenses lgpl 3 0"),
    ("lgpl", ("gnu lesser general public license", "gnu library general public license", "gnu lgpl"), "lgpl", "gnu org licenses lgpl"),
    ("agpl-3", ("gnu affero general public license version 3", "agplv3", "agpl v3"), "agpl 3 0", "gnu org licenses agpl 3 0"),
    ("agpl", ("gnu affero general public license", "affero general public license", "gnu agpl"), "agpl", "gnu org licenses agpl"),
    ("gfdl", ("gnu free documentation license", "gfdl"), "gfdl 1 3", "gnu org licenses fdl"),
    ("mpl-1.1", ("mozilla public license version 1 1", "mpl 1 1"), "mpl 1 1", "mozilla org mpl mpl 1 1"),
    ("mpl-2", ("mozilla public license version? 2 0", "mpl 2 0"), "mpl 2 0", "mozilla org mpl 2 0"),
    ("epl-1", ("eclipse public license version? v? 1 0", "epl 1 0"), "epl 1 0", "eclipse org legal epl v10"),
    ("epl-2", ("eclipse public license version? v? 2 0", "epl 2 0"), "epl 2 0", "eclipse org legal epl 2 0"),
    ("edl-1", ("eclipse distribution license version? v? 1 0", "edl 1 0"), "edl 1 0", "eclipse org org documents edl v10"),
    ("cddl-1", ("common development and distribution license version? 1 0", "cddl 1 0"), "cddl 1 0", "opensource org licenses cddl 1 0"),
    ("cpl-1", ("common public license version? 1 0", "cpl 1 0"), "cpl 1 0", "opensource org licenses cpl 1 0"),
    ("ipl-1", ("ibm public license version? 1 0", "ipl 1 0"), "ipl 1 0", "opensource org licenses ipl 1 0"),
    ("artistic-1", ("artistic license version? 1 0",), "artistic 1 0", "opensource org licenses artistic 1 0"),
    ("artistic-2", ("artistic license version? 2 0", "perl artistic license 2 0?"), "artistic 2 0", "opensource org licenses artistic 2 0"),
    ("bsl-1", ("boost software license version? 1 0", "boost license 1 0"), "bsl 1 0", "boost org license 1 0"),
    ("zlib", ("zlib license", "zlib libpng license"), "zlib", "opensource org licenses zlib"),
    ("libpng", ("libpng license version? 2?",), "libpng 2 0", "libpng org pub png src libpng license"),
    ("unlicense", ("the unlicense", "unlicense"), "unlicense", "unlicense org"),
    ("wtfpl", ("do what the fuck you want to public license", "wtfpl"), "wtfpl", "wtfpl net"),
    ("cc0", ("creative commons zero version? 1? 0?", "cc0 1 0 universal", "cc0"), "cc0 1 0", "creativecommons org publicdomain zero"),
    ("cc-by", ("creative commons attribution", "cc by"), "cc by 4 0", "creativecommons org licenses by"),
    ("cc-by-sa", ("creative commons attribution share alike", "creative commons attribution sharealike", "cc by sa"), "cc by sa 4 0", "creativecommons org licenses by sa"),
    ("cc-by-nc", ("creative commons attribution non commercial", "creative commons attribution noncommercial", "cc by nc"), "cc by nc 4 0", "creativecommons org licenses by nc"),
    ("cc-by-nd", ("creative commons attribution no derivatives", "creative commons attribution noderivatives", "cc by nd"), "cc by nd 4 0", "creativecommons org licenses by nd"),
    ("cc-by-nc-sa", ("creative commons attribution noncommercial sharealike", "cc by nc sa"), "cc by nc sa 4 0", "creativecommons org licenses by nc sa"),
    ("cc-by-nc-nd", ("creative commons attribution noncommercial noderivatives", "cc by nc nd"), "cc by nc nd 4 0", "creativecommons org licenses by nc nd"),
    ("cc-sampling", ("creative commons sampling plus?", "cc sampling"), "cc sampling 1 0", "creativecommons org licenses sampling"),
    ("pdm", ("public domain mark 1? 0?",), "pdm 1 0", "creativecommons org publicdomain mark"),
    ("odbl", ("open database license version? 1? 0?", "odbl 1 0"), "odbl 1 0", "opendatacommons org licenses odbl"),
    ("odc-by", ("open data commons attribution license", "odc by"), "odc by 1 0", "opendatacommons org licenses by"),
    ("pddl", ("public domain dedication and license", "pddl 1 0"), "pddl 1 0", "opendatacommons org licenses pddl"),
    ("cdla-permissive", ("community data license agreement permissive",), "cdla permissive 2 0", "cdla dev permissive"),
    ("cdla-sharing", ("community data license agreement sharing",), "cdla sharing 1 0", "cdla dev sharing"),
    ("ogl-uk", ("open government licen[cs]e", "open government licence v3 0"), "ogl uk 3 0", "nationalarchives gov uk doc open government licence"),
    ("etalab", ("licence ouverte", "etalab open license"), "etalab 2 0", "etalab gouv fr licence ouverte"),
    ("dl-de-by", ("datenlizenz deutschland namensnennung",), "dl de by 2 0", "govdata de dl de by"),
    ("eupl", ("european union public licen[cs]e", "eupl v? 1 2"), "eupl 1 2", "joinup ec europa eu eupl"),
    ("cecill", ("cecill free software license", "cecill b", "cecill c"), "cecill 2 1", "cecill info licences"),
    ("ofl", ("sil open font license version? 1? 1?", "open font license"), "ofl 1 1", "scripts sil org ofl"),
    ("psf", ("python software foundation license version? 2?", "psf license"), "psf 2 0", "python org license"),
    ("php", ("php license version? 3? 0?1?",), "php 3 01", "php net license"),
    ("ruby", ("ruby license",), "ruby", "ruby lang org en about license"),
    ("openssl", ("openssl license", "ssleay license"), "openssl", "openssl org source license"),
    ("postgresql", ("postgresql license",), "postgresql", "opensource org licenses postgresql"),
    ("ms-pl", ("microsoft public license", "ms pl"), "ms pl", "opensource org licenses ms pl"),
    ("ms-rl", ("microsoft reciprocal license", "ms rl"), "ms rl", "opensource org licenses ms rl"),
    ("ncsa", ("university of illinois ncsa open source license", "ncsa license"), "ncsa", "opensource org licenses ncsa"),
    ("w3c", ("w3c software notice and license", "w3c license"), "w3c", "w3 org consortium legal copyright software"),
    ("x11", ("x11 license", "x consortium license"), "x11", "spdx org licenses x11"),
    ("osl-3", ("open software license version? 3 0",), "osl 3 0", "opensource org licenses osl 3 0"),
    ("afl-3", ("academic free license version? 3 0",), "afl 3 0", "opensource org licenses afl 3 0"),
    ("upl", ("universal permissive license version? 1? 0?",), "upl 1 0", "opensource org licenses upl"),
    ("busl", ("business source license version? 1? 1?", "busl 1 1"), "busl 1 1", "mariadb com bsl11"),
    ("sspl", ("server side public license version? 1?", "sspl v1"), "sspl 1 0", "mongodb com licensing server side public license"),
    ("elastic-2", ("elastic license version? 2 0",), "elastic 2 0", "elastic co licensing elastic license"),
    ("polyform-nc", ("polyform noncommercial license 1? 0?",), "polyform noncommercial 1 0 0", "polyformproject org licenses noncommercial"),
    ("openrail", ("creativeml open rail m license", "openrail license", "bigscience openrail m"), "openrail", "licenses ai"),
    ("beerware", ("beer ware license", "beerware"), "beerware", "spdx org licenses beerware"),
)

#: Sentences that say something about rights without naming a licence: label, keyword, pattern.
SENTENCES: tuple[tuple[str, str, str], ...] = (
    ("all-rights-reserved", "reserved", "all rights reserved"),
    ("all-rights-reserved", "reproduced", "no part of this (publication|work|document) may be reproduced"),
    ("public-domain", "domain", "(released|dedicated|placed|is) (in|into|to) the public domain"),
    ("public-domain", "domain", "this (work|text|software|document) is (in the )?public domain"),
    ("proprietary", "proprietary", "proprietary and confidential"),
    ("proprietary", "confidential", "confidential and proprietary"),
    ("proprietary", "unauthorized", "unauthorized (copying|use|reproduction|distribution)( or (copying|use|reproduction|distribution))? (of|is)"),
    ("mit", "charge", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "noninfringement", "fitness for a particular purpose and noninfringement in no event shall the authors"),
    ("isc", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3", "endorse", "may be used to endorse or promote products derived from this software"),
    ("bsd-4", "acknowledgement", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("apache-2", "compliance", "you may not use this file except in compliance with the license"),
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("zlib", "altered", "altered source versions must be plainly marked as such"),
    ("bsl-1", "derivative", "to use reproduce display distribute execute and transmit the software and to prepare derivative works"),
    ("wtfpl", "fuck", "you just do what the fuck you want to"),
)

GRANT = rb"(?:licensed|released|distributed|available|published|covered|provided|shared|issued|made available) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?(?:a )?"


def _words(phrase: str) -> bytes:
    """Pattern of a phrase; a word ending in ? may be absent."""
    out = ""
    for word in phrase.split():
        out += f"(?: {word[:-1]})?" if word.endswith("?") else f" {word}"
    return out.strip().encode()


def _keyword(phrase: str) -> frozenset[bytes]:
    """The phrase's longest plain word."""
    plain = [w for w in phrase.split() if w.isalnum()]
    return frozenset([max(plain, key=len).encode()])


def _rule(label: str, priority: int, keywords: frozenset[bytes], pattern: bytes) -> Rule:
    return Rule(label, priority, keywords, re.compile(rb"(?<![^ ])" + pattern + rb"(?![^ ])"))


def rules() -> list[Rule]:
    """All rules, the higher priority first."""
    out = []
    for label, titles, tag, address in LICENSES:
        out.append(_rule(label, 100, frozenset([b"spdx"]), rb"spdx license identifier " + _words(tag)))
        out.append(_rule(label, 90, _keyword(address), _words(address)))
        out.append(_rule(label, 70, frozenset([b"license", b"licence"]), rb"licen[cs]e " + _words(tag)))
        for title in titles:
            out.append(_rule(label, 80, _keyword(title), GRANT + _words(title) + rb"(?: licen[cs]e)?"))
            if len(title.split()) > 1:
                out.append(_rule(label, 60, _keyword(title), _words(title)))
    out += [_rule(label, 85, frozenset([keyword.encode()]), text.encode()) for label, keyword, text in SENTENCES]
    return sorted(out, key=lambda r: -r.priority)

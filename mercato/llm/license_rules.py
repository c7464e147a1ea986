"""Licence signatures: one row per licence, from which the scan builds its ordered rules."""

from __future__ import annotations

from typing import NamedTuple


class Licence(NamedTuple):
    """`name` is a regular expression over lower-case words joined by one space.

    `keywords`, parted by spaces, are words of which each match of `name` holds one; `spdx` is the
    identifier's words.
    `plain` names say nothing alone ("mit", "x11") and are not reported without a context.
    """

    label: str
    keywords: str
    name: str
    spdx: str
    plain: bool = False


V = r"(?: (?:version|v))?"

LICENCES = (
    Licence("apache-1.1", "apache", rf"apache(?: software)?(?: licen[cs]e)?{V} 1 1", "apache 1 1"),
    Licence("apache-2.0", "apache", rf"apache(?: software)?(?: licen[cs]e)?{V} 2(?: 0)?", "apache 2 0"),
    Licence("apache", "apache", r"apache(?: software)?(?: foundation)?", "apache", True),
    Licence("mit", "mit", r"mit(?: x11)?(?: style)?", "mit", True),
    Licence("mit-0", "mit", r"mit(?: 0| no attribution)", "mit 0"),
    Licence("isc", "isc", r"isc", "isc", True),
    Licence("x11", "x11", r"x11", "x11", True),
    Licence("bsd-2-clause", "bsd freebsd", r"(?:simplified bsd|freebsd|bsd(?: 2| two) clause)", "bsd 2 clause"),
    Licence(
        "bsd-3-clause", "bsd", r"(?:(?:new|modified|revised) bsd|bsd(?: 3| three) clause)", "bsd 3 clause"
    ),
    Licence("bsd-4-clause", "bsd", r"(?:original bsd|bsd(?: 4| four) clause)", "bsd 4 clause"),
    Licence("0bsd", "0bsd zero", r"(?:0bsd|zero clause bsd)", "0bsd"),
    Licence("bsd", "bsd", r"bsd(?: style)?", "bsd", True),
    Licence(
        "gpl-2.0", "gpl gplv2", rf"(?:gnu )?gpl(?:v2|{V} 2(?: 0)?)(?: only| or later)?", "gpl 2 0(?: only| or later)?"
    ),
    Licence(
        "gpl-3.0", "gpl gplv3", rf"(?:gnu )?gpl(?:v3|{V} 3(?: 0)?)(?: only| or later)?", "gpl 3 0(?: only| or later)?"
    ),
    Licence("gpl", "gpl", r"(?:gnu )?gpl", "gpl"),
    Licence("gpl-1.0", "general", rf"(?:gnu )?general public licen[cs]e{V} 1(?: 0)?", "gpl 1 0(?: only)?"),
    Licence("gpl-2.0", "general", rf"(?:gnu )?general public licen[cs]e{V} 2(?: 0)?", "gplv2"),
    Licence("gpl-3.0", "general", rf"(?:gnu )?general public licen[cs]e{V} 3(?: 0)?", "gplv3"),
    Licence("gpl", "general", r"(?:gnu )?general public licen[cs]e", "gpl any"),
    Licence("lgpl-2.1", "lgpl lgplv2", rf"(?:gnu )?lgpl(?:v2 1|{V} 2 1)", "lgpl 2 1(?: only| or later)?"),
    Licence("lgpl-3.0", "lgpl lgplv3", rf"(?:gnu )?lgpl(?:v3|{V} 3(?: 0)?)", "lgpl 3 0(?: only| or later)?"),
    Licence("lgpl", "lgpl", r"(?:gnu )?lgpl", "lgpl"),
    Licence("lgpl", "lesser library", r"(?:gnu )?(?:lesser|library) general public licen[cs]e", "lgpl any"),
    Licence("lgpl-2.1", "lesser", rf"(?:gnu )?lesser general public licen[cs]e{V} 2 1", "lgplv2 1"),
    Licence("lgpl-3.0", "lesser", rf"(?:gnu )?lesser general public licen[cs]e{V} 3(?: 0)?", "lgplv3"),
    Licence("agpl-3.0", "agpl agplv3", rf"(?:gnu )?agpl(?:v3|{V} 3(?: 0)?)", "agpl 3 0(?: only| or later)?"),
    Licence("agpl", "agpl", r"(?:gnu )?agpl", "agpl"),
    Licence("agpl-3.0", "affero", rf"(?:gnu )?affero general public licen[cs]e(?:{V} 3(?: 0)?)?", "agplv3"),
    Licence("gfdl", "documentation", rf"(?:gnu )?free documentation licen[cs]e(?:{V} 1 [1-3])?", "gfdl 1 [1-3]"),
    Licence("mpl-1.1", "mozilla", rf"mozilla public licen[cs]e{V} 1 1", "mpl 1 1"),
    Licence("mpl-2.0", "mozilla", rf"mozilla public licen[cs]e{V} 2(?: 0)?", "mpl 2 0"),
    Licence("mpl", "mozilla", r"mozilla public licen[cs]e", "mpl"),
    Licence("epl-1.0", "eclipse", rf"eclipse public licen[cs]e{V} 1(?: 0)?", "epl 1 0"),
    Licence("epl-2.0", "eclipse", rf"eclipse public licen[cs]e{V} 2(?: 0)?", "epl 2 0"),
    Licence("epl", "eclipse", r"eclipse public licen[cs]e", "epl"),
    Licence("edl-1.0", "eclipse", rf"eclipse distribution licen[cs]e(?:{V} 1(?: 0)?)?", "edl 1 0"),
    Licence("cddl-1.0", "cddl", rf"cddl(?:{V} 1(?: [01])?)?", "cddl 1 [01]"),
    Licence("cddl-1.0", "common", r"common development and distribution licen[cs]e", "cddl"),
    Licence("cpl-1.0", "common", rf"common public licen[cs]e(?:{V} 1(?: 0)?)?", "cpl 1 0"),
    Licence("eupl", "european", rf"european union public licen[cs]e(?:{V} 1 [0-2])?", "eupl 1 [0-2]"),
    Licence("artistic", "artistic", rf"artistic licen[cs]e(?:{V} [12] 0)?", "artistic [12] 0"),
    Licence("bsl-1.0", "boost", rf"boost software licen[cs]e(?:{V} 1(?: 0)?)?", "bsl 1 0"),
    Licence("zlib", "zlib", r"zlib(?: libpng)?", "zlib", True),
    Licence("unlicense", "unlicense", r"unlicense", "unlicense"),
    Licence("wtfpl", "wtfpl", r"wtfpl", "wtfpl"),
    Licence("beerware", "beerware", r"beerware", "beerware"),
    Licence("psf-2.0", "python", r"python software foundation licen[cs]e", "psf 2 0"),
    Licence("ofl-1.1", "open", rf"(?:sil )?open font licen[cs]e(?:{V} 1 [01])?", "ofl 1 1"),
    Licence("odbl-1.0", "database", r"open database licen[cs]e", "odbl 1 0"),
    Licence("odc-by", "attribution", r"open data commons attribution licen[cs]e", "odc by 1 0"),
    Licence("ms-pl", "microsoft", r"microsoft public licen[cs]e", "ms pl"),
    Licence("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e", "ms rl"),
    Licence("openssl", "openssl", r"openssl", "openssl", True),
    Licence("php-3.01", "php", rf"php licen[cs]e(?:{V} 3 01)?", "php 3 01"),
    Licence("ruby", "ruby", r"ruby", "ruby", True),
    Licence("postgresql", "postgresql", r"postgresql", "postgresql", True),
    Licence("ncsa", "ncsa", r"(?:university of illinois )?ncsa", "ncsa", True),
    Licence("afl-3.0", "academic", r"academic free licen[cs]e", "afl 3 0"),
    Licence("osl-3.0", "open", r"open software licen[cs]e", "osl 3 0"),
    Licence("busl-1.1", "business", r"business source licen[cs]e", "busl 1 1"),
    Licence("sspl-1.0", "server", r"server side public licen[cs]e", "sspl 1 0"),
    Licence("cc0-1.0", "cc0", r"(?:creative commons )?cc0(?: 1 0)?", "cc0 1 0"),
    Licence("cc-by", "cc", r"cc by(?: [1-4] [05])?", "cc by [1-4] [05]"),
    Licence("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?", "cc by sa [1-4] [05]"),
    Licence("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?", "cc by nc [1-4] [05]"),
    Licence("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?", "cc by nd [1-4] [05]"),
    Licence("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?", "cc by nc sa [1-4] [05]"),
    Licence("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?", "cc by nc nd [1-4] [05]"),
    Licence("cc-by", "creative", r"creative commons attribution(?: [1-4] [05])?", "creative commons by"),
    Licence("cc-by-sa", "creative", r"creative commons attribution share ?alike", "creative commons by sa"),
    Licence("cc-by-nc", "creative", r"creative commons attribution non ?commercial", "creative commons by nc"),
    Licence("cc-by-nd", "creative", r"creative commons attribution no ?deriv\w*", "creative commons by nd"),
    Licence("cc", "creative", r"creative commons", "creative commons", True),
    Licence("public-domain", "public", r"public domain", "public domain"),
)

# Sentences that stand in licence texts and notices: label, keywords, expression, weight.
SENTENCES = (
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy", 1.0),
    ("isc", "permission", r"permission to use copy modify and(?: or)? distribute this software", 0.9),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms", 1.0),
    ("gpl", "redistribute", r"free software you can redistribute it and or modify it", 0.9),
    ("no-warranty", "warranty warranties", r"without(?: any)? warrant(?:y|ies)(?: or conditions)? of any kind", 0.5),
    ("no-warranty", "warranties", r"without(?: any)? warranties(?: or conditions)? of any kind", 0.5),
    ("copyright", "copyright", r"copyright(?: c)?(?: (?:19|20)\d\d)+", 0.6),
    ("copyright", "copyrighted", r"copyrighted (?:work|material|content)s?", 0.5),
    ("reserved", "reserved", r"all rights(?: are)? reserved", 0.9),
    ("reserved", "reserved", r"(?:some|no) rights reserved", 0.6),
    ("non-commercial", "commercial", r"(?:for )?non commercial (?:use|purposes?) only", 0.6),
    ("proprietary", "proprietary", r"proprietary and confidential", 0.7),
    ("copyleft", "copyleft", r"copyleft", 0.5),
    ("licensed", "licensed licenced", r"licen[cs]ed under", 0.3),
    ("licensed", "license licence", r"(?:see|under) the licen[cs]e(?: file)?", 0.3),
)

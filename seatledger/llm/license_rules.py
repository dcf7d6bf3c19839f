"""The written rules of the license scan: families of names, and sentences."""

from __future__ import annotations

# Public licenses as label, SPDX identifiers, names as written in prose, address.
FAMILIES = (
    ("mit", "MIT MIT-0 X11", "mit|expat|x11", "opensource.org/licenses/mit"),
    ("apache", "Apache-1.0 Apache-1.1 Apache-2.0", "apache(?: software)?", "apache.org/licenses"),
    ("gpl", "GPL-1.0 GPL-2.0 GPL-3.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later", r"(?:gnu )?general public|(?:gnu )?gpl", "gnu.org/licenses/gpl"),
    ("lgpl", "LGPL-2.0 LGPL-2.1 LGPL-3.0 LGPL-2.1-or-later LGPL-3.0-or-later", r"(?:gnu )?(?:lesser|library) general public|(?:gnu )?lgpl", "gnu.org/licenses/lgpl"),
    ("agpl", "AGPL-1.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later", r"(?:gnu )?affero general public|(?:gnu )?agpl", "gnu.org/licenses/agpl"),
    ("bsd-2-clause", "BSD-2-Clause BSD-2-Clause-Patent", r"(?:simplified|freebsd|2-clause|two-clause) bsd|bsd 2-clause", "opensource.org/licenses/bsd-2-clause"),
    ("bsd-3-clause", "BSD-3-Clause BSD-3-Clause-Clear", r"(?:new|modified|revised|3-clause|three-clause) bsd|bsd 3-clause", "opensource.org/licenses/bsd-3-clause"),
    ("bsd", "BSD-4-Clause 0BSD", r"bsd(?:-style)?", "opensource.org/licenses/bsd"),
    ("mpl", "MPL-1.0 MPL-1.1 MPL-2.0", r"mozilla public|mpl", "mozilla.org/mpl"),
    ("epl", "EPL-1.0 EPL-2.0", r"eclipse public|epl", "eclipse.org/legal/epl"),
    ("cddl", "CDDL-1.0 CDDL-1.1", r"common development and distribution|cddl", "opensource.org/licenses/cddl"),
    ("cpl", "CPL-1.0", r"common public", "opensource.org/licenses/cpl"),
    ("isc", "ISC", r"isc", "opensource.org/licenses/isc"),
    ("zlib", "Zlib zlib-acknowledgement", r"zlib(?:/libpng)?", "zlib.net/zlib_license"),
    ("libpng", "Libpng libpng-2.0", r"libpng", "libpng.org/pub/png/src/libpng-license"),
    ("boost", "BSL-1.0", r"boost software", "boost.org/license"),
    ("artistic", "Artistic-1.0 Artistic-2.0", r"artistic", "opensource.org/licenses/artistic"),
    ("unlicense", "Unlicense", r"the unlicense|unlicense", "unlicense.org"),
    ("wtfpl", "WTFPL", r"do what the fuck you want to public|wtfpl", "wtfpl.net"),
    ("cc0", "CC0-1.0", r"cc0|creative commons zero", "creativecommons.org/publicdomain/zero"),
    ("cc-by", "CC-BY-1.0 CC-BY-2.0 CC-BY-2.5 CC-BY-3.0 CC-BY-4.0", r"cc[ -]by(?![ -](?:nc|sa|nd))|creative commons attribution(?![ -](?:non|share|no))", "creativecommons.org/licenses/by/"),
    ("cc-by-sa", "CC-BY-SA-1.0 CC-BY-SA-2.0 CC-BY-SA-3.0 CC-BY-SA-4.0", r"cc[ -]by[ -]sa|creative commons attribution[ -]share[ -]?alike", "creativecommons.org/licenses/by-sa/"),
    ("cc-by-nc", "CC-BY-NC-1.0 CC-BY-NC-2.0 CC-BY-NC-3.0 CC-BY-NC-4.0", r"cc[ -]by[ -]nc(?![ -](?:sa|nd))|creative commons attribution[ -]non[ -]?commercial(?![ -](?:share|no))", "creativecommons.org/licenses/by-nc/"),
    ("cc-by-nc-sa", "CC-BY-NC-SA-3.0 CC-BY-NC-SA-4.0", r"cc[ -]by[ -]nc[ -]sa|creative commons attribution[ -]non[ -]?commercial[ -]share[ -]?alike", "creativecommons.org/licenses/by-nc-sa/"),
    ("cc-by-nd", "CC-BY-ND-3.0 CC-BY-ND-4.0", r"cc[ -]by[ -]nd|creative commons attribution[ -]no[ -]?deriv", "creativecommons.org/licenses/by-nd/"),
    ("cc-by-nc-nd", "CC-BY-NC-ND-3.0 CC-BY-NC-ND-4.0", r"cc[ -]by[ -]nc[ -]nd|creative commons attribution[ -]non[ -]?commercial[ -]no[ -]?deriv", "creativecommons.org/licenses/by-nc-nd/"),
    ("odbl", "ODbL-1.0", r"open database|odbl", "opendatacommons.org/licenses/odbl"),
    ("odc-by", "ODC-By-1.0", r"open data commons attribution|odc-by", "opendatacommons.org/licenses/by"),
    ("pddl", "PDDL-1.0", r"public domain dedication and|pddl", "opendatacommons.org/licenses/pddl"),
    ("ofl", "OFL-1.0 OFL-1.1", r"(?:sil )?open font|ofl", "scripts.sil.org/ofl"),
    ("python", "PSF-2.0 Python-2.0", r"python software foundation|psf", "python.org/psf/license"),
    ("php", "PHP-3.0 PHP-3.01", r"php", "php.net/license"),
    ("ruby", "Ruby", r"ruby", "ruby-lang.org/en/about/license"),
    ("openssl", "OpenSSL", r"openssl", "openssl.org/source/license"),
    ("postgresql", "PostgreSQL", r"postgresql", "opensource.org/licenses/postgresql"),
    ("ncsa", "NCSA", r"university of illinois/ncsa|ncsa", "opensource.org/licenses/ncsa"),
    ("ms-pl", "MS-PL", r"microsoft public|ms-pl", "opensource.org/licenses/ms-pl"),
    ("ms-rl", "MS-RL", r"microsoft reciprocal|ms-rl", "opensource.org/licenses/ms-rl"),
    ("eupl", "EUPL-1.0 EUPL-1.1 EUPL-1.2", r"european union public|eupl", "joinup.ec.europa.eu/collection/eupl"),
    ("cecill", "CECILL-1.0 CECILL-2.0 CECILL-2.1 CECILL-B CECILL-C", r"cecill(?:-[bc])?", "cecill.info/licences"),
    ("osl", "OSL-1.0 OSL-2.0 OSL-3.0", r"open software", "opensource.org/licenses/osl"),
    ("afl", "AFL-1.1 AFL-2.0 AFL-3.0", r"academic free|afl", "opensource.org/licenses/afl"),
    ("apsl", "APSL-1.0 APSL-2.0", r"apple public source|apsl", "opensource.apple.com/apsl"),
    ("qpl", "QPL-1.0", r"q public|qpl", "opensource.org/licenses/qpl"),
    ("sleepycat", "Sleepycat", r"sleepycat", "opensource.org/licenses/sleepycat"),
    ("vim", "Vim", r"vim", "vimhelp.org/uganda"),
    ("upl", "UPL-1.0", r"universal permissive|upl", "oss.oracle.com/licenses/upl"),
    ("w3c", "W3C W3C-19980720", r"w3c(?: software)?", "w3.org/consortium/legal"),
    ("gfdl", "GFDL-1.1 GFDL-1.2 GFDL-1.3", r"(?:gnu )?free documentation|gfdl", "gnu.org/licenses/fdl"),
    ("sspl", "SSPL-1.0", r"server side public|sspl", "mongodb.com/licensing/server-side-public-license"),
    ("busl", "BUSL-1.1", r"business source|busl", "mariadb.com/bsl"),
    ("elastic", "Elastic-2.0", r"elastic", "elastic.co/licensing/elastic-license"),
    ("llama", "Llama-2 Llama-3", r"llama (?:2|3)(?:\.\d)? community", "llama.meta.com/llama"),
    ("openrail", "OpenRAIL OpenRAIL-M", r"(?:creativeml )?openrail(?:-m)?", "huggingface.co/spaces/bigscience/license"),
)

# Sentences of license texts, grants and notices, as label, keyword, pattern. A space stands for white space of any kind.
SENTENCES = (
    # MIT and its kin
    ("mit", "permission is hereby granted", r"permission is hereby granted,? free of charge,? to any person obtaining a copy"),
    ("mit", "without restriction", r"deal in the software without restriction"),
    ("mit", "the above copyright notice", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("mit", "substantial portions", r"in all copies or substantial portions of the software"),
    ("mit", "the software is provided", r"the software is provided [\"'`]{0,2}as is[\"'`]{0,2},? without warranty of any kind"),
    ("mit", "noninfringement", r"fitness for a particular purpose and noninfringement"),
    ("x11", "x consortium", r"the name of the x consortium shall not be used in advertising"),
    # Apache
    ("apache", "limitations under the license", r"see the license for the specific language governing permissions and limitations under the license"),
    ("apache", "in compliance with the license", r"you may not use this file except in compliance with the license"),
    ("apache", "apache license", r"licensed under the apache license,? version 2\.0"),
    ("apache", "contributor license agreements", r"licensed to the apache software foundation \(asf\) under one or more contributor license agreements"),
    ("apache", "distributed on an", r"distributed on an [\"'`]{0,2}as is[\"'`]{0,2} basis,? without warranties or conditions of any kind"),
    ("apache", "each contributor hereby grants", r"subject to the terms and conditions of this license,? each contributor hereby grants to you a perpetual,? worldwide"),
    ("apache", "apache software foundation", r"this product includes software developed by the apache software foundation"),
    # GNU
    ("gpl", "free software foundation", r"under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "redistribute it", r"this program is free software[:;,] you can redistribute it and/or modify"),
    ("gpl", "general public license for more details", r"see the gnu general public license for more details"),
    ("gpl", "copy of the gnu general public license", r"you should have received a copy of the gnu general public license"),
    ("gpl", "any later version", r"either version [123] of the license,? or \(?at your option\)? any later version"),
    ("gpl", "everyone is permitted", r"everyone is permitted to copy and distribute verbatim copies of this license document"),
    ("gpl", "gpl version", r"\bgpl,? (?:version |v\.? ?)[123]\b"),
    ("gpl", "linking exception", r"\bgpl[^\n]{0,60}(?:linking|classpath) exception"),
    ("lgpl", "free software foundation", r"under the terms of the gnu (?:lesser|library) general public license as published by the free software foundation"),
    ("lgpl", "lesser general public license", r"see the gnu lesser general public license for more details"),
    ("lgpl", "library general public license", r"see the gnu library general public license for more details"),
    ("lgpl", "redistribute it", r"this library is free software[:;,] you can redistribute it and/or modify"),
    ("agpl", "free software foundation", r"under the terms of the gnu affero general public license as published by the free software foundation"),
    ("agpl", "affero general public license", r"see the gnu affero general public license for more details"),
    ("agpl", "remote network interaction", r"remote network interaction; use with the gnu general public license"),
    ("gfdl", "free documentation license", r"permission is granted to copy,? distribute and/or modify this document under the terms of the gnu free documentation license"),
    ("gfdl", "invariant sections", r"with no invariant sections,? (?:with )?no front-cover texts,? and (?:with )?no back-cover texts"),
    # BSD
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms,? with or without modification,? are permitted"),
    ("bsd", "redistributions of source code", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions in binary form", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd", "this software is provided by", r"this software is provided by the (?:copyright holders?|regents|author) and contributors"),
    ("bsd", "this software is provided by", r"this software is provided by the author [\"'`]{0,2}as is[\"'`]{0,2} and any express or implied warranties"),
    ("bsd-3-clause", "endorse or promote", r"may be used to endorse or promote products derived from this software without specific"),
    ("bsd-3-clause", "neither the name", r"neither the name of [^\n.;]{1,120} nor the names of (?:its|their) contributors"),
    ("bsd-4-clause", "advertising materials", r"all advertising materials mentioning features or use of this software must display"),
    ("0bsd", "permission to use, copy", r"permission to use,? copy,? modify,? and/or distribute this software for any purpose with or without fee is hereby granted\."),
    ("isc", "permission to use, copy", r"permission to use,? copy,? modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted,? provided"),
    ("isc", "all warranties with regard", r"the author disclaims all warranties with regard to this software"),
    ("ncsa", "university of illinois", r"neither the names of [^\n.;]{0,120}university of illinois[^\n.;]{0,120} nor the names of its contributors"),
    # Other permissive texts
    ("zlib", "altered source versions", r"altered source versions must be plainly marked as such"),
    ("zlib", "must not be misrepresented", r"the origin of this software must not be misrepresented"),
    ("zlib", "express or implied", r"this software is provided [\"'`]{0,2}as[- ]is[\"'`]{0,2},? without any express or implied warranty"),
    ("libpng", "contributing authors", r"libpng [^\n]{0,80}contributing authors"),
    ("boost", "to any person or organization", r"permission is hereby granted,? free of charge,? to any person or organization"),
    ("boost", "boost software license", r"distributed under the boost software license,? version 1\.0"),
    ("unlicense", "released into the public domain", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy", r"anyone is free to copy,? modify,? publish,? use,? compile,? sell,? or distribute this software"),
    ("wtfpl", "do what the fuck you want", r"you just do what the fuck you want to"),
    ("upl", "documentation and", r"subject to the condition set forth below,? permission is hereby granted to any person obtaining a copy of this software,? associated documentation and/or data"),
    ("postgresql", "without a written agreement", r"for any purpose,? without fee,? and without a written agreement is hereby granted"),
    ("python", "licensee", r"psf hereby grants licensee a nonexclusive,? royalty-free,? world-?wide license"),
    ("python", "python software foundation", r"this license agreement is between the python software foundation"),
    ("php", "php software", r"this product includes php software,? freely available from"),
    ("openssl", "openssl toolkit", r"for use in the openssl toolkit"),
    ("openssl", "openssl project", r"this product includes software developed by the openssl project"),
    ("ssleay", "cryptographic software", r"this product includes cryptographic software written by eric young"),
    ("vim", "charityware", r"vim is charityware\. you can use and copy it as much as you like"),
    ("ruby", "verbatim copies", r"you may make and give away verbatim copies of the source form of the software without restriction"),
    ("w3c", "w3c software", r"this (?:work|software) is distributed under the w3c software"),
    ("curl", "permission to use, copy", r"permission to use,? copy,? modify,? and distribute this software for any purpose with or without fee is hereby granted,? provided that the above copyright notice and this permission notice appear in all copies\."),
    ("ntp", "permission to use, copy", r"permission to use,? copy,? modify,? and distribute this software and its documentation for any purpose (?:with or )?without fee is hereby granted"),
    ("ftl", "freetype project", r"portions of this software are copyright [^\n]{0,80}the freetype project"),
    ("ijg", "independent jpeg group", r"this software is based in part on the work of the independent jpeg group"),
    ("bzip2", "bzip2", r"this program,? \"?bzip2\"?,? the associated library"),
    ("unicode", "unicode data files", r"permission is hereby granted,? free of charge,? to any person obtaining a copy of the unicode data files"),
    ("beerware", "beer in return", r"you can buy me a beer in return"),
    ("json", "good, not evil", r"the software shall be used for good,? not evil"),
    ("icu", "icu license", r"\bicu license\b"),
    ("tcl", "distribute", r"the authors hereby grant permission to use,? copy,? modify,? distribute,? and license this software"),
    ("hpnd", "suitability of this software", r"makes no representations about the suitability of this software for any purpose"),
    ("afl", "academic free license", r"licensed under the academic free license version \d\.\d"),
    ("artistic", "artistic license", r"under the (?:same )?terms (?:of|as) (?:perl|the artistic license)"),
    ("perl", "perl itself", r"(?:redistribute|modify) it under the same terms as perl(?: \d)? itself"),
    ("ms-pl", "contributor grants you", r"each contributor grants you a non-exclusive,? worldwide,? royalty-free copyright license to reproduce its contribution"),
    ("ms-rl", "reciprocal grants", r"reciprocal grants ?- ?for any file you distribute"),
    ("eupl", "the eupl", r"licensed under the eupl,? version 1\.[012]"),
    ("cecill", "cecill", r"this software is governed by the cecill(?:-[bc])? license under french law"),
    ("osl", "open software license", r"licensed under the open software license version \d\.\d"),
    ("cpl", "common public license", r"under the terms of the common public license"),
    ("epl", "eclipse public", r"made available under the terms of the eclipse public license"),
    ("edl", "eclipse distribution license", r"eclipse distribution license"),
    ("mpl", "mozilla public", r"subject to the terms of the mozilla public license"),
    ("mpl", "mozilla public license", r"the contents of this file are subject to the mozilla public license"),
    ("mpl", "mpl was not distributed", r"if a copy of the mpl was not distributed with this file"),
    ("cddl", "common development and distribution", r"subject to the terms of the common development and distribution license"),
    ("apsl", "apple public source", r"subject to the apple public source license"),
    ("npl", "netscape public", r"subject to the netscape public license"),
    ("spl", "sun public license", r"subject to the sun public license"),
    ("nposl", "non-profit open software", r"non-profit open software license"),
    ("rpl", "reciprocal public license", r"reciprocal public license"),
    ("ipl", "ibm public license", r"ibm public license"),
    ("lpl", "lucent public license", r"lucent public license"),
    ("lppl", "latex project public", r"latex project public license"),
    ("lppl", "lppl", r"under the (?:terms|conditions) of the lppl"),
    ("ofl", "sil open font", r"this font software is licensed under the sil open font license"),
    ("ofl", "reserved font name", r"with reserved font names?\b"),
    ("bitstream-vera", "bitstream vera", r"bitstream vera is a trademark of bitstream"),
    ("ubuntu-font", "ubuntu font", r"ubuntu font licen[sc]e"),
    # Data and culture
    ("cc0", "waived all copyright", r"waived all copyright and related or neighboring rights"),
    ("cc0", "dedicated the work", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc-by", "creative commons attribution", r"licensed under a creative commons attribution (?:\d\.\d )?(?:international|unported|generic)"),
    ("cc-by-sa", "attribution", r"licensed under a creative commons attribution-share ?alike"),
    ("cc-by-nc", "attribution", r"licensed under a creative commons attribution-non ?commercial"),
    ("cc-by-nd", "attribution", r"licensed under a creative commons attribution-no ?deriv"),
    ("cc", "some rights reserved", r"some rights reserved"),
    ("odbl", "open database license", r"made available under the open database license"),
    ("odbl", "openstreetmap contributors", r"openstreetmap contributors"),
    ("odc-by", "open data commons attribution", r"made available under the open data commons attribution license"),
    ("pddl", "public domain dedication", r"made available under the public domain dedication and license"),
    ("ogl-uk", "open government licence", r"open government licence v\d\.\d"),
    ("etalab", "licence ouverte", r"licence ouverte"),
    ("dl-de", "datenlizenz deutschland", r"datenlizenz deutschland"),
    ("cdla", "community data license", r"community data license agreement"),
    ("gutenberg", "project gutenberg", r"project gutenberg[\-\u2122 (tm)]{0,6} license"),
    ("wikipedia", "attribution", r"text is available under the creative commons attribution[- ]share[- ]?alike"),
    # Source-available and models
    ("sspl", "server side public", r"subject to the terms of the server side public license"),
    ("busl", "business source license", r"use of this software is governed by the business source license"),
    ("busl", "change date", r"on the change date,? [^\n]{0,80}change license"),
    ("elastic", "elastic license", r"(?:under|subject to) the elastic license 2\.0"),
    ("commons-clause", "commons clause", r"commons clause (?:license )?condition"),
    ("polyform", "polyform", r"polyform (?:noncommercial|small business|shield|strict|perimeter|free trial|internal use) license"),
    ("confluent", "confluent community", r"confluent community license"),
    ("timescale", "timescale license", r"timescale license"),
    ("redis", "redis source available", r"redis source available license"),
    ("llama", "community license agreement", r"llama [23](?:\.\d)? community license agreement"),
    ("gemma", "gemma terms of use", r"gemma terms of use"),
    ("openrail", "responsible ai license", r"responsible ai license"),
    ("bigscience", "bigscience", r"bigscience (?:open )?rail license"),
    ("falcon", "falcon", r"falcon \d{1,3}b tii license"),
    ("tongyi", "tongyi qianwen", r"tongyi qianwen license"),
    ("deepseek", "deepseek license", r"deepseek license agreement"),
    # Other languages
    ("gpl", "wie von der", r"gnu[- ]general[- ]public[- ]license,? wie von der free software foundation"),
    ("gpl", "licence publique", r"licence publique g\u00e9n\u00e9rale (?:publique )?gnu"),
    ("gpl", "licencia", r"licencia p\u00fablica general de gnu"),
    ("cc", "creative commons", r"(?:licence|licencia|lizenz|licenza) creative commons"),
    # No license, or none that is open
    ("public-domain", "public domain", r"(?:placed|dedicated|released|is) (?:in|into|in to|to) the public domain"),
    ("public-domain", "public domain", r"public domain (?:work|software|dedication)"),
    ("public-domain", "no copyright", r"no copyright is claimed"),
    ("public-domain", "united states government", r"work of the (?:united states|u\.s\.) government"),
    ("proprietary", "all rights reserved", r"all rights reserved"),
    ("proprietary", "proprietary and confidential", r"proprietary and confidential"),
    ("proprietary", "trade secret", r"(?:contains|are|is) trade secrets?"),
    ("proprietary", "unauthorized copying", r"unauthorized (?:copying|use|reproduction)[^\n.]{0,80} (?:is )?(?:strictly )?prohibited"),
    ("proprietary", "end user license", r"end[- ]user license agreement"),
    ("proprietary", "may not be reproduced", r"may not be reproduced (?:or transmitted )?(?:in any form )?without (?:the )?(?:prior )?(?:written )?permission"),
    ("proprietary", "without express", r"without (?:the )?express (?:prior )?written (?:permission|consent)"),
    ("copyright", "copyright", r"copyright (?:\(c\)|\u00a9)? ?\d{4}"),
    ("copyright", "copyright", r"\(c\) copyright \d{4}"),
)

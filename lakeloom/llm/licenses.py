"""License scan by ordered signature rules, in DataFrame expressions only.

A text is lower-cased (A-Z) and becomes its words (runs of characters other than
ASCII marks, blanks and controls) with one blank between them. Each rule is a
regular expression over words with a keyword, a label and a priority. A text
without any gate string is done after a cheap search; the gates are derived from
the rules themselves (``gates``), so no detection is lost. In the other texts a rule
runs only if its keyword is there. Of two detections, the one whose words lie within
the other's is dropped if its priority is lower, or equal and the other longer.
Labels of the base phrases always stay.

The rules are the sentences by which licenses are recognised, written out, and
names with versions made from a table. One narrow projection: no shuffle, no join,
nothing gathered. Places come from marked words and their index, and a detection is
compared only with those that start at most one match before it, so the time is in
proportion to the text even where every word belongs to a detection.

Defined cases: a null text is empty (no words, labels are empty text, score 0);
long texts are searched whole; repeated rows give one result row each; a null
doc_id stays null; other columns are ignored; an empty table gives an empty result.
Two detections of equal place and priority both stay.
"""

from __future__ import annotations

import functools
import operator
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ASCII_LOWER, ASCII_UPPER, table

#: What stands between words.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases that are always reported: (label, phrase, keyword).
BASE = (("cc-by", "cc by", " cc by "), ("gpl", "general public license", "general public"), ("reserved", "all rights reserved", "reserved"))

#: Families: (label, names as a pattern that "license" may follow, keywords of which a name has one, versions).
FAMILIES = (
    ("apache", "apache(?: software)?", "apache", ("1 0", "1 1", "2 0")),
    ("gpl", "(?:gnu )?(?:gpl|general public)", "gpl|general public", ("1", "2", "3", "2 0", "3 0")),
    ("lgpl", "(?:gnu )?(?:lgpl|(?:lesser|library) general public)", "lgpl|general public", ("2", "2 0", "2 1", "3", "3 0")),
    ("agpl", "(?:gnu )?(?:agpl|affero general public)", "agpl|general public", ("1", "3", "3 0")),
    ("fdl", "(?:gnu )?(?:gfdl|free documentation)", "gfdl|free documentation", ("1 1", "1 2", "1 3")),
    ("mpl", "(?:mpl|mozilla public)", " mpl |mozilla", ("1 0", "1 1", "2 0")),
    ("epl", "(?:epl|eclipse public)", " epl |eclipse", ("1 0", "2 0")),
    ("cpl", "(?:ibm )?common public", "common public", ("1 0",)),
    ("cddl", "(?:cddl|common development and distribution)", "cddl|common development", ("1 0", "1 1")),
    ("eupl", "(?:eupl|european union public)", "eupl|european union", ("1 0", "1 1", "1 2")),
    ("cecill", "cecill", "cecill", ("1 0", "2 0", "2 1")),
    ("osl", "(?:osl|open software)", " osl |open software", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "(?:afl|academic free)", " afl |academic free", ("1 1", "2 0", "2 1", "3 0")),
    ("artistic", "artistic", "artistic", ("1 0", "2 0")),
    ("bsl", "boost(?: software)?", "boost", ("1 0",)),
    ("busl", "business source", "business source", ("1 1",)),
    ("elastic", "elastic", "elastic", ("2 0",)),
    ("sspl", "server side public", "server side", ("1",)),
    ("apsl", "apple public source", "apple public", ("1 0", "1 1", "1 2", "2 0")),
    ("rpl", "reciprocal public", "reciprocal public", ("1 1", "1 5")),
    ("qpl", "q public", " q public", ("1 0",)),
    ("php", "php", " php ", ("3 0", "3 01")),
    ("psf", "(?:psf|python software foundation|python)", " psf |python", ("2", "2 0")),
    ("zpl", "zope public", "zope", ("1 1", "2 0", "2 1")),
    ("ecl", "educational community", "educational community", ("1 0", "2 0")),
    ("lppl", "(?:lppl|latex project public)", "lppl|latex", ("1 0", "1 2", "1 3")),
    ("ofl", "(?:sil )?(?:ofl|open font)", " ofl |open font", ("1 0", "1 1")),
    ("odbl", "(?:odbl|open database)", "odbl|open database", ("1 0",)),
    ("odc-by", "open data commons attribution", "open data commons", ("1 0",)),
    ("upl", "universal permissive", "universal permissive", ("1 0",)),
    ("mulan", "mulan permissive software", "mulan", ("1", "2")),
    ("blueoak", "blue oak model", "blue oak", ("1 0 0",)),
    ("polyform", "polyform (?:noncommercial|small business|strict)", "polyform", ("1 0 0",)),
    ("mit", "(?:mit|expat|x11)", " mit | expat | x11 ", ()),
    ("isc", "(?:isc|internet systems consortium)", " isc |internet systems", ()),
    ("zlib", "(?:zlib|libpng|zlib libpng)", "zlib|libpng", ()),
    ("ncsa", "(?:ncsa|university of illinois ncsa)", "ncsa", ()),
    ("ms-pl", "microsoft public", "microsoft public", ()),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal", ()),
    ("postgresql", "postgresql", "postgresql", ()),
    ("openssl", "openssl", "openssl", ()),
    ("ruby", "ruby", " ruby ", ()),
    ("vim", "vim", " vim ", ()),
    ("w3c", "w3c(?: software)?", "w3c", ()),
    ("json", "json", " json ", ()),
    ("icu", "(?:icu|unicode)", " icu | unicode ", ()),
    ("beerware", "(?:beerware|beer ware)", "beerware|beer ware", ()),
    ("wtfpl", "(?:wtfpl|do what the fuck you want to public)", "wtfpl|do what the", ()),
    ("tcl", "tcl tk", " tcl tk ", ()),
    ("curl", "curl", " curl ", ()),
    ("hpnd", "historical permission notice and disclaimer", "historical permission", ()),
    ("bsd", "(?:new |modified |simplified |original )?bsd", "bsd", ()),
    ("bsd-0-clause", "(?:0bsd|zero clause bsd|bsd zero clause|bsd 0 clause)", "bsd", ()),
    ("bsd-2-clause", "(?:bsd 2 clause|2 clause bsd|two clause bsd|freebsd)", "bsd", ()),
    ("bsd-3-clause", "(?:bsd 3 clause|3 clause bsd|three clause bsd|revised bsd)", "bsd", ()),
    ("bsd-4-clause", "(?:bsd 4 clause|4 clause bsd|four clause bsd)", "bsd", ()),
)

#: Creative Commons: (label, words of the short form, words of the long form).
COMMONS = (
    ("cc-by", "cc by", "attribution"),
    ("cc-by-sa", "cc by sa", "attribution share(?: |)alike"),
    ("cc-by-nc", "cc by nc", "attribution non(?: |)commercial"),
    ("cc-by-nd", "cc by nd", "attribution no(?: |)deriv(?:atives|s)?(?: works)?"),
    ("cc-by-nc-sa", "cc by nc sa", "attribution non(?: |)commercial share(?: |)alike"),
    ("cc-by-nc-nd", "cc by nc nd", "attribution non(?: |)commercial no(?: |)deriv(?:atives|s)?(?: works)?"),
)
COMMONS_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

#: Sentences that tell a license without its name: (label, pattern, keyword, priority).
SENTENCES = (
    # MIT and its relatives
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission", 85),
    ("mit", "to deal in the software without restriction including without limitation the rights to use", "without restriction", 84),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions", "permission notice", 84),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability", "no event shall", 75),
    ("mit-0", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files (?:the software )?to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided", "permission", 95),
    ("x11", "except as contained in this notice the name of (?:[^ ]+ ){1,12}shall not be used in advertising", "except as contained", 90),
    ("json", "the software shall be used for good not evil", "good not evil", 95),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission", 85),
    ("isc", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted", "permission", 86),
    ("isc", "the software is provided as is and the author disclaims all warranties", "disclaims all", 80),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided", "permission", 95),
    ("hpnd", "permission to use copy modify and distribute this software and its documentation for any purpose", "permission", 84),
    ("hpnd", "makes no representations about the suitability of this software for any purpose", "representations about", 70),
    ("postgresql", "without fee and without a written agreement is hereby granted", "written agreement", 88),
    ("ntp", "permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted", "permission", 86),
    ("icu", "including without limitation the rights to use copy modify merge publish distribute and or sell copies of the software", "publish distribute", 82),
    ("unicode", "unicode data files and software", "unicode data", 84),
    ("curl", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice", "permission", 92),
    # BSD family
    ("bsd", "redistribution and use in source and binary forms", "redistribution", 70),
    ("bsd", "redistributions of source code must retain the above copyright notice", "redistributions of source", 72),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", "redistributions in binary", 72),
    ("bsd", "this software is provided by the (?:regents|copyright holders?|authors?) and contributors as is", "and contributors", 71),
    ("bsd", "however caused and on any theory of liability whether in contract strict liability or tort", "theory of liability", 71),
    ("bsd-3-clause", "neither the name of (?:[^ ]+ ){1,12}may be used to endorse or promote products", "endorse", 85),
    ("bsd-3-clause", "the name of the author may not be used to endorse or promote products derived from this software", "endorse", 86),
    ("bsd-3-clause", "names of its contributors may be used to endorse or promote products", "endorse", 78),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "advertising materials", 90),
    ("bsd-4-clause", "this product includes software developed by (?:the )?university of california", "university of california", 88),
    ("bsd-3-clause-clear", "no express or implied licenses to any party(?: s)? patent rights are granted", "patent rights", 92),
    ("bsd-3-clause-no-nuclear", "not designed licensed or intended for use in the design construction operation or maintenance of any nuclear facility", "nuclear facility", 92),
    ("bsd-2-clause-patent", "each copyright holder and contributor hereby grants to those receiving rights under this license", "receiving rights", 92),
    ("bsd-source-code", "redistributions of source code must retain the original copyright", "original copyright", 74),
    # Apache
    ("apache-2.0", "you may not use this file except in compliance with the license", "complian", 80),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license", "applicable law", 82),
    ("apache-2.0", "limitations under the license", "limitations under", 55),
    ("apache-2.0", "www apache org licenses license 2 0", "apache org", 92),
    ("apache-2.0", "terms and conditions for use reproduction and distribution", "for use reproduction", 82),
    ("apache-2.0", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable", "perpetual worldwide", 83),
    ("apache-1.1", "the end user documentation included with the redistribution if any must include the following acknowledge?ment", "end user documentation", 88),
    ("apache-1.1", "this product includes software developed by the apache software foundation", "apache software foundation", 88),
    ("apache-1.0", "this product includes software developed by the apache group", "apache group", 90),
    # GNU
    ("gpl", "free software you can redistribute it and or modify it", "redistribut", 65),
    ("gpl", "(?:either )?version [23] (?:of the license )?or (?:at your option )?any later version", "any later version", 60),
    ("gpl", "you should have received a copy of the gnu general public license", "received a copy", 72),
    ("gpl", "www gnu org licenses gpl", "gnu org", 74),
    ("gpl", "under the terms of the gnu general public license", "gnu general public", 72),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty", "hope that it will", 64),
    ("gpl", "without even the implied warranty of merchantability or fitness for a particular purpose", "implied warranty", 58),
    ("gpl", "the licenses for most software are designed to take away your freedom to share and change it", "freedom to share", 84),
    ("gpl-2.0", "activities other than copying distribution and modification are not covered by this license", "other than copying", 86),
    ("gpl-3.0", "the gnu general public license is a free copyleft license for software and other kinds of works", "copyleft", 90),
    ("gpl-3.0", "to convey a work means any kind of propagation that enables other parties to make or receive copies", "to convey", 88),
    ("gpl-3.0", "installation information for a user product", "installation information", 80),
    ("gpl-2.0-only", "gpl 2 0 only", "gpl", 93),
    ("gpl-3.0-only", "gpl 3 0 only", "gpl", 93),
    ("gpl-2.0-or-later", "gpl 2 0 or later", "gpl", 93),
    ("gpl-3.0-or-later", "gpl 3 0 or later", "gpl", 93),
    ("gpl-classpath-exception", "as a special exception the copyright holders of this library give you permission to link this library with independent modules", "special exception", 92),
    ("gpl-classpath-exception", "classpath exception", "classpath", 82),
    ("gpl-gcc-exception", "gcc runtime library exception", "gcc runtime", 90),
    ("gpl-bison-exception", "as a special exception you may create a larger work that contains part or all of the bison parser skeleton", "bison", 92),
    ("gpl-font-exception", "as a special exception if you create a document which uses this font", "special exception", 92),
    ("gpl-autoconf-exception", "as a special exception to the gnu general public license if you distribute this file as part of a program that contains a configuration script", "special exception", 92),
    ("gpl-linking-exception", "as a special exception the copyright holders give permission to link the code of portions of this program with the openssl library", "openssl library", 92),
    ("linux-syscall-note", "this copyright does not cover user programs that use kernel services by normal system calls", "kernel services", 92),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public license", "general public", 82),
    ("lgpl", "under the terms of the gnu (?:lesser|library) general public license", "general public", 82),
    ("lgpl", "this library is free software you can redistribute it and or modify it", "library is free software", 80),
    ("lgpl", "a program that contains no derivative of any portion of the library but is designed to work with the library", "designed to work with", 86),
    ("lgpl-3.0", "this version of the gnu lesser general public license incorporates the terms and conditions", "incorporates the terms", 90),
    ("agpl", "you should have received a copy of the gnu affero general public license", "affero", 86),
    ("agpl", "under the terms of the gnu affero general public license", "affero", 86),
    ("agpl", "remote network interaction use with the gnu general public license", "remote network", 88),
    ("fdl", "with no invariant sections no front cover texts and no back cover texts", "invariant sections", 90),
    ("fdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "free documentation", 90),
    # Mozilla, Eclipse and other weak copyleft
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license", "source code form", 90),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at", "copy of the mpl", 90),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1", "contents of this file", 92),
    ("mpl", "the contents of this file are subject to the mozilla public license", "contents of this file", 82),
    ("mpl", "software distributed under the license is distributed on an as is basis without warranty of any kind either express or implied see the license for the specific language", "as is basis", 78),
    ("mpl-2.0-no-copyleft-exception", "this source code form is incompatible with secondary licenses", "secondary licenses", 92),
    ("netscape", "netscape public license", "netscape", 82),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", "accompanying materials", 86),
    ("epl-2.0", "www eclipse org legal epl 2 0", "eclipse org", 92),
    ("epl-1.0", "www eclipse org legal epl v10", "eclipse org", 92),
    ("edl-1.0", "eclipse distribution license v 1 0", "eclipse distribution", 92),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license", "contents of this file", 88),
    ("cpl-1.0", "the accompanying program is provided under the terms of this common public license", "common public", 90),
    ("ipl-1.0", "ibm public license", "ibm public", 80),
    ("cecill", "this software is governed by the cecill(?: [abc])? license under french law", "french law", 90),
    ("eupl", "licensed under the eupl", "eupl", 76),
    ("osl-3.0", "licensed under the open software license version 3 0", "open software", 92),
    ("afl-3.0", "licensed under the academic free license version 3 0", "academic free", 92),
    ("artistic-1.0", "the intent of this document is to state the conditions under which a package may be copied", "intent of this document", 90),
    ("artistic-2.0", "this license establishes the terms under which a given free software package may be copied", "license establishes", 90),
    ("artistic", "the same terms as perl itself", "as perl itself", 84),
    ("ms-pl", "if you bring a patent claim against any contributor over patents that you claim are infringed by the software", "patent claim", 86),
    ("ms-rl", "for any file you distribute that contains code from the software in source code or binary format", "contains code from", 88),
    ("sleepycat", "redistributions in any form must be accompanied by information on how to obtain complete source code", "accompanied by information", 90),
    ("qpl-1.0", "the q public license version 1 0", "q public", 92),
    # Others of the permissive kind
    ("zlib", "this software is provided as is without any express or implied warranty", "warrant", 60),
    ("zlib", "the origin of this software must not be misrepresented", "misrepresented", 84),
    ("zlib", "altered source versions must be plainly marked as such", "altered source", 84),
    ("libpng", "the contributing authors and group 42 inc disclaim all warranties", "group 42", 92),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software", "permission", 90),
    ("bsl-1.0", "www boost org license 1 0", "boost org", 92),
    ("ncsa", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction", "deal with the software", 90),
    ("openssl", "this product includes software developed by the openssl project", "openssl project", 90),
    ("ssleay", "this product includes cryptographic software written by eric young", "cryptographic software", 90),
    ("php", "this product includes php software", "php software", 88),
    ("psf", "subject to the terms and conditions of this license agreement psf hereby grants licensee", "psf hereby", 92),
    ("python", "stichting mathematisch centrum", "stichting", 84),
    ("ruby", "you may make and give away verbatim copies of the source form of the software without restriction", "give away verbatim", 84),
    ("tcl", "the authors hereby grant permission to use copy modify distribute and license this software", "hereby grant permission", 90),
    ("vim", "vim is charityware", "charityware", 88),
    ("w3c", "permission to copy modify and distribute this software and its documentation with or without modification", "permission", 88),
    ("upl-1.0", "any person obtaining a copy of this software associated documentation and or data", "associated documentation and or", 90),
    ("blueoak-1.0.0", "each contributor licenses you to do everything with this software that would otherwise infringe", "otherwise infringe", 90),
    ("mulan", "you may reproduce modify use and distribute the software with or without modification mulan", "mulan", 88),
    ("fair", "usage of the works is permitted provided that this instrument is retained with the works", "instrument is retained", 90),
    ("afmparse", "may be freely copied and distributed as long as the copyright notice is retained", "freely copied", 78),
    ("fsfap", "copying and distribution of this file with or without modification are permitted in any medium without royalty", "without royalty", 88),
    ("fsfullr", "this file is free software the free software foundation gives unlimited permission to copy and or distribute it", "unlimited permission", 88),
    ("beerware", "if we meet some day and you think this stuff is worth it you can buy me a beer", "buy me a beer", 95),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed", "changing it is allowed", 92),
    ("wtfpl", "you just do what the fuck you want to", "you just do what", 90),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1", "font software", 94),
    ("ofl", "the goals of the open font license", "open font", 80),
    ("bitstream-vera", "bitstream vera is a trademark of bitstream", "bitstream", 88),
    # Public domain and dedications
    ("public-domain", "(?:in|into|to) the public domain", "public domain", 60),
    ("public-domain", "dedicated to the public domain", "public domain", 75),
    ("public-domain", "(?:hereby )?(?:disclaims?|relinquish(?:es)?) (?:all )?copyright", "copyright", 62),
    ("public-domain", "no copyright (?:is )?claimed", "no copyright", 62),
    ("unlicense", "this is free and unencumbered software", "unencumbered", 85),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", "anyone is free", 85),
    ("unlicense", "the unlicense", "unlicense", 60),
    ("cc0", "(?:cc0|creative commons zero)(?: 1 0)?(?: universal)?", "cc0|creative commons", 80),
    ("cc0", "has waived all copyright and related or neighbou?ring rights", "neighb", 86),
    ("cc0", "to the extent possible under law the (?:person|author)", "extent possible", 82),
    ("pddl-1.0", "public domain dedication and license", "domain dedication", 84),
    # Creative Commons and data
    ("cc", "this work is licensed under a creative commons", "creative commons", 42),
    ("cc", "creativecommons org licenses", "creativecommons", 38),
    ("cc-nc", "for non(?: |)commercial (?:use|purposes) only", "commercial", 58),
    ("cc-sa", "if you remix transform or build upon the material you must distribute your contributions under the same license", "build upon the material", 82),
    ("odbl-1.0", "made available under the open database license", "open database", 86),
    ("odc-by", "made available under the open data commons attribution license", "open data commons", 86),
    ("cdla-permissive", "community data license agreement permissive", "community data", 86),
    ("cdla-sharing", "community data license agreement sharing", "community data", 86),
    ("ogl-uk", "open government licen[sc]e", "open government", 80),
    # Source available
    ("sspl-1", "if you make the functionality of the program or a modified version available to third parties as a service", "as a service", 92),
    ("busl-1.1", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use", "non production use", 92),
    ("busl-1.1", "change date (?:[^ ]+ ){1,8}change license", "change date", 84),
    ("elastic-2.0", "you may not provide the software to third parties as a hosted or managed service", "hosted or managed", 92),
    ("commons-clause", "commons clause", "commons clause", 82),
    ("commons-clause", "the license does not grant to you the right to sell the software", "right to sell", 86),
    ("polyform", "the licensor grants you a copyright license for the software to do everything you might do", "copyright license for", 86),
    ("confluent", "confluent community license", "confluent", 84),
    ("ethical-source", "hippocratic license", "hippocratic", 84),
    ("rail", "(?:open )?rail(?: m)? license|responsible ai license", " rail |responsible ai", 78),
    # Reserved and proprietary
    ("no-warranty", "without warranties or conditions of any kind", "warrant", 50),
    ("no-warranty", "the software is provided as is", "as is", 45),
    ("no-warranty", "there is no warranty for the program to the extent permitted by applicable law", "no warranty", 52),
    ("copyright", "copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9]){0,30}", "copyright", 30),
    ("copyright", "copyright (?:held )?by", "copyright", 20),
    ("proprietary", "(?:proprietary and confidential|confidential and proprietary)", "proprietary", 80),
    ("proprietary", "unauthori[sz]ed (?:copying|use|reproduction|distribution)", "unauthori", 70),
    ("proprietary", "may not be (?:copied|reproduced|distributed|disclosed) (?:in whole or in part )?without (?:the )?(?:express |prior )*written (?:permission|consent)", "written permission|written consent", 74),
    ("proprietary", "trade secrets? (?:and|or) confidential information", "trade secret", 76),
    ("proprietary", "this software is the property of", "is the property of", 68),
    ("proprietary", "by (?:installing|downloading|using) (?:this|the) software you agree to (?:be bound by )?the terms", "you agree to", 72),
    ("proprietary", "end user license agreement", "end user license", 70),
    ("proprietary", "you may not (?:reverse engineer|decompile|disassemble)", "you may not", 72),
    ("evaluation", "for (?:evaluation|trial|internal|personal) (?:use|purposes) only", "evaluation|trial|internal|personal", 62),
    ("reserved", "(?:all|some|no) rights (?:are )?reserved", "reserved", 40),
    ("reserved", "alle rechte vorbehalten", "vorbehalten", 40),
    ("reserved", "tous droits r[eéÉ]serv[eéÉ]s", "droits", 40),
    ("reserved", "(?:todos los|reservados todos los) derechos(?: reservados)?", "derechos", 40),
)

#: Strings that stand in many rules; a rule whose matches hold one is found by it, others by their own keywords.
ANCHORS = ("licen", "redistribut", "permission", "copyright", "reserved", "warrant", "public", "commons", "software", "endorse", "proprietary")
GRANT = "(?:licen[sc]ed|released|distributed|available|provided|published|covered|offered) (?:to you )?(?:under|by|according to) (?:the )?(?:terms of )?(?:the )?(?:license )?"


def rules() -> list[tuple[str, str, str, int]]:
    """All rules as (label, pattern over words, keywords joined by |, priority), base phrases not included."""
    made: list[tuple[str, str, str, int]] = []
    for label, names, keywords, versions in FAMILIES:
        made.append((label, f"{names} licen[sc]e", keywords, 50))
        made.append((label, f"{GRANT}{names} licen[sc]e", keywords, 60))
        made.append((label, f"spdx license identifier {names}", keywords, 75))
        for version in versions:
            dotted = f"{label}-{version.replace(' ', '.')}"
            tail = f"(?: licen[sc]e)? (?:as published by the free software foundation )?(?:either )?(?:version |v |v)?{version}"
            made.append((dotted, f"(?:{GRANT})?{names}{tail}", keywords, 80))
            made.append((dotted, f"spdx license identifier {names} {version}(?: only| or later)?", keywords, 90))
    for label, short, long in COMMONS:
        made.append((label, f"{short}", " cc by ", 40 + 5 * label.count("-")))
        made.append((label, f"creative commons {long}", "creative commons", 45 + 5 * label.count("-")))
        made.append((label, f"creativecommons org licenses {short[3:]}", "creativecommons", 50 + 5 * label.count("-")))
        for version in COMMONS_VERSIONS:
            dotted = f"{label}-{version.replace(' ', '.')}"
            made.append((dotted, f"(?:{GRANT})?(?:{short}|creative commons {long})(?: international| unported| generic)?(?: public)?(?: licen[sc]e)? (?:version )?{version}", " cc by |creative commons", 85))
            made.append((dotted, f"creativecommons org licenses {short[3:]} {version}", "creativecommons", 90))
    made += [(label, pattern, keyword, priority) for label, pattern, keyword, priority in SENTENCES]
    return made


def fixed_words(pattern: str) -> list[str]:
    """Strings without blanks that every match of the pattern holds: what stands outside groups, classes and options."""
    flat = pattern
    while (inner := re.sub(r"\((?:\?:)?[^()]*\)(?:[?*+]|\{[^}]*\})?", "\0", flat)) != flat:
        flat = inner
    if "|" in flat:
        return []
    flat = re.sub(r"\[[^\]]*\](?:[?*+]|\{[^}]*\})?", "\0", flat)
    flat = re.sub(r".\?", "\0", flat)
    return [w for w in re.split("[\0 ]+", flat) if w]


def gates() -> list[tuple[str, ...]]:
    """Groups of strings; a text with a detection holds all strings of one group, whatever stands between its words.
    A string between blanks is a whole word."""
    parts = lambda k: (k,) if k == f" {k.strip()} " and " " not in k.strip() else tuple(k.split())
    found = {parts(keyword) for *_, keyword in BASE}
    for _, pattern, keywords, _ in rules():
        words = fixed_words(pattern)
        anchor = next((a for a in ANCHORS if any(a in w for w in words)), None)
        found |= {(anchor,)} if anchor else {parts(k) for k in keywords.split("|")}
    return sorted(g for g in found if not any(h != g and all(any(part in own for own in g) for part in h) for h in found))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _rule_array() -> str:
    """The rules as an array of structs for Spark SQL; a match takes the blank before its first word."""
    structs = (
        f"named_struct('label', {_quoted(label)}, 'pattern', {_quoted(f' ({pattern})(?= )')}, 'keywords', array({', '.join(map(_quoted, keyword.split('|')))}), 'priority', {priority})"
        for label, pattern, keyword, priority in rules()
    )
    return f"array({', '.join(structs)})"


#: Marks a match's first word; no word holds it.
MARK = "\\u0001"
_WORDS_IN = "(length({0}) - length(replace({0}, ' ', '')))"
_HIT = "struct<first: int, before: int, less: int, label: string>"

#: For one rule: its matches as (first word, minus the word past it, minus the priority, label), in linear time:
#: the places are the marked words' numbers, the sizes those of the matches, in the same order.
_MATCHES = f"""
zip_with(
  filter(transform(split(regexp_replace(words, r.pattern, ' {MARK}$1'), ' '), (w, i) -> if(startswith(w, '{MARK}'), i - 1, null)), i -> i is not null),
  regexp_extract_all(words, r.pattern, 0),
  (at, hit) -> named_struct('first', at, 'before', -at - {_WORDS_IN.format("hit")}, 'less', -r.priority, 'label', r.label))
"""

#: Of detections sorted as above, those that no other suppresses. What holds a detection starts at most ``reach`` words
#: before it, so it is among the ``most`` that stand before it in the order; ``most`` is the largest number of
#: detections in two neighbouring stretches of ``reach`` words.
_KEPT = """
filter(hits, (a, i) -> not exists(slice(hits, greatest(1, i + 1 - most), least(i, most)), b ->
  b.before <= a.before and (b.less < a.less or (b.less = a.less and a.first - b.first + a.before - b.before > 0))))
"""
_MOST = """
aggregate(hits, named_struct('stretch', -2L, 'now', 0, 'last', 0, 'most', 0), (acc, h) ->
  named_struct(
    'stretch', h.first div reach,
    'now', if(h.first div reach = acc.stretch, acc.now + 1, 1),
    'last', if(h.first div reach = acc.stretch, acc.last, if(h.first div reach = acc.stretch + 1, acc.now, 0)),
    'most', greatest(acc.most, if(h.first div reach = acc.stretch, acc.now + 1 + acc.last, 1 + if(h.first div reach = acc.stretch + 1, acc.now, 0)))),
  acc -> acc.most)
"""


def _base(label: str, phrase: str):
    """How often a base phrase stands in ``words``, and its first and last place."""
    pattern, size = _quoted(f" {phrase}(?= )"), len(phrase.split())
    pieces = f"split(words, {pattern}, -1)"
    return F.expr(f"""named_struct('label', '{label}', 'n', size({pieces}) - 1,
      'first', cast({_WORDS_IN.format(f"{pieces}[0]")} as int),
      'last', cast({_WORDS_IN.format("words")} - 1 - {size} - ({_WORDS_IN.format(f"element_at({pieces}, -1)")} - 1) as int))""")


def scan_licenses(docs: DataFrame) -> DataFrame:
    """For every row ``doc_id``, ``n_words``, ``base`` (label, n, first, last of the base phrases that stand in it)
    and ``hits`` (label, first, past, priority of all other detections that survive, by place)."""
    words = lambda c: F.array_remove(F.split(c, BETWEEN), "")
    # Lowered once: the column is read many times, so the optimiser leaves it where it is.
    lowered = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).select("doc_id", "text", F.lower("text").alias("low"))
    low = F.col("low")
    whole = lambda part: low.rlike(f"(?:^|{BETWEEN}){part.strip()}(?:{BETWEEN}|$)") if part.startswith(" ") else F.lit(True)
    held = lambda group: functools.reduce(operator.and_, [low.contains(part.strip()) & whole(part) for part in group])  # noqa: E731  parts may stand apart in any way
    gated = functools.reduce(operator.or_, map(held, gates()))
    spaced = F.concat(F.lit(" "), F.array_join(words(F.translate("text", ASCII_UPPER, ASCII_LOWER)), " "), F.lit(" "))
    read = lowered.select("doc_id", F.size(words(F.col("text"))).cast("long").alias("n_words"), F.when(gated, spaced).alias("words"))
    found = read.select(
        "doc_id",
        "n_words",
        F.when(F.col("words").isNotNull(), F.array(*(_base(label, phrase) for label, phrase, _ in BASE))).alias("base"),
        F.expr(f"""
      if(words is null, cast(array() as array<{_HIT}>), array_sort(flatten(transform(
        filter({_rule_array()}, r -> exists(r.keywords, k -> contains(words, k)) and rlike(words, r.pattern)),
        r -> {_MATCHES}))))""").alias("hits"),
    )
    sized = found.withColumn("reach", F.expr("coalesce(array_max(transform(hits, h -> -h.before - h.first)), 1)"))
    kept = sized.withColumn("most", F.expr(_MOST)).withColumn("hits", F.expr(_KEPT))
    return kept.select(
        "doc_id",
        "n_words",
        F.expr("coalesce(filter(base, b -> b.n > 0), array())").alias("base"),
        F.expr("transform(hits, h -> named_struct('label', h.label, 'first', h.first, 'past', -h.before, 'priority', -h.less))").alias("hits"),
    )


def op6_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = lambda labels: F.expr(f"array_join(array_sort(array_distinct({labels})), ',')")
    return scan_licenses(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        F.expr("cast(aggregate(base, 0, (n, b) -> n + b.n) as long)").alias("n_base"),
        F.expr("cast(array_min(transform(base, b -> b.first)) as long)").alias("first_word"),
        F.expr("cast(array_max(transform(base, b -> b.last)) as long)").alias("last_word"),
        joined("transform(base, b -> b.label)").alias("base_labels"),
        joined("concat(transform(base, b -> b.label), transform(hits, h -> h.label))").alias("labels"),
        F.expr("greatest(if(size(base) > 0, 60, 0), coalesce(array_max(transform(hits, h -> h.priority)), 0)) / 100.0D").alias("score"),
    )

"""License scans: ordered signature rules behind a keyword prefilter.

A text becomes its lower-cased words joined by single spaces. One Aho-Corasick pass finds the
keywords that stand in it, and only the rules of these keywords run. Of overlapping detections
one that lies within another of higher or equal priority gives way to it.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.runtime import ship, worker

#: Phrases whose places are counted, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: label | keywords, one of which is in every text that matches | regular expressions of the name, over normalised words. Each gives a rule for
#: a tag, for a notice, and for the bare name.
NAMES = """
apache-2.0 | apache | apache (?:software )?license(?: version)? 2(?: 0)?|apache 2 0
apache-1.1 | apache | apache (?:software )?license(?: version)? 1 1|apache 1 1
apache-1.0 | apache | apache (?:software )?license(?: version)? 1 0|apache 1 0
mit | mit | mit license|the mit licence|mit expat license
mit-0 | mit | mit no attribution|mit 0
x11 | x11 | x11 license|mit x11 license
bsd-2-clause | bsd | (?:simplified|freebsd|2 clause|two clause) bsd license|bsd 2 clause(?: license)?
bsd-3-clause | bsd | (?:new|modified|revised|3 clause|three clause) bsd license|bsd 3 clause(?: license)?
bsd-4-clause | bsd | (?:original|old|4 clause|four clause) bsd license|bsd 4 clause(?: license)?
0bsd | bsd | bsd zero clause license|0bsd
bsd-protection | bsd | bsd protection license
isc | isc, internet systems consortium | isc license|internet systems consortium license
gpl-1.0 | general public | gnu general public license(?: version| v)? 1(?: 0)?
gpl-2.0 | general public | gnu general public license(?: version| v)? 2(?: 0)?|general public license v2
gpl-3.0 | general public | gnu general public license(?: version| v)? 3(?: 0)?|general public license v3
gpl-2.0-short | gpl | gpl(?: version)? v?2(?: 0)?(?: only)?
gpl-2.0-or-later | gpl | gpl(?: version)? v?2(?: 0)? or later|gplv2 or later
gpl-3.0-short | gpl | gpl(?: version)? v?3(?: 0)?(?: only)?
gpl-3.0-or-later | gpl | gpl(?: version)? v?3(?: 0)? or later|gplv3 or later
lgpl-2.0 | library general public | gnu library general public license(?: version| v)? 2(?: 0)?
lgpl-2.1 | lesser general public | gnu lesser general public license(?: version| v)? 2 1
lgpl-3.0 | lesser general public | gnu lesser general public license(?: version| v)? 3(?: 0)?
lgpl-short | lgpl | lgpl(?: v?[23](?: [01])?)?(?: or later| only)?
agpl-1.0 | affero | affero general public license(?: version| v)? 1(?: 0)?
agpl-3.0 | affero | (?:gnu )?affero general public license(?: version| v)? 3(?: 0)?
agpl-short | agpl | agpl(?: v?3(?: 0)?)?(?: or later| only)?
gfdl-1.1 | free documentation | gnu free documentation license(?: version| v)? 1 1
gfdl-1.2 | free documentation | gnu free documentation license(?: version| v)? 1 2
gfdl-1.3 | free documentation | gnu free documentation license(?: version| v)? 1 3
mpl-1.0 | mozilla | mozilla public license(?: version| v)? 1 0
mpl-1.1 | mozilla | mozilla public license(?: version| v)? 1 1
mpl-2.0 | mozilla | mozilla public license(?: version| v)? 2(?: 0)?
mpl-short | mpl | mpl v?[12](?: [01])?
epl-1.0 | eclipse | eclipse public license(?: version| v)? 1 0
epl-2.0 | eclipse | eclipse public license(?: version| v)? 2(?: 0)?
edl-1.0 | eclipse | eclipse distribution license(?: version| v)? 1 0
cddl-1.0 | common development | common development and distribution license(?: version| v)? 1 0
cddl-1.1 | common development | common development and distribution license(?: version| v)? 1 1
cpl-1.0 | common public | common public license(?: version| v)? 1 0
cpal-1.0 | common public attribution | common public attribution license(?: version| v)? 1 0
ipl-1.0 | ibm public | ibm public license(?: version| v)? 1 0
eupl-1.1 | european union | european union public licen[cs]e(?: version| v)? 1 1
eupl-1.2 | european union | european union public licen[cs]e(?: version| v)? 1 2
artistic-1.0 | artistic | artistic license(?: version| v)? 1 0
artistic-2.0 | artistic | artistic license(?: version| v)? 2 0
perl | perl | same terms as perl(?: 5)?(?: itself)?
bsl-1.0 | boost | boost software license(?: version| v)? 1 0|boost software license
busl-1.1 | business source | business source license(?: version| v)? 1 1
elastic-2.0 | elastic | elastic license(?: version| v)? 2 0
sspl-1.0 | server side public | server side public license(?: version| v)? 1
unlicense | unlicense | the unlicense|unlicense org
wtfpl | want to public | do what the fuck you want to public license
cc0-1.0 | cc0 | cc0 1 0(?: universal)?|cc0
cc0-name | creative commons zero | creative commons zero(?: v?1 0)?(?: universal)?
cc-by-1.0 | cc by | cc by 1 0
cc-by-2.0 | cc by | cc by 2 0
cc-by-2.5 | cc by | cc by 2 5
cc-by-3.0 | cc by | cc by 3 0
cc-by-4.0 | cc by | cc by 4 0
cc-by-sa | cc by sa | cc by sa(?: [1-4] [05])?
cc-by-nc | cc by nc | cc by nc(?: [1-4] [05])?
cc-by-nd | cc by nd | cc by nd(?: [1-4] [05])?
cc-by-nc-sa | cc by nc sa | cc by nc sa(?: [1-4] [05])?
cc-by-nc-nd | cc by nc nd | cc by nc nd(?: [1-4] [05])?
cc-by-name | creative commons | creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?(?: license)?
cc-by-sa-name | creative commons | creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: license)?
cc-by-nc-name | creative commons | creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)?(?: license)?
cc-by-nd-name | creative commons | creative commons attribution no ?deriv(?:s|atives)(?: [1-4] [05])?(?: international| unported| generic)?(?: license)?
odbl-1.0 | open database, open data commons | open (?:data commons )?database license(?: version| v)?(?: 1 0)?
odc-by-1.0 | open data commons | open data commons attribution license
pddl-1.0 | public domain dedication | (?:odc )?public domain dedication (?:and|&) licen[cs]e
public-domain | public domain | (?:in|into|to) the public domain|public domain dedication
zlib | zlib | zlib license|zlib libpng license
libpng | libpng, png reference | libpng license|png reference library license
ijg | jpeg | independent jpeg group s? ?license
openssl | openssl | openssl license|openssl and ssleay license
curl | curl | curl license
python-2.0 | python, psf | python (?:software foundation )?license(?: version)? 2|psf license
ruby | ruby | ruby s license|ruby license
php-3.01 | php | php license(?: version)?(?: 3 0?1)?
postgresql | postgresql | postgresql licen[cs]e
vim | vim | vim license
tcl | tcl | tcl tk license|tcl license
w3c | w3c | w3c software (?:notice and )?license|w3c license
unicode-dfs | unicode | unicode (?:inc )?license agreement|unicode license
ofl-1.1 | open font | sil open font license(?: version| v)?(?: 1 1)?
ms-pl | microsoft public | microsoft public license
ms-rl | microsoft reciprocal | microsoft reciprocal license
afl-3.0 | academic free | academic free license(?: version| v)?(?: 3 0)?
osl-3.0 | open software license | open software license(?: version| v)?(?: 3 0)?
ecl-2.0 | educational community | educational community license(?: version| v)?(?: 2 0)?
ncsa | ncsa | (?:university of illinois )?ncsa open source license
lppl-1.3c | project public | latex project public license(?: version| v)?(?: 1 3c?)?
qpl-1.0 | q public | q public license(?: version| v)?(?: 1 0)?
sleepycat | sleepycat | sleepycat (?:public )?license
zpl-2.1 | zope | zope public license(?: version| v)?(?: 2 1)?
ntp | ntp license | ntp license
beerware | beer ware | (?:the )?beer ware license
json | good not evil | shall be used for good not evil
mulan-2.0 | mulan | mulan (?:psl|permissive software license)(?: v2| version 2)?
bluoak-1.0 | blue oak | blue oak model license(?: 1 0 0)?
openrail | openrail | (?:creativeml )?openrail(?: m)?(?: license)?
llama | llama | llama [23](?: [0-9])? community license
polyform-nc | polyform | polyform noncommercial license(?: 1 0 0)?
proprietary | proprietary | proprietary and confidential|confidential and proprietary
"""

#: label | the identifier of the license list as words: what stands after `SPDX-License-Identifier:`. Fixed values.
TAGS = """
apache-2.0 | apache 2 0
apache-1.1 | apache 1 1
apache-1.0 | apache 1 0
mit | mit
mit-0 | mit 0
x11 | x11
isc | isc
0bsd | 0bsd
bsd-2-clause | bsd 2 clause
bsd-3-clause | bsd 3 clause
bsd-4-clause | bsd 4 clause
bsd-protection | bsd protection
gpl-1.0 | gpl 1 0
gpl-2.0 | gpl 2 0
gpl-3.0 | gpl 3 0
lgpl-2.0 | lgpl 2 0
lgpl-2.1 | lgpl 2 1
lgpl-3.0 | lgpl 3 0
agpl-1.0 | agpl 1 0
agpl-3.0 | agpl 3 0
gfdl-1.1 | gfdl 1 1
gfdl-1.2 | gfdl 1 2
gfdl-1.3 | gfdl 1 3
mpl-1.0 | mpl 1 0
mpl-1.1 | mpl 1 1
mpl-2.0 | mpl 2 0
epl-1.0 | epl 1 0
epl-2.0 | epl 2 0
cddl-1.0 | cddl 1 0
cddl-1.1 | cddl 1 1
cpl-1.0 | cpl 1 0
cpal-1.0 | cpal 1 0
ipl-1.0 | ipl 1 0
eupl-1.1 | eupl 1 1
eupl-1.2 | eupl 1 2
artistic-1.0 | artistic 1 0(?: perl| cl8)?
artistic-2.0 | artistic 2 0
bsl-1.0 | bsl 1 0
busl-1.1 | busl 1 1
elastic-2.0 | elastic 2 0
sspl-1.0 | sspl 1 0
unlicense | unlicense
wtfpl | wtfpl
cc0-1.0 | cc0 1 0
cc-by-1.0 | cc by 1 0
cc-by-2.0 | cc by 2 0
cc-by-2.5 | cc by 2 5
cc-by-3.0 | cc by 3 0
cc-by-4.0 | cc by 4 0
cc-by-sa | cc by sa [1-4] [05]
cc-by-nc | cc by nc [1-4] [05]
cc-by-nd | cc by nd [1-4] [05]
cc-by-nc-sa | cc by nc sa [1-4] [05]
cc-by-nc-nd | cc by nc nd [1-4] [05]
odbl-1.0 | odbl 1 0
odc-by-1.0 | odc by 1 0
pddl-1.0 | pddl 1 0
zlib | zlib
libpng | libpng(?: 2 0)?
ijg | ijg
openssl | openssl
curl | curl
python-2.0 | python 2 0(?: 1)?|psf 2 0
ruby | ruby
php-3.01 | php 3 01
postgresql | postgresql
vim | vim
tcl | tcl
w3c | w3c
unicode-dfs | unicode (?:dfs 201[56]|3 0)
ofl-1.1 | ofl 1 [01]
ms-pl | ms pl
ms-rl | ms rl
afl-3.0 | afl [1-3] [0-2]
osl-3.0 | osl [1-3] [01]
ecl-2.0 | ecl [12] 0
ncsa | ncsa
lppl-1.3c | lppl 1 3[ac]
qpl-1.0 | qpl 1 0
sleepycat | sleepycat
zpl-2.1 | zpl [12] [01]
ntp | ntp
beerware | beerware
json | json
mulan-2.0 | mulanpsl [12] 0
bluoak-1.0 | blueoak 1 0 0
polyform-nc | polyform noncommercial 1 0 0
"""

#: priority | label | keywords | regular expression: sentences of license texts and notices.
SENTENCES = r"""
40 | license | except in compliance | you may not use this file except in compliance with the license
90 | mit | permission is hereby | permission is hereby granted free of charge to any person obtaining a copy
90 | isc | permission to use | permission to use copy modify and or distribute this software for any purpose
88 | bsd | redistribution | redistribution and use in source and binary forms with or without modification
86 | bsd-3-clause | neither the name | neither the name of (?:\S+ ){1,12}nor the names of (?:its|the) contributors
86 | bsd-4-clause | advertising materials | all advertising materials mentioning features or use of this software
84 | apache-2.0 | apache | (?:www )?apache org licenses license 2 0
84 | apache-1.1 | apache software foundation | this product includes software developed by the apache software foundation
83 | mit | above copyright notice | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
83 | isc | above copyright notice | provided that the above copyright notice and this permission notice appear in all copies
83 | bsd | above copyright notice | redistributions of source code must retain the above copyright notice
83 | bsd | above copyright notice | redistributions in binary form must reproduce the above copyright notice
83 | bsd-4-clause | following acknowledgement | must display the following acknowledgement
83 | gpl | free software foundation | write to the free software foundation inc
83 | gpl | copy of the gnu | you should have received a copy of the gnu general public license
83 | lgpl | copy of the gnu | you should have received a copy of the gnu (?:lesser|library) general public license
83 | agpl | copy of the gnu | you should have received a copy of the gnu affero general public license
84 | gpl-2.0-or-later | either version | either version 2 of the license or (?:at your option )?any later version
84 | gpl-3.0-or-later | either version | either version 3 of the license or (?:at your option )?any later version
83 | gfdl | invariant sections | with no invariant sections no front cover texts
83 | mpl-2.0 | source code form | this source code form is subject to the terms of the mozilla public license
83 | mpl-1.1 | contents of this file | the contents of this file are subject to the mozilla public license version 1 1
83 | cddl-1.0 | contents of this file | the contents of this file are subject to the terms of the common development and distribution license
83 | epl-1.0 | accompanying materials | this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
83 | epl-2.0 | accompanying materials | this program and the accompanying materials are made available under the terms of the eclipse public license (?:v )?2 0
84 | epl-2.0 | eclipse org | (?:www )?eclipse org legal epl 2 0
84 | epl-1.0 | eclipse org | (?:www )?eclipse org legal epl v10
84 | bsl-1.0 | accompanying file | see accompanying file license 1 0 txt
83 | bsl-1.0 | this license to use | obtaining a copy of the software and accompanying documentation covered by this license to use reproduce display
83 | zlib | misrepresented | the origin of this software must not be misrepresented
83 | zlib | plainly marked | altered source versions must be plainly marked as such
83 | cc0-1.0 | copyright and related | waived all copyright and related or neighboring rights
83 | ofl-1.1 | reserved font name | with reserved font name
84 | ofl-1.1 | scripts sil org | scripts sil org ofl
83 | wtfpl | just do what | you just do what the fuck you want to
83 | beerware | buy me a beer | you can buy me a beer in return
83 | artistic-2.0 | standard version | distribute verbatim copies of the source form of the standard version of this package
83 | openssl | openssl project | this product includes software developed by the openssl project
83 | postgresql | and its documentation | permission to use copy modify and distribute this software and its documentation for any purpose without fee
83 | python-2.0 | psf hereby grants | psf hereby grants licensee a nonexclusive royalty free world wide license
83 | unicode-dfs | data files | copy of the unicode data files and any associated documentation
83 | ncsa | with the software | deal with the software without restriction
83 | public-domain | public domain | (?:this|the) (?:work|file|code|software) is (?:hereby )?(?:placed |released )?(?:in|into) the public domain
83 | public-domain | no copyright | no copyright is claimed
83 | busl-1.1 | additional use grant | additional use grant
83 | elastic-2.0 | managed service | you may not provide the software to third parties as a hosted or managed service
83 | llama | community license | community license agreement
83 | openrail | use based restrictions | use based restrictions
83 | proprietary | strictly prohibited | unauthorized (?:copying|use|reproduction|distribution) (?:of this (?:file|software|document) )?(?:\S+ ){0,6}is strictly prohibited
83 | proprietary | may not be reproduced | may not be reproduced (?:\S+ ){0,10}without (?:the )?(?:prior )?(?:express )?(?:written )?(?:permission|consent)
83 | proprietary | trade secret | contains (?:confidential|proprietary) (?:\S+ ){0,4}trade secrets?
83 | noncommercial | commercial | (?:for )?non ?commercial use only
83 | noncommercial | personal use | for personal use only
83 | evaluation | evaluation purposes | for evaluation purposes only
83 | eula | end user | end user license agreement
83 | patent-grant | patent license | royalty free irrevocable (?:\S+ ){0,6}patent license
83 | patent-grant | patent rights | additional grant of patent rights
83 | contributor | contributor license | contributor license agreement
83 | contributor | certificate of origin | developer certificate of origin
83 | export | export control | subject to (?:\S+ ){0,4}export control
83 | attribution | attribution | please (?:provide|give) attribution
83 | dual-license | dual license, multi license | dual licensed?|multi licensed?
84 | gpl | free software | this program is free software you can redistribute it and or modify it
84 | gpl | free software foundation | as published by the free software foundation
84 | gpl | gnu org | www gnu org licenses(?: gpl(?: [123] 0)?)?
84 | lgpl | gnu org | www gnu org licenses lgpl(?: [23] [01])?
84 | agpl | gnu org | www gnu org licenses agpl(?: 3 0)?
84 | cc-by | creativecommons | creativecommons org licenses by [1-4] [05]
85 | cc-by-sa | creativecommons | creativecommons org licenses by sa [1-4] [05]
85 | cc-by-nc | creativecommons | creativecommons org licenses by nc [1-4] [05]
85 | cc-by-nd | creativecommons | creativecommons org licenses by nd [1-4] [05]
85 | cc0-1.0 | creativecommons | creativecommons org publicdomain zero 1 0
84 | mit | opensource | opensource org licenses mit(?: license)?(?: php)?
84 | bsd | opensource | opensource org licenses bsd(?: license)?(?: php)?
84 | mpl-2.0 | mozilla | mozilla org mpl 2 0
84 | boost | boost | boost org license 1 0 txt
82 | unlicense | unencumbered | free and unencumbered software released into the public domain
82 | zlib | as is | this software is provided as is without any express or implied warranty
80 | warranty | without warranties | without warranties or conditions of any kind
80 | warranty | warranty | without even the implied warranty of merchantability
80 | warranty | as is without warrant | (?:provided )?as is without warrant(?:y|ies) of any kind
60 | gpl | gnu | gnu general public license
60 | lgpl | lesser | gnu lesser general public license
60 | agpl | affero | affero general public license
58 | gpl | gpl | gplv?[123]
55 | cc | creative commons | creative commons(?: license)?
50 | reserved | rights | (?:all|some) rights reserved
45 | copyright | copyright | copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?
40 | license | licensed under | licensed under (?:the )?(?:\S+ ){0,6}licen[cs]e
40 | license | license | see (?:the )?license (?:file )?for (?:more )?(?:details|information)
35 | license | licence, license | this work is licen[cs]ed under
30 | trademark | trademark | (?:registered )?trademarks? of
30 | patent | patent | patents? (?:pending|granted)
"""

#: Confidence of a detection by its priority, for the score.
SURE = 100


class Rule(NamedTuple):
    priority: int
    label: str
    keywords: list[str]
    pattern: re.Pattern


def _rule(priority: int, label: str, keywords: str, pattern: str) -> Rule:
    return Rule(priority, label, keywords.split(", "), re.compile(rf"(?<= )(?:{pattern})(?= )"))


def rules() -> list[Rule]:
    """All rules, the highest priority first."""
    found = []
    for line in NAMES.strip().splitlines():
        label, keyword, name = (x.strip() for x in line.split(" | ", 2))
        label = re.sub(r"-(short|name)$", "", label)
        found.append(_rule(94, label, keyword, rf"spdx license identifier (?:{name})"))
        found.append(_rule(92, label, keyword, rf"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:{name})"))
        found.append(_rule(75, label, keyword, name))
    tags = [[x.strip() for x in line.split(" | ", 1)] for line in TAGS.strip().splitlines()]
    for label, tag in tags:  # alone, or behind another name of an expression; the detection is the group's
        found.append(_rule(95, label, "spdx license identifier", rf"spdx license identifier (?:(?:\S+ ){{1,6}}(?:or|and|with) )?((?:{tag})(?: only| or later)?)"))
    for line in SENTENCES.strip().splitlines():
        priority, label, keyword, pattern = (x.strip() for x in line.split(" | ", 3))
        found.append(_rule(int(priority), label, keyword, pattern))
    return sorted(found, key=lambda r: -r.priority)


#: Bytes that aren't part of a word become spaces, A-Z become a-z.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


class Scanner:
    def __init__(self) -> None:
        self.by_keyword = defaultdict(list)
        for rule in rules():
            for keyword in rule.keywords:
                self.by_keyword[keyword].append(rule)
        self.keywords = ahocorasick.Automaton()
        for word in [*self.by_keyword, *BASE]:
            self.keywords.add_word(word, word)
        self.keywords.make_automaton()
        self.base = {phrase: re.compile(rf"(?<= ){phrase}(?= )") for phrase in BASE}

    def scan(self, text: str | None) -> tuple[int, int, int | None, int | None, str, str, float, list[tuple[int, int, str]]]:
        """(words, base places, first, last, base labels, labels, score, kept detections as (first word, end word, label))."""
        words = (text or "").encode().translate(_FOLD).split()
        flat = f" {b' '.join(words).decode()} "
        present = {word for _, word in self.keywords.iter(flat)}
        places, base = [], set()
        for phrase, label in BASE.items():
            if phrase in present:
                here = [m.start() for m in self.base[phrase].finditer(flat)]
                places += here
                base |= {label} if here else set()
        hits = []
        for keyword in present & self.by_keyword.keys():
            for rule in self.by_keyword[keyword]:
                hits += [(rule.priority, *m.span(m.re.groups), rule.label) for m in rule.pattern.finditer(flat)]
        kept = suppressed(hits)
        starts = list(itertools.accumulate((len(w) + 1 for w in flat.split()), initial=1))
        word_at = lambda at: bisect.bisect_right(starts, at) - 1
        labels = base | {label for *_, label in kept}
        doubt = 1.0
        for priority in {p for p, *_ in kept}:
            doubt *= 1 - priority / SURE
        score = max(round(1 - doubt, 6) if kept else 0.0, 0.5 if base else 0.0)
        spans = [(word_at(lo), word_at(hi - 1) + 1, label) for _, lo, hi, label in kept]
        first, last = (word_at(min(places)), word_at(max(places))) if places else (None, None)
        return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score, spans


def suppressed(hits: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """(priority, start, end, label) hits without those within another kept one of no lower priority; first the
    highest priority, then the longest, then the first by place and label.

    A sweep for each priority: a hit gives way if one that begins no later, of this priority or a higher one, ends no earlier.
    """
    kept: list[tuple[int, int, int, str]] = []
    above: list[tuple[int, int]] = []  # (start, end) of the higher priorities, by start, without those inside others
    for priority in sorted({h[0] for h in hits}, reverse=True):
        own = sorted({h for h in hits if h[0] == priority}, key=lambda h: (h[1], -h[2], h[3]))
        at, furthest, fresh = 0, -1, []
        for hit in own:
            while at < len(above) and above[at][0] <= hit[1]:
                furthest, at = max(furthest, above[at][1]), at + 1
            if furthest < hit[2]:
                furthest = hit[2]
                fresh.append(hit)
        kept += fresh
        merged = []
        for start, end in sorted([*above, *((h[1], h[2]) for h in fresh)], key=lambda x: (x[0], -x[1])):
            if not merged or end > merged[-1][1]:
                merged.append((start, end))
        above = merged
    return sorted(kept, key=lambda h: (h[1], h[2], h[3]))


_SCANNER: list[Scanner] = []
_SPANS = pa.list_(pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("label", pa.string())]))


@worker("licenses")
def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if not _SCANNER:
        _SCANNER.append(Scanner())
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), _SPANS]
    for batch in batches:
        found = [_SCANNER[0].scan(t.as_py()) for t in batch["text"]]
        columns = list(zip(*found)) if found else [()] * len(names)
        spans = [[{"first_word": a, "end_word": b, "label": c} for a, b, c in row] for row in columns[-1]]
        columns = [pa.array(list(c), kind) for c, kind in zip([*columns[:-1], spans], kinds)]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", *names])


def scan_licenses(docs: DataFrame) -> DataFrame:
    """License labels of every whole text.

    Out, a row for each row of docs: doc_id, n_words, n_base (places of the base phrases), first_word
    and last_word (the smallest and largest start of these; null without one), base_labels, labels
    (with those of the rules that weren't suppressed), score (how sure the labels are) and spans
    (the rules' detections: first word, end word, label).

    A null text counts as empty: no words, no labels, score 0. Rows may share a doc_id or have
    none. Very long texts are scanned whole. An empty table gives no rows. Other columns of docs
    don't matter.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<first_word:long,end_word:long,label:string>>"
    return docs.mapInArrow(_scan, schema)

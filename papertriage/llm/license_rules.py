"""Signature rules of the license scan.

A rule's regex reads normalised text: lower-case words with one space between
them ("Version 2.0" reads "version 2 0"). Its keyword is a literal that every
match contains; a rule is tried only on texts with its keyword. Priorities:
3 identifiers and addresses, 2 named licenses, 1 families and phrases.
Order breaks ties. Every repeat is bounded, so a match has a bounded length.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    priority: int
    weight: float
    regex: str


# The base phrases and their labels.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# label | keyword | regex: named licenses (priority 2)
_NAMED = """
gpl-1.0 | general public | (?:gnu )?general public licen[cs]e(?: gpl)? (?:version|v) ?1
gpl-2.0 | general public | (?:gnu )?general public licen[cs]e(?: gpl)?(?: as published by the free software foundation)? (?:either )?(?:version|v) ?2
gpl-3.0 | general public | (?:gnu )?general public licen[cs]e(?: gpl)?(?: as published by the free software foundation)? (?:either )?(?:version|v) ?3
gpl-2.0-or-later | any later version | version 2(?: of the licen[cs]e)? or (?:at your option )?any later version
gpl-3.0-or-later | any later version | version 3(?: of the licen[cs]e)? or (?:at your option )?any later version
gpl-2.0 | gplv2 | gplv2
gpl-3.0 | gplv3 | gplv3
gpl-2.0 | gpl | gpl (?:version |v ?)2(?: 0)?
gpl-3.0 | gpl | gpl (?:version |v ?)3(?: 0)?
lgpl | lesser general | (?:gnu )?lesser general public licen[cs]e
lgpl | library general | (?:gnu )?library general public licen[cs]e
lgpl-2.0 | library general | (?:gnu )?library general public licen[cs]e (?:version|v) ?2
lgpl-2.1 | lesser general | (?:gnu )?lesser general public licen[cs]e (?:either )?(?:version|v) ?2 1
lgpl-3.0 | lesser general | (?:gnu )?lesser general public licen[cs]e (?:either )?(?:version|v) ?3
lgpl-2.1 | lgplv2 | lgplv2(?: 1)?
lgpl-3.0 | lgplv3 | lgplv3
agpl | affero | (?:gnu )?affero general public licen[cs]e
agpl-3.0 | affero | (?:gnu )?affero general public licen[cs]e (?:either )?(?:version|v) ?3
agpl-3.0 | agplv3 | agplv3
gfdl | free documentation | (?:gnu )?free documentation licen[cs]e
gfdl-1.2 | free documentation | (?:gnu )?free documentation licen[cs]e version 1 2
gfdl-1.3 | free documentation | (?:gnu )?free documentation licen[cs]e version 1 3
gpl-classpath-exception | classpath | classpath exception
gcc-exception | runtime library | gcc runtime library exception
gpl-notice | free software | this program is free software you can redistribute it and or modify it
apache-1.0 | apache | apache (?:software )?licen[cs]e (?:version |v ?)1 0
apache-1.1 | apache | apache (?:software )?licen[cs]e (?:version |v ?)1 1
apache-2.0 | apache | apache (?:software )?licen[cs]e (?:version |v ?)?2(?: 0)?
apache-2.0 | apache | licensed under the apache licen[cs]e (?:version |v ?)2 0 the licen[cs]e
mit | mit | (?:the )?mit licen[cs]e
mit | mit | (?:the )?mit x11 licen[cs]e
mit | expat | (?:the )?expat licen[cs]e
mit | permission is hereby | permission is hereby granted free of charge to any person obtaining a copy
mit-0 | mit no attribution | mit no attribution
mit-notice | as is | the software is provided as is without warranty of any kind
x11 | x11 | (?:the )?x11 licen[cs]e
isc | isc | (?:the )?isc licen[cs]e
isc | permission to use copy | permission to use copy modify and or distribute this software for any purpose with or without fee
bsd-0 | zero clause | (?:bsd zero clause|zero clause bsd)(?: licen[cs]e)?
bsd-1-clause | clause | bsd (?:1|one) clause(?: licen[cs]e)?
bsd-2-clause | clause | (?:bsd (?:2|two) clause|(?:2|two) clause bsd)(?: licen[cs]e)?
bsd-2-clause | simplified bsd | simplified bsd licen[cs]e
bsd-2-clause | freebsd | freebsd licen[cs]e
bsd-3-clause | clause | (?:bsd (?:3|three) clause|(?:3|three) clause bsd)(?: licen[cs]e)?
bsd-3-clause | bsd | (?:new|revised|modified) bsd licen[cs]e
bsd-4-clause | clause | (?:bsd (?:4|four) clause|(?:4|four) clause bsd)(?: licen[cs]e)?
bsd-4-clause | original bsd | original bsd licen[cs]e
bsd-notice | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd-patent | patent | bsd (?:2 clause )?plus patent(?: licen[cs]e)?
cc-by-1.0 | attribution | creative commons attribution 1 0
cc-by-2.0 | attribution | creative commons attribution 2 0
cc-by-2.5 | attribution | creative commons attribution 2 5
cc-by-3.0 | attribution | creative commons attribution 3 0
cc-by-4.0 | attribution | creative commons attribution 4 0
cc-by | attribution | creative commons attribution(?: licen[cs]e)?
cc-by-sa | share | creative commons attribution share ?alike(?: licen[cs]e)?
cc-by-sa-3.0 | share | creative commons attribution share ?alike 3 0
cc-by-sa-4.0 | share | creative commons attribution share ?alike 4 0
cc-by-nc | commercial | creative commons attribution non ?commercial(?: licen[cs]e)?
cc-by-nc-3.0 | commercial | creative commons attribution non ?commercial 3 0
cc-by-nc-4.0 | commercial | creative commons attribution non ?commercial 4 0
cc-by-nc-sa | commercial | creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?
cc-by-nc-nd | commercial | creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [05])?
cc-by-nd | deriv | creative commons attribution no ?deriv(?:ative)?s(?: [1-4] [05])?
cc-by-sa | cc by | cc by sa(?: [1-4] [05])?
cc-by-nc | cc by | cc by nc(?: [1-4] [05])?
cc-by-nc-sa | cc by | cc by nc sa(?: [1-4] [05])?
cc-by-nc-nd | cc by | cc by nc nd(?: [1-4] [05])?
cc-by-nd | cc by | cc by nd(?: [1-4] [05])?
cc-by-3.0 | cc by | cc by 3 0
cc-by-4.0 | cc by | cc by 4 0
cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | creative commons | creative commons (?:zero|public domain dedication)
mpl | mozilla | mozilla public licen[cs]e
mpl-1.0 | mozilla | mozilla public licen[cs]e (?:version |v ?)?1 0
mpl-1.1 | mozilla | mozilla public licen[cs]e (?:version |v ?)?1 1
mpl-2.0 | mozilla | mozilla public licen[cs]e (?:version |v ?)?2 0
mpl-2.0 | mozilla | this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
epl | eclipse | eclipse public licen[cs]e
epl-1.0 | eclipse | eclipse public licen[cs]e (?:version |v ?)?1 0
epl-2.0 | eclipse | eclipse public licen[cs]e (?:version |v ?)?2 0
edl-1.0 | eclipse | eclipse distribution licen[cs]e(?: (?:version |v ?)?1 0)?
cddl | common development | common development and distribution licen[cs]e
cddl-1.0 | common development | common development and distribution licen[cs]e(?: cddl)? (?:version |v ?)?1 0
cddl-1.1 | common development | common development and distribution licen[cs]e(?: cddl)? (?:version |v ?)?1 1
cpl-1.0 | common public | common public licen[cs]e(?: (?:version |v ?)?1 0)?
ipl-1.0 | ibm public | ibm public licen[cs]e(?: (?:version |v ?)?1 0)?
eupl | european union public | european union public licen[cs]e
eupl-1.1 | european union public | european union public licen[cs]e (?:version |v ?)?1 1
eupl-1.2 | european union public | european union public licen[cs]e (?:version |v ?)?1 2
artistic | artistic | artistic licen[cs]e
artistic-1.0 | artistic | artistic licen[cs]e (?:version |v ?)?1 0
artistic-2.0 | artistic | artistic licen[cs]e (?:version |v ?)?2 0
perl | perl | same terms as perl itself
bsl-1.0 | boost | boost software licen[cs]e(?: (?:version |v ?)?1 0)?
busl-1.1 | business source | business source licen[cs]e(?: 1 1)?
sspl-1.0 | server side public | server side public licen[cs]e(?: (?:version |v ?)?1)?
elastic-2.0 | elastic | elastic licen[cs]e(?: (?:version |v ?)?2 0)?
zlib | zlib | (?:the )?zlib(?: libpng)? licen[cs]e
libpng | libpng | (?:the )?libpng licen[cs]e
unlicense | unlicense | (?:the )?unlicense
unlicense | unencumbered | this is free and unencumbered software released into the public domain
wtfpl | what the fuck | do what the fuck you want to public licen[cs]e
wtfpl | wtfpl | wtfpl
beerware | beer | (?:the )?beer ?ware licen[cs]e
ofl-1.1 | open font | (?:sil )?open font licen[cs]e(?: (?:version |v ?)?1 1)?
ofl-1.0 | open font | (?:sil )?open font licen[cs]e (?:version |v ?)?1 0
odbl | open database | (?:odc )?open database licen[cs]e(?: odbl)?(?: (?:version |v ?)?1 0)?
pddl | public domain dedication | (?:odc )?public domain dedication and licen[cs]e
odc-by | data commons | open data commons attribution licen[cs]e
ogl-uk | open government | open government licen[cs]e(?: v ?[123] 0)?
psf-2.0 | python software foundation | python software foundation licen[cs]e(?: (?:version |v ?)?2)?
python-2.0 | python | python licen[cs]e(?: (?:version |v ?)?2 0)?
php-3.0 | php | php licen[cs]e(?: (?:version |v ?)?3 0)?
php-3.01 | php | php licen[cs]e (?:version |v ?)?3 01
ruby | ruby | ruby licen[cs]e
openssl | openssl | openssl licen[cs]e
ssleay | ssleay | (?:original )?ssleay licen[cs]e
postgresql | postgresql | postgresql licen[cs]e
ncsa | ncsa | (?:university of illinois )?ncsa(?: open source)? licen[cs]e
ms-pl | microsoft | microsoft public licen[cs]e
ms-rl | microsoft | microsoft reciprocal licen[cs]e
apsl-2.0 | apple public | apple public source licen[cs]e(?: (?:version |v ?)?2 0)?
afl-3.0 | academic free | academic free licen[cs]e(?: (?:version |v ?)?3 0)?
osl-3.0 | open software | open software licen[cs]e(?: (?:version |v ?)?3 0)?
qpl-1.0 | q public | q public licen[cs]e(?: (?:version |v ?)?1 0)?
rpl-1.5 | reciprocal public | reciprocal public licen[cs]e(?: (?:version |v ?)?1 5)?
sleepycat | sleepycat | sleepycat licen[cs]e
w3c | w3c | w3c (?:software )?(?:notice and )?licen[cs]e
zpl-2.1 | zope | zope public licen[cs]e(?: (?:version |v ?)?2 1)?
lppl | latex project | latex project public licen[cs]e(?: (?:version |v ?)?1 3c?)?
ecl-2.0 | educational community | educational community licen[cs]e(?: (?:version |v ?)?2 0)?
upl-1.0 | universal permissive | universal permissive licen[cs]e(?: (?:version |v ?)?1 0)?
vim | vim | vim licen[cs]e
icu | icu | icu licen[cs]e
unicode | unicode | unicode (?:inc )?(?:terms of use|licen[cs]e agreement)
curl | curl | curl licen[cs]e
json | json | (?:the )?json licen[cs]e
json | good not evil | the software shall be used for good not evil
hpnd | historical permission | historical permission notice and disclaimer
cecill | cecill | cecill(?: [bc])?(?: licen[cs]e)?
mulan-psl-2.0 | mulan | mulan permissive software licen[cs]e(?: (?:version |v ?)?2)?
blueoak-1.0.0 | blue oak | blue oak model licen[cs]e(?: 1 0 0)?
openrail | openrail | (?:creativeml )?openrail(?: [mads])?(?: licen[cs]e)?
openrail | open rail | (?:creativeml )?open rail(?: [mads])?(?: licen[cs]e)?
llama-community | llama | llama [234](?: [123])? community licen[cs]e
"""

# label | keyword | weight | regex: families and phrases (priority 1)
_PHRASES = """
gpl | general public | 0.7 | (?:gnu )?general public licen[cs]e
gpl | gpl | 0.5 | gnu gpl
apache | apache | 0.7 | apache licen[cs]e
cc-by | cc by | 0.6 | cc by
cc | creative commons | 0.5 | creative commons(?: licen[cs]e)?
bsd | bsd | 0.6 | bsd (?:style )?licen[cs]e
public-domain | public domain | 0.4 | (?:released into|placed in|in) the public domain
proprietary | all rights reserved | 0.3 | all rights reserved
proprietary | proprietary | 0.4 | proprietary and confidential
proprietary | end user | 0.4 | end user licen[cs]e agreement
copyleft | copyleft | 0.3 | copyleft licen[cs]e
dual | dual | 0.3 | dual licensed under
"""

# Public license identifiers, read after an SPDX tag (priority 3).
_TAGGED = (
    "0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.0 Apache-1.1 Apache-2.0 Artistic-1.0 "
    "Artistic-2.0 BlueOak-1.0.0 BSD-1-Clause BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 BUSL-1.1 CC-BY-3.0 "
    "CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 "
    "CECILL-2.1 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 GFDL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-2.0-only "
    "GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later HPND ICU IPL-1.0 ISC JSON LGPL-2.0 LGPL-2.1 "
    "LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later Libpng LPPL-1.3c MIT MIT-0 MPL-1.0 "
    "MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.0 OFL-1.1 OpenSSL OSL-3.0 PDDL-1.0 PHP-3.01 "
    "PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby Sleepycat SSPL-1.0 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1"
).split()

# label | keyword | regex: addresses of license texts (priority 3)
_ADDRESSES = """
gpl-2.0 | gnu org | gnu org licen[cs]es (?:old licenses )?gpl 2 0
gpl-3.0 | gnu org | gnu org licen[cs]es gpl 3 0
gpl | gnu org | gnu org licen[cs]es gpl
lgpl | gnu org | gnu org licen[cs]es lgpl(?: [23] [01])?
agpl-3.0 | gnu org | gnu org licen[cs]es agpl(?: 3 0)?
gfdl | gnu org | gnu org licen[cs]es fdl(?: 1 [23])?
apache-2.0 | apache org | apache org licenses license 2 0
apache-1.1 | apache org | apache org licenses license 1 1
mit | opensource org | opensource org licenses mit(?: license)?
bsd-2-clause | opensource org | opensource org licenses bsd 2 clause
bsd-3-clause | opensource org | opensource org licenses bsd 3 clause
isc | opensource org | opensource org licenses isc(?: license)?
mpl-2.0 | mozilla org | mozilla org (?:en us )?mpl 2 0
epl-2.0 | eclipse org | eclipse org legal epl 2 0
epl-1.0 | eclipse org | eclipse org legal epl v10
cc0-1.0 | creativecommons org | creativecommons org publicdomain zero 1 0
cc-by-4.0 | creativecommons org | creativecommons org licenses by 4 0
cc-by-3.0 | creativecommons org | creativecommons org licenses by 3 0
cc-by-sa-4.0 | creativecommons org | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | creativecommons org | creativecommons org licenses by sa 3 0
cc-by-nc-4.0 | creativecommons org | creativecommons org licenses by nc 4 0
cc-by-nc-sa-4.0 | creativecommons org | creativecommons org licenses by nc sa 4 0
cc-by-nc-nd-4.0 | creativecommons org | creativecommons org licenses by nc nd 4 0
cc-by-nd-4.0 | creativecommons org | creativecommons org licenses by nd 4 0
unlicense | unlicense org | unlicense org
bsl-1.0 | boost org | boost org license 1 0
ofl-1.1 | scripts sil org | scripts sil org ofl
wtfpl | wtfpl net | wtfpl net
"""


def _lines(block: str) -> list[list[str]]:
    return [[part.strip() for part in line.split(" | ")] for line in block.strip().splitlines()]


def _words(identifier: str) -> str:
    return "".join(ch if ch.isalnum() else " " for ch in identifier.lower())


def rules() -> list[Rule]:
    """All signature rules in order."""
    out = [Rule(i.lower(), "spdx license identifier", 3, 1.0, f"spdx license identifier {_words(i)}") for i in _TAGGED]
    out += [Rule(label, word, 3, 0.95, regex) for label, word, regex in _lines(_ADDRESSES)]
    out += [Rule(label, word, 2, 0.9, regex) for label, word, regex in _lines(_NAMED)]
    out += [Rule(label, word, 1, float(weight), regex) for label, word, weight, regex in _lines(_PHRASES)]
    return out

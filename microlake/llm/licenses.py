"""License scans with ordered signature rules.

A rule is a regular expression over the text's lower-cased words, joined by single spaces, with a label, a priority and
the keywords one of which must occur for it to be tried; an Aho-Corasick automaton finds all keywords of a text in one
pass, so most of the many hundred expressions, of which some 250 are single ones, never run on it. Detections that lie inside one of higher priority, or
of equal priority and greater length, are suppressed. The labels of the base phrases always stay.

Defined cases: null and empty texts have no words, no labels (an empty string) and score 0; rows that repeat get the same
answer each; an empty table gives an empty result; a null id is passed on. Columns other than doc_id and text are not
read. Texts are read whole.
"""

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, groupby
from typing import NamedTuple

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import own_names, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {i: i + 32 for i in range(65, 91)}
#: The base phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
_PHRASE = {label: re.compile(r"(?<![^ ])" + phrase + r"(?![^ ])") for phrase, label in PHRASES.items()}
_CHEAP = {label: re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+".join(phrase.split())) for phrase, label in PHRASES.items()}


class Rule(NamedTuple):
    label: str
    priority: int
    keywords: tuple[str, ...]
    pattern: re.Pattern


def _rule(label: str, priority: int, keywords: str, pattern: str) -> Rule:
    """In patterns a space stands between words, and {v} takes the words a version may be introduced by."""
    pattern = pattern.replace("{v}", "(?: (?:version|v|ver|release))? ?v?")
    return Rule(label, priority, tuple(keywords.split("|")), re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])"))


def _families() -> Iterator[Rule]:
    """Licences of which there are several versions; each gives rules for its name, its short name and its notice."""
    or_later = "(?: or(?: at your option)? (?:any )?later(?: version)?)"
    gnu = [("gpl", "gnu general public license", ("1", "2", "3")), ("lgpl", "gnu (?:lesser|library) general public license", ("2", "2 1", "3")), ("agpl", "gnu affero general public license", ("1", "3")), ("gfdl", "gnu free documentation license", ("1 1", "1 2", "1 3"))]
    for short, name, versions in gnu:
        for v in versions:
            dots, tail = v.replace(" ", "."), "" if " " in v else "(?: 0)?"
            yield _rule(f"{short}-{dots}", 70, "gnu", f"{name}{{v}} ?{v}{tail}(?: only)?")
            yield _rule(f"{short}-{dots}-or-later", 75, "gnu", f"{name}{{v}} ?{v}{tail}(?: of the license)?{or_later}")
            yield _rule(f"{short}-{dots}", 60, short, f"(?:gnu )?{short}(?:{{v}} ?| )?{v}{tail}(?: only)?")
            yield _rule(f"{short}-{dots}-or-later", 65, short, f"(?:gnu )?{short}(?:{{v}} ?| )?{v}{tail}(?:{or_later}| plus)")
            yield _rule(f"{short}-{dots}", 72, short, f"spdx license identifier {short} {v}{tail} only")
            notice = f"{name} as published by the free software foundation(?: inc)?(?: either)?{{v}} ?{v}{tail}"
            yield _rule(f"{short}-{dots}", 71, "gnu", f"{notice}(?: only)?(?: of the license)?(?: only)?")
            yield _rule(f"{short}-{dots}-or-later", 76, "gnu", f"{notice}(?: of the license)?{or_later}")
        yield _rule(short, 40, "gnu", name)
        yield _rule(short, 30, short, f"(?:under|of) the (?:terms of the )?(?:gnu )?{short}")
    numbered = [
        ("apache", "apache(?: software)? license", ("1 0", "1 1", "2 0")), ("mpl", "mozilla public license", ("1 0", "1 1", "2 0")), ("epl", "eclipse public license", ("1 0", "2 0")),
        ("cddl", "common development and distribution license", ("1 0", "1 1")), ("afl", "academic free license", ("1 1", "1 2", "2 0", "2 1", "3 0")), ("osl", "open software license", ("1 0", "1 1", "2 0", "2 1", "3 0")),
        ("eupl", "european union public licen[cs]e", ("1 0", "1 1", "1 2")), ("artistic", "artistic license", ("1 0", "2 0")), ("bsl", "boost software license", ("1 0",)), ("cecill", "cecill(?: free software)? license(?: agreement)?", ("1 0", "1 1", "2 0", "2 1")),
        ("lppl", "latex project public license", ("1 0", "1 1", "1 2", "1 3")), ("cpl", "common public license", ("1 0",)), ("ipl", "ibm public license", ("1 0",)), ("ofl", "(?:sil )?open font license", ("1 0", "1 1")),
        ("php", "php license", ("3 0", "3 01")), ("zpl", "zope public license", ("1 1", "2 0", "2 1")), ("npl", "netscape public license", ("1 0", "1 1")), ("apsl", "apple public source license", ("1 0", "1 1", "1 2", "2 0")),
        ("qpl", "q public license", ("1 0",)), ("rpl", "reciprocal public license", ("1 1", "1 5")), ("spl", "sun public license", ("1 0",)), ("upl", "universal permissive license", ("1 0",)), ("ecl", "educational community license", ("1 0", "2 0")),
        ("sspl", "server side public license", ("1",)), ("busl", "business source license", ("1 0", "1 1")), ("polyform-nc", "polyform noncommercial license", ("1 0 0",)), ("polyform-sb", "polyform small business license", ("1 0 0",)),
        ("mulanpsl", "mulan permissive software license", ("1", "2")), ("odbl", "open (?:data commons )?(?:open )?database license", ("1 0",)), ("cal", "cryptographic autonomy license", ("1 0",)), ("nasa", "nasa open source agreement", ("1 3",)),
        ("openssl", "openssl license", ("1",)), ("unicode-dfs", "unicode license agreement data files and software", ("2015", "2016")), ("blueoak", "blue oak model license", ("1 0 0",)), ("ms-pl", "microsoft public license", ("1",)), ("ms-rl", "microsoft reciprocal license", ("1",)),
        ("watcom", "sybase open watcom public license", ("1 0",)), ("elastic", "elastic license", ("2 0",)), ("tapr-ohl", "tapr open hardware license", ("1 0",)), ("cern-ohl", "cern open hardware licen[cs]e", ("1 1", "1 2", "2")),
    ]
    for short, name, versions in numbered:
        key = max(re.sub(r"\(\?:[^)]*\)\??|\[[^]]*\]", " ", name).split(), key=len)
        for v in versions:
            dots = v.replace(" ", ".")
            yield _rule(f"{short}-{dots}", 70, key, f"{name}{{v}} ?{v}")
            yield _rule(f"{short}-{dots}-or-later", 75, key, f"{name}{{v}} ?{v}{or_later}")
            yield _rule(f"{short}-{dots}", 71, key, f"{name} either{{v}} ?{v}(?: of (?:the|this) license)?")
            yield _rule(f"{short}-{dots}-or-later", 76, key, f"{name}(?: either)?{{v}} ?{v}(?: of (?:the|this) license)?{or_later}")
            if "-" not in short and len(short) > 2:
                yield _rule(f"{short}-{dots}", 60, short, f"{short}(?:{{v}} ?| )?{v}")
        yield _rule(short, 40, key, name)
    for v in ("1 1", "1 2"):
        yield _rule(f"eupl-{v.replace(' ', '.')}-or-later", 76, "eupl", f"eupl version {v} (?:only )?or (?:[–—] )?as soon (?:as )?they will be approved by the european commission (?:[–—] )?subsequent versions of the eupl")
    terms = (("by", "attribution"), ("by sa", "attribution share ?alike"), ("by nd", "attribution no ?deriv(?:ative|ative work)s?"), ("by nc", "attribution non ?commercial"), ("by nc sa", "attribution non ?commercial share ?alike"), ("by nc nd", "attribution non ?commercial no ?deriv(?:ative|ative work)s?"))
    for short, name in terms:
        label = "cc-" + short.replace(" ", "-")
        for v in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            yield _rule(f"{label}-{v.replace(' ', '.')}", 60 + 2 * len(short), "cc", f"cc {short} {v}")
            yield _rule(f"{label}-{v.replace(' ', '.')}", 62 + len(name), "creative", f"creative commons {name}(?: international| unported| generic)?(?: public)?(?: license)?{{v}} ?{v}")
            yield _rule(f"{label}-{v.replace(' ', '.')}", 64, "creativecommons", f"creativecommons org licenses {short} {v}")
        yield _rule(label, 40 + 2 * len(short), "cc", f"cc {short}")
        yield _rule(label, 42 + len(name), "creative", f"creative commons {name}")


#: label | priority | keywords (any of them) | pattern
_SINGLE = """
mit | 50 | mit | (?:the )?mit license
mit | 55 | permission | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | 52 | expat | expat license
mit-0 | 60 | attribution | mit no attribution(?: license)?
bsd-2-clause | 60 | bsd | (?:simplified|2 clause|two clause|freebsd) bsd(?: license)?
bsd-2-clause | 60 | bsd | bsd 2 clause(?: license)?
bsd-3-clause | 60 | bsd | (?:modified|new|revised|3 clause|three clause) bsd(?: license)?
bsd-3-clause | 60 | bsd | bsd 3 clause(?: license)?
bsd-4-clause | 60 | bsd | (?:original|4 clause|four clause) bsd(?: license)?
bsd-4-clause | 60 | bsd | bsd 4 clause(?: license)?
0bsd | 60 | bsd | (?:zero clause|0 clause) bsd(?: license)?
bsd | 40 | bsd | (?:the )?bsd(?: style)? license
bsd-2-clause | 55 | redistribution | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | 58 | endorse | neither the name of .{1,80}? may be used to endorse or promote products
bsd-4-clause | 58 | advertising | all advertising materials mentioning features or use of this software must display
isc | 55 | isc | (?:the )?isc license
isc | 55 | granted | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
zlib | 50 | zlib | (?:zlib|zlib libpng) license
zlib | 55 | misrepresented | the origin of this software must not be misrepresented
unlicense | 55 | unlicense | (?:the )?unlicense
unlicense | 56 | unencumbered | free and unencumbered software released into the public domain
wtfpl | 55 | wtfpl | wtfpl
wtfpl | 55 | want | do what the .{1,12} you want to public license
cc0 | 55 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0 | 55 | cc | cc zero
public-domain | 45 | domain | (?:released|placed|dedicated) (?:in|into|to) the public domain
public-domain | 30 | domain | public domain
python | 50 | python | python software foundation license(?: agreement)?
python | 50 | psf | psf license(?: agreement)?
ruby | 50 | ruby | ruby license
vim | 50 | vim | vim license
postgresql | 50 | postgresql | postgresql license
ncsa | 50 | ncsa | (?:university of illinois )?ncsa open source license
x11 | 50 | x11 | (?:x11|mit x11) license
curl | 50 | curl | curl license
beerware | 50 | beer | beer ?ware license
json | 55 | evil | the software shall be used for good not evil
sleepycat | 50 | sleepycat | sleepycat license
intel | 50 | intel | intel (?:open source|simplified software) license
w3c | 50 | w3c | w3c software(?: notice and)?(?: license)?
hpnd | 50 | historical | historical permission notice and disclaimer
libpng | 50 | libpng | libpng license
freetype | 50 | freetype | freetype (?:project )?license
imagemagick | 50 | imagemagick | imagemagick license
naumen | 50 | naumen | naumen public license
nokia | 50 | nokia | nokia open source license
motosoto | 50 | motosoto | motosoto open source license
jabber | 50 | jabber | jabber open source license
entessa | 50 | entessa | entessa public license
fair | 50 | fair | fair license
eiffel | 50 | eiffel | eiffel forum license
ogl-uk | 50 | government | open government licen[cs]e
odc-by | 50 | commons | open data commons attribution license
pddl | 50 | dedication | (?:open data commons )?public domain dedication and license
proprietary | 45 | reserved | all rights reserved
proprietary | 50 | confidential | (?:proprietary and confidential|confidential and proprietary)
proprietary | 52 | prohibited | unauthorized (?:copying|reproduction|distribution)(?: of this file)?(?: via any medium)? is (?:strictly )?prohibited
free-use | 30 | freely | may be freely (?:distributed|copied|used)(?: and (?:distributed|copied|modified|used))*
share-alike | 30 | alike | share ?alike
non-commercial | 30 | commercial | for non ?commercial use only
mit | 57 | noninfringement | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
mit | 56 | sublicense | to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software
mit | 48 | mit | (?:released|licensed|distributed|available|published) under (?:the )?(?:terms of the )?mit
mit | 46 | mit | spdx license identifier mit
mit | 44 | mit | license mit
mit-modern | 60 | modern | mit license modern variant
mit-advertising | 60 | enlightenment | mit enlightenment (?:license|advertising)
bsd-2-clause | 54 | retain | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd-2-clause | 53 | reproduce | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-2-clause-patent | 62 | patent | bsd 2 clause plus patent license
bsd-3-clause-clear | 62 | clear | (?:the )?clear bsd license
bsd-3-clause-lbnl | 62 | lawrence | lawrence berkeley national labs bsd variant license
bsd-4-clause | 59 | acknowledgement | this product includes software developed by .{1,60}? acknowledgement
bsd-protection | 62 | protection | bsd protection license
bsd-source-code | 62 | attribution | bsd source code attribution
bsd | 35 | bsd | (?:released|licensed|distributed|available) under (?:the |a )?bsd
0bsd | 56 | 0bsd | (?:license )?0bsd
isc | 50 | isc | (?:released|licensed|distributed) under (?:the )?isc
isc | 48 | isc | spdx license identifier isc
apache | 45 | apache | (?:released|licensed|distributed|available) under (?:the )?(?:terms of the )?apache
apache-2.0 | 66 | apache | licensed under the apache license version 2 0 the license
apache-2.0 | 64 | limitations | see the license for the specific language governing permissions and limitations under the license
apache-2.0 | 64 | compliance | you may not use this file except in compliance with the license
apache-2.0 | 65 | apache | http www apache org licenses license 2 0
apache-2.0 | 58 | apache2|asl | (?:apache2|asl ?2 0)
gpl | 45 | gpl | (?:released|licensed|distributed|available|free software) under (?:the )?(?:terms of the )?(?:gnu )?gpl
gpl | 42 | warranty | this program is distributed in the hope that it will be useful but without any warranty
gpl | 43 | franklin | write to the free software foundation inc (?:51|59) .{1,40}? franklin
gpl-2 | 63 | gplv2 | (?:gnu )?gplv2
gpl-3 | 63 | gplv3 | (?:gnu )?gplv3
gpl-2-or-later | 67 | gplv2 | (?:gnu )?gplv2 (?:plus|or later)
gpl-3-or-later | 67 | gplv3 | (?:gnu )?gplv3 (?:plus|or later)
gpl | 41 | gnu | www gnu org licenses gpl(?: 2 0| 3 0)?(?: html| txt)?
lgpl | 41 | gnu | www gnu org licenses lgpl(?: 2 1| 3 0)?(?: html| txt)?
agpl | 41 | gnu | www gnu org licenses agpl(?: 3 0)?(?: html| txt)?
lgpl-2.1 | 63 | lgplv2 | (?:gnu )?lgplv2(?: 1)?
lgpl-3 | 63 | lgplv3 | (?:gnu )?lgplv3
agpl-3 | 63 | agplv3 | (?:gnu )?agplv3
gpl-classpath-exception | 68 | classpath | (?:with (?:the )?)?classpath exception
gpl-linking-exception | 68 | linking | (?:with (?:the |a )?)?(?:static |special )?linking exception
gpl-font-exception | 68 | font | gpl font exception
gpl-bison-exception | 68 | bison | bison exception
gpl-autoconf-exception | 68 | autoconf | autoconf (?:configure script )?exception
gcc-runtime-exception | 68 | gcc | gcc runtime library exception
openssl-exception | 68 | openssl | openssl (?:linking )?exception
llvm-exception | 68 | llvm | (?:apache 2 0 )?with llvm exceptions?
gfdl | 47 | documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl | 44 | invariant | with no invariant sections
mpl | 47 | mozilla | http (?:www )?mozilla org mpl
mpl-2.0 | 66 | mpl | this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed
epl | 47 | eclipse | https? www eclipse org (?:legal )?epl
cddl | 46 | cddl | (?:released|licensed|distributed) under (?:the )?cddl
cpl | 46 | cpl | (?:released|licensed|distributed) under (?:the )?cpl
unlicense | 54 | unlicense | (?:http|https) unlicense org
unlicense | 57 | heirs | for the benefit of the public at large and to the detriment of our heirs and successors
cc0 | 57 | cc0 | cc0 1 0 universal public domain dedication
cc0 | 56 | waived | has waived all copyright and related or neighboring rights
cc0 | 54 | publicdomain | creativecommons org publicdomain zero 1 0
cc-pdm | 54 | publicdomain | creativecommons org publicdomain mark 1 0
cc-pdm | 52 | mark | public domain mark(?: 1 0)?
cc-sampling | 52 | sampling | creative commons sampling(?: plus)?
cc-devnations | 52 | developing | creative commons developing nations
creative-commons | 25 | creative | creative commons
public-domain | 46 | domain | (?:this|the) (?:work|file|code|text|software|document) is in the public domain
public-domain | 46 | domain | no copyright (?:is )?(?:claimed )?public domain
public-domain | 47 | government | work of the (?:united states|u s) government
public-domain | 44 | expired | copyright (?:has|have) expired
zlib | 56 | altered | altered source versions must be plainly marked as such
zlib | 56 | commercial | permission is granted to anyone to use this software for any purpose including commercial applications
boost | 58 | boost | distributed under the boost software license
boost | 56 | boost | http www boost org license 1 0 txt
python | 52 | python | python license 2 0
python | 52 | cnri | cnri python(?: open source)? license
artistic | 48 | perl | (?:the )?same terms as perl(?: itself)?
artistic-perl | 50 | clarified | clarified artistic license
php | 48 | php | (?:released|licensed) under (?:the )?php license
openssl | 52 | ssleay | (?:original )?ssleay license
openssl | 55 | toolkit | this product includes software developed by the openssl project for use in the openssl toolkit
x11 | 52 | consortium | x consortium license
x11-distribute | 54 | x11 | x11 license distribution modification variant
ijg | 52 | jpeg | this software is based in part on the work of the independent jpeg group
ntp | 52 | ntp | ntp license
tcl | 52 | tcl | tcl tk license
bzip2 | 52 | bzip2 | bzip2 (?:and libbzip2 )?license
icu | 52 | icu | icu license
unicode | 50 | unicode | unicode (?:license|terms of use)
libtiff | 52 | libtiff | libtiff license
netcdf | 52 | netcdf | netcdf license
sqlite-blessing | 56 | forgiveness | may you find forgiveness for yourself and forgive others
sqlite-blessing | 55 | blessing | in place of a legal notice here is a blessing
beerware | 55 | beer | you can buy me a beer in return
catosl | 52 | computer | computer associates trusted open source license
condor | 52 | condor | condor public license
cua | 52 | cua | cua office public license
ecos | 52 | ecos | ecos license
efl | 52 | eiffel | eiffel forum license (?:1|2)(?: 0)?
eudatagrid | 52 | datagrid | eu datagrid software license
frameworx | 52 | frameworx | frameworx (?:open )?license
gust-font | 52 | gust | gust font (?:source )?license
lucent | 52 | lucent | lucent public license
miros | 52 | miros | (?:the )?miros licen[cs]e
multics | 52 | multics | multics license
nethack | 52 | nethack | nethack general public license
nlpl | 52 | limit | no limit public license
ngpl | 52 | nethack | nethack gpl
noweb | 52 | noweb | noweb license
nposl | 52 | profit | non profit open software license
oclc | 52 | oclc | oclc research public license
oset | 52 | oset | oset public license
parity | 52 | parity | parity public license
prosperity | 52 | prosperity | prosperity public license
realnetworks | 52 | realnetworks | realnetworks public source license
ricoh | 52 | ricoh | ricoh source code public license
sax | 52 | sax | sax public domain notice
sendmail | 52 | sendmail | sendmail license
simpl | 52 | simple | simple public license
sissl | 52 | sun | sun industry standards source license
tmate | 52 | tmate | tmate open source license
torque | 52 | torque | torque v2 5 software license
unlicense-libtelnet | 52 | libtelnet | libtelnet license
vovida | 52 | vovida | vovida software license
vsl | 52 | vovida | vovida license
wxwindows | 54 | wxwindows | wxwindows library licen[cs]e
yahoo | 52 | yahoo | yahoo public license
zimbra | 52 | zimbra | zimbra public license
hippocratic | 52 | hippocratic | hippocratic license
anti996 | 52 | 996 | anti 996 license
commons-clause | 58 | commons | commons clause(?: license condition)?
confluent | 52 | confluent | confluent community license
cockroach | 52 | cockroach | cockroach(?:db)? community license
mongodb | 50 | mongodb | mongodb public license
redis-source | 52 | redis | redis source available license
timescale | 52 | timescale | timescale license
fair-source | 52 | fair | fair source license
functional-source | 52 | functional | functional source license
polyform | 50 | polyform | polyform (?:shield|strict|internal use|free trial|perimeter) license
openrail | 56 | rail | (?:creative ml )?open ?rail(?: m| d| s)?
llama-community | 56 | llama | llama (?:2|3|3 1|3 2) community license(?: agreement)?
bloom-rail | 56 | bigscience | bigscience (?:bloom )?rail license
odc-by | 52 | odc | odc by(?: 1 0)?
odbl | 52 | odbl | (?:released|licensed|made available) under (?:the )?odbl
pddl | 52 | pddl | pddl(?: 1 0)?
cdla-permissive | 56 | permissive | community data license agreement permissive(?: (?:1|2) 0)?
cdla-sharing | 56 | sharing | community data license agreement sharing(?: 1 0)?
ogl-uk | 52 | contains | contains public sector information licensed under the open government licen[cs]e
ogl-canada | 54 | canada | open government licen[cs]e canada
dl-de-by | 56 | datenlizenz | datenlizenz deutschland namensnennung
dl-de-zero | 56 | datenlizenz | datenlizenz deutschland zero
etalab | 56 | etalab | (?:licence ouverte|open licence) (?:v2 0 )?etalab
iodl | 56 | italian | italian open data license
kogl | 56 | korea | korea open government license
norwegian-open-data | 56 | norwegian | norwegian licen[cs]e for open government data
opl | 52 | publication | open publication license
open-game | 54 | gaming|game | open (?:game|gaming) license
free-art | 56 | art | free art license|licence art libre
design-science | 52 | science | design science license
against-drm | 52 | drm | against drm
ofl | 55 | reserved | with reserved font name
bitstream-vera | 56 | bitstream | bitstream vera fonts? (?:copyright|license)
arphic | 56 | arphic | arphic public license
ubuntu-font | 56 | ubuntu | ubuntu font licen[cs]e
ipa-font | 56 | ipa | ipa font license
stix-font | 56 | stix | stix fonts? (?:user )?license
lppl | 56 | lppl|latex | (?:latex project public license|lppl) (?:maintenance status|maintained)
knuth-ctan | 54 | ctan | knuth ctan license
cecill-b | 58 | cecill | cecill b(?: free software)?(?: license(?: agreement)?)?
cecill-c | 58 | cecill | cecill c(?: free software)?(?: license(?: agreement)?)?
licence-libre-quebec | 56 | québec | licence libre du québec
mulan | 50 | mulan|木兰 | 木兰宽松许可证|mulan psl
nasa | 50 | nasa | nasa open source
noassertion-eula | 48 | user | end user licen[cs]e agreement
proprietary | 50 | property | (?:this (?:file|document|software) is )?the (?:confidential|exclusive) property of
proprietary | 51 | trade | (?:contains|constitutes) (?:confidential )?trade secrets
proprietary | 48 | permission | may not be (?:reproduced|copied|distributed|used) (?:in any form )?without (?:the )?(?:prior )?(?:express )?(?:written )?permission
proprietary | 48 | consent | without (?:the )?(?:prior )?(?:express )?written consent
proprietary | 46 | unpublished | unpublished (?:work|source code|rights reserved)
evaluation-only | 48 | evaluation | for (?:internal )?evaluation purposes only
academic-only | 48 | academic|educational|research | for (?:academic|educational|research)(?: and (?:academic|educational|research))? (?:use|purposes) only
personal-use | 40 | personal | for personal use only
no-derivatives | 34 | derivative | no derivative works?
attribution-required | 32 | attribution | (?:proper )?attribution (?:is )?required
dual-license | 36 | dual|dually | (?:dual|dually) licen[cs]ed
multi-license | 36 | choice|option | (?:at your choice|at your option) (?:of )?(?:either|any) (?:of the following )?licen[cs]es?
license-file | 15 | license|copying|licence | see (?:the )?(?:file )?(?:license|licence|copying)(?: txt| md)?(?: file)?(?: for details)?
all-wrongs | 40 | wrongs | all wrongs reserved
copyleft | 34 | copyleft | copyleft(?: all wrongs reserved)?
spdx | 20 | spdx | spdx license identifier
copyright-notice | 10 | copyright | copyright(?: c)? (?:19|20)[0-9]{2}
"""


def build_rules() -> list[Rule]:
    """All rules; a rule's place in the list settles ties of priority and length."""
    single = [_rule(*(f(x.strip()) for f, x in zip((str, int, str, str), line.split(" | ", 3), strict=True))) for line in _SINGLE.strip().splitlines()]
    return [*_families(), *single]


class Scanner:
    def __init__(self, rules: list[Rule]):
        self.rules, self.gate = rules, ahocorasick.Automaton()
        of: dict[str, list[int]] = {}
        for i, r in enumerate(rules):
            for k in r.keywords:
                of.setdefault(k, []).append(i)
        for k, at in of.items():
            self.gate.add_word(k, at)
        self.gate.make_automaton()

    def detections(self, lower: str) -> list[tuple[int, int, Rule]]:
        """(start, end, rule) in normal text; those inside a stronger one are left out."""
        tried = sorted({i for _, at in self.gate.iter(lower) for i in at})
        if not tried:
            return []
        text = " ".join(WORD.findall(lower))
        found = [(m.start(), m.end(), i) for i in tried for m in self.rules[i].pattern.finditer(text)]
        found.sort(key=lambda x: (-self.rules[x[2]].priority, x[0], -x[1], x[2]))
        kept: list[tuple[int, int, int]] = []
        for _, level in groupby(found, lambda x: self.rules[x[2]].priority):
            # an interval lies in a stronger one if, of those that start no later, one ends no sooner
            stronger = sorted(kept)
            starts, ends = [a for a, _, _ in stronger], list(accumulate((b for _, b, _ in stronger), max))
            reach = -1  # furthest end at this level
            for start, end, i in level:
                at = bisect_right(starts, start)
                if end > reach and not (at and ends[at - 1] >= end):
                    kept.append((start, end, i))
                reach = max(reach, end)
        return [(a, b, self.rules[i]) for a, b, i in sorted(kept)]

    def scan(self, text: str | None) -> tuple[int, int, int | None, int | None, str, str, float]:
        text = text or ""
        lower = text.lower() if text.isascii() else text.translate(_LOWER)
        n_words = len(WORD.findall(lower))
        starts: list[int] = []
        base = set()
        if any(p.search(lower) for p in _CHEAP.values()):
            normal = " ".join(WORD.findall(lower))
            for label, p in _PHRASE.items():
                word = at = 0
                for m in p.finditer(normal):  # words are counted from match to match
                    word, at = word + normal.count(" ", at, m.start()), m.start()
                    starts.append(word)
                    base.add(label)
        own = self.detections(lower)
        labels = base | {r.label for _, _, r in own}
        score = max([0.0, *(min(1.0, r.priority / 100) for _, _, r in own), *(0.5 for _ in base)])
        return n_words, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def scan_licenses(docs: DataFrame) -> DataFrame:
    """The documents with all their columns and a struct license_scan (with a _ behind it, if they have such a column)."""

    @F.pandas_udf(f"struct<{SCHEMA.replace(' ', ':').replace(',:', ',')}>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(build_rules())
        for texts in batches:
            out = pd.DataFrame([scanner.scan(t) for t in texts], columns=_NAMES)
            yield out.astype({"first_word": "Int64", "last_word": "Int64"})

    return docs.withColumn(own_names(docs, "license_scan")["license_scan"], scan(F.col("text").cast("string")))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "license_scan.*")


QUERIES = {"op10_license_scan": op10_license_scan}

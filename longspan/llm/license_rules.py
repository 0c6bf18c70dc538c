"""Signatures of licenses, written by hand: one a line, as label, keywords and pattern.

A pattern runs over the words of a text, in small letters and with one space between two, and begins and ends at word edges. The
keywords are words without which it can't match. Names in braces stand for the parts in ``PARTS``. Kinds come in blocks, highest
priority first; within a kind the order of the lines is the order of the rules.
"""

from __future__ import annotations

#: Turns of phrase that many patterns share.
PARTS = {
    "id": "spdx license identifier ",
    "under": "(?:licensed|released|distributed|available|provided|published|issued|covered|redistributable) (?:to you )?"
             "(?:under|by|subject to|in accordance with) (?:(?:the|a|an) )?(?:terms (?:and conditions )?of (?:the )?)?",
    "v": "(?:version |ver |v ?)?",
    "lic": "licen[cs]e",
    "later": "(?: or| and) (?:any later(?: version)?|later|newer|greater|above)",
}

#: Priority and confidence of each kind.
KINDS = {
    "identifier": (90, 1.0), "exception": (88, 0.95), "negation": (87, 0.9), "choice": (86, 0.95), "grant": (80, 0.95),
    "text": (70, 0.9), "url": (65, 0.9), "notice": (60, 0.8), "phrase": (50, 0.7), "title": (40, 0.6),
}

RULES = {
    "identifier": r"""
mit-or-apache-2.0 | spdx mit apache | {id}(?:mit or apache 2 0|apache 2 0 or mit)
gpl-2.0-or-mit | spdx gpl mit | {id}(?:gpl 2 0(?: only| or later)? or mit|mit or gpl 2 0(?: only| or later)?)
gpl-2.0-or-bsd | spdx gpl bsd | {id}(?:gpl 2 0(?: only| or later)? or bsd [23] clause|bsd [23] clause or gpl 2 0(?: only| or later)?)
linux-syscall-note | spdx gpl syscall | {id}gpl 2 0(?: only| or later)? with linux syscall note
classpath-exception | spdx gpl classpath | {id}gpl [23] 0(?: only| or later)? with classpath exception(?: 2 0)?
gcc-exception | spdx gpl gcc | {id}gpl [23] 0(?: only| or later)? with gcc exception(?: [23] [01])?
llvm-exception | spdx apache llvm | {id}apache 2 0 with llvm exception
gpl-1.0 | spdx gpl 1 | {id}gpl 1 0(?: only| or later)?
gpl-2.0+ | spdx gpl 2 later | {id}gpl 2 0 or later
gpl-2.0 | spdx gpl 2 | {id}gpl 2 0(?: only)?
gpl-3.0+ | spdx gpl 3 later | {id}gpl 3 0 or later
gpl-3.0 | spdx gpl 3 | {id}gpl 3 0(?: only)?
lgpl-2.0 | spdx lgpl 2 | {id}lgpl 2 0(?: only| or later)?
lgpl-2.1+ | spdx lgpl 2 later | {id}lgpl 2 1 or later
lgpl-2.1 | spdx lgpl 2 | {id}lgpl 2 1(?: only)?
lgpl-3.0+ | spdx lgpl 3 later | {id}lgpl 3 0 or later
lgpl-3.0 | spdx lgpl 3 | {id}lgpl 3 0(?: only)?
agpl-3.0+ | spdx agpl 3 later | {id}agpl 3 0 or later
agpl-3.0 | spdx agpl 3 | {id}agpl 3 0(?: only)?
gfdl-1.3 | spdx gfdl | {id}gfdl 1 [123](?: only| or later)?
apache-1.1 | spdx apache 1 | {id}apache 1 [01]
apache-2.0 | spdx apache 2 | {id}apache 2 0
mit-0 | spdx mit 0 | {id}mit 0
mit | spdx mit | {id}mit
x11 | spdx x11 | {id}x11
0bsd | spdx 0bsd | {id}0bsd
bsd-1-clause | spdx bsd 1 | {id}bsd 1 clause
bsd-2-clause | spdx bsd 2 | {id}bsd 2 clause(?: (?:patent|views))?
bsd-3-clause | spdx bsd 3 | {id}bsd 3 clause(?: (?:clear|lbnl|attribution))?
bsd-4-clause | spdx bsd 4 | {id}bsd 4 clause(?: uc)?
isc | spdx isc | {id}isc
mpl-1.1 | spdx mpl 1 | {id}mpl 1 [01]
mpl-2.0 | spdx mpl 2 | {id}mpl 2 0(?: no copyleft exception)?
epl-1.0 | spdx epl 1 | {id}epl 1 0
epl-2.0 | spdx epl 2 | {id}epl 2 0
cddl-1.0 | spdx cddl | {id}cddl 1 [01]
cpl-1.0 | spdx cpl | {id}cpl 1 0
artistic-1.0 | spdx artistic 1 | {id}artistic 1 0(?: perl)?
artistic-2.0 | spdx artistic 2 | {id}artistic 2 0
zlib | spdx zlib | {id}zlib
libpng | spdx libpng | {id}libpng(?: 2 0)?
bsl-1.0 | spdx bsl | {id}bsl 1 0
busl-1.1 | spdx busl | {id}busl 1 1
unlicense | spdx unlicense | {id}unlicense
wtfpl | spdx wtfpl | {id}wtfpl
cc0-1.0 | spdx cc0 | {id}cc0 1 0
cc-by-nc-nd | spdx cc nc nd | {id}cc by nc nd [1234] [05]
cc-by-nc-sa | spdx cc nc sa | {id}cc by nc sa [1234] [05]
cc-by-nc | spdx cc nc | {id}cc by nc [1234] [05]
cc-by-nd | spdx cc nd | {id}cc by nd [1234] [05]
cc-by-sa-3.0 | spdx cc sa 3 | {id}cc by sa 3 0
cc-by-sa-4.0 | spdx cc sa 4 | {id}cc by sa 4 0
cc-by-3.0 | spdx cc by 3 | {id}cc by 3 0
cc-by-4.0 | spdx cc by 4 | {id}cc by 4 0
ofl-1.1 | spdx ofl | {id}ofl 1 [01](?: (?:no )?rfn)?
postgresql | spdx postgresql | {id}postgresql
python-2.0 | spdx 2 0 | {id}(?:python|psf) 2 0(?: 1)?
ruby | spdx ruby | {id}ruby
php-3.01 | spdx php | {id}php 3 (?:0|01)
ncsa | spdx ncsa | {id}ncsa
odbl-1.0 | spdx odbl | {id}odbl 1 0
ms-pl | spdx ms pl | {id}ms pl
ms-rl | spdx ms rl | {id}ms rl
eupl-1.2 | spdx eupl | {id}eupl 1 [12]
osl-3.0 | spdx osl | {id}osl [123] [01]
afl-3.0 | spdx afl | {id}afl [123] [012]
upl-1.0 | spdx upl | {id}upl 1 0
ecl-2.0 | spdx ecl | {id}ecl [12] 0
mulanpsl-2.0 | spdx mulanpsl | {id}mulanpsl [12] 0
blueoak-1.0.0 | spdx blueoak | {id}blueoak 1 0 0
openssl | spdx openssl | {id}openssl
curl | spdx curl | {id}curl
vim | spdx vim | {id}vim
""",
    "exception": r"""
classpath-exception | linking statically modules | linking this library statically or dynamically with other modules is making a combined work
classpath-exception | classpath exception | (?:gnu )?(?:gpl )?(?:{v}[23](?: 0)? )?(?:with )?(?:the )?(?:gnu )?classpath (?:linking )?exception
gcc-exception | gcc runtime library exception | gcc runtime library exception(?: {v}3(?: 1)?)?
llvm-exception | llvm exceptions | (?:with )?llvm exceptions(?: to the apache 2 0 {lic})?
openssl-exception | openssl permission link | permission to link (?:the code of )?(?:portions of )?this (?:program|software) with (?:the )?openssl(?: library| project s openssl library)?
bison-exception | bison parser skeleton | part or all of the bison parser skeleton
autoconf-exception | configuration script generated autoconf | a configuration script generated by autoconf
font-exception | font embed document | (?:as a special exception )?if you create a document which uses this font and embed this font
linking-exception | linking exception | (?:with )?(?:a |the )?(?:static )?linking exception
universal-foss-exception | universal foss exception | universal foss exception(?: {v}1 0)?
syscall-note | kernel services normal system calls | user programs that use kernel services by normal system calls
commons-clause | commons clause condition | commons clause (?:{lic} )?condition(?: {v}1 0)?
""",
    "negation": r"""
not-gpl | not gnu general public | (?:is|are) not (?:licensed|released|distributed|available|covered) (?:under|by) (?:the )?(?:terms of (?:the )?)?gnu general public {lic}
not-gpl | not gpl | (?:is|are) not (?:licensed|released|distributed|available|covered) (?:under|by) (?:the )?(?:terms of (?:the )?)?(?:gnu )?gpl
not-apache | not apache | (?:is|are) not (?:licensed|released|distributed|available|covered) (?:under|by) (?:the )?(?:terms of (?:the )?)?apache {lic}
not-mit | not mit | (?:is|are) not (?:licensed|released|distributed|available|covered) (?:under|by) (?:the )?(?:terms of (?:the )?)?mit {lic}
not-bsd | not bsd | (?:is|are) not (?:licensed|released|distributed|available|covered) (?:under|by) (?:the )?(?:terms of (?:the )?)?bsd {lic}
not-cc | not creative commons | (?:is|are) not (?:licensed|released|distributed|available|covered) (?:under|by) (?:the |a )?(?:terms of (?:the )?)?creative commons {lic}
not-gpl | incompatible gpl | (?:is )?incompatible with the (?:gnu )?gpl
not-open | not open source | (?:is|are) not (?:an )?open source (?:software|{lic}|project)
not-public-domain | not public domain | (?:is|are) not (?:in|part of) the public domain
""",
    "choice": r"""
mit-or-apache-2.0 | mit apache under | (?:dual )?(?:licensed )?under (?:either )?(?:of )?(?:the )?(?:terms of )?(?:both )?(?:the )?apache(?: {lic})?(?: {v}2(?: 0)?)? (?:or|and) (?:the )?mit(?: {lic}s?)?
mit-or-apache-2.0 | mit apache under | (?:dual )?(?:licensed )?under (?:either )?(?:of )?(?:the )?(?:terms of )?(?:both )?(?:the )?mit(?: {lic})? (?:or|and) (?:the )?apache(?: {lic}s?)?(?: {v}2(?: 0)?)?
mit-or-apache-2.0 | mit apache | at your option (?:the )?(?:mit {lic} or (?:the )?apache|apache {lic} or (?:the )?mit)
gpl-or-mit | dual gpl mit | dual (?:licensed )?(?:under )?(?:the )?(?:mit (?:and|or) (?:the )?gpl|gpl (?:and|or) (?:the )?mit)(?: {lic}s?)?
gpl-or-bsd | dual gpl bsd | dual (?:licensed )?(?:under )?(?:the )?(?:bsd (?:and|or) (?:the )?gpl|gpl (?:and|or) (?:the )?bsd)(?: {lic}s?)?
gpl-or-bsd | alternatively bsd | alternatively this (?:software|file|program) may be (?:distributed|used) under (?:the )?(?:terms of )?(?:the )?bsd {lic}
gpl-or-other | alternatively gnu general public | alternatively (?:this (?:software|file|program) may be (?:distributed|used|licensed)|the contents of this file may be used) under the terms of (?:either )?the gnu general public {lic}
lgpl-or-mpl | alternatively gnu lesser general public | alternatively the contents of this file may be used under the terms of (?:either )?the gnu lesser general public {lic}
gpl-or-artistic | same terms perl itself | (?:it )?under the same terms as (?:the )?perl(?: 5)?(?: programming language system)? itself
gpl-or-commercial | commercial gpl | (?:a )?commercial {lic} (?:or|as an alternative to) the (?:gnu )?gpl
epl-or-apache | eclipse apache public | eclipse public {lic} {v}[12] 0 (?:and|or) (?:the )?apache {lic} {v}2 0
epl-or-gpl | secondary licenses eclipse | this source code may also be made available under the following secondary licenses when the conditions for such availability set forth in the eclipse
ruby-or-bsd | ruby s bsd | ruby s {lic} or (?:the )?(?:2 clause )?bsd(?: l| {lic})?
""",
    "grant": r"""
gpl-1.0 | gnu general public | {under}gnu general public {lic} {v}1(?: 0)?(?:{later})?
gpl-2.0+ | gnu general public | {under}gnu general public {lic} (?:as published by the free software foundation )?(?:either )?{v}2(?: 0)?(?: of the {lic})?{later}
gpl-2.0 | gnu general public | {under}gnu general public {lic} (?:as published by the free software foundation )?(?:either )?{v}2(?: 0)?
gpl-3.0+ | gnu general public | {under}gnu general public {lic} (?:as published by the free software foundation )?(?:either )?{v}3(?: 0)?(?: of the {lic})?{later}
gpl-3.0 | gnu general public | {under}gnu general public {lic} (?:as published by the free software foundation )?(?:either )?{v}3(?: 0)?
gpl | gnu general public | {under}gnu general public {lic}
gpl-2.0 | gpl | {under}(?:gnu )?gpl {v}2(?: 0)?(?: only)?
gpl-2.0 | gplv2 | {under}(?:gnu )?gplv2(?: 0)?(?: only)?
gpl-3.0 | gpl | {under}(?:gnu )?gpl {v}3(?: 0)?(?: only)?
gpl-3.0 | gplv3 | {under}(?:gnu )?gplv3(?: 0)?(?: only)?
gpl | gpl | {under}(?:gnu )?gpl
lgpl-2.1 | gnu lesser general public 1 | {under}gnu lesser general public {lic} {v}2 1(?:{later})?
lgpl-3.0 | gnu lesser general public | {under}gnu lesser general public {lic} {v}3(?: 0)?(?:{later})?
lgpl | gnu lesser general public | {under}gnu lesser general public {lic}
lgpl-2.0 | gnu library general public | {under}gnu library general public {lic}(?: {v}2(?: 0)?)?
lgpl | lgpl | {under}(?:gnu )?lgpl(?: {v}[23](?: [01])?)?
agpl-3.0 | gnu affero general public | {under}gnu affero general public {lic}(?: {v}3(?: 0)?)?
agpl-3.0 | agpl | {under}(?:gnu )?agpl(?: {v}3(?: 0)?)?
gfdl | gnu free documentation | {under}gnu free documentation {lic}(?: {v}1 [123])?
apache-1.1 | apache | {under}apache (?:software )?{lic} {v}1 [01]
apache-2.0 | apache | {under}apache (?:software )?(?:{lic} )?{v}2(?: 0)?(?: {lic})?
apache | apache | {under}apache (?:software )?{lic}
mit-0 | mit attribution | {under}mit no attribution(?: {lic})?
mit | mit | {under}(?:permissive )?mit(?: style| x11)?(?: open source)? {lic}
mit | expat | {under}expat(?: mit)? {lic}
bsd-2-clause | bsd 2 | {under}(?:bsd 2 clause|2 clause bsd)(?: {lic})?
bsd-2-clause | bsd simplified | {under}simplified bsd(?: {lic})?
bsd-3-clause | bsd 3 | {under}(?:bsd 3 clause|3 clause bsd)(?: {lic})?
bsd-3-clause | bsd three | {under}three clause bsd(?: {lic})?
bsd-3-clause | bsd | {under}(?:new|modified|revised) bsd(?: {lic})?
bsd-4-clause | bsd | {under}(?:original|old) bsd(?: {lic})?
bsd | bsd | {under}bsd(?: style)? {lic}
isc | isc | {under}isc {lic}
mpl-1.1 | mozilla public | {under}mozilla public {lic} {v}1 [01]
mpl-2.0 | mozilla public | {under}mozilla public {lic} {v}2(?: 0)?
mpl-2.0 | mpl | {under}mpl {v}2(?: 0)?
epl-1.0 | eclipse public | {under}eclipse public {lic} {v}1 0
epl-2.0 | eclipse public | {under}eclipse public {lic} {v}2 0
cddl-1.0 | common development distribution | {under}common development and distribution {lic}(?: {v}1 [01])?
artistic-2.0 | artistic | {under}artistic {lic} {v}2(?: 0)?
artistic | artistic | {under}(?:perl )?artistic {lic}
zlib | zlib | {under}zlib(?: libpng)? {lic}
bsl-1.0 | boost software | {under}boost software {lic}(?: {v}1 0)?
busl-1.1 | business source | {under}business source {lic}(?: {v}1 1)?
cc-by-nc-sa | creative commons attribution | {under}creative commons attribution non ?commercial share ?alike(?: {v}[1234] [05])?(?: international| unported| generic)?(?: {lic})?
cc-by-nc-nd | creative commons attribution | {under}creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: works)?(?: {v}[1234] [05])?(?: international| unported| generic)?(?: {lic})?
cc-by-nc | creative commons attribution | {under}creative commons attribution non ?commercial(?: {v}[1234] [05])?(?: international| unported| generic)?(?: {lic})?
cc-by-sa-4.0 | creative commons attribution 0 | {under}creative commons attribution share ?alike {v}4 0(?: international)?(?: {lic})?
cc-by-sa-3.0 | creative commons attribution 0 | {under}creative commons attribution share ?alike {v}3 0(?: unported)?(?: {lic})?
cc-by-sa | creative commons attribution | {under}creative commons attribution share ?alike(?: {lic})?
cc-by-nd | creative commons attribution | {under}creative commons attribution no ?deriv(?:ative)?s(?: works)?(?: {v}[1234] [05])?(?: international| unported)?(?: {lic})?
cc-by-4.0 | creative commons attribution 0 | {under}creative commons attribution {v}4 0(?: international)?(?: public)?(?: {lic})?
cc-by-3.0 | creative commons attribution 0 | {under}creative commons attribution {v}3 0(?: unported)?(?: {lic})?
cc-by | creative commons attribution | {under}creative commons attribution(?: {lic})?
cc-by-sa | cc by sa | {under}cc by sa(?: [1234] [05])?(?: {lic})?
cc-by-nc | cc by nc | {under}cc by nc(?: [1234] [05])?(?: {lic})?
cc-by | cc by | {under}cc by(?: [1234] [05])?(?: {lic})?
cc0-1.0 | cc0 | {under}cc0(?: 1 0)?(?: universal)?(?: {lic})?
ofl-1.1 | sil open font | {under}sil open font {lic}(?: {v}1 [01])?
postgresql | postgresql | {under}postgresql {lic}
python-2.0 | python | {under}python (?:software foundation )?{lic}(?: {v}2)?
python-2.0 | psf | {under}psf {lic}(?: {v}2)?
php | php | {under}php {lic}(?: {v}3(?: 01?)?)?
ms-pl | microsoft public | {under}microsoft public {lic}
ms-rl | microsoft reciprocal | {under}microsoft reciprocal {lic}
eupl-1.2 | european union public | {under}european union public {lic}(?: {v}1 [12])?
odbl-1.0 | open database | {under}open (?:data commons open )?database {lic}(?: {v}1 0)?
wtfpl | do what the fuck you want to public | {under}do what the fuck you want to public {lic}
unlicense | unlicense | {under}unlicense
""",
    "text": r"""
mit | permission hereby granted free charge | permission is hereby granted free of charge to any person obtaining a copy of this (?:software|font software|work)(?: and associated documentation files)?(?: the software)?
mit | copyright permission notice included copies | the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies(?: or substantial portions of the software)?
mit | merchantability particular warranties | including but not limited to the warranties of merchantability fitness for a particular purpose and non ?infringement
mit-0 | deal restriction | to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided
bsd | redistribution source binary forms modification permitted | redistribution and use in source and binary forms with or without modification are permitted
bsd | redistributions source retain copyright notice | redistributions of source code must retain the (?:above )?copyright notice(?: this list of conditions and the following disclaimer)?
bsd | redistributions binary reproduce copyright | redistributions in binary form must reproduce the (?:above )?copyright notice
bsd-3-clause | endorse promote products derived prior | (?:names? of (?:its |the )?(?:contributors|copyright holders?) )?may (?:not )?be used to endorse or promote products derived from this software without (?:specific )?prior written permission
bsd-4-clause | advertising materials mentioning features | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
isc | permission use copy modify distribute fee | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
ntp | permission use copy modify distribute documentation | permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?(?:with or )?without fee is hereby granted
apache-2.0 | may use except compliance | you may not use this (?:file|work|software) except in compliance with the {lic}
apache-2.0 | unless required applicable law agreed writing | unless required by applicable law or agreed to in writing software distributed under the {lic}
apache-2.0 | asf more contributor agreements | licensed to the apache software foundation asf under one or more contributor {lic} agreements
apache-2.0 | contributor perpetual worldwide irrevocable | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable
apache-1.1 | product includes developed apache | this product includes software developed by the apache (?:software foundation|group)
gpl | free redistribute modify terms | this (?:program|file|software|code|package) is free software you can redistribute it and or modify it under the terms of the gnu general public {lic}
gpl | free redistribute modify | this (?:program|file|software|code|package) is free software you can redistribute it and or modify it
gpl | distributed hope useful warranty | this (?:program|file|software|code|package) is distributed in the hope that it will be useful but without any warranty
gpl | should received copy gnu general public | you should have received a copy of the gnu general public {lic}(?: along with this (?:program|file|software|code|package))?
gpl | everyone permitted copy distribute verbatim | everyone is permitted to copy and distribute verbatim copies of this {lic} document but changing it is not allowed
gpl | designed freedom share change | designed to take away your freedom to share and change
gpl | guarantee freedom share change | intended to guarantee your freedom to share and change
gpl-3.0 | free copyleft software other works | is a free copyleft {lic} for software and other kinds of works
agpl-3.0 | cooperation community network server | specifically designed to ensure cooperation with the community in the case of network server software
agpl-3.0 | should received copy gnu affero | you should have received a copy of the gnu affero general public {lic}(?: along with this (?:program|file|software|code|package))?
lgpl | library free redistribute modify | this library is free software you can redistribute it and or modify it(?: under the terms of the gnu (?:lesser|library) general public {lic})?
lgpl | should received copy gnu general public | you should have received a copy of the gnu (?:lesser|library) general public {lic}(?: along with this (?:library|program|file|software))?
lgpl-2.1 | first released version lesser gpl | this is the first released version of the lesser gpl
lgpl | work uses library | a work that uses the library
gfdl | permission granted copy distribute document | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation {lic}
gfdl | invariant sections cover texts | with no invariant sections (?:with )?no front cover texts and (?:with )?no back cover texts
mpl-2.0 | source form subject mozilla public | this source code form is subject to the terms of the mozilla public {lic}(?: {v}2 0)?
mpl-2.0 | copy mpl was distributed file | if a copy of the mpl was not distributed with this file you can obtain one at
mpl-1.1 | contents file subject mozilla public | the contents of this file are subject to the mozilla public {lic}(?: {v}1 [01])?
epl | accompanying materials made available eclipse public | this program and the accompanying materials are made available under the terms of the eclipse public {lic}(?: {v}[12] 0)?
epl | accompanying program provided | the accompanying program is provided under the terms of this eclipse public {lic}
cddl-1.0 | contents file subject common development distribution | the contents of this file are subject to the terms of (?:either the gnu general public {lic} {v}2 only gpl or )?the common development and distribution {lic}
cpl-1.0 | program accompanying materials common public | this program and the accompanying materials are made available under the terms of the common public {lic}
unlicense | free unencumbered released public domain | this is free and unencumbered software released into the public domain
unlicense | anyone free copy modify publish | anyone is free to copy modify publish use compile sell or distribute this software
zlib | altered source versions plainly marked | altered source versions must be plainly marked as such
zlib | origin misrepresented | the origin of this software must not be misrepresented
zlib | event held liable damages arising | in no event will the authors? be held liable for any damages arising from the use of this software
bsl-1.0 | permission hereby granted organization obtaining | permission is hereby granted free of charge to any person or organization obtaining a copy of the software
artistic-2.0 | standard version | you are permitted to use the standard version and create and use modified versions for any purpose
artistic-1.0 | intent document state conditions package | the intent of this document is to state the conditions under which a package may be copied
wtfpl | you just do what fuck want | you just do what the fuck you want to
beer-ware | beer ware | beer ware {lic}
beer-ware | beerware | beerware {lic}
beer-ware | retain notice you can whatever want stuff | as long as you retain this notice you can do whatever you want with this stuff(?: if we meet some day)?
cc0-1.0 | person associated work deed dedicated | the person who associated a work with this deed has dedicated the work to the public domain
cc0-1.0 | rights work worldwide copyright | by waiving all of his or her rights to the work worldwide under copyright law
cc0-1.0 | extent possible law waived copyright related neighboring | to the extent possible under law (?:the )?(?:author|person|[^ ]+(?: [^ ]+){0,3}) (?:has|have) waived all copyright and related or neighboring rights
cc-by | work licensed creative commons attribution | this work is licensed under (?:a |the )?creative commons attribution(?: [1234] [05])?(?: international| unported| generic)? {lic}
cc-by-sa | work licensed creative commons attribution | this work is licensed under (?:a |the )?creative commons attribution share ?alike(?: [1234] [05])?(?: international| unported| generic)? {lic}
cc-by-nc | work licensed creative commons attribution | this work is licensed under (?:a |the )?creative commons attribution non ?commercial(?: share ?alike| no ?derivatives)?(?: [1234] [05])?(?: international| unported| generic)? {lic}
ofl-1.1 | font software licensed sil open | this font software is licensed under the sil open font {lic}(?: {v}1 1)?
ofl-1.1 | reserved font | with reserved font names?
postgresql | permission use copy modify documentation without agreement | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
python-2.0 | agreement between python foundation | this {lic} agreement is between the python software foundation
php | product includes php freely available | this product includes php (?:software )?freely available from
openssl | product includes openssl | this product includes software developed by the openssl project(?: for use in the openssl toolkit)?
ms-pl | governs accompanying software accept | this {lic} governs use of the accompanying software if you use the software you accept this {lic}
upl-1.0 | universal permissive | universal permissive {lic}(?: {v}1 0)?
ncsa | permission hereby granted deal | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction
odbl-1.0 | database made available open | this database is made available under the open database {lic}
""",
    "url": r"""
apache-2.0 | apache org licenses | (?:www )?apache org licenses {lic} 2 0(?: (?:txt|html))?
apache-1.1 | apache org licenses 1 | (?:www )?apache org licenses {lic} 1 [01]
gpl-2.0 | gnu org licenses gpl 2 | (?:www )?gnu org licenses (?:old licenses )?gpl 2 0(?: (?:en )?(?:html|txt))?
gpl-3.0 | gnu org licenses gpl 3 | (?:www )?gnu org licenses gpl 3 0(?: (?:en )?(?:html|txt))?
gpl | gnu org licenses gpl | (?:www )?gnu org licenses gpl(?: (?:en )?html)?
gpl | gnu org copyleft gpl | (?:www )?gnu org copyleft gpl(?: html)?
lgpl-2.1 | gnu org licenses lgpl 2 1 | (?:www )?gnu org licenses (?:old licenses )?lgpl 2 1(?: (?:en )?(?:html|txt))?
lgpl-3.0 | gnu org licenses lgpl 3 | (?:www )?gnu org licenses lgpl 3 0(?: (?:en )?(?:html|txt))?
lgpl | gnu org licenses lgpl | (?:www )?gnu org licenses lgpl(?: (?:en )?html)?
agpl-3.0 | gnu org licenses agpl | (?:www )?gnu org licenses agpl(?: 3 0)?(?: (?:en )?(?:html|txt))?
gfdl | gnu org licenses fdl | (?:www )?gnu org licenses (?:old licenses )?fdl(?: 1 [123])?(?: (?:en )?(?:html|txt))?
gnu | gnu org licenses | (?:www )?gnu org licenses
mpl-2.0 | mozilla org mpl 2 | (?:www )?mozilla org (?:en us )?mpl 2 0
mpl-1.1 | mozilla org mpl 1 | (?:www )?mozilla org mpl mpl 1 1(?: html)?
epl-1.0 | eclipse org legal epl | (?:www )?eclipse org legal epl v10(?: html)?
epl-2.0 | eclipse org legal epl | (?:www )?eclipse org legal epl (?:2 0|v20)(?: html)?
mit | opensource org licenses mit | opensource org licenses mit(?: {lic})?(?: php)?
mit | opensource org license mit | opensource org license mit
mit | choosealicense com mit | choosealicense com licenses mit
apache-2.0 | opensource org licenses apache | opensource org licenses apache(?: {lic})? 2 0(?: php)?
bsd-2-clause | opensource org licenses bsd 2 clause | opensource org licenses bsd 2 clause
bsd-3-clause | opensource org licenses bsd 3 | opensource org licenses bsd 3 clause
bsd | opensource org licenses bsd | opensource org licenses bsd {lic}(?: php)?
isc | opensource org licenses isc | opensource org licenses isc(?: {lic})?
gpl-3.0 | opensource org licenses gpl 3 | opensource org licenses gpl 3 0
osl-3.0 | opensource org licenses osl | opensource org licenses osl 3 0(?: php)?
cddl-1.0 | opensource org licenses cddl1 | opensource org licenses cddl1(?: php)?
ms-pl | opensource org licenses ms pl | opensource org licenses ms pl(?: html)?
artistic-2.0 | opensource org licenses artistic | opensource org licenses artistic {lic} 2 0
bsl-1.0 | boost org 1 | (?:www )?boost org {lic} 1 0(?: txt)?
unlicense | unlicense org | unlicense org
wtfpl | wtfpl net | (?:www )?wtfpl net(?: about)?
wtfpl | sam zoy org wtfpl | sam zoy org wtfpl
ofl-1.1 | sil org ofl | scripts sil org ofl
python-2.0 | python org psf | (?:www )?python org psf {lic}
php | php net | (?:www )?php net {lic}(?: 3 01? txt)?
cc0-1.0 | creativecommons org publicdomain zero | (?:www )?creativecommons org publicdomain zero 1 0
pdm-1.0 | creativecommons org publicdomain mark | (?:www )?creativecommons org publicdomain mark 1 0
cc-by-nc-nd | creativecommons org licenses by nc nd | (?:www )?creativecommons org licenses by nc nd [1234] [05]
cc-by-nc-sa | creativecommons org licenses by nc sa | (?:www )?creativecommons org licenses by nc sa [1234] [05]
cc-by-nc | creativecommons org licenses by nc | (?:www )?creativecommons org licenses by nc(?: [1234] [05])?
cc-by-nd | creativecommons org licenses by nd | (?:www )?creativecommons org licenses by nd(?: [1234] [05])?
cc-by-sa-4.0 | creativecommons org licenses by sa 4 | (?:www )?creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | creativecommons org licenses by sa 3 | (?:www )?creativecommons org licenses by sa 3 0
cc-by-sa | creativecommons org licenses by sa | (?:www )?creativecommons org licenses by sa(?: [12] [05])?
cc-by-4.0 | creativecommons org licenses by 4 | (?:www )?creativecommons org licenses by 4 0
cc-by-3.0 | creativecommons org licenses by 3 | (?:www )?creativecommons org licenses by 3 0
cc-by | creativecommons org licenses by | (?:www )?creativecommons org licenses by(?: [12] [05])?
odbl-1.0 | opendatacommons org licenses odbl | (?:www )?opendatacommons org licenses odbl(?: 1 0)?
pddl-1.0 | opendatacommons org licenses pddl | (?:www )?opendatacommons org licenses pddl(?: 1 0)?
eupl | joinup ec europa eu eupl | joinup ec europa eu (?:[^ ]+ ){0,4}eupl
""",
    "notice": r"""
gpl | under terms gnu general public | under (?:the )?terms of (?:the )?gnu general public {lic}
lgpl | under terms gnu lesser general public | under (?:the )?terms of (?:the )?gnu lesser general public {lic}
apache | under terms apache | under (?:the )?terms of (?:the )?apache {lic}(?: {v}2(?: 0)?)?
mit | under terms mit | under (?:the )?terms of (?:the )?mit {lic}
bsd | under terms bsd | under (?:the )?terms of (?:the )?bsd(?: style)? {lic}
mpl | under terms mozilla public | under (?:the )?terms of (?:the )?mozilla public {lic}
cc-by | under terms creative commons attribution | under (?:the )?terms of (?:the |a )?creative commons attribution {lic}
gpl | gnu general public details | (?:see|refer to) the gnu general public {lic} for more details
lgpl | gnu lesser general public details | (?:see|refer to) the gnu lesser general public {lic} for more details
agpl | gnu affero general public details | (?:see|refer to) the gnu affero general public {lic} for more details
apache-2.0 | specific language governing permissions limitations | see the {lic} for the specific language governing permissions and limitations under the {lic}
proprietary | proprietary confidential | (?:this (?:file|document|software|information) is |strictly )?(?:proprietary and confidential|confidential and proprietary)
proprietary | unauthorized copying file medium | unauthorized copying of this file via any medium is strictly prohibited
proprietary | part this may | no part of this (?:publication|book|document|work|site) may be (?:reproduced|copied|transmitted|stored)
proprietary | without prior permission | without (?:the )?prior (?:written )?permission (?:in writing )?(?:of|from) the (?:publisher|author|copyright (?:owner|holder))
public-domain | public domain | (?:has been |is |was )?(?:hereby )?(?:released|placed|put) (?:into|in) the public domain
public-domain | dedicated public domain | (?:has been |is |was )?(?:hereby )?dedicated to the public domain
public-domain | public domain | (?:is|are) in the public domain(?: worldwide| in the united states)?
public-domain | work united states government public | (?:is )?a work of the united states government and is (?:therefore )?(?:in the )?public domain
sspl-1.0 | server side public | server side public {lic}(?: {v}1)?
elastic-2.0 | elastic | elastic {lic} (?:{v})2(?: 0)?
polyform | polyform | polyform (?:noncommercial|small business|strict|shield|perimeter)(?: {lic})?(?: 1 0 0)?
openrail | openrail | (?:creativeml |bigscience |bigcode )?openrail(?: (?:m|plus plus m))?(?: {lic})?
openrail | open rail | (?:creativeml |bigscience |bigcode )?open rail(?: (?:m|plus plus m))?(?: {lic})?
llama | llama community | llama (?:[234](?: [123])? )?community {lic}(?: agreement)?
""",
    "phrase": r"""
bsd-3-clause | neither nor | neither the names? of (?:[^ ]+ ){1,8}nor
proprietary | all rights reserved | all rights reserved
unknown-spdx | spdx license identifier | spdx license identifier
as-is | provided as is | (?:software |font software |work )?is provided (?:by [^ ]+(?: [^ ]+){0,4} )?as is (?:and )?without (?:any )?(?:express or implied )?warrant(?:y|ies)(?: of any kind)?
as-is | provided as is | (?:software|program|code) is provided as is
open-source | open source | (?:an |the )?open source {lic}
free-software | free software foundation | free software foundation
permissive | permissive | permissive {lic}
copyleft | copyleft | copyleft {lic}
attribution | attribution required | attribution (?:is )?required
noncommercial | non commercial use only | (?:for )?(?:personal and )?non commercial use only
noncommercial | commercial use prohibited | commercial use (?:is )?(?:strictly )?prohibited
""",
    "title": r"""
gpl-1.0 | gnu general public | gnu general public {lic} {v}1(?: 0)?
gpl-2.0 | gnu general public | gnu general public {lic} {v}2(?: 0)?
gpl-3.0 | gnu general public | gnu general public {lic} {v}3(?: 0)?
gpl | gnu general public | gnu general public licence
gpl-2.0 | gnu gpl | gnu gpl {v}2(?: 0)?
gpl-3.0 | gnu gpl | gnu gpl {v}3(?: 0)?
gpl | gnu gpl | gnu gpl
gpl-2.0 | gplv2 | gplv2(?: 0)?
gpl-3.0 | gplv3 | gplv3(?: 0)?
gpl-2.0 | gpl 0 | gpl (?:{v})2 0
gpl-3.0 | gpl 0 | gpl (?:{v})3 0
lgpl-2.0 | gnu library general public | gnu library general public {lic}(?: {v}2(?: 0)?)?
lgpl-2.1 | gnu lesser general public 1 | gnu lesser general public {lic} {v}2 1
lgpl-3.0 | gnu lesser general public | gnu lesser general public {lic} {v}3(?: 0)?
lgpl | gnu lesser general public | gnu lesser general public {lic}
lgpl-2.1 | lgpl 1 | lgpl {v}2 1
lgpl-2.1 | lgplv2 1 | lgplv2 1
lgpl-3.0 | lgpl 0 | lgpl {v}3 0
lgpl-3.0 | lgplv3 | lgplv3(?: 0)?
agpl-3.0 | gnu affero general public | gnu affero general public {lic} {v}3(?: 0)?
agpl | gnu affero general public | gnu affero general public {lic}
agpl-3.0 | agpl 0 | agpl {v}3 0
agpl-3.0 | agplv3 | agplv3(?: 0)?
gfdl-1.3 | gnu free documentation 3 | gnu free documentation {lic} {v}1 3
gfdl | gnu free documentation | gnu free documentation {lic}
apache-1.1 | apache | apache (?:software )?{lic} {v}1 [01]
apache-2.0 | apache | apache (?:software )?{lic} {v}2(?: 0)?
apache-2.0 | apache 0 | apache {v}2 0
apache | apache software | apache software {lic}
mit | mit | mit {lic}
mit | expat | expat {lic}
mit-0 | mit no attribution | mit no attribution
mit-0 | mit 0 | mit 0
x11 | x11 | x11 {lic}
bsd-2-clause | bsd 2 clause | (?:bsd 2 clause|2 clause bsd)(?: {lic})?
bsd-3-clause | bsd 3 clause | (?:bsd 3 clause|3 clause bsd)(?: {lic})?
bsd-4-clause | bsd 4 clause | (?:bsd 4 clause|4 clause bsd)(?: {lic})?
bsd-2-clause | simplified bsd | simplified bsd {lic}
bsd-2-clause | freebsd | freebsd {lic}
bsd-3-clause | bsd | (?:new|modified|revised) bsd {lic}
bsd-4-clause | original bsd | original bsd {lic}
0bsd | zero clause bsd | zero clause bsd(?: {lic})?
bsd | bsd | bsd {lic}
isc | isc | isc {lic}
mpl-1.1 | mozilla public | mozilla public {lic} {v}1 [01]
mpl-2.0 | mozilla public | mozilla public {lic} {v}2(?: 0)?
mpl | mozilla public | mozilla public {lic}
mpl-2.0 | mpl 0 | mpl {v}2 0
epl-1.0 | eclipse public | eclipse public {lic} {v}1 0
epl-2.0 | eclipse public | eclipse public {lic} {v}2 0
epl | eclipse public | eclipse public {lic}
cddl-1.0 | common development distribution | common development and distribution {lic}
cpl-1.0 | common public | common public {lic}
artistic-2.0 | artistic 0 | artistic {lic} {v}2 0
artistic | artistic | artistic {lic}
zlib | zlib | zlib(?: libpng)? {lic}
libpng | libpng | libpng {lic}
bsl-1.0 | boost software | boost software {lic}(?: {v}1 0)?
busl-1.1 | business source | business source {lic}(?: {v}1 1)?
unlicense | the unlicense | the unlicense
wtfpl | do what the fuck you want to public | do what the fuck you want to public {lic}
postgresql | postgresql | postgresql {lic}
python-2.0 | python software foundation | python software foundation {lic}
ruby | ruby | ruby {lic}
php | php | php {lic}(?: {v}3(?: 01?)?)?
perl | perl | perl {lic}
ofl-1.1 | sil open font | sil open font {lic}(?: {v}1 [01])?
ms-pl | microsoft public | microsoft public {lic}
ms-rl | microsoft reciprocal | microsoft reciprocal {lic}
eupl-1.2 | european union public | european union public {lic}(?: {v}1 [12])?
osl-3.0 | open software | open software {lic}(?: {v}3 0)?
afl-3.0 | academic free | academic free {lic}(?: {v}[23] [01])?
ecl-2.0 | educational community | educational community {lic}(?: {v}2 0)?
ncsa | university illinois ncsa | university of illinois ncsa open source {lic}
odbl-1.0 | open database | open database {lic}
odc-by-1.0 | open data commons attribution | open data commons attribution {lic}(?: {v}1 0)?
pddl-1.0 | public domain dedication | public domain dedication and {lic}
cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | creative commons zero | creative commons zero(?: {v}1 0)?(?: universal)?
cc-by-nc-nd | cc by nc nd | cc by nc nd(?: [1234] [05])?
cc-by-nc-sa | cc by nc sa | cc by nc sa(?: [1234] [05])?
cc-by-sa-4.0 | cc by sa 4 0 | cc by sa 4 0
cc-by-sa-3.0 | cc by sa 3 0 | cc by sa 3 0
cc-by-sa | cc by sa | cc by sa
cc-by-nc | cc by nc | cc by nc(?: [1234] [05])?
cc-by-nd | cc by nd | cc by nd(?: [1234] [05])?
cc-by-4.0 | cc by 4 0 | cc by 4 0
cc-by-3.0 | cc by 3 0 | cc by 3 0
cc-by-nc-sa | creative commons attribution | creative commons attribution non ?commercial share ?alike(?: {v}[1234] [05])?
cc-by-nc-nd | creative commons attribution | creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: {v}[1234] [05])?
cc-by-nc | creative commons attribution | creative commons attribution non ?commercial(?: {v}[1234] [05])?
cc-by-nd | creative commons attribution | creative commons attribution no ?deriv(?:ative)?s(?: {v}[1234] [05])?
cc-by-sa | creative commons attribution | creative commons attribution share ?alike(?: {v}[1234] [05])?
cc-by-4.0 | creative commons attribution 0 | creative commons attribution {v}4 0(?: international)?
cc-by-3.0 | creative commons attribution 0 | creative commons attribution {v}3 0(?: unported)?
cc-by | creative commons attribution | creative commons attribution
ogl-uk-3.0 | open government | open government {lic}(?: {v}[123](?: 0)?)?
gnu-all-permissive | gnu all permissive | gnu all permissive {lic}
""",
}


def lines() -> list[tuple[str, str, str, str]]:
    """``(kind, label, keywords, pattern)`` of each rule in order, parts filled in."""
    out = []
    for kind, block in RULES.items():
        for line in filter(None, block.split("\n")):
            label, keywords, pattern = line.split(" | ", 2)
            for name, part in PARTS.items():
                pattern = pattern.replace("{" + name + "}", part)
            out.append((kind, label, keywords, pattern))
    return out

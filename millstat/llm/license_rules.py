"""Signature rules of the license scan, in order.

One rule a line: ``label priority weight | keywords | rest``. A keyword is
the first word of a signature; the rest is a pattern of the words after it, over
words of a-z, 0-9 and non-ASCII characters joined by single spaces. Priority
1: a license's own text or identifier, 2: its name, 3: a mention that any
license of the family may have. Where two rules find the same words the
upper one holds.
"""

from __future__ import annotations

from dataclasses import dataclass

V = "(?:version |v ?)?"                       # "version 2", "v2", "v 2", "2"
LIC = "(?:license|licence)"
LATER = "(?: or(?: at your option)? (?:any )?later(?: version)?| plus)?"

TEXT = f"""
gpl 3 0.6 | gnu | general public license
apache 3 0.6 | apache | license
cc-by 3 0.6 | cc | by
mit 3 0.6 | mit | license
agpl-1.0 1 0.95 | agpl | 1 0
agpl-3.0 1 0.95 | agpl | {V}3(?: 0)?(?: only| or later)?
agpl-3.0 1 0.95 | agplv3 agpl3 |
agpl-3.0 2 0.9 | gnu | affero general public {LIC}(?: as published by the free software foundation)? {V}3(?: 0)?{LATER}
agpl-3.0 2 0.9 | affero | general public {LIC} {V}3(?: 0)?{LATER}
agpl 3 0.7 | gnu | affero general public {LIC}
agpl 3 0.7 | gnu | agpl
agpl 3 0.6 | affero | general public {LIC}
lgpl-2.0 1 0.95 | lgpl | {V}2 0(?: only| or later)?
lgpl-2.1 1 0.95 | lgpl | {V}2 1(?: only| or later)?
lgpl-3.0 1 0.95 | lgpl | {V}3(?: 0)?(?: only| or later)?
lgpl-2.1 1 0.95 | lgplv2 | 1
lgpl-3.0 1 0.95 | lgplv3 lgpl3 |
lgpl-2.0 2 0.9 | gnu | library general public {LIC} {V}2(?: 0)?{LATER}
lgpl-2.0 2 0.9 | gnu | lesser general public {LIC} {V}2(?: 0)?{LATER}
lgpl-2.1 2 0.9 | gnu | lesser general public {LIC}(?: as published by the free software foundation either)? {V}2 1{LATER}
lgpl-3.0 2 0.9 | gnu | lesser general public {LIC}(?: as published by the free software foundation either)? {V}3(?: 0)?{LATER}
lgpl 3 0.7 | gnu | (?:lesser|library) general public {LIC}
lgpl 3 0.7 | gnu | (?:lesser|library) gpl
lgpl 3 0.6 | lesser | general public {LIC}
lgpl 3 0.6 | gnu | lgpl
gpl-1.0 1 0.95 | gpl | {V}1 0(?: only| or later)?
gpl-2.0 1 0.95 | gpl | {V}2(?: 0)?(?: only| or later)?
gpl-3.0 1 0.95 | gpl | {V}3(?: 0)?(?: only| or later)?
gpl-2.0 1 0.95 | gplv2 gpl2 |
gpl-3.0 1 0.95 | gplv3 gpl3 |
gpl-1.0 2 0.9 | gnu | general public {LIC} {V}1(?: 0)?{LATER}
gpl-2.0 2 0.9 | gnu | general public {LIC}(?: as published by the free software foundation either)? {V}2(?: 0)?{LATER}
gpl-3.0 2 0.9 | gnu | general public {LIC}(?: as published by the free software foundation either)? {V}3(?: 0)?{LATER}
gpl-2.0-classpath 1 0.95 | gpl | 2 0 with classpath exception
gpl-2.0-classpath 1 0.95 | classpath | exception 2 0
gpl 3 0.6 | gnu | gpl
gpl 3 0.6 | gnu | general public licence
gfdl-1.1 1 0.95 | gfdl | 1 1
gfdl-1.2 1 0.95 | gfdl | 1 2
gfdl-1.3 1 0.95 | gfdl | 1 3
gfdl-1.2 2 0.9 | gnu | free documentation {LIC} {V}1 2{LATER}
gfdl-1.3 2 0.9 | gnu | free documentation {LIC} {V}1 3{LATER}
gfdl 3 0.7 | gnu | free documentation {LIC}
apache-1.0 2 0.9 | apache | (?:software )?{LIC} {V}1 0
apache-1.1 2 0.9 | apache | (?:software )?{LIC} {V}1 1
apache-2.0 2 0.9 | apache | (?:software )?{LIC} {V}2(?: 0)?
apache-1.0 1 0.95 | apache | 1 0
apache-1.1 1 0.95 | apache | 1 1
apache-2.0 1 0.95 | apache | 2(?: 0)?
apache-2.0 1 0.95 | asl | 2 0
apache-2.0 1 0.95 | www | apache org licenses license 2 0
apache-2.0 1 0.95 | apache | org licenses license 2 0
apache-2.0 1 0.95 | licensed | under the apache {LIC} {V}2 0(?: the {LIC})?
apache 3 0.6 | apache | (?:software|public) {LIC}
cc-by-1.0 1 0.95 | cc | by 1 0
cc-by-2.0 1 0.95 | cc | by 2 0
cc-by-2.5 1 0.95 | cc | by 2 5
cc-by-3.0 1 0.95 | cc | by 3 0
cc-by-4.0 1 0.95 | cc | by 4 0
cc-by-sa-2.0 1 0.95 | cc | by sa 2 0
cc-by-sa-2.5 1 0.95 | cc | by sa 2 5
cc-by-sa-3.0 1 0.95 | cc | by sa 3 0
cc-by-sa-4.0 1 0.95 | cc | by sa 4 0
cc-by-nd-3.0 1 0.95 | cc | by nd 3 0
cc-by-nd-4.0 1 0.95 | cc | by nd 4 0
cc-by-nc-2.0 1 0.95 | cc | by nc 2 0
cc-by-nc-3.0 1 0.95 | cc | by nc 3 0
cc-by-nc-4.0 1 0.95 | cc | by nc 4 0
cc-by-nc-sa-2.0 1 0.95 | cc | by nc sa 2 0
cc-by-nc-sa-3.0 1 0.95 | cc | by nc sa 3 0
cc-by-nc-sa-4.0 1 0.95 | cc | by nc sa 4 0
cc-by-nc-nd-3.0 1 0.95 | cc | by nc nd 3 0
cc-by-nc-nd-4.0 1 0.95 | cc | by nc nd 4 0
cc-by-sa 2 0.8 | cc | by sa
cc-by-nd 2 0.8 | cc | by nd
cc-by-nc-sa 2 0.8 | cc | by nc sa
cc-by-nc-nd 2 0.8 | cc | by nc nd
cc-by-nc 2 0.8 | cc | by nc
cc0-1.0 1 0.95 | cc0 | 1 0(?: universal)?
cc0-1.0 2 0.8 | cc0 |
cc0-1.0 1 0.95 | creativecommons | org publicdomain zero 1 0
cc-pdm-1.0 1 0.95 | creativecommons | org publicdomain mark 1 0
cc-by-2.0 1 0.95 | creativecommons | org licenses by 2 0
cc-by-3.0 1 0.95 | creativecommons | org licenses by 3 0
cc-by-4.0 1 0.95 | creativecommons | org licenses by 4 0
cc-by-sa-3.0 1 0.95 | creativecommons | org licenses by sa 3 0
cc-by-sa-4.0 1 0.95 | creativecommons | org licenses by sa 4 0
cc-by-nd-4.0 1 0.95 | creativecommons | org licenses by nd 4 0
cc-by-nc-3.0 1 0.95 | creativecommons | org licenses by nc 3 0
cc-by-nc-4.0 1 0.95 | creativecommons | org licenses by nc 4 0
cc-by-nc-sa-3.0 1 0.95 | creativecommons | org licenses by nc sa 3 0
cc-by-nc-sa-4.0 1 0.95 | creativecommons | org licenses by nc sa 4 0
cc-by-nc-nd-4.0 1 0.95 | creativecommons | org licenses by nc nd 4 0
cc0-1.0 2 0.9 | creative | commons (?:cc0|zero)(?: 1 0)?(?: universal)?
cc-by-nc-nd 2 0.85 | creative | commons attribution non ?commercial no ?deriv(?:s|atives|ative works)
cc-by-nc-sa 2 0.85 | creative | commons attribution non ?commercial share ?alike
cc-by-nc 2 0.85 | creative | commons attribution non ?commercial
cc-by-nd 2 0.85 | creative | commons attribution no ?deriv(?:s|atives|ative works)
cc-by-sa 2 0.85 | creative | commons attribution share ?alike
cc-by 2 0.85 | creative | commons attribution
cc 3 0.5 | creative | commons {LIC}
mit 1 0.98 | permission | is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit-0 1 0.95 | mit | 0
mit-0 2 0.9 | mit | no attribution
mit 2 0.8 | expat | {LIC}
mit 2 0.8 | mit | licence
mit 2 0.8 | mit | expat
mit 1 0.95 | opensource | org licenses mit(?: {LIC})?(?: php)?
mit 2 0.85 | licensed | under (?:the )?mit
mit 2 0.8 | released | under (?:the )?mit
mit-advertising 1 0.95 | mit | advertising
mit-cmu 1 0.95 | mit | cmu
mit-modern 1 0.95 | mit | modern variant
x11 2 0.85 | x11 | {LIC}
x11 2 0.85 | mit | x11(?: {LIC})?
bsd-3-clause 1 0.98 | redistribution | and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd 1 0.9 | redistribution | and use in source and binary forms with or without modification are permitted
bsd-1-clause 1 0.95 | bsd | 1 clause
bsd-2-clause-patent 1 0.95 | bsd | 2 clause patent
bsd-2-clause-views 1 0.95 | bsd | 2 clause (?:freebsd|views)
bsd-2-clause 1 0.95 | bsd | 2 clause(?: {LIC})?
bsd-3-clause-clear 1 0.95 | bsd | 3 clause clear
bsd-3-clause-lbnl 1 0.95 | bsd | 3 clause lbnl
bsd-3-clause 1 0.95 | bsd | 3 clause(?: {LIC})?
bsd-4-clause-uc 1 0.95 | bsd | 4 clause uc
bsd-4-clause 1 0.95 | bsd | 4 clause(?: {LIC})?
bsd-source-code 1 0.95 | bsd | source code
0bsd 1 0.95 | 0bsd |
0bsd 2 0.9 | zero | clause bsd(?: {LIC})?
bsd-2-clause 2 0.9 | simplified | bsd(?: {LIC})?
bsd-2-clause 2 0.9 | freebsd | {LIC}
bsd-2-clause 2 0.9 | two | clause bsd(?: {LIC})?
bsd-3-clause 2 0.9 | new | bsd(?: {LIC})?
bsd-3-clause 2 0.9 | modified | bsd(?: {LIC})?
bsd-3-clause 2 0.9 | revised | bsd(?: {LIC})?
bsd-3-clause 2 0.9 | three | clause bsd(?: {LIC})?
bsd-4-clause 2 0.9 | original | bsd(?: {LIC})?
bsd-4-clause 2 0.9 | four | clause bsd(?: {LIC})?
bsd 3 0.6 | bsd | (?:style )?{LIC}
bsd-3-clause 1 0.95 | opensource | org licenses bsd 3 clause
bsd-2-clause 1 0.95 | opensource | org licenses bsd 2 clause
bsd 2 0.8 | licensed | under (?:the |a )?bsd
isc 1 0.95 | permission | to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc 2 0.85 | isc | {LIC}
isc 1 0.95 | opensource | org licenses isc
hpnd 1 0.9 | permission | to use copy modify and distribute this software and its documentation for any purpose
hpnd 2 0.85 | historical | permission notice and disclaimer
ntp 2 0.85 | ntp | {LIC}
mpl-1.0 1 0.95 | mpl | {V}1 0
mpl-1.1 1 0.95 | mpl | {V}1 1
mpl-2.0 1 0.95 | mpl | {V}2 0
mpl-1.0 2 0.9 | mozilla | public {LIC} {V}1 0
mpl-1.1 2 0.9 | mozilla | public {LIC} {V}1 1
mpl-2.0 2 0.9 | mozilla | public {LIC} {V}2(?: 0)?
mpl-2.0 1 0.98 | source | code form is subject to the terms of the mozilla public {LIC} v 2 0
mpl-2.0 1 0.95 | mozilla | org mpl 2 0
mpl 3 0.7 | mozilla | public {LIC}
epl-1.0 1 0.95 | epl | {V}1 0
epl-2.0 1 0.95 | epl | {V}2 0
epl-1.0 2 0.9 | eclipse | public {LIC} {V}1(?: 0)?
epl-2.0 2 0.9 | eclipse | public {LIC} {V}2(?: 0)?
epl-1.0 1 0.95 | eclipse | org legal epl v10
epl-2.0 1 0.95 | eclipse | org legal epl (?:v20|2 0)
epl 3 0.7 | eclipse | public {LIC}
edl-1.0 2 0.9 | eclipse | distribution {LIC}(?: {V}1 0)?
cddl-1.0 1 0.95 | cddl | {V}1 0
cddl-1.1 1 0.95 | cddl | {V}1 1
cddl 2 0.85 | common | development and distribution {LIC}
cpl-1.0 1 0.95 | cpl | 1 0
cpl-1.0 2 0.85 | common | public {LIC}(?: {V}1 0)?
cpal-1.0 1 0.95 | cpal | 1 0
cpal-1.0 2 0.85 | common | public attribution {LIC}
apsl-1.0 1 0.95 | apsl | 1 0
apsl-2.0 1 0.95 | apsl | 2 0
apsl-2.0 2 0.85 | apple | public source {LIC}
artistic-1.0 1 0.95 | artistic | 1 0(?: perl)?
artistic-2.0 1 0.95 | artistic | 2 0
artistic-1.0 2 0.9 | artistic | {LIC} {V}1(?: 0)?
artistic-2.0 2 0.9 | artistic | {LIC} {V}2(?: 0)?
artistic 3 0.6 | artistic | {LIC}
afl-2.1 1 0.95 | afl | 2 1
afl-3.0 1 0.95 | afl | 3 0
afl-3.0 2 0.85 | academic | free {LIC}
osl-2.1 1 0.95 | osl | 2 1
osl-3.0 1 0.95 | osl | 3 0
osl-3.0 2 0.85 | open | software {LIC}
bsl-1.0 1 0.95 | bsl | 1 0
bsl-1.0 2 0.9 | boost | software {LIC}(?: {V}1 0)?
bsl-1.0 1 0.95 | boost | org license 1 0(?: txt)?
busl-1.1 1 0.95 | busl | 1 1
busl-1.1 2 0.85 | business | source {LIC}(?: {V}1 1)?
sspl-1.0 1 0.95 | sspl | 1 0
sspl-1.0 2 0.9 | server | side public {LIC}
elastic-2.0 1 0.95 | elastic | 2 0
elastic-2.0 2 0.85 | elastic | {LIC}(?: {V}2 0)?
unlicense 1 0.98 | unencumbered | software released into the public domain
unlicense 2 0.85 | unlicense |
unlicense 1 0.95 | unlicense | org
wtfpl 2 0.85 | wtfpl |
wtfpl 2 0.85 | fuck | you want to public {LIC}
zlib 1 0.95 | zlib | libpng {LIC}
zlib 2 0.85 | zlib | {LIC}
zlib 1 0.9 | provided | as is without any express or implied warranty
libpng 2 0.85 | libpng | {LIC}
libtiff 2 0.85 | libtiff | {LIC}
openssl 2 0.85 | openssl | {LIC}
ssleay 2 0.85 | ssleay | {LIC}
curl 2 0.85 | curl | {LIC}
python-2.0 1 0.95 | psf | 2 0
python-2.0 2 0.9 | python | software foundation {LIC}
python-2.0 2 0.85 | psf | {LIC}
python-2.0 3 0.6 | python | {LIC}
php-3.0 1 0.95 | php | (?:{LIC} )?{V}3 0
php-3.01 1 0.95 | php | (?:{LIC} )?{V}3 01
php 3 0.6 | php | {LIC}
ruby 2 0.85 | ruby | {LIC}
perl 2 0.8 | terms | as perl(?: itself)?
postgresql 2 0.85 | postgresql | {LIC}
sqlite-blessing 1 0.95 | good | and not evil may you find forgiveness
w3c 2 0.85 | w3c | (?:software notice and )?{LIC}
unicode-dfs-2016 2 0.85 | unicode | (?:inc )?{LIC}
icu 2 0.85 | icu | {LIC}
vim 2 0.85 | vim | {LIC}
tcl 2 0.8 | tcl | {LIC}
qpl-1.0 1 0.95 | qpl | 1 0
qpl-1.0 2 0.85 | q | public {LIC}
ofl-1.0 1 0.95 | ofl | 1 0
ofl-1.1 1 0.95 | ofl | 1 1
ofl-1.1 2 0.9 | sil | open font {LIC}(?: {V}1 1)?
ofl 3 0.7 | open | font {LIC}
ipl-1.0 1 0.95 | ipl | 1 0
ipl-1.0 2 0.85 | ibm | public {LIC}
ms-pl 1 0.95 | ms | pl
ms-rl 1 0.95 | ms | rl
ms-pl 2 0.9 | microsoft | public {LIC}
ms-rl 2 0.9 | microsoft | reciprocal {LIC}
ncsa 2 0.85 | ncsa | (?:open source )?{LIC}
ncsa 2 0.85 | university | of illinois (?:ncsa )?open source {LIC}
eupl-1.1 1 0.95 | eupl | {V}1 1
eupl-1.2 1 0.95 | eupl | {V}1 2
eupl 2 0.85 | european | union public {LIC}
cecill-2.1 1 0.95 | cecill | (?:{LIC} )?{V}2 1
cecill-b 1 0.9 | cecill | b
cecill-c 1 0.9 | cecill | c
cecill 3 0.6 | cecill |
mulanpsl-2.0 1 0.95 | mulanpsl | 2 0
mulanpsl-2.0 2 0.9 | mulan | psl(?: v ?2)?
upl-1.0 1 0.95 | upl | 1 0
upl-1.0 2 0.9 | universal | permissive {LIC}
odbl-1.0 1 0.95 | odbl | 1 0
odbl-1.0 2 0.9 | open | (?:data commons open )?database {LIC}
odc-by-1.0 1 0.95 | odc | by(?: 1 0)?
pddl-1.0 1 0.95 | pddl | 1 0
pddl-1.0 2 0.9 | public | domain dedication and {LIC}
public-domain 2 0.7 | released | (?:in)?to the public domain
public-domain 2 0.7 | dedicated | to the public domain
public-domain 3 0.4 | public | domain
nposl-3.0 1 0.95 | nposl | 3 0
rpl-1.5 1 0.95 | rpl | 1 5
rpl-1.5 2 0.85 | reciprocal | public {LIC}
sleepycat 2 0.85 | sleepycat | {LIC}
beerware 2 0.85 | beer | ware {LIC}
beerware 2 0.85 | beerware | {LIC}
json 1 0.95 | used | for good not evil
json 2 0.7 | json | {LIC}
bigscience-openrail-m 1 0.95 | bigscience | (?:open ?)?rail(?: m)?(?: {LIC})?
openrail 2 0.8 | openrail | m(?: {LIC})?
llama2 2 0.85 | llama | 2 community {LIC}
llama3 2 0.85 | llama | 3(?: 1| 2| 3)? community {LIC}
gemma 2 0.8 | gemma | terms of use
proprietary 2 0.6 | rights | reserved
proprietary 2 0.7 | proprietary | and confidential
proprietary 2 0.7 | unauthorized | copying of this file
gpl 2 0.85 | redistribute | it and or modify it under the terms of the gnu general public {LIC}
gpl 2 0.7 | licensed | under (?:the )?(?:terms of the )?(?:gnu )?gpl
lgpl 2 0.7 | licensed | under (?:the )?(?:terms of the )?(?:gnu )?lgpl
mpl 2 0.7 | licensed | under (?:the )?mpl
cc 2 0.6 | licensed | under a creative commons
gpl 1 0.95 | gnu | org licenses gpl(?: {V}[0-9])?(?: 0)?(?: html| txt)?
lgpl 1 0.95 | gnu | org licenses lgpl(?: {V}[0-9])?(?: [0-9])?(?: html| txt)?
agpl 1 0.95 | gnu | org licenses agpl(?: {V}[0-9])?(?: 0)?(?: html| txt)?
spdx-tag 1 0.9 | spdx | license identifier
unstated 3 0.2 | license | (?:file|txt|md)
"""

BASE = 4  #: the first rules are the contract's phrases: their places always count


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    priority: int
    weight: float
    keywords: tuple[str, ...]
    pattern: str  #: matches a window of words, each followed by one space


def _rules() -> list[Rule]:
    out = []
    for n, line in enumerate(filter(None, TEXT.split("\n")), 1):
        head, keys, rest = (x.strip() for x in line.split("|", 2))
        label, priority, weight = head.split()
        keywords = tuple(keys.split())
        first = keywords[0] if len(keywords) == 1 else f"(?:{'|'.join(keywords)})"
        out.append(Rule(n, label, int(priority), float(weight), keywords, f"^{first}{' ' + rest if rest else ''} "))
    return out


RULES = _rules()
KEYWORDS: dict[str, list[Rule]] = {}
for _rule in RULES:
    for _word in _rule.keywords:
        KEYWORDS.setdefault(_word, []).append(_rule)

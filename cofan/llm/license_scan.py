r"""License detection by ordered signature rules, with DataFrame functions only.

A text is lower-cased (A-Z) and reduced to its words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``
with single spaces.  ``RULES`` are hand-written regular expressions over such words,
each with a label, a priority (1 strongest) and a gate: a plain keyword without which
the expression cannot match.  A text is searched for the gates first, and only the
rules of the gates it holds are run, so most texts run no expression at all.

Every match of a rule is a detection, as word places [start, end).  Detections are
ordered by start, longer ones first, then by priority and the order of the rules.  A
detection inside an earlier one of the same or a stronger priority is suppressed; one
that a weaker detection contains, or that overlaps another, stays.

``phrases`` are base signatures: they are found at every place, and nothing suppresses
their labels.  ``score`` is the confidence of the strongest detection that stays (by
priority, ``CONFIDENCE``; 1 for a phrase), 0 without any.

Null text counts as empty: no words, no detections, empty strings for the labels, nulls
for the places.  Repeated rows are scanned each; an empty table gives an empty result;
other columns are kept, those named like an output are replaced.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that part words.
PARTS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONFIDENCE = {1: 0.98, 2: 0.85, 3: 0.6}
#: Fixed values of the query.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

#: Gate: rules "label priority expression", one a line; an expression matches whole words
#: and contains its gate.  ``L`` stands for license or licence, ``V`` for an optional
#: "version" or "v" before a number.
_RULES = {
    "spdx": r"""
mit 1 spdx L identifier mit
mit-0 1 spdx L identifier mit 0
apache-1.1 1 spdx L identifier apache 1 1
apache-2.0 1 spdx L identifier apache 2 0
bsd-2-clause 1 spdx L identifier bsd 2 clause
bsd-3-clause 1 spdx L identifier bsd 3 clause
bsd-4-clause 1 spdx L identifier bsd 4 clause
0bsd 1 spdx L identifier 0bsd
gpl-1.0 1 spdx L identifier gpl 1 0(?: only| or later)?
gpl-2.0-only 1 spdx L identifier gpl 2 0(?: only)?
gpl-2.0-or-later 1 spdx L identifier gpl 2 0 or later
gpl-3.0-only 1 spdx L identifier gpl 3 0(?: only)?
gpl-3.0-or-later 1 spdx L identifier gpl 3 0 or later
lgpl-2.0 1 spdx L identifier lgpl 2 0(?: only| or later)?
lgpl-2.1 1 spdx L identifier lgpl 2 1(?: only| or later)?
lgpl-3.0 1 spdx L identifier lgpl 3 0(?: only| or later)?
agpl-3.0 1 spdx L identifier agpl 3 0(?: only| or later)?
mpl-1.1 1 spdx L identifier mpl 1 1
mpl-2.0 1 spdx L identifier mpl 2 0
epl-1.0 1 spdx L identifier epl 1 0
epl-2.0 1 spdx L identifier epl 2 0
cddl-1.0 1 spdx L identifier cddl 1 0
eupl-1.2 1 spdx L identifier eupl 1 2
isc 1 spdx L identifier isc
zlib 1 spdx L identifier zlib
bsl-1.0 1 spdx L identifier bsl 1 0
unlicense 1 spdx L identifier unlicense
wtfpl 1 spdx L identifier wtfpl
cc0-1.0 1 spdx L identifier cc0 1 0
cc-by-4.0 1 spdx L identifier cc by 4 0
cc-by-sa-4.0 1 spdx L identifier cc by sa 4 0
cc-by-nc-4.0 1 spdx L identifier cc by nc 4 0
cc-by-nd-4.0 1 spdx L identifier cc by nd 4 0
cc-by-nc-sa-4.0 1 spdx L identifier cc by nc sa 4 0
cc-by-nc-nd-4.0 1 spdx L identifier cc by nc nd 4 0
ofl-1.1 1 spdx L identifier ofl 1 1
artistic-2.0 1 spdx L identifier artistic 2 0
ncsa 1 spdx L identifier ncsa
postgresql 1 spdx L identifier postgresql
python-2.0 1 spdx L identifier (?:psf|python) 2 0
proprietary 1 spdx L identifier (?:licenseref )?proprietary
""",
    " mit ": r"""
mit 1 (?:released|licensed|distributed|available|provided|published|shared) under (?:the )?(?:terms of )?(?:the )?mit L
mit 1 under the (?:terms of the )?mit L
mit 1 subject to the mit L
mit 2 mit (?:open source )?(?:software )?L
mit 2 the mit L mit
mit 2 mit x11 L
mit 2 mit expat L
mit 2 L mit
mit 2 L under mit
mit-0 2 mit no attribution
mit-0 2 mit L 0
mit-cmu 2 mit cmu (?:style )?L
mit-style 3 mit style L
""",
    "apache": r"""
apache-2.0 1 (?:licensed|released|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?apache (?:software )?L V2(?: 0)?
apache-2.0 1 apache L V2 0 the L
apache-2.0 1 apache org licenses L 2 0
apache-2.0 2 apache (?:software )?(?:public )?L V2(?: 0)?
apache-2.0 2 apache 2(?: 0)?(?: L)?
apache-2.0 2 apache V2 0
apache-2.0 2 asl 2(?: 0)? apache
apache-1.1 2 apache (?:software )?L V1 1
apache-1.0 2 apache (?:software )?L V1 0
apache-2.0-llvm 1 apache L V2 0 with llvm exceptions?
apache 3 apache (?:software )?L
apache 3 apache style L
""",
    "general public": r"""
gpl-1.0 1 gnu general public L V1(?: 0)?
gpl-2.0-only 1 gnu general public L (?:as published by the free software foundation )?V2(?: 0)?
gpl-2.0-or-later 1 gnu general public L (?:as published by the free software foundation )?(?:either )?V2(?: 0)?(?: of the L)? or (?:\(?at your option\)? )?(?:any )?later
gpl-3.0-only 1 gnu general public L (?:as published by the free software foundation )?V3(?: 0)?
gpl-3.0-or-later 1 gnu general public L (?:as published by the free software foundation )?(?:either )?V3(?: 0)?(?: of the L)? or (?:at your option )?(?:any )?later
gpl 2 (?:under|terms of) (?:the )?(?:terms of )?(?:the )?gnu general public L(?! (?:as published by the free software foundation )?(?:either )?V[123])
gpl 3 gnu general public L
gpl 3 general public L
lgpl-2.0 1 gnu (?:library|lesser) general public L V2(?: 0)?
lgpl-2.1 1 gnu lesser general public L V2 1
lgpl-3.0 1 gnu lesser general public L V3(?: 0)?
lgpl 2 (?:gnu )?(?:library|lesser) general public L
agpl-3.0 1 (?:gnu )?affero general public L V3(?: 0)?
agpl-1.0 1 affero general public L V1(?: 0)?
agpl 2 (?:gnu )?affero general public L
""",
    "gpl": r"""
gpl-2.0-only 2 (?:gnu )?gpl ?v?2(?: 0)?(?: only)?
gpl-2.0-or-later 2 (?:gnu )?gpl ?v?2(?: 0)? or (?:any )?later
gpl-2.0-or-later 2 gplv2 plus
gpl-3.0-only 2 (?:gnu )?gpl ?v?3(?: 0)?(?: only)?
gpl-3.0-or-later 2 (?:gnu )?gpl ?v?3(?: 0)? or (?:any )?later
gpl-2.0-only 2 gpl version 2(?: 0)?
gpl-3.0-only 2 gpl version 3(?: 0)?
gpl-2.0-classpath 1 gpl ?v?2(?: 0)? with (?:the )?classpath exception
gpl 2 (?:licensed|released|distributed|available) under (?:the )?(?:gnu )?gpl
gpl 3 gnu gpl
gpl 3 gpl L
lgpl-2.1 2 (?:gnu )?lgpl ?v?2 1(?: only| or later)?
lgpl-2.0 2 (?:gnu )?lgpl ?v?2 0(?: only| or later)?
lgpl-3.0 2 (?:gnu )?lgpl ?v?3(?: 0)?(?: only| or later)?
lgpl 2 (?:licensed|released|distributed|available) under (?:the )?(?:gnu )?lgpl
lgpl 3 gnu lgpl
lgpl 3 lgpl L
agpl-3.0 2 (?:gnu )?agpl ?v?3(?: 0)?(?: only| or later)?
agpl 2 (?:licensed|released|distributed|available) under (?:the )?(?:gnu )?agpl
agpl 3 gnu agpl
""",
    "redistribution and use": r"""
bsd 2 redistribution and use in source and binary forms with or without modification are permitted
bsd-2-clause 1 redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice
bsd-style 3 redistribution and use (?:of this \S+ )?(?:is|are) permitted
""",
    "bsd": r"""
bsd-2-clause 1 (?:simplified|freebsd|2 clause|two clause) bsd L
bsd-2-clause 2 bsd 2 clause
bsd-3-clause 1 (?:modified|new|revised|3 clause|three clause) bsd L
bsd-3-clause 2 bsd 3 clause
bsd-4-clause 1 (?:original|old|4 clause|four clause) bsd L
bsd-4-clause 2 bsd 4 clause
bsd-0-clause 1 (?:zero clause|0 clause) bsd
bsd-3-clause-clear 2 clear bsd L
bsd-patent 2 bsd (?:2 clause )?plus patent
bsd 2 (?:licensed|released|distributed|available) under (?:the |a )?(?:terms of the )?bsd(?: L)?
bsd 3 bsd L
bsd 3 bsd style L
""",
    "mozilla": r"""
mpl-1.0 1 mozilla public L V1(?: 0)?
mpl-1.1 1 mozilla public L V1 1
mpl-2.0 1 mozilla public L V2(?: 0)?
mpl-2.0 1 mozilla org mpl 2 0
mpl 2 (?:under|terms of) the mozilla public L
mpl 3 mozilla public L
""",
    "mpl": r"""
mpl-1.1 2 mpl V1 1
mpl-2.0 2 mpl V2(?: 0)?
mpl 3 mpl L
""",
    "eclipse": r"""
epl-1.0 1 eclipse public L V1(?: 0)?
epl-2.0 1 eclipse public L V2(?: 0)?
edl-1.0 1 eclipse distribution L V1(?: 0)?
epl 3 eclipse public L
""",
    "common development": r"""
cddl-1.0 1 common development and distribution L V1(?: 0)?
cddl-1.1 1 common development and distribution L V1 1
cddl 2 common development and distribution L
""",
    "european union public": r"""
eupl-1.1 1 european union public L V1 1
eupl-1.2 1 european union public L V1 2
eupl 2 european union public L
""",
    "common public": r"""
cpl-1.0 1 common public L V1(?: 0)?
cpal-1.0 1 common public attribution L(?: V1(?: 0)?)?
cpl 3 common public L
""",
    "creative commons": r"""
cc-by 1 creative commons attribution(?: L| international| unported)
cc-by-4.0 1 creative commons attribution (?:L )?V4 0(?: international)?
cc-by-3.0 1 creative commons attribution (?:L )?V3 0(?: unported)?
cc-by-2.5 1 creative commons attribution (?:L )?V2 5
cc-by-2.0 1 creative commons attribution (?:L )?V2 0
cc-by-sa 1 creative commons attribution share ?alike
cc-by-sa-4.0 1 creative commons attribution share ?alike (?:L )?V4 0
cc-by-sa-3.0 1 creative commons attribution share ?alike (?:L )?V3 0
cc-by-nd 1 creative commons attribution no ?deriv(?:ative)?s
cc-by-nc 1 creative commons attribution non ?commercial
cc-by-nc-sa 1 creative commons attribution non ?commercial share ?alike
cc-by-nc-nd 1 creative commons attribution non ?commercial no ?deriv(?:ative)?s
cc0 1 creative commons (?:zero|cc0|public domain dedication)
cc 3 creative commons L
cc 3 under (?:a )?creative commons
""",
    "creativecommons": r"""
cc-by 1 creativecommons org licenses by(?: [1-4] [05])?
cc-by-sa 1 creativecommons org licenses by sa(?: [1-4] [05])?
cc-by-nd 1 creativecommons org licenses by nd(?: [1-4] [05])?
cc-by-nc 1 creativecommons org licenses by nc(?: [1-4] [05])?
cc-by-nc-sa 1 creativecommons org licenses by nc sa(?: [1-4] [05])?
cc-by-nc-nd 1 creativecommons org licenses by nc nd(?: [1-4] [05])?
cc0-1.0 1 creativecommons org publicdomain zero(?: 1 0)?
public-domain 1 creativecommons org publicdomain mark
""",
    "cc by": r"""
cc-by 2 cc by
cc-by-4.0 2 cc by 4(?: 0)?
cc-by-3.0 2 cc by 3(?: 0)?
cc-by-2.5 2 cc by 2 5
cc-by-2.0 2 cc by 2 0
cc-by-sa 2 cc by sa
cc-by-sa-4.0 2 cc by sa 4(?: 0)?
cc-by-sa-3.0 2 cc by sa 3(?: 0)?
cc-by-nd 2 cc by nd
cc-by-nd-4.0 2 cc by nd 4(?: 0)?
cc-by-nc 2 cc by nc
cc-by-nc-4.0 2 cc by nc 4(?: 0)?
cc-by-nc-3.0 2 cc by nc 3(?: 0)?
cc-by-nc-sa 2 cc by nc sa
cc-by-nc-sa-4.0 2 cc by nc sa 4(?: 0)?
cc-by-nc-nd 2 cc by nc nd
cc-by-nc-nd-4.0 2 cc by nc nd 4(?: 0)?
""",
    "cc0": r"""
cc0-1.0 2 cc0 1 0(?: universal)?
cc0 2 cc0(?: public domain)?
cc0 2 cc0 L
""",
    "public domain": r"""
public-domain 2 (?:released|placed|dedicated|donated) (?:in|into|to) the public domain
public-domain 2 (?:is|are) (?:hereby )?(?:in|within) the public domain
public-domain 2 public domain (?:dedication|mark|work|software)
public-domain 2 no copyright public domain
unlicense 1 free and unencumbered software released into the public domain
odc-pddl 1 public domain dedication and L
""",
    "unlicense": r"""
unlicense 2 (?:the )?unlicense
unlicense 1 unlicense org
""",
    "permission is hereby granted": r"""
mit 1 permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
x11 1 permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the x consortium
ncsa 2 permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal with the software
bsl-1.0 1 permission is hereby granted free of charge to any person or organization obtaining a copy of the software
ofl-1.1 2 permission is hereby granted free of charge to any person obtaining a copy of the font software
postgresql 2 permission is hereby granted without written agreement and without L
hpnd 3 permission is hereby granted
""",
    "permission to use copy modify": r"""
isc 1 permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc 2 permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted
hpnd 2 permission to use copy modify and distribute this software and its documentation for any purpose
postgresql 1 permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
""",
    "as is": r"""
zlib 1 this software is provided as is without any express or implied warranty in no event will the authors be held liable
warranty-disclaimer 3 (?:software|work|data|material) is provided (?:by \S+ (?:\S+ )?)?as is
warranty-disclaimer 3 provided as is without (?:any )?warranty
""",
    "isc l": r"""
isc 2 isc L
isc 1 under (?:the )?(?:terms of )?(?:the )?isc L
""",
    "zlib": r"""
zlib 2 zlib L
zlib 2 zlib libpng L
""",
    "boost": r"""
bsl-1.0 1 boost software L(?: V1(?: 0)?)?
bsl-1.0 3 boost L
""",
    "artistic l": r"""
artistic-1.0 1 artistic L V1(?: 0)?
artistic-2.0 1 artistic L V2(?: 0)?
artistic-perl 2 perl artistic L
artistic 2 (?:the )?artistic L
""",
    "python software foundation": r"""
python-2.0 1 python software foundation L(?: V2)?
""",
    "psf l": r"""
python-2.0 2 psf L
python-2.0 2 psf L agreement
""",
    "do what the": r"""
wtfpl 1 do what the \S+ you want to public L
""",
    "wtfpl": r"""
wtfpl 2 wtfpl(?: V2)?
""",
    "open font": r"""
ofl-1.0 1 (?:sil )?open font L V1(?: 0)?
ofl-1.1 1 (?:sil )?open font L V1 1
ofl 2 (?:sil )?open font L
""",
    "open database": r"""
odbl-1.0 1 open database L V1(?: 0)?
odbl 2 open database L
""",
    "open data commons": r"""
odbl 1 open data commons open database L
odc-by 1 open data commons attribution L
odc-pddl 1 open data commons public domain dedication
""",
    "open government": r"""
ogl-1.0 1 open government L V1(?: 0)?
ogl-2.0 1 open government L V2(?: 0)?
ogl-3.0 1 open government L V3(?: 0)?
ogl 2 open government L
""",
    "free documentation": r"""
gfdl-1.1 1 (?:gnu )?free documentation L V1 1
gfdl-1.2 1 (?:gnu )?free documentation L V1 2
gfdl-1.3 1 (?:gnu )?free documentation L V1 3
gfdl 2 (?:gnu )?free documentation L
""",
    "academic free": r"""
afl-2.1 1 academic free L V2 1
afl-3.0 1 academic free L V3(?: 0)?
afl 2 academic free L
""",
    "open software l": r"""
osl-2.1 1 open software L V2 1
osl-3.0 1 open software L V3(?: 0)?
osl 2 open software L
""",
    "university of illinois": r"""
ncsa 1 university of illinois ncsa open source L
ncsa 1 university of illinois open source L
""",
    "microsoft": r"""
ms-pl 1 microsoft public L
ms-rl 1 microsoft reciprocal L
ms-limited 2 microsoft limited (?:public|reciprocal) L
""",
    "apple public": r"""
apsl-1.0 1 apple public source L V1(?: 0)?
apsl-2.0 1 apple public source L V2(?: 0)?
apsl 2 apple public source L
""",
    "server side public": r"""
sspl-1.0 1 server side public L(?: V1)?
""",
    "business source": r"""
busl-1.1 1 business source L(?: V1 1)?
""",
    "elastic l": r"""
elastic-2.0 1 elastic L V2(?: 0)?
elastic 2 elastic L
""",
    "openrail": r"""
openrail-m 1 (?:creativeml |bigscience )?(?:bloom )?openrail m?
openrail-m 2 openrail L
""",
    "beerware": r"""
beerware 1 (?:the )?beerware L
""",
    "wxwindows": r"""
wxwindows 1 wxwindows library L
""",
    "openssl l": r"""
openssl 1 openssl L
""",
    "w3c": r"""
w3c 1 w3c software (?:notice and )?L
w3c-document 1 w3c document L
""",
    "unicode l": r"""
unicode 1 unicode L(?: V3)?
unicode-dfs 1 unicode L agreement data files and software
""",
    "json l": r"""
json 2 json L
""",
    "good not evil": r"""
json 1 the software shall be used for good not evil
""",
    "rights reserved": r"""
all-rights-reserved 2 all rights reserved
some-rights-reserved 2 some rights reserved
no-rights-reserved 2 no rights reserved
""",
    "proprietary": r"""
proprietary 2 proprietary and confidential
proprietary 2 proprietary (?:software|L|material|information)
""",
    "without permission": r"""
no-reuse 2 (?:may|must) not be (?:copied|reproduced|republished|redistributed)(?: \S+){0,6} without permission
no-reuse 2 no part of this (?:publication|work|book|document) may be reproduced(?: \S+){0,12} without permission
""",
    "non commercial": r"""
non-commercial 2 (?:for )?non commercial (?:use|purposes)(?: only)?
""",
    "noncommercial": r"""
non-commercial 2 (?:for )?noncommercial (?:use|purposes)(?: only)?
polyform-noncommercial 1 polyform noncommercial L
""",
    "royalty free": r"""
royalty-free 3 royalty free L
royalty-free 3 worldwide royalty free
""",
    "end user l": r"""
eula 2 end user L agreement
""",
    "copyleft": r"""
copyleft 3 copyleft L
""",
    "is strictly prohibited": r"""
proprietary 1 unauthorized (?:copying|use|distribution) of this (?:file|software|document)\S* (?:via any medium )?is strictly prohibited
""",
    "terms as perl itself": r"""
perl 1 same terms as perl itself
""",
    "ssleay": r"""
ssleay 1 original ssleay L
""",
    "libpng": r"""
libpng 2 libpng L
""",
    "not for commercial": r"""
non-commercial 2 not for commercial use
""",
}


def rules() -> list[tuple[str, str, int, str]]:
    """(gate, label, priority, expression), in order.  An expression takes the space
    before its words and looks at the one behind them."""
    out = []
    for gate, lines in _RULES.items():
        for line in lines.strip().splitlines():
            label, priority, words = line.split(" ", 2)
            words = words.replace("V", "(?:version |v)?").replace("L", "licen[cs]e")
            out.append((gate[:-1] + "licen" if gate.endswith(" l") else gate, label, int(priority), f" (?:{words})(?= )"))
    return out


def _words(text: Column) -> Column:
    """The words of ``text`` after a space each, and a last space."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    # Only these two characters become a-z when every letter is lower-cased.
    lower = F.when(text.contains("\u0130") | text.contains("\u212a"), F.translate(text, upper, upper.lower())).otherwise(F.lower(text))
    body = F.trim(F.regexp_replace(lower, PARTS, " "))
    return F.when(body == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), body, F.lit(" ")))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def _scan(items: Column, zero: Column, step: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column], kind: str, piece: int = 256) -> Column:
    """For every item ``emit(state before it, item)``, an array of ``kind``.  Results are
    appended within pieces, and the pieces to each other, so that copying stays small."""
    none = F.array().cast(f"array<{kind}>")

    def over(part: Column, state: Column) -> Column:
        return F.aggregate(part, F.struct(state.alias("s"), none.alias("o")), lambda a, x: F.struct(step(a["s"], x).alias("s"), F.concat(a["o"], F.array(emit(a["s"], x))).alias("o")))

    def add(a: Column, k: Column) -> Column:
        return _let(over(F.slice(items, k * piece + 1, F.lit(piece)), a["s"]), lambda got: F.struct(got["s"].alias("s"), F.concat(a["o"], F.array(got["o"])).alias("o")))

    pieces = F.sequence(F.lit(0), F.ceil(F.size(items) / piece).cast("int") - 1)
    start = F.struct(zero.alias("s"), F.array().cast(f"array<array<{kind}>>").alias("o"))
    return F.when(F.size(items) > 0, F.aggregate(pieces, start, add, lambda a: F.flatten(a["o"]))).otherwise(none)


_HIT = "struct<start:int,back:int,priority:int,place:int,label:string>"


def _detections(words: Column, rule: Column) -> Column:
    """Every match of one rule; ``back`` is the end below zero, so that longer ones of
    one start sort first."""
    found, between = F.regexp_extract_all(words, rule["rx"], F.lit(0)), F.split(words, rule["rx"], -1)
    sizes = _let(between, lambda b: F.transform(found, lambda m, k: F.struct(_spaces(F.get(b, k)).alias("gap"), _spaces(m).alias("size"))))
    hit = lambda s, x: F.struct((s + x["gap"]).alias("start"), (-(s + x["gap"] + x["size"])).alias("back"), rule["priority"].alias("priority"), rule["place"].alias("place"), rule["label"].alias("label"))
    return _let(sizes, lambda z: _scan(z, F.lit(0), lambda s, x: s + x["gap"] + x["size"], hit, _HIT))


def _kept(hits: Column) -> Column:
    """The sorted detections that no earlier one of the same or a stronger priority
    contains; the state is the furthest end so far by priority."""
    levels = sorted(CONFIDENCE)
    zero = F.struct(*[F.lit(-1).alias(f"e{p}") for p in levels])
    step = lambda s, x: F.struct(*[F.when(x["priority"] == p, F.greatest(s[f"e{p}"], -x["back"])).otherwise(s[f"e{p}"]).alias(f"e{p}") for p in levels])
    covered = lambda s, x: F.greatest(*[F.when(x["priority"] >= p, s[f"e{p}"]).otherwise(F.lit(-1)) for p in levels])
    out = _scan(hits, zero, step, lambda s, x: F.when(covered(s, x) < -x["back"], x), _HIT)
    return F.filter(out, lambda x: x.isNotNull())


def scan(docs: DataFrame, text_col: str = "text", phrases: list[tuple[str, str]] = PHRASES) -> DataFrame:
    """``docs`` without the text, and ``n_words``, ``detections`` (array of start, end,
    label, priority; ends left out), ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels`` and ``score``."""
    added = ["n_words", "detections", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    rest = [c for c in docs.columns if c != text_col and c not in added]
    by_gate: dict[str, list[dict]] = {}
    for place, (gate, label, priority, rx) in enumerate(rules()):
        by_gate.setdefault(gate, []).append({"place": place, "label": label, "priority": priority, "rx": rx})
    known = F.from_json(F.lit(json.dumps([{"gate": g, "rules": r} for g, r in by_gate.items()])), "array<struct<gate:string,rules:array<struct<place:int,label:string,priority:int,rx:string>>>>")
    own = F.struct(*[F.col(f"`{c}`") for c in rest]).alias("__row")
    rows = docs.select(own, _words(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("w"))
    w = F.col("w")
    places = []
    for phrase, label in phrases:
        gaps = F.when(w.contains(f" {phrase} "), F.split(w, rf" (?=\Q{phrase}\E )", -1))
        places.append(F.struct(F.lit(label).alias("label"), gaps.alias("gaps")))
    gates = F.filter(known, lambda g: F.contains(w, g["gate"]))
    rows = rows.select("__row", "w", F.filter(F.array(*places), lambda p: p["gaps"].isNotNull()).alias("places"), F.flatten(F.transform(gates, lambda g: g["rules"])).alias("rules"))
    total = _spaces(w)
    hits = F.when(F.size("rules") > 0, F.flatten(F.transform("rules", lambda r: _detections(w, r))))
    rows = rows.select(
        "__row", (total - 1).cast("long").alias("n_words"),
        F.aggregate("places", F.lit(0), lambda a, p: a + F.size(p["gaps"]) - 1).cast("long").alias("n_base"),
        F.array_min(F.transform("places", lambda p: _spaces(p["gaps"][0]))).cast("long").alias("first_word"),
        F.array_max(F.transform("places", lambda p: total - _spaces(F.element_at(p["gaps"], -1)) - 1)).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"]))).alias("base"),
        F.when(F.size(hits) > 0, F.array_sort(hits)).alias("hits"),
    )
    rows = rows.withColumn("kept", F.when(F.col("hits").isNull(), F.array().cast(f"array<{_HIT}>")).otherwise(_kept(F.col("hits"))))
    best = F.array_min(F.transform("kept", lambda x: x["priority"]))
    score = F.when(F.col("n_base") > 0, F.lit(1.0))
    for priority, confidence in CONFIDENCE.items():
        score = score.when(best == priority, F.lit(confidence))
    return rows.select(
        *[F.col(f"__row.`{c}`").alias(c) for c in rest], "n_words",
        F.transform("kept", lambda x: F.struct(x["start"].alias("start"), (-x["back"]).alias("end"), x["label"].alias("label"), x["priority"].alias("priority"))).alias("detections"),
        "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", F.transform("kept", lambda x: x["label"])))), ",").alias("labels"),
        score.otherwise(F.lit(0.0)).alias("score"),
    )

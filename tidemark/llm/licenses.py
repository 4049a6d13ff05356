"""License scans by ordered signature rules.

A text is its words in order: A-Z lowered, then everything but digits, letters and what isn't ASCII parts words. Rules are regexes over these words, parted
by single blanks; each stands under keywords without which it is not tried. Where matches overlap, the higher priority wins: a match goes if it lies
within one of the same or a higher priority, or if one of a higher priority lies within it; of equals, the longer, then the earlier rule stays.

Besides the rules, base phrases are found at all their places, overlapping ones too; no rule suppresses them.

Scale: one pass over the table without a shuffle, in bounded Arrow batches; the work for a text grows with its length (and n log n of its matches).

Defined results: a null text is empty; empty texts have no words and score 0. Every row has one result, repeated and null ids too. An empty table gives an
empty table. Columns other than the id and the text are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.work import bounded_batches, words_source

#: Phrases whose places are all counted, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: priority; keywords (all of those with commas between, one of those with bars); label; regex. <n> stands for up to n words, L for license or licence.
SIGNATURES = r"""
95;spdx;apache-2.0;spdx L identifier apache 2 0
95;spdx;apache-1.1;spdx L identifier apache 1 1
95;spdx;mit;spdx L identifier mit
95;spdx;mit-0;spdx L identifier mit 0
95;spdx;bsd-2-clause;spdx L identifier bsd 2 clause
95;spdx;bsd-3-clause;spdx L identifier bsd 3 clause
95;spdx;bsd-4-clause;spdx L identifier bsd 4 clause
95;spdx;0bsd;spdx L identifier 0bsd
95;spdx;gpl-2.0;spdx L identifier gpl 2 0(?: only| or later)?
95;spdx;gpl-3.0;spdx L identifier gpl 3 0(?: only| or later)?
95;spdx;lgpl-2.1;spdx L identifier lgpl 2 1(?: only| or later)?
95;spdx;lgpl-3.0;spdx L identifier lgpl 3 0(?: only| or later)?
95;spdx;agpl-3.0;spdx L identifier agpl 3 0(?: only| or later)?
95;spdx;mpl-2.0;spdx L identifier mpl 2 0
95;spdx;epl-2.0;spdx L identifier epl 2 0
95;spdx;isc;spdx L identifier isc
95;spdx;zlib;spdx L identifier zlib
95;spdx;unlicense;spdx L identifier unlicense
95;spdx;bsl-1.0;spdx L identifier bsl 1 0
95;spdx;cc0-1.0;spdx L identifier cc0 1 0
95;spdx;cc-by-4.0;spdx L identifier cc by 4 0
95;spdx;cc-by-sa-4.0;spdx L identifier cc by sa 4 0
95;spdx;wtfpl;spdx L identifier wtfpl
95;spdx;eupl-1.2;spdx L identifier eupl 1 2
40;spdx;spdx-other;spdx L identifier \S+
90;apache;apache-2.0;apache L (?:version |v )?2(?: 0)?
90;apache;apache-2.0;apache (?:software )?L v2(?: 0)?
90;apache;apache-2.0;www apache org licenses L 2 0
90;apache;apache-2.0;apache 2 0 L
90;asl2|asl;apache-2.0;asl (?:version )?2(?: 0)?
90;apache;apache-1.1;apache (?:software )?L (?:version |v )?1 1
90;apache;apache-1.0;apache (?:software )?L (?:version |v )?1 0
70;apache;apache;(?:the )?apache (?:software )?L
60;contributor,patent;apache-2.0;each contributor hereby grants to you a perpetual worldwide non exclusive <4>patent L
60;agreed,basis;apache-2.0;unless required by applicable law or agreed to in writing software
60;apache,foundation;apache;software developed by the apache software foundation
90;mit;mit;(?:the )?mit L
90;mit;mit;L mit
85;mit;mit;licensed under (?:the )?(?:terms of (?:the )?)?mit
85;mit;mit;released under (?:the )?mit
85;mit;mit;opensource org licenses mit
90;mit;mit-0;mit no attribution
75;permission,granted;mit;permission is hereby granted free of charge to any person obtaining a copy
75;merchantability,noninfringement;mit;as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
60;sublicense,copies;mit;use copy modify merge publish distribute sublicense and or sell copies
90;x11;x11;x11 L
90;expat;mit;expat L
90;bsd;bsd-2-clause;bsd 2 clause(?: L)?
90;bsd;bsd-2-clause;(?:2|two) clause bsd(?: L)?
90;bsd;bsd-2-clause;simplified bsd L
90;freebsd;bsd-2-clause;freebsd L
90;bsd;bsd-3-clause;bsd 3 clause(?: L)?
90;bsd;bsd-3-clause;(?:3|three) clause bsd(?: L)?
90;bsd;bsd-3-clause;(?:new|modified|revised) bsd L
90;bsd;bsd-4-clause;(?:4|four) clause bsd(?: L)?
90;bsd;bsd-4-clause;original bsd L
90;0bsd|bsd;0bsd;(?:0bsd|zero clause bsd)(?: L)?
70;bsd;bsd;(?:the )?bsd (?:style |like )?L
70;bsd;bsd;licensed under (?:the )?bsd
70;bsd;bsd;opensource org licenses bsd(?: L)?
75;redistribution,binary;bsd;redistribution and use in source and binary forms with or without modification
80;endorse,promote;bsd-3-clause;neither the names? of <8>may be used to endorse or promote products
80;advertising,acknowledgement;bsd-4-clause;all advertising materials mentioning features or use of this software must display
60;redistributions;bsd;redistributions of source code must retain the above copyright notice
90;gpl;gpl-1.0;gpl (?:version |v )?1(?: 0)?
90;gpl;gpl-2.0;gpl (?:version |v )?2(?: 0)?(?: only| or later)?
90;gpl|gplv2;gpl-2.0;gplv2(?: only| or later)?
90;gpl|gplv3;gpl-3.0;gplv3(?: only| or later)?
90;gpl;gpl-3.0;gpl (?:version |v )?3(?: 0)?(?: only| or later)?
90;general,public;gpl-1.0;(?:gnu )?general public L (?:as published by the free software foundation <3>)?(?:version |v )1(?: 0)?
90;general,public;gpl-2.0;(?:gnu )?general public L (?:as published by the free software foundation <3>)?(?:version |v )2(?: 0)?
90;general,public;gpl-3.0;(?:gnu )?general public L (?:as published by the free software foundation <3>)?(?:version |v )3(?: 0)?
70;general,public;gpl;(?:the )?gnu general public L
65;general,public;gpl;general public L
70;gnu,gpl;gpl;gnu gpl
65;gpl;gpl;(?:licensed|released|distributed) under (?:the )?(?:terms of (?:the )?)?gpl
85;gnu;gpl-2.0;gnu org licenses (?:old licenses )?gpl 2 0
85;gnu;gpl-3.0;gnu org licenses gpl 3 0
70;gnu;gpl;gnu org licenses gpl
60;redistribute,gnu;gpl;you can redistribute it and or modify it under the terms of the gnu general public L
55;hope,useful;gpl;distributed in the hope that it will be useful but without any warranty
50;usa,temple;gpl;59 temple place suite 330 boston
50;franklin,boston;gpl;51 franklin (?:st|street) fifth floor boston
80;classpath,exception;gpl-classpath;classpath exception
80;linking,exception;gpl-linking;(?:gcc runtime library|linking) exception
92;lesser,public;lgpl-2.1;(?:gnu )?lesser general public L <6>(?:version |v )2 1
92;lesser,public;lgpl-3.0;(?:gnu )?lesser general public L <6>(?:version |v )3(?: 0)?
92;library,public;lgpl-2.0;(?:gnu )?library general public L <6>(?:version |v )2(?: 0)?
72;lesser,public;lgpl;(?:gnu )?lesser general public L
72;library,public;lgpl;(?:gnu )?library general public L
92;lgpl;lgpl-2.1;lgpl (?:version |v )?2 1
92;lgpl;lgpl-3.0;lgpl (?:version |v )?3(?: 0)?
92;lgplv3;lgpl-3.0;lgplv3
92;lgplv2;lgpl-2.1;lgplv2(?: 1)?
72;lgpl;lgpl;(?:gnu )?lgpl
72;gnu;lgpl;gnu org licenses lgpl
92;affero,public;agpl-3.0;(?:gnu )?affero general public L <6>(?:version |v )3(?: 0)?
92;affero,public;agpl-1.0;affero general public L <3>(?:version |v )1
72;affero,public;agpl;(?:gnu )?affero general public L
92;agpl;agpl-3.0;agpl (?:version |v )?3(?: 0)?
92;agplv3;agpl-3.0;agplv3
72;agpl;agpl;agpl
92;documentation,gnu;gfdl-1.2;gnu free documentation L version 1 2
92;documentation,gnu;gfdl-1.3;gnu free documentation L version 1 3
72;documentation;gfdl;(?:gnu )?free documentation L
72;gfdl;gfdl;gfdl
60;invariant,sections;gfdl;with no invariant sections
90;mozilla;mpl-1.0;mozilla public L (?:version |v )?1 0
90;mozilla;mpl-1.1;mozilla public L (?:version |v )?1 1
90;mozilla;mpl-2.0;mozilla public L (?:version |v )?2(?: 0)?
90;mpl;mpl-1.1;mpl (?:version |v )?1 1
90;mpl;mpl-2.0;mpl (?:version |v )?2(?: 0)?
90;mozilla;mpl-2.0;mozilla org mpl 2 0
70;mozilla;mpl;mozilla public L
60;mozilla;mpl;mozilla org mpl
60;incompatible,secondary;mpl-2.0;incompatible with secondary licenses
90;eclipse;epl-1.0;eclipse public L (?:version |v )?1(?: 0)?
90;eclipse;epl-2.0;eclipse public L (?:version |v )?2(?: 0)?
70;eclipse;epl;eclipse public L
90;epl;epl-1.0;epl (?:version |v )?1 0
90;epl;epl-2.0;epl (?:version |v )?2 0
90;eclipse,distribution;edl-1.0;eclipse distribution L(?: version| v)?(?: 1 0)?
70;eclipse;epl;eclipse org legal epl
90;cddl;cddl-1.0;cddl (?:version |v )?1 0
90;cddl;cddl-1.1;cddl (?:version |v )?1 1
70;cddl;cddl;cddl
70;development,distribution;cddl;common development and distribution L
90;common,public;cpl-1.0;common public L (?:version |v )?1(?: 0)?
70;common,public;cpl;common public L
70;attribution,cpal;cpal-1.0;common public attribution L
90;ibm;ipl-1.0;ibm public L
90;nokia;nokia;nokia open source L
90;sun,public;spl-1.0;sun public L
90;sun,sissl;sissl;sun industry standards source L
90;isc;isc;isc L
70;isc;isc;(?:licensed|released) under (?:the )?isc
75;permission,fee;isc;permission to use copy modify and or distribute this software for any purpose with or without fee
60;disclaims,fee;isc;the author disclaims all warranties with regard to this software
90;zlib;zlib;zlib (?:libpng )?L
90;libpng;libpng;libpng L
75;misrepresented,origin;zlib;the origin of this software must not be misrepresented
60;altered,misrepresented;zlib;altered source versions must be plainly marked
90;boost;bsl-1.0;boost software L(?: version| v)?(?: 1(?: 0)?)?
70;boost;bsl-1.0;boost org license 1 0
75;executable,processor;bsl-1.0;machine executable object code generated by a source language processor
90;unlicense;unlicense;(?:the )?unlicense
75;unencumbered;unlicense;free and unencumbered software released into the public domain
90;wtfpl;wtfpl;wtfpl(?: version 2)?
75;wtf|fuck;wtfpl;do what the (?:fuck|f) you want to public L
90;beerware;beerware;beerware L
75;beer;beerware;you can buy me a beer in return
90;artistic;artistic-1.0;artistic L (?:version |v )?1(?: 0)?
90;artistic;artistic-2.0;artistic L (?:version |v )?2(?: 0)?
70;artistic;artistic;(?:the )?(?:perl )?artistic L
65;perl;perl;same terms as perl(?: itself)?
90;python,psf;psf-2.0;psf L (?:agreement )?(?:version 2)?
80;python;psf-2.0;python software foundation L
80;cnri;cnri-python;cnri open source L agreement
80;ruby;ruby;ruby L
80;php;php-3.01;php L (?:version |v )?3 01
70;php;php;php L
80;zope;zpl-2.1;zope public L (?:version |v )?2 1
70;zope;zpl;zope public L
80;w3c;w3c;w3c (?:software (?:notice and )?)?L
80;openssl;openssl;openssl L
60;openssl,toolkit;openssl;developed by the openssl project
80;ssleay;ssleay;(?:original )?ssleay L
80;ncsa;ncsa;(?:university of illinois )?ncsa (?:open source )?L
80;postgresql;postgresql;postgresql L
80;curl;curl;curl L
80;icu;icu;icu L
80;unicode;unicode-dfs;unicode L agreement
80;tcl;tcl;tcl tk L
80;vim;vim;vim L
80;netscape;npl-1.1;netscape public L(?: version 1 1)?
80;microsoft;ms-pl;microsoft public L
80;microsoft;ms-rl;microsoft reciprocal L
80;ms,pl;ms-pl;ms pl
80;academic,free;afl-3.0;academic free L(?: version| v)?(?: 3 0)?
80;open,software;osl-3.0;open software L(?: version| v)? 3 0
80;educational,community;ecl-2.0;educational community L(?: version| v)?(?: 2 0)?
80;eupl;eupl-1.1;eupl (?:version |v )?1 1
80;eupl;eupl-1.2;eupl (?:version |v )?1 2
70;european,union;eupl;european union public L
80;cecill;cecill-2.1;cecill (?:version |v )?2 1
80;cecill;cecill-b;cecill b
80;cecill;cecill-c;cecill c
70;cecill;cecill;cecill
80;qt|qpl;qpl-1.0;(?:q public L|qpl)(?: version)?(?: 1 0)?
80;sleepycat;sleepycat;sleepycat L
80;intel;intel;intel (?:open source|simplified software) L
80;nasa;nasa-1.3;nasa open source agreement(?: version)?(?: 1 3)?
80;hpnd|historical;hpnd;historical permission notice and disclaimer
80;jasper;jasper-2.0;jasper L
80;json;json;json L
60;good,evil;json;the software shall be used for good not evil
80;sil|ofl;ofl-1.1;(?:sil )?open font L(?: version)?(?: 1 1)?
80;ofl;ofl-1.1;ofl (?:version )?1 1
80;lppl;lppl-1.3c;lppl (?:version )?1 3(?: ?c)?
70;latex;lppl;latex project public L
80;server,side;sspl-1.0;server side public L(?: version 1)?
80;sspl;sspl-1.0;sspl(?: 1 0)?
80;business,source;busl-1.1;business source L(?: version)?(?: 1 1)?
80;elastic;elastic-2.0;elastic L(?: version)?(?: 2 0)?
80;commons,clause;commons-clause;commons clause (?:L )?(?:condition)?
80;polyform;polyform;polyform (?:noncommercial|shield|strict|small business|free trial) L
80;prosperity;prosperity;prosperity public L
80;confluent;confluent;confluent community L
80;mulan;mulan-2.0;mulan (?:psl|permissive software L)(?: v2)?
80;blue,oak;blueoak-1.0.0;blue oak model L
80;openrail;openrail;(?:bigscience |creativeml )?openrail(?: \+*m)?(?: L)?
80;rail;openrail;responsible ai L
80;llama;llama;llama (?:\d )?(?:\d )?community L
80;gemma;gemma;gemma terms of use
90;cc0;cc0-1.0;cc0(?: 1 0)?(?: universal)?
90;publicdomain;cc0-1.0;creativecommons org publicdomain zero 1 0
92;cc;cc-by-nc-nd;(?:L )?cc by nc nd(?: [1-4] [05])?
92;cc;cc-by-nc-sa;(?:L )?cc by nc sa(?: [1-4] [05])?
91;cc;cc-by-nc;cc by nc(?: [1-4] [05])?
91;cc;cc-by-nd;cc by nd(?: [1-4] [05])?
91;cc;cc-by-sa;cc by sa(?: [1-4] [05])?
88;cc;cc-by;cc by(?: [1-4] [05])?
92;creativecommons;cc-by-nc-nd;creativecommons org licenses by nc nd(?: [1-4] [05])?
92;creativecommons;cc-by-nc-sa;creativecommons org licenses by nc sa(?: [1-4] [05])?
91;creativecommons;cc-by-nc;creativecommons org licenses by nc(?: [1-4] [05])?
91;creativecommons;cc-by-nd;creativecommons org licenses by nd(?: [1-4] [05])?
91;creativecommons;cc-by-sa;creativecommons org licenses by sa(?: [1-4] [05])?
88;creativecommons;cc-by;creativecommons org licenses by(?: [1-4] [05])?
92;creative,commons;cc-by-nc-nd;creative commons attribution non ?commercial no ?deriv(?:s|atives|ative works)
92;creative,commons;cc-by-nc-sa;creative commons attribution non ?commercial share ?alike
91;creative,commons;cc-by-nc;creative commons attribution non ?commercial
91;creative,commons;cc-by-nd;creative commons attribution no ?deriv(?:s|atives|ative works)
91;creative,commons;cc-by-sa;creative commons attribution share ?alike
88;creative,commons;cc-by;creative commons attribution(?: [1-4] [05])?
60;creative,commons;cc;creative commons L
45;creative,commons;cc;creative commons
90;odc;odc-by-1.0;odc by(?: 1 0)?
90;open,data;odbl-1.0;open (?:data commons open )?database L(?: v)?(?: 1 0)?
90;odbl;odbl-1.0;odbl(?: 1 0)?
90;pddl;pddl-1.0;(?:odc )?pddl(?: 1 0)?
80;data,commons;odc-by-1.0;open data commons attribution L
80;cdla;cdla-permissive;cdla permissive(?: [12] 0)?
80;cdla;cdla-sharing;cdla sharing(?: 1 0)?
80;ogl|government;ogl-uk-3.0;open government L(?: v)?(?: ?3 0)?
80;etalab;etalab-2.0;(?:etalab )?(?:open L|licence ouverte)(?: etalab)?(?: 2 0)?
60;domain;public-domain;(?:released into|placed in|dedicated to|in) the public domain
55;domaine;public-domain;domaine public
55;dominio;public-domain;dominio p\xc3\xbablico
55;gemeinfrei;public-domain;gemeinfrei
60;crown;crown-copyright;crown copyright
60;proprietary;proprietary;proprietary and confidential
60;proprietary;proprietary;proprietary software L
60;unauthorized|unauthorised;proprietary;unauthori[sz]ed (?:copying|reproduction|use|distribution) of this <4>(?:is )?(?:strictly )?prohibited
60;commercial;non-commercial;(?:for )?non ?commercial use only
60;research;research-only;for research (?:purposes|use) only
60;personal;personal-use;for personal use only
60;evaluation;evaluation;for evaluation purposes only
60;freeware;freeware;freeware
60;shareware;shareware;shareware
55;eula|user;eula;end user L agreement
55;trade,secret;proprietary;trade secrets? of
50;reproduced,permission;reserved;(?:may|must) not be reproduced <6>without (?:the )?(?:prior )?(?:written )?permission
50;rights,reserved;reserved;all rights reserved
50;droits;reserved;tous droits r\xc3\xa9serv\xc3\xa9s
50;derechos;reserved;todos los derechos reservados
50;rechte;reserved;alle rechte vorbehalten
45;rights,reserved;some-rights;some rights reserved
40;copyright;copyright;copyright (?:c )?(?:\d{4} )(?:\d{4} )?(?:by )?\S+
40;spdx|licensed;other;licensed under the <3>L
40;released;other;released under the <3>L
40;terms;other;under the terms of the <4>L
40;see,license;other;see (?:the )?license(?: file)? for (?:more )?(?:details|information)
35;license;other;license agreement
"""


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    priority: int
    keywords: tuple[frozenset[bytes], ...]
    pattern: re.Pattern[bytes]


def parsed(table: str) -> list[Rule]:
    """Rules of a table in the form of SIGNATURES, in order; their names are the label and the line's number."""
    rules = []
    for n, line in enumerate(x for x in table.splitlines() if x.strip()):
        priority, keywords, label, regex = line.split(";", 3)
        regex = re.sub(r"<(\d+)>", r"(?:\\S+ ){0,\1}", re.sub(r"\bL\b", "licen[cs]e", regex))
        needed = tuple(frozenset(x.encode() for x in k.split("|")) for k in keywords.split(","))
        rules.append(Rule(f"{label}:{n}", label, int(priority), needed, re.compile(b"(?<= )(?:" + regex.encode("latin-1") + b")(?= )")))
    return rules


@cache
def standard_rules() -> tuple[Rule, ...]:
    return tuple(parsed(SIGNATURES))


#: Lowers A-Z and puts a blank for every byte that is no digit, no letter and ASCII.
WORDS = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORDS).split()


def places(line: bytes, phrases: dict[str, str]) -> list[tuple[int, int, str]]:
    """start, end (bytes) and label of all places of the phrases in words between single blanks; overlapping ones too."""
    out = []
    for phrase, label in phrases.items():
        wanted = b" " + phrase.encode() + b" "
        at = line.find(wanted)
        while at >= 0:
            out.append((at + 1, at + len(wanted) - 1, label))
            at = line.find(wanted, at + 1)
    return sorted(out)


def settled(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of (start, end, priority, rule): those that stay. Priority by priority: what lies within a kept one, or has a kept one of a higher priority within it, goes."""
    kept: list[tuple[int, int, int, int]] = []
    for priority in sorted({f[2] for f in found}, reverse=True):
        higher = sorted(kept)
        starts = [k[0] for k in higher]
        reach = list(accumulate((k[1] for k in higher), max))
        least = list(accumulate((k[1] for k in reversed(higher)), min))[::-1]
        last = -1
        for f in sorted((f for f in found if f[2] == priority), key=lambda f: (f[0], -f[1], f[3])):
            start, end = f[:2]
            before, after = bisect_right(starts, start), bisect_left(starts, start)
            if end <= last or (before and reach[before - 1] >= end) or (after < len(higher) and least[after] <= end):
                continue
            kept.append(f)
            last = end
    return sorted(kept)


class Scanner:
    """The rules by their keywords."""

    def __init__(self, rules: tuple[Rule, ...], phrases: dict[str, str]):
        self.rules, self.phrases = rules, phrases
        self.by_word: dict[bytes, list[int]] = {}
        for i, r in enumerate(rules):
            for w in r.keywords[0]:
                self.by_word.setdefault(w, []).append(i)
        self.known = frozenset(self.by_word)

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int, str]], list[tuple[int, int, int, int]]]:
        """Number of words; places of the phrases; (first word, word after the last, priority, rule) of the matches that stay."""
        words = words_of(text)
        line = b" " + b" ".join(words) + b" "
        there = set(words)
        tried = {i for w in there & self.known for i in self.by_word[w] if all(k & there for k in self.rules[i].keywords)}
        found = [(m.start(), m.end(), self.rules[i].priority, i) for i in sorted(tried) for m in self.rules[i].pattern.finditer(line)]
        base, kept = places(line, self.phrases), settled(found)
        ends = sorted({x for f in (*base, *kept) for x in f[:2]})
        word, n, before = {}, 0, 0
        for x in ends:  # blanks before a place are words before it
            n, before = n + line.count(b" ", before, x), x
            word[x] = n
        return len(words), [(word[s] - 1, word[e], label) for s, e, label in base], [(word[s] - 1, word[e], p, i) for s, e, p, i in kept]


SPAN = pa.struct([("first", pa.int64()), ("stop", pa.int64()), ("label", pa.string())])
MATCH = pa.struct([("first", pa.int64()), ("stop", pa.int64()), ("label", pa.string()), ("rule", pa.string()), ("priority", pa.int32())])


def scan(docs: DataFrame, rules: tuple[Rule, ...] | None = None, phrases: dict[str, str] = BASE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, places (spans of words first to stop - 1 with a phrase's label), matches (spans of the rules' matches that stay, their labels, rules and priorities)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = rules or standard_rules()
        scanner = Scanner(own, phrases)
        for b in batches:
            done = [scanner.scan(t.as_buffer().to_pybytes()) for t in b.column(1)]
            spans = [[{"first": s, "stop": e, "label": label} for s, e, label in x[1]] for x in done]
            matches = [[{"first": s, "stop": e, "label": own[i].label, "rule": own[i].name, "priority": p} for s, e, p, i in x[2]] for x in done]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x[0] for x in done], pa.int64()), pa.array(spans, pa.list_(SPAN)), pa.array(matches, pa.list_(MATCH))], names=["doc_id", "n_words", "places", "matches"])

    span, match = "struct<first:long,stop:long,label:string>", "struct<first:long,stop:long,label:string,rule:string,priority:int>"
    return words_source(docs, id_col, text_col).mapInArrow(run, f"doc_id long, n_words long, places array<{span}>, matches array<{match}>")


def joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def digests(scanned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of scan(). score: 1 less the product of what each label's best match leaves (1 - priority / 100;
    a phrase has 0.5)."""
    starts = F.transform("places", lambda p: p["first"])
    both = F.concat(F.transform("places", lambda p: F.struct(p["label"].alias("label"), F.lit(50).alias("priority"))), F.transform("matches", lambda m: F.struct(m["label"].alias("label"), m["priority"].alias("priority"))))
    best = lambda label: F.array_max(F.transform(F.filter("both", lambda x: x["label"] == label), lambda x: x["priority"]))
    left = F.aggregate(F.array_sort(F.array_distinct("both.label")), F.lit(1.0), lambda acc, label: acc * (1 - best(label) / 100))
    return scanned.withColumn("both", F.array_distinct(both)).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(F.col("places.label")).alias("base_labels"), joined(F.col("both.label")).alias("labels"), (1 - left).alias("score"), F.size("matches").cast("long").alias("n_matches"),
    )

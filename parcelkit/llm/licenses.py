"""License scan with ordered signature rules, in built-in functions only.

A text is reduced to its words in lower case, joined by single spaces. Each
rule is a hand-written regular expression over that form and has a keyword,
a word without which it cannot match. A text's words are intersected with
all keywords first, and only the rules of the keywords present are tried.
Detections are ordered by start, longer first, then by the rules' order; one
that lies within an earlier one is suppressed. So the most specific rule
speaks for a passage, and of rules for one passage the first.

Base phrases are rules too, but are neither suppressed nor suppress others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelkit.llm.common import prepare, tmp_names

# Fixed by the contract: phrases counted everywhere, and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# License families: label; keyword; name as a pattern over words; SPDX
# identifiers; words of its address. Names are tried plain and in a grant
# ("licensed under ..."), identifiers in an SPDX tag, addresses plain. An
# empty field makes no rule. The order is the order of the rules.
FAMILIES = """
agpl-3.0 ; affero ; (?:gnu )?affero general public licen[sc]e (?:version |v )?3(?: 0)? ; agpl 3 0(?: only| or later)? ; gnu org licenses agpl 3 0
agpl ; affero ; (?:gnu )?affero general public licen[sc]e ; agpl 1 0(?: only| or later)? ; gnu org licenses agpl
lgpl-2.1 ; lesser ; (?:gnu )?lesser general public licen[sc]e (?:version |v )?2 1 ; lgpl 2 1(?: only| or later)? ; gnu org licenses lgpl 2 1
lgpl-3.0 ; lesser ; (?:gnu )?lesser general public licen[sc]e (?:version |v )?3(?: 0)? ; lgpl 3 0(?: only| or later)? ; gnu org licenses lgpl 3 0
lgpl-2.0 ; library ; (?:gnu )?library general public licen[sc]e(?: (?:version |v )?2(?: 0)?)? ; lgpl 2 0(?: only| or later)? ; gnu org licenses old licenses lgpl 2 0
lgpl ; lesser ; (?:gnu )?lesser general public licen[sc]e ; ; gnu org copyleft lesser
gpl-3.0 ; general ; (?:gnu )?general public licen[sc]e (?:version |v )?3(?: 0)? ; gpl 3 0(?: only| or later)? ; gnu org licenses gpl 3 0
gpl-2.0 ; general ; (?:gnu )?general public licen[sc]e (?:version |v )?2(?: 0)? ; gpl 2 0(?: only| or later)? ; gnu org licenses old licenses gpl 2 0
gpl-1.0 ; general ; (?:gnu )?general public licen[sc]e (?:version |v )?1(?: 0)? ; gpl 1 0(?: only| or later)? ; gnu org licenses old licenses gpl 1 0
gpl ; general ; (?:gnu )?general public licen[sc]e ; ; gnu org licenses gpl
gpl-short ; gpl ; (?:gnu )?gpl (?:version |v )?[123](?: 0)? ; ; gnu org copyleft gpl
gpl-v ; gplv3 ; gplv3 ; ;
gpl-v ; gplv2 ; gplv2 ; ;
gfdl-1.3 ; documentation ; (?:gnu )?free documentation licen[sc]e (?:version |v )?1 3 ; gfdl 1 3(?: only| or later)? ; gnu org licenses fdl 1 3
gfdl ; documentation ; (?:gnu )?free documentation licen[sc]e ; gfdl 1 [12](?: only| or later)? ; gnu org licenses fdl
apache-2.0 ; apache ; apache (?:software )?licen[sc]e (?:version |v )?2(?: 0)? ; apache 2 0 ; apache org licenses license 2 0
apache-1.1 ; apache ; apache (?:software )?licen[sc]e (?:version |v )?1 1 ; apache 1 1 ; apache org licenses license 1 1
apache-1.0 ; apache ; apache (?:software )?licen[sc]e (?:version |v )?1(?: 0)? ; apache 1 0 ; apache org licenses license 1 0
apache ; apache ; apache (?:software )?licen[sc]e ; ; apache org licenses
mit-0 ; attribution ; mit no attribution(?: licen[sc]e)? ; mit 0 ; opensource org licenses mit 0
mit ; license ; mit licen[sc]e ; mit ; opensource org licenses mit
mit ; licence ; mit licence ; ; opensource org licence mit
expat ; expat ; expat licen[sc]e ; ; jclark com xml copying
x11 ; x11 ; (?:mit )?x11 licen[sc]e ; x11 ; xfree86 org current license
bsd-4-clause ; bsd ; (?:4 clause bsd|bsd 4 clause|original bsd)(?: licen[sc]e)? ; bsd 4 clause(?: uc)? ; directory fsf org license bsd 4clause
bsd-3-clause ; bsd ; (?:3 clause bsd|bsd 3 clause|new bsd|modified bsd|revised bsd)(?: licen[sc]e)? ; bsd 3 clause(?: clear| lbnl)? ; opensource org licenses bsd 3 clause
bsd-2-clause ; bsd ; (?:2 clause bsd|bsd 2 clause|simplified bsd)(?: licen[sc]e)? ; bsd 2 clause(?: patent| views)? ; opensource org licenses bsd 2 clause
bsd-2-clause ; freebsd ; freebsd licen[sc]e ; ; freebsd org copyright freebsd license
0bsd ; bsd ; zero clause bsd(?: licen[sc]e)? ; 0bsd ; landley net toybox license
bsd ; bsd ; bsd(?: style)? licen[sc]e ; ; opensource org licenses bsd license
isc ; isc ; isc licen[sc]e ; isc ; opensource org licenses isc
mpl-2.0 ; mozilla ; mozilla public licen[sc]e (?:version |v )?2(?: 0)? ; mpl 2 0 ; mozilla org mpl 2 0
mpl-1.1 ; mozilla ; mozilla public licen[sc]e (?:version |v )?1 1 ; mpl 1 1 ; mozilla org mpl 1 1
mpl ; mozilla ; mozilla public licen[sc]e ; mpl 1 0 ; mozilla org mpl
epl-2.0 ; eclipse ; eclipse public licen[sc]e (?:version |v )?2(?: 0)? ; epl 2 0 ; eclipse org legal epl 2 0
epl-1.0 ; eclipse ; eclipse public licen[sc]e (?:version |v )?1(?: 0)? ; epl 1 0 ; eclipse org legal epl v10
epl ; eclipse ; eclipse public licen[sc]e ; ; eclipse org legal
edl-1.0 ; eclipse ; eclipse distribution licen[sc]e(?: (?:version |v )?1(?: 0)?)? ; ; eclipse org org documents edl
cddl-1.1 ; distribution ; common development and distribution licen[sc]e (?:version |v )?1 1 ; cddl 1 1 ; glassfish java net public cddl
cddl-1.0 ; distribution ; common development and distribution licen[sc]e(?: (?:version |v )?1(?: 0)?)? ; cddl 1 0 ; opensource org licenses cddl
cpl-1.0 ; common ; common public licen[sc]e(?: (?:version |v )?1(?: 0)?)? ; cpl 1 0 ; opensource org licenses cpl1 0
eupl-1.2 ; union ; european union public licen[sc]e (?:version |v )?1 2 ; eupl 1 2 ; joinup ec europa eu page eupl
eupl ; union ; european union public licen[sc]e ; eupl 1 [01] ; eupl eu
osl-3.0 ; open ; open software licen[sc]e(?: (?:version |v )?3(?: 0)?)? ; osl 3 0 ; opensource org licenses osl 3 0
afl-3.0 ; academic ; academic free licen[sc]e(?: (?:version |v )?[23](?: [01])?)? ; afl 3 0 ; opensource org licenses afl 3 0
artistic-2.0 ; artistic ; artistic licen[sc]e (?:version |v )?2(?: 0)? ; artistic 2 0 ; perlfoundation org artistic license 2 0
artistic-1.0 ; artistic ; artistic licen[sc]e (?:version |v )?1(?: 0)? ; artistic 1 0(?: perl| cl8)? ; opensource org licenses artistic license 1 0
artistic ; artistic ; artistic licen[sc]e ; ; perlfoundation org artistic
boost-1.0 ; boost ; boost software licen[sc]e(?: (?:version |v )?1(?: 0)?)? ; bsl 1 0 ; boost org license 1 0
bsl-1.1 ; business ; business source licen[sc]e(?: (?:version |v )?1 1)? ; busl 1 1 ; mariadb com bsl11
sspl-1.0 ; server ; server side public licen[sc]e(?: (?:version |v )?1(?: 0)?)? ; sspl 1 0 ; mongodb com licensing server side public license
elastic-2.0 ; elastic ; elastic licen[sc]e(?: (?:version |v )?[12](?: 0)?)? ; elastic 2 0 ; elastic co licensing elastic license
commons-clause ; commons ; commons clause(?: license condition)? ; ; commonsclause com
cc0-1.0 ; cc0 ; cc0(?: 1 0)?(?: universal)? ; cc0 1 0 ; creativecommons org publicdomain zero
cc0-name ; creative ; creative commons zero(?: v?1 0)?(?: universal)? ; ; creativecommons org choose zero
cc-by-nc-nd ; cc ; cc by nc nd(?: [1-4] [05])? ; cc by nc nd [1-4] [05] ; creativecommons org licenses by nc nd
cc-by-nc-sa ; cc ; cc by nc sa(?: [1-4] [05])? ; cc by nc sa [1-4] [05] ; creativecommons org licenses by nc sa
cc-by-nc ; cc ; cc by nc(?: [1-4] [05])? ; cc by nc [1-4] [05] ; creativecommons org licenses by nc
cc-by-nd ; cc ; cc by nd(?: [1-4] [05])? ; cc by nd [1-4] [05] ; creativecommons org licenses by nd
cc-by-sa ; cc ; cc by sa(?: [1-4] [05])? ; cc by sa [1-4] [05] ; creativecommons org licenses by sa
cc-by-versioned ; cc ; cc by [1-4] [05] ; cc by [1-4] [05] ; creativecommons org licenses by
cc-by-nc-nd ; creative ; creative commons attribution non ?commercial no ?deriv(?:s|atives)(?: [1-4] [05])? ; ;
cc-by-nc-sa ; creative ; creative commons attribution non ?commercial share ?alike(?: [1-4] [05])? ; ;
cc-by-sa ; creative ; creative commons attribution share ?alike(?: [1-4] [05])? ; ;
cc-by-nc ; creative ; creative commons attribution non ?commercial(?: [1-4] [05])? ; ;
cc-by-name ; creative ; creative commons attribution(?: [1-4] [05])?(?: international| unported)? ; ;
creative-commons ; creative ; creative commons(?: licen[sc]e)? ; ; creativecommons org
odbl-1.0 ; database ; open (?:data commons open )?database licen[sc]e(?: v?1 0)? ; odbl 1 0 ; opendatacommons org licenses odbl
odc-by-1.0 ; commons ; open data commons attribution licen[sc]e(?: v?1 0)? ; odc by 1 0 ; opendatacommons org licenses by
pddl-1.0 ; dedication ; (?:open data commons )?public domain dedication and licen[sc]e(?: v?1 0)? ; pddl 1 0 ; opendatacommons org licenses pddl
cdla-permissive ; agreement ; community data licen[sc]e agreement permissive(?: v(?:ersion )?[12] 0)? ; cdla permissive [12] 0 ; cdla dev permissive
cdla-sharing ; agreement ; community data licen[sc]e agreement sharing(?: v(?:ersion )?1 0)? ; cdla sharing 1 0 ; cdla dev sharing
unlicense ; unlicense ; (?:the )?unlicense ; unlicense ; unlicense org
wtfpl ; wtfpl ; wtfpl(?: version 2)? ; wtfpl ; wtfpl net
zlib ; zlib ; zlib(?: libpng)? licen[sc]e ; zlib ; zlib net zlib license
libpng ; libpng ; libpng licen[sc]e(?: version 2)? ; libpng(?: 2 0)? ; libpng org pub png src libpng license
openssl ; openssl ; openssl licen[sc]e ; openssl ; openssl org source license
php-3.01 ; php ; php licen[sc]e(?: (?:version |v )?3 01)? ; php 3 01 ; php net license 3 01
python-2.0 ; python ; python software foundation licen[sc]e(?: version 2)? ; (?:python|psf) 2 0 ; docs python org license
ruby ; ruby ; ruby(?: s)? licen[sc]e ; ruby ; ruby lang org en about license
postgresql ; postgresql ; postgresql licen[sc]e ; postgresql ; opensource org licenses postgresql
ms-pl ; microsoft ; microsoft public licen[sc]e ; ms pl ; opensource org licenses ms pl
ms-rl ; microsoft ; microsoft reciprocal licen[sc]e ; ms rl ; opensource org licenses ms rl
ncsa ; ncsa ; (?:university of illinois )?ncsa open source licen[sc]e ; ncsa ; opensource org licenses ncsa
ofl-1.1 ; font ; (?:sil )?open font licen[sc]e(?: (?:version |v )?1 1)? ; ofl 1 1 ; scripts sil org ofl
ipa ; font ; ipa font licen[sc]e(?: agreement)? ; ipa ; ipafont ipa go jp
w3c ; w3c ; w3c software(?: notice and)? licen[sc]e ; w3c ; w3 org consortium legal copyright software
qpl-1.0 ; q ; q public licen[sc]e(?: (?:version |v )?1(?: 0)?)? ; qpl 1 0 ; opensource org licenses qtpl
sleepycat ; sleepycat ; sleepycat licen[sc]e ; sleepycat ; opensource org licenses sleepycat
upl-1.0 ; universal ; universal permissive licen[sc]e(?: (?:version |v )?1(?: 0)?)? ; upl 1 0 ; oss oracle com licenses upl
vim ; vim ; vim licen[sc]e ; vim ; vimhelp org uganda txt
beerware ; beerware ; beerware(?: licen[sc]e)? ; beerware ; people freebsd org phk
blueoak-1.0.0 ; oak ; blue oak model licen[sc]e(?: 1 0 0)? ; blueoak 1 0 0 ; blueoakcouncil org license 1 0 0
cecill-2.1 ; cecill ; cecill(?: [abc])?(?: free software)? licen[sc]e ; cecill(?: [bc])?(?: [12] [01])? ; cecill info licences
ecl-2.0 ; educational ; educational community licen[sc]e(?: (?:version |v )?2(?: 0)?)? ; ecl 2 0 ; opensource org licenses ecl 2 0
llama ; llama ; llama (?:[234] )?community licen[sc]e(?: agreement)? ; ; llama meta com license
openrail ; openrail ; (?:bigscience |creativeml )?openrail(?: m)?(?: licen[sc]e)? ; openrail ; huggingface co spaces bigscience license
public-domain ; domain ; (?:released |dedicated |placed )?(?:in|into|to) the public domain ; ;
proprietary ; proprietary ; proprietary(?: and confidential)? (?:licen[sc]e|software|information) ; licenseref proprietary ;
no-redistribution ; redistribution ; (?:no|without) (?:copying or )?redistribution(?: permitted| allowed)? ; ;
mit-text ; permission ; permission is hereby granted free of charge to any person obtaining a copy ; ;
isc-text ; permission ; permission to use copy modify and or distribute this software for any purpose ; ;
bsd-text ; redistribution ; redistribution and use in source and binary forms with or without modification are permitted ; ;
apache-text ; compliance ; you may not use this file except in compliance with the licen[sc]e ; ;
gpl-text ; warranty ; this program is distributed in the hope that it will be useful but without any warranty ; ;
copyright-notice ; copyright ; copyright (?:c )?(?:19|20)[0-9]{2} ; ;
"""
GRANT = (r"(?:licen[sc]ed|released|distributed|published|provided|available|offered|dual licen[sc]ed)"
         r" (?:to you )?under (?:the )?(?:terms of (?:the )?)?")


@dataclass(frozen=True)
class Signature:
    rank: int      # order of the rules; smaller goes first
    label: str
    keyword: str   # a word of every match
    pattern: str   # over the words of a match, without the spaces around them
    weight: float  # how sure a detection is, 0 to 1
    base: bool = False


def signatures() -> list[Signature]:
    """All rules in order: grants, SPDX tags, addresses, plain names; base last."""
    families = [[x.strip() for x in row.split(";")] for row in FAMILIES.strip().splitlines()]
    forms = [(lambda f: f[2] and GRANT + f[2], None, 0.95),
             (lambda f: f[3] and rf"spdx licen[sc]e identifier (?:{f[3]})", "spdx", 1.0),
             (lambda f: f[4], None, 0.9),
             (lambda f: f[2], None, 0.7)]
    out = []
    for at, (make, keyword, weight) in enumerate(forms):
        for f in families:
            if make(f):
                # An address is gated by a word of its own.
                word = max(f[4].split(), key=len) if at == 2 else keyword or f[1]
                out.append(Signature(len(out), f[0], word, make(f), weight))
    for phrase, label in BASE:
        out.append(Signature(len(out), label, max(phrase.split(), key=len), phrase, 0.5, True))
    return out


def words_of(text: Column) -> Column:
    """The text's words in lower case, joined by single spaces. Only A-Z fold
    into ASCII letters but for one sign (Kelvin), which no base phrase holds."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _spans(joined: Column, rule: Column) -> Column:
    """Detections of one rule as (start, end descending, rank, label, weight,
    base): the words before a match are counted on a copy of the text in
    which a control character marks where matches begin."""
    full = F.concat(F.lit("(?<![^ ])(?:"), rule["pattern"], F.lit(")(?![^ ])"))
    marked = F.split(F.regexp_replace(joined, full, F.lit("\x01$0")), " ")
    starts = F.filter(F.transform(marked, lambda w, i: F.when(w.startswith("\x01"), i)), lambda i: i.isNotNull())
    sizes = F.transform(F.regexp_extract_all(joined, full, F.lit(0)), lambda m: F.size(F.split(m, " ")))
    return F.zip_with(starts, sizes, lambda s, n: F.struct(
        s.alias("start"), (-(s + n)).alias("till"), rule["rank"].alias("rank"), rule["label"].alias("label"),
        rule["weight"].alias("weight"), rule["base"].alias("base")))


SPAN = "array<struct<start:int,till:int,rank:int,label:string,weight:double,base:boolean>>"


def scan(docs: DataFrame, text: str = "text", rules: list[Signature] | None = None) -> DataFrame:
    """``docs`` with struct column ``licenses``: n_words, base (detections of
    the base phrases) and found (the detections that stand), both as arrays
    of (start, till, rank, label, weight, base) in order; till is minus the
    word after the last, words count from 0.

    All of it is computed within a row: nothing is shuffled, repeated rows
    and any doc_id are as good as others. Null and empty texts have no words
    and no detections. ``licenses`` replaces an input column of that name.
    """
    prepare(docs.sparkSession)
    rules = signatures() if rules is None else rules
    joined, words, keys = tmp_names(docs, "license_text", "license_words", "license_keys")
    table = F.array(*(F.struct(F.lit(r.keyword).alias("keyword"), F.lit(r.pattern).alias("pattern"),
                               F.lit(r.rank).alias("rank"), F.lit(r.label).alias("label"),
                               F.lit(r.weight).alias("weight"), F.lit(r.base).alias("base")) for r in rules))
    keywords = F.array(*(F.lit(k) for k in sorted({r.keyword for r in rules})))
    gated = (docs.withColumn(joined, words_of(F.col(f"`{text}`")))
             .withColumn(words, F.split(joined, " "))
             .withColumn(keys, F.array_intersect(words, keywords)))
    tried = F.filter(table, lambda r: F.array_contains(F.col(keys), r["keyword"]))
    spans = F.array_sort(F.flatten(F.transform(tried, lambda r: _spans(F.col(joined), r))))
    none = F.array().cast(SPAN)
    start = F.struct(F.lit(0).alias("reach"), none.alias("kept"))

    def result(s: Column) -> Column:  # s is a lambda variable: the spans are computed once
        kept = F.aggregate(
            F.filter(s, lambda x: ~x["base"]), start,
            lambda acc, x: F.when(-x["till"] <= acc["reach"], acc).otherwise(
                F.struct((-x["till"]).alias("reach"), F.concat(acc["kept"], F.array(x)).alias("kept"))),
            lambda acc: acc["kept"])
        return F.struct(F.filter(s, lambda x: x["base"]).alias("base"), kept.alias("found"))

    hit = F.when(F.size(keys) > 0, F.transform(F.array(spans), result)[0]).otherwise(
        F.struct(none.alias("base"), none.alias("found")))
    n = F.when(F.col(joined) == "", F.lit(0)).otherwise(F.size(words)).cast("long")
    (tmp,) = tmp_names(gated, "license_hit")
    out = gated.withColumn(tmp, hit)
    mark = F.struct(n.alias("n_words"), F.col(tmp)["base"].alias("base"), F.col(tmp)["found"].alias("found"))
    return out.withColumn("licenses", mark).select(*(f"`{c}`" for c in docs.columns if c != "licenses"), "licenses")


def labels(*spans: Column) -> Column:
    """Distinct labels of detections, sorted and joined by commas."""
    each = F.concat(*(F.transform(s, lambda x: x["label"]) for s in spans))
    return F.array_join(F.array_sort(F.array_distinct(each)), ",")

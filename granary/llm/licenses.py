"""License scan: ordered signature rules over whole texts, with DataFrame functions only.

A text is brought to lower-case words joined by single spaces. Every rule has a keyword that each of
its matches must contain; a rule's pattern runs only where the text contains the keyword. A rule also
has a priority: 4 for a machine-readable tag, 3 for a sentence that grants a named license, 2 for a
name with its version, 1 for a bare name. Detections are sorted by place; one that lies within
another of higher priority is suppressed in a single ordered pass.

The four base phrases are counted wherever they stand; their labels stay whatever suppresses them.

Null and empty texts have no words: counts 0, places null, labels '' and score 0. Rows are handled one
by one without a shuffle, so repeated rows repeat and no group of copies is heavier than its rows.
(Letters outside A-Z are lower-cased too, which moves no word's edge.)
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import pick

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = (
    ("gnu general public license", "gpl", " gnu "),
    ("apache license", "apache", " apache "),
    ("cc by", "cc-by", " cc "),
    ("mit license", "mit", " mit "),
)
FOUND = "array<struct<start:int,neg_end:int,neg_prio:int,label:string,base:boolean>>"
CONFIDENCE = {4: 1.0, 3: 0.95, 2: 0.85, 1: 0.6}

L = "licen[cs]e"
GRANT = r"(?:licensed|released|distributed|available|published|made available|provided|covered|offered)"
UNDER = r"under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?"
TAG = r"spdx license identifier "
VER = r"(?:version |v ?)?"


def _versioned(label: str, key: str, names: str, versions: dict[str, str]) -> list[tuple]:
    """Rules of a license family: for each version a tagged, a granting and a named form."""
    out = []
    for suffix, pattern in versions.items():
        out.append((key, 3, f"{label}-{suffix}", rf"{GRANT} {UNDER}{names} {pattern}"))
        out.append((key, 2, f"{label}-{suffix}", rf"{names} {pattern}"))
    return out


def _tags(entries: dict[str, str]) -> list[tuple]:
    return [(" spdx ", 4, label, TAG + pattern) for label, pattern in entries.items()]


def rules() -> list[tuple[str, int, str, str]]:
    """(keyword, priority, label, pattern) in order; keywords are parts of the space-padded text."""
    v = {n: rf"{VER}{n.replace('.', ' ')}" for n in ("1.0", "1.1", "1.2", "1.3", "2.0", "2.1", "2.5", "3.0", "4.0")}
    whole = r"(?: 0)?(?! [1-9](?: |$))"  # "2" isn't found in "2 1"
    n = {k: rf"{VER}{k}{whole}" for k in ("1", "2", "3")}
    out: list[tuple[str, int, str, str]] = []
    out += _versioned("gpl", " gnu ", rf"gnu general public {L}", n)
    out += _versioned("lgpl", " gnu ", rf"gnu (?:lesser|library) general public {L}",
                      {"2": n["2"], "2.1": rf"{VER}2 1", "3": n["3"]})
    out += _versioned("agpl", " gnu ", rf"gnu affero general public {L}", {k: n[k] for k in ("1", "3")})
    out += _versioned("gfdl", " gnu ", rf"gnu free documentation {L}", {k: v[k] for k in ("1.1", "1.2", "1.3")})
    out += _versioned("apache", " apache ", rf"apache (?:software )?{L}", {k: v[k] for k in ("1.0", "1.1", "2.0")})
    out += _versioned("mpl", " mozilla ", rf"mozilla public {L}", {k: v[k] for k in ("1.0", "1.1", "2.0")})
    out += _versioned("epl", " eclipse ", rf"eclipse public {L}", {k: v[k] for k in ("1.0", "2.0")})
    out += _versioned("eupl", " european ", rf"european union public {L}", {k: v[k] for k in ("1.0", "1.1", "1.2")})
    out += _versioned("cddl", " common ", rf"common development and distribution {L}", {k: v[k] for k in ("1.0", "1.1")})
    out += _versioned("cpl", " common ", rf"common public {L}", {"1.0": v["1.0"]})
    out += _versioned("artistic", " artistic ", rf"artistic {L}", {k: v[k] for k in ("1.0", "2.0")})
    out += _versioned("ofl", " sil ", rf"sil open font {L}", {k: v[k] for k in ("1.0", "1.1")})
    out += _versioned("bsl", " boost ", rf"boost software {L}", {"1.0": v["1.0"]})
    out += _versioned("afl", " academic ", rf"academic free {L}", {k: v[k] for k in ("1.1", "1.2", "2.0", "2.1", "3.0")})
    out += _versioned("osl", " open ", rf"open software {L}", {k: v[k] for k in ("1.0", "1.1", "2.0", "2.1", "3.0")})
    out += _versioned("odbl", " open ", rf"open (?:data commons open )?database {L}", {"1.0": v["1.0"]})
    out += _versioned("lppl", " latex ", rf"latex project public {L}", {k: v[k] for k in ("1.0", "1.1", "1.2")})
    out += [(" microsoft ", 3, "ms-pl-1", rf"{GRANT} {UNDER}microsoft public {L}(?: ms pl)?"),
            (" microsoft ", 2, "ms-pl-1", rf"microsoft public {L}(?: ms pl)?")]
    out += _versioned("psf", " python ", rf"python software foundation {L}", {"2": n["2"]})
    out += _versioned("upl", " universal ", rf"universal permissive {L}", {"1.0": v["1.0"]})
    out += _versioned("zpl", " zope ", rf"zope public {L}", {k: v[k] for k in ("1.1", "2.0", "2.1")})
    for short, words in (("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
                         ("by-nc", "attribution non ?commercial"), ("by-nc-sa", "attribution non ?commercial share ?alike"),
                         ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?")):
        tag = short.replace("-", " ")
        for ver in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            num = ver.replace(".", " ")
            out.append((" cc ", 2, f"cc-{short}-{ver}", rf"cc {tag} (?:version |v ?)?{num}"))
            out.append((" creative ", 3, f"cc-{short}-{ver}", rf"creative commons {words} {num}(?: international| unported| generic)?"))
        out.append((" creative ", 2, f"cc-{short}", rf"creative commons {words}(?: {L})?"))
        out.append((" cc ", 1, f"cc-{short}", rf"cc {tag}"))
        out.append((" creativecommons ", 3, f"cc-{short}", rf"creativecommons org licenses {tag}(?: \d \d)?"))
    out += _tags({f"cc-{s}-{x}": rf"cc {s.replace('-', ' ')} {x.replace('.', ' ')}"
                  for s in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd") for x in ("2.0", "3.0", "4.0")})
    out += _tags({f"{f}-{x}": rf"{f} {x}(?: 0)?(?: only| or later)?" for f in ("gpl", "lgpl", "agpl") for x in ("2", "3")})
    out += _tags({
        "apache-2.0": "apache 2 0", "apache-1.1": "apache 1 1", "mit": "mit(?: 0)?", "isc": "isc",
        "bsd-2-clause": "bsd 2 clause(?: patent)?", "bsd-3-clause": "bsd 3 clause(?: clear)?", "bsd-4-clause": "bsd 4 clause",
        "0bsd": "0bsd", "mpl-2.0": "mpl 2 0", "mpl-1.1": "mpl 1 1", "epl-1.0": "epl 1 0", "epl-2.0": "epl 2 0",
        "eupl-1.1": "eupl 1 1", "eupl-1.2": "eupl 1 2", "cddl-1.0": "cddl 1 0", "cddl-1.1": "cddl 1 1", "lgpl-2.1": "lgpl 2 1(?: only| or later)?",
        "cc0-1.0": "cc0 1 0", "unlicense": "unlicense", "wtfpl": "wtfpl", "zlib": "zlib", "bsl-1.0": "bsl 1 0",
        "artistic-2.0": "artistic 2 0", "ofl-1.1": "ofl 1 1", "postgresql": "postgresql", "ncsa": "ncsa", "python-2.0": "python 2 0",
        "openssl": "openssl", "ms-pl": "ms pl", "ms-rl": "ms rl", "upl-1.0": "upl 1 0", "odbl-1.0": "odbl 1 0", "blueoak-1.0.0": "blueoak 1 0 0",
    })
    out += [
        (" gpl", 2, "gpl-2", r"gpl ?v?2(?: 0)?(?: only| or later)?"), (" gpl", 2, "gpl-3", r"gpl ?v?3(?: 0)?(?: only| or later)?"),
        (" gpl", 1, "gpl", r"gpl"), (" lgpl", 2, "lgpl-2.1", r"lgpl ?v?2 1"), (" lgpl", 2, "lgpl-3", r"lgpl ?v?3(?: 0)?"),
        (" lgpl", 1, "lgpl", r"lgpl"), (" agpl", 2, "agpl-3", r"agpl ?v?3(?: 0)?"), (" agpl", 1, "agpl", r"agpl"),
        (" gnu ", 3, "gpl", rf"{GRANT} {UNDER}gnu general public {L}"), (" gnu ", 1, "lgpl", rf"gnu (?:lesser|library) general public {L}"),
        (" gnu ", 1, "agpl", rf"gnu affero general public {L}"), (" gnu ", 1, "gfdl", rf"gnu free documentation {L}"),
        (" gnu ", 3, "gpl-2-or-later", r"gnu general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version"),
        (" gnu ", 3, "gpl-3-or-later", r"gnu general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version"),
        (" apache ", 3, "apache", rf"{GRANT} {UNDER}apache (?:software )?{L}"), (" apache ", 2, "apache-2.0", r"apache (?:license )?v?2(?: 0)?"),
        (" apache ", 3, "apache-2.0", r"apache org licenses license 2 0"), (" apache ", 1, "apache", rf"apache software {L}"),
        (" mit ", 3, "mit", rf"{GRANT} {UNDER}mit(?: x11)? {L}"), (" mit ", 1, "mit", r"mit licensed"), (" expat ", 1, "mit", rf"expat {L}"),
        (" permission ", 3, "mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
        (" permission ", 3, "isc", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
        (" isc ", 1, "isc", rf"isc {L}"), (" isc ", 3, "isc", rf"{GRANT} {UNDER}isc {L}"),
        (" redistribution ", 3, "bsd", r"redistribution and use in source and binary forms with or without modification are permitted"),
        (" bsd ", 1, "bsd", rf"bsd(?: style)? {L}"), (" bsd ", 2, "bsd-2-clause", rf"(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: {L})?"),
        (" freebsd ", 2, "bsd-2-clause", rf"freebsd(?: {L})?"),
        (" bsd ", 2, "bsd-3-clause", rf"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: {L})?"),
        (" bsd ", 2, "bsd-4-clause", rf"(?:bsd 4 clause|4 clause bsd|original bsd)(?: {L})?"),
        (" bsd ", 3, "bsd", rf"{GRANT} {UNDER}(?:[234] clause |new |simplified )?bsd(?: [234] clause)?(?: style)? {L}"),
        (" mozilla ", 1, "mpl", rf"mozilla public {L}"), (" mpl ", 2, "mpl-2.0", r"mpl (?:v ?)?2 0"), (" mpl ", 2, "mpl-1.1", r"mpl (?:v ?)?1 1"),
        (" eclipse ", 1, "epl", rf"eclipse public {L}"), (" eclipse ", 1, "edl-1.0", rf"eclipse distribution {L}"),
        (" european ", 1, "eupl", rf"european union public {L}"), (" artistic ", 1, "artistic", rf"artistic {L}"),
        (" boost ", 1, "bsl-1.0", rf"boost software {L}"), (" zlib ", 1, "zlib", rf"zlib(?: libpng)? {L}"),
        (" unlicense", 1, "unlicense", r"unlicensed?"), (" unencumbered ", 3, "unlicense", r"this is free and unencumbered software released into the public domain"),
        (" wtfpl ", 1, "wtfpl", r"wtfpl"), (" beerware", 1, "beerware", rf"beerware(?: {L})?"), (" openssl ", 1, "openssl", rf"openssl {L}"),
        (" sleepycat ", 1, "sleepycat", rf"sleepycat {L}"), (" vim ", 1, "vim", rf"vim {L}"), (" ruby ", 1, "ruby", rf"ruby {L}"),
        (" php ", 1, "php", rf"php {L}"), (" php ", 2, "php-3.01", rf"php {L} (?:version |v ?)?3 01"), (" w3c ", 1, "w3c", rf"w3c (?:software (?:notice and )?)?{L}"),
        (" postgresql ", 1, "postgresql", rf"postgresql {L}"), (" ncsa ", 1, "ncsa", rf"(?:university of illinois )?ncsa(?: open source)? {L}"),
        (" cc0 ", 2, "cc0-1.0", r"cc0 1 0(?: universal)?"), (" cc0 ", 1, "cc0", r"cc0"), (" zero ", 3, "cc0", r"creative commons zero"),
        (" creative ", 1, "creative-commons", rf"creative commons(?: {L})?"), (" cc ", 3, "cc-by", rf"{GRANT} {UNDER}cc by"),
        (" cc ", 3, "cc-by-nc-4.0", rf"{GRANT} {UNDER}cc by nc 4 0"), (" cc ", 3, "cc-by-sa-4.0", rf"{GRANT} {UNDER}cc by sa 4 0"),
        (" domain ", 1, "public-domain", r"(?:dedicated to|released into|placed in|in) the public domain"), (" domain ", 2, "public-domain", r"public domain (?:dedication|mark)(?: 1 0)?"),
        (" proprietary ", 2, "proprietary", r"proprietary and confidential"), (" reserved ", 1, "all-rights-reserved", r"all rights reserved"),
        (" copyright ", 2, "all-rights-reserved", r"copyright (?:c )?(?:\d{4} )?(?:[^ ]+ ){0,6}?all rights reserved"),
        (" sspl", 1, "sspl-1", r"sspl(?: v?1)?"), (" elastic ", 1, "elastic", rf"elastic {L}(?: 2 0)?"), (" business ", 1, "busl-1.1", rf"business source {L}(?: 1 1)?"),
        (" polyform ", 1, "polyform", rf"polyform [^ ]+(?: [^ ]+)? {L}"), (" commons ", 1, "commons-clause", r"commons clause"),
        (" open ", 1, "odc-by", rf"open data commons attribution {L}"), (" government ", 1, "ogl", rf"open government {L}"),
        (" cecill", 1, "cecill", rf"cecill(?: [bc])?(?: {L})?"), (" mulan ", 1, "mulan", rf"mulan (?:permissive|public) (?:software )?{L}"),
        (" intel ", 1, "intel", rf"intel open source {L}"), (" q ", 1, "qpl", rf"q public {L}"), (" qt ", 1, "qpl", rf"qt public {L}"), (" ibm ", 1, "ipl", rf"ibm public {L}"),
        (" sun ", 1, "spl", rf"sun public {L}"), (" nokia ", 1, "nokia", rf"nokia open source {L}"), (" apple ", 1, "apsl", rf"apple public source {L}"),
        (" netscape ", 1, "npl", rf"netscape public {L}"), (" lucent ", 1, "lpl", rf"lucent public {L}"), (" dual ", 2, "dual", r"dual licensed under"),
        (" open ", 1, "osl", rf"open software {L}"), (" academic ", 1, "afl", rf"academic free {L}"), (" sil ", 1, "ofl", rf"sil open font {L}"),
        (" latex ", 1, "lppl", rf"latex project public {L}"), (" zope ", 1, "zpl", rf"zope public {L}"), (" microsoft ", 1, "ms-rl", rf"microsoft reciprocal {L}"),
        (" python ", 1, "psf", rf"python software foundation {L}"), (" blue ", 1, "blueoak-1.0.0", rf"blue oak model {L}(?: 1 0 0)?"),
    ]
    return out


def _whole(pattern: str) -> str:
    return rf"(?<![^ ])(?:{pattern})(?![^ ])"


def _rule_array(all_rules: list[tuple]) -> Column:
    """The rules as one literal array of structs."""
    base = [(key, 1, label, phrase, True) for phrase, label, key in BASE]
    rows = [{"key": k, "prio": p, "label": label, "rx": _whole(rx), "base": is_base}
            for k, p, label, rx, is_base in base + [(*r, False) for r in all_rules]]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<key:string,prio:int,label:string,rx:string,base:boolean>>")


def _gate(keys: list[str]) -> str:
    """A pattern that finds some keyword at the start of a word, grouped by first letter."""
    by_first: dict[str, list[str]] = {}
    for k in keys:  # a key that ends in a space is a whole word, another the start of one
        by_first.setdefault(k[1], []).append(k[2:].rstrip() + (r"(?: |$)" if k.endswith(" ") else ""))
    groups = "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by_first.items())
    return rf"(?:^| )(?:{groups})"


def _let(value: Column, use) -> Column:
    """use(value) with the value worked out once for a row: the optimizer copies a plain column's
    expression into a lambda, which would run it for every element."""
    return F.transform(F.array(value), use)[0]


def _places(text: Column, pattern: Column) -> Column:
    """Structs (s, e) of the first and last word of each match: matches are marked, then the marked
    words are found, so the time is linear in the text."""

    def at(words: Column, mark) -> Column:
        return F.filter(F.transform(words, lambda w, i: F.when(mark(w), i)), lambda i: i.isNotNull())

    return _let(
        F.split(F.regexp_replace(text, pattern, F.lit("\x01$0\x02")), " ", -1),
        lambda words: F.arrays_zip(at(words, lambda w: w.startswith("\x01")).alias("s"),
                                   at(words, lambda w: w.endswith("\x02")).alias("e")))


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           extra: list[tuple[str, int, str, str]] | None = None) -> DataFrame:
    """Per row: id, n_words and ``found``: sorted structs (start, neg_end, neg_prio, label, base) in
    words, before suppression. ``extra`` rules come after the built-in ones."""
    ordered = rules() + list(extra or [])
    names = list(dict.fromkeys([k for *_, k in BASE] + [r[0] for r in ordered]))
    keys = F.array(*[F.lit(k) for k in names])
    base = pick(docs, id_col, text_col).select(
        F.col(id_col).alias("id"),
        F.trim(F.regexp_replace(F.translate(F.coalesce(F.col(text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), SEPARATORS, " ")).alias("norm"))
    n_words = F.when(F.col("norm") == "", 0).otherwise(F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit(""))) + 1)
    all_rules = _rule_array(ordered)

    def places(norm: Column, r: Column) -> Column:
        return F.transform(_places(norm, r["rx"]), lambda p: F.struct(
            p["s"].alias("start"), (-p["e"]).alias("neg_end"), (-r["prio"]).alias("neg_prio"),
            r["label"].alias("label"), r["base"].alias("base")))

    def found(norm: Column) -> Column:
        some = _let(F.concat(F.lit(" "), norm, F.lit(" ")), lambda padded: F.filter(keys, lambda k: padded.contains(k)))
        return _let(some, lambda have: F.array_sort(F.flatten(F.transform(
            F.filter(all_rules, lambda r: F.array_contains(have, r["key"]) & F.rlike(norm, r["rx"])),
            lambda r: places(norm, r)))))

    return base.select(
        F.col("id").alias(id_col), n_words.cast("long").alias("n_words"),
        F.when(F.col("norm").rlike(_gate(names)), _let(F.col("norm"), found)).otherwise(F.array().cast(FOUND)).alias("found"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         extra: list[tuple[str, int, str, str]] | None = None) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    rows = detect(docs, id_col, text_col, extra)
    start = F.struct(
        *[F.lit(-1).alias(f"end{p}") for p in (2, 3, 4)],
        F.array().cast("array<string>").alias("labels"), F.lit(0).alias("best"),
    )

    def step(acc: Column, d: Column) -> Column:
        end, prio = -d["neg_end"], -d["neg_prio"]
        above = F.when(prio == 1, acc["end2"]).when(prio == 2, acc["end3"]).when(prio == 3, acc["end4"]).otherwise(F.lit(-1))
        keep = above < end
        return F.struct(
            *[F.when(prio >= p, F.greatest(acc[f"end{p}"], end)).otherwise(acc[f"end{p}"]).alias(f"end{p}") for p in (2, 3, 4)],
            F.when(keep, F.array_union(acc["labels"], F.array(d["label"]))).otherwise(acc["labels"]).alias("labels"),
            F.when(keep, F.greatest(acc["best"], prio)).otherwise(acc["best"]).alias("best"),
        )

    rows = rows.select(
        id_col, "n_words",
        _let(F.col("found"), lambda f: F.struct(F.filter(f, lambda d: d["base"]).alias("b"), F.aggregate(f, start, step).alias("kept"))).alias("r"),
    )
    places = F.transform("r.b", lambda d: d["start"])
    base_labels = F.array_sort(F.array_distinct(F.transform("r.b", lambda d: d["label"])))
    best = F.col("r.kept.best")
    score = F.lit(0.0)
    for p, c in CONFIDENCE.items():
        score = F.when(best == p, F.lit(c)).otherwise(score)
    return rows.select(
        id_col, "n_words", F.size("r.b").cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        F.concat_ws(",", base_labels).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(base_labels, F.col("r.kept.labels")))).alias("labels"),
        score.alias("score"),
    )

"""Licence detection by ordered signature rules, in Spark columns only.

A text is reduced to lower-case words. A prefilter of keywords picks the texts, and then the
rules, that are worth a regular expression. Every match is an interval of words with the
priority of its rule; one that lies inside an interval of higher priority is suppressed.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases counted whatever the rules say, with their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

RULE = "struct<regex:string,keyword:string,label:string,trust:double,place:int>"
SPAN = "struct<start:int,end:int,place:int,label:string,trust:double>"

_NUMBERS = {"1 0": "1.0", "1 1": "1.1", "2 0": "2.0", "2 1": "2.1", "2 5": "2.5", "3 0": "3.0", "4 0": "4.0"}


def _cc_rules():
    words = {
        "by": "attribution",
        "by sa": "attribution share ?alike",
        "by nd": "attribution no ?deriv(?:ative)?s?",
        "by nc": "attribution non ?commercial",
        "by nc sa": "attribution non ?commercial share ?alike",
        "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s?",
    }
    for short, long in words.items():
        label = "cc-" + short.replace(" ", "-")
        for form, keyword in ((f"cc {short}", "cc"), (f"creative commons {long}", "creative")):
            for number in ("1 0", "2 0", "2 5", "3 0", "4 0"):
                yield f"{form}(?: international| unported| generic| license| licence| version)* {number}", keyword, f"{label}-{_NUMBERS[number]}", 1.0
            yield form, keyword, label, 0.9
    yield "cc0(?: 1 0)?", "cc0", "cc0-1.0", 1.0
    yield "creative commons zero", "creative", "cc0-1.0", 1.0
    yield "creative commons", "creative", "creative-commons", 0.6


def _gnu_rules():
    families = {
        "agpl": ("affero general public licen[sc]e", ("3",)),
        "lgpl": ("(?:lesser|library) general public licen[sc]e", ("2", "2 1", "3")),
        "gfdl": ("free documentation licen[sc]e", ("1 1", "1 2", "1 3")),
        "gpl": ("general public licen[sc]e", ("1", "2", "3")),
    }
    for short, (name, versions) in families.items():
        for version in versions:
            dotted = version.replace(" ", ".")
            tail = f"(?:(?: as)? published by the free software foundation)?(?: either)?(?: v| version)? ?{version}(?: 0)?"
            for later, mark in ((" or(?: at your option)?(?: any)? later(?: version)?", "+"), ("", "")):
                yield f"(?:gnu )?{name}{tail}{later}", "public" if short != "gfdl" else "documentation", f"{short}-{dotted}{mark}", 1.0
                yield f"(?:gnu )?{short} ?v? ?{version}(?: 0)?{later}", short, f"{short}-{dotted}{mark}", 0.95
        yield f"gnu {name}", "gnu", short, 0.9
        yield name, "licen", short, 0.8
        yield f"(?:gnu )?{short} licen[sc]ed?", short, short, 0.8


def _named_rules():
    # Name, keyword, versions, label.
    named = (
        ("apache (?:software )?licen[sc]e", "apache", ("1 0", "1 1", "2 0"), "apache"),
        ("mozilla public licen[sc]e", "mozilla", ("1 0", "1 1", "2 0"), "mpl"),
        ("eclipse public licen[sc]e", "eclipse", ("1 0", "2 0"), "epl"),
        ("common development and distribution licen[sc]e", "development", ("1 0", "1 1"), "cddl"),
        ("academic free licen[sc]e", "academic", ("2 1", "3 0"), "afl"),
        ("open software licen[sc]e", "software", ("1 0", "2 0", "3 0"), "osl"),
        ("artistic licen[sc]e", "artistic", ("1 0", "2 0"), "artistic"),
        ("european union public licen[sc]e", "european", ("1 0", "1 1"), "eupl"),
        ("common public licen[sc]e", "common", ("1 0",), "cpl"),
        ("boost software licen[sc]e", "boost", ("1 0",), "bsl"),
        ("sil open font licen[sc]e", "font", ("1 0", "1 1"), "ofl"),
        ("open database licen[sc]e", "database", ("1 0",), "odbl"),
        ("microsoft (?:public|reciprocal) licen[sc]e", "microsoft", (), "ms-pl"),
        ("python software foundation licen[sc]e", "python", ("2 0",), "psf"),
        ("php licen[sc]e", "php", ("3 0",), "php"),
        ("ruby licen[sc]e", "ruby", (), "ruby"),
        ("zope public licen[sc]e", "zope", ("2 0", "2 1"), "zpl"),
        ("q public licen[sc]e", "public", ("1 0",), "qpl"),
        ("isc licen[sc]e", "isc", (), "isc"),
        ("zlib licen[sc]e", "zlib", (), "zlib"),
        ("x11 licen[sc]e", "x11", (), "x11"),
        ("postgresql licen[sc]e", "postgresql", (), "postgresql"),
        ("vim licen[sc]e", "vim", (), "vim"),
        ("beerware(?: licen[sc]e)?", "beerware", (), "beerware"),
        ("do what the f[a-z]* you want to public licen[sc]e", "want", (), "wtfpl"),
        ("wtfpl", "wtfpl", (), "wtfpl"),
        ("unlicense", "unlicense", (), "unlicense"),
        ("this is free and unencumbered software released into the public domain", "unencumbered", (), "unlicense"),
    )
    for name, keyword, versions, label in named:
        for version in versions:
            yield f"{name}(?: v| version)? ?{version}", keyword, f"{label}-{version.replace(' ', '.')}", 1.0
        yield name, keyword, label, 0.9
    for count, written in (("2", "two|2"), ("3", "three|3"), ("4", "four|4")):
        for words in ("bsd (?:{0}) clause(?: licen[sc]e)?", "(?:{0}) clause bsd(?: licen[sc]e)?", "(?:new|modified|simplified) (?:{0}) clause bsd"):
            yield words.format(written), "bsd", f"bsd-{count}-clause", 1.0
    yield "bsd(?: style)? licen[sc]e", "bsd", "bsd", 0.8
    yield "(?:the )?mit(?: x11)? licen[sc]e", "mit", "mit", 1.0
    yield "expat licen[sc]e", "expat", "mit", 1.0
    for name in "mit isc zlib unlicense wtfpl apache-2.0 bsd-2-clause bsd-3-clause mpl-2.0 epl-2.0 cc0-1.0 ofl-1.1 bsl-1.0 gpl-2.0 gpl-3.0 lgpl-2.1 lgpl-3.0 agpl-3.0 cddl-1.0 artistic-2.0 eupl-1.2 odbl-1.0 cc-by-4.0 cc-by-sa-4.0".split():
        for tail, mark in ((" only", ""), (" or later", "+"), ("", "")):
            yield f"spdx licen[sc]e identifier {name.replace('-', ' ').replace('.', ' ')}{tail}", "spdx", name + mark, 1.0


def _text_rules():
    # Sentences of licence texts and notices.
    grants = (
        ("permission is hereby granted free of charge to any person obtaining a copy", "hereby", "mit", 1.0),
        ("permission to use copy modify and or distribute this software for any purpose", "permission", "isc", 1.0),
        ("redistribution and use in source and binary forms with or without modification", "redistribution", "bsd", 0.9),
        ("this program is free software you can redistribute it", "redistribute", "gpl", 0.9),
        ("this library is free software you can redistribute it", "redistribute", "lgpl", 0.9),
        ("(?:is |was )?(?:released|dedicated|placed) (?:in|into|to) the public domain", "domain", "public-domain", 0.9),
        ("public domain", "domain", "public-domain", 0.7),
        ("the software is provided as is(?: without warranty of any kind)?", "provided", "warranty-disclaimer", 0.7),
        ("all rights reserved", "reserved", "reserved", 1.0),
        ("no part of this (?:publication|work|book|document) may be reproduced", "reproduced", "reserved", 1.0),
        ("unauthori[sz]ed (?:copying|reproduction|use) (?:is )?(?:strictly )?prohibited", "prohibited", "reserved", 0.9),
        ("proprietary and confidential", "proprietary", "proprietary", 0.9),
        ("used with permission", "permission", "permission", 0.6),
        ("terms of (?:use|service)", "terms", "terms", 0.4),
        ("licen[sc]ed under (?:the )?(?:terms|conditions)", "licen", "licensed", 0.5),
        ("copyright(?: c)? (?:19|20)[0-9][0-9]", "copyright", "copyright", 0.6),
        ("all content is copyright(?:ed)?", "copyright", "copyright", 0.6),
    )
    yield from grants


def rules() -> list[dict]:
    """All rules, longest signature first inside a confidence; a rule's place is its priority."""
    found = [*_cc_rules(), *_gnu_rules(), *_named_rules(), *_text_rules()]
    found.sort(key=lambda r: (-r[3], -len(r[0])))
    return [{"regex": f" {x}(?= )", "keyword": k, "label": n, "trust": t} for x, k, n, t in found]


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _detections(text: Column, rule: Column) -> Column:
    """Word intervals ``start`` to before ``end`` of all matches of a rule; every word has one space before it."""
    gaps = F.transform(F.split(text, rule.getField("regex")), _spaces)
    widths = F.transform(F.regexp_extract_all(text, rule.getField("regex"), F.lit(0)), _spaces)
    none = F.array().cast(f"array<{SPAN}>")

    def add(acc: Column, gap: Column, width: Column) -> Column:
        start = acc.getField("at") + gap
        end = start + F.coalesce(width, F.lit(0))
        found = F.struct(start.alias("start"), end.alias("end"), *[rule.getField(c).alias(c) for c in ("place", "label", "trust")])
        grown = F.when(width.isNull(), acc.getField("out")).otherwise(F.concat(acc.getField("out"), F.array(found)))
        return F.struct(end.alias("at"), grown.alias("out"))

    both = F.zip_with(gaps, widths, lambda gap, width: F.struct(gap.alias("gap"), width.alias("width")))
    empty = F.struct(F.lit(0).alias("at"), none.alias("out"))
    return F.aggregate(both, empty, lambda acc, p: add(acc, p.getField("gap"), p.getField("width")), lambda acc: acc.getField("out"))


def _suppress(spans: Column) -> Column:
    """Without intervals inside one of higher priority.

    In order of start, longest first, all that may contain an interval come before it, and of
    those only the ones still open are compared: at most one a rule.
    """

    def order(a: Column, b: Column) -> Column:
        keys = [(a.getField("start"), b.getField("start")), (b.getField("end"), a.getField("end")), (a.getField("place"), b.getField("place"))]
        out = F.lit(0)
        for x, y in reversed(keys):
            out = F.when(x < y, -1).when(x > y, 1).otherwise(out)
        return out

    def step(acc: Column, d: Column) -> Column:
        alive = F.filter(acc.getField("open"), lambda o: o.getField("end") > d.getField("start"))
        inside = F.exists(alive, lambda o: (o.getField("end") >= d.getField("end")) & (o.getField("place") < d.getField("place")))
        kept = F.when(inside, acc.getField("kept")).otherwise(F.concat(acc.getField("kept"), F.array(d)))
        return F.struct(F.when(inside, alive).otherwise(F.concat(alive, F.array(d))).alias("open"), kept.alias("kept"))

    none = F.array().cast(f"array<{SPAN}>")
    start = F.struct(none.alias("open"), none.alias("kept"))
    return F.aggregate(F.array_sort(spans, order), start, step, lambda acc: acc.getField("kept"))


def license_scan(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``keep``, ``n_words, n_base, first_word, last_word, base_labels, labels, score, spans`` per row.

    Words are runs of ASCII letters and digits and of other characters past ASCII, in lower
    case. ``n_base`` counts the places of the base phrases, ``first_word`` and ``last_word``
    are the smallest and largest word they start at, null without any. ``spans`` lists what
    the rules find, in order of ``start``: words ``start`` to before ``end``, ``place`` of the
    rule (0 first), ``label`` and ``trust``; intervals inside one of an earlier rule are left
    out, those that only overlap stay. ``labels`` adds the labels of ``spans``; both are
    distinct, sorted and joined by commas. ``score`` is the highest trust of a detection, 1
    for a base phrase, 0 for none.

    A null text counts as empty: 0 words, empty labels and spans, score 0. Repeated rows are judged one
    by one. Columns not in ``keep`` are dropped, so they cannot clash; ``keep`` must not name
    an output column. An empty table gives no rows. Texts stay where they are, no shuffle.
    """
    kept = F.struct(*[F.col(c) for c in keep]) if keep else F.lit(1)
    # lower() differs from ASCII lower case in characters past ASCII only, which no rule has.
    plain = F.regexp_replace(F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    base = docs.select(kept.alias("kept"), F.trim(plain).alias("flat"))
    base = base.select("kept", F.when(F.col("flat") == "", " ").otherwise(F.concat(F.lit(" "), "flat", F.lit(" "))).alias("text"))
    text = F.col("text")
    places, firsts, lasts, labels = [], [], [], []
    for phrase, label in BASE:
        there = F.contains(text, F.lit(f" {phrase} "))
        places.append(F.when(there, F.regexp_count(text, F.lit(f" {phrase}(?= )"))).otherwise(0))
        first = F.instr(text, f" {phrase} ") - 1
        last = F.length(text) - F.instr(F.reverse(text), f" {phrase} "[::-1]) + 1 - len(phrase) - 2
        firsts.append(F.when(there, _spaces(F.substring(text, F.lit(1), first))))
        lasts.append(F.when(there, _spaces(F.substring(text, F.lit(1), last))))
        labels.append(F.when(there, F.lit(label)))
    table = rules()
    every = F.from_json(F.lit(json.dumps([r | {"place": i} for i, r in enumerate(table)])), f"array<{RULE}>")
    gate = "|".join(sorted({r["keyword"] for r in table}))
    # Patterns as literals are compiled once a task; only rules that match go on to their intervals.
    hits = F.array_compact(
        F.expr("array(" + ", ".join(f"if(contains(text, '{r['keyword']}') AND text RLIKE '{r['regex']}', {i}, null)" for i, r in enumerate(table)) + ")")
    )
    spans = F.flatten(F.transform("hits", lambda i: _detections(text, F.get(every, i))))
    none = F.array().cast(f"array<{SPAN}>")
    base = base.withColumn("hits", F.when(F.regexp_like(text, F.lit(gate)), hits))
    found = base.select(
        "kept",
        F.when(text == " ", 0).otherwise(_spaces(text) - 1).cast("long").alias("n_words"),
        sum(places).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"),
        F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base"),
        F.when(F.size("hits") > 0, _suppress(spans)).otherwise(none).alias("spans"),
    )
    both = F.array_union("base", F.col("spans.label"))
    score = F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max("spans.trust"), F.lit(0.0)))
    return found.select(
        *[F.col("kept").getField(c).alias(c) for c in keep],
        "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        score.alias("score"),
        "spans",
    )

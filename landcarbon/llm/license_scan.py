"""License scans: ordered signature rules over normalised words, gated by a keyword prefilter.

A text is reduced to its lower-case words with one blank between them, so that line breaks, comment signs and
punctuation inside a notice do not matter. One Aho-Corasick pass finds keywords; only rules whose keyword occurs run.
A detection that lies inside another one of the same or a higher priority is suppressed, as "apache license" is by
"apache license version 2". Null counts as an empty text, repeated rows are scanned one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from landcarbon.llm.common import map_arrow, word_list

# Phrases that always count, with their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Fixed values of the rules: license names by family, with the words that notices use for them.
VERSIONED = (
    ("gpl", "gnu general public licen[cs]e|gnu gpl|gpl", "gpl|general public", ("1", "2", "3")),
    ("lgpl", "gnu lesser general public licen[cs]e|gnu library general public licen[cs]e|lgpl", "lgpl|lesser general|library general", ("2", "2 1", "3")),
    ("agpl", "gnu affero general public licen[cs]e|agpl", "agpl|affero", ("1", "3")),
    ("gfdl", "gnu free documentation licen[cs]e|gfdl", "gfdl|free documentation", ("1 1", "1 2", "1 3")),
    ("mpl", "mozilla public licen[cs]e|mpl", "mozilla|mpl", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse public licen[cs]e|epl", "eclipse|epl", ("1 0", "2 0")),
    ("apache", "apache licen[cs]e|apache software licen[cs]e|apache", "apache", ("1 0", "1 1", "2 0")),
    ("cddl", "common development and distribution licen[cs]e|cddl", "cddl|common development", ("1 0", "1 1")),
    ("eupl", "european union public licen[cs]e|eupl", "eupl|european union public", ("1 0", "1 1", "1 2")),
    ("osl", "open software licen[cs]e|osl", "open software|osl", ("1 0", "1 1", "2 0", "2 1", "3 0")),
    ("afl", "academic free licen[cs]e|afl", "academic free|afl", ("1 1", "1 2", "2 0", "2 1", "3 0")),
    ("artistic", "artistic licen[cs]e", "artistic", ("1 0", "2 0")),
    ("cecill", "cecill", "cecill", ("1 0", "1 1", "2 0", "2 1")),
    ("lppl", "latex project public licen[cs]e|lppl", "lppl|latex project", ("1 0", "1 1", "1 2", "1 3")),
    ("odbl", "open database licen[cs]e|odbl", "open database|odbl", ("1 0",)),
    ("ofl", "sil open font licen[cs]e|ofl", "open font|ofl", ("1 0", "1 1")),
    ("bsl", "business source licen[cs]e|busl", "business source|busl", ("1 1",)),
    ("sspl", "server side public licen[cs]e|sspl", "server side public|sspl", ("1",)),
    ("psf", "python software foundation licen[cs]e|psf licen[cs]e", "python software|psf", ("2",)),
    ("zpl", "zope public licen[cs]e|zpl", "zope|zpl", ("1 1", "2 0", "2 1")),
)
PLAIN = (
    ("mit", "mit licen[cs]e|permission is hereby granted free of charge to any person obtaining a copy", "mit|permission is hereby"),
    ("bsd", "bsd licen[cs]e|bsd style licen[cs]e|redistribution and use in source and binary forms", "bsd|redistribution"),
    ("bsd-2-clause", "(?:2|two) clause bsd|bsd (?:2|two) clause|simplified bsd|freebsd licen[cs]e", "bsd|freebsd"),
    ("bsd-3-clause", "(?:3|three) clause bsd|bsd (?:3|three) clause|(?:new|revised|modified) bsd licen[cs]e", "bsd"),
    ("bsd-4-clause", "(?:4|four) clause bsd|bsd (?:4|four) clause|original bsd licen[cs]e", "bsd"),
    ("isc", "isc licen[cs]e", "isc"),
    ("zlib", "zlib licen[cs]e|zlib libpng licen[cs]e", "zlib"),
    ("unlicense", "the unlicense|this is free and unencumbered software", "unlicense|unencumbered"),
    ("cc0", "cc0|creative commons zero|cc zero", "cc0|creative commons|cc zero"),
    ("wtfpl", "wtfpl|do what the fuck you want to public licen[cs]e", "wtfpl|do what the"),
    ("boost", "boost software licen[cs]e", "boost"),
    ("public-domain", "(?:in|into|to) the public domain|public domain dedication", "public domain"),
    ("all-rights-reserved", "all rights reserved", "rights reserved"),
    ("proprietary", "proprietary and confidential|confidential and proprietary", "proprietary"),
    ("ms-pl", "microsoft public licen[cs]e|ms pl", "microsoft public|ms pl"),
    ("beerware", "the beer ware licen[cs]e", "beer ware"),
)
# Sentences that stand in license texts and notices themselves, each with its keyword.
NOTICES = (
    ("bsd-3-clause", "nor the names? of (?:its|any|other) contributors may be used to endorse or promote products", "nor the name"),
    ("bsd-3-clause", "names? of the (?:author|authors|copyright holder|copyright holders) may not be used to endorse or promote products", "name of the|names of the"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "all advertising"),
    ("isc", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted", "permission to use"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "this software is provided"),
    ("boost", "permission is hereby granted free of charge to any person or organi[sz]ation obtaining a copy of the software", "permission is hereby"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", "anyone is free"),
    ("x11", "(?:x11|x consortium) licen[cs]e", "x11|x consortium"),
    ("mit", "(?:dual )?licensed under (?:the terms of )?(?:the )?mit", "licensed under|dual licensed"),
    ("cc0", "creativecommons org publicdomain zero 1 0", "creativecommons"),
    ("public-domain", "creativecommons org (?:publicdomain mark 1 0|licenses publicdomain)", "creativecommons"),
    ("public-domain", "no copyright is claimed|has been dedicated to the public domain|waives? all copyright", "no copyright|has been dedicated|waive"),
    ("proprietary", "unauthori[sz]ed copying of (?:this|these) files? (?:via any medium )?is strictly prohibited", "unauthori"),
)
CC_PARTS = {"by": "attribution", "nc": "non ?commercial", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s?(?: works)?"}
CC_KINDS = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd")
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")


def _words(pattern: str) -> re.Pattern[bytes]:
    return re.compile(rb"(?<![^ ])(?:" + pattern.encode() + rb")(?![^ ])")


def _rules() -> list[tuple[int, str, float, list[str], re.Pattern[bytes]]]:
    """(priority, label, weight, keywords, pattern), the strongest first."""
    out = [(9, label, 1.0, [phrase], _words(phrase)) for phrase, label in PHRASES]
    for name, names, keys, versions in VERSIONED:
        keys = keys.split("|")
        full = "|".join(n for n in names.split("|") if "licen" in n)
        for version in versions:
            label, exact = f"{name}-{version.replace(' ', '.')}", version
            # 2 and 2.0 are the same version.
            number = f"(?:{exact}|{version[0]})" if version.endswith(" 0") else exact if " " in exact else f"{exact}(?: 0)?"
            numbered = f"(?:{names}) (?:version |v )?v?{number}"
            published = f"(?:{full}) as published by the free software foundation(?: inc)? (?:either )?version {number}(?: of the licen[cs]e)?"
            out.append((8, f"{label}-or-later", 0.95, keys, _words(f"{numbered}(?: of the licen[cs]e)? (?:or (?:at your option )?(?:any )?(?:later|newer)(?: version)?|and later|plus)")))
            out.append((8, f"{label}-only", 0.95, keys, _words(f"{numbered} only")))
            if "gnu" in full:
                out.append((8, f"{label}-or-later", 0.95, keys, _words(f"{published} or at your option any later version")))
                out.append((7, label, 0.9, keys, _words(published)))
            out.append((7, label, 0.9, ["spdx"], _words(f"spdx licen[cs]e identifier {name} {number}(?! 0| or later| only)")))
            out.append((6, label, 0.8, keys, _words(f"(?:{names}) (?:version |v )v?{number}")))
            out.append((5, label, 0.7, keys, _words(f"(?:{names.split('|')[-1]}) ?v?{number if ' ' not in exact else exact}")))
            if full:
                out.append((6, label, 0.8, keys, _words(f"(?:{full}) v?{number if ' ' not in exact else exact}")))
        out.append((2, name, 0.4, keys, _words("|".join(n for n in names.split("|") if " " in n) or names)))
    for kind in CC_KINDS:
        parts = kind.split()
        spoken = " ".join(CC_PARTS[p] for p in parts)
        label = "cc-" + kind.replace(" ", "-")
        for version in CC_VERSIONS:
            full = f"{label}-{version.replace(' ', '.')}"
            out.append((8, full, 0.95, ["cc"], _words(f"cc {kind} {version}")))
            out.append((8, full, 0.95, ["creative commons"], _words(f"creative commons {spoken}(?: (?:{version} (?:international|unported|generic)|{version})| licen[cs]e (?:version )?{version})")))
            out.append((8, full, 0.95, ["creativecommons"], _words(f"creativecommons org licenses {kind} {version}")))
        out.append((4, label, 0.7, ["creative commons"], _words(f"creative commons {spoken}(?: licen[cs]e)?")))
        out.append((4, label, 0.7, ["cc"], _words(f"cc {kind}")))
    for label, pattern, keys in PLAIN:
        out.append((7, label, 0.9, ["spdx"], _words(f"spdx licen[cs]e identifier {label.replace('-', ' ')}")))
        out.append((3, label, 0.6, keys.split("|"), _words(pattern)))
    out += [(4, label, 0.8, keys.split("|"), _words(pattern)) for label, pattern, keys in NOTICES]
    return sorted(out, key=lambda r: -r[0])


def _suppress(found: list[tuple[int, int, int, str, float]]) -> list[tuple[int, int, int, str, float]]:
    """Detections (start, end, priority, label, weight) that lie in no other one of their priority or a higher one."""
    found = sorted(set(found), key=lambda f: (f[0], -f[1], -f[2], f[3]))
    reach: dict[int, int] = {}
    kept = []
    for f in found:
        if not any(end >= f[1] for priority, end in reach.items() if priority >= f[2]):
            kept.append(f)
        reach[f[2]] = max(reach.get(f[2], -1), f[1])
    return kept


def licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections) of every text.

    ``detections`` are (label, start, end) in words, end exclusive, after suppression. ``score`` is the weight of the
    strongest detection, 0 where there is none.
    """
    schema = (
        f"doc_id {dict(docs.dtypes)[id_col]}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, detections array<struct<label:string,start:long,end:long>>"
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        rules = _rules()
        finder = ahocorasick.Automaton()
        by_key: dict[str, list[int]] = {}
        for i, rule in enumerate(rules):
            for key in rule[3]:
                by_key.setdefault(key, []).append(i)
        for key in by_key:
            finder.add_word(f" {key}", key)
        finder.make_automaton()
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                words = word_list(text)
                line = b" ".join(words)
                keys = {key for _, key in finder.iter(" " + line.decode("latin-1"))}
                rows.append((len(words), *_detect(line, sorted({i for k in keys for i in by_key[k]}), rules)))
            columns = list(zip(*rows)) or [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))]
            names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    return map_arrow(docs.select(id_col, text_col), scan, schema)


def _detect(line: bytes, active: list[int], rules: list) -> tuple:
    """Places of the phrases that always count, and what is left of all detections after suppression."""
    starts, base_labels = [], set()
    found = []
    for i in active:
        priority, label, weight, _, pattern = rules[i]
        for m in pattern.finditer(line):
            found.append((m.start(), m.end(), priority, label, weight))
            if priority == 9:
                starts.append(m.start())
                base_labels.add(label)
    kept = _suppress(found)
    at = _word_numbers(line, {x for f in kept for x in f[:2]} | set(starts))
    places = [at[s] for s in starts]
    labels = base_labels | {f[3] for f in kept}
    spans = [{"label": f[3], "start": at[f[0]], "end": at[f[1]] + 1} for f in kept]
    return (
        len(starts),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(base_labels)),
        ",".join(sorted(labels)),
        max((f[4] for f in kept), default=0.0),
        spans,
    )


def _word_numbers(line: bytes, places: set[int]) -> dict[int, int]:
    """Number of the word at each byte position; the position after a word gets that word's number."""
    out, last, count = {}, 0, 0
    for place in sorted(places):
        count += line.count(b" ", last, place)
        out[place], last = count, place
    return out

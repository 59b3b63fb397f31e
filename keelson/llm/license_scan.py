"""License scans by ordered signature rules.

A text is brought to words; every rule is a regular expression over words that names one
keyword each match must hold. The keywords found in a text gate the rules that run on it.
Detections are taken in order of priority, longer ones first, and a detection that lies inside
one already taken is suppressed."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk

# The phrases every scan reports, with their labels and keywords.
BASE = [("cc by", "cc-by", "cc"), ("general public license", "gpl", "general"), ("all rights reserved", "reserved", "rights")]

# Label, keyword and words of well-known licenses. Versions are words of digits.
FAMILIES = [
    ("apache-1.1", "apache", "apache (?:software )?licen[sc]e (?:version )?1 1"),
    ("apache-2.0", "apache", "apache (?:software )?licen[sc]e (?:version )?2(?: 0)?"),
    ("apache-2.0", "apache", "apache 2 0"),
    ("mit", "mit", "mit"),
    ("mit", "expat", "expat"),
    ("bsd-2-clause", "bsd", "(?:2 clause|simplified|freebsd) bsd"),
    ("bsd-2-clause", "bsd", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(?:3 clause|new|revised|modified) bsd"),
    ("bsd-3-clause", "bsd", "bsd 3 clause"),
    ("bsd", "bsd", "bsd"),
    ("gpl-1.0", "general", "(?:gnu )?general public licen[sc]e (?:version |v)?1(?: 0)?"),
    ("gpl-2.0", "general", "(?:gnu )?general public licen[sc]e (?:version |v)?2(?: 0)?"),
    ("gpl-3.0", "general", "(?:gnu )?general public licen[sc]e (?:version |v)?3(?: 0)?"),
    ("gpl-2.0", "gplv2", "(?:gnu )?gplv2"),
    ("gpl-3.0", "gplv3", "(?:gnu )?gplv3"),
    ("gpl-2.0", "gpl", "(?:gnu )?gpl (?:version |v )?2(?: 0)?"),
    ("gpl-3.0", "gpl", "(?:gnu )?gpl (?:version |v )?3(?: 0)?"),
    ("gpl", "gpl", "(?:gnu )?gpl"),
    ("gpl", "general", "gnu general public licen[sc]e"),
    ("lgpl-2.0", "lesser", "(?:gnu )?lesser general public licen[sc]e (?:version |v)?2(?: 0)?"),
    ("lgpl-2.1", "lesser", "(?:gnu )?lesser general public licen[sc]e (?:version |v)?2 1"),
    ("lgpl-3.0", "lesser", "(?:gnu )?lesser general public licen[sc]e (?:version |v)?3(?: 0)?"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public licen[sc]e"),
    ("agpl-3.0", "affero", "(?:gnu )?affero general public licen[sc]e (?:version |v)?3(?: 0)?"),
    ("agpl", "affero", "(?:gnu )?affero general public licen[sc]e"),
    ("agpl-3.0", "agpl", "(?:gnu )?agpl (?:version |v )?3(?: 0)?"),
    ("gfdl", "documentation", "(?:gnu )?free documentation licen[sc]e"),
    ("mpl-1.1", "mozilla", "mozilla public licen[sc]e (?:version )?1 1"),
    ("mpl-2.0", "mozilla", "mozilla public licen[sc]e (?:version )?2(?: 0)?"),
    ("mpl", "mozilla", "mozilla public licen[sc]e"),
    ("mpl-2.0", "mpl", "mpl 2 0"),
    ("epl-1.0", "eclipse", "eclipse public licen[sc]e (?:version )?1(?: 0)?"),
    ("epl-2.0", "eclipse", "eclipse public licen[sc]e (?:version )?2(?: 0)?"),
    ("epl", "eclipse", "eclipse public licen[sc]e"),
    ("cddl", "cddl", "cddl"),
    ("cddl", "distribution", "common development and distribution licen[sc]e"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?"),
    ("cc0-1.0", "universal", "creative commons (?:zero|0) 1 0 universal"),
    ("public-domain", "domain", "public domain"),
    ("unlicense", "unlicense", "unlicense"),
    ("artistic-2.0", "artistic", "artistic licen[sc]e (?:version )?2(?: 0)?"),
    ("artistic-1.0", "artistic", "artistic licen[sc]e (?:version )?1(?: 0)?"),
    ("isc", "isc", "isc"),
    ("zlib", "zlib", "zlib(?: libpng)?"),
    ("bsl-1.0", "boost", "boost software licen[sc]e"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("ofl-1.1", "sil", "sil open font licen[sc]e(?: version)?(?: 1 1)?"),
    ("eupl-1.2", "eupl", "eupl(?: v?1 2)?"),
    ("ms-pl", "microsoft", "microsoft public licen[sc]e"),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[sc]e"),
    ("psf-2.0", "python", "python software foundation licen[sc]e"),
    ("postgresql", "postgresql", "postgresql"),
    ("openssl", "openssl", "openssl"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)?"),
    ("odbl-1.0", "odbl", "odbl"),
    ("odbl-1.0", "database", "open database licen[sc]e"),
    ("cecill", "cecill", "cecill"),
    ("sspl-1.0", "server", "server side public licen[sc]e"),
    ("elastic-2.0", "elastic", "elastic licen[sc]e 2 0"),
    ("business-source", "business", "business source licen[sc]e(?: 1 1)?"),
]
CC_TERMS = ["by nc sa", "by nc nd", "by nc", "by sa", "by nd", "by"]
CC_LONG = {"by": "attribution", "nc": "non ?commercial", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s?(?: works)?"}
CC_VERSIONS = ["4 0", "3 0", "2 5", "2 0", "1 0", ""]


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    keyword: str
    pattern: re.Pattern
    weight: float


def signature_rules() -> list[Rule]:
    """All rules, in order: tags, grants, titles, then bare names of the families above and of the
    Creative Commons terms in all versions."""
    names = list(FAMILIES)
    for terms in CC_TERMS:
        for version in CC_VERSIONS:
            label = "-".join(["cc", *terms.split(), *([version.replace(" ", ".")] if version else [])])
            tail = f" {version}" if version else ""
            long = " ".join(CC_LONG[t] for t in terms.split())
            names.append((label, "cc", f"cc {terms}{tail}"))
            names.append((label, "creative", f"creative commons {long}(?: international| unported| generic)?{tail}"))
    grant = "(?:licen[sc]ed|released|distributed|published|available|provided) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?:an? )?"
    forms = [
        (0, "spdx licen[sc]e identifier (?:{})(?: only| or later)?", 0.99),
        (1, grant + "(?:{})(?: licen[sc]e)?(?: or (?:any later|later) version)?", 0.9),
        (2, "(?:the )?(?:{}) licen[sc]e", 0.6),
        (3, "{}", 0.3),
    ]
    rules = []
    for priority, form, weight in forms:
        for label, keyword, words in names:
            if priority == 3 and words == keyword and words in ("mit", "bsd", "isc", "expat", "unlicense", "openssl", "postgresql"):
                continue        # too short to mean a license by themselves
            rules.append(Rule(priority, label, keyword, re.compile(f"(?<= )(?:{form.format(words)})(?= )".encode()), weight))
    extra = [
        (1, "proprietary", "proprietary", "proprietary and confidential"),
        (1, "permissive-grant", "hereby", "permission is hereby granted free of charge to any person"),
        (1, "warranty-disclaimer", "warranty", "without (?:any )?warranty(?: of any kind)?"),
        (2, "copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}"),
        (2, "reserved", "rights", "all rights reserved"),
    ]
    return rules + [Rule(p, label, k, re.compile(f"(?<= )(?:{w})(?= )".encode()), 0.5) for p, label, k, w in extra]


def uncontained(seen: list[tuple[int, int, int, int, str, float]]) -> list[tuple[int, int, str, float]]:
    """(start, end, label, weight) of the detections, best first, that lie in none taken before them.

    ``reach[i]`` holds, in the manner of a binary indexed tree over the starts, the farthest end of
    the taken detections that begin no later: one look tells whether any of them contains a new one."""
    starts = sorted({s for _, _, s, _, _, _ in seen})
    place = {s: i + 1 for i, s in enumerate(starts)}
    reach = [-1] * (len(starts) + 1)
    taken = []
    for _, _, start, end, label, weight in seen:
        i, farthest = place[start], -1
        while i:
            farthest = max(farthest, reach[i])
            i &= i - 1
        if farthest >= end:
            continue
        taken.append((start, end, label, weight))
        i = place[start]
        while i < len(reach):
            reach[i] = max(reach[i], end)
            i += i & -i
    return taken


class Detector:
    def __init__(self) -> None:
        self.by_keyword: dict[bytes, list[Rule]] = {}
        for rule in signature_rules():
            self.by_keyword.setdefault(rule.keyword.encode(), []).append(rule)
        for _, _, keyword in BASE:
            self.by_keyword.setdefault(keyword.encode(), [])
        self.hasher = tk.Hasher(seed=41, fold=True)
        self.words = sorted(self.by_keyword)
        chunk = next(tk.chunks(pa.array([b" ".join(self.words)], pa.binary())))
        hashes = self.hasher.words(chunk, tk.words(chunk, tk.ALNUM))
        order = np.argsort(hashes)
        self.known, self.names = hashes[order], [self.words[i] for i in order]
        self.rough = np.zeros(1 << 16, bool)
        self.rough[(self.known >> np.uint64(48)).astype(np.int64)] = True
        self.table = bytes(b if tk.ALNUM[b] else 0x20 for b in tk.LOWER)

    def rows(self, chunk: tk.Chunk) -> Iterator[tuple[int, list[tuple[int, int, str]], list[tuple[int, int, str, float]]]]:
        """(n_words, base places, detections) of each row."""
        found = tk.words(chunk, tk.ALNUM)
        hashes = self.hasher.words(chunk, found)
        at = np.flatnonzero(self.rough[(hashes >> np.uint64(48)).astype(np.int64)])
        near = np.minimum(np.searchsorted(self.known, hashes[at]), len(self.known) - 1)
        hit = self.known[near] == hashes[at]
        gates: dict[int, set[bytes]] = {}
        for r, k in zip((np.searchsorted(found.first, at[hit], "right") - 1).tolist(), near[hit].tolist(), strict=True):
            gates.setdefault(r, set()).add(self.names[k])
        for r, n in enumerate(np.diff(found.first).tolist()):
            yield (n, *self.scan(chunk.text(r), gates[r])) if r in gates else (n, [], [])

    def scan(self, text: bytes, keywords: set[bytes]) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str, float]]]:
        line = b" " + b" ".join(text.translate(self.table).split()) + b" "
        blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
        word = lambda at: int(np.searchsorted(blanks, at)) - 1
        base = []
        for phrase, label, keyword in BASE:
            if keyword.encode() in keywords:
                needle, at = f" {phrase} ".encode(), -1
                while (at := line.find(needle, at + 1)) >= 0:
                    start = word(at + 1)
                    base.append((start, start + phrase.count(" ") + 1, label))
        seen = []
        for keyword in sorted(keywords):
            for rule in self.by_keyword[keyword]:
                for m in rule.pattern.finditer(line):
                    start = word(m.start())
                    seen.append((rule.priority, start - (end := start + m.group().count(b" ") + 1), start, end, rule.label, rule.weight))
        return sorted(base), sorted(uncontained(sorted(seen)))


def license_report(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and the struct ``license``: n_words, base and detections (start and
    end in words, label), labels (distinct, sorted) and score (0 without a detection, otherwise
    one minus the product of what each detection leaves open).

    Words are runs of ASCII letters, digits and all non-ASCII characters, A-Z lower-cased. Null
    and empty texts have no words and no detections. Each row is scanned by itself, so repeated
    rows get equal results. Of equal detections (same rule priority, place and length) the one
    with the smaller label stays. A column called ``license`` is replaced. An empty table gives
    an empty result."""
    docs = docs.drop("license")
    place = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("label", T.StringType())]))
    report = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("base", place), T.StructField("detections", place),
                           T.StructField("labels", T.ArrayType(T.StringType())), T.StructField("score", T.DoubleType())])
    at, names = docs.columns.index(text), docs.columns
    arrow_place = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())]))
    kind = pa.struct([("n_words", pa.int64()), ("base", arrow_place), ("detections", arrow_place), ("labels", pa.list_(pa.string())), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = Detector()
        shown = lambda xs: [{"start": x[0], "end": x[1], "label": x[2]} for x in xs]
        for batch in batches:
            out = []
            for chunk in tk.chunks(batch.column(at)):
                for n, base, taken in detector.rows(chunk):
                    left = 1.0
                    for weight in sorted([x[3] for x in taken] + [0.3] * len(base)):
                        left *= 1 - weight
                    out.append({"n_words": n, "base": shown(base), "detections": shown(taken),
                                "labels": sorted({x[2] for x in base} | {x[2] for x in taken}), "score": 1 - left})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], [*names, "license"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("license", report)]))

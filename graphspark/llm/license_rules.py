"""Operator 8: license scans by sentence rules.

A text is cut into sentences; each is normalised and looked up among known licence sentences, which gives a
sequence of sentences with places. The known ones are cut by the same rule, so that one written with ``:``, ``;`` or a
blank line inside is a row of parts. Licence rules are ordered lists of identifiers; a rule matches where the parts of
its sentences follow one another in the text with at most ``MAX_GAP`` other sentences in between (``GAPS`` has the
rules that allow more). Rules with more parts are tried first and a sentence serves one match only. Sentences with free
words that name a licence in a known form (short grants, SPDX tags, licence fields: ``license_names``) are found besides,
where no rule matches.

Null, empty and licence-free texts give no rows. A notice that stands several times is found each time. Repeated
rows give repeated rows. Sentences are found at any length of text and over line breaks. Extra columns don't
matter.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import product

import pandas as pd
from pyspark.sql import DataFrame

from graphspark.llm.common import text_batches
from graphspark.llm.license_names import named

MAX_GAP = 1

#: Room for a name in a known sentence that stands among other lines without a full stop.
NAME_CHARS = 1_000

#: Known licence sentences by identifier; several spellings of one are listed. Only a-z and 0-9 and what
#: ends a sentence count; ``*`` stands for the words of a name.
SENTENCES = {
    "apache2_short": "licensed under the apache license version 2 0",
    "apache2_grant": "licensed under the apache license version 2 0 the license",
    "apache2_use": "you may not use this file except in compliance with the license",
    "apache2_copy": tuple(f"you may obtain a copy of the license at{gap}{http} www apache org licenses license 2 0"
                          for gap in ("\n\n", " ") for http in ("http", "https")),
    "apache2_basis": "unless required by applicable law or agreed to in writing software distributed under the license "
                     "is distributed on an as is basis without warranties or conditions of any kind either express or "
                     "implied",
    "apache2_see": "see the license for the specific language governing permissions and limitations under the license",
    "mit_short": "released under the mit license",
    "mit_licensed": "licensed under the mit license",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software without restriction including "
                 "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                 "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                 "the following conditions",
    "mit_notice": ("the above copyright notice and this permission notice shall be included in all copies or "
                   "substantial portions of the software",
                   "the above copyright notice and this permission notice including the next paragraph shall be "
                   "included in all copies or substantial portions of the software"),
    "mit_as_is": "the software is provided as is without warranty of any kind express or implied including but not "
                 "limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit_liable": "in no event shall * be liable for any claim damages or other liability whether in an action of "
                  "contract tort or otherwise arising from out of or in connection with the software or the use or "
                  "other dealings in the software",
    "gpl3_short": "this work is licensed under the gnu general public license version 3",
    "gpl3_licensed": "licensed under the gnu general public license version 3",
    "gpl_free": tuple(f"this {what} is free software" for what in ("program", "library", "file")),
    **{f"{name}{n}_terms": tuple(
        f"you can redistribute it and or modify it under the terms of the gnu {kind} general public license as "
        f"published by the free software foundation{a} either version {n.replace('_', ' ')} of the license or at your "
        "option any later version" for a in ("", ";"))
       for name, kind, versions in (("gpl", "", ("2", "3")), ("lgpl", "lesser", ("2_1", "3")), ("agpl", "affero", ("3",)))
       for n in versions},
    **{f"{name}{n}_only": tuple(
        f"you can redistribute it and or modify it under the terms of the gnu {kind} general public license {terms}"
        for v in [n.replace("_", " ")] for terms in (
            f"version {v} as published by the free software foundation",
            f"version {v} only as published by the free software foundation",
            f"as published by the free software foundation version {v} of the license",
            f"as published by the free software foundation; version {v} of the license",
            f"as published by the free software foundation; version {v}"))
       for name, kind, versions in (("gpl", "", ("2", "3")), ("lgpl", "lesser", ("2_1", "3")), ("agpl", "affero", ("3",)))
       for n in versions},
    "gpl_hope": tuple(f"this {what} is distributed in the hope that it will be useful but without any warranty{a} "
                      "without even the implied warranty of merchantability or fitness for a particular purpose"
                      for what in ("program", "library", "file") for a in ("", ";")),
    "cc_by_nc4_short": "licensed under cc by nc 4 0",
    "cc_by4_short": "licensed under cc by 4 0",
    "cc_by_sa4_short": "licensed under cc by sa 4 0",
    "cc0_short": "released under cc0 1 0",
    "bsd_redistribute": "redistribution and use in source and binary forms with or without modification are permitted "
                        "provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and "
                  "the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and "
                  "the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_names": "neither the name of * may be used to endorse or promote products derived from this software without "
                 "specific prior written permission",
    "bsd_as_is": "this software is provided by * as is and any express or implied warranties including but not limited "
                 "to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd_liable": "in no event shall * be liable for any direct indirect incidental special exemplary or consequential "
                  "damages including but not limited to procurement of substitute goods or services; loss of use data or "
                  "profits; or business interruption however caused and on any theory of liability whether in contract "
                  "strict liability or tort including negligence or otherwise arising in any way out of the use of this "
                  "software even if advised of the possibility of such damage",
    "mpl2_subject": "this source code form is subject to the terms of the mozilla public license v. 2 0",
    "mpl2_copy": tuple(f"if a copy of the mpl was not distributed with this file you can obtain one at {http} mozilla "
                       "org mpl 2 0" for http in ("http", "https")),
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
                 "hereby granted provided that the above copyright notice and this permission notice appear in all "
                 "copies",
    "isc_as_is": "the software is provided as is and the author disclaims all warranties with regard to this software "
                 "including all implied warranties of merchantability and fitness",
    "unlicense_free": "this is free and unencumbered software released into the public domain",
    "unlicense_anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in "
                        "source code form or as a compiled binary for any purpose commercial or non commercial and by "
                        "any means",
}

#: Licence of each ordered rule.
RULES = (
    ("Apache-2.0", ("apache2_grant", "apache2_use", "apache2_copy", "apache2_basis", "apache2_see")),
    ("Apache-2.0", ("apache2_grant", "apache2_use", "apache2_copy", "apache2_basis")),
    ("Apache-2.0", ("apache2_grant", "apache2_use")),
    ("Apache-2.0", ("apache2_short",)),
    ("Apache-2.0", ("apache2_grant",)),
    ("MIT", ("mit_grant", "mit_notice", "mit_as_is", "mit_liable")),
    ("MIT", ("mit_grant", "mit_notice", "mit_as_is")),
    ("MIT", ("mit_grant", "mit_notice")),
    ("MIT", ("mit_short",)),
    ("MIT", ("mit_licensed",)),
    *((licence, keys) for licence, terms in (
        ("GPL-3.0-or-later", "gpl3_terms"), ("GPL-2.0-or-later", "gpl2_terms"), ("LGPL-3.0-or-later", "lgpl3_terms"),
        ("LGPL-2.1-or-later", "lgpl2_1_terms"), ("AGPL-3.0-or-later", "agpl3_terms"),
        ("GPL-3.0-only", "gpl3_only"), ("GPL-2.0-only", "gpl2_only"), ("LGPL-3.0-only", "lgpl3_only"),
        ("LGPL-2.1-only", "lgpl2_1_only"), ("AGPL-3.0-only", "agpl3_only"))
      for keys in (("gpl_free", terms, "gpl_hope"), ("gpl_free", terms), (terms, "gpl_hope"), (terms,))),
    ("GPL-3.0-only", ("gpl3_short",)),
    ("GPL-3.0-only", ("gpl3_licensed",)),
    ("CC-BY-NC-4.0", ("cc_by_nc4_short",)),
    ("CC-BY-4.0", ("cc_by4_short",)),
    ("CC-BY-SA-4.0", ("cc_by_sa4_short",)),
    ("CC0-1.0", ("cc0_short",)),
    ("BSD-3-Clause", ("bsd_redistribute", "bsd_source", "bsd_binary", "bsd_names", "bsd_as_is", "bsd_liable")),
    ("BSD-2-Clause", ("bsd_redistribute", "bsd_source", "bsd_binary", "bsd_as_is", "bsd_liable")),
    ("BSD", ("bsd_redistribute", "bsd_as_is")),
    ("BSD", ("bsd_redistribute",)),
    ("MPL-2.0", ("mpl2_subject", "mpl2_copy")),
    ("MPL-2.0", ("mpl2_subject",)),
    ("ISC", ("isc_grant", "isc_as_is")),
    ("Unlicense", ("unlicense_free", "unlicense_anyone")),
    ("Unlicense", ("unlicense_free",)),
)

#: Other sentences that a rule allows between two of its own, if not ``MAX_GAP``: the clauses of older BSD licences,
#: their numbers alone being sentences.
GAPS = {("bsd_redistribute", "bsd_as_is"): 12}

#: A sentence ends at . ! ? : ; before white space or the end, or before a blank line or one with the mark of a comment
#: alone; not inside ``2.0``.
_END = re.compile(r"[.!?:;]+(?=\s|$)|\n(?=[^\w\n]*\n)")
_NOT_WORD = re.compile(r"[^a-z0-9]+")
#: What stands before a sentence: white space, whole lines without a word.
_LEAD = re.compile(r"(?:[^\w\n]*\n)*\s*")
#: The number or letter of a list item.
_ITEM = re.compile(r"[^A-Za-z0-9(]*\(?(?:[0-9]{1,2}|[A-Za-z])[.)]\s")


def normalise(sentence: str) -> str:
    """Lower case, anything but a-z and 0-9 as one blank, none at the ends; the number of a list item goes."""
    item = _ITEM.match(sentence)
    return _NOT_WORD.sub(" ", sentence[item.end() if item else 0:].lower()).strip()


def sentences_of(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence; one without a word is none."""
    cuts = [0, *(m.end() for m in _END.finditer(text)), len(text)]
    return [(a, b) for a, b in zip(cuts[:-1], cuts[1:]) if re.search(r"\w", text[a:b])]


class Scanner:
    """Known sentences and rules, ready for whole texts."""

    def __init__(self, sentences: dict = SENTENCES, rules=RULES):
        def parts(spelling: str) -> tuple[str, ...]:
            cut = (spelling[a:b].split("*") for a, b in sentences_of(spelling))
            return tuple(" * ".join(map(normalise, x)) for x in cut)

        spelled = {k: [parts(x) for x in ([v] if isinstance(v, str) else v)] for k, v in sentences.items()}
        ready = [(licence, keys, sum(way, ()), GAPS.get(keys, MAX_GAP))
                 for licence, keys in rules for way in product(*(spelled[k] for k in keys))]
        self.rules = sorted(ready, key=lambda r: -len(r[2]))
        known = {part for *_, row, _ in self.rules for part in row}
        self.known = {part for part in known if "*" not in part}
        self.named = [(part, *part.split("*")) for part in sorted(known - self.known)]
        self.first = {part.split()[0] for part in known}
        self.longest = max(len(part) for part in known)
        # only texts with the opening words of a rule are cut into sentences
        opening = {" ".join(row[0].split("*")[0].split()[:3]) for *_, row, _ in self.rules}
        self.opening = re.compile("|".join(r"[^a-z0-9]+".join(map(re.escape, o.split())) for o in sorted(opening)), re.I)

    def known_as(self, text: str) -> str | None:
        """The known sentence that this one, normalised, is."""
        if text in self.known:
            return text
        return next((part for part, head, tail in self.named
                     if text.startswith(head) and text.endswith(tail) and len(text) > len(head) + len(tail)), None)

    def sequence(self, text: str) -> list[tuple[int, str, int, int]]:
        """(number of the sentence, known sentence, start, end) of the known sentences.

        A sentence that runs on over line breaks is known whole; a line or some lines of it are known by themselves
        too, as below a heading without a full stop."""
        out, number = [], 0

        def add(key: str, a: int, b: int) -> None:
            out.append((number, key, _LEAD.match(text, a, b).end(), a + len(text[a:b].rstrip())))

        for start, end in sentences_of(text):
            whole = self.known_as(normalise(text[start:end]))
            if whole or "\n" not in text[start:end]:
                if whole:
                    add(whole, start, end)
                number += 1
                continue
            cuts, i, other = [start, *(start + i + 1 for i, c in enumerate(text[start:end]) if c == "\n"), end], 0, False
            while i < len(cuts) - 1:
                stop, best, line = i + 1, None, normalise(text[cuts[i]:cuts[i + 1]])
                if line and line.split()[0] in self.first:
                    for k in range(i + 1, len(cuts)):  # the longest run of lines that is known
                        line = normalise(text[cuts[i]:cuts[k]])
                        if key := self.known_as(line):
                            stop, best = k, key
                        if len(line) > self.longest + NAME_CHARS:
                            break
                if best:
                    number += other
                    add(best, cuts[i], cuts[stop])
                    number += 1
                other = not best and (other or bool(re.search(r"\w", text[cuts[i]:cuts[stop]])))  # lines around are one
                i = stop
            number += other
        return out

    def scan(self, text: str | None) -> list[tuple[str, str, int, int]]:
        """(licence, identifiers, start, end) of each match, by place."""
        if not text:
            return []
        found = self.matches(text) if self.opening.search(text) else []
        taken = sorted((a, b) for *_, a, b in found)
        starts = [a for a, _ in taken]
        for name in named(text):
            before = bisect_left(starts, name[3]) - 1  # matches don't overlap, so the last one that starts before its end
            if before < 0 or taken[before][1] <= name[2]:
                found.append(name)
        return sorted(found, key=lambda f: f[2:])

    def matches(self, text: str) -> list[tuple[str, str, int, int]]:
        """(licence, identifiers, start, end) of each match of a rule, by place."""
        seen, used, found, places = self.sequence(text), set(), [], {}
        for i, (_, key, _, _) in enumerate(seen):
            places.setdefault(key, []).append(i)
        for licence, keys, row, gap in self.rules:
            for i in places.get(row[0], []):
                at = [] if i in used else [i]
                while at and len(at) < len(row):  # the next sentence of the rule, near enough
                    j = last = at[-1]
                    after = None
                    while after is None and (j := j + 1) < len(seen) and seen[j][0] - seen[last][0] <= 1 + gap:
                        after = j if seen[j][1] == row[len(at)] and j not in used else None
                    at = [] if after is None else [*at, after]
                if at:
                    used |= set(at)
                    found.append((licence, "+".join(keys), seen[at[0]][2], seen[at[-1]][3]))
        return sorted(found, key=lambda f: f[2])


def scan(docs: DataFrame, sentences: dict = SENTENCES, rules=RULES) -> DataFrame:
    """doc_id, license, rule, start, end (code points) of every match; no shuffle, texts read once."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(sentences, rules)
        for pdf in batches:
            rows = [(d, *m) for d, t in zip(pdf["doc_id"], pdf["text"]) for m in scanner.scan(t)]
            out = pd.DataFrame(rows, columns=["doc_id", "license", "rule", "start", "end"])
            yield out.astype({"doc_id": "Int64", "start": "int64", "end": "int64"})

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInPandas(
        run, "doc_id long, license string, rule string, start long, end long")

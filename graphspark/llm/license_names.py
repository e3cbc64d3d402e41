"""Licences that a sentence names: the part of operator 8 for sentences with free words.

Three classes of sentences are known by their form. A grant has a verb of granting, then the names of one or more
licences (``distributed under the terms of the GPL v2 or later``, ``licensed under the Apache License 2.0 and MIT``).
A tag is a line ``SPDX-License-Identifier: MIT OR Apache-2.0``. A field is a line ``License: BSD 3-Clause``. A name
alone, as in prose about a licence, is none of these.
"""

from __future__ import annotations

import re

#: What may stand between the words of a name: anything but letters and digits that doesn't end a sentence. A run of
#: it is taken whole (possessive), so a long one is read once.
_GAP = r"(?:[^A-Za-z0-9.!?;:]|[.!?;:](?!\s|$))"

#: Licence, name, versions. In a name a blank is any gap between words and ``(a|b)`` are alternatives.
#: ``#`` in a licence stands for the version found, of which one without ``.0`` gets it; a name with versions but none
#: found is the family alone.
NAMES = (
    ("Apache-#", "apache( software)?( license)?", "1.0 1.1 2.0"),
    ("MIT", "(mit|expat)( x11)?", ""),
    ("BSD-2-Clause", "(bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)", ""),
    ("BSD-3-Clause", "(bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)", ""),
    ("0BSD", "(0bsd|bsd zero clause|zero clause bsd)", ""),
    ("BSD", "bsd( style)?", ""),
    ("LGPL-#", "(gnu )?(lgpl|lesser general public license|library general public license|lesser gpl)", "2.0 2.1 3.0"),
    ("AGPL-#", "(gnu )?(agpl|affero general public license|affero gpl)", "3.0"),
    ("GPL-#", "(gnu )?(gpl|general public license)", "1.0 2.0 3.0"),
    ("MPL-#", "(mozilla public license|mpl)", "1.0 1.1 2.0"),
    ("EPL-#", "(eclipse public license|epl)", "1.0 2.0"),
    ("EUPL-#", "(european union public licen[cs]e|eupl)", "1.0 1.1 1.2"),
    ("CDDL-#", "(common development and distribution license|cddl)", "1.0 1.1"),
    ("BSL-#", "boost software license", "1.0"),
    ("Artistic-#", "artistic license", "1.0 2.0"),
    ("Zlib", "zlib( libpng)?", ""),
    ("ISC", "isc", ""),
    ("Unlicense", "unlicense", ""),
    ("WTFPL", "wtfpl", ""),
    ("CC0-#", "(creative commons zero|creative commons cc0|cc0|cc zero)", "1.0"),
    ("CC-BY-NC-SA-#", "(cc by nc sa|creative commons attribution non ?commercial share ?alike)", "2.0 2.5 3.0 4.0"),
    ("CC-BY-NC-ND-#", "(cc by nc nd|creative commons attribution non ?commercial no ?deriv(ative)?s)", "2.0 2.5 3.0 4.0"),
    ("CC-BY-NC-#", "(cc by nc|creative commons attribution non ?commercial)", "2.0 2.5 3.0 4.0"),
    ("CC-BY-SA-#", "(cc by sa|creative commons attribution share ?alike)", "2.0 2.5 3.0 4.0"),
    ("CC-BY-ND-#", "(cc by nd|creative commons attribution no ?deriv(ative)?s)", "2.0 2.5 3.0 4.0"),
    ("CC-BY-#", "(cc by|creative commons attribution)", "2.0 2.5 3.0 4.0"),
)

#: Families whose versions stand alone or with all later ones.
_LATER = ("GPL", "LGPL", "AGPL")

#: Verbs of a grant, with the word that leads to the licence.
VERBS = ("(dual |double |tri )?licensed (under|with)", "(re)?licensed to you under", "released under", "distributed under",
         "(re)?distributable under", "available under", "published under", "provided under", "offered under", "shared under",
         "covered (by|under)", "governed by", "subject to")


def _pattern(words: str) -> str:
    """A written pattern with blanks as gaps, groups without numbers, either spelling of license."""
    words = words.replace("license", "licen[cs]e").replace("(", "(?:")
    return words.replace(" ?", f"{_GAP}*+").replace(" ", f"{_GAP}++")


def _version(versions: str) -> str:
    """Any of these versions, after ``version`` or ``v`` or alone; ``2`` is ``2.0``."""
    each = [re.escape(v[:-2]) + r"(?:\.0)?" if v.endswith(".0") else re.escape(v) for v in versions.split()]
    return f"(?:version|v)?{_GAP}*+(?:{'|'.join(reversed(each))})(?![A-Za-z0-9]|\\.[0-9])"


def _one(words: str, versions: str) -> str:
    """A name, its word ``license``, its version and what may follow."""
    licence = f"(?:{_GAP}++(?:public{_GAP}++)?licen[cs]e)?"
    out = _pattern(words) + f"(?![A-Za-z])?{licence}"
    return out + (f"(?:{_GAP}*+{_version(versions)}{_TAIL})?{licence}" if versions else "")


_TAIL = (rf"(?:\+|{_GAP}++(?:or|and){_GAP}++(?:at{_GAP}++your{_GAP}++option{_GAP}++)?(?:any{_GAP}++)?(?:later|newer|above)"
         rf"(?:{_GAP}++versions?)?(?![A-Za-z])|{_GAP}++(?:international|unported|only)(?![A-Za-z]))?")
_NAME = "(?:" + "|".join(f"(?:{_one(w, v)})" for _, w, v in NAMES) + ")(?![A-Za-z0-9])"
_SINGLE = [(licence, re.compile(f"(?:{_one(w, v)})(?![A-Za-z0-9])", re.I), v) for licence, w, v in NAMES]
_ARTICLE = rf"(?:(?:the|a|an|either|both){_GAP}++)*(?:(?:terms|conditions){_GAP}++(?:and{_GAP}++conditions{_GAP}++)?of{_GAP}++)?" \
           rf"(?:(?:the|a|an|either|both){_GAP}++)*"
_MORE = rf"(?:{_GAP}*+(?:(?:and|or){_GAP}++)?{_ARTICLE}{_NAME})*"
_GRANT = re.compile(rf"(?<![A-Za-z0-9])(?:{'|'.join(map(_pattern, VERBS))}){_GAP}++{_ARTICLE}({_NAME}{_MORE})", re.I)
_FIELD = re.compile(rf"^[^\w\n]*licen[cs]e[ \t]*[:=][ \t\"']*({_NAME}{_MORE})[^\w\n]*$", re.I | re.M)
_SPDX = re.compile(r"SPDX-License-Identifier:[ \t]*([^\n]*)", re.I)
_SPDX_ID = re.compile(r"(?<![\w.+-])(?!(?:AND|OR|WITH)(?![\w.+-]))([A-Za-z0-9](?:[\w.+-]*[A-Za-z0-9+])?)", re.I)
_EXCEPTION = re.compile(r"WITH[ \t]+[\w.+-]+", re.I)
#: Only texts with one of these are looked at.
_HINT = re.compile(r"under|covered|governed|subject|licensed|spdx|licen[cs]e[ \t]*[:=]", re.I)


def _licence(licence: str, name: str, versions: str) -> str:
    """The identifier of a found name: its version put in, ``-only`` or ``-or-later`` where the family has them."""
    if not versions:
        return licence
    family = licence.replace("-#", "")
    found = re.search(rf"(?<![0-9.])({'|'.join(re.escape(v) for v in versions.split())})", name) \
        or re.search(rf"({'|'.join(v[0] for v in versions.split() if v.endswith('.0'))})(?![0-9.]*[0-9])", name[len(family) - 1:])
    if not found:
        return family
    version = found[1] if "." in found[1] else found[1] + ".0"
    later = re.search(r"\+|later|newer|above", name[found.start():], re.I)
    end = ("-or-later" if later else "-only") if family in _LATER else ""
    return licence.replace("#", version) + end


def _names(text: str, start: int, end: int) -> list[tuple[str, int]]:
    """(licence, end) of each name in a run of names, first ones first."""
    out, at = [], start
    while at < end:
        for licence, pattern, versions in _SINGLE:
            m = pattern.match(text, at, end)
            if m and (at == start or not text[at - 1].isalnum()):
                out.append((_licence(licence, m[0], versions), m.end()))
                at = m.end()
                break
        else:
            at += 1
    return out


def named(text: str) -> list[tuple[str, str, int, int]]:
    """(licence, class, start, end) of every licence that a grant, tag or field of the text names, by place."""
    if not _HINT.search(text):
        return []
    out = []
    for m in _SPDX.finditer(text):
        line = _EXCEPTION.sub(lambda x: " " * len(x[0]), m[1])
        out += [(x[1], "spdx", m.start(), m.start(1) + x.end()) for x in _SPDX_ID.finditer(line)]
    for kind, pattern in (("grant", _GRANT), ("field", _FIELD)):
        for m in pattern.finditer(text):
            out += [(licence, kind, m.start(), end) for licence, end in _names(text, m.start(1), m.end(1))]
    return sorted(out, key=lambda f: f[2:])

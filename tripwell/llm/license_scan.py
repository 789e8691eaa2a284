"""Licence recognition by known sentences, in column expressions only.

A text is cut into sentences twice: once with every line end as a boundary
(notices on a line of their own) and once with only blank lines as boundaries
(licence texts wrapped to a width). Each sentence is reduced to lower-case
letters and digits separated by single spaces and looked up among the known
sentences. The identifiers found, in text order, form a sequence, and a licence
is reported when all sentences of one of its rules occur in that order in one of
the two sequences; other sentences may stand between them.

Some known sentences hold a mark that cuts: a colon, a semicolon, or the point of an
abbreviation. Their real wordings go through the same cutter, and the pieces it
makes, next to each other, count as the sentence.

Null and empty texts have no sentence and no licence. Repeated sentences stay in
the sequence as often as they occur. The work is one pass over the rows without
a shuffle, so neither hot keys nor copies matter.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, normalised, by identifier.
SENTENCES: dict[int, str] = {
    1: "licensed under the apache license version 2 0",
    2: "licensed under the apache license version 2 0 the license",
    3: "you may not use this file except in compliance with the license",
    4: "you may obtain a copy of the license at http www apache org licenses license 2 0",
    5: "see the license for the specific language governing permissions and limitations under the license",
    6: "spdx license identifier apache 2 0",
    10: "released under the mit license",
    11: "licensed under the mit license",
    12: "the mit license mit",
    13: "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software and to permit persons to whom the software is furnished to do so subject to "
        "the following conditions",
    14: "the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software",
    15: "the software is provided as is without warranty of any kind express or implied including but not "
        "limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    16: "spdx license identifier mit",
    20: "this work is licensed under the gnu general public license version 3",
    21: "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 3 of the license "
        "or at your option any later version",
    22: "this program is free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 2 of the license "
        "or at your option any later version",
    23: "this program is distributed in the hope that it will be useful but without any warranty without even "
        "the implied warranty of merchantability or fitness for a particular purpose",
    24: "see the gnu general public license for more details",
    25: "spdx license identifier gpl 3 0 only",
    26: "spdx license identifier gpl 3 0 or later",
    27: "spdx license identifier gpl 2 0 only",
    30: "licensed under cc by nc 4 0",
    31: "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    32: "licensed under cc by 4 0",
    33: "this work is licensed under a creative commons attribution 4 0 international license",
    34: "licensed under cc by sa 4 0",
    35: "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    36: "licensed under cc0 1 0",
    40: "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met",
    41: "redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer",
    42: "redistributions in binary form must reproduce the above copyright notice this list of conditions and "
        "the following disclaimer in the documentation and or other materials provided with the distribution",
    43: "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission",
    44: "spdx license identifier bsd 2 clause",
    45: "spdx license identifier bsd 3 clause",
    50: "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    51: "this source code form is subject to the terms of the mozilla public license v 2 0",
    52: "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    53: "this is free and unencumbered software released into the public domain",
}

_GRANT = ("This program is free software{} you can redistribute it and/or modify it under the terms of the GNU General "
          "Public License as published by the Free Software Foundation{} either version {} of the License, or (at your "
          "option) any later version.")

# Real wordings of the known sentences that hold a mark inside, by identifier.
WORDINGS: dict[int, list[str]] = {
    6: ["SPDX-License-Identifier: Apache-2.0"],
    16: ["SPDX-License-Identifier: MIT"],
    21: [_GRANT.format(a, b, 3) for a in ",;" for b in ",;"],
    22: [_GRANT.format(a, b, 2) for a in ",;" for b in ",;"],
    23: ["This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
         "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    25: ["SPDX-License-Identifier: GPL-3.0-only"],
    26: ["SPDX-License-Identifier: GPL-3.0-or-later"],
    27: ["SPDX-License-Identifier: GPL-2.0-only"],
    44: ["SPDX-License-Identifier: BSD-2-Clause"],
    45: ["SPDX-License-Identifier: BSD-3-Clause"],
    51: ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
}

_LIBRARY_GRANT = ("This library is free software{} you can redistribute it and/or modify it under the terms of the GNU Lesser "
                  "General Public License as published by the Free Software Foundation{} either version 2.1 of the License, "
                  "or (at your option) any later version.")

# More wordings of public licence texts and notices; the first form gives the sentence.
WORDINGS |= {
    60: [_LIBRARY_GRANT.format(a, b) for a in ",;" for b in ",;"],
    61: [_GRANT.format(a, b, 3).replace("GNU General", "GNU Lesser General") for a in ",;:" for b in ",;"],
    62: [_GRANT.format(a, b, 3).replace("GNU General", "GNU Affero General") for a in ",;:" for b in ",;"],
    63: ["This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
         "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."],
    64: ["This program and the accompanying materials are made available under the terms of the Eclipse Public License "
         "2.0 which is available at https://www.eclipse.org/legal/epl-2.0"],
    65: ["Distributed under the Boost Software License, Version 1.0."],
    66: ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
         "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
         "distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to "
         "permit third-parties to whom the Software is furnished to do so, all subject to the following:"],
    67: ["This software is provided 'as-is', without any express or implied warranty."],
    68: ["Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
         "to alter it and redistribute it freely, subject to the following restrictions:"],
    69: ["Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, "
         "worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare "
         "Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such "
         "Derivative Works in Source or Object form."],
    70: ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
         "hereby granted."],
}

# Further licence tags by sentence identifier, and the licence each names.
TAGS: dict[int, tuple[str, str]] = {
    100: ("GPL-2.0-or-later", "GPL-2.0"), 101: ("LGPL-2.1-only", "LGPL-2.1"), 102: ("LGPL-2.1-or-later", "LGPL-2.1"),
    103: ("LGPL-3.0-only", "LGPL-3.0"), 104: ("LGPL-3.0-or-later", "LGPL-3.0"), 105: ("AGPL-3.0-only", "AGPL-3.0"),
    106: ("AGPL-3.0-or-later", "AGPL-3.0"), 107: ("MPL-2.0", "MPL-2.0"), 108: ("EPL-2.0", "EPL-2.0"),
    109: ("BSL-1.0", "BSL-1.0"), 110: ("Zlib", "Zlib"), 111: ("Artistic-2.0", "Artistic-2.0"), 112: ("CC0-1.0", "CC0-1.0"),
    113: ("Unlicense", "Unlicense"), 114: ("ISC", "ISC"), 115: ("0BSD", "0BSD"), 116: ("CC-BY-4.0", "CC-BY-4.0"),
    117: ("CC-BY-SA-4.0", "CC-BY-SA-4.0"), 118: ("CC-BY-NC-4.0", "CC-BY-NC-4.0"),
}
WORDINGS |= {i: [f"SPDX-License-Identifier: {tag}"] for i, (tag, _) in TAGS.items()}


def normalised(wording: str) -> str:
    return " ".join(re.findall("[a-z0-9]+", wording.lower()))


SENTENCES |= {i: normalised(forms[0]) for i, forms in WORDINGS.items() if i not in SENTENCES}

# Licence and the sentence identifiers that show it, in order.
RULES: list[tuple[str, list[int]]] = [
    ("Apache-2.0", [1]),
    ("Apache-2.0", [2, 3]),
    ("Apache-2.0", [6]),
    ("MIT", [10]),
    ("MIT", [11]),
    ("MIT", [12]),
    ("MIT", [13, 14, 15]),
    ("MIT", [16]),
    ("GPL-3.0", [20]),
    ("GPL-3.0", [21, 23]),
    ("GPL-3.0", [25]),
    ("GPL-3.0", [26]),
    ("GPL-2.0", [22, 23]),
    ("GPL-2.0", [27]),
    ("CC-BY-NC-4.0", [30]),
    ("CC-BY-NC-4.0", [31]),
    ("CC-BY-4.0", [32]),
    ("CC-BY-4.0", [33]),
    ("CC-BY-SA-4.0", [34]),
    ("CC-BY-SA-4.0", [35]),
    ("CC0-1.0", [36]),
    ("BSD-2-Clause", [40, 41, 42]),
    ("BSD-2-Clause", [44]),
    ("BSD-3-Clause", [40, 41, 42, 43]),
    ("BSD-3-Clause", [45]),
    ("ISC", [50]),
    ("MPL-2.0", [51, 52]),
    ("Unlicense", [53]),
    ("LGPL-2.1", [60, 63]),
    ("LGPL-3.0", [61, 23]),
    ("AGPL-3.0", [62, 23]),
    ("EPL-2.0", [64]),
    ("BSL-1.0", [65]),
    ("BSL-1.0", [66]),
    ("Zlib", [67, 68]),
    ("Apache-2.0", [69]),
    ("0BSD", [70]),
    *[(name, [i]) for i, (_, name) in TAGS.items()],
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SENTENCE_END = r"[.!?;:]+[\"')*]*([ \t\r\n]+|$)"
_BLANK_LINE = r"\n[ \t\r]*\n"


def _sentences(text: Column, by_line: bool) -> Column:
    """Normalised sentences of a text, empty ones included."""
    low = F.translate(text, _UPPER, _LOWER)
    if not by_line:
        low = F.regexp_replace(F.regexp_replace(low, _BLANK_LINE, ". "), r"[\r\n]+", " ")
    marked = F.regexp_replace(low, _SENTENCE_END, "\n")
    return F.split(F.regexp_replace(marked, r"[^a-z0-9\n]+", " "), "\n")


def pieces(wording: str) -> list[str]:
    """What the cutter makes of a wording without line ends, normalised, empty pieces left out."""
    marked = re.sub(_SENTENCE_END, "\n", wording.translate(str.maketrans(_UPPER, _LOWER)))
    return [p for x in re.sub(r"[^a-z0-9\n]+", " ", marked).split("\n") if (p := x.strip())]


def _codes(known: dict[int, str], wordings: dict[int, list[str]]) -> tuple[dict[str, str], list[tuple[str, str]]]:
    """Code of every known sentence and piece, and the runs of codes that stand for a sentence, longest first."""
    codes = {sentence: f"|{i}|" for i, sentence in known.items()}
    cut = sorted({(tuple(p), i) for i, forms in wordings.items() if i in known for p in map(pieces, forms) if len(p) > 1},
                 key=lambda x: (-len(x[0]), x))
    for k, piece in enumerate(dict.fromkeys(p for parts, _ in cut for p in parts)):
        codes.setdefault(piece, f"<{k}>")
    return codes, [("".join(codes[p] for p in parts), f"|{i}|") for parts, i in cut]


def sentence_ids(text: Column, by_line: bool, known: dict[int, str] = SENTENCES,
                 wordings: dict[int, list[str]] = WORDINGS) -> Column:
    """Identifiers of the known sentences of a text, in text order, as ``|1||10|``."""
    codes, runs = _codes(known, wordings)
    lookup = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    found = F.transform(F.transform(_sentences(text, by_line), lambda s: F.trim(s)),
                        lambda s: F.when(s.isin(*codes), lookup[s]).otherwise(F.lit("?")))
    ids = F.array_join(found, "")
    for run, code in runs:
        ids = F.replace(ids, F.lit(run), F.lit(code))
    return F.regexp_replace(ids, r"<[0-9]+>|\?", "")


def _pattern(sequence: list[int]) -> str:
    return "%" + "%".join(f"|{i}|" for i in sequence) + "%"


def _holds(longer: list[int], shorter: list[int]) -> bool:
    rest = iter(longer)
    return len(longer) > len(shorter) and all(i in rest for i in shorter)


def longer_rules(name: str, sequence: list[int], rules: list[tuple[str, list[int]]]) -> list[list[int]]:
    """Sequences of other licences that hold a rule's sequence, longest first."""
    return sorted((s for n, s in rules if n != name and _holds(s, sequence)), key=lambda s: (-len(s), s))


def scan_licenses(docs: DataFrame, text: str = "text", rules: list[tuple[str, list[int]]] = RULES,
                  known: dict[int, str] = SENTENCES, wordings: dict[int, list[str]] = WORDINGS) -> DataFrame:
    """Adds ``line_ids``, ``wrapped_ids`` (identifier sequences) and ``licenses`` (array, in rule order).

    Columns of those names in the input are replaced. Where the sequence of one licence holds
    that of another, the longer one wins: its unbroken runs are taken out before the shorter
    is looked for, and the shorter is not reported while the longer still matches the rest.
    """
    source = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    found = docs.withColumns({"line_ids": sentence_ids(source, True, known, wordings),
                              "wrapped_ids": sentence_ids(source, False, known, wordings)})

    def shown(ids: Column, name: str, sequence: list[int]) -> Column:
        longer = longer_rules(name, sequence, rules)
        for other in longer:
            ids = F.replace(ids, F.lit("".join(f"|{i}|" for i in other)), F.lit(""))
        hit = ids.like(_pattern(sequence))
        for other in longer:
            hit = hit & ~ids.like(_pattern(other))
        return hit

    hits = []
    for name in dict.fromkeys(n for n, _ in rules):
        either = F.lit(False)
        for _, sequence in (r for r in rules if r[0] == name):
            either = either | shown(F.col("line_ids"), name, sequence) | shown(F.col("wrapped_ids"), name, sequence)
        hits.append(F.when(either, F.lit(name)))
    return found.withColumn("licenses", F.array_compact(F.array(*hits)))


def _sql_ids(by_line: bool) -> str:
    low = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
    if not by_line:
        low = rf"regexp_replace(regexp_replace({low}, '\n[ \t\r]*\n', '. ', 'g'), '[\r\n]+', ' ', 'g')"
    marked = rf"""regexp_replace({low}, '[.!?;:]+["'')*]*([ \t\r\n]+|$)', chr(10), 'g')"""
    pieces = rf"string_split(regexp_replace({marked}, '[^a-z0-9\n]+', ' ', 'g'), chr(10))"
    codes, runs = _codes(SENTENCES, WORDINGS)
    cases = " ".join(f"when '{sentence}' then '{code}'" for sentence, code in codes.items())
    ids = f"array_to_string(list_transform({pieces}, lambda s: case trim(s) {cases} else '?' end), '')"
    for run, code in runs:
        ids = f"replace({ids}, '{run}', '{code}')"
    return f"regexp_replace({ids}, '<[0-9]+>|[?]', '', 'g')"


def _sql_shown(ids: str, name: str, sequence: list[int]) -> str:
    longer = longer_rules(name, sequence, RULES)
    for other in longer:
        ids = f"replace({ids}, '{''.join(f'|{i}|' for i in other)}', '')"
    return " and ".join([f"{ids} like '{_pattern(sequence)}'", *[f"{ids} not like '{_pattern(s)}'" for s in longer]])


def oracle() -> str:
    """The same result, stated over sentences in DuckDB's dialect."""
    names = []
    for name in dict.fromkeys(n for n, _ in RULES):
        tests = [f"({_sql_shown(c, name, s)})" for n, s in RULES if n == name for c in ("line_ids", "wrapped_ids")]
        names.append(f"case when {' or '.join(tests)} then '{name}' end")
    return (f"with found as (select doc_id, {_sql_ids(True)} as line_ids, {_sql_ids(False)} as wrapped_ids "
            f"from documents) select doc_id, line_ids, wrapped_ids, concat_ws(',', {', '.join(names)}) as licenses "
            "from found")

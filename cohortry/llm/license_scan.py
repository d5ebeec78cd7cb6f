"""Licences in texts: known sentences become identifiers, ordered rules match their sequences.

A text is cut into sentences at line ends and after . ! ? before white space. A
sentence is normalised to its lower-case ASCII letters and digits with single
spaces between; known ones are replaced by their identifiers, the others
vanish. A line end inside a paragraph is white space as well: a sentence may run
over any number of whole lines, the longest known one counts. Lines without
letters or digits end a paragraph. Rules are tried in order, so that a long
notice is taken before a sentence that it holds; what a rule has taken, later
ones don't see.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Normalised sentences of licences and notices, and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "apache2-under",
    "licensed under the apache license version 2 0 the license": "apache2-defined",
    "you may not use this file except in compliance with the license": "apache2-comply",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache2-copy",
    "released under the mit license": "mit-under",
    "licensed under the mit license": "mit-under",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "the software is provided as is without warranty of any kind": "mit-warranty",
    "this work is licensed under the gnu general public license version 3": "gpl3-under",
    "licensed under the gnu general public license version 3": "gpl3-under",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-free",
    "either version 3 of the license or at your option any later version": "gpl3-later",
    "licensed under cc by nc 4 0": "ccbync4-under",
    "licensed under cc by 4 0": "ccby4-under",
    "licensed under cc by sa 4 0": "ccbysa4-under",
    "redistributions of source code must retain the above copyright notice": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice": "bsd-binary",
    "all rights reserved": "reserved",
    # As the licences have them: whole sentences, and those that a line of its own or a semicolon parts or joins.
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "apache2-grant",
    "you may obtain a copy of the license at": "apache2-obtain",
    "http www apache org licenses license 2 0": "apache2-url",
    "https www apache org licenses license 2 0": "apache2-url",
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "apache2-copy",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-notice",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "this work is licensed under cc by nc 4 0": "ccbync4-under",
    "this work is licensed under cc by 4 0": "ccby4-under",
    "this work is licensed under cc by sa 4 0": "ccbysa4-under",
    **{
        f"this work is licensed under {article} creative commons {kind} 4 0 international license": found
        for article in ("a", "the")
        for kind, found in (
            ("attribution noncommercial", "ccbync4-under"), ("attribution", "ccby4-under"), ("attribution sharealike", "ccbysa4-under"),
        )
    },
    **{
        f"this {work} is free software you can redistribute it and or modify it under the terms of the gnu {licence} as published by the free software foundation either version {version} of the license or at your option any later version": found
        for work in ("program", "library")
        for licence, version, found in (
            ("general public license", "2", "gpl2-notice"), ("lesser general public license", "2 1", "lgpl21-notice"),
            ("lesser general public license", "3", "lgpl3-notice"), ("affero general public license", "3", "agpl3-notice"),
        )
    },
    "this source code form is subject to the terms of the mozilla public license v": "mpl2-subject",
    **{f"if a copy of the mpl was not distributed with this file you can obtain one at {scheme} mozilla org mpl 2 0": "mpl2-copy" for scheme in ("http", "https")},
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "this software is provided as is without any express or implied warranty": "zlib-warranty",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "zlib-grant",
    "distributed under the boost software license version 1 0": "bsl1-under",
    "this is free and unencumbered software released into the public domain": "unlicense-free",
    "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide": "cc0-dedicated",
    **{
        f"this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at {scheme} www eclipse org legal epl 2 0": "epl2-notice"
        for scheme in ("http", "https")
    },
}

#: Rules in order: licence, sequence of identifiers that follow one another.
RULES = (
    ("Apache-2.0", ("apache2-defined", "apache2-comply", "apache2-copy")),
    ("Apache-2.0", ("apache2-defined", "apache2-comply", "apache2-obtain", "apache2-url")),
    ("Apache-2.0", ("apache2-grant", "apache2-copy")),
    ("Apache-2.0", ("apache2-grant", "apache2-obtain", "apache2-url")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-later")),
    ("GPL-3.0-or-later", ("gpl3-notice",)),
    ("GPL-2.0-or-later", ("gpl2-notice",)),
    ("LGPL-2.1-or-later", ("lgpl21-notice",)),
    ("LGPL-3.0-or-later", ("lgpl3-notice",)),
    ("AGPL-3.0-or-later", ("agpl3-notice",)),
    ("MPL-2.0", ("mpl2-subject", "mpl2-copy")),
    ("MPL-2.0", ("mpl2-subject",)),
    ("EPL-2.0", ("epl2-notice",)),
    ("ISC", ("isc-grant",)),
    ("Zlib", ("zlib-warranty", "zlib-grant")),
    ("Zlib", ("zlib-grant",)),
    ("BSL-1.0", ("bsl1-under",)),
    ("Unlicense", ("unlicense-free",)),
    ("CC0-1.0", ("cc0-dedicated",)),
    ("MIT", ("mit-notice", "mit-warranty")),
    ("BSD-3-Clause", ("reserved", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-3-Clause", ("bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("reserved", "bsd-source", "bsd-binary")),
    ("BSD-2-Clause", ("bsd-source", "bsd-binary")),
    ("Apache-2.0", ("apache2-grant",)),
    ("Apache-2.0", ("apache2-defined",)),
    ("Apache-2.0", ("apache2-under",)),
    ("MIT", ("mit-under",)),
    ("GPL-3.0-only", ("gpl3-under",)),
    ("CC-BY-NC-4.0", ("ccbync4-under",)),
    ("CC-BY-SA-4.0", ("ccbysa4-under",)),
    ("CC-BY-4.0", ("ccby4-under",)),
    ("Proprietary", ("reserved",)),
)

MARKS = r"[.!?]+(?:[ \t\r\f\x0B]+|$)"
#: The holder that the third BSD clause names.
HOLDER = r"(?<=\|)neither[ |]the[ |]names?[ |]of[ |](?:[a-z0-9]+[ |]){1,20}?nor[ |]the[ |]names[ |]of[ |]its[ |]contributors(?=[ |])"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _anchors(sentences: dict[str, str]) -> str:
    """A pattern that every text with a known sentence holds: each sentence's longest word."""
    return "(?i)" + "|".join(sorted({max(s.split(), key=len) for s in sentences}))


def _runs(sentences: dict[str, str]) -> str:
    """A pattern of each sentence over one or more whole lines, the longest first."""
    longest = sorted(sentences, key=lambda s: (-len(s), s))
    return r"(?<=\|)(?:" + "|".join(s.replace(" ", "[ |]") for s in longest) + r")(?=\|)"


def identifiers(text: Column, sentences: dict[str, str] = SENTENCES) -> Column:
    """The identifiers of the known sentences in their order; null for a null text."""
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    # Lines stand between bars; a mark becomes an empty line, which no sentence crosses.
    cut = F.regexp_replace(text, "(?md)" + MARKS, "\n\n")
    words = F.regexp_replace(F.translate(cut, UPPER, LOWER), "[^a-z0-9\n]+", " ")
    lines = F.regexp_replace(F.concat(F.lit("\n"), words, F.lit("\n")), " ?\n ?", "|")
    lines = F.regexp_replace(lines, HOLDER, "neither the name of the copyright holder nor the names of its contributors")
    found = F.transform(F.regexp_extract_all(lines, F.lit(_runs(sentences)), F.lit(0)), lambda s: F.element_at(known, F.translate(s, "|", " ")))
    return F.when(text.isNull(), F.lit(None)).when(text.rlike(_anchors(sentences)), found).otherwise(F.array().cast("array<string>"))


def licences(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules: tuple = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sentence_ids, licences) of every row, both arrays in order of the text.

    A text that is null or empty, or knows no sentence, has empty arrays.
    Repeated rows give repeated rows, a null id stays null, other columns
    aren't read, and an empty table gives an empty result.
    """
    ids = F.coalesce(identifiers(F.col(text_col).cast("string"), sentences), F.array().cast("array<string>"))
    rows = docs.select(F.col(id_col).alias("doc_id"), ids.alias("sentence_ids"))
    sequence = F.concat(F.lit("<"), F.array_join("sentence_ids", "><"), F.lit(">"))
    for name, wanted in rules:
        sequence = F.replace(sequence, F.lit("<" + "><".join(wanted) + ">"), F.lit("{" + name + "}"))
    return rows.select("doc_id", "sentence_ids", F.regexp_extract_all(sequence, F.lit(r"\{([^}]*)\}"), 1).alias("licences"))

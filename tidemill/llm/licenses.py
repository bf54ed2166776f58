"""Licence scan by sentence rules: known sentences become identifiers, and sequences of those licences.

A text is cut into sentences, each is normalised (lower case, letters and digits only), and those in the
table of known sentences give their identifier. The identifiers of a text, in order, are then rewritten by ordered
rules: each replaces a sequence by a licence, so a rule for a longer licence comes before one for its parts.
Identifiers that no rule takes up are reported as left over.

Everything is SQL expressions over whole texts. The tables are constants.

Defined results: NULL counts as an empty text, without sentences. Rows with the same id are separate; a licence
that a text states twice is listed once, in the order of first statement.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# One of these is in every known sentence; texts without any are not cut.
HINT = "(?i)licen[cs]e|copyright|rights reserved|permission|warrant|redistribut|public domain|spdx"
ENDS = r"([.!?])[ \t\r]+"
OTHER = "[^a-z0-9]+"

# Known sentences of public licence notices, normalised, by identifier.
SENTENCES = {
    "MITRELEASED": ("released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "the mit license", "mit license"),
    "MITGRANT": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
        "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject "
        "to the following conditions",
    ),
    "MITNOTICE": ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",),
    "APACHELICENSED": (
        "licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license",
        "released under the apache license version 2 0", "this project is licensed under the apache license 2 0",
    ),
    "APACHEUNLESS": ("you may not use this file except in compliance with the license",),
    "APACHECOPY": ("you may obtain a copy of the license at",),
    "GPL3LICENSED": (
        "this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3",
        "this program is licensed under the gnu general public license version 3",
    ),
    "GPLFREE": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
        "published by the free software foundation either version 3 of the license or at your option any later version",
    ),
    "GPLWARRANTY": ("this program is distributed in the hope that it will be useful but without any warranty",),
    "LGPLLICENSED": ("licensed under the gnu lesser general public license version 3", "licensed under the gnu lesser general public license version 2 1"),
    "AGPLLICENSED": ("licensed under the gnu affero general public license version 3",),
    "MPLLICENSED": ("this source code form is subject to the terms of the mozilla public license v 2 0", "licensed under the mozilla public license version 2 0"),
    "BSDREDIST": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",),
    "BSDLICENSED": ("licensed under the bsd 3 clause license", "released under the bsd license", "licensed under the bsd 2 clause license"),
    "BSDNAMES": ("neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",),
    "CCBYNC": ("licensed under cc by nc 4 0", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    "CCBYSA": ("licensed under cc by sa 4 0", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    "CCBY": ("licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"),
    "CC0": ("licensed under cc0 1 0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    "PUBLICDOMAIN": ("this is free and unencumbered software released into the public domain", "this work is in the public domain"),
    "RESERVED": ("all rights reserved",),
    "SPDXMIT": ("spdx license identifier mit",),
    "SPDXAPACHE": ("spdx license identifier apache 2 0",),
    "SPDXGPL": ("spdx license identifier gpl 3 0 only", "spdx license identifier gpl 3 0 or later"),
}
# In order: a sequence of identifiers (each followed by a space), and its licence.
RULES = (
    ("MITRELEASED (MITGRANT )?(MITNOTICE )?|MITGRANT MITNOTICE |MITGRANT |SPDXMIT ", "MIT"),
    ("APACHELICENSED (APACHEUNLESS )?(APACHECOPY )?|APACHEUNLESS APACHECOPY |SPDXAPACHE ", "Apache-2.0"),
    ("AGPLLICENSED (GPLWARRANTY )?", "AGPL-3.0"),
    ("LGPLLICENSED (GPLWARRANTY )?", "LGPL"),
    ("GPLFREE (GPLWARRANTY )?|GPL3LICENSED (GPLWARRANTY )?|SPDXGPL ", "GPL-3.0"),
    ("MPLLICENSED ", "MPL-2.0"),
    ("BSDREDIST BSDNAMES |BSDREDIST |BSDLICENSED (BSDREDIST )?(BSDNAMES )?", "BSD"),
    ("CCBYNC ", "CC-BY-NC-4.0"),
    ("CCBYSA ", "CC-BY-SA-4.0"),
    ("CCBY ", "CC-BY-4.0"),
    ("CC0 ", "CC0-1.0"),
    ("PUBLICDOMAIN ", "public-domain"),
    ("RESERVED ", "all-rights-reserved"),
)


def enclosed(pattern: str) -> str:
    """The rule's pattern with each identifier between semicolons, so that none is part of another."""
    return re.sub(r"([A-Z0-9]+) ", r";\1;", pattern)


def sentences(text: Column) -> Column:
    """Normalised sentences of a text, in order; a line ends a sentence, too."""
    parts = F.split(F.regexp_replace(text, ENDS, "$1\n"), "\n")
    return F.transform(parts, lambda s: F.trim(F.regexp_replace(F.translate(s, UPPER, LOWER), OTHER, " ")))


def identifiers(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    known = {s: name for name, forms in SENTENCES.items() for s in forms}
    table = F.create_map(*(F.lit(v) for pair in known.items() for v in pair))
    # Sentences of a length that no known one has are dropped before the look-up.
    shortest, longest = min(map(len, known)), max(map(len, known))
    likely = F.filter(sentences(text), lambda s: F.length(s).between(shortest, longest))
    found = F.filter(F.transform(likely, lambda s: F.try_element_at(table, s)), lambda i: i.isNotNull())
    return F.when(text.rlike(HINT), found).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame) -> DataFrame:
    """`doc_id, identifiers, licenses, n_known, n_left` for every row of documents `doc_id, text`."""
    found = docs.select("doc_id", identifiers(F.coalesce("text", F.lit(""))).alias("ids"))
    sequence = F.array_join(F.transform("ids", lambda i: F.concat(F.lit(";"), i, F.lit(";"))), "")
    for pattern, licence in RULES:
        sequence = F.regexp_replace(sequence, enclosed(pattern), f"<{licence}>")
    rows = found.select("doc_id", "ids", sequence.alias("sequence"))
    licences = F.array_distinct(F.regexp_extract_all("sequence", F.lit("<([^>]*)>"), F.lit(1)))
    return rows.select(
        "doc_id",
        F.array_join("ids", " ").alias("identifiers"),
        F.array_join(licences, ",").alias("licenses"),
        F.size("ids").cast("bigint").alias("n_known"),
        F.size(F.regexp_extract_all("sequence", F.lit(";[A-Z0-9]+;"), F.lit(0))).cast("bigint").alias("n_left"),
    )


def oracle() -> str:
    """The same in DuckDB's SQL."""
    known = {s: name for name, forms in SENTENCES.items() for s in forms}
    keys = ", ".join(f"'{s}'" for s in known)
    values = ", ".join(f"'{n}'" for n in known.values())
    sequence = "seq"
    for pattern, licence in RULES:
        sequence = f"regexp_replace({sequence}, '{enclosed(pattern)}', '<{licence}>', 'g')"
    return f"""
WITH cut AS (
  SELECT doc_id, list_transform(
      string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \\t\\r]+', '\\1' || chr(10), 'g'), chr(10)),
      lambda s: trim(regexp_replace(translate(s, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g'), ' ')) AS parts
  FROM documents
), named AS (
  SELECT doc_id, list_filter(list_transform(parts, lambda s: map([{keys}], [{values}])[s]), lambda i: i IS NOT NULL) AS ids FROM cut
), ruled AS (
  SELECT doc_id, ids, {sequence} AS seq
  FROM (SELECT *, coalesce(array_to_string(list_transform(ids, lambda i: ';' || i || ';'), ''), '') AS seq FROM named)
), stated AS (SELECT *, regexp_extract_all(seq, '<([^>]*)>', 1) AS found FROM ruled)
SELECT doc_id, coalesce(array_to_string(ids, ' '), '') AS identifiers,
  coalesce(array_to_string(list_filter(found, lambda l, i: list_position(found, l) = i), ','), '') AS licenses,
  len(ids)::BIGINT AS n_known, len(regexp_extract_all(seq, ';[A-Z0-9]+;'))::BIGINT AS n_left
FROM stated
"""

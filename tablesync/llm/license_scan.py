"""Licence scans by sentence rules.

Texts are cut into sentences, sentences are normalised, known ones become
identifiers, and the sequence of identifiers is matched against ordered rules.
A known sentence may run over several of the cuts: published texts are wrapped,
and hold colons, semicolons and abbreviations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.frames import packed, text_of

#: Normalised sentences of published licence texts and notices, with their identifiers.
SENTENCES = {
    "licensed under the apache license version 2 0": "Apache2Ref",
    "licensed under the apache license version 2 0 the license": "Apache2Ref",
    "you may not use this file except in compliance with the license": "ApacheCompliance",
    "you may obtain a copy of the license at": "ApacheCopy",
    "http www apache org licenses license 2 0": "ApacheLink",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "ApacheAsIs",
    "see the license for the specific language governing permissions and limitations under the license": "ApacheSee",
    "released under the mit license": "MitRef",
    "licensed under the mit license": "MitRef",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MitNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MitAsIs",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MitLiability",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BsdGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BsdEndorse",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "IscGrant",
    "this work is licensed under the gnu general public license version 3": "Gpl3Ref",
    "this work is licensed under the gnu general public license version 2": "Gpl2Ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "Gpl3PlusGrant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "Gpl2PlusGrant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GnuHope",
    "see the gnu general public license for more details": "GnuSee",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "Mpl2Subject",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "Mpl2Copy",
    "licensed under cc by 4 0": "CcBy4Ref",
    "licensed under cc by sa 4 0": "CcBySa4Ref",
    "licensed under cc by nc 4 0": "CcByNc4Ref",
    "licensed under cc by nd 4 0": "CcByNd4Ref",
    "all rights reserved": "AllRights",
}

#: Tried in this order; what a rule has matched is taken out before the next is tried.
RULES = [
    ("Apache-2.0", ["Apache2Ref", "ApacheCompliance", "ApacheCopy", "ApacheLink", "ApacheAsIs", "ApacheSee"]),
    ("Apache-2.0", ["Apache2Ref", "ApacheCompliance", "ApacheCopy", "ApacheAsIs", "ApacheSee"]),
    ("Apache-2.0", ["Apache2Ref"]),
    ("MIT", ["MitGrant", "MitNotice", "MitAsIs", "MitLiability"]),
    ("MIT", ["MitRef"]),
    ("BSD-3-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse"]),
    ("BSD-2-Clause", ["BsdGrant", "BsdSource", "BsdBinary"]),
    ("ISC", ["IscGrant"]),
    ("GPL-3.0-or-later", ["Gpl3PlusGrant", "GnuHope", "GnuSee"]),
    ("GPL-3.0-or-later", ["Gpl3PlusGrant"]),
    ("GPL-2.0-or-later", ["Gpl2PlusGrant", "GnuHope", "GnuSee"]),
    ("GPL-2.0-or-later", ["Gpl2PlusGrant"]),
    ("GPL-3.0", ["Gpl3Ref"]),
    ("GPL-2.0", ["Gpl2Ref"]),
    ("MPL-2.0", ["Mpl2Subject", "Mpl2Copy"]),
    ("MPL-2.0", ["Mpl2Subject"]),
    ("CC-BY-4.0", ["CcBy4Ref"]),
    ("CC-BY-SA-4.0", ["CcBySa4Ref"]),
    ("CC-BY-NC-4.0", ["CcByNc4Ref"]),
    ("CC-BY-ND-4.0", ["CcByNd4Ref"]),
]


def sentences(text: Column) -> Column:
    """Normalised sentences: cut at line ends and after full stops, ASCII letters and digits only."""
    cut = F.split(F.regexp_replace(text, "([.;:!?])[ \t]+", "$1\n"), "\n", -1)
    plain = F.transform(cut, lambda s: F.trim(F.regexp_replace(F.lower(s), "[^a-z0-9]+", " ")))
    return F.filter(plain, lambda s: s != "")


#: Words that mark comments, in front of a line.
_MARKS = r"(?<=\n)(?:dnl|rem)(?: |(?=\n))"


def known_runs(parts: Column, known: dict[str, str]) -> Column:
    """The known sentences in order; each begins and ends with a piece, whatever cuts lie between."""
    line = F.concat(F.lit("\n"), F.array_join(parts, "\n"), F.lit("\n"))
    line = F.regexp_replace(F.regexp_replace(line, _MARKS, ""), r"\bhttps\b", "http")
    runs = "|".join(k.replace(" ", r"[ \n]+") for k in sorted(known, key=len, reverse=True))
    found = F.regexp_extract_all(line, F.lit(rf"(?<=\n)(?:(?:[0-9]{{1,2}}|[a-z]) )?({runs})(?=\n)"), F.lit(1))
    return F.transform(found, lambda s: F.regexp_replace(s, r"\n+", " "))


def _tag(names: list[str]) -> str:
    return "".join(f"<{n}>" for n in names)


def scan_licenses(
    docs: DataFrame,
    text_col: str = "text",
    known: dict[str, str] = SENTENCES,
    rules: list[tuple[str, list[str]]] = RULES,
) -> DataFrame:
    """``row``, ``n_sentences``, ``sentence_ids`` and ``licenses`` of every row.

    Built-in functions within the row: no shuffle, and hot sources or sentences
    make no difference. Known sentences are also found wrapped over lines, behind
    comment marks and numbers of a list, and over the cuts inside them, though
    ``n_sentences`` counts each piece. Sentences that are not known are left out of the
    sequence, so a licence may be interrupted by other text. ``licenses`` names
    each licence once, in the order of the rules. Null and empty texts have no
    sentences.
    """
    names = F.create_map(*(F.lit(x) for pair in known.items() for x in pair))
    base = packed(docs, text=text_col).withColumn("parts", sentences(text_of()))
    base = base.withColumn(
        "ids", F.filter(F.transform(known_runs(F.col("parts"), known), lambda s: names[s]), lambda i: i.isNotNull())
    )
    joined = F.array_join(F.transform("ids", lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")
    table = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(_tag(s)).alias("tag")) for n, s in rules))

    def step(done, rule):
        return F.struct(
            F.replace(done["rest"], rule["tag"], F.lit("|")).alias("rest"),
            F.when(
                F.contains(done["rest"], rule["tag"]),
                F.array_union(done["found"], F.array(rule["name"])),
            ).otherwise(done["found"]).alias("found"),
        )

    start = F.struct(F.col("tags").alias("rest"), F.expr("cast(array() as array<string>)").alias("found"))
    return base.withColumn("tags", joined).select(
        "row",
        F.size("parts").cast("long").alias("n_sentences"),
        F.col("ids").alias("sentence_ids"),
        F.when(F.size("ids") == 0, F.expr("cast(array() as array<string>)"))
        .otherwise(F.aggregate(table, start, step, lambda done: done["found"]))
        .alias("licenses"),
    )


def oracle_sql() -> str:
    """The same in DuckDB, one step for each rule."""
    pairs = ", ".join(f"'{k}': '{v}'" for k, v in SENTENCES.items())
    steps = []
    for i, (name, ids) in enumerate(RULES):
        tag = _tag(ids)
        steps.append(
            f"r{i + 1} AS MATERIALIZED (SELECT doc_id, n_sentences, ids, replace(rest, '{tag}', '|') AS rest, "
            f"CASE WHEN contains(rest, '{tag}') AND NOT list_contains(found, '{name}') "
            f"THEN list_append(found, '{name}') ELSE found END AS found FROM r{i})"
        )
    return rf"""
        WITH cut AS (
            SELECT doc_id, list_filter(list_transform(
                string_split(regexp_replace(coalesce(text, ''), '([.;:!?])[ \t]+', '\1' || chr(10), 'g'), chr(10)),
                lambda s: trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g'))), lambda s: s <> '') AS parts
            FROM documents),
        known AS (
            SELECT doc_id, len(parts) AS n_sentences,
                   list_filter(list_transform(parts, lambda s: MAP {{{pairs}}}[s]), lambda i: i IS NOT NULL) AS ids
            FROM cut),
        r0 AS (
            SELECT *, array_to_string(list_transform(ids, lambda i: '<' || i || '>'), '') AS rest,
                   CAST([] AS VARCHAR[]) AS found FROM known),
        {", ".join(steps)}
        SELECT doc_id, n_sentences, array_to_string(ids, ',') AS sentence_ids,
               array_to_string(found, ',') AS licenses FROM r{len(RULES)}"""

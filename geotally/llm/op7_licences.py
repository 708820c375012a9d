r"""Licence scan by sentence rules, in DataFrame functions only.

A text is cut into sentences after ``.``, ``!`` or ``?`` with a blank behind it and at lines without a letter or digit (empty
ones, and those of a comment's marks alone); a sentence that goes over several lines is looked up as a whole and, if unknown, line by line, so that a notice is found on a line of
its own as well as wrapped over lines. Sentences are normalised (ASCII lower case, runs of other ASCII characters
than letters and digits become one space) and mapped to the identifiers of known licence sentences. Then the ordered rules
are matched: a rule is a sequence of identifiers that must follow each other among the text's known sentences, and what it
matches is used up before the next rule.

Defined results: a null or empty text has no licence; a licence found twice in a text is counted twice; repeated rows get
one row each; other columns are ignored; an empty table gives an empty result. Texts of any length are scanned whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

# Public licence sentences, as their licences or usual notices give them.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-grant-only": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mit-line": "Released under the MIT License.",
    "mit-under": "Licensed under the MIT License.",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "apache-line": "Licensed under the Apache License, Version 2.0.",
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "gpl3-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-redistribute": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "cc-by-nc-4-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4-line": "Licensed under CC BY-SA 4.0.",
    "all-rights": "All rights reserved.",
}
# Longer sequences come before their parts.
RULES = (
    ("MIT", ("mit-grant", "as-is", "mit-liability")),
    ("MIT", ("mit-grant-only", "mit-notice", "as-is", "mit-liability")),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-grant-only", "mit-notice")),
    ("BSD-3-Clause", ("bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-source", "bsd-binary")),
    ("GPL-3.0-or-later", ("gpl-redistribute", "gpl-hope")),
    ("GPL-3.0-or-later", ("gpl-redistribute",)),
    ("Apache-2.0", ("apache-notice", "apache-copy")),
    ("Apache-2.0", ("apache-notice",)),
    ("ISC", ("isc-grant",)),
    ("MIT", ("mit-line",)),
    ("MIT", ("mit-under",)),
    ("Apache-2.0", ("apache-line",)),
    ("GPL-3.0-only", ("gpl3-line",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-line",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-line",)),
    ("CC-BY-4.0", ("cc-by-4-line",)),
    ("LicenseRef-all-rights-reserved", ("all-rights",)),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SENTENCE_END = r"([.!?])[ \t\x0B\f\r]*[ \t\n\x0B\f\r]|\n[^\nA-Za-z0-9\x{80}-\x{10FFFF}]*\n"


def normalised(text: str) -> str:
    """The Python twin of the normalisation, for the table of sentences."""
    import re

    return re.sub(OTHER, " ", text.translate(str.maketrans(UPPER, LOWER))).strip(" ")


KNOWN = {normalised(text): name for name, text in SENTENCES.items()}


def _normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), OTHER, " "))


def _lookup(key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair]), key)


def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, ``found`` (identifiers of the known sentences in order) and ``licences`` (names in the order of the rules)."""
    sentences = F.split(F.regexp_replace(F.coalesce("text", F.lit("")), SENTENCE_END, "$1\u0001"), "\u0001")

    def one(sentence: Column) -> Column:
        whole = _lookup(_normalised(sentence))
        lines = F.transform(F.split(sentence, "\n"), lambda line: _lookup(_normalised(line)))
        return F.when(whole.isNotNull(), F.array(whole)).when(F.instr(sentence, "\n") > 0, lines).otherwise(F.array(F.lit(None).cast("string")))

    found = docs.select("doc_id", F.filter(F.flatten(F.transform(sentences, one)), lambda x: x.isNotNull()).alias("found"))
    # Identifiers as <a><b>; what a rule has used becomes one | so that nothing joins across it.
    made = found.withColumn("left", F.concat(F.lit(""), F.array_join(F.transform("found", lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")))
    named = []
    for i, (licence, sequence) in enumerate(rules):
        pattern = "".join(f"<{x}>" for x in sequence)
        times = ((F.length("left") - F.length(F.replace(F.col("left"), F.lit(pattern), F.lit("")))) / len(pattern)).cast("int")
        made = made.withColumns({f"n{i}": times, "left": F.replace(F.col("left"), F.lit(pattern), F.lit("|"))})
        named.append(F.array_repeat(F.lit(licence), F.col(f"n{i}")))
    return made.select("doc_id", "found", F.flatten(F.array(*named)).alias("licences"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.size("found").cast("long").alias("n_known_sentences"), F.array_join("found", ",").alias("sentence_ids"),
                        F.array_join("licences", ",").alias("licences"), (F.size("licences") > 0).alias("licensed"))


def _sql() -> str:
    known = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in KNOWN.items()) + "}"
    norm = lambda x: f"trim(regexp_replace(translate({x}, '{UPPER}', '{LOWER}'), '{OTHER}', ' ', 'g'))"
    step, last = "", "r0"
    for i, (_, sequence) in enumerate(RULES):
        pattern = "".join(f"<{x}>" for x in sequence)
        step += f""",
r{i + 1} AS (SELECT * EXCLUDE (rest), (length(rest) - length(replace(rest, '{pattern}', ''))) // {len(pattern)} AS n{i}, replace(rest, '{pattern}', '|') AS rest FROM r{i})"""
        last = f"r{i + 1}"
    names = " || ".join(f"repeat('{licence},', CAST(n{i} AS INT))" for i, (licence, _) in enumerate(RULES))
    end = SENTENCE_END.replace(r"\x0B", r"\v")
    return rf"""
WITH s AS (SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '{end}', '\1' || chr(1), 'g'), chr(1)) AS parts FROM documents),
known AS (SELECT {known} AS m),
f AS (SELECT doc_id, list_filter(flatten(list_transform(parts, lambda p:
  CASE WHEN m[{norm('p')}] IS NOT NULL THEN [m[{norm('p')}]]
       ELSE list_transform(string_split(p, chr(10)), lambda l: m[{norm('l')}]) END)), lambda x: x IS NOT NULL) AS found FROM s, known),
r0 AS (SELECT doc_id, found, coalesce(array_to_string(list_transform(found, lambda x: '<' || x || '>'), ''), '') AS rest FROM f){step}
SELECT doc_id, CAST(len(found) AS BIGINT) AS n_known_sentences, coalesce(array_to_string(found, ','), '') AS sentence_ids,
  rtrim({names}, ',') AS licences, ({names}) <> '' AS licensed FROM {last}
"""


SQL = _sql()

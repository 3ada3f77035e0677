"""License scans by sentence rules, in DataFrame operations only: sentences to identifiers, identifier sequences to rules."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Sentences of published licences and notices, by identifier.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "as-is-software": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-obtain": "You may obtain a copy of the License at",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-short": "Licensed under the Apache License, Version 2.0.",
    "gpl2-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl3-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-no-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl2-short": "This work is licensed under the GNU General Public License, version 2.",
    "gpl3-short": "This work is licensed under the GNU General Public License, version 3.",
    "lgpl3-short": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl3-short": "This work is licensed under the GNU Affero General Public License, version 3.",
    "mpl2-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mit-short": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "bsd3-short": "Released under the BSD 3-Clause License.",
    "bsd2-short": "Released under the BSD 2-Clause License.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
}
# Kinds of Creative Commons licences and their versions; SPDX names that a tag line may give.
CREATIVE = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
VERSIONS = ("2.0", "3.0", "4.0")
SPDX = ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-3.0-only", "AGPL-3.0-only", "MPL-2.0", "Unlicense", "CC0-1.0")

# Rules in order of precedence within a family: licence, family, identifiers that must follow each other.
RULES = [
    ("BSD-3-Clause", "bsd", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", "bsd", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", "bsd", ("bsd3-short",)),
    ("BSD-2-Clause", "bsd", ("bsd2-short",)),
    ("MIT", "mit", ("mit-grant", "mit-notice", "as-is-software")),
    ("MIT", "mit", ("mit-grant", "mit-notice")),
    ("MIT", "mit", ("mit-short",)),
    ("MIT", "mit", ("mit-licensed",)),
    ("ISC", "isc", ("isc-grant",)),
    ("Apache-2.0", "apache", ("apache-notice", "apache-obtain", "apache-as-is")),
    ("Apache-2.0", "apache", ("apache-notice",)),
    ("Apache-2.0", "apache", ("apache-short",)),
    ("GPL-2.0-or-later", "gpl2", ("gpl2-notice", "gpl-no-warranty")),
    ("GPL-2.0-or-later", "gpl2", ("gpl2-notice",)),
    ("GPL-2.0-only", "gpl2", ("gpl2-short",)),
    ("GPL-3.0-or-later", "gpl3", ("gpl3-notice", "gpl-no-warranty")),
    ("GPL-3.0-or-later", "gpl3", ("gpl3-notice",)),
    ("GPL-3.0-only", "gpl3", ("gpl3-short",)),
    ("LGPL-3.0-only", "lgpl", ("lgpl3-short",)),
    ("AGPL-3.0-only", "agpl", ("agpl3-short",)),
    ("MPL-2.0", "mpl", ("mpl2-notice",)),
    ("Unlicense", "unlicense", ("unlicense",)),
    ("CC0-1.0", "cc0", ("cc0",)),
]

#: A sentence ends at a mark that white space follows, or at an empty line.
BREAK = r"[.!?;]\s+|\n\s*\n"


def catalogue() -> tuple[list[tuple[str, str]], list[tuple[int, str, str, str, str]]]:
    """Sentences (identifier, normalised text), and rules (precedence, licence, family, first identifier, pattern)."""
    sentences, rules = dict(SENTENCES), list(RULES)
    for kind in CREATIVE:
        for version in VERSIONS:
            name = f"CC-{kind}-{version}"
            sentences[name.lower()] = f"Licensed under CC {kind} {version}."
            rules.append((name, name.lower(), (name.lower(),)))
    for name in SPDX:
        sentences[f"spdx-{name.lower()}"] = f"SPDX-License-Identifier: {name}"
        rules.append((name, f"spdx-{name.lower()}", (f"spdx-{name.lower()}",)))
    pieces, known = [], {}
    for key, text in sentences.items():  # a long sentence with marks inside is a sequence of identifiers of its own
        parts = [re.sub("[^a-z0-9]+", " ", p.lower()).strip() for p in re.split(BREAK, text)]
        known[key] = [f"{key}.{i}" for i, p in enumerate(parts) if p]
        pieces += list(zip(known[key], [p for p in parts if p], strict=True))
    flat = []
    for order, (licence, family, keys) in enumerate(rules):
        ids = [i for key in keys for i in known[key]]
        flat.append((order, licence, family, ids[0], "%" + "%".join(f"|{i}|" for i in ids) + "%"))
    return pieces, flat


def _tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The catalogue as tables; its size is that of this module's lists."""
    pieces, rules = catalogue()
    return spark.createDataFrame(pieces, "id string, known string"), spark.createDataFrame(rules, "rule int, license string, family string, head string, pattern string")


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, license, family, first_sentence, n_sentences): the licences that each document states.

    Texts are cut into sentences, and sentences into lines where they have several; each is lower-cased, with all but letters
    a-z and digits as single spaces, and looked up as a whole. A document's identifiers, in text order (a sentence before
    its lines), must contain those of a rule in order, others may stand between; of a family's rules that match, the
    first counts. first_sentence is the number (from 0) of the document's first known sentence, n_sentences how many known
    ones it has. Documents without a licence have no row; null and empty texts have none. Every row is a document of its own,
    also where rows repeat a doc_id or have none. A very long text is cut into its sentences within the task that reads it;
    only known sentences are shuffled. Other columns aren't looked at; no rows give no rows.
    """
    pieces, rules = _tables(docs.sparkSession)
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    sentences = rows.select("row", "doc_id", F.posexplode(F.split("text", BREAK)).alias("at", "sentence"))
    lines = F.split("sentence", "\n")
    parts = F.when(F.size(lines) > 1, F.concat(F.array("sentence"), lines)).otherwise(F.array("sentence"))
    found = sentences.select("row", "doc_id", "at", F.posexplode(parts).alias("line", "part"))
    found = found.withColumn("known", F.trim(F.regexp_replace(F.lower("part"), "[^a-z0-9]+", " ")))
    hits = found.join(F.broadcast(pieces), "known").select("row", "doc_id", "at", "line", "id")
    each = hits.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(F.struct("at", "line", "id"))).alias("hits"))
    text = F.array_join(F.transform("hits", lambda h: F.concat(F.lit("|"), h["id"], F.lit("|"))), "")
    each = each.select("row", "doc_id", F.get("hits", F.lit(0))["at"].cast("long").alias("first_sentence"), F.size("hits").cast("long").alias("n_sentences"), text.alias("ids"), F.array_distinct(F.transform("hits", lambda h: h["id"])).alias("heads"))
    cases = each.withColumn("head", F.explode("heads")).join(F.broadcast(rules), "head").where("ids LIKE pattern")
    best = F.row_number().over(Window.partitionBy("row", "family").orderBy("rule"))
    return cases.withColumn("best", best).where("best = 1").select("doc_id", "license", "family", "first_sentence", "n_sentences")


def oracle() -> str:
    """The same scan of ``documents`` in DuckDB."""
    pieces, rules = catalogue()
    text = lambda x: "'" + str(x).replace("'", "''") + "'"
    known = ", ".join(f"({text(a)}, {text(b)})" for a, b in pieces)
    ruled = ", ".join(f"({r}, {text(a)}, {text(b)}, {text(c)}, {text(d)})" for r, a, b, c, d in rules)
    return f"""
WITH pieces(id, known) AS (VALUES {known}), rules(rule, license, family, head, pattern) AS (VALUES {ruled}),
cut AS (SELECT row_number() OVER () AS row, doc_id, string_split_regex(text, '[.!?;]\\s+|\\n\\s*\\n') AS parts FROM documents),
sentences AS (SELECT row, doc_id, unnest(range(0, len(parts))) AS spot, unnest(parts) AS sentence FROM cut),
lined AS (SELECT row, doc_id, spot, CASE WHEN contains(sentence, chr(10)) THEN list_concat([sentence], string_split(sentence, chr(10))) ELSE [sentence] END AS lines FROM sentences),
found AS (SELECT row, doc_id, spot, unnest(range(0, len(lines))) AS line, unnest(lines) AS part FROM lined),
hits AS (
  SELECT row, doc_id, spot, line, id FROM found JOIN pieces ON pieces.known = trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g'))
),
each AS (
  SELECT row, doc_id, min(spot) AS first_sentence, count(*) AS n_sentences, string_agg('|' || id || '|', '' ORDER BY spot, line, id) AS ids FROM hits GROUP BY row, doc_id
),
cases AS (SELECT each.*, rules.* FROM each JOIN rules ON ids LIKE pattern)
SELECT doc_id, license, family, first_sentence, n_sentences FROM cases
QUALIFY row_number() OVER (PARTITION BY row, family ORDER BY rule) = 1
"""

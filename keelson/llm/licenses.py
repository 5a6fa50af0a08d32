"""License scans by sentence-rule recognition.

A text is cut into sentences (at ``.``, ``!``, ``?`` before white space, at lines without a letter
or digit, and at numbered list items) and, separately, into lines. Each piece is normalised (lower case, everything but
letters and digits to single spaces), so line breaks and comment marks within a sentence
don't matter; a sentence that names a holder or a work is reduced to its fixed part
(``FIXED_PARTS``). Pieces are looked up among known licence sentences. The identifiers that are found, in text order, are matched against ordered rules:
a rule fits where its identifiers follow each other among the recognised ones. A
fitting rule hides the rules of the same licence that it contains.

One projection over the table, with no shuffle. Texts without any marker word
(each known sentence holds one) aren't cut. A null, empty or unlicensed text has
empty results. Every row is judged by itself: repeated rows get equal results, whole texts of any
length are read, an empty table gives no rows, and other columns aren't read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Known licence sentences, normalised, by identifier.
SENTENCES = {
    "mit-notice": "released under the mit license",
    "mit-notice-2": "licensed under the mit license",
    "mit-title": "the mit license mit",
    "mit-title-2": "mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-condition": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-grant-condition": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "no-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-header": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-obtain": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl3-notice-2": "licensed under the gnu general public license version 3",
    "gpl3-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl-details": "see the gnu general public license for more details",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "cc-by-notice": "licensed under cc by 4 0",
    "cc-by-sa-notice": "licensed under cc by sa 4 0",
    "bsd-name-any": "endorse or promote products derived from this software",
    "apache-header-use": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "apache-obtain-at": "you may obtain a copy of the license at",
    "apache-url": "http www apache org licenses license 2 0",
    "apache-url-s": "https www apache org licenses license 2 0",
    "apache-obtain-as-is": "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-obtain-as-is-s": "you may obtain a copy of the license at https www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-title": "apache license version 2 0 january 2004 http www apache org licenses",
    "mit0-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so",
    "mpl-form": "this source code form is subject to the terms of the mozilla public license v",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "mpl-copy-s": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "mpl-title": "mozilla public license version 2 0",
    "lgpl21-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "lgpl3-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl3-free-program": "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "lgpl-details": "see the gnu lesser general public license for more details",
    "agpl3-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "agpl-details": "see the gnu affero general public license for more details",
    "gpl2-title": "gnu general public license version 2 june 1991",
    "gpl3-title": "gnu general public license version 3 29 june 2007",
    "lgpl21-title": "gnu lesser general public license version 2 1 february 1999",
    "lgpl3-title": "gnu lesser general public license version 3 29 june 2007",
    "agpl3-title": "gnu affero general public license version 3 19 november 2007",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-grant-and": "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc0-waived": "has waived all copyright and related or neighboring rights to",
    "cc0-title": "cc0 1 0 universal",
    "cc0-title-legal": "creative commons legal code cc0 1 0 universal",
}
# Sentences with names in them; a piece that holds one of these counts as it.
FIXED_PARTS = [SENTENCES["bsd-name-any"], SENTENCES["cc0-waived"]]
# Identifiers that may follow SPDX-License-Identifier.
SPDX = [
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0",
    "EPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "MIT", "MIT-0", "MPL-2.0", "Unlicense", "Zlib",
]
SENTENCES |= {f"spdx-{x}": "spdx license identifier " + re.sub("[^a-z0-9]+", " ", x.lower()) for x in SPDX}
# Ordered rules, (rule, licence, sentence identifiers).
RULES = [
    ("mit-full", "MIT", ["mit-grant-condition", "as-is", "no-liability"]),
    ("mit-full-cut", "MIT", ["mit-grant", "mit-condition", "as-is", "no-liability"]),
    ("mit-terms", "MIT", ["mit-grant-condition"]),
    ("mit-terms-cut", "MIT", ["mit-grant", "mit-condition"]),
    ("mit-notice", "MIT", ["mit-notice"]),
    ("mit-notice-2", "MIT", ["mit-notice-2"]),
    ("mit-title", "MIT", ["mit-title"]),
    ("mit-title-2", "MIT", ["mit-title-2"]),
    ("apache-full", "Apache-2.0", ["apache-header", "apache-use", "apache-obtain", "apache-as-is"]),
    ("apache-header", "Apache-2.0", ["apache-header"]),
    ("apache-header-full", "Apache-2.0", ["apache-header-use", "apache-obtain-at", "apache-url", "apache-as-is"]),
    ("apache-header-full-s", "Apache-2.0", ["apache-header-use", "apache-obtain-at", "apache-url-s", "apache-as-is"]),
    ("apache-header-joined", "Apache-2.0", ["apache-header-use", "apache-obtain-as-is"]),
    ("apache-header-joined-s", "Apache-2.0", ["apache-header-use", "apache-obtain-as-is-s"]),
    ("apache-header-use", "Apache-2.0", ["apache-header-use"]),
    ("apache-title", "Apache-2.0", ["apache-title"]),
    ("apache-notice", "Apache-2.0", ["apache-notice"]),
    ("gpl3-full", "GPL-3.0-or-later", ["gpl3-free", "gpl-hope", "gpl-details"]),
    ("gpl3-free", "GPL-3.0-or-later", ["gpl3-free"]),
    ("gpl2-full", "GPL-2.0-or-later", ["gpl2-free", "gpl-hope", "gpl-details"]),
    ("gpl2-free", "GPL-2.0-or-later", ["gpl2-free"]),
    ("gpl3-notice", "GPL-3.0-only", ["gpl3-notice"]),
    ("gpl3-notice-2", "GPL-3.0-only", ["gpl3-notice-2"]),
    ("bsd3-full", "BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name-any"]),
    ("bsd3-name-first", "BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-name-any", "bsd-binary"]),
    ("bsd2-full", "BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("mit0-full", "MIT-0", ["mit0-grant", "as-is", "no-liability"]),
    ("mpl-full", "MPL-2.0", ["mpl-form", "mpl-copy"]),
    ("mpl-full-s", "MPL-2.0", ["mpl-form", "mpl-copy-s"]),
    ("mpl-form", "MPL-2.0", ["mpl-form"]),
    ("mpl-title", "MPL-2.0", ["mpl-title"]),
    ("lgpl21-full", "LGPL-2.1-or-later", ["lgpl21-free", "lgpl-hope", "lgpl-details"]),
    ("lgpl21-free", "LGPL-2.1-or-later", ["lgpl21-free"]),
    ("lgpl3-full", "LGPL-3.0-or-later", ["lgpl3-free", "lgpl-hope", "lgpl-details"]),
    ("lgpl3-free", "LGPL-3.0-or-later", ["lgpl3-free"]),
    ("lgpl3-program", "LGPL-3.0-or-later", ["lgpl3-free-program"]),
    ("agpl3-full", "AGPL-3.0-or-later", ["agpl3-free", "gpl-hope", "agpl-details"]),
    ("agpl3-free", "AGPL-3.0-or-later", ["agpl3-free"]),
    ("gpl2-title", "GPL-2.0-only", ["gpl2-title"]),
    ("gpl3-title", "GPL-3.0-only", ["gpl3-title"]),
    ("lgpl21-title", "LGPL-2.1-only", ["lgpl21-title"]),
    ("lgpl3-title", "LGPL-3.0-only", ["lgpl3-title"]),
    ("agpl3-title", "AGPL-3.0-only", ["agpl3-title"]),
    ("isc-grant", "ISC", ["isc-grant"]),
    ("isc-grant-and", "ISC", ["isc-grant-and"]),
    ("0bsd-grant", "0BSD", ["0bsd-grant"]),
    ("unlicense", "Unlicense", ["unlicense"]),
    ("cc0-waived", "CC0-1.0", ["cc0-waived"]),
    ("cc0-title", "CC0-1.0", ["cc0-title"]),
    ("cc0-title-legal", "CC0-1.0", ["cc0-title-legal"]),
    ("cc-by-nc-notice", "CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("cc-by-notice", "CC-BY-4.0", ["cc-by-notice"]),
    ("cc-by-sa-notice", "CC-BY-SA-4.0", ["cc-by-sa-notice"]),
]
RULES += [(f"spdx-{x}", x, [f"spdx-{x}"]) for x in SPDX]
# Rules that hide others of a different licence, (longer, shorter).
HIDES = [("bsd3-full", "bsd2-full")]
# No rule for the shorter licence fits a text with this sentence, (sentence, rule).
BARS = [("bsd-name-any", "bsd2-full")]
# Each known sentence holds one of these words.
MARKERS = ["license", "licensed", "permission", "warranty", "liability", "compliance", "permitted", "redistributions", "endorse", "unencumbered", "waived", "cc0", "mozilla"]

LIST_ITEM = r"\n[^A-Za-z0-9\n]*(?:[0-9]{1,2}[.)]|\([a-z0-9]{1,2}\)|[a-z]\))[ \t]"
EMPTY_LINE = r"\n[^A-Za-z0-9\n]*\n"
SENTENCE_END = LIST_ITEM + r"|[.!?]+(?=\s|$)|" + EMPTY_LINE
LINE_END = r"[\n\r]+"


def normalised(piece: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(piece), r"[^a-z0-9]+", " "))


def reduced(piece: Column) -> Column:
    """A normalised sentence that holds a fixed part as that part alone."""
    out = piece
    for part in FIXED_PARTS:
        out = F.when(F.contains(piece, F.lit(part)), F.lit(part)).otherwise(out)
    return out


def _identifiers(text: Column, end: str) -> Column:
    known = F.create_map(*[F.lit(x) for name, s in SENTENCES.items() for x in (s, name)])
    names = F.transform(F.split(text, end), lambda piece: F.try_element_at(known, reduced(normalised(piece))))
    return F.filter(names, lambda name: name.isNotNull())


def hidden_by(rules: list, hides: list) -> dict[str, list[str]]:
    """rule -> longer rules that contain it (same licence) or hide it by name."""

    def inside(a: list, b: list) -> bool:
        return len(a) < len(b) and any(b[i : i + len(a)] == a for i in range(len(b)))

    out = {r: [o for o, olic, oids in rules if olic == lic and inside(ids, oids)] for r, lic, ids in rules}
    for longer, shorter in hides:
        out[shorter].append(longer)
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_known, rules, licences): the known sentences in the text (by sentences
    or by lines, whichever finds more), the fitting rules and their licences,
    sorted and joined by commas."""
    text = F.col(text_col).cast("string")
    marked = F.coalesce(F.rlike(text, F.lit("(?i)" + "|".join(MARKERS))), F.lit(False))
    empty = F.array().cast("array<string>")
    rows = docs.select(
        F.col(id_col),
        F.when(marked, _identifiers(text, SENTENCE_END)).otherwise(empty).alias("by_sentence"),
        F.when(marked, _identifiers(text, LINE_END)).otherwise(empty).alias("by_line"),
    )
    chain = lambda ids: F.concat(F.lit("<"), F.array_join(ids, "><"), F.lit(">"))
    rows = rows.withColumn("s", chain(F.col("by_sentence"))).withColumn("l", chain(F.col("by_line")))
    fits = {}
    for rule, _, ids in RULES:
        pattern = F.lit("<" + "><".join(ids) + ">")
        fits[rule] = F.contains(F.col("s"), pattern) | F.contains(F.col("l"), pattern)
    for name, rule in BARS:
        fits[rule] = fits[rule] & ~(F.contains(F.col("s"), F.lit(f"<{name}>")) | F.contains(F.col("l"), F.lit(f"<{name}>")))
    hidden = hidden_by(RULES, HIDES)
    shown = [
        F.when(fits[rule] & ~_any([fits[o] for o in hidden[rule]]), F.struct(F.lit(rule).alias("rule"), F.lit(lic).alias("licence")))
        for rule, lic, _ in RULES
    ]
    rows = rows.withColumn("found", F.when(F.size("by_sentence") + F.size("by_line") > 0, F.filter(F.array(*shown), lambda x: x.isNotNull())))
    join = lambda field: F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.col(f"found.{field}"))), ","), F.lit(""))
    return rows.select(
        id_col, F.greatest(F.size("by_sentence"), F.size("by_line")).cast("long").alias("n_known"), join("rule").alias("rules"), join("licence").alias("licences")
    )


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

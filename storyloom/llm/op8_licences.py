"""Licence scans by digests of canonical texts, by DataFrame functions alone."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from storyloom.llm.common import digest, stored

# Published licence texts and common one-line notices; longer texts are in the folder beside this file.
KNOWN: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under CC BY-NC 4.0.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "ISC": [
        "SPDX-License-Identifier: ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ],
}

TEXTS = Path(__file__).parent / "licences"
# Titles under which short licences are published, beside none.
TITLES: dict[str, list[str]] = {
    "MIT": ["The MIT License", "The MIT License (MIT)", "MIT License (MIT)"],
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)"],
    "BSD-2-Clause": ["BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The BSD 2-Clause License"],
    "BSD-3-Clause": ["BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "The BSD 3-Clause License"],
}


def _published() -> dict[str, list[str]]:
    """The texts of the folder, each as published and in the other forms that it is commonly handed on in."""
    out = {p.stem: [p.read_text(encoding="utf-8")] for p in sorted(TEXTS.glob("*.txt"))}
    for name, texts in out.items():
        # without the advice on how to apply it
        end = re.search(r"END OF TERMS AND CONDITIONS", texts[0])
        if end:
            texts += [texts[0][: end.end()], texts[0][: end.start()]]
        # with the holder of the rights filled in, which is left out like any such line
        texts += [t.replace("Copyright [yyyy] [name of copyright owner]", "") for t in texts if "[yyyy]" in t]
    regents = out["BSD-3-Clause"][0]
    holder = regents.replace("the University", "the copyright holder").replace("REGENTS AND", "COPYRIGHT HOLDERS AND").replace("REGENTS OR", "COPYRIGHT HOLDER OR")
    two = re.sub(r"3\. Neither.*?permission\.\n", "", holder, flags=re.S)
    for name, texts in (("BSD-3-Clause", [regents, holder]), ("BSD-2-Clause", [two])):
        # clauses with numbers or bullets
        out[name] = [form for t in texts for form in (t, re.sub(r"(?m)^[123]\. ", "* ", t))]
    return out


def _add_published() -> None:
    for name, texts in _published().items():
        KNOWN[name] = KNOWN.get(name, []) + texts
    for name, titles in TITLES.items():
        bodies = [t.removeprefix("MIT License\n") for t in KNOWN[name] if len(t) > 500]
        KNOWN[name][:0] = [t + "\n\n" + b for t in titles for b in bodies] + bodies * (name == "MIT")


_add_published()

# Words and phrases that count as the same; of each pair the first becomes the second.
SAME: list[tuple[str, str]] = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("per cent", "percent"),
    ("whilst", "while"),
    ("favour", "favor"),
    ("organisation", "organization"),
    ("copyright owner", "copyright holder"),
]
# A line that only says who holds the rights, after lowering.
HOLDER = r"^[ \t#/*;!-]*(copyright[ \t]*(\(c\)|©|<|[0-9])|\(c\)[ \t]|©|all rights reserved)"
NOT_WORD = r"[^\p{L}\p{N}]+"


def _same(out: Column) -> Column:
    for a, b in SAME:
        out = F.replace(out, F.lit(f" {a} "), F.lit(f" {b} "))
    return out


def canonical_line(line: Column) -> Column:
    """Lower case, no punctuation, one blank between words, equivalent spellings made one; empty for a copyright line."""
    low = F.lower(line)
    out = _same(F.concat(F.lit(" "), F.regexp_replace(low, NOT_WORD, " "), F.lit(" ")))
    return F.when(low.rlike(HOLDER), "").otherwise(F.trim(F.regexp_replace(out, "  +", " ")))


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text that are not empty."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), canonical_line), lambda x: x != "")


def known_texts(spark: SparkSession, known: dict[str, list[str]] | None = None) -> DataFrame:
    rows = [(name, text) for name, texts in (KNOWN if known is None else known).items() for text in texts]
    return spark.createDataFrame(rows, "licence string, text string")


def licence_scan(
    documents: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Licences that a document is, or names in a line of its own, by digest of canonical text.

    Texts and lines are made canonical (``canonical_line``; a text is its canonical lines joined) and digested once;
    the digests are joined to those of the known texts, so the cost does not depend on how many are known. A
    whole text or a whole line must equal a known text; parts of either never match.

    One row per row that goes in: doc_id, text_digest (SHA-256 of the canonical text), text_licence (null if the text
    is no known one), line_licences (sorted, each once), n_lines (lines that match). Of several names for one
    text the first by code point counts. Texts are matched with phrases that a line break cuts made one; ``text_digest``
    is of the lines as they are. Null and empty texts match nothing; repeated rows repeat; a null id stays
    null; an empty table gives an empty result; other columns are ignored.
    """
    spark = documents.sparkSession
    known = known_texts(spark) if known is None else known
    whole = lambda lines: F.array_join(lines, " ")
    # a phrase that a line break cuts becomes one after lines are joined
    rejoined = lambda lines: F.trim(_same(F.concat(F.lit(" "), whole(lines), F.lit(" "))))
    pair = lambda x: F.struct(*(h.alias(n) for h, n in zip(digest(x), ("h1", "h2"))))
    known = known.select("licence", rejoined(canonical_lines(F.col("text"))).alias("c")).filter("c != ''")
    known = known.groupBy(pair(F.col("c")).alias("h")).agg(F.min("licence").alias("licence"))
    rows = documents.select(documents[id_col].alias("doc_id"), documents[text_col].alias("text"))
    key = digest(F.col("doc_id"), F.col("text"))
    rows = rows.select("doc_id", key[0].alias("d1"), key[1].alias("d2"), canonical_lines(F.col("text")).alias("lines"))
    rows = rows.select(
        "doc_id", "d1", "d2", F.transform("lines", pair).alias("lines"), pair(rejoined(F.col("lines"))).alias("whole"),
        F.sha2(whole(F.col("lines")), 256).alias("text_digest"),
    )
    rows = stored(rows, "canonical-digests")
    # positions in place of a count: repeated rows have the same ones
    units = rows.select("d1", "d2", F.posexplode("lines").alias("pos", "h"))
    units = units.union(rows.select("d1", "d2", F.lit(-1), "whole"))
    of_text = F.col("pos") < 0
    found = units.join(known, "h").groupBy("d1", "d2").agg(
        F.min(F.when(of_text, F.col("licence"))).alias("text_licence"),
        F.sort_array(F.collect_set(F.when(~of_text, F.col("licence")))).alias("line_licences"),
        F.size(F.collect_set(F.when(~of_text, F.col("pos")))).alias("n_lines"),
    )
    return rows.join(found, ["d1", "d2"], "left").select(
        "doc_id", "text_digest", "text_licence",
        F.coalesce("line_licences", F.array().cast("array<string>")).alias("line_licences"),
        F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"),
    )

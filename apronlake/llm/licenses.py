"""License scans by canonical digest lookup.

A text is brought to a canonical form: lower case, copyright statements left out, equivalent
spellings of whole words unified, everything but letters and digits turned to single spaces.
Statements (of 16 words at most) are left out where they stand alone: paragraphs of nothing
else, and lines before a text's first other line. A line inside a paragraph stays, however it begins, so that the
form of a text does not depend on where its lines are broken. The sha256
of the whole form is joined with the digests of known licenses and notices, brought to
the same form. Units that are looked up: the whole document, each of its paragraphs
(between empty lines) and each of its lines. A match is always of an entire unit with an
entire known text, never of a part.

Before any form is made, texts and units are asked for a stem: a few stems are chosen so
that each known text has one of them in some word, however that word may be spelled
(``licen`` stands for both license and licence). A unit without any of them cannot have a
known form, so leaving it out loses nothing.

The table of known digests has a row a license; it is broadcast up to ``broadcast_rows``
rows and joined by shuffle beyond. Units are exploded in the scan and only matches move.

Cases. Null and empty texts, and units without letters or digits, match nothing. Very
long texts are read whole. A license found in several units counts once in ``licenses``
and once a line in ``n_notices``. Repeated rows and rows of a null or repeated doc_id: each by
itself, as often as they are there. Ties of equal known texts: the smaller name. Empty
table: no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table

#: Equivalent spellings, as license-matching guidelines list them, of whole words.
SPELLINGS = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("sublicences", "sublicenses"),
    ("sublicenced", "sublicensed"),
    ("organisation", "organization"),
    ("organisations", "organizations"),
    ("authorisation", "authorization"),
    ("authorisations", "authorizations"),
    ("authorised", "authorized"),
    ("unauthorised", "unauthorized"),
    ("favour", "favor"),
    ("fulfilment", "fulfillment"),
    ("non commercial", "noncommercial"),
    ("per cent", "percent"),
    ("copyright holder", "copyright owner"),
    ("copyright holders", "copyright owners"),
)
#: Words after "copyright" that tell of a licence's own wrapped line, not of a holder.
_NO_HOLDER = r"(?:notices?|holders?|owners?|owned|licen[cs]es?|laws?|statements?|interests?|protections?|treaty|treaties|rights?|acts?|disclaimers?|permissions?|terms|conditions|status|information|and|or|in|on|to|of|is|are|as|for|with|that|this|which|from|under|at|may|shall|must|if|not)\b"
#: A line that is a statement: "copyright" with a year, a sign or a holder; "©"; "(c)" with a year or a few words.
STATEMENT = (
    r"^[^a-z0-9]*(?:copyright[^a-z0-9]*(?:\(c\)|©|[0-9]{4})|©|\(c\)[^a-z0-9]*(?:[0-9]{4}|(?:[a-z0-9]+[^a-z0-9]*){0,6}$)|all rights reserved[^a-z0-9]*$)"
)
HOLDER = r"^[^a-z0-9]*copyright[^a-z0-9]+[a-z]"
NO_HOLDER = r"^[^a-z0-9]*copyright[^a-z0-9]+" + _NO_HOLDER
#: A line of more than 16 words is a paragraph that no line feed breaks, and no statement.
LONG = r"^[^a-z0-9]*(?:[a-z0-9]+[^a-z0-9]+){16}[a-z0-9]"

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_BSD_1 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_2 = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_3 = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_0BSD = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.
""" + _ISC.split("\n")[1]
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

#: sha256 of the canonical forms of whole license texts, too long to stand here.
#: Each of these texts has the stem "licen".
DIGESTS = (
    ("Apache-2.0", "e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2"),
    ("Artistic-1.0-Perl", "64e91f5cc481723b420f8e1ecf131ec7eba02da96cf0a78bb4b764fb30984f7a"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "b123b020cdebe3d55bd68618c6353838071d2e10f0f64d65763cf7ff420a19c3"),
    ("GFDL-1.3", "05ddf12dd5f65ec20f1e8ac132f9c8890bd9aa6682a1ae8f3a2f6607e15424dd"),
    ("GPL-1.0", "f50d5d0bba8851579c601dfc6943feb65815649761437e05c57783508e2ef998"),
    ("GPL-2.0", "ae3b95b52f656d001aef1261789ff7235942239f226c063ecb26e091e7e4d750"),
    ("GPL-3.0", "fb0ec0c6d81c7bd0a2fc44aec57e155bf0b7baf77ccc23a5b1a223c303bcee7c"),
    ("LGPL-2.0", "78313bd7f6a556002af519e0d71d98c19dad90ecf9eaf36108e18f3c3ad06753"),
    ("LGPL-2.1", "26bdd7a58ce6908a552c31c8651d55291831a995263cab92a3c3cc2b86066c25"),
    ("LGPL-3.0", "3ce770135de37fc153de7af30789ebf6cf1e9ad54eb9b487647ea8aa9ccae9c2"),
    ("MPL-1.1", "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a"),
    ("Unlicense", "8d3909f4543649cfba0b0b1fc765c67acf3736106a78237ea2972f83eaa7dd3e"),
)

#: Texts of licenses and of the notices by which documents name them.
KNOWN = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n" + _MIT),
    ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("ISC", _ISC),
    ("ISC", "ISC License\n" + _ISC),
    ("BSD-2-Clause", f"{_BSD_1}\n{_BSD_2}"),
    ("BSD-2-Clause", f"BSD 2-Clause License\n{_BSD_1}\n{_BSD_2}"),
    ("BSD-3-Clause", f"{_BSD_1}\n{_BSD_3}\n{_BSD_2}"),
    ("BSD-3-Clause", f"BSD 3-Clause License\n{_BSD_1}\n{_BSD_3}\n{_BSD_2}"),
    ("0BSD", _0BSD),
    ("Zlib", _ZLIB),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This work is licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "This work is licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "Released under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0-only", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
)


def _silent(line: Column) -> Column:
    """Whether a line holds no words of a license: a statement, or nothing but marks."""
    statement = line.rlike(STATEMENT) | (line.rlike(HOLDER) & ~line.rlike(NO_HOLDER))
    return (statement & ~line.rlike(LONG)) | ~line.rlike("[a-z0-9]")


def canonical(text: Column) -> Column:
    """The canonical form; empty if nothing is left."""
    lines = lambda x: F.split(x, "\n")
    kept = F.filter(F.split(F.lower(text), r"\n\s*\n"), lambda p: F.exists(lines(p), lambda x: ~_silent(x)))
    rest = lines(F.array_join(kept, "\n"))
    begin = F.array_position(F.transform(rest, lambda x: ~_silent(x)), F.lit(True)).cast("int")
    x = F.when(begin > 0, F.array_join(F.slice(rest, F.greatest(begin, F.lit(1)), F.size(rest)), " ")).otherwise("")
    x = F.trim(F.regexp_replace(x, "[^a-z0-9]+", " "))
    for old, new in SPELLINGS:
        x = F.regexp_replace(x, rf"\b{old}\b", new)
    return x


def canonical_text(text: str) -> str:
    """The same form in Python, for the few known texts."""
    statement = lambda x: re.search(STATEMENT, x) or (re.search(HOLDER, x) and not re.search(NO_HOLDER, x))
    silent = lambda x: bool(statement(x) and not re.search(LONG, x)) or not re.search("[a-z0-9]", x)
    kept = [p for p in re.split(r"\n\s*\n", text.lower()) if not all(map(silent, p.split("\n")))]
    lines = "\n".join(kept).split("\n")
    begin = next((i for i, x in enumerate(lines) if not silent(x)), len(lines))
    x = re.sub("[^a-z0-9]+", " ", " ".join(lines[begin:])).strip()
    for old, new in SPELLINGS:
        x = re.sub(rf"\b{old}\b", new, x)
    return x


def stems(known: tuple[tuple[str, str], ...]) -> list[str]:
    """Stems of which every known form has one: greedily the one that most forms have, longer ones first.

    The stem of a word is what it shares from the start with each other spelling of it; a
    word that a change of spelling over several words could make or break is left out.
    """
    forms = [canonical_text(t) for _, t in known]
    loose = {w for pair in SPELLINGS if " " in pair[0] + pair[1] for side in pair for w in side.split()}
    of = []
    for form in forms:
        found = set()
        for word in form.split():
            variants = {word} | {old for old, new in SPELLINGS if new == word}
            stem = os.path.commonprefix(sorted(variants))
            if len(stem) >= 5 and not any(x in word for x in loose):
                found.add(stem)
        of.append((form, found))
    chosen: list[str] = []
    left = [x for x in of if x[0]]
    while left:
        counts = Counter(s for s in {s for _, f in left for s in f} for form, _ in left if s in form)
        if not counts:
            return [""]  # a known text without a sure stem: every unit is asked
        best = max(counts, key=lambda s: (counts[s], len(s), s))
        chosen.append(best)
        left = [x for x in left if best not in x[0]]
    return chosen


def has_stem(text: Column, stems_: list[str]) -> Column:
    out = F.lit(False)
    for s in stems_:
        out = out | F.contains(text, F.lit(s))
    return out


def digest(text: Column) -> Column:
    """sha256 of the canonical form; null if it is empty."""
    c = canonical(text)
    return F.when(c != "", F.sha2(c.cast("binary"), 256))


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN, digests: tuple[tuple[str, str], ...] = DIGESTS) -> DataFrame:
    rows = spark.createDataFrame(list(known), "license string, text string").select("license", digest(F.col("text")).alias("digest"))
    rows = rows.unionByName(spark.createDataFrame(list(digests), "license string, digest string"))
    return rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("license").alias("license"))


def scan_licenses(docs: DataFrame, texts: tuple[tuple[str, str], ...] = KNOWN, broadcast_rows: int = 100_000, digests: tuple[tuple[str, str], ...] = DIGESTS) -> DataFrame:
    """(doc_id, whole, n_notices, licenses) of every row of ``docs``.

    ``whole`` is the license that the entire text is; ``n_notices`` counts lines that are
    a known text; ``licenses`` are all names found, sorted, comma-joined, or empty.
    """
    known = known_digests(docs.sparkSession, texts, digests)
    asked = sorted({*stems(texts), *(["licen"] if digests else [])})
    if known.limit(broadcast_rows + 1).count() <= broadcast_rows:
        known = F.broadcast(known)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.coalesce("text", F.lit(""))).alias("text"))
    # Rows are named by id and text: what equal rows hold is the same.
    docs = docs.withColumn("mark", F.when(has_stem(F.col("text"), asked), F.md5("text")))
    unit = lambda kind, parts: F.transform(parts, lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("part")))
    units = F.concat(unit("text", F.array("text")), unit("paragraph", F.split("text", r"\n\s*\n")), unit("line", F.split("text", "\n")))
    found = docs.where("mark IS NOT NULL").select("doc_id", "mark", F.posexplode(units).alias("place", "u")).where(has_stem(F.col("u.part"), asked))
    found = found.select("doc_id", "mark", "place", "u.kind", digest(F.col("u.part")).alias("digest")).join(known, "digest").dropDuplicates(["doc_id", "mark", "place"])
    of = found.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(
        F.max(F.when(F.col("kind") == "text", F.col("license"))).alias("whole"),
        F.sum((F.col("kind") == "line").cast("long")).alias("n_notices"),
        F.array_join(F.sort_array(F.collect_set("license")), ",").alias("licenses"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    return docs.select("doc_id", "mark").join(of, same, "left").select("doc_id", "whole", F.coalesce("n_notices", F.lit(0)).alias("n_notices"), F.coalesce("licenses", F.lit("")).alias("licenses"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licenses in the whole of ``documents``."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    """The same lookup in DuckDB; its patterns have no lookahead, so lines are left out one by one."""
    matches = lambda p: "regexp_matches(x, '{}')".format(p.replace("\\b", "([^a-z0-9_]|$)"))
    silent = f"((({matches(STATEMENT)} OR ({matches(HOLDER)} AND NOT {matches(NO_HOLDER)})) AND NOT {matches(LONG)}) OR NOT {matches('[a-z0-9]')})"
    kept = f"list_filter(regexp_split_to_array(lower(t), '\\n\\s*\\n'), lambda p: len(list_filter(string_split(p, chr(10)), lambda x: NOT {silent})) > 0)"
    lines = f"string_split(array_to_string({kept}, chr(10)), chr(10))"
    begin = f"list_position(list_transform({lines}, lambda x: NOT {silent}), true)"
    form = f"CASE WHEN {begin} > 0 THEN array_to_string(({lines})[{begin}:], ' ') ELSE '' END"
    form = f"trim(regexp_replace({form}, '[^a-z0-9]+', ' ', 'g'))"
    for old, new in SPELLINGS:
        form = f"regexp_replace({form}, '\\b{old}\\b', '{new}', 'g')"
    values = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in KNOWN)
    digests = ", ".join(f"('{a}', '{b}')" for a, b in DIGESTS)
    return f"""
WITH k AS (SELECT c, min(license) AS license FROM (SELECT license, sha256({form}) AS c FROM (VALUES {values}) v(license, t) UNION ALL SELECT * FROM (VALUES {digests})) GROUP BY c),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
u AS (SELECT r, 'text' AS kind, t FROM d UNION ALL SELECT r, 'paragraph', unnest(regexp_split_to_array(t, '\\n\\s*\\n')) FROM d
      UNION ALL SELECT r, 'line', unnest(string_split(t, chr(10))) FROM d),
f AS (SELECT u.r, u.kind, k.license FROM (SELECT r, kind, {form} AS c FROM u) u JOIN k ON k.c = sha256(u.c) AND u.c <> ''),
g AS (SELECT r, max(license) FILTER (kind = 'text') AS whole, count(*) FILTER (kind = 'line') AS n_notices,
      array_to_string(list_sort(list(DISTINCT license)), ',') AS licenses FROM f GROUP BY r)
SELECT d.doc_id, g.whole, coalesce(g.n_notices, 0)::BIGINT AS n_notices, coalesce(g.licenses, '') AS licenses FROM d LEFT JOIN g USING (r)
"""


ORACLE_SQL = _oracle()

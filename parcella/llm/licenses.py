"""License scan by canonical digest.

A text is reduced to a canonical form (copyright lines dropped, lower case, equivalent
spellings united, punctuation and white space folded to one space) and its MD5 digest
is hash-joined to the digests of known licences. The same is done for every single
line, so a licence statement inside other prose is found too: a line's digest is looked up
in the plan's list of the known statements' digests. Everything is one pass
of built-in functions; the known licences are a fixed table: the texts in
``license_texts`` and the usual one-line statements, which the README lists.

Defined cases: a null text has a null digest and no licence; a text without letters or
digits has the digest of the empty text; a text of any length is folded whole, within its
row; a digest of two licences has the first by name; repeated rows stay; an empty table gives
an empty result; extra columns are ignored unless asked for with ``keep``.
"""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Equivalent spellings, united to the second form.
SPELLINGS = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("organisation", "organization"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("authorised", "authorized"),
    ("whilst", "while"),
    ("per cent", "percent"),
    ("http:", "https:"),
    ("&", "and"),
)

#: A line that only names the owner of the rights. Group 1 keeps the line break before it.
COPYRIGHT_LINE = (
    r"(?i)(^|\n)[^\p{L}\p{N}\n]*(?:copyright[^\p{L}\p{N}\n]*(?:\(c\)|©|[0-9]{4}|<|\[)"
    r"|\(c\)[^\p{L}\p{N}\n]*[0-9]{4}|©)[^\n]*"
)
SEPARATORS = r"[^\p{L}\p{N}\n]+"

# Whole licences, as their stewards publish them.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this
software and associated documentation files (the "Software"), to deal in the Software without
restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or
substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE
AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License
is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied. See the License for the specific language governing permissions and limitations under the
License."""
MPL_NOTICE = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
If a copy of the MPL was not distributed with this file, You can obtain one at
https://mozilla.org/MPL/2.0/."""

# Licences and the names that statements give them.
NAMES = {
    "MIT": ("the MIT License", "MIT", "the MIT license (MIT)"),
    "ISC": ("the ISC License", "ISC"),
    "0BSD": ("the BSD Zero Clause License", "0BSD"),
    "BSD-2-Clause": ("the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License"),
    "Apache-2.0": (
        "the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License",
        "the Apache Software License, Version 2.0", "Apache-2.0",
    ),
    "MPL-1.1": ("the Mozilla Public License, version 1.1", "MPL 1.1"),
    "MPL-2.0": ("the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0", "MPL 2.0"),
    **{
        f"{short}-{v}.0".replace(".1.0", ".1"): tuple(
            x.format(v=v, long=long, short=short)
            for x in (
                "the GNU {long} General Public License, version {v}", "the GNU {long} General Public License v{v}",
                "the GNU {long} General Public License version {v} or later",
                "the GNU {long} General Public License, version {v} or any later version",
                "the GNU {short} v{v}", "the {short} v{v}", "the GNU {short}, version {v}", "{short}v{v}", "the {short}v{v}",
            )
        )
        for short, long, v in (
            ("GPL", "", 1), ("GPL", "", 2), ("GPL", "", 3), ("LGPL", "Lesser", 2.1), ("LGPL", "Lesser", 3),
            ("LGPL", "Library", 2), ("AGPL", "Affero", 3),
        )
    },
    "GFDL-1.2": ("the GNU Free Documentation License, version 1.2",),
    "GFDL-1.3": ("the GNU Free Documentation License, version 1.3",),
    "BSL-1.0": ("the Boost Software License, Version 1.0", "the Boost Software License 1.0"),
    "Zlib": ("the zlib License",),
    "Unlicense": ("the Unlicense", "The Unlicense license"),
    "EPL-1.0": ("the Eclipse Public License 1.0", "the Eclipse Public License v1.0"),
    "EPL-2.0": ("the Eclipse Public License 2.0", "the Eclipse Public License v2.0"),
    "OFL-1.1": ("the SIL Open Font License, Version 1.1", "the SIL Open Font License 1.1"),
    "NCSA": ("the University of Illinois/NCSA Open Source License",),
    "CC0-1.0": ("CC0 1.0", "CC0", "the CC0 1.0 Universal License"),
    **{
        f"CC-{short.replace(' ', '-')}-{v}": (
            f"CC {short} {v}", f"a CC {short} {v} License", f"the CC {short} {v} License",
            *(f"{a} Creative Commons {long} {v} {port} License" for a in ("a", "the")),
        )
        for short, long in (
            ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
        for v, port in (("3.0", "Unported"), ("4.0", "International"))
    },
}
OPENINGS = (
    "Licensed under", "Released under", "Distributed under", "Available under", "This work is licensed under",
    "This software is licensed under", "This project is licensed under", "SPDX-License-Identifier:",
)


def statements() -> tuple[tuple[str, str], ...]:
    """(licence, line) of the usual statements; an SPDX line has the identifier alone."""
    return tuple(
        (name, f"{opening} {said}.")
        for name, titles in NAMES.items()
        for opening in OPENINGS
        for said in ((name, f"{name}-only", f"{name}-or-later") if opening.endswith(":") else titles)
        if not said.endswith(("-only", "-or-later")) or "GPL" in name
    )


def whole_texts() -> tuple[tuple[str, str], ...]:
    """(licence, text) of the files in ``license_texts``, with and without title, appendix
    and numbering where these are often left out. A name ends before ``~``."""
    out = []
    for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        name, text = file.stem.split("~")[0], file.read_text("utf-8")
        if name.startswith("BSD-"):
            body = text[text.index("Redistribution and use") :]
            out += [
                (name, f"{title}\n{rights}\n{form}")
                for title in ("", f"BSD {name[4]}-Clause License", f"The BSD {name[4]}-Clause License")
                for rights in ("", "All rights reserved.")
                for form in (body, re.sub(r"(?m)^\s*[123]\. ", "* ", body))
            ]
            continue
        out.append((name, text))
        head, end, tail = text.partition("END OF TERMS AND CONDITIONS")
        if end and tail:
            out += [(name, head), (name, head + end)]
        for title in {"Zlib": ("zlib License",), "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD")}.get(name, ()):
            out.append((name, f"{title}\n{text}"))
    return tuple(out)


# Fixed values: (licence, text) of whole licences and of one-line statements.
KNOWN = (
    ("MIT", MIT),
    ("MIT", "MIT License\n\n" + MIT),
    ("MIT", "The MIT License\n\n" + MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", ISC),
    ("ISC", "ISC License\n\n" + ISC),
    ("Apache-2.0", APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MPL-2.0", MPL_NOTICE),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
    ("LicenseRef-All-Rights-Reserved", "All rights reserved."),
    *statements(),
    *whole_texts(),
)


def canonical_lines(text: Column) -> Column:
    """Canonical form that still has the line breaks."""
    out = F.lower(F.regexp_replace(text, COPYRIGHT_LINE, "$1"))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.regexp_replace(out, SEPARATORS, " ")


def whole(lines: Column) -> Column:
    """Canonical form of the entire text: every break is one space."""
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def known_licenses(spark, known=KNOWN) -> DataFrame:
    """``digest, license``: digests of the known texts; equal ones unite by name order."""
    texts = spark.createDataFrame(list(known), "license string, text string")
    return (
        texts.select(F.md5(whole(canonical_lines(F.col("text")))).alias("digest"), "license")
        .groupBy("digest")
        .agg(F.min("license").alias("license"))
    )


def scan(docs: DataFrame, known=KNOWN, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``keep`` columns, ``digest`` of the canonical text,
    ``license`` of the entire text (null if unknown), ``line_licenses`` (sorted names of
    licences that stand as a line) and ``n_license_lines``.

    ``known`` is a list that fits a query plan (some thousand entries at most): its
    digests travel as literals for the lines and as a small join side for whole texts.
    """
    listed = {r.digest: r.license for r in known_licenses(docs.sparkSession, known).collect()}
    digests = F.array(*(F.lit(d) for d in sorted(listed)))
    names = F.create_map(*(F.lit(x) for d in sorted(listed) for x in (d, listed[d])))
    ids = [F.col(f"`{c}`") for c in keep]
    forms = docs.select(*ids, canonical_lines(F.col(f"`{text}`")).alias("_lines"))
    hashed = forms.select(
        *ids,
        F.md5(whole(F.col("_lines"))).alias("digest"),
        F.transform(F.split("_lines", "\n"), lambda x: F.md5(F.trim(x))).alias("_each"),
    )
    found = hashed.select(
        *ids,
        "digest",
        F.array_intersect("_each", digests).alias("_kinds"),
        F.when(
            F.arrays_overlap("_each", digests),
            F.size(F.filter("_each", lambda x: F.array_contains(digests, x))),
        )
        .otherwise(0)
        .cast("long")
        .alias("n_license_lines"),
    )
    sides = docs.sparkSession.createDataFrame(sorted(listed.items()), "_digest string, license string")
    return found.join(sides, F.col("digest") == F.col("_digest"), "left").select(
        *ids,
        "digest",
        "license",
        F.coalesce(
            F.array_sort(F.array_distinct(F.transform("_kinds", lambda d: names[d]))),
            F.array().cast("array<string>"),
        ).alias("line_licenses"),
        "n_license_lines",
    )

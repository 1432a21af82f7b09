"""Licence scans by canonical digest lookup.

A text is brought to canonical form: ASCII lower case, equivalent spellings replaced, lines that
begin with a copyright mark dropped, runs of punctuation and white space made one space. The SHA-256 digest of the
whole canonical text is joined with the digests of known licences, made by the same
expression. The list of known texts is counted before it is broadcast; beyond that it is joined by a shuffle of
digests. Of long licences only the digests are kept, of whole texts and of those without their appendix. Besides, each sentence of a text
is compared, in the same canonical form, with known notices and with the names of licences behind phrases such as `licensed under`.

Only digests are joined; the documents' texts are read once and never shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbrule.workspace import broadcast_if_small

# Known texts and spellings.
LICENSES = {
    "MIT": """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH
THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """ISC License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Zlib": """Copyright (c) <year> <owner>

This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
    "BSD-2-Clause": """Copyright (c) <year> <owner>. All rights reserved.

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
}
LICENSES["BSD-3-Clause"] = LICENSES["BSD-2-Clause"].replace(
    "THIS SOFTWARE IS PROVIDED",
    """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED""",
    1,
)
TITLES = {"MIT": "MIT License", "ISC": "ISC License", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License", "Zlib": "zlib License"}
DIGESTS = {
    "0933e9fdf25f8a4aced10e10246650350123e13b939182f69b5ec6730ce2d793": "Apache-2.0",
    "0d5838e6f6e5a374e58d608af5c01bc6a67cf18552dd7b346e5aef652b808ee9": "Apache-2.0",
    "3f3112fe3656909b8bf79c7ec7988f83a43b47aeadf2b7d62205aaf449d9f1be": "Apache-2.0",
    "93c166a0858ad5fc8ee860a087818d84b9afe007ed085d189dd32c12f841d3c6": "Apache-2.0",
    "a59acb355ce555a1fa4343147138e7cf6fa02a8efa49c4b10b8a5b9e9ace8911": "Apache-2.0",
    "a657010cc8660623635462386107381af70d2c7ec43ab36e27484c72cbb3b28f": "Apache-2.0",
    "3d151449461c0c776e892a4dc41cac0d251eb00c9fc49d2d48802d9bed818fe9": "BSD-3-Clause",
    "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f": "CC0-1.0",
    "19d29a7c800a0d85704b63b4c09d5cd01dd9a287c61e238f4717d8a9e75d214f": "GFDL-1.2",
    "835e93c269f96ffb287b3c8c1c5d41482a48fe84971237b192ae3d0f85299142": "GFDL-1.2",
    "2d23a1792689607291f114da9fdb3b413c6ef2346dfb9e4fafe0c5cf9b969da3": "GFDL-1.3",
    "e70f40f3a50995855f972521fe4eaa4af360a4597e5914977b6093cce5243480": "GFDL-1.3",
    "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc": "GPL-1.0",
    "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70": "GPL-1.0",
    "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224": "GPL-1.0",
    "a1e7ba14d8d85807f384435b77f91e925decc43da128311c991c4f2337e44017": "GPL-2.0",
    "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1": "GPL-2.0",
    "e4d14510e41435c3eb12c255b72546a3cb9943f06f209c72bc30a19095b08999": "GPL-2.0",
    "010ce52b3b970c80b5447205f4afc3b42084811cda2d11b95178b1fd3940764f": "GPL-3.0",
    "3d4de016a08e1d98b27dec755cdf4530b92807d97aaa185b32e12d52942b1943": "GPL-3.0",
    "3dcf77ad8c25248618918aaff1de8a2cb80cea6ca922ef4a7a389cca96a7560b": "GPL-3.0",
    "f3ab5ee40da170411ea6671f9845ada2aaba303ee57ba6086b373d1e66c9dc3f": "GPL-3.0",
    "9b0b3105b96203f9d9e4b72d4b77951152156c88139302b5aedf6295e3ceaaa3": "LGPL-2.0",
    "e0de5033b5ad2a24c0a1a8b04f09e33038ffa62d2bef7178de2a3c6f5d56f499": "LGPL-2.0",
    "ff773d8d898dfc51ae2dbf3baa20700673e8ceb153b13d26c525af34a59adf0c": "LGPL-2.0",
    "963f79d48038eed98d8341c84d8d3b765e99508a738d00654c0112f70a7c370c": "LGPL-2.1",
    "9bf9c99aeafbdbccd7456a00d574699e3deb41868375496cacbf170be719bebd": "LGPL-2.1",
    "cb225061bb71741fe8b31a2092e22fe05b1130438158ae5d16c48fd50186e345": "LGPL-2.1",
    "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be": "LGPL-3.0",
    "f77c59051c0127d677dcce7ba0d4733294974749a7b4155250912498d92767d6": "MPL-1.1",
    "fbe9a0b96f52e03cb474f9a7083781399c011279e85b548118563ec96e659354": "MPL-1.1",
    "2cec6f733aa157c2d0b72e9669f75ca354f332218fcb5a3a885931f385272a04": "MPL-2.0",
    "8f0473f9c917c507827dca355168119bb065ca1a9dab0e366988bcdba5fa039b": "MPL-2.0",
    "9e79a7d513376f6fa1500e4df4f6276c6e7e61c5c3e28dcdb1acee24033acc56": "MPL-2.0",
    "8d3909f4543649cfba0b0b1fc765c67acf3736106a78237ea2972f83eaa7dd3e": "Unlicense",
    "e2380bdfe57ca73b01d0b1848a4ee630998d729b260e63082b9267100b4a7229": "Unlicense",
}
NOTICES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0."),
    "MIT": ("Released under the MIT License.", "Licensed under the MIT License."),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v3.0.",
    ),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.",),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    "proprietary": ("All rights reserved.",),
}
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"),
    "MIT": ("MIT License", "MIT"),
    "ISC": ("ISC License",),
    "Zlib": ("zlib License",),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPLv2", "GPL-2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3", "GPL-3.0"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1", "LGPL-2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPLv3", "LGPL-3.0"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL-2.0"),
    "Unlicense": ("Unlicense",),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC0-1.0": ("CC0 1.0",),
}
# In canonical form, where a line is a sentence; what follows is the name.
SPOKEN = (
    r"(?m)^ *(?:(?:this|the) \w+ is |it is )?(?:dual )?(?:licensed|released|distributed|published|available|made available|provided)"
    r" under (?:the )?(?:terms of (?:the )?)?([^\n]+?) *$"
)
SPELLINGS = (
    ("licence", "license"), ("acknowledgement", "acknowledgment"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("copyright owner", "copyright holder"), ("favour", "favor"), ("fulfilment", "fulfillment"), ("non-infringement", "noninfringement"),
    ("non-commercial", "noncommercial"), ("per cent", "percent"), ("sub-license", "sublicense"), ("merchantibility", "merchantability"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT_LINE = r"(^|\n)[ \t]*(copyright|©|\(c\))[^\n]*"
SENTENCE_END = r"[.!?;:]+(?=\s|$)"
PUNCTUATION = r"[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F“”‘’«»–—…©]+"


def canonical_lines(text: Column) -> Column:
    """The canonical form with a line end behind every sentence and line."""
    form = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    for old, new in SPELLINGS:
        form = F.replace(form, F.lit(old), F.lit(new))
    sentences = F.regexp_replace(F.regexp_replace(form, COPYRIGHT_LINE, "\n"), SENTENCE_END, "\n")
    return F.regexp_replace(sentences, PUNCTUATION, " ")


def whole(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def variants() -> list[tuple[str, str]]:
    """(license_id, text) of LICENSES with and without title, with and without numbers before the clauses."""
    rows = []
    for name, text in LICENSES.items():
        plain = text.removeprefix(TITLES[name])
        bullets = re.sub(r"(?m)^\d\.", "*", plain)
        rows += [(name, form) for form in (plain, bullets, f"{TITLES[name]}\n{plain}", f"{TITLES[name]}\n{bullets}")]
    return rows


def known_licenses(spark: SparkSession, licenses: dict[str, str] | None = None) -> DataFrame:
    """(license_id, text) of the licences that come with the library as texts, or of `licenses`."""
    rows = variants() if licenses is None else list(licenses.items())
    return spark.createDataFrame(rows, "license_id string, text string")


def scan_licenses(docs: DataFrame, known: DataFrame | None = None, notices: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, digest, license_id, notices.

    `license_id` is the known licence that the whole text is, or NULL; of several with one digest the first by code point. `notices` are
    the sorted ids of the notices among the text's sentences; without `notices` also of the licences that a sentence names. `docs` needs doc_id and text; further columns are ignored. NULL
    texts count as empty, and texts empty in canonical form have the digest of the empty text and no licence.
    """
    spark = docs.sparkSession
    listed = known_licenses(spark) if known is None else known
    digests = listed.select(
        F.sha2(whole(canonical_lines(F.col("text"))), 256).alias("digest"), "license_id", whole(canonical_lines(F.col("text"))).alias("form")
    )
    digests = digests.filter("form <> ''").select("digest", "license_id")
    if known is None:
        digests = digests.union(spark.createDataFrame(list(DIGESTS.items()), "digest string, license_id string"))
    digests = digests.groupBy("digest").agg(F.min("license_id").alias("license_id"))
    pairs = [(name, line) for name, lines in (NOTICES if notices is None else notices).items() for line in lines]
    spoken = F.array(*(F.struct(F.lit(name).alias("id"), whole(canonical_lines(F.lit(line))).alias("form")) for name, line in pairs))
    names = [(name, form) for name, forms in (NAMES if notices is None else {}).items() for form in forms]
    called = F.array(*(F.struct(F.lit(name).alias("id"), whole(canonical_lines(F.lit(form))).alias("form")) for name, form in names))
    named = F.transform(F.regexp_extract_all("lines", F.lit(SPOKEN), F.lit(1)), lambda name: F.regexp_replace(name, " +", " "))
    lines = F.split("lines", "\n")
    formed = docs.select("doc_id", canonical_lines(F.col("text")).alias("lines"))
    shaped = formed.select(
        "doc_id",
        F.sha2(whole(F.col("lines")), 256).alias("digest"),
        F.array_distinct(F.transform(lines, lambda line: F.trim(F.regexp_replace(line, " +", " ")))).alias("forms"),
        named.alias("named"),
    )
    if pairs:
        heard = F.filter(spoken, lambda notice: F.array_contains("forms", notice["form"]))
        found = F.array_sort(F.array_distinct(F.transform(heard, lambda notice: notice["id"])))
    else:
        found = F.expr("CAST(array() AS array<string>)")
    if names:
        heard = F.filter(called, lambda name: F.array_contains("named", name["form"]))
        heard = F.when(F.size("named") > 0, F.transform(heard, lambda name: name["id"])).otherwise(F.expr("CAST(array() AS array<string>)"))
        found = F.array_sort(F.array_union(found, heard))
    rows = shaped.select("doc_id", "digest", found.alias("notices"))
    return rows.join(broadcast_if_small(digests), "digest", "left").select("doc_id", "digest", "license_id", "notices")


def license_report(docs: DataFrame) -> DataFrame:
    return scan_licenses(docs).select("doc_id", "digest", "license_id", F.array_join("notices", ",").alias("notices"))

"""Licence scans by canonical digests.

A text is brought to a canonical form: lower case, copyright lines left out, equivalent spellings made one, punctuation and
white space made single spaces.  Its SHA-256 digest is looked up among those of known licence texts, brought to the same
form.  Whole texts are looked up, and the single lines of a text and every two that follow each other as well, for licence
notices that stand in other text, also where they are wrapped.

The list of known texts is a parameter (name, text).  With the module come short licences and notices, the whole texts in
the folder licence_texts (each also without its appendix), and notices made of the names of licences.
Null and empty texts have no canonical form and match nothing.  Repeated rows are looked up alike.  Extra columns are
ignored.  An empty table gives an empty result.  If two known texts have the same canonical form the smaller name is used.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from importlib import resources

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmill.llm.shared import in_arrow, row_key, written

#: The known texts are broadcast only if they are no more than this.
SMALL = 20_000
#: Spellings that count as equal, as in the matching guidelines for licence lists; a fixed list.
SPELLINGS = {
    "licence": "license", "licences": "license", "licenses": "license", "licenced": "licensed", "licencing": "licensing", "sublicence": "sublicense", "sublicences": "sublicense",
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization", "authorised": "authorized",
    "calibre": "caliber", "cancelled": "canceled", "catalogue": "catalog", "categorise": "categorize", "centre": "center",
    "emphasised": "emphasized", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill", "fulfilment": "fulfillment", "initialise": "initialize",
    "judgement": "judgment", "labelling": "labeling", "labour": "labor", "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "offence": "offense",
    "optimise": "optimize", "organisation": "organization", "organise": "organize", "practise": "practice", "programme": "program", "realise": "realize",
    "recognise": "recognize", "signalling": "signaling", "utilisation": "utilization", "whilst": "while", "wilful": "willful", "https": "http",
}
PHRASES = (("sub license", "sublicense"), ("non infringement", "noninfringement"), ("copyright holder", "copyright owner"), ("copyright holders", "copyright owners"), ("per cent", "percent"), ("owner s", "owners"))
COPYRIGHT_LINE = re.compile(r"(?im)^[ \t*#/;\-]*(?:portions\s+)?(?:copyright\b[^\n]*(?:\(c\)|\xA9|\d{4}|<year>|\[year\])|\(c\)\s*\d{4}|\xA9)[^\n]*$|^[ \t*#/;\-]*all rights reserved\.?[ \t]*$")
BREAK = re.compile(r"[\W_]+")
LINE = re.compile(r"\r\n|\r|\n")

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_NAME = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
#: Known texts: short licences in full, and one-line notices; a fixed list.
KNOWN = (
    ("MIT", MIT), ("MIT", "MIT License\n\n" + MIT), ("MIT", "The MIT License (MIT)\n\n" + MIT), ("ISC", ISC), ("ISC", "ISC License\n\n" + ISC),
    ("BSD-2-Clause", BSD_HEAD + BSD_TAIL), ("BSD-2-Clause", "BSD 2-Clause License\n\n" + BSD_HEAD + BSD_TAIL), ("BSD-3-Clause", BSD_HEAD + BSD_NAME + BSD_TAIL), ("BSD-3-Clause", "BSD 3-Clause License\n\n" + BSD_HEAD + BSD_NAME + BSD_TAIL),
    ("notice:MIT", "Released under the MIT License."), ("notice:MIT", "Licensed under the MIT License."),
    *((f"notice:Apache-{v}", f"{verb} under the Apache License, Version {v}.") for v in ("1.1", "2.0") for verb in ("Licensed", "Released")),
    *((f"notice:GPL-{v}.0", f"This work is licensed under the GNU General Public License, version {v}.") for v in (2, 3)),
    *((f"notice:CC-{kind}-{v}", f"{verb} under CC {kind} {v}.") for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for v in ("3.0", "4.0") for verb in ("Licensed", "Released")),
    ("notice:reserved", "All rights reserved."),
)


#: Licences by name, as notices put them, and what may stand before.
NAMES = (
    ("MIT", "the MIT License"), ("ISC", "the ISC License"), ("Zlib", "the zlib License"), ("Unlicense", "the Unlicense"), ("BSL-1.0", "the Boost Software License, Version 1.0"),
    ("BSD-2-Clause", "the BSD 2-Clause License"), ("BSD-3-Clause", "the BSD 3-Clause License"), ("CC0-1.0", "CC0 1.0"),
    *((f"Apache-{v}", f"{name}{v}") for v in ("1.1", "2.0") for name in ("the Apache License, Version ", "the Apache License ")),
    *((f"MPL-{v}", f"the Mozilla Public License{at}{v}") for v in ("1.1", "2.0") for at in (", version ", " ")),
    *((f"{short}-{v}", f"the GNU {kind} Public License{at}{v.removesuffix('.0')}") for short, kind, versions in (("GPL", "General", ("1.0", "2.0", "3.0")), ("LGPL", "Lesser General", ("2.1", "3.0")), ("AGPL", "Affero General", ("3.0",))) for v in versions for at in (", version ", " v")),
    *((f"CC-{kind}-{v}", f"{the}CC {kind} {v}{end}") for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND") for v in ("1.0", "2.0", "2.5", "3.0", "4.0") for the, end in (("", ""), ("the ", " license"))),
)
VERBS = ("Licensed", "Released", "Distributed", *(f"This {thing} is {verb}" for thing in ("work", "software", "project", "program", "file", "library", "code") for verb in ("licensed", "released", "distributed")))
APPENDIX = re.compile(r"(?m)^\s*END OF TERMS AND CONDITIONS\s*$")


def listed_texts() -> list[tuple[str, str]]:
    """(name, text) of all that comes with the module."""
    rows = [*KNOWN, *((f"notice:{name}", f"{verb} under {put}.") for name, put in NAMES for verb in VERBS)]
    for file in sorted(resources.files("chartmill.llm").joinpath("licence_texts").iterdir(), key=lambda f: f.name):
        name, text = file.name.removesuffix(".txt"), file.read_text(encoding="utf-8")
        end = APPENDIX.search(text)
        rows += [(name, text)] + ([(name, text[: end.start()]), (name, text[: end.end()])] if end else [])
    return rows


def words(text: str) -> str:
    """Lower case, punctuation as spaces, and one spelling for words that have several."""
    plain = " ".join([SPELLINGS.get(w, w) for w in BREAK.sub(" ", text.lower()).split()])
    for found, wanted in PHRASES:
        if found in plain:
            plain = f" {plain} ".replace(f" {found} ", f" {wanted} ").strip()
    return plain


def canonical(text: str) -> str:
    """The canonical form of a whole text; empty if nothing is left."""
    return words(COPYRIGHT_LINE.sub(" ", text))


def digest(form: str) -> str | None:
    return hashlib.sha256(form.encode("utf-8", "surrogatepass")).hexdigest() if form else None


def notices(text: str) -> Iterator[str]:
    """The forms of the lines of a text, and of each two that follow each other."""
    lines = LINE.split(text)
    yield from map(words, lines)
    yield from (words(f"{a} {b}") for a, b in zip(lines, lines[1:], strict=False))


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, licence) of known texts (name, text).  A text of copyright lines only is taken as it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array([digest(canonical(t) or words(t)) for t in texts], pa.string()), batch.column(0)], names=["digest", "name"])

    found = in_arrow(known.select("name", "text"), run, "digest string, name string")
    rows = found.where("digest is not null").groupBy("digest").agg(F.min("name").alias("licence"))
    return F.broadcast(rows) if rows.limit(SMALL + 1).count() <= SMALL else rows


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, key, digest, lines): the digest of each whole text and those of its `notices`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = [t.as_py() or "" for t in part.column(2)]
                lines = [list({digest(form) for form in notices(t)} - {None}) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([digest(canonical(t)) for t in texts], pa.string()), pa.array(lines, pa.list_(pa.string()))],
                    names=["doc_id", "key", "digest", "lines"],
                )

    rows = docs.select("doc_id", row_key("doc_id", "text").alias("key"), F.col("text").cast("string").alias("text"))
    return in_arrow(rows, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, key struct<a:long,b:long>, digest string, lines array<string>")


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, digest of its canonical form, the licence that this is, if any, how many of its
    different lines, or of two together, are known texts, and which, in order."""
    spark = docs.sparkSession
    listed = known_digests(known if known is not None else spark.createDataFrame(listed_texts(), "name string, text string"))
    rows = written(digests(docs), "digests")
    # Known lines are few; only these are shuffled.
    found = rows.select("key", F.explode("lines").alias("digest")).join(listed, "digest").distinct()
    # Names are those of known texts, so the list is bounded by theirs.
    per_doc = found.groupBy("key").agg(F.count("*").alias("n_lines"), F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("line_licences"))
    out = rows.select("doc_id", "key", "digest").join(listed, "digest", "left").join(per_doc, "key", "left")
    return out.select("doc_id", "digest", "licence", F.coalesce("n_lines", F.lit(0)).cast("long").alias("n_lines"), F.coalesce("line_licences", F.lit("")).alias("line_licences"))

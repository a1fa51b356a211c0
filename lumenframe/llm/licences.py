"""Licence scan by canonical digest: whole texts in canonical form are hash-joined to the digests of known licences.

DataFrame functions only. Canonical form: A-Z in lower case, a title and copyright lines dropped, equivalent spellings made
one, every run of other ASCII characters than letters and digits made one space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# Texts of licences and notices, public wording.
KNOWN = {
    "MIT": [
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
        "Released under the MIT License.",
        "Licensed under the MIT License.",
    ],
    "ISC": [
        'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    ],
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
        "Licensed under the Apache License, Version 2.0.",
    ],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
}
# SHA-256 of the canonical forms of licences' published texts (with and without their appendices, and the usual
# variants of a few words), as ``known_digests`` makes them of the texts.
DIGESTS = {
    "MIT": ["0cf21bdfd1964a97a8615e128534845826afbc887edc95aa5c925cbf64386b5c"],
    "ISC": ["217da0747cec63a2e734185db11cbaa819bcd9e5b83cd12f812128fffe66e26a"],
    "0BSD": ["25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c"],
    "BSD-2-Clause": ["a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30", "032f33a9fad178d38ba062bc5f6e47fde5eb48f13d4c8895fe1360e806c83a69", "5151319f99abfc15f9a1aab05c799faf3b0e5715fac5a5812b9d3566ae984374", "7be8178e4e9d0dea6ff4b04bd52bd086d7ea8386a5a6e09760df916bae5d42d2", "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74"],
    "BSD-3-Clause": ["9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2", "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa", "526279aa5ce65fb23ffd45ae5430abc95af7bd6118ff94cc2842185ce6aa2c02", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"],
    "Apache-2.0": ["c1c0704caa0bece8e9cf965100efe6a1e373c1d95c51aa5a681849640719d9e7", "622fc03e7533c5f35400f87ba05aef4aa91efa281c18741e99ef504cc8c78ad0", "825221f68d3a9d54228c2cd25f51e3199698e2b9880fcfcb5b814637dd090b0f", "3aa88fd36fd7dc55bdb5022559e9c79077648f60c559407ec2d92bde674b0141", "02e0387d62d515d993e09c20b262e2e7cd6264f465579d65d530b728b5bc4cc2"],
    "GPL-1.0": ["8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"],
    "GPL-2.0": ["efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821", "42a2063beecb82de51a227e52a22e4acf4fa0d052827262e6bb57835e02e10e9"],
    "GPL-3.0": ["a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68", "45d55e6a1f1db973422ccbae8d15b1ad6389e7c384bfc422b46f5e230b86ecaf"],
    "LGPL-2.0": ["61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908", "0e3c184176a70698802350b8f697a92e908601a66f8f622e8d4c08c9e90e0a8f"],
    "LGPL-2.1": ["4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891", "45ab1a2a290e74e8c905ed1fbb6a81f1d48fe964330aa7855ba1aa1f88306f09"],
    "LGPL-3.0": ["aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"],
    "MPL-1.1": ["3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1"],
    "MPL-2.0": ["f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a", "9eab7902f21bef0326dee4ed0cae1402c781cbf1f8e3dbeed6fbe176d641bb13"],
    "GFDL-1.2": ["5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"],
    "GFDL-1.3": ["93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"],
    "Artistic-1.0": ["e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"],
    "CC0-1.0": ["96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"],
    "Unlicense": ["e2380bdfe57ca73b01d0b1848a4ee630998d729b260e63082b9267100b4a7229"],
    "Zlib": ["1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7"],
    "BSL-1.0": ["5fcf89bde8c0c2deb999f4cc626e1aebf90e80fdc5cd334dae008152ef4a1ded"],
    "BlueOak-1.0.0": ["6cffa606d4960a0fadb3c8161a99b92c53dbe7b999697a5e26d35cfdc1d80f3d"],
}
#: Known texts that a scan takes at most, as their table is sent to every task.
KNOWN_MAX = 10_000
# Spellings that licence matching guidelines treat as equal.
SPELLINGS = {"licence": "license", "licenced": "licensed", "sub license": "sublicense", "non commercial": "noncommercial", "per cent": "percent", "organisation": "organization", "favour": "favor", "fulfil": "fulfill", "merchantibility": "merchantability"}
# Lines that state a copyright (the word with a sign, a year, a place for one or an address), after comment marks; a first line
# that is a licence's name, where text follows.
COPYRIGHT = r"(^|\n)[ \t#*/;%!-]*((\(c\)[ \t]*)?copyright[ \t:,]*(\(c\)|©|[0-9]{4}|[<\[{]|[^\n]*(, inc|https?://|@[a-z]))|\(c\)[ \t]*[0-9]{4}|©|all rights reserved)[^\n]*"
TITLE = r"^[ \t\r\n#*/;=-]*\(?(?:the )?(?:mit|isc|x11|zlib|apache|boost software|(?:new |simplified |modified )?bsd(?: [0-4]-clause)?(?: \"?(?:new|simplified|revised|original)\"?)?(?: or \"?(?:new|revised)\"?)?) licen[cs]e\)?(?: \((?:mit|isc)\))?:?[ \t\r#*/;=-]*\n([ \t\r\n#*/;=-]*[a-z0-9(\"])"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OTHER = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def canonical(text: Column) -> Column:
    out = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    out = F.regexp_replace(F.regexp_replace(out, TITLE, "$1"), COPYRIGHT, "\n")
    out = F.concat(F.lit(" "), F.regexp_replace(out, OTHER, " "), F.lit(" "))
    out = F.regexp_replace(out, " +", "  ")
    for was, now in SPELLINGS.items():
        out = F.replace(out, F.lit(f" {was.replace(' ', '  ')} "), F.lit(f" {now} "))
    return F.trim(F.regexp_replace(out, " +", " "))


def canonical_sql(text: str) -> str:
    """The same form in DuckDB's SQL."""
    out = f"regexp_replace(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '{TITLE}', '\\1')"
    out = f"regexp_replace({out}, '{COPYRIGHT}', chr(10), 'g')"
    out = f"regexp_replace(' ' || regexp_replace({out}, '{OTHER}', ' ', 'g') || ' ', ' +', '  ', 'g')"
    for was, now in SPELLINGS.items():
        out = f"replace({out}, ' {was.replace(' ', '  ')} ', ' {now} ')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'), ' ')"


def known_digests(spark: SparkSession, known: dict[str, list[str]] | None = None, digests: dict[str, list[str]] | None = None) -> DataFrame:
    """digest and license_id of the known texts, and of the digests listed without their texts (none where only texts are
    given); as many rows as are listed, KNOWN_MAX at most."""
    digests = digests or ({} if known is not None else DIGESTS)
    known = KNOWN if known is None else known
    if (n := sum(map(len, known.values())) + sum(map(len, digests.values()))) > KNOWN_MAX:
        raise ValueError(f"{n} known texts; a scan takes {KNOWN_MAX} at most")
    rows = [(k, t, None) for k, own in known.items() for t in own] + [(k, None, x) for k, own in digests.items() for x in own]
    listed = spark.createDataFrame(rows, "license_id string, text string, digest string")
    digest = F.coalesce("digest", F.sha2(canonical(F.col("text")), 256))
    return listed.select(digest.alias("digest"), "license_id").groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan_licences(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", known: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, digest, license_id (of the whole text, or null) and line_licenses (of whole lines, comma-joined, sorted).

    Null and empty texts have the digest of the empty form and no licence; repeated rows give a row each; only the two
    named columns are read. The known digests are a listed table of a checked size, so its broadcast does not grow with the
    documents; lines are tried against it inside the row, so a document never leaves its partition. Without known texts
    nothing is found; of several licences with one canonical form the first by name is given.
    """
    pairs = known_digests(docs.sparkSession, known).orderBy("digest").collect()  # as many as are listed
    table = F.create_map(*(F.lit(x) for r in pairs for x in (r["digest"], r["license_id"]))) if pairs else F.create_map().cast("map<string,string>")
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    found = F.transform(lines, lambda x: F.element_at(table, F.sha2(canonical(x), 256)))
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.sha2(canonical(F.col(text)), 256).alias("digest"), F.array_join(F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull()))), ",").alias("line_licenses"))
    return own.join(F.broadcast(known_digests(docs.sparkSession, known)), "digest", "left").select("doc_id", "digest", "license_id", "line_licenses")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(common.table(spark, sf_dir, "documents"))


def op8_sql() -> str:
    rows = ", ".join("('" + k + "', '" + t.replace("'", "''") + "')" for k, own in KNOWN.items() for t in own)
    listed = ", ".join(f"('{k}', '{x}')" for k, own in DIGESTS.items() for x in own)
    return f"""
    WITH known AS (SELECT digest, min(k) AS license_id FROM (SELECT k, sha256({canonical_sql('t')}) AS digest FROM (VALUES {rows}) v(k, t) UNION ALL SELECT * FROM (VALUES {listed}) w(k, digest)) GROUP BY 1),
    lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
    hits AS (SELECT DISTINCT doc_id, license_id FROM (SELECT doc_id, sha256({canonical_sql('line')}) AS digest FROM lines) JOIN known USING (digest)),
    joined AS (SELECT doc_id, string_agg(license_id, ',' ORDER BY license_id) AS l FROM hits GROUP BY 1),
    own AS (SELECT doc_id, sha256({canonical_sql('text')}) AS digest FROM documents)
    SELECT own.doc_id, own.digest, known.license_id, coalesce(joined.l, '') AS line_licenses
    FROM own LEFT JOIN known USING (digest) LEFT JOIN joined ON own.doc_id = joined.doc_id"""

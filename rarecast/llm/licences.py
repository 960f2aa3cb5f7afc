"""Licence scan of a corpus whose documents are files in directories.

Every sentence and line of every file is compared with the licence templates by the cosine of sparse TF-IDF
vectors; document frequencies are counted over the whole corpus, first for the templates' terms.  No
term weighs less than 1, which bounds a line's cosine from above; only lines whose bound reaches the threshold
go on.  The document frequencies of their other terms are counted in a second pass, kept in a partitioned
table and joined to them for the exact cosine.  In the same way every whole file is compared with the whole
licence texts (``licence_texts`` and those passed in), and its beginning, at several lengths, with the
standard headers.  A file's own licence is that of the whole text it is; else of its SPDX identifier or header, the
better one; else of its best line.  An identifier that is no template's name is given as written.  A
*licence file* is a whole licence text, or one whose words lie mostly in matching lines; its licence holds for its directory.  Files without
a licence of their own inherit that of the nearest ancestor directory that has one, by equi-joins
of the file's ancestor paths with the directories' licences; only the smallest depth per file is kept.

Defined cases: null and empty texts have no licence of their own and inherit like others; null or
empty paths have no ancestors but the root ""; a directory with several licence files takes the one
with the highest cosine, then the smallest name, then the smallest id; ties of a line's cosine go to
the template listed first; rows that share id and path get the same answer; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IdFilter, read_table, stored
from .kernels import IS_SEP, HashIndex, chunks, distinct_per_row, words
from .registry import register

THRESHOLD = 0.8
FILE_SHARE = 0.5             # of a licence file's words that lie in matching lines

# Notice texts of common licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Released under CC0 1.0 into the public domain.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "MPL-2.0": "This file is subject to the terms of the Mozilla Public License, version 2.0.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "proprietary": "All rights reserved.",
}
_GNU = ("This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1}General Public "
        "License as published by the Free Software Foundation, either version {2} of the License, or (at your option) any "
        "later version. This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1}General Public License "
        "for more details. You should have received a copy of the GNU {1}General Public License along with this {0}. If "
        "not, see <https://www.gnu.org/licenses/>.")
# Standard headers.
HEADERS = {
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                  'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
                  "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                  "permissions and limitations under the License.",
    "GPL-2.0": _GNU.format("program", "", "2"),
    "GPL-3.0": _GNU.format("program", "", "3"),
    "LGPL-2.1": _GNU.format("library", "Lesser ", "2.1"),
    "LGPL-3.0": _GNU.format("library", "Lesser ", "3"),
    "AGPL-3.0": _GNU.format("program", "Affero ", "3"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
               "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
}
BEFORE = range(0, 41, 8)     # words that may stand before a header, as copyright lines do
_SEPARATORS = IS_SEP.copy()
_SEPARATORS[list(b"!\"#$%&'()*+,/:;<=>?@[\\]^_`{|}~")] = True      # "." and "-" belong to terms


def _terms(c):
    """Words without a final dot."""
    from .kernels import Words, byte_spans, span_hash

    w = words(c, _SEPARATORS)
    end = w.end - ((c.buf[np.maximum(w.end - 1, 0)] == 46) & (w.end - w.start > 1)) if len(w.end) else w.end
    return Words(w.row, w.start, end, span_hash(c, w.start, end), w.first)


def _term_lists(texts):
    return [_terms(next(chunks(pa.array([t])))).hash for t in texts]


def bundled_texts() -> dict:
    """Whole licence texts by name."""
    files = sorted((resources.files(__package__) / "licence_texts").iterdir(), key=lambda f: f.name)
    return {f.name.removesuffix(".txt"): f.read_text() for f in files if f.name.endswith(".txt")}


class _Index:
    """Normalised TF-IDF vectors of the templates over their own terms."""

    def __init__(self, terms, df: dict, n_docs: int):
        vocabulary = np.unique(np.concatenate(terms))
        idf = np.log((1 + n_docs) / (1 + np.array([df.get(int(t), 0) for t in vocabulary.view(np.int64)]))) + 1
        self.index, self.idf = HashIndex(vocabulary), idf
        self.m = np.zeros((len(vocabulary), len(terms)))
        for j, t in enumerate(terms):
            for x in self.index.find(t):
                self.m[x, j] += idf[x]
        self.m /= np.sqrt((self.m ** 2).sum(0))

    def lines(self, c, threshold):
        """(words, line of each word, candidate lines' numbers, best templates, dot products, squared norms over the
        templates' terms, and (line, term, times) of their other terms)."""
        w = _terms(c)
        breaks = np.zeros(len(c.buf) + 1, np.int64)
        np.cumsum(c.buf == 10, out=breaks[1:])
        stop = (c.buf[w.end] == 46) if len(w.end) and w.end[-1] < len(c.buf) else np.append(c.buf[w.end[:-1]] == 46, False)
        line = breaks[w.start] + w.row + np.cumsum(stop) - stop     # rows and sentences also end lines
        at = self.index.find(w.hash)
        some = np.unique(line[at >= 0])
        if not len(some):
            return w, line, some, some, np.zeros(0), np.zeros(0), (some, w.hash[:0], some)
        use = np.flatnonzero(np.isin(line, some))
        k = np.searchsorted(some, line[use])
        # term counts of each candidate line
        key = np.stack([k.astype(np.uint64), w.hash[use]], 1)
        order = np.lexsort((key[:, 1], key[:, 0]))
        key = key[order]
        new = np.flatnonzero(np.concatenate([[True], (np.diff(key[:, 0]) > 0) | (key[1:, 1] != key[:-1, 1])]))
        times = np.diff(np.append(new, len(key)))
        k, h = key[new, 0].astype(np.int64), key[new, 1]
        at = self.index.find(h)
        hit = at >= 0
        weight = times * np.where(hit, self.idf[np.maximum(at, 0)], 0.0)
        inner = np.bincount(k, weight ** 2, len(some))
        dot = np.zeros((len(some), self.m.shape[1]))
        np.add.at(dot, k[hit], weight[hit, None] * self.m[at[hit]])
        best = dot.max(1)
        good = best >= (threshold - 1e-9) * np.sqrt(inner + np.bincount(k, np.where(hit, 0, times ** 2), len(some)))
        more = ~hit & good[k]
        return w, line, some[good], dot.argmax(1)[good], best[good], inner[good], (some[k[more]], h[more], times[more])


class _Texts(_Index):
    """Whole texts, then headers (the first ``n_whole`` are whole texts)."""

    def __init__(self, terms, n_whole: int, df: dict, n_docs: int):
        super().__init__(terms, df, n_docs)
        self.n_whole, self.sizes = n_whole, [len(t) for t in terms]

    def products(self, row, h, n_rows: int):
        """(dot products, squared norm over the templates' terms, number of other words) per row."""
        at = self.index.find(h)
        v = len(self.idf)
        key, times = np.unique(row[at >= 0] * v + at[at >= 0], return_counts=True)
        r, x = np.divmod(key, v)
        weight = times * self.idf[x]
        dot = np.zeros((n_rows, self.m.shape[1]))
        first = np.flatnonzero(np.diff(r, prepend=-1))
        if len(first):
            dot[r[first]] = np.add.reduceat(weight[:, None] * self.m[x], first, axis=0)
        return dot, np.bincount(r, weight ** 2, n_rows), np.bincount(row[at < 0], minlength=n_rows)

    def matches(self, w, n_rows: int, threshold):
        """(row, template, dot product, squared norm, words, other terms, their times) of each file or beginning of
        one that may reach the threshold."""
        def unit(r, template, dot, inner, n):
            h = w.hash[w.first[r]:w.first[r] + n]
            return (int(r), template, dot, inner, n, *np.unique(h[self.index.find(h) < 0], return_counts=True))

        low = threshold - 1e-9
        dot, inner, others = self.products(w.row, w.hash, n_rows)
        whole = dot[:, :self.n_whole]
        count = np.diff(w.first)
        for r in np.flatnonzero((count > 0) & (whole.max(1) >= low * np.sqrt(inner + others))):
            j = int(whole[r].argmax())
            yield unit(r, j, whole[r, j], inner[r], int(count[r]))
        # a beginning of L words has a norm of sqrt(L) at least
        place = np.arange(len(w.hash)) - w.first[w.row]
        near = place < max(self.sizes[self.n_whole:]) + max(BEFORE)
        dot = self.products(w.row[near], w.hash[near], n_rows)[0]
        for j in range(self.n_whole, len(self.sizes)):
            for r in np.flatnonzero(dot[:, j] >= low * np.sqrt(np.minimum(count, self.sizes[j])).clip(1)):
                for n in sorted({min(self.sizes[j] + b, int(count[r])) for b in BEFORE}):
                    h = w.hash[w.first[r]:w.first[r] + n]
                    d, i, o = self.products(np.zeros(n, np.int64), h, 1)
                    if d[0, j] >= low * np.sqrt(i[0] + o[0]):
                        yield unit(r, j, d[0, j], i[0], n)


class _TermFilter(IdFilter):
    """Bitmap of terms, by the low bits of their hashes."""

    def slot(self, name: str):
        return F.pmod(F.col(name), F.lit(self.bits))


def _more_frequencies(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, df) of at least ``terms`` over all texts; per task merged in memory up to a bound."""
    chosen = _TermFilter(terms)
    held, mask = chosen.held, np.uint64(chosen.bits - 1)

    def run(batches):
        kept, size = [], 0

        def merged():
            u, at = np.unique(np.concatenate([x for x, _ in kept]), return_inverse=True)
            return u, np.bincount(at, np.concatenate([x for _, x in kept]), len(u)).astype(np.int64)

        def batch(u, n):
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)], names=["term", "df"])

        for b in batches:
            for c in chunks(b.column("text")):
                w = _terms(c)
                at = (w.hash & mask).astype(np.int64)
                some = (held.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                kept.append(np.unique(distinct_per_row(w.row[some], w.hash[some], c.n)[0], return_counts=True))
                size += len(kept[-1][0])
                if size > 1_000_000:
                    kept = [merged()]
                    size = len(kept[0][0])
                    if size > 500_000:
                        yield batch(*kept[0])
                        kept, size = [], 0
        if kept:
            yield batch(*merged())

    return texts.mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _document_frequency(texts: DataFrame, terms):
    vocabulary = HashIndex(np.unique(np.concatenate(terms)))

    def run(batches):
        total, n = np.zeros(len(vocabulary.keys), np.int64), 0
        for b in batches:
            n += b.num_rows
            for c in chunks(b.column("text")):
                w = _terms(c)
                at = vocabulary.find(w.hash)
                pair = np.unique(w.row[at >= 0] * len(total) + at[at >= 0])
                total += np.bincount(pair % len(total), minlength=len(total))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(vocabulary.keys.view(np.int64), 0)), pa.array(np.append(total, n)),
             pa.array(np.append(np.zeros(len(total), bool), True))], names=["term", "n", "all"])

    rows = (texts.mapInArrow(run, "term long, n long, all boolean").groupBy("all", "term").agg(F.sum("n").alias("n"))
            .collect())                                     # as many rows as the templates have terms
    return {r.term: r.n for r in rows if not r["all"]}, sum(r.n for r in rows if r["all"])


def file_licences(files: DataFrame, id_col: str, path_col: str, text_col: str, threshold: float = THRESHOLD,
                  more_texts: DataFrame | None = None) -> DataFrame:
    """Per file: doc_id, path, own licence and cosine (null without), matched line's bytes, share of words in
    matching lines."""
    rows = files.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(path_col), F.lit("")).alias("path"),
                        F.col(text_col).cast("string").alias("text"))
    whole = list(bundled_texts().items())
    if more_texts is not None:
        whole += [(x["licence"], x["text"]) for x in more_texts.select("licence", "text").collect()]     # templates only
    terms, text_terms = _term_lists(TEMPLATES.values()), _term_lists([t for _, t in whole] + list(HEADERS.values()))
    df, n = _document_frequency(rows.select("text"), terms + text_terms)
    held = rows.sparkSession.sparkContext.broadcast((_Index(terms, df, n), _Texts(text_terms, len(whole), df, n)))
    names, text_names, n_whole = list(TEMPLATES), [x for x, _ in whole] + list(HEADERS), len(whole)
    spdx = _term_lists(["SPDX-License-Identifier"])[0][0]
    canonical = {x.lower() + end: x for x in [*names, *text_names] for end in ("", "-only", "-or-later", "+")}
    unit_type = pa.list_(pa.struct([("kind", pa.int32()), ("licence", pa.string()), *[(c, pa.float64()) for c in ("dot", "inner", "share")],
                                    *[(c, pa.int64()) for c in ("start", "end")],
                                    ("terms", pa.list_(pa.struct([("term", pa.int64()), ("times", pa.int64())])))]))

    def run(batches):
        ix, texts = held.value
        for b in batches:
            units = [[] for _ in range(b.num_rows)]
            for c in chunks(b.column("text")):
                w, line, some, template, dot, inner, (of, term, times) = ix.lines(c, threshold)
                count = np.diff(w.first)
                for r, j, d, i, size, t, times_ in texts.matches(w, c.n, threshold):
                    lo = w.first[r]
                    units[c.at + r].append({
                        "kind": 0 if j < n_whole else 1, "licence": text_names[j], "dot": d, "inner": i,
                        "share": 1.0 if j < n_whole else 0.0, "start": w.start[lo] - c.offs[r],
                        "end": w.end[lo + size - 1] - c.offs[r],
                        "terms": [{"term": int(a), "times": int(b_)} for a, b_ in zip(t.view(np.int64), times_)]})
                for lo in np.flatnonzero((w.hash[:-1] == spdx) & (line[1:] == line[:-1])):
                    r = int(w.row[lo])
                    name = c.buf[w.start[lo + 1]:w.end[lo + 1]].tobytes().decode("utf-8", "replace")
                    units[c.at + r].append({
                        "kind": 1, "licence": canonical.get(name.lower(), name), "dot": 1.0, "inner": 1.0, "share": 2 / count[r],
                        "start": w.start[lo] - c.offs[r], "end": w.end[lo + 1] - c.offs[r], "terms": []})
                for k in range(len(some)):
                    lo, hi = np.searchsorted(line, [some[k], some[k] + 1])
                    x, y = np.searchsorted(of, [some[k], some[k] + 1])
                    r = int(w.row[lo])
                    units[c.at + r].append({
                        "kind": 2, "licence": names[template[k]], "dot": dot[k], "inner": inner[k], "share": (hi - lo) / count[r],
                        "start": w.start[lo] - c.offs[r], "end": w.end[hi - 1] - c.offs[r],
                        "terms": [{"term": int(t), "times": int(n)} for t, n in zip(term[x:y].view(np.int64), times[x:y])]})
            yield pa.RecordBatch.from_arrays([b.column("rid"), b.column("doc_id"), b.column("path"), pa.array(units, unit_type)],
                                             names=["rid", "doc_id", "path", "units"])

    found = stored(rows.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(
        run, "rid long, doc_id long, path string, units array<struct<kind: int, licence: string, dot: double, inner: double, share: double, "
             "start: long, end: long, terms: array<struct<term: long, times: long>>>>"), "licence-candidates")
    unit = found.select("rid", F.posexplode("units").alias("pos", "unit")).select("rid", "pos", "unit.*")
    other = unit.select("rid", "pos", F.explode("terms").alias("t")).select("rid", "pos", "t.*")
    idf = F.log((1 + n) / (1 + F.col("df"))) + 1
    outer = (other.join(_more_frequencies(rows.select("text"), other.select("term")), "term")
             .groupBy("rid", "pos").agg(F.sum((F.col("times") * idf) ** 2).alias("outer")))
    best = F.min(F.struct("kind", (-F.round("cosine", 12)).alias("c"), "start", "licence", "end", "cosine")).alias("best")
    own = (unit.join(outer, ["rid", "pos"], "left")
           .withColumn("cosine", F.col("dot") / F.sqrt(F.col("inner") + F.coalesce("outer", F.lit(0.0))))
           .filter(F.col("cosine") >= threshold - 1e-12).groupBy("rid").agg(best, F.least(F.sum("share"), F.lit(1.0)).alias("share")))
    return stored(found.drop("units").join(own, "rid", "left").select(
        "doc_id", "path", *[F.col(f"best.{c}").alias(c) for c in ("licence", "cosine", "start", "end")],
        F.coalesce("share", F.lit(0.0)).alias("share")), "file-licences")


def _parent(path):
    """Directory of a path; the root is ""."""
    cut = F.length(path) - F.length(F.substring_index(path, "/", -1)) - 1
    return F.when(cut > 0, path.substr(F.lit(1), cut)).otherwise("")


def licence_scan(files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text",
                 threshold: float = THRESHOLD, file_share: float = FILE_SHARE, more_texts: DataFrame | None = None) -> DataFrame:
    """``more_texts``: whole licence texts (licence, text) beside the bundled ones.  One row per file: doc_id, path, licence, cosine, origin ("own", "inherited", "none"), licence_dir (of
    an inherited one), is_licence_file, start, end."""
    own = file_licences(files, id_col, path_col, text_col, threshold, more_texts)
    holder = own.filter(F.col("licence").isNotNull() & (F.col("share") >= file_share))
    dirs = (holder.withColumn("dir", _parent(F.col("path")))
            .groupBy("dir").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "licence", "doc_id")).alias("best"))
            .select("dir", F.col("best.licence").alias("dir_licence"), (-F.col("best.c")).alias("dir_cosine")))
    # ancestors of the distinct directories that need one: a file's row is never multiplied by its depth
    need = own.filter("licence IS NULL").select(_parent(F.col("path")).alias("at")).distinct()
    up = need.withColumn("parts", F.when(F.col("at") == "", F.array().cast("array<string>")).otherwise(F.split("at", "/")))
    up = up.select("at", F.explode(F.sequence(F.lit(0), F.size("parts"))).alias("depth"), "parts").select(
        "at", "depth", F.array_join(F.slice("parts", F.lit(1), F.col("depth")), "/").alias("dir"))
    near = (up.join(dirs, "dir").groupBy("at").agg(F.max(F.struct("depth", "dir", "dir_licence", "dir_cosine")).alias("near")))
    out = own.withColumn("at", _parent(F.col("path"))).join(near, "at", "left")
    mine = F.col("licence").isNotNull()
    return out.select(
        "doc_id", "path", F.coalesce("licence", "near.dir_licence").alias("licence"),
        F.coalesce("cosine", "near.dir_cosine").alias("cosine"),
        F.when(mine, "own").when(F.col("near").isNotNull(), "inherited").otherwise("none").alias("origin"),
        F.when(~mine, F.col("near.dir")).alias("licence_dir"),
        (mine & (F.col("share") >= file_share)).alias("is_licence_file"), "start", "end")


@register("op4_licence_scan")
def op4(spark, sf_dir):
    """Documents as files: source, language and thousand of the id are the directories."""
    docs = read_table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")),
                       F.concat(F.lit("part-"), F.floor(F.col("doc_id") / 1000).cast("string")),
                       F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licence_scan(docs.withColumn("path", path))

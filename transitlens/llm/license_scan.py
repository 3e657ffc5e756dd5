"""License scans (operator 7).

Every line of every text is compared with short licence templates by the cosine
of sparse TF-IDF vectors.  Document frequencies of template terms are counted
over the lines of the whole corpus; a term that no template holds weighs as a
term seen once.  A document's own licence is the template of its best line of
at least ``least`` cosine.  If such lines hold ``file_share`` of its words, or
its file name says so, the document is a licence file, and its directory carries
the licence.  A document without a licence of its own inherits that of its
nearest ancestor directory, found by joins on paths.

Counting is pre-aggregated per task (one row per template term); the join side
that carries licences has one row per directory, so a directory with a third of
all documents can be split.

Defined cases: null or empty text has no licence of its own but inherits; null
path: no directory, inherits nothing; equal cosines go to the template that
comes first by name; several licence files in a directory: the highest cosine,
then the smallest path; repeated rows are scanned row by row; extra columns are
ignored; an empty table gives no rows.
"""
from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from transitlens.llm.common import Scratch, texts

# Usual short forms of public licences, lower case.
TEMPLATES = {
    "Apache-2.0": "licensed under the apache license version 2.0",
    "BSD-3-Clause": "redistribution and use in source and binary forms with or without modification are permitted",
    "CC-BY-4.0": "licensed under cc by 4.0",
    "CC-BY-NC-4.0": "licensed under cc by nc 4.0",
    "CC-BY-SA-4.0": "licensed under cc by sa 4.0",
    "GPL-2.0": "this work is licensed under the gnu general public license version 2",
    "GPL-3.0": "this work is licensed under the gnu general public license version 3",
    "LGPL-3.0": "this work is licensed under the gnu lesser general public license version 3",
    "MIT": "released under the mit license",
    "MIT-full": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "MPL-2.0": "this source code form is subject to the terms of the mozilla public license version 2.0",
}
SPDX = {"MIT-full": "MIT"}
FILE_NAME = re.compile(r"(?i)^(licen[cs]e|copying|notice)([._-].*)?$")
_TERM = re.compile(rb"[a-z0-9]+(?:\.[0-9]+)*")
NO_STOP = frozenset(b"the of and a to in is this for with or are any by under".split())


def terms(line: bytes) -> list[bytes]:
    return _TERM.findall(line.lower())


_VECTORS = {k: terms(v.encode()) for k, v in TEMPLATES.items()}
_VOCAB = frozenset(t for v in _VECTORS.values() for t in v)
_TELLING = _VOCAB - NO_STOP


def _lines(text: bytes):
    for line in text.split(b"\n"):
        ts = terms(line)
        if ts:
            yield ts


def _count(batches):
    """(term, lines that hold it) of one task; the empty term counts lines."""
    df: dict[str, int] = {"": 0}
    for batch in batches:
        for text in texts(batch.column(0)):
            for ts in _lines(text):
                df[""] += 1
                for t in _VOCAB.intersection(ts):
                    df[t.decode()] = df.get(t.decode(), 0) + 1
    yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.string()), pa.array(list(df.values()), pa.int64())], names=["term", "n"])


class Matcher:
    """Cosines of a line with every template."""

    def __init__(self, df: dict[str, int]):
        n = df.get("", 0)
        self.rare = math.log((n + 1) / 2) + 1
        self.idf = {t: math.log((n + 1) / (df.get(t.decode(), 0) + 1)) + 1 for t in _VOCAB}
        self.vectors = {}
        for name in sorted(_VECTORS):
            v = {t: _VECTORS[name].count(t) * self.idf[t] for t in set(_VECTORS[name])}
            norm = math.sqrt(sum(x * x for x in v.values()))
            self.vectors[name] = {t: x / norm for t, x in v.items()}

    def best(self, ts: list[bytes]) -> tuple[float, str]:
        v: dict[bytes, float] = {}
        for t in ts:
            v[t] = v.get(t, 0) + self.idf.get(t, self.rare)
        norm = math.sqrt(sum(x * x for x in v.values()))
        return max(((sum(v.get(t, 0) * x for t, x in u.items()) / norm, name) for name, u in self.vectors.items()),
                   key=lambda c: c[0])                       # names are sorted: the first of equals wins


SCAN_SCHEMA = "doc_id long, path string, license string, cosine double, share double"


def _scan(df: dict[str, int], least: float):
    def scan(batches):
        m = Matcher(df)
        for batch in batches:
            lic, cos, share = [], [], []
            for text in texts(batch.column(2)):
                top, total, held = (0.0, None), 0, 0
                for ts in _lines(text):
                    total += len(ts)
                    if len(_TELLING.intersection(ts)) < 2:       # one shared telling term cannot reach the threshold
                        continue
                    c, name = m.best(ts)
                    if c >= least:
                        held += len(ts)
                        if c > top[0]:
                            top = (c, SPDX.get(name, name))
                lic.append(top[1])
                cos.append(top[0])
                share.append(held / total if total else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(lic, pa.string()),
                                              pa.array(cos, pa.float64()), pa.array(share, pa.float64())],
                                             names=["doc_id", "path", "license", "cosine", "share"])
    return scan


def own_licenses(docs: DataFrame, least: float = 0.6) -> DataFrame:
    """(doc_id, path, license, cosine, share) before inheritance."""
    base = docs.select(F.col("doc_id").cast("long"), F.col("path").cast("string"), F.col("text").cast("string"))
    df = {r["term"]: r["n"] for r in base.select("text").mapInArrow(_count, "term string, n long")
          .groupBy("term").agg(F.sum("n").alias("n")).collect()}          # one row per template term
    return base.mapInArrow(_scan(df, least), SCAN_SCHEMA)


def _steps(path):
    return F.filter(F.split(path, "/"), lambda s: s != "")


def _root(path):
    return F.when(path.startswith("/"), "/").otherwise("")


def _dir(path):
    """Folder of a path, without doubled slashes: ``/`` at the root, empty for a bare name."""
    steps = _steps(path)
    return F.concat(_root(path), F.array_join(F.slice(steps, 1, F.size(steps) - F.when(path.endswith("/"), 0).otherwise(F.least(F.lit(1), F.size(steps)))), "/"))


def scan_licenses(docs: DataFrame, least: float = 0.6, file_share: float = 0.5) -> DataFrame:
    """(doc_id, license, found, license_dir): found is 'header', 'file', 'inherited' or null."""
    tmp = Scratch(docs.sparkSession, "license-scan")
    own = tmp.write(own_licenses(docs, least)
                    .withColumn("dir", _dir(F.col("path")))
                    .withColumn("is_file", F.coalesce(F.col("license").isNotNull()
                                                      & ((F.col("share") >= file_share) | F.regexp_extract("path", "([^/]*)$", 1).rlike(FILE_NAME.pattern)), F.lit(False))),
                    "own")
    dirs = (own.filter("is_file and dir is not null").groupBy(F.col("dir").alias("at"))
            .agg(F.min_by("license", F.struct(-F.round("cosine", 9), F.col("path"))).alias("dir_license")))
    wanting = own.filter("license is null and path is not null").select("dir").distinct()
    steps = _steps(F.col("dir"))
    up = wanting.select("dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(steps)), lambda n: F.concat(
        _root(F.col("dir")), F.array_join(F.slice(steps, 1, n), "/")))).alias("at"))
    near = (up.join(dirs, "at").groupBy("dir").agg(F.max_by(F.struct("at", "dir_license"), F.length("at")).alias("n"))
            .select("dir", F.col("n.at").alias("license_dir"), F.col("n.dir_license").alias("dir_license")))
    out = own.join(near, "dir", "left")
    mine = F.col("license").isNotNull()
    return out.select("doc_id", F.coalesce("license", "dir_license").alias("license"),
                      F.when(F.col("is_file"), "file").when(mine, "header").when(F.col("dir_license").isNotNull(), "inherited").alias("found"),
                      F.when(~mine, F.col("license_dir")).alias("license_dir"))

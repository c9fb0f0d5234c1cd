"""Licence scans: TF-IDF cosine of lines to licence notices, then inheritance from the nearest ancestor directory.

All steps are DataFrame operations. Notices are a fixed short list, so their weights are broadcast. Every line of
every text is looked at. Two exact bounds, worked out from the notices, come before lines are exploded into words: a
line needs an anchor word, and the words it shares with a notice must make up enough of that notice.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.words import fields, whole_row
from millwright.session import materialize

#: Notices by licence, and names of licence files.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "MPL-2.0": "This work is subject to the terms of the Mozilla Public License, v. 2.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0",
    "Proprietary": "All rights reserved",
}
LICENSE_FILE = r"(?i)(^|/)(license|licence|copying|unlicense)(\.[a-z]+)?$"

THRESHOLD = 0.8


def _words(text: str) -> list[str]:
    return [w for w in re.split("[^a-z0-9]+", text.lower()) if w]


def weights(notices: dict[str, str]) -> tuple[dict[str, float], float, dict[str, dict[str, float]]]:
    """Inverse document frequencies over the notices, the one of any other word, and unit vectors of the notices."""
    counts = {name: Counter(_words(text)) for name, text in notices.items()}
    df = Counter(w for c in counts.values() for w in c)
    idf = {w: math.log((1 + len(notices)) / (1 + n)) + 1 for w, n in df.items()}
    vectors = {}
    for name, c in counts.items():
        norm = math.sqrt(sum((n * idf[w]) ** 2 for w, n in c.items()))
        vectors[name] = {w: n * idf[w] / norm for w, n in c.items()}
    return idf, math.log(1 + len(notices)) + 1, vectors


def anchors(vectors: dict[str, dict[str, float]], threshold: float) -> list[str]:
    """Words of which every line that reaches the threshold has at least one.

    Words of a notice are taken until its unit vector is shorter than the threshold without them: a line that shares
    only the others cannot come closer than that length. Words taken before come first, then long ones, which other
    texts have less often.
    """
    if threshold <= 0:
        raise ValueError("the threshold must be positive")
    taken: set[str] = set()
    for vector in vectors.values():
        left = 1.0
        for word in sorted(vector, key=lambda w: (w not in taken, -len(w), w)):
            if left < (threshold - 1e-6) ** 2:
                break
            left -= vector[word] ** 2
            taken.add(word)
    return sorted(taken)


def _split(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda w: w != "")


def _shares_enough(line: Column, vectors: dict[str, dict[str, float]], threshold: float) -> Column:
    """Whether the notice's words that stand in the line can reach the threshold: no cosine exceeds their length."""
    least = (threshold - 1e-6) ** 2
    vocabulary = F.array(*[F.lit(w) for w in sorted({w for v in vectors.values() for w in v})])

    def enough(known: Column) -> Column:
        lengths = [sum(F.when(F.array_contains(known, w), x * x).otherwise(0.0) for w, x in v.items()) for v in vectors.values()]
        return reduce(or_, [length >= least for length in lengths])

    # Inside one function, so that the shared words are found once for each line.
    return F.exists(F.array(F.array_intersect(vocabulary, _split(line))), enough)


def matching_lines(lines: DataFrame, notices: dict[str, str], threshold: float) -> DataFrame:
    """(row, pos, license, score) of lines (row, pos, line): the notice with the largest cosine, ties by name."""
    idf, other, vectors = weights(notices)
    spark = lines.sparkSession
    table = spark.createDataFrame(
        [(w, name, x, idf[w]) for name, v in vectors.items() for w, x in v.items()], "word string, license string, x double, idf double"
    )
    line = F.col("line")
    anchored = lines.where(F.lower(line).rlike(f"(?<![a-z0-9])(?:{'|'.join(anchors(vectors, threshold))})(?![a-z0-9])"))
    close = anchored.where(_shares_enough(line, vectors, threshold))
    words = close.select("row", "pos", F.explode(_split(line)).alias("word")).groupBy("row", "pos", "word").agg(F.count(F.lit(1)).alias("n"))
    known = F.broadcast(table.groupBy("word").agg(F.first("idf").alias("idf"), F.collect_list(F.struct("license", "x")).alias("in")))
    weighed = words.join(known, "word", "left").withColumn("w", F.col("n") * F.coalesce("idf", F.lit(other)))
    # Per line: one number for its length and one for each notice, so no row is made per pair.
    dots = [
        F.sum(F.col("w") * F.aggregate("in", F.lit(0.0), _add_if(name))).alias(f"d{i}") for i, name in enumerate(vectors)
    ]
    per_line = weighed.groupBy("row", "pos").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), *dots)
    cosines = [F.struct(F.round(F.coalesce(F.col(f"d{i}"), F.lit(0.0)) / F.col("norm"), 9).alias("score"), F.lit(name).alias("license")) for i, name in enumerate(vectors)]
    best = F.array_sort(F.array(*cosines), lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1).when(a["license"] < b["license"], -1).otherwise(1))[0]
    return per_line.select("row", "pos", best.alias("b")).select("row", "pos", "b.license", "b.score").where(F.col("score") >= threshold)


def _add_if(name: str):
    return lambda total, e: total + F.when(e["license"] == name, e["x"]).otherwise(0.0)


def scan_licenses(files: DataFrame, path: Column, notices: dict[str, str] = NOTICES, threshold: float = THRESHOLD) -> DataFrame:
    """``files`` (with text) with license, score, n_notices and license_from added; existing columns of those names go.

    A file's own licence is its line closest to a notice, the first of equals. A file whose name is that of a licence
    file, or all of whose non-blank lines are notices, speaks for its directory. A file without a licence of its own
    takes that of the nearest ancestor directory that has one; of several files there the closest match counts, then
    the name. license_from is "own", the directory, or null. A null or empty text has no notice of its own, a null
    path no directory. Repeated rows are all returned; an empty table stays empty.
    """
    # Rows with equal path and text have one answer, so a hash of both names a row, however often it is read.
    text = F.col("text")
    row = F.struct(F.xxhash64(path).alias("p"), F.xxhash64(text).alias("t"), F.xxhash64(F.lit("second"), text, path).alias("b"))
    spoken = files.select(row.alias("row"), path.alias("path"), text.alias("text"))
    lines = spoken.select("row", "path", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"))
    found = matching_lines(lines, notices, threshold)
    order = F.struct(-F.col("score"), F.col("pos"))
    own = found.groupBy("row").agg(
        F.min_by("license", order).alias("license"), F.max("score").alias("score"), F.count(F.lit(1)).alias("n_notices")
    )
    full = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n", -1), lambda x: F.btrim(x) != "")).alias("lines")
    named = F.coalesce(F.col("path").rlike(LICENSE_FILE), F.lit(False)).alias("named")
    base = materialize(spoken.select("row", "path", full, named).distinct().join(own, "row", "left"))
    folder = F.regexp_extract("path", "^(.*)/[^/]*$", 1)
    speaks = base.where("license is not null and path is not null").where(F.col("named") | (F.col("n_notices") == F.col("lines")))
    of_folder = materialize(speaks.groupBy(folder.alias("folder")).agg(
        F.min_by("license", F.struct(-F.col("score"), F.col("license"))).alias("theirs"), F.max("score").alias("their_score")
    ))
    # One row per directory and distinct ancestor: a directory with a third of all files is asked for once.
    folders = base.where("license is null and path is not null").select(folder.alias("of")).distinct()
    asked = folders.select("of", F.explode(_ancestors("of")).alias("a")).select("of", "a.*")
    nearest = asked.join(of_folder, "folder").groupBy("of").agg(
        F.max_by(F.struct("theirs", "their_score", "folder"), "depth").alias("near")
    )
    joined = base.withColumn("of", folder).join(nearest, "of", "left")
    result = joined.select(
        "row", F.coalesce("license", "near.theirs").alias("license"), F.coalesce("score", "near.their_score").alias("score"),
        F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
        F.when(F.col("license").isNotNull(), "own").otherwise(F.col("near.folder")).alias("license_from"),
    )
    added = ("license", "score", "n_notices", "license_from")
    keyed = files.select(row.alias("row"), whole_row(files))
    return keyed.join(result, "row").select(*fields(files, *added), *added)


def _ancestors(folder: str) -> Column:
    parts = F.split(folder, "/")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("folder")),
    )

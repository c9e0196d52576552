"""Licence scan: sparse TF-IDF cosine of notices to templates, then inheritance from the nearest ancestor directory.

A notice is a line that mentions a licence, or a sentence of such a line that does; a licence file is one by name, or one whose lines are mostly notices, and is also compared
as a whole. Terms are weighted by how few notices (of all files) and templates have them. Equal notices are compared once, so a line that a third
of all files share costs one comparison. A file without a licence of its own takes that of the nearest ancestor directory with a
licence file. Column expressions throughout.

Defined cases: null text counts as empty; a null path has no directory and inherits nothing; a file without notices and without an
ancestor's licence has a null licence; of several notices the most similar decides, on ties the alphabetically first licence, but one that
grants a licence goes before one that only reserves rights; the same
holds for several licence files of a directory; an empty table gives no rows; repeated rows are each reported; extra columns are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import q
from tidemill.session import settled

#: Licence id -> wordings of its notices. Fixed values.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "Apache License Version 2.0, January 2004", "SPDX-License-Identifier: Apache-2.0",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License"],
    "MIT": ["Released under the MIT License", "Licensed under the MIT License", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"],
    "BSD-3-Clause": ["Licensed under the 3-clause BSD License", "BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause",
                     "Redistribution and use in source and binary forms, with or without modification, are permitted"],
    "BSD-2-Clause": ["Licensed under the 2-clause BSD License", "BSD 2-Clause License", "SPDX-License-Identifier: BSD-2-Clause"],
    "ISC": ["Licensed under the ISC License", "SPDX-License-Identifier: ISC",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2", "GNU General Public License, version 2", "SPDX-License-Identifier: GPL-2.0-or-later"],
    "LGPL-2.1": ["Licensed under the GNU Lesser General Public License, version 2.1", "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0-or-later",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License version 3"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3", "SPDX-License-Identifier: LGPL-3.0-or-later"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3", "SPDX-License-Identifier: AGPL-3.0-or-later"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0-1.0": ["Dedicated to the public domain under CC0 1.0", "SPDX-License-Identifier: CC0-1.0"],
    "LicenseRef-Proprietary": ["All rights reserved", "Proprietary and confidential. All rights reserved"],
}
CUE = r"(?i)licen[sc]|copyright|spdx|creative commons|\bcc[ -]by\b|\bcc0\b|public domain|rights reserved|redistribut|permission is hereby granted|permission to use"
SENTENCE = r"(?<=[.!?;])\s+(?=\p{Lu})"
RESERVED = "LicenseRef-Proprietary"
FILE_NAME = r"(?i)^(licen[sc]e|copying|notice|unlicense)([._-].*)?$"
LEAST = 0.6  # cosine from which a notice counts as the licence
MOSTLY = 0.5  # share of notices among the lines of a licence file


def terms(text: Column) -> Column:
    """Lower-case words and numbers; version numbers stay whole."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}.]+|\.(?![0-9])"), lambda w: w != "")


def _weights(texts: DataFrame) -> DataFrame:
    """(key, term, weight) with unit length per key, from (key, text, n): TF-IDF with document counts weighted by n."""
    counts = texts.select("key", "n", F.explode(terms(F.col("text"))).alias("term")).groupBy("key", "n", "term").agg(F.count(F.lit(1)).alias("tf"))
    total = texts.agg(F.sum("n").alias("total")).first()["total"] or 0
    spread = settled(counts.groupBy("term").agg(F.sum("n").alias("df")), "terms")
    weighed = counts.join(spread, "term").select("key", "term", (F.col("tf") * (F.log(F.lit(float(total) + 1) / (F.col("df") + 1)) + 1)).alias("w"))
    length = weighed.groupBy("key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighed.join(length, "key").select("key", "term", (F.col("w") / F.col("norm")).alias("weight"))


def compared(notices: DataFrame) -> DataFrame:
    """(text, license, cosine) of the distinct notice texts (text, n) that are like a template."""
    spark = notices.sparkSession
    fixed = spark.createDataFrame([(f"{name}\t{i}", text, 1) for name, texts in TEMPLATES.items() for i, text in enumerate(texts)], "key string, text string, n long")
    marked = notices.select(F.concat(F.lit("\n"), "text").alias("key"), "text", F.col("n").cast("long").alias("n"))
    weights = settled(_weights(fixed.unionByName(marked)), "tf-idf")
    ours = weights.where(F.col("key").startswith("\n"))
    theirs = weights.where(~F.col("key").startswith("\n")).select(F.substring_index("key", "\t", 1).alias("license"), F.col("key").alias("template"), "term", F.col("weight").alias("other"))
    pairs = ours.join(theirs, "term").groupBy("key", "license", "template").agg(F.sum(F.col("weight") * F.col("other")).alias("cosine"))
    best = pairs.where(F.col("cosine") >= LEAST).groupBy("key").agg(F.min(F.struct((-F.round("cosine", 9)).alias("less"), "license")).alias("best"))
    return best.select(F.expr("substring(key, 2)").alias("text"), "best.license", (-F.col("best.less")).alias("cosine"))


def _ancestors(directory: Column) -> Column:
    """The directory and all above it, nearest first: ``a/b`` -> [a/b, a, '']."""
    parts = F.split(directory, "/")
    return F.when(directory == "", F.array(F.lit(""))).otherwise(
        F.transform(F.sequence(F.size(parts), F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/")))


def scan(files: DataFrame, id_col: str, path_col: str, text_col: str = "text") -> DataFrame:
    """(id, path, license, cosine, origin, licensed_by) per file; origin: own, inherited or none; licensed_by: the directory it comes from."""
    plain = files.select(q(id_col).alias("id"), q(path_col).cast("string").alias("path"), F.coalesce(q(text_col).cast("string"), F.lit("")).alias("text"))
    lines = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(x)), lambda x: x != "")
    cues = F.when(F.col("text").rlike(CUE), F.filter(F.col("lines"), lambda x: x.rlike(CUE))).otherwise(F.array().cast("array<string>"))
    named = F.coalesce(F.substring_index("path", "/", -1).rlike(FILE_NAME), F.lit(False))
    rows = plain.withColumn("lines", lines).withColumn("cues", cues).withColumn("is_file", named | ((F.size("cues") > 0) & (F.size("cues") >= MOSTLY * F.size("lines"))))
    directory = F.when(F.contains("path", F.lit("/")), F.regexp_replace("path", "/[^/]*$", "")).when(F.col("path").isNotNull(), F.lit(""))
    sentences = F.filter(F.flatten(F.transform("cues", lambda x: F.split(x, SENTENCE))), lambda x: x.rlike(CUE))
    texts = F.array_distinct(F.concat("cues", sentences, F.when(F.col("is_file"), F.array("text")).otherwise(F.array().cast("array<string>"))))
    rows = settled(rows.select("id", "path", directory.alias("dir"), "is_file", F.monotonically_increasing_id().alias("row"), texts.alias("notices")), "notices")
    notices = rows.select("row", F.explode("notices").alias("text"))
    known = settled(compared(notices.groupBy("text").agg(F.count(F.lit(1)).alias("n"))), "licensed")
    best = notices.join(known, "text").groupBy("row").agg(
        F.min(F.struct((F.col("license") == RESERVED).alias("reserved"), (-F.col("cosine")).alias("less"), "license")).alias("best"))
    own = settled(rows.drop("notices").join(best, "row", "left").select("id", "path", "dir", "is_file", F.col("best.license").alias("own"), (-F.col("best.less")).alias("cosine")), "own")
    # path joins: every directory that occurs meets the licences of its ancestors, the nearest one stays
    granted = settled(own.where("is_file and own is not null and dir is not null").groupBy("dir").agg(F.min(F.struct((-F.col("cosine")).alias("less"), F.col("own").alias("license"))).alias("g"))
                      .select(F.col("dir").alias("above"), "g.license"), "granted")
    dirs = own.where("dir is not null").select("dir").distinct().select("dir", F.posexplode(_ancestors(F.col("dir"))).alias("far", "above"))
    near = dirs.join(granted, "above").groupBy("dir").agg(F.min(F.struct("far", "license", "above")).alias("near"))
    near = settled(near.select("dir", F.col("near.license").alias("inherited"), F.col("near.above").alias("above")), "inherited")
    out = own.join(near, "dir", "left")
    return out.select("id", "path", F.coalesce("own", "inherited").alias("license"), F.coalesce("cosine", F.lit(0.0)).alias("cosine"),
                      F.when(F.col("own").isNotNull(), "own").when(F.col("inherited").isNotNull(), "inherited").otherwise("none").alias("origin"),
                      F.when(F.col("own").isNotNull(), F.col("dir")).otherwise(F.col("above")).alias("licensed_by"))

"""License scan: TF-IDF cosine of header lines to templates, then inheritance by directory.

Lines that speak of a licence are compared with short statements of known
licences; equal lines are compared once.  A file without such a line inherits
from the licence file in the nearest directory above it.  Everything is
DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.shared import written

# Licence names (SPDX) and statements that stand for them.
TEMPLATES = (
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause Simplified License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause New License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("EPL-2.0", "Licensed under the Eclipse Public License, version 2.0."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("ISC", "Licensed under the ISC License."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)
SPEAKS_OF_LICENCE = "(?i)licen[sc]e|copyright|copying|spdx|warrant|public domain|all rights reserved"
LICENCE_FILE = "(?i)^(licen[sc]e|copying|notice|unlicense)[^/]*$"
TERM = "[a-z0-9]+"


def statement_terms(statements: DataFrame) -> DataFrame:
    """(statement, term, tf) of distinct statements."""
    terms = F.regexp_extract_all(F.lower("statement"), F.lit(TERM), 0)
    return (
        statements.select("statement", F.explode(terms).alias("term"))
        .groupBy("statement", "term")
        .agg(F.count("*").alias("tf"))
    )


def best_templates(lines: DataFrame, threshold: float) -> DataFrame:
    """(statement, license, score) of the lines whose best template reaches the threshold."""
    spark = lines.sparkSession
    names = ", ".join(f"('{name}', '{text}')" for name, text in TEMPLATES)
    templates = spark.sql(f"SELECT * FROM VALUES {names} AS t(license, statement)")
    statements = lines.select("statement").union(templates.select("statement")).distinct()
    terms = written(statement_terms(statements), "licence-terms")
    n = terms.agg(F.count_distinct("statement")).first()[0]
    idf = terms.groupBy("term").agg(
        (F.log((F.lit(n) + 1) / (F.count("*") + 1)) + 1).alias("idf")
    )
    weights = terms.join(idf, "term").select(
        "statement", "term", (F.col("tf") * F.col("idf")).alias("weight")
    )
    norms = weights.groupBy("statement").agg(
        F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm")
    )
    vectors = weights.join(norms, "statement").select(
        "statement", "term", (F.col("weight") / F.col("norm")).alias("weight")
    )
    # The templates are a fixed list, so this side has a fixed size.
    known = F.broadcast(
        templates.join(vectors, "statement").select(
            "license", "term", F.col("weight").alias("known_weight")
        )
    )
    cosine = F.round(F.sum(F.col("weight") * F.col("known_weight")), 6)
    return (
        lines.select("statement")
        .distinct()
        .join(vectors, "statement")
        .join(known, "term")
        .groupBy("statement", "license")
        .agg(cosine.alias("score"))
        .where(F.col("score") >= threshold)
        .groupBy("statement")
        .agg(
            F.min_by("license", F.struct(-F.col("score"), F.col("license"))).alias("license"),
            F.max("score").alias("score"),
        )
    )


def ancestors(directory: str):
    """Array of (depth, directory) of a path and all directories above it."""
    parts = F.split(directory, "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda k: F.struct(
            k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("above")
        ),
    )


def scan_licenses(
    files: DataFrame,
    file_id: str = "doc_id",
    path: str = "path",
    text: str = "text",
    threshold: float = 0.6,
) -> DataFrame:
    """(file_id, license, score, origin, licence_path) of every file.

    `origin` is header if a line of the file itself reaches the threshold (the
    best line counts, ties go to the first licence name), inherited if the
    nearest directory above has a licence file that does, and else none.  Of
    several licence files in a directory the best one counts, then the smallest
    path.  A null text has no lines; a null path inherits nothing.  Repeated
    rows come back as often as given.
    """
    rows = files.select(
        F.col(file_id).alias("file_id"), F.col(path).alias("path"), F.col(text).alias("text")
    )
    speaking = rows.where(F.col("text").rlike(SPEAKS_OF_LICENCE))
    lines = (
        speaking.select("file_id", "path", F.explode(F.split("text", "\n")).alias("line"))
        .where(F.col("line").rlike(SPEAKS_OF_LICENCE))
        .select("file_id", "path", F.trim("line").alias("statement"))
        .distinct()
    )
    lines = written(lines, "licence-lines")
    best = best_templates(lines, threshold)
    own = written(
        lines.join(best, "statement")
        .groupBy("file_id", "path")
        .agg(
            F.min_by("license", F.struct(-F.col("score"), F.col("license"))).alias("license"),
            F.max("score").alias("score"),
        ),
        "own-licences",
    )
    directory = F.regexp_replace("path", "/[^/]*$", "")
    name = F.regexp_extract("path", "[^/]*$", 0)
    by_directory = (
        own.where(name.rlike(LICENCE_FILE) & F.col("path").contains("/"))
        .groupBy(directory.alias("above"))
        .agg(
            F.min_by(
                F.struct("license", "score", F.col("path").alias("licence_path")),
                F.struct(-F.col("score"), F.col("path"), F.col("license")),
            ).alias("found")
        )
    )
    placed = rows.select(
        "file_id",
        "path",
        F.when(F.col("path").contains("/"), directory).alias("directory"),
    )
    nearest = (
        placed.select("directory")
        .dropna()
        .distinct()
        .select("directory", F.explode(ancestors("directory")).alias("at"))
        .select("directory", "at.depth", "at.above")
        .join(by_directory, "above")
        .groupBy("directory")
        .agg(F.max_by("found", "depth").alias("found"))
    )
    mine = own.select(
        F.col("file_id").alias("own_id"),
        F.col("path").alias("own_path"),
        F.col("license").alias("own_license"),
        F.col("score").alias("own_score"),
    )
    joined = placed.join(
        mine,
        placed["file_id"].eqNullSafe(mine["own_id"]) & placed["path"].eqNullSafe(mine["own_path"]),
        "left",
    ).join(nearest, "directory", "left")
    header = F.col("own_license").isNotNull()
    inherited = F.col("found").isNotNull()
    return joined.select(
        F.col("file_id").alias(file_id),
        F.coalesce("own_license", "found.license").alias("license"),
        F.coalesce("own_score", "found.score").alias("score"),
        F.when(header, "header").when(inherited, "inherited").otherwise("none").alias("origin"),
        F.when(header, F.col("path")).otherwise(F.col("found.licence_path")).alias("licence_path"),
    )


def oracle(files: str, threshold: float = 0.6) -> str:
    """The scan of a query for (doc_id, path, text) as DuckDB SQL."""
    names = ", ".join(f"('{name}', '{text}')" for name, text in TEMPLATES)
    speaks = SPEAKS_OF_LICENCE.removeprefix("(?i)")
    return f"""
WITH files AS ({files}),
lines AS (
  SELECT DISTINCT doc_id, path, trim(line, ' ') AS statement
  FROM (SELECT doc_id, path, unnest(string_split(text, chr(10))) AS line FROM files)
  WHERE regexp_matches(line, '{speaks}', 'i')
),
templates(license, statement) AS (VALUES {names}),
statements AS (SELECT statement FROM lines UNION SELECT statement FROM templates),
terms AS (
  SELECT statement, term, count(*) AS tf
  FROM (SELECT statement, unnest(regexp_extract_all(lower(statement), '{TERM}')) AS term FROM statements)
  GROUP BY ALL
),
size AS (SELECT count(DISTINCT statement) AS n FROM terms),
idf AS (SELECT term, ln((n + 1) / (count(*) + 1)) + 1 AS idf FROM terms, size GROUP BY term, n),
weights AS (SELECT statement, term, tf * idf AS weight FROM terms JOIN idf USING (term)),
vectors AS (
  SELECT statement, term, weight / sqrt(sum(weight * weight) OVER (PARTITION BY statement)) AS weight
  FROM weights
),
scores AS (
  SELECT v.statement, t.license, round(sum(v.weight * k.weight), 6) AS score
  FROM vectors v JOIN vectors k USING (term) JOIN templates t ON t.statement = k.statement
  GROUP BY ALL HAVING score >= {threshold}
),
own AS (
  SELECT doc_id, path, license, score FROM lines JOIN scores USING (statement)
  QUALIFY row_number() OVER (PARTITION BY doc_id, path ORDER BY score DESC, license) = 1
),
licence_files AS (
  SELECT regexp_replace(path, '/[^/]*$', '') AS above, path AS licence_path, license, score FROM own
  WHERE regexp_matches(regexp_extract(path, '[^/]*$'), '^(licen[sc]e|copying|notice|unlicense)', 'i')
  QUALIFY row_number() OVER (PARTITION BY above ORDER BY score DESC, path, license) = 1
),
inherited AS (
  SELECT f.doc_id, f.path, l.license, l.score, l.licence_path
  FROM files f JOIN licence_files l ON starts_with(f.path, l.above || '/')
  QUALIFY row_number() OVER (PARTITION BY f.doc_id, f.path ORDER BY length(l.above) DESC) = 1
)
SELECT f.doc_id, coalesce(o.license, i.license) AS license, coalesce(o.score, i.score) AS score,
  CASE WHEN o.license IS NOT NULL THEN 'header' WHEN i.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
  CASE WHEN o.license IS NOT NULL THEN f.path ELSE i.licence_path END AS licence_path
FROM files f LEFT JOIN own o ON o.doc_id = f.doc_id AND o.path = f.path
LEFT JOIN inherited i ON i.doc_id = f.doc_id AND i.path = f.path
"""

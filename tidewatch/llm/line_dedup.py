"""Removal of repeated line runs through a suffix array over lines, built by distributed prefix doubling.

Lines are what stands between line feeds. The name of a position at level k is a hash of the 2^k lines from there to
the end of their document's run; two positions with one name are neighbours in the suffix array, and a group of equal
names at level k is a longest-common-prefix interval of at least 2^k lines. Level k + 1 combines the names of a
position and of the position 2^k further on, and is only built where both belong to such an interval, so each level
holds repeated runs only and the last one is empty.

A run counts when it has at least two lines, or one line of at least ``min_chars`` characters. Of equal runs the first
in the order (doc_id, line) stays; every line inside a later copy goes. Runs never cross documents.

Edge cases: a null text counts as an empty text; an empty text is one empty line; null ids come before all others;
rows with equal id and text are one document, and each of them gets its result; an empty table gives no rows; columns
of the documents other than the id and the text are carried along or not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.session import stage

MIN_CHARS = 40
KEY = ["doc_id", "text_key"]


def keyed(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.withColumn("text", text).withColumn("text_key", F.xxhash64("text"))


def line_names(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, line, n_chars, name): one row per line of each distinct document."""
    lines = documents.select("doc_id", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("line", "content"))
    # The second hash makes a chance agreement of different lines as good as impossible.
    return lines.select(
        *KEY, "line", F.length("content").alias("n_chars"), F.xxhash64("content", F.hash("content")).alias("name")
    )


def _intervals(level: DataFrame) -> DataFrame:
    """Names of at least two positions, with the first of these positions."""
    return (
        level.groupBy("name")
        .agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "text_key", "line")).alias("first"))
        .where("copies > 1")
    )


def _repeated(level: DataFrame, label: str) -> DataFrame:
    """Positions inside an interval; ``later`` marks all but the first of each.

    The interval side has one row per name, so a name of very many positions splits across tasks.
    """
    here = F.struct("doc_id", "text_key", "line")
    held = level.join(_intervals(level), "name").withColumn("later", ~here.eqNullSafe(F.col("first")))
    return stage(held.select(*KEY, "line", "n_chars", "name", "later"), label)


def repeated_levels(documents: DataFrame) -> list[DataFrame]:
    """The staged levels of the suffix array, as far as runs repeat: positions with ``later``."""
    distinct = line_names(documents).dropDuplicates([*KEY, "line"])
    level, levels, step = _repeated(distinct, "lines-0"), [], 1
    while not level.isEmpty():
        levels.append(level)
        # Positions of a document are bounded by its lines; a missing position ends a run.
        reach = Window.partitionBy(*KEY).orderBy("line").rangeBetween(step, step)
        after = level.withColumn("next", F.first("name").over(reach)).where(F.col("next").isNotNull())
        joined = after.select(*KEY, "line", "n_chars", F.xxhash64("name", "next").alias("name"))
        level = _repeated(joined, f"lines-{len(levels)}")
        step *= 2
    return levels


def doomed_lines(levels: list[DataFrame], min_chars: int = MIN_CHARS) -> DataFrame | None:
    """(doc_id, text_key, line) of lines inside later copies.

    Every run of two lines or more is covered by its windows of two lines, which level 1 holds; longer levels only
    tell how far a run reaches.
    """
    if not levels:
        return None
    found = levels[0].where(F.col("later") & (F.col("n_chars") >= min_chars)).select(*KEY, "line")
    if len(levels) > 1:
        pairs = levels[1].where("later").select(*KEY, F.explode(F.array(F.col("line"), F.col("line") + 1)).alias("line"))
        found = found.union(pairs)
    return found.distinct()


def repeated_runs(levels: list[DataFrame], min_chars: int = MIN_CHARS) -> DataFrame | None:
    """Maximal runs of lines to delete: (doc_id, text_key, first_line, n_lines)."""
    doomed = doomed_lines(levels, min_chars)
    if doomed is None:
        return None
    island = F.col("line") - F.row_number().over(Window.partitionBy(*KEY).orderBy("line"))
    return (
        doomed.withColumn("island", island)
        .groupBy(*KEY, "island")
        .agg(F.min("line").alias("first_line"), F.count("*").alias("n_lines"))
        .drop("island")
    )


def with_line_dedup(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with the text that stays, ``n_lines``, ``n_removed`` and ``n_runs``."""
    source = keyed(documents)
    runs = repeated_runs(repeated_levels(source), min_chars)
    if runs is None:
        held = source.withColumn("runs", F.lit(None).cast("array<struct<first_line:int,n_lines:bigint>>"))
    else:
        per_document = runs.groupBy(*KEY).agg(F.collect_list(F.struct("first_line", "n_lines")).alias("runs"))
        left, right = source.alias("d"), per_document.alias("r")
        same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.text_key") == F.col("r.text_key"))
        held = left.join(right, same, "left").select("d.*", "r.runs")
    content = F.split("text", "\n", -1)
    # Runs are few where lines are many, so a line is held against the runs, not against single lines.
    stays = F.filter(content, lambda _, i: ~F.exists("runs", lambda r: (i >= r["first_line"]) & (i < r["first_line"] + r["n_lines"])))
    kept = F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.array_join(stays, "\n"))
    return (
        held.withColumn("n_lines", F.size(content).cast("long"))
        .withColumn("n_removed", F.coalesce(F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["n_lines"]), F.lit(0).cast("long")))
        .withColumn("n_runs", F.when(F.col("runs").isNull(), 0).otherwise(F.size("runs")).cast("long"))
        .withColumn("text", kept)
        .drop("runs", "text_key")
    )


def line_dedup(documents: DataFrame) -> DataFrame:
    done = with_line_dedup(documents.select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


SQL = f"""
WITH docs AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS content,
         generate_subscripts(string_split(text, chr(10)), 1) AS line
  FROM docs),
paired AS (
  SELECT *, lead(content) OVER (PARTITION BY doc_id, text ORDER BY line) AS following,
         row_number() OVER (PARTITION BY content ORDER BY doc_id NULLS FIRST, text, line) AS copy
  FROM lines),
copies AS (
  SELECT *, CASE WHEN following IS NULL THEN 1 ELSE
         row_number() OVER (PARTITION BY content, following ORDER BY doc_id NULLS FIRST, text, line) END AS pair_copy
  FROM paired),
marked AS (
  SELECT doc_id, text, line, content,
         (copy > 1 AND length(content) >= {MIN_CHARS}) OR pair_copy > 1
         OR coalesce(lag(pair_copy) OVER (PARTITION BY doc_id, text ORDER BY line) > 1, false) AS doomed
  FROM copies),
starts AS (
  SELECT *, doomed AND NOT coalesce(lag(doomed) OVER (PARTITION BY doc_id, text ORDER BY line), false) AS opens
  FROM marked),
done AS (
  SELECT doc_id, text, count(*) AS n_lines, count(*) FILTER (WHERE doomed) AS n_removed,
         count(*) FILTER (WHERE opens) AS n_runs,
         sha256(coalesce(string_agg(content, chr(10) ORDER BY line) FILTER (WHERE NOT doomed), '')) AS kept_sha256
  FROM starts GROUP BY doc_id, text)
SELECT d.doc_id, n_lines, n_removed, n_runs, kept_sha256
FROM documents d JOIN done ON d.doc_id IS NOT DISTINCT FROM done.doc_id AND coalesce(d.text, '') = done.text
"""

"""Document fingerprints by spot signatures: chains of content words that follow common words.

A spot is a common word, the start of a line, or anything without a letter or digit between blanks; the two content
words after it, common
words skipped, are its signature. A fingerprint is the set of a text's signatures, as sorted 32-bit hashes. Their
likeness is the Jaccard similarity of the sets. Documents that are alike have sets of like size, so a search compares
only neighbouring partitions of set sizes, and within them only documents that share one of their rarest signatures.

Everything here is column expressions and joins.

Edge cases: a text without a signature has the empty set, or, if it has words, one signature of all its words; two
empty sets have likeness 1, an empty and another one 0; null texts are empty; null ids come before all others in the
order; rows that repeat an id follow one another in the order of their texts; the only row of a table is its own next
one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.session import stage

# ---- fixed values: common words of four languages --------------------------
COMMON_WORDS = (
    "a an and are as at be but by for from had has have he her his if in is it its not of on or she so that the "
    "their there they this to was we were which who will with would you "
    "au aux ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas pour "
    "que qui sa sans se ses son sont sur un une vous "
    "aber als am auch auf aus bei bin bis das dass dem den der des die doch ein eine einem einen einer er es für hat "
    "ich ihr im in ist mit nach nicht noch nur oder sein sich sie sind so über um und uns von vor war was wie wir zu zum zur "
    "al como con cuando del el ella ellos era esta este fue ha hay la las lo los más me mi muy no nos o para pero por "
    "porque se ser si sin sobre su sus también te tiene todo un una y ya"
).split()
# ----------------------------------------------------------------------------
COMMON = sorted(set(COMMON_WORDS))
SPOT = "\u0001"
ROWS_PER_RANGE = 4096
MOST_RANGES = 16_384


def with_signatures(rows: DataFrame, text: str, name: str) -> DataFrame:
    """The rows with a column of sorted distinct 32-bit hashes of the signatures of a text.

    Every step that is used twice is a column of its own, so that it is computed once per row.
    """
    low = F.concat(F.lit(f"{SPOT} "), F.regexp_replace(F.lower(text), "\n", f"\n{SPOT} "))
    bare = F.regexp_replace(low, rf"[^\p{{L}}\p{{N}}\s{SPOT}]+", SPOT)
    spaced = F.trim(F.regexp_replace(bare, r"[\s\u0085 ]+", " "))
    # Signs inside or beside a word go; between blanks they are spots.
    words = F.split(F.regexp_replace(spaced, f"(?<=[^ {SPOT}]){SPOT}+|{SPOT}+(?=[^ {SPOT}])", ""), " ")
    marked = F.array_join(F.transform(words, lambda w: F.when(w.isin(COMMON), SPOT).otherwise(w)), " ")
    # A spot now stands before the content word that follows it, or, at the end of the text, alone.
    joined = F.regexp_replace(marked, f"{SPOT}[{SPOT} ]* ", SPOT)  # no group: a long run would nest too deep
    chains = F.regexp_extract_all("_joined", F.lit(f"{SPOT}(?=([^ {SPOT}]+ {SPOT}?[^ {SPOT}]+))"), F.lit(1))
    whole = F.trim(F.translate("_joined", SPOT, ""))
    found = F.when(F.size("_chains") > 0, F.col("_chains")).when(F.col("_whole") != "", F.array("_whole"))
    hashes = F.transform(F.coalesce(found, F.array().cast("array<string>")), lambda c: F.hash(F.translate(c, SPOT, "")))
    rows = rows.withColumn("_joined", joined).withColumn("_chains", chains).withColumn("_whole", F.when(F.size("_chains") == 0, whole))
    return rows.withColumn(name, F.sort_array(F.array_distinct(hashes))).drop("_joined", "_chains", "_whole")


def as_text(signature_set: Column) -> Column:
    """Eight hexadecimal digits per signature."""
    digits = F.transform(signature_set, lambda s: F.lpad(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    return F.lower(F.array_join(digits, ""))


def likeness(one: Column, two: Column) -> Column:
    """Jaccard similarity of two signature sets; sizes alone settle the empty cases."""
    shared = F.size(F.array_intersect(one, two))
    total = F.size(one) + F.size(two) - shared
    return F.when(total == 0, 1.0).otherwise(shared / total).cast("double")


def _ranges(documents: DataFrame) -> list[int]:
    """Ids that open ranges of about ROWS_PER_RANGE rows: at most MOST_RANGES numbers, whatever the table."""
    n, low = documents.agg(F.count("doc_id"), F.min("doc_id")).first()
    count = min(MOST_RANGES, n // ROWS_PER_RANGE)
    if not n:
        return []
    if count < 2:
        return [low]
    shares = [i / count for i in range(1, count)]
    cuts = documents.agg(F.percentile_approx("doc_id", shares, 100 * count)).first()[0]
    return sorted({low, *cuts})


def _place(cuts: list[int]) -> Column:
    """Number of the range that an id is in, by a search on two levels; nulls are in the first."""
    step = max(1, math.isqrt(len(cuts)))
    coarse, fine = cuts[::step], [cuts[i : i + step] for i in range(0, len(cuts), step)]
    held = F.array(*[F.lit(c).cast("long") for c in coarse])
    at = F.greatest(F.lit(1), F.size(F.filter(held, lambda c: c <= F.col("doc_id"))))
    lists = F.array(*[F.array(*[F.lit(c).cast("long") for c in part]) for part in fine])
    inner = F.size(F.filter(F.element_at(lists, at), lambda c: c <= F.col("doc_id")))
    return F.coalesce((at - 1) * step + F.greatest(F.lit(1), inner) - 1, F.lit(0)).cast("int")


def with_next(documents: DataFrame) -> DataFrame:
    """(doc_id, text, own, next_text, of_next): each row beside the row that follows it by id, the last beside the first.

    Rows are dealt to ranges of ids, so a text is shuffled once. The first row of each range is dealt to the range
    before it as well, where it only ends the order.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = _ranges(rows)
    rows = with_signatures(rows, "text", "own")
    if not cuts:
        order = Window.orderBy("text")  # at most rows without an id
        last = Window.orderBy("text").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        beside = F.coalesce(F.lead(F.struct("text", "own")).over(order), F.first(F.struct("text", "own")).over(last))
        return rows.withColumn("beside", beside).select("doc_id", "text", "own", F.col("beside.text").alias("next_text"), F.col("beside.own").alias("of_next"))
    here = _place(cuts)
    nulls = F.min(F.col("doc_id").isNull().cast("int") * -1)
    has_null = rows.agg(nulls).first()[0] == -1
    opens = F.col("doc_id").isNull() if has_null else F.lit(False)
    edges = F.array(*[F.lit(c).cast("long") for c in cuts[1:]]) if len(cuts) > 1 else F.array().cast("array<bigint>")
    first = opens if has_null else F.col("doc_id") == cuts[0]
    before = F.when(first, len(cuts) - 1).when(F.array_contains(edges, F.col("doc_id")), here - 1)
    copies = F.filter(F.array(F.struct(here.alias("range"), F.lit(0).alias("ends")), F.struct(before.cast("int").alias("range"), F.lit(1).alias("ends"))), lambda c: c["range"].isNotNull())
    dealt = rows.select("*", F.explode(copies).alias("at")).select("doc_id", "text", "own", "at.range", "at.ends")
    dealt = dealt.repartition(len(cuts), "range")  # by rows, not by bytes: the work behind it is by words
    order = Window.partitionBy("range").orderBy("ends", F.col("doc_id").asc_nulls_first(), "text")
    after = dealt.withColumn("next_text", F.lead("text").over(order)).withColumn("of_next", F.lead("own").over(order))
    return after.where("ends = 0").drop("range", "ends")


def fingerprints(documents: DataFrame) -> DataFrame:
    """The contract's rows: a text's own fingerprint, its edited text's, and two likenesses."""
    n = F.char_length("text").cast("long")
    pairs = with_next(documents).withColumn("n_chars", n)
    edited = F.concat(F.expr("substring(text, 1, int(n_chars - n_chars div 2))"), F.expr("substring(next_text, 1, int(n_chars div 2))"))
    sets = with_signatures(pairs.withColumn("edited", edited).withColumn("edited_sha256", F.sha2(F.encode("edited", "UTF-8"), 256)), "edited", "of_edited")
    return sets.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("of_edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("of_edited")).alias("near_edited"), likeness(F.col("own"), F.col("of_next")).alias("near_next"),
    )


def near_duplicates(documents: DataFrame, least: float = 0.8) -> DataFrame:
    """(class_id, other_id, likeness): pairs of distinct fingerprints that are alike; a class is named by its least id.

    Documents with equal sets are one class. Set sizes fall into partitions that are 1 / least times as wide as they
    begin, so partners are in the same or the next one. Signatures are put in order of their frequency, and classes
    meet on the few rarest that any partner must share; a class is dropped from a meeting by size, before its set is read.
    """
    texts = documents.where(F.col("doc_id").isNotNull()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = with_signatures(texts, "text", "set").select("doc_id", "set")
    classes = own.where(F.size("set") > 0).groupBy("set").agg(F.min("doc_id").alias("id")).withColumn("n", F.size("set"))
    classes = stage(classes, "signature-classes")
    rows = classes.select("id", "n", F.explode("set").alias("signature"))
    common = rows.groupBy("signature").agg(F.count("*").alias("df"))
    order = Window.partitionBy("id").orderBy("df", "signature")
    prefix = F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9) + 1
    rare = rows.join(common, "signature").withColumn("place", F.row_number().over(order)).where(F.col("place") <= prefix)
    part = F.floor(F.log("n") / -math.log(least) + 1e-9).cast("int")
    left = rare.select("signature", part.alias("part"), F.col("id").alias("a"), F.col("n").alias("n_a"))
    right = rare.select("signature", F.explode(F.array(part, part - 1)).alias("part"), F.col("id").alias("b"), F.col("n").alias("n_b"))
    sized = (F.col("n_a") <= F.col("n_b")) & (F.col("n_a") >= least * F.col("n_b") - 1e-9) & ((F.col("n_a") < F.col("n_b")) | (F.col("a") < F.col("b")))
    met = left.join(right, ["signature", "part"]).where(sized & (F.col("a") != F.col("b"))).select("a", "b").distinct()
    one = classes.select(F.col("id").alias("a"), F.col("set").alias("set_a"))
    two = classes.select(F.col("id").alias("b"), F.col("set").alias("set_b"))
    full = met.join(one, "a").join(two, "b").withColumn("likeness", likeness(F.col("set_a"), F.col("set_b")))
    return full.where(F.col("likeness") >= least).select(F.least("a", "b").alias("class_id"), F.greatest("a", "b").alias("other_id"), "likeness")

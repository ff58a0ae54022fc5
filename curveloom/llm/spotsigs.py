"""Document fingerprints by SpotSigs: what follows common words.

Common words of running text (anchors) mark spots; the chain of the next content words, common ones
skipped, is a signature.  The set of signatures is the fingerprint, and two documents are as alike as the
Jaccard likeness of their sets.  Only built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from curveloom.llm.tables import stored

# fixed values: words that open a signature, and further ones that chains skip
ANCHORS = (
    "the", "is", "was", "that", "with",
    "der", "die", "das", "ist", "mit",
    "le", "la", "les", "dans", "une",
    "el", "los", "las", "que", "por",
)
SKIPPED = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "it", "of", "on", "or", "to",
    "auf", "dem", "den", "ein", "eine", "für", "im", "in", "und", "von", "zu",
    "au", "de", "des", "du", "en", "et", "par", "pour", "sur", "un",
    "al", "como", "con", "del", "es", "para", "se", "su", "una", "y",
)
CHAIN = 2
#: words after an anchor among which its chain is sought
REACH = 6
#: hexadecimal digits of a signature in a fingerprint
DIGITS = 8
#: neighbouring ids that are ordered together, and how often such runs are gathered into runs: 12 bits each
RUN, LEVELS = 4096, 5
#: neighbouring ids whose texts are put in order together
RUN_DOCS = 512
NOT_WORD = r"[^\p{L}\p{N}]+"


def signatures(text: Column) -> Column:
    """Sorted distinct signatures of ``text``.  The start of a text is an anchor too, so any content word gives one."""
    common = sorted({*ANCHORS, *SKIPPED})

    def of(words: Column) -> Column:
        def spot(word: Column, i: Column) -> Column:
            content = F.filter(F.slice(words, i + 2, REACH), lambda w: ~w.isin(common))
            chain = F.slice(content, 1, CHAIN)
            return F.when(F.size(chain) > 0, F.substring(F.md5(F.concat_ws(":", word, chain)), 1, DIGITS))

        found = F.transform(words, lambda w, i: F.when(w.isin("^", *ANCHORS), spot(w, i)))
        return F.sort_array(F.array_distinct(F.filter(found, lambda x: x.isNotNull())))

    words = F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")
    # an array of one element binds the words, which are then computed once
    return F.transform(F.array(F.concat(F.array(F.lit("^")), words)), of)[0]


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two signature sets; equal sets (also empty ones) are alike.

    Sets without a common signature by their sizes alone need no comparison.
    """
    shared = F.size(F.array_intersect(a, b))
    return (
        F.when(a == b, F.lit(1.0))
        .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(shared / (F.size(a) + F.size(b) - shared))
    )


def _following(keys: DataFrame, level: int) -> DataFrame:
    """(key, after): ``top`` of the next smaller key; of ``keys(key, top)`` with distinct keys.

    Runs of ``RUN`` neighbouring key values are ordered each on their own, and then the runs in the
    same way, so no task orders more than ``RUN`` rows whatever the number of keys.
    """
    down = F.col("key").desc()
    if level == 0:
        return keys.select("key", F.lead("top").over(Window.partitionBy(F.lit(0)).orderBy(down)).alias("after"))
    runs = keys.withColumn("run", F.floor(F.col("key") / RUN))
    inside = runs.select("run", "key", F.lead("top").over(Window.partitionBy("run").orderBy(down)).alias("inner"))
    outside = _following(runs.groupBy("run").agg(F.max("top").alias("top")).withColumnRenamed("run", "key"), level - 1)
    return inside.join(outside.withColumnRenamed("key", "run"), "run").select(
        "key", F.coalesce("inner", "after").alias("after")
    )


def _with_next(rows: DataFrame) -> DataFrame:
    """``rows(doc_id, text)`` with ``next_text``, the text of the next row by falling doc_id.

    Texts are shuffled once, in runs of ``RUN_DOCS`` neighbouring ids; of each run only the first text
    is also sent to the run before.
    """
    keyed = rows.withColumn("run", F.floor(F.col("doc_id") / RUN_DOCS))
    tie = F.xxhash64("text")
    heads = stored(
        keyed.groupBy("run").agg(F.max(F.struct("doc_id", F.bitwise_not(tie), "text"))["text"].alias("head")), "heads"
    )
    largest = heads.agg(F.max("run")).first()[0]
    following = _following(heads.select(F.col("run").alias("key"), F.col("run").alias("top")), LEVELS)
    nexts = following.select(F.col("key"), F.coalesce("after", F.lit(largest)).alias("run")).join(heads, "run").select(
        F.col("key").alias("run"), "head"
    )
    order = Window.partitionBy("run").orderBy(F.col("doc_id").desc(), tie)
    return keyed.withColumn("next_text", F.lead("text").over(order)).join(nexts, "run").select(
        "doc_id", "text", F.coalesce("next_text", "head").alias("next_text")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last half of the text's code points replaced by the first ones of the next
    document, by descending doc_id and then from the largest again.  A fingerprint is the sorted
    signatures, joined; near_edited and near_next are its Jaccard likeness to those of the edited text
    and of the next document.  A NULL text is empty: its fingerprint is empty, as that of any text
    without a content word.  Rows that repeat a doc_id follow one another by a hash of the text.  A row
    without doc_id is nobody's next and has an empty next document.
    """
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    rows = _with_next(base.where("doc_id IS NOT NULL")).union(
        base.where("doc_id IS NULL").withColumn("next_text", F.lit(""))
    )
    edited = F.concat(
        F.expr("substring(text, 1, length(text) - half)"), F.expr("substring(next_text, 1, half)")
    )
    return (
        rows.withColumn("half", F.floor(F.length("text") / 2).cast("int"))
        .withColumn("edited", edited)
        .withColumns({"spots": signatures(F.col("text")), "edited_spots": signatures(F.col("edited")), "next_spots": signatures(F.col("next_text"))})
        .select(
            "doc_id",
            F.length("text").cast("long").alias("n_chars"),
            F.sha2("edited", 256).alias("edited_sha256"),
            F.array_join("spots", "").alias("fingerprint"),
            F.array_join("edited_spots", "").alias("edited_fingerprint"),
            likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
            likeness(F.col("spots"), F.col("next_spots")).alias("near_next"),
        )
    )

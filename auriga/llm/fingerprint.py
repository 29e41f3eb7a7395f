"""Winnowing fingerprints in Spark's own functions: k-gram hashes, window minima, positions."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auriga.llm.common import let, split_words, text_of

GRAM = 5
WINDOW = 8


def winnow(text: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The selected (hash, position) pairs of a text, by position; empty for a text without words.

    Words are lower-cased. Each word is hashed once; the hash of a k-gram combines its words' hashes. In
    every window of k-gram hashes the smallest is chosen, the rightmost of equal ones. Two texts that share
    gram + window - 1 words in a row share a selected hash with its positions, and shared runs shorter than
    gram words are never reported. A text of fewer words than a gram has one gram of all its words; fewer
    grams than a window make one window.
    """
    return let(
        F.transform(split_words(F.lower(text)), lambda w: F.xxhash64(w)),
        lambda words: let(
            F.transform(
                F.sequence(F.lit(0), F.greatest(F.size(words) - gram, F.lit(0))),
                lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(gram)]),
            ),
            lambda grams: F.when(
                F.size(words) > 0,
                F.transform(
                    F.array_distinct(_minima(grams, window)),
                    lambda at: F.struct(F.get(grams, at).alias("hash"), at.alias("position")),
                ),
            ).otherwise(F.array().cast("array<struct<hash:bigint,position:int>>")),
        ),
    )


def _minima(hashes: Column, window: int) -> Column:
    """Position of the minimum of each window, rightmost of ties; short windows only if no full one fits.

    Spans are doubled: the best of 2n grams is the better of two neighbouring bests of n.
    """

    def better(best: Column, width: int, step: int) -> Column:
        last = F.size(hashes) - width

        def pick(left: Column, i: Column) -> Column:
            right = F.get(best, i + step)
            return F.when(F.get(hashes, right) <= F.get(hashes, left), right).otherwise(left)

        return F.transform(F.slice(best, 1, F.greatest(last + 1, F.lit(1))), pick)

    def widen(best: Column, width: int) -> Column:
        if width == window:
            return best
        wider = min(2 * width, window)
        return let(best, lambda b: widen(_padded(b, hashes, width, wider, better), wider))

    return widen(F.sequence(F.lit(0), F.size(hashes) - 1), 1)


def _padded(best: Column, hashes: Column, width: int, wider: int, better) -> Column:
    """Bests of the wider spans. Where no full span fits, the bests of what is there."""
    return F.when(F.size(hashes) >= wider, better(best, wider, wider - width)).otherwise(
        F.array(
            F.aggregate(
                best,
                F.get(best, F.lit(0)),
                lambda a, b: F.when(F.get(hashes, b) <= F.get(hashes, a), b).otherwise(a),
            )
        )
    )


def likeness(left: Column, right: Column) -> Column:
    """Jaccard similarity of the selected hashes; 1 for two empty fingerprints, 0 if one is empty."""
    a, b = F.array_distinct(left["hash"]), F.array_distinct(right["hash"])
    common, every = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(every == 0, F.lit(1.0)).otherwise(common / every)


def digest(selected: Column) -> Column:
    """The whole fingerprint, hashes and positions, as 64 hex digits."""
    parts = F.transform(selected, lambda s: F.concat_ws("@", F.hex(s["hash"]), s["position"].cast("string")))
    return F.sha2(F.array_join(parts, ","), 256)


def fingerprints(
    documents: DataFrame, gram: int = GRAM, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id and fingerprint (array of hash and position) of every row; no shuffle. A null text is empty."""
    return documents.select(
        F.col(id_column).alias("doc_id"), winnow(text_of(text_column), gram, window).alias("fingerprint")
    )


def with_next(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, text, next_text: the text of the following row by ascending id; after the last comes the first.

    Rows of equal id follow by text; a null id comes before all others. One row follows itself. An empty
    table gives no rows. See following() for the plan.
    """
    rows, within = following(documents, id_column, text_column)
    return rows.withColumn("next_text", F.lead("text").over(within)).filter("guest = 0").drop("bucket", "guest")


def following(documents: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, Window]:
    """Rows in ranges of ids, and the window in which lead() gives a row's successor.

    Every range also gets a guest: a copy of the first row of the next range, sorted after its own rows.
    So each text is shuffled once, no range waits for another, and no window spans the table. The ranges'
    first ids, one per range, go through the driver.
    """
    spark = documents.sparkSession
    ids = documents.select(F.coalesce(F.col(id_column).cast("double"), F.lit(float("-inf"))).alias("id"))
    ranges = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = ids.repartitionByRange(ranges, "id").groupBy(F.spark_partition_id().alias("range"))
    firsts = sorted(row["first"] for row in numbered.agg(F.min("id").alias("first")).collect())
    order = F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf")))
    rows = documents.select(
        F.col(id_column).cast("bigint").alias("doc_id"), text_of(text_column).alias("text")
    ).withColumn("_order", order)
    if len(firsts) > 1:
        bounds = [float("-inf"), *firsts[1:], float("inf")]
        rows = Bucketizer(splits=bounds, inputCol="_order", outputCol="bucket").transform(rows)
    else:
        rows = rows.withColumn("bucket", F.lit(0.0))
    before = F.when(F.col("bucket") == 0, F.lit(float(len(firsts) - 1))).otherwise(F.col("bucket") - 1)
    own = F.struct(F.col("bucket"), F.lit(0).alias("guest"))
    guest = F.struct(before.alias("bucket"), F.lit(1).alias("guest"))
    first = F.get(F.lit(firsts or [0.0]), F.col("bucket").cast("int"))
    places = F.when(F.col("_order") == first, F.array(own, guest)).otherwise(F.array(own))
    rows = rows.select("doc_id", "text", F.explode(places).alias("place")).select("doc_id", "text", "place.*")
    within = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "text")
    return rows, within


def edited_fingerprints(
    documents: DataFrame, gram: int = GRAM, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Each row's fingerprint beside that of its edited text and of the next row's text.

    The edited text has its last floor(n / 2) code points replaced by the first as many of the next text.
    """
    rows, within = following(documents, id_column, text_column)
    chars = F.char_length("text")
    half = F.floor(chars / 2).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), chars - half)
    return (
        rows.withColumn("next_text", F.lead("text").over(within))
        .select(
            "*",
            chars.cast("bigint").alias("n_chars"),
            F.concat(kept, F.substring(F.col("next_text"), F.lit(1), half)).alias("edited"),
            winnow(F.col("text"), gram, window).alias("selected"),
        )
        .withColumn("next_selected", F.lead("selected").over(within))
        .filter("guest = 0")
        .withColumn("edited_selected", winnow(F.col("edited"), gram, window))
        .select("doc_id", "n_chars", "edited", "selected", "edited_selected", "next_selected")
    )

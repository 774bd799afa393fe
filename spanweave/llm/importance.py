"""Importance resampling towards a target distribution by hashed word n-grams.

Words are exploded with their positions; ``lead`` over a document's positions adds the words that follow, for each order above one. An n-gram's
CRC-32 gives its bucket. A bucket's gain is the logarithm of how much more frequent it is in the target than in the documents; a document's
weight is the sum over its n-grams, and with Gumbel noise from its doc_id the best weights are a sample without replacement.

Only built-in expressions run. The gains are joined by broadcast: there are as many as buckets, however many documents there are.

Defined cases: a document is a row, so repeated rows are documents of their own; a null text has no words; a document without features weighs 0; a
null doc_id takes its noise from the empty text; equal scores are ranked by doc_id, nulls last; an empty table gives an empty result, an empty target
equal shares; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanweave.llm.common import documents, materialize

QUERY = "op13_importance_resampling"
#: Of n-grams.
ORDERS = 1
BUCKETS = 10_000
SEED = 2024
#: Documents with fewer words aren't drawn; of the others so many in a hundred are.
MIN_WORDS = 20
PERCENT = 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; ASCII characters but letters and digits part them."""
    return F.filter(F.split(F.translate(text, _UPPER, _LOWER), _BETWEEN), lambda w: w != "")


def positions(texts: DataFrame) -> DataFrame:
    """(row, pos, word) of (row, text): each word with its place; a text without words keeps one row without both."""
    return texts.select("row", F.posexplode_outer(_words(F.col("text"))).alias("pos", "word"))


def features(words: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """(row, n, bucket): the n-grams of orders 1 to ``orders`` at each position, repeats included, n being the order."""
    follows = Window.partitionBy("row").orderBy("pos")
    ahead = words.select("row", F.col("word").alias("w0"), *(F.lead("word", k).over(follows).alias(f"w{k}") for k in range(1, orders)))
    if orders == 1:
        grams = ahead.select("row", F.when(F.col("w0").isNotNull(), 1).alias("n"), F.col("w0").alias("gram"))
    else:
        each = [F.when(F.col(f"w{k - 1}").isNotNull(), F.struct(F.lit(k).alias("n"), F.concat_ws(" ", *(f"w{i}" for i in range(k))).alias("gram"))) for k in range(1, orders + 1)]
        grams = ahead.select("row", F.explode_outer(F.filter(F.array(*each), lambda g: g.isNotNull())).alias("g")).select("row", "g.n", "g.gram")
    return grams.select("row", "n", F.pmod(F.crc32("gram"), F.lit(buckets)).cast("int").alias("bucket"))


def _counts(found: DataFrame) -> DataFrame:
    return materialize(found.where("bucket IS NOT NULL").groupBy("bucket").agg(F.count("*").alias("n")), "bucket-counts")


def gains(found: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket that has a feature: 1000 times the logarithm of the smoothed shares' quotient, rounded down."""
    own, other = _counts(found), _counts(target)
    total, goal = (c.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for c in (own, other))
    share = own.withColumnRenamed("n", "s").join(other.withColumnRenamed("n", "t"), "bucket", "left")
    t = F.coalesce("t", F.lit(0))
    quotient = ((t + 1) * F.lit(float(total + buckets))) / ((F.col("s") + 1) * F.lit(float(goal + buckets)))
    return share.select("bucket", F.floor(1000 * F.log(quotient)).alias("gain"))


def weights(texts: DataFrame, target: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """(row, n_words, n_features, weight) for each row of (row, text) against the texts of ``target``."""
    found = features(positions(texts), orders, buckets)
    goal = features(positions(target.select(F.monotonically_increasing_id().alias("row"), "text")), orders, buckets)
    gain = materialize(gains(found, goal, buckets), "bucket-gains")
    sums = [F.count(F.when(F.col("n") == 1, 1)).alias("n_words"), F.count("bucket").alias("n_features"), F.coalesce(F.sum("gain"), F.lit(0)).alias("weight")]
    return found.join(F.broadcast(gain), "bucket", "left").groupBy("row").agg(*sums)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times a Gumbel variate, rounded down, from a hash of the doc_id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(row, rank) of the best ``percent`` in a hundred of (row, doc_id, score).

    Sorted by ranges; a row's rank is its place in its range and the sizes of the ranges before, so that no task numbers them all.
    """
    order = [F.desc("score"), F.col("doc_id").asc_nulls_last(), "row"]
    placed = materialize(rows.orderBy(*order).select("row", F.monotonically_increasing_id().alias("at")), "importance-order")
    part = F.shiftright("at", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = materialize(sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"), "n"), "importance-ranges")
    drawn = (before.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] * percent) // 100
    named = placed.withColumn("part", part).join(F.broadcast(before), "part")  # a row for each range
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return named.select("row", rank.alias("rank")).where(F.col("rank") <= drawn)


def resample(docs: DataFrame, target: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS, seed: int = SEED, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of each document; rank is null for those not drawn."""
    texts = materialize(docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id()), "importance-rows")
    scored = weights(texts.select("row", "text"), target, orders, buckets).join(texts.select("row", "doc_id"), "row")
    scored = materialize(scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "importance-scores")
    ranks = ranked(scored.where(F.col("n_words") >= min_words).select("row", "doc_id", "score"), percent)
    return scored.join(ranks, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")


def query(spark, sf_dir):
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: CRC-32 by its table: entries by eight shifts each, then a byte of the word after the other.
ORACLE_SQL = r"""
WITH crc_table AS (
  SELECT list(e ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_concat([i], [k::BIGINT FOR k IN range(8)]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS e
    FROM (SELECT unnest(range(256))::BIGINT AS i))),
split AS (
  SELECT 'd' AS side, doc_id, row_number() OVER () AS r, text FROM documents
  UNION ALL SELECT 'b', NULL, row_number() OVER (), text FROM benchmark),
words AS (
  SELECT side, r, unnest(list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')) AS word
  FROM split),
vocabulary AS (
  SELECT word, xor(list_reduce(list_concat([4294967295::BIGINT], [('0x' || substr(hex(encode(word)), 2 * k + 1, 2))::BIGINT FOR k IN range(octet_length(encode(word)))]),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM words), crc_table),
hashed AS (SELECT side, r, bucket FROM words JOIN vocabulary USING (word)),
sizes AS (SELECT count(*) FILTER (side = 'd') AS own, count(*) FILTER (side = 'b') AS goal FROM hashed),
gain AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (own + 10000)::DOUBLE) / ((s + 1) * (goal + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM hashed GROUP BY bucket), sizes),
weighed AS (SELECT r, count(*) AS n, sum(gain)::BIGINT AS weight FROM hashed JOIN gain USING (bucket) WHERE side = 'd' GROUP BY r),
scored AS (
  SELECT doc_id, r, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM split LEFT JOIN weighed USING (r) WHERE side = 'd'),
drawn AS (
  SELECT r, rank FROM (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS total FROM scored WHERE n_features >= 20)
  WHERE rank <= (10 * total) // 100)
SELECT doc_id, n_features, weight, score, rank FROM scored LEFT JOIN drawn USING (r)
"""

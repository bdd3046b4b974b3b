"""Importance resampling towards a target corpus, by hashed n-gram features.

DuckDB counts, Spark merges. Every task hands its documents to an in-memory DuckDB, a slice of bounded size at a
time: SQL unnests the words, windows them into n-grams and counts them by bucket, with zlib's CRC-32 as a registered function.
The counts of each document are written as Parquet to the shared folder. Spark sums them by bucket, derives each
bucket's gain and each document's weight, adds noise that a digest of the id fixes (which makes the highest scores a
draw without replacement by weight), and numbers the drawn documents from a range-partitioned order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import duckdb
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cytoflux.llm.common import LOWER, UPPER, Scratch, cut

BUCKETS, SEED, PERCENT, MIN_WORDS = 10_000, 2024, 10, 20
#: Words are runs of other characters than these.
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
#: UTF-8 bytes of texts (one text at least) that one statement counts.
SLICE = 8 << 20


def counting_sql(least: int, most: int, buckets: int) -> str:
    """DuckDB SQL over slice(row, text): by row n_words, n_features, and the lists bucket and n."""
    grams = []
    for n in range(least, most + 1):
        words = ["word", *(f"lead(word, {k}) OVER places" for k in range(1, n))]
        if n == 1:
            grams.append("SELECT row, word AS feature FROM words")
        else:  # a window that runs past the last word has none
            grams.append(f"SELECT row, feature FROM (SELECT row, concat_ws(' ', {', '.join(words)}) AS feature, {words[-1]} AS final FROM words WINDOW places AS (PARTITION BY row ORDER BY place)) WHERE final IS NOT NULL")
    return f"""WITH lists AS (SELECT row, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^{SEPARATORS}]+') AS list FROM slice),
 words AS (SELECT row, unnest(list) AS word{', unnest(range(len(list))) AS place' if most > 1 else ''} FROM lists),
 grams AS ({' UNION ALL '.join(grams)}),
 counted AS (SELECT row, feature, count(*) AS n FROM grams GROUP BY row, feature),
 hashed AS (SELECT feature, (zlib_crc32(feature) % {buckets})::INTEGER AS bucket FROM (SELECT DISTINCT feature FROM counted)),
 summed AS (SELECT row, bucket, sum(n)::BIGINT AS n FROM counted JOIN hashed USING (feature) GROUP BY row, bucket),
 listed AS (SELECT row, sum(n)::BIGINT AS n_features, list(bucket) AS bucket, list(n) AS n FROM summed GROUP BY row)
 SELECT lists.row, coalesce(len(list), 0)::BIGINT AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(bucket, []) AS bucket, coalesce(n, []) AS n
 FROM lists LEFT JOIN listed ON lists.row = listed.row ORDER BY lists.row"""


def _crc32(features: pa.ChunkedArray) -> pa.Array:
    return pa.array([zlib.crc32(f.encode()) for f in features.to_pylist()], pa.uint32())


def _slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    start = size = 0
    for k, text in enumerate(batch.column(1)):
        size += len(text.as_buffer()) if text.is_valid else 0
        if size >= most:
            yield batch.slice(start, k + 1 - start)
            start, size = k + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def count_features(docs: DataFrame, least: int = 1, most: int = 1, buckets: int = BUCKETS, id_column: str = "doc_id") -> DataFrame:
    """row (unique), the id, n_words, n_features, and the lists bucket and n of each document.

    Null and empty texts, and texts without a word, have no features; texts of any length are counted whole.
    """
    sql = counting_sql(least, most, buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with duckdb.connect(":memory:", config={"threads": 1}) as con:
            con.execute("SET temp_directory = ''")  # no files on the machine
            con.create_function("zlib_crc32", _crc32, ["VARCHAR"], "UINTEGER", type="arrow")
            row = TaskContext.get().partitionId() << 33
            for batch in batches:
                for part in _slices(batch, SLICE):
                    texts = pa.table({"row": pa.array(range(row, row + part.num_rows), pa.int64()), "text": part.column(1)})
                    con.register("slice", texts)
                    counted = con.sql(sql).to_arrow_table().combine_chunks()
                    con.unregister("slice")
                    row += part.num_rows
                    yield from pa.table([counted["row"], part.column(0), *(counted[c] for c in COUNTED[1:])], [COUNTED[0], "id", *COUNTED[1:]]).to_batches()

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column).alias("id"), "text").mapInArrow(run, f"row long, id {kind}, n_words long, n_features long, bucket array<int>, n array<long>")


COUNTED = ["row", "n_words", "n_features", "bucket", "n"]


def _by_bucket(counted: DataFrame, total: str) -> DataFrame:
    """bucket and its features' number: at most as many rows as buckets."""
    pairs = counted.select(F.explode(F.arrays_zip("bucket", "n")).alias("x")).select("x.bucket", "x.n")
    return pairs.groupBy("bucket").agg(F.sum("n").alias(total))


def _sum(counts: DataFrame, column: str) -> float:
    return float(counts.agg(F.coalesce(F.sum(column), F.lit(0))).first()[0])


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """bucket and gain: floor(1000 * ln of the target's share of the bucket over the corpus' share, both smoothed by one)."""
    corpus_total, target_total = _sum(corpus, "s") + buckets, _sum(target, "t") + buckets
    s, t = F.col("s").cast("double") + 1, F.coalesce("t", F.lit(0)).cast("double") + 1
    ratio = t * corpus_total / (s * target_total)
    return corpus.join(target, "bucket", "left").select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def noise(doc_id: Column, seed: int) -> Column:
    """floor(1000 * a standard Gumbel variate), fixed by seed and id; a null id is as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def number_highest(scored: DataFrame, take: int, scratch: Scratch) -> DataFrame:
    """row and rank of the `take` rows of highest score, ties to the smaller doc_id (nulls last), then n_features, then row."""
    # Scores are whole numbers within some 100,000, so that their histogram is small; it bounds what is ordered at all.
    upto = F.sum("n").over(Window.orderBy(F.desc("score")))
    least = scored.groupBy("score").agg(F.count("*").alias("n")).select("score", "n", upto.alias("upto")).where(F.col("upto") - F.col("n") < take).agg(F.min("score")).first()[0]
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("row")]
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    high = scored.where(F.col("score") >= F.lit(least)).select("row", "doc_id", "n_features", "score")
    ordered = scratch.cut(high.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("row", F.monotonically_increasing_id().alias("place")))
    part = F.shiftright("place", 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # One row a partition.
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    placed = ordered.select("row", part.alias("part"), F.col("place").bitwiseAND((1 << 33) - 1).alias("nth")).join(F.broadcast(before), "part")
    return placed.select("row", (F.col("before") + F.col("nth") + 1).alias("rank")).where(F.col("rank") <= take)


def resample(docs: DataFrame, target: DataFrame, least: int = 1, most: int = 1, buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score and rank (null: not drawn).

    Features are the runs of `least` to `most` consecutive words; floor(percent * N / 100) of the N documents with
    min_words words are drawn. Repeated rows are documents of their own; rows that share id and score are ranked by n_features, then
    by their place in the table. A null id is noise's empty id and comes last among ties. Null texts have no features and weight 0. An empty target leaves the
    gains to the corpus; an empty table gives no rows; other columns are not looked at.
    """
    with Scratch(docs.sparkSession) as scratch:
        counted = scratch.cut(count_features(docs, least, most, buckets))
        goal = scratch.cut(_by_bucket(count_features(target.select(F.lit(0).alias("doc_id"), "text"), least, most, buckets), "t"))
        gain = scratch.cut(gains(scratch.cut(_by_bucket(counted, "s")), goal, buckets))
        # Broadcast: one row a bucket. A document's rows are in one task, so that they are one row again before the shuffle.
        pairs = counted.select("row", F.explode(F.arrays_zip("bucket", "n")).alias("x")).select("row", "x.bucket", "x.n")
        sums = pairs.join(F.broadcast(gain), "bucket").groupBy("row").agg(F.sum(F.col("n") * F.col("gain")).alias("total"))
        weighed = counted.select("row", F.col("id").alias("doc_id"), "n_words", "n_features").join(sums, "row", "left")
        weighed = weighed.withColumn("weight", F.coalesce(F.floor(F.col("total") / F.col("n_features")), F.lit(0)).cast("long"))
        scored = cut(weighed.select("row", "doc_id", "n_words", "n_features", "weight", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score")))
        eligible = scored.where(F.col("n_words") >= min_words)
        take = percent * eligible.count() // 100
        columns = ["doc_id", "n_features", "weight", "score"]
        if not take:
            return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
        ranks = cut(number_highest(eligible, take, scratch))
        return scored.join(ranks, "row", "left").select(*columns, "rank")

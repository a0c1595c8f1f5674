"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame expressions only.

Test items are partitioned by their number of distinct five-word shingles into classes (1, 2, 3-4, 5-8, 9-16 ...).
An item's sketch is the bottom of its MinHash order: its k shingles with the smallest hashes, k being one more than
a document may lack in that class and still hold `CONTAINED` of the item. So every such document holds a sketch
shingle: candidates are the documents that do, however long they are, and none is missed. Candidates are then
verified by exact shingle containment.

Documents aren't shuffled: their shingle hashes are streamed past the sketches, which are broadcast after their rows
and bytes have been added up (beyond those bounds, joined by a shuffle), and so are the few candidates' keys in the
verifying pass.

Words are runs of letters and digits of the lower-cased text. An item of one to four words is one shingle of its own
width, in a class of its own; documents get shingles of such a width only where the items have it, and hold the item
where its words stand in a row. Defined cases: null or empty text, or one
without a word, neither contains nor is contained; repeated rows give one result each; rows are told apart by id and
text (`shared.keyed`), null ids included; other columns are ignored. Whole texts are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tendril.llm.shared import keyed, maybe_broadcast, table, written

SHINGLE = 5
CONTAINED = 80  # hundredths of an item's distinct shingles
WORDS = r"[\p{L}\p{N}]+"
_PARTS = ["s0", "s1", "s2", "s3", "s4"]


def words_of(text: str) -> Column:
    return F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORDS), F.lit(0))


def shingle_words(words: Column, widths: list[int] | None = None) -> Column:
    """An array with a struct of words for each shingle, nulls at the end of narrow ones: of the given widths, or of the
    text's own, which is five words, or all of a shorter text."""

    def of(n: Column, width: int) -> Column:
        return F.arrays_zip(*[F.slice(words, k + 1, n if k < width else F.lit(0)).alias(name) for k, name in enumerate(_PARTS)])

    if widths is None:
        return of(F.when(F.size(words) > 0, F.greatest(F.size(words) - (SHINGLE - 1), F.lit(1))).otherwise(0), SHINGLE)
    arrays = [of(F.greatest(F.size(words) - (w - 1), F.lit(0)), w) for w in widths]
    return F.concat(*arrays) if len(arrays) > 1 else arrays[0]


def shingle_strings(words: Column, widths: list[int] | None = None) -> Column:
    return F.array_distinct(F.transform(shingle_words(words, widths), lambda x: F.concat_ws(" ", *[x[name] for name in _PARTS])))


def hashes_of(df: DataFrame, key: str, widths: list[int] | None = None) -> DataFrame:
    """df (key, words) -> key, h: a row for each shingle."""
    return df.select(key, F.inline(shingle_words(F.col("words"), widths))).select(key, F.xxhash64(*_PARTS).alias("h"))


def sketches(items: DataFrame) -> DataFrame:
    """items (item, words) -> item, h: each item's bottom-k shingle hashes, k by its size class."""
    hashed = hashes_of(items, "item").distinct()
    own = Window.partitionBy("item")
    ranked = hashed.select("item", "h", F.row_number().over(own.orderBy("h")).alias("rank"), F.count(F.lit(1)).over(own).alias("n"))
    most = F.pow(F.lit(2.0), F.ceil(F.log2("n"))).cast("long")  # of the class
    lacked = F.floor(most * (100 - CONTAINED) / 100)
    return ranked.where(F.col("rank") <= lacked + 1).select("item", "h")


def _contained(texts: DataFrame, items: DataFrame) -> DataFrame:
    """texts (key, doc_id, text), items (item_id, text) -> key, doc_id, item_id, n_shingles, n_found."""
    bench = written(items.select("item_id", words_of("text").alias("words")).where(F.size("words") > 0).withColumn("item", F.monotonically_increasing_id()), "items")
    sketch = written(sketches(bench.select("item", "words")), "sketches")
    widths = sorted(r[0] for r in bench.select(F.least(F.size("words"), F.lit(SHINGLE))).distinct().collect()) or [SHINGLE]  # of five at most
    found = hashes_of(texts.select("key", words_of("text").alias("words")), "key", widths).join(maybe_broadcast(sketch), "h").select("key", "item").distinct()
    candidates = written(found, "candidates")
    keys = written(candidates.select("key").distinct(), "candidate_keys")
    suspects = texts.join(maybe_broadcast(keys), "key", "left_semi").select("key", "doc_id", shingle_strings(words_of("text"), widths).alias("theirs"))
    named = written(bench.select("item", "item_id", shingle_strings(F.col("words")).alias("own")), "item_shingles")
    pairs = suspects.join(candidates.join(maybe_broadcast(named), "item"), "key")
    counted = pairs.select("key", "doc_id", "item_id", F.size("own").cast("long").alias("n_shingles"), F.size(F.array_intersect("own", "theirs")).cast("long").alias("n_found"))
    return counted.where(f"100 * n_found >= {CONTAINED} * n_shingles")


def contained_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs (doc_id, text), items (item_id, text) -> doc_id, item_id, n_shingles, n_found, containment."""
    own, _, key, _ = keyed(docs.select("doc_id", "text"))
    found = _contained(own.where("text is not null").select(F.col(key).alias("key"), "doc_id", "text"), items)
    return found.drop("key").withColumn("containment", F.col("n_found") / F.col("n_shingles"))


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without those that contain a test item; all columns stay."""
    own, _, key, _ = keyed(docs)
    found = _contained(own.where("text is not null").select(F.col(key).alias("key"), "doc_id", "text"), items)
    gone = written(found.select(F.col("key").alias(key)).distinct(), "contaminated")
    return own.join(maybe_broadcast(gone), key, "left_anti").select(docs.columns)


def op9_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _shingles_sql(source: str, key: str) -> str:
    return (
        f"SELECT DISTINCT rid, {key}, array_to_string(ws[i:i + 4], ' ') AS s FROM (SELECT rid, {key}, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i"
        f" FROM (SELECT row_number() OVER () AS rid, {key}, regexp_extract_all(lower(text), '{WORDS}') AS ws FROM {source} WHERE text IS NOT NULL) WHERE len(ws) > 0)"
    )


OP9_SQL = f"""
WITH b AS ({_shingles_sql("benchmark", "item_id")}),
n AS (SELECT rid, count(*) AS n_shingles FROM b GROUP BY rid),
w AS (SELECT DISTINCT least(len(regexp_extract_all(text, '{WORDS}')), {SHINGLE}) AS w FROM benchmark),
d AS (
  SELECT DISTINCT rid, doc_id, array_to_string(ws[i:i + w - 1], ' ') AS s FROM (SELECT rid, doc_id, ws, w, unnest(range(1, len(ws) - w + 2)) AS i
  FROM (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(text), '{WORDS}') AS ws FROM documents WHERE text IS NOT NULL), w WHERE w > 0)
),
m AS (SELECT d.rid, d.doc_id, b.rid AS item, b.item_id, count(*) AS n_found FROM d JOIN b USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_shingles, n_found, n_found / n_shingles AS containment
FROM m JOIN n ON n.rid = m.item WHERE 100 * n_found >= {CONTAINED} * n_shingles
"""

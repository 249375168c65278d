"""Benchmark decontamination by a prefix-filtered set join.

Benchmark items are cut into windows of ``WINDOW`` consecutive words (a shorter item is one
window), windows into shingles of ``SHINGLE`` words. A document that holds a window holds all
its shingles, so it is enough to look for one of them: the prefix of a window is its rarest
shingle over the whole corpus. Document shingles meet the prefixes in an equi-join;
the place of the shingle in the window bounds where the window must start (not before the
document) and end (not after it), and the words there are compared with the window.

Only DataFrame expressions are used. One scan of the texts finds the positions whose shingle
may belong to an item (a bit table of ``BITS`` bits, a constant of proven size; chance hits
only cost rows) and keeps them with the words around; rarity, join and verification work on
these rows. They and the prefixes are landed, so Spark can split the join on a hot shingle.

Edge cases: null and wordless texts have no words and no hits; null and wordless items have no
windows; the windows of an item with a null id hit, but the id is not listed; repeated items
count once per id; rows that repeat a doc_id are judged each by its own text; items_sha256 is
the digest of the empty string without items. Very long texts are scanned whole. Extra columns
are ignored; an empty table gives an empty result or one without hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartloom.llm.common import landed, lower_az, table
from cartloom.llm.lookup import long_array

WINDOW = 10
SHINGLE = 3
BITS = 1 << 23
#: Words stand between ASCII characters that are neither digits nor lower-case letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; null: none."""
    # Splitting is several times cheaper than extracting all matches of the complement.
    return F.coalesce(F.array_remove(F.split(lower_az(text), SEPARATORS), ""),
                      F.array().cast("array<string>"))


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """``item, wid, words`` for every window of every item; ``wid`` is the joined words."""
    words = items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("w"))
    cut = F.when(F.size("w") >= window, F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1))),
        lambda i: F.slice("w", i, window))).otherwise(F.array("w"))
    return (words.where(F.size("w") > 0).select("item", F.explode(cut).alias("words"))
            .select("item", F.array_join("words", " ").alias("wid"), "words"))


def _shingle(words: Column, i: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *[F.get(words, i + k) for k in range(size)])


def _window_shingles(windows: DataFrame) -> DataFrame:
    """``wid, len, j, h``: every shingle of every distinct window and its place."""
    w = windows.select("wid", "words").dropDuplicates(["wid"])
    n = F.size("words")
    places = F.sequence(F.lit(0), n - F.least(n, F.lit(SHINGLE)))
    hashed = F.when(n >= SHINGLE, _shingle(F.col("words"), F.col("j"), SHINGLE))
    for size in range(1, SHINGLE):
        hashed = F.when(n == size, _shingle(F.col("words"), F.col("j"), size)).otherwise(hashed)
    return (w.select("wid", "words", n.alias("len"), F.explode(places).alias("j"))
            .select("wid", "len", "j", hashed.alias("h")))


def _probes(h: Column) -> list[Column]:
    return [h.bitwiseAND(F.lit(BITS - 1)),
            F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(BITS - 1))]


def _bit_table(hashes: DataFrame) -> Column:
    bits = (hashes.select(F.explode(F.array(*_probes(F.col("h")))).alias("bit"))
            .groupBy(F.shiftright("bit", 6).alias("slot"))
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"),
                                          F.col("bit").bitwiseAND(F.lit(63)).cast("int"))).alias("bits")))
    return long_array(bits, "slot", F.coalesce("bits", F.lit(0).cast("long")), BITS // 64)


def _held(model: Column, bit: Column) -> Column:
    word = F.get(model, F.shiftright(bit, 6).cast("int"))
    one = F.call_function("shiftrightunsigned", word, bit.bitwiseAND(F.lit(63)).cast("int"))
    return one.bitwiseAND(F.lit(1).cast("long")) == 1


def _positions(docs: DataFrame, shingles: DataFrame, id_col: str, text_col: str,
               window: int) -> DataFrame:
    """One row at -1 per document, and one per position whose shingle may be an item's, with
    the words that a window over it can reach."""
    model = _bit_table(shingles.select("h").distinct())
    # Only the shingle sizes that windows have (1 to SHINGLE of them) are looked for: every
    # further size makes the compiled loop over all words larger and slower.
    sizes = sorted(r["k"] for r in shingles.select(F.least("len", F.lit(SHINGLE)).alias("k")).distinct().collect())
    text = F.col(text_col).cast("string")
    words = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("th"),
                        words_of(text).alias("w"))
    n, i, w = F.size("w"), F.col("i"), F.col("w")
    rows = words.select("doc_id", "th", "w", n.alias("n"), F.explode(F.sequence(F.lit(-1), n - 1)).alias("i"))
    hashed = [F.when((i >= 0) & (i + k <= F.col("n")), _shingle(w, i, k)).alias(f"h{k}") for k in sizes]
    rows = rows.select("doc_id", "th", "w", "n", "i", *hashed)
    found = i < 0
    for k in sizes:
        first, second = _probes(F.col(f"h{k}"))
        found = found | (_held(model, first) & _held(model, second))
    lo = F.greatest(i - (window - 1), F.lit(0))
    around = F.slice(w, lo + 1, F.least(F.col("n"), i + window) - lo)
    none = F.lit(None).cast("long")
    return rows.where(found).select(
        "doc_id", "th", F.col("n").cast("long").alias("n"), "i",
        *[F.col(f"h{k}") if k in sizes else none.alias(f"h{k}") for k in range(1, SHINGLE + 1)],
        lo.alias("lo"), F.when(i >= 0, around).alias("around"))


def find_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text", item_id_col: str = "item_id",
                       item_text_col: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """``(documents, hits)``: one row per document (``doc_id, th, n_words``) and one per window
    that occurs in it (``doc_id, th, start, len, wid``); ``th`` is the hash of its text."""
    windows = item_windows(items, item_id_col, item_text_col, window)
    shingles = landed(_window_shingles(windows), "decon-windows")
    rows = landed(_positions(docs, shingles, id_col, text_col, window), "decon-positions")
    at_item = rows.where("i >= 0").select(
        "doc_id", "th", "n", "i", "lo", "around",
        F.explode(F.array(*[f"h{k}" for k in range(1, SHINGLE + 1)])).alias("h")).where("h IS NOT NULL")
    counts = at_item.groupBy("h").count()
    # The rarest shingle of each window; a window with a shingle that never occurs is left out.
    prefix = (shingles.join(counts, "h", "left").groupBy("wid", "len").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("c"), "h", "j")).alias("m"))
        .where("m.c > 0").select("wid", "len", F.col("m.h").alias("h"), F.col("m.j").alias("j")))
    prefix = landed(prefix, "decon-prefixes")
    start = F.col("i") - F.col("j")
    same = F.array_join(F.slice("around", start - F.col("lo") + 1, F.col("len")), " ") == F.col("wid")
    hits = (at_item.join(prefix, "h").where((start >= 0) & (start + F.col("len") <= F.col("n")))
            .where(same).select("doc_id", "th", start.alias("start"), "len", "wid"))
    documents = rows.where("i < 0").select("doc_id", "th", F.col("n").alias("n_words"))
    return documents, landed(hits, "decon-hits")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text",
                  window: int = WINDOW) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    documents, hits = find_contamination(docs, items, id_col, text_col, item_id_col,
                                         item_text_col, window)
    key = ["doc_id", "th"]
    # Words inside the union of the windows: what each adds to those that start before it.
    before = (Window.partitionBy(*key).orderBy("start", "len", "wid")
              .rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("start") + F.col("len")
    added = F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(F.max(end).over(before), F.lit(0))))
    covered = hits.select(*key, added.alias("added")).groupBy(*key).agg(F.sum("added").alias("n_hit"))
    names = item_windows(items, item_id_col, item_text_col, window).select("item", "wid").distinct()
    named = (hits.select(*key, "wid").distinct().join(landed(names, "decon-items"), "wid")
             .where("item IS NOT NULL").groupBy(*key).agg(F.collect_set("item").alias("items")))
    match = lambda b: F.col("d.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (
        F.col("d.th").eqNullSafe(F.col(f"{b}.th")))
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (documents.alias("d").join(covered.alias("c"), match("c"), "left")
            .join(named.alias("m"), match("m"), "left")
            .select("d.doc_id", "n_words", n_hit.alias("n_hit"),
                    F.size(items_of).cast("long").alias("n_items"),
                    F.sha2(F.array_join(F.array_sort(items_of), ",").cast("binary"), 256).alias("items_sha256"),
                    (n_hit > 0).alias("contaminated")))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark),
bw AS (SELECT item_id, CASE WHEN len(w) < 10 THEN len(w) ELSE 10 END AS n,
              unnest(CASE WHEN len(w) >= 10
                          THEN list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9])
                          ELSE [w] END) AS win
       FROM b WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS s, w FROM d, lens WHERE len(w) >= n),
hits AS (SELECT dw.doc_id, dw.s, dw.n, bw.item_id
         FROM (SELECT doc_id, s, n, w[s:s + n - 1] AS win FROM dw) dw JOIN bw USING (n, win)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hits))
        GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL)
        GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""

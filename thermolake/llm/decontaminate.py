"""Benchmark decontamination by a prefix-filtered set join over item-sized windows.

A window (`width` consecutive item words, or all words of a shorter item) is the set of its two-word
shingles. To hold a whole window, a document must hold its rarest shingle, so that one is the necessary
prefix. Shingles are ordered by how often all documents hold them; documents are probed for prefix
shingles, a hit at a word position fixes where the window would begin and end (the positional and length
bounds), and the words there are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from thermolake.llm.ids import by_ids, fresh
from thermolake.session import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words: ASCII but letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Shingles that are probed as a literal set; with more of them a join finds the positions.
SET_LIMIT = 200_000
#: Shingles that are broadcast to that join (16 bytes each).
BROADCAST_KEYS = 4_000_000
#: Bytes of windows that are broadcast.
BROADCAST_WINDOWS = 64 << 20


def word_array(text: Column) -> Column:
    """Words after A-Z are lowered; lower() does that alone where all is ASCII."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, SEPARATORS), "")


def _shingles(words: str) -> Column:
    """The hash of each word with the next one; the last word stands alone."""
    return F.expr(f"zip_with({words}, slice({words}, 2, greatest(size({words}) - 1, 0)), (a, b) -> xxhash64(a, b))")


def _at_keys(shingled: DataFrame, keys: DataFrame, n_keys: int) -> DataFrame:
    """Adds at: the positions of shingles that are keys.

    Up to SET_LIMIT keys are looked up where the words are. Beyond it, narrow rows (text, position, shingle) meet the
    keys, broadcast up to BROADCAST_KEYS and shuffled beyond, and only positions that are left go back to the texts.
    """
    if n_keys <= SET_LIMIT:
        literals = ",".join(str(r[0]) for r in keys.collect()) or "null"
        return shingled.withColumn("at", F.expr(f"filter(transform(sh, (h, i) -> if(h in ({literals}), i, -1)), i -> i >= 0)"))
    narrow = shingled.select("text_key", F.posexplode("sh").alias("i", "key"))
    found = narrow.join(F.broadcast(keys) if n_keys <= BROADCAST_KEYS else keys, "key", "left_semi")
    places = found.groupBy("text_key").agg(F.sort_array(F.collect_set("i")).alias("at")).withColumnRenamed("text_key", "of_text")
    joined = shingled.join(places, F.col("text_key") == F.col("of_text"), "left")
    return joined.select(*shingled.columns, F.coalesce("at", F.array().cast("array<int>")).alias("at"))


def _probe(shingled: DataFrame, keys: DataFrame, n_keys: int, reach: int) -> DataFrame:
    """Adds hits: (pos, key, low, near), near being the words around a position that holds a key."""
    near = f"slice(w, greatest(i - {reach}, 0) + 1, {2 * reach + 2})"
    return _at_keys(shingled, keys, n_keys).withColumn("hit", F.expr(f"transform(at, i -> named_struct('pos', i, 'key', sh[i], 'low', greatest(i - {reach}, 0), 'near', {near}))"))


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """doc_id, text_key (a hash of the text), n_words, n_hit, n_items, items (sorted ids as strings) of every document.

    Null and empty texts have no words. Rows equal in id and text give one row; texts of one id, or of none, one
    each. A text of any length is searched whole. With an empty benchmark all counts of hits are 0, and an empty
    table gives no rows. Further columns, whatever their names, are not read.
    """
    scratch = scratch or Scratch(docs.sparkSession, "decontaminate")
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), word_array(F.col(item_text)).alias("w")).where(F.size("w") > 0)
    windows = items.select("item", F.expr(f"explode(transform(sequence(0, greatest(size(w) - {width}, 0)), i -> slice(w, i + 1, {width})))").alias("win")).distinct()
    windows = scratch.table(windows.withColumn("win_id", F.xxhash64("win")), "windows")
    alone = windows.where(F.size("win") == 1).limit(1).count() > 0

    # a window of one word has its hash as its only shingle
    pairs = "transform(sequence(0, greatest(size(win) - 2, 0)), i -> named_struct('offset', i, 'key', xxhash64(win[i], try_element_at(win, i + 2))))"
    tokens = windows.select("win", F.explode(F.expr(pairs)).alias("t")).select("win", "t.offset", "t.key").distinct()
    tokens = scratch.table(tokens, "tokens")
    keys = tokens.select("key").distinct()
    n_keys = keys.count()

    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), word_array(F.col(text_col)).alias("w"))
    shingled = texts.withColumn("sh", _shingles("w"))
    if alone:  # single words are keys too: probe both, at the same positions
        shingled = shingled.withColumn("sh", F.expr("concat(sh, transform(w, a -> xxhash64(a)))"))
    if n_keys <= SET_LIMIT:
        literals = ",".join(str(r[0]) for r in keys.collect()) or "null"
        held = shingled.select(F.explode(F.expr(f"array_distinct(filter(sh, h -> h in ({literals})))")).alias("key"))
    else:
        held = shingled.select(F.explode(F.array_distinct("sh")).alias("key")).join(F.broadcast(keys) if n_keys <= BROADCAST_KEYS else keys, "key", "left_semi")
    rarity = scratch.table(held.groupBy("key").agg(F.count("*").alias("df")), "rarity")

    rarest = F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "offset", "key")).alias("p")
    prefixes = tokens.join(rarity, "key", "left").groupBy("win").agg(rarest).where("p.df > 0").select("win", F.col("p.offset").alias("offset"), F.col("p.key").alias("key"), F.xxhash64("win").alias("win_id"))
    prefixes = scratch.table(prefixes, "prefixes")
    n_prefixes, n_bytes = prefixes.agg(F.count("*"), F.coalesce(F.sum(F.aggregate("win", F.lit(64), lambda n, w: n + 24 + F.octet_length(w)).cast("long")), F.lit(0))).first()

    found = _probe(shingled, prefixes.select("key").distinct(), n_prefixes, width - 2)
    found = found.select("doc_id", "text_key", F.size("w").alias("n_words"), F.explode_outer("hit").alias("hit"))
    if alone:
        found = found.withColumn("hit", F.expr("if(hit.pos >= n_words, named_struct('pos', hit.pos - n_words, 'key', hit.key, 'low', cast(null as int), 'near', cast(null as array<string>)), hit)"))
    side = F.broadcast(prefixes) if n_bytes <= BROADCAST_WINDOWS else prefixes
    begin = F.col("hit.pos") - F.col("offset")
    same = F.expr("if(hit.near is null, size(win) = 1, slice(hit.near, hit.pos - offset - hit.low + 1, size(win)) = win)")
    inside = (begin >= 0) & (begin + F.size("win") <= F.col("n_words"))
    joined = found.join(side, F.col("hit.key") == F.col("key"), "left")
    ok = F.when(inside, same).otherwise(False)
    hits = joined.select("doc_id", "text_key", "n_words", F.when(ok, begin).alias("begin"), F.when(ok, begin + F.size("win")).alias("end"), F.when(ok, F.col("win_id")).alias("win_id"))
    hits = scratch.table(hits.distinct(), "hits")
    scratch.keep("hits", "windows")

    key = ["doc_id", "text_key"]
    docs_seen = hits.groupBy(*key).agg(F.max("n_words").cast("long").alias("n_words"))
    spans = hits.where("begin is not null").select(*key, "begin", "end").distinct()
    earlier = F.max("end").over(Window.partitionBy(*key).orderBy("begin", "end").rowsBetween(Window.unboundedPreceding, -1))
    covered = spans.withColumn("new", F.greatest(F.lit(0), F.col("end") - F.greatest("begin", F.coalesce(earlier, F.lit(0))))).groupBy(*key).agg(F.sum("new").alias("n_hit"))
    owners = windows.select("win_id", "item")
    held_items = hits.where("begin is not null").select(*key, "win_id").distinct().join(owners, "win_id").groupBy(*key).agg(F.sort_array(F.collect_set("item")).alias("items"))
    same_doc = lambda other: (F.col("d.doc_id").eqNullSafe(other["doc_id"])) & (F.col("d.text_key") == other["text_key"])
    both = covered.alias("c").join(held_items.alias("i"), F.col("c.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("c.text_key") == F.col("i.text_key"))).select(F.col("c.doc_id"), F.col("c.text_key"), "n_hit", "items")
    return docs_seen.alias("d").join(both, same_doc(both), "left").select(
        F.col("d.doc_id"), F.col("d.text_key"), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The documents that hold no benchmark window, with the columns they came with, whatever their names.

    Every row goes or stays by its text alone, so that a clean text stays though another one of its id goes.
    """
    key = fresh(docs, "text_key")
    scratch = Scratch(docs.sparkSession, "decontaminate")
    found = contamination(docs, benchmark, scratch=scratch, **kw).where("n_hit > 0").select(F.col("text_key").alias(key))
    keyed = docs.withColumn(key, F.xxhash64("text"))
    left = by_ids(Scratch(docs.sparkSession, "contaminated"), keyed, found, "left_anti", "found", key).select(*docs.columns)
    scratch.keep()
    return left


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = contamination(docs, bench)
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))

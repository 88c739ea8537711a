"""Benchmark decontamination by winnowing.

k-gram hashes of words are winnowed: of every ``window`` consecutive ones the
least is kept.  Two texts that share window + k - 1 words share a whole window
of k-grams, hence its least hash, so no such span is missed.  Documents with a
kept hash of the benchmark are extended to all their shared spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize, small, unused

SPAN = 13
GRAM = 5
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column, exact: bool = True) -> Column:
    """Words of a text with A-Z lower-cased.

    ``exact=False`` lower-cases all letters, which is much faster and keeps the
    number and places of words: texts with equal words have equal words there
    too.  (Σ is the one letter whose lower case depends on its neighbours.)
    """
    low = F.translate(text, _UPPER, _LOWER) if exact else F.lower(F.replace(text, F.lit("Σ"), F.lit("σ")))
    return F.array_remove(F.split(low, _SEPARATORS), "")


def _runs(array: str, n: int, one) -> Column:
    """one(elements) for all runs of n elements.

    Elements are fetched one by one: slice() copies the whole array each time.
    """
    return F.when(
        F.size(array) >= n,
        F.transform(F.sequence(F.lit(0), F.size(array) - n), lambda i: one([F.get(array, i + j) if j else F.get(array, i) for j in range(n)])),
    )


def _grams(hashes: str, n: int) -> Column:
    """Hashes of all runs of n words, from the words' hashes."""
    return F.coalesce(_runs(hashes, n, lambda ws: F.xxhash64(*ws)), F.array().cast("array<bigint>"))


def _marked(hashes: Column, n: int) -> Column:
    """Hashes of runs of n words, unlike those of other lengths."""
    return F.transform(hashes, lambda h: F.xxhash64(F.lit(n), h))


def _minima(array: str, window: int) -> Column:
    """The least of all runs of ``window`` elements, from an array of the least of runs of ``_step(window)``."""
    step = _step(window)
    starts = sorted({min(i, window - step) for i in range(0, window, step)})
    return F.when(
        F.size(array) > window - step,
        F.transform(F.sequence(F.lit(0), F.size(array) - 1 - (window - step)), lambda i: F.least(*[F.get(array, i + j) if j else F.get(array, i) for j in starts]) if len(starts) > 1 else F.get(array, i)),
    )


def _step(window: int) -> int:
    """About the root: least of a run from the least of its parts, so fewer elements are fetched."""
    return next(k for k in range(1, window + 1) if k * k >= window)


def _hashed(rows: DataFrame, words: str = "words") -> DataFrame:
    """Adds ``_wh``: the hash of each word."""
    return rows.withColumn("_wh", F.transform(words, lambda w: F.xxhash64(w)))


def fingerprints(rows: DataFrame, words: str = "words", span: int = SPAN, gram: int = GRAM, short: tuple[int, ...] = ()) -> DataFrame:
    """Adds ``fps``: the winnowed k-gram hashes, and all runs of each length in ``short``."""
    window = span - gram + 1
    none = F.array().cast("array<bigint>")
    out = _hashed(rows, words).withColumn("_grams", _grams("_wh", gram))
    part = _runs("_grams", _step(window), lambda hs: F.least(*hs) if len(hs) > 1 else hs[0])
    out = out.withColumn("_least", F.coalesce(part, none))
    fps = F.coalesce(F.array_distinct(_minima("_least", window)), none)
    for n in short:
        fps = F.concat(fps, _marked(_grams("_wh", n), n))
    return out.withColumn("fps", fps).drop("_grams", "_least", "_wh")


def _windows(rows: DataFrame, lengths: list[int], words: str = "words") -> DataFrame:
    """Rows (other columns, pos, len, a, b) for all runs of each of the lengths, in one pass; (a, b) hashes a run to 128 bits.

    The outer generator keeps Spark from pushing a test of the generated array
    below the projection that makes the words, which would make them anew for
    each element.
    """
    keep = [c for c in rows.columns if c != words]
    none = F.array().cast("array<struct<pos:int,len:int,a:bigint,b:bigint>>")

    def run(n: int) -> Column:
        one = lambda i: F.struct(i.alias("pos"), F.lit(n).alias("len"), *[F.xxhash64(*lead, *[F.get("_wh", i + j) if j else F.get("_wh", i) for j in range(n)]).alias(x) for x, lead in (("a", ()), ("b", (F.lit(n),)))])
        return F.coalesce(F.when(F.size("_wh") >= n, F.transform(F.sequence(F.lit(0), F.size("_wh") - n), one)), none)

    out = _hashed(rows, words).select(*keep, F.explode_outer(F.concat(*[run(n) for n in lengths])).alias("h"))
    return out.select(*keep, "h.*").where("pos is not null")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", span: int = SPAN, gram: int = GRAM, share: int = 20) -> DataFrame:
    """One row per input row: id_col, text_hash, n_words, n_hit, n_items, items, contaminated.

    A window is ``span`` consecutive words of a benchmark item; an item of fewer
    words, but not none, is one window.  A document word inside an occurrence of
    a window is hit.  contaminated: n_hit > 0 and share * n_hit >= n_words.
    items are the ids, as strings, sorted, of items with occurring windows.
    Null texts have no words; items with a null id or text are left out.  Rows
    equal in id and text have equal results and are all returned.  An empty
    benchmark hits nothing; an empty table gives an empty result.  Other columns
    are not looked at.

    Every document is winnowed, however large the benchmark is, and its
    fingerprints are joined with the benchmark's: in the scan's stage while
    those pass the broadcast's size check, else by a shuffle of them.  Only
    documents that share one are cut into windows.
    """
    named = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("t"))
    items = materialize(named.select("item", words_of(F.col("t")).alias("words")).where("size(words) > 0"), "items")
    lengths = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(span))).distinct().collect())  # span numbers at most
    short = tuple(n for n in lengths if n < span)

    loose = named.select(words_of(F.col("t"), exact=False).alias("words"))
    kept = fingerprints(loose.where(F.size("words") >= span), span=span, gram=gram)
    for n in short:
        kept = kept.unionByName(fingerprints(loose.where(F.size("words") == n), span=span, gram=gram, short=(n,)))
    kept = materialize(kept.select(F.explode_outer("fps").alias("fp")).where("fp is not null").distinct().withColumn("hit", F.lit(1)), "item_fingerprints")

    text = F.coalesce(F.col(text_col), F.lit(""))
    tokens = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_th"), words_of(text, exact=False).alias("words"))
    marks = fingerprints(tokens, span=span, gram=gram, short=short).select("_id", "_th", F.size("words").cast("long").alias("n_words"), F.posexplode_outer("fps").alias("_pos", "fp"))
    found = marks.join(small(kept, kept.count()), "fp", "left")
    per_doc = materialize(
        found.groupBy("_id", "_th", "n_words").agg(F.max("hit").alias("hit"), F.sum(F.when(F.coalesce("_pos", F.lit(0)) == 0, 1).otherwise(0)).alias("copies")),
        "per_document",
    )
    out = per_doc.withColumn("_items", F.lit(None).cast("array<string>")).withColumn("_hit", F.lit(None).cast("int"))
    if lengths:
        covered = _covered(docs, per_doc.where("hit = 1").select("_id", "_th"), items, lengths, id_col, text)
        out = per_doc.join(covered, F.col("_id").eqNullSafe(F.col("_hid")) & (F.col("_th") == F.col("_hth")), "left")
    discard(items, kept)
    n_hit = F.coalesce("_hit", F.lit(0)).cast("long")
    return out.select(
        F.col("_id").alias(id_col), F.col("_th").alias("text_hash"), F.col("n_words"), n_hit.alias("n_hit"),
        F.coalesce(F.size("_items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("_items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy"),
    ).drop("_copy")


def _covered(docs: DataFrame, suspects: DataFrame, items: DataFrame, lengths: list[int], id_col: str, text: Column) -> DataFrame:
    """(_hid, _hth, _items, _hit), written, of the suspects with an occurring window."""
    span = max(lengths)
    cut = items.withColumn("_n", F.least(F.size("words"), F.lit(span)))
    windows = materialize(_windows(cut, lengths).where("len = _n").select("a", "b", "item").distinct(), "item_windows")
    distinct = materialize(windows.select("a", "b").distinct(), "windows")

    exact = docs.select(F.col(id_col).alias("_id"), text.alias("_t")).withColumn("_th", F.xxhash64("_t"))
    exact = exact.join(small(suspects, suspects.count()), exact["_id"].eqNullSafe(suspects["_id"]) & (exact["_th"] == suspects["_th"]), "left_semi")
    exact = exact.select("_id", "_th", words_of(F.col("_t")).alias("words"))
    hits = materialize(_windows(exact, lengths).join(small(distinct, distinct.count()), ["a", "b"]).select("_id", "_th", "pos", "len", "a", "b"), "hits")

    spans = hits.groupBy("_id", "_th").agg(F.collect_set(F.struct("pos", "len")).alias("_spans"))
    width = 64 + (windows.agg(F.max(F.octet_length("item"))).first()[0] or 0)
    told = hits.select("_id", "_th", "a", "b").distinct().join(small(windows, windows.count(), width), ["a", "b"]).groupBy("_id", "_th").agg(F.collect_set("item").alias("_items"))
    places = F.array_distinct(F.flatten(F.transform("_spans", lambda s: F.sequence(s["pos"], s["pos"] + s["len"] - 1))))
    told = told.select(F.col("_id").alias("_iid"), F.col("_th").alias("_ith"), F.array_sort("_items").alias("_items"))
    both = spans.join(told, F.col("_id").eqNullSafe(F.col("_iid")) & (F.col("_th") == F.col("_ith")))
    out = materialize(both.select(F.col("_id").alias("_hid"), F.col("_th").alias("_hth"), "_items", F.size(places).alias("_hit")), "covered")
    discard(windows, distinct, hits)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of docs that are not contaminated, all columns, whatever their names."""
    bad, told, key = unused(docs.columns, "_bad", "_told", "_key")
    found = contamination(docs, benchmark, id_col, text_col, **kw).where("contaminated").select(F.col(id_col).alias(bad), F.col("text_hash").alias(told)).distinct()
    found = materialize(found, "contaminated")
    here = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    return here.join(small(found, found.count()), F.col(id_col).eqNullSafe(F.col(bad)) & (F.col(key) == F.col(told)), "left_anti").drop(key)

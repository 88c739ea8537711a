"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, fits, match_groups, materialize, small, unused

#: Code points of a text that the second level hashes.
PREFIX_CHARS = 256


def _prefix(text: Column, chars: int) -> Column:
    return F.xxhash64(F.substring(text, 1, chars))


def _whole(text: Column) -> Column:
    return F.sha2(text, 256)


def _digests(docs: DataFrame, id_col: str, text_col: str, prefix_chars: int, digest_all: bool) -> DataFrame:
    """Written rows (_id, _len, _ph, _shared, _sha), one per input row.

    _ph is null where the length occurs once; _shared where the prefix does;
    _sha is the full hash of rows that are shared, or of all rows.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t")).withColumn("_len", F.octet_length("_t"))
    lengths = materialize(rows.groupBy("_len").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_len", F.lit(True).alias("_same")), "shared_lengths")
    if fits(lengths.count(), 16):
        rows = rows.join(F.broadcast(lengths), "_len", "left")
    else:  # millions of shared lengths: to move texts would cost more than to hash prefixes
        rows = rows.withColumn("_same", F.lit(True))
    rows = rows.withColumn("_ph", F.when(F.col("_same"), _prefix(F.col("_t"), prefix_chars)))
    prefixes = rows.where("_ph is not null").groupBy("_len", "_ph").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    prefixes = materialize(prefixes.select("_len", "_ph", F.lit(True).alias("_shared")), "shared_prefixes")
    if fits(prefixes.count(), 32):
        rows = rows.join(F.broadcast(prefixes), ["_len", "_ph"], "left")
    else:
        rows = rows.withColumn("_shared", F.col("_same"))
    sha = _whole(F.col("_t"))
    out = materialize(rows.select("_id", "_len", "_ph", "_shared", (sha if digest_all else F.when(F.col("_shared"), sha)).alias("_sha")), "digests")
    discard(lengths, prefixes)
    return out


def _judged(rows: DataFrame) -> DataFrame:
    """The digests with _keep and _size, null where a text occurs once."""
    shared = rows.where("_shared")
    groups = materialize(shared.groupBy("_sha").agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_size")).where("_size > 1"), "groups")
    alone = rows.where("_shared is null").withColumn("_keep", F.lit(None).cast(dict(rows.dtypes)["_id"])).withColumn("_size", F.lit(None).cast("long"))
    return match_groups(shared, groups, ["_sha"], "_size", rows.count(), "left").unionByName(alone)


def _kept() -> Column:
    return F.col("_size").isNull() | F.coalesce(F.col("_id").eqNullSafe(F.col("_keep")), F.lit(True))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS, digest_all: bool = False) -> DataFrame:
    """One row per input row: id_col, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical (null counts as empty).  The row with the
    largest id stays.  Levels, each an aggregate with map-side combine:

    1. texts are grouped by byte length; a length that occurs once is settled;
    2. the first characters of the rest are hashed, and the rest is grouped by
       length and that hash; a pair that occurs once is settled;
    3. only rows that are still shared have their whole text hashed, and are
       grouped by SHA-256.

    Rows are tested against the shared lengths and prefixes in the scan, by
    broadcast while those lists pass its size check; a longer list settles
    nothing, as hashing a text costs less than moving it.  So no text is ever
    shuffled.  A group with a large share of all rows is looked up by broadcast.

    ``digest_all`` fills text_sha256 for settled rows too.  Rows with a null id
    can be dropped copies, never the one that stays unless all ids of the group
    are null; then every row of the group stays.  Rows with equal id and text
    are one document: each has kept = true if any has.  Other columns are not
    looked at.  An empty table gives an empty result.
    """
    rows = _judged(_digests(docs, id_col, text_col, prefix_chars, digest_all))
    return rows.select(
        F.col("_id").alias(id_col), F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"), _kept().alias("kept"), F.col("_sha").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """The rows of docs that stay, all columns; one of rows with equal id and text.

    Rows with a null id always stay.  Columns may have any names.  An empty
    table gives an empty result.  A row's whole text is hashed again only if its
    id, length and prefix are those of a row to be dropped.
    """
    rows = _judged(_digests(docs, id_col, text_col, prefix_chars, False)).where("_id is not null and _size is not null").withColumn("_kept", _kept())
    at, n, ph, sha = unused(docs.columns, "_id", "_len", "_ph", "_sha")
    named = [F.col("_id").alias(at), F.col("_len").alias(n), F.col("_ph").alias(ph), F.col("_sha").alias(sha)]
    dropped = materialize(rows.where("not _kept").select(*named).distinct(), "dropped")
    repeated = materialize(rows.where("_kept").groupBy("_id", "_len", "_ph", "_sha").count().where("count > 1").select(*named), "repeated")
    text = F.coalesce(docs[text_col], F.lit(""))

    def same(found: DataFrame) -> Column:
        # the last test is no join key, so it is made only where the others agree
        return (docs[id_col] == found[at]) & (F.octet_length(text) == found[n]) & (_prefix(text, prefix_chars) == found[ph]) & (F.instr(_whole(text), found[sha]) == 1)

    out = docs.join(small(dropped, dropped.count(), 128), same(dropped), "left_anti")
    if k := repeated.count():
        again = small(repeated, k, 128)
        twice = docs.join(again, same(again), "left_semi").withColumn(sha, _whole(F.coalesce(F.col(text_col), F.lit("")))).dropDuplicates([id_col, sha]).drop(sha)
        out = out.join(again, same(again), "left_anti").unionByName(twice)
    return out

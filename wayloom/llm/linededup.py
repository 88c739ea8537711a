"""Line dedup by overlapping windows of consecutive lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, match_groups, materialize, unused

WINDOW = 3


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id_col, text_hash, gone): the places of lines, from 0, that repeat earlier windows.

    Lines end at line feeds.  Every run of ``window`` consecutive lines that has
    more than spaces is a window; of equal windows anywhere, the first by
    (id, place) stays, and the lines that any later one covers go, overlaps
    merged.  Windows are compared by 128 bits of hash.  Rows equal in id and
    text are one document.  Documents of fewer lines have no window.

    Windows are hashed once, written as a few longs each, and counted by hash;
    a window that a large share of all documents has is looked up by broadcast,
    so its occurrences do not meet in one task.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_th"), F.split(text, "\n").alias("_lines"))
    rows = rows.select("_id", "_th", F.transform("_lines", lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), (F.length(F.trim(x)) > 0).alias("full"))).alias("_ls"))

    def run(i):
        some = [F.get("_ls", i + j) for j in range(window)]
        full = some[0]["full"]
        for s in some[1:]:
            full = full | s["full"]
        return F.struct(i.alias("pos"), F.xxhash64(*[s["a"] for s in some]).alias("a"), F.xxhash64(*[s["b"] for s in some]).alias("b"), full.alias("full"))

    runs = F.when(F.size("_ls") >= window, F.transform(F.sequence(F.lit(0), F.size("_ls") - window), run))
    seen = materialize(rows.select("_id", "_th", F.explode_outer(runs).alias("w")).where("w.full").select("_id", "_th", "w.pos", "w.a", "w.b"), "windows")
    groups = materialize(seen.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("_id", "_th", "pos")).alias("first")).where("n > 1"), "repeated_windows")
    later = match_groups(seen, groups, ["a", "b"], "n", seen.count()).where(~F.struct("_id", "_th", "pos").eqNullSafe(F.col("first")))
    gone = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + window - 1))))
    out = later.groupBy("_id", "_th").agg(F.collect_set("pos").alias("places")).select(F.col("_id").alias(id_col), F.col("_th").alias("text_hash"), F.array_sort(gone).alias("gone"))
    out = materialize(out, "gone_lines")
    discard(seen, groups)
    return out


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """docs with text_col less its repeated lines, and n_lines and n_removed (long).

    A null text stays null with no lines; a text all of whose lines repeat
    becomes empty.  Rows with a null id come first in the order.  Rows equal in
    id and text are one document and lose the same lines.  Other columns pass
    through, whatever their names; columns named n_lines or n_removed are
    replaced.  An empty table gives an empty result.

    The list of lines that go grows with the input, so at every size it meets
    the texts in one hashed shuffle, in which only that list is held in memory.
    """
    here = docs.drop("n_lines", "n_removed")
    gid, gth, th, lost, lines = unused(docs.columns, "_gid", "_gth", "_th", "_gone", "_lines")
    gone = repeated_lines(docs, id_col, text_col, window)
    gone = gone.select(F.col(id_col).alias(gid), F.col("text_hash").alias(gth), F.col("gone").alias(lost)).hint("shuffle_hash")
    # the lines, and not the text, are shuffled: what is left of them is looked up by place
    here = here.withColumn(th, F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))).withColumn(lines, F.split(F.col(text_col), "\n")).drop(text_col)
    out = here.join(gone, F.col(id_col).eqNullSafe(F.col(gid)) & (F.col(th) == F.col(gth)), "left")
    places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), lost)
    left = F.transform(places, lambda i: F.get(lines, i))
    out = out.withColumn("n_lines", F.when(F.col(lines).isNull(), 0).otherwise(F.size(lines)).cast("long")).withColumn("n_removed", F.coalesce(F.size(lost), F.lit(0)).cast("long"))
    out = out.withColumn(text_col, F.array_join(F.when(F.col(lost).isNull(), F.col(lines)).otherwise(left), "\n"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_removed")], "n_lines", "n_removed")

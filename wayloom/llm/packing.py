"""Best-fit packing into bins of several permitted sequence lengths."""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import giving_back_group, small, small_batches

#: Permitted sequence lengths, and what a bin costs: its length and a fixed share.
CAPACITIES = (512, 1024, 2048, 4096, 8192)
FIXED_COST = 64
#: Pieces that are packed together, on average; and tokens, where sequences are laid out.
BUCKET_PIECES, BUCKET_TOKENS = 4096, 1 << 21


def cost(capacity: int) -> float:
    return capacity + FIXED_COST


def pack(lengths: np.ndarray, capacities: tuple[int, ...] = CAPACITIES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bin, the offset in it and the bin's final capacity for each length; lengths must be in descending order.

    A piece goes into the open bin that it leaves the least room in.  If none
    has room, the bin to open is the permitted length whose cost per token is
    least, counting with the piece what the pieces still to come could fill,
    longest first.  In the end each bin shrinks to the least length that holds
    its contents.  A piece of length 0 goes into any bin, full ones too.
    """
    most = max(capacities)
    left = np.bincount(lengths, minlength=most + 1)  # pieces still to come, by length
    kinds = sorted(set(lengths.tolist()))  # lengths that may still come, ascending
    room: list[tuple[int, int]] = []  # (room, bin), ascending
    sizes: list[int] = []
    fill: list[int] = []
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)

    def filled(space: int) -> int:
        """Tokens that the pieces to come could put into a space.

        Each length that is looked at is used, and lengths differ, so the steps
        are fewer than the root of twice the space.
        """
        total, i = 0, bisect.bisect_right(kinds, space) - 1
        while i >= 0 and kinds[i]:
            n = min(space // kinds[i], int(left[kinds[i]]))
            total += n * kinds[i]
            space -= n * kinds[i]
            i = min(i - 1, bisect.bisect_right(kinds, space) - 1)
        return total

    for p, n in enumerate(lengths.tolist()):
        left[n] -= 1
        if not left[n]:
            kinds.pop(bisect.bisect_left(kinds, n))
        if not n and sizes:
            bins[p], offsets[p] = len(sizes) - 1, fill[-1]
            continue
        at = bisect.bisect_left(room, (n, -1))
        if at < len(room):
            space, b = room.pop(at)
        else:
            b, space = len(sizes), min((cost(c) / max(1, n + filled(c - n)), c) for c in capacities if c >= n)[1]
            sizes.append(space)
            fill.append(0)
        bins[p], offsets[p] = b, fill[b]
        fill[b] += n
        if space > n:
            bisect.insort(room, (space - n, b))
    final = np.array([next(c for c in sorted(capacities) if c >= f) for f in fill], np.int64)
    return bins, offsets, final[bins]


def word_length(text: Column) -> Column:
    """Words between ASCII white space, and an end mark."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+"), "")) + 1


def _pieces(n: np.ndarray, ties: np.ndarray, capacities: tuple[int, ...]) -> dict[str, np.ndarray]:
    """The pieces of documents of n tokens: document, number, length, bin (from 0), offset and capacity of each."""
    most = max(capacities)
    rest = np.where((n > most) & (n % most == 0), most, np.where(n > most, n % most, n))
    order = np.lexsort((ties, -n, -rest))
    bins, offsets, sizes = pack(rest[order], capacities)
    full = (n - rest) // most  # whole bins of each document
    used = int(bins.max()) + 1 if len(bins) else 0
    first = used + np.cumsum(full) - full
    doc = np.repeat(np.arange(len(n)), full)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(full) - full, full)
    join = lambda a, b: np.concatenate([a, b]).astype(np.int64)
    return {
        "doc": join(order, doc), "piece": join(full[order], piece), "len": join(rest[order], np.full(len(doc), most)),
        "bin": join(bins, first[doc] + piece), "offset": join(offsets, np.zeros(len(doc))), "capacity": join(sizes, np.full(len(doc), most)),
    }


def _dealt(rows: DataFrame, buckets: int, most: int) -> DataFrame:
    """Adds ``bucket``: a hash of id and length, so it does not depend on how the input is stored.

    Rows of an id and length that more than ``most`` rows share are dealt by
    where they stand in the input instead, which a task that runs again finds as
    before; so no group of rows meets in one bucket.
    """
    groups = rows.groupBy("id", "n").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > most)
    here = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("null")), "n")
    if not (hot := groups.count()):
        return rows.withColumn("bucket", F.pmod(here, F.lit(buckets)))
    found = small(groups.select(F.col("id").alias("_hot"), F.col("n").alias("_n")), hot)
    marked = rows.withColumn("_at", F.monotonically_increasing_id()).join(found, F.col("id").eqNullSafe(F.col("_hot")) & (F.col("n") == F.col("_n")), "left")
    return marked.withColumn("bucket", F.pmod(F.when(F.col("_n").isNull(), here).otherwise(F.xxhash64("_at")), F.lit(buckets))).drop("_at", "_hot", "_n")


def best_fit(docs: DataFrame, id_col: str = "doc_id", length: Column | None = None, text_col: str = "text", capacities: tuple[int, ...] = CAPACITIES, bucket_pieces: int = BUCKET_PIECES) -> DataFrame:
    """One row per piece of a document: id_col, n_tokens, piece, piece_start, piece_len, bin_id, bin_offset, capacity.

    ``length`` gives a document's tokens (default: words and an end mark); null
    or negative counts as none.  A document longer than the largest capacity is
    cut: each full piece is a bin of its own, the rest is packed with the others,
    so nothing is dropped.  A document without tokens has one piece of length 0.
    Rows are dealt to hash buckets, whose number follows the table's rows; each
    bucket is packed by itself, longest first, ties by id, so a few bins a
    bucket stay part empty.  bin_id is unique over all buckets.  Rows that
    repeat an id are packed each; null ids are packed too; other columns are not
    looked at.  An empty table gives an empty result.
    """
    most = max(capacities)
    tokens = F.greatest(F.coalesce(length if length is not None else word_length(F.col(text_col)), F.lit(0)), F.lit(0)).cast("long")
    kind = dict(docs.dtypes)[id_col]
    rows = _dealt(docs.select(F.col(id_col).alias("id"), tokens.alias("n")), 1 + docs.count() // bucket_pieces, bucket_pieces // 4)

    def run(group: pa.Table) -> pa.Table:
        n, bucket = group["n"].to_numpy(), group["bucket"][0].as_py()
        p = _pieces(n, group["id"].to_pandas().rank(method="first").fillna(0).to_numpy(), capacities)
        return pa.table({
            id_col: group["id"].take(pa.array(p["doc"])), "n_tokens": n[p["doc"]], "piece": p["piece"], "piece_start": p["piece"] * most, "piece_len": p["len"],
            "bin_id": (np.int64(bucket) << np.int64(32)) + p["bin"], "bin_offset": p["offset"], "capacity": p["capacity"],
        })

    return rows.groupBy("bucket").applyInArrow(run, f"`{id_col}` {kind}, n_tokens long, piece long, piece_start long, piece_len long, bin_id long, bin_offset long, capacity long")


def sequences(tokens: DataFrame, id_col: str = "doc_id", capacities: tuple[int, ...] = CAPACITIES, bucket_tokens: int = BUCKET_TOKENS, pad_id: int = 0) -> DataFrame:
    """The packed sequences, one row per bin: bin_id, capacity, n_tokens, pieces, input_ids.

    ``tokens`` is a written table as ``wavelet.token_ids`` makes it: id_col,
    n_tokens, ids.  input_ids are capacity little-endian unsigned 32-bit ids:
    the pieces' ids one after the other, then pad_id.  pieces is an array of
    (id_col, n_tokens, piece, piece_start, piece_len, bin_offset) in the order
    of offsets.  Documents are cut and packed as best_fit says.  A bucket holds
    bucket_tokens on average, or one longer document; ids are shuffled once.  A
    null ids is a document without tokens.  An empty table gives an empty result.
    """
    small_batches(tokens.sparkSession)
    most, kind = max(capacities), dict(tokens.dtypes)[id_col]
    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    rows = _dealt(tokens.select(F.col(id_col).alias("id"), F.coalesce("ids", F.lit(b"")).alias("ids"), F.when(F.col("ids").isNull(), 0).otherwise(F.col("n_tokens")).cast("long").alias("n")), 1 + total // bucket_tokens, BUCKET_PIECES // 4)

    def run(group: pa.Table) -> pa.Table:
        n, bucket = group["n"].to_numpy(), group["bucket"][0].as_py()
        ids_of = [np.frombuffer(x.as_buffer(), f"<u{x.as_buffer().size // k}") if k else np.zeros(0, "<u2") for x, k in zip(group["ids"], n.tolist())]
        p = _pieces(n, group["id"].to_pandas().rank(method="first").fillna(0).to_numpy(), capacities)
        order = np.lexsort((p["len"], p["offset"], p["bin"]))
        p = {k: v[order] for k, v in p.items()}
        cuts = np.flatnonzero(np.concatenate(([True], p["bin"][1:] != p["bin"][:-1]))) if len(order) else np.zeros(0, np.int64)
        capacity = p["capacity"][cuts]
        base = np.cumsum(capacity) - capacity
        # every piece is copied from its document to its place in its bin
        of_bin = np.repeat(np.arange(len(cuts)), np.diff(np.append(cuts, len(order))))
        out = np.full(int(capacity.sum()), pad_id, dtype="<u4")
        for doc, start, to, size in zip(p["doc"].tolist(), (p["piece"] * most).tolist(), (base[of_bin] + p["offset"]).tolist(), p["len"].tolist()):
            out[to : to + size] = ids_of[doc][start : start + size]
        offsets = (4 * np.append(base, len(out))).astype("<i8")
        laid = pa.Array.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.binary())
        ids = group["id"].combine_chunks().take(pa.array(p["doc"]))
        members = pa.StructArray.from_arrays(
            [ids, *(pa.array(x) for x in (n[p["doc"]], p["piece"], p["piece"] * most, p["len"], p["offset"]))], names=[id_col, "n_tokens", "piece", "piece_start", "piece_len", "bin_offset"]
        )
        return pa.table({
            "bin_id": (np.int64(bucket) << np.int64(32)) + p["bin"][cuts], "capacity": capacity, "n_tokens": np.add.reduceat(p["len"], cuts) if len(cuts) else p["len"],
            "pieces": pa.ListArray.from_arrays(pa.array(np.append(cuts, len(order)).astype(np.int32)), members), "input_ids": laid,
        })

    piece = f"struct<`{id_col}`:{kind},n_tokens:long,piece:long,piece_start:long,piece_len:long,bin_offset:long>"
    return rows.groupBy("bucket").applyInArrow(giving_back_group(run), f"bin_id long, capacity long, n_tokens long, pieces array<{piece}>, input_ids binary")

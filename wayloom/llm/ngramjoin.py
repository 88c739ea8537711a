"""N-gram Jaccard self-join with token-combination prefixes.

A document's tokens are its distinct word shingles.  Under one order of all
tokens, rare ones first, two sets that must share t tokens share k within their
prefixes of n - t + k tokens.  So either a rare token stands in both prefixes,
and its own index entry finds the pair, or they share k frequent ones, and the
entry of that combination does.  Candidates are then verified on whole sets.

Three things keep the work near the number of documents:

* A set can only link if at least t of its tokens occur in another set.  A
  first pass deals 32-bit token prints to buckets, finds those that occur
  again, and tells each document how many it has (never too few), so all but
  possible members leave before any set is stored.
* Rows with equal sets are one class, with its smallest id for all of them.
* Entries' groups are linked through leaders, not as all pairs: members are
  verified against the one with fewest tokens of its own, then what is left in other components against
  leaders of the group's largest one, until the pairs of different components
  are few; those are all verified.  No pair is skipped except within a component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, connected_components, discard, giving_back, giving_back_group, match_groups, materialize, small, small_batches, unused
from .textgrams import shingle_sets

#: Documents up to which a token counts as rare, and is an index entry by itself.
RARE = 16
#: Tokens in a combination.
COMBINED = 2
#: Frequent tokens in a prefix up to which all combinations are indexed; sets with more use single entries.
MOST_COMBINED = 48
#: Text bytes whose token prints make a bucket, on average; and tokens that are dealt to buckets at once.
BUCKET_BYTES, DEAL_TOKENS = 16 << 20, 1 << 20
#: Leaders of a group in one round, and rounds with leaders at most.
LEADERS, ROUNDS = 8, 6

_U = np.uint64
_PRINTS = "bucket int, kind int, src long, index binary, data binary"


def _column(batch, i: int):
    c = batch.column(i)
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


def _prints(width: int, buckets: int):
    """Map: each document's token prints, dealt to buckets, and its size and set hash.

    Documents are dealt DEAL_TOKENS tokens at a time.  A print that two of them
    share is known to occur twice: it is counted here, and its bucket gets it
    once, without documents.  So a print that a third of all documents has
    reaches its bucket once a deal, not once a document.  A row is written for
    each bucket that gets prints, so work is in proportion to tokens.
    """

    def deal(src: int, ids: np.ndarray, sizes: np.ndarray, seconds: np.ndarray, tokens: np.ndarray):
        cuts = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        total = np.concatenate((np.zeros(1, _U), np.cumsum(tokens, dtype=_U)))  # the set hash does not depend on order
        order = np.argsort(tokens)
        same = tokens[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(same)), bool), same[1:] != same[:-1])))
        often = np.diff(np.append(first, len(same))) > 1
        alone = np.zeros(len(tokens), dtype=bool)
        alone[order[first[~often]]] = True
        doc = np.repeat(np.arange(len(ids), dtype=np.uint32), sizes)
        here = np.bincount(doc[~alone], minlength=len(ids))
        meta = np.stack([ids.view(_U), sizes.astype(_U), total[cuts[1:]] - total[cuts[:-1]], seconds, here.astype(_U)])
        rows = [(src % buckets, 1, src, b"", meta.tobytes())]
        where = lambda x: ((x >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int32)
        known = same[first[often]]
        mine = where(known)
        edges = np.flatnonzero(np.concatenate((np.ones(min(1, len(mine)), bool), mine[1:] != mine[:-1])))
        for k, stop in zip(edges.tolist(), [*edges[1:].tolist(), len(mine)]):
            rows.append((int(mine[k]), 2, src, b"", known[k:stop].astype(np.uint32).tobytes()))
        single, doc = tokens[alone], doc[alone]
        mine = where(single)
        order = np.argsort(mine, kind="stable")
        mine, doc, low = mine[order], doc[order], single[order].astype(np.uint32)
        edges = np.flatnonzero(np.concatenate((np.ones(min(1, len(mine)), bool), mine[1:] != mine[:-1])))
        for k, stop in zip(edges.tolist(), [*edges[1:].tolist(), len(mine)]):
            some = doc[k:stop]
            starts = np.flatnonzero(np.concatenate(([True], some[1:] != some[:-1])))
            index = np.stack([some[starts], np.diff(np.append(starts, len(some))).astype(np.uint32)])
            rows.append((int(mine[k]), 0, src, index.tobytes(), low[k:stop].tobytes()))
        for k in range(0, len(rows), 256):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows[k : k + 256]), (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                names=["bucket", "kind", "src", "index", "data"],
            )

    def run(batches):
        from pyspark import TaskContext

        src, held, size = TaskContext.get().partitionId() << 24, [], 0

        def flush():
            nonlocal src, held, size
            ids, sets, seconds = (np.array([h[0] for h in held], np.int64), [h[1] for h in held], np.array([h[2] for h in held], dtype=_U))
            src, held, size = src + 1, [], 0
            return deal(src - 1, ids, np.array([len(s) for s in sets], dtype=np.uint32), seconds, np.concatenate(sets))

        for batch in batches:
            ids = _column(batch, 0).to_pylist()
            for i, s, total in shingle_sets(_column(batch, 1), width):
                held.append((ids[i], s, total))
                size += len(s)
                if size >= DEAL_TOKENS:
                    yield from flush()
        if held:
            yield from flush()

    return run


def _again(group: pa.Table) -> pa.Table:
    """Of a bucket: how many of each document's prints occur in another deal's document too."""
    kind = group["kind"].to_numpy()
    src, index, data = group["src"].to_numpy(), group["index"].to_pylist(), group["data"].to_pylist()
    mine, known = np.flatnonzero(kind == 0), np.flatnonzero(kind == 2)
    every = [np.frombuffer(data[i], np.uint32) for i in (*mine, *known, *known)]  # known ones count twice
    prints = np.sort(np.concatenate(every)) if every else np.zeros(0, np.uint32)
    twice = np.unique(prints[1:][prints[1:] == prints[:-1]])
    quick = np.zeros(1 << 24, dtype=bool)
    quick[twice >> 8] = True
    out = [(1, int(src[i]), data[i]) for i in np.flatnonzero(kind == 1)]
    for i in mine:
        x = np.frombuffer(data[i], np.uint32)
        hit = quick[x >> 8]
        if len(twice):
            maybe = np.flatnonzero(hit)
            at = np.minimum(np.searchsorted(twice, x[maybe]), len(twice) - 1)
            hit[maybe] = twice[at] == x[maybe]
        docs, lengths = np.frombuffer(index[i], np.uint32).reshape(2, -1)
        total = np.concatenate(([0], np.cumsum(hit)))
        ends = np.cumsum(lengths, dtype=np.int64)
        found = (total[ends] - total[ends - lengths]).astype(np.uint32)
        some = found > 0
        if some.any():
            out.append((0, int(src[i]), np.stack([docs[some], found[some]]).tobytes()))
    return pa.table({"kind": pa.array([r[0] for r in out], pa.int32()), "src": pa.array([r[1] for r in out], pa.int64()), "data": pa.array([r[2] for r in out], pa.binary())})


def _told(group: pa.Table) -> pa.Table:
    """Of a deal: id, size, set hash and shared prints of each of its documents."""
    kind, data = group["kind"].to_pylist(), group["data"].to_pylist()
    meta = np.frombuffer(data[kind.index(1)], _U).reshape(5, -1)
    shared = meta[4].astype(np.int64)
    for k, d in zip(kind, data):
        if k == 0:
            docs, found = np.frombuffer(d, np.uint32).reshape(2, -1)
            shared[docs] += found
    return pa.table({"id": meta[0].view(np.int64), "n": meta[1].astype(np.int64), "a": meta[2].view(np.int64), "b": meta[3].view(np.int64), "shared": shared})


def _needed(n: str, percent: int) -> Column:
    """Tokens that a set of n must share: ceil(percent * n / 100)."""
    return F.expr(f"(({n}) * {percent} + 99) div 100")


def _sizes_allow(a: str, b: str, percent: int) -> Column:
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


def _enough(rest: str, a: str, b: str, percent: int) -> Column:
    """Whether ``rest`` shared tokens can link sets of a and b.

    The first token that two linked sets share is an entry of both (or begins a
    combination that is), and all they share stands from there on; so an entry
    whose rest can't do may be left out, as it is the first of no linked pair.
    """
    return F.expr(f"{100 + percent} * {rest} >= {percent} * ({a} + {b})")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    left, right = (sets.select(F.col("rep").alias(c), F.col("hs").alias(f"h{c}")) for c in ("a", "b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("ha", "hb"))
    return both.where(100 * shared >= percent * (F.size("ha") + F.size("hb") - shared)).select("a", "b")


def _entries(sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The index: (key, single, rep, n, big) rows for prefix tokens and combinations."""
    tokens = sets.select("rep", F.explode("hs").alias("h"))
    counts = scratch.table(tokens.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "counts")
    total = sets.agg(F.sum(F.size("hs"))).first()[0] or 0
    shared = match_groups(tokens, counts, ["h"], "df", total).groupBy("rep").agg(F.collect_list(F.struct("df", "h")).alias("ts"))
    rows = shared.join(sets.select("rep", F.size("hs").alias("n")), "rep")
    # tokens that occur once come first in the order, and can't be shared
    rows = rows.withColumn("take", F.col("n") - _needed("n", percent) + COMBINED - (F.col("n") - F.size("ts"))).where("take > 0 and n > 1")
    rows = rows.select("rep", "n", F.size("ts").alias("m"), F.slice(F.array_sort("ts"), 1, F.col("take")).alias("ts"))
    rows = scratch.table(rows.withColumn("ts", F.transform("ts", lambda t, i: F.struct(t["df"].alias("df"), t["h"].alias("h"), (F.col("m") - i).cast("int").alias("rest")))), "prefixes")
    ordered = rows.select("rep", "n", (F.col("n") - F.col("m")).alias("own"), F.filter("ts", lambda t: t["df"] <= RARE).alias("rare"), F.filter("ts", lambda t: t["df"] > RARE).alias("often"))
    ordered = ordered.withColumn("big", F.size("often") > MOST_COMBINED)
    entry = lambda key, single, rest: F.struct(key.alias("key"), F.lit(single).alias("single"), rest.alias("rest"))
    pairs_of = F.flatten(
        F.transform("often", lambda x: F.transform(F.filter("often", lambda y: y["h"] > x["h"]), lambda y: entry(F.xxhash64(F.lit("two"), x["h"], y["h"]), False, F.greatest(x["rest"], y["rest"]))))
    )
    keys = F.concat(
        F.transform("rare", lambda t: entry(t["h"], False, t["rest"])),
        F.when(F.col("big"), F.array().cast("array<struct<key:bigint,single:boolean,rest:int>>")).otherwise(pairs_of),
        F.transform("often", lambda t: entry(F.xxhash64(F.lit("one"), t["h"]), True, t["rest"])),
    )
    entries = ordered.select("rep", "n", "own", "big", F.explode_outer(keys).alias("e")).where("e is not null").select("e.key", "e.single", "e.rest", "rep", "n", "own", "big")
    # single entries of frequent tokens only serve pairs with a set too big for combinations
    groups = entries.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.max("big").alias("some_big"), F.max("single").alias("s"), F.min("n").alias("least"))
    groups = scratch.table(groups.where("members > 1 and (some_big or not s)").select("key", "least", "members"), "keys")
    total = groups.agg(F.sum("members")).first()[0] or 0
    # what is left of a set from its entry on must do for the smallest set of the group
    live = match_groups(entries, groups, ["key"], "members", total).where(_enough("rest", "n", "least", percent)).drop("least", "members")
    return scratch.table(live, "entries")


def _components(entries: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(rep, comp) for the sets that link, found group by group."""
    size = entries.count()
    first = entries.groupBy("key").agg(F.min(F.struct("own", "n", "rep", "rest")).alias("l"), F.count(F.lit(1)).alias("c"))
    first = scratch.table(first.select("key", F.col("l.n").alias("ln"), F.col("l.rest").alias("lr"), F.col("l.rep").alias("l"), "c"), "leaders")
    allowed = lambda n, m, r, q: _sizes_allow(n, m, percent) & _enough(f"least({r}, {q})", n, m, percent)
    pairs = match_groups(entries, first, ["key"], "c", size).where("rep <> l").where(allowed("n", "ln", "rest", "lr")).select(F.least("rep", "l").alias("a"), F.greatest("rep", "l").alias("b")).distinct()
    links = scratch.table(_verified(scratch.table(pairs, "pairs"), sets, percent), "links")
    comps = materialize(connected_components(links), "components")
    before = None
    nodes = scratch.table(entries.select("rep", "n", "own").distinct(), "nodes")
    for turn in range(ROUNDS + 1):
        known = entries.join(comps, entries["rep"] == comps["node"], "left").select("key", "single", "rest", "rep", "n", "big", F.coalesce("comp", "rep").alias("comp"))
        parts = known.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
        groups = parts.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("members"), F.sum(F.col("c") * F.col("c")).alias("squares")).where("members > top.c")
        groups = materialize(groups.select("key", "members", F.col("top.comp").alias("top"), ((F.col("members") * F.col("members") - F.col("squares")) / 2).cast("long").alias("crossing")), "groups")
        crossing = groups.agg(F.sum("crossing")).first()[0] or 0
        if not crossing:
            break
        open_rows = match_groups(known, groups, ["key"], "members", size)
        # another round unless what is left is little, or the last one joined little of it
        last = crossing <= size // 2 or turn == ROUNDS or (before is not None and crossing > 0.7 * before)
        before = crossing
        if last:
            left = open_rows.select("key", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("rest").alias("ra"), F.col("big").alias("ba"), "single", F.col("comp").alias("ca"))
            right = known.join(groups.select("key"), "key", "left_semi").select("key", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("rest").alias("rb"), F.col("big").alias("bb"), F.col("comp").alias("cb"))
            pairs = left.join(right, "key").where("ca <> cb and a < b and (not single or ba or bb)").where(allowed("na", "nb", "ra", "rb")).select("a", "b").distinct()
        else:
            members = nodes.join(comps, nodes["rep"] == comps["node"], "left").withColumn("comp", F.coalesce("comp", "rep"))
            order = [F.struct("own", "n", "rep"), *[F.xxhash64("rep", F.lit(turn * LEADERS + i)) for i in range(1, LEADERS)]]
            seeds = [F.min_by(F.struct("rep", "n"), o) for o in order]
            leaders = members.groupBy("comp").agg(F.array_distinct(F.array(*seeds)).alias("ls"))
            out = open_rows.where("comp <> top").select("rep", "n", F.col("top").alias("comp")).distinct().join(leaders, "comp")
            out = out.select("rep", "n", F.explode("ls").alias("l"))
            pairs = out.where(_sizes_allow("n", "l.n", percent)).select(F.least("rep", "l.rep").alias("a"), F.greatest("rep", "l.rep").alias("b")).distinct()
        pairs = scratch.table(pairs, "pairs")
        new = scratch.table(_verified(pairs, sets, percent), "links")
        if new.head(1):
            old = comps
            ends = [comps.select(F.col("node").alias(c), F.col("comp").alias(f"c{c}")) for c in ("a", "b")]
            merged = new.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b")
            lower = materialize(connected_components(merged), "components")
            up = lower.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
            comps = materialize(
                comps.join(up, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
                .unionByName(lower.join(comps.select("node"), "node", "left_anti").select("node", "comp")), "components"
            )
            discard(old)
        discard(groups)
        if last:
            break
    return comps


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: id_col, n_shingles, component_id, n_equal, linked.

    Texts are lower-cased (A-Z) and cut into words at ASCII white space; a
    document's set is its distinct shingles of ``width`` words, or its whole
    sequence if it has fewer; without words or text it is empty and linked with
    nothing.  Two documents link when 100 * intersection >= percent * union.
    component_id is the smallest id reachable by links, itself included;
    n_equal is the number of rows with an equal set, linked whether the set
    links with a different one.  Ids are integers.  Rows with a null id take no
    part: they have no component.  Rows that repeat an id are one node of the
    graph, with the links of all their texts; other columns are not looked at;
    an empty table gives an empty result.

    Words are hashed by XXH3.  Sets count as equal if their size and 128 bits
    from two independent hashes of every shingle agree; shared shingles of two
    sets are counted by 64 bits, which could only mislead if two different
    shingles of one compared pair agree in them (1e-12 for two texts of 4,000 words).
    """
    small_batches(docs.sparkSession)
    scratch = Scratch()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8, -(-total // BUCKET_BYTES))
    prints = rows.mapInArrow(giving_back(_prints(width, buckets)), _PRINTS)
    again = prints.groupBy("bucket").applyInArrow(giving_back_group(_again), "kind int, src long, data binary")
    told = scratch.table(again.groupBy("src").applyInArrow(giving_back_group(_told), "id long, n long, a long, b long, shared long"), "told")

    # classes of equal sets, numbered; the row with the smallest id stands for each
    full = told.where("n > 0")
    classes = full.groupBy("n", "a", "b").agg(F.min("id").alias("least"), F.max("shared").alias("shared"), F.count(F.lit(1)).alias("copies"))
    classes = scratch.table(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    # a class of copies shares every print, one set without partners fewer than it needs
    members = scratch.table(classes.where((F.col("n") > 1) & (F.col("shared") >= _needed("n", percent))).select("rep", "n", "a", "b", F.col("least").alias("id")), "members")
    n_members = members.count()
    reps = rows.join(small(members.select("id").distinct(), n_members), "id", "left_semi")

    def sets_of(batches):
        for batch in batches:
            ids = _column(batch, 0).to_pylist()
            found = [(s, total) for _, s, total in shingle_sets(_column(batch, 1), width)]
            for start in range(0, len(found), 256):
                some = found[start : start + 256]
                cuts = np.concatenate(([0], np.cumsum([len(s) for s, _ in some]))).astype(np.int32)
                hs = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate([s for s, _ in some]).view(np.int64)))
                a = np.array([s.sum(dtype=_U) for s, _ in some], dtype=_U).view(np.int64)
                b = np.array([total for _, total in some], dtype=_U).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ids[start : start + 256], pa.int64()), pa.array(a), pa.array(b), hs], names=["id", "a", "b", "hs"])

    sets = reps.mapInArrow(giving_back(sets_of), "id long, a long, b long, hs array<long>")
    # rows that repeat an id may have other texts: the class's own set is the one meant
    sets = sets.join(small(members.select("rep", "id", "a", "b"), n_members), ["id", "a", "b"]).select("rep", "hs").dropDuplicates(["rep"])
    sets = scratch.table(sets, "sets")

    comps = _components(_entries(sets, percent, scratch), sets, percent, scratch)
    named = match_groups(full.select("id", "n", "a", "b"), classes.select("n", "a", "b", "rep", "copies"), ["n", "a", "b"], "copies", told.count())
    named = scratch.table(named.select("id", "n", "rep", "copies"), "named")
    # classes of rows that share an id belong together
    shared = named.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("last")).where("a <> last")
    same_id = scratch.table(named.join(shared, "id").select("a", F.col("rep").alias("b")).where("a <> b").distinct(), "same_id")
    whole = comps
    if same_id.head(1):
        whole = materialize(connected_components(same_id.unionByName(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")))), "components")
    least = classes.select("rep", "least").join(whole, F.col("rep") == F.col("node")).groupBy("comp").agg(F.min("least").alias("component_id"))
    of_class = whole.join(least, "comp").select(F.col("node").alias("rep"), "component_id")
    of_class = classes.select("rep", "copies", "least").join(of_class, "rep", "left").join(comps.select(F.col("node").alias("rep"), F.lit(True).alias("linked")).distinct(), "rep", "left")
    of_class = scratch.table(of_class.select("rep", "copies", F.coalesce("component_id", "least").alias("component_id"), F.coalesce("linked", F.lit(False)).alias("linked")), "class_components")
    found = match_groups(named.drop("copies"), of_class, ["rep"], "copies", told.count()).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("copies").alias("n_equal"), "linked",
    )
    empty = told.where("n = 0").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(1).cast("long").alias("n_equal"), F.lit(False).alias("linked"))
    out = scratch.result(found.unionByName(empty), "near_duplicates")
    discard(comps, whole)
    nameless = docs.where(F.col(id_col).isNull()).select(
        F.lit(None).cast("long").alias(id_col), F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(1).cast("long").alias("n_equal"), F.lit(False).alias("linked")
    )
    return out.unionByName(nameless)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of docs that stay, all columns, whatever their names: of each component one with the smallest id; rows with a null id stay.

    Of rows that repeat that id, one stays.
    """
    (lost,) = unused(docs.columns, "_gone")
    found = near_duplicates(docs, id_col, text_col, **kw)
    gone = materialize(found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias(lost)).distinct(), "gone")
    left = docs.join(small(gone, gone.count()), F.col(id_col) == F.col(lost), "left_anti")
    again = materialize(found.where(F.col(id_col).isNotNull() & (F.col(id_col) == F.col("component_id"))).groupBy(id_col).count().where("count > 1").select(F.col(id_col).alias(lost)), "repeated")
    if n := again.count():
        here = F.col(id_col) == F.col(lost)
        once = left.join(small(again, n), here, "left_semi").dropDuplicates([id_col])
        left = left.join(small(again, n), here, "left_anti").unionByName(once)
    return left

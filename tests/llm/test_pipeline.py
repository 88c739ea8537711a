import zlib

import corpus_pipeline
import numpy as np
from conftest import DATA
from test_groups import brute_components
from pyspark.sql import functions as F
from test_text_operators import brute_contamination, edge  # noqa: F401
from wayloom.llm import langid, queries


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = langid.train(docs.where(langid.fold() != 2))
    rejected = {r["doc_id"] for r in langid.identify(docs, model).where("rejected").collect()}
    left = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] not in rejected}
    last = {t: i for i, t in sorted(left.items())}
    left = {i: t for t, i in last.items()}
    comps = brute_components(list(left.items()))
    left = {i: t for i, t in left.items() if comps[i][1] == i}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    bad = {r[0] for r in brute_contamination(list(left.items()), items) if r[5]}
    got = corpus_pipeline.run(spark, str(DATA)).collect()
    assert {r["doc_id"] for r in got} == set(left) - bad
    sizes = {}
    for r in got:
        sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["piece_len"]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    assert sizes == {i: len(tokenizer.encode(left[i], add_special_tokens=False).ids) + 1 for i in sizes}
    # every sequence, laid out anew from the pieces, has the crc32 that is told
    bins = {}
    for r in got:
        ids = [*tokenizer.encode(left[r["doc_id"]], add_special_tokens=False).ids, 2]
        bins.setdefault((r["bin_id"], r["capacity"], r["bin_crc32"]), {})[r["bin_offset"]] = ids[r["piece_start"] : r["piece_start"] + r["piece_len"]]
    for (_, capacity, crc), parts in bins.items():
        flat = [x for _, p in sorted(parts.items()) for x in p]
        assert zlib.crc32(np.array(flat + [0] * (capacity - len(flat)), "<u4").tobytes()) == crc


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(DATA)).columns == docs.columns




def test_stages_take_any_rows(spark, edge):  # noqa: F811
    """Nulls, empty and repeated rows, no rows: no stage fails, and what stays is as each stage says."""
    docs = edge.select("doc_id", "text", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    for rows in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            if name == "language ID":
                left = stage(spark, rows, str(DATA))
                assert left.where("text is null or trim(text) = ''").count() == 0
            elif name == "best-fit packing":
                assert stage(spark, rows, str(DATA)).select("doc_id").distinct().count() == rows.select("doc_id").distinct().count()
            else:
                assert stage(spark, rows, str(DATA)).columns == rows.columns

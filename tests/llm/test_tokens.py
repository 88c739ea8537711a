import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import DATA
from wayloom.llm import queries, wavelet
from wayloom.llm.common import giving_back
from wayloom.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def encoder():
    return wavelet.PieceEncoder(tokenizer_path(), most=500)


def plain(encoder, text):
    return np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab.,'s12 \n\t\r éß日\x1c-", max_size=40))
def test_pieces_give_the_ids_of_the_whole_text(encoder, text):
    assert encoder.encode([text]) == [plain(encoder, text)]


def test_known_texts(encoder):
    for text in ("", " ", "one", "The end.\nNext line, it's", "two  spaces", " lead", "trail ", "a.\n\nb", "x,,", "9.", "don't.", "w." * 2000):
        assert encoder.encode([text])[0] == plain(encoder, text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70000), max_size=200), st.integers(1, 9))
def test_queries_of_a_file(ids, chunk):
    shard = wavelet.Shard(wavelet.pack(np.array(ids, dtype="<u4"), [1], np.array([len(ids)]), chunk_bytes=chunk))
    assert shard.ids().tolist() == ids
    for i, t in enumerate(ids):
        assert shard.access(i) == t and shard.rank(t, i) == ids[:i].count(t) and shard.select(t, ids[:i].count(t)) == i
    assert shard.count(3) == ids.count(3) and shard.select(71000, 0) == -1 and shard.count(1 << 40) == 0
    with pytest.raises(IndexError):
        shard.access(len(ids))


def test_files_round_trip(spark, encoder):
    given_rows = [(5, "five five", 1), (2, None, 2), (9, "", 3), (None, "no id", 4), (2, "two again", 5), (7, "long " * 4000, 6), (5, "five five", 7)]
    docs = spark.createDataFrame(given_rows, "doc_id long, text string, start long")
    manifest = wavelet.write_shards(docs, tokenizer_path(), shard_tokens=500)
    assert manifest.count() > 1
    got = sorted(wavelet.read_shards(manifest).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 2, 2, 5, 5, 7, 9]
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    want = sorted((i, zlib.crc32(plain(encoder, t or "") + np.array([2], "<u4").tobytes())) for i, t, _ in given_rows if i is not None)
    assert sorted((r["doc_id"], r["ids_crc32"]) for r in got if r["doc_id"] is not None) == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert wavelet.read_shards(wavelet.write_shards(docs, tokenizer_path())).count() == 0


def test_packing_query_packs_token_ids(spark):
    got = queries.op3_variable_best_fit(spark, str(DATA)).collect()
    want = {r["doc_id"]: r["n_tokens"] for r in queries.op1_wavelet_tokens(spark, str(DATA)).collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want
    sizes = {}
    for r in got:
        sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["piece_len"]
    assert sizes == want


def test_counts_are_those_of_the_ids(spark, encoder):
    texts = ["", "one", "two  spaces\n", "a b\nc d.", "日本" * 9000, "x" * 9000]
    assert encoder.count(texts) == [len(plain(encoder, t)) // 4 for t in texts]
    rows = [(1, None), (1, "one"), (None, "日本" * 9000)]
    got = wavelet.token_counts(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer_path()).collect()
    assert sorted(r["n_tokens"] for r in got) == sorted(1 + len(plain(encoder, t or "")) // 4 for _, t in rows)


def test_encoder_memory_does_not_follow_the_words_it_has_met():
    """Texts of ever new words, in a process of its own: what it held at most beyond the loaded encoder."""
    script = """
import re
import pyarrow as pa
from wayloom.llm import wavelet
from wayloom.llm.common import giving_back
from wayloom.llm.queries import tokenizer_path

held = lambda name: int(re.search(name + r":\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024
enc = wavelet.PieceEncoder(tokenizer_path())
enc.count(["one text"])
loaded = held("VmRSS")

def batches():
    for k in range(10):
        yield pa.array([" ".join(f"w{(k * 2500 + i) * 60 + j:x} and the {j}" for j in range(60)) * 2 for i in range(2500)])

def run(columns):
    for column in columns:
        for ids, sizes in enc.encode_column(column):
            yield int(sizes.sum())

assert sum(giving_back(run)(batches())) > 10_000_000
print(held("VmHWM") - loaded)
"""
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, check=True, cwd=Path(wavelet.__file__).parents[2], timeout=300)
    assert int(out.stdout) < 160


def test_workers_use_one_allocator(spark):
    def run(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pylist([{"pool": pa.default_memory_pool().backend_name}])

    assert {r["pool"] for r in spark.range(2).mapInArrow(giving_back(run), "pool string").collect()} == {"system"}

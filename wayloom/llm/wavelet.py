"""Token ids in wavelet-matrix files.

A shard file holds the ids of a run of documents as bit-planes: plane l has bit
l (from the top) of each id, after the ids were stably parted by the bits above
it.  Planes are cut into compressed chunks with running counts of ones, so one
file answers access (id at a place), rank and count (how often an id occurs
before a place), and select (where the k-th occurrence is) by reading a chunk a
plane.

Layout, little-endian: magic, u32 header length, header (JSON: levels, n, docs,
chunk bytes, zeros of each plane), then sections, each a u64 length and bytes:
document ids (zstd, i64, with a validity byte each), token counts (zstd, u32),
the chunk directory (zstd; for each plane and chunk u64 offset, u32 length, u64
ones before it), and the chunks.
"""

from __future__ import annotations

import io
import json
import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import giving_back, materialize, new_path, small_batches

MAGIC = b"WLWAVE01"
CHUNK_BYTES = 1 << 15
#: Ids after which a shard file is closed, at the next document's end.
SHARD_TOKENS = 1 << 21
#: Words whose ids a worker remembers, and the bytes they may have: beyond either it begins anew.
CACHE_WORDS, CACHE_BYTES = 500_000, 12 << 20
#: Text bytes that are encoded at once, or one longer text.
SLICE_BYTES = 2 << 20
#: Rows of an Arrow batch of texts.
BATCH_ROWS = 2500


# -- encoding -----------------------------------------------------------------


class PieceEncoder:
    """Encodes with a byte-level BPE tokenizer, word by word, and remembers words.

    The tokenizer's own pattern never joins text across a single space, or a
    single line feed, that stands between characters that are not white space:
    the space begins the next word and the line feed is a word of its own.  Nor
    does it join a Latin letter and a run of points, commas or other signs that
    ends a piece.  Pieces between such places therefore have the ids that they
    have within the whole text.  Texts with other white space are cut only at
    such spaces.

    Arrow cuts a column of texts and finds the distinct pieces and words; only
    words that are not known yet reach the tokenizer, many in one text.  The
    ids of known words stand in one array, from which all texts are gathered.
    """

    #: White space other than single spaces and line feeds between other characters (RE2 has no Unicode \\s).
    _ODD = r"  |\n\n| \n|\n |^[ \n]|[ \n]\z|[\t\x0b\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    _CUT = re.compile(r"(?<=\S) (?=\S)")
    _WHITE = re.compile(r"\s")
    #: A word with white space in it, or none at all.
    _ALONE = r"(?s)\A.\z|\A.+[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    _LETTER_LAST = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]\z"
    #: Signs that the tokenizer parts from a letter before them.  The apostrophe is not among them: it may join what follows.
    _SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, path: str, most: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a worker has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(self._WHITE.search(t) for t in self.special):
            raise ValueError("special tokens with white space could cross pieces")
        if hasattr(self.tokenizer.model, "_resize_cache"):  # no word comes twice, so the tokenizer's own cache only costs
            self.tokenizer.model._resize_cache(0)
        self.wide = self.tokenizer.get_vocab_size() > 1 << 16
        self.most = most
        feed = self._each(["\n"])[0]
        if len(feed) != 1:
            raise ValueError("a line feed must be one id")
        self.line_feed = feed[0]
        self._forget()

    def _forget(self) -> None:
        # words with what stands before them, a space or a line feed; entry 0 has no ids, entry 1 those of the line feed itself
        self.words = pa.array(["\n", ""], pa.string())
        self.ids = np.array([self.line_feed], dtype="<u4")
        self.start, self.size = np.zeros(2, np.int64), np.array([0, 1], np.int64)

    def _each(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _places(self, wanted: pa.Array) -> np.ndarray:
        """Entries of distinct words, each after a space or a line feed; the line feed's own id is not among a word's."""
        # Arrow hashes the wanted words, not all known ones: time and memory follow the slice
        met = pc.index_in(self.words, value_set=wanted)
        at = np.full(len(wanted), -1, np.int64)
        at[np.asarray(met.drop_null())] = np.flatnonzero(np.asarray(met.is_valid()))
        missing = at < 0
        if missing.any():
            new = wanted.filter(pa.array(missing))
            known, ids, sizes = len(self.words), [], []
            for lead in ("\n", " "):
                mine = new.filter(pc.starts_with(new, lead))
                odd = pc.match_substring_regex(mine, self._ALONE)
                plain, alone = mine.filter(pc.invert(odd)), mine.filter(odd)
                self.words = pa.concat_arrays([self.words, plain, alone])
                for k in range(0, len(plain), 512):
                    some = plain.slice(k, 512).to_pylist()
                    if lead == "\n":  # words at the start of a line
                        text = "".join(some)[1:]
                    else:
                        text = "\n".join(some)
                    got = np.array(self._each([text])[0], dtype="<u4")
                    feeds = np.flatnonzero(got == self.line_feed)
                    if len(feeds) != len(some) - 1:
                        raise ValueError("a word has a line feed's id")
                    ids.append(np.delete(got, feeds))
                    sizes.append(np.diff(np.concatenate(([-1], feeds, [len(got)]))) - 1)
                for got in self._each([x if lead == " " else x[1:] for x in alone.to_pylist()]):
                    ids.append(np.array(got, dtype="<u4"))
                    sizes.append(np.array([len(got)]))
            sizes = np.concatenate(sizes).astype(np.int64)
            self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(sizes) - sizes])
            self.size = np.concatenate([self.size, sizes])
            self.ids = np.concatenate([self.ids, *ids])
            at[missing] = np.asarray(pc.index_in(new, value_set=self.words.slice(known))).astype(np.int64) + known
        return at

    @staticmethod
    def _gather(ids: np.ndarray, start: np.ndarray, size: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The ids of entries, one after the other."""
        out = []
        for k in range(0, len(places), 1 << 18):
            some = places[k : k + (1 << 18)]
            sizes = size[some]
            shift = start[some] - (np.cumsum(sizes) - sizes)
            out.append(ids[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))])
        return np.concatenate(out) if out else ids[:0]

    def _parts(self, pieces: pa.Array) -> np.ndarray:
        """Three entries for each piece: a line feed before it, its word, the signs that end it; 0 for none.

        A piece stands after a space, or begins with the line feed that is before it.
        """
        fed = pc.starts_with(pieces, "\n")
        body = pc.if_else(fed, pc.utf8_slice_codeunits(pieces, 1), pieces)
        word = pc.utf8_rtrim(body, characters=self._SIGNS)
        cut = pc.match_substring_regex(word, self._LETTER_LAST)
        for t in self.special:
            cut = pc.and_(cut, pc.invert(pc.match_substring(body, t)))
        word = pc.if_else(cut, word, body)
        keys = pc.binary_join_element_wise(pc.if_else(fed, "\n", " "), word, "")
        rest = np.asarray(pc.binary_length(body)) - np.asarray(pc.binary_length(word))  # signs are a byte each
        longer = np.flatnonzero(rest)
        _, offsets, data = body.buffers()
        stops = np.frombuffer(offsets, np.int32)[body.offset + 1 : body.offset + 1 + len(body)].astype(np.int64)[longer]
        many = rest[longer].astype(np.int64)
        # a line feed, then the signs
        cuts = np.cumsum(many + 1)
        ends = np.full(int(cuts[-1]) if len(cuts) else 0, 10, np.uint8)
        signs = np.ones(len(ends), bool)
        signs[cuts - many - 1] = False
        ends[signs] = np.frombuffer(data, np.uint8)[np.repeat(stops - np.cumsum(many), many) + np.arange(int(many.sum()))]
        ends = pa.Array.from_buffers(pa.string(), len(many), [None, pa.py_buffer(np.concatenate(([0], cuts)).astype(np.int32).tobytes()), pa.py_buffer(ends.tobytes())])
        both = pa.concat_arrays([keys, ends]).dictionary_encode()
        at = self._places(both.dictionary)[np.asarray(both.indices)]
        out = np.zeros((len(pieces), 3), np.int64)
        out[:, 0] = np.asarray(fed)
        out[:, 1] = at[: len(pieces)]
        out[longer, 2] = at[len(pieces) :]
        return out

    def pieces(self, column: pa.Array):
        """(ids, start and size of the distinct pieces, which piece stands where, pieces of each text), a slice of texts at a time."""
        if column.null_count:
            column = column.fill_null("")
        sizes = np.asarray(pc.binary_length(column)).astype(np.int64)
        ends, row = np.cumsum(sizes), 0
        while row < len(column):
            before = int(ends[row - 1]) if row else 0
            stop = max(row + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
            if len(self.words) > self.most or self.words.nbytes > CACHE_BYTES:
                self._forget()
            yield self._slice(column.slice(row, stop - row))
            row = stop

    def _slice(self, texts: pa.Array):
        odd = np.asarray(pc.match_substring_regex(texts, self._ODD))
        found = {}
        if odd.any():
            which = np.flatnonzero(odd)
            found = {k: self._CUT.split(t) for k, t in zip(which.tolist(), texts.take(pa.array(which)).to_pylist())}
            texts = pc.if_else(pa.array(~odd), texts, "")
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        offsets = np.asarray(lists.offsets).astype(np.int64)
        distinct = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = offsets - offsets[0]
        # a text's first piece has no space before it: as at the start of a line, without the line feed
        heads = pa.array([*(["\n" + h for h in distinct.take(pa.array(offsets[:-1])).dictionary_decode().to_pylist()]), *("\n" + ps[0] for ps in found.values())], pa.string())
        inner = pa.array([p for ps in found.values() for p in ps[1:]], pa.string())
        parts = self._parts(pa.concat_arrays([distinct.dictionary.cast(pa.string()), heads, inner]))
        base, n = len(distinct.dictionary), len(heads)
        parts[base : base + n, 0] = 0
        size = self.size[parts].sum(axis=1)
        ids = self._gather(self.ids, self.start, self.size, parts.ravel())
        start = np.cumsum(size) - size
        where, counts = np.asarray(distinct.indices).astype(np.int64), np.diff(offsets)
        where[offsets[:-1]] = base + np.arange(len(counts))
        if found:
            bits, at, head, inside = [], 0, base + len(counts), base + n
            for k, ps in found.items():
                bits += [where[at : offsets[k]], [head], np.arange(inside, inside + len(ps) - 1)]
                at, counts[k], head, inside = offsets[k + 1], len(ps), head + 1, inside + len(ps) - 1
            where = np.concatenate([*bits, where[at:]]).astype(np.int64)
        return ids, start, size, where, counts

    def count_column(self, column: pa.Array) -> np.ndarray:
        """The number of ids of each text of a column."""
        out = [np.add.reduceat(size[where], np.cumsum(counts) - counts) for _, _, size, where, counts in self.pieces(column)]
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def encode_column(self, column: pa.Array):
        """(ids, number of ids of each text), a slice of texts at a time."""
        for ids, start, size, where, counts in self.pieces(column):
            yield self._gather(ids, start, size, where), np.add.reduceat(size[where], np.cumsum(counts) - counts)

    def count(self, texts: list[str]) -> list[int]:
        return self.count_column(pa.array(texts, pa.string())).tolist()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        return [x.astype("<u4").tobytes() for ids, sizes in self.encode_column(pa.array(texts, pa.string())) for x in np.split(ids, np.cumsum(sizes)[:-1])]


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


# -- the file format ----------------------------------------------------------


def pack(ids: np.ndarray, doc_ids: list, counts: np.ndarray, chunk_bytes: int = CHUNK_BYTES) -> bytes:
    """The bytes of a shard file."""
    press = zstandard.ZstdCompressor(level=1).compress
    n = len(ids)
    levels = max(1, int(ids.max()).bit_length()) if n else 1
    now = ids.astype("<u2" if levels <= 16 else "<u4")
    zeros, directory, chunks, at = [], [], [], 0
    for level in range(levels):
        bit = (now >> (levels - 1 - level)) & 1
        ones = bit.astype(bool)
        raw = np.packbits(ones, bitorder="little")
        before = 0
        for start in range(0, len(raw), chunk_bytes):
            part = raw[start : start + chunk_bytes]
            pressed = press(part.tobytes())
            directory.append((at, len(pressed), before))
            before += int(np.bitwise_count(part).sum())
            at += len(pressed)
            chunks.append(pressed)
        zeros.append(n - before)
        now = np.concatenate([now.take(np.flatnonzero(~ones)), now.take(np.flatnonzero(ones))])
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    keys = np.array([d or 0 for d in doc_ids], dtype="<i8")
    head = json.dumps({"levels": levels, "n": n, "docs": len(doc_ids), "chunk": chunk_bytes, "zeros": zeros}).encode()
    table = np.array(directory, dtype=[("at", "<u8"), ("size", "<u4"), ("ones", "<u8")])
    out = io.BytesIO()
    out.write(MAGIC + struct.pack("<I", len(head)) + head)
    for section in (press(keys.tobytes() + known.tobytes()), press(np.asarray(counts, dtype="<u4").tobytes()), press(table.tobytes())):
        out.write(struct.pack("<Q", len(section)) + section)
    out.write(struct.pack("<Q", at) + b"".join(chunks))
    return out.getvalue()


class Shard:
    """Queries on the bytes of a shard file; chunks are expanded when they are needed."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a wavelet shard")
        (size,) = struct.unpack_from("<I", data, 8)
        head = json.loads(data[12 : 12 + size])
        self.levels, self.n, self.chunk, self.zeros = head["levels"], head["n"], head["chunk"], head["zeros"]
        expand, at, sections = zstandard.ZstdDecompressor().decompress, 12 + size, []
        for _ in range(3):
            (size,) = struct.unpack_from("<Q", data, at)
            sections.append(expand(data[at + 8 : at + 8 + size]))
            at += 8 + size
        docs = head["docs"]
        keys, known = np.frombuffer(sections[0][: 8 * docs], "<i8"), sections[0][8 * docs :]
        self.doc_ids = [int(k) if ok else None for k, ok in zip(keys, known)]
        self.counts = np.frombuffer(sections[1], "<u4")
        self.directory = np.frombuffer(sections[2], [("at", "<u8"), ("size", "<u4"), ("ones", "<u8")])
        self.per_plane = -(-(-(-self.n // 8)) // self.chunk)
        self.data, self.base, self.expand, self.seen = data, at + 8, expand, {}

    def _chunk(self, level: int, k: int) -> np.ndarray:
        if (level, k) not in self.seen:
            d = self.directory[level * self.per_plane + k]
            start = self.base + int(d["at"])
            self.seen[level, k] = np.frombuffer(self.expand(self.data[start : start + int(d["size"])]), np.uint8)
        return self.seen[level, k]

    def _ones(self, level: int, i: int) -> int:
        """Ones of a plane before place i."""
        k, rest = divmod(i, 8 * self.chunk)
        if k == self.per_plane:
            return self.n - self.zeros[level]
        part, before = self._chunk(level, k), int(self.directory[level * self.per_plane + k]["ones"])
        whole, bits = divmod(rest, 8)
        tail = int(part[whole]) & ((1 << bits) - 1) if bits else 0
        return before + int(np.bitwise_count(part[:whole]).sum()) + tail.bit_count()

    def _bit(self, level: int, i: int) -> int:
        k, rest = divmod(i, 8 * self.chunk)
        return int(self._chunk(level, k)[rest >> 3]) >> (rest & 7) & 1

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level in range(self.levels):
            bit, ones = self._bit(level, i), self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where occurrences of an id among the first i places stand after the last plane."""
        low, high = 0, i
        if token >> self.levels:
            return 0, 0
        for level in range(self.levels):
            a, b = self._ones(level, low), self._ones(level, high)
            if token >> (self.levels - 1 - level) & 1:
                low, high = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, high = low - a, high - b
        return low, high

    def rank(self, token: int, i: int) -> int:
        """How often an id occurs before place i."""
        low, high = self._range(token, min(max(i, 0), self.n))
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """The place of the k-th occurrence (from 0) of an id, or -1."""
        low, high = self._range(token, self.n)
        if not 0 <= k < high - low:
            return -1
        i = low + k
        for level in reversed(range(self.levels)):
            one = token >> (self.levels - 1 - level) & 1
            wanted = i - self.zeros[level] if one else i
            a, b = wanted, self.n - 1  # the wanted bit, from 0, is not before place a
            while a < b:
                m = (a + b) // 2
                ones = self._ones(level, m + 1)
                if (ones if one else m + 1 - ones) > wanted:
                    b = m
                else:
                    a = m + 1
            i = a
        return i

    def ids(self) -> np.ndarray:
        """All ids, in order."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        now = np.zeros(self.n, dtype=kind)
        for level in reversed(range(self.levels)):
            parts = [self._chunk(level, k) for k in range(self.per_plane)]
            ones = np.unpackbits(np.concatenate(parts) if parts else np.zeros(0, np.uint8), count=self.n, bitorder="little").view(bool)
            z, up = self.zeros[level], np.empty(self.n, dtype=kind)
            up[np.flatnonzero(~ones)] = now[:z]
            up[np.flatnonzero(ones)] = now[z:] | kind(1 << (self.levels - 1 - level))
            now = up
            for k in range(self.per_plane):
                self.seen.pop((level, k), None)
        return now.astype("<u4")


# -- Spark --------------------------------------------------------------------


def _filesystem(path: str):
    """The store of a path and the path in it; Spark's names of stores as pyarrow knows them."""
    from pyarrow import fs

    scheme, mark, rest = path.partition("://")
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + mark + rest)


def _put(path: str, data: bytes) -> None:
    """Write a whole file, or none: to another name first, then moved."""
    where, name = _filesystem(path)
    where.create_dir(name.rpartition("/")[0], recursive=True)
    with where.open_output_stream(f"{name}.part") as f:
        f.write(data)
    where.move(f"{name}.part", name)


def _get(path: str) -> bytes:
    where, name = _filesystem(path)
    with where.open_input_stream(name) as f:
        return f.read()


def _binary(ids: np.ndarray, sizes: np.ndarray, kind: str) -> pa.Array:
    """Runs of ids as a binary column."""
    offsets = np.concatenate(([0], np.cumsum(sizes))) * np.dtype(kind).itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.astype("<i8").tobytes()), pa.py_buffer(ids.astype(kind).tobytes())]).cast(pa.binary())


def _ended(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> np.ndarray:
    """Ids with an end mark after each text's."""
    return np.insert(ids, np.cumsum(sizes), end_id)


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col and n_tokens, the ids of its text and an end mark; a null text is empty."""
    small_batches(docs.sparkSession, BATCH_ROWS)
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        enc = encoder(tokenizer)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(enc.count_column(batch.column(1)) + 1)], names=[id_col, "n_tokens"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long")


def token_ids(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, n_tokens and ids, an end mark after them; a null text is empty.

    ids are little-endian unsigned integers of octet_length(ids) / n_tokens
    bytes each: two if the vocabulary has up to 65,536 ids, else four.
    """
    small_batches(docs.sparkSession, BATCH_ROWS)
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        enc = encoder(tokenizer)
        width = "<u4" if enc.wide or end_id >> 16 else "<u2"
        for batch in batches:
            at = 0
            for ids, sizes in enc.encode_column(batch.column(1)):
                some = batch.column(0).slice(at, len(sizes))
                at += len(sizes)
                yield pa.RecordBatch.from_arrays([some, pa.array(sizes + 1), _binary(_ended(ids, sizes, end_id), sizes + 1, width)], names=[id_col, "n_tokens", "ids"])

    return docs.select(id_col, text_col).mapInArrow(giving_back(run), f"`{id_col}` {kind}, n_tokens long, ids binary")


MANIFEST = "part long, seq long, path string, n_docs long, n_tokens long, before long"


def write_shards(docs: DataFrame, tokenizer: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS, folder: str | None = None) -> DataFrame:
    """Encode every text, append end_id, write shard files in ascending id order; returns their manifest.

    Columns: part, seq (the order of files), path, n_docs, n_tokens, start (ids
    of all files before).  Null texts are empty; rows with a null id come first;
    rows that repeat an id follow each other in the order of their texts'
    hashes; other columns are not looked at; an empty table writes no file.

    Texts are encoded where they are read, and their ids (two bytes each for a
    vocabulary of up to 65,536) are dealt to ranges of document ids.  A file is
    closed after the document that reaches shard_tokens, so what a task holds is
    bounded by that and its longest text.  Names are new for each attempt at a
    task and only files of attempts that succeeded are listed, so a lost
    executor leaves no wrong file behind.
    """
    spark = docs.sparkSession
    small_batches(spark, BATCH_ROWS)
    folder = folder or new_path(spark, "tokens")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"), F.col(text_col).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # bounds of the ranges: a number a partition
    cuts = rows.agg(F.percentile_approx("id", [i / parts for i in range(1, parts)] or [1.0], max(10_000, 10 * parts))).first()[0]
    bounds = np.array(cuts if parts > 1 and cuts else [], dtype=np.int64)

    def encode(batches):
        enc = encoder(tokenizer)
        kind = "<u4" if enc.wide or end_id >> 16 else "<u2"
        for batch in batches:
            at, known = 0, batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            part = np.where(known, np.searchsorted(bounds, batch.column(0).fill_null(0).to_numpy()), 0)
            for ids, sizes in enc.encode_column(batch.column(2)):
                some = batch.slice(at, len(sizes))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[at : at + len(sizes)], pa.int32()), some.column(0), some.column(1), pa.array(np.full(len(sizes), np.dtype(kind).itemsize), pa.int32()), _binary(_ended(ids, sizes, end_id), sizes + 1, kind)],
                    names=["part", "id", "h", "width", "ids"],
                )
                at += len(sizes)

    def write(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        keys, held, size, seq, before = [], [], 0, 0, 0

        def close():
            nonlocal keys, held, size, seq, before
            path = f"{folder}/{part:06d}-{seq:06d}-{uuid.uuid4().hex[:12]}.wave"
            _put(path, pack(np.concatenate(held), keys, np.array([len(h) for h in held], dtype="<u4")))
            row = [part, seq, path, len(keys), size, before]
            keys, held, size, seq, before = [], [], 0, seq + 1, before + size
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["part", "seq", "path", "n_docs", "n_tokens", "before"])

        for batch in batches:
            for key, width, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                keys.append(key)
                held.append(np.frombuffer(ids.as_buffer(), f"<u{width}").copy())
                size += len(held[-1])
                if size >= shard_tokens:
                    yield close()
        if keys:
            yield close()

    dealt = rows.mapInArrow(encode, "part int, id long, h long, width int, ids binary").repartitionById(parts, "part").sortWithinPartitions("id", "h")
    files = materialize(dealt.select("id", "width", "ids").mapInArrow(write, MANIFEST), "manifest")
    # one row for each partition that wrote: as many as the shuffle has partitions
    totals = sorted((r["part"], r["n"]) for r in files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    starts, at = [], 0
    for part, n in totals:
        starts.append((part, at))
        at += n
    base = spark.createDataFrame(starts, "part long, base long")
    return files.join(F.broadcast(base), "part").select("part", "seq", "path", "n_docs", "n_tokens", (F.col("base") + F.col("before")).alias("start"))


def read_shards(manifest: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document of the files: id, start, n_tokens, ids_crc32 of all its ids."""

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(_get(path))
                ids = memoryview(shard.ids().tobytes())
                ends = 4 * np.cumsum(shard.counts, dtype=np.int64)
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, pa.int64()), pa.array(start + ends // 4 - shard.counts, pa.int64()), pa.array(shard.counts.astype(np.int64)), pa.array(crcs, pa.int64())],
                    names=[id_col, "start", "n_tokens", "ids_crc32"],
                )

    return manifest.select("path", "start").mapInArrow(read, f"{id_col} long, start long, n_tokens long, ids_crc32 long")

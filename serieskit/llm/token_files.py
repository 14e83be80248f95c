"""Token ids as flat binary files with 64-bit document offsets.

A part file holds one or more blocks. A block is: the ids of its documents as one flat
unsigned little-endian array (16 bits wide if the vocabulary fits, else 32), zero bytes up to a
multiple of 8, the documents' starts inside the block as 64-bit unsigned integers with the total behind them, their doc_ids as 64-bit
signed integers, one byte each that says whether the doc_id is known (again filled up to 8), and a footer of
three 64-bit integers (documents, ids, bytes per id) before the eight bytes of ``MAGIC``. All
arrays can be memory-mapped in place. Parts are ranges of doc_id, so reading parts in name order gives
ascending doc_ids; a block's base in the corpus is the prefix sum of the ids before it.

Spark's text writer writes the files: a block is one row and ``MAGIC`` is its line end, so the
files may lie in any store Spark writes to and are committed as any Spark output.

Defined cases: a null text is empty; an empty text has only the end id; rows that repeat a
doc_id follow each other in the order of a hash of their text; a null doc_id comes first; other columns are
ignored; no rows give no blocks.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from serieskit.llm.common import scratch, small_batches, stored, texts

MAGIC = "IDBLOCK1"
FOOTER = 24
PART_BYTES = 24 << 20
BLOCK_BYTES = 8 << 20
# Blocks of a part file, so that no part grows beyond what is read at once, whatever lies in its range.
PART_BLOCKS = 32
# Part numbers whose blocks are summed up in one group.
BAND_PARTS = 1_000
CACHE_RUNS = 400_000

# What the tokenizer's own pattern cuts a lower-cased Latin-1 text into.
_LETTERS, _NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾"
_RUN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\t-\r {_LETTERS}{_NUMBERS}]+")
# Texts with these go to the library whole: its special tokens, and controls that are white space in one pattern language and not in another.
_ODD = re.compile("<\\||[\x1c-\x1f\x85\xa0]")
# Byte-level models see a byte as one printable sign: itself where it is one, else the next sign from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


class CachedEncoder:
    """Ids of whole texts, by the tokenizer, with the ids of runs of letters, digits and signs it has met kept.

    The tokenizer lower-cases, drops white space and never joins across the borders of such runs, so a text's ids are those of
    its runs. That holds for tokenizers whose pattern is ``pattern``; texts beyond Latin-1 and all texts of other tokenizers are
    encoded whole. Two generations of runs bound the memory.
    """

    pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        cuts = (made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        kinds = [n["type"] for n in (made.get("normalizer") or {}).get("normalizers", [])]
        self.by_runs = cuts[0].get("pattern", {}).get("Regex") == self.pattern and kinds == ["NFC", "Replace", "Lowercase"]
        self.runs: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _library(self, whole: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(whole, add_special_tokens=False)]

    def _model(self, run: str) -> bytes:
        """Ids of one run by the tokenizer's model alone: its normalizer and its pattern would leave the run as it is."""
        signs = run if run.isascii() and run.isprintable() else run.encode().decode("latin-1").translate(_BYTE_SIGNS)
        return array(self.kind.char, [token.id for token in self.tokenizer.model.tokenize(signs)]).tobytes()

    def _cut(self, text: str) -> list[str] | None:
        low = text.lower()
        if not low.isascii():
            try:
                low.encode("latin-1")
            except UnicodeEncodeError:
                return None
        return None if _ODD.search(low) else _RUN.findall(low)

    def encode(self, batch: list[str]) -> list[bytes]:
        if not self.by_runs:
            return self._library(batch)
        if len(self.runs) > CACHE_RUNS:
            self.runs, self.older = {}, self.runs
        cut = [self._cut(text) for text in batch]
        runs, older = self.runs, self.older
        new = set().union(*(c for c in cut if c)).difference(runs)
        if older:
            runs.update((run, older[run]) for run in new if run in older)
            new.difference_update(older)
        runs.update((run, self._model(run)) for run in new)
        whole = iter(self._library([text for text, c in zip(batch, cut) if c is None]))
        return [next(whole) if c is None else b"".join(map(runs.__getitem__, c)) for c in cut]


_ENCODERS: dict[str, CachedEncoder] = {}


def encoder(path: str) -> CachedEncoder:
    """The worker's encoder for a tokenizer file; its words are kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = CachedEncoder(path)
    return _ENCODERS[path]


def _padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def pack_block(docs: list[tuple[int | None, bytes]], width: int) -> bytes:
    """The bytes of one block, without ``MAGIC``."""
    sizes = np.array([len(ids) // width for _, ids in docs], "<u8")
    starts = np.concatenate([np.zeros(1, "<u8"), np.cumsum(sizes, dtype="<u8")])
    known = np.array([i is not None for i, _ in docs], "u1")
    doc_ids = np.array([i or 0 for i, _ in docs], "<i8")
    footer = np.array([len(docs), int(starts[-1]), width], "<u8")
    return b"".join((_padded(b"".join(ids for _, ids in docs)), starts.tobytes(), doc_ids.tobytes(), _padded(known.tobytes()), footer.tobytes()))


def blocks_of(data) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, starts, doc_ids, known) of every block of a part, as views of its bytes (a buffer or a memory map)."""
    data = np.frombuffer(data, "u1") if not isinstance(data, np.ndarray) else data
    end, found = len(data), []
    while end:
        if bytes(data[end - len(MAGIC) : end]) != MAGIC.encode():
            raise ValueError("not a part of token ids")
        end -= len(MAGIC)
        docs, count, width = (int(x) for x in data[end - FOOTER : end].view("<u8"))
        known_at = end - FOOTER - (docs + 7) // 8 * 8
        ids_at = known_at - 8 * docs
        starts_at = ids_at - 8 * (docs + 1)
        begin = starts_at - (count * width + 7) // 8 * 8
        found.append((
            data[begin : begin + count * width].view(f"<u{width}"), data[starts_at:ids_at].view("<u8"),
            data[ids_at:known_at].view("<i8"), data[known_at : known_at + docs].view("u1"),
        ))
        end = begin
    return found[::-1]


def open_part(path: str):
    """A part of a local or mounted folder as memory maps, block by block."""
    return blocks_of(np.memmap(path, "u1", "r")) if os.path.getsize(path) else []


def _pack(path: str, end_id: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        end = np.array([end_id], enc.kind).tobytes()
        docs, size = [], 0

        def block():
            return pa.RecordBatch.from_arrays([pa.array([pack_block(docs, enc.kind.itemsize)], pa.binary())], ["block"])

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(batch.column("text").to_pylist())):
                docs.append((doc_id, ids + end))
                size += len(ids) + 24
                if size >= BLOCK_BYTES:
                    yield block()
                    docs, size = [], 0
        if docs:
            yield block()

    return pack


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES) -> None:
    """Write the ids of every whole text, ``end_id`` behind each, in ascending doc_id order under ``folder``.

    One shuffle of the texts by ranges of doc_id; the number of ranges follows the bytes of text. Rows of one doc_id and text are
    alike in the files, so they may be spread over ranges by their place in the input.
    """
    small_batches(docs.sparkSession)
    rows = texts(docs, id_col, text_col)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spread = rows.withColumn("tie", F.xxhash64("text")).withColumn("spread", F.monotonically_increasing_id())
    ranges = spread.repartitionByRange(max(1, -(-total // part_bytes)), "doc_id", "tie", "spread")
    ordered = ranges.sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    packed = ordered.mapInArrow(_pack(tokenizer_path, end_id), "block binary")
    packed.select(F.col("block").cast("string").alias("value")).write.option("lineSep", MAGIC).option("maxRecordsPerFile", PART_BLOCKS).text(folder)


FILES_OF_A_PART = 10_000
READ_FIELDS = "part long, block long, place long, doc_id long, start long, n_tokens long, ids_crc32 long"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in READ_FIELDS.split(", ")]
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            name = re.search(r"part-(\d+)-.*?(?:-c(\d+))?\.", path.rsplit("/", 1)[1])
            part = int(name[1]) * FILES_OF_A_PART + int(name[2] or 0)
            raw = content.as_buffer()
            for block, (ids, starts, doc_ids, known) in enumerate(blocks_of(raw) if raw.size else []):
                n = len(doc_ids)
                bounds = starts.astype("i8")
                sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                columns = [np.full(n, part), np.full(n, block), np.arange(n), None, bounds[:-1], np.diff(bounds), np.array(sums, "i8")]
                columns = [pa.array(doc_ids, pa.int64(), mask=known == 0) if c is None else pa.array(c, pa.int64()) for c in columns]
                yield pa.RecordBatch.from_arrays(columns, names)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start in the whole corpus, n_tokens and ids_crc32 of every document, from the files alone.

    A block's base is the prefix sum over the blocks of its band of parts, behind the sum of all bands before.
    """
    small_batches(spark)
    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    rows = stored(files.mapInArrow(_read, READ_FIELDS), "token-index")
    sums = rows.groupBy("part", "block").agg(F.sum("n_tokens").alias("ids")).withColumn("band", F.floor(F.col("part") / (FILES_OF_A_PART * BAND_PARTS)))
    inside, before = (w.rowsBetween(Window.unboundedPreceding, -1) for w in (Window.partitionBy("band").orderBy("part", "block"), Window.orderBy("band")))
    bands = sums.groupBy("band").agg(F.sum("ids").alias("ids")).select("band", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("band_base"))
    bases = sums.withColumn("inside", F.coalesce(F.sum("ids").over(inside), F.lit(0))).join(bands, "band")
    bases = bases.select("part", "block", (F.col("band_base") + F.col("inside")).alias("base"))
    return rows.join(bases, ["part", "block"]).select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write the files into the shared folder and read them back."""
    folder = scratch(docs.sparkSession, "token-files")
    write_token_files(docs, folder, tokenizer_path, end_id)
    return read_token_files(docs.sparkSession, folder)

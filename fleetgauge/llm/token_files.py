"""Token ids in Parquet list columns: encoded columns, set row groups and pages, selective reads."""

from __future__ import annotations

import os
import re
import unicodedata
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetgauge.llm.common import Memo, table
from fleetgauge.sources.session import checkpoint_root

VOCABULARY, END = "byte_bpe_50k.json", 0
#: Bytes of a row group and rows of a page: a reader of a few documents skips the pages of all others by the page index.
ROW_GROUP, PAGE_ROWS = 32 << 20, 500
#: Texts per task of the ordered write.
TASK_ROWS = 8_000


#: Code points below this are told apart by character classes of the standard library's expressions, which are faster.
NARROW = 0x250


def _narrow_pattern() -> str:
    """The tokenizer's pattern of pieces with its classes of letters, numbers and white space written out."""

    def members(test) -> str:
        return "".join(f"\\u{i:04x}" for i in range(NARROW) if test(chr(i)))

    letter, number = (members(lambda c, kind=kind: unicodedata.category(c)[0] == kind) for kind in "LN")
    space = members(lambda c: c in "\t\n\x0b\x0c\r \x85\xa0")
    return rf"'(?:[sdmt]|ll|ve|re)| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones for themselves, the others, in
    order, for those from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Ids of texts as the vocabulary file's tokenizer gives them.

    The tokenizer cuts a text into pieces before it merges bytes, and the ids of a piece depend on nothing else, so each
    distinct piece is encoded once and remembered. Texts that name a special token go to the tokenizer whole. The
    vocabulary has to be one of bytes.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.wide, self.narrow = regex.compile(public_tokenizers.PATTERN).findall, re.compile(_narrow_pattern()).findall
        self.beyond = re.compile(f"[^\\u0000-\\u{NARROW - 1:04x}]").search
        self.model, self.letters = self.whole.model, _byte_letters()
        self.kind = np.uint16 if self.whole.get_vocab_size() <= 1 << 16 else np.uint32
        self.memo = Memo(self._piece, 600_000)

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece from the model alone, as the cutting is done: bytes as the characters that stand for them."""
        tokens = self.model.tokenize(piece.encode("utf-8").decode("latin-1").translate(self.letters))
        return np.array([t.id for t in tokens], self.kind).tobytes()

    def pieces(self, text: str) -> list[str]:
        return self.wide(text) if self.beyond(text) else self.narrow(text)

    def packed(self, text: str) -> bytes:
        """Ids as 16-bit numbers (32-bit ones in a large vocabulary)."""
        if any(s in text for s in self.special):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        return b"".join(map(self.memo.__getitem__, self.pieces(text)))

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.packed(text), self.kind).astype(np.int32)


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One encoder for each worker process: pieces that an earlier task met are remembered."""
    return Encoder(path)


def _encoded(path: str, end: int):
    def run(batches):
        encoder, rows = encoder_of(path), 0
        closing, width = encoder.kind(end).tobytes(), np.dtype(encoder.kind).itemsize
        for batch in batches:
            part, size, first = [], 0, 0
            began, rows = rows, rows + batch.num_rows
            texts = batch.column("__text").to_pylist()

            def block(until: int):
                offsets = np.concatenate([[0], np.cumsum([len(p) for p in part]) // width]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(part), encoder.kind).astype(np.int32)))
                ids = batch.column("doc_id").slice(first, until - first)
                lengths = pa.array(np.diff(offsets).astype(np.int64))
                shard, place = batch.column("shard").slice(first, until - first), pa.array(np.arange(began + first, began + until))
                return pa.RecordBatch.from_arrays([shard, place, ids, lengths, tokens], names=["shard", "row", "doc_id", "n_tokens", "tokens"])

            for i, text in enumerate(texts):
                part.append(encoder.packed(text or "") + closing)
                size += len(part[-1])
                if size >= width << 20:
                    yield block(i + 1)
                    part, size, first = [], 0, i + 1
            if part:
                yield block(len(texts))

    return run


def write_tokens(docs: DataFrame, out: str, vocabulary: str, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes ``shard``, ``row``, ``doc_id``, ``n_tokens`` and ``tokens`` to Parquet, rows in ascending id order.

    Files follow each other by ``shard``, rows inside by id, then by text; ``row`` is the place in the shard. Token ids are dictionary encoded, ids and
    lengths delta encoded (format version 2), statistics and page indexes are written, and row groups and pages are kept
    small. A null text counts as empty and has the end id only; null ids come first; rows with the same id are all
    written. An empty table gives files without rows. Other columns are ignored.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    parts = max(1, -(-slim.count() // TASK_ROWS))
    ranged = slim.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "__text").withColumn("shard", F.spark_partition_id())
    kind = dict(slim.dtypes)["doc_id"]
    coded = ranged.mapInArrow(_encoded(vocabulary, end), f"shard int, row long, doc_id {kind}, n_tokens long, tokens array<int>")
    writer = coded.write.option("parquet.writer.version", "v2").option("parquet.enable.dictionary", "false")
    writer = writer.option("parquet.enable.dictionary#tokens.list.element", "true").option("parquet.dictionary.page.size", str(1 << 20))
    writer.option("parquet.block.size", str(ROW_GROUP)).option("parquet.page.row.count.limit", str(PAGE_ROWS)).option("compression", "zstd").parquet(out)


def _checked(batches):
    for batch in batches:
        tokens = batch.column("tokens")
        values = tokens.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.cumsum(tokens.value_lengths().to_numpy(zero_copy_only=False))
        raw, sums, start = memoryview(values.tobytes()), [], 0
        for e in ends.tolist():
            sums.append(zlib.crc32(raw[4 * start : 4 * e]))
            start = e
        names = ["shard", "row", "doc_id", "n_tokens"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(sums, pa.int64())], names=[*names, "ids_crc32"])


def read_lengths(spark: SparkSession, out: str) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of all documents. No page of tokens is read."""
    return spark.read.parquet(out).select("doc_id", "n_tokens")


def read_tokens(spark: SparkSession, out: str, ids: list[int] | DataFrame) -> DataFrame:
    """``doc_id`` and ``tokens`` of chosen documents.

    A list reaches the scan: rows are sorted by id, so files, row groups and, by the page index, pages of other ids are
    skipped. A table of ids (its first column) is joined; Spark derives a filter from it where it is small.
    """
    files = spark.read.parquet(out)
    if isinstance(ids, list):
        return files.where(F.col("doc_id").isin(ids)).select("doc_id", "tokens")
    chosen = ids.select(F.col(ids.columns[0]).alias("doc_id")).distinct()
    return files.join(chosen, "doc_id", "left_semi").select("doc_id", "tokens")


def read_digests(spark: SparkSession, out: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32`` from the files.

    Sums of shards come from ``shard`` and ``n_tokens`` alone; only the checksum reads the tokens. Inside a shard, a
    bounded number of rows, the running total is a window.
    """
    files = spark.read.parquet(out)
    sizes = files.select("shard", "n_tokens").groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    kind = dict(files.dtypes)["doc_id"]
    rows = files.mapInArrow(_checked, f"shard int, row long, doc_id {kind}, n_tokens long, ids_crc32 long")
    within = Window.partitionBy("shard").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    return rows.join(offsets, "shard").select("doc_id", start.cast("long").alias("start"), "n_tokens", "ids_crc32")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{checkpoint_root(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write_tokens(table(spark, sf_dir, "documents"), out, vocabulary_path())
    return read_digests(spark, out)


QUERIES = {"op9_token_files": query}
ORACLE: dict[str, str] = {}

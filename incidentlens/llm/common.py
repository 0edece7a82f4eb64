"""Helpers shared by the operators: tables, written intermediate tables, whole-text tokenisation."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: White space of every contract here: space and \x09-\x0D; everything else belongs to a word.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_RE = "[\\x20\\x09-\\x0D]+"
WORD_RE = "[^\\x20\\x09-\\x0D]+"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back, ``by`` its last column if given.

    Cuts the lineage at storage every executor can reach, so a lost executor costs only its
    own tasks; a fresh folder name for each call keeps concurrent runs apart. Nothing reads the
    shuffle files of a finished write again, so Spark is told to remove them with it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame | None) -> None:
    """Remove tables that ``stored`` wrote, once nothing that is still to run reads them."""
    for df in tables:
        if df is None:
            continue
        spark = df.sparkSession
        for at in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if "/llm/" in at:
                path = spark._jvm.org.apache.hadoop.fs.Path(at)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Shared:
    """An object of bounded size for all tasks. It is broadcast with its class's code, so that
    executors need no copy of this package; ``get`` is called once per task."""

    def __init__(self, spark: SparkSession, value):
        self.broadcast = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def get(self):
        return cloudpickle.loads(self.broadcast.value)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that an operator is about to add (compared as Spark compares names)."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def n_words(text: Column | str) -> Column:
    """Number of words of a text, NULL and empty texts counting 0."""
    return F.coalesce(F.regexp_count(F.col(text) if isinstance(text, str) else text, F.lit(WORD_RE)), F.lit(0)).cast("long")


class Words:
    """Words of a batch of texts: ``codes`` (one per word, in order) index ``vocab``; the words of
    text i are ``codes[starts[i]:starts[i + 1]]``. NULL texts have no words."""

    def __init__(self, texts: pa.Array, lower: bool = True):
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        # copied: the string kernels below want arrays that start where their buffers do
        texts = pa.concat_arrays([texts.cast(pa.large_string()), pa.array([], pa.large_string())])
        texts = pc.fill_null(texts, "")
        if lower:
            texts = pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(texts)
        flat = lists.flatten()
        offsets = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = offsets - offsets[0]
        coded = flat.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.vocab: pa.Array = coded.dictionary
        empty = pc.index(self.vocab, pa.scalar("", self.vocab.type)).as_py() if len(self.vocab) else -1
        if empty >= 0:  # leading and trailing white space gives empty strings
            real = codes != empty
            offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
            codes = codes[real]
        self.codes, self.starts = codes, offsets
        self.counts = np.diff(offsets)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word of ``vocab`` (equal in every process)."""
        if not len(self.vocab):
            return np.zeros(0, np.uint64)
        return hash_array(self.vocab.to_numpy(zero_copy_only=False), categorize=False)


_MIX = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def shingles(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all n-word shingles of each text, with repeats, and the start of each
    text's run. A text of fewer words has one shingle, its whole sequence; without words, none."""
    h = words.hashes()[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    total, counts, starts = len(h), words.counts, words.starts
    with np.errstate(over="ignore"):
        rolled = np.zeros(total, np.uint64)
        for k in range(n):
            rolled[: total - k if k else total] = rolled[: total - k if k else total] * _MIX + scramble(h[k:] + np.uint64(k + 1))
        per = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
        out_starts = np.concatenate([[0], np.cumsum(per)])
        idx = np.arange(out_starts[-1]) + np.repeat(starts[:-1] - out_starts[:-1], per)
        out = rolled[idx] if len(idx) else np.zeros(0, np.uint64)
        for i in np.flatnonzero((counts > 0) & (counts < n)):  # whole short sequences, marked by their length
            acc = np.uint64(counts[i])
            for x in h[starts[i]:starts[i + 1]]:
                acc = acc * _MIX + scramble(np.array([x + np.uint64(11)]))[0]
            out[out_starts[i]] = acc
        return scramble(out), out_starts


def slices(batches, rows: int = 2000, max_bytes: int = 12_000_000):
    """Arrow batches cut into pieces of bounded size, so one batch of long texts stays small in memory."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            n = min(rows, batch.num_rows - at)
            while n > 1 and batch.slice(at, n).nbytes > max_bytes:
                n //= 2
            yield batch.slice(at, n)
            at += n
    pa.default_memory_pool().release_unused()  # a worker that waits for its next task holds no empty buffers

"""Phrase collocation mining by direct-address tiling.

Frequent words get ids by their rank (most frequent first), and the texts are stored once as arrays of ids. A pair of
neighbours is then a cell of a square of ranks, cut into tiles of ``EDGE`` by ``EDGE`` cells: a tile that
many pairs of a batch fall into is counted with a dense ``bincount``, the sparse rest as sorted coordinates
with counts. Frequent pairs are ranked again and take the place of words, so a pair of (phrase of k words,
word) is a phrase of k + 1 words, counted the same way; only phrases whose first and last k words are frequent
are candidates, so no frequent phrase is missed.

The ranks of the ``RANKS`` most frequent words (phrases) travel to all tasks as 64-bit hashes, a proven bound. Rarer
ones that still reach the minimum have their hash for an id and are known by a bitmap of
``TAIL_BITS`` bits; a word that hits it by chance only makes candidates that do not reach the minimum. So tables of any
size are counted whole.

Defined results: NULL and empty texts have no words; a NULL lang is ``und``; rows that repeat count as often as they
stand; an empty table, or one without a phrase that is frequent enough, gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pandas.util import hash_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Shared, Words, scramble, slices, stored, table

#: Characters between pieces; none of them can be part of a word, so " . " marks a border.
BORDERS = "[.,;:!?\\x0A-\\x0D]"
MIN_COUNT, LONGEST, FIRST = 100, 5, 2000
RANKS = 1 << 17
EDGE_BITS = 11
EDGE = 1 << EDGE_BITS
#: A tile with at least so many pairs of a batch is counted densely.
DENSE = EDGE * EDGE // 16
TAIL_BITS = 1 << 23
_TAIL = np.int64(1 << 62)
#: Products of whole numbers of up to 38 digits.
SCORE = ("cast((cast(a as decimal(17, 0)) * cast(n as decimal(17, 0)) * cast(1000 as decimal(4, 0)))"
         " div (cast(l as decimal(17, 0)) * cast(r as decimal(17, 0))) as long)")
#: Pairs a task counts at once, and distinct words it holds.
HELD_PAIRS, HELD_WORDS = 1_000_000, 200_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Pieces(Words):
    """Words of a batch of texts; ``border`` is the code of the piece border in ``vocab`` (-1: none)."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        super().__init__(pc.replace_substring_regex(texts, BORDERS, " . "))
        self.border = pc.index(self.vocab, pa.scalar(".", self.vocab.type)).as_py() if len(self.vocab) else -1
        self.hash = self.hashes()


def _lang_codes(langs: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Code of each text's language, the languages, and their hashes."""
    coded = pc.fill_null(langs.cast(pa.string()), "und").dictionary_encode()
    names = coded.dictionary.to_pylist()
    return coded.indices.to_numpy(zero_copy_only=False), names, scramble(hash_array(np.asarray(names, object), categorize=False))


def _word_keys(lang_hash: np.ndarray, word_hash: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return scramble(lang_hash * _MIX + word_hash)


def _pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return scramble(scramble(left.astype(np.uint64)) * _MIX + right.astype(np.uint64))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, key, n) of all words of ``docs`` (text, lang, ...); key: their 64-bit hash."""
    def run(batches):
        held, rows = [], 0
        for batch in slices(batches, max_bytes=3_000_000):
            w = Pieces(batch.column(0))
            lang, names, lang_hash = _lang_codes(batch.column(1))
            real = w.codes != w.border
            code = (np.repeat(lang, w.counts)[real].astype(np.int64) * max(1, len(w.vocab))) + w.codes[real]
            code, n = np.unique(code, return_counts=True)
            lang, word = np.divmod(code, max(1, len(w.vocab)))
            held.append(pa.table([pa.array(names, pa.string()).take(pa.array(lang)), w.vocab.take(pa.array(word)).cast(pa.string()),
                                  pa.array(_word_keys(lang_hash[lang], w.hash[word]).view(np.int64)), pa.array(n.astype(np.int64))],
                                 names=["lang", "word", "key", "n"]))
            rows += len(code)
            if rows > HELD_WORDS:
                held = [_summed(held)]
                rows = held[0].num_rows
                if rows > HELD_WORDS // 2:
                    yield from held[0].to_batches()
                    held, rows = [], 0
        if held:
            yield from _summed(held).to_batches()

    rows = docs.select("text", "lang").mapInArrow(run, "lang string, word string, key long, n long")
    return rows.groupBy("lang", "word", "key").agg(F.sum("n").alias("n"))


def _summed(tables: list) -> pa.Table:
    keys = ["lang", "word", "key"]
    t = pa.concat_tables(tables).group_by(keys).aggregate([("n", "sum")])
    return t.select([*keys, "n_sum"]).rename_columns([*keys, "n"])


class Ranks:
    """Ids of frequent words or phrases by their keys: the rank from 1, or for the tail a hash."""

    def __init__(self, keys: np.ndarray, tail: np.ndarray | None):
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order.astype(np.int64) + 1
        self.tail = tail  # bitmap by cell, None if every frequent one has a rank

    def ids(self, keys: np.ndarray) -> np.ndarray:
        """Id of each key; 0 for what is not frequent."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = self.keys[at] == keys
        out = np.where(known, self.rank[at], 0)
        if self.tail is not None:
            cell = (keys % np.uint64(TAIL_BITS)).astype(np.int64)
            there = ~known & ((self.tail[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1).astype(bool)
            out[there] = (keys[there] >> np.uint64(2)).astype(np.int64) | _TAIL
        return out


def ranked(frequent: DataFrame) -> Ranks:
    """Ranks of ``frequent`` (key, n, ...), stored; at most RANKS keys and one bitmap reach the driver."""
    top = frequent.orderBy(F.desc("n"), "key").limit(RANKS).select("key", "n").collect()
    keys = np.array([r["key"] for r in sorted(top, key=lambda r: (-r["n"], r["key"]))], np.int64).view(np.uint64)
    if len(keys) < RANKS:
        return Ranks(keys, None)
    last = max((-r["n"], r["key"]) for r in top)
    rest = frequent.where((F.col("n") < -last[0]) | ((F.col("n") == -last[0]) & (F.col("key") > last[1])))

    def run(batches):
        for batch in batches:
            cell = batch.column(0).to_numpy().view(np.uint64) % np.uint64(TAIL_BITS)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int64) + 1)], names=["cell"])

    cells = rest.select("key").mapInArrow(run, "cell long")
    tail = np.zeros(TAIL_BITS // 8, np.uint8)
    rows = (cells.groupBy(F.bitmap_bucket_number("cell").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")))
    for r in rows.collect():  # TAIL_BITS / 32768 rows of 4 KB at most
        at = (r["bucket"] - 1) * 4096
        part = np.frombuffer(r["bits"], np.uint8)[: len(tail) - at]
        tail[at:at + len(part)] = part
    return Ranks(keys, tail)


def encoded(docs: DataFrame, words: Ranks) -> DataFrame:
    """(ids) of every text with neighbouring frequent words; 0 stands for all else, and ends each text."""
    shared = Shared(docs.sparkSession, words)

    def run(batches):
        ranks = shared.get()
        for batch in slices(batches, max_bytes=3_000_000):
            w = Pieces(batch.column(0))
            lang, _, lang_hash = _lang_codes(batch.column(1))
            doc = np.repeat(np.arange(batch.num_rows), w.counts)
            ids = ranks.ids(_word_keys(lang_hash[lang[doc]], w.hash[w.codes]) if len(doc) else np.zeros(0, np.uint64))
            ids[w.codes == w.border] = 0
            keep = np.ones(len(ids), bool)  # a run of zeros says no more than one
            keep[1:] = (ids[1:] != 0) | (ids[:-1] != 0) | (doc[1:] != doc[:-1])
            ids, doc = ids[keep], doc[keep]
            n = np.bincount(doc, minlength=batch.num_rows)
            stop = np.cumsum(n)
            ids = np.insert(ids, stop, 0)
            offsets = np.concatenate([[0], np.cumsum(n + 1)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
            yield pa.RecordBatch.from_arrays([lists.filter(pa.array(n > 1))], names=["ids"])

    return docs.select("text", "lang").mapInArrow(run, "ids array<long>")


def count_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs and their counts: dense tiles by bincount, the rest as sorted coordinates."""
    out = []
    ranked_ = (left <= RANKS) & (right <= RANKS)
    tail_l, tail_r = left[~ranked_], right[~ranked_]
    l, r = left[ranked_], right[ranked_]
    across = (RANKS >> EDGE_BITS) + 1
    tile = (l >> EDGE_BITS) * across + (r >> EDGE_BITS)
    size = np.bincount(tile, minlength=1)
    sparse = np.ones(len(l), bool)
    for t in np.flatnonzero(size >= DENSE):
        own = tile == t
        sparse &= ~own
        n = np.bincount(((l[own] & (EDGE - 1)) << EDGE_BITS) | (r[own] & (EDGE - 1)), minlength=EDGE * EDGE)
        cell = np.flatnonzero(n)
        out.append(((t // across << EDGE_BITS) | (cell >> EDGE_BITS), (t % across << EDGE_BITS) | (cell & (EDGE - 1)), n[cell]))
    code, n = np.unique((l[sparse] << 32) | r[sparse], return_counts=True)
    out.append((code >> 32, code & 0xFFFFFFFF, n))
    if len(tail_l):
        order = np.lexsort((tail_r, tail_l))
        tail_l, tail_r = tail_l[order], tail_r[order]
        first = np.flatnonzero(np.concatenate([[True], (tail_l[1:] != tail_l[:-1]) | (tail_r[1:] != tail_r[:-1])]))
        out.append((tail_l[first], tail_r[first], np.diff(np.concatenate([first, [len(tail_l)]]))))
    return tuple(np.concatenate([o[k] for o in out]).astype(np.int64) for k in range(3))


def phrase_ids(x: np.ndarray, levels: list[Ranks]) -> np.ndarray:
    """Id of the phrase of len(levels) + 1 words that begins at each place; 0 if it is not frequent."""
    now = x
    for k, ranks in enumerate(levels, 1):
        at = np.flatnonzero((now[:-k] != 0) & (x[k:] != 0)) if len(x) > k else np.zeros(0, np.int64)
        next_ = np.zeros(len(x), np.int64)
        next_[at] = ranks.ids(_pair_keys(now[at], x[at + k]))
        now = next_
    return now


def pair_counts(texts: DataFrame, levels: list[Ranks]) -> DataFrame:
    """(l, r, n) of phrases of k + 1 words, k = len(levels) + 1: id of the first k and of the last word."""
    shared = Shared(texts.sparkSession, levels)
    k = len(levels) + 1

    def run(batches):
        known = shared.get()
        held, size = [], 0

        def counted():
            l, r, n = count_pairs(*(np.concatenate([h[j] for h in held]) for j in range(2)))
            for at in range(0, len(l), 1 << 17):
                part = slice(at, at + (1 << 17))
                yield pa.RecordBatch.from_arrays([pa.array(c[part]) for c in (l, r, n)], names=["l", "r", "n"])

        for batch in slices(batches, max_bytes=4_000_000):
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            if len(x) <= k:
                continue
            ids = phrase_ids(x, known)
            at = np.flatnonzero((ids[:-k] != 0) & (ids[1:len(ids) - k + 1] != 0) & (x[k:] != 0))
            held.append((ids[at], x[at + k]))
            size += len(at)
            if size > HELD_PAIRS:
                yield from counted()
                held, size = [], 0
        if size:
            yield from counted()

    rows = texts.mapInArrow(run, "l long, r long, n long")
    return rows.groupBy("l", "r").agg(F.sum("n").alias("n"))


def with_keys(pairs: DataFrame) -> DataFrame:
    """``pairs`` (l, r, n) with their 64-bit hash."""
    def run(batches):
        for batch in batches:
            key = _pair_keys(*(batch.column(k).to_numpy() for k in range(2))).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=["l", "r", "n", "key"])

    return pairs.select("l", "r", "n").mapInArrow(run, "l long, r long, n long, key long")


def with_ids(frequent: DataFrame, ranks: Ranks) -> DataFrame:
    """``frequent`` (key, ...) with the id of each row."""
    shared = Shared(frequent.sparkSession, ranks)
    names = frequent.columns

    def run(batches):
        known = shared.get()
        for batch in batches:
            ids = known.ids(batch.column(names.index("key")).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids)], names=[*names, "id"])

    return frequent.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frequent.schema) + ", id long")


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, a) of all phrases of 1 to ``longest`` words that occur ``min_count`` times or more, and
    (lang, n), the number of all words of each language."""
    docs = docs.select("text", "lang")
    words = stored(word_counts(docs), "phrases-words")
    totals = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrases-totals")
    frequent = stored(words.where(F.col("n") >= min_count), "phrases-frequent")
    ranks = ranked(frequent)
    texts = stored(encoded(docs, ranks), "phrases-texts")
    single = stored(with_ids(frequent, ranks).select("id", "lang", F.col("word").alias("phrase"), F.lit(1).alias("k"), F.col("n").alias("a")),
                    "phrases-of-1")
    last, all_, levels = single, single, []
    for k in range(2, longest + 1):
        frequent = stored(with_keys(pair_counts(texts, levels).where(F.col("n") >= min_count)), "phrases-frequent")
        ranks = ranked(frequent)
        if not len(ranks.keys):
            break
        rows = with_ids(frequent, ranks).select("id", "l", "r", F.col("n").alias("a"))
        first = last.select(F.col("id").alias("l"), "lang", F.col("phrase").alias("_first"))
        word = single.select(F.col("id").alias("r"), F.col("phrase").alias("_word"))
        rows = rows.join(first, "l").join(word, "r")
        last = stored(rows.select("id", "lang", F.concat_ws(" ", "_first", "_word").alias("phrase"), F.lit(k).alias("k"), "a"), f"phrases-of-{k}")
        all_ = all_.unionByName(last)
        levels.append(ranks)
    return all_.select("lang", "phrase", "k", "a"), totals


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, first: int = FIRST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``first`` phrases of each language of ``docs`` (text, lang, ...).

    Products are of decimals of 38 digits: 1000 * a * n and l * r stay exact up to 10 ** 17 words."""
    all_, totals = frequent_phrases(docs, min_count, longest)
    words = F.split("phrase", " ")
    some = all_.where("k > 1").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    some = some.select("lang", "phrase", "a", "cut", F.concat_ws(" ", F.slice(words, F.lit(1), F.col("cut"))).alias("_left"),
                       F.concat_ws(" ", F.slice(words, F.col("cut") + 1, F.col("k") - F.col("cut"))).alias("_right"))
    part = lambda name, count: all_.select("lang", F.col("phrase").alias(name), F.col("a").alias(count))
    some = some.join(part("_left", "l"), ["lang", "_left"]).join(part("_right", "r"), ["lang", "_right"]).join(totals, "lang")
    best = (some.withColumn("score", F.expr(SCORE)).groupBy("lang", "phrase", "a", "n")
            .agg(F.min(F.struct("score", "cut", "l", "r")).alias("b")))
    best = best.select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score")
    # a phrase inside a longer one as frequent is inside one that is longer by one word and as frequent
    longer = all_.where("k > 2").select("lang", "a", F.explode(F.array(
        F.concat_ws(" ", F.slice(words, F.lit(1), F.col("k") - 1)), F.concat_ws(" ", F.slice(words, F.lit(2), F.col("k") - 1)))).alias("phrase"))
    best = best.join(longer, ["lang", "phrase", "a"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return top.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrase_mining(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = """
WITH pieces AS (
  SELECT doc_id, lang, unnest(list_zip(p, range(len(p)))) AS z
  FROM (SELECT doc_id, coalesce(lang, 'und') AS lang, regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]') AS p FROM documents)),
words AS (SELECT lang, regexp_extract_all(z[1], '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM words, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, k, phrase, a, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
parts AS (
  SELECT *, array_to_string(string_split(phrase, ' ')[1:cut], ' ') AS x, array_to_string(string_split(phrase, ' ')[cut + 1:], ' ') AS y FROM cuts),
scored AS (
  SELECT p.lang, p.k, p.phrase, p.a, u.a AS l, v.a AS r, t.n,
    ((1000::HUGEINT * p.a * t.n) // (u.a::HUGEINT * v.a))::BIGINT AS score, cut
  FROM parts p JOIN f u ON u.lang = p.lang AND u.phrase = p.x JOIN f v ON v.lang = p.lang AND v.phrase = p.y JOIN totals t ON t.lang = p.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM f q WHERE q.lang = b.lang AND q.k > b.k AND q.a >= b.a
      AND contains(' ' || q.phrase || ' ', ' ' || b.phrase || ' '))),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM r WHERE rank <= 2000"""

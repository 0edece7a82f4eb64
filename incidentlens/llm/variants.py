"""Spelling variant grouping by finite-state composition.

Words are counted over all texts (``word_counts``); the frequent ones are the vocabulary. Two words are
near if one inserted, deleted or replaced code point turns one into the other. Near pairs are the
paths of a composed machine: the minimised acceptor of the words, a one-edit transducer (state 0: no edit
yet, state 1: one made), and the acceptor again.

The composition is run by initial state. Let m be the length of the shorter word of a pair and d the
length of the prefix both share (the place of the edit, 0 to m). For a window s <= d < e the pair shares its first s and its last
m - e code points, so all pairs of a window meet in the group of words with that beginning and that end: the
part of the machine that is entered in the state behind the beginning. Every word belongs to two m (its length, and one
less) and, for each, to the windows of its two halves. Each pair is enumerated in exactly one group.

A group of more than ``MOST`` words is not run but divided: its window is halved, which narrows beginning and
end, and so on. A window of one place holds at most a few thousand words (one free code point, or two), so every
group that runs is small whatever the vocabulary, no pair is lost, and no word meets all others.

Defined results: NULL and empty texts have no words; a NULL doc_id counts as an empty one; rows that repeat are
counted as often as they stand; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, slices, stored, table

LETTERS = "A-Za-z\\x{C0}-\\x{FF}"
#: Every run whose checksum is a multiple of this loses one code point.
ONE_IN = 199
MIN_LENGTH, MIN_COUNT = 6, 5
#: A word's form is its most frequent near word, if that is so many times as frequent.
RATIO = 5
#: Words of one group that are composed in one place (a window of one place never holds more, see ``divided``).
MOST = 20_000
#: Distinct words a task holds before it hands them on.
HELD = 200_000


def _zero_tables(longest: int) -> np.ndarray:
    """tables[n, k, b]: the CRC-32 register after n zero bytes, for the byte b of the register's k-th byte."""
    one = np.zeros(256, np.uint32)
    for b in range(256):
        x = b
        for _ in range(8):
            x = (x >> 1) ^ (0xEDB88320 if x & 1 else 0)
        one[b] = x
    out = np.zeros((longest + 1, 4, 256), np.uint32)
    for k in range(4):
        out[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(1, longest + 1):
        before = out[n - 1]
        out[n] = (before >> np.uint32(8)) ^ one[before & np.uint32(255)]
    return out


class Checksums:
    """CRC-32 of concatenations from those of their parts: the register is linear in its start."""

    def __init__(self, longest: int = 64):
        self.tables = _zero_tables(longest)

    def joined(self, first: np.ndarray, second: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Checksums of a + b, given those of a and of b and the bytes of b."""
        size = np.asarray(size)
        while len(size) and size.max() >= len(self.tables):
            self.tables = _zero_tables(2 * len(self.tables))
        t, out = self.tables, second.astype(np.uint32)
        for k in range(4):
            out = out ^ t[size, k, (first >> np.uint32(8 * k)) & np.uint32(255)]
        return out


#: Runs of more bytes are checked one by one.
LONG_RUN = 200


def _counted(batch: pa.RecordBatch, sums: Checksums) -> tuple[pa.Array, np.ndarray]:
    """The words of a batch (doc_id, text) and how often each occurs, with the deletions made."""
    texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
    w = Words(pc.replace_substring_regex(texts, f"[^{LETTERS}]+", " "))
    n = np.bincount(w.codes, minlength=len(w.vocab)).astype(np.int64)
    if not len(w.codes):
        return w.vocab, n
    ids = ["" if i is None else str(i) for i in batch.column(0).to_pylist()]
    start = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
    vocab = w.vocab.to_pylist()
    raw = [v.encode() for v in vocab]
    own = np.array([zlib.crc32(r) for r in raw], np.uint32)
    size = np.array([len(r) for r in raw])
    doc = np.repeat(np.arange(len(ids)), w.counts)
    h = np.zeros(len(w.codes), np.uint32)
    usual = size[w.codes] < LONG_RUN
    c = w.codes[usual]
    h[usual] = sums.joined(start[doc[usual]], own[c], size[c])
    for at in np.flatnonzero(~usual):
        h[at] = zlib.crc32(raw[w.codes[at]], int(start[doc[at]]))
    changed = np.flatnonzero(h % np.uint32(ONE_IN) == 0)
    np.subtract.at(n, w.codes[changed], 1)
    more: dict[str, int] = {}
    for at in changed:
        word = vocab[w.codes[at]]
        k = int(h[at]) % len(word)
        word = word[:k] + word[k + 1:]
        more[word] = more.get(word, 0) + 1
    words = pa.concat_arrays([w.vocab.cast(pa.large_string()), pa.array(list(more), pa.large_string())])
    return words, np.concatenate([n, np.fromiter(more.values(), np.int64, len(more))])


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of ``docs`` (doc_id, text, ...) of at least that length and so many occurrences."""
    def run(batches):
        sums, held, rows = Checksums(), [], 0
        for batch in slices(batches, max_bytes=5_000_000):
            word, n = _counted(batch, sums)
            keep = (pc.utf8_length(word).to_numpy(zero_copy_only=False) >= min_length) & (n > 0)
            held.append(pa.table([word.filter(pa.array(keep)), pa.array(n[keep])], names=["word", "n"]))
            rows += held[-1].num_rows
            if rows > HELD:
                held = [_summed(held)]
                rows = held[0].num_rows
                if rows > HELD // 2:
                    yield from held[0].to_batches()
                    held, rows = [], 0
        if held:
            yield from _summed(held).to_batches()

    counted = docs.select(F.col("doc_id"), F.col("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _summed(tables: list) -> pa.Table:
    t = pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")])
    return pa.table([t.column("word").cast(pa.string()).cast(pa.large_string()), t.column("n_sum")], names=["word", "n"])


# ---- the machine of one group


class Acceptor:
    """The minimal deterministic acceptor of sorted distinct words (states built behind a moving front).

    ``arcs[q]`` maps code points to states, ``final[q]`` says whether q accepts, ``names[q]`` are the ends
    accepted from q (so a path names its words)."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        open_: list[tuple[dict, list]] = [({}, [False])]  # states of the last word's path, not yet frozen
        last = ""
        for word in words:
            same = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                same += 1
            self._freeze(open_, last, same)
            open_ += [({}, [False]) for _ in word[same:]]
            open_[-1][1][0] = True
            last = word
        self._freeze(open_, last, 0)
        self.start = self._state(*open_[0])

    def _freeze(self, open_, word, depth):
        while len(open_) > depth + 1:
            arcs, final = open_.pop()
            open_[-1][0][word[len(open_) - 1]] = self._state(arcs, final)

    def _state(self, arcs, final):
        key = (final[0], tuple(arcs.items()))
        q = self._known.get(key)
        if q is None:
            q = self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final[0])
        return q


def near_pairs(words: list[str], most_prefix: int) -> list[tuple[str, str]]:
    """Pairs (x, y) one edit apart whose common prefix is shorter than ``most_prefix``; x is the longer one,
    or comes first if both have one length.

    Paths of acceptor, one-edit transducer and acceptor: before the edit both acceptors are in one state, as the words
    agree; behind it the pair of states must accept a common end, which is remembered for each pair."""
    a = Acceptor(sorted(words))
    arcs, final = a.arcs, a.final
    ends: dict[tuple[int, int], list[str]] = {}

    def shared(p: int, q: int) -> list[str]:
        few, many = (arcs[p], arcs[q]) if len(arcs[p]) <= len(arcs[q]) else (arcs[q], arcs[p])
        return [c for c in few if c in many]

    def chain(p: int, q: int) -> tuple[list[str], int, int, list[str]]:
        """The code points that follow without a choice, the states behind them, and the choices there."""
        text, next_ = [], shared(p, q)
        while len(next_) == 1 and not (final[p] and final[q]):
            c = next_[0]
            text.append(c)
            p, q = arcs[p][c], arcs[q][c]
            next_ = shared(p, q)
        return text, p, q, next_

    def common(p: int, q: int) -> list[str]:
        """All ends that both states accept: paths of edit state 1 (remembered where paths part)."""
        todo, begun = [(p, q)], {}
        while todo:
            key = todo[-1]
            if key in ends:
                todo.pop()
                continue
            if key not in begun:
                begun[key] = chain(*key)
            text, x, y, next_ = begun[key]
            missing = [k for k in ((arcs[x][c], arcs[y][c]) for c in next_) if k not in ends]
            if missing:
                todo += missing
                continue
            found = [""] if final[x] and final[y] else []
            found += [c + end for c in next_ for end in ends[arcs[x][c], arcs[y][c]]]
            ends[key] = ["".join(text) + end for end in found] if text else found
            todo.pop()
        return ends[p, q]

    def text_of(path) -> str:
        out = []
        while path is not None:
            path, c = path
            out.append(c)
        return "".join(reversed(out))

    out = []
    front = [(None, a.start)]  # paths of edit state 0, as (path before, code point)
    for _ in range(most_prefix):
        behind = []
        for path, q in front:
            own, made = sorted(arcs[q].items()), []
            for k, (c, to) in enumerate(own):
                behind.append(((path, c), to))
                for d, other in own[k + 1:]:  # replaced
                    made += [(c + end, d + end) for end in common(to, other)]
                # deleted, at the last place that gives this pair: what follows does not begin with c
                if final[to] and final[q]:
                    made.append((c, ""))
                for d in shared(to, q):
                    if d != c:
                        made += [(c + d + end, d + end) for end in common(arcs[to][d], arcs[q][d])]
            if made:
                prefix = text_of(path)
                out += [(prefix + x, prefix + y) for x, y in made]
        front = behind
    return out


# ---- groups


def _window(s, e, m) -> tuple:
    """Key of the group of a word for the window [s, e) of pairs whose shorter word has m code points."""
    word, size = F.col("word"), F.col("size")
    end = F.greatest(m - e, F.lit(0))
    return (F.struct(m.alias("m"), s.alias("s"), e.alias("e"), F.substring(word, F.lit(1), s).alias("head"),
                     F.when(end > 0, F.substring(word, size - end + 1, end)).otherwise("").alias("tail")))


def groups(vocabulary: DataFrame) -> DataFrame:
    """(word, n, size, key): every word once for each group it belongs to, windows of half a word."""
    rows = vocabulary.select("word", "n", F.length("word").alias("size"))
    rows = rows.withColumn("m", F.explode(F.array(F.col("size"), F.col("size") - 1))).where("m > 0")
    half = F.floor(F.col("m") / 2).cast("int")
    m = F.col("m")
    windows = F.array(_window(F.lit(0), half, m), _window(half, m + 1, m))
    return rows.select("word", "n", "size", F.explode(windows).alias("key")).where("key.s < key.e")


def divided(rows: DataFrame) -> DataFrame:
    """The same words in the groups of both halves of their windows.

    A window of one place leaves its words of the shorter length one free code point and the longer ones two; with the
    91 letters of a run that is 91 + 91 * 91 words at most, which is below ``MOST``."""
    s, e, m = F.col("key.s"), F.col("key.e"), F.col("key.m")
    mid = F.floor((s + e) / 2).cast("int")
    return rows.withColumn("key", F.explode(F.array(_window(s, mid, m), _window(mid, e, m))))


def _pairs_of_groups(rows: DataFrame) -> DataFrame:
    """(word, n, other, other_n), both ways, of the near words of each group."""
    def run(batches):
        for names, sizes, words, counts in _whole_groups(batches):
            m, s, e = sizes
            end = max(m - e, 0)
            cut = {w[s:len(w) - end]: k for k, w in enumerate(words)}
            if len(cut) < 2:
                continue
            found = near_pairs(list(cut), e - s)
            pair = [(cut[x], cut[y]) for x, y in found if min(len(x), len(y)) + s + end == m]
            yield [(words[a], counts[a], words[b], counts[b]) for x, y in pair for a, b in ((x, y), (y, x))]

    def batches_of(batches):
        held = []
        for part in run(batches):
            held += part
            if len(held) > 10_000:
                yield _pair_batch(held)
                held = []
        if held:
            yield _pair_batch(held)

    flat = rows.select(F.col("key.m").alias("m"), F.col("key.s").alias("s"), F.col("key.e").alias("e"),
                       F.col("key.head").alias("head"), F.col("key.tail").alias("tail"), "word", "n")
    key = ["m", "s", "e", "head", "tail"]
    return (flat.repartition(*key).sortWithinPartitions(*key, "word")
            .mapInArrow(batches_of, "word string, n long, other string, other_n long"))


def _pair_batch(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.string(), pa.int64(), pa.string(), pa.int64()])],
                                      names=["word", "n", "other", "other_n"])


def _whole_groups(batches):
    """(key, (m, s, e), words, counts) of each run of rows with one key."""
    now, words, counts = None, [], []
    for batch in batches:
        cols = [batch.column(k).to_pylist() for k in range(7)]
        for m, s, e, head, tail, word, n in zip(*cols):
            key = (m, s, e, head, tail)
            if key != now:
                if len(words) > 1:
                    yield now, now[:3], words, counts
                now, words, counts = key, [], []
            words.append(word)
            counts.append(n)
    if len(words) > 1:
        yield now, now[:3], words, counts


def near_words(vocabulary: DataFrame, most: int = MOST) -> DataFrame:
    """(word, n, other, other_n) for every two near words of ``vocabulary`` (word, n), both ways."""
    rows, found = stored(groups(vocabulary), "variants-groups"), None
    while True:
        size = rows.groupBy("key").agg(F.count("*").alias("k"))
        divides = (F.col("k") > most) & F.expr("key.e - key.s > 1")
        small = size.where((F.col("k") > 1) & ~divides).select("key")
        large = size.where(divides).select("key")
        pairs = _pairs_of_groups(rows.join(small, "key"))
        found = pairs if found is None else found.unionByName(pairs)
        if large.isEmpty():
            return found
        rows = stored(divided(rows.join(large, "key")), "variants-groups")


def variants(vocabulary: DataFrame, ratio: int = RATIO, most: int = MOST) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``vocabulary`` (word, n).

    Each form is at least ``ratio`` times as frequent as its word, so chains of forms are as long as a logarithm of the counts
    at most; they are followed by doubling, one shuffle join a step."""
    vocabulary = stored(vocabulary.select("word", "n"), "variants-words")
    near = near_words(vocabulary, most).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("other"))).alias("best"))
    both = vocabulary.join(near, "word", "left")
    is_form = -F.col("best.minus") >= ratio * F.col("n")
    marked = stored(both.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(is_form, F.col("best.other")).alias("form"), F.when(is_form, -F.col("best.minus")).alias("form_n")),
                    "variants-forms")
    up = marked.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        step = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if up.join(step, "root", "left_semi").isEmpty():
            break
        up = stored(up.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "variants-roots")
    return (marked.join(up, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op12_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return variants(word_counts(table(spark, sf_dir, "documents")))
